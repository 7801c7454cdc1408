"""Pseudonyms for personal numbers, dates and addresses, with DataFrame functions only.

Method. Candidates are found by one regular expression and validated (Luhn for card
numbers, ranges for dates and IPv4 addresses, digit counts for phone numbers). A valid
value becomes mixed-radix digits that a keyed Feistel network permutes within the same
format: equal values get equal pseudonyms in every document, different values different
ones, and whoever has the key can invert it. Check digits are computed anew.

Formats: card numbers of 13 to 19 digits, alone or in one grouping with one separator, also
with other digits behind them; phone numbers; numbers like 123-45-6789; IPv4
addresses; dates of 1900 to 2099 as year-month-day, also in front of a time, or day/month/year
(both spellings of a day share one pseudonym), and month/day/year where it cannot be day first
(with pseudonyms of its own, among such dates); the part of an e-mail address before the @. All else stays.

Defined cases. A null text stays null. Candidates that fail validation stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Most repetitions of a permutation until its result is of the same kind; all but surely enough.
WALK = 64
#: Card numbers: digits alone, or with one separator in one grouping. A short last group counts
#: only if no digits follow: it may be something else, which ``_card`` decides.
LAST = r"(?!\w|[ ./-]\d)"
CARDS = [r"\d{13,19}(?!\w)"]
for _s in " -":
    CARDS += [rf"\d{{4}}(?:{_s}\d{{4}}){{3}}(?:{_s}\d{{1,3}}{LAST}|(?!\w))",
              rf"\d{{4}}(?:{_s}\d{{4}}){{2}}{_s}\d{{1,3}}(?!\w)",
              rf"\d{{4}}{_s}\d{{6}}{_s}\d{{4,5}}(?:{_s}\d{{1,4}}{LAST}|(?!\w))",
              rf"\d{{6}}{_s}\d{{7,13}}(?!\w)"]
    CARDS += [rf"\d{{{_k}}}(?:{_s}\d{{{_k}}}){{{12 // _k},{19 // _k - 1}}}"
              rf"(?:{_s}\d{{1,{max(_k - 1, 1)}}}{LAST}|(?!\w))" for _k in (1, 2, 3, 5, 6, 8)]
#: Lengths of card numbers, in the order in which they are tried at a place.
LENGTHS = (16, 15, 14, 13, 19, 18, 17)
# The formats, in the order in which they are tried at a place.
FORMATS = {
    "date": r"(?:\d{4}-\d{2}-\d{2}(?=T\d)|(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})(?![\w-]))",
    "ip": r"\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\w-])",
    "local": r"\d{3}[.-]\d{3}[.-]\d{4}(?!\w)",
    "card": "|".join(CARDS),
    "phone": r"\+?\d{0,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\w)"
             r"|\+\d(?:[ .-]?\d){7,14}(?!\w)",
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
}
#: Possible starts come first, so that a long run of letters is passed once.
FIND = r"(?<![A-Za-z0-9._%+@-])(?:" + "|".join(FORMATS.values()) + ")"
DATE = r"^(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})$"
#: Days from 1900-01-01 to 2099-12-31, as two digits of these bases.
DATE_BASES = (319, 229)
FIRST_DAY = "1900-01-01"


def _prf(key: str, kind: Column, k: Column, i: Column, half: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), kind, k.cast("string"), i.cast("string"),
                       F.array_join(half.cast("array<string>"), ","))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def permute(digits: Column, bases: Column, kind: Column, key: str, back: bool = False) -> Column:
    """Mixed-radix digits permuted by an alternating Feistel network; ``back`` inverts it."""
    half = F.floor(F.size(digits) / 2).cast("int")
    split = [F.slice(c, F.lit(1), half) for c in (digits, bases)]
    split += [F.slice(c, half + 1, F.size(c) - half) for c in (digits, bases)]
    sign = -1 if back else 1

    def turn(acc: Column, k: Column) -> Column:
        def add(x: Column, base: Column, y: Column) -> Column:
            return F.transform(x, lambda v, i: F.pmod(
                v + sign * F.pmod(_prf(key, kind, k, i, y), F.get(base, i)), F.get(base, i)))

        left, right = acc["l"], acc["r"]
        odd = k % 2 == 1
        return F.struct(F.when(odd, add(left, acc["lb"], right)).otherwise(left).alias("l"),
                        acc["lb"].alias("lb"),
                        F.when(odd, right).otherwise(add(right, acc["rb"], left)).alias("r"),
                        acc["rb"].alias("rb"))

    start = F.struct(split[0].alias("l"), split[1].alias("lb"), split[2].alias("r"),
                     split[3].alias("rb"))
    order = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else \
        F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(order, start, turn, lambda acc: F.concat(acc["l"], acc["r"]))


def _longs(chars: Column) -> Column:
    return chars.cast("array<bigint>")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of an array of digits whose last one counts once."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 0, d * 2 - F.when(
        d > 4, F.lit(9)).otherwise(F.lit(0))).otherwise(d))
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda a, d: a + d)


def _digits(value: Column) -> Column:
    return _longs(F.split(F.regexp_replace(value, r"\D", ""), ""))


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, one after the other."""
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("n"))

    def put(acc: Column, c: Column) -> Column:
        is_digit = c.rlike(r"^\d$")
        return F.struct(
            F.concat(acc["s"], F.when(is_digit, F.get(digits, acc["n"]).cast("string"))
                     .otherwise(c)).alias("s"),
            (acc["n"] + F.when(is_digit, 1).otherwise(0)).alias("n"))

    return F.aggregate(F.split(value, ""), start, put, lambda acc: acc["s"])


def _numbers(value: Column, kind: str, key: str, back: bool, keep: int = 0, check: bool = False
             ) -> Column:
    """Decimal digits permuted but for the first ``keep``; with a new Luhn digit if asked."""
    digits = _digits(value)
    body = F.slice(digits, F.lit(keep + 1), F.greatest(F.size(digits) - keep - int(check), F.lit(0)))
    new = permute(body, F.transform(body, lambda _: F.lit(10).cast("long")), F.lit(kind), key, back)
    new = F.concat(F.slice(digits, 1, keep), new) if keep else new
    if check:
        zero = F.concat(new, F.array(F.lit(0).cast("long")))
        new = F.concat(new, F.array(F.pmod(-luhn_sum(zero), F.lit(10).cast("long"))))
    return _refill(value, new)


def _card_span(value: Column) -> Column:
    """The first card number that ``value`` begins with and that ends with a group, or null."""
    ends = F.array(*[F.regexp_extract(value, rf"^\d(?:[ -]?\d){{{n - 1}}}(?!\d)", 0) for n in LENGTHS])
    return F.get(F.filter(ends, lambda s: (s != "") & (luhn_sum(_digits(s)) % 10 == 0)), 0)


def _card(value: Column, key: str, back: bool) -> Column:
    """The card number in front replaced, what follows kept; ``value`` if there is none.

    The permutation goes on until the card number would be told from what follows in the same
    way, so that it can be inverted.
    """
    def step(acc: Column, rest: Column) -> Column:
        new = F.transform(F.array(acc), lambda s: _numbers(s, "card", key, back, check=True))
        return F.get(F.transform(new, lambda s: F.struct(
            s.alias("s"), F.coalesce(F.length(_card_span(F.concat(s, rest))) == F.length(s),
                                     F.lit(False)).alias("ok"))), 0)

    def moved(span: Column) -> Column:
        rest = F.substring(value, F.length(span) + 1, F.length(value))
        first = F.struct(span.alias("s"), F.lit(False).alias("ok"))
        return F.concat(F.aggregate(
            F.sequence(F.lit(1), F.lit(WALK)), first,
            lambda acc, _: F.when(acc["ok"], acc).otherwise(step(acc["s"], rest)),
            lambda acc: acc["s"]), rest)

    found = F.filter(F.array(_card_span(value)), lambda s: s.isNotNull())
    return F.coalesce(F.get(F.transform(found, moved), 0), value)


def _phone(value: Column, key: str, back: bool) -> Column:
    """The last seven digits permuted: country and area stay."""
    digits = _digits(value)
    head = F.slice(digits, F.lit(1), F.size(digits) - 7)
    body = F.slice(digits, F.size(digits) - 6, F.lit(7))
    new = permute(body, F.transform(body, lambda _: F.lit(10).cast("long")),
                  F.concat(F.lit("phone"), F.array_join(head.cast("array<string>"), "")), key, back)
    return _refill(value, F.concat(head, new))


def _date(value: Column, key: str, back: bool) -> Column:
    slash = value.contains("/")
    usual = F.when(slash, F.try_to_date(value, "dd/MM/yyyy")).otherwise(
        F.try_to_date(value, "yyyy-MM-dd"))
    a, b = DATE_BASES
    bases = F.array(F.lit(a).cast("long"), F.lit(b).cast("long"))
    start = F.lit(FIRST_DAY).cast("date")

    def at(digits: Column) -> Column:
        return F.date_add(start, (F.get(digits, 0) * b + F.get(digits, 1)).cast("int"))

    def moved(day: Column, spelling: str, first: bool) -> Column:
        n = F.date_diff(day, start).cast("long")
        kind = F.lit("month first" if first else "date")
        new = permute(F.array(F.floor(n / b), n % b), bases, kind, key, back)
        if first:
            # Again until it is of the dates that cannot be read as day first either.
            new = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), new, lambda acc, _: F.when(
                F.dayofmonth(at(acc)) > 12, acc).otherwise(permute(acc, bases, kind, key, back)))
        return F.when((n >= 0) & (n < a * b), F.date_format(at(new), spelling)).otherwise(value)

    month_first = F.try_to_date(value, "MM/dd/yyyy")
    return F.when(usual.isNotNull() & slash, moved(usual, "dd/MM/yyyy", False)).when(
        usual.isNotNull(), moved(usual, "yyyy-MM-dd", False)).when(
        slash & month_first.isNotNull(), moved(month_first, "MM/dd/yyyy", True)).otherwise(value)


def _ip(value: Column, key: str, back: bool) -> Column:
    parts = _longs(F.split(value, r"\."))
    base = F.array(*[F.lit(256).cast("long")] * 4)
    new = permute(parts, base, F.lit("ip"), key, back)
    plain = ~F.exists(F.split(value, r"\."), lambda p: p.rlike("^0.")) & ~F.exists(
        parts, lambda p: p > 255)
    return F.when(plain, F.array_join(new.cast("array<string>"), ".")).otherwise(value)


def _email(value: Column, key: str, back: bool) -> Column:
    """Letters stay letters and digits digits before the @, of the same case."""
    local = F.substring_index(value, "@", 1)
    chars = F.split(local, "")

    def low(c: Column) -> Column:
        return F.when(c.rlike("^[a-z]$"), 97).when(c.rlike("^[A-Z]$"), 65).when(
            c.rlike("^[0-9]$"), 48).otherwise(F.ascii(c))

    bases = F.transform(chars, lambda c: F.when(c.rlike("^[A-Za-z]$"), 26).when(
        c.rlike("^[0-9]$"), 10).otherwise(1).cast("long"))
    new = permute(F.transform(chars, lambda c: (F.ascii(c) - low(c)).cast("long")), bases,
                  F.lit("email"), key, back)
    text = F.array_join(F.zip_with(chars, new, lambda c, v: F.chr(low(c) + v)), "")
    return F.concat(text, F.substring(value, F.length(local) + 1, F.length(value)))


def pseudonym(value: Column, key: str, back: bool = False) -> Column:
    """The pseudonym of one candidate, or the value itself if it is not valid."""
    digits = F.length(F.regexp_replace(value, r"\D", ""))
    return (F.when(value.contains("@"), _email(value, key, back))
            .when(value.rlike(DATE), _date(value, key, back))
            .when(value.rlike(f"^(?:{FORMATS['ip']})$"), _ip(value, key, back))
            .when(value.rlike(f"^(?:{FORMATS['ssn']})$"), _numbers(value, "ssn", key, back))
            .when(value.rlike(f"^(?:{FORMATS['card']})$"), _card(value, key, back))
            .when(value.rlike(f"^(?:{FORMATS['local']}|{FORMATS['phone']})$") & digits.between(9, 15),
                  _phone(value, key, back))
            .otherwise(value))


def pseudonymised(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with valid values of ``text`` replaced; all other columns stay.

    Gaps and values are taken apart by one expression and put together again, so nothing
    else of the text changes. Texts without a digit or an @ are passed through.
    """
    value = F.col(text)
    values = F.regexp_extract_all(value, F.lit(FIND), F.lit(0))
    parts = F.zip_with(F.split(value, FIND), values, lambda gap, v: F.concat(
        gap, F.coalesce(pseudonym(v, key, back), F.lit(""))))
    new = F.when(value.rlike("[0-9@]"), F.array_join(parts, "")).otherwise(value)
    return docs.withColumn(text, new)


def n_found(text: Column) -> Column:
    """How many candidates a text has."""
    return F.coalesce(F.when(text.rlike("[0-9@]"), F.regexp_count(text, F.lit(FIND))), F.lit(0))
