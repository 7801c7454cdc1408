"""Tolerant parsers for text cells.

Every parser is one column expression. Where a malformed cell must be reported
rather than nulled, a ``bad_*`` predicate sits beside the parser, so a job can
route the row to its rejects while the good rows pass. ANSI mode stays on; all
conversions go through ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Spellings the sources use.
NULL_WORDS = ("nan", "none", "<na>")
TRUE_WORDS = ("true", "t", "1", "yes")
FALSE_WORDS = ("false", "f", "0", "no")
ZERO_CELLS = ("", "0", "0.0")

SMALLINT_MAX = 32767

# Blank characters at either end of a cell, as a text strip would remove them.
_BLANKS = " \t\r\n\x0b\x0c"


def strip(x: Column) -> Column:
    """Without blanks at both ends. Two comparisons decide whether there are any:
    every blank sorts before ``!``."""
    return F.when((x < "!") | (F.substring(x, -1, 1) < "!"), F.trim(x, F.lit(_BLANKS))).otherwise(x)


def is_missing(x: Column) -> Column:
    """NULL or only blanks."""
    return x.isNull() | (strip(x) == "")


def is_missing_number(x: Column) -> Column:
    """NULL or NaN, for a column that is a double already."""
    return x.isNull() | F.isnan(x)


def text_or_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def card_name(x: Column) -> Column:
    return strip(x)


def number_or_null(x: Column) -> Column:
    """Double, or NULL for blank, unparseable and NaN cells.

    Number casts skip blanks at both ends themselves. The empty cell, by far the
    most frequent malformed one, is kept from the cast, where it would cost an
    exception. A trailing ``d``/``f`` is Java's way to write a number, not the
    source's, and counts as unparseable.
    """
    java_suffix = F.substring(x, -1, 1).isin("d", "D", "f", "F") & x.rlike(r"[0-9.][dDfF]$")
    return F.when((x != "") & ~java_suffix,
                  F.nanvl(x.try_cast("double"), F.lit(None).cast("double")))


def _whole(x: Column) -> Column:
    """The cell is written as a plain whole number that fits 64 bits."""
    return x.rlike(r"^\s*[+-]?[0-9]{1,18}\s*$")


def integer_or_null(x: Column) -> Column:
    """Whole number, NULL for blank or unparseable cells; see `bad_integer`.

    A failing cast of text costs an exception, so plain numbers are recognised
    first and everything else goes through double.
    """
    d = number_or_null(x)
    return F.when(_whole(x), x.cast("bigint")).when(d == F.floor(d), d.try_cast("bigint"))


def bad_integer(x: Column) -> Column:
    """A numeric cell that is not a whole number that fits 64 bits."""
    d = number_or_null(x)
    big = F.abs(d) >= 2.0**63
    return F.coalesce(~_whole(x) & ((d != F.floor(d)) | big), F.lit(False))


def bad_small(x: Column) -> Column:
    """A numeric cell that is not a whole number of 16 bits: narrowing would lose it."""
    d = number_or_null(x)
    return F.coalesce((d != F.floor(d)) | ~d.between(-2**15, 2**15 - 1), F.lit(False))


def key_integer(x: Column) -> Column:
    """Integer part of a key cell; fractions are cut off. NULL means malformed."""
    return F.when(_whole(x), x.cast("bigint")).otherwise(number_or_null(x).try_cast("bigint"))


def bad_key(x: Column) -> Column:
    """A key cell without a number."""
    return key_integer(x).isNull()


def count_or_zero(x: Column) -> Column:
    """Count cell as int: blank, null words and unparseable text give 0."""
    return F.coalesce(key_integer(x).try_cast("int"), F.lit(0))


def bad_count(x: Column) -> Column:
    """A count cell that holds no number, is not finite or exceeds a smallint."""
    cell = F.lower(strip(x))
    d = number_or_null(x)
    blank = x.isNull() | (cell == "") | cell.isin(*NULL_WORDS)
    return ~blank & (d.isNull() | (F.abs(d) >= SMALLINT_MAX + 1))


def bool_or_null(x: Column) -> Column:
    word = F.lower(strip(x))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def bad_bool(x: Column) -> Column:
    return ~is_missing(x) & bool_or_null(x).isNull()


def timestamp_or_null(x: Column) -> Column:
    return strip(x).try_cast("timestamp_ntz")


def bad_time(x: Column) -> Column:
    """A cell that holds something, but no time in ISO spelling."""
    return ~is_missing(x) & timestamp_or_null(x).isNull()


def id_tokens(x: Column) -> Column:
    """``a|b|c`` as an array of trimmed, non-empty tokens; never NULL.

    The clean spelling takes a plain split; only cells with blanks pay for a
    (once compiled) regular expression. All parts stay inside generated code.
    """
    empty = F.array().cast("array<string>")
    cell = strip(x)
    blanks = (F.instr(x, " ") > 0) | (F.instr(x, "\t") > 0)
    tight = F.when(blanks, F.regexp_replace(cell, r"\s*\|\s*", "|")).otherwise(x)
    usable = (F.instr(x, "|") > 0) | ~F.lower(cell).isin(*NULL_WORDS)
    return F.coalesce(F.when(usable, F.array_remove(F.split(tight, r"\|"), "")), empty)


def id_or_null(token: Column) -> Column:
    """Id token: whole number, otherwise the integer part of a decimal number."""
    return key_integer(token)


def is_meaningful(x: Column, wide: bool = False) -> Column:
    """False for NULL and for the exact cells '', '0' and '0.0'.

    ``wide`` also ignores case and surrounding blanks and drops the null words.
    """
    if wide:
        word = F.lower(strip(x))
        return x.isNotNull() & ~word.isin(*ZERO_CELLS, *NULL_WORDS)
    return x.isNotNull() & ~x.isin(*ZERO_CELLS)


def values_equal(a: Column, b: Column, kind: str = "exact") -> Column:
    """Null-safe equality; ``kind='float'`` allows float32 rounding."""
    if kind != "float":
        return a.eqNullSafe(b)
    close = F.abs(a - b) <= F.lit(1e-7) + F.lit(1e-6) * F.abs(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(close | (a == b))


def canonical_json(columns: Mapping[str, Column]) -> Column:
    """One JSON object with sorted field names; missing cells become null."""
    fields = [
        F.when(~is_missing(col.cast("string")), col).alias(name)
        for name, col in sorted(columns.items())
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
