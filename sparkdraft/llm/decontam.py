"""Benchmark decontamination with DataFrame functions only.

Method. The n-grams of the benchmark (13 words, or the whole of a shorter item) are hashed;
the hash set is broadcast when its size is within ``BROADCAST_GRAMS``, else joined by key.
Every window of every document is looked up in one pass over the texts: first in a table of
at most ``MOST_CELLS`` cells that travels with the plan and lets a few per cent through,
then in the hash set. Each hit is verified word by word on the documents that have one.
Hit spans or whole documents go.

Words: A-Z lower-cased, then runs of ASCII letters, digits and all characters from U+0080.

Defined cases. A null text has no words. Rows with a null id are kept and judged by their
text. Repeated rows are judged alike, each returned. Items without words match nothing.
An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm.common import stored, unused

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
WINDOW = 13
#: N-grams up to this many are broadcast: 16 bytes each, so 64 MB at most.
BROADCAST_GRAMS = 1 << 20
#: One byte each; sixteen cells for each n-gram up to this many.
LEAST_CELLS, MOST_CELLS = 1 << 12, 1 << 18


def words(text: Column) -> Column:
    """The words of a text as an array."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + BETWEEN,
                        UPPER.lower() + " " * len(BETWEEN))
    return F.array_remove(F.split(plain, " "), "")


def gram_key(w: Column, first: Column, k: int) -> Column:
    """The lookup key of the ``k`` words of ``w`` from ``first``.

    It hashes four of the words, evenly spread: cheap at every window of every document.
    Different n-grams may share a key; verification compares whole n-grams.
    """
    steps = sorted({round(j * (k - 1) / 3) for j in range(4)})
    return F.xxhash64(F.lit(k), *[F.get(w, first + (step - 1)) for step in steps])


def benchmark_grams(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per distinct (item_id, n-gram): ``item``, ``k`` words, ``gram``, ``key``."""
    w = benchmark.select(F.col("item_id").alias("item"), words(F.col("text")).alias("w"))
    w = w.where("size(w) > 0").withColumn("k", F.least(F.size("w"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("i")
    key = F.lit(None).cast("long")
    for k in range(1, window + 1):
        key = F.when(F.col("k") == k, gram_key(F.col("w"), F.col("i"), k)).otherwise(key)
    return w.select("item", "k", "w", starts).select(
        "item", "k", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("gram"),
        key.alias("key")).distinct()


def _lengths(grams: DataFrame) -> list[int]:
    """The n-gram lengths that occur: at most ``window`` values."""
    return sorted(r.k for r in grams.select("k").distinct().collect())


def _bounded(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def _cells(keys: DataFrame, cells: int) -> Column:
    """A binary literal with a byte of 1 for each cell that holds a key; of bounded size."""
    full = keys.select(F.pmod("key", F.lit(cells)).alias("cell")).distinct()
    table = bytearray(cells)
    for r in full.collect():
        table[r.cell] = 1
    return F.lit(bytes(table))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its words and what was found in it.

    Columns: ``doc_id``, ``n_words``, ``spans`` (array of first word, from 1, and number of
    words; sorted) and ``items`` (array of item ids as text; sorted).
    """
    grams = stored(benchmark_grams(benchmark, window), "grams")
    lengths = _lengths(grams)
    keys = grams.select("key").distinct()
    n_keys = keys.count()
    base = docs.select("doc_id", "text").withColumn("tkey", F.xxhash64("text"))

    cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (16 * n_keys).bit_length()))
    table = _cells(keys, cells)

    def windows(k: int) -> Column:
        at = F.sequence(F.lit(1), F.size("w") - k + 1)
        maybe = F.filter(at, lambda i: F.substring(
            table, F.pmod(gram_key(F.col("w"), i, k), F.lit(cells)).cast("int") + 1, 1) == b"\1")
        found = F.transform(maybe, lambda i: F.struct(
            i.alias("first"), F.lit(k).alias("k"), gram_key(F.col("w"), i, k).alias("key")))
        return F.when(F.size("w") >= k, found).otherwise(
            F.array().cast("array<struct<first:int,k:int,key:bigint>>"))

    # One scan: the windows that may be wanted, and one row of its own for each document.
    w = base.select("doc_id", "tkey", words(F.col("text")).alias("w"))
    # Its key only spreads the own rows where the n-grams are joined by key.
    own = F.array(F.struct(F.lit(0).alias("first"), F.lit(0).alias("k"),
                           F.xxhash64("doc_id", "tkey").alias("key")))
    scanned = w.select("doc_id", "tkey", F.size("w").alias("n_words"),
                       F.inline(F.concat(own, *[windows(k) for k in lengths])))
    found = scanned.join(_bounded(keys.withColumn("wanted", F.lit(True)), n_keys, BROADCAST_GRAMS),
                         "key", "left").where("k = 0 or wanted")
    per_doc = found.groupBy("doc_id", "tkey").agg(
        F.max("n_words").alias("n_words"), F.count(F.when(F.col("k") == 0, 1)).alias("copies"),
        F.collect_set(F.when(F.col("k") > 0, F.struct("first", "k"))).alias("at"))
    per_doc = stored(per_doc, "scanned")

    # Verification: the words themselves, at the places found, in documents that have one.
    hot = per_doc.where("size(at) > 0").select(F.col("doc_id").alias("id2"),
                                               F.col("tkey").alias("tkey2"), "at")
    texts = base.join(hot, F.col("doc_id").eqNullSafe(F.col("id2"))
                      & (F.col("tkey") == F.col("tkey2")))
    texts = texts.dropDuplicates(["doc_id", "tkey"]).select(
        "doc_id", "tkey", words(F.col("text")).alias("w"), "at")
    at = texts.select("doc_id", "tkey", F.explode(F.transform("at", lambda x: F.struct(
        x["first"].alias("first"), x["k"].alias("k"),
        F.array_join(F.slice("w", x["first"], x["k"]), " ").alias("gram")))).alias("s"))
    n_grams = grams.count()
    checked = at.select("doc_id", "tkey", "s.*").join(
        _bounded(grams.select("item", "gram", "k"), n_grams, BROADCAST_GRAMS), ["gram", "k"])
    each = checked.groupBy("doc_id", "tkey").agg(
        F.array_sort(F.collect_set(F.struct("first", "k"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    each = each.withColumnsRenamed({"doc_id": "id2", "tkey": "tkey2"})
    out = per_doc.join(each, F.col("doc_id").eqNullSafe(F.col("id2"))
                       & (F.col("tkey") == F.col("tkey2")), "left")
    one = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_copy")
    return out.select(
        "doc_id", "tkey", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,k:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), one).drop("_copy")


def covered(spans: Column) -> Column:
    """How many words sorted spans cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def add(acc: Column, s: Column) -> Column:
        end = s["first"] + s["k"]
        new = F.greatest(F.lit(0), end - F.greatest(acc["end"], s["first"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"])


def verdicts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: words, hit words, items and whether the row is contaminated."""
    h = hits(docs, benchmark, window).withColumn("n_hit", covered(F.col("spans")))
    return h.select("doc_id", "tkey", "n_words", "n_hit", "items",
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
                    .alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated rows; the others stay as they are."""
    bad = verdicts(docs, benchmark, window).where("contaminated")
    one, key = unused("llm_id", docs), unused("llm_tkey", docs)
    bad = bad.select(F.col("doc_id").alias(one), F.col("tkey").alias(key)).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(one))
                     & (F.xxhash64(docs["text"]) == F.col(key)), "left_anti")


def clean_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text): hit words go, with what follows them up to the next word."""
    marks = hits(docs, benchmark, window).select(
        F.col("doc_id").alias("llm_id"), F.col("tkey").alias("llm_tkey"), "spans").distinct()
    rows = docs.select("doc_id", "text").join(
        marks, F.col("doc_id").eqNullSafe(F.col("llm_id"))
        & (F.xxhash64("text") == F.col("llm_tkey")))
    inside = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    parts = F.regexp_extract_all("text", F.lit(inside), F.lit(0))
    lead = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    kept = F.filter(parts, lambda part, i: ~F.exists(
        "spans", lambda s: (i + 1 >= s["first"]) & (i + 1 < s["first"] + s["k"])))
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(
        F.concat(lead, F.array_join(kept, "")))
    return rows.select("doc_id", text.alias("text"))
