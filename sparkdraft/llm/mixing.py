"""Mixing sources to target weights: whole documents whose words add up to each source's target.

The weights 5, 2, 1 repeat over the sources in the order of their names. A source's target stops
at twice its words, and what is cut off goes to the others by weight, until nothing is above.
Where a target reaches a source's words, every document is taken once, and the budget that is
left is filled with second copies; else the budget is filled with first copies. The budget is
fitted on the counts of documents of each exact length: an even share of all lengths comes
first, and a bounded knapsack over the lengths that are left closes the gap. Which documents of
a length are taken follows from a seeded hash of ``doc_id``.

Of a corpus only counts by source and length meet in one task: the lengths of a source with W words
number less than sqrt(2 W) + 1, whatever the number of its documents. Documents are numbered by
a range sort, so a source or a length may hold any share of the rows.

Defined cases: a null or empty text has size 0 and is taken 0 words. A null source is a source
of its own and the last. A source without words has target 0. A null ``doc_id`` has a hash like
any id; rows of one id and one length are taken in any order, which gives the same rows. Other
columns are ignored, whatever their names. Texts are counted whole. An empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm.common import stored
from sparkdraft.llm.numbering import in_runs, numbered

WEIGHTS = (5, 2, 1)
#: The mix holds this share of all words; no document more often than COPIES.
SHARE = 1.5
COPIES = 2
SEED = 20240229
#: Words of the largest gap that the knapsack closes; larger gaps take long documents first.
KNAPSACK_WORDS = 1 << 16
GOLDEN = (5 ** 0.5 - 1) / 2


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """(src, source_size, target) of sources (src, source_size), whose names sort as ``src``.

    A round gives every source its share of what the capped ones leave; those above their cap
    join these. Each round is one sum over the sources, and only the sums reach the driver.
    """
    rows = numbered(sources.withColumn("one", F.lit(0)), ["one"], ["src"])
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("llm_i") % len(WEIGHTS) + 1).cast("int"))
    rows = rows.select("src", "source_size", weight.alias("w"),
                       (COPIES * F.col("source_size")).alias("cap"))
    words = rows.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while True:
        over = F.col("w") * F.lit(level) > F.col("cap")
        n, caps, open_weight = rows.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0))).first()
        if n == before or not open_weight:
            break
        level, before = (SHARE * words - caps) / open_weight, n
    return rows.select("src", "source_size", F.least(
        F.col("w") * F.lit(level), F.col("cap").cast("double")).alias("target"))


def knapsack(sizes: np.ndarray, counts: np.ndarray, goal: int) -> np.ndarray:
    """How many of each size to take so that their sum is as near to ``goal`` as it can be.

    ``sizes`` are positive and differ; at most ``counts`` of each. Every sum up to twice
    the goal keeps the piece that first reached it: pieces of 1, 2, 4, .. copies, so that a piece
    builds on earlier ones only. Memory grows with the goal alone.
    """
    taken = np.zeros(len(sizes), dtype=np.int64)
    live = np.flatnonzero(counts)
    if goal <= 0 or not len(live):
        return taken
    top = 2 * int(goal)  # beyond that, nothing at all is nearer
    first = np.full(top + 1, -1, dtype=np.int64)
    first[0] = 0
    pieces = [(-1, 0, 0)]
    for k in live[np.argsort(-sizes[live], kind="stable")]:
        left, copies = min(int(counts[k]), top // int(sizes[k])), 1
        while left > 0 and first[goal] < 0:
            copies = min(copies, left)
            step = copies * int(sizes[k])
            new = (first[:-step] >= 0) & (first[step:] < 0)
            first[step:][new] = len(pieces)
            pieces.append((k, copies, step))
            left, copies = left - copies, 2 * copies
    reached = np.flatnonzero(first >= 0)
    at = int(reached[np.argmin(np.abs(reached - goal))])
    while at:
        k, copies, step = pieces[first[at]]
        taken[k] += copies
        at -= step
    return taken


def _gap_closed(sizes: np.ndarray, counts: np.ndarray, gap: int) -> np.ndarray:
    """How many of each size to take for a gap: the longest that fit while it is large, then
    the knapsack."""
    taken = np.zeros(len(sizes), dtype=np.int64)
    for k in np.flatnonzero(counts)[::-1]:
        if gap <= KNAPSACK_WORDS:
            break
        taken[k] = min(int(counts[k]), gap // int(sizes[k]))
        gap -= int(taken[k] * sizes[k])
    return taken + knapsack(sizes, counts - taken, gap) if gap <= KNAPSACK_WORDS else taken


def fitted(sizes: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each size to take for a budget of words.

    ``sizes`` rise. Documents in order of length are taken at even steps, as many as the
    budget's share of all; the longest of them go while they exceed it, and a few of all
    lengths to leave the knapsack room. The gap is closed from what is not taken. Where that leaves a gap still, one document more is tried
    against others that make room for it.
    """
    whole = int(np.sum(sizes * counts))
    goal = min(int(round(budget)), whole)
    if goal == whole:
        return counts.copy()
    upto = np.floor(np.cumsum(counts) * (goal / whole)).astype(np.int64)
    taken = np.diff(upto, prepend=0)
    gap = goal - int(np.sum(sizes * taken))
    for k in np.flatnonzero(taken)[::-1]:
        if gap >= 0:
            break
        out = min(int(taken[k]), -(gap // int(sizes[k])))
        taken[k] -= out
        gap += out * int(sizes[k])
    room = min(KNAPSACK_WORDS // 2, 4 * int(sizes[-1]))
    held = np.flatnonzero(taken)
    for k in held[np.argsort(np.arange(len(held)) * GOLDEN % 1)]:  # lengths from all over
        out = min(int(taken[k]), max(0, room - gap) // (8 * int(sizes[k])) + 1)
        if gap < room and gap + out * int(sizes[k]) <= KNAPSACK_WORDS:
            taken[k] -= out
            gap += out * int(sizes[k])
    taken = taken + _gap_closed(sizes, counts - taken, gap)
    gap = goal - int(np.sum(sizes * taken))
    rest = np.flatnonzero(counts > taken)
    if gap and len(rest):
        other = taken.copy()
        other[rest[0]] += 1
        other -= _gap_closed(sizes, other, int(sizes[rest[0]]) - gap)
        if abs(goal - int(np.sum(sizes * other))) < abs(gap):
            return other
    return taken


def _quotas(key: tuple, lengths: pd.DataFrame) -> pd.DataFrame:
    """Per length of one source, the documents that get the extra copy."""
    lengths = lengths.sort_values("size")
    all_once = lengths.target.iloc[0] >= lengths.source_size.iloc[0]
    budget = lengths.target.iloc[0] - (lengths.source_size.iloc[0] if all_once else 0)
    extra = fitted(lengths["size"].to_numpy(), lengths.n.to_numpy(), budget)
    return pd.DataFrame({"src": lengths.src, "size": lengths["size"], "base": int(all_once),
                         "extra": extra})


def mixed(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    slim = stored(documents.select(
        "doc_id", F.coalesce(F.concat(F.lit("-"), F.col("source").cast("string")), F.lit("~"))
        .alias("src"), size(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id").alias("draw")), "mix-sizes")
    goals = stored(targets(slim.groupBy("src").agg(F.sum("size").alias("source_size"))), "mix-targets")
    rows, runs = in_runs(slim, ["src", "size"], ["draw", "doc_id"])
    lengths = runs.groupBy("src", "size").agg(F.sum("llm_rows").alias("n"))
    positive = lengths.where("size > 0").join(goals, "src")
    quotas = positive.groupBy("src").applyInPandas(
        _quotas, "src string, size long, base int, extra long")
    plan = runs.join(goals, "src").join(stored(quotas, "mix-quotas"), ["src", "size"], "left")
    at = F.col("llm_before") + F.col("llm_at") - F.col("llm_first")
    copies = F.col("base") + (at < F.col("extra")).cast("int")
    return rows.join(plan.drop("llm_rows", "llm_total"), ["src", "size", "llm_part"]).select(
        "doc_id", "size", "source_size", "target",
        F.coalesce(copies * F.col("size"), F.lit(0)).cast("long").alias("taken"))
