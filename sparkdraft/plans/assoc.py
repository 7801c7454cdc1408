"""Probability-weighted positive PMI of cards that share a deck.

For every build the chance that both cards are among ``cards_seen`` drawn ones is
computed; a draft counts with its strongest build only, so deck changes between
games do not count a draft twice; the sums over drafts give p(a), p(b) and p(a,b).
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from sparkdraft.functions import prob
from sparkdraft.operators.joins import size_checked
from sparkdraft.session import work_dir

# Names that are left out, and the job's defaults.
BASIC_NAMES = ("Plains", "Island", "Swamp", "Mountain", "Forest", "Wastes")
DECK_SIZE = 40
CARDS_SEEN = 10
MIN_PAIR_PROB = 1e-5

#: Pairs of cards that one task forms of a draft at a time; drafts with more are cut into units.
UNIT_PAIRS = 1_000_000
#: Rows that a task joins or counts, and pairs that it takes the maximum of: its memory must not
#: rise with the input, so the number of tasks does.
TASK_ROWS, TASK_PAIRS = 500_000, 250_000


def tasks_for(rows: float, of_task: int) -> int:
    return max(1, math.ceil(rows / of_task))


def in_tasks(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` to that many tasks; one is left to Spark."""
    return df.repartition(tasks, *keys) if tasks > 1 else df


def eligible(cards: DataFrame, excluded: Iterable[str] = BASIC_NAMES) -> DataFrame:
    names = list(excluded)
    return cards.where(~F.col("card_name").isin(*names)) if names else cards


def item_table(deck_build_cards: DataFrame, cards: DataFrame,
               excluded: Iterable[str] = BASIC_NAMES) -> DataFrame:
    """Cards that occur in some main deck, by id (in the order the matrix uses)."""
    played = deck_build_cards.where(F.col("deck_count") > 0).select("card_id").distinct()
    return eligible(cards, excluded).select("card_id", "card_name").join(
        played, "card_id", "left_semi").orderBy("card_id")


def build_cards(deck_builds: DataFrame, deck_build_cards: DataFrame, cards: DataFrame,
                excluded: Iterable[str] = BASIC_NAMES) -> DataFrame:
    """(draft_id, build_id, card_id, deck_count) of main-deck cards that take part."""
    rows = deck_build_cards.where(F.col("deck_count") > 0).select(
        "build_id", "card_id", "deck_count")
    rows = in_tasks(rows, tasks_for(deck_build_cards.count(), TASK_ROWS), "build_id")
    return rows.join(deck_builds.select("build_id", "draft_id"), "build_id").join(
        eligible(cards, excluded).select("card_id"), "card_id", "left_semi")


def draft_work(rows: DataFrame) -> DataFrame:
    """(draft_id, pairs): the pairs of a draft are those of its builds, n (n + 1) / 2 each.

    Rows are counted per build, which combines before the shuffle.
    """
    per_build = rows.groupBy("draft_id", "build_id").agg(F.count(F.lit(1)).alias("n"))
    work = F.sum(F.col("n") * (F.col("n") + 1) / 2)
    return per_build.groupBy("draft_id").agg(work.alias("pairs"))


def wide_drafts(rows: DataFrame, unit_pairs: int = UNIT_PAIRS) -> DataFrame:
    """(draft_id, segments) of drafts with more than ``unit_pairs`` pairs of cards."""
    return _wide(draft_work(rows), unit_pairs)


def _wide(work: DataFrame, unit_pairs: int) -> DataFrame:
    """With s segments of its cards a draft's pairs fall into s (s + 1) / 2 units of about the
    same work."""
    return work.where(F.col("pairs") > unit_pairs).select(
        "draft_id", F.ceil(F.sqrt(2 * F.col("pairs") / unit_pairs)).cast("int").alias("segments"))


def units(rows: DataFrame, wide: DataFrame) -> DataFrame:
    """Rows with their unit (``low``, ``high``) and whether they are of the segment ``high``.

    Each pair of segments of a draft is a unit, which the cards of both go to; a draft of
    one segment is one unit, and its rows are not multiplied.
    """
    segments = F.coalesce("segments", F.lit(1))
    own = F.pmod(F.xxhash64("card_id"), segments).cast("int")
    sized = rows.join(size_checked(wide), "draft_id", "left").select(
        *rows.columns, segments.alias("segments"), own.alias("own"))
    others = F.sequence(F.lit(0), F.col("segments") - 1)
    return sized.select(*rows.columns, "own", F.explode(others).alias("other")).select(
        *rows.columns, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).alias("upper"))


def draft_pairs(unit_rows: DataFrame, deck_size: int, cards_seen: int, tasks: int = 1) -> DataFrame:
    """Strongest p per (draft, pair of cards); a card with itself stands for the card alone.

    One exchange by draft and unit serves cards and pairs: gathering a build's cards of a
    unit, pairing them and taking the maximum over builds all happen in it, so the pairs -
    by far the largest intermediate - never cross the network one by one. With ``tasks`` the
    exchange has that many partitions, else Spark decides.
    """
    unit = ["draft_id", "low", "high"]
    dealt = in_tasks(unit_rows, tasks, *unit) if tasks > 1 else unit_rows.repartition(*unit)
    decks = dealt.groupBy(*unit, "build_id").agg(
        F.array_sort(F.collect_list(F.struct("upper", "card_id", "deck_count"))).alias("deck"))
    firsts = decks.select(*unit, "deck", F.posexplode("deck").alias("pos", "a"))
    same = F.slice("deck", F.col("pos") + 1, F.size("deck") - F.col("pos"))
    across = F.when(~F.col("a.upper"), F.filter("deck", lambda b: b["upper"]))
    partners = F.when(F.col("low") == F.col("high"), same).otherwise(across)
    pairs = firsts.select(*unit, "a", F.explode(partners).alias("b"))
    alone = F.col("a.card_id") == F.col("b.card_id")
    p = F.when(alone, prob.p_seen(F.col("a.deck_count"), deck_size, cards_seen)).otherwise(
        prob.p_seen_together(F.col("a.deck_count"), F.col("b.deck_count"), deck_size, cards_seen))
    return pairs.groupBy(*unit, F.least("a.card_id", "b.card_id").alias("card_a_id"),
                         F.greatest("a.card_id", "b.card_id").alias("card_b_id")).agg(F.max(p).alias("p"))


def probabilities(rows: DataFrame, deck_builds: DataFrame, *, deck_size: int = DECK_SIZE,
                  cards_seen: int = CARDS_SEEN, unit_pairs: int = UNIT_PAIRS,
                  scratch: str | None = None) -> DataFrame:
    """(card_a_id, card_b_id, p): p(a, b) of each pair of cards, and p(a) where both are one.

    Probabilities are relative to all drafts that have a build, also those whose
    cards are all left out.
    """
    prob.check_sampling(deck_size, cards_seen)
    n_drafts = deck_builds.agg(F.count_distinct("draft_id").cast("double").alias("n")).scalar()
    work = draft_work(rows)
    path = scratch or work_dir(rows.sparkSession, "draft-work")
    work.write.mode("overwrite").parquet(path)  # read for the wide drafts and for the number of tasks
    work = rows.sparkSession.read.schema(work.schema).parquet(path)
    total = work.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)).cast("double").alias("n")).head()["n"]
    pairs = draft_pairs(units(rows, _wide(work, unit_pairs)), deck_size, cards_seen,
                        tasks_for(total, TASK_PAIRS))
    return pairs.groupBy("card_a_id", "card_b_id").agg(F.sum("p").alias("s")).select(
        "card_a_id", "card_b_id", (F.col("s") / n_drafts).alias("p"))


def pmi_pairs(deck_builds: DataFrame, deck_build_cards: DataFrame, cards: DataFrame, *,
              excluded: Iterable[str] = BASIC_NAMES, min_pair_prob: float = MIN_PAIR_PROB,
              scratch: str | None = None, **sampling: int) -> DataFrame:
    """p_ab, p_a, p_b and PMI of every pair above the probability threshold.

    The probabilities, one row a pair, are written to ``scratch`` and read from there as pairs
    and as single cards: the decks are paired once.
    """
    rows = build_cards(deck_builds, deck_build_cards, cards, excluded)
    found = probabilities(rows, deck_builds, scratch=scratch and f"{scratch}-drafts", **sampling)
    path = scratch or work_dir(rows.sparkSession, "pair-probabilities")
    found.write.mode("overwrite").parquet(path)
    found = rows.sparkSession.read.schema(found.schema).parquet(path)
    alone = found.where((F.col("card_a_id") == F.col("card_b_id")) & (F.col("p") > 0))
    as_a = alone.select("card_a_id", F.col("p").alias("p_a"))
    as_b = alone.select("card_b_id", F.col("p").alias("p_b"))
    return (
        found.where((F.col("card_a_id") != F.col("card_b_id")) & (F.col("p") > min_pair_prob))
        .withColumnRenamed("p", "p_ab").join(as_a, "card_a_id").join(as_b, "card_b_id")
        .select("card_a_id", "card_b_id", "p_ab", "p_a", "p_b",
                prob.pmi(F.col("p_ab"), F.col("p_a"), F.col("p_b")).alias("pmi"))
    )


def ppmi_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with a finite, positive PMI."""
    value = F.col("ppmi")
    return pairs.withColumn("ppmi", prob.ppmi(F.col("pmi"))).where(
        value.isNotNull() & ~F.isnan(value) & (value < float("inf")) & (value > 0))
