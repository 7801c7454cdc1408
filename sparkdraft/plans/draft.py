"""Tables from the pick source: drafts, draft_picks, draft_pick_cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkdraft.functions import clean, keys
from sparkdraft.operators import checks, ordering, reshape
from sparkdraft.operators.joins import only_absent, size_checked
from sparkdraft.plans.quarantine import TIME, CellCheck
from sparkdraft.sources.layout import PICK_KINDS, Layout
from sparkdraft.sources.text import ORDER_COLUMNS, WideSource, source_order, with_line_rank

METADATA = {
    "expansion": "string", "event_type": "string", "draft_time": "timestamp_ntz",
    "rank": "string", "event_match_wins": "smallint", "event_match_losses": "smallint",
    "user_n_games_bucket": "smallint", "user_game_win_rate_bucket": "float",
}
INTEGER_METADATA = ("event_match_wins", "event_match_losses", "user_n_games_bucket")


def draft_index(game_lines: DataFrame) -> DataFrame:
    """Per draft of the game source: where it is first seen and its game count."""
    return game_lines.groupBy("draft_id").agg(
        F.min(source_order()).alias("first_seen"), F.count(F.lit(1)).alias("expected_games"))


def numbered_index(index: DataFrame, game_lines: DataFrame) -> DataFrame:
    """The index with 0-based first-seen numbers."""
    flat = index.select("draft_id", "expected_games", *[
        F.col(f"first_seen.{c}").alias(c) for c in ORDER_COLUMNS])
    ranked = with_line_rank(flat, game_lines)
    return ordering.dense_index(ranked, ["line_rank"], "draft_index").select(
        "draft_id", "draft_index", "expected_games")


def orphan_drafts(picks: WideSource, index: DataFrame) -> DataFrame:
    """Draft ids of the pick source that have no game."""
    return only_absent(picks.lines.select("draft_id").distinct(), index, "draft_id")


def only_targets(picks: WideSource, orphans: DataFrame) -> WideSource:
    """Pick lines of drafts that have games.

    Nearly every draft has games, so the wide lines are not shuffled to meet the
    index: the few ids *without* games are found from the narrow id column and
    removed with a join that broadcasts them when their number is small.
    """
    return picks.with_lines(only_absent(picks.lines, size_checked(orphans), "draft_id"))


def _metadata(picks: WideSource) -> DataFrame:
    raw = picks.named(*METADATA)
    parsed = []
    for name, dtype in METADATA.items():
        cell = F.col(name)
        if dtype == "string":
            value = clean.text_or_null(cell)
        elif dtype == "timestamp_ntz":
            value = clean.timestamp_or_null(cell)
        elif dtype == "smallint":
            value = clean.integer_or_null(cell).try_cast("smallint")
        else:
            value = clean.number_or_null(cell)
        parsed.append(value.alias(name))
    return raw.select(*ORDER_COLUMNS, "draft_id", *parsed)


def drafts(picks: WideSource) -> DataFrame:
    """Metadata of each draft, from its first pick row."""
    first = ordering.first_per_key(_metadata(picks), ["draft_id"], list(METADATA), source_order())
    return first.select("draft_id", *[F.col(c).cast(t).alias(c) for c, t in METADATA.items()])


def draft_conflicts(picks: WideSource) -> DataFrame:
    """Drafts whose pick rows disagree on metadata."""
    approx = ["user_game_win_rate_bucket"]
    exact = [c for c in METADATA if c not in approx]
    return checks.metadata_conflicts(_metadata(picks), ["draft_id"], exact, approx, source_order())


def draft_picks(picks: WideSource) -> DataFrame:
    """One row per pick. The card key is computed from the name, so no join is
    needed; `unknown_picked_cards` finds names that are not canonical cards."""
    rows = picks.named("pack_number", "pick_number", "pick", "pick_maindeck_rate",
                       "pick_sideboard_in_rate")
    return rows.select(
        F.col("row_id").alias("pick_id"), "draft_id",
        clean.key_integer(F.col("pack_number")).try_cast("smallint").alias("pack_number"),
        clean.key_integer(F.col("pick_number")).try_cast("smallint").alias("pick_number"),
        keys.card_key(F.col("pick")).alias("card_id"),
        clean.number_or_null(F.col("pick_maindeck_rate")).cast("float").alias("pick_maindeck_rate"),
        clean.number_or_null(F.col("pick_sideboard_in_rate")).cast("float")
        .alias("pick_sideboard_in_rate"))


def draft_pick_cards(picks: WideSource) -> DataFrame:
    """Offered and owned cards of each pick, sparse, one row per (pick, card)."""
    melted = reshape.melt_counts(
        picks.cells(), picks.layout.count_columns(PICK_KINDS), ["pack", "pool"], ["row_id"])
    return melted.select(F.col("row_id").alias("pick_id"), "card_id",
                         F.col("pack").try_cast("smallint").alias("pack_count"),
                         F.col("pool").try_cast("smallint").alias("pool_count"))


def pick_checks(layout: Layout) -> list[CellCheck]:
    """What makes a cell of a pick line malformed, beside its counts."""
    return [CellCheck("draft_id", clean.is_missing, "blank", key=True),
            *[CellCheck(c, clean.bad_key, "no number", key=True)
              for c in ("pack_number", "pick_number")],
            *[CellCheck(c, clean.bad_small, "no small whole number") for c in INTEGER_METADATA],
            CellCheck("draft_time", clean.bad_time, TIME)]


def unknown_picked_cards(draft_picks: DataFrame, cards: DataFrame) -> DataFrame:
    return checks.missing_parents(draft_picks, ["card_id"], cards, ["card_id"])


def picks_not_offered(draft_picks: DataFrame, draft_pick_cards: DataFrame) -> DataFrame:
    """Picks whose card is not in the offered pack."""
    offered = draft_pick_cards.where(F.col("pack_count") > 0).select("pick_id", "card_id")
    return draft_picks.select("pick_id", "card_id").join(offered, ["pick_id", "card_id"], "left_anti")
