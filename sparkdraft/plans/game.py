"""Tables from the game source: games, players, card stats, deck builds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkdraft.functions import clean, keys
from sparkdraft.operators import checks, ordering, reshape
from sparkdraft.sources.layout import GAME_KINDS, CountColumn, Layout, sql_literal
from sparkdraft.plans.quarantine import TIME, CellCheck
from sparkdraft.sources.text import ORDER_COLUMNS, WideSource, cell_at, source_order

STATS = ("opening_hand", "drawn", "tutored")
DECK = ("deck", "sideboard")
INTEGERS = ("match_number", "game_number", "build_index", "num_turns", "num_mulligans",
            "opp_num_mulligans")
FLAGS = ("on_play", "won")
# Fields that the game and the replay source must agree on.
SHARED_FIELDS = ("on_play", "won", "num_turns", "num_mulligans", "opp_num_mulligans")


def keyed_cells(source: WideSource, last: int = -1) -> DataFrame:
    """game_id, draft_id, order and the cells of a game or replay source."""
    return source.cells(last).withColumnRenamed("row_id", "game_id")


def game_rows(source: WideSource) -> DataFrame:
    """One parsed row per game, without the card columns."""
    raw = source.named("match_number", "game_number", "build_index", "game_time", "rank",
                       "opp_rank", "main_colors", "splash_colors", "opp_colors", *FLAGS,
                       "num_turns", "num_mulligans", "opp_num_mulligans")
    parsed = {c: clean.integer_or_null(F.col(c)).try_cast("smallint") for c in INTEGERS}
    parsed |= {c: clean.bool_or_null(F.col(c)) for c in FLAGS}
    parsed |= {c: clean.text_or_null(F.col(c)) for c in
               ("rank", "opp_rank", "main_colors", "splash_colors", "opp_colors")}
    parsed["game_time"] = clean.timestamp_or_null(F.col("game_time"))
    return raw.withColumns(parsed).withColumnRenamed("row_id", "game_id").withColumn(
        "build_id", keys.build_key(F.col("draft_id"), F.col("build_index")))


def games(rows: DataFrame, has_build_columns: bool = True) -> DataFrame:
    build = F.col("build_id") if has_build_columns else F.lit(None).cast("bigint")
    return rows.select(
        "game_id", "draft_id", build.alias("build_id"),
        "match_number", "game_number", "game_time",
        F.col("on_play").alias("user_on_play"), F.col("won").alias("user_won"),
        F.col("num_turns").alias("source_num_turns"))


def game_players(rows: DataFrame, replay_rows: DataFrame | None = None) -> DataFrame:
    """User and opponent row per game; the user's buckets come from the replay.

    The replay is joined once per game, before the fan-out doubles the rows.
    """
    if replay_rows is not None:
        buckets = replay_rows.select("game_id", "user_n_games_bucket", "user_game_win_rate_bucket")
        rows = rows.join(buckets, "game_id", "left")
    else:
        rows = rows.withColumns({"user_n_games_bucket": F.lit(None).cast("smallint"),
                                 "user_game_win_rate_bucket": F.lit(None).cast("float")})
    none = F.lit(None)
    return reshape.two_sided(rows, ["game_id"], {
        "rank": F.col("rank"), "main_colors": F.col("main_colors"),
        "splash_colors": F.col("splash_colors"), "observed_colors": none.cast("string"),
        "num_mulligans": F.col("num_mulligans"), "n_games_bucket": F.col("user_n_games_bucket"),
        "game_win_rate_bucket": F.col("user_game_win_rate_bucket"),
    }, {
        "rank": F.col("opp_rank"), "main_colors": none.cast("string"),
        "splash_colors": none.cast("string"), "observed_colors": F.col("opp_colors"),
        "num_mulligans": F.col("opp_num_mulligans"), "n_games_bucket": none.cast("smallint"),
        "game_win_rate_bucket": none.cast("float"),
    })


def game_card_stats(source: WideSource) -> DataFrame:
    melted = reshape.melt_counts(keyed_cells(source), source.layout.count_columns(GAME_KINDS),
                                 list(STATS), ["game_id"])
    return melted.select("game_id", "card_id", *[
        F.col(s).try_cast("smallint").alias(f"{s}_count") for s in STATS])


def composition(columns: list[CountColumn]) -> Column:
    """A game's deck as array<struct<card_id, deck, sideboard>> of nonzero cards."""
    by_card: dict[str, dict[str, list[int]]] = {}
    for c in columns:
        if c.kind in DECK:
            by_card.setdefault(c.card_name, {k: [] for k in DECK})[c.kind].append(c.position)
    entries = ", ".join(
        f"named_struct('card_id', {keys.card_key_sql(sql_literal(name))}, "
        + ", ".join(f"'{k}', cast(array({', '.join(map(str, p[k]))}) as array<int>)" for k in DECK)
        + ")"
        for name, p in by_card.items())
    positions = F.expr(f"array({entries})")
    # Few of the cells are not zero: one flat look at all of them finds those, in the cards' order.
    flat = ", ".join(f"named_struct('card', {i}, 'position', {at})"
                     for i, p in enumerate(by_card.values()) for k in DECK for at in p[k])

    def live(entry: Column) -> Column:
        cell = cell_at(entry["position"])
        return (cell != "0") & ~cell.isin(*clean.ZERO_CELLS)

    def count(s: Column, kind: str) -> Column:
        values = F.filter(F.transform(s[kind], lambda p: F.when(cell_at(p) == "0", 0).otherwise(
            clean.count_or_zero(cell_at(p)))), lambda v: v != 0)
        return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(0))

    touched = F.transform(F.array_distinct(F.filter(F.expr(f"array({flat})"), live)["card"]),
                          lambda i: F.get(positions, i))
    counted = F.transform(touched, lambda s: F.struct(
        s["card_id"].alias("card_id"), count(s, "deck").alias("deck"),
        count(s, "sideboard").alias("sideboard")))
    return F.filter(counted, lambda s: (s["deck"] != 0) | (s["sideboard"] != 0))


def build_compositions(source: WideSource) -> DataFrame:
    """First composition per (draft, build index) and whether later games differ.

    A game's deck is compacted inside its row, so what is aggregated is one short
    array per game; games of one build combine before the shuffle.
    """
    columns = source.layout.count_columns(GAME_KINDS)
    rows = source.cells().select(
        *ORDER_COLUMNS, "draft_id",
        clean.integer_or_null(F.col("named.build_index")).alias("build_index"),
        composition(columns).alias("composition"),
    ).where(F.col("build_index").isNotNull())
    digest = F.xxhash64("composition")
    return rows.groupBy("draft_id", "build_index").agg(
        F.min_by("composition", source_order()).alias("composition"),
        (F.min(digest) != F.max(digest)).alias("drifted"),
    ).withColumn("build_id", keys.build_key(F.col("draft_id"), F.col("build_index")))


def deck_builds(compositions: DataFrame) -> DataFrame:
    return compositions.select("build_id", "draft_id",
                               F.col("build_index").try_cast("smallint").alias("build_index"))


def deck_build_cards(compositions: DataFrame) -> DataFrame:
    cards = compositions.select("build_id", F.inline_outer("composition")).where("card_id is not null")
    return cards.select(
        "build_id", "card_id", F.col("deck").try_cast("smallint").alias("deck_count"),
        F.col("sideboard").try_cast("smallint").alias("sideboard_count"))


def build_drift(compositions: DataFrame) -> DataFrame:
    """Builds that some later game shows with another composition."""
    return compositions.where("drifted").select("build_id", "draft_id", "build_index")


def draft_metadata(source: WideSource) -> DataFrame:
    """Draft metadata as the game source states it (first row per draft)."""
    rows = _draft_metadata_rows(source)
    return ordering.first_per_key(rows, ["draft_id"], ["expansion", "event_type", "draft_time"],
                                  source_order())


def _draft_metadata_rows(source: WideSource) -> DataFrame:
    return source.named("expansion", "event_type", "draft_time").withColumns({
        "expansion": clean.text_or_null(F.col("expansion")),
        "event_type": clean.text_or_null(F.col("event_type")),
        "draft_time": clean.timestamp_or_null(F.col("draft_time"))})


def draft_metadata_conflicts(source: WideSource) -> DataFrame:
    return checks.metadata_conflicts(_draft_metadata_rows(source), ["draft_id"],
                                     ["expansion", "event_type", "draft_time"])


def game_checks(layout: Layout) -> list[CellCheck]:
    """What makes a cell of a game line malformed, beside its counts."""
    return [*[CellCheck(c, clean.bad_small, "no small whole number") for c in INTEGERS],
            *[CellCheck(c, clean.bad_bool, "no truth value") for c in FLAGS],
            *[CellCheck(c, clean.bad_time, TIME) for c in ("draft_time", "game_time")]]
