"""Tables from the replay source: turns, events, hands, state, zones, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkdraft.functions import clean, keys
from sparkdraft.operators import reshape
from sparkdraft.operators.joins import skew_safe_lookup
from sparkdraft.plans.game import FLAGS, SHARED_FIELDS, keyed_cells
from sparkdraft.plans.quarantine import CellCheck
from sparkdraft.plans.rules import SIDES, TOTALS, ZONES, event_rule
from sparkdraft.sources.layout import Layout
from sparkdraft.sources.text import WideSource, cell_at

HAND_SIZE = 7


def _sql(value: object, sql_type: str) -> str:
    if value is None:
        return f"cast(null as {sql_type})"
    if isinstance(value, bool):
        return str(value).lower()
    return f"'{value}'" if isinstance(value, str) else f"cast({value} as {sql_type})"


def replay_rows(source: WideSource) -> DataFrame:
    """One parsed row per replayed game: shared fields and the user's buckets."""
    raw = source.named(*SHARED_FIELDS, "user_n_games_bucket", "user_game_win_rate_bucket")
    parsed = {c: clean.bool_or_null(F.col(c)) if c in FLAGS
              else clean.integer_or_null(F.col(c)).try_cast("smallint") for c in SHARED_FIELDS}
    return raw.withColumnRenamed("row_id", "game_id").withColumns({
        **parsed,
        "user_n_games_bucket": clean.integer_or_null(F.col("user_n_games_bucket"))
        .try_cast("smallint"),
        "user_game_win_rate_bucket": clean.number_or_null(F.col("user_game_win_rate_bucket"))
        .cast("float"),
    })


def replay_mismatches(replays: DataFrame, games: DataFrame,
                      present: list[str] | None = None) -> DataFrame:
    """Replays without a game, and replays that disagree with their game.

    Both inputs are parsed rows keyed by game_id; only fields that the replay source
    has are compared, null-safe.
    """
    fields = [f for f in SHARED_FIELDS if present is None or f in present]
    pairs = replays.select("game_id", F.struct(*SHARED_FIELDS).alias("r")).join(
        games.select("game_id", F.struct(*SHARED_FIELDS).alias("g")), "game_id", "left")
    names = [F.when(~F.col(f"r.{f}").eqNullSafe(F.col(f"g.{f}")), F.lit(f)) for f in fields]
    differing = F.when(F.col("g").isNull(), F.lit("no game")).otherwise(F.concat_ws(",", *names))
    return pairs.select("game_id", differing.alias("differing")).where(F.col("differing") != "")


# --- turns, player state, zones -------------------------------------------

def _turn_spec(source: WideSource) -> str:
    """Literal array with one struct per (side, turn): its column positions."""
    turns: dict[tuple[str, int], dict[str, int]] = {}
    for c in source.layout.turn_columns():
        turns.setdefault((c.side, c.turn_index), {})[c.suffix] = c.position
    fixed = [f"eot_{p}_{m}" for p in SIDES for m in ("life", "poison_counters", "cards_in_hand")]
    fixed += [f"{p}_mana_spent" for p in SIDES]
    fixed += [z for z in ZONES if z not in fixed]
    entries = []
    for (side, index), columns in sorted(turns.items()):
        parts = [f"'side', '{side}'", f"'turn_index', {index}",
                 f"'all', array({', '.join(map(str, columns.values()))})"]
        parts += [f"'{f}', {_sql(columns.get(f), 'int')}" for f in fixed]
        entries.append(f"named_struct({', '.join(parts)})")
    return f"array({', '.join(entries)})"


def turn_rows(source: WideSource) -> DataFrame:
    """Active turns with their end-of-turn cells.

    A turn is active if any of its columns is meaningful. This one narrow frame
    serves turns, player state and zones; the turn key is hashed once per turn.
    """
    one = keyed_cells(source).select("game_id", "cells", F.expr(
        f"explode({_turn_spec(source)})").alias("t"))
    active = F.exists("t.all", lambda p: F.coalesce(
        clean.is_meaningful(cell_at(p)), F.lit(False)))

    def cell(suffix: str) -> Column:
        return cell_at(F.col(f"t.{suffix}"))

    state = {f"{p}_{m}": cell(f"eot_{p}_{m}") for p in SIDES
             for m in ("life", "poison_counters", "cards_in_hand")}
    state |= {f"{p}_mana_spent": cell(f"{p}_mana_spent") for p in SIDES}
    zones = F.array(*[F.struct(F.lit(owner).alias("owner_is_user"), F.lit(zone).alias("zone"),
                               cell(suffix).alias("ids"))
                      for suffix, (owner, zone) in ZONES.items()])
    return one.where(active).select(
        keys.turn_key(F.col("game_id"), F.col("t.side"), F.col("t.turn_index")).alias("turn_id"),
        "game_id", (F.col("t.side") == "user").alias("is_user_turn"),
        F.col("t.turn_index").cast("smallint").alias("source_turn_index"),
        *[c.alias(n) for n, c in state.items()], zones.alias("zones"))


def turns(rows: DataFrame) -> DataFrame:
    return rows.select("turn_id", "game_id", "is_user_turn", "source_turn_index")


def turn_player_state(rows: DataFrame) -> DataFrame:
    """Both players' state per active turn; dropped where nothing is known."""
    def number(name: str) -> Column:
        return clean.number_or_null(F.col(name)).cast("float")

    hand = F.col("user_cards_in_hand")
    sizes = {
        "user": F.when(~clean.is_missing(hand), F.size(clean.id_tokens(hand))).cast("smallint"),
        "oppo": clean.integer_or_null(F.col("oppo_cards_in_hand")).try_cast("smallint"),
    }
    side = {p: {"life": number(f"{p}_life"), "poison_counters": number(f"{p}_poison_counters"),
                "hand_size": sizes[p], "mana_spent": number(f"{p}_mana_spent")} for p in SIDES}
    both = reshape.two_sided(rows, ["turn_id"], side["user"], side["oppo"], "player_is_user")
    return both.where(F.coalesce(
        F.col("life").cast("double"), F.col("poison_counters").cast("double"),
        F.col("hand_size").cast("double"), F.col("mana_spent").cast("double")).isNotNull())


def turn_zone_cards(rows: DataFrame, arena: DataFrame) -> DataFrame:
    """Card quantities per zone; ids are counted inside their cell."""
    # The outer forms, here and below: of the others Spark infers a filter of the whole array,
    # which moves down to the lines and parses every one of them once more.
    listed = rows.select("turn_id", F.explode_outer("zones").alias("z")).where(
        ~clean.is_missing(F.col("z.ids")))
    # A malformed id stays visible as a NULL key, which the checks reject.
    unknown = F.lit(-(2**63))
    ids = F.transform(clean.id_tokens(F.col("z.ids")),
                      lambda t: F.coalesce(clean.id_or_null(t), unknown))
    counted = listed.select(
        "turn_id", "z.owner_is_user", "z.zone", F.inline_outer(reshape.multiset(ids))).where(
        "quantity is not null").withColumn("source_arena_card_id", F.nullif("item", unknown))
    return _resolve_card(counted, arena).select(
        "turn_id", "owner_is_user", "zone", "source_arena_card_id", "card_id",
        F.col("quantity").try_cast("smallint").alias("quantity"))


def _resolve_card(df: DataFrame, arena: DataFrame) -> DataFrame:
    return skew_safe_lookup(df, arena, "source_arena_card_id", "arena_card_id", ["card_id"])


# --- events ---------------------------------------------------------------

def _event_spec(source: WideSource) -> str:
    entries = []
    for c in source.layout.turn_columns():
        rule = event_rule(c.side, c.suffix)
        if rule is None:
            continue
        entries.append(
            f"named_struct('position', {c.position}, 'source_field', '{c.column}', "
            f"'side', '{c.side}', 'turn_index', {c.turn_index}, "
            f"'event_type', '{rule.event_type}', 'payload', '{rule.payload}', "
            f"'actor', {_sql(rule.actor_is_user, 'boolean')}, "
            f"'affected', {_sql(rule.affected_is_user, 'boolean')}, "
            f"'exact', {_sql(rule.exact_turn, 'boolean')})")
    return f"array({', '.join(entries)})"


def event_cells(source: WideSource) -> DataFrame:
    """Meaningful cells of event columns with their rule: one narrow stage."""
    one = keyed_cells(source).select("game_id", "cells", F.expr(
        f"explode({_event_spec(source)})").alias("e"))
    value = cell_at(F.col("e.position"))
    live = F.coalesce(clean.is_meaningful(value), F.lit(False))
    return one.where(live).select("game_id", "e.*", value.alias("value"))


def events(cells: DataFrame, arena: DataFrame, abilities: DataFrame) -> DataFrame:
    """Events of the cells: one per listed id, or one per nonzero number."""
    number = clean.number_or_null(F.col("value"))
    is_number = F.col("payload") == "numeric"
    tokens = F.when(is_number & (number != 0), F.array(F.col("value"))).when(
        ~is_number, clean.id_tokens(F.col("value")))
    listed = cells.select(
        "game_id", "source_field", "side", "turn_index", "event_type", "payload", "actor",
        "affected", "exact", F.posexplode_outer(tokens).alias("pos", "token")).where("pos is not null")
    is_number = F.col("payload") == "numeric"
    ident = clean.id_or_null(F.col("token"))
    turn_id = keys.turn_key(F.col("game_id"), F.col("side"), F.col("turn_index"))
    rows = listed.select(
        keys.event_key(F.col("game_id"), F.col("source_field"), F.col("pos") + 1)
        .alias("event_id"),
        "game_id", turn_id.alias("source_turn_id"), "exact", "event_type",
        F.col("actor").alias("actor_is_user"), F.col("affected").alias("affected_is_user"),
        F.when(F.col("payload") == "card", ident).alias("source_arena_card_id"),
        F.when(F.col("payload") == "ability", ident).alias("source_ability_id"),
        F.when(is_number, clean.number_or_null(F.col("token"))).alias("numeric_value"),
        (F.col("pos") + 1).cast("smallint").alias("source_ordinal"), "source_field")
    resolved = skew_safe_lookup(_resolve_card(rows, arena), abilities, "source_ability_id",
                                "ability_id", ["ability_id"])
    return resolved.select(
        "event_id", "game_id", "source_turn_id",
        F.when(F.col("exact"), F.col("source_turn_id")).alias("actual_turn_id"),
        "event_type", "actor_is_user", "affected_is_user", "source_arena_card_id", "card_id",
        "source_ability_id", "ability_id", "numeric_value", "source_ordinal", "source_field")


# --- candidate hands ------------------------------------------------------

def hand_rows(source: WideSource) -> DataFrame:
    """Per game: usable candidates, the final attempt, and what looks wrong."""
    slots = F.array(*[F.struct(F.lit(a).alias("attempt"), clean.id_tokens(
        cell_at(F.lit(p))).alias("items")) for a, p in source.layout.candidate_columns()])
    used = [*(p for _, p in source.layout.candidate_columns()),
            *map(source.layout.position, ("num_mulligans", "opening_hand"))]
    # The split of a line stops behind the last of these cells.
    base = keyed_cells(source, max((p for p in used if p is not None), default=-1)).select(
        "game_id", clean.integer_or_null(source.cell("num_mulligans")).alias("num_mulligans"),
        clean.id_tokens(source.cell("opening_hand")).alias("opening"), slots.alias("listed"))
    usable = F.filter("listed", lambda c: F.size(c["items"]) == HAND_SIZE)
    odd = F.filter("listed", lambda c: (F.size(c["items"]) > 0) & (F.size(c["items"]) != HAND_SIZE))
    return base.select(
        "game_id", "num_mulligans", "opening", usable.alias("candidates"),
        F.size(odd).alias("n_odd_hands")
    ).withColumn("final_attempt", reshape.final_candidate(F.col("candidates"), F.col("opening")))


def candidate_hands(rows: DataFrame) -> DataFrame:
    one = rows.select("game_id", "final_attempt", F.explode_outer("candidates").alias("c")).where(
        "c is not null")
    attempt = F.col("c.attempt")
    return one.select(
        keys.hand_key(F.col("game_id"), attempt).alias("hand_id"), "game_id",
        attempt.cast("smallint").alias("attempt_number"),
        (attempt == F.col("final_attempt")).alias("is_final_candidate"))


def candidate_hand_cards(rows: DataFrame, arena: DataFrame) -> DataFrame:
    one = rows.select("game_id", F.explode_outer("candidates").alias("c")).where("c is not null")
    hands = one.select(keys.hand_key(F.col("game_id"), F.col("c.attempt")).alias("hand_id"),
                       F.posexplode("c.items").alias("pos", "token"))
    ids = hands.select("hand_id", (F.col("pos") + 1).cast("smallint").alias("slot_number"),
                       clean.id_or_null(F.col("token")).alias("source_arena_card_id"))
    return _resolve_card(ids, arena).select(
        "hand_id", "slot_number", "source_arena_card_id", "card_id")


def hand_reports(rows: DataFrame) -> DataFrame:
    """Games per kind of hand inconsistency, with the game ids."""
    n = F.size("candidates")
    match = reshape.bind(F.array_sort("opening"), lambda goal: F.exists(
        "candidates", lambda c: F.array_sort(c["items"]) == goal))
    expected = F.col("num_mulligans") + 1
    reasons = F.filter(F.array(
        F.when(n == 0, F.lit("no usable candidate hand")),
        F.when(F.col("n_odd_hands") > 0, F.lit("candidate hand of another size")),
        F.when(~expected.eqNullSafe(n), F.lit("candidates disagree with mulligans")),
        F.when((n > 0) & ~match, F.lit("opening hand matches no candidate")),
    ), lambda r: r.isNotNull())
    return rows.select("game_id", F.explode_outer(reasons).alias("reason")).where("reason is not null")


# --- totals ---------------------------------------------------------------

def game_player_totals(source: WideSource) -> DataFrame:
    def measures(side: str) -> dict[str, Column]:
        return {t: clean.number_or_null(source.cell(f"{side}_total_{t}")).try_cast(
            "float" if t == "mana_spent" else "smallint") for t in TOTALS}

    return reshape.two_sided(keyed_cells(source), ["game_id"], measures("user"), measures("oppo"))


def replay_checks(layout: Layout) -> list[CellCheck]:
    """What makes a cell of a replay line malformed."""
    totals = [f"{p}_total_{t}" for p in SIDES for t in TOTALS if t != "mana_spent"]
    integers = [f for f in SHARED_FIELDS if f not in FLAGS] + ["user_n_games_bucket", *totals]
    return [*[CellCheck(c, clean.bad_small, "no small whole number") for c in integers],
            *[CellCheck(c, clean.bad_bool, "no truth value") for c in FLAGS]]


def state_rejects(rows: DataFrame) -> DataFrame:
    """Active turns whose opposing hand size is no small whole number."""
    return rows.where(clean.bad_small(F.col("oppo_cards_in_hand"))).select("turn_id", "game_id")


def malformed_events(events: DataFrame) -> DataFrame:
    """Events whose listed id was no number: neither an id nor a value is left."""
    return events.where(F.col("source_arena_card_id").isNull() & F.col("source_ability_id").isNull()
                        & F.col("numeric_value").isNull())
