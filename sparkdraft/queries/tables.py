"""The entity builders run on wide text sources derived from the benchmark tables.

Every order becomes one line of a pick source and of a game source, every event row
one line of a replay source. The lines are real CSV text (names with commas are
quoted) and go through the same split, melt and rule code as source files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkdraft.plans import dims, draft, game, replay
from sparkdraft.queries.cleaning import part_lookup
from sparkdraft.queries.registry import query, sql_key, table
from sparkdraft.sources.layout import Layout
from sparkdraft.session import work_dir
from sparkdraft.sources.text import WideSource, keyed_lines, read_bronze, write_bronze

# The brands stand for cards; every second name holds a comma.
BRANDS = 25
NAMES = [f"Brand, {n}" if n % 2 else f"Brand#{n}" for n in range(1, BRANDS + 1)]
_NAME_SQL = "CASE WHEN {n} % 2 = 1 THEN 'Brand, ' || {n} ELSE 'Brand#' || {n} END"
_NAME_OF = _NAME_SQL.format(n="replace(p_brand, 'Brand#', '')::INT")


def _name_of(n: Column) -> Column:
    text = n.cast("string")
    return F.when(n % 2 == 1, F.concat(F.lit("Brand, "), text)).otherwise(
        F.concat(F.lit("Brand#"), text))


def _quoted(text: Column) -> Column:
    return F.when(F.instr(text, ",") > 0, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)


_BRONZE: dict[tuple[str, str, str], str] = {}


def _source(spark: SparkSession, sf: str, kind: str, df: DataFrame, seq: Column,
            columns: dict[str, Column], counts: dict[str, Column] = {}) -> WideSource:
    """Bronze copy of CSV lines: named cells, then per prefix a count per brand.

    As in the build, the lines are written once and all tables read that copy.
    """
    layout = Layout((*columns, *[f"{prefix}{name}" for prefix in counts for name in NAMES]))
    slot = (spark.sparkContext.applicationId, sf, kind)
    if slot not in _BRONZE:
        cells = [F.coalesce(c.cast("string"), F.lit("")) for c in columns.values()]
        # The rows are spread before their lines are made, which are much longer.
        spread = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), seq)
        lines = spread.select(
            F.lit(kind).alias("src_file"), F.lit(0).cast("bigint").alias("src_block"),
            seq.cast("bigint").alias("src_seq"),
            F.concat_ws(",", *cells, *counts.values()).alias("value"))
        path = work_dir(spark, f"bronze-{kind}")
        source = WideSource(keyed_lines(lines, layout, kind), layout, kind)
        write_bronze(source, path)
        _BRONZE[slot] = path
    return read_bronze(spark, _BRONZE[slot], layout, kind)


def _order_brands(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with two count texts over all brands: returned (r) and other (k) lines.

    What is gathered per order is one entry per brand, counted before.
    """
    li, part, orders = (table(spark, sf, t) for t in ("lineitem", "part", "orders"))
    number = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int")
    counts = li.join(part, li.l_partkey == part.p_partkey).groupBy(
        "l_orderkey", number.alias("n")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("r"),
        F.count_if(F.col("l_returnflag") != "R").alias("k"))
    by_brand = counts.groupBy("l_orderkey").agg(F.map_from_entries(
        F.collect_list(F.struct("n", F.struct("r", "k")))).alias("m"))

    # The few brands of an order in their order; zeros fill the gaps in front, between and behind.
    entries = F.array_sort(F.map_entries(F.map_filter("m", lambda n, _: n.between(1, BRANDS))))

    def text(kind: str) -> Column:
        def cell(e: Column, i: Column) -> Column:
            before = F.coalesce(F.get(F.col("m"), i - 1)["key"], F.lit(0))
            return F.concat(F.repeat(F.lit("0,"), e["key"] - before - 1),
                            e["value"][kind].cast("string"))

        last = F.coalesce(F.get(F.col("m"), F.size("m") - 1)["key"], F.lit(0))
        return F.concat(F.array_join(F.transform("m", cell), ","),
                        F.repeat(F.lit(",0"), BRANDS - last)).alias(kind)

    joined = orders.join(by_brand.withColumn("m", entries),
                         orders.o_orderkey == by_brand.l_orderkey, "left")
    empty = F.lit(",".join(["0"] * BRANDS))
    return joined.withColumns({k: F.when(F.size("m") > 0, text(k)).otherwise(empty)
                               for k in ("r", "k")}).drop("m")


def pick_source(spark: SparkSession, sf: str) -> WideSource:
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    columns = {
        "draft_id": cust, "expansion": F.concat(F.lit("S"), (cust % 5).cast("string")),
        "event_type": F.when(cust % 3 > 0, F.lit("Premier")), "draft_time": F.lit("2024-01-02 03:04:05"),
        "rank": F.col("o_orderpriority"), "event_match_wins": F.concat((cust % 8).cast("string"), F.lit(".0")),
        "pack_number": F.floor(order / 1000), "pick_number": order % 1000,
        "pick": _quoted(_name_of(order % BRANDS + 1)), "pick_maindeck_rate": F.lit("0.48"),
    }
    return _source(spark, sf, "draft", _order_brands(spark, sf), order, columns,
                   {"pack_card_": F.col("k"), "pool_": F.col("r")})


def game_source(spark: SparkSession, sf: str) -> WideSource:
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    columns = {
        "draft_id": cust, "match_number": F.floor(order / 1000), "game_number": order % 1000,
        "build_index": F.when(order % 7 > 0, (order % 3).cast("string")),
        "game_time": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "rank": F.col("o_orderpriority"), "opp_rank": F.lit("gold"), "main_colors": F.col("o_orderstatus"),
        "splash_colors": F.lit(" "), "opp_colors": F.lit("W"),
        "on_play": F.when(order % 2 == 0, "True").otherwise("f"),
        "won": F.when(order % 3 == 0, "1").when(order % 3 == 1, "no"),
        "num_turns": F.concat((order % 12).cast("string"), F.lit(".0")),
        "num_mulligans": order % 2, "opp_num_mulligans": F.lit(""),
    }
    return _source(spark, sf, "game", _order_brands(spark, sf), order, columns,
                   {"deck_": F.col("k"), "sideboard_": F.col("r"), "opening_hand_": F.col("r"),
                    "drawn_": F.col("k")})


_BRAND_COUNTS_SQL = f"""
    b AS (SELECT l_orderkey, {sql_key("'card'", "name")} AS card_id,
                 count(*) FILTER (WHERE l_returnflag = 'R') AS r,
                 count(*) FILTER (WHERE l_returnflag <> 'R') AS k
          FROM (SELECT l_orderkey, l_returnflag, {_NAME_OF} AS name
                FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY l_orderkey, name)"""
_PICK_ID = sql_key("'pick'", "o_custkey::VARCHAR", "(o_orderkey // 1000)::VARCHAR",
                   "(o_orderkey % 1000)::VARCHAR")
_GAME_ID = sql_key("o_custkey::VARCHAR", "(o_orderkey // 1000)::VARCHAR",
                   "(o_orderkey % 1000)::VARCHAR")
_BUILD_ID = sql_key("'build'", "o_custkey::VARCHAR", "(o_orderkey % 3)::VARCHAR")


@query("drafts", """
    WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
               FROM orders)
    SELECT o_custkey::VARCHAR AS draft_id, 'S' || (o_custkey % 5) AS expansion,
           CASE WHEN o_custkey % 3 > 0 THEN 'Premier' END AS event_type,
           TIMESTAMP '2024-01-02 03:04:05' AS draft_time, o_orderpriority AS rank,
           (o_custkey % 8)::SMALLINT AS event_match_wins FROM f WHERE rn = 1""")
def drafts(spark: SparkSession, sf: str) -> DataFrame:
    return draft.drafts(pick_source(spark, sf)).select(
        "draft_id", "expansion", "event_type", "draft_time", "rank", "event_match_wins")


@query("draft_picks", f"""
    SELECT {_PICK_ID} AS pick_id, o_custkey::VARCHAR AS draft_id,
           (o_orderkey // 1000)::SMALLINT AS pack_number, (o_orderkey % 1000)::SMALLINT AS pick_number,
           {sql_key("'card'", "(" + _NAME_SQL.format(n=f"(o_orderkey % {BRANDS} + 1)") + ")")} AS card_id,
           round(0.48::FLOAT::DOUBLE, 6) AS pick_maindeck_rate FROM orders""")
def draft_picks(spark: SparkSession, sf: str) -> DataFrame:
    rows = draft.draft_picks(pick_source(spark, sf))
    rate = F.round(F.col("pick_maindeck_rate").cast("double"), 6)
    return rows.select("pick_id", "draft_id", "pack_number", "pick_number", "card_id",
                       rate.alias("pick_maindeck_rate"))


@query("draft_pick_cards", f"""
    WITH {_BRAND_COUNTS_SQL}
    SELECT {_PICK_ID} AS pick_id, card_id, k::SMALLINT AS pack_count, r::SMALLINT AS pool_count
    FROM b JOIN orders ON l_orderkey = o_orderkey""")
def draft_pick_cards(spark: SparkSession, sf: str) -> DataFrame:
    return draft.draft_pick_cards(pick_source(spark, sf))


@query("picks_not_offered", f"""
    WITH {_BRAND_COUNTS_SQL}, p AS (SELECT {_PICK_ID} AS pick_id, o_orderkey,
        {sql_key("'card'", "(" + _NAME_SQL.format(n=f"(o_orderkey % {BRANDS} + 1)") + ")")} AS card_id
        FROM orders)
    SELECT pick_id, card_id FROM p WHERE NOT EXISTS (
        SELECT 1 FROM b WHERE l_orderkey = o_orderkey AND b.card_id = p.card_id AND k > 0)""")
def picks_not_offered(spark: SparkSession, sf: str) -> DataFrame:
    source = pick_source(spark, sf)
    return draft.picks_not_offered(draft.draft_picks(source), draft.draft_pick_cards(source))


@query("games", f"""
    SELECT {_GAME_ID} AS game_id, o_custkey::VARCHAR AS draft_id,
           CASE WHEN o_orderkey % 7 > 0 THEN {_BUILD_ID} END AS build_id,
           (o_orderkey // 1000)::SMALLINT AS match_number, (o_orderkey % 1000)::SMALLINT AS game_number,
           date_trunc('second', o_orderdate) AS game_time, o_orderkey % 2 = 0 AS user_on_play,
           CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS user_won,
           (o_orderkey % 12)::SMALLINT AS source_num_turns FROM orders""")
def games(spark: SparkSession, sf: str) -> DataFrame:
    return game.games(game.game_rows(game_source(spark, sf)))


@query("draft_index", """
    WITH f AS (SELECT o_custkey, min(o_orderkey) AS first_seen, count(*) AS expected_games
               FROM orders GROUP BY o_custkey)
    SELECT o_custkey::VARCHAR AS draft_id, expected_games,
           row_number() OVER (ORDER BY first_seen) - 1 AS draft_index FROM f""")
def draft_index(spark: SparkSession, sf: str) -> DataFrame:
    lines = game_source(spark, sf).lines
    return draft.numbered_index(draft.draft_index(lines), lines)


@query("game_players", f"""
    SELECT {_GAME_ID} AS game_id, true AS is_user, o_orderpriority AS rank,
           o_orderstatus AS main_colors, NULL::VARCHAR AS splash_colors, NULL::VARCHAR AS observed_colors,
           (o_orderkey % 2)::SMALLINT AS num_mulligans,
           CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 50)::SMALLINT END AS n_games_bucket,
           CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 8) / 8.0::DOUBLE END AS game_win_rate_bucket
    FROM orders
    UNION ALL SELECT {_GAME_ID}, false, 'gold', NULL, NULL, 'W', NULL, NULL, NULL FROM orders""")
def game_players(spark: SparkSession, sf: str) -> DataFrame:
    """The buckets come from replays, which three games of four have."""
    rows = game.game_rows(game_source(spark, sf))
    order = F.col("match_number").cast("bigint") * 1000 + F.col("game_number")
    replays = rows.where(order % 4 > 0).select(
        "game_id", (order % 50).cast("smallint").alias("user_n_games_bucket"),
        ((order % 8) / 8).cast("float").alias("user_game_win_rate_bucket"))
    return game.game_players(rows, replays).withColumn(
        "game_win_rate_bucket", F.col("game_win_rate_bucket").cast("double"))


@query("game_card_stats", f"""
    WITH {_BRAND_COUNTS_SQL}
    SELECT {_GAME_ID} AS game_id, card_id, r::SMALLINT AS opening_hand_count,
           k::SMALLINT AS drawn_count, 0::SMALLINT AS tutored_count
    FROM b JOIN orders ON l_orderkey = o_orderkey""")
def game_card_stats(spark: SparkSession, sf: str) -> DataFrame:
    return game.game_card_stats(game_source(spark, sf))


_FIRST_BUILD_SQL = """
    f AS (SELECT o_custkey, o_orderkey % 3 AS build_index, min(o_orderkey) AS o_orderkey
          FROM orders WHERE o_orderkey % 7 > 0 GROUP BY o_custkey, o_orderkey % 3)"""


@query("deck_builds", f"""
    WITH {_FIRST_BUILD_SQL}
    SELECT {_BUILD_ID} AS build_id, o_custkey::VARCHAR AS draft_id,
           build_index::SMALLINT AS build_index FROM f""")
def deck_builds(spark: SparkSession, sf: str) -> DataFrame:
    return game.deck_builds(game.build_compositions(game_source(spark, sf)))


@query("deck_build_cards", f"""
    WITH {_FIRST_BUILD_SQL}, {_BRAND_COUNTS_SQL}
    SELECT {_BUILD_ID} AS build_id, card_id, k::SMALLINT AS deck_count, r::SMALLINT AS sideboard_count
    FROM f JOIN b ON l_orderkey = o_orderkey""")
def deck_build_cards(spark: SparkSession, sf: str) -> DataFrame:
    return game.deck_build_cards(game.build_compositions(game_source(spark, sf)))


@query("build_drift", f"""
    WITH {_BRAND_COUNTS_SQL}, c AS (
        SELECT o_custkey, o_orderkey, o_orderkey % 3 AS build_index,
               coalesce((SELECT string_agg(card_id || ':' || k || ':' || r, ',' ORDER BY card_id)
                         FROM b WHERE l_orderkey = o_orderkey), '') AS composition
        FROM orders WHERE o_orderkey % 7 > 0)
    SELECT o_custkey::VARCHAR AS draft_id, build_index::BIGINT AS build_index FROM c
    GROUP BY o_custkey, build_index HAVING count(DISTINCT composition) > 1""")
def build_drift(spark: SparkSession, sf: str) -> DataFrame:
    return game.build_drift(game.build_compositions(game_source(spark, sf))).select(
        "draft_id", "build_index")


# --- replay ---------------------------------------------------------------

#: What the columns of a turn mean: side, suffix, event type, payload, whether the user acts and
#: is affected, and whether the event is known to belong to that turn. The oracle reads it.
EXPECTED_EVENTS = """
user cards_discarded card_discarded card T - F
user lands_played land_played card T - T
user creatures_cast creature_cast card T - F
user non_creatures_cast non_creature_cast card T - F
user creatures_attacked creature_attacked card T - T
user creatures_blocked creature_blocked card T - T
user creatures_unblocked creature_unblocked card T - T
user creatures_blocking creature_blocking card F - T
user creatures_blitzed creatures_blitzed numeric T - F
user player_combat_damage_dealt combat_damage_dealt numeric T F T
user cards_drawn card_drawn card T - F
user cards_tutored card_tutored card T - F
user cards_foretold card_foretold card T - T
user user_instants_sorceries_cast instant_sorcery_cast card T - T
user oppo_instants_sorceries_cast instant_sorcery_cast card F - T
user user_cards_learned card_learned card T - T
user oppo_cards_learned card_learned card F - T
user user_abilities ability ability T - T
user oppo_abilities ability ability F - T
user user_creatures_killed_combat creature_died_combat card - T T
user oppo_creatures_killed_combat creature_died_combat card - F T
user user_creatures_killed_non_combat creature_died_non_combat card - T T
user oppo_creatures_killed_non_combat creature_died_non_combat card - F T
user user_combat_damage_taken combat_damage_taken numeric F T T
user oppo_combat_damage_taken combat_damage_taken numeric T F T
oppo cards_discarded card_discarded card F - F
oppo lands_played land_played card F - T
oppo creatures_cast creature_cast card F - F
oppo non_creatures_cast non_creature_cast card F - F
oppo creatures_attacked creature_attacked card F - T
oppo creatures_blocked creature_blocked card F - T
oppo creatures_unblocked creature_unblocked card F - T
oppo creatures_blocking creature_blocking card T - T
oppo creatures_blitzed creatures_blitzed numeric F - F
oppo player_combat_damage_dealt combat_damage_dealt numeric F T T
oppo cards_drawn cards_drawn_hidden numeric F - F
oppo cards_tutored cards_tutored_hidden numeric F - F
oppo cards_drawn_or_tutored cards_drawn_or_tutored_hidden numeric F - F
oppo cards_foretold cards_foretold_hidden numeric F - T
oppo user_instants_sorceries_cast instant_sorcery_cast card T - T
oppo oppo_instants_sorceries_cast instant_sorcery_cast card F - T
oppo user_cards_learned card_learned card T - T
oppo oppo_cards_learned card_learned card F - T
oppo user_abilities ability ability T - T
oppo oppo_abilities ability ability F - T
oppo user_creatures_killed_combat creature_died_combat card - T T
oppo oppo_creatures_killed_combat creature_died_combat card - F T
oppo user_creatures_killed_non_combat creature_died_non_combat card - T T
oppo oppo_creatures_killed_non_combat creature_died_non_combat card - F T
oppo user_combat_damage_taken combat_damage_taken numeric F T T
oppo oppo_combat_damage_taken combat_damage_taken numeric T F T
"""
EVENTS = [line.split() for line in EXPECTED_EVENTS.strip().splitlines()]
EXPECTED_ZONES = [("eot_user_cards_in_hand", "true", "hand"),
                  ("eot_user_lands_in_play", "true", "battlefield_land"),
                  ("eot_oppo_lands_in_play", "false", "battlefield_land"),
                  ("eot_user_creatures_in_play", "true", "battlefield_creature"),
                  ("eot_oppo_creatures_in_play", "false", "battlefield_creature"),
                  ("eot_user_non_creatures_in_play", "true", "battlefield_noncreature"),
                  ("eot_oppo_non_creatures_in_play", "false", "battlefield_noncreature")]
MEASURES = ("cards_drawn", "cards_tutored", "cards_drawn_or_tutored", "cards_discarded", "lands_played",
            "cards_foretold", "creatures_cast", "creatures_blitzed", "non_creatures_cast",
            "instants_sorceries_cast", "cards_learned", "mana_spent")


def replay_source(spark: SparkSession, sf: str) -> WideSource:
    """One replay line per event row, with every turn column of two turns of both sides.

    A line fills one event column, in one or both turns, one zone and some of the state."""
    e, u = F.col("event_id"), F.col("user_id")
    hand = F.concat_ws("|", *[((e + n) % 9).cast("string") for n in range(7)])
    reverse = F.concat_ws("|", *[((e + n) % 9).cast("string") for n in reversed(range(7))])
    columns = {
        "draft_id": u, "match_number": e, "game_number": F.lit("1"),
        "num_mulligans": e % 2, "opening_hand": F.when(e % 4 == 0, hand).otherwise(reverse),
        "candidate_hand_1": hand, "candidate_hand_2": F.when(e % 3 > 0, F.concat_ws(
            "|", *[((u + n) % 9).cast("string") for n in range(7)])).otherwise("1|2|3"),
        "candidate_hand_3": F.when(e % 5 == 0, reverse),
    }
    cell = {"card": F.concat_ws("|", (e % 50 + 1).cast("string"), (e % 7 + 900000).cast("string")),
            "ability": F.concat_ws("|", (e % 30).cast("string"), F.lit("1000")),
            "numeric": F.concat((e % 5).cast("string"), F.lit(".0"))}
    zone = F.concat_ws("|", (e % 50 + 1).cast("string"), (u % 50 + 1).cast("string"),
                       (e % 50 + 1).cast("string"))
    for turn in (1, 2):
        filled = F.floor(e / len(EVENTS)) % 3 != 2 - turn
        for j, (side, suffix, _, payload, *_) in enumerate(EVENTS):
            columns[f"{side}_turn_{turn}_{suffix}"] = F.when((e % len(EVENTS) == j) & filled, cell[payload])
        for side, parity in (("user", 0), ("oppo", 1)):
            here = (e % 2 == parity) & (F.floor(e / 14) % 2 == turn - 1)
            columns |= {f"{side}_turn_{turn}_{suffix}": F.when((e % 7 == z) & here, zone)
                        for z, (suffix, _, _) in enumerate(EXPECTED_ZONES)}
    columns |= {
        "user_turn_1_eot_user_life": F.when(e % 3 == 0, e % 21),
        "user_turn_1_eot_oppo_poison_counters": F.when(e % 5 == 0, F.concat((e % 4).cast("string"), F.lit(".5"))),
        "user_turn_1_eot_oppo_cards_in_hand": F.when(e % 4 == 0, e % 8),
        "user_turn_1_user_mana_spent": F.when(e % 6 == 0, F.lit("2.5")),
        "oppo_turn_2_eot_oppo_life": F.when(e % 9 == 0, "x"),
    }
    for i, measure in enumerate(MEASURES):
        of_user = F.col("value") if measure == "mana_spent" else (e + i) % 60
        columns |= {f"user_total_{measure}": of_user,
                    f"oppo_total_{measure}": F.lit("" if measure == "mana_spent" else f"{i}.0")}
    return _source(spark, sf, "replay", table(spark, sf, "events"), e, columns)


_RID = sql_key("user_id::VARCHAR", "event_id::VARCHAR", "'1'")
_TURN = sql_key("'turn'", "game_id::VARCHAR", "side", "turn::VARCHAR")
_CARD = sql_key("'card'", "p_name")
_TRUTH = {"T": "true", "F": "false", "-": "NULL::BOOLEAN"}
_EVENT_VALUES = ",\n".join(
    f"({j}, '{side}', '{suffix}', '{kind}', '{payload}', {_TRUTH[actor]}, {_TRUTH[affected]}, {_TRUTH[exact]})"
    for j, (side, suffix, kind, payload, actor, affected, exact) in enumerate(EVENTS))
_ZONE_VALUES = ", ".join(f"({z}, '{suffix}', {owner}, '{zone}')"
                         for z, (suffix, owner, zone) in enumerate(EXPECTED_ZONES))
_REPLAY_SQL = f"""
    e AS (SELECT *, {_RID} AS game_id FROM events),
    rule(j, side, suffix, event_type, payload, actor, affected, exact) AS (VALUES {_EVENT_VALUES}),
    c AS (SELECT e.* EXCLUDE (event_type), rule.*, turn FROM e JOIN rule ON event_id % {len(EVENTS)} = j
          JOIN (VALUES (1), (2)) n(turn) ON (event_id // {len(EVENTS)}) % 3 <> 2 - turn
          WHERE payload <> 'numeric' OR event_id % 5 <> 0),
    zone(z, suffix, owner_is_user, zone) AS (VALUES {_ZONE_VALUES}),
    z AS (SELECT e.*, owner_is_user, zone, CASE event_id % 2 WHEN 0 THEN 'user' ELSE 'oppo' END AS side,
                 1 + (event_id // 14) % 2 AS turn FROM e JOIN zone ON event_id % 7 = z),
    s AS (SELECT game_id, 'user' AS side, 1 AS turn, event_id FROM e
          WHERE (event_id % 3 = 0 AND event_id % 21 <> 0) OR event_id % 5 = 0
             OR (event_id % 4 = 0 AND event_id % 8 <> 0) OR event_id % 6 = 0
          UNION ALL SELECT game_id, 'oppo', 2, event_id FROM e WHERE event_id % 9 = 0),
    a AS (SELECT game_id, side, turn FROM c UNION SELECT game_id, side, turn FROM z
          UNION SELECT game_id, side, turn FROM s),
    t AS (SELECT *, {_TURN} AS turn_id FROM a)"""


@query("turns", f"""
    WITH {_REPLAY_SQL}
    SELECT turn_id, game_id, side = 'user' AS is_user_turn, turn::SMALLINT AS source_turn_index FROM t""")
def turns(spark: SparkSession, sf: str) -> DataFrame:
    return replay.turns(replay.turn_rows(replay_source(spark, sf)))


@query("turn_player_state", f"""
    WITH {_REPLAY_SQL}, first AS (SELECT turn_id, e.* FROM t JOIN e USING (game_id)
                                  WHERE side = 'user' AND turn = 1),
    p AS (
        SELECT turn_id, true AS player_is_user,
               CASE WHEN event_id % 3 = 0 THEN (event_id % 21)::DOUBLE END AS life,
               NULL::DOUBLE AS poison_counters,
               CASE WHEN event_id % 6 = 0 THEN 2.5::DOUBLE END AS mana_spent,
               CASE WHEN event_id % 14 = 0 AND (event_id // 14) % 2 = 0 THEN 3::SMALLINT END AS hand_size
        FROM first
        UNION ALL
        SELECT turn_id, false, NULL, CASE WHEN event_id % 5 = 0 THEN event_id % 4 + 0.5::DOUBLE END,
               NULL, CASE WHEN event_id % 4 = 0 THEN (event_id % 8)::SMALLINT END FROM first
        UNION ALL
        SELECT turn_id, true, NULL, NULL, NULL, 3::SMALLINT FROM t JOIN z USING (game_id, side, turn)
        WHERE zone = 'hand' AND (side <> 'user' OR turn <> 1))
    SELECT * FROM p WHERE coalesce(life, poison_counters, mana_spent, hand_size) IS NOT NULL""")
def turn_player_state(spark: SparkSession, sf: str) -> DataFrame:
    rows = replay.turn_player_state(replay.turn_rows(replay_source(spark, sf)))
    numbers = ("life", "poison_counters", "mana_spent")
    return rows.select("turn_id", "player_is_user",
                       *[F.col(c).cast("double").alias(c) for c in numbers], "hand_size")


def _arena(spark: SparkSession, sf: str) -> DataFrame:
    return dims.arena_card_ids(dims.arena_rows(part_lookup(spark, sf))).select(
        "arena_card_id", "card_id")


@query("turn_zone_cards", f"""
    WITH {_REPLAY_SQL}, i AS (
        SELECT turn_id, owner_is_user, zone, unnest([event_id % 50 + 1, user_id % 50 + 1, event_id % 50 + 1]) AS id
        FROM t JOIN z USING (game_id, side, turn))
    SELECT turn_id, owner_is_user, zone, id AS source_arena_card_id,
           {_CARD} AS card_id, count(*) AS quantity
    FROM i LEFT JOIN part ON p_partkey = id GROUP BY turn_id, owner_is_user, zone, id, p_name""")
def turn_zone_cards(spark: SparkSession, sf: str) -> DataFrame:
    rows = replay.turn_zone_cards(replay.turn_rows(replay_source(spark, sf)), _arena(spark, sf))
    return rows.withColumn("quantity", F.col("quantity").cast("bigint"))


_EVENT_ID = sql_key("'event'", "game_id::VARCHAR", "source_field", "ord::VARCHAR")


@query("events", f"""
    WITH {_REPLAY_SQL}, l AS (
        SELECT *, side || '_turn_' || turn || '_' || suffix AS source_field,
               CASE WHEN payload = 'card' THEN CASE ord WHEN 1 THEN event_id % 50 + 1 ELSE event_id % 7 + 900000 END
               END AS card_token,
               CASE WHEN payload = 'ability' THEN CASE ord WHEN 1 THEN event_id % 30 ELSE 1000 END END AS ability_token,
               CASE WHEN payload = 'numeric' THEN (event_id % 5)::DOUBLE END AS numeric_value
        FROM c JOIN (VALUES (1), (2)) o(ord) ON ord = 1 OR payload <> 'numeric')
    SELECT {_EVENT_ID} AS event_id, game_id, {_TURN} AS source_turn_id,
           CASE WHEN exact THEN {_TURN} END AS actual_turn_id, event_type,
           actor AS actor_is_user, affected AS affected_is_user, card_token AS source_arena_card_id,
           CASE WHEN p_partkey IS NOT NULL THEN {_CARD} END AS card_id,
           ability_token AS source_ability_id,
           CASE WHEN ability_token BETWEEN 1 AND 25 THEN ability_token END AS ability_id,
           numeric_value, ord::SMALLINT AS source_ordinal, source_field
    FROM l LEFT JOIN part ON p_partkey = card_token""")
def events(spark: SparkSession, sf: str) -> DataFrame:
    lookup = table(spark, sf, "part").select(
        F.col("p_partkey").alias("src_seq"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("id"), F.col("p_type").alias("text"))
    cells = replay.event_cells(replay_source(spark, sf))
    return replay.events(cells, _arena(spark, sf), dims.abilities(lookup).select("ability_id"))


_HANDS_SQL = f"""
    h AS (SELECT *, {_RID} AS game_id, list_transform(range(7), lambda n: (event_id + n) % 9) AS h1,
                 list_transform(range(7), lambda n: (user_id + n) % 9) AS h2 FROM events),
    g AS (SELECT game_id, event_id, 1 AS attempt, h1 AS items, true AS matches FROM h
          UNION ALL SELECT game_id, event_id, 2, h2, list_sort(h1) = list_sort(h2) FROM h
                    WHERE event_id % 3 > 0
          UNION ALL SELECT game_id, event_id, 3, list_reverse(h1), true FROM h WHERE event_id % 5 = 0),
    f AS (SELECT game_id, max(attempt) FILTER (WHERE matches) AS final_attempt FROM g GROUP BY game_id)"""
_HAND_ID = sql_key("'hand'", "game_id::VARCHAR", "attempt::VARCHAR")


@query("candidate_hands", f"""
    WITH {_HANDS_SQL}
    SELECT {_HAND_ID} AS hand_id, game_id, attempt::SMALLINT AS attempt_number,
           attempt = final_attempt AS is_final_candidate FROM g JOIN f USING (game_id)""")
def candidate_hands(spark: SparkSession, sf: str) -> DataFrame:
    return replay.candidate_hands(replay.hand_rows(replay_source(spark, sf)))


@query("candidate_hand_cards", f"""
    WITH {_HANDS_SQL}, c AS (SELECT {_HAND_ID} AS hand_id, unnest(items) AS id,
                                    generate_subscripts(items, 1) AS slot FROM g)
    SELECT hand_id, slot::SMALLINT AS slot_number, id AS source_arena_card_id,
           CASE WHEN p_partkey IS NOT NULL THEN {_CARD} END AS card_id
    FROM c LEFT JOIN part ON p_partkey = id""")
def candidate_hand_cards(spark: SparkSession, sf: str) -> DataFrame:
    hands = replay.hand_rows(replay_source(spark, sf))
    return replay.candidate_hand_cards(hands, _arena(spark, sf))


@query("hand_reports", f"""
    WITH {_HANDS_SQL}, n AS (SELECT game_id, count(*) AS n FROM g GROUP BY game_id)
    SELECT {_RID} AS game_id, 'candidate hand of another size' AS reason FROM events
    WHERE event_id % 3 = 0
    UNION ALL SELECT game_id, 'candidates disagree with mulligans' FROM n JOIN h USING (game_id)
    WHERE n <> event_id % 2 + 1""")
def hand_reports(spark: SparkSession, sf: str) -> DataFrame:
    return replay.hand_reports(replay.hand_rows(replay_source(spark, sf)))


_USER_TOTALS = ", ".join(f"((event_id + {i}) % 60)::SMALLINT AS {m}" for i, m in enumerate(MEASURES[:-1]))
_OPPO_TOTALS = ", ".join(f"{i}::SMALLINT" for i in range(len(MEASURES) - 1))


@query("game_player_totals", f"""
    SELECT {_RID} AS game_id, true AS is_user, {_USER_TOTALS},
           round(value::FLOAT::DOUBLE, 4) AS mana_spent FROM events
    UNION ALL SELECT {_RID}, false, {_OPPO_TOTALS}, NULL FROM events""")
def game_player_totals(spark: SparkSession, sf: str) -> DataFrame:
    return replay.game_player_totals(replay_source(spark, sf)).withColumn(
        "mana_spent", F.round(F.col("mana_spent").cast("double"), 4))
