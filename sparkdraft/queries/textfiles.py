"""Sources as files: CSV text written from the benchmark tables and read back by the readers.

Every table row becomes a line of one of eight files, each with its own header; some lines are
spoiled on purpose. The rejects must name file, line, column and cell of each.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkdraft.plans import contracts, draft, game, quarantine, replay
from sparkdraft.queries.registry import query, sql_key, table
from sparkdraft.session import work_dir
from sparkdraft.sources import discover, dtypes, layout, text
from sparkdraft.sources.text import WideSource

FILES = 8
CARDS = ("Lion, King", 'The "Bear"', "Island")


def _header_line(columns: list[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(columns)
    return out.getvalue()


def _csv_folder(df: DataFrame, key: Column, columns: dict[str, Column], spoiled: Column | None = None,
                headers: Column | None = None) -> str:
    """Files of a header and a line per row, in the order of the key; ``spoiled`` may replace
    a line (column ``line``), ``headers`` the header of a file (column ``file``)."""
    spark, header = df.sparkSession, _header_line(list(columns))
    cells = [F.coalesce(c.cast("string"), F.lit("")) for c in columns.values()]
    lines = df.select((key % FILES).cast("int").alias("file"), key.cast("long").alias("at"),
                      F.concat_ws(",", *cells).alias("line"))
    if spoiled is not None:
        lines = lines.withColumn("line", spoiled)
    first = F.lit(header) if headers is None else headers
    heads = spark.range(FILES).select(F.col("id").cast("int").alias("file")).select(
        "file", F.lit(-1).cast("long").alias("at"), first.alias("line"))
    path = work_dir(spark, "csv")
    (lines.unionByName(heads).repartition(FILES, "file").sortWithinPartitions("file", "at")
     .select("file", F.col("line").alias("value")).write.partitionBy("file").text(path))
    return path


def _file(column: str = "src_file") -> Column:
    return F.regexp_extract(column, r"/file=([0-9]+)/", 1).cast("int").alias("file")


def _reasons(source: WideSource, cell_checks, kinds) -> DataFrame:
    rows = quarantine.reason_rows(quarantine.rejects(source, cell_checks(source.layout), kinds))
    return rows.select(_file(), "row_number", "dropped", "column_name", "cell", "reason")


def _every(n: int, rest: int, key: Column, then: str, usual: Column) -> Column:
    return F.when(key % n == rest, F.lit(then)).otherwise(usual.cast("string"))


def _cut(n: int, rest: int) -> Column:
    """Lines without their last field."""
    cut = F.regexp_replace("line", ",[^,]*$", "")
    return F.when(F.col("at") % n == rest, cut).otherwise(F.col("line"))


def _counts(prefixes, key: Column, odd: dict[str, Column]) -> dict[str, Column]:
    plain = {f"{p}{name}": ((key + i) % 3).cast("string") for p in prefixes for i, name in enumerate(CARDS)}
    return plain | odd


def pick_files(spark: SparkSession, sf: str) -> WideSource:
    o = F.col("o_orderkey")
    columns = {
        "draft_id": _every(61, 5, o, " ", F.col("o_custkey")), "pack_number": F.floor(o / 1000),
        "pick_number": _every(41, 0, o, "x", o % 1000), "expansion": F.lit("S"),
        "event_type": F.lit("P"), "draft_time": _every(37, 6, o, "2 Jan 2024", F.lit("2024-01-02 03:04:05")),
        "event_match_wins": _every(43, 1, o, "2.5", o % 8), "pick": F.lit('"Lion, King"'),
    } | _counts(("pack_card_", "pool_"), o, {
        "pack_card_Island": _every(53, 3, o, "many", o % 2), "pool_Lion, King": _every(59, 4, o, "-1", o % 2)})
    path = _csv_folder(table(spark, sf, "orders"), o, columns, _cut(47, 2))
    return text.read_wide(spark, path, "draft")


def game_files(spark: SparkSession, sf: str) -> WideSource:
    o = F.col("o_orderkey")
    columns = {
        "draft_id": F.col("o_custkey"), "match_number": _every(41, 0, o, "x", F.floor(o / 1000)),
        "game_number": o % 1000, "num_turns": _every(43, 1, o, "40000", o % 12),
        "on_play": F.lit("True"), "won": _every(53, 3, o, "maybe", o % 2),
    } | _counts(("deck_", "drawn_"), o, {
        "deck_Lion, King": _every(59, 4, o, "1.2.3", o % 2), "deck_Island": _every(67, 6, o, "inf", o % 2),
        'drawn_The "Bear"': _every(71, 7, o, "-2.0", o % 2)})
    path = _csv_folder(table(spark, sf, "orders"), o, columns, _cut(47, 2))
    return text.read_wide(spark, path, "game")


def replay_files(spark: SparkSession, sf: str) -> WideSource:
    e = F.col("event_id")
    columns = {
        "draft_id": F.col("user_id"), "match_number": e, "game_number": _every(41, 0, e, "", F.lit(1)),
        "on_play": _every(53, 3, e, "?", e % 2), "num_turns": e % 9,
        "user_total_cards_drawn": _every(43, 1, e, "70000", e % 60), "user_total_mana_spent": F.lit("x"),
    }
    longer = F.when(F.col("at") % 47 == 2, F.concat("line", F.lit(',"a, b"'))).otherwise(F.col("line"))
    return text.read_wide(spark, _csv_folder(table(spark, sf, "events"), e, columns, longer), "replay")


def _reject_sql(source: str, key: str, dropped: str, reasons: list[tuple[str, str, str, str]],
                width: int, cell: str | None = None) -> str:
    """Rows of every (condition, column, cell, reason); lines of another width have no other."""
    whole = f"{key} % 47 <> 2"
    parts = [f"SELECT file, row_number, {dropped} AS dropped, '{column}' AS column_name, "
             f"{value} AS cell, '{reason}' AS reason FROM f WHERE {condition} AND {whole}"
             for condition, column, value, reason in reasons]
    parts.append(f"SELECT file, row_number, true, '', '{width}', 'wrong field count' FROM f "
                 f"WHERE NOT {whole}")
    return (f"WITH f AS (SELECT *, ({key} % {FILES})::INT AS file, row_number() OVER "
            f"(PARTITION BY {key} % {FILES} ORDER BY {key}) AS row_number FROM {source})\n"
            + "\nUNION ALL ".join(parts))


@query("pick_rejects", _reject_sql(
    "orders", "o_orderkey", "o_orderkey % 61 = 5 OR o_orderkey % 41 = 0", [
        ("o_orderkey % 61 = 5", "draft_id", "' '", "blank"),
        ("o_orderkey % 41 = 0", "pick_number", "'x'", "no number"),
        ("o_orderkey % 43 = 1", "event_match_wins", "'2.5'", "no small whole number"),
        ("o_orderkey % 37 = 6", "draft_time", "'2 Jan 2024'", "no time"),
        ("o_orderkey % 53 = 3", "pack_card_Island", "'many'", "no count"),
        ("o_orderkey % 59 = 4", "pool_Lion, King", "'-1'", "negative count")], 13))
def pick_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _reasons(pick_files(spark, sf), draft.pick_checks, layout.PICK_KINDS)


@query("game_rejects", _reject_sql("orders", "o_orderkey", "o_orderkey % 41 = 0", [
    ("o_orderkey % 41 = 0", "draft_id|match_number|game_number",
     "o_custkey || '|x|' || (o_orderkey % 1000)", "unusable key"),
    ("o_orderkey % 43 = 1", "num_turns", "'40000'", "no small whole number"),
    ("o_orderkey % 53 = 3", "won", "'maybe'", "no truth value"),
    ("o_orderkey % 59 = 4", "deck_Lion, King", "'1.2.3'", "no count"),
    ("o_orderkey % 67 = 6", "deck_Island", "'inf'", "no count"),
    ("o_orderkey % 71 = 7", 'drawn_The "Bear"', "'-2.0'", "negative count")], 11))
def game_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _reasons(game_files(spark, sf), game.game_checks, layout.GAME_KINDS)


@query("replay_rejects", _reject_sql("events", "event_id", "event_id % 41 = 0", [
    ("event_id % 41 = 0", "draft_id|match_number|game_number", "user_id || '|' || event_id || '|'",
     "unusable key"),
    ("event_id % 53 = 3", "on_play", "'?'", "no truth value"),
    ("event_id % 43 = 1", "user_total_cards_drawn", "'70000'", "no small whole number")], 8))
def replay_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _reasons(replay_files(spark, sf), replay.replay_checks, {})


@query("width_rejects", f"""
    WITH f AS (SELECT o_orderkey, (o_orderkey % {FILES})::INT AS file, row_number() OVER
               (PARTITION BY o_orderkey % {FILES} ORDER BY o_orderkey) AS row_number FROM orders)
    SELECT file, row_number, '11' AS n_fields, o_orderkey % 1000 AS game_number FROM f WHERE o_orderkey % 47 = 2""")
def width_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of another width, with a cell that can still be read from the kept line."""
    rows = quarantine.rejects(game_files(spark, sf), []).where(F.col("reasons")[0]["reason"] == quarantine.WIDTH)
    return rows.select(_file(), "row_number", F.col("reasons")[0]["cell"].alias("n_fields"),
                       F.split("line", ",")[2].cast("long").alias("game_number"))


@query("wide_scan", f"""
    SELECT (o_orderkey % {FILES})::INT AS file, o_custkey::VARCHAR AS draft_id,
           CASE WHEN o_orderkey % 41 > 0 THEN {sql_key("o_custkey::VARCHAR", "(o_orderkey // 1000)::VARCHAR",
                                                       "(o_orderkey % 1000)::VARCHAR")} END AS row_id,
           CASE WHEN o_orderkey % 47 = 2 THEN 11 ELSE 12 END AS n_fields FROM orders""")
def wide_scan(spark: SparkSession, sf: str) -> DataFrame:
    return game_files(spark, sf).lines.select(_file(), "draft_id", "row_id", "n_fields")


@query("header_mismatches", f"SELECT DISTINCT (o_orderkey % {FILES})::INT AS file FROM orders "
                            f"WHERE o_orderkey % {FILES} IN (2, 5)")
def header_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a set whose header is another one."""
    o = F.col("o_orderkey")
    other = F.when(F.col("file").isin(2, 5), F.lit("id,price")).otherwise(F.lit("id,total"))
    path = _csv_folder(table(spark, sf, "orders"), o, {"id": o, "total": F.col("o_totalprice")}, headers=other)
    return text.header_mismatches(text.read_lines(spark, path), "id,total").select(_file())


@query("lookup_source", """
    SELECT p_partkey::VARCHAR AS id, replace(p_name, 'e', '"') || ', ' || p_brand AS name,
           CASE WHEN p_size > 10 THEN p_type END AS extra FROM part""")
def lookup_source(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup file with quoted names, doubled quotes and blank cells."""
    part, path = table(spark, sf, "part"), work_dir(spark, "lookup")
    name = F.concat(F.replace("p_name", F.lit("e"), F.lit('"')), F.lit(", "), "p_brand")
    part.select(F.col("p_partkey").alias("id"), name.alias("name"),
                F.when(F.col("p_size") > 10, F.col("p_type")).alias("extra")).write.csv(
        path, header=True, escape='"')
    return text.read_lookup(spark, path, ("id", "name")).drop("src_seq")


@query("typed_source", """
    SELECT o_orderkey % 3 = 0 AS won, CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 12)::TINYINT END AS num_turns,
           o_orderpriority AS rank, (o_orderkey % 4)::TINYINT AS "pool_Lion, King" FROM orders""")
def typed_source(spark: SparkSession, sf: str) -> DataFrame:
    o, path = F.col("o_orderkey"), work_dir(spark, "typed")
    table(spark, sf, "orders").select(
        F.when(o % 3 == 0, "True").otherwise("no").alias("won"),
        F.when(o % 5 > 0, F.concat((o % 12).cast("string"), F.lit(".0"))).alias("num_turns"),
        F.col("o_orderpriority").alias("rank"), (o % 4).alias("pool_Lion, King"),
        F.lit("left out").alias("surprise")).write.csv(path, header=True, escape='"')
    known, unknown = dtypes.column_dtypes(["won", "num_turns", "rank", "pool_Lion, King", "surprise"])
    if unknown != ["surprise"]:
        raise ValueError(f"columns without a rule: {unknown}")
    return text.read_typed(spark, path, known)


@query("dataset_triples", """
    WITH f AS (SELECT p_partkey // 3 AS n, ['draft', 'game', 'replay'][1 + p_partkey % 3] AS kind
               FROM part WHERE p_partkey % 7 <> 0)
    SELECT 'S' || n || '.' || n % 4 AS suffix,
           max('/in/' || kind || '_data_public.S' || n || '.' || n % 4 || '.csv.gz') FILTER (WHERE kind = 'game')
               AS game_file, count(DISTINCT kind) = 3 AS complete FROM f GROUP BY n""")
def dataset_triples(spark: SparkSession, sf: str) -> DataFrame:
    """Triples among file names, most of which lack a file; other names take no part."""
    key = F.col("p_partkey")
    n, kind = F.floor(key / 3), F.get(F.array(*map(F.lit, discover.KINDS)), (key % 3).cast("int"))
    name = F.when(key % 7 == 0, F.lit("notes.csv.gz")).otherwise(F.concat(
        kind, F.lit("_data_public.S"), n.cast("string"), F.lit("."), (n % 4).cast("string"), F.lit(".csv.gz")))
    files = table(spark, sf, "part").select(F.concat(F.lit("/in/"), name).alias("path"), name.alias("file_name"))
    return discover.dataset_triples(files).select("suffix", "game_file", "complete")


@query("header_contracts", """
    WITH c AS (SELECT DISTINCT CASE event_id % 3 WHEN 0 THEN 'oppo' ELSE 'user' END AS side,
                      user_id % 6 + 1 AS turn, CASE event_type WHEN 'click' THEN 'cards_drawn'
                      WHEN 'view' THEN 'eot_user_life' ELSE event_type END AS suffix
               FROM events WHERE user_id % 6 <> 3 OR event_type <> 'view'),
    low AS (SELECT side, suffix FROM c WHERE turn = (SELECT min(turn) FROM c l WHERE l.side = c.side)),
    bad AS (SELECT DISTINCT c.side, c.turn FROM c LEFT JOIN low USING (side, suffix) WHERE low.suffix IS NULL
            UNION SELECT t.side, t.turn FROM (SELECT DISTINCT side, turn FROM c) t JOIN low USING (side)
            WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.side = t.side AND c.turn = t.turn AND c.suffix = low.suffix)),
    hand AS (SELECT DISTINCT user_id % 10 * 2 + 1 AS n FROM events)
    SELECT 'unclassified turn column' AS problem, side || '_' || suffix AS detail FROM
        (SELECT DISTINCT side, suffix FROM c WHERE suffix NOT IN ('cards_drawn', 'eot_user_life'))
    UNION ALL SELECT 'turn with other columns than the lowest one of its side', side || '_turn_' || turn FROM bad
    UNION ALL SELECT 'candidate hands are not contiguous, missing', n::VARCHAR FROM
        (SELECT unnest(range(1, (SELECT max(n) FROM hand) + 1)) AS n) WHERE n NOT IN (SELECT n FROM hand)""")
def header_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """What a header made of the events breaks: columns without a rule, uneven turns, gaps."""
    e, turn = table(spark, sf, "events"), F.col("user_id") % 6 + 1
    kind = F.col("event_type")
    suffix = F.when(kind == "click", "cards_drawn").when(kind == "view", "eot_user_life").otherwise(kind)
    side = F.when(F.col("event_id") % 3 == 0, "oppo").otherwise("user")
    turns = e.where((turn != 4) | (kind != "view")).select(F.concat_ws(
        "_", side, F.lit("turn"), turn.cast("string"), suffix).alias("column"))
    hands = e.select(F.concat(F.lit("candidate_hand_"), (F.col("user_id") % 10 * 2 + 1).cast("string")))
    return contracts.contract_breaks(turns.unionAll(hands).distinct())


@query("replay_mismatches", f"""
    WITH k AS (SELECT *, {sql_key("o_custkey::VARCHAR", "(o_orderkey // 1000)::VARCHAR",
                                  "(o_orderkey % 1000)::VARCHAR")} AS game_id FROM orders WHERE o_orderkey % 5 > 0)
    SELECT game_id, CASE WHEN o_orderkey % 41 = 0 THEN 'no game' ELSE concat_ws(',',
             CASE WHEN o_orderkey % 6 = 0 THEN 'on_play' END, CASE WHEN o_orderkey % 10 = 1 THEN 'num_turns' END)
           END AS differing
    FROM k WHERE o_orderkey % 41 = 0 OR o_orderkey % 6 = 0 OR o_orderkey % 10 = 1""")
def replay_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Replays of four games of five: some disagree with their game, some have none."""
    o = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    key = {"draft_id": F.col("o_custkey"), "match_number": F.floor(o / 1000), "game_number": o % 1000}
    shared = {"on_play": F.lit("True"), "won": o % 2, "num_turns": (o % 10).cast("string"),
              "num_mulligans": F.lit(""), "opp_num_mulligans": F.lit("1")}
    games = text.read_wide(spark, _csv_folder(orders.where(o % 41 > 0), o, key | shared), "game")
    other = shared | {"on_play": F.when(o % 6 == 0, "f").otherwise("t"),
                      "num_turns": F.when(o % 10 == 1, F.lit("")).otherwise(F.concat(o % 10, F.lit(".0")))}
    replays = text.read_wide(spark, _csv_folder(orders.where(o % 5 > 0), o, key | other), "replay")
    return replay.replay_mismatches(replay.replay_rows(replays), game.game_rows(games))
