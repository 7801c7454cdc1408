"""Data-quality operators over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.operators import checks
from sparkdraft.plans import report
from sparkdraft.queries.registry import query, sql_key, table


@query("unique_violations", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def unique_violations(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("fk_violations", """
    SELECT doc_id + 100 AS ref, count(*) AS n_rows FROM labels
    WHERE doc_id + 100 NOT IN (SELECT doc_id FROM documents WHERE lang <> 'en') GROUP BY doc_id""")
def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    child = table(spark, sf, "labels").select((F.col("doc_id") + 100).alias("ref"))
    parent = table(spark, sf, "documents").where(F.col("lang") != "en")
    return checks.missing_parents(child, ["ref"], parent, ["doc_id"])


@query("null_counts", """
    WITH j AS (SELECT quality, toxic, doc_id FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'doc_id' AS column_name, count(*) FILTER (WHERE doc_id IS NULL) AS n_null FROM j
    UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM j
    UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM j""")
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return checks.null_counts(joined, ["doc_id", "quality", "toxic"])


@query("negative_counts", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def negative_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.negative_counts(table(spark, sf, "customer").select("c_custkey", "c_acctbal"),
                                  ["c_acctbal"])


@query("metadata_conflicts", """
    SELECT * FROM (SELECT p_name, concat_ws(',',
        CASE WHEN count(DISTINCT p_type) > 1 THEN 'p_type' END,
        CASE WHEN count(DISTINCT p_size) > 1 THEN 'p_size' END,
        CASE WHEN max(p_retailprice) - min(p_retailprice) > 0.01 THEN 'p_retailprice' END)
        AS differing FROM part GROUP BY p_name) WHERE differing <> ''""")
def metadata_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.metadata_conflicts(table(spark, sf, "part"), ["p_name"], ["p_type", "p_size"],
                                     ["p_retailprice"], F.col("p_partkey"))


@query("exactly_n_children", """
    SELECT o_orderkey, count(l_orderkey) AS n_children
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linestatus = 'O'
    GROUP BY o_orderkey HAVING count(l_orderkey) <> 2""")
def exactly_n_children(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return checks.children_not_exactly(table(spark, sf, "orders"), "o_orderkey", lines, 2,
                                       F.col("l_linestatus") == "O")


@query("completeness", """
    WITH e AS (SELECT o_custkey, count(*) AS n_expected FROM orders GROUP BY o_custkey),
    a AS (SELECT o_custkey, count(*) AS n_actual FROM orders
          WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY o_custkey)
    SELECT o_custkey, n_expected, coalesce(n_actual, 0) AS n_actual
    FROM e LEFT JOIN a USING (o_custkey) WHERE coalesce(n_actual, 0) <> n_expected""")
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    expected = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    with_lines = orders.join(table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return checks.incomplete_groups(expected, "o_custkey", "n", with_lines)


@query("group_schema_drift", """
    WITH p AS (SELECT DISTINCT p_brand AS side, p_size AS idx, p_type AS member FROM part),
    b AS (SELECT side, member FROM p WHERE idx = (SELECT min(idx) FROM p q WHERE q.side = p.side)),
    g AS (SELECT side, idx, count(*) AS n_members, count(*) FILTER (
              WHERE (side, member) IN (SELECT (side, member) FROM b)) AS n_shared
          FROM p GROUP BY side, idx),
    n AS (SELECT side, count(*) AS n_base FROM b GROUP BY side)
    SELECT side, idx, n_base - n_shared AS n_missing, n_members - n_shared AS n_extra
    FROM g JOIN n USING (side) WHERE n_base > n_shared OR n_members > n_shared""")
def group_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(
        F.col("p_brand").alias("side"), F.col("p_size").alias("idx"), F.col("p_type").alias("member"))
    return checks.group_schema_drift(parts, "side", "idx", "member")


@query("stable_sample", """
    SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0
    ORDER BY c_acctbal, c_custkey LIMIT 10""")
def stable_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The bounded sample of offending rows that messages quote."""
    bad = checks.negative_counts(table(spark, sf, "customer"), ["c_acctbal"])
    return checks.stable_sample(bad.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"])


def _as_model(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Orders, lines and customers under the names of the data model."""
    orders, li, part = (table(spark, sf, t) for t in ("orders", "lineitem", "part"))
    names = part.select(F.col("p_partkey").alias("card_id"))
    raw = (F.col("l_partkey") * 2 - 100).alias("source_arena_card_id")
    ids = li.select("l_orderkey", "l_linenumber", "l_suppkey", raw).join(
        names, F.col("source_arena_card_id") == F.col("card_id"), "left")
    events = ids.select(
        F.col("l_orderkey").alias("game_id"), "source_arena_card_id", "card_id",
        F.col("l_suppkey").alias("source_ability_id"),
        F.when(F.col("l_suppkey") % 4 > 0, F.col("l_suppkey")).alias("ability_id"),
        F.when(F.col("l_linenumber") % 3 > 0, F.col("l_orderkey")).alias("actual_turn_id"))
    return {
        "games": orders.select(F.col("o_orderkey").alias("game_id")), "events": events,
        "candidate_hand_cards": ids.where(F.col("l_linenumber") == 1).select(
            "source_arena_card_id", "card_id"),
        "turn_zone_cards": ids.where(F.col("l_linenumber") == 2).select(
            (F.col("source_arena_card_id") + 1).alias("source_arena_card_id"),
            F.lit(None).cast("bigint").alias("card_id")),
    }


@query("coverage_metrics", """
    WITH u AS (SELECT l_partkey * 2 - 100 AS id, l_linenumber FROM lineitem)
    SELECT 'unmapped_cards' AS metric, count(DISTINCT id) AS value FROM (
        SELECT id FROM u WHERE id NOT IN (SELECT p_partkey FROM part)
        UNION ALL SELECT id + 1 FROM u WHERE l_linenumber = 2) WHERE id > 0
    UNION ALL SELECT 'unmapped_abilities', count(DISTINCT l_suppkey) FROM lineitem
        WHERE l_suppkey > 0 AND l_suppkey % 4 = 0
    UNION ALL SELECT 'unknown_turn_events', count(*) FROM lineitem WHERE l_linenumber % 3 = 0
    UNION ALL SELECT 'games', count(*) FROM orders
    UNION ALL SELECT 'events', count(*) FROM lineitem""")
def coverage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return report.coverage_metrics(_as_model(spark, sf))


@query("foreign_turns", f"""
    WITH e AS (SELECT {sql_key("'event'", "l_orderkey::VARCHAR", "l_linenumber::VARCHAR")} AS event_id,
                      l_orderkey AS game_id, l_suppkey AS turn_id FROM lineitem),
    t AS (SELECT s_suppkey AS turn_id, s_suppkey * 3 AS game_id FROM supplier)
    SELECT event_id, e.turn_id AS source_turn_id FROM e JOIN t USING (turn_id)
    WHERE e.game_id <> t.game_id""")
def foreign_turns(spark: SparkSession, sf: str) -> DataFrame:
    from sparkdraft.functions.keys import deterministic_key

    events = table(spark, sf, "lineitem").select(
        deterministic_key("event", F.col("l_orderkey"), F.col("l_linenumber")).alias("event_id"),
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("source_turn_id"))
    turns = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("turn_id"), (F.col("s_suppkey") * 3).alias("game_id"))
    return report.foreign_turns({"events": events, "turns": turns}, "source_turn_id")


@query("drafts_without_picks", """
    SELECT DISTINCT o_custkey AS draft_id FROM orders WHERE o_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def drafts_without_picks(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "draft_id")
    return report.drafts_without_picks({
        "games": orders, "draft_picks": orders.where(F.col("o_orderstatus") == "P")})
