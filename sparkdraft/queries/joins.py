"""Join forms and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.operators import joins, merge
from sparkdraft.queries.registry import query, table

HAS_LINES = "EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"


@query("semi_target", f"SELECT o_orderkey, o_custkey FROM orders WHERE {HAS_LINES}")
def semi_target(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.only_present(table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                              ids, "o_orderkey")


@query("anti_missing", f"SELECT o_orderkey, o_custkey FROM orders WHERE NOT {HAS_LINES}")
def anti_missing(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.only_absent(table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                             ids, "o_orderkey")


@query("left_lookup", """
    SELECT l_orderkey, l_linenumber, l_partkey * 2 AS part_id, p_name
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey * 2""")
def left_lookup(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 2).alias("part_id"))
    return joins.lookup(li, table(spark, sf, "part"), "part_id", "p_partkey", ["p_name"])


@query("double_left_join", """
    SELECT c.conv_id, c.turn, u.text AS user_text, a.role AS assistant_role
    FROM conversations c
    LEFT JOIN conversations u ON u.conv_id = c.conv_id AND u.turn = c.turn AND u.role = 'user'
    LEFT JOIN conversations a ON a.conv_id = c.conv_id AND a.turn = c.turn AND a.role = 'assistant'""")
def double_left_join(spark: SparkSession, sf: str) -> DataFrame:
    conv = table(spark, sf, "conversations").withColumn("key", F.struct("conv_id", "turn"))
    user = joins.by_role(conv.select("key"), conv, "key", F.col("role") == "user",
                         {"text": "user_text"})
    both = joins.by_role(user, conv, "key", F.col("role") == "assistant",
                         {"role": "assistant_role"})
    return both.select("key.conv_id", "key.turn", "user_text", "assistant_role")


@query("inner_equi_join", """
    SELECT n_name, r_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name""")
def inner_equi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Totals per customer first: the joins then see one row per customer."""
    per_customer = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    joined = per_customer.join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"),
                               "c_custkey")
    per_nation = joined.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.sum("n").alias("n_orders"), F.sum("total").alias("total"))
    named = per_nation.join(table(spark, sf, "nation"), "n_nationkey").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select("n_name", "r_name", "n_orders",
                        F.round(F.col("total").cast("double"), 2).alias("revenue"))


@query("set_operations", """
    SELECT 'union' AS op, count(*) AS n FROM (SELECT l_partkey FROM lineitem UNION SELECT p_partkey FROM part)
    UNION ALL SELECT 'intersection', count(*) FROM
        (SELECT p_partkey FROM part INTERSECT SELECT l_partkey FROM lineitem)
    UNION ALL SELECT 'difference', count(*) FROM
        (SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem)""")
def set_operations(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("k"))
    used = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"))

    def sized(op: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")

    return (sized("union", merge.set_union(used, parts))
            .unionAll(sized("intersection", parts.intersect(used)))
            .unionAll(sized("difference", parts.subtract(used))))
