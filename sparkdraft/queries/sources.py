"""Reports, manifests and incremental ingest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkdraft.functions.keys import deterministic_key
from sparkdraft.queries.registry import query, sql_key, table
from sparkdraft.session import work_dir
from sparkdraft.sources import store
from sparkdraft.streaming import ledger
from sparkdraft.streaming.ingest import IncrementalTable, ingest_files

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("row_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return store.row_counts({t: table(spark, sf, t) for t in TABLES}, TABLES)


@query("parameter_query", """
    SELECT o_orderpriority, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
    FROM orders WHERE o_totalprice > 1000 AND o_orderstatus <> 'P' GROUP BY o_orderpriority""")
def parameter_query(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "orders").createOrReplaceTempView("orders_store")
    return store.query(spark, """
        SELECT o_orderpriority, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
        FROM orders_store WHERE o_totalprice > ? AND o_orderstatus <> ? GROUP BY o_orderpriority""",
        [1000, "P"])


# Columns of every table. Numbers that Spark and SQL print in different ways are scaled to whole
# ones, times are taken as microseconds and vectors as the scaled sum of their entries.
HASHED = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal*100 c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal*100",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice*100",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice*100 o_orderdate@ o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity*100 l_extendedprice*100 "
                "l_discount*100 l_tax*100 l_returnflag l_linestatus l_shipdate@",
    "events": "event_id ts@ user_id event_type value*10000 props",
    "documents": "doc_id text lang source n_chars", "embeddings": "vec_id embedding+ label",
    "pages": "page_id url html", "benchmark": "item_id text", "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _spark_value(column: str) -> Column:
    name, _, scale = column.partition("*")
    if scale:
        return F.round(F.col(name) * int(scale)).cast("bigint")
    if column.endswith("@"):
        return F.unix_micros(F.col(column[:-1]).cast("timestamp"))
    if column.endswith("+"):
        scaled = F.transform(column[:-1], lambda c: F.round(c.cast("double") * 10000).cast("bigint"))
        return F.aggregate(scaled, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return F.col(column)


def _sql_value(column: str) -> str:
    name, _, scale = column.partition("*")
    if scale:
        return f"round({name} * {scale})::BIGINT::VARCHAR"
    if column.endswith("@"):
        return f"epoch_us({column[:-1]})::VARCHAR"
    if column.endswith("+"):
        return f"list_sum([round(c::DOUBLE * 10000)::BIGINT FOR c IN {column[:-1]}])::BIGINT::VARCHAR"
    return f"{column}::VARCHAR"


def _manifest_sql(name: str, columns: str) -> str:
    key = sql_key(*[f"coalesce({_sql_value(c)}, '')" for c in columns.split()])
    return (f"SELECT '{name}' AS table_name, count(*) AS row_count, bit_xor({key}) AS hash_xor, "
            f"sum({key} & 4294967295)::BIGINT AS hash_sum FROM {name}")


@query("manifest", "\nUNION ALL ".join(_manifest_sql(n, c) for n, c in HASHED.items()))
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Content hash of every table."""
    return reduce(DataFrame.unionAll, [store.content_manifest(
        table(spark, sf, n), n, deterministic_key(*[
            F.coalesce(_spark_value(c).cast("string"), F.lit("")) for c in columns.split()]))
        for n, columns in HASHED.items()])


EVENTS_DDL = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string")


def _keyed(df: DataFrame) -> DataFrame:
    key: Column = deterministic_key("event", F.col("event_id"))
    return df.select(key.alias("row_key"), "event_id", "ts", "user_id", "event_type", "value")


@query("stream_ingest", f"""
    SELECT {sql_key("'event'", "event_id::VARCHAR")} AS row_key, event_id, ts, user_id, event_type, value
    FROM events""")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The event file is ingested twice: the second stream sees the same rows again
    and must add none of them."""
    root = work_dir(spark, "ingest")
    target = IncrementalTable(
        spark, f"{root}/table", "row_key bigint, event_id bigint, ts timestamp_ntz, "
        "user_id bigint, event_type string, value double", ["row_key"])
    for run in ("first", "second"):
        ingest_files(spark, sf, EVENTS_DDL, target, f"{root}/{run}", _keyed, name=run,
                     pathGlobFilter="events.parquet")
    return target.rows()


@query("draft_progress", """
    WITH e AS (SELECT o_custkey, count(*) AS expected FROM orders GROUP BY o_custkey),
    p AS (SELECT o_custkey, count(*) AS processed FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
    SELECT o_custkey, expected, coalesce(processed, 0) AS processed,
           coalesce(processed, 0) = expected AS completed FROM e LEFT JOIN p USING (o_custkey)""")
def draft_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Progress after two increments of orders."""
    orders = table(spark, sf, "orders")
    start = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("expected")).withColumn("processed", F.lit(0).cast("bigint"))
    once = ledger.merge_progress(start, orders.where(F.col("o_orderstatus") == "F"), "o_custkey")
    return ledger.merge_progress(once, orders.where(F.col("o_orderstatus") == "O"), "o_custkey")
