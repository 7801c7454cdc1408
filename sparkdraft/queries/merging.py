"""Merge operators: two versions of a table derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.operators import merge
from sparkdraft.queries.registry import query, table

# Stored: labels with a NULL quality for every third document. Incoming: the even
# documents, with the quality, and a toxic flag that differs for every tenth one.
_STORED = """s AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN quality END AS quality, toxic FROM labels)"""
_INCOMING = """i AS (SELECT d.doc_id, l.quality, CASE WHEN d.doc_id % 10 = 0 THEN 1 - l.toxic ELSE l.toxic END AS toxic
    FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.doc_id % 2 = 0)"""
KEY, COLUMNS = ["doc_id"], ["quality", "toxic"]


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    labels, docs = table(spark, sf, "labels"), table(spark, sf, "documents").select("doc_id")
    stored = labels.withColumn("quality", F.when(F.col("doc_id") % 3 > 0, F.col("quality")))
    flipped = F.when(F.col("doc_id") % 10 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    incoming = docs.where(F.col("doc_id") % 2 == 0).join(labels, "doc_id", "left").select(
        "doc_id", "quality", flipped.alias("toxic"))
    return stored, incoming


_DIFF = """nullif(concat_ws(',', CASE WHEN {q} THEN 'quality' END, CASE WHEN {t} THEN 'toxic' END), '')"""


@query("null_fill_merge", f"""
    WITH {_STORED}, {_INCOMING}
    SELECT doc_id, coalesce(s.quality, i.quality) AS quality, coalesce(s.toxic, i.toxic) AS toxic
    FROM s FULL JOIN i USING (doc_id)""")
def null_fill_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merge.null_fill_merge(*_sides(spark, sf), KEY, COLUMNS)


@query("null_fill_conflicts", f"""
    WITH {_STORED}, {_INCOMING}
    SELECT * FROM (SELECT doc_id, {_DIFF.format(q="s.quality <> i.quality", t="s.toxic <> i.toxic")}
        AS differing FROM s JOIN i USING (doc_id)) WHERE differing IS NOT NULL""")
def null_fill_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return merge.null_fill_conflicts(*_sides(spark, sf), KEY, COLUMNS)


_STRICT = _DIFF.format(q="s.quality IS DISTINCT FROM i.quality", t="s.toxic IS DISTINCT FROM i.toxic")


@query("strict_ensure", f"""
    WITH {_STORED}, {_INCOMING}
    SELECT * FROM (SELECT doc_id, {_STRICT} AS differing FROM s JOIN i USING (doc_id))
    WHERE differing IS NOT NULL""")
def strict_ensure(spark: SparkSession, sf: str) -> DataFrame:
    return merge.strict_ensure_conflicts(*_sides(spark, sf), KEY, COLUMNS)


@query("insert_or_validate", f"""
    WITH {_STORED}, {_INCOMING}
    SELECT doc_id, 'insert' AS outcome FROM i WHERE doc_id NOT IN (SELECT doc_id FROM s)
    UNION ALL SELECT doc_id, 'differs' FROM s JOIN i USING (doc_id) WHERE {_STRICT} IS NOT NULL""")
def insert_or_validate(spark: SparkSession, sf: str) -> DataFrame:
    fresh, differing = merge.insert_or_validate(*_sides(spark, sf), KEY, COLUMNS)
    return fresh.select("doc_id", F.lit("insert").alias("outcome")).unionAll(
        differing.select("doc_id", F.lit("differs").alias("outcome")))


@query("update_from", f"""
    WITH {_STORED}, {_INCOMING}
    SELECT s.doc_id, CASE WHEN i.doc_id IS NOT NULL AND s.toxic = 0 THEN i.quality ELSE s.quality END
        AS quality, s.toxic FROM s LEFT JOIN i USING (doc_id)""")
def update_from(spark: SparkSession, sf: str) -> DataFrame:
    stored, incoming = _sides(spark, sf)
    return merge.update_from(stored, incoming.select("doc_id", "quality"), KEY, ["quality"],
                             when=F.col("toxic") == 0)


@query("insert_if_absent", f"""
    WITH {_INCOMING} SELECT * FROM i WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    stored, incoming = _sides(spark, sf)
    return merge.insert_if_absent(stored, incoming, KEY)


@query("mismatch_rows", """
    SELECT s_suppkey, concat_ws(',',
        CASE WHEN s_nationkey IS DISTINCT FROM c_nationkey THEN 'nation' END,
        CASE WHEN s_acctbal::FLOAT IS DISTINCT FROM c_acctbal::FLOAT THEN 'balance' END) AS differing
    FROM supplier JOIN customer ON s_suppkey = c_custkey
    WHERE s_nationkey IS DISTINCT FROM c_nationkey
       OR s_acctbal::FLOAT IS DISTINCT FROM c_acctbal::FLOAT""")
def mismatch_rows(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"),
                                            F.col("s_acctbal").alias("balance"))
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("s_suppkey"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"))
    return merge.mismatches(s, c, ["s_suppkey"], ["nation", "balance"], {"balance": "float32"})
