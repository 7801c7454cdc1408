"""The registered queries of this subpackage, op1 to op13."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdraft.llm import (decontam, jaccard, langid, licences, merkle, mixing, nndescent,
                            pii, quality, tokenfile, toxicity, unigram, whiten)
from sparkdraft.llm.common import fold, stored
from sparkdraft.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where they see the driver's files."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The pseudonym key of the queries; users pass their own.
DEMO_KEY = "demonstration key"
PIECES = "piece_bpe_32k.model"


@query("op1_language")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = fold(F.col("doc_id"), 5) == 0
    model = langid.fit(docs.where(~held))
    found = docs.select("doc_id", held.alias("held_out"),
                        langid.predict(F.col("text"), model, docs).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"),
                        F.col("p.score").alias("score"), F.col("p.languages").alias("languages"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    p = toxicity.Parameters()
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.where(fold(F.col("doc_id"), 3) != 1), p)
    return docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
                       toxicity.score(F.col("text"), model, docs).alias("score")).withColumn(
        "predicted", (F.col("score") >= p.threshold).cast("int"))


#: DuckDB: words of a text; they hold no character that the query lower-cases otherwise.
SQL_WORDS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP3_SQL = f"""
WITH item AS (SELECT item_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k,
         array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
spot AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)
),
hit AS (SELECT doc_id, item_id, i, k FROM spot JOIN grams USING (gram, k)),
n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
),
it AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS h
  FROM hit GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op3_decontamination", OP3_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.verdicts(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")


@query("op4_jaccard_join")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.joined(table(spark, sf, "documents"))


@query("op5_pieces")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    """Piece ids of every document, and whether decoding gives the text back."""
    docs = table(spark, sf, "documents")
    model = unigram.fit(docs, tokenizer_file(PIECES))
    coded = docs.select("doc_id", "text", unigram.encode(F.col("text"), model, docs).alias("ids"))
    back = unigram.decode(F.col("ids"), model, docs)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
                        back.eqNullSafe(F.col("text")).alias("round_trip"))


@query("op6_quality")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    stats = stored(quality.described(docs), "statistics")
    model = quality.fit(stats, labels.where(fold(F.col("doc_id"), 3) != 1))
    return stats.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
                        quality.score(F.col("stats"), model, stats).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


@query("op7_licences")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    """Every licence notice found in the paragraphs of ``documents``."""
    docs = table(spark, sf, "documents")
    return licences.scanned(docs, licences.fit(docs))


@query("op8_token_file")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "token-file")
    spec = Path(tokenizer_file("byte_bpe_50k.json")).read_text(encoding="utf-8")
    tokenfile.write(table(spark, sf, "documents"), path, spec, end_id=2)
    return tokenfile.digests(spark, path)


@query("op9_pseudonyms")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    new = docs.withColumn("candidates", pii.n_found(F.col("text")))
    return pii.pseudonymised(new, DEMO_KEY)


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x <> 0]) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN n ON vec_id = n.a
"""


@query("op10_nn_descent", OP10_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return nndescent.near_duplicates(table(spark, sf, "embeddings"))


@query("op11_whitening")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return whiten.whitened(table(spark, sf, "embeddings"))


@query("op12_mixing")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(table(spark, sf, "documents"))


#: DuckDB: a field of a leaf, a leaf, the level above a list of nodes, crc32 of a decimal number.
SQL_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
SQL_LEAF = "sha256(" + " || ".join(SQL_FIELD.format(f) for f in merkle.FIELDS) + ")"
SQL_UP = "[sha256(arr[2 * k + 1] || coalesce(arr[2 * k + 2], '')) FOR k IN range((len(arr) + 1) // 2)]"
SQL_CRC32 = """xor(4294967295, list_reduce(
    [ascii(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
    lambda crc, byte: list_reduce(range(8),
        lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END,
        xor(crc, byte)),
    CAST(4294967295 AS BIGINT)))"""

OP13_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, lang, {SQL_LEAF} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {SQL_CRC32} % 7 = 0
              THEN {SQL_LEAF.replace("n_chars", "(n_chars + 1)")} END AS tampered
  FROM documents
),
node AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaf
),
low AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY i) AS arr FROM node GROUP BY lang
  UNION ALL
  SELECT lang, lvl + 1, {SQL_UP} FROM low WHERE len(arr) > 1
),
sub AS (
  SELECT lang, arr[1] AS subroot, lvl AS height,
         row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t
  FROM low WHERE len(arr) = 1
),
high AS (
  SELECT 0 AS lvl, list(subroot ORDER BY t) AS arr FROM sub
  UNION ALL
  SELECT lvl + 1, {SQL_UP} FROM high WHERE len(arr) > 1
),
step AS (
  SELECT node.lang, i, lvl, (i >> lvl) % 2 AS bit, coalesce(arr[xor(i >> lvl, 1) + 1], '') AS sib
  FROM node JOIN low ON node.lang IS NOT DISTINCT FROM low.lang WHERE len(arr) > 1
  UNION ALL
  SELECT node.lang, node.i, height + high.lvl, (t >> high.lvl) % 2,
         coalesce(arr[xor(t >> high.lvl, 1) + 1], '')
  FROM node JOIN sub ON node.lang IS NOT DISTINCT FROM sub.lang, high WHERE len(arr) > 1
),
path AS (
  SELECT lang, i, list(struct_pack(bit, sib) ORDER BY lvl) AS p, string_agg(sib, '' ORDER BY lvl) AS proof
  FROM step GROUP BY lang, i
),
fold AS (
  SELECT node.lang, node.i, 0 AS lvl, coalesce(tampered, leaf) AS h, p, proof
  FROM node LEFT JOIN path ON node.lang IS NOT DISTINCT FROM path.lang AND node.i = path.i
  UNION ALL
  SELECT lang, i, lvl + 1, sha256(CASE WHEN p[lvl + 1].bit = 1 THEN p[lvl + 1].sib || h
                                       ELSE h || p[lvl + 1].sib END), p, proof
  FROM fold WHERE lvl < coalesce(len(p), 0)
)
SELECT doc_id, leaf, subroot, (SELECT arr[1] FROM high WHERE len(arr) = 1) AS root,
       sha256(coalesce(proof, '')) AS proof_sha256, h AS folded_root,
       h = (SELECT arr[1] FROM high WHERE len(arr) = 1) AS verified
FROM node JOIN sub ON node.lang IS NOT DISTINCT FROM sub.lang
JOIN fold ON node.lang IS NOT DISTINCT FROM fold.lang AND node.i = fold.i
         AND fold.lvl = coalesce(len(fold.p), 0)
"""


@query("op13_merkle", OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.manifest(table(spark, sf, "documents"))
