"""Corpus cleaning: toxic documents, near copies, benchmark passages, personal data, encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdraft.llm import decontam, jaccard, pii, toxicity, unigram
from sparkdraft.llm.common import stored
from sparkdraft.llm.queries import DEMO_KEY, PIECES, importable, table, tokenizer_file


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    importable(spark)
    p = toxicity.Parameters()
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), p)
    return docs.where(toxicity.score(F.col("text"), model, docs) < p.threshold)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    importable(spark)
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold benchmark passages by the rule of the operator."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal numbers, dates and addresses."""
    return pii.pseudonymised(docs, DEMO_KEY)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids): the piece ids of every document that is left."""
    importable(spark)
    model = unigram.fit(docs, tokenizer_file(PIECES))
    ids = unigram.encode(F.col("text"), model, docs)
    return docs.select("doc_id", ids.alias("ids")).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [("toxicity", toxic_out), ("n-gram Jaccard join", near_copies_out),
          ("benchmark decontamination", decontaminated), ("pseudonyms", pseudonymised),
          ("SentencePiece encoding", encoded)]

#: A trained classifier and a learned encoding take part, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
