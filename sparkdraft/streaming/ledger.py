"""Source fingerprints and per-draft completion across increments."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.sources import files


#: Bytes at either end of a file that its fingerprint covers.
END_BYTES = 1 << 20


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """SHA-256 over name, size, header line and both ends of the files of one dataset.

    Files are taken in the order of their names, so a dataset keeps its fingerprint in
    another folder; two files of one name count as two.
    """
    parts = []
    for path in sorted(paths, key=lambda p: (p.rsplit("/", 1)[-1], p)):
        header = spark.read.text(path).limit(1).head()
        size, head, tail = files.read_ends(spark, path, END_BYTES)
        ends = [hashlib.sha256(end).hexdigest() for end in (head, tail)]
        parts.append([path.rsplit("/", 1)[-1], size, header["value"] if header else None, *ends])
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def merge_progress(progress: DataFrame, batch: DataFrame, key: str = "draft_id") -> DataFrame:
    """Progress rows (key, expected, processed, completed) after one more batch."""
    counted = batch.groupBy(key).agg(F.count(F.lit(1)).alias("_new"))
    processed = F.col("processed") + F.coalesce("_new", F.lit(0))
    return progress.join(counted, key, "left").select(
        key, "expected", processed.cast("bigint").alias("processed"),
        (processed == F.col("expected")).alias("completed"))


def overfull(progress: DataFrame) -> DataFrame:
    """Keys with more processed than expected rows."""
    return progress.where(F.col("processed") > F.col("expected"))
