"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "sparkdraft", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect.

    Shuffle partitions stay at the cluster default (AQE coalesces them) unless
    given; UTC keeps zone-less timestamps equal on every executor.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables that every executor sees.

    ``spark.checkpoint.dir`` names it. Where that is unset (tests, one machine) the
    warehouse is used, which is shared wherever there is a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return base.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for one job's intermediate data."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"
