"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1000003).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    ``links`` has columns ``a`` and ``b`` of one orderable type, in either direction, with
    repeats allowed. Each round stores its edges; a node's neighbours are only aggregated
    and joined, never collected. Nodes without links do not appear.
    """
    links = links.where("a is not null and b is not null and a <> b")
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "edges")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"),
                                                            F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"),
                                                            F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        edges = stored(small, "edges")
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("a"), F.col("b").alias("root"))
                             .distinct()).groupBy("a").agg(F.min("root").alias("root")) \
        .select(F.col("a").alias("node"), "root")
