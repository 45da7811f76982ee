"""Connected components of large graphs by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.where("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """edges (a, b) of comparable ids -> (node, root): every node that has an edge, with the least node that it reaches.

    Edges may repeat, and may stand either way round; loops and edges with a
    null end are left out. Each round writes its edges to the shared folder,
    and only their number and checksum come to the driver. The number of
    rounds grows with the logarithm of the longest chain.
    """
    clean = edges.where("a is not null and b is not null and a <> b")
    now = written(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").bitwiseAND(F.lit((1 << 31) - 1)))).first()
        if mark == seen:
            break
        seen = mark
        if not mark[0]:
            break
        # rounds alternate; stars at their least nodes stay as they are
        before, now = now, written(_small_star(_large_star(now).distinct()).distinct(), name)
        discard(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
