"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _mark(edges: DataFrame) -> tuple:
    """A value that tells two edge sets apart."""
    row = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of all linked nodes.

    Nodes are longs. Nodes that no edge names and those linked only to
    themselves are not in the result; an empty edge set gives an empty result.
    Each round is cut to the shared checkpoint folder. A star's centre may have
    many edges: minima are combined before the shuffle and the joins that
    follow can be split by adaptive execution.
    """
    a, b = F.col(left), F.col(right)
    now = stored(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    mark = _mark(now)
    if mark[0]:
        for _ in range(most_rounds):
            now = stored(_small_star(_large_star(now)))
            last, mark = mark, _mark(now)
            if mark == last:
                break
        else:
            raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
