"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omicspark.storage import materialize

MAX_ROUNDS = 60


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """True if each ``a`` has one ``b`` and no ``b`` is an ``a``."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    per_node = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    wrong = per_node.where("out > 1 OR (out > 0 AND into > 0)").agg(F.count("*").alias("n"))
    return wrong.first()["n"] == 0


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node.

    ``edges`` holds two columns of one orderable type; null ends and loops are
    ignored, repeated edges count once, and no edges give no rows. Each round
    joins on plain node columns, so adaptive skew joins split a hub's edges, and
    minima combine on the map side. Rounds grow with the logarithm of the
    longest path; each is written to the shared folder, never collected.
    """
    a, b = F.col(src), F.col(dst)
    current = materialize(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "edges",
    )
    for _ in range(MAX_ROUNDS):
        if _is_forest_of_stars(current):
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.min("b").alias("low")), "lows").select("a", F.least("a", "low").alias("low"))
        large = materialize(
            both.join(low, "a").where("b > a AND b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(),
            "large",
        )
        low = materialize(large.groupBy("a").agg(F.min("b").alias("low")), "lows")
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        current = materialize(small.select("e.*").where("a <> b").distinct(), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
