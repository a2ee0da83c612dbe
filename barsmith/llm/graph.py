"""Connected components by alternating large-star and small-star, all in joins and aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.session import stage_freed


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Join every node's neighbours (the larger ones, or with `small` the smaller ones) to its least neighbour."""
    if small:
        pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
    tied = pairs.join(least, "u")
    out = tied.filter("v > u" if not small else "v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if small:
        out = out.unionAll(least.filter("u != m").select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component (its least node) of every node of `edges` (a, b); written, so that later reads survive losses."""
    edges = stage_freed(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    digest = None
    for _ in range(rounds):
        edges = stage_freed(_star(_star(edges, small=False), small=True), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == digest:
            break
        digest = now
    else:
        raise RuntimeError("components did not settle")
    tops = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        tops.select("node", F.col("node").alias("component")))
