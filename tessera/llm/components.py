"""Connected components by alternating stars, with DataFrame operations only.

Each round joins every edge with the least neighbour of its node (an aggregate that combines
before the shuffle, and a join that Spark can split), so no node's neighbours are ever gathered
in one place. Rounds grow with the logarithm of the number of nodes; each round's edges go to the
shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's least neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked with the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its least node.

    Edges with a null end and loops of one node link nothing and are left out; repeated and
    reversed edges count once. No edges: no rows.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v").distinct().checkpoint()
    before = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("a"),
        ).first()
        if mark["n"] == 0 or mark == before:
            break
        before = mark
        now = _small_star(_large_star(now)).checkpoint()
    root = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(root)
