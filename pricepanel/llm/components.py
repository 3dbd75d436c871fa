"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.lineage import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node to the least of them.

    Large: larger neighbours only, over both directions of every edge.
    Small: neighbours no larger than the node, and the node itself.
    """
    if large:
        pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = pairs.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its least node."""
    current = cut(
        edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
    seen = None
    while True:
        # xor of row hashes tells whether the edges changed; both sums are over one small row each.
        state = tuple(
            current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        )
        if state == seen:
            break
        seen = state
        current = cut(_star(_star(current, large=True), large=False))
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(roots.distinct())
