"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.membership import spread
from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u", spread("u")).agg(F.min("v").alias("_near")).select("u", F.least("u", "_near").alias("_least"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_least").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node itself, move to the smallest of them."""
    least = edges.groupBy("u", spread("u")).agg(F.min("v").alias("_least")).select("u", "_least")
    moved = edges.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("_least").alias("v"))
    return moved.where("u <> v").distinct()


def _print_of(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node that has an edge; the component is its smallest node.

    ``edges`` has two columns of one integer type. Self-links, repeated links and nulls are left out.
    Each round halves the depth or better; its edges are written to the shared folder, so a lost
    executor costs one round at most. Joins have the aggregated side unique, so a hub splits as a
    skewed key, and only aggregated values meet by node.
    """
    a, b = edges.columns
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    links = cut_lineage(links.distinct(), "links")
    seen = _print_of(links)
    for _ in range(rounds):
        if not seen[0]:
            break
        links = cut_lineage(_small_star(_large_star(links)), "links")
        now = _print_of(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
