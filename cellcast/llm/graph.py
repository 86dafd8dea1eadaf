"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a minimum per node (combined before the shuffle) joined back to
the links, so a node with very many links is split like any skewed join key.
Every round is written under ``spark.checkpoint.dir``; the driver sees only a
count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.session import cut_lineage


def _stars(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    large = (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
        .where("hi <> lo")
        .distinct()
    )
    root = large.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = large.join(root, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionAll(root.select("hi", F.col("m").alias("lo"))).distinct()


def _mark(links: DataFrame):
    return tuple(
        links.agg(
            F.count("*"),
            F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")), F.lit(0)),
        ).first()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link."""
    now = cut_lineage(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where("hi <> lo")
        .distinct(),
        "links",
    )
    mark = _mark(now)
    while mark[0]:
        after = cut_lineage(_stars(now), "stars")
        new = _mark(after)
        now = after
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
