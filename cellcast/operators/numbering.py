"""Row numbers and order statistics that no single task computes.

``number_rows`` numbers the rows of each group by one range sort: a group that
spans many range partitions is numbered by all of them, with offsets from the
partitions' counts.  ``order_statistics`` finds values of given rank from counts
per bucket; only the bucket that holds the rank is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellcast.session import cut_lineage, shuffle_partitions

#: Cells into which a bucket is cut when it is looked at again.
_CELLS = 4096


def number_rows(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column], output_col: str = "row_number"
) -> DataFrame:
    """Add the 0-based number of each row in its group by ``order_cols`` (ties in no fixed order)."""
    parts = shuffle_partitions(df.sparkSession)
    order = [*group_cols, *order_cols]
    sorted_rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Written, so that a row keeps its place in the sort in every later job.
    rows = cut_lineage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    # A row per group and partition it reaches into: at most as many as there are partitions.
    spans = rows.groupBy(*group_cols, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*group_cols, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_at") - F.col("_first")
    return rows.join(spans, [*group_cols, "_part"]).withColumn(output_col, number).drop("_at", "_part", "_first", "_before")


def order_statistics(
    counted: DataFrame, wanted: Sequence[tuple[int, int, int, float, float]]
) -> dict[tuple[int, int], float]:
    """Values by rank: ``counted`` holds (c, v, n), a value of column number c and how often it occurs.

    ``wanted``: (c, rank, rank inside [low, high], low, high).  Each round cuts
    every interval into cells of equal width and keeps the one with the rank, so
    the driver sees one line per wanted value and no task sorts an interval.
    """
    spark = counted.sparkSession
    found: dict[tuple[int, int], float] = {}
    search = list(wanted)
    while search:
        for c, rank, _, low, high in search:
            if low == high or low != low:  # one value, or all not a number
                found[c, rank] = low
        search = [s for s in search if (s[0], s[1]) not in found]
        if not search:
            break
        # One row per wanted value.
        state = spark.createDataFrame(search, "c int, rank long, left long, low double, high double")
        near = counted.join(F.broadcast(state), "c").where(F.col("v").between(F.col("low"), F.col("high")))
        place = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * _CELLS
        cells = near.groupBy("c", "rank", "left", F.least(F.floor(place), F.lit(_CELLS - 1)).alias("cell")).agg(
            F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        before = Window.partitionBy("c", "rank").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        hit = cells.where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("n")))
        search = [(r["c"], r["rank"], r["left"] - r["before"], r["low"], r["high"]) for r in hit.collect()]
    return found
