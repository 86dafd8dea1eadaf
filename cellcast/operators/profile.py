"""Table profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellcast.operators.numbering import order_statistics
from cellcast.operators.ranking import log_bucket
from cellcast.session import cut_lineage

QUARTILES = (0.25, 0.5, 0.75)


def table_profile(df: DataFrame, cell_col: str, date_col: str, label_col: str) -> DataFrame:
    """Rows, distinct cells, first/last day, positives, positive rate."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(cell_col).alias("cells"),
        F.min(date_col).alias("start_date"),
        F.max(date_col).alias("end_date"),
        F.sum(F.col(label_col).cast("long")).alias("positives"),
        F.avg(F.col(label_col).cast("double")).alias("positive_rate"),
    )


def null_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A10: fraction of nulls per column (one aggregate, then unpivot), largest first."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    long = wide.unpivot([], columns, "column_name", "null_fraction")
    return long.orderBy(F.col("null_fraction").desc(), F.col("column_name"))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, exact quartiles, max per numeric column.

    Two scans for any number of columns: the first counts all columns by value
    buckets (moments come along), the second counts the values of the few buckets
    that hold a quartile.  Those are cut further, so that no task sorts a column.
    """
    columns = list(columns)
    spark = df.sparkSession
    value = F.explode(
        F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    )
    long = df.select(value.alias("x")).select("x.c", "x.v").where("v is not null").withColumn("bucket", log_bucket(F.col("v")))
    # Columns x buckets rows, however long the table is.
    buckets = cut_lineage(
        long.groupBy("c", "bucket").agg(
            F.count("*").alias("n"),
            F.avg("v").alias("m"),
            F.var_pop("v").alias("s"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
        ),
        "buckets",
    )
    by_value = Window.partitionBy("c").orderBy("bucket")
    everything = Window.partitionBy("c")
    placed = buckets.select(
        "*",
        F.coalesce(F.sum("n").over(by_value.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(everything).alias("rows"),
        (F.sum(F.col("n") * F.col("m")).over(everything) / F.sum("n").over(everything)).alias("mean"),
    )
    shift = F.col("m") - F.col("mean")
    totals = placed.groupBy("c").agg(
        F.max("rows").alias("count"),
        F.max("mean").alias("mean"),
        F.sum(F.col("n") * (F.col("s") + shift * shift)).alias("squares"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
    )
    quartile = F.explode(F.array(*[F.lit(q) for q in QUARTILES]))
    at = F.col("q") * (F.col("rows") - 1)
    ranks = F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at))))
    held = placed.select("*", quartile.alias("q")).select("*", ranks.alias("rank")).where(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    )
    # At most six ranks of a column, and one row of totals.
    wanted = held.select("c", "rank", (F.col("rank") - F.col("before")).alias("left"), "low", "high", "bucket").distinct().collect()
    searched = {(r["c"], r["bucket"]) for r in wanted if r["low"] < r["high"]}
    found = {(r["c"], r["rank"]): r["low"] for r in wanted if not r["low"] < r["high"]}
    if searched:
        few = spark.createDataFrame(sorted(searched), "c int, bucket long")
        counted = cut_lineage(
            long.join(F.broadcast(few), ["c", "bucket"]).groupBy("c", "v").agg(F.count("*").alias("n")), "bucket-values"
        )
        open_ranks = [(r["c"], r["rank"], r["left"], r["low"], r["high"]) for r in wanted if r["low"] < r["high"]]
        found |= order_statistics(counted, open_ranks)
    quartiles = []
    for c, n in {(r["c"], r["count"]) for r in totals.select("c", "count").collect()}:
        row = [c]
        for q in QUARTILES:
            place = q * (n - 1)
            low, high = found[c, math.floor(place)], found[c, math.ceil(place)]
            row.append(low if low == high else low + (high - low) * (place - math.floor(place)))
        quartiles.append(tuple(row))
    names = spark.createDataFrame(list(enumerate(columns)), "c int, column_name string")
    values = spark.createDataFrame(quartiles, "c int, p25 double, p50 double, p75 double")
    # One row per column on every side.
    out = names.join(totals, "c", "left").join(values, "c", "left")
    std = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1)))
    return out.select(
        "column_name", F.coalesce("count", F.lit(0)).alias("count"), "mean", std.alias("std"), "min", "p25", "p50", "p75", "max"
    )


def monthly_label_stats(df: DataFrame, date_col: str, label_col: str) -> DataFrame:
    """Rows, positives and rate per ``yyyy-MM``."""
    return df.groupBy(F.date_format(date_col, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label_col).cast("long")).alias("positives"),
        F.avg(F.col(label_col).cast("double")).alias("positive_rate"),
    )
