"""Feed payloads and request plans.

Payloads are landed files; parsing them is a Spark job: ``from_json`` with a
declared schema, ``posexplode`` to match each location to its request row by
position, and ``arrays_zip`` to turn the columnar daily arrays into rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellcast.operators.ranking import ordinal_rank


def rename_feed_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Feed variable names -> model column names (only those present)."""
    from cellcast.fixed_values import WEATHER_API_RENAMES

    renames = renames or WEATHER_API_RENAMES
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def location_schema(variables: Sequence[str]) -> T.ArrayType:
    daily = T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    )
    return T.ArrayType(
        T.StructType(
            [
                T.StructField("latitude", T.DoubleType()),
                T.StructField("longitude", T.DoubleType()),
                T.StructField("elevation", T.DoubleType()),
                T.StructField("daily", daily),
            ]
        )
    )


def as_list_payload(text: F.Column) -> F.Column:
    """A single JSON object becomes a one-element list."""
    t = F.trim(text)
    return F.when(t.startswith("{"), F.concat(F.lit("["), t, F.lit("]"))).otherwise(t)


def flatten_payload(
    payloads: DataFrame,
    requests: DataFrame,
    variables: Sequence[str],
    batch_col: str = "batch_number",
    text_col: str = "payload",
    position_col: str = "position",
) -> tuple[DataFrame, DataFrame]:
    """(batch, JSON text) + (batch, position, request columns) -> daily rows.

    Returns ``(rows, rejected)``: a batch whose location count differs from
    its request count, or a location without ``daily``, is rejected as a
    whole (K8 logs it) instead of being partly loaded.
    """
    parsed = payloads.select(
        batch_col, F.from_json(as_list_payload(F.col(text_col)), location_schema(variables)).alias("locs")
    )
    sizes = requests.groupBy(batch_col).agg(F.count(F.lit(1)).alias("_requested"))
    checked = parsed.join(sizes, batch_col, "left").withColumn(
        "_error",
        F.when(F.col("locs").isNull(), F.lit("unparseable payload"))
        .when(F.size("locs") != F.col("_requested"), F.format_string("returned %d locations for a %d-location batch", F.size("locs"), F.col("_requested")))
        .when(F.exists("locs", lambda l: l["daily"].isNull()), F.lit("location without daily values")),
    )
    rejected = checked.filter(F.col("_error").isNotNull()).select(batch_col, F.col("_error").alias("error"))
    good = checked.filter(F.col("_error").isNull()).select(batch_col, F.posexplode("locs").alias(position_col, "loc"))
    matched = good.join(requests, [batch_col, position_col], "inner")
    zipped = F.arrays_zip(*[F.col(f"loc.daily.{c}").alias(c) for c in ["time", *variables]])
    rows = matched.select(
        *[c for c in requests.columns],
        F.col("loc.latitude").alias("weather_latitude"),
        F.col("loc.longitude").alias("weather_longitude"),
        F.col("loc.elevation").alias("elevation"),
        F.explode(zipped).alias("d"),
    ).select(
        *[c for c in requests.columns],
        "weather_latitude",
        "weather_longitude",
        "elevation",
        F.to_date(F.col("d.time")).alias("date"),
        *[F.col(f"d.{v}").alias(v) for v in variables],
    )
    return rows, rejected


def triage_payloads(raw: DataFrame, text_col: str = "value", allow_empty: bool = False) -> DataFrame:
    """Classify landed text as good, empty, html or invalid.

    With ``allow_empty`` (historical backfill) an empty payload is good and
    yields no rows; otherwise it is rejected.
    """
    t = F.trim(F.coalesce(F.col(text_col), F.lit("")))
    status = (
        F.when(t == "", F.lit("good" if allow_empty else "empty"))
        .when(t.startswith("<"), F.lit("html"))
        .when(F.lower(t).startswith("invalid"), F.lit("invalid"))
        .otherwise(F.lit("good"))
    )
    return raw.withColumn("status", status)


def date_blocks(start: dt.date | F.Column, end: dt.date | F.Column, days: int) -> F.Column:
    """Request blocks of at most ``days`` days covering [start, end]:
    array of (block_start, day_count)."""
    s = start if isinstance(start, F.Column) else F.lit(start)
    e = end if isinstance(end, F.Column) else F.lit(end)
    starts = F.sequence(s, e, F.expr(f"INTERVAL {days} DAY"))
    return F.transform(
        starts,
        lambda b: F.struct(b.alias("block_start"), F.least(F.lit(days), F.datediff(e, b) + 1).alias("day_count")),
    )


def cell_batches(cells: DataFrame, size: int, order_col: str = "grid_id", batch_col: str = "batch_number") -> DataFrame:
    """Fixed-size numbered batches in cell order, with the position inside the batch.

    The ordinal comes from the distributed ranking primitive (no single
    partition window over the cells).
    """
    ranked = ordinal_rank(cells, [], order_col, (), descending=False, output_col="_n", size_col=None, split_ties=False) if _numeric(cells, order_col) else _string_rank(cells, order_col)
    return ranked.withColumn(batch_col, ((F.col("_n") - 1) / size).cast("long") + 1).withColumn(
        "position", ((F.col("_n") - 1) % size).cast("int")
    ).drop("_n")


def _numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.IntegerType, T.LongType, T.ShortType, T.DoubleType, T.FloatType))


def _string_rank(cells: DataFrame, col: str) -> DataFrame:
    # One constant score: the rank is the position by the id, computed with
    # the tie-key buckets of the distributed ordinal rank (no global window).
    ranked = ordinal_rank(
        cells.withColumn("_const", F.lit(0.0)), [], "_const", [col], descending=False, output_col="_n", size_col=None
    )
    return ranked.drop("_const")


def skip_finished(plan: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Planned requests without a landed file."""
    return plan.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def already_complete(day_rows: DataFrame, grid: DataFrame, key: str = "grid_id") -> bool:
    """The date holds every grid cell (distinct counts compared, one job each)."""
    have = day_rows.select(key).distinct().count()
    want = grid.select(key).distinct().count()
    return have == want
