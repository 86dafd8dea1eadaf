"""Per-cell time-series windows, next-day labels, dedupe and sequential ids.

Rolling windows partition by cell and order by date; a partition holds one
cell's days (bounded by the calendar).  All features that share a partition
and order are computed by one Window operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellcast.fixed_values import INCLUSIVE_WINDOW_SPECS, PAST_WINDOW_SPECS

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _min_count(value: Column, window, aggregation: str, minimum: int) -> Column:
    """Aggregate over the frame; null when fewer than ``minimum`` non-null values."""
    return F.when(F.count(value).over(window) >= minimum, _AGG[aggregation](value).over(window))


def rolling_rows(
    df: DataFrame,
    specs: Sequence[tuple] = PAST_WINDOW_SPECS,
    include_current: bool = False,
    cell_col: str = "grid_id",
    date_col: str = "date",
    extra_partition: Sequence[Column | str] = (),
) -> DataFrame:
    """W1 (``include_current``) / W2 (past only): windows counted in rows.

    W1 frame is the last ``n`` rows including this one; W2 is the ``n`` rows
    before this one.  Rows, not days: on gap-free series they agree with W3.
    """
    base = Window.partitionBy(cell_col, *extra_partition).orderBy(date_col)
    columns = []
    for n, source, aggregation, minimum, output in specs:
        frame = base.rowsBetween(-(n - 1), 0) if include_current else base.rowsBetween(-n, -1)
        columns.append(_min_count(F.col(source), frame, aggregation, minimum).alias(output))
    return df.select("*", *columns)


def rolling_today(df: DataFrame, cell_col: str = "grid_id", date_col: str = "date", specs=INCLUSIVE_WINDOW_SPECS):
    """W1 with the reference's inclusive spec (rain 7/30 sum, temp 3 max, humidity 3 min)."""
    return rolling_rows(df, specs, True, cell_col, date_col)


def rolling_calendar(
    df: DataFrame,
    specs: Sequence[tuple] = PAST_WINDOW_SPECS,
    cell_col: str = "grid_id",
    date_col: str = "date",
) -> DataFrame:
    """W3 panel form: calendar window ``[D - n, D)`` on sparse series."""
    base = Window.partitionBy(cell_col).orderBy(F.unix_date(F.col(date_col)))
    columns = []
    for n, source, aggregation, minimum, output in specs:
        frame = base.rangeBetween(-n, -1)
        columns.append(_min_count(F.col(source), frame, aggregation, minimum).alias(output))
    return df.select("*", *columns)


def next_row_label(
    df: DataFrame,
    flag_col: str = "fire_today",
    label_col: str = "fire_next_day",
    cell_col: str = "grid_id",
    date_col: str = "date",
) -> DataFrame:
    """label = next row's flag (no gap check); last row per cell dropped."""
    w = Window.partitionBy(cell_col).orderBy(date_col)
    out = df.withColumn(label_col, F.lead(flag_col, 1).over(w))
    return out.filter(F.col(label_col).isNotNull()).withColumn(label_col, F.col(label_col).cast("int"))


def next_day_label(
    df: DataFrame,
    flag_col: str = "fire_today",
    label_col: str = "fire_next_day",
    cell_col: str = "grid_id",
    date_col: str = "date",
    extra_partition: Sequence[Column | str] = (),
) -> DataFrame:
    """Label only when the next row is exactly the next calendar day; else dropped."""
    w = Window.partitionBy(cell_col, *extra_partition).orderBy(date_col)
    next_date = F.lead(date_col, 1).over(w)
    next_flag = F.lead(flag_col, 1).over(w)
    out = df.withColumn(label_col, F.when(F.datediff(next_date, F.col(date_col)) == 1, next_flag))
    return out.filter(F.col(label_col).isNotNull()).withColumn(label_col, F.col(label_col).cast("int"))


def year_safe_features(
    df: DataFrame,
    specs: Sequence[tuple] = PAST_WINDOW_SPECS,
    flag_col: str = "fire_today",
    label_col: str = "fire_next_day",
    cell_col: str = "grid_id",
    date_col: str = "date",
) -> DataFrame:
    """W2 + W5 with windows that never cross a calendar year."""
    with_year = df.withColumn("_year", F.year(date_col))
    out = rolling_rows(with_year, specs, False, cell_col, date_col, extra_partition=["_year"])
    out = next_day_label(out, flag_col, label_col, cell_col, date_col, extra_partition=["_year"])
    return out.drop("_year")


def dedupe_keep(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    keep: str = "last",
) -> DataFrame:
    """W9 (keep="last") / W10 (keep="first"): one row per key by an explicit order.

    Written as ``max_by``/``min_by`` aggregation: partial aggregation runs
    before the shuffle, so a key with millions of copies never lands whole in
    one task (a per-key window would).
    """
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in others])
    pick = F.max_by(payload, order) if keep == "last" else F.min_by(payload, order)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def sequential_ids(
    cells: DataFrame,
    order_cols: Sequence[str] = ("ix", "iy"),
    output_col: str = "grid_id",
    fmt: str = "CA-%05d",
) -> DataFrame:
    """1-based ids in the order of ``order_cols``, formatted.

    The first column splits the grid: an id is the number of cells of smaller
    first columns (a running sum over one row per grid column) plus the position
    by the other columns inside its own.
    """
    first, *others = order_cols
    before = (
        cells.groupBy(F.col(first).alias("_first"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.orderBy("_first")) - F.col("_n"))
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy(first).orderBy(*(others or [first])))
    ranked = cells.withColumn("_inside", inside).join(before, F.col(first) == F.col("_first"))
    return ranked.withColumn(
        output_col, F.format_string(fmt, F.col("_before") + F.col("_inside"))
    ).drop("_first", "_before", "_inside")
