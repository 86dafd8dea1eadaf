"""Cell-by-day panel operators: daily aggregation, spines, lookups, snapshots, splits.

All functions take and return DataFrames and take column names as
parameters, so they run on the domain tables and on any stand-in table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.fixed_values import (
    HISTORY_DAYS,
    HISTORY_YEARS,
    PAST_WINDOW_SPECS,
    SEASON_END,
    SEASON_START,
)
from cellcast.operators.contracts import (
    assert_unique,
    checked_join,
)


# --------------------------------------------------------------------------- #
# A1 / A2: daily cell events
# --------------------------------------------------------------------------- #
def daily_cell_events(
    events: DataFrame,
    cell_col: str = "grid_id",
    date_col: str = "date",
    measure_col: str | None = "frp",
) -> DataFrame:
    """A1: detections per cell and day: count, max and mean of the measure, flag = 1.

    The measure is optional, as in the reference.  Partial aggregation runs
    map-side, so a burst of detections in one cell does not reach one task
    unreduced.
    """
    aggs = [F.count(F.lit(1)).cast("int").alias("fire_detection_count")]
    if measure_col:
        aggs += [
            F.max(measure_col).alias("maximum_frp"),
            F.avg(measure_col).alias("mean_frp"),
        ]
    aggs.append(F.lit(1).cast("int").alias("fire_today"))
    return events.groupBy(cell_col, date_col).agg(*aggs)


def daily_cell_events_strict(
    events: DataFrame,
    cell_col: str = "grid_id",
    date_col: str = "date",
    measure_col: str = "frp",
) -> DataFrame:
    """A2: strict schema: fire_present = 1, fire_count, total/mean/max of the measure."""
    return events.groupBy(cell_col, date_col).agg(
        F.lit(1).cast("int").alias("fire_present"),
        F.count(F.lit(1)).alias("fire_count"),
        F.sum(measure_col).alias("total_frp"),
        F.avg(measure_col).alias("mean_frp"),
        F.max(measure_col).alias("max_frp"),
    )


# --------------------------------------------------------------------------- #
# Spines (J5 / J9-style products without a join)
# --------------------------------------------------------------------------- #
def date_bounds(df: DataFrame, date_col: str = "date") -> tuple[dt.date, dt.date]:
    """One small aggregate job: the first and last day present."""
    row = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    if row is None or row["lo"] is None:
        raise ValueError("No row has a date.")
    return row["lo"], row["hi"]


def calendar_spine(
    cells: DataFrame,
    start: dt.date | Column,
    end: dt.date | Column,
    cell_col: str = "grid_id",
    date_col: str = "date",
) -> DataFrame:
    """Every cell x every calendar day in [start, end].

    Generated per cell with ``sequence`` (a generator, not a join).  The
    bounds are plan literals or scalar subqueries (see :func:`calendar_bounds`).
    """
    s = start if isinstance(start, Column) else F.lit(start)
    e = end if isinstance(end, Column) else F.lit(end)
    days = F.sequence(s, e, F.expr("INTERVAL 1 DAY"))
    return cells.select(F.col(cell_col), F.explode(days).alias(date_col))


def calendar_bounds(df: DataFrame, date_col: str = "date") -> tuple[Column, Column]:
    """First and last day as scalar subqueries: evaluated once inside the
    query that uses them, with no separate driver round trip."""
    bounds = df.agg(F.struct(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).alias("b")).scalar()
    return bounds["lo"], bounds["hi"]


def spine_fill(
    spine: DataFrame,
    values: DataFrame,
    keys: Sequence[str],
    fill: dict[str, object],
    casts: dict[str, str] | None = None,
) -> DataFrame:
    """J2/J5 + P8: left join from the spine, fill defaults, cast.

    ``values`` must be unique on ``keys`` (one-to-one); that is what
    aggregation produces, so no extra check runs here.
    """
    joined = spine.join(values, list(keys), "left")
    casts = casts or {}
    out = joined
    for name, default in fill.items():
        column = F.coalesce(F.col(name), F.lit(default))
        if name in casts:
            column = column.cast(casts[name])
        out = out.withColumn(name, column)
    return out


def event_panel(
    weather: DataFrame,
    daily_events: DataFrame,
    cell_col: str = "grid_id",
    date_col: str = "date",
) -> DataFrame:
    """Daily events onto the (dense) weather panel; no event -> 0."""
    joined = weather.join(daily_events, [cell_col, date_col], "left")
    fills = {
        "fire_detection_count": ("int", 0),
        "fire_today": ("int", 0),
        "maximum_frp": ("double", 0.0),
        "mean_frp": ("double", 0.0),
    }
    for name, (kind, default) in fills.items():
        if name in daily_events.columns:
            joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)).cast(kind))
    return joined


def fill_static_defaults(panel: DataFrame) -> DataFrame:
    """Static attribute defaults (vegetation 0, fuel 0, missing flag 1, history 0)."""
    defaults = [
        ("vegetation_cover_mean", 0.0, "double"),
        ("fuel_model_dominant", 0, "int"),
        ("landfire_missing", 1, "int"),
        ("historical_firms_detection_count_2020_2023", 0, "int"),
    ]
    out = panel
    for name, default, kind in defaults:
        if name in out.columns:
            out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)).cast(kind))
    return out


# --------------------------------------------------------------------------- #
# Date-range filters (written as ranges so they push down)
# --------------------------------------------------------------------------- #
def season_bounds(year: int) -> tuple[dt.date, dt.date]:
    return dt.date(year, *SEASON_START), dt.date(year, *SEASON_END)


def in_season(date: Column) -> Column:
    """Row-level season test for any year: May 1 .. Oct 30 inclusive."""
    y = F.year(date)
    return date.between(
        F.make_date(y, F.lit(SEASON_START[0]), F.lit(SEASON_START[1])),
        F.make_date(y, F.lit(SEASON_END[0]), F.lit(SEASON_END[1])),
    )


def year_range_filter(df: DataFrame, date_col: str, first_year: int, last_year: int) -> DataFrame:
    """P4 as a date range, so Parquet min/max statistics can skip row groups."""
    return df.filter(
        (F.col(date_col) >= F.lit(dt.date(first_year, 1, 1)))
        & (F.col(date_col) < F.lit(dt.date(last_year + 1, 1, 1)))
    )


def history_trim(df: DataFrame, date_col: str, end: dt.date | Column, days: int = HISTORY_DAYS) -> DataFrame:
    """P5: keep ``[end - days, end]`` (days + 1 dates)."""
    end_col = end if isinstance(end, Column) else F.lit(end)
    return df.filter(F.col(date_col).between(F.date_sub(end_col, days), end_col))


# --------------------------------------------------------------------------- #
# A3 / A4: history summaries
# --------------------------------------------------------------------------- #
def history_summary(
    detections: DataFrame,
    all_cells: DataFrame | None = None,
    cell_col: str = "grid_id",
    date_col: str = "date",
    years: tuple[int, int] = HISTORY_YEARS,
) -> DataFrame:
    """A3: per cell over a fixed year range: detections, distinct days, distinct years.

    With ``all_cells`` every cell appears (zeros filled, int32), J5.  Detections
    are counted by day, days by year, years by cell: each step combines before
    its shuffle, and no row is expanded for a distinct count.
    """
    first, last = years
    suffix = f"{first}_{last}"
    rows = year_range_filter(detections.select(cell_col, date_col), date_col, first, last)
    daily = rows.groupBy(cell_col, date_col).agg(F.count(F.lit(1)).alias("_n"))
    yearly = daily.groupBy(cell_col, F.year(date_col).alias("_year")).agg(
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_days")
    )
    summary = yearly.groupBy(cell_col).agg(
        F.sum("_n").alias(f"historical_firms_detection_count_{suffix}"),
        F.sum("_days").alias(f"historical_fire_active_days_{suffix}"),
        F.count(F.lit(1)).alias(f"historical_fire_active_years_{suffix}"),
    )
    value_cols = [c for c in summary.columns if c != cell_col]
    if all_cells is not None:
        assert_unique(all_cells, [cell_col], "The grid")
        summary = all_cells.select(cell_col).join(summary, cell_col, "left")
    return summary.select(
        cell_col, *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in value_cols]
    )


def season_summary(
    daily: DataFrame,
    all_cells: DataFrame,
    history_years: Sequence[int],
    cell_col: str = "grid_id",
    date_col: str = "date",
    count_col: str = "fire_count",
) -> DataFrame:
    """A4: prior-year season summary for several years in one aggregation.

    Per (cell, history year): detections summed over May 1..Oct 30, distinct
    active days, log1p of the sum; every cell appears for every year (zeros).
    """
    years = sorted(set(int(y) for y in history_years))
    first, last = years[0], years[-1]
    rows = year_range_filter(daily, date_col, first, last).filter(in_season(F.col(date_col)))
    rows = rows.withColumn("history_year", F.year(date_col)).filter(
        F.col("history_year").isin(years)
    )
    agg = rows.groupBy(cell_col, "history_year").agg(
        F.sum(count_col).alias("prior_year_firms_detection_count"),
        F.countDistinct(date_col).alias("prior_year_firms_active_days"),
    )
    spine = all_cells.select(cell_col).withColumn(
        "history_year", F.explode(F.array(*[F.lit(y) for y in years]))
    )
    summary = spine.join(agg, [cell_col, "history_year"], "left")
    count = F.coalesce(F.col("prior_year_firms_detection_count"), F.lit(0)).cast("int")
    days = F.coalesce(F.col("prior_year_firms_active_days"), F.lit(0)).cast("int")
    hy = F.col("history_year")
    return summary.select(
        cell_col,
        hy.cast("int").alias("history_year"),
        (hy + 1).cast("int").alias("feature_year"),
        F.make_date(hy, F.lit(SEASON_START[0]), F.lit(SEASON_START[1])).alias("window_start"),
        F.make_date(hy, F.lit(SEASON_END[0]), F.lit(SEASON_END[1])).alias("window_end"),
        count.alias("prior_year_firms_detection_count"),
        F.log1p(count).alias("prior_year_firms_detection_count_log"),
        days.alias("prior_year_firms_active_days"),
    )


def yearly_summary(
    daily: DataFrame,
    cell_col: str = "grid_id",
    date_col: str = "date",
    count_col: str = "fire_count",
    history_years: Sequence[int] | None = None,
) -> DataFrame:
    """A4, whole-year flavour: per (cell, calendar year) the summed detections
    and distinct active days, keyed for the next year; active cells only (the
    lenient lookup fills the rest with 0).  Counts below 1 are rejected."""
    if daily.filter(F.col(count_col) < 1).limit(1).count():
        raise ValueError("A day counts less than one detection.")
    rows = daily
    if history_years:
        rows = year_range_filter(rows, date_col, min(history_years), max(history_years))
    return rows.groupBy(cell_col, F.year(date_col).alias("history_year")).agg(
        F.sum(count_col).cast("long").alias("prior_year_firms_detection_count"),
        F.countDistinct(date_col).alias("prior_year_firms_active_days"),
    ).select(
        cell_col,
        (F.col("history_year") + 1).cast("int").alias("feature_year"),
        "prior_year_firms_detection_count",
        "prior_year_firms_active_days",
    )


# --------------------------------------------------------------------------- #
# Year-shifted lookup
# --------------------------------------------------------------------------- #
def prior_year_lookup(
    panel: DataFrame,
    summary: DataFrame,
    cell_col: str = "grid_id",
    date_col: str = "date",
    value_cols: Sequence[str] = (
        "prior_year_firms_detection_count",
        "prior_year_firms_detection_count_log",
        "prior_year_firms_active_days",
    ),
    strict: bool = False,
) -> DataFrame:
    """Attach the summary of year Y-1 to rows of year Y (never the same year).

    Lenient: misses become 0.  Strict: a miss raises (one count job).
    """
    right = summary.select(cell_col, F.col("feature_year").cast("int").alias("_fy"), *value_cols)
    left = panel.withColumn("_fy", F.year(date_col).cast("int"))
    joined = checked_join(left, right, [cell_col, "_fy"], "left", validate="many_to_one", check_left=False)
    if strict:
        misses = joined.filter(F.col(value_cols[0]).isNull()).limit(1).count()
        if misses:
            raise ValueError("Some cells have no season of the year before.")
    out = joined
    for c in value_cols:
        kind = dict(summary.dtypes)[c]
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast(kind))
    return out.drop("_fy")


# --------------------------------------------------------------------------- #
# A5 / W3 (snapshot form): past calendar-window aggregates for one date
# --------------------------------------------------------------------------- #
def _agg_fn(name: str):
    return {"sum": F.sum, "max": F.max, "min": F.min}[name]


def past_window_snapshot(
    history: DataFrame,
    feature_date: dt.date | Column,
    specs: Sequence[tuple] = PAST_WINDOW_SPECS,
    cell_col: str = "grid_id",
    date_col: str = "date",
) -> DataFrame:
    """A5: per cell, aggregates over ``[D - days, D)`` with a minimum non-null count.

    All specs are computed in one grouped aggregation over the widest window;
    below the minimum the value is null.
    """
    d = feature_date if isinstance(feature_date, Column) else F.lit(feature_date)
    widest = max(spec[0] for spec in specs)
    rows = history.filter((F.col(date_col) >= F.date_sub(d, widest)) & (F.col(date_col) < d))
    aggs = []
    for days, column, aggregation, minimum, output in specs:
        in_window = F.col(date_col) >= F.date_sub(d, days)
        value = F.when(in_window, F.col(column))
        aggs.append(
            F.when(F.count(value) >= minimum, _agg_fn(aggregation)(value)).alias(output)
        )
    return rows.groupBy(cell_col).agg(*aggs)


def select_feature_date(
    weather: DataFrame, date_col: str = "date", feature_date: dt.date | str | None = None
) -> dt.date:
    """The given date, else the newest date present."""
    if feature_date is not None:
        if isinstance(feature_date, str):
            return dt.date.fromisoformat(feature_date)
        return feature_date
    newest = weather.agg(F.max(date_col)).first()[0]
    if newest is None:
        raise ValueError(f"No date in column {date_col}.")
    return newest


# --------------------------------------------------------------------------- #
# Temporal splits
# --------------------------------------------------------------------------- #
def temporal_split(
    df: DataFrame,
    date_col: str,
    validation_start: dt.date | str,
    test_start: dt.date | str,
    test_end_exclusive: dt.date | str | None = None,
    split_col: str = "split",
) -> DataFrame:
    """Label rows train / validation / test by date (test end optional, exclusive)."""
    vs = F.lit(_as_date(validation_start))
    ts = F.lit(_as_date(test_start))
    d = F.col(date_col)
    test_cond = d >= ts
    if test_end_exclusive is not None:
        test_cond = test_cond & (d < F.lit(_as_date(test_end_exclusive)))
    label = (
        F.when(d < vs, F.lit("train"))
        .when((d >= vs) & (d < ts), F.lit("validation"))
        .when(test_cond, F.lit("test"))
    )
    return df.withColumn(split_col, label)


def split_summary(df: DataFrame, date_col: str, label_col: str, split_cols: Sequence[str]) -> DataFrame:
    """One aggregate for every split: first/last day, rows, positives."""
    return df.filter(F.col(split_cols[-1]).isNotNull()).groupBy(*split_cols).agg(
        F.min(date_col).alias("start_date"),
        F.max(date_col).alias("end_date"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label_col).cast("long")).alias("positives"),
    )


def check_split_summary(summary_rows: list, require_positives: bool = True) -> None:
    """Raise on empty splits, splits without positives, or broken chronology.

    ``summary_rows`` are the few rows of :func:`split_summary` (one per split).
    """
    by = {r["split"]: r for r in summary_rows}
    for name in ("train", "validation", "test"):
        row = by.get(name)
        if row is None or row["rows"] == 0:
            raise ValueError(f"The {name} slice holds no row.")
        if require_positives and not row["positives"]:
            raise ValueError(f"The {name} slice holds no positive row.")
    if not (
        by["train"]["end_date"]
        < by["validation"]["start_date"]
        <= by["validation"]["end_date"]
        < by["test"]["start_date"]
    ):
        raise ValueError("The slices overlap in time or are out of order.")


def fold_split(df: DataFrame, date_col: str, folds: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rows x folds, each row labelled per fold, rows outside a fold dropped.

    Folds are a short literal list; each row is exploded over the folds it
    belongs to (no join).
    """
    d = F.col(date_col)
    entries = []
    for name, validation_start, test_start, test_end in folds:
        vs, ts, te = (F.lit(_as_date(x)) for x in (validation_start, test_start, test_end))
        split = (
            F.when(d < vs, F.lit("train"))
            .when(d < ts, F.lit("validation"))
            .when(d < te, F.lit("test"))
        )
        entries.append(F.struct(F.lit(name).alias("fold"), split.alias("split")))
    exploded = df.withColumn("_fold", F.explode(F.array(*entries)))
    return (
        exploded.filter(F.col("_fold.split").isNotNull())
        .withColumn("fold", F.col("_fold.fold"))
        .withColumn("split", F.col("_fold.split"))
        .drop("_fold")
    )


def _as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


# --------------------------------------------------------------------------- #
# Dense panel -> positive cell-days in the strict schema
# --------------------------------------------------------------------------- #
def positive_cell_days(panel: DataFrame, cell_col: str = "grid_id", date_col: str = "date") -> DataFrame:
    return panel.filter(F.col("fire_today") == 1).select(
        cell_col,
        date_col,
        F.lit(1).cast("int").alias("fire_present"),
        F.col("fire_detection_count").cast("long").alias("fire_count"),
    )
