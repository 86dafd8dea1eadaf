"""The training table and the model panel.

``build_training_table`` is the published table: weather panel + daily
detections (J2, zero-filled) + static attributes and history (J1, checked
many-to-one lookups) + defaults (P8) + rolling windows
that include the day (W1) + next-row label (W4).

``build_model_panel`` is the stricter form the models train on: past-only
windows and next-calendar-day label that never cross a year (W6), the
prior-year season summary (J3), and rows with missing inputs dropped (P7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.fixed_values import INCLUSIVE_WINDOW_SPECS, PAST_WINDOW_SPECS
from cellcast.operators import contracts as C
from cellcast.operators import panel as P
from cellcast.operators import windows as W


def lookup(panel: DataFrame, dim: DataFrame, key: str, source: str) -> DataFrame:
    """Many-to-one left lookup; a dimension with two rows of a key fails the job that reads it.

    The check is part of the plan, and the join is left to the optimizer, which
    broadcasts the dimension by its measured size.
    """
    return panel.join(C.unique_side(dim, [key], source), key, "left")


def build_training_table(
    weather: DataFrame,
    daily_events: DataFrame,
    static: DataFrame,
    history: DataFrame,
    key: str = "grid_id",
    date_col: str = "date",
) -> DataFrame:
    """No contract starts a job: keys are checked in the plan, while the table is written."""
    static_cols = [c for c in static.columns if c != key and c not in weather.columns]
    history_cols = [c for c in history.columns if c != key and c not in weather.columns]
    data = P.event_panel(weather, daily_events, key, date_col)
    data = lookup(data, static.select(key, *static_cols), key, "Static attributes")
    data = lookup(data, history.select(key, *history_cols), key, "History summary")
    data = P.fill_static_defaults(data)
    data = C.unique_days(data, key, date_col, "Weather panel")
    data = W.rolling_rows(data, INCLUSIVE_WINDOW_SPECS, True, key, date_col)
    return W.next_row_label(data, "fire_today", "fire_next_day", key, date_col)


def build_model_panel(
    panel: DataFrame,
    season_summary: DataFrame | None,
    required: Sequence[str],
    key: str = "grid_id",
    date_col: str = "date",
    strict_history: bool = True,
    static: DataFrame | None = None,
    specs: Sequence[tuple] = PAST_WINDOW_SPECS,
    flag_col: str = "fire_today",
    label_col: str = "fire_next_day",
) -> DataFrame:
    """E2's panel: year-safe windows and labels (W6), prior-year season (J3), static
    attributes (J1).

    A row that lacks one of the ``required`` values fails the job (P9); rows without
    enough days before them for the windows are left out (P7).  A season that is
    missing for a cell and year fails it too, unless ``strict_history`` is off.
    """
    data = C.unique_days(panel, key, date_col, "Panel")
    data = W.year_safe_features(data, specs, flag_col, label_col, key, date_col)
    if season_summary is not None:
        data = season_lookup(data, season_summary, key, date_col, strict_history)
    if static is not None:
        data = lookup(data, static, key, "Static attributes")
    # Both rules in one condition: a filter of its own would let rows go unchecked.
    message = F.concat(F.lit("A row lacks a current, static or seasonal value, such as one of "), F.col(key).cast("string"))
    windows = C.incomplete_rows(data, [s[4] for s in specs])
    return data.where(C.guard(~windows, C.incomplete_rows(data, list(required)), message))


def season_lookup(panel: DataFrame, summary: DataFrame, key: str, date_col: str, strict: bool) -> DataFrame:
    """J3 inside the plan: the season of year Y-1 at rows of year Y; a miss raises or counts as 0."""
    values = [c for c in summary.columns if c.startswith("prior_year_")]
    right = summary.select(key, F.col("feature_year").cast("int").alias("_year"), *values)
    right = C.unique_side(right, [key, "_year"], "Season summary").withColumn("_met", F.lit(True))
    out = panel.withColumn("_year", F.year(date_col)).join(right, [key, "_year"], "left")
    if strict:
        message = F.concat(F.lit("No prior-year season for "), F.to_json(F.struct(key, "_year")))
        out = out.withColumn(key, C.guard(F.col(key), F.col("_met").isNull(), message))
    types = dict(summary.dtypes)
    filled = {c: F.coalesce(F.col(c), F.lit(0)).cast(types[c]) for c in values}
    return out.withColumns(filled).drop("_year", "_met")
