"""Query catalog: every operator bound to the driver's test tables.

Binding (see SURVEY 7.3): ``events`` stands in for the panel -- cell =
``user_id``, day = ``to_date(ts)``, detection = ``event_type = 'error'``,
measure = ``value``; ``customer`` is the static attribute table; ``orders``
gives multi-year history; ``documents`` joined to ``labels`` is a scored set
(score = ``n_chars``, label = ``quality``); ``embeddings`` and ``part`` feed the
spatial operators.

Each entry is ``(spark, sf_dir) -> DataFrame`` with an equivalent DuckDB SQL
string in :data:`ORACLE_SQL` (absent only for non-SQL operators).  Every query
reads whole tables.  Floating results that depend on summation order are
rounded the same way on both sides.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellcast.operators import panel as P
from cellcast.operators import ranking as R
from cellcast.operators import windows as W

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# --------------------------------------------------------------------------- #
# shared bindings
# --------------------------------------------------------------------------- #
CELL = "user_id"
DAY = "date"
EVENT_PAST_SPECS = [
    (7, "value_total", "sum", 3, "total_previous_7d"),
    (30, "value_total", "sum", 7, "total_previous_30d"),
    (3, "value_max", "max", 1, "max_previous_3d"),
    (3, "value_min", "min", 1, "min_previous_3d"),
]
EVENT_TODAY_SPECS = [
    (7, "value_total", "sum", 1, "total_7d"),
    (30, "value_total", "sum", 1, "total_30d"),
    (3, "value_max", "max", 1, "max_3d"),
    (3, "value_min", "min", 1, "min_3d"),
]
ROLL_OUT = [s[4] for s in EVENT_PAST_SPECS]
TODAY_OUT = [s[4] for s in EVENT_TODAY_SPECS]


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col(CELL), F.to_date("ts").alias(DAY), "event_type", "value", "event_id", "ts")


def sparse_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell-days that have events: counts, value measures, detections, flag."""
    d = event_days(spark, sf_dir)
    is_error = F.col("event_type") == "error"
    return d.groupBy(CELL, DAY).agg(
        F.count(F.lit(1)).alias("event_count"),
        r6(F.sum("value")).alias("value_total"),
        F.max("value").alias("value_max"),
        F.min("value").alias("value_min"),
        F.count_if(is_error).alias("error_count"),
        F.max(is_error.cast("int")).alias("fire_today"),
    )


def full_panel_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell x every day of the event calendar; no-event days: counts 0, measures null."""
    sparse = sparse_panel(spark, sf_dir)
    days = event_days(spark, sf_dir)
    start, end = P.calendar_bounds(days, DAY)
    cells = days.select(CELL).distinct()
    spine = P.calendar_spine(cells, start, end, CELL, DAY)
    return P.spine_fill(
        spine,
        sparse,
        [CELL, DAY],
        {"event_count": 0, "error_count": 0, "fire_today": 0},
        {"event_count": "long", "error_count": "long", "fire_today": "int"},
    )


SQL_DAYS = "SELECT user_id, CAST(ts AS DATE) AS date, event_type, value, event_id, ts FROM events"
SQL_SPARSE = f"""
sparse AS (
  SELECT user_id, date, COUNT(*) AS event_count, ROUND(SUM(value), 6) AS value_total,
         MAX(value) AS value_max, MIN(value) AS value_min,
         COUNT(*) FILTER (WHERE event_type = 'error') AS error_count,
         MAX(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS fire_today
  FROM ({SQL_DAYS}) d GROUP BY user_id, date)"""
SQL_FULL = f"""
d AS ({SQL_DAYS}),
{SQL_SPARSE.strip()},
cells AS (SELECT DISTINCT user_id FROM d),
cal AS (SELECT CAST(UNNEST(generate_series((SELECT MIN(date) FROM d), (SELECT MAX(date) FROM d), INTERVAL 1 DAY)) AS DATE) AS date),
panel AS (
  SELECT c.user_id, cal.date, COALESCE(s.event_count, 0) AS event_count, s.value_total, s.value_max,
         s.value_min, COALESCE(s.error_count, 0) AS error_count, COALESCE(s.fire_today, 0) AS fire_today
  FROM cells c CROSS JOIN cal LEFT JOIN sparse s ON s.user_id = c.user_id AND s.date = cal.date)"""


def _sql_min_count(source: str, agg: str, minimum: int, frame: str, out: str, rnd: bool) -> str:
    value = f"{agg.upper()}({source}) OVER ({frame})"
    if rnd:
        value = f"ROUND({value}, 6)"
    return f"CASE WHEN COUNT({source}) OVER ({frame}) >= {minimum} THEN {value} END AS {out}"


def _spark_round_sums(df: DataFrame, specs) -> DataFrame:
    for _, _, agg, _, out in specs:
        if agg == "sum":
            df = df.withColumn(out, r6(out))
    return df


# --------------------------------------------------------------------------- #
# A1 / A2 -- daily cell events
# --------------------------------------------------------------------------- #
@register(
    "daily_cell_events",
    """
SELECT user_id, CAST(ts AS DATE) AS date, 1 AS fire_present, COUNT(*) AS fire_count,
       ROUND(SUM(value), 6) AS total_frp, ROUND(AVG(value), 6) AS mean_frp, MAX(value) AS max_frp
FROM events WHERE event_type = 'error' GROUP BY 1, 2
""",
)
def q_daily_cell_events(spark, sf_dir):
    det = event_days(spark, sf_dir).filter(F.col("event_type") == "error")
    out = P.daily_cell_events_strict(det, CELL, DAY, "value")
    return out.withColumn("total_frp", r6("total_frp")).withColumn("mean_frp", r6("mean_frp"))


@register(
    "daily_cell_events_flagged",
    """
SELECT user_id, CAST(ts AS DATE) AS date, CAST(COUNT(*) AS INTEGER) AS fire_detection_count,
       MAX(value) AS maximum_frp, ROUND(AVG(value), 6) AS mean_frp, 1 AS fire_today
FROM events WHERE event_type = 'error' GROUP BY 1, 2
""",
)
def q_daily_cell_events_flagged(spark, sf_dir):
    det = event_days(spark, sf_dir).filter(F.col("event_type") == "error")
    return P.daily_cell_events(det, CELL, DAY, "value").withColumn("mean_frp", r6("mean_frp"))


# --------------------------------------------------------------------------- #
# J9/J5/J2/P8 -- full panel
# --------------------------------------------------------------------------- #
@register("full_panel", f"WITH {SQL_FULL.strip()} SELECT * FROM panel")
def q_full_panel(spark, sf_dir):
    return full_panel_df(spark, sf_dir)


# --------------------------------------------------------------------------- #
# W1 / W2 / W3 -- rolling windows
# --------------------------------------------------------------------------- #
def _rows_sql(specs, include_current: bool) -> str:
    parts = []
    for n, source, agg, minimum, out in specs:
        frame = (
            f"PARTITION BY user_id ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
            if include_current
            else f"PARTITION BY user_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING"
        )
        parts.append(_sql_min_count(source, agg, minimum, frame, out, agg == "sum"))
    return ",\n  ".join(parts)


def _range_sql(specs) -> str:
    parts = []
    for n, source, agg, minimum, out in specs:
        frame = (
            f"PARTITION BY user_id ORDER BY date "
            f"RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING"
        )
        parts.append(_sql_min_count(source, agg, minimum, frame, out, agg == "sum"))
    return ",\n  ".join(parts)


@register(
    "rolling_today",
    f"WITH {SQL_FULL.strip()} SELECT user_id, date, value_total, value_max, value_min,\n  "
    + _rows_sql(EVENT_TODAY_SPECS, True)
    + " FROM panel",
)
def q_rolling_today(spark, sf_dir):
    base = full_panel_df(spark, sf_dir).select(CELL, DAY, "value_total", "value_max", "value_min")
    out = W.rolling_rows(base, EVENT_TODAY_SPECS, True, CELL, DAY)
    return _spark_round_sums(out, EVENT_TODAY_SPECS)


@register(
    "rolling_past",
    f"WITH {SQL_FULL.strip()} SELECT user_id, date, value_total, value_max, value_min,\n  "
    + _rows_sql(EVENT_PAST_SPECS, False)
    + " FROM panel",
)
def q_rolling_past(spark, sf_dir):
    base = full_panel_df(spark, sf_dir).select(CELL, DAY, "value_total", "value_max", "value_min")
    out = W.rolling_rows(base, EVENT_PAST_SPECS, False, CELL, DAY)
    return _spark_round_sums(out, EVENT_PAST_SPECS)


@register(
    "rolling_past_calendar",
    f"WITH {SQL_SPARSE.strip()} SELECT user_id, date, value_total, value_max, value_min,\n  "
    + _range_sql(EVENT_PAST_SPECS)
    + " FROM sparse",
)
def q_rolling_past_calendar(spark, sf_dir):
    base = sparse_panel(spark, sf_dir).select(CELL, DAY, "value_total", "value_max", "value_min")
    out = W.rolling_calendar(base, EVENT_PAST_SPECS, CELL, DAY)
    return _spark_round_sums(out, EVENT_PAST_SPECS)


# --------------------------------------------------------------------------- #
# W4 / W5 -- labels
# --------------------------------------------------------------------------- #
@register(
    "next_row_label",
    f"""
WITH {SQL_SPARSE.strip()},
l AS (SELECT user_id, date, fire_today,
             LEAD(fire_today) OVER (PARTITION BY user_id ORDER BY date) AS fire_next_day FROM sparse)
SELECT user_id, date, fire_today, CAST(fire_next_day AS INTEGER) AS fire_next_day
FROM l WHERE fire_next_day IS NOT NULL
""",
)
def q_next_row_label(spark, sf_dir):
    base = sparse_panel(spark, sf_dir).select(CELL, DAY, "fire_today")
    return W.next_row_label(base, "fire_today", "fire_next_day", CELL, DAY)


@register(
    "next_day_label",
    f"""
WITH {SQL_SPARSE.strip()},
l AS (SELECT user_id, date, fire_today,
             CASE WHEN LEAD(date) OVER w - date = 1 THEN LEAD(fire_today) OVER w END AS fire_next_day
      FROM sparse WINDOW w AS (PARTITION BY user_id ORDER BY date))
SELECT user_id, date, fire_today, CAST(fire_next_day AS INTEGER) AS fire_next_day
FROM l WHERE fire_next_day IS NOT NULL
""",
)
def q_next_day_label(spark, sf_dir):
    base = sparse_panel(spark, sf_dir).select(CELL, DAY, "fire_today")
    return W.next_day_label(base, "fire_today", "fire_next_day", CELL, DAY)


# --------------------------------------------------------------------------- #
# Scored panel used by the ranking queries:
# label = next-calendar-day detection (W5), score = past 7-row value total
# --------------------------------------------------------------------------- #
def scored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = full_panel_df(spark, sf_dir).select(CELL, DAY, "value_total", "value_max", "value_min", "fire_today")
    feats = W.rolling_rows(base, EVENT_PAST_SPECS[:1], False, CELL, DAY)
    labelled = W.next_day_label(feats, "fire_today", "label", CELL, DAY)
    return labelled.select(
        CELL, DAY, "label", F.coalesce(r6("total_previous_7d"), F.lit(0.0)).alias("score")
    )


SQL_SCORED = f"""{SQL_FULL.strip()},
feats AS (
  SELECT user_id, date, fire_today,
         {_sql_min_count('value_total', 'sum', 3, 'PARTITION BY user_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING', 'total_previous_7d', True)},
         LEAD(date) OVER (PARTITION BY user_id ORDER BY date) AS next_date,
         LEAD(fire_today) OVER (PARTITION BY user_id ORDER BY date) AS next_flag
  FROM panel),
scored AS (
  SELECT user_id, date, CAST(next_flag AS INTEGER) AS label, COALESCE(total_previous_7d, 0.0) AS score
  FROM feats WHERE next_date - date = 1 AND next_flag IS NOT NULL)"""


# --------------------------------------------------------------------------- #
# W7 / W8 / F8 -- daily rank, percentile, tiers
# --------------------------------------------------------------------------- #
@register(
    "daily_rank",
    f"""
WITH {SQL_SCORED}
SELECT user_id, date, score,
       ROW_NUMBER() OVER (PARTITION BY date ORDER BY score DESC, user_id ASC) AS daily_rank,
       COUNT(*) OVER (PARTITION BY date) AS group_rows
FROM scored
""",
)
def q_daily_rank(spark, sf_dir):
    s = scored_panel(spark, sf_dir).select(CELL, DAY, "score")
    return R.ordinal_rank(s, [DAY], "score", [CELL], True, "daily_rank", "group_rows")


SQL_PERCENTILE = """(RANK() OVER (PARTITION BY date ORDER BY score) - 1
        + (COUNT(*) OVER (PARTITION BY date, score) + 1) / 2.0)
       / COUNT(*) OVER (PARTITION BY date)"""


@register(
    "daily_percentile",
    f"""
WITH {SQL_SCORED}
SELECT user_id, date, score, {SQL_PERCENTILE} AS daily_percentile
FROM scored
""",
)
def q_daily_percentile(spark, sf_dir):
    s = scored_panel(spark, sf_dir).select(CELL, DAY, "score")
    return R.average_percentile(s, [DAY], "score", "daily_percentile")
