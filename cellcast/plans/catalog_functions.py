"""Catalog: scalar functions and remaining contracts on the whole test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cellcast.functions import categories as FC
from cellcast.functions import dates as FD
from cellcast.functions.display import is_stale
from cellcast.operators import contracts as C
from cellcast.operators import panel as P
from cellcast.plans.catalog import CELL, DAY, register, table


# --------------------------------------------------------------------------- #
# Detection date + HHMM (leading zeros lost) -> timestamp -> day
# --------------------------------------------------------------------------- #
@register(
    "detection_times",
    """
WITH d AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS acq_date,
                  CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS acq_time FROM events),
t AS (SELECT *, lpad(CAST(acq_time AS VARCHAR), 4, '0') AS hhmm FROM d),
u AS (SELECT *, CAST(strptime(acq_date || ' ' || substr(hhmm, 1, 2) || ':' || substr(hhmm, 3, 2), '%Y-%m-%d %H:%M') AS TIMESTAMP) AS detected_at FROM t)
SELECT event_id, acq_time, hhmm, detected_at, CAST(detected_at AS DATE) AS date,
       strftime(detected_at, '%Y-%m') AS month, strftime(detected_at, '%m-%d') AS month_day,
       CAST(detected_at AS DATE) + 1 AS next_day
FROM u""",
)
def q_detection_times(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("acq_date"),
        (F.hour("ts") * 100 + F.minute("ts")).cast("int").alias("acq_time"),
    )
    ts = FD.detection_timestamp(F.col("acq_date"), F.col("acq_time"))
    out = ev.select("event_id", "acq_time", FD.hhmm(F.col("acq_time")).alias("hhmm"), ts.cast("timestamp_ntz").alias("detected_at"))
    day = FD.naive_day(F.col("detected_at"))
    return out.select(
        "event_id", "acq_time", "hhmm", "detected_at", day.alias("date"),
        FD.month_key(F.col("detected_at")).alias("month"), FD.month_day(F.col("detected_at")).alias("month_day"),
        FD.next_day(day).alias("next_day"),
    )


# --------------------------------------------------------------------------- #
# Numeric coercion, missing flag as string
# --------------------------------------------------------------------------- #
@register(
    "numeric_coercion",
    """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS prop_k_number,
       TRY_CAST(event_type AS DOUBLE) AS event_type_number,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 'false' ELSE 'true' END AS missing_flag
FROM events""",
)
def q_numeric_coercion(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    flag = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type") != "view")
    return ev.select(
        "event_id",
        FC.numeric_or_null(F.get_json_object("props", "$.k")).alias("prop_k_number"),
        FC.numeric_or_null(F.col("event_type")).alias("event_type_number"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(FC.missing_flag_string(flag)).alias("missing_flag"),
    )


# --------------------------------------------------------------------------- #
# stale flag of the newest prediction day against a given "now"
# --------------------------------------------------------------------------- #
STALE_NOW = dt.datetime(2024, 1, 31, 12, 0, 0)


@register(
    "stale_flag",
    f"""
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) + 1 AS prediction_date FROM events)
SELECT prediction_date, CAST(CAST(prediction_date AS VARCHAR) || ' 23:59:59' AS TIMESTAMP) < TIMESTAMP '{STALE_NOW}' AS stale FROM d""",
)
def q_stale_flag(spark, sf_dir):
    d = table(spark, sf_dir, "events").select(F.date_add(F.to_date("ts"), 1).alias("prediction_date")).distinct()
    return d.select("prediction_date", is_stale(F.col("prediction_date"), F.lit(STALE_NOW).cast("timestamp")).alias("stale"))


# --------------------------------------------------------------------------- #
# A7 / A8 / P12 / P13 / S13 as queries
# --------------------------------------------------------------------------- #
@register("static_slice", "SELECT DISTINCT c_custkey, c_nationkey, c_mktsegment FROM customer")
def q_static_slice(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return C.static_slice(c, "c_custkey", ["c_nationkey", "c_mktsegment"])


@register(
    "conservation",
    """
WITH before AS (SELECT COUNT(*) AS n FROM events WHERE event_type = 'error'),
after AS (SELECT SUM(c) AS n FROM (SELECT COUNT(*) AS c FROM events WHERE event_type = 'error' GROUP BY user_id, CAST(ts AS DATE)))
SELECT before.n AS detections_before, after.n AS detections_after, before.n = after.n AS conserved FROM before, after""",
)
def q_conservation(spark, sf_dir):
    det = table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(CELL, F.to_date("ts").alias(DAY))
    daily = P.daily_cell_events_strict(det.withColumn("frp", F.lit(0.0)), CELL, DAY, "frp")
    before = det.agg(F.count(F.lit(1)).alias("detections_before"))
    after = daily.agg(F.sum("fire_count").alias("detections_after"))
    out = C.side_by_side(before, after)
    return out.withColumn("conserved", F.col("detections_before") == F.col("detections_after"))


@register(
    "source_values",
    """SELECT list_sort(list(DISTINCT event_type)) AS values, COUNT(DISTINCT event_type) = 1 AS single_source FROM events""",
)
def q_source_values(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.agg(F.sort_array(F.collect_set("event_type")).alias("values")).withColumn(
        "single_source", F.size("values") == 1
    )


@register(
    "coercion_report",
    """
SELECT COUNT(*) FILTER (WHERE d IS NULL OR TRY_CAST(d AS DATE) IS NULL) AS invalid_dates,
       COUNT(*) FILTER (WHERE value IS NULL OR isnan(value)) AS missing_value
FROM (SELECT strftime(ts, '%Y-%m-%d') AS d, value FROM events)""",
)
def q_coercion_report(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("d"), "value")
    return C.coercion_report(ev, "d", "yyyy-MM-dd", ["value"])


@register(
    "day_completeness",
    """
WITH per_day AS (SELECT CAST(ts AS DATE) AS date, COUNT(DISTINCT user_id) AS cells FROM events GROUP BY 1),
allc AS (SELECT COUNT(DISTINCT user_id) AS n FROM events)
SELECT date, cells, cells = allc.n AS complete FROM per_day, allc""",
)
def q_day_completeness(spark, sf_dir):
    """S13 for every day at once: distinct cells on the day vs in the grid."""
    ev = table(spark, sf_dir, "events").select(CELL, F.to_date("ts").alias(DAY))
    per_day = ev.groupBy(DAY).agg(F.countDistinct(CELL).alias("cells"))
    total = ev.agg(F.countDistinct(CELL).alias("_n"))
    return C.side_by_side(per_day, total).select(DAY, "cells", (F.col("cells") == F.col("_n")).alias("complete"))
