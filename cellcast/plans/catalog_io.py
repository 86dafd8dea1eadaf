"""Catalog: payload parsing, request plans, triage, publishing, leakage audit,
the E1 training table and model scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.fixed_values import (
    CONDITION_FALLBACK,
    CONDITION_PHRASES,
    CONDITION_PREFIX,
    CONDITION_SUFFIX,
    INCLUSIVE_WINDOW_SPECS,
    PUBLISH_AREA,
)
from cellcast.functions.display import condition_summary
from cellcast.operators import panel as P
from cellcast.operators import windows as W
from cellcast.plans.backtest import perturbation_audit
from cellcast.plans.catalog import (
    CELL,
    DAY,
    EVENT_PAST_SPECS,
    EVENT_TODAY_SPECS,
    SQL_FULL,
    SQL_SPARSE,
    _rows_sql,
    full_panel_df,
    r6,
    register,
    sparse_panel,
    table,
)
from cellcast.plans.daily_scoring import document_header, publish_locations, with_header
from cellcast.plans.training_table import build_training_table
from cellcast.session import cut_lineage
from cellcast.sources import payload as S


def r10(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 10)


# --------------------------------------------------------------------------- #
# S11 -- request plans
# --------------------------------------------------------------------------- #
BLOCK_DAYS = 5
BATCH_SIZE = 10


@register(
    "date_blocks",
    f"""WITH d AS (SELECT CAST(ts AS DATE) AS date FROM events),
b AS (SELECT MIN(date) AS s, MAX(date) AS e FROM d),
blk AS (SELECT CAST(UNNEST(generate_series(b.s, b.e, INTERVAL {BLOCK_DAYS} DAY)) AS DATE) AS block_start, b.e FROM b)
SELECT block_start, CAST(LEAST({BLOCK_DAYS}, e - block_start + 1) AS INTEGER) AS day_count FROM blk""",
)
def q_date_blocks(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias(DAY))
    bounds = days.agg(F.min(DAY).alias("s"), F.max(DAY).alias("e"))
    return bounds.select(F.explode(S.date_blocks(F.col("s"), F.col("e"), BLOCK_DAYS)).alias("b")).select(
        "b.block_start", F.col("b.day_count").cast("int").alias("day_count")
    )


@register(
    "cell_batches",
    f"""SELECT user_id, CAST((rn - 1) // {BATCH_SIZE} + 1 AS BIGINT) AS batch_number,
       CAST((rn - 1) % {BATCH_SIZE} AS INTEGER) AS position
FROM (SELECT user_id, ROW_NUMBER() OVER (ORDER BY user_id) AS rn FROM (SELECT DISTINCT user_id FROM events))""",
)
def q_cell_batches(spark, sf_dir):
    cells = table(spark, sf_dir, "events").select(CELL).distinct()
    return S.cell_batches(cells, BATCH_SIZE, CELL)


# --------------------------------------------------------------------------- #
# S5 / S6 -- columnar payloads rebuilt per batch from the events, then parsed
# --------------------------------------------------------------------------- #
PAYLOAD_VARS = ["value_total", "value_max"]


def _field(name: str):
    return lambda x: x[name]


def build_payloads(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Landed-payload stand-in: one JSON text per request batch, locations in
    request order, each with columnar daily arrays (the feed's layout)."""
    cells = table(spark, sf_dir, "events").select(CELL).distinct()
    requests = S.cell_batches(cells, BATCH_SIZE, CELL)
    sparse = sparse_panel(spark, sf_dir)
    ev = table(spark, sf_dir, "events").groupBy(CELL).agg(
        F.min("value").alias("latitude"), F.max("value").alias("longitude"), F.count(F.lit(1)).cast("double").alias("elevation")
    )
    series = sparse.groupBy(CELL).agg(
        F.array_sort(F.collect_list(F.struct(F.date_format(DAY, "yyyy-MM-dd").alias("t"), *PAYLOAD_VARS))).alias("s")
    )
    loc = (
        requests.join(ev, CELL).join(series, CELL)
        .select(
            "batch_number",
            "position",
            F.struct(
                "latitude",
                "longitude",
                "elevation",
                F.struct(
                    F.transform("s", lambda x: x["t"]).alias("time"),
                    *[F.transform("s", _field(v)).alias(v) for v in PAYLOAD_VARS],
                ).alias("daily"),
            ).alias("loc"),
        )
    )
    payloads = loc.groupBy("batch_number").agg(
        F.array_sort(F.collect_list(F.struct("position", "loc"))).alias("locs")
    )
    text = F.to_json(F.transform("locs", lambda x: x["loc"]))
    # A one-location batch is landed as a bare object (S6 path).
    text = F.when(F.size("locs") == 1, F.to_json(F.col("locs")[0]["loc"])).otherwise(text)
    return payloads.select("batch_number", text.alias("payload")), requests


@register(
    "payload_flatten",
    f"""WITH {SQL_SPARSE.strip()},
rq AS (SELECT user_id, CAST((rn - 1) // {BATCH_SIZE} + 1 AS BIGINT) AS batch_number, CAST((rn - 1) % {BATCH_SIZE} AS INTEGER) AS position
       FROM (SELECT user_id, ROW_NUMBER() OVER (ORDER BY user_id) AS rn FROM (SELECT DISTINCT user_id FROM events))),
ev AS (SELECT user_id, MIN(value) AS weather_latitude, MAX(value) AS weather_longitude, CAST(COUNT(*) AS DOUBLE) AS elevation FROM events GROUP BY 1)
SELECT rq.user_id, rq.batch_number, rq.position, ev.weather_latitude, ev.weather_longitude, ev.elevation,
       s.date, s.value_total, s.value_max
FROM rq JOIN ev ON ev.user_id = rq.user_id JOIN sparse s ON s.user_id = rq.user_id""",
)
def q_payload_flatten(spark, sf_dir):
    payloads, requests = build_payloads(spark, sf_dir)
    rows, rejected = S.flatten_payload(payloads, requests, PAYLOAD_VARS)
    return rows


# --------------------------------------------------------------------------- #
# S7 -- raw text triage over pages and documents
# --------------------------------------------------------------------------- #
@register(
    "payload_triage",
    r"""WITH raw AS (SELECT 'pages' AS source, html AS value FROM pages UNION ALL SELECT 'documents', text FROM documents),
t AS (SELECT source, regexp_replace(COALESCE(value, ''), '^\s+|\s+$', '', 'g') AS v FROM raw)
SELECT source, CASE WHEN v = '' THEN 'empty' WHEN starts_with(v, '<') THEN 'html'
                    WHEN starts_with(lower(v), 'invalid') THEN 'invalid' ELSE 'good' END AS status,
       COUNT(*) AS rows
FROM t GROUP BY 1, 2""",
)
def q_payload_triage(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), F.col("html").alias("value"))
    docs = table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("text").alias("value"))
    raw = pages.unionByName(docs).withColumn(
        "value", F.regexp_replace(F.coalesce(F.col("value"), F.lit("")), r"^\s+|\s+$", "")
    )
    return S.triage_payloads(raw, "value").groupBy("source", "status").agg(F.count(F.lit(1)).alias("rows"))


# --------------------------------------------------------------------------- #
# K4 / F9 / F17-F19 -- published document, compared field by field
# --------------------------------------------------------------------------- #
PUBLISH_THRESHOLD = 100.0


def _publish_features(spark, sf_dir) -> DataFrame:
    panel = full_panel_df(spark, sf_dir)
    feats = W.rolling_rows(panel, EVENT_PAST_SPECS[:1], False, CELL, DAY)
    day = P.select_feature_date(feats, DAY)
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(CELL), F.col("c_nationkey").alias("fuel_model_dominant"))
    today = feats.filter(F.col(DAY) == F.lit(day)).join(cust, CELL, "left")
    return today.select(
        CELL,
        (F.lit(32.5) + F.col(CELL) * F.lit(0.05)).alias("centroid_lat"),
        (F.lit(-124.0) + F.col(CELL) * F.lit(0.07)).alias("centroid_lon"),
        "fuel_model_dominant",
        F.col("value_max").alias("temperature_max"),
        F.col("value_min").alias("humidity_min"),
        F.col("event_count").cast("double").alias("wind_speed_max"),
        F.col("value_total").alias("precipitation_total"),
        F.coalesce(r6("total_previous_7d"), F.lit(0.0)).alias("model_score"),
    ), day


@register(
    "publish_json",
    f"""WITH {SQL_FULL.strip()},
f AS (SELECT *, {_rows_sql(EVENT_PAST_SPECS[:1], False)} FROM panel),
dm AS (SELECT MAX(date) AS d FROM f),
t AS (SELECT f.user_id, CAST(32.5 AS DOUBLE) + f.user_id * CAST(0.05 AS DOUBLE) AS lat,
             CAST(-124.0 AS DOUBLE) + f.user_id * CAST(0.07 AS DOUBLE) AS lng, c.c_nationkey AS fuel,
             f.value_max AS temperature_max, f.value_min AS humidity_min, CAST(f.event_count AS DOUBLE) AS wind,
             f.value_total AS rain, COALESCE(f.total_previous_7d, 0.0) AS score
      FROM f JOIN dm ON f.date = dm.d LEFT JOIN customer c ON c.c_custkey = f.user_id),
p AS (SELECT *, (RANK() OVER (ORDER BY score) - 1 + (COUNT(*) OVER (PARTITION BY score) + 1) / 2.0) / COUNT(*) OVER () * 100 AS pct FROM t),
loc AS (
  SELECT CAST(user_id AS VARCHAR) AS id, 'Grid ' || CAST(user_id AS VARCHAR) AS name, '{PUBLISH_AREA}' AS area,
         round_even(lat, 6) AS lat, round_even(lng, 6) AS lng, 'LANDFIRE fuel model ' || CAST(fuel AS VARCHAR) AS forest_type,
         round_even(pct, 1) AS risk_score,
         CASE WHEN pct >= 99 THEN 'Extreme' WHEN pct >= 95 THEN 'High' WHEN pct >= 90 THEN 'Medium' ELSE 'Low' END AS risk_level,
         round_even(score, 8) AS model_score, score >= {PUBLISH_THRESHOLD} AS above_model_threshold,
         round_even(temperature_max, 1) AS temperature_max_c, round_even(humidity_min, 1) AS humidity_min_percent,
         round_even(wind, 1) AS wind_speed_max_kmh, round_even(rain, 2) AS precipitation_mm
  FROM p)
SELECT (SELECT CAST(d AS VARCHAR) FROM dm) AS feature_date, (SELECT CAST(d + 1 AS VARCHAR) FROM dm) AS prediction_date,
       CAST((SELECT COUNT(*) FROM loc) AS INTEGER) AS grid_count, loc.*,
       '{CONDITION_PREFIX}' || CASE WHEN len(ph) = 0 THEN '{CONDITION_FALLBACK}' ELSE array_to_string(ph[1:3], ', ') END || '{CONDITION_SUFFIX}' AS explanation
FROM loc, LATERAL (SELECT list_filter([{', '.join(
        f"CASE WHEN {dict(temperature_max='temperature_max_c', humidity_min='humidity_min_percent', wind_speed_max='wind_speed_max_kmh', precipitation_total='precipitation_mm')[c]} {op} {lim} THEN '{ph}' END"
        for c, op, lim, ph in CONDITION_PHRASES)}], lambda x: x IS NOT NULL) AS ph)""",
)
def q_publish_json(spark, sf_dir):
    feats, day = _publish_features(spark, sf_dir)
    locations = publish_locations(feats, PUBLISH_THRESHOLD, CELL)
    import datetime as dt

    flat = with_header(locations, document_header(day, day + dt.timedelta(days=1), "stand-in", "fixed"))
    c = F.col("conditions")
    return flat.select(
        "feature_date",
        "prediction_date",
        "grid_count",
        "id", "name", "area", "lat", "lng", "forest_type", "risk_score", "risk_level", "model_score", "above_model_threshold",
        c["temperature_max_c"].alias("temperature_max_c"),
        c["humidity_min_percent"].alias("humidity_min_percent"),
        c["wind_speed_max_kmh"].alias("wind_speed_max_kmh"),
        c["precipitation_mm"].alias("precipitation_mm"),
        condition_summary(
            c["temperature_max_c"], c["humidity_min_percent"], c["wind_speed_max_kmh"], c["precipitation_mm"]
        ).alias("explanation"),
    )


# --------------------------------------------------------------------------- #
# M8 -- past-only perturbation audit (a leaky inclusive window must be caught)
# --------------------------------------------------------------------------- #
PERTURB = {"value_total": 999999.0, "value_max": 999999.0, "value_min": -999999.0}


def _audit_sql(specs, include_current: bool, name: str) -> str:
    feats = _rows_sql(specs, include_current)
    cols = ", ".join(s[4] for s in specs)
    return f"""
{name}_b AS (SELECT user_id, date, {cols} FROM (SELECT user_id, date, {feats} FROM panel) WHERE date = (SELECT t FROM tgt)),
{name}_p AS (SELECT user_id, date, {cols} FROM (SELECT user_id, date, {feats} FROM pert) WHERE date = (SELECT t FROM tgt)),
{name}_d AS (SELECT COUNT(*) AS n FROM ((SELECT * FROM {name}_b EXCEPT ALL SELECT * FROM {name}_p)
                                        UNION ALL (SELECT * FROM {name}_p EXCEPT ALL SELECT * FROM {name}_b)))"""


@register(
    "leakage_audit",
    f"""WITH {SQL_FULL.strip()},
tgt AS (SELECT MIN(date) + CAST((MAX(date) - MIN(date) + 1) // 2 AS INTEGER) AS t FROM panel),
pert AS (SELECT user_id, date,
                CASE WHEN date >= (SELECT t FROM tgt) THEN 999999.0 ELSE value_total END AS value_total,
                CASE WHEN date >= (SELECT t FROM tgt) THEN 999999.0 ELSE value_max END AS value_max,
                CASE WHEN date >= (SELECT t FROM tgt) THEN -999999.0 ELSE value_min END AS value_min FROM panel),
{_audit_sql(EVENT_PAST_SPECS, False, 'past').strip()},
{_audit_sql(EVENT_TODAY_SPECS, True, 'today').strip()}
SELECT 'rolling_past_only' AS "check", n AS differing_rows, n = 0 AS passed FROM past_d
UNION ALL SELECT 'rolling_including_today', n, n = 0 FROM today_d""",
)
def q_leakage_audit(spark, sf_dir):
    panel = full_panel_df(spark, sf_dir).select(CELL, DAY, "value_total", "value_max", "value_min")
    panel = cut_lineage(panel, "audit-panel")
    start, end = P.calendar_bounds(panel, DAY)
    # middle day of the calendar, as a scalar subquery
    target = F.date_add(start, F.floor((F.datediff(end, start) + 1) / 2).cast("int"))
    families = {
        name: (lambda df, s=specs, i=inclusive: _rounded(W.rolling_rows(df, s, i, CELL, DAY), s), [s[4] for s in specs])
        for name, specs, inclusive in (
            ("rolling_past_only", EVENT_PAST_SPECS, False),
            ("rolling_including_today", EVENT_TODAY_SPECS, True),
        )
    }
    differing = perturbation_audit(panel, families, [target], PERTURB, CELL, DAY)
    counts = differing.groupBy("check").agg(F.count(F.lit(1)).alias("differing_rows"))
    checks = spark.createDataFrame([(name,) for name in families], "check string")
    out = checks.join(counts, "check", "left").select("check", F.coalesce("differing_rows", F.lit(0)).alias("differing_rows"))
    return out.withColumn("passed", F.col("differing_rows") == 0)


def _rounded(df: DataFrame, specs) -> DataFrame:
    for _, _, agg, _, out in specs:
        if agg == "sum":
            df = df.withColumn(out, r6(out))
    return df


# --------------------------------------------------------------------------- #
# E1 -- the training table on the events stand-in
# --------------------------------------------------------------------------- #
def _e1_inputs(spark, sf_dir):
    panel = full_panel_df(spark, sf_dir)
    weather = panel.select(
        F.col(CELL).alias("grid_id"),
        DAY,
        F.col("value_total").alias("precipitation_total"),
        F.col("value_max").alias("temperature_max"),
        F.col("value_min").alias("humidity_min"),
    )
    det = table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(
        F.col(CELL).alias("grid_id"), F.to_date("ts").alias(DAY), F.col("value").alias("frp")
    )
    daily = P.daily_cell_events(det, "grid_id", DAY, "frp").withColumn("mean_frp", r6("mean_frp"))
    cust = table(spark, sf_dir, "customer")
    static = cust.select(
        F.col("c_custkey").alias("grid_id"),
        F.col("c_acctbal").alias("vegetation_cover_mean"),
        F.col("c_nationkey").alias("fuel_model_dominant"),
        (F.col("c_acctbal").isNull() | F.col("c_nationkey").isNull()).cast("int").alias("landfire_missing"),
    )
    history = (
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("grid_id"))
        .agg(F.count(F.lit(1)).cast("int").alias("historical_firms_detection_count_2020_2023"))
    )
    return weather, daily, static, history


def _e1_sql() -> str:
    inc = []
    for n, src, agg, minimum, out in INCLUSIVE_WINDOW_SPECS:
        frame = f"PARTITION BY grid_id ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
        value = f"{agg.upper()}({src}) OVER ({frame})"
        if agg == "sum":
            value = f"ROUND({value}, 6)"
        inc.append(f"CASE WHEN COUNT({src}) OVER ({frame}) >= {minimum} THEN {value} END AS {out}")
    return f"""WITH {SQL_FULL.strip()},
w AS (SELECT user_id AS grid_id, date, value_total AS precipitation_total, value_max AS temperature_max, value_min AS humidity_min FROM panel),
det AS (SELECT user_id AS grid_id, CAST(ts AS DATE) AS date, CAST(COUNT(*) AS INTEGER) AS fire_detection_count,
               MAX(value) AS maximum_frp, ROUND(AVG(value), 6) AS mean_frp, 1 AS fire_today
        FROM events WHERE event_type = 'error' GROUP BY 1, 2),
st AS (SELECT c_custkey AS grid_id, c_acctbal AS vegetation_cover_mean, c_nationkey AS fuel_model_dominant,
              CAST(c_acctbal IS NULL OR c_nationkey IS NULL AS INTEGER) AS landfire_missing FROM customer),
hi AS (SELECT o_custkey AS grid_id, CAST(COUNT(*) AS INTEGER) AS historical_firms_detection_count_2020_2023 FROM orders GROUP BY 1),
j AS (SELECT w.*, CAST(COALESCE(det.fire_detection_count, 0) AS INTEGER) AS fire_detection_count,
             COALESCE(det.maximum_frp, 0.0) AS maximum_frp, COALESCE(det.mean_frp, 0.0) AS mean_frp,
             CAST(COALESCE(det.fire_today, 0) AS INTEGER) AS fire_today,
             COALESCE(st.vegetation_cover_mean, 0.0) AS vegetation_cover_mean,
             CAST(COALESCE(st.fuel_model_dominant, 0) AS INTEGER) AS fuel_model_dominant,
             CAST(COALESCE(st.landfire_missing, 1) AS INTEGER) AS landfire_missing,
             CAST(COALESCE(hi.historical_firms_detection_count_2020_2023, 0) AS INTEGER) AS historical_firms_detection_count_2020_2023
      FROM w LEFT JOIN det ON det.grid_id = w.grid_id AND det.date = w.date
      LEFT JOIN st ON st.grid_id = w.grid_id LEFT JOIN hi ON hi.grid_id = w.grid_id),
r AS (SELECT *, {', '.join(inc)},
             LEAD(fire_today) OVER (PARTITION BY grid_id ORDER BY date) AS nf FROM j)
SELECT * EXCLUDE (nf), CAST(nf AS INTEGER) AS fire_next_day FROM r WHERE nf IS NOT NULL"""


@register("training_table", _e1_sql())
def q_training_table(spark, sf_dir):
    weather, daily, static, history = _e1_inputs(spark, sf_dir)
    out = build_training_table(weather, daily, static, history, "grid_id", DAY)
    return _rounded(out, INCLUSIVE_WINDOW_SPECS)


# --------------------------------------------------------------------------- #
# M1-M6 -- fit, choose threshold on validation, evaluate on test (no SQL oracle)
# --------------------------------------------------------------------------- #
@register("model_backtest")
def q_model_backtest(spark, sf_dir):
    from cellcast.operators import learn as L
    from cellcast.operators import ranking as R
    from cellcast.plans.catalog_metrics import four_score_base

    data = four_score_base(spark, sf_dir)  # materialized: reused by every fitting pass
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(CELL), "c_mktsegment")
    data = data.join(cust, CELL, "left")
    numeric = ["s_rank_total_7d", "s_rank_total_30d", "s_rank_max_3d", "s_rank_min_3d"]
    split = P.temporal_split(data, DAY, "2024-01-15", "2024-01-23")
    train = split.filter(F.col("split") == "train")
    valid = split.filter(F.col("split") == "validation")
    test = split.filter(F.col("split") == "test")
    model = L.fit_model(train, numeric, ["c_mktsegment"], "label", kind="logistic", max_iter=50)
    v = L.score(model, valid, ["c_mktsegment"])
    threshold = R.choose_threshold(R.score_levels(v, "label", "score"), "score").first()["threshold"]
    t = L.score(model, test, ["c_mktsegment"])
    return R.binary_metrics(t, "label", "score", threshold).withColumn("threshold", F.lit(float(threshold)))


# --------------------------------------------------------------------------- #
# P20 -- valid pins, chosen tiers, padded viewport
# --------------------------------------------------------------------------- #
VIEW = (36.0, -122.0, 38.0, -118.0)


@register(
    "viewport_pins",
    f"""WITH {SQL_FULL.strip()},
f AS (SELECT *, {_rows_sql(EVENT_PAST_SPECS[:1], False)} FROM panel),
dm AS (SELECT MAX(date) AS d FROM f),
t AS (SELECT f.user_id, CAST(32.5 AS DOUBLE) + f.user_id * CAST(0.05 AS DOUBLE) AS lat,
             CAST(-124.0 AS DOUBLE) + f.user_id * CAST(0.07 AS DOUBLE) AS lng, COALESCE(f.total_previous_7d, 0.0) AS score
      FROM f JOIN dm ON f.date = dm.d),
p AS (SELECT *, (RANK() OVER (ORDER BY score) - 1 + (COUNT(*) OVER (PARTITION BY score) + 1) / 2.0) / COUNT(*) OVER () * 100 AS risk_score FROM t),
q AS (SELECT *, CASE WHEN risk_score >= 99 THEN 'Extreme' WHEN risk_score >= 95 THEN 'High'
                     WHEN risk_score >= 90 THEN 'Medium' ELSE 'Low' END AS risk_level FROM p)
SELECT CAST(user_id AS VARCHAR) AS id, round_even(lat, 6) AS lat, round_even(lng, 6) AS lng, round_even(risk_score, 1) AS risk_score, risk_level
FROM q WHERE risk_level IN ('Low', 'Medium')
  AND lat BETWEEN {VIEW[0]} - ({VIEW[2]} - {VIEW[0]}) * 0.25 AND {VIEW[2]} + ({VIEW[2]} - {VIEW[0]}) * 0.25
  AND lng BETWEEN {VIEW[1]} - ({VIEW[3]} - {VIEW[1]}) * 0.25 AND {VIEW[3]} + ({VIEW[3]} - {VIEW[1]}) * 0.25""",
)
def q_viewport_pins(spark, sf_dir):
    from cellcast.operators.spatial import viewport_filter

    feats, _ = _publish_features(spark, sf_dir)
    pins = publish_locations(feats, PUBLISH_THRESHOLD, CELL).select("id", "lat", "lng", "risk_score", "risk_level")
    south, west, north, east = VIEW
    return viewport_filter(pins, south, west, north, east, 0.25, ["Low", "Medium"])
