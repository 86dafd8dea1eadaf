"""Catalog: contracts, readers and the model panel bound to the test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.operators import contracts as C
from cellcast.operators import learn as L
from cellcast.operators import panel as P
from cellcast.operators import ranking as R
from cellcast.plans.catalog import DAY, _sql_min_count, register, table
from cellcast.plans.catalog_history import SUPP_SPECS, _spark_round_sums, _year_frame, supplier_days
from cellcast.plans.catalog_metrics import BLEND_MODELS, ORACLE_BLEND, four_rank_panel
from cellcast.plans.training_table import build_model_panel
from cellcast.sources import readers as RD


# --------------------------------------------------------------------------- #
# P12, P13, P16 -- landed detections (events: place = user and value)
# --------------------------------------------------------------------------- #
@register(
    "detection_contract",
    """WITH det AS (
  SELECT CAST(user_id % 90 AS DOUBLE) AS latitude, CASE WHEN value > 5 THEN value END AS longitude,
         CASE WHEN event_id % 97 = 0 THEN 'no date' ELSE strftime(ts, '%Y-%m-%d') END AS acq_date,
         CAST(user_id % 24 AS INTEGER) AS acq_time, event_type AS satellite, 'VIIRS' AS instrument
  FROM (SELECT event_id, user_id, ts, event_type, ROUND(value, 0) AS value FROM events)),
k AS (SELECT latitude, longitude, acq_date, acq_time, satellite, COUNT(*) AS n FROM det GROUP BY ALL)
SELECT CAST(SUM(CASE WHEN longitude IS NULL OR latitude IS NULL OR TRY_CAST(acq_date AS DATE) IS NULL THEN n ELSE 0 END) AS BIGINT) AS invalid_rows,
       CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
       CAST(SUM(CASE WHEN satellite <> 'click' THEN n ELSE 0 END) AS BIGINT) AS other_satellite_rows,
       CAST(SUM(CASE WHEN satellite = 'click' THEN n ELSE 0 END) = 0 AS BIGINT) AS without_satellite,
       CAST(SUM(CASE WHEN year(TRY_CAST(acq_date AS DATE)) <> 2023 THEN n ELSE 0 END) AS BIGINT) AS other_year_rows
FROM k""",
)
def q_detection_contract(spark, sf_dir):
    value = F.round("value", 0)
    det = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 90).cast("double").alias("latitude"),
        F.when(value > 5, value).alias("longitude"),
        F.when(F.col("event_id") % 97 == 0, "no date").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("acq_date"),
        (F.col("user_id") % 24).cast("int").alias("acq_time"),
        F.col("event_type").alias("satellite"),
        F.lit("VIIRS").alias("instrument"),
    )
    return C.detection_report(det, "click", 2023)


@register(
    "source_contract",
    """SELECT COUNT(*) FILTER (WHERE event_type = 'click') AS expected_rows, COUNT(*) FILTER (WHERE event_type <> 'click') AS other_rows,
       COUNT(*) FILTER (WHERE event_type = 'click') > 0 AND COUNT(*) FILTER (WHERE event_type <> 'click') = 0 AS single_source
FROM events""",
)
def q_source_contract(spark, sf_dir):
    return C.source_report(table(spark, sf_dir, "events"), "event_type", "click")


# --------------------------------------------------------------------------- #
# P9, P14-P17 -- a scoring table (orders: cell = customer, dates = order dates)
# --------------------------------------------------------------------------- #
SQL_SCORING = """sc AS (
  SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS grid_id, CAST(o_orderdate AS DATE) AS feature_date,
         CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderdate AS DATE) + 1 END AS prediction_date,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 11 = 0 THEN CAST('Infinity' AS DOUBLE)
              WHEN o_orderkey % 13 <> 0 THEN CAST(o_totalprice AS DOUBLE) END AS model_score FROM orders)"""


def _scoring(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    score = (
        F.when(key % 7 == 0, F.lit(float("nan")))
        .when(key % 11 == 0, F.lit(float("inf")))
        .when(key % 13 != 0, F.col("o_totalprice").cast("double"))
    )
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 50 != 0, F.col("o_custkey")).alias("grid_id"),
        day.alias("feature_date"),
        F.when(key % 31 != 0, F.date_add(day, 1)).alias("prediction_date"),
        score.alias("model_score"),
    )


@register(
    "scoring_contract",
    f"""WITH {SQL_SCORING}
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE grid_id IS NULL) AS null_ids,
       COUNT(grid_id) - COUNT(DISTINCT grid_id) AS duplicate_rows,
       COUNT(*) FILTER (WHERE feature_date IS NULL OR prediction_date IS NULL) AS undated_rows,
       MIN(feature_date) AS min_feature_date, MIN(prediction_date) AS min_prediction_date,
       MAX(feature_date) AS max_feature_date, MAX(prediction_date) AS max_prediction_date,
       COUNT(*) FILTER (WHERE model_score IS NULL OR NOT isfinite(model_score)) AS not_finite
FROM sc""",
)
def q_scoring_contract(spark, sf_dir):
    scoring = _scoring(spark, sf_dir)
    finite = C.finite_report(scoring, ["model_score"]).select(F.col("model_score").alias("not_finite"))
    return C.side_by_side(C.scoring_report(scoring, "grid_id"), finite)


@register(
    "null_contract",
    f"""WITH {SQL_SCORING},
bad AS (SELECT * FROM sc WHERE prediction_date IS NULL OR model_score IS NULL OR isnan(model_score))
SELECT (SELECT COUNT(*) FROM bad) AS incomplete_rows,
       (SELECT list(grid_id ORDER BY grid_id) FROM (SELECT grid_id FROM bad WHERE grid_id IS NOT NULL ORDER BY grid_id LIMIT 10)) AS examples""",
)
def q_null_contract(spark, sf_dir):
    rows = _scoring(spark, sf_dir)
    # Rows without an id are counted, but are no example.
    report = C.null_report(rows, ["prediction_date", "model_score"])
    named = C.null_report(rows.where("grid_id is not null"), ["prediction_date", "model_score"]).select("examples")
    return C.side_by_side(report.select("incomplete_rows"), named)


@register(
    "conservation_contract",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS date, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1, 2)
SELECT (SELECT COUNT(*) FROM events WHERE event_type = 'error') AS total_before, CAST((SELECT SUM(n) FROM d) AS BIGINT) AS total_after,
       (SELECT COUNT(*) FROM events WHERE event_type = 'error') = (SELECT SUM(n) FROM d) AS conserved""",
)
def q_conservation_contract(spark, sf_dir):
    det = table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.col("user_id").alias("grid_id"), F.to_date("ts").alias(DAY), F.col("value").alias("frp"), F.lit(1).alias("n")
    )
    daily = P.daily_cell_events(det, "grid_id", DAY, "frp")
    return C.conservation_report(det, daily, "n", "fire_detection_count")


# --------------------------------------------------------------------------- #
# S3 / S4 -- files in the order given, duplicates out, columns pruned
# --------------------------------------------------------------------------- #
@register(
    "ordered_files",
    """SELECT 0 AS source, COUNT(*) AS rows, COUNT(DISTINCT user_id) AS cells, ROUND(SUM(value), 4) AS total FROM events""",
)
def q_ordered_files(spark, sf_dir):
    path = os.path.join(sf_dir, "events.parquet")
    landed = RD.read_ordered_parquet(spark, [path, path], ["event_id", "user_id", "value"], ["event_id"])
    return landed.groupBy(F.col("_source_order").cast("int").alias("source")).agg(
        F.count("*").alias("rows"), F.count_distinct("user_id").alias("cells"), F.round(F.sum("value"), 4).alias("total")
    )


# --------------------------------------------------------------------------- #
# A23 -- the best candidate by a lexicographic key
# --------------------------------------------------------------------------- #
@register(
    "lexicographic_best",
    f"""WITH r AS ({ORACLE_BLEND})
SELECT candidate, rank_total_7d_weight AS first_weight, ROUND(validation_pr_auc, 2) AS coarse_pr_auc
FROM r ORDER BY ROUND(validation_pr_auc, 2) DESC, rank_total_7d_weight DESC, candidate LIMIT 1""",
)
def q_lexicographic_best(spark, sf_dir):
    """Candidates that agree to two digits are told apart by a second key, then by their order."""
    results = R.blend_weight_search(four_rank_panel(spark, sf_dir), "label", BLEND_MODELS, 4)
    results = results.select(
        "candidate",
        F.col("rank_total_7d_weight").alias("first_weight"),
        F.round(F.round("validation_pr_auc", 10), 2).alias("coarse_pr_auc"),
    )
    return L.select_candidate(results, ["coarse_pr_auc", "first_weight"])


# --------------------------------------------------------------------------- #
# E2 -- the model panel: year-safe windows, prior-year season, static attributes
# --------------------------------------------------------------------------- #
SQL_MODEL_PANEL = f"""
sd AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, SUM(l_quantity) AS qty_total,
              MAX(l_extendedprice) AS price_max, MIN(l_discount) AS discount_min,
              MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS fire_today,
              COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned
       FROM lineitem GROUP BY 1, 2),
f AS (SELECT * EXCLUDE (returned),
   {_sql_min_count('qty_total', 'sum', 3, _year_frame(7), 'qty_previous_7d', True)},
   {_sql_min_count('qty_total', 'sum', 7, _year_frame(30), 'qty_previous_30d', True)},
   {_sql_min_count('price_max', 'max', 1, _year_frame(3), 'price_max_previous_3d', False)},
   {_sql_min_count('discount_min', 'min', 1, _year_frame(3), 'discount_min_previous_3d', False)},
   LEAD(date) OVER (PARTITION BY l_suppkey, year(date) ORDER BY date) AS nd,
   LEAD(fire_today) OVER (PARTITION BY l_suppkey, year(date) ORDER BY date) AS nf
   FROM sd),
season AS (SELECT l_suppkey, year(date) AS y, SUM(returned) AS n, COUNT(DISTINCT date) AS d FROM sd
           WHERE returned > 0 AND date BETWEEN make_date(year(date), 5, 1) AND make_date(year(date), 10, 30) GROUP BY 1, 2)
SELECT f.l_suppkey, f.date, qty_total, price_max, discount_min, fire_today, qty_previous_7d, qty_previous_30d,
       price_max_previous_3d, discount_min_previous_3d, CAST(nf AS INTEGER) AS fire_next_day,
       CAST(COALESCE(season.n, 0) AS INTEGER) AS prior_year_firms_detection_count,
       ROUND(LN(1 + COALESCE(season.n, 0)), 10) AS prior_year_firms_detection_count_log,
       CAST(COALESCE(season.d, 0) AS INTEGER) AS prior_year_firms_active_days, s_nationkey, s_acctbal
FROM f JOIN supplier ON s_suppkey = f.l_suppkey
LEFT JOIN season ON season.l_suppkey = f.l_suppkey AND season.y = year(f.date) - 1
WHERE nd - f.date = 1 AND nf IS NOT NULL AND qty_previous_7d IS NOT NULL AND qty_previous_30d IS NOT NULL
  AND price_max_previous_3d IS NOT NULL AND discount_min_previous_3d IS NOT NULL"""


@register("model_panel", f"WITH {SQL_MODEL_PANEL.strip()}")
def q_model_panel(spark, sf_dir):
    days = supplier_days(spark, sf_dir)
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    daily = returned.groupBy("l_suppkey", F.to_date("l_shipdate").alias(DAY)).agg(F.count("*").alias("fire_count"))
    supplier = table(spark, sf_dir, "supplier")
    cells = supplier.select(F.col("s_suppkey").alias("l_suppkey"))
    season = P.season_summary(daily, cells, range(1990, 2002), "l_suppkey", DAY)
    season = season.select(
        "l_suppkey",
        "feature_year",
        "prior_year_firms_detection_count",
        F.round("prior_year_firms_detection_count_log", 10).alias("prior_year_firms_detection_count_log"),
        "prior_year_firms_active_days",
    )
    static = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey", "s_acctbal")
    required = ["qty_total", "price_max", "discount_min", "s_nationkey", "s_acctbal"]
    out = build_model_panel(days, season, required, "l_suppkey", DAY, True, static, SUPP_SPECS)
    return _spark_round_sums(out, SUPP_SPECS)
