"""Catalog: history summaries, year-safe windows, snapshots, contracts, dedupe,
upsert, splits and category levels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.functions.categories import category_string
from cellcast.operators import contracts as C
from cellcast.operators import learn as L
from cellcast.operators import panel as P
from cellcast.operators import windows as W
from cellcast.plans.catalog import (
    CELL,
    DAY,
    EVENT_PAST_SPECS,
    SQL_DAYS,
    SQL_FULL,
    SQL_SCORED,
    SQL_SPARSE,
    _spark_round_sums,
    _sql_min_count,
    event_days,
    full_panel_df,
    r6,
    register,
    scored_panel,
    sparse_panel,
    table,
)
from cellcast.plans.daily_scoring import build_next_day_features
from cellcast.streaming.history_upsert import upsert_history


def r10(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 10)


# --------------------------------------------------------------------------- #
# orders as multi-year detection history: cell = o_custkey
# --------------------------------------------------------------------------- #
HIST_YEARS = (1996, 1999)
SEASON_YEARS = list(range(1995, 2001))


def order_days(spark, sf_dir, years: tuple[int, int] | None = None) -> DataFrame:
    """(customer, day) rows; with ``years`` the range is also applied to the
    stored timestamp, so the Parquet scan can skip row groups (a filter on the
    derived day alone cannot be pushed down)."""
    o = table(spark, sf_dir, "orders")
    if years:
        o = o.filter(
            (F.col("o_orderdate") >= F.lit(dt.datetime(years[0], 1, 1)).cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.lit(dt.datetime(years[1] + 1, 1, 1)).cast("timestamp_ntz"))
        )
    return o.select("o_custkey", F.to_date("o_orderdate").alias(DAY))


def daily_orders(spark, sf_dir, years: tuple[int, int] | None = None) -> DataFrame:
    return order_days(spark, sf_dir, years).groupBy("o_custkey", DAY).agg(F.count(F.lit(1)).alias("fire_count"))


def all_customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))


@register(
    "history_summary",
    """
WITH h AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date FROM orders
           WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2000-01-01'),
s AS (SELECT o_custkey, COUNT(*) AS n, COUNT(DISTINCT date) AS d, COUNT(DISTINCT year(date)) AS y
      FROM h GROUP BY o_custkey)
SELECT c.c_custkey AS o_custkey,
       CAST(COALESCE(s.n, 0) AS INTEGER) AS historical_firms_detection_count_1996_1999,
       CAST(COALESCE(s.d, 0) AS INTEGER) AS historical_fire_active_days_1996_1999,
       CAST(COALESCE(s.y, 0) AS INTEGER) AS historical_fire_active_years_1996_1999
FROM customer c LEFT JOIN s ON s.o_custkey = c.c_custkey""",
)
def q_history_summary(spark, sf_dir):
    days = order_days(spark, sf_dir, HIST_YEARS)
    return P.history_summary(days, all_customers(spark, sf_dir), "o_custkey", DAY, HIST_YEARS)


SQL_SEASON = """
daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS fire_count FROM orders GROUP BY 1, 2),
agg AS (SELECT o_custkey, year(date) AS history_year, SUM(fire_count) AS n, COUNT(DISTINCT date) AS d
        FROM daily
        WHERE date BETWEEN make_date(year(date), 5, 1) AND make_date(year(date), 10, 30)
          AND year(date) BETWEEN 1995 AND 2000
        GROUP BY 1, 2),
spine AS (SELECT c_custkey AS o_custkey, y AS history_year FROM customer CROSS JOIN (SELECT UNNEST(range(1995, 2001)) AS y)),
season AS (
  SELECT spine.o_custkey, CAST(spine.history_year AS INTEGER) AS history_year,
         CAST(spine.history_year + 1 AS INTEGER) AS feature_year,
         make_date(spine.history_year, 5, 1) AS window_start, make_date(spine.history_year, 10, 30) AS window_end,
         CAST(COALESCE(agg.n, 0) AS INTEGER) AS prior_year_firms_detection_count,
         ROUND(LN(1 + COALESCE(agg.n, 0)), 10) AS prior_year_firms_detection_count_log,
         CAST(COALESCE(agg.d, 0) AS INTEGER) AS prior_year_firms_active_days
  FROM spine LEFT JOIN agg ON agg.o_custkey = spine.o_custkey AND agg.history_year = spine.history_year)"""


def _season(spark, sf_dir) -> DataFrame:
    daily = daily_orders(spark, sf_dir, (min(SEASON_YEARS), max(SEASON_YEARS)))
    s = P.season_summary(daily, all_customers(spark, sf_dir), SEASON_YEARS, "o_custkey", DAY)
    return s.withColumn("prior_year_firms_detection_count_log", r10("prior_year_firms_detection_count_log"))


@register("season_summary", f"WITH {SQL_SEASON.strip()} SELECT * FROM season")
def q_season_summary(spark, sf_dir):
    return _season(spark, sf_dir)


@register(
    "prior_year_lookup",
    f"""WITH {SQL_SEASON.strip()}
SELECT d.o_custkey, d.date, d.fire_count,
       CAST(COALESCE(s.prior_year_firms_detection_count, 0) AS INTEGER) AS prior_year_firms_detection_count,
       COALESCE(s.prior_year_firms_detection_count_log, 0.0) AS prior_year_firms_detection_count_log,
       CAST(COALESCE(s.prior_year_firms_active_days, 0) AS INTEGER) AS prior_year_firms_active_days
FROM daily d LEFT JOIN season s ON s.o_custkey = d.o_custkey AND s.feature_year = year(d.date)""",
)
def q_prior_year_lookup(spark, sf_dir):
    return P.prior_year_lookup(daily_orders(spark, sf_dir), _season(spark, sf_dir), "o_custkey", DAY)


@register(
    "season_contract",
    f"""WITH {SQL_SEASON.strip()}
SELECT COUNT(*) FILTER (WHERE feature_year <> history_year + 1) AS bad_feature_year,
       COUNT(*) FILTER (WHERE NOT (month(window_start) = 5 AND day(window_start) = 1 AND month(window_end) = 10 AND day(window_end) = 30)) AS bad_window,
       COUNT(*) FILTER (WHERE prior_year_firms_detection_count < 0) AS negative_counts,
       COUNT(DISTINCT o_custkey) AS cells,
       (SELECT COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) FROM (SELECT COUNT(*) AS n FROM season GROUP BY o_custkey, history_year)) AS duplicate_rows,
       (SELECT MIN(n) FROM (SELECT COUNT(DISTINCT o_custkey) AS n FROM season GROUP BY feature_year)) AS min_cells_per_year
FROM season""",
)
def q_season_contract(spark, sf_dir):
    return C.season_summary_report(_season(spark, sf_dir), "o_custkey")


# --------------------------------------------------------------------------- #
# W6 on lineitem supplier-days (multi-year)
# --------------------------------------------------------------------------- #
SUPP_SPECS = [
    (7, "qty_total", "sum", 3, "qty_previous_7d"),
    (30, "qty_total", "sum", 7, "qty_previous_30d"),
    (3, "price_max", "max", 1, "price_max_previous_3d"),
    (3, "discount_min", "min", 1, "discount_min_previous_3d"),
]


def supplier_days(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_suppkey", F.to_date("l_shipdate").alias(DAY)).agg(
        F.sum("l_quantity").alias("qty_total"),
        F.max("l_extendedprice").alias("price_max"),
        F.min("l_discount").alias("discount_min"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("fire_today"),
    )


def _year_frame(n_before: int) -> str:
    return f"PARTITION BY l_suppkey, year(date) ORDER BY date ROWS BETWEEN {n_before} PRECEDING AND 1 PRECEDING"


@register(
    "year_safe_features",
    f"""
WITH sd AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, SUM(l_quantity) AS qty_total,
                   MAX(l_extendedprice) AS price_max, MIN(l_discount) AS discount_min,
                   MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS fire_today
            FROM lineitem GROUP BY 1, 2),
f AS (SELECT *,
   {_sql_min_count('qty_total', 'sum', 3, _year_frame(7), 'qty_previous_7d', True)},
   {_sql_min_count('qty_total', 'sum', 7, _year_frame(30), 'qty_previous_30d', True)},
   {_sql_min_count('price_max', 'max', 1, _year_frame(3), 'price_max_previous_3d', False)},
   {_sql_min_count('discount_min', 'min', 1, _year_frame(3), 'discount_min_previous_3d', False)},
   LEAD(date) OVER (PARTITION BY l_suppkey, year(date) ORDER BY date) AS nd,
   LEAD(fire_today) OVER (PARTITION BY l_suppkey, year(date) ORDER BY date) AS nf
   FROM sd)
SELECT l_suppkey, date, qty_total, price_max, discount_min, fire_today,
       qty_previous_7d, qty_previous_30d, price_max_previous_3d, discount_min_previous_3d,
       CAST(nf AS INTEGER) AS fire_next_day
FROM f WHERE nd - date = 1 AND nf IS NOT NULL""",
)
def q_year_safe_features(spark, sf_dir):
    out = W.year_safe_features(supplier_days(spark, sf_dir), SUPP_SPECS, "fire_today", "fire_next_day", "l_suppkey", DAY)
    return _spark_round_sums(out, SUPP_SPECS)


# --------------------------------------------------------------------------- #
# A5 and the E3 snapshot on the events panel
# --------------------------------------------------------------------------- #
def _snapshot_sql(source: str) -> str:
    parts = []
    for n, col, agg, minimum, out in EVENT_PAST_SPECS:
        value = f"{agg.upper()}({col}) FILTER (WHERE date >= dm.d - {n})"
        if agg == "sum":
            value = f"ROUND({value}, 6)"
        parts.append(f"CASE WHEN COUNT({col}) FILTER (WHERE date >= dm.d - {n}) >= {minimum} THEN {value} END AS {out}")
    return (
        f"SELECT {source}.user_id, " + ", ".join(parts)
        + f" FROM {source}, dm WHERE date >= dm.d - 30 AND date < dm.d GROUP BY {source}.user_id"
    )


@register(
    "past_window_snapshot",
    f"""WITH {SQL_SPARSE.strip()},
dm AS (SELECT MAX(date) AS d FROM sparse)
{_snapshot_sql('sparse')}""",
)
def q_past_window_snapshot(spark, sf_dir):
    sparse = sparse_panel(spark, sf_dir)
    day = sparse.agg(F.max(DAY)).scalar()  # as-of date D as a scalar subquery
    out = P.past_window_snapshot(sparse, day, EVENT_PAST_SPECS, CELL, DAY)
    return _spark_round_sums(out, EVENT_PAST_SPECS)


def _customer_static(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(CELL), "c_acctbal", "c_mktsegment"
    )


def _order_history(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias(CELL))
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


@register(
    "next_day_snapshot",
    f"""WITH {SQL_FULL.strip()},
dm AS (SELECT MAX(date) AS d FROM panel),
win AS ({_snapshot_sql('panel')}),
cur AS (SELECT user_id, value_total, value_max, value_min, event_count FROM panel, dm WHERE date = dm.d),
hist AS (SELECT o_custkey AS user_id, COUNT(*) AS order_count FROM orders GROUP BY 1)
SELECT cur.user_id, cur.value_total, cur.value_max, cur.value_min, cur.event_count,
       win.total_previous_7d, win.total_previous_30d, win.max_previous_3d, win.min_previous_3d,
       c.c_acctbal, c.c_mktsegment, COALESCE(h.order_count, 0) AS order_count,
       ROUND(LN(1 + COALESCE(h.order_count, 0)), 10) AS order_count_log,
       dm.d AS feature_date, dm.d + 1 AS prediction_date
FROM cur CROSS JOIN dm
LEFT JOIN win ON win.user_id = cur.user_id
LEFT JOIN customer c ON c.c_custkey = cur.user_id
LEFT JOIN hist h ON h.user_id = cur.user_id""",
)
def q_next_day_snapshot(spark, sf_dir):
    feats = build_next_day_features(
        full_panel_df(spark, sf_dir),
        _customer_static(spark, sf_dir),
        _order_history(spark, sf_dir),
        reference=None,
        feature_date=None,
        validate=False,
        specs=EVENT_PAST_SPECS,
        key=CELL,
        date_col=DAY,
        current_cols=("value_total", "value_max", "value_min", "event_count"),
        static_cols=("c_acctbal", "c_mktsegment"),
        history_col="order_count",
        history_log_col="order_count_log",
        reference_cols=(),
    )
    return _spark_round_sums(feats, EVENT_PAST_SPECS).withColumn("order_count_log", r10("order_count_log"))


# --------------------------------------------------------------------------- #
# Contracts as queries
# --------------------------------------------------------------------------- #
@register(
    "conflict_check",
    """
WITH t AS (SELECT l_orderkey, l_linestatus, NULLIF(l_returnflag, 'N') AS return_flag FROM lineitem),
g AS (SELECT l_orderkey,
             COUNT(DISTINCT l_linestatus) + MAX(CASE WHEN l_linestatus IS NULL THEN 1 ELSE 0 END) > 1 AS l_linestatus_changes,
             COUNT(DISTINCT return_flag) + MAX(CASE WHEN return_flag IS NULL THEN 1 ELSE 0 END) > 1 AS return_flag_changes
      FROM t GROUP BY l_orderkey)
SELECT * FROM g WHERE l_linestatus_changes OR return_flag_changes""",
)
def q_conflict_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("return_flag")
    )
    return C.conflicting_keys(li, "l_orderkey", ["l_linestatus", "return_flag"])


@register(
    "duplicate_check",
    """
WITH k AS (SELECT user_id, CAST(ts AS DATE) AS date, COUNT(*) AS n FROM events GROUP BY 1, 2)
SELECT COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS duplicate_rows, COUNT(*) FILTER (WHERE n > 1) AS duplicated_keys FROM k""",
)
def q_duplicate_check(spark, sf_dir):
    return C.duplicate_report(event_days(spark, sf_dir), [CELL, DAY])


NULL_COLS = ["event_count", "value_total", "value_max", "value_min", "error_count", "fire_today"]


@register(
    "null_profile",
    f"WITH {SQL_FULL.strip()} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_fraction FROM panel"
        for c in NULL_COLS
    ),
)
def q_null_profile(spark, sf_dir):
    from cellcast.operators.profile import null_fractions

    return null_fractions(full_panel_df(spark, sf_dir), NULL_COLS)


@register(
    "table_profile",
    f"""WITH {SQL_SCORED}
SELECT COUNT(*) AS rows, COUNT(DISTINCT user_id) AS cells, MIN(date) AS start_date, MAX(date) AS end_date,
       SUM(label) AS positives, ROUND(AVG(label), 10) AS positive_rate FROM scored""",
)
def q_table_profile(spark, sf_dir):
    from cellcast.operators.profile import table_profile

    out = table_profile(scored_panel(spark, sf_dir), CELL, DAY, "label")
    return out.withColumn("positive_rate", r10("positive_rate"))


@register(
    "coverage_gap",
    """
WITH e AS (SELECT DISTINCT c_custkey AS user_id FROM customer),
a AS (SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)),
j AS (SELECT e.user_id AS eu, a.user_id AS au, COALESCE(e.user_id, a.user_id) AS user_id FROM e FULL OUTER JOIN a ON e.user_id = a.user_id)
SELECT COUNT(*) FILTER (WHERE au IS NULL) AS missing, COUNT(*) FILTER (WHERE eu IS NULL) AS unexpected,
       (SELECT list(user_id ORDER BY user_id) FROM (SELECT user_id FROM j WHERE au IS NULL ORDER BY user_id LIMIT 10)) AS missing_examples
FROM j""",
)
def q_coverage_gap(spark, sf_dir):
    days = event_days(spark, sf_dir)
    last = P.select_feature_date(days, DAY)
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(CELL))
    actual = days.filter(F.col(DAY) == F.lit(last)).select(CELL)
    return C.coverage_report(expected, actual, CELL)


@register(
    "domain_checks",
    """
WITH h AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date FROM orders
           WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2000-01-01'),
s0 AS (SELECT o_custkey, COUNT(*) AS n, COUNT(DISTINCT date) AS d, COUNT(DISTINCT year(date)) AS y FROM h GROUP BY 1),
s AS (SELECT c.c_custkey AS grid_id, COALESCE(n, 0) AS n, COALESCE(d, 0) AS d, COALESCE(y, 0) AS y
      FROM customer c LEFT JOIN s0 ON s0.o_custkey = c.c_custkey)
SELECT COUNT(*) FILTER (WHERE grid_id IS NULL) AS missing_grid_ids,
       COUNT(*) FILTER (WHERE n IS NULL OR d IS NULL OR y IS NULL) AS missing_values,
       COUNT(*) FILTER (WHERE n < 0 OR d < 0 OR y < 0) AS negative_counts,
       COUNT(*) FILTER (WHERE y > 4) AS years_over_limit,
       COUNT(*) FILTER (WHERE d > n) AS days_over_detections,
       COUNT(*) FILTER (WHERE y > d) AS years_over_days,
       (SELECT COUNT(*) FILTER (WHERE quality NOT IN (0, 1) OR toxic NOT IN (0, 1)) FROM labels) AS labels_outside_domain
FROM s""",
)
def q_domain_checks(spark, sf_dir):
    summary = P.history_summary(order_days(spark, sf_dir, HIST_YEARS), all_customers(spark, sf_dir), "o_custkey", DAY, HIST_YEARS)
    summary = summary.withColumnRenamed("o_custkey", "grid_id")
    inv = C.history_invariants(summary, "1996_1999", 4)
    labels = table(spark, sf_dir, "labels")
    dom = C.domain_report(
        labels, {"labels_outside_domain": ~F.col("quality").isin(0, 1) | ~F.col("toxic").isin(0, 1)}
    )
    return C.side_by_side(inv, dom)


# --------------------------------------------------------------------------- #
# W9 / W10 dedupe; T1 upsert
# --------------------------------------------------------------------------- #
def _dedupe_sql(direction: str) -> str:
    return f"""
WITH d AS ({SQL_DAYS}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, date ORDER BY ts {direction}, event_id {direction}) AS rn FROM d)
SELECT user_id, date, event_type, value, event_id, ts FROM r WHERE rn = 1"""


@register("dedupe_keep_last", _dedupe_sql("DESC"))
def q_dedupe_keep_last(spark, sf_dir):
    return W.dedupe_keep(event_days(spark, sf_dir), [CELL, DAY], ["ts", "event_id"], "last")


@register("dedupe_keep_first", _dedupe_sql("ASC"))
def q_dedupe_keep_first(spark, sf_dir):
    return W.dedupe_keep(event_days(spark, sf_dir), [CELL, DAY], ["ts", "event_id"], "first")


UPSERT_EXISTING_END = dt.date(2024, 1, 20)
UPSERT_DOWNLOAD_START = dt.date(2024, 1, 15)
UPSERT_FORECAST = dt.date(2024, 1, 25)


@register(
    "history_upsert_trim",
    f"""WITH {SQL_SPARSE.strip()},
ex AS (SELECT user_id, date, value_total, 0 AS src FROM sparse WHERE date <= DATE '{UPSERT_EXISTING_END}'),
dl AS (SELECT user_id, date, ROUND(value_total * 2, 6) AS value_total, 1 AS src FROM sparse WHERE date >= DATE '{UPSERT_DOWNLOAD_START}'),
u AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, date ORDER BY src DESC) AS rn FROM (SELECT * FROM ex UNION ALL SELECT * FROM dl))
SELECT user_id, date, value_total FROM u
WHERE rn = 1 AND date BETWEEN DATE '{UPSERT_FORECAST}' - 30 AND DATE '{UPSERT_FORECAST}'""",
)
def q_history_upsert_trim(spark, sf_dir):
    sparse = sparse_panel(spark, sf_dir).select(CELL, DAY, "value_total")
    existing = sparse.filter(F.col(DAY) <= F.lit(UPSERT_EXISTING_END))
    downloaded = sparse.filter(F.col(DAY) >= F.lit(UPSERT_DOWNLOAD_START)).withColumn(
        "value_total", r6(F.col("value_total") * 2)
    )
    return upsert_history(existing, downloaded, UPSERT_FORECAST, [CELL, DAY], DAY)


# --------------------------------------------------------------------------- #
# P18 / P19 splits; W11 query ids
# --------------------------------------------------------------------------- #
SPLIT_VALIDATION = "2024-01-15"
SPLIT_TEST = "2024-01-23"
FOLDS = [
    ("fold_a", "2024-01-10", "2024-01-15", "2024-01-20"),
    ("fold_b", "2024-01-15", "2024-01-20", "2024-01-26"),
]


@register(
    "temporal_split",
    f"""WITH {SQL_SCORED},
t AS (SELECT *, CASE WHEN date < DATE '{SPLIT_VALIDATION}' THEN 'train'
                     WHEN date < DATE '{SPLIT_TEST}' THEN 'validation' ELSE 'test' END AS split FROM scored)
SELECT split, MIN(date) AS start_date, MAX(date) AS end_date, COUNT(*) AS rows, SUM(label) AS positives
FROM t GROUP BY split""",
)
def q_temporal_split(spark, sf_dir):
    split = P.temporal_split(scored_panel(spark, sf_dir), DAY, SPLIT_VALIDATION, SPLIT_TEST)
    summary = P.split_summary(split, DAY, "label", ["split"])
    return summary


def _fold_sql() -> str:
    rows = ", ".join(f"('{n}', DATE '{v}', DATE '{t}', DATE '{e}')" for n, v, t, e in FOLDS)
    return f"""WITH {SQL_SCORED},
fl AS (SELECT * FROM (VALUES {rows}) x(fold, vs, ts, te)),
t AS (SELECT fl.fold, CASE WHEN date < vs THEN 'train' WHEN date < ts THEN 'validation' WHEN date < te THEN 'test' END AS split,
             scored.* FROM scored CROSS JOIN fl)
SELECT fold, split, MIN(date) AS start_date, MAX(date) AS end_date, COUNT(*) AS rows, SUM(label) AS positives
FROM t WHERE split IS NOT NULL GROUP BY fold, split"""


@register("fold_split", _fold_sql())
def q_fold_split(spark, sf_dir):
    folds = P.fold_split(scored_panel(spark, sf_dir), DAY, FOLDS)
    return P.split_summary(folds, DAY, "label", ["fold", "split"])


@register(
    "query_ids",
    f"""WITH {SQL_SCORED}
SELECT s.user_id, s.date, CAST(q.qid AS BIGINT) AS query_id
FROM scored s JOIN (SELECT date, ROW_NUMBER() OVER (ORDER BY date) - 1 AS qid FROM (SELECT DISTINCT date FROM scored)) q
ON q.date = s.date""",
)
def q_query_ids(spark, sf_dir):
    from cellcast.operators.ranking import query_ids

    return query_ids(scored_panel(spark, sf_dir).select(CELL, DAY), DAY, "query_id")


# --------------------------------------------------------------------------- #
# Categories learned on early days, applied to later days
# --------------------------------------------------------------------------- #
CATEGORY_CUT = dt.date(2024, 1, 11)


def _event_categories(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.to_date("ts").alias(DAY),
        "event_type",
        F.get_json_object("props", "$.k").alias("prop_k"),
    )


SQL_CATS = f"""
ev AS (SELECT event_id, CAST(ts AS DATE) AS date, event_type, json_extract_string(props, '$.k') AS prop_k FROM events),
tr AS (SELECT * FROM ev WHERE date < DATE '{CATEGORY_CUT}'),
lv AS (SELECT feature, level, CAST(ROW_NUMBER() OVER (PARTITION BY feature ORDER BY level) - 1 AS INTEGER) AS level_index
       FROM (SELECT DISTINCT 'event_type' AS feature, COALESCE(CAST(event_type AS VARCHAR), '__MISSING__') AS level FROM tr
             UNION SELECT DISTINCT 'prop_k', COALESCE(CAST(prop_k AS VARCHAR), '__MISSING__') FROM tr))"""


@register("category_levels", f"WITH {SQL_CATS.strip()} SELECT * FROM lv")
def q_category_levels(spark, sf_dir):
    train = _event_categories(spark, sf_dir).filter(F.col(DAY) < F.lit(CATEGORY_CUT))
    return L.category_levels(train, ["event_type", "prop_k"])


@register(
    "apply_levels",
    f"""WITH {SQL_CATS.strip()}
SELECT ev.event_id, ev.date, a.level AS event_type, a.level_index AS event_type_index,
       b.level AS prop_k, b.level_index AS prop_k_index
FROM ev
LEFT JOIN (SELECT * FROM lv WHERE feature = 'event_type') a ON a.level = COALESCE(ev.event_type, '__MISSING__')
LEFT JOIN (SELECT * FROM lv WHERE feature = 'prop_k') b ON b.level = COALESCE(ev.prop_k, '__MISSING__')
WHERE ev.date >= DATE '{CATEGORY_CUT}'""",
)
def q_apply_levels(spark, sf_dir):
    ev = _event_categories(spark, sf_dir)
    train = ev.filter(F.col(DAY) < F.lit(CATEGORY_CUT))
    levels = L.category_levels(train, ["event_type", "prop_k"])
    later = ev.filter(F.col(DAY) >= F.lit(CATEGORY_CUT))
    return L.apply_levels(later, levels, ["event_type", "prop_k"])


SQL_ODD_CATS = f"""
odd AS (SELECT event_id, CAST(ts AS DATE) AS date, NULLIF(event_type, 'view') AS event_type,
               NULLIF(json_extract_string(props, '$.k'), '3') AS prop_k,
               CASE WHEN user_id % 5 <> 0 THEN user_id % 3 END AS third FROM events),
odd_train AS (SELECT * FROM odd WHERE date < DATE '{CATEGORY_CUT}' AND COALESCE(event_type, '') <> 'click'),
modes AS (SELECT feature, arg_min(value, struct_pack(less := -n, v := value)) AS mode, MAX(n) AS n
          FROM (SELECT feature, value, COUNT(*) AS n
                FROM (SELECT 'event_type' AS feature, event_type AS value FROM odd_train UNION ALL
                      SELECT 'prop_k', prop_k FROM odd_train UNION ALL
                      SELECT 'third', CAST(third AS VARCHAR) FROM odd_train)
                WHERE value IS NOT NULL GROUP BY 1, 2) GROUP BY feature)"""
ODD_COLS = ["event_type", "prop_k", "third"]


def _odd_categories(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(training rows, later rows) with nulls; one event type does not occur in training."""
    odd = _event_categories(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")
    odd = odd.select(
        "event_id",
        DAY,
        F.nullif(F.col("event_type"), F.lit("view")).alias("event_type"),
        F.nullif(F.col("prop_k"), F.lit("3")).alias("prop_k"),
        F.when(F.col("user_id") % 5 != 0, F.col("user_id") % 3).alias("third"),
    )
    train = odd.filter((F.col(DAY) < F.lit(CATEGORY_CUT)) & (F.coalesce("event_type", F.lit("")) != "click"))
    return train, odd.filter(F.col(DAY) >= F.lit(CATEGORY_CUT))


@register("column_modes", f"WITH {SQL_ODD_CATS.strip()} SELECT feature, mode, n FROM modes")
def q_column_modes(spark, sf_dir):
    from cellcast.operators.encoders import column_modes

    return column_modes(_odd_categories(spark, sf_dir)[0], ODD_COLS)


@register(
    "imputed_codes",
    f"""WITH {SQL_ODD_CATS.strip()},
lvl AS (SELECT feature, value, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY value) - 1 AS code
        FROM (SELECT DISTINCT 'event_type' AS feature, event_type AS value FROM odd_train WHERE event_type IS NOT NULL
              UNION SELECT DISTINCT 'prop_k', prop_k FROM odd_train WHERE prop_k IS NOT NULL
              UNION SELECT DISTINCT 'third', CAST(third AS VARCHAR) FROM odd_train WHERE third IS NOT NULL)),
f AS (SELECT event_id, COALESCE(event_type, (SELECT mode FROM modes WHERE feature = 'event_type')) AS event_type,
             COALESCE(prop_k, (SELECT mode FROM modes WHERE feature = 'prop_k')) AS prop_k,
             COALESCE(CAST(third AS VARCHAR), (SELECT mode FROM modes WHERE feature = 'third')) AS third
      FROM odd WHERE date >= DATE '{CATEGORY_CUT}')
SELECT f.event_id, f.event_type AS event_type_filled, f.prop_k AS prop_k_filled, f.third AS third_filled,
       CAST(COALESCE(a.code, -1) AS DOUBLE) AS event_type_code, CAST(COALESCE(b.code, -1) AS DOUBLE) AS prop_k_code,
       CAST(COALESCE(c.code, -1) AS DOUBLE) AS third_code
FROM f LEFT JOIN lvl a ON a.feature = 'event_type' AND a.value = f.event_type
LEFT JOIN lvl b ON b.feature = 'prop_k' AND b.value = f.prop_k
LEFT JOIN lvl c ON c.feature = 'third' AND c.value = f.third""",
)
def q_imputed_codes(spark, sf_dir):
    """M1 + M4: the category stages of the tree models, fitted on early days, applied to later ones."""
    from pyspark.ml import Pipeline

    from cellcast.operators.encoders import CategoryText, ModeImputer, OrdinalEncoder

    train, later = _odd_categories(spark, sf_dir)
    text, filled = [f"{c}_text" for c in ODD_COLS], [f"{c}_filled" for c in ODD_COLS]
    stages = [
        CategoryText(inputCols=ODD_COLS, outputCols=text),
        ModeImputer(inputCols=text, outputCols=filled),
        OrdinalEncoder(inputCols=filled, outputCols=[f"{c}_code" for c in ODD_COLS]),
    ]
    out = Pipeline(stages=stages).fit(train).transform(later)
    return out.select("event_id", *filled, *[f"{c}_code" for c in ODD_COLS])


@register(
    "missing_token",
    """
SELECT event_id, COALESCE(CAST(NULLIF(event_type, 'view') AS VARCHAR), '__MISSING__') AS event_type_category,
       COALESCE(CAST(CAST(NULLIF(user_id % 7, 0) AS DOUBLE) AS VARCHAR), '__MISSING__') AS bucket_category
FROM events""",
)
def q_missing_token(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        category_string(F.nullif(F.col("event_type"), F.lit("view"))).alias("event_type_category"),
        category_string(F.nullif(F.col("user_id") % 7, F.lit(0)), "double").alias("bucket_category"),
    )


# --------------------------------------------------------------------------- #
# P23 positive cell-days; E1 training table
# --------------------------------------------------------------------------- #
@register(
    "positive_cell_days",
    f"""WITH {SQL_FULL.strip()}
SELECT user_id, date, 1 AS fire_present, CAST(error_count AS BIGINT) AS fire_count FROM panel WHERE fire_today = 1""",
)
def q_positive_cell_days(spark, sf_dir):
    panel = full_panel_df(spark, sf_dir).withColumnRenamed("error_count", "fire_detection_count")
    return P.positive_cell_days(panel, CELL, DAY)


# --------------------------------------------------------------------------- #
# A12 / A13 -- numeric describe (exact quartiles) and monthly label stats
# --------------------------------------------------------------------------- #
DESCRIBE_COLS = ["o_totalprice", "o_custkey"]


@register(
    "numeric_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std,
       CAST(MIN({c}) AS DOUBLE) AS min, ROUND(QUANTILE_CONT({c}, 0.25), 6) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS p50,
       ROUND(QUANTILE_CONT({c}, 0.75), 6) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM orders"""
        for c in DESCRIBE_COLS
    ),
)
def q_numeric_describe(spark, sf_dir):
    from cellcast.operators.profile import describe_numeric

    out = describe_numeric(table(spark, sf_dir, "orders"), DESCRIBE_COLS)
    for c in ("mean", "std", "p25", "p50", "p75"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@register(
    "monthly_label_stats",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS rows,
       SUM(CAST(o_orderstatus = 'F' AS INTEGER)) AS positives,
       ROUND(AVG(CAST(o_orderstatus = 'F' AS INTEGER)), 10) AS positive_rate
FROM orders GROUP BY 1""",
)
def q_monthly_label_stats(spark, sf_dir):
    from cellcast.operators.profile import monthly_label_stats

    o = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias(DAY), (F.col("o_orderstatus") == "F").cast("int").alias("label")
    )
    return monthly_label_stats(o, DAY, "label").withColumn("positive_rate", r10("positive_rate"))


# --------------------------------------------------------------------------- #
# J4 -- reference values: the weather's own newest value wins, the external
# reference fills the rest (full outer join)
# --------------------------------------------------------------------------- #
@register(
    "reference_fallback",
    f"""WITH {SQL_SPARSE.strip()},
w AS (SELECT user_id, arg_max(value_max, date) AS elevation FROM sparse GROUP BY user_id),
r AS (SELECT c_custkey AS user_id, MAX(c_acctbal) AS elevation_ref, MAX(CAST(c_nationkey AS DOUBLE)) AS lat_ref
      FROM customer GROUP BY 1)
SELECT COALESCE(w.user_id, r.user_id) AS user_id, COALESCE(w.elevation, r.elevation_ref) AS elevation,
       r.lat_ref AS centroid_lat
FROM w FULL OUTER JOIN r ON w.user_id = r.user_id""",
)
def q_reference_fallback(spark, sf_dir):
    from cellcast.plans.daily_scoring import reference_grid

    weather = sparse_panel(spark, sf_dir).select(CELL, DAY, F.col("value_max").alias("elevation"))
    reference = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(CELL), F.col("c_acctbal").alias("elevation"),
        F.col("c_nationkey").cast("double").alias("centroid_lat"),
    )
    return reference_grid(weather, reference, [CELL, "elevation", "centroid_lat"], CELL)


# --------------------------------------------------------------------------- #
# A4 whole-year flavour + lenient J3 lookup
# --------------------------------------------------------------------------- #
@register(
    "prior_year_whole",
    """
WITH daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS fire_count FROM orders GROUP BY 1, 2),
y AS (SELECT o_custkey, CAST(year(date) + 1 AS INTEGER) AS feature_year, CAST(SUM(fire_count) AS BIGINT) AS n,
             COUNT(DISTINCT date) AS d FROM daily GROUP BY 1, 2)
SELECT daily.o_custkey, daily.date, daily.fire_count,
       COALESCE(y.n, 0) AS prior_year_firms_detection_count, COALESCE(y.d, 0) AS prior_year_firms_active_days
FROM daily LEFT JOIN y ON y.o_custkey = daily.o_custkey AND y.feature_year = year(daily.date)""",
)
def q_prior_year_whole(spark, sf_dir):
    daily = daily_orders(spark, sf_dir)
    summary = P.yearly_summary(daily, "o_custkey", DAY, "fire_count")
    return P.prior_year_lookup(
        daily, summary, "o_custkey", DAY, ("prior_year_firms_detection_count", "prior_year_firms_active_days")
    )


# --------------------------------------------------------------------------- #
# M8 (prior-year part): mapping, window before the feature year, coverage
# --------------------------------------------------------------------------- #
AUDIT_FEATURE_YEARS = [1997, 1998]


@register(
    "prior_year_audit",
    f"""WITH {SQL_SEASON.strip()},
rel AS (SELECT * FROM season WHERE feature_year IN ({', '.join(map(str, AUDIT_FEATURE_YEARS))})),
py AS (SELECT feature_year, COUNT(DISTINCT o_custkey) AS cells FROM rel GROUP BY 1),
chk AS (SELECT COUNT(*) FILTER (WHERE history_year <> feature_year - 1) AS bad_mapping,
               COUNT(*) FILTER (WHERE window_end >= make_date(feature_year, 1, 1)) AS late_windows FROM rel),
cov AS (SELECT COUNT(*) AS years_present, MIN(cells) AS min_cells, MAX(cells) AS max_cells FROM py)
SELECT 'prior_year_mapping' AS "check", bad_mapping = 0 AS passed FROM chk
UNION ALL SELECT 'prior_year_window_precedes_features', late_windows = 0 FROM chk
UNION ALL SELECT 'prior_year_grid_coverage', years_present = {len(AUDIT_FEATURE_YEARS)} AND min_cells = max_cells AND min_cells = (SELECT COUNT(*) FROM customer) FROM cov""",
)
def q_prior_year_audit(spark, sf_dir):
    from cellcast.plans.backtest import prior_year_audit

    cells = all_customers(spark, sf_dir).count()  # expected grid size (one small job)
    return prior_year_audit(_season(spark, sf_dir).withColumnRenamed("o_custkey", "grid_id"), AUDIT_FEATURE_YEARS, cells)
