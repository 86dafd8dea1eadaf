"""Catalog: ranking metrics, thresholds, top-fraction capture, NDCG, blending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.fixed_values import BLEND_WEIGHT_UNITS, MINIMUM_RECALL, NDCG_CUTOFF, TOP_FRACTIONS
from cellcast.functions.display import risk_tier
from cellcast.operators import ranking as R
from cellcast.operators import windows as W
from cellcast.operators.learn import class_balance
from cellcast.session import cut_lineage
from cellcast.plans.catalog import (
    CELL,
    DAY,
    EVENT_PAST_SPECS,
    SQL_FULL,
    SQL_PERCENTILE,
    SQL_SCORED,
    _sql_min_count,
    full_panel_df,
    r6,
    register,
    scored_panel,
    table,
)


def r10(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 10)


# --------------------------------------------------------------------------- #
# scored document set: score = n_chars, label = quality
# --------------------------------------------------------------------------- #
def scored_documents(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id", "inner")


SQL_DOCS = """
s AS (SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS score, l.quality AS label
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
lv AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM s GROUP BY score),
c AS (SELECT score, pos, neg,
             SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp,
             SUM(pos) OVER () AS "P", SUM(neg) OVER () AS "N" FROM lv),
curve AS (SELECT score AS threshold, tp / (tp + fp) AS precision,
                 CASE WHEN "P" > 0 THEN tp / "P" ELSE 1.0 END AS recall FROM c),
chosen AS (SELECT threshold, precision, recall FROM curve WHERE recall >= 0.7
           ORDER BY precision DESC, threshold DESC LIMIT 1)"""


@register(
    "average_precision",
    f"""WITH {SQL_DOCS.strip()}
SELECT ROUND(SUM(pos * tp / (tp + fp)) / MAX("P"), 10) AS pr_auc FROM c""",
)
def q_average_precision(spark, sf_dir):
    levels = R.score_levels(scored_documents(spark, sf_dir), "label", "score")
    return R.curve_metrics(levels).select(r10("pr_auc").alias("pr_auc"))


@register(
    "roc_auc",
    f"""WITH {SQL_DOCS.strip()}
SELECT ROUND(SUM(pos * ("N" - fp + neg / 2.0)) / (MAX("P") * MAX("N")), 10) AS roc_auc FROM c""",
)
def q_roc_auc(spark, sf_dir):
    levels = R.score_levels(scored_documents(spark, sf_dir), "label", "score")
    return R.curve_metrics(levels).select(r10("roc_auc").alias("roc_auc"))


@register(
    "pr_curve",
    f"""WITH {SQL_DOCS.strip()}
SELECT threshold, ROUND(precision, 10) AS precision, ROUND(recall, 10) AS recall FROM curve""",
)
def q_pr_curve(spark, sf_dir):
    levels = R.score_levels(scored_documents(spark, sf_dir), "label", "score")
    curve = R.precision_recall_curve(levels, "score")
    return curve.select("threshold", r10("precision").alias("precision"), r10("recall").alias("recall"))


@register(
    "threshold_choice",
    f"""WITH {SQL_DOCS.strip()}
SELECT threshold, ROUND(precision, 10) AS precision, ROUND(recall, 10) AS recall FROM chosen""",
)
def q_threshold_choice(spark, sf_dir):
    levels = R.score_levels(scored_documents(spark, sf_dir), "label", "score")
    chosen = R.choose_threshold(levels, "score", minimum_recall=MINIMUM_RECALL)
    return chosen.select("threshold", r10("precision").alias("precision"), r10("recall").alias("recall"))


@register(
    "confusion",
    f"""WITH {SQL_DOCS.strip()},
m AS (SELECT COUNT(*) FILTER (WHERE s.score >= t.threshold AND s.label = 1) AS tp,
             COUNT(*) FILTER (WHERE s.score >= t.threshold AND s.label <> 1) AS fp,
             COUNT(*) FILTER (WHERE s.score < t.threshold AND s.label = 1) AS fn,
             COUNT(*) FILTER (WHERE s.score < t.threshold AND s.label <> 1) AS tn
      FROM s CROSS JOIN chosen t)
SELECT tn, fp, fn, tp,
       ROUND(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 10) AS precision,
       ROUND(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 10) AS recall,
       ROUND(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 10) AS f1
FROM m""",
)
def q_confusion(spark, sf_dir):
    scored = scored_documents(spark, sf_dir)
    levels = R.score_levels(scored, "label", "score")
    threshold = R.choose_threshold(levels, "score").select("threshold").scalar()  # scalar subquery
    out = R.confusion_at_threshold(scored, "label", "score", threshold)
    return out.select("tn", "fp", "fn", "tp", *[r10(c).alias(c) for c in ("precision", "recall", "f1")])


# --------------------------------------------------------------------------- #
# A20 -- daily top-fraction capture (flagship) and A21 monthly metrics
# --------------------------------------------------------------------------- #
SQL_FRACTIONS = "(VALUES ('Top 1%', 0.01::DOUBLE), ('Top 5%', 0.05::DOUBLE), ('Top 10%', 0.10::DOUBLE)) f(risk_group, fraction)"


@register(
    "topk_capture",
    f"""WITH {SQL_SCORED},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY score DESC, user_id) AS rk,
             COUNT(*) OVER (PARTITION BY date) AS n FROM scored),
tot AS (SELECT SUM(label) AS p FROM scored),
agg AS (SELECT f.risk_group, f.fraction,
               COUNT(*) FILTER (WHERE r.rk <= CEIL(r.n * f.fraction)) AS rows_selected,
               COALESCE(SUM(r.label) FILTER (WHERE r.rk <= CEIL(r.n * f.fraction)), 0) AS positive_rows_captured
        FROM r CROSS JOIN {SQL_FRACTIONS} GROUP BY f.risk_group, f.fraction)
SELECT risk_group, fraction, rows_selected, positive_rows_captured,
       ROUND(positive_rows_captured / (SELECT p FROM tot), 10) AS capture_rate,
       ROUND(CASE WHEN rows_selected > 0 THEN positive_rows_captured / rows_selected ELSE 0 END, 10) AS precision
FROM agg""",
)
def q_topk_capture(spark, sf_dir):
    scored = scored_panel(spark, sf_dir)
    cap = R.daily_top_capture(scored, DAY, "label", "score", [CELL], TOP_FRACTIONS)
    return cap.withColumn("capture_rate", r10("capture_rate")).withColumn("precision", r10("precision"))


def scored_orders(spark, sf_dir) -> DataFrame:
    """A many-month scored set: score = total price, label = fulfilled order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias(DAY),
        F.col("o_totalprice").alias("score"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )


ORDERS_THRESHOLD = 250000.0
SQL_ORDERS_SCORED = """
os AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS score,
              CAST(o_orderstatus = 'F' AS INTEGER) AS label, strftime(o_orderdate, '%Y-%m') AS month
       FROM orders)"""


@register(
    "monthly_metrics",
    f"""WITH {SQL_ORDERS_SCORED.strip()},
lv AS (SELECT month, score, SUM(label) AS pos, SUM(1 - label) AS neg FROM os GROUP BY month, score),
c AS (SELECT month, score, pos, neg,
             SUM(pos) OVER (PARTITION BY month ORDER BY score DESC) AS tp,
             SUM(neg) OVER (PARTITION BY month ORDER BY score DESC) AS fp,
             SUM(pos) OVER (PARTITION BY month) AS "P", SUM(neg) OVER (PARTITION BY month) AS "N" FROM lv),
cm AS (SELECT month,
              CASE WHEN MAX("P") > 0 THEN SUM(pos * tp / (tp + fp)) / MAX("P") END AS pr_auc,
              CASE WHEN MAX("P") > 0 AND MAX("N") > 0
                   THEN SUM(pos * ("N" - fp + neg / 2.0)) / (MAX("P") * MAX("N")) END AS roc_auc
       FROM c GROUP BY month),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY month, date ORDER BY score DESC, o_orderkey) AS rk,
             COUNT(*) OVER (PARTITION BY month, date) AS n FROM os),
base AS (SELECT month, MIN(date) AS start_date, MAX(date) AS end_date, COUNT(*) AS rows,
                SUM(label) AS positive_rows, AVG(label) AS positive_rate,
                COUNT(*) FILTER (WHERE score >= {ORDERS_THRESHOLD} AND label = 1) AS tp,
                COUNT(*) FILTER (WHERE score >= {ORDERS_THRESHOLD} AND label <> 1) AS fp,
                COUNT(*) FILTER (WHERE score < {ORDERS_THRESHOLD} AND label = 1) AS fn,
                SUM(label) FILTER (WHERE rk <= CEIL(n * 0.01)) AS cap1,
                SUM(label) FILTER (WHERE rk <= CEIL(n * 0.05)) AS cap5,
                SUM(label) FILTER (WHERE rk <= CEIL(n * 0.10)) AS cap10
         FROM r GROUP BY month)
SELECT b.month, b.start_date, b.end_date, b.rows, b.positive_rows, ROUND(b.positive_rate, 10) AS positive_rate,
       CAST({ORDERS_THRESHOLD} AS DOUBLE) AS threshold, ROUND(cm.pr_auc, 10) AS pr_auc, ROUND(cm.roc_auc, 10) AS roc_auc,
       ROUND(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 10) AS precision,
       ROUND(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 10) AS recall,
       ROUND(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 10) AS f1,
       ROUND(CASE WHEN b.positive_rows > 0 THEN COALESCE(cap1, 0) / b.positive_rows END, 10) AS top_1_percent_capture,
       ROUND(CASE WHEN b.positive_rows > 0 THEN COALESCE(cap5, 0) / b.positive_rows END, 10) AS top_5_percent_capture,
       ROUND(CASE WHEN b.positive_rows > 0 THEN COALESCE(cap10, 0) / b.positive_rows END, 10) AS top_10_percent_capture
FROM base b JOIN cm ON b.month = cm.month""",
)
def q_monthly_metrics(spark, sf_dir):
    from cellcast.plans.backtest import monthly_metrics

    scored = scored_orders(spark, sf_dir)
    out = monthly_metrics(scored, DAY, "label", "score", ORDERS_THRESHOLD, tie_cols=["o_orderkey"])
    rounded = [
        "positive_rate", "pr_auc", "roc_auc", "precision", "recall", "f1",
        "top_1_percent_capture", "top_5_percent_capture", "top_10_percent_capture",
    ]
    for c in rounded:
        out = out.withColumn(c, r10(c))
    return out


# --------------------------------------------------------------------------- #
# A26 -- NDCG@44 per day
# --------------------------------------------------------------------------- #
@register(
    "ndcg_daily",
    f"""WITH {SQL_SCORED},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY score DESC, user_id) AS rk FROM scored),
dd AS (SELECT date, SUM(CASE WHEN rk <= {NDCG_CUTOFF} THEN (POW(2, label) - 1) / LOG2(rk + 1) ELSE 0 END) AS dcg,
             SUM(label) AS positives FROM r GROUP BY date)
SELECT date, ROUND(dcg, 10) AS dcg, positives,
       ROUND(CASE WHEN positives > 0
                  THEN dcg / list_sum(list_transform(range(1, CAST(LEAST(positives, {NDCG_CUTOFF}) AS BIGINT) + 1), lambda i: 1 / LOG2(i + 1)))
                  ELSE 1.0 END, 10) AS ndcg
FROM dd""",
)
def q_ndcg_daily(spark, sf_dir):
    scored = scored_panel(spark, sf_dir)
    out = R.daily_ndcg(scored, DAY, "label", "score", [CELL], NDCG_CUTOFF)
    return out.select(DAY, r10("dcg").alias("dcg"), "positives", r10("ndcg").alias("ndcg"))


# --------------------------------------------------------------------------- #
# W8 + F8 -- risk tiers
# --------------------------------------------------------------------------- #
@register(
    "risk_tiers",
    f"""WITH {SQL_SCORED},
p AS (SELECT user_id, date, score, {SQL_PERCENTILE} * 100 AS risk_score FROM scored)
SELECT user_id, date, ROUND(risk_score, 6) AS risk_score,
       CASE WHEN risk_score >= 99 THEN 'Extreme' WHEN risk_score >= 95 THEN 'High'
            WHEN risk_score >= 90 THEN 'Medium' ELSE 'Low' END AS risk_level
FROM p""",
)
def q_risk_tiers(spark, sf_dir):
    s = scored_panel(spark, sf_dir).select(CELL, DAY, "score")
    p = R.average_percentile(s, [DAY], "score", "_pct").withColumn("risk_score", F.col("_pct") * 100)
    return p.select(CELL, DAY, r6("risk_score").alias("risk_score"), risk_tier(F.col("risk_score")).alias("risk_level"))


# --------------------------------------------------------------------------- #
# A24 / F22 / J12 -- blend-weight search over four daily-rank scores
# --------------------------------------------------------------------------- #
BLEND_MODELS = ["rank_total_7d", "rank_total_30d", "rank_max_3d", "rank_min_3d"]


def four_score_base(spark, sf_dir) -> DataFrame:
    """Labelled panel with four simple past-only scores, materialized once."""
    base = full_panel_df(spark, sf_dir).select(CELL, DAY, "value_total", "value_max", "value_min", "fire_today")
    feats = W.rolling_rows(base, EVENT_PAST_SPECS, False, CELL, DAY)
    labelled = W.next_day_label(feats, "fire_today", "label", CELL, DAY)
    scores = {
        "rank_total_7d": F.coalesce(r6("total_previous_7d"), F.lit(0.0)),
        "rank_total_30d": F.coalesce(r6("total_previous_30d"), F.lit(0.0)),
        "rank_max_3d": F.coalesce(F.col("max_previous_3d"), F.lit(0.0)),
        "rank_min_3d": F.coalesce(F.col("min_previous_3d"), F.lit(0.0)),
    }
    return cut_lineage(labelled.select(CELL, DAY, "label", *[v.alias(f"s_{k}") for k, v in scores.items()]))


def four_rank_panel(spark, sf_dir) -> DataFrame:
    base = four_score_base(spark, sf_dir)
    out = base
    # The base is materialized, so one quantile pass over it is a cheap file
    # scan and gives balanced buckets for all four scores.
    bounds = R.score_bounds_many(base, [f"s_{name}" for name in BLEND_MODELS])
    for name in BLEND_MODELS:
        out = R.average_percentile(out, [DAY], f"s_{name}", name, bounds=bounds[f"s_{name}"], totals_from=base)
    # Materialize the ranks: the candidate search reads them from two branches
    # (level table and bucket totals) and must not re-run the rank chain.
    return cut_lineage(out, "four_ranks")


def _sql_weights() -> str:
    rows = [
        f"({i}, {', '.join(f'CAST({w!r} AS DOUBLE)' for w in v)})"
        for i, v in enumerate(R.weight_grid(len(BLEND_MODELS), BLEND_WEIGHT_UNITS))
    ]
    cols = ", ".join(f"{m}_weight" for m in BLEND_MODELS)
    return f"(VALUES {', '.join(rows)}) wt(candidate, {cols})"


def _sql_rank(score: str, out: str) -> str:
    return (
        f"(RANK() OVER (PARTITION BY date ORDER BY {score}) - 1 + "
        f"(COUNT(*) OVER (PARTITION BY date, {score}) + 1) / 2.0) / COUNT(*) OVER (PARTITION BY date) AS {out}"
    )


SQL_FOUR = f"""{SQL_FULL.strip()},
feats AS (
  SELECT user_id, date, fire_today,
    {_sql_min_count('value_total', 'sum', 3, 'PARTITION BY user_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING', 'a', True)},
    {_sql_min_count('value_total', 'sum', 7, 'PARTITION BY user_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING', 'b', True)},
    {_sql_min_count('value_max', 'max', 1, 'PARTITION BY user_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING', 'c', False)},
    {_sql_min_count('value_min', 'min', 1, 'PARTITION BY user_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING', 'd', False)},
    LEAD(date) OVER (PARTITION BY user_id ORDER BY date) AS next_date,
    LEAD(fire_today) OVER (PARTITION BY user_id ORDER BY date) AS next_flag
  FROM panel),
lab AS (SELECT user_id, date, CAST(next_flag AS INTEGER) AS label,
               COALESCE(a, 0.0) AS sa, COALESCE(b, 0.0) AS sb, COALESCE(c, 0.0) AS sc, COALESCE(d, 0.0) AS sd
        FROM feats WHERE next_date - date = 1 AND next_flag IS NOT NULL),
ranks AS (SELECT user_id, date, label,
    {_sql_rank('sa', 'rank_total_7d')}, {_sql_rank('sb', 'rank_total_30d')},
    {_sql_rank('sc', 'rank_max_3d')}, {_sql_rank('sd', 'rank_min_3d')} FROM lab)"""


ORACLE_BLEND = f"""WITH {SQL_FOUR},
long AS (SELECT wt.*, ranks.label,
                0.0 + rank_total_7d_weight * rank_total_7d + rank_total_30d_weight * rank_total_30d
                    + rank_max_3d_weight * rank_max_3d + rank_min_3d_weight * rank_min_3d AS blended
         FROM ranks CROSS JOIN {_sql_weights()}),
lv AS (SELECT candidate, blended, SUM(label) AS pos, SUM(1 - label) AS neg FROM long GROUP BY candidate, blended),
c AS (SELECT candidate, pos, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp,
             SUM(pos) OVER (PARTITION BY candidate) AS "P"
      FROM lv WINDOW w AS (PARTITION BY candidate ORDER BY blended DESC)),
ap AS (SELECT candidate, SUM(pos * tp / (tp + fp)) / MAX("P") AS ap FROM c GROUP BY candidate)
SELECT wt.*, ROUND(ap.ap, 10) AS validation_pr_auc
FROM {_sql_weights()} JOIN ap ON wt.candidate = ap.candidate"""


@register("blend_weights", ORACLE_BLEND)
def q_blend_weights(spark, sf_dir):
    ranks = four_rank_panel(spark, sf_dir)
    out = R.blend_weight_search(ranks, "label", BLEND_MODELS, BLEND_WEIGHT_UNITS)
    return out.withColumn("validation_pr_auc", r10("validation_pr_auc"))


# --------------------------------------------------------------------------- #
# A22 / A11 -- class weights and label distribution
# --------------------------------------------------------------------------- #
@register(
    "label_distribution",
    """
SELECT quality AS label, COUNT(*) AS rows,
       ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 4) AS percent
FROM labels GROUP BY quality""",
)
def q_label_distribution(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return class_balance(labels, "quality").select(
        F.col("quality").alias("label"), "rows", F.round("percent", 4).alias("percent")
    )


@register(
    "class_weights",
    """
WITH c AS (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality),
t AS (SELECT SUM(n) AS total, SUM(n) FILTER (WHERE quality = 1) AS pos, SUM(n) FILTER (WHERE quality = 0) AS neg FROM c)
SELECT c.quality AS label, c.n AS rows, ROUND(t.total / (2.0 * c.n), 10) AS class_weight,
       ROUND(t.neg / t.pos, 10) AS imbalance_ratio, ROUND(SQRT(t.neg / t.pos), 10) AS sqrt_imbalance
FROM c CROSS JOIN t""",
)
def q_class_weights(spark, sf_dir):
    from cellcast.operators.learn import balanced_class_weights

    labels = table(spark, sf_dir, "labels")
    out = balanced_class_weights(labels, "quality")
    return out.select(
        F.col("quality").alias("label"),
        "rows",
        r10("class_weight").alias("class_weight"),
        r10("imbalance_ratio").alias("imbalance_ratio"),
        r10("sqrt_imbalance").alias("sqrt_imbalance"),
    )


@register(
    "blend_best",
    f"""WITH {SQL_FOUR},
long AS (SELECT wt.*, ranks.label,
                0.0 + rank_total_7d_weight * rank_total_7d + rank_total_30d_weight * rank_total_30d
                    + rank_max_3d_weight * rank_max_3d + rank_min_3d_weight * rank_min_3d AS blended
         FROM ranks CROSS JOIN {_sql_weights()}),
lv AS (SELECT candidate, blended, SUM(label) AS pos, SUM(1 - label) AS neg FROM long GROUP BY candidate, blended),
c AS (SELECT candidate, pos, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp,
             SUM(pos) OVER (PARTITION BY candidate) AS "P"
      FROM lv WINDOW w AS (PARTITION BY candidate ORDER BY blended DESC)),
ap AS (SELECT candidate, ROUND(SUM(pos * tp / (tp + fp)) / MAX("P"), 10) AS ap FROM c GROUP BY candidate)
SELECT wt.*, ap.ap AS validation_pr_auc
FROM {_sql_weights()} JOIN ap ON wt.candidate = ap.candidate
ORDER BY validation_pr_auc DESC, wt.candidate ASC LIMIT 1""",
)
def q_blend_best(spark, sf_dir):
    """The best weight vector by validation PR AUC, first candidate on ties."""
    ranks = four_rank_panel(spark, sf_dir)
    out = R.blend_weight_search(ranks, "label", BLEND_MODELS, BLEND_WEIGHT_UNITS, only_best=True)
    return R.best_candidate(out.withColumn("validation_pr_auc", r10("validation_pr_auc")))
