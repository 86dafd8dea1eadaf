"""Ranks, percentiles and exact ranking metrics without single-partition windows.

Every ordering here ("rank within a day", "precision at every distinct score")
is computed with one pattern:

1. Cut the score axis into ordered buckets that are a fixed function of the
   score (stable under recompute and executor loss).  By default the bucket is
   the score's binade split into 64 slices (:func:`log_bucket`), which needs
   no pass over the data; explicit boundaries (for example from one
   ``approxQuantile`` pass, :func:`score_bounds`) can be given instead.
2. Total each (group, bucket) -- a table of at most groups x buckets rows --
   and take exclusive prefix sums over the buckets of a group.
3. Join the offsets back and finish the ordering inside (group, bucket)
   partitions, which Spark can spread over the whole cluster.

Boundaries affect only balance, never results: equal scores always share a
bucket.  A hot day or group is cut into as many pieces as it spans score
ranges.  Ties never pile up in one task: percentiles and curves work on
distinct (group, score) levels, and the ordinal rank splits a tie set by
buckets of its tie key (:func:`ordinal_rank_split_ties`).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellcast.fixed_values import MINIMUM_RECALL, NDCG_CUTOFF, TOP_FRACTIONS
from cellcast.session import cut_lineage, shuffle_partitions, ship_package

_BUCKET = "_score_bucket"


# --------------------------------------------------------------------------- #
# bucketing primitives
# --------------------------------------------------------------------------- #
def default_bucket_count(df: DataFrame) -> int:
    return max(2, min(512, 2 * shuffle_partitions(df.sparkSession)))


def score_bounds(
    df: DataFrame,
    score_col: str,
    n_buckets: int | None = None,
    relative_error: float = 0.001,
) -> list[float]:
    """Interior bucket boundaries (ascending, distinct) from one quantile pass."""
    n_buckets = n_buckets or default_bucket_count(df)
    if n_buckets <= 1:
        return []
    probabilities = [i / n_buckets for i in range(1, n_buckets)]
    quantiles = df.select(F.col(score_col).cast("double").alias("_s")).approxQuantile(
        "_s", probabilities, relative_error
    )
    return sorted({float(q) for q in quantiles if q is not None and math.isfinite(q)})


def score_bounds_many(
    df: DataFrame,
    score_cols: Sequence[str],
    n_buckets: int | None = None,
    relative_error: float = 0.001,
) -> dict[str, list[float]]:
    """Boundaries for several score columns from one quantile pass."""
    n_buckets = n_buckets or default_bucket_count(df)
    probabilities = [i / n_buckets for i in range(1, n_buckets)]
    cast = df.select(*[F.col(c).cast("double").alias(c) for c in score_cols])
    result = cast.approxQuantile(list(score_cols), probabilities, relative_error)
    return {
        c: sorted({float(q) for q in qs if q is not None and math.isfinite(q)})
        for c, qs in zip(score_cols, result)
    }


def bucket_of(score: Column, bounds: Sequence[float]) -> Column:
    """Index = number of boundaries <= score, as a balanced CASE tree (depth log2 B)."""

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(score >= F.lit(bounds[mid - 1]), build(mid, hi)).otherwise(
            build(lo, mid - 1)
        )

    return build(0, len(bounds)).cast("int")


LOG_SLICES = 64  # buckets per binade (power of two)
_NULL_BUCKET = -(1 << 40)


def log_bucket(score: Column, slices: int = LOG_SLICES) -> Column:
    """Order-preserving bucket of a double with no data pass.

    Positive ``x`` = m * 2^e with m in [1, 2): bucket ``e * slices + floor((m - 1) * slices)``
    (``e`` from ``log2`` and then corrected exactly, so rounding near powers of
    two cannot break monotonicity); zero sits between negatives and positives;
    negatives mirror positives.  Equal scores share a bucket, larger scores
    never get a smaller bucket.  Null/NaN go to one sentinel bucket.
    """
    x = score.cast("double")
    a = F.abs(x)
    finite = (a > F.lit(0.0)) & (a < F.lit(float("inf")))
    safe = F.when(finite, a).otherwise(F.lit(1.0))  # keeps log2/floor in range
    e0 = F.floor(F.log2(safe))
    m0 = safe / F.pow(F.lit(2.0), e0)
    e = F.when(m0 >= 2.0, e0 + 1).when(m0 < 1.0, e0 - 1).otherwise(e0)
    m = safe / F.pow(F.lit(2.0), e)
    magnitude = e * F.lit(slices) + F.floor((m - F.lit(1.0)) * F.lit(slices))
    offset = F.lit(2 * 1100 * slices)  # larger than any |magnitude|
    top = F.lit(4 * 1100 * slices)  # infinities
    key = (
        F.when(F.isnan(x), top + 1)  # Spark orders NaN above +inf
        .when(x == F.lit(float("inf")), top)
        .when(x == F.lit(float("-inf")), -top)
        .when(x > 0, offset + magnitude)
        .when(x < 0, -(offset + magnitude))
        .when(x == 0, F.lit(0))
    )
    return F.coalesce(key.cast("long"), F.lit(_NULL_BUCKET))


def _window(partition: Sequence[str]) -> Window:
    return Window.partitionBy(*partition) if partition else Window.partitionBy()


def bucket_offsets(
    df: DataFrame,
    group_cols: Sequence[str],
    measures: Sequence[str],
    descending: bool,
) -> DataFrame:
    """Per (group, bucket): exclusive prefix (``_off_m``) and group total (``_all_m``).

    The input is already bucketed; the output has groups x buckets rows.
    """
    totals = df.groupBy(*group_cols, _BUCKET).agg(
        *[F.sum(m).alias(f"_tot_{m}") for m in measures]
    )
    order = F.col(_BUCKET).desc() if descending else F.col(_BUCKET).asc()
    before = _window(group_cols).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = _window(group_cols)
    columns = []
    for m in measures:
        columns.append(F.coalesce(F.sum(f"_tot_{m}").over(before), F.lit(0)).alias(f"_off_{m}"))
        columns.append(F.sum(f"_tot_{m}").over(whole).alias(f"_all_{m}"))
    offsets = totals.select(*group_cols, _BUCKET, *columns)
    if not group_cols:
        # Proven size bound: one row per bucket (at most ~2^18 log buckets).
        offsets = F.broadcast(offsets)
    return offsets


def bucket_expr(score: Column, bounds: Sequence[float] | None) -> Column:
    """Explicit boundaries -> CASE tree; ``None`` -> :func:`log_bucket` (no data pass)."""
    return log_bucket(score) if bounds is None else bucket_of(score, bounds)


def _bucketed(df: DataFrame, score_col: str, bounds: Sequence[float] | None) -> DataFrame:
    return df.withColumn(_BUCKET, bucket_expr(F.col(score_col), bounds))


# --------------------------------------------------------------------------- #
# Ranks within groups
# --------------------------------------------------------------------------- #
def ordinal_rank(
    df: DataFrame,
    group_cols: Sequence[str],
    score_col: str,
    tie_cols: Sequence[str] = (),
    descending: bool = True,
    output_col: str = "daily_rank",
    size_col: str | None = "group_rows",
    bounds: Sequence[float] | None = None,
    split_ties: bool = True,
) -> DataFrame:
    """1-based position within the group by score, ties broken by ``tie_cols`` ascending.

    Equals ``rank(method="first")`` on input ordered by the tie columns.
    With ``split_ties`` (the default) this is :func:`ordinal_rank_split_ties`,
    which also spreads one score shared by a huge number of rows over many
    tasks; without tie columns a deterministic row hash orders the ties.
    ``split_ties=False`` orders rows inside (group, score-bucket) partitions,
    for callers whose scores are unique.
    """
    if split_ties and tie_cols:
        return ordinal_rank_split_ties(df, group_cols, score_col, tie_cols, descending, output_col, size_col, bounds)
    if split_ties:
        # No tie-break requested: any order among equal scores is valid, so a
        # deterministic row hash orders (and splits) a tie set.
        hashed = df.withColumn("_row_hash", F.xxhash64(*df.columns))
        ranked = ordinal_rank_split_ties(
            hashed, group_cols, score_col, ["_row_hash", *df.columns], descending, output_col, size_col, bounds
        )
        return ranked.drop("_row_hash")
    b = _bucketed(df, score_col, bounds)
    offsets = bucket_offsets(b.select(*group_cols, _BUCKET, F.lit(1).alias("_one")), group_cols, ["_one"], descending)
    joined = _null_safe_join(b, offsets, [*group_cols, _BUCKET])
    score_order = F.col(score_col).desc() if descending else F.col(score_col).asc()
    local = Window.partitionBy(*group_cols, _BUCKET).orderBy(
        score_order, *[F.col(c).asc() for c in tie_cols]
    )
    out = joined.withColumn(output_col, (F.col("_off__one") + F.row_number().over(local)).cast("long"))
    if size_col:
        out = out.withColumn(size_col, F.col("_all__one").cast("long"))
    return out.drop(_BUCKET, "_off__one", "_all__one")


def _tie_bucket(df: DataFrame, col: str, prefix: int) -> Column:
    """Order-preserving coarse bucket of a tie key: log buckets for numbers, a
    fixed-length prefix for strings (same prefix -> same bucket)."""
    dtype = df.schema[col].dataType.typeName()
    if dtype in ("integer", "long", "short", "byte", "double", "float", "decimal"):
        return log_bucket(F.col(col))
    if dtype == "string":
        return F.coalesce(F.substring(F.col(col), 1, prefix), F.lit(""))
    return F.lit(0)


def ordinal_rank_split_ties(
    df: DataFrame,
    group_cols: Sequence[str],
    score_col: str,
    tie_cols: Sequence[str],
    descending: bool = True,
    output_col: str = "daily_rank",
    size_col: str | None = "group_rows",
    bounds: Sequence[float] | None = None,
    tie_prefix: int = 6,
) -> DataFrame:
    """W7 that stays spread out when one score holds a large share of a group.

    rank = (rows of the group with a strictly better score)
         + (position inside the tie set by ``tie_cols``).
    The first term comes from distinct (group, score) levels (ties collapse in
    a partial aggregation; bucketed prefix over levels).  The second is a
    bucketed prefix over the first tie column inside each tie set, so a hot
    tie set is split across (group, score, tie-bucket) partitions.  Exact.
    """
    levels = df.groupBy(*group_cols, score_col).agg(F.count(F.lit(1)).alias("_n"))
    levels = levels.withColumn(_BUCKET, bucket_expr(F.col(score_col), bounds))
    offsets = bucket_offsets(levels, group_cols, ["_n"], descending)
    order = F.col(score_col).desc() if descending else F.col(score_col).asc()
    before = Window.partitionBy(*group_cols, _BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    level_table = _null_safe_join(levels, offsets, [*group_cols, _BUCKET]).select(
        *group_cols,
        score_col,
        (F.col("_off__n") + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_better"),
        F.col("_all__n").alias("_group_rows"),
    )
    keyed = df.withColumn("_tb", _tie_bucket(df, tie_cols[0], tie_prefix))
    tie_groups = [*group_cols, score_col]
    tie_totals = keyed.groupBy(*tie_groups, "_tb").agg(F.count(F.lit(1)).alias("_t"))
    tie_before = Window.partitionBy(*tie_groups).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    tie_offsets = tie_totals.select(
        *tie_groups, "_tb", F.coalesce(F.sum("_t").over(tie_before), F.lit(0)).alias("_tie_off")
    )
    local = Window.partitionBy(*tie_groups, "_tb").orderBy(*[F.col(c).asc() for c in tie_cols])
    joined = _null_safe_join(keyed, level_table, tie_groups)
    joined = _null_safe_join(joined, tie_offsets, [*tie_groups, "_tb"])
    out = joined.withColumn(
        output_col, (F.col("_better") + F.col("_tie_off") + F.row_number().over(local)).cast("long")
    )
    if size_col:
        out = out.withColumn(size_col, F.col("_group_rows").cast("long"))
    return out.drop("_tb", "_better", "_group_rows", "_tie_off")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null matches null (a null score or group is a
    level of its own, so no row is lost)."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def average_percentile(
    df: DataFrame,
    group_cols: Sequence[str],
    score_col: str,
    output_col: str = "daily_percentile",
    bounds: Sequence[float] | None = None,
    totals_from: DataFrame | None = None,
) -> DataFrame:
    """Average-tie ascending rank divided by group size (single row -> 1.0).

    This is ``rank(method="average", pct=True)``; it differs from Spark's
    ``percent_rank`` and ``cume_dist`` on ties and at the ends.

    Computed on distinct (group, score) levels: ties collapse in a partial
    aggregation, the prefix runs over levels (bucketed), and rows join back on
    (group, score) -- a score shared by a third of all rows is one level row,
    and AQE's skew join splits the row side of that key.  ``totals_from``
    (same rows, e.g. a checkpointed base) feeds the level counts, so chained
    ranks scan the base instead of re-evaluating the chain.  Null scores get
    a null percentile.
    """
    source = df if totals_from is None else totals_from
    levels = source.where(F.col(score_col).isNotNull()).groupBy(*group_cols, score_col).agg(
        F.count(F.lit(1)).alias("_ties")
    )
    levels = levels.withColumn(_BUCKET, bucket_expr(F.col(score_col), bounds))
    offsets = bucket_offsets(levels, group_cols, ["_ties"], descending=False)
    joined = _null_safe_join(levels, offsets, [*group_cols, _BUCKET])
    before = (
        Window.partitionBy(*group_cols, _BUCKET)
        .orderBy(F.col(score_col).asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    less = F.col("_off__ties") + F.coalesce(F.sum("_ties").over(before), F.lit(0))
    table = joined.select(
        *group_cols,
        score_col,
        ((less + (F.col("_ties") + F.lit(1)) / F.lit(2.0)) / F.col("_all__ties")).alias(output_col),
    )
    return _null_safe_join(df, table, [*group_cols, score_col], "left")


def query_ids(df: DataFrame, date_col: str = "date", output_col: str = "query_id") -> DataFrame:
    """Contiguous 0-based id per distinct day.

    Distinct days are numbered with the distributed ordinal rank on the day
    number (no global window), then broadcast back: the day table is bounded
    by the calendar.
    """
    days = df.select(date_col).distinct().withColumn("_day_number", F.unix_date(F.col(date_col)))
    numbered = ordinal_rank(
        days, [], "_day_number", (), descending=False, output_col="_qid", size_col=None, split_ties=False
    )  # day numbers are unique: no ties to split
    numbered = numbered.select(date_col, (F.col("_qid") - 1).cast("long").alias(output_col))
    return df.join(F.broadcast(numbered), date_col, "left")


# --------------------------------------------------------------------------- #
# Curves over distinct scores
# --------------------------------------------------------------------------- #
def score_levels(
    df: DataFrame,
    label_col: str,
    score_col: str,
    group_cols: Sequence[str] = (),
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """One row per (group, distinct score) with cumulative counts, score descending.

    Columns: ``pos``/``neg`` at the level, ``tp``/``fp`` at ``score >= level``,
    and group totals ``P``/``N``.
    """
    y = F.col(label_col).cast("long")
    rows = df.select(*group_cols, F.col(score_col), y.alias("pos"), (F.lit(1) - y).alias("neg"))
    return counted_levels(rows, score_col, group_cols, bounds)


def counted_levels(
    counts: DataFrame,
    score_col: str,
    group_cols: Sequence[str] = (),
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """:func:`score_levels` of rows that carry ``pos`` and ``neg`` counts.

    The bucket totals are sums over the level table, so both sides of the join
    start from one exchange and the rows are read once.
    """
    rows = counts.withColumn(_BUCKET, bucket_expr(F.col(score_col), bounds))
    levels = rows.groupBy(*group_cols, _BUCKET, score_col).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    offsets = bucket_offsets(levels, group_cols, ["pos", "neg"], descending=True)
    joined = _null_safe_join(levels, offsets, [*group_cols, _BUCKET])
    running = (
        Window.partitionBy(*group_cols, _BUCKET)
        .orderBy(F.col(score_col).desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return joined.select(
        *group_cols,
        F.col(score_col),
        "pos",
        "neg",
        (F.col("_off_pos") + F.sum("pos").over(running)).alias("tp"),
        (F.col("_off_neg") + F.sum("neg").over(running)).alias("fp"),
        F.col("_all_pos").alias("P"),
        F.col("_all_neg").alias("N"),
    )


def curve_metrics(levels: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """A17 average precision (step sum) and A18 ROC AUC (average-rank) per group.

    One-class groups give null, by choice.
    """
    return levels.groupBy(*group_cols).agg(*_curve_sums()).select(*group_cols, *_curve_columns())


def _curve_sums() -> list[Column]:
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return [
        F.max("P").alias("_P"),
        F.max("N").alias("_N"),
        F.sum(F.col("pos") * precision).alias("_ap"),
        F.sum(F.col("pos") * (F.col("N") - F.col("fp") + F.col("neg") / F.lit(2.0))).alias("_auc"),
    ]


def _curve_columns() -> list[Column]:
    return [
        F.when(F.col("_P") > 0, F.col("_ap") / F.col("_P")).alias("pr_auc"),
        F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_auc") / (F.col("_P") * F.col("_N"))).alias(
            "roc_auc"
        ),
    ]


def precision_recall_curve(levels: DataFrame, score_col: str) -> DataFrame:
    """Precision and recall for ``score >= threshold`` at every distinct score.

    With no positives recall is 1 everywhere (the convention of the common
    library), precision 0.
    """
    return levels.select(
        "*",
        F.col(score_col).alias("threshold"),
        F.coalesce(F.col("tp") / (F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(F.lit(1.0)).alias("recall"),
    )


def choose_threshold(
    levels: DataFrame,
    score_col: str,
    group_cols: Sequence[str] = (),
    minimum_recall: float = MINIMUM_RECALL,
) -> DataFrame:
    """Highest precision among thresholds with recall >= minimum; tie -> higher threshold.

    If no threshold reaches the recall, the lowest threshold with the maximum
    recall is taken.
    """
    curve = precision_recall_curve(levels, score_col)
    ok = F.col("recall") >= F.lit(float(minimum_recall))
    best = curve.groupBy(*group_cols).agg(
        F.max(F.when(ok, F.struct("precision", "threshold", "recall"))).alias("_ok"),
        F.max(F.struct("recall", F.negative("threshold").alias("neg_t"), "precision")).alias("_fb"),
    )
    return best.select(
        *group_cols,
        F.coalesce(F.col("_ok.threshold"), F.negative(F.col("_fb.neg_t"))).alias("threshold"),
        F.coalesce(F.col("_ok.precision"), F.col("_fb.precision")).alias("precision"),
        F.coalesce(F.col("_ok.recall"), F.col("_fb.recall")).alias("recall"),
    )


# --------------------------------------------------------------------------- #
# Confusion counts at a threshold
# --------------------------------------------------------------------------- #
def confusion_at_threshold(
    df: DataFrame,
    label_col: str,
    score_col: str,
    threshold: float | Column,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Counts, precision, recall and F1 for ``score >= threshold``; zero division -> 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    predicted = F.col(score_col) >= t
    actual = F.col(label_col) == 1
    agg = df.groupBy(*group_cols).agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(~predicted & ~actual).alias("tn"),
    )
    return agg.select(*group_cols, *_confusion_columns())


def _confusion_columns() -> list[Column]:
    return [
        *[F.col(c) for c in ("tn", "fp", "fn", "tp")],
        _safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _safe_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    ]


def _safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def binary_metrics(
    df: DataFrame,
    label_col: str,
    score_col: str,
    threshold: float | Column,
    group_cols: Sequence[str] = (),
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """The metric record of a scored set: PR AUC, ROC AUC, precision, recall, F1.

    The counts at the threshold are sums over the same level table as the curve.
    """
    levels = score_levels(df, label_col, score_col, group_cols, bounds)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    predicted = F.col(score_col) >= t

    def count(rows: Column, column: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(rows, F.col(column))), F.lit(0)).cast("long").alias(name)

    agg = levels.groupBy(*group_cols).agg(
        *_curve_sums(),
        count(predicted, "pos", "_tp"),
        count(predicted, "neg", "_fp"),
        count(~predicted, "pos", "_fn"),
        count(~predicted, "neg", "_tn"),
    )
    agg = agg.select(
        *group_cols, *_curve_columns(), *[F.col(f"_{c}").alias(c) for c in ("tn", "fp", "fn", "tp")]
    )
    return agg.select(*group_cols, "pr_auc", "roc_auc", *_confusion_columns())


# --------------------------------------------------------------------------- #
# Daily top-fraction capture
# --------------------------------------------------------------------------- #
def _fraction_label(fraction: float) -> str:
    return f"Top {fraction * 100:.0f}%"


def daily_top_capture(
    df: DataFrame,
    date_col: str,
    label_col: str,
    score_col: str,
    tie_cols: Sequence[str] = (),
    fractions: Sequence[float] = TOP_FRACTIONS,
    group_cols: Sequence[str] = (),
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """Rows whose daily rank is within ``ceil(day_rows * fraction)``, per fraction.

    One output row per (group, fraction): rows selected, positives captured,
    capture rate (of all positives in the group) and precision.  All fractions
    are counted in one pass; no cross join.
    """
    for fraction in fractions:
        if not 0 < fraction <= 1:
            raise ValueError("A top fraction lies within (0, 1].")
    ranked = ordinal_rank(
        df,
        [*group_cols, date_col],
        score_col,
        tie_cols,
        descending=True,
        output_col="_rank",
        size_col="_day_rows",
        bounds=bounds,
    )
    label = F.col(label_col).cast("long")
    sums = [F.sum(label).alias("_positives")]
    for i, fraction in enumerate(fractions):
        chosen = F.col("_rank") <= F.ceil(F.col("_day_rows") * F.lit(float(fraction)))
        sums.append(F.count_if(chosen).alias(f"_sel{i}"))
        sums.append(F.sum(F.when(chosen, label).otherwise(F.lit(0))).alias(f"_cap{i}"))
    agg = ranked.groupBy(*group_cols).agg(*sums)
    per_fraction = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(_fraction_label(f)).alias("risk_group"),
                    F.lit(float(f)).alias("fraction"),
                    F.col(f"_sel{i}").alias("rows_selected"),
                    F.col(f"_cap{i}").alias("positive_rows_captured"),
                )
                for i, f in enumerate(fractions)
            ]
        )
    ).alias("_f")
    rows = agg.select(*group_cols, "_positives", per_fraction)
    return rows.select(
        *group_cols,
        "_f.risk_group",
        "_f.fraction",
        "_f.rows_selected",
        "_f.positive_rows_captured",
        F.when(F.col("_positives") > 0, F.col("_f.positive_rows_captured") / F.col("_positives")).alias(
            "capture_rate"
        ),
        _safe_ratio(F.col("_f.positive_rows_captured"), F.col("_f.rows_selected")).alias("precision"),
    )


def require_positives(capture: DataFrame) -> DataFrame:
    """Raise like the reference when a ranking group has no positives.

    The capture table has groups x fractions rows, so the check is small.
    """
    empty = capture.filter(F.col("capture_rate").isNull()).limit(1).count()
    if empty:
        raise ValueError("A ranked group holds no positive row.")
    return capture


# --------------------------------------------------------------------------- #
# NDCG@k per day
# --------------------------------------------------------------------------- #
def daily_ndcg(
    df: DataFrame,
    date_col: str,
    label_col: str,
    score_col: str,
    tie_cols: Sequence[str] = (),
    k: int = NDCG_CUTOFF,
    group_cols: Sequence[str] = (),
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """Mean over days of NDCG@k with gain 2^y - 1 for binary labels.

    A day without positives scores 1 (the ranking library's convention).  The
    ideal DCG of a binary day is the closed form over its first
    ``min(k, positives)`` positions.
    """
    ranked = ordinal_rank(
        df, [*group_cols, date_col], score_col, tie_cols, True, "_rank", None, bounds
    )
    gain = F.pow(F.lit(2.0), F.col(label_col).cast("double")) - F.lit(1.0)
    discount = F.log2(F.col("_rank") + F.lit(1))
    per_day = ranked.groupBy(*group_cols, date_col).agg(
        F.sum(F.when(F.col("_rank") <= k, gain / discount).otherwise(F.lit(0.0))).alias("dcg"),
        F.sum(F.col(label_col).cast("long")).alias("positives"),
    )
    ideal_len = F.least(F.col("positives"), F.lit(k)).cast("int")
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.greatest(ideal_len, F.lit(1))),
        F.lit(0.0),
        lambda acc, i: acc + F.when(i <= ideal_len, F.lit(1.0) / F.log2(i + F.lit(1))).otherwise(F.lit(0.0)),
    )
    per_day = per_day.withColumn(
        "ndcg", F.when(F.col("positives") > 0, F.col("dcg") / ideal).otherwise(F.lit(1.0))
    )
    return per_day


# --------------------------------------------------------------------------- #
# Rank blending
# --------------------------------------------------------------------------- #
def blend(rank_cols: Sequence[str], weights: Sequence[float]) -> Column:
    """Weighted sum of daily ranks, accumulated left to right."""
    total: Column = F.lit(0.0)
    for name, weight in zip(rank_cols, weights, strict=True):
        total = total + F.lit(float(weight)) * F.col(name)
    return total


def weight_grid(n_models: int, units: int) -> list[tuple[float, ...]]:
    """All weight vectors in steps of 1/units that sum to one, in product order."""
    vectors: list[tuple[float, ...]] = []

    def walk(prefix: list[int]) -> None:
        if len(prefix) == n_models:
            if sum(prefix) == units:
                vectors.append(tuple(u / units for u in prefix))
            return
        for u in range(units + 1):
            walk([*prefix, u])

    walk([])
    return vectors


#: Buckets of the blended score, and their ceiling for the table of counts.
BLEND_BUCKETS = 1 << 14


def _blended(batch: pa.RecordBatch, rank_cols: Sequence[str], vectors: np.ndarray) -> np.ndarray:
    """rows x candidates: the same sums, in the same order, as :func:`blend`."""
    total = np.zeros((batch.num_rows, len(vectors)))
    for i, name in enumerate(rank_cols):
        ranks = pc.fill_null(batch.column(name).cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
        total = total + vectors[:, i] * ranks[:, None]
    return total


def _blend_bucket(scores: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the score; what lies outside [0, 1) goes to the end buckets."""
    at = np.nan_to_num(scores * buckets, nan=0.0, posinf=buckets, neginf=0)
    return np.clip(at, 0, buckets - 1).astype(np.int64)


_BLEND_ROWS = 4096


def _count_buckets(rank_cols: Sequence[str], vectors: np.ndarray, buckets: int):
    """Positives and negatives of every (candidate, bucket) in a task's rows."""
    names = ["candidate", "bucket", "pos", "neg"]

    def run(batches):
        cells = len(vectors) * buckets
        pos, neg = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
        offset = np.arange(len(vectors)) * buckets
        for whole in batches:
            for start in range(0, whole.num_rows, _BLEND_ROWS):
                batch = whole.slice(start, _BLEND_ROWS)
                cell = _blend_bucket(_blended(batch, rank_cols, vectors), buckets) + offset
                y = batch.column("y").to_numpy(zero_copy_only=False)
                np.add.at(pos, cell[y == 1].ravel(), 1)
                np.add.at(neg, cell[y == 0].ravel(), 1)
        some = np.flatnonzero(pos + neg)
        columns = [some // buckets, some % buckets, pos[some], neg[some]]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _open_rows(rank_cols: Sequence[str], vectors: np.ndarray, wanted: np.ndarray, open_cells: np.ndarray, buckets: int):
    """(candidate, bucket, score, pos, neg) of the rows in open buckets, equal scores of a batch together."""
    names = ["candidate", "bucket", "blended_score", "pos", "neg"]

    def run(batches):
        is_open = np.zeros(len(wanted) * buckets, bool)
        is_open[open_cells] = True
        offset = np.arange(len(wanted)) * buckets
        for whole in batches:
            for start in range(0, whole.num_rows, _BLEND_ROWS):
                batch = whole.slice(start, _BLEND_ROWS)
                scores = _blended(batch, rank_cols, vectors[wanted])
                bucket = _blend_bucket(scores, buckets)
                row, candidate = np.nonzero(is_open[bucket + offset])
                y = batch.column("y").to_numpy(zero_copy_only=False)[row]
                keys, back = np.unique(
                    np.rec.fromarrays([candidate, bucket[row, candidate], scores[row, candidate]]), return_inverse=True
                )
                pos = np.bincount(back, weights=y, minlength=len(keys)).astype(np.int64)
                n = np.bincount(back, minlength=len(keys)).astype(np.int64)
                columns = [wanted[keys.f0], keys.f1, keys.f2, pos, n - pos]
                yield pa.record_batch(
                    [pa.array(c, pa.float64() if i == 2 else pa.int64()) for i, c in enumerate(columns)], names
                )

    return run


def blend_weight_search(
    df: DataFrame,
    label_col: str,
    rank_cols: Sequence[str],
    units: int,
    only_best: bool = False,
    buckets: int = BLEND_BUCKETS,
) -> DataFrame:
    """Exact average precision of every candidate weight vector, in two reads of the rows.

    The first read counts positives and negatives per candidate and score bucket:
    a table of candidates x buckets, however many rows there are.  Precision at a
    positive needs an exact order only inside buckets that hold a positive and
    something else; the second read gives the rows of those alone.  Positives are
    rare, so almost every row stays where it is.

    With ``only_best`` the counts also bound each candidate's average precision
    from both sides; candidates whose upper bound is below another's lower bound
    are left out before the second read.  Output: candidate index, weights, AP.
    """
    spark = df.sparkSession
    ship_package(spark)
    grid = weight_grid(len(rank_cols), units)
    vectors = np.array(grid)
    rows = df.select(*rank_cols, F.col(label_col).cast("long").alias("y"))
    counts = rows.mapInArrow(
        _count_buckets(rank_cols, vectors, buckets), "candidate long, bucket long, pos long, neg long"
    )
    counts = counts.groupBy("candidate", "bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    better = Window.partitionBy("candidate").orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    counts = cut_lineage(
        counts.select(
            "*",
            F.coalesce(F.sum("pos").over(better), zero).alias("tp"),
            F.coalesce(F.sum("neg").over(better), zero).alias("fp"),
        ),
        "blend-counts",
    )
    wanted = np.arange(len(grid))
    if only_best:
        wanted = np.array(_contenders(counts), dtype=np.int64)
    # Candidates x buckets flags at most; the driver and every task hold them as bits.
    mixed = counts.where("pos > 0 and pos + neg > 1").where(F.col("candidate").isin([int(w) for w in wanted]))
    found = mixed.select("candidate", "bucket").toArrow()
    place = np.full(len(grid), -1)
    place[wanted] = np.arange(len(wanted))
    open_cells = place[found.column("candidate").to_numpy()] * buckets + found.column("bucket").to_numpy()
    exact = rows.mapInArrow(
        _open_rows(rank_cols, vectors, wanted, open_cells, buckets),
        "candidate long, bucket long, blended_score double, pos long, neg long",
    )
    levels = exact.groupBy("candidate", "bucket", "blended_score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    levels = levels.join(counts.select("candidate", "bucket", "tp", "fp"), ["candidate", "bucket"])
    inside = Window.partitionBy("candidate", "bucket").orderBy(F.col("blended_score").desc())
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    tp = F.col("tp") + F.sum("pos").over(upto)
    fp = F.col("fp") + F.sum("neg").over(upto)
    # A positive alone in its bucket needs no second look.
    alone = counts.where("pos = 1 and neg = 0").where(F.col("candidate").isin([int(w) for w in wanted]))
    gains = levels.select("candidate", F.col("pos"), tp.alias("tp"), fp.alias("fp")).unionByName(
        alone.select("candidate", "pos", (F.col("tp") + 1).alias("tp"), "fp")
    )
    sums = gains.groupBy("candidate").agg(F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("gain"))
    totals = counts.groupBy("candidate").agg(F.sum("pos").alias("P"))
    ap = totals.join(sums, "candidate").select("candidate", (F.col("gain") / F.col("P")).alias("validation_pr_auc"))
    weights = spark.createDataFrame(
        [(int(i), *grid[i]) for i in wanted], "candidate long, " + ", ".join(f"{c}_weight double" for c in rank_cols)
    )
    return weights.join(ap, "candidate", "left")


def _contenders(counts: DataFrame) -> list[int]:
    """Candidates that may be best, from bounds on average precision by buckets.

    A bucket's positives gain most if they are one level above its negatives, and
    least if they come one by one after them.  1e-9 covers rounding of the sums.
    """
    n_pos, n_neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    bounds = counts.groupBy("candidate").agg(
        F.sum(F.when(n_pos > 0, n_pos * (tp + n_pos) / (tp + n_pos + fp)).otherwise(0.0)).alias("high"),
        F.sum(F.when(n_pos > 0, n_pos * (tp + 1) / (tp + 1 + fp + n_neg)).otherwise(0.0)).alias("low"),
    ).collect()  # a line per candidate
    floor = max((r["low"] for r in bounds), default=0.0)
    return sorted(r["candidate"] for r in bounds if r["high"] * (1 + 1e-9) >= floor)


def best_candidate(results: DataFrame, metric_col: str = "validation_pr_auc") -> DataFrame:
    """The single best row by metric, first candidate on ties (one
    top-1 pass; the candidate table is small)."""
    return results.orderBy(F.col(metric_col).desc_nulls_last(), F.col("candidate").asc()).limit(1)
