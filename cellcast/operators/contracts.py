"""Data contracts.

Each check has two forms: a lazy DataFrame of a few rows (usable as a query
and composable), and an ``enforce_*`` helper that runs that one small job and
raises.  All counts of one table are folded into
one aggregate, so a contract costs one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellcast.fixed_values import DETECTION_KEY


def side_by_side(base: DataFrame, *one_row_frames: DataFrame) -> DataFrame:
    """Attach the columns of single-row aggregates to every row of ``base``.

    Each one-row frame becomes a scalar subquery (``DataFrame.scalar()``),
    evaluated once and inlined as a value -- no join, no row multiplication.
    """
    out = base
    for i, other in enumerate(one_row_frames):
        packed = other.select(F.struct(*other.columns).alias("_s")).scalar()
        name = f"_scalar{i}"
        out = out.withColumn(name, packed).select(
            *[c for c in out.columns], *[F.col(f"{name}.{c}").alias(c) for c in other.columns]
        )
    return out


# --------------------------------------------------------------------------- #
# Contracts that ride along: no job of their own
# --------------------------------------------------------------------------- #
def guard(column: Column, violation: Column, message: str | Column) -> Column:
    """``column``, or an error in the job that reads it, where ``violation`` holds.

    Put on a key or another column that the result keeps: an unused column is
    pruned, and its check with it.
    """
    return F.when(violation, F.raise_error(message)).otherwise(column)


def unique_side(dim: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """P16 / J14 inside the plan: one row per key, or an error naming the key.

    The grouping shuffles by the join key, which the join needs anyway.
    """
    others = [c for c in dim.columns if c not in keys]
    row = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*others) if others else F.lit(1)).alias("_row"))
    message = F.concat(F.lit(f"{source}: more than one row for "), F.to_json(F.struct(*keys)))
    first, *rest = keys
    return row.select(
        guard(F.col(first), F.col("_n") > 1, message).alias(first), *rest, *[F.col(f"_row.{c}").alias(c) for c in others]
    )


def unique_days(df: DataFrame, cell_col: str, date_col: str, source: str) -> DataFrame:
    """P16 for a panel: an error where a cell has a day twice.

    The window is that of the rolling features, so the plan sorts once for both.
    """
    before = F.lag(date_col).over(Window.partitionBy(cell_col).orderBy(date_col))
    message = F.concat(F.lit(f"{source}: more than one row for "), F.to_json(F.struct(cell_col, date_col)))
    return df.withColumn("_before", before).withColumn(
        date_col, guard(F.col(date_col), F.col("_before") == F.col(date_col), message)
    ).drop("_before")


def guard_complete(df: DataFrame, required: Sequence[str], key: str) -> DataFrame:
    """P9 inside the plan: an error naming the first row met that lacks a required value."""
    message = F.concat(F.lit("missing static, current, or rolling inputs, such as "), F.col(key).cast("string"))
    return df.withColumn(key, guard(F.col(key), incomplete_rows(df, required), message))


# --------------------------------------------------------------------------- #
# Required columns (metadata only, no job)
# --------------------------------------------------------------------------- #
def require_columns(df: DataFrame, columns: Sequence[str], source: str = "Input") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{source}: columns {missing} are not there.")


# --------------------------------------------------------------------------- #
# Duplicates and checked joins
# --------------------------------------------------------------------------- #
def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of duplicate rows (``sum(count - 1)``) and duplicated keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )


def assert_unique(df: DataFrame, keys: Sequence[str], source: str = "Input") -> None:
    row = duplicate_report(df, keys).first()
    if row["duplicate_rows"]:
        raise ValueError(f"{source} contains {row['duplicate_rows']:,} duplicate grid IDs.")


def checked_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    validate: str = "many_to_one",
    check_left: bool = True,
    source: str = "Lookup",
) -> DataFrame:
    """Join after asserting the cardinality (``one_to_one`` or ``many_to_one``).

    The uniqueness test is an aggregate on the key only (partial aggregation,
    no full-row shuffle).
    """
    if validate not in ("one_to_one", "many_to_one"):
        raise ValueError(f"Unsupported validate mode: {validate}")
    assert_unique(right, on, f"{source} right side")
    if validate == "one_to_one" and check_left:
        assert_unique(left, on, f"{source} left side")
    return left.join(right, list(on), how)


# --------------------------------------------------------------------------- #
# nulls
# --------------------------------------------------------------------------- #
def _null_or_nan(c: str, dtype: str) -> Column:
    column = F.col(c)
    if dtype in ("double", "float"):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def incomplete_rows(df: DataFrame, required: Sequence[str]) -> Column:
    types = dict(df.dtypes)
    cond = F.lit(False)
    for c in required:
        cond = cond | _null_or_nan(c, types[c])
    return cond


def first_keys(df: DataFrame, key: str, n: int = 10):
    """Up to ``n`` smallest keys as an array scalar subquery (a top-k, bounded)."""
    return df.select(key).orderBy(key).limit(n).agg(F.collect_list(key).alias("k")).scalar()


def null_report(df: DataFrame, required: Sequence[str], key: str = "grid_id", examples: int = 10) -> DataFrame:
    """One row: count of rows with any required value missing, and up to N example keys."""
    bad = incomplete_rows(df, required)
    return df.agg(F.count_if(bad).alias("incomplete_rows")).withColumn(
        "examples", first_keys(df.filter(bad), key, examples)
    )


def enforce_complete(df: DataFrame, required: Sequence[str], key: str = "grid_id") -> None:
    bad = incomplete_rows(df, required)
    n = df.agg(F.count_if(bad)).first()[0]
    if n:
        examples = [r[0] for r in df.filter(bad).select(key).orderBy(key).limit(10).collect()]
        raise ValueError(
            f"{n:,} rows with missing static, current, or rolling inputs, such as {examples}"
        )


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with nulls (or NaN) in ``subset``."""
    return df.filter(~incomplete_rows(df, subset))


# --------------------------------------------------------------------------- #
# Domain checks folded into one aggregate
# --------------------------------------------------------------------------- #
def domain_report(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """One row with ``count_if(violation)`` per named predicate (predicate = violation)."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def enforce_zero(report: DataFrame, message: str = "Contract violated") -> None:
    row = report.first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise ValueError(f"{message}: {bad}")


def history_invariants(summary: DataFrame, suffix: str = "2020_2023", years: int = 4) -> DataFrame:
    """P11 for the fixed-window history summary."""
    n = F.col(f"historical_firms_detection_count_{suffix}")
    d = F.col(f"historical_fire_active_days_{suffix}")
    y = F.col(f"historical_fire_active_years_{suffix}")
    return domain_report(
        summary,
        {
            "missing_grid_ids": F.col("grid_id").isNull(),
            "missing_values": n.isNull() | d.isNull() | y.isNull(),
            "negative_counts": (n < 0) | (d < 0) | (y < 0),
            "years_over_limit": y > years,
            "days_over_detections": d > n,
            "years_over_days": y > d,
        },
    )


# --------------------------------------------------------------------------- #
# P12 / P13 / P14 / P15 / P17
# --------------------------------------------------------------------------- #
def source_report(df: DataFrame, column: str, expected: str) -> DataFrame:
    """One row: rows of the expected source, rows of others, and whether the
    values, nulls aside, are exactly the expected one."""
    own = F.count_if(F.col(column) == F.lit(expected))
    others = F.count_if(F.col(column) != F.lit(expected))
    return df.agg(own.alias("expected_rows"), others.alias("other_rows")).withColumn(
        "single_source", (F.col("expected_rows") > 0) & (F.col("other_rows") == 0)
    )


def enforce_single_source(df: DataFrame, column: str, expected: str) -> None:
    row = source_report(df, column, expected).first()
    if not row["single_source"]:
        raise ValueError(f"{row['other_rows']:,} rows come from another {column} than {expected!r}, {row['expected_rows']:,} from it.")


def detection_report(
    detections: DataFrame, satellite: str | None = None, year: int | None = None, keys: Sequence[str] = DETECTION_KEY
) -> DataFrame:
    """P12, P13, P16 for landed detections: one row of violation counts.

    All of them follow from the key columns, so detections are counted by key and
    the counts are summed: one pass, one shuffle of keys.
    """
    per_key = detections.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    day = F.try_to_timestamp(F.col("acq_date").cast("string"), F.lit("yyyy-MM-dd"))
    n = F.col("_n")

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    invalid = day.isNull()
    for c in ("latitude", "longitude"):
        invalid = invalid | F.col(c).isNull() | F.isnan(F.col(c))
    counts = [
        rows(invalid).alias("invalid_rows"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicate_rows"),
    ]
    if satellite is not None:
        counts.append(rows(F.col("satellite") != satellite).alias("other_satellite_rows"))
        counts.append((rows(F.col("satellite") == satellite) == 0).cast("bigint").alias("without_satellite"))
    if year is not None:
        counts.append(rows(F.year(day) != year).alias("other_year_rows"))
    return per_key.agg(*counts)


def coercion_report(df: DataFrame, date_col: str, fmt: str | None, coord_cols: Sequence[str]) -> DataFrame:
    """One row: unparseable dates and missing coordinates."""
    parsed = F.try_to_timestamp(F.col(date_col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(date_col))
    preds = {"invalid_dates": F.col(date_col).isNotNull() & parsed.isNull() | F.col(date_col).isNull()}
    for c in coord_cols:
        preds[f"missing_{c}"] = F.col(c).isNull() | F.isnan(F.col(c))
    return domain_report(df, preds)


def scoring_report(df: DataFrame, key: str, dates: Sequence[str] = ("feature_date", "prediction_date")) -> DataFrame:
    """P9, P14-P16 of a scoring table: one row of its size, key faults and date ranges."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(_any_null(dates)).alias("_undated"),
        *[F.min(F.to_date(c)).alias(f"_min_{c}") for c in dates],
        *[F.max(F.to_date(c)).alias(f"_max_{c}") for c in dates],
    )
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("_n"), zero).alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), zero).alias("null_ids"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("_n") - 1)), zero).alias("duplicate_rows"),
        F.coalesce(F.sum("_undated"), zero).alias("undated_rows"),
        *[F.min(f"_min_{c}").alias(f"min_{c}") for c in dates],
        *[F.max(f"_max_{c}").alias(f"max_{c}") for c in dates],
    )


def _any_null(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


def single_date(df: DataFrame, column: str):
    """Exactly one distinct date; returns it."""
    if column not in df.columns:
        raise ValueError(f"No column {column} in the scoring table.")
    rows = df.select(F.to_date(column).alias("d")).distinct().limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"The scoring table needs one {column} for all rows.")
    return rows[0]["d"]


def enforce_row_count(df: DataFrame, expected: int | None) -> int:
    """Expected row count; returns the count."""
    return check_row_count(df.count(), expected)


def check_row_count(n: int, expected: int | None) -> int:
    if expected is not None and n != expected:
        raise ValueError(f"Wrong number of rows: expected {expected:,}, received {n:,}.")
    return n


def non_finite(column: Column) -> Column:
    return column.isNull() | F.isnan(column) | (F.abs(column) == F.lit(float("inf")))


def finite_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: values of each column that are missing, infinite or not numbers."""
    return df.agg(*[F.count_if(non_finite(F.col(c))).alias(c) for c in columns])


def enforce_finite(df: DataFrame, column: str) -> None:
    n = finite_report(df, [column]).first()[0]
    if n:
        raise ValueError(f"{n:,} values of {column} are missing, infinite or not numbers.")


# --------------------------------------------------------------------------- #
# coverage
# --------------------------------------------------------------------------- #
def coverage_report(
    expected: DataFrame, actual: DataFrame, key: str = "grid_id", examples: int = 10
) -> DataFrame:
    """One row: ids missing from ``actual`` and unexpected in it, with examples.

    One full outer join on the key (both sides reduced to distinct keys first).
    """
    e = expected.select(key).distinct().withColumn("_e", F.lit(True))
    a = actual.select(key).distinct().withColumn("_a", F.lit(True))
    both = e.join(a, key, "full_outer")
    missing = F.col("_a").isNull()
    unexpected = F.col("_e").isNull()
    return both.agg(
        F.count_if(missing).alias("missing"),
        F.count_if(unexpected).alias("unexpected"),
    ).withColumn("missing_examples", first_keys(both.filter(missing), key, examples))


def enforce_coverage(expected: DataFrame, actual: DataFrame, key: str = "grid_id") -> None:
    row = coverage_report(expected, actual, key).first()
    if row["missing"] or row["unexpected"]:
        raise ValueError(
            "The two sets of cells differ. "
            f"Missing grids: {row['missing']:,} (such as {list(row['missing_examples'])}); "
            f"beyond the expected set: {row['unexpected']:,}."
        )


# --------------------------------------------------------------------------- #
# A6 / A7 / A8
# --------------------------------------------------------------------------- #
def conflicting_keys(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys whose attributes take more than one value, null counted as a value.

    Least against greatest value and a count of values: one aggregate, no row
    expansion per attribute.
    """
    changes = []
    for c in attributes:
        differ = F.coalesce(F.min(c) != F.max(c), F.lit(False))
        some_null = (F.count(c) > 0) & (F.count(c) < F.count(F.lit(1)))
        changes.append((differ | some_null).alias(f"{c}_changes"))
    per_key = df.groupBy(key).agg(*changes)
    any_change = F.lit(False)
    for c in attributes:
        any_change = any_change | F.col(f"{c}_changes")
    return per_key.filter(any_change)


def static_slice(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """The distinct static slice; rejects keys with conflicting values and nulls."""
    distinct = df.select(key, *attributes).distinct()
    conflicts = conflicting_keys(df, key, attributes).limit(1).count()
    if conflicts:
        raise ValueError("Static attributes change within a grid.")
    enforce_complete(distinct, [key, *attributes], key)
    return distinct


def conservation_report(before: DataFrame, after: DataFrame, column: str, after_column: str | None = None) -> DataFrame:
    """One row: the totals before and after an aggregation, and whether they agree."""
    b = before.agg(F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias("total_before"))
    a = after.agg(F.coalesce(F.sum(after_column or column), F.lit(0)).cast("bigint").alias("total_after"))
    return side_by_side(b, a).withColumn("conserved", F.col("total_before") == F.col("total_after"))


def enforce_conservation(before: DataFrame, after: DataFrame, column: str, after_column: str | None = None) -> None:
    row = conservation_report(before, after, column, after_column).first()
    if not row["conserved"]:
        raise ValueError(f"Detections were {row['total_before']:,} before they were summed, and are {row['total_after']:,}.")


# --------------------------------------------------------------------------- #
# Season summary contract
# --------------------------------------------------------------------------- #
def season_summary_report(summary: DataFrame, key: str = "grid_id") -> DataFrame:
    """One row of violations for the prior-year season table."""
    start_ok = (F.month("window_start") == 5) & (F.dayofmonth("window_start") == 1)
    end_ok = (F.month("window_end") == 10) & (F.dayofmonth("window_end") == 30)
    dups = (
        summary.groupBy(key, "history_year")
        .count()
        .agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count") - 1)), F.lit(0)).alias("duplicate_rows"))
    )
    checks = summary.agg(
        F.count_if(F.col("feature_year") != F.col("history_year") + 1).alias("bad_feature_year"),
        F.count_if(~start_ok | ~end_ok).alias("bad_window"),
        F.count_if(F.col("prior_year_firms_detection_count") < 0).alias("negative_counts"),
        F.countDistinct(key).alias("cells"),
    )
    per_year = (
        summary.groupBy("feature_year")
        .agg(F.countDistinct(key).alias("n"))
        .agg(F.min("n").alias("min_cells_per_year"))
    )
    return side_by_side(checks, dups, per_year)
