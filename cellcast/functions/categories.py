"""Categorical and coercion scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellcast.fixed_values import CATEGORICAL_MISSING_TOKEN


def category_string(value: Column, as_type: str | None = None, missing: str = CATEGORICAL_MISSING_TOKEN) -> Column:
    """category -> string with a missing token.

    Cast to a fixed type first (``as_type``) so 270 and 270.0 agree across
    training and scoring inputs.
    """
    v = value.cast(as_type) if as_type else value
    return F.coalesce(v.cast("string"), F.lit(missing))


def numeric_or_null(value: Column) -> Column:
    """numeric coercion; unparseable -> null."""
    return value.cast("string").try_cast("double")


def missing_flag_string(flag: Column) -> Column:
    """missing flag -> fill True -> string."""
    return F.coalesce(flag.cast("boolean"), F.lit(True)).cast("string")
