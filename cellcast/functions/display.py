"""Publishing scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellcast.fixed_values import (
    CONDITION_FALLBACK,
    CONDITION_PHRASES,
    CONDITION_PREFIX,
    CONDITION_SUFFIX,
    MAX_CONDITION_PHRASES,
    RISK_TIER_DEFAULT,
    RISK_TIERS,
)


def risk_tier(percentile: Column) -> Column:
    """F8: Extreme >= 99, High >= 95, Medium >= 90, else Low (percentile 0-100)."""
    out = None
    for cut, name in RISK_TIERS:
        out = F.when(percentile >= cut, F.lit(name)) if out is None else out.when(percentile >= cut, F.lit(name))
    return out.otherwise(F.lit(RISK_TIER_DEFAULT))


def display_round(value: Column, places: int) -> Column:
    """half-to-even rounding of the decimal value (differs from binary rounding
    only on near-ties)."""
    return F.bround(value.cast("double"), places)


def above_threshold(score: Column, threshold: float | Column) -> Column:
    """F17."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return score >= t


def grid_label(grid_id: Column) -> Column:
    """``Grid <id>``."""
    return F.concat(F.lit("Grid "), grid_id.cast("string"))


def fuel_label(fuel_model: Column) -> Column:
    """``LANDFIRE fuel model <code>``."""
    return F.concat(F.lit("LANDFIRE fuel model "), fuel_model.cast("string"))


def condition_summary(temperature: Column, humidity: Column, wind: Column, rain: Column) -> Column:
    """up to three condition phrases in display order, else the fallback sentence."""
    values = {
        "temperature_max": temperature,
        "humidity_min": humidity,
        "wind_speed_max": wind,
        "precipitation_total": rain,
    }
    phrases = []
    for column, op, limit, phrase in CONDITION_PHRASES:
        v = values[column]
        hit = v >= F.lit(limit) if op == ">=" else v <= F.lit(limit)
        phrases.append(F.when(hit, F.lit(phrase)))
    chosen = F.slice(F.array_compact(F.array(*phrases)), 1, MAX_CONDITION_PHRASES)
    body = F.when(F.size(chosen) > 0, F.array_join(chosen, ", ")).otherwise(F.lit(CONDITION_FALLBACK))
    return F.concat(F.lit(CONDITION_PREFIX), body, F.lit(CONDITION_SUFFIX))


def is_stale(prediction_date: Column, now: Column | None = None) -> Column:
    """the prediction day ended before ``now`` (pass now as a parameter)."""
    now = now if now is not None else F.current_timestamp()
    end_of_day = F.to_timestamp(F.concat(prediction_date.cast("string"), F.lit(" 23:59:59")))
    return end_of_day < now
