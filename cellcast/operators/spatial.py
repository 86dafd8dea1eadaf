"""Spatial operators without a geometry library.

Points meet cells by an equi-join on square buckets: :mod:`.polygons` deals edges
to buckets (J6, J10), :mod:`.nearest` lays centroids out in a quadtree (J7).  The
join is left to the optimizer, which broadcasts the small side by its measured
size; otherwise AQE splits a bucket that holds very many points.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.fixed_values import CLUSTER_PIXELS_BY_ZOOM, GRID_ID_FORMAT
from cellcast.functions.display import risk_tier
from cellcast.functions.geo import web_mercator_pixel
from cellcast.operators.nearest import enforce_all_assigned, nearest_cell
from cellcast.operators.polygons import clip_cells, point_in_polygon
from cellcast.operators.windows import sequential_ids

__all__ = [
    "clip_cells",
    "cluster_pixels",
    "enforce_all_assigned",
    "generate_grid",
    "nearest_cell",
    "pin_clusters",
    "point_in_polygon",
    "select_region",
    "viewport_filter",
    "zonal_statistics",
]


def select_region(boundaries: DataFrame, column: str, value: str) -> DataFrame:
    """One region from a boundary table by equality; an empty result is an error."""
    region = boundaries.filter(F.col(column) == F.lit(value))
    if region.limit(1).count() == 0:
        raise ValueError(f"No region has {value!r} in {column}.")
    return region


# --------------------------------------------------------------------------- #
# Grid generation
# --------------------------------------------------------------------------- #
def generate_grid(
    spark,
    min_x: float,
    min_y: float,
    max_x: float,
    max_y: float,
    size: float,
    id_format: str = GRID_ID_FORMAT,
) -> DataFrame:
    """Square cells ``[min + i*size, min + (i+1)*size)`` covering ``[min, max)``, x outer, y inner.

    Cell count per axis is ``ceil((max - min) / size)``.  Ids are sequential in
    (ix, iy) order.  Columns: grid_id, ix, iy, x0, y0, x1, y1, ring.
    """
    nx = max(1, math.ceil((max_x - min_x) / size))
    ny = max(1, math.ceil((max_y - min_y) / size))
    cells = spark.range(nx * ny).select(
        (F.col("id") / ny).cast("long").alias("ix"), (F.col("id") % ny).alias("iy")
    )
    cells = cells.select(
        "ix",
        "iy",
        (F.lit(min_x) + F.col("ix") * F.lit(size)).alias("x0"),
        (F.lit(min_y) + F.col("iy") * F.lit(size)).alias("y0"),
        (F.lit(min_x) + (F.col("ix") + 1) * F.lit(size)).alias("x1"),
        (F.lit(min_y) + (F.col("iy") + 1) * F.lit(size)).alias("y1"),
    )
    cells = cells.withColumn("ring", box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    return sequential_ids(cells, ("ix", "iy"), "grid_id", id_format)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed counter-clockwise ring of an axis-aligned box."""

    def p(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    return F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))


# --------------------------------------------------------------------------- #
# Zonal statistics of a pixel table
# --------------------------------------------------------------------------- #
def zonal_statistics(
    pixels: DataFrame,
    cells: DataFrame,
    x_col: str = "x",
    y_col: str = "y",
    mean_col: str | None = "value",
    mode_col: str | None = None,
    nodata: float | None = None,
    id_col: str = "grid_id",
    ring_col: str = "ring",
    bucket: float = 10000.0,
    holes_col: str | None = None,
) -> DataFrame:
    """Per cell: mean of ``mean_col`` and the most frequent ``mode_col`` (tie -> lowest).

    Pixel centres strictly inside the cell and in no hole count; nodata and NaN are removed;
    a cell without valid pixels gets nulls (left join from the cells).  The
    mode is a two-level aggregation (cell, value) -> counts -> max, so a huge
    cell is reduced map-side.
    """

    def valid(c: str) -> Column:
        v = F.col(c)
        ok = v.isNotNull() & ~F.isnan(v.cast("double"))
        if nodata is not None:
            ok = ok & (v != F.lit(nodata))
        return ok

    located = point_in_polygon(pixels, cells, x_col, y_col, id_col, ring_col, bucket, "_cell", holes_col)
    # A cell of several parts is one cell.
    results = cells.select(F.col(id_col)).distinct()
    if mean_col:
        mean = located.filter(valid(mean_col)).groupBy(F.col("_cell").alias(id_col)).agg(
            F.avg(F.col(mean_col).cast("double")).alias(f"{mean_col}_mean")
        )
        results = results.join(mean, id_col, "left")
    if mode_col:
        counts = located.filter(valid(mode_col)).groupBy("_cell", mode_col).agg(F.count(F.lit(1)).alias("_n"))
        mode = counts.groupBy(F.col("_cell").alias(id_col)).agg(
            F.max(F.struct(F.col("_n"), F.negative(F.col(mode_col)).alias("_neg"))).alias("_m")
        ).select(id_col, F.negative(F.col("_m._neg")).alias(f"{mode_col}_mode"))
        results = results.join(mode, id_col, "left")
    return results


# --------------------------------------------------------------------------- #
# Zoom-dependent clustering of published pins
# --------------------------------------------------------------------------- #
def cluster_pixels(zoom: int) -> int:
    for max_zoom, pixels in CLUSTER_PIXELS_BY_ZOOM:
        if zoom <= max_zoom:
            return pixels
    return 0


def pin_clusters(
    pins: DataFrame, zoom: int, lat_col: str = "lat", lng_col: str = "lng", score_col: str = "risk_score"
) -> DataFrame:
    """Pins grouped by Web-Mercator pixel cell at ``zoom``: mean score, mean
    centre, count, tier of the mean.  From zoom 9 every pin is its own group."""
    size = cluster_pixels(zoom)
    px, py = web_mercator_pixel(F.col(lat_col), F.col(lng_col), zoom)
    if size == 0:
        keyed = pins.withColumn("cx", F.lit(None).cast("long")).withColumn("cy", F.lit(None).cast("long"))
        return keyed.select(
            "cx", "cy",
            F.col(score_col).alias("average_score"),
            F.col(lat_col).alias("lat"),
            F.col(lng_col).alias("lng"),
            F.lit(1).cast("long").alias("count"),
            risk_tier(F.col(score_col)).alias("risk_level"),
        )
    keyed = pins.withColumn("cx", F.floor(px / size)).withColumn("cy", F.floor(py / size))
    agg = keyed.groupBy("cx", "cy").agg(
        F.avg(score_col).alias("average_score"),
        F.avg(lat_col).alias("lat"),
        F.avg(lng_col).alias("lng"),
        F.count(F.lit(1)).alias("count"),
    )
    return agg.withColumn("risk_level", risk_tier(F.col("average_score")))


def viewport_filter(pins: DataFrame, south: float, west: float, north: float, east: float, pad: float = 0.25,
                    tiers: Sequence[str] | None = None, lat_col: str = "lat", lng_col: str = "lng",
                    score_col: str = "risk_score", tier_col: str = "risk_level") -> DataFrame:
    """P20: valid pins (finite lat/lng/score, known tier), chosen tiers, padded bounding box."""
    dlat, dlng = (north - south) * pad, (east - west) * pad
    finite = F.lit(True)
    for c in (lat_col, lng_col, score_col):
        finite = finite & F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) != F.lit(float("inf")))
    known = F.col(tier_col).isin("Extreme", "High", "Medium", "Low")
    chosen = F.col(tier_col).isin(list(tiers)) if tiers else F.lit(True)
    box = F.col(lat_col).between(south - dlat, north + dlat) & F.col(lng_col).between(west - dlng, east + dlng)
    return pins.filter(finite & known & chosen & box)
