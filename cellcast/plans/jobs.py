"""The batch jobs, wired from landed files to outputs.

Each job is a function of paths and parameters (no CLI parsing), runs as one
Spark application, and writes only at stage boundaries worth reusing.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellcast.fixed_values import (
    BACKTEST_FOLDS,
    GRID_CELL_METRES,
    HISTORY_YEARS,
    MAX_ASSIGN_DISTANCE_METRES,
    PERTURBED_WEATHER,
    REFERENCE_COLUMNS,
    STATIC_COLUMNS,
    TRAINING_REQUIRED,
    WEATHER_COLUMNS,
)
from cellcast.functions.dates import detection_day
from cellcast.functions.geo import albers_inverse, albers_xy
from cellcast.operators import contracts as C
from cellcast.operators import panel as P
from cellcast.operators import profile as PR
from cellcast.operators import spatial as S
from cellcast.operators.polygons import closed_ring
from cellcast.operators.windows import dedupe_keep, sequential_ids
from cellcast.plans import backtest as B
from cellcast.plans import daily_scoring as D
from cellcast.plans.training_table import build_model_panel, build_training_table, lookup
from cellcast.session import cut_lineage
from cellcast.sinks import writers as K
from cellcast.sources import readers as RD


def assign_detections(
    detections: DataFrame,
    centroids: DataFrame,
    max_distance: float = MAX_ASSIGN_DISTANCE_METRES,
    strict: bool = True,
) -> DataFrame:
    """Detections (lat/lon, acq_date, HHMM) -> (grid_id, date, frp, distance).

    Both sides are projected to metres (F14) and matched with the exact
    bucketed nearest-cell join (J7); with ``strict`` any detection farther than
    ``max_distance`` raises, as in the reference.
    """
    dx, dy = albers_xy(F.col("longitude"), F.col("latitude"))
    pts = detections.select(
        detection_day(F.col("acq_date"), F.col("acq_time")).alias("date"),
        F.col("frp"),
        dx.alias("px"),
        dy.alias("py"),
    )
    cx, cy = albers_xy(F.col("centroid_lon"), F.col("centroid_lat"))
    cells = centroids.select("grid_id", cx.alias("cx"), cy.alias("cy"))
    assigned = S.nearest_cell(pts, cells, "px", "py", "grid_id", "cx", "cy", max_distance)
    if strict:
        S.enforce_all_assigned(assigned, "grid_id", max_distance)
    return assigned.select("grid_id", "date", "frp", "assignment_distance_m")


def assign_detections_within(detections: DataFrame, grid_rings: DataFrame, bucket_degrees: float = 0.1) -> DataFrame:
    """Detections -> (grid_id, date, frp) by strict ``within`` on the cell
    polygons stored in lon/lat (J6); detections outside every cell are dropped."""
    pts = detections.select(
        detection_day(F.col("acq_date"), F.col("acq_time")).alias("date"),
        F.col("frp"),
        F.col("longitude").alias("px"),
        F.col("latitude").alias("py"),
    )
    holes = "holes" if "holes" in grid_rings.columns else None
    located = S.point_in_polygon(pts, grid_rings, "px", "py", "grid_id", "ring", bucket_degrees, "grid_id", holes)
    return located.select("grid_id", "date", "frp")


def run_training_table(
    spark: SparkSession,
    weather_path: str,
    detections_csv: str | Sequence[str],
    centroids_path: str,
    static_path: str,
    history_path: str,
    output_dir: str,
    grid_geojson: str | None = None,
    satellite: str | None = None,
    year: int | None = None,
) -> str:
    """Landed detections + weather + attributes -> training table (Parquet,
    CSV, 5,000-row sample), with every weather measure of the input and the cells'
    centroids.

    Detections are refused if any has no place or date, occurs twice, or, where
    these are given, comes from another satellite or year.

    Detections are assigned to the nearest centroid within 10 km (all must
    match), or, with ``grid_geojson``, strictly within the cell polygons
    (misses dropped) -- the two flavours the reference uses for different
    years; their counts are not interchangeable.
    """
    det = RD.read_detection_csv(spark, detections_csv)
    C.enforce_zero(C.detection_report(det, satellite, year), "Detections")
    centroids = RD.read_columns(spark, centroids_path, ["grid_id", "centroid_lat", "centroid_lon"])
    if grid_geojson:
        assigned = assign_detections_within(det, RD.read_grid_geojson(spark, grid_geojson))
    else:
        assigned = assign_detections(det, centroids)
    daily = P.daily_cell_events(assigned, "grid_id", "date", "frp")
    landed = spark.read.parquet(weather_path)
    C.require_columns(landed, WEATHER_COLUMNS[:2] + ["precipitation_total", "temperature_max", "humidity_min"], "Weather")
    weather = landed.select(*[c for c in WEATHER_COLUMNS if c in landed.columns])
    weather = lookup(weather.withColumn("date", F.to_date("date")), centroids, "grid_id", "Centroids")
    static = spark.read.parquet(static_path)
    history = spark.read.parquet(history_path)
    table = build_training_table(weather, daily, static, history)
    out = os.path.join(output_dir, "training_table")
    K.write_parquet_and_csv(table, out + ".parquet", out + "_csv")
    K.write_sample(table, out + "_sample")
    return out + ".parquet"


def run_validation(spark: SparkSession, table_path: str, output_dir: str, required: Sequence[str] = TRAINING_REQUIRED) -> str:
    """Required columns, then the profiles of a training table: size, nulls, numbers, months."""
    table = spark.read.parquet(table_path)
    C.require_columns(table, required, "Training")
    numbers = [c for c, t in table.dtypes if t in ("double", "float", "int", "bigint")]
    reports = {
        "profile": PR.table_profile(table, "grid_id", "date", "fire_next_day"),
        "nulls": PR.null_fractions(table),
        "numbers": PR.describe_numeric(table, numbers),
        "months": PR.monthly_label_stats(table, "date", "fire_next_day"),
    }
    for name, report in reports.items():
        K.write_new(report, os.path.join(output_dir, name))
    return output_dir


def run_model_panel(
    spark: SparkSession,
    panel_paths: Sequence[str],
    season_path: str,
    static_path: str,
    output_path: str,
    required: Sequence[str],
) -> str:
    """E2's input: yearly grid-days one after the other, features that stay in their
    year, the season before and the static attributes, in date order."""
    panel = None
    for path in panel_paths:
        part = spark.read.parquet(path)
        panel = part if panel is None else panel.unionByName(part)
    panel = panel.withColumn("date", F.to_date("date"))
    static = RD.read_columns(spark, static_path, STATIC_COLUMNS)
    data = build_model_panel(panel, spark.read.parquet(season_path), required, static=static)
    # Range-sorted files: a fold reads only the days it needs.
    K.write_new(data.orderBy("date", "grid_id"), output_path)
    return output_path


def run_grid_build(
    spark: SparkSession, boundary: DataFrame, geojson_path: str, centroids_path: str, size: float = GRID_CELL_METRES
) -> DataFrame:
    """Square cells over a region, clipped by it, numbered after the clip; grid file and centroids.

    ``boundary``: a row per part of the region, ``ring`` and ``holes`` in metres.
    Returns (grid_id, centroid_lat, centroid_lon, polygons in degrees).
    """
    corner = boundary.select(F.explode("ring").alias("p")).agg(F.min("p.x"), F.min("p.y"), F.max("p.x"), F.max("p.y")).first()
    grid = S.generate_grid(spark, *[float(v) for v in corner], size).drop("grid_id")
    clipped = S.clip_cells(grid.withColumn("cell_key", F.struct("ix", "iy")), boundary, "cell_key", "ring", "holes")
    cells = sequential_ids(clipped.select("*", "grid_key.*"), ("ix", "iy"), "grid_id")
    cells = albers_inverse(cells, "centroid_x", "centroid_y", "centroid_lon", "centroid_lat")
    # Corners go back to degrees one by one and are then put together again.
    corners = cells.select("grid_id", F.posexplode("pieces").alias("piece", "r")).select(
        "grid_id", "piece", "r.hole", F.posexplode(closed_ring(F.col("r.ring"))).alias("at", "c")
    )
    corners = albers_inverse(corners.select("grid_id", "piece", "hole", "at", "c.x", "c.y"), "x", "y", "lon", "lat")
    place = F.struct("at", F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("c"))
    rings = corners.groupBy("grid_id", "piece", "hole").agg(F.array_sort(F.collect_list(place)).alias("ring"))
    rings = rings.withColumn("ring", F.transform("ring", lambda p: p["c"]))
    # A hole belongs to the one outer ring of its cell; with several parts it follows the first.
    outer = F.col("hole").cast("int")
    lists = rings.groupBy("grid_id").agg(F.array_sort(F.collect_list(F.struct(outer.alias("hole"), "piece", "ring"))).alias("r"))
    parts = F.transform(F.filter("r", lambda x: x["hole"] == 0), lambda x: F.array(x["ring"]))
    holes = F.transform(F.filter("r", lambda x: x["hole"] == 1), lambda x: x["ring"])
    polygons = F.transform(parts, lambda p, i: F.when(i == 0, F.concat(p, holes)).otherwise(p))
    lists = lists.select("grid_id", polygons.alias("polygons"))
    out = cut_lineage(cells.select("grid_id", "centroid_lat", "centroid_lon").join(lists, "grid_id"), "grid")
    K.write_grid(out, geojson_path, centroids_path)
    return out


def run_static_attributes(
    spark: SparkSession,
    cover_path: str,
    fuel_path: str,
    grid_geojson: str,
    output_path: str,
    nodata: float | None = None,
    bucket_degrees: float = 0.1,
) -> str:
    """Two pixel tables and the cells -> mean cover and most frequent fuel model of every cell;
    a cell without pixels of either is marked as missing."""
    cells = RD.read_grid_geojson(spark, grid_geojson)
    zone = dict(nodata=nodata, bucket=bucket_degrees, holes_col="holes")
    cover = S.zonal_statistics(RD.read_pixels(spark, cover_path), cells, mean_col="value", **zone)
    fuel = S.zonal_statistics(RD.read_pixels(spark, fuel_path), cells, mean_col=None, mode_col="value", **zone)
    table = cover.join(fuel, "grid_id").select(
        "grid_id",
        F.col("value_mean").alias("vegetation_cover_mean"),
        F.col("value_mode").cast("int").alias("fuel_model_dominant"),
        (F.col("value_mean").isNull() | F.col("value_mode").isNull()).cast("int").alias("landfire_missing"),
    )
    K.write_new(table.orderBy("grid_id"), output_path)
    return output_path


def run_history_summary(
    spark: SparkSession, detections_csv: str | Sequence[str], grid_geojson: str, output_dir: str, years: tuple[int, int] = HISTORY_YEARS
) -> str:
    """Detections of past years within the cells -> counts, days and years of every cell (Parquet and CSV)."""
    det = RD.read_detection_csv(spark, detections_csv)
    cells = RD.read_grid_geojson(spark, grid_geojson)
    within = assign_detections_within(det, cells)
    summary = cut_lineage(P.history_summary(within, cells.select("grid_id").distinct(), years=years), "history")
    C.enforce_zero(C.history_invariants(summary, f"{years[0]}_{years[1]}", years[1] - years[0] + 1), "History summary")
    out = os.path.join(output_dir, "history_summary")
    K.write_parquet_and_csv(summary, out + ".parquet", out + "_csv")
    return out + ".parquet"


def run_season_summary(
    spark: SparkSession, daily_path: str, cells_path: str, output_dir: str, history_years: Sequence[int]
) -> str:
    """Daily detections -> each cell's last season, by year (one folder a year)."""
    cells = spark.read.parquet(cells_path).select("grid_id").distinct()
    summary = cut_lineage(P.season_summary(spark.read.parquet(daily_path), cells, history_years), "season")
    K.write_by_year(summary, output_dir, expected_per_year=cells.count())
    return output_dir


def run_inference_grid(spark: SparkSession, source_path: str, output_path: str, columns: Sequence[str] = REFERENCE_COLUMNS) -> str:
    """One row per cell of its position and height; conflicting or missing values are refused."""
    source = RD.read_columns(spark, source_path, columns)
    K.write_new(C.static_slice(source, columns[0], columns[1:]).orderBy(columns[0]), output_path)
    return output_path


def run_backtest(
    spark: SparkSession,
    panel_path: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    output_dir: str,
    season_path: str | None = None,
    folds: Sequence[tuple[str, str, str, str]] = BACKTEST_FOLDS,
    feature_fn: Callable[[DataFrame], DataFrame] | None = None,
    feature_cols: Sequence[str] = (),
    perturb: dict[str, float] = PERTURBED_WEATHER,
    audit_dates: Sequence[dt.date] = (),
    lookback: int = 62,
    **model_params,
) -> DataFrame:
    """Leakage audit first (raises on failure), then the resumable backtest.

    ``feature_fn`` adds ``feature_cols`` to the panel by cell.  Before any model is
    fitted they are computed again with the weather replaced from each audit date
    on (by default the first day of every test slice); a feature that changes on
    that date looks ahead, and the run is refused.
    """
    panel = spark.read.parquet(panel_path).withColumn("date", F.to_date("date"))
    if season_path:
        years = sorted({int(f[1][:4]) for f in folds})
        audit = B.prior_year_audit(spark.read.parquet(season_path), years, None).collect()
        B.enforce_audit(audit)
    if feature_fn:
        dates = list(audit_dates) or sorted({dt.date.fromisoformat(f[2]) for f in folds})
        B.enforce_past_only(
            B.perturbation_audit(panel, {"features": (feature_fn, list(feature_cols))}, dates, perturb, lookback=lookback)
        )
        panel = feature_fn(panel)
    return B.rolling_backtest(panel, numeric, categorical, output_dir, folds=folds, **model_params)


def run_daily_scoring(
    spark: SparkSession,
    weather_inputs: Sequence[str],
    static_path: str,
    history_path: str,
    reference_path: str | None,
    scorer: Callable[[DataFrame], DataFrame],
    metadata: dict,
    model_name: str,
    output_dir: str,
    feature_date: str | dt.date | None = None,
    expected_grid_count: int | None = None,
) -> str:
    """Overlapping weather files (newest wins) -> next-day features -> scores
    -> published document (versioned folder + pointer)."""
    weather = RD.read_ordered_parquet(spark, weather_inputs, WEATHER_COLUMNS)
    weather = dedupe_keep(weather.withColumn("date", F.to_date("date")), ["grid_id", "date"], ["_source_order"], "last")
    reference = spark.read.parquet(reference_path) if reference_path else None
    features = D.build_next_day_features(
        weather.drop("_source_order"), spark.read.parquet(static_path), spark.read.parquet(history_path),
        reference, feature_date, validate="inline",
    )
    features = cut_lineage(features, "features")
    locations, day, next_day = D.score_locations(features, scorer, metadata, expected_grid_count)
    return D.write_nested(locations, D.document_header(day, next_day, model_name), output_dir)
