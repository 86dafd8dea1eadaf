"""Checks inside the plan, the leakage audit, and the grid, panel and summary jobs."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cellcast.operators import contracts as C
from cellcast.operators import windows as W
from cellcast.plans import backtest as B
from cellcast.plans import jobs as J
from cellcast.plans.training_table import build_model_panel, build_training_table

PANEL = "grid_id string, date date, precipitation_total double, temperature_max double, humidity_min double, fire_today int"
SPECS = [(3, "precipitation_total", "sum", 1, "rain_previous_3d")]


def panel_rows(days=40, cells=("a", "b")):
    first = dt.date(2024, 7, 1)
    return [(g, first + dt.timedelta(days=i), float(i % 7), 20.0 + i % 5, 30.0, int(i % 6 == 0)) for g in cells for i in range(days)]


def training_inputs(spark):
    rows = [r[:5] for r in panel_rows(10)]
    weather = spark.createDataFrame(rows, PANEL.rsplit(",", 1)[0])
    daily = spark.createDataFrame([("a", rows[2][1], 2, 1.0, 1.0, 1)], "grid_id string, date date, fire_detection_count int, maximum_frp double, mean_frp double, fire_today int")
    static = spark.createDataFrame([("a", 1.0, 101, 0)], "grid_id string, vegetation_cover_mean double, fuel_model_dominant int, landfire_missing int")
    history = spark.createDataFrame([("b", 3)], "grid_id string, historical_firms_detection_count_2020_2023 int")
    return weather, daily, static, history


def test_training_table_starts_no_job_and_still_raises(spark):
    weather, daily, static, history = training_inputs(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("contracts", "contracts")
    table = build_training_table(weather, daily, static, history)
    assert list(tracker.getJobIdsForGroup("contracts")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert table.count() == 18
    for broken in (
        (weather, daily, static.unionAll(static), history),
        (weather, daily, static, history.unionAll(history)),
        (weather.unionAll(weather.limit(1)), daily, static, history),
    ):
        with pytest.raises(PySparkException, match="more than one row"):
            build_training_table(*broken).collect()


def test_model_panel_raises_for_missing_values_and_seasons(spark):
    panel = spark.createDataFrame(panel_rows(), PANEL)
    season = spark.createDataFrame([("a", 2024, 4, 1.6, 2), ("b", 2024, 0, 0.0, 0)],
                                   "grid_id string, feature_year int, prior_year_firms_detection_count int, prior_year_firms_detection_count_log double, prior_year_firms_active_days int")
    out = build_model_panel(panel, season, ["temperature_max"], specs=SPECS)
    assert out.count() == 2 * 38  # the first day has nothing before it, the last none after
    assert {r[0] for r in out.where("grid_id = 'a'").select("prior_year_firms_active_days").collect()} == {2}
    with pytest.raises(PySparkException, match="No prior-year season"):
        build_model_panel(panel, season.where("grid_id = 'a'"), [], specs=SPECS).collect()
    lenient = build_model_panel(panel, season.where("grid_id = 'a'"), [], specs=SPECS, strict_history=False)
    assert lenient.where("grid_id = 'b' and prior_year_firms_detection_count = 0").count() == 38
    # A hole on a cell's first day is found, though that day itself is left out.
    hole = panel.withColumn("temperature_max", F.when(F.col("date") > "2024-07-01", F.col("temperature_max")))
    with pytest.raises(PySparkException, match="lacks a current"):
        build_model_panel(hole, season, ["temperature_max"], specs=SPECS).collect()
    assert C.detection_report(spark.createDataFrame([], "latitude double, longitude double, acq_date string, acq_time int, satellite string, instrument string"), "N", 2024).first()["without_satellite"] == 1


def past(df):
    return W.rolling_rows(df, SPECS, False)


def leaky(df):
    return W.rolling_rows(df, [(3, "precipitation_total", "sum", 1, "rain_3d")], True)


def test_audit_of_many_dates_in_one_plan(spark):
    panel = spark.createDataFrame(panel_rows(), PANEL)
    dates = [dt.date(2024, 7, d) for d in range(8, 30)]
    perturb = {"precipitation_total": 999.0}
    families = {"past": (past, ["rain_previous_3d"]), "leaky": (leaky, ["rain_3d"])}
    for lookback in (None, 10):
        found = B.perturbation_audit(panel, families, dates, perturb, lookback=lookback)
        counts = {(r["check"], r["version"]): r["count"] for r in found.groupBy("check", "version").count().collect()}
        assert counts == {("leaky", "as is"): 44, ("leaky", "perturbed"): 44}
    views = B.perturbed_views(panel, dates, perturb, lookback=3)
    assert views.count() <= panel.count() * 8  # itself and at most seven targets near


def test_backtest_refuses_a_leaky_feature(spark, tmp_dir):
    path = os.path.join(tmp_dir, "panel")
    spark.createDataFrame(panel_rows(), PANEL).withColumn("fire_next_day", F.col("fire_today")).write.parquet(path)
    folds = [("f", "2024-07-20", "2024-07-28", "2024-08-05")]
    with pytest.raises(ValueError, match="their own day or later"):
        J.run_backtest(spark, path, ["rain_3d"], [], os.path.join(tmp_dir, "o"), folds=folds, feature_fn=leaky, feature_cols=["rain_3d"])
    assert not os.path.exists(os.path.join(tmp_dir, "o"))
    done = J.run_backtest(spark, path, ["rain_previous_3d"], [], os.path.join(tmp_dir, "p"), folds=folds, feature_fn=past,
                          feature_cols=["rain_previous_3d"], kind="logistic", max_iter=5)
    assert [r["fold"] for r in done.collect()] == ["f"]


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def test_grid_build_job(spark, tmp_dir):
    """Cells are numbered after the clip; the grid file and the centroids read back."""
    from cellcast.sources.readers import read_grid_geojson

    box = [(0, 0), (25_000, 0), (25_000, 20_000), (0, 20_000), (0, 0)]
    hole = [(2_000, 2_000), (6_000, 2_000), (6_000, 6_000), (2_000, 6_000), (2_000, 2_000)]
    schema = "ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>"
    boundary = spark.createDataFrame([(ring(box), [ring(hole)]), (ring([(41_000, 0), (49_000, 0), (41_000, 8_000)]), None)], schema)
    geo, csv = os.path.join(tmp_dir, "grid.geojson"), os.path.join(tmp_dir, "centroids")
    J.run_grid_build(spark, boundary, geo, csv)
    doc = json.load(open(geo))
    ids = [f["properties"]["grid_id"] for f in doc["features"]]
    assert ids == [f"CA-{i:05d}" for i in range(1, 8)]  # 3 x 2 cells and one triangle
    first = doc["features"][0]["geometry"]
    assert first["type"] == "Polygon" and len(first["coordinates"]) == 2  # its hole
    assert all(r[0] == r[-1] for f in doc["features"] for r in f["geometry"]["coordinates"])
    assert all(-121 < x < -119 and 37 < y < 39 for f in doc["features"] for r in f["geometry"]["coordinates"] for x, y in r)
    table = spark.read.option("header", True).option("inferSchema", True).csv(csv).collect()
    assert [r["grid_id"] for r in table] == ids
    back = read_grid_geojson(spark, geo)
    assert back.count() == 7 and back.where("size(holes) = 1").count() == 1
    # The first cell's centroid lies in its hole.
    spots = spark.createDataFrame([("2024-01-01", 100, 1.0, r["centroid_lon"], r["centroid_lat"]) for r in table],
                                  "acq_date string, acq_time int, frp double, longitude double, latitude double")
    assert sorted(r["grid_id"] for r in J.assign_detections_within(spots, back).collect()) == ids[1:]


def test_summary_and_validation_jobs(spark, tmp_dir):
    cells = spark.createDataFrame([("a",), ("b",)], "grid_id string")
    daily = spark.createDataFrame([("a", dt.date(2022, 6, 1), 3), ("a", dt.date(2023, 6, 1), 1)], "grid_id string, date date, fire_count int")
    cells.write.parquet(f"{tmp_dir}/cells")
    daily.write.parquet(f"{tmp_dir}/daily")
    J.run_season_summary(spark, f"{tmp_dir}/daily", f"{tmp_dir}/cells", f"{tmp_dir}/season", [2022, 2023])
    season = spark.read.parquet(f"{tmp_dir}/season")
    assert season.count() == 4 and season.where("grid_id = 'a' and feature_year = 2023").first()["prior_year_firms_detection_count"] == 3
    source = spark.createDataFrame([("a", 1.0, 2.0, 3.0), ("a", 1.0, 2.0, 3.0), ("b", 4.0, 5.0, 6.0)], "grid_id string, elevation double, centroid_lat double, centroid_lon double")
    source.write.parquet(f"{tmp_dir}/source")
    assert spark.read.parquet(J.run_inference_grid(spark, f"{tmp_dir}/source", f"{tmp_dir}/inference")).count() == 2
    panel = spark.createDataFrame(panel_rows(), PANEL).withColumn("fire_next_day", F.col("fire_today"))
    panel.write.parquet(f"{tmp_dir}/table")
    with pytest.raises(ValueError, match="are not there"):
        J.run_validation(spark, f"{tmp_dir}/table", f"{tmp_dir}/report")
    J.run_validation(spark, f"{tmp_dir}/table", f"{tmp_dir}/report", ["grid_id", "date"])
    assert spark.read.parquet(f"{tmp_dir}/report/profile").first()["rows"] == 80
    assert spark.read.parquet(f"{tmp_dir}/report/numbers").count() == 5


def test_static_attributes_job(spark, tmp_dir):
    square = lambda x: {"type": "Polygon", "coordinates": [[[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]]}
    features = [{"type": "Feature", "properties": {"grid_id": f"CA-0000{i}"}, "geometry": square(float(i))} for i in (1, 2)]
    geo = os.path.join(tmp_dir, "grid.geojson")
    json.dump({"type": "FeatureCollection", "features": features}, open(geo, "w"))
    pixels = [(1.2, 0.5, 10.0), (1.4, 0.5, 20.0), (1.6, 0.5, 20.0), (1.7, 0.5, -9999.0)]
    spark.createDataFrame(pixels, "x double, y double, value double").write.parquet(f"{tmp_dir}/px")
    out = J.run_static_attributes(spark, f"{tmp_dir}/px", f"{tmp_dir}/px", geo, f"{tmp_dir}/static", nodata=-9999.0, bucket_degrees=0.5)
    got = [tuple(r) for r in spark.read.parquet(out).orderBy("grid_id").collect()]
    assert got == [("CA-00001", pytest.approx(50 / 3), 20, 0), ("CA-00002", None, None, 1)]
