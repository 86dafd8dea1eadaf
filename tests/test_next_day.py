"""Behaviour of the reference's next-day prediction tests on the same tiny panel."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from cellcast.fixed_values import CATEGORICAL_MISSING_TOKEN
from cellcast.operators.ranking import average_percentile
from cellcast.plans.daily_scoring import build_next_day_features, build_prediction_payload
from cellcast.streaming.history_upsert import upsert_history

CELLS = ["CA-00001", "CA-00002"]
FEATURES = [
    "temperature_max", "temperature_min", "humidity_mean", "humidity_min", "precipitation_total",
    "wind_speed_max", "elevation", "vegetation_cover_mean", "rain_previous_7d", "rain_previous_30d",
    "temperature_max_previous_3d", "humidity_min_previous_3d", "historical_firms_detection_count_log",
    "wind_direction_dominant", "fuel_model_dominant", "landfire_missing",
]
CATEGORICAL = ["wind_direction_dominant", "fuel_model_dominant", "landfire_missing"]


def weather_rows():
    rows = []
    for n, cell in enumerate(CELLS, start=1):
        for day in range(31):
            rows.append((
                cell, dt.date(2024, 1, 1) + dt.timedelta(days=day), 20.0 + n, 10.0, 50.0, 30.0 + n,
                1000.0 if day == 30 else 1.0, 15.0, 270, 100.0 * n, 35.0 + n, -120.0 - n,
            ))
    return rows


WEATHER_SCHEMA = (
    "grid_id string, date date, temperature_max double, temperature_min double, humidity_mean double, "
    "humidity_min double, precipitation_total double, wind_speed_max double, wind_direction_dominant int, "
    "elevation double, centroid_lat double, centroid_lon double"
)


@pytest.fixture()
def inputs(spark):
    weather = spark.createDataFrame(weather_rows(), WEATHER_SCHEMA)
    static = spark.createDataFrame(
        [("CA-00001", 50.0, 101, 0), ("CA-00002", 60.0, 102, 0)],
        "grid_id string, vegetation_cover_mean double, fuel_model_dominant int, landfire_missing int",
    )
    history = spark.createDataFrame(
        [("CA-00001", 0), ("CA-00002", 9)], "grid_id string, historical_firms_detection_count_2020_2023 long"
    )
    reference = weather.select("grid_id", "elevation", "centroid_lat", "centroid_lon").dropDuplicates(["grid_id"])
    return weather, static, history, reference


def fake_scorer(df):
    """0.1 x average-rank percentile of temperature_max."""
    ranked = average_percentile(df.withColumn("_all", F.lit(1)), ["_all"], "temperature_max", "_p")
    return ranked.withColumn("model_score", F.col("_p") * 0.1).drop("_all", "_p")


def nan_scorer(df):
    return df.withColumn("model_score", F.lit(float("nan")))


META = {
    "threshold": 0.05,
    "feature_columns": FEATURES,
    "categorical_features": CATEGORICAL,
    "categorical_missing_value": CATEGORICAL_MISSING_TOKEN,
}


def test_feature_date_predicts_exactly_next_day(inputs):
    weather, static, history, _ = inputs
    f = build_next_day_features(weather, static, history, feature_date="2024-01-31")
    rows = {r["grid_id"]: r for r in f.collect()}
    assert len(rows) == 2
    for r in rows.values():
        assert r["feature_date"] == dt.date(2024, 1, 31)
        assert r["prediction_date"] == dt.date(2024, 2, 1)
        assert r["rain_previous_7d"] == 7
        assert r["rain_previous_30d"] == 30
    assert rows["CA-00002"]["historical_firms_detection_count_log"] == pytest.approx(math.log1p(9))


def test_payload_uses_percentiles_and_expected_units(inputs):
    weather, static, history, _ = inputs
    f = build_next_day_features(weather, static, history, feature_date="2024-01-31")
    doc = build_prediction_payload(f, fake_scorer, META, "test_model").first()
    assert doc["prediction_date"] == "2024-02-01"
    assert doc["grid_count"] == 2
    assert [loc["risk_score"] for loc in doc["locations"]] == [50.0, 100.0]
    assert "temperature_max_c" in doc["locations"][0]["conditions"].asDict()
    assert "not calibrated" in doc["score_semantics"]


def test_rolling_features_ignore_current_and_future_weather(inputs):
    weather, static, history, reference = inputs
    day = dt.date(2024, 1, 20)
    base = build_next_day_features(weather, static, history, reference, feature_date=day)
    changed = weather
    for c, v in (("precipitation_total", 9999.0), ("temperature_max", 9999.0), ("humidity_min", -9999.0)):
        changed = changed.withColumn(c, F.when(F.col("date") >= F.lit(day), F.lit(v)).otherwise(F.col(c)))
    pert = build_next_day_features(changed, static, history, reference, feature_date=day)
    cols = ["grid_id", "rain_previous_7d", "rain_previous_30d", "temperature_max_previous_3d", "humidity_min_previous_3d"]
    assert sorted(base.select(cols).collect()) == sorted(pert.select(cols).collect())


def test_duplicate_feature_date_weather_is_rejected(inputs):
    weather, static, history, reference = inputs
    dup = weather.filter((F.col("grid_id") == "CA-00001") & (F.col("date") == dt.date(2024, 1, 31)))
    with pytest.raises(ValueError, match="duplicate grid IDs"):
        build_next_day_features(weather.unionByName(dup), static, history, reference, feature_date="2024-01-31")


def test_missing_feature_date_grid_is_rejected(inputs):
    weather, static, history, reference = inputs
    gone = weather.filter(~((F.col("grid_id") == "CA-00002") & (F.col("date") == dt.date(2024, 1, 31))))
    with pytest.raises(ValueError, match="Missing grids: 1"):
        build_next_day_features(gone, static, history, reference, feature_date="2024-01-31")


def test_incomplete_feature_date_weather_is_rejected(inputs):
    weather, static, history, reference = inputs
    hole = weather.withColumn(
        "humidity_min",
        F.when((F.col("grid_id") == "CA-00001") & (F.col("date") == dt.date(2024, 1, 31)), F.lit(float("nan")))
        .otherwise(F.col("humidity_min")),
    )
    with pytest.raises(ValueError, match="missing static, current, or rolling inputs"):
        build_next_day_features(hole, static, history, reference, feature_date="2024-01-31")


def test_duplicate_inference_grid_is_rejected(inputs):
    weather, static, history, reference = inputs
    f = build_next_day_features(weather, static, history, reference, feature_date="2024-01-31")
    with pytest.raises(ValueError, match="duplicate grid IDs"):
        build_prediction_payload(f.unionByName(f.limit(1)), fake_scorer, META, "test_model")


def test_incorrect_inference_grid_count_is_rejected(inputs):
    weather, static, history, reference = inputs
    f = build_next_day_features(weather, static, history, reference, feature_date="2024-01-31")
    with pytest.raises(ValueError, match="expected 4,355, received 2"):
        build_prediction_payload(f, fake_scorer, META, "test_model", expected_grid_count=4355)


def test_invalid_model_scores_are_rejected(inputs):
    weather, static, history, reference = inputs
    f = build_next_day_features(weather, static, history, reference, feature_date="2024-01-31")
    with pytest.raises(ValueError, match="missing, infinite"):
        build_prediction_payload(f, nan_scorer, META, "invalid_model")


def test_published_set_has_all_grids_and_finite_scores(spark, tmp_dir):
    """A synthetic 4,355-cell published set, written and read back."""
    from cellcast.plans.daily_scoring import publish_document, publish_locations, read_current_document, write_document

    cells = spark.range(1, 4356).select(
        F.format_string("CA-%05d", "id").alias("grid_id"),
        (F.lit(32.5) + F.col("id") / 1000.0).alias("centroid_lat"),
        (F.lit(-124.0) + F.col("id") / 900.0).alias("centroid_lon"),
        (F.col("id") % 13 + 100).alias("fuel_model_dominant"),
        F.lit(25.0).alias("temperature_max"),
        F.lit(20.0).alias("humidity_min"),
        F.lit(10.0).alias("wind_speed_max"),
        F.lit(0.0).alias("precipitation_total"),
        (F.col("id") % 97 / 97.0).alias("model_score"),
    )
    doc = publish_document(publish_locations(cells, 0.5), dt.date(2024, 1, 31), dt.date(2024, 2, 1), "m", "now")
    write_document(doc, tmp_dir)
    payload = read_current_document(spark, tmp_dir)
    ids = [loc["id"] for loc in payload["locations"]]
    assert payload["grid_count"] == 4355 and len(ids) == 4355 and len(set(ids)) == 4355
    assert all(math.isfinite(loc["model_score"]) and math.isfinite(loc["risk_score"]) for loc in payload["locations"])


def test_weather_history_is_merged_revised_and_trimmed(spark):
    existing = spark.createDataFrame(
        [("CA-00001", "2024-01-01", 10.0), ("CA-00001", "2024-01-31", 20.0)], "grid_id string, date string, temperature_max double"
    )
    downloaded = spark.createDataFrame(
        [("CA-00001", "2024-01-31", 21.0), ("CA-00001", "2024-02-01", 22.0)], "grid_id string, date string, temperature_max double"
    )
    out = upsert_history(existing, downloaded, dt.date(2024, 2, 1)).orderBy("grid_id", "date").collect()
    assert [str(r["date"]) for r in out] == ["2024-01-31", "2024-02-01"]
    assert [r["temperature_max"] for r in out] == [21.0, 22.0]


def test_publishes_one_form_at_every_size(spark, tmp_dir):
    from cellcast.plans import daily_scoring as D

    cells = spark.range(1, 51).select(
        F.format_string("CA-%05d", "id").alias("grid_id"),
        (F.lit(32.5) + F.col("id") / 1000.0).alias("centroid_lat"),
        (F.lit(-124.0) + F.col("id") / 900.0).alias("centroid_lon"),
        F.lit(101).alias("fuel_model_dominant"),
        F.lit(25.0).alias("temperature_max"),
        F.lit(20.0).alias("humidity_min"),
        F.lit(10.0).alias("wind_speed_max"),
        F.lit(0.0).alias("precipitation_total"),
        (F.col("id") / 50.0).alias("model_score"),
    )
    target = D.publish(D.publish_locations(cells, 0.5), dt.date(2024, 1, 31), dt.date(2024, 2, 1), "m", tmp_dir, "now")
    header = spark.read.json(os.path.join(target, "header")).first()
    head, locs = D.read_published(spark, tmp_dir)
    assert head.first() == header
    assert header["grid_count"] == 50 and locs.count() == 50
    assert locs.agg(F.max("risk_score")).first()[0] == 100.0
