"""End-to-end jobs: streaming history upsert (T1) and the resumable backtest."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cellcast.streaming.history_upsert import current_version, start_history_stream

SCHEMA = "grid_id string, date date, temperature_max double"


def test_stream_upsert_revises_and_trims(spark, tmp_dir):
    landing, history, ckpt = (os.path.join(tmp_dir, p) for p in ("landing", "history", "ckpt"))
    d = dt.date
    spark.createDataFrame([("CA-00001", d(2024, 1, 1), 10.0), ("CA-00001", d(2024, 1, 31), 20.0)], SCHEMA) \
        .write.parquet(os.path.join(landing, "batch1"))
    q = start_history_stream(spark, os.path.join(landing, "*"), spark.createDataFrame([], SCHEMA).schema,
                             history, ckpt, d(2024, 2, 1))
    q.awaitTermination(120)
    spark.createDataFrame([("CA-00001", d(2024, 1, 31), 21.0), ("CA-00001", d(2024, 2, 1), 22.0)], SCHEMA) \
        .write.parquet(os.path.join(landing, "batch2"))
    q = start_history_stream(spark, os.path.join(landing, "*"), spark.createDataFrame([], SCHEMA).schema,
                             history, ckpt, d(2024, 2, 1))
    q.awaitTermination(120)
    rows = spark.read.parquet(current_version(history)).orderBy("date").collect()
    assert [(str(r["date"]), r["temperature_max"]) for r in rows] == [("2024-01-31", 21.0), ("2024-02-01", 22.0)]


def test_stream_window_moves_with_the_batches(spark, tmp_dir):
    landing, history, ckpt = (os.path.join(tmp_dir, p) for p in ("landing", "history", "ckpt"))
    d = dt.date
    for i, days in enumerate([[d(2024, 1, 1), d(2024, 1, 2)], [d(2024, 1, 20)], [d(2024, 2, 2)]]):
        rows = [("CA-00001", day, float(i)) for day in days]
        spark.createDataFrame(rows, SCHEMA).write.parquet(os.path.join(landing, f"batch{i}"))
        q = start_history_stream(spark, os.path.join(landing, "*"), spark.createDataFrame([], SCHEMA).schema, history, ckpt)
        q.awaitTermination(120)
    kept = spark.read.parquet(current_version(history))
    assert sorted(kept.columns) == ["date", "grid_id", "temperature_max"]
    # [2024-01-03, 2024-02-02]: the first batch has left the window
    assert sorted(r["date"] for r in kept.collect()) == [d(2024, 1, 20), d(2024, 2, 2)]


def test_fold_parts_are_replaced(spark, tmp_dir):
    from cellcast.plans.backtest import _replace_fold

    path = os.path.join(tmp_dir, "parts")
    for fold, n in (("a", 3), ("b", 2), ("a", 1)):
        _replace_fold(spark.range(n).withColumn("fold", F.lit(fold)), path)
    got = {r["fold"]: r["count"] for r in spark.read.parquet(path).groupBy("fold").count().collect()}
    assert got == {"a": 1, "b": 2}


def test_rolling_backtest_resumes(spark, tmp_dir):
    from cellcast.plans.backtest import rolling_backtest
    from cellcast.plans.catalog import full_panel_df
    from cellcast.plans.catalog_metrics import four_rank_panel

    sf = "/root/testdata/sf0.01"
    data = four_rank_panel(spark, sf).withColumnRenamed("user_id", "grid_id")
    cust = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("grid_id"), "c_mktsegment")
    data = data.join(F.broadcast(cust), "grid_id", "left")
    folds = [("fold_a", "2024-01-10", "2024-01-15", "2024-01-20"), ("fold_b", "2024-01-15", "2024-01-20", "2024-01-26")]
    numeric = ["s_rank_total_7d", "s_rank_total_30d", "s_rank_max_3d", "s_rank_min_3d"]
    out = os.path.join(tmp_dir, "bt")
    first = rolling_backtest(data, numeric, ["c_mktsegment"], out, "label", folds=folds[:1], kind="logistic", max_iter=20)
    assert [r["fold"] for r in first.collect()] == ["fold_a"]
    both = rolling_backtest(data, numeric, ["c_mktsegment"], out, "label", folds=folds, kind="logistic", max_iter=20)
    got = sorted(r["fold"] for r in both.collect())
    assert got == ["fold_a", "fold_b"]  # fold_a was not refit or appended twice
    monthly = spark.read.parquet(os.path.join(out, "monthly"))
    assert monthly.select("fold").distinct().count() == 2
    ranking = spark.read.parquet(os.path.join(out, "ranking"))
    assert ranking.count() == 6



def test_training_table_job_end_to_end(spark, tmp_dir):
    """Detections CSV -> projected nearest cell -> daily events -> training table."""
    from cellcast.plans.jobs import run_training_table

    det_csv = os.path.join(tmp_dir, "det.csv")
    with open(det_csv, "w") as fh:
        fh.write("latitude,longitude,acq_date,acq_time,frp,satellite,instrument\n")
        fh.write("36.001,-120.001,2024-07-01,5,2.0,N,VIIRS\n")      # near cell A, 00:05 UTC
        fh.write("36.002,-120.000,2024-07-01,2359,4.0,N,VIIRS\n")   # near cell A
        fh.write("37.000,-121.000,2024-07-02,1200,1.0,N,VIIRS\n")   # near cell B
    cent = spark.createDataFrame([("CA-00001", 36.0, -120.0), ("CA-00002", 37.0, -121.0)], "grid_id string, centroid_lat double, centroid_lon double")
    cent.write.parquet(os.path.join(tmp_dir, "cent.parquet"))
    rows = [(g, d(2024, 7, day), 1.0 * day, 20.0 + day, 30.0) for g in ("CA-00001", "CA-00002") for day in range(1, 5)]
    spark.createDataFrame(rows, "grid_id string, date date, precipitation_total double, temperature_max double, humidity_min double") \
        .write.parquet(os.path.join(tmp_dir, "weather.parquet"))
    spark.createDataFrame([("CA-00001", 50.0, 101, 0)], "grid_id string, vegetation_cover_mean double, fuel_model_dominant int, landfire_missing int") \
        .write.parquet(os.path.join(tmp_dir, "static.parquet"))
    spark.createDataFrame([("CA-00002", 3)], "grid_id string, historical_firms_detection_count_2020_2023 int") \
        .write.parquet(os.path.join(tmp_dir, "hist.parquet"))
    out = run_training_table(spark, os.path.join(tmp_dir, "weather.parquet"), det_csv, os.path.join(tmp_dir, "cent.parquet"),
                             os.path.join(tmp_dir, "static.parquet"), os.path.join(tmp_dir, "hist.parquet"), tmp_dir)
    t = {(r["grid_id"], r["date"].day): r for r in spark.read.parquet(out).collect()}
    assert len(t) == 6  # 2 cells x 4 days, last day per cell has no next-row label
    assert t[("CA-00001", 1)]["fire_detection_count"] == 2 and t[("CA-00001", 1)]["maximum_frp"] == 4.0
    assert t[("CA-00002", 2)]["fire_today"] == 1 and t[("CA-00002", 1)]["fire_next_day"] == 1
    assert t[("CA-00002", 1)]["landfire_missing"] == 1 and t[("CA-00002", 1)]["historical_firms_detection_count_2020_2023"] == 3
    assert t[("CA-00001", 3)]["rain_7d"] == 6.0


def d(y, m, day):
    return dt.date(y, m, day)


def test_daily_scoring_job_newest_file_wins(spark, tmp_dir):
    from test_next_day import META, WEATHER_SCHEMA, fake_scorer, weather_rows

    from cellcast.plans.daily_scoring import read_current_document
    from cellcast.plans.jobs import run_daily_scoring

    rows = weather_rows()
    old = [r for r in rows if r[1] <= dt.date(2024, 1, 30)]
    # the newer file revises Jan 30-31 and makes CA-00001 the hotter cell
    new = [tuple(list(r[:2]) + [30.0 if r[0] == "CA-00001" else r[2]] + list(r[3:])) for r in rows if r[1] >= dt.date(2024, 1, 30)]
    spark.createDataFrame(old, WEATHER_SCHEMA).write.parquet(os.path.join(tmp_dir, "w1.parquet"))
    spark.createDataFrame(new, WEATHER_SCHEMA).write.parquet(os.path.join(tmp_dir, "w2.parquet"))
    spark.createDataFrame([("CA-00001", 50.0, 101, 0), ("CA-00002", 60.0, 102, 0)],
                          "grid_id string, vegetation_cover_mean double, fuel_model_dominant int, landfire_missing int") \
        .write.parquet(os.path.join(tmp_dir, "static.parquet"))
    spark.createDataFrame([("CA-00001", 0), ("CA-00002", 9)], "grid_id string, historical_firms_detection_count_2020_2023 long") \
        .write.parquet(os.path.join(tmp_dir, "hist.parquet"))
    out_dir = os.path.join(tmp_dir, "pub")
    run_daily_scoring(spark, [os.path.join(tmp_dir, "w1.parquet"), os.path.join(tmp_dir, "w2.parquet")],
                      os.path.join(tmp_dir, "static.parquet"), os.path.join(tmp_dir, "hist.parquet"), None,
                      fake_scorer, META, "stub", out_dir, feature_date="2024-01-31", expected_grid_count=2)
    doc = read_current_document(spark, out_dir)
    scores = {loc["id"]: loc["risk_score"] for loc in doc["locations"]}
    assert scores == {"CA-00001": 100.0, "CA-00002": 50.0}
    assert doc["prediction_date"] == "2024-02-01"


def test_within_assignment_drops_outside_points(spark, tmp_dir):
    import json as _json

    from cellcast.plans.jobs import assign_detections_within
    from cellcast.sources.readers import read_grid_geojson

    path = os.path.join(tmp_dir, "grid.geojson")
    ring = lambda x0, y0: [[x0, y0], [x0 + 0.1, y0], [x0 + 0.1, y0 + 0.1], [x0, y0 + 0.1], [x0, y0]]
    with open(path, "w") as fh:
        _json.dump({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"grid_id": "CA-00001"}, "geometry": {"type": "Polygon", "coordinates": [ring(-120.0, 36.0)]}},
            {"type": "Feature", "properties": {"grid_id": "CA-00002"}, "geometry": {"type": "Polygon", "coordinates": [ring(-119.9, 36.0)]}},
        ]}, fh)
    det = spark.createDataFrame(
        [(36.05, -119.95, "2024-07-01", "0105", 1.0), (36.05, -119.85, "2024-07-01", "5", 2.0), (37.0, -121.0, "2024-07-01", "1200", 3.0)],
        "latitude double, longitude double, acq_date string, acq_time string, frp double")
    out = {r["frp"]: r["grid_id"] for r in assign_detections_within(det, read_grid_geojson(spark, path)).collect()}
    assert out == {1.0: "CA-00001", 2.0: "CA-00002"}


def test_replayed_batch_writes_nothing_and_untouched_dates_stay(spark, tmp_dir):
    """Three batches that move on, one replay: only touched dates get new folders."""
    from cellcast.streaming.history_upsert import merge_batch, read_history

    def batch(rows):
        return spark.createDataFrame([(g, d(*day), v) for g, day, v in rows], SCHEMA)

    def folders():
        return {k: v for k, v in __import__("json").loads(open(os.path.join(tmp_dir, "CURRENT")).read())["dates"].items()}

    merge_batch(spark, batch([("a", (2024, 1, 1), 1.0), ("b", (2024, 1, 1), 2.0), ("a", (2024, 1, 2), 3.0)]), tmp_dir, source="s", epoch=0)
    one = folders()
    merge_batch(spark, batch([("a", (2024, 1, 2), 4.0), ("a", (2024, 1, 3), 5.0)]), tmp_dir, source="s", epoch=1)
    two = folders()
    assert two["2024-01-01"] == one["2024-01-01"] and two["2024-01-02"] != one["2024-01-02"] and set(two) == set(one) | {"2024-01-03"}
    before = sorted(os.listdir(os.path.join(tmp_dir, "parts")))
    merge_batch(spark, batch([("a", (2024, 1, 2), 99.0)]), tmp_dir, source="s", epoch=1)  # the replay
    assert folders() == two and sorted(os.listdir(os.path.join(tmp_dir, "parts"))) == before
    merge_batch(spark, batch([("b", (2024, 2, 1), 6.0)]), tmp_dir, source="s", epoch=2)
    assert set(folders()) == {"2024-01-02", "2024-01-03", "2024-02-01"}  # 31 dates back from the newest
    got = sorted(tuple(r) for r in read_history(spark, tmp_dir).select("grid_id", "date", "temperature_max").collect())
    assert got == [("a", d(2024, 1, 2), 4.0), ("a", d(2024, 1, 3), 5.0), ("b", d(2024, 2, 1), 6.0)]
    merge_batch(spark, batch([("b", (2024, 2, 1), 7.0)]), tmp_dir, source="other", epoch=0)  # another stream's epochs
    assert read_history(spark, tmp_dir).where("date = '2024-02-01'").first()["temperature_max"] == 7.0
