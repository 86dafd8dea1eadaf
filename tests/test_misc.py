"""Sinks, small contracts and helpers that have no query of their own."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cellcast.operators import learn as L
from cellcast.operators import spatial as S
from cellcast.sinks import writers as K
from cellcast.sources import payload as PL
from cellcast.sources import readers as RD


def test_sinks_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(f"CA-{i:05d}", dt.date(2024, 1, 1 + i % 3), i % 2, i / 10) for i in range(20)],
                               "grid_id string, date date, fire_next_day int, score double")
    K.write_parquet_and_csv(df, os.path.join(tmp_dir, "t.parquet"), os.path.join(tmp_dir, "t_csv"))
    assert spark.read.parquet(os.path.join(tmp_dir, "t.parquet")).count() == 20
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "t_csv")).count() == 20
    K.write_sample(df, os.path.join(tmp_dir, "sample"), rows=5)
    sample = spark.read.option("header", True).csv(os.path.join(tmp_dir, "sample")).collect()
    assert [r["grid_id"] for r in sample] == [f"CA-{i:05d}" for i in range(5)]
    scored = K.scored_rows(df.withColumn("extra", F.lit(1)), "score", 1.0)
    assert scored.columns == ["date", "grid_id", "fire_next_day", "predicted_score", "predicted_class"]
    assert scored.agg(F.sum("predicted_class")).first()[0] == 10
    target = K.write_versioned(df, os.path.join(tmp_dir, "versions"))
    with open(os.path.join(tmp_dir, "versions", "CURRENT")) as fh:
        assert target.endswith(fh.read().strip())


def test_quarantine_and_by_year(spark, tmp_dir):
    requests = spark.createDataFrame([(1, 0, "A"), (1, 1, "B"), (2, 0, "C")], "batch_number long, position int, grid_id string")
    rejected = spark.createDataFrame([(1, "returned 1 locations for a 2-location batch")], "batch_number long, error string")
    K.quarantine(rejected, requests, os.path.join(tmp_dir, "q"))
    row = spark.read.parquet(os.path.join(tmp_dir, "q")).first()
    assert (row["first_grid_id"], row["last_grid_id"], row["cells"]) == ("A", "B", 2)
    summary = spark.createDataFrame([("A", 2022), ("B", 2022), ("A", 2023), ("B", 2023)], "grid_id string, history_year int")
    K.write_by_year(summary, os.path.join(tmp_dir, "years"), expected_per_year=2)
    assert {"history_year=2022", "history_year=2023"} <= set(os.listdir(os.path.join(tmp_dir, "years")))
    with pytest.raises(ValueError, match="duplicate"):
        K.write_by_year(summary.unionByName(summary), os.path.join(tmp_dir, "years2"))


def test_experiment_row_joins_features(spark):
    metrics = spark.createDataFrame([(0.3, 0.8)], "test_pr_auc double, test_roc_auc double")
    row = K.experiment_row(spark, {"experiment_name": "e", "model": "m"}, ["a", "b", "c"], metrics).first()
    assert row["features"] == "a|b|c" and row["feature_count"] == 3 and row["test_pr_auc"] == 0.3


def test_feed_renames_region_and_fallback(spark, tmp_dir):
    df = spark.createDataFrame([("2024-01-01", 1.0, 2.0)], "time string, temperature_2m_max double, precipitation_sum double")
    assert PL.rename_feed_columns(df).columns == ["date", "temperature_max", "precipitation_total"]
    b = spark.createDataFrame([("06", "CA"), ("41", "OR")], "STATEFP string, name string")
    assert S.select_region(b, "STATEFP", "06").first()["name"] == "CA"
    with pytest.raises(ValueError):
        S.select_region(b, "STATEFP", "99")
    legacy = os.path.join(tmp_dir, "weather_through_2024-01-02.parquet")
    spark.range(1).write.parquet(legacy)
    spark.range(1).write.parquet(os.path.join(tmp_dir, "weather_through_2024-01-05.parquet"))
    chosen = RD.first_available(spark, [os.path.join(tmp_dir, "missing.parquet")], os.path.join(tmp_dir, "weather_through_*.parquet"))
    assert chosen.endswith("weather_through_2024-01-05.parquet")
    with pytest.raises(FileNotFoundError):
        RD.first_available(spark, [os.path.join(tmp_dir, "missing.parquet")])


def test_skip_finished_and_complete(spark):
    plan = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 6),)], "block_start date")
    landed = spark.createDataFrame([(dt.date(2024, 1, 1),)], "block_start date")
    assert [r[0] for r in PL.skip_finished(plan, landed, ["block_start"]).collect()] == [dt.date(2024, 1, 6)]
    grid = spark.createDataFrame([("A",), ("B",)], "grid_id string")
    assert PL.already_complete(spark.createDataFrame([("A",), ("B",), ("B",)], "grid_id string"), grid)
    assert not PL.already_complete(spark.createDataFrame([("A",)], "grid_id string"), grid)


def test_available_features_drops_optional(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert L.available_features(df, ["a", "b", "hist"], optional=["hist"]) == ["a", "b"]
    with pytest.raises(ValueError):
        L.available_features(df, ["a", "zzz"])


@pytest.fixture(scope="module")
def model_data(spark):
    from cellcast.plans.catalog_metrics import four_score_base

    base = four_score_base(spark, "/root/testdata/sf0.01")
    cust = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return base.join(F.broadcast(cust), "user_id", "left")


NUM = ["s_rank_total_7d", "s_rank_total_30d", "s_rank_max_3d", "s_rank_min_3d"]


@pytest.mark.parametrize("kind,params", [("random_forest", {"trees": 5, "depth": 4}), ("gbt", {"iterations": 5, "depth": 3})])
def test_tree_models_fit_and_score(spark, model_data, kind, params):
    train = model_data.filter(F.col("date") < "2024-01-20")
    valid = model_data.filter(F.col("date") >= "2024-01-20")
    model = L.fit_model(train, NUM, ["c_mktsegment"], "label", kind=kind,
                        validation=valid if kind == "gbt" else None, **params)
    scored = L.score(model, valid, ["c_mktsegment"])
    r = scored.agg(F.min("score"), F.max("score"), F.count("score")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] == valid.count()


def test_blended_daily_ranks(spark, model_data, tmp_dir):
    m1 = L.fit_model(model_data, NUM[:2], [], "label", kind="logistic", max_iter=10)
    m2 = L.fit_model(model_data, NUM[2:], ["c_mktsegment"], "label", kind="logistic", max_iter=10)
    out = L.blended_daily_ranks(model_data, {"a": (m1, []), "b": (m2, ["c_mktsegment"])}, {"a": 0.75, "b": 0.25})
    r = out.agg(F.min("blended_score"), F.max("blended_score"), F.count("blended_score")).first()
    assert 0.0 < r[0] <= r[1] <= 1.0 and r[2] == model_data.count()
    L.save_artifact(m1, os.path.join(tmp_dir, "art"), {"threshold": 0.1, "feature_columns": NUM[:2], "categorical_features": []})
    loaded, meta = L.load_artifact(os.path.join(tmp_dir, "art"))
    assert meta["threshold"] == 0.1 and meta["categorical_missing_value"] == "__MISSING__"
    assert L.score(loaded, model_data, []).count() == model_data.count()


def test_scale_conf_sizes_partitions():
    from cellcast.session import scale_conf

    big = scale_conf(100 * 2**40, 1000, 8)
    small = scale_conf(10 * 2**30, 10, 4)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    assert int(small["spark.sql.shuffle.partitions"]) >= 80
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_cut_lineage_writes_under_checkpoint_dir(spark):
    from cellcast.session import cut_lineage, ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark)
    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2), "probe")
    assert df.count() == 10
    files = df.inputFiles()
    assert files and all(root.replace("file:", "") in f.replace("file:", "") for f in files)
