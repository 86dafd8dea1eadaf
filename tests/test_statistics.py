"""Quartiles, level numbers, blend search and category stages against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from cellcast.operators import encoders as E
from cellcast.operators import learn as L
from cellcast.operators import numbering as N
from cellcast.operators import ranking as R
from cellcast.operators.profile import describe_numeric


def test_quartiles_of_all_columns(spark):
    rng = random.Random(1)
    rows = [(rng.gauss(0, 5), float(rng.randint(0, 3)), rng.uniform(100, 100.001), None if i % 3 else -1e300 * rng.random(), 7.0) for i in range(1001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").withColumn("none", F.lit(None).cast("double"))
    got = {r["column_name"]: r for r in describe_numeric(df, ["a", "b", "c", "d", "e", "none"]).collect()}
    for i, name in enumerate("abcde"):
        x = np.array([r[i] for r in rows if r[i] is not None])
        assert got[name]["count"] == len(x)
        assert got[name]["min"] == x.min() and got[name]["max"] == x.max()
        for q, p in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            assert got[name][p] == pytest.approx(np.quantile(x, q), rel=1e-12), (name, p)
        if name != "d":
            assert got[name]["mean"] == pytest.approx(x.mean()) and got[name]["std"] == pytest.approx(x.std(ddof=1), abs=1e-9)
    assert got["none"]["count"] == 0 and got["none"]["p50"] is None


def test_rows_are_numbered_across_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 3 * F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"), "id").repartition(7)
    got = N.number_rows(df, ["g"], ["v"]).collect()
    for g in {r["g"] for r in got}:
        mine = sorted((r["v"], r["row_number"]) for r in got if r["g"] == g)
        assert [n for _, n in mine] == list(range(len(mine)))


def test_large_vocabulary_of_levels(spark):
    train = spark.range(20_000).selectExpr("concat('w', id % 7000) as word", "cast(id % 2 as string) as flag")
    levels = L.category_levels(train, ["word", "flag"])
    got = {(r["feature"], r["level"]): r["level_index"] for r in levels.collect()}
    words = sorted(f"w{i}" for i in range(7000))
    assert all(got["word", w] == i for i, w in enumerate(words)) and got["flag", "1"] == 1 and len(got) == 7002
    later = spark.createDataFrame([("w5", "0"), ("new", None)], "word string, flag string")
    coded = L.ordinal_codes(later, levels, ["word", "flag"]).orderBy("word").collect()
    assert [(r["word"], r["word_code"], r["flag_code"]) for r in coded] == [("new", -1, -1), ("w5", words.index("w5"), 0)]
    with pytest.raises(ValueError, match="no training levels"):
        L.require_levels(levels, ["word", "other"])


def brute_average_precision(y, s):
    total, out = sum(y), 0.0
    for level in sorted(set(s), reverse=True):
        at = [i for i in range(len(s)) if s[i] >= level]
        out += sum(y[i] for i in at if s[i] == level) * sum(y[i] for i in at) / len(at)
    return out / total


def test_blend_search_is_exact_and_reads_few_rows_again(spark):
    rng = random.Random(3)
    n = 700
    rows = [(int(rng.random() < 0.08), *[math.ceil(rng.random() * n) / n for _ in range(3)]) for _ in range(n)]
    rows = [(y, min(1.0, a + 0.3 * y), b, 1.0 if i % 5 == 0 else c) for i, (y, a, b, c) in enumerate(rows)]
    names = ["r1", "r2", "r3"]
    df = spark.createDataFrame(rows, "y int, r1 double, r2 double, r3 double").repartition(3)
    grid = R.weight_grid(3, 4)
    want = []
    for w in grid:
        score = [0.0 + w[0] * r[1] + w[1] * r[2] + w[2] * r[3] for r in rows]
        want.append(brute_average_precision([r[0] for r in rows], score))
    for buckets in (8, 1 << 14):
        got = {r["candidate"]: r["validation_pr_auc"] for r in R.blend_weight_search(df, "y", names, 4, buckets=buckets).collect()}
        assert [got[i] for i in range(len(grid))] == pytest.approx(want)
    best = R.blend_weight_search(df, "y", names, 4, only_best=True)
    assert best.count() < len(grid)  # some candidates are out by their bounds
    assert R.best_candidate(best).first()["candidate"] == want.index(max(want))
    # Rows that are looked at again: those in buckets with a positive and something else.
    vectors = np.array(grid)
    scores = np.zeros((n, len(grid)))
    for i in range(3):
        scores = scores + vectors[:, i] * np.array([r[i + 1] for r in rows])[:, None]
    cell = R._blend_bucket(scores, 1 << 14)
    again = sum(
        sum((cell[:, c] == b).sum() for b in set(cell[[i for i in range(n) if rows[i][0]], c]) if (cell[:, c] == b).sum() > 1)
        for c in range(len(grid))
    )
    assert again < 0.5 * n * len(grid)


def test_category_stages_impute_encode_and_reload(spark, tmp_dir):
    train = spark.createDataFrame(
        [("b", 2), ("a", 2), ("b", None), (None, 10), ("a", 10), ("c", 1)], "kind string, size int"
    )
    stages = [
        E.CategoryText(inputCols=["kind", "size"], outputCols=["k", "s"]),
        E.ModeImputer(inputCols=["k", "s"], outputCols=["kf", "sf"]),
        E.OrdinalEncoder(inputCols=["kf", "sf"], outputCols=["kc", "sc"]),
    ]
    model = Pipeline(stages=stages).fit(train)
    model.write().overwrite().save(f"{tmp_dir}/model")
    later = spark.createDataFrame([("z", 1), (None, None), ("c", 2)], "kind string, size int")
    for m in (model, PipelineModel.load(f"{tmp_dir}/model")):
        got = [(r["kf"], r["sf"], r["kc"], r["sc"]) for r in m.transform(later).collect()]
        # a and b are equally frequent: the smaller; 10 and 2 too, as text
        assert got == [("z", "1", -1.0, 0.0), ("a", "10", 0.0, 1.0), ("c", "2", 2.0, 2.0)]
    with pytest.raises(ValueError, match="more than 2 levels"):
        E.OrdinalEncoder(inputCols=["kind"], outputCols=["x"], maxLevels=2).fit(train)
    with pytest.raises(ValueError, match="No value"):
        E.ModeImputer(inputCols=["kind"], outputCols=["x"]).fit(train.limit(0))


def test_positive_weight_search(spark):
    rng = random.Random(5)
    rows = [(float(x := rng.random()), "a" if rng.random() < 0.5 else "b", int(x + rng.gauss(0, 0.2) > 0.8)) for _ in range(300)]
    df = spark.createDataFrame(rows, "x double, c string, y int")
    model, best, results = L.search_positive_weight(df, df, ["x"], ["c"], "y", kind="logistic", max_iter=10)
    table = sorted(results.collect(), key=lambda r: r["candidate"])
    assert [r["weight_name"] for r in table] == ["unweighted", "sqrt_imbalance", "moderate_weight"]
    pos = sum(r[2] for r in rows)
    assert table[1]["positive_weight"] == pytest.approx(math.sqrt((300 - pos) / pos))
    key = [(r["precision"], r["pr_auc"], -r["candidate"]) for r in table]
    assert best.first()["candidate"] == key.index(max(key))
    assert L.score(model, df, ["c"]).count() == 300
