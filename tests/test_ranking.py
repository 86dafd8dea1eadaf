"""Ranking metrics against direct brute-force definitions on small cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cellcast.operators import ranking as R


def brute_ap(y, s):
    """Step-wise AP over distinct thresholds (score >= t), descending."""
    P = sum(y)
    if P == 0:
        return None
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp = sum(1 for yi, si in zip(y, s) if si >= t and yi == 1)
        fp = sum(1 for yi, si in zip(y, s) if si >= t and yi == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def brute_auc(y, s):
    pos = [si for yi, si in zip(y, s) if yi == 1]
    neg = [si for yi, si in zip(y, s) if yi == 0]
    if not pos or not neg:
        return None
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


CASES = [
    ([1, 0, 1, 0, 1, 1, 0, 0], [0.9, 0.8, 0.8, 0.3, 0.3, 0.2, 0.1, 0.1]),
    ([0, 0, 1, 1], [0.5, 0.5, 0.5, 0.5]),  # all equal
    ([1, 0, 0, 0, 0], [0.1, 0.2, 0.3, 0.4, 0.5]),
    ([0, 0, 0], [0.1, 0.2, 0.3]),  # no positives
]


@pytest.mark.parametrize("y,s", CASES)
@pytest.mark.parametrize("buckets", [1, 3, 13])
def test_ap_auc_match_brute_force(spark, y, s, buckets):
    df = spark.createDataFrame(list(zip(y, s)), "label int, score double")
    bounds = R.score_bounds(df, "score", n_buckets=buckets)
    m = R.curve_metrics(R.score_levels(df, "label", "score", bounds=bounds)).first()
    ap, auc = brute_ap(y, s), brute_auc(y, s)
    assert (m["pr_auc"] is None) == (ap is None)
    if ap is not None:
        assert m["pr_auc"] == pytest.approx(ap, abs=1e-12)
    assert (m["roc_auc"] is None) == (auc is None)
    if auc is not None:
        assert m["roc_auc"] == pytest.approx(auc, abs=1e-12)


def test_grouped_curves_and_partition_invariance(spark):
    rng = random.Random(7)
    rows = [(g, rng.randint(0, 1), round(rng.random(), 2)) for g in range(4) for _ in range(200)]
    df = spark.createDataFrame(rows, "g int, label int, score double")
    a = {r["g"]: r for r in R.curve_metrics(R.score_levels(df, "label", "score", ["g"]), ["g"]).collect()}
    b = {r["g"]: r for r in R.curve_metrics(R.score_levels(df.repartition(7), "label", "score", ["g"], bounds=[0.3]), ["g"]).collect()}
    for g in range(4):
        y = [r[1] for r in rows if r[0] == g]
        s = [r[2] for r in rows if r[0] == g]
        assert a[g]["pr_auc"] == pytest.approx(brute_ap(y, s), abs=1e-12)
        assert a[g]["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
        assert b[g]["pr_auc"] == pytest.approx(a[g]["pr_auc"], abs=1e-12)


def test_percentile_average_ties(spark):
    df = spark.createDataFrame([("d", 1.0), ("d", 5.0), ("d", 5.0), ("d", 7.0), ("e", 3.0)], "date string, score double")
    out = sorted((r["date"], r["score"], r["p"]) for r in R.average_percentile(df, ["date"], "score", "p", bounds=[4.0, 6.0]).collect())
    assert [o[2] for o in out] == [0.25, 0.625, 0.625, 1.0, 1.0]


def test_ordinal_rank_ties_by_key(spark):
    df = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.5), (1, "c", 0.9), (2, "z", 0.1)], "date int, grid_id string, score double")
    out = {(r["date"], r["grid_id"]): r["daily_rank"] for r in R.ordinal_rank(df, ["date"], "score", ["grid_id"], bounds=[0.2, 0.6]).collect()}
    assert out == {(1, "c"): 1, (1, "a"): 2, (1, "b"): 3, (2, "z"): 1}


def test_threshold_choice_rule(spark):
    # thresholds: 0.9 (p=1, r=.25), 0.8 (p=2/3, r=.5), 0.7 (p=3/4, r=.75), 0.1 (p=4/6, r=1)
    y = [1, 0, 1, 1, 0, 1]
    s = [0.9, 0.8, 0.8, 0.7, 0.1, 0.1]
    df = spark.createDataFrame(list(zip(y, s)), "label int, score double")
    t = R.choose_threshold(R.score_levels(df, "label", "score"), "score").first()
    assert t["threshold"] == 0.7
    assert t["precision"] == pytest.approx(0.75)


def test_capture_counts_and_ceil(spark):
    rows = [(d, f"g{i:03d}", float(i % 17), int(i % 5 == 0)) for d in range(3) for i in range(150)]
    df = spark.createDataFrame(rows, "date int, grid_id string, score double, label int")
    cap = {r["risk_group"]: r for r in R.daily_top_capture(df, "date", "label", "score", ["grid_id"]).collect()}
    # brute force
    total = sum(r[3] for r in rows)
    for f, name in ((0.01, "Top 1%"), (0.05, "Top 5%"), (0.10, "Top 10%")):
        sel = cap_count = 0
        for d in range(3):
            day = sorted([r for r in rows if r[0] == d], key=lambda r: (-r[2], r[1]))
            k = math.ceil(len(day) * f)
            sel += k
            cap_count += sum(r[3] for r in day[:k])
        assert cap[name]["rows_selected"] == sel
        assert cap[name]["positive_rows_captured"] == cap_count
        assert cap[name]["capture_rate"] == pytest.approx(cap_count / total)


def test_capture_rejects_bad_fraction(spark):
    df = spark.createDataFrame([(1, "a", 0.1, 1)], "date int, grid_id string, score double, label int")
    with pytest.raises(ValueError, match="within"):
        R.daily_top_capture(df, "date", "label", "score", ["grid_id"], fractions=(0.0,))


def test_ndcg_perfect_and_empty_days(spark):
    rows = [(1, "a", 0.9, 1), (1, "b", 0.1, 0), (2, "a", 0.5, 0), (2, "b", 0.4, 0)]
    df = spark.createDataFrame(rows, "date int, grid_id string, score double, label int")
    out = {r["date"]: r["ndcg"] for r in R.daily_ndcg(df, "date", "label", "score", ["grid_id"]).collect()}
    assert out == {1: 1.0, 2: 1.0}


def test_blend_weight_grid_has_35_vectors():
    v = R.weight_grid(4, 4)
    assert len(v) == 35 and all(abs(sum(x) - 1) < 1e-12 for x in v)


def test_confusion_zero_division(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    r = R.confusion_at_threshold(df, "label", "score", 0.5).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_log_bucket_is_monotone(spark):
    import struct

    vals = [0.0, -0.0, 5e-324, 1e-300, 0.1, 0.5, 1.0, 2.0, 3.0, 4.0, 8.0, 1e300, float("inf")]
    vals += [x * (1 + d) for x in (1.0, 2.0, 4.0, 1024.0, 2.0 ** -20) for d in (-1e-16, -2.2e-16, 2.2e-16, 1e-12)]
    vals += [-v for v in vals]
    vals += [struct.unpack("d", struct.pack("Q", b))[0] for b in range(0x3FF0000000000000 - 3, 0x3FF0000000000000 + 3)]
    df = spark.createDataFrame([(float(v),) for v in vals], "s double")
    rows = sorted((r["s"], r["b"]) for r in df.select("s", R.log_bucket(F.col("s")).alias("b")).collect())
    for (s1, b1), (s2, b2) in zip(rows, rows[1:]):
        assert b1 <= b2, (s1, b1, s2, b2)
        if s1 == s2:
            assert b1 == b2


def test_default_buckets_match_explicit_bounds(spark):
    rng = random.Random(11)
    rows = [(g, rng.randint(0, 1), rng.choice([0.0, -1.5, 2.0, 1e-3, rng.random(), rng.random() * 100])) for g in range(3) for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, label int, score double")
    a = {r["g"]: r for r in R.curve_metrics(R.score_levels(df, "label", "score", ["g"]), ["g"]).collect()}
    b = {r["g"]: r for r in R.curve_metrics(R.score_levels(df, "label", "score", ["g"], bounds=[0.5]), ["g"]).collect()}
    for g in range(3):
        assert a[g]["pr_auc"] == pytest.approx(b[g]["pr_auc"], abs=1e-12)
        assert a[g]["roc_auc"] == pytest.approx(b[g]["roc_auc"], abs=1e-12)
    r1 = {(r["g"], r["label"], r["score"], r["p"]) for r in R.average_percentile(df, ["g"], "score", "p").collect()}
    r2 = {(r["g"], r["label"], r["score"], r["p"]) for r in R.average_percentile(df, ["g"], "score", "p", bounds=[0.0, 1.0]).collect()}
    assert r1 == r2


def test_split_ties_rank_matches_plain_and_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for d in range(3):
        for i in range(400):
            score = 0.0 if rng.random() < 0.6 else round(rng.random(), 2)  # a hot tie at 0.0
            rows.append((d, f"g{rng.randint(0, 99999):05d}-{i}", score))
    df = spark.createDataFrame(rows, "date int, grid_id string, score double")
    plain = {(r["date"], r["grid_id"]): r["daily_rank"] for r in R.ordinal_rank(df, ["date"], "score", ["grid_id"]).collect()}
    split = {(r["date"], r["grid_id"]): r["daily_rank"] for r in R.ordinal_rank(df, ["date"], "score", ["grid_id"], split_ties=True).collect()}
    brute = {}
    for d in range(3):
        day = sorted([r for r in rows if r[0] == d], key=lambda r: (-r[2], r[1]))
        brute.update({(d, r[1]): i + 1 for i, r in enumerate(day)})
    assert plain == brute
    assert split == brute
    num = spark.createDataFrame([(1, i, 0.5 if i % 3 else 0.9) for i in range(300)], "date int, k long, score double")
    got = {r["k"]: r["daily_rank"] for r in R.ordinal_rank(num, ["date"], "score", ["k"], split_ties=True).collect()}
    exp = {k: i + 1 for i, k in enumerate(sorted(range(300), key=lambda k: (-(0.5 if k % 3 else 0.9), k)))}
    assert got == exp


def test_split_ties_keeps_null_scores_and_groups(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5), (1, "b", None), (1, "c", 0.9), (None, "d", 0.1), (None, "e", None)],
        "date int, grid_id string, score double")
    out = {r["grid_id"]: (r["daily_rank"], r["group_rows"]) for r in R.ordinal_rank(df, ["date"], "score", ["grid_id"]).collect()}
    assert out == {"c": (1, 3), "a": (2, 3), "b": (3, 3), "d": (1, 2), "e": (2, 2)}


def test_rank_without_tie_columns_is_a_valid_order(spark):
    rows = [(d, i, 0.0 if i % 4 else float(i)) for d in range(2) for i in range(200)]
    df = spark.createDataFrame(rows, "date int, k int, score double")
    out = R.ordinal_rank(df, ["date"], "score").collect()
    again = {(r["date"], r["k"]): r["daily_rank"] for r in R.ordinal_rank(df.repartition(5), ["date"], "score").collect()}
    for d in range(2):
        day = sorted((r for r in out if r["date"] == d), key=lambda r: r["daily_rank"])
        assert [r["daily_rank"] for r in day] == list(range(1, 201))
        scores = [r["score"] for r in day]
        assert scores == sorted(scores, reverse=True)
    assert again == {(r["date"], r["k"]): r["daily_rank"] for r in out}  # deterministic
