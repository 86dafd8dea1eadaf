"""Metamorphic checks: shuffle-partition count and input order never change results."""

import pytest

import __spark_entry__ as entry
from oracle_check import canon

SF = "/root/testdata/sf0.001"
NAMES = ["topk_capture", "daily_percentile", "average_precision", "monthly_metrics", "nearest_cell",
         "point_in_cell", "dedupe_keep_last", "blend_weights", "year_safe_features", "zonal_mode"]


@pytest.mark.parametrize("name", NAMES)
def test_partition_count_invariance(spark, name):
    fn = entry.queries()[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = fn(spark, SF)
            results.append(canon(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_row_order_invariance(spark):
    from pyspark.sql import functions as F

    from cellcast.operators import ranking as R

    df = spark.read.parquet(f"{SF}/orders.parquet").select(
        F.to_date("o_orderdate").alias("date"), "o_orderkey", F.col("o_totalprice").alias("score"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    shuffled = df.orderBy(F.rand(5)).repartition(7)
    a = R.daily_top_capture(df, "date", "label", "score", ["o_orderkey"]).collect()
    b = R.daily_top_capture(shuffled, "date", "label", "score", ["o_orderkey"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
