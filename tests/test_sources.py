"""Sources and sinks on small landed files."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from cellcast.functions.dates import detection_day, hhmm
from cellcast.sources import payload as S
from cellcast.sources import readers as RD
from cellcast.sinks import writers as K


def test_detection_csv_and_hhmm(spark, tmp_dir):
    path = os.path.join(tmp_dir, "d.csv")
    with open(path, "w") as fh:
        fh.write("latitude,longitude,acq_date,acq_time,frp,satellite,instrument\n")
        fh.write("36.1,-120.2,2024-07-01,5,1.5,N,VIIRS\n37.0,-121.0,2024-07-01,2359,2.0,N,VIIRS\n")
    df = RD.read_detection_csv(spark, path)
    rows = df.select(hhmm(F.col("acq_time")).alias("t"), detection_day(F.col("acq_date"), F.col("acq_time")).alias("d")).collect()
    assert [r["t"] for r in rows] == ["0005", "2359"]
    assert all(r["d"] == dt.date(2024, 7, 1) for r in rows)


def test_missing_folder_files_raise(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        RD.read_csv_folder(spark, tmp_dir, "weather_batch_*.csv")


def test_ordered_parquet_later_file_wins(spark, tmp_dir):
    from cellcast.operators.windows import dedupe_keep

    a, b = os.path.join(tmp_dir, "a.parquet"), os.path.join(tmp_dir, "b.parquet")
    spark.createDataFrame([("c", "2024-01-01", 1.0)], "grid_id string, date string, v double").write.parquet(a)
    spark.createDataFrame([("c", "2024-01-01", 2.0)], "grid_id string, date string, v double").write.parquet(b)
    df = RD.read_ordered_parquet(spark, [a, b], ["grid_id", "date", "v"])
    out = dedupe_keep(df, ["grid_id", "date"], ["_source_order"], "last").first()
    assert out["v"] == 2.0


def test_payload_flatten_and_size_mismatch(spark):
    requests = spark.createDataFrame([(1, 0, "A"), (1, 1, "B"), (2, 0, "C")], "batch_number long, position int, grid_id string")
    loc = lambda v: {"latitude": 1.0, "longitude": 2.0, "elevation": 3.0, "daily": {"time": ["2024-01-01", "2024-01-02"], "t": [v, v + 1]}}
    payloads = spark.createDataFrame([(1, json.dumps([loc(1.0), loc(5.0)])), (2, json.dumps([loc(9.0), loc(9.0)]))], "batch_number long, payload string")
    rows, rejected = S.flatten_payload(payloads, requests, ["t"])
    got = sorted((r["grid_id"], str(r["date"]), r["t"]) for r in rows.collect())
    assert got == [("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0), ("B", "2024-01-01", 5.0), ("B", "2024-01-02", 6.0)]
    assert [r["batch_number"] for r in rejected.collect()] == [2]


def test_single_object_payload(spark):
    requests = spark.createDataFrame([(1, 0, "A")], "batch_number long, position int, grid_id string")
    obj = {"latitude": 1.0, "longitude": 2.0, "elevation": 3.0, "daily": {"time": ["2024-01-01"], "t": [7.0]}}
    payloads = spark.createDataFrame([(1, json.dumps(obj))], "batch_number long, payload string")
    rows, rejected = S.flatten_payload(payloads, requests, ["t"])
    assert rows.count() == 1 and rejected.count() == 0


def test_triage(spark):
    raw = spark.createDataFrame([("",), ("<html>",), ("Invalid key",), ("a,b\n1,2",)], "value string")
    assert [r["status"] for r in S.triage_payloads(raw).collect()] == ["empty", "html", "invalid", "good"]
    assert S.triage_payloads(raw, allow_empty=True).first()["status"] == "good"


def test_date_blocks(spark):
    df = spark.range(1).select(F.explode(S.date_blocks(dt.date(2024, 1, 1), dt.date(2024, 1, 12), 5)).alias("b"))
    assert [(str(r["b"]["block_start"]), r["b"]["day_count"]) for r in df.collect()] == [
        ("2024-01-01", 5), ("2024-01-06", 5), ("2024-01-11", 2)]


def test_geojson_grid(spark, tmp_dir):
    path = os.path.join(tmp_dir, "grid.geojson")
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"grid_id": "CA-00001"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"grid_id": "CA-00002"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[2, 0], [3, 0], [3, 1], [2, 0]]], [[[4, 0], [5, 0], [5, 1], [4, 0]]]]}},
    ]}
    with open(path, "w") as fh:
        json.dump(fc, fh)
    g = RD.read_grid_geojson(spark, path)
    assert sorted(r["grid_id"] for r in g.collect()) == ["CA-00001", "CA-00002", "CA-00002"]


def test_append_checked_rejects_schema_change(spark, tmp_dir):
    path = os.path.join(tmp_dir, "results")
    K.append_checked(spark.createDataFrame([(1, 0.5)], "fold int, pr_auc double"), path)
    with pytest.raises(ValueError, match="do not match"):
        K.append_checked(spark.createDataFrame([(1, 0.5, 1)], "fold int, pr_auc double, extra int"), path)


def test_refuse_overwrite(spark, tmp_dir):
    path = os.path.join(tmp_dir, "out")
    K.write_new(spark.range(1), path)
    with pytest.raises(Exception):
        K.write_new(spark.range(1), path)


def test_nan_becomes_null_at_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "w.parquet")
    spark.createDataFrame([("c", "2024-01-01", float("nan")), ("c", "2024-01-02", 2.0)], "grid_id string, date string, v double").write.parquet(path)
    df = RD.read_columns(spark, path, ["grid_id", "date", "v"])
    r = df.agg(F.count("v").alias("n"), F.max("v").alias("m")).first()
    assert (r["n"], r["m"]) == (1, 2.0)


def test_geojson_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "grid.jsonl")
    with open(path, "w") as fh:
        for i in range(3):
            fh.write(json.dumps({"type": "Feature", "properties": {"grid_id": f"CA-{i:05d}"},
                                 "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 0]]]}}) + "\n")
    g = RD.read_grid_geojson(spark, path, line_delimited=True)
    assert sorted(r["grid_id"] for r in g.collect()) == ["CA-00000", "CA-00001", "CA-00002"]
    assert len(g.first()["ring"]) == 4


def test_explicit_unsorted_files_keep_their_order(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for name, value in (("a", 1.0), ("b", 2.0)):
        pq.write_table(pa.table({"grid_id": ["x"], "date": ["2024-01-01"], "v": [value]}), f"{tmp_dir}/{name}.parquet")
    files = [f"{tmp_dir}/b.parquet", f"{tmp_dir}/a.parquet"]
    got = {r.v: r._source_order for r in RD.read_ordered_parquet(spark, files, ["grid_id", "v"]).collect()}
    assert got == {2.0: 0, 1.0: 1}
    pq.write_table(pa.table({"grid_id": ["x"], "date": ["2024-01-02"]}), f"{tmp_dir}/c.parquet")
    with pytest.raises(ValueError):
        RD.read_ordered_parquet(spark, [*files, f"{tmp_dir}/c.parquet"], ["grid_id", "v"])


def test_wide_detection_header(spark, tmp_dir):
    names = "latitude,longitude,brightness,scan,acq_date,acq_time,satellite,instrument,frp,daynight"
    with open(f"{tmp_dir}/wide.csv", "w") as f:
        f.write(names + "\n34.5,-118.2,300.1,0.4,2024-07-01,0905,N,VIIRS,2.5,D\n")
    row = RD.read_detection_csv(spark, f"{tmp_dir}/wide.csv").first()
    assert (row.latitude, row.longitude, row.frp, row.satellite) == (34.5, -118.2, 2.5, "N")
    with open(f"{tmp_dir}/short.csv", "w") as f:
        f.write("latitude,longitude,frp\n34.5,-118.2,2.5\n")
    with pytest.raises(ValueError):
        RD.read_detection_csv(spark, f"{tmp_dir}/short.csv")
