"""Sinks (K1-K10).  All writes go through DataFrameWriter; "atomic" means a new
versioned folder plus a pointer switch, never an in-place overwrite of a path
that may be read."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellcast.operators import contracts as C


def write_parquet_and_csv(df: DataFrame, parquet_path: str, csv_path: str, mode: str = "overwrite") -> None:
    """K1: the same table as Parquet and as CSV with a header."""
    df.write.mode(mode).parquet(parquet_path)
    df.write.mode(mode).option("header", True).csv(csv_path)


def write_grid(cells: DataFrame, geojson_path: str, centroids_path: str, id_col: str = "grid_id") -> None:
    """K1: the grid as one GeoJSON FeatureCollection and its centroids as CSV, both in id order.

    ``cells``: id, ``centroid_lat``, ``centroid_lon`` and ``polygons`` (array of
    polygons, each an array of rings of (x, y) in degrees, closed).  Features are
    written as text in parallel and strung together by the file system.
    """
    spark = cells.sparkSession
    pairs = F.transform("polygons", lambda p: F.transform(p, lambda r: F.transform(r, lambda c: F.array(c["x"], c["y"]))))
    single = F.size("polygons") == 1
    geometry = F.when(
        single, F.to_json(F.struct(F.lit("Polygon").alias("type"), pairs[0].alias("coordinates")))
    ).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), pairs.alias("coordinates"))))
    properties = F.to_json(F.struct(id_col, "centroid_lat", "centroid_lon"))
    feature = F.concat(
        F.lit(',{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}")
    )
    parts = f"{geojson_path}.parts-{uuid.uuid4().hex[:8]}"
    cells.select(id_col, feature.alias("value")).orderBy(id_col).select("value").write.text(parts)
    join_text_parts(spark, parts, geojson_path, '{"type":"FeatureCollection","features":[\n', "]}\n", skip=1)
    centroids = cells.select(id_col, "centroid_lat", "centroid_lon").orderBy(id_col)
    centroids.write.mode("errorifexists").option("header", True).csv(centroids_path)


def write_versioned(df: DataFrame, root: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """K2: write to ``root/v-<time>-<id>`` then move ``root/CURRENT`` to it."""
    version = new_version()
    target = os.path.join(root, version)
    writer = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)
    switch_pointer(df.sparkSession, root, version)
    return target


def new_version() -> str:
    """Name of a new version: its time, and a few random letters."""
    return f"v-{dt.datetime.now(dt.timezone.utc).strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:6]}"


def join_text_parts(spark: SparkSession, parts: str, target: str, head: str, foot: str, skip: int = 0) -> None:
    """String the part files of a folder together, in name order, between ``head`` and ``foot``.

    The Hadoop file system of ``target`` copies them through a fixed buffer;
    ``skip`` leaves out the first bytes of all.  The folder of parts goes afterwards.
    """
    jvm = spark.sparkContext._jvm
    api = jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = api.Path(parts)
    fs = folder.getFileSystem(conf)
    names = sorted(s.getPath().toString() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-") and s.getLen())
    out = fs.create(api.Path(target), False)
    try:
        out.write(bytearray(head.encode()))
        for name in names:
            stream = fs.open(api.Path(name))
            try:
                if skip:
                    stream.seek(skip)
                    skip = 0
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            finally:
                stream.close()
        out.write(bytearray(foot.encode()))
    finally:
        out.close()
    fs.delete(folder, True)


def switch_pointer(spark: SparkSession, root: str, version: str) -> None:
    """Let ``root/CURRENT`` name ``version``: a new file, renamed over the old one by
    the Hadoop file system of ``root``."""
    api = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = api.Path(root).getFileSystem(conf)
    folder = fs.makeQualified(api.Path(root))
    fs.mkdirs(folder)
    fresh = api.Path(folder, f"CURRENT.{uuid.uuid4().hex}.tmp")
    stream = fs.create(fresh, False)
    stream.write(bytearray(f"{version}\n".encode()))
    stream.close()
    rename = getattr(api, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    api.FileContext.getFileContext(folder.toUri(), conf).rename(fresh, api.Path(folder, "CURRENT"), options)


def read_pointer(spark: SparkSession, root: str) -> str | None:
    """The version that ``root/CURRENT`` names, or None."""
    from cellcast.sources.readers import path_exists

    pointer = os.path.join(root, "CURRENT")
    return spark.read.text(pointer).first()["value"].strip() if path_exists(spark, pointer) else None


def write_sample(df: DataFrame, path: str, order: Sequence[str] = ("grid_id", "date"), rows: int = 5000) -> None:
    """K3: the first ``rows`` rows in key order, as CSV (a sample is the feature here)."""
    df.orderBy(*order).limit(rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_checked(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K5: append rows whose schema equals the existing table's, else raise."""
    spark = df.sparkSession
    from cellcast.sources.readers import path_exists

    if path_exists(spark, path):
        existing = spark.read.format(fmt).load(path).dtypes
        if existing != df.dtypes:
            raise ValueError(f"The rows to append do not match {path}: it holds {existing}, they have {df.dtypes}.")
    df.write.mode("append").format(fmt).save(path)


def scored_rows(df: DataFrame, score_col: str, threshold: float,
                preferred: Sequence[str] = ("date", "grid_id", "fire_next_day")) -> DataFrame:
    """K6: preferred columns that exist + score + predicted class."""
    keep = [c for c in preferred if c in df.columns]
    return df.select(
        *keep,
        F.col(score_col).alias("predicted_score"),
        (F.col(score_col) >= F.lit(float(threshold))).cast("int").alias("predicted_class"),
    )


def write_new(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K7: refuse to overwrite an existing output."""
    df.write.mode("errorifexists").format(fmt).save(path)


def quarantine(rejected: DataFrame, requests: DataFrame, path: str,
               batch_col: str = "batch_number", key: str = "grid_id", position_col: str = "position") -> None:
    """K8: one row per failed batch: first and last cell by position, the error."""
    spans = requests.groupBy(batch_col).agg(
        F.min_by(key, position_col).alias("first_grid_id"),
        F.max_by(key, position_col).alias("last_grid_id"),
        F.count(F.lit(1)).alias("cells"),
    )
    log = rejected.groupBy(batch_col).agg(F.first("error").alias("error")).join(spans, batch_col, "left")
    log.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def write_by_year(df: DataFrame, path: str, key: str = "grid_id", year_col: str = "history_year",
                  expected_per_year: int | None = None) -> None:
    """K9: per-year partitions + key/row-count contract (one aggregate)."""
    dup = C.duplicate_report(df, [key, year_col]).first()["duplicate_rows"]
    if dup:
        raise ValueError(f"Summary contains {dup:,} duplicate grid-years.")
    if expected_per_year is not None:
        bad = df.groupBy(year_col).count().filter(F.col("count") != expected_per_year).limit(1).count()
        if bad:
            raise ValueError("A year summary changed the grid count.")
    df.write.mode("overwrite").partitionBy(year_col).parquet(path)


def experiment_row(spark, metadata: dict, feature_columns: Sequence[str], metrics: DataFrame) -> DataFrame:
    """K5 record: run metadata + the feature list joined with "|" (F21) + one metrics row."""
    meta = spark.createDataFrame([tuple(metadata.values())], list(metadata.keys()))
    feats = spark.createDataFrame([(list(feature_columns),)], "features array<string>").select(
        F.concat_ws("|", "features").alias("features"), F.size("features").alias("feature_count")
    )
    return C.side_by_side(meta.withColumn("recorded_at_utc", F.current_timestamp()), feats, metrics)
