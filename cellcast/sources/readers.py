"""Sources (S1-S4, S8-S10): declared schemas, required-column contracts,
Parquet discovery with source order, GeoJSON grids, pixel tables and
fallback chains.  Every reader returns a lazy DataFrame; only path probing
and contracts run on the driver.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellcast.operators.contracts import require_columns

# Detection CSV as landed from the feed; acq_time is read as text so leading
# zeros are kept (F1 restores missing ones).
DETECTION_SCHEMA = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("acq_date", T.StringType()),
        T.StructField("acq_time", T.StringType()),
        T.StructField("frp", T.DoubleType()),
        T.StructField("satellite", T.StringType()),
        T.StructField("instrument", T.StringType()),
    ]
)
DETECTION_REQUIRED = ["latitude", "longitude", "acq_date", "acq_time"]


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values arrive as NaN from pandas-written files; Spark treats NaN
    as a value (``max`` returns it, ``count`` counts it), so float columns are
    normalised to null at every read."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (columns or df.columns) if c in floats]
    if not targets:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in targets})


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted paths matching a glob (works on any Hadoop file system)."""
    p, fs = _fs(spark, pattern)
    statuses = fs.globStatus(p)
    if statuses is None:
        return []
    return sorted(str(s.getPath().toString()) for s in statuses)


def read_detection_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = DETECTION_SCHEMA,
    required: Sequence[str] = DETECTION_REQUIRED,
) -> DataFrame:
    """The declared columns of CSV files that may have others besides.

    The header of the files is read first and checked for the required names;
    the columns of ``schema`` are then taken by name, with their types, and a
    value that does not fit becomes null.  ``enforceSchema=False`` makes Spark
    compare every file's header with the first one's.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    header = spark.read.option("header", True).csv(paths).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .schema(text)
        .csv(paths)
    )
    require_columns(raw, required, "Detection")
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema if f.name in header]
    return nan_to_null(raw.select(*typed))


def read_csv_folder(spark: SparkSession, folder: str, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """Every CSV matching ``pattern`` in ``folder``; error when there is none."""
    files = list_files(spark, os.path.join(folder, pattern))
    if not files:
        raise FileNotFoundError(f"{folder} holds no file like {pattern}.")
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(files)


def discover_parquet(spark: SparkSession, inputs: Sequence[str]) -> list[str]:
    """S3: explicit files and folders of ``*.parquet``; order kept, duplicates removed."""
    files: list[str] = []
    for item in inputs:
        p, fs = _fs(spark, item)
        if not fs.exists(p):
            raise FileNotFoundError(f"{item} does not exist.")
        if fs.getFileStatus(p).isDirectory():
            files.extend(list_files(spark, os.path.join(item, "*.parquet")))
        else:
            files.append(str(fs.makeQualified(p).toString()))
    unique = list(dict.fromkeys(files))
    if not unique:
        raise FileNotFoundError("The inputs hold no Parquet file.")
    return unique


def read_ordered_parquet(
    spark: SparkSession,
    inputs: Sequence[str],
    required: Sequence[str],
    keys: Sequence[str] = ("grid_id", "date"),
) -> DataFrame:
    """S3: read all files at once, tag each row with its file's position.

    The position comes from a broadcast (path -> order) table joined on
    ``_metadata.file_path``; every file's footer must have the required
    columns, and a key repeated inside one file is rejected with one grouped
    count.  Later files win in :func:`cellcast.operators.windows.dedupe_keep`.
    """
    files = discover_parquet(spark, inputs)
    for path in files:
        require_columns(spark.read.parquet(path), required, "Weather")
    df = spark.read.parquet(*files).select("*", F.col("_metadata.file_path").alias("_file"))
    order = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "_file string, _source_order int")
    tagged = df.join(F.broadcast(order), "_file", "left")
    dup, lost = (
        tagged.groupBy("_file", "_source_order", *keys)
        .count()
        .agg(F.sum(F.col("count") - 1), F.count_if(F.col("_source_order").isNull()))
        .first()
    )
    if lost:
        raise ValueError("Some rows come from files whose position in the input list is unknown.")
    if dup:
        raise ValueError(f"{dup:,} rows of the input files repeat a key of their own file.")
    return nan_to_null(tagged.drop("_file"))


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Parquet read of only the named columns (pruned at the scan)."""
    df = spark.read.parquet(path)
    require_columns(df, columns, path)
    return nan_to_null(df.select(*columns))


def read_grid_geojson(
    spark: SparkSession, path: str, id_field: str = "grid_id", line_delimited: bool = False
) -> DataFrame:
    """FeatureCollection -> (grid_id, properties, rings).

    Polygons give one ring list; MultiPolygons are exploded to their parts.
    A FeatureCollection file is one JSON record (read by one task; fine for a
    grid of thousands of cells); ``line_delimited`` reads one feature per line
    so a large grid is split across tasks.
    """
    coords_schema = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
    schema = T.StructType(
        [
            T.StructField(
                "features",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
                            T.StructField(
                                "geometry",
                                T.StructType(
                                    [
                                        T.StructField("type", T.StringType()),
                                        T.StructField("coordinates", T.StringType()),
                                    ]
                                ),
                            ),
                        ]
                    )
                ),
            )
        ]
    )
    if line_delimited:
        feats = spark.read.schema(schema["features"].dataType.elementType).json(path).select(
            F.struct("properties", "geometry").alias("f")
        )
    else:
        raw = spark.read.schema(schema).option("multiLine", True).json(path)
        feats = raw.select(F.explode("features").alias("f"))
    geom = F.col("f.geometry.coordinates")
    multi = F.from_json(geom, coords_schema)
    single = F.from_json(geom, T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
    parts = F.when(F.col("f.geometry.type") == "MultiPolygon", multi).otherwise(F.array(single))
    rows = feats.select(
        F.col("f.properties")[id_field].alias("grid_id"),
        F.col("f.properties").alias("properties"),
        F.explode(parts).alias("polygon"),
    )
    to_ring = lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return rows.select("grid_id", "properties", to_ring(F.col("polygon")[0]).alias("ring"),
                       F.transform(F.slice("polygon", 2, F.size("polygon")), to_ring).alias("holes"))


def read_pixels(spark: SparkSession, path: str, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Pixel table (x, y, value); an optional bounding box is pushed to the scan."""
    df = nan_to_null(spark.read.parquet(path).select("x", "y", "value"))
    if bbox:
        x0, y0, x1, y1 = bbox
        df = df.filter(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))
    return df


def first_available(spark: SparkSession, candidates: Sequence[str], legacy_glob: str | None = None) -> str:
    """The preferred path, else the newest legacy file by name, else an error."""
    for path in candidates:
        if path_exists(spark, path):
            return path
    if legacy_glob:
        legacy = list_files(spark, legacy_glob)
        if legacy:
            return legacy[-1]
    raise FileNotFoundError(f"Looked for {list(candidates)} {legacy_glob or ''} and found nothing.")
