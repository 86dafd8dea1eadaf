"""Spark session and lineage helpers.

Every job in the package runs on a session built here (or on one the caller
already owns).  The settings are the ones that matter at scale: UTC session
time (dates are derived from UTC timestamps), adaptive query execution with
skew-join splitting, and Arrow for the few pandas hand-offs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "cellcast",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(
    input_bytes: int,
    executors: int,
    cores_per_executor: int,
    shuffle_fraction: float = 0.25,
    target_partition_bytes: int = 256 << 20,
) -> dict[str, str]:
    """Session settings sized for a cluster run.

    Shuffle partitions are sized so that the expected shuffle volume (input
    after pruning and partial aggregation, ``shuffle_fraction``) lands near
    ``target_partition_bytes`` per partition -- small enough to sort in
    executor memory without heavy spill -- and never fewer than two waves of
    cores.  AQE then coalesces small partitions and splits skewed ones.
    """
    slots = max(1, executors * cores_per_executor)
    wanted = int(input_bytes * shuffle_fraction // target_partition_bytes) + 1
    partitions = min(max(2 * slots, wanted), 100_000)
    mb = target_partition_bytes >> 20
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{mb}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{mb}m",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    (local tests) is a scratch folder created; on a cluster the setting must
    name shared storage.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        configured = tempfile.mkdtemp(prefix="cellcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpoint_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing Parquet under the shared checkpoint folder.

    Unlike ``localCheckpoint`` the data survives executor loss, and unlike
    ``cache`` a recompute never re-runs the upstream plan.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Reliable lineage cut into the shared checkpoint folder (never ``localCheckpoint``).

    Written as Parquet and read back: one job (``Dataset.checkpoint`` computes
    the plan twice unless cached), columnar and compressed, and later jobs
    that reuse ``df`` -- or retry after losing an executor -- start from the
    files instead of recomputing the upstream plan.
    """
    return checkpoint_table(df, name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Bytes of one Arrow batch between the JVM and a Python worker.
ARROW_BATCH_BYTES = 4 << 20


def bound_arrow_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, unless the session has a tighter limit.

    Spark's default of 64 MB counts for every running task several times over: once
    in the JVM's buffers and at least once in the worker, before any result.  Texts
    differ in length by orders of magnitude, so a row limit does not bound memory.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).strip().lower().removesuffix("b")
    if not now.isdigit() or int(now) <= 0 or int(now) > ARROW_BATCH_BYTES:
        spark.conf.set(key, str(ARROW_BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Make the package importable on every Python worker (once per context).

    Pandas and Arrow functions are pickled by reference to their module, so a
    worker started elsewhere needs the sources; Spark itself hands out the zip.
    """
    bound_arrow_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_cellcast_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cellcast-zip-"), "cellcast_sources.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    sc._cellcast_shipped = True
