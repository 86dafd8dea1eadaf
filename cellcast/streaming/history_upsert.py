"""Keep a rolling weather history current.

Batch form: ``upsert_history`` unions retained rows with newly landed rows,
lets the newest copy of each (cell, date) win, and trims to ``[D-30, D]``.

Stream form: ``start_history_stream`` watches a landing folder with a file
source; each micro-batch is merged into the retained history with the same
function.  Only the dates it touches are written, to new folders; one pointer
then names the folders of all dates and the batch's epoch (K2), so a batch that
is replayed after a failure writes nothing.  No watermark applies: a revision may
arrive for any retained date, and the retained state is bounded by the trim (31
dates per cell).
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cellcast.fixed_values import HISTORY_DAYS
from cellcast.operators.panel import history_trim
from cellcast.operators.windows import dedupe_keep
from cellcast.sinks.writers import new_version, read_pointer, switch_pointer


def upsert_history(
    existing: DataFrame,
    downloaded: DataFrame,
    forecast_date: dt.date,
    keys: Sequence[str] = ("grid_id", "date"),
    date_col: str = "date",
    days: int = HISTORY_DAYS,
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """Merge (new rows replace old ones on the same key), then trim to ``days + 1`` dates.

    ``order_cols`` of ``downloaded`` order its rows of one key (the last wins);
    they are not kept.
    """
    old = existing.withColumn(date_col, F.to_date(date_col)).withColumn("_src", F.lit(0))
    new = downloaded.withColumn(date_col, F.to_date(date_col)).withColumn("_src", F.lit(1))
    both = old.unionByName(new, allowMissingColumns=True)
    # Trim first: rows outside the window never reach the shuffle.
    both = history_trim(both, date_col, forecast_date, days)
    latest = dedupe_keep(both, list(keys), ["_src", *order_cols], keep="last")
    return latest.drop("_src", *order_cols)


def _manifest(spark: SparkSession, root: str) -> dict:
    """What ``CURRENT`` holds: the folder of every retained date, and the last epoch of every source."""
    text = read_pointer(spark, root)
    return json.loads(text) if text else {"dates": {}, "epochs": {}}


def current_version(root: str, spark: SparkSession | None = None) -> str | None:
    """A path pattern of all retained dates' folders; None before the first batch.

    A pattern is one string, so every reader takes it; :func:`read_history` also
    merges schemas of dates that landed with different columns.
    """
    dates = _manifest(spark or SparkSession.active(), root)["dates"]
    return os.path.join(root, "{" + ",".join(dates[d] for d in sorted(dates)) + "}") if dates else None


def read_history(spark: SparkSession, root: str) -> DataFrame | None:
    path = current_version(root, spark)
    return spark.read.option("mergeSchema", True).parquet(path) if path else None


def merge_batch(
    spark: SparkSession,
    batch: DataFrame,
    history_root: str,
    forecast_date: dt.date | None = None,
    keys: Sequence[str] = ("grid_id", "date"),
    date_col: str = "date",
    order_cols: Sequence[str] = (),
    source: str = "",
    epoch: int | None = None,
    days: int = HISTORY_DAYS,
) -> str | None:
    """Merge one landed batch into the retained history; returns its path pattern.

    Only the dates that the batch touches are read and written, each to a folder of
    its own; ``CURRENT`` then names the folders of all dates, old and new, in one
    switch.  It also names the last ``epoch`` of ``source``: a batch that comes
    again with an epoch already merged writes nothing.  Without ``forecast_date``
    the window ends at the newest date of the history and the batch, so it moves
    on as days land; dates that leave it are only dropped from the list.
    """
    manifest = _manifest(spark, history_root)
    dates, epochs = manifest["dates"], manifest["epochs"]
    if epoch is not None and epoch <= epochs.get(source, -1):
        return current_version(history_root, spark)
    landed = batch.withColumn(date_col, F.to_date(date_col))
    if forecast_date is None:
        newest = [d for d in (landed.agg(F.max(date_col)).first()[0],) if d] + [dt.date.fromisoformat(d) for d in dates]
        if not newest:
            return None
        forecast_date = max(newest)
    landed = history_trim(landed, date_col, forecast_date, days)
    # At most days + 1 dates.
    touched = sorted(str(r[0]) for r in landed.select(date_col).distinct().collect())
    first, last = str(forecast_date - dt.timedelta(days=days)), str(forecast_date)
    kept = {d: p for d, p in dates.items() if first <= d <= last}
    if touched:
        old = [os.path.join(history_root, kept[d]) for d in touched if d in kept]
        existing = (
            spark.read.option("mergeSchema", True).parquet(*old)
            if old
            else spark.createDataFrame([], landed.drop(*order_cols).schema)
        )
        merged = upsert_history(existing, landed, forecast_date, keys, date_col, days, order_cols)
        version = new_version()
        folder = F.date_format(date_col, "yyyy-MM-dd")
        merged.withColumn("_day", folder).write.partitionBy("_day").mode("errorifexists").parquet(
            os.path.join(history_root, "parts", version)
        )
        kept |= {d: f"parts/{version}/_day={d}" for d in touched}
    if epoch is not None:
        epochs[source] = epoch
    switch_pointer(spark, history_root, json.dumps({"dates": kept, "epochs": epochs}))
    return current_version(history_root, spark)


def start_history_stream(
    spark: SparkSession,
    landing_dir: str,
    schema: StructType,
    history_root: str,
    checkpoint_dir: str,
    forecast_date: dt.date | None = None,
    keys: Sequence[str] = ("grid_id", "date"),
    date_col: str = "date",
    once: bool = True,
) -> StreamingQuery:
    """File-source stream -> ``foreachBatch(merge_batch)``; exactly-once via the
    stream checkpoint and the epoch in the pointer, which is kept by checkpoint folder.

    Without ``forecast_date`` each batch moves the window to the newest date
    seen.  Of two files of one batch the one that landed later wins.
    """
    landed = ("_landed", "_file")
    stream = spark.readStream.schema(schema).parquet(landing_dir)
    stream = stream.select(
        "*",
        F.col("_metadata.file_modification_time").alias(landed[0]),
        F.col("_metadata.file_path").alias(landed[1]),
    )

    def handle(batch: DataFrame, epoch_id: int) -> None:
        if batch.limit(1).count():
            merge_batch(
                batch.sparkSession, batch, history_root, forecast_date, keys, date_col, landed, checkpoint_dir, epoch_id
            )

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
