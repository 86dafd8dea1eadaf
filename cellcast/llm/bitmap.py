"""A bitmap of hashed keys that lets most rows skip a join.

The bitmap has a fixed upper size (2^26 bits, 8 MB).  It never loses a key: a
row whose key is present always passes; a few others pass too, and the join
that follows removes them.  With more keys than bits it merely stops helping.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 15, 26
_PART_BITS = 15


def key_bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Bits (packed, little-endian) of the long column ``column`` of ``keys``, which holds hashes."""
    count = keys.count()
    bits = min(MAX_BITS, max(MIN_BITS, (16 * count).bit_length()))
    spot = F.shiftrightunsigned(column, 64 - bits)

    def build(table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << _PART_BITS, np.uint8)
        flags[table["spot"].to_numpy() & ((1 << _PART_BITS) - 1)] = 1
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pa.table({"part": table["part"][:1], "bits": pa.array([packed], pa.binary())})

    parts = (
        keys.select(spot.alias("spot"))
        .distinct()
        .select("spot", F.shiftrightunsigned("spot", _PART_BITS).alias("part"))
        .groupBy("part")
        .applyInArrow(build, "part long, bits binary")
    )
    out = np.zeros((1 << (bits - _PART_BITS), 1 << (_PART_BITS - 3)), np.uint8)
    for r in parts.collect():
        out[r.part] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def may_contain(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each (int64) key may be in the bitmap."""
    bits = (8 * len(bitmap)).bit_length() - 1
    spot = keys.view(np.uint64) >> np.uint64(64 - bits)
    return (bitmap[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def filter_rows(df: DataFrame, column: str, bitmap: np.ndarray, inside: bool = True) -> DataFrame:
    """Rows of ``df`` whose long ``column`` may be in the bitmap; with ``inside`` false, all others."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for batch in batches:
            keys = batch.column(column).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(may_contain(shared.value, keys) == inside))

    return df.mapInArrow(run, df.schema)


def explode_hits(df: DataFrame, column: str, bitmap: np.ndarray, keep: list[str]) -> DataFrame:
    """Rows (``keep``, key) for the elements of an array column that may be in the bitmap."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for batch in batches:
            lists = batch.column(column)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            hit = may_contain(shared.value, values)
            pick = pa.array(owner[hit])
            cols = {c: batch.column(c).take(pick) for c in keep}
            yield pa.record_batch({**cols, "key": pa.array(values[hit], pa.int64())})

    types = dict(df.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in keep) + ", key bigint"
    return df.select(*keep, column).mapInArrow(run, schema)
