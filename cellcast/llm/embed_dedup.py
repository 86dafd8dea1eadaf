"""Embedding near-duplicates by sorted projection passes.

Each pass hashes a vector to 64 sign bits of random projections and sorts all
vectors lexicographically by the concatenated bits; a vector is compared with
the neighbours in its block of the order and in the next block (at least
``block`` followers).  Verified links of all passes are united.  The passes only
have to connect a group, not to meet every pair of it: afterwards the members of
each component are compared with each other in blocks, which gives exact link
counts however many neighbours a vector has.

Passes come in rounds with new projections.  In a pass all vectors that share the
first L bits with a vector lie in the blocks it is compared with, where L follows
from the order itself and grows with the row count and the density around it; a
vector at the threshold angle shares them with probability ``(1 - angle / pi)^L``.
The next round takes the vectors whose passes together may still miss such a
neighbour with more than probability ``miss``.  Rounds end when there is no such
vector, or when one joins no two components.  Links are found with high
probability, not with certainty: the README gives measured recall.

Equal vectors are one class with a weight, so copies cost nothing.  Cosines are
taken in double precision.  A vector that is null, empty, zero or holds null or
non-finite components links with nothing, and so do vectors of different
lengths.  Rows with a null id get no component and no links.  Repeated rows
count as vectors of their own.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm.graph import components
from cellcast.session import cut_lineage, ship_package, shuffle_partitions

_POSITION = (1 << 33) - 1


def _unit_rows(vectors: list[np.ndarray]) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keys(passes: int, seed: int, turn: int):
    """(id, vec) -> (pass, dim, key, id): 64 sign bits, most significant first, as an ordered long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for batch in batches:
            ids, lists = batch.column("id").to_numpy(), batch.column("vec")
            sizes = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                x = _unit_rows([lists[int(i)].values.to_numpy(zero_copy_only=False) for i in own])
                for p in range(passes):
                    plane = np.random.default_rng([seed, p + passes * turn, dim]).standard_normal((dim, 64))
                    key = ((x @ plane > 0) * weight).sum(axis=1, dtype=np.uint64)
                    yield pa.record_batch(
                        {
                            "pass": pa.array(np.full(len(own), p, np.int32)),
                            "dim": pa.array(np.full(len(own), dim, np.int32)),
                            "key": pa.array((key ^ np.uint64(1 << 63)).view(np.int64)),
                            "id": pa.array(ids[own]),
                        }
                    )

    return run


def _similar(table: pa.Table, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, link matrix) of the rows of each pass and length."""
    sizes = np.array([len(v) for v in table["vec"]])
    passes = table["pass"].to_numpy() if "pass" in table.schema.names else np.zeros(len(sizes))
    for p in np.unique(passes):
        for dim in np.unique(sizes[passes == p]):
            rows = np.flatnonzero((passes == p) & (sizes == dim))
            x = _unit_rows([table["vec"][int(i)].values.to_numpy(zero_copy_only=False) for i in rows])
            yield rows, x @ x.T >= threshold


def _common_bits(keys: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many leading bits each key shares with ``limit``."""
    other = (keys ^ limit).view(np.uint64)
    high, low = other >> np.uint64(32), other & np.uint64(0xFFFFFFFF)
    return 64 - np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])


def _reach(table: pa.Table, here: int, last: int, block: int) -> np.ndarray:
    """Leading bits that a row may share with rows beyond this block and its successor (-1: with none).

    Rows of the block look at what follows, rows of its successor at what precedes.
    """
    place, keys = table["position"].to_numpy(), table["key"].to_numpy()
    run = np.stack([table["pass"].to_numpy(), table["dim"].to_numpy()])
    out = np.full(len(place), -1, np.int32)
    own = place // block == here
    for side, edge, whole in ((own, place.argmax(), here + 1 >= last), (~own, place.argmin(), here <= 0)):
        rows = np.flatnonzero(side & (run == run[:, [edge]]).all(axis=0))
        if not whole:
            out[rows] = _common_bits(keys[rows], keys[edge])
    return out


def _window_links(threshold: float, last: int, block: int):
    """Spanning links (a, b) of a block and its successor, and each row's reach (a, pass, bits)."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        bits = _reach(table, key[0].as_py(), last, block)
        a, b = [], []
        for rows, link in _similar(table, threshold):
            order = np.argsort(ids[rows])
            rows, link = rows[order], link[np.ix_(order, order)]
            np.fill_diagonal(link, True)
            root = np.arange(len(rows))
            while True:
                new = np.minimum(root, np.where(link, root[None, :], len(rows)).min(axis=1))
                new = new[new]
                if (new == root).all():
                    break
                root = new
            moved = np.flatnonzero(root != np.arange(len(rows)))
            a.append(ids[rows[moved]])
            b.append(ids[rows[root[moved]]])
        cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b)]
        none = len(cols[0])
        return pa.table(
            {
                "a": pa.array(np.concatenate([cols[0], ids]), pa.int64()),
                "b": pa.concat_arrays([pa.array(cols[1], pa.int64()), pa.nulls(len(ids), pa.int64())]),
                "pass": pa.concat_arrays([pa.nulls(none, pa.int32()), table["pass"].combine_chunks()]),
                "bits": pa.concat_arrays([pa.nulls(none, pa.int32()), pa.array(bits, pa.int32())]),
            }
        )

    return run


def _count_links(threshold: float):
    """Of two parts of a component (or one): each member's linked rows in the other part."""

    def run(table: pa.Table) -> pa.Table:
        ids, weight = table["id"].to_numpy(), table["copies"].to_numpy()
        first = table["part"].to_numpy() == table["p"].to_numpy()
        alone = bool((table["p"].to_numpy() == table["q"].to_numpy()).all())
        total = np.zeros(len(ids), np.int64)
        for rows, link in _similar(table, threshold):
            if alone:
                np.fill_diagonal(link, False)
            else:
                link = link & (first[rows][:, None] != first[rows][None, :])
            total[rows] = link @ weight[rows]
        return pa.table({"id": table["id"], "n": pa.array(total)})

    return run


def _one_round(
    active: DataFrame, threshold: float, passes: int, block: int, seed: int, turn: int
) -> DataFrame:
    """Links and reach of ``passes`` sorted passes over ``active``."""
    spark = active.sparkSession
    keyed = active.select("id", "vec").mapInArrow(
        _keys(passes, seed, turn), "pass int, dim int, key long, id long"
    )
    order = ["pass", "dim", "key", "id"]
    placed = cut_lineage(
        keyed.repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("mid", F.monotonically_increasing_id()),
        "order",
    )
    # One row per partition: how many rows the partitions before it hold.
    task = F.shiftright("mid", 33)
    counts = sorted(placed.groupBy(task.alias("task")).count().collect())
    before, table = 0, []
    for number, count in counts:
        table.append((number, before))
        before += count
    offsets = spark.createDataFrame(table, "task long, before long")
    position = F.col("before") + F.col("mid").bitwiseAND(F.lit(_POSITION))
    number = F.floor(F.col("position") / block)
    blocks = (
        placed.withColumn("task", task)
        .join(F.broadcast(offsets), "task")
        .withColumn("position", position)
        .select("pass", "dim", "key", "position", "id", F.explode(F.array(number, number - 1)).alias("block"))
    )
    return cut_lineage(
        blocks.join(active.select("id", "vec"), "id")
        .groupBy("block")
        .applyInArrow(
            _window_links(threshold, max(0, before - 1) // block, block),
            "a long, b long, pass int, bits int",
        ),
        "round",
    )


def _between(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The links whose ends are in different components."""
    ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    return (
        links.join(ra, "a", "left")
        .join(rb, "b", "left")
        .where(F.coalesce("ra", "a") != F.coalesce("rb", "b"))
        .select("a", "b")
    )


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    passes: int = 12,
    block: int = 256,
    part: int = 512,
    seed: int = 20,
    miss: float = 1e-3,
    idle_rounds: int = 3,
) -> DataFrame:
    """One row per vector row: the id, ``n_links``, ``component_id`` and ``kept``.

    ``passes`` and ``block`` set the size of a round, ``miss`` when a vector needs no further one.
    ``idle_rounds`` rounds in a row that join nothing end the search for the rest.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vec"))
    usable = (
        "id is not null and vec is not null and size(vec) > 0"
        " and not exists(vec, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
        " and exists(vec, x -> x <> 0)"
    )
    good = rows.where(usable)
    classes = cut_lineage(
        good.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vectors"
    )
    agree = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    active, turn, idle = classes.select("id", "vec", F.lit(0.0).alias("missed")), 0, 0
    roots = None
    while True:
        found = _one_round(active, threshold, passes, block, seed, turn)
        links = found.where("b is not null").select("a", "b")
        if roots is None:
            roots = components(links)
        else:
            fresh = cut_lineage(_between(links, roots), "fresh")
            idle = idle + 1 if fresh.isEmpty() else 0
            if idle == idle_rounds:
                break
            if not idle:
                roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(fresh))
        # Beyond the reach of both sides all rows that share one bit more are met.
        bits = found.where("b is null").groupBy("a", "pass").agg((F.max("bits") + 1).alias("bits"))
        met = F.when(F.col("bits") <= 64, F.pow(F.lit(agree), F.col("bits"))).otherwise(0.0)
        # A pass that meets everything leaves nothing to miss.
        logs = bits.groupBy("a").agg(F.sum(F.log(F.greatest(1 - met, F.lit(1e-300)))).alias("log"))
        active = cut_lineage(
            active.join(logs, F.col("id") == F.col("a"))
            .select("id", "vec", (F.col("missed") + F.col("log")).alias("missed"))
            .where(F.col("missed") > math.log(miss)),
            "active",
        )
        turn += 1
        if active.isEmpty():
            break
    members = classes.join(roots, F.col("id") == F.col("node")).select("id", "vec", "copies", "root")
    parts = members.groupBy("root").agg(F.ceil(F.count("*") / part).alias("parts"))
    own = F.pmod(F.xxhash64("id"), "parts")
    units = (
        members.join(parts, "root")
        .withColumn("part", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select(
            "root",
            "id",
            "vec",
            "copies",
            "part",
            F.least("part", "other").alias("p"),
            F.greatest("part", "other").alias("q"),
        )
        # Without this the parts of a component stay where the join on its root put them.
        .repartition("root", "p", "q")
    )
    counted = (
        units.groupBy("root", "p", "q")
        .applyInArrow(_count_links(threshold), "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
    )
    named = (
        classes.join(counted, "id", "left")
        .join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
        .select(
            "vec",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
        )
    )
    out = rows.withColumn("ok", F.expr(usable)).join(named, "vec", "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("ok"), F.col("n_links")).otherwise(0).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
