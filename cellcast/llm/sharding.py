"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``replicas`` virtual nodes on a ring of 64-bit positions.  A row
goes clockwise from the hash of its key to the next virtual node; a shard takes
rows up to its bound, and what overflows goes on clockwise to the next shard
that still has room.  Bounds sum to the whole load, so balance is guaranteed
whatever the keys: a key that holds a third of all rows fills its shard and runs
over into the following ones.  With one shard more, rows move into the new shard
and, besides those, only some that overflow.

All rows go round by round.  In a round each open shard takes its waiting rows in
the order of a hash of key, size and text, then of the row's number; a shard that
reaches its bound closes, and the rest wait for the next round, which has fewer
shards.  What a shard takes is an order-statistic, found by a radix search: sums
by the leading digit of the order, then only the digit in which the bound falls
is looked at again.  A round is thus an aggregate over short rows, never a sort;
the driver sees one line per shard.  Where a row goes is then one lookup by its
virtual node.

``law='rows'``: every row weighs one; bounds differ by at most one and so do the
counts.  ``law='bytes'``: a row weighs its size; a shard closes with the row that
reaches its bound, so it exceeds it by less than one row.

Null text has no bytes (size 1).  A null key has a position like any other.
Repeated rows are placed one by one.  An empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellcast.session import cut_lineage

#: Bits of the order read at once, and rows that need no further digit.
_DIGIT = 12
_FEW = 50_000
#: Rows that one window numbers, about.
_CELL_ROWS = 20_000


def ring(shards: int, replicas: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, by position; a shard's nodes do not depend on the others."""

    def position(shard: int, copy: int) -> int:
        digest = hashlib.blake2b(f"shard {shard} copy {copy}".encode(), digest_size=8).digest()
        return int.from_bytes(digest, "big", signed=True)

    return sorted((position(s, c), s) for s in range(shards) for c in range(replicas))


def next_open(nodes: list[tuple[int, int]], closed: set[int]) -> list[int]:
    """For each virtual node, the first shard at or clockwise after it that is open."""
    out = [-1] * len(nodes)
    seen = -1
    for i in [*range(len(nodes)), *range(len(nodes))][::-1]:
        if nodes[i][1] not in closed:
            seen = nodes[i][1]
        out[i] = seen
    return out


def _home(rows: DataFrame, nodes: list[tuple[int, int]]) -> DataFrame:
    """Add ``node``, the number of the first virtual node at or after ``position``.

    The ring is cut into equal cells, each with its few virtual nodes; the table
    of cells has twice as many rows as there are nodes, at most.
    """
    bits = max(4, (len(nodes)).bit_length())
    cells = [[] for _ in range(1 << bits)]
    for at, _ in nodes:
        cells[(at >> (64 - bits)) + (1 << (bits - 1))].append(at)
    data, before = [], 0
    for cell, inside in enumerate(cells):
        data.append((cell - (1 << (bits - 1)), before, inside))
        before += len(inside)
    table = rows.sparkSession.createDataFrame(data, "cell long, before long, inside array<long>")
    joined = rows.withColumn("cell", F.shiftright("position", 64 - bits)).join(F.broadcast(table), "cell")
    passed = F.size(F.filter("inside", lambda p: p < F.col("position")))
    node = (F.col("before") + passed) % len(nodes)
    return joined.withColumn("node", node.cast("int")).drop("cell", "before", "inside", "position")


def _lookup(spark: SparkSession, rounds: list[list[int]], cuts: list[dict[int, tuple[int, int]]]) -> DataFrame:
    """(node, way): per round the shard a virtual node leads to and the last place it takes."""
    last = (1 << 63) - 1
    data = []
    for node in range(len(rounds[0])):
        way = [(shards[node], *cut.get(shards[node], (last, last))) for shards, cut in zip(rounds, cuts)]
        data.append((node, way))
    return spark.createDataFrame(data, "node int, way array<struct<shard:int, order:long, row:long>>")


def _waiting(rows: DataFrame, rounds: list[list[int]], cuts: list[dict[int, tuple[int, int]]]) -> DataFrame:
    """Rows that no earlier round has taken, with the shard they now ask for."""
    table = _lookup(rows.sparkSession, rounds, [*cuts, {}])
    joined = rows.join(F.broadcast(table), "node")
    return joined.select(*rows.columns, _taken("way").alias("spot")).where(
        F.col("spot.round") == len(rounds) - 1
    ).select(*rows.columns, F.col("spot.shard").alias("shard"))


def _taken(way: str):
    """(round, shard) of the first round that takes the row."""

    def fits(w):
        return (F.col("order") < w["order"]) | ((F.col("order") == w["order"]) & (F.col("row") <= w["row"]))

    numbered = F.transform(way, lambda w, i: F.struct(i.alias("round"), w["shard"].alias("shard"), fits(w).alias("ok")))
    return F.get(F.filter(numbered, lambda w: w["ok"]), 0)


def _cuts(waiting: DataFrame, room: dict[int, int]) -> tuple[dict[int, tuple[int, int]], dict[int, int]]:
    """The last (order, row) that each overfull shard takes, and the weight every shard is offered.

    ``order`` and ``row`` are read as one string of 128 bits, a digit at a time.
    """
    offered = {r.shard: int(r.weight) for r in waiting.groupBy("shard").agg(F.sum("weight").alias("weight")).collect()}
    full = {s: room[s] for s, w in offered.items() if w > room[s]}
    cuts: dict[int, tuple[int, int]] = {}
    # shard: (weight still to take, orders from, orders to, rows from, rows to), ends included
    least, most = -(1 << 63), (1 << 63) - 1
    search = {s: (left, least, most, 0, most) for s, left in full.items()}
    while search:
        state = waiting.sparkSession.createDataFrame(
            [(s, *v) for s, v in search.items()], "shard int, take long, o1 long, o2 long, r1 long, r2 long"
        )
        near = waiting.join(F.broadcast(state), "shard").where(
            F.col("order").between(F.col("o1"), F.col("o2")) & F.col("row").between(F.col("r1"), F.col("r2"))
        )
        # Widths of digits are powers of two, so cells nest.
        on_row = F.col("o1") == F.col("o2")
        width = {}
        for s, (_, o1, o2, r1, r2) in search.items():
            span = (r2 - r1 if o1 == o2 else o2 - o1) + 1
            width[s] = max(0, span.bit_length() - 1 - _DIGIT)
        shift = F.lit(0)
        for s, bits in width.items():
            shift = F.when(F.col("shard") == s, F.lit(bits)).otherwise(shift)
        value = F.when(on_row, F.col("row")).otherwise(F.col("order"))
        cells = (
            near.groupBy("shard", "take", F.call_function("shiftright", value, shift).alias("cell"))
            .agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
        )
        upto = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("before", F.coalesce(F.sum("weight").over(upto), F.lit(0)))
        hit = cells.where("before < take").groupBy("shard").agg(
            F.max(F.struct("cell", "before", "weight", "n")).alias("hit")
        )
        few: dict[int, tuple[int, int, int, int, int]] = {}
        for r in hit.collect():
            take, o1, o2, r1, r2 = search.pop(r.shard)
            bits, left = width[r.shard], take - int(r.hit.before)
            start = r.hit.cell << bits
            if o1 == o2:
                bounds = (left, o1, o2, start, start + (1 << bits) - 1)
            else:
                bounds = (left, start, start + (1 << bits) - 1, r1, r2)
            if r.hit.n <= _FEW or bits == 0 and o1 == o2:
                few[r.shard] = bounds
            else:
                search[r.shard] = bounds
        if few:
            state = waiting.sparkSession.createDataFrame(
                [(s, *v) for s, v in few.items()], "shard int, take long, o1 long, o2 long, r1 long, r2 long"
            )
            near = waiting.join(F.broadcast(state), "shard").where(
                F.col("order").between(F.col("o1"), F.col("o2")) & F.col("row").between(F.col("r1"), F.col("r2"))
            )
            upto = Window.partitionBy("shard").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, -1)
            near = near.withColumn("before", F.coalesce(F.sum("weight").over(upto), F.lit(0)))
            last = near.where("before < take").groupBy("shard").agg(F.max(F.struct("order", "row")).alias("cut"))
            cuts |= {r.shard: (r.cut.order, r.cut.row) for r in last.collect()}
    return cuts, offered


def shard_documents(
    documents: DataFrame,
    shards: int = 8,
    law: str = "rows",
    replicas: int = 256,
    slack: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: the id, ``size`` (bytes of the text plus one), ``text_crc32``, ``shard`` and
    ``slot`` (its number in the shard, without gaps).

    ``slack`` raises every bound by that share of the mean load: fewer rows
    overflow, and balance is looser.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law {law!r} is neither 'rows' nor 'bytes'")
    spark = documents.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(
        F.col(id_col).alias("key"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    nodes = ring(shards, replicas)
    rows = rows.withColumn("order", F.xxhash64("key", "size", "text_crc32", F.lit(1)))
    rows = _home(rows.withColumn("position", F.xxhash64("key")), nodes)
    weight = F.col("size") if law == "bytes" else F.lit(1).cast("bigint")
    # Written once: numbers of rows stay, and no later job reads a text.
    rows = cut_lineage(rows.withColumn("weight", weight), "shard-rows")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("weight"), F.lit(0))).first()

    extra = int(slack * int(total) / shards)
    room = {s: int(total) // shards + (s < int(total) % shards) + extra for s in range(shards)}
    closed = {s for s in room if room[s] <= 0}
    rounds, cuts = [], []
    while n and len(closed) < shards:
        rounds.append(next_open(nodes, closed))
        cut, offered = _cuts(_waiting(rows, rounds, cuts), room)
        cuts.append(cut)
        if not cut:
            break
        for s, weight_offered in offered.items():
            room[s] -= weight_offered
        closed |= {s for s in room if room[s] <= 0}
    if not rounds:
        rounds, cuts = [next_open(nodes, set())], [{}]
    placed = rows.join(F.broadcast(_lookup(spark, rounds, cuts)), "node").select(
        "key", "size", "text_crc32", "row", _taken("way")["shard"].alias("shard")
    )
    placed = cut_lineage(placed, "shard-placed")

    cells = max(1, n // (_CELL_ROWS * shards))
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells)))
    sums = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("row"))
    out = placed.withColumn("number", number).join(sums, ["shard", "cell"])
    return out.select(
        F.col("key").alias(id_col), "size", "text_crc32", "shard", (F.col("before") + F.col("number") - 1).alias("slot")
    )
