"""Prefix trie of conversations by fixed-length block hashing.

A node of the trie is a distinct sequence of first turns.  Conversations are cut
into blocks of ``block`` turns and grouped by successive block digests first:
two conversations share a block node when they agree up to that block's end.
Turn boundaries are refined only inside blocks where siblings diverge, and only
for one conversation of each block node; a block that all siblings share is
laid out turn by turn without another digest.

A digest is a sum of position-keyed 128-bit turn hashes, kept as four sums of 32
bits.  Sums need no order inside a block and no walk along a conversation: the
digest before a block is a running sum over blocks, taken in two levels, so a
conversation that holds a third of all rows is spread over many tasks.  Turns
are numbered by one range sort, which splits such a conversation too.

Totals over subtrees need no walk up the trie either.  Every node is charged to
its smallest member; a subtree's total is the sum, over the members of its top,
of what they are charged at its depth and below.

Null role or text counts as empty.  Rows are ordered by turn (null first); rows
of a conversation that share a turn number follow by role, then by a fixed hash
of their text.  A row without a conversation id belongs to no conversation and
makes no node.  An empty table has no nodes.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellcast.session import cut_lineage, ship_package, shuffle_partitions

#: Blanks and the control characters tab to carriage return part words.
WORD = r"[^\x20\x09-\x0D]+"

_LOW = ["p1", "p2", "p3", "p4"]  # digest before a block
_SUM = ["x1", "x2", "x3", "x4"]  # digest of a turn or a block
_KEY = ["k1", "k2", "k3", "k4"]  # digest that names a node
#: Blocks whose running sums one window holds.
_FAN = 1024
#: Conversation ids in one string before they are hashed.
_IDS = 4096


def ordered_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, pos, d1, d2, words): each row's place in its conversation, its digest and word count."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.xxhash64(role, text).alias("d1"),
        F.xxhash64(text, F.lit(1), role).alias("d2"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("salt"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "d1", "d2", "salt"]
    parts = shuffle_partitions(conversations.sparkSession)
    turns = turns.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    turns = cut_lineage(turns.select("conv", "d1", "d2", "words", at.alias("at")), "turns")
    turns = turns.withColumn("part", F.shiftright("at", 33))
    spans = turns.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    pos = F.col("before") + F.col("at") - F.col("first")
    return turns.join(spans.drop("n"), ["conv", "part"]).select("conv", pos.alias("pos"), "d1", "d2", "words")


def _running(df: DataFrame, columns: list[str], after: bool) -> DataFrame:
    """Sums of ``columns`` over the blocks of a conversation before (or after) each block, as ``r_*``."""
    order = F.col("b").desc() if after else F.col("b").asc()
    df = df.withColumn("far", F.floor(F.col("b") / _FAN))
    near = Window.partitionBy("conv", "far").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    far_order = F.col("far").desc() if after else F.col("far").asc()
    outer = Window.partitionBy("conv").orderBy(far_order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("conv", "far").agg(*[F.sum(c).alias(f"t_{c}") for c in columns])
    totals = totals.select(
        "conv", "far", *[F.coalesce(F.sum(f"t_{c}").over(outer), F.lit(0)).alias(f"f_{c}") for c in columns]
    )
    inner = df.select(
        "*", *[F.coalesce(F.sum(c).over(near), F.lit(0)).alias(f"n_{c}") for c in columns]
    )
    both = inner.join(totals, ["conv", "far"])
    sums = [(F.col(f"n_{c}") + F.col(f"f_{c}")).alias(f"r_{c}") for c in columns]
    return both.select(*[c for c in df.columns if c != "far"], *sums)


def _chunk_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv) rows to strings of at most ``_IDS`` ids of one node."""
    node, first, ids = None, None, []
    names = ["depth", *_KEY, "first", "ids"]

    def flush(out):
        if ids:
            out.append((*node, first, ",".join(ids)))

    def made(out):
        columns = list(zip(*out)) if out else [()] * 7
        types = [pa.int64()] * 6 + [pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("depth", *_KEY, "conv")]
        for *key, conv in zip(*columns):
            if tuple(key) != node or len(ids) >= _IDS:
                flush(out)
                node, first, ids = tuple(key), conv, []
            ids.append(str(conv))
        yield made(out)
    out = []
    flush(out)
    yield made(out)


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted strings of ids to one digest per node; only the running hash is kept."""
    node, sha = None, None
    names = ["depth", *_KEY, "ends_sha256"]
    types = [pa.int64()] * 5 + [pa.string()]

    def made(out):
        columns = list(zip(*out)) if out else [()] * 6
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("depth", *_KEY, "ids")]
        for *key, ids in zip(*columns):
            if tuple(key) != node:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = tuple(key), hashlib.sha256(ids.encode())
            else:
                sha.update(f",{ids}".encode())
        yield made(out)
    yield made([(*node, sha.hexdigest())] if node is not None else [])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the sorted conversation ids that end at each node.

    A range sort over (node, id) joins ids to strings in parallel; the strings of
    a node are then hashed in order, one at a time.
    """
    spark = ends.sparkSession
    ship_package(spark)
    parts = shuffle_partitions(spark)
    node = ["depth", *_KEY]
    keys = ", ".join(f"{c} long" for c in node)
    strings = (
        ends.repartitionByRange(parts, *node, "conv")
        .sortWithinPartitions(*node, "conv")
        .mapInArrow(_chunk_ids, f"{keys}, first long, ids string")
    )
    return (
        strings.repartition(parts, *node)
        .sortWithinPartitions(*node, "first")
        .mapInArrow(_hash_ids, f"{keys}, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, conversations: DataFrame, block: int = 8) -> DataFrame:
    """One row per node of the trie over ``turns`` (conv, pos, d1, d2, words).

    ``conversations`` (conv) holds every conversation once, those without a turn
    too.  Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    one, two = F.xxhash64("pos", "d1", "d2"), F.xxhash64("d2", F.lit(7), "pos", "d1")
    low = F.lit(0xFFFFFFFF)
    parts = [F.shiftrightunsigned(one, 32), one.bitwiseAND(low), F.shiftrightunsigned(two, 32), two.bitwiseAND(low)]
    b = F.floor(F.col("pos") / block)
    turns = cut_lineage(
        turns.select("conv", "pos", b.alias("b"), "words", *[p.alias(x) for p, x in zip(parts, _SUM)]), "trie-turns"
    )

    # Successive block digests of every conversation.
    blocks = turns.groupBy("conv", "b").agg(F.count("*").alias("n"), *[F.sum(x).alias(x) for x in _SUM])
    blocks = _running(blocks, _SUM, after=False)
    blocks = blocks.select(
        "conv",
        "b",
        "n",
        *[F.col(f"r_{x}").alias(p) for x, p in zip(_SUM, _LOW)],
        *[(F.col(f"r_{x}") + F.col(x)).alias(k) for x, k in zip(_SUM, _KEY)],
    )
    blocks = cut_lineage(blocks, "trie-blocks")
    groups = blocks.groupBy("b", "n", *_LOW, *_KEY).agg(F.count("*").alias("members"), F.min("conv").alias("rep"))
    groups = cut_lineage(groups, "trie-groups")

    # Blocks with one sibling only need no turn digests.  The first block has the
    # root above it, which is taken as diverging without a look.
    siblings = groups.where("b > 0").groupBy("b", *_LOW).agg(F.count("*").alias("siblings"))
    later = groups.where("b > 0").join(siblings, ["b", *_LOW])
    first = groups.where("b = 0").withColumn("siblings", F.lit(2).cast("bigint"))
    marked = first.unionByName(later)
    inside = Window.partitionBy("rep", "b").orderBy("pos")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    laid = marked.join(turns.withColumnRenamed("conv", "rep"), ["rep", "b"])
    laid = laid.select(
        "rep",
        "b",
        "members",
        "words",
        (F.col("pos") + 1).alias("depth"),
        "pos",
        *_LOW,
        *[
            F.when(F.col("siblings") > 1, F.col(p) + F.sum(x).over(so_far)).otherwise(F.col(k)).alias(k)
            for p, x, k in zip(_LOW, _SUM, _KEY)
        ],
        F.struct(*_KEY).alias("end"),
    )
    above = [F.coalesce(F.lag(k).over(inside), F.col(p)).alias(f"up_{k}") for k, p in zip(_KEY, _LOW)]
    laid = cut_lineage(laid.select("rep", "b", "pos", "depth", "members", "words", *_KEY, "end", *above), "trie-laid")

    node = ["depth", *_KEY]
    up = [f"up_{k}" for k in _KEY]
    nodes = laid.groupBy(*node).agg(
        F.sum("members").alias("n_convs"),
        F.min("rep").alias("conv_id"),
        F.max("words").alias("words"),
        *[F.min(u).alias(u) for u in up],
    )
    nodes = cut_lineage(nodes, "trie-nodes")
    below = (
        nodes.where("depth > 1")
        .groupBy((F.col("depth") - 1).alias("depth"), *[F.col(u).alias(k) for u, k in zip(up, _KEY)])
        .agg(F.count("*").alias("n_children"))
    )
    nodes = nodes.join(below, node, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("bigint"))
    nodes = cut_lineage(nodes, "trie-nodes")

    # Each node is charged to its smallest member, at its depth.
    charged = nodes.select(F.col("conv_id").alias("rep"), "depth", "saved", "leaf")
    per_block = charged.groupBy(
        F.col("rep").alias("conv"), F.floor((F.col("depth") - 1) / block).alias("b")
    ).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    later = blocks.join(per_block, ["conv", "b"], "left").na.fill(0, ["saved", "leaf"])
    later = _running(later, ["saved", "leaf"], after=True)
    later = later.groupBy("b", F.struct(*_KEY).alias("end")).agg(
        F.sum("r_saved").alias("later_saved"), F.sum("r_leaf").alias("later_leaf")
    )
    down = inside.orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, 0)
    own = laid.join(charged, ["rep", "depth"], "left").na.fill(0, ["saved", "leaf"])
    own = own.select(
        *node, "b", "end", F.sum("saved").over(down).alias("s"), F.sum("leaf").over(down).alias("l")
    ).join(later, ["b", "end"])
    totals = own.groupBy(*node).agg(
        F.sum(F.col("s") + F.col("later_saved")).alias("saved_tokens"),
        F.sum(F.col("l") + F.col("later_leaf")).alias("n_leaves"),
    )

    ends = blocks.groupBy("conv").agg(F.max(F.struct("b", "n", *_KEY)).alias("last"))
    ends = ends.select("conv", (F.col("last.b") * block + F.col("last.n")).alias("depth"), "last.*").select("conv", *node)
    turnless = conversations.select("conv").join(blocks.where("b = 0").select("conv"), "conv", "left_anti")
    ends = ends.unionByName(turnless.select("conv", *[F.lit(0).cast("bigint").alias(c) for c in node]))
    digests = cut_lineage(end_digests(ends), "trie-ends")

    whole = nodes.agg(
        F.sum((F.col("depth") == 1).cast("bigint")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    members = conversations.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    # One row each: the root's members and the totals over all nodes.
    top = members.select("*", *[F.lit(0).cast("bigint").alias(c) for c in node]).join(
        whole.withColumn("depth", F.lit(0).cast("bigint")), "depth"
    )
    empty = hashlib.sha256(b"").hexdigest()
    root = top.select(
        "conv_id",
        *node,
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        *[F.col(k).alias(u) for k, u in zip(_KEY, up)],
        F.col("conv_id").alias("parent_conv_id"),
    )
    # Nodes of depth one hang below the root, whose smallest member is one value.
    smallest = members.select("conv_id").scalar()
    placed = nodes.where("depth = 1").withColumn("parent_conv_id", smallest).unionByName(
        nodes.where("depth > 1").join(parents, ["depth", *up])
    )
    placed = placed.join(totals, node).select(
        "conv_id", *node, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"
    )
    out = root.unionByName(placed).join(digests, node, "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


def share_heads(turns: DataFrame, span: int = 20, kinds: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) rebuilt so that neighbours share a beginning.

    Conversation c starts with the first h turns of conversation ``c - c % span``
    and goes on with its own turns after its first h, with h the CRC-32 of c's
    digits modulo ``kinds``.
    """
    convs = turns.groupBy("conv").agg(F.count("*").alias("len"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % kinds
    convs = convs.select("conv", "len", h.alias("h"), (F.col("conv") - F.col("conv") % span).alias("base"))
    lengths = convs.select(F.col("conv").alias("base"), F.col("len").alias("base_len"))
    convs = convs.join(lengths, "base", "left")
    convs = convs.withColumn("head", F.least("h", F.coalesce("base_len", F.lit(0))))
    convs = cut_lineage(convs, "trie-convs")
    own = turns.join(convs.select("conv", "h", "head"), "conv").where("pos >= h")
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("head"))
    heads = turns.where(F.col("pos") < kinds - 1).withColumnRenamed("conv", "base")
    lent = heads.join(convs.select("conv", "base", "head"), "base").where("pos < head")
    columns = ["conv", "pos", "d1", "d2", "words"]
    return own.select(columns).unionByName(lent.select(columns)), convs.select("conv")
