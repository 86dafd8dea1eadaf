"""Sequence packing: full windows first, best-fit decreasing for what is left.

A document's token ids end with a separator id.  Every full window of
``window`` ids is a sequence of its own; the remainder (shorter than a window)
is packed by best-fit decreasing: remainders go from long to short into the
open sequence with the least room that still fits, found in a segment tree
indexed by remaining capacity, or into a new sequence.

Tokenizing is one map over the documents; only a small row per piece
(never text) is shuffled, to groups of at most about ``group_rows`` pieces by a
hash, so a group's size does not depend on the data.  The padding
left by a group is that of its last sequences.

Null text counts as empty (the separator alone).  Repeated rows are packed as
documents of their own; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.session import ship_package


def default_vocabulary() -> tuple[str, str]:
    """(tokenizer json, the same vocabulary as byte ranks)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path(
        "byte_bpe_50k.tiktoken"
    )


class _Encoder:
    """Ids of the json tokenizer; plain texts through the faster rank encoder.

    Both hold the same vocabulary and merges.  A text that spells out a special
    token goes through the json tokenizer itself, which treats it by its rules.
    """

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.exact = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


_ENCODERS: dict[tuple[str, str], _Encoder] = {}


def _encoder(paths: tuple[str, str]) -> _Encoder:
    if paths not in _ENCODERS:
        _ENCODERS[paths] = _Encoder(*paths)
    return _ENCODERS[paths]


_PIECE = pa.schema(
    [
        ("id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("row", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def _cut(paths: tuple[str, str], window: int, separator: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(paths)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            ids_col, row_col, texts = batch.column("id"), batch.column("row"), batch.column("text")
            for i in range(batch.num_rows):
                ids = np.append(encode(texts[i].as_py() or ""), np.uint32(separator)).astype("<u4")
                doc, row, n = ids_col[i].as_py(), row_col[i].as_py(), len(ids)
                for a in range(0, n, window):
                    piece = ids[a : a + window]
                    out[0].append(doc)
                    out[1].append(a)
                    out[2].append(len(piece))
                    out[3].append(zlib.crc32(piece.tobytes()))
                    out[4].append(n)
                    out[5].append(row)
                    out[6].append(piece.astype(np.int32) if with_ids else None)
                if len(out[0]) >= 20_000:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, _PIECE)], _PIECE)
                    out = [[], [], [], [], [], [], []]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, _PIECE)], _PIECE)

    return run


class OpenWindows:
    """Open sequences by remaining room, with a segment tree over the capacities."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)  # open sequences below each node
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.stacks[room].append(sequence)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The open sequence with the least room that holds ``need``: (room, sequence)."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up to a filled right sibling
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:  # down to its leftmost capacity
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        self._change(room, -1)
        return room, self.stacks[room].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length; lengths must not increase."""
    tree = OpenWindows(window)
    sequence, offset, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        spot = tree.take(n)
        if spot is None:
            spot = (window, used)
            used += 1
        room, number = spot
        sequence[i], offset[i] = number, window - room
        if room > n:
            tree.add(room - n, number)
    return sequence, offset


def _pack_group(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(
            ["length", "id", "row", "ids_crc32"], ascending=[False, True, True, True]
        )
        number, offset = best_fit_decreasing(pdf["length"].to_numpy(), window)
        return pdf.assign(number=number, offset=offset)

    return run


def pack_documents(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 1024,
    separator: int = 0,
    group_rows: int = 20_000,
    vocabulary: tuple[str, str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and, with ``with_ids``, the piece's token ``ids``.

    A sequence id is the group number times 2^32 plus the sequence's number in
    its group.
    """
    spark = documents.sparkSession
    ship_package(spark)
    rows = documents.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    paths = vocabulary or default_vocabulary()
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, row long, ids array<int>"
    pieces = rows.mapInArrow(_cut(paths, window, separator, with_ids), schema)
    # A text has at most a piece per window of bytes, and one more.
    size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-(size[0] + size[1] // window) // group_rows))
    # Full windows and remainders part after one exchange: tokenizing runs once.
    pieces = pieces.withColumn("group", F.pmod(F.xxhash64("id", "row", "start"), F.lit(groups)))
    packed = pieces.groupBy("group").applyInPandas(
        _pack_all(window), f"{schema}, group long, number long, offset long"
    )
    sequence = F.shiftleft("group", 32) + F.col("number")
    out = packed.select(
        F.col("id").alias(id_col),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        sequence.alias("sequence_id"),
        "offset",
        *(["ids"] if with_ids else []),
    )
    return out


def _pack_all(window: int):
    pack = _pack_group(window)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        full = pdf["length"].to_numpy() == window
        rest = pack(pdf[~full])
        used = int(rest["number"].max()) + 1 if len(rest) else 0
        alone = pdf[full].sort_values(["id", "row", "start"])
        alone = alone.assign(number=np.arange(used, used + len(alone)), offset=0)
        return pd.concat([rest, alone], ignore_index=True)

    return run


def packed_sequences(pieces: DataFrame) -> DataFrame:
    """Token ids of each sequence, from pieces made ``with_ids`` (at most a window each)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
