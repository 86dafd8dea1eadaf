"""Line dedup: exact repeats and lines within one word edit go, the earliest stays.

A line is what stands between line feeds; its words are what stands between
blanks.  Two lines are near when their word sequences differ by at most one
inserted, deleted or replaced word; lines of fewer than ``min_words`` words are
only compared exactly, and a line without words is never dropped.  An
occurrence is dropped when an equal line, or a near one, occurs earlier (by
document id, then line number).  The earlier line counts whether it is kept
itself or not, so the result does not depend on the order of work.

The join is a deletion neighbourhood.  Every line emits, as hashes, itself and
its variants with one word deleted:

* equal variants with the word deleted at the same place are one replacement
  apart;
* a variant equal to another line is one insertion apart.

Candidates are verified on their words.  In a group of equal variants each line
only meets the earliest one, so a group of any size costs one row per line.

An edit in one half of a line leaves the other half as it is.  Lines that share
no half with a different line therefore cannot be near any, and only the others
emit variants.

Null text stays null and has no lines.  Rows that repeat an id and a text get
the same decision; rows that share an id but not the text are told apart by a
hash of both.  Null ids order before all others.  All columns of the input are
returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm import words as W
from cellcast.llm.bitmap import explode_hits, filter_rows, key_bitmap
from cellcast.session import cut_lineage, ship_package

#: Text bytes whose lines are held at once: about 30 bytes of working memory for each.
_SLICE = 1 << 20
_K1 = 0x9E3779B97F4A7C15
_K2 = 0xC2B2AE3D27D4EB4F


class _Lines:
    """Lines with words of a batch: owner, number, word range and prefix sums of word hashes."""

    def __init__(self, batch: pa.RecordBatch, column: str):
        buf, offsets = W.text_buffer(batch.column(column), lower=False)
        words = W.Words(buf, offsets, W.NON_SPACE)
        feeds = np.flatnonzero(buf == 10)
        before = np.searchsorted(feeds, offsets)
        doc = words.docs()
        number = np.searchsorted(feeds, words.starts) - before[:-1][doc]
        head = np.ones(len(words), bool)
        head[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
        self.start = np.flatnonzero(head)
        self.end = np.append(self.start[1:], len(words))
        self.n = self.end - self.start
        self.doc, self.number = doc[head], number[head]
        self.words = words
        at = np.arange(len(words)) - np.repeat(self.start, self.n)
        most = int(self.n.max()) if len(self.n) else 0
        h = words.hashes()
        self.sums, self.down = [], []
        for k in (_K1, _K2):
            up = np.full(most + 1, k, np.uint64)
            up[0] = 1
            up = np.cumprod(up, dtype=np.uint64)
            inv = np.full(most + 1, pow(k, -1, 1 << 64), np.uint64)
            inv[0] = 1
            self.down.append(np.cumprod(inv, dtype=np.uint64))
            total = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(h * up[at] if len(h) else h, out=total[1:])
            self.sums.append(total)

    def key(self, which: int) -> np.ndarray:
        total = self.sums[which]
        return W.mix(total[self.end] - total[self.start] + self.n.astype(np.uint64))

    def halves(self, least: int) -> list[list[int]]:
        """Hashes of the first and last half (for both roundings) of lines that may be near others."""
        total, down = self.sums[0], self.down[0]
        cols = []
        for size in (self.n // 2, (self.n - 1) // 2):
            tag = W.mix(size.astype(np.uint64) + np.uint64(1))
            cols.append(W.combine(total[self.start + size] - total[self.start], tag))
            tail = (total[self.end] - total[self.end - size]) * down[self.n - size]
            cols.append(W.combine(tail, tag + np.uint64(7)))
        table = np.stack(cols, axis=1).view(np.int64) if len(self.n) else np.zeros((0, 4), np.int64)
        even = self.n % 2 == 0
        return [
            [] if n < least else (row if e else row[:2])
            for n, e, row in zip(self.n.tolist(), even.tolist(), table.tolist())
        ]

    def variants(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own key, keys of the variants with one word deleted, the same with the word's place)."""
        total, inv = self.sums[0], np.uint64(pow(_K1, -1, 1 << 64))
        line = np.repeat(np.arange(len(self.n)), self.n)
        word = np.arange(len(line))
        left = total[word] - total[self.start[line]]
        right = (total[self.end[line]] - total[word + 1]) * inv
        keys = W.mix(left + right + (self.n[line] - 1).astype(np.uint64))
        place = word - self.start[line]
        return self.key(0), keys, W.combine(keys, place.astype(np.uint64))


_LINE = "id long, row long, line int, h long, h2 long, halves array<long>"


def _list_lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, "text", _SLICE):
                x = _Lines(batch, "text")
                pick = pa.array(x.doc)
                yield pa.record_batch(
                    {
                        "id": batch.column("id").take(pick),
                        "row": batch.column("row").take(pick),
                        "line": pa.array(x.number, pa.int32()),
                        "h": pa.array(x.key(0).view(np.int64)),
                        "h2": pa.array(x.key(1).view(np.int64)),
                        "halves": pa.array(x.halves(least), pa.list_(pa.int64())),
                    }
                )

    return run


_NEAR = (
    "id long, row long, line int, h long, h2 long, own long, variants array<long>, "
    "placed array<long>, text string"
)


def _line_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines of each document, with their variant keys."""
    for whole in batches:
        for batch in W.slices(whole, "text", _SLICE):
            x = _Lines(batch, "text")
            own, keys, placed = x.variants()
            h, h2 = x.key(0).view(np.int64), x.key(1).view(np.int64)
            wanted = batch.column("lines")
            out: list[list] = [[] for _ in range(9)]
            by_doc = np.searchsorted(x.doc, np.arange(batch.num_rows + 1))
            for d in range(batch.num_rows):
                want = set(wanted[d].as_py())
                for i in range(by_doc[d], by_doc[d + 1]):
                    if int(x.number[i]) in want:
                        a, b = x.start[i], x.end[i]
                        text = x.words.buf[x.words.starts[a] : x.words.ends[b - 1]].tobytes()
                        row = (
                            batch.column("id")[d].as_py(),
                            batch.column("row")[d].as_py(),
                            int(x.number[i]),
                            int(h[i]),
                            int(h2[i]),
                            int(own[i].view(np.int64)),
                            keys[a:b].view(np.int64),
                            placed[a:b].view(np.int64),
                            text.decode("utf-8", "replace"),
                        )
                        for col, v in zip(out, row):
                            col.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [
                    *[pa.array(c, t) for c, t in zip(out, types)],
                    pa.array(out[6], pa.list_(pa.int64())),
                    pa.array(out[7], pa.list_(pa.int64())),
                    pa.array(out[8], pa.string()),
                ],
                names=["id", "row", "line", "h", "h2", "own", "variants", "placed", "text"],
            )


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether two word sequences are at most one insertion, deletion or replacement apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    p, short = 0, min(len(a), len(b))
    while p < short and a[p] == b[p]:
        p += 1
    s = 0
    while s < short - p and a[-1 - s] == b[-1 - s]:
        s += 1
    return max(len(a), len(b)) - p - s <= 1


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [
            within_one(a.as_py().encode().split(), b.as_py().encode().split())
            for a, b in zip(batch.column("text"), batch.column("other"))
        ]
        yield batch.filter(pa.array(keep, pa.bool_())).select(["h", "h2"])


def _several(hashes: DataFrame, column: str) -> DataFrame:
    """Values of an array column that rows with different ``h`` have (for a bitmap and an exact join)."""
    return cut_lineage(
        hashes.select("h", F.explode(column).alias("key"))
        .groupBy("key")
        .agg(F.min("h").alias("least"), F.max("h").alias("most"))
        .where("least <> most")
        .select("key"),
        "several",
    )


def find_repeats(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """One row per line to drop: (id, row, line, exact, near); ``exact``: an equal line is
    earlier; ``near``: a near one is.  ``docs``: id, row, text."""
    lines = cut_lineage(docs.mapInArrow(_list_lines(min_words), _LINE), "lines")
    place = F.struct("id", "row", "line")
    firsts = cut_lineage(
        lines.groupBy("h", "h2").agg(F.min(place).alias("first"), F.count("*").alias("times")),
        "firsts",
    )
    common = _several(lines, "halves")
    some = (
        explode_hits(lines, "halves", key_bitmap(common, "key"), ["h", "h2"])
        .distinct()
        .join(common, "key")
        .select("h", "h2")
        .distinct()
    )
    wanted = cut_lineage(
        some.join(firsts, ["h", "h2"])
        .groupBy(F.col("first.id").alias("wid"), F.col("first.row").alias("wrow"))
        .agg(F.collect_set("first.line").alias("lines")),
        "wanted",
    )
    # A broadcast would chain the filter and the variants in one task, which then holds two Python
    # workers; they stay for as long as an executor is busy.
    near = cut_lineage(
        filter_rows(docs, "row", key_bitmap(wanted, "wrow"))
        .join(wanted.hint("merge"), (F.col("row") == F.col("wrow")) & F.col("id").eqNullSafe(F.col("wid")))
        .select("id", "row", "text", "lines")
        .mapInArrow(_line_variants, _NEAR)
        .dropDuplicates(["h", "h2"]),
        "variants",
    )
    line = ["id", "row", "line", "h", "h2"]
    order = F.struct(*line)
    replaced = explode_hits(near, "placed", key_bitmap(_several(near, "placed"), "key"), line)
    replaced = replaced.select("key", order.alias("at"))
    earliest = replaced.groupBy("key").agg(F.min("at").alias("first"))
    replaced = (
        replaced.join(earliest, "key")
        .where("at <> first")
        .select(F.col("at").alias("later"), F.col("first").alias("earlier"))
    )
    whole = near.select(F.col("own").alias("key"), order.alias("other"))
    inserted = (
        explode_hits(near, "variants", key_bitmap(whole, "key"), line)
        .select("key", order.alias("at"))
        .join(whole, "key")
        .select(F.greatest("at", "other").alias("later"), F.least("at", "other").alias("earlier"))
    )
    links = replaced.unionAll(inserted).distinct()
    words = near.select("h", "h2", "text")
    other = near.select(
        F.col("h").alias("eh"), F.col("h2").alias("eh2"), F.col("text").alias("other")
    )
    repeats = (
        links.select(
            F.col("later.h").alias("h"),
            F.col("later.h2").alias("h2"),
            F.col("earlier.h").alias("eh"),
            F.col("earlier.h2").alias("eh2"),
        )
        .join(words, ["h", "h2"])
        .join(other, ["eh", "eh2"])
        .select("h", "h2", "text", "other")
        .mapInArrow(_confirm, "h long, h2 long")
        .distinct()
        .withColumn("near", F.lit(True))
    )
    known = cut_lineage(
        firsts.join(repeats, ["h", "h2"], "left")
        .where("times > 1 or near")
        .select("h", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")),
        "known",
    )
    return (
        filter_rows(lines.select(*line), "h", key_bitmap(known, "h"))
        .join(known, ["h", "h2"])
        .select("id", "row", "line", (place != F.col("first")).alias("exact"), "near")
        .where("exact or near")
    )


def dedup_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8
) -> tuple[DataFrame, DataFrame]:
    """(documents with the repeated lines taken out of the text, one summary row per document row).

    The summary holds the id, ``n_lines`` (with words or not), ``n_words_lines``
    (lines with words that stay), ``dropped`` (sorted line numbers from 0),
    ``n_exact`` and ``n_near``, and the new text.
    """
    ship_package(documents.sparkSession)
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    docs = documents.select(
        F.col(id_col).cast("bigint").alias("id"), row.alias("row"), F.col(text_col).alias("text")
    )
    found = find_repeats(docs, min_words)
    dropped = (
        found
        # Repeated rows list the same lines: once is enough.
        .groupBy("id", "row", "line")
        .agg(F.max("exact").alias("exact"), F.max("near").alias("near"))
        .groupBy(F.col("id").alias("__id"), F.col("row").alias("__row"))
        .agg(
            F.array_sort(F.collect_list("line")).alias("__dropped"),
            F.count_if("exact").alias("__n_exact"),
            F.count_if(F.expr("near and not exact")).alias("__n_near"),
        )
    )
    names = documents.columns
    parts = F.split(F.col(text_col), "\n", -1)
    joined = documents.withColumn("__key", row).join(
        dropped,
        (F.col("__key") == F.col("__row")) & F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")),
        "left",
    )
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__dropped")),
        lambda i: F.get(parts, i),
    )
    text = F.when(F.col("__dropped").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    joined = joined.withColumn("__text", text)
    cleaned = joined.select(*[F.col("__text").alias(c) if c == text_col else F.col(c) for c in names])
    summary = joined.select(
        F.col(id_col).alias(id_col),
        F.coalesce(F.size(parts), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce("__dropped", F.expr("cast(array() as array<int>)")).alias("dropped"),
        F.coalesce("__n_exact", F.lit(0)).alias("n_exact"),
        F.coalesce("__n_near", F.lit(0)).alias("n_near"),
        F.col("__text").alias("kept_text"),
    )
    return cleaned, summary


def digest(summary: DataFrame) -> DataFrame:
    """Counts, dropped line numbers and a fingerprint of the remaining text."""
    return summary.select(
        "doc_id",
        "n_lines",
        "n_exact",
        "n_near",
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"),
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )
