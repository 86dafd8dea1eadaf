"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are all windows of ``window`` consecutive benchmark words (an item
with fewer words is one pattern).  Patterns of one length share a scanner:

* blocks of two words; the shift table tells how far a text position can jump
  because no pattern has its block nearer to its end (9 words for a block that
  is in no pattern of 10 words);
* a position whose shift is 0 looks up the patterns with the same suffix block,
  and the hash of the whole window selects among them;
* the bytes of the words are compared directly before a hit counts.

All documents of a batch are scanned in lockstep: one pointer per stretch of
text, moved with array operations.  Patterns are places in one byte array, and
the shift table grows with their number.  Benchmark text is sent to the tasks in
shards of at most ``shard_bytes``; a larger benchmark takes more scans, each
adding to the spans found so far, so no size is too large.

Null or word-less documents have no spans; null or word-less items have no
windows.  An item with a null id marks spans like any other and is left out of
the item list alone.  Repeated items, repeated documents and null ids are kept
row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm import words as W
from cellcast.session import cut_lineage, ship_package

#: The shift table has a slot for every few blocks of the patterns, from 2^18 to 2^26 slots of a byte.
_TABLE_BITS = (18, 26)
_STRETCH = 256
#: Benchmark text handled at once.  Its tables take about 60 bytes for each of its words: a
#: shard of 8 MB costs the driver and every Python worker some 150 MB, whatever the benchmark's size.
SHARD_BYTES = 8 << 20


def _window_hash(h: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    acc = np.zeros(len(first), dtype=np.uint64)
    for j in range(size):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[first + j]
    return W.mix(acc)


class Scanner:
    """Wu-Manber tables for the patterns of one length (in words)."""

    def __init__(self, size: int, hashes: np.ndarray):
        """``hashes``: one row of ``size`` word hashes per pattern, in the order of the windows' hashes."""
        self.size = size
        self.block = min(2, size)
        free = size - self.block + 1
        low, high = _TABLE_BITS
        # Eight slots for each block that a pattern may add, so that other text seldom meets a taken one.
        self.mask = (1 << min(high, max(low, (8 * len(hashes)).bit_length()))) - 1
        self.shift = np.full(self.mask + 1, min(free, 127), dtype=np.int8)
        for end in range(self.block - 1, size):  # nearer blocks last: they shift least
            block = self._block(hashes[:, end], hashes[:, end - 1] if self.block == 2 else None)
            self.shift[block & np.uint64(self.mask)] = min(size - 1 - end, 127)
        #: window hashes, ascending as the patterns are
        self.full = _window_hash(hashes.reshape(-1), np.arange(len(hashes)) * size, size)
        suffix = self._block(hashes[:, -1], hashes[:, -2] if self.block == 2 else None)
        self.suffix = np.unique(suffix)

    def _block(self, last: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        return last if before is None else W.combine(before, last)

    def candidates(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Positions of last words whose window may be a pattern."""
        m = self.size
        lo, hi = first[:-1] + m - 1, first[1:]
        pieces = np.maximum(0, -(-(hi - lo) // _STRETCH))
        doc = np.repeat(np.arange(len(lo)), pieces)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = lo[doc] + nth * _STRETCH
        stop = np.minimum(at + _STRETCH, hi[doc])
        found = []
        while len(at):
            block = self._block(h[at], h[at - 1] if self.block == 2 else None)
            jump = self.shift[block & np.uint64(self.mask)].astype(np.int64)
            zero = jump == 0
            if zero.any():
                ends, key = at[zero], block[zero]
                k = np.searchsorted(self.suffix, key)
                k[k == len(self.suffix)] = 0
                found.append(ends[self.suffix[k] == key])
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def hits(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
        """(position of the last word, pattern number) still to be confirmed."""
        ends = self.candidates(h, first)
        if not len(ends):
            return
        full = _window_hash(h, ends - self.size + 1, self.size)
        lo = np.searchsorted(self.full, full, "left")
        hi = np.searchsorted(self.full, full, "right")
        for i in np.flatnonzero(hi > lo):
            for k in range(lo[i], hi[i]):
                yield int(ends[i]), k


class PatternSet:
    """All windows of a shard of the benchmark: the words' bytes once, and per length the
    places of distinct windows, a scanner and the items that hold each window."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        batch = pa.record_batch({"t": pa.array([t for _, t in items], pa.string())})
        words = W.batch_words(batch, "t", W.ALNUM)
        self.buf, self.starts, self.ends = words.buf, words.starts, words.ends
        #: names of the items; -1 stands for an item without one
        names = sorted({i for i, _ in items if i is not None})
        number = {name: k for k, name in enumerate(names)}
        self.names = names
        owner = np.array([-1 if i is None else number[i] for i, _ in items], np.int64)
        h, counts = words.hashes(), words.counts()
        sizes = np.minimum(window, counts)
        self.groups = []
        for size in np.unique(sizes[sizes > 0]).tolist():
            docs = np.flatnonzero(sizes == size)
            n = counts[docs] - size + 1
            at = np.repeat(words.first[docs] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            own = np.repeat(owner[docs], n)
            full = _window_hash(h, at, size)
            # Windows of one hash stand together; equal ones are kept once, by their first place.
            order = np.lexsort((at, full))
            full, at, own = full[order], at[order], own[order]
            same = np.zeros(len(at), bool)
            for i in np.flatnonzero(full[1:] == full[:-1]) + 1:
                same[i] = self._equal(at[i - 1], self.buf, self.starts, self.ends, at[i], size)
            group = np.cumsum(~same) - 1
            place = at[~same]
            pairs = np.unique(np.stack([group, own], 1)[own >= 0], axis=0)
            first = np.searchsorted(pairs[:, 0], np.arange(len(place) + 1))
            self.groups.append((Scanner(size, h[place[:, None] + np.arange(size)]), place, first, pairs[:, 1]))

    def _equal(self, at: int, buf, starts, ends, other: int, size: int) -> bool:
        """Whether the words from ``at`` here are, byte by byte, those from ``other`` there."""
        return all(
            np.array_equal(
                self.buf[self.starts[at + j] : self.ends[at + j]], buf[starts[other + j] : ends[other + j]]
            )
            for j in range(size)
        )

    def search(self, words: W.Words) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
        """Merged word spans and item ids by document number."""
        h = words.hashes()
        ranges: list[tuple[int, int]] = []
        items: dict[int, set[str]] = {}
        for scanner, place, first, owners in self.groups:
            m = scanner.size
            for end, k in scanner.hits(h, words.first):
                start = end - m + 1
                if self._equal(place[k], words.buf, words.starts, words.ends, start, m):
                    ranges.append((start, end + 1))
                    d = int(np.searchsorted(words.first, start, "right")) - 1
                    items.setdefault(d, set()).update(self.names[o] for o in owners[first[k] : first[k + 1]])
        spans: dict[int, list[tuple[int, int]]] = {}
        for start, end in sorted(ranges):
            d = int(np.searchsorted(words.first, start, "right")) - 1
            base = int(words.first[d])
            own = spans.setdefault(d, [])
            if own and start - base <= own[-1][1]:
                own[-1] = (own[-1][0], max(own[-1][1], end - base))
            else:
                own.append((start - base, end - base))
        return spans, items


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ITEMS = pa.list_(pa.string())


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value
        for whole in batches:
            for batch in W.slices(whole, "__text"):
                words = W.batch_words(batch, "__text", W.ALNUM)
                spans, items = patterns.search(words)
                n = batch.num_rows
                old_spans, old_items = batch.column("spans"), batch.column("items")
                all_spans: list = [[]] * n
                all_items: list = [[]] * n
                had = np.flatnonzero(np.diff(old_spans.offsets.to_numpy()))
                for d in {*spans, *had.tolist()}:
                    before = [(x["start"], x["end"]) for x in old_spans[d].as_py()]
                    all_spans[d] = [
                        {"start": a, "end": b} for a, b in _merge(before + spans.get(d, []))
                    ]
                    all_items[d] = sorted({*old_items[d].as_py(), *items.get(d, ())})
                cols = {c: batch.column(c) for c in batch.schema.names}
                cols["n_words"] = pa.array(words.counts(), pa.int64())
                cols["spans"] = pa.array(all_spans, _SPANS)
                cols["items"] = pa.array(all_items, _ITEMS)
                yield pa.record_batch(cols)

    return run


def _pattern_sets(
    benchmark: DataFrame, item_col: str, item_text_col: str, window: int, shard_bytes: int
) -> Iterator[PatternSet]:
    """Patterns of the benchmark, shard by shard; an empty benchmark has one empty shard.

    The driver holds the text of one shard, which :data:`SHARD_BYTES` bounds.
    """
    bench = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")
    ).where("text is not null")
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-int(size) // shard_bytes))
    for k in range(shards):
        # The text is hashed too, so items that share an id, or have none, spread over the shards.
        own = F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == k
        part = bench.where(own) if shards > 1 else bench
        yield PatternSet([(r.item, r.text) for r in part.collect()], window)


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shard_bytes: int = SHARD_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Spans of benchmark windows in each document.

    Returns one row per document row: the id, the columns named in ``keep``
    (prefixed ``kept_``), ``n_words``, ``spans`` (merged word ranges) and
    ``items`` (ids, as sorted strings, of items with an occurring window).
    """
    spark = documents.sparkSession
    ship_package(spark)
    state = documents.select(
        F.col(id_col).alias("__id"),
        F.col(text_col).alias("__text"),
        *[F.col(c).alias(f"kept_{c}") for c in keep or []],
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    for k, patterns in enumerate(_pattern_sets(benchmark, item_col, item_text_col, window, shard_bytes)):
        if k:
            state = cut_lineage(state, "decontam")
        state = state.mapInArrow(_scan(spark.sparkContext.broadcast(patterns)), state.schema)
    return state.drop("__text").withColumnRenamed("__id", id_col)


def _keep_clean(shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value
        for whole in batches:
            for batch in W.slices(whole, text_col):
                spans, _ = patterns.search(W.batch_words(batch, text_col, W.ALNUM))
                clean = np.ones(batch.num_rows, bool)
                clean[list(spans)] = False
                yield batch.filter(pa.array(clean))

    return run


def keep_clean(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The rows of ``documents``, as they are, that hold no window of a benchmark item.

    A filter: each text passes through Python once, and a row goes at the first
    shard of the benchmark that it matches.
    """
    spark = documents.sparkSession
    ship_package(spark)
    for patterns in _pattern_sets(benchmark, item_col, item_text_col, window, shard_bytes):
        documents = documents.mapInArrow(_keep_clean(spark.sparkContext.broadcast(patterns), text_col), documents.schema)
    return documents


def digest(found: DataFrame) -> DataFrame:
    """Counts and item fingerprint of :func:`find_contamination` rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
