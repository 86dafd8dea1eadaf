"""Words of Arrow text batches as numpy arrays.

A batch of texts is treated as one byte buffer: letters are lowered, words are
runs of word bytes, and each word gets a 64-bit hash from prefix sums of a
polynomial.  Nothing here loops over words or characters in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a single longer text is still taken whole.
SLICE_BYTES = 4 << 20
#: Bytes hashed at once (eight bytes of working memory for each).
_SEGMENT = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Everything but blanks and the control characters tab to carriage return.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, lower-case ASCII letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int) -> np.ndarray:
    out = np.full(_SEGMENT + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        _TABLES["pow"] = _powers(_BASE)
        _TABLES["inv"] = _powers(pow(_BASE, -1, 1 << 64))
    return _TABLES["pow"], _TABLES["inv"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the 64 output bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ordered hash of two hash arrays."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + right)


class Words:
    """Words of a batch: byte ranges, hashes and the first word of each document."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, keep: np.ndarray):
        self.buf, self.offsets = buf, offsets
        is_word = keep[buf]
        head = is_word.copy()
        tail = is_word.copy()
        if len(buf):
            head[1:] &= ~is_word[:-1]
            tail[:-1] &= ~is_word[1:]
            cuts = offsets[(offsets > 0) & (offsets < len(buf))]
            head[cuts] = is_word[cuts]
            tail[cuts - 1] = is_word[cuts - 1]
        self.starts = np.flatnonzero(head)
        self.ends = np.flatnonzero(tail) + 1
        #: word range of document d is first[d] .. first[d + 1]
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        """Document number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self) -> np.ndarray:
        return hash_ranges(self.buf, self.starts, self.ends)


def hash_ranges(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range (ranges ascend and do not overlap)."""
    up, down = _tables()
    out = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _SEGMENT, "right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        if hi - lo > _SEGMENT:  # one range longer than a segment
            h = 0
            for at in range(lo, hi, _SEGMENT):
                part = buf[at : min(hi, at + _SEGMENT)].astype(np.uint64) + np.uint64(1)
                total = int((part * up[: len(part)]).sum(dtype=np.uint64))
                h = (h * 0xD6E8FEB86659FD93 + total) & _MASK
            out[a] = h
        else:
            part = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(
                (buf[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=part[1:]
            )
            s, e = starts[a:b] - lo, ends[a:b] - lo
            out[a:b] = (part[e] - part[s]) * down[s]
        a = b
    lengths = (ends - starts).astype(np.uint64)
    return mix(out + lengths * np.uint64(0xA24BAED4963EE407))


def text_buffer(column: pa.Array | pa.ChunkedArray, lower: bool = True):
    """(bytes, offsets) of a text column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    buf = (
        np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        if data is not None
        else np.zeros(0, np.uint8)
    )
    return (_LOWER[buf] if lower else buf), offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` text bytes (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    a = 0
    while a < batch.num_rows:
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(a, b - a)
        a = b


def batch_words(batch: pa.RecordBatch, column: str, keep: np.ndarray) -> Words:
    return Words(*text_buffer(batch.column(column)), keep)


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document: (hashes, first).

    A document of fewer than ``size`` words, but not none, is one shingle.
    """
    return shingles_at(words, words.hashes(), size)[:2]


def shingles_at(words: Words, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`shingle_hashes` from the hashes of the words, and each shingle's first word at one of its places."""
    n = words.counts()
    docs = words.docs()
    at = np.arange(len(h)) - np.repeat(words.first[:-1], n)
    left = np.repeat(n, n) - at  # words from here to the end of the document
    head = np.flatnonzero((left >= size) | (at == 0))
    acc = np.zeros(len(head), dtype=np.uint64)
    for j in range(size):
        inside = left[head] > j
        nxt = np.where(inside, h[np.minimum(head + j, max(len(h) - 1, 0))], np.uint64(j + 1))
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + nxt
    acc = mix(acc)
    owner = docs[head]
    order = np.lexsort((acc, owner))
    acc, owner, head = acc[order], owner[order], head[order]
    fresh = np.ones(len(acc), dtype=bool)
    if len(acc):
        fresh[1:] = (acc[1:] != acc[:-1]) | (owner[1:] != owner[:-1])
    acc, owner, head = acc[fresh], owner[fresh], head[fresh]
    return acc, np.searchsorted(owner, np.arange(len(n) + 1)), head
