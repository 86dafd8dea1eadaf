"""Greedy word-piece counts with a linear longest-match automaton.

A word is a run of non-blank bytes, read with a blank before it.  Its pieces are
the longest vocabulary entries from the left, one after the other.  The
vocabulary is a trie whose nodes have a failure link: where the match goes on
once the longest entries on the path are taken off, and how many entries that
takes off.  Counting needs these numbers only, so no piece is ever built and a
byte is never read twice.

A word that no sequence of greedy matches covers counts as one unknown piece.
Null text counts as empty and has no words.  Rows are counted one by one;
repeated rows, null ids and empty tables need no special treatment.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm import words as W
from cellcast.session import ship_package


class PieceCounter:
    """Trie with failure links and popped-entry counts; :meth:`count` is the number of pieces."""

    def __init__(self, vocabulary: list[bytes]):
        self.next: list[dict[int, int]] = [{}]
        ends = [False]
        for entry in vocabulary:
            node = 0
            for byte in entry:
                child = self.next[node].get(byte)
                if child is None:
                    child = self.next[node][byte] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                node = child
            ends[node] = True
        ends[0] = False
        #: failure link (-1: none) and the entries that following it takes off
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for byte, child in self.next[node].items():
                queue.append(child)
                if ends[child]:
                    self.fail[child], self.popped[child] = 0, 1
                    continue
                at, count = self.fail[node], self.popped[node]
                while at >= 0 and byte not in self.next[at]:
                    count += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[child], self.popped[child] = self.next[at][byte], count

    def count(self, word: bytes) -> int:
        step, fail, popped = self.next, self.fail, self.popped
        node = total = 0
        for byte in word:
            child = step[node].get(byte)
            while child is None:
                if fail[node] < 0:
                    return 1  # unknown
                total += popped[node]
                node = fail[node]
                child = step[node].get(byte)
            node = child
        while node:
            if fail[node] < 0:
                return 1
            total += popped[node]
            node = fail[node]
        return total


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_vocabulary(path: str) -> list[bytes]:
    """Entries of a rank file: base 64 and rank on each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


_COUNTERS: dict[str, PieceCounter] = {}
#: Word lengths remembered by a worker; the memory is emptied when full.
_REMEMBER = 300_000


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = PieceCounter(read_vocabulary(path))
        count = _COUNTERS[path].count
        known: dict[bytes, int] = {}
        for whole in batches:
            for batch in W.slices(whole, "text"):
                words = W.Words(*W.text_buffer(batch.column("text"), lower=False), W.NON_SPACE)
                h = words.hashes()
                _, first, back = np.unique(h, return_index=True, return_inverse=True)
                lengths = np.empty(len(first), np.int64)
                for i, at in enumerate(first.tolist()):
                    word = words.bytes_of(at)
                    n = known.get(word)
                    if n is None:
                        n = count(b" " + word)
                        if len(word) <= 64:
                            if len(known) >= _REMEMBER:
                                known.clear()
                            known[word] = n
                    lengths[i] = n
                sums = np.concatenate([[0], np.cumsum(lengths[back])])
                yield pa.record_batch(
                    {
                        "id": batch.column("id"),
                        "n_words": pa.array(words.counts(), pa.int64()),
                        "n_tokens": pa.array(np.diff(sums[words.first]), pa.int64()),
                    }
                )

    return run


def count_tokens(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per document row: the id, ``n_words`` and ``n_tokens``."""
    ship_package(documents.sparkSession)
    id_type = documents.schema[id_col].dataType.simpleString()
    return (
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(
            _count(vocabulary or default_vocabulary()),
            f"id {id_type}, n_words long, n_tokens long",
        )
        .withColumnRenamed("id", id_col)
    )
