"""Toxicity with a linear-chain conditional random field over words.

Only documents carry labels, so tokens are labelled first: over all labelled
training documents every word and word beginning is counted by document, and one
that occurs in enough toxic documents and hardly in others marks its tokens in
toxic documents.  The field has two states; its features are hashes of the word,
its beginnings and its end, its weights come from gradient steps on windows of
tokens.

A document is read whole.  Forward-backward gives each token's marginal
probability of being toxic; the recursion runs in two levels (products inside
stretches of tokens, then over the stretches), which is exact at any length.
Document features are the largest marginal and the expected number of toxic
tokens; a logistic function fitted on the training sample turns them into the
score.  Runs of tokens with a marginal of at least one half are the offending
spans (code points, end exclusive).

The field is fitted on at most about ``max_rows`` labelled rows per label, chosen
by a hash of the id; the counts cover all training rows.  Null text counts as
empty and scores like any text without toxic words.  Rows without a label never
train.  Repeated rows and null ids are scored row by row; extra columns are not
read.  Without training rows every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm import words as W
from cellcast.session import cut_lineage, ship_package

#: Bytes of the word beginnings that are features, and of the ending.
BEGINNINGS = (4, 5, 6)
ENDING = 4
FEATURE_BITS = 18
_WINDOW = 48
#: Training windows at marked tokens that one document gives at most.
MARKED_WINDOWS = 4
_STRETCH = 64
_SLICE = 1 << 20


def token_features(words: W.Words) -> np.ndarray:
    """64-bit feature hashes, one row per word: the word, its beginnings, its end."""
    h = [W.combine(words.hashes(), np.uint64(1))]
    size = words.ends - words.starts
    for k, n in enumerate(BEGINNINGS):
        part = W.hash_ranges(words.buf, words.starts, words.starts + np.minimum(size, n))
        h.append(W.combine(part, np.uint64(10 + k)))
    part = W.hash_ranges(words.buf, words.ends - np.minimum(size, ENDING), words.ends)
    h.append(W.combine(part, np.uint64(30)))
    return np.stack(h, axis=1)


def _slot(features: np.ndarray) -> np.ndarray:
    return (features >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


class ToxicField:
    """A two-state linear-chain field with a logistic layer for documents."""

    def __init__(self):
        self.weight = np.zeros(1 << FEATURE_BITS)
        self.bias = 0.0
        self.step = np.zeros((2, 2))  # log potential of (state, next state)
        self.layer = np.zeros(3)
        self.lexicon = np.zeros(0, np.uint64)

    def potentials(self, features: np.ndarray) -> np.ndarray:
        """Log potential of the toxic state of each token (of the other state: 0)."""
        return self.weight[_slot(features)].sum(axis=1) + self.bias

    # -- training on windows of equal length

    def _window_pass(self, x: np.ndarray):
        """Marginals of tokens and transitions of padded windows (rows of potentials)."""
        n, length = x.shape
        e = np.stack([np.ones_like(x), np.exp(np.clip(x, -30, 30))], axis=2)
        t = np.exp(self.step)
        alpha = np.empty_like(e)
        alpha[:, 0] = e[:, 0]
        alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
        for i in range(1, length):
            alpha[:, i] = (alpha[:, i - 1] @ t) * e[:, i]
            alpha[:, i] /= alpha[:, i].sum(axis=1, keepdims=True)
        beta = np.ones_like(e)
        for i in range(length - 2, -1, -1):
            beta[:, i] = (e[:, i + 1] * beta[:, i + 1]) @ t.T
            beta[:, i] /= beta[:, i].sum(axis=1, keepdims=True)
        p = alpha * beta
        p /= p.sum(axis=2, keepdims=True)
        pair = alpha[:, :-1, :, None] * t * (e * beta)[:, 1:, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        return p[:, :, 1], pair

    def fit(self, slots: np.ndarray, labels: np.ndarray, real: np.ndarray, rounds: int = 12) -> None:
        """Adagrad on the conditional likelihood; ``slots``: (window, token, feature)."""
        rng = np.random.default_rng(5)
        g2, t2, b2 = np.full(len(self.weight), 1e-6), np.full((2, 2), 1e-6), 1e-6
        n = len(slots)
        for _ in range(rounds):
            for rows in np.array_split(rng.permutation(n), max(1, n // 256)):
                x = self.weight[slots[rows]].sum(axis=2) + self.bias
                x = np.where(real[rows], x, -30.0)
                p, pair = self._window_pass(x)
                miss = np.where(real[rows], labels[rows] - p, 0.0)
                grad = np.bincount(
                    slots[rows].reshape(-1),
                    np.repeat(miss.reshape(-1), slots.shape[2]),
                    len(self.weight),
                )
                grad -= 1e-3 * self.weight * (grad != 0)
                both = (real[rows][:, 1:] & real[rows][:, :-1])[:, :, None, None]
                y = labels[rows].astype(int)
                hot = np.zeros(pair.shape)
                i, j = np.indices(y[:, 1:].shape)
                hot[i, j, y[:, :-1], y[:, 1:]] = 1
                step = ((hot - pair) * both).sum(axis=(0, 1))
                bias = miss.sum()
                g2 += grad**2
                t2 += step**2
                b2 += bias**2
                self.weight += 0.3 * grad / np.sqrt(g2)
                self.step += 0.05 * step / np.sqrt(t2)
                self.bias += 0.1 * bias / np.sqrt(b2)

    def fit_layer(self, x: np.ndarray, y: np.ndarray) -> None:
        """Newton steps of a ridge logistic regression (document features -> label)."""
        a = np.column_stack([np.ones(len(x)), x])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a @ self.layer, -30, 30)))
            h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 0.05 * np.eye(3)
            self.layer = self.layer + np.linalg.solve(h, a.T @ (y - p) - 0.05 * self.layer)

    # -- reading whole documents

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of the toxic state of each token of the documents ``first[d]:first[d + 1]``."""
        forward = self._sweep(x, first, self.step)
        last = first[:-1] + first[1:]
        back = np.repeat(last, np.diff(first)) - 1 - np.arange(len(x))
        backward = self._sweep(x[back], first, self.step.T)[back]
        # Both sweeps hold the token's own potential once; take it off one of them.
        e = np.exp(np.clip(x, -30, 30))
        one = forward[:, 1] * backward[:, 1] / e
        zero = forward[:, 0] * backward[:, 0]
        return one / (one + zero)

    def _sweep(self, x: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Scaled forward vectors of all tokens, in two levels."""
        e = np.exp(np.clip(x, -30, 30))
        t = np.exp(step)
        n = np.diff(first)
        pieces = -(-n // _STRETCH)
        doc = np.repeat(np.arange(len(n)), pieces)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = first[:-1][doc] + nth * _STRETCH
        size = np.minimum(_STRETCH, first[1:][doc] - start)
        # Product of each stretch: the vector after it, for either state before it.
        m = np.zeros((len(doc), 2, 2))
        m[:] = np.eye(2)
        for i in range(_STRETCH):
            on = np.flatnonzero(size > i)
            if not len(on):
                break
            nxt = m[on] @ t
            nxt[:, :, 1] *= e[start[on] + i][:, None]
            m[on] = nxt / nxt.sum(axis=(1, 2), keepdims=True)
        # Vector before each stretch; a document begins as if after a neutral step.
        before = np.zeros((len(doc), 2))
        begin = np.flatnonzero(nth == 0)
        inv = np.linalg.inv(t) if abs(np.linalg.det(t)) > 1e-12 else np.eye(2)
        before[begin] = np.ones(2) @ inv
        live = begin
        while True:
            live = live[(live + 1 < len(doc))]
            live = live[nth[np.minimum(live + 1, len(doc) - 1)] > 0]
            if not len(live):
                break
            v = np.einsum("ni,nij->nj", before[live], m[live])
            before[live + 1] = v / v.sum(axis=1, keepdims=True)
            live = live + 1
        out = np.empty((len(x), 2))
        v = before
        for i in range(_STRETCH):
            on = np.flatnonzero(size > i)
            if not len(on):
                break
            nxt = v[on] @ t
            nxt[:, 1] *= e[start[on] + i]
            nxt /= nxt.sum(axis=1, keepdims=True)
            out[start[on] + i] = nxt
            v[on] = nxt
        return out

    def document_features(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(largest marginal, log of 1 + expected toxic tokens among the marked) per document."""
        n = np.diff(first)
        out = np.zeros((len(n), 2))
        some = np.flatnonzero(n)
        if len(some):
            out[some, 0] = np.maximum.reduceat(p, first[:-1][some])
            marked = np.where(p >= 0.5, p, 0.0)
            out[some, 1] = np.log1p(np.add.reduceat(marked, first[:-1][some]))
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.layer.any():
            return np.zeros(len(features))
        z = self.layer[0] + features @ self.layer[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a feature."""
    for whole in batches:
        for batch in W.slices(whole, "text", _SLICE):
            words = W.batch_words(batch, "text", W.ALNUM)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            f = token_features(words)[:, :-1]  # word and beginnings
            doc = np.repeat(words.docs(), f.shape[1])
            key = f.reshape(-1)
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            key, doc = key[fresh], doc[fresh]
            value, back = np.unique(key, return_inverse=True)
            bad = np.bincount(back, toxic[doc], len(value)).astype(np.int64)
            all_docs = np.bincount(back, minlength=len(value)).astype(np.int64)
            yield pa.record_batch(
                {
                    "feature": pa.array(value.view(np.int64)),
                    "bad": pa.array(bad),
                    "good": pa.array(all_docs - bad),
                }
            )


def _marked_windows(marked: np.ndarray, hashes: np.ndarray, start: int) -> list[int]:
    out, end = [], -1
    for m in marked.tolist():
        if m >= end:
            out.append(max(start, m - _WINDOW // 2))
            end = out[-1] + _WINDOW
    key = lambda s: (int(W.mix(hashes[s : s + _WINDOW].sum(dtype=np.uint64, keepdims=True))[0]), s)
    return sorted(out, key=key)[:MARKED_WINDOWS]


def _windows(lexicon):
    """Training windows: at marked tokens of toxic documents, and one by hash of each document.

    Windows at marked tokens do not overlap and together hold all of them; of a
    document with more than ``MARKED_WINDOWS`` those whose words hash lowest are
    taken, wherever they stand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = lexicon.value
        for whole in batches:
            for batch in W.slices(whole, "text", _SLICE):
                words = W.batch_words(batch, "text", W.ALNUM)
                if not len(words):
                    continue
                f = token_features(words)
                toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
                label = np.isin(f[:, :-1], marks).any(axis=1) & toxic[words.docs()]
                out = []
                for d in range(batch.num_rows):
                    a, b = int(words.first[d]), int(words.first[d + 1])
                    if a == b:
                        continue
                    starts = {a + int(f[a, 0] % np.uint64(b - a))}
                    marked = a + np.flatnonzero(label[a:b])
                    starts.update(_marked_windows(marked, f[:, 0], a))
                    for s in sorted(starts):
                        e = min(b, s + _WINDOW)
                        out.append((_slot(f[s:e]).astype(np.int32).tobytes(), label[s:e].tobytes()))
                yield pa.record_batch(
                    {
                        "slots": pa.array([x for x, _ in out], pa.binary()),
                        "labels": pa.array([y for _, y in out], pa.binary()),
                    }
                )

    return run


def _read(field):
    """(id, features of the document, spans) under a field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = field.value
        for whole in batches:
            for batch in W.slices(whole, "text", _SLICE):
                words = W.batch_words(batch, "text", W.ALNUM)
                if len(words):
                    p = own.marginals(own.potentials(token_features(words)), words.first)
                else:
                    p = np.zeros(0)
                x = own.document_features(p, words.first)
                spans: list[list] = [[] for _ in range(batch.num_rows)]
                docs = words.docs()
                hit = np.flatnonzero(p >= 0.5)
                runs = np.split(hit, np.flatnonzero((np.diff(hit) > 1) | (np.diff(docs[hit]) > 0)) + 1)
                for run_ in runs if len(hit) else []:
                    d = int(docs[run_[0]])
                    lo, hi = int(words.starts[run_[0]]), int(words.ends[run_[-1]])
                    base = int(words.offsets[d])
                    before = int(((words.buf[base:lo] & 0xC0) != 0x80).sum())
                    inside = int(((words.buf[lo:hi] & 0xC0) != 0x80).sum())
                    spans[d].append({"start": before, "end": before + inside, "p": float(p[run_].max())})
                yield pa.record_batch(
                    {
                        "id": batch.column("id"),
                        "score": pa.array(own.score(x)),
                        "largest": pa.array(x[:, 0]),
                        "expected": pa.array(x[:, 1]),
                        "spans": pa.array(
                            spans,
                            pa.list_(
                                pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])
                            ),
                        ),
                    }
                )

    return run


_READ = "score double, largest double, expected double, spans array<struct<start:bigint,end:bigint,p:double>>"


def learn_field(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = 4_000,
    min_docs: int = 3,
    min_share: float = 0.9,
) -> ToxicField:
    """Fit a field on labelled documents (rows without text or label are left out)."""
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.col(label_col) == 1).alias("toxic")
    )
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    field = ToxicField()
    if not sizes.get(True) or not sizes.get(False):
        return field
    counts = (
        rows.mapInArrow(_count_features, "feature long, bad long, good long")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    )
    bad, good = F.col("bad") / sizes[True], F.col("good") / sizes[False]
    marks = counts.where((F.col("bad") >= min_docs) & (bad >= min_share * (bad + good))).select("feature")
    # The text is hashed too: rows that share an id, or have none, are thinned one by one.
    keep = F.pmod(F.xxhash64(F.col("id").cast("string"), "text", F.lit("toxicity")), F.lit(1_000_003))
    rate = {k: int(1_000_003 * min(1.0, max_rows / v)) for k, v in sizes.items()}
    # The larger rate alone needs no label, so it thins the documents before they meet their labels.
    sample = cut_lineage(
        rows.where(keep < max(rate.values())).where(
            keep < F.when(F.col("toxic"), rate[True]).otherwise(rate[False])
        ),
        "sample",
    )
    # Marks serve to label the sample, so only those that occur there are needed, at any corpus size.
    here = sample.where("toxic").mapInArrow(_count_features, "feature long, bad long, good long").select("feature").distinct()
    found = marks.join(here, "feature", "left_semi").collect()
    field.lexicon = np.sort(np.array([r.feature for r in found], np.int64).view(np.uint64))
    windows = sample.mapInArrow(
        _windows(spark.sparkContext.broadcast(field.lexicon)), "slots binary, labels binary"
    ).collect()
    windows.sort(key=lambda w: (bytes(w.slots), bytes(w.labels)))
    width = len(BEGINNINGS) + 2
    slots = np.zeros((len(windows), _WINDOW, width), np.int64)
    labels = np.zeros((len(windows), _WINDOW))
    real = np.zeros((len(windows), _WINDOW), bool)
    for i, w in enumerate(windows):
        y = np.frombuffer(w.labels, bool)
        slots[i, : len(y)] = np.frombuffer(w.slots, np.int32).reshape(len(y), width)
        labels[i, : len(y)], real[i, : len(y)] = y, True
    field.fit(slots, labels, real)
    seen = (
        sample.select("text", F.col("toxic").cast("int").alias("id"))
        .mapInArrow(_read(spark.sparkContext.broadcast(field)), f"id int, {_READ}")
        .select("id", "largest", "expected")
        .collect()
    )
    x = np.array([[r.largest, r.expected] for r in seen])
    field.fit_layer(x, np.array([r.id for r in seen], float))
    return field


def score_toxicity(
    documents: DataFrame, field: ToxicField, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document row: the id, ``score`` and the offending ``spans``."""
    spark = documents.sparkSession
    ship_package(spark)
    id_type = documents.schema[id_col].dataType.simpleString()
    return (
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(_read(spark.sparkContext.broadcast(field)), f"id {id_type}, {_READ}")
        .select(F.col("id").alias(id_col), "score", "spans")
    )
