"""Language-model scores from a weighted backoff automaton over words.

The model is a smoothed model of order two (words and pairs of words) of all
training documents.  Its automaton
has a state per word (and one for the start of a text).  A state u has an arc
for every word seen after it, with the probability

    (count(u, w) + kappa * p(w)) / (count(u) + kappa)

and a failure arc of weight ``kappa / (count(u) + kappa)`` to the state without
context, whose arcs hold ``p(w) = (count(w) + 1) / (N + V + 1)``; a word never
seen takes the last share.  A text is read once from left to right: the state is
the word before, a missing arc costs the failure weight, and the logarithms add
up.  The probabilities of each state sum to one.

No table of the whole model exists anywhere.  Documents are dealt into chunks
of neighbouring ids;
each chunk's distinct words and word pairs (as hashes, with their counts in
training texts) go to groups by hash, where they are added up over the
corpus; a group answers a chunk with the sums that differ from what the chunk
itself counted.  The chunk's part of the automaton is then built from its own
counts and the answers, and its texts are scored.  Common words are summed per
chunk before they move, so a word of any frequency costs one entry per chunk.

Tokens are runs of non-blank bytes with A-Z lowered, then one end per text; the
end follows the last word, or the start in an empty text.  Null text counts as
empty.  Rows with a null id are scored and never train (their remainder is
null).  Repeated rows train and are scored each by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.llm import words as W
from cellcast.session import cut_lineage, ship_package

_END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)
_LOW = np.uint64((1 << 48) - 1)
_IS_PAIR = np.int64(1 << 48)


def _group_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Group by the upper half of a hash; inside a group its lower 48 bits tell hashes apart."""
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _code(bucket, low: np.ndarray) -> np.ndarray:
    """Hashes again as one number: group and lower bits (the flag of pairs is bit 63)."""
    low = low.astype(np.uint64)
    flag = (low >> np.uint64(48)) << np.uint64(63)
    group = (np.asarray(bucket).astype(np.uint64) & np.uint64((1 << 15) - 1)) << np.uint64(48)
    return flag | group | (low & _LOW)


def _pack(low: np.ndarray, counts: np.ndarray) -> bytes:
    """Words first, then pairs: two lengths and the width of a count, six bytes per hash, then
    the counts, in four bytes each or, where one needs it, in eight."""
    words = int((low < _IS_PAIR).sum())
    width = 8 if len(counts) and int(counts.max()) >= 1 << 32 else 4
    head = np.array([words, len(low) - words, width], "<u4").tobytes()
    six = low.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return head + six + counts.astype(f"<u{width}").tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    words, pairs, width = np.frombuffer(blob, "<u4", 3).tolist()
    n = words + pairs
    low = np.zeros((n, 8), np.uint8)
    low[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, 12).reshape(n, 6)
    low = low.reshape(-1).view("<i8").copy()
    low[words:] += _IS_PAIR
    return low, np.frombuffer(blob, f"<u{width}", n, 12 + 6 * n).astype(np.int64)


def _add(at: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``counts`` by place, in whole numbers at any size."""
    out = np.zeros(n, np.int64)
    np.add.at(out, at, counts)
    return out


class _Tokens:
    """Tokens of a slice, with ends: word hashes, the state before each, and pair hashes."""

    def __init__(self, batch: pa.RecordBatch):
        words = W.batch_words(batch, "text", W.NON_SPACE)
        n = words.counts()
        self.count = n + 1
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.h = np.empty(int(self.first[-1]), np.uint64)
        ends = self.first[1:] - 1
        inner = np.ones(len(self.h), bool)
        inner[ends] = False
        self.h[inner] = words.hashes()
        self.h[ends] = _END
        self.state = np.empty_like(self.h)
        self.state[1:] = self.h[:-1]
        self.state[self.first[:-1]] = _START
        self.pair = W.combine(self.state, self.h)
        self.starts = self.first[:-1]

    def entries(self, train: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(distinct hashes in order, training counts) of the words, then of the pairs."""
        weight = np.repeat(train, self.count).astype(np.int64)
        # The start state's count is the number of training texts.
        words = np.concatenate([self.h, np.full(len(train), _START)])
        out = []
        for h, w in ((words, np.concatenate([weight, train.astype(np.int64)])), (self.pair, weight)):
            keys, back = np.unique(h, return_inverse=True)
            # At most as many as the slice has tokens, which a double holds exactly.
            out.append((keys, np.bincount(back, w, len(keys)).astype(np.int64)))
        return out


def _gather(buckets: int):
    """Chunk's documents -> (bucket, chunk, packed entries)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            chunk = whole.column("chunk").to_numpy()
            for c in np.unique(chunk).tolist():
                for batch in W.slices(whole.filter(pa.array(chunk == c)), "text"):
                    train = batch.column("train").to_numpy(zero_copy_only=False)
                    kinds = []
                    for (h, counts), flag in zip(_Tokens(batch).entries(train), (0, _IS_PAIR)):
                        # Groups follow the order of the hashes.
                        cuts = np.searchsorted(_group_of(h, buckets), np.arange(buckets + 1))
                        kinds.append(((h & _LOW).astype(np.int64) + flag, counts, cuts))
                    some, blobs = [], []
                    for g in range(buckets):
                        part = [(low[k[g] : k[g + 1]], n[k[g] : k[g + 1]]) for low, n, k in kinds]
                        if len(part[0][0]) + len(part[1][0]):
                            some.append(g)
                            blobs.append(_pack(*(np.concatenate(x) for x in zip(*part))))
                    yield pa.record_batch(
                        {
                            "bucket": pa.array(some, pa.int64()),
                            "chunk": pa.array(np.full(len(some), c, np.int64)),
                            "blob": pa.array(blobs, pa.binary()),
                        }
                    )

    return run


_ANSWERS = "bucket long, chunk long, blob binary, tokens long, distinct long"


def _answer(buckets: int, large: np.ndarray):
    """Sums over the corpus of a group's hashes; to each chunk, those it does not know itself.

    A ``large`` chunk is scored in several parts, which know less than the chunk: it
    gets all sums.
    """
    start = np.array([_START], np.uint64)
    start_group, start_low = int(_group_of(start, buckets)[0]), int(start[0] & _LOW)

    def run(table: pa.Table) -> pa.Table:
        group = table["bucket"][0].as_py()
        chunks = table["chunk"].to_numpy()
        parts = [_unpack(b) for b in table["blob"].to_pylist()]
        owner = np.repeat(chunks, [len(p[0]) for p in parts])
        own = np.concatenate([p[1] for p in parts])
        keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        total = _add(back, own, len(keys))
        word = keys < _IS_PAIR
        if group == start_group:
            word &= keys != start_low
        # What the chunk counted, over all its parts.
        order = np.lexsort((back, owner))
        owner, back, own = owner[order], back[order], own[order]
        head = np.ones(len(order), bool)
        head[1:] = (owner[1:] != owner[:-1]) | (back[1:] != back[:-1])
        own = np.add.reduceat(own, np.flatnonzero(head))
        owner, back = owner[head], back[head]
        news = (own != total[back]) | np.isin(owner, large)
        owner, back = owner[news], back[news]
        names, first = np.unique(owner, return_index=True)
        cuts = np.append(first, len(owner))
        out = [(group, -1, b"", int(total[word].sum()), int((total[word] > 0).sum()))]
        for i, c in enumerate(names.tolist()):
            mine = back[cuts[i] : cuts[i + 1]]
            out.append((group, c, _pack(keys[mine], total[mine]), 0, 0))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        names = ["bucket", "chunk", "blob", "tokens", "distinct"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


class BackoffAutomaton:
    """Arcs of the states that a chunk's texts pass, as sorted hash arrays with counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, n: int, v: int, kappa: float):
        self.keys, self.counts, self.n, self.v, self.kappa = keys, counts, n, v, kappa

    def count(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, self.counts[at], 0)

    def traverse(self, state: np.ndarray, word: np.ndarray, pair: np.ndarray):
        """(log10 probability of each step, of the step without context, the word's count)."""
        seen = self.count(word)
        plain = (seen + 1) / (self.n + self.v + 1)
        context = self.count(state)
        arc = self.count(pair)
        failure = self.kappa / (context + self.kappa)
        prob = arc / (context + self.kappa) + failure * plain
        return np.log10(prob), np.log10(plain), seen


_SCORED = pa.schema(
    [("id", pa.int64()), ("train", pa.bool_())]
    + [(c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")]
    + [(c, pa.float64()) for c in ("base_score", "score")]
)


def _score(n: int, v: int, kappa: float, buckets: int):
    def codes(h: np.ndarray, flag: int = 0) -> np.ndarray:
        return _code(_group_of(h, buckets), (h & _LOW).astype(np.int64) + flag)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:  # a part of a large chunk that no row was dealt to
            return _SCORED.empty_table()
        batches = [
            b
            for whole in texts.combine_chunks().to_batches()
            for b in W.slices(whole, "text")
        ]
        own_keys, own_counts, tokens = [], [], []
        for batch in batches:
            t = _Tokens(batch)
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for (h, counts), flag in zip(t.entries(train), (0, int(_IS_PAIR))):
                own_keys.append(codes(h, flag))
                own_counts.append(counts)
            tokens.append(t)
        keys, back = np.unique(np.concatenate(own_keys), return_inverse=True)
        counts = _add(back, np.concatenate(own_counts), len(keys))
        # Answers replace the chunk's own counts; a part of a chunk does not hold all its hashes.
        for group, blob in zip(answers["bucket"].to_pylist(), answers["blob"].to_pylist()):
            low, total = _unpack(blob)
            code = _code(group, low)
            at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
            mine = keys[at] == code
            counts[at[mine]] = total[mine]
        automaton = BackoffAutomaton(keys, counts, n, v, kappa)
        out = []
        for batch, t in zip(batches, tokens):
            log, plain, seen = automaton.traverse(
                codes(t.state), codes(t.h), codes(t.pair, int(_IS_PAIR))
            )
            out.append(
                pa.table(
                    {
                        "id": batch.column("id"),
                        "train": batch.column("train"),
                        "n_tokens": pa.array(t.count, pa.int64()),
                        "n_known": pa.array(np.add.reduceat(seen > 0, t.starts, dtype=np.int64)),
                        "train_tokens": pa.array(np.full(len(t.count), n, np.int64)),
                        "base_score": pa.array(np.add.reduceat(plain, t.starts)),
                        "score": pa.array(np.add.reduceat(log, t.starts)),
                    }
                )
            )
        return pa.concat_tables(out)

    return run


def score_documents(
    documents: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    kappa: float = 200.0,
    chunk_ids: int = 2048,
    chunk_bytes: int = 7 << 20,
    entries: int = 1_000_000,
) -> DataFrame:
    """One row per document row: the id, ``train`` (whether it trained the model),
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``chunk_ids`` neighbouring ids make a chunk.  One that holds far more than
    ``chunk_bytes`` of text (a hot or null id, long neighbours) is dealt out by a
    hash of the text, and what one repeated or very long text still makes too large
    is scored in parts.  ``entries`` is the size aimed at for a group of hashes.
    """
    spark = documents.sparkSession
    ship_package(spark)
    docs = documents.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    bytes_of = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    size = docs.agg(F.coalesce(F.sum(bytes_of), F.lit(0))).first()[0]
    buckets = max(8, -(-int(size) // (8 * entries)))
    # Neighbouring ids make a chunk, so that a map task meets few chunks.  One of more than
    # thrice its size is dealt out by a hash of the text, and what is still too large after
    # that -- one text, repeated or very long -- is scored in parts.
    def too_large() -> dict[int, int]:
        sizes = docs.groupBy("chunk").agg(F.sum(bytes_of).alias("bytes")).where(F.col("bytes") > 3 * chunk_bytes)
        return {r.chunk: -(-int(r["bytes"]) // chunk_bytes) for r in sizes.collect()}

    def looked_up(found: dict[int, int]) -> Column:
        known = F.create_map(*[F.lit(v) for pair in found.items() for v in pair])
        return F.coalesce(F.element_at(known, F.col("chunk")), F.lit(1)).cast("bigint")

    chunk = F.coalesce(F.floor(F.col("id") / chunk_ids), F.lit(-2)).cast("bigint")
    docs = docs.withColumn("chunk", chunk)
    dealt, parts = too_large(), {}
    if dealt:
        n = looked_up(dealt)
        spread = F.xxhash64("chunk", F.pmod(F.xxhash64("text"), n))
        docs = docs.withColumn("chunk", F.when(n > 1, spread).otherwise(F.col("chunk")))
        parts = too_large()
    large = np.array(sorted(parts), np.int64)
    answers = cut_lineage(
        docs.drop("row")
        .mapInArrow(_gather(buckets), "bucket long, chunk long, blob binary")
        .groupBy("bucket")
        .applyInArrow(_answer(buckets, large), _ANSWERS),
        "answers",
    )
    total = answers.where("chunk = -1").agg(F.sum("tokens"), F.sum("distinct")).first()
    schema = (
        "id long, train boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    told = answers.where("chunk <> -1").select("chunk", "bucket", "blob")
    zero = F.lit(0).cast("bigint")
    part, copies = zero, F.array(zero)
    if parts:
        n = looked_up(parts)
        # Any part will do for a row: all parts get the same sums.
        part, copies = F.pmod(F.xxhash64("row"), n), F.sequence(zero, n - 1)
    docs = docs.withColumn("part", part).drop("row")
    told = told.withColumn("part", F.explode(copies))
    return (
        docs.groupBy("chunk", "part")
        .cogroup(told.groupBy("chunk", "part"))
        .applyInArrow(_score(int(total[0] or 0), int(total[1] or 0), kappa, buckets), schema)
        .withColumnRenamed("id", id_col)
    )
