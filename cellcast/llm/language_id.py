"""Language ID with n-gram filters that answer for all languages at once.

N-grams are four bytes of lower-cased text in which everything but letters is a
blank.  A language's filter holds the n-grams that are common in it: at least
``min_rate`` of its n-grams (so at most ``1 / min_rate`` of them) and at least
``share`` of the rate in the language where they are most common.  The filters
are bit-sliced: a slot holds one bit per language, and the AND of the slots that
an n-gram hashes to is the mask of the languages that contain it.

A document's hits per language are the popcounts of its masks by bit.  With f
the false positive rate of the language's filter, ``(hits / n - f) / (1 - f)``
estimates the share of its n-grams; the largest share decides (ties: the first
name), and the score weighs it against the runner-up.

The filters are learned from at most about ``max_rows`` labelled rows of each
language, chosen by a hash of the id and the text; a language with fewer rows is
learned from all of them.  Repeated rows are in or out together, and the rows with
a language's smallest hash are always in, so no labelled language is left out.
Prediction reads the text only.  Null or letter-less text is ``und`` with score 0.  With no labelled row everything is ``und``.  Repeated
rows, null ids, null labels and extra columns are harmless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellcast.llm import words as W
from cellcast.session import cut_lineage, ship_package

GRAM = 4
HASHES = 3
_SLICE = 1 << 20
_HASH_RANGE = 1_000_003
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[97:123] = True
_LETTER = _ASCII_LETTER.copy()
_LETTER[0x80:] = True


def _grams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram numbers in text order, first n-gram of each document, ASCII letters per document)."""
    buf, offsets = W.text_buffer(batch.column("text"))
    n = len(offsets) - 1
    padded = np.full(len(buf) + GRAM * (n + 1), 32, np.uint8)
    shift = GRAM * np.repeat(np.arange(n), np.diff(offsets)) + 1
    padded[np.arange(len(buf)) + shift] = np.where(_LETTER[buf], buf, 32)
    value = np.zeros(max(0, len(padded) - GRAM + 1), np.uint32)
    for j in range(GRAM):
        value = (value << np.uint32(8)) | padded[j : len(value) + j]
    at = np.flatnonzero(_LETTER[padded[1 : len(value) + 1]])
    first = np.searchsorted(at, offsets + GRAM * np.arange(n + 1))
    letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[buf])])
    return value[at], first, np.diff(letters[offsets])


class LanguageFilters:
    """Bit-sliced Bloom filters: one bit per language in every slot."""

    def __init__(self, grams: dict[str, np.ndarray], slot_bits: int = 20):
        self.names = sorted(grams)
        planes = max(1, -(-len(self.names) // 8))
        self.slot_bits = slot_bits
        self.slots = np.zeros((planes, 1 << slot_bits), np.uint8)
        for k, name in enumerate(self.names):
            for j in range(HASHES):
                self.slots[k // 8, self._slot(grams[name], j)] |= np.uint8(1 << (k % 8))
        self.wrong = []
        for k in range(len(self.names)):
            fill = ((self.slots[k // 8] >> np.uint8(k % 8)) & 1).mean()
            self.wrong.append(float(fill**HASHES))

    def _slot(self, grams: np.ndarray, j: int) -> np.ndarray:
        h = (grams.astype(np.uint64) + np.uint64(1)) * np.uint64(
            (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)[j]
        )
        return (h >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def shares(self, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Corrected share of each document's n-grams (rows) in each language (columns)."""
        n = np.maximum(np.diff(first), 1)
        out = np.zeros((len(first) - 1, len(self.names)))
        slots = [self._slot(grams, j) for j in range(HASHES)]
        for plane in range(len(self.slots)):
            mask = self.slots[plane][slots[0]]
            for s in slots[1:]:
                mask &= self.slots[plane][s]
            for k in range(8 * plane, min(8 * plane + 8, len(self.names))):
                hits = np.concatenate([[0], np.cumsum((mask >> np.uint8(k % 8)) & 1, dtype=np.int64)])
                rate = np.diff(hits[first]) / n
                out[:, k] = np.maximum(0.0, (rate - self.wrong[k]) / (1 - self.wrong[k]))
        return out


def learn_filters(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    max_rows: int = 40_000,
    min_rate: float = 1e-5,
    share: float = 0.4,
    min_count: int = 3,
) -> LanguageFilters:
    """Filters of the languages in ``labelled`` (rows with a null text or label are left out)."""
    ship_package(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    lang = F.col(lang_col).cast("string")
    keep = F.pmod(F.xxhash64(F.col(id_col).cast("string"), text_col, F.lit("langid")), F.lit(_HASH_RANGE))
    sizes = rows.groupBy(lang.alias("lang")).agg(F.count("*").alias("n"), F.min(keep).alias("least")).collect()
    below = {r.lang: max(int(_HASH_RANGE * max_rows / r.n), r.least + 1) for r in sizes if r.n > max_rows}
    if below:
        limits = F.create_map(*[F.lit(v) for pair in below.items() for v in pair])
        rows = rows.where(keep < F.coalesce(F.element_at(limits, lang), F.lit(_HASH_RANGE)))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, "text", _SLICE):
                grams, first, _ = _grams(batch)
                langs = np.array(batch.column("lang").to_pylist(), object)
                owner = np.repeat(langs, np.diff(first)) if len(langs) else langs
                for lang in sorted(set(langs.tolist())):
                    value, times = np.unique(grams[owner == lang], return_counts=True)
                    yield pa.record_batch(
                        {
                            "lang": pa.array([lang] * len(value), pa.string()),
                            "gram": pa.array(value.astype(np.int64)),
                            "n": pa.array(times.astype(np.int64)),
                        }
                    )

    # Written once: totals, rates and the choice all read it.
    counts = cut_lineage(
        rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
        .mapInArrow(tally, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    most = rated.groupBy("gram").agg(F.max("rate").alias("most"))
    chosen = rated.where((F.col("rate") >= min_rate) & (F.col("n") >= min_count)).join(most, "gram")
    picked = chosen.where(F.col("rate") >= share * F.col("most")).select("lang", "gram").collect()
    grams: dict[str, list[int]] = {r.lang: [] for r in totals.select("lang").collect()}
    for r in picked:
        grams[r.lang].append(r.gram)
    return LanguageFilters({k: np.array(v, np.uint32) for k, v in grams.items()})


def _predict(
    own: LanguageFilters, batch: pa.RecordBatch
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, coverage) of the texts of a batch."""
    grams, first, letters = _grams(batch)
    share = own.shares(grams, first)
    texts = batch.column("text")
    n = batch.num_rows
    names, score, cover = ["und"] * n, np.zeros(n), np.zeros(n)
    if own.names:
        best = share.argmax(axis=1)
        top = share[np.arange(n), best]
        rest = share.copy()
        rest[np.arange(n), best] = 0
        second = rest.max(axis=1)
        margin = np.where(top > 0, top / np.maximum(top + second, 1e-300), 0)
        for i in range(n):
            if letters[i] or any(c.isalpha() for c in texts[i].as_py() or ""):
                names[i] = own.names[best[i]]
                cover[i] = min(1.0, top[i])
                score[i] = cover[i] * margin[i]
    return names, score, cover


def identify(
    documents: DataFrame, filters: LanguageFilters, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document row: the id, ``lang_pred``, ``score`` and ``coverage`` (the best share)."""
    spark = documents.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(filters)
    id_type = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, "text", _SLICE):
                names, score, cover = _predict(shared.value, batch)
                yield pa.record_batch(
                    {
                        "id": batch.column("id"),
                        "lang_pred": pa.array(names, pa.string()),
                        "score": pa.array(score),
                        "coverage": pa.array(cover),
                    }
                )

    return (
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(run, f"id {id_type}, lang_pred string, score double, coverage double")
        .withColumnRenamed("id", id_col)
    )


def keep_identified(
    documents: DataFrame,
    filters: LanguageFilters,
    text_col: str = "text",
    min_coverage: float = 0.2,
) -> DataFrame:
    """The rows of ``documents``, as they are, whose text is in a learned language."""
    spark = documents.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, text_col, _SLICE):
                texts = pa.record_batch({"text": batch.column(text_col)})
                names, _, cover = _predict(shared.value, texts)
                keep = (np.array(names) != "und") & (cover >= min_coverage)
                yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)
