"""Alignment of two tokenizers' pieces by an associative monoid of fragments.

A document is a blank and its text.  Tokenizer A (byte-level merges) and B
(pieces with byte fallback) both cut these bytes into tokens; where tokens of
both end, a group closes.  A byte range sees the tokens that end in it.  Its
fragment is an open prefix (tokens before the first common end), the closed
stretch between its first and last common end, and an open suffix.  Two
neighbours compose: left suffix and right prefix become a closed stretch, or, if
the right range holds no common end, the suffix grows.  Composition is
associative, so ranges of a very long document are tokenized by different tasks
and reduced as a tree.  Closed stretches leave the tree as soon as they close;
only open ends climb it.

Links are pairs of an A and a B token that share bytes.  Laying both cuts over
each other gives intervals, one for each link.  How many documents hold a pair of
ids linked is summed from distinct pairs of slabs of documents; each slab gets
back the counts of its own pairs only, never a table of all pairs.

Neither tokenizer has a token across the end of a word and the blank after it,
so a text is cut there, and a task tokenizes each distinct piece of a slice once.
Where the piece vocabulary had such an entry, the whole text is one piece.

Null and empty texts, and texts that B does not give back byte by byte, have no
tokens: zeros and an empty ``groups``.  Repeated rows and rows without an id
count as documents of their own.  An empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellcast.llm import words as W
from cellcast.session import cut_lineage, ship_package, shuffle_partitions

#: Text bytes aligned at once; text bytes and documents whose pairs are counted together.
_SLICE = 2 << 20
_SLAB = 32 << 20
_SLAB_DOCS = 100_000
#: Text bytes of distinct pieces that are encoded at once.
_RUN = 8 << 10
#: Neighbouring fragments composed by one step of the tree.
_FAN = 16


def default_vocabularies() -> tuple[str, str]:
    """(byte-level ranks, piece model)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """Ids of both tokenizers for pieces of text, and the bytes of every id."""

    def __init__(self, ranks_path: str, model_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.a = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.a_len = np.zeros(max(ranks.values()) + 1, np.int64)
        for entry, rank in ranks.items():
            self.a_len[rank] = len(entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        mark = "▁"
        self.mark = mark.encode()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(mark, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.blank = self.b.piece_to_id(mark)
        #: whether no entry of B crosses from a word into the blank after it
        self.parts = not any(x != mark and y == mark for p in pieces for x, y in zip(p, p[1:]))

    def _one(self, piece: bytes) -> tuple[np.ndarray, np.ndarray, bool]:
        text = piece.decode()
        a = np.array(self.a.encode_ordinary(text), np.int64)
        # B puts the blank before the text itself, but not before an empty one.
        b = self.b.encode(text[1:]) if len(text) > 1 else [self.blank]
        good = b"".join([self.b_bytes[i] for i in b]) == piece
        return a, np.array(b if good else [], np.int64), good

    def encode(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, first A id of each piece, B ids, first B id, whether B gives the piece back).

        Pieces start with a blank.  Those that may stand next to each other, as
        neither tokenizer joins them, are strung together and encoded in long runs.
        """
        _, offs, data = pieces.buffers()
        offsets = np.frombuffer(offs, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        safe = np.zeros(len(pieces), bool)
        if self.parts and len(pieces):
            last = buf[offsets[1:] - 1]
            # The end of white space beyond ASCII is left to the odd ones, with what shares its last byte.
            safe = (last > 32) & ~np.isin(last, _WHITE_ENDS)
            safe &= ~pc.match_substring(pieces, self.mark).to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        good = np.ones(len(pieces), bool)
        order, a_all, b_all, a_n, b_n = [], [], [], [], []
        joined = np.flatnonzero(safe)
        run_of = np.cumsum(sizes[joined]) // _RUN
        runs = np.split(joined, np.flatnonzero(np.diff(run_of)) + 1) if len(joined) else []
        odd = np.flatnonzero(~safe).tolist()
        texts = [b"".join(pieces.take(pa.array(r)).to_pylist()) for r in runs]
        all_b = self.b.encode([t.decode()[1:] for t in texts], num_threads=1) if texts else []
        for run, text, b in zip(runs, texts, all_b):
            ends = np.cumsum(sizes[run])
            a, b = np.array(self.a.encode_ordinary(text.decode()), np.int64), np.array(b, np.int64)
            a_ends, b_ends = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
            i, j = np.searchsorted(a_ends, ends, "right"), np.searchsorted(b_ends, ends, "right")
            whole = b"".join([self.b_bytes[x] for x in b.tolist()]) == text
            if not whole or (a_ends[i - 1] != ends).any() or (b_ends[j - 1] != ends).any():
                odd.extend(run.tolist())  # one of them is odd: each by itself
                continue
            order.append(run)
            a_all.append(a)
            b_all.append(b)
            a_n.append(np.diff(i, prepend=0))
            b_n.append(np.diff(j, prepend=0))
        for k in odd:
            a, b, good[k] = self._one(pieces[k].as_py())
            order.append(np.array([k]))
            a_all.append(a)
            b_all.append(b)
            a_n.append(np.array([len(a)]))
            b_n.append(np.array([len(b)]))
        none = np.zeros(0, np.int64)
        place = np.concatenate([none, *order])

        def starts(counts: list[np.ndarray]) -> np.ndarray:
            """First id and number of ids of every piece, though the ids stand in another order."""
            n = np.concatenate([none, *counts])
            out = np.empty((2, len(pieces)), np.int64)
            out[0, place], out[1, place] = np.cumsum(n) - n, n
            return out

        return np.concatenate([none, *a_all]), starts(a_n), np.concatenate([none, *b_all]), starts(b_n), good


#: Last bytes of white space beyond ASCII: U+0085, U+00A0, U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000.
_WHITE_ENDS = np.array(sorted({chr(c).encode()[-1] for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}), np.uint8)


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def _tokenizers(paths: tuple[str, str]) -> Tokenizers:
    if paths not in _LOADED:
        _LOADED[paths] = Tokenizers(*paths)
    return _LOADED[paths]


def piece_starts(buf: np.ndarray, offsets: np.ndarray, parts: bool) -> np.ndarray:
    """Starts of the pieces of texts that each begin with a blank.

    A piece starts at a text's start and at a blank after a character that is no
    white space (after some characters that share bytes with white space it does
    not, which only makes pieces longer).
    """
    if not parts or not len(buf):
        return offsets[:-1]
    blank = buf == 32
    before = np.zeros((3, len(buf)), np.uint8)
    for back in (1, 2, 3):
        before[back - 1, back:] = buf[:-back]
    one, two, three = before
    white = (one == 32) | ((one >= 9) & (one <= 13)) | ((one >= 28) & (one <= 31))
    white |= (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    white |= ((three >= 0xE1) & (three <= 0xE3)) & ((two == 0x9A) | (two == 0x80) | (two == 0x81))
    head = blank & ~white
    head[offsets[:-1]] = True
    return np.flatnonzero(head)


class Tokens:
    """A and B tokens of a run of documents: ids, ends in the common buffer, and which documents hold."""

    def __init__(self, tok: Tokenizers, buf: np.ndarray, offsets: np.ndarray):
        starts = piece_starts(buf, offsets, tok.parts)
        bounds = np.append(starts, len(buf)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(buf)]
        ).dictionary_encode()
        a_ids, a_of, b_ids, b_of, good = tok.encode(pieces.dictionary)
        index = pieces.indices.to_numpy(zero_copy_only=False)
        bad = ~good[index]
        owner = np.searchsorted(offsets, starts, "right") - 1
        #: documents that B gives back
        self.ok = np.ones(len(offsets) - 1, bool)
        self.ok[owner[bad]] = False
        index = index[self.ok[owner]]
        owner = owner[self.ok[owner]]
        self.a, a_owner = _gather(a_ids, a_of, index, owner)
        self.b, b_owner = _gather(b_ids, b_of, index, owner)
        self.a_first = np.searchsorted(a_owner, np.arange(len(offsets)))
        self.b_first = np.searchsorted(b_owner, np.arange(len(offsets)))
        # Lengths of earlier documents that hold, so that ends ascend over the run.
        sizes = np.where(self.ok, np.diff(offsets), 0)
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.a_ends = np.cumsum(tok.a_len[self.a])
        self.b_ends = np.cumsum(tok.b_len[self.b])


def _gather(ids: np.ndarray, of: np.ndarray, index: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces in order, and the document of each id; ``of``: first id and number by piece."""
    first, n = of[0, index], of[1, index]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(n) else 0) + np.repeat(first - (ends - n), n)
    return ids[at], np.repeat(owner, n)


class Overlay:
    """Both cuts of one stretch of bytes: an interval between neighbouring ends is a link."""

    def __init__(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray):
        size = int(a_ends[-1]) if len(a_ends) else 0
        flags = np.zeros(size + 1, np.uint8)
        flags[a_ends] = 1
        flags[b_ends] |= 2
        self.a, self.b = a, b
        #: where the intervals end, and whether an A, a B token ends there
        self.ends = np.flatnonzero(flags)
        self.is_a, self.is_b = flags[self.ends] & 1 > 0, flags[self.ends] & 2 > 0
        self.a_at, self.b_at = np.cumsum(self.is_a) - self.is_a, np.cumsum(self.is_b) - self.is_b
        both = self.is_a & self.is_b
        self.common = self.ends[both]
        #: tokens up to and with each common end, and the group of each interval
        self.a_upto, self.b_upto = self.a_at[both] + 1, self.b_at[both] + 1
        self.group = np.cumsum(both) - both

    def codes(self) -> np.ndarray:
        """The pair of ids of every link."""
        return (self.a[self.a_at] << 16) | self.b[self.b_at]

    def text(self) -> tuple[memoryview, np.ndarray]:
        """All groups as text, each followed by ``;``, and where each token's text starts in it
        (tokens in the order of the text)."""
        # A's tokens of a group stand after B's of all groups before, B's after A's of this group too.
        a_at = np.arange(len(self.a)) + np.concatenate([[0], self.b_upto])[self.group[self.is_a]]
        b_at = np.arange(len(self.b)) + self.a_upto[self.group[self.is_b]]
        out = np.empty(len(self.a) + len(self.b), np.int64)
        out[a_at], out[b_at] = self.a, self.b
        out[a_at[self.a_upto - 1]] += 1 << 16
        out[b_at[self.b_upto - 1]] += 2 << 16
        letters, width = _texts()
        n = width[out]
        written = letters[out][np.arange(letters.shape[1]) < n[:, None]]
        return memoryview(written.tobytes()), np.concatenate([[0], np.cumsum(n, dtype=np.int64)])


_TEXTS: list[tuple[np.ndarray, np.ndarray]] = []


def _texts() -> tuple[np.ndarray, np.ndarray]:
    """Every id followed by ``,``, ``|`` and ``;``: rows of letters, and how many count."""
    if not _TEXTS:
        made = [str(i).encode() + s for s in (b",", b"|", b";") for i in range(1 << 16)]
        letters = np.frombuffer(b"".join(x.ljust(6) for x in made), np.uint8).reshape(-1, 6)
        _TEXTS.append((letters, np.array([len(x) for x in made], np.uint8)))
    return _TEXTS[0]


_SLAB_SCHEMA = pa.schema(
    [
        ("id", pa.list_(pa.int64())),
        ("n_a", pa.list_(pa.int64())),
        ("n_b", pa.list_(pa.int64())),
        ("n_groups", pa.list_(pa.int64())),
        ("n_links", pa.list_(pa.int64())),
        ("sha", pa.list_(pa.string())),
        ("n_pairs", pa.list_(pa.int32())),
        ("pairs", pa.binary()),
        ("times", pa.binary()),
        ("code", pa.list_(pa.int64())),
        ("docs", pa.list_(pa.int64())),
    ]
)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of texts with a blank before each; null and empty texts have no bytes at all."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    texts = pc.if_else(pc.equal(texts, nothing), texts, pc.binary_join_element_wise(blank, texts, nothing))
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


class _Slab:
    """Results of a run of documents, and the distinct pairs of ids of each."""

    def __init__(self):
        self.columns: list[list] = [[] for _ in range(7)]
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.bytes = 0

    def add(self, tok: Tokenizers, ids: list, buf: np.ndarray, offsets: np.ndarray) -> None:
        filled = np.flatnonzero(np.diff(offsets) > 0)
        t = Tokens(tok, buf, np.append(offsets[filled], len(buf)))
        laid = Overlay(t.a, t.a_ends, t.b, t.b_ends)
        text, place = laid.text()
        first_link = np.searchsorted(laid.ends, t.at, "right")
        first_group = np.searchsorted(laid.common, t.at, "right")
        doc = np.repeat(np.arange(len(filled)), np.diff(first_link))
        distinct, times = np.unique((doc << 32) | laid.codes(), return_counts=True)
        n_pairs = np.zeros(len(ids), np.int64)
        n_pairs[filled] = np.bincount(distinct >> 32, minlength=len(filled))
        zero = np.zeros((4, len(ids)), np.int64)
        for row, values in zip(zero, (t.a_first, t.b_first, first_group, first_link)):
            row[filled] = np.diff(values)
        sha = [""] * len(ids)
        cuts = place[t.a_first + t.b_first].tolist()
        for d, at in enumerate(filled.tolist()):
            if t.ok[d]:
                sha[at] = hashlib.sha256(text[cuts[d] : cuts[d + 1] - 1]).hexdigest()
        for column, values in zip(self.columns, (ids, *[z.tolist() for z in zero], sha, n_pairs.tolist())):
            column.extend(values)
        self.pairs.append((distinct & 0xFFFFFFFF).astype("<u4"))
        self.times.append(times.astype("<u4"))
        self.bytes += len(buf)

    def row(self) -> pa.RecordBatch:
        pairs = np.concatenate(self.pairs) if self.pairs else np.zeros(0, "<u4")
        times = np.concatenate(self.times) if self.times else np.zeros(0, "<u4")
        code, docs = np.unique(pairs, return_counts=True)
        values = [*self.columns, pairs.tobytes(), times.tobytes(), code.astype(np.int64), docs.astype(np.int64)]
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, _SLAB_SCHEMA)], _SLAB_SCHEMA)


def _align(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizers(paths)
        slab = _Slab()
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                slab.add(tok, part.column("id").to_pylist(), *_buffer(part.column("text")))
                if slab.bytes >= _SLAB or len(slab.columns[0]) >= _SLAB_DOCS:
                    yield slab.row()
                    slab = _Slab()
        if slab.columns[0]:
            yield slab.row()

    return run


# ---- very long documents: fragments of byte ranges


class Fragment:
    """Open prefix, whether a common end was seen, and open suffix with the place where it starts."""

    def __init__(self, prefix, bounded: bool, suffix, at: int):
        self.prefix, self.bounded, self.suffix, self.at = prefix, bounded, suffix, at

    def compose(self, right: Fragment, closed: list) -> Fragment:
        """The fragment of both ranges; the stretch that closes between them goes to ``closed``."""
        joint = tuple(np.concatenate(x) for x in zip(self.suffix if self.bounded else self.prefix, right.prefix))
        if not right.bounded:
            if self.bounded:
                return Fragment(self.prefix, True, joint, self.at)
            return Fragment(joint, False, joint, self.at)
        if not self.bounded:
            return Fragment(joint, True, right.suffix, right.at)
        if len(joint[0]) or len(joint[1]):
            closed.append((self.at, *joint))
        return Fragment(self.prefix, True, right.suffix, right.at)


def fragment(a, a_ends, b, b_ends) -> tuple[Fragment, tuple | None]:
    """The fragment of tokens that end in one range, and its closed stretch (start, A ids, B ids)."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    if not len(common):
        return Fragment((a, b), False, (a, b), 0), None
    i, j = np.searchsorted(a_ends, common[[0, -1]]) + 1
    k, m = np.searchsorted(b_ends, common[[0, -1]]) + 1
    made = Fragment((a[:i], b[:k]), True, (a[j:], b[m:]), int(common[-1]))
    return made, (int(common[0]), a[i:j], b[k:m]) if j > i else None


_FRAGMENT = "row long, place long, ok boolean, closed boolean, at long, bounded boolean, a1 binary, b1 binary, a2 binary, b2 binary"
_FRAGMENT_ARROW = pa.schema(
    [
        ("row", pa.int64()),
        ("place", pa.int64()),
        ("ok", pa.bool_()),
        ("closed", pa.bool_()),
        ("at", pa.int64()),
        ("bounded", pa.bool_()),
        ("a1", pa.binary()),
        ("b1", pa.binary()),
        ("a2", pa.binary()),
        ("b2", pa.binary()),
    ]
)


def _pack(ids: np.ndarray) -> bytes:
    return ids.astype("<u2").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2").astype(np.int64)


def _fragment_row(row: int, place: int, f: Fragment) -> tuple:
    return (row, place, True, False, f.at, f.bounded, *map(_pack, f.prefix), *map(_pack, f.suffix))


def _closed_row(row: int, at: int, a: np.ndarray, b: np.ndarray) -> tuple:
    return (row, 0, True, True, at, True, _pack(a), _pack(b), b"", b"")


def _fragments(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_FRAGMENT_ARROW)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _FRAGMENT_ARROW)], _FRAGMENT_ARROW)


def _cut_long(paths: tuple[str, str], segment: int):
    """Texts to segments of whole pieces: (row, start, data)."""
    names = ["row", "start", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _tokenizers(paths).parts
        for batch in batches:
            for i in range(batch.num_rows):
                buf, offsets = _buffer(batch.column("text").slice(i, 1))
                starts = piece_starts(buf, offsets, parts)
                # The first piece that starts in each stretch of ``segment`` bytes heads a segment.
                cuts = starts[np.unique(starts // segment, return_index=True)[1]].tolist()
                row = batch.column("row")[i].as_py()
                for lo, hi in zip(cuts, [*cuts[1:], len(buf)]):
                    yield pa.record_batch(
                        [pa.array([row], pa.int64()), pa.array([lo], pa.int64()), pa.array([buf[lo:hi].tobytes()])],
                        names,
                    )

    return run


def _align_segments(paths: tuple[str, str], span: int):
    """Tokens of each segment, dealt to ranges of ``span`` bytes by where they end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizers(paths)
        for batch in batches:
            for row, start, data in zip(*[batch.column(c).to_pylist() for c in ("row", "start", "data")]):
                t = Tokens(tok, np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64))
                if not t.ok[0]:
                    yield _fragments([(row, start, False, False, 0, False, b"", b"", b"", b"")])
                    continue
                a_ends, b_ends = t.a_ends + start, t.b_ends + start
                out = []
                first, last = start // span, (start + len(data) - 1) // span
                edges = np.arange(first, last + 1) * span + span
                i = np.concatenate([[0], np.searchsorted(a_ends, edges, "right")])
                k = np.concatenate([[0], np.searchsorted(b_ends, edges, "right")])
                for r in range(len(edges)):
                    mine = slice(i[r], i[r + 1]), slice(k[r], k[r + 1])
                    if mine[0].start == mine[0].stop and mine[1].start == mine[1].stop:
                        continue
                    f, stretch = fragment(t.a[mine[0]], a_ends[mine[0]], t.b[mine[1]], b_ends[mine[1]])
                    # Ranges and segments both ascend with this place.
                    out.append(_fragment_row(row, max(start, int(edges[r]) - span), f))
                    if stretch:
                        out.append(_closed_row(row, *stretch))
                yield _fragments(out)

    return run


def _compose(table: pa.Table) -> pa.Table:
    """Neighbouring fragments of a document to one; stretches that close go along."""
    rows = sorted(table.to_pylist(), key=lambda r: r["place"])
    closed: list[tuple] = []
    made = None
    for r in rows:
        f = Fragment((_unpack(r["a1"]), _unpack(r["b1"])), r["bounded"], (_unpack(r["a2"]), _unpack(r["b2"])), r["at"])
        made = f if made is None else made.compose(f, closed)
    row = rows[0]["row"]
    out = [_fragment_row(row, rows[0]["place"], made), *[_closed_row(row, *c) for c in closed]]
    return pa.Table.from_batches([_fragments(out)])


def _long_parts(long: DataFrame, paths: tuple[str, str], segment: int, span: int) -> DataFrame:
    """(row, at, a1, b1): ids of the closed stretches of very long documents; none of those without tokens."""
    parts = shuffle_partitions(long.sparkSession)
    segments = long.select("row", "text").mapInArrow(_cut_long(paths, segment), "row long, start long, data binary")
    level = cut_lineage(
        segments.repartition(parts, "row", "start").mapInArrow(_align_segments(paths, span), _FRAGMENT), "fragments"
    )
    bad = level.where("not ok").select("row").distinct()
    good = level.join(bad, "row", "left_anti")
    stretches = [good.where("closed")]
    # Numbers without gaps in each document, so that the tree has no empty branch.
    number = F.row_number().over(Window.partitionBy("row").orderBy("place")) - 1
    order = good.where("not closed").withColumn("place", number.cast("bigint"))
    order = cut_lineage(order, "fragments")
    while (order.agg(F.max("place")).first()[0] or 0) > 0:
        step = (
            order.groupBy("row", F.floor(F.col("place") / _FAN).alias("branch"))
            .applyInArrow(_compose, _FRAGMENT)
        )
        step = cut_lineage(step, "fragments")
        stretches.append(step.where("closed"))
        order = step.where("not closed").withColumn("place", F.floor(F.col("place") / _FAN))
    # The start of a document is a common end, and so is its end.
    stretches.append(order.where("bounded").withColumn("at", F.lit(-1).cast("bigint")))
    whole = stretches[0].select("row", "at", "a1", "b1")
    for s in stretches[1:]:
        whole = whole.unionByName(s.select("row", "at", "a1", "b1"))
    return whole


_PART = "row long, at long, n_a long, n_b long, n_groups long, n_links long, groups binary, code array<long>, times array<long>"


def _part_pairs(paths: tuple[str, str]):
    """Counts, groups as text and pairs of every closed stretch."""
    types = [pa.int64()] * 6 + [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [f.split()[0] for f in _PART.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizers(paths)
        for batch in batches:
            out = []
            for row, at, a, b in zip(*[batch.column(c).to_pylist() for c in ("row", "at", "a1", "b1")]):
                a, b = _unpack(a), _unpack(b)
                a_ends, b_ends = np.cumsum(tok.a_len[a]), np.cumsum(tok.b_len[b])
                laid = Overlay(a, a_ends, b, b_ends)
                code, times = np.unique(laid.codes(), return_counts=True)
                counts = len(a), len(b), len(laid.common), len(laid.ends)
                out.append((row, at, *counts, laid.text()[0].tobytes(), code.tolist(), times.tolist()))
            columns = list(zip(*out)) if out else [()] * len(types)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


# ---- counts back to the documents


_RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_RESULT_ARROW = pa.schema(
    [("id", pa.int64())] + [(c, pa.int64()) for c in "n_a n_b n_groups n_links n_best count_sum".split()]
    + [("groups_sha256", pa.string())]
)


def _settle(slab: pa.Table, counts: pa.Table) -> pa.Table:
    """A slab's documents with the counts of its pairs."""
    code = counts.column("code").to_numpy()
    order = np.argsort(code)
    code = code[order]
    n = counts.column("docs").to_numpy()[order]
    best = counts.column("best").to_numpy()[order]
    tables = []
    for r in slab.to_pylist():
        pairs = np.frombuffer(r["pairs"], "<u4").astype(np.int64)
        times = np.frombuffer(r["times"], "<u4").astype(np.int64)
        at = np.searchsorted(code, pairs)
        ends = np.cumsum(np.array(r["n_pairs"], np.int64))

        def per_doc(values):
            sums = np.concatenate([[0], np.cumsum(values)])
            return np.diff(sums[np.concatenate([[0], ends])])

        own = n[at] if len(at) else np.zeros(0, np.int64)
        top = own == (best[at] if len(at) else own)
        columns = [
            r["id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], per_doc(times * top), per_doc(times * own), r["sha"],
        ]
        tables.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT_ARROW)], schema=_RESULT_ARROW))
    return pa.concat_tables(tables) if tables else _RESULT_ARROW.empty_table()


def align_tokens(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabularies: tuple[str, str] | None = None,
    long_bytes: int = 64 << 10,
    segment: int = 16 << 10,
    span: int = 4 << 10,
) -> DataFrame:
    """One row per row: the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups_sha256``.

    Texts of more than ``long_bytes`` are cut into segments of about ``segment``
    bytes, which different tasks tokenize; fragments cover ``span`` bytes.
    """
    spark = documents.sparkSession
    ship_package(spark)
    paths = vocabularies or default_vocabularies()
    docs = documents.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    is_long = F.coalesce(F.octet_length("text") > long_bytes, F.lit(False))

    slab_schema = (
        "id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
        "sha array<string>, n_pairs array<int>, pairs binary, times binary, code array<long>, docs array<long>"
    )
    slabs = docs.where(~is_long).select("id", "text").mapInArrow(_align(paths), slab_schema)
    slabs = cut_lineage(slabs.withColumn("slab", F.monotonically_increasing_id()), "slabs")
    known = slabs.select("slab", F.explode(F.arrays_zip("code", "docs")).alias("p")).select("slab", "p.code", "p.docs")

    # Written with its numbers, as every later job must see the same ones.
    long = cut_lineage(docs.where(is_long), "long-docs")
    parts = _long_parts(long.select("row", "text"), paths, segment, span)
    parts = cut_lineage(
        parts.repartition(shuffle_partitions(spark), "row", "at").mapInArrow(_part_pairs(paths), _PART), "long-parts"
    )
    long_pairs = (
        parts.select("row", F.explode(F.arrays_zip("code", "times")).alias("p"))
        .groupBy("row", F.col("p.code").alias("code"))
        .agg(F.sum("p.times").alias("times"))
    )
    long_pairs = cut_lineage(long_pairs, "long-pairs")

    each = known.select("code", "docs").unionByName(long_pairs.select("code", F.lit(1).cast("bigint").alias("docs")))
    counts = cut_lineage(each.groupBy("code").agg(F.sum("docs").alias("docs")), "pair-counts")
    first = F.shiftright("code", 16)
    best = counts.groupBy(first.alias("a")).agg(F.max("docs").alias("best"))
    counts = counts.withColumn("a", first).join(best, "a").select("code", "docs", "best")

    back = known.select(F.col("slab").alias("of"), "code").join(counts, "code")
    settled = slabs.drop("code", "docs").groupBy("slab").cogroup(back.groupBy("of")).applyInArrow(_settle, _RESULT)

    long_sums = (
        long_pairs.join(counts, "code")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("docs") == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
        )
    )
    # The groups of one document, in order; its text is no longer than the row it came in.
    ordered = F.array_sort(F.collect_list(F.struct("at", "groups")))
    joined = F.aggregate(ordered, F.lit("").cast("binary"), lambda acc, p: F.concat(acc, p["groups"]))
    per_doc = parts.groupBy("row").agg(
        *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")], joined.alias("groups")
    )
    whole = F.expr("substring(groups, 1, octet_length(groups) - 1)")
    per_doc = per_doc.withColumn("groups_sha256", F.sha2(whole, 256)).drop("groups")
    zeros = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    finished = (
        long.select("id", "row").join(per_doc, "row", "left").join(long_sums, "row", "left")
        .select("id", *[F.coalesce(c, F.lit(0)).alias(c) for c in zeros], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    )
    return settled.unionByName(finished).withColumnRenamed("id", id_col)
