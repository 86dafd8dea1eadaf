"""Sharding, token alignment and the prefix trie against brute-force versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellcast.llm import prefix_trie, queries, sharding, token_align

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- 11


def brute_shards(placed_rows, shards, law, replicas):
    """One row after the other: (row, key position, order, weight) to shards."""
    ring = sharding.ring(shards, replicas)
    total = sum(r["weight"] for r in placed_rows)
    room = {s: total // shards + (s < total % shards) for s in range(shards)}
    closed, out, waiting = {s for s in room if room[s] <= 0}, {}, list(placed_rows)
    while waiting and len(closed) < shards:
        asked = defaultdict(list)
        for r in waiting:
            at = next((i for i, (p, _) in enumerate(ring) if p >= r["position"]), 0)
            while ring[at % len(ring)][1] in closed:
                at += 1
            asked[ring[at % len(ring)][1]].append(r)
        waiting = []
        for s, mine in asked.items():
            for r in sorted(mine, key=lambda r: (r["order"], r["row"])):
                if room[s] > 0:
                    out[r["row"]] = s
                    room[s] -= r["weight"]
                else:
                    waiting.append(r)
        closed = {s for s in room if room[s] <= 0}
    return out


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_sharding(spark, odd_docs, law, monkeypatch):
    monkeypatch.setattr(sharding, "_FEW", 4)
    monkeypatch.setattr(sharding, "_CELL_ROWS", 7)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    got = sharding.shard_documents(docs, shards=5, law=law, replicas=16).collect()
    assert len(got) == docs.count()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    base = docs.select(
        F.col("doc_id").alias("key"),
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"),
        F.monotonically_increasing_id().alias("row"),
    ).selectExpr("*", "xxhash64(key, size, crc, 1) as order", "xxhash64(key) as position")
    base = [r.asDict() | {"weight": r["size"] if law == "bytes" else 1} for r in base.collect()]
    brute = brute_shards(base, 5, law, 16)
    by_row = Counter((r["key"], r["size"], r["crc"], brute[r["row"]]) for r in base)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in got) == by_row
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if law == "rows":
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_sharding_hot_key_and_equal_rows(spark, no_docs, monkeypatch):
    """Half of the rows are one row repeated; shards stay balanced and nothing is lost."""
    monkeypatch.setattr(sharding, "_FEW", 8)
    docs = spark.range(3000).selectExpr(
        "case when id % 2 = 0 then 7 when id % 5 = 0 then null else id end as doc_id",
        "case when id % 2 = 0 then 'same' else concat('text ', id) end as text",
        "id as shard",
    )
    got = sharding.shard_documents(docs, shards=7, replicas=32)
    counts = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert len(counts) == 7 and sum(counts) == 3000 and max(counts) - min(counts) <= 1
    assert got.select("shard", "slot").distinct().count() == 3000
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sharding.shard_documents(no_docs).count() == 0
    few = sharding.shard_documents(docs.limit(2), shards=7).collect()
    assert len({r.shard for r in few}) == 2
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, law="other")


def test_sharding_moves_little(spark):
    """One shard more: rows move into it, and few others move."""
    docs = spark.range(20_000).selectExpr("id as doc_id", "concat('t', id) as text")
    before = dict(rows(sharding.shard_documents(docs, 8, slack=0.1).select("doc_id", "shard")))
    after = dict(rows(sharding.shard_documents(docs, 9, slack=0.1).select("doc_id", "shard")))
    moved = [k for k in before if before[k] != after[k]]
    into_new = sum(after[k] == 8 for k in moved)
    assert 0.08 < into_new / len(before) < 0.15
    assert len(moved) - into_new < 0.05 * len(before)


def test_next_open():
    nodes = [(-5, 0), (0, 1), (3, 0), (9, 2)]
    assert sharding.next_open(nodes, set()) == [0, 1, 0, 2]
    assert sharding.next_open(nodes, {0}) == [1, 1, 2, 2]
    assert sharding.next_open(nodes, {0, 2}) == [1, 1, 1, 1]


# ---- 12


@pytest.fixture(scope="module")
def tok():
    return token_align.Tokenizers(*token_align.default_vocabularies())


def brute_alignment(tok, data):
    """Rows of align_tokens from whole texts, token by token."""
    docs = []
    a_bytes = [tok.a.decode_single_token_bytes(i) for i in range(50256)]
    for doc, text in data:
        whole = (" " + (text or "")).encode()
        a = tok.a.encode_ordinary(whole.decode()) if text else []
        b = tok.b.encode(text) if text else []
        good = text and b"".join(a_bytes[i] for i in a) == whole and b"".join(tok.b_bytes[i] for i in b) == whole
        docs.append((doc, a if good else [], b if good else []))
    pairs, held = [], Counter()
    for _, a, b in docs:
        spans_a, spans_b, at = [], [], 0
        for i in a:
            spans_a.append((at, at := at + len(a_bytes[i]), i))
        at = 0
        for i in b:
            spans_b.append((at, at := at + len(tok.b_bytes[i]), i))
        mine, j = [], 0
        for lo, hi, i in spans_a:
            while j < len(spans_b) and spans_b[j][1] <= lo:
                j += 1
            k = j
            while k < len(spans_b) and spans_b[k][0] < hi:
                mine.append((i, spans_b[k][2]))
                k += 1
        pairs.append((spans_a, spans_b, mine))
        held.update(set(mine))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for (doc, a, b), (spans_a, spans_b, mine) in zip(docs, pairs):
        common = sorted({s[1] for s in spans_a} & {s[1] for s in spans_b})
        groups, lo = [], 0
        for hi in common:
            ga = ",".join(str(s[2]) for s in spans_a if lo < s[1] <= hi)
            gb = ",".join(str(s[2]) for s in spans_b if lo < s[1] <= hi)
            groups.append(f"{ga}|{gb}")
            lo = hi
        text = ";".join(groups)
        counts = [held[p] for p in mine]
        out.append(
            (doc, len(a), len(b), len(groups), len(mine), sum(held[p] == best[p[0]] for p in mine), sum(counts),
             hashlib.sha256(text.encode()).hexdigest() if a else "")
        )
    return Counter(out)


ODD = [
    (1, "plain words, and some more"),
    (1, "plain words, and some more"),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "  two  blanks \n and\t tabs \n\n  x  "),
    (6, "a ▁ mark that B gives back as a blank"),
    (7, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (8, "Ünïcödé ßtraße 日本語 no blanks here 한국어 🎉🎉 ﬁ ½"),
    (9, "x" * 300 + " " + "0123456789abcdef" * 40),
    (10, "non breaking  blank, em  space　 wide \u0085 next"),
    (None, "no id"),
    (11, "line\r\nline\r\n line \x1c  sep \x0b v"),
    (12, "\x00nul ﻿bom é ​ zero"),
    (13, "trailing blank "),
]


def test_alignment(spark, tok):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    data = docs + ODD
    df = spark.createDataFrame([(i, t, "x", i) for i, t in data], "doc_id long, text string, n_a string, row long")
    want = brute_alignment(tok, [d for d in data])
    assert Counter(rows(token_align.align_tokens(df))) == want
    # Every text as a very long one: fragments of a few bytes from many segments.
    assert Counter(rows(token_align.align_tokens(df, long_bytes=1, segment=64, span=7))) == want
    assert Counter(rows(token_align.align_tokens(df, long_bytes=400, segment=200, span=50))) == want


def test_alignment_edges(spark, tok, odd_docs, no_docs):
    assert token_align.align_tokens(no_docs).count() == 0
    got = token_align.align_tokens(odd_docs)
    assert got.columns[0] == "doc_id" and len(got.collect()) == odd_docs.count()
    only_empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {r[1:] for r in rows(token_align.align_tokens(only_empty))} == {(0, 0, 0, 0, 0, 0, "")}


def test_pieces_encode_like_whole_texts(tok):
    """Cutting a text into pieces changes no token."""
    rng = np.random.default_rng(5)
    alphabet = list("ab, .'1\n\t\r\x0b\x1c  ") + ["é", " ", " ", "　", "\u0085", "—", "日", " ", "'s", "▂"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet, rng.integers(1, 40)))
        buf = np.frombuffer((" " + text).encode(), np.uint8)
        t = token_align.Tokens(tok, buf, np.array([0, len(buf)]))
        assert t.a.tolist() == tok.a.encode_ordinary(" " + text)
        assert t.ok[0] and t.b.tolist() == tok.b.encode(text)


def test_composition_is_associative(tok):
    rng = np.random.default_rng(3)
    text = "some words to cut, übergrößenträger 日本語 and 0123456789 more"
    buf = np.frombuffer((" " + text).encode(), np.uint8)
    t = token_align.Tokens(tok, buf, np.array([0, len(buf)]))

    def frag(lo, hi):
        i = np.searchsorted(t.a_ends, [lo, hi], "right")
        k = np.searchsorted(t.b_ends, [lo, hi], "right")
        return token_align.fragment(t.a[i[0] : i[1]], t.a_ends[i[0] : i[1]], t.b[k[0] : k[1]], t.b_ends[k[0] : k[1]])

    def plain(f):
        return [x.tolist() for x in (*f.prefix, *f.suffix)], f.bounded

    for _ in range(50):
        cuts = sorted(rng.choice(np.arange(1, len(buf)), 2, replace=False))
        (x, xs), (y, ys), (z, zs) = (frag(a, b) for a, b in zip([0, *cuts], [*cuts, len(buf)]))
        left, right, one = [], [], []
        a = x.compose(y, left).compose(z, left)
        b = x.compose(y.compose(z, right), right)
        assert plain(a) == plain(b)
        key = lambda c: (c[1].tolist(), c[2].tolist())
        assert sorted(map(key, left)) == sorted(map(key, right))
        whole, _ = frag(0, len(buf))
        assert plain(whole)[0][:2] == plain(a)[0][:2]


# ---- 13


def brute_trie(data):
    """Nodes of the rebuilt conversations' trie, prefix by prefix."""
    own = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, v in own.items()}
    members = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        members[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h]) + tuple(own[c][h:])
    under = defaultdict(list)
    for c, turns in members.items():
        for d in range(len(turns) + 1):
            under[turns[:d]].append(c)
    kids = defaultdict(list)
    for p in under:
        if p:
            kids[p[:-1]].append(p)

    def words(p):
        return len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0

    def total(p):
        saved, leaves = (len(under[p]) - 1) * words(p), int(not kids[p])
        for k in kids[p]:
            s, n = total(k)
            saved, leaves = saved + s, leaves + n
        return saved, leaves

    out = []
    for p in list(under):
        ends = sorted(c for c in under[p] if members[c] == p)
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        saved, leaves = total(p)
        parent = min(under[p[:-1]]) if p else None
        out.append((min(under[p]), len(p), parent, len(under[p]), len(kids[p]), leaves, saved, sha))
    return Counter(out)


def trie_rows(df, block=8):
    turns, convs = prefix_trie.share_heads(prefix_trie.ordered_turns(df))
    return Counter(rows(prefix_trie.prefix_trie(turns, convs, block)))


SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def odd_talk():
    out = []
    for c in range(0, 130, 3):
        for t in range(c % 9):
            out.append((c, t, "user" if t % 2 else None, f"turn {t} of kind {c % (2 + t)}" if t % 4 else "hello there", "x"))
    out += [(500 + i, t, "user", f"long {t // 4}", None) for i in range(3) for t in range(20 + i)]
    out += [(7, None, "a", "first"), (7, 1, "b", None), (21, 0, None, None), (22, 0, "q", "alone"), (-41, 2, "u", "minus  words here")]
    out += [(-41, 1, "u", "x"), (-41, 3, "u", ""), (-41, 4, "w", "y z"), (None, 1, "user", "no conversation"), (600, 1, "u", "same"), (600, 1, "u", "same")]
    return [(*r, None)[:5] for r in out]


@pytest.mark.parametrize("block", [1, 3, 8])
def test_prefix_trie(spark, block):
    data = odd_talk()
    df = spark.createDataFrame(data, SCHEMA)
    assert trie_rows(df, block) == brute_trie([r[:4] for r in data])


def test_prefix_trie_given_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    got = Counter(rows(queries.QUERIES["op13_prefix_trie"](spark, SF)))
    assert got == brute_trie(pd.read_parquet(f"{SF}/conversations.parquet").itertuples(index=False, name=None))
    assert trie_rows(df.limit(0)) == Counter()


def test_prefix_trie_hot_conversations(spark, monkeypatch):
    """Hundreds of equal conversations and one very long one; small strings of ids and runs of blocks."""
    monkeypatch.setattr(prefix_trie, "_FAN", 4)
    data = [(c, t, "u", f"t{t}", None) for c in range(1000, 1300) for t in range(3)]
    data += [(5, t, "u", f"w {t}", None) for t in range(240)]
    df = spark.createDataFrame(data, SCHEMA)
    assert trie_rows(df, 4) == brute_trie([r[:4] for r in data])


def test_end_digests_in_pieces():
    """Ids of a node come in several strings and batches."""
    import pyarrow as pa

    old, prefix_trie._IDS = prefix_trie._IDS, 3
    try:
        ids = list(range(8, 20))
        node = lambda n: [pa.array([1] * n, pa.int64())] * 5
        names = ["depth", "k1", "k2", "k3", "k4", "conv"]
        batches = [pa.record_batch([*node(5), pa.array(ids[:5])], names), pa.record_batch([*node(7), pa.array(ids[5:])], names)]
        strings = [b for b in prefix_trie._chunk_ids(iter(batches))]
        assert sum(b.num_rows for b in strings) == 4
        (digest,) = [x for b in prefix_trie._hash_ids(iter(strings)) for x in b.column("ends_sha256").to_pylist()]
        assert digest == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    finally:
        prefix_trie._IDS = old
