"""Ranked search, token alignment and sharding against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelflux.llm import alignment, lexical, queries, sharding

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
A, B = queries.tokenizer(), queries.tokenizer("piece_bpe_32k.model")


# ranked search


def brute_search(docs, items, top=20):
    """{(item_id, text): [(score, doc_id) ...]} by scoring every document."""
    found = [Counter(TERM.findall((t or "").translate(UPPER))) for _, t in docs]
    n = sum(1 for c in found if c)
    total = sum(sum(c.values()) for c in found)
    df = Counter(t for c in found for t in c)
    out = {}
    for item_id, text in set(items):
        asked = Counter(TERM.findall((text or "").translate(UPPER)))
        scored = []
        for (doc_id, _), c in zip(docs, found, strict=True):
            if not c:
                continue
            m = 75 + 25 * sum(c.values()) * n // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out[item_id, text] = [(i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:top])]
    return out


def searched(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in lexical.search(d, i, **more).collect()), key=repr)


def expected(docs, items, top=20):
    return sorted(((item, *row) for (item, _), rows in brute_search(docs, items, top).items() for row in rows), key=repr)


ITEMS = [(1, "the quick Ünïcödé fox"), (2, ""), (3, None), (4, "zzz nowhere"), (5, "dog dog dog cat"), (6, "漢字 fox-dog")]


def test_search_of_odd_rows(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    rng = random.Random(1)
    words = [w for _, t in docs for w in TERM.findall(t or "")]
    items = [*ITEMS, *((10 + i, " ".join(rng.choices(words, k=12))) for i in range(12)), (10, "another text under a known id"), (None, "ein zwei drei")]
    assert searched(spark, docs, [*items, items[0]]) == expected(docs, items)


def test_search_keeps_all_that_may_win(spark, monkeypatch):
    """Many segments, ties and common words: what is dropped between owners changes nothing."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 30)))) for i in range(900)] + [(1000 + i, "w0 w1 w2 w59") for i in range(60)]
    items = [(i, " ".join(rng.choices(words, weights, k=8))) for i in range(25)] + [(99, "w0 w1 w2 w59")]
    want = expected(docs, items, 5)
    for segment, bundle in ((16, 4), (1 << 15, 256)):
        monkeypatch.setattr(lexical, "SEGMENT_DOCS", segment)
        monkeypatch.setattr(lexical, "BUNDLE", bundle)
        assert searched(spark, docs, items, top=5) == want


def test_search_of_nothing(spark, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(items.select(F.col("item_id").alias("doc_id"), "text"), items.where("1 = 0")).count() == 0


def test_search_ignores_other_columns(spark):
    docs = spark.createDataFrame([(1, "a fox", 5, "x"), (2, "a dog", 6, "y")], "doc_id long, text string, item_id long, score string")
    items = spark.createDataFrame([(7, "fox", 1)], "item_id long, text string, doc_id long")
    assert [(r.item_id, r.rank, r.doc_id) for r in lexical.search(docs, items).collect()] == [(7, 1, 1)]


# alignment


def brute_align(texts):
    own = alignment.Aligner(A, B)
    docs = []
    for t in texts:
        if not t:
            docs.append(None)
            continue
        ids_a, ids_b = own.a.encode(" " + t, add_special_tokens=False).ids, own.b.encode(t)
        of_a, of_b = [own.bytes_a[i] for i in ids_a], [own.bytes_b[i] for i in ids_b]
        if b"".join(of_a) != (" " + t).encode() or b"".join(of_b) != (" " + t).encode():
            docs.append(None)
            continue
        end_a, end_b = np.cumsum([len(x) for x in of_a]).tolist(), np.cumsum([len(x) for x in of_b]).tolist()
        cuts = sorted(set(end_a) & set(end_b))
        groups, links, i, j = [], [], 0, 0
        for c in cuts:
            p, q = i, j
            while i < len(end_a) and end_a[i] <= c:
                i += 1
            while j < len(end_b) and end_b[j] <= c:
                j += 1
            groups.append(",".join(map(str, ids_a[p:i])) + "|" + ",".join(map(str, ids_b[q:j])))
            links += [(ids_a[x], ids_b[y]) for x in range(p, i) for y in range(q, j) if end_a[x] > end_b[y] - len(of_b[y]) and end_b[y] > end_a[x] - len(of_a[x])]
        docs.append((len(ids_a), len(ids_b), len(groups), links, ";".join(groups)))
    count = Counter(p for d in docs if d for p in set(d[3]))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return count, [(0, 0, 0, 0, 0, 0, "") if d is None else (*d[:3], len(d[3]), sum(count[p] == top[p[0]] for p in d[3]), sum(count[p] for p in d[3]), d[4]) for d in docs]


HOSTILE = [
    "a  b", " x", "x ", "\ta\n b", "▁a x ▁", "<s> x </s> <|endoftext|>", "<0x0A> y", "a\x00b c", "日本 語  漢字", "é é 　   x", "it's  we'll 'd", "1234567 89,01",
    "    four", "\n\n\n", " ", "x" * 300, "emoji 😀😀 👨‍👩‍👧 ok", "  z\u0085 q", "a\x1c b\x1d", "ﬁ ﬂ ½", "\r\n tab\t\t x", "Ã©", "\x7f \x80", "\U0001f1e9\U0001f1ea!",
]


def test_alignment_of_odd_rows(spark, documents):
    rng = random.Random(4)
    parts = [*HOSTILE, "the", "Fox", "jumps,", " ", "  ", "\n", "Straße", "…"]
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows += [(200 + i, t) for i, t in enumerate(HOSTILE)] + [(300 + i, rng.choice(["", " "]).join(rng.choices(parts, k=rng.randint(1, 12)))) for i in range(150)]
    count, want = brute_align([t for _, t in rows])
    want = sorted(((d, *w) for (d, _), w in zip(rows, want, strict=True)), key=repr)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, groups string, run long").repartition(4)
    for more in ({}, {"size": 500, "fan": 3}):  # many runs, several levels of merges
        assert sorted((tuple(r) for r in alignment.align(df, A, B, **more).collect()), key=repr) == want
    digest = {(r.doc_id, r.n_a): r.groups for r in alignment.align(df, A, B, digest=True).collect() if r.doc_id is not None and r.doc_id >= 100}
    assert digest == {(d, n): hashlib.sha256(g.encode()).hexdigest() if g else "" for d, n, *_, g in want if d is not None and d >= 100}
    found = {(r.a, r.b): (r.docs, r.best) for r in alignment.pair_counts(df, A, B).collect()}
    assert {p: n for p, (n, _) in found.items()} == dict(count)
    assert all(best == (n == max(m for (x, _), (m, _) in found.items() if x == a)) for (a, _), (n, best) in list(found.items())[:300])


def test_alignment_of_nothing(spark, nothing):
    assert alignment.align(nothing, A, B).count() == 0
    assert alignment.pair_counts(nothing, A, B).count() == 0


def test_heap_merge_sums_equal_pairs():
    rng = np.random.default_rng(5)
    heads = [(np.unique(rng.integers(0, 1 << 12, n).astype(np.uint64) << np.uint64(30)), None) for n in (0, 1, 5000, 900, 4000)]
    heads = [(p, rng.integers(1, 9, len(p))) for p, _ in heads]
    want = Counter()
    for p, n in heads:
        want.update(dict(zip(p.tolist(), n.tolist(), strict=True)))
    got = list(alignment.merged(heads, block=7))
    assert dict(zip(np.concatenate([p for p, _ in got]).tolist(), np.concatenate([n for _, n in got]).tolist(), strict=True)) == dict(want)
    ids = [set((p >> np.uint64(32)).tolist()) for p, _ in got]
    assert len(got) > 3 and all(not x & y for x, y in zip(ids, ids[1:], strict=False))
    assert np.all(np.diff(np.concatenate([p for p, _ in got]).astype(np.int64)) > 0)


# sharding


def naive_best_fit(sizes, capacity):
    rooms, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= s]
        if fits:
            i = min(fits)[1]
        else:
            rooms.append(max(capacity, s))
            i = len(rooms) - 1
        rooms[i] -= s
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_takes_the_tightest_bin(seed, monkeypatch):
    monkeypatch.setattr(sharding.Rooms, "WIDTH", 4)  # leaves part often
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.integers(1, (60, 400, 1200, 90)[seed], 700))[::-1].copy()
    assert sharding.best_fit(sizes, 1000).tolist() == naive_best_fit(sizes.tolist(), 1000)
    used = sharding.best_fit(sizes, 1000).max() + 1
    assert sharding.best_fit(sizes, 1000, int(used)) is not None and sharding.best_fit(sizes, 1000, int(used) - 1) is None


def test_equal_bins():
    rng = np.random.default_rng(1)
    sizes = np.sort(rng.integers(1, 100, 5000))[::-1].copy()
    load = np.bincount(sharding.equal_bins(sizes, 8), sizes, 8)
    assert load.max() - load.min() <= 0.001 * load.mean()
    load = np.bincount(sharding.equal_bins(np.concatenate([[10**6], sizes]), 8), np.concatenate([[10**6], sizes]), 8)
    assert load[0] == 10**6 and load[1:].max() - load[1:].min() <= 0.001 * load[1:].mean()
    assert sharding.equal_bins(np.array([5, 3]), 8).tolist() == [0, 1] and len(sharding.equal_bins(np.zeros(0, np.int64), 8)) == 0


def placed_well(rows, docs, count):
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == sorted(((d, size(t), zlib.crc32((t or "").encode())) for d, t in docs), key=repr)
    at = defaultdict(list)
    for r in rows:
        at[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in at.values()) and set(at) <= set(range(count))
    of = defaultdict(set)
    for r in rows:
        of[r.text_crc32, r.size].add(r.shard)
    assert all(len(x) == 1 for x in of.values())


def test_shards_of_odd_rows(spark, documents, nothing):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    placed_well(sharding.balanced(documents.withColumn("shard", F.lit("x")).withColumn("grp", F.lit(1)), 8).collect(), docs, 8)
    assert sharding.balanced(nothing).count() == 0 and sharding.packed(nothing, 100).count() == 0


def test_shards_are_equal(spark, monkeypatch):
    """A third of the rows is one text, which takes more than a shard; blocks of places end inside shards."""
    monkeypatch.setattr(sharding, "BLOCK_BITS", 5)
    rng = random.Random(3)
    docs = [(i, " ".join(["word"] * rng.randint(1, 60)) + str(i // 2)) for i in range(2000)] + [(None, "the same text " * 12)] * 1000
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = sharding.balanced(df, 8).collect()
    placed_well(rows, docs, 8)
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert load[0] == 1000 * 169 and max(load[s] for s in range(1, 8)) - min(load[s] for s in range(1, 8)) <= 0.002 * load[1]


def test_packed_keeps_the_capacity(spark, monkeypatch):
    rng = random.Random(6)
    docs = [(i, "x" * rng.randint(1, 900) + str(i)) for i in range(1500)] + [(9999, "y" * 9000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    total = sum(len(t) + 1 for _, t in docs)
    for lane in (4, 64):
        monkeypatch.setattr(sharding, "LANE", lane)
        rows = sharding.packed(df, 5000).collect()
        shards = max(r.shard for r in rows) + 1
        placed_well(rows, docs, shards)
        load = Counter()
        for r in rows:
            load[r.shard] += r.size
        alone = {r.shard for r in rows if r.doc_id == 9999}
        assert all(n <= 5000 for s, n in load.items() if s not in alone) and shards <= total / 5000 * 1.02 + total / 5000 / lane + 3


def test_written_shards(spark, documents, tmp_path):
    found = sharding.write(documents, f"file://{tmp_path}/out", 4).collect()
    assert sum(r.rows for r in found) == documents.count()
    rows = spark.read.parquet(f"file://{tmp_path}/out").select("row.doc_id", "row.text", "shard").collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(((r.doc_id, r.text) for r in documents.collect()), key=repr)
    assert len({r.shard for r in rows}) == 4


def test_queries_on_tables(spark):
    """Whole registered queries: alignment by brute force, shards by their law."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    _, want = brute_align([t for _, t in docs])
    want = sorted((d, *w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for (d, _), w in zip(docs, want, strict=True))
    assert sorted(tuple(r) for r in queries.op12_token_alignment(spark, "/root/testdata/sf0.001").collect()) == want
    rows = queries.op13_shards(spark, "/root/testdata/sf0.001").collect()
    placed_well(rows, docs, 8)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
