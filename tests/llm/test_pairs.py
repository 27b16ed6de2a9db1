"""Near duplicates, exact substrings, chunks and benchmark overlaps against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxelflux.llm import cdc, components, decontam, identity, minmax, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text, k):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_components(rows, k, percent):
    """The component of each row, as a set of row numbers."""
    sets = [shingles(t, k) for _, t in rows]
    own = [{i} for i in range(len(rows))]
    for i, s in enumerate(sets):
        for j in range(i):
            t = sets[j]
            if s and t and own[i] is not own[j] and 100 * len(s & t) >= percent * len(s | t):
                own[i] |= own[j]
                for m in own[j]:
                    own[m] = own[i]
    return own


def component_ids(rows, k, percent):
    """component_id of each row: the smallest doc_id of its component, None if no row there has one."""
    return [min((rows[j][0] for j in c if rows[j][0] is not None), default=None) for c in brute_components(rows, k, percent)]


def by_row(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) for x in r])


def groups(sentence, seed=5, n_groups=4, size=60, words=120):
    """Groups of loosely similar texts: each a base with words replaced at rates from 0 to 15 %, some of them alike."""
    rng = random.Random(seed)
    rows, i = [], 0
    for g in range(n_groups):
        base = sentence(rng, words).split()
        for j in range(size):
            own = list(base if j % 3 else (rows[-1][1].split() if rows and j else base))
            for _ in range(rng.randint(0, words * 15 // 100 if j % 3 else 2)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append((i, " ".join(own)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_of_loose_groups(spark, sentence, k, percent):
    rows = groups(sentence)
    want = dict(zip((d for d, _ in rows), component_ids(rows, k, percent), strict=True))
    got = {r.doc_id: r for r in minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()}
    assert {d: r.component_id for d, r in got.items()} == want
    assert all(r.kept == (want[d] == d) for d, r in got.items())


def test_near_duplicates_of_odd_rows(documents, nothing):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    out = minmax.near_duplicates(documents).collect()
    want = [(d, len(shingles(t, 3)), c if t and t.split() else d) for (d, t), c in zip(rows, component_ids(rows, 3, 85), strict=True)]
    assert by_row((r.doc_id, r.n_shingles, r.component_id) for r in out) == by_row(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out if r.component_id is not None)
    assert [r.kept for r in out if r.component_id is None] == [True]  # a text of its own without id
    assert minmax.near_duplicates(nothing).count() == 0 and minmax.one_of_each(nothing).count() == 0
    kept = minmax.one_of_each(documents)
    assert kept.columns == documents.columns and kept.where("doc_id in (44, 45)").count() == 0 and kept.where("doc_id = 43").count() == 1
    assert kept.where("doc_id in (40, 41, 42)").count() == 3 and kept.where("doc_id = 5").count() == 2


def test_rows_without_id_link_nothing_but_by_text(spark, sentence):
    rng = random.Random(8)
    a, b, c, d = (sentence(rng, 60) for _ in range(4))
    rows = [(5, a), (9, b), (None, a + " more"), (None, b + " more"), (None, c), (None, d), (None, d), (9, sentence(rng, 50)), (9, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({x: F.lit(1) for x in ("key", "row", "first", "packed")}).repartition(3)
    out = minmax.near_duplicates(df).collect()
    assert by_row((r.doc_id, r.component_id) for r in out) == by_row(zip((x for x, _ in rows), component_ids(rows, 3, 85), strict=True))
    assert sum(r.kept for r in out if r.component_id is None) == 2
    kept = minmax.one_of_each(df, k=3, percent=85)
    assert sorted(r.text for r in kept.collect()) == sorted([a, b, c, d, rows[7][1]]) and kept.columns == df.columns


def test_min_max_estimates_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    h = np.concatenate([np.sort(np.concatenate([common, x])) for x in (a, b)])
    s = minmax.signatures(h, np.array([0, 900, 1800]), 256)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.06


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def brute_spans(rows):
    """Bytes covered by a 100-byte string that starts earlier, by the definition."""
    seen, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    for i in order:
        data = (rows[i][1] or "").encode()
        cover = bytearray(len(data))
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if w in seen:
                cover[s : s + 100] = b"\1" * 100
            else:
                seen[w] = i
        kept = bytes(c for c, x in zip(data, cover, strict=True) if not x)
        spans = sum(1 for j in range(len(data)) if cover[j] and not (j and cover[j - 1]))
        out.append((rows[i][0], len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(sentence, seed=11):
    rng = random.Random(seed)
    shared = [sentence(rng, rng.randint(15, 60)) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [sentence(rng, rng.randint(1, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            cut = rng.randint(0, len(p) // 2)
            parts += [p[cut:] if rng.random() < 0.5 else p[: len(p) - cut], sentence(rng, rng.randint(0, 20))]
        rows.append((i, " ".join(parts)))
    rows += [(80, "ab" * 300), (81, "x" + "ab" * 300), (82, "a" * 450), (83, "a" * 99), (84, "a" * 100), (85, rows[3][1]), (86, rows[3][1]), (87, ""), (88, None), (89, "é" * 120)]
    rng.shuffle(rows)
    return rows


def test_suffix_dedup_is_exact(spark, sentence):
    rows = passages(sentence)
    got = sorted(tuple(r) for r in suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    assert got == sorted(brute_spans(rows))


def numbers(docs):
    """(number, doc_id, text) of each row by the definition of identity.numbered(), checked against it."""
    rows = identity.numbered(docs).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    texts, own = defaultdict(set), defaultdict(set)
    for r in rows:
        texts[r.doc].add((r.doc_id, r.text))
        own[r.doc_id, r.text].add(r.doc)
    assert all(len(x) == 1 for x in [*texts.values(), *own.values()])
    known = {r.doc_id for r in rows if r.doc_id is not None}
    assert all(any(r.doc == d for r in rows) for d in known) and all(r.doc == r.doc_id or r.doc >= identity.LATER for r in rows)
    return rows


def check_suffixes(docs):
    rows = numbers(docs)
    by_number = {x[0]: x[1:] for x in brute_spans(sorted({(r.doc, r.text or "") for r in rows}))}
    got = suffixes.dedup(docs).collect()
    assert by_row(map(tuple, got)) == by_row((r.doc_id, *by_number[r.doc]) for r in rows)
    return got


def test_suffix_dedup_of_odd_rows(documents, nothing):
    out = check_suffixes(documents)
    assert sum(r.n_removed == r.n_bytes > 0 for r in out) == 2  # two further copies of one text, one of them without id
    clashing = documents.select("*", *(F.lit(i).alias(c) for i, c in enumerate(("doc", "role", "first_h1", "blobs", "h1"))))
    assert by_row(map(tuple, suffixes.dedup(clashing).collect())) == by_row(map(tuple, out))
    assert suffixes.dedup(nothing).count() == 0


def test_suffix_dedup_of_rows_without_id_or_under_one_id(spark, sentence):
    rng = random.Random(78)
    a, b, c, p = (sentence(rng, 50) for _ in range(4))
    rows = [(5, f"{a} {p}"), (9, b), (None, f"{p} {c}"), (None, sentence(rng, 40)), (None, f"{c} {p}"), (9, f"{sentence(rng, 20)} {a}"), (9, b), (None, b), (9, None), (9, ""), (9, a)]
    check_suffixes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


@pytest.mark.parametrize("often", [2, 8, 10**6])
def test_suffix_dedup_of_a_line_in_a_third_of_the_rows(spark, sentence, monkeypatch, often):
    """Texts around the line differ, so every row of it is a text of its own for the line's leading string."""
    monkeypatch.setattr(suffixes, "HOT_SEEN", min(often, 8))
    monkeypatch.setattr(suffixes, "HOT_ROWS", often)
    rng, line = random.Random(31), "licensed under the terms of a licence that all of these rows name in full."
    rows = [(i, f"{sentence(rng, rng.randint(0, 30))} {line if i % 3 == 0 else ''} {sentence(rng, rng.randint(0, 30))}") for i in range(300)]
    rows += [(300 + i, f"{sentence(rng, 3)} {rows[3 * i][1]}") for i in range(30)]
    check_suffixes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_multikey_sort():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 2, (300, 19)).astype(np.uint8)
    rows[50:90] = rows[0]
    order, shared = suffixes.multikey_sort(rows)
    want = sorted(range(300), key=lambda i: rows[i].tobytes())
    assert [rows[i].tobytes() for i in order] == [rows[i].tobytes() for i in want]
    for j in range(1, 300):
        a, b = rows[order[j - 1]], rows[order[j]]
        assert shared[j] == next((x for x in range(19) if a[x] != b[x]), 19)


def test_anchor_hits_every_window():
    rng = np.random.default_rng(9)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[500:800] = data[1200:1500]
    offsets = np.array([0, 1000, 1050, 3000])
    a = suffixes.anchors(data, offsets)
    windows = sum(max(0, n - 99) for n in np.diff(offsets))
    assert a["count"].sum() == windows and (a["off"] < suffixes.PLACES).all() and (a["off"] - a["count"] >= -1).all()


def test_equal_hashes_are_compared_by_bytes():
    text = np.frombuffer(b"abcdabcdabceabcd", np.uint8)
    at, size, off = np.array([0, 4, 8, 12, 0]), np.array([4, 4, 4, 4, 3]), np.array([1, 1, 1, 2, 1])
    assert suffixes._alike(text, at, size, off, np.array([True, False, False, False, False])).tolist() == [True, True, False, False, False]
    assert suffixes._alike(text, at, size, off, np.ones(5, bool)).all()


def test_many_rows_alike_have_one_text_and_a_row_each(spark, sentence, monkeypatch):
    rng = random.Random(31)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    rows = [(1, a), *[(2, f"{b} {a}")] * 25, *[(None, f"{c} {b}")] * 23, (3, c), (None, None), (None, None)]
    monkeypatch.setattr(identity, "PIECE", 10)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffixes.dedup(df).groupBy("doc_id", "n_bytes", "n_removed").count().collect()
    held = {(r.doc_id, r.n_bytes): (r.n_removed, r["count"]) for r in got}
    size = lambda t: len(t.encode())
    assert held[1, size(a)] == (0, 1) and held[None, 0] == (0, 2) and held[3, size(c)] == (0, 1) and len(held) == 5
    assert held[2, size(a) + size(b) + 1][1] == 25 and held[2, size(a) + size(b) + 1][0] >= size(a)
    assert held[None, size(b) + size(c) + 1][1] == 23 and held[None, size(b) + size(c) + 1][0] >= size(b) + size(c) - 1
    again = identity.repeated(identity.numbered(df))
    assert {r.n for r in again.collect()} == {25, 23, 2} and identity.one_each(identity.numbered(df), again).count() == 5


def test_chunks_resist_insertions():
    rng = np.random.default_rng(7)
    data = rng.integers(32, 127, 20_000).astype(np.uint8)
    other = np.insert(data, 5000, rng.integers(32, 127, 37).astype(np.uint8))
    cut = lambda d: {d[s:e].tobytes() for s, e in zip(*cdc.chunks(d, np.array([0, len(d)])), strict=True)}
    a, b = cut(data), cut(other)
    assert len(a - b) <= 4 and len(a) > 200
    s, e = cdc.chunks(data, np.array([0, 300, 300, 20_000]))
    assert s[0] == 0 and e[-1] == 20_000 and (s[1:] == e[:-1]).all() and 300 in s and (e - s).max() <= cdc.MOST
    flat = np.full(5000, 65, np.uint8)
    s, e = cdc.chunks(flat, np.array([0, 5000]))
    assert (e - s).max() <= cdc.MOST


def cut_out(rows, spans):
    """Texts without spans, by a loop over bytes."""
    out = []
    for d, t in rows:
        data = bytearray((t or "").encode())
        for start, length in sorted(((r.start, r.length) for r in spans if r.doc_id == d), reverse=True):
            del data[start : start + length]
        out.append((d, bytes(data)))
    return out


def test_without_spans(spark, sentence, documents, nothing):
    rows = passages(sentence)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = cdc.repeated_spans(df).cache()
    left = {r.doc_id: r.text for r in cdc.without_spans(df, spans).collect()}
    for d, kept in cut_out(rows, spans.collect()):
        assert (left[d] or "").encode() == kept or "\ufffd" in kept.decode(errors="replace")
    odd = cdc.repeated_spans(documents)
    assert odd.where("doc_id = 44").count() == 1 and odd.where("doc_id = 43").count() == 0
    clashing = documents.select("*", *(F.lit(i).alias(c) for i, c in enumerate(("doc", "spans", "packed", "lo", "shared"))))
    cut = cdc.without_spans(clashing, odd)
    assert cut.columns == clashing.columns and cut.count() == documents.count()
    assert cut.select("doc", "spans", "packed", "lo", "shared", "row", "size").distinct().collect() == [(0, 1, 2, 3, 4, 1.5, "x")]
    assert cdc.repeated_spans(nothing).count() == 0 and cdc.without_spans(nothing, odd).count() == 0


def test_spans_of_rows_without_id_or_under_one_id(spark, sentence):
    rng = random.Random(77)
    a, b, c, p = (sentence(rng, 90) for _ in range(4))
    rows = [(5, f"{a} {p}"), (9, b), (None, f"{p} {c}"), (None, sentence(rng, 80)), (None, f"{c} {p}"), (9, f"{sentence(rng, 40)} {a}"), (9, b), (9, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = cdc.repeated_spans(df)
    found = [(r.doc_id, r.first_doc_id) for r in spans.collect()]
    assert (9, 5) in found and (None, 5) in found and {d for d, _ in found} == {9, None}
    left = sorted(r.text for r in cdc.without_spans(df, spans).collect())
    assert len(left) == len(rows) and left.count(b) == 3 and rows[0][1] in left and rows[3][1] in left
    assert sum(p in t for t in left) == 1 and sum(a in t for t in left) == 1 and sum(c in t for t in left) == 1


def test_long_shared_passages_are_caught(spark, sentence):
    rng = random.Random(21)
    rows, hit = [], set()
    for i in range(300):
        a, b, p = sentence(rng, 80), sentence(rng, 80), sentence(rng, 70)
        rows += [(2 * i, f"{a} {p} {b}"), (2 * i + 1, f"{sentence(rng, rng.randint(5, 90))} {p}")]
        hit.add(2 * i + 1)
    got = {r.doc_id for r in cdc.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= hit and len(got) == 300


def planted(sentence, seed=13):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.randint(14, 60))) for i in range(30)] + [(30, "one two three"), (31, "only seven words stand in this item"), (32, None), (33, "")]
    docs, want = [], set()
    for i in range(200):
        text = sentence(rng, rng.randint(5, 150)).split()
        if i % 4 == 0:
            item, t = items[rng.randrange(30)]
            words = t.split()
            for _ in range(len(words) // 12):
                words[rng.randrange(len(words))] = "zzz"
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() if rng.random() < 0.1 else w for w in words]
            want.add((i, item))
        docs.append((i, ", ".join(text)))
    docs += [(200, "x y only seven words stand in this item z"), (201, "only seven words stand in that item"), (202, None), (203, "one two three"), (None, items[4][1])]
    return items, docs, want | {(200, 31), (None, 4)}


def test_benchmark_overlaps(spark, sentence, documents, nothing):
    items, docs, want = planted(sentence)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.hits(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), bench).collect()}
    assert set(got) == want
    assert all(r.equal * 5 >= r.overlap * 4 for r in got.values())
    mixed = documents.unionByName(documents.where("doc_id = 48").withColumn("doc_id", F.lit(500).cast("long")).withColumn("text", F.lit("so " + items[0][1])))
    clean = decontam.clean(mixed, bench)
    assert clean.columns == documents.columns and clean.count() == documents.count() and clean.where("doc_id = 500").count() == 0
    assert decontam.hits(nothing, bench).count() == 0 and decontam.hits(documents, bench.where("1 = 0")).count() == 0


def exhaustive(docs, items, least=13):
    """{(row, item)} with an overlap at any of all shifts; best_overlap() itself is held against brute force below."""
    tok = lambda texts: [h[a:b] for h, at in [decontam.tokens(pa.array(texts))] for a, b in itertools.pairwise(at)]
    d, i = tok([t for _, t in docs]), tok([t for _, t in items])
    return {(r, j) for r, x in enumerate(d) for j, y in enumerate(i) if len(y) >= decontam.SPAN and np.isin(x, y).any() for s in range(-len(y) + 1, len(x)) if decontam.best_overlap(x, y, s, least)[1]}


def test_benchmark_overlaps_against_all_alignments(spark, sentence):
    rng = random.Random(15)
    items = [(i, sentence(rng, rng.randint(13, 40))) for i in range(12)]
    docs = []
    for i in range(60):
        words = items[i % 12][1].split()
        lo = rng.randint(0, len(words) - 10)
        part = words[lo : lo + rng.randint(8, 30)]
        for _ in range(rng.randint(0, len(part) // 3)):
            part[rng.randrange(len(part))] = "zz"
        docs.append((i, " ".join(sentence(rng, rng.randint(0, 30)).split() + part + sentence(rng, rng.randint(0, 30)).split())))
    got = decontam.hits(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = exhaustive(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == want and 15 < len(want) < 60


def test_clean_judges_each_row_by_its_own_text(spark, sentence):
    rng = random.Random(16)
    item, other = sentence(rng, 30), sentence(rng, 60)
    rows = [(None, f"so {item}"), (None, other), (4, f"{item} then"), (4, sentence(rng, 50)), (None, None), (4, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("key", "key2", "row", "packed", "tokens")})
    bench = spark.createDataFrame([(1, item, 2), (None, item, 3)], "item_id long, text string, item long")
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(rows[i] for i in (1, 3, 4, 5))
    assert decontam.clean(docs.where("1 = 0"), bench).count() == 0 and decontam.clean(docs, bench.where("1 = 0")).count() == len(rows)
    assert decontam.hits(docs, spark.createDataFrame([(1, "one two")], "item_id long, text string"), least=1).count() == 0


def test_a_phrase_of_many_items_and_documents(spark, sentence):
    """A document takes what faces the item to the comparison, not its whole text."""
    rng = random.Random(17)
    phrase = " ".join(f"p{i}" for i in range(11))
    items = [(i, f"{sentence(rng, 6)} {phrase} {sentence(rng, 6)}") for i in range(60)]
    docs = [(i, f"{sentence(rng, 40)} {phrase if i % 3 == 0 else ''} {sentence(rng, 400)}") for i in range(60)] + [(100 + i, t) for i, t in items[:5]]
    got = decontam.hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(100 + i, i) for i in range(5)} <= {(r.doc_id, r.item_id) for r in got}
    assert {(r.doc_id, r.item_id) for r in got} == {(docs[r][0], i) for r, i in exhaustive(docs, items)}


def test_many_ranges_give_the_same(spark, sentence, monkeypatch):
    rows = passages(sentence, seed=12)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 500)
    monkeypatch.setattr(suffixes, "MOST_RANGES", 8)
    assert suffixes._ranges(df.select(F.col("doc_id").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))).split > 4
    assert sorted(tuple(r) for r in suffixes.dedup(df).collect()) == sorted(brute_spans(rows))


def covered(rows, n):
    """For each document the bytes in a string of n bytes that an earlier place holds too."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        data = t.encode()
        cover = np.zeros(len(data), bool)
        for s in range(len(data) - n + 1):
            w = data[s : s + n]
            if w in seen:
                cover[s : s + n] = True
            seen.add(w)
        out[d] = cover
    return out


def test_passages_of_51_words_are_found_whole(spark, sentence):
    rng = random.Random(51)
    rows = []
    for i in range(400):
        p = sentence(rng, 51)
        rows += [(2 * i, f"{sentence(rng, rng.randint(0, 80))} {p} {sentence(rng, 30)}"), (2 * i + 1, f"{sentence(rng, rng.randint(0, 90))} {p} {sentence(rng, rng.randint(0, 9))}")]
    want = covered(rows, cdc.MIN_SPAN)
    got = {d: np.zeros(len(c), bool) for d, c in want.items()}
    for r in cdc.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        got[r.doc_id][r.start : r.start + r.length] = True
    assert all((got[d] == want[d]).all() for d in want) and sum(c.any() for c in want.values()) == 400


def test_spans_hold_repeats_only(spark, sentence, documents, nothing):
    rows = [(d, t) for d, t in passages(sentence) if t]
    want = covered(rows, cdc.MIN_SPAN)
    got = {d: np.zeros(len(c), bool) for d, c in want.items()}
    for r in cdc.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        got[r.doc_id][r.start : r.start + r.length] = True
        assert r.length >= cdc.MIN_SPAN and r.n_chunks > 0 and r.first_doc_id <= r.doc_id
    assert not any((got[d] & ~want[d]).any() for d in want)
    sure = covered(rows, cdc.SURE)
    missed, whole = sum((sure[d] & ~got[d]).sum() for d in sure), sum(c.sum() for c in sure.values())
    assert missed * 16 <= whole, (missed, whole)  # parts of six passages: chunks have their first places in other parts
    odd = cdc.repeated_spans(documents)
    assert odd.where("doc_id = 44").count() == 1 and odd.where("doc_id = 43").count() == 0
    assert cdc.repeated_spans(nothing).count() == 0


def brute_overlap(doc, item, shift, least):
    """The highest sum of any part from an equal token to an equal token, None if it is below 0."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    score = [1 if item[i] == doc[i + shift] else -4 for i in range(lo, hi)]
    sums = [sum(score[i:j]) for i in range(len(score)) for j in range(i + least, len(score) + 1) if score[i] == score[j - 1] == 1]
    return max((x for x in sums if x >= 0), default=None)


def test_best_overlap_is_the_best():
    rng, found = np.random.default_rng(6), 0
    for _ in range(400):
        doc, item = rng.integers(0, 1000, 60).astype(np.uint64), rng.integers(1000, 2000, 30).astype(np.uint64)
        shift = int(rng.integers(-10, 45))
        for i in range(max(0, -shift), min(30, 60 - shift)):
            if rng.random() < 0.83:
                item[i] = doc[i + shift]
        start, length, equal = decontam.best_overlap(doc, item, shift, 13)
        want = brute_overlap(doc, item, shift, 13)
        assert (equal * 5 - length * 4 if length else None) == want
        assert not length or equal == (item[start : start + length] == doc[start + shift : start + shift + length]).sum()
        found += length > 0
    assert found > 100


def test_overlap_after_a_changed_middle(spark, sentence):
    rng = random.Random(40)
    item = [f"t{i}" for i in range(40)]
    doc = sentence(rng, 20).split() + item[:11] + [f"z{i}" for i in range(10)] + item[21:] + sentence(rng, 20).split()
    docs = spark.createDataFrame([(1, " ".join(doc)), (2, sentence(rng, 80))], "doc_id long, text string")
    got = decontam.hits(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(1, 7, 41, 21, 19, 19)]


def least_blocks(masks, upto, windows=()):
    """For each length, the fewest substitutions that leave no place to any mask; both ends are equal tokens. With windows, a
    mask counts only inside a window of one of these lengths whose ends are equal tokens."""
    n = 1 << max([*map(len, masks), *windows])
    last = np.arange(n)  # substitutions among the last tokens, the newest in bit 0; before the first all count as such
    hit = np.zeros(n, bool)
    for m in masks:
        if not windows:
            hit |= (last & int(m, 2)) == 0
        for w in windows:
            for at in range(w - len(m) + 1):
                hit |= (((last >> at) & int(m, 2)) == 0) & (last & 1 == 0) & (last >> (w - 1) & 1 == 0)
    cost, out = np.full(n, 10**6), {}
    cost[n - 1] = 0
    for length in range(1, upto + 1):
        new = np.full(n, 10**6)
        for bit in (0,) if length == 1 else (0, 1):
            np.minimum.at(new, (last << 1) & (n - 1) | bit, cost + bit)
        new[hit] = 10**6
        cost = new
        out[length] = int(cost[last & 1 == 0].min())
    return out


def test_masks_hit_every_allowed_overlap():
    assert max(map(len, decontam.MASKS)) <= decontam.SPAN
    for windows in ((), range(13, 13 + decontam.MORE + 1)):  # any seed, and seeds that many items share
        least = least_blocks(decontam.MASKS, 200, windows)
        assert all(least[n] > n // 5 for n in range(13, 201))
    for n in (11, 12):
        for gone in itertools.combinations(range(n), n // 5):
            assert any(all(c == "0" or at + j not in gone for j, c in enumerate(m)) for m in decontam.MASKS for at in range(n - len(m) + 1))


def shared_phrases(sentence, n_phrase, n_items=120, n_docs=200):
    """Items and documents that have a phrase in common, and documents with parts of single items, some tokens of them changed."""
    rng = random.Random(n_phrase)
    phrase = [f"p{i}" for i in range(n_phrase)]
    items = [(i, " ".join([*sentence(rng, 12).split(), *phrase, *sentence(rng, 12).split()])) for i in range(n_items)]
    docs = [(i, " ".join([*sentence(rng, 15).split(), *phrase, *sentence(rng, 15).split()])) for i in range(n_docs)]
    for i in range(40):
        words = items[i][1].split()
        lo = rng.randint(4, 14)
        part = words[lo : lo + rng.randint(13, 20)]
        for j in rng.sample(range(1, len(part) - 1), len(part) // 6):
            part[j] = f"z{j}"
        docs.append((1000 + i, " ".join([*sentence(rng, 20).split(), *part, *sentence(rng, 20).split()])))
    return items, docs


@pytest.mark.parametrize("n_phrase", [11, 12])
def test_a_shared_phrase_makes_no_pairs_of_all(spark, sentence, monkeypatch, n_phrase):
    items, docs = shared_phrases(sentence, n_phrase)
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.hits(*frames).collect()}
    assert decontam._lain(*frames, 13, decontam.LEAST)[0].count() < 3 * len(docs)  # and not items times documents
    ids = [d for d, _ in docs]
    assert got == {(ids[r], j) for r, j in exhaustive(docs, items)} and len(got) > 30
    monkeypatch.setattr(decontam, "MANY", 10**9)  # every seed joins by itself: the same overlaps
    assert {(r.doc_id, r.item_id) for r in decontam.hits(*frames).collect()} == got


def test_overlaps_with_substitutions_anywhere(spark, sentence):
    rng, items, docs = random.Random(80), [], []
    for i in range(300):
        n = rng.randint(13, 24)
        item = [f"i{i}x{j}" for j in range(n)]
        gone = {n // 2 - 1, n // 2} if i % 3 == 0 else set(rng.sample(range(1, n - 1), n // 5))
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(sentence(rng, 20).split() + [f"z{j}" if j in gone else t for j, t in enumerate(item)] + sentence(rng, 20).split())))
    got = decontam.hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i in range(300)}


def test_components_never_stop_half_way(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    with pytest.raises(RuntimeError, match="still change"):
        components.components(chain, rounds=1)
    assert {r.root for r in components.components(chain).collect()} == {0}


def test_stars_are_components_at_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "settle", lambda df, name, own=components.settle: written.append(name) or own(df, name))
    stars = spark.createDataFrame([(i % 7, 10 + i) for i in range(90)], "a long, b long")
    got = {r.node: r.root for r in components.components(stars).collect()}
    assert got == {n: n if n < 7 else (n - 10) % 7 for n in [*range(7), *range(10, 100)]} and written == ["edges"]


def test_near_duplicates_take_few_jobs(spark, documents):
    """What the driver keeps of plans, stages and threads follows the number of jobs, whatever the size of the input."""
    spark.sparkContext.setJobGroup("near-duplicates", "near-duplicates")
    try:
        assert minmax.near_duplicates(documents).count() == documents.count()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("near-duplicates"))
    assert jobs <= 55, jobs
