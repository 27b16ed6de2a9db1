"""Mixing, URL rules, token counts, token files, language and quality: brute force, round trips, held-out accuracy."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxelflux.llm import langid, mixing, quality, queries, textnum, tokencounts, tokenfile, urlfilter

DATA = Path("/root/testdata/sf0.01")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(1, 2, 3)):
    """Shares by weight, capped at three times the size, the excess shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 3 * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check_mix(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes, longest = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += size(r.text)
        longest[r.source] = max(longest[r.source], size(r.text))
    want = brute_targets(sizes)
    out = mixing.mix(docs, rows_per_range=20).collect()
    assert Counter((r.doc_id, r["size"]) for r in out) == Counter((r.doc_id, size(r.text)) for r in rows)
    source = {(r.doc_id, size(r.text)): r.source for r in rows}
    taken = defaultdict(int)
    for r in out:
        s = source[r.doc_id, r["size"]]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9)
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[s] += r.taken
    return taken, want, longest, out


def test_mix(spark, sentence):
    rng = random.Random(1)
    rows = [(i, sentence(rng, rng.randint(1, 60)), f"s{min(int(rng.expovariate(0.4)), 6)}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    taken, want, longest, out = check_mix(docs)
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * longest[s]
    again = mixing.mix(docs.repartition(7), rows_per_range=20).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    mixed = mixing.mixed(docs)
    count = Counter(r.doc_id for r in mixed.collect())
    assert count == Counter({r.doc_id: r.copies for r in out if r.copies})


def test_mix_of_odd_rows(documents, nothing):
    check_mix(documents)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0
    assert mixing.mixed(documents).columns == documents.columns


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


def brute_mine(rows, min_support=0.002, min_count=20, z=2.0):
    """{(tokens, verdict): (lift, n)} from (tokens, bad) by counting every combination, pruned by definition."""
    seen, of = Counter(), Counter()
    for tokens, bad in rows:
        for size in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), size):
                seen[part] += 1
                of[part, "block" if bad else "allow"] += 1
    share = {"block": sum(b for _, b in rows) / len(rows)}
    share["allow"] = 1 - share["block"]
    least = max(min_support * len(rows), min_count)
    found = {}
    for (part, verdict), k in of.items():
        n, p = seen[part], k / seen[part]
        low = (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)
        if k >= least and low / share[verdict] > 1:
            found[part, verdict] = (low / share[verdict], n)
    shorter = lambda part: (q for size in range(1, len(part)) for q in itertools.combinations(part, size))
    return {(t, v): x for (t, v), x in found.items() if not any(found.get((q, v), (0,))[0] >= x[0] - 1e-12 for q in shorter(t))}


def check_rules(spark, pages, labelled):
    """Rules and verdicts against brute force; returns what decided each page."""
    known = [(r.t, r.bad) for r in labelled.where("bad is not null").select(urlfilter.tokens(F.col("url")).alias("t"), "bad").collect()]
    want = brute_mine(known)
    got = {(tuple(r.tokens), r.verdict): (r.lift, r.n) for r in urlfilter.mine(labelled).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    have = pages.select("page_id", "url", urlfilter.tokens(F.col("url")).alias("t")).collect()
    decided, out = {}, urlfilter.judge(pages, labelled).collect()
    assert Counter(r.page_id for r in out) == Counter(r.page_id for r in have)
    expected = {}
    for r in have:
        fits = [(round(x[0], 9), v, " ".join(t)) for (t, v), x in want.items() if set(t) <= set(r.t)]
        expected[r.page_id] = (r.url, max(fits, default=None))
    for r in out:
        url, best = expected[r.page_id]
        host, path, rule = brute_rule(url)
        assert (r.host, r.path, r.rule) == (host, path, rule[0] if rule else None), url
        assert r.mined_rule == (best[2] if best else None), url
        assert r.verdict == (rule[1] if rule else best[1] if best else "allow")
        decided[r.page_id] = r
    return decided


def test_url_rules(spark):
    rng = random.Random(4)
    hosts = ["a.example.org", "example.org", "EXAMPLE.org", "notexample.org", "b.example.com", "com", "x.net", "spam.x.net", "org", "ok.x.net"]
    paths = ["", "/", "/es/1", "/en/1", "/en/12?x=1", "/en/2#y", "/fr/3", "/de/4", "/de", "?q=/fr/", "#://org/", "/p/7"]
    urls = [f"{s}{h}{p}" for s in ("http://", "https://") for h in hosts for p in paths] + [None, "", "no-scheme.org/", "://", "a://b://org/", "https://.../x"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "x")], "page_id long, url string, host string")
    labelled = [(f"https://spam.x.net/p/{i}", True) for i in range(40)] + [(f"https://ok.x.net/p/{i}", rng.random() < 0.1) for i in range(200)]
    labelled += [(f"http://y.net/{rng.choice('abc')}/{rng.choice('de')}?k={i}&m=1", rng.random() < 0.3) for i in range(300)] + [(None, True), ("https://x.net/", None)]
    labelled = spark.createDataFrame(labelled, "url string, bad boolean").repartition(3)
    out = check_rules(spark, pages, labelled)
    by_url = {urls[i]: r for i, r in out.items()}
    assert by_url["https://spam.x.net/de"].verdict == "block" and by_url["https://ok.x.net/de"].verdict == "allow"
    assert by_url["https://spam.x.net/de"].lift > 1 and by_url["https://ok.x.net/de"].mined_rule
    assert urlfilter.judge(pages.where("1 = 0"), labelled).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, labelled.where("1 = 0")).where("rule is null").collect()} == {"allow"}


def test_many_sure_rules_do_not_hide_less_sure_ones(spark, monkeypatch):
    bad = [f"https://w{i}.v{i}.u{i}.bad{i}.net/a{i}/b{i}/c{i}/d{i}" for i in range(17)]
    rows = [(u, True) for u in bad for _ in range(20)] + [("https://soft.info/s", i < 20) for i in range(30)] + [(f"https://ok{i % 9}.net/x", False) for i in range(900)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean").repartition(4)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*bad, "https://soft.info/other", "https://ok1.net/x", None])], "page_id long, url string")
    for small in (urlfilter.SMALL, 3):
        monkeypatch.setattr(urlfilter, "SMALL", small)
        got = {i: r.verdict for i, r in check_rules(spark, pages, labelled).items()}
        assert got == {i: "block" if i < 18 else "allow" for i in range(20)}


def test_rules_from_anywhere_in_a_url(spark):
    """Tokens far back in path, query and host make rules; a URL of very many tokens goes to the miner with its rarest ones."""
    deep = lambda i, tail: f"https://a{i % 50}.b.c.d.site.net/x/y/z/u/v/w/{tail}/k?a=1&b=2&c=3&d=4&{'evil' if tail == 'ads' else 'good'}=5"
    rows = [(deep(i, "ads"), True) for i in range(60)] + [(deep(i, f"page{i % 3}"), False) for i in range(240)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean").repartition(3)
    rules = {(tuple(r.tokens), r.verdict) for r in urlfilter.mine(labelled).collect()}
    assert (("p:ads",), "block") in rules and (("q:evil",), "block") in rules and (("q:good",), "allow") in rules
    pages = spark.createDataFrame([(1, "https://other.org.uk/1/2/3/4/5/6/7/ads?x=1"), (2, "http://h.net/?a&b&c&d&e&evil"), (3, "http://h.net/q")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urlfilter.judge(pages, labelled).collect()} == {1: "block", 2: "block", 3: "allow"}
    items = urlfilter.transactions(labelled, 6, 5).collect()
    assert len(items) == 300 and all(len(r["items"]) <= 5 for r in items)


def test_no_token_of_a_long_url_is_left_out(spark):
    """Long URLs make the same rules as all combinations of their tokens, also of their most frequent ones and by pairs."""
    rng = random.Random(12)
    rows = []
    for i in range(150):
        keys = [f"k{j}" for j in range(9) if rng.random() < (0.9 if j < 3 else 0.2) or i % 50 == 0]
        evil = "k0" in keys and "k4" in keys
        rows.append((f"https://s.net/a/b/{'c' if evil else 'd'}?" + "&".join(f"{k}=1" for k in keys), rng.random() < (0.95 if evil else 0.15)))
    labelled = spark.createDataFrame(rows, "url string, bad boolean").repartition(3)
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows[:20])] + [(40, None), (41, "http://h.org/?k0=1&k4=2")], "page_id long, url string")
    assert labelled.select(F.max(F.size(urlfilter.tokens(F.col("url"))))).first()[0] > urlfilter.WIDTH
    assert any(r.mined_rule for r in check_rules(spark, pages, labelled).values())


def test_the_most_frequent_of_many_tokens_decides(spark):
    """URLs of up to forty tokens, each in rows that hold the one before: two to the fortieth combinations, none better than one token."""
    deep = lambda i: "/".join("d" + "abcdefgh"[j // 8] + "abcdefgh"[j % 8] for j in range(34 if i >= 40 else 10 + i % 24))
    rows = [(f"https://s.net/zz/{deep(i)}", True) for i in range(120)] + [(f"https://ok.net/{deep(i)}", False) for i in range(240)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean").repartition(3)
    rules = {(tuple(r.tokens), r.verdict): r.n for r in urlfilter.mine(labelled).collect()}
    assert rules[("p:zz",), "block"] == 120 and rules[("h:ok.net",), "allow"] == 240
    pages = spark.createDataFrame([(1, "http://other.org.uk/zz"), (2, "https://ok.net/7")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urlfilter.judge(pages, labelled).collect()} == {1: "block", 2: "allow"}


def test_rollup(spark, documents, tmp_path):
    rollup = tokencounts.Rollup(spark, f"file://{tmp_path}/r")
    assert rollup.totals().count() == 0
    n = tokencounts.count(F.col("text"), "words-1")
    load = tokencounts.changes(documents, "insert", "words-1", F.lit(7))
    assert rollup.apply("1", load) and not rollup.apply("1", load)
    rollup.apply("2", tokencounts.changes(documents, "revise", "words-1", n, F.lit(7)))
    gone = documents.where("doc_id = 46")
    rollup.apply("3", tokencounts.changes(gone, "delete", "words-1", n))
    rollup.apply("4", documents.where("1 = 0").select(F.lit("insert").alias("op"), "source", "lang", F.lit("v").alias("tokenizer"), F.lit(1).alias("n_tokens"), F.lit(0).alias("old_tokens")))
    want = defaultdict(lambda: [0, 0])
    for r in documents.collect():
        if r.doc_id != 46:
            want[r.source, r.lang][0] += 1
            want[r.source, r.lang][1] += len(WORD.findall(r.text or ""))
    got = {(r.source, r.lang): [r.docs, r.tokens] for r in rollup.totals().collect()}
    assert got == dict(want) and rollup.batches() == ["1", "2", "3", "4"]
    (tmp_path / "r" / "batch=3" / "_SUCCESS").unlink()  # a write that broke off counts for nothing and is done anew
    assert rollup.batches() == ["1", "2", "4"] and rollup.apply("3", tokencounts.changes(gone, "delete", "words-1", n))
    small = rollup.compact("upto-4", f"file://{tmp_path}/c")
    assert {(r.source, r.lang): [r.docs, r.tokens] for r in small.totals().collect()} == dict(want) and small.batches() == ["upto-4"]
    with pytest.raises(Exception, match="unknown change"):
        rollup.apply("5", tokencounts.changes(documents, "upsert", "words-1", n))


def test_pack_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 1001):
        v = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = tokenfile.pack(v)
        assert len(control) == -(-n // 4) and (tokenfile.unpack(control, data, n) == v).all()


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_encoder_equals_library():
    rng = random.Random(8)
    parts = ["a", "é", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u2003", "'s", "don't", "123", "!!", "😀", "漢字", "ß", "\x1c", "<|endoftext|>", "\r\n", "Wort", "ñ", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(600)] + [None, "", " "]
    own = tokenfile.Encoder(queries.tokenizer(), memory=500)
    for _ in range(2):
        ids, at = own.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == plain_ids(texts)


def test_library_gets_new_pieces_in_few_strings_and_common_ones_once():
    class Counting:
        def __init__(self, own):
            self.own, self.strings, self.text = own, 0, Counter()

        def encode_batch_fast(self, batch, **how):
            self.strings += len(batch)
            self.text.update(w for t in batch for w in t.split(" "))
            return self.own.encode_batch_fast(batch, **how)

    rng = random.Random(9)
    common = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(200)]
    own = tokenfile.Encoder(queries.tokenizer(), memory=3_000)
    own.tokenizer = seen = Counting(own.tokenizer)
    for i in range(12):  # each slice has 1,000 words that never come again, and the common ones
        texts = [" ".join([f"x{i}y{j}z{k}" for k in range(10)] + common) + "." for j in range(100)]
        ids, at = own.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == plain_ids(texts)
    assert seen.strings < 12 * 150 and max(seen.text[w] for w in common[:-1]) == 1


def test_token_files(spark, documents, nothing, tmp_path):
    uri = f"file://{tmp_path}/t"
    shards = tokenfile.write(documents, uri, queries.tokenizer(), shard_bytes=20_000)
    assert shards.count() > 1
    got = tokenfile.read(shards, uri).collect()
    rows = documents.collect()
    made = [(r.doc_id, ids + [2]) for r, ids in zip(rows, plain_ids([r.text for r in rows]), strict=True)]
    raw = spark.createDataFrame([(i, np.array(x[1], "<u2").tobytes()) for i, x in enumerate(made)], "i int, b binary")
    by_hash = {r.i: r.h for r in raw.select("i", F.xxhash64("b").alias("h")).collect()}
    made = [made[i] for i in sorted(range(len(made)), key=lambda i: (made[i][0] is not None, made[i][0] or 0, by_hash[i]))]
    start, want = 0, []
    for d, ids in made:
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    ranks = np.frombuffer((tmp_path / "t" / "ranks.bin").read_bytes(), "<u4")
    seen = Counter(i for _, ids in made for i in ids)
    assert [seen[int(i)] for i in ranks] == sorted(seen.values(), reverse=True)
    empty = tokenfile.write(nothing, f"file://{tmp_path}/e", queries.tokenizer())
    assert tokenfile.read(empty, f"file://{tmp_path}/e").count() == 0


LANGS = {"aa": "the of and to in is was that for it with as his on be at by had not are", "bb": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine", "cc": "de la le et les des en un une du que qui dans au pour par sur est pas plus"}


def test_rows_of_one_id_fill_several_shards(spark, sentence, tmp_path):
    rng = random.Random(12)
    rows = [(7 if i % 3 else None, sentence(rng, 80)) for i in range(300)] + [(i, sentence(rng, 20)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    uri = f"file://{tmp_path}/t"
    shards = tokenfile.write(docs, uri, queries.tokenizer(), shard_bytes=10_000)
    sizes = [r.ids for r in shards.collect()]
    assert len(sizes) > 6 and max(sizes) < 3 * sum(sizes) / len(sizes)
    got = sorted(tokenfile.read(shards, uri).collect(), key=lambda r: r.start)
    ids = [(-1 if r.doc_id is None else r.doc_id) for r in got]
    assert ids == sorted(ids) and Counter(ids) == Counter(-1 if d is None else d for d, _ in rows)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)]).tolist()[:-1]


def test_other_tokenizers_are_refused():
    assert tokenfile.highest_id(queries.tokenizer()) == 50256
    with pytest.raises(ValueError, match="byte-level"):
        tokenfile.highest_id(str(Path(queries.tokenizer()).with_name("word_bpe_49k.json")))


def brute_language(train, texts, min_count=2):
    """Languages by the rule in the module's text: words first, then n-grams of five letters down to one."""
    langs = sorted({lang for _, lang in train})
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    grams = lambda w, n: [w[i : i + n] for i in range(len(w) - n + 1)]
    seen = {k: defaultdict(Counter) for k in (0, 5, 4, 3, 2, 1)}
    for t, lang in train:
        for w in words(t):
            seen[0][w][lang] += 1
            for n in (5, 4, 3, 2, 1):
                for g in grams(w, n):
                    seen[n][g][lang] += 1
    totals = {k: {lang: sum(c[lang] for c in seen[k].values()) for lang in langs} for k in seen}
    known = {k: {x for x, c in seen[k].items() if sum(c.values()) >= min_count} for k in seen}

    def logs(kind, x):
        share = [(seen[kind][x][lang] + 0.5) / (totals[kind][lang] + 0.5 * len(known[kind])) for lang in langs]
        return np.log(np.array(share) / sum(share))

    out = []
    for t in texts:
        total, n = np.zeros(len(langs)), 0
        for w in words(t):
            n += 1
            if w in known[0]:
                total += logs(0, w)
                continue
            for size in (5, 4, 3, 2, 1):
                own = [g for g in grams(w, size) if g in known[size]]
                if own:
                    total += sum(logs(size, g) for g in own) / len(own)
                    break
        p = np.exp((total - total.max()) / max(n, 1) * min(n, langid.EVIDENCE))
        out.append((langs[int(total.argmax())], p.max() / p.sum()) if n else ("und", 0.0))
    return out


def test_language_is_what_the_rule_says(spark, documents):
    rng = random.Random(26)
    vocabulary = {lang: [*LANGS[lang].split(), *("".join(rng.choices("abcdeéïßñ" if lang == "bb" else "defghijö", k=rng.randint(3, 9))) for _ in range(60))] for lang in LANGS}
    make = lambda: (lang := rng.choice(sorted(LANGS)), " ".join(rng.choice(vocabulary[lang]).title() + rng.choice(["", "", "x", "9", "."]) for _ in range(rng.randint(1, 25))))
    rows = [(i, *reversed(make())) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    train = docs.where(langid.fold(F.col("doc_id")) != 2)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, langid.train(train)).collect()}
    kept = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    for (i, _, _), (lang, score) in zip(rows, brute_language(kept, [t for _, t, _ in rows]), strict=True):
        assert got[i][1] == pytest.approx(score, abs=1e-4) and (got[i][0] == lang or score < 0.51), i


def test_language(spark, documents, nothing):
    rng = random.Random(6)
    rows = []
    for i in range(900):
        lang = rng.choice(sorted(LANGS))
        rows.append((i, " ".join(rng.choice(LANGS[lang].split()) + (rng.choice(LANGS[lang].split()) if rng.random() < 0.4 else "") for _ in range(rng.randint(8, 60))), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.train(docs.where(langid.fold(F.col("doc_id")) != 2))
    out = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 150 and np.mean([out[i].lang_pred == lang for i, _, lang in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in out.values())
    odd = {r.doc_id: r for r in langid.predict(documents, model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (40, 41, 42, 49))
    assert langid.predict(documents, model).count() == documents.count()
    kept = langid.identified(documents, model)
    assert kept.columns == documents.columns and kept.where("doc_id in (40, 41, 42, 49)").count() == 0
    assert langid.predict(nothing, model).count() == 0
    none = langid.train(nothing)
    assert {r.lang_pred for r in langid.predict(documents, none).collect()} == {"und"}


def test_backoff_goes_from_long_to_short_grams():
    word = lambda w: int(langid._words(pa.array([w]))[4][0])
    def gram(w, n):
        hasher, s, e, _, _ = langid._words(pa.array([w]))
        return np.sort(np.unique(langid._grams(hasher, s, e, n)[0]))

    table = {0: (np.array([word("known")], np.uint64), np.log(np.array([[0.9, 0.1]])))}
    table |= {n: (np.zeros(0, np.uint64), np.zeros((0, 2))) for n in langid.GRAMS}
    three, one = gram("abc", 3), gram("abc", 1)
    table[3] = (three, np.log(np.full((len(three), 2), [0.2, 0.8])))
    table[1] = (one, np.log(np.full((len(one), 2), [0.99, 0.01])))
    model = langid.Model(["x", "y"], table)
    assert model.predict(pa.array(["known", "zabcz", "a", "qq", "9"]))[0] == ["x", "y", "x", "x", "und"]


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def test_quality_counts(spark, documents, nothing, sentence):
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choice([sentence(rng, 3), "same line", "é ü", "", "## | $", "a b c a b c"]) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    more = spark.createDataFrame(rows, "doc_id long, text string").unionByName(documents.select("doc_id", "text"))
    out = quality.judge(more)
    got = Counter(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in out.collect())
    assert got == Counter((r.doc_id, *brute_counts(r.text)) for r in more.collect())
    for r in out.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert quality.judge(nothing).count() == 0


def brute_em(votes, rounds=400, docs=quality.PRIOR_DOCS):
    """Posteriors of good by EM over documents one by one."""
    good = [0.98 if v.count(0) == 0 else 0.3 if v.count(0) == 1 else 0.02 for v in votes]
    for _ in range(rounds):
        chance = []
        for side, prior in zip((good, [1 - g for g in good]), quality.PRIOR, strict=True):
            table = [{x: docs * p + sum(s for s, v in zip(side, votes, strict=True) if v[r] == x) for x, p in zip((-1, 0, 1), prior, strict=True)} for r in range(len(votes[0]))]
            share = (sum(side) + 1) / (len(votes) + 2)
            chance.append([share * np.prod([t[x] / sum(t.values()) for t, x in zip(table, v, strict=True)]) for v in votes])
        good = [a / (a + b) for a, b in zip(*chance, strict=True)]
    return good


def test_posteriors_are_those_of_em_over_documents():
    rng = random.Random(14)
    votes = [tuple(rng.choices((-1, 0, 1), (1, 1, 8) if rng.random() < 0.8 else (2, 5, 3))[0] for _ in range(4)) for _ in range(250)]
    found = quality.fit(sorted((list(v), n) for v, n in Counter(votes).items()))
    assert all(found[v] == pytest.approx(g, abs=1e-3) for v, g in zip(votes, brute_em(votes), strict=True))


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_quality_agrees_with_labels(spark):
    judged = quality.judge(spark.read.parquet(f"{DATA}/documents.parquet")).select("doc_id", "kept", "base_failed", "quality")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col("quality").alias("label")).distinct()
    rows = judged.join(labels, "doc_id").collect()
    bad, good = ([r for r in rows if r.label == x] for x in (0, 1))
    assert sum(r.kept for r in bad) <= 0.05 * len(bad) and sum(r.quality >= 0.5 for r in good) >= 0.95 * len(good)


def test_letters_of_any_script():
    found = quality.counts(pa.array(["Привет Мир", "漢字 仮名", "", None, "ÀÉ ñ", "12 34"]))
    assert found["n_letters"].tolist() == [9, 4, 0, 0, 3, 0] and found["n_upper"].tolist() == [2, 0, 0, 0, 2, 0]


def test_weak_supervision_parts_junk(sentence):
    rng = random.Random(10)
    patterns = Counter()
    for _ in range(3000):
        good = rng.random() < 0.85
        votes = tuple((0 if rng.random() < 0.01 else rng.choice([1, 1, 1, -1])) if good else (0 if rng.random() < 0.4 else rng.choice([1, -1])) for _ in range(7))
        patterns[votes, good] += 1
    totals = Counter()
    for (v, _), n in patterns.items():
        totals[v] += n
    posterior = quality.fit(sorted((list(v), n) for v, n in totals.items()))
    right = sum(n for (v, good), n in patterns.items() if (posterior[v] >= 0.5) == good)
    assert right / 3000 > 0.97 and quality.fit([]) == {}


def test_words_and_slices():
    arr = pa.array(["a b", None, "", " x\ty ", "é"])
    data, offsets = textnum.raw(arr.slice(1))
    s, e, r = textnum.words(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(s, e, strict=True)] == [b"x", b"y", "é".encode()] and r.tolist() == [2, 2, 3]
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 5)], names=["text"])
    assert [p.num_rows for p in textnum.slices(batch, limit=25)] == [2, 2, 1] and [p.num_rows for p in textnum.slices(batch, limit=1)] == [1] * 5


def near_targets(out, longest):
    """Whether each source's taken words are within a document of its target, and none is taken more than three times."""
    taken, want = Counter(), {}
    for r in out:
        taken[r.source_size, r.target] += r.taken
        want[r.source_size, r.target] = r.target
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    assert all(abs(taken[k] - t) <= 2 * longest for k, t in want.items()), (taken, want)


def test_mix_of_rows_without_or_under_one_id(spark, sentence):
    """Rows without doc_id, different texts under one doc_id, and equal rows are taken near their source's target."""
    rng = random.Random(9)
    others = [(i, " ".join(["w"] * rng.randint(5, 60)) + f" {i}", f"s{i % 2 + 1}") for i in range(3000)]
    for case in ("null", "shared", "equal"):
        own = [(None if case == "null" else 7, ("x " * 49 + (str(i) if case != "equal" else "x")), "s0") for i in range(3000)]
        docs = spark.createDataFrame(others + own, "doc_id long, text string, source string").repartition(6)
        out = mixing.mix(docs, rows_per_range=100).collect()
        assert len(out) == 6000
        near_targets(out, 61)
        rows = Counter((r.doc_id, r.size, r.taken) for r in out)
        assert rows == Counter((r.doc_id, r.size, r.taken) for r in mixing.mix(docs.repartition(3), rows_per_range=100).collect())
        copies = Counter(r.doc_id for r in mixing.mixed(docs).collect())
        want = Counter()
        for r in mixing.mix(docs).collect():
            want[r.doc_id] += r.taken // r.size if r.size else 0
        assert copies == +want


def test_mix_of_one_text(spark):
    docs = spark.createDataFrame([(None, "a b c", None)] * 500 + [(1, "d e f", "s")] * 7, "doc_id long, text string, source string").repartition(4)
    out = mixing.mix(docs).collect()
    near_targets(out, 3)
    assert sum(r.taken for r in out) <= 507 * 3
