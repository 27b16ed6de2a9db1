"""Language ID by words first, then ever shorter character n-grams.

A word that training text holds is scored by its log frequency in each language. Any other word falls back to
its character n-grams of five letters; if none of them is known, of four, and so on to single letters. Words are
runs of letters in lower case. All scores are log probabilities over the languages, so a word that is equally
common everywhere says nothing.

The model is learnt by Spark from a bounded sample of labelled rows (about `max_rows`, chosen by a hash of doc_id)
and keeps every word and n-gram that the sample holds `min_count` times or more. So its size follows the sample and not
the corpus, and it can be sent to every task. Prediction reads nothing but the text.

Defined cases: null text and text without letters give `und` with score 0; with no labelled rows everything is
`und`; null languages are not learnt; repeated rows are judged alike; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm.store import prepare

GRAMS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
#: A score uses the evidence of so many words at most, or every long text would score 1.
EVIDENCE = 20.0

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters, by Python's Unicode tables; built once a process."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lowered = [(t or "").lower() for t in texts.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
    return np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def _words(texts: pa.Array) -> tuple[tn.Hasher, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    points, offsets = _points(texts)
    starts, ends, rows = tn.runs(letters()[points], offsets)
    hasher = tn.Hasher(points)
    return hasher, starts, ends, rows, hasher.of(starts, ends)


def _grams(hasher: tn.Hasher, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of some words, and the number of the word each comes from."""
    times = np.maximum(ends - starts - n + 1, 0)
    owner = np.repeat(np.arange(len(starts)), times)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times) + starts[owner]
    return hasher.of(at, at + n), owner


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, lang, n): words are kind 0, n-grams kind n; summed within each slice already."""
    for batch in batches:
        for part in tn.slices(batch):
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            hasher, starts, ends, rows, keys = _words(part.column("text"))
            by_lang = code[rows] if len(rows) else np.zeros(0, int)
            for lang, name in enumerate(names):
                own = by_lang == lang
                words, first, times = np.unique(keys[own], return_index=True, return_counts=True)
                s, e = starts[own][first], ends[own][first]
                found = [(0, words, times)]
                for n in GRAMS:
                    grams, owner = _grams(hasher, s, e, n)
                    g, inverse = np.unique(grams, return_inverse=True)
                    found.append((n, g, np.bincount(inverse, weights=times[owner], minlength=len(g)).astype(np.int64)))
                for kind, k, t in found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array([name] * len(k), pa.string()), pa.array(t.astype(np.int64))],
                        names=["kind", "key", "lang", "n"],
                    )


class Model:
    """For each kind sorted keys and one row of log probabilities over the languages for each key."""

    def __init__(self, langs: list[str], tables: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.langs, self.tables = langs, tables

    def look_up(self, kind: int, keys: np.ndarray) -> np.ndarray:
        """Rows of the table, -1 for unknown keys."""
        known, _ = self.tables[kind]
        if not len(known):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, at, -1)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n, k = len(texts), len(self.langs)
        hasher, starts, ends, rows, keys = _words(texts)
        if not len(rows) or not k:
            return [UNKNOWN] * n, np.zeros(n)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = self.look_up(0, unique)
        logs = np.where((at >= 0)[:, None], self.tables[0][1][at] if len(self.tables[0][0]) else 0.0, 0.0)
        left = np.flatnonzero(at < 0)
        for size in GRAMS:
            if not len(left):
                break
            grams, owner = _grams(hasher, starts[first[left]], ends[first[left]], size)
            found = self.look_up(size, grams)
            grams, owner = found[found >= 0], owner[found >= 0]
            times = np.bincount(owner, minlength=len(left))
            sums = np.stack([np.bincount(owner, weights=self.tables[size][1][grams, j] if len(grams) else None, minlength=len(left)) for j in range(k)], 1)
            hit = times > 0
            logs[left[hit]] = sums[hit] / times[hit, None]
            left = left[~hit]
        total = np.stack([np.bincount(rows, weights=logs[inverse, j], minlength=n) for j in range(k)], 1)
        words = np.bincount(rows, minlength=n)
        mean = total / np.maximum(words, 1)[:, None] * np.minimum(words, EVIDENCE)[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = total.argmax(1)
        return [self.langs[b] if w else UNKNOWN for b, w in zip(best, words, strict=True)], np.where(words > 0, p[np.arange(n), best], 0.0)


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4; rows where it is 2 are held out of training."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def train(docs: DataFrame, max_rows: int = 12_000, min_count: int = 2) -> Model:
    """Learn from docs (doc_id, text, lang), all of which are seen as training rows; bounds as in the module's text."""
    prepare(docs.sparkSession)
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    rows = labelled.count()
    if rows > max_rows:
        own = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
        labelled = labelled.where(F.pmod(own, F.lit(1 << 30)) < int(max_rows / rows * (1 << 30)))
    counted = labelled.mapInArrow(_count, "kind int, key long, lang string, n long").groupBy("kind", "key", "lang").agg(F.sum("n").alias("n")).cache()
    totals = {(r.kind, r.lang): r.n for r in counted.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({lang for _, lang in totals})
    empty = {kind: (np.zeros(0, np.uint64), np.zeros((0, len(langs)), np.float32)) for kind in (0, *GRAMS)}
    if not langs:
        return Model(langs, empty)
    per_lang = [F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, lang in enumerate(langs)]
    known = counted.groupBy("kind", "key").agg(F.sum("n").alias("all"), *per_lang).where(F.col("all") >= min_count).drop("all").toArrow()
    counted.unpersist()
    kinds, keys = known.column("kind").to_numpy(), known.column("key").to_numpy().view(np.uint64)
    n = np.stack([known.column(f"n{i}").to_numpy() for i in range(len(langs))], 1).astype(float)
    del known
    pa.default_memory_pool().release_unused()
    tables = dict(empty)
    for kind in np.unique(kinds).tolist():
        own = np.flatnonzero(kinds == kind)
        own = own[np.argsort(keys[own])]
        share = (n[own] + 0.5) / (np.array([totals[kind, lang] for lang in langs]) + 0.5 * len(own))
        tables[kind] = (keys[own], np.log(share / share.sum(1, keepdims=True)).astype(np.float32))
    return Model(langs, tables)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of docs (doc_id, text)."""
    sent = prepare(docs.sparkSession).sparkContext.broadcast((model.langs, model.tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            for part in tn.slices(batch):
                lang, score = own.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c != "text"), pa.array(lang, pa.string()), pa.array(score)], names=[*(c for c in part.schema.names if c != "text"), "lang_pred", "score"])

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identified(docs: DataFrame, model: Model, min_score: float = 0.5) -> DataFrame:
    """The rows of docs, with their own columns, whose language is known with min_score at least."""
    sent = prepare(docs.sparkSession).sparkContext.broadcast((model.langs, model.tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            for part in tn.slices(batch):
                lang, score = own.predict(part.column("text"))
                keep = pa.array([name != UNKNOWN and s >= min_score for name, s in zip(lang, score, strict=True)], pa.bool_())
                yield part.filter(keep)

    return docs.mapInArrow(run, docs.schema)
