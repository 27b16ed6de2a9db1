"""Quality rules under weak supervision.

Each rule votes good or bad or abstains. Which rules are right how often is not known beforehand: expectation-
maximisation estimates, from all documents and without labels, how often each rule gives each vote on good and
on bad text; a document is kept if its posterior probability of being good is 1/2 or more. Votes are counted
by pattern before EM, and there are at most 3 ** number of rules patterns (2,187), so EM runs over a small,
bounded table on the driver whatever the size of the corpus.

Counts, as the base of rules: see measure(). Defined cases: null and empty text have no words and fail the base
rules; extra columns are ignored; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm.store import prepare

#: The characters counted as symbols
SYMBOLS = "#*$%&|<>"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks"]
#: EM ends when no posterior changes by more than this, and it is an error if it does not.
STILL, ROUNDS = 1e-6, 2000
#: So many documents the prior weighs, whatever the number of documents.
PRIOR_DOCS = 100.0
#: Expected shares of abstaining, bad and good votes on good and on bad text.
PRIOR = ((0.2, 0.01, 0.79), (0.3, 0.3, 0.4))


_tables: list[np.ndarray] = []


def letters() -> list[np.ndarray]:
    """Which code points are letters, and which are capitals, by Python's Unicode tables; built once a process."""
    if not _tables:
        for kind in (str.isalpha, str.isupper):
            _tables.append(np.fromiter((kind(chr(c)) for c in range(0x110000)), bool, 0x110000))
    return _tables


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = tn.raw(texts)
    n = len(offsets) - 1
    space = tn.IS_SPACE[data]
    starts, ends, rows = tn.runs(~space, offsets)
    hasher = tn.Hasher(data)
    head = (data & 0xC0) != 0x80  # first bytes of code points
    out = {"n_words": np.bincount(rows, minlength=n), "word_chars": _per_row(head & ~space, offsets), "n_symbols": _per_row(IS_SYMBOL[data], offsets)}
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum(head, dtype=np.int64)])[offsets]  # rows in code points
    letter, upper = letters()
    out |= {"n_upper": _per_row(upper[points], at), "n_letters": _per_row(letter[points], at), "n_marks": _per_row((data == 33) | (data == 124), offsets)}

    lb, le, lr = tn.runs(data != 10, offsets)  # lines without their \n; empty ones have no word anyway
    has = np.concatenate([[0], np.cumsum(~space, dtype=np.int64)])
    full = has[le] > has[lb]
    lb, le, lr = lb[full], le[full], lr[full]
    _, at = tn.distinct(hasher.of(lb, le), lr, n)
    out["n_lines"] = np.bincount(lr, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.diff(at)

    again = np.zeros(len(starts), bool)
    if len(starts) >= 3:
        h = hasher.of(starts, ends)
        same = np.flatnonzero(rows[:-2] == rows[2:])
        windows = tn.mix(tn.mix(tn.mix(h[same]) + h[same + 1]) + h[same + 2]) + rows[same].astype(np.uint64) * np.uint64(tn.BASE)
        _, inverse, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = same[times[inverse] > 1]
        for j in range(3):
            again[twice + j] = True
    out["n_repeat_words"] = np.bincount(rows[again], minlength=n)
    return {k: out[k].astype(np.int64) for k in COUNTS}


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch):
            found = counts(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(found[c]) for c in COUNTS)], names=["doc_id", *COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every whole text of docs (doc_id, text).

    n_words; word_chars, code points in words; n_symbols, characters of SYMBOLS; n_lines, lines with a word;
    n_dup_lines, such lines equal to an earlier one; n_repeat_words, words inside a window of three words that
    is found twice or more; n_upper and n_letters, capitals and letters of any script; n_marks, exclamation marks and bars.
    """
    prepare(docs.sparkSession)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(_measure, schema)


def rules() -> dict[str, Column]:
    """1 good, 0 bad, -1 abstain. Ratios are compared as products, so no division is needed."""
    c = F.col

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, 0).when(good, 1).otherwise(-1)

    w = c("n_words")
    return {
        "symbols": vote(c("n_symbols") * 50 <= w, c("n_symbols") * 10 >= w),
        "dup_lines": vote(c("n_dup_lines") == 0, c("n_dup_lines") * 4 >= c("n_lines")),
        "repeats": vote(c("n_repeat_words") * 20 <= w, c("n_repeat_words") * 5 >= w),
        "word_length": vote(c("word_chars").between(w * 3, w * 10), (c("word_chars") < w * 2) | (c("word_chars") > w * 14)),
        "capitals": vote((c("n_upper") * 5 <= c("n_letters")) & (c("n_letters") > 0), (c("n_upper") * 2 >= c("n_letters")) & (c("n_letters") > 0)),
        "marks": vote(c("n_marks") * 50 <= w, c("n_marks") * 5 >= w),
        "letters": vote(c("n_letters") * 10 >= c("word_chars") * 8, c("n_letters") * 10 <= c("word_chars") * 6),
    }


def fit(patterns: list[tuple[list[int], int]], prior_docs: float = PRIOR_DOCS) -> dict[tuple[int, ...], float]:
    """Posterior of good for each pattern of votes; patterns has (votes, number of documents).

    Two classes and three votes a rule, so abstaining may tell something too. EM starts with any bad vote as
    doubt, two as disbelief, and maximises the posterior under a weak prior on votes (PRIOR, worth `prior_docs`
    documents of each class): a rule seldom speaks against good text, while bad text is of many kinds and each rule sees one.
    """
    if not patterns:
        return {}
    votes = np.array([v for v, _ in patterns])
    n = np.array([k for _, k in patterns], float)
    good = np.select([(votes == 0).sum(1) == 0, (votes == 0).sum(1) == 1], [0.98, 0.3], 0.02)
    onehot = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)
    for _ in range(ROUNDS):
        before, logs = good, []
        for weight, prior in ((n * good, PRIOR[0]), (n * (1 - good), PRIOR[1])):
            seen = np.einsum("p,prv->rv", weight, onehot) + prior_docs * np.array(prior)
            logs.append(np.log((weight.sum() + 1) / (n.sum() + 2)) + np.einsum("prv,rv->p", onehot, np.log(seen / seen.sum(1, keepdims=True))))
        good = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
        if np.abs(good - before).max() <= STILL:
            return {tuple(int(x) for x in v): float(g) for v, g in zip(votes, good, strict=True)}
    raise RuntimeError(f"the votes' posteriors still change after {ROUNDS} rounds")


def judge(docs: DataFrame) -> DataFrame:
    """The counts of measure() with votes, posterior, base_failed and kept for every row of docs (doc_id, text)."""
    voted = measure(docs).withColumn("votes", F.array(*rules().values())).cache()  # one pass over the texts
    posterior = fit(sorted((list(r.votes), r.n) for r in voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()))
    known = json.dumps({",".join(map(str, k)): v for k, v in posterior.items()})
    table = F.from_json(F.lit(known), "map<string,double>")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (
        voted.withColumn("quality", F.element_at(table, F.array_join(F.col("votes").cast("array<string>"), ",")))
        .withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )
