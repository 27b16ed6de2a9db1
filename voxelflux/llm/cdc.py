"""Substring dedup by content-defined chunks.

A gear rolling hash runs over the bytes of every text: each byte's random 32-bit value is added to the hash shifted
by one bit, so the hash sees the last 32 bytes. A chunk ends where the hash is the least of the `WINDOW` places before and
after, so a cut depends on the bytes around it and on nothing else: an insertion moves no cut but those near it, and a
passage has the same cuts wherever it stands. Where text repeats itself in short periods, equal minima stand side by
side; one in `WINDOW` bytes is a cut. Stretches without a cut are divided every `MOST` bytes.

 1. Chunks are compared by a 64-bit digest. A chunk that its document has before is a repeat of the last such place, as
    the task that cuts the document sees. Of the others the first one of a digest (smallest document) stays, and later
    ones are repeats of it. The rows of a digest are pre-aggregated to its first place; a digest that very many
    documents hold is one skewed key of a join with that one row, which adaptive execution splits.
 2. Repeats that touch and repeat one place of one document are a run. A passage begins and ends inside chunks, so the
    bytes around a run are compared with those around the place it repeats, `REACH` to each side, as are its outer
    chunks themselves. What is left after that has its true bounds; with `min_span` bytes or more it is a repeat.
 3. Repeats that touch or overlap are one span.

A chunk is compared with one place only. So a passage can lose up to a chunk at an edge, or be missed, if
all of its chunks stand still earlier in other surroundings.

Documents are told apart by identity.numbered(): ids, then rows without id and further texts under one id, each a
document of its own; rows that agree in id and text are one document, and no repeats of each other. Other cases:
null and empty texts have no chunks; an empty table gives no rows; other columns are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm.identity import numbered, one_each
from voxelflux.llm.store import prepare, settle

#: A cut is the least of 2 * WINDOW + 1 places, so chunks have some 49 bytes. REACH is MOST, so that a passage's last bytes, which are
#: fewer than MOST after its last cut, are compared whole.
WINDOW, MOST, REACH, MIN_SPAN = 24, 256, 256, 96
#: A repeated string of so many bytes holds a whole chunk, but for stretches of few different bytes; shorter ones hold one less often.
SURE = 200
SEEN = 31  # places that the hash at a byte sees before it
#: One value for each byte, from a rule, so that every run cuts alike.
GEAR = (tn.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(tn.BASE)) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: the sum of the last 32 gear values, each shifted by its age."""
    h, width = GEAR[data], 1
    while width < 32:
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h, width = more, 2 * width
    return h


def cuts(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places in all rows where a chunk begins because the hash of the byte before is a local minimum."""
    n = len(data)
    if n < SEEN + 2 * window + 1:
        return np.zeros(0, np.int64)
    h = gear(data)
    low, width = h, 1
    while width < window:  # low[i] becomes the least of h[i : i + window]
        step = min(width, window - width)
        low, width = np.minimum(low[:-step], low[step:]), width + step
    at = np.arange(window, n - window)
    at = at[(h[at] <= low[: n - 2 * window]) & (h[at] <= low[window + 1 :])]
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = (at - offsets[row] >= SEEN + window) & (at + window < offsets[row + 1])  # no hash of the row before or after
    at, row = at[inside], row[inside]
    new = np.append(True, (np.diff(at) > window) | (row[1:] != row[:-1]))[: len(at)]
    if not new.all():  # equal minima stand side by side where text repeats itself: one in `window` places from the first on
        place = (at - at[np.flatnonzero(new)[np.cumsum(new) - 1]]) // window
        at = at[new | np.append(True, place[1:] != place[:-1])]
    return at + 1


def chunks(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all chunks of all rows, and their ends."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], cuts(data, offsets, window))
    ends = np.append(starts[1:], n)
    extra = (ends - starts - 1) // most
    if extra.any():
        owner = np.repeat(np.arange(len(starts)), extra)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        starts = np.sort(np.concatenate([starts, starts[owner] + step * most]))
        ends = np.append(starts[1:], n)
    return starts, ends


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of each document; `before` is where the document has the same chunk last before that, null if nowhere."""
    for batch in batches:
        for part in tn.slices(batch):
            data, offsets = tn.raw(part.column("text"))
            starts, ends = chunks(data, offsets)
            row = np.searchsorted(offsets, starts, side="right") - 1
            digest = tn.Hasher(data).of(starts, ends)
            place = (starts - offsets[row]).astype(np.int32)
            own = tn.mix(digest) + row.astype(np.uint64) * np.uint64(tn.BASE)
            order = np.argsort(own, kind="stable")
            again = np.flatnonzero(own[order][1:] == own[order][:-1])
            before = np.full(len(starts), -1, np.int32)
            before[order[again + 1]] = place[order[again]]
            out = [part.column("doc").take(pa.array(row)), pa.array(digest.view(np.int64)), pa.array(place), pa.array((ends - starts).astype(np.int32)), pa.array(before, mask=before < 0)]
            yield pa.RecordBatch.from_arrays(out, names=["doc", "digest", "start", "length", "before"])


def _shared(a: pa.Array, b: pa.Array, backwards: bool) -> np.ndarray:
    """How many bytes the values of two binary columns share at their starts, or at their ends."""
    (x, x_at), (y, y_at) = tn.raw(a), tn.raw(b)
    out = np.zeros(len(a), np.int64)
    for i in range(len(a)):
        u, v = x[x_at[i] : x_at[i + 1]], y[y_at[i] : y_at[i + 1]]
        n = min(len(u), len(v))
        differ = u[len(u) - n :][::-1] != v[len(v) - n :][::-1] if backwards else u[:n] != v[:n]
        out[i] = int(differ.argmax()) if differ.any() else n
    return out


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs with the bytes around both places to runs with their true bounds; runs whose outer chunks differ are dropped."""
    for batch in batches:
        left = _shared(batch.column("left"), batch.column("left1"), True)
        right = _shared(batch.column("right"), batch.column("right1"), False)
        head, tail = batch.column("head").to_numpy(), batch.column("tail").to_numpy()
        start, end = batch.column("start").to_numpy() - (left - head), batch.column("end").to_numpy() + right - tail
        out = [batch.column("doc"), batch.column("doc_id"), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), batch.column("first_doc_id"), batch.column("n")]
        yield pa.RecordBatch.from_arrays(out, names=["doc", "doc_id", "start", "end", "first_doc_id", "n"]).filter(pa.array((left >= head) & (right >= tail)))


def _around(start, end, head, tail):
    """The bytes before the end of a run's first chunk and after the start of its last, REACH beyond the run."""
    begin = F.greatest(start - REACH, F.lit(0))
    return F.substring("bytes", begin + 1, start + head - begin), F.substring("bytes", end - tail + 1, tail + REACH)


def repeated_spans(docs: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """(doc_id, start, length, n_chunks, first_doc_id, doc): byte spans of docs (doc_id, text) that repeat earlier text.

    first_doc_id is the document whose text the span repeats where it begins; doc is the number of identity.numbered().
    """
    prepare(docs.sparkSession)
    slim = one_each(numbered(docs))
    cut = settle(slim.select("doc", "text").mapInArrow(_chunk, "doc long, digest long, start int, length int, before int"), "chunks")
    fresh = cut.where("before is null").drop("before")
    seen = fresh.groupBy("digest").agg(F.min("doc").alias("doc1"), F.min_by("start", "doc").alias("start1"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    repeats = fresh.join(seen, "digest").where("doc > doc1").select("doc", "start", "length", "doc1", (F.col("start") - F.col("start1")).alias("shift"))
    repeats = repeats.unionByName(cut.where("before is not null").select("doc", "start", "length", F.col("doc").alias("doc1"), (F.col("start") - F.col("before")).alias("shift")))
    by_place = Window.partitionBy("doc", "doc1", "shift").orderBy("start")
    touches = F.col("start") == F.lag(F.col("start") + F.col("length")).over(by_place)
    runs = (
        repeats.withColumn("new", F.when(touches, 0).otherwise(1)).withColumn("run", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc", "doc1", "shift", "run")
        .agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"), F.min_by("length", "start").alias("head"), F.max_by("length", "start").alias("tail"), F.count(F.lit(1)).alias("n"))
        .drop("run")
    )
    texts = slim.select(F.col("doc").alias("own"), F.col("doc_id").alias("own_id"), F.encode("text", "UTF-8").alias("bytes")).repartition("own")
    left1, right1 = _around(F.col("start") - F.col("shift"), F.col("end") - F.col("shift"), F.col("head"), F.col("tail"))
    there = runs.join(texts, F.col("doc1") == F.col("own")).select(*runs.columns, F.col("own_id").alias("first_doc_id"), left1.alias("left1"), right1.alias("right1"))
    left, right = _around(F.col("start"), F.col("end"), F.col("head"), F.col("tail"))
    both = there.join(texts, F.col("doc") == F.col("own")).select("doc", F.col("own_id").alias("doc_id"), "start", "end", "head", "tail", "first_doc_id", "n", left.alias("left"), right.alias("right"), "left1", "right1")
    found = both.mapInArrow(_extend, "doc long, doc_id long, start int, end int, first_doc_id long, n long").where(F.col("end") - F.col("start") >= min_span)
    in_order = Window.partitionBy("doc").orderBy("start", "end")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        found.withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
        .withColumn("span", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc", "span")
        .agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n_chunks"), F.min_by("first_doc_id", F.struct("start", "first_doc_id")).alias("first_doc_id"))
    )
    return spans.select("doc_id", "start", (F.col("end") - F.col("start")).alias("length"), "n_chunks", "first_doc_id", "doc")


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with the bytes of spans (doc, start, length) taken out of text; broken characters at the edges are dropped, other columns stay."""
    held = spans.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"))
    names = docs.columns
    joined = numbered(docs, F.struct("*").alias("packed")).join(held, "doc", "left")
    data, n = F.encode("text", "UTF-8"), F.size("spans")
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("spans", i - 1)["start"] + F.get("spans", i - 1)["length"])
    end = lambda i: F.when(i == n, F.octet_length(data)).otherwise(F.get("spans", i)["start"])
    kept = lambda i: F.substring(data, begin(i) + 1, end(i) - begin(i)).cast("string")
    parts = F.transform(F.sequence(F.lit(0), n), lambda i: F.coalesce(F.try_validate_utf8(kept(i)), F.make_valid_utf8(kept(i))))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.replace(F.array_join(parts, ""), F.lit("�"), F.lit("")))
    return joined.select(*(text.alias(c) if c == "text" else F.col("packed")[c].alias(c) for c in names))
