"""Benchmark decontamination by spaced seeds.

A mask of fixed form slides over the tokens of benchmark items and documents; the tokens it selects are hashed,
those it ignores may differ. Hashes of both sides are joined, each hit fixes how a document lies against an item,
and all their tokens that then face each other are compared one by one, with +1 for each equal token and -4 for each
substituted one: the overlap is the part of `min_overlap` tokens or more, from an equal token to an equal token, with
the highest sum. Documents with an overlap of `min_overlap` tokens (the whole item if it has fewer) with four tokens
in five equal are contaminated. Of a document only the tokens that face the item are sent to be compared, so what a
candidate weighs follows the item and not the document.

A seed that more than MANY items share, such as a common phrase, would make a candidate of each of them for each document
that holds it. Such seeds join by windows instead: `min_overlap` tokens or one more around the seed, hashed with its two end
tokens. A shared phrase shorter than `min_overlap` then meets only items whose tokens beside it agree as well, and every
overlap that counts still has such a window.

Document hashes pass a bit table of the benchmark's hashes before they are shuffled. Its size is bounded whatever
the benchmark's (2**27 bits, 16 MB, and as much for windows): a fuller table lets more hashes through to the join and loses none.

Tokens are runs of ASCII letters, digits and bytes from 0x80, A-Z in lower case. Defined cases: items with fewer
tokens than a mask match whole and exactly; items of fewer than `least` tokens (five) match nothing, as two or three words
stand everywhere, nor do null texts; repeated rows are judged alike, and so each row without doc_id or under a doc_id
that another text has is judged by its own text; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm.identity import keys
from voxelflux.llm.store import prepare, settle

#: 1 takes a token into the hash, 0 ignores it. Together they hit every overlap of 13 tokens or more, and every
#: whole item of 11 or 12, with four tokens in five equal, wherever the others are; a test goes through all cases.
MASKS = ("1111011", "110010111", "11000100111", "11111001")
SPAN = 11
LEAST = 5
#: A seed that more items have is shared: it joins by windows around it.
MANY = 4
#: A window has so many tokens more than min_overlap at most. Overlaps of 13 tokens or more have a mask in a window of 13 or
#: 14 with equal ends; the test of the masks goes through these cases too.
MORE = 1
SUBSTITUTION = 4
TOKEN = np.zeros(256, bool)
TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, and the n + 1 offsets of the rows into them."""
    data, offsets = tn.raw(texts)
    starts, ends, rows = tn.runs(TOKEN[data], offsets)
    n = len(offsets) - 1
    return tn.Hasher(tn.LOWER[data]).of(starts, ends), np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int64)


def seeds(hashes: np.ndarray, at: np.ndarray, masks: tuple[str, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, place, row) of every mask at every place where it fits into its row."""
    n = len(hashes)
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for mask in masks:
        span = len(mask)
        if n < span:
            continue
        fits = rows[: n - span + 1] == rows[span - 1 :]
        h = np.full(n - span + 1, np.uint64(int(mask, 2) * 2 + 1), np.uint64)
        for j, c in enumerate(mask):
            if c == "1":
                h += hashes[j : n - span + 1 + j] * np.uint64(pow(tn.BASE, j + 3, 1 << 64))
        where = np.flatnonzero(fits)
        yield tn.mix(h[where]), where, rows[where]


def windows(hashes: np.ndarray, at: np.ndarray, h: np.ndarray, place: np.ndarray, row: np.ndarray, span: int, min_overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, index into h) of the windows around seeds that lie inside their rows: seed, place in the window, end tokens."""
    for size in range(min_overlap, min_overlap + MORE + 1):
        for before in range(size - span + 1):
            first, last = place - before, place - before + size - 1
            inside = np.flatnonzero((first >= at[row]) & (last < at[row + 1]))
            ends = tn.mix(hashes[first[inside]] + np.uint64(size * 64 + before + 1)) + hashes[last[inside]] * np.uint64(tn.BASE)
            yield tn.mix(h[inside] + tn.mix(ends)), inside


def _item_windows(min_overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "item_tokens"):
                hashes, at = _held(part.column("item_tokens"))
                sizes, names = np.diff(at), part.column("item").to_numpy()
                for mask, (h, place, row) in zip((m for m in MASKS if len(hashes) >= len(m)), seeds(hashes, at, MASKS), strict=True):
                    for e, i in windows(hashes, at, h, place, row, len(mask), min_overlap):
                        out = [pa.array(h[i].view(np.int64)), pa.array(e.view(np.int64)), pa.array(names[row[i]]), pa.array((place[i] - at[row[i]]).astype(np.int32)), pa.array(sizes[row[i]].astype(np.int32))]
                        yield pa.RecordBatch.from_arrays(out, names=["h", "e", "item", "item_at", "n"])

    return run


def _item_seeds(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch, "item_tokens"):
                hashes, at = _held(part.column("item_tokens"))
                sizes = np.diff(at)
                names = part.column("item").to_numpy()
                for size in sorted({SPAN, *sizes[(sizes >= least) & (sizes < SPAN)].tolist()}):
                    for h, place, row in seeds(hashes, at, MASKS if size == SPAN else ("1" * size,)):
                        own = sizes[row] >= SPAN if size == SPAN else sizes[row] == size
                        h, place, row = h[own], place[own], row[own]
                        out = [pa.array(h.view(np.int64)), pa.array(names[row]), pa.array((place - at[row]).astype(np.int32)), pa.array(np.full(len(h), size, np.int32)), pa.array(sizes[row].astype(np.int32))]
                        yield pa.RecordBatch.from_arrays(out, names=["h", "item", "item_at", "size", "n"])

    return run


def _item_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch):
            hashes, at = tokens(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("item_id"), tn.binary(hashes, at)], names=["item_id", "item_tokens"])


def _held(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a binary column and the offsets of its rows."""
    data, offsets = tn.raw(column)
    return np.frombuffer(data.tobytes(), np.uint64), offsets // 8


def _bit_places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def _in_table(h: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    a, b = _bit_places(h, bits)
    return (table[a >> np.uint64(6)] >> (a & np.uint64(63))) & (table[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1)


def _bit_table(seed_rows: DataFrame, bits: int) -> np.ndarray:
    """Which of two bits for each hash are set; at most bits / 64 rows come to the driver."""
    high = F.shiftrightunsigned("h", 32)
    places = F.explode(F.array(F.col("h").bitwiseAND(F.lit(bits - 1)), high.bitwiseAND(F.lit(bits - 1))))
    words = seed_rows.select(places.alias("p")).groupBy(F.shiftrightunsigned("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v"))
    table = np.zeros(bits // 64, np.int64)
    for r in words.toArrow().to_batches():
        table[r.column("w").to_numpy()] = r.column("v").to_numpy()
    return table.view(np.uint64)


def best_overlap(doc: np.ndarray, item: np.ndarray, shift: int, min_overlap: int) -> tuple[int, int, int]:
    """(start in the item, length, equal tokens) of the best overlap at a shift, length 0 if none is long and equal enough."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    same = item[lo:hi] == doc[lo + shift : hi + shift]
    n, sums = len(same), np.concatenate([[0], np.cumsum(np.where(same, 1, -SUBSTITUTION))])
    if len(item) < min_overlap:
        return (0, n, int(same.sum())) if n == len(item) and sums[-1] >= 0 else (0, 0, 0)
    if n < min_overlap:
        return 0, 0, 0
    never = SUBSTITUTION * (n + 1)
    begin = np.where(same, sums[:-1], never)
    low = np.minimum.accumulate(begin)[: n - min_overlap + 1]
    gain = np.where(same, sums[1:], -never)[min_overlap - 1 :] - low
    if gain.max() < 0:
        return 0, 0, 0
    ends = np.flatnonzero(gain == gain.max())
    starts = [int((begin == low[i]).argmax()) for i in ends]
    length, start = max((int(i) + min_overlap - s, s) for i, s in zip(ends, starts, strict=True))
    return lo + start, length, int(same[start : start + length].sum())


def hits(docs: DataFrame, items: DataFrame, min_overlap: int = 13, least: int = LEAST) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, overlap, equal): the longest overlap of each document row with each
    item it holds a part of; places and lengths count tokens. docs has doc_id and text, items item_id and text."""
    return _found(docs, items, min_overlap, least).drop("key", "key2")


def _lain(docs: DataFrame, items: DataFrame, min_overlap: int, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """How rows lie against items (row, item, n, shift); rows with hits and items, by their numbers."""
    spark = prepare(docs.sparkSession)
    item_type, doc_type = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    item_rows = items.select("item_id", "text").mapInArrow(_item_tokens, f"item_id {item_type}, item_tokens binary")
    item_rows = settle(item_rows.withColumn("item", F.monotonically_increasing_id()), "items")
    seed_rows = settle(item_rows.select("item", "item_tokens").mapInArrow(_item_seeds(least), "h long, item long, item_at int, size int, n int"), "seeds")
    n_seeds = seed_rows.count()
    bits = min(1 << 27, max(1 << 16, 1 << int(128 * max(1, n_seeds) - 1).bit_length()))
    sizes = sorted(r.size for r in seed_rows.select("size").distinct().collect())  # least to SPAN
    shared = settle(seed_rows.where((F.col("size") == SPAN) & (F.col("n") >= min_overlap)).groupBy("h").agg(F.count_distinct("item").alias("items")).where(F.col("items") > MANY).select("h"), "shared-seeds")
    second, more_bits, joined = None, 0, seed_rows.select("h", "item", "item_at", "n")
    if not shared.isEmpty():
        rare = seed_rows.join(shared.withColumn("common", F.lit(True)), "h", "left").where(F.col("common").isNull() | (F.col("n") < min_overlap))
        around = item_rows.select("item", "item_tokens").mapInArrow(_item_windows(min_overlap), "h long, e long, item long, item_at int, n int")
        around = settle(around.join(shared, "h", "left_semi").select(F.col("e").alias("h"), "item", "item_at", "n"), "windows")
        more_bits = min(1 << 27, max(1 << 16, 1 << int(128 * max(1, around.count()) - 1).bit_length()))
        second, joined = _bit_table(around, more_bits), rare.select("h", "item", "item_at", "n").unionByName(around)
    sent = spark.sparkContext.broadcast((_bit_table(seed_rows, bits), bits, sizes, second, more_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits, sizes, second, more_bits = sent.value
        masks = [m for size in sizes for m in (MASKS if size == SPAN else ("1" * size,))]
        for batch in batches:
            for part in tn.slices(batch):
                hashes, at = tokens(part.column("text"))
                found = []
                for mask, (h, place, row) in zip((m for m in masks if len(hashes) >= len(m)), seeds(hashes, at, tuple(masks)), strict=True):
                    on = np.flatnonzero(_in_table(h, table, bits))
                    h, place, row = h[on], place[on], row[on]
                    found.append((h, place - at[row], row))
                    for e, i in windows(hashes, at, h, place, row, len(mask), min_overlap) if second is not None and mask in MASKS else ():
                        hit = np.flatnonzero(_in_table(e, second, more_bits))
                        found.append((e[hit], (place - at[row])[i[hit]], row[i[hit]]))
                h, place, row = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
                order = np.argsort(row, kind="stable")
                h, place, row = h[order].view(np.int64), place[order].astype(np.int32), row[order]
                own, first = np.unique(row, return_index=True)
                ends = np.append(first, len(row)).astype(np.int32)
                lists = lambda x: pa.ListArray.from_arrays(pa.array(ends), pa.array(x))
                kept = np.concatenate([hashes[at[r] : at[r + 1]] for r in own]) if len(own) else np.zeros(0, np.uint64)
                kept_at = np.concatenate([[0], np.cumsum(at[own + 1] - at[own])]).astype(np.int64)
                took = part.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([*(took.column(c) for c in ("doc_id", "key", "key2")), lists(h), lists(place), tn.binary(kept, kept_at)], names=["doc_id", "key", "key2", "hs", "places", "tokens"])

    with_hits = docs.select("doc_id", *keys(), "text").mapInArrow(run, f"doc_id {doc_type}, key long, key2 long, hs array<long>, places array<int>, tokens binary")
    with_hits = settle(with_hits.withColumn("row", F.monotonically_increasing_id()), "with-hits")
    each = with_hits.select("row", F.explode(F.arrays_zip("hs", "places")).alias("x")).select("row", F.col("x.hs").alias("h"), F.col("x.places").alias("doc_at"))
    lain = each.join(joined, "h").select("row", "item", "n", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct()
    return lain, with_hits, item_rows


def _found(docs: DataFrame, items: DataFrame, min_overlap: int, least: int) -> DataFrame:
    lain, with_hits, item_rows = _lain(docs, items, min_overlap, least)
    begin = F.greatest("shift", F.lit(0))
    faced = F.substring("tokens", begin * 8 + 1, (F.col("shift") + F.col("n") - begin) * 8)
    candidates = lain.join(with_hits.select("row", "tokens"), "row").select("row", "item", "shift", faced.alias("tokens")).join(item_rows.select("item", "item_tokens"), "item")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shifts = batch.column("shift").to_numpy()
            (d, d_at), (i, i_at) = _held(batch.column("tokens")), _held(batch.column("item_tokens"))
            found = [best_overlap(d[d_at[j] : d_at[j + 1]], i[i_at[j] : i_at[j + 1]], min(int(shifts[j]), 0), min_overlap) for j in range(batch.num_rows)]
            starts, lengths, equal = np.array(found, np.int32).reshape(-1, 3).T
            out = [batch.column("row"), batch.column("item"), pa.array(starts + shifts.astype(np.int32)), pa.array(starts), pa.array(lengths), pa.array(equal)]
            yield pa.RecordBatch.from_arrays(out, names=["row", "item", "doc_start", "item_start", "overlap", "equal"]).filter(pa.array(lengths > 0))

    slim = candidates.select("row", "item", "shift", "tokens", "item_tokens")
    best = F.max(F.struct("overlap", "equal", (-F.col("doc_start")).alias("first"), "item_start")).alias("b")
    found = slim.mapInArrow(compare, "row long, item long, doc_start int, item_start int, overlap int, equal int").groupBy("row", "item").agg(best)
    named = found.join(with_hits.select("row", "doc_id", "key", "key2"), "row").join(item_rows.select("item", "item_id"), "item")
    return named.select("doc_id", "item_id", (-F.col("b.first")).alias("doc_start"), "b.item_start", "b.overlap", "b.equal", "key", "key2")


def clean(docs: DataFrame, items: DataFrame, min_overlap: int = 13, least: int = LEAST) -> DataFrame:
    """The rows of docs, with their own columns, that overlap with no item."""
    bad = _found(docs, items, min_overlap, least).select("key", "key2").distinct()
    return docs.select(*keys(), F.struct("*").alias("packed")).join(bad, ["key", "key2"], "left_anti").select("packed.*")
