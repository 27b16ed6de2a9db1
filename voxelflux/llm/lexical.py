"""Ranked lexical search by pipelined term partitioning.

The index is partitioned by term: an owner holds all postings of its terms. A bundle of items visits the owners one after
another and carries what its items have scored so far: sparse accumulators, one for each document still in play. Each stage
is a cogroup of the bundles with the owner's postings; contributions are integers, so the order of stages changes nothing.

No bundle grows with the corpus: documents lie in segments of bounded size, and a bundle meets one segment at a time. The
first owners hold the rarest terms (cuts by weight at fixed shares of all postings). After a stage the least score that
an item's best documents are sure of is known for all segments, and an accumulator is dropped once it cannot reach that
with all that later owners could add. Nothing that may be among the best is dropped, whatever the ties.

Scores: a term's weight is floor(1000 ln((2N + 2) / (2df + 1))), a document's m is 75 + 25nN div L, and a term adds
weight * ((10^9 tf) div (1000 tf + 12 m)) for each time the item has it.

Defined cases: a null or empty text has no terms and is no document; an item without terms, or whose terms no document
has, gives no rows; rows that agree in item_id and text are one item, further texts under one item_id are items of their
own; every document row is ranked by itself, also without doc_id (last among equal scores) or under a shared one; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm.store import prepare, settle

#: The bytes of terms [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+, ASCII letters and digits and all beyond ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[0x30:0x3A] = IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Documents and postings of a segment, items of a bundle, and the shares of all postings at which owners end.
SEGMENT_DOCS, SEGMENT_POSTINGS, BUNDLE, OWNERS = 1 << 15, 1 << 21, 256, (0.02, 0.1, 0.35, 1.0)
#: The postings of a very common term are dealt to so many parts when they meet the items that have it.
SALT = 16
UNIT = 1_000_000_000


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts, and start, end, row and hash of every term."""
    data, offsets = tn.raw(texts)
    data = tn.LOWER[data]
    starts, ends, rows = tn.runs(IS_TERM[data], offsets)
    return data, starts, ends, rows, tn.Hasher(data).of(starts, ends)


def _spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    content = data.tobytes()
    return [content[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch):
            data, starts, ends, rows, hashes = terms(part.column("text"))
            took = part.column("item").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([took, pa.array(hashes.view(np.int64)), pa.array(_spelled(data, starts, ends), pa.string())], names=["item", "h", "term"])


def _bits(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for each hash; at most bits / 64 rows come to the driver."""
    place = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = hashes.select(place.alias("p")).groupBy(F.shiftrightunsigned("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v"))
    table = np.zeros(bits // 64, np.int64)
    for batch in words.toArrow().to_batches():
        table[batch.column("w").to_numpy()] = batch.column("v").to_numpy()
    return table.view(np.uint64)


def index(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Segments of docs (doc_id, text) and their postings of the terms whose hash h is in wanted, written once.

    A segment is one row with term null: its doc_ids in ascending order (null last), their numbers of terms. Each other
    row is one term in one segment: places in the segment, occurrences. A segment never spans two tasks.
    """
    spark = prepare(docs.sparkSession)
    n = wanted.count()
    bits = min(1 << 27, max(1 << 16, 1 << int(64 * max(1, n) - 1).bit_length()))
    sent = spark.sparkContext.broadcast((_bits(wanted, bits), bits))  # 16 MB at most
    names = ["segment", "term", "ids", "sizes", "places", "tfs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, bits = sent.value
        first = TaskContext.get().partitionId() << 32
        spelled: dict[int, str] = {}

        def close(number: int, held: list) -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays([x[0] for x in held])
            sizes = np.concatenate([x[1] for x in held])
            h, doc, tf = (np.concatenate([x[j] for x in held]) for j in (2, 3, 4))
            order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            doc = place[doc]
            by = np.lexsort((doc, h))
            h, doc, tf = h[by], doc[by].astype("<u2"), tf[by].astype("<u4")
            begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            at = np.append(begin, len(h))
            known = ids.take(pa.array(order))
            rows = len(begin)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([None], pa.string()), pa.array([known.to_pylist()], pa.list_(pa.int64())), pa.array([sizes[order].astype("<u4").tobytes()]), pa.array([None], pa.binary()), pa.array([None], pa.binary())], names=names
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, number)), pa.array([spelled[k] for k in h[begin].tolist()], pa.string()), pa.nulls(rows, pa.list_(pa.int64())), pa.nulls(rows, pa.binary()), tn.binary(doc, at), tn.binary(tf, at)], names=names
            )
            spelled.clear()

        held, docs_held, postings = [], 0, 0
        for batch in batches:
            for part in tn.slices(batch):
                data, starts, ends, rows, hashes = terms(part.column("text"))
                sizes = np.bincount(rows, minlength=part.num_rows)
                p = hashes & np.uint64(bits - 1)
                on = np.flatnonzero((table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1))
                row, h = rows[on], hashes[on]
                order = np.lexsort((h, row))
                row, h, on = row[order], h[order], on[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.zeros(0, bool)
                begin = np.flatnonzero(new)
                tf = np.diff(np.append(begin, len(h)))
                row, h, on = row[begin], h[begin], on[begin]
                some = sizes > 0  # a text without terms is no document
                local = np.cumsum(some) - 1
                for part_at in range(0, max(1, part.num_rows), SEGMENT_DOCS):  # a slice of very many short texts is several segments
                    upto = min(part.num_rows, part_at + SEGMENT_DOCS)
                    mine = slice(*np.searchsorted(row, [part_at, upto]))
                    kept = np.flatnonzero(some[part_at:upto]) + part_at
                    if held and (docs_held + len(kept) > SEGMENT_DOCS or postings > SEGMENT_POSTINGS):
                        yield from close(first, held)
                        first, held, docs_held, postings = first + 1, [], 0, 0
                    if not len(kept):
                        continue
                    fresh = np.unique(h[mine], return_index=True)
                    missing = [j for k, j in zip(fresh[0].tolist(), fresh[1].tolist(), strict=True) if k not in spelled]
                    where = on[mine][missing]
                    spelled.update(zip(h[mine][missing].tolist(), _spelled(data, starts[where], ends[where]), strict=True))
                    held.append((part.column("doc_id").take(pa.array(kept)), sizes[kept], h[mine], local[row[mine]] - local[kept[0]] + docs_held, tf[mine]))
                    docs_held, postings = docs_held + len(kept), postings + (mine.stop - mine.start)
        if held:
            yield from close(first, held)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settle(slim.mapInArrow(run, "segment long, term string, ids array<long>, sizes binary, places binary, tfs binary"), "index")


def _query(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items (item, item_id) by number, and (item, term, h, q) with q the occurrences of a term in an item."""
    rows = settle(items.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    found = rows.select("item", "text").mapInArrow(_item_terms, "item long, h long, term string")
    return rows.select("item", "item_id"), settle(found.groupBy("item", "term", "h").agg(F.count(F.lit(1)).alias("q")), "item-terms")


def _weights(rows: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(term, w, most): the weight of every term that documents have, and the most that one occurrence in an item can add."""
    ones = rows.where("term is not null").select("segment", "term", "places", "tfs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = tn.raw(batch.column("tfs"))
            tf, at = np.frombuffer(data.tobytes(), "<u4"), at // 4
            top = np.maximum.reduceat(tf, at[:-1]) if len(at) > 1 else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays([batch.column("term"), pa.array(np.diff(at)), pa.array(top.astype(np.int64))], names=["term", "df", "tf"])

    seen = ones.mapInArrow(run, "term string, df long, tf long").groupBy("term").agg(F.sum("df").alias("df"), F.max("tf").alias("tf"))
    w = F.floor(1000 * F.log((F.lit(2 * n_docs + 2).cast("double")) / (2 * F.col("df") + 1))).cast("long")
    most = F.expr(f"{UNIT} * tf div (1000 * tf + 12 * 75)")
    return seen.select("term", "df", w.alias("w"), (w * most).alias("most"))


def _lengths(rows: DataFrame) -> tuple[int, int]:
    """N and L: documents with a term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.frombuffer(b"".join(batch.column("sizes").to_pylist()), "<u4")
            yield pa.RecordBatch.from_arrays([pa.array([len(n)]), pa.array([int(n.sum(dtype=np.int64))])], names=["docs", "terms"])

    found = rows.where("term is null").select("sizes").mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


def _owner(weights: DataFrame, postings: DataFrame) -> Column:
    """The owner of a weight: the rarest terms first, owners end at OWNERS of all that items add up. One row a weight at most is read."""
    by_weight = postings.join(weights, "term").groupBy("w").agg(F.sum(F.col("df") * F.col("uses")).alias("n")).orderBy(F.desc("w")).collect()
    total, so_far, cuts = sum(r.n for r in by_weight), 0, []
    for r in by_weight:
        while len(cuts) < len(OWNERS) - 1 and so_far >= OWNERS[len(cuts)] * total:
            cuts.append(r.w)
        so_far += r.n
    return sum((F.when(F.col("w") <= c, 1).otherwise(0) for c in cuts), F.lit(0))


def _stage(top: int, stage: int, n_docs: int, n_terms: int):
    """One visit: a bundle's accumulators of a segment meet the owner's postings there."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundles.num_rows:
            return bundles
        row = bundles.to_pylist()[0]
        sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        m = 75 + 25 * sizes * n_docs // n_terms
        items, rest = np.frombuffer(row["items"], "<i8"), np.frombuffer(row["rest"], "<i8").reshape(len(OWNERS), -1)
        floors = np.frombuffer(row["floors"], "<i8") if row["floors"] else np.zeros(len(items), np.int64)
        held, held_at, held_scores = np.frombuffer(row["docs"], "<u2"), np.frombuffer(row["ends"], "<i8"), np.frombuffer(row["scores"], "<i8")
        place_of = {k: j for j, k in enumerate(items.tolist())}
        asked: list[list] = [[] for _ in items]
        for p, t, w, users in zip(*(postings.column(c).to_pylist() for c in ("places", "tfs", "w", "users")), strict=True):
            places, tf = np.frombuffer(p, "<u2"), np.frombuffer(t, "<u4").astype(np.int64)
            adds = w * (UNIT * tf // (1000 * tf + 12 * m[places]))
            for u in users:
                asked[place_of[u["item"]]].append((places, adds, u["q"]))
        docs, scores, best = [], [], []
        sums, seen = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), bool)
        for j in range(len(items)):
            mine = slice(held_at[j - 1] if j else 0, held_at[j])
            sums[:], seen[:] = 0, False
            sums[held[mine]], seen[held[mine]] = held_scores[mine], True
            later = int(rest[stage, j])
            new = int(rest[stage - 1, j]) >= floors[j] if stage else True  # else documents without an accumulator are out of reach
            for places, adds, q in asked[j]:
                sums[places] += adds * q
                if new:
                    seen[places] = True
            there = np.flatnonzero(seen & (sums > 0))
            got = sums[there]
            floor = floors[j]
            if len(there) > top:
                floor = max(floor, np.partition(got, len(got) - top)[len(got) - top])
            keep = got + later >= floor
            docs.append(there[keep].astype("<u2"))
            scores.append(got[keep])
            best.append(np.sort(got)[::-1][:top])
        out = {c: bundles.column(c) for c in ("bundle", "segment", "items", "rest", "sizes")}
        joined = lambda x, t: pa.array([np.concatenate(x).astype(t).tobytes()], pa.binary())
        out |= {"docs": joined(docs, "<u2"), "ends": pa.array([np.cumsum([len(x) for x in docs]).astype("<i8").tobytes()], pa.binary()), "scores": joined(scores, "<i8")}
        out |= {"best": joined(best, "<i8"), "best_ends": pa.array([np.cumsum([len(x) for x in best]).astype("<i8").tobytes()], pa.binary())}
        return pa.table(out)

    return run


def _listed(columns: tuple[str, str]):
    """Rows (item, score, place, segment) of the values that bundles hold for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.frombuffer(row[columns[1]], "<i8")
                owner = np.repeat(np.frombuffer(row["items"], "<i8"), np.diff(ends, prepend=0))
                scores = np.frombuffer(row[columns[0]], "<i8")
                place = np.frombuffer(row["docs"], "<u2").astype(np.int64) if columns[0] == "scores" else np.zeros(len(scores), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(scores), pa.array(place), pa.array(np.full(len(scores), row["segment"]))], names=["item", "score", "place", "segment"])

    return run


LISTED = "item long, score long, place long, segment long"


def _packed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row a bundle: items in order, with columns of theirs as binary, those of `rest` stage by stage."""

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("item")
        out = {"bundle": part.column("bundle").slice(0, 1), "items": pa.array([part.column("item").to_numpy().astype("<i8").tobytes()], pa.binary())}
        for name in columns:
            values = np.array(part.column(name).to_pylist(), "<i8")
            out[name] = pa.array([np.ascontiguousarray(values.T).astype("<i8").tobytes()], pa.binary())
        return pa.table(out)

    return rows.groupBy("bundle").applyInArrow(run, "bundle long, items binary, " + ", ".join(f"{c} binary" for c in columns))


def search(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the top documents of docs (doc_id, text) for each of items (item_id, text)."""
    spark = prepare(docs.sparkSession)
    named, asked = _query(items)
    rows = index(docs, asked.select("h").distinct())
    n_docs, n_terms = _lengths(rows)
    weights = settle(_weights(rows, n_docs, n_terms), "weights")
    uses = asked.groupBy("term").agg(F.count(F.lit(1)).alias("uses"))
    owner = _owner(weights, uses)
    bundles = max(1, -(-named.count() // BUNDLE))
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles))
    query = settle(asked.join(weights, "term").withColumn("owner", owner).withColumn("bundle", bundle), "query")

    # what owners after a stage can add to an item at most
    later = [F.sum(F.when(F.col("owner") > s, F.col("q") * F.col("most")).otherwise(0)) for s in range(len(OWNERS))]
    bounds = query.groupBy("bundle", "item").agg(F.array(*later).alias("rest"))
    heads = _packed(bounds, ["rest"])
    segments = rows.where("term is null").select("segment", "sizes", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long"))).alias("bundle"))
    nothing = F.lit(b"")
    now = segments.join(heads, "bundle").select("bundle", "segment", "items", "rest", "sizes", nothing.alias("docs"), F.lit(None).cast("binary").alias("ends"), nothing.alias("scores"), F.lit(None).cast("binary").alias("floors"))
    now = now.withColumn("ends", F.expr("unhex(repeat('00', cast(octet_length(items) as int)))"))

    who = F.collect_list(F.struct("item", "q")).alias("users")
    users = query.groupBy("owner", "term", "bundle").agg(F.first("w").alias("w"), who)  # at most the items of a bundle
    users = settle(users.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), "users")
    postings = rows.where("term is not null").select("segment", "term", "places", "tfs", F.pmod(F.xxhash64("segment"), F.lit(SALT)).cast("int").alias("salt"))
    schema = "bundle long, segment long, items binary, rest binary, sizes binary, docs binary, ends binary, scores binary, best binary, best_ends binary"
    for stage in range(len(OWNERS)):
        owned = postings.join(users.where(F.col("owner") == stage).drop("owner"), ["term", "salt"]).select(F.col("bundle").alias("to"), F.col("segment").alias("at"), "places", "tfs", "w", "users")
        met = now.groupBy("bundle", "segment").cogroup(owned.groupBy("to", "at")).applyInArrow(_stage(top, stage, n_docs, max(1, n_terms)), schema)
        now = settle(met, f"stage-{stage}")
        if stage + 1 < len(OWNERS):
            sure = now.select("items", "segment", "best", "best_ends").mapInArrow(_listed(("best", "best_ends")), LISTED)
            ranked = sure.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("r") <= top)
            floor = F.when(F.count(F.lit(1)) == top, F.min("score")).otherwise(0)
            floors = bounds.select("bundle", "item").join(ranked.groupBy("item").agg(floor.alias("floors")), "item", "left").fillna(0, ["floors"])
            now = now.drop("best", "best_ends").join(_packed(floors, ["floors"]).select("bundle", "floors"), "bundle")

    final = now.select("items", "segment", "docs", "scores", "ends").mapInArrow(_listed(("scores", "ends")), LISTED)
    in_segment = Window.partitionBy("item", "segment").orderBy(F.desc("score"), "place")
    near = final.withColumn("r", F.row_number().over(in_segment)).where(F.col("r") <= top).drop("r")  # places follow doc_id
    ids = rows.where("term is null").select("segment", "ids")
    told = near.join(ids, "segment").withColumn("doc_id", F.element_at("ids", (F.col("place") + 1).cast("int"))).drop("ids")
    whole = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = told.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    return best.join(named, "item").select("item_id", "rank", "doc_id", "score")
