"""Cross-tokenizer alignment, with pairs of ids counted externally by spilled runs.

Tokenizer A (byte-level BPE, space + text) and B (pieces with byte fallback, which adds the space itself) cut the same
bytes. Offsets where tokens of both end part them into groups; an A and a B token are linked where their bytes overlap. A
pair's count is the number of document rows that hold it linked, in the whole corpus.

How pairs are counted: a task collects pair-document records into runs of bounded size, sorted by pair and dealt by a radix
of the A id, each part as zstd bytes. The heads of runs (pairs and how many documents of the run hold them) are merged by a
k-way heap over their blocks, at most FAN runs at a time, level by level until one is left. Pairs come out of a merge with
A major, so the highest count of an A id is known when its last pair has passed. Counts then stream back down the levels to
the runs, which hold the documents: they add them up by document. A pair that every document holds is one entry a run, so no
key grows with the corpus, and texts, records and groups are never sorted by Spark.

Texts are cut before a space that follows a solid character; no piece of either vocabulary reaches across such a place
(checked for B when it is loaded), so what is known of a piece, its ids, groups and links, is worked out once a worker.
Documents in which a piece doesn't come back byte by byte are encoded as a whole, which settles them.

Defined cases: a text that is null or empty, or whose joined tokens of A or B differ from space + text, has no tokens: zeros
and empty groups; every row is a document of its own, whatever its doc_id; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm import tokenfile
from voxelflux.llm.store import prepare, settle

#: Records of a run, parts by A id, runs that one merge takes, entries of a block in it.
RUN, RADIX, FAN, BLOCK = 1_500_000, 32, 256, 4096
#: Pieces that a worker remembers; it starts anew beyond that.
MEMORY = 400_000
SPACE, MARK = 0x20, "▁"
DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups {}"


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Ids, groups and links of pieces, remembered by a hash of their bytes."""

    def __init__(self, path_a: str, path_b: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        tokenfile.highest_id(path_a)  # an error unless A is a plain byte-level BPE
        self.a, self.b, self.memory = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b), memory
        self.a.encode_special_tokens = True
        byte_of = _byte_level()
        self.bytes_a = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        if any(x != MARK and y == MARK for p in pieces for x, y in zip(p, p[1:], strict=False)):
            raise ValueError(f"{path_b} has pieces that reach across a space; texts can't be cut there")
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slots, self.known = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        self.counts = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, whole
        self.names: list[bytes] = []
        self.pairs, self.pair_at, self.times = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A and by B of texts that begin with a space."""
        return [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)], self.b.encode([p[1:] for p in pieces], num_threads=1)

    def aligned(self, pieces: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """For each piece: counts, groups as text; all links as pairs with the piece they lie in, in order."""
        found_a, found_b = self.encode(pieces)
        counts, names = np.zeros((len(pieces), 5), np.int64), [b""] * len(pieces)
        good = []
        for i, (p, a, b) in enumerate(zip(pieces, found_a, found_b, strict=True)):
            content = p.encode()
            if b"".join([self.bytes_a[x] for x in a]) == content and b"".join([self.bytes_b[x] for x in b]) == content:
                good.append(i)
        counts[good, 4] = 1
        a = np.fromiter((x for i in good for x in found_a[i]), np.int64)
        b = np.fromiter((x for i in good for x in found_b[i]), np.int64)
        of = np.array(good, np.int64)
        own_a, own_b = (np.repeat(of, [len(x[i]) for i in good]) for x in (found_a, found_b))
        end_a = np.cumsum(np.fromiter((len(self.bytes_a[x]) for x in a.tolist()), np.int64, len(a)))
        end_b = np.cumsum(np.fromiter((len(self.bytes_b[x]) for x in b.tolist()), np.int64, len(b)))
        begin_a = np.concatenate([[0], end_a[:-1]]) if len(a) else end_a
        low, high = np.searchsorted(end_b, begin_a, side="right"), np.searchsorted(end_b, end_a, side="left")
        each = high - low + 1
        left = np.repeat(np.arange(len(a)), each)
        right = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(low, each)
        pairs, owner = a[left].astype(np.uint64) << np.uint64(32) | b[right].astype(np.uint64), own_a[left]
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        upto_a, upto_b = np.searchsorted(end_a, both) + 1, np.searchsorted(end_b, both) + 1
        for column, owners in ((0, own_a), (1, own_b), (2, own_a[upto_a - 1] if len(both) else own_a), (3, owner)):
            counts[:, column] = np.bincount(owners, minlength=len(pieces))
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups = [",".join(text_a[i:j]) + "|" + ",".join(text_b[k:m]) for i, j, k, m in zip([0, *upto_a[:-1].tolist()], upto_a.tolist(), [0, *upto_b[:-1].tolist()], upto_b.tolist(), strict=True)] if len(both) else []
        at = 0
        for i in good:
            names[i] = ";".join(groups[at : at + counts[i, 2]]).encode()
            at += int(counts[i, 2])
        return counts, names, pairs, owner, own_a

    def slots_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number in this worker's memory of each piece of data."""
        unique, first, inverse = np.unique(tn.Hasher(data).of(starts, ends), return_index=True, return_inverse=True)
        if self.known + len(unique) > self.memory and self.known:
            self._forget()
        at = np.searchsorted(self.keys, unique)
        there = np.zeros(len(unique), bool)
        there[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] == unique[at < len(self.keys)]
        new = np.flatnonzero(~there)
        if len(new):
            content = data.tobytes()
            counts, names, pairs, owner, _ = self.aligned([content[s:e].decode() for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            order = np.lexsort((pairs, owner))
            pairs, owner = pairs[order], owner[order]
            begin = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])])) if len(pairs) else np.zeros(0, np.int64)
            times = np.diff(np.append(begin, len(pairs)))
            sizes = np.bincount(owner[begin], minlength=len(new)) if len(begin) else np.zeros(len(new), np.int64)
            self.pairs, self.times = np.concatenate([self.pairs, pairs[begin]]), np.concatenate([self.times, times])
            self.pair_at = np.concatenate([self.pair_at, self.pair_at[-1] + np.cumsum(sizes)])
            self.counts = np.concatenate([self.counts, counts])
            self.names += names
            spot = at[new]
            self.keys, self.slots = np.insert(self.keys, spot, unique[new]), np.insert(self.slots, spot, self.known + np.arange(len(new)))
            self.known += len(new)
        return self.slots[np.searchsorted(self.keys, unique)][inverse]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python worker, kept for its later tasks."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def _spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of space + text for each row, nothing for null and empty texts."""
    data, offsets = tn.raw(texts)
    some = np.diff(offsets) > 0
    shift = np.cumsum(some)
    out = np.full(len(data) + int(shift[-1]) if len(shift) else 0, SPACE, np.uint8)
    out[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = data
    return out, offsets + np.concatenate([[0], shift])


def documents(texts: pa.Array, own: Aligner) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """For each text counts (n_a, n_b, n_groups, n_links) and groups; and by row and pair the number of links, sorted so."""
    data, offsets = _spaced(texts)
    n = len(offsets) - 1
    starts = tokenfile.pieces(data, offsets)
    starts = starts[starts < len(data)]
    starts = starts[data[starts] == SPACE]  # a line end may be part of a piece with what is before it in B
    rows = np.searchsorted(offsets, starts, side="right") - 1
    slots = own.slots_of(data, starts, np.append(starts[1:], len(data))) if len(starts) else np.zeros(0, np.int64)
    found = own.counts[slots]
    odd = np.unique(rows[found[:, 4] == 0])
    usual = ~np.isin(rows, odd)
    rows, slots, found = rows[usual], slots[usual], found[usual]
    counts = np.stack([np.bincount(rows, weights=found[:, j], minlength=n).astype(np.int64) for j in range(4)], 1)
    at = np.searchsorted(rows, np.arange(n + 1))
    listed = slots.tolist()
    names = [b";".join([own.names[s] for s in listed[i:j]]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    both, often = np.unique(rows << np.int64(32) | slots, return_counts=True)  # each piece of a text once
    row, slot = both >> np.int64(32), both & np.int64((1 << 32) - 1)
    sizes = own.pair_at[slot + 1] - own.pair_at[slot]
    where = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - own.pair_at[slot], sizes)
    pairs, row, times = own.pairs[where], np.repeat(row, sizes), own.times[where] * np.repeat(often, sizes)
    if len(odd):
        content = data.tobytes()
        more, odd_names, odd_pairs, owner, _ = own.aligned([content[offsets[i] : offsets[i + 1]].decode() for i in odd.tolist()])
        counts[odd] = more[:, :4]
        for i, name in zip(odd.tolist(), odd_names, strict=True):
            names[i] = name
        pairs, row, times = np.concatenate([pairs, odd_pairs]), np.concatenate([row, odd[owner]]), np.concatenate([times, np.ones(len(owner), np.int64)])
    order = np.lexsort((pairs, row))
    pairs, row, times = pairs[order], row[order], times[order]
    begin = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (row[1:] != row[:-1])])) if len(pairs) else np.zeros(0, np.int64)
    return counts, names, row[begin], pairs[begin], np.add.reduceat(times, begin) if len(begin) else times


def _press(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    for x in arrays:
        small = x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)
        np.save(out, small, allow_pickle=False)
    return zstandard.compress(out.getvalue(), 3)


def _unpress(content: bytes, n: int) -> list[np.ndarray]:
    held = io.BytesIO(zstandard.decompress(content))
    return [np.load(held, allow_pickle=False) for _ in range(n)]


def _press_pairs(pairs: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted pairs as differences, which are small, and what goes with them."""
    return _press(np.diff(pairs, prepend=np.uint64(0)), *more)


def _unpress_pairs(content: bytes, n: int) -> list[np.ndarray]:
    steps, *more = _unpress(content, n)
    return [np.cumsum(steps.astype(np.uint64), dtype=np.uint64), *(x.astype(np.int64) for x in more)]


def radix_of(pairs: np.ndarray) -> np.ndarray:
    return (tn.mix(pairs >> np.uint64(32)) % np.uint64(RADIX)).astype(np.int64)


def _to_batch(table: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(table)
    return out.getvalue()


def runs(docs: DataFrame, path_a: str, path_b: str, digest: bool, size: int = RUN) -> DataFrame:
    """(run, radix, head, records, docs): the spilled runs, written once. radix -1 holds a run's documents, without n_best and count_sum."""
    spark = prepare(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        held, documents_held, records = [], 0, 0

        def close(number: int) -> pa.RecordBatch:
            ids, counts, names = pa.concat_arrays([x[0] for x in held]), np.concatenate([x[1] for x in held]), pa.concat_arrays([x[2] for x in held])
            row, pairs, times = (np.concatenate([x[j] for x in held]) for j in (3, 4, 5))
            order = np.argsort(pairs, kind="stable")
            row, pairs, times = row[order], pairs[order], times[order]
            table = pa.RecordBatch.from_arrays([ids, *(pa.array(counts[:, j]) for j in range(4)), names], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
            radix = radix_of(pairs)
            out = [(number, -1, None, None, _to_batch(table))]
            for r in np.unique(radix).tolist():
                mine = radix == r
                p, d, t = pairs[mine], row[mine], times[mine]
                begin = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
                out.append((number, r, _press_pairs(p[begin], np.diff(np.append(begin, len(p)))), _press(d, t), None))
            types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=["run", "radix", "head", "records", "docs"])

        for batch in batches:
            for part in tn.slices(batch):
                counts, names, row, pairs, times = documents(part.column("text"), own)
                if digest:
                    groups = pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in names], pa.string())
                else:
                    groups = pa.array([x.decode() for x in names], pa.string())
                held.append((part.column("doc_id"), counts, groups, row + documents_held, pairs, times))
                documents_held, records = documents_held + part.num_rows, records + len(pairs)
                if records >= size:
                    yield close(number)
                    number, held, documents_held, records = number + 1, [], 0, 0
        if held:
            yield close(number)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settle(slim.mapInArrow(work, "run long, radix int, head binary, records binary, docs binary"), "runs")


def merged(heads: list[tuple[np.ndarray, np.ndarray]], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs and sums of counts of sorted heads, by a k-way heap over blocks; every yield holds whole A ids, in order."""
    heap = [(int(p[0]), i, 0) for i, (p, _) in enumerate(heads) if len(p)]
    heapq.heapify(heap)
    open_p, open_n, waiting = [], [], 0
    while heap:
        _, i, at = heapq.heappop(heap)
        p, n = heads[i]
        open_p.append(p[at : at + block])
        open_n.append(n[at : at + block])
        waiting += len(open_p[-1])
        if at + block < len(p):
            heapq.heappush(heap, (int(p[at + block]), i, at + block))
        if heap and waiting < 64 * block:
            continue
        p, n = np.concatenate(open_p), np.concatenate(open_n)
        order = np.argsort(p, kind="stable")
        p, n = p[order], n[order]
        # all below the least key that is still to come has passed, and with it the A ids below that key's
        ready = int(np.searchsorted(p, np.uint64(heap[0][0] >> 32 << 32))) if heap else len(p)
        if ready:
            begin = np.flatnonzero(np.concatenate([[True], p[1:ready] != p[: ready - 1]]))
            yield p[begin], np.add.reduceat(n[:ready], begin)
        open_p, open_n, waiting = [p[ready:]], [n[ready:]], len(p) - ready
    if waiting:
        raise AssertionError("a merge has left pairs behind")


def _up(top: bool):
    def run(part: pa.Table) -> pa.Table:
        heads = [_unpress_pairs(x, 2) for x in part.column("head").to_pylist()]
        pairs, counts, best = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for p, n in merged(heads):
            pairs.append(p)
            counts.append(n)
            a = p >> np.uint64(32)
            begin = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            best.append(n == np.repeat(np.maximum.reduceat(n, begin), np.diff(np.append(begin, len(a)))) if top else np.zeros(len(p), bool))
        p, n, b = np.concatenate(pairs), np.concatenate(counts), np.concatenate(best)
        return pa.table({"node": part.column("parent").slice(0, 1), "radix": part.column("radix").slice(0, 1), "head": pa.array([_press_pairs(p, n)]), "told": pa.array([_press_pairs(p, n, b.astype(np.uint8))])})

    return run


def _down(children: pa.Table, parent: pa.Table) -> pa.Table:
    pairs, counts, best = _unpress_pairs(parent.column("told")[0].as_py(), 3)
    out = []
    for head in children.column("head").to_pylist():
        own, _ = _unpress_pairs(head, 2)
        at = np.searchsorted(pairs, own)
        out.append(_press_pairs(own, counts[at], best[at]))
    return pa.table({"node": children.column("node"), "radix": children.column("radix"), "told": pa.array(out, pa.binary())})


def _levels(heads: DataFrame, n_runs: int, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes (node, radix, head, parent) level by level, and the root (node, radix, told) of each radix."""
    level, n, below = heads, n_runs, []
    while True:
        n = max(1, -(-n // fan))
        level = level.withColumn("parent", F.pmod(F.xxhash64(F.lit(len(below)), "node"), F.lit(n)) if n > 1 else F.lit(0).cast("long"))
        below.append(level)
        level = settle(level.groupBy("parent", "radix").applyInArrow(_up(n == 1), "node long, radix int, head binary, told binary"), "merged")
        if n == 1:
            return below, level.select("node", "radix", "told")
        level = level.drop("told")


def counted(all_runs: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(node, radix, told) for each run: count of each of its pairs, and whether it is its A id's highest; and the same of the whole corpus."""
    heads = all_runs.where("radix >= 0").select(F.col("run").alias("node"), "radix", "head")
    n = all_runs.where("radix = -1").count()
    below, root = _levels(heads, n, fan)
    told = root
    for children in reversed(below):
        told = children.groupBy("parent", "radix").cogroup(told.select(F.col("node").alias("top"), F.col("radix").alias("part"), "told").groupBy("top", "part")).applyInArrow(_down, "node long, radix int, told binary")
    return told, root


def _added(own: pa.Table, told: pa.Table) -> pa.Table:
    """The documents of a run with what their links add up to."""
    row = own.filter(pc.equal(own.column("radix"), -1)).column("docs")[0].as_py()
    with pa.ipc.open_stream(row) as reader:
        table = reader.read_all()
    best, total = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, np.int64)
    counts = dict(zip(told.column("part").to_pylist(), told.column("told").to_pylist(), strict=True))
    for radix, head, records in zip(*(own.column(c).to_pylist() for c in ("radix", "head", "records")), strict=True):
        if radix < 0:
            continue
        _, n = _unpress_pairs(head, 2)
        _, count, top = _unpress_pairs(counts[radix], 3)
        doc, times = (x.astype(np.int64) for x in _unpress(records, 2))
        np.add.at(total, doc, np.repeat(count, n) * times)
        np.add.at(best, doc, np.repeat(top, n) * times)
    columns = {c: table.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(columns | {"n_best": pa.array(best), "count_sum": pa.array(total), "groups": table.column("groups")})


def align(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, size: int = RUN, fan: int = FAN) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for every row of docs (doc_id, text); groups as
    `a1,a2|b1;a3|b2,b3`, or their sha256 in hex with digest."""
    all_runs = runs(docs, path_a, path_b, digest, size)
    told, _ = counted(all_runs, fan)
    told = told.select(F.col("node").alias("of"), F.col("radix").alias("part"), "told")
    return all_runs.groupBy("run").cogroup(told.groupBy("of")).applyInArrow(_added, DOC.format("string"))


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(a, b, docs, best) for every pair of ids that is linked somewhere in docs."""
    _, root = counted(runs(docs, path_a, path_b, True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for told in batch.column("told").to_pylist():
                pairs, counts, best = _unpress_pairs(told, 3)
                a, b = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64((1 << 32) - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(counts), pa.array(best > 0)], names=["a", "b", "docs", "best"])

    return root.mapInArrow(run, "a long, b long, docs long, best boolean")
