"""Exact substring dedup over a sparse suffix array.

Of any 100 bytes, the suffix that starts at their smallest 24-byte hash (leftmost if equal) is their anchor: equal
strings have their anchors at equal places, and only one suffix in some 39 is one. So the array holds anchors only,
and still every string of 100 bytes is found under exactly one suffix.

 1. Exact copies of a document become one; later copies are repeats from end to end.
 2. Anchors are dealt to buckets by their leading eight bytes, between at most 8,191 splitters sampled from the corpus
    (beyond that a range is several buckets, by a hash of the leading 24 bytes); a leading
    token that fills several buckets is dealt among them by its hash. A bucket tells which anchors have equals.
 3. Those anchors are dealt again, with the text around them. A bucket sorts what follows the anchors, and what
    comes before them backwards, by multikey quicksort over eight-byte words; common prefixes of neighbours say
    which strings of 100 bytes are equal, and of those all but the first are repeats. Equal strings have equal
    leading tokens and so lie in one bucket: nothing has to be compared across the bounds of buckets.
 4. A document's repeats are united and cut out.

A task sends one anchor for each leading string, and one for each text around it; the others of its own that equal
it are repeats (or have equals) already and only pass through. So a string that a third of all documents hold costs
a bucket one row a task, not one a document. If such a string has another text around it in every document, it would
still be one bucket's work. So leading strings that the sample shows to be frequent (HOT_ROWS) are known beforehand: of the text around these each string of 100 bytes is dealt by its own 128-bit
digest, and equal digests are equal strings. Which strings count as frequent changes no result.

What differs from a full suffix array: suffixes that are no anchors are left out; which anchors have equals is told by
their hashes, without sorting; texts around anchors that are equal as a whole are found by a 64-bit hash, and only those
that differ are sorted; as equal strings always meet in one bucket, the comparison across bounds has nothing to do.

Texts are shuffled once, by number; the three steps that need them share that exchange. Documents are told apart and
put in order by identity.numbered(): ids, then rows without id and further texts under one id, each a document of
its own; rows that agree in id and text are one document and are judged alike. Other cases: null text is empty; texts
under 100 bytes lose nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm.identity import every_row, numbered, one_each, repeated
from voxelflux.llm.store import prepare, settle

WIDTH, GRAM = 100, 24
PLACES = WIDTH - GRAM + 1
BUCKET_BYTES = 8 << 20
SAMPLE_ROWS = 4000
#: Splitters are sent to every task, so there are no more than this; beyond it a range is several buckets, by hash.
MOST_RANGES = 8192
FLUSH = 150_000
#: A leading string is frequent if, by the sample, about so many anchors have it (some 9 MB with the text around them), and if
#: HOT_SEEN of the sample do; MOST_HOT of them are sent to every task at most (8 bytes each).
HOT_ROWS, HOT_SEEN, MOST_HOT = 50_000, 8, 1 << 20

ANCHOR = [("doc", "<i8"), ("first", "<i4"), ("count", "u1"), ("off", "u1"), ("kind", "u1"), ("key", "<u8")]
#: kind of an anchor: alone so far, with equals in its own task, or known to have equals (passes through)
ONE, MORE, SURE = 0, 1, 2


def anchors(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of all strings of WIDTH bytes: for each its row, the first string (its start in the row), the number
    of consecutive strings that share it, its place in the first of them, its hash and its leading eight bytes."""
    n = len(data)
    none = {k: np.zeros(0, t) for k, t in (("row", np.int64), ("first", np.int64), ("count", np.int64), ("off", np.int64), ("key", np.uint64), ("lead", np.uint64))}
    if n < WIDTH:
        return none
    at = np.arange(n - GRAM + 1)
    h = tn.Hasher(data).of(at, at + GRAM)
    low, width = at.astype(np.int32 if n < 1 << 31 else np.int64), 1
    while 2 * width <= PLACES:
        a, b = low[: len(low) - width], low[width:]
        low, width = np.where(h[a] <= h[b], a, b), 2 * width
    if width < PLACES:
        shift = PLACES - width
        a, b = low[: len(low) - shift], low[shift:]
        low = np.where(h[a] <= h[b], a, b)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.flatnonzero(row[: n - WIDTH + 1] == row[WIDTH - 1 :])
    if not len(starts):
        return none
    anchor = low[starts].astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    s, p = starts[first], anchor[first]
    lead = np.zeros(len(p), np.uint64)
    for j in range(8):
        lead = lead << np.uint64(8) | data[p + j].astype(np.uint64)
    return {"row": row[s], "first": s - offsets[row[s]], "count": np.diff(np.append(first, len(starts))), "off": p - s, "key": h[p], "lead": lead}


class Ranges:
    """Buckets by leading bytes: `split` of them for each range between splitters; hot has the hashes of frequent leading strings."""

    def __init__(self, splitters: np.ndarray, split: int = 1, hot: np.ndarray = np.zeros(0, np.uint64)):
        self.splitters, self.split, self.buckets, self.hot = splitters, split, (len(splitters) + 1) * split, hot

    def is_hot(self, key: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(key), bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, key), len(self.hot) - 1)] == key

    def of(self, lead: np.ndarray, key: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.splitters, lead, side="left"), np.searchsorted(self.splitters, lead, side="right")
        place = lo + (key % (hi - lo + 1).astype(np.uint64)).astype(np.int64)
        return place * self.split + (tn.mix(key) % np.uint64(self.split)).astype(np.int64)


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows, and for each in that order how many bytes it shares with the row before it.

    One eight-byte word after the other; only rows that are equal so far are sorted by the next word.
    """
    n, width = rows.shape
    words = np.pad(rows, ((0, 0), (0, -width % 8))).view(">u8").astype(np.uint64)
    order, tied, group = np.arange(n), np.arange(n), np.zeros(n, np.int64)
    for j in range(words.shape[1]):
        if not len(tied):
            break
        own = order[tied]
        inner = np.lexsort((words[own, j], group[tied]))
        order[tied] = own[inner]
        w = words[order[tied], j]
        start = np.ones(len(tied), bool)
        start[1:] = (w[1:] != w[:-1]) | (group[tied][1:] != group[tied][:-1])
        group[tied] = tied[np.flatnonzero(start)][np.cumsum(start) - 1]
        alone = start & np.append(start[1:], True)
        tied = tied[~alone]
    shared = np.zeros(n, np.int64)
    if n > 1:
        for lo in range(1, n, 1 << 15):
            hi = min(n, lo + (1 << 15))
            same = rows[order[lo:hi]] == rows[order[lo - 1 : hi - 1]]
            shared[lo:hi] = np.where(same.all(1), width, same.argmin(1))
    return order, shared


def repeats(doc: np.ndarray, first: np.ndarray, count: np.ndarray, off: np.ndarray, context: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of every string of WIDTH bytes that an earlier place holds too.

    Member i is an anchor with context[at[i]:at[i + 1]]: the count[i] + WIDTH - 1 bytes from its first string on.
    Members are in the order of their places, and no place is given twice.
    """
    n = len(doc)
    right, left = np.zeros((n, WIDTH), np.uint8), np.zeros((n, PLACES), np.uint8)
    anchor, end = at[:-1] + off, at[1:]
    for j in range(WIDTH):
        there = anchor + j < end
        right[there, j] = context[anchor[there] + j]
    for j in range(PLACES - 1):
        there = off > j
        left[there, j] = context[anchor[there] - 1 - j]
    (r_order, r_shared), (l_order, l_shared) = multikey_sort(right), multikey_sort(left)
    r_name, l_name = np.empty(n, np.int64), np.empty(n, np.int64)
    docs, starts = [], []
    for o in range(PLACES):
        own = np.flatnonzero((off >= o) & (off - count < o))
        if len(own) < 2:
            continue
        r_name[r_order] = np.cumsum(r_shared < WIDTH - o)
        l_name[l_order] = np.cumsum(l_shared < o) if o else 0
        name = r_name[own] * (n + 1) + l_name[own]
        _, earliest = np.unique(name, return_index=True)
        late = np.ones(len(own), bool)
        late[earliest] = False
        own = own[late]
        docs.append(doc[own])
        starts.append(first[own] + off[own] - o)
    return (np.concatenate(docs), np.concatenate(starts)) if docs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def united(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of the same doc that touch or overlap as one, sorted by doc and start."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    code = np.cumsum(np.append(True, doc[1:] != doc[:-1])) - 1
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + code * span)  # ends never reach into the next doc's range
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + code[1:] * span > reach[:-1]
    new[1:] |= code[1:] != code[:-1]
    first = np.flatnonzero(new)
    return doc[first], start[first], np.maximum.reduceat(end, first)


def _by_doc(doc: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """One row (doc, blob) a document; doc is sorted, values has one row of fixed width each."""
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    width = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(-1)
    return pa.RecordBatch.from_arrays([pa.array(doc[first].astype(np.int64)), tn.binary(flat, np.append(first, len(doc)) * width)], names=["doc", "blob"])


REQUEST = [("first", "<i4"), ("count", "u1"), ("off", "u1")]


def _deal(parts: list[np.ndarray], leads: list[np.ndarray], ranges: Ranges) -> Iterator[pa.RecordBatch]:
    """A task's anchors by bucket; of equal ones the first stands for all, and the others pass through."""
    rows, lead = np.concatenate(parts), np.concatenate(leads)
    order = np.lexsort((rows["first"], rows["doc"], rows["key"]))
    rows, lead = rows[order], lead[order]
    place_again = np.zeros(len(rows), bool)
    place_again[1:] = (rows["doc"][1:] == rows["doc"][:-1]) & (rows["first"][1:] == rows["first"][:-1])
    rows, lead = rows[~place_again], lead[~place_again]  # repeated rows of one document
    head = np.append(True, rows["key"][1:] != rows["key"][:-1])
    lone = head & np.append(head[1:], True)
    rows["kind"] = np.where(lone, ONE, np.where(head, MORE, SURE))
    bucket = np.where(head, ranges.of(lead, rows["key"]), (tn.mix(rows["doc"].astype(np.uint64)) % np.uint64(ranges.buckets)).astype(np.int64))
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for a, b in zip(first.tolist(), np.append(first[1:], len(rows)).tolist(), strict=True):
        own = rows[a:b][np.argsort(rows["doc"][a:b], kind="stable")]
        yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a])], pa.int64()), *(pa.array([own[c].tobytes()], pa.binary()) for c, _ in ANCHOR)], names=["bucket", *(c for c, _ in ANCHOR)])


def _anchor_rows(ranges: Ranges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, leads, held = [], [], 0
        for batch in batches:
            for part in tn.slices(batch):
                found = anchors(*tn.raw(part.column("text")))
                rows = np.zeros(len(found["row"]), ANCHOR)
                rows["doc"] = part.column("doc").to_numpy()[found["row"]]
                for c in ("first", "count", "off", "key"):
                    rows[c] = found[c]
                parts.append(rows)
                leads.append(found["lead"])
                held += len(rows)
                if held >= FLUSH:
                    yield from _deal(parts, leads, ranges)
                    parts, leads, held = [], [], 0
        if held:
            yield from _deal(parts, leads, ranges)

    return run


def _with_equals(table: pa.Table) -> pa.Table:
    """Of a bucket's anchors, those with equals: (doc, blob of REQUEST)."""
    cols = {c: np.concatenate([np.frombuffer(b.as_buffer(), t) for b in table.column(c)]) for c, t in ANCHOR}
    sure = cols["kind"] == SURE
    _, inverse, times = np.unique(cols["key"][~sure], return_inverse=True, return_counts=True)
    keep = sure.copy()
    keep[~sure] = (times[inverse] > 1) | (cols["kind"][~sure] == MORE)
    keep = np.flatnonzero(keep)
    keep = keep[np.argsort(cols["doc"][keep], kind="stable")]
    out = np.zeros(len(keep), REQUEST)
    for c, _ in REQUEST:
        out[c] = cols[c][keep]
    return pa.Table.from_batches([_by_doc(cols["doc"][keep], out)])


CONTEXT = [("doc", "<i8"), ("first", "<i4"), ("count", "u1"), ("off", "u1")]


def _alike(text: np.ndarray, at: np.ndarray, size: np.ndarray, off: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Whether each string of text equals, byte for byte, the last one before it that head marks; those it marks do."""
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    out = (size == size[lead]) & (off == off[lead])
    own = np.flatnonzero(out & ~head)
    if len(own):
        s = size[own]
        begin = np.cumsum(s) - s
        step = np.arange(s.sum()) - np.repeat(begin, s)
        out[own] = np.logical_and.reduceat(text[np.repeat(at[own], s) + step] == text[np.repeat(at[lead[own]], s) + step], begin)
    return out


def _context_rows(ranges: Ranges):
    def flush(parts: list[tuple[np.ndarray, bytes, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows, text = np.concatenate([p[0] for p in parts]), np.frombuffer(b"".join(p[1] for p in parts), np.uint8)
        same, lead, key = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
        size = rows["count"].astype(np.int64) + WIDTH - 1
        at = np.cumsum(size) - size
        order = np.lexsort((rows["first"], rows["doc"], same))
        rows, at, size, same, lead, key = (x[order] for x in (rows, at, size, same, lead, key))
        again = np.append(False, (rows["doc"][1:] == rows["doc"][:-1]) & (rows["first"][1:] == rows["first"][:-1]))
        rows, at, size, same, lead, key = (x[~again] for x in (rows, at, size, same, lead, key))
        head = np.append(True, same[1:] != same[:-1])
        head |= ~_alike(text, at, size, rows["off"], head)
        over = rows[~head]
        if len(over):  # equal to an earlier text around an anchor: repeats already
            doc, a, b = united(over["doc"], over["first"].astype(np.int64), over["first"].astype(np.int64) + over["count"] + WIDTH - 1)
            for lo in range(0, len(doc), 20_000):
                hi = lo + 20_000
                blobs = [x[lo:hi].tobytes() for x in (doc, a.astype("<i4"), (b - a).astype("<i4"))]
                yield _context_batch(int(tn.mix(np.array([doc[lo]], np.uint64))[0] % np.uint64(ranges.buckets)), *blobs, b"", b"", SPANS)
        hot = head & ranges.is_hot(key)
        if hot.any():
            yield from windows(rows[hot], at[hot], text)
        head &= ~hot
        rows, at, size = rows[head], at[head], size[head]
        if not len(rows):
            return
        bucket = ranges.of(lead[head], key[head])
        order = np.argsort(bucket, kind="stable")
        first = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
        for a, b in zip(list(first), [*first[1:], len(order)], strict=True):
            own = order[a:b]
            s = size[own]
            take = np.arange(s.sum()) + np.repeat(at[own] - (np.cumsum(s) - s), s)
            yield _context_batch(int(bucket[own[0]]), *(np.ascontiguousarray(rows[c][own]).tobytes() for c, _ in CONTEXT), text[take].tobytes(), TEXTS)

    def windows(rows: np.ndarray, at: np.ndarray, text: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Every string of WIDTH bytes around frequent anchors, dealt by its own digest."""
        times = rows["count"].astype(np.int64)
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        place, whole = np.repeat(at, times) + step, memoryview(text)
        names = np.frombuffer(b"".join(hashlib.blake2b(whole[i : i + WIDTH], digest_size=16).digest() for i in place.tolist()), np.uint64).reshape(-1, 2)
        doc, start = np.repeat(rows["doc"], times), np.repeat(rows["first"], times) + step.astype("<i4")
        bucket = (names[:, 0] % np.uint64(ranges.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        first = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
        for a, b in zip(first.tolist(), np.append(first[1:], len(order)).tolist(), strict=True):
            own = order[a:b]
            yield _context_batch(int(bucket[own[0]]), doc[own].tobytes(), start[own].astype("<i4").tobytes(), b"", b"", names[own].tobytes(), DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in tn.slices(batch):
                data, offsets = tn.raw(part.column("text"))
                docs, hasher = part.column("doc").to_numpy(), tn.Hasher(data)
                for i, blobs in enumerate(part.column("blobs").to_pylist()):
                    want = np.frombuffer(b"".join(blobs), REQUEST)
                    rows = np.zeros(len(want), CONTEXT)
                    rows["doc"] = docs[i]
                    for c, _ in REQUEST:
                        rows[c] = want[c]
                    start = offsets[i] + want["first"].astype(np.int64)
                    size = want["count"].astype(np.int64) + WIDTH - 1
                    same = tn.mix(hasher.of(start, start + size) + want["off"].astype(np.uint64))
                    lead = np.zeros(len(want), np.uint64)
                    for j in range(8):
                        lead = lead << np.uint64(8) | data[start + want["off"] + j].astype(np.uint64)
                    take = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
                    anchor = start + want["off"]
                    parts.append((rows, data[take].tobytes(), same, lead, hasher.of(anchor, anchor + GRAM)))
                    held += len(rows)
                    if held >= FLUSH // 3:
                        yield from flush(parts)
                        parts, held = [], 0
        if held:
            yield from flush(parts)

    return run


#: What a row for a bucket holds: anchors with the text around them, spans that are repeats already, or digests of strings.
TEXTS, SPANS, DIGESTS = 0, 1, 2


def _context_batch(bucket: int, doc: bytes, first: bytes, count: bytes, off: bytes, text: bytes, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), *(pa.array([x], pa.binary()) for x in (doc, first, count, off, text)), pa.array([kind], pa.int32())], names=["bucket", "doc", "first", "count", "off", "text", "kind"])


def _repeated(table: pa.Table) -> pa.Table:
    """Repeated intervals of a bucket: (doc, blob of start and end)."""
    docs, starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cols: dict[str, list[np.ndarray]] = {c: [] for c in ("doc", "first", "count", "off", "text")}
    hot: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(table.num_rows):
        get = lambda c, t: np.frombuffer(table.column(c)[i].as_buffer(), t)  # noqa: B023,E731
        kind = table.column("kind")[i].as_py()
        if kind == SPANS:
            docs.append(get("doc", "<i8"))
            starts.append(get("first", "<i4").astype(np.int64))
            ends.append(starts[-1] + get("count", "<i4"))
        elif kind == DIGESTS:
            hot.append((get("doc", "<i8"), get("first", "<i4").astype(np.int64), get("text", np.uint64).reshape(-1, 2)))
        else:
            for c, t in (*CONTEXT, ("text", "u1")):
                cols[c].append(get(c, t))
    if hot:
        doc, start, name = (np.concatenate(x) for x in zip(*hot, strict=True))
        order = np.lexsort((start, doc, name[:, 1], name[:, 0]))
        late = order[1:][(name[order[1:]] == name[order[:-1]]).all(1)]
        docs.append(doc[late])
        starts.append(start[late])
        ends.append(start[late] + WIDTH)
    if cols["doc"]:
        doc, first, count, off = (np.concatenate(cols[c]).astype(np.int64) for c, _ in CONTEXT)
        text = np.concatenate(cols["text"])
        size = count + WIDTH - 1
        at = np.cumsum(size) - size
        same = tn.mix(tn.Hasher(text).of(at, at + size) + off.astype(np.uint64))
        order = np.lexsort((first, doc, same))
        new = np.append(True, same[order][1:] != same[order][:-1])
        new |= ~_alike(text, at[order], size[order], off[order], new)
        over, order = order[~new], order[new]
        docs.append(doc[over])
        starts.append(first[over])
        ends.append(first[over] + size[over])
        order = order[np.lexsort((first[order], doc[order]))]
        s = size[order]
        take = np.arange(s.sum()) + np.repeat(at[order] - (np.cumsum(s) - s), s)
        d, f = repeats(doc[order], first[order], count[order], off[order], text[take], np.append(0, np.cumsum(s)))
        docs.append(d)
        starts.append(f)
        ends.append(f + WIDTH)
    doc, a, b = united(np.concatenate(docs), np.concatenate(starts), np.concatenate(ends))
    return pa.Table.from_batches([_by_doc(doc, np.stack([a, b], 1).astype("<i4"))])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tn.slices(batch):
            data, offsets = tn.raw(part.column("text"))
            roles, blobs = part.column("role").to_pylist(), part.column("blobs").to_pylist()
            removed, spans, digests = [], [], []
            for i, (role, held) in enumerate(zip(roles, blobs, strict=True)):
                own = data[offsets[i] : offsets[i + 1]]
                found = np.zeros((0, 2), np.int64)
                if role == "copy" and len(own) >= WIDTH:
                    found = np.array([[0, len(own)]])
                elif role == "judged" and held:
                    pairs = np.frombuffer(b"".join(held), "<i4").reshape(-1, 2).astype(np.int64)
                    found = np.stack(united(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])[1:], 1)
                keep, at = [], 0
                for a, b in found.tolist():
                    keep.append(own[at:a])
                    at = b
                digests.append(hashlib.sha256(b"".join([*(x.tobytes() for x in keep), own[at:].tobytes()])).hexdigest())
                removed.append(int((found[:, 1] - found[:, 0]).sum()))
                spans.append(len(found))
            out = [part.column("doc"), part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["doc", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _ranges(slim: DataFrame) -> Ranges:
    """Ranges between the leading tokens that part the anchors of a sample (about SAMPLE_ROWS rows, by a hash) evenly."""
    rows, size = slim.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(4, -(-size // BUCKET_BYTES))
    n = min(buckets, MOST_RANGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch):
                found = anchors(*tn.raw(part.column("text")))
                yield pa.RecordBatch.from_arrays([pa.array((found["lead"] ^ np.uint64(1 << 63)).view(np.int64)), pa.array(found["key"].view(np.int64))], names=["lead", "key"])

    share = min(1.0, max(SAMPLE_ROWS, rows // 5000) / max(1, rows))
    some = settle(slim.where(F.pmod(F.xxhash64("doc"), F.lit(1 << 30)) < int(share * (1 << 30))).mapInArrow(run, "lead long, key long"), "sample")
    found = some.agg(F.percentile_approx("lead", [i / n for i in range(1, n)], max(1000, 4 * n))).first()[0]
    often = some.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(HOT_SEEN, HOT_ROWS * share)).orderBy(F.desc("n"), "key").limit(MOST_HOT).select("key")
    hot = np.sort(often.toArrow().column("key").to_numpy().view(np.uint64))
    return Ranges(np.sort(np.array(found or [], np.int64).view(np.uint64) ^ np.uint64(1 << 63)), -(-buckets // n), hot)


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of docs (doc_id, text)."""
    prepare(docs.sparkSession)
    rows = numbered(docs).select("doc", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    again = repeated(rows)
    slim = one_each(rows, again)  # rows that agree in id and text are one document: one text of them moves
    ranges = _ranges(slim)
    named = slim.select("doc", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    firsts = named.groupBy("h1", "h2").agg(F.min("doc").alias("doc")).groupBy("doc").agg(F.min("h1").alias("first_h1"))
    role = F.when(F.col("first_h1").isNull(), "copy").when(F.col("first_h1") == F.xxhash64("text"), "judged").otherwise("left")
    held = slim.repartition("doc").join(firsts, "doc", "left").select("doc", "doc_id", "text", role.alias("role"))
    judged = held.where("role = 'judged'").select("doc", "doc_id", "text")  # the columns of held, so both read one exchange

    dealt = judged.mapInArrow(_anchor_rows(ranges), "bucket long, " + ", ".join(f"{c} binary" for c, _ in ANCHOR))
    wanted = dealt.groupBy("bucket").applyInArrow(_with_equals, "doc long, blob binary").groupBy("doc").agg(F.collect_list("blob").alias("blobs"))
    around = judged.join(wanted, "doc").mapInArrow(_context_rows(ranges), "bucket long, doc binary, first binary, count binary, off binary, text binary, kind int")
    found = around.groupBy("bucket").applyInArrow(_repeated, "doc long, blob binary").groupBy("doc").agg(F.collect_list("blob").alias("blobs"))
    cut = held.join(found, "doc", "left").select("doc", "doc_id", "text", "role", "blobs")
    return every_row(cut.mapInArrow(_cut, "doc long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), again).drop("doc")
