"""Token ids as binary files.

Ids are renumbered by how often the corpus uses them, so that most become small, and written in a byte-aligned
variable-length code: two bits an id in control bytes that stand apart tell whether it takes one to four data
bytes. Readers look control bytes up in a table of 256 rows and gather data bytes with numpy.

A shard file holds documents in ascending doc_id order, and shards are in that order too:

    magic "VXT1", uint32 number of documents, uint64 number of ids, uint64 number of control bytes
    int64 doc_id of each document (the lowest int64 for null), uint32 ids of each document
    control bytes, data bytes (all little-endian)

`ranks.bin` beside the shards holds the token id of each rank as uint32. A shard is written under another name
and then moved, so a task that runs twice leaves one file.

Documents are dealt to shards by ranges of doc_id and a hash of their ids, so rows that share a doc_id or have none fill
as many shards as they need. Shards are about 16 MB, more only for corpora of over 1 TB, so that there are at most some
65,536 of them: what the driver holds of each is one row.

Defined cases: null text is empty and encodes to the end id alone; null doc_id sorts first; documents with equal doc_id
are ordered by a hash of their ids and then by their bytes; an empty table gives ranks and no shard; other columns are
ignored; a tokenizer that is no byte-level BPE is an error, as texts could not be cut where they are.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm.store import prepare

MAGIC = b"VXT1"
HEAD = "<4sIQQ"
NULL_ID = -(2**63)
#: Word pieces that a Python worker remembers, and new ones that the library gets in one string.
MEMORY, JOINED = 600_000, 500
SHARD_BYTES, MOST_SHARDS = 16 << 20, 1 << 16

#: Lengths of the four ids that a control byte tells of.
LENGTHS = np.array([[(c >> (2 * j) & 3) + 1 for j in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = size - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    keep = np.arange(4, dtype=np.uint8) < size[:, None]
    return control, values.astype("<u4").view(np.uint8).reshape(-1, 4)[keep]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values that pack() was given."""
    size = LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    out = data[at].astype(np.uint32)
    for j in range(1, 4):
        more = np.flatnonzero(size > j)
        if not len(more):
            break
        out[more] |= data[at[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return out


def _solid(data: np.ndarray) -> np.ndarray:
    """Ends of characters that are no white space: ASCII ones, and letters or signs in two bytes that begin with C3."""
    solid = (data < 0x80) & (data > 0x20) & (data != 0x7F)
    solid[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80)
    return solid


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places, row starts included, where a text may be cut without changing its byte-level BPE ids.

    The pre-tokenizer never joins a character that is no white space to white space after it. So a text may be
    cut before ASCII white space that follows such a character: another ASCII one, or one in two bytes that
    begins with C3.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        cut[1:n] = tn.IS_SPACE[data[1:]] & _solid(data)[:-1]
    cut[offsets[:-1]] = True
    cut[n] = False
    return np.flatnonzero(cut)


def highest_id(path: str) -> int:
    """The highest id of a tokenizer file; an error unless it is a byte-level BPE that changes no text before it parts it,
    as pieces() assumes. The file is read as JSON, as the library's tokenizer would stay in the driver's memory."""
    with open(path, encoding="utf-8") as f:
        kind = json.load(f)
    before = kind.get("pre_tokenizer") or {}
    if kind["model"].get("type") != "BPE" or kind.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
    return max([*kind["model"]["vocab"].values(), *(t["id"] for t in kind.get("added_tokens") or [])])


class Encoder:
    """Ids of whole texts by the tokenizers library, each different piece of a text encoded once and remembered.

    New pieces that begin with white space and end in a character that is none are handed to the library in strings of
    JOINED pieces, as texts may be cut between any two of them; the bytes of the ids tell where each piece ends. When
    the memory is full, pieces that were met again since it was last full are kept, up to half of it.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.memory = Tokenizer.from_file(path), memory
        names = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(names.values()) + 1, np.int64)  # a character of a name is a byte of text
        for name, i in names.items():
            self.lengths[i] = len(name)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.lengths[i] = len(token.content.encode())
        self.keys, self.places, self.sizes, self.ids, self.again = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32), np.zeros(0, bool)

    def _forget(self) -> None:
        kept = np.flatnonzero(self.again)
        kept = kept if 2 * len(kept) <= self.memory else kept[:0]
        sizes = self.sizes[kept].astype(np.int64)
        self.ids = self.ids[tn.ranges(self.places[kept], sizes)]
        self.keys, self.places, self.sizes, self.again = self.keys[kept], np.cumsum(sizes) - sizes, self.sizes[kept], np.zeros(len(kept), bool)

    def _new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces by the library: the place of each piece's first id, the number of its ids, all ids."""
        joins = tn.IS_SPACE[data[starts]] & _solid(data)[ends - 1]
        size = (ends - starts)[joins]
        upto = np.cumsum(size)
        text = data[tn.ranges(starts[joins], size)].tobytes()
        bounds = [0, *upto[JOINED - 1 : -1 : JOINED].tolist(), len(text)] if len(text) else [0]
        alone = [data[s:e].tobytes().decode() for s, e in zip(starts[~joins].tolist(), ends[~joins].tolist(), strict=True)]
        found = self.tokenizer.encode_batch_fast([*(text[s:e].decode() for s, e in zip(bounds, bounds[1:], strict=False)), *alone], add_special_tokens=False)
        parts = [np.array(e.ids, np.uint32) for e in found]
        ids = np.concatenate(parts)
        sizes = np.zeros(len(starts), np.int64)
        told = np.cumsum(self.lengths[np.concatenate([ids[:0], *parts[: len(bounds) - 1]])])
        last = np.searchsorted(told, upto)
        if len(text) and not (len(told) and told[-1] == len(text) and (told[last] == upto).all()):
            raise ValueError("ids do not tell the bytes of their text: not a byte-level BPE of all bytes")
        sizes[joins] = np.diff(last + 1, prepend=0)
        sizes[~joins] = [len(p) for p in parts[len(bounds) - 1 :]]
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        places = np.zeros(len(starts), np.int64)
        places[order] = np.cumsum(sizes[order]) - sizes[order]
        return places, sizes, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the n + 1 offsets of the rows into them."""
        data, offsets = tn.raw(texts)
        n = len(offsets) - 1
        starts = pieces(data, offsets)
        starts = starts[starts < len(data)]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        ends = np.append(starts[1:], len(data))
        rows = np.searchsorted(offsets, starts, side="right") - 1
        unique, first, inverse = np.unique(tn.Hasher(data).of(starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > self.memory and len(self.keys):
            self._forget()
        known = np.zeros(len(unique), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, unique), len(self.keys) - 1)
            known = self.keys[at] == unique
            self.again[at[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            places, sizes, ids = self._new(data, starts[first[new]], ends[first[new]])
            spot = np.searchsorted(self.keys, unique[new])
            self.keys, self.places = np.insert(self.keys, spot, unique[new]), np.insert(self.places, spot, places + len(self.ids))
            self.sizes, self.again = np.insert(self.sizes, spot, sizes), np.insert(self.again, spot, False)
            self.ids = np.concatenate([self.ids, ids])
        at = np.searchsorted(self.keys, unique)[inverse]
        sizes = self.sizes[at].astype(np.int64)
        return self.ids[tn.ranges(self.places[at], sizes)], np.concatenate([[0], np.cumsum(np.bincount(rows, weights=sizes, minlength=n).astype(np.int64))])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept for its later tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, ids) with ids as little-endian uint32 or, where the vocabulary allows, uint16 bytes."""
    width = "<u2" if max(end_id, highest_id(tokenizer)) < 1 << 16 else "<u4"
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for part in tn.slices(batch):
                ids, at = own.encode(part.column("text"))
                rows = np.arange(1, len(at))
                whole = np.insert(ids, at[1:], end_id)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), tn.binary(whole.astype(width), at + np.concatenate([[0], rows]))], names=["doc_id", "ids"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, ids binary").withColumn("wide", F.lit(width == "<u4"))


def _ids(column: pa.Array, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tn.raw(column)
    return data.view("<u4" if wide else "<u2"), offsets // (4 if wide else 2)


def frequencies(ids: DataFrame) -> dict[int, int]:
    """How often each id occurs; at most one entry for each id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                seen = np.bincount(_ids(batch.column("ids"), batch.column("wide")[0].as_py())[0])
                total = seen + np.pad(total, (0, len(seen) - len(total))) if len(seen) > len(total) else total + np.pad(seen, (0, len(total) - len(seen)))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int64)), pa.array(total[there].astype(np.int64))], names=["id", "n"])

    return {r.id: r.n for r in ids.select("ids", "wide").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def write_file(uri: str, content: bytes) -> None:
    fs, path = _files(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    spare = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(spare) as out:
        out.write(content)
    fs.move(spare, path)


def write(docs: DataFrame, uri: str, tokenizer: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode docs (doc_id, text) and write them under uri; returns (shard, path, docs, ids) for each shard, in order.

    Texts are encoded once: their ids lie in a table beside the shards while frequencies are counted.
    """
    spark = docs.sparkSession
    encoded(docs, tokenizer, end_id).write.mode("overwrite").option("compression", "zstd").parquet(f"{uri}/ids")
    raw = spark.read.parquet(f"{uri}/ids")
    seen = frequencies(raw)
    by_rank = np.array(sorted(seen, key=lambda i: (-seen[i], i)), np.uint32)
    write_file(f"{uri}/ranks.bin", by_rank.astype("<u4").tobytes())
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    sent = spark.sparkContext.broadcast(rank_of)
    size = 2 * sum(seen.values())
    shards = max(1, -(-size // max(shard_bytes, size // MOST_SHARDS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        names, sizes, controls, datas = [], [], [], []
        carry = np.zeros(0, np.uint32)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, at = _ids(batch.column("ids"), batch.column("wide")[0].as_py())
            names.append(batch.column("doc_id").fill_null(NULL_ID).to_numpy())
            sizes.append(np.diff(at))
            values = np.concatenate([carry, sent.value[ids]])
            whole = len(values) // 4 * 4
            control, data = pack(values[:whole])
            carry = values[whole:]
            controls.append(control)
            datas.append(data)
        if not names:
            return
        control, data = pack(carry)
        control, data = np.concatenate([*controls, control]), np.concatenate([*datas, data])
        name, size = np.concatenate(names).astype("<i8"), np.concatenate(sizes)
        path = f"{uri}/shard-{shard:06d}.vxt"
        write_file(path, struct.pack(HEAD, MAGIC, len(name), int(size.sum()), len(control)) + name.tobytes() + size.astype("<u4").tobytes() + control.tobytes() + data.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([path]), pa.array([len(name)], pa.int64()), pa.array([int(size.sum())], pa.int64())], names=["shard", "path", "docs", "ids"])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("ids")]
    written = raw.repartitionByRange(int(shards), *order[:2]).sortWithinPartitions(*order).mapInArrow(run, "shard int, path string, docs long, ids long")
    rows = sorted((r.shard, r.path, r.docs, r.ids) for r in written.collect())  # one row a shard
    return spark.createDataFrame(rows, "shard int, path string, docs long, ids long")


def read_shard(uri: str, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id and number of ids of each document of a shard, and all its ids."""
    fs, path = _files(uri)
    with fs.open_input_stream(path) as f:
        content = f.read()
    magic, docs, ids, controls = struct.unpack_from(HEAD, content)
    if magic != MAGIC:
        raise ValueError(f"not a token file: {uri}")
    at = struct.calcsize(HEAD)
    names = np.frombuffer(content, "<i8", docs, at)
    sizes = np.frombuffer(content, "<u4", docs, at + 8 * docs)
    at += 12 * docs
    control = np.frombuffer(content, np.uint8, controls, at)
    return names, sizes, ranks[unpack(control, np.frombuffer(content, np.uint8, offset=at + controls), ids)]


def read(shards: DataFrame, uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shard files."""
    listed = shards.orderBy("shard").collect()  # one row a shard of some 16 MB
    first, rows = 0, []
    for s in listed:
        rows.append((s.path, first))
        first += s.ids
    spark = shards.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _files(f"{uri}/ranks.bin")
        with fs.open_input_stream(path) as f:
            ranks = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for shard, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                names, sizes, ids = read_shard(shard, ranks)
                at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                content = memoryview(ids.astype("<u4").tobytes())
                crc = np.fromiter((zlib.crc32(content[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)), np.int64, len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names, mask=names == NULL_ID), pa.array(before + at[:-1]), pa.array(sizes.astype(np.int64)), pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    paths = spark.createDataFrame(rows, "path string, before long").repartition(max(1, len(rows)))
    return paths.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
