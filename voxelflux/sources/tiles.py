"""A Spark sink for snapshots that is sure of what it has written: every tile is read back and compared before the commit.

    spark.dataSource.register(Tiles)
    dealt(points, 128).write.format("tiles").mode("append").option("path", uri).option("digests", uri2).option("block", 128).save()

Tiles arrive whole and in the order of a Morton curve. A task writes a Parquet file for each stretch of the curve, with one
row group a tile, so statistics prune files and row groups on all three axes alike: a plane of any axis reads about n**(2/3)
of n tiles. Each tile is hashed as it is sent (float32, little-endian, field by field, in z, y, x order); when a file is full it
is read back, tile by tile, and compared in all its columns, and the digests of its tiles are written. A file has at most MOST
tiles, so a task holds what its present file says of them, however many tiles it has. Files stand under hidden names until the
commit, which runs only if all tasks agree; an abort removes them. What was verified stands in the table of digests: time_index,
tile_key, n_points, byte_count, sha256, file.

Tiles of a task ascend on the curve, and tasks share no stretch: a task tells the driver the numbers of its deals, DEALS over all
tasks, and the commit compares those.

Defined cases: a tile in two places of the input, with points missing or twice, or with values that are not finite or null
is an error, and so is an input that dealt() has not dealt; an empty input writes nothing; a task that runs twice leaves the
files of one run.
"""

from __future__ import annotations

import hashlib
import importlib
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

PLACE = ["time_index", "z", "y", "x"]
#: Points of a file at least, if its task has more: small snapshots share files.
LEAST = 1 << 20
#: Tiles of a file at most: a Parquet footer holds some 14 kB in memory for each tile of three fields.
MOST = 2048
#: Stretches are dealt to tasks by so many numbers.
DEALS = 1 << 16
DIGEST = pa.schema([("time_index", pa.int32()), ("tile_key", pa.string()), ("n_points", pa.int64()), ("byte_count", pa.int64()), ("sha256", pa.string()), ("file", pa.string())])


def morton(z: Column, y: Column, x: Column, bits: int) -> Column:
    """The place on a Morton curve: bits of z, y and x in turn."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for k, c in enumerate((x, y, z)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")), 3 * bit + k))
    return out


def deal(time_index, stretch):
    """The number by which a stretch is dealt, of columns or arrays alike."""
    return (time_index * 64 + stretch) % DEALS


def dealt(points: DataFrame, block: int, n: int, files: int = 64) -> DataFrame:
    """points in the order that the sink asks for: one exchange by stretches of the curve, at most `files` of a snapshot.

    n is the length of an axis. Stretches are known beforehand, so nothing is sampled and a source is read once.
    """
    bits = max(1, (-(-n // block) - 1).bit_length())
    code = morton(*(F.floor(F.col(a) / block) for a in "zyx"), bits)
    stretch = F.floor(code * files / (1 << 3 * bits)).cast("int")
    rows = points.withColumn("curve", code).withColumn("stretch", stretch)
    return rows.repartition(F.pmod(deal(F.col("time_index").cast("long"), F.col("stretch")), F.lit(DEALS))).sortWithinPartitions("time_index", "stretch", "curve", "z", "y", "x")


def files_of(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def digest(table: pa.Table, fields: list[str]) -> str:
    h = hashlib.sha256()
    for c in fields:
        h.update(np.ascontiguousarray(table.column(c).to_numpy().astype("<f4")).data)
    return h.hexdigest()


def everything(table: pa.Table) -> str:
    """A digest of all columns as they are, places and doubles too."""
    h = hashlib.sha256()
    for c in table.column_names:
        h.update(np.ascontiguousarray(table.column(c).to_numpy()).data)
    return h.hexdigest()


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # hidden and final names
    deals: list[int]


class TileWriter(DataSourceArrowWriter):
    def __init__(self, schema, options: dict):
        self.path, self.digests = options["path"].rstrip("/"), options["digests"].rstrip("/")
        self.block, self.codec = int(options["block"]), options.get("codec", "zstd")
        self.least = int(options.get("least", LEAST))
        self.probe = options.get("probe")  # module:function, called with a file's path before it is read back
        self.fields = [f.name for f in schema.fields if f.name not in (*PLACE, "curve", "stretch")]

    def _tiles(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Table]]:
        """(time_index, stretch) and one tile after another, whole."""
        held: list[pa.Table] = []

        def parts(table: pa.Table) -> list[int]:
            own = [table.column(c).to_numpy() for c in ("time_index", "stretch", "curve")]
            return np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in own], axis=0))).tolist()

        def last() -> tuple[tuple[int, int], pa.Table]:
            table = pa.concat_tables(held).combine_chunks()
            return (table.column("time_index")[0].as_py(), table.column("stretch")[0].as_py()), table

        key = lambda t: tuple(t.column(c)[0].as_py() for c in ("time_index", "stretch", "curve"))
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            starts = parts(table)
            for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
                part = table.slice(a, b - a)
                if held and key(held[0]) != key(part):
                    yield last()
                    held = []
                held.append(part)
        if held:
            yield last()

    def _checked(self, tile: pa.Table) -> tuple[str, int]:
        """Key and number of points of a tile whose places are those of a box, at its place on the curve, and whose values are finite."""
        place = np.stack([tile.column(c).to_numpy() for c in ("z", "y", "x")]).astype(np.int64)
        low = place[:, 0] // self.block * self.block
        key = "x{2:04d}_y{1:04d}_z{0:04d}".format(*low)
        high = place[:, -1] + 1
        size = high - place[:, 0]
        box = np.stack(np.unravel_index(np.arange(tile.num_rows), size)) if size.min() > 0 and size.prod() == tile.num_rows else None
        if box is None or (place[:, 0] != low).any() or (place != box + low[:, None]).any():
            raise ValueError(f"tile {key} lacks points or holds some twice")
        for c in self.fields:
            values = tile.column(c)
            if values.null_count or not np.isfinite(values.to_numpy()).all():
                raise ValueError(f"tile {key} holds values of {c} that are not finite")
        if tile.column("curve")[0].as_py() != sum((int(a) // self.block >> bit & 1) << 3 * bit + k for k, a in enumerate(low[::-1]) for bit in range(21)):
            raise ValueError(f"tile {key} is not at its place on the curve")
        return key, tile.num_rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = files_of(self.path)
        own, under = files_of(self.digests)
        token = uuid.uuid4().hex
        sent: list[tuple] = []  # tiles of the file that is being written
        files: list[tuple[str, str]] = []
        table = (f"{under}/.part-{token}.parquet", f"{under}/part-{token}.parquet")
        deals: set[int] = set()
        writer, stream, told, out, last, held = None, None, None, None, None, 0

        def full() -> None:
            """The file is closed and verified, and its digests are written."""
            nonlocal told, out
            writer.close()
            stream.close()
            self._verify(fs, files[-1][0], sent)
            if told is None:
                own.create_dir(under, recursive=True)
                out = own.open_output_stream(table[0])
                told = pq.ParquetWriter(out, DIGEST)
            told.write_table(pa.table({f.name: pa.array(c, f.type) for f, c in zip(DIGEST, zip(*(r[:-1] for r in sent), strict=True), strict=True)}, DIGEST))

        try:
            for stretch, tile in self._tiles(iterator):
                key, n = self._checked(tile)
                place = (*stretch, tile.column("curve")[0].as_py())
                if last is not None and place <= last:
                    raise ValueError(f"tile {key} lies in two places of the input, or the input is not dealt()")
                slim = tile.select([*PLACE, *self.fields])
                if writer is None or (stretch != last[:2] and held >= self.least) or len(sent) == MOST:
                    if writer:
                        full()
                    name = f"t{stretch[0]:06d}-{stretch[1]:05d}-{token}-{len(files)}.parquet"
                    files.append((f"{root}/.{name}", f"{root}/{name}"))
                    fs.create_dir(root, recursive=True)
                    stream = fs.open_output_stream(files[-1][0])
                    writer, held, sent = pq.ParquetWriter(stream, slim.schema, compression=self.codec), 0, []
                writer.write_table(slim, row_group_size=max(1, n))
                last, held = place, held + n
                deals.add(deal(*stretch))
                sent.append((stretch[0], key, n, n * 4 * len(self.fields), digest(slim, self.fields), files[-1][1], everything(slim)))
            if writer:
                full()
                told.close()
                out.close()
                files.append(table)
        except BaseException:
            for at, hidden in [*((fs, hidden) for hidden, _ in files), (own, table[0])]:
                if at.get_file_info(hidden).type != pafs.FileType.NotFound:
                    at.delete_file(hidden)
            raise
        return Written(files, sorted(deals))

    def _verify(self, fs: pafs.FileSystem, hidden: str, sent: list[tuple]) -> None:
        if self.probe:
            module, name = self.probe.split(":")
            getattr(importlib.import_module(module), name)(hidden)
        with fs.open_input_file(hidden) as content:
            back = pq.ParquetFile(content)
            if back.num_row_groups != len(sent):
                raise OSError(f"{hidden} holds {back.num_row_groups} tiles, {len(sent)} were sent")
            for i, (_, key, *_, whole) in enumerate(sent):
                if everything(back.read_row_group(i)) != whole:
                    raise OSError(f"tile {key} in {hidden} differs from what was sent")

    def commit(self, messages: list[Written | None]) -> None:
        """All tasks agree: files get their names, those of digests last, so digests never tell of a file that is not there."""
        found = [m for m in messages if m]
        deals = [d for m in found for d in m.deals]
        if len(deals) != len(set(deals)):
            self.abort(messages)
            raise ValueError("a tile lies in two places of the input, or the input is not dealt()")
        fs, _ = files_of(self.path)
        for hidden, final in sorted((f for m in found for f in m.files), key=lambda f: "/part-" in f[1]):
            fs.move(hidden, final)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = files_of(self.path)
        for hidden, final in (f for m in messages if m for f in m.files):
            for name in (hidden, final):
                if fs.get_file_info(name).type != pafs.FileType.NotFound:
                    fs.delete_file(name)


class Tiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tiles"

    def schema(self) -> str:
        return "time_index int, z int, y int, x int"

    def writer(self, schema, overwrite: bool) -> TileWriter:
        if overwrite:
            raise ValueError("tiles are appended; write to a folder of their own to replace them")
        return TileWriter(schema, dict(self.options))


def write(points: DataFrame, path: str, digests: str, block: int, n: int, *, files: int = 64, least: int = LEAST, codec: str = "zstd", probe: str = "") -> DataFrame:
    """Write and verify points; returns the digests of what now stands under path."""
    spark = points.sparkSession
    spark.dataSource.register(Tiles)
    out = dealt(points, block, n, files).write.format("tiles").mode("append").option("path", path).option("digests", digests).option("block", block).option("least", least).option("codec", codec)
    (out.option("probe", probe) if probe else out).save()
    return verified(spark, digests)


def verified(spark, digests: str) -> DataFrame:
    """The table of digests; empty if nothing was written."""
    fs, path = files_of(digests)
    there = [f for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.base_name.endswith(".parquet") and not f.base_name.startswith(".")]
    schema = "time_index int, tile_key string, n_points long, byte_count long, sha256 string, file string"
    return spark.read.schema(schema).parquet(digests) if there else spark.createDataFrame([], schema)


def layout(path: str, axis: str, index: int) -> dict[str, int]:
    """How many files and row groups there are under path, and how many may hold the plane axis = index by their statistics."""
    fs, root = files_of(path)
    out = {"files": 0, "row_groups": 0, "files_read": 0, "row_groups_read": 0}
    for info in fs.get_file_info(pafs.FileSelector(root)):
        if info.base_name.startswith(".") or not info.base_name.endswith(".parquet"):
            continue
        with fs.open_input_file(info.path) as content:
            meta = pq.ParquetFile(content).metadata
        column = next(i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == axis)
        hit = sum(s.min <= index <= s.max for s in (meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)))
        out["files"], out["row_groups"] = out["files"] + 1, out["row_groups"] + meta.num_row_groups
        out["files_read"], out["row_groups_read"] = out["files_read"] + (hit > 0), out["row_groups_read"] + hit
    return out
