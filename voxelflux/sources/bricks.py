"""Snapshots as Parquet bricks: partitioned by snapshot and z-brick, so planes and boxes prune files."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.functions.fields import finite, tile_key
from voxelflux.session import shared_dir
from voxelflux.sources import tiles

COMPONENTS = ["ux", "uy", "uz"]


def write(points: DataFrame, path: str, brick: int = 128, codec: str = "zstd", folders: tuple[str, ...] = ("time_index", "zb")) -> None:
    """Points are dealt by brick and sorted so inside files, and row-group statistics prune on y and x as directories do on z.

    Very many small snapshots are better off without a folder each: folders=("zb",) leaves them to statistics too.
    """
    yb, xb = (F.floor(F.col(a) / brick) for a in "yx")
    placed = points.withColumn("zb", F.floor(F.col("z") / brick).cast("int"))
    (
        placed.repartition("time_index", "zb", yb, xb).sortWithinPartitions(*folders, *(c for c in ("time_index", "zb") if c not in folders), yb, xb, "z", "y", "x")
        .write.mode("overwrite").option("compression", codec).partitionBy(*folders).parquet(path)
    )


def read(spark: SparkSession, path: str, brick: int = 128, z: tuple[int, int] | None = None) -> DataFrame:
    """All points, or those with z in a half-open range; then other bricks are not read."""
    points = spark.read.parquet(path)
    if z is not None:
        if "zb" in points.columns:
            points = points.where(F.col("zb").between(z[0] // brick, (z[1] - 1) // brick))
        points = points.where((F.col("z") >= z[0]) & (F.col("z") < z[1]))
    kept = ["time_index", *(c for c in points.columns if c not in ("time_index", "zb"))]
    return points.select(*kept)


def write_verified(points: DataFrame, path: str, block: int, n: int, **more) -> DataFrame:
    """Write points through the sink of sources.tiles: (time_index, tile_key, n_points, n_finite, sha256) of what stands under
    path/tiles, or an error if a tile differs from what was sent, is not whole or holds values that are not finite. More options
    are those of tiles.write()."""
    found = tiles.write(points, f"{path}/tiles", f"{path}/digests", block, n, **more)
    return found.select("time_index", "tile_key", "n_points", F.col("n_points").alias("n_finite"), "sha256")


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written once in the folder that driver and executors share, and read back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FACTS = "time_index int, tile_key string, n_points long, n_finite long, byte_count long, sha256 string, minimum double, maximum double, total double, squares double, axis string, plane int, at0 int, at1 int, face binary"


def tile_facts(points: DataFrame, block: int, n: int, fields: list[str] = COMPONENTS) -> DataFrame:
    """All that validation asks of a frame of n * n * n points, from one scan and one exchange, written once.

    A row with axis null is a tile: digest, numbers of points and of finite ones, extrema and sums over all fields. Each other
    row is a face of a tile in plane 0, 1 or n - 1 of an axis, from which seams() works out steps; about 9 / n of the frame.
    """
    tiled = points.withColumn("tile_key", tile_key(*(F.floor(F.col(a) / block) * block for a in "xyz")))
    good = F.lit(True)
    for c in fields:
        good &= finite(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            yield from _facts(table, fields, block, n)

    slim = tiled.select("time_index", "tile_key", "z", "y", "x", *fields, good.cast("int").alias("good"))
    dealt = slim.repartition("time_index", "tile_key").sortWithinPartitions("time_index", "tile_key", "z", "y", "x")
    return kept(dealt.mapInArrow(run, FACTS), "tile-facts")


def _facts(table: pa.Table, fields: list[str], block: int, n: int) -> Iterator[pa.RecordBatch]:
    starts = tile_starts(table)
    known = tile_digests(table, starts, fields)
    values = np.stack([table.column(c).to_numpy().astype(float) for c in fields])
    corner = np.stack([table.column(c).to_numpy() for c in ("z", "y", "x")])
    rows, schema = [], pa.schema([("minimum", pa.float64()), ("maximum", pa.float64()), ("total", pa.float64()), ("squares", pa.float64()), ("axis", pa.string()), ("plane", pa.int32()), ("at0", pa.int32()), ("at1", pa.int32()), ("face", pa.binary())])
    ends = np.append(starts[1:], table.num_rows)
    faces = []
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        own = values[:, a:b]
        rows.append((own.min(), own.max(), own.sum(), (own * own).sum(), None, None, None, None, None))
        size = corner[:, b - 1] + 1 - corner[:, a]
        if size.min() < 1 or size.prod() != b - a:
            continue  # not whole, which is an error of its own
        cube = own.reshape(len(fields), *size)
        for k, axis in enumerate("zyx"):
            others = [corner[j, a] for j in range(3) if j != k]
            for plane in sorted({0, 1, n - 1}):
                at = plane - corner[k, a]
                if 0 <= at < size[k]:
                    face = np.ascontiguousarray(np.take(cube, at, axis=k + 1))
                    faces.append((i, (None, None, None, None, axis, plane, int(others[0]), int(others[1]), face.tobytes())))
    listed = [*((i, r) for i, r in enumerate(rows)), *faces]
    more = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for _, r in listed], schema).combine_chunks().to_batches()[0]
    told = known.take(pa.array([i for i, _ in listed]))
    yield pa.RecordBatch.from_arrays([*told.columns, *more.columns], names=[*told.schema.names, *schema.names])


def statistics(facts: DataFrame) -> DataFrame:
    """reports.snapshot_statistics() from tile_facts()."""
    tile = facts.where("axis is null")
    n = F.sum("n_points") * F.lit(len(COMPONENTS))
    return tile.groupBy("time_index").agg(
        F.count(F.lit(1)).alias("tiles"), n.alias("n"), F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"),
        (F.sum("total") / n).alias("mean"), F.sqrt(F.sum("squares") / n).alias("rms"), (F.sum("n_finite") == F.sum("n_points")).alias("all_finite"),
    )


def seams(facts: DataFrame, n: int, fields: int = 3) -> DataFrame:
    """grid.seams() from tile_facts(): faces of opposite tiles meet by their place in the plane."""
    at = lambda i, name: F.max(F.when(F.col("plane") == i, F.col("face"))).alias(name)
    lines = facts.where("axis is not null").groupBy("time_index", "axis", "at0", "at1").agg(at(0, "first"), at(1, "second"), at(n - 1, "last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrap, internal, count = [], [], []
            for first, second, last in zip(*(batch.column(c).to_pylist() for c in ("first", "second", "last")), strict=True):
                f, s, z = (np.frombuffer(x, float) for x in (first, second, last))
                wrap.append(float(((f - z) ** 2).sum()))
                internal.append(float(((s - f) ** 2).sum()))
                count.append(len(f))
            yield pa.RecordBatch.from_arrays([batch.column("time_index"), batch.column("axis"), pa.array(wrap, pa.float64()), pa.array(internal, pa.float64()), pa.array(count, pa.int64())], names=["time_index", "axis", "w", "i", "n"])

    sums = lines.mapInArrow(run, "time_index int, axis string, w double, i double, n long").groupBy("time_index", "axis")
    out = sums.agg(F.sqrt(F.sum("w") / F.sum("n")).alias("wrap_rms"), F.sqrt(F.sum("i") / F.sum("n")).alias("internal_rms"))
    return out.withColumn("ratio", F.col("wrap_rms") / F.greatest("internal_rms", F.lit(1e-30)))


def checksums(points: DataFrame, block: int, fields: list[str] = COMPONENTS) -> DataFrame:
    """(time_index, tile_key, n_points, n_finite, byte_count, sha256) of each block**3 tile.

    The digest is over float32 little-endian values, field by field, in z, y, x order. A task holds one tile at a
    time and what an Arrow batch adds to it.
    """
    tiled = points.withColumn("tile_key", tile_key(*(F.floor(F.col(a) / block) * block for a in "xyz")))
    good = F.lit(True)
    for c in fields:
        good &= finite(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            yield tile_digests(table, tile_starts(table), fields)

    slim = tiled.select("time_index", "tile_key", "z", "y", "x", *fields, good.cast("int").alias("good"))
    dealt = slim.repartition("time_index", "tile_key").sortWithinPartitions("time_index", "tile_key", "z", "y", "x")
    return dealt.mapInArrow(run, "time_index int, tile_key string, n_points long, n_finite long, byte_count long, sha256 string")


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables that hold whole tiles."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        starts = tile_starts(table)
        if len(starts) > 1:  # the last tile may go on in the next batch
            yield table.slice(0, starts[-1]).combine_chunks()
            held = table.slice(starts[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def tile_starts(table: pa.Table) -> np.ndarray:
    key, t = table.column("tile_key").to_numpy(), table.column("time_index").to_numpy()
    return np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (t[1:] != t[:-1])))


def tile_digests(table: pa.Table, starts: np.ndarray, fields: list[str]) -> pa.RecordBatch:
    ends = np.append(starts[1:], table.num_rows)
    values = np.stack([table.column(c).to_numpy().astype("<f4") for c in fields])
    good = np.concatenate([[0], np.cumsum(table.column("good").to_numpy())])
    raw = [np.ascontiguousarray(values[:, a:b]).tobytes() for a, b in zip(starts, ends, strict=True)]
    first = table.take(pa.array(starts))
    out = [first.column("time_index").combine_chunks(), first.column("tile_key").combine_chunks(), pa.array(ends - starts), pa.array(good[ends] - good[starts])]
    out += [pa.array([len(x) for x in raw], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string())]
    return pa.RecordBatch.from_arrays(out, names=["time_index", "tile_key", "n_points", "n_finite", "byte_count", "sha256"])
