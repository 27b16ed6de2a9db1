"""Grid geometry as DataFrame operations: tiles, containment, crops, slices, seams, overlaps, coverage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelflux.functions.fields import tile_key, wide

POINT = ["time_index", "z", "y", "x"]


def tiles(snapshots: DataFrame, shape: tuple[int, int, int], block: tuple[int, int, int]) -> DataFrame:
    """Blocks that cover (nx, ny, nz) for each snapshot, the last of an axis cut short: key, origin, size.

    The blocks of one snapshot are generated from its row, so no join and no exchange is needed.
    """
    out = snapshots
    for axis, n, size in zip("zyx", shape[::-1], block[::-1], strict=True):
        out = out.withColumn(f"{axis}0", F.explode(F.sequence(F.lit(0), F.lit(n - 1), F.lit(size))))
        out = out.withColumn(f"n{axis}", F.least(F.lit(size), F.lit(n) - F.col(f"{axis}0")))
    return out.withColumn("tile_key", tile_key(F.col("x0"), F.col("y0"), F.col("z0")))


def inside(tile_rows: DataFrame, requests: DataFrame, block: tuple[int, int, int]) -> DataFrame:
    """Tiles joined with the request that contains them; request columns end in _r.

    Requests form a grid of `block`, so the only request that can contain a tile is found by division: an
    equi-join, not a range join. Containment is then checked in full.
    """
    other = requests.select(*(F.col(c).alias(f"{c}_r") for c in requests.columns))
    same = [F.col("time_index") == F.col("time_index_r")]
    fits = F.lit(True)
    for axis, size in zip("xyz", block, strict=True):
        same.append(F.floor(F.col(f"{axis}0") / size) * size == F.col(f"{axis}0_r"))
        fits &= F.col(f"{axis}0") + F.col(f"n{axis}") <= F.col(f"{axis}0_r") + F.col(f"n{axis}_r")
    on = same[0]
    for s in same[1:]:
        on &= s
    return tile_rows.join(other, on & fits)


def coverage(planned: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only: (keys, side)."""
    side = F.when(F.col("f").isNull(), "missing").otherwise("unplanned")
    both = planned.select(*keys, F.lit(1).alias("p")).join(found.select(*keys, F.lit(1).alias("f")), keys, "full_outer")
    return both.where("p is null or f is null").select(*keys, side.alias("side"))


def pending(planned: DataFrame, verified: DataFrame, keys: list[str]) -> DataFrame:
    """Planned rows that have no verified row with the same keys (digest included)."""
    return planned.join(verified.select(*keys), keys, "left_anti")


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def axis_lengths(points: DataFrame) -> DataFrame:
    """For each snapshot the length of its axes as its points have it, and whether no point is missing or doubled."""
    out = points.groupBy("time_index").agg(*((F.max(a) + 1).alias(f"n{a}") for a in "xyz"), F.count(F.lit(1)).alias("n_points"), F.min(F.least("x", "y", "z")).alias("first"))
    return out.withColumn("full", (F.col("n_points") == F.col("nx").cast("long") * F.col("ny") * F.col("nz")) & (F.col("first") == 0)).drop("first")


def missing_fields(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns that a frame lacks, in order."""
    return [c for c in required if c not in df.columns]


def in_tile() -> Column:
    """Whether a point lies in its row's tile (x0, y0, z0, nx, ny, nz)."""
    inside_it = F.lit(True)
    for a in "xyz":
        inside_it &= (F.col(a) >= F.col(f"{a}0")) & (F.col(a) < F.col(f"{a}0") + F.col(f"n{a}"))
    return inside_it


def plan(snapshots: DataFrame, shape: tuple[int, int, int], request: tuple[int, int, int], tile: tuple[int, int, int], crop_shape: tuple[int, int, int]) -> DataFrame:
    """For each snapshot the number of requests and tiles and uncompressed sizes: float32 velocity, ten work fields,
    24 floats a point of the crop and 17 bytes a point of the whole grid in the result."""
    def blocks(size: tuple[int, int, int]) -> Column:
        return F.lit(math.prod(-(-n // s) for n, s in zip(shape, size, strict=True)))

    points = F.lit(math.prod(shape)).cast("long")
    return snapshots.select(
        "time_index", blocks(request).cast("long").alias("requests"), blocks(tile).cast("long").alias("tiles"), (points * 12).alias("raw_bytes"),
        (points * 17 + F.lit(math.prod(crop_shape)) * 96).alias("result_bytes"), (points * 40).alias("workspace_bytes"),
    )


def crop(points: DataFrame, start: tuple[int, int, int], shape: tuple[int, int, int]) -> DataFrame:
    """The box start (x, y, z) + shape with local indices lz, ly, lx beside the global ones."""
    out = points
    for axis, s, n in zip("xyz", start, shape, strict=True):
        out = out.where((F.col(axis) >= s) & (F.col(axis) < s + n)).withColumn(f"l{axis}", F.col(axis) - s)
    return out


def plane(points: DataFrame, axis: str, index: int, fields: list[str], stride: int = 1) -> DataFrame:
    """Fields on the plane axis = index, every stride-th point of its two other axes."""
    if axis not in ("x", "y", "z"):
        raise ValueError(f"unknown axis: {axis}")
    others = [a for a in ("z", "y", "x") if a != axis]
    out = points.where(F.col(axis) == index)
    for a in others if stride > 1 else []:
        out = out.where(F.col(a) % stride == 0)
    return out.select("time_index", *others, *fields)


def pivot_components(long: DataFrame, names: tuple[str, ...] = ("ux", "uy", "uz")) -> DataFrame:
    """(time_index, z, y, x, c, v) to one row a point. The components are known, so no pass looks for them."""
    return long.groupBy(*POINT).agg(*(F.max(F.when(F.col("c") == i, F.col("v"))).alias(name) for i, name in enumerate(names)))


def seams(points: DataFrame, n: int, fields: list[str]) -> DataFrame:
    """For each snapshot and axis the rms step across the periodic seam, inside the first pair, and their ratio.

    Only planes 0, 1 and n - 1 are read, and each line's three values meet in one aggregate: no self join.
    """
    found = None
    for axis in ("x", "y", "z"):
        others = [a for a in ("z", "y", "x") if a != axis]
        at = lambda i, c: F.max(F.when(F.col(axis) == i, wide(c)))  # noqa: B023,E731
        line = points.where(F.col(axis).isin(0, 1, n - 1)).groupBy("time_index", *others).agg(*(f(c).alias(k) for c in fields for f, k in ((lambda c: at(0, c) - at(n - 1, c), f"w_{c}"), (lambda c: at(1, c) - at(0, c), f"i_{c}"))))
        square = lambda k: sum((F.col(f"{k}_{c}") * F.col(f"{k}_{c}") for c in fields), F.lit(0.0)) / len(fields)
        part = line.groupBy("time_index").agg(F.lit(axis).alias("axis"), F.sqrt(F.avg(square("w"))).alias("wrap_rms"), F.sqrt(F.avg(square("i"))).alias("internal_rms"))
        found = part if found is None else found.unionByName(part)
    return found.withColumn("ratio", F.col("wrap_rms") / F.greatest("internal_rms", F.lit(1e-30)))


def overlap(old: DataFrame, new: DataFrame, start: tuple[int, int, int], fields: list[str], rtol: float = 5e-5, atol: float = 5e-6) -> DataFrame:
    """Largest |old - new| of each field where a crop (local indices) meets the whole grid, and whether all are close."""
    moved = old.select("time_index", *((F.col(a) + s).alias(a) for a, s in zip("xyz", start, strict=True)), *(F.col(c).alias(f"o_{c}") for c in fields))
    both = moved.join(new.select(*POINT, *fields), POINT)
    diff = {c: F.abs(wide(f"o_{c}") - wide(c)) for c in fields}
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"d_{c}").alias("max_diff"), F.col(f"k_{c}").alias("close")) for c in fields))
    aggs = [a for c in fields for a in (F.max(diff[c]).alias(f"d_{c}"), F.bool_and(diff[c] <= atol + rtol * F.abs(wide(c))).alias(f"k_{c}"))]
    return both.groupBy("time_index").agg(*aggs).select("time_index", F.inline(rows))


def cached_velocity(held: DataFrame, new: DataFrame, start: tuple[int, int, int], names: tuple[str, ...] = ("bx", "by", "bz")) -> DataFrame:
    """overlap() of a stored crop of the filtered velocity with one on the whole grid, at the tolerances of a reusable cache."""
    return overlap(held, new, start, list(names), rtol=2e-5, atol=2e-6)


def ordered(tile_rows: DataFrame) -> DataFrame:
    """Tiles with their place in a snapshot's listing (by z0, y0, x0) and in natural order (by x0, y0, z0), from 1."""
    place = lambda *c: F.row_number().over(Window.partitionBy("time_index").orderBy(*c))
    return tile_rows.withColumns({"listed": place("z0", "y0", "x0"), "natural": place("x0", "y0", "z0")})


def unpivot(points: DataFrame, fields: list[str]) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(i).alias("c"), F.col(f).alias("v")) for i, f in enumerate(fields)))
    return points.select(*POINT, F.inline(pairs))


def key_of(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)
