"""Per-axis periodic transforms: derivative and Gaussian filter.

Both are diagonal along each axis, so a set of transforms of a snapshot takes two exchanges whatever its number and its
filter widths: planes of constant z for the x and y axes, then planes of constant y for the z axis. A group is one plane of
n * n points, never a whole snapshot; where even a plane is too large, lines along each axis in turn take three exchanges and
a task holds a batch of lines. Everything else about fields stays in DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DERIVE, FILTER = "d", "g"
KEYS = ["time_index", "z", "y", "x"]


def multiplier(n: int, ops: str, length: float, sigma: float, precision: type = np.float64) -> np.ndarray:
    """Factors of the real spectrum of a line of n points for "d" (derivative), "g" (Gaussian) or both.

    The mode n / 2 of an even line has no derivative. Sigma counts grid spacings.
    """
    k = np.arange(n // 2 + 1)
    out = np.ones(n // 2 + 1, complex)
    if DERIVE in ops:
        wave = 2j * np.pi * k / length
        if n % 2 == 0:
            wave[-1] = 0
        out = out * wave
    if FILTER in ops:
        if not sigma > 0:
            raise ValueError("sigma must be positive")
        out = out * np.exp(-0.5 * (sigma * 2 * np.pi * k / n) ** 2)
    return out.astype(np.complex64 if precision is np.float32 else complex)


def along(values: np.ndarray, axis: int, ops: str, length: float, sigma: float) -> np.ndarray:
    if not ops:
        return values
    shape = [1] * values.ndim
    shape[axis] = -1
    factor = multiplier(values.shape[axis], ops, length, sigma, values.dtype.type).reshape(shape)
    return np.fft.irfft(np.fft.rfft(values, axis=axis) * factor, n=values.shape[axis], axis=axis).astype(values.dtype)


def both_sides(half: np.ndarray, n: int) -> np.ndarray:
    """Factors of the whole spectrum of n modes from those of the modes that are not negative."""
    return np.concatenate([half, half[1 : n - n // 2][::-1].conj()])


def over_planes(values: np.ndarray, wanted: list[tuple[str, str, float]], length: float) -> list[np.ndarray]:
    """values (planes, n, n) under each of wanted: (operations of axis 1, of axis 2, sigma).

    Forward spectra are taken once, whatever the number of operations and filter widths.
    """
    n, kind = values.shape[1], values.dtype
    factor = lambda ops, sigma: multiplier(n, ops, length, sigma, kind.type)
    spectra: dict[bool, np.ndarray] = {}
    out = []
    for first, second, sigma in wanted:
        if not first and not second:
            out.append(values)
            continue
        plane = bool(second)
        if plane not in spectra:
            spectra[plane] = np.fft.rfft2(values, axes=(1, 2)) if plane else np.fft.rfft(values, axis=1)
        if plane:
            both = both_sides(factor(first, sigma), n)[:, None] * factor(second, sigma)[None, :]
            out.append(np.fft.irfft2(spectra[plane] * both, s=(n, n), axes=(1, 2)).astype(kind))
        else:
            out.append(np.fft.irfft(spectra[plane] * factor(first, sigma)[:, None], n=n, axis=1).astype(kind))
    return out


@dataclass(frozen=True)
class Transform:
    """out = source with ops along x, y and z, each "", "d", "g" or "dg"; sigma is that of a filter, if it has one of its own."""

    out: str
    source: str
    x: str = ""
    y: str = ""
    z: str = ""
    sigma: float | None = None


def derivative(out: str, source: str, axis: str) -> Transform:
    return Transform(out, source, **{axis: DERIVE})


def gaussian(out: str, source: str, sigma: float | None = None) -> Transform:
    return Transform(out, source, FILTER, FILTER, FILTER, sigma)


def filtered_derivative(out: str, source: str, axis: str, sigma: float | None = None) -> Transform:
    return Transform(out, source, **{a: FILTER + (DERIVE if a == axis else "") for a in "xyz"}, sigma=sigma)


Step = tuple[str, str, str, str, float]


def _planes(df: DataFrame, n: int, fixed: str, steps: list[Step], keep: list[str], length: float, kind: str) -> DataFrame:
    """One pass over planes of constant `fixed`; steps are (out, source, ops of axis 0, ops of axis 1, sigma).

    Spark deals rows by plane and sorts them (and spills if it must); a task transforms the planes as they come, as
    many at once as an Arrow batch completes, and holds one plane more at most.
    """
    rows, cols = ("y", "x") if fixed == "z" else ("z", "x")
    dtype, size = (np.float32 if kind == "float" else np.float64), n * n
    of: dict[str, list[int]] = {}
    for i, step in enumerate(steps):
        of.setdefault(step[1], []).append(i)

    def planes(table: pa.Table) -> pa.RecordBatch:
        place = {c: table.column(c).to_numpy() for c in KEYS}
        count = table.num_rows // size
        fits = (place[rows] * np.int64(n) + place[cols] == np.tile(np.arange(size), count)).all()
        for c in ("time_index", fixed):
            own = place[c].reshape(count, size)
            fits = fits and (own == own[:, :1]).all()
        if not fits:
            raise ValueError(f"a plane lacks points of its {n} x {n} grid or holds some twice")
        made: dict[int, pa.Array] = {}
        for source, own_steps in of.items():
            grid = table.column(source).to_numpy().astype(dtype).reshape(count, n, n)
            done = over_planes(grid, [(steps[i][2], steps[i][3], steps[i][4]) for i in own_steps], length)
            made |= {i: pa.array(x.reshape(-1)) for i, x in zip(own_steps, done, strict=True)}
        out = [table.column(c).combine_chunks() for c in [*KEYS, *keep]] + [made[i] for i in range(len(steps))]
        return pa.RecordBatch.from_arrays(out, names=[*KEYS, *keep, *(s[0] for s in steps)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= size:
                table = pa.Table.from_batches(held)
                whole = waiting // size * size
                yield planes(table.slice(0, whole))
                held, waiting = table.slice(whole).combine_chunks().to_batches(), waiting - whole
        if waiting:
            raise ValueError(f"a plane of {n} x {n} points has {waiting} rows")

    types = dict(df.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in [*KEYS, *keep]] + [f"{s[0]} {kind}" for s in steps])
    needed = list(dict.fromkeys([*KEYS, *keep, *(s[1] for s in steps)]))
    dealt = df.select(*needed).repartition("time_index", fixed).sortWithinPartitions("time_index", fixed, rows, cols)
    return dealt.mapInArrow(run, schema)


def _lines(df: DataFrame, n: int, axis: str, steps: list[tuple[str, str, str, float]], keep: list[str], length: float, kind: str) -> DataFrame:
    """One pass over lines along an axis; steps are (out, source, ops, sigma). Rows are dealt by line and sorted; a task holds the
    lines that an Arrow batch completes and one line more at most."""
    others = [a for a in ("z", "y", "x") if a != axis]
    dtype = np.float32 if kind == "float" else np.float64
    of: dict[str, list[int]] = {}
    for i, step in enumerate(steps):
        of.setdefault(step[1], []).append(i)

    def lines(table: pa.Table) -> pa.RecordBatch:
        count = table.num_rows // n
        fits = (table.column(axis).to_numpy() == np.tile(np.arange(n), count)).all()
        for c in ("time_index", *others):
            own = table.column(c).to_numpy().reshape(count, n)
            fits = fits and (own == own[:, :1]).all()
        if not fits:
            raise ValueError(f"a line lacks points of its {n} or holds some twice")
        made: dict[int, pa.Array] = {}
        for source, own_steps in of.items():
            values = table.column(source).to_numpy().astype(dtype).reshape(count, n)
            spectrum = np.fft.rfft(values, axis=1) if any(steps[i][2] for i in own_steps) else None
            for i in own_steps:
                _, _, ops, sigma = steps[i]
                done = np.fft.irfft(spectrum * multiplier(n, ops, length, sigma, dtype), n=n, axis=1).astype(dtype) if ops else values
                made[i] = pa.array(done.reshape(-1))
        out = [table.column(c).combine_chunks() for c in [*KEYS, *keep]] + [made[i] for i in range(len(steps))]
        return pa.RecordBatch.from_arrays(out, names=[*KEYS, *keep, *(s[0] for s in steps)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= n:
                table = pa.Table.from_batches(held)
                whole = waiting // n * n
                yield lines(table.slice(0, whole))
                held, waiting = table.slice(whole).combine_chunks().to_batches(), waiting - whole
        if waiting:
            raise ValueError(f"a line of {n} points has {waiting} rows")

    types = dict(df.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in [*KEYS, *keep]] + [f"{s[0]} {kind}" for s in steps])
    needed = list(dict.fromkeys([*KEYS, *keep, *(s[1] for s in steps)]))
    dealt = df.select(*needed).repartition("time_index", *others).sortWithinPartitions("time_index", *others, axis)
    return dealt.mapInArrow(run, schema)


def _pencils(points: DataFrame, n: int, wanted: list[Transform], keep: list[str], length: float, kind: str) -> DataFrame:
    """transform() in three exchanges, one an axis: no task holds a plane."""
    now, at = points, {t.out: t.source for t in wanted}  # the column in which each transform stands so far
    for axis in "xyz":
        names: dict[tuple, str] = {}
        for t in wanted:
            ops = getattr(t, axis)
            if ops:
                names.setdefault((at[t.out], ops, t.sigma if FILTER in ops else 0.0), f"_{axis}{len(names)}")
        if not names:
            continue
        moved = {t.out: names[at[t.out], getattr(t, axis), t.sigma if FILTER in getattr(t, axis) else 0.0] if getattr(t, axis) else at[t.out] for t in wanted}
        later = {at[t.out] for t in wanted if not getattr(t, axis)} - set(keep)
        now = _lines(now, n, axis, [(name, source, ops, sigma or 1.0) for (source, ops, sigma), name in names.items()], [*keep, *sorted(later)], length, kind)
        at = moved
    return now.select(*KEYS, *keep, *(F.col(at[t.out]).cast(kind).alias(t.out) for t in wanted))


#: Points of a plane up to which a task takes it whole; larger ones are transformed line by line.
PLANE_POINTS = 1 << 22


def transform(points: DataFrame, n: int, wanted: Iterable[Transform], *, keep: Iterable[str] = (), length: float = 2 * np.pi, sigma: float = 1.0, kind: str = "double", plane_points: int | None = None) -> DataFrame:
    """points (time_index, z, y, x, fields) with the wanted transforms beside the columns in keep.

    kind is the type of the transforms: double, or float as fields are stored. sigma holds for filters without one of their own.
    Planes of more than plane_points points (PLANE_POINTS) are never held: such grids take three exchanges, by lines.
    """
    wanted, keep = [t if t.sigma else replace(t, sigma=sigma) for t in wanted], list(keep)
    if n * n > (plane_points or PLANE_POINTS):
        return _pencils(points, n, wanted, keep, length, kind)
    key = lambda t: (t.source, t.x, t.y, t.sigma if FILTER in t.x + t.y else 0.0)
    inner: dict[tuple, str] = {}
    for t in wanted:
        inner.setdefault(key(t), f"_{len(inner)}")
    first = _planes(points, n, "z", [(name, source, y, x, s or sigma) for (source, x, y, s), name in inner.items()], keep, length, kind)
    if not any(t.z for t in wanted):
        return first.select(*KEYS, *keep, *(F.col(inner[key(t)]).alias(t.out) for t in wanted))
    ready = [t for t in wanted if not t.z]
    carried = list(dict.fromkeys(inner[key(t)] for t in ready))
    second = _planes(first, n, "y", [(t.out, inner[key(t)], t.z, "", t.sigma) for t in wanted if t.z], keep + carried, length, kind)
    return second.select(*KEYS, *keep, *(F.col(inner[key(t)]).alias(t.out) if not t.z else F.col(t.out) for t in wanted))


def line(values: Column, ops: str, *, length: float = 2 * np.pi, sigma: float = 1.0) -> Column:
    """A transform of whole periodic lines held as arrays of equal length; no exchange."""

    @F.pandas_udf("array<double>")
    def run(lines: pd.Series) -> pd.Series:
        if not len(lines):
            return lines
        return pd.Series(list(along(np.stack(lines.to_numpy()).astype(float), 1, ops, length, sigma)))

    return run(values)
