"""Reductions with exact semantics: moments, exact percentiles, dense histograms, ordered digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelflux.functions.fields import wide
from voxelflux.session import shared_dir

BINS = 4096
#: Times BINS, values that one task sorts for a group.
SORTED = 16


def exact_percentile(df: DataFrame, value: Column, share: float) -> float | None:
    """The percentile of all values; None if there is none."""
    row = percentiles(df, [], value, {"p": share}).first()
    return row.p if row else None


def percentiles(df: DataFrame, keys: list[str], value: Column, shares: dict[str, float]) -> DataFrame:
    """(keys, a column for each of shares): percentiles of each group, linearly interpolated at rank (n - 1) * share. Without
    keys one row, or none if there is no value.

    Groups of at most SORTED * BINS values are sorted: each value goes once through one exchange, and its row number is its rank.
    In larger groups each rank has an interval that holds its value. A pass counts the values of an interval in bins of equal
    width, at most BINS; there is one for BINS values, so counts are few beside values, but for the interval of a bin that held
    over half of the last one's. A bin that holds a rank is one of the next intervals. It is narrowed on until its ends are equal, so that they are the value, or its values are few enough to
    be sorted. Ranks that share an interval share its counts. Intervals are a table that each pass writes anew, joined as Spark
    sees fit by its size; the driver learns only whether any are open. Nulls are left out; values must be finite.
    """
    values = df.select(*keys, wide(value).alias("v")).where("v is not null")
    most = SORTED * BINS
    ends = values.groupBy(*keys).agg(F.count("v").alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi")).where(F.col("total") > most)
    large = _kept(ends.select(*keys, "total", F.lit(0).cast("long").alias("before"), F.col("total").alias("n"), "lo", "hi", _parts(F.col("total")).alias("parts")))
    if large.isEmpty():
        return _interpolated(_sorted(_counted(values, keys), keys, shares), keys, shares)
    span = [*keys, "total", "before", "n", "lo", "hi"]
    found, now, few = large.where("lo = hi").select(span), large, None
    while not (open_ := now.where((F.col("lo") < F.col("hi")) & (F.col("n") > most))).isEmpty():
        now = _kept(_narrowed(values, keys, shares, open_))
        found = found.unionByName(now.where("lo = hi").select(span))
        rest = now.where((F.col("lo") < F.col("hi")) & (F.col("n") <= most)).select(span)
        few = rest if few is None else few.unionByName(rest)
    if keys:
        found = found.unionByName(_sorted(_counted(_held(values, keys, large, "left_anti"), keys), keys, shares))
    if few is not None and not few.isEmpty():
        held = _held(values, keys, few).where(F.col("v").between(F.col("lo"), F.col("hi")))
        found = found.unionByName(_sorted(held.select(*keys, "total", "before", "v"), keys, shares))
    return _interpolated(found, keys, shares)


def _kept(df: DataFrame) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/intervals-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _parts(n: Column) -> Column:
    """Bins for an interval of n values."""
    return F.least(F.lit(float(BINS)), F.greatest(F.lit(2.0), F.ceil(n / BINS).cast("double")))


def _ranks(shares: dict[str, float]) -> list[tuple[Column, Column, Column]]:
    """For each share its two ranks in a group of `total` values and what the second one weighs."""
    out = []
    for share in shares.values():
        at = (F.col("total") - 1) * F.lit(float(share))
        low = F.floor(at).cast("long")
        out.append((low, F.least(low + 1, F.col("total") - 1), at - F.floor(at)))
    return out


def _within(rank: Column) -> Column:
    return (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))


def _wanted(shares: dict[str, float]) -> Column:
    out = F.lit(False)
    for low, high, _ in _ranks(shares):
        out |= _within(low) | _within(high)
    return out


def _counted(values: DataFrame, keys: list[str]) -> DataFrame:
    """Values of whole groups that are small, with their number."""
    return values.select(*keys, F.count("v").over(Window.partitionBy(*keys)).alias("total"), F.lit(0).cast("long").alias("before"), "v")


def _sorted(held: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """The values at the ranks of shares, as intervals of one value; rows of held are (keys, total, before, v)."""
    place = F.row_number().over(Window.partitionBy(*keys, "before").orderBy("v")) - 1
    one = held.select(*keys, "total", (F.col("before") + place).alias("before"), F.lit(1).cast("long").alias("n"), F.col("v").alias("lo"), F.col("v").alias("hi"))
    return one.where(_wanted(shares))


def _held(values: DataFrame, keys: list[str], spans: DataFrame, how: str = "inner") -> DataFrame:
    """Values beside the intervals of their group, or those of groups without one."""
    if keys:
        renamed = spans.withColumnsRenamed({k: f"k_{k}" for k in keys})
        on = F.lit(True)
        for k in keys:
            on &= F.col(k).eqNullSafe(F.col(f"k_{k}"))
        return values.join(renamed, on, how).drop(*(f"k_{k}" for k in keys))
    rows = F.array(*(F.struct(*(F.lit(x).cast(t).alias(n) for n, t, x in zip(spans.columns, dict(spans.dtypes).values(), row, strict=True))) for row in spans.collect()))
    return values.select("v", F.inline(rows))  # two rows a share at most


def _narrowed(values: DataFrame, keys: list[str], shares: dict[str, float], open_: DataFrame) -> DataFrame:
    """The intervals after one pass over values; rows of open_ are (keys, total, before, n, lo, hi, parts)."""
    held = _held(values, keys, open_).where(F.col("v").between(F.col("lo"), F.col("hi")))
    parts = F.col("parts")
    width = F.col("hi") / parts - F.col("lo") / parts
    by_width = F.least(F.floor(F.col("v") / width - F.col("lo") / width).cast("double"), parts - 1)
    fine = F.col("lo") + width == F.col("lo")  # few doubles in between
    group = [*keys, "total", "before"]
    bins = held.groupBy(*group, F.when(fine, F.col("v")).otherwise(by_width).alias("bin")).agg(F.max("n").alias("was"), F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    sofar = F.sum("n").over(Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    hit = bins.withColumn("before", sofar - F.col("n"))
    crowded = F.col("n") > F.col("was") / 2  # then few bins hold values, so many of them cost little
    parts = F.when(crowded, F.lit(float(BINS))).otherwise(_parts(F.col("n"))).alias("parts")
    return hit.where(_wanted(shares)).select(*keys, "total", "before", "n", "lo", "hi", parts)


def _interpolated(found: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Percentiles from intervals of equal ends that hold the ranks of shares."""
    sides, out = [], []
    for i, (name, (low, high, part)) in enumerate(zip(shares, _ranks(shares), strict=True)):
        sides += [F.max(F.when(_within(rank), F.col("lo"))).alias(f"v{i}_{side}") for side, rank in ((1, low), (2, high))]
        sides.append(F.max(part).alias(f"f{i}"))
        out.append((F.col(f"v{i}_1") + (F.col(f"v{i}_2") - F.col(f"v{i}_1")) * F.col(f"f{i}")).alias(name))
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sides).where("_n > 0").select(*keys, *out)


def moments(fields: DataFrame, names: list[str]) -> DataFrame:
    """(field, point_count, total, sum_squares, rms, max_abs) for each field, from one scan."""
    aggs = []
    for c in names:
        v = wide(c)
        aggs += [F.count(v).alias(f"n_{c}"), F.sum(v).alias(f"s_{c}"), F.sum(v * v).alias(f"q_{c}"), F.max(F.abs(v)).alias(f"m_{c}")]
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"n_{c}").alias("point_count"), F.col(f"s_{c}").alias("total"), F.col(f"q_{c}").alias("sum_squares"), F.sqrt(F.try_divide(f"q_{c}", f"n_{c}")).alias("rms"), F.col(f"m_{c}").alias("max_abs")) for c in names))
    return fields.agg(*aggs).select(F.inline(rows))


def dense_counts(df: DataFrame, key: Column, name: str, bins: list) -> DataFrame:
    """(name, n) for all bins, also those without rows."""
    spark = df.sparkSession
    every = spark.createDataFrame([(b,) for b in bins], [name])
    seen = df.groupBy(key.cast(dict(every.dtypes)[name]).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return every.join(seen, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n"))


def ordered_digest(df: DataFrame, group: list[str], order: Column, digest: Column) -> DataFrame:
    """One digest a group: of its rows' digests in order. Groups are bounded, such as the tiles of a snapshot."""
    parts = F.array_sort(F.collect_list(F.struct(order.alias("k"), digest.alias("h"))))
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_parts"), F.sha2(F.array_join(F.transform(parts, lambda p: p["h"]), ""), 256).alias("digest"))


def tree(leaves: DataFrame) -> DataFrame:
    """A Merkle tree over the tiles of snapshots: (time_index, level, z, y, x, digest), the root being the highest level.

    leaves are (time_index, z, y, x, digest) with places counted in tiles. A node is the SHA-256 of the digests of its up to
    eight children, those of halves of each axis, in z, y, x order, so no group ever holds more than eight rows, and a tree of
    n tiles has log8(n) levels, each an eighth of the one below.
    """
    leaves = leaves.select("time_index", F.lit(0).alias("level"), "z", "y", "x", "digest")
    most = leaves.agg(F.max(F.greatest("z", "y", "x"))).first()[0]
    level, levels = leaves, [leaves]
    for depth in range(1, int(most or 0).bit_length() + 1):
        up = [F.shiftright(a, 1).alias(a) for a in "zyx"]
        part = F.array_sort(F.collect_list(F.struct(F.col("z").alias("a"), F.col("y").alias("b"), F.col("x").alias("c"), "digest")))
        joined = F.sha2(F.array_join(F.transform("parts", lambda p: p["digest"]), ""), 256)
        level = level.groupBy("time_index", *up).agg(part.alias("parts")).select("time_index", F.lit(depth).alias("level"), "z", "y", "x", joined.alias("digest"))
        levels.append(level)
    out = levels[0]
    for part in levels[1:]:
        out = out.unionByName(part)
    return out


def damaged(old: DataFrame, new: DataFrame) -> DataFrame:
    """(time_index, z, y, x) of the tiles that differ between two trees, found from the root down: a level's nodes are compared
    only below nodes that differ, so a changed tile costs eight comparisons a level."""
    top = old.agg(F.max("level")).first()[0] or 0
    keys = ["time_index", "z", "y", "x"]
    at = lambda tree, level: tree.where(F.col("level") == level).drop("level")
    wrong = None
    for level in range(top, -1, -1):
        a, b = at(old, level), at(new, level).withColumnRenamed("digest", "now")
        if wrong is not None:
            above = [F.shiftright(k, 1).alias(k) if k != "time_index" else F.col(k) for k in keys]
            a, b = (t.withColumn("above", F.struct(*above)).join(wrong.select(F.struct(*keys).alias("above")), "above", "left_semi").drop("above") for t in (a, b))
        wrong = a.join(b, keys, "full_outer").where(~F.col("digest").eqNullSafe(F.col("now"))).select(*keys)
    return wrong


def symmetric_limit(df: DataFrame, value: Column, percent: float = 99.0) -> float:
    """symmetric_limits() of all rows; 1 without a finite value."""
    row = symmetric_limits(df, [], value, percent).first()
    return row.color_limit if row else 1.0


def symmetric_limits(df: DataFrame, keys: list[str], value: Column, percent: float = 99.0) -> DataFrame:
    """(keys, color_limit): for each group the limit of a colour scale: the percentile of |value| over finite values, else their
    maximum, else 1. Groups without a finite value are left out.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be in (0, 100]")
    good = df.select(*keys, F.abs(wide(value)).alias("a")).where(~F.isnan("a") & (F.col("a") != float("inf")))
    shares = {"limit": percent / 100} | ({"most": 1.0} if percent < 100 else {})
    found = percentiles(good, keys, F.col("a"), shares)
    tries = [F.when(F.col(c) > 0, F.col(c)) for c in shares]
    return found.select(*keys, F.coalesce(*tries, F.lit(1.0)).alias("color_limit"))
