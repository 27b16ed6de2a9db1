"""Small frames behind figures: ordered rows of reports, and slices with colour limits. Drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelflux.functions.fields import QUADRANTS, scientific, symlog, wide
from voxelflux.operators.aggregates import symmetric_limit
from voxelflux.operators.grid import plane

TOTALS = ("s_bar", "pi", "work_resolved", "work_full")


def totals(qa: DataFrame) -> DataFrame:
    """(place, field, total) of budget_qa's totals, smallest effect first."""
    rows = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(c).alias("field"), F.col(f"total_{c}").alias("total")) for i, c in enumerate(TOTALS)))
    return qa.select(F.inline(rows)).orderBy("place")


def gates(qa: DataFrame, identity_max: float, net_max: float) -> DataFrame:
    """(metric, value, threshold, status) of budget_qa's two gates; an undefined value is named so."""
    row = lambda name, value, limit, ok: F.struct(F.lit(name).alias("metric"), scientific(F.col(value)).alias("value"), scientific(F.lit(limit)).alias("threshold"), F.when(F.col(ok), "pass").otherwise("fail").alias("status"))
    return qa.select(F.inline(F.array(row("identity residual", "relative_residual", identity_max, "identity_passed"), row("net transport", "s_bar_vs_pi", net_max, "net_passed"))))


def signs(weak: DataFrame) -> DataFrame:
    """(place, part, total, n, volume_fraction): backward, forward, net; the net row counts points that are zero."""
    part = lambda i, name, total, n: F.struct(F.lit(i).alias("place"), F.lit(name).alias("part"), F.col(total).alias("total"), F.col(n).alias("n"), F.try_divide(F.col(n), F.col("point_count")).alias("volume_fraction"))
    return weak.select(F.inline(F.array(part(0, "positive", "positive_sum", "positive_count"), part(1, "negative", "negative_sum", "negative_count"), part(2, "net", "pi_sum", "zero_count")))).orderBy("place")


def quadrants(flux: DataFrame) -> DataFrame:
    """(place, quadrant, n, conditional_mean) of quadrant_flux, Q1 to Q4."""
    place = F.array_position(F.array(*(F.lit(q) for q in QUADRANTS)), F.col("quadrant")) - 1
    return flux.select(place.cast("int").alias("place"), "quadrant", "n", "conditional_mean").orderBy("place")


def continuous_slice(points: DataFrame, n: int, axis: str, index: int, field: str, *, percent: float = 99.0, scale: str = "linear", threshold: float | None = None, most: int = 512) -> tuple[DataFrame, float]:
    """A plane of a field, thinned to about `most` points an axis, and the symmetric limit of its colours.

    scale is linear or symlog; symlog needs a positive threshold and linear takes none.
    """
    if scale not in ("linear", "symlog") or (scale == "symlog") != (threshold is not None):
        raise ValueError("scale is linear, or symlog with a threshold")
    flat = plane(points, axis, index, [field], max(1, n // most))
    value = symlog(wide(field), threshold) if scale == "symlog" else wide(field)
    flat = flat.withColumn("value", value)
    return flat, symmetric_limit(flat, F.col("value"), percent)


def regime_slice(points: DataFrame, axis: str, index: int) -> DataFrame:
    """A plane of regime codes, never thinned: codes have no order that thinning would keep."""
    return plane(points, axis, index, ["regime"])
