"""The scalar reports over stored fields, each one scan, as one-row or few-row DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelflux.functions.fields import QUADRANTS, guarded, identity_residual, quadrant, ratio, wide
from voxelflux.operators.aggregates import exact_percentile


def quadrant_flux(fields: DataFrame) -> DataFrame:
    """Conditional flux of pi by the signs of both works: a row for each of Q1 to Q4, also for empty ones.

    (quadrant, n, volume_fraction, pi_sum, stored_cq, conditional_mean, les_cq, les_conditional_mean)
    """
    pi, wf, wr = (guarded(wide(c), c) for c in ("pi", "work_full", "work_resolved"))
    rows = fields.select(pi.alias("pi"), quadrant(wf, wr).alias("quadrant"))
    aggs = [F.count(F.lit(1)).alias("n_all")]
    for q in QUADRANTS:
        own = F.col("quadrant") == q
        aggs += [F.count_if(own).alias(f"n_{q}"), F.coalesce(F.sum(F.when(own, F.col("pi"))), F.lit(0.0)).alias(f"s_{q}")]
    each = F.array(*(F.struct(F.lit(q).alias("quadrant"), F.col(f"n_{q}").alias("n"), F.col(f"s_{q}").alias("pi_sum")) for q in QUADRANTS))
    out = rows.agg(*aggs).select("n_all", F.inline(each))
    cq, mean = F.try_divide("pi_sum", "n_all"), F.try_divide("pi_sum", "n")
    return out.select("quadrant", "n", F.try_divide("n", "n_all").alias("volume_fraction"), "pi_sum", cq.alias("stored_cq"), mean.alias("conditional_mean"), (-cq).alias("les_cq"), (-mean).alias("les_conditional_mean"))


def quadrant_closure(fields: DataFrame, limit: float = 1e-12) -> DataFrame:
    """Whether the quadrants' counts and sums come to those of all points: one row."""
    pi, wf, wr = (guarded(wide(c), c) for c in ("pi", "work_full", "work_resolved"))
    rows = fields.select(pi.alias("pi"), quadrant(wf, wr).alias("q"))
    parts = rows.rollup("q").agg(F.count(F.lit(1)).alias("n"), F.sum("pi").alias("s"), F.sum(F.abs("pi")).alias("a"))
    every, own = F.col("q").isNull(), F.col("q").isNotNull()
    one = parts.agg(
        F.sum(F.when(own, F.col("n"))).alias("covered"), F.max(F.when(every, F.col("n"))).alias("point_count"),
        F.sum(F.when(own, F.col("s"))).alias("parts_sum"), F.max(F.when(every, F.col("s"))).alias("pi_sum"), F.max(F.when(every, F.col("a"))).alias("abs_sum"),
    )
    relative = ratio(F.abs(F.col("parts_sum") - F.col("pi_sum")), F.col("abs_sum"))
    return one.withColumn("relative_residual", relative).withColumn("passed", (F.col("covered") == F.col("point_count")) & F.coalesce(F.col("relative_residual") <= limit, F.lit(False)))


def weak_asymmetry(fields: DataFrame, limit: float = 1e-12) -> DataFrame:
    """Balance of forward (pi < 0) and backward (pi > 0) flux: one row, with exact p99 and maximum of |pi|."""
    pi = guarded(wide("pi"), "pi")
    rows = fields.select(pi.alias("pi"))
    p99 = exact_percentile(rows, F.abs(F.col("pi")), 0.99)
    v = F.col("pi")
    out = rows.agg(
        F.count(v).alias("point_count"), F.sum(v).alias("pi_sum"), F.sum(F.abs(v)).alias("abs_sum"), F.sum(v * v).alias("sum_squares"), F.max(F.abs(v)).alias("abs_max"),
        F.coalesce(F.sum(F.when(v > 0, v)), F.lit(0.0)).alias("positive_sum"), F.coalesce(F.sum(F.when(v < 0, v)), F.lit(0.0)).alias("negative_sum"),
        F.count_if(v > 0).alias("positive_count"), F.count_if(v < 0).alias("negative_count"), F.count_if(v == 0).alias("zero_count"),
    )
    out = out.withColumn("pi_mean", F.try_divide("pi_sum", "point_count")).withColumn("pi_rms", F.sqrt(F.try_divide("sum_squares", "point_count"))).withColumn("abs_p99", F.lit(p99).cast("double"))
    mean = F.col("pi_mean")
    closure = ratio(F.abs(F.col("positive_sum") + F.col("negative_sum") - F.col("pi_sum")), F.col("abs_sum"))
    return out.withColumns({
        "asymmetry_index": ratio(mean, F.col("pi_rms")), "ratio_p99": ratio(F.abs(mean), F.col("abs_p99")), "ratio_max": ratio(F.abs(mean), F.col("abs_max")),
        "closure_residual": closure,
        "passed": (F.col("positive_count") + F.col("negative_count") + F.col("zero_count") == F.col("point_count")) & F.coalesce(closure <= limit, F.lit(False)),
    })


def tail(fields: DataFrame) -> DataFrame:
    """(point_count, abs_p99, abs_max) of pi: what a report of an older version lacks, without the other fields."""
    rows = fields.select(F.abs(guarded(wide("pi"), "pi")).alias("a"))
    p99 = exact_percentile(rows, F.col("a"), 0.99)
    return rows.agg(F.count("a").alias("point_count"), F.max("a").alias("abs_max")).select("point_count", F.lit(p99).cast("double").alias("abs_p99"), "abs_max")


def weak_by_quadrant(fields: DataFrame) -> DataFrame:
    """The balance of forward and backward flux inside each quadrant that has points."""
    pi, wf, wr = (guarded(wide(c), c) for c in ("pi", "work_full", "work_resolved"))
    v = F.col("pi")
    out = fields.select(pi.alias("pi"), quadrant(wf, wr).alias("quadrant")).groupBy("quadrant").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v > 0).alias("positive_count"), F.sum(F.when(v > 0, v)).alias("positive_sum"), F.sum(F.when(v < 0, v)).alias("negative_sum"),
        F.avg(v).alias("mean"), F.sqrt(F.avg(v * v)).alias("rms"),
    )
    return out.select("quadrant", "n", "positive_count", "positive_sum", "negative_sum", ratio(F.col("mean"), F.col("rms")).alias("asymmetry_index"))


def budget_qa(fields: DataFrame, identity_max: float = 1e-4, net_max: float = 1e-2, keys: list[str] | None = None) -> DataFrame:
    """Closure of work_full = work_resolved - pi + s_bar, and net s_bar against net pi: one row (for each of keys)."""
    names = ("work_full", "work_resolved", "pi", "s_bar")
    w: dict[str, Column] = {c: guarded(wide(c), c) for c in names}
    res = identity_residual(w["work_full"], w["work_resolved"], w["pi"], w["s_bar"])
    aggs = [F.count(F.lit(1)).alias("point_count"), *(F.sum(w[c]).alias(f"total_{c}") for c in names)]
    aggs += [F.sqrt(F.avg(res * res)).alias("residual_rms"), F.max(F.abs(res)).alias("residual_max"), F.sqrt(sum((F.avg(w[c] * w[c]) for c in names), F.lit(0.0))).alias("joint_rms")]
    out = (fields.groupBy(*keys) if keys else fields).agg(*aggs)
    out = out.withColumn("relative_residual", ratio(F.col("residual_rms"), F.col("joint_rms"))).withColumn("s_bar_vs_pi", ratio(F.abs("total_s_bar"), F.abs("total_pi")))
    out = out.withColumn("identity_passed", F.coalesce(F.col("relative_residual") <= identity_max, F.lit(False))).withColumn("net_passed", F.coalesce(F.col("s_bar_vs_pi") <= net_max, F.lit(False)))
    return out.withColumn("passed", F.col("identity_passed") & F.col("net_passed"))


def reclassified(qa: DataFrame, identity_max: float, net_max: float) -> DataFrame:
    """budget_qa's verdicts under other limits, from its stored numbers: no scan of fields."""
    out = qa.withColumn("identity_passed", F.coalesce(F.col("relative_residual") <= identity_max, F.lit(False)))
    out = out.withColumn("net_passed", F.coalesce(F.col("s_bar_vs_pi") <= net_max, F.lit(False)))
    return out.withColumn("passed", F.col("identity_passed") & F.col("net_passed"))


def snapshot_statistics(points: DataFrame, fields: list[str]) -> DataFrame:
    """For each snapshot count, minimum, maximum, mean and rms over all components together, and if all are finite."""
    v = [wide(c) for c in fields]
    total, squares = sum(v[1:], v[0]), sum((x * x for x in v), F.lit(0.0))
    good = F.lit(True)
    for x in v:
        good &= x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    n = F.count(F.lit(1)) * len(fields)
    return points.groupBy("time_index").agg(n.alias("n"), F.min(F.array_min(F.array(*v))).alias("minimum"), F.max(F.array_max(F.array(*v))).alias("maximum"), (F.sum(total) / n).alias("mean"), F.sqrt(F.sum(squares) / n).alias("rms"), F.bool_and(good).alias("all_finite"))
