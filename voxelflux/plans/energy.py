"""From velocity to energy-budget fields: the plan of one snapshot and one filter width.

Transforms of the same stage share two exchanges (see operators.spectral), so the whole chain takes six:
velocity -> filtered velocity and both gradient tensors; accelerations and products -> their filtered forms;
transport -> its divergence. Everything between is column arithmetic. work_full, work_resolved and pi need no third stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelflux.functions.fields import TINY, dot, regime, wide
from voxelflux.operators.spectral import KEYS, Transform, derivative, filtered_derivative, gaussian, transform

U, UB = ("ux", "uy", "uz"), ("bx", "by", "bz")
AXES = "xyz"
PAIRS = [(i, j) for i in range(3) for j in range(i, 3)]
ENERGY = ["work_full", "work_resolved", "pi", "s_bar"]


def gradient_names(prefix: str) -> list[str]:
    return [f"{prefix}_{i}{j}" for i in AXES for j in AXES]


def gradients(points: DataFrame, n: int, **options) -> DataFrame:
    """g_ij, the derivative of component i along axis j, beside the velocity."""
    return transform(points, n, [derivative(f"g_{i}{j}", f"u{i}", j) for i in AXES for j in AXES], keep=U, **options)


def filtered(points: DataFrame, n: int, **options) -> DataFrame:
    """Gaussian-filtered velocity bx, by, bz beside the velocity."""
    return transform(points, n, [gaussian(b, u) for b, u in zip(UB, U, strict=True)], keep=U, **options)


def filtered_batch(points: DataFrame, n: int, sigmas: list[float], **options) -> DataFrame:
    """Filtered velocities of several widths, bx_s0, ..., in the two exchanges of one."""
    return energy_batch(points, n, sigmas, wanted=list(UB), **options)


def divergence(prefix: str) -> Column:
    return F.col(f"{prefix}_xx") + F.col(f"{prefix}_yy") + F.col(f"{prefix}_zz")


def tau(i: int, j: int) -> Column:
    """Subgrid stress: filter(u_i u_j) - ub_i ub_j; symmetric, so six are kept."""
    a, b = sorted((i, j))
    return F.col(f"tau_{AXES[a]}{AXES[b]}")


TAU = [f"tau_{AXES[i]}{AXES[j]}" for i, j in PAIRS]
TRANSPORT = [f"t_{j}" for j in AXES]
FIELDS = [*U, *UB, *gradient_names("g"), *gradient_names("h"), *TAU, *TRANSPORT, *ENERGY, "div", "div_bar"]


SHARED = [*U, *gradient_names("g"), "div"]  # what no filter width changes


def own(name: str, i: int) -> str:
    """The name of a field at the i-th filter width of a batch."""
    return name if name in SHARED else f"{name}_s{i}"


def of_sigma(batch: DataFrame, i: int) -> DataFrame:
    """The fields of a batch at its i-th filter width, under their plain names."""
    held = [x for x in FIELDS if own(x, i) in batch.columns]
    return batch.select(*KEYS, *(F.col(own(x, i)).alias(x) for x in held))


def energy_fields(points: DataFrame, n: int, *, sigma: float, length: float = 2 * math.pi, kind: str = "double", wanted: list[str] | None = None, ready: bool = False) -> DataFrame:
    """points with those of FIELDS that are wanted (all by default): b*, both gradients (g_ij, h_ij), tau_ij, transport
    t_j, div, div_bar and the four energy fields.

    With ready, points hold bx, by and bz at this sigma already, and the velocity is not filtered again.
    """
    if ready:
        points = points.withColumnsRenamed({b: own(b, 0) for b in UB})
    return of_sigma(energy_batch(points, n, [sigma], length=length, kind=kind, wanted=wanted, ready=(0,) if ready else ()), 0)


def energy_batch(points: DataFrame, n: int, sigmas: list[float], *, length: float = 2 * math.pi, kind: str = "double", wanted: list[str] | None = None, ready: tuple[int, ...] = (), plane_points: int | None = None) -> DataFrame:
    """energy_fields() at all filter widths at once; of_sigma() has those of one. Fields that depend on the width end in _s0, _s1, ...

    Transforms of all widths share the exchanges of a stage, six in all whatever their number, and what is filtered in the
    second stage (accelerations, products of velocities) is made and sent once for all widths.

    Only the transforms that the wanted fields need are planned, and a column is carried through an exchange only if
    something after it reads it: the exchanges cannot be pruned, as Arrow functions stand between them. For widths in ready,
    points hold b*_s<i>: these velocities are not filtered again, and their gradients are plain derivatives of them.
    """
    options, c = {"length": length, "kind": kind, "plane_points": plane_points}, F.col
    wanted = FIELDS if wanted is None else wanted
    if unknown := set(wanted) - set(FIELDS):
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    every = range(len(sigmas))
    fields = [x for i in every for x in ([own(f, i) for f in FIELDS if f not in SHARED])]
    fields = [f for f in SHARED if f in wanted] + [f for f in fields if f.rsplit("_s", 1)[0] in wanted]
    want = lambda *names: any(x in wanted for x in names)
    stress = want("pi", "s_bar", *TAU, *TRANSPORT)
    raw, smooth = want("work_full", "div", *gradient_names("g")), want("work_resolved", "pi", "div_bar", *gradient_names("h"))
    held = [own(b, i) for i in ready for b in UB]
    first: list[Transform] = [derivative(f"g_{i}{j}", f"u{i}", j) for i in AXES for j in AXES] if raw else []
    for i, sigma in enumerate(sigmas):
        if i not in ready and (stress or want(*UB, "work_full", "work_resolved")):
            first += [gaussian(own(b, i), u, sigma) for b, u in zip(UB, U, strict=True)]
        for a, u, b in zip(AXES, U, UB, strict=True) if smooth else ():
            first += [derivative(own(f"h_{a}{j}", i), own(b, i), j) if i in ready else filtered_derivative(own(f"h_{a}{j}", i), u, j, sigma) for j in AXES]
    stage = transform(points, n, first, keep=[*U, *held], **options) if first else points.select(*KEYS, *U, *held)

    b = lambda i: [c(own(x, i)) for x in UB]
    h = lambda i, a: [c(own(f"h_{a}{j}", i)) for j in AXES]
    made = {}
    if want("div"):
        made["div"] = divergence("g")
    for i in every:
        if want("div_bar"):
            made[own("div_bar", i)] = sum((c(own(f"h_{a}{a}", i)) for a in "yz"), c(own("h_xx", i)))
        if want("work_resolved"):
            made[own("work_resolved", i)] = dot(b(i), [dot(b(i), h(i, a)) for a in AXES])
    later = {f"a_{i}": dot([c(u) for u in U], [c(f"g_{i}{j}") for j in AXES]) for i in AXES} if want("work_full") else {}
    later |= {f"p_{AXES[i]}{AXES[j]}": c(U[i]) * c(U[j]) for i, j in PAIRS} if stress else {}
    kept = [x for x in stage.columns if x in fields] + list(made)
    if later:  # what is filtered in the second stage, and what is read beside it there
        beside = [own(x, i) for i in every for x in [*UB, *(gradient_names("h") if want("pi") else [])]]
        kept = list(dict.fromkeys([*kept, *beside]))
        stage = stage.withColumns(made).select(*KEYS, *kept, *(v.alias(k) for k, v in later.items()))
        second = [gaussian(own(f"f{k}", i), k, sigma) for i, sigma in enumerate(sigmas) for k in later]
        stage = transform(stage, n, second, keep=kept, **options)
        made = {}
        for i in every:
            if want("work_full"):
                made[own("work_full", i)] = dot(b(i), [c(own(f"fa_{a}", i)) for a in AXES])
            if stress:
                stage = stage.withColumns({own(t, i): c(own(f"fp_{t[4:]}", i)) - b(i)[j] * b(i)[k] for t, (j, k) in zip(TAU, PAIRS, strict=True)})
                at = lambda j, k: c(own(TAU[PAIRS.index((min(j, k), max(j, k)))], i))  # noqa: B023,E731
                if want("pi"):
                    made[own("pi", i)] = dot([at(j, k) for j in range(3) for k in range(3)], [x for a in AXES for x in h(i, a)])
                if want("s_bar", *TRANSPORT):
                    made |= {own(f"t_{AXES[k]}", i): dot(b(i), [at(j, k) for j in range(3)]) for k in range(3)}
        transport = [own(t, i) for i in every for t in TRANSPORT]
        kept = [x for x in stage.columns if x in fields] + [x for x in made if x in fields or x in transport]
    stage = stage.withColumns(made).select(*KEYS, *kept)
    if want("s_bar"):
        kept = [x for x in kept if x in fields]
        stage = transform(stage, n, [derivative(own(f"s_{j}", i), own(f"t_{j}", i), j) for i in every for j in AXES], keep=kept, **options)
        stage = stage.withColumns({own("s_bar", i): c(own("s_x", i)) + c(own("s_y", i)) + c(own("s_z", i)) for i in every})
    return stage.select(*KEYS, *fields)


def divergence_metrics(fields: DataFrame, div: str, gradient: list[str], rms_max: float = 1e-4, max_max: float = 1e-3) -> DataFrame:
    """For each snapshot: rms and largest divergence relative to those of the gradient, and whether both are small."""
    return divergences(fields, [("", div, gradient)], rms_max, max_max).drop("name")


def divergences(fields: DataFrame, named: list[tuple[str, str, list[str]]], rms_max: float = 1e-4, max_max: float = 1e-3) -> DataFrame:
    """divergence_metrics() of several velocities, (name, divergence, gradient) each, from one scan: a row a snapshot and name."""
    aggs, rows = [F.count(F.lit(1)).alias("n_points")], []
    for i, (name, div, gradient) in enumerate(named):
        squares = sum((wide(g) * wide(g) for g in gradient), F.lit(0.0))
        aggs += [F.sqrt(F.avg(wide(div) * wide(div))).alias(f"dr{i}"), F.max(F.abs(wide(div))).alias(f"dm{i}")]
        aggs += [F.sqrt(F.sum(squares) / (F.count(F.lit(1)) * len(gradient))).alias(f"gr{i}"), F.max(F.greatest(*(F.abs(wide(g)) for g in gradient))).alias(f"gm{i}")]
        rows.append(F.struct(F.lit(name).alias("name"), *(F.col(f"{k}{i}").alias(a) for k, a in (("dr", "div_rms"), ("dm", "div_max"), ("gr", "grad_rms"), ("gm", "grad_max")))))
    out = fields.groupBy("time_index").agg(*aggs).select("time_index", "n_points", F.inline(F.array(*rows)))
    out = out.withColumn("relative_rms", F.col("div_rms") / F.greatest("grad_rms", F.lit(TINY))).withColumn("relative_max", F.col("div_max") / F.greatest("grad_max", F.lit(TINY)))
    return out.withColumn("passed", (F.col("relative_rms") <= rms_max) & (F.col("relative_max") <= max_max))


def with_regime(fields: DataFrame, keys: list[str], eps_abs: float = 0.0, eps_rel: float = 1e-3) -> DataFrame:
    """fields with regime: thresholds are eps_rel of each work's rms over the whole snapshot, eps_abs at least.

    The thresholds are one row for each snapshot, joined back; Spark broadcasts them as long as they are small.
    """
    limit = lambda w: F.greatest(F.lit(eps_abs), F.lit(eps_rel) * F.sqrt(F.avg(wide(w) * wide(w))))
    limits = fields.groupBy(*keys).agg(limit("work_full").alias("eps_full"), limit("work_resolved").alias("eps_resolved"))
    joined = fields.join(limits, keys)
    return joined.withColumn("regime", regime(wide("work_full"), wide("work_resolved"), F.col("eps_full"), F.col("eps_resolved"))).drop("eps_full", "eps_resolved")
