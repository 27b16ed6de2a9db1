"""Fields and reports on analytic velocities against golden values that were computed apart, in float64 numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelflux.operators import spectral
from voxelflux.plans import energy, reports
from voxelflux.sources import analytic

N = 16
GOLDEN = {
    1.0: {"joint": 0.20239526445, "pi": -36.7394125256, "rms_pi": 0.02295252555, "rms_s": 0.03132154793, "asym": -0.39078850449, "p99": 0.06520232931, "max": 0.07431734003, "regimes": [0.00390625, 0.45703125, 0.0703125, 0.02734375, 0.44140625]},
    2.0: {"joint": 0.09125709840, "pi": -58.2540203137, "rms_pi": 0.03053939124, "rms_s": 0.04695249161, "asym": -0.46569929369, "p99": 0.08080182552, "max": 0.08438020229, "regimes": [0.0078125, 0.41796875, 0.203125, 0.03125, 0.33984375]},
}


@pytest.fixture(scope="module")
def fields(spark):
    points = analytic.velocity(spark, N, analytic.triad(N))
    return {s: energy.energy_fields(points, N, sigma=s).cache() for s in GOLDEN}


@pytest.mark.parametrize("sigma", GOLDEN)
def test_triad_golden(fields, sigma):
    g, f = GOLDEN[sigma], fields[sigma]
    qa = reports.budget_qa(f).first()
    assert qa.point_count == N**3
    assert qa.joint_rms == pytest.approx(g["joint"], rel=1e-9)
    assert qa.total_pi == pytest.approx(g["pi"], rel=1e-9)
    assert qa.total_work_full == pytest.approx(-g["pi"], rel=1e-9)
    assert abs(qa.total_s_bar) < 1e-10 and abs(qa.total_work_resolved) < 1e-10
    assert qa.relative_residual < 1e-13 and qa.passed
    weak = reports.weak_asymmetry(f).first()
    assert weak.asymmetry_index == pytest.approx(g["asym"], rel=1e-9)
    assert weak.abs_p99 == pytest.approx(g["p99"], rel=1e-9) and weak.abs_max == pytest.approx(g["max"], rel=1e-9)
    assert weak.passed
    rms = f.agg(F.sqrt(F.avg(F.col("pi") ** 2)), F.sqrt(F.avg(F.col("s_bar") ** 2))).first()
    assert rms[0] == pytest.approx(g["rms_pi"], rel=1e-9) and rms[1] == pytest.approx(g["rms_s"], rel=1e-9)


@pytest.mark.parametrize("sigma", GOLDEN)
def test_triad_regimes(fields, sigma):
    coded = energy.with_regime(fields[sigma], ["time_index"])
    seen = {r.regime: r["count"] / N**3 for r in coded.groupBy("regime").count().collect()}
    assert [seen.get(i, 0) for i in range(5)] == GOLDEN[sigma]["regimes"]


def test_divergence_gate(spark, fields):
    good = energy.divergence_metrics(fields[1.0], "div", energy.gradient_names("g")).first()
    assert good.passed and good.relative_rms < 1e-13
    bar = energy.divergence_metrics(fields[1.0], "div_bar", energy.gradient_names("h")).first()
    assert bar.passed
    squeezed = energy.gradients(analytic.velocity(spark, N, analytic.compressible(N)), N).withColumn("div", energy.divergence("g"))
    assert not energy.divergence_metrics(squeezed, "div", energy.gradient_names("g")).first().passed


def test_abc_and_taylor_green_have_no_net_flux(spark):
    for field, joint in ((analytic.abc(N), 0.29685681976), (analytic.taylor_green(N), 0.03928764499)):
        qa = reports.budget_qa(energy.energy_fields(analytic.velocity(spark, N, field), N, sigma=2.0)).first()
        assert qa.joint_rms == pytest.approx(joint, rel=1e-9) and abs(qa.total_pi) < 1e-10 and qa.identity_passed


def test_float_transforms_are_close(spark, fields):
    points = analytic.velocity(spark, N, analytic.triad(N), "float")
    single = energy.energy_fields(points, N, sigma=1.0, kind="float").select("z", "y", "x", F.col("pi").alias("single"))
    both = fields[1.0].join(single, ["z", "y", "x"])
    assert both.count() == N**3
    assert both.agg(F.max(F.abs(F.col("pi") - F.col("single")))).first()[0] < 3e-6


def test_line_derivative_and_constant(spark):
    n = 64
    line = [math.sin(3 * 2 * math.pi * i / n) for i in range(n)]
    df = spark.createDataFrame([(line, [1.0] * n)], "a array<double>, b array<double>")
    row = df.select(spectral.line(F.col("a"), "d").alias("d"), spectral.line(F.col("b"), "g", sigma=2.0).alias("g")).first()
    assert np.allclose(row.d, [3 * math.cos(3 * 2 * math.pi * i / n) for i in range(n)], atol=1e-12)
    assert np.allclose(row.g, 1.0)


def test_harmonic_gradient_on_all_axes(spark):
    n = 24
    a = {c: F.col(c) * (2 * math.pi / n) for c in "xyz"}
    points = analytic.grid(spark, n).withColumn("f", F.sin(a["x"]) + 0.5 * F.cos(2 * a["y"]) + 0.25 * F.sin(3 * a["z"]))
    out = spectral.transform(points, n, [spectral.derivative(f"d{c}", "f", c) for c in "xyz"])
    worst = out.agg(*(F.max(F.abs(F.col(f"d{c}") - e)) for c, e in (("x", F.cos(a["x"])), ("y", -F.sin(2 * a["y"])), ("z", 0.75 * F.cos(3 * a["z"]))))).first()
    assert max(worst) < 1e-12


def test_incomplete_plane_is_refused(spark):
    points = analytic.velocity(spark, 4, analytic.compressible(4))
    with pytest.raises(Exception, match="plane"):
        energy.gradients(points.where("not (x = 1 and y = 1 and z = 1)"), 4).collect()
    with pytest.raises(Exception, match="plane"):
        energy.gradients(points.unionByName(points.limit(1)), 4).collect()


def test_crop_filter_does_not_cross_transform(spark):
    points = analytic.velocity(spark, 8, analytic.triad(8))
    whole = energy.gradients(points, 8)
    cut = {(r.z, r.y, r.x): r.g_xx for r in whole.where("x = 3").collect()}
    full = {(r.z, r.y, r.x): r.g_xx for r in whole.collect() if r.x == 3}
    assert cut == full and len(cut) == 64


def test_wanted_fields_are_the_same_with_fewer_exchanges(spark, fields):
    points = analytic.velocity(spark, N, analytic.triad(N))
    full = fields[2.0]
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    for wanted, most in ((["div"], 2), (["g_xy", "bx"], 2), (["work_resolved"], 2), (["work_full"], 4), (["pi"], 4), (["tau_xy", "uz"], 4), (["t_x"], 4), (["s_bar"], 6), (["work_full", "s_bar", "div_bar"], 6)):
        out = energy.energy_fields(points, N, sigma=2.0, wanted=wanted)
        assert out.columns == ["time_index", "z", "y", "x", *(f for f in energy.FIELDS if f in wanted)] and exchanges(out) <= most
        old = full.select("z", "y", "x", *(F.col(w).alias(f"o_{w}") for w in wanted))
        worst = out.join(old, ["z", "y", "x"]).agg(F.count(F.lit(1)), *(F.max(F.abs(F.col(w) - F.col(f"o_{w}"))) for w in wanted)).first()
        assert worst[0] == N**3 and max(worst[1:]) < 1e-12, wanted
    with pytest.raises(ValueError, match="unknown"):
        energy.energy_fields(points, N, sigma=2.0, wanted=["speed"])


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_all_filter_widths_share_the_exchanges_of_one(spark, fields):
    points = analytic.velocity(spark, N, analytic.triad(N))
    widths = [1.0, 2.0, 3.5]
    batch = energy.energy_batch(points, N, widths)
    assert exchanges(batch) == exchanges(energy.energy_fields(points, N, sigma=4.0)) == 6
    assert exchanges(energy.filtered_batch(points, N, widths)) == 2
    batch = batch.cache()
    for i, sigma in enumerate(widths):
        one = energy.of_sigma(batch, i)
        assert one.columns == ["time_index", "z", "y", "x", *energy.FIELDS]
        old = fields[sigma] if sigma in fields else energy.energy_fields(points, N, sigma=sigma)
        old = old.select("z", "y", "x", *(F.col(f).alias(f"o_{f}") for f in energy.FIELDS))
        worst = one.join(old, ["z", "y", "x"]).agg(F.count(F.lit(1)), *(F.max(F.abs(F.col(f) - F.col(f"o_{f}"))) for f in energy.FIELDS)).first()
        assert worst[0] == N**3 and max(worst[1:]) < 1e-12
    batch.unpersist()


def test_a_ready_filtered_velocity_is_not_filtered_again(spark, fields, monkeypatch, tmp_path):
    points = analytic.velocity(spark, N, analytic.triad(N))
    fields[2.0].select("time_index", "z", "y", "x", *energy.U, *energy.UB).write.parquet(str(tmp_path / "held"))
    held = spark.read.parquet(str(tmp_path / "held"))
    planned = []
    real = energy.transform
    monkeypatch.setattr(energy, "transform", lambda p, n, wanted, **more: planned.append(list(wanted)) or real(p, n, wanted, **more))
    for wanted, saved in ((["s_bar"], 2), (["pi", "div_bar"], 0), (energy.ENERGY, 0), (["tau_xy", "bx"], 2)):
        planned.clear()
        fresh = energy.energy_fields(held.drop(*energy.UB), N, sigma=2.0, wanted=wanted)
        of_u = lambda: [t for stage in planned for t in stage if t.source in energy.U and spectral.FILTER in t.x + t.y + t.z]
        assert of_u()
        planned.clear()
        reused = energy.energy_fields(held, N, sigma=2.0, wanted=wanted, ready=True)
        assert not of_u() and exchanges(fresh) - exchanges(reused) == saved
        old = fields[2.0].select("z", "y", "x", *(F.col(w).alias(f"o_{w}") for w in wanted))
        worst = reused.join(old, ["z", "y", "x"]).agg(F.count(F.lit(1)), *(F.max(F.abs(F.col(w) - F.col(f"o_{w}"))) for w in wanted)).first()
        assert worst[0] == N**3 and max(worst[1:]) < 1e-12, wanted


def test_odd_and_even_planes_agree_with_axis_by_axis():
    rng = np.random.default_rng(1)
    for n in (8, 9, 2, 1):
        values = rng.normal(size=(3, n, n))
        wanted = [(a, b, s) for a in ("", "d", "g", "dg") for b in ("", "d", "g", "dg") for s in (1.0, 2.5)]
        for (first, second, sigma), got in zip(wanted, spectral.over_planes(values, wanted, 3.0), strict=True):
            assert np.allclose(got, spectral.along(spectral.along(values, 2, second, 3.0, sigma), 1, first, 3.0, sigma), atol=1e-12)


def test_lines_instead_of_planes_change_nothing(spark, fields):
    """A plane that is larger than what a task may hold is transformed by lines: three exchanges a stage, the same fields."""
    points = analytic.velocity(spark, N, analytic.triad(N))
    batch = energy.energy_batch(points, N, [1.0, 2.0], wanted=[*energy.ENERGY, "div_bar", "g_xy"], plane_points=N * N - 1)
    assert exchanges(batch) == 9
    batch = batch.cache()
    for i, sigma in enumerate((1.0, 2.0)):
        one = energy.of_sigma(batch, i)
        old = fields[sigma].select("z", "y", "x", *(F.col(f).alias(f"o_{f}") for f in (*energy.ENERGY, "div_bar", "g_xy")))
        worst = one.join(old, ["z", "y", "x"]).agg(F.count(F.lit(1)), *(F.max(F.abs(F.col(f) - F.col(f"o_{f}"))) for f in (*energy.ENERGY, "div_bar", "g_xy"))).first()
        assert worst[0] == N**3 and max(worst[1:]) < 1e-12
    assert reports.budget_qa(energy.of_sigma(batch, 0)).first().total_pi == pytest.approx(GOLDEN[1.0]["pi"], rel=1e-9)
    batch.unpersist()
    one = spectral.transform(points, N, [spectral.derivative("d", "ux", "y"), spectral.gaussian("f", "ux")], keep=["uz"], kind="float", plane_points=1)
    assert one.columns[-3:] == ["uz", "d", "f"] and dict(one.dtypes)["d"] == "float" and one.count() == N**3
    with pytest.raises(Exception, match="line"):
        spectral.transform(points.where("not (x = 1 and y = 1 and z = 1)"), N, [spectral.derivative("d", "ux", "y")], plane_points=1).collect()
