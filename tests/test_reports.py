import pytest

from voxelflux.functions import fields as fx
from voxelflux.operators import aggregates
from voxelflux.plans import energy, reports

PI = [1.0, 2.0, -3.0, 4.0, 5.0, -6.0, 7.0, -8.0]
WF = [1.0] * 4 + [-1.0] * 4
WR = [1.0, 1.0, -1.0, -1.0] * 2


def tiny(spark, pi=PI, wf=WF, wr=WR):
    return spark.createDataFrame(list(zip(pi, wf, wr, strict=True)), "pi double, work_full double, work_resolved double")


def test_quadrants(spark):
    rows = {r.quadrant: r for r in reports.quadrant_flux(tiny(spark)).collect()}
    assert [rows[q].n for q in fx.QUADRANTS] == [2, 2, 2, 2] and rows["Q1"].pi_sum == 3.0
    assert sum(r.stored_cq for r in rows.values()) == pytest.approx(0.25)
    assert rows["Q1"].les_cq == -rows["Q1"].stored_cq
    assert reports.quadrant_closure(tiny(spark)).first().passed


def test_zero_is_nonnegative_and_empty_quadrants_show(spark):
    rows = {r.quadrant: r for r in reports.quadrant_flux(tiny(spark, [1.0, 2.0], [0.0, -0.0], [-0.0, 0.0])).collect()}
    assert rows["Q1"].n == 2 and len(rows) == 4
    assert rows["Q4"].n == 0 and rows["Q4"].conditional_mean is None and rows["Q4"].stored_cq == 0.0


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
def test_values_that_are_not_finite_end_reports(spark, bad):
    df = tiny(spark, [bad, 1.0], [1.0, 1.0], [1.0, 1.0])
    for report in (reports.quadrant_flux, reports.weak_asymmetry):
        with pytest.raises(Exception, match="not finite"):
            report(df).collect()


def test_weak_asymmetry(spark):
    w = reports.weak_asymmetry(tiny(spark)).first()
    assert (w.positive_sum, w.positive_count, w.negative_sum, w.negative_count, w.zero_count) == (19.0, 5, -17.0, 3, 0)
    assert w.pi_mean == 0.25 and w.abs_max == 8.0 and w.abs_p99 == pytest.approx(7.93) and w.passed
    zero = reports.weak_asymmetry(tiny(spark, [0.0] * 3, [1.0] * 3, [1.0] * 3)).first()
    assert zero.asymmetry_index == 0.0 and zero.ratio_p99 == 0.0 and zero.zero_count == 3


@pytest.mark.parametrize("bins", [3, 50, 4096])
def test_exact_percentile(spark, bins, monkeypatch):
    import numpy as np

    monkeypatch.setattr(aggregates, "BINS", bins)
    values = np.abs(np.random.default_rng(42).standard_normal(10_003)).astype(np.float32)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for share in (0.0, 0.5, 0.99, 1.0):
        assert aggregates.exact_percentile(df, df.v, share) == pytest.approx(float(np.percentile(values.astype(float), share * 100)), rel=1e-12)
    ties = spark.createDataFrame([(1.0,)] * 500 + [(2.0,)] * 3, "v double")
    assert aggregates.exact_percentile(ties, ties.v, 0.5) == 1.0
    assert aggregates.exact_percentile(ties.where("v > 5"), ties.v, 0.5) is None


def test_percentiles_of_groups_and_of_two_heaps(spark, monkeypatch):
    """Ranks in different bins, values of very different size, groups of one value and null keys."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(7)
    rows = [("two", float(v)) for v in np.concatenate([rng.random(3000), 1e6 + rng.random(3000)])]
    rows += [("wide", float(v)) for v in 10.0 ** rng.uniform(-300, 300, 2001)] + [("huge", v) for v in (-1.7e308, 1.7e308, 0.0)] + [("one", 5.0)] * 7 + [(None, 1.0), (None, 2.0)] + [("none", None)]
    rows += [("near", float(np.nextafter(1.0, 2.0))), ("near", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = {"p50": 0.5, "p99": 0.99}
    passes = []
    real = aggregates._narrowed
    monkeypatch.setattr(aggregates, "_narrowed", lambda *args: passes.append(1) or real(*args))
    monkeypatch.setattr(spark, "createDataFrame", lambda *a, **k: pytest.fail("an interval went through the driver"))
    found = aggregates.percentiles(df, ["k"], F.col("v"), shares)
    got = {r.k: r for r in found.collect()}
    assert set(got) == {"two", "wide", "huge", "one", None, "near"} and found.columns == ["k", "p50", "p99"]
    for k, row in got.items():
        own = sorted(x for name, x in rows if name == k and x is not None)
        for name, share in shares.items():
            rank = (len(own) - 1) * share
            lo, hi = own[int(rank)], own[min(int(rank) + 1, len(own) - 1)]
            assert row[name] == pytest.approx(lo + (hi - lo) * (rank - int(rank)), rel=1e-12)
    assert "BroadcastNestedLoop" not in found._jdf.queryExecution().toString() and len(passes) < 12
    limits = {r.k: r.color_limit for r in aggregates.symmetric_limits(df.withColumn("v", -F.col("v")), ["k"], F.col("v"), 100).collect()}
    assert limits["two"] == pytest.approx(max(v for k, v in rows if k == "two")) and limits["one"] == 5.0


def test_percentiles_move_each_value_once(spark, monkeypatch):
    """Small groups reach an exchange with a row a value, whatever the number of shares; large ones with fewer rows than values."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    shares = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    rows = [(g, float(v)) for g in range(40) for v in rng.random(200)] + [(None, float(v)) for v in 10.0 ** rng.uniform(-30, 30, 3000)] + [(-1, float(v)) for v in rng.random(5000)] + [(-2, 4.0)] * 3000
    df = spark.createDataFrame(rows, "k long, v double").repartition(3).cache()

    def rows_in_plan(found):
        plan, out, todo = found._jdf.queryExecution().executedPlan(), [], []
        todo.append(plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan)
        while todo:
            node = todo.pop()
            if "QueryStage" in node.nodeName():
                node = node.plan()
            if "Exchange" in node.nodeName() and "Broadcast" not in node.nodeName():
                out.append(node.metrics().apply("shuffleRecordsWritten").value())
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return out

    few = aggregates.percentiles(df.where("k >= 0"), ["k"], F.col("v"), shares)
    few._jdf.collectToPython()
    assert 8000 in rows_in_plan(few) and sum(rows_in_plan(few)) < 2 * 8000
    monkeypatch.setattr(aggregates, "BINS", 64)
    moved = []
    real = aggregates._narrowed

    def narrowed(*args):
        out = real(*args)
        out._jdf.collectToPython()
        moved.append(max(rows_in_plan(out)))
        return out

    monkeypatch.setattr(aggregates, "_narrowed", narrowed)
    got = {r.k: r for r in aggregates.percentiles(df, ["k"], F.col("v"), shares).collect()}
    assert moved and max(moved) < 8000 / 4 and len(got) == 43
    for k, row in got.items():
        own = [v for g, v in rows if g == k]
        for name, share in shares.items():
            assert row[name] == pytest.approx(float(np.percentile(own, share * 100)), rel=1e-9)


def budget(spark, s_bar, pi):
    rows = [(0.01 * i - pi + s, 0.01 * i, pi, s) for i, s in enumerate(s_bar)]
    return spark.createDataFrame(rows, "work_full double, work_resolved double, pi double, s_bar double")


def test_budget_gates(spark):
    even = [(-1.0 if i % 2 == 0 else 1.0) for i in range(64)]
    ok = reports.budget_qa(budget(spark, even, 0.25)).first()
    assert ok.passed and ok.s_bar_vs_pi == 0.0
    bad = reports.budget_qa(budget(spark, [1.0] * 64, 0.25))
    assert not bad.first().net_passed and bad.first().identity_passed
    assert reports.reclassified(bad, 1e-4, 10.0).first().passed
    none = reports.budget_qa(budget(spark, [1.0] * 64, 0.0)).first()
    assert none.s_bar_vs_pi is None and not none.passed


def test_regime_rule(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(2.0, 2.0), (2.0, -2.0), (-2.0, 2.0), (-2.0, -2.0), (0.0, 1.0), (0.1, 1.0)], "f double, r double")
    got = [r[0] for r in df.select(fx.regime(F.col("f"), F.col("r"), F.lit(0.1), F.lit(0.1))).collect()]
    assert got == [1, 2, 3, 4, 0, 0]


def test_dense_histogram_and_limit(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1,), (1,), (3,)], "r int")
    rows = {r.regime: r.n for r in aggregates.dense_counts(df, F.col("r"), "regime", list(fx.REGIMES)).collect()}
    assert rows == {0: 0, 1: 2, 2: 0, 3: 1, 4: 0}
    import numpy as np

    v = spark.createDataFrame([(float(x),) for x in [*np.linspace(-2, 2, 10_000), 1000.0, float("nan")]], "v double")
    assert 1.9 < aggregates.symmetric_limit(v, v.v, 99) < 2.0 and aggregates.symmetric_limit(v, v.v, 100) == 1000.0
    zero = spark.createDataFrame([(0.0,)], "v double")
    assert aggregates.symmetric_limit(zero, zero.v) == 1.0
    with pytest.raises(ValueError, match="percent"):
        aggregates.symmetric_limit(zero, zero.v, 0)


def test_tags_of_a_column(spark):
    from pyspark.sql import functions as F

    values = [2.0, 2.5, 1e-5, 100.0, 0.00012345678912, 123456789.0, -3.25, 1e8, 0.1 + 0.2, 9.99999999, 1e-4, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.t for r in df.select(fx.tag(F.col("v")).alias("t")).collect()] == [fx.sigma_tag(v) for v in values]


def test_names_and_coordinates(spark):
    from pyspark.sql import functions as F

    assert [fx.sigma_tag(s) for s in (2.0, 2.5, 1e-5)] == ["2", "2p5", "1em05"]
    row = spark.range(1).select(fx.coordinate(F.lit(4), 16, 8.0), fx.physical_time(F.lit(3)), fx.tile_key(F.lit(128), F.lit(0), F.lit(64)), fx.scientific(F.lit(None).cast("double")), fx.symlog(F.lit(-1.0), 1.0)).first()
    assert list(row)[:4] == [2.0, 0.004, "x0128_y0000_z0064", "undefined"] and row[4] == pytest.approx(-0.6931471805599453)
    for bad in (fx.coordinate(F.lit(16), 16, 8.0), fx.physical_time(F.lit(0))):
        with pytest.raises(Exception, match="range|starts"):
            spark.range(1).select(bad).collect()
    assert energy.gradient_names("g")[0] == "g_xx"
