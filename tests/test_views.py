import os

import pytest
from pyspark.sql import functions as F

from voxelflux.operators import ledger
from voxelflux.plans import reports, views
from voxelflux.sources import analytic, secret


def test_token(monkeypatch, tmp_path):
    monkeypatch.delenv("VF_TOKEN", raising=False)
    file = tmp_path / "token"
    assert secret.token_source("VF_TOKEN", file) is None
    with pytest.raises(RuntimeError, match="no token"):
        secret.get_token("VF_TOKEN", file)
    file.write_text(" abc \n")
    os.chmod(file, 0o644)
    with pytest.raises(PermissionError):
        secret.get_token("VF_TOKEN", file)
    os.chmod(file, 0o600)
    assert secret.get_token("VF_TOKEN", file) == "abc"
    monkeypatch.setenv("VF_TOKEN", "xyz")
    assert secret.token_source("VF_TOKEN", file) == "environment" and secret.get_token("VF_TOKEN", file) == "xyz"
    monkeypatch.setenv("VF_TOKEN", "  ")
    with pytest.raises(RuntimeError, match="empty"):
        secret.get_token("VF_TOKEN")


def test_report_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0, 2.0), (-1.0, 3.0, -1.0, -5.0)], "work_full double, work_resolved double, pi double, s_bar double")
    qa = reports.budget_qa(df)
    assert [r.field for r in views.totals(qa).collect()] == ["s_bar", "pi", "work_resolved", "work_full"]
    assert [r.status for r in views.gates(qa, 1e-4, 1e-2).collect()] == ["pass", "fail"]
    rows = views.signs(reports.weak_asymmetry(df)).collect()
    assert [(r.part, r.total, r.n) for r in rows] == [("positive", 2.0, 1), ("negative", -1.0, 1), ("net", 1.0, 0)]
    zero = reports.budget_qa(df.withColumn("pi", F.lit(0.0)))
    assert views.gates(zero, 1e-4, 1e-2).collect()[1].value == "undefined"


def test_slices(spark):
    points = analytic.velocity(spark, 8, analytic.triad(8)).withColumn("regime", F.lit(2))
    flat, limit = views.continuous_slice(points, 8, "z", 3, "ux", percent=100)
    assert flat.count() == 64 and limit == pytest.approx(flat.agg(F.max(F.abs("ux"))).first()[0])
    thin, _ = views.continuous_slice(points, 8, "z", 3, "ux", most=4)
    assert thin.count() == 16 and views.regime_slice(points, "x", 0).count() == 64
    for bad in ({"scale": "log"}, {"scale": "symlog"}, {"threshold": 1.0}):
        with pytest.raises(ValueError):
            views.continuous_slice(points, 8, "z", 3, "ux", **bad)


def test_snapshot_state(spark):
    rows = [("d", 1, 1, "planned", None), ("d", 1, 2, "validated", "h1"), ("d", 1, 3, None, None), ("d", 2, 1, "planned", None)]
    states = ledger.snapshots(spark.createDataFrame(rows, "dataset string, time_index int, seq long, status string, manifest_hash string"))
    got = {r.time_index: r for r in states.collect()}
    assert (got[1].status, got[1].manifest_hash, got[1].created, got[1].updated) == ("validated", "h1", 1, 3) and got[2].manifest_hash is None
    tiles = spark.createDataFrame([(1, "verified"), (1, "fetching")], "time_index int, status string")
    assert {(r.time_index, r.tiles, r.done) for r in ledger.with_progress(states, tiles, ["time_index"]).collect()} == {(1, 2, 1), (2, 0, 0)}
