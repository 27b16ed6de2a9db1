import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from voxelflux.plans import commit, energy, reports
from voxelflux.sources import analytic
from voxelflux.streaming import bricks


@pytest.fixture()
def results(spark, tmp_path):
    return commit.Results(spark, tmp_path / "results")


def small(spark):
    return analytic.velocity(spark, 4, analytic.triad(4)).withColumn("pi", F.col("ux"))


def test_commit_chain_and_reports(spark, results):
    results.stage(small(spark), 3, 2.5, {"a": 1}, "inputhash")
    assert results.complete() == []
    path = results.finalize(3, 2.5)
    assert path.name == "t000003_sigma_2p5" and results.complete() == [path] and results.open(path).count() == 64
    calls = []

    def compute(df):
        calls.append(1)
        return {"n": df.count()}

    for _ in range(2):
        assert results.ensure_report(path, "weak.json", compute, {"version": 1})["n"] == 64
    assert len(calls) == 1 and results.report(path, "weak.json") and results.report(path, "qa.json")
    results.ensure_report(path, "weak.json", compute, {"version": 2})
    assert len(calls) == 2
    (path / "weak.json").write_text("{}")
    assert results.report(path, "weak.json") is None


def test_replace_and_refuse(spark, results):
    results.stage(small(spark), 1, 1.0, {}, "h")
    first = results.finalize(1, 1.0)
    results.stage(small(spark).where("x < 2"), 1, 1.0, {}, "h")
    assert results.open(results.finalize(1, 1.0)).count() == 32
    (first / commit.MARKER).unlink()
    (first / "manifest.json").unlink()  # no crash of a commit leaves this: with a manifest that holds, recover() would go on
    results.stage(small(spark), 1, 1.0, {}, "h")
    with pytest.raises(RuntimeError, match="not replaced"):
        results.finalize(1, 1.0)
    with pytest.raises(RuntimeError, match="not complete"):
        results.open(first)


def test_bad_values_and_lock(spark, results, tmp_path):
    with pytest.raises(ValueError, match="pi"):
        results.stage(small(spark).withColumn("pi", F.lit(float("nan"))), 1, 1.0, {}, "h")
    with pytest.raises(FileNotFoundError):
        results.finalize(1, 1.0)
    with commit.lock(tmp_path / "l"), pytest.raises(FileExistsError), commit.lock(tmp_path / "l"):
        pass
    with pytest.raises(ValueError, match="child"):
        commit.remove_child(tmp_path, tmp_path / "a" / "b")
    with pytest.raises(RuntimeError, match="bytes"):
        commit.enough_space(tmp_path, 10**18, 0)


def test_a_crash_at_any_step_of_a_replacement_is_mended(spark, results, monkeypatch):
    for fail_at, says in ((1, "back"), (2, "forward"), (3, "forward")):
        results.stage(small(spark), fail_at, 1.0, {}, "h")
        path = results.finalize(fail_at, 1.0)
        results.stage(small(spark).where("x < 2"), fail_at, 1.0, {}, "h")
        steps = []

        def crash(step, real):
            def run(*args, **more):
                if args and str(args[0]).endswith(".partial"):
                    return real(*args, **more)
                steps.append(step)
                if len(steps) == fail_at + 1:  # noqa: B023
                    raise KeyboardInterrupt
                return real(*args, **more)

            return run

        with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
            m.setattr(commit.os, "replace", crash("replace", commit.os.replace))
            m.setattr(commit.Results, "_mark", staticmethod(crash("mark", commit.Results._mark)))
            m.setattr(commit.shutil, "rmtree", crash("rmtree", commit.shutil.rmtree))
            results.finalize(fail_at, 1.0)
        assert results.recover(fail_at, 1.0) == says and results.recover(fail_at, 1.0) == "none"
        assert results.open(path).count() == (64 if says == "back" else 32) and results.report(path, "qa.json") is not None


def test_a_crash_at_any_step_of_a_first_commit_is_mended(spark, results, monkeypatch):
    for fail_at in (1, 2):
        results.stage(small(spark), fail_at, 1.0, {}, "h")
        steps = []

        def crash(real):
            def run(*args, **more):
                if args and str(args[0]).endswith(".partial"):
                    return real(*args, **more)
                steps.append(1)
                if len(steps) == fail_at:  # noqa: B023
                    raise KeyboardInterrupt
                return real(*args, **more)

            return run

        with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
            m.setattr(commit.os, "replace", crash(commit.os.replace))
            m.setattr(commit.Results, "_mark", staticmethod(crash(commit.Results._mark)))
            results.finalize(fail_at, 1.0)
        if fail_at == 1:  # still staged: committed again
            assert results.recover(fail_at, 1.0) == "none" and results.finalize(fail_at, 1.0)
        else:  # moved, without its marker
            assert results.recover(fail_at, 1.0) == "forward"
        path = results.path(fail_at, 1.0)
        assert results.recover(fail_at, 1.0) == "none" and results.open(path).count() == 64 and results.report(path, "qa.json") is not None


def test_presence_types_and_damage(spark, tmp_path):
    strict = commit.Results(spark, tmp_path / "r", (("pi", "double"), ("regime", "tinyint")))
    strict.stage(small(spark), 1, 1.0, {}, "h")
    with pytest.raises(ValueError, match="regime"):
        strict.finalize(1, 1.0)
    strict.stage(small(spark).withColumn("regime", F.lit(1).cast("tinyint")), 1, 1.0, {}, "h", crop=small(spark).where("x = 1"))
    staged = strict.staging(1, 1.0)
    small(spark).where("x = 2").write.mode("overwrite").parquet(str(staged / "crop"))
    with pytest.raises(OSError, match="not what was staged"):
        strict.finalize(1, 1.0)
    with pytest.raises(ValueError, match="mount"):
        commit.Results(spark, "hdfs://x/y")


def test_locks_left_behind_are_taken_over(tmp_path):
    import subprocess

    gone = subprocess.Popen(["true"])
    gone.wait()
    (tmp_path / "l").write_text(json.dumps({"pid": gone.pid, "host": commit.socket.gethostname()}))
    with commit.lock(tmp_path / "l"):
        pass
    (tmp_path / "l").write_text(json.dumps({"pid": 1, "host": "elsewhere"}))
    with pytest.raises(FileExistsError), commit.lock(tmp_path / "l"):
        pass


def test_of_many_that_see_a_dead_holder_one_takes_over(tmp_path):
    import subprocess
    import threading

    gone = subprocess.Popen(["true"])
    gone.wait()
    took, done = [], threading.Event()

    def take(i):
        try:
            with commit.lock(tmp_path / "l"):
                took.append(i)
                done.wait(20)
        except FileExistsError:
            pass

    (tmp_path / "l").write_text(json.dumps({"pid": gone.pid, "host": commit.socket.gethostname()}))
    takers = [threading.Thread(target=take, args=(i,)) for i in range(12)]
    for t in takers:
        t.start()
    for t in takers[:]:
        t.join(0.2)
    done.set()
    for t in takers:
        t.join()
    assert len(took) == 1


def test_upgrade_adds_regime(spark, results):
    fields = small(spark).withColumn("work_full", F.col("uy")).withColumn("work_resolved", F.col("uz"))
    results.stage(fields, 1, 1.0, {}, "h")
    path = results.finalize(1, 1.0)
    manifest = json.loads((path / "manifest.json").read_text())
    commit.atomic_json(path / "manifest.json", manifest | {"schema_version": 4})
    path = results.upgrade(1, 1.0, lambda df: energy.with_regime(df, ["time_index"]))
    assert "regime" in results.open(path).columns and results.upgrade(1, 1.0, None) == path


def test_run_record_expires(tmp_path):
    now = datetime(2026, 1, 1, tzinfo=timezone.utc)
    assert commit.run_record(tmp_path / "r.json", 72, now)["remaining_hours"] == 72
    assert commit.run_record(tmp_path / "r.json", 72, now + timedelta(hours=70))["remaining_hours"] == 2
    with pytest.raises(RuntimeError, match="expired"):
        commit.run_record(tmp_path / "r.json", 72, now + timedelta(hours=72))


def test_streamed_tiles_count_once(spark, tmp_path):
    pts = analytic.velocity(spark, 8, analytic.triad(8))
    tiles = bricks.tile_moments(pts, F.concat_ws("_", F.floor(F.col("z") / 4)), "ux")
    tiles.coalesce(1).write.parquet(str(tmp_path / "in"))
    tiles.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    query = bricks.running(bricks.arriving(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("moments").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    row = spark.table("moments").first()
    stats = reports.snapshot_statistics(pts, ["ux"]).first()
    assert row.n_tiles == 2 and row.n == 512 and row.rms == pytest.approx(stats.rms)
