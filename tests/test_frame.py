import inspect
import json
import shutil

import pytest
from pyspark.sql import functions as F

from voxelflux import __main__ as cli
from voxelflux.plans import commit, config, frame
from voxelflux.sources import analytic, bricks


def settings(tmp_path, **more):
    base = {"source": str(tmp_path / "points"), "state_root": str(tmp_path / "state"), "result_root": str(tmp_path / "results"), "sigmas": [1.0, 2.5], "net_max": 1e-2}
    path = tmp_path / "run.yaml"
    path.write_text(json.dumps(base | more))
    return path


def test_frame_end_to_end(spark, tmp_path):
    bricks.write(analytic.velocity(spark, 16, analytic.triad(16), "float"), str(tmp_path / "points"), brick=8)
    cfg = config.load(settings(tmp_path))
    done = frame.single_frame(spark, cfg, 1)
    assert [p.rsplit("/", 1)[1] for p in done] == ["t000001_sigma_1", "t000001_sigma_2p5"]
    results = commit.Results(spark, cfg.result_root)
    path = results.path(1, 1.0)
    weak = results.report(path, "weak.json")
    assert weak["pi_sum"] == pytest.approx(-36.7394125256, rel=1e-4) and weak["passed"]
    assert results.report(path, "cq.json")["passed"] and results.report(path, "sbar.json")["passed"]
    assert all("<svg" in (path / f"{n}.html").read_text() for n in ("cq", "weak", "sbar")) and "Q4" in (path / "cq.html").read_text()
    fields = results.open(path)
    assert fields.count() == 4096 and set(fields.columns) == {"time_index", "z", "y", "x", *frame.energy.ENERGY, "regime"} and dict(fields.dtypes)["pi"] == "float"
    crop = results.open_crop(path)
    assert crop.count() == 512 and set(frame.CROP_FIELDS) <= set(crop.columns) and len(frame.CROP_FIELDS) == 24
    assert (crop.agg({"x": "min"}).first()[0], crop.agg({"z": "max"}).first()[0]) == (4, 11)
    strict = config.load(settings(tmp_path, net_max=1e-30))
    assert not frame.report(spark, strict, path, "sbar")["passed"]
    assert frame.single_frame(spark, cfg, 1) == done
    assert cli.main(["status", "--config", str(settings(tmp_path))]) == 0
    assert cli.main(["qa-sbar", "--config", str(settings(tmp_path, net_max=1e-30)), "--sigma", "1.0"]) == 2
    assert cli.main(["slice", "--config", str(settings(tmp_path)), "--sigma", "1.0", "--axis", "w"]) == 1


def test_divergent_input_stops(spark, tmp_path):
    bricks.write(analytic.velocity(spark, 16, analytic.compressible(16), "float"), str(tmp_path / "points"), brick=8)
    with pytest.raises(RuntimeError, match="divergence"):
        frame.single_frame(spark, config.load(settings(tmp_path)), 1)
    with pytest.raises(Exception, match="tiles"):
        bad = analytic.velocity(spark, 16, analytic.triad(16), "float").where("not (x = 0 and y = 0 and z = 0)")
        bricks.write(bad, str(tmp_path / "bad"), brick=8)
        frame.validate(spark, config.load(settings(tmp_path, source=str(tmp_path / "bad"))), 1)


def test_config_is_closed(tmp_path):
    for bad in ({"colour": 1}, {"sigmas": [1.0, 1.0]}, {"sigmas": []}, {"tile": [5, 5, 5]}, {"crop_start": [10, 10, 10]}, {"source": "<username>/x"}, {"net_max": 0}, {"kind": "half"}):
        with pytest.raises(ValueError):
            config.load(settings(tmp_path, **bad))
    cfg = config.load(settings(tmp_path, sigmas=2, crop_start=[0, 0, 0]))
    assert cfg.sigmas == (2.0,) and cfg.physical_time(3) == pytest.approx(0.004)
    with pytest.raises(ValueError):
        cfg.physical_time(0)
    big = config.Config(grid=(1024,) * 3, tile=(128,) * 3, request=(512,) * 3, crop_start=(256,) * 3, crop_shape=(512,) * 3).checked().plan(1)
    assert (big["tiles"], big["requests"], big["result_bytes"] / 2**30, big["raw_bytes"] / 2**30) == (512, 8, 29.0, 12.0)


def test_cli_without_spark(tmp_path, capsys):
    path = settings(tmp_path)
    assert cli.main(["plan", "--config", str(path)]) == 0 and json.loads(capsys.readouterr().out)["tiles"] == 8
    assert cli.main(["doctor", "--config", str(path)]) == 2 and not json.loads(capsys.readouterr().out)["checks"]["source_there"]
    (tmp_path / "points").mkdir()
    assert cli.main(["doctor", "--config", str(path)]) == 0
    assert cli.main(["plan", "--config", str(tmp_path / "none.yaml")]) == 1
    assert "undefined" in frame.bars("x", {"a": 1.0, "b": None, "c": -2.0})


def test_upgrades_of_older_results(spark, tmp_path):
    bricks.write(analytic.velocity(spark, 16, analytic.triad(16), "float"), str(tmp_path / "points"), brick=8)
    cfg = config.load(settings(tmp_path, sigmas=[2.0]))
    frame.single_frame(spark, cfg, 1)
    results = commit.Results(spark, cfg.result_root)
    path = results.path(1, 2.0)
    new = sorted(results.open(path).select("z", "y", "x", "regime").collect())

    def older(version, drop):
        fields = results.open(path).drop(*drop)
        rows = fields.collect()
        spark.createDataFrame(rows, fields.schema).write.mode("overwrite").parquet(str(path / "fields"))
        manifest = json.loads((path / "manifest.json").read_text()) | {"schema_version": version}
        (path / commit.MARKER).write_text(commit.atomic_json(path / "manifest.json", manifest))

    for version, drop in ((4, ["regime"]), (3, ["regime", "s_bar"])):
        older(version, drop)
        assert cli.main(["upgrade-result", "--config", str(settings(tmp_path, sigmas=[2.0]))]) == 0
        assert sorted(results.open(path).select("z", "y", "x", "regime").collect()) == new
        assert json.loads((path / "manifest.json").read_text())["schema_version"] == commit.SCHEMA_VERSION and results.report(path, "weak.json")
    weak = results.report(path, "weak.json")
    first = {k: v for k, v in weak.items() if k not in ("abs_p99", "abs_max", "ratio_p99", "ratio_max")} | {"report_version": 1}
    manifest = json.loads((path / "manifest.json").read_text())
    manifest["reports"]["weak.json"] = commit.atomic_json(path / "weak.json", first)
    (path / commit.MARKER).write_text(commit.atomic_json(path / "manifest.json", manifest))
    assert frame.report(spark, cfg, path, "weak") == pytest.approx(weak)
    older(9, [])
    with pytest.raises(RuntimeError, match="not known"):
        frame.upgrade(spark, cfg, 1, 2.0)



SERVICE = """
import os
import numpy as np

def service(box, time_index):
    x0, y0, z0, nx, ny, nz = box
    if x0 and y0 and os.path.exists({stop!r}):
        raise OSError("the service is away")
    with open({log!r}, "a") as log:
        log.write(f"{{x0}},{{y0}},{{z0}}\\n")
    z, y, x = np.meshgrid(np.arange(z0, z0 + nz), np.arange(y0, y0 + ny), np.arange(x0, x0 + nx), indexing="ij")
    a = 2 * np.pi / 16
    return np.stack([np.sin(x * a) * np.cos(y * a), -np.cos(x * a) * np.sin(y * a), 0.0 * z], -1)
"""


def test_acquisition_goes_on_where_it_broke_off(spark, tmp_path):
    """The service is a field by formula that refuses one request as long as a file is there."""
    log, stop = tmp_path / "log", tmp_path / "stop"
    stop.touch()
    (tmp_path / "field_service.py").write_text(SERVICE.format(log=str(log), stop=str(stop)))
    spark.sparkContext.addPyFile(str(tmp_path / "field_service.py"))
    cfg = config.load(settings(tmp_path, source="field_service:service", request=[8, 8, 8], tile=[4, 4, 4], retries=1, backoff_seconds=0))
    with pytest.raises(Exception, match="away"):
        frame.acquire(spark, cfg, 1)
    before = frame.status(spark, cfg, 1)
    assert before["tiles"] == {"verified": 24, "failed": 8, "planned": 32, "total": 64} and len(log.read_text().split()) == 3
    stop.unlink()
    assert frame.points(spark, cfg, 1).count() == 4096
    assert frame.status(spark, cfg, 1)["tiles"] == {"verified": 64, "total": 64} and len(log.read_text().split()) == 8
    assert frame.acquire(spark, cfg, 1).count() == 4096 and len(log.read_text().split()) == 8
    damaged = tmp_path / "state" / "raw" / "t000001" / "tiles" / "request=x0008_y0000_z0000"
    spark.read.parquet(str(damaged)).where("x < 12").coalesce(1).write.parquet(str(tmp_path / "half"))
    spark.read.parquet(str(tmp_path / "half")).write.mode("overwrite").parquet(str(damaged))
    assert frame.acquire(spark, cfg, 1).count() == 4096 and len(log.read_text().split()) == 9
    assert frame.validate(spark, cfg, 1)["status"] == "validated"
    assert len(log.read_text().split()) == 9


def flip(path):
    with open(path, "r+b") as f:
        whole = f.read()
        for at in range(40, len(whole) // 2, 97):  # some of them hit values, others headers
            f.seek(at)
            f.write(bytes([whole[at] ^ 0x40]))


def test_flipped_bytes_make_acquisition_fail(spark, tmp_path, monkeypatch):
    """What stands on disk is compared before a request counts; earlier requests are not hashed again."""
    log, stop = tmp_path / "log", tmp_path / "stop"
    (tmp_path / "flipped_service.py").write_text(SERVICE.format(log=str(log), stop=str(stop)) + inspect.getsource(flip))
    spark.sparkContext.addPyFile(str(tmp_path / "flipped_service.py"))
    cfg = config.load(settings(tmp_path, source="flipped_service:service", request=[8, 8, 8], tile=[4, 4, 4], retries=1, backoff_seconds=0))
    real, hashed = frame.tile_sink.write, []
    with monkeypatch.context() as m:
        m.setattr(frame.tile_sink, "write", lambda *a, **more: real(*a, **more, probe="flipped_service:flip"))
        with pytest.raises(Exception, match="flipped|differs|OSError|Error"):
            frame.acquire(spark, cfg, 1)
    assert frame.status(spark, cfg, 1)["tiles"]["failed"] == 8
    assert not [p for p in (tmp_path / "state" / "raw").rglob("*.parquet") if "digests" not in str(p)]
    monkeypatch.setattr(frame.bricks, "checksums", lambda *a, **more: hashed.append(1) or real_checksums(*a, **more))
    assert frame.acquire(spark, cfg, 1).count() == 4096 and len(hashed) == 1
    assert frame.status(spark, cfg, 1)["tiles"] == {"verified": 64, "total": 64}


real_checksums = bricks.checksums


def test_a_token_reaches_the_service_and_no_message(spark, tmp_path, monkeypatch):
    (tmp_path / "token").write_text("s3cr3t-value\n")
    (tmp_path / "token").chmod(0o600)
    (tmp_path / "closed_service.py").write_text("def service(box, time_index, token):\n    raise OSError('refused ' + token)\n")
    spark.sparkContext.addPyFile(str(tmp_path / "closed_service.py"))
    cfg = config.load(settings(tmp_path, source="closed_service:service", request=[8, 8, 8], tile=[4, 4, 4], retries=1, backoff_seconds=0, token_file=str(tmp_path / "token")))
    with pytest.raises(Exception, match=r"refused \*\*\*") as caught:
        frame.acquire(spark, cfg, 1)
    assert "s3cr3t" not in str(caught.value)
    assert cli.main(["auth-status", "--config", str(settings(tmp_path, token_file=str(tmp_path / "token")))]) == 0
    assert cli.main(["auth-status", "--config", str(settings(tmp_path))]) == 2


def test_filtered_velocity_is_reused_and_damage_is_refused(spark, tmp_path):
    bricks.write(analytic.velocity(spark, 16, analytic.triad(16), "float"), str(tmp_path / "points"), brick=8)
    cfg = config.load(settings(tmp_path, keep_filtered=True))
    checked = frame.validate(spark, cfg, 1)["manifest_hash"]
    assert frame.trusted_input(cfg, 1) == checked and frame.trusted_input(cfg, 2) is None
    first = frame.process_batch(spark, cfg, 1, [1.0, 2.5], checked)
    assert not any(x["reuse"]["filtered_velocity"] for x in first.values()) and not list((tmp_path / "state" / "work").iterdir())
    results = frame._results(spark, cfg)
    for s in cfg.sigmas:
        results.finalize(1, s)
    again = frame.process_batch(spark, cfg, 1, [1.0, 2.5, 3.0], checked)
    assert [again[s]["reuse"]["filtered_velocity"] for s in (1.0, 2.5, 3.0)] == [True, True, False]
    for s in (1.0, 2.5):
        assert {k: v for k, v in again[s]["budget"].items() if k.startswith("total")} == pytest.approx({k: v for k, v in first[s]["budget"].items() if k.startswith("total")}, rel=1e-4, abs=1e-3)
    place = frame._filtered_place(cfg, 1.0, checked)
    assert frame.kept_filtered(spark, cfg, 1, 1.0, "another input") is None
    record = (place / "record.json").read_text()
    (place / "record.json").unlink()  # without a record the crop of the complete result vouches
    assert frame.kept_filtered(spark, cfg, 1, 1.0, checked) is not None
    kept = spark.read.parquet(str(place / "data"))
    rows = kept.withColumn("bx", F.when((F.col("x") == 5) & (F.col("y") == 5) & (F.col("z") == 5), F.col("bx") + 0.5).otherwise(F.col("bx")).cast("float")).collect()
    spark.createDataFrame(rows, kept.schema).write.mode("overwrite").parquet(str(place / "data"))
    assert frame.kept_filtered(spark, cfg, 1, 1.0, checked) is None  # the crop differs
    (place / "record.json").write_text(record)
    assert frame.kept_filtered(spark, cfg, 1, 1.0, checked) is None  # the digest differs
    assert not frame.process(spark, cfg, 1, 1.0, checked)["reuse"]["filtered_velocity"]


def test_an_older_result_is_replaced_only_if_fields_agree(spark, tmp_path):
    bricks.write(analytic.velocity(spark, 16, analytic.triad(16), "float"), str(tmp_path / "points"), brick=8)
    cfg = config.load(settings(tmp_path, sigmas=[2.0]))
    frame.single_frame(spark, cfg, 1)
    results = frame._results(spark, cfg)
    path = results.path(1, 2.0)

    def third(change):
        fields = results.open(path).drop("regime").withColumn("pi", change)
        rows = fields.where("x between 4 and 11 and y between 4 and 11 and z between 4 and 11").collect()
        spark.createDataFrame(rows, fields.schema).write.mode("overwrite").parquet(str(path / "fields"))
        manifest = json.loads((path / "manifest.json").read_text()) | {"schema_version": 3}
        (path / commit.MARKER).write_text(commit.atomic_json(path / "manifest.json", manifest))

    third(F.col("pi"))
    frame.upgrade(spark, cfg, 1, 2.0)
    assert results.open(path).count() == 4096 and results.version(path) == commit.SCHEMA_VERSION
    told = json.loads((path / "qa.json").read_text())["overlap"]
    assert told["passed"] and set(told["maximum_abs_difference"]) == set(frame.energy.ENERGY)
    third((F.col("pi") + 0.01).cast("float"))
    with pytest.raises(RuntimeError, match="pi"):
        frame.upgrade(spark, cfg, 1, 2.0)
    assert results.open(path).count() == 512 and results.version(path) == 3  # it stays


def test_an_upgrade_fetches_nothing(spark, tmp_path):
    log, stop = tmp_path / "log", tmp_path / "stop"
    (tmp_path / "late_service.py").write_text(SERVICE.format(log=str(log), stop=str(stop)))
    spark.sparkContext.addPyFile(str(tmp_path / "late_service.py"))
    cfg = config.load(settings(tmp_path, source="late_service:service", request=[8, 8, 8], tile=[8, 8, 8], sigmas=[2.0], net_max=1e30, retries=1))
    frame.single_frame(spark, cfg, 1)
    asked = len(log.read_text().split())
    results = frame._results(spark, cfg)
    path = results.path(1, 2.0)
    manifest = json.loads((path / "manifest.json").read_text()) | {"schema_version": 3}
    (path / commit.MARKER).write_text(commit.atomic_json(path / "manifest.json", manifest))
    shutil.rmtree(tmp_path / "state" / "raw" / "t000001" / "tiles" / "request=x0008_y0008_z0008")
    with pytest.raises(ValueError, match="missing"):
        frame.upgrade(spark, cfg, 1, 2.0)
    assert len(log.read_text().split()) == asked and results.version(path) == 3


def test_finalize_checks_presence(spark, tmp_path):
    cfg = config.load(settings(tmp_path, sigmas=[1.0]))
    commit.Results(spark, cfg.result_root).stage(analytic.velocity(spark, 4, analytic.triad(4)), 1, 1.0, {}, "h")
    assert cli.main(["finalize-result", "--config", str(settings(tmp_path, sigmas=[1.0]))]) == 1
    with pytest.raises(ValueError, match="mount"):
        config.load(settings(tmp_path, state_root="hdfs://x/y"))
