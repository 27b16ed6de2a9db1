import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelflux.operators import grid, ledger
from voxelflux.sources import analytic, bricks, cutout


def index_field(n=8):
    def fetch(box, time_index):
        x0, y0, z0, nx, ny, nz = box
        z, y, x = np.meshgrid(np.arange(z0, z0 + nz), np.arange(y0, y0 + ny), np.arange(x0, x0 + nx), indexing="ij")
        return np.stack([x, y, z], -1)

    return fetch


def fetch_index(box, time_index):
    return index_field()(box, time_index)


def test_tiles_cover_once(spark):
    snaps = spark.createDataFrame([(1,), (2,)], "time_index int")
    tiles = grid.tiles(snaps, (8, 6, 5), (4, 4, 4)).cache()
    assert tiles.count() == 2 * 2 * 2 * 2
    assert tiles.where("time_index = 1").agg(F.sum(F.col("nx") * F.col("ny") * F.col("nz"))).first()[0] == 8 * 6 * 5
    big = grid.tiles(snaps.limit(1), (1024, 1024, 1024), (128, 128, 128)).cache()
    requests = grid.tiles(snaps.limit(1), (1024, 1024, 1024), (512, 512, 512))
    assert big.count() == 512 and requests.count() == 8
    held = grid.inside(big, requests, (512, 512, 512)).groupBy("tile_key_r").count().collect()
    assert len(held) == 8 and all(r["count"] == 64 for r in held)
    assert "CartesianProduct" not in grid.inside(big, requests, (512, 512, 512))._jdf.queryExecution().executedPlan().toString()


def test_crop_plane_pivot_overlap(spark):
    n = 6
    pts = analytic.grid(spark, n).select("*", *(F.col(a).cast("float").alias(f"u{a}") for a in "xyz"))
    cut = grid.crop(pts, (1, 2, 3), (2, 3, 1))
    assert cut.count() == 6 and cut.where("lx + 1 <> x or ly + 2 <> y or lz + 3 <> z").count() == 0
    assert grid.plane(pts, "y", 2, ["ux"], stride=2).count() == 9
    with pytest.raises(ValueError, match="axis"):
        grid.plane(pts, "w", 0, ["ux"])
    back = grid.pivot_components(grid.unpivot(pts, ["ux", "uy", "uz"]))
    assert back.where("ux <> x or uy <> y or uz <> z").count() == 0
    old = cut.select("time_index", F.col("lx").alias("x"), F.col("ly").alias("y"), F.col("lz").alias("z"), "ux", "uy", "uz")
    assert all(r.close and r.max_diff == 0 for r in grid.overlap(old, pts, (1, 2, 3), ["ux", "uy"]).collect())
    assert not grid.overlap(old.withColumn("ux", F.col("ux") + 1), pts, (1, 2, 3), ["ux"]).first().close


def test_seams(spark):
    pts = analytic.grid(spark, 8).select("*", *(F.col(a).cast("double").alias(f"u{a}") for a in "xyz"))
    rows = {r.axis: r for r in grid.seams(pts, 8, ["ux", "uy", "uz"]).collect()}
    assert rows["x"].wrap_rms == pytest.approx((49 / 3) ** 0.5) and rows["x"].internal_rms == pytest.approx((1 / 3) ** 0.5) and rows["z"].ratio == pytest.approx(7.0)


def test_coverage_pending_ledger(spark):
    plan = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    found = spark.createDataFrame([("b",), ("d",)], "key string")
    assert {(r.key, r.side) for r in grid.coverage(plan, found, ["key"]).collect()} == {("a", "missing"), ("c", "missing"), ("d", "unplanned")}
    events = spark.createDataFrame([("a", 1, "planned", None, None), ("a", 2, "fetching", None, None), ("a", 3, "verified", "h1", 10), ("a", 4, "fetching", None, None), ("b", 1, "planned", None, None)], ledger.EVENT)
    rows = {r.key: r for r in ledger.state(events).collect()}
    assert (rows["a"].status, rows["a"].attempts, rows["a"].sha256) == ("fetching", 2, "h1") and rows["b"].attempts == 0
    more = ledger.planned(events, plan, 9)
    assert [r.key for r in more.collect()] == ["c"]
    assert ledger.planned(events.unionByName(more), plan, 10).count() == 0
    assert [r.key for r in ledger.orphans(found, plan, ["key"]).collect()] == ["d"]
    total = {r.status: r.n for r in ledger.progress(ledger.state(events), [], F.col("status")).collect()}
    assert total == {"fetching": 1, "planned": 1, None: 2}


def test_bricks_round_trip_and_pruning(spark, tmp_path):
    pts = analytic.velocity(spark, 8, analytic.triad(8), "float")
    bricks.write(pts, str(tmp_path / "b"), brick=4)
    back = bricks.read(spark, str(tmp_path / "b"), 4)
    assert back.exceptAll(pts).isEmpty() and back.count() == 512
    part = bricks.read(spark, str(tmp_path / "b"), 4, z=(5, 7))
    assert part.count() == 128
    assert "PartitionFilters: [" in (plan := part._jdf.queryExecution().executedPlan().toString()) and "zb" in plan.split("PartitionFilters")[1][:200]
    sums = bricks.checksums(pts, 4)
    assert sums.count() == 8 and sums.agg(F.sum("n_points")).first()[0] == 512
    other = bricks.checksums(pts.withColumn("ux", F.when(F.expr("x = 0 and y = 0 and z = 0"), F.lit(9.0)).otherwise(F.col("ux")).cast("float")), 4)
    assert sums.join(other, ["tile_key", "sha256"], "left_anti").count() == 1
    one = sums.where("tile_key = 'x0000_y0000_z0000'").first()
    values = np.array([[r.ux, r.uy, r.uz] for r in pts.where("x < 4 and y < 4 and z < 4").orderBy("z", "y", "x").collect()], "<f4")
    import hashlib

    assert one.sha256 == hashlib.sha256(np.ascontiguousarray(values.T).tobytes()).hexdigest()


def test_cutout_source(spark):
    assert cutout.one_based((0, 128, 0, 64, 64, 32)) == [[1, 64], [129, 192], [1, 32]]
    spark.dataSource.register(cutout.Cutout)
    reader = cutout.CutoutReader({"fetcher": "tests.test_grid:fetch_index", "n": "8", "request": "4", "time_index": "1,2"})
    assert len(reader.partitions()) == 2
    rows = sum(b.num_rows for b in _read(reader))
    assert rows == 512
    calls = []

    def flaky(box, t):
        calls.append(box)
        if len(calls) < 3:
            raise OSError("token abc is bad")
        return index_field()(box, t)

    assert cutout.fetch(flaky, (0, 0, 0, 2, 2, 2), 1, 3, 0).shape == (2, 2, 2, 3) and len(calls) == 3
    with pytest.raises(RuntimeError, match="\\*\\*\\*"):
        cutout.fetch(lambda b, t: (_ for _ in ()).throw(OSError("token abc is bad")), (0, 0, 0, 2, 2, 2), 1, 2, 0, secret="abc")
    with pytest.raises(RuntimeError, match="finite"):
        cutout.fetch(lambda b, t: np.full((2, 2, 2, 3), np.nan), (0, 0, 0, 2, 2, 2), 1, 1, 0)


def _read(reader):
    import sys
    import types

    module = types.ModuleType("tests.test_grid")
    module.fetch_index = fetch_index
    sys.modules.setdefault("tests.test_grid", module)
    return reader.read(reader.partitions()[0])
