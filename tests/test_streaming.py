"""The stateful tail of snapshots against percentiles of all their points."""

import time

import pytest
from pyspark.sql import functions as F

from voxelflux.session import ship
from voxelflux.sources import analytic
from voxelflux.streaming import bricks, rollups, tail


@pytest.fixture(scope="module")
def tiles(spark):
    """Tiles of three snapshots of 8 * 8 * 8 points, and what is true of them."""
    ship(spark)
    points = None
    for t, field in ((1, analytic.triad(8)), (2, analytic.abc(8)), (3, analytic.taylor_green(8))):
        own = analytic.velocity(spark, 8, field).withColumn("time_index", F.lit(t))
        points = own if points is None else points.unionByName(own)
    made = tail.tile_tails(points, F.concat_ws("_", *(F.floor(F.col(a) / 4) for a in "zyx")), "ux", 512, 0.9).cache()
    truth = {r.time_index: r for r in points.groupBy("time_index").agg(F.percentile(F.abs("ux"), 0.9).alias("p"), F.max(F.abs("ux")).alias("m")).collect()}
    return made, truth


def test_any_order_and_repetition(spark, tiles, tmp_path):
    made, truth = tiles
    for i in range(3):  # each tile three times, in different orders and files
        made.orderBy(F.xxhash64(F.lit(i), "tile_key", "time_index")).coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
    paths = [str(tmp_path / x) for x in ("in", "out", "check")]
    rows = tail.collected(spark, *paths, 512, 0.9).collect()
    assert sorted(r.time_index for r in rows) == [1, 2, 3]
    for r in rows:
        assert r.complete and r.tiles == 8 and r.point_count == 512
        assert r.abs_percentile == pytest.approx(truth[r.time_index].p, rel=1e-12) and r.abs_max == truth[r.time_index].m
    made.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # late tiles of closed snapshots
    assert tail.collected(spark, *paths, 512, 0.9).count() == 3


def test_a_run_goes_on_from_its_checkpoint(spark, tiles, tmp_path):
    made, truth = tiles
    paths = [str(tmp_path / x) for x in ("in", "out", "check")]
    half = F.col("tile_key") < "1"
    made.where(half).coalesce(3).write.parquet(paths[0])
    assert tail.collected(spark, *paths, 512, 0.9).count() == 0
    made.where(~half & (F.col("time_index") < 3)).unionByName(made.where(half)).coalesce(3).write.mode("append").parquet(paths[0])
    rows = {r.time_index: r for r in tail.collected(spark, *paths, 512, 0.9).collect()}
    assert set(rows) == {1, 2} and all(r.abs_percentile == pytest.approx(truth[t].p, rel=1e-12) for t, r in rows.items())


def test_a_timer_closes_what_stays_incomplete(spark, tiles, tmp_path):
    made, _ = tiles
    part = made.where("time_index = 1 and tile_key < '1'")
    part.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = tail.tails(tail.arriving(spark, str(tmp_path / "in")), 512, 0.9, wait_seconds=2)
    query = stream.writeStream.format("memory").queryName("closed_tails").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    try:
        until = time.time() + 90
        while time.time() < until and not spark.table("closed_tails").count():
            time.sleep(1)
    finally:
        query.stop()
    row = spark.table("closed_tails").first()
    assert not row.complete and row.tiles == 4 and row.point_count == 256


def test_state_is_bounded(spark, tiles):
    made, _ = tiles
    assert tail.most_needed(512, 0.9) == 53 and tail.most_needed(0, 0.9) == 0
    assert made.agg(F.max(F.size("largest"))).first()[0] <= 53


def test_a_restart_in_mid_batch_gives_the_same_totals(spark, tmp_path, monkeypatch):
    """A batch whose totals are in, but whose checkpoint is not written, comes again and changes nothing."""
    points = analytic.velocity(spark, 8, analytic.triad(8))
    tiles = bricks.tile_moments(points, F.concat_ws("_", *(F.floor(F.col(a) / 4) for a in "zyx")), "ux")
    timed = tiles.withColumn("arrived", F.lit("2026-01-01").cast("timestamp")).cache()
    for part in ("tile_key < '1'", "tile_key >= '1'", "tile_key < '0_1'"):  # the last one repeats tiles
        timed.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    held = rollups.Rollup(spark, f"file://{tmp_path}/totals")
    real, calls = rollups.Rollup.apply, []

    def crash(self, batch, batch_id):
        out = real(self, batch, batch_id)
        calls.append((batch_id, out))
        if len(calls) == 2:
            raise RuntimeError("power is gone")
        return out

    monkeypatch.setattr(rollups.Rollup, "apply", crash)
    start = lambda: rollups.keep_up(spark.readStream.schema(rollups.TILE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), held, str(tmp_path / "c"))
    with pytest.raises(Exception, match="STREAM_FAILED"):
        start().awaitTermination()
    start().awaitTermination()
    assert calls[1][0] == calls[2][0] and calls[1][1] and not calls[2][1]  # it came twice and counted once
    row = held.totals().first()
    truth = points.agg(F.avg("ux"), F.sqrt(F.avg(F.col("ux") ** 2)), F.max(F.abs("ux"))).first()
    assert row.n_tiles == 8 and row.n == 512 and row.rms == pytest.approx(truth[1]) and row.max_abs == truth[2]
    assert held.log.chained() and not held.apply(timed, 0)
    monkeypatch.setattr(rollups.Rollup, "TAIL", 2)
    last = held.log.latest()[1]["batch"]
    for i in range(1, 5):
        assert real(held, timed.limit(0).drop("arrived"), last + i)
    assert held.totals().first().n == 512 and len(held.log.latest()[1]["deltas"]) <= 3
    timed.unpersist()
