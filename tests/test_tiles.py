"""The verifying sink, one-pass facts, Merkle trees, the log and the journal."""

import threading

import pytest
from pyspark.sql import functions as F

from voxelflux.operators import aggregates, grid, ledger
from voxelflux.plans import reports
from voxelflux.plans.journal import Journal
from voxelflux.session import ship
from voxelflux.sources import analytic, bricks, tiles
from voxelflux.sources.log import Log

U = ["ux", "uy", "uz"]


@pytest.fixture(scope="module")
def points(spark):
    ship(spark)
    return analytic.velocity(spark, 16, analytic.triad(16), "float")


def test_what_stands_has_the_digests_of_what_was_sent(spark, points, tmp_path):
    found = bricks.write_verified(points, str(tmp_path), 4, 16, files=8, least=1)
    back = bricks.read(spark, str(tmp_path / "tiles"))
    assert back.exceptAll(points).isEmpty() and points.exceptAll(back).isEmpty()
    want = {r.tile_key: r.sha256 for r in bricks.checksums(points, 4).collect()}
    assert {r.tile_key: r.sha256 for r in found.collect()} == want and len(want) == 64
    for axis in "xyz":  # a plane of any axis: 16 of 64 tiles in 4 of 8 files
        assert tiles.layout(str(tmp_path / "tiles"), axis, 5) == {"files": 8, "row_groups": 64, "files_read": 4, "row_groups_read": 16}
        assert bricks.read(spark, str(tmp_path / "tiles")).where(F.col(axis) == 5).count() == 256


@pytest.mark.parametrize("wrong", ["missing", "twice", "nan", "null"])
def test_bad_tiles_are_not_committed(spark, points, tmp_path, wrong):
    at = (F.col("x") == 1) & (F.col("y") == 9) & (F.col("z") == 3)
    bad = {
        "missing": points.where(~at), "twice": points.unionByName(points.where(at)),
        "nan": points.withColumn("uy", F.when(at, F.lit(float("nan"))).otherwise(F.col("uy")).cast("float")), "null": points.withColumn("uy", F.when(~at, F.col("uy"))),
    }[wrong]
    with pytest.raises(Exception, match="x0000_y0008_z0000"):
        bricks.write_verified(bad, str(tmp_path), 8, 16)
    assert not list(tmp_path.rglob("*.parquet"))


def test_a_task_of_many_tiles_holds_a_file_of_them(spark, points, tmp_path, monkeypatch):
    """Files have a bounded number of tiles, each is verified when it is full, and what a task tells the driver does not grow with its tiles."""
    many = points.crossJoin(spark.range(40).select(F.col("id").cast("int").alias("t"))).withColumn("time_index", F.col("t")).drop("t")
    rows = tiles.dealt(many, 4, 16, 1).coalesce(1).sortWithinPartitions("time_index", "stretch", "curve", "z", "y", "x").toArrow()
    writer = tiles.TileWriter(many.schema, {"path": str(tmp_path / "tiles"), "digests": str(tmp_path / "digests"), "block": "4"})
    monkeypatch.setattr(tiles, "MOST", 100, raising=False)
    seen = []
    real = tiles.everything
    monkeypatch.setattr(tiles, "everything", lambda t: seen.append(t.num_rows) or real(t))
    done = writer.write(iter(rows.to_batches(max_chunksize=5000)))
    assert not list(tmp_path.rglob("[!.]*.parquet")) and len(seen) == 2 * 40 * 64
    assert sum(len(x) for x in vars(done).values()) < 100
    writer.commit([done])
    assert tiles.layout(str(tmp_path / "tiles"), "x", 5) == {"files": 26, "row_groups": 2560, "files_read": 26, "row_groups_read": 640}
    found = tiles.verified(spark, str(tmp_path / "digests"))
    want = {(r.time_index, r.tile_key): r.sha256 for r in bricks.checksums(many, 4).collect()}
    assert {(r.time_index, r.tile_key): r.sha256 for r in found.collect()} == want and found.count() == 2560
    back = bricks.read(spark, str(tmp_path / "tiles"))
    assert back.count() == many.count() and back.exceptAll(many.select(back.columns)).isEmpty()


@pytest.mark.parametrize("tasks", ["one", "two"])
def test_a_tile_in_two_places_is_not_committed(spark, points, tmp_path, tasks):
    one = tiles.dealt(points, 8, 16, 4)
    both = one.unionByName(one.where("x < 8"))  # two tasks that are whole by themselves
    spark.dataSource.register(tiles.Tiles)
    write = (both.coalesce(1) if tasks == "one" else both).write.format("tiles").mode("append").option("path", f"{tmp_path}/tiles").option("digests", f"{tmp_path}/digests").option("block", 8)
    with pytest.raises(Exception, match="in two places"):
        write.save()
    assert not list(tmp_path.rglob("*.parquet"))


def test_nothing_is_written_for_nothing(spark, points, tmp_path):
    assert bricks.write_verified(points.where("x < 0"), str(tmp_path), 8, 16).count() == 0


def test_facts_of_one_scan(spark, points):
    facts = bricks.tile_facts(points, 4, 16)
    old = reports.snapshot_statistics(points, U).first()
    new = bricks.statistics(facts).first()
    assert new.tiles == 64 and new.all_finite and all(new[k] == pytest.approx(old[k], rel=1e-12, abs=1e-15) for k in ("n", "minimum", "maximum", "mean", "rms"))
    seams = {r.axis: r for r in bricks.seams(facts, 16).collect()}
    for r in grid.seams(points, 16, U).collect():
        assert seams[r.axis].wrap_rms == pytest.approx(r.wrap_rms, rel=1e-9) and seams[r.axis].internal_rms == pytest.approx(r.internal_rms, rel=1e-9)
    assert {r.tile_key: r.sha256 for r in facts.where("axis is null").collect()} == {r.tile_key: r.sha256 for r in bricks.checksums(points, 4).collect()}
    holed = bricks.tile_facts(points.where("not (x = 1 and y = 1 and z = 1)"), 4, 16)
    assert holed.where("axis is null and n_points <> 64").count() == 1


def test_a_tree_names_the_damaged_tile(spark, points):
    def tree(df):
        place = [F.floor(F.substring("tile_key", at, 4).cast("int") / 2).cast("int").alias(a) for a, at in (("z", 14), ("y", 8), ("x", 2))]
        return aggregates.tree(bricks.checksums(df, 2).select("time_index", *place, F.col("sha256").alias("digest")))

    one = tree(points).cache()
    assert {r.level: r["count"] for r in one.groupBy("level").count().collect()} == {0: 512, 1: 64, 2: 8, 3: 1}
    assert aggregates.damaged(one, one).isEmpty()
    hurt = points.withColumn("uz", F.when((F.col("x") == 11) & (F.col("y") == 2) & (F.col("z") == 7), F.lit(0.5)).otherwise(F.col("uz")).cast("float"))
    assert [tuple(r) for r in aggregates.damaged(one, tree(hurt)).collect()] == [(1, 3, 1, 5)]
    lost = tree(points.where("not (x < 2 and y < 2 and z < 2)"))
    assert [tuple(r) for r in aggregates.damaged(one, lost).collect()] == [(1, 0, 0, 0)]
    one.unpersist()


@pytest.mark.parametrize("kind", ["file", "viewfs"])
def test_one_of_two_drivers_puts_an_entry(spark, tmp_path, kind):
    if kind == "viewfs":
        spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.logs.link./in", f"file://{tmp_path}")
    log = Log(spark, "viewfs://logs/in/log" if kind == "viewfs" else f"file://{tmp_path}/log")
    assert log.latest() == (0, {}) and not log.put(2, {"a": 1})
    assert log.put(1, {"a": 1}) and not log.put(1, {"a": 2}) and log.entry(1)["a"] == 1
    won = []
    if kind == "file":
        racers = [threading.Thread(target=lambda i=i: won.append(i) if Log(spark, log.uri).put(2, {"a": i}) else None) for i in range(6)]
        for t in racers:
            t.start()
        for t in racers:
            t.join()
        assert len(won) == 1 and log.entry(2)["a"] == won[0]
    assert log.change(lambda now: {"a": now["a"] + 100})[1]["a"] == log.latest()[1]["a"] and log.chained()
    assert all(p.name.endswith(".json") for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc"))


def events(spark, rows):
    return spark.createDataFrame(rows, ledger.EVENT)


def test_compaction_changes_no_state(spark, tmp_path):
    held = Journal(spark, f"file://{tmp_path}/j")
    assert held.state().count() == 0 and held.compact() == 0
    first = [("a", 1, "planned", None, None), ("b", 1, "planned", None, None), ("a", 2, "fetching", None, None), ("a", 3, "verified", "h1", 5)]
    later = [("a", 4, "fetching", None, None), ("a", 5, "failed", None, None), ("b", 2, "fetching", None, None)]
    late = [("a", 2, "verified", "h0", 4), ("b", 0, "verified", "h9", 1)]  # of lower order than what is folded
    whole = []
    for part in (first, later, late):
        held.append(events(spark, part))
        whole += part
        want = sorted(ledger.state(events(spark, whole)).collect())
        before = held.events().cache()
        reader = before.count()
        assert sorted(held.state().collect()) == want
        held.compact()
        assert sorted(held.state().collect()) == want and not held.log.latest()[1]["deltas"]
        assert held.events().count() <= 2 * 2 and before.count() == reader
        assert held.compact() == held.log.latest()[0]
    assert held.append(events(spark, [])) == held.log.latest()[0]
    gone = held.vacuum(1)
    assert gone and sorted(held.state().collect()) == want and held.vacuum(1) == []


def test_a_reader_sees_one_version_and_no_append_is_lost(spark, tmp_path, monkeypatch):
    held = Journal(spark, f"file://{tmp_path}/j")
    held.append(events(spark, [("a", 1, "planned", None, None)]))
    reader = held.events()
    real = ledger.folded

    def meanwhile(df):  # another driver appends while this one folds
        monkeypatch.setattr(ledger, "folded", real)
        Journal(spark, held.uri).append(events(spark, [("b", 1, "planned", None, None)]))
        return real(df)

    monkeypatch.setattr(ledger, "folded", meanwhile)
    held.compact()
    assert len(held.log.latest()[1]["deltas"]) == 1
    assert {r.key for r in held.state().collect()} == {"a", "b"} and [r.key for r in reader.collect()] == ["a"]
    monkeypatch.setattr(Journal, "TAIL", 3)
    for i in range(5):
        held.append(events(spark, [(f"k{i}", 1, "planned", None, None)]))
    assert held.state().count() == 7 and len(held.log.latest()[1]["deltas"]) < 3
