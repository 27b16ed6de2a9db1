"""The verbs of a frame: acquire and validate the input, process a filter width, gate, commit, report, upgrade, status."""

from __future__ import annotations

import json
import math
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.operators import grid, ledger
from voxelflux.plans import commit, energy, reports
from voxelflux.plans.config import Config
from voxelflux.plans.journal import Journal
from voxelflux.session import ship
from voxelflux.sources import bricks, cutout
from voxelflux.sources import tiles as tile_sink

REPORT_VERSION = 2
CROP_FIELDS = [*energy.U, *energy.UB, *energy.gradient_names("g"), *energy.gradient_names("h")]


def fetched(cfg: Config) -> bool:
    """Whether the source names a function, module:function, and no folder."""
    return ":" in cfg.source and "/" not in cfg.source


def points(spark: SparkSession, cfg: Config, time_index: int, fetch: bool = True) -> DataFrame:
    """A frame's velocity: from bricks, or from its own store where `source` names a function. With fetch, what the store
    lacks is acquired first; without, it is read as it stands."""
    ship(spark)
    if not fetched(cfg):
        return bricks.read(spark, cfg.source, cfg.tile[0]).where(F.col("time_index") == time_index)
    if fetch:
        acquire(spark, cfg, time_index)
    return _held(spark, cfg, time_index)


def _raw(cfg: Config, time_index: int) -> Path:
    return Path(cfg.state_root).absolute() / "raw" / f"t{time_index:06d}"


def _held(spark: SparkSession, cfg: Config, time_index: int) -> DataFrame:
    """What stands in the store of a frame."""
    found = sorted(commit.uri(p) for p in (_raw(cfg, time_index) / "tiles").glob("request=*") if any(p.glob("*.parquet")))
    return spark.read.schema(cutout.SCHEMA).parquet(*found) if found else spark.createDataFrame([], cutout.SCHEMA)


def journal(spark: SparkSession, cfg: Config, time_index: int) -> Journal:
    """The ledger of a frame's tiles."""
    return Journal(spark, commit.uri(Path(cfg.state_root) / "ledger" / f"t{time_index:06d}"))


def _ledger(spark: SparkSession, cfg: Config, time_index: int) -> DataFrame:
    return journal(spark, cfg, time_index).events()


def _append(rows: DataFrame, cfg: Config, time_index: int) -> None:
    journal(rows.sparkSession, cfg, time_index).append(rows)


def acquire(spark: SparkSession, cfg: Config, time_index: int) -> DataFrame:
    """The velocity of a frame in a store of its own, fetched request by request.

    Tiles are planned in the ledger once. The sink of sources.tiles hashes each tile as it is sent, reads it back and commits
    a request only if all agree; its digests are what the ledger calls verified, so nothing is hashed again after a request.
    A run that broke off goes on with what is pending: what an earlier run has left is hashed once at the start, and tiles
    that stand in the store with the ledger's digest are not fetched again. The service takes one request at a time, so
    requests are a loop on the driver, of a handful of steps; the fields never pass through it.
    """
    ship(spark)
    spark.dataSource.register(cutout.Cutout)
    raw, state = _raw(cfg, time_index), Path(cfg.state_root).absolute()
    with commit.lock(state / ".locks" / f"acquire_t{time_index:06d}.lock"):
        snapshot = spark.createDataFrame([(time_index,)], "time_index int")
        tiles = grid.tiles(snapshot, cfg.grid, cfg.tile)
        plan = tiles.select(F.col("tile_key").alias("key"))
        _append(ledger.planned(_ledger(spark, cfg, time_index), plan, time.time_ns()), cfg, time_index)
        there = bricks.checksums(_held(spark, cfg, time_index), cfg.tile[0]).select(F.col("tile_key").alias("key"), "sha256")
        missing = ledger.to_fetch(plan, ledger.state(_ledger(spark, cfg, time_index)), there)
        held = grid.inside(tiles, grid.tiles(snapshot, cfg.grid, cfg.request), cfg.request).select(F.col("tile_key").alias("key"), F.struct(*(F.col(f"{c}_r").alias(c) for c in ("z0", "y0", "x0", "nx", "ny", "nz", "tile_key"))).alias("request")).cache()
        todo = [r.request for r in held.join(missing, "key", "left_semi").select("request").distinct().orderBy("request").collect()]
        if todo:
            commit.enough_space(state.anchor, cfg.plan(time_index)["raw_bytes"] * len(todo) // cfg.plan(time_index)["requests"], int(cfg.reserve_gib * 2**30))
        options = {"fetcher": cfg.source, "n": cfg.grid[0], "request": cfg.request[0], "time_index": time_index, "retries": cfg.retries, "backoff": cfg.backoff_seconds}
        options |= {k: v for k, v in (("token_variable", cfg.token_variable), ("token_file", cfg.token_file)) if v}
        for request in todo:
            own = held.where(F.col("request.tile_key") == request.tile_key).select("key")
            said = lambda event, rows: rows.select("key", F.lit(time.time_ns()).alias("seq"), F.lit(event).alias("event"), *(F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (("sha256", "string"), ("byte_count", "long"))))
            _append(said("fetching", own), cfg, time_index)
            folders = [raw / part / f"request={request.tile_key}" for part in ("tiles", "digests")]
            try:
                for folder in folders:
                    commit.remove_child(folder.parent, folder) if folder.exists() else None
                box = ",".join(str(request[c]) for c in ("x0", "y0", "z0", "nx", "ny", "nz"))
                values = spark.read.format("cutout").options(**options, boxes=box).load()
                sums = tile_sink.write(values, *(commit.uri(f) for f in folders), cfg.tile[0], cfg.grid[0])
                sums = sums.select(F.col("tile_key").alias("key"), "sha256", "byte_count").join(own, "key", "left_semi").cache()
                if sums.count() != own.count():
                    raise OSError(f"{folders[0]} does not hold all tiles of its request")
            except Exception:
                _append(said("failed", own), cfg, time_index)
                raise
            _append(said("verified", sums), cfg, time_index)
            sums.unpersist()
        held.unpersist()
    return _held(spark, cfg, time_index)


def validate(spark: SparkSession, cfg: Config, time_index: int, fetch: bool = True) -> dict:
    """Coverage exactly once, finite values, statistics, seams and tile digests; writes QA and an input manifest.

    The frame is scanned once, whatever is asked of it. Without fetch nothing is acquired, and a store that lacks tiles is
    an error.
    """
    frame = points(spark, cfg, time_index, fetch)
    n, tile = cfg.grid[0], cfg.tile[0]
    snapshot = spark.createDataFrame([(time_index,)], "time_index int")
    facts = bricks.tile_facts(frame, tile, n)
    sums = facts.where("axis is null")
    gaps = grid.coverage(grid.tiles(snapshot, cfg.grid, cfg.tile), sums, ["tile_key"]).count()
    wrong = sums.where((F.col("n_points") != tile**3) | (F.col("n_finite") != F.col("n_points"))).count()
    if gaps or wrong:
        raise ValueError(f"{gaps} tiles are missing or unplanned, {wrong} are incomplete or not finite")
    stats = bricks.statistics(facts).first()
    tiles = [{"key": r.tile_key, "sha256": r.sha256, "bytes": r.byte_count} for r in sums.orderBy("tile_key").collect()]  # one row a tile
    qa = {
        "status": "validated", "time_index": time_index, "physical_time": cfg.physical_time(time_index), "coverage_exactly_once": True,
        "statistics": {k: stats[k] for k in ("minimum", "maximum", "mean", "rms")}, "seams": {r.axis: {"wrap_rms": r.wrap_rms, "internal_rms": r.internal_rms, "ratio": r.ratio} for r in bricks.seams(facts, n).collect()},
    }
    state = Path(cfg.state_root)
    commit.atomic_json(state / "qa" / f"input_t{time_index:06d}.json", qa)
    digest = commit.atomic_json(state / "manifests" / f"input_t{time_index:06d}.json", {"grid": list(cfg.grid), "tiles": tiles, "qa": qa})
    return qa | {"manifest_hash": digest}


def trusted_input(cfg: Config, time_index: int) -> str | None:
    """The hash of a frame's input manifest, if the frame was validated under this grid; no data is read."""
    path = Path(cfg.state_root) / "manifests" / f"input_t{time_index:06d}.json"
    if not path.exists():
        return None
    held = json.loads(path.read_text())
    return commit.file_hash(path) if held["qa"]["status"] == "validated" and held["grid"] == list(cfg.grid) else None


def _results(spark: SparkSession, cfg: Config) -> commit.Results:
    required = (*((f, cfg.kind) for f in energy.ENERGY), ("regime", "tinyint"))
    return commit.Results(spark, cfg.result_root, required)


def _filtered_place(cfg: Config, sigma: float, input_hash: str) -> Path:
    """Where a filtered velocity is kept: named by all that its content follows from."""
    content = {"input": input_hash, "sigma": sigma, "grid": list(cfg.grid), "kind": cfg.kind}
    return Path(cfg.state_root).absolute() / "filtered" / commit.content_key(content)


def kept_filtered(spark: SparkSession, cfg: Config, time_index: int, sigma: float, input_hash: str) -> DataFrame | None:
    """The velocity with its filtered form of an earlier run over the same input, if it can be trusted; else None.

    It can if its record names this content and the data have the digests of the record. A record that is lost or of other
    content leaves one way: a complete result of this frame whose crop of the filtered velocity agrees. Data that differ from
    their own record are damaged and never used.
    """
    place = _filtered_place(cfg, sigma, input_hash)
    if not (place / "data").exists():
        return None
    held = commit.read(spark, place / "data")
    if sorted(held.columns) != sorted([*grid.POINT, *energy.U, *energy.UB]):
        return None
    try:
        facts = commit.field_facts(held)
    except ValueError:  # values that are not finite
        return None
    record = json.loads((place / "record.json").read_text()) if (place / "record.json").exists() else {}
    if record.get("status") == "complete" and record.get("input_hash") == input_hash and record.get("sigma") == sigma:
        return held if record["facts"] == facts else None
    results = _results(spark, cfg)
    path = results.path(time_index, sigma)
    if not (path / commit.MARKER).exists() or facts["bx"]["count"] != math.prod(cfg.grid):
        return None
    crop = results.open_crop(path)
    if any(b not in crop.columns for b in energy.UB):
        return None
    rows = grid.cached_velocity(crop.select(*grid.POINT, *energy.UB), held, (0, 0, 0)).collect()
    return held if len(rows) == 3 and all(r.close for r in rows) else None


def keep_filtered(fields: DataFrame, cfg: Config, sigma: float, input_hash: str) -> None:
    """Store velocity and filtered velocity side by side, so a later run reads both in one scan."""
    place = _filtered_place(cfg, sigma, input_hash)
    fields.select(*grid.POINT, *energy.U, *energy.UB).write.mode("overwrite").option("compression", "zstd").parquet(commit.uri(place / "data"))
    facts = commit.field_facts(commit.read(fields.sparkSession, place / "data"))
    commit.atomic_json(place / "record.json", {"status": "complete", "input_hash": input_hash, "sigma": sigma, "facts": facts})


def overlap_with_stored(spark: SparkSession, cfg: Config, time_index: int, sigma: float, fields: DataFrame) -> dict | None:
    """Whether new energy fields agree with those of the older result they are to replace; an error if not.

    Results that lack an energy field tell nothing: None.
    """
    results = _results(spark, cfg)
    path = results.path(time_index, sigma)
    if not (path / commit.MARKER).exists() or results.version(path) not in (2, 3):
        return None
    old = results.open(path)
    if any(f not in old.columns for f in energy.ENERGY):
        return None
    rows = grid.overlap(old.select(*grid.POINT, *energy.ENERGY), fields, (0, 0, 0), energy.ENERGY).collect()
    far = sorted(r.field for r in rows if not r.close)
    if far or not rows:
        raise RuntimeError(f"new fields differ from those of the stored result: {far or 'no point in common'}")
    return {"passed": True, "maximum_abs_difference": {r.field: r.max_diff for r in rows}}


def process(spark: SparkSession, cfg: Config, time_index: int, sigma: float, input_hash: str) -> dict:
    """process_batch() of one filter width."""
    return process_batch(spark, cfg, time_index, [sigma], input_hash)[sigma]


def process_batch(spark: SparkSession, cfg: Config, time_index: int, sigmas: list[float], input_hash: str) -> dict[float, dict]:
    """Fields of all filter widths into staging, if the divergence of all velocities is small enough.

    All widths go through the same exchanges (energy.energy_batch), but for those whose filtered velocity a run over the same
    input has left: these start from it. First the gate: divergences and gradients alone, two exchanges. Then all fields are
    written once to a work folder, and budget, thresholds, results and crops are read from there; an executor that is lost
    later costs no transform. The four energy fields and the regime are kept on the whole grid, velocities and gradients on
    the crop alone, as Config.plan() counts them; the work folder has nulls for these outside the crop.
    """
    ready = {s: held for s in sigmas if (held := kept_filtered(spark, cfg, time_index, s, input_hash)) is not None}
    fresh = [s for s in sigmas if s not in ready]
    out: dict[float, dict] = {}
    for widths, frame, reused in [*([(fresh, points(spark, cfg, time_index, fetch=False), False)] if fresh else []), *(([s], held, True) for s, held in ready.items())]:
        out |= _batch(spark, cfg, time_index, widths, frame, reused, input_hash)
    return out


def _batch(spark: SparkSession, cfg: Config, time_index: int, sigmas: list[float], frame: DataFrame, reused: bool, input_hash: str) -> dict[float, dict]:
    every = range(len(sigmas))
    if reused:
        frame = frame.withColumnsRenamed({b: energy.own(b, 0) for b in energy.UB})
    batch = lambda wanted: energy.energy_batch(frame, cfg.grid[0], sigmas, length=cfg.domain_length, kind=cfg.kind, wanted=wanted, ready=(0,) if reused else ())
    g, h = energy.gradient_names("g"), energy.gradient_names("h")
    named = [("raw", "div", g), *((str(i), energy.own("div_bar", i), [energy.own(x, i) for x in h]) for i in every)]
    rows = {r["name"]: {k: r[k] for k in ("relative_rms", "relative_max", "passed")} for r in energy.divergences(batch(["div", "div_bar", *g, *h]), named, cfg.divergence_rms_max, cfg.divergence_max_max).collect()}
    gates = {s: {"raw": rows["raw"], "filtered": rows[str(i)]} for i, s in enumerate(sigmas)}
    if not all(x["passed"] for x in rows.values()):
        commit.atomic_json(Path(cfg.state_root) / "qa" / f"divergence_t{time_index:06d}.json", {str(s): gate for s, gate in gates.items()})
        raise RuntimeError(f"the velocity is not free of divergence: {gates}")
    work = Path(cfg.state_root).absolute() / "work" / f"t{time_index:06d}-{uuid.uuid4().hex}"
    inside = F.lit(True)
    for a, start, size in zip("xyz", cfg.crop_start, cfg.crop_shape, strict=True):
        inside &= (F.col(a) >= start) & (F.col(a) < start + size)
    whole = [energy.own(f, i) for f in [*energy.ENERGY, *(energy.UB if cfg.keep_filtered else [])] for i in every] + (list(energy.U) if cfg.keep_filtered else [])
    fields = batch([*CROP_FIELDS, *energy.ENERGY])
    fields = fields.select(*grid.POINT, *(F.col(c) if c in whole else F.when(inside, F.col(c)).alias(c) for c in fields.columns if c not in grid.POINT))
    try:
        fields.write.option("compression", "zstd").parquet(commit.uri(work))
        written, out = commit.read(spark, work), {}
        for i, sigma in enumerate(sigmas):
            own = energy.of_sigma(written, i)
            budget = reports.budget_qa(own, cfg.identity_rms_max, cfg.net_max).first().asDict()
            qa = {"divergence": gates[sigma], "budget": budget, "sigma": sigma, "reuse": {"filtered_velocity": reused}, "overlap": overlap_with_stored(spark, cfg, time_index, sigma, own)}
            crop = grid.crop(own.select(*grid.POINT, *CROP_FIELDS), cfg.crop_start, cfg.crop_shape).drop("lx", "ly", "lz")
            _results(spark, cfg).stage(_coded(cfg, own.select(*grid.POINT, *energy.ENERGY)), time_index, sigma, qa, input_hash, crop)
            if cfg.keep_filtered and not reused:
                keep_filtered(own, cfg, sigma, input_hash)
            out[sigma] = {"divergence": gates[sigma], "budget": budget, "reuse": qa["reuse"], "overlap": qa["overlap"]}
    finally:
        commit.remove_child(work.parent, work) if work.exists() else None
    return out


def _coded(cfg: Config, fields: DataFrame) -> DataFrame:
    return energy.with_regime(fields, ["time_index"], cfg.eps_abs, cfg.eps_rel).withColumn("regime", F.col("regime").cast("tinyint"))


def upgrade(spark: SparkSession, cfg: Config, time_index: int, sigma: float) -> Path:
    """A committed result of an older schema brought to the current one.

    Version 4 lacks the regime, which comes from its stored works. Versions 2 and 3 are made anew from the stored
    velocity; nothing is fetched for that. Reports are then made as they are missing or stale.
    """
    results = _results(spark, cfg)
    path = results.path(time_index, sigma)
    results.recover(time_index, sigma)
    if not (path / commit.MARKER).exists():
        raise RuntimeError(f"{path} is not complete")
    version = json.loads((path / "manifest.json").read_text())["schema_version"]
    if version == 4:
        results.upgrade(time_index, sigma, lambda fields: _coded(cfg, fields.select(*grid.POINT, *energy.ENERGY)))
    elif version in (2, 3):
        if fetched(cfg) and not _raw(cfg, time_index).exists():
            raise RuntimeError("the velocity is not stored; an upgrade fetches nothing")
        process(spark, cfg, time_index, sigma, validate(spark, cfg, time_index, fetch=False)["manifest_hash"])
        results.finalize(time_index, sigma)
    elif version != commit.SCHEMA_VERSION:
        raise RuntimeError(f"schema {version} is not known")
    for name in ("cq", "weak", "sbar"):
        report(spark, cfg, path, name)
    return path


def status(spark: SparkSession, cfg: Config, time_index: int) -> dict:
    """The state of the input's tiles by the ledger, and of all results by their manifests."""
    tiles = {r.status or "total": r.n for r in ledger.progress(ledger.state(_ledger(spark, cfg, time_index)).withColumn("time_index", F.lit(time_index)), ["time_index"], F.col("status")).collect()}
    return {"time_index": time_index, "planned": cfg.plan(time_index)["tiles"], "tiles": tiles, "results": [r.asDict() for r in _results(spark, cfg).status().collect()]}


def single_frame(spark: SparkSession, cfg: Config, time_index: int) -> list[str]:
    """Validate once, then process all filter widths that are not there yet together and commit them; older results are upgraded."""
    results = _results(spark, cfg)
    commit.run_record(Path(cfg.state_root) / "run.json", cfg.scratch_hours)
    left = [s for s in cfg.sigmas if not (results.path(time_index, s) / commit.MARKER).exists()]
    commit.enough_space(Path(cfg.result_root).absolute().anchor, cfg.plan(time_index)["result_bytes"] * len(left), int(cfg.reserve_gib * 2**30))
    for sigma in cfg.sigmas:
        results.recover(time_index, sigma)
    left = [s for s in left if not (results.path(time_index, s) / commit.MARKER).exists()]
    if left:
        process_batch(spark, cfg, time_index, left, validate(spark, cfg, time_index)["manifest_hash"])
    for sigma in left:
        results.finalize(time_index, sigma)
    return [str(upgrade(spark, cfg, time_index, sigma)) for sigma in cfg.sigmas]


#: What the chart of a report shows.
SHOWN = {"cq": "stored_cq", "weak": ("positive_sum", "negative_sum", "pi_sum"), "sbar": ("total_work_full", "total_work_resolved", "total_pi", "total_s_bar")}


def report(spark: SparkSession, cfg: Config, path: Path, name: str) -> dict:
    """A report over a committed result, and a page with its chart beside it."""
    made = _report(spark, cfg, path, name)
    shown = {r["quadrant"]: r[SHOWN["cq"]] for r in made["regimes"]} if name == "cq" else {k: made.get(k) for k in SHOWN[name]}
    page, target = bars(f"{name}: {path.name}", shown), path / f"{name}.html"
    if not target.exists() or target.read_text() != page:
        commit.atomic_text(target, page)
    return made


def _report(spark: SparkSession, cfg: Config, path: Path, name: str) -> dict:
    """One of the reports cq, weak and sbar; made anew only if limits or version changed."""
    results = _results(spark, cfg)
    if name == "sbar":
        held = results.report(path, "sbar.json")
        facts = {"report_version": REPORT_VERSION, "identity_max": cfg.identity_rms_max, "net_max": cfg.net_max}
        if held and held["report_version"] == REPORT_VERSION:  # other limits need no scan

            def again(_: DataFrame) -> dict:
                kept = {k: v for k, v in held.items() if k not in facts}
                ok = [v is not None and v <= m for v, m in ((kept["relative_residual"], cfg.identity_rms_max), (kept["s_bar_vs_pi"], cfg.net_max))]
                return kept | {"identity_passed": ok[0], "net_passed": ok[1], "passed": all(ok)}

            return results.ensure_report(path, "sbar.json", again, facts)
        return results.ensure_report(path, "sbar.json", lambda df: reports.budget_qa(df, cfg.identity_rms_max, cfg.net_max).first().asDict(), facts)
    facts = {"report_version": REPORT_VERSION, "limit": cfg.partition_max}
    if name == "weak":
        held = results.report(path, "weak.json")
        if held and held["report_version"] == 1 and held["limit"] == cfg.partition_max:  # lacks the tail, which one column gives

            def with_tail(fields: DataFrame) -> dict:
                tail, mean = reports.tail(fields).first(), abs(held["pi_mean"])
                ratios = {f"ratio_{k}": mean / v if v else (0.0 if mean == 0 else None) for k, v in (("p99", tail.abs_p99), ("max", tail.abs_max))}
                return held | {"abs_p99": tail.abs_p99, "abs_max": tail.abs_max, **ratios}

            return results.ensure_report(path, "weak.json", with_tail, facts)
        return results.ensure_report(path, "weak.json", lambda df: reports.weak_asymmetry(df, cfg.partition_max).first().asDict(), facts)

    def flux(df: DataFrame) -> dict:
        closure = reports.quadrant_closure(df, cfg.partition_max).first().asDict()
        return {"regimes": [r.asDict() for r in reports.quadrant_flux(df).orderBy("quadrant").collect()], "closure": closure, "passed": closure["passed"]}

    return results.ensure_report(path, "cq.json", flux, facts)


def bars(title: str, values: dict[str, float | None]) -> str:
    """A self-contained HTML page with one bar for each value."""
    most = max([abs(v) for v in values.values() if v is not None and math.isfinite(v)] or [1.0]) or 1.0
    rows = []
    for i, (name, v) in enumerate(values.items()):
        width = 0 if v is None else 200 * abs(v) / most
        x = 320 if v is None or v >= 0 else 320 - width
        label = "undefined" if v is None else f"{v:.6e}"
        rows.append(f'<text x="4" y="{30 * i + 44}">{name}</text><rect x="{x:.1f}" y="{30 * i + 30}" width="{width:.1f}" height="18" fill="#4477aa"/><text x="530" y="{30 * i + 44}">{label}</text>')
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title></head><body><svg xmlns="http://www.w3.org/2000/svg" width="680" height="{30 * len(values) + 50}" font-family="sans-serif" font-size="13"><text x="4" y="18">{title}</text>{"".join(rows)}</svg></body></html>'
