"""python -m voxelflux COMMAND --config FILE: 0 all passed, 2 a gate failed, 1 an error."""

from __future__ import annotations

import argparse
import json
import os
import sys
from pathlib import Path

from voxelflux.plans import commit, frame
from voxelflux.plans.config import load
from voxelflux.sources.secret import token_source

REPORTS = {"compute-cq": "cq", "compute-weak-asymmetry": "weak", "qa-sbar": "sbar"}
COMMANDS = ["plan", "doctor", "smoke", "cache", "validate-input", "process", "finalize-result", "single-frame", "upgrade-result", "backfill-full-regime", "backfill-full-fields", "status", "auth-status", "slice", *REPORTS]


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="voxelflux")
    out.add_argument("command", choices=COMMANDS)
    out.add_argument("--config", required=True)
    out.add_argument("--time-index", type=int, default=1)
    out.add_argument("--sigma", type=float)
    out.add_argument("--axis", default="z")
    out.add_argument("--index", type=int, default=0)
    out.add_argument("--field", default="pi")
    out.add_argument("--master", default=os.environ.get("SPARK_MASTER", "local[*]"))
    return out


def doctor(cfg, time_index: int) -> dict:
    """Named checks of folders, space, versions and the source; all must hold."""
    import importlib.util
    import shutil

    import pyarrow
    import pyspark

    checks, plan = {}, cfg.plan(time_index)
    for name, folder, needed in (("results", cfg.result_root, plan["result_bytes"] * len(cfg.sigmas)), ("state", cfg.state_root, plan["raw_bytes"] if frame.fetched(cfg) else 0)):
        path = Path(folder)
        path.mkdir(parents=True, exist_ok=True)
        checks[f"{name}_writable"] = os.access(path, os.W_OK)
        checks[f"{name}_space"] = shutil.disk_usage(path).free >= needed + int(cfg.reserve_gib * 2**30)
    module = cfg.source.split(":")[0]
    checks["source_there"] = bool(cfg.source) and (importlib.util.find_spec(module) is not None if frame.fetched(cfg) else Path(cfg.source).exists())
    checks["python_3_10"] = sys.version_info >= (3, 10)
    checks["spark_4"] = int(pyspark.__version__.split(".")[0]) >= 4
    checks["arrow_11"] = int(pyarrow.__version__.split(".")[0]) >= 11
    checks["java_found"] = bool(shutil.which("java") or os.environ.get("JAVA_HOME"))
    record = Path(cfg.state_root) / "run.json"
    try:
        checks["run_not_expired"] = not record.exists() or commit.run_record(record, cfg.scratch_hours)["remaining_hours"] > 0
    except RuntimeError:
        checks["run_not_expired"] = False
    return {"checks": checks, "passed": all(checks.values())}


def run(args: argparse.Namespace) -> dict | list:
    cfg = load(args.config)
    cfg = cfg.with_sigma(args.sigma) if args.sigma else cfg
    t = args.time_index
    if args.command == "plan":
        return cfg.plan(t)
    if args.command == "doctor":
        return doctor(cfg, t)
    if args.command == "auth-status":
        source = token_source(cfg.token_variable, cfg.token_file or None)
        return {"source": source, "passed": source is not None}
    from voxelflux.session import build

    spark = build(args.master)
    results = frame._results(spark, cfg)
    if args.command == "smoke":
        from voxelflux.plans.reports import snapshot_statistics

        row = snapshot_statistics(frame.points(spark, cfg, t).where("x < 8 and y < 8 and z < 8"), ["ux", "uy", "uz"]).first()
        return {"n": row.n, "minimum": row.minimum, "maximum": row.maximum, "passed": row.all_finite}
    if args.command == "validate-input":
        return frame.validate(spark, cfg, t)
    if args.command == "process":
        done = frame.process_batch(spark, cfg, t, list(cfg.sigmas), frame.trusted_input(cfg, t) or frame.validate(spark, cfg, t)["manifest_hash"])
        return [done[s] for s in cfg.sigmas]
    if args.command == "finalize-result":
        return [str(results.finalize(t, s)) for s in cfg.sigmas]
    if args.command == "single-frame":
        return frame.single_frame(spark, cfg, t)
    if args.command == "cache":
        return {"points": frame.points(spark, cfg, t).count(), **frame.status(spark, cfg, t)}
    if args.command in ("upgrade-result", "backfill-full-regime", "backfill-full-fields"):
        return [str(frame.upgrade(spark, cfg, t, s)) for s in cfg.sigmas]
    if args.command == "status":
        return frame.status(spark, cfg, t)
    path = results.path(t, cfg.sigmas[0])
    if args.command == "slice":
        from voxelflux.operators.grid import plane

        return [r.asDict() for r in plane(results.open(path), args.axis, args.index, [args.field]).collect()]  # one plane
    return frame.report(spark, cfg, path, REPORTS[args.command])


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        out = run(args)
    except Exception as error:
        print(f"error: {error}", file=sys.stderr)
        return 1
    print(json.dumps(out, indent=2, sort_keys=True, default=str))
    return 2 if isinstance(out, dict) and out.get("passed") is False else 0


if __name__ == "__main__":
    sys.exit(main())
