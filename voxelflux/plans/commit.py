"""Results on disk: staged writes, sidecar reports with a hash chain, atomic commit, upgrades.

A result is a folder with Parquet datasets (fields on the whole grid, and more of them on the crop), qa.json,
manifest.json and, last of all, COMPLETE, whose content names the manifest's hash. A report is current if its own hash
stands in the manifest and the manifest's in COMPLETE. Sidecars are files of a few kB that the driver writes; datasets are
written and read by Spark. Both are on one POSIX file system that all machines mount: roots with another scheme are refused.

A result is committed by a rename and a marker, and replaced by two renames and a marker. recover() tells from what is there
where a crash came: a new folder whose manifest holds gets its marker, also if there was no older one; otherwise the old one
comes back.
"""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
import shutil
import socket
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.functions.fields import finite, sigma_tag
from voxelflux.operators.grid import missing_fields

SCHEMA_VERSION = 5
MARKER = "COMPLETE"


def result_id(time_index: int, sigma: float) -> str:
    return f"t{time_index:06d}_sigma_{sigma_tag(sigma)}"


def atomic_json(path: Path, payload: dict) -> str:
    """Write sorted, indented JSON under another name, sync and rename; returns the hash of the bytes."""
    return atomic_text(path, json.dumps(payload, indent=2, sort_keys=True, allow_nan=False))


def atomic_text(path: Path, text: str) -> str:
    """Write a text so that readers see the old one or all of the new one; returns the hash of its bytes."""
    raw = text.encode()
    path.parent.mkdir(parents=True, exist_ok=True)
    spare = path.with_name(path.name + ".partial")
    with spare.open("wb") as out:
        out.write(raw)
        out.flush()
        os.fsync(out.fileno())
    os.replace(spare, path)
    return hashlib.sha256(raw).hexdigest()


def uri(path: Path) -> str:
    """A path for Spark's readers and writers, whatever its default file system."""
    return f"file://{path.absolute()}"


def read(spark: SparkSession, path: Path) -> DataFrame:
    return spark.read.parquet(uri(path))


def content_key(content: dict) -> str:
    """A short name for what a stored dataset follows from."""
    return hashlib.sha256(json.dumps(content, sort_keys=True).encode()).hexdigest()[:32]


def file_hash(path: Path) -> str:
    return hashlib.sha256(path.read_bytes()).hexdigest()


@contextlib.contextmanager
def lock(path: Path) -> Iterator[None]:
    """A lock file that exists while the block runs; fails at once if another holds it.

    It names process and machine, so one that a crash on this machine left behind is taken over.
    """
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.with_name(path.name + ".guard").open("a") as guard:
        fcntl.flock(guard, fcntl.LOCK_EX)  # of two that see a dead holder one looks first, and the other then sees the first; a crash lets go
        if path.exists() and _left_behind(path):
            path.unlink(missing_ok=True)
        handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        os.write(handle, json.dumps({"pid": os.getpid(), "host": socket.gethostname()}).encode())
    try:
        yield
    finally:
        os.close(handle)
        path.unlink()


def _left_behind(path: Path) -> bool:
    try:
        holder = json.loads(path.read_text())
        if holder["host"] != socket.gethostname():
            return False
        os.kill(holder["pid"], 0)
    except ProcessLookupError:
        return True
    except (OSError, ValueError, KeyError):  # alive under another user, or still being written
        return False
    return False


def enough_space(path: Path, needed: int, reserve: int) -> None:
    free = shutil.disk_usage(path).free
    if free < needed + reserve:
        raise RuntimeError(f"{needed + reserve} bytes are needed under {path}, {free} are free")


def remove_child(parent: Path, path: Path) -> None:
    if path.resolve().parent != parent.resolve():
        raise ValueError(f"{path} is no direct child of {parent}")
    if path.exists():
        shutil.rmtree(path)


def run_record(path: Path, hours: int, now: datetime | None = None) -> dict:
    """Create the record of a scratch run, or check that the one there has not expired."""
    now = now or datetime.now(timezone.utc)
    if path.exists():
        record = json.loads(path.read_text())
        if now >= datetime.fromisoformat(record["expires_at"]):
            raise RuntimeError("the scratch run has expired")
    else:
        record = {"created_at": now.isoformat(), "expires_at": (now + timedelta(hours=hours)).isoformat()}
        atomic_json(path, record)
    left = datetime.fromisoformat(record["expires_at"]) - now
    return record | {"remaining_hours": max(0.0, left.total_seconds() / 3600)}


class Results:
    """All results under one root. `required` are (column, type) pairs that the whole-grid fields of each must have."""

    def __init__(self, spark: SparkSession, root: str | Path, required: tuple[tuple[str, str], ...] = ()):
        if "://" in str(root) or str(root).startswith("file:"):
            raise ValueError(f"results need a folder that all machines mount, not {root}")
        self.spark, self.root, self.required = spark, Path(root).absolute(), required

    def path(self, time_index: int, sigma: float) -> Path:
        return self.root / result_id(time_index, sigma)

    def staging(self, time_index: int, sigma: float) -> Path:
        return self.root / ".staging" / result_id(time_index, sigma)

    def _lock(self, time_index: int, sigma: float):
        return lock(self.root / ".locks" / f"{result_id(time_index, sigma)}.lock")

    def _read(self, path: Path) -> DataFrame:
        return self.spark.read.parquet(uri(path))

    def version(self, path: Path) -> int:
        """The schema version of a result."""
        return json.loads((path / "manifest.json").read_text())["schema_version"]

    def complete(self) -> list[Path]:
        return sorted(p for p in self.root.iterdir() if p.is_dir() and not p.name.startswith(".") and (p / MARKER).exists()) if self.root.exists() else []

    def stage(self, fields: DataFrame, time_index: int, sigma: float, qa: dict, input_hash: str, crop: DataFrame | None = None) -> Path:
        """Write datasets and QA to the staging folder; a staged result that is there goes."""
        with self._lock(time_index, sigma):
            return self._stage(fields, time_index, sigma, qa, input_hash, crop)

    def _stage(self, fields: DataFrame, time_index: int, sigma: float, qa: dict, input_hash: str, crop: DataFrame | None) -> Path:
        target, facts = self.staging(time_index, sigma), {}
        remove_child(target.parent, target) if target.exists() else None
        for name, rows in (("fields", fields), ("crop", crop)):
            if rows is not None:
                rows.write.option("compression", "zstd").parquet(uri(target / name))
                facts[name] = field_facts(self._read(target / name))
        if crop is not None and field_facts(crop) != facts["crop"]:  # read back and compared, as crops are kept for good
            raise OSError(f"the crop under {target} differs from what was written")
        atomic_json(target / "qa.json", qa | {"status": "processed", "input_hash": input_hash, "facts": facts})
        return target

    def finalize(self, time_index: int, sigma: float) -> Path:
        """Check the staged datasets, write manifest and COMPLETE, and move the folder into place."""
        with self._lock(time_index, sigma):
            return self._finalize(time_index, sigma)

    def _finalize(self, time_index: int, sigma: float) -> Path:
        staged, final = self.staging(time_index, sigma), self.path(time_index, sigma)
        self.recover(time_index, sigma)
        qa = json.loads((staged / "qa.json").read_text())
        if qa.get("status") != "processed":
            raise RuntimeError("the staged result is not processed")
        if final.exists() and not (final / MARKER).exists():
            raise RuntimeError(f"{final} is there without {MARKER}; it is not replaced")
        fields = self._read(staged / "fields")
        wrong = missing_fields(fields, [c for c, _ in self.required]) or [c for c in self.required if c not in fields.dtypes]
        if wrong:
            raise ValueError(f"missing or of another type: {wrong}")
        facts = {"fields": field_facts(fields)} | ({"crop": field_facts(self._read(staged / "crop"))} if (staged / "crop").exists() else {})
        if facts != qa["facts"]:
            raise OSError(f"what stands under {staged} is not what was staged")
        manifest = {"schema_version": SCHEMA_VERSION, "time_index": time_index, "sigma": sigma, **facts, "input_hash": qa["input_hash"], "reports": {"qa.json": file_hash(staged / "qa.json")}}
        digest = atomic_json(staged / "manifest.json", manifest)
        old = self._old(final)
        if final.exists():
            os.replace(final, old)
        os.replace(staged, final)
        self._mark(final, digest)
        if old.exists():
            shutil.rmtree(old)
        return final

    @staticmethod
    def _old(final: Path) -> Path:
        return final.with_name(f".{final.name}.old")

    @staticmethod
    def _mark(final: Path, digest: str) -> None:
        with (final / MARKER).open("x") as out:
            out.write(digest)
            out.flush()
            os.fsync(out.fileno())

    def recover(self, time_index: int, sigma: float) -> str:
        """Bring a replacement that a crash broke off to one of its two ends; says which, or that there was none."""
        final = self.path(time_index, sigma)
        old, manifest = self._old(final), final / "manifest.json"
        if not old.exists() and (not final.exists() or (final / MARKER).exists()):
            return "none"
        if not (final / MARKER).exists():
            whole = manifest.exists() and json.loads(manifest.read_text()).get("reports", {}).get("qa.json") == file_hash(final / "qa.json")
            if not whole:
                if not old.exists():
                    return "none"  # a folder that no commit has left; it is not touched
                if final.exists():
                    shutil.rmtree(final)
                os.replace(old, final)
                return "back"
            self._mark(final, file_hash(manifest))
        if old.exists():
            shutil.rmtree(old)
        return "forward"

    def open(self, path: Path) -> DataFrame:
        if not (path / MARKER).exists() or json.loads((path / "qa.json").read_text()).get("status") != "processed":
            raise RuntimeError(f"{path} is not complete")
        return self._read(path / "fields")

    def open_crop(self, path: Path) -> DataFrame:
        """What only the crop of a complete result has."""
        self.open(path)
        return self._read(path / "crop")

    def report(self, path: Path, name: str) -> dict | None:
        """A report whose hash chain holds, else None."""
        manifest = path / "manifest.json"
        if not (path / MARKER).exists() or (path / MARKER).read_text() != file_hash(manifest):
            return None
        if not (path / name).exists() or json.loads(manifest.read_text())["reports"].get(name) != file_hash(path / name):
            return None
        return json.loads((path / name).read_text())

    def ensure_report(self, path: Path, name: str, compute, facts: dict) -> dict:
        """The report if its chain holds and it was made under the same facts (version, thresholds); else a new one."""
        held = self.report(path, name)
        if held and all(held.get(k) == v for k, v in facts.items()):
            return held
        with lock(self.root / ".locks" / f"{path.name}.{name}.lock"):
            made = compute(self.open(path)) | facts
            manifest = json.loads((path / "manifest.json").read_text())
            manifest["reports"][name] = atomic_json(path / name, made)
            digest = atomic_json(path / "manifest.json", manifest)
            spare = path / f"{MARKER}.partial"
            spare.write_text(digest)
            os.replace(spare, path / MARKER)
        return made

    def upgrade(self, time_index: int, sigma: float, recompute) -> Path:
        """A result of an older schema with the columns that `recompute` adds, committed like a new one.

        The old result stays in place until the new one is whole, and comes back if a step fails or a crash breaks in.
        """
        path = self.path(time_index, sigma)
        with self._lock(time_index, sigma):
            self.recover(time_index, sigma)
            manifest = json.loads((path / "manifest.json").read_text())
            if manifest["schema_version"] == SCHEMA_VERSION:
                return path
            crop = self._read(path / "crop") if (path / "crop").exists() else None
            self._stage(recompute(self.open(path)), time_index, sigma, json.loads((path / "qa.json").read_text()), manifest["input_hash"], crop)
            return self._finalize(time_index, sigma)

    def status(self) -> DataFrame:
        """One row a result folder with what its manifest says; null where there is none or the chain is broken."""
        rows = []
        for p in sorted(q for q in self.root.iterdir() if q.is_dir() and not q.name.startswith(".")) if self.root.exists() else []:
            held = json.loads((p / "manifest.json").read_text()) if (p / "manifest.json").exists() else {}
            whole = (p / MARKER).exists() and (p / MARKER).read_text() == file_hash(p / "manifest.json")
            rows.append((p.name, held.get("time_index"), held.get("sigma"), held.get("schema_version"), whole, sorted(held.get("reports", {}))))
        return self.spark.createDataFrame(rows, "result string, time_index int, sigma double, schema_version int, complete boolean, reports array<string>")


def field_facts(fields: DataFrame) -> dict:
    """Type, row count, extrema and an order-free digest of each column, from one scan; fails on values not finite."""
    numeric = [(c, t) for c, t in fields.dtypes if t in ("float", "double", "int", "bigint", "tinyint", "smallint")]
    aggs = [F.count(F.lit(1)).alias("n")]
    for c, _ in numeric:
        aggs += [F.count_if(~finite(c)).alias(f"bad_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.bit_xor(F.xxhash64("time_index", "z", "y", "x", c)).alias(f"xor_{c}")]
    row = fields.agg(*aggs).first()
    bad = [c for c, _ in numeric if row[f"bad_{c}"]]
    if bad:
        raise ValueError(f"values that are not finite in {bad}")
    return {c: {"dtype": t, "count": row["n"], "min": row[f"min_{c}"], "max": row[f"max_{c}"], "xor": f"{row[f'xor_{c}'] & (2**64 - 1):016x}"} for c, t in numeric}
