"""Settings of a run, from YAML with a closed schema: unknown keys, bad ranges and repeated filter widths are errors."""

from __future__ import annotations

import math
import os
from dataclasses import asdict, dataclass, fields, replace
from pathlib import Path

from voxelflux.functions.fields import sigma_tag

Triple = tuple[int, int, int]


@dataclass(frozen=True)
class Config:
    dataset: str = "snapshots"
    grid: Triple = (16, 16, 16)
    domain_length: float = 2 * math.pi
    time_step: float = 0.002
    source: str = ""  # Parquet bricks of points, or module:function for the cutout source
    state_root: str = "state"
    result_root: str = "results"
    tile: Triple = (8, 8, 8)
    request: Triple = (16, 16, 16)
    crop_start: Triple = (4, 4, 4)
    crop_shape: Triple = (8, 8, 8)
    sigmas: tuple[float, ...] = (1.0,)
    eps_abs: float = 0.0
    eps_rel: float = 1e-3
    divergence_rms_max: float = 1e-4
    divergence_max_max: float = 1e-3
    identity_rms_max: float = 1e-4
    net_max: float = 1e-2
    partition_max: float = 1e-12
    retries: int = 3
    backoff_seconds: float = 5.0
    reserve_gib: float = 0.0
    scratch_hours: int = 72
    kind: str = "float"
    keep_filtered: bool = False  # filtered velocities stay for later runs over the same input
    token_variable: str = ""
    token_file: str = ""

    def checked(self) -> Config:
        def need(ok: bool, what: str) -> None:
            if not ok:
                raise ValueError(what)

        for name in ("grid", "tile", "request", "crop_shape"):
            need(all(isinstance(n, int) and n > 0 for n in getattr(self, name)), f"{name} must be three positive integers")
        need(not any("://" in str(r) or str(r).startswith("file:") for r in (self.state_root, self.result_root)), "state_root and result_root must be folders that all machines mount")
        need(len(set(self.grid)) == 1, "the grid must be a cube")
        need(all(n % t == 0 for n, t in zip(self.grid, self.tile, strict=True)), "tile must divide grid")
        need(all(n % r == 0 for n, r in zip(self.grid, self.request, strict=True)), "request must divide grid")
        need(all(r % t == 0 for r, t in zip(self.request, self.tile, strict=True)), "tile must divide request")
        need(all(s >= 0 and s + n <= g for s, n, g in zip(self.crop_start, self.crop_shape, self.grid, strict=True)), "the crop lies outside the grid")
        need(bool(self.sigmas) and all(math.isfinite(s) and s > 0 for s in self.sigmas), "sigmas must be positive")
        need(len({sigma_tag(s) for s in self.sigmas}) == len(self.sigmas), "sigmas must be unique")
        need(min(self.divergence_rms_max, self.divergence_max_max, self.identity_rms_max, self.net_max, self.partition_max) > 0, "limits must be positive")
        need(self.eps_abs >= 0 and self.eps_rel >= 0, "thresholds must not be negative")
        need(self.retries >= 1 and self.backoff_seconds >= 0 and self.reserve_gib >= 0 and self.scratch_hours > 0, "retry and storage settings are invalid")
        need(self.kind in ("float", "double"), "kind must be float or double")
        return self

    def with_sigma(self, sigma: float) -> Config:
        return replace(self, sigmas=(float(sigma),)).checked()

    def physical_time(self, time_index: int) -> float:
        if time_index < 1:
            raise ValueError("time_index starts at 1")
        return (time_index - 1) * self.time_step

    def plan(self, time_index: int) -> dict:
        """Counts and uncompressed sizes of a frame: velocity, and for each sigma the result of the crop (24 floats a
        point) and of the whole grid (four floats and a byte a point)."""
        points, crop = math.prod(self.grid), math.prod(self.crop_shape)
        count = lambda b: math.prod(-(-n // s) for n, s in zip(self.grid, b, strict=True))
        return {
            "dataset": self.dataset, "time_index": time_index, "physical_time": self.physical_time(time_index), "requests": count(self.request), "tiles": count(self.tile),
            "raw_bytes": points * 12, "result_bytes": crop * 96 + points * 17, "workspace_bytes": points * 40, "sigmas": list(self.sigmas), "serial_source": True,
        }

    def facts(self) -> dict:
        return asdict(self)


def load(path: str | Path) -> Config:
    import yaml

    raw = yaml.safe_load(Path(path).read_text()) or {}
    if not isinstance(raw, dict):
        raise ValueError("the configuration must be a mapping")
    known = {f.name: f.default for f in fields(Config)}
    unknown = sorted(set(raw) - set(known))
    if unknown:
        raise ValueError(f"unknown settings: {unknown}")
    for key, value in raw.items():
        if isinstance(value, str):
            value = os.path.expandvars(value)
            if "<username>" in value:
                raise ValueError(f"{key} holds a placeholder")
        if isinstance(known[key], float):
            value = float(value)  # YAML reads 1e-4 as text
        raw[key] = tuple(value) if isinstance(value, list) else value
    if isinstance(raw.get("sigmas"), (int, float)):
        raw["sigmas"] = (float(raw["sigmas"]),)
    return Config(**raw).checked()
