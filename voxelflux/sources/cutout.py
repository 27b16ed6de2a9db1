"""A Spark data source for box cutouts of a remote field service.

The service allows one request at a time, so a snapshot is one partition that walks its request blocks in order,
with retries and linear back-off, and yields Arrow batches block by block. The fetcher is any importable callable
(box, time_index) -> array (nz, ny, nx, 3), named as "module:function"; tests use a formula. With token_variable or
token_file it is called with the token as a third argument, and messages of its errors come without it.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from voxelflux.sources.secret import get_token

SCHEMA = "time_index int, z int, y int, x int, ux float, uy float, uz float"


def blocks(n: int, size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Request boxes (x0, y0, z0, nx, ny, nz) in z, y, x order."""
    ranges = [(s, min(size, n - s)) for s in range(0, n, size)]
    return [(x, y, z, nx, ny, nz) for z, nz in ranges for y, ny in ranges for x, nx in ranges]


def one_based(box: tuple[int, int, int, int, int, int]) -> list[list[int]]:
    """The closed one-based ranges by which the service names a box."""
    return [[box[i] + 1, box[i] + box[i + 3]] for i in range(3)]


def fetch(fetcher, box, time_index: int, retries: int, backoff: float, secret: str = "") -> np.ndarray:
    for attempt in range(1, retries + 1):
        try:
            values = np.asarray(fetcher(box, time_index))
            x0, y0, z0, nx, ny, nz = box
            if values.shape != (nz, ny, nx, 3):
                raise ValueError(f"the cutout has shape {values.shape}")
            if not np.isfinite(values).all():
                raise ValueError("the cutout holds values that are not finite")
            return values.astype("<f4")
        except Exception as error:
            if attempt == retries:
                text = str(error).replace(secret, "***") if secret else str(error)
                raise RuntimeError(f"request {one_based(box)} failed {retries} times: {text}") from None
            time.sleep(backoff * attempt)
    raise AssertionError


class Snapshot(InputPartition):
    def __init__(self, time_index: int):
        self.time_index = time_index


class CutoutReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Snapshot]:
        return [Snapshot(int(t)) for t in str(self.options.get("time_index", "1")).split(",")]

    def read(self, partition: Snapshot) -> Iterator[pa.RecordBatch]:
        module, name = self.options["fetcher"].split(":")
        fetcher = getattr(importlib.import_module(module), name)
        variable, file = self.options.get("token_variable", ""), self.options.get("token_file")
        secret = get_token(variable, file) if variable or file else ""  # read where it is used; options and plans hold names only
        asked = (lambda box, time_index: fetcher(box, time_index, secret)) if secret else fetcher
        n, size = int(self.options["n"]), int(self.options.get("request", self.options["n"]))
        named = self.options.get("boxes")  # x0,y0,z0,nx,ny,nz;... instead of the whole snapshot
        for box in [tuple(map(int, b.split(","))) for b in named.split(";")] if named else blocks(n, size):
            values = fetch(asked, box, partition.time_index, int(self.options.get("retries", 3)), float(self.options.get("backoff", 1.0)), secret)
            x0, y0, z0, nx, ny, nz = box
            z, y, x = (a.reshape(-1).astype(np.int32) for a in np.meshgrid(np.arange(z0, z0 + nz), np.arange(y0, y0 + ny), np.arange(x0, x0 + nx), indexing="ij"))
            flat = values.reshape(-1, 3)
            cols = [np.full(len(x), partition.time_index, np.int32), z, y, x, *(np.ascontiguousarray(flat[:, i]) for i in range(3))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["time_index", "z", "y", "x", "ux", "uy", "uz"])


class Cutout(DataSource):
    """spark.dataSource.register(Cutout); spark.read.format("cutout").option("fetcher", ...).option("n", ...)."""

    @classmethod
    def name(cls) -> str:
        return "cutout"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CutoutReader:
        return CutoutReader(dict(self.options))
