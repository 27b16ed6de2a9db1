"""Exact tail of snapshots whose tiles arrive over time, in any order and perhaps twice, with bounded state.

The percentile of a snapshot of `expected` points lies among its expected - floor((expected - 1) * share) largest values. So
the state of a snapshot is that many values and little more: a tile brings its own largest ones, those below the least that
is still held are dropped at once, others are appended as a chunk, and chunks are merged when half as many again are held. A
tile counts once. A snapshot closes when all its points are there, or, incomplete, when nothing has come for a while: it is
told once, its values leave the state, and late or repeated tiles of it find the mark that stays for a time.

Defined cases: a tile without points counts as a tile; values that are null or not finite are an error of tile_tails(); a
snapshot that closes incomplete has the percentile of what came; tiles that come after the mark has gone open it anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from voxelflux.functions.fields import guarded, wide

TILE = "time_index int, tile_key string, n long, largest array<double>"
OUT = "time_index int, tiles int, point_count long, abs_percentile double, abs_max double, complete boolean"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def most_needed(expected: int, share: float) -> int:
    """How many of the largest of `expected` values hold both ranks of a percentile."""
    return expected - int((expected - 1) * share) if expected else 0


def tile_tails(points: DataFrame, tile: Column, field: str, expected: int, share: float = 0.99) -> DataFrame:
    """One row a tile, the unit that is delivered: its number of points and the largest of |field| that may matter.

    A tile is bounded, so its values may meet in one task.
    """
    v = F.abs(guarded(wide(field), field))
    values = F.reverse(F.array_sort(F.collect_list(v)))
    return points.groupBy("time_index", tile.alias("tile_key")).agg(F.count(v).alias("n"), F.slice(values, 1, most_needed(expected, share)).alias("largest"))


class Tail(StatefulProcessor):
    def __init__(self, expected: int, share: float, wait_ms: int, mark_ms: int):
        self.expected, self.share, self.wait_ms, self.mark_ms = expected, share, wait_ms, mark_ms
        self.most = most_needed(expected, share)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "tile_key string", "n long")
        self.chunks = handle.getListState("chunks", "chunk array<double>")
        self.sums = handle.getValueState("sums", "n long, tiles int, held long, least double")
        self.closed = handle.getValueState("closed", "n long", self.mark_ms)

    def _values(self) -> np.ndarray:
        parts = [np.asarray(c[0], float) for c in self.chunks.get()] if self.chunks.exists() else []
        return np.concatenate(parts) if parts else np.zeros(0)

    def _largest(self, values: np.ndarray) -> np.ndarray:
        return values if len(values) <= self.most else np.partition(values, len(values) - self.most)[len(values) - self.most :]

    def _told(self, key: tuple) -> pd.DataFrame:
        n, tiles, _, _ = self.sums.get()
        top = np.sort(self._largest(self._values()))
        percentile = None
        if n:
            rank = (n - 1) * self.share
            low = len(top) - (n - int(rank))  # where that rank is among those held
            a, b = top[low], top[min(low + 1, len(top) - 1)]
            percentile = float(a + (b - a) * (rank - int(rank)))
        self.seen.clear()
        self.chunks.clear()
        self.sums.clear()
        self.closed.update((n,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        return pd.DataFrame({"time_index": [key[0]], "tiles": [tiles], "point_count": [n], "abs_percentile": [percentile], "abs_max": [float(top[-1]) if n else None], "complete": [n == self.expected]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.closed.exists():
            return
        n, tiles, held, least = self.sums.get() if self.sums.exists() else (0, 0, 0, -1.0)
        fresh, here = [], set()
        for part in rows:
            for tile, count, largest in zip(part["tile_key"], part["n"], part["largest"], strict=True):
                if tile in here or self.seen.containsKey((tile,)):
                    continue
                here.add(tile)
                self.seen.updateValue((tile,), (int(count),))
                n, tiles = n + int(count), tiles + 1
                values = np.asarray(largest, float)
                fresh.append(values[values > least] if held >= self.most else values)
        if not here:
            return
        new = self._largest(np.concatenate(fresh)) if fresh else np.zeros(0)
        if len(new):
            self.chunks.appendValue((new.tolist(),))
            held += len(new)
        if held > self.most * 3 // 2 or (least < 0 and held >= self.most):
            kept = self._largest(self._values())
            self.chunks.put([(kept.tolist(),)])
            held, least = len(kept), float(kept.min()) if len(kept) >= self.most and len(kept) else least
        self.sums.update((n, tiles, held, least))
        if n >= self.expected:
            yield self._told(key)
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sums.exists():
            yield self._told(key)

    def close(self) -> None:
        pass


def arriving(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(TILE).option("maxFilesPerTrigger", per_trigger).parquet(path)


def tails(tiles: DataFrame, expected: int, share: float = 0.99, wait_seconds: float = 3600, mark_seconds: float = 7 * 86400) -> DataFrame:
    """A stream of OUT rows, one a snapshot as it closes, from a stream of TILE rows."""
    tiles.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    processor = Tail(expected, share, int(wait_seconds * 1000), int(mark_seconds * 1000))
    return tiles.groupBy("time_index").transformWithStateInPandas(processor, OUT, "Append", "ProcessingTime")


def collected(spark: SparkSession, source: str, sink: str, checkpoint: str, expected: int, share: float = 0.99, **more) -> DataFrame:
    """All tiles that lie in a folder now, as a stream that ends; what closed stands in sink, exactly once.

    Batches without data, in which timers would fire, are switched off, as a stream with timers would never end: snapshots
    that are incomplete stay open for the next run.
    """
    switch = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(switch, "true")
    spark.conf.set(switch, "false")
    try:
        query = tails(arriving(spark, source), expected, share, **more).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(switch, before)
    return spark.read.schema(OUT).parquet(sink)
