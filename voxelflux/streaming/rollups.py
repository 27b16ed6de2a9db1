"""Additive totals of snapshots kept up from a stream of tiles, each batch exactly once.

foreachBatch may give a batch again after a crash. Totals therefore carry the number of the last batch that is in them, in the
same entry of a sources.log that names the data: a batch that is there already changes nothing, and two drivers can't both
put one. A tile that is delivered again counts once within the watermark: its state is dropped when event time has moved on
by `keep`, so state doesn't grow for ever; what comes later than that is late data and is left out.

Defined cases: an empty batch makes an entry without data; tiles without event time are left out, as Spark's watermark does;
totals of an empty rollup are an empty frame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.sources.log import Log

TOTALS = "time_index int, n_tiles long, n long, total double, sum_squares double, max_abs double"
TILE_SCHEMA = "time_index int, tile_key string, n long, total double, sum_squares double, max_abs double, arrived timestamp"


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("time_index").agg(F.sum("n_tiles").alias("n_tiles"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("sum_squares").alias("sum_squares"), F.max("max_abs").alias("max_abs"))


class Rollup:
    #: Deltas after which they are summed into one.
    TAIL = 16

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri.rstrip("/")
        self.log = Log(spark, f"{self.uri}/log")

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(TOTALS).parquet(*(f"{self.uri}/{n}" for n in names)) if names else self.spark.createDataFrame([], TOTALS)

    def _write(self, rows: DataFrame) -> str:
        name = f"delta-{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(f"{self.uri}/{name}")
        return name

    def apply(self, batch: DataFrame, batch_id: int) -> bool:
        """Add a batch of tiles; False if its totals are in already."""
        n, now = self.log.latest()
        if now.get("batch", -1) >= batch_id:
            return False
        name = self._write(_sums(batch.withColumn("n_tiles", F.lit(1).cast("long"))))
        kept = now.get("deltas", [])
        if len(kept) >= self.TAIL:
            kept = [self._write(_sums(self._read(kept)))]
        if not self.log.put(n + 1, {"batch": batch_id, "deltas": [*kept, name]}):
            if self.log.latest()[1]["batch"] >= batch_id:
                return False  # another driver was first with the same batch
            raise RuntimeError("another stream writes to this rollup")
        return True

    def totals(self) -> DataFrame:
        """(time_index, n_tiles, n, mean, rms, max_abs) of all batches."""
        out = _sums(self._read(self.log.latest()[1].get("deltas", [])))
        return out.select("time_index", "n_tiles", "n", F.try_divide("total", "n").alias("mean"), F.sqrt(F.try_divide("sum_squares", "n")).alias("rms"), "max_abs")


def keep_up(tiles: DataFrame, rollup: Rollup, checkpoint: str, keep: str = "1 day", **trigger):
    """Start the query that adds a stream of TILE_SCHEMA rows to a rollup."""
    once = tiles.withWatermark("arrived", keep).dropDuplicatesWithinWatermark(["time_index", "tile_key"])

    def add(batch: DataFrame, batch_id: int) -> None:
        if not rollup.apply(batch, batch_id):
            batch.write.format("noop").mode("overwrite").save()  # its totals are in, but the state of its tiles may not be

    return once.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
