"""Snapshots whose bricks arrive over time: running moments by Structured Streaming.

A brick file may be delivered twice; rows of a tile count once. State is one row a tile key and one a snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.functions.fields import wide

TILE_SCHEMA = "time_index int, tile_key string, n long, total double, sum_squares double, max_abs double"


def tile_moments(points: DataFrame, tile: Column, field: str) -> DataFrame:
    """Additive moments of each tile, the unit that is delivered: one row a tile."""
    v = wide(field)
    return points.groupBy("time_index", tile.alias("tile_key")).agg(F.count(v).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("sum_squares"), F.max(F.abs(v)).alias("max_abs"))


def arriving(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(TILE_SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(path)


def running(tiles: DataFrame) -> DataFrame:
    """(time_index, n_tiles, n, mean, rms, max_abs) over the tiles so far, each counted once."""
    once = tiles.dropDuplicates(["time_index", "tile_key"])
    out = once.groupBy("time_index").agg(F.count(F.lit(1)).alias("n_tiles"), F.sum("n").alias("n"), F.sum("total").alias("s"), F.sum("sum_squares").alias("q"), F.max("max_abs").alias("max_abs"))
    return out.select("time_index", "n_tiles", "n", F.try_divide("s", "n").alias("mean"), F.sqrt(F.try_divide("q", "n")).alias("rms"), "max_abs")
