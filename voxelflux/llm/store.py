"""Intermediate tables in the folder that driver and executors share, and what a session needs for Arrow functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from voxelflux.session import shared_dir, ship


def prepare(spark: SparkSession) -> SparkSession:
    """Code to the executors, and smaller Arrow batches than Spark's 10,000 rows, as texts are long."""
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame under spark.checkpoint.dir and read it back: lineage ends here and lost executors lose nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
