"""Session helpers: one place that says how a Spark session is configured and how code reaches executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def build(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings that the library assumes: UTC, AQE with skew splitting, zstd Parquet."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    builder = SparkSession.builder.master(master).appName("voxelflux")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once for each application, so Arrow functions can be imported there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="voxelflux-")) / "voxelflux_src.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, os.path.join("voxelflux", str(path.relative_to(root))))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temp folder where it is unset.

    Only a session on one machine gets a folder of its own; on a cluster the setting must be there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="voxelflux-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")
