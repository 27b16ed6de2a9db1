"""Velocity fields by formula on spark.range, and fields that lie in tables of arrays."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def grid(spark: SparkSession, n: int, time_index: int = 1, partitions: int | None = None) -> DataFrame:
    """All points of an n * n * n grid: time_index, z, y, x."""
    i = F.col("id")
    rows = spark.range(0, n**3, 1, partitions) if partitions else spark.range(n**3)
    return rows.select(F.lit(time_index).alias("time_index"), F.floor(i / (n * n)).cast("int").alias("z"), (F.floor(i / n) % n).cast("int").alias("y"), (i % n).cast("int").alias("x"))


def _angles(n: int) -> dict[str, Column]:
    return {a: F.col(a) * F.lit(2 * math.pi / n) for a in "xyz"}


def taylor_green(n: int) -> dict[str, Column]:
    a = _angles(n)
    return {"ux": F.sin(a["x"]) * F.cos(a["y"]), "uy": -F.cos(a["x"]) * F.sin(a["y"]), "uz": F.lit(0.0)}


def compressible(n: int) -> dict[str, Column]:
    return {"ux": F.sin(_angles(n)["x"]), "uy": F.lit(0.0), "uz": F.lit(0.0)}


def abc(n: int, a: float = 1.0, b: float = 0.7, c: float = 0.43) -> dict[str, Column]:
    t = _angles(n)
    return {
        "ux": a * F.sin(t["z"]) + c * F.cos(t["y"]), "uy": b * F.sin(t["x"]) + a * F.cos(t["z"]), "uz": c * F.sin(t["y"]) + b * F.cos(t["x"]),
    }


def triad(n: int) -> dict[str, Column]:
    """Divergence-free with a net forward flux: the curl of three waves."""
    t = _angles(n)
    x, y, z = t["x"], t["y"], t["z"]
    wave = y + z + 0.3, x + y + z + 0.9, x + y + z + 0.2, y + z + 0.4
    return {
        "ux": 0.3 * F.cos(wave[3]) + 0.5 * F.sin(wave[2]),
        "uy": -0.5 * F.sin(wave[0]) + 0.4 * F.cos(wave[1]) + 0.8 * F.sin(x + 0.7),
        "uz": 0.6 * F.cos(x + 1.1) - 0.5 * F.sin(wave[2]) + 0.5 * F.sin(wave[0]) - 0.4 * F.cos(wave[1]),
    }


def velocity(spark: SparkSession, n: int, field: dict[str, Column], kind: str = "double") -> DataFrame:
    return grid(spark, n).select("time_index", "z", "y", "x", *(v.cast(kind).alias(c) for c, v in field.items()))


def cubes(vectors: DataFrame, side: int = 4) -> DataFrame:
    """Snapshots from a table (vec_id, embedding): three consecutive vectors of side**3 values are the components
    of one snapshot. Snapshots that lack a component are left out. One exchange, on the snapshot."""
    t = F.floor(F.col("vec_id") / 3).cast("int")
    three = vectors.groupBy(t.alias("time_index")).agg(*(F.max(F.when(F.col("vec_id") % 3 == i, F.col("embedding"))).alias(c) for i, c in enumerate(("ux", "uy", "uz"))))
    point = three.where("ux is not null and uy is not null and uz is not null").select("time_index", F.posexplode(F.arrays_zip("ux", "uy", "uz")).alias("i", "u"))
    q, s = F.col("i"), side
    return point.select("time_index", F.floor(q / (s * s)).cast("int").alias("z"), (F.floor(q / s) % s).cast("int").alias("y"), (q % s).cast("int").alias("x"), *(F.col(f"u.{c}").cast("double").alias(c) for c in ("ux", "uy", "uz")))


def flux(lineitem: DataFrame) -> DataFrame:
    """Energy fields from an order table: signed values for which all four quadrants are met."""
    c = F.col
    return lineitem.select("l_orderkey", "l_partkey", "l_suppkey", (c("l_extendedprice") - 50000).alias("pi"), (c("l_quantity") - 25.5).alias("work_full"), (c("l_discount") - 0.05).alias("work_resolved"))
