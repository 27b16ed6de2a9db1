"""One number for each document, whatever its doc_id.

A document's number is its doc_id. A row without doc_id is a document of its own, and so is each further text under a
doc_id that has another text already (the one with the least hash keeps the id): these get a number from a hash of what
they hold, 2**62 or above, so they come after all ids below that. Rows that agree in doc_id and text share a number.
The number follows from the row alone, so a lost executor computes the same again and no group passes through one task.

Defined cases: null and empty texts under one doc_id are two texts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelflux.llm.store import settle

LATER = 1 << 62


def keys() -> list[Column]:
    """key and key2: hashes that name a row by its doc_id and text, 128 bits in all, wherever it is read."""
    return [F.xxhash64("doc_id", "text").alias("key"), F.xxhash64(F.lit(1), "doc_id", "text").alias("key2")]


def _later(h: Column) -> Column:
    return h.bitwiseAND(F.lit(LATER - 1)).bitwiseOR(F.lit(LATER))


def numbered(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc, doc_id, text, more) for each row of docs (doc_id, text); doc is the number."""
    h = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more).withColumn("doc", F.coalesce("doc_id", _later(h)))
    texts = rows.groupBy("doc").agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select(F.col("doc").alias("shared"), "lo")
    texts = settle(texts, "shared-ids")
    if not texts.isEmpty():
        own = F.when(F.col("lo") != h, _later(F.xxhash64(F.lit(1), "doc_id", "text"))).otherwise(F.col("doc"))
        rows = rows.join(texts, F.col("doc") == F.col("shared"), "left").withColumn("doc", own)
    return rows.select("doc", *(c for c in rows.columns if c not in ("doc", "shared", "lo")))


def repeated(rows: DataFrame) -> DataFrame:
    """(doc, n): the numbers that more than one of rows has, and how many have it."""
    return settle(rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-rows")


def one_each(rows: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """rows of numbered() without repeats of a number; again is what repeated() says of them."""
    again = repeated(rows) if again is None else again
    if again.isEmpty():
        return rows
    return rows.join(again, "doc", "left_anti").unionByName(rows.join(again, "doc", "left_semi").dropDuplicates(["doc"]))


#: Rows that one row of every_row() is spread to by one task.
PIECE = 10_000


def every_row(found: DataFrame, again: DataFrame) -> DataFrame:
    """What was found (doc, ...) for each number, once for each row that has it; many rows alike are spread over tasks."""
    if again.isEmpty():
        return found
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.coalesce("n", F.lit(1)) - 1) / PIECE))
    dealt = found.join(again, "doc", "left").withColumn("piece", F.explode(pieces)).repartition("doc", "piece")
    own = F.least(F.coalesce("n", F.lit(1)) - F.col("piece") * PIECE, F.lit(PIECE))
    return dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), own))).select(*found.columns)
