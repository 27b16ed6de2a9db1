"""Sharding by best-fit-decreasing bin packing of groups of equal texts.

A group is all rows of one text and is never split. Groups are packed largest first, each into the open shard with the
least room that still takes it; the rooms lie in a balanced tree, so a placement costs a logarithm of the open shards.
`balanced()` fills a given number of shards about equally: the least capacity at which best-fit-decreasing needs no more
of them. `packed()` fills shards of a given capacity and needs few of them.

No task sees all groups. A group of more than 1/GRAIN of a shard is an item of its own, of which there are at most
shards * GRAIN; all lighter groups are summed by hash into items of about 1/GRAIN of a shard, so what is packed in one
place is at most 2 * shards * GRAIN rows of two numbers, whatever the corpus. `packed()` deals groups to lanes of LANE
shards and packs the lanes side by side. Row counts and places in a shard are sums by blocks of rows.

Defined cases: null text counts as empty and groups with it; a group larger than a shard's share (or its capacity) has a
shard of its own and the others share the rest; with fewer groups than shards some stay empty; an empty table gives no
rows; null and repeated doc_ids are rows like others; other columns of any name are ignored or left alone.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelflux.llm.store import prepare, settle

#: Items a shard is made of at least, and shards that are packed together.
GRAIN, LANE = 1024, 64
#: Rows of a block within which places are counted by a window.
BLOCK_BITS = 14
#: Items up to which their table is sent to every task: 16 bytes each.
SENT = 1 << 18


class Rooms:
    """What is left in each open bin, in order: a B-tree of two levels, whose leaves are parted at 2 * WIDTH keys."""

    WIDTH = 256

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.tops: list[tuple[int, int]] = []  # the highest key of every leaf but the last

    def add(self, room: int, of: int) -> None:
        i = bisect_left(self.tops, (room, of))
        leaf = self.leaves[i]
        leaf.insert(bisect_left(leaf, (room, of)), (room, of))
        if len(leaf) > 2 * self.WIDTH:
            self.leaves.insert(i + 1, leaf[self.WIDTH :])
            del leaf[self.WIDTH :]
            self.tops.insert(i, leaf[-1])

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the bin with the least room of need or more."""
        i = bisect_left(self.tops, (need, -1))
        while i < len(self.leaves):
            leaf = self.leaves[i]
            j = bisect_left(leaf, (need, -1))
            if j < len(leaf):
                found = leaf.pop(j)
                if not leaf and len(self.leaves) > 1:
                    del self.leaves[i]
                    del self.tops[min(i, len(self.tops) - 1)]
                return found
            i += 1
        return None


def best_fit(sizes: np.ndarray, capacity: int, most: int | None = None) -> np.ndarray | None:
    """The bin of each of sizes (in falling order); None if more than most bins are needed. A size beyond capacity has a bin alone."""
    rooms, bins, out = Rooms(), 0, np.empty(len(sizes), np.int64)
    for i, size in enumerate(sizes.tolist()):
        found = rooms.tightest(size)
        if found is None:
            if bins == most:
                return None
            found = (max(capacity, size), bins)
            bins += 1
        rooms.add(found[0] - size, found[1])
        out[i] = found[1]
    return out


def equal_bins(sizes: np.ndarray, count: int) -> np.ndarray:
    """The bin of each of sizes (in falling order), none of count bins larger than it must be for this method."""
    total, alone = int(sizes.sum()), 0
    while alone < min(len(sizes), count - 1) and int(sizes[alone]) * (count - alone) > total:
        total -= int(sizes[alone])
        alone += 1
    rest, left = sizes[alone:], count - alone
    if not len(rest):
        return np.arange(alone)
    low = max(int(rest[0]), -(-total // left))
    high, packing = low, best_fit(rest, low, left)
    step = max(1, low >> 10)
    while packing is None:
        low, high = high + 1, high + step
        step *= 2
        packing = best_fit(rest, high, left)
    while low < high:
        middle = (low + high) // 2
        found = best_fit(rest, middle, left)
        if found is None:
            low = middle + 1
        else:
            high, packing = middle, found
    return np.concatenate([np.arange(alone), packing + alone])


def _group() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, grp, place) of every row, written once; place is the row's number among all that were written."""
    prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    size, crc = (F.octet_length(text) + 1).cast("long"), F.crc32(text.cast("binary"))
    return settle(docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), _group().alias("grp"), F.monotonically_increasing_id().alias("place")), "sized")


def _items(rows: DataFrame, share: int, shards: int, lanes: int) -> tuple[DataFrame, DataFrame]:
    """Heavy groups (grp, lane, size) and light items (lane, light, size) of a corpus in shards of about share."""
    groups = settle(rows.groupBy("grp").agg(F.sum("size").alias("size")).withColumn("lane", F.pmod(F.xxhash64(F.lit(1), "grp"), F.lit(lanes))), "groups")
    heavy = groups.where(F.col("size") * GRAIN > share)
    light = groups.where(F.col("size") * GRAIN <= share).groupBy("lane", _light(shards, lanes)).agg(F.sum("size").alias("size"))
    return heavy, light


def _light(shards: int, lanes: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), "grp"), F.lit(max(1, -(-shards // lanes)) * GRAIN)).alias("light")


def _pack(rows: DataFrame, share: int, shards: int, lanes: int, pack) -> tuple[DataFrame, int]:
    """(grp, lane, light, bin) of all items, a bin's number being its lane's own, and the number of items."""
    heavy, light = _items(rows, share, shards, lanes)
    nothing = F.lit(None).cast("long")
    items = heavy.select("grp", "lane", nothing.alias("light"), "size").unionByName(light.select(nothing.alias("grp"), "lane", "light", "size"))

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("size", "descending"), ("grp", "ascending"), ("light", "ascending")])
        return part.drop_columns("size").append_column("bin", pa.array(pack(part.column("size").to_numpy())))

    placed = settle(items.groupBy("lane").applyInArrow(run, "grp long, lane long, light long, bin long"), "placed")
    return placed, placed.count()


def _placed(rows: DataFrame, placed: DataFrame, n_items: int, shards: int, lanes: int) -> DataFrame:
    """rows (with grp) and the lane and bin of their item."""
    near = F.broadcast if n_items <= SENT else (lambda df: df)
    heavy = placed.where("grp is not null").select("grp", F.col("bin").alias("own"))
    light = placed.where("light is not null").select("lane", "light", F.col("bin").alias("shared"))
    rows = rows.withColumn("lane", F.pmod(F.xxhash64(F.lit(1), "grp"), F.lit(lanes))).withColumn("light", _light(shards, lanes))
    joined = rows.join(near(heavy), "grp", "left").join(near(light), ["lane", "light"], "left")
    return joined.withColumn("bin", F.coalesce("own", "shared")).drop("own", "shared", "light")


def slots(rows: DataFrame) -> DataFrame:
    """rows (with shard and place) and slot: their number in the shard from 0, in the order of place.

    Blocks of places hold at most 2 ** BLOCK_BITS rows, so no window grows with a shard; one row a block and shard is summed.
    """
    rows = rows.withColumn("block", F.shiftright("place", BLOCK_BITS))
    so_far = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select("shard", "block", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("place")) - 1
    return rows.withColumn("inside", inside).join(before, ["shard", "block"]).withColumn("slot", F.col("before") + F.col("inside")).drop("block", "inside", "before")


def _shares(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]


def balanced(docs: DataFrame, count: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row in one of count shards of about the same bytes."""
    rows = sized(docs)
    placed, n = _pack(rows, -(-_shares(rows) // count), count, 1, lambda sizes: equal_bins(sizes, count))
    return slots(_placed(rows, placed, n, count, 1).withColumn("shard", F.col("bin").cast("int"))).select("doc_id", "size", "text_crc32", "shard", "slot")


def packed(docs: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row in one of few shards of at most capacity bytes each."""
    rows = sized(docs)
    shards = max(1, -(-_shares(rows) // capacity))
    lanes = -(-shards // LANE)
    placed, n = _pack(rows, capacity, shards, lanes, lambda sizes: best_fit(sizes, capacity))
    firsts = placed.groupBy("lane").agg((F.max("bin") + 1).alias("bins")).select(
        "lane", F.coalesce(F.sum("bins").over(Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first")
    )  # one row a lane
    shard = (F.col("first") + F.col("bin")).cast("int")
    return slots(_placed(rows, placed, n, shards, lanes).join(firsts, "lane").withColumn("shard", shard)).select("doc_id", "size", "text_crc32", "shard", "slot")


def write(docs: DataFrame, uri: str, count: int = 8) -> DataFrame:
    """The rows of docs under uri, one folder a shard of balanced(); returns (shard, rows)."""
    rows = sized(docs)
    placed, n = _pack(rows, -(-_shares(rows) // count), count, 1, lambda sizes: equal_bins(sizes, count))
    full = _placed(docs.select(_group().alias("grp"), F.struct("*").alias("row")), placed, n, count, 1)
    full.select("row", F.col("bin").cast("int").alias("shard")).write.partitionBy("shard").option("compression", "zstd").parquet(uri)
    return docs.sparkSession.read.parquet(uri).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
