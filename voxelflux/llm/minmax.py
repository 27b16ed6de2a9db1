"""Near duplicates by min-max hashing.

Each of `perms` hash permutations gives two signature values, its minimum and its maximum over a document's
shingles: half the hash evaluations of MinHash for as many values. Bands of two permutations (four values) put
documents into buckets. All links are confirmed on whole shingle sets.

 1. Rows with equal sets (a 128-bit set hash) become one class, so copies cost one row however many they are.
 2. A bucket of classes is searched from hubs: every class is compared with the one of its bucket that shares most
    buckets with others, so rows grow with classes and not with their pairs. Links give components.
 3. Only classes of a bucket that are not in its hub's component are left (strays). After `hub_rounds` such rounds
    they meet the rest of their bucket by what sets them apart from the first hub: if a stray is linked with another
    class, the two differ from the hub in common shingles, at least as many as the link and their sizes call for. So
    only the rarest of those shingles are joined (a prefix filter), and a crowd of loosely similar texts makes few
    pairs. No link between components is missed within a bucket, and links inside a component change nothing.

Links are confirmed on whole sets of shingles, each shingle as a hash of 64 bits.

Words are [^\\x20\\x09-\\x0D]+ with A-Z in lower case. Defined cases: every row is a document of its own, also rows
without doc_id and rows that share one, so they link nothing but by their text. component_id is the smallest doc_id of
a component, null if no row of it has one; then the first row is kept, else all rows with that doc_id. Documents without
words (null, empty) are linked with nothing and kept; fewer than k words are one shingle; an empty table gives no rows;
other columns are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelflux.llm import textnum as tn
from voxelflux.llm.components import components
from voxelflux.llm.identity import keys
from voxelflux.llm.store import prepare, settle

PERMS, BAND = 32, 2
NAMES = ["doc_id", "key", "key2"]
#: Two classes and the sizes of their sets.
PAIR = ["a", "b", "n_a", "n_b"]


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and the n + 1 offsets of the rows."""
    data, offsets = tn.raw(texts)
    starts, ends, rows = tn.words(data, offsets)
    h, owner = tn.shingles(tn.Hasher(tn.LOWER[data]).of(starts, ends), rows, k, len(texts))
    return tn.distinct(h, owner, len(texts))


def signatures(h: np.ndarray, at: np.ndarray, perms: int) -> np.ndarray:
    """Minimum and maximum of each permutation for each row with shingles: rows x perms x 2."""
    first = at[:-1][np.diff(at) > 0]
    out = np.zeros((len(first), perms, 2), np.uint64)
    for j in range(perms):
        p = h * np.uint64(pow(tn.BASE, 2 * j + 3, 1 << 64) | 1) + np.uint64(pow(tn.BASE, 2 * j + 4, 1 << 64))
        p ^= p >> np.uint64(29)
        out[:, j, 0] = np.minimum.reduceat(p, first)
        out[:, j, 1] = np.maximum.reduceat(p, first)
    return out


def _features(k: int, perms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch):
                h, at = shingle_sets(part.column("text"), k)
                size = np.diff(at)
                full = np.flatnonzero(size)
                bands = np.zeros((len(size), perms // BAND), np.uint64)
                if len(full):
                    values = signatures(h, at, perms).reshape(len(full), perms // BAND, 2 * BAND)
                    for j in range(values.shape[2]):
                        bands[full] = tn.mix(bands[full] + values[:, :, j])
                lists = pa.FixedSizeListArray.from_arrays(pa.array(bands.view(np.int64).reshape(-1)), perms // BAND).cast(pa.list_(pa.int64()))
                names = tn.binary(_keys(h, at).reshape(-1), np.arange(len(size) + 1) * 2)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in NAMES), pa.array(size.astype(np.int64)), names, lists], names=[*NAMES, "n", "set_key", "bands"])

    return run


def _keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 128-bit key of each row's set, whatever its order."""
    key = np.zeros((len(at) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        key[full, 0] = np.add.reduceat(tn.mix(h), at[:-1][full])
        key[full, 1] = np.add.reduceat(tn.mix(h ^ np.uint64(tn.BASE)), at[:-1][full])
    return key


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tn.slices(batch):
                h, at = shingle_sets(part.column("text"), k)
                names = tn.binary(_keys(h, at).reshape(-1), np.arange(len(at)) * 2)
                own = pc.equal(names, part.column("set_key"))  # another text under the same doc_id has another key
                yield pa.RecordBatch.from_arrays([part.column("c"), tn.binary(h, at)], names=["c", "shingles"]).filter(own)

    return run


def _common(whole: bool):
    """Shared shingles of left and right and, if whole is set, those in one of them only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            found, apart = np.zeros(batch.num_rows, np.int64), [b""] * batch.num_rows
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(x[i].as_buffer(), np.uint64) for x in (left, right))
                in_b = b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a if len(b) else np.zeros(len(a), bool)
                found[i] = np.count_nonzero(in_b)
                if whole:
                    in_a = a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b if len(a) else np.zeros(len(b), bool)
                    apart[i] = np.concatenate([a[~in_b], b[~in_a]]).tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in PAIR), pa.array(found), pa.array(apart, pa.binary())], names=[*PAIR, "common", "apart"])

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tn.raw(batch.column("apart"))
        lists = pa.ListArray.from_arrays(pa.array((offsets // 8).astype(np.int32)), pa.array(np.frombuffer(data.tobytes(), np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("hub"), batch.column("c"), batch.column("root"), lists], names=["hub", "c", "root", "apart"])


def _compared(pairs: DataFrame, sets: DataFrame, percent: int, whole: bool = False) -> DataFrame:
    """(a, b, n_a, n_b, linked, apart) for pairs (a, b, n_a, n_b) of classes and the sizes of their sets.

    Unless whole is set, pairs whose sizes rule a link out are left out and apart (shingles of one side only) is empty.
    """
    near = pairs if whole else pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    held = near.join(sets.select(F.col("c").alias("b"), F.col("shingles").alias("right")), "b")
    held = held.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("left")), "a")
    common = held.select(*PAIR, "left", "right").mapInArrow(_common(whole), "a long, b long, n_a long, n_b long, common long, apart binary")
    total = F.col("n_a") + F.col("n_b") - F.col("common")
    return settle(common.select(*PAIR, (F.col("common") * 100 >= total * percent).alias("linked"), "apart"), "compared")


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, perms: int = PERMS, hub_rounds: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text)."""
    return _judged(docs, k, percent, perms, hub_rounds).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, k: int, percent: int, perms: int, hub_rounds: int = 2) -> DataFrame:
    """near_duplicates() with the key, key2 and number of each row, and the number of its component (null without words)."""
    prepare(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys(), "text")
    features = slim.mapInArrow(_features(k, perms), "doc_id long, key long, key2 long, n long, set_key binary, bands array<long>")
    features = settle(features.withColumn("row", F.monotonically_increasing_id()), "features")
    firsts = features.where("n > 0").groupBy("set_key").agg(F.min("row").alias("row"), F.min("doc_id").alias("lowest"))
    classes = settle(features.join(firsts.select("row", "lowest"), "row").select(F.col("row").alias("c"), "set_key", "key", "lowest", "n", "bands"), "classes")

    banded = classes.select("c", "n", F.posexplode("bands").alias("band", "h"))
    crowds = banded.groupBy("band", "h").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    crowded = settle(banded.join(crowds, ["band", "h"]), "crowded")
    weight = crowded.groupBy("c").agg(F.sum("crowd").alias("weight"))
    members = settle(crowded.join(weight, "c").select("band", "h", "c", "n", "weight"), "members")
    members = settle(_with_hubs(members), "hubs")

    wanted = weight.select("c").join(classes, "c").select("c", "key", "set_key")
    texts = slim.select("key", "text").join(wanted, "key").select("c", "set_key", "text")
    sets = settle(texts.mapInArrow(_sets(k), "c long, shingles binary"), "sets")
    held, different = sets.agg(F.count(F.lit(1)), F.count_distinct("c")).first()
    if held > different:  # repeated rows
        sets = settle(sets.dropDuplicates(["c"]), "sets")

    first, roots, left = None, None, members
    for turn in range(hub_rounds):
        if turn and left.isEmpty():
            break
        pairs = (_with_hubs(left) if turn else left).where("c <> hub")
        pairs = pairs.select(F.col("hub").alias("a"), F.col("c").alias("b"), F.col("n_hub").alias("n_a"), F.col("n").alias("n_b")).distinct()
        compared = _compared(pairs, sets, percent, whole=turn == 0)
        first = first or compared
        linked = compared.where("linked").select("a", "b")
        if turn and linked.isEmpty():  # components and strays stay as they are
            break
        roots = settle(components(_with_links(roots, linked)), "roots")
        left = settle(_strays(members, roots), "strays")
    if not left.isEmpty():
        rest = settle(_across(first, roots, percent), "across")
        linked = _compared(rest, sets, percent).where("linked").select("a", "b")
        if not linked.isEmpty():
            roots = settle(components(_with_links(roots, linked)), "roots")

    if roots is None:
        ids = classes.select("set_key", "c", "lowest", F.col("c").alias("root"))
    else:
        ids = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").select("set_key", "c", "lowest", F.coalesce("root", "c").alias("root"))
    lowest = ids.groupBy("root").agg(F.min("lowest").alias("component_id"), F.min("c").alias("first"))
    named = ids.join(lowest, "root").select("set_key", "component_id", "first")
    out = features.join(named, "set_key", "left").withColumn("component_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.when(F.col("first").isNull(), True).when(F.col("component_id").isNull(), F.col("row") == F.col("first")).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"), "key", "key2", "row", "first")


def _with_hubs(members: DataFrame) -> DataFrame:
    """members (band, h, c, n, weight) with the hub of their bucket and the size of its set."""
    top = F.max(F.struct("weight", (-F.col("c")).alias("c"), "n")).alias("top")
    hubs = members.groupBy("band", "h").agg(top).select("band", "h", (-F.col("top.c")).alias("hub"), F.col("top.n").alias("n_hub"))
    return members.join(hubs, ["band", "h"])


def _with_links(roots: DataFrame | None, linked: DataFrame) -> DataFrame:
    """Edges of the components so far, which are stars, and further ones."""
    return linked if roots is None else roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(linked)


def _strays(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets that are not in the component of the bucket's hub."""
    own = roots.select(F.col("node").alias("c"), F.col("root").alias("root_c"))
    hub = roots.select(F.col("node").alias("hub"), F.col("root").alias("root_h"))
    joined = members.join(own, "c", "left").join(hub, "hub", "left")
    return joined.where(F.coalesce("root_c", "c") != F.coalesce("root_h", "hub")).select("band", "h", "c", "n", "weight")


def _across(first: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of a stray and another class of the same hub, in different components, that may be linked.

    Let D be the shingles that tell a set from its hub, n its size, and r = (100 - percent) / (100 + percent). Linked
    sets u and m differ in at most r * (n_u + n_m) shingles, and in |D_u| + |D_m| - 2 * |common part of D_u and D_m|,
    so the common part has at least half of |D_u| + |D_m| - r * (n_u + n_m). A stray has |D| > r * (n + n_hub), which
    bounds that from below for each set alone; it is never less than one shingle. Of sets with so much in common, the
    rarest |D| - least + 1 shingles of both, in the same order, have one in common. Each set's own bound says which of
    its shingles are joined; the bound of the pair, which is tighter, then holds for the ranks on both sides.
    """
    r = (100 - percent) / (100 + percent)
    own = roots.select(F.col("node").alias("b"), F.col("root").alias("root_c"))
    hub = roots.select(F.col("node").alias("a"), F.col("root").alias("root_h"))
    told = first.join(own, "b", "left").join(hub, "a", "left")
    told = told.select(F.col("a").alias("hub"), F.col("b").alias("c"), F.col("n_a").alias("n_hub"), F.col("n_b").alias("n"), F.coalesce("root_c", "b").alias("root"), F.coalesce("root_h", "a").alias("root_h"), "apart")
    told = told.withColumn("stray", F.col("root") != F.col("root_h")).withColumn("size", F.octet_length("apart") / 8)
    told = told.join(told.where("stray").select("hub").distinct(), "hub", "left_semi")
    least = F.when(F.col("stray"), (F.col("size") - r * F.col("n") * (1 + 100 / percent)) / 2).otherwise((F.col("size") + r * (F.col("n_hub") - F.col("n"))) / 2)
    marked = settle(told.withColumn("take", F.col("size") + 1 - F.greatest(F.ceil(least - 1e-9), F.lit(1))), "told")
    each = marked.select("hub", "c", "root", "apart").mapInArrow(_listed, "hub long, c long, root long, apart array<long>").select("hub", "c", "root", F.explode("apart").alias("e"))
    seen = each.groupBy("hub", "e").agg(F.count(F.lit(1)).alias("seen"), (F.min("root") < F.max("root")).alias("roots"))
    ranked = each.drop("root").join(seen, ["hub", "e"]).withColumn("rank", F.row_number().over(Window.partitionBy("hub", "c").orderBy("seen", "e"))).where("roots")
    kept = ranked.join(marked.select("hub", "c", "n", "size", "root", "stray", "take"), ["hub", "c"]).where("rank <= take")
    kept = settle(kept.select("hub", "e", "c", "n", "size", "rank", "root", "stray"), "prefixes")
    other = kept.select("hub", "e", *(F.col(c).alias(f"{c}2") for c in ("c", "n", "size", "rank", "root")))
    pair = F.greatest(F.ceil((F.col("size") + F.col("size2") - r * (F.col("n") + F.col("n2"))) / 2 - 1e-9), F.lit(1))
    able = (F.col("c") != F.col("c2")) & (F.col("root") != F.col("root2")) & (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent)
    able &= (F.col("rank") + pair <= F.col("size") + 1) & (F.col("rank2") + pair <= F.col("size2") + 1)
    low, high = (F.when(F.col("c") < F.col("c2"), F.struct(F.col(x).alias("c"), F.col(y).alias("n"))).otherwise(F.struct(F.col(z).alias("c"), F.col(w).alias("n"))) for x, y, z, w in (("c", "n", "c2", "n2"), ("c2", "n2", "c", "n")))
    found = kept.where("stray").join(other, ["hub", "e"]).where(able).select(low.alias("low"), high.alias("high"))
    return found.select(F.col("low.c").alias("a"), F.col("high.c").alias("b"), F.col("low.n").alias("n_a"), F.col("high.n").alias("n_b")).distinct()


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, perms: int = 48) -> DataFrame:
    """The rows of docs, with their own columns, that stand for their group: one row of each component, one with its smallest
    doc_id, and all rows without words.

    24 bands instead of 16, as at a similarity of 0.8 a band is shared less often than at 0.85.
    """
    judged = settle(_judged(docs, k, percent, perms).where("first is not null").select("key", "key2", "row", "first", "kept"), "judged")
    by_key = judged.groupBy("key", "key2").agg(F.count(F.lit(1)).alias("n"))
    stands = judged.where("kept").groupBy("first").agg(F.min("row").alias("row"))
    stands = judged.join(stands.select("row"), "row", "left_semi").select("key", "key2")
    gone = by_key.join(stands, ["key", "key2"], "left_anti").select("key", "key2")
    again = settle(by_key.where("n > 1").join(stands, ["key", "key2"], "left_semi").select("key", "key2"), "again")
    kept = docs.select(*keys(), F.struct("*").alias("packed")).join(gone, ["key", "key2"], "left_anti")
    if not again.isEmpty():  # rows that agree in doc_id and text
        kept = kept.join(again, ["key", "key2"], "left_anti").unionByName(kept.join(again, ["key", "key2"], "left_semi").dropDuplicates(["key", "key2"]))
    return kept.select("packed.*")
