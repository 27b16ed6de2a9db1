"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every document of a shuffled source gets a virtual finish time: the source's cumulative words up to and
with the document, divided by the source's target. Sorted by finish time over all sources and cut at the
budget, each source has given about its target. A source whose target exceeds its size starts again with
its first document (an epoch), at most `most` times.

A row's place in its source follows from 128 hash bits of its doc_id and text. Rows that agree in both, such as those of one
text without doc_id, stand in one place as a run of n rows, counted before anything is shuffled by key: a run has one finish
time for each of its rows, by arithmetic, and no window or task sees its rows one by one but for those in the slot in which
the budget ends. So no source is gathered in one task, and no run either: cumulative words come from sums by
(source, hash range) and a window inside each hash range. The cut of a source is one place and a number of rows of the run
there; rows are judged where they lie, by a join with one row for each source. Only where a cut falls inside a run its rows
are numbered, in blocks.

Defined cases: null text has size 0, null source is a source of its own and sorts last, size 0 is never taken, an empty table
gives no rows; rows without doc_id or under a shared one are documents of their own, and of equal rows any may be taken once
more than the others; other columns of any name are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelflux.llm.store import settle

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_RANGE = 50_000
#: Rows of a block in which equal rows at a cut are numbered.
BLOCK_BITS = 14


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row for each source: sid, src, source_size, n_docs, target.

    Shares of all words by weight, none above `most` times its source's size; the excess is shared again by
    weight. That is one water level: with sources sorted by (cap / weight), the level is the largest of
    (words left after the caps before) / (weights from here on). The windows run over one row a source.
    """
    by_name, by_cap = Window.orderBy(F.col("src").asc_nulls_last()), Window.orderBy("ratio", "sid")
    everything = Window.partitionBy(F.lit(1))
    cap = F.col("source_size") * F.lit(most)
    return (
        sized.groupBy("src")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("sid", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") - 1) % len(weights) + 1))
        .withColumn("ratio", cap / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("from_here", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", F.max((F.col("total") - F.col("before")) / F.col("from_here")).over(everything))
        .select("sid", "src", "source_size", "n_docs", F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"))
    )


def cuts(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """targets() with the last instance taken from each source: end (epoch, h, h2, size, i, n), null for none; i of the n rows at
    that place are taken in that epoch."""
    shares = targets(sized, weights, most).cache()
    n_docs, budget = shares.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    n = max(64, -(-n_docs // rows_per_range))
    span = F.floor((F.col("h").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64) * F.lit(n)).cast("long")
    runs = sized.where("size > 0").groupBy("src", "h", "h2", "size").agg(F.count(F.lit(1)).alias("n"))  # equal rows are one run
    own = runs.join(shares.drop("n_docs"), runs.src.eqNullSafe(shares.src)).drop("src").withColumn("span", span).withColumn("words", F.col("size") * F.col("n"))
    spans = own.groupBy("sid", "span").agg(F.sum("words").alias("words")).select(
        "sid", "span", F.coalesce(F.sum("words").over(Window.partitionBy("sid").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    upto = F.sum("words").over(Window.partitionBy("sid", "span").orderBy("h", "h2", "size"))
    # row i of a run (from 1) in an epoch ends at base + i * size words of its source; slots are ranges of finish times
    epochs = (
        own.withColumn("upto", upto).join(spans, ["sid", "span"])
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("base", F.col("before") + F.col("upto") - F.col("words") + F.col("epoch") * F.col("source_size"))
        .where((F.col("base") + F.col("size") < 2 * F.col("target")) | (F.col("epoch") == 0))
    )
    slot_of = lambda i: F.least(F.floor((F.col("base") + i * F.col("size")) / F.col("target") * n / 2), F.lit(n - 1))
    last_in = lambda s: F.when(s >= n - 1, F.col("n")).otherwise(F.least(F.floor(((s + 1) * 2 / F.lit(n) * F.col("target") - F.col("base")) / F.col("size")).cast("long"), F.col("n")))
    queued = (
        epochs.withColumn("slot", F.explode(F.sequence(slot_of(F.lit(1)), slot_of(F.col("n")))))
        .withColumn("from", F.when(F.col("slot") == slot_of(F.lit(1)), F.lit(0)).otherwise(last_in(F.col("slot") - 1)))
        .withColumn("to", F.when(F.col("slot") == slot_of(F.col("n")), F.col("n")).otherwise(last_in(F.col("slot"))))
        .where(F.col("to") > F.col("from"))
        .select("sid", "epoch", "h", "h2", "size", "n", "base", "target", "slot", "from", "to")
    )
    queued = settle(queued, "mix-queue")  # read by the search for the slot, and by both sides of it
    place = Window.orderBy("slot")
    crossing = (
        queued.groupBy("slot").agg(F.sum(F.col("size") * (F.col("to") - F.col("from"))).alias("words"))
        .withColumn("sofar", F.sum("words").over(place))
        .where(F.col("sofar") > budget).orderBy("slot").select("slot", F.col("sofar") - F.col("words")).first()
    )
    taken = queued.select("sid", "slot", F.struct("epoch", "h", "h2", "size", F.col("to").alias("i"), "n").alias("end"))
    if crossing:  # only the slot in which the budget ends needs its rows in order, one by one
        order = ["finish", "sid", "epoch", "h", "h2", "size", "i"]
        running = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + F.lit(crossing[1])
        each = queued.where(F.col("slot") == crossing[0]).withColumn("i", F.explode(F.sequence(F.col("from") + 1, F.col("to"))))
        each = each.withColumn("finish", (F.col("base") + F.col("i") * F.col("size")) / F.col("target"))
        last = each.withColumn("sofar", running).where(F.col("sofar") <= budget).select("sid", "slot", F.struct("epoch", "h", "h2", "size", "i", "n").alias("end"))
        taken = taken.where(F.col("slot") < crossing[0]).unionByName(last)
    ends = taken.groupBy("sid").agg(F.max("end").alias("end"))
    return shares.join(ends, "sid", "left").select("src", "source_size", "target", "end")


def _keys(seed: int) -> list[Column]:
    size = words(F.col("text"))
    text = F.xxhash64("text")
    return [F.col("source").alias("src"), size.alias("size"), F.xxhash64(F.lit(seed), "doc_id", text).alias("h"), F.xxhash64(F.lit(seed + 1), "doc_id", text).alias("h2")]


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 7, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for every row of docs (doc_id, source, text)."""
    sized = docs.select("doc_id", *_keys(seed)).cache()  # word counts are needed for totals, ranges and cut; a lost block is computed again
    ends = settle(cuts(sized, weights, most, rows_per_range), "mix-cuts")  # one row a source
    return _judged(sized, ends, ["doc_id", "size"]).select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _judged(rows: DataFrame, ends: DataFrame, kept: list[str]) -> DataFrame:
    """kept columns of rows with source_size, target and copies."""
    place = F.struct("h", "h2", "size")
    cut = F.struct(F.col("end.h").alias("h"), F.col("end.h2").alias("h2"), F.col("end.size").alias("size"))
    nothing = F.col("end").isNull() | (F.col("size") == 0)
    upto = F.when(place < cut, 1).when(place > cut, 0).when(F.col("end.i") == F.col("end.n"), 1)  # null: inside a run that is cut
    joined = rows.join(ends, rows.src.eqNullSafe(ends.src)).drop(ends.src)
    judged = joined.withColumn("upto", F.when(nothing, 0).otherwise(upto)).withColumn("epoch", F.when(nothing, 0).otherwise(F.col("end.epoch")))
    wanted = [*kept, "source_size", "target", (F.col("epoch") + F.col("upto")).alias("copies")]
    if not ends.where("end.i < end.n").isEmpty():
        tied = settle(judged.where("upto is null").select(*kept, "src", "source_size", "target", "epoch", F.col("end.i").alias("i"), F.monotonically_increasing_id().alias("place")), "mix-tied")
        tied = tied.withColumn("block", F.shiftright("place", BLOCK_BITS))
        sofar = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        before = tied.groupBy("src", "block").agg(F.count(F.lit(1)).alias("m")).select(F.col("src").alias("of"), "block", F.coalesce(F.sum("m").over(sofar), F.lit(0)).alias("before"))
        inside = F.row_number().over(Window.partitionBy("src", "block").orderBy("place"))
        numbered = tied.withColumn("inside", inside).withColumnRenamed("block", "own")
        numbered = numbered.join(before, numbered.src.eqNullSafe(before.of) & (F.col("own") == F.col("block")))
        numbered = numbered.withColumn("upto", (F.col("before") + F.col("inside") <= F.col("i")).cast("int"))
        return judged.where("upto is not null").select(*wanted).unionByName(numbered.select(*wanted))
    return judged.select(*wanted)


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself: the rows of docs with all their columns, each as often as the mix takes it."""
    slim = docs.select(*_keys(seed)).cache()
    ends = settle(cuts(slim, weights, most), "mix-cuts")
    judged = _judged(docs.select(*_keys(seed), F.struct("*").alias("row")), ends, ["row"])
    return judged.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
