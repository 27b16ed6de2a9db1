"""An append-only ledger of tile events and its latest-state view.

Nothing is updated in place: planning, attempts and verification append events, and the state is what the last
event of a key says. Attempts are counted, and an event without a digest keeps the one before. folded() keeps of any number of
events what their state needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT = "key string, seq long, event string, sha256 string, byte_count long"


def latest(events: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Last values of each key. max_by keeps one row a key and combines on the map side; no window sort is needed."""
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("last")
    return events.groupBy(*keys).agg(last).select(*keys, "last.*")


FOLDED = f"{EVENT}, attempts long"


def counted(events: DataFrame) -> DataFrame:
    """EVENT rows as FOLDED rows: an event counts as an attempt or not."""
    return events.select("key", "seq", "event", "sha256", "byte_count", (F.col("event") == "fetching").cast("long").alias("attempts"))


def folded(events: DataFrame) -> DataFrame:
    """FOLDED rows with the same state() as events, whatever is added later: for each key its last event with all attempts, and
    its last event with a digest."""
    has = F.col("sha256").isNotNull()
    order = F.struct("seq", "event")
    whole = F.struct("seq", "event", "sha256", "byte_count")
    out = events.groupBy("key").agg(F.max_by(whole, order).alias("last"), F.max_by(F.when(has, whole), F.when(has, order)).alias("told"), F.sum("attempts").alias("attempts"))
    rows = F.array(F.struct("last.*", "attempts"), F.struct("told.*", F.lit(0).cast("long").alias("attempts")))
    return out.select("key", F.inline(rows)).where("event is not null").distinct()


def state(events: DataFrame) -> DataFrame:
    """(key, status, attempts, sha256, byte_count) of EVENT or FOLDED rows: planned, fetching, verified, failed."""
    events = events if "attempts" in events.columns else counted(events)
    order = F.struct("seq", "event")
    digest = F.max_by(F.when(F.col("sha256").isNotNull(), F.struct("sha256", "byte_count")), F.when(F.col("sha256").isNotNull(), order))
    out = events.groupBy("key").agg(F.max_by("event", order).alias("status"), F.sum("attempts").alias("attempts"), digest.alias("d"))
    return out.select("key", "status", "attempts", F.col("d.sha256").alias("sha256"), F.col("d.byte_count").alias("byte_count"))


def planned(ledger: DataFrame, plan: DataFrame, seq: int) -> DataFrame:
    """Events to append for a plan (key): keys that the ledger lacks. Planning twice appends nothing."""
    known = ledger.select("key").distinct()
    return plan.join(known, "key", "left_anti").select("key", F.lit(seq).cast("long").alias("seq"), F.lit("planned").alias("event"), F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("long").alias("byte_count"))


def to_fetch(plan: DataFrame, states: DataFrame, stored: DataFrame) -> DataFrame:
    """Keys of a plan (key) that still have to be fetched: not verified in state(), or stored (key, sha256) with another
    digest or not at all."""
    good = states.where("status = 'verified'").select("key", "sha256").join(stored.select("key", "sha256"), ["key", "sha256"])
    return plan.select("key").distinct().join(good, "key", "left_anti")


def lookup(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys a table names."""
    return rows.join(wanted.select(*keys).distinct(), keys, "left_semi")


def current(reports: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, entries, current): whether all digests that a manifest (keys, sha256) has for a report (keys, sha256) are the
    report's own; a report without an entry is not current."""
    said = manifest.select(*keys, F.col("sha256").alias("said"))
    return reports.join(said, keys, "left").groupBy(*keys).agg(F.count("said").alias("entries"), F.coalesce(F.bool_and(F.col("said") == F.col("sha256")), F.lit(False)).alias("current"))


def progress(states: DataFrame, group: list[str], status: Column) -> DataFrame:
    """Counts by status with a total row (status null) for each group."""
    rolled = states.select(*group, status.alias("status")).groupBy(*group, "status").count().withColumnRenamed("count", "n")
    total = rolled.groupBy(*group).agg(F.sum("n").alias("n")).withColumn("status", F.lit(None).cast("string"))
    return rolled.unionByName(total.select(*group, "status", "n"))


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of child whose keys no parent row has."""
    return child.join(parent.select(*keys), keys, "left_anti")


def snapshots(events: DataFrame) -> DataFrame:
    """(dataset, time_index, status, manifest_hash, created, updated) of events (dataset, time_index, seq, status,
    manifest_hash): the last status and the last hash that is not null, so planning again keeps both."""
    said = lambda c: F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col("seq")))
    return events.groupBy("dataset", "time_index").agg(said("status").alias("status"), said("manifest_hash").alias("manifest_hash"), F.min("seq").alias("created"), F.max("seq").alias("updated"))


def with_progress(snapshot_rows: DataFrame, tile_states: DataFrame, keys: list[str], done: str = "verified") -> DataFrame:
    """Snapshots with the number of their tiles and of those done; snapshots without tiles have 0 of both."""
    counts = tile_states.groupBy(*keys).agg(F.count(F.lit(1)).alias("tiles"), F.count_if(F.col("status") == done).alias("done"))
    return snapshot_rows.join(counts, keys, "left").fillna(0, ["tiles", "done"])
