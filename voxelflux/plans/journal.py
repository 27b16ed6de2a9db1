"""A ledger on disk: a snapshot and what came after it, named by a version of sources.log.

append() writes a delta and puts a version that names it; compact() folds snapshot and deltas into a new snapshot and puts a
version that names that alone. What a version names is never changed, so a reader sees one version whatever is appended or
compacted meanwhile, and reads one snapshot and a short tail however many events there were. Two drivers may append at once:
one is first, the other puts its delta on top.

Defined cases: a journal without a version has no events; an event that comes late (with a lower seq) has the same effect
before and after compaction; compacting twice changes nothing; empty appends make no version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from voxelflux.operators import ledger
from voxelflux.sources.log import Log


class Journal:
    #: Deltas after which append() compacts.
    TAIL = 16

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri.rstrip("/")
        self.log = Log(spark, f"{self.uri}/log")

    def events(self, version: int | None = None) -> DataFrame:
        """The events of a version, the latest by default, folded as far as its snapshot goes."""
        now = self.log.entry(version) if version else self.log.latest()[1]
        parts = [now["base"]] if now.get("base") else []
        parts += now.get("deltas", [])
        if not parts:
            return self.spark.createDataFrame([], ledger.FOLDED)
        return self.spark.read.schema(ledger.FOLDED).parquet(*(f"{self.uri}/{p}" for p in parts))

    def state(self) -> DataFrame:
        return ledger.state(self.events())

    def append(self, events: DataFrame) -> int:
        """Add EVENT rows; returns the version that has them."""
        name = f"delta-{uuid.uuid4().hex}"
        ledger.counted(events).coalesce(1).write.option("compression", "zstd").parquet(f"{self.uri}/{name}")
        if self.spark.read.schema(ledger.FOLDED).parquet(f"{self.uri}/{name}").isEmpty():
            self.log.delete(name)
            return self.log.latest()[0]
        n, now = self.log.change(lambda last: {"base": last.get("base"), "deltas": [*last.get("deltas", []), name]})
        if len(now["deltas"]) >= self.TAIL:
            n = self.compact()
        return n

    def compact(self) -> int:
        """Fold all events of the latest version; deltas that others append meanwhile stay in the tail."""
        n, now = self.log.latest()
        if not now.get("deltas"):
            return n
        name = f"base-{uuid.uuid4().hex}"
        ledger.folded(self.events(n)).write.option("compression", "zstd").parquet(f"{self.uri}/{name}")

        def on_top(last: dict) -> dict:
            if last.get("base") != now.get("base"):
                raise RuntimeError("another driver has compacted")  # its snapshot holds all that this one does
            return {"base": name, "deltas": [d for d in last["deltas"] if d not in now["deltas"]]}

        try:
            return self.log.change(on_top)[0]
        except RuntimeError:
            self.log.delete(name)
            return self.log.latest()[0]

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove datasets that none of the last `keep` versions names; call it when nobody reads older ones. Returns their names."""
        named = {x for n in self.log.numbers()[-keep:] for e in [self.log.entry(n)] for x in [e.get("base"), *e.get("deltas", [])] if x}
        gone = [x for x in self.log.listed() if x.startswith(("delta-", "base-")) and x not in named]
        for x in gone:
            self.log.delete(x)
        return gone
