"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes holds inserts, deletes and revised counts. It is summed to one signed row for each
(source, lang, tokenizer) before anything is stored, so storage and reads follow the number of groups,
not of documents. A batch is one folder, <root>/batch=<id>, written by Spark's committer; it counts once its
_SUCCESS file is there. Applying the same batch again changes nothing, and a batch whose write broke off is
written anew. Totals are the sum of the committed batches; compact() replaces them by one.

Changes: (op, source, lang, tokenizer, n_tokens, old_tokens); op is insert, delete or revise. An insert adds
a document and n_tokens, a delete takes them away, a revision adds n_tokens - old_tokens and no document.
Defined cases: null source and lang are groups of their own, null counts are 0, other ops raise an error, an
empty batch commits and adds nothing, repeated rows count as often as they stand there, other columns are
ignored. Groups whose documents and tokens both come to 0 are left out of the totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
#: Versions of the counting rule and the pattern each counts
TOKENIZERS = {"words-1": r"[^\x20\x09-\x0D]+", "words-2": r"[^\x20\x09-\x0D.,;:!?]+|[.,;:!?]"}


def count(text: Column, tokenizer: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")


def changes(docs: DataFrame, op: str, tokenizer: str, n_tokens: Column, old_tokens: Column | None = None) -> DataFrame:
    old = F.lit(0) if old_tokens is None else old_tokens
    return docs.select(F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), n_tokens.cast("long").alias("n_tokens"), old.cast("long").alias("old_tokens"))


def signed(batch: DataFrame) -> DataFrame:
    """One additive row for each group: (source, lang, tokenizer, docs, tokens)."""
    op, new, old = F.col("op"), F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    unknown = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null"))))
    docs = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(unknown.cast("int"))
    tokens = F.when(op == "insert", new).when(op == "delete", -new).when(op == "revise", new - old).otherwise(unknown.cast("long"))
    return batch.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("docs"), F.sum(tokens).cast("long").alias("tokens"))


class Rollup:
    """Totals under a root folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, tail: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{tail}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def committed(self, batch_id: str) -> bool:
        fs, path = self._path(f"batch={batch_id}/_SUCCESS")
        return fs.exists(path)

    def batches(self) -> list[str]:
        fs, path = self._path("")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch=") and self.committed(n.removeprefix("batch=")))

    def apply(self, batch_id: str, batch: DataFrame) -> bool:
        """Commit a batch; False if it was there already."""
        if self.committed(batch_id):
            return False
        signed(batch).write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")
        return True

    def totals(self) -> DataFrame:
        paths = [f"{self.root}/batch={b}" for b in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, docs long, tokens long")
        total = self.spark.read.parquet(*paths).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return total.where("docs <> 0 or tokens <> 0")

    def compact(self, batch_id: str, to: str) -> "Rollup":
        """The totals so far as the only batch of a new root; the old root stays until the caller drops it."""
        out = Rollup(self.spark, to)
        if not out.committed(batch_id):
            self.totals().write.mode("overwrite").parquet(f"{out.root}/batch={batch_id}")
        return out
