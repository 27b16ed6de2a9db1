"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.llm import alignment, cdc, decontam, langid, lexical, minmax, mixing, quality, sharding, suffixes, tokencounts, tokenfile, urlfilter
from voxelflux.llm.inputs import scratch, table, tokenizer
from voxelflux.llm.store import settle


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are judged by rules mined from labelled URLs; a page's label is that of the document it shows."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    shown = pages.select("url", F.expr("try_cast(regexp_extract(url, '/[a-z]+/([0-9]+)', 1) AS BIGINT)").alias("doc_id"))
    labelled = shown.join(labels, "doc_id").select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urlfilter.judge(pages, labelled)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in with estimated counts, are revised to exact ones, and toxic ones are deleted again.

    The batch of revisions is then applied once more, which must change nothing.
    """
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rollup = tokencounts.Rollup(spark, scratch(spark, "rollup"))
    exact = {v: tokencounts.count(F.col("text"), v).alias(v) for v in tokencounts.TOKENIZERS}
    slim = docs.select("doc_id", "source", "lang", F.floor(F.coalesce("n_chars", F.lit(0)) / 5).alias("guess"), *exact.values())
    slim = settle(slim, "counted")  # texts are read once; what follows moves no text
    toxic = slim.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")

    def batch(rows: DataFrame, op: str) -> DataFrame:
        out = None
        for version in tokencounts.TOKENIZERS:
            new, old = {"insert": ("guess", None), "revise": (version, "guess"), "delete": (version, None)}[op]
            part = tokencounts.changes(rows, op, version, F.col(f"`{new}`"), F.col(old) if old else None)
            out = part if out is None else out.unionByName(part)
        return out

    for batch_id, rows, op in (("1-load", slim, "insert"), ("2-exact", slim, "revise"), ("3-toxic", toxic, "delete"), ("2-exact", slim, "revise")):
        rollup.apply(batch_id, batch(rows, op))
    return rollup.totals()


def op5_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = scratch(spark, "tokens")
    shards = tokenfile.write(table(spark, sf_dir, "documents"), uri, tokenizer())
    return tokenfile.read(shards, uri)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.fold(F.col("doc_id")) == 2
    model = langid.train(docs.where(F.coalesce(~held_out, F.lit(True))))
    return langid.predict(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op10_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.repeated_spans(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), tokenizer(), tokenizer("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of about the same bytes; documents of one text stay together."""
    placed = sharding.balanced(table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_url_rules, op2_suffix_dedup, op3_mix_sources, op4_token_rollups, op5_benchmark_overlaps, op6_token_files, op7_language, op8_near_duplicates, op9_quality, op10_repeated_spans, op11_ranked_search, op12_token_alignment, op13_shards)}

ORACLES = {
    "op4_token_rollups": r"""
WITH kept AS (SELECT * FROM documents WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)),
counted AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM kept
  UNION ALL
  SELECT source, lang, 'words-2', len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D.,;:!?]+|[.,;:!?]')) FROM kept)
SELECT source, lang, tokenizer, count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens FROM counted GROUP BY ALL
""",
    "op11_ranked_search": r"""
WITH found AS (
  SELECT row_number() OVER () AS doc, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tfs AS (SELECT doc, doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
sizes AS (SELECT doc, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc),
whole AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM sizes),
dfs AS (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
query AS (SELECT item_id, term, count(*)::BIGINT AS q FROM asked GROUP BY ALL),
scored AS (
  SELECT item_id, doc, doc_id, sum(q * floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // l))))::BIGINT AS score
  FROM query JOIN tfs USING (term) JOIN dfs USING (term) JOIN sizes USING (doc), whole GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
