"""From raw documents to token files: the stages of voxelflux.llm in order, each over all that the one before kept.

Every row is a document of its own, also without doc_id or under one that another row has; columns beyond those of
documents stay with their rows, whatever their names; an empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxelflux.llm import decontam, langid, minmax, mixing, tokenfile
from voxelflux.llm.inputs import scratch, table, tokenizer
from voxelflux.llm.store import settle


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; the model is learnt from a bounded sample of the rows with a language.

    Null and empty texts and texts without letters go; with no row that has a language, all go.
    """
    return langid.identified(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more.

    It is one with the smallest doc_id of the group; of repeated rows one stays. Documents without words stay.
    """
    return minmax.one_of_each(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item; each row is judged by its own text, null texts stay."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 1, 2, 3 in turn, none is taken more than three times.

    A null source is one of its own; documents without words are not taken.
    """
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold of each document; a null text is its end id alone."""
    uri = scratch(spark, "mix")
    return tokenfile.read(tokenfile.write(docs, uri, tokenizer()), uri)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: Language models, hash signatures and byte-pair encoding have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
