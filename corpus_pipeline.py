"""The corpus pipeline: language identification, exact and near deduplication, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's
documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import exact_dedup, langid, mixing, near_dedup, packing
from corpusloom.llm.shared import Scratch, tune, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what is no language: null texts and texts without a letter (``und``). All languages stay.

    Rows that repeat stay each; columns of any name are kept; an empty table, or one without a labelled text, gives an
    empty one. See :func:`langid.keep_known`.
    """
    tune(spark)
    return langid.keep_known(docs, langid.learn(docs.filter(~langid.held_out())))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest stays, then the one with the smallest doc_id.

    Null texts count as empty, and all empty texts as equal. Rows that repeat in full leave one; columns of any name
    are kept; an empty table gives an empty one. See :func:`exact_dedup.drop_exact_duplicates`.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays.

    Null and empty texts, and rows without a doc_id, are in no group and stay; of rows that share the smallest id of
    a group all stay. Columns of any name are kept; an empty table gives an empty one. See
    :func:`near_dedup.drop_near_duplicates`.
    """
    tune(spark)
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: up to three times, or not at all.

    A null source is a source of its own; texts without words have no weight. Rows that share an id share its copies.
    Columns of any name are kept; an empty table gives an empty one. See :func:`mixing.take_mix`.
    """
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents, repeated ones each; null and empty texts are one piece with the end token.

    Only doc_id and text are read; an empty table gives no pieces. See :func:`packing.cut` and :func:`packing.pack`.
    """
    tune(spark)
    return packing.pack(packing.cut(docs))


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

#: Neither language identification nor the random mix nor near-duplicates at scale can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        before = None
        for _, stage in STAGES[:-1]:
            docs = scratch(stage(spark, docs, sf_dir))
            if before is not None:
                scratch.drop(before)
            before = docs
        return written(STAGES[-1][1](spark, docs, sf_dir))
