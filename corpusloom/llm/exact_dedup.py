"""Exact deduplication with a heavy-hitter split, in DataFrame functions alone.

Every text is reduced to the SHA-256 of its normalised form (white space deleted), once, into a narrow table.
``freqItems`` (the Misra-Gries summary of Karp, Schenker and Papadimitriou) names every digest that more than
``support`` of the rows carry; at most ``1 / support`` counters exist, so the candidates can be broadcast. Their
exact counts and winners are found with map-side partial aggregates, verified against the support, and broadcast
back: rows of frequent digests never meet in one task. What is left has at most ``support`` of the rows in a
group and goes through ordinary shuffles of narrow rows, as partial aggregates and a join back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, beside, without_spaces, written

#: Digests above this share of the rows are removed map-side.
SUPPORT = 0.001


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, chars, row_ix) of every row; null text counts as empty. Other columns are not read."""
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.sha2(without_spaces(F.col(text_col)).cast("binary"), 256).alias("digest"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row_ix"),
    )


def _best() -> Column:
    """Most code points, then the smallest doc_id (null last), then the first row."""
    rank = F.struct("chars", F.col("doc_id").isNotNull(), F.bitwise_not(F.coalesce("doc_id", F.lit(0))), F.bitwise_not("row_ix"))
    return F.max_by(F.struct("doc_id", "row_ix"), rank)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, heavy.

    Of equal texts (equal once white space is deleted) the row with the most code points stays, then the
    smallest doc_id; a null doc_id comes last, and of rows that repeat in full exactly one stays. Null text is
    empty text, so all empty texts are one group. An empty table gives an empty result. ``doc_id`` must be a
    number; any other column, whatever its name, is ignored.
    """
    with Scratch(df.sparkSession) as scratch:
        narrow = scratch(fingerprints(df, id_col, text_col))
        n = narrow.count()
        summary = narrow.stat.freqItems(["digest"], max(support, 1e-4))
        candidates = summary.select(F.explode(F.array_distinct("digest_freqItems")).alias("digest"))  # at most 1 / support rows
        winners = narrow.join(F.broadcast(candidates), "digest").groupBy("digest").agg(_best().alias("best"), F.count(F.lit(1)).alias("group_size"))
        winners = scratch(winners.filter(F.col("group_size") > support * n))  # verified: fewer than 1 / support rows
        heavy = narrow.join(F.broadcast(winners), "digest").withColumn("heavy", F.lit(True))
        light = narrow.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        # no group is held: partial aggregates, and a join back that needs no room for a group
        found = light.groupBy("digest").agg(_best().alias("best"), F.count(F.lit(1)).alias("group_size"))
        light = light.hint("merge").join(found.hint("merge"), "digest").withColumn("heavy", F.lit(False))
        return written(
            heavy.unionByName(light).select(
                "doc_id",
                F.col("best.doc_id").alias("keep_id"),
                "group_size",
                (F.col("row_ix") == F.col("best.row_ix")).alias("kept"),
                F.col("digest").alias("text_sha256"),
                "heavy",
            )
        )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``df`` that stay, all columns; null and empty texts are one group, of which one row stays.

    Rows are found again by id, in one join that moves whole rows once; an id that several rows share, of which some
    go, is settled by id and digest, and of rows that repeat in full one stays. An empty table gives an empty one.
    """
    decided = exact_groups(df, id_col, text_col, support)
    ids = decided.groupBy(F.col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("__n"), F.count_if("kept").alias("__stay"))
    ids = written(ids.filter("__stay > 0"))
    out = beside(df, ids, df[id_col].eqNullSafe(ids["__id"]), "inner")
    if not ids.filter("__stay < __n").isEmpty():  # ids that rows share, of which some stay
        some = out.filter("__stay < __n").withColumn("__sha", F.sha2(without_spaces(F.col(text_col)).cast("binary"), 256))
        stay = decided.filter("kept").select(F.col("doc_id").alias("__of"), F.col("text_sha256").alias("__digest")).distinct()
        some = some.join(stay, some["__id"].eqNullSafe(stay["__of"]) & (some["__sha"] == stay["__digest"]), "left_semi")
        rank = Window.partitionBy("__id", "__sha").orderBy(F.char_length(F.coalesce(text_col, F.lit(""))).desc(), text_col)
        some = some.withColumn("__rank", F.row_number().over(rank)).filter("__rank = 1").drop("__rank", "__sha")
        out = out.filter("__stay = __n").unionByName(some)
    return out.drop("__id", "__n", "__stay")
