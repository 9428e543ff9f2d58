"""Budgeted selection: rows are taken while the sum of what came before them stays under a budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import prefix


def before(value: str | Column, partition: Sequence[str], order: Sequence[str | Column]) -> Column:
    """The sum of ``value`` over the rows before this one."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def spent_before(df: DataFrame, value: Column, partition: Sequence[str], order: Sequence[str | Column], bucket: Column | None, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the partition before this one.

    Without ``bucket`` by one window, which puts a partition into one task; with it (any column that follows the
    order) by prefix sums within and over buckets, so that a partition may hold any share of the rows.
    """
    if bucket is None:
        return df.withColumn(name, before(value, partition, order))
    return prefix(df, bucket, order, value, name=name, partition=partition)


def admit(df: DataFrame, value: str, cap: Column | float, partition: Sequence[str], order: Sequence[str | Column], bucket: Column | None = None) -> DataFrame:
    """Rows whose predecessors sum to less than ``cap``: a group may exceed its budget by one row."""
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    return spent_before(df, F.col(value), partition, order, bucket, "spent").filter(F.col("spent") < cap)


def four_passes(df: DataFrame, value: str, cap: float, flag: str, partition: Sequence[str], order: Sequence[str | Column], shares: tuple[float, float] = (0.8, 0.2), bucket: Column | None = None) -> DataFrame:
    """``pass`` (1 to 4, null if not taken): plain rows up to a share of the cap, flagged rows up to theirs, then
    plain and at last flagged rows for what the cap has left. Values are at least 0, nulls count as 0; a row whose flag
    is null is not taken.

    So a pass takes the next rows of its kind, and one prefix sum per kind with three totals per partition says what
    each pass takes. With ``bucket`` (any column that follows the order) no partition has to fit one task.
    """
    v, spent, plain, flagged = F.coalesce(F.col(value), F.lit(0)), F.col("__spent"), F.col(flag) == F.lit(False), F.col(flag) == F.lit(True)
    rows = spent_before(df, v, [*partition, flag], order, bucket, "__spent")
    first, second = plain & (spent < shares[0] * cap), flagged & (spent < shares[1] * cap)

    def totals(rows: DataFrame, **of: Column) -> DataFrame:
        """``rows`` with sums over their partition, one row of it each."""
        sums = rows.groupBy(*[F.col(p).alias(f"__p_{p}") for p in partition]).agg(*[F.coalesce(F.sum(F.when(c, v)), F.lit(0)).alias(n) for n, c in of.items()])
        on = F.lit(True)
        for p in partition:
            on = on & F.col(p).eqNullSafe(F.col(f"__p_{p}"))
        return rows.join(sums, on).drop(*[f"__p_{p}" for p in partition])

    rows = totals(rows, __plain=first, __flagged=second)
    third = plain & (spent < F.lit(cap) - F.col("__flagged"))
    rows = totals(rows, __third=third & ~first)
    fourth = flagged & (spent < F.lit(cap) - F.col("__plain") - F.col("__third"))
    taken = F.when(first, 1).when(second, 2).when(third, 3).when(fourth, 4)
    return rows.withColumn("pass", taken).drop("__spent", "__plain", "__flagged", "__third")


def two_levels(df: DataFrame, value: str, group: str, group_cap: float, cap: float, seq: str, bucket: int = 4096) -> DataFrame:
    """A budget per group, then one over all survivors, both in order of the whole number ``seq``."""
    part = F.floor(F.col(seq) / bucket)
    rows = admit(df, value, group_cap, [group], [seq], part).drop("spent")
    rows = prefix(rows, part, [seq], F.col(value), name="spent")
    return rows.filter(F.col("spent") < cap)


def first_seen_ids(df: DataFrame, key: str, seq: str, base: int = 0, name: str = "key_id", bucket: int = 1 << 20) -> DataFrame:
    """Dense numbers from ``base`` in the order in which keys first appear, ``seq`` being a whole number; one row per
    key is ranked, in slices of ``bucket`` numbers. Keys that first appear at one number share an id."""
    first = df.groupBy(key).agg(F.min(seq).alias("__first"))
    places = prefix(first.select("__first").distinct(), F.floor(F.col("__first") / bucket), ["__first"], name="__id")
    places = places.select(F.col("__first").alias("__place"), (F.col("__id") + base).cast("int").alias(name))
    ids = first.join(places, F.col("__first").eqNullSafe(F.col("__place"))).select(F.col(key).alias("__key"), name)
    return df.join(ids, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
