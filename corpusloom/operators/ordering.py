"""Deterministic order and prefix sums that do not pull a table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_key(seed: str | int, *keys: str | Column) -> Column:
    """A pseudo-random order that any SQL engine with md5 can repeat: hex md5 of seed and keys, joined by ``|``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))


def prefix(df: DataFrame, bucket: Column, order: Sequence[Column | str], value: Column | None = None, name: str = "before", partition: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` (rows if None) over all rows before this one in ``order``.

    ``bucket`` must follow the order: rows of a smaller bucket come first. Sums run within buckets, one task each,
    and over the small table of buckets; only that table goes through a window without many partitions.
    """
    value = F.lit(1).cast("long") if value is None else value
    rows = df.withColumn("__bucket", bucket)
    within = Window.partitionBy(*partition, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*partition, "__bucket").agg(F.sum(value).alias("__total"))
    over = Window.partitionBy(*partition).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(p).alias(f"__p_{p}") for p in partition], F.col("__bucket").alias("__of"), F.coalesce(F.sum("__total").over(over), F.lit(0)).alias("__base"))
    rows = rows.withColumn("__local", F.coalesce(F.sum(value).over(within), F.lit(0)))
    on = F.col("__bucket").eqNullSafe(F.col("__of"))
    for p in partition:
        on = on & F.col(p).eqNullSafe(F.col(f"__p_{p}"))
    out = rows.join(totals, on).withColumn(name, F.col("__base") + F.col("__local"))
    return out.drop("__bucket", "__of", "__base", "__local", *[f"__p_{p}" for p in partition])


def hash_rank(df: DataFrame, key: Column, tie: Sequence[str], name: str = "rank0") -> DataFrame:
    """The position of each row in the order of the hex string ``key``, then ``tie``; buckets are its first three digits."""
    rows = df.withColumn("__key", key)
    return prefix(rows, F.substring("__key", 1, 3), ["__key", *tie], name=name).drop("__key")
