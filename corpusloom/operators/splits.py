"""Splits, shards and samples in a repeatable pseudo-random order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import hash_rank, prefix, shuffle_key


def stratified_split(df: DataFrame, strata: Sequence[str], key: str, seed: int = 0, share: float = 0.02, least: int = 100) -> DataFrame:
    """``split``: of each stratum the first k rows in hash order are ``val``.

    With N rows in all, ``n_val = max(least, floor(share * N))`` and a stratum of n gets
    ``k = max(1, round_half_even(n_val * n / N))``; small strata may go to ``val`` whole.
    """
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n"))
    total = F.sum("__n").over(Window.partitionBy())
    n_val = F.greatest(F.lit(least), F.floor(F.lit(share) * total).cast("int"))
    sizes = sizes.select(*[F.col(s).alias(f"__s_{s}") for s in strata], F.greatest(F.lit(1), F.bround(n_val * F.col("__n") / total)).cast("long").alias("__k"))
    on = F.lit(True)
    for s in strata:
        on = on & F.col(s).eqNullSafe(F.col(f"__s_{s}"))
    rows = df.join(sizes, on)
    # the rank within a stratum goes by hash buckets, so a large stratum spreads
    rows = rows.withColumn("__h", shuffle_key(seed, key))
    rows = prefix(rows, F.substring("__h", 1, 2), ["__h", key], name="__r", partition=list(strata))
    return rows.withColumn("split", F.when(F.col("__r") < F.col("__k"), "val").otherwise("train")).drop("__h", "__r", "__k", *[f"__s_{s}" for s in strata])


def epoch_shards(df: DataFrame, key: str, epoch: int, shards: int, seed: int = 0) -> DataFrame:
    """``pos`` in the epoch's permutation and ``shard``: contiguous slices of ceil(n / shards) rows, the last may be short."""
    rows = hash_rank(df, shuffle_key(seed + epoch, key), [key], name="pos")
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    return rows.crossJoin(F.broadcast(n)).withColumn("shard", F.floor(F.col("pos") / F.ceil(F.col("__n") / shards)).cast("long")).drop("__n")


def head_of_epoch(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The first ``n`` rows of epoch 0, for calibration."""
    return df.orderBy(shuffle_key(seed, key), key).limit(n)


def shard_count(seconds: Column, done: Column, minutes: Column, total: Column, overhead: int = 240, least: int = 50) -> Column:
    """Shards of ``minutes`` each for ``total`` rows, given that ``done`` rows took ``seconds``, with a fixed overhead."""
    per_row = F.greatest(seconds - overhead, F.lit(1.0)) / F.greatest(done, F.lit(1))
    rows = F.greatest(F.floor((minutes * 60 - overhead) / per_row), F.lit(least))
    return F.greatest(F.lit(1).cast("long"), F.ceil(total / rows).cast("long"))


def sample_per_group(df: DataFrame, group: Sequence[str], key: str, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` rows of each group, without replacement; the group limit is pushed before the exchange."""
    w = Window.partitionBy(*group).orderBy(shuffle_key(seed, key), key)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def holdout(df: DataFrame, key: str, share: float = 0.1, seed: int = 42) -> DataFrame:
    """``held_out``: the first floor(share * n) keys in hash order."""
    rows = hash_rank(df, shuffle_key(seed, key), [key], name="__r")
    n = df.agg(F.floor(F.count(F.lit(1)) * F.lit(share)).alias("__n"))
    return rows.crossJoin(F.broadcast(n)).withColumn("held_out", F.col("__r") < F.col("__n")).drop("__r", "__n")


def keep_first(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Of rows with equal keys the one with the smallest ``seq``, any one of those that share it.

    Keys, which may be whole texts, are compared by a digest; only that and ``seq`` are aggregated, and the rows move once.
    """
    rows = df.withColumn("__key", F.sha2(F.to_json(F.struct(*keys)), 256))
    first = rows.groupBy("__key").agg(F.min(seq).alias("__first"))
    found = rows.join(first.withColumnRenamed("__key", "__of"), F.col("__key") == F.col("__of")).filter(F.col(seq).eqNullSafe(F.col("__first")))
    return found.dropDuplicates(["__key"]).select(*df.columns)


def disjoint_slices(df: DataFrame, key: str, sizes: dict[str, int], seed: int = 0, rest: str = "rest") -> DataFrame:
    """``part``: consecutive ranges of the hash order, disjoint by construction whatever the size of the table."""
    rows = hash_rank(df, shuffle_key(seed, key), [key], name="__r")
    at, label = 0, None
    for name, n in sizes.items():
        hit = (F.col("__r") >= at) & (F.col("__r") < at + n)
        label = F.when(hit, name) if label is None else label.when(hit, name)
        at += n
    return rows.withColumn("part", label.otherwise(rest)).drop("__r")
