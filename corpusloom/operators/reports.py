"""Report aggregates: hours, shares, drop reasons, histograms, frequencies, masked means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_reason(reasons: dict[str, Column], default: str = "kept") -> Column:
    """The name of the first condition that holds, in order; a null condition does not hold."""
    out = None
    for name, condition in reasons.items():
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return F.lit(default) if out is None else out.otherwise(default)


def hours(df: DataFrame, seconds: Column, *keys: str, digits: int = 3) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.sum(seconds) / 3600, digits).alias("hours"))


def shares(df: DataFrame, value: Column, *keys: str, digits: int = 1) -> DataFrame:
    """Percent of the total of ``value`` by key: a window over the few sums."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias("total"))
    return sums.select(*keys, "total", F.round(100 * F.col("total") / F.sum("total").over(Window.partitionBy()), digits).alias("percent"))


def most_common(df: DataFrame, keys: Sequence[str], seq: str, n: int | None = None) -> DataFrame:
    """Counts in falling order, ties in the order of first appearance: ``n`` and ``rank`` from 1."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first_seen"))
    if n is not None:
        counts = counts.orderBy(F.desc("n"), "first_seen").limit(n)
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "first_seen")))


def histogram(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Counts per bin [lo, hi), the last one closed; NaN, null and values outside are left out, empty bins count 0."""
    spark = df.sparkSession
    bins = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))], "bin int, lo double, hi double")
    last = len(edges) - 2

    def place(v: Column) -> Column:
        inside = [(v >= a) & ((v <= b) if i == last else (v < b)) & ~F.isnan(v) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        return F.coalesce(*(F.when(x, i) for i, x in enumerate(inside)), F.lit(-1))

    # bound as a lambda's argument, the value is computed once a row, not once a bin; a bin of -1 for what is in none,
    # since a test for null would be pushed down and compute the value again
    counts = df.select(F.coalesce(F.transform(F.array(F.col(value).cast("double")), place)[0], F.lit(-1)).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return bins.join(counts, "bin", "left").select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def nan_mean(value: Column) -> Column:
    """The mean of what is neither null nor NaN; null where nothing is left."""
    return F.avg(F.when(~F.isnan(value), value))


def masked_mean(value: Column, where: Column) -> Column:
    return exact_mean(F.when(where & ~F.isnan(value), value))


def exact_mean(value: Column) -> Column:
    """The mean of a double, the same in whatever order rows are added, so that a mean that is a limit is not put beside it.

    Values are added as decimals of 18 places, if all of them are the same as such; otherwise, or where that sum
    has over 20 digits before the point, it is the plain mean. Null where nothing is left.
    """
    fixed = value.try_cast("decimal(38,18)")
    same = F.bool_and(F.when(value.isNotNull(), F.coalesce(fixed.cast("double") == value, F.lit(False))))
    return F.coalesce(F.when(same, F.try_sum(fixed).cast("double") / F.count(value)), F.avg(value))


def ratio_of_sums(top: Column, bottom: Column, least: float = 1e-6) -> Column:
    return F.sum(top) / F.greatest(F.sum(bottom), F.lit(least))


def correlation(a: Column, b: Column, least: int = 1000) -> Column:
    """Pearson's correlation of two signals, a row per pair of samples; 0 with fewer than ``least``. Nulls don't count."""
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    n = F.count(a)
    return F.when(n < least, 0.0).otherwise(n * F.covar_pop(a, b) / (n * F.stddev_pop(a) * F.stddev_pop(b) + 1e-9))


def shown(value: Column) -> Column:
    """A number for a report: three digits, ``n/a`` for null and NaN."""
    return F.when(value.isNull() | F.isnan(value), "n/a").otherwise(F.format_string("%.3f", value))


def by_suffix(sums: DataFrame, key: str, value: str, suffixes: Sequence[str]) -> DataFrame:
    """(suffix, total): the sum of ``value`` over the keys that end in ``_suffix``; 0 where there is none."""
    total = lambda s: F.coalesce(F.sum(F.when(F.col(key).endswith(f"_{s}"), F.col(value))), F.lit(0.0)).alias("total")
    one = sums.agg(F.array(*(F.struct(F.lit(s).alias("suffix"), total(s)) for s in suffixes)).alias("x"))
    return one.select(F.inline("x"))


def card(metrics: DataFrame, name: str, value: str, titles: dict[str, str], heads: tuple[str, str] = ("metric", "value")) -> DataFrame:
    """One row ``markdown``: a table of the named metrics in the order of ``titles`` (name to title), ``n/a`` for what is
    null, NaN or missing. ``metrics`` has a row a metric; other rows are left out, so the list stays as long as ``titles``."""
    known = metrics.filter(F.col(name).isin(*titles)).groupBy(F.col(name).alias("__name")).agg(F.min(value).alias("__value"))
    found = known.agg(F.map_from_entries(F.collect_list(F.struct("__name", "__value"))).alias("m"))
    lines = [F.concat(F.lit(f"| {title} | "), shown(F.try_element_at("m", F.lit(k))), F.lit(" |")) for k, title in titles.items()]
    return found.select(F.array_join(F.array(F.lit(f"| {heads[0]} | {heads[1]} |"), F.lit("|---|---|"), *lines), "\n").alias("markdown"))
