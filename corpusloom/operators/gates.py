"""Quality gates, early stopping and checkpoint choice as queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gate(value: Column, test: Column) -> Column:
    """True or false, null where the value is missing."""
    return F.when(value.isNotNull() & ~F.isnan(value), test)


# --- fixed values: the margins of the evaluation ---
OOD_MARGIN, APPENDIX_MARGIN, BASELINE_MARGIN, WER_MARGIN = 0.03, 0.06, 0.05, 0.05
MIXED_PCER, MIXED_PCER_EN, LEAST_MOS, MOS_MARGIN = 0.10, 0.15, 3.5, 0.3
MOST_CLIPPING, MOST_SILENCE, COMB_MARGIN = 0.001, 1.5, 3.0
# --- end of fixed values ---


def evaluation(df: DataFrame, *keys: str) -> DataFrame:
    """(*keys, one column per gate) of measured metrics by name; NaN counts as missing.

    A gate that needs a baseline, a naturalness score or a real recording is null without it; the others fail without
    their value, as a comparison with NaN does.
    """
    m = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    must = lambda test: F.coalesce(test, F.lit(False))
    mos, real = F.coalesce(m("utmos"), m("dnsmos")), m("real_mos")
    tests = {
        "ood_cer": m("ood_cer") <= m("floor") + OOD_MARGIN,
        "beats_baseline": F.when(m("base_cer").isNotNull(), must(m("appendix_cer") < m("base_cer") - BASELINE_MARGIN)),
        "appendix_cer": must(m("appendix_cer") <= m("floor") + APPENDIX_MARGIN),
        "mixed_pcer": must(m("mixed_pcer") <= MIXED_PCER),
        "mixed_pcer_en": m("mixed_pcer_en") <= MIXED_PCER_EN,
        "no_english_word_lost": must(m("words_lost") == 0),
        "english_wer": F.when(m("base_wer").isNotNull(), must(m("english_wer") <= m("base_wer") + WER_MARGIN)),
        "naturalness": F.when(mos.isNotNull(), (mos >= LEAST_MOS) | must(mos >= real - MOS_MARGIN)),
        "no_clipping": must(m("clipping_max") < MOST_CLIPPING),
        "no_long_silence": must(m("max_silence") <= MOST_SILENCE),
        "no_comb": m("comb_median") <= m("real_comb") + COMB_MARGIN,
    }
    return df.select(*keys, *[t.alias(f"g_{n}") for n, t in tests.items()])


def passed(gates: Sequence[str]) -> Column:
    """True unless a gate is false: gates without a value do not count."""
    out = F.lit(True)
    for g in gates:
        out = out & F.coalesce(F.col(g), F.lit(True))
    return out


def complete(gates: Sequence[str]) -> Column:
    """True only if every gate is true."""
    out = F.lit(True)
    for g in gates:
        out = out & F.coalesce(F.col(g), F.lit(False))
    return out


def early_stop(df: DataFrame, group: Sequence[str], order: str, value: str, least: int = 4, margin: float = 0.005) -> DataFrame:
    """``stop`` per group: at least ``least`` values, and neither of the last two under the best before by ``margin``."""
    known = df.filter(F.col(value).isNotNull())
    rows = known.withColumn("back", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(order))))
    stats = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("back") <= 2, F.col(value))).alias("late"), F.min(F.when(F.col("back") > 2, F.col(value))).alias("best"))
    return stats.select(*group, "n", F.coalesce((F.col("n") >= least) & (F.col("late") >= F.col("best") - margin), F.lit(False)).alias("stop"))


def select_checkpoint(df: DataFrame, group: Sequence[str], epoch: str, weights: dict[str, tuple[float, float]], zero_is_missing: Sequence[str] = ()) -> DataFrame:
    """The epoch with the least weighted sum of metrics, the first on ties. ``weights``: metric to (weight, default)."""
    score = F.lit(0.0)
    for metric, (weight, default) in weights.items():
        v = F.nullif(F.col(metric), F.lit(0.0)) if metric in zero_is_missing else F.col(metric)
        score = score + weight * F.coalesce(v, F.lit(default))
    rows = df.withColumn("score", score)
    return rows.groupBy(*group).agg(F.min_by(epoch, F.struct("score", epoch)).alias("best_epoch"), F.round(F.min("score"), 6).alias("best_score"))


def retain(df: DataFrame, group: Sequence[str], order: Sequence[str], last: int, keep: Column) -> DataFrame:
    """``kept``: the last rows of each group, and whatever ``keep`` says."""
    back = F.row_number().over(Window.partitionBy(*group).orderBy(*[F.desc(c) for c in order]))
    return df.withColumn("kept", (back <= last) | F.coalesce(keep, F.lit(False)))


def projected_hours(rows: Column, seconds_per_row: Column, epochs: Column, slack: float = 1.15) -> Column:
    return rows * seconds_per_row * epochs / 3600 * slack
