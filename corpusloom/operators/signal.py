"""Signal checks: runs of quiet frames, clipping, robust peaks, lists of issues, spectral measures."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of a batch of clips that comes to Python (one clip at least), and samples made ready that it hands on at once.
MOST_BYTES, MOST_SAMPLES = 16 << 20, 1 << 20


def longest_quiet_run(df: DataFrame, group: Sequence[str], order: Sequence[str], quiet: Column) -> DataFrame:
    """Gaps and islands: the longest run of quiet rows inside each group; leading and trailing quiet does not count,
    and a group that is quiet throughout counts whole."""
    by = Window.partitionBy(*group).orderBy(*order)
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("__q", quiet).withColumn("__loud", F.sum(F.when(F.col("__q"), 0).otherwise(1)).over(upto))
    # a run of quiet rows shares the number of loud rows before it; run 0 leads, the last one trails
    runs = rows.groupBy(*group, "__loud").agg(F.count_if("__q").alias("__n"), F.count(F.lit(1)).alias("__all"))
    last = F.max("__loud").over(Window.partitionBy(*group))
    inner = F.when((F.col("__loud") > 0) & (F.col("__loud") < last), F.col("__n")).when(last == 0, F.col("__all")).otherwise(0)
    return runs.withColumn("__inner", inner).groupBy(*group).agg(F.max("__inner").cast("long").alias("longest"))


def clipping_ratio(samples: Column, threshold: float = 0.99) -> Column:
    """The share of samples at or above the threshold; 0 for none."""
    n = F.size(samples)
    return F.when(n > 0, F.size(F.filter(samples, lambda x: F.abs(x) >= threshold)) / n).otherwise(0.0)


def mad_peak(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """How many median absolute deviations the largest value stands above the median."""
    mid = df.groupBy(*group).agg(F.median(value).alias("__mid"), F.max(value).alias("__top"))
    rows = df.join(mid, list(group))
    return rows.groupBy(*group).agg(F.first("__mid").alias("median"), F.first("__top").alias("top"), F.median(F.abs(F.col(value) - F.col("__mid"))).alias("mad")).withColumn("peak", (F.col("top") - F.col("median")) / (F.col("mad") + 1e-9))


def issues(tests: dict[str, Column]) -> Column:
    """The names of the tests that fail, in order."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in tests.items()]), lambda x: x.isNotNull())


def _power(y: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    frames = np.lib.stride_tricks.sliding_window_view(y, n_fft)[::hop]
    return np.abs(np.fft.rfft(frames * np.hanning(n_fft), axis=1)) ** 2


def rolloff(rate: int, share: float = 0.95, n_fft: int = 2048, hop: int | None = None):
    """A pandas UDF: mean over frames of the frequency below which ``share`` of the energy lies; null if too short."""
    hop = hop or n_fft // 4

    @F.pandas_udf("double")
    def run(samples: pd.Series) -> pd.Series:
        freqs = np.fft.rfftfreq(n_fft, 1 / rate)

        def one(y) -> float | None:
            if y is None or len(y) < n_fft:
                return None
            p = _power(np.asarray(y, float)[: max(n_fft, len(y) - 1)], n_fft, hop)
            part = p.cumsum(axis=1) / (p.sum(axis=1, keepdims=True) + 1e-12)
            return float(freqs[(part >= share).argmax(axis=1)].mean())

        return samples.map(one)

    return run


def high_energy(rate: int, cutoff: float = 8000.0, n_fft: int = 2048):
    """A pandas UDF: the share of energy above ``cutoff`` over whole frames; null if too short."""

    @F.pandas_udf("double")
    def run(samples: pd.Series) -> pd.Series:
        high = np.fft.rfftfreq(n_fft, 1 / rate) > cutoff

        def one(y) -> float | None:
            if y is None or len(y) < n_fft:
                return None
            p = _power(np.asarray(y, float), n_fft, n_fft)
            return float(p[:, high].sum() / (p.sum() + 1e-12))

        return samples.map(one)

    return run


def comb_peak(rate: int, lo_ms: float = 12.5, hi_ms: float = 30.0, n_fft: int = 4096):
    """A pandas UDF: median over frames of the strongest cepstral peak between two delays, in MADs; null if too short."""
    lo, hi = int(rate * lo_ms / 1000), int(rate * hi_ms / 1000)

    @F.pandas_udf("double")
    def run(samples: pd.Series) -> pd.Series:
        def one(y) -> float | None:
            if y is None or len(y) < 2 * n_fft:
                return None
            frames = np.lib.stride_tricks.sliding_window_view(np.asarray(y, float)[:-1], n_fft)[:: n_fft // 2]
            cep = np.abs(np.fft.irfft(np.log(np.abs(np.fft.rfft(frames * np.hanning(n_fft), axis=1)) + 1e-9), axis=1))[:, lo:hi]
            mid = np.median(cep, axis=1, keepdims=True)
            mad = np.median(np.abs(cep - mid), axis=1) + 1e-9
            return float(np.median((cep.max(axis=1) - mid[:, 0] - 1e-9) / mad))

        return samples.map(one)

    return run


def audit(df: DataFrame, speaker: str, clip: str, rolloff: str, high: str, per_speaker: int = 30, limit: float = 8000.0, seed: int = 0) -> DataFrame:
    """(speaker, n_sampled, n_clips, rolloff_hz, high_percent, band_limited): means over a pseudo-random sample of each
    speaker's clips; clips without a measure are left out of the means. ``band_limited`` is null without any."""
    order = F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(clip).cast("string"))), clip)
    rank = F.row_number().over(Window.partitionBy(speaker).orderBy(order))
    sample = df.select(speaker, clip, rolloff, high).withColumn("__r", rank).filter(F.col("__r") <= per_speaker)
    means = sample.groupBy(speaker).agg(F.count(rolloff).alias("n_sampled"), F.avg(rolloff).alias("__m"), F.avg(high).alias("__h"))
    clips = df.groupBy(F.col(speaker).alias("__s")).agg(F.count(F.lit(1)).alias("n_clips"))
    out = clips.join(means, F.col("__s").eqNullSafe(F.col(speaker)))
    return out.select(speaker, "n_sampled", "n_clips", F.round("__m", 1).alias("rolloff_hz"), F.round(100 * F.col("__h"), 3).alias("high_percent"), (F.col("__m") < limit).alias("band_limited"))


def assert_full_band(references: DataFrame, verdicts: DataFrame, speaker: str) -> DataFrame:
    """``references`` of speakers, or an error that names one whose audit says that it is band-limited."""
    bad = verdicts.filter("band_limited").select(F.col(speaker).alias("__bad"), "rolloff_hz")
    rows = references.join(bad, F.col(speaker) == F.col("__bad"), "left")
    message = F.concat(F.lit("band-limited, no reference: "), F.col(speaker).cast("string"))
    return rows.filter(F.when(F.col("__bad").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))).drop("__bad", "rolloff_hz")


def _levels(y: np.ndarray, frame: int = 2048, hop: int = 512) -> np.ndarray:
    """RMS of frames centred on every ``hop``-th sample, in decibels below the loudest frame; zeros around the clip."""
    padded = np.pad(y.astype(np.float64), frame // 2)
    rms = np.sqrt((np.lib.stride_tricks.sliding_window_view(padded, frame)[::hop] ** 2).mean(axis=1))
    return 20 * np.log10(np.maximum(rms, 1e-5) / max(1e-5, rms.max(initial=0.0)))


def resample(y: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Band-limited resampling by the spectrum; a clip of any length gets round(n * target / rate) samples."""
    n = round(len(y) * target / rate)
    if rate == target or not len(y) or not n:
        return y
    spectrum = np.fft.rfft(y)
    out = np.zeros(n // 2 + 1, complex)
    k = min(len(out), len(spectrum))
    out[:k] = spectrum[:k]
    return np.fft.irfft(out, n) * n / len(y)


def clean_clip(samples, rate: int, target: int = 24_000, top_db: float = 40.0, pad: float = 0.1, least: float = 1.5) -> tuple[str, np.ndarray | None]:
    """(reason, samples): resampled, its peak at -1 dBFS, silence at the ends cut but for ``pad`` seconds; reasons are
    decode_error, silent, too_short, kept."""
    if samples is None or not rate:
        return "decode_error", None
    y = resample(np.asarray(samples, np.float64), int(rate), target)
    peak = float(np.abs(y).max(initial=0.0))
    if peak <= 1e-4:
        return "silent", None
    y = y / peak * 10 ** (-1 / 20)
    loud = np.flatnonzero(_levels(y) > -top_db)
    first, last = (int(loud[0]) * 512, min(len(y), (int(loud[-1]) + 1) * 512)) if len(loud) else (0, 0)
    margin = int(pad * target)
    y = y[max(0, first - margin) : min(len(y), last + margin)]
    return ("too_short", None) if len(y) / target < least else ("kept", y)


def split_clip(y: np.ndarray, sentences: list[str], rate: int = 24_000, most: float = 20.0, least: float = 1.5, gap: float = 0.3, top_db: float = 35.0) -> list[tuple[np.ndarray, str]]:
    """The parts of a long clip at its pauses, each with its sentence; none if pauses and sentences don't agree in
    number, or a part is too short or too long."""
    loud = _levels(y) > -top_db
    edges = np.flatnonzero(np.diff(np.concatenate([[False], loud, [False]]).astype(int)))
    spans = np.minimum(edges * 512, len(y)).reshape(-1, 2)
    if len(spans) < 2:
        return []
    pauses = np.flatnonzero((spans[1:, 0] - spans[:-1, 1]) / rate >= gap)
    if not len(pauses) or len(pauses) + 1 != len(sentences):
        return []
    ends = [*(spans[pauses, 1] + int(0.15 * rate)).tolist(), len(y)]
    starts = [0, *(max(0, e - int(0.1 * rate)) for e in ends[:-1])]
    parts = [y[a:b] for a, b in zip(starts, ends, strict=True)]
    return list(zip(parts, sentences, strict=True)) if all(least <= len(p) / rate <= most for p in parts) else []


def prepare_clips(df: DataFrame, key: str, samples: str, rate: str, text: str, target: int = 24_000, most: float = 20.0) -> DataFrame:
    """(key, part, reason, text, dur, samples): clips made ready, long ones in parts; a clip that is left out is one row
    with its reason (decode_error, silent, too_short, too_long_dropped) and without samples."""
    kind = dict(df.dtypes)[key]
    names = ["key", "part", "reason", "text", "dur", "samples"]
    kinds = [pa.int32(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.float32())]

    def parts_of(batch: pa.RecordBatch, i: int) -> list[tuple]:
        y, r, t = batch.column(1)[i], batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
        y = y.values.to_numpy(zero_copy_only=False) if y.is_valid else None
        reason, clean = clean_clip(y, 0 if r is None or r != r else int(r), target)
        parts = [(clean, t)] if clean is not None else []
        if clean is not None and len(clean) / target > most:
            sentences = [s for s in re.split(r"(?<=[۔؟!?.])\s+", (t or "").strip()) if s]
            parts = split_clip(clean, sentences, target, most)
            reason = "split" if parts else "too_long_dropped"
        return [(i, k, reason, s, round(len(p) / target, 3), p.astype(np.float32)) for k, (p, s) in enumerate(parts)] or [(i, 0, reason, t, None, None)]

    def emit(batch: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
        at, *columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for i in range(batch.num_rows):
                found = parts_of(batch, i)
                out += found
                held += sum(len(x[-1]) for x in found if x[-1] is not None)
                if held > MOST_SAMPLES:
                    yield emit(batch, out)
                    out, held = [], 0
            if out:
                yield emit(batch, out)

    # Spark cuts batches by bytes; a session that sets more is held to less
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(limit).rstrip("b")) > MOST_BYTES:
        conf.set(limit, str(MOST_BYTES))
    rows = df.select(F.col(key).alias("key"), F.col(samples).cast("array<double>").alias("samples"), F.col(rate).alias("rate"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, part int, reason string, text string, dur double, samples array<float>").withColumnRenamed("key", key)


def longest_pause(rate: int, level: float = -45.0, frame_ms: float = 20.0):
    """A pandas UDF: seconds of the longest run of quiet frames between the first and the last loud one; a clip that is
    quiet throughout counts whole, one shorter than a frame 0; null for null."""
    n = int(rate * frame_ms / 1000)

    @F.pandas_udf("double")
    def run(samples: pd.Series) -> pd.Series:
        def one(y) -> float | None:
            if y is None:
                return None
            y = np.asarray(y, float)
            if len(y) < n:
                return 0.0
            rms = np.sqrt((y[: len(y) // n * n].reshape(-1, n) ** 2).mean(axis=1))
            loud = np.flatnonzero(20 * np.log10(rms + 1e-9) >= level)
            return float(np.diff(loud, prepend=loud[0] - 1).max() - 1) * frame_ms / 1000 if len(loud) else len(y) / rate

        return samples.map(one)

    return run


# --- fixed values: the mel scale that is linear up to 1000 Hz, and the frames of the comparison ---
MEL_STEP, MEL_BREAK, MEL_LOG = 200.0 / 3, 1000.0, np.log(6.4) / 27
FRAME, HOP, BANDS, LOG_FLOOR = 1024, 256, 80, 1e-5
# --- end of fixed values ---


def mel_filters(rate: int, frame: int = FRAME, bands: int = BANDS) -> np.ndarray:
    """Triangles of equal area on the mel scale: (bands, bins of the spectrum)."""
    top = rate / 2
    mel = lambda f: np.where(f < MEL_BREAK, f / MEL_STEP, MEL_BREAK / MEL_STEP + np.log(np.maximum(f, 1e-9) / MEL_BREAK) / MEL_LOG)
    marks = np.linspace(0.0, float(mel(np.array(top))), bands + 2)
    hertz = np.where(marks < MEL_BREAK / MEL_STEP, marks * MEL_STEP, MEL_BREAK * np.exp(MEL_LOG * (marks - MEL_BREAK / MEL_STEP)))
    bins = np.linspace(0.0, top, frame // 2 + 1)
    low, mid, high = hertz[:-2, None], hertz[1:-1, None], hertz[2:, None]
    return np.maximum(0.0, np.minimum((bins - low) / (mid - low), (high - bins) / (high - mid))) * (2.0 / (high - low))


def log_mel(y: np.ndarray, filters: np.ndarray, frame: int = FRAME, hop: int = HOP) -> np.ndarray:
    """Logarithms of the power in each band of frames centred at every ``hop``-th sample; zeros beyond the ends."""
    padded = np.pad(np.asarray(y, float), frame // 2)
    frames = np.lib.stride_tricks.sliding_window_view(padded, frame)[::hop]
    power = np.abs(np.fft.rfft(frames * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(frame) / frame)), axis=1)) ** 2
    return np.log(power @ filters.T + LOG_FLOOR)


def _correlated(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a - a.mean(), b - b.mean()
    return float(np.vdot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-9))


def likeness(rate: int, least: int = 1000):
    """A pandas UDF of two signals: (wave, mel, length_ratio), Pearson's correlation of the samples and of the log-mel
    spectra over the shorter length, and the second length by the first. 0 for fewer than ``least`` samples; null for null."""

    @F.pandas_udf("struct<wave:double,mel:double,length_ratio:double>")
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        filters, out = mel_filters(rate), []
        for x, y in zip(a, b, strict=True):
            if x is None or y is None:
                out.append((None, None, None))
                continue
            x, y, n = np.asarray(x, float), np.asarray(y, float), min(len(x), len(y))
            wave, mel = (0.0, 0.0) if n < least else (_correlated(x[:n], y[:n]), _correlated(log_mel(x[:n], filters), log_mel(y[:n], filters)))
            out.append((wave, mel, len(y) / max(len(x), 1)))
        return pd.DataFrame(out, columns=["wave", "mel", "length_ratio"])

    return run


def parity(df: DataFrame, group: Sequence[str], a: str, b: str, rate: int = 24_000) -> DataFrame:
    """(group, min_corr, mean_corr, mel_corr_min, len_ratio_mean, n): how alike pairs of signals are."""
    rows = df.withColumn("__l", likeness(rate)(F.col(a), F.col(b))).filter("__l.wave IS NOT NULL")
    return rows.groupBy(*group).agg(F.min("__l.wave").alias("min_corr"), F.avg("__l.wave").alias("mean_corr"), F.min("__l.mel").alias("mel_corr_min"), F.avg("__l.length_ratio").alias("len_ratio_mean"), F.count(F.lit(1)).alias("n"))
