"""Strict phones, clips, and what is written as documents, against plain Python."""

import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import edit
from corpusloom.operators import frontend, signal, vectors
from corpusloom.sources import files


def test_invalid_phones_are_reported(spark):
    entries = spark.createDataFrame([(1, "سلام", "ɬɑː")], "seq int, word string, pron string")
    english = spark.createDataFrame([], "word string, pron string")
    df = spark.createDataFrame([(1, "سلام")], "id int, text string")
    row = frontend.phonemize(df, "id", "text", entries, english).first()
    assert row["phonemes"] is None and row["unknown"] == ["ɬ"]
    with pytest.raises(Exception, match="ɬ"):
        frontend.phonemize(df, "id", "text", entries, english, strict=True).collect()


def test_source_counts(spark):
    said = spark.createDataFrame([("a", "x", "lexicon"), ("b", "y", "rules"), ("c", "z", "rules")], "word string, pron string, source string")
    assert {r["source"]: r["n"] for r in frontend.source_counts(said).collect()} == {"lexicon": 1, "rules": 2}


# --- clips ---
RATE = 24_000


def tone(seconds, amplitude=0.5, hz=220.0, rate=RATE):
    return amplitude * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)


def silence(seconds):
    return np.zeros(int(seconds * RATE))


def test_clips_are_resampled_levelled_and_trimmed():
    reason, y = signal.clean_clip(np.concatenate([silence(1), tone(2), silence(1)]), RATE)
    assert reason == "kept" and abs(len(y) / RATE - 2.2) < 0.1 and np.abs(y).max() == pytest.approx(10 ** (-1 / 20), rel=1e-3)
    slow = signal.resample(tone(1, rate=8000), 8000, RATE)
    assert len(slow) == RATE and np.abs(slow[2000:-2000] - tone(1)[2000:-2000]).max() < 0.02
    assert signal.clean_clip(silence(3), RATE)[0] == "silent" and signal.clean_clip(tone(0.5), RATE)[0] == "too_short"
    assert signal.clean_clip(None, 0)[0] == "decode_error"


def test_long_clips_are_split_at_pauses(spark):
    y = np.concatenate([tone(11), silence(0.6), tone(10)])
    assert [s for _, s in signal.split_clip(y, ["one.", "two."])] == ["one.", "two."]
    assert signal.split_clip(y, ["one."]) == [] and signal.split_clip(tone(21), ["a.", "b."]) == []
    rows = [("u", y.tolist(), RATE, "one. two."), ("v", y.tolist(), RATE, "only one"), ("w", tone(2).tolist(), RATE, "short"), ("x", None, None, None)]
    got = signal.prepare_clips(spark.createDataFrame(rows, "utt string, y array<double>, rate int, text string"), "utt", "y", "rate", "text").select("utt", "part", "reason", "text").collect()
    assert sorted(map(tuple, got), key=str) == [("u", 0, "split", "one."), ("u", 1, "split", "two."), ("v", 0, "too_long_dropped", "only one"), ("w", 0, "kept", "short"), ("x", 0, "decode_error", None)]


def test_batches_of_clips_are_bounded(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    try:
        y = F.when(F.col("id") == 7, None).otherwise(F.array_repeat(F.when(F.col("id") % 2 == 0, 0.5).otherwise(0.0), 30_000))
        df = spark.range(0, 200, 1, 1).select("id", y.alias("y"), F.lit(8000.0).alias("rate"), F.lit("One.").alias("t"))
        out = signal.prepare_clips(df, "id", "y", "rate", "t", target=8000)
        assert int(spark.conf.get(limit).rstrip("b")) <= signal.MOST_BYTES

        got = {r["id"]: r["reason"] for r in out.collect()}
        assert got == {i: "kept" if i % 2 == 0 else "decode_error" if i == 7 else "silent" for i in range(200)}
        assert out.filter("id = 0").selectExpr("size(samples) n", "dur").first() == (30_000, 3.75)
    finally:
        spark.conf.set(limit, before)


def test_longest_pause_equals_plain_runs(spark):
    rng = np.random.default_rng(2)
    clips = [np.repeat(rng.choice([0.0, 0.001, 0.1], 40), 200) for _ in range(20)] + [np.zeros(900), np.zeros(50)]

    def plain(y, n=200):
        if len(y) < n:
            return 0.0
        quiet = [20 * np.log10(np.sqrt(np.mean(y[i : i + n] ** 2)) + 1e-9) < -45 for i in range(0, len(y) - n + 1, n)]
        if all(quiet):
            return len(y) / 10_000
        text = "".join("q" if q else "l" for q in quiet).strip("q")
        return max(map(len, text.split("l"))) * 0.02

    df = spark.createDataFrame([(i, y.tolist()) for i, y in enumerate(clips)], "i int, y array<double>")
    got = {r["i"]: r["s"] for r in df.select("i", signal.longest_pause(10_000)("y").alias("s")).collect()}
    assert got == {i: pytest.approx(plain(y)) for i, y in enumerate(clips)}


def test_spectral_measures_equal_plain_fourier_sums(spark):
    rng = np.random.default_rng(7)
    clips = [rng.normal(size=n) for n in (20, 64, 65, 100)]
    df = spark.createDataFrame([(i, y.tolist()) for i, y in enumerate(clips)], "i int, y array<double>")
    n, rate = 32, 24_000
    window = [0.5 - 0.5 * np.cos(2 * np.pi * k / (n - 1)) for k in range(n)]

    def power(frame):
        return [abs(sum(frame[k] * window[k] * np.exp(-2j * np.pi * f * k / n) for k in range(n))) ** 2 for f in range(n // 2 + 1)]

    got = {r["i"]: r for r in df.select("i", signal.rolloff(rate, 0.95, n)("y").alias("r"), signal.high_energy(rate, 8000.0, n)("y").alias("h"), signal.comb_peak(1000, 1.0, 8.0, 16)("y").alias("c")).collect()}
    for i, y in enumerate(clips):
        if len(y) < n:
            assert got[i]["r"] is None and got[i]["h"] is None
            continue
        places = []
        for at in range(0, len(y) - n, n // 4):
            p = power(y[at : at + n])
            places.append(next(f for f in range(len(p)) if sum(p[: f + 1]) / (sum(p) + 1e-12) >= 0.95) * rate / n)
        assert got[i]["r"] == pytest.approx(np.mean(places))
        p = [x for at in range(0, len(y) - n + 1, n) for x in enumerate(power(y[at : at + n]))]
        assert got[i]["h"] == pytest.approx(sum(x for f, x in p if f * rate / n > 8000) / (sum(x for _, x in p) + 1e-12))
        m, peaks = 16, []
        win = [0.5 - 0.5 * np.cos(2 * np.pi * k / (m - 1)) for k in range(m)]
        for at in range(0, len(y) - m, m // 2):
            half = [np.log(abs(sum(y[at + k] * win[k] * np.exp(-2j * np.pi * f * k / m) for k in range(m))) + 1e-9) for f in range(m // 2 + 1)]
            full = half + half[-2:0:-1]
            cep = [abs(sum(full[f] * np.exp(2j * np.pi * f * k / m) for f in range(m)) / m) for k in range(1, 8)]
            mid = np.median(cep)
            peaks.append((max(cep) - mid - 1e-9) / (np.median([abs(c - mid) for c in cep]) + 1e-9))
        assert got[i]["c"] == pytest.approx(np.median(peaks), rel=1e-6)


def test_band_limited_speakers_are_no_references(spark):
    refs = spark.createDataFrame([("a", 1), ("b", 2)], "spk string, clip int")
    verdicts = spark.createDataFrame([("a", 9000.0, False), ("b", 9000.0, False), ("c", 1.0, True)], "spk string, rolloff_hz double, band_limited boolean")
    assert signal.assert_full_band(refs, verdicts, "spk").count() == 2
    with pytest.raises(Exception, match="no reference: b"):
        signal.assert_full_band(refs, verdicts.withColumn("band_limited", F.col("spk") == "b"), "spk").collect()


# --- files ---
def test_documents_for_people(spark, tmp_path):
    df = spark.createDataFrame([(2, "b\tc", None), (1, "اردو", 0.5)], "i int, t string, x double")
    files.write_json_document(df.orderBy("i"), str(tmp_path / "j"))
    (part,) = (tmp_path / "j").glob("part-*")
    assert json.loads(part.read_text()) == [{"i": 1, "t": "اردو", "x": 0.5}, {"i": 2, "t": "b\tc", "x": None}]
    files.write_review(df, str(tmp_path / "r"), ["i", "t"], ["i"])
    (part,) = (tmp_path / "r").glob("part-*")
    assert part.read_text() == "i\tt\n1\tاردو\n2\tb c\n"
    assert files.markdown(df.orderBy("i"), "T").startswith("## T\n\n| i | t | x |")
    with pytest.raises(ValueError, match="more than"):
        files.markdown(spark.range(10_001), "T")


def test_tar_archives_round_trip(spark):
    df = spark.createDataFrame([("a", f"m{i:03d}", bytes([i % 256]) * i) for i in range(300)], "archive string, member string, content binary")
    parts = files.pack_tar(df, "archive", "member", "content").collect()
    found = {}
    for r in parts:
        with tarfile.open(fileobj=io.BytesIO(bytes(r["content"]))) as tar:
            found |= {m.name: tar.extractfile(m).read() for m in tar}
    assert len(parts) == 2 and found == {f"m{i:03d}": bytes([i % 256]) * i for i in range(300)}


def test_word_list(spark, tmp_path):
    (tmp_path / "w.txt").write_text("كتاب\t5\nx\nآ\nگھر\nعِلم\n12\n", encoding="utf-8")
    assert [r["word"] for r in files.read_words(spark, str(tmp_path / "w.txt")).collect()] == ["کتاب", "گھر", "عِلم"]
    assert files.read_words(spark, str(tmp_path / "w.txt"), top=2).count() == 2


def test_lexicon_is_normalised_when_read(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("كتاب\tkɪt̪ɑːb\t\tɡʱəɾ;t͡ʃaː\n", encoding="utf-8")
    row = files.read_lexicon(spark, str(tmp_path / "l.tsv")).first()
    assert (row["word"], row["pron"], row["source"], row["variants"]) == ("کتاب", "kɪtɑːb", "wikipron", ["ɡʰər", "ʧɑː"])


def test_distances_of_many_words(spark):
    rng = np.random.default_rng(1)
    rows = [([f"w{x}" for x in rng.integers(0, 400, 300)], [f"w{x}" for x in rng.integers(0, 400, 280)]) for _ in range(5)] + [([], ["a"]), (["a"], [])]
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select(edit.sequence_distance(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r["d"] for r in got] == [sum(op != "M" for *_, op in edit.align(a, b)) for a, b in rows]


def test_kernel_rows_are_few(spark):
    points = spark.createDataFrame([(1, [1.0])], "at int, v array<double>")
    with pytest.raises(ValueError, match="more than"):
        vectors.kernel_rows(points, "at", "v", spark.range(10_001).withColumnRenamed("id", "row"), "row")
