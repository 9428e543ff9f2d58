"""Shards, scans that end, steps that can be run again, tails of logs, extension points, guards and likeness of signals."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import phones, registry
from corpusloom.operators import admission, selection, signal
from corpusloom.sources import files, shards
from corpusloom.streaming import steps


@pytest.fixture
def at(spark, tmp_path):
    shards.register(spark)
    return str(tmp_path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_shards_read_columns_types_and_missing_ones(spark, at):
    df = spark.createDataFrame([(i, f"t{i}", bytes([i]) * 5, None if i % 3 else i * 0.5) for i in range(100)], "id long, text string, payload binary, x double")
    shards.write_shards(df, f"{at}/s", ["id"], 5)
    assert len(shards.names(f"{at}/s")) == 5
    read = lambda schema: (spark.read.format("shards").schema(schema) if schema else spark.read.format("shards")).load(f"{at}/s")
    assert read(None).schema.simpleString() == df.schema.simpleString() and rows(read(None).select("id", "text", "x").na.fill(-1.0)) == rows(df.select("id", "text", "x").na.fill(-1.0))
    got = read("payload binary, nothing string, id int").collect()
    assert len(got) == 100 and all(bytes(r["payload"]) == bytes([r["id"]]) * 5 and r["nothing"] is None for r in got)
    one = spark.read.format("shards").option("files", json.dumps(shards.names(f"{at}/s")[:1])).load(f"{at}/s")
    assert 0 < one.count() < 40 and one.agg(F.max("id")).first()[0] < 40
    assert rows(spark.read.format("shards").schema("id long").load(f"{at}/s").filter("id < 0")) == []


def test_no_shards(spark, at, tmp_path):
    (tmp_path / "none").mkdir()
    assert spark.read.format("shards").schema("id long").load(f"{at}/none").count() == 0
    with pytest.raises(Exception, match="no shards"):
        spark.read.format("shards").load(f"{at}/none").count()


def test_stream_goes_on_behind_its_offset(spark, at):
    """Three starts on one checkpoint, one of them with nothing new: each shard is taken once, in the start it came."""
    for start in range(3):
        if start != 1:
            df = spark.range(100 * start, 100 * start + 50).withColumnRenamed("id", "k")
            shards.write_shards(df, f"{at}/new{start}", ["k"], 3)
            files.move_all(spark, f"{at}/new{start}", f"{at}/in", f"{start}-")
        s = spark.readStream.format("shards").schema("k long").load(f"{at}/in").withColumn("start", F.lit(start))
        s.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/cp").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(f"{at}/out").select("k", "start")) == sorted([(k, 0) for k in range(50)] + [(200 + k, 2) for k in range(50)])


def test_scan_ends_when_all_budgets_are_full(spark, at):
    df = spark.createDataFrame([(i, ["a", "b", None][i % 3], i % 2, i % 7 + 1) for i in range(3000)], "id long, who string, flag int, n long")
    shards.write_shards(df, f"{at}/s", ["id"], 20)
    caps = {(w, f): 50.0 if f else 100.0 for w in ("a", "b", None) for f in (0, 1)}
    out, read = shards.admit_until_full(spark, f"{at}/s", f"{at}/out", None, "n", ["who", "flag"], caps, "id", F.floor(F.col("id") / 64))
    cap = F.when(F.col("flag") == 1, 50.0).otherwise(100.0)
    want = selection.admit(df, "n", cap, ["who", "flag"], ["id"])
    key = lambda r: r[0]
    assert sorted(map(tuple, out.select("id", "who", "flag", "n", "spent").collect()), key=key) == sorted(map(tuple, want.select("id", "who", "flag", "n", "spent").collect()), key=key)
    assert 0 < read < 6 < 20
    # a budget that never fills: all is read
    out, read = shards.admit_until_full(spark, f"{at}/s", f"{at}/out2", "id long, who string, flag int, n long", "n", ["who", "flag"], {("nobody", 0): 1.0, ("a", 0): 10.0}, "id", F.floor(F.col("id") / 64), at_once=7)
    assert read == 20 and {r["who"] for r in out.collect()} == {"a"}


@pytest.mark.parametrize("where", ["before", "written", "entered"])
def test_a_batch_that_is_broken_off_is_done_once(spark, at, where):
    spark.range(40).withColumn("part", F.col("id") % 4).repartition("part").write.partitionBy("part").parquet(f"{at}/in")
    stream = lambda: spark.readStream.schema("id long, part int").option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    calls = []

    def step(df, batch):
        calls.append(batch)
        return df

    def crash(batch, point):
        if (batch, point) == (1, where):
            raise RuntimeError("broken off")

    with pytest.raises(Exception, match="broken off"):
        steps.run_steps(stream(), step, at, crash)
    assert rows(steps.finished(spark, at).select("id")) == [(i,) for i in sorted(r[0] for r in steps.finished(spark, at).select("id").collect())]
    n_before = steps.finished(spark, at).count()
    assert n_before == (20 if where == "entered" else 10)
    out = steps.run_steps(stream(), step, at)
    assert rows(out.select("id")) == [(i,) for i in range(40)]
    assert calls.count(1) == {"before": 1, "written": 2, "entered": 1}[where]
    assert rows(steps.run_steps(stream(), step, at).select("id")) == [(i,) for i in range(40)]
    assert steps.Ledger(spark, f"{at}/ledger").batches() == [0, 1, 2, 3]


def test_retention_deletes(spark, at, tmp_path):
    for e in range(5):
        (tmp_path / "epochs" / f"epoch_{e}").mkdir(parents=True)
        (tmp_path / "epochs" / f"epoch_{e}" / "w.bin").write_bytes(b"x")
    keep = spark.createDataFrame([("epoch_1",), ("epoch_4",), ("other",)], "name string")
    assert steps.delete_all_but(spark, f"{at}/epochs", keep, "name") == ["epoch_0", "epoch_2", "epoch_3"]
    assert sorted(p.name for p in (tmp_path / "epochs").iterdir()) == ["epoch_1", "epoch_4"]
    assert steps.delete_all_but(spark, f"{at}/epochs", keep.limit(0), "name") == []


def test_tails(spark, at, tmp_path):
    (tmp_path / "logs" / "deep").mkdir(parents=True)
    texts = {"a.log": "é" * 5000 + "end", "deep/b.log": "short", "c.log": "", "d.log": "😀x" * 999, "e.log": "line\n" * 500}
    for name, t in texts.items():
        (tmp_path / "logs" / name).write_text(t, newline="")
    got = {r["path"].split("/logs/")[1]: (r["length"], r["text"]) for r in files.tails(spark, f"{at}/logs", 100).collect()}
    assert got == {name: (len(t.encode()), t[-100:]) for name, t in texts.items() if t}


def test_own_table_functions_and_aggregates(spark):
    class Own:
        def eval(self, text, times):
            for i in range(times or 0):
                yield (f"{text}{i}",)

    names = registry.register(spark, tables={"corpus_repeat": (Own, "said string")}, aggregates={"corpus_spread": (lambda v: float(v.max() - v.min()), "double")})
    assert {"corpus_repeat", "corpus_spread", "corpus_sentences", "corpus_nanmean", "corpus_nfc"} <= set(names)
    spark.createDataFrame([("a", 2, 1.0), ("b", 3, float("nan")), ("b", None, 4.0), (None, 1, None)], "t string, n int, x double").createOrReplaceTempView("own")
    assert rows(spark.sql("SELECT said FROM own, LATERAL corpus_repeat(t, n) WHERE t IS NOT NULL")) == [("a0",), ("a1",), ("b0",), ("b1",), ("b2",)]
    assert {r[0]: r[1] for r in spark.sql("SELECT t, corpus_nanmean(x) FROM own GROUP BY t").collect()} == {"a": 1.0, "b": 4.0, None: None}
    assert rows(spark.sql("SELECT n, sentence FROM (SELECT ' One. Two!  Three' AS t UNION ALL SELECT NULL), LATERAL corpus_sentences(t)")) == [(0, "One."), (1, "Two!"), (2, "Three")]


def test_parts_of_clips_are_those_of_plain_code(spark):
    registry.register(spark)
    rng = np.random.default_rng(0)
    clips = [np.concatenate([rng.normal(size=n) * (i % 2 == 0) for i, n in enumerate(sizes)]) for sizes in ((4000, 3000, 5000), (4000, 100, 5000), (9000,), (2500, 4000, 1000, 4000, 4000))]
    said = ["One. Two.", "One. Two.", "One.", "One. Two? Three!"]
    df = spark.createDataFrame([(i, c.tolist(), t) for i, (c, t) in enumerate(zip(clips, said, strict=True))] + [(9, None, "x"), (10, clips[0].tolist(), None)], "id int, y array<double>, t string")
    df.createOrReplaceTempView("clips")
    got = rows(spark.sql("SELECT id, part, sentence, dur, size(samples) FROM clips, LATERAL corpus_clip_parts(y, 2000, t, 0.2D, 20.0D)"))
    want = [(i, k, s, round(len(p) / 2000, 3), len(p)) for i, (c, t) in enumerate(zip(clips, said, strict=True)) for k, (p, s) in enumerate(signal.split_clip(c, registry._sentences(t), 2000, 20.0, 0.2))]
    assert got == sorted(want) and len(want) >= 2


def test_edits_without_a_row_are_named(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "text string, k int")
    edits = spark.createDataFrame([("a", "A!")], "text string, edited string")
    assert sorted((r["k"], r["spoken"]) for r in admission.edited(df, "text", edits).collect()) == [(1, "A!"), (2, "b"), (3, "A!"), (4, None)]
    for more, match in (([("a", "A"), ("zebra", "Z")], "zebra"), ([("a", " ")], "an empty edit of: a")):
        with pytest.raises(Exception, match=match):
            admission.edited(df, "text", spark.createDataFrame(more, "text string, edited string")).collect()


def test_guarded_write(spark, at):
    df = spark.range(10).withColumn("x", F.col("id") - 3)
    assert admission.write_guarded(df, f"{at}/ok", {"big": F.col("x") > 100}, least=10) == {"rows": 10, "big": 0}
    assert spark.read.parquet(f"{at}/ok").count() == 10
    with pytest.raises(admission.NotAdmitted, match="3 rows: negative"):
        admission.write_guarded(df, f"{at}/bad", {"negative": F.col("x") < 0})
    with pytest.raises(admission.NotAdmitted, match="10 rows, at least 11"):
        admission.write_guarded(df, f"{at}/few", {}, least=11)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{at}/bad")


def test_retroflex_repair(spark):
    cases = [("لڑکا رات", "lərka rat", "ləɽka rat"), ("رڑر", "rərər", "rəɽər"), ("گھر", "ɡʰər", "ɡʰər"), ("لڑکا", "ləɽka", "ləɽka"), ("لڑ", "lərər", "lərər"), ("پڑھ", "pər.h", "pəɽʰ"), ("ر", "a.b.", "ab."), (None, "r", "r"), ("ڑ", None, None)]
    df = spark.createDataFrame([(i, w, r) for i, (w, r, _) in enumerate(cases)], "i int, w string, r string")
    got = {r["i"]: r["s"] for r in df.select("i", phones.retroflex_repaired(F.col("w"), F.col("r")).alias("s")).collect()}
    assert got == {i: c[2] for i, c in enumerate(cases)}


def test_likeness_is_that_of_plain_code(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=4000)
    pairs = [(a, a * 0.5), (a, np.concatenate([a + rng.normal(size=4000) * 0.3, np.zeros(800)])), (a[:500], a), (a, rng.normal(size=3000))]
    df = spark.createDataFrame([("g", x.tolist(), y.tolist()) for x, y in pairs] + [("g", None, a.tolist())], "g string, a array<double>, b array<double>")
    got = df.select(signal.likeness(24_000)(F.col("a"), F.col("b")).alias("l")).collect()

    def triangle(k, f, edges):
        lo, mid, hi = edges[k : k + 3]
        return max(0.0, min((f - lo) / (mid - lo), (hi - f) / (hi - mid))) * 2 / (hi - lo)

    def to_mel(f):
        return f * 3 / 200 if f < 1000 else 15 + math.log(f / 1000) / (math.log(6.4) / 27)

    def to_hertz(m):
        return m * 200 / 3 if m < 15 else 1000 * math.exp((m - 15) * math.log(6.4) / 27)

    edges = [to_hertz(to_mel(12_000) * i / 81) for i in range(82)]
    filters = np.array([[triangle(k, 12_000 * j / 512, edges) for j in range(513)] for k in range(80)])

    def mel(y):
        padded = np.concatenate([np.zeros(512), y, np.zeros(512)])
        window = np.hanning(1025)[:-1]
        return np.array([np.log(filters @ np.abs(np.fft.rfft(window * padded[i : i + 1024])) ** 2 + 1e-5) for i in range(0, len(y) + 1, 256) if i + 1024 <= len(padded)])

    def corr(x, y):
        return float(np.corrcoef(np.ravel(x), np.ravel(y))[0, 1])

    for (x, y), r in zip(pairs, got, strict=False):
        n = min(len(x), len(y))
        want = (corr(x[:n], y[:n]), corr(mel(x[:n]), mel(y[:n]))) if n >= 1000 else (0.0, 0.0)
        assert r["l"]["wave"] == pytest.approx(want[0], abs=1e-6) and r["l"]["mel"] == pytest.approx(want[1], abs=1e-6)
        assert r["l"]["length_ratio"] == pytest.approx(len(y) / len(x))
    assert got[-1]["l"]["wave"] is None
    p = signal.parity(df, ["g"], "a", "b").first()
    assert p["n"] == 4 and p["min_corr"] == min(r["l"]["wave"] for r in got[:4]) and p["mel_corr_min"] == min(r["l"]["mel"] for r in got[:4])
