"""What is let in and refused: nulls, edges, errors, and values against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import admission, frontend, reports


def test_clips_at_their_limits(spark):
    rows = [(1.49, "a"), (1.5, "a"), (2.0, "a"), (15.0, " "), (15.0, "aہے"), (15.1, "a"), (20.0, "ہے"), (20.1, "a"), (None, "a"), (3.0, None)]
    df = spark.createDataFrame(rows, "s double, said string")
    got = df.select(admission.read_clip(F.col("s"), F.col("said")).alias("r"), admission.spoken_clip(F.col("s"), F.col("said")).alias("f")).collect()
    assert [r["r"] for r in got] == [False, False, True, False, False, False, False, False, False, False]
    assert [r["f"] for r in got] == [False, True, True, False, True, True, True, False, False, False]


def test_too_few_rows_are_refused(spark):
    assert admission.require_rows(spark.range(500)).count() == 500
    with pytest.raises(ValueError, match="the list has only 499 rows"):
        admission.require_rows(spark.range(499), what="the list")


def test_lines_of_fitting_length(spark):
    lines = ["x" * 29, "x" * 30, " " + "y" * 160 + " ", "z" * 161, "w" * 40, "v" * 40 + "ہے", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, t string")
    exclude = spark.createDataFrame([("w" * 40,), (None,)], "t string")
    assert sorted(r["i"] for r in admission.english_lines(df, "t", exclude).collect()) == [1, 2]
    assert sorted(r["i"] for r in admission.english_lines(df, "t", exclude.limit(0)).collect()) == [1, 2, 4]


def test_the_first_articles(spark):
    df = spark.createDataFrame([(i * 7 % 11, f"t{i}") for i in range(11)], "seq int, t string")
    assert sorted(r["seq"] for r in admission.first_articles(df, "seq", 4).collect()) == [0, 1, 2, 3]
    assert admission.first_articles(df, "seq", 100).count() == 11
    assert admission.first_articles(df.limit(0), "seq", 4).count() == 0


def test_issues_with_one_title(spark):
    wanted = spark.createDataFrame([("a", "x"), ("b", "y")], "title string, body string")
    issues = spark.createDataFrame([("a", 7, "open"), ("a", 3, "open"), ("a", 1, "closed"), ("b", 2, "closed")], "title string, number int, state string")
    assert {r["title"]: (r["action"], r["number"]) for r in admission.upserts(wanted, issues).collect()} == {"a": ("comment", 3), "b": ("create", None)}


def test_hours_of_histories(spark):
    kind = "map<string,struct<history:array<struct<seconds:double>>>>"
    states = ['{"a": {"history": [{"seconds": 1800}, {"seconds": null}]}, "b": {"history": [{"seconds": 1800}]}}', '{"a": {}, "b": {"history": []}}', "{}", None]
    df = spark.createDataFrame([(s,) for s in states], "j string").select(admission.nested_hours(F.from_json("j", kind)).alias("h"))
    assert [r["h"] for r in df.collect()] == [1.0, 0.0, 0.0, 0.0]


def test_correlation_of_signals(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=1000)
    b = 0.4 * a + rng.normal(size=1000)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b, strict=True)] + [(None, 1.0)], "a double, b double")
    assert df.agg(reports.correlation(F.col("a"), F.col("b")).alias("r")).first()["r"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)
    assert df.limit(999).agg(reports.correlation(F.col("a"), F.col("b")).alias("r")).first()["r"] == 0.0


def test_sums_by_suffix(spark):
    df = spark.createDataFrame([("x_en", 1.0), ("y_en", 2.5), ("en", 9.0), (None, 5.0)], "k string, v double")
    assert {r["suffix"]: r["total"] for r in reports.by_suffix(df, "k", "v", ["en", "ur"]).collect()} == {"en": 3.5, "ur": 0.0}
    assert [r["s"] for r in spark.createDataFrame([(1.23456,), (None,), (float("nan"),)], "x double").select(reports.shown(F.col("x")).alias("s")).collect()] == ["1.235", "n/a", "n/a"]


def test_the_cascade_without_candidates(spark):
    entries = spark.createDataFrame([(1, "کتاب", "kɪtɑːb")], "seq int, word string, pron string")
    words = spark.createDataFrame([("کتاب",), ("قلم",)], "word string")
    plain = frontend.urdu_words(words, entries)
    none = frontend.urdu_words(words, entries, nbest=spark.createDataFrame([], "word string, cands array<struct<pron:string,logp:double>>"))
    assert sorted(map(tuple, plain.collect())) == sorted(tuple(r)[:3] for r in none.collect())
    assert not any(r["rejected"] for r in none.collect())
