"""The pipeline's stages against brute force on a small fixture."""

import collections

import pytest
from test_llm import WORD, brute_components, empty, odd  # noqa: F401

import corpus_pipeline
from corpusloom.llm.shared import tune


@pytest.fixture(scope="module")
def stages(spark, sf):
    tune(spark)
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs := stage(spark, docs, sf).cache())
    return out


def test_pipeline(spark, sf, stages):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    language, exact, near, mix, pack = stages
    for stage in stages[:-1]:
        assert stage.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"] for r in language.collect()} == {i for i, t in texts.items() if any(map(str.isalpha, t or ""))}
    best = {}
    for r in language.collect():
        key = "".join(WORD.findall(r["text"]))
        best[key] = min(best.get(key, (1, 0)), (-len(r["text"]), r["doc_id"]))
    kept = {i for _, i in best.values()}
    assert {r["doc_id"] for r in exact.collect()} == kept
    first = {c for _, c in brute_components({i: texts[i] for i in kept}).values()}
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(first)
    copies = collections.Counter(r["doc_id"] for r in mix.collect())
    assert set(copies) <= first and max(copies.values()) <= 3
    assert collections.Counter(r["doc_id"] for r in pack.filter("piece = 0").collect()) == copies
    assert corpus_pipeline.run(spark, sf).count() == pack.count()


def test_every_stage_on_an_odd_and_on_an_empty_table(spark, sf, odd, empty):  # noqa: F811
    for table in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, sf)
            rows = out.collect()
            if name != "pack":
                assert out.columns == table.columns, name
            if table is empty:
                assert not rows, name
            elif name == "language":
                assert {r["doc_id"] for r in rows} == {None, 1, 4, 5, 6, 7, 10, 11, 12, 13, 14} and sum(r["doc_id"] == 4 for r in rows) == 2
            elif name == "exact":
                assert sorted(r["doc_id"] or -1 for r in rows) == [-1, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14]
            elif name == "near":
                ids = [r["doc_id"] for r in rows]
                assert {2, 3, 8, 9}.issubset(ids) and {5, 7, 12}.isdisjoint(ids) and ids.count(4) == 2 and ids.count(None) == 2
            elif name == "mix":
                assert max(collections.Counter(r["doc_id"] for r in rows).values()) <= 2 * 3
            else:
                assert collections.Counter(r["doc_id"] for r in rows if r["piece"] == 0) == collections.Counter(r["doc_id"] for r in table.collect())
