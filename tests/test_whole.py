"""Queries over whole texts and whole tables against plain Python, on small fixtures."""

import collections
import re

import numpy as np
import pytest

from corpusloom import catalogue
from corpusloom.functions import edit, phones


def written(spark, folder, **tables):
    """A folder with these tables: name to (rows, schema)."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def long_docs(spark, tmp_path_factory):
    """Documents whose last words are far behind the first 300 characters and the first 1000 words."""
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    docs = [(d, " ".join([f"w{name(i % 700)}" for i in range(1500)] + [f"end{name(d)} last{name(d % 2)}"]) + " Ω☃", lang) for d, lang in enumerate(["en", "fr", "de", "it", "en"])]
    folder = tmp_path_factory.mktemp("long") / "t"
    return docs, written(spark, folder, documents=(docs, "doc_id long, text string, lang string"), benchmark=([(0, "Waaaa and lastaaaa")], "item_id long, text string"))


def records(docs):
    source = {"en": "llm", "fr": "wikipron", "de": "agree"}
    return [(w, f"{w}{d % 3}", source.get(lang, "rules")) for d, text, lang in docs for w in re.findall("[a-z]+", text.lower())]


def test_lexicon_of_whole_texts(spark, long_docs):
    docs, folder = long_docs
    rank, want = {"wikipron": 1, "agree": 2, "llm": 3, "rules": 5}, {}
    for w, pron, source in records(docs):
        if w not in want or rank[source] < rank[want[w][1]]:
            want[w] = (pron, source, [])
        elif pron != want[w][0] and pron not in want[w][2]:
            want[w][2].append(pron)
    got = {r["word"]: (r["pron"], r["source"], r["variants"]) for r in catalogue.QUERIES["lexicon_rank_merge"](spark, folder).collect()}
    assert got == {w: (p, s, ";".join(v)) for w, (p, s, v) in want.items()}


def test_new_words_of_whole_texts(spark, long_docs):
    docs, folder = long_docs
    r = records(docs)
    known = {"waaaa", "and", "lastaaaa"} | {w for w, _, s in r if s == "wikipron"}
    want = collections.Counter(w for w, *_ in r if w not in known)
    assert want and {r["word"]: r["n"] for r in catalogue.QUERIES["oov_new_words"](spark, folder).collect()} == want


# --- oov_chars ---
def test_oov_chars_of_whole_texts(spark, long_docs):
    docs, folder = long_docs
    got = {r["doc_id"]: r["oov"] for r in catalogue.QUERIES["oov_chars"](spark, folder).collect()}
    assert got == {d: "".join(sorted({c for c in text if c not in phones.VOCABULARY})) for d, text, _ in docs}
    assert all("☃" in x for x in got.values())


# --- pairs ---
def turns():
    long = " ".join(f"word{i % 37} of turn" for i in range(60))
    texts = [[long + " the same end", long + " another end, longer", "short", "sharp"], [long, long.replace("word36", "x") + " y", "", "a b"]]
    return [(c, t, ("user", "assistant")[t % 2], text) for c, conv in enumerate(texts) for t, text in enumerate(conv)]


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    """A folder, and (conv_id, turn, role, characters of ref and hyp, their distance, wer) of each pair by plain Python."""
    rows, out = turns(), []
    distance = lambda a, b: sum(op != "M" for *_, op in edit.align(a, b))
    for (c, _, _, ref), (d, t, role, hyp) in zip(rows, rows[1:], strict=False):
        if c == d:
            r, h = (re.sub(r"\s+", " ", re.sub("[^a-z0-9' ]+", " ", x.lower())).strip() for x in (ref, hyp))
            x, y = r.replace(" ", ""), h.replace(" ", "")
            out.append((c, t, role, x, r != h, distance(list(x), list(y)), round(distance(r.split(), h.split()) / len(r.split()), 6) if r else None))
    folder = tmp_path_factory.mktemp("turns") / "t"
    return written(spark, folder, conversations=(rows, "conv_id long, turn int, role string, text string")), out


def test_error_rates_of_whole_turns(spark, scored):
    folder, pairs = scored
    cer = {(c, t): round(n / len(r), 6) if r else None for c, t, _, r, _, n, _ in pairs}
    assert {(r["conv_id"], r["turn"]): r["cer"] for r in catalogue.QUERIES["cer_en_pairs"](spark, folder).collect()} == cer
    assert {(r["conv_id"], r["turn"]): r["wer"] for r in catalogue.QUERIES["wer_pairs"](spark, folder).collect()} == {(c, t): w for c, t, *_, w in pairs}
    every = [n / len(r) for _, _, _, r, _, n, _ in pairs if r]
    floor = [n / len(r) for _, _, role, r, _, n, _ in pairs if r and role == "assistant"]
    limit = {"assistant": max(0.25, sum(floor) / len(floor) + 0.15), "user": 0.78}
    kept = {(r["conv_id"], r["turn"]): r["cer"] for r in catalogue.QUERIES["cer_filter_keep"](spark, folder).collect()}
    assert kept == {(c, t): cer[c, t] for c, t, role, r, _, n, _ in pairs if r and n / len(r) <= limit[role]}
    edges = [0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 1, 10]
    bins = {r["bin"]: r["n"] for r in catalogue.QUERIES["cer_histogram"](spark, folder).collect()}
    assert bins == {i: sum(a <= x < b for x in every) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))}
    for r in catalogue.QUERIES["per_micro"](spark, folder).collect():
        own = [p for p in pairs if p[2] == r["role"]]
        assert r["per"] == pytest.approx(sum(p[5] for p in own) / sum(len(p[3]) for p in own)) and r["wer"] == pytest.approx(sum(p[4] for p in own) / len(own))


# --- gaussian_weighted_rows, cosine_pairs ---
@pytest.fixture(scope="module")
def vecs(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=12).astype("f4").tolist(), int(i % 3)) for i in [*range(45), 510, 511, 1020]] + [(1530 + 509, [1.0] * 12, 7)]
    return rows, written(spark, tmp_path_factory.mktemp("vecs") / "t", embeddings=(rows, "vec_id long, embedding array<float>, label int"))


def test_gaussian_rows_of_all_vectors(spark, vecs):
    rows, folder = vecs
    got = {(r["label"], r["row"], r["pos"]): r["value"] for r in catalogue.QUERIES["gaussian_weighted_rows"](spark, folder).collect()}
    assert len(got) == 4 * 510 * 12
    for label in (0, 1, 2, 7):
        at, v = np.array([i % 510 for i, _, x in rows if x == label]), np.array([e for _, e, x in rows if x == label], np.float64)
        for row in range(1, 511):
            w = np.exp(-0.5 * ((at - row) / 40.0) ** 2)
            want = w @ v / w.sum() if w.sum() > 1e-3 else v.mean(axis=0)
            assert np.allclose([got[label, row, p] for p in range(12)], want, atol=1e-5)


def test_cosine_with_the_label_s_reference(spark, vecs):
    rows, folder = vecs
    got = {r["vec_id"]: (r["ref"], r["cosine"]) for r in catalogue.QUERIES["cosine_pairs"](spark, folder).collect()}
    v, ref = {i: np.array(e, np.float64) for i, e, _ in rows}, {x: min(i for i, _, y in rows if y == x) for _, _, x in rows}
    assert {i: r for i, (r, _) in got.items()} == {i: ref[x] for i, _, x in rows}
    assert all(abs(c - v[i] @ v[r] / np.linalg.norm(v[i]) / np.linalg.norm(v[r])) < 1e-6 for i, (r, c) in got.items())


# --- cardinal_words ---
def test_cardinals_of_all_keys(spark, tmp_path):
    folder = written(spark, tmp_path / "t", lineitem=([(k,) for k in (7, 99_999, 100_000, 2_500_000, 10_000_000, 100_000)], "l_partkey long"))
    got = {r["n"]: r["words"] for r in catalogue.QUERIES["cardinal_words"](spark, folder).collect()}
    assert got.keys() == {7, 99_999, 100_000, 2_500_000, 10_000_000}
    assert (got[100_000], got[2_500_000], got[10_000_000]) == ("ایک لاکھ", "پچیس لاکھ", "ایک کروڑ")
