"""Repeated strings against brute force over all windows."""

import collections
import hashlib
import random

import numpy as np
import pytest

from corpusloom.llm import queries, suffix_dedup
from corpusloom.llm.shared import tune


def plain(texts, length):
    """Maximal removed runs of each text, from a count of every window."""
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)))
    return out


def check(spark, texts, length=100, **kw):
    tune(spark)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, g string, rid long").repartition(3)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(df, length=length, **kw).collect()}
    data = [(t or "").encode() for t in texts]
    for i, (t, want) in enumerate(zip(data, plain(data, length), strict=True)):
        assert [(s["begin"], s["end"]) for s in got[i]["spans"]] == want, i
        at = [0, *[x for w in want for x in w], len(t)]
        assert got[i]["n_bytes"] == len(t) and bytes(got[i]["kept"]) == b"".join(t[a:b] for a, b in zip(at[::2], at[1::2], strict=True))


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefé", k=rng.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (12, 18, 19, 20, 21, 25, 60)]
    out = [prose(60) + rng.choice(passages) + prose(40) + rng.choice(passages) + prose(5) for _ in range(60)]
    base = prose(300)
    out += [base, base] + [" ".join(w if rng.random() > 0.03 else word() for w in base.split(" ")) for _ in range(10)]
    out += [base[i : i + 99 + k] for k, i in enumerate(range(0, 60, 7))]  # at the edge of the length
    out += ["a" * 350, "ab" * 120, "ab" * 60 + "c" + "ab" * 60, "xyz" * 50, None, "", " ", "é" * 80, "日本" * 40, prose(30) * 3]
    return out


@pytest.mark.parametrize("most", [suffix_dedup.MOST, 3])
def test_brute_force(spark, most):
    """``most`` = 3 sends nearly everything through the counted windows, with the same result."""
    check(spark, texts(), most=most)


def test_long_texts_go_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(1)
    long = bytes(rng.integers(97, 123, (1 << 21) + 5000, np.uint8)).decode()
    tune(spark)
    cut = (1 << 21) - 150  # a copied passage that lies over the seam between two pieces
    df = spark.createDataFrame([(1, long), (2, "." * 10 + long[cut : cut + 600]), (3, long[:399]), (4, long[-500:])], "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {1: [(cut, cut + 600), (len(long) - 500, len(long))], 2: [(10, 610)], 3: [], 4: [(0, 500)]}


def test_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    data = [(r["text"] or "").encode() for r in rows]
    got = {r["doc_id"]: r for r in queries.op11_bwt_merge_dedup(spark, sf).collect()}
    for r, t, spans in zip(rows, data, plain(data, 400), strict=True):
        at = [0, *[x for s in spans for x in s], len(t)]
        kept = b"".join(t[a:b] for a, b in zip(at[::2], at[1::2], strict=True))
        g = got[r["doc_id"]]
        assert (g["n_bytes"], g["n_removed"], g["n_spans"], g["kept_sha256"]) == (len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    assert sum(g["n_removed"] > 0 for g in got.values()) > 5


def test_interleave():
    rng = random.Random(5)
    block = np.sort(np.array([rng.randint(0, 4) for _ in range(200)]))
    strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 30))) for _ in range(200)]
    order, common = suffix_dedup.interleave(block, strings, 30)
    rows = [(block[i], strings[i].ljust(32, b"\0")) for i in order]
    assert rows == sorted(rows)
    for k in range(1, 200):
        a, b = rows[k - 1], rows[k]
        assert common[k] == (-1 if a[0] != b[0] else next((i for i in range(32) if a[1][i] != b[1][i]), 32))


def test_empty_and_ids(spark):
    tune(spark)
    df = spark.createDataFrame([(None, "q" * 90), (1, "long enough " * 20), (1, "long enough " * 20)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df, length=100).collect()
    assert sorted((r["doc_id"] or 0, len(r["kept"])) for r in got) == [(0, 90), (1, 0), (1, 0)]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
