"""The Merkle manifest against plain Python."""

import collections
import hashlib

import pytest
from helpers import connect, rows_of, rows_of_sql
from pyspark.sql import functions as F

from corpusloom.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain(rows):
    """(id, leaf) to (subroot, root, proof), level by level."""

    def leaf(r):
        return sha("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in FIELDS))

    def climb(row):
        proofs = [""] * len(row)
        below = [[i] for i in range(len(row))]
        while len(row) > 1:
            runs = [range(i, min(i + 2, len(row))) for i in range(0, len(row), 2)]
            for run in runs:
                for i in run:
                    for x in below[i]:
                        proofs[x] += "".join(row[j] for j in run if j != i)
            below = [sum((below[i] for i in run), []) for run in runs]
            row = [sha("".join(row[i] for i in run)) for run in runs]
        return row[0], proofs

    by = collections.defaultdict(list)
    for r in rows:
        by[r["lang"]].append(((r["doc_id"] is not None, r["doc_id"] or 0), leaf(r), r["doc_id"]))
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[1] for x in sorted(by[g])]) for g in langs}
    root, over = climb([trees[g][0] for g in langs])
    return [(x[2], x[1], trees[g][0], root, trees[g][1][i] + over[k]) for k, g in enumerate(langs) for i, x in enumerate(sorted(by[g]))]


def check(df, **kw):
    rows = [r.asDict() for r in df.select(*FIELDS).collect()]
    out = merkle.manifest(df, FIELDS, **kw).withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"), F.col("path"))).collect()
    assert all(r["folded"] == r["root"] for r in out)
    key = lambda t: tuple(map(str, t))
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in out), key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_blocks_of_any_height(spark, levels):
    """Groups of 1 to 70 rows, lone last nodes, several storeys."""
    rows = [(i, f"s{i % 3}", f"g{g}" if g else None, i * 7 if i % 5 else None, f"text {i} é" if i % 4 else None) for g in range(9) for i in range(100 * g, 100 * g + [70, 1, 2, 3, 5, 9, 17, 33, 64][g])]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), levels=levels)


def test_odd_rows(spark):
    """Null ids, repeated rows, ids shared by different rows, clashing names."""
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "a", "en", 2, "x"), (1, "a", "en", 2, "x"), (1, "a", "en", 2, ""), (-(1 << 63), "", "", 0, "日本" * 1000)]
    df = spark.createDataFrame([(*r, 1, "z", "p") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, gx long, h string, proof string")
    check(df)
    assert merkle.manifest(df.limit(0), FIELDS).count() == 0
    assert merkle.manifest(df.filter("doc_id = 1 and text = ''"), FIELDS).first()["proof"] == ""


def test_tampering_shows(spark, sf):
    got = rows_of(queries.op13_merkle_manifest(spark, sf))
    assert got == rows_of_sql(connect(sf), queries.OP13_SQL)
    at = got[0].index("verified")
    assert {r[at] for r in got[1]} == {True, False}
