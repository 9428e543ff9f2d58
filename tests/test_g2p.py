"""Alignment, n-grams and beam search against brute force, and the error rate on published held-out words."""

import itertools
import math
import os
from functools import reduce

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import edit, phones, rules
from corpusloom.operators import g2p, lexicon

#: A file of (word, pronunciation) lines of Urdu words that no rule was made from, for the last test.
HELD_OUT = os.environ.get("HELD_OUT_WORDS", "")


@pytest.fixture(scope="module")
def lexicon_(spark):
    rows = [(w, w.replace("sh", "S").replace("x", "ks").replace("e", "")) for w in "shax shine sheet axes exit tax hash has ash sash shah six nest test set shoe his hens".split()]
    return spark.createDataFrame(rows, "word string, pron string")


def test_one_round_is_exact(spark):
    """Expected counts against all alignments, one by one."""
    pairs = [("ab", "xy"), ("aab", "xyy"), ("b", "yx"), ("c", "zzz")]
    chance, want = None, None
    for _ in range(3):
        counts = {}
        for word, said in pairs:
            ways = [ks for ks in itertools.product(range(3), repeat=len(word)) if sum(ks) == len(said)]
            weight = {}
            for ks in ways:
                at, chunks = 0, []
                for c, k in zip(word, ks, strict=True):
                    chunks.append((c, " ".join(said[at : at + k])))
                    at += k
                weight[tuple(chunks)] = math.prod(1.0 if chance is None else chance.get(x, g2p.FLOOR) for x in chunks)
            for chunks, p in weight.items():
                for x in chunks:
                    counts[x] = counts.get(x, 0) + p / sum(weight.values())
        total = {}
        for (c, _), n in counts.items():
            total[c] = total.get(c, 0) + n
        chance = {k: n / total[k[0]] for k, n in counts.items() if n > 1e-6}
        want = chance
    df = spark.createDataFrame([(list(a), list(b)) for a, b in pairs], "letters array<string>, phones array<string>")
    got = g2p.chances(df, rounds=3)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_alignment_and_ngrams(lexicon_):
    aligned = g2p.align(lexicon_, g2p.letters_of(F.col("word")), g2p.letters_of(F.col("pron"))).collect()
    assert len(aligned) == lexicon_.count()
    for r in aligned:
        assert [g.split("\t")[0] for g in r["graphones"]] == r["letters"]
        assert " ".join(g.split("\t")[1] for g in r["graphones"]).split() == r["phones"]
    counts = {}
    for r in aligned:
        s = ["", "", *r["graphones"], g2p.END]
        for i in range(2, len(s)):
            for k in range(3):
                key = (k, "\n".join(s[i - k : i]), s[i])
                counts[key] = counts.get(key, 0) + 1
    model = g2p.fit(lexicon_, g2p.letters_of(F.col("word")), g2p.letters_of(F.col("pron")), order=3).collect()
    assert {(r["order"], r["history"], r["graphone"]): r["n"] for r in model} == counts


def test_beam_is_the_brute_force_best(lexicon_):
    """A beam wide enough finds the best of all pronunciations; probabilities sum to one over them."""
    rows = [tuple(r) for r in g2p.fit(lexicon_, g2p.letters_of(F.col("word")), g2p.letters_of(F.col("pron")), order=3).collect()]
    d = g2p.Decoder(rows)
    for word in ("shes", "taxi", "nets", "zap"):
        best = {}
        for said in itertools.product(*[sorted(d.phones.get(c, {""})) for c in word]):
            history, p = ("", ""), 1.0
            for c, x in zip(word, said, strict=True):
                g = f"{c}\t{x}"
                p *= d.chance(history, g)
                history = (*history, g)[1:]
            p *= d.chance(history, g2p.END)
            pron = "".join(said).replace(" ", "")
            best[pron] = max(best.get(pron, 0), p)
        order = sorted(best, key=lambda k: (-best[k], k))
        got = d.nbest(list(word), beam=10_000, n=5)
        assert [g[0] for g in got] == order[:5]
        assert all(math.isclose(math.exp(s), best[p] / sum(best.values()), rel_tol=1e-9) for p, s in got)
    # chances of all graphones and the end sum to one
    every = [f"{c}\t{x}" for c, xs in d.phones.items() for x in xs] + [g2p.END]
    for h in (("", ""), ("", "s\tS"), ("s\tS", "h\t"), ("no", "such")):
        assert math.isclose(sum(d.chance(h, g) for g in every), 1.0, rel_tol=1e-9)


def test_next_steps_are_worked_out_once():
    rows = [(0, "", "a\tA", 3), (0, "", "a\tB", 1), (0, "", g2p.END, 2), (1, "a\tA", "a\tA", 1), (1, "a\tA", g2p.END, 1)]
    d, asked = g2p.Decoder(rows), []
    plain = d.chance
    d.chance = lambda history, graphone: asked.append((history, graphone)) or plain(history, graphone)
    first = d.nbest(list("aaaa"), 5, 5)
    n = len(asked)
    assert n == len(set(asked)) and d.nbest(list("aaaa"), 5, 5) == first and len(asked) == n


def test_texts_are_read_once(spark, sf, monkeypatch):
    from corpusloom.plans import language

    reads, plain = [], language.words_of
    monkeypatch.setattr(language, "words_of", lambda *a: reads.append(a) or plain(*a))
    out = language.nbest_decoded(spark, sf)
    assert len(reads) == 1 and all("documents" not in f for f in out.inputFiles())


def test_odd_words(spark, lexicon_):
    pairs = lexicon_.unionByName(spark.createDataFrame([("", "x"), (None, "y"), ("ab", None), ("a", "toolongforthat")], "word string, pron string"))
    model = g2p.fit(pairs, g2p.letters_of(F.col("word")), g2p.letters_of(F.col("pron")))
    words = spark.createDataFrame([("tax",), ("tax",), (None,), ("",), ("ßx",)], "word string")
    got = {r["word"]: [c["pron"] for c in r["cands"]] for r in g2p.nbest(words, model, n=1).collect()}
    assert got == {"tax": ["taks"], None: [], "": [], "ßx": ["ks"]}
    nothing = g2p.fit(lexicon_.limit(0), g2p.letters_of(F.col("word")), g2p.letters_of(F.col("pron")))
    assert nothing.count() == 0 and [c["pron"] for c in g2p.nbest(words.limit(1), nothing).first()["cands"]] == [""]


@pytest.mark.skipif(not os.path.exists(HELD_OUT), reason="HELD_OUT_WORDS names no file")
def test_error_rate_below_that_of_the_rules(spark):
    """Each fifth of the held-out words decoded by a model that corrects the rules, learned from the other four.

    The rules have 0.193; published for a network learned from about ten times as many words: 0.163.
    """
    rows = spark.read.option("sep", "\t").option("quote", "").option("comment", "#").csv(HELD_OUT).select(F.col("_c0").alias("word"), phones.canonical(F.col("_c1")).alias("pron"))
    rows = rows.dropna().dropDuplicates(["word"]).withColumn("rules", rules.rules_phones(F.col("word"))).cache()
    part = F.pmod(F.xxhash64("word"), F.lit(5))
    of = lambda c: phones.units(F.col(c))
    folds = [g2p.nbest(rows.filter(part == k), g2p.fit(rows.filter(part != k), of("rules"), of("pron"), order=2), letters=of("rules"), beam=20) for k in range(5)]
    cands = reduce(lambda a, b: a.unionByName(b), folds).join(rows.select("word", "rules"), "word").cache()

    def rate(hyp):
        e = rows.drop("rules").join(hyp, "word").select(edit.sequence_distance(of("pron"), phones.units(F.col("hyp"))).alias("e"), F.size(of("pron")).alias("n"))
        return e.agg(F.sum("e") / F.sum("n")).first()[0]

    assert rows.count() == 626
    alone = rate(cands.select("word", F.coalesce(F.col("cands")[0]["pron"], F.lit("")).alias("hyp")))
    ranked = rate(lexicon.rerank(cands).withColumnRenamed("pron", "hyp"))
    assert rate(rows.select("word", F.col("rules").alias("hyp"))) == pytest.approx(0.193, abs=5e-4)
    assert alone < 0.180 and ranked < 0.182
