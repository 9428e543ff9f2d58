"""Pronunciations learned from a lexicon: letters and phones aligned by expectation-maximisation, a joint n-gram
model as a table, and the n best pronunciations of any word by beam search.

A word is read as graphones: each letter (or each phone that rules give it, to be corrected) with the none, one or two phones it stands for. The counts of each round of
the alignment, and of the n-grams, are sums that Spark aggregates; only tables bounded by the alphabets and by
``MOST_NGRAMS`` come to the driver and are broadcast.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phones of one letter at most.
MOST_PHONES = 2
#: More different letters with phones, or n-grams, are an error: a lexicon of that size needs a bound on its words.
MOST_CHUNKS, MOST_NGRAMS = 200_000, 5_000_000
#: Histories whose next steps a decoder keeps.
MOST_KEPT = 100_000
#: Chance of a letter's phones that were never seen, for the first rounds and for letters a model doesn't know.
FLOOR = 1e-9
END = "</w>"

_GRAPHONE, _BETWEEN = "\t", "\n"


def _forward_backward(letters: list[str], phones: list[str], chance: dict[tuple[str, str], float] | None, counts: dict[tuple[str, str], float]) -> float:
    """Adds the expected counts of (letter, phones) of one word; returns its likelihood, 0 where it can't be aligned."""
    n, m = len(letters), len(phones)
    p = (lambda i, j, k: 1.0) if chance is None else (lambda i, j, k: chance.get((letters[i], " ".join(phones[j : j + k])), FLOOR))
    ahead = [[0.0] * (m + 1) for _ in range(n + 1)]
    ahead[0][0] = 1.0
    for i in range(n):
        for j in range(m + 1):
            if a := ahead[i][j]:
                for k in range(min(MOST_PHONES, m - j) + 1):
                    ahead[i + 1][j + k] += a * p(i, j, k)
    total = ahead[n][m]
    if not total:
        return 0.0
    back = [[0.0] * (m + 1) for _ in range(n + 1)]
    back[n][m] = 1.0
    for i in range(n - 1, -1, -1):
        for j in range(m + 1):
            for k in range(min(MOST_PHONES, m - j) + 1):
                b = p(i, j, k) * back[i + 1][j + k]
                back[i][j] += b
                if b and ahead[i][j]:
                    counts[letters[i], " ".join(phones[j : j + k])] += ahead[i][j] * b / total
    return total


def _best_path(letters: list[str], phones: list[str], chance: dict[tuple[str, str], float]) -> list[str] | None:
    n, m = len(letters), len(phones)
    best: list[dict[int, tuple[float, int]]] = [{0: (0.0, 0)}]
    for i in range(n):
        row: dict[int, tuple[float, int]] = {}
        for j, (s, _) in best[i].items():
            for k in range(min(MOST_PHONES, m - j) + 1):
                t = s + math.log(chance.get((letters[i], " ".join(phones[j : j + k])), FLOOR))
                if j + k not in row or t > row[j + k][0]:
                    row[j + k] = (t, k)
        best.append(row)
    if m not in best[n]:
        return None
    out, j = [], m
    for i in range(n, 0, -1):
        k = best[i][j][1]
        out.append(letters[i - 1] + _GRAPHONE + " ".join(phones[j - k : j]))
        j -= k
    return out[::-1]


def chances(pairs: DataFrame, rounds: int = 8) -> dict[tuple[str, str], float]:
    """P(phones | letter) from (letters array, phones array), by rounds of expectation (in batches) and maximisation (an aggregate)."""
    chance: dict[tuple[str, str], float] | None = None
    for _ in range(rounds):
        held = pairs.sparkSession.sparkContext.broadcast(chance)

        def expect(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            counts: dict[tuple[str, str], float] = defaultdict(float)
            for b in batches:
                for letters, phones in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    _forward_backward(letters, phones, held.value, counts)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.float64())], names=["letter", "phones", "n"])

        found = pairs.select("letters", "phones").mapInArrow(expect, "letter string, phones string, n double")
        rows = found.groupBy("letter", "phones").agg(F.sum("n").alias("n")).limit(MOST_CHUNKS + 1).collect()
        if len(rows) > MOST_CHUNKS:
            raise ValueError(f"more than {MOST_CHUNKS} different letters with phones")
        total: dict[str, float] = defaultdict(float)
        for r in rows:
            total[r["letter"]] += r["n"]
        chance = {(r["letter"], r["phones"]): r["n"] / total[r["letter"]] for r in rows if r["n"] > 1e-6}
        held.unpersist()
    return chance or {}


def align(pairs: DataFrame, letters: Column, phones: Column, rounds: int = 8) -> DataFrame:
    """(letters, phones, graphones): the best alignment of each pair of arrays; pairs that have too many phones for their
    letters, no letters or no phones are left out."""
    rows = pairs.select(letters.alias("letters"), phones.alias("phones")).filter("size(letters) > 0 AND size(phones) > 0")
    held = pairs.sparkSession.sparkContext.broadcast(chances(rows, rounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = [_best_path(w, p, held.value) for w, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(paths, pa.list_(pa.string()))], names=["letters", "phones", "graphones"]).filter(pa.array([x is not None for x in paths], pa.bool_()))

    return rows.mapInArrow(run, "letters array<string>, phones array<string>, graphones array<string>")


def ngrams(aligned: DataFrame, order: int = 4) -> DataFrame:
    """(history, graphone, n): the model as a table; a history is what stood before, of up to ``order`` - 1 graphones."""
    seq = F.concat(F.transform(F.sequence(F.lit(1), F.lit(order - 1)), lambda _: F.lit("")), "graphones", F.array(F.lit(END)))
    rows = aligned.select(seq.alias("s"))
    at = F.explode(F.sequence(F.lit(order), F.size("s")))
    rows = rows.select("s", at.alias("i")).select("s", "i", F.explode(F.sequence(F.lit(0), F.lit(order - 1))).alias("k"))
    history = F.array_join(F.slice("s", F.col("i") - F.col("k"), F.col("k")), _BETWEEN)
    return rows.select(F.col("k").alias("order"), history.alias("history"), F.element_at("s", F.col("i")).alias("graphone")).groupBy("order", "history", "graphone").agg(F.count(F.lit(1)).alias("n"))


def letters_of(word: Column) -> Column:
    """The letters of a word, one by one."""
    return F.filter(F.split(word, ""), lambda c: c != "")


def fit(pairs: DataFrame, letters: Column, phones: Column, order: int = 4, rounds: int = 8) -> DataFrame:
    """The n-gram table of a lexicon. ``letters`` may be what rules say of the word, which the model then corrects."""
    return ngrams(align(pairs, letters, phones, rounds), order)


class Decoder:
    """Beam search over graphones with Witten-Bell interpolation of all orders."""

    def __init__(self, rows: list[tuple[int, str, str, int]]):
        self.order = 1 + max((k for k, *_ in rows), default=0)
        self.counts: list[dict[str, dict[str, int]]] = [{} for _ in range(self.order)]
        self.phones: dict[str, set[str]] = defaultdict(set)
        for k, history, graphone, n in rows:
            self.counts[k].setdefault(history, {})[graphone] = n
            if k == 0 and graphone != END:
                letter, _, phones = graphone.partition(_GRAPHONE)
                self.phones[letter].add(phones)
        self.totals = [{h: (sum(c.values()), len(c)) for h, c in level.items()} for level in self.counts]
        self.base = 1.0 / (1 + sum(map(len, self.phones.values())))
        self.known: dict[tuple[tuple[str, ...], str], list[tuple[str, str, float]]] = {}

    def chance(self, history: tuple[str, ...], graphone: str) -> float:
        p = self.base
        for k in range(self.order):
            h = _BETWEEN.join(history[len(history) - k :]) if k else ""
            seen = self.totals[k].get(h)
            if seen is None:
                break
            total, kinds = seen
            p = (self.counts[k][h].get(graphone, 0) + kinds * p) / (total + kinds)
        return p

    def steps(self, history: tuple[str, ...], letter: str) -> list[tuple[str, str, float]]:
        """(graphone, phones joined, log of its chance) of all graphones of a letter, or of the end, after a history; kept, up to ``MOST_KEPT``."""
        found = self.known.get((history, letter))
        if found is None:
            if letter == END:
                found = [(END, "", math.log(self.chance(history, END)))]
            else:
                of = [(letter + _GRAPHONE + phones, phones.replace(" ", "")) for phones in sorted(self.phones.get(letter, ("",)))]
                found = [(g, said, math.log(self.chance(history, g))) for g, said in of]
            if len(self.known) >= MOST_KEPT:
                self.known.clear()
            self.known[history, letter] = found
        return found

    def nbest(self, letters: list[str], beam: int, n: int) -> list[tuple[str, float]]:
        """(phones joined, log P(phones | letters)) of the n best, normalised over what is in the beam at the end."""
        states = [(0.0, ("",) * (self.order - 1), "")]
        for letter in letters:
            grown: dict[tuple[tuple[str, ...], str], float] = {}
            for score, history, said in states:
                for g, more, chance in self.steps(history, letter):
                    key = ((*history, g)[1:], said + more)
                    s = score + chance
                    if s > grown.get(key, -math.inf):
                        grown[key] = s
            best = sorted(grown.items(), key=lambda x: (-x[1], x[0]))[:beam]
            states = [(s, h, said) for (h, said), s in best]
        ended: dict[str, float] = {}
        for score, history, said in states:
            s = score + self.steps(history, END)[0][2]
            ended[said] = max(s, ended.get(said, -math.inf))
        if not letters or not ended:
            return []
        top = max(ended.values())
        norm = top + math.log(sum(math.exp(s - top) for s in ended.values()))
        return [(said, s - norm) for said, s in sorted(ended.items(), key=lambda x: (-x[1], x[0]))[:n]]


def nbest(words: DataFrame, model: DataFrame, word: str = "word", letters: Column | None = None, beam: int = 5, n: int = 5) -> DataFrame:
    """(word, cands array of (pron, logp)) of each distinct word, best first; ready for :func:`lexicon.rerank`.

    ``letters`` must be as the model was fitted, the word's letters by default. ``model`` is a table from :func:`fit`, at most ``MOST_NGRAMS`` rows. Null and empty words have no candidates.
    """
    rows = model.select("order", "history", "graphone", "n").limit(MOST_NGRAMS + 1).toArrow()
    if rows.num_rows > MOST_NGRAMS:
        raise ValueError(f"more than {MOST_NGRAMS} n-grams: fit on fewer words")
    held = words.sparkSession.sparkContext.broadcast(rows)
    kind = pa.list_(pa.struct([("pron", pa.string()), ("logp", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(list(zip(*(held.value.column(i).to_pylist() for i in range(4)), strict=True)))
        for b in batches:
            found = [[{"pron": p, "logp": s} for p, s in decoder.nbest(x or [], beam, n)] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=["word", "cands"])

    source = letters_of(F.col(word)) if letters is None else letters
    rows = words.select(F.col(word).alias("word"), source.alias("letters")).dropDuplicates(["word"])
    return rows.mapInArrow(run, "word string, cands array<struct<pron:string,logp:double>>")
