"""Toxicity scores: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Features: densities of a small lexicon and of words and word beginnings learned from labelled rows, how near those
stand to the second person, capitals, punctuation, obfuscation and elongation rates, and length. Labelled rows are
dealt to three parts by a hash, so that no step is fitted on rows that an earlier one has learned by heart: the
terms that a row's features use are learned from the other two parts, trees from two parts, the calibration from
the third. Scores use the terms of all parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows from which everything is learned, at most on average; whole texts.
MAX_LABELLED = 24_000
#: Learned terms: in so many toxic documents at least, and so much likelier there (natural logarithm).
MIN_DOCS, MIN_ODDS = 3, 2.5
#: Lengths of word beginnings, in bytes.
PREFIXES = (4, 5, 6)
#: Words and their weights kept in a worker; emptied when full.
CACHE = 300_000

#: A plain list of insults, so that few labels are enough.
INSULTS = frozenset(b"idiot idiots moron morons stupid loser losers pathetic worthless disgusting scum trash clown imbecile dumb fool bastard jerk garbage".split())
#: Second person in some languages.
SECOND = frozenset(
    "you your yours yourself du dein deine dich dir ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".encode().split()
)
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_MIXED = re.compile(rb"[a-z]+[0-9@$*!|]+[a-z][a-z0-9@$*!|]*")
_LONG = re.compile(rb"([a-z])\1\1")
_PLAIN = bytes.maketrans(b"013457@$!|", b"oieastasil")
NAMES = ["insult_density", "insults", "term_density", "term_weight", "term_max", "term_kinds", "near_second", "second_density", "capitals", "capital_words", "bangs", "symbols", "digits", "obfuscated", "obfuscated_insults", "elongated", "words", "word_length", "non_ascii", "lines"]


class Weights(dict):
    """A word's weight: the largest among the word and its beginnings in ``terms``, and whether it is an insult."""

    def __init__(self, terms: dict[bytes, float]):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: bytes) -> float:
        get = self.terms.get
        w = max(get(b"=" + word, 0.0), *(get(word[:k], 0.0) for k in PREFIXES))
        self[word] = w
        return w


def features(texts: list[str | None], weights: Weights) -> np.ndarray:
    """A row of :data:`NAMES` for each text; null is empty text, and that has zeros."""
    out = np.zeros((len(texts), len(NAMES)), np.float32)
    if len(weights) > CACHE:
        weights.clear()
    for row, text in zip(out, texts, strict=True):
        raw = (text or "").encode("utf-8", "replace")
        if not raw:
            continue
        low = text.lower().encode("utf-8", "replace")
        words = low.translate(_LETTERS).split()
        n = max(1, len(words))
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
        found = [(i, w) for i, w in enumerate(map(weights.__getitem__, words)) if w]
        rude = {i for i, w in enumerate(words) if w in INSULTS}
        second = [i for i, w in enumerate(words) if w in SECOND]
        near = 0
        if second and (found or rude):
            at = np.array(sorted(rude.union(i for i, _ in found)))
            k = np.searchsorted(second, at)
            s = np.array([-100, *second, 1 << 60])
            near = int((np.minimum(at - s[k], s[k + 1] - at) <= 5).sum())
        mixed = _MIXED.findall(low) if digits or counts[[33, 36, 42, 64, 124]].any() else []
        masked = sum(any(x.translate(_PLAIN, b"*").startswith(y) for y in INSULTS) for x in mixed)
        total = len(raw)
        row[:] = (
            len(rude) / n, min(20, len(rude)), len(found) / n, sum(w for _, w in found) / n, max((w for _, w in found), default=0.0),
            min(20, len({words[i] for i, _ in found})), near / n, len(second) / n, upper / max(1, upper + lower),
            sum(map(str.isupper, text.split())) / n if upper > 1 else 0.0, counts[33] / n, (counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / total,
            digits / total, len(mixed) / n, masked, len(_LONG.findall(low)) / n, np.log1p(len(words)), sum(map(len, words)) / n, counts[128:].sum() / total, counts[10] / n,
        )
    return out


def _terms(words: set[bytes]) -> set[bytes]:
    return {b"=" + w for w in words}.union(w[:k] for w in words for k in PREFIXES if len(w) >= k)


PARTS = 3


def learn_terms(df: DataFrame) -> list[dict[bytes, float]]:
    """Terms that stand in many more toxic documents of (text, toxic, part) than others, and their log odds.

    One dictionary for each part, learned from the other parts, and at last one from all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for text, toxic, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for t in _terms(set((text or "").lower().encode("utf-8", "replace").translate(_LETTERS).split())):
                    if (n := seen.get(t)) is None:
                        n = seen[t] = np.zeros(2 * PARTS, np.int64)
                    n[2 * part + (toxic == 1)] += 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), *map(pa.array, np.stack(list(seen.values())).T)], names=["term", *(f"n{i}" for i in range(2 * PARTS))])

    names = [f"n{i}" for i in range(2 * PARTS)]
    both = df.groupBy("part").agg(F.count_if(F.col("toxic") == 0).alias("good"), F.count_if(F.col("toxic") == 1).alias("bad")).collect()
    size = np.zeros(2 * PARTS)
    for r in both:
        size[2 * r["part"]], size[2 * r["part"] + 1] = r["good"], r["bad"]
    rows = df.mapInArrow(run, "term binary, " + ", ".join(f"{n} long" for n in names)).groupBy("term").agg(*(F.sum(n).alias(n) for n in names))
    bad = sum((F.col(n) for n in names[1::2]), F.lit(0))
    good = sum((F.col(n) for n in names[::2]), F.lit(0))
    # what no part can do without, before anything comes to the driver
    rows = rows.filter((bad >= MIN_DOCS) & (F.log(bad + 0.5) - F.log(good + 0.5) >= MIN_ODDS - 1 + float(np.log((size[1::2].sum() + 1) / (size[::2].sum() + 1)))))
    found = rows.toPandas()  # bounded by the labelled rows: each term stands in MIN_DOCS toxic ones at least
    n = found[names].to_numpy(float)
    out = []
    for part in range(PARTS + 1):
        keep = [2 * k for k in range(PARTS) if k != part]
        g, b = n[:, keep].sum(axis=1), n[:, [k + 1 for k in keep]].sum(axis=1)
        odds = np.log((b + 0.5) / (size[[k + 1 for k in keep]].sum() + 1)) - np.log((g + 0.5) / (size[keep].sum() + 1))
        ok = (b >= MIN_DOCS) & (odds >= MIN_ODDS)
        out.append({bytes(t): float(o) for t, o, y in zip(found["term"], odds, ok, strict=True) if y})
    return out


@dataclass
class Boosted:
    """Trees of one depth, as arrays: per tree and inner node a feature and a threshold, per leaf a value."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(value)))):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Boosted:
    """Logistic gradient boosting with Newton leaves on histograms; ``least`` is the hessian a leaf needs."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    raw, inner = np.full(len(y), base), 2**depth - 1
    features_, thresholds, values = [], [], []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-raw))
        g, h = y - q, q * (1 - q)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            for f, c in enumerate(cuts):
                key = local * (bins + 1) + binned[:, f]
                gs = np.bincount(key, g, width * (bins + 1)).reshape(width, -1).cumsum(axis=1)
                hs = np.bincount(key, h, width * (bins + 1)).reshape(width, -1).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                gain[(hs < least) | (ht - hs < least)] = 0
                gain = gain[:, : len(c)]
                if not gain.size:
                    continue
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better], feature[first : first + width][better], threshold[first : first + width][better] = top[better], f, c[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        raw += value[leaf]
        features_.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Boosted(base, np.array(features_), np.array(thresholds), np.array(values))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising function from raw scores to probabilities, kept off 0 and 1."""
    blocks: list[list[float]] = []  # sum, count, lowest and highest raw score
    for s in np.unique(raw):
        m = raw == s
        blocks.append([float(y[m].sum()), float(m.sum()), s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a[0], blocks[-1][1] + a[1], blocks[-1][2], a[3]]
    x = [v for b in blocks for v in (b[2], b[3])]
    p = [(b[0] + 0.1) / (b[1] + 0.2) for b in blocks for _ in range(2)]
    return np.array(x), np.maximum.accumulate(np.array(p))


@dataclass
class Model:
    terms: dict[bytes, float]
    trees: Boosted | None
    knots: tuple[np.ndarray, np.ndarray] | None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:  # nothing to learn from: the share of insults alone
            return np.minimum(1.0, 10.0 * x[:, 0].astype(float))
        raw = self.trees.raw(x)
        if self.knots is None:
            return 1 / (1 + np.exp(-raw))
        return np.clip(np.interp(raw, *self.knots), 0, 1)


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> Model:
    """A model from rows of ``df`` whose id has a label of 0 or 1 in ``labels``.

    A document labelled several times is toxic if any label says so. Of more than ``max_labelled`` labels a share
    is chosen by a hash of the id. Terms, numbers of features and labels come to the driver, no texts. Null texts
    count as empty, and rows of ``df`` that repeat count each. Without labels of both kinds, or with an empty table,
    the model scores by the share of insults alone.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("toxic"))
    n = known.count()
    key = F.pmod(F.xxhash64("__id", F.lit("toxic")), F.lit(3 << 28))
    sample = known.filter(key < min(1.0, max_labelled / max(1, n)) * float(3 << 28))
    sample = F.broadcast(sample.withColumn("part", F.pmod(F.xxhash64("__id", F.lit("part")), F.lit(PARTS))))  # max_labelled rows
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(sample, "__id").select("text", "toxic", "part")
    *others, terms = learn_terms(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [Weights(t) for t in others]
        for batch in batches:
            texts, parts = batch.column(0).to_pylist(), np.array(batch.column(2).to_pylist(), np.int64)
            x = np.zeros((len(texts), len(NAMES)), np.float32)
            for k in range(PARTS):
                at = np.flatnonzero(parts == k)
                x[at] = features([texts[i] for i in at], weights[k])
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float32())), batch.column(1), batch.column(2)], names=["x", "toxic", "part"])

    found: pd.DataFrame = rows.mapInArrow(run, f"x array<float>, toxic {dict(rows.dtypes)['toxic']}, part long").toPandas()
    fit, calibrate = found[found["part"] < PARTS - 1], found[found["part"] == PARTS - 1]
    if fit["toxic"].nunique() < 2:
        return Model(terms, None, None)

    def split(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        x = np.stack(part["x"].to_list()).astype(np.float32)
        order = np.lexsort(x.T)  # the same model whatever order the rows came in
        return x[order], part["toxic"].to_numpy(float)[order]

    trees = boost(*split(fit))
    if calibrate["toxic"].nunique() < 2:
        return Model(terms, trees, None)
    x, y = split(calibrate)
    return Model(terms, trees, isotonic(trees.raw(x), y))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score, features. Null and empty texts are scored as texts without words."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        weights = Weights(m.terms)
        for batch in batches:
            x = features(batch.column(1).to_pylist(), weights)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.score(x)), pa.array(list(x), pa.list_(pa.float32()))], names=["doc_id", "score", "features"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, features array<float>")
