"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to order 3. Under frozen counts a symbol seen n times among the N
symbols (q of them distinct) that followed a context costs -log2(n / (N + q)) bits there, one not seen costs the
escape, -log2(q / (N + q)), and then what it costs in the context one byte shorter; below the empty context all
symbols are alike. Where that table is small the costs of every context, symbol and language are worked out once, and
a text's code length under every language is a sum of table rows; else they are worked out for the different
grams of the texts at hand. The shortest code names the language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import tune

#: Documents per language from which the trees are learned, at most on average; whole texts.
DOCS_PER_LANGUAGE = 1500
#: Code lengths are looked up in one dense table of up to so many numbers; beyond that, in sorted ones. Costs are rounded to ``STEP``, so sums are exact and the same.
MAX_DENSE = 8_000_000
STEP = 2.0**-16
#: More different labels than this are no languages: an error.
MAX_LANGUAGES = 5000
#: Bytes scored at a time.
CHUNK = 1 << 20

#: ASCII bytes other than small letters part words.
_TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def prepare(text: str) -> bytes:
    """Lower case, everything but letters to single spaces: what the trees see."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_TABLE).split())


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept out of learning: crc32 of the id as text leaves 2 when divided by 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, n): the four-byte windows of each text, three spaces before it."""
    total: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts.setdefault(lang, []).append(b"   " + prepare(text))
        for lang, parts in texts.items():
            for part in parts:
                x = np.frombuffer(part, np.uint8).astype(np.int64)
                total.setdefault(lang, []).append(x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:])
    for lang, grams in total.items():
        gram, n = np.unique(np.concatenate(grams), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


class Trees:
    """The frozen context trees of all languages as one table of code lengths."""

    def __init__(self, counts: pd.DataFrame, max_dense: int = MAX_DENSE):
        self.langs = sorted(counts["lang"].unique())
        gram, lang = counts["gram"].to_numpy(np.int64), np.searchsorted(self.langs, counts["lang"]).astype(np.int64)
        n = counts["n"].to_numpy(np.int64)
        # every byte that was seen is a symbol (prepared UTF-8 has at most 142), all others are symbol 0
        kept = sorted({32, *np.unique(gram & 255).tolist()})
        self.symbol = np.zeros(256, np.int32)
        self.symbol[kept] = np.arange(1, len(kept) + 1)
        a = self.n_symbols = len(kept) + 1
        s = [self.symbol[gram >> shift & 255].astype(np.int64) for shift in (24, 16, 8, 0)]
        # by order: sorted keys of (language, context) with the cost of the escape, of (language, context, symbol) with its cost
        self.escapes, self.costs = [], []
        for order in range(4):
            context = (lang * a**order + self._context(s, order)) * a + s[3]
            keys, at = np.unique(context, return_inverse=True)
            freq = np.bincount(at, weights=n, minlength=len(keys))
            contexts, of, distinct = np.unique(keys // a, return_inverse=True, return_counts=True)
            total = np.bincount(of, weights=freq, minlength=len(contexts))
            self.escapes.append((contexts, -np.log2(distinct / (total + distinct)) if len(contexts) else total))
            self.costs.append((keys, -np.log2(freq / (total + distinct)[of]) if len(keys) else freq))
        self.node = None
        seen = np.unique(self._context(s, 3))
        if (len(seen) + a * a) * a * max(1, len(self.langs)) <= max_dense:
            self._fill(seen)

    def _context(self, s: list[np.ndarray], order: int) -> np.ndarray:
        """The last ``order`` of the three symbols before one, as a number."""
        a = self.n_symbols
        return [np.zeros_like(s[3]), s[2], s[1] * a + s[2], (s[0] * a + s[1]) * a + s[2]][order]

    def _bits(self, s: list[np.ndarray], lang: int) -> np.ndarray:
        """Exact cost of each symbol ``s[3]`` after the three others in one language."""
        a = self.n_symbols
        out = np.full(len(s[3]), np.log2(a))
        for order in range(4):
            context = lang * a**order + self._context(s, order)
            (known, escape), (keys, cost) = self.escapes[order], self.costs[order]
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, context), len(known) - 1)
            out = np.where(known[at] == context, escape[at] + out, out)  # a context that a language never has costs nothing
            at = np.minimum(np.searchsorted(keys, context * a + s[3]), len(keys) - 1)
            out = np.where(keys[at] == context * a + s[3], cost[at], out)
        return np.rint(out / STEP) * STEP  # below 256 bits: exact in single precision, and sums of 2 ** 29 of them in double

    def _fill(self, seen: np.ndarray) -> None:
        """The dense table: a row for each context of three symbols that was seen, and for each pair of symbols."""
        a = self.n_symbols
        pairs = np.arange(a * a, dtype=np.int64)
        first = np.concatenate([seen // (a * a), np.zeros_like(pairs)])  # symbol 0 has never been seen
        rest = np.concatenate([seen % (a * a), pairs])
        s = [np.repeat(x, a) for x in (first, rest // a, rest % a)]
        s.append(np.tile(np.arange(a, dtype=np.int64), len(first)))
        self.cost = np.zeros((len(s[3]), max(1, len(self.langs))), np.float32)
        for lang in range(len(self.langs)):
            self.cost[:, lang] = self._bits(s, lang)
        node = np.tile(len(seen) + pairs.astype(np.int32), a)
        node[seen] = np.arange(len(seen))
        self.node = node * np.int32(a)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each prepared text under each language."""
        out = np.zeros((len(texts), max(1, len(self.langs))))
        a, held, size = self.n_symbols, [], 0
        for i, t in enumerate(texts):
            for at in range(0, len(t), CHUNK):  # a long text goes in several chunks, each with its context
                held.append((i, (b"   " + t[:CHUNK]) if at == 0 else t[at - 3 : at + CHUNK]))
                size += len(held[-1][1])
                if size >= CHUNK:
                    self._add(out, held, a)
                    held, size = [], 0
        if held:
            self._add(out, held, a)
        return out

    def _add(self, out: np.ndarray, held: list[tuple[int, bytes]], a: int) -> None:
        x = self.symbol[np.frombuffer(b"".join(t for _, t in held), np.uint8)]
        ends = np.cumsum([len(t) for _, t in held])
        starts = ends - [len(t) for _, t in held]
        # windows that reach over two texts belong to none
        cuts = np.column_stack([starts, ends - 3]).ravel()[:-1]
        rows = [i for i, _ in held]
        if self.node is not None:
            bits = self.cost[self.node[(x[:-3] * a + x[1:-2]) * a + x[2:-1]] + x[3:]]
            np.add.at(out, rows, np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)[::2])
            return
        x = x.astype(np.int64)
        grams, at = np.unique(((x[:-3] * a + x[1:-2]) * a + x[2:-1]) * a + x[3:], return_inverse=True)
        s = [grams // a**3, grams // a**2 % a, grams // a % a, grams % a]
        for lang in range(len(self.langs)):
            np.add.at(out[:, lang], rows, np.add.reduceat(self._bits(s, lang)[at], cuts)[::2])


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", docs_per_language: int = DOCS_PER_LANGUAGE) -> Trees:
    """Trees from a sample of the rows of ``df`` that have a text and a language.

    The sample is a share of each language's rows, chosen by a hash of the id so that ``docs_per_language`` are
    expected; its counts, not its texts, come to the driver. More than ``MAX_LANGUAGES`` labels are an error. Rows
    that repeat count each; an empty table gives trees of no language.
    """
    rows = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels: these are no languages")
    rates = {r["lang"]: min(1.0, docs_per_language / r["n"]) for r in sizes}
    if not rates:
        return Trees(pd.DataFrame({"lang": [], "gram": [], "n": []}))
    rate = df.sparkSession.createDataFrame(list(rates.items()), "of string, rate double")  # at most MAX_LANGUAGES rows
    rows, rate = rows.join(F.broadcast(rate), F.col("lang") == F.col("of")), F.col("rate")
    chosen = rows.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < rate * float(1 << 30))
    counts = chosen.select("lang", "text").mapInArrow(count_grams, "lang string, gram long, n long")
    return Trees(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())


def predict(df: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, bits_per_byte.

    ``und`` with score 0 for null texts, texts without a letter, and where no language was learned. The score is
    the probability of the language given the code lengths, all languages being equally likely before. Ties go to
    the first language by name. No other column is read.
    """
    held = df.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            known = [bool(model.langs) and t is not None and has_letter(t) for t in texts]
            ready = [prepare(t) if k else b"" for t, k in zip(texts, known, strict=True)]
            bits = model.code_lengths(ready)
            best = bits.argmin(axis=1)
            low = bits[np.arange(len(bits)), best]
            score = 1 / np.exp2(np.clip(low[:, None] - bits, -1000, 0)).sum(axis=1)
            cols = [
                pa.array([model.langs[b] if k else "und" for b, k in zip(best.tolist(), known, strict=True)], pa.string()),
                pa.array(np.where(known, score, 0.0)),
                pa.array(low / np.maximum(1, [len(t) for t in ready])),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, bits_per_byte double")


def keep_known(df: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose language is not ``und``; in one pass, without a join.

    Null and empty texts and those without a letter go, and all go where no language was learned. Rows that repeat
    stay each. Columns of any name are kept; an empty table gives an empty one.
    """
    tune(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(trees)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            known = [bool(model.langs) and t is not None and has_letter(t) for t in texts]
            bits = model.code_lengths([prepare(t) if k else b"" for t, k in zip(texts, known, strict=True)])
            yield batch.filter(pa.array([k and bool(np.isfinite(b).all()) for k, b in zip(known, bits, strict=True)], pa.bool_()))

    return df.mapInArrow(run, df.schema)
