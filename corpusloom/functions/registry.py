"""The library's Python functions for SQL, and user functions in their place.

Column functions need no registration; what runs in Python does, to be called from SQL text. ``own`` replaces or adds
functions: a mapping of names to (function on pandas Series, result type), so that a user's phonemiser, transliterator
or normaliser takes part under the same names. Besides scalar functions there are table functions, for ``LATERAL`` joins,
and aggregates of groups, both open to a user's own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.signal import split_clip
from . import edit, rules, text

DEFAULTS: dict[str, tuple[Callable, str]] = {
    "corpus_nfc": (text._nfc.__wrapped__, "string"),
    "corpus_nfd": (text.nfd.__wrapped__, "string"),
    "corpus_expand_numbers": (text.expand_numbers.__wrapped__, "string"),
    "corpus_spell_urls": (text._spell_urls.__wrapped__, "string"),
    "corpus_rules": (rules._pronounce.__wrapped__, "string"),
    "corpus_align": (edit.alignment.__wrapped__, "array<struct<i:int,j:int,op:string>>"),
}


SENTENCE_END = r"(?<=[۔؟!?.])\s+"


def _sentences(text: str | None) -> list[str]:
    return [s for s in re.split(SENTENCE_END, (text or "").strip()) if s]


class _Sentences:
    """The sentences of a text, by number."""

    def eval(self, text: str | None) -> Iterator[tuple[int, str]]:
        yield from enumerate(_sentences(text))


class _Parts:
    """The parts of a clip at its pauses, each with its sentence; see :func:`signal.split_clip`."""

    def eval(self, samples, rate: int, text: str | None, least: float, most: float) -> Iterator[tuple]:
        if samples is None or not text:
            return
        for i, (part, sentence) in enumerate(split_clip(np.asarray(samples, float), _sentences(text), rate, most, least)):
            yield i, sentence, round(len(part) / rate, 3), part.tolist()


#: Table functions: class with ``eval``, and the columns that it yields.
TABLES: dict[str, tuple[type, str]] = {
    "corpus_sentences": (_Sentences, "n int, sentence string"),
    "corpus_clip_parts": (_Parts, "part int, sentence string, dur double, samples array<double>"),
}


def _nanmean(values: pd.Series) -> float | None:
    known = values.dropna()  # neither null nor NaN
    return float(known.mean()) if len(known) else None


#: Aggregates: function of the Series of one group, which must fit a task, and its result type.
AGGREGATES: dict[str, tuple[Callable, str]] = {"corpus_nanmean": (_nanmean, "double")}


def register(spark: SparkSession, own: dict[str, tuple[Callable, str]] | None = None, tables: dict[str, tuple[type, str]] | None = None, aggregates: dict[str, tuple[Callable, str]] | None = None) -> list[str]:
    """Registers the functions, the user's own with or instead of the library's, and returns their names."""
    functions, tables, aggregates = DEFAULTS | (own or {}), TABLES | (tables or {}), AGGREGATES | (aggregates or {})
    for name, (f, kind) in functions.items():
        spark.udf.register(name, F.pandas_udf(f, kind))
    for name, (cls, kind) in tables.items():
        spark.udtf.register(name, F.udtf(cls, returnType=kind))
    for name, (f, kind) in aggregates.items():
        spark.udf.register(name, F.pandas_udf(f, kind, F.PandasUDFType.GROUPED_AGG))
    return sorted({*functions, *tables, *aggregates})
