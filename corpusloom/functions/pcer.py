"""Phonetic error rates over words with their phones and languages, by aligned classes of phones."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column

from . import vectorised
from .edit import align

RESULT = "pcer double, pcer_ur double, pcer_en double, n_ref int, lost array<string>"


@vectorised(RESULT)
def _score(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
    out = []
    for words, heard in zip(ref, hyp, strict=True):
        spans, phones, langs = [], [], []
        for w in [] if words is None else words:
            spans.append((w["word"], w["lang"], len(phones), len(phones) + len(w["phones"])))
            phones += list(w["phones"])
            langs += [w["lang"]] * len(w["phones"])
        if not phones:
            out.append((None, None, None, 0, []))
            continue
        wrong, hit, total = {"ur": 0, "en": 0}, set(), 0
        for i, _, op in align(phones, [] if heard is None else list(heard)):
            if op == "M":
                hit.add(i)
            else:  # an insertion counts for the phone at its place, the last one at the end
                wrong[langs[min(i, len(phones) - 1)]] += 1
                total += 1
        lost = [w for w, lang, a, b in spans if lang == "en" and b > a and sum(i in hit for i in range(a, b)) < (b - a) / 2]
        share = lambda lang, wrong=wrong, langs=langs: wrong[lang] / langs.count(lang) if lang in langs else None
        out.append((total / len(phones), share("ur"), share("en"), len(phones), lost))
    return pd.DataFrame(out, columns=["pcer", "pcer_ur", "pcer_en", "n_ref", "lost"])


def pcer(ref: Column, hyp: Column) -> Column:
    """A struct of rates, reference size and lost English words.

    ``ref`` is an array of (word, lang, phones) with phones as classes, ``hyp`` an array of classes. Rates are null
    where there is nothing to count; a word is lost if less than half of its phones match.
    """
    return _score(ref, hyp)
