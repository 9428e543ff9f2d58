"""Edit distances and error rates as Column expressions; alignment as a UDF.

Distances between word sequences stay in the JVM: the words of each pair are numbered, each number becomes one
character, and the built-in ``levenshtein`` compares the two strings.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vectorised

#: The alphabet that stands for word numbers: characters of one UTF-16 unit each.
_FIRST, _LAST = 0x0100, 0xD7FF


def normalize_en(text: Column) -> Column:
    """Lower case; everything but a-z, 0-9, apostrophe and space to one space; trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9' ]+", " "), r"\s+", " "))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def sequence_distance(a: Column, b: Column) -> Column:
    """Edit distance of two arrays of strings; an error where both together have over 55,000 distinct ones.

    Sequences and their numbers are bound as arguments of lambdas, so that each is made once a pair.
    """

    def coded(x: Column) -> Column:
        def distance(y: Column) -> Column:
            code = lambda s: F.array_join(F.transform(s, lambda w: F.element_at(y["numbers"], w)), "")
            return F.levenshtein(code(y["a"]), code(y["b"]))

        char = lambda w, i: F.decode(F.unhex(F.lpad(F.hex(i + _FIRST), 4, "0")), "UTF-16BE")
        numbers = F.map_from_arrays(x["seen"], F.transform(x["seen"], char))
        found = F.transform(F.array(F.struct(x["a"].alias("a"), x["b"].alias("b"), numbers.alias("numbers"))), distance)[0]
        known = F.when(F.size(x["seen"]) <= _LAST - _FIRST, found).otherwise(F.raise_error(F.lit("too many distinct words for a distance")).cast("int"))
        return F.when((F.size(x["a"]) == 0) | (F.size(x["b"]) == 0), F.greatest(F.size(x["a"]), F.size(x["b"]))).otherwise(known)

    pair = F.struct(a.alias("a"), b.alias("b"), F.array_distinct(F.concat(a, b)).alias("seen"))
    return F.transform(F.array(pair), coded)[0]


def cer(ref: Column, hyp: Column) -> Column:
    """Character error rate of normalised texts, spaces left out; null where the reference is empty; may exceed 1."""
    r, h = F.replace(ref, F.lit(" "), F.lit("")), F.replace(hyp, F.lit(" "), F.lit(""))
    return F.when(F.char_length(r) > 0, F.levenshtein(r, h) / F.char_length(r))


def wer(ref: Column, hyp: Column) -> Column:
    """Word error rate of normalised texts; null where the reference is empty."""
    r, h = words_of(ref), words_of(hyp)
    return F.when(F.size(r) > 0, sequence_distance(r, h) / F.size(r))


def align(ref: list[str], hyp: list[str]) -> list[tuple[int, int, str]]:
    """(i, j, op) along a cheapest alignment: M match, S substitution, D deletion, I insertion.

    Going back from the end, a diagonal step is preferred to a deletion, a deletion to an insertion.
    """
    rows = [list(range(len(hyp) + 1))]
    for i, r in enumerate(ref, 1):
        above, row = rows[-1], [i]
        for j, h in enumerate(hyp, 1):
            row.append(min(above[j - 1] + (r != h), above[j] + 1, row[-1] + 1))
        rows.append(row)
    i, j, steps = len(ref), len(hyp), []
    while i or j:
        cost = rows[i][j]
        same = i and j and ref[i - 1] == hyp[j - 1]
        if i and j and cost == rows[i - 1][j - 1] + (not same):
            i, j = i - 1, j - 1
            steps.append((i, j, "M" if same else "S"))
        elif i and cost == rows[i - 1][j] + 1:
            i -= 1
            steps.append((i, j, "D"))
        else:
            j -= 1
            steps.append((i, j, "I"))
    return steps[::-1]


@vectorised("array<struct<i:int,j:int,op:string>>")
def alignment(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    """:func:`align` of two arrays of strings; null arrays count as empty."""
    of = lambda x: [] if x is None else list(x)
    return pd.Series([[{"i": i, "j": j, "op": op} for i, j, op in align(of(r), of(h))] for r, h in zip(ref, hyp, strict=True)])
