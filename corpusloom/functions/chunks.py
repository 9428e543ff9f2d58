"""Chunks for synthesis: short sentences merged, long ones cut at marks, then at the limit; folds inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_short(sentences: Column, least: int, most: int) -> Column:
    """Neighbours joined by a space while one of the two is shorter than ``least`` and both together fit ``most``."""

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joins = ((F.char_length(last) < least) | (F.char_length(s) < least)) & (F.char_length(last) + F.char_length(s) + 1 <= most)
        head = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(F.coalesce(joins, F.lit(False)), F.concat(head, F.array(F.concat_ws(" ", last, s)))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(sentences, F.array().cast("array<string>"), step)


def merge_spoken(sentences: Column, least: int, most: int) -> Column:
    """:func:`merge_short` of (text, phonemes) structs by the length of the phones; texts go with them."""

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        a, b = F.char_length(last["phonemes"]), F.char_length(s["phonemes"])
        joins = F.coalesce(((a < least) | (b < least)) & (a + b + 1 <= most), F.lit(False))
        both = F.struct(F.concat_ws(" ", last["text"], s["text"]).alias("text"), F.concat_ws(" ", last["phonemes"], s["phonemes"]).alias("phonemes"))
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(both))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(sentences, F.array().cast("array<struct<text:string,phonemes:string>>"), step)


def fill_lines(text: Column, limit: int) -> Column:
    """Pieces that end in a mark, packed greedily to at most ``limit`` characters; longer pieces are cut hard."""
    pieces = F.filter(F.split(text, r"(?<=[,.!?;:…]) "), lambda p: p != "")

    def cut(piece: Column) -> Column:
        n = F.ceil(F.char_length(piece) / limit).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: F.substring(piece, k * limit + 1, F.lit(limit)))

    def step(acc: Column, p: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        fits = F.char_length(last) + F.char_length(p) + 1 <= limit
        head = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(F.coalesce(fits, F.lit(False)), F.concat(head, F.array(F.concat_ws(" ", last, p)))).otherwise(F.concat(acc, cut(p)))

    return F.when(F.char_length(text) <= limit, F.array(text)).otherwise(F.aggregate(pieces, F.array().cast("array<string>"), step))
