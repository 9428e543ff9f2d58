"""Pronunciation lexicons as tables: ranked merge, lookup chain, choice of variants and candidates, cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import edit, phones
from ..functions.text import strip_diacritics

# --- fixed values ---
RANKS = {"gold": 0, "wikipron": 1, "agree": 2, "llm": 3, "espeak": 4, "rules": 5, "neural": 6}
SPELLINGS = [("ۂ", "ہ"), ("ئ", "ی"), ("ے", "ی"), ("ہ", "ا")]
IZAFAT, HEH_IZAFAT, HEH, IZAFAT_SOUND = "ِ", "ۂ", "ہ", "eː"
LENGTH_POWER, EDIT_PENALTY, RULES_PRIOR = 0.7, 0.5, -2.0
# --- end of fixed values ---


def rank(source: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in RANKS.items() for x in kv)), source), F.lit(9))


def merge(records: DataFrame) -> DataFrame:
    """(seq, word, pron, source) in order of seq to one entry per word: word, pron, source, variants, seq.

    A better source replaces the entry, old variants included; a record that is not better adds its pronunciation
    as a variant. So the entry is the first record of the best rank, and variants are what came after it, behind those
    that the entry's own record has in ``variants`` (an optional array). A record whose optional ``override`` holds
    replaces whatever came before it.
    """
    if "override" in records.columns:
        reset = records.filter("override").groupBy(F.col("word").alias("__w")).agg(F.max("seq").alias("__reset"))
        records = records.join(reset, F.col("word") == F.col("__w"), "left").filter("seq >= coalesce(__reset, seq)").drop("__w", "__reset")
    if "variants" in records.columns:
        plain = merge(records.drop("variants", "override"))
        entry = records.groupBy(F.col("word").alias("__w")).agg(F.min_by(F.coalesce("variants", F.array().cast("array<string>")), F.struct(rank(F.col("source")), "seq")).alias("__own"))
        out = plain.join(entry, F.col("word") == F.col("__w"))
        own = F.concat("__own", F.array_except("variants", "__own"))
        return out.select("word", "pron", "source", own.alias("variants"), "seq")
    first = records.groupBy("word", "pron", "source").agg(F.min("seq").alias("seq"))  # few rows, before the sort that min_by needs
    best = first.groupBy("word").agg(F.min_by(F.struct("seq", "pron", "source"), F.struct(rank(F.col("source")), "seq")).alias("w"), F.min("seq").alias("first_seq"))
    later = records.join(best, "word").filter((F.col("seq") > F.col("w.seq")) & (F.col("pron") != F.col("w.pron")))
    later = later.groupBy("word", "pron").agg(F.min("seq").alias("seq")).groupBy("word").agg(F.sort_array(F.collect_list(F.struct("seq", "pron"))).alias("v"))
    variants = F.coalesce(F.transform("v", lambda x: x["pron"]), F.array().cast("array<string>"))
    return best.join(later, "word", "left").select("word", F.col("w.pron").alias("pron"), F.col("w.source").alias("source"), variants.alias("variants"), F.col("first_seq").alias("seq"))


def lookup(words: DataFrame, entries: DataFrame) -> DataFrame:
    """(word) to (word, entry, pron): the first hit of the word itself, its bare form, the index of bare forms
    (first entry wins), and the bare form with each of four spellings replaced; null where none hits."""
    bare = strip_diacritics(F.col("word"))
    tries = [("word", F.col("word")), ("word", bare), ("bare", bare)]
    tries += [("word", F.when(bare.contains(a), F.replace(bare, F.lit(a), F.lit(b)))) for a, b in SPELLINGS]
    keys = [F.struct(F.lit(p).alias("p"), F.lit(kind).alias("kind"), key.alias("key")) for p, (kind, key) in enumerate(tries)]
    wanted = words.select("word").distinct().select("word", F.explode(F.array(*keys)).alias("k")).select("word", "k.*").filter("key IS NOT NULL")
    index = entries.select(F.lit("word").alias("kind"), F.col("word").alias("key"), F.col("word").alias("entry"), "pron")
    first = entries.groupBy(strip_diacritics(F.col("word")).alias("key")).agg(F.min_by(F.struct("word", "pron"), "seq").alias("e"))
    index = index.unionByName(first.select(F.lit("bare").alias("kind"), "key", F.col("e.word").alias("entry"), F.col("e.pron").alias("pron")))
    hits = wanted.join(index, ["kind", "key"]).groupBy("word").agg(F.min_by(F.struct("entry", "pron"), "p").alias("h"))
    return words.select("word").distinct().join(hits, "word", "left").select("word", F.col("h.entry").alias("entry"), F.col("h.pron").alias("pron"))


def cascade(words: DataFrame, entries: DataFrame, letters: DataFrame | None = None, rules: Column | None = None) -> DataFrame:
    """(word, pron, source): names of single letters, exact entries, izafat on a known base, lookup, then ``rules``."""
    w = words.select("word").distinct()
    izafat = F.when(F.col("word").endswith(IZAFAT), F.col("word").substr(F.lit(1), F.char_length("word") - 1)).when(F.col("word").endswith(HEH_IZAFAT), F.concat(F.col("word").substr(F.lit(1), F.char_length("word") - 1), F.lit(HEH)))
    w = w.withColumn("base", izafat)
    exact = entries.select(F.col("word").alias("__e"), F.col("pron").alias("exact"))
    any_form = lookup(w.select("word").union(w.filter("base IS NOT NULL").select("base")), entries).select(F.col("word").alias("__f"), F.col("pron").alias("found"))
    of_base = any_form.select(F.col("__f").alias("__b"), F.col("found").alias("of_base"))
    out = w.join(exact, w["word"] == exact["__e"], "left").join(any_form, F.col("word") == F.col("__f"), "left").join(of_base, F.col("base") == F.col("__b"), "left")
    name = F.lit(None).cast("string")
    if letters is not None:
        n = letters.select(F.col("letter").alias("__l"), F.col("name").alias("__name"))
        out, name = out.join(n, strip_diacritics(F.col("word")) == F.col("__l"), "left"), F.col("__name")
    pron = F.coalesce("exact", F.concat("of_base", F.lit(IZAFAT_SOUND)), "found")
    fallback = rules if rules is not None else F.lit(None).cast("string")
    return out.select("word", F.coalesce(name, pron, fallback).alias("pron"), F.when(name.isNotNull(), "letter").when(pron.isNotNull(), "lexicon").otherwise("rules").alias("source"))


def choose_variant(df: DataFrame, word: str, prons: str) -> DataFrame:
    """(word, best, others): by skeleton, canonical symbols, long vowels, length; the first listed on ties."""
    rows = df.select(word, F.posexplode(prons).alias("pos", "raw")).withColumn("p", phones.canonical(F.replace("raw", F.lit(" "), F.lit("")))).filter("p <> ''")
    rows = rows.groupBy(word, "p").agg(F.min("pos").alias("pos"))
    n_long = sum((F.regexp_count("p", F.lit(v)) for v in phones.LONG_VOWELS), F.lit(0))
    score = F.struct(phones.skeleton_ok(F.col(word), F.col("p")).alias("ok"), phones.is_canonical(F.col("p")).alias("canonical"), n_long.alias("n_long"), F.char_length("p").alias("n"), (-F.col("pos")).alias("pos"), F.col("p").alias("p"))
    ranked = rows.withColumn("s", score).groupBy(word).agg(F.sort_array(F.collect_list("s"), asc=False).alias("r"))
    names = F.transform("r", lambda x: x["p"])
    return ranked.select(word, F.element_at(names, 1).alias("best"), F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(1))).alias("others"))


def select_candidate(df: DataFrame, word: str = "word", a: str = "a", b: str = "b", rules: Column | None = None) -> DataFrame:
    """(word, pron, source) from two candidates: equal ones agree; of two valid ones the second if its consonants are
    the first's; else the valid one, the first, or ``rules``."""
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    ok = lambda c: F.coalesce(phones.skeleton_ok(F.col(word), some(c)), F.lit(False))
    rows = df.withColumn("__a", ok(a)).withColumn("__b", ok(b))
    hard = lambda c: F.regexp_replace(F.col(c), f"[^{phones.CONSONANTS}]", "")
    source = (
        F.when(some(a) == some(b), "agree")
        .when(F.col("__a") & F.col("__b") & (hard(a) == hard(b)), "llm")
        .when(F.col("__a"), "espeak")
        .when(F.col("__b"), "llm")
        .when(some(a).isNotNull(), "espeak")
        .otherwise("rules")
    )
    fallback = rules if rules is not None else F.lit(None).cast("string")
    rows = rows.withColumn("source", source)
    return rows.select(word, F.when(F.col("source") == "llm", F.col(b)).when(F.col("source") == "rules", fallback).otherwise(F.col(a)).alias("pron"), "source")


def rerank(df: DataFrame, word: str = "word", candidates: str = "cands", rules: str = "rules") -> DataFrame:
    """(word, pron, source): candidates (pron, logp) that pass the skeleton, scored by length-normalised log
    probability less a penalty per edit from the rules' form; the rules have a fixed prior and win ties."""
    rows = df.select(word, rules, F.posexplode_outer(candidates).alias("pos", "c")).select(word, rules, "pos", "c.pron", "c.logp")
    u, r = phones.units(F.col("pron")), phones.units(F.col(rules))
    rows = rows.withColumn("__ok", F.coalesce(phones.skeleton_ok(F.col(word), F.nullif("pron", F.lit(""))), F.lit(False))).withColumn("__u", u).withColumn("__r", r)
    score = F.col("logp") / F.pow(F.size("__u"), F.lit(LENGTH_POWER)) - EDIT_PENALTY * edit.sequence_distance(F.col("__u"), F.col("__r"))
    rows = rows.withColumn("score", F.when(F.col("__ok"), score))
    best = rows.groupBy(word, rules).agg(F.max(F.when(F.col("score") > RULES_PRIOR, F.struct("score", (-F.col("pos")).alias("p"), "pron"))).alias("b"))
    return best.select(word, F.coalesce("b.pron", rules).alias("pron"), F.when(F.col("b").isNotNull(), "neural").otherwise("rules").alias("source"))


def new_words(words: DataFrame, seq: str, known: list[DataFrame], entries: DataFrame) -> DataFrame:
    """Words whose bare form is in none of ``known`` (tables of ``word``) and that no lookup finds; of those that
    share a bare form the first stays."""
    rows = words.withColumn("__bare", strip_diacritics(F.col("word")))
    for k in known:
        rows = rows.join(k.select(strip_diacritics(F.col("word")).alias("__bare")).distinct(), "__bare", "left_anti")
    hits = lookup(rows, entries).filter("pron IS NOT NULL").select("word")
    rows = rows.join(hits, "word", "left_anti")
    return rows.groupBy("__bare").agg(F.min_by("word", seq).alias("word"), F.min(seq).alias(seq)).select("word", seq)
