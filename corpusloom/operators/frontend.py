"""From sentences to phones: words of either language looked up once each, pieces put together by place; chunks of them.

English pronunciations come as a table (word, pron), in place of a pronunciation engine. A word that no table knows is
named in ``missing``, and a symbol outside the vocabulary in ``unknown``; a result with either has no phones, since
leaving a phone out would change a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chunks, phones, text, tokens
from ..functions.rules import rules_phones
from . import lexicon, reports

# --- fixed values ---
MARKS = ',.!?;:—…"()“”'
SHORTEST, LONGEST = 3, 510
OOD_SHORTEST, OOD_LONGEST = 20, 500
MIN_TOKENS, MAX_TOKENS = 10, 400
SEPARATOR = "<sep>"
# --- end of fixed values ---


def urdu_words(words: DataFrame, entries: DataFrame, letters: DataFrame | None = None, nbest: DataFrame | None = None) -> DataFrame:
    """(word, pron, source) of distinct Urdu words: the cascade, with the rules for what no lexicon knows.

    ``nbest`` (word, cands: array of pron and logp), one row a word, competes with the rules; where they win against
    candidates, ``source`` is ``rules`` and ``rejected`` holds.
    """
    said = lexicon.cascade(words, entries, letters, rules=rules_phones(F.col("word")))
    if nbest is None:
        return said
    offers = said.filter("source = 'rules'").join(nbest.filter(F.size("cands") > 0), "word").select("word", "cands", F.col("pron").alias("rules"))
    chosen = lexicon.rerank(offers).select(F.col("word").alias("__w"), F.col("pron").alias("__pron"), F.col("source").alias("__source"))
    out = said.join(chosen, F.col("word") == F.col("__w"), "left")
    return out.select("word", F.coalesce("__pron", "pron").alias("pron"), F.coalesce("__source", "source").alias("source"), F.coalesce(F.col("__source") == "rules", F.lit(False)).alias("rejected"))


def source_tokens(word: Column, said: Column) -> Column:
    """Input of a model that corrects the rules: the letters, a separator, the units of the rules' phones."""
    return F.concat(F.filter(F.split(word, ""), lambda c: c != ""), F.array(F.lit(SEPARATOR)), phones.units(said))


def urdu_phones(df: DataFrame, key: str, column: str, entries: DataFrame, letters: DataFrame | None = None) -> DataFrame:
    """(key, phonemes, sources) of Urdu spans: words between white space, joined, in the canonical phone set."""
    words = df.select(F.col(key).alias("__key"), F.posexplode(F.filter(F.split(F.trim(text.normalize_chars(F.col(column))), r"\s+"), lambda w: w != "")).alias("pos", "word"))
    said = urdu_words(words.select("word"), entries, letters)
    one = F.struct("pos", "pron", "source")
    found = words.join(said, "word").groupBy("__key").agg(F.sort_array(F.collect_list(one)).alias("p"))
    joined = phones.canonical(F.array_join(F.filter(F.transform("p", lambda x: x["pron"]), lambda p: p != ""), " "))
    found = found.select("__key", joined.alias("phonemes"), F.transform("p", lambda x: x["source"]).alias("sources"))
    out = df.select(F.col(key)).join(found, F.col(key).eqNullSafe(F.col("__key")), "left")
    return out.select(key, F.coalesce("phonemes", F.lit("")).alias("phonemes"), F.coalesce("sources", F.array().cast("array<string>")).alias("sources"))


def source_counts(said: DataFrame) -> DataFrame:
    """(source, n): how many words each step of the cascade has answered; ``neural_rejected`` counts candidates that
    lost against the rules, whose words count under ``rules`` too."""
    if "rejected" in said.columns:
        said = said.select(F.explode(F.when(F.col("rejected"), F.array("source", F.lit("neural_rejected"))).otherwise(F.array("source"))).alias("source"))
    return said.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def _english(tagged: DataFrame, english: DataFrame, retroflex: bool) -> DataFrame:
    """(key, pos, piece, missing) of the tokens of English runs: acronyms spelled, spoken ones looked up capitalised.
    Each different token is looked up and its sounds mapped once, then brought back to its places."""
    table = english.select(F.col("word").alias("__w"), F.col("pron").alias("__pron"))
    rows, kind = tagged.filter(F.col("tag").isin(*tokens.ENGLISH)), ["token", "tag", "accent"]
    asked = F.when(F.col("tag") == "en_acronym_word", F.initcap("token")).otherwise(F.col("token"))
    once = rows.select(*kind).distinct().withColumn("__asked", asked)
    exact = once.join(table, F.col("__asked") == F.col("__w"), "left").drop("__w")
    lower = table.toDF("__l", "__lower")
    once = exact.join(lower, F.lower("__asked") == F.col("__l"), "left")
    spoken = F.when(F.col("tag") == "en_acronym", tokens.spell(F.col("token"))).otherwise(F.coalesce("__pron", "__lower"))
    once = once.withColumn("__raw", spoken)
    mapped = F.when(F.col("accent") == "native", phones.to_native(F.col("__raw"))).otherwise(phones.to_pakistani(F.col("__raw"), retroflex=retroflex))
    said = once.select(*kind, mapped.alias("piece"), F.when(F.col("__raw").isNull(), F.col("token")).alias("missing"))
    return rows.join(said, kind).select("key", "pos", "piece", "missing")


def phonemize(df: DataFrame, key: str, column: str, entries: DataFrame, english: DataFrame, letters: DataFrame | None = None, known: DataFrame | None = None, accent: str = "auto", retroflex: bool = True, normalized: bool = False, strict: bool = False) -> DataFrame:
    """(key, phonemes, accent, missing, unknown): one row per row of ``df``, whose ``key`` is unique.

    Text is normalised (unless ``normalized``), tagged, and each token turned into phones: Urdu words by the cascade,
    English ones by ``english`` with the accent mapped, numbers that survived in Urdu words, marks kept and put behind
    the word before. ``accent`` is native, pakistani, or auto (by the share of English tokens). Null and empty texts
    have empty phones. With ``strict`` an unknown symbol or missing word is an error, as a synthesiser wants it.
    """
    source = F.coalesce(F.col(column), F.lit(""))
    rows = df.select(F.col(key).alias("key"), (source if normalized else text.normalize(source)).alias("text"))
    tagged = tokens.tag(rows, "key", "text", known)
    chosen = tokens.accent(tagged, "key") if accent == "auto" else rows.select("key", F.lit(accent).alias("accent"))
    tagged = tagged.join(chosen, "key")
    # each Urdu word once; digits that survived are read first
    said = F.when(F.col("tag") == "ur", F.array("token")).when(F.col("tag") == "num_ur", F.filter(F.split(text.expand_numbers(F.col("token")), r"\s+"), lambda w: w != ""))
    urdu = tagged.filter(F.col("tag").isin("ur", "num_ur")).select("key", "pos", F.posexplode(said).alias("k", "word"))
    prons = urdu_words(urdu.select("word"), entries, letters).select("word", "pron")
    one = F.struct("k", F.coalesce("pron", F.lit("")).alias("pron"))
    urdu = urdu.join(prons, "word").groupBy("key", "pos").agg(F.sort_array(F.collect_list(one)).alias("p"), F.min(F.when(F.col("pron").isNull(), F.col("word"))).alias("missing"))
    urdu = urdu.select("key", "pos", F.array_join(F.transform("p", lambda x: x["pron"]), " ").alias("piece"), "missing")
    mark = text.normalize_punctuation(F.col("token"))
    kept = tagged.filter(F.col("tag") == "punct").select("key", "pos", F.when(F.translate(mark, MARKS, "") == "", mark).alias("piece"), F.lit(None).cast("string").alias("missing"))
    pieces = urdu.unionByName(_english(tagged, english, retroflex)).unionByName(kept)
    one = F.struct("pos", "piece")
    whole = pieces.groupBy("key").agg(F.sort_array(F.collect_list(F.when(F.col("piece") != "", one))).alias("p"), F.array_sort(F.collect_set("missing")).alias("missing"))
    joined = text.nfd(F.array_join(F.transform("p", lambda x: x["piece"]), " "))
    joined = F.regexp_replace(F.trim(F.regexp_replace(joined, r"\s+", " ")), r"\s+([,.!?;:…])", "$1")
    whole = whole.select(F.col("key").alias("__key"), joined.alias("raw"), "missing")
    out = rows.select("key").join(whole, F.col("key").eqNullSafe(F.col("__key")), "left").join(chosen.withColumnRenamed("key", "__k"), F.col("key").eqNullSafe(F.col("__k")), "left")
    none = F.array().cast("array<string>")
    out = out.select(F.col("key").alias(key), F.coalesce("raw", F.lit("")).alias("raw"), F.coalesce("accent", F.lit("pakistani")).alias("accent"), F.coalesce("missing", none).alias("missing"))
    out = out.withColumn("unknown", F.array_sort(phones.unknown_symbols(F.col("raw"))))
    good = (F.size("missing") == 0) & (F.size("unknown") == 0)
    said = F.when(good, F.col("raw"))
    if strict:
        said = F.coalesce(said, F.raise_error(F.concat(F.lit("outside the vocabulary or any lexicon: "), F.array_join(F.concat("unknown", "missing"), " "))))
    return out.select(key, said.alias("phonemes"), "accent", "missing", "unknown")


def chunk_text(df: DataFrame, key: str, column: str, least: int = MIN_TOKENS, most: int = MAX_TOKENS, **options) -> DataFrame:
    """(key, n, text, phonemes): sentences turned into phones (``options`` of :func:`phonemize`), neighbours merged
    while one of the two is short, and what is too long cut at marks, then hard. Sentences without phones are left out."""
    s = text.split_sentences(F.col(column))
    rows = df.select(F.col(key).alias("__id"), F.posexplode(F.when(F.size(s) > 0, s).otherwise(F.array(F.col(column)))).alias("k", "text"))
    rows = rows.withColumn("sid", F.struct("__id", "k"))
    said = phonemize(rows, "sid", "text", **options).select("sid", "phonemes")
    rows = rows.select("sid", "text").join(said, "sid").filter(F.trim("phonemes") != "")
    one = F.struct(F.col("sid.k").alias("k"), "text", "phonemes")
    lists = rows.groupBy(F.col("sid.__id").alias(key)).agg(F.sort_array(F.collect_list(one)).alias("s"))
    merged = chunks.merge_spoken(F.transform("s", lambda x: F.struct(x["text"].alias("text"), x["phonemes"].alias("phonemes"))), least, most)
    parts = F.flatten(F.transform(merged, lambda x: F.transform(chunks.fill_lines(x["phonemes"], min(most, LONGEST)), lambda p: F.struct(x["text"].alias("text"), p.alias("phonemes")))))
    return lists.select(key, F.posexplode(parts).alias("n", "c")).select(key, "n", "c.text", "c.phonemes")


def phone_reason(said: Column) -> Column:
    """Why a row's phones can't be used: oov, empty, too_long; ``kept`` otherwise. Null phones are an ``exception``."""
    n = F.char_length(said)
    return reports.first_reason({"exception": said.isNull(), "oov": F.size(phones.unknown_symbols(said)) > 0, "empty": n < SHORTEST, "too_long": n > LONGEST})


def ood_line(said: Column, english: Column) -> Column:
    """The line of phones that a list of unseen sentences takes, or null: of English its known symbols alone."""
    line = F.when(english, F.trim(phones.only_known(said))).otherwise(said)
    return F.when(F.char_length(line).between(OOD_SHORTEST, OOD_LONGEST) & (F.size(phones.unknown_symbols(line)) == 0), line)


def training_pairs(entries: DataFrame, test_words: DataFrame) -> DataFrame:
    """(word, pron) to learn from: entries and their first variant, without spaces, of words that are not tested."""
    rows = entries.join(test_words.select(F.col("word").alias("__t")).distinct(), F.col("word") == F.col("__t"), "left_anti")
    prons = F.filter(F.array(F.col("pron"), F.try_element_at("variants", F.lit(1))), lambda p: p.isNotNull() & (p != "") & ~p.contains(" "))
    return rows.select("word", F.explode(prons).alias("pron"))


def usable_candidates(lines: DataFrame, batch: DataFrame) -> DataFrame:
    """(seq, word, pron) of answer lines (seq, line): two fields at tabs, else at white space, word and phones
    normalised; kept if the word was asked for and the phones are canonical. Of a word's answers the last counts."""
    strip = lambda c: F.regexp_replace(c, "^[\\s`]+|[\\s`]+$", "")
    by_tab = F.split(F.replace("line", F.lit("<TAB>"), F.lit("\t")), "\t")
    fields = F.when(F.size(by_tab) >= 2, by_tab).otherwise(F.filter(F.split(F.col("line"), r"\s+"), lambda x: x != ""))
    rows = lines.withColumn("f", fields).filter(F.size("f") >= 2)
    rows = rows.select("seq", text.normalize_chars(strip(F.element_at("f", 1))).alias("word"), phones.canonical(strip(F.element_at("f", 2))).alias("pron"))
    rows = rows.filter((F.col("pron") != "") & phones.is_canonical(F.col("pron"))).join(batch.select("word").distinct(), "word", "left_semi")
    return rows.groupBy("word").agg(F.max_by("pron", "seq").alias("pron"), F.max("seq").alias("seq")).select("seq", "word", "pron")


def best_take(df: DataFrame, group: str, take: str, score: str) -> DataFrame:
    """(group, take, score): the take with the highest score, the first on ties; takes without a score come last."""
    rank = F.struct(F.coalesce(F.col(score), F.lit(float("-inf"))), -F.col(take))
    return df.groupBy(group).agg(F.max_by(take, rank).alias(take), F.max(score).alias(score))


def split_ids(df: DataFrame, key: str, part: str) -> DataFrame:
    """``df`` with the key of rows cut into several parts followed by ``_p`` and the part's number."""
    several = F.count(F.lit(1)).over(Window.partitionBy(key)) > 1  # parts of one clip: few
    return df.withColumn("__several", several).withColumn(key, F.when(F.col("__several"), F.concat(F.col(key), F.lit("_p"), F.col(part).cast("string"))).otherwise(F.col(key))).drop("__several")


def over_collected(df: DataFrame, column: str, seq: str, n: int, seed: int = 3) -> DataFrame:
    """``n`` distinct texts of ``df``, of its first 3 n rows in order of ``seq``, in a pseudo-random order; a top-n each."""
    first = df.select(seq, column).orderBy(seq).limit(3 * n)
    once = first.groupBy(column).agg(F.min(seq).alias(seq))
    return once.withColumn("__h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(seq).cast("string")))).orderBy("__h", seq).limit(n).drop("__h")
