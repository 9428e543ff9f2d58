"""Queries of the text, token, phone and lexicon layers over the driver tables, with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import chunks, numbers, phones, text, tokens
from ..operators import g2p, lexicon
from ..streaming import budget
from .corpus import table, words_of
from .formats import folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _lit(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, float):
        return f"CAST({x!r} AS DOUBLE)"
    return str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"


def values(rows: list[tuple], names: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_lit, r)) + ')' for r in rows)}) AS t({names})"


TOKENS = r"SELECT conv_id * 1000 + turn AS id, unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z''’\-]*|\d+(?:[.:,]\d+)*|[^\s]')) AS token FROM conversations"


@query(f"SELECT id, count(*) AS n, count(*) FILTER (regexp_matches(token, '[A-Za-z]')) AS n_en, count(*) FILTER (regexp_matches(token, '^[0-9]')) AS n_num FROM ({TOKENS}) GROUP BY id")
def token_tags(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    t = tokens.tag(c, "id", "text")
    return t.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tag").startswith("en")).alias("n_en"), F.count_if(F.col("tag").startswith("num")).alias("n_num"))


@query(f"""SELECT id, CASE WHEN count(*) FILTER (regexp_matches(token, '[A-Za-z]') OR regexp_matches(token, '^[0-9]')) > 0
AND (count(*) FILTER (regexp_matches(token, '[A-Za-z]')) + CASE WHEN count(*) FILTER (regexp_matches(token, '[A-Za-z]')) > 0 THEN count(*) FILTER (regexp_matches(token, '^[0-9]')) ELSE 0 END)
 / CAST(count(*) FILTER (regexp_matches(token, '[A-Za-z0-9]')) + count(*) FILTER (NOT regexp_matches(token, '[A-Za-z0-9]')) * 0 AS DOUBLE) >= 0.8 THEN 'native' ELSE 'pakistani' END AS accent FROM ({TOKENS}) GROUP BY id""")
def sentence_accent(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    return tokens.accent(tokens.tag(c, "id", "text"), "id")


@query("SELECT doc_id, regexp_matches(text, '[A-Za-z]') AS latin, regexp_matches(text, '[؀-ۿݐ-ݿ]') AS arabic FROM documents")
def arabic_latin_flags(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.has_latin(F.col("text")).alias("latin"), text.has_arabic_script(F.col("text")).alias("arabic"))


VOCAB_SQL = "[" + ", ".join(_lit(k) for k in phones.VOCABULARY) + "]"


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split(text, ''), lambda c: NOT list_contains({VOCAB_SQL}, c)))), '') AS oov FROM documents")
def oov_chars(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(phones.unknown_symbols(F.col("text"))), "").alias("oov"))


VOCAB_MAP = "MAP {" + ", ".join(f"{_lit(k)}: {v}" for k, v in phones.VOCABULARY.items()) + "}"


@query(f"SELECT word, array_to_string(list_transform(list_filter(string_split(word, ''), lambda c: list_contains({VOCAB_SQL}, c)), lambda c: ({VOCAB_MAP})[c]), ',') AS ids FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)")
def vocab_tokenize(spark, sf_dir):
    return words_of(spark, sf_dir).select("word").distinct().select("word", F.array_join(phones.ids(F.col("word")).cast("array<string>"), ",").alias("ids"))


#: Scales up to 99 crore, enough for the keys of any table of parts.
PART_SCALES = [(scale, 100, name) for scale, name in numbers.SCALES if scale <= 10**7]
ONES = values([(i, w) for i, w in enumerate(numbers.BELOW_100)], "i, w")


@query(f"""WITH u AS ({ONES}), k AS (SELECT DISTINCT CAST(l_partkey AS BIGINT) AS n FROM lineitem)
SELECT n, trim(concat_ws(' ', {", ".join(f"CASE WHEN n // {scale} % {most} > 0 THEN (SELECT w FROM u WHERE i = n // {scale} % {most}) || ' {name}' END" for scale, most, name in PART_SCALES)}, CASE WHEN n % 1000 >= 100 THEN (SELECT w FROM u WHERE i = n % 1000 // 100) || ' سو' END, CASE WHEN n % 100 > 0 OR n = 0 THEN (SELECT w FROM u WHERE i = n % 100) END)) AS words FROM k""")
def cardinal_words(spark, sf_dir):
    k = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("n")).distinct()
    return k.select("n", numbers.cardinal(F.col("n")).alias("words"))


@query("SELECT doc_id, length(regexp_replace(regexp_replace(text, '[^0-9]', '', 'g'), '', '', 'g')) AS digits FROM documents")
def digits_to_ascii(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.char_length(F.regexp_replace(numbers.ascii_digits(F.col("text")), "[^0-9]", "")).alias("digits"))


RECORDS = "SELECT doc_id * 2147483648 + p AS seq, word, pron, source FROM (SELECT doc_id, p, w AS word, w || CAST(doc_id % 3 AS VARCHAR) AS pron, CASE lang WHEN 'en' THEN 'llm' WHEN 'fr' THEN 'wikipron' WHEN 'de' THEN 'agree' ELSE 'rules' END AS source FROM (SELECT doc_id, lang, unnest(x) AS w, generate_subscripts(x, 1) AS p FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '[a-z]+') AS x FROM documents)))"


def _records(spark, sf_dir, once: bool = False):
    """Lexicon records made of all words of each document, as stand-in for source files.

    ``once``: a word's first place in each document only. A document has one source, and one pronunciation of a word,
    so that the merged lexicon is the same.
    """
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.posexplode(F.array_distinct(words) if once else words).alias("p", "word"))
    source = F.when(F.col("lang") == "en", "llm").when(F.col("lang") == "fr", "wikipron").when(F.col("lang") == "de", "agree").otherwise("rules")
    return d.select((F.shiftleft("doc_id", 31) + F.col("p")).alias("seq"), "word", F.concat("word", (F.col("doc_id") % 3).cast("string")).alias("pron"), source.alias("source"))


@query(f"""WITH r AS (SELECT word, pron, source, min(seq) AS seq FROM ({RECORDS}) GROUP BY word, pron, source, seq // 2147483648), k AS (SELECT *, CASE source WHEN 'wikipron' THEN 1 WHEN 'agree' THEN 2 WHEN 'llm' THEN 3 ELSE 5 END AS rk FROM r),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY rk, seq) AS n FROM k) WHERE n = 1),
v AS (SELECT k.word, k.pron, min(k.seq) AS seq FROM k JOIN w ON k.word = w.word AND k.seq > w.seq AND k.pron <> w.pron GROUP BY ALL),
a AS (SELECT word, string_agg(pron, ';' ORDER BY seq) AS variants FROM v GROUP BY word)
SELECT w.word, w.pron, w.source, coalesce(variants, '') AS variants FROM w LEFT JOIN a USING (word)""")
def lexicon_rank_merge(spark, sf_dir):
    return lexicon.merge(_records(spark, sf_dir, once=True)).select("word", "pron", "source", F.array_join("variants", ";").alias("variants"))


#: Words that the pronunciation model is fitted on, on average at most: a share of all, by hash.
FITTED = 4000


@query("""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)
SELECT word, replace(replace(replace(word, 'x', 'ks'), 'q', 'k'), 'h', '') AS pron FROM w""")
def nbest_decoded(spark, sf_dir):
    """Every word of the documents decoded by a model learned from a lexicon of some of them, in which x is two
    phones, q another one and h silent."""
    at = folder(spark)  # texts are read once, not in every round of the fit

    def kept(rows, name):
        rows.write.parquet(f"{at}/{name}")
        return spark.read.schema("word string").parquet(f"{at}/{name}")

    words = kept(words_of(spark, sf_dir).select("word").distinct(), "words")
    share = int(min(1.0, FITTED / max(1, words.count())) * (1 << 30))
    known = kept(words.filter(F.pmod(F.xxhash64("word", F.lit("fit")), F.lit(1 << 30)) < share).repartition(spark.sparkContext.defaultParallelism), "known")
    said = F.replace(F.replace(F.replace("word", F.lit("x"), F.lit("ks")), F.lit("q"), F.lit("k")), F.lit("h"), F.lit(""))
    model = g2p.fit(known, g2p.letters_of(F.col("word")), g2p.letters_of(said))
    found = g2p.nbest(words, model)
    return found.select("word", F.col("cands")[0]["pron"].alias("pron"))


@query(f"""WITH r AS ({RECORDS}), known AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark)
SELECT word, count(*) AS n FROM r WHERE word NOT IN (SELECT word FROM known) AND word NOT IN (SELECT word FROM r WHERE source = 'wikipron') GROUP BY word""")
def oov_new_words(spark, sf_dir):
    r = _records(spark, sf_dir)
    known = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    fresh = lexicon.new_words(r.select("word", "seq"), "seq", [known], r.filter("source = 'wikipron'").select("seq", "word", "pron"))
    return fresh.join(r, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(r"""WITH RECURSIVE s AS (SELECT conv_id * 1000 + turn AS id, list_filter(list_transform(string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS p FROM conversations),
m AS (SELECT id, p, 1 AS k, CAST([] AS VARCHAR[]) AS acc FROM s UNION ALL
SELECT id, p, k + 1, CASE WHEN len(acc) > 0 AND (length(acc[-1]) < 60 OR length(p[k]) < 60) AND length(acc[-1]) + length(p[k]) + 1 <= 200 THEN list_append(acc[:-2], acc[-1] || ' ' || p[k]) ELSE list_append(acc, p[k]) END FROM m WHERE k <= len(p))
SELECT id, array_to_string(acc, chr(10)) AS chunks FROM m WHERE k = len(p) + 1""")
def short_sentence_merge(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    s = F.filter(F.transform(F.split("text", r"(?<=[.?!])\s+|\n+"), lambda x: F.trim(x)), lambda x: x != "")
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.array_join(chunks.merge_short(s, 60, 200), "\n").alias("chunks"))


@query(r"""WITH RECURSIVE s AS (SELECT conv_id, turn, replace(text, chr(10), ' ') AS t FROM conversations),
p AS (SELECT conv_id, turn, list_filter(string_split(regexp_replace(t, '([,.!?;:…]) ', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '') AS p, t FROM s WHERE length(t) > 200),
m AS (SELECT conv_id, turn, p, 1 AS k, CAST([] AS VARCHAR[]) AS acc FROM p UNION ALL
SELECT conv_id, turn, p, k + 1, CASE WHEN len(acc) > 0 AND length(acc[-1]) + length(p[k]) + 1 <= 200 THEN list_append(acc[:-2], acc[-1] || ' ' || p[k])
 ELSE list_concat(acc, list_transform(range(0, CAST(ceil(length(p[k]) / 200.0) AS BIGINT)), lambda i: substr(p[k], i * 200 + 1, 200))) END FROM m WHERE k <= len(p)),
a AS (SELECT conv_id, turn, acc FROM m WHERE k = len(p) + 1 UNION ALL SELECT conv_id, turn, [t] FROM s WHERE length(t) <= 200)
SELECT conv_id, turn, CAST(generate_subscripts(acc, 1) - 1 AS INTEGER) AS k, unnest(acc) AS chunk FROM a""")
def greedy_chunks(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.posexplode(chunks.fill_lines(F.regexp_replace("text", "\n", " "), 200)).alias("k", "chunk"))


U = f"WITH u AS ({ONES}) "


def _u(n: str) -> str:
    return f"(SELECT w FROM u WHERE i = {n})"


@query(U + f"""SELECT DISTINCT y, CASE WHEN y < 2000 THEN {_u("y // 100")} || ' {numbers.HUNDRED}' || CASE WHEN y % 100 > 0 THEN ' ' || {_u("y % 100")} ELSE '' END
ELSE {_u("y // 1000")} || ' {numbers.SCALES[-1][1]}' || CASE WHEN y % 1000 > 0 THEN ' ' || {_u("y % 1000")} ELSE '' END END AS words FROM (SELECT year(o_orderdate) AS y FROM orders)""")
def year_words(spark, sf_dir):
    y = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("y")).distinct()
    return y.select("y", numbers.year(F.col("y")).alias("words"))


@query(U + f"""SELECT DISTINCT h, m, CASE m WHEN 0 THEN {_u('h12')} || ' {numbers.OCLOCK}' WHEN 15 THEN '{numbers.QUARTER_PAST} ' || {_u('h12')} WHEN 45 THEN '{numbers.QUARTER_TO} ' || {_u('h12 % 12 + 1')}
WHEN 30 THEN CASE h12 WHEN 1 THEN '{numbers.HALF_PAST_1}' WHEN 2 THEN '{numbers.HALF_PAST_2}' ELSE '{numbers.HALF_PAST} ' || {_u('h12')} END
ELSE {_u('h12')} || ' {numbers.PAST} ' || {_u('m')} || ' {numbers.MINUTES}' END AS words
FROM (SELECT hour(ts) AS h, minute(ts) AS m, CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END AS h12 FROM events)""")
def time_words(spark, sf_dir):
    t = table(spark, sf_dir, "events").select(F.hour("ts").alias("h"), F.minute("ts").alias("m")).distinct()
    return t.select("h", "m", numbers.clock(F.col("h"), F.col("m")).alias("words"))


@query(U + f"""SELECT DISTINCT q AS value, {_u("0")} || ' {numbers.POINT} ' || {_u("CAST(substr(q, 3, 1) AS INTEGER)")} || CASE WHEN length(q) > 3 THEN ' ' || {_u("CAST(substr(q, 4, 1) AS INTEGER)")} ELSE '' END AS words
FROM (SELECT printf('%.2f', l_discount) AS q FROM lineitem)""")
def decimal_words(spark, sf_dir):
    q = table(spark, sf_dir, "lineitem").select(F.format_string("%.2f", F.col("l_discount")).alias("value")).distinct()
    return q.select("value", numbers.decimal(F.col("value")).alias("words"))


@query(U + f"""SELECT DISTINCT l_linenumber AS n, CASE l_linenumber {" ".join(f"WHEN {k} THEN '{v}'" for k, v in numbers.ORDINALS.items())} ELSE {_u("l_linenumber")} || '{numbers.ORDINAL_SUFFIX}' END AS words FROM lineitem""")
def ordinal_words(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("n")).distinct()
    return n.select("n", numbers.ordinal(F.col("n")).alias("words"))


@query("""WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS token FROM documents)
SELECT token, CASE WHEN list_contains(string_split('""" + " ".join(tokens.SPELLED) + """', ' '), token) THEN 'en_acronym' WHEN list_contains(string_split('""" + " ".join(tokens.SPOKEN) + """', ' '), token) THEN 'en_acronym_word'
WHEN regexp_matches(token, '^[A-Z]{2,6}$') AND length(token) >= 4 AND regexp_matches(token[2:-2], '[AEIOU]') AND token NOT LIKE '%S' THEN 'en_acronym_word' WHEN regexp_matches(token, '^[A-Z]{2,6}$') THEN 'en_acronym' ELSE 'en' END AS class FROM t""")
def latin_class(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("token")).distinct()
    return t.select("token", tokens.classify_latin(F.col("token")).alias("class"))


@query("""WITH b AS (SELECT user_id, event_id, value, coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY event_id, value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM events)
SELECT user_id, event_id, value, round(spent, 4) AS spent FROM b WHERE spent < 500""")
def streaming_budget(spark, sf_dir):
    """events as a stream into a budget per user; everything available is taken once, then read back."""
    at = f"{budget.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(at)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    e = table(spark, sf_dir, "events")
    source = spark.readStream.schema(e.schema).parquet(f"{sf_dir}/event[s].parquet")  # a pattern, for a stream of files
    budget.run_available(budget.admit_stream(source.select("user_id", "event_id", "value"), "user_id", "event_id", "value", 500.0), f"{at}/out", f"{at}/state")
    return spark.read.parquet(f"{at}/out").withColumn("spent", F.round("spent", 4))
