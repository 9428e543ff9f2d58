"""Queries of single words, symbols and clips over the driver tables, with SQL that says the same in its own way."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import edit, numbers, phones, text, tokens
from ..operators import admission, frontend, lexicon, reports, signal
from .corpus import table, words_of
from .formats import folder
from .language import VOCAB_MAP, VOCAB_SQL, _lit

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


WORDS = "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents"


def _words(spark, sf_dir):
    return words_of(spark, sf_dir).select("word").distinct()


@query("SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ' rupees' AS plain FROM orders")
def thousands_stripped(spark, sf_dir):
    """Sums written with separators, which go."""
    o = table(spark, sf_dir, "orders")
    said = F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit(" rupees"))
    return o.select("o_orderkey", numbers.strip_thousands(said).alias("plain"))


@query("SELECT conv_id, turn, replace(replace(replace(replace(text, '–', ','), '-', ' '), '''', ''), '\"', '') AS said FROM conversations")
def punctuation_of_turns(spark, sf_dir):
    """Turns written with Urdu marks come back with plain ones, without quotes."""
    c = table(spark, sf_dir, "conversations")
    urdu = F.translate("text", ".?,;", "۔؟،؛")
    return c.select("conv_id", "turn", text.normalize_punctuation(urdu).alias("said"))


@query(f"SELECT word, replace(replace(replace(word, 'k', 'ک'), 'y', 'ی'), 'h', 'ہ') AS said FROM ({WORDS})")
def letters_unified(spark, sf_dir):
    """Words written with letters of another script's habit, with joiners at their edges and spaces around."""
    w = _words(spark, sf_dir)
    odd = F.concat(F.lit("‌ "), F.translate("word", "kyh", "كيه"), F.lit("‌\t "))
    return w.select("word", text.normalize_chars(odd).alias("said"))


@query(f"SELECT word, regexp_replace(replace(replace(word, 'b', 'ب'), 'k', 'ک'), '[a-z]', '', 'g') AS letters FROM ({WORDS})")
def letters_alone(spark, sf_dir):
    """What is left of a word besides letters that count."""
    return _words(spark, sf_dir).select("word", text.letters_only(F.translate("word", "bk", "بک")).alias("letters"))


LETTER_MAP = "MAP {" + ", ".join(f"{_lit(k)}: {_lit(v)}" for k, v in tokens.LETTER_NAMES.items()) + "}"


@query(f"SELECT word, array_to_string(list_transform(string_split(upper(word), ''), lambda c: ({LETTER_MAP})[c]), ' ') AS said FROM ({WORDS})")
def words_spelled(spark, sf_dir):
    return _words(spark, sf_dir).select("word", tokens.spell(F.col("word")).alias("said"))


@query(f"""SELECT conv_id, turn, '0,' || array_to_string(list_transform(list_filter(string_split(text, ''), lambda c: list_contains({VOCAB_SQL}, c))[1:510], lambda c: ({VOCAB_MAP})[c]), ',')
|| CASE WHEN len(list_filter(string_split(text, ''), lambda c: list_contains({VOCAB_SQL}, c))) > 0 THEN ',0' ELSE '0' END AS ids FROM conversations WHERE text IS NOT NULL""")
def turn_ids(spark, sf_dir):
    """Ids of whole turns between two zeros, at most 510 of them."""
    c = table(spark, sf_dir, "conversations").filter("text IS NOT NULL")
    return c.select("conv_id", "turn", F.array_join(phones.framed_ids(F.col("text")).cast("array<string>"), ",").alias("ids"))


@query("""WITH p AS (SELECT DISTINCT coalesce(source, '') AS a, coalesce(lang, '') AS b FROM documents)
SELECT a, b, CAST(levenshtein(a, b) AS BIGINT) AS cost, CAST(length(a) AS BIGINT) AS taken, CAST(length(b) AS BIGINT) AS made FROM p""")
def alignment_costs(spark, sf_dir):
    """Alignments of the letters of sources and languages: their cost is the distance, and they use up both sides."""
    d = table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("a"), F.coalesce("lang", F.lit("")).alias("b")).distinct()
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    ops = d.select("a", "b", edit.alignment(letters("a"), letters("b")).alias("ops"))
    n = lambda *kinds: F.size(F.filter("ops", lambda x: x["op"].isin(*kinds))).cast("long")
    return ops.select("a", "b", n("S", "D", "I").alias("cost"), n("M", "S", "D").alias("taken"), n("M", "S", "I").alias("made"))


@query(f"""WITH w AS (SELECT word, substr(word, 1, 1) || chr(1614) || substr(word, 2) AS marked FROM ({WORDS}))
SELECT marked AS word, CASE WHEN length(word) % 3 > 0 THEN word END AS entry, CASE WHEN length(word) % 3 > 0 THEN word || '1' END AS pron FROM w""")
def lookup_of_marked_words(spark, sf_dir):
    """Words with a mark that the entries don't have are found by their bare form; some have no entry."""
    w = _words(spark, sf_dir)
    marked = F.concat(F.substring("word", 1, 1), F.lit("َ"), F.expr("substring(word, 2)"))
    entries = w.filter(F.char_length("word") % 3 > 0).select(F.xxhash64("word").alias("seq"), "word", F.concat("word", F.lit("1")).alias("pron"))
    return lexicon.lookup(w.select(marked.alias("word")), entries)


@query(f"""WITH w AS ({WORDS}), k AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark), r AS (SELECT word FROM w WHERE word NOT IN (SELECT word FROM k))
SELECT word, word || 'a' AS pron FROM r WHERE length(word) % 4 > 0 UNION ALL SELECT word, word || 'b' FROM r WHERE length(word) % 2 = 0""")
def pairs_to_learn(spark, sf_dir):
    """Pronunciations and first variants of words that are not held out; some have a space and go, some have no variant."""
    w = _words(spark, sf_dir)
    n = F.char_length("word")
    pron = F.when(n % 4 > 0, F.concat("word", F.lit("a"))).otherwise(F.concat("word", F.lit(" a")))
    variants = F.when(n % 2 == 0, F.array(F.concat("word", F.lit("b")), F.concat("word", F.lit("c")))).otherwise(F.array().cast("array<string>"))
    tested = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return frontend.training_pairs(w.select("word", pron.alias("pron"), variants.alias("variants")), tested)


# --- clips ---


def _signal(loud: int, quiet: int):
    """Stretches of full scale made of a vector's signs, with a pause between them, in one array."""
    tone = F.flatten(F.array_repeat(F.transform("embedding", lambda x: F.when(x < 0, -0.5).otherwise(0.5)), loud))
    return F.concat(tone, F.array_repeat(F.lit(0.0), quiet), tone)


@query("SELECT vec_id, label FROM embeddings WHERE embedding IS NOT NULL")
def full_band_references(spark, sf_dir):
    """References of speakers whose audit finds the full band: none is refused; one that is would make the job fail."""
    e = table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL").select("vec_id", "label")
    audit = signal.audit(e.select("label", "vec_id", F.lit(9000.0).alias("rolloff"), F.lit(0.1).alias("high")), "label", "vec_id", "rolloff", "high")
    return signal.assert_full_band(e, audit, "label")


@query("""SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'decode_error' WHEN vec_id % 5 = 1 THEN 'silent' WHEN vec_id % 5 = 2 THEN 'too_short' ELSE 'kept' END AS reason, 0 AS part,
vec_id % 5 > 2 AS has_samples FROM embeddings WHERE embedding IS NOT NULL""")
def clips_prepared(spark, sf_dir):
    """Clips without a rate, silent, short and fitting ones made ready: resampled, levelled, trimmed."""
    k = F.col("vec_id") % 5
    e = table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL")
    long, short, none = _signal(130, 400), _signal(20, 0), F.array_repeat(F.lit(0.0), 9000)
    clips = e.select("vec_id", F.when(k == 1, none).when(k == 2, short).otherwise(long).alias("y"), F.when(k > 0, 8000).alias("rate"), F.lit("One.").alias("said"))
    out = signal.prepare_clips(clips, "vec_id", "y", "rate", "said", target=8000)
    return out.select("vec_id", "reason", "part", F.col("samples").isNotNull().alias("has_samples"))


@query("SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN 0.0 ELSE (vec_id % 3) * 0.2 END::DOUBLE AS pause FROM embeddings WHERE embedding IS NOT NULL")
def longest_pauses(spark, sf_dir):
    """The longest run of quiet frames within clips whose pause is known."""
    k = F.col("vec_id") % 3
    e = table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL")
    clip = F.when(k == 0, _signal(40, 0)).when(k == 1, _signal(40, 1600)).otherwise(_signal(40, 3200))
    return e.select("vec_id", F.round(signal.longest_pause(8000)(clip), 6).alias("pause"))


# --- lines and reports ---


@query(r"""WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN regexp_replace(lower(text), '[a-z]', chr(1576), 'g') ELSE text END AS t FROM conversations)
SELECT conv_id, turn, coalesce(length(t) BETWEEN 20 AND 200 AND NOT regexp_matches(t, '[A-Za-z]') AND len(regexp_extract_all(t, '[\[\](){}<>|/=\\*_#]')) = 0 AND right(t, 1) IN ('.', '?', '!'), false) AS plain FROM t""")
def sentences_of_one_script(spark, sf_dir):
    """Turns, every second one written in another script, as sentences of that script."""
    other = F.regexp_replace(F.lower("text"), "[a-z]", "ب")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, other).otherwise(F.col("text")).alias("t"))
    return c.select("conv_id", "turn", admission.plain_sentence(F.col("t"), ends=".?!").alias("plain"))


@query("SELECT event_id, event_type, CASE WHEN value > 250 THEN value END AS score FROM events")
def streamed_rows(spark, sf_dir):
    """Rows that a stream writes as JSON lines, some without a score, read back."""
    at, e = folder(spark), table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    source = spark.readStream.schema(e.schema).parquet(f"{sf_dir}/event[s].parquet")  # a pattern, for a stream of files
    rows = source.select("event_id", "event_type", F.when(F.col("value") > 250, F.col("value")).alias("score"))
    rows.writeStream.format("json").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id long, event_type string, score double").json(f"{at}/rows")


@query("""WITH m AS (SELECT event_type AS name, avg(value) AS v FROM events GROUP BY 1), s(k, title, name) AS (VALUES (1, 'Clicks', 'click'), (2, 'Views', 'view'), (3, 'Nothing', 'nothing'))
SELECT '| measure | mean |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || title || ' | ' || coalesce(printf('%.3f', v), 'n/a') || ' |', chr(10) ORDER BY k) AS markdown FROM s LEFT JOIN m USING (name)""")
def metrics_card(spark, sf_dir):
    """Means by kind of event as a Markdown table; one kind has no events."""
    m = table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg("value").alias("v"))
    return reports.card(m, "event_type", "v", {"click": "Clicks", "view": "Views", "nothing": "Nothing"}, ("measure", "mean"))
