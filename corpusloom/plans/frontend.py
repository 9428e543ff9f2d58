"""Queries of the way from sentences to phones and of the last gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import frontend, gates, signal
from .corpus import table
from .language import VOCAB_SQL

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


_TOKEN = r"[a-z][a-z''’\-]*|\d+(?:[.:,]\d+)*|[^\s]"
_KEPT = f"array_to_string(list_filter(string_split(t, ''), lambda c: list_contains({VOCAB_SQL}, c)), '')"
_MARKS = "[" + ", ".join("'" + c + "'" for c in frontend.MARKS) + "]"


@query(rf"""WITH t AS (SELECT conv_id * 1000 + turn AS id, regexp_extract_all(lower(coalesce(text, '')), '{_TOKEN}') AS t FROM conversations),
p AS (SELECT id, list_filter(list_transform(t, lambda t: CASE WHEN regexp_matches(t, '[a-z0-9]') THEN {_KEPT} WHEN t IN ('''', '"', '-', '–') THEN '' WHEN list_contains({_MARKS}, t) THEN t ELSE '' END), lambda x: x <> '') AS p FROM t)
SELECT id, regexp_replace(trim(regexp_replace(array_to_string(p, ' '), '\s+', ' ', 'g')), '\s+([,.!?;:…])', '\1', 'g') AS phonemes FROM p""")
def sentence_phones(spark, sf_dir):
    """All turns with their own words as pronunciations, in the native accent: what is assembled is what was said."""
    c = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    words = c.select(F.explode(F.regexp_extract_all("text", F.lit(r"([a-z][a-z'’\-]*|\d+(?:[.:,]\d+)*)"), F.lit(0))).alias("word")).distinct()
    entries = spark.createDataFrame([], "seq int, word string, pron string")
    out = frontend.phonemize(c, "id", "text", entries, words.select("word", F.col("word").alias("pron")), accent="native", normalized=True)
    return out.select("id", "phonemes")


_REASON = f"CASE WHEN len(list_filter(string_split(text, ''), lambda c: NOT list_contains({VOCAB_SQL}, c))) > 0 THEN 'oov' WHEN length(text) < 3 THEN 'empty' WHEN length(text) > 510 THEN 'too_long' ELSE 'kept' END"


@query(f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN text IS NULL THEN 'exception' ELSE {_REASON} END AS reason FROM (SELECT regexp_replace(text, '[^a-z ]', '', 'g') || CASE WHEN turn = 0 THEN '#' ELSE '' END AS text FROM conversations)) GROUP BY reason")
def phone_reasons(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    said = F.concat(F.regexp_replace("text", "[^a-z ]", ""), F.when(F.col("turn") == 0, "#").otherwise(""))
    return c.select(frontend.phone_reason(said).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH l AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN trim(array_to_string(list_filter(string_split(text, ''), lambda c: list_contains({VOCAB_SQL}, c)), '')) ELSE text END AS line FROM conversations)
SELECT conv_id, turn, line FROM l WHERE length(line) BETWEEN 20 AND 500 AND len(list_filter(string_split(line, ''), lambda c: NOT list_contains({VOCAB_SQL}, c))) = 0""")
def ood_lines(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", frontend.ood_line(F.col("text"), F.col("turn") % 2 == 0).alias("line")).filter("line IS NOT NULL")


@query("""WITH m AS (SELECT user_id, avg(value) FILTER (event_type = 'click') / 1000 AS ood, avg(value) / 1000 AS app, min(value) / 100 AS pcer, avg(value) FILTER (event_type = 'view') / 2000 AS pcer_en, count(*) FILTER (value > 495) AS lost,
 max(value) / 1000 AS wer, avg(value) FILTER (event_type = 'purchase') / 80 AS utmos, avg(value) / 90 AS dnsmos, min(value) / 4000 AS clip, max(value) / 330 AS silence, median(value) / 60 AS comb FROM events GROUP BY user_id),
b AS (SELECT *, CASE WHEN user_id % 3 > 0 THEN 0.33 END AS base, CASE WHEN user_id % 4 > 0 THEN 0.45 END AS base_wer, CASE WHEN user_id % 5 > 0 THEN 3.1 END AS real_mos, CASE WHEN user_id % 2 > 0 THEN 1.2 END AS real_comb FROM m)
SELECT user_id, ood <= 0.20 + 0.03 AS g_ood_cer, CASE WHEN base IS NOT NULL THEN app < base - 0.05 END AS g_beats_baseline, app <= 0.20 + 0.06 AS g_appendix_cer, pcer <= 0.10 AS g_mixed_pcer, pcer_en <= 0.15 AS g_mixed_pcer_en,
 lost = 0 AS g_no_english_word_lost, CASE WHEN base_wer IS NOT NULL THEN wer <= base_wer + 0.05 END AS g_english_wer, coalesce(utmos, dnsmos) >= 3.5 OR coalesce(coalesce(utmos, dnsmos) >= real_mos - 0.3, false) AS g_naturalness,
 clip < 0.001 AS g_no_clipping, silence <= 1.5 AS g_no_long_silence, comb <= real_comb + 3.0 AS g_no_comb FROM b""")
def evaluation_gates(spark, sf_dir):
    """All eleven gates, on measures made of each user's events."""
    v, of = F.col("value"), lambda kind: F.avg(F.when(F.col("event_type") == kind, F.col("value")))
    m = table(spark, sf_dir, "events").groupBy("user_id").agg(
        (of("click") / 1000).alias("ood_cer"), (F.avg(v) / 1000).alias("appendix_cer"), (F.min(v) / 100).alias("mixed_pcer"), (of("view") / 2000).alias("mixed_pcer_en"), F.count_if(v > 495).alias("words_lost"),
        (F.max(v) / 1000).alias("english_wer"), (of("purchase") / 80).alias("utmos"), (F.avg(v) / 90).alias("dnsmos"), (F.min(v) / 4000).alias("clipping_max"), (F.max(v) / 330).alias("max_silence"), (F.median(v) / 60).alias("comb_median"),
    )
    some = lambda k, x: F.when(F.col("user_id") % k > 0, F.lit(x))
    m = m.withColumns({"floor": F.lit(0.20), "base_cer": some(3, 0.33), "base_wer": some(4, 0.45), "real_mos": some(5, 3.1), "real_comb": some(2, 1.2)})
    return gates.evaluation(m, "user_id")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5('0|' || event_id), event_id) AS r FROM events),
m AS (SELECT user_id, count(*) AS n_sampled, avg(value * 32) AS m, avg(value / 500) AS h FROM r WHERE r <= 30 GROUP BY user_id)
SELECT user_id, n_sampled, n_clips, round(m, 1) AS rolloff_hz, round(100 * h, 3) AS high_percent, m < 8000 AS band_limited FROM m JOIN (SELECT user_id, count(*) AS n_clips FROM events GROUP BY user_id) USING (user_id)""")
def speaker_audit(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("value") * 32).alias("rolloff"), (F.col("value") / 500).alias("high"))
    return signal.audit(e, "user_id", "event_id", "rolloff", "high")


@query("SELECT user_id, arg_max(event_id, value * 1e6 - event_id * 1e-6) AS event_id, max(value) AS value FROM events GROUP BY user_id")
def best_take(spark, sf_dir):
    return frontend.best_take(table(spark, sf_dir, "events"), "user_id", "event_id", "value")


@query("""WITH f AS (SELECT doc_id, lang || '|' || source AS t FROM documents ORDER BY doc_id LIMIT 120), o AS (SELECT t, min(doc_id) AS doc_id FROM f GROUP BY t)
SELECT t, doc_id FROM o ORDER BY md5('3|' || doc_id), doc_id LIMIT 40""")
def over_collected(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("|", "lang", "source").alias("t"))
    return frontend.over_collected(d, "t", "doc_id", 40)


@query("SELECT CASE WHEN count(*) OVER (PARTITION BY conv_id) > 1 THEN conv_id || '_p' || turn ELSE CAST(conv_id AS VARCHAR) END AS utt, turn FROM conversations")
def split_part_ids(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("utt"), "turn")
    return frontend.split_ids(c, "utt", "turn")
