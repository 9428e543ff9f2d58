"""Queries of what is let in and refused, and of the smaller reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import phones, registry
from ..operators import admission, reports, signal, splits
from ..sources import files
from .corpus import table, words_of
from .formats import folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


# --- clips and lines ---

CLIPS = "SELECT conv_id, turn, turn % 3 = 0 AS odd, length(text) / 40.0 AS s, CASE WHEN turn % 3 = 0 THEN text || 'ہے' ELSE text END AS said FROM conversations"


@query(f"""SELECT conv_id, turn, coalesce(s BETWEEN 2.0 AND 15.0 AND trim(said) <> '' AND NOT odd, false) AS is_read, coalesce(s BETWEEN 1.5 AND 20.0 AND trim(said) <> '', false) AS is_spoken,
coalesce(s >= 0.5, false) AS is_long, coalesce(floor(s * 10) >= 80, false) AS has_frames FROM ({CLIPS})""")
def clip_tests(spark, sf_dir):
    """Turns as clips, a second for 40 characters; every third one has Arabic script in it."""
    odd = F.col("turn") % 3 == 0
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.char_length("text") / 40.0).alias("s"), F.when(odd, F.concat("text", F.lit("ہے"))).otherwise(F.col("text")).alias("said"))
    s, said = F.col("s"), F.col("said")
    return c.select("conv_id", "turn", admission.read_clip(s, said).alias("is_read"), admission.spoken_clip(s, said).alias("is_spoken"), admission.long_enough(s).alias("is_long"), admission.enough_frames(F.floor(s * 10)).alias("has_frames"))


@query("""WITH c AS (SELECT conv_id, turn, role, trim(text) AS text FROM conversations)
SELECT conv_id, turn, text FROM c WHERE length(text) BETWEEN 30 AND 160 AND text NOT IN (SELECT text FROM c WHERE role = 'user' AND text IS NOT NULL)""")
def english_ood_lines(spark, sf_dir):
    """Turns of fitting length that no user has said."""
    c = table(spark, sf_dir, "conversations")
    exclude = c.filter("role = 'user'").select(F.trim("text").alias("text"))
    return admission.english_lines(c.select("conv_id", "turn", "text"), "text", exclude)


@query("""WITH w AS (SELECT lower(source) AS word, doc_id, lang FROM documents WHERE source IS NOT NULL), c AS (SELECT word, arg_min(lang, doc_id) AS cand FROM w WHERE doc_id % 7 = 3 GROUP BY word)
SELECT w.word, w.doc_id, c.cand FROM w LEFT JOIN c USING (word)""")
def candidate_map(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("source IS NOT NULL").select(F.lower("source").alias("word"), "doc_id", "lang")
    return admission.with_candidates(d.select("word", "doc_id"), d.filter("doc_id % 7 = 3").select("word", F.col("lang").alias("cand"), F.col("doc_id").alias("seq")))


@query("""WITH a AS (SELECT * FROM documents ORDER BY doc_id LIMIT 40001), w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM a)
SELECT word, count(*) AS n FROM w WHERE length(word) >= 2 GROUP BY word""")
def article_words(spark, sf_dir):
    """Word counts of a stream of articles that ends after 40,001 of them."""
    a = admission.first_articles(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    words = a.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).filter(F.char_length("word") >= 2)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- data sets, versions, variants, steps, issues ---


@query("""WITH l AS (SELECT event_type AS name, count(*) AS n_lines FROM events WHERE event_id % 9 > 0 GROUP BY event_type)
SELECT name, n_lines, n_lines >= 500 AND name <> 'click' AS valid FROM l""")
def dataset_validity(spark, sf_dir):
    """Lists written and read back: one has no archive, some lines are blank, and on a small table all are too short."""
    at = folder(spark)
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("name"), F.when(F.col("event_id") % 9 > 0, F.concat("event_id", F.lit("|x"))).otherwise("  ").alias("value"))
    e.write.partitionBy("name").text(at)
    lists = spark.read.text(at)
    archives = e.select("name").filter("name <> 'click'")
    return admission.validity(lists, "name", "value", archives)


@query("SELECT user_id, CASE WHEN max(value) > 400 THEN array_to_string(list_sort(list(DISTINCT event_type)), ',') ELSE '' END AS steps FROM events GROUP BY user_id")
def restart_steps(spark, sf_dir):
    """Steps of each user, of which those without outputs are done again."""
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("done"), (F.max("value") > 400).alias("have"))
    return e.select("user_id", F.array_join(admission.steps_that_count(F.col("done"), F.col("have")), ",").alias("steps"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 > 1 THEN 'made with front end 0.' || doc_id % 4 || ', this one is 1.0' END AS warning FROM documents""")
def version_contract(spark, sf_dir):
    """Rows stamped by this version, by none, and by older ones."""
    d = admission.stamped(table(spark, sf_dir, "documents").select("doc_id"))
    k = F.col("doc_id") % 4
    found = F.when(k == 0, F.col("frontend_version")).when(k > 1, F.concat(F.lit("0."), k.cast("string")))
    return d.select("doc_id", admission.version_warning(found).alias("warning"))


@query("""WITH w AS (SELECT DISTINCT lang AS title, 'n' AS body FROM documents WHERE lang IS NOT NULL), i AS (SELECT source || '' AS s, lang AS title, doc_id AS number, doc_id % 2 = 0 AS is_open FROM documents WHERE n_chars > 900 AND doc_id % 3 = 0),
f AS (SELECT title, min(number) AS number FROM i WHERE is_open GROUP BY title) SELECT w.title, w.body, f.number, CASE WHEN f.number IS NULL THEN 'create' ELSE 'comment' END AS action FROM w LEFT JOIN f USING (title)""")
def issue_upsert(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    wanted = d.filter("lang IS NOT NULL").select(F.col("lang").alias("title")).distinct().withColumn("body", F.lit("n"))
    issues = d.filter("n_chars > 900 AND doc_id % 3 = 0").select(F.col("lang").alias("title"), F.col("doc_id").alias("number"), F.when(F.col("doc_id") % 2 == 0, "open").otherwise("closed").alias("state"))
    return admission.upserts(wanted, issues)


@query("""SELECT user_id, round(avg(value) / 1000, 6) AS "appendixA_cer", round(min(value) / 100, 6) AS mixed_pcer_pakistani, CAST(NULL AS DOUBLE) AS english_wer_native, round(max(value) / 90, 6) AS dnsmos, count(*) > 3 AS gates FROM events GROUP BY user_id""")
def light_metrics(spark, sf_dir):
    """Five metrics of each user's events and no others; one of them is not measured."""
    v = F.col("value")
    m = table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(F.avg(v) / 1000, 6).alias("appendixA_cer"), F.round(F.min(v) / 100, 6).alias("mixed_pcer_pakistani"), F.round(F.max(v) / 90, 6).alias("dnsmos"), (F.count(F.lit(1)) > 3).alias("gates"), F.sum(v).alias("more"))
    return admission.light(m, "user_id")


@query("SELECT user_id, round(coalesce(sum(value) FILTER (event_id % 4 > 0), 0) / 3600, 6) AS hours FROM events GROUP BY user_id")
def nested_history_hours(spark, sf_dir):
    """A JSON state per user with a history per stage; some entries have no seconds, some stages no history."""
    e = table(spark, sf_dir, "events").withColumn("h", F.struct(F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("seconds")))
    stages = e.groupBy("user_id", "event_type").agg(F.struct(F.collect_list("h").alias("history")).alias("s"))
    states = stages.groupBy("user_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("event_type", "s")))).alias("j"))
    empty = F.map_concat(F.from_json("j", "map<string,struct<history:array<struct<seconds:double>>>>"), F.from_json(F.lit('{"none": {}}'), "map<string,struct<history:array<struct<seconds:double>>>>"))
    return states.select("user_id", F.round(admission.nested_hours(empty), 6).alias("hours"))


@query("""SELECT user_id, round(least(avg(value) FILTER (event_type = 'click'), avg(value) FILTER (event_type = 'view'), avg(value) FILTER (event_type = 'purchase')), 6) AS best FROM events GROUP BY user_id""")
def best_of_metrics(spark, sf_dir):
    """The least of several metrics; those that a user lacks don't count."""
    of = lambda k: F.avg(F.when(F.col("event_type") == k, F.col("value")))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(F.least(of("click"), of("view"), of("purchase")), 6).alias("best"))


@query("SELECT conv_id, CAST(sum(len(regexp_extract_all(text, '[A-Z][a-z]+'))) AS BIGINT) AS lost FROM conversations GROUP BY conv_id")
def words_lost(spark, sf_dir):
    """The lengths of a list per row, summed by conversation."""
    lost = F.size(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0)))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sum(lost).alias("lost"))


@query("""SELECT event_type, CASE WHEN count(*) < 1000 THEN 0.0 ELSE round(count(*) * covar_pop(value, user_id) / (count(*) * stddev_pop(value) * stddev_pop(user_id) + 1e-9), 6) END AS r FROM events GROUP BY event_type""")
def waveform_correlation(spark, sf_dir):
    """Signals as rows; a pair of fewer than 1000 samples has none."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(reports.correlation(F.col("value"), F.col("user_id").cast("double")), 6).alias("r"))


@query("""WITH s AS (SELECT event_id, value FROM events ORDER BY md5('42|' || event_id), event_id LIMIT 180) SELECT event_id, value FROM s ORDER BY value DESC, event_id DESC LIMIT 60""")
def best_of_sample(spark, sf_dir):
    return admission.best_of_sample(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", "value", 60)


@query("""WITH k AS (SELECT source || '_' || lang AS key, sum(n_chars) / 3600.0 AS hours FROM documents GROUP BY ALL)
SELECT suffix, printf('%.3f', coalesce((SELECT sum(hours) FROM k WHERE ends_with(key, '_' || suffix)), 0)) AS hours FROM (VALUES ('en'), ('de'), ('xx')) AS t(suffix)""")
def card_hours(spark, sf_dir):
    """Hours by the language at the end of a key, as a card shows them."""
    k = table(spark, sf_dir, "documents").groupBy(F.concat_ws("_", "source", "lang").alias("key")).agg((F.sum("n_chars") / 3600.0).alias("hours"))
    return reports.by_suffix(k, "key", "hours", ["en", "de", "xx"]).select("suffix", reports.shown(F.col("total")).alias("hours"))


# --- files ---


@query("SELECT page_id, url, octet_length(encode(html)) AS bytes FROM pages")
def undecoded_scan(spark, sf_dir):
    """A source whose payload stays as bytes: they are measured, not decoded, and no other column is read."""
    return table(spark, sf_dir, "pages").select("page_id", "url", F.octet_length(F.encode("html", "UTF-8")).cast("long").alias("bytes"))


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('3|' || doc_id), doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents), s AS (SELECT doc_id, pos, CAST(floor(pos / ceil(n / 7.0)) AS BIGINT) AS shard FROM r)
SELECT 3 AS epoch, shard, count(*) AS n, md5(string_agg('d' || doc_id, ' ' ORDER BY pos)) AS lines FROM s GROUP BY shard""")
def shard_files(spark, sf_dir):
    """The shards of an epoch written in their order and read back."""
    at = folder(spark)
    d = splits.epoch_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", epoch=3, shards=7)
    files.write_shards(d.withColumn("line", F.concat(F.lit("d"), "doc_id")), at, "line", 3)
    rows = spark.read.text(at).select("epoch", F.col("shard").cast("long").alias("shard"), "value", files.place().alias("at"))
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), " ")
    return rows.groupBy("epoch", "shard").agg(F.count(F.lit(1)).alias("n"), F.md5(lines).alias("lines"))


@query("SELECT '- ' || event_id || ' ' || event_type || ': ' || CASE WHEN value < 250 THEN 'first' ELSE 'second' END AS line FROM events")
def progress_log(spark, sf_dir):
    at = folder(spark)
    e = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("value") < 250).alias("early"))
    for early, note in ((True, "first"), (False, "second")):
        files.append_log(e.filter(F.col("early") == early).select(F.concat(F.lit("- "), "event_id", F.lit(" "), "event_type", F.lit(f": {note}")).alias("value")), at)
    return spark.read.text(at).withColumnRenamed("value", "line")


# --- words and functions ---


@query("SELECT conv_id, turn, replace(regexp_replace(lower(text), '[^a-z ]', '', 'g'), 'g', 'ɡ') AS said FROM conversations")
def known_symbols(spark, sf_dir):
    """Turns whose symbols are all in the vocabulary pass the assertion as they are."""
    said = F.translate(F.regexp_replace(F.lower("text"), "[^a-z ]", ""), "g", "ɡ")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", phones.assert_known(said).alias("said"))


@query("SELECT conv_id, turn, text || '!' AS own, replace(text, 'e', '\u00e9') AS composed FROM conversations")
def functions_in_sql(spark, sf_dir):
    """A user's function and the library's own, called by name: one in place of a transliterator, and composed letters."""
    registry.register(spark, {"corpus_to_urdu": (_marked, "string")})
    table(spark, sf_dir, "conversations").createOrReplaceTempView("corpusloom_turns")
    return spark.sql("SELECT conv_id, turn, corpus_to_urdu(text) AS own, corpus_nfc(replace(text, 'e', 'e\u0301')) AS composed FROM corpusloom_turns")


def _marked(text: pd.Series) -> pd.Series:
    return text + "!"


@query("SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'speaker one' WHEN role = 'assistant' THEN 'speaker two' ELSE role END AS spoken FROM conversations")
def edits_all_used(spark, sf_dir):
    """Roles edited by a table made of the data; an edit without a row would make the job fail."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    edits = c.select("role").distinct().filter("role IN ('user', 'assistant')").select("role", F.when(F.col("role") == "user", "speaker one").otherwise("speaker two").alias("edited"))
    return admission.edited(c, "role", edits, "role").select("conv_id", "turn", "spoken")


@query("SELECT doc_id, lang, n_chars FROM documents")
def guarded_write(spark, sf_dir):
    """Documents written and checked in one pass: ids are there, lengths are not negative."""
    at = f"{folder(spark)}/guarded"
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    admission.write_guarded(d, at, {"no id": F.col("doc_id").isNull(), "negative length": F.col("n_chars") < 0})
    return spark.read.parquet(at)


@query("SELECT word, replace(word, 'l', '\u027d') AS said FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)")
def retroflex_repair(spark, sf_dir):
    """All words written with the two letters for r and l, and candidates that say both alike."""
    w = words_of(spark, sf_dir).select("word").distinct()
    written = F.translate("word", "rl", phones.TAPS)
    return w.select("word", phones.retroflex_repaired(written, F.translate("word", "l", "r")).alias("said"))


def parity_of_signals(spark, sf_dir):
    """Each vector as a signal against a later, noisier and shorter one, by label."""
    e = table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL")
    a = F.flatten(F.array_repeat(F.transform("embedding", lambda x: x.cast("double")), 40))
    b = F.transform(a, lambda x, i: x + 0.05 * F.sin(i * 1.7 + F.col("vec_id")))
    pairs = e.select("label", a.alias("a"), F.slice(b, 1, 2400).alias("b"))
    out = signal.parity(pairs, ["label"], "a", "b")
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("min_corr", "mean_corr", "mel_corr_min", "len_ratio_mean")], "n")


QUERIES["parity_of_signals"] = parity_of_signals
