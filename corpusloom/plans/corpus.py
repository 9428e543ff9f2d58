"""Queries of the corpus layer over the driver tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ordering, reports, selection, splits

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with quality and toxic, 0 where there is no label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").na.fill(0, ["quality", "toxic"])



def _bucket():
    """Slices of the order of doc_id, so that no source has to fit one task."""
    return F.floor(F.col("doc_id") / 4096)


LABELLED = "SELECT doc_id, lang, source, n_chars, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM documents LEFT JOIN labels USING (doc_id)"


@query("SELECT source, lang, round(CAST(sum(n_chars) AS BIGINT) / 3600.0, 3) AS hours FROM documents GROUP BY ALL")
def hours_by_source_lang(spark, sf_dir):
    return reports.hours(table(spark, sf_dir, "documents"), F.col("n_chars"), "source", "lang")


@query("SELECT lang, CAST(sum(n_chars) AS BIGINT) AS total, round(100.0 * sum(n_chars) / sum(sum(n_chars)) OVER (), 1) AS percent FROM documents GROUP BY lang")
def mix_percent_by_lang(spark, sf_dir):
    return reports.shares(table(spark, sf_dir, "documents"), F.col("n_chars"), "lang")


@query("SELECT source, lang, n, first_seen, CAST(row_number() OVER (ORDER BY n DESC, first_seen) AS INTEGER) AS rank FROM (SELECT source, lang, count(*) AS n, min(doc_id) AS first_seen FROM documents GROUP BY ALL)")
def style_counts(spark, sf_dir):
    return reports.most_common(table(spark, sf_dir, "documents"), ["source", "lang"], "doc_id")


@query(f"SELECT source, CAST(coalesce(sum(n_chars) FILTER (toxic = 0), 0) AS BIGINT) AS plain, CAST(coalesce(sum(n_chars) FILTER (toxic = 1), 0) AS BIGINT) AS flagged FROM ({LABELLED}) GROUP BY source")
def conditional_hours_pivot(spark, sf_dir):
    one = lambda v: F.coalesce(F.sum(F.when(F.col("toxic") == v, F.col("n_chars"))), F.lit(0))
    return labelled(spark, sf_dir).groupBy("source").agg(one(0).alias("plain"), one(1).alias("flagged"))


REASON = "CASE WHEN n_chars < 150 THEN 'too_short' WHEN n_chars > 20000 THEN 'too_long' WHEN text = '' THEN 'empty' ELSE 'kept' END"


def _reason():
    return reports.first_reason({"too_short": F.col("n_chars") < 150, "too_long": F.col("n_chars") > 20000, "empty": F.col("text") == ""})


@query(f"SELECT doc_id, {REASON} AS reason FROM documents")
def duration_filter_reasons(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", _reason().alias("reason"))


@query(f"SELECT source, {REASON} AS reason, count(*) AS n FROM documents GROUP BY ALL")
def drop_counts_by_reason(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source", _reason().alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, regexp_matches(upper(event_type), 'CLICK|PURCHASE|SIGN') AS flagged FROM events")
def keyword_flag(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.upper("event_type").rlike("CLICK|PURCHASE|SIGN").alias("flagged"))


@query("SELECT event_id, CAST(coalesce(CASE WHEN value > 0 AND value <= 25 THEN value END, 0) AS DOUBLE) AS duration, value > 0 AND value <= 25 AS valid FROM events")
def duration_validity(spark, sf_dir):
    v = F.coalesce(F.col("value").cast("string").try_cast("double"), F.lit(0.0))
    return table(spark, sf_dir, "events").select("event_id", F.when((v > 0) & (v <= 25), v).otherwise(0.0).alias("duration"), ((v > 0) & (v <= 25)).alias("valid"))


@query("SELECT page_id, coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), nullif(url, ''), 'none') AS title FROM pages")
def schema_fallback_coalesce(spark, sf_dir):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(F.nullif(title, F.lit("")), F.nullif("url", F.lit("")), F.lit("none")).alias("title"))


@query(f"""WITH t AS (SELECT *, CAST(coalesce(sum(n_chars) OVER (PARTITION BY source, toxic ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent FROM ({LABELLED}))
SELECT doc_id, source, toxic, n_chars, spent FROM t WHERE spent < CASE WHEN toxic = 1 THEN 10000.0 ELSE 20000.0 END""")
def budget_admission(spark, sf_dir):
    cap = F.when(F.col("toxic") == 1, 10000.0).otherwise(20000.0)
    return selection.admit(labelled(spark, sf_dir), "n_chars", cap, ["source", "toxic"], ["doc_id"], _bucket()).select("doc_id", "source", "toxic", "n_chars", "spent")


def _pass(n: int, flag: int, budget: str) -> str:
    row = f"pass IS NULL AND toxic = {flag}"
    return f"""p{n}b AS (SELECT *, {budget} AS budget, coalesce(sum(CASE WHEN {row} THEN n_chars END) OVER (PARTITION BY lang ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM p{n - 1}),
p{n} AS (SELECT doc_id, lang, n_chars, toxic, h, CASE WHEN {row} AND s < budget THEN {n} ELSE pass END AS pass FROM p{n}b)"""


_GOT = "50000.0 - coalesce(sum(CASE WHEN pass IS NOT NULL THEN n_chars END) OVER (PARTITION BY lang), 0)"


@query(f"""WITH p0 AS (SELECT doc_id, lang, n_chars, toxic, md5('7|' || doc_id) AS h, CAST(NULL AS INTEGER) AS pass FROM ({LABELLED})),
{_pass(1, 0, "40000.0")}, {_pass(2, 1, "10000.0")}, {_pass(3, 0, _GOT)}, {_pass(4, 1, _GOT)}
SELECT doc_id, lang, n_chars, toxic, pass FROM p4 WHERE pass IS NOT NULL""")
def budget_four_pass_fill(spark, sf_dir):
    rows = labelled(spark, sf_dir).withColumn("flagged", F.col("toxic") == 1).withColumn("h", ordering.shuffle_key(7, "doc_id"))
    out = selection.four_passes(rows, "n_chars", 50000.0, "flagged", ["lang"], ["h", "doc_id"], bucket=F.substring("h", 1, 2))
    return out.filter("pass IS NOT NULL").select("doc_id", "lang", "n_chars", "toxic", "pass")


@query("""WITH a AS (SELECT *, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM documents WHERE n_chars >= 200),
b AS (SELECT *, CAST(coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent FROM a WHERE s < 30000)
SELECT doc_id, source, n_chars, spent FROM b WHERE spent < 400000""")
def two_level_budget(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").filter("n_chars >= 200")
    return selection.two_levels(docs, "n_chars", "source", 30000, 400000, "doc_id").select("doc_id", "source", "n_chars", "spent")


@query("""WITH f AS (SELECT source, min(doc_id) AS m FROM documents GROUP BY 1), i AS (SELECT source, CAST(dense_rank() OVER (ORDER BY m) + 1 AS INTEGER) AS speaker FROM f)
SELECT doc_id, source, speaker FROM documents JOIN i USING (source) WHERE n_chars BETWEEN 200 AND 15000""")
def first_seen_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return selection.first_seen_ids(docs, "source", "doc_id", base=2, name="speaker").filter("n_chars BETWEEN 200 AND 15000").select("doc_id", "source", "speaker")


@query("""WITH n AS (SELECT lang, count(*) AS n, sum(count(*)) OVER () AS total FROM documents GROUP BY 1),
k AS (SELECT lang, greatest(1, round_even(greatest(100, CAST(floor(0.02 * total) AS INTEGER)) * n / CAST(total AS DOUBLE), 0)) AS k FROM n),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) - 1 AS r FROM documents)
SELECT doc_id, lang, CASE WHEN r < k THEN 'val' ELSE 'train' END AS split FROM r JOIN k USING (lang)""")
def stratified_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return splits.stratified_split(docs, ["lang"], "doc_id", seed=42)


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('3|' || doc_id), doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents)
SELECT doc_id, pos, CAST(floor(pos / ceil(n / 7.0)) AS BIGINT) AS shard FROM r""")
def epoch_shards(spark, sf_dir):
    return splits.epoch_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", epoch=3, shards=7)


@query("SELECT event_id FROM events ORDER BY md5('0|' || event_id), event_id LIMIT 600")
def calibration_head(spark, sf_dir):
    return splits.head_of_epoch(table(spark, sf_dir, "events").select("event_id"), "event_id", 600)


@query("""WITH e AS (SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS sec, count(*) AS done FROM events GROUP BY 1),
r AS (SELECT *, greatest(floor((60 * 60 - 240) / (greatest(sec - 240, 1.0) / done)), 50) AS n_rows FROM e)
SELECT user_id, greatest(1, CAST(ceil(100000 / n_rows) AS BIGINT)) AS shards FROM r""")
def shard_sizing(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.sum(F.round(F.col("value") * 100).cast("long")).cast("double").alias("sec"), F.count(F.lit(1)).alias("done"))
    return e.select("user_id", splits.shard_count(F.col("sec"), F.col("done"), F.lit(60), F.lit(100000)).alias("shards"))


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('5|' || doc_id), doc_id) AS r FROM documents) WHERE r <= 8")
def sample_n_per_group(spark, sf_dir):
    return splits.sample_per_group(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], "doc_id", 8, seed=5)


@query("SELECT doc_id, lang, n_chars, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id DESC) AS r FROM documents) WHERE r <= 10")
def topn_by_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return splits.top_per_group(docs, ["lang"], [F.desc("n_chars"), F.desc("doc_id")], 10)


WORDS = "SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents"


def words_of(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return docs.select("doc_id", "lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))


@query(f"""WITH w AS (SELECT DISTINCT word FROM ({WORDS})), r AS (SELECT word, row_number() OVER (ORDER BY md5('42|' || word), word) - 1 AS r, count(*) OVER () AS n FROM w)
SELECT word, r < floor(n * 0.1) AS held_out FROM r""")
def holdout_words(spark, sf_dir):
    return splits.holdout(words_of(spark, sf_dir).select("word").distinct(), "word")


@query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedupe_keep_first(spark, sf_dir):
    return splits.keep_first(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], "doc_id")


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('9|' || doc_id), doc_id) - 1 AS r FROM documents)
SELECT doc_id, CASE WHEN r < 300 THEN 'ood' WHEN r < 420 THEN 'appendix' WHEN r < 620 THEN 'mixed' ELSE 'rest' END AS part FROM r""")
def disjoint_slices(spark, sf_dir):
    return splits.disjoint_slices(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", {"ood": 300, "appendix": 120, "mixed": 200}, seed=9)


@query(f"SELECT word, count(*) AS n FROM ({WORDS}) WHERE lang = 'en' AND length(word) >= 2 GROUP BY word")
def word_freq(spark, sf_dir):
    return words_of(spark, sf_dir).filter("lang = 'en' AND length(word) >= 2").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT lang, count(DISTINCT word) AS types FROM ({WORDS}) GROUP BY lang")
def word_types(spark, sf_dir):
    return words_of(spark, sf_dir).distinct().groupBy("lang").agg(F.countDistinct("word").alias("types"))


@query("SELECT ch, n FROM (SELECT unnest(string_split(text, '')) AS ch, count(*) AS n FROM documents GROUP BY 1) WHERE ch <> '' ORDER BY n DESC, ch LIMIT 60")
def char_freq_top60(spark, sf_dir):
    chars = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "")).alias("ch")).filter("ch <> ''")
    return chars.groupBy("ch").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ch").limit(60)


@query(f"SELECT word, count(*) AS n FROM ({WORDS}) WHERE length(word) >= 2 GROUP BY word ORDER BY n DESC, word LIMIT 100")
def topk_words(spark, sf_dir):
    return words_of(spark, sf_dir).filter("length(word) >= 2").groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(100)


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


SENTENCES = r"SELECT doc_id, trim(s) AS sentence FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(10), 'g'), chr(10))) AS s FROM documents) WHERE trim(s) <> ''"


def sentences_of(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.explode(F.split("text", r"(?<=[.?!])\s+|\n+")).alias("s")).select("doc_id", F.trim("s").alias("sentence")).filter("sentence <> ''")


@query(f"SELECT doc_id, sentence, count(*) AS n FROM ({SENTENCES}) GROUP BY ALL")
def sentence_split(spark, sf_dir):
    return sentences_of(spark, sf_dir).groupBy("doc_id", "sentence").agg(F.count(F.lit(1)).alias("n"))


OOD = rf"SELECT * FROM ({SENTENCES}) WHERE length(sentence) BETWEEN 20 AND 200 AND NOT regexp_matches(sentence, '[][{{}}()<>|/=\\*_#]') AND regexp_matches(sentence, '[.?!]$')"


def ood_of(spark, sf_dir) -> DataFrame:
    s = F.col("sentence")
    return sentences_of(spark, sf_dir).filter((F.char_length(s).between(20, 200)) & ~s.rlike(r"[\[\]{}()<>|/=\\*_#]") & s.rlike("[.?!]$"))


@query(f"SELECT DISTINCT sentence FROM ({OOD})")
def ood_sentence_filter(spark, sf_dir):
    return ood_of(spark, sf_dir).select("sentence").distinct()


@query(f"SELECT DISTINCT sentence FROM ({OOD}) WHERE sentence NOT IN (SELECT trim(s) FROM (SELECT unnest(string_split(regexp_replace(text, '([.?!])\\s+', '\\1' || chr(10), 'g'), chr(10))) AS s FROM benchmark))")
def exclude_antijoin(spark, sf_dir):
    known = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", r"(?<=[.?!])\s+|\n+")).alias("s")).select(F.trim("s").alias("sentence"))
    return ood_of(spark, sf_dir).select("sentence").distinct().join(known, "sentence", "left_anti")


@query(f"SELECT DISTINCT sentence FROM ({SENTENCES}) WHERE NOT regexp_matches(sentence, '[0-9]') OR substr(md5('3|' || sentence), 1, 8) < '4ccccccc'")
def bernoulli_digit_thinning(spark, sf_dir):
    s = F.col("sentence")
    keep = ~s.rlike("[0-9]") | (F.substring(ordering.shuffle_key(3, "sentence"), 1, 8) < "4ccccccc")
    return sentences_of(spark, sf_dir).filter(keep).select("sentence").distinct()


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def extras_antijoin(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


EDITS = "(VALUES ('user', 'speaker one'), ('assistant', 'speaker two'), ('narrator', 'speaker three'))"


@query(f"""WITH e(k, v) AS (SELECT * FROM {EDITS})
SELECT c.conv_id, c.turn, coalesce(e.v, c.role) AS role, (SELECT count(*) FROM e WHERE k NOT IN (SELECT role FROM conversations)) AS unmatched FROM conversations c LEFT JOIN e ON c.role = e.k""")
def text_edit_join(spark, sf_dir):
    edits = spark.createDataFrame([("user", "speaker one"), ("assistant", "speaker two"), ("narrator", "speaker three")], "k string, v string")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    unmatched = edits.join(c, edits["k"] == c["role"], "left_anti").agg(F.count(F.lit(1)).alias("unmatched"))
    return c.join(F.broadcast(edits), c["role"] == edits["k"], "left").crossJoin(F.broadcast(unmatched)).select("conv_id", "turn", F.coalesce("v", "role").alias("role"), "unmatched")


@query("""WITH f AS (SELECT lower(text) AS t, conv_id, turn, role FROM conversations)
SELECT t AS text, min(conv_id * 1000 + turn) AS first_seen, string_agg(role, ',' ORDER BY conv_id, turn, role) AS roles, count(*) AS n FROM f GROUP BY t""")
def grouped_listening_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("text", F.lower("text"))
    one = F.sort_array(F.collect_list(F.struct("conv_id", "turn", "role")))
    return c.groupBy("text").agg(F.min(F.col("conv_id") * 1000 + F.col("turn")).alias("first_seen"), F.array_join(F.transform(one, lambda x: x["role"]), ",").alias("roles"), F.count(F.lit(1)).alias("n"))


@query(r"""SELECT page_id, p AS paragraph, count(*) AS n FROM (SELECT page_id, trim(regexp_replace(unnest(string_split(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'gs'), '</?(p|div|li|h[1-6]|br)[^>]*>', chr(10), 'g'), chr(10))), '<[^>]*>', '', 'g')) AS p FROM pages)
WHERE length(p) >= 40 AND p NOT LIKE '%==%' GROUP BY ALL""")
def html_paragraphs(spark, sf_dir):
    html = F.regexp_replace("html", r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " ")
    parts = F.explode(F.split(F.regexp_replace(html, "</?(p|div|li|h[1-6]|br)[^>]*>", "\n"), "\n"))
    rows = table(spark, sf_dir, "pages").select("page_id", parts.alias("p")).select("page_id", F.trim(F.regexp_replace("p", "<[^>]*>", "")).alias("paragraph"))
    return rows.filter((F.char_length("paragraph") >= 40) & ~F.col("paragraph").contains("==")).groupBy("page_id", "paragraph").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT source, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS refs FROM ({LABELLED}) WHERE toxic = 0 AND quality = 1 GROUP BY source")
def refs_per_speaker(spark, sf_dir):
    rows = labelled(spark, sf_dir).filter("toxic = 0 AND quality = 1").groupBy("source").agg(F.sort_array(F.collect_list("doc_id")).alias("refs"))
    return rows.select("source", F.array_join(F.col("refs").cast("array<string>"), ",").alias("refs"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def sha256_fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query(f"""SELECT count(*) AS n_rows, count(DISTINCT source) AS sources, CAST(sum(n_chars) AS BIGINT) AS chars, count(*) FILTER (toxic = 1) AS flagged,
CAST(sum(CASE WHEN quality = 1 THEN n_chars ELSE 0 END) AS BIGINT) AS good_chars, count(*) FILTER (n_chars > 10000) AS long_rows, coalesce(max(n_chars), 0) AS longest FROM ({LABELLED})""")
def audit_summary(spark, sf_dir):
    return labelled(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("source").alias("sources"), F.sum("n_chars").alias("chars"), F.count_if(F.col("toxic") == 1).alias("flagged"),
        F.sum(F.when(F.col("quality") == 1, F.col("n_chars")).otherwise(0)).alias("good_chars"), F.count_if(F.col("n_chars") > 10000).alias("long_rows"), F.coalesce(F.max("n_chars"), F.lit(0)).alias("longest"),
    )


@query("SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY ALL")
def dropped_by_group(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query(f"""WITH t AS (SELECT *, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM ({LABELLED}) WHERE n_chars BETWEEN 150 AND 20000),
a AS (SELECT * FROM t WHERE spent < 60000), n AS (SELECT lang, count(*) AS n, sum(count(*)) OVER () AS total FROM a GROUP BY 1),
k AS (SELECT lang, greatest(1, round_even(greatest(100, CAST(floor(0.02 * total) AS INTEGER)) * n / CAST(total AS DOUBLE), 0)) AS k FROM n),
r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) - 1 AS r FROM a)
SELECT CASE WHEN r < k THEN 'val' ELSE 'train' END AS split, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM r JOIN k USING (lang) GROUP BY ALL""")
def flagship_split(spark, sf_dir):
    """Scan, join labels, filter, budget per source, stratified split, report."""
    rows = labelled(spark, sf_dir).filter("n_chars BETWEEN 150 AND 20000")
    rows = selection.admit(rows, "n_chars", 60000, ["source"], ["doc_id"], _bucket())
    return splits.stratified_split(rows, ["lang"], "doc_id", seed=42).groupBy("split", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
