"""Queries of sources and sinks: files written from the driver tables and read back, with SQL over those tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import registry
from ..sources import files, shards
from ..streaming import steps
from ..streaming.budget import shared_folder
from .corpus import ORACLES as CORPUS
from .corpus import labelled, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def folder(spark) -> str:
    """A new folder where all machines write and read; it goes when the application ends."""
    path = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def _seq():
    return F.col("conv_id") * 1000 + F.col("turn")


@query("SELECT CAST(doc_id AS VARCHAR) AS utt, lang, source, text, n_chars / 10.0 AS dur_raw, n_chars / 5.0 AS dur FROM documents")
def manifest_round_trip(spark, sf_dir):
    """A manifest written, then rewritten from itself with one more field."""
    at = f"{folder(spark)}/manifest"
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("utt"), "lang", "source", "text", (F.col("n_chars") / 10.0).alias("dur_raw"))
    d.write.json(at)
    files.write_manifest(files.read_manifest(spark, at).withColumn("dur", F.col("dur_raw") * 2), at)
    return files.read_manifest(spark, at).select("utt", "lang", "source", "text", "dur_raw", "dur")


@query("SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def json_document_round_trip(spark, sf_dir):
    at = f"{folder(spark)}/report"
    files.write_json_document(table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")), at)
    return files.read_json_document(spark, at, "source string, n long, chars long")


@query("SELECT 'line ' || doc_id AS line FROM documents WHERE doc_id % 5 > 0 AND doc_id % 7 > 0")
def line_list(spark, sf_dir):
    """Lines, comments and blank lines; the lines come back trimmed."""
    at, i = f"{folder(spark)}/lines", F.col("doc_id")
    line = F.when(i % 5 == 0, F.concat(F.lit("# "), i)).when(i % 7 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" line "), i, F.lit(" ")))
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(at)
    return files.read_lines(spark, at)


@query("""SELECT user_id, event_type, event_id AS last FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events WHERE event_id % 11 > 0) WHERE r = 1""")
def transcript_lines(spark, sf_dir):
    """File names with texts, of which the last line counts; lines with too few fields don't."""
    at = f"{folder(spark)}/transcripts"
    file = F.concat_ws("/", "user_id", "event_type")
    fields = F.when(F.col("event_id") % 11 > 0, F.concat_ws("\t", "file", "event_id", F.lit("x"))).otherwise(F.concat_ws("\t", "file", "event_id"))
    rows = table(spark, sf_dir, "events").select("event_id", file.alias("file"))
    rows.repartition("file").sortWithinPartitions("event_id").select(fields.alias("value")).write.text(at)
    last = files.read_tsv(spark, at, ["file", "text"], least=3).groupBy("file").agg(F.max_by("text", "seq").alias("text"))
    return last.select(F.substring_index("file", "/", 1).cast("long").alias("user_id"), files.basename(F.col("file")).alias("event_type"), F.col("text").cast("long").alias("last"))


SPOKEN = "SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM conversations"
# --- expected results: fixed values ---
PRONS = ["kɪtɑːb", "ɡʰər", "hɛː"]
# --- end of expected results ---
PRON_SQL = "CASE length(word) % 3 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PRONS)) + " END"


def _words(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(_seq().alias("at"), F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("p", "word"))
    pron = F.element_at(F.array(*map(F.lit, PRONS)), (F.char_length("word") % len(PRONS) + 1).cast("int"))
    return c.withColumn("pron", pron)


@query(f"SELECT DISTINCT word, {PRON_SQL} AS pron, CASE WHEN length(word) > 4 THEN 'llm' ELSE 'wikipron' END AS source, CASE WHEN length(word) > 6 THEN 'ɡər;hɛː' ELSE '' END AS variants FROM ({SPOKEN})")
def lexicon_round_trip(spark, sf_dir):
    """A lexicon under a header; an entry without a source gets the default one."""
    at, n = f"{folder(spark)}/lexicon", F.char_length("word")
    w = _words(spark, sf_dir).select("word", "pron").distinct()
    w = w.withColumns({"source": F.when(n > 4, "llm").otherwise(""), "variants": F.when(n > 6, F.array(F.lit("ɡər"), F.lit("hɛː"))).otherwise(F.array().cast("array<string>"))})
    files.write_lexicon(w, at, "words\nof all turns")
    return files.read_lexicon(spark, at).select("word", "pron", "source", F.array_join("variants", ";").alias("variants"))


@query("""WITH w AS (SELECT conv_id * 1000 + turn AS k, unnest(x) AS word, generate_subscripts(x, 1) AS p FROM (SELECT *, regexp_extract_all(lower(text), '[a-z]+') AS x FROM conversations))
SELECT word, count(*) AS n, md5(string_agg('p' || k, ' ' ORDER BY k, p)) AS prons FROM w WHERE length(word) BETWEEN 2 AND 40 GROUP BY word""")
def wikipron_scan(spark, sf_dir):
    """Every word's pronunciations in the order of lines; words of one character are left out."""
    at = f"{folder(spark)}/wikipron"
    w = _words(spark, sf_dir).filter("length(word) <= 40")
    w.repartition("word").sortWithinPartitions("at", "p").select(F.concat_ws("\t", "word", F.concat(F.lit("p"), "at")).alias("value")).write.text(at)
    return files.read_wikipron(spark, at).select("word", F.size("prons").cast("long").alias("n"), F.md5(F.array_join("prons", " ")).alias("prons"))


@query(f"SELECT word, {PRON_SQL} AS pron, count(*) AS n FROM ({SPOKEN}) GROUP BY ALL")
def pair_scan(spark, sf_dir):
    """Pairs to learn from: phones set apart by spaces come back as one canonical string."""
    at = f"{folder(spark)}/pairs"
    _words(spark, sf_dir).select(F.concat(F.lit(" "), "word", F.lit("\t"), F.regexp_replace("pron", "(.)(?=[^ː])", "$1 ")).alias("value")).write.text(at)
    return files.read_pairs(spark, at).groupBy("word", "pron").agg(F.count(F.lit(1)).alias("n"))


# --- expected results: fixed values ---
LISTED = [("كتاب", "کتاب"), ("عِلْم", "عِلْم"), ("ab", None), ("ق", None), ("گھر", "گھر")]
# --- end of expected results ---


@query("SELECT word, count(*) AS n FROM (SELECT CASE doc_id % 5 " + " ".join(f"WHEN {i} THEN '{w}'" for i, (_, w) in enumerate(LISTED) if w) + " END AS word FROM documents) WHERE word IS NOT NULL GROUP BY word")
def word_list_scan(spark, sf_dir):
    at = f"{folder(spark)}/words"
    raw = F.element_at(F.array(*[F.lit(r) for r, _ in LISTED]), (F.col("doc_id") % len(LISTED) + 1).cast("int"))
    table(spark, sf_dir, "documents").select(F.concat_ws("\t", raw, "doc_id").alias("value")).write.text(at)
    return files.read_words(spark, at).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(user_id AS VARCHAR) AS w, arg_max(CASE WHEN value < 250 THEN 'second' ELSE 'first' END || event_id, CASE WHEN value < 250 THEN 1000000000000 ELSE 0 END + event_id) AS p FROM events GROUP BY user_id")
def cache_round_trip(spark, sf_dir):
    """Two appends and a broken line: of equal keys the last one appended counts."""
    at = f"{folder(spark)}/cache"
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("w"), "event_id", (F.col("value") < 250).alias("late"))
    for late, name in ((False, "first"), (True, "second")):
        rows = e.filter(F.col("late") == late).repartition("w").sortWithinPartitions("event_id")
        files.append_cache(rows.select("w", F.concat(F.lit(name), "event_id").alias("p")), at)
    spark.range(1).select(F.lit('{"w": broken').alias("value")).write.mode("append").text(at)
    return files.read_cache(spark, at)


@query("SELECT conv_id || '_' || turn || '.wav' AS file, length(regexp_replace(text, '[|\\n\\r]', ' ', 'g')) AS n, CAST(turn AS VARCHAR) AS spk FROM conversations")
def pipe_list_round_trip(spark, sf_dir):
    """Lines of clip, phones and speaker, read back as file name and length."""
    at = f"{folder(spark)}/list"
    c = table(spark, sf_dir, "conversations").select(F.concat(F.lit("C:\\wav/"), "conv_id", F.lit("_"), "turn", F.lit(".wav")).alias("wav"), F.regexp_replace("text", "[|\n\r]", " ").alias("phonemes"), F.col("turn").alias("spk"))
    files.write_list(c, at, ["wav", "phonemes", "spk"])
    rows = files.read_list(spark, at, ["wav", "phonemes", "spk"])
    return rows.select(files.basename(F.col("wav")).alias("file"), F.char_length("phonemes").cast("long").alias("n"), "spk")


@query("SELECT word, CAST(count(*) AS VARCHAR) AS n FROM (" + SPOKEN + ") GROUP BY word")
def count_list_round_trip(spark, sf_dir):
    """Words with their counts, the most frequent first."""
    at = f"{folder(spark)}/counts"
    counts = _words(spark, sf_dir).groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word")
    files.write_list(counts, at, ["word", "n"], "\t")
    return files.read_tsv(spark, at, ["word", "n"], least=2).select("word", "n")


@query("SELECT n_name AS resource, CAST(n_nationkey + 0.5 AS DOUBLE) AS used, CAST(30 AS DOUBLE) AS total FROM nation WHERE n_name = 'NATION_7'")
def quota_row(spark, sf_dir):
    at = f"{folder(spark)}/quota"
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("resource"), F.concat("n_nationkey", F.lit(".5h")).alias("used"), F.lit("30H").alias("total"))
    n.write.option("header", True).csv(at)
    return files.read_quota(spark, at, "nation_7")


@query("SELECT 'source=' || source AS speaker, CAST(sum(strlen(doc_id || '') + 1) AS BIGINT) AS bytes FROM documents WHERE source IS NOT NULL GROUP BY source")
def media_listing(spark, sf_dir):
    """Files under a folder per speaker: their sizes, without reading them."""
    at = f"{folder(spark)}/media"
    d = table(spark, sf_dir, "documents").filter("source IS NOT NULL").select("source", F.col("doc_id").cast("string").alias("value"))
    d.write.partitionBy("source").text(at)
    return files.read_media(spark, at, "*.txt").groupBy("speaker").agg(F.sum("length").alias("bytes"))


@query("""SELECT page_id, 'p' || page_id || '.html' AS file, strlen(html) AS bytes, sha256(html) AS sha FROM pages WHERE html IS NOT NULL AND page_id % 2 = 0""")
def tar_round_trip(spark, sf_dir):
    """Pages packed into archives, written, streamed back, and joined with the last of their transcript lines."""
    at = folder(spark)
    p = table(spark, sf_dir, "pages").filter("html IS NOT NULL")
    member = F.concat(F.lit("dir/p"), "page_id", F.lit(".html"))
    packed = files.pack_tar(p.select((F.col("page_id") % 16).alias("archive"), member.alias("member"), F.encode("html", "UTF-8").alias("html")), "archive", "member", "html")
    files.write_files(packed.withColumn("name", F.concat("archive", F.lit("-"), "part", F.lit(".tar"))), f"{at}/tar", "name", "content")
    line = F.concat_ws("\t", F.concat(F.lit("x\\p"), "page_id", F.lit(".html")), "page_id", F.lit("x"))
    p.filter("page_id % 2 = 0").select(line.alias("value")).write.text(f"{at}/lines")
    out = files.tar_with_transcripts(spark, f"{at}/tar", f"{at}/lines", suffix=".html")
    return out.select(F.col("text").cast("long").alias("page_id"), "file", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha"))


@query("SELECT vec_id, 24000 AS rate, len(embedding) AS n, CAST(trunc(greatest(-1.0, least(1.0, CAST(embedding[1] AS DOUBLE) * 8)) * 32767) AS BIGINT) AS first FROM embeddings")
def wav_round_trip(spark, sf_dir):
    """Vectors as clips of 16-bit samples, clipped to one."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 8).alias("y"))
    w = e.select("vec_id", files.from_wav(files.to_wav(F.col("y"))).alias("w"))
    return w.select("vec_id", "w.rate", F.size("w.samples").cast("long").alias("n"), F.round(F.element_at("w.samples", 1).cast("double") * 32767).cast("long").alias("first"))


LOG = "SELECT event_id, floor(value) AS v FROM events"


@query(f"""SELECT 'loss' AS name, CAST(arg_min(v, event_id) AS DOUBLE) AS first, CAST(arg_max(v, event_id) AS DOUBLE) AS last, round(avg(v), 6) AS mean, count(*) AS n FROM ({LOG})
UNION ALL SELECT 'Saving..', NULL, NULL, NULL, count(*) FILTER (v > 400) FROM ({LOG})""")
def log_scan(spark, sf_dir):
    """A log in files that follow one another: first, last and mean of a number, and how often a marker stands there."""
    at = f"{folder(spark)}/log"
    v = F.floor("value").cast("long")
    line = F.concat(F.lit("step "), "event_id", F.lit(", Mel Loss: "), v, F.when(v > 400, " Saving..").otherwise(""))
    rows = table(spark, sf_dir, "events").select("event_id", line.alias("value"))
    rows.repartitionByRange("event_id").sortWithinPartitions("event_id").select("value").write.text(at)
    return files.parse_log(spark, at, {"loss": r"Mel Loss: (\d+)"}, ["Saving.."]).withColumn("mean", F.round("mean", 6))


def _esc(c: str) -> str:
    return f"""replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')"""


@query(f"""SELECT min(conv_id * 1000 + turn) AS first_seen, md5('<section><h2>' || {_esc("text")} || '</h2>' || string_agg('<p>' || {_esc("role")} || ' <audio controls src="' || conv_id || '.wav"></audio></p>', '' ORDER BY conv_id * 1000 + turn, role, conv_id) || '</section>') AS page
FROM conversations GROUP BY text""")
def listening_sections(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(_seq().alias("seq"), "text", "role", F.concat("conv_id", F.lit(".wav")).alias("src"))
    return files.listening_page(c, "text", "role", "src", "seq").select("first_seen", F.md5("html").alias("page"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name, n_regionkey || ' ' || n_name AS note FROM nation")
def review_round_trip(spark, sf_dir):
    """A sheet to look through under its header; a tab in a field becomes a space."""
    at = f"{folder(spark)}/review"
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.concat_ws("\t", "n_regionkey", "n_name").alias("note"))
    files.write_review(n, at, ["key", "name", "note"], ["key"])
    return files.read_tsv(spark, at, ["key", "name", "note"]).filter("key <> 'key'").select("key", "name", "note")


@query("SELECT '## regions' || chr(10) || chr(10) || '| key | name |' || chr(10) || '|-|-|' || chr(10) || string_agg('| ' || r_regionkey || ' | ' || r_name || ' |', chr(10) ORDER BY r_regionkey) || chr(10) AS report FROM region")
def markdown_report(spark, sf_dir):
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")).orderBy("key")
    return spark.createDataFrame([(files.markdown(r, "regions"),)], "report string")


@query(r"SELECT page_id, regexp_extract(url, '[^\\/]+$', 0) AS file FROM pages")
def url_basename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", files.basename(F.col("url")).alias("file"))


@query("SELECT page_id, octet_length(encode(html)) AS bytes, sha256(html) AS sha FROM pages")
def shard_scan(spark, sf_dir):
    """Shards read by the data source: two of three columns, the payload as bytes."""
    at = f"{folder(spark)}/shards"
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.encode("html", "UTF-8").alias("payload"))
    shards.write_shards(p, at, ["page_id"], 8)
    shards.register(spark)
    rows = spark.read.format("shards").schema("page_id long, payload binary").load(at)
    return rows.select("page_id", F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("sha"))


@query("SELECT page_id, octet_length(encode(html)) AS bytes, page_id % 2 AS start FROM pages")
def shard_stream(spark, sf_dir):
    """The same shards as a stream that is started twice, the second time with new shards: each is taken once."""
    at = folder(spark)
    p = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("payload"))
    shards.register(spark)
    for start in (0, 1):
        part = f"{at}/part{start}"
        shards.write_shards(p.filter(F.col("page_id") % 2 == start), part, ["page_id"], 4)
        files.move_all(spark, part, f"{at}/in", f"{start}-")
        rows = spark.readStream.format("shards").schema("page_id long, payload binary").load(f"{at}/in")
        rows = rows.select("page_id", F.octet_length("payload").cast("long").alias("bytes"), F.lit(start).cast("long").alias("start"))
        rows.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query(CORPUS["budget_admission"].replace("10000.0", "2000.0").replace("20000.0", "4000.0"))
def budget_scan(spark, sf_dir):
    """Budgeted admission over shards, which ends when all budgets are full: later shards are not opened."""
    at = folder(spark)
    d = labelled(spark, sf_dir).select("doc_id", "source", "toxic", "n_chars")
    shards.write_shards(d, f"{at}/shards", ["doc_id"], 16)
    budgets = d.select("source", "toxic").distinct().collect()  # a row a budget
    caps = {(r["source"], r["toxic"]): 2000.0 if r["toxic"] == 1 else 4000.0 for r in budgets}
    out, _ = shards.admit_until_full(spark, f"{at}/shards", f"{at}/out", None, "n_chars", ["source", "toxic"], caps, "doc_id", F.shiftright("doc_id", 12))
    return out.select("doc_id", "source", "toxic", "n_chars", "spent")


@query("SELECT vec_id, CAST(i AS INTEGER) AS part, 'sentence ' || i || '.' AS sentence FROM embeddings, range(3) AS t(i) WHERE embedding IS NOT NULL")
def clip_parts(spark, sf_dir):
    """Clips of three loud stretches, made of each vector, cut at their pauses by a table function in a lateral join."""
    registry.register(spark)
    loud = F.flatten(F.array_repeat(F.transform("embedding", lambda x: F.when(x < 0, -1.0).otherwise(1.0)), 64))
    quiet = F.array_repeat(F.lit(0.0), 4096)
    e = table(spark, sf_dir, "embeddings").filter("embedding IS NOT NULL")
    e.select("vec_id", F.concat(loud, quiet, loud, quiet, loud).alias("samples")).createOrReplaceTempView("corpusloom_clips")
    return spark.sql("SELECT vec_id, part, sentence FROM corpusloom_clips, LATERAL corpus_clip_parts(samples, 2000, 'sentence 0. sentence 1. sentence 2.', 1.5D, 20.0D)")


@query(r"""WITH s AS (SELECT conv_id, turn, unnest(list_filter(string_split(regexp_replace(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')) AS sentence FROM conversations)
SELECT conv_id, round(avg(CASE WHEN length(sentence) % 7 > 0 THEN length(sentence) END), 6) AS mean FROM s GROUP BY conv_id""")
def extensions_in_sql(spark, sf_dir):
    """A table function and an aggregate, both called from SQL: sentences of turns, and a mean without NaN."""
    registry.register(spark)
    table(spark, sf_dir, "conversations").createOrReplaceTempView("corpusloom_said")
    return spark.sql("""SELECT conv_id, round(corpus_nanmean(CASE WHEN length(sentence) % 7 > 0 THEN CAST(length(sentence) AS DOUBLE) ELSE CAST('NaN' AS DOUBLE) END), 6) AS mean
        FROM corpusloom_said, LATERAL corpus_sentences(text) GROUP BY conv_id""")


@query("SELECT event_type, user_id % 8 AS part, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def resumable_steps(spark, sf_dir):
    """A step over a stream of eight files, broken off in its third batch after it has written, and run again."""
    at, e = folder(spark), table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    e.withColumn("part", F.pmod("user_id", F.lit(8))).repartition("part").write.partitionBy("part").parquet(f"{at}/in")
    schema = "user_id long, event_type string, value double, part int"

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")

    def step(rows, batch):
        return rows.groupBy("event_type", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))

    def crash(batch, where):
        if batch == 2 and where == "written":
            raise RuntimeError("broken off")

    try:
        steps.run_steps(stream(), step, at, crash)
    except Exception as e:
        if "broken off" not in str(e):
            raise
    out = steps.run_steps(stream(), step, at)
    return out.groupBy("event_type", F.col("part").cast("long").alias("part")).agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))


@query(r"""WITH l AS (SELECT event_type, string_agg('step ' || event_id || ', Mel Loss: ' || CAST(floor(value) AS BIGINT) || chr(10), '' ORDER BY event_id) AS t FROM events GROUP BY event_type),
r AS (SELECT event_type, length(t) > 4000 AS longer, regexp_extract_all(right(t, 4000), 'Mel Loss: (\d+)', 1) AS v FROM l)
SELECT event_type, longer, len(v) AS n, CAST(v[-1] AS BIGINT) AS last FROM r""")
def log_tail(spark, sf_dir):
    """The last characters of each log, read from the end of its file."""
    at = f"{folder(spark)}/logs"
    line = F.concat(F.lit("step "), "event_id", F.lit(", Mel Loss: "), F.floor("value").cast("long"))
    e = table(spark, sf_dir, "events").select("event_type", "event_id", line.alias("value"))
    e.repartition("event_type").sortWithinPartitions("event_type", "event_id").select("event_type", "value").write.partitionBy("event_type").text(at)
    t = files.tails(spark, at, 4000)
    v = F.regexp_extract_all("text", F.lit(r"Mel Loss: (\d+)"), F.lit(1))
    rows = t.select(F.regexp_extract("path", "event_type=([^/]+)", 1).alias("event_type"), (F.col("length") > 4000).alias("longer"), v.alias("v"))
    return rows.select("event_type", "longer", F.size("v").cast("long").alias("n"), F.try_element_at("v", F.lit(-1)).cast("long").alias("last"))
