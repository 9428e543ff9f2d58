"""Queries of the scoring layer over the driver tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import edit
from ..operators import gates, reports, signal, vectors
from .corpus import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _norm(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9'' ]+', ' ', 'g'), '\\s+', ' ', 'g'))"


PAIRS = f"""SELECT conv_id, turn, role, {_norm("text")} AS hyp, lag({_norm("text")}) OVER (PARTITION BY conv_id ORDER BY turn) AS ref FROM conversations"""
CER = "CASE WHEN length(replace(ref, ' ', '')) > 0 THEN levenshtein(replace(ref, ' ', ''), replace(hyp, ' ', '')) / CAST(length(replace(ref, ' ', '')) AS DOUBLE) END"


def pairs(spark, sf_dir):
    """Consecutive turns as hypothesis and reference, normalised, whole."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", edit.normalize_en(F.col("text")).alias("t"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = c.select("conv_id", "turn", "role", F.col("t").alias("hyp"), F.lag("t").over(w).alias("ref"))
    # few bytes but much work: over as many tasks as any shuffle has, not put together by size
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id", "turn")


def cers(spark, sf_dir):
    return pairs(spark, sf_dir).filter("ref IS NOT NULL").select("conv_id", "turn", "role", edit.cer(F.col("ref"), F.col("hyp")).alias("cer"))


@query(f"SELECT conv_id, turn, round({CER}, 6) AS cer FROM ({PAIRS}) WHERE ref IS NOT NULL")
def cer_en_pairs(spark, sf_dir):
    return cers(spark, sf_dir).select("conv_id", "turn", F.round("cer", 6).alias("cer"))


@query()
def wer_pairs(spark, sf_dir):
    """No SQL: DuckDB's levenshtein compares bytes, and whole turns have more distinct words than a byte has values."""
    return pairs(spark, sf_dir).filter("ref IS NOT NULL").select("conv_id", "turn", F.round(edit.wer(F.col("ref"), F.col("hyp")), 6).alias("wer"))


@query(f"""WITH p AS (SELECT conv_id, turn, role, {CER} AS cer FROM ({PAIRS}) WHERE ref IS NOT NULL),
f AS (SELECT avg(CASE WHEN role = 'assistant' THEN cer END) AS floor FROM p)
SELECT conv_id, turn, round(cer, 6) AS cer FROM p, f WHERE cer <= CASE role WHEN 'assistant' THEN greatest(0.25, coalesce(floor, 0.10) + 0.15) WHEN 'user' THEN 0.78 END""")
def cer_filter_keep(spark, sf_dir):
    """A measured floor raises the limit of one group; rows of any other group have no limit and vanish."""
    rows = cers(spark, sf_dir)
    floor = rows.agg(F.avg(F.when(F.col("role") == "assistant", F.col("cer"))).alias("floor"))
    limit = F.when(F.col("role") == "assistant", F.greatest(F.lit(0.25), F.coalesce("floor", F.lit(0.10)) + 0.15)).when(F.col("role") == "user", 0.78)
    return rows.crossJoin(F.broadcast(floor)).filter(F.col("cer") <= limit).select("conv_id", "turn", F.round("cer", 6).alias("cer"))


EDGES = [0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 1, 10]


@query(f"""WITH b(bin, lo, hi) AS (VALUES {", ".join(f"({i}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:], strict=False)))}),
p AS (SELECT {CER} AS cer FROM ({PAIRS}) WHERE ref IS NOT NULL)
SELECT bin, lo, hi, count(cer) AS n FROM b LEFT JOIN p ON cer >= lo AND (cer < hi OR (bin = {len(EDGES) - 2} AND cer = hi)) GROUP BY ALL""")
def cer_histogram(spark, sf_dir):
    return reports.histogram(cers(spark, sf_dir), "cer", EDGES)


@query(f"""SELECT role, CAST(sum(levenshtein(replace(ref, ' ', ''), replace(hyp, ' ', ''))) AS DOUBLE) / sum(length(replace(ref, ' ', ''))) AS per, avg(CASE WHEN ref <> hyp THEN 1.0 ELSE 0.0 END) AS wer
FROM ({PAIRS}) WHERE ref IS NOT NULL GROUP BY role""")
def per_micro(spark, sf_dir):
    r, h = F.replace("ref", F.lit(" "), F.lit("")), F.replace("hyp", F.lit(" "), F.lit(""))
    rows = pairs(spark, sf_dir).filter("ref IS NOT NULL")
    return rows.groupBy("role").agg((F.sum(F.levenshtein(r, h)).cast("double") / F.sum(F.char_length(r))).alias("per"), F.avg(F.when(F.col("ref") != F.col("hyp"), 1.0).otherwise(0.0)).alias("wer"))


@query("SELECT event_type, user_id % 3 AS accent, round(avg(CASE WHEN value < 50 THEN value END), 6) AS low, round(avg(value), 6) AS every FROM events GROUP BY ALL")
def nanmean_by_kind(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("low", F.when(F.col("value") < 50, F.col("value")).otherwise(F.lit(float("nan"))))
    return e.groupBy("event_type", (F.col("user_id") % 3).alias("accent")).agg(F.round(reports.nan_mean(F.col("low")), 6).alias("low"), F.round(reports.nan_mean(F.col("value")), 6).alias("every"))


@query("SELECT user_id, round(sum(value) / greatest(sum(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.5 END), 1e-6), 3) AS rtf FROM events GROUP BY user_id")
def ratio_of_sums(spark, sf_dir):
    weight = F.when(F.col("event_type") == "click", 1.0).otherwise(0.5)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(reports.ratio_of_sums(F.col("value"), weight), 3).alias("rtf"))


METRICS = """SELECT user_id, avg(value) FILTER (event_type = 'click') / 1000 AS ood_cer, avg(value) FILTER (event_type = 'purchase') / 1000 AS pcer,
 avg(value) FILTER (event_type = 'view') / 10 AS mos, max(value) AS silence, count(*) FILTER (value > 495) AS lost FROM events GROUP BY user_id"""
GATES = """SELECT user_id, CASE WHEN ood_cer IS NOT NULL THEN ood_cer <= 0.10 + 0.03 END AS g_ood, CASE WHEN pcer IS NOT NULL THEN pcer <= 0.10 END AS g_pcer,
 CASE WHEN mos IS NOT NULL THEN mos >= 3.5 END AS g_mos, silence <= 480.0 AS g_silence, lost = 0 AS g_lost FROM (""" + METRICS + ")"
GATE_NAMES = ["g_ood", "g_pcer", "g_mos", "g_silence", "g_lost"]


def _gates(spark, sf_dir):
    of = lambda kind: reports.masked_mean(F.col("value"), F.col("event_type") == kind)
    m = table(spark, sf_dir, "events").groupBy("user_id").agg((of("click") / 1000).alias("ood_cer"), (of("purchase") / 1000).alias("pcer"), (of("view") / 10).alias("mos"), F.max("value").alias("silence"), F.count_if(F.col("value") > 495).alias("lost"))
    g = lambda c, t: gates.gate(F.col(c), t)
    return m.select("user_id", g("ood_cer", F.col("ood_cer") <= 0.10 + 0.03).alias("g_ood"), g("pcer", F.col("pcer") <= 0.10).alias("g_pcer"), g("mos", F.col("mos") >= 3.5).alias("g_mos"), (F.col("silence") <= 480.0).alias("g_silence"), (F.col("lost") == 0).alias("g_lost"))


@query(GATES)
def gate_eval(spark, sf_dir):
    return _gates(spark, sf_dir)


@query("SELECT user_id, " + " AND ".join(f"coalesce({g}, true)" for g in GATE_NAMES) + " AS gates_passed, " + " AND ".join(f"coalesce({g}, false)" for g in GATE_NAMES) + " AS gates_complete FROM (" + GATES + ")")
def gates_passed(spark, sf_dir):
    return _gates(spark, sf_dir).select("user_id", gates.passed(GATE_NAMES).alias("gates_passed"), gates.complete(GATE_NAMES).alias("gates_complete"))


@query("""WITH b AS (SELECT avg(value) AS base FROM events WHERE event_type = 'click') SELECT user_id, round(avg(value) - base, 6) AS diff, abs(avg(value) - base) <= 5 AS within FROM events, b GROUP BY user_id, base""")
def baseline_diff(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    base = e.filter("event_type = 'click'").agg(F.avg("value").alias("base"))
    rows = e.groupBy("user_id").agg(F.avg("value").alias("v")).crossJoin(F.broadcast(base))
    return rows.select("user_id", F.round(F.col("v") - F.col("base"), 6).alias("diff"), (F.abs(F.col("v") - F.col("base")) <= 5).alias("within"))


EPOCHS = "SELECT user_id % 25 AS stage, row_number() OVER (PARTITION BY user_id % 25 ORDER BY event_id) AS epoch, CASE WHEN event_id % 7 > 0 THEN value END AS val_mel, CASE WHEN event_id % 5 > 0 THEN value / 500 END AS cer, CASE WHEN event_id % 3 = 0 THEN 0.0 WHEN event_id % 3 = 1 THEN value / 100 END AS pcer FROM events"


def _epochs(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("stage", F.col("user_id") % 25)
    m = F.col("event_id") % 3
    return e.select("stage", F.row_number().over(Window.partitionBy("stage").orderBy("event_id")).alias("epoch"), F.when(F.col("event_id") % 7 > 0, F.col("value")).alias("val_mel"), F.when(F.col("event_id") % 5 > 0, F.col("value") / 500).alias("cer"), F.when(m == 0, 0.0).when(m == 1, F.col("value") / 100).alias("pcer"))


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY epoch DESC) AS back FROM ({EPOCHS}) WHERE val_mel IS NOT NULL)
SELECT stage, count(*) AS n, coalesce(count(*) >= 4 AND min(val_mel) FILTER (back <= 2) >= min(val_mel) FILTER (back > 2) - 0.005, false) AS stop FROM r GROUP BY stage""")
def early_stop(spark, sf_dir):
    return gates.early_stop(_epochs(spark, sf_dir), ["stage"], "epoch", "val_mel")


@query(f"""WITH s AS (SELECT stage, epoch, 0.0 + 3.0 * coalesce(cer, 1.0) + 1.0 * coalesce(pcer, 0.5) + 1.0 * coalesce(nullif(val_mel, 0.0), 9.0) AS score FROM ({EPOCHS}))
SELECT stage, CAST(arg_min(epoch, score * 1e9 + epoch) AS INTEGER) AS best_epoch, round(min(score), 6) AS best_score FROM s GROUP BY stage""")
def select_checkpoint(spark, sf_dir):
    return gates.select_checkpoint(_epochs(spark, sf_dir), ["stage"], "epoch", {"cer": (3.0, 1.0), "pcer": (1.0, 0.5), "val_mel": (1.0, 9.0)}, zero_is_missing=["val_mel"])


@query(f"""SELECT stage, CAST(epoch AS INTEGER) AS epoch, row_number() OVER (PARTITION BY stage ORDER BY epoch DESC) <= 2 OR epoch % 50 = 0 AS kept FROM ({EPOCHS})""")
def retention_keep(spark, sf_dir):
    return gates.retain(_epochs(spark, sf_dir), ["stage"], ["epoch"], 2, F.col("epoch") % 50 == 0).select("stage", "epoch", "kept")


@query("SELECT user_id, round(count(*) * 2.5 * 13 / 3600 * 1.15, 6) AS hours, round(count(*) * 2.5 * 13 / 3600 * 1.15 / 30, 6) AS weeks FROM events GROUP BY user_id")
def time_projection(spark, sf_dir):
    h = gates.projected_hours(F.count(F.lit(1)), F.lit(2.5), F.lit(13))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(h, 6).alias("hours"), F.round(h / 30, 6).alias("weeks"))


@query("""WITH l AS (SELECT user_id, event_id, 'Mel Loss: ' || CAST(CAST(value * 1000 AS BIGINT) AS VARCHAR) || ', step ' || event_id || CASE WHEN value > 400 THEN ' Saving..' ELSE '' END AS line FROM events),
p AS (SELECT *, CAST(regexp_extract(line, 'Mel Loss: (\\d+)', 1) AS BIGINT) AS loss FROM l)
SELECT user_id, arg_min(loss, event_id) AS first_loss, arg_max(loss, event_id) AS last_loss, round(avg(loss), 6) AS mean_loss, count(*) FILTER (line LIKE '%Saving..%') AS saved FROM p GROUP BY user_id""".replace("\\\\", "\\"))
def log_parse_stats(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    line = F.concat(F.lit("Mel Loss: "), F.round(F.col("value") * 1000).cast("long").cast("string"), F.lit(", step "), F.col("event_id").cast("string"), F.when(F.col("value") > 400, " Saving..").otherwise(""))
    p = e.select("user_id", "event_id", line.alias("line")).withColumn("loss", F.regexp_extract("line", r"Mel Loss: (\d+)", 1).cast("long"))
    return p.groupBy("user_id").agg(F.min_by("loss", "event_id").alias("first_loss"), F.max_by("loss", "event_id").alias("last_loss"), F.round(F.avg("loss"), 6).alias("mean_loss"), F.sum(F.regexp_count("line", F.lit("Saving"))).alias("saved"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, CAST(max(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS top FROM events GROUP BY event_type")
def props_json_stats(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total"), F.max(k).alias("top"))


@query("""WITH q AS (SELECT user_id, ts, event_id, value < 40 AS q, sum(CASE WHEN value < 40 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS loud FROM events),
r AS (SELECT user_id, loud, count(*) FILTER (q) AS n, count(*) AS a, max(loud) OVER (PARTITION BY user_id) AS last FROM q GROUP BY user_id, loud)
SELECT user_id, max(CASE WHEN loud > 0 AND loud < last THEN n WHEN last = 0 THEN a ELSE 0 END) AS longest FROM r GROUP BY user_id""")
def longest_quiet_run(spark, sf_dir):
    return signal.longest_quiet_run(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("value") < 40)


@query("SELECT vec_id, round(len(list_filter(embedding, lambda x: abs(x) >= 0.2)) / CAST(len(embedding) AS DOUBLE), 6) AS clipped FROM embeddings")
def clipping_ratio(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(signal.clipping_ratio(F.col("embedding"), 0.2), 6).alias("clipped"))


@query("""WITH m AS (SELECT user_id, median(value) AS mid, max(value) AS top FROM events GROUP BY 1)
SELECT user_id, round(mid, 6) AS median, round(top, 6) AS top, round(median(abs(value - mid)), 6) AS mad, round((top - mid) / (median(abs(value - mid)) + 1e-9), 6) AS peak FROM events JOIN m USING (user_id) GROUP BY user_id, mid, top""")
def median_mad_peak(spark, sf_dir):
    out = signal.mad_peak(table(spark, sf_dir, "events"), ["user_id"], "value")
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("median", "top", "mad", "peak")])


@query("SELECT event_id, array_to_string(list_filter([CASE WHEN value < 5 THEN 'near_silent' END, CASE WHEN value > 400 THEN 'clipping' END, CASE WHEN event_type = 'error' THEN 'bad_rate' END, CASE WHEN value < 1 OR value > 495 THEN 'short' END], lambda x: x IS NOT NULL), ',') AS issues FROM events")
def signal_issues(spark, sf_dir):
    v = F.col("value")
    tests = {"near_silent": v < 5, "clipping": v > 400, "bad_rate": F.col("event_type") == "error", "short": (v < 1) | (v > 495)}
    return table(spark, sf_dir, "events").select("event_id", F.array_join(signal.issues(tests), ",").alias("issues"))


@query("""WITH r AS (SELECT label, min(vec_id) AS ref FROM embeddings GROUP BY label)
SELECT a.vec_id, b.vec_id AS ref, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine
FROM embeddings a JOIN r USING (label) JOIN embeddings b ON b.vec_id = r.ref""")
def cosine_pairs(spark, sf_dir):
    """Every vector with the reference vector of its label (the speaker): its first one."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return vectors.against_reference(e, "vec_id", "embedding", "label").select("vec_id", "ref", F.round("cosine", 6).alias("cosine"))


@query("SELECT vec_id, round(sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm, round(CAST(embedding[1] AS DOUBLE) / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS first FROM embeddings")
def l2_normalise(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(vectors.norm(F.col("embedding")), 6).alias("norm"), F.round(F.element_at(vectors.unit(F.col("embedding")), 1), 6).alias("first"))


@query("SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL")
def centroid_by_label(spark, sf_dir):
    return vectors.centroid(table(spark, sf_dir, "embeddings"), "label", "embedding").select("label", "pos", F.round("mean", 6).alias("mean"))


@query("""WITH p AS (SELECT label, vec_id % 510 AS loc, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
s AS (SELECT label, loc, pos, count(*) AS n, sum(CAST(x AS DOUBLE)) AS x FROM p GROUP BY ALL), r AS (SELECT unnest(range(1, 511)) AS row),
w AS (SELECT label, row, pos, sum(exp(-0.5 * ((loc - row) / 40.0) ** 2) * n) AS w, sum(exp(-0.5 * ((loc - row) / 40.0) ** 2) * x) AS wx, sum(x) / sum(n) AS mean FROM s, r GROUP BY ALL)
SELECT label, row, CAST(pos AS INTEGER) AS pos, round(CASE WHEN w > 1e-3 THEN wx / w ELSE mean END, 5) AS value FROM w""")
def gaussian_weighted_rows(spark, sf_dir):
    """Rows 1 to 510 of each label (the speaker), over all of its vectors and all positions."""
    e = table(spark, sf_dir, "embeddings").select("label", (F.col("vec_id") % 510).alias("at"), "embedding")
    out = vectors.kernel_rows(e, "at", "embedding", spark.range(1, 511).withColumnRenamed("id", "row"), "row", by=["label"])
    return out.select("label", "row", "pos", F.round("value", 5).alias("value"))


@query("SELECT event_type, round(corr(value, CAST(json_extract(props, '$.k') AS BIGINT)), 6) AS r, min(value) AS lo, round(avg(value), 6) AS mean FROM events GROUP BY event_type")
def pearson_corr(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.corr("value", k), 6).alias("r"), F.min("value").alias("lo"), F.round(F.avg("value"), 6).alias("mean"))


@query("SELECT doc_id, vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM documents JOIN embeddings ON vec_id = least(n_chars, 510) - 1")
def voicepack_row_lookup(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", (F.least("n_chars", F.lit(510)) - 1).alias("vec_id"))
    return d.join(table(spark, sf_dir, "embeddings"), "vec_id").select("doc_id", "vec_id", F.round(F.element_at("embedding", 1).cast("double"), 6).alias("first"))


@query()
def spectral_rolloff(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", signal.rolloff(24000, 0.95, 32)("embedding").alias("rolloff"))


@query()
def hf_ratio(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", signal.high_energy(24000, 8000.0, 32)("embedding").alias("hf"))


@query()
def comb_peak(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", signal.comb_peak(1000, 1.0, 8.0, 16)("embedding").alias("comb"))
