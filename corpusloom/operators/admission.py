"""What is let in and what is refused: clips, lines, data sets, versions, variants, steps, issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import ARABIC_SCRIPT, has_arabic_script
from .ordering import shuffle_key

# --- fixed values ---
READ_SECONDS, SPOKEN_SECONDS, AUDIT_SECONDS, STYLE_FRAMES = (2.0, 15.0), (1.5, 20.0), 0.5, 80
LINE_LENGTHS = (30, 160)
LEAST_LINES, MOST_ARTICLES, SAMPLED = 500, 40_001, 3
STATES = ["running", "queued", "complete", "error", "cancel"]
SPECIAL_DEVICE, SPECIAL_MARK = "NvidiaL4", "L4"
LIGHT = ["appendixA_cer", "mixed_pcer_pakistani", "english_wer_native", "dnsmos", "gates"]
VERSION = "1.0"
# --- end of fixed values ---


def read_clip(seconds: Column, said: Column) -> Column:
    """Whether a clip of read English is taken: its length, and a text without Arabic script. Null counts as no."""
    return F.coalesce(seconds.between(*READ_SECONDS) & (F.trim(said) != "") & ~has_arabic_script(said), F.lit(False))


def spoken_clip(seconds: Column, said: Column) -> Column:
    """Whether a clip of free speech is taken: its length and any text. Null counts as no."""
    return F.coalesce(seconds.between(*SPOKEN_SECONDS) & (F.trim(said) != ""), F.lit(False))


def long_enough(seconds: Column) -> Column:
    """Whether a clip is long enough to be audited."""
    return F.coalesce(seconds >= AUDIT_SECONDS, F.lit(False))


def enough_frames(frames: Column) -> Column:
    """Whether a clip has frames enough for a style vector."""
    return F.coalesce(frames >= STYLE_FRAMES, F.lit(False))


def english_lines(df: DataFrame, column: str, exclude: DataFrame) -> DataFrame:
    """Rows with a trimmed text of 30 to 160 characters, without Arabic script, that ``exclude`` (texts in its column of
    the same name) does not hold. The texts are compared by their digests, so that they don't move themselves."""
    rows = df.withColumn(column, F.trim(column)).filter(F.char_length(column).between(*LINE_LENGTHS) & ~F.col(column).rlike(ARABIC_SCRIPT))
    taken = exclude.select(F.sha2(column, 256).alias("__taken")).distinct()
    return rows.join(taken, F.sha2(column, 256) == F.col("__taken"), "left_anti")


def require_rows(df: DataFrame, least: int = LEAST_LINES, what: str = "the table") -> DataFrame:
    """``df``, or an error if it has fewer than ``least`` rows. No more than those are counted."""
    n = df.limit(least).count()
    if n < least:
        raise ValueError(f"{what} has only {n} rows, {least} are needed")
    return df


def validity(lists: DataFrame, name: str, line: str, archives: DataFrame, least: int = LEAST_LINES) -> DataFrame:
    """(name, n_lines, valid): a prepared data set counts only with an archive and ``least`` lines that are not blank."""
    n = lists.groupBy(name).agg(F.count_if(F.trim(line) != "").alias("n_lines"))
    have = archives.select(F.col(name).alias("__name"), F.lit(True).alias("__have")).distinct()
    return n.join(have, F.col(name) == F.col("__name"), "left").select(name, "n_lines", (F.coalesce("__have", F.lit(False)) & (F.col("n_lines") >= least)).alias("valid"))


def steps_that_count(done: Column, have_outputs: Column) -> Column:
    """Steps done, or none of them where their outputs are gone: all is done again from the first step then."""
    return F.when(have_outputs, done).otherwise(F.slice(done, 1, 0))


def stamped(df: DataFrame, version: str = VERSION) -> DataFrame:
    """``df`` with the version of the front end that made it."""
    return df.withColumn("frontend_version", F.lit(version))


def version_warning(found: Column, version: str = VERSION) -> Column:
    """A warning where a version is stamped and is not this one; else null."""
    return F.when(F.nullif(found, F.lit("")) != version, F.concat(F.lit("made with front end "), found, F.lit(f", this one is {version}")))


def runs_on(accelerator: Column, device: Column) -> Column:
    """Whether a variant can run: one for the special accelerator needs a device of that name."""
    return F.coalesce((accelerator != SPECIAL_DEVICE) | device.contains(SPECIAL_MARK), F.lit(False))


def state_of(output: Column) -> Column:
    """The first known state that an output names, in fixed order; else ``unknown``."""
    low = F.lower(output)
    return F.coalesce(*(F.when(low.contains(s), s) for s in STATES), F.lit("unknown"))


def upserts(wanted: DataFrame, issues: DataFrame) -> DataFrame:
    """(title, body, number): an open issue with the same title gets a comment (the smallest number), else one is made
    (null number)."""
    first = issues.filter("state = 'open'").groupBy(F.col("title").alias("__t")).agg(F.min("number").alias("number"))
    return wanted.join(first, F.col("title") == F.col("__t"), "left").select("title", "body", "number", F.when(F.col("number").isNull(), "create").otherwise("comment").alias("action"))


def light(df: DataFrame, *keys: str) -> DataFrame:
    """The metrics of an evaluation after an epoch; those that it lacks are null."""
    return df.select(*keys, *[F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in LIGHT])


def nested_hours(states: Column) -> Column:
    """Hours over all histories of a map of stages, array of (seconds) each; null seconds and stages count 0."""
    each = F.transform(F.map_values(states), lambda s: F.aggregate(F.coalesce(s["history"], F.array().cast("array<struct<seconds:double>>")), F.lit(0.0), lambda a, h: a + F.coalesce(h["seconds"], F.lit(0.0))))
    return F.coalesce(F.aggregate(each, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))) / 3600, F.lit(0.0))


def best_of_sample(df: DataFrame, key: str, score: str, n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows of the highest score, the larger key on ties, among a sample of three times as many."""
    sample = df.orderBy(shuffle_key(seed, key), key).limit(SAMPLED * n)
    return sample.orderBy(F.desc(score), F.desc(key)).limit(n)


def first_articles(df: DataFrame, seq: str, most: int = MOST_ARTICLES) -> DataFrame:
    """The first ``most`` rows in order of ``seq`` (unique): only the numbers are sorted, the texts stay where they are."""
    last = df.select(seq).orderBy(seq).limit(most).agg(F.max(seq).alias("__last"))
    return df.join(F.broadcast(last), F.col(seq) <= F.col("__last")).drop("__last")


def with_candidates(words: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every word with its candidate, null where there is none; of several for a word the first by ``seq`` counts."""
    first = candidates.groupBy(F.col("word").alias("__w")).agg(F.min_by("cand", "seq").alias("cand"))
    return words.join(first, F.col("word") == F.col("__w"), "left").drop("__w")


# --- fixed values: what a sentence of one script may not hold ---
SIGNS_REFUSED = r"[\[\](){}<>|/=\\*_#]"
# --- end of fixed values ---


def plain_sentence(sentence: Column, ends: str = "۔؟!", least: int = 20, most: int = 200, latin: bool = False) -> Column:
    """Of fitting length, without signs of markup, closed by one of ``ends``, and without Latin letters unless ``latin``."""
    s = sentence
    ok = F.char_length(s).between(least, most) & ~s.rlike(SIGNS_REFUSED) & s.rlike(f"[{ends}]$")
    return F.coalesce(ok if latin else ok & ~s.rlike("[A-Za-z]"), F.lit(False))


# --- guards that are checked in the pass that does the work ---


def edited(df: DataFrame, text: str, edits: DataFrame, key: str = "text", value: str = "edited", as_: str = "spoken") -> DataFrame:
    """``df`` with ``as_``: the edit of its text, or the text itself. An edit whose key no row has is an error that names it,
    raised by the job that computes the rows; so is one that is null or empty."""
    e = edits.select(F.col(key).alias("__key"), F.col(value).alias("__value"), F.lit(True).alias("__edit"))
    rows = df.withColumn("__row", F.lit(True)).join(e, F.col(text).eqNullSafe(F.col("__key")), "full_outer")
    fault = F.when(F.col("__row").isNull(), F.concat(F.lit("no row has the text of the edit: "), F.coalesce("__key", F.lit("null"))))
    fault = fault.when(F.col("__edit") & (F.trim(F.coalesce("__value", F.lit(""))) == ""), F.concat(F.lit("an empty edit of: "), F.coalesce("__key", F.lit("null"))))
    checked = F.when(fault.isNotNull(), F.raise_error(fault).cast("string")).otherwise(F.coalesce("__value", F.col(text)))
    return rows.withColumn(as_, checked).filter(F.col("__row") | F.col(as_).isNotNull()).drop("__row", "__key", "__value", "__edit")


class NotAdmitted(ValueError):
    """What was written does not meet its expectations."""


def write_guarded(df: DataFrame, path: str, faults: dict[str, Column], least: int = 1) -> dict[str, int]:
    """Writes ``df`` as Parquet and counts, in the same pass, its rows and those with each of ``faults``.

    Fewer than ``least`` rows, or any row with a fault, is an error once the write has ended; what was written is
    removed. Returns the counts.
    """
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(name) for name, c in faults.items()]]
    df.observe(seen, *counts).write.parquet(path)
    got = seen.get
    wrong = [f"{got[name]} rows: {name}" for name in faults if got[name]]
    if got["rows"] < least:
        wrong.append(f"{got['rows']} rows, at least {least} are needed")
    if wrong:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        raise NotAdmitted("; ".join(wrong))
    return got
