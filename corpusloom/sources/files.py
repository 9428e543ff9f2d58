"""Readers and writers for the file formats of a corpus: manifests, lexicons, lists, logs, archives, reports."""

from __future__ import annotations

import io
import json
import tarfile
import uuid
import wave
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import phones
from ..functions.text import URDU_LETTERS, normalize_chars, strip_diacritics
from ..operators import lexicon
from .shards import open_fs

#: Members of one tar archive.
TAR_MEMBERS = 256
#: Bytes that a reader of archives gathers before it hands rows on.
BATCH_BYTES = 16 << 20

MANIFEST = (
    "utt string, raw string, wav string, spk int, lang string, source string, style string, gender string, emotional boolean, "
    "text_raw string, text string, dur_raw double, dur double, asr_cer double, asr_hyp string, phonemes string"
)


def first_of(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def place(latest: bool = False) -> Column:
    """The place of a line in its files, to order by: file, block, line. With ``latest`` files go by their time first."""
    parts = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")]
    return F.struct(*([F.col("_metadata.file_modification_time").alias("time")] if latest else []), *parts)


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def read_manifest(spark: SparkSession, path: str, schema: str = MANIFEST, require: bool = True) -> DataFrame:
    """JSON lines under an explicit schema; blank lines are skipped. With ``require`` an empty manifest is an error."""
    df = spark.read.schema(schema).json(path)
    if require and df.isEmpty():
        raise ValueError(f"{path} has no rows")
    return df


def write_manifest(df: DataFrame, path: str) -> None:
    """JSON lines, swapped into place when complete, so that a manifest may be rewritten from itself."""
    spark, stage = df.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.json(stage)
    jvm = spark._jvm
    new, old = jvm.org.apache.hadoop.fs.Path(stage), jvm.org.apache.hadoop.fs.Path(path)
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"{stage} could not be moved to {path}")


def read_json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_cache(spark: SparkSession, path: str, schema: str = "w string, p string") -> DataFrame:
    """An append-only cache of JSON lines; malformed rows are dropped, of equal keys the newest file's last row wins."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).select("*", place(latest=True).alias("__at"))
    return rows.filter(F.col("w").isNotNull()).groupBy("w").agg(F.max_by("p", "__at").alias("p"))


def append_cache(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_lines(spark: SparkSession, path: str, comment: str | None = "#") -> DataFrame:
    """(line) without blank lines and comments, trimmed."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")
    return lines if comment is None else lines.filter(~F.col("line").startswith(comment))


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str], least: int | None = None) -> DataFrame:
    """Tab-separated lines as strings, no quoting; comments, blank lines and lines of fewer than ``least`` fields are
    skipped; missing fields are null. ``seq`` follows the order of files by name and of their lines."""
    rows = spark.read.text(path).select(F.col("value"), place().alias("seq"))
    rows = rows.filter((F.trim("value") != "") & ~F.col("value").startswith("#")).withColumn("f", F.split("value", "\t"))
    rows = rows.filter(F.size("f") >= (least or 1))
    return rows.select("seq", *[F.try_element_at("f", F.lit(i + 1)).alias(c) for i, c in enumerate(columns)])


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(seq, word, pron, source, variants): lines of at least two fields; the default source is ``wikipron``. Words are
    normalised, pronunciations and variants brought into the canonical phone set."""
    rows = read_tsv(spark, path, ["word", "pron", "source", "variants"], least=2)
    variants = F.split(phones.canonical(F.trim(F.coalesce("variants", F.lit("")))), r"\s*;\s*")
    word, pron = normalize_chars(F.trim("word")), phones.canonical(F.trim("pron"))
    return rows.select("seq", word.alias("word"), pron.alias("pron"), first_of(F.trim("source"), F.lit("wikipron")).alias("source"), F.filter(variants, lambda v: v != "").alias("variants"))


def read_words(spark: SparkSession, path: str, top: int | None = None) -> DataFrame:
    """(seq, word): the first fields of lines that are Urdu words of at least two letters, normalised, the first ``top``."""
    lines = spark.read.text(path).select(place().alias("seq"), normalize_chars(F.trim(F.substring_index("value", "\t", 1))).alias("word"))
    bare = strip_diacritics(F.col("word"))
    words = lines.filter(bare.rlike(f"^[{URDU_LETTERS}]{{2,}}$"))
    return words if not top else words.orderBy("seq").limit(top)


def load_lexicon(spark: SparkSession, base: str, extras: Sequence[str] = ()) -> DataFrame:
    """(word, pron, source, variants) of a base file and further ones, one after the other, merged by rank."""
    parts = [read_lexicon(spark, path).withColumn("seq", F.struct(F.lit(i).alias("list"), F.col("seq").alias("at"))) for i, path in enumerate([base, *extras])]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return lexicon.merge(rows).select("word", "pron", "source", "variants")


def write_lexicon(df: DataFrame, path: str, header: str = "") -> None:
    """One sorted file of word, pronunciation, source, variants, with a commented header. A lexicon is small."""
    line = F.concat_ws("\t", "word", "pron", "source", F.array_join("variants", ";"))
    rows = df.select(F.lit(1).alias("__part"), F.col("word").alias("__key"), line.alias("value"))
    if header:
        top = [(0, f"{i:06d}", f"# {h}") for i, h in enumerate(header.rstrip("\n").split("\n"))]
        rows = df.sparkSession.createDataFrame(top, rows.schema).unionByName(rows)
    rows.coalesce(1).sortWithinPartitions("__part", "__key").select("value").write.mode("overwrite").text(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(seq, word, pron): pairs to learn from, as they stand but for white space at the ends, phones canonical without spaces."""
    rows = read_tsv(spark, path, ["word", "pron"], least=2)
    return rows.select("seq", F.trim("word").alias("word"), phones.canonical(F.replace("pron", F.lit(" "), F.lit(""))).alias("pron"))


def read_wikipron(spark: SparkSession, path: str) -> DataFrame:
    """(word, prons): pronunciations in the order of lines, words normalised, of at least two characters."""
    rows = read_tsv(spark, path, ["word", "pron"], least=2).withColumn("word", normalize_chars(F.col("word"))).filter(F.char_length("word") >= 2)
    one = F.sort_array(F.collect_list(F.struct("seq", "pron")))
    return rows.groupBy("word").agg(F.transform(one, lambda x: x["pron"]).alias("prons"))


def write_list(df: DataFrame, path: str, columns: Sequence[str], separator: str = "|") -> None:
    """Delimited lines without header or escapes; a separator or line end inside a field is an error."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.coalesce(F.col(c).cast("string").rlike(r"[\n\r" + "\\" + separator + "]"), F.lit(False))
    line = F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    checked = F.when(bad, F.raise_error(F.concat(F.lit("a field holds a separator: "), line))).otherwise(line)
    df.select(checked.alias("value")).write.mode("overwrite").text(path)


def write_shards(shards: DataFrame, path: str, line: str, epoch: int) -> None:
    """Lines of (pos, shard, line) in order of ``pos``, a folder for each shard of an epoch."""
    rows = shards.select(F.lit(epoch).alias("epoch"), "shard", "pos", F.col(line).alias("value")).repartition("shard").sortWithinPartitions("shard", "pos")
    rows.select("epoch", "shard", "value").write.partitionBy("epoch", "shard").mode("overwrite").option("maxRecordsPerFile", 0).text(path)


def append_log(lines: DataFrame, path: str) -> None:
    """One column of text, appended to the lines that are there."""
    lines.write.mode("append").text(path)


def read_list(spark: SparkSession, path: str, columns: Sequence[str], separator: str = "|") -> DataFrame:
    fields = F.split("value", "\\" + separator)
    return spark.read.text(path).filter("trim(value) <> ''").select(*[F.try_element_at(fields, F.lit(i + 1)).alias(c) for i, c in enumerate(columns)])


def read_quota(spark: SparkSession, path: str, resource: str) -> DataFrame:
    """(resource, used, total) in hours from a CSV with values such as ``12.5h``; the resource is matched without case."""
    hours = lambda c: F.regexp_replace(F.trim(c), "[hH]$", "").try_cast("double")
    rows = spark.read.option("header", True).csv(path)
    names = rows.columns
    return rows.filter(F.lower(F.trim(names[0])) == resource.lower()).select(F.col(names[0]).alias("resource"), hours(names[1]).alias("used"), hours(names[2]).alias("total"))


def basename(path: Column) -> Column:
    """The last part of a path with either kind of slash."""
    return F.regexp_extract(path, r"[^\\/]+$", 0)


def read_media(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """(speaker, file, path, length, content): files under a folder per speaker; content is read only where it is used."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -2).alias("speaker"), F.element_at(parts, -1).alias("file"), "path", "length", "content")


def read_tar_members(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(archive, pos, member, content) of tar archives, compressed or not, ``pos`` the place in the archive.

    Archives are read as streams, so that one may be larger than memory; an archive is read by one task. Arrow opens
    the paths, on any file system that it knows.
    """
    schema = pa.schema([("archive", pa.string()), ("pos", pa.int64()), ("member", pa.string()), ("content", pa.binary())])

    def members(name: str) -> Iterator[tuple]:
        fs, at = open_fs(name)
        with fs.open_input_stream(at, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
            for pos, m in enumerate(tar):
                if m.isfile() and m.name.endswith(suffix):
                    yield name, pos, m.name, tar.extractfile(m).read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                for row in members(name):
                    rows.append(row)
                    size += len(row[3])
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    names = spark.read.format("binaryFile").load(path).select("path")  # the listing alone: no content is read
    return names.mapInArrow(run, "archive string, pos long, member string, content binary")


def write_files(df: DataFrame, path: str, name: str, content: str) -> None:
    """Each row's ``content`` as a file ``name`` below ``path``; a file appears when it is complete, and a task that
    runs again writes the same files again. Names are unique."""
    path = path.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(path)
        for batch in batches:
            done = []
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = f"{base}/{file}"
                folder, _, last = at.rpartition("/")
                fs.create_dir(folder, recursive=True)
                stage = f"{folder}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(stage, compression=None) as out:
                    out.write(data or b"")
                fs.move(stage, at)
                done.append(last)
            yield pa.RecordBatch.from_pydict({"file": pa.array(done, pa.string())})

    df.select(F.col(name).cast("string"), F.col(content).cast("binary")).mapInArrow(run, "file string").write.format("noop").mode("overwrite").save()


def tar_with_transcripts(spark: SparkSession, archives: str, transcripts: str, limit: int | None = None, suffix: str = ".wav") -> DataFrame:
    """(file, text, content): members of archives with their transcripts, joined by file name.

    Transcripts are lines of at least three fields, the file first, the text second; of a file that comes twice the
    last line counts. With ``limit`` the first members in the order of archives and of their members.
    """
    lines = read_tsv(spark, transcripts, ["file", "text"], least=3)
    last = lines.groupBy(basename(F.col("file")).alias("file")).agg(F.max_by("text", "seq").alias("text"))
    out = read_tar_members(spark, archives, suffix).select(basename(F.col("member")).alias("file"), "archive", "pos", "content").join(last, "file")
    return (out.orderBy("archive", "pos").limit(limit) if limit is not None else out).select("file", "text", "content")


def parse_log(spark: SparkSession, path: str, values: dict[str, str], markers: Sequence[str] = ()) -> DataFrame:
    """(name, first, last, mean, n) of numbers in a log: ``values`` maps names to patterns with one group; ``markers``
    are counted as plain words."""
    lines = spark.read.text(path).select("value", place().alias("at"))
    found = None
    for name, pattern in values.items():
        part = lines.select("at", F.lit(name).alias("name"), F.posexplode(F.regexp_extract_all("value", F.lit(pattern), F.lit(1))).alias("k", "raw")).select("name", F.struct("at", "k").alias("o"), F.col("raw").try_cast("double").alias("v"))
        found = part if found is None else found.unionByName(part)
    stats = found.groupBy("name").agg(F.min_by("v", "o").alias("first"), F.max_by("v", "o").alias("last"), F.avg("v").alias("mean"), F.count("v").alias("n"))
    for m in markers:
        n = lines.select(F.sum(F.regexp_count("value", F.lit(r"\Q" + m + r"\E"))).alias("n"))
        none = F.lit(None).cast("double")
        stats = stats.unionByName(n.select(F.lit(m).alias("name"), none.alias("first"), none.alias("last"), none.alias("mean"), F.coalesce("n", F.lit(0)).alias("n")))
    return stats


def to_wav(samples: Column, rate: int = 24_000) -> Column:
    """Mono 16-bit PCM files as binary, samples clipped to one."""
    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        def one(y) -> bytes | None:
            if y is None:
                return None
            out = io.BytesIO()
            with wave.open(out, "wb") as w:
                w.setnchannels(1)
                w.setsampwidth(2)
                w.setframerate(rate)
                w.writeframes((np.clip(np.asarray(y, float), -1, 1) * 32767).astype("<i2").tobytes())
            return out.getvalue()

        return s.map(one)

    return run(samples)


def from_wav(content: Column) -> Column:
    """(rate, samples) of 16-bit PCM files, channels averaged; null where the file can't be decoded."""
    @F.pandas_udf("rate int, samples array<float>")
    def run(s: pd.Series) -> pd.DataFrame:
        def one(data) -> tuple:
            try:
                with wave.open(io.BytesIO(data)) as w:
                    y = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels()).mean(axis=1) / 32767
                    return w.getframerate(), y.astype(np.float32)
            except Exception:  # a broken file is a row without samples, counted by its drop reason
                return None, None

        return pd.DataFrame([one(x) for x in s], columns=["rate", "samples"])

    return run(content)


#: Rows of what is written as one document.
MOST_REPORTED = 10_000


def _few(df: DataFrame) -> list:
    rows = df.limit(MOST_REPORTED + 1).collect()
    if len(rows) > MOST_REPORTED:
        raise ValueError(f"more than {MOST_REPORTED} rows for one document")
    return rows


def write_json_document(df: DataFrame, path: str) -> None:
    """All rows as one indented JSON array; for reports."""
    rows = [json.loads(x) for x in (r["j"] for r in _few(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j"))))]
    text = json.dumps(rows, ensure_ascii=False, indent=2)
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_review(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str]) -> None:
    """Tab-separated lines under a header for people to look through, in order, in one file; for samples. Tabs and line
    ends in a field become spaces."""
    fields = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\t\r\n]", " ") for c in columns]
    lines = [r["value"] for r in _few(df.orderBy(*order).select(F.concat_ws("\t", *fields).alias("value")))]
    df.sparkSession.createDataFrame([("\n".join(["\t".join(columns), *lines]),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def pack_tar(df: DataFrame, archive: str, member: str, content: str) -> DataFrame:
    """(archive, part, content): tar archives of the members of each archive, in parts of at most TAR_MEMBERS members."""
    one = F.struct(F.col(member).alias("m"), F.col(content).alias("c"))
    rows = df.withColumn("__part", F.floor((F.row_number().over(Window.partitionBy(archive).orderBy(member)) - 1) / TAR_MEMBERS).cast("int"))
    rows = rows.groupBy(archive, F.col("__part").alias("part")).agg(F.sort_array(F.collect_list(one)).alias("members"))

    @F.pandas_udf("binary")
    def pack(members: pd.Series) -> pd.Series:
        def one_archive(items) -> bytes:
            out = io.BytesIO()
            with tarfile.open(fileobj=out, mode="w") as tar:
                for x in items:
                    info = tarfile.TarInfo(x["m"])
                    info.size = len(x["c"] or b"")
                    tar.addfile(info, io.BytesIO(x["c"] or b""))
            return out.getvalue()

        return members.map(one_archive)

    return rows.select(archive, "part", pack("members").alias("content"))


def markdown(df: DataFrame, title: str) -> str:
    """A small result as a Markdown table; more than ``MOST_REPORTED`` rows are an error."""
    rows = _few(df)
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)]) + "\n"


def listening_page(df: DataFrame, group: str, label: str, src: str, seq: str) -> DataFrame:
    """(first_seen, html): one section per distinct text in the order of first appearance, its takes in order, escaped."""
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    one = F.struct(seq, F.concat(F.lit("<p>"), esc(F.col(label)), F.lit(' <audio controls src="'), esc(F.col(src)), F.lit('"></audio></p>')).alias("p"))
    rows = df.groupBy(group).agg(F.min(seq).alias("first_seen"), F.sort_array(F.collect_list(one)).alias("__takes"))
    return rows.select("first_seen", F.concat(F.lit("<section><h2>"), esc(F.col(group)), F.lit("</h2>"), F.array_join(F.transform("__takes", lambda x: x["p"]), ""), F.lit("</section>")).alias("html"))


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def move_all(spark: SparkSession, source: str, target: str, prefix: str = "") -> None:
    """Moves the files of a folder, but what begins with ``_`` or ``.``, to another one, each name behind ``prefix``."""
    fs, src = _hadoop(spark, source)
    fs.mkdirs(_hadoop(spark, target)[1])
    for s in fs.listStatus(src):
        name = s.getPath().getName()
        if name[0] not in "_.":
            fs.rename(s.getPath(), _hadoop(spark, f"{target}/{prefix}{name}")[1])


def tails(spark: SparkSession, path: str, most: int = 400_000, glob: str = "*") -> DataFrame:
    """(path, length, text): the last ``most`` characters of every file under ``path``, and its bytes in all.

    Only the end of a file is read; bytes at the cut that are part of a character are left out. A line that is cut
    stays as it is; an empty file has no row.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, at = open_fs(name)
                with fs.open_input_file(at) as f:
                    f.seek(max(0, length - 4 * most))  # a character has four bytes at most
                    data = f.read()
                while length > 4 * most and data and data[0] & 0xC0 == 0x80:
                    data = data[1:]
                yield pa.RecordBatch.from_pydict({"path": [name], "length": [length], "text": [data.decode("utf-8", "replace")[-most:]]})

    return listed.mapInArrow(run, "path string, length long, text string")
