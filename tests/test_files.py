"""Readers, writers and the stream, round trip."""

import io
import tarfile

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import files
from corpusloom.streaming import budget


def test_manifest_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([("u1", 0, "en", 1.5), ("u2", 1, "ur", None)], "utt string, spk int, lang string, dur_raw double").write.json(path)
    df = files.read_manifest(spark, path)
    files.write_manifest(df.withColumn("dur", F.col("dur_raw") * 2), path)
    assert sorted((r["utt"], r["dur"]) for r in files.read_manifest(spark, path).collect()) == [("u1", 3.0), ("u2", None)]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "x.json").write_text("\n")
    with pytest.raises(ValueError, match="no rows"):
        files.read_manifest(spark, str(tmp_path / "e"))


def test_lexicon_round_trip(spark, tmp_path):
    src = tmp_path / "lex.tsv"
    src.write_text("# head\nb\tp2\tgold\tx;y\n\na\tp1\nbad\n", encoding="utf-8")
    df = files.read_lexicon(spark, str(src))
    assert sorted((r["word"], r["pron"], r["source"], r["variants"]) for r in df.collect()) == [("a", "p1", "wikipron", []), ("b", "p2", "gold", ["x", "y"])]
    out = tmp_path / "out"
    files.write_lexicon(df, str(out), "made here\ntwice")
    (part,) = out.glob("part-*")
    assert part.read_text().split("\n") == ["# made here", "# twice", "a\tp1\twikipron\t", "b\tp2\tgold\tx;y", ""]


def test_lists_refuse_separators(spark, tmp_path):
    df = spark.createDataFrame([("a.wav", "p q", 1)], "wav string, phonemes string, spk int")
    files.write_list(df, str(tmp_path / "l"), ["wav", "phonemes", "spk"])
    assert [tuple(r) for r in files.read_list(spark, str(tmp_path / "l"), ["wav", "phonemes", "spk"]).collect()] == [("a.wav", "p q", "1")]
    with pytest.raises(Exception, match="separator"):
        files.write_list(df.withColumn("phonemes", F.lit("a|b")), str(tmp_path / "m"), ["wav", "phonemes"])


def test_cache_last_row_wins(spark, tmp_path):
    path = tmp_path / "c"
    path.mkdir()
    (path / "a.json").write_text('{"w": "x", "p": "1"}\n{broken\n{"w": "x", "p": "2"}\n{"w": "y", "p": "3"}\n')
    assert {r["w"]: r["p"] for r in files.read_cache(spark, str(path)).collect()} == {"x": "2", "y": "3"}


def test_tar_join_and_wav(spark, tmp_path):
    wav = spark.createDataFrame([([0.0, 0.5, -2.0],)], "s array<float>").select(files.to_wav(F.col("s")).alias("w")).first()[0]
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        for name in ("dir/one.wav", "dir/two.wav"):
            info = tarfile.TarInfo(name)
            info.size = len(wav)
            t.addfile(info, io.BytesIO(bytes(wav)))
    (tmp_path / "t.tsv").write_text("x/one.wav\told\tz\none.wav\tnew\tz\nshort.wav\tno\n")
    rows = files.tar_with_transcripts(spark, str(tmp_path / "a.tar.gz"), str(tmp_path / "t.tsv")).withColumn("d", files.from_wav(F.col("content"))).collect()
    assert [(r["file"], r["text"], r["d"]["rate"]) for r in rows] == [("one.wav", "new", 24000)]
    assert [round(x, 2) for x in rows[0]["d"]["samples"]] == [0.0, 0.5, -1.0]


def test_archives_written_and_read_in_order(spark, tmp_path):
    rows = [("b", "z.wav", b"3"), ("a", "y.wav", b"2"), ("a", "n.txt", b""), ("a", "x.wav", None), ("b", "m.wav", b"4" * 70_000)]
    packed = files.pack_tar(spark.createDataFrame(rows, "a string, m string, c binary"), "a", "m", "c")
    for _ in range(2):  # a task that runs again leaves the same files
        files.write_files(packed.withColumn("name", F.concat("a", F.lit("/"), "part", F.lit(".tar"))), str(tmp_path / "t"), "name", "content")
    assert sorted(str(x.relative_to(tmp_path / "t")) for x in (tmp_path / "t").rglob("*") if x.is_file()) == ["a/0.tar", "b/0.tar"]
    got = files.read_tar_members(spark, str(tmp_path / "t" / "*"), ".wav").orderBy("archive", "pos").collect()
    assert [(r["member"], r["pos"], len(r["content"])) for r in got] == [("x.wav", 1, 0), ("y.wav", 2, 1), ("m.wav", 0, 70_000), ("z.wav", 1, 1)]
    (tmp_path / "l.tsv").write_text("".join(f"{m}\t{m[0]}\tx\n" for _, m, _ in rows))
    few = files.tar_with_transcripts(spark, str(tmp_path / "t" / "*"), str(tmp_path / "l.tsv"), limit=3).collect()
    assert sorted(r["text"] for r in few) == ["m", "x", "y"]


def test_cache_newest_file_wins(spark, tmp_path):
    for i in range(3):
        files.append_cache(spark.createDataFrame([("k", str(i))], "w string, p string"), str(tmp_path / "c"))
    assert [r["p"] for r in files.read_cache(spark, str(tmp_path / "c")).collect()] == ["2"]


def test_log_and_small_readers(spark, tmp_path):
    (tmp_path / "log").write_text("Mel Loss: 3.5, x\nSaving..\nMel Loss: 1.5 Mel Loss: bad\nSaving..\n")
    got = {r["name"]: (r["first"], r["last"], r["n"]) for r in files.parse_log(spark, str(tmp_path / "log"), {"mel": r"Mel Loss: ([\d.]+)"}, ["Saving.."]).collect()}
    assert got == {"mel": (3.5, 1.5, 2), "Saving..": (None, None, 2)}
    (tmp_path / "lines").write_text("# no\n\n a \nb\n")
    assert [r["line"] for r in files.read_lines(spark, str(tmp_path / "lines")).collect()] == ["a", "b"]
    (tmp_path / "q.csv").write_text("resource,used,total\nGPU,12.5h,30h\nTPU,1h,x\n")
    assert [tuple(r) for r in files.read_quota(spark, str(tmp_path / "q.csv"), "gpu").collect()] == [("GPU", 12.5, 30.0)]
    page = files.listening_page(spark.createDataFrame([(1, "a<b", "v1", "x.wav"), (0, "a<b", "v0", "y.wav")], "seq int, t string, l string, s string"), "t", "l", "s", "seq").first()
    assert page["first_seen"] == 0 and "a&lt;b" in page["html"] and page["html"].index("y.wav") < page["html"].index("x.wav")
    assert "| n |" in files.markdown(spark.range(1).select(F.lit(1).alias("n")), "t")


def test_stream_budget_continues(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "k string, seq int, v double"
    for rows in ([("a", 0, 3.0), ("a", 1, 3.0), ("b", 0, 9.0)], [("a", 2, 3.0), ("a", 3, 3.0), ("b", 1, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        budget.run_available(budget.admit_stream(spark.readStream.schema(schema).parquet(src), "k", "seq", "v", 7.0), out, ck)
    assert sorted((r["k"], r["seq"]) for r in spark.read.parquet(out).collect()) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
