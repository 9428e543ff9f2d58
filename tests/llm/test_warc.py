"""Archives of others: any number of records in a gzip member, cut files, large files in parts."""

import gzip

import pytest

from corpusloom.llm import warc


def records(n, size=20):
    return [warc.record("response" if i % 3 else "warcinfo", f"urn:page:{i}", "d", [("WARC-Target-URI", f"t{i}")], "text/plain", b"block %d\r\n\r\n" % i + bytes([65 + i % 26]) * size) for i in range(n)]


def read(spark, path, **options):
    warc.register(spark)
    return spark.read.format("warc").options(**options).load(str(path))


@pytest.mark.parametrize("per_member", [1, 2, 7, 1000])
def test_members_of_any_number_of_records(spark, tmp_path, per_member):
    rs = records(50, 3000)
    data = b"".join(gzip.compress(b"".join(rs[i : i + per_member])) for i in range(0, 50, per_member))
    (tmp_path / "x.warc.gz").write_bytes(data)
    got = {r["record_id"]: r["payload"] for r in read(spark, tmp_path).collect()}
    assert len(got) == 50 and all(got[f"urn:page:{i}"].startswith(b"block %d\r\n" % i) for i in range(50))
    some = read(spark, tmp_path).filter("record_type = 'warcinfo'").collect()
    assert {r["record_id"] for r in some} == {f"urn:page:{i}" for i in range(0, 50, 3)}
    assert read(spark, tmp_path, payload="none").count() == 50


def test_records_over_several_members(spark, tmp_path):
    """Members that end in the middle of records."""
    data = b"".join(records(20, 500))
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(data[i : i + 777]) for i in range(0, len(data), 777)))
    assert read(spark, tmp_path).count() == 20 and read(spark, tmp_path).filter("record_type = 'response'").count() == 13


@pytest.mark.parametrize("name", ["x.warc", "x.warc.gz", "own.warc.gz"])
@pytest.mark.parametrize("cut", [1, 30, 300, 2500])
def test_what_is_cut_off_is_an_error(spark, tmp_path, name, cut):
    rs = records(4, 2000)
    whole = {"x.warc": b"".join(rs), "x.warc.gz": gzip.compress(b"".join(rs), 0), "own.warc.gz": b"".join(warc.member(r, 0) for r in rs)}[name]
    (tmp_path / name).write_bytes(whole)
    assert read(spark, tmp_path).count() == 4
    if name == "x.warc" and cut == 1:
        return  # part of the empty lines behind the last record
    (tmp_path / name).write_bytes(whole[:-cut])
    for df in (read(spark, tmp_path), read(spark, tmp_path).filter("record_type = 'response'"), read(spark, tmp_path).filter("record_id = '<none>'")):
        with pytest.raises(Exception, match="cut off|shorter than it says"):
            df.collect()


def test_no_record_is_an_error(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(records(1)[0] + b"something else\r\n\r\n")
    with pytest.raises(Exception, match="no record"):
        read(spark, tmp_path).collect()


def test_large_files_in_parts(spark, tmp_path):
    """Members written here, one of which holds an archive of such members uncompressed, read by many tasks."""
    rs = records(300, 900)
    inner = b"".join(warc.member(r) for r in records(5, 300))
    rs[150] = warc.record("response", "urn:page:150", "d", [], "application/octet-stream", inner)
    (tmp_path / "x.warc.gz").write_bytes(b"".join(warc.member(r, 0) for r in rs))
    df = read(spark, tmp_path, partition_bytes="20000")
    assert df.rdd.getNumPartitions() > 10
    got = [r["record_id"] for r in df.collect()]
    assert sorted(got) == sorted(f"urn:page:{i}" for i in range(300))
    with warc.open_fs(str(tmp_path))[0].open_input_file(str(tmp_path / "x.warc.gz")) as f:
        size, at = f.size(), sum(len(warc.member(r, 0)) for r in rs[:150])
        assert warc.first_member(f, at, size) == at and warc.first_member(f, at + 1, size) == at + len(warc.member(rs[150], 0))
    assert df.filter("target_uri = 't299'").count() == 1
