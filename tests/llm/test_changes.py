"""The change applier against a plain fold."""

import collections
import datetime
import math
import zlib

import pytest

from corpusloom.llm import changes, queries


def plain(rows, batches=12):
    rows = list({tuple(r.asDict().values()): r for r in rows}.values())
    seqs = collections.defaultdict(set)
    for r in rows:
        seqs[r.client_id].add(r.seq)
    rank = {c: {s: i + 1 for i, s in enumerate(sorted(v, key=lambda s: (s is not None, s or 0)))} for c, v in seqs.items()}
    by = collections.defaultdict(list)
    for r in rows:
        h = zlib.crc32(str(r.change_id).encode()) if r.change_id is not None else 0
        if r.valid_at is None or h % 11 == 0:
            continue
        day = (r.valid_at - datetime.datetime(1970, 1, 1)).days + 9 * (h % 4)
        by[max(1, min(batches, 1 + (day - 19723) * batches // 160))].append((day, r.change_id, rank[r.client_id][r.seq], r))
    state = collections.defaultdict(lambda: {"next": 1, "held": {}, "city": None, "balance": None})
    out, horizon = [], None
    for b in range(1, batches + 2):
        def drain(c, s, missed=0):
            while s["next"] in s["held"]:
                _, r = s["held"].pop(s["next"])
                if r.op == "I":
                    s["city"], s["balance"] = r.city, r.balance
                elif r.op == "U":
                    s["city"] = s["city"] if r.city is None else r.city
                    s["balance"] = s["balance"] if r.balance is None else r.balance
                elif r.op == "D":
                    s["city"] = s["balance"] = None
                s["next"] += 1
                cents = None if s["balance"] is None else math.floor(100 * s["balance"] + 0.5)
                s["last"] = len(out)
                out.append([r.change_id, c, "applied", b, missed, s["city"], cents, False, r.op])
                missed = 0

        for c, s in state.items():
            while s["held"] and (b > batches or horizon is not None and min(d for d, _ in s["held"].values()) + 3 <= horizon):
                low = min(s["held"])
                missed, s["next"] = low - s["next"], low
                drain(c, s, missed)
        for day, change_id, n, r in sorted(by[b], key=lambda x: (x[0], x[1], x[3].op or "", x[3].city or "", str(x[3].balance))):
            s = state[r.client_id]
            if n < s["next"] or n in s["held"]:
                out.append([change_id, r.client_id, "rejected", b, 0, None, None, False, r.op])
            else:
                s["held"][n] = (day, r)
                drain(r.client_id, s)
        horizon = max([x[0] for x in by[b]] + ([horizon] if horizon is not None else []), default=None)
    for s in state.values():
        if "last" in s and out[s["last"]][8] != "D":
            out[s["last"]][7] = True
    return sorted((tuple(x[:8]) for x in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/client_changes.parquet").collect()
    out = got(queries.op12_change_applier(spark, sf))
    assert out == plain(rows)
    assert any(r[4] > 0 for r in out) and any(r[3] == 13 for r in out) and any(r[2] == "rejected" for r in out)


@pytest.fixture
def frame(spark):
    def make(rows):
        return spark.createDataFrame(rows, "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double, n long, lane int")

    return make


def test_odd_rows(spark, frame, monkeypatch):
    """Null clients, numbers, cities and ops; repeats; a client with more waiting rows than fit its value; empty batches."""
    t = lambda d: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d)
    rows = [(i, 5, i if i else -1, "IUUD"[i % 4], t(i % 40), "s", None, f"c{i}" if i % 3 else None, i + 0.005 if i % 5 else None, 1, 2) for i in range(900)]
    rows += [(2000 + i, None, i, "U", t(i), "s", "x", "town", -1.5, 1, 2) for i in range(30)] + [(3000 + i, 7, None, None, t(150), None, None, None, None, 1, 2) for i in range(5)]
    rows += rows[:50] + [(i + 10_000, 5, i, "I", t(i % 50), "s", None, "again", 0.0, 1, 2) for i in range(300)] + [(4000, 9, 1, "I", None, "s", "x", "y", 1.0, 1, 2), (None, 9, 2, "I", t(1), "s", "x", "y", 1.0, 1, 2)]
    rows += [(5000 + i, 11, i, "I", t(0) - datetime.timedelta(days=100), "s", "x", "early", 1.0, 1, 2) for i in range(4)]
    df = frame(rows)
    seen = []
    out = changes.apply_changes(df, after_start=seen.append)
    out = out.select("change_id", "client_id", "status", "batch", "missed", "city", changes.cents(out["balance"]).alias("cents"), "current")
    assert got(out) == plain(df.collect()) and seen == list(range(1, 14))


def test_empty(frame):
    assert changes.apply_changes(frame([]), batches=2).count() == 0


def test_stores_close_with_their_task(spark, sf):
    key, seen = "spark.sql.streaming.stateStore.unloadOnCommit", []
    before = spark.conf.get(key)
    rows = spark.read.parquet(f"{sf}/client_changes.parquet").limit(50)
    changes.apply_changes(rows, 1, lambda batch: seen.append(spark.conf.get(key)))
    assert seen == ["true", "true"] and spark.conf.get(key) == before


def test_files_of_checkpoint(spark, sf):
    """One file for each change of a store, in a folder of this machine renamed without programs of the system; settings come back."""
    keys = ["spark.sql.streaming.checkpoint.fileChecksum.enabled", "spark.sql.streaming.checkpointFileManagerClass"]
    seen, before = [], [spark.conf.get(k, None) for k in keys]
    rows = spark.read.parquet(f"{sf}/client_changes.parquet").limit(50)
    changes.apply_changes(rows, 1, lambda batch: seen.append([spark.conf.get(k) for k in keys]))
    assert [x[0] for x in seen] == ["false", "false"] and all(x[1].endswith(".FileSystemBasedCheckpointFileManager") for x in seen)
    assert [spark.conf.get(k, None) for k in keys] == before
