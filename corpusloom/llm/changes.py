"""Changes that carry sequence numbers, applied in order by a streaming query of two chained stateful stages.

The first stage keeps a state for each (client, n): of rows with the same number the first to arrive goes on, others
are rejected there, so that the rows of a hot client spread over all tasks. What goes on is one row a number; the
second stage keeps, for each client, the next number, the current values and the rows that wait for a gap to close.

The grouping keys are hashes of (client, n) and of the client, as many that each has about ``PER_BUCKET`` rows in all, and
the states of what falls to one key are one value, text in JSON: the Python worker sends a batch of its own for each grouping
key and asks the state store once for each value, which for keys of one row each takes most of the time.

A row that is the first of its number is rejected by the second stage only if its number lies below ``next`` as it was
when the batch began: within a batch ``next`` passes a number only by applying it. So that stage needs no order
among the rows of a batch and takes them as they come; what it holds of a client in memory is bounded, more waits in
a map state. Buckets without rows in a batch are woken by timers.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .shared import Scratch, _hadoop, positions, shared_dir, written

BATCHES = 12
#: Days that a client's earliest waiting row waits for a gap to close.
PATIENCE = 3
#: Waiting rows of a client that its state holds as one value; more go to a map state, row by row.
FEW = 200
#: Rows for each grouping key of either stage, on average over all batches; a task holds those of one key and batch.
PER_BUCKET, LEAST_BUCKETS = 1000, 64
_TICK = "#"

_IN = "batch int, client_id long, n long, day int, change_id long, op string, city string, balance double"
_MID = "repeat boolean, client_id long, n long, day int, change_id long, op string, city string, balance double"
_OUT = "client_id long, n long, change_id long, op string, status string, batch int, missed long, city string, balance double"
_WAIT = "n long, day int, change_id long, op string, city string, balance double"
_mid, _out = (Row(*[c.split()[0] for c in schema.split(", ")]) for schema in (_MID, _OUT))


class Firsts(StatefulProcessor):
    """The first row ever of each (client, n) goes on, every later one is marked as a repeat."""

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "numbers string")  # by client

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best: dict[tuple, tuple] = {}
        for r in rows:
            if r.op == _TICK:
                continue
            # ties beyond day and change_id only happen between rows of one change_id: any fixed order
            at, own = (r.client_id, r.n), ((r.day, r.change_id, r.op or "", r.city or "", str(r.balance)), r)
            before = best.get(at)
            if before is None or own[0] < before[0]:
                best[at], own = own, before
            if own is not None:
                yield _mid(True, *own[1][1:])
        if not best:
            return
        got = self.seen.get()
        seen = {(client, n) for client, numbers in json.loads(got[0]) for n in numbers} if got is not None else set()
        for at, (_, r) in best.items():
            yield _mid(at in seen, *r[1:])
        by: dict[int | None, list[int]] = {}
        for client, n in seen.union(best):
            by.setdefault(client, []).append(n)
        self.seen.update((json.dumps(list(by.items())),))

    def close(self) -> None:
        pass


class _Client:
    """What is known of a client; ``few`` are its waiting rows by number, as far as they are few."""

    __slots__ = ("balance", "begun", "city", "earliest", "few", "many", "next")

    def __init__(self, next: int = 1, city: str | None = None, balance: float | None = None, earliest: int | None = None, many: int = 0, few: list = ()):
        self.next, self.city, self.balance, self.earliest, self.many = next, city, balance, earliest, many
        self.few = {r[0]: tuple(r) for r in few}
        self.begun = next

    def row(self) -> tuple:
        return self.next, self.city, self.balance, self.earliest, self.many, list(self.few.values())


class Sequencer(StatefulProcessor):
    """Applies the rows of each client in order. ``horizon``: the largest day of all earlier batches, None before any."""

    def __init__(self, batch: int, horizon: int | None, last: bool):
        self.batch, self.horizon, self.last = batch, horizon, last

    def init(self, handle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "batch int, timer boolean, clients string")
        self.many = handle.getMapState("many", "client_id long, n long", _WAIT)  # waiting rows beyond the few

    def _take(self, client: int | None, c: _Client, n: int) -> tuple | None:
        if (row := c.few.pop(n, None)) is None and c.many and (row := self.many.getValue((client, n))) is not None:
            row = tuple(row)
            self.many.removeKey((client, n))
            c.many -= 1
        return row

    def _apply(self, client: int | None, c: _Client, row: tuple | None, missed: int) -> Iterator[Row]:
        """Applies ``row`` and all that wait right behind it."""
        while row is not None:
            n, _, change_id, op, city, balance = row
            if op in ("I", "D"):
                c.city, c.balance = (city, balance) if op == "I" else (None, None)
            elif op == "U":
                c.city, c.balance = c.city if city is None else city, c.balance if balance is None else balance
            yield _out(client, n, change_id, op, "applied", self.batch, missed, c.city, c.balance)
            c.next, missed = n + 1, 0
            row = self._take(client, c, c.next)

    def _due(self, day: int) -> bool:
        return self.last or self.horizon is not None and day + PATIENCE <= self.horizon

    def _jump(self, client: int | None, c: _Client) -> Iterator[Row]:
        """Gives up missing numbers while the earliest waiting row has waited long enough."""
        left = [(n, r[1]) for n, r in c.few.items()]
        if c.many:  # numbers and days of what waits, 16 bytes a row; rows themselves stay where they are
            left += [(k[1], v[1]) for k, v in self.many.iterator() if k[0] == client]
        left = np.array(sorted(left), np.int64)
        least = np.minimum.accumulate(left[::-1, 1])[::-1]  # the earliest day among a row and those above it
        for (n, _), day in zip(left.tolist(), least.tolist(), strict=True):
            if n < c.next:
                continue  # applied behind another
            if not self._due(day):
                break
            yield from self._apply(client, c, self._take(client, c, n), n - c.next)
        still = left[:, 0] >= c.next
        c.earliest = int(left[still, 1].min()) if still.any() else None

    def _begin(self) -> Iterator[Row]:
        """The start of a batch, once a bucket."""
        got = self.bucket.get()
        at, self.timer, clients = got if got is not None else (0, False, "[]")
        self.clients = {client: _Client(*row) for client, row in json.loads(clients)}
        if at != self.batch:
            for client, c in self.clients.items():
                if (c.few or c.many) and self._due(c.earliest):
                    yield from self._jump(client, c)
                    c.begun = c.next

    def _end(self, timers) -> None:
        if not self.timer and any(c.few or c.many for c in self.clients.values()):
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + 1)
            self.timer = True
        self.bucket.update((self.batch, self.timer, json.dumps([(client, c.row()) for client, c in self.clients.items()])))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self._begin()
        for r in rows:
            client = r.client_id
            if not r.repeat and (c := self.clients.get(client)) is None:
                c = self.clients[client] = _Client()
            if r.repeat or r.n < c.begun:
                yield _out(client, r.n, r.change_id, r.op, "rejected", self.batch, 0, None, None)
                continue
            row = (r.n, r.day, r.change_id, r.op, r.city, r.balance)
            if r.n == c.next:
                yield from self._apply(client, c, row, 0)
                if not c.few and not c.many:
                    c.earliest = None
                continue
            c.earliest = r.day if c.earliest is None else min(c.earliest, r.day)
            if len(c.few) < FEW:
                c.few[r.n] = row
            else:
                self.many.updateValue((client, r.n), row)
                c.many += 1
        self._end(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._begin()
        self.timer = False
        self._end(timerValues)

    def close(self) -> None:
        pass


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def prepare(changes: DataFrame, scratch: Scratch, batches: int = BATCHES) -> DataFrame:
    """(batch, client_id, n, day, change_id, op, city, balance): distinct changes with their number and batch.

    n is the dense rank of seq within the client, null seq first; it is worked out before rows without ``valid_at``, and every
    eleventh by hash, go, so that numbers are missing.
    """
    rows = changes.select("change_id", "client_id", "seq", "op", "valid_at", *[c for c in ("source", "segment") if c in changes.columns], "city", "balance").distinct()
    rows = scratch(rows.select("change_id", "client_id", "seq", "op", "valid_at", "city", "balance"))
    ranks = positions(rows.select("client_id", "seq").distinct(), ["client_id"], ["seq"], scratch)
    ranks = ranks.select(F.col("client_id").alias("of"), F.col("seq").alias("s"), (F.col("pos") + 1).alias("n"))
    rows = rows.join(ranks, F.col("client_id").eqNullSafe(F.col("of")) & F.col("seq").eqNullSafe(F.col("s")))
    h = F.crc32(F.col("change_id").cast("string"))
    rows = rows.filter(F.col("valid_at").isNotNull() & (h % 11 != 0))
    rows = rows.withColumn("day", (F.unix_date(F.col("valid_at").cast("date")) + 9 * (h % 4)).cast("int"))
    number = F.floor((F.col("day") - 19723) * batches / 160) + 1
    number = F.greatest(F.lit(1), F.least(F.lit(batches), number)).cast("int")
    return rows.select(number.alias("batch"), "client_id", "n", "day", "change_id", "op", "city", "balance")


def apply_changes(changes: DataFrame, batches: int = BATCHES, after_start: Callable[[int], None] | None = None) -> DataFrame:
    """(change_id, client_id, n, op, status, batch, missed, city, balance, current): what became of every change.

    The rows of a client are applied in the order of their numbers. A row whose number has come before, or lies below
    the next one, is rejected. When a batch begins and a client's earliest waiting row is ``PATIENCE`` days older than the
    largest day of all clients in earlier batches, the numbers missing before the first waiting row are given up.
    What still waits after the last batch is applied as batch ``batches`` + 1. ``current`` marks a client's last
    applied row, unless it deletes.

    Each batch is a start of its own of one streaming query, on one checkpoint, in a new folder. Null client_id is a
    client of its own; rows without change_id or valid_at vanish; an op other than I, U and D changes nothing; rows
    that repeat in full count once; other columns, whatever their names, only part rows that are otherwise alike where
    they are named source or segment. An empty table gives an empty result. ``after_start`` is called after each start.
    """
    spark = changes.sparkSession
    base = shared_dir(spark)
    fs, _ = _hadoop(spark, base)
    at = lambda *x: _hadoop(spark, "/".join([base, *x]))[1]
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # a start opens each store once: closed with its task, as many are open as tasks run, not one for each partition and start
        "spark.sql.streaming.stateStore.unloadOnCommit": "true",
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.maintenanceInterval": "20s",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        # the checkpoint lives no longer than this call: no second file beside each of its files
        "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
    }
    if base.startswith(("file:", "/")):  # on mounted folders the manager taken otherwise starts programs of the system for each file that it renames
        settings["spark.sql.streaming.checkpointFileManagerClass"] = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
    with Scratch(spark) as scratch:
        ticks = spark.range(1, batches + 2).select(F.col("id").cast("int").alias("batch"), F.lit(_TICK).alias("op"))
        rows = prepare(changes, scratch, batches).unionByName(ticks, allowMissingColumns=True)
        rows.repartition("batch", F.pmod(F.hash("change_id"), F.lit(8))).write.partitionBy("batch").parquet(f"{base}/staged")
    # a row a batch
    days = {r[0]: r[1:] for r in spark.read.schema(_IN).parquet(f"{base}/staged").groupBy("batch").agg(F.max("day"), F.count(F.lit(1))).collect()}
    buckets = max(LEAST_BUCKETS, sum(n for _, n in days.values()) // PER_BUCKET)
    fs.mkdirs(at("in"))
    horizon = None
    with _settings(spark, settings):
        for batch in range(1, batches + 2):
            fs.rename(at("staged", f"batch={batch}"), at("in", f"batch={batch}"))
            _start(spark, base, Sequencer(batch, horizon, batch > batches), buckets)
            if after_start:
                after_start(batch)
            horizon = max((x for x in (horizon, days[batch][0]) if x is not None), default=None)
    out = spark.read.schema(_OUT).parquet(f"{base}/out")
    final = out.filter("status = 'applied'").groupBy(F.col("client_id").alias("of")).agg(F.max("n").alias("top"))
    out = out.hint("merge").join(final.hint("merge"), F.col("client_id").eqNullSafe(F.col("of")) & (F.col("n") == F.col("top")), "left")
    current = (F.col("status") == "applied") & F.col("top").isNotNull() & ~F.col("op").eqNullSafe("D")
    return written(out.select("change_id", "client_id", "n", "op", "status", "batch", "missed", "city", "balance", current.alias("current")))


def _start(spark: SparkSession, base: str, sequencer: Sequencer, buckets: int) -> None:
    """One start of the query: takes what lies in the folder and is new, and ends."""
    bucket = lambda *of: F.pmod(F.xxhash64(*of), F.lit(buckets)).cast("int")
    rows = spark.readStream.schema(_IN).parquet(f"{base}/in").select(bucket("client_id", "n").alias("slot"), *[c.split()[0] for c in _MID.split(", ")[1:]])
    firsts = rows.groupBy("slot").transformWithState(Firsts(), _MID, "append", "none")
    # repeats need no state any more: they pass the second stage in all its buckets
    owner = F.when(F.col("repeat"), bucket("change_id")).otherwise(bucket("client_id"))
    done = firsts.withColumn("owner", owner).groupBy("owner").transformWithState(sequencer, _OUT, "append", "processingTime")
    done.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()


def cents(balance: Column) -> Column:
    return F.floor(F.lit(100) * balance + F.lit(0.5)).cast("long")
