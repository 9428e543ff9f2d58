"""Steps of a stream that can be run again: a ledger of batches, and retention that deletes.

A step writes what it makes of a batch to a folder named after the batch, which it replaces, and only then enters the batch
in the ledger. A batch that is delivered again is done again if it is not in the ledger, and passed over if it is;
either way its rows stand in the output once.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Ledger:
    """One small file a finished batch, created whole or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def done(self, batch: int) -> bool:
        fs, p = _fs(self.spark, f"{self.path}/{batch}.json")
        return fs.exists(p)

    def enter(self, batch: int, note: dict | None = None) -> None:
        fs, p = _fs(self.spark, f"{self.path}/_{batch}.json")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps({"batch": batch, "at": datetime.now(timezone.utc).isoformat(), **(note or {})}).encode()))
        out.close()
        fs.rename(p, _fs(self.spark, f"{self.path}/{batch}.json")[1])

    def batches(self) -> list[int]:
        fs, p = _fs(self.spark, self.path)
        found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(x.removesuffix(".json")) for x in found if x.endswith(".json") and not x.startswith("_"))


def idempotent(step: Callable[[DataFrame, int], DataFrame], out: str, ledger: Ledger, crash: Callable[[int, str], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes ``step(rows, batch)`` to ``out``, each batch once.

    ``crash`` is called between the parts of a batch (``before``, ``written``, ``entered``): tests break off there.
    """

    def run(rows: DataFrame, batch: int) -> None:
        told = crash or (lambda batch, where: None)
        if ledger.done(batch):
            return
        told(batch, "before")
        step(rows, batch).write.mode("overwrite").parquet(f"{out}/batch={batch}")
        told(batch, "written")
        ledger.enter(batch)
        told(batch, "entered")

    return run


def run_steps(stream: DataFrame, step: Callable[[DataFrame, int], DataFrame], path: str, crash: Callable[[int, str], None] | None = None) -> DataFrame:
    """Takes all that is available, batch after batch, and returns what has been made so far, of finished batches only.

    Run again after any interruption, it goes on where the last finished batch ended.
    """
    spark = stream.sparkSession
    ledger = Ledger(spark, f"{path}/ledger")
    write = stream.writeStream.foreachBatch(idempotent(step, f"{path}/out", ledger, crash)).option("checkpointLocation", f"{path}/checkpoint")
    write.trigger(availableNow=True).start().awaitTermination()
    return finished(spark, path)


def finished(spark: SparkSession, path: str) -> DataFrame:
    """The output of the batches that are in the ledger."""
    batches = Ledger(spark, f"{path}/ledger").batches()
    return spark.read.option("basePath", f"{path}/out").parquet(*[f"{path}/out/batch={b}" for b in batches])


def delete_all_but(spark: SparkSession, path: str, keep: DataFrame, column: str) -> list[str]:
    """Deletes the entries of the folder ``path`` whose names are not in ``keep.column``; returns the names that went.

    ``keep`` has a row for each entry that stays; an empty ``keep`` deletes nothing, since it is more likely a fault.
    """
    fs, p = _fs(spark, path)
    there = [s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName()[0] not in "_."]
    stay = {r[0] for r in spark.createDataFrame([(x,) for x in there], "name string").join(keep.select(F.col(column).cast("string").alias("name")), "name", "left_semi").collect()} if there else set()
    if not stay:
        return []
    gone = sorted(set(there) - stay)
    for x in gone:
        fs.delete(_fs(spark, f"{path}/{x}")[1], True)
    return gone
