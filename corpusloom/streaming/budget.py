"""Budgeted admission over a stream: state per key, exactly once with a checkpoint."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def admit_stream(stream: DataFrame, key: str, seq: str, value: str, cap: float) -> DataFrame:
    """Rows of a stream taken while the sum of their predecessors of the same key is under ``cap``.

    Within a micro-batch rows go in order of ``seq``, then of ``value``; the spent budget is the only state. Null
    values count 0. Output: (key, seq, value, spent).
    """
    fields = {f.name: f.dataType.simpleString() for f in stream.schema.fields}

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        spent = state.get[0] if state.exists else 0.0
        rows = pd.concat(list(batches)).sort_values([seq, value], ignore_index=True)
        v = rows[value].fillna(0).astype(float)
        before = spent + v.cumsum().shift(fill_value=0.0)
        state.update((float(spent + v.sum()),))
        taken = rows.assign(spent=before)[before < cap]
        yield taken[[key, seq, value, "spent"]]

    schema = f"{key} {fields[key]}, {seq} {fields[seq]}, {value} {fields[value]}, spent double"
    return stream.groupBy(key).applyInPandasWithState(step, schema, "spent double", "append", "NoTimeout")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; on one machine, where it is unset, the session's warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.conf.get("spark.master", "local").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return (base or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends everything that is available to Parquet at ``path`` and stops; run again, it takes only what is new."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
