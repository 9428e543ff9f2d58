"""A data set in shards as a Python data source, in batch and as a stream, and a scan that ends itself.

``spark.read.format("shards").schema("page_id long, payload binary").load(path)`` reads the Parquet files of a folder,
each row group a partition, only the columns of the schema (without one, all columns), and leaves payloads as the bytes
they are. ``readStream`` gives each shard once: the offset is the name of the last shard taken, so a stream that is started
again goes on behind it. Paths are those that Arrow opens on the driver and on all executors.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.ordering import prefix

BATCH_ROWS = 1024


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def names(path: str) -> list[str]:
    """The shards of a folder in the order of their names; what begins with ``_`` or ``.`` is none."""
    fs, base = open_fs(path)
    found = fs.get_file_info(pafs.FileSelector(base))
    return sorted(f"{base}/{x.base_name}" for x in found if x.type == pafs.FileType.File and x.base_name.endswith(".parquet") and x.base_name[0] not in "_.")


@dataclass
class Group(InputPartition):
    file: str
    group: int


class _Shards:
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema
        self.files = json.loads(options["files"]) if "files" in options else None

    def groups(self, files: Sequence[str]) -> list[Group]:
        fs, _ = open_fs(self.path)
        out = []
        for name in files:
            with fs.open_input_file(name) as f:
                out += [Group(name, g) for g in range(pq.ParquetFile(f).num_row_groups)]
        return out

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = open_fs(self.path)
        kind = to_arrow_schema(self.schema)
        with fs.open_input_file(partition.file) as f:
            file = pq.ParquetFile(f)
            there = set(file.schema_arrow.names)
            for batch in file.iter_batches(BATCH_ROWS, row_groups=[partition.group], columns=[c for c in kind.names if c in there]):
                # a column that a shard lacks is null
                cols = [batch.column(batch.schema.get_field_index(x.name)).cast(x.type) if x.name in there else pa.nulls(batch.num_rows, x.type) for x in kind]
                yield pa.RecordBatch.from_arrays(cols, schema=kind)


class ShardReader(_Shards, DataSourceReader):
    def partitions(self) -> list[Group]:
        return self.groups(names(self.path) if self.files is None else self.files) or [Group("", 0)]


class ShardStream(_Shards, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"last": ""}

    def latestOffset(self) -> dict:
        return {"last": max((x.rpartition("/")[2] for x in names(self.path)), default="")}

    def partitions(self, start: dict, end: dict) -> list[Group]:
        return self.groups([x for x in names(self.path) if start["last"] < x.rpartition("/")[2] <= end["last"]])

    def commit(self, end: dict) -> None:
        pass


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> StructType:
        files = names(self.options["path"])
        if not files:
            raise ValueError(f"{self.options['path']} has no shards: name the schema")
        with open_fs(self.options["path"])[0].open_input_file(files[0]) as f:
            return from_arrow_schema(pq.ParquetFile(f).schema_arrow)

    def reader(self, schema: StructType) -> ShardReader:
        return ShardReader(dict(self.options), schema)

    def streamReader(self, schema: StructType) -> ShardStream:
        return ShardStream(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ShardSource)


def write_shards(df: DataFrame, path: str, order: Sequence[str], shards: int) -> None:
    """``df`` as Parquet shards that follow ``order``: all rows of a shard come before those of the next by name."""
    df.repartitionByRange(shards, *order).sortWithinPartitions(*order).write.parquet(path)


def scan_until(spark: SparkSession, path: str, schema: str | None, step: Callable[[DataFrame, int], bool], at_once: int = 1) -> int:
    """Gives ``step`` the rows of ``at_once`` shards after another, in order, until it says that it has enough.

    ``step`` gets the rows and the number of shards before them. Returns how many shards were read; later ones
    were not opened.
    """
    register(spark)
    files = names(path)
    for at in range(0, len(files), at_once):
        reader = spark.read.format("shards").option("files", json.dumps(files[at : at + at_once]))
        if schema is not None:
            reader = reader.schema(schema)
        if step(reader.load(path), at):
            return min(len(files), at + at_once)
    return len(files)


def admit_until_full(spark: SparkSession, path: str, out: str, schema: str | None, value: str, keys: Sequence[str], caps: dict[tuple, float], order: str, bucket: Column, at_once: int = 1) -> tuple[DataFrame, int]:
    """Rows whose predecessors of the same ``keys`` sum to less than their cap, from shards that follow ``order``.

    The scan ends when every budget of ``caps`` (one small entry a budget) is full, so later shards stay unread;
    rows of other keys are not taken. Returns the rows with ``spent``, written to ``out``, and the number of shards read.
    Within a step, sums are prefix sums over ``bucket`` (a column that follows the order), as in ``selection.admit``.
    """
    kinds: list[str] = []
    spent = dict.fromkeys(caps, 0)

    def step(rows: DataFrame, at: int) -> bool:
        types = dict(rows.dtypes)
        kinds[:] = [f"{k} {types[k]}" for k in keys]
        budgets = spark.createDataFrame([(*k, float(caps[k]), spent[k]) for k in caps], ", ".join([*[f"__{x}" for x in kinds], "__cap double", "__spent long"]))
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
        rows = rows.join(F.broadcast(budgets), on).drop(*[f"__{k}" for k in keys])  # a row a budget
        rows = prefix(rows, bucket, [order], F.coalesce(F.col(value), F.lit(0)), name="__before", partition=keys)
        rows = rows.withColumn("spent", F.col("__spent") + F.col("__before"))
        rows.filter(F.col("spent") < F.col("__cap")).drop("__cap", "__spent", "__before").write.mode("append").parquet(out)
        for r in rows.groupBy(*keys).agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("s")).collect():
            spent[tuple(r[k] for k in keys)] += r["s"]
        return all(spent[k] >= caps[k] for k in caps)

    read = scan_until(spark, path, schema, step, at_once)
    return spark.read.parquet(out), read
