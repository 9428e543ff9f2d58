"""Helpers the operators of this subpackage share: the cluster's shared folder, written tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows per Arrow batch: a batch of whole documents stays within tens of megabytes.
BATCH_ROWS = 512
#: The white space of the contracts: space and U+0009 to U+000D.
SPACES = " \n\t\r\x0b\x0c"


def tune(spark: SparkSession) -> None:
    """Small Arrow batches, and filter push-down into Python data sources."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share, the one named in ``spark.checkpoint.dir``.

    Only a session on one machine (tests) may name none; its warehouse is used then. The path goes when the
    application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    path = f"{(base or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/corpusloom-{uuid.uuid4().hex}"
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)
    return path


#: Spark drops the shuffle files of a statement as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, its lineage cut, safe against lost executors.

    Its shuffle files go with the statement that writes it, since nothing reads them again.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables that an operator needs on its way: ``with Scratch(spark) as scratch: t = scratch(df)``.

    ``drop`` deletes one; all that are left go at the end of the block. What the operator returns must be
    :func:`written` by itself before that.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Scratch:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        path = shared_dir(self.spark)
        out = written(df, path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path, _ = self.paths.pop(id(t))
            fs, p = _hadoop(self.spark, path)
            fs.delete(p, True)

    def __exit__(self, *_) -> None:
        self.drop(*[t for _, t in self.paths.values()])


def beside(df: DataFrame, decisions: DataFrame, on: Column, how: str) -> DataFrame:
    """Whole rows joined with decisions about them that grow with the table: always by one shuffle of either side.

    No broadcast, whatever the size, so that the plan that holds on a small table is the plan on a large one.
    """
    return df.hint("merge").join(decisions.hint("merge"), on, how)


def positions(df: DataFrame, group: list[str], order: list[str], scratch: Scratch, name: str = "pos") -> DataFrame:
    """``df`` with the place (from 0) of each row within its ``group`` in ``order``; no group meets in one task.

    Rows are range-sorted once; a row's place is the one in its partition, plus what the group has in the partitions
    before. There is one small row a partition and group, not one a row, in the window over the partitions.
    """
    keys = [*group, *order]
    ordered = scratch(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    pieces = ordered.groupBy(part.alias("__part"), *[F.col(g).alias(f"__g_{g}") for g in group]).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*[f"__g_{g}" for g in group]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("__base", F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first"))
    on = part == F.col("__part")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    return ordered.join(pieces, on).select(*df.columns, (F.col("__at") + F.col("__base")).alias(name))


def without_spaces(text: Column) -> Column:
    """The text without white space; null counts as empty. Plain replaces are the fastest native form."""
    out = F.coalesce(text, F.lit(""))
    for ch in SPACES:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each string, empty for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by the keys; one group is held at a time."""
    import pyarrow.compute as pc

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        change = None
        for c in cols:
            d = pc.not_equal(c.slice(1), c.slice(0, n - 1))
            change = d if change is None else pc.or_(change, d)
        cuts = [i + 1 for i, x in enumerate(change.to_pylist()) if x]
        begin = 0
        for end in [*cuts, n]:
            part = batch.slice(begin, end - begin)
            key = tuple(c[begin].as_py() for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            last, begin = key, end
    if held:
        yield pa.Table.from_batches(held)
