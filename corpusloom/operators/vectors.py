"""Vector measures over arrays: cosine, centroids, kernel-weighted rows, correlation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Output rows of :func:`kernel_rows`, at most.
MOST_ROWS = 10_000
#: Sums that it hands on at once.
CELLS = 1 << 20


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector over its length; null for the zero vector."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def against_reference(df: DataFrame, id_col: str, vec: str, key: str) -> DataFrame:
    """(id, ref, cosine): each vector against the one with the smallest id of its ``key``; one row a vector."""
    refs = df.groupBy(key).agg(F.min_by(vec, id_col).alias("__ref"), F.min(id_col).alias("ref"))  # one row a key
    rows = df.join(refs, df[key].eqNullSafe(refs[key]))
    return rows.select(df[id_col], "ref", cosine(F.col(vec), F.col("__ref")).alias("cosine"))


def centroid(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, pos, mean): element-wise means in long form, partial aggregates only."""
    return df.select(key, F.posexplode(vec).alias("pos", "x")).groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def kernel_rows(points: DataFrame, at: str, vec: str, rows: DataFrame, row: str, sigma: float = 40.0, least: float = 1e-3, by: Sequence[str] = ()) -> DataFrame:
    """(*by, row, pos, value): Gaussian-weighted means of vectors by the distance of ``at`` from ``row``; the plain mean
    where all weights together are ``least`` or less. Points without a place or a vector take no part.

    ``rows`` is a table of at most ``MOST_ROWS`` whole numbers. Weights times vectors is a matrix product, made in
    Arrow batches, so that what is shuffled is a sum per batch and not a product per point and row.
    """
    targets = [r[0] for r in rows.select(F.col(row).cast("long")).distinct().limit(MOST_ROWS + 1).collect()]
    if len(targets) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows to weight")
    kinds = dict(points.dtypes)
    out = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), f"`{row}` long", "sums array<struct<w:double,wx:double,x:double,n:long>>"])
    keys = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.array(targets, float)
        cell = pa.struct([("w", pa.float64()), ("wx", pa.float64()), ("x", pa.float64()), ("n", pa.int64())])
        for batch in batches:
            of: dict[tuple, list[int]] = {}
            for i, k in enumerate(zip(*(batch.column(c).to_pylist() for c in range(keys)), strict=True) if keys else [()] * batch.num_rows):
                of.setdefault(k, []).append(i)
            where, vectors = batch.column(keys).to_pylist(), batch.column(keys + 1).to_pylist()
            for k, members in of.items():
                size = max(len(vectors[i]) for i in members)
                x, there, some = (np.zeros((len(members), size)) for _ in range(3))
                for j, i in enumerate(members):
                    y = np.array(vectors[i], float)  # null becomes NaN
                    known = np.array([e is not None for e in vectors[i]], bool)
                    x[j, : len(y)], there[j, : len(y)], some[j, : len(y)] = np.where(known, y, 0.0), 1.0, known
                distance = (np.array([where[i] for i in members], float)[:, None] - places) / sigma
                weight = np.exp(-0.5 * distance * distance).T
                sum_x, n = x.sum(axis=0), some.sum(axis=0).astype(np.int64)
                step = max(1, CELLS // max(1, size))
                for a in range(0, len(places), step):
                    part = weight[a : a + step]
                    m = len(part)
                    flat = pa.StructArray.from_arrays([pa.array((part @ there).ravel()), pa.array((part @ x).ravel()), pa.array(np.tile(sum_x, m)), pa.array(np.tile(n, m))], fields=list(cell))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * size, pa.int32()), flat)
                    fixed = [pa.array([k[c]] * m, batch.schema.field(c).type) for c in range(keys)]
                    yield pa.RecordBatch.from_arrays([*fixed, pa.array(places[a : a + step].astype(np.int64)), lists], names=[*by, row, "sums"])

    known = points.filter(F.col(at).isNotNull() & F.col(vec).isNotNull()).select(*by, F.col(at).cast("double").alias("__at"), F.col(vec).cast("array<double>").alias("__vec"))
    parts = known.mapInArrow(run, out).select(*by, row, F.posexplode("sums").alias("pos", "s"))
    means = parts.groupBy(*by, row, "pos").agg(F.sum("s.w").alias("w"), F.sum("s.wx").alias("wx"), F.try_divide(F.sum("s.x"), F.sum("s.n")).alias("mean"))
    return means.select(*by, row, "pos", F.when(F.col("w") > least, F.col("wx") / F.col("w")).otherwise(F.col("mean")).alias("value"))
