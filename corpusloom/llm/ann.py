"""Approximate nearest neighbours by inner product over learned partitions.

A bounded sample gets its exact neighbour graph; the graph is cut into balanced parts with few links between them;
a small network learns, from the vector alone, in which parts its neighbours lie. The network then deals every
vector of the table to its most probable part, or to its two most probable ones, and sends each query to as many of
its most probable parts as queries of the sample that the network has not seen need for the wanted recall; one or
two copies, whichever scores fewer vectors for it. For the scores the parts stand in a row that is cut into pieces of
bounded size. Each candidate moves once a copy, each query once to every piece that has a part of its own, and not once a
part; there the queries stream past the candidates and are scored exactly against those in their parts.
Parts grow with the table, as far as the sample allows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written

#: Vectors the partitions are learned from: an eighth of the table, but LEAST_SAMPLE to SAMPLE on average.
LEAST_SAMPLE, SAMPLE = 4096, 32_768
#: Sample vectors a part has at least; parts are a power of two.
LEAST = 32
#: Parts stand in a row that is cut into so many pieces at least, more where a piece would hold over WITHIN components.
PIECES, WITHIN = 16, 1 << 22
#: Scores a task holds at once.
SCORES = 1 << 22
#: Numbers in a block of a matrix that has a row or a column for every vector of the sample; no such matrix is held whole.
BLOCK = 1 << 21
#: Recall the number of probed parts is chosen for, measured on sample queries the network has not seen.
RECALL = 0.95


def blocks(n: int, width: int) -> Iterator[np.ndarray]:
    """Numbers from 0 to n in runs whose rows of ``width`` numbers stay within BLOCK; 512 at most."""
    step = min(512, max(1, BLOCK // width))
    for at in range(0, n, step):
        yield np.arange(at, min(n, at + step))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows with the largest inner product with each row, itself excluded."""
    out = np.empty((len(x), k), np.int32)
    for rows in blocks(len(x), len(x)):
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -np.inf
        out[rows] = np.argpartition(np.negative(s, out=s), k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8, slack: float = 1.05) -> np.ndarray:
    """Halves along the direction of most variance, again and again; then nodes move to where more of their
    neighbours are, as long as no part grows over ``slack`` times its share."""
    part = np.zeros(len(x), np.int64)
    n = 1
    while n < parts:
        for p in range(n):
            at = np.flatnonzero(part == p)
            if len(at) > 1:
                _, axes = np.linalg.eigh(np.cov(x[at].T))
                side = x[at] @ axes[:, -1]
                part[at[np.argsort(side, kind="stable")[len(at) // 2 :]]] = p + n
        n *= 2
    size, most = np.bincount(part, minlength=parts), int(slack * len(x) / parts) + 1
    # the neighbours of each node, and the nodes that it is a neighbour of, one node after another
    of, to = np.repeat(np.arange(len(x), dtype=np.int32), graph.shape[1]), graph.ravel()
    ends = np.concatenate([of, to])
    around = np.concatenate([to, of])[np.argsort(ends, kind="stable")]
    around = np.split(around, np.cumsum(np.bincount(ends, minlength=len(x)))[:-1])
    for _ in range(rounds):
        moved = 0
        for i in range(len(x)):
            votes = np.bincount(part[around[i]], minlength=parts)
            votes[size >= most] = -1
            to, own = int(votes.argmax()), part[i]
            if votes[to] > (part[around[i]] == own).sum():
                size[own] -= 1
                size[to] += 1
                part[i] = to
                moved += 1
        if moved < len(x) // 200:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer: probabilities of parts for vectors.

    ``probes``: parts a query is sent to; ``copies``: parts a vector is dealt to; ``share``: of all vectors, those that
    a query is scored against, and ``recall``, both as measured on unseen queries of the sample.
    """

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1
    copies: int = 1
    share: float = 1.0
    recall: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def shares(part: np.ndarray, graph: np.ndarray, parts: int, rows: np.ndarray) -> np.ndarray:
    """Of the neighbours of ``rows``, the share in each part; a vector belongs with its neighbours, and with itself."""
    out, k = np.zeros((len(rows), parts)), graph.shape[1]
    np.add.at(out, (np.repeat(np.arange(len(rows)), k), part[graph[rows]].ravel()), 1.0)
    out[np.arange(len(rows)), part[rows]] += k
    return out / out.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: Callable[[np.ndarray], np.ndarray], parts: int, hidden: int = 128, epochs: int = 40, rate: float = 2e-3, seed: int = 5) -> Router:
    """Cross entropy against shares of neighbours by part, which ``y`` gives for rows, with Adam; fewer epochs over large samples."""
    epochs = max(8, min(epochs, 240_000 // max(1, len(x))))
    rng = np.random.default_rng(seed)
    shape = ((x.shape[1], hidden), (hidden,), (hidden, parts), (parts,))
    scale = 1 / max(1e-9, float(np.sqrt((x**2).mean())))
    w = [rng.normal(0, np.sqrt(2 / s[0]), s) * (scale if i == 0 else 1) if len(s) == 2 else np.zeros(s) for i, s in enumerate(shape)]
    m, v, t = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - y(rows)) / len(rows)
            e = (d @ w[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((x[rows].T @ e, e.sum(axis=0), h.T @ d, d.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= rate * (scale if i == 0 else 1) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Router(*w)


def blank(dim: int) -> Router:
    """One part, in which everything is."""
    return Router(np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))


def fit(x: np.ndarray, total: int, k: int = 20, recall: float = RECALL, least: int = LEAST) -> Router:
    """A router from sample vectors of a table of ``total`` rows."""
    n = 1
    while 2 * n * least <= len(x):
        n *= 2
    k_all = min(k, len(x) - 1)
    if n == 1 or k_all < 1:
        return blank(x.shape[1])
    graph = neighbour_graph(x, k_all)
    part = balanced_parts(x, graph, n)
    seen, unseen = (np.flatnonzero((np.arange(len(x)) % 4 == 0) == u) for u in (False, True))
    router = train(x[seen], lambda rows: shares(part, graph, n, seen[rows]), n)
    own = np.empty((len(x), 2), np.int32)
    place = np.empty((len(unseen), n), np.min_scalar_type(n))  # when each part would be probed
    for rows in blocks(len(x), n):
        order = np.argsort(-router.logits(x[rows]), axis=1, kind="stable")
        own[rows] = order[:, :2]
        new = rows % 4 == 0
        place[rows[new] // 4] = np.argsort(order[new], axis=1)
    # the k nearest of the table have so many of the sample among them
    near = np.empty((len(unseen), min(k_all, max(3, round(k * len(x) / max(total, len(x)))))), np.int32)
    for rows in blocks(len(unseen), k_all * x.shape[1]):
        found = graph[unseen[rows]]
        nearest = np.argsort(-np.einsum("qd,qkd->qk", x[unseen[rows]], x[found]), axis=1, kind="stable")
        near[rows] = np.take_along_axis(found, nearest, axis=1)[:, : near.shape[1]]
    best = None
    for copies in (1, 2):
        when = np.take_along_axis(place, own[near, :copies].reshape(len(near), -1), axis=1).reshape(*near.shape, copies).min(axis=2)
        reached = np.cumsum(np.bincount(when.ravel(), minlength=n)) / when.size
        probes = int(np.argmax(reached >= recall)) + 1
        # a vector with copies in several probed parts is scored once
        scored = 0
        for rows in blocks(len(unseen), len(x)):
            hit = place[rows] < probes
            scored += int(np.logical_or.reduce([hit[:, own[:, c]] for c in range(copies)]).sum())
        share = scored / (len(unseen) * len(x))
        if best is None or share < best[2]:
            best = (probes, copies, share, float(reached[probes - 1]))
    router.probes, router.copies, router.share, router.recall = best
    return router


def usable(vector: Column, dim: int) -> Column:
    """Vectors of ``dim`` components, all finite, not all zero."""
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) == dim) & whole & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def top(rough: np.ndarray, query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, longest: float, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, and ids and scores of the k best, ties to the smaller id.

    ``rough`` has the products of queries and vectors, -inf for those that take no part; it only finds who can be
    among the best, ``longest`` being the largest norm of a vector. Scores are summed component by component in
    double precision, so equal vectors have equal scores.
    """
    slack = 1e-10 * np.sqrt((query**2).sum(axis=1)) * longest
    # the k-th best of some is at most the k-th best of all, and leaves few to choose from
    some = rough[:, :: max(1, min(16, rough.shape[1] // (4 * k)))]
    bound = np.partition(some, -k, axis=1)[:, -k] if some.shape[1] > k else np.full(len(query), -np.inf)
    for r, s in enumerate(rough):
        at = np.flatnonzero((s >= bound[r] - slack[r]) & (s > -np.inf))
        if len(at) > k:
            at = at[s[at] >= np.partition(s[at], -k)[-k] - slack[r]]
        exact = (query[r] * vectors[at]).cumsum(axis=1)[:, -1]
        best = np.lexsort((ids[at], -exact))[:k]
        yield r, ids[at][best], exact[best]


def spare(vectors: np.ndarray, part: np.ndarray, before: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Whether no query needs a candidate: of equal vectors that meet the same queries, those with the k smallest ids
    are enough, and one more for each time that a query's own id may stand among them."""
    salt = np.random.default_rng(9).integers(1, 1 << 62, vectors.shape[1]).astype(np.uint64)
    mark = (vectors.view(np.uint64) * salt).sum(axis=1)  # equal vectors have equal marks
    order = np.lexsort((ids, mark, before, part))
    new = np.ones(len(ids), bool)
    new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (part, before, mark)])
    at = np.flatnonzero(~new)
    new[at] = (vectors[order[at]] != vectors[order[at - 1]]).any(axis=1)
    starts = np.flatnonzero(new)
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(starts, append=len(ids)))
    out = np.empty(len(ids), bool)
    out[order] = place >= k + np.unique(ids, return_counts=True)[1].max()
    return out


class Piece:
    """Candidates of one piece, first copies before second ones and each by part; ``before`` is the part of a second
    copy's first, or -1."""

    def __init__(self, rows: pa.Table, dim: int, parts: int, k: int):
        self.ids, self.parts, self.k = rows["id"].to_numpy(), parts, k
        self.vectors = _matrix(rows["v"], dim).astype(float)
        part, before = rows["part"].to_numpy(), rows["before"].to_numpy()
        if (drop := spare(self.vectors, part, before, self.ids, k)).any():
            self.ids, self.vectors, part, before = (x[~drop] for x in (self.ids, self.vectors, part, before))
        self.longest = float(np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors).max()))
        self.again = int((before < 0).sum())  # where second copies begin
        self.before = before[self.again :]
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        self.runs = [(int(part[a]), slice(a, b)) for a, b in itertools.pairwise(cuts)]
        self.by_id = np.argsort(self.ids, kind="stable")

    def nearest(self, own: np.ndarray, query: np.ndarray, bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """As :func:`top`, for queries with ids ``own`` and a row of ``bits``, one for each part they go to."""
        asked = np.unpackbits(bits, axis=1, count=self.parts).astype(bool)
        rough = np.full((len(query), len(self.ids)), -np.inf)
        for part, run in self.runs:
            if len(who := np.flatnonzero(asked[:, part])):
                rough[who, run] = query[who] @ self.vectors[run].T
        np.copyto(rough[:, self.again :], -np.inf, where=asked[:, self.before])  # scored with the first copy
        ids = self.ids[self.by_id]
        for r, (a, b) in enumerate(zip(np.searchsorted(ids, own), np.searchsorted(ids, own, "right"), strict=True)):
            rough[r, self.by_id[a:b]] = -np.inf
        yield from top(rough, query, self.vectors, self.ids, self.longest, self.k)


def learn(rows: DataFrame, dim: int, total: int, k: int = 20, sample: int = SAMPLE, recall: float = RECALL, least: int = LEAST) -> Router:
    """A router from a share of the rows (id, v), chosen by a hash of the id: an eighth, ``sample`` on average at most."""
    most = min(sample, max(LEAST_SAMPLE, total // 8))
    rate = int(min(1.0, most / total) * (1 << 30))
    chosen = rows.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < rate).select("id", "v").toArrow().sort_by("id")
    return fit(_matrix(chosen["v"], dim).astype(float), total, k, recall, least) if len(chosen) else blank(dim)


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, sample: int = SAMPLE, recall: float = RECALL, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query``, the ``k`` best of all rows with another id.

    Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part,
    neither do rows without an id. Queries that share an id count once (any one vector); candidates that share an
    id are separate. Fewer candidates than ``k`` give fewer ranks, an empty table none. Other columns are ignored.
    """
    spark = df.sparkSession
    kind = "array<float>" if df.schema[vec_col].dataType == T.ArrayType(T.FloatType()) else "array<double>"
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("v"), is_query.alias("query"))
    schema = "query_id long, rank int, vec_id long, score double"
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    dim, total = dims[0]["d"], dims[0]["n"]
    rows = rows.filter(usable(F.col("v"), dim))
    router = learn(rows, dim, total, k, sample, recall, least)
    parts = len(router.b2)
    held = spark.sparkContext.broadcast(router)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = held.value
        for b in batches:
            if b.num_rows:
                order = np.argsort(-r.logits(_matrix(b.column(1), dim)), axis=1, kind="stable")
                to = np.zeros((b.num_rows, parts), bool)
                np.put_along_axis(to, order[:, : r.probes], True, axis=1)
                bits = [x.tobytes() if q else None for x, q in zip(np.packbits(to, axis=1), b.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(order[:, : r.copies].astype(np.int32)), pa.list_(pa.int32())), pa.array(bits, pa.binary())], names=["id", "v", "query", "own", "bits"])

    routed = written(rows.mapInArrow(route, f"id long, v {kind}, query boolean, own array<int>, bits binary"))
    # one row a part, and at most one part for each LEAST vectors of the sample
    counts = np.zeros(parts, np.int64)
    for r in routed.select(F.explode("own").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["part"]] = r["n"]
    ends = counts.cumsum()
    pieces = max(PIECES, math.ceil(int(ends[-1]) * dim / WITHIN))
    width = max(1, math.ceil(int(ends[-1]) / pieces))
    first, last = (ends - counts) // width, (ends - 1) // width  # pieces that hold a part
    places = spark.createDataFrame([(p, int(ends[p] - n), n) for p, n in enumerate(counts.tolist()) if n], "part int, begin long, n long")
    # a candidate's second copy knows the part of its first
    items = routed.select("id", "v", F.posexplode("own").alias("copy", "part"), F.when(F.col("copy") > 0, F.element_at("own", 1)).otherwise(-1).alias("before"))
    items = items.join(F.broadcast(places), "part").withColumn("at", F.col("begin") + F.pmod(F.xxhash64("id", "v"), F.col("n")))
    items = items.select(F.floor(F.col("at") / width).cast("int").alias("piece"), F.lit(False).alias("query"), "id", "v", "part", "before", F.lit(None).cast("binary").alias("bits"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            to = []
            for bits in b.column(2).to_pylist():
                own = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=parts) & (counts > 0))
                edge = np.zeros(pieces + 1, np.int32)
                np.add.at(edge, first[own], 1)
                np.add.at(edge, last[own] + 1, -1)
                to.append(np.flatnonzero(edge.cumsum()[:-1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to, pa.list_(pa.int32()))], names=["id", "v", "bits", "pieces"])

    asked = routed.filter("query").dropDuplicates(["id"]).select("id", "v", "bits").mapInArrow(send, f"id long, v {kind}, bits binary, pieces array<int>")
    asked = asked.select(F.explode("pieces").alias("piece"), F.lit(True).alias("query"), "id", "v", F.lit(-1).alias("part"), F.lit(-1).alias("before"), "bits")
    met = items.unionByName(asked).repartitionById(pieces, F.col("piece")).sortWithinPartitions("piece", "query", F.col("before") >= 0, "part")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, piece, of = [], None, None
        for b in batches:
            number, query = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("piece", "query"))
            cuts = [0, *(np.flatnonzero((np.diff(number) != 0) | (np.diff(query.astype(int)) != 0)) + 1).tolist(), len(number)]
            for begin, end in itertools.pairwise(cuts) if len(number) else ():
                if number[begin] != of:
                    gathered, piece, of = [], None, number[begin]
                if not query[begin]:
                    gathered.append(b.slice(begin, end - begin))
                    continue
                if gathered:
                    piece, gathered = Piece(pa.Table.from_batches(gathered), dim, parts, k), []
                if piece is None:
                    continue
                step = max(1, SCORES // len(piece.ids))
                for at in range(begin, end, step):
                    g, out = b.slice(at, min(step, end - at)), ([], [], [])
                    own, bits = g["id"].to_numpy(), np.stack([np.frombuffer(x, np.uint8) for x in g["bits"].to_pylist()])
                    for r, found, scores in piece.nearest(own, _matrix(g["v"], dim).astype(float), bits):
                        for col, x in zip(out, (np.full(len(found), own[r]), found, scores), strict=True):
                            col.append(x)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])

    near = met.mapInArrow(score, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
