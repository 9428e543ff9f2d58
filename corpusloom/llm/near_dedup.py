"""Near-duplicate detection with HyperMinHash sketches.

1. Each text becomes its set of hashed shingles. Texts with equal sets form a class; only one of a class goes on.
2. A sketch has ``BANDS * ROWS`` buckets. Each keeps the smallest hash that falls into it, not whole but as
   HyperMinHash stores it: the count of leading zeros and the ten bits that follow, two bytes in all. Sets with
   few shingles get one hash function per bucket instead of one bucket per shingle, so that no bucket is empty.
3. Bands of compressed registers are hashed; texts that agree in a band are candidates.
4. Estimates of Jaccard similarity, corrected for accidental collisions of compressed registers, join candidates to
   groups that look alike: those whose estimate comes near the threshold (4.5 standard errors below it). First each
   text meets one other: among the most popular members of its bands, the one it shares most bands with. Then what
   shares a band with a larger group, without being in it, meets its members in tiles of bounded size; at last the
   members of small groups that share a band meet, in tiles as well. A tile gives no pairs, only the links of a
   spanning forest: at most one for each text in it.
5. Verification reads the full sets of the texts in such groups, once. In groups larger than a tile each text is
   first compared with the one it met first. Then the members of a group, as far as no link joins them yet, meet in
   tiles that hold their sets, and each tile gives the links of a spanning forest of true links. What is in one
   component already is not compared. So a group of copies costs one comparison a text, and texts that look alike
   without being linked are compared in memory, never written as pairs.

Every true link between candidates lies within one group, so none is lost but by the chances of bands and estimates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import Scratch, beside, groups, utf8, written

#: At similarity 0.75 a link is missed with probability (1 - 0.75 ** 5) ** 48, or 2e-6.
BANDS, ROWS = 48, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Sets up to SMALL shingles have a sketch of one kind, from 3/4 of that on (also) of the other: a linked pair has sizes within 3/4.
SMALL = 1024
#: Texts on either side of a tile, on average; a text counts once more for each LARGE shingles it has.
TILE, LARGE = 512, 2048
#: Groups of so many texts, that look alike by their estimates, are hosts to what shares a band with them.
HOST = 4
#: Words kept with their hashes in a worker; emptied when full.
CACHE = 500_000

_u = np.uint64
_MIX = _u(0x9E3779B97F4A7C15)


def _constants(n: int, salt: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{salt}{i}") for i in range(n)], np.uint64)


_A, _B = _constants(REGISTERS, "a") | _u(1), _constants(REGISTERS, "b")

#: Chance that two different smallest hashes leave the same register: the same octave, and the same bits in it.
_octaves = np.exp(-(2.0 ** np.arange(-40, 8))) - np.exp(-(2.0 ** np.arange(-39, 9)))
COLLISION = float((_octaves**2).sum() / 2**MANTISSA)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _u(31))) * _u(0xBF58476D1CE4E5B9)
    return x ^ (x >> _u(29))


def shingles(text: bytes, known: dict[bytes, int], width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; one for all words where there are fewer than ``width``."""
    words = text.lower().split()  # A-Z only, and exactly the white space of the contract
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(width, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64) * _MIX
    for i in range(k):
        h = _mix((h ^ w[i : len(w) - k + 1 + i]) * _MIX)
    return np.unique(h)


def compress(least: np.ndarray) -> np.ndarray:
    """Leading zeros and the following bits of 64-bit hashes, as 1 to 65535; the largest hash stands for an empty bucket, 0."""
    fraction, exponent = np.frexp(least.astype(np.float64))
    value = ((64 - exponent).astype(np.int64) << MANTISSA) + ((2 * fraction - 1) * 2**MANTISSA).astype(np.int64) + 1
    return np.where(least == _u(0xFFFFFFFFFFFFFFFF), 0, np.clip(value, 1, 65535)).astype("<u2")


def sketch(hashes: np.ndarray, small: bool) -> bytes:
    if small:
        least = np.full(REGISTERS, 0xFFFFFFFFFFFFFFFF, np.uint64)
        for at in range(0, len(hashes), 256):
            least = np.minimum(least, _mix(hashes[at : at + 256, None] * _A + _B).min(axis=0))
        return compress(least).tobytes()
    bucket = (_mix(hashes * _A[0] + _B[0]) >> _u(33)) % _u(REGISTERS)
    value = _mix(hashes * _A[1] + _B[1])
    order = np.lexsort((value, bucket))
    first = np.flatnonzero(np.diff(bucket[order], prepend=_u(REGISTERS)))
    least = np.full(REGISTERS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    least[bucket[order][first].astype(np.int64)] = value[order][first]
    return compress(least).tobytes()


def estimate(matches: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Jaccard similarity from equal registers among those that are not empty in both, less accidental ones."""
    return (matches / np.maximum(1, used) - COLLISION) / (1 - COLLISION)


def floor_for(threshold: float) -> float:
    """Estimates below this are 4.5 standard errors (a chance of 3e-6) from the threshold."""
    return threshold - 4.5 * float(np.sqrt(threshold * (1 - threshold) / REGISTERS))


def sketches(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.75) -> DataFrame:
    """(doc_id, row, n_shingles, set_key, few, many): sizes, a fingerprint of each set, and its registers by kind.

    ``row`` is a number of its own for each row, until the table is computed again.
    """
    low = int(SMALL * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            if len(known) > CACHE:
                known.clear()
            sets = [shingles(t, known, width) for t in utf8(batch.column(2))]
            cols = [
                batch.column(0),
                batch.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_set_key(s) for s in sets], pa.binary()),
                pa.array([sketch(s, True) if 0 < len(s) <= SMALL else None for s in sets], pa.binary()),
                pa.array([sketch(s, False) if len(s) >= low else None for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", "n_shingles", "set_key", "few", "many"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, row long, n_shingles long, set_key binary, few binary, many binary")


def _set_key(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh128_digest(hashes.tobytes()) if len(hashes) else None


def _registers(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Registers by row, and which rows have them."""
    data = col.to_pylist()
    blank = bytes(2 * REGISTERS)
    return np.frombuffer(b"".join(x or blank for x in data), "<u2").reshape(-1, REGISTERS), np.array([x is not None for x in data], bool)


def hashed_sets(wanted: DataFrame, df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, repeated, hashes) for ``wanted`` (node, doc_id, set_key, repeated): full sets, 48 bits a shingle.

    Texts move once, in a join by doc_id; of texts that share an id the one with the wanted set counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            if len(known) > CACHE:
                known.clear()
            sets = [shingles(t, known, width) for t in utf8(batch.column(0))]
            same = pa.array([_set_key(s) == k for s, k in zip(sets, batch.column(1).to_pylist(), strict=True)], pa.bool_())
            packed = [(s >> _u(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(packed, pa.binary())], names=["node", "repeated", "hashes"]).filter(same)

    wanted = wanted.withColumnRenamed("doc_id", "__id")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = beside(docs, wanted, F.col("doc_id") == F.col("__id"), "inner").select("text", "set_key", "node", "repeated")
    return rows.mapInArrow(run, "node long, repeated boolean, hashes binary")


def _unpack(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
    return np.unique(out.view("<u8").ravel())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the intersection of two sets is at least ``percent`` of their union."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def linked_pairs(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray, percent: int, columns: int = 4096) -> np.ndarray:
    """:func:`linked` for every row of ``p`` with every row of ``q``, by products of incidence matrices."""
    used = np.union1d(p, q)
    size = np.array([len(sets[i]) for i in used], np.int64)
    owner = np.repeat(np.arange(len(used)), size)
    _, shingle, count = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    often = count > 1  # the others are in no intersection
    number = np.cumsum(often) - 1
    keep = often[shingle]
    owner, shingle = owner[keep], number[shingle[keep]]
    order = np.argsort(shingle, kind="stable")
    owner, shingle = owner[order], shingle[order]
    at_p, at_q = np.searchsorted(used, p), np.searchsorted(used, q)
    both = np.zeros((len(p), len(q)), np.float32)  # exact: no text has 2 ** 24 shingles that others share
    for first in range(0, int(often.sum()), columns):
        x, y = np.searchsorted(shingle, [first, first + columns])
        m = np.zeros((len(used), columns), np.float32)
        m[owner[x:y], shingle[x:y] - first] = 1
        both += m[at_p] @ m[at_q].T
    union = size[at_p][:, None] + size[at_q][None, :] - both
    return 100 * both.astype(np.float64) >= percent * union.astype(np.float64)


def _matrix(table: pa.Table, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Estimates between the rows ``p`` and ``q``, the larger of the two kinds of sketch; -1 where they share none."""
    out = np.full((len(p), len(q)), -1.0, np.float32)
    for kind in ("few", "many"):
        r, has = _registers(table[kind])
        if not (has[p].any() and has[q].any()):
            continue
        same, used = np.zeros(out.shape, np.int16), np.zeros(out.shape, np.int16)
        for x, y in zip(r[p].T, r[q].T, strict=True):
            some = (x > 0)[:, None]
            same += (x[:, None] == y[None, :]) & some
            used += some | (y > 0)[None, :]
        both = has[p][:, None] & has[q][None, :]
        out = np.where(both, np.maximum(out, estimate(same, used)), out)
    return out


class _Forest:
    """Components within a tile; ``join`` says whether two were apart until now."""

    def __init__(self):
        self.top: dict[int, int] = {}

    def find(self, x: int) -> int:
        top = self.top
        while (y := top.get(x, x)) != x:
            top[x] = top.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.top[max(a, b)] = min(a, b)
        return a != b


_LINKS = "a long, b long"


def _links(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Tiles over as many tasks as any shuffle has: they are few bytes but much work, and must not be put together by size."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys, "node")


def _every(n: str):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))


def _slice(n: str, salt: int):
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))


def _stars(pairs: DataFrame, payload: DataFrame, check) -> DataFrame:
    """Those (node, leader) of ``pairs`` that ``check`` (a table, rows, the leader's row) finds linked, as (a, b).

    Each leader comes once to every slice of its followers.
    """
    info = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("long").alias("slices"))
    left = pairs.join(info, "leader").select("leader", _slice("slices", 1).alias("s"), F.lit(True).alias("guest"), "node")
    right = info.select("leader", _every("slices").alias("s"), F.lit(False).alias("guest"), F.col("leader").alias("node"))
    rows = _spread(left.unionByName(right).join(payload, "node"), "leader", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["leader", "s"]):
            guest = table["guest"].to_numpy(zero_copy_only=False).astype(bool)
            p, q = np.flatnonzero(guest), np.flatnonzero(~guest)
            if len(p) and len(q):
                node = table["node"].to_numpy()
                found = node[p[check(table, p, int(q[0]))]]
                yield _links(found, np.full(len(found), node[q[0]]))

    return rows.mapInArrow(run, _LINKS)


def _visits(guests: DataFrame, hosts: DataFrame, found: DataFrame, payload: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) by estimate between guests (node, host) and members of host groups, one for each guest and tile."""
    least = floor_for(threshold)
    info = guests.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("long").alias("slices"))
    info = info.join(hosts.select(F.col("component").alias("host"), F.ceil(F.col("n") / TILE).cast("long").alias("tiles")), "host")
    left = guests.join(info, "host").select("host", _every("tiles").alias("t"), _slice("slices", 1).alias("s"), F.lit(True).alias("guest"), "node")
    right = found.withColumnRenamed("component", "host").join(info, "host").select("host", _slice("tiles", 2).alias("t"), _every("slices").alias("s"), F.lit(False).alias("guest"), "node")
    rows = _spread(left.unionByName(right).join(payload, "node"), "host", "t", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["host", "t", "s"]):
            guest = table["guest"].to_numpy(zero_copy_only=False).astype(bool)
            p, q = np.flatnonzero(guest), np.flatnonzero(~guest)
            if len(p) and len(q):
                near, node = _matrix(table, p, q), table["node"].to_numpy()
                at = np.flatnonzero(near.max(axis=1) >= least)
                yield _links(node[p[at]], node[q[near[at].argmax(axis=1)]])

    return rows.mapInArrow(run, _LINKS)


def _tiles(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(tile, left, node, component) of (grp, node, component, weight): the members of every group that has several
    components, dealt to tiles so that any two of different components meet in one.

    Components as large as a tile have slices of their own, which never meet each other; all others share slices.
    """
    sizes = scratch(members.groupBy("grp", "component").agg(F.sum("weight").alias("w")))
    mixed = sizes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("grp")
    own = F.when(F.col("w") >= TILE, F.col("component"))
    sizes = sizes.join(mixed, "grp", "left_semi").withColumn("own", own)
    slices = scratch(sizes.groupBy("grp", "own").agg(F.ceil(F.sum("w") / TILE).cast("long").alias("slices")))
    each = slices.select("grp", "own", _every("slices").alias("s"))
    place = lambda x: F.struct(F.col(f"{x}.own").isNotNull(), F.coalesce(f"{x}.own", F.lit(0)), F.col(f"{x}.s"))
    apart = (place("x") <= place("y")) & (F.col("x.own").isNull() | F.col("y.own").isNull() | (F.col("x.own") != F.col("y.own")))
    pairs = each.alias("x").join(each.alias("y"), (F.col("x.grp") == F.col("y.grp")) & apart)
    pairs = scratch(pairs.select(F.monotonically_increasing_id().alias("tile"), F.col("x.grp").alias("grp"), F.col("x.own").alias("own_x"), F.col("x.s").alias("s_x"), F.col("y.own").alias("own_y"), F.col("y.s").alias("s_y")))
    # a slice that meets itself is the left side only
    sides = pairs.select("tile", "grp", F.col("own_x").alias("own"), F.col("s_x").alias("s"), F.lit(True).alias("left"))
    sides = sides.unionByName(pairs.filter("NOT (own_x <=> own_y AND s_x = s_y)").select("tile", "grp", F.col("own_y").alias("own"), F.col("s_y").alias("s"), F.lit(False).alias("left")))
    sides = sides.select("tile", F.col("grp").alias("__g"), F.col("own").alias("__own"), F.col("s").alias("__s"), "left")
    dealt = members.join(sizes.select("grp", "component", "own"), ["grp", "component"]).join(slices.select("grp", F.col("own").alias("__o"), "slices"), "grp").filter("own <=> __o")
    dealt = dealt.select("grp", "own", _slice("slices", 3).alias("s"), "node", "component")
    met = dealt.join(sides, (F.col("grp") == F.col("__g")) & F.col("own").eqNullSafe(F.col("__own")) & (F.col("s") == F.col("__s")))
    return met.select("tile", "left", "node", "component")


def _meet(tiles: DataFrame, payload: DataFrame, threshold: float, verify: bool) -> DataFrame:
    """Links (a, b) that join different components within each tile, a spanning forest of them: by estimate, between
    components, or by full sets, between nodes."""
    least, percent = floor_for(threshold), round(threshold * 100)
    rows = _spread(tiles.join(payload, "node"), "tile")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["tile"]):
            node, comp = table["node"].to_numpy(), table["component"].to_numpy()
            left = table["left"].to_numpy(zero_copy_only=False).astype(bool)
            p, q = (np.arange(len(node)),) * 2 if left.all() else (np.flatnonzero(left), np.flatnonzero(~left))
            if not len(p):
                continue
            near = _matrix(table, p, q)
            ok = (near >= least) & (comp[p][:, None] != comp[q][None, :])
            if left.all():
                ok = np.triu(ok)
            if not ok.any():
                continue
            if verify:
                sets = [_unpack(x) for x in table["hashes"].to_pylist()]
                many = ok.sum() > 8 * (len(p) + len(q))
                if many:
                    rows_, cols_ = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
                    ok[np.ix_(rows_, cols_)] &= linked_pairs(sets, p[rows_], q[cols_], percent)
            x, y = np.nonzero(ok)
            order = np.argsort(-near[x, y], kind="stable")
            forest, a, b = _Forest(), [], []
            for i, j in zip(p[x[order]].tolist(), q[y[order]].tolist(), strict=True):
                u, v = int(comp[i]), int(comp[j])
                if forest.find(u) == forest.find(v) or verify and not many and not linked(sets[i], sets[j], percent):
                    continue
                forest.join(u, v)
                a.append(int(node[i]) if verify else u)
                b.append(int(node[j]) if verify else v)
            yield _links(a, b)

    return rows.mapInArrow(run, _LINKS)


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` of (node, ...) with the component each node is in, itself if in none."""
    return rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.75) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Null and empty texts have no shingles and are linked with nothing. ``component_id`` is the smallest doc_id
    reachable over links, the row's own included, and ``kept`` is ``doc_id = component_id``. Rows that share a
    doc_id are linked as their texts are, each for itself. A row without a doc_id has neither component nor ``kept``
    and links nothing. Other columns are ignored; an empty table gives an empty result.
    """
    least = floor_for(threshold)
    with Scratch(df.sparkSession) as scratch:
        wide = scratch(sketches(df, id_col, text_col, width, threshold))
        # one text of each class of equal sets
        one = wide.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key")
        nodes = scratch(one.agg(F.min("row").alias("node"), F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("few").alias("few"), F.first("many").alias("many")))
        rows = scratch(wide.select("doc_id", "n_shingles", "set_key"))
        scratch.drop(wide)
        payload = nodes.select("node", "few", "many")

        def band(kind: str, salt: int):
            cut = lambda i: F.xxhash64(i, F.lit(salt), F.substring(F.col(kind), i * (2 * ROWS) + 1, F.lit(2 * ROWS)))
            return F.when(F.col(kind).isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), cut)).otherwise(F.array().cast("array<bigint>"))

        bands = nodes.select("node", F.explode(F.concat(band("few", 1), band("many", 2))).alias("key"))
        shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        members = scratch(bands.join(shared, "key").select("key", "node", "n"))
        # the member of a bucket that has the fullest buckets leads it; a text meets the leader it shares most with
        popular = members.groupBy("node").agg(F.sum("n").alias("fame"))
        leaders = members.join(popular, "node").groupBy("key").agg(F.max(F.struct("fame", -F.col("node"))).alias("x")).select("key", (-F.col("x.col2")).alias("leader"))
        met = members.join(leaders, "key").filter("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("times"))
        first = met.groupBy("node").agg(F.max(F.struct("times", -F.col("leader"))).alias("x")).select("node", (-F.col("x.col2")).alias("leader"))
        stars = scratch(_stars(first, payload, lambda t, p, q: _matrix(t, p, np.array([q]))[:, 0] >= least))
        found = scratch(components(stars))
        # what meets a larger group without being in it
        named = scratch(_named(members.select("key", "node"), found))
        hosts = scratch(found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= HOST))
        rooms = named.join(hosts, "component", "left_semi").select("key", F.col("component").alias("host")).distinct()
        guests = scratch(named.join(rooms, "key").filter("component <> host").select("node", "host").distinct())
        visits = scratch(_visits(guests, hosts, found, payload, threshold))
        # members of hosts have met everything that shares a band with them; what is left is in small groups
        small = named.join(hosts, "component", "left_anti").select(F.col("key").alias("grp"), "node", "component", F.lit(1).alias("weight"))
        across = scratch(_meet(_tiles(small, scratch), payload, threshold, verify=False))
        scratch.drop(members, named, guests)
        found = scratch(components(stars.unionByName(visits).unionByName(across)))

        # full sets of all that look alike, read once
        some = nodes.join(found, "node").select("node", "doc_id", "set_key", F.col("component").alias("grp"), (1 + F.floor(F.col("n_shingles") / LARGE)).alias("weight"))
        ids = rows.join(some.select("set_key", "node", F.col("doc_id").alias("__id")), "set_key").filter(F.col("doc_id") == F.col("__id"))
        wanted = ids.groupBy("node", "doc_id", "set_key").agg((F.count(F.lit(1)) > 1).alias("repeated"))
        sets = scratch(hashed_sets(wanted, df, id_col, text_col, width))
        sets = sets.filter("NOT repeated").unionByName(sets.filter("repeated").dropDuplicates(["node"])).select("node", "hashes")
        some = scratch(some)
        large = some.groupBy("grp").agg(F.sum("weight").alias("w")).filter(F.col("w") > TILE).select("grp")
        percent = round(threshold * 100)

        def check(t: pa.Table, p: np.ndarray, q: int) -> np.ndarray:
            data = t["hashes"].to_pylist()
            mine = _unpack(data[q])
            return np.array([linked(_unpack(data[i]), mine, percent) for i in p], bool)

        centre = some.join(large, "grp", "left_semi").select("node").join(stars.toDF("node", "leader"), "node")
        links = scratch(_stars(centre, sets, check))
        parts = scratch(_named(some.select("grp", "node", "weight"), scratch(components(links))))
        rest = _meet(_tiles(parts.select("grp", "node", "component", "weight"), scratch), sets.join(payload, "node"), threshold, verify=True)
        links = scratch(links.unionByName(rest))
        classes = _named(nodes.select("set_key", "node", "doc_id"), scratch(components(links)))
        # a component is named by the smallest doc_id in it
        name = classes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        classes = classes.join(name, "component").select("set_key", "component_id")
        out = rows.join(classes, "set_key", "left")
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return written(out.select("doc_id", "n_shingles", own.alias("component_id"), (F.col("doc_id") == own).alias("kept")))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df``, all columns, but those that a smaller doc_id of their component stands for.

    Null and empty texts and rows without a doc_id stay. Where rows share a doc_id, all stay if one is kept. Whole
    rows move once, in a join by id; an empty table gives an empty one.
    """
    decided = near_groups(df, id_col, text_col, **options).groupBy(F.col("doc_id").alias("__gone")).agg(F.max("kept").alias("__kept"))
    gone = written(decided.filter("NOT __kept").select("__gone"))
    return beside(df, gone, df[id_col].cast("long") == gone["__gone"], "left_anti")
