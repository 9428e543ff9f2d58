"""Removal of long repeated byte strings, from Burrows-Wheeler transforms of shards that are merged by interleaving.

A string of ``length`` bytes is a window. Whether it starts anywhere else is what the order of all suffixes tells: it
does if, in that order, a neighbour shares ``length`` bytes. Suffixes are not kept for every byte, as in prefix-free parsing:

1. *Parsing.* Of the grams of ``GRAM`` bytes in a window the one with the smallest hash, the first of equals, is its
   anchor. That depends on the window's bytes alone, so equal windows have their anchor at the same place. Windows with one
   anchor in common follow each other; with all their bytes they are a phrase. Each task collapses the equal phrases of its shard.
2. *Dictionary.* Grams that one occurrence has are done: no window of theirs is repeated. A phrase that occurs twice has
   all windows repeated. What is left are the different phrases of grams that have several, one representative each.
3. *Shard transforms.* A shard sorts its representatives by gram and by the suffix that begins at the anchor. Beside
   each suffix stands its transform's symbol, what comes before: here not a byte but the phrase's part left of the anchor.
4. *Merge.* The runs of all shards for one gram begin interleaved as they come, one after another. Each iteration refines the
   interleave by the next eight bytes within blocks that still agree; a block of one suffix is done, no run is sorted
   again. The iteration in which two neighbours part gives their longest common prefix. The symbols to the left are
   interleaved likewise, backwards. Suffixes with common prefixes of at least t are intervals of the one order, symbols that agree on d
   bytes are intervals of the other; a window whose anchor is at d is repeated if another phrase shares both its intervals for
   t = length - d.

Grams are independent of each other, so executors merge them side by side, many grams at a time. A gram with more than ``MOST``
different phrases (a passage in a large share of all documents, at its edges) does not meet in one task: its windows are counted by
digest instead, by partial aggregates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, beside, groups, written

GRAM = 64
#: Different phrases of one gram that one task merges.
MOST = 32_768
#: Bytes parsed at a time, and bytes of a shard.
BLOCK, SHARD = 1 << 21, 1 << 24
#: Phrases merged at a time, where there are as many.
MERGE_ROWS = 16_384

_u = np.uint64
_rng = np.random.default_rng(20240511)
_BYTES = _rng.integers(0, 1 << 63, 256, np.uint64) * _u(2) + _u(1)
_BASE = 0x9E3779B97F4A7C15
_INDEX = _u((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Parser:
    """Phrases of blocks of bytes; keeps the powers of its rolling hash."""

    def __init__(self, length: int):
        self.length, self.window = length, length - GRAM + 1
        self.up = self.down = np.empty(0, np.uint64)

    def grams(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[:n], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * self.down[: n - GRAM + 1]
        h ^= h >> _u(32)
        h *= _u(0xD6E8FEB86659FD93)
        return h ^ h >> _u(29)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, anchor, first window, last window, gram) of each phrase; texts lie at ``starts`` to ``ends``."""
        n, w = len(data), self.window
        if n < self.length:
            return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),)
        gram = self.grams(data)
        key = np.full(-(-len(gram) // w) * w, ~_u(0))
        key[: len(gram)] = gram & ~_INDEX | np.arange(len(gram), dtype=np.uint64)
        # the least key of each window: of the rest of one row of w keys and the beginning of the next
        rows = key.reshape(-1, w)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        m = len(gram) - w + 1
        anchor = (np.minimum(after[:m], before[w - 1 : w - 1 + m]) & _INDEX).astype(np.int64)
        has = np.zeros(m + 1, np.int8)  # windows that lie in one text
        long = ends - starts >= self.length
        np.add.at(has, starts[long], 1)
        np.add.at(has, ends[long] - self.length + 1, -1)
        anchor[np.cumsum(has[:m], dtype=np.int8) == 0] = -1
        first = np.flatnonzero(np.diff(anchor, prepend=-2))
        last = np.append(first[1:], m) - 1
        keep = anchor[first] >= 0
        first, last = first[keep], last[keep]
        at = anchor[first]
        return np.searchsorted(starts, first, side="right") - 1, at, first, last, gram[at]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where texts begin and end in them."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _blocks(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, ends, row ids, place of each start in its text) of at most about ``BLOCK`` bytes."""
    rid = batch.column(0).to_numpy(zero_copy_only=False)
    data, at = _texts(batch.column(1))
    i = 0
    while i < len(rid):
        j = max(i + 1, int(np.searchsorted(at, at[i] + BLOCK, side="right")) - 1)
        if j == i + 1 and at[j] - at[i] > BLOCK:  # a long text, in pieces that share their windows' bytes
            for begin in range(0, int(at[j] - at[i]) - length + 1, BLOCK):
                piece = data[at[i] + begin : min(at[j], at[i] + begin + BLOCK + length - 1)]
                yield piece, np.array([0]), np.array([len(piece)]), rid[i:j], np.array([begin])
        else:
            yield data[at[i] : at[j]], at[i:j] - at[i], at[i + 1 : j + 1] - at[i], rid[i:j], np.zeros(j - i, np.int64)
        i = j


_OCC = pa.struct([("rid", pa.int64()), ("a", pa.int64()), ("p", pa.int64()), ("q", pa.int64())])
_PHRASES = "g long, h1 long, h2 long, n long, occs array<struct<rid:long,a:long,p:long,q:long>>"


def _phrases(length: int):
    """Phrases of a shard: gram, digest, and where each different one occurs (row, anchor, first and last window)."""

    def shard(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        g, h1, h2, rid, a, p, q = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((p, rid, h2, h1, g))
        g, h1, h2, *occ = (x[order] for x in (g, h1, h2, rid, a, p, q))
        new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
        offsets = np.append(new, len(g))
        occs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(x) for x in occ], fields=list(_OCC)))
        out = pa.RecordBatch.from_arrays([pa.array(g[new]), pa.array(h1[new]), pa.array(h2[new]), pa.array(np.diff(offsets)), occs], names=["g", "h1", "h2", "n", "occs"])
        for i in range(0, out.num_rows, 4096):
            yield out.slice(i, 4096)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse, parts, size = Parser(length), [], 0
        for batch in batches:
            for data, starts, ends, rid, base in _blocks(batch, length):
                text, a, p, q, gram = parse(data, starts, ends)
                if not len(text):
                    continue
                view = memoryview(data)
                digest = b"".join([hashlib.blake2b(view[i:j], digest_size=16).digest() for i, j in zip(p.tolist(), (q + length).tolist(), strict=True)])
                digest = np.frombuffer(digest, np.int64).reshape(-1, 2)
                move = base[text] - starts[text]
                parts.append((gram.view(np.int64), digest[:, 0], digest[:, 1], rid[text], a + move, p + move, q + move))
                size += len(data)
                if size >= SHARD:
                    yield from shard(parts)
                    parts, size = [], 0
        if parts:
            yield from shard(parts)

    return run


_CONTEXT = "g long, run int, at int, rid long, a long, alone boolean, near int, far int, left binary, right binary"


def _contexts(length: int):
    """The transform of a shard: suffixes from the anchors in order, each with what stands before it, backwards.

    ``near`` and ``far`` are how far the anchor lies from the last and the first window of the phrase.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = TaskContext.get().partitionId(), []
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for text, wanted in zip(texts, batch.column(1).to_pylist(), strict=True):
                for m in wanted:
                    a, p, q = m["a"], m["p"], m["q"]
                    rows.append((m["g"], text[a : q + length], m["rid"], a, m["alone"], a - q, a - p, text[p:a][::-1]))
            if len(rows) >= 20_000:
                yield from emit(task, rows)
                rows = []
        if rows:
            yield from emit(task, rows)

    def emit(task: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: r[:4])
        g, right, rid, a, alone, near, far, left = zip(*rows, strict=True)
        n = len(rows)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        cols = [g, [task] * n, range(n), rid, a, alone, near, far, left, right]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in _CONTEXT.split(", ")])
        for i in range(0, n, 2048):
            yield out.slice(i, 2048)

    return run


def interleave(block: np.ndarray, strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the merged order of strings within blocks, and what each shares with the one before it.

    ``block`` ascends. ``common`` is -1 where a block begins; strings are as if filled up with zeros to ``width``.
    """
    n, words = len(strings), -(-width // 8)
    table = np.frombuffer(b"".join([s.ljust(8 * words, b"\0") for s in strings]), ">u8").reshape(n, words)
    order, common = np.arange(n), np.full(n, 8 * words, np.int64)
    begins = np.diff(block, prepend=block[:1] - 1) != 0
    common[begins] = -1
    for j in range(words):
        # places in blocks that still have several strings
        alone = begins & np.append(begins[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        ids = np.cumsum(begins)[open_]
        word = table[order[open_], j].astype(np.uint64)
        by = np.lexsort((word, ids))
        order[open_], word = order[open_][by], word[by]
        parts = np.flatnonzero((np.diff(ids) == 0) & (word[1:] != word[:-1])) + 1
        differ = word[parts] ^ word[parts - 1]
        # whole bytes before the highest bit that differs
        high = np.zeros(len(differ), np.int64)
        for bit in (32, 16, 8):
            over = differ >> _u(bit) != 0
            differ, high = np.where(over, differ >> _u(bit), differ), high + bit * over
        common[open_[parts]] = 8 * j + 7 - high // 8
        begins[open_[parts]] = True
    return order, common


def repeated(block: np.ndarray, left: list[bytes], right: list[bytes], near: np.ndarray, far: np.ndarray, length: int) -> np.ndarray:
    """Whether the window of each phrase (row) whose anchor is at d (column) is in another phrase of the same block."""
    n = len(block)
    r_order, r_common = interleave(block, right, length)
    l_order, l_common = interleave(block, left, length - GRAM)
    out = np.zeros((n, length - GRAM + 1), bool)
    r_of, l_of = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int(near.min()), int(far.max()) + 1):
        own = np.flatnonzero((near <= d) & (d <= far))
        if len(own) < 2:
            continue
        r_of[r_order] = np.cumsum(r_common < length - d)
        l_of[l_order] = np.cumsum(l_common < d)
        both = r_of[own] * (n + 1) + l_of[own]
        by = np.argsort(both, kind="stable")
        same = both[by][1:] == both[by][:-1]
        out[own[by[1:][same]], d] = True
        out[own[by[:-1][same]], d] = True
    return out


_SPANS = "rid long, lo long, hi long"


def _span_batch(rid, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rid, lo, hi)], names=["rid", "lo", "hi"])


def _merge(length: int):
    """Spans of repeated windows, from the runs of all shards, sorted by gram, run and place."""

    def solve(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        t = pa.concat_tables(tables).combine_chunks()
        num = {c: t.column(c).to_numpy() for c in ("g", "rid", "a", "alone", "near", "far")}
        block = np.cumsum(np.diff(num["g"], prepend=num["g"][:1]) != 0)
        dup = repeated(block, t.column("left").to_pylist(), t.column("right").to_pylist(), num["near"], num["far"], length)
        dup[~num["alone"]] = False  # known already
        edge = np.diff(np.pad(dup.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        yield _span_batch(num["rid"][row], num["a"][row] - high + 1, num["a"][row] - low + length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for table in groups(batches, ["g"]):
            if rows and rows + table.num_rows > MERGE_ROWS:
                yield from solve(held)
                held, rows = [], 0
            held.append(table)
            rows += table.num_rows
        if held:
            yield from solve(held)

    return run


def _windows(length: int):
    """(g, d, h1, h2, rid, p, alone): every window of the phrases of very common grams, by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for text, wanted in zip(texts, batch.column(1).to_pylist(), strict=True):
                for m in wanted:
                    p = np.arange(m["p"], m["q"] + 1)
                    digest = b"".join([hashlib.blake2b(text[i : i + length], digest_size=16).digest() for i in p.tolist()])
                    digest = np.frombuffer(digest, np.int64).reshape(-1, 2)
                    n = len(p)
                    cols = [np.full(n, m["g"]), m["a"] - p, digest[:, 0], digest[:, 1], np.full(n, m["rid"]), p, np.full(n, m["alone"])]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["g", "d", "h1", "h2", "rid", "p", "alone"])

    return run


def _spans(rows: DataFrame, length: int, most: int, scratch: Scratch) -> DataFrame:
    """(rid, lo, hi): bytes that repeated windows cover, in pieces that may overlap."""
    phrases = scratch(rows.select("rid", "text").mapInArrow(_phrases(length), _PHRASES).withColumn("pid", F.monotonically_increasing_id()))
    grams = phrases.groupBy("g").agg(F.sum("n").alias("total"), F.min("h1").alias("low"), F.max("h1").alias("top"))
    grams = grams.filter("total > 1").select("g", (F.col("low") == F.col("top")).alias("single"))
    live = scratch(phrases.join(grams, "g"))
    scratch.drop(phrases)
    several = live.filter("not single")
    first = F.struct("pid", F.col("occs")[0].alias("o"))
    hulls = scratch(several.groupBy("g", "h1", "h2").agg(F.sum("n").alias("n"), F.min(first)["o"].alias("o")))
    sizes = hulls.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    wanted = F.struct("g", F.col("o.rid").alias("rid"), F.col("o.a").alias("a"), F.col("o.p").alias("p"), F.col("o.q").alias("q"), (F.col("n") == 1).alias("alone"))
    members = hulls.join(sizes, "g").select(F.col("o.rid").alias("of"), (F.col("size") > most).alias("big"), wanted.alias("m"))
    members = scratch(members.groupBy("of", "big").agg(F.collect_list("m").alias("wanted")))  # at most a text's own phrases

    full = live.filter("single").select("occs").unionByName(several.join(hulls.filter("n > 1").select("g", "h1", "h2"), ["g", "h1", "h2"]).select("occs"))
    full = full.select(F.explode("occs").alias("o")).select(F.col("o.rid").alias("rid"), F.col("o.p").alias("lo"), (F.col("o.q") + length).alias("hi"))

    def of(big: bool) -> DataFrame:
        part = members.filter(F.col("big") == big)
        return beside(rows.select("rid", "text"), part, F.col("rid") == F.col("of"), "inner").select("text", "wanted")

    runs = of(False).mapInArrow(_contexts(length), _CONTEXT).repartition("g").sortWithinPartitions("g", "run", "at")
    out = scratch(runs.select(*[c.split()[0] for c in _CONTEXT.split(", ")]).mapInArrow(_merge(length), _SPANS).unionByName(full))
    if not members.filter("big").isEmpty():
        key = ["g", "d", "h1", "h2"]
        windows = scratch(of(True).mapInArrow(_windows(length), "g long, d long, h1 long, h2 long, rid long, p long, alone boolean"))
        twice = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
        more = windows.filter("alone").join(twice, key).select("rid", F.col("p").alias("lo"), (F.col("p") + length).alias("hi"))
        out = scratch(out.unionByName(more))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to (doc_id, n_bytes, spans as maximal runs, kept bytes)."""
    for batch in batches:
        sizes, runs, kept = [], [], []
        for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
            merged: list[list[int]] = []
            for s in sorted((s["lo"], s["hi"]) for s in spans or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            sizes.append(len(text))
            runs.append([{"begin": b, "end": e} for b, e in merged])
            at = [0, *[x for m in merged for x in m], len(text)]
            kept.append(b"".join([text[i:j] for i, j in zip(at[::2], at[1::2], strict=True)]))
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, most: int = MOST) -> DataFrame:
    """One row per input row: doc_id, n_bytes, spans (array of begin, end) and kept (bytes).

    Each byte that lies in a string of ``length`` bytes which also starts anywhere else, in the same text or another
    one, is removed; texts are UTF-8 bytes, and strings never reach over two texts. Spans are maximal and do not
    touch. Null text is empty; texts shorter than ``length`` have no spans; rows that repeat are texts of their own, so
    each removes the other; doc_id need not be unique and may be null. Other columns are not read; an empty table
    gives an empty result. ``length`` must be at least 80. ``most`` only says how the work is done.
    """
    if length < GRAM + 16:
        raise ValueError("length must be at least 80")
    with Scratch(df.sparkSession) as scratch:
        rows = scratch(df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("rid")))
        spans = _spans(rows, length, most, scratch).groupBy(F.col("rid").alias("of")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
        both = beside(rows, spans, F.col("rid") == F.col("of"), "left").select("doc_id", "text", "spans")
        return written(both.mapInArrow(_cut, "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"))
