"""A Merkle manifest of a data set: leaves in groups, a proof for every row, hashed block by block in DuckDB.

Rows are ordered within their group by one range sort; a row's position follows from the place it has there and from
the sizes of the sorted pieces before it, so no group meets in one task. Positions are cut into aligned blocks of
2 to the power ``LEVELS`` leaves, each a complete subtree. Executors hand whole blocks, as Arrow tables, to DuckDB, which climbs them
with one ordered ``string_agg`` and ``sha256`` a level. The roots of the blocks are the leaves of the next storey;
storeys are climbed in the same way until each group has one root, and then once more over the roots of the groups.
On the way down each block gets the proof of its own root by a join, and DuckDB puts the proofs within it before that.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, written

#: Levels of a block; it has at most 2 to that power leaves.
LEVELS = 12
#: Rows that one call of the engine climbs at least, where there are as many: small blocks go together.
CHUNK_ROWS = 50_000


def leaf(*fields: Column) -> Column:
    """SHA-256 of the fields one after another: ``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""

    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*map(one, fields)).cast("binary"), 256)


def _whole_blocks(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.Table]:
    """Tables of some whole blocks each, from batches in which the rows of a block stand together."""
    held: list[pa.RecordBatch] = []
    rows, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(batch.column("gx").to_pylist(), [p >> levels for p in batch.column("pos").to_pylist()], strict=True))
        if rows >= CHUNK_ROWS:  # cut where the next block begins
            cut = next((i for i, k in enumerate(keys) if k != last), None)
            if cut is not None:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, rows, batch = [], 0, batch.slice(cut)
        held.append(batch)
        rows, last = rows + batch.num_rows, keys[-1]
    if held:
        yield pa.Table.from_batches(held)


class _Engine:
    """DuckDB over the blocks of one Arrow table: level tables ``l0``, ``l1``, ... of (gx, b, pos, h, top)."""

    def __init__(self, nodes: pa.Table, levels: int):
        import duckdb

        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.con.register("nodes", nodes)
        self.size = levels
        # a group that fits one block is climbed to its root, else a block to its full height, single nodes included
        self.con.execute(
            f"CREATE TABLE l0 AS SELECT gx, pos >> {levels} AS b, pos & {(1 << levels) - 1} AS pos, h, "
            f"CASE WHEN n > {1 << levels} THEN {levels} ELSE ceil(log2(n))::INT END AS top FROM nodes"
        )
        self.levels = self.con.execute("SELECT max(top) FROM l0").fetchone()[0]
        for k in range(self.levels):
            self.con.execute(
                f"CREATE TABLE l{k + 1} AS SELECT gx, b, pos >> 1 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h, any_value(top) AS top "
                f"FROM l{k} WHERE top > {k} GROUP BY gx, b, pos >> 1"
            )

    def roots(self) -> pa.Table:
        parts = [f"SELECT gx, b AS pos, h FROM l{k} WHERE top = {k}" for k in range(self.levels + 1)]
        return self.con.execute(" UNION ALL ".join(parts)).to_arrow_table()

    def proofs(self, rest: str) -> pa.Table:
        """The rows of ``nodes`` with their columns ``rest``, and the proof and path of each up to the root.

        Those of a block's root stand in the block's row with the lowest position.
        """
        outer = f"SELECT gx, pos >> {self.size} AS b, outer_proof, outer_path FROM nodes WHERE pos & {(1 << self.size) - 1} = 0"
        self.con.execute(f"CREATE TABLE above AS {outer}")
        for k in range(self.levels, -1, -1):
            inner = (
                f"SELECT l.gx, l.b, l.pos, coalesce(s.h, '') || u.proof AS proof, "
                f"CASE WHEN s.h IS NULL THEN '-' WHEN l.pos & 1 = 1 THEN 'L' ELSE 'R' END || u.path AS path "
                f"FROM l{k} l JOIN p{k + 1} u ON u.gx = l.gx AND u.b = l.b AND u.pos = l.pos >> 1 "
                f"LEFT JOIN l{k} s ON s.gx = l.gx AND s.b = l.b AND s.pos = xor(l.pos, 1) WHERE l.top > {k} UNION ALL "
                if k < self.levels
                else ""
            )
            self.con.execute(f"CREATE TABLE p{k} AS {inner}SELECT l.gx, l.b, l.pos, a.outer_proof AS proof, a.outer_path AS path FROM l{k} l JOIN above a USING (gx, b) WHERE l.top = {k}")
        return self.con.execute(
            f"SELECT n.gx, n.pos, {rest}, p.proof, p.path FROM nodes n JOIN p0 p ON p.gx = n.gx AND p.b = n.pos >> {self.size} AND p.pos = n.pos & {(1 << self.size) - 1}"
        ).to_arrow_table()


def _block(levels: int) -> Column:
    return F.shiftright("pos", levels)


def _block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """(gx, pos, h, n): the roots of all blocks of a storey of nodes, as the nodes of the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches, levels):
            yield from _Engine(table, levels).roots().cast(pa.schema([("gx", pa.int64()), ("pos", pa.int64()), ("h", pa.string())])).to_batches()

    dealt = nodes.select("gx", "pos", "h", "n", _block(levels).alias("block")).repartition("gx", "block").sortWithinPartitions("gx", "block").drop("block")
    sizes = nodes.filter("pos = 0").select("gx", F.ceil(F.col("n") / F.lit(1 << levels)).alias("n"))
    return dealt.mapInArrow(run, "gx long, pos long, h string").join(sizes, "gx").select("gx", "pos", "h", "n")


def _above(roots: DataFrame, scratch: Scratch, levels: int, groups: bool = True) -> DataFrame:
    """(gx, pos, outer_proof, outer_path, subroot, root) of every node of a storey; nodes are alone where n is 1.

    ``groups``: they belong to trees of groups, whose roots make one more tree.
    """
    n, most = roots.agg(F.count(F.lit(1)), F.max("n")).first()
    if n and most > 1:
        up = _above(scratch(_block_roots(roots, levels)), scratch, levels, groups)
        return scratch(_descend(roots, up, [], levels).select("gx", "pos", F.col("proof").alias("outer_proof"), F.col("path").alias("outer_path"), "subroot", "root"))
    none = F.lit("")
    if not groups or not n:
        return roots.select("gx", "pos", none.alias("outer_proof"), none.alias("outer_path"), F.col("h").alias("subroot"), F.col("h").alias("root"))
    one = roots.select(F.lit(0).cast("long").alias("gx"), F.col("gx").alias("pos"), "h", F.lit(n).cast("long").alias("n"))
    top = _above(one, scratch, levels, False).select(F.col("pos").alias("gx"), F.lit(0).cast("long").alias("pos"), "outer_proof", "outer_path", "root")
    return scratch(roots.select("gx", "pos", F.col("h").alias("subroot")).join(top, ["gx", "pos"]))


def _descend(nodes: DataFrame, up: DataFrame, rest: Sequence[str], levels: int) -> DataFrame:
    """``nodes`` with proof, path, subroot and root, given those of the roots of their blocks."""
    kept = ", ".join(f'n."{c}"' for c in [*rest, "subroot", "root"])
    types = dict(nodes.dtypes)
    schema = ", ".join(["gx long", "pos long", *[f"`{c}` {types[c]}" for c in rest], "subroot string", "root string", "proof string", "path string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches, levels):
            out = _Engine(table, levels).proofs(kept)
            yield from out.cast(pa.schema([(f.name, pa.string() if f.type == pa.large_string() else f.type) for f in out.schema])).to_batches(max_chunksize=2048)

    first = F.col("pos").bitwiseAND((1 << levels) - 1) == 0
    own = up.select(F.col("gx").alias("ogx"), F.col("pos").alias("oblock"), "outer_proof", "outer_path", "subroot", "root")
    both = nodes.withColumn("block", _block(levels)).hint("merge").join(own.hint("merge"), (F.col("gx") == F.col("ogx")) & (F.col("block") == F.col("oblock")))
    # long proofs travel once a block, in its first row
    both = both.withColumns({c: F.when(first, F.col(c)) for c in ("outer_proof", "outer_path")})
    return both.sortWithinPartitions("gx", "block").select("gx", "pos", "h", "n", "outer_proof", "outer_path", "subroot", "root", *[c for c in rest if c != "h"]).mapInArrow(run, schema)


def manifest(df: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group_col: str = "lang", id_col: str = "doc_id", carry: Mapping[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per input row: id, group, leaf, position, subroot, root, proof and path, and the columns of ``carry``.

    Within a group leaves ascend by id (null first), then by digest; two neighbours make a node, a single last one a
    node of its own, until one is left, the subroot. Subroots, ordered by group (null first, then by UTF-8 bytes),
    make the root likewise. ``proof`` has the siblings from leaf to root one after another, 64 digits each; ``path``
    says for each level whether the sibling stands to the left (``L``), to the right (``R``) or is missing (``-``);
    :func:`fold` follows them. A block has 2 to the
    power ``levels`` leaves. ``carry`` names further string columns, worked out in the same pass as the leaves. Rows that
    repeat are leaves of their own; null and empty texts differ; an empty table gives an empty result; columns that
    are not named are not read.
    """
    carry = dict(carry or {})
    with Scratch(df.sparkSession) as scratch:
        leaves = scratch(df.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf(*[F.col(c) for c in fields]).alias("h"), *[c.alias(f"c_{k}") for k, c in carry.items()]))
        ordered = leaves.repartitionByRange("grp", "id", "h").sortWithinPartitions("grp", "id", "h")
        ordered = scratch(ordered.withColumn("at", F.monotonically_increasing_id()))
        scratch.drop(leaves)
        # pieces: what one partition of the range sort has of one group, at most one a partition and group
        part = F.shiftright("at", 33)
        pieces = ordered.groupBy(part.alias("part"), "grp").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
        before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        pieces = scratch(pieces.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")))
        groups = pieces.groupBy("grp").agg(F.sum("rows").alias("n")).repartitionByRange("grp").sortWithinPartitions("grp")
        groups = scratch(groups.withColumn("at", F.monotonically_increasing_id()))
        ranks = groups.groupBy(part.alias("of")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))  # a row a partition
        ranks = ranks.withColumn("base", F.coalesce(F.sum("rows").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("first"))
        groups = groups.join(ranks.select("of", "base"), part == F.col("of")).select(F.col("grp").alias("of_grp"), "n", (F.col("at") + F.col("base")).alias("gx"))
        pieces = scratch(pieces.join(groups, F.col("grp").eqNullSafe(F.col("of_grp"))).select("part", F.col("grp").alias("of_grp"), "base", "n", "gx"))
        nodes = ordered.join(pieces, (part == F.col("part")) & F.col("grp").eqNullSafe(F.col("of_grp")))
        rest = ["id", "grp", "h", *[f"c_{k}" for k in carry]]
        nodes = scratch(nodes.select("gx", (F.col("at") + F.col("base")).alias("pos"), "n", *rest))
        scratch.drop(ordered)
        roots = scratch(_block_roots(nodes, levels))
        out = _descend(nodes, _above(roots, scratch, levels), rest, levels)
        return written(out.select(F.col("id").alias(id_col), F.col("grp").alias(group_col), F.col("h").alias("leaf"), F.col("pos").alias("position"), "subroot", "root", "proof", "path", *[F.col(f"c_{k}").alias(k) for k in carry]))


def fold(start: Column, proof: Column, path: Column) -> Column:
    """The root that follows from a leaf, its proof and its path."""
    step = F.struct(start.alias("h"), F.lit(1).alias("at"))

    def up(acc: Column, side: Column) -> Column:
        sibling = F.substring(proof, acc["at"], F.lit(64))
        both = F.when(side == "L", F.concat(sibling, acc["h"])).when(side == "R", F.concat(acc["h"], sibling)).otherwise(acc["h"])
        return F.struct(F.sha2(both.cast("binary"), 256).alias("h"), (acc["at"] + F.when(side == "-", 0).otherwise(64)).alias("at"))

    return F.aggregate(F.filter(F.split(path, ""), lambda c: c != ""), step, up)["h"]
