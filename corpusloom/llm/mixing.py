"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

A source's target over its size is the number of copies each of its documents should get. The whole part is
given to all; the fractional parts are rounded by the pivotal method on words: two documents at a time, words
move from one to the other, at random but with the expectation of either unchanged, until one of the two has a
whole number of copies. The sum of words is kept at each step, so a source misses its target by one document at
most. Documents are dealt to blocks of bounded size by a hash; each block leaves one document undecided, and
those meet in the next level of a reduction tree, down to one per source. A few documents of each size wait for
that one at the root, so that what is rounded at last is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, beside, written

#: Documents per block, on average.
BLOCK = 128
#: Documents of a source and size class (a power of two) that wait for the root, on average.
HELD = 32
#: No document is taken more often than this.
MAX_COPIES = 3


def count_words(text: Column) -> Column:
    """Number of runs of anything but white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in order of code points, null last, weigh ``weights``, repeating, and share the sum of all sizes; a
    target stops at ``cap`` times its source's size and the excess goes to the rest by weight, until none is
    above. That fixed point is a water level: with sources in order of cap over weight, the level stands after
    the last source that it would drown. One row per source; an empty table gives none.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    rows = sizes.select("source", "source_size", w.cast("long").alias("weight"), (F.col("source_size") * cap).alias("most"))
    by = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    below = by.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("most").over(below), F.lit(0))).alias("left"),
        (F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(below), F.lit(0))).alias("of"),
    )
    rows = rows.withColumn("drowned", F.col("most") * F.col("of") < F.col("left") * F.col("weight"))
    # the first source in this order that keeps its head above sets the level for itself and all after it
    first = F.min(F.when(~F.col("drowned"), F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), "source", "left", "of"))).over(Window.partitionBy())
    rows = rows.withColumn("level", first)
    share = (F.col("level.left") * F.col("weight")) / F.col("level.of")
    return rows.select("source", "source_size", F.when(F.col("drowned") | F.col("level").isNull(), F.col("most").cast("double")).otherwise(F.least(share, F.col("most").cast("double"))).alias("target"))


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _pair(a: Column, b: Column, level: int, seed: int) -> tuple[Column, Column]:
    """The whole one and the open one of two documents after one transfer of words."""
    ra, ma, rb, mb = (1 - a["p"]) * a["size"], a["p"] * a["size"], (1 - b["p"]) * b["size"], b["p"] * b["size"]
    up, down = F.least(ra, mb), F.least(ma, rb)  # words that a can get from b, or give to b
    u = _uniform(a["doc_id"], a["rep"], b["doc_id"], b["rep"], F.lit(level), F.lit(seed))
    rise = u * (up + down) < down
    whole_a = (rise & (ra <= mb)) | (~rise & (ma <= rb))

    def put(x: Column, p: Column) -> Column:
        return F.struct(x["size"].alias("size"), x["doc_id"].alias("doc_id"), x["rep"].alias("rep"), p.alias("p"))

    pa = F.when(whole_a, F.when(rise, 1.0).otherwise(0.0)).when(rise, a["p"] + mb / a["size"]).otherwise(a["p"] - rb / a["size"])
    pb = F.when(~whole_a, F.when(rise, 0.0).otherwise(1.0)).when(rise, b["p"] - ra / b["size"]).otherwise(b["p"] + ma / b["size"])
    one, two = put(a, pa), put(b, pb)
    return F.when(whole_a, one).otherwise(two), F.when(whole_a, two).otherwise(one)


def _fold(df: DataFrame, keys: list[str], level: int, seed: int) -> DataFrame:
    """Each group's documents through :func:`_pair` one after the other: the whole ones and the one left open."""
    unit = "struct<size:bigint,doc_id:bigint,rep:int,p:double>"
    # the largest come first, so what stays open is small
    items = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("size", "doc_id", "rep", "p")), asc=False).alias("items"))

    def step(acc: Column, x: Column) -> Column:
        whole, still = _pair(acc["open"], x, level, seed)
        return F.struct(F.concat(acc["done"], F.array(whole)).alias("done"), still.alias("open"))

    zero = F.struct(F.array().cast(f"array<{unit}>").alias("done"), F.element_at("items", 1).alias("open"))
    rest = F.slice("items", 2, F.greatest(F.size("items") - 1, F.lit(1)))
    return items.select(*keys, F.aggregate(rest, zero, step).alias("r")).select(*keys, "r.done", "r.open")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), cap: int = MAX_COPIES, seed: int = 17, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    ``size`` is the words of the text (null: 0), ``copies`` how often the mix takes the document (0 to ``cap``),
    ``taken`` their product. A null source is a source of its own; a null doc_id is allowed; rows that repeat in
    full are rounded apart. Documents without words take nothing (their copies are rounded one by one). The
    result depends on ids, sizes and ``seed`` alone, so reruns agree, whatever the partitions. No rows, no result.
    """
    with Scratch(df.sparkSession) as scratch:
        rows = scratch(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), count_words(F.col(text_col)).alias("size")))
        goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
        counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        goal = goal.join(counts, goal["source"].eqNullSafe(counts["source"])).select(
            F.coalesce(F.xxhash64(goal["source"], goal["source"].isNull()), F.lit(0)).alias("sid"), goal["source"], "source_size", "target", "n"
        )
        goal = scratch(goal.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)))
        if goal.isEmpty():
            return written(rows.select("doc_id", "source", "size", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("taken")))

        # rows that repeat in full count as one with a multiplicity, dealt out again under a number of their own
        units = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).cast("int").alias("m"))
        units = units.select(F.xxhash64("source", F.col("source").isNull()).alias("sid"), "doc_id", "size", F.explode(F.sequence(F.lit(1), "m")).alias("rep"))
        small = goal.select("sid", F.col("ratio") - F.floor("ratio"), "n").toDF("sid", "p", "n")
        units = units.join(small, "sid").withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size"))))
        units = scratch(units.withColumn("loose", (F.col("size") == 0) | (F.col("p") == 0)))
        classes = scratch(units.filter("not loose").groupBy("sid", "class").agg(F.count(F.lit(1)).alias("of")))
        solo = units.filter("loose").select("sid", "doc_id", "rep", "size", (_uniform(F.col("doc_id"), F.col("rep"), F.lit(seed)) < F.col("p")).cast("double").alias("p"))
        blocks = F.greatest(F.ceil(F.col("n") / block), F.lit(1))
        held = _uniform(F.col("doc_id"), F.col("rep"), F.lit("held"), F.lit(seed)) * F.col("of") < HELD
        tied = units.filter("not loose").join(classes, ["sid", "class"])
        tied = scratch(tied.select("sid", "doc_id", "rep", "size", "p", held.alias("held"), F.pmod(F.xxhash64("doc_id", "rep", "size", F.lit(seed)), blocks).alias("block")))
        root = tied.filter("held").drop("held", "block")  # a bounded number per source
        tied = tied.filter("not held").drop("held")

        parts, level = [solo], 0
        while True:
            folded = scratch(_fold(tied, ["sid", "block"], level, seed))
            parts.append(folded.select("sid", F.explode("done").alias("x")).select("sid", "x.doc_id", "x.rep", "x.size", "x.p"))
            left = folded.select("sid", "block", "open.doc_id", "open.rep", "open.size", "open.p")
            if left.filter("block > 0").isEmpty():
                break
            tied, level = left.withColumn("block", F.floor(F.col("block") / block).cast("long")), level + 1
        # at the root the documents held back, of all sizes, large ones first, settle what the tree left open
        folded = scratch(_fold(root.unionByName(left.drop("block")), ["sid"], -1, seed))
        parts.append(folded.select("sid", F.explode("done").alias("x")).select("sid", "x.doc_id", "x.rep", "x.size", "x.p"))
        last = folded.select("sid", "open.*")
        chance = _uniform(F.col("doc_id"), F.col("rep"), F.lit(seed), F.lit("root"))
        parts.append(last.withColumn("p", F.when(F.col("p").isin(0.0, 1.0), F.col("p")).otherwise((chance < F.col("p")).cast("double"))))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        out = out.join(goal.select("sid", "source", "source_size", "target", "ratio"), "sid")
        copies = (F.floor("ratio") + F.round("p")).cast("long")
        return written(out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")))


def take_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``df``, each as often as :func:`mix` takes it; an empty table gives an empty one.

    Null and empty texts have no words, and stay or go by the fraction alone. Where rows share an id (or have none),
    their copies are summed and dealt evenly to those rows, the first ones in order of source and text getting more.
    Whole rows move once, in a join by id; columns of any name are kept.
    """
    copies = mix(df, id_col, text_col, source_col, **options).groupBy(F.col("doc_id").alias("__id")).agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__n"))
    copies = written(copies.filter("__copies > 0"))
    out = beside(df, copies, df[id_col].cast("long").eqNullSafe(copies["__id"]), "inner")
    if not copies.filter("__n > 1").isEmpty():  # ids that rows share
        rank = F.row_number().over(Window.partitionBy("__id").orderBy(source_col, text_col))
        dealt = F.floor(F.col("__copies") / F.col("__n")) + (rank <= F.col("__copies") % F.col("__n")).cast("long")
        some = out.filter("__n > 1").withColumn("__copies", dealt).filter("__copies > 0")
        out = out.filter("__n = 1").unionByName(some)
    out = out.withColumn("__rep", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return out.drop("__id", "__copies", "__n", "__rep")
