"""Multi-party perspective rotation, in DataFrame functions alone.

For every participant of a dialogue the dialogue is rendered once, with that speaker as the assistant and all
others as named users. A rendering is kept as its segments, one per turn, each with its place in the rendered
text, its template head and body, and the part of it that is trained on; so no dialogue, however long, has to
come together in one task. Places are prefix sums in two steps: within slices of a dialogue, then over slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

START, END = "<|im_start|>", "<|im_end|>\n"
#: Speakers who give instructions and are nobody's part.
SYSTEM = ("system",)


#: Characters that may not stand in a name in a template head, and how they are written there.
NAME_ESCAPES = {"%": "%25", " ": "%20", "\t": "%09", "\n": "%0A", "\r": "%0D", "<": "%3C", ">": "%3E", "|": "%7C"}


def _clean(name: Column) -> Column:
    """A speaker's name as it may stand in a template head; different names stay different."""
    for ch, code in NAME_ESCAPES.items():
        name = F.replace(name, F.lit(ch), F.lit(code))
    return name


def _harmless(text: Column) -> Column:
    """The text without anything that reads as a control token: a space parts the bracket from the bar."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", system: tuple[str, ...] = SYSTEM) -> DataFrame:
    """(conv_id, perspective, seq, turn, speaker, role, segment, start, length, mask_start, mask_length).

    One row for each turn and each participant of its dialogue. ``seq`` counts from 0 in order of turn, speaker
    and text (null first), ``start`` is the segment's first code point in the rendering, and the mask covers the
    body and the end mark of the perspective's own turns (length 0 elsewhere). A null text is empty, a null
    speaker is called ``unknown``; a dialogue of system turns alone has no participant and gives no rows. A null
    conv_id is a dialogue of its own. Control tokens in a text are written apart (``< |``), so that no text forges a
    turn; names are escaped as in addresses. Turns that repeat in full are rendered as often as they stand. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = df.sparkSession
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("speaker"), _harmless(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    # slices of a dialogue: ranges of all turns in order, so that a long dialogue spreads over many tasks
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(rows.repartitionByRange(n, "conv", "turn", "speaker", "text").withColumn("slice", F.spark_partition_id()))
    is_system = F.col("speaker").isin(*system) if system else F.lit(False)
    within = Window.partitionBy("slice", "conv").orderBy("turn", "speaker", "text")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    shown = _clean(F.col("speaker"))
    head_other = F.when(is_system, F.lit(f"{START}system\n")).otherwise(F.concat(F.lit(f"{START}user name="), shown, F.lit("\n")))
    size_other = F.char_length(head_other) + F.char_length("text") + len(END)
    # an own turn has another head: what it is longer or shorter
    gain = F.char_length(F.lit(f"{START}assistant\n")) - F.char_length(head_other)
    local = rows.select(
        "*",
        head_other.alias("head_other"),
        is_system.alias("is_system"),
        (F.row_number().over(within) - 1).cast("long").alias("k"),
        F.coalesce(F.sum(size_other).over(before), F.lit(0)).cast("long").alias("at"),
        size_other.cast("long").alias("size_other"),
        gain.cast("long").alias("gain"),
    )
    local = written(local)
    # per slice of a dialogue: its turns and size; per speaker: own turns, whose heads differ
    slices = local.groupBy("conv", "slice").agg(F.count(F.lit(1)).alias("turns"), F.sum("size_other").alias("size"))
    over = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("conv", "slice", F.coalesce(F.sum("turns").over(over), F.lit(0)).alias("k0"), F.coalesce(F.sum("size").over(over), F.lit(0)).alias("at0"))
    speakers = local.filter(~F.col("is_system")).groupBy("conv", "slice", F.col("speaker").alias("perspective")).agg(F.sum("gain").alias("gains"))
    people = speakers.select("conv", "perspective").distinct()
    grid = people.alias("p").join(slices.alias("c"), F.col("p.conv").eqNullSafe(F.col("c.conv"))).select("c.conv", "slice", "perspective", "k0", "at0")
    grid = grid.alias("g").join(speakers.alias("s"), F.col("g.conv").eqNullSafe(F.col("s.conv")) & (F.col("g.slice") == F.col("s.slice")) & (F.col("g.perspective") == F.col("s.perspective")), "left")
    over = Window.partitionBy("conv", "perspective").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.select("g.conv", "g.slice", "g.perspective", "k0", "at0", "gains")
    grid = written(grid.select("conv", "slice", "perspective", "k0", (F.col("at0") + F.coalesce(F.sum(F.coalesce("gains", F.lit(0))).over(over), F.lit(0))).alias("at0")))
    turned = local.alias("l").join(grid.alias("g"), F.col("l.conv").eqNullSafe(F.col("g.conv")) & (F.col("l.slice") == F.col("g.slice")))
    own = (F.col("speaker") == F.col("perspective")) & ~F.col("is_system")
    within = Window.partitionBy("l.slice", "l.conv", "g.perspective").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    own_before = F.coalesce(F.sum(F.when(own, F.col("gain")).otherwise(0)).over(within), F.lit(0))
    head = F.when(own, F.lit(f"{START}assistant\n")).otherwise(F.col("head_other"))
    segment = F.concat(head, F.col("text"), F.lit(END))
    start = F.col("at0") + F.col("at") + own_before
    return turned.select(
        F.col("l.conv").alias("conv_id"),
        "perspective",
        (F.col("k0") + F.col("k")).alias("seq"),
        "turn",
        "speaker",
        F.when(F.col("is_system"), "system").when(own, "assistant").otherwise("user").alias("role"),
        segment.alias("segment"),
        start.alias("start"),
        F.char_length(segment).cast("long").alias("length"),
        (start + F.when(own, F.char_length(head)).otherwise(0)).alias("mask_start"),
        F.when(own, F.char_length("text") + len(END)).otherwise(0).cast("long").alias("mask_length"),
    )


def assemble(segments: DataFrame, max_turns: int = 4096) -> DataFrame:
    """(conv_id, perspective, part, text, masks): whole renderings, those of very long dialogues in parts of ``max_turns``.

    ``masks`` holds (start, length) of the trained stretches in the part's text.
    """
    rows = segments.withColumn("part", F.floor(F.col("seq") / max_turns))
    one = F.struct("seq", "segment", "start", "mask_start", "mask_length")
    rows = rows.groupBy("conv_id", "perspective", "part").agg(F.sort_array(F.collect_list(one)).alias("s"))  # at most max_turns
    first = F.element_at("s", 1)["start"]
    masks = F.transform(F.filter("s", lambda x: x["mask_length"] > 0), lambda x: F.struct((x["mask_start"] - first).alias("start"), x["mask_length"].alias("length")))
    return rows.select("conv_id", "perspective", "part", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("text"), masks.alias("masks"))
