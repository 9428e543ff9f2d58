"""Best-fit packing of tokenised documents into sequences of bounded length, as a hierarchy.

Documents are cut into pieces (:func:`cut`); pieces are dealt by a hash to batches of bounded size; each batch is
packed best-fit decreasing in one task. Bins that are nearly full are emitted. The underfull ones go up as items
of their own, batches of them merge, and best-fit runs again, until one batch is left or a round no longer helps.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, written

#: Items per batch, on average: what one task packs.
BATCH_ITEMS = 50_000
#: A bin with at most this share of its room left is nearly full.
SLACK = 1 / 256
#: Words kept with their ids in a worker; the memory is emptied when full.
CACHE = 500_000
#: Words whose ids are put together at a time.
SLICE = 1 << 20

#: Other characters than those for which splitting here agrees with the tokenizer file's own rules; the look of a special token.
_STRANGE = "[^\t\n\r -~¡-įı-ɏ]|<[|]"
#: Classes of characters in the tokenizer's pattern, by code point: white space, letters, digits, others.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(0x250, _OTHER, np.int8)
_CLASS[[ord(c) for c in "\t\n\r "]] = _SPACE
_CLASS[[c for c in range(0x250) if 97 <= c <= 122 or c in (0xAA, 0xB5, 0xBA) or 0xDF <= c and c != 0xF7]] = _LETTER
_CLASS[[*range(48, 58), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _DIGIT
#: Texts gathered before they are encoded, in bytes.
GATHER = 6_000_000


def word_starts(b: np.ndarray) -> np.ndarray:
    """Where words and runs of white space begin in UTF-8 bytes of characters below U+0250 in lower case.

    A word is a run of letters, one digit, or a run of others; at a word's beginning an apostrophe takes s, t, m, d, re, ve
    or ll with it. The last byte must be white space.
    """
    kind = _CLASS[np.minimum(b, 127)]
    lead = np.flatnonzero(b >= 0xC0)
    two = _CLASS[(b[lead].astype(np.int64) & 31) << 6 | b[lead + 1] & 63]
    kind[lead] = kind[lead + 1] = two
    start = np.empty(len(b), bool)
    start[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == _DIGIT
    start[lead + 1] = False
    quote = np.flatnonzero((b == 39) & start)  # not behind another character of its class
    one = b[quote + 1]
    with_one = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    second = b[np.minimum(quote + 2, len(b) - 1)]
    with_two = np.isin(one, np.frombuffer(b"rv", np.uint8)) & (second == ord("e")) | (one == ord("l")) & (second == ord("l"))
    start[quote[with_one | with_two] + 1] = False
    start[quote[with_one] + 2] = True
    start[quote[with_two] + 3] = True
    return np.flatnonzero(start)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to the tokenizer's own.

    The tokenizer puts texts in lower case, splits them to words and works word by word. So whole batches are put in lower case and split as
    Arrow columns, each distinct word is encoded once, and a text's ids are gathered by the numbers of its words. A text
    with a character, as it stands or in lower case, for which that is not certain (only those tried one by one
    are), or with the look of a special token, goes to the tokenizer whole.
    """

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        spec = json.loads(Path(path or default_tokenizer()).read_text())
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        bytewise = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, bytewise]}}
        self.by_word = Tokenizer.from_str(json.dumps(spec))  # for words already split and in lower case
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # the tokens that end a word
        self.last[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.begin = self.size = np.zeros(1, np.int64)
        self.pool = np.empty(0, "<u4")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        pools, sizes = [self.pool], [self.size]
        for at in range(0, len(words), 10_000):
            part = words[at : at + 10_000]
            (found,) = self.by_word.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):
                each = [self.whole(w) for w in part]
                ids, ends = np.frombuffer(b"".join(each), "<u4"), np.cumsum([len(x) // 4 for x in each])
            pools.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        self.number.update(zip(words, range(len(self.size), len(self.size) + len(words)), strict=True))
        self.pool, self.size = np.concatenate(pools), np.concatenate(sizes)
        self.begin = np.cumsum(self.size) - self.size

    def __call__(self, texts: pa.Array) -> list[bytes]:
        texts = texts.fill_null("")
        low = pc.utf8_lower(texts)
        strange = pc.or_(pc.match_substring_regex(texts, _STRANGE), pc.match_substring_regex(low, _STRANGE))
        low = pc.binary_join_element_wise(pc.if_else(strange, "", low), "", "\n").cast(pa.large_string())
        offsets = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + len(low) + 1]
        data = low.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])) if len(low) else pa.py_buffer(b"")
        starts = word_starts(np.frombuffer(data, np.uint8))
        cuts = np.searchsorted(starts, offsets - offsets[0])
        ends = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        words = pa.LargeStringArray.from_buffers(len(starts), ends, data).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        if len(self.number) > CACHE:
            self.forget()
        if new := [w for w in distinct if w not in self.number]:
            self.number.update((w, 0) for w in new if w.isspace())  # no ids
            self.learn([w for w in new if not w.isspace()])
        number = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        number = number[words.indices.to_numpy(zero_copy_only=False)]
        sizes = self.size[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        parts = []
        for at in range(0, len(number), SLICE):
            n, k = number[at : at + SLICE], sizes[at : at + SLICE]
            shift = self.begin[n] - (ends[at : at + len(n)] - ends[at])
            parts.append(self.pool[np.repeat(shift, k) + np.arange(k.sum())])
        data = np.concatenate([self.pool[:0], *parts]).tobytes()
        at = (4 * ends[cuts]).tolist()
        return [self.whole(texts[i].as_py()) if odd else data[b:e] for i, (b, e, odd) in enumerate(zip(at, at[1:], strange.to_pylist(), strict=False))]


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker process and tokenizer file: tasks that follow each other share what it has learned."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], pa.Array]]:
    """(ids, texts) of some batches together: the more texts, the fewer of their words are new."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHER:
            yield _together(held)
            held, size = [], 0
    if held:
        yield _together(held)


def _together(batches: list[pa.RecordBatch]) -> tuple[list[int | None], pa.Array]:
    texts = pa.concat_arrays([b.column(1) for b in batches])
    return [i for b in batches for i in b.column(0).to_pylist()], texts


def cut(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1, tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and ``end_id``, cut only where longer than ``capacity``.

    Null text is empty text: one piece with ``end_id`` alone. Rows that repeat are cut each; an empty table gives no
    pieces. Other columns are not read. ``ids`` adds the ids as little-endian unsigned 32-bit bytes.
    """
    end = int(end_id).to_bytes(4, "little")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for docs, texts in _gathered(batches):
            rows: list[list] = [[] for _ in range(5 + ids)]
            for doc, data in zip(docs, encode(texts), strict=True):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    for col, x in zip(rows, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part), strict=False):
                        col.append(x)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=False)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + ids])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (index of the bin's first item, offset, fill of the bin) of each item, by position."""
    order = np.argsort(-lengths, kind="stable")
    first, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: dict[int, int] = {}
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by the room they have left
    mask = 0  # bit r: a bin with room r is open
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        if fits := mask >> n:
            r = n + ((fits & -fits).bit_length() - 1)
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, i
            fill[b] = 0
        first[i], offset[i] = b, fill[b]
        fill[b] += n
        if left := r - n:
            room[left].append(b)
            mask |= 1 << left
    return first, offset, np.array([fill[b] for b in first.tolist()], np.int64)


def _round(items: DataFrame, capacity: int) -> DataFrame:
    """(uid, length, batch) to (uid, bin, at, fill): bin is the uid of the bin's first item."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)  # the same bins whatever order the rows came in
        first, at, fill = best_fit(pdf["length"].to_numpy(), capacity)
        uid = pdf["uid"].to_numpy()
        return pd.DataFrame({"uid": uid, "bin": uid[first], "at": at, "fill": fill})

    return items.groupBy("batch").applyInPandas(run, "uid long, bin long, at long, fill long")


def pack(pieces: DataFrame, capacity: int = 4096, batch_items: int = BATCH_ITEMS) -> DataFrame:
    """``pieces`` (any columns, among them ``length`` from 1 to ``capacity``) with sequence_id and offset.

    Sequences are gapless from offset 0 and never longer than ``capacity``. Repeated rows are separate items. An
    empty table gives an empty result. Columns of ``pieces`` may have any name; one named sequence_id or offset is
    replaced. Merging ends with a single batch, or when a round leaves more than 95 % of its items: bins that
    best-fit can't join pairwise any more.
    """
    own = pieces.drop("sequence_id", "offset")
    with Scratch(pieces.sparkSession) as scratch:
        # the row as one column, so that no name of it meets a name used here
        rows = scratch(own.select(F.struct("*").alias("row"), F.col("length").alias("length"), F.monotonically_increasing_id().alias("uid")))
        items, rounds, level, before = rows.select("uid", "length"), [], 0, None
        while True:
            n = items.count()
            if n == 0 or before is not None and n > 0.95 * before:
                break
            batches = -(-n // batch_items)
            deal = F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(batches))
            done = scratch(_round(items.withColumn("batch", deal), capacity))
            rounds.append(done)
            if batches == 1:
                break
            # bins that may still take something go up
            least = items.agg(F.min("length")).first()[0]
            room = max(int(SLACK * capacity), least - 1)
            items = done.filter((F.col("at") == 0) & (F.col("fill") < capacity - room)).select("uid", F.col("fill").alias("length"))
            before, level = n, level + 1
        if not rounds:
            return written(rows.select("row.*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
        out = rows.join(rounds[0].select("uid", F.col("bin").alias("sequence_id"), F.col("at").alias("offset")), "uid")
        for up in rounds[1:]:
            up = up.select(F.col("uid").alias("sequence_id"), "bin", "at")
            out = out.join(up, "sequence_id", "left").withColumn("offset", F.col("offset") + F.coalesce("at", F.lit(0)))
            out = out.withColumn("sequence_id", F.coalesce("bin", "sequence_id")).drop("bin", "at")
        return written(out.select("row.*", "sequence_id", "offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, pieces, ids): the packed sequences themselves, from pieces that carry ``ids``."""
    one = F.struct("offset", "doc_id", "piece", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(one)).alias("p"))  # at most capacity pieces
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", "length", F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["offset"].alias("offset"), x["length"].alias("length"))).alias("pieces"), joined.alias("ids"))
