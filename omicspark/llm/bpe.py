"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text over ``chunk + overlap`` bytes is cut into chunks that overlap; each is a
row of its own, pre-tokenised and encoded in parallel with the others. A chunk
may begin within a pre-token, so its first boundaries can be wrong, but what
follows a boundary depends only on the text after it: at the first boundary that
a chunk and its predecessor both find in their overlap the two agree from there
on. There they are stitched; ids of pre-tokens before it come from the
predecessor, the rest from the chunk. BPE never crosses a pre-token, so each
pre-token is encoded in the chunk that found it, and the text moves once. A text
without a common boundary in some overlap is encoded in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T

from omicspark.llm.encoders import IDS, tiktoken_ids, tiktoken_pieces, tiktoken_ranks
from omicspark.storage import bound_batches, materialize

CHUNK = 1 << 14
OVERLAP = 1 << 10


def _id_lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // IDS.itemsize for p in packed], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype=IDS).astype(np.int32)))


def _encode_column(path: str, pattern: str):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        ids = tiktoken_ids(path, pattern)
        return _id_lists([ids(t) if t else b"" for t in texts.to_pylist()])

    return encode


@lru_cache(maxsize=4)
def _pieces(path: str) -> pa.Array:
    """The bytes of each id, in order of ids; null where an id is not used."""
    ranks = tiktoken_ranks(path)
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        table[i] = piece
    return pa.array(table, pa.large_binary())


def decode_lists(ids: pa.Array, path: str) -> pa.Array:
    """The bytes of each list of ids: those of all ids side by side, cut where lists end."""
    flat = _pieces(path).take(ids.flatten())
    if flat.null_count:
        raise ValueError("an id is not in the vocabulary")
    sizes = np.diff(np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset : flat.offset + len(flat) + 1])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    lists = np.concatenate([[0], np.cumsum(np.nan_to_num(pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64))])
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends[lists].astype(np.int64).tobytes()), flat.buffers()[2] if len(flat) else pa.py_buffer(b"")])
    return pc.if_else(pc.is_valid(ids), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def _decode_column(path: str):
    return F.arrow_udf(lambda ids: decode_lists(ids, path), T.BinaryType())


def _char_start(data: bytes, at: int) -> int:
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def cut(data: bytes, chunk: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, start of the next chunk, end) of each chunk, on character boundaries; the next start is -1 for the last."""
    found, start = [], 0
    while len(data) - start > chunk + overlap:
        after = _char_start(data, start + chunk)
        found.append((start, after, _char_start(data, after + overlap)))
        start = after
    return [*found, (start, -1, len(data))]


def _cut_rows(chunk: int, overlap: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = cut(data, chunk, overlap)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uid] * len(spans)), pa.array(range(len(spans)), pa.int32()), pa.array([s for s, _, _ in spans]), pa.array([n for _, n, _ in spans]), pa.array([data[s:e] for s, _, e in spans], pa.binary())],
                    ["uid", "k", "start", "after", "data"],
                )

    return rows


def _places(data: bytes) -> np.ndarray:
    """Of each byte of the text with U+FFFD for what is no UTF-8, and of its end, the place of the bytes that stand there."""
    parts, at = [], 0
    while at < len(data):
        try:
            data[at:].decode()
            start = end = len(data)
        except UnicodeDecodeError as e:
            start, end = at + e.start, at + e.end
        parts.append(np.arange(at, start))
        if start < end:
            parts.append(np.full(3, start))
        at = end
    return np.concatenate([*parts, [len(data)]]).astype(np.int64)


_MARKS = "head array<long>, head_ids array<int>, tail array<long>, tail_ids array<int>"


def encode_chunk(data: bytes, start: int, after: int, overlap: int, path: str, pattern: str) -> tuple:
    """Ids of a chunk; its boundaries in both overlaps, each with the number of ids before it.

    A byte that is no UTF-8 counts as U+FFFD, which is three bytes: places are those of the bytes that stand there.
    """
    known = tiktoken_pieces(path, pattern)
    text = data.decode("utf-8", "replace")
    pieces = [p.encode() for p in regex.findall(pattern, text)]
    packed = list(map(known.__getitem__, pieces))
    at = np.cumsum([0] + [len(p) for p in pieces])[:-1]
    at = start + (at if "\ufffd" not in text else _places(data)[at])
    before = np.cumsum([0] + [len(p) // IDS.itemsize for p in packed])[:-1]
    head = at < start + overlap
    tail = at >= after if after >= 0 else np.zeros(len(at), dtype=bool)
    return b"".join(packed), at[head], before[head], at[tail], before[tail]


def _encode_chunks(path: str, pattern: str, overlap: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [encode_chunk(d, s, a, overlap, path, pattern) for s, a, d in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([o[i + 1] for o in out], t) for i, t in enumerate((longs, ints, longs, ints))), _id_lists([o[0] for o in out])],
                ["uid", "k", "head", "head_ids", "tail", "tail_ids", "ids"],
            )

    return rows


def _stitched(chunks: DataFrame) -> DataFrame:
    """(uid, ids, whole): ids of each text from its chunks; whole is false if some overlap has no common boundary."""
    order = Window.partitionBy("uid").orderBy("k")
    seen = chunks.withColumns(
        {
            "first": F.lag("k").over(order).isNull(),
            "last": F.lead("k").over(order).isNull(),
            "from": F.get(F.array_intersect(F.lag("tail").over(order), "head"), 0),
            "to": F.get(F.array_intersect("tail", F.lead("head").over(order)), 0),
        }
    )
    number = lambda marks, ids, at: F.get(F.col(ids), (F.array_position(marks, F.col(at)) - 1).cast("int"))
    spans = seen.select(
        "uid",
        "k",
        F.when(F.col("first"), 0).otherwise(number("head", "head_ids", "from")).alias("skip"),
        F.when(F.col("last"), F.size("ids")).otherwise(number("tail", "tail_ids", "to")).alias("stop"),
        "ids",
    )
    sound = F.col("skip").isNotNull() & F.col("stop").isNotNull() & (F.col("skip") <= F.col("stop"))
    parts = spans.select("uid", sound.alias("sound"), F.struct("k", F.when(sound, F.slice("ids", F.col("skip") + 1, F.greatest(F.col("stop") - F.col("skip"), F.lit(0)))).alias("ids")).alias("part"))
    return parts.groupBy("uid").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["ids"])).alias("ids"),
        F.bool_and("sound").alias("whole"),
    )


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``keep`` columns and ids array<int>: the ids of every whole text, without special tokens.

    path: ranks in tiktoken's form; pattern: the pre-token pattern. Null and
    empty texts have no ids. Rows are told apart by where they stand in the
    table, so repeated and null ids and repeated texts are fine. An empty table
    gives no rows. Texts up to chunk + overlap bytes don't move.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text_col).cast("binary").alias("data"))
    of = _encode_column(path, pattern)
    is_long = F.coalesce(F.octet_length("data"), F.lit(0)) > chunk + overlap
    short = rows.where(~is_long).select("kept.*", of("data").alias("ids"))
    # Written once with its number, as another evaluation could number rows otherwise.
    long = materialize(rows.where(is_long).withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    cut_up = long.select("uid", "data").mapInArrow(_cut_rows(chunk, overlap), "uid long, k int, start long, after long, data binary")
    coded = cut_up.repartition("uid", "k").mapInArrow(_encode_chunks(path, pattern, overlap), f"uid long, k int, {_MARKS}, ids array<int>")
    stitched = materialize(_stitched(coded), "stitched")
    joined = long.select("uid", "kept").join(stitched.where("whole").select("uid", "ids"), "uid").select("kept.*", "ids")
    out = short.unionByName(joined)
    broken = stitched.where("NOT whole").select("uid")
    if not broken.isEmpty():
        out = out.unionByName(long.join(broken, "uid", "left_semi").select("kept.*", of("data").alias("ids")))
    return out


def decode(ids: Column | str, path: str) -> Column:
    """The bytes of a column of ids: the raw bytes of each, put together. Null stays null."""
    return _decode_column(path)(F.col(ids) if isinstance(ids, str) else ids)
