"""BPE encoding that encodes content-defined chunks once and reuses them across documents.

A rolling hash over the last 32 bytes cuts texts where the content says so, so equal
passages give equal chunks wherever they stand. A chunk that more than one place
holds is encoded in one of them, and its ids go to all of them; what no other place
holds is encoded where it is. A cut can fall within a word, so what was encoded on
either side of a join is repaired: the bytes around it are encoded again, from a
boundary of words on the left to one on the right, and the window grows until its
first and last word have exactly the ids that they had before.

For tokenizers that drop white space, whose words are encoded by themselves.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from omicspark.llm.encoders import IDS, hugging_units
from omicspark.llm.rows import row_key
from omicspark.storage import bound_batches, materialize

MEAN, LEAST, MOST = 1 << 10, 1 << 7, 1 << 14  # bytes of a chunk
WINDOW = 32
_BLOCK = 1 << 22
_MARKS = 4  # boundaries of words kept at either end of what was encoded
# Where a word begins after white space; no token holds both sides of it.
_BOUNDARY = re.compile(rb"[ \t-\r](?=[^ \t-\r])")
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], dtype=np.uint32)

_ENCODED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("marks", T.ArrayType(T.IntegerType()))])


def _candidates(data: np.ndarray, mean: int) -> np.ndarray:
    """Places after which a text may be cut: where the rolling hash of the WINDOW bytes up to there has its high bits clear."""
    found = []
    for begin in range(0, len(data), _BLOCK):
        low = max(0, begin - WINDOW + 1)
        h = _GEAR[data[low : begin + _BLOCK]]
        span = 1
        while span < WINDOW:  # the hash of 2n bytes from two of n
            wider = h.copy()
            wider[span:] += h[:-span] << np.uint32(span)
            h, span = wider, 2 * span
        at = np.flatnonzero(h < np.uint32((1 << 32) // mean)) + low
        found.append(at[at >= begin])
    return np.concatenate(found) + 1 if found else np.empty(0, dtype=np.int64)


def cut(data: bytes, mean: int = MEAN, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of a text; each has ``least`` to ``most`` bytes (the last may have fewer), and ends with a character."""
    places = _candidates(np.frombuffer(data, dtype=np.uint8), mean).tolist() if len(data) > least else []
    ends, start, n = [], 0, len(data)
    while n - start > least:
        i = bisect_left(places, start + least)
        end = min(places[i] if i < len(places) else n, start + most, n)
        while end < n and data[end] & 0xC0 == 0x80:
            end += 1
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def _chunk_rows(mean: int, least: int, most: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, starts, sizes, keys = [], [], [], []
            for uid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = 0
                for end in cut(data, mean, least, most) if data else ():
                    uids.append(uid)
                    starts.append(start)
                    sizes.append(end - start)
                    keys.append(hashlib.blake2b(data[start:end], digest_size=16).digest())
                    start = end
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.binary()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int32()), pa.array(keys, pa.binary())], ["uid", "start", "size", "key"])

    return rows


def encode_span(data: bytes, path: str) -> tuple[bytes, list[int]]:
    """Packed ids of bytes by themselves, and marks: (place, ids before it) of the first and last boundaries of words, one after the other."""
    encode = hugging_units(path).encode
    head = []
    for m in _BOUNDARY.finditer(data):
        head.append(m.start())
        if len(head) == 2 * _MARKS:
            break
    places = head
    if len(head) == 2 * _MARKS:
        low = max(len(data) - 512, head[_MARKS - 1] + 1)
        tail = [m.start() + low for m in _BOUNDARY.finditer(data[low:])]
        if len(tail) < _MARKS:
            low = head[_MARKS - 1] + 1
            tail = [m.start() + low for m in _BOUNDARY.finditer(data[low:])]
        places = head[:_MARKS] + tail[-_MARKS:]
    parts, marks, n = [], [], 0
    for a, b in zip([0, *places], [*places, len(data)]):
        parts.append(encode(data[a:b]))
        n += len(parts[-1]) // IDS.itemsize
        marks += [b, n]
    return b"".join(parts), marks[:-2]


class _Span:
    """What was encoded from a range of a text: its ids, and the places of its marks in the text."""

    def __init__(self, start: int, end: int, ids: bytes, marks: list[int]):
        self.start, self.end, self.ids = start, end, ids
        self.places, self.before = [start + m for m in marks[::2]], marks[1::2]

    def part(self, low: int, high: int) -> bytes:
        return self.ids[low * IDS.itemsize : high * IDS.itemsize]


def _spans(data: bytes, borrowed: list[tuple[int, int, bytes, list[int]]], path: str) -> list[_Span]:
    """Spans of a whole text, each with two boundaries of words at least, if the text has so many.

    A borrowed chunk without them counts as bytes that nobody has encoded.
    """
    known = {start: (start + size, ids, marks) for start, size, ids, marks in borrowed if len(marks) >= 4}
    starts = sorted(known)
    spans, at, n = [], 0, len(data)
    while at < n:
        if at in known:
            end, ids, marks = known[at]
            spans.append(_Span(at, end, ids, marks))
            at = end
            continue
        i = bisect_right(starts, at)
        end = starts[i] if i < len(starts) else n
        ids, marks = encode_span(data[at:end], path)
        if len(marks) < 4 and end < n:  # with the chunk after it
            end = known[end][0]
            ids, marks = encode_span(data[at:end], path)
        if len(marks) < 4 and spans:  # with what is before it
            at = spans.pop().start
            ids, marks = encode_span(data[at:end], path)
        spans.append(_Span(at, end, ids, marks))
        at = end
    return spans


def assemble(data: bytes, borrowed: list[tuple[int, int, bytes, list[int]]], path: str) -> bytes:
    """Packed ids of a whole text of which some chunks (start, size, ids, marks) have been encoded elsewhere."""
    encode = hugging_units(path).encode
    if not borrowed:
        return encode(data)
    first, *rest = _spans(data, borrowed, path)
    # done: ids up to the place ``upto``; those of the last span count from its id ``skip`` on.
    done, last, skip, upto = [], first, 0, 0
    for span in rest:
        found = _repair(data, last, skip, span, encode)
        if found is None:  # no boundary agrees: the two are one span, encoded again
            last = _Span(upto, span.end, *encode_span(data[upto : span.end], path))
            skip = 0
            continue
        low, ids, high, place = found
        done += [last.part(skip, low), ids]
        last, skip, upto = span, high, place
    done.append(last.part(skip, len(last.ids)))
    return b"".join(done)


def _repair(data: bytes, left: _Span, skip: int, right: _Span, encode) -> tuple[int, bytes, int, int] | None:
    """Encode across a join until what is found agrees with both sides.

    Gives the number of the left's ids that stay, the ids after them, the number of
    the right's ids that these replace, and the place up to which they go; None if the
    marks end before there is agreement.
    """
    mine = [(p, n) for p, n in zip(left.places, left.before) if n >= skip]
    yours = list(zip(right.places, right.before))
    if len(mine) < 2 or len(yours) < 2:
        return None
    for width in range(1, max(len(mine), len(yours))):
        i, j = max(0, len(mine) - 1 - width), min(width, len(yours) - 1)
        (p, n), (q, m) = mine[i], yours[j]
        ids, first, final = encode(data[p:q]), left.part(n, mine[i + 1][1]), right.part(yours[j - 1][1], m)
        if len(ids) >= len(first) + len(final) and ids.startswith(first) and ids.endswith(final):
            return n, ids, m, q
    return None


def _squeezed():
    """Texts as they go through the shuffle. Null stays null."""

    @F.arrow_udf(T.BinaryType())
    def squeezed(texts: pa.Array) -> pa.Array:
        compress = zstandard.ZstdCompressor(level=1).compress
        return pa.array([compress(t) if t else t for t in texts.to_pylist()], pa.binary())

    return squeezed


def _whole_texts(squeezed: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(t) if t else b"" for t in squeezed.to_pylist()]


def _publish(path: str):
    """The encoded chunks of a text that other places want; kept columns come along so that the shuffle of texts is one."""

    @F.arrow_udf(T.ArrayType(_ENCODED))
    def published(texts: pa.Array, wanted: pa.Array, kept: pa.Array) -> pa.Array:
        out = []
        for data, spans in zip(_whole_texts(texts), wanted.to_pylist()):
            found = [encode_span(data[s["start"] : s["start"] + s["size"]], path) for s in spans]
            out.append([{"ids": ids, "marks": marks} for ids, marks in found])
        return pa.array(out, pa.list_(pa.struct([("ids", pa.binary()), ("marks", pa.list_(pa.int32()))])))

    return published


def _id_lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // IDS.itemsize for p in packed], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype=IDS).astype(np.int32)))


def _assembled(path: str):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def whole(texts: pa.Array, borrowed: pa.Array) -> pa.Array:
        return _id_lists([assemble(d, [(b["start"], b["size"], b["encoded"]["ids"], b["encoded"]["marks"]) for b in own or ()], path) if d else b"" for d, own in zip(_whole_texts(texts), borrowed.to_pylist())])

    return whole


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), mean: int = MEAN, least: int = LEAST, most: int = MOST) -> DataFrame:
    """``keep`` columns and ids array<int>: the ids of every whole text, without special tokens.

    path: a tokenizer file whose tokenizer drops white space. Null and empty texts
    have no ids. Rows are known by a digest of id and text, so repeated rows, null ids
    and ties are fine; rows of one id and text are one to the count of chunks. An empty
    table gives no rows. Texts move once; with them go the ids of their shared
    chunks. A text and its ids are one row.
    """
    bound_batches(docs.sparkSession)
    data = F.col(text_col).cast("binary")
    rows = docs.select(row_key(id_col, text_col).alias("uid"), F.struct(*keep).alias("kept"), _squeezed()(data).alias("data")).where("uid IS NOT NULL")
    texts = docs.where(F.octet_length(data) > 0).select(row_key(id_col, text_col).alias("uid"), data.alias("data"))
    chunks = materialize(texts.mapInArrow(_chunk_rows(mean, least, most), "uid binary, start long, size int, key binary").distinct(), "chunks")
    shared = chunks.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("uid", "start", "size")).alias("at")).where("n > 1")
    wanted = shared.groupBy("at.uid").agg(F.collect_list(F.struct("at.start", "at.size", "key")).alias("wanted"))  # chunks of one text
    asked = rows.join(wanted.hint("merge"), "uid")
    told = asked.select("wanted", _publish(path)("data", "wanted", "kept").alias("encoded")).select(F.explode(F.arrays_zip(F.col("wanted.key").alias("key"), "encoded")).alias("c"))
    once = told.groupBy("c.key").agg(F.first("c.encoded").alias("encoded"))  # repeated rows publish the same
    borrowed = chunks.join(once.hint("merge"), "key").groupBy("uid").agg(F.collect_list(F.struct("start", "size", "encoded")).alias("borrowed"))
    return rows.join(borrowed.hint("merge"), "uid", "left").select("kept.*", _assembled(path)("data", "borrowed").alias("ids"))


@lru_cache(maxsize=4)
def _tokens(path: str) -> pa.Array:
    """Each id's token and a space, in order of ids; null where an id is not used."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    table: list[bytes | None] = [None] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        table[i] = token.encode() + b" "
    return pa.array(table, pa.large_binary())


def decode_lists(ids: pa.Array, path: str) -> pa.Array:
    """What the library's own decoding gives for a file without a decoder: tokens, special ones included, joined by spaces."""
    flat = _tokens(path).take(ids.flatten())
    if flat.null_count:
        raise ValueError("an id is not in the vocabulary")
    ends = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset : flat.offset + len(flat) + 1]
    lists = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    text = memoryview(flat.buffers()[2]) if len(flat) else memoryview(b"")
    found = [bytes(text[ends[a] : ends[b] - 1]) if b > a else b"" for a, b in zip(lists[:-1], lists[1:])]
    return pa.array([f if there else None for f, there in zip(found, pc.is_valid(ids).to_pylist())], pa.binary())


def decode(ids: Column | str, path: str) -> Column:
    """The decoded text of a column of ids, as bytes. Null stays null."""
    return F.arrow_udf(lambda own: decode_lists(own, path), T.BinaryType())(F.col(ids) if isinstance(ids, str) else ids)
