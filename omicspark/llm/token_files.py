"""Token ids as binary files: fixed-width bit packing in blocks, with random access.

A file is: the magic word; blocks of ``BLOCK`` ids, each id in as many bits as
the vocabulary needs, least significant first; the block offsets, the document
ids (and which are null) and the documents' lengths; a fixed-size trailer with
the width, the block size, the counts and where the index begins. Ids are packed
as they come, so a task holds one block and 17 bytes a document.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F, types as T

from omicspark.llm.encoders import IDS, hugging_units
from omicspark.llm.files import attempt_name, open_input, open_output
from omicspark.storage import bound_batches, materialize, new_path, spread

MAGIC = b"OMTOKEN1"
BLOCK = 1 << 13
_TRAILER = struct.Struct("<IIQQQQ8s")  # width, ids a block, ids, documents, blocks, where the index begins, magic


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each, least significant bit first, padded to whole bytes."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in (8, 16, 32):  # the same bytes, without going through bits
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=n).astype(IDS)
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype(IDS)


class TokenWriter:
    def __init__(self, uri: str, width: int, block: int = BLOCK):
        self._out, self._width, self._block = open_output(uri), width, block
        self._out.write(MAGIC)
        self._at, self._offsets, self._held = len(MAGIC), [], np.empty(0, dtype=IDS)
        self._docs, self._nulls, self._lengths, self.n_ids = [], [], [], 0

    def _flush(self, n: int) -> None:
        data = pack(self._held[:n], self._width)
        self._offsets.append(self._at)
        self._out.write(data)
        self._at += len(data)
        self._held = self._held[n:]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append(doc_id or 0)
        self._nulls.append(doc_id is None)
        self._lengths.append(len(ids))
        self.n_ids += len(ids)
        self._held = np.concatenate([self._held, ids])
        while len(self._held) >= self._block:
            self._flush(self._block)

    def close(self) -> None:
        if len(self._held):
            self._flush(len(self._held))
        for values, kind in ((self._offsets, "<u8"), (self._docs, "<i8"), (self._nulls, "u1"), (self._lengths, "<u8")):
            self._out.write(np.asarray(values, dtype=kind).tobytes())
        self._out.write(_TRAILER.pack(self._width, self._block, self.n_ids, len(self._docs), len(self._offsets), self._at, MAGIC))
        self._out.close()


class TokenReader:
    """Random access to a token file by id position."""

    def __init__(self, uri: str):
        self._file = open_input(uri)
        size = self._file.size()
        self.width, self.block, self.n_ids, self.n_docs, n_blocks, index, magic = _TRAILER.unpack(self._file.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != MAGIC or self._file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        raw, at = self._file.read_at(size - _TRAILER.size - index, index), 0
        found = []
        for n, kind in ((n_blocks, "<u8"), (self.n_docs, "<i8"), (self.n_docs, "u1"), (self.n_docs, "<u8")):
            found.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
            at += found[-1].nbytes
        offsets, self.doc_ids, self.nulls, self.lengths = found
        self._offsets = np.append(offsets, index).astype(np.int64)

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start``: only the blocks that hold them are read."""
        n = max(0, min(n, self.n_ids - start))
        if not n:
            return np.empty(0, dtype=IDS)
        first, last = start // self.block, (start + n - 1) // self.block
        raw = self._file.read_at(int(self._offsets[last + 1] - self._offsets[first]), int(self._offsets[first]))
        parts = [unpack(raw[self._offsets[b] - self._offsets[first] : self._offsets[b + 1] - self._offsets[first]], min(self.block, self.n_ids - b * self.block), self.width) for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block :][:n]

    def close(self) -> None:
        self._file.close()


def write_token_files(docs: DataFrame, path: str, vocabulary: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, end it with ``end_id`` and write ids in ascending order of ``id_col``.

    Gives (file, part, n_docs, n_ids, base): a row a file, in order of part; base
    is the number of ids in the files before. Null ids come first; rows of one id stand
    together, by a hash of their columns, in as many files as they need. path: a
    tokenizer that drops white space. Null and empty texts are their end id alone. An
    empty table gives no files.
    """
    bound_batches(docs.sparkSession)
    folder = new_path(docs.sparkSession, "packed")
    width = width_of(vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, part, end = hugging_units(path), TaskContext.get().partitionId(), np.array([end_id], dtype=IDS).tobytes()
        out, n, name = None, 0, attempt_name(folder, part)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = out or TokenWriter(name, width)
                out.add(doc_id, np.frombuffer(units.encode(text or b"") + end, dtype=IDS))
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int32()), pa.array([n]), pa.array([out.n_ids])], ["file", "part", "n_docs", "n_ids"])

    # One id may hold a large part of the rows, so ranges go on within it.
    told = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("data"), told.alias("told"))
    ordered = rows.repartitionByRange("doc_id", "told").sortWithinPartitions("doc_id", "told").select("doc_id", "data")
    files = materialize(ordered.mapInArrow(write, "file string, part int, n_docs long, n_ids long"), "packed-names")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return materialize(files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "packed-files")


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            reader = TokenReader(name)
            starts = np.concatenate([[0], np.cumsum(reader.lengths.astype(np.int64))])
            doc = 0
            while doc < reader.n_docs:  # some documents at a time, about 64 blocks
                stop = max(doc + 1, int(np.searchsorted(starts, starts[doc] + 64 * reader.block, side="right")) - 1)
                ids = reader.read(int(starts[doc]), int(starts[stop] - starts[doc]))
                offsets = (starts[doc : stop + 1] - starts[doc]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.doc_ids[doc:stop], mask=reader.nulls[doc:stop].astype(bool)), pa.array(base + starts[doc:stop]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))],
                    ["doc_id", "start", "ids"],
                )
                doc = stop
            reader.close()


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document in the files that ``write_token_files`` gave, read from them."""
    parts = spread(files.sparkSession, files.count())
    return files.select("file", "base").repartition(parts, "file").mapInArrow(_read_documents, "doc_id long, start long, ids array<int>")


def crc32_of(ids: pa.Array) -> pa.Array:
    """crc32 of each list of ids as little-endian unsigned 32-bit integers."""
    flat, ends = ids.flatten().to_numpy(zero_copy_only=False).astype(IDS), ids.offsets.to_numpy() - ids.offsets[0].as_py()
    return pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])], pa.int64())


def ids_crc32(col: str):
    """crc32_of as a column."""
    return F.arrow_udf(crc32_of, T.LongType())(F.col(col))
