"""Packing documents into windows of a fixed number of tokens.

Each document's ids are cut into full windows and a rest. The lengths of all
pieces make a histogram of at most ``window`` counts; from it alone the driver
plans which lengths share a window (``packing_plan``): non-negative least squares
over combinations of up to three lengths that fill it, rounded, then greedy for
the rest. A plan's row says where pieces of one length with a range of ranks go,
so its size doesn't grow with the number of pieces. Ranks come from the counts of
each (writing task, length): no sort, and no task sees all pieces of a length. What
comes before a task's pieces is a small file in the shared folder, read by whoever
places them, so neither pieces nor counts are shuffled or broadcast at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omicspark.llm.encoders import IDS, hugging_units, id_kind
from omicspark.llm.files import open_input, publish
from omicspark.llm.packing_plan import plan_packing
from omicspark.storage import bound_batches, materialize, new_path

WINDOW = 2048


def _cut_pieces(path: str, end_id: int, window: int, small: np.dtype):
    """Pieces of each (row, bytes) row, ranked among the task's pieces of their length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = hugging_units(path).encode, np.array([end_id], dtype=IDS).tobytes()
        task, seen = TaskContext.get().partitionId(), np.zeros(window + 1, dtype=np.int64)
        for batch in batches:
            kept, texts = batch.column(0), batch.column(1).to_pylist()
            for low in range(0, len(texts), 256):
                packed = [encode(text) + end if text else end for text in texts[low : low + 256]]
                total = np.array([len(p) for p in packed]) // IDS.itemsize
                n = -(-total // window)
                take = np.repeat(np.arange(len(n)), n)
                start = (np.arange(len(take)) - np.repeat(np.cumsum(n) - n, n)) * window
                size = np.minimum(window, total[take] - start)
                # Pieces of a document, and documents, follow each other without gaps.
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32) * small.itemsize
                data = pa.BinaryArray.from_buffers(pa.binary(), len(take), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.frombuffer(b"".join(packed), dtype=IDS).astype(small).tobytes())])
                order = np.argsort(size, kind="stable")
                run = np.flatnonzero(np.diff(size[order], prepend=-1))
                within = np.arange(len(order)) - np.repeat(run, np.diff(np.append(run, len(order))))
                rank = np.empty(len(order), dtype=np.int64)
                rank[order] = within + seen[size[order]]
                np.add.at(seen, size, 1)
                yield pa.RecordBatch.from_arrays(
                    [kept.take(pa.array(take + low)), pa.array(start, pa.int64()), pa.array(size, pa.int32()), pa.array(total[take], pa.int64()), pa.array(np.full(len(take), task, np.int32)), pa.array(rank), data],
                    ["kept", "start", "length", "doc_tokens", "task", "rank", "data"],
                )

    return rows


def _write_bases(folder: str, window: int):
    """A file a task: for each length, the number of such pieces in all tasks before."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task, lengths, bases in zip(*(c.to_pylist() for c in batch.columns)):
                table = np.zeros(window + 1, dtype="<i8")
                table[lengths] = bases
                publish(table.tobytes(), f"{folder}/{task:08d}")
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["task"])

    return rows


def _ranks(task: np.ndarray, length: np.ndarray, rank: np.ndarray, bases: dict[int, np.ndarray], folder: str) -> np.ndarray:
    """Ranks among all pieces of a length, from those within a task."""
    out = rank.copy()
    for t in np.unique(task).tolist():
        if t not in bases:
            if len(bases) >= 64:
                bases.clear()
            with open_input(f"{folder}/{t:08d}") as f:
                bases[t] = np.frombuffer(f.read(), dtype="<i8")
        own = task == t
        out[own] += bases[t][length[own]]
    return out


def _place(plan, small: np.dtype, folder: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases: dict[int, np.ndarray] = {}
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            task, length, own_rank = (col[n].to_numpy(zero_copy_only=False) for n in ("task", "length", "rank"))
            rank = _ranks(task, length, own_rank, bases, folder)
            row, part = plan.place(length, rank)
            start, size = plan.start[part], plan.size[part]
            data = col["data"]
            at = np.frombuffer(data.buffers()[1], dtype=np.int32)[data.offset : data.offset + len(data)] // small.itemsize
            flat = np.frombuffer(data.buffers()[2] or b"", dtype=small)
            ends = np.concatenate([[0], np.cumsum(size)])
            ids = flat[np.repeat(at[row] + start - ends[:-1], size) + np.arange(ends[-1])]
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [col["kept"].take(own), pa.array(col["start"].to_numpy(zero_copy_only=False)[row] + start), pa.array(size), col["doc_tokens"].take(own), pa.array(plan.shift[part] + rank[row]), pa.array(plan.offset[part]), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                ["kept", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return rows


def pack(docs: DataFrame, path: str, end_id: int, vocabulary: int, window: int = WINDOW, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, start, length, doc_tokens, sequence_id, offset and ids of every piece.

    path: a tokenizer whose pre-tokens may begin with white space. A document is
    its ids and ``end_id``: null and empty texts are one id. Every id is in one
    piece; offsets of a sequence have no gaps from 0. All sequences are full but
    the last few, whose lengths are powers of two. Repeated rows and null ids are
    documents of their own; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    small = id_kind(max(vocabulary - 1, end_id))
    source = docs.select(F.struct(*keep).alias("kept"), F.col(text_col).cast("binary").alias("data"))
    kept = source.schema["kept"].dataType.simpleString()
    pieces = materialize(source.mapInArrow(_cut_pieces(path, end_id, window, small), f"kept {kept}, start long, length int, doc_tokens long, task int, rank long, data binary"), "pieces")
    counts = materialize(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(window + 1, dtype=np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row a length
        histogram[r["length"]] = r["n"]
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    folder = new_path(docs.sparkSession, "piece-bases")
    each = bases.groupBy("task").agg(F.collect_list("length").alias("lengths"), F.collect_list("base").alias("bases"))  # at most a value a length
    materialize(each.mapInArrow(_write_bases(folder, window), "task int"), "piece-base-tasks")
    placed = pieces.mapInArrow(_place(plan_packing(histogram, window), small, folder), f"kept {kept}, start long, length long, doc_tokens long, sequence_id long, offset long, ids array<int>")
    return placed.select("kept.*", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
