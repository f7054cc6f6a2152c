"""Token counts of documents in flat token files, by a scan for separators.

A flat file is nothing but ids, each document ended by the separator id. It has
no index. The scan deals each file as blocks of ``block`` ids; a block finds its
separators with one vectorised comparison. Ids take 16 bits where all of them fit, else 32. A prefix scan over a file's blocks,
the number of separators and the place of the last one before each block, then
stitches documents that cross blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omicspark.llm.encoders import id_kind, tiktoken_ids, tiktoken_ranks
from omicspark.llm.files import attempt_name, open_input, open_output
from omicspark.storage import bound_batches, materialize, new_path, spread

BLOCK = 1 << 20


def file_kind(path: str, end_id: int) -> np.dtype:
    """How flat files hold an id."""
    return id_kind(max(end_id, *tiktoken_ranks(path).values()))


def write_token_files(docs: DataFrame, path: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write each partition's texts as one flat file of ids; (file, ordinal, doc) of each document, doc being its id.

    The rows say which document stands where in which file, not where it begins.
    Ids are as wide as the greater of ``end_id`` and the ranks' last id needs.
    """
    bound_batches(docs.sparkSession)
    folder = new_path(docs.sparkSession, "flat")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = file_kind(path, end_id)
        ids, end = tiktoken_ids(path, pattern, width), np.array([end_id], dtype=width).tobytes()
        out, name, n = None, attempt_name(folder, TaskContext.get().partitionId()), 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                out = out or open_output(name)
                for text in batch.column(1).to_pylist():
                    out.write((ids(text) if text else b"") + end)
                yield pa.RecordBatch.from_arrays([pa.array([name] * batch.num_rows), pa.array(np.arange(n, n + batch.num_rows)), batch.column(0)], ["file", "ordinal", "doc"])
                n += batch.num_rows
        finally:
            if out:
                out.close()

    kind = docs.schema[id_col].dataType.simpleString()
    written = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("data")).mapInArrow(write, f"file string, ordinal long, doc {kind}")
    return materialize(written, "flat-names")


def _blocks(block: int, kind: np.dtype):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open_input(name) as f:
                    n = f.size() // kind.itemsize
                starts = np.arange(0, n, block)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(starts), pa.string()), pa.array(starts, pa.int64()), pa.array(np.minimum(block, n - starts), pa.int64())], ["file", "start", "n"])

    return rows


def _scan(end_id: int, kind: np.dtype):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                with open_input(name) as f:
                    ids = np.frombuffer(f.read_at(n * kind.itemsize, start * kind.itemsize), dtype=kind)
                ends = start + np.flatnonzero(ids == end_id)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([start]), pa.array([start + n]), pa.array([ends], pa.list_(pa.int64()))], ["file", "start", "stop", "ends"])

    return rows


def count_tokens(files: DataFrame, end_id: int, file_col: str = "file", block: int = BLOCK, kind: np.dtype = np.dtype("<u4")) -> DataFrame:
    """(file, ordinal, start, n_tokens) of every document in the flat files named in ``file_col``, whose ids are of ``kind``.

    Repeated names count once. n_tokens leaves the separator out; ids after a
    file's last separator are a document of their own; an empty file has none.
    """
    names = files.where(F.col(file_col).isNotNull()).select(F.col(file_col).alias("file")).distinct()
    blocks = names.mapInArrow(_blocks(block, kind), "file string, start long, n long")
    scanned = blocks.repartition(spread(files.sparkSession), "file", "start").mapInArrow(_scan(end_id, kind), "file string, start long, stop long, ends array<long>")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = scanned.select(
        "file",
        "stop",
        "ends",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("seen"),
        F.coalesce(F.max(F.array_max("ends")).over(before), F.lit(-1)).alias("last"),
        (F.lead("start").over(Window.partitionBy("file").orderBy("start")).isNull()).alias("final"),
    )
    open_end = F.coalesce(F.element_at(F.col("ends"), F.when(F.size("ends") > 0, -1)), F.col("last"))
    # A file that doesn't end with a separator ends with one past its last id.
    closed = placed.select("file", "seen", "last", F.when(F.col("final") & (open_end < F.col("stop") - 1), F.concat("ends", F.array("stop"))).otherwise(F.col("ends")).alias("ends"))
    paired = closed.select("file", "seen", F.posexplode(F.arrays_zip(F.concat(F.array("last"), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0)))).alias("begin"), F.col("ends").alias("end"))).alias("at", "span"))
    paired = paired.where("span.end IS NOT NULL")
    return paired.select("file", (F.col("seen") + F.col("at")).alias("ordinal"), (F.col("span.begin") + 1).alias("start"), (F.col("span.end") - F.col("span.begin") - 1).alias("n_tokens"))


def document_token_counts(docs: DataFrame, path: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, n_tokens) of every row: written to flat files, counted by the scan.

    Null and empty texts have 0 tokens; null and repeated ids keep their rows;
    an empty table gives no rows; other columns are ignored.
    """
    names = write_token_files(docs, path, pattern, end_id, id_col, text_col)
    counts = count_tokens(names, end_id, block=block, kind=file_kind(path, end_id))
    # A row a document on both sides, so neither may be broadcast, however small its files are.
    return names.hint("merge").join(counts, ["file", "ordinal"]).select(F.col("doc").alias(id_col), "n_tokens")
