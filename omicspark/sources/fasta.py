"""FASTA as tiles: a record of any length is read by as many tasks as its bytes need.

A file is cut into byte ranges wherever they fall, within lines and records too. Each
range tells how many bases it has before its first header, after its last one, and
in the rest of a line that it begins with; running sums over these counts, a row a
range, say to which record and place the bases of each range belong.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from omicspark.sources.readers import byte_parts, open_part
from omicspark.storage import materialize

_SPACE = b" \t\r\n\v\f"
_COUNTS = "file string, part bigint, lead bigint, free bigint, record bigint, seq_id string, descr string, tail bigint, head_end bigint"
_PIECES = "file string, part bigint, lead boolean, record bigint, seq_id string, descr string, at bigint, bases string"


def _walk(f, start: int, stop: int, size: int) -> Iterator[tuple]:
    """What begins in a range of a file, in order.

    (">", byte, line, end) for a header, whose line is read to its end wherever that
    is; ("lead", bases) for at most ``size`` bytes of a line begun before the range,
    which may be the rest of a header; ("bases", bases) for the same of sequence lines.
    """
    lead = False
    if start:
        f.seek(start - 1)
        lead = f.read(1) != b"\n"
    fresh, at = not lead, start
    while at < stop and (data := f.read(min(size, stop - at))):
        i, n = 0, len(data)
        while i < n:
            if lead:
                j = data.find(b"\n", i)
                end = n if j < 0 else j + 1
                yield "lead", data[i:end].translate(None, _SPACE)
                lead, fresh = j < 0, j >= 0
            elif fresh and data[i] == 62:  # >
                j = data.find(b"\n", i)
                end = n if j < 0 else j + 1
                line = data[i:end]
                if j < 0:
                    more = f.readline()
                    line, at = line + more, at + len(more)
                yield ">", at + i - (len(line) - (end - i)), line, at + end
            else:
                j = data.find(b"\n>", i)
                end = n if j < 0 else j + 1
                yield "bases", data[i:end].translate(None, _SPACE)
                fresh = data[end - 1] == 10
            i = end
        at += n


def _named(line: bytes) -> tuple[str, str]:
    """Id and description of a header line."""
    text = line.decode("utf-8", "replace")[1:].rstrip("\r\n")
    words = text.split(None, 1) if text[:1].strip() else ["", text]
    return (words[0] if words else ""), (words[1].strip() if len(words) > 1 else "")


class _FastaReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.size, self.piece = options["path"], int(options["partbytes"]), int(options["piecebytes"])
        self.counts = options["what"] == "counts"

    def partitions(self):
        return byte_parts(self.path, self.size)

    def read(self, part):
        stop = 1 << 62 if part.path.endswith(".gz") else part.stop
        with open_part(self.path, part) as f:
            walk = _walk(f, part.start, stop, self.piece)
            yield from self._count(part, walk) if self.counts else self._pieces(part, walk)

    def _count(self, part, walk):
        lead = free = tail = 0
        head = (None, None, None)
        head_end = None
        for kind, *rest in walk:
            if kind == ">":
                head, head_end, tail = (rest[0], *_named(rest[1])), rest[2], 0
            elif kind == "lead":
                lead += len(rest[0])
            elif head_end is None:
                free += len(rest[0])
            else:
                tail += len(rest[0])
        yield (part.path, part.start, lead, free, *head, tail, head_end)

    def _pieces(self, part, walk):
        """Rows rather than batches: each holds up to ``piece`` bases."""
        head, at, was = (None, None, None), 0, None
        for kind, *rest in walk:
            if kind == ">":
                head, at = (rest[0], *_named(rest[1])), 0
                yield (part.path, part.start, False, *head, 0, "")
                was = kind
                continue
            if kind == "bases" and was == "lead":
                at = 0
            if rest[0]:
                yield (part.path, part.start, kind == "lead", *head, at, rest[0].decode("ascii", "replace"))
            at, was = at + len(rest[0]), kind


class FastaDataSource(DataSource):
    @classmethod
    def name(cls):
        return "fasta_parts"

    def schema(self):
        return _COUNTS if self.options["what"] == "counts" else _PIECES

    def reader(self, schema):
        return _FastaReader(self.options)


def _carried(counts: DataFrame) -> DataFrame:
    """(file, part, skip, shift, before): for each range whether it begins in a header, the bases of its line's rest, and the record it begins in with the bases already read.

    A range without a header passes on what it got and its own bases.
    """
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    told = counts.withColumn("skip", F.coalesce(F.max("head_end").over(earlier) > F.col("part"), F.lit(False)))
    told = told.withColumn("shift", F.when(F.col("skip"), 0).otherwise(F.col("lead")))
    told = told.withColumn("sum", F.coalesce(F.sum(F.when(F.col("head_end").isNull(), F.col("shift") + F.col("free")).otherwise(0)).over(earlier), F.lit(0)))
    last = F.when(F.col("head_end").isNotNull(), F.struct("record", "seq_id", "descr", (F.col("tail") - F.col("sum")).alias("rest")))
    told = told.withColumn("last", F.last(last, ignorenulls=True).over(earlier))
    return told.select("file", "part", "skip", "shift", F.when(F.col("last").isNotNull(), F.struct("last.record", "last.seq_id", "last.descr", (F.col("last.rest") + F.col("sum")).alias("n"))).alias("before"))


def read_fasta_tiles(spark: SparkSession, path: str, tile: int = 1 << 16, part_bytes: int = 64 << 20) -> DataFrame:
    """(seq_id, descr, file, record, tile, bases) of the records of FASTA files, ``tile`` bases a row, the last of a record fewer.

    record: the byte in its file at which a record's header begins, so records with
    one id stay apart. tile counts from 0; a record without bases has one empty row.
    White space within sequences is left out, also line ends of two bytes; each byte
    beyond ASCII in a sequence is one replacement character. Text before the first
    header of a file is an error, blank lines there are none. Files are read twice,
    once for counts; bases move once, to the other pieces of their tile, and the
    result lies by (seq_id, tile). A compressed file is read by one task.
    """
    spark.dataSource.register(FastaDataSource)
    source = spark.read.format("fasta_parts").option("partBytes", part_bytes).option("pieceBytes", max(1 << 10, min(1 << 20, 8 * tile)))
    carried = materialize(_carried(source.option("what", "counts").load(path)), "fasta-parts")
    pieces = source.option("what", "pieces").load(path).join(carried, ["file", "part"])
    kept = pieces.where(~(F.col("lead") & F.col("skip")))
    own = F.col("record").isNotNull()
    of = lambda name: F.when(own, F.col(name)).when(F.col("before").isNull(), F.raise_error(F.concat(F.lit("text before the first header of "), F.col("file")))).otherwise(F.col(f"before.{name}"))
    start = F.when(own, F.col("at")).otherwise(F.col("at") + F.when(F.col("lead"), 0).otherwise(F.col("shift")) + F.col("before.n"))
    placed = kept.select("file", of("record").alias("record"), of("seq_id").alias("seq_id"), of("descr").alias("descr"), start.alias("start"), "bases")
    last = F.greatest(F.col("start"), F.col("start") + F.length("bases") - 1)
    dealt = placed.withColumn("tile", F.explode(F.sequence(F.expr(f"start div {int(tile)}"), F.floor(last / tile))))
    low = F.greatest(F.col("start"), F.col("tile") * tile)
    high = F.least(F.col("start") + F.length("bases"), (F.col("tile") + 1) * tile)
    cut = dealt.select("seq_id", "descr", "file", "record", "tile", low.alias("low"), F.substring("bases", (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias("bases"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("low", "bases"))), lambda x: x["bases"]), "")
    return cut.repartition("seq_id", "tile").groupBy("seq_id", "descr", "file", "record", "tile").agg(whole.alias("bases"))
