"""Readers of sequencing, annotation and hit files as DataFrames."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from omicspark.functions.text import attributes

# The column names of the formats.
GFF = "seqid STRING, source STRING, type STRING, start BIGINT, `end` BIGINT, score STRING, strand STRING, phase STRING, attributes STRING"
BED = ("chrom", "start", "end", "name", "score", "strand")
SAM = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
REFGENE = "bin INT, name STRING, chrom STRING, strand STRING, tx_start BIGINT, tx_end BIGINT, cds_start BIGINT, cds_end BIGINT, exon_count INT, exon_starts STRING, exon_ends STRING, id STRING, name2 STRING, cds_start_stat STRING, cds_end_stat STRING, exon_frames STRING"
DOMAINS = "acc STRING, md5 STRING, seqlen INT, analysis STRING, analysis_id STRING, analysis_desc STRING, start INT, stop INT, score STRING, status STRING, date STRING, ipr_id STRING, ipr_desc STRING, gos STRING, paths STRING"
TABULAR_HITS = "query STRING, hit STRING, identity DOUBLE, length INT, mismatches INT, gaps INT, q_start INT, q_end INT, s_start INT, s_end INT, evalue DOUBLE, bits DOUBLE"
DUPLEX = "target STRING, target_length INT, query STRING, query_length INT, energy DOUBLE, pvalue DOUBLE, position INT, line1 STRING, line2 STRING, line3 STRING, line4 STRING"


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(seq_id, descr, seq) of records that begin with ``>``; white space within sequences is left out."""
    raw = spark.read.option("lineSep", "\n>").text(path).where("trim(value) <> ''")
    whole = raw.select(F.regexp_replace("value", "^>", "").alias("v"))
    head, body = F.substring_index("v", "\n", 1), F.expr("substring(v, length(substring_index(v, '\n', 1)) + 2)")
    return whole.select(F.regexp_extract(head, r"^(\S*)", 1).alias("seq_id"), F.trim(F.regexp_extract(head, r"^\S*\s*(.*)$", 1)).alias("descr"), F.regexp_replace(body, r"\s", "").alias("seq"))


_FASTQ_ROWS = 4096


class BytePart(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


def byte_parts(uri: str, size: int) -> list[BytePart]:
    """The files of a path in ranges of ``size`` bytes; a compressed file can't be entered midway and is one. Without bytes one part of no file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
    info = store.get_file_info(path)
    files = store.get_file_info(fs.FileSelector(path)) if info.type == fs.FileType.Directory else [info]
    parts = []
    for f in files:
        if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")):
            step = f.size if f.extension == "gz" else size
            parts += [BytePart(f.path, s, min(s + step, f.size)) for s in range(0, f.size, max(1, step))]
    return parts or [BytePart("", 0, 0)]


def open_part(uri: str, part: BytePart) -> io.BufferedReader:
    """The file of a part, decompressed."""
    from pyarrow import fs

    if not part.path:
        return io.BufferedReader(io.BytesIO())
    store, _ = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), "")
    return io.BufferedReader(store.open_input_stream(part.path) if part.path.endswith(".gz") else store.open_input_file(part.path), 1 << 20)


class _FastqReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.size, self.skip = options["path"], int(options.get("partbytes", 64 << 20)), options.get("badrecords", "fail") == "skip"

    def partitions(self):
        return byte_parts(self.path, self.size)

    def read(self, part):
        """Arrow batches of the records that begin in the part.

        A record is four lines, the first with ``@``, the third with ``+``, bases and
        qualities of one length. A part that begins within a record leaves out its
        rest, at most three lines. Anything else that is no record is an error, or
        with the option badRecords=skip left out line by line. Blank lines between records are borne.
        """
        from pyarrow import RecordBatch

        gz = part.path.endswith(".gz")
        midway = 3 if not gz and part.start else 0  # lines that may belong to a record begun before
        held: list[tuple[str, str, str, str]] = []
        names = ["read_id", "descr", "seq", "qual"]
        with open_part(self.path, part) as f:
            at = 0
            if midway:
                f.seek(part.start - 1)
                at = part.start - 1 + len(f.readline())
            lines: list[tuple[int, str]] = []
            while True:
                while len(lines) < 4 and (raw := f.readline()):
                    text = raw.decode("utf-8", "replace").rstrip("\r\n")
                    if lines or text:
                        lines.append((at, text))
                    at += len(raw)
                if not lines or (not gz and lines[0][0] >= part.stop):
                    break
                head, seq, plus, qual = [t for _, t in lines] if len(lines) == 4 else ("", "", "", "")
                if head.startswith("@") and plus.startswith("+") and len(seq) == len(qual):
                    name, _, descr = head[1:].partition(" ")
                    held.append((name, descr, seq, qual))
                    lines, midway = [], 0
                    if len(held) == _FASTQ_ROWS:
                        yield RecordBatch.from_arrays(list(map(list, zip(*held))), names)
                        held = []
                elif midway or self.skip:
                    midway = max(0, midway - 1)
                    del lines[0]
                else:
                    raise ValueError(f"no FASTQ record at byte {lines[0][0]} of {part.path}: {lines[0][1][:80]}")
        if held:
            yield RecordBatch.from_arrays(list(map(list, zip(*held))), names)


class FastqDataSource(DataSource):
    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return "read_id string, descr string, seq string, qual string"

    def reader(self, schema):
        return _FastqReader(self.options)


def read_fastq(spark: SparkSession, path: str, part_bytes: int = 64 << 20, bad_records: str = "fail") -> DataFrame:
    """(read_id, descr, seq, qual). A large file is read in parts of ``part_bytes``, each from the first whole record.

    bad_records: ``fail`` at what is no record, or ``skip`` it.
    """
    spark.dataSource.register(FastqDataSource)
    return spark.read.format("fastq").option("partBytes", part_bytes).option("badRecords", bad_records).load(path)


def read_gff(spark: SparkSession, path: str, dialect: str = "gff3") -> DataFrame:
    """Features, 0-based and half-open, with ``attrs``; comments and embedded sequences are left out."""
    raw = spark.read.csv(path, sep="\t", comment="#", schema=GFF, quote="").where("start IS NOT NULL AND attributes IS NOT NULL")
    return raw.withColumn("start", F.col("start") - 1).withColumn("attrs", attributes("attributes", dialect))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    schema = "chrom STRING, start BIGINT, `end` BIGINT, name STRING, score DOUBLE, strand STRING"
    return spark.read.csv(path, sep="\t", comment="#", schema=schema).where("start IS NOT NULL")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments: the eleven fields and ``tags``, TAG -> value. Header lines are in ``read_sam_header``."""
    parts = spark.read.text(path).where("NOT startswith(value, '@') AND value <> ''").select(F.split("value", "\t").alias("x"))
    kinds = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}
    fields = [F.get("x", F.lit(i)).cast(kinds.get(n, "string")).alias(n) for i, n in enumerate(SAM)]
    tags = F.map_from_entries(F.transform(F.slice("x", 12, 1 << 20), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substring(t, F.lit(6), F.length(t)).alias("v"))))
    return parts.select(*fields, tags.alias("tags"))


def read_sam_header(spark: SparkSession, path: str) -> DataFrame:
    """(kind, fields, line): a row for each distinct header line, ``@`` left out of its kind; fields: TAG -> value.

    A comment (CO) has no fields. A tag that is there twice has its first value.
    """
    lines = spark.read.text(path).where("startswith(value, '@')").select(F.col("value").alias("line"), F.split("value", "\t").alias("x")).distinct()
    kind = F.substring(F.get("x", F.lit(0)), F.lit(2), F.lit(100))
    pairs = F.filter(F.slice("x", 2, 1 << 20), lambda t: F.regexp_like(t, F.lit("^[A-Za-z][A-Za-z0-9]:")))
    names = F.array_distinct(F.transform(pairs, lambda t: F.substring(t, 1, 2)))
    first = F.transform(names, lambda n: F.struct(n.alias("k"), F.element_at(F.filter(pairs, lambda t: F.substring(t, 1, 2) == n), 1).alias("v")))
    fields = F.map_from_entries(F.transform(first, lambda e: F.struct(e["k"].alias("k"), F.substring(e["v"], F.lit(4), F.length(e["v"])).alias("v"))))
    return lines.select(kind.alias("kind"), F.when(kind == "CO", F.create_map().cast("map<string,string>")).otherwise(fields).alias("fields"), "line")


def read_table(spark: SparkSession, path: str, header: bool = True, skip: int = 0, names: list[str] | None = None, sep: str = "\t") -> DataFrame:
    """A delimited table of text columns; skip: lines before it, of a single file; names: instead of its own."""
    if not skip:
        df = spark.read.csv(path, sep=sep, header=header)
    else:
        lines = spark.read.text(path).withColumn("__at", F.monotonically_increasing_id())
        first = lines.orderBy("__at").limit(skip + 1).collect()  # as many lines as are skipped, and one
        rest = lines.where(F.col("__at") > first[-1]["__at"] if header and len(first) > skip else F.col("__at") >= first[-1]["__at"])
        cols = first[-1]["value"].split(sep)
        parts = F.split("value", f"\\Q{sep}\\E", -1)
        df = rest.select(*[F.get(parts, F.lit(i)).alias(c if header else f"_c{i}") for i, c in enumerate(cols)])
    return df.toDF(*names) if names else df


def read_clstr(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, member) of blocks that begin with ``>Cluster n``."""
    blocks = spark.read.option("lineSep", "\n>Cluster ").text(path).select(F.regexp_replace("value", "^>Cluster ", "").alias("v"))
    lines = blocks.select(F.concat(F.lit("Cluster "), F.regexp_extract("v", r"^(\d+)", 1)).alias("cluster"), F.explode(F.split("v", "\n")).alias("line"))
    return lines.select("cluster", F.regexp_extract("line", r">([^.\s]+)", 1).alias("member")).where("member <> ''")


def read_hits(spark: SparkSession, path: str, fmt: str = "tabular") -> DataFrame:
    """(query, hit, bits, evalue, is_rbh): twelve tabular columns, or ``labelled`` lines Query= Hit= Score= Evalue= with a mark ***RBH***."""
    if fmt == "tabular":
        return spark.read.csv(path, sep="\t", comment="#", schema=TABULAR_HITS).select("query", "hit", "bits", "evalue", F.lit(False).alias("is_rbh"))
    lines = spark.read.text(path).where("value LIKE '%Query=%'")
    take = lambda name: F.regexp_extract("value", rf"{name}=\s*(\S+)", 1)
    return lines.select(take("Query").alias("query"), take("Hit").alias("hit"), take("Score").try_cast("double").alias("bits"), take("Evalue").try_cast("double").alias("evalue"), F.contains("value", F.lit("***RBH***")).alias("is_rbh"))


def read_refgene(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema=REFGENE)


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=DOMAINS, quote="")


def read_classified(spark: SparkSession, path: str) -> DataFrame:
    """(read, taxid) of classified reads (status C); the taxon as ``taxid N`` or a bare number."""
    raw = spark.read.csv(path, sep="\t", schema="status STRING, read STRING, taxinfo STRING").where("status = 'C'")
    named = F.nullif(F.regexp_extract("taxinfo", r"taxid\s+(\d+)", 1), F.lit(""))
    return raw.select("read", F.coalesce(named, F.trim("taxinfo")).try_cast("bigint").alias("taxid")).where("taxid IS NOT NULL")


def read_taxdump(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A dump with bars between fields, as text columns, blanks trimmed."""
    parts = F.split("value", r"\|")
    return spark.read.text(path).where("trim(value) <> ''").select(*[F.nullif(F.trim(F.regexp_replace(F.get(parts, F.lit(i)), r"\t", " ")), F.lit("")).alias(n) for i, n in enumerate(names)])


def read_flat_records(spark: SparkSession, path: str) -> DataFrame:
    """(entry, sections map<string, array<string>>) of records that end with ``///``; a line that begins with blanks goes on with the section before."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["value"]:
                sections: dict[str, list[str]] = {}
                name = None
                for line in text.split("\n"):
                    if not line.strip() or line.startswith("///"):
                        continue
                    if not line[0].isspace():
                        name, _, line = line.partition(" ")
                    if name:
                        sections.setdefault(name, []).append(line.strip())
                if sections:
                    rows.append(((sections.get("ENTRY") or [""])[0].split(" ")[0], sections))
            yield pd.DataFrame(rows, columns=["entry", "sections"])

    return spark.read.option("lineSep", "///\n").text(path).where("trim(value) <> ''").mapInPandas(parse, "entry string, sections map<string, array<string>>")


def read_folds(spark: SparkSession, path: str) -> DataFrame:
    """(id, seq, fold) of three-line records; what follows the fold's first blank is left out."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.split(F.regexp_replace("value", "^>", ""), "\n").alias("x")).where(F.size("x") >= 3)
    return raw.select(F.regexp_extract(F.get("x", F.lit(0)), r"^(\S*)", 1).alias("id"), F.get("x", F.lit(1)).alias("seq"), F.regexp_extract(F.get("x", F.lit(2)), r"^([.()]*)", 1).alias("fold"))


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')


def read_dir(spark: SparkSession, path: str, pattern: str, names: list[str], sep: str = "\t") -> DataFrame:
    """All tables of a folder, with columns taken from each file's name by the groups of a pattern."""
    raw = spark.read.csv(path, sep=sep).select("*", F.col("_metadata.file_name").alias("__file"))
    return raw.select(*[c for c in raw.columns if c != "__file"], *[F.regexp_extract("__file", pattern, i + 1).alias(n) for i, n in enumerate(names)])


def read_duplexes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=":", schema=DUPLEX, quote="")


def place_in_file(df: DataFrame, file_col: str) -> DataFrame:
    """``line``: the number of each row within its file."""
    return df.withColumn("__at", F.monotonically_increasing_id()).withColumn("line", F.row_number().over(Window.partitionBy(file_col).orderBy("__at"))).drop("__at")


def shortest_first_read(spark: SparkSession, paths: list[str]) -> int:
    """The least number of bases that the first record of each FASTQ file has; the length for ``trim_fixed``. Empty files don't count.

    Two lines of each file are read.
    """
    heads = [spark.read.text(p).head(2) for p in paths]
    lengths = [len(h[1][0]) for h in heads if len(h) == 2]
    if not lengths:
        raise ValueError("no file has a read")
    return min(lengths)
