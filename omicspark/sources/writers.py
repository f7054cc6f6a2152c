"""Writers of sequencing and annotation formats. Nulls become empty text here, and only here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omicspark.storage import dealt


def _text(col: str) -> F.col:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fasta_lines(df: DataFrame, width: int | None = None) -> DataFrame:
    seq = _text("seq") if not width else F.rtrim(F.regexp_replace(_text("seq"), f"(.{{{width}}})", "$1\n"), F.lit("\n"))
    head = F.rtrim(F.concat(F.lit(">"), _text("seq_id"), F.lit(" "), _text("descr")))
    return df.select(F.concat(head, F.lit("\n"), seq).alias("value"))


def write_fasta(df: DataFrame, path: str, width: int | None = None, mode: str = "error") -> None:
    fasta_lines(df, width).write.mode(mode).text(path)


def write_fastq(df: DataFrame, path: str, mode: str = "error") -> None:
    head = F.rtrim(F.concat(F.lit("@"), _text("read_id"), F.lit(" "), _text("descr")))
    df.select(F.concat_ws("\n", head, _text("seq"), F.lit("+"), _text("qual")).alias("value")).write.mode(mode).text(path)


def _tsv(df: DataFrame, path: str, mode: str, header: bool = False) -> None:
    df.write.mode(mode).csv(path, sep="\t", header=header, quote="", emptyValue="", nullValue="")


def write_gff(df: DataFrame, path: str, mode: str = "error") -> None:
    """Features with 1-based starts; a version line heads each file."""
    cols = ["seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes"]
    told = df.withColumn("start", F.col("start") + 1).select(*[F.coalesce(F.nullif(_text(c), F.lit("")), F.lit(".")).alias(c) for c in cols])
    told.select(F.concat_ws("\t", *cols).alias("value")).selectExpr("value").write.mode(mode).option("lineSep", "\n").text(path)
    df.sparkSession.createDataFrame([("##gff-version 3",)], "value string").coalesce(1).write.mode("append").text(path)


def write_bed(df: DataFrame, path: str, mode: str = "error") -> None:
    _tsv(df.select("chrom", "start", "end", "name", "score", "strand"), path, mode)


def write_sam(df: DataFrame, path: str, mode: str = "error", header: DataFrame | None = None) -> None:
    """Alignments as SAM. header (kind, line): its lines are the first file, so files in the order of their numbers are one SAM; HD first, then SQ, RG, PG and the rest."""
    fields = [_text(c) for c in ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")]
    tags = F.array_join(F.transform(F.map_entries("tags"), lambda e: F.concat(e["key"], F.when(F.regexp_like(e["value"], F.lit(r"^-?\d+$")), ":i:").otherwise(":Z:"), e["value"])), "\t")
    told = df.select(F.rtrim(F.concat_ws("\t", *fields, tags), F.lit("\t")).alias("value"))
    if header is not None:
        place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ("HD", "SQ", "RG", "PG"))), F.col("kind")), F.lit(0)), F.lit(9))
        # A header has a line a reference, so one task writes it.
        told = header.coalesce(1).sortWithinPartitions(place, "line").select(F.col("line").alias("value")).union(told)
    told.write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, labels: list[str] | None = None, mode: str = "error") -> None:
    _tsv(df.toDF(*labels) if labels else df, path, mode, header=True)


def write_split(df: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
    """A folder for each value of ``by``. Rows meet their folder's others first, and a folder of many rows stays in several files."""
    df.repartition(by, F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(8))).write.partitionBy(by).mode(mode).parquet(path)


def gene_sets(df: DataFrame, name: str, gene: str) -> DataFrame:
    """A line a set: its name, a tab, its genes."""
    return df.groupBy(name).agg(F.array_join(F.array_sort(F.collect_set(gene)), ";").alias("genes")).select(F.concat_ws("\t", name, "genes").alias("value"))


def write_gmt(df: DataFrame, path: str, name: str, gene: str, mode: str = "error") -> None:
    gene_sets(df, name, gene).write.mode(mode).text(path)


def nested_hits(df: DataFrame) -> DataFrame:
    """A row a query: its hits, each with its alignments, from rows (query, hit, bits, start, end)."""
    per_hit = df.groupBy("query", "hit").agg(F.max("bits").alias("bits"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("alignment"))
    return per_hit.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("bits")).alias("order"), "hit", "bits", "alignment"))).alias("h")).select("query", F.transform("h", lambda h: F.struct(h["hit"].alias("id"), h["bits"].alias("bits"), h["alignment"].alias("alignment"))).alias("hit"))


def write_hits_xml(df: DataFrame, path: str, mode: str = "error") -> None:
    """A reader takes a file of XML whole, so files follow the hits: about ROWS of them a file, and no query in two."""
    nested_hits(dealt(df.select("query", "hit", "bits", "start", "end"), "hits", "query")).write.mode(mode).format("xml").option("rootTag", "queries").option("rowTag", "query").save(path)
