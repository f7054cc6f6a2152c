"""Registered round trips of the file formats: a table is written to the shared folder in the format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from omicspark.plans.queries import B, query, run, table
from omicspark.sources import readers as IN, writers as OUT
from omicspark.sources.fasta import read_fasta_tiles
from omicspark.storage import new_path


def _s(col) -> F.col:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _lines(df, value, spark, name: str) -> str:
    """The path of text files with a line, or several, a row."""
    path = new_path(spark, name)
    df.select(value.alias("value")).write.text(path)
    return path


@query(f"SELECT read_id, descr, seq, qual FROM ({B.READS})")
def io1_io19_fastq(spark, sf):
    path = new_path(spark, "fastq")
    OUT.write_fastq(run(spark, sf, B.READS), path)
    return IN.read_fastq(spark, path)


@query(f"SELECT read_id AS seq_id, descr, seq || reverse(seq) AS seq FROM ({B.READS})")
def io2_io18_fasta(spark, sf):
    path = new_path(spark, "fasta")
    OUT.write_fasta(run(spark, sf, B.READS).select(F.col("read_id").alias("seq_id"), "descr", F.concat("seq", F.reverse("seq")).alias("seq")), path, width=20)
    return IN.read_fasta(spark, path)


@query(f"WITH g AS (SELECT read_id, descr, repeat(seq, 1 + (length(descr) * 7) % 40) AS seq FROM ({B.READS})) SELECT read_id AS seq_id, descr, t AS tile, substr(seq, t * 100 + 1, 100) AS bases FROM g, range(0, 1000) r(t) WHERE t * 100 < length(seq)")
def io2_fasta_tiles(spark, sf):
    """Records cut into ranges of bytes wherever they fall, given back as tiles."""
    path = new_path(spark, "fasta")
    bases = F.expr("repeat(seq, 1 + (length(descr) * 7) % 40)")
    OUT.write_fasta(run(spark, sf, B.READS).select(F.col("read_id").alias("seq_id"), "descr", bases.alias("seq")), path, width=60)
    return read_fasta_tiles(spark, path, tile=100, part_bytes=1 << 18).select("seq_id", "descr", "tile", "bases")


@query(f"""SELECT id, seqid, start, "end", type, strand, parent FROM ({B.features('duckdb')})""")
def io3_io20_gff(spark, sf):
    path = new_path(spark, "gff")
    f = run(spark, sf, B.features("spark"))
    OUT.write_gff(f.withColumns({"source": F.lit("own"), "score": F.lit(None).cast("string"), "phase": F.lit(None).cast("string"), "attributes": F.concat_ws(";", F.concat(F.lit("ID="), "id"), F.concat(F.lit("Parent="), "parent"))}), path)
    return IN.read_gff(spark, path).select(F.col("attrs")["ID"].alias("id"), "seqid", "start", "end", "type", "strand", F.col("attrs")["Parent"].alias("parent"))


@query(f"""SELECT chrom, start, "end", name, start / 4.0 AS score, strand FROM ({B.intervals('duckdb', 'true')})""")
def io4_io20_bed(spark, sf):
    path = new_path(spark, "bed")
    OUT.write_bed(run(spark, sf, B.intervals("spark", "true")).withColumn("score", F.col("start") / 4.0), path)
    return IN.read_bed(spark, path)


@query(f"SELECT read_id AS qname, (length(descr) * 16)::INTEGER AS flag, descr AS rname, CAST(substr(read_id, 2) AS BIGINT) + 1 AS pos, '32M' AS cigar, seq, qual, '0' AS nm, '32' AS md FROM ({B.READS})")
def io5_io20_sam(spark, sf):
    r = run(spark, sf, B.READS)
    pos = F.substring("read_id", 2, 20).cast("bigint") + 1
    aln = r.select(F.col("read_id").alias("qname"), (F.length("descr") * 16).alias("flag"), F.col("descr").alias("rname"), pos.alias("pos"), F.lit(60).alias("mapq"), F.lit("32M").alias("cigar"), F.lit("*").alias("rnext"), F.lit(0).alias("pnext"), F.lit(0).alias("tlen"), "seq", "qual", F.create_map(F.lit("NM"), F.lit("0"), F.lit("MD"), F.lit("32")).alias("tags"))
    path = new_path(spark, "sam")
    OUT.write_sam(aln, path)
    return IN.read_sam(spark, path).select("qname", "flag", "rname", "pos", "cigar", "seq", "qual", F.col("tags")["NM"].alias("nm"), F.col("tags")["MD"].alias("md"))


@query("SELECT 'SQ' AS kind, n_name AS sn, (n_nationkey + 100)::STRING AS ln, 3 AS n FROM nation UNION ALL SELECT 'HD', NULL, NULL, 3 UNION ALL SELECT 'CO', NULL, NULL, 3")
def io5_sam_header(spark, sf):
    """Header lines and alignments written together, both read back."""
    sq = table(spark, sf, "nation").select(F.lit("SQ").alias("kind"), F.concat(F.lit("@SQ\tSN:"), "n_name", F.lit("\tLN:"), F.col("n_nationkey") + 100).alias("line"))
    header = sq.unionByName(spark.createDataFrame([("CO", "@CO\tfree: text"), ("HD", "@HD\tVN:1.6\tSO:unsorted")], "kind string, line string"))
    aln = table(spark, sf, "region").where("r_regionkey < 3").select(F.col("r_name").alias("qname"), F.lit(0).alias("flag"), F.lit("*").alias("rname"), F.lit(0).alias("pos"), F.lit(0).alias("mapq"), *[F.lit("*").alias(c) for c in ("cigar", "rnext")], F.lit(0).alias("pnext"), F.lit(0).alias("tlen"), F.lit("A").alias("seq"), F.lit("I").alias("qual"), F.create_map(F.lit("NM"), F.lit("0")).alias("tags"))
    path = new_path(spark, "sam")
    OUT.write_sam(aln, path, header=header)
    n = IN.read_sam(spark, path).agg(F.count("*").cast("int").alias("n"))
    return IN.read_sam_header(spark, path).select("kind", F.col("fields")["SN"].alias("sn"), F.col("fields")["LN"].alias("ln")).join(F.broadcast(n))  # one row


@query("SELECT c_custkey::STRING AS id, c_name AS label, c_mktsegment AS kind FROM customer")
def io6_io21_table(spark, sf):
    path = new_path(spark, "tsv")
    OUT.write_table(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, ["id", "label", "kind"])
    return IN.read_table(spark, path)


@query("SELECT n_nationkey::STRING AS id, n_name AS name FROM nation")
def io6_skipped_lines(spark, sf):
    rows = table(spark, sf, "nation").select(F.concat_ws("\t", _s("n_nationkey"), "n_name").alias("l")).agg(F.array_join(F.array_sort(F.collect_list("l")), "\n").alias("l"))  # a line a nation
    path = _lines(rows, F.concat(F.lit("# one\n# two\nid\tname\n"), "l"), spark, "skip")
    return IN.read_table(spark, path, skip=2)


@query("SELECT 'Cluster ' || c_nationkey AS cluster, 'm' || c_custkey AS member FROM customer")
def io7_clusters(spark, sf):
    line = F.concat(F.lit("0\t10aa, >m"), _s("c_custkey"), F.lit("... at 90%"))
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.array_join(F.collect_list(line), "\n").alias("lines"))
    return IN.read_clstr(spark, _lines(c, F.concat(F.lit(">Cluster "), _s("c_nationkey"), F.lit("\n"), "lines"), spark, "clstr"))


@query(f"SELECT query, hit, bits, evalue, bits > 40 AS is_rbh FROM ({B.HITS})")
def io8_labelled_hits(spark, sf):
    mark = F.when(F.col("bits") > 40, "***RBH*** ").otherwise("")
    line = F.concat(mark, F.lit("Query= "), "query", F.lit(" Hit= "), "hit", F.lit(" Score= "), _s("bits"), F.lit(" Evalue= "), _s("evalue"))
    return IN.read_hits(spark, _lines(run(spark, sf, B.HITS), line, spark, "hits"), "labelled")


@query(f"SELECT query, hit, bits, evalue, false AS is_rbh FROM ({B.HITS})")
def io8_tabular_hits(spark, sf):
    line = F.concat_ws("\t", "query", "hit", *[F.lit(x) for x in ("99.5", "10", "0", "0", "1", "10", "1", "10")], _s("evalue"), _s("bits"))
    return IN.read_hits(spark, _lines(run(spark, sf, B.HITS), line, spark, "hits"))


@query("SELECT 't' || l_orderkey || '.' || l_linenumber || '.' || l_partkey AS name, 's' || l_suppkey AS chrom, l_partkey * 10 AS tx_start, l_partkey * 10 + 500 AS tx_end, 2 AS exon_count, l_partkey * 10 || ',' || (l_partkey * 10 + 300) || ',' AS exon_starts, 'g' || l_orderkey AS name2 FROM lineitem")
def io9_refgene(spark, sf):
    n, start = F.concat(F.lit("t"), F.concat_ws(".", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"))), F.col("l_partkey") * 10
    starts, ends = F.concat(_s(start), F.lit(","), _s(start + 300), F.lit(",")), F.concat(_s(start + 100), F.lit(","), _s(start + 500), F.lit(","))
    line = F.concat_ws("\t", F.lit("1"), n, F.concat(F.lit("s"), _s("l_suppkey")), F.lit("+"), _s(start), _s(start + 500), _s(start), _s(start), F.lit("2"), starts, ends, F.lit("0"), F.concat(F.lit("g"), _s("l_orderkey")), F.lit("cmpl"), F.lit("cmpl"), F.lit("0,0,"))
    found = IN.read_refgene(spark, _lines(table(spark, sf, "lineitem"), line, spark, "refgene"))
    return found.select("name", "chrom", "tx_start", "tx_end", "exon_count", "exon_starts", "name2")


@query("SELECT 'p' || o_orderkey AS acc, o_orderstatus AS analysis, o_orderpriority AS analysis_id, (o_orderkey % 100)::INTEGER AS start, 'GO:' || o_custkey || '|GO:7' AS gos FROM orders")
def io10_domains(spark, sf):
    line = F.concat_ws("\t", F.concat(F.lit("p"), _s("o_orderkey")), F.lit("md5"), F.lit("99"), "o_orderstatus", "o_orderpriority", F.lit("d"), _s(F.col("o_orderkey") % 100), F.lit("9"), F.lit("0.1"), F.lit("T"), F.lit("date"), F.lit("IPR1"), F.lit("e"), F.concat(F.lit("GO:"), _s("o_custkey"), F.lit("|GO:7")), F.lit("KEGG: 1"))
    return IN.read_domains(spark, _lines(table(spark, sf, "orders"), line, spark, "domains")).select("acc", "analysis", "analysis_id", "start", "gos")


@query("SELECT 'r' || o_orderkey AS read, o_custkey AS taxid FROM orders WHERE o_orderstatus <> 'F'")
def io11_classified(spark, sf):
    line = F.concat_ws("\t", F.when(F.col("o_orderstatus") == "F", "U").otherwise("C"), F.concat(F.lit("r"), _s("o_orderkey")), F.when(F.col("o_orderkey") % 2 == 0, _s("o_custkey")).otherwise(F.concat(F.lit("Genus (taxid "), _s("o_custkey"), F.lit(")"))))
    return IN.read_classified(spark, _lines(table(spark, sf, "orders"), line, spark, "classified"))


@query(f"SELECT taxid::STRING AS taxid, parent::STRING AS parent, 'no rank' AS rank FROM ({B.NODES})")
def io12_dump(spark, sf):
    line = F.concat(F.concat_ws("\t|\t", _s("taxid"), _s("parent"), F.lit("no rank")), F.lit("\t|"))
    return IN.read_taxdump(spark, _lines(run(spark, sf, B.NODES), line, spark, "dump"), ["taxid", "parent", "rank"])


@query("SELECT 'K' || p_partkey AS entry, p_name AS name, 2::BIGINT AS pathways, p_brand AS second FROM part")
def io13_flat_records(spark, sf):
    # write.text ends each row with a line feed, so the record's last line is its mark.
    record = F.concat(F.lit("ENTRY       K"), _s("p_partkey"), F.lit("   KO\nNAME        "), "p_name", F.lit("\nPATHWAY     one\n            "), "p_brand", F.lit("\n///"))
    found = IN.read_flat_records(spark, _lines(table(spark, sf, "part"), record, spark, "flat"))
    s = F.col("sections")
    return found.select("entry", s["NAME"][0].alias("name"), F.size(s["PATHWAY"]).cast("bigint").alias("pathways"), s["PATHWAY"][1].alias("second"))


@query(f"SELECT read_id AS id, seq, translate(seq, 'ACGT', '.()(') AS fold FROM ({B.READS})")
def io14_folds(spark, sf):
    record = F.concat(F.lit(">"), "read_id", F.lit(" x\n"), "seq", F.lit("\n"), F.translate("seq", "ACGT", ".()("), F.lit(" (-1.50)"))
    return IN.read_folds(spark, _lines(run(spark, sf, B.READS), record, spark, "folds"))


@query("""SELECT c_custkey::STRING AS id, c_name || chr(10) || '"' || c_mktsegment || '", quoted' AS note FROM customer""")
def io15_quoted_csv(spark, sf):
    path = new_path(spark, "csv")
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", quoted'))
    table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), note.alias("note")).write.csv(path, header=True, quote='"', escape='"')
    return IN.read_quoted_csv(spark, path)


@query("SELECT o_orderkey::STRING AS k, o_orderstatus AS status, left(o_orderpriority, 1) AS priority FROM orders")
def io16_io22_folder(spark, sf):
    path = new_path(spark, "split")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.left("o_orderpriority", F.lit(1)).alias("priority"))
    OUT.write_split(o, path, "o_orderstatus")
    parts = spark.read.parquet(path)
    flat = new_path(spark, "tables")
    parts.select(_s("o_orderkey").alias("k"), "priority", "o_orderstatus").write.partitionBy("o_orderstatus").csv(flat, sep="\t")
    # The value of the split is in each file's folder, the rest in its lines.
    found = spark.read.csv(flat, sep="\t", schema="k STRING, priority STRING, o_orderstatus STRING")
    return found.select("k", F.col("o_orderstatus").alias("status"), "priority")


@query("SELECT DISTINCT p_brand AS brand, unnest(string_split(p_name, ' ')) AS word, 'part' AS kind FROM part")
def io16_names_of_files(spark, sf):
    path = new_path(spark, "named")
    OUT.write_gmt(table(spark, sf, "part").select("p_brand", F.explode(F.split("p_name", " ")).alias("word")), path, "p_brand", "word")
    found = IN.read_dir(spark, path, r"^(part)-", ["kind"])
    return found.select(F.col("_c0").alias("brand"), F.explode(F.split("_c1", ";")).alias("word"), "kind")


@query("SELECT 's' || l_suppkey AS target, 'p' || l_partkey AS query, -l_quantity AS energy, l_discount AS pvalue, l_linenumber AS position FROM lineitem")
def io17_duplexes(spark, sf):
    line = F.concat_ws(":", F.concat(F.lit("s"), _s("l_suppkey")), F.lit("10"), F.concat(F.lit("p"), _s("l_partkey")), F.lit("5"), _s(-F.col("l_quantity")), _s("l_discount"), _s("l_linenumber"), *[F.lit(x) for x in "abcd"])
    return IN.read_duplexes(spark, _lines(table(spark, sf, "lineitem"), line, spark, "duplexes")).select("target", "query", "energy", "pvalue", "position")


@query("SELECT p_brand AS term, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS genes FROM part GROUP BY p_brand")
def io23_gene_sets(spark, sf):
    path = new_path(spark, "gmt")
    OUT.write_gmt(table(spark, sf, "part"), path, "p_brand", "p_type")
    return IN.read_table(spark, path, header=False, names=["term", "genes"])


@query(f"SELECT query, count(*) AS hits, max(bits) AS best FROM ({B.HITS}) GROUP BY query")
def io24_hits_xml(spark, sf):
    path = new_path(spark, "xml")
    OUT.write_hits_xml(run(spark, sf, B.HITS).withColumns({"start": F.lit(1), "end": F.lit(9)}), path)
    back = spark.read.format("xml").option("rowTag", "query").schema("query STRING, hit ARRAY<STRUCT<id: STRING, bits: DOUBLE>>").load(path)
    return back.select("query", F.size("hit").cast("bigint").alias("hits"), F.array_max(F.transform("hit", lambda h: h["bits"])).alias("best"))
