"""More registered queries: reads, intervals, hits, taxa, features, expression, graphs, k-mers, haplotypes, modules."""

from __future__ import annotations

from pyspark.sql import functions as F

from omicspark.functions import sequences as X
from omicspark.plans.queries import B, E, FT, G, H, HP, I, K, M, RD, TB, TX, _r, query, run, table

_AF, _NO = B.intervals("duckdb", "l_returnflag = 'A'"), B.intervals("duckdb", "l_returnflag = 'R'")


def _sides(spark, sf):
    return run(spark, sf, B.intervals("spark", "l_returnflag = 'A'")), run(spark, sf, B.intervals("spark", "l_returnflag = 'R'"))


# --- reads --------------------------------------------------------------------

_M = f"WITH m AS ({B.MATES}), a AS (SELECT left(read_id, length(read_id) - 2) AS id, seq, qual FROM m WHERE mate = 1), b AS (SELECT left(read_id, length(read_id) - 2) AS id, seq, qual FROM m WHERE mate = 2)"


def _mates(spark, sf):
    m = run(spark, sf, B.MATES)
    return m.where("mate = 1").drop("mate"), m.where("mate = 2").drop("mate")


@query(f"{_M} SELECT id, a.seq AS seq1, b.seq AS seq2, a.qual AS qual1, b.qual AS qual2 FROM a JOIN b USING (id)")
def r1_merge_pairs(spark, sf):
    return RD.merge_pairs(*_mates(spark, sf), strict=True)


@query(f"{_M} SELECT id || '/' || n AS read_id, CASE n WHEN 1 THEN a.seq ELSE b.seq END AS seq, CASE n WHEN 1 THEN a.qual ELSE b.qual END AS qual FROM a JOIN b USING (id), range(1, 3) t(n)")
def r2_unmerge_pairs(spark, sf):
    pairs = RD.merge_pairs(*_mates(spark, sf)).select("id", F.concat("seq1", "seq2").alias("seq"), F.concat("qual1", "qual2").alias("qual"))
    one, two = RD.unmerge_pairs(RD.split_merged(pairs))
    return one.unionByName(two)


@query(f"{_M} SELECT id, a.seq || 'NNNN' || b.seq AS seq, a.qual || '!!!!' || b.qual AS qual FROM a JOIN b USING (id) UNION ALL SELECT id, NULL, NULL FROM a ANTI JOIN b USING (id) UNION ALL SELECT id, NULL, NULL FROM b ANTI JOIN a USING (id)")
def r3_concat_pairs(spark, sf):
    joined, alone = RD.concat_pairs(*_mates(spark, sf), 4)
    return joined.unionByName(alone, allowMissingColumns=True)


@query(f"SELECT read_id, substr(seq, 1, 20) AS seq, substr(qual, 1, 20) AS qual FROM ({B.READS})")
def r4_trim_fixed(spark, sf):
    return RD.trim_fixed(run(spark, sf, B.READS), 20).select("read_id", "seq", "qual")


_CUT = f"SELECT read_id, seq, qual, coalesce(list_min([i FOR i IN range(1, 33) IF ascii(substr(qual, i, 1)) - 33 < 10]) - 1, 32) AS cut FROM ({B.READS})"


@query(f"SELECT read_id, substr(seq, 1, cut) AS seq, substr(qual, 1, cut) AS qual, cut >= 5 AS passed FROM ({_CUT})")
def r5_trim_first_low(spark, sf):
    return RD.trim_first_low(run(spark, sf, B.READS), 10, 5).select("read_id", "seq", "qual", "passed")


_WINDOW_CUT = f"""WITH r AS (SELECT read_id, seq, qual, [ascii(c) - 33 FOR c IN string_split(qual, '')] AS q FROM ({B.READS})),
 s AS (SELECT *, coalesce(list_min([i FOR i IN range(0, 30) IF (q[i + 1] + q[i + 2] + q[i + 3]) / 3.0 < 25]), 30) AS s FROM r),
 c AS (SELECT *, coalesce(list_min([i FOR i IN range(0, 32) IF i >= s AND q[i + 1] < 25]), 32) AS cut FROM s)"""


@query(f"{_WINDOW_CUT} SELECT read_id, substr(seq, 1, cut) AS seq, substr(qual, 1, cut) AS qual, cut >= 10 AS passed FROM c")
def r6_trim_window(spark, sf):
    return RD.trim_window(run(spark, sf, B.READS), 25, 10).select("read_id", "seq", "qual", "passed")


@query(f"SELECT route, count(*) AS n FROM (SELECT CASE WHEN cut >= 3 AND cut % 2 = 0 THEN 'paired' WHEN cut >= 3 OR cut % 2 = 0 THEN 'single' ELSE 'none' END AS route FROM ({_CUT})) GROUP BY route")
def r7_route_pairs(spark, sf):
    cut = run(spark, sf, B.READS).withColumn("cut", RD.first_low(X.phred("qual"), 10))
    return RD.route_pairs(cut.withColumns({"passed1": F.col("cut") >= 3, "passed2": F.col("cut") % 2 == 0})).groupBy("route").agg(F.count("*").alias("n"))


@query(f"""WITH r AS (SELECT read_id, seq, qual, [25 - (ascii(c) - 33) FOR c IN string_split(reverse(qual), '')] AS d FROM ({B.READS})),
 s AS (SELECT *, [list_sum(list_slice(d, 1, i)) FOR i IN range(1, 33)] AS sums FROM r),
 t AS (SELECT *, coalesce(list_min([i FOR i IN range(1, 33) IF sums[i] < 0]), 33) AS stop FROM s),
 b AS (SELECT *, list_max(list_slice(sums, 1, stop - 1)) AS best FROM t),
 c AS (SELECT *, CASE WHEN best > 0 THEN 32 - list_position(list_slice(sums, 1, stop - 1), best) ELSE 32 END AS cut FROM b)
 SELECT read_id, CASE WHEN cut > 0 THEN substr(seq, 1, cut) ELSE 'N' END AS seq, CASE WHEN cut > 0 THEN substr(qual, 1, cut) ELSE '#' END AS qual FROM c""")
def r8_trim_bwa(spark, sf):
    return RD.trim_bwa(run(spark, sf, B.READS), 25).select("read_id", "seq", "qual")


@query(f"SELECT read_id FROM ({B.READS}) WHERE read_id NOT IN (SELECT 'r' || o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def r9_exclude_ids(spark, sf):
    ids = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("id"))
    return TB.exclude_ids(run(spark, sf, B.READS), ids, "read_id").select("read_id")


@query(f"SELECT read_id FROM ({B.MATES}) WHERE left(read_id, length(read_id) - 2) NOT IN (SELECT 'p' || o_orderkey FROM orders WHERE o_custkey % 8 < 4)")
def r10_remove_mapped(spark, sf):
    hits = table(spark, sf, "orders").select(F.concat(F.lit("p"), F.col("o_orderkey").cast("string"), F.lit("/2")).alias("qname"), (F.col("o_custkey") % 8).cast("int").alias("flag"))
    return RD.remove_mapped(run(spark, sf, B.MATES), hits).select("read_id")


@query(f"SELECT read_id, seq, CASE WHEN CAST(substr(read_id, 2) AS BIGINT) % 2 = 0 THEN 'known ' || descr ELSE 'none' END AS descr FROM ({B.READS})")
def r11_recover_descr(spark, sf):
    reads = run(spark, sf, B.READS).select("read_id", "seq", F.lit("none").alias("descr"))
    ref = run(spark, sf, B.READS).where("CAST(substr(read_id, 2) AS BIGINT) % 2 = 0").select("read_id", "seq", F.concat(F.lit("known "), "descr").alias("descr"))
    return RD.recover_descr(reads, ref)


@query(f"SELECT read_id || '/1' AS read_id, seq, qual FROM ({B.READS}) UNION ALL SELECT read_id || '/2', reverse(translate(seq, 'ACGT', 'TGCA')), reverse(qual) FROM ({B.READS})")
def r12_se_to_pe(spark, sf):
    return RD.se_to_pe(run(spark, sf, B.READS))


@query(f"SELECT read_id AS seq_id, seq, repeat('I', 32) AS qual FROM ({B.READS})")
def r13_fasta_to_fastq(spark, sf):
    return RD.fasta_to_fastq(run(spark, sf, B.READS).select(F.col("read_id").alias("seq_id"), "seq"))


@query(f"SELECT translate(replace(seq, 'T', 'U'), 'U', 'T') AS seq, split_part(read_id || ' x', ' ', 1) AS id FROM ({B.READS})")
def r14_clean(spark, sf):
    return run(spark, sf, B.READS).select(X.u_to_t(F.replace("seq", F.lit("T"), F.lit("U"))).alias("seq"), X.first_token(F.concat("read_id", F.lit(" x"))).alias("id"))


@query(f"SELECT read_id, 'new_' || lpad(to_hex(dense_rank() OVER (ORDER BY read_id)), 10, '0') AS new_id FROM ({B.READS})")
def r15_rename_ids(spark, sf):
    return RD.rename_ids(run(spark, sf, B.READS).select("read_id"), "new_", "read_id")


@query("SELECT p_partkey, regexp_replace(regexp_replace(p_name, '\\bred\\b', 'RED', 'g'), '\\bblue\\b', 'BLUE', 'g') AS p_name FROM part")
def r16_restore_ids(spark, sf):
    mapping = spark.range(2).select(F.when(F.col("id") == 0, "red").otherwise("blue").alias("new_id"), F.when(F.col("id") == 0, "RED").otherwise("BLUE").alias("old_id"))
    return RD.restore_ids(table(spark, sf, "part").select("p_partkey", "p_name"), mapping, "p_name", "p_partkey")


@query(f"SELECT read_id, CASE WHEN read_id IN (SELECT 'r' || o_orderkey FROM orders) THEN 'o' || substr(read_id, 2) ELSE 'new_' || lpad(to_hex(dense_rank() OVER (ORDER BY read_id)), 10, '0') END AS new_id FROM ({B.READS})")
def r15_rename_by_map(spark, sf):
    given = table(spark, sf, "orders").select(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("old_id"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("new_id"))
    return RD.rename_ids(run(spark, sf, B.READS).select("read_id"), "new_", "read_id", given)


@query("SELECT o_orderkey, 'see ' || coalesce(replace(CASE WHEN length(n_name) < 9 THEN rpad(n_name, 9, '_') ELSE n_name END, ' ', '-'), 'c' || o_custkey % 40) || ' there' AS note FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 40")
def r16_restore_filled_ids(spark, sf):
    mapping = table(spark, sf, "nation").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("new_id"), F.col("n_name").alias("old_id"))
    notes = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("see c"), (F.col("o_custkey") % 40).cast("string"), F.lit(" there")).alias("note"))
    return RD.restore_ids(notes, mapping, "note", "o_orderkey", width=9, pad="_", sub=" ", repl="-")


@query(f"SELECT read_id, right(seq, 6) || left(seq, 6) AS junction FROM ({B.READS})")
def r17_circular_junction(spark, sf):
    return run(spark, sf, B.READS).select("read_id", X.circular_junction("seq", 6).alias("junction"))


@query(f"""WITH h AS (SELECT DISTINCT 'r' || l_orderkey AS read_id, 'ACGT' || CASE WHEN l_suppkey % 3 = 0 THEN 'A' ELSE 'CC' END AS primer, l_returnflag AS name, CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END AS flag, l_linenumber + 4 AS start FROM lineitem),
 o AS (SELECT read_id, min(primer) AS primer, min(flag) AS flag, min(start) AS start FROM h GROUP BY read_id HAVING count(DISTINCT primer) = 1 AND count(DISTINCT name) = 1),
 c AS (SELECT read_id, CASE WHEN flag = 16 THEN substr(seq, 1, start + length(primer) - 1) ELSE substr(seq, start) END AS seq FROM ({B.READS}) JOIN o USING (read_id)) SELECT * FROM c WHERE length(seq) > 11""")
def r18_amplicon(spark, sf):
    hits = table(spark, sf, "lineitem").select(F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("read_id"), F.concat(F.lit("ACGT"), F.when(F.col("l_suppkey") % 3 == 0, "A").otherwise("CC")).alias("primer"), F.col("l_returnflag").alias("name"), F.when(F.col("l_linestatus") == "O", 16).otherwise(0).alias("flag"), (F.col("l_linenumber") + 4).alias("start"))
    return RD.amplicon_from_hits(run(spark, sf, B.READS), hits, 11)


_ALN = "SELECT concat('q', CAST(l_orderkey AS STRING)) AS qname, CAST(l_suppkey % 2 * 64 + (1 - l_suppkey % 2) * 128 + CASE WHEN l_discount > 0.05 THEN 256 ELSE 0 END AS INT) AS flag, l_partkey AS pos, l_linenumber AS line, l_extendedprice AS x FROM lineitem"


@query(f"SELECT qname, flag, pos FROM ({_ALN}) QUALIFY count(*) OVER (PARTITION BY qname) = 1")
def r20_unique_alignments(spark, sf):
    return RD.unique_alignments(run(spark, sf, _ALN)).select("qname", "flag", "pos")


@query(f"SELECT qname, line, pos, x, CASE WHEN row_number() OVER (PARTITION BY qname, flag & 192 ORDER BY flag & 256, line, pos, x) = 1 THEN flag & ~256 ELSE flag | 256 END::INT AS flag FROM ({_ALN})")
def r21_fix_primary(spark, sf):
    return RD.fix_primary(run(spark, sf, _ALN), ["line", "pos", "x"]).select("qname", "line", "pos", "x", "flag")


@query("SELECT c_name AS qname, ((o_orderkey % 4096 | 1 | 8 | 64) & ~256)::INT AS flag, o_orderkey AS pos FROM orders JOIN customer ON o_custkey = c_custkey")
def r22_fix_missing_mate(spark, sf):
    aln = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("qname"), (F.col("o_orderkey") % 4096).cast("int").alias("flag"), F.col("o_orderkey").alias("pos"))
    return RD.fix_missing_mate(aln, table(spark, sf, "customer").select(F.col("c_custkey").alias("n"), F.col("c_name").alias("name")), 1)


@query("SELECT l_orderkey, l_linenumber, l_quantity::BIGINT + 5 AS aligned, l_linenumber::BIGINT AS inserted, 3::BIGINT AS deleted, 2::BIGINT AS clipped, l_partkey - 1 + l_quantity::BIGINT + 8 AS ref_end FROM lineitem")
def r23_expand_cigar(spark, sf):
    cigar = F.concat(F.lit("2S"), F.col("l_quantity").cast("int").cast("string"), F.lit("M"), F.col("l_linenumber").cast("string"), F.lit("I3D5="))
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("pos"), cigar.alias("cigar"))
    return RD.expand_cigar(df).drop("pos", "cigar")


@query(f"""WITH a AS (SELECT descr AS qname, substr(seq, 1, 1) AS rname, read_id, seq, CAST(substr(read_id, 2) AS BIGINT) AS n FROM ({B.READS})), o AS (SELECT *, min(n) OVER (PARTITION BY qname, rname) AS f, row_number() OVER (PARTITION BY qname, rname ORDER BY n) AS hsp_num FROM a)
 SELECT read_id, substr(seq, 1, 20) || '---' || substr(seq, 21) AS query_aligned, substr(seq, 1, 5) || 'N' || substr(seq, 7, 4) || '--' || substr(seq, 13, 8) || 'ACG' || substr(seq, 21) AS hit_aligned,
  5::BIGINT AS gaps, n + 32 AS hit_to, dense_rank() OVER (PARTITION BY qname ORDER BY f) AS hit_num, hsp_num FROM o""")
def r23_expand_alignment(spark, sf):
    n = F.substring("read_id", 2, 20).cast("bigint")
    aln = run(spark, sf, B.READS).select("read_id", F.col("descr").alias("qname"), F.left("seq", F.lit(1)).alias("rname"), n.alias("pos"), "seq", F.lit("10M2I8M3D12M").alias("cigar"), F.lit("5N12^ACG12").alias("md"))
    return RD.expand_alignment(aln, ["pos"]).select("read_id", "query_aligned", "hit_aligned", "gaps", "hit_to", F.col("hit_num").cast("bigint").alias("hit_num"), F.col("hsp_num").cast("bigint").alias("hsp_num"))


@query(f"""WITH r AS (SELECT seq, [ascii(c) FOR c IN string_split(qual, '')] AS q, read_id, qual FROM ({B.READS})),
 e AS (SELECT seq, i, max(q[i]) AS m FROM r, range(1, 33) t(i) GROUP BY seq, i), b AS (SELECT seq, string_agg(chr(m), '' ORDER BY i) AS qual1 FROM e GROUP BY seq)
 SELECT min(read_id) AS id, seq AS seq1, reverse(seq) AS seq2, count(*) AS n, any_value(b.qual1) AS qual1, any_value(b.qual1) AS qual2 FROM r JOIN b USING (seq) GROUP BY seq""")
def a1_dedup_pairs(spark, sf):
    pairs = run(spark, sf, B.READS).select(F.col("read_id").alias("id"), F.col("seq").alias("seq1"), F.reverse("seq").alias("seq2"), F.col("qual").alias("qual1"), F.col("qual").alias("qual2"))
    return RD.dedup_pairs(pairs)


@query(f"""WITH r AS (SELECT seq, read_id || CASE WHEN CAST(substr(read_id, 2) AS BIGINT) % 3 = 0 THEN '_x4' ELSE '' END AS read_id FROM ({B.READS})),
 u AS (SELECT seq, sum(CASE WHEN read_id LIKE '%\\_x4' ESCAPE '\\' THEN 4 ELSE 1 END)::BIGINT AS n, row_number() OVER (ORDER BY seq) AS k FROM r GROUP BY seq)
 SELECT read_id AS old_id, 'abc1_' || lpad(k::STRING, 9, '0') || '_x' || n AS new_id FROM r JOIN u USING (seq)""")
def a2_dedup_reads(spark, sf):
    reads = run(spark, sf, B.READS).withColumn("read_id", F.concat("read_id", F.when(F.expr("CAST(substr(read_id, 2) AS BIGINT) % 3 = 0"), "_x4").otherwise("")))
    return RD.dedup_reads(reads, "abc", 1)[1]


@query(f"""WITH r AS (SELECT seq, [ascii(c) FOR c IN string_split(qual, '')] AS q FROM ({B.READS})), e AS (SELECT seq, i, max(q[i]) AS m FROM r, range(1, 33) t(i) GROUP BY seq, i), b AS (SELECT seq, string_agg(chr(m), '' ORDER BY i) AS qual FROM e GROUP BY seq)
 SELECT 'abc1_' || lpad((row_number() OVER (ORDER BY seq))::STRING, 9, '0') || '_x' || n AS read_id, seq, qual, n FROM (SELECT seq, count(*) AS n FROM r GROUP BY seq) JOIN b USING (seq)""")
def a2_unique_reads(spark, sf):
    return RD.dedup_reads(run(spark, sf, B.READS), "abc", 1)[0]


@query(f"{_M} SELECT 'p' || o_orderkey AS id, CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL THEN 'paired' WHEN a.id IS NOT NULL THEN 'single1' WHEN b.id IS NOT NULL THEN 'single2' ELSE 'none' END AS route FROM orders LEFT JOIN a ON a.id = 'p' || o_orderkey LEFT JOIN b ON b.id = 'p' || o_orderkey")
def j18_repair_pairs(spark, sf):
    a, b = (m.select(X.strip_mate("read_id").alias("id")) for m in _mates(spark, sf))
    return RD.repair_pairs(table(spark, sf, "orders").select(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("id")), a, b)


_QC = f"""WITH r AS ({B.READS}), a AS (SELECT read_id, length(regexp_extract(seq, '^(A{{2,}}|T{{2,}})')) AS f, seq, qual FROM r),
 b AS (SELECT read_id, substr(seq, f + 1) AS seq, substr(qual, f + 1) AS qual FROM a), k AS (SELECT *, length(regexp_replace(seq, '(A{{2,}}|T{{2,}})$', '')) AS k FROM b),
 c AS (SELECT read_id, substr(seq, 1, k) AS seq, substr(qual, 1, k) AS qual FROM k), q AS (SELECT *, [ascii(x) - 33 FOR x IN string_split(qual, '') IF x <> ''] AS q FROM c),
 w AS (SELECT *, CASE WHEN len(q) < 5 THEN CASE WHEN len(q) > 0 AND list_avg(q) >= 15 THEN len(q) ELSE 0 END ELSE coalesce(list_max([i FOR i IN range(0, len(q) - 4) IF (q[i + 1] + q[i + 2] + q[i + 3] + q[i + 4] + q[i + 5]) / 5.0 >= 15]) + 5, 0) END AS cut FROM q),
 d AS (SELECT read_id, substr(seq, 1, cut) AS seq, substr(qual, 1, cut) AS qual, cut FROM w WHERE cut >= 10), p AS (SELECT *, [substr(seq, i, 2) FOR i IN range(1, cut)] AS pairs FROM d)
 SELECT read_id, seq, qual FROM p WHERE NOT regexp_matches(seq, '[^ACGT]') AND list_max([len([1 FOR y IN pairs IF y = x]) FOR x IN list_distinct(pairs)]) <= 0.15 * (cut - 1)"""


@query(_QC)
def f15_qc_reads(spark, sf):
    return RD.qc_reads(run(spark, sf, B.READS), min_length=10, tail=2, q=15, max_low_complexity=0.15).select("read_id", "seq", "qual")


@query(f"SELECT i::INTEGER AS position, substr(seq, i, 1) AS base, count(*) AS n, round(avg(ascii(substr(qual, i, 1)) - 33), 6) AS mean_quality FROM ({B.READS}), range(1, 33) t(i) GROUP BY ALL")
def a25_base_profile(spark, sf):
    return RD.base_profile(run(spark, sf, B.READS)).withColumn("mean_quality", _r("mean_quality"))


@query("SELECT length(p_name)::INTEGER AS length, count(*) AS n FROM part GROUP BY ALL")
def a25_length_histogram(spark, sf):
    return RD.length_histogram(table(spark, sf, "part").select(F.col("p_name").alias("seq")))


# --- intervals ------------------------------------------------------------------

_ON = 'a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end"'
_OV = 'least(a."end", b."end") - greatest(a.start, b.start)'


@query(f'WITH a AS ({_AF}), b AS ({_NO}) SELECT a.name AS a_name, a.start AS a_start, b.name AS b_name, b.start AS b_start, {_OV} AS overlap FROM a JOIN b ON {_ON}')
def j9_overlap_join(spark, sf):
    a, b = _sides(spark, sf)
    return I.overlap_join(a, b).select("a_name", "a_start", "b_name", "b_start", "overlap")


@query(f'WITH a AS ({_AF}), b AS ({_NO}), p AS (SELECT a.name AS a_name, a.start AS a_start, b.name AS b_name, {_OV} AS overlap FROM a JOIN b ON {_ON} AND a.strand = b.strand AND {_OV} >= 0.5 * (a."end" - a.start) AND {_OV} >= 0.5 * (b."end" - b.start)) SELECT * FROM p')
def j9_overlap_reciprocal(spark, sf):
    a, b = _sides(spark, sf)
    return I.overlap_join(a, b, same_strand=True, min_frac=0.5, reciprocal=True).select("a_name", "a_start", "b_name", "overlap")


@query(f'WITH a AS ({_AF}), b AS ({_NO}) SELECT a.name, a.chrom, a.start, a."end", a.strand FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE {_ON})')
def j9_overlap_none(spark, sf):
    a, b = _sides(spark, sf)
    return I.overlap_join(a, b, mode="v").select("name", "chrom", "start", "end", "strand")


@query(f'WITH a AS ({_AF}), b AS ({_NO}) SELECT a.name AS a_name, b.name AS b_name, CASE WHEN b.name IS NULL THEN 0 ELSE {_OV} END AS overlap FROM a LEFT JOIN b ON {_ON}')
def j9_overlap_all(spark, sf):
    a, b = _sides(spark, sf)
    return I.overlap_join(a, b, mode="wao").select("a_name", "b_name", "overlap")


@query()
def a37_link_loci(spark, sf):
    return I.link_loci(*_sides(spark, sf))


@query(f"""WITH c AS (SELECT *, 'p' || CAST(split_part(name, '.', 1) AS BIGINT) % 40 AS parent FROM ({_AF})), p AS (SELECT *, 'p' || CAST(split_part(name, '.', 1) AS BIGINT) % 40 AS pid FROM ({_NO}))
 SELECT a.name, a.chrom, a.start, a."end", 'F' AS strand, b.pid AS parent, b.start AS parent_start FROM c a JOIN p b ON {_ON} AND a.parent = b.pid
 QUALIFY row_number() OVER (PARTITION BY a.name, a.start, a."end" ORDER BY {_OV} DESC, b.start, b."end") = 1""")
def j20_reparent(spark, sf):
    a, b = _sides(spark, sf)
    pid = F.expr("concat('p', CAST(CAST(split_part(name, '.', 1) AS BIGINT) % 40 AS STRING))")
    b = b.withColumn("name", pid).withColumn("strand", F.lit("F"))
    return I.reparent(a.withColumn("parent", pid), b).select("name", "chrom", "start", "end", "strand", "parent", "parent_start")


@query(f"""WITH a AS ({_AF}), b AS ({_NO}), x AS (SELECT *, left(md5(split_part(name, '.', 3)), 3) AS s FROM a), y AS (SELECT *, left(md5(split_part(name, '.', 3)), 3) AS s FROM b),
 j AS (SELECT a.name AS a_name, b.name AS b_name, CASE WHEN a.chrom = b.chrom AND a.strand = b.strand THEN {_OV} ELSE 0 END AS o, a."end" - a.start AS la, b."end" - b.start AS lb FROM x a JOIN y b ON a.s = b.s),
 k AS (SELECT *, CASE WHEN o >= 0.3 * la AND o >= 0.3 * lb THEN o END AS sc FROM j), r AS (SELECT *, max(sc) OVER (PARTITION BY a_name) AS best, count(*) OVER (PARTITION BY a_name) AS n FROM k)
 SELECT a_name, b_name, n = 1 OR best IS NOT NULL AS settled FROM r WHERE n = 1 OR best IS NULL OR sc = best""")
def j10_exact_match(spark, sf):
    a, b = _sides(spark, sf)
    seq = F.expr("left(md5(split_part(name, '.', 3)), 3)")
    return I.exact_match(a.withColumn("seq", F.concat(seq, F.lit("*"))), b.withColumn("seq", seq), 0.3)


@query("""WITH x AS (SELECT l_orderkey AS tx, l_partkey * 100 AS start, l_partkey * 100 + 50 AS "end", CASE WHEN l_orderkey % 2 = 0 THEN '-' ELSE '+' END AS strand FROM lineitem GROUP BY ALL),
 b AS (SELECT tx, strand, min(start) AS s, max("end") AS e FROM x GROUP BY ALL), g AS (SELECT tx, strand, "end" AS s, lead(start) OVER (PARTITION BY tx ORDER BY start) AS e FROM x)
 SELECT tx, 'transcript' AS kind, s AS start, e AS "end" FROM b UNION ALL SELECT tx, 'tss', CASE WHEN strand = '-' THEN e - 1 ELSE s END, CASE WHEN strand = '-' THEN e ELSE s + 1 END FROM b
 UNION ALL SELECT tx, 'promoter', greatest(CASE WHEN strand = '-' THEN e ELSE s - 1000 END, 0), CASE WHEN strand = '-' THEN e + 1000 ELSE s END FROM b
 UNION ALL SELECT tx, 'exon', start, "end" FROM x UNION ALL SELECT tx, 'intron', s, e FROM g WHERE e > s
 UNION ALL SELECT tx, 'cds', start, "end" FROM x WHERE start % 300 = 0
 UNION ALL SELECT x.tx, CASE WHEN x.strand = '-' THEN '3utr' ELSE '5utr' END, x.start, least(x."end", c.lo) FROM x JOIN (SELECT tx, min(start) AS lo FROM x WHERE start % 300 = 0 GROUP BY tx) c USING (tx) WHERE x.start < least(x."end", c.lo)
 UNION ALL SELECT x.tx, CASE WHEN x.strand = '-' THEN '5utr' ELSE '3utr' END, greatest(x.start, c.hi), x."end" FROM x JOIN (SELECT tx, max("end") AS hi FROM x WHERE start % 300 = 0 GROUP BY tx) c USING (tx) WHERE greatest(x.start, c.hi) < x."end\"""")
def a10_gene_regions(spark, sf):
    x = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("tx"), F.lit("c").alias("chrom"), F.when(F.col("l_orderkey") % 2 == 0, "-").otherwise("+").alias("strand"), (F.col("l_partkey") * 100).alias("start"), (F.col("l_partkey") * 100 + 50).alias("end")).distinct()
    return I.gene_regions(x, x.where("start % 300 = 0")).select("tx", "kind", "start", "end")


@query("""WITH i AS (SELECT l_quantity::BIGINT AS n, row_number() OVER (ORDER BY l_quantity) AS r, count(*) OVER () AS t FROM lineitem)
 SELECT min(n) FILTER (r >= greatest(floor(t * 0.05), 1)) AS low, min(n) FILTER (r >= greatest(floor(t * 0.95), 1)) AS high FROM i""")
def a34_intron_percentiles(spark, sf):
    return I.intron_percentiles(table(spark, sf, "lineitem").select(F.lit(0).cast("bigint").alias("start"), F.col("l_quantity").cast("bigint").alias("end")), 0.05, 0.95)


@query(f'WITH x AS (SELECT name AS tx, chrom AS gene, "end" - start AS n FROM ({_AF})), t AS (SELECT tx, sum(n) AS n FROM x GROUP BY tx) SELECT gene, max(t.n)::BIGINT AS length FROM t JOIN (SELECT DISTINCT tx, gene FROM x) USING (tx) GROUP BY gene')
def a8_feature_lengths(spark, sf):
    x = _sides(spark, sf)[0].select(F.col("name").alias("tx"), F.col("chrom").alias("gene"), "start", "end")
    return I.feature_lengths(x, x)


@query("""WITH r AS (SELECT o_orderkey AS read, o_orderstatus <> 'F' AS aligned FROM orders), h AS (SELECT DISTINCT l_orderkey AS read, 'g' || l_suppkey AS gene FROM lineitem),
 n AS (SELECT read, count(*) AS n FROM h GROUP BY read), l AS (SELECT 'g' || s_suppkey AS gene, s_suppkey * 10 AS length FROM supplier WHERE s_suppkey % 5 <> 0)
 SELECT read, coalesce(gene, '') AS gene, round(CASE WHEN aligned THEN 1.0 / coalesce(n, 1) ELSE 0 END, 9) AS weight, round(CASE WHEN aligned AND length IS NOT NULL THEN 1.0 / n / (length / 1000.0) ELSE 0 END, 9) AS rpk
 FROM r LEFT JOIN h USING (read) LEFT JOIN n USING (read) LEFT JOIN l USING (gene)""")
def a9_fractional_counts(spark, sf):
    reads = table(spark, sf, "orders").select(F.col("o_orderkey").alias("read"), (F.col("o_orderstatus") != "F").alias("aligned"))
    hits = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("read"), F.concat(F.lit("g"), F.col("l_suppkey").cast("string")).alias("gene"))
    lengths = table(spark, sf, "supplier").where("s_suppkey % 5 <> 0").select(F.concat(F.lit("g"), F.col("s_suppkey").cast("string")).alias("gene"), (F.col("s_suppkey") * 10).alias("length"))
    return I.fractional_counts(reads, hits, lengths).withColumns({"weight": _r("weight", 9), "rpk": _r("rpk", 9)})


# --- hits -----------------------------------------------------------------------

_TOP = "SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY query ORDER BY bits DESC, evalue, hit) = 1"


@query(f"WITH h AS ({B.HITS}) SELECT q.query, coalesce(max(bits), 0) AS bits, coalesce(min(evalue), 1) AS evalue FROM (SELECT DISTINCT query FROM h) q LEFT JOIN (SELECT * FROM h WHERE query = hit) s USING (query) GROUP BY q.query")
def j15_self_scores(spark, sf):
    return H.self_scores(run(spark, sf, B.HITS))


@query(f"WITH h AS ({B.HITS}), b AS ({_TOP}), n AS (SELECT *, max(bits) OVER (PARTITION BY query) AS m FROM h) SELECT n.query, n.hit, n.bits, n.evalue, EXISTS (SELECT 1 FROM b WHERE b.query = n.hit AND b.hit = n.query) AS is_rbh FROM n WHERE bits >= 0.9 * m")
def j12_near_best_hits(spark, sf):
    hits = run(spark, sf, B.HITS)
    return H.near_best_hits(hits, 0.9, H.top_hits(hits)).select("query", "hit", "bits", "evalue", "is_rbh")


@query(f"""WITH h AS ({B.HITS}), u AS (SELECT * FROM h WHERE evalue <= 0.05), s AS (SELECT query, bits AS sb FROM h WHERE query = hit),
 r AS (SELECT *, max(bits) OVER (PARTITION BY query) AS m, row_number() OVER (PARTITION BY query ORDER BY bits DESC, evalue, hit) AS n FROM u),
 c AS (SELECT r.query, r.hit, r.bits, coalesce(r.bits >= 0.9 * coalesce(q.sb, 0), false) AS oq, coalesce(r.bits >= 0.9 * t.sb, false) AS os, n FROM r LEFT JOIN s q ON r.query = q.query LEFT JOIN (SELECT d.query, coalesce(sb, 0) AS sb FROM (SELECT DISTINCT query FROM h) d LEFT JOIN s USING (query)) t ON r.hit = t.query WHERE r.bits >= m - 2),
 k AS (SELECT query, hit, bits, CASE WHEN oq AND os THEN '==' WHEN os THEN '=~' WHEN oq THEN '~=' WHEN n = 1 THEN '~~' END AS class FROM c) SELECT * FROM k WHERE class IS NOT NULL""")
def j11_best_hit(spark, sf):
    hits = run(spark, sf, B.HITS)
    own = H.self_scores(hits)
    return H.best_hit(hits, own, own, 0.9, 0.05)


_PLACES = "SELECT concat('n', CAST(p_partkey AS STRING)) AS name, CAST(p_size AS STRING) AS chrom, CAST(p_retailprice AS BIGINT) AS start, CAST(p_retailprice AS BIGINT) + 500 AS \"end\", '+' AS strand FROM part"


@query(f"""WITH l AS ({_PLACES}), h AS (SELECT DISTINCT 'n' || l_suppkey AS query, 'n' || l_partkey AS hit FROM lineitem WHERE l_discount >= 0.09),
 o AS (SELECT query, hit, max({_OV}) AS o FROM h JOIN l a ON a.name = query JOIN l b ON b.name = hit WHERE {_ON} AND {_OV} >= 0.7 * 500 GROUP BY ALL),
 t AS (SELECT h.query, h.hit, o, count(*) OVER w AS n, max(o) OVER w AS m FROM h LEFT JOIN o USING (query, hit) WINDOW w AS (PARTITION BY h.query))
 SELECT query, hit, n = 1 OR m IS NOT NULL AS settled FROM t WHERE n = 1 OR m IS NULL OR o = m""")
def j11_settle_by_overlap(spark, sf):
    hits = table(spark, sf, "lineitem").where("l_discount >= 0.09").select(F.concat(F.lit("n"), F.col("l_suppkey").cast("string")).alias("query"), F.concat(F.lit("n"), F.col("l_partkey").cast("string")).alias("hit")).distinct()
    at = run(spark, sf, _PLACES)
    return H.settle_by_overlap(hits, at, at)


@query(f"""WITH h AS ({B.HITS}), t AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bits DESC, hit) AS n FROM h)
 SELECT 'A' AS qdb, t.query, 'A' AS sdb, string_agg(t.hit || CASE WHEN b.query IS NULL THEN '' ELSE '*' END, ';' ORDER BY t.n) AS marked FROM t LEFT JOIN t b ON b.query = t.hit AND b.hit = t.query GROUP BY t.query""")
def j13_mark_reciprocal(spark, sf):
    hits = run(spark, sf, B.HITS)
    return H.mark_reciprocal(H.ranked_hits(hits).select(F.lit("A").alias("qdb"), "query", F.lit("A").alias("sdb"), "hits"))


@query(f"""WITH h AS ({B.HITS}), r AS (SELECT *, bits > 0.95 * max(bits) OVER (PARTITION BY query) AND substr(query, 2) > substr(hit, 2) AS is_rbh FROM h),
 f AS (SELECT * FROM r WHERE NOT is_rbh AND bits >= 5 AND evalue <= 0.05 AND query NOT IN (SELECT query FROM r WHERE is_rbh) AND hit NOT IN (SELECT hit FROM r WHERE is_rbh)),
 b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY query ORDER BY bits DESC, evalue, hit) = 1)
 SELECT query, hit, bits, evalue FROM b QUALIFY count(*) OVER (PARTITION BY hit) = 1""")
def j14_exclusive_pairs(spark, sf):
    hits = run(spark, sf, B.HITS)
    near = hits.join(hits.groupBy("query").agg(F.max("bits").alias("m")), "query")
    marked = near.withColumn("is_rbh", (F.col("bits") > 0.95 * F.col("m")) & (F.substring("query", 2, 10) > F.substring("hit", 2, 10)))
    return H.exclusive_pairs(marked.drop("m"), 5, 0.05)


@query(f"""WITH h AS ({B.HITS}), n AS (SELECT query, hit, CASE WHEN bits > 100 THEN '==' ELSE '~=' END AS c FROM h WHERE evalue <= 0.001),
 r AS (SELECT query, string_agg(hit || '[' || c || ']', ';' ORDER BY hit || '[' || c || ']') AS t FROM n WHERE c = '==' GROUP BY query), p AS (SELECT query, string_agg(hit || '[' || c || ']', ';' ORDER BY hit || '[' || c || ']') AS t FROM n WHERE c = '~=' GROUP BY query)
 SELECT 'A' AS qdb, 'B' AS sdb, coalesce(r.query, p.query) AS query, coalesce(r.t, '') AS rna, coalesce(p.t, '') AS protein FROM r FULL JOIN p ON r.query = p.query""")
def a36_relation_table(spark, sf):
    n = run(spark, sf, B.HITS).where("evalue <= 0.001").select(F.lit("A").alias("qdb"), F.lit("B").alias("sdb"), "query", "hit", F.when(F.col("bits") > 100, "==").otherwise("~=").alias("class"))
    names = n.select(F.concat(F.lit("P"), "query").alias("protein"), "query").distinct()
    return H.relation_table(n.where("class = '=='"), n.where("class = '~='").withColumn("query", F.concat(F.lit("P"), "query")), names)


# --- taxa -----------------------------------------------------------------------

_CL = f"WITH nodes AS ({B.NODES}), cl AS ({B.CLOSURE_SQL})"


def _paths(spark, sf):
    return TX.taxon_paths(run(spark, sf, B.NODES))


@query(f"{_CL} SELECT * FROM cl")
def taxon_closure(spark, sf):
    return TX.taxon_closure(run(spark, sf, B.NODES))


@query("SELECT o_orderkey, coalesce(n, x) AS ids FROM (SELECT o_orderkey, unnest([o_custkey, o_custkey + 1]) AS x FROM orders) LEFT JOIN (SELECT c_custkey AS o, c_custkey + 100000 AS n FROM customer WHERE c_nationkey = 3) ON x = o")
def j8_replace_merged(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.concat_ws(" ", F.col("o_custkey").cast("string"), (F.col("o_custkey") + 1).cast("string")).alias("ids"))
    merged = table(spark, sf, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("old"), (F.col("c_custkey") + 100000).alias("new"))
    return TX.replace_merged(df, merged, "ids")


@query(f"{_CL}, k AS (SELECT ancestor AS target, descendant AS taxid FROM cl WHERE ancestor IN (11, 103) UNION SELECT descendant, ancestor FROM cl WHERE descendant IN (11, 103)) SELECT target, o_orderkey AS read FROM orders JOIN k ON taxid = CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE o_custkey + 1000 END")
def j16_reads_by_taxa(spark, sf):
    reads = table(spark, sf, "orders").select(F.col("o_orderkey").alias("read"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(1)).otherwise(F.col("o_custkey") + 1000).cast("bigint").alias("taxid"))
    targets = spark.range(2).select(F.when(F.col("id") == 0, 11).otherwise(103).cast("bigint").alias("taxid"))
    return TX.reads_by_taxa(reads, _paths(spark, sf), targets)


@query(f"{_CL}, k AS (SELECT descendant AS t FROM cl WHERE ancestor = 12 UNION SELECT ancestor FROM cl WHERE descendant = 12) SELECT o_orderkey FROM orders WHERE o_custkey + 1000 IN (SELECT t FROM k) OR o_custkey + 1001 IN (SELECT t FROM k)")
def j17_taxon_compatible(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.concat_ws("__", (F.col("o_custkey") + 1000).cast("string"), (F.col("o_custkey") + 1001).cast("string")).alias("ids"))
    return TX.taxon_compatible(df, _paths(spark, sf), "ids", 12).select("o_orderkey")


@query(f"""{_CL}, m AS (SELECT DISTINCT l_partkey AS k, o_custkey + 1000 AS t FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IN (SELECT c_custkey FROM customer)), n AS (SELECT k, count(*) AS n FROM m GROUP BY k),
 s AS (SELECT k, ancestor, count(*) AS c, max(depth) AS far FROM m JOIN cl ON t = descendant GROUP BY ALL) SELECT k, arg_min(ancestor, far) AS lca FROM s JOIN n USING (k) WHERE c = n GROUP BY k""")
def a35_lca(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    m = o.join(li, o["o_orderkey"] == li["l_orderkey"]).select(F.col("l_partkey").alias("k"), (F.col("o_custkey") + 1000).alias("t"))
    return TX.lca(m, _paths(spark, sf), "k", "t")


# --- features -------------------------------------------------------------------

_F = f"WITH f AS ({B.features('duckdb')})"


# Nations, customers, orders and lines: four levels; orders of every third customer have no place, as it is missing.
_DEEP = """SELECT concat('n', CAST(n_nationkey AS STRING)) AS id, CAST(NULL AS STRING) AS parent, 'c' AS seqid, CAST(n_nationkey % 5 AS BIGINT) AS start, CAST(9 AS BIGINT) AS "end" FROM nation
 UNION ALL SELECT concat('k', CAST(c_custkey AS STRING)), concat('n', CAST(c_nationkey AS STRING)), 'c', CAST(c_custkey % 7 AS BIGINT), CAST(9 AS BIGINT) FROM customer WHERE c_custkey % 3 <> 0
 UNION ALL SELECT concat('o', CAST(o_orderkey AS STRING)), concat('k', CAST(o_custkey AS STRING)), 'c', CAST(o_orderkey % 11 AS BIGINT), CAST(9 AS BIGINT) FROM orders
 UNION ALL SELECT DISTINCT concat('l', CAST(l_orderkey AS STRING), '.', CAST(l_linenumber AS STRING)), concat('o', CAST(l_orderkey AS STRING)), 'c', CAST(l_linenumber AS BIGINT), CAST(9 AS BIGINT) FROM lineitem"""
_PATHS = f"""WITH f AS ({_DEEP}), s AS (SELECT id, parent, [{{'seqid': seqid, 'start': start, 'end': "end", 'id': id}}] AS own FROM f),
 l1 AS (SELECT id, own AS path FROM s WHERE parent IS NULL), l2 AS (SELECT s.id, path || own AS path FROM s JOIN l1 ON parent = l1.id), l3 AS (SELECT s.id, path || own AS path FROM s JOIN l2 ON parent = l2.id), l4 AS (SELECT s.id, path || own AS path FROM s JOIN l3 ON parent = l3.id),
 p AS (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3 UNION ALL SELECT * FROM l4)"""


@query(f"{_PATHS} SELECT id, row_number() OVER (ORDER BY path) AS n FROM p")
def s1_sort_hierarchy(spark, sf):
    from omicspark.operators.ranks import global_row_number
    from omicspark.storage import materialize, parts_of

    # Written, as ranges are found by a first pass over the paths.
    paths = materialize(FT.place_in_hierarchy(run(spark, sf, _DEEP))[0].select("id", "path"), "paths")
    return global_row_number(paths, ["path"], "n", parts_of(paths.count())).select("id", "n")


@query(f"{_PATHS} SELECT id, parent FROM f WHERE id NOT IN (SELECT id FROM p)")
def s1_without_place(spark, sf):
    return FT.sort_hierarchy(run(spark, sf, _DEEP))[1].select("id", "parent")


@query(f"{_F} SELECT f.id, f.parent FROM f ANTI JOIN f p ON f.parent = p.id WHERE f.parent IS NOT NULL")
def s1_orphans(spark, sf):
    return FT.sort_hierarchy(run(spark, sf, B.features("spark")))[1].select("id", "parent")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN count(*) OVER w > 1 THEN l_partkey || '_' || row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) ELSE l_partkey::STRING END AS new_id FROM lineitem WINDOW w AS (PARTITION BY l_partkey)")
def w4_disambiguate(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_partkey").cast("string").alias("p"), "l_partkey")
    return FT.disambiguate(df, "p", ["l_orderkey", "l_linenumber", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_partkey", "new_id")


@query(f"{_F}, o AS (SELECT f.* FROM f ANTI JOIN f p ON f.parent = p.id WHERE f.parent IS NOT NULL) SELECT id, parent, seqid, start, \"end\", strand, type FROM f UNION ALL SELECT parent, NULL, min(seqid), min(start), max(\"end\"), min(strand), 'gene' FROM o GROUP BY parent")
def a11_complete_hierarchy(spark, sf):
    return FT.complete_hierarchy(run(spark, sf, B.features("spark")), "gene")


@query("""SELECT l_orderkey AS tx, l_linenumber AS start, pmod AS phase FROM (SELECT l_orderkey, l_linenumber, ((3 - coalesce(sum(n) OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_orderkey % 2 = 0 THEN -l_linenumber ELSE l_linenumber END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 3) % 3)::INT AS pmod FROM (SELECT l_orderkey, l_linenumber, sum(l_quantity)::BIGINT AS n FROM lineitem GROUP BY ALL))""")
def w7_cds_phase(spark, sf):
    x = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("n"))
    cds = x.select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("start"), (F.col("l_linenumber") + F.col("n")).alias("end"), F.when(F.col("l_orderkey") % 2 == 0, "-").otherwise("+").alias("strand"))
    return FT.cds_phase(cds).select("tx", "start", "phase")


@query("SELECT 'e' || l_orderkey || '.' || l_linenumber || '.' || l_partkey AS id, 't' || l_suppkey AS tx, CASE l_suppkey % 3 WHEN 0 THEN (l_suppkey * 7)::STRING WHEN 1 THEN 'LOC' || l_suppkey ELSE 'g' || l_suppkey END AS gene FROM lineitem")
def j7_gff_to_gtf(spark, sf):
    e = table(spark, sf, "lineitem").select(F.concat(F.lit("e"), F.concat_ws(".", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])).alias("id"), F.concat(F.lit("t"), F.col("l_suppkey").cast("string")).alias("parent"), F.lit("").alias("attributes"))
    n = F.col("s_suppkey")
    t = table(spark, sf, "supplier").select(F.concat(F.lit("t"), n.cast("string")).alias("id"), F.concat(F.lit("g"), n.cast("string")).alias("parent"), F.when(n % 3 == 0, F.concat(F.lit("Dbxref=GeneID:"), (n * 7).cast("string"))).when(n % 3 == 1, F.concat(F.lit("gene=LOC"), n.cast("string"))).otherwise("").alias("attributes"))
    return FT.gff_to_gtf(e.unionByName(t)).where("id LIKE 'e%'")


@query("SELECT o_orderkey, n_name AS symbol FROM orders LEFT JOIN nation ON o_custkey % 40 = n_nationkey AND n_regionkey = 1")
def j5_gene_info(spark, sf):
    f = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("Dbxref=GeneID:"), (F.col("o_custkey") % 40).cast("string")).alias("attributes"))
    info = table(spark, sf, "nation").select(F.col("n_regionkey").alias("tax_id"), F.col("n_nationkey").cast("bigint").alias("gene_id"), F.col("n_name").alias("symbol"), F.lit("").alias("description"))
    return FT.gene_info(f, info, 1).select("o_orderkey", "symbol")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 30 < 25 THEN 'g' || s_suppkey % 30 END AS gene FROM supplier")
def j6_add_gene(spark, sf):
    df = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("tx=<"), (F.col("s_suppkey") % 30).cast("string"), F.lit(">")).alias("col"))
    n = F.col("n_nationkey").cast("string")
    half = F.col("n_nationkey") % 2 == 0
    feats = table(spark, sf, "nation").select(F.when(half, F.concat(F.lit("<"), n, F.lit(">"))).otherwise(F.concat(F.lit("rna-<"), n, F.lit(">.1"))).alias("id"), F.concat(F.lit("g"), n).alias("parent"))
    return FT.add_gene(df, feats, "col", "(<.*>)").select("s_suppkey", "gene")


@query("SELECT 'n' || n_nationkey || '_e' || i AS name, n_nationkey * 100 + i * 10 AS start, n_nationkey * 100 + i * 10 + 5 AS \"end\", CASE WHEN n_nationkey % 2 = 0 THEN -1 ELSE 1 END AS strand FROM nation, range(1, 4) t(i)")
def x7_explode_exons(spark, sf):
    n = F.col("n_nationkey").cast("bigint")
    starts = F.concat(*[x for i in (1, 2, 3) for x in ((n * 100 + i * 10).cast("string"), F.lit(","))])
    ends = F.concat(*[x for i in (1, 2, 3) for x in ((n * 100 + i * 10 + 5).cast("string"), F.lit(","))])
    df = table(spark, sf, "nation").select(F.concat(F.lit("n"), n.cast("string")).alias("name"), F.lit("c").alias("chrom"), F.when(n % 2 == 0, "-").otherwise("+").alias("strand"), starts.alias("exon_starts"), ends.alias("exon_ends"))
    return FT.explode_exons(df).select("name", "start", "end", "strand")


@query(f"SELECT read_id || '.' || k AS id, k AS type, 0::BIGINT AS start, 32::BIGINT AS \"end\" FROM ({B.READS}), (SELECT unnest(['gene', 'exon']) AS k)")
def x20_sequences_as_features(spark, sf):
    return FT.sequences_as_features(run(spark, sf, B.READS).select(F.col("read_id").alias("seq_id"), "seq")).select("id", "type", "start", "end")


_GENOME = "SELECT doc_id AS chrom, translate(repeat(md5(text), 30), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM documents"
_PARTS = "SELECT DISTINCT concat(l_orderkey, '.', l_linenumber, '.', l_suppkey, '.', l_partkey % 960) AS id, l_suppkey AS chrom, l_partkey % 960 AS start, l_partkey % 960 + 40 AS \"end\", CASE WHEN l_orderkey % 2 = 0 THEN '-' ELSE '+' END AS strand FROM lineitem"


def _cut_out(low: str, high: str) -> str:
    part = f"substr(seq, ({low}) + 1, ({high}) - ({low}))"
    return f"WITH g AS ({_GENOME}), p AS ({_PARTS}) SELECT id, CASE WHEN strand = '-' THEN reverse(translate({part}, 'ACGT', 'TGCA')) ELSE {part} END AS seq FROM p JOIN g USING (chrom)"


@query(_cut_out("start", '"end"'))
def x14_extract_sequences(spark, sf):
    return FT.extract_sequences(run(spark, sf, _PARTS), run(spark, sf, _GENOME), tile=64)


@query(_cut_out("CASE WHEN strand = '-' THEN greatest(start - 25, 0) ELSE start END", "CASE WHEN strand = '-' THEN \"end\" ELSE \"end\" + 25 END"))
def x14_extended_sequences(spark, sf):
    return FT.extract_sequences(run(spark, sf, _PARTS), run(spark, sf, _GENOME), tile=64, ext3=25)


@query("SELECT doc_id, substr(md5(text), 1, 10) AS utr5, substr(md5(text), 21) AS utr3, true AS found FROM documents")
def x15_split_utr(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("tx_seq"), F.substring(F.md5("text"), 11, 10).alias("cds_seq"))
    return FT.split_utr(df).select("doc_id", "utr5", "utr3", "found")


@query(f"{_F} SELECT seqid, count(*) AS n, count(*) FILTER (type = 'gene') AS genes, count(*) FILTER (type = 'mRNA') AS mrnas, count(*) FILTER (type = 'tRNA') AS ncrnas, count(DISTINCT seqid) AS scaffolds FROM f GROUP BY ROLLUP (seqid)")
def a27_feature_stats(spark, sf):
    f = run(spark, sf, B.features("spark")).withColumn("grp", F.col("seqid"))
    return FT.feature_stats(f, "grp").withColumnRenamed("grp", "seqid")


@query("""WITH c AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS d, 1 AS t FROM part UNION ALL SELECT p_partkey, p_type, 2 FROM part UNION ALL SELECT p_partkey, split_part(p_name, ' ', 1), 3 FROM part)
 SELECT p_partkey, count(*) AS n_domains, string_agg(d, ';' ORDER BY d) AS domains FROM (SELECT p_partkey, d FROM c GROUP BY ALL HAVING count(DISTINCT t) >= 2) GROUP BY p_partkey""")
def a12_consensus_domains(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("(2)+")).alias("a"), F.col("p_type").alias("b"), F.substring_index("p_name", " ", 1).alias("c"))
    return FT.consensus_domains(df, ["a", "b", "c"], 2, "p_partkey")


@query("SELECT c_custkey AS id, coalesce(n_name, '') AS header FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 2")
def j3_annotate_via_cluster(spark, sf):
    df = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    clusters = table(spark, sf, "customer").select(F.col("c_nationkey").alias("cluster"), F.col("c_custkey").alias("member"))
    refs = table(spark, sf, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("cluster"), F.col("n_name").alias("header"))
    return FT.annotate_via_cluster(df, clusters, refs)


@query("""WITH o AS (SELECT DISTINCT o_custkey AS acc, unnest(['GO:' || o_orderstatus, 'GO:' || left(o_orderpriority, 1)]) AS t FROM orders), s AS (SELECT DISTINCT c_nationkey AS k, t FROM customer JOIN o ON acc = c_custkey)
 SELECT c_custkey AS id, coalesce(string_agg(t, ';' ORDER BY t), '') AS terms FROM customer LEFT JOIN s ON k = c_nationkey GROUP BY c_custkey""")
def j4_annotate_domains(spark, sf):
    domains = table(spark, sf, "orders").select(F.col("o_custkey").alias("acc"), F.lit("Pfam").alias("analysis"), F.lit("x").alias("analysis_id"), F.lit("").alias("ipr_id"), F.concat(F.lit("GO:"), "o_orderstatus", F.lit("|GO:"), F.left("o_orderpriority", F.lit(1))).alias("gos"), F.lit("").alias("paths"))
    clusters = table(spark, sf, "customer").select(F.col("c_nationkey").alias("cluster"), F.col("c_custkey").alias("member"))
    return FT.annotate_domains(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), domains, "GO", clusters)


@query("SELECT o_orderkey AS tree, leaf, coalesce(n_name, '') AS description FROM (SELECT DISTINCT o_orderkey, unnest([o_custkey % 30, o_orderkey % 30])::STRING AS leaf FROM orders) LEFT JOIN nation ON n_nationkey::STRING = leaf")
def j22_leaf_annotations(spark, sf):
    texts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("tree"), F.concat(F.lit("(leaf:"), (F.col("o_custkey") % 30).cast("string"), F.lit(",leaf:"), (F.col("o_orderkey") % 30).cast("string"), F.lit(");")).alias("text"))
    return FT.leaf_annotations(texts, table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("description")), r"leaf:(\d+)")


_KIND = "CASE WHEN l_linenumber = 1 THEN 'CDS' WHEN l_linenumber % 2 = 0 THEN 'five_prime_UTR' ELSE 'three_prime_UTR' END"


@query(f"""WITH p AS (SELECT l_orderkey AS k, bool_or(t = 'CDS') AS c, bool_or(t = 'five_prime_UTR') AS a, bool_or(t = 'three_prime_UTR') AS b FROM (SELECT l_orderkey, {_KIND} AS t FROM lineitem WHERE l_quantity > 20) GROUP BY l_orderkey)
 SELECT o_orderstatus AS grp, count(*) AS mrnas, count(*) FILTER (c AND a AND b) AS utr5_cds_utr3, count(*) FILTER (c AND a AND NOT b) AS utr5_cds, count(*) FILTER (c AND b AND NOT a) AS cds_utr3, count(*) FILTER (c AND NOT a AND NOT b) AS cds FROM orders LEFT JOIN p ON k = o_orderkey GROUP BY ROLLUP (o_orderstatus)""")
def a27_coding_stats(spark, sf):
    mrnas = table(spark, sf, "orders").select(F.concat(F.lit("m"), "o_orderkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.lit("mRNA").alias("type"), F.col("o_orderstatus").alias("grp"))
    parts = table(spark, sf, "lineitem").where("l_quantity > 20").select(F.lit("x").alias("id"), F.concat(F.lit("m"), "l_orderkey").alias("parent"), F.expr(_KIND).alias("type"), F.lit("-").alias("grp"))
    return FT.coding_stats(mrnas.unionByName(parts), "grp")


@query("""WITH o AS (SELECT o_custkey AS acc, o_orderstatus AS t, min('about ' || o_orderpriority) AS d FROM orders GROUP BY ALL), s AS (SELECT c_nationkey AS k, t, min(d) AS d FROM customer JOIN o ON acc = c_custkey GROUP BY ALL)
 SELECT c_custkey AS id, coalesce(string_agg(t, ';' ORDER BY t), '') AS terms, coalesce(string_agg(d, ';' ORDER BY t), '') AS descriptions FROM customer LEFT JOIN s ON k = c_nationkey GROUP BY c_custkey""")
def j4_domain_descriptions(spark, sf):
    domains = table(spark, sf, "orders").select(F.col("o_custkey").alias("acc"), F.lit("Pfam").alias("analysis"), F.col("o_orderstatus").alias("analysis_id"), F.concat(F.lit("about "), "o_orderpriority").alias("analysis_desc"))
    clusters = table(spark, sf, "customer").select(F.col("c_nationkey").alias("cluster"), F.col("c_custkey").alias("member"))
    return FT.annotate_domains(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), domains, "Pfam", clusters, describe=True)


@query("""SELECT o_orderkey AS tree, leaf, coalesce(n_name, '') AS description, coalesce('SF' || s_suppkey % 7, '') AS subfamily, CASE WHEN l::INTEGER % 4 = 0 THEN '**' WHEN l::INTEGER % 2 = 0 THEN '*' ELSE '' END AS mark, n_regionkey::BIGINT AS tax_id, coalesce(r_name, '') AS taxon
 FROM (SELECT o_orderkey, leaf, leaf AS l FROM (SELECT DISTINCT o_orderkey, unnest([o_custkey % 30, o_orderkey % 30])::STRING AS leaf FROM orders)) LEFT JOIN nation ON n_nationkey::STRING = leaf LEFT JOIN supplier ON s_suppkey::STRING = leaf LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey > 1""")
def j22_leaf_memberships(spark, sf):
    texts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("tree"), F.concat(F.lit("(leaf:"), (F.col("o_custkey") % 30).cast("string"), F.lit(",leaf:"), (F.col("o_orderkey") % 30).cast("string"), F.lit(");")).alias("text"))
    known = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.concat("n_name", F.lit(" n=3 Tax=x TaxID="), "n_regionkey").alias("description"))
    groups = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("SF"), F.col("s_suppkey") % 7).alias("subfamily"))
    leaf = (F.col("o_orderkey") % 30).alias("n")
    both = table(spark, sf, "orders").select(F.explode(F.array(leaf, F.col("o_custkey") % 30)).alias("n")).where("n % 2 = 0").select(F.col("n").cast("string").alias("id"), (F.col("n") % 4 == 0).alias("seed"))
    taxa = table(spark, sf, "region").where("r_regionkey > 1").select(F.col("r_regionkey").cast("bigint").alias("taxid"), F.col("r_name").alias("taxon"))
    return FT.leaf_annotations(texts, known, r"leaf:(\d+)", groups, both, taxa)


# --- expression -----------------------------------------------------------------

_C = f"WITH c AS ({B.COUNTS})"
_SAMPLES = ["AF", "AO", "NF", "NO", "RF", "RO"]


@query(f"""{_C}, a AS (SELECT feature, sample, value + 1 AS value FROM c), t AS (SELECT sample, sum(value) AS t FROM a GROUP BY sample), f AS (SELECT DISTINCT feature FROM a),
 v AS (SELECT f.feature, t.sample, round(coalesce(a.value, 0) * 1e6 / t, 2) AS v FROM f CROSS JOIN t LEFT JOIN a ON a.feature = f.feature AND a.sample = t.sample)
 SELECT x.feature, x.sample AS first, y.sample AS second, x.v AS cpm_1, y.v AS cpm_2, CASE WHEN x.v > 0 AND y.v > 0 THEN round(log2(x.v / y.v), 6) END AS log2_fold FROM v x JOIN v y ON x.feature = y.feature AND x.sample < y.sample""")
def a17_cpm_fold(spark, sf):
    return E.cpm_fold(run(spark, sf, B.COUNTS), _SAMPLES).withColumn("log2_fold", _r("log2_fold"))


@query("""WITH x AS (SELECT l_partkey, sum(l_quantity) FILTER (l_returnflag = 'A')::BIGINT % 60 AS x, sum(l_quantity) FILTER (l_returnflag = 'R')::BIGINT % 60 AS y FROM lineitem GROUP BY l_partkey)
 SELECT l_partkey, round(exp(y * ln(8e3 / 1e4) + lgamma(x + y + 1) - lgamma(x + 1) - lgamma(y + 1) - (x + y + 1) * ln(1 + 8e3 / 1e4)), 9) AS p FROM x WHERE x IS NOT NULL AND y IS NOT NULL""")
def a18_audic_claverie(spark, sf):
    q = lambda f: (F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))).cast("bigint") % 60).alias
    x = table(spark, sf, "lineitem").groupBy("l_partkey").agg(q("A")("x"), q("R")("y")).where("x IS NOT NULL AND y IS NOT NULL").withColumns({"n1": F.lit(1e4), "n2": F.lit(8e3)})
    return x.select("l_partkey", _r(E.audic_claverie("x", "y", "n1", "n2"), 9).alias("p"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(log2((l_extendedprice + 1) / (l_quantity + 1)), 6) AS log2_fold FROM lineitem")
def a19_log2_fold(spark, sf):
    return E.log2_fold(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select("l_orderkey", "l_linenumber", "l_partkey", "log2_fold")


@query(f"{_C} SELECT feature, sample, round_even(value * CASE sample WHEN 'AF' THEN 0.5 ELSE 2.0 END, 0) AS value FROM c")
def a20_denormalize(spark, sf):
    c = run(spark, sf, B.COUNTS)
    return E.denormalize(c, c.select("sample").distinct().withColumn("scale", F.when(F.col("sample") == "AF", 0.5).otherwise(2.0)))


_FACTORS = "m AS (SELECT feature, avg(ln(value)) AS m FROM c GROUP BY feature HAVING count(*) = 6), sf AS (SELECT sample, exp(quantile_cont(ln(value) - m, 0.5)) AS f FROM c JOIN m USING (feature) GROUP BY sample)"


@query(f"{_C}, {_FACTORS} SELECT sample, round(f, 6) AS factor FROM sf")
def a21_size_factors(spark, sf):
    c = run(spark, sf, B.COUNTS)
    return E.size_factors(c, 6).select("sample", _r("factor").alias("factor"))


@query(f"{_C}, {_FACTORS} SELECT feature, CASE sample WHEN 'NO' THEN 'open' ELSE 'done' END AS \"group\", round(avg(value / f), 6) AS mean FROM c JOIN sf USING (sample) GROUP BY ALL")
def a21_group_means(spark, sf):
    c = run(spark, sf, B.COUNTS)
    design = c.select("sample").distinct().withColumn("group", F.when(F.col("sample") == "NO", "open").otherwise("done"))
    return E.group_means(E.normalized(c, E.size_factors(c, 6)), design).withColumn("mean", _r("mean"))


@query(f"""{_C}, t AS (SELECT sample, sum(value) AS n FROM c GROUP BY sample), s AS (SELECT * FROM c JOIN t USING (sample) WHERE value > 0), r AS (SELECT feature, value AS r, n AS rn FROM s WHERE sample = 'AF'),
 b AS (SELECT sample, log2(value / n / (r / rn)) AS m, log2(value / n * r / rn) / 2 AS a, 1 / ((n - value) / (n * value) + (rn - r) / (rn * r)) AS w FROM s JOIN r USING (feature)),
 q AS (SELECT sample, quantile_cont(m, 0.3) AS ml, quantile_cont(m, 0.7) AS mh, quantile_cont(a, 0.05) AS al, quantile_cont(a, 0.95) AS ah FROM b GROUP BY sample)
 SELECT sample, round(pow(2, sum(w * m) / sum(w)), 6) AS factor FROM b JOIN q USING (sample) WHERE m BETWEEN ml AND mh AND a BETWEEN al AND ah GROUP BY sample""")
def a22_tmm_factors(spark, sf):
    c = run(spark, sf, B.COUNTS)
    return E.tmm_factors(c, "AF").select("sample", _r("factor").alias("factor"))


@query(f"""{_C}, t AS (SELECT sample, sum(value) AS n FROM c GROUP BY sample), s AS (SELECT * FROM c JOIN t USING (sample) WHERE value > 0), r AS (SELECT feature, value AS r, n AS rn FROM s WHERE sample = 'AF'),
 b AS (SELECT sample, log2(value / n / (r / rn)) AS m, log2(value / n * r / rn) / 2 AS a, 1 / ((n - value) / (n * value) + (rn - r) / (rn * r)) AS w FROM s JOIN r USING (feature)),
 q AS (SELECT sample, quantile_cont(m, 0.3) AS ml, quantile_cont(m, 0.7) AS mh, quantile_cont(a, 0.05) AS al, quantile_cont(a, 0.95) AS ah FROM b GROUP BY sample),
 f AS (SELECT sample, pow(2, sum(w * m) / sum(w)) AS f FROM b JOIN q USING (sample) WHERE m BETWEEN ml AND mh AND a BETWEEN al AND ah GROUP BY sample)
 SELECT feature, sample, round(value * 1e6 / (n * f), 4) AS value FROM c JOIN t USING (sample) JOIN f USING (sample)""")
def a22_tmm_cpm(spark, sf):
    c = run(spark, sf, B.COUNTS)
    return E.tmm_cpm(c, "AF").withColumn("value", _r("value", 4))


@query()
def a31_sample_pca(spark, sf):
    return E.sample_pca(run(spark, sf, B.COUNTS), _SAMPLES)


@query("SELECT o_custkey AS gene, l_quantity AS score, l_discount AS evalue, l_partkey::STRING AS descr FROM lineitem JOIN orders ON l_orderkey = o_orderkey QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY l_quantity DESC, l_discount, l_partkey::STRING) = 1")
def a29_best_annotation(spark, sf):
    ann = table(spark, sf, "lineitem").select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".p1")).alias("tx"), F.col("l_quantity").alias("score"), F.col("l_discount").alias("evalue"), F.col("l_partkey").cast("string").alias("descr"))
    return E.best_annotation(ann, table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("tx"), F.col("o_custkey").alias("gene")))


@query("""WITH g AS (SELECT DISTINCT l_partkey AS gene FROM lineitem), ch AS (SELECT DISTINCT l_partkey AS gene FROM lineitem WHERE l_discount >= 0.1), s AS (SELECT DISTINCT p_type AS term, p_partkey AS gene FROM part WHERE p_partkey IN (SELECT gene FROM g)),
 n AS (SELECT (SELECT count(*) FROM g) AS t, (SELECT count(*) FROM ch) AS n), k AS (SELECT term, count(*) AS m, count(ch.gene) AS k FROM s LEFT JOIN ch USING (gene) GROUP BY term HAVING count(*) >= 10),
 lc AS (SELECT term, m, k, t, n, i, lgamma(m + 1) - lgamma(i + 1) - lgamma(m - i + 1) + lgamma(t - m + 1) - lgamma(n - i + 1) - lgamma(t - m - n + i + 1) - (lgamma(t + 1) - lgamma(n + 1) - lgamma(t - n + 1)) AS l FROM k, n, range(0, 100000) r(i) WHERE i BETWEEN k AND least(m, n) AND t - m - n + i >= 0)
 SELECT term, m AS size, k AS hits, round(least(1.0, sum(exp(l))), 6) AS p_value FROM lc GROUP BY ALL""")
def a30_enrich(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("gene"), "l_discount")
    sets = table(spark, sf, "part").select(F.col("p_type").alias("term"), F.col("p_partkey").alias("gene"))
    return E.enrich(sets, li, li.where("l_discount >= 0.1")).select("term", "size", "hits", _r("p_value").alias("p_value"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(log2(l_extendedprice + 1) - log2(l_quantity + 1), 6) AS m, round((log2(l_extendedprice + 1) + log2(l_quantity + 1)) / 2, 6) AS a FROM lineitem")
def a31_ma_values(spark, sf):
    return E.ma_values(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select("l_orderkey", "l_linenumber", "l_partkey", _r("m").alias("m"), _r("a").alias("a"))


@query(f"{_C} SELECT feature, round(avg(value), 6) AS mean, round(var_samp(value) / nullif(avg(value) * avg(value), 0), 4) AS cv2 FROM c GROUP BY feature")
def a31_cv2(spark, sf):
    return E.cv2(run(spark, sf, B.COUNTS)).select("feature", _r("mean").alias("mean"), _r("cv2", 4).alias("cv2"))


_WIDE = f"{_C}, w AS (SELECT f.feature, s.sample, coalesce(value, 0) AS v FROM (SELECT DISTINCT feature FROM c) f CROSS JOIN (SELECT DISTINCT sample FROM c) s LEFT JOIN c ON c.feature = f.feature AND c.sample = s.sample), p AS (SELECT l.sample AS x, r.sample AS y, l.v AS u, r.v AS v FROM w l JOIN w r ON l.feature = r.feature AND l.sample < r.sample)"


@query(f"{_WIDE} SELECT x AS a, y AS b, round(sqrt(sum((u - v) * (u - v))), 4) AS distance FROM p GROUP BY ALL")
def a31_euclidean(spark, sf):
    return E.euclidean_distance(run(spark, sf, B.COUNTS), _SAMPLES).withColumn("distance", _r("distance", 4))


@query(f"{_WIDE} SELECT x AS a, y AS b, round(sqrt(sum((CASE WHEN u > 0 THEN u * log2(u / ((u + v) / 2)) ELSE 0 END + CASE WHEN v > 0 THEN v * log2(v / ((u + v) / 2)) ELSE 0 END) / 2)), 4) AS distance FROM p GROUP BY ALL")
def a31_js_distance(spark, sf):
    return E.js_distance(run(spark, sf, B.COUNTS), _SAMPLES).withColumn("distance", _r("distance", 4))


@query("SELECT p_type AS term, count(*) AS n, count(*) FILTER (f > 0) AS up, count(*) FILTER (f < 0) AS down, round((count(*) FILTER (f > 0) - count(*) FILTER (f < 0)) / sqrt(count(*)), 6) AS zscore FROM (SELECT DISTINCT p_type, unnest([p_partkey, p_partkey + 1]) AS g FROM part) JOIN (SELECT s_suppkey AS g, s_acctbal - 4000 AS f FROM supplier) USING (g) GROUP BY p_type")
def j21_term_zscore(spark, sf):
    terms = table(spark, sf, "part").groupBy(F.col("p_type").alias("term")).agg(F.array_join(F.flatten(F.collect_list(F.array(F.col("p_partkey"), F.col("p_partkey") + 1))).cast("array<string>"), ",").alias("genes"))
    de = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("gene"), (F.col("s_acctbal") - 4000).alias("fold"))
    return E.term_zscore(terms, de).withColumn("zscore", _r("zscore"))


@query("""WITH t AS (SELECT ceil(count(*) / 1000.0)::BIGINT AS k FROM events), d AS (SELECT rep, user_id AS gene, CASE WHEN event_id % 3 = 0 THEN 0.5 ELSE 1.0 END AS w, event_id % 7 AS r, (event_id * 48271 * rep % 2147483647) % k + 1 AS chunk FROM events, range(1, 3) r(rep), t),
 c AS (SELECT rep, gene, chunk, sum(w) AS n, coalesce(sum(w) FILTER (w >= 1), 0) AS u, sum(r) AS r FROM d GROUP BY ALL), u AS (SELECT *, sum(n) OVER w AS upto, sum(r) OVER w AS rpk FROM c WHERE gene IS NOT NULL WINDOW w AS (PARTITION BY rep, gene ORDER BY chunk)), f AS (SELECT rep, gene, min(chunk) AS chunk FROM u WHERE upto >= 2 AND rpk >= 8 GROUP BY ALL),
 x AS (SELECT rep, chunk, count(*) AS g, count(c_custkey) AS o FROM f LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) ON gene = c_custkey GROUP BY ALL),
 s AS (SELECT rep, chunk, sum(n) AS n, sum(u) AS u FROM c GROUP BY ALL), g AS (SELECT rep, chunk, n, u, coalesce(x.g, 0) AS g, coalesce(x.o, 0) AS o FROM s LEFT JOIN x USING (rep, chunk))
 SELECT rep::INTEGER AS rep, chunk, (sum(n) OVER v)::DOUBLE AS mapped, (sum(u) OVER v)::DOUBLE AS mapped_unique, (sum(g) OVER v)::BIGINT AS genes, (sum(o) OVER v)::BIGINT AS known, (sum(g - o) OVER v)::BIGINT AS novel FROM g WINDOW v AS (PARTITION BY rep ORDER BY chunk)""")
def w5_rarefaction(spark, sf):
    w = F.when(F.col("event_id") % 3 == 0, 0.5).otherwise(1.0)
    reads = table(spark, sf, "events").select(F.col("event_id").alias("read"), F.col("user_id").alias("gene"), w.alias("w"), (F.col("event_id") % 7).alias("r"))
    known = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("gene"))
    return E.rarefaction(reads, F.col("read") * 48271 * F.col("rep") % 2147483647, 1000, 2, 2, 8.0, known, "w", "r")


def _mix(x):
    once = f"((({x}) % 2147483647 * 48271 + 11) % 2147483647)"
    return f"({once} * ({once} % 65537 + 1) % 2147483647)"


_Z = "(rep * 1000003 + r * 7919)"
_MIRROR = f"(({_mix(_Z)} * 2147483647 + {_mix(_Z + ' + 1')}) % t - x + t) % t"


@query(f"""WITH RECURSIVE a AS (SELECT event_id, user_id, count(*) OVER () AS t, row_number() OVER (ORDER BY event_id, user_id) - 1 AS x FROM events),
 p AS (SELECT event_id, user_id, t, x, rep, 1::BIGINT AS r FROM a, range(1, 3) q(rep) UNION ALL
  SELECT event_id, user_id, t, CASE WHEN {_mix(f"{_mix('greatest(x, y)')} + {_mix(_Z + ' + 2')}")} % 2 = 1 THEN y ELSE x END, rep, r + 1 FROM (SELECT *, {_MIRROR} AS y FROM p WHERE r <= 16)),
 c AS (SELECT rep, x // 1000 + 1 AS chunk, user_id AS gene, count(*) AS n FROM p WHERE r = 17 GROUP BY ALL),
 u AS (SELECT *, sum(n) OVER (PARTITION BY rep, gene ORDER BY chunk) AS upto FROM c WHERE gene IS NOT NULL),
 f AS (SELECT rep, chunk, count(*) AS g FROM (SELECT rep, gene, min(chunk) AS chunk FROM u WHERE upto >= 3 GROUP BY ALL) GROUP BY ALL),
 s AS (SELECT rep, chunk, sum(n) AS n FROM c GROUP BY ALL)
 SELECT rep::INTEGER AS rep, chunk, (sum(n) OVER v)::DOUBLE AS mapped, (sum(n) OVER v)::DOUBLE AS mapped_unique, (sum(coalesce(g, 0)) OVER v)::BIGINT AS genes, 0::BIGINT AS known, (sum(coalesce(g, 0)) OVER v)::BIGINT AS novel FROM s LEFT JOIN f USING (rep, chunk) WINDOW v AS (PARTITION BY rep ORDER BY chunk)""")
def w5_even_chunks(spark, sf):
    reads = table(spark, sf, "events").select(F.col("event_id").alias("read"), F.col("user_id").alias("gene"))
    return E.rarefaction(reads, None, 1000, 2, 3)


@query("""WITH g AS (SELECT l_linenumber, count(l_quantity) AS n, avg(l_quantity) AS m, stddev_samp(l_quantity) / sqrt(count(l_quantity)) AS se FROM lineitem GROUP BY l_linenumber)
 SELECT l_linenumber, n, round(m / (l_linenumber * 50) * 100, 6) AS percent, round((m - 1.96 * se) / (l_linenumber * 50) * 100, 6) AS percent_low, round((m + 1.96 * se) / (l_linenumber * 50) * 100, 6) AS percent_high FROM g""")
def w8_percent_of_chunk(spark, sf):
    got = E.replicate_stats(table(spark, sf, "lineitem"), "l_linenumber", "l_quantity", F.col("l_linenumber") * 50)
    return got.select("l_linenumber", "n", *[_r(c).alias(c) for c in ("percent", "percent_low", "percent_high")])


_CURVE = "SELECT l_suppkey AS g, CAST(month(l_shipdate) AS BIGINT) + 12 * (CAST(year(l_shipdate) AS BIGINT) - 1992) AS x, CAST(sum(l_quantity) AS DOUBLE) AS y FROM lineitem GROUP BY l_suppkey, CAST(month(l_shipdate) AS BIGINT) + 12 * (CAST(year(l_shipdate) AS BIGINT) - 1992)"


@query(f"SELECT g, x, round((y - lag(y) OVER w) / (x - lag(x) OVER w), 6) AS quotient FROM ({_CURVE}) WINDOW w AS (PARTITION BY g ORDER BY x)")
def w9_difference_quotients(spark, sf):
    return E.difference_quotients(run(spark, sf, _CURVE), "x", "y", "g").select("g", "x", _r("quotient").alias("quotient"))


@query(f"""WITH c AS (SELECT g, x, sum(y) OVER (PARTITION BY g ORDER BY x) AS y FROM ({_CURVE})),
 f AS (SELECT g, x, max(x) OVER a AS e, regr_slope(y, x) OVER a AS m, regr_intercept(y, x) OVER a AS b, regr_r2(y, x) OVER a AS r2, row_number() OVER (PARTITION BY g ORDER BY x) AS nr, count(*) OVER (PARTITION BY g) AS n FROM c WINDOW a AS (PARTITION BY g ORDER BY x ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING))
 SELECT g, x::DOUBLE AS start, e::DOUBLE AS "end", round(m, 5) AS slope FROM f WHERE nr <= n - 6 AND r2 > 0.9 QUALIFY row_number() OVER (PARTITION BY g ORDER BY m, x) = 1""")
def w9_steady_line(spark, sf):
    upto = run(spark, sf, f"SELECT g, x, sum(y) OVER (PARTITION BY g ORDER BY x) AS y FROM ({_CURVE})")
    return E.steady_line(upto, "x", "y", "g", 5, 0.9).select("g", "start", "end", _r("slope", 5).alias("slope"))


@query("SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(stddev_samp(value) / sqrt(count(value)), 6) AS se, round(avg(value) - 1.96 * stddev_samp(value) / sqrt(count(value)), 6) AS low, round(avg(value) + 1.96 * stddev_samp(value) / sqrt(count(value)), 6) AS high FROM events GROUP BY event_type")
def w8_replicate_stats(spark, sf):
    got = E.replicate_stats(table(spark, sf, "events"), "event_type", "value")
    return got.select("event_type", "n", *[_r(c).alias(c) for c in ("mean", "sd", "se", "low", "high")])


@query("SELECT l_returnflag, round(regr_slope(l_extendedprice, ln(l_quantity)), 4) AS slope, round(regr_r2(l_extendedprice, ln(l_quantity)), 6) AS r2, round(regr_intercept(l_extendedprice, ln(l_quantity)) + regr_slope(l_extendedprice, ln(l_quantity)) * ln(max(l_quantity) * 4 / 3), 4) AS predicted FROM lineitem WHERE l_quantity > 0 GROUP BY l_returnflag")
def w9_saturation_fit(spark, sf):
    got = E.saturation_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag")
    return got.select("l_returnflag", _r("slope", 4).alias("slope"), _r("r2").alias("r2"), _r("predicted", 4).alias("predicted"))


# --- graphs, k-mers, haplotypes, modules -------------------------------------------

# Parts met in orders.
_MET = "SELECT concat('f', CAST(l_partkey AS STRING)) AS feature, concat('o', CAST(l_orderkey AS STRING)) AS sample, l_quantity AS value FROM lineitem"
_SHARES = f"""WITH c AS (SELECT feature, sample, sum(value) AS value FROM ({_MET}) GROUP BY ALL), t AS (SELECT sample, sum(value) AS t FROM c GROUP BY sample), n AS (SELECT count(*) AS n FROM t), v AS (SELECT feature, sample, (value / t)::DOUBLE AS v FROM c JOIN t USING (sample))"""
_RANKED = ", x AS (SELECT feature, sample, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 + (n - count(*) OVER f) - CASE WHEN n > count(*) OVER f THEN (n - count(*) OVER f + 1) / 2.0 ELSE 0 END AS v FROM v, n WINDOW f AS (PARTITION BY feature))"
_PAIRED = ", s AS (SELECT feature, sum(v) AS s, sum(v * v) AS q FROM x GROUP BY feature), p AS (SELECT l.feature AS a, r.feature AS b, sum(l.v * r.v) AS p, sum(least(l.v, r.v)) AS low FROM x l JOIN x r ON l.sample = r.sample AND l.feature < r.feature GROUP BY ALL), j AS (SELECT l.feature AS a, r.feature AS b, coalesce(p, 0) AS p, coalesce(low, 0) AS low, l.s AS sa, l.q AS qa, r.s AS sb, r.q AS qb, n FROM s l JOIN s r ON l.feature < r.feature LEFT JOIN p ON p.a = l.feature AND p.b = r.feature, n)"
_ENDS = " (SELECT a, b, round(s, 6) AS score, 'top' AS side FROM k ORDER BY round(s, 9) DESC, a, b LIMIT 10) UNION ALL (SELECT a, b, round(s, 6), 'bottom' FROM k ORDER BY round(s, 9), a, b LIMIT 10)"
_CORR = ", k AS (SELECT a, b, (n * p - sa * sb) / sqrt((n * qa - sa * sa) * (n * qb - sb * sb)) AS s FROM j WHERE (n * qa - sa * sa) * (n * qb - sb * sb) > 0)"


@query(f"{_SHARES}, x AS (SELECT * FROM v){_PAIRED}{_CORR}{_ENDS}")
def a32_cooccurrence(spark, sf):
    return G.cooccurrence(run(spark, sf, _MET), 10).withColumn("score", _r("score"))


@query(f"{_SHARES}{_RANKED}{_PAIRED}{_CORR}{_ENDS}")
def a32_cooccurrence_of_ranks(spark, sf):
    return G.cooccurrence(run(spark, sf, _MET), 10, "spearman").withColumn("score", _r("score"))


@query(f"{_SHARES}, x AS (SELECT * FROM v){_PAIRED}, k AS (SELECT a, b, 2 * low / (sa + sb) AS s FROM j){_ENDS}")
def a32_cooccurrence_bray(spark, sf):
    return G.cooccurrence(run(spark, sf, _MET), 10, "bray").withColumn("score", _r("score"))


_EDGES = "SELECT concat('n', CAST(l_suppkey AS STRING)) AS src, concat('n', CAST(l_partkey AS STRING)) AS dst, l_quantity AS weight FROM lineitem"


@query(f"""WITH e AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, max(weight) AS weight FROM ({_EDGES}) WHERE src <> dst GROUP BY ALL), b AS (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e), d AS (SELECT src AS n, count(*) AS d FROM b GROUP BY src),
 c AS (SELECT e.src, e.dst, count(*) AS c FROM e JOIN b p ON p.src = e.src JOIN b q ON q.src = e.dst AND q.dst = p.dst GROUP BY ALL)
 SELECT e.src, e.dst, e.weight, x.d AS src_degree, y.d AS dst_degree, coalesce(c, 0) AS common, round(2 * coalesce(c, 0) / (x.d + y.d), 6) AS dice FROM e JOIN d x ON x.n = e.src JOIN d y ON y.n = e.dst LEFT JOIN c USING (src, dst)""")
def a33_edge_stats(spark, sf):
    return G.edge_stats(run(spark, sf, _EDGES)).withColumn("dice", _r("dice"))


@query("""WITH e AS (SELECT DISTINCT 'ath-miR-' || l_suppkey AS a, 'g' || l_partkey AS b FROM lineitem), n AS (SELECT a AS node, b AS o FROM e UNION ALL SELECT b, a FROM e)
 SELECT node, count(*) AS degree, CASE WHEN node LIKE 'ath%' THEN 'miRNA' ELSE 'mRNA' END AS kind, CASE WHEN node IN (SELECT 'g' || p_partkey FROM part WHERE p_size > 25) THEN 'Y' ELSE 'N' END AS status FROM n GROUP BY node""")
def a33_node_stats(spark, sf):
    edges = table(spark, sf, "lineitem").select(F.concat(F.lit("ath-miR-"), "l_suppkey").alias("src"), F.concat(F.lit("g"), "l_partkey").alias("dst"), F.lit(1.0).alias("weight"))
    valid = table(spark, sf, "part").where("p_size > 25").select(F.concat(F.lit("g"), "p_partkey").alias("node"))
    return G.node_stats(edges, {"miRNA": "^[a-z]{3}-(let|bantam|miR)"}, "mRNA", valid)


@query(f"SELECT substr(seq, i, 5) AS kmer, count(*) AS n FROM ({B.READS}), range(1, 29) t(i) GROUP BY ALL")
def a26_kmer_counts(spark, sf):
    return K.kmer_counts(run(spark, sf, B.READS), 5)


@query(f"""WITH r AS ({B.READS}), k AS (SELECT read_id, substr(seq, i, 4) AS k FROM r, range(1, 30) t(i)), c AS (SELECT k, count(*) AS n FROM k GROUP BY k) SELECT read_id FROM r WHERE read_id NOT IN (SELECT read_id FROM k JOIN c USING (k) WHERE n < 20)""")
def a26_filter_kmer_abundance(spark, sf):
    return K.filter_kmer_abundance(run(spark, sf, B.READS), 4, 20).select("read_id")


@query(f"""WITH r AS ({B.READS}), k AS (SELECT read_id, i, substr(seq, i, 6) AS k FROM r, range(1, 28) t(i)), c AS (SELECT k, count(*) AS n FROM k GROUP BY k),
 f AS (SELECT read_id, min(i) FILTER (n < 3) AS bad FROM k JOIN c USING (k) GROUP BY read_id)
 SELECT read_id, substr(seq, 1, coalesce(bad + 4, 32)) AS seq, substr(qual, 1, coalesce(bad + 4, 32)) AS qual FROM r JOIN f USING (read_id) WHERE bad IS NULL OR bad > 1""")
def a26_trim_rare_bases(spark, sf):
    return K.trim_rare_bases(run(spark, sf, B.READS), 6, 3, qual="qual").select("read_id", "seq", "qual")


@query("""WITH q AS (SELECT DISTINCT substr(text, i, 5) AS k FROM (SELECT text, unnest(range(1, length(text) - 3)) AS i FROM benchmark)),
 e AS (SELECT doc_id, substr(text, i, 5) AS k FROM (SELECT doc_id, text, unnest(range(1, length(text) - 3)) AS i FROM documents WHERE length(text) >= 5))
 SELECT doc_id AS id FROM e LEFT JOIN q USING (k) GROUP BY doc_id HAVING 2 * count(q.k) >= count(*)""")
def j23_sweep_reads(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("read_id"), F.col("text").alias("seq"))
    return K.sweep_reads(docs, table(spark, sf, "benchmark"), 5, query_seq="text").select(F.col("read_id").alias("id"))


@query(f"""WITH p AS (SELECT read_id, seq FROM ({B.READS})), m AS (SELECT read_id, substr(seq, 11, 6) AS m FROM p),
 j AS (SELECT m.read_id AS mature, p.read_id AS precursor, m, string_split(seq, m) AS parts FROM m JOIN p ON contains(seq, m))
 SELECT mature, precursor, (list_sum([length(x) FOR x IN parts[1:i]]) + (i - 1) * 6 + 1)::BIGINT AS position FROM j, range(1, 12) t(i) WHERE i < len(parts)""")
def j19_find_in(spark, sf):
    reads = run(spark, sf, B.READS).select(F.col("read_id").alias("id"), "seq")
    mature = reads.select("id", F.substring("seq", 11, 6).alias("seq"))
    return K.find_in(mature, reads, 5)


_GENO = """SELECT vec_id AS subject, concat('pop', CAST(label AS STRING)) AS pop, m AS marker, CASE WHEN element_at(embedding, m) > 0 THEN 'A' ELSE 'T' END AS a1, CASE WHEN element_at(embedding, m + 8) > 0.1 THEN 'T' ELSE CASE WHEN element_at(embedding, m) > 0 THEN 'A' ELSE 'T' END END AS a2 FROM embeddings"""


def _geno(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("m", F.explode(F.sequence(F.lit(1), F.lit(4))))
    a1 = F.when(F.element_at("embedding", F.col("m")) > 0, "A").otherwise("T")
    return e.select(F.col("vec_id").alias("subject"), F.concat(F.lit("pop"), F.col("label").cast("string")).alias("pop"), F.col("m").alias("marker"), a1.alias("a1"), F.when(F.element_at("embedding", F.col("m") + 8) > 0.1, "T").otherwise(a1).alias("a2"))


@query("""WITH g AS (SELECT vec_id AS s, 'pop' || label AS pop, m, CASE WHEN embedding[m] > 0 THEN 'A' ELSE 'T' END AS a1, CASE WHEN embedding[m + 8] > 0.1 THEN 'T' WHEN embedding[m] > 0 THEN 'A' ELSE 'T' END AS a2 FROM embeddings, range(1, 5) t(m)),
 r AS (SELECT s, pop, count(*) FILTER (a1 <> a2) AS het, string_agg(a1, '' ORDER BY m) AS h1, string_agg(a2, '' ORDER BY m) AS h2 FROM g GROUP BY ALL),
 u AS (SELECT pop, unnest([h1, h2]) AS h FROM r WHERE het <= 1), w AS (SELECT pop, h, count(*)::DOUBLE AS w FROM u GROUP BY ALL), k AS (SELECT h, sum(w) AS f FROM w GROUP BY h),
 o AS (SELECT s, pop, h1, h2, h, f FROM r JOIN k ON len([i FOR i IN range(1, 5) IF substr(h, i, 1) <> substr(h1, i, 1) AND substr(h, i, 1) <> substr(h2, i, 1)]) = 0 WHERE het > 1 QUALIFY row_number() OVER (PARTITION BY s, pop ORDER BY f DESC, h) = 1),
 x AS (SELECT pop, unnest([h, array_to_string([CASE WHEN substr(h, i, 1) = substr(h1, i, 1) THEN substr(h2, i, 1) ELSE substr(h1, i, 1) END FOR i IN range(1, 5)], '')]) AS h FROM o),
 z AS (SELECT pop, h, sum(w) AS w FROM (SELECT * FROM w UNION ALL SELECT pop, h, count(*)::DOUBLE FROM x GROUP BY ALL) GROUP BY ALL)
 SELECT pop, h AS haplotype, w AS weight, round(100 * w / sum(w) OVER (PARTITION BY pop), 6) AS percent FROM z""")
def a24_haplotype_freq(spark, sf):
    return HP.haplotype_freq(_geno(spark, sf)).withColumn("percent", _r("percent"))


@query("""WITH g AS (SELECT vec_id AS s, 'pop' || label AS pop, m, CASE WHEN vec_id % 9 = 0 AND m = 2 THEN 'N' WHEN embedding[m] > 0 THEN 'A' ELSE 'T' END AS a FROM embeddings, range(1, 5) t(m)),
 h AS (SELECT s, pop, string_agg(a, '' ORDER BY m) AS h FROM g GROUP BY ALL), w AS (SELECT pop, h, 2.0 * count(*) AS w FROM h GROUP BY ALL), c AS (SELECT * FROM w WHERE NOT contains(h, 'N')),
 e AS (SELECT pop, h AS f, replace(h, 'N', b) AS h, w FROM w, (SELECT unnest(['A', 'C', 'G', 'T']) AS b) WHERE contains(h, 'N')), q AS (SELECT e.*, 1 + coalesce(c.w, 0) AS k FROM e LEFT JOIN c ON c.pop = e.pop AND c.h = e.h),
 d AS (SELECT pop, h, w * k / sum(k) OVER (PARTITION BY pop, f) AS w FROM q), z AS (SELECT pop, h, sum(w) AS w FROM (SELECT * FROM c UNION ALL SELECT * FROM d) GROUP BY ALL), l AS (SELECT *, 'one' AS lv_one, 'two' || right(pop, 1)::INT % 2 AS lv_two FROM z)
 SELECT lv_one, lv_two, pop, h AS haplotype, round(sum(w), 6) AS weight FROM l GROUP BY GROUPING SETS ((lv_one, lv_two, pop, h), (lv_one, lv_two, h), (lv_one, h))""")
def a24_report_levels(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("m", F.explode(F.sequence(F.lit(1), F.lit(4))))
    base = F.when((F.col("vec_id") % 9 == 0) & (F.col("m") == 2), "N").when(F.element_at("embedding", F.col("m")) > 0, "A").otherwise("T")
    pop = F.concat(F.lit("pop"), F.col("label").cast("string"))
    freq = HP.haplotype_freq(e.select(F.col("vec_id").alias("subject"), pop.alias("pop"), F.col("m").alias("marker"), base.alias("a1"), base.alias("a2")))
    pops = table(spark, sf, "embeddings").select(pop.alias("pop"), F.lit("one").alias("lv_one"), F.concat(F.lit("two"), (F.right(F.col("label").cast("string"), F.lit(1)).cast("int") % 2).cast("string")).alias("lv_two")).distinct()
    return HP.report_levels(freq, pops).withColumn("weight", _r("weight"))


@query("""WITH s AS (SELECT o_custkey, list(DISTINCT b) AS ids FROM (SELECT o_custkey, 'K' || l_linenumber AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey) GROUP BY o_custkey)
 SELECT o_custkey::STRING AS key, 'M1' AS module, ((list_contains(ids, 'K1') OR list_contains(ids, 'K2'))::INT + (list_contains(ids, 'K6') AND list_contains(ids, 'K7'))::INT + list_contains(ids, 'K5')::INT)::BIGINT AS found, 3::BIGINT AS needed FROM s
 UNION ALL SELECT o_custkey::STRING, 'M2', (list_contains(ids, 'K3') AND (list_contains(ids, 'K4') OR list_contains(ids, 'K7')))::BIGINT, 1 FROM s""")
def x16_module_steps(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    sets = o.join(li, o["o_orderkey"] == li["l_orderkey"]).groupBy(F.col("o_custkey").alias("key")).agg(F.collect_set(F.concat(F.lit("K"), F.col("l_linenumber").cast("string"))).alias("ids"))
    return M.module_steps(sets, [("M1", "(K1,K2) K6+K7 K5"), ("M2", "(K3 (K4,K7))")])


@query("SELECT l_returnflag AS \"group\", split_part(n_name, '_', 1) AS genus, count(*) AS n FROM lineitem JOIN nation ON l_suppkey % 25 = n_nationkey GROUP BY ALL".replace("split_part(n_name, '_', 1)", "split_part(n_name, ' ', 1)"))
def a13_genus_counts(spark, sf):
    genes = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("group"), (F.col("l_suppkey") % 25).cast("int").alias("code"))
    return M.genus_counts(genes, table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")))


@query("SELECT p_brand AS category, string_agg(DISTINCT p_partkey::STRING, ';' ORDER BY p_partkey::STRING) AS ids FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY') GROUP BY p_brand")
def a16_pathway_sets(spark, sf):
    entries = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("category"), F.col("p_type").alias("class"))
    return M.pathway_sets(entries, "ECONOMY")
