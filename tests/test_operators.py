"""Operators on small fixtures: kernels against plain loops, properties, examples with known results, edge cases."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from omicspark.functions import sequences as X, text as XT
from omicspark.operators import expression as E, features as FT, haplotypes as HP, intervals as I, modules as M, ranks as R, reads as RD, tables as TB, taxa as TX
from omicspark.operators.components import connected_components
from omicspark.sources import readers, writers


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 40))
def test_bwa_cut(quals, q):
    best, at, total = 0, len(quals), 0
    for i in range(len(quals) - 1, -1, -1):
        total += q - quals[i]
        if total < 0:
            break
        if total > best:
            best, at = total, i
    assert RD._bwa_cut(np.array(quals, dtype=np.int64), q) == at


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 40))
def test_window_cut(quals, q):
    n = len(quals)
    w = max(1, n // 10)
    start = next((i for i in range(n - w + 1) if sum(quals[i : i + w]) / w < q), n - w + 1) if n else 0
    want = next((i for i in range(max(start, 0), n) if quals[i] < q), n)
    assert RD._window_cut(np.array(quals, dtype=np.int64), q) == want


@settings(max_examples=100, deadline=None)
@given(st.floats(0.01, 1e6))
def test_lgamma(x):
    assert math.isclose(float(E.lgamma(np.array([x]))[0]), math.lgamma(x), rel_tol=1e-10, abs_tol=1e-9)


def test_components_of_a_chain_a_star_and_noise(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    df = spark.createDataFrame([*chain, *star, (5, 5), (None, 3), (7, 6), (7, 6)], "src long, dst long")
    got = dict(map(tuple, connected_components(df).collect()))
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(200)) and len(got) == 261
    assert connected_components(df.limit(0)).count() == 0


def test_components_against_plain_search(spark):
    rng = np.random.default_rng(0)
    edges = rng.integers(0, 300, (200, 2)).tolist()
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert {k: v for k, v in got.items()} == {k: v for k, v in label.items() if k in got} and len(got) == len({x for a, b in edges if a != b for x in (a, b)})


def test_overlap_join_is_brute_force(spark):
    rng = np.random.default_rng(1)
    make = lambda n, tag: [(str(rng.choice(["c1", "c2"])), int(s), int(s + rng.integers(0, 80)), str(rng.choice(["+", "-"])), f"{tag}{i}") for i, s in enumerate(rng.integers(0, 500, n))]
    a, b = make(80, "a") + [("c1", 10, 20, "+", "touch")], make(80, "b") + [("c1", 20, 30, "+", "next"), ("c1", 0, 10_000, "+", "long")]
    schema = "chrom string, start long, end long, strand string, name string"
    da, db = spark.createDataFrame(a + [(None, 1, 2, "+", "nochrom"), ("c1", None, 5, "+", "nostart")], schema), spark.createDataFrame(b, schema)
    want = sorted((x[4], y[4], min(x[2], y[2]) - max(x[1], y[1])) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and x[1] < x[2] and y[1] < y[2])
    for size in (7, 64, 1 << 14):
        got = I.overlap_join(da, db, bin_size=size).select("a_name", "b_name", "overlap").collect()
        assert sorted(map(tuple, got)) == want
    alone = {r["name"] for r in I.overlap_join(da, db, mode="v").collect()}
    assert alone == {x[4] for x in a} - {w[0] for w in want} | {"nochrom", "nostart"}
    assert I.overlap_join(da, db, mode="wao").count() == len(want) + len(alone)


def test_bh_by_hand_and_ties(spark):
    p = [0.01, 0.02, 0.02, 0.5, 1.0, None]
    got = {r.i: r.q_value for r in R.bh_adjust(spark.createDataFrame([(i, "g", x) for i, x in enumerate(p)], "i int, g string, p double"), "p", ["g"]).collect()}
    assert [None if v is None else round(v, 9) for v in (got[i] for i in range(6))] == [round(2 * 0.05 / 3, 9)] * 3 + [0.625, 1.0, None]
    one = R.bh_adjust(spark.createDataFrame([("g", 1.0), (None, 0.2)], "g string, p double"), "p", ["g"]).collect()
    assert {(r.g, r.q_value) for r in one} == {("g", 1.0), (None, 0.2)}


def test_sample_distances_of_the_worked_example(spark):
    values = {"x": (10, 0, 0), "y": (10, 5, 5), "z": (10, 10, 0)}
    df = spark.createDataFrame([(f"f{i}", s, float(v)) for s, vs in values.items() for i, v in enumerate(vs)], "feature string, sample string, value double")
    got = {(r.a, r.b): r.distance for r in E.euclidean_distance(df, ["x", "y", "z"]).collect()}
    assert round(got["x", "y"], 6) == 7.071068 and got["x", "z"] == 10
    js = {(r.a, r.b): r.distance for r in E.js_distance(df, ["x", "y", "z"]).collect()}
    assert round(js["x", "y"], 6) == round(js["x", "z"], 6)


def test_lca_with_and_without_stripping(spark):
    nodes = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 2), (5, 3)], "taxid long, parent long")
    closure = TX.taxon_paths(nodes)
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", 5), ("c", 2), ("c", 3), ("c", 5), ("d", 2), ("d", 3), ("d", 4), ("e", 5), ("e", 5), ("f", None)], "k string, t long")
    assert {r.k: r.lca for r in TX.lca(df, closure, "k", "t").collect()} == {"a": 2, "b": 5, "c": 2, "d": 2, "e": 5}
    assert {r.k: r.lca for r in TX.lca(df, closure, "k", "t", strip=True).collect()} == {"a": 2, "b": 5, "c": 5, "d": 2, "e": 5}


def test_unknown_bases_and_haplotypes(spark):
    df = spark.createDataFrame([(1, "NNNNN"), (2, "ANC"), (3, "ACG")], "i int, haplotype string")
    got = HP.expand_unknown(df).groupBy("i").agg(F.count("*").alias("n"), F.count_distinct("haplotype").alias("d")).collect()
    assert {(r.i, r.n, r.d) for r in got} == {(1, 1024, 1024), (2, 4, 4), (3, 1, 1)}


def test_modules():
    assert M.holds("(K1,K2) K3", {"K2", "K3"}) and not M.holds("(K1,K2) K3", {"K1", "K2"})
    assert M.holds("K1+K2-K9", {"K1", "K9"}) and M.holds("((K1 K2),K3)", {"K3"})


def test_merge_unmerge_round_trip(spark):
    r1 = spark.createDataFrame([("a/1", "ACGT", "IIII"), ("b/1", "AC", "#I"), ("c/1", "A", "I")], "read_id string, seq string, qual string")
    r2 = spark.createDataFrame([("b/2", "GG", "II"), ("a/2", "TTTT", "####")], "read_id string, seq string, qual string")
    one, two = RD.unmerge_pairs(RD.merge_pairs(r1, r2))
    assert sorted(map(tuple, one.collect())) == [("a/1", "ACGT", "IIII"), ("b/1", "AC", "#I")] and sorted(map(tuple, two.collect())) == [("a/2", "TTTT", "####"), ("b/2", "GG", "II")]
    routed = RD.repair_pairs(spark.createDataFrame([("a",), ("c",), ("z",)], "id string"), r1.select(X.strip_mate("read_id").alias("id")), r2.select(X.strip_mate("read_id").alias("id")))
    assert {r.id: r.route for r in routed.collect()} == {"a": "paired", "c": "single1", "z": "none"}


def test_dedup_of_unequal_mates(spark):
    df = spark.createDataFrame([("a", "ACG", "T", "#I#", "I"), ("b", "ACG", "T", "I#I", "#"), ("c", "A", "T", "5", "5")], "id string, seq1 string, seq2 string, qual1 string, qual2 string")
    got = {r.id: (r.n, r.qual1, r.qual2) for r in RD.dedup_pairs(df).collect()}
    assert got == {"a": (2, "III", "I"), "c": (1, "5", "5")}


def test_text_functions(spark):
    row = spark.sql("SELECT 'ID=a;Parent=b;ID=c' AS g, 'gene_id \"x\"; tag \"y z\";' AS t, 'a(b(c)d)e(f)' AS p, 'a;b;;' AS l, '' AS e, CAST(NULL AS STRING) AS n")
    got = row.select(XT.attributes("g").alias("g"), XT.attributes("t", "gtf").alias("t"), XT.strip_parens("p").alias("p"), XT.split_list("l", ";").alias("l"), XT.split_list("e", ";").alias("e"), XT.split_list("n", ";").alias("n"), X.revcomp("n").alias("r"), XT.set_attribute("e", "ID", F.lit("q")).alias("s")).first()
    assert got.g == {"ID": "c", "Parent": "b"} and got.t == {"gene_id": "x", "tag": "y z"} and got.p == "ae" and got.l == ["a", "b"] and got.e == [] and got.n is None and got.r is None and got.s == "ID=q"


def test_sequences_over_tiles(spark):
    genome = spark.createDataFrame([("c", "ACGTTGCAAC" * 10)], "chrom string, seq string")
    parts = spark.createDataFrame([("x", "c", 5, 25, "+"), ("x", "c", 30, 33, "+"), ("y", "c", 0, 4, "-")], "id string, chrom string, start long, end long, strand string")
    whole = "ACGTTGCAAC" * 10
    for tile in (3, 8, 1000):
        assert {r.id: r.seq for r in FT.extract_sequences(parts, genome, tile).collect()} == {"x": whole[5:25] + whole[30:33], "y": "ACGT"}


def test_empty_and_null_tables(spark):
    reads = spark.createDataFrame([], "read_id string, seq string, qual string")
    assert RD.trim_window(reads, 20, 5).count() == RD.trim_bwa(reads, 20).count() == RD.qc_reads(reads).count() == 0
    nulls = spark.createDataFrame([("a", None, None)], "read_id string, seq string, qual string")
    assert RD.trim_window(nulls, 20, 5).first().seq is None
    lineage = spark.createDataFrame([(None, 1.0), ("", 2.0), ("a; b", 3.0)], "l string, s double")
    assert {(r.lineage, r.s) for r in TB.rollup_lineage(lineage, "l", ["s"]).collect()} == {("Unclassified", 3.0), ("a", 3.0), ("a; b", 3.0)}
    scaled = {r.lineage: r.s for r in TB.rollup_lineage(lineage, "l", ["s"], scale=100, rank=1).collect()}
    assert scaled == {"Unclassified": 50.0, "a": 50.0}


# --- files -------------------------------------------------------------------


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("s1", "first one", "ACGT" * 5), ("s2", "", "GG")], "seq_id string, descr string, seq string")
    writers.write_fasta(df.coalesce(1), str(tmp_path / "fa"), width=7)
    assert sorted(map(tuple, readers.read_fasta(spark, str(tmp_path / "fa")).collect())) == sorted(map(tuple, df.collect()))


def test_fastq_in_parts(spark, tmp_path):
    rows = [(f"r{i}", "x y" if i % 2 else "", "ACGT"[: i % 4 + 1] * 3, "@+I#"[: i % 4 + 1] * 3) for i in range(200)]
    df = spark.createDataFrame(rows, "read_id string, descr string, seq string, qual string")
    writers.write_fastq(df.coalesce(1), str(tmp_path / "fq"))
    for size in (64, 1000, 1 << 20):
        got = readers.read_fastq(spark, str(tmp_path / "fq"), size).collect()
        assert sorted(map(tuple, got)) == sorted(rows)


def test_gff_bed_sam(spark, tmp_path):
    f = spark.createDataFrame([("c1", "src", "gene", 9, 20, None, "+", None, "ID=a;Note=b")], "seqid string, source string, type string, start long, end long, score string, strand string, phase string, attributes string")
    writers.write_gff(f, str(tmp_path / "gff"))
    r = readers.read_gff(spark, str(tmp_path / "gff")).first()
    assert (r.start, r.end, r.attrs) == (9, 20, {"ID": "a", "Note": "b"})
    bed = spark.createDataFrame([("c1", 1, 5, "n", 1.0, "-")], "chrom string, start long, end long, name string, score double, strand string")
    writers.write_bed(bed, str(tmp_path / "bed"))
    assert tuple(readers.read_bed(spark, str(tmp_path / "bed")).first()) == ("c1", 1, 5, "n", 1.0, "-")
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nq1\t16\tc1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\tMD:Z:4\n")
    aln = readers.read_sam(spark, str(tmp_path / "a.sam"))
    assert aln.first().tags == {"NM": "0", "MD": "4"} and aln.first().flag == 16
    writers.write_sam(aln, str(tmp_path / "sam"))
    assert readers.read_sam(spark, str(tmp_path / "sam")).first() == aln.first()


def test_other_readers(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    assert sorted(map(tuple, readers.read_clstr(spark, put("c", ">Cluster 0\n0\t10aa, >a.1... *\n1\t9aa, >b... at 90%\n>Cluster 1\n0\t5aa, >c... *\n")).collect())) == [("Cluster 0", "a"), ("Cluster 0", "b"), ("Cluster 1", "c")]
    hits = readers.read_hits(spark, put("h", "***RBH*** Query= a Hit= b Score= 10.5 Evalue= 1e-5\nQuery= c Hit= d Score= 3 Evalue= 1\n"), "labelled").collect()
    assert {tuple(h) for h in hits} == {("a", "b", 10.5, 1e-5, True), ("c", "d", 3.0, 1.0, False)}
    assert {tuple(r) for r in readers.read_classified(spark, put("k", "C\tr1\tHomo (taxid 9606)\nU\tr2\t0\nC\tr3\t7\n")).collect()} == {("r1", 9606), ("r3", 7)}
    assert {tuple(r) for r in readers.read_taxdump(spark, put("m", "12\t|\t74109\t|\n30\t|\t29\t|\n"), ["old", "new"]).collect()} == {("12", "74109"), ("30", "29")}
    rec = readers.read_flat_records(spark, put("f", "ENTRY       K1   KO\nNAME        x, y\nPATHWAY     p1\n            p2\n///\nENTRY       K2   KO\n///\n")).collect()
    assert {r.entry for r in rec} == {"K1", "K2"} and next(r for r in rec if r.entry == "K1").sections["PATHWAY"] == ["p1", "p2"]
    assert {tuple(r) for r in readers.read_folds(spark, put("g", ">a x\nACGU\n(..) (-1.0)\n>b\nAA\n..\n")).collect()} == {("a", "ACGU", "(..)"), ("b", "AA", "..")}
    assert readers.read_quoted_csv(spark, put("q", 'a,b\n"x, y","two\nlines ""q"""\n')).first().b == 'two\nlines "q"'
    skipped = readers.read_table(spark, put("t", "# one\n# two\nid\tv\na\t1\nb\t2\n"), skip=2)
    assert skipped.columns == ["id", "v"] and skipped.count() == 2
    (tmp_path / "d").mkdir()
    put("d/A_vs_B.tsv", "x\t1\n")
    assert tuple(readers.read_dir(spark, str(tmp_path / "d"), r"(\w)_vs_(\w)", ["q", "s"]).first()) == ("x", "1", "A", "B")
    assert readers.read_duplexes(spark, put("u", "t:10:m:5:-20.5:0.01:3:a:b:c:d\n")).first().energy == -20.5
    assert readers.read_refgene(spark, put("r", "\t".join(["1", "n", "c", "+", "0", "9", "1", "8", "1", "0,", "9,", "i", "g", "x", "y", "0,"]) + "\n")).first().name2 == "g"
    assert readers.read_domains(spark, put("p", "\t".join(["a", "m", "9", "Pfam", "PF1", "d", "1", "5", "0.1", "T", "date", "IPR1", "e", "GO:1|GO:2", "KEGG: 1"]) + "\n")).first().gos == "GO:1|GO:2"


def test_sets_split_and_xml(spark, tmp_path):
    df = spark.createDataFrame([("s", "b"), ("s", "a"), ("t", "c")], "term string, gene string")
    writers.write_gmt(df, str(tmp_path / "gmt"), "term", "gene")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "gmt")).collect()) == ["s\ta;b", "t\tc"]
    writers.write_split(df, str(tmp_path / "split"), "term")
    assert sorted(p.name for p in (tmp_path / "split").iterdir() if p.is_dir()) == ["term=s", "term=t"]
    writers.write_table(df, str(tmp_path / "tsv"), ["A", "B"])
    assert spark.read.csv(str(tmp_path / "tsv"), sep="\t", header=True).columns == ["A", "B"]
    hits = spark.createDataFrame([("q", "h1", 5.0, 1, 9), ("q", "h2", 9.0, 2, 8), ("q", "h1", 7.0, 20, 30)], "query string, hit string, bits double, start int, end int")
    nested = writers.nested_hits(hits).first()
    assert [(h.id, h.bits, len(h.alignment)) for h in nested.hit] == [("h2", 9.0, 1), ("h1", 7.0, 2)]
    writers.write_hits_xml(hits, str(tmp_path / "xml"))
    assert spark.read.format("xml").option("rowTag", "query").load(str(tmp_path / "xml")).count() == 1


@pytest.mark.parametrize("n,k", [(1, 2), (100, 5)])
def test_max_mismatches(spark, n, k):
    p = lambda x, m: 1 - sum(math.exp(-m) * m**i / math.factorial(i) for i in range(x + 1))
    want = max(2, next(x for x in range(1, 100) if p(x, n * 0.02) < 0.04))
    assert spark.range(1).select(X.max_mismatches(F.lit(n)).alias("k")).first().k == want
