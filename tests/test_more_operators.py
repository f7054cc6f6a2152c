"""Operators against plain versions: row numbers under shuffles, ranges, blocks, hierarchies, alignments, rarefaction."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.sources import readers as IN, writers as OUT
from omicspark.operators import expression as E, features as FT, graphs as G, grams as GR, haplotypes as HP, hits as H, intervals as I, kmers as K, pairs as P, ranks as R, reads as RD, tables as TB, taxa as TX


def stored(df, path):
    """The table written, and read shuffled: every evaluation may number rows otherwise."""
    df.repartition(5).write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path)).repartition(3)


def test_overlap_modes_of_shuffled_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    make = lambda n, tag: [("c", int(s), int(s) + 3, "+", f"{tag}{i}", "x" * (i % 50)) for i, s in enumerate(rng.integers(0, 900, n))]
    schema = "chrom string, start long, end long, strand string, name string, other string"
    a, b = make(200, "a"), make(120, "b")
    da, db = stored(spark.createDataFrame(a, schema), tmp_path / "a"), stored(spark.createDataFrame(b, schema), tmp_path / "b")
    pairs = [(x[4], y[4]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
    alone = sorted({x[4] for x in a} - {p[0] for p in pairs})
    assert sorted(r["name"] for r in I.overlap_join(da, db, mode="v").select("name").collect()) == alone and len(alone) > 20
    got = I.overlap_join(da, db, mode="wao").select("a_name", "b_name").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([*pairs, *((x, None) for x in alone)], key=repr)
    with pytest.raises(ValueError):
        I.overlap_join(da, db, mode="x")


def test_linked_loci(spark):
    """Against a plain search: only overlaps between the two sets on one strand link."""
    rng = np.random.default_rng(12)
    make = lambda n, tag: [(str(rng.choice(["c1", "c2"])), int(s), int(s + rng.integers(1, 40)), str(rng.choice(["+", "-"])), f"{tag}{i:02}") for i, s in enumerate(rng.integers(0, 900, n))]
    schema = "chrom string, start long, end long, strand string, name string"
    a, b = make(60, "a"), make(60, "b")
    group = {x[4]: x[4] for x in a + b}
    changed = True
    while changed:
        changed = False
        for x in a:
            for y in b:
                if x[0] == y[0] and x[3] == y[3] and x[1] < y[2] and y[1] < x[2] and group[x[4]] != group[y[4]]:
                    group[x[4]] = group[y[4]] = min(group[x[4]], group[y[4]])
                    changed = True
    want = {}
    for x in a + b:
        want.setdefault(group[x[4]], []).append(x)
    got = {r.locus: (r.chrom, r.strand, r.start, r.end, r.members) for r in I.link_loci(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}
    assert got == {k: (v[0][0], v[0][3], min(x[1] for x in v), max(x[2] for x in v), "/".join(sorted(x[4] for x in v))) for k, v in want.items()}
    assert len(got) < 110


def brute_loci(a, b):
    """(members, chrom, strand, start, end) of what overlaps between two sets connect."""
    up = {x[4]: x[4] for x in a + b}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in a:
        for y in b:
            if x[0] == y[0] and x[3] == y[3] and x[1] < y[2] and y[1] < x[2]:
                p, q = root(x[4]), root(y[4])
                up[max(p, q)] = min(p, q)
    groups = {}
    for x in a + b:
        groups.setdefault(root(x[4]), []).append(x)
    return sorted((k, min(x[0] for x in v), min(x[3] for x in v), min(x[1] for x in v), max(x[2] for x in v), "/".join(sorted({x[4] for x in v}))) for k, v in groups.items())


@pytest.mark.parametrize(("parts", "longest", "strands"), [(1, 30, 2), (7, 60, 1), (12, 900, 1), (12, 5, 3)])
def test_loci_over_many_ranges(spark, parts, longest, strands):
    """Open features are carried over borders, however many ranges they span."""
    rng = np.random.default_rng(parts * longest)
    make = lambda n, tag: [(f"c{rng.integers(0, 2)}", int(s), int(s + rng.integers(1, longest if rng.random() < 0.9 else 4000)), f"{rng.integers(0, strands)}", f"{tag}{i:03}") for i, s in enumerate(rng.integers(0, 6000, n))]
    a, b = make(170, "a"), make(40, "b")
    b += [a[3][:4] + ("a003",)]  # an id of both sets
    schema = "chrom string, start long, end long, strand string, name string"
    was = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = I.link_loci(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).select("locus", "chrom", "strand", "start", "end", "members").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was[1])
    assert sorted(map(tuple, got)) == brute_loci(a, b)


def test_loci_of_odd_rows(spark):
    schema = "chrom string, start long, end long, strand string, name string"
    a = spark.createDataFrame([("c", 1, 5, "+", "x"), ("c", 5, 5, "+", "empty"), (None, 1, 5, "+", "nochrom"), ("c", 1, 5, None, "nostrand"), ("c", None, 5, "+", "nostart")], schema)
    got = I.link_loci(a, a.limit(0))
    assert sorted(r.members for r in got.collect()) == ["empty", "nochrom", "nostart", "nostrand", "x"]
    assert I.link_loci(a.limit(0), a.limit(0)).count() == 0


def test_an_interval_of_any_length_is_a_few_rows(spark):
    """10^11 bases meet what they cover, at the level of their length."""
    schema = "chrom string, start long, end long, strand string, name string"
    long = spark.createDataFrame([("c", 0, 10**11, "+", "long"), ("c", 16**6 - 1, 16**6 + 1, "+", "border")], schema)
    short = spark.createDataFrame([("c", i * 10**8, i * 10**8 + 50, "+", f"s{i}") for i in range(1200)] + [("c", 16**6, 16**6 + 3, "+", "next")], schema)
    got = {(r.a_name, r.b_name) for r in I.overlap_join(long, short).collect()}
    assert got == {("long", f"s{i}") for i in range(1000)} | {("long", "next"), ("border", "next")}
    sized = long.withColumn("l", I._level("start", "end", I.BIN))
    assert sized.select(F.explode(I._bins("start", "end", "l", list(range(14)), list(range(14)), I.BIN))).count() <= 2 * 14 * 2


def test_deep_taxonomy(spark):
    """A line of 100 taxa with a branch at each, repeated nodes, a missing parent, and a circle."""
    line = [(1, None), *((i, i - 1) for i in range(2, 101)), *((1000 + i, i) for i in range(1, 101)), (5, 4), (7000, 6999)]
    nodes = spark.createDataFrame(line, "taxid long, parent long")
    paths = TX.taxon_paths(nodes)
    found = {r.taxid: r.path for r in paths.collect()}
    assert len(found) == 201 and found[100] == list(range(1, 101)) and found[1060] == [*range(1, 61), 1060] and found[7000] == [6999, 7000]
    df = spark.createDataFrame([("a", 1100), ("a", 1050), ("b", 1090), ("b", 40), ("c", 100), ("c", 30), ("d", 7000), ("d", 3), ("e", 30), ("e", 1060), ("e", 1070), ("e", 50)], "k string, t long")
    assert {r.k: r.lca for r in TX.lca(df, paths, "k", "t").collect()} == {"a": 50, "b": 40, "c": 30, "e": 30}
    assert {r.k: r.lca for r in TX.lca(df, paths, "k", "t", strip=True).collect()} == {"a": 50, "b": 1090, "c": 100, "e": 60}
    reads = spark.createDataFrame([("r1", 1100), ("r2", 40), ("r3", 41), ("r4", 1039)], "read string, taxid long")
    targets = spark.createDataFrame([(40,), (1039,)], "taxid long")
    assert sorted(map(tuple, TX.reads_by_taxa(reads, paths, targets).collect())) == [(40, "r1"), (40, "r2"), (40, "r3"), (1039, "r4")]
    with pytest.raises(ValueError, match="circle"):
        TX.taxon_paths(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "taxid long, parent long"))


def test_fastq_records_that_are_none(spark, tmp_path):
    good = "".join(f"@r{i} d\nACGT\n+\nII@I\n" for i in range(50))
    (tmp_path / "ok.fq").write_text("\n" + good + "\n\n")
    for size in (13, 100, 1 << 20):
        assert sorted(r.read_id for r in IN.read_fastq(spark, str(tmp_path / "ok.fq"), size).collect()) == sorted(f"r{i}" for i in range(50))
    (tmp_path / "bad.fq").write_text(good + "@odd\nACG\n+\nII\n" + good)
    (tmp_path / "cut.fq").write_text(good + "@last\nACG\n")
    for name in ("bad.fq", "cut.fq"):
        with pytest.raises(Exception, match="no FASTQ record"):
            IN.read_fastq(spark, str(tmp_path / name)).collect()
    assert IN.read_fastq(spark, str(tmp_path / "bad.fq"), bad_records="skip").count() == 100
    assert IN.read_fastq(spark, str(tmp_path / "cut.fq"), bad_records="skip").count() == 50


def test_compatible_taxa_of_shuffled_rows(spark, tmp_path):
    nodes = spark.createDataFrame([(1, 1), *((i, 1 if i < 5 else i // 5) for i in range(2, 60))], "taxid long, parent long")
    closure, paths = TX.taxon_closure(nodes).cache(), TX.taxon_paths(nodes)
    kin = {r.descendant for r in closure.where("ancestor = 3").collect()} | {r.ancestor for r in closure.where("descendant = 3").collect()}
    rows = [(i, f"{i % 58 + 2}__{(i * 7) % 58 + 2}", "z" * (i % 30)) for i in range(200)]
    hits = stored(spark.createDataFrame(rows, "i long, ids string, other string"), tmp_path / "h")
    got = sorted(r.i for r in TX.taxon_compatible(hits, paths, "ids", 3).select("i").collect())
    assert got == [i for i, ids, _ in rows if {int(x) for x in ids.split("__")} & kin]


def test_dedup_keeps_whole_qualities(spark):
    df = spark.createDataFrame([("a", "ACGTACGTAC", "T", "I#########", "I"), ("b", "ACGTACGTAC", "T", "#########I", "#"), ("c", "", "", "", ""), ("d", None, None, None, None)], "id string, seq1 string, seq2 string, qual1 string, qual2 string")
    got = {r.id: (r.n, r.qual1, r.qual2) for r in RD.dedup_pairs(df).collect()}
    assert got == {"a": (2, "I########I", "I"), "c": (2, "", "")}
    with pytest.raises(Exception, match="lengths"):
        RD.dedup_pairs(spark.createDataFrame([("a", "AC", "T", "I", "I")], df.schema)).collect()
    reads = spark.createDataFrame([("r_x3", "ACG", "##I"), ("q", "ACG", "I##"), ("p", "A", "5")], "read_id string, seq string, qual string")
    unique, log = RD.dedup_reads(reads, "abc", 1)
    assert {(r.read_id, r.seq, r.qual) for r in unique.collect()} == {("abc1_000000001_x1", "A", "5"), ("abc1_000000002_x4", "ACG", "I#I")}
    assert {tuple(r) for r in log.collect()} == {("p", "abc1_000000001_x1"), ("q", "abc1_000000002_x4"), ("r_x3", "abc1_000000002_x4")}


def test_hierarchy_of_any_depth(spark, tmp_path):
    rows = [("g", None, 10), ("m", "g", 11), ("e", "m", 12), ("x", "e", 13), ("y", "x", 14), ("z", "y", 15), ("h", None, 5), ("k", "h", 6), ("g", None, 30), ("lost", "nobody", 1), ("l2", "lost", 2), ("loop", "pool", 3), ("pool", "loop", 4), ("self", "self", 7)]
    df = stored(spark.createDataFrame([(i, p, "c", s, s + 1, "o" * s) for i, p, s in rows], "id string, parent string, seqid string, start long, end long, other string"), tmp_path / "f")
    placed, lost = FT.sort_hierarchy(df)
    assert [(r.id, r.start) for r in placed.collect()] == [("h", 5), ("k", 6), ("g", 10), ("m", 11), ("e", 12), ("x", 13), ("y", 14), ("z", 15), ("g", 30)]
    assert {r.id for r in lost.collect()} == {"lost", "l2", "loop", "pool", "self"}


def test_hierarchy_with_clashing_names(spark):
    rows = [(f"n{i}", f"n{i - 1}" if i else None, i % 3, f"p{i}", i) for i in range(70)] + [("low", "gone", 1, "q", 0), ("under", "low", 1, "q", 0), ("deep", "under", 1, "q", 0), (None, None, 9, None, None)]
    df = spark.createDataFrame([(i, p, "c", s, s, path, n) for i, p, s, path, n in rows], "id string, parent string, seqid string, start long, end long, path string, __row int").repartition(3)
    placed, lost = FT.sort_hierarchy(df)
    assert placed.columns == df.columns == lost.columns
    assert [(r.id, r.path, r["__row"]) for r in placed.collect()] == [(f"n{i}", f"p{i}", i) for i in range(70)] + [(None, None, None)]
    assert {r.id for r in lost.collect()} == {"low", "under", "deep"}
    none, gone = FT.sort_hierarchy(df.limit(0))
    assert none.count() == gone.count() == 0


def brute_bh(ps):
    n, order = len(ps), sorted(range(len(ps)), key=lambda i: ps[i])
    q, low = [0.0] * n, 1.0
    for at in range(n - 1, -1, -1):
        low = min(low, ps[order[at]] * n / (at + 1))
        q[order[at]] = low
    return q


def test_bh_over_many_ranges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, g, float(x)) for i, (g, x) in enumerate(zip(rng.choice(["hot"] * 8 + ["b", "c", ""], 3000).tolist(), rng.beta(0.4, 2, 3000).round(4)))]
    df = spark.createDataFrame([(i, g or None, p) for i, g, p in rows], "i long, g string, p double").repartition(7)
    got = {r.i: r.q_value for r in R.bh_adjust(df, "p", ["g"]).collect()}
    for g in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == g]
        for (i, _, _), q in zip(own, brute_bh([r[2] for r in own])):
            assert math.isclose(got[i], q, rel_tol=1e-9)
    whole = {r.i: r.q_value for r in R.bh_adjust(df, "p", []).collect()}
    assert all(math.isclose(whole[r[0]], q, rel_tol=1e-9) for r, q in zip(rows, brute_bh([r[2] for r in rows])))
    assert R.bh_adjust(df.limit(0), "p", []).count() == 0


def test_percentiles(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(x)) for g, x in zip(rng.choice(["a"] * 5 + ["b"], 1001).tolist(), rng.normal(0, 1, 1001).round(2))] + [("one", 5.0), ("none", None)]
    got = {r.g: r for r in R.exact_percentiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", {"half": 0.5, "low": 0.05, "high": 1.0}).collect()}
    assert set(got) == {"a", "b", "one"}
    for g, r in got.items():
        x = [v for k, v in rows if k == g]
        assert np.allclose([r.half, r.low, r.high], np.quantile(x, [0.5, 0.05, 1.0]))


def test_numbers_within_groups(spark):
    rng = np.random.default_rng(13)
    rows = [(g, int(x), i) for i, (g, x) in enumerate(zip(rng.choice(["hot"] * 9 + ["b", ""], 800).tolist(), rng.integers(0, 200, 800)))]
    df = spark.createDataFrame([(g or None, x, i) for g, x, i in rows], "g string, x int, i int").repartition(6)
    got = {r.i: (r.at, r.n) for r in R.numbers_within(df, ["g"], ["x", "i"], "at", "n").collect()}
    for g in {r[0] for r in rows}:
        own = sorted((x, i) for k, x, i in rows if k == g)
        assert all(got[i] == (at + 1, len(own)) for at, (_, i) in enumerate(own))
    named = {r.i: r.new_id for r in FT.disambiguate(spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("b", 1, 3)], "id string, x int, i int"), "id", ["x"]).collect()}
    assert named == {1: "a_2", 2: "a_1", 3: "b"}


def brute_cooccurrence(rows, k, method):
    samples = sorted({s for _, s, _ in rows})
    total, value = Counter(), Counter()
    for f, s, v in rows:
        total[s] += v
        value[f, s] += v
    names = sorted({f for f, _, _ in rows})
    x = np.array([[value[f, s] / total[s] for s in samples] for f in names])
    if method == "spearman":
        x = np.array([[(sum(b < a for b in row) + (1 + sum(b == a for b in row)) / 2) for a in row] for row in x])
    out = []
    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            score = 2 * np.minimum(x[i], x[j]).sum() / (x[i].sum() + x[j].sum()) if method == "bray" else np.corrcoef(x[i], x[j])[0, 1]
            if not np.isnan(score):
                out.append((names[i], names[j], round(float(score), 9)))
    return sorted(out, key=lambda e: (-e[2], e[0], e[1]))[:k], sorted(out, key=lambda e: (e[2], e[0], e[1]))[:k]


@pytest.mark.parametrize("method", ["pearson", "spearman", "bray"])
def test_cooccurrence_in_blocks(spark, method, monkeypatch):
    monkeypatch.setattr(G, "_CELLS", 50)
    rng = np.random.default_rng(5)
    rows = [(f"f{f}", f"s{s}", float(rng.integers(1, 1000))) for f in range(25) for s in rng.choice(9, rng.integers(2, 8), replace=False)]
    df = spark.createDataFrame(rows, "feature string, sample string, value double")
    for size in (20, 1 << 17):
        got = G.cooccurrence(df, 6, method, rows=size).collect()
        top, bottom = brute_cooccurrence(rows, 6, method)
        for side, want in (("top", top), ("bottom", bottom)):
            found = {(r.a, r.b): r.score for r in got if r.side == side}
            assert found.keys() == {e[:2] for e in want} and all(math.isclose(found[e[:2]], e[2], abs_tol=1e-8) for e in want)
    assert G.cooccurrence(df.limit(0), 3, method).count() == 0


@pytest.mark.parametrize("method", ["pearson", "spearman", "bray"])
def test_cooccurrence_of_features_that_exclude_each_other(spark, method):
    """Groups of features with samples of their own: edges between groups are the weakest, and few blocks need to meet."""
    rng = np.random.default_rng(3)
    rows = [(f"f{g}{i}", f"s{g}{s}", float(rng.integers(1, 50))) for g in range(4) for i in range(6) for s in rng.choice(5, 3, replace=False)]
    rows += [("A", "s00", 2.0), ("A", "s01", 3.0), ("B", "s10", 2.0), ("B", "s11", 1.0)]
    df = spark.createDataFrame(rows, "feature string, sample string, value double")
    for size in (10, 40, 1 << 17):
        got = G.cooccurrence(df, 5, method, rows=size).collect()
        for side, want in zip(("top", "bottom"), brute_cooccurrence(rows, 5, method)):
            found = {(r.a, r.b): r.score for r in got if r.side == side}
            assert found.keys() == {e[:2] for e in want} and all(math.isclose(found[e[:2]], e[2], abs_tol=1e-8) for e in want)


def test_cooccurrence_in_few_samples(spark):
    rows = [("A", "s1", 1.0), ("A", "s2", 2.0), ("B", "s3", 1.0), ("B", "s4", 2.0), *(("C", f"s{i}", float(i)) for i in range(1, 5))]
    got = G.cooccurrence(spark.createDataFrame(rows, "feature string, sample string, value double"), 3).where("side = 'bottom'").orderBy("score").collect()
    assert [(r.a, r.b) for r in got][0] == ("A", "B") and len(got) == 3


def test_blocks_that_cannot_matter_do_not_meet(spark, monkeypatch):
    """Features that are alike in samples of their own: pairs of other blocks stay below the kth edge."""
    rows = [(f"f{g}{i}", f"s{g}{s}", 10.0 + i * s) for g in range(6) for i in range(4) for s in range(4)]
    df = spark.createDataFrame(rows, "feature string, sample string, value double")
    seen = []
    was = G._bounded_pairs
    monkeypatch.setattr(G, "_bounded_pairs", lambda *a: seen.append(was(*a).count()) or was(*a))
    got = G.cooccurrence(df, 3, "bray", rows=16).collect()
    assert sum(r.side == "top" for r in got) == 3 and seen[0] < 15


def test_haplotypes_with_unknown_bases(spark):
    """Three sure AC, one AN: each way to read it by 1 and what is known; a doubly heterozygous subject takes the most frequent that fits."""
    g = [("s1", "A", "A", "C", "C"), ("s2", "A", "A", "C", "T"), ("s3", "A", "A", "N", "N"), ("s4", "A", "G", "C", "T"), ("s5", "G", "C", "G", "A")]
    df = spark.createDataFrame([(s, "p", m, x, y) for s, a1, a2, b1, b2 in g for m, x, y in ((1, a1, a2), (2, b1, b2))], "subject string, pop string, marker int, a1 string, a2 string")
    got = {r.haplotype: r.weight for r in HP.haplotype_freq(df).collect()}
    # Sure: AC 3, AT 1, AN 2; AN goes 4/8 to AC, 2/8 to AT, 1/8 each to AA and AG.
    want = {"AC": 4.0 + 1, "AT": 1.5, "AA": 0.25, "AG": 0.25, "GT": 1.0}
    assert {k: round(v, 9) for k, v in got.items()} == want
    assert round(sum(r.percent for r in HP.haplotype_freq(df).collect()), 6) == 100


def test_columns_named_like_helpers_stay(spark):
    df = spark.createDataFrame([("a", 0.01, 7, True, 0.5), ("a", 0.04, 8, False, 0.5), ("b", 0.2, 9, None, 0.5)], "g string, p double, __n int, __used boolean, q_value double")
    first = TB.limit_per_group(df, ["g"], 1, [F.col("p")])
    assert first.columns == df.columns and sorted(r["__n"] for r in first.collect()) == [7, 9]
    adjusted = R.bh_adjust(df, "p", [])
    assert adjusted.columns == ["g", "p", "__n", "__used", "q_value"]
    assert sorted((r["__n"], r["__used"], round(r.q_value, 9)) for r in adjusted.collect()) == [(7, True, 0.03), (8, False, 0.06), (9, None, 0.2)]


def test_many_unknown_bases(spark):
    """Ways are rows and no array: 13 N in one haplotype are 4^13 of them."""
    import itertools

    df = spark.createDataFrame([("NACNNNGNNTN", 1), ("ACG", 2), ("", 3), ("N", 4), (None, 5)], "haplotype string, __n int")
    got = Counter((r.haplotype, r["__n"]) for r in HP.expand_unknown(df).collect())
    want = Counter(("{}AC{}{}{}G{}{}T{}".format(*x), 1) for x in itertools.product("ACGT", repeat=7)) + Counter([("ACG", 2), ("", 3), (None, 5), *((b, 4) for b in "ACGT")])
    assert got == want
    one = HP.expand_unknown(spark.createDataFrame([("N" * 13,)], "haplotype string"))
    assert one.count() == 4**13
    with pytest.raises(Exception, match="over 30 N"):
        HP.expand_unknown(spark.createDataFrame([("N" * 31,)], "haplotype string")).count()


def test_short_lists_are_checked(spark, monkeypatch):
    monkeypatch.setattr(TB, "MOST_TEMPLATES", 2)
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    with pytest.raises(ValueError):
        TB.select_by_template(names, names, "id", "^($id)?$")
    monkeypatch.setattr(HP, "MOST_KNOWN", 0)
    g = spark.createDataFrame([("s", "p", 1, "A", "A")], "subject string, pop string, marker int, a1 string, a2 string")
    with pytest.raises(ValueError):
        HP.haplotype_freq(g)


def test_aligned_strings():
    assert RD.aligned_strings("ACGTA", "2M1I2M", "4") == ("ACGTA", "AC-TA", 1, 4)
    assert RD.aligned_strings("ACGTA", "3M2D2M", "1G1^TT2") == ("ACG--TA", "AGGTTTA", 2, 7)
    assert RD.aligned_strings("xxACG", "2S3M", "0T2") == ("ACG", "TCG", 0, 3)
    for odd in ((None, "1M", "1"), ("A", "2M", "2"), ("AC", "2M", "3"), ("AC", "2M", "1"), ("AC", "1M1D1M", "3"), ("AC", "2M", "1^G1")):
        assert RD.aligned_strings(*odd) is None


def test_alignment_ordinals(spark):
    rows = [("q", "r2", 1, 5), ("q", "r1", 2, 6), ("q", "r2", 3, 7), ("p", "r1", 4, 8)]
    df = spark.createDataFrame([(q, r, pos, "AC", "2M", "2", i) for q, r, i, pos in rows], "qname string, rname string, pos long, seq string, cigar string, md string, line long")
    got = {r.line: (r.hit_num, r.hsp_num, r.hit_to) for r in RD.expand_alignment(df, ["line"]).collect()}
    assert got == {1: (1, 1, 6), 2: (2, 1, 7), 3: (1, 2, 8), 4: (1, 1, 9)}


def test_ambiguous_hits_settle_by_overlap(spark):
    best = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "z"), ("c", "x"), ("d", "y"), ("d", "w")], "query string, hit string")
    at = "name string, chrom string, start long, end long, strand string"
    q = spark.createDataFrame([("a", "c", 0, 100, "+"), ("b", "c", 500, 600, "+"), ("d", "c", 0, 100, "+")], at)
    s = spark.createDataFrame([("x", "c", 10, 110, "+"), ("y", "c", 5, 105, "+"), ("z", "c", 560, 700, "+"), ("w", "c", 5, 105, "+"), ("w", "c", 300, 400, "+")], at)
    got = {tuple(r) for r in H.settle_by_overlap(best, q, s).collect()}
    assert got == {("a", "y", True), ("b", "x", False), ("b", "z", False), ("c", "x", True), ("d", "y", True), ("d", "w", True)}


def test_sequences_with_3_prime_extension(spark):
    whole = "ACGTTGCAAC" * 5
    parts = spark.createDataFrame([("x", "c", 5, 10, "+"), ("x", "c", 20, 22, "+"), ("y", "c", 3, 9, "-"), ("z", "c", 44, 48, "+")], "id string, chrom string, start long, end long, strand string")
    got = {r.id: r.seq for r in FT.extract_sequences(parts, spark.createDataFrame([("c", whole)], "chrom string, seq string"), tile=7, ext3=4).collect()}
    turned = whole[0:9][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert got == {"x": whole[5:10] + whole[20:26], "y": turned, "z": whole[44:50]}


def test_rarefaction_against_a_loop(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.choice(["", "g1", "g2", "g3", "g4"]), float(rng.choice([0.5, 1.0])), float(rng.uniform(0, 2))) for i in range(300)]
    rows = [(i, g, w if g else 0.0, k if g else 0.0) for i, g, w, k in rows]
    df = spark.createDataFrame(rows, "read long, gene string, w double, k double")
    known = spark.createDataFrame([("g1",), ("g3",)], "gene string")
    got = {(r.rep, r.chunk): r for r in E.rarefaction(df, F.col("read") * 7919 * F.col("rep") % 1009, 50, 2, 8, 6.0, known, "w", "k").collect()}
    for rep in (1, 2):
        sums, seen, mapped, unique = {}, set(), 0.0, 0.0
        for c in range(1, 7):
            for i, g, w, k in rows:
                if (i * 7919 * rep % 1009) % 6 + 1 == c:
                    mapped, unique = mapped + w, unique + (w if w >= 1 else 0)
                    n, r = sums.get(g, (0, 0))
                    sums[g] = (n + w, r + k)
            seen |= {g for g, (n, k) in sums.items() if g and n >= 8 and k >= 6}
            r = got[rep, c]
            assert (round(r.mapped, 6), round(r.mapped_unique, 6), r.genes, r.known, r.novel) == (round(mapped, 6), round(unique, 6), len(seen), len(seen & {"g1", "g3"}), len(seen - {"g1", "g3"}))


def test_steady_line(spark):
    y = [0, 1, 4, 9, 12, 15, 18, 22, 27, 40, 60, 80, 90]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(y)], "g string, x int, y int")
    r = E.steady_line(df, "x", "y", "g").first()
    fits = []
    for i in range(len(y) - 5 - 1):
        ys = [v or 0.001 for v in y[i : i + 5]]
        slope, intercept = np.polyfit(range(i, i + 5), ys, 1)
        if np.corrcoef(range(i, i + 5), ys)[0, 1] ** 2 > 0.98:
            fits.append((slope, i, i + 4, intercept))
    want = min(fits)
    assert np.allclose([r.slope, r.start, r.end, r.intercept], want)


def test_principal_components(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 3, (4, 60))
    df = spark.createDataFrame([(f"f{f}", f"s{s}", float(x[s, f])) for s in range(4) for f in range(60)], "feature string, sample string, value double")
    centred = x - x.mean(axis=0)
    for top in (None, 20):
        use = centred if top is None else centred[:, np.argsort(-(centred**2).sum(axis=0))[:top]]
        u, d, _ = np.linalg.svd(use, full_matrices=False)
        got = {(r.sample, r.component): r for r in E.sample_pca(df, [f"s{i}" for i in range(4)], 2, top).collect()}
        for c in (0, 1):
            want = u[:, c] * d[c] * (1 if (u[:, c])[np.abs(u[:, c]).argmax()] > 0 else -1)
            assert np.allclose([got[f"s{i}", c + 1].score for i in range(4)], want) and math.isclose(got["s0", c + 1].share, d[c] ** 2 / (d**2).sum())


def test_renaming_and_restoring(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "id string")
    given = spark.createDataFrame([("b", "B!")], "old_id string, new_id string")
    assert {(r.id, r.new_id) for r in RD.rename_ids(df, "n", "id", given).collect()} == {("a", "n0000000001"), ("b", "B!"), ("c", "n0000000003"), (None, None)}
    text = spark.createDataFrame([(1, "x1 and  x2\tx1")], "k int, t string")
    names = spark.createDataFrame([("a.b", "x1"), ("longer", "x2")], "old_id string, new_id string")
    assert RD.restore_ids(text, names, "t", "k", width=5, pad="_", sub=r"\.", repl="-").first().t == "a-b__ and  longer\ta-b__"


def test_sweep_of_whole_texts(spark):
    """A match far into a long text counts as much as one at its beginning."""
    rng = np.random.default_rng(9)
    word = lambda n: "".join(rng.choice(list("ACGT"), n))
    known = word(400)
    reads = [("all", known), ("late", word(300) + known), ("early", known + word(300)), ("none", word(600)), ("few", word(900) + known[:100]), ("short", "ACG"), ("empty", ""), ("null", None)]
    df = spark.createDataFrame(reads, "read_id string, seq string")
    kmers = {known[i : i + 12] for i in range(len(known) - 11)}
    want = {i for i, s in reads if s and len(s) >= 12 and 2 * sum(s[j : j + 12] in kmers for j in range(len(s) - 11)) >= len(s) - 11}
    got = {r.read_id for r in K.sweep_reads(df, spark.createDataFrame([(known,)], "seq string"), 12).collect()}
    assert got == want == {"all", "late", "early"}


@pytest.mark.parametrize(("k", "most"), [(1, 1 << 22), (2, 1 << 22), (3, 1 << 22), (5, 1 << 22), (12, 1 << 22), (1, 2), (3, 20), (5, 300), (5, 1), (12, 600)])
def test_sweep_holds_the_whole_query_or_a_part(spark, monkeypatch, k, most):
    """Rows are the same, whatever part of the query's k-mers tasks hold."""
    monkeypatch.setattr(GR, "MOST_HELD", most)
    monkeypatch.setattr(K, "_PIECE", 50)
    rng = np.random.default_rng(k)
    word = lambda n: "".join(rng.choice(list("abé\U0001f9ec"), n, p=[0.5, 0.3, 0.1, 0.1]))
    known = [word(40), None, "", word(3), word(90)]
    taken = lambda: known[4][(i := int(rng.integers(60))) : i + 30]
    reads = [(i, word(int(rng.integers(0, 60))) + taken() * (i % 4) + word(int(rng.integers(0, 60)))) for i in range(200)] + [(200, None), (201, ""), (202, known[0]), (203, "a"), (204, "z" * 70)]
    kmers = {t[i : i + k] for t in known if t for i in range(len(t) - k + 1)}
    want = {i for i, s in reads if s and len(s) >= k and 2 * sum(s[j : j + k] in kmers for j in range(len(s) - k + 1)) >= len(s) - k + 1}
    got = K.sweep_reads(spark.createDataFrame(reads, "read_id int, seq string").repartition(3), spark.createDataFrame([(t,) for t in known], "seq string"), k)
    assert sorted(r.read_id for r in got.collect()) == sorted(want) and 0 < len(want) < len(reads)
    assert ("Join Inner" in got._jdf.queryExecution().analyzed().toString() or len(kmers) <= most // k) and (most > 1000 or len(kmers) > most // k)


def test_sweep_moves_ids_only(spark):
    """Where tasks hold all of the query's k-mers, reads' k-mers are no rows of a join."""
    got = K.sweep_reads(spark.createDataFrame([("a", "ACGTACGT"), ("b", "TTTTTTTT")], "read_id string, seq string"), spark.createDataFrame([("ACGTACG",)], "seq string"), 4)
    assert [r.read_id for r in got.collect()] == ["a"]
    assert "Join Inner" not in got._jdf.queryExecution().analyzed().toString()


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """Substrings are compared, so one hash for all of them changes nothing."""
    monkeypatch.setattr(GR, "hashed", lambda codes, k: np.zeros(max(len(codes) - k + 1, 0), np.uint64))
    for k, known, text in [(4, ["abcd", "bcde"], "abcdebcdx"), (5, ["abcde"], "xabcdeabcd"), (7, [], "abcdefgh"), (1, ["b"], "abc")]:
        codes = GR.codes_of([text])
        held = GR.GramSet(known, k).holds(GR.hashed(codes, k), GR.words_of(codes, k))
        assert held.tolist() == [text[i : i + k] in known for i in range(len(text) - k + 1)]


def brute_trim(reads, k, least, most):
    kmers = lambda s: [s.upper()[i : i + k] for i in range(len(s or "") - k + 1)]
    n = {}
    for _, s in reads:
        for x in kmers(s):
            n[x] = n.get(x, 0) + (not set(x) - set("ACGT"))
    out = []
    for i, s in reads:
        bad = [j for j, x in enumerate(kmers(s)) if n[x] < least or (most and n[x] > most)]
        if s and len(s) >= k and (not bad or bad[0] > 0):
            out.append((i, s[: bad[0] + k - 1] if bad else s))
    return sorted(out, key=str)


@pytest.mark.parametrize(("k", "least", "most", "held"), [(3, 4, None, 1 << 18), (5, 2, 30, 1 << 18), (12, 2, None, 1 << 18), (21, 2, None, 1 << 18), (31, 3, None, 1 << 18), (7, 3, 40, 5)])
def test_rare_bases_against_a_loop(spark, monkeypatch, k, least, most, held):
    """Runs of one base, other letters, lower case, null and short reads; minimizers with more runs than a task holds."""
    rng = np.random.default_rng(k)
    word = lambda n: "".join(rng.choice(list("ACGT"), n))
    genome = word(400) + "A" * 90 + "AC" * 60
    reads = []
    for i in range(150):
        at, n = int(rng.integers(0, 560)), int(rng.integers(1, 120))
        s = genome[at : at + n]
        if i % 3 == 0 and len(s) > 9:
            j = int(rng.integers(0, len(s)))
            s = s[:j] + "ACGTNn\u00e9"[int(rng.integers(0, 7))] + s[j + 1 :]
        reads.append((f"r{i}", s.lower() if i % 11 == 0 else s))
    reads += [("null", None), ("empty", ""), ("n", "N" * 50), ("long", genome * 30), (None, genome[:100])]
    monkeypatch.setattr(K, "MOST_WORDS", held)
    df = spark.createDataFrame([(i, s, s, 1) for i, s in reads], "read_id string, seq string, qual string, __cut int").repartition(3)
    got = K.trim_rare_bases(df, k, least, most, qual="qual").collect()
    assert sorted([(r.read_id, r.seq) for r in got], key=str) == brute_trim(reads, k, least, most)
    assert all(r.seq == r.qual for r in got)


def test_trim_of_no_reads(spark):
    assert K.trim_rare_bases(spark.createDataFrame([], "read_id string, seq string"), 5, 2).collect() == []


def test_grams_of_pieces():
    texts = ["abcdefghij" * 5, "", None, "xyz", "\U0001f600bc\U0001f600bc"]
    whole = {(r, int(a), int(h)) for r, t in enumerate(texts) if t for _, a, h in zip(*GR.hashes([t], 3))}
    cut = {(int(rows[o]), int(a + off[o]), int(h)) for rows, off, part in GR.pieces(texts, 2, 7) for o, a, h in zip(*GR.hashes(part, 3))}
    assert cut == whole and len({h for r, a, h in whole if r == 4}) == 3


def plain_permutation(n, key, rounds=16):
    mix = lambda x: (lambda a: a * (a % 65537 + 1) % 2147483647)((x % 2147483647 * 48271 + 11) % 2147483647)
    places = list(range(n))
    for r in range(1, rounds + 1):
        z = key * 1000003 + r * 7919
        for i, x in enumerate(places):
            y = ((mix(z) * 2147483647 + mix(z + 1)) % n - x) % n
            if mix(mix(max(x, y)) + mix(z + 2)) % 2:
                places[i] = y
    return places


@pytest.mark.parametrize("n", [1, 2, 3, 7, 256, 1001])
def test_permutation_of_exactly_n(spark, n):
    df = spark.range(n).select("id", F.lit("x").alias("__place"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("rep"))
    got = R.keyed_permutation(df, "id", n, F.col("rep"), "at").collect()
    assert all(r["__place"] == "x" for r in got)
    orders = [[r.at for r in sorted(got, key=lambda r: r.id) if r.rep == rep] for rep in (1, 2, 3)]
    assert orders == [plain_permutation(n, rep) for rep in (1, 2, 3)]
    assert all(sorted(o) == list(range(n)) for o in orders)
    if n > 200:  # near as many meet in place, or stay near each other, as by chance
        assert sum(a == b for a, b in zip(orders[0], orders[1])) < 8 and sum(i == a for i, a in enumerate(orders[0])) < 8
        assert abs(np.corrcoef(range(n), orders[0])[0, 1]) < 0.2 and abs(np.corrcoef(orders[0][:-1], orders[0][1:])[0, 1]) < 0.2


def test_rarefaction_in_even_chunks(spark):
    rng = np.random.default_rng(8)
    rows = [(i // 2, f"g{int(rng.integers(0, 40))}") for i in range(505)] + [(None, None), (None, "g1")]
    df = spark.createDataFrame(rows, "read long, gene string").repartition(5)
    got = {(r.rep, r.chunk): r for r in E.rarefaction(df, None, 50, 2, 4).collect()}
    assert sorted(got) == [(rep, c) for rep in (1, 2) for c in range(1, 12)]
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1] or ""))
    for rep in (1, 2):
        places = plain_permutation(len(rows), rep)
        for c in range(1, 12):
            genes = [ordered[i][1] for i, at in enumerate(places) if at < 50 * c]
            r = got[rep, c]
            assert r.mapped == min(50 * c, len(rows)) == r.mapped_unique
            assert r.genes == sum(genes.count(g) >= 4 for g in set(genes) - {None})


def test_many_names_by_template(spark):
    """100,000 ids; ids with signs of the regex language, ids within ids, the empty one; templates that need no id."""
    texts = [(f"seq{i} len=5", i) for i in range(0, 3000, 7)] + [("a.b+c len=5", -1), ("a\\Eb len=5", -2), ("", -3), (None, -4), ("axb+c len=5", -5)]
    ids = [f"seq{i}" for i in range(100_000)] + ["a.b+c", "a\\Eb", "", None]
    df, named = spark.createDataFrame(texts, "h string, n int"), spark.createDataFrame([(i,) for i in ids], "id string")
    got = {(r.n, r.matched_id) for r in TB.select_by_template(df, named, "h", r"^$id\s").collect()}
    assert got == {(n, f"seq{n}") for t, n in texts if n >= 0} | {(-1, "a.b+c"), (-2, "a\\Eb")}
    few = spark.createDataFrame([("seq7",), ("seq70",), ("len",)], "id string")
    got = sorted((r.n, r.h) for r in TB.select_by_template(df, few, "h", "$id", rename=True).where("n < 100 AND n > 0").collect())
    assert got == sorted([(n, "len") for t, n in texts if 0 < n < 100] + [(7, "seq7"), (70, "seq7"), (70, "seq70"), (77, "seq7")])
    assert TB.select_by_template(df, few, "h", "(?i)^$ID|^a|$id").where("n = -1").count() == 3


def test_many_names_within_ids(spark):
    feats = spark.createDataFrame([(f"rna-x{i}.1", f"g{i}") for i in range(2000)] + [("x5", "own"), (None, "n"), ("rna-z", None)], "id string, parent string")
    df = spark.createDataFrame([(f"tx=x{i}", i) for i in range(0, 30_000, 3)] + [("tx=x5", 5), (None, -1), ("none", -2)], "c string, __id int")
    got = {(r["__id"], r.gene) for r in FT.add_gene(df, feats, "c", "tx=(x.*)").collect()}
    ids = sorted(f"rna-x{i}.1" for i in range(2000))
    near = {n: next((j for j in ids if f"x{n}" in j), None) for n in range(0, 2000, 3)}
    want = {(n, f"g{near[n][5:-2]}" if n < 2000 else None) for n in range(0, 30_000, 3)} | {(5, "own"), (-1, None), (-2, None)}
    assert got == want


def test_shortest_first_read(spark, tmp_path):
    for name, text in (("a", "@1\nACGTAC\n+\nIIIIII\n@2\nAC\n+\nII\n"), ("b", "@1\nACGT\n+\nIIII\n"), ("empty", "")):
        (tmp_path / name).write_text(text)
    assert IN.shortest_first_read(spark, [str(tmp_path / n) for n in ("a", "b", "empty")]) == 4
    with pytest.raises(ValueError):
        IN.shortest_first_read(spark, [str(tmp_path / "empty")])


FASTA = (">a first one\nACGT\nAC GT\r\nA\n>b\n\n>  \nTT\n>a again >x\n" + "ACGTTGCA" * 9 + "\n" + "GATTACA" * 5 + "\n>c " + "long" * 12 + "\nA>C\n\nG\n>d\nNNNN")


@pytest.mark.parametrize("part", [1, 2, 3, 7, 20, 64, 5000])
def test_fasta_tiles_cut_anywhere(spark, tmp_path, part):
    """Ranges that end within headers, lines and line ends give the tiles of whole records."""
    from omicspark.sources.fasta import read_fasta_tiles

    (tmp_path / "fa").mkdir()
    (tmp_path / "fa" / "one.fa").write_bytes(("\n" + FASTA).encode())
    (tmp_path / "fa" / "two.fa").write_bytes(b">a first one\nGG\n")
    want = []
    for name, text in (("one.fa", "\n" + FASTA), ("two.fa", ">a first one\nGG\n")):
        at = text.index(">")
        while at >= 0:
            after = text.find("\n>", at)
            head, _, body = text[at : after + 1 if after >= 0 else None].partition("\n")
            words = head[1:].split(None, 1) if head[1:2].strip() else ["", head[1:]]
            seq = "".join(body.split())
            want += [(words[0], words[1].strip() if len(words) > 1 else "", name, at, t, seq[t * 10 : t * 10 + 10]) for t in range(max(1, -(-len(seq) // 10)))]
            at = after + 1 if after >= 0 else -1
    got = [(r.seq_id, r.descr, r.file.rsplit("/", 1)[1], r.record, r.tile, r.bases) for r in read_fasta_tiles(spark, f"file://{tmp_path}/fa", 10, part).collect()]
    assert sorted(got) == sorted(want)


def test_fasta_tiles_of_odd_files(spark, tmp_path):
    import gzip

    from omicspark.sources.fasta import read_fasta_tiles

    (tmp_path / "none.fa").write_bytes(b"")
    assert read_fasta_tiles(spark, str(tmp_path / "none.fa"), 10).collect() == []
    assert IN.read_fastq(spark, str(tmp_path / "none.fa")).collect() == []
    (tmp_path / "headless.fa").write_bytes(b"ACGT\n>a\nC\n")
    with pytest.raises(Exception, match="before the first header"):
        read_fasta_tiles(spark, str(tmp_path / "headless.fa"), 10, 3).collect()
    with gzip.open(tmp_path / "one.fa.gz", "wb") as f:
        f.write(FASTA.encode())
    (tmp_path / "one.fa").write_bytes(FASTA.encode())
    rows = lambda name: sorted((r.seq_id, r.record, r.tile, r.bases) for r in read_fasta_tiles(spark, str(tmp_path / name), 10, 50).collect())
    assert rows("one.fa.gz") == rows("one.fa")


def test_one_record_is_read_by_many_tasks(spark, tmp_path):
    """A single line of 3 MB in ranges of 64 KB; parts are cut out of its tiles as out of the whole."""
    from omicspark.sources.fasta import read_fasta_tiles

    rng = np.random.default_rng(5)
    seq = "".join(rng.choice(list("ACGT"), 3_000_000))
    (tmp_path / "g.fa").write_text(">chr\n" + seq)
    tiles = read_fasta_tiles(spark, str(tmp_path / "g.fa"), 1 << 14, 1 << 16)
    got = tiles.collect()
    assert "".join(r.bases for r in sorted(got, key=lambda r: r.tile)) == seq and len(got) == -(-len(seq) // (1 << 14))
    cuts = sorted(int(x) for x in rng.integers(0, len(seq) - 40_000, 20))
    parts = spark.createDataFrame([(f"p{i}", "chr", c, c + 1 + 2000 * i, "+") for i, c in enumerate(cuts)], "id string, chrom string, start long, end long, strand string")
    found = {r.id: r.seq for r in FT.extract_sequences(parts, tiles.withColumnRenamed("seq_id", "chrom"), tile=1 << 14).collect()}
    assert found == {f"p{i}": seq[c : c + 1 + 2000 * i] for i, c in enumerate(cuts)}


def test_components_and_distances_of_many_samples(spark):
    """More samples than a block, sparse values, repeated and unknown rows; a plan that doesn't grow."""
    rng = np.random.default_rng(11)
    n, m = 700, 150
    names = [f"s{i}" for i in range(n)]
    x = np.where(rng.random((n, m)) < 0.3, rng.gamma(1.0, 3.0, (n, m)), 0.0) + np.outer(rng.normal(size=n) > 0, rng.random(m) > 0.5) * 4.0
    x[5] = 0.0
    cells = [(f"f{f}", names[s], float(x[s, f]) / 2) for s, f in zip(*np.nonzero(x))]
    df = spark.createDataFrame([*cells, *cells, ("f0", "other", 1e9), ("f1", "s0", None), (None, "s5", 0.0)], "feature string, sample string, value double")
    centred = x - x.mean(axis=0)
    for top in (None, 40):
        use = centred if top is None else centred[:, np.argsort(-(centred**2).sum(axis=0))[:top]]
        u, d, _ = np.linalg.svd(use, full_matrices=False)
        got = {(r.sample, r.component): r for r in E.sample_pca(df, names, 3, top).collect()}
        for c in range(3):
            want = u[:, c] * d[c] * (1 if u[np.abs(u[:, c]).argmax(), c] > 0 else -1)
            assert np.allclose([got[s, c + 1].score for s in names], want, atol=1e-6) and math.isclose(got["s0", c + 1].share, d[c] ** 2 / (d**2).sum())
    euclid = {(r.a, r.b): r.distance for r in E.euclidean_distance(df, names).collect()}
    assert len(euclid) == n * (n - 1) // 2
    some = [(int(a), int(b)) for a, b in rng.integers(0, n, (300, 2)) if a < b] + [(0, n - 1), (5, 6), (511, 512)]
    assert all(math.isclose(euclid[names[a], names[b]], float(np.linalg.norm(x[a] - x[b])), rel_tol=1e-9) for a, b in some)
    js = {(r.a, r.b): r.distance for r in E.js_distance(df, names).collect()}
    part = lambda p, q: sum(v * math.log2(2 * v / (v + w)) for v, w in zip(p, q) if v > 0)
    assert len(js) == len(euclid) and all(math.isclose(js[names[a], names[b]], math.sqrt((part(x[a], x[b]) + part(x[b], x[a])) / 2), rel_tol=1e-9) for a, b in some)


def test_components_of_nothing(spark):
    df = spark.createDataFrame([], "feature string, sample string, value double")
    assert {(r.score, r.share) for r in E.sample_pca(df, ["a", "b"]).collect()} == {(0.0, 0.0)} and E.sample_pca(df, ["a", "b"]).count() == 4
    assert E.sample_pca(df, []).collect() == [] and [tuple(r) for r in E.euclidean_distance(df, ["a", "b"]).collect()] == [("a", "b", 0.0)]
    flat = spark.createDataFrame([("f", "a", 1.0), ("f", "b", 1.0)], "feature string, sample string, value double")
    assert {r.share for r in E.sample_pca(flat, ["a", "b"]).collect()} == {0.0} and E.js_distance(flat, ["a", "b"]).first().distance == 0.0
    assert E.sample_pca(flat, ["a"]).count() == 1


def test_places_of_mature_sequences_move_once(spark, monkeypatch):
    """Pieces that end within a repeat, rows that come twice, nulls; pairs are made by the last join alone, after which nothing moves."""
    rng = np.random.default_rng(4)
    mature = [(f"m{i}", "".join(rng.choice(list("AC"), n))) for i, n in enumerate((2, 3, 4, 5, 5, 6))] + [("rep", "AAA"), ("rep", "AAA"), ("short", "A"), ("null", None)]
    precursors = [(f"p{i}", "".join(rng.choice(list("AC"), int(n)))) for i, n in enumerate(rng.integers(1, 60, 12))] + [("run", "A" * 50), ("run", "A" * 50), ("null", None), ("empty", "")]
    want = set()
    for m, x in mature:
        for p, seq in precursors:
            at = seq.find(x) if seq and x and len(x) >= 2 else -1
            while at >= 0:
                want.add((m, p, at + 1))
                at = seq.find(x, at + len(x))
    a, b = spark.createDataFrame(mature, "id string, seq string"), spark.createDataFrame(precursors, "id string, seq string")
    was = GR.pieces
    for most in (7, 1 << 20):
        monkeypatch.setattr(K, "pieces", lambda texts, overlap, most=most: was(texts, overlap, most))
        got = K.find_in(a, b, 2)
        rows = [tuple(r) for r in got.collect()]
        assert set(rows) == want and len(rows) == len(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("Join")[0] and "contains" not in plan


def test_places_are_dealt_by_their_pairs(spark, monkeypatch):
    """One sequence that all texts hold: its pairs are made by many tasks, of equal ids too."""
    for name, value in (("BLOCK", 16), ("TASK_PAIRS", 64), ("LEAST_PAIRS", 16)):
        monkeypatch.setattr(P, name, value)
    mature = spark.createDataFrame([(f"m{i}", "ACG") for i in range(40)] + [(None, "ACG"), ("n", "TTTT")], "id string, seq string")
    texts = spark.createDataFrame([(f"p{i % 50}", "GACGT" + "C" * i) for i in range(60)] + [(None, "ACGACG")], "id string, seq string")
    got = K.find_in(mature, texts, 3).withColumn("task", F.spark_partition_id()).collect()
    names = [*(f"m{i}" for i in range(40)), None]
    assert Counter((r.mature, r.precursor, r.position) for r in got) == Counter([(m, f"p{i % 50}", 2) for m in names for i in range(60)] + [(m, None, at) for m in names for at in (1, 4)])
    tasks = Counter(r.task for r in got)
    assert len(tasks) >= 4 and max(tasks.values()) < 0.7 * len(got)


@pytest.mark.parametrize("min_frac", [0.3, 0.0])
def test_exact_matches_without_pairs_that_move(spark, min_frac):
    """Names that come twice, empty intervals, other strands and chromosomes, nulls; no window over the pairs of equal sequences."""
    rng = np.random.default_rng(8)

    def make(n, tag):
        rows = [(f"{tag}{rng.integers(n * 3 // 4)}", str(rng.choice(["c", "d"])), int(s), int(s) + int(rng.integers(0, 12)), str(rng.choice(["+", "-"])), str(rng.choice(["AC", "G*T", "TT", "*"]))) for s in rng.integers(0, 60, n)]
        return [*rows, (f"{tag}x", None, 1, 9, "+", "AC"), (f"{tag}y", "c", 1, 9, None, "TT"), (None, "c", 3, 9, "+", "GT"), (None, "c", 4, 9, "+", "AC"), (f"{tag}z", "c", 5, 9, "+", None), (f"{tag}one", "c", 5, 5, "+", f"Z{tag}"), (f"{tag}solo", "c", 5, 9, "+", "L")]

    a, b = make(40, "a"), make(50, "b")
    pairs = []
    for x in a:
        for y in b:
            if x[5] and y[5] and (s := x[5].replace("*", "")) and s == y[5].replace("*", ""):
                same = None not in (x[1], x[4]) and x[1] == y[1] and x[4] == y[4]
                o = min(x[3], y[3]) - max(x[2], y[2]) if same else 0
                pairs.append((x[0], y[0], o if o >= min_frac * (x[3] - x[2]) and o >= min_frac * (y[3] - y[2]) else None))
    n, best = Counter(p[0] for p in pairs), {}
    for name, _, score in pairs:
        if score is not None:
            best[name] = max(score, best.get(name, score))
    want = [(x, y, n[x] == 1 or x in best) for x, y, score in pairs if n[x] == 1 or x not in best or score == best[x]]
    schema = "name string, chrom string, start long, end long, strand string, seq string"
    got = I.exact_match(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), min_frac)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and {w[2] for w in want} >= {True}
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("block", [8, 1 << 12])
def test_pairs_of_one_sequence_are_made_by_many_tasks(spark, monkeypatch, block):
    """Tasks follow the pairs and not the bytes that move; a sequence of many rows meets in blocks, rows that come twice count twice."""
    for name, value in (("BLOCK", block), ("TASK_PAIRS", 64), ("LEAST_PAIRS", 16)):
        monkeypatch.setattr(P, name, value)
    make = lambda tag, n, chrom: [(f"{tag}{i // 2}", chrom, i, i + 5, "+", "AC" if i % 5 else f"S{i}") for i in range(n)] + [(f"{tag}z", chrom, 1, 2, "+", "only" + tag)]
    a, b = make("a", 60, "c"), make("b", 45, "d")
    schema = "name string, chrom string, start long, end long, strand string, seq string"
    got = I.exact_match(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 0.5).withColumn("task", F.spark_partition_id()).collect()
    partners = Counter(x[0] for x in a for y in b if x[5] == y[5])
    assert Counter((r.a_name, r.b_name, r.settled) for r in got) == Counter((x[0], y[0], partners[x[0]] == 1) for x in a for y in b if x[5] == y[5])
    tasks = Counter(r.task for r in got)
    assert len(got) > 1700 and (max(tasks.values()) < 600 and len(tasks) > 12 if block == 8 else len(tasks) > 2)
    rows = [spark.createDataFrame([(k, v) for k in (1, 2, None) for v in range(n)], f"k int, {c} int") for c, n in (("x", 30), ("y", 1))]
    made = P.all_pairs(*(P.materialize(df, "test") for df in rows), "k")
    assert sorted(map(tuple, made.select("k", "x", "y").collect())) == [(k, x, 0) for k in (1, 2) for x in range(30)]


def test_only_places_of_own_hits_meet(spark, monkeypatch):
    """A thousand places over each other on one chromosome: pairs are those of the hits, not of the chromosome."""
    best = spark.createDataFrame([(f"n{i}", f"n{i * 7 % 1000}") for i in range(1000)] + [("n1", "n500"), ("n1", "gone")], "query string, hit string")
    at = spark.createDataFrame([(f"n{i}", "c", i, i + 2000, "+") for i in range(1000)] + [("n1", None, 0, 9, "+")], "name string, chrom string, start long, end long, strand string")
    seen, was = [], H.overlap_join
    monkeypatch.setattr(H, "overlap_join", lambda *a, **k: seen.append(was(*a, **k)) or seen[-1])
    got = {tuple(r) for r in H.settle_by_overlap(best, at, at).collect()}
    assert ("n1", "n7", True) in got and ("n1", "n500", True) not in got and len(got) == 1000
    assert seen[0].count() <= 1002


def test_common_neighbours_by_threes_of_groups(spark, monkeypatch):
    """Hubs, loops, edges that come twice: whatever the number of groups, and no path of two edges is a row."""
    rng = np.random.default_rng(6)
    pairs = {(min(a, b), max(a, b)) for a, b in rng.integers(0, 40, (220, 2)).tolist() if a != b} | {(0, i) for i in range(1, 40)}
    near = {v: {a + b - v for a, b in pairs if v in (a, b)} for v in range(40)}
    edges = spark.createDataFrame([*pairs], "lo long, hi long")
    want = {(a, b): len(near[a] & near[b]) for a, b in pairs if near[a] & near[b]}
    for rows, cells in ((1 << 20, 1 << 22), (600, 7), (60, 1 << 22)):
        monkeypatch.setattr(G, "_CELLS", cells)
        assert {(r.lo, r.hi): r.common for r in G.common_neighbours(edges, 40, rows).collect()} == want
    named = spark.createDataFrame([(f"n{b}", f"n{a}", float(a)) for a, b in pairs] + [("n0", "n1", 9.0), ("n3", "n3", 1.0)], "src string, dst string, weight double")
    got = G.edge_stats(named)
    for r in got.collect():
        a, b = int(r.src[1:]), int(r.dst[1:])
        assert (r.src_degree, r.dst_degree, r.common) == (len(near[a]), len(near[b]), len(near[a] & near[b])) and r.src < r.dst
    assert got.count() == len(pairs) and "third" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_edges_move_packed(spark, monkeypatch):
    """What goes to the threes of groups are blocks of a few bytes an edge, each edge once for a group; whole numbers come back as they were."""
    rng = np.random.default_rng(12)
    n, nodes = 60_000, 2_000_000
    lo, hi = np.sort(rng.choice(np.arange(1, nodes + 1), (n, 2)), axis=1).T
    pairs = sorted({(a, b) for a, b in zip(lo.tolist(), hi.tolist()) if a < b} | {(a, b) for a in range(5, 60) for b in range(a + 1, 60)})
    for keys in ([0], [7], [0, 1, 1 << 62], np.unique(rng.integers(0, 1 << 40, 999))):
        keys = np.array(keys, np.int64)
        assert np.array_equal(G._taken(G._put(keys), len(keys)), keys)
    monkeypatch.setattr(G, "FEW_EDGES", 1000)
    packed = []
    was = G._packed
    batch = G.pa.RecordBatch.from_arrays([G.pa.array([p[e] for p in pairs], G.pa.int64()) for e in (0, 1)], names=["lo", "hi"])
    for part in was(iter([batch.slice(at, 9999) for at in range(0, len(pairs), 9999)]), 4, nodes):
        packed += part.to_pylist()
    span = nodes // 4 + 1
    back = sorted((int(k) // span * 4 + r["a"], int(k) % span * 4 + r["b"]) for r in packed for k in G._taken(r["data"], r["n"]))
    assert back == pairs and len(packed) == 16 and sum(len(r["data"]) for r in packed) < 5 * len(pairs)
    got = G.common_neighbours(spark.createDataFrame(pairs, "lo long, hi long"), nodes)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "data#" in plan
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    assert {(r.lo, r.hi): r.common for r in got.collect()} == {(a, b): len(near[a] & near[b]) for a, b in pairs if near[a] & near[b]}


@pytest.mark.parametrize("method", ["pearson", "spearman", "bray"])
@pytest.mark.parametrize("tried", [4096, 20])
def test_cooccurrence_of_features_that_seldom_meet(spark, method, tried, monkeypatch):
    """Copies of few features in samples of their own, so many edges are equal: no pairs of blocks are made, and names decide."""
    monkeypatch.setattr(G, "MOST_TRIED", tried)
    rng = np.random.default_rng(9)
    base = [(f, s, float(rng.integers(1, 9))) for s in range(8) for f in rng.choice(5, 2, replace=False)]
    rows = [(f"f{(f * 7 + g * 3) % 50:02d}{f}{g}", f"s{g}.{s}", v) for g in range(12) for f, s, v in base]
    df = spark.createDataFrame(rows, "feature string, sample string, value double")
    met, made = G._sparse_edges, []
    monkeypatch.setattr(G, "_sparse_edges", lambda *a: made.append(met(*a)) or made[-1])
    got = G.cooccurrence(df, 6, method, rows=8).collect()
    assert made[0] is not None
    for side, want in zip(("top", "bottom"), brute_cooccurrence(rows, 6, method)):
        found = [(r.a, r.b, r.score) for r in got if r.side == side]
        assert {f[:2] for f in found} == {e[:2] for e in want} and all(math.isclose(f[2], dict((e[:2], e[2]) for e in want)[f[:2]], abs_tol=1e-8) for f in found)


def test_ranges_to_sweep_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(I, "RANGE_ROWS", 16)
    rows = [("c", i * 10, i * 10 + 4, "+", f"x{i:03d}") for i in range(320)]
    df = spark.createDataFrame(rows, "chrom string, start long, end long, strand string, name string")
    seen, was = {}, I.materialize
    monkeypatch.setattr(I, "materialize", lambda d, name: seen.setdefault(name, was(d, name)))
    assert I.link_loci(df, df.limit(0)).count() == 320
    sizes = [r["count"] for r in seen["sweep-ranges"].groupBy("range").count().collect()]
    assert sum(sizes) == 320 and max(sizes) <= 32


def test_xml_files_follow_the_hits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("omicspark.storage.ROWS", 50, raising=False)
    rows = [(f"q{i % 40}", f"h{i}", float(i), 1, 9) for i in range(400)]
    OUT.write_hits_xml(spark.createDataFrame(rows, "query string, hit string, bits double, start int, end int"), str(tmp_path / "xml"))
    files = list((tmp_path / "xml").glob("part-*"))
    assert len(files) > 4  # the session's partitions
    back = spark.read.format("xml").option("rowTag", "query").schema("query STRING, hit ARRAY<STRUCT<id: STRING, bits: DOUBLE>>").load(str(tmp_path / "xml"))
    assert sorted((r.query, h.id, h.bits) for r in back.collect() for h in r.hit) == sorted(r[:3] for r in rows)


def test_tasks_of_hits_follow_the_hits(spark, monkeypatch):
    monkeypatch.setattr("omicspark.storage.ROWS", 50, raising=False)
    rows = [(f"n{i % 20}", f"n{i // 20}", float(i % 7), 0.1) for i in range(400) if i % 3]
    hits = spark.createDataFrame(rows, "query string, hit string, bits double, evalue double")
    top = H.top_hits(hits)
    near = H.near_best_hits(hits, 0.9, top)
    by_query = {q: sorted(((-b, h) for p, h, b, _ in rows if p == q)) for q in {r[0] for r in rows}}
    best = {q: (x[0][1], -x[0][0]) for q, x in by_query.items()}
    assert {(r.query, r.hit, r.bits) for r in top.collect()} == {(q, *x) for q, x in best.items()}
    assert sorted((r.query, r.hit, r.is_rbh) for r in near.collect()) == sorted((q, h, best.get(h, ("",))[0] == q) for q, h, b, _ in rows if b >= 0.9 * best[q][1])
    assert top.rdd.getNumPartitions() > 4 and near.rdd.getNumPartitions() > 4  # the session's partitions


def test_tasks_of_relations_follow_the_hits(spark, monkeypatch):
    monkeypatch.setattr("omicspark.storage.ROWS", 50, raising=False)
    pairs = [(i % 20, i // 20) for i in range(400) if i % 3]
    of = {f"n{q}": [f"n{h}" for p, h in pairs if p == q] for q in range(20)}
    marked = H.mark_reciprocal(spark.createDataFrame([("A", q, "A", x) for q, x in of.items()], "qdb string, query string, sdb string, hits array<string>"))
    assert {r.query: r.marked for r in marked.collect()} == {q: ";".join(h + "*" * (q in of[h]) for h in x) for q, x in of.items()}
    assert marked.rdd.getNumPartitions() > 4


def test_tasks_of_a_hierarchy_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr("omicspark.storage.ROWS", 50, raising=False)
    rows = [(f"g{i}", None) for i in range(100)] + [(f"m{i}", f"g{i % 130}") for i in range(300)] + [(f"e{i}", f"m{i % 310}") for i in range(400)]
    df = spark.createDataFrame([(i, p, "c", 1, 2) for i, p in rows], "id string, parent string, seqid string, start long, end long")
    placed, lost = FT.place_in_hierarchy(df)
    parent = dict(rows)
    has = lambda i: i in parent and (parent[i] is None or has(parent[i]))
    chain = lambda i: [] if i is None else [*chain(parent[i]), i]
    assert {r.id: [x.id for x in r.path] for r in placed.collect()} == {i: chain(i) for i, _ in rows if has(i)}
    assert {r.id for r in lost.collect()} == {i for i, _ in rows if not has(i)}
    assert lost.rdd.getNumPartitions() > 4  # the session's partitions


def test_row_numbers_in_a_given_number_of_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = R.global_row_number(df, ["x"], "n", 9)
    assert {(r.x, r.n) for r in got.collect()} == {(i, i + 1) for i in range(1000)}


def test_bases_of_single_parts_move_once(spark):
    rng = np.random.default_rng(3)
    whole = "".join(rng.choice(list("ACGT"), 500))
    rows = [(f"x{i}", int(s), int(s + n), "+-"[i % 2]) for i, (s, n) in enumerate(zip(rng.integers(0, 505, 300), rng.integers(1, 200, 300)))]
    rows += [("two", 10, 20, "-"), ("two", 40, 95, "-"), ("pair", 480, 490, "+"), ("pair", 492, 498, "+")]
    parts = spark.createDataFrame([(i, "c", s, e, d) for i, s, e, d in rows], "id string, chrom string, start long, end long, strand string")
    turn = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    held = FT._tiles(spark.createDataFrame([("c", whole)], "chrom string, seq string"), 64, 64)
    assert {r.tile: r.bases for r in held.collect()} == {t: whole[t * 64 : t * 64 + 128] for t in range(8)}
    for tile in (7, 64):
        got = FT.extract_sequences(parts, spark.createDataFrame([("c", whole)], "chrom string, seq string"), tile=tile, ext3=25)
        seqs = {r.id: r.seq for r in got.collect()}
        assert seqs["two"] == turn(whole[0:10] + whole[10:20] + whole[40:95]) and seqs["pair"] == whole[480:490] + whole[492:498] + whole[498:523]
        assert all(seqs[i] == (turn(whole[max(s - 25, 0) : e]) if d == "-" else whole[s : e + 25]) for i, s, e, d in rows if i in seqs and i[0] == "x")
        assert set(seqs) >= {i for i, s, e, d in rows if s < 500}
