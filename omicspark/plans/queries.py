"""Registered queries of the library's own operators, each with DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omicspark.functions import sequences as X
from omicspark.functions import text as XT
from omicspark.operators import expression as E
from omicspark.operators import features as FT
from omicspark.operators import graphs as G
from omicspark.operators import haplotypes as HP
from omicspark.operators import hits as H
from omicspark.operators import intervals as I
from omicspark.operators import kmers as K
from omicspark.operators import modules as M
from omicspark.operators import ranks as R
from omicspark.operators import reads as RD
from omicspark.operators import tables as TB
from omicspark.operators import taxa as TX
from omicspark.plans import bindings as B
from omicspark.plans.bindings import run, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _r(col, n: int = 6):
    return F.round(F.col(col) if isinstance(col, str) else col, n)


# --- column functions -------------------------------------------------------


@query(f"SELECT read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM ({B.READS})")
def x1_revcomp(spark, sf):
    return run(spark, sf, B.READS).select("read_id", X.revcomp("seq").alias("rc"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def x2_split_rows(spark, sf):
    return TB.split_rows(table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("word")), "word", " ")


@query(f"SELECT read_id, list_sum([ascii(c) - 33 FOR c IN string_split(qual, '')])::BIGINT AS total FROM ({B.READS})")
def x3_phred(spark, sf):
    return run(spark, sf, B.READS).select("read_id", F.aggregate(X.phred("qual"), F.lit(0).cast("bigint"), lambda n, q: n + q).alias("total"))


@query(f"SELECT read_id, array_to_string([greatest(substr(qual, i, 1), substr(reverse(qual), i, 1)) FOR i IN range(1, 33)], '') AS best FROM ({B.READS})")
def x4_max_quality(spark, sf):
    return run(spark, sf, B.READS).select("read_id", X.max_quality("qual", F.reverse("qual")).alias("best"))


@query(r"""SELECT p_partkey, p_brand AS brand, 'ID=' || p_brand || ';Note=new' AS changed, 'Name=' || p_name || ';ID=' || p_brand || ';Note=x' AS added FROM part""")
def x5_attributes(spark, sf):
    a = F.concat(F.lit("ID="), "p_brand", F.lit(";Note="), "p_type")
    b = F.concat(F.lit("Name="), "p_name", F.lit(";ID="), "p_brand")
    df = table(spark, sf, "part").withColumns({"a": a, "b": b})
    return df.select("p_partkey", XT.attribute("a", "ID").alias("brand"), XT.set_attribute("a", "Note", F.lit("new")).alias("changed"), XT.set_attribute("b", "Note", F.lit("x")).alias("added"))


@query(r"""SELECT p_partkey, coalesce(nullif(regexp_extract(p_brand, '^Brand#?(\d)', 1), ''), p_brand) AS xref FROM part""")
def x6_xref(spark, sf):
    return table(spark, sf, "part").select("p_partkey", XT.xref_id("p_brand", [r"^Brand#?(\d)"]).alias("xref"))


@query("SELECT p_partkey, coalesce('k__' || p_type, '') || '; p__' || p_brand || '; c__; o__; f__; g__' || p_name || '; s__; t__' AS lineage FROM part")
def x8_format_lineage(spark, sf):
    return table(spark, sf, "part").select("p_partkey", XT.format_lineage(F.array(F.lit("k"), F.lit("p"), F.lit("g")), F.array("p_type", "p_brand", "p_name")).alias("lineage"))


@query("SELECT o_orderkey, to_base(o_orderkey, 36) AS b36, lpad(CAST(o_orderkey AS STRING), 10, '0') AS padded FROM orders")
def x9_bases(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.to_base("o_orderkey").alias("b36"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("padded"))


@query("""WITH lengths AS (SELECT DISTINCT CAST(o_orderkey % 250 + 1 AS INTEGER) AS length FROM orders),
 sums AS (SELECT length, k, sum(exp(-0.02 * length + i * ln(0.02 * length) - lgamma(i + 1))) AS p FROM lengths, range(1, 60) a(k), range(0, 60) b(i) WHERE i <= k GROUP BY length, k)
 SELECT length, greatest(min(k), 2)::INTEGER AS k FROM sums WHERE 1 - p < 0.04 GROUP BY length""")
def x10_max_mismatches(spark, sf):
    lengths = table(spark, sf, "orders").select((F.col("o_orderkey") % 250 + 1).cast("int").alias("length")).distinct()
    return lengths.select("length", X.max_mismatches("length").alias("k"))


@query(r"SELECT p_partkey, p_name || 'x' AS plain FROM part")
def x11_strip_parens(spark, sf):
    text = F.concat("p_name", F.lit("("), "p_brand", F.lit("(a)(b(c))"), F.lit(")x"))
    return table(spark, sf, "part").select("p_partkey", XT.strip_parens(text).alias("plain"))


@query(r"""WITH f AS (SELECT doc_id, translate(md5(text), '0123456789abcdef', '((((((.......)))') AS fold FROM documents),
 s AS (SELECT doc_id, substr(fold, 3, 12) AS part FROM f), n AS (SELECT doc_id, length(replace(replace(part, ')', ''), '.', '')) AS o, length(replace(replace(part, '(', ''), '.', '')) AS c FROM s)
 SELECT doc_id, CASE WHEN o > c THEN '5p' WHEN c > o THEN '3p' END AS arm FROM n""")
def x12_arm(spark, sf):
    fold = F.translate(F.md5("text"), "0123456789abcdef", "((((((.......)))")
    return table(spark, sf, "documents").select("doc_id", X.arm_of(fold, F.lit(3), F.lit(12)).alias("arm"))


@query(f"""SELECT name, least(greatest(CASE WHEN strand = 'F' THEN "end" ELSE start - 40 END, 0), 11000) AS p_start, least(greatest(CASE WHEN strand = 'F' THEN "end" + 40 ELSE start END, 0), 11000) AS p_end FROM ({B.intervals('duckdb', "l_returnflag = 'R'")})""")
def x13_promoter(spark, sf):
    df = run(spark, sf, B.intervals("spark", "l_returnflag = 'R'")).withColumn("strand", F.when(F.col("strand") == "F", "-").otherwise("+"))
    low, high = XT.promoter_span("start", "end", "strand", 40, F.lit(11000).cast("bigint"))
    return df.select("name", low.alias("p_start"), high.alias("p_end"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS v FROM events")
def x17_json(spark, sf):
    return table(spark, sf, "events").select("event_id", XT.json_get("props", "$.k").alias("v"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <= 0.05 AND l_tax - 0.04 >= 0.02 THEN 'Up' WHEN l_discount <= 0.05 AND l_tax - 0.04 <= -0.02 THEN 'Down' ELSE 'Not DEG' END AS label FROM lineitem")
def x18_regulation(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", XT.regulation("l_discount", F.col("l_tax") - 0.04, 0.05, 0.02).alias("label"))


@query("SELECT doc_id, source || '_' || lang AS sample FROM documents")
def x19_sample_of(spark, sf):
    return table(spark, sf, "documents").select("doc_id", XT.sample_of(F.concat(F.lit("/data/run/"), "source", F.lit("_"), "lang", F.lit("_R1.fastq.gz"))).alias("sample"))


@query("UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem) ON l_quantity, l_tax INTO NAME variable VALUE value")
def x21_melt(spark, sf):
    return TB.melt(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"), ["l_orderkey", "l_linenumber"])


@query("SELECT l_suppkey AS gene, bool_and(CAST(l_partkey AS STRING) LIKE '1%') AS novel FROM lineitem GROUP BY l_suppkey")
def x22_novel_loci(spark, sf):
    return FT.novel_loci(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("gene"), F.col("l_partkey").cast("string").alias("tx")), "1")


@query("SELECT p_partkey, CASE WHEN regexp_matches(p_type, 'ECO') THEN 'low' WHEN regexp_matches(p_type, '^P') THEN 'high' ELSE 'rest' END AS label FROM part")
def x23_relabel(spark, sf):
    return table(spark, sf, "part").select("p_partkey", XT.relabel("p_type", [("ECO", "low"), ("^P", "high")], "rest").alias("label"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'r' || doc_id || '/1' ELSE 'r' || doc_id || '/1' END AS id FROM documents")
def x24_mate_suffix(spark, sf):
    name = F.concat(F.lit("r"), F.col("doc_id").cast("string"))
    return table(spark, sf, "documents").select("doc_id", X.mate_suffix(F.when(F.col("doc_id") % 3 == 0, F.concat(name, F.lit("/1"))).otherwise(name), 1).alias("id"))


# --- tables -------------------------------------------------------------------

_LINEAGE = "SELECT concat('k__', p_type, '; p__', p_brand, '; c__', p_name) AS lineage, l_returnflag, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey"


@query(f"""WITH w AS (SELECT lineage, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS a, coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0) AS n, coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS r FROM ({_LINEAGE}) GROUP BY lineage),
 p AS (SELECT array_to_string(list_slice(string_split(lineage, '; '), 1, d), '; ') AS lineage, d::INTEGER AS depth, a, n, r FROM w, range(1, 4) t(d))
 SELECT lineage, depth, sum(a) AS a, sum(n) AS n, sum(r) AS r, sum(a) + sum(n) + sum(r) AS total FROM p GROUP BY lineage, depth""")
def a5_rollup_lineage(spark, sf):
    rows = run(spark, sf, _LINEAGE)
    wide = rows.groupBy("lineage").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity")).fillna(0).toDF("lineage", "a", "n", "r")
    return TB.rollup_lineage(wide, "lineage", ["a", "n", "r"])


@query(f"SELECT feature, coalesce(sum(value) FILTER (sample = 'AF'), 0) AS \"AF\", coalesce(sum(value) FILTER (sample = 'NO'), 0) AS \"NO\", coalesce(sum(value) FILTER (sample = 'RF'), 0) AS \"RF\" FROM ({B.COUNTS}) GROUP BY feature")
def a6_matrix(spark, sf):
    return TB.to_matrix(run(spark, sf, B.COUNTS), "feature", "sample", "value", ["AF", "NO", "RF"])


@query("""WITH e AS (SELECT l_returnflag || l_linestatus AS a, 'q' AS x, l_suppkey % 4 AS i, l_partkey % 4 AS j, l_quantity AS v FROM lineitem),
 p AS (SELECT i, j, max(v) AS v FROM (SELECT i, j, v FROM e WHERE i < j UNION ALL SELECT j, i, v FROM e WHERE i < j) GROUP BY i, j)
 SELECT 'n' || i AS name, coalesce(max(v) FILTER (j = 0), 0) AS n0, coalesce(max(v) FILTER (j = 1), 0) AS n1, coalesce(max(v) FILTER (j = 2), 0) AS n2, coalesce(max(v) FILTER (j = 3), 0) AS n3 FROM p GROUP BY i""")
def a7_symmetric_matrix(spark, sf):
    e = table(spark, sf, "lineitem").where("l_suppkey % 4 < l_partkey % 4").select(F.concat(F.lit("n"), (F.col("l_suppkey") % 4).cast("string")).alias("a"), F.concat(F.lit("n"), (F.col("l_partkey") % 4).cast("string")).alias("b"), "l_quantity")
    return TB.symmetric_matrix(e, "a", "b", "l_quantity", ["n0", "n1", "n2", "n3"])


@query("SELECT l_partkey, sum(l_quantity) AS s1, sum(l_linenumber)::DOUBLE AS s2 FROM lineitem GROUP BY l_partkey")
def a4_sum_counts(spark, sf):
    df = table(spark, sf, "lineitem").select("l_partkey", F.col("l_quantity").alias("s1"), F.col("l_linenumber").alias("s2"), F.col("l_tax").alias("s1(norm)"), F.lit(1).alias("total"))
    return TB.sum_counts(df, "l_partkey")


@query("SELECT c_nationkey, string_agg(c_mktsegment, ';' ORDER BY c_mktsegment) AS c_mktsegment, string_agg(k, ';' ORDER BY k) AS k FROM (SELECT DISTINCT c_nationkey, c_mktsegment, CAST(c_custkey % 3 AS STRING) AS k FROM customer) GROUP BY c_nationkey")
def a3_aggregate_concat(spark, sf):
    return TB.aggregate_concat(table(spark, sf, "customer").select("c_nationkey", "c_mktsegment", (F.col("c_custkey") % 3).alias("k")), "c_nationkey")


@query("SELECT c_custkey, c_name AS \"name.x\", n_name AS \"name.y\" FROM customer FULL JOIN nation ON c_custkey = n_nationkey".replace("SELECT c_custkey,", "SELECT coalesce(c_custkey, n_nationkey) AS c_custkey,"))
def j1_merge_tables(spark, sf):
    x = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"))
    y = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), F.col("n_name").alias("name"))
    return TB.merge_tables(x, y, "c_custkey", "n_nationkey", all_x=True, all_y=True)


@query("SELECT c_custkey, coalesce(p, '') AS priority FROM customer LEFT JOIN (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS p FROM orders WHERE o_orderkey % 5 = 0 GROUP BY o_custkey) ON c_custkey = o_custkey")
def j2_annotate(spark, sf):
    return TB.annotate(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").where("o_orderkey % 5 = 0"), "c_custkey", "o_custkey", "o_orderpriority", "priority", "o_orderkey")


@query("SELECT c_custkey AS k, true AS kept FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT l_partkey, false FROM lineitem WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)".replace("IN (SELECT o_custkey FROM orders)", "IN (SELECT l_partkey FROM lineitem)"))
def f1_select_ids(spark, sf):
    kept, missing = TB.select_ids(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "lineitem").select("l_partkey"), "c_custkey", "l_partkey")
    return kept.select(F.col("c_custkey").alias("k"), F.lit(True).alias("kept")).unionByName(missing.select(F.col("c_custkey").alias("k"), F.lit(False).alias("kept")))


@query("SELECT p_partkey, n_name AS matched_id FROM part JOIN (SELECT DISTINCT left(p_type, 3) AS n_name FROM part) ON regexp_matches(p_type, '^' || n_name || '.*')")
def f2_select_by_template(spark, sf):
    ids = table(spark, sf, "part").select(F.left("p_type", F.lit(3)).alias("id")).distinct()
    return TB.select_by_template(table(spark, sf, "part").select("p_partkey", "p_type"), ids, "p_type", "^$id.*").select("p_partkey", "matched_id")


@query("SELECT doc_id FROM documents WHERE contains('group_' || lpad(CAST(doc_id % 20 AS STRING), 5, '0') || '_' || lang, '00007') AND lang IN ('en', 'fr')")
def f3_select_group(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("group_"), F.lpad((F.col("doc_id") % 20).cast("string"), 5, "0"), F.lit("_"), "lang").alias("header"))
    return TB.select_group(df, "header", 7, ["en$", "fr$"]).select("doc_id")


@query("SELECT DISTINCT l_suppkey AS chrom, l_partkey AS start, l_orderkey AS \"end\", CASE l_linenumber WHEN 1 THEN '+' WHEN 2 THEN '-' ELSE '.' END AS strand FROM lineitem WHERE l_quantity >= 20")
def f4_filter_junctions(spark, sf):
    df = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("start"), F.col("l_orderkey").alias("end"), F.col("l_linenumber").alias("strand"), F.col("l_quantity").alias("reads"))
    return FT.filter_junctions(df, 20)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linestatus = 'O' AND abs(l_tax - 0.04) >= 0.02 AND l_discount <= 0.04 AND (l_quantity >= 40 OR l_extendedprice >= 60000)")
def f5_filter_deg(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linestatus") == "O", "OK").otherwise("NOTEST").alias("status"), (F.col("l_tax") - 0.04).alias("log2_fold"), F.col("l_discount").alias("q_value"), F.when(F.col("l_quantity") >= 40, 1).otherwise(0).alias("value_1"), F.when(F.col("l_extendedprice") >= 60000, 1).otherwise(0).alias("value_2"))
    return E.filter_deg(df, 0.02, 0.04, 1).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_discount <= 0.01 OR l_tax <= 0.01) AND (abs(l_quantity - 25) >= 20 OR abs(l_linenumber - 4) >= 3)")
def f6_filter_any(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({"d1": F.col("l_quantity") - 25, "d2": F.col("l_linenumber") - 4.0})
    df = df.withColumn("d2", F.when(F.abs("d2") >= 3, 20.0).otherwise(0.0))
    return E.filter_any(df, ["l_discount", "l_tax"], ["d1", "d2"], 0.01, 20).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity + l_linenumber > 50")
def f7_filter_min_sum(spark, sf):
    return E.filter_min_sum(table(spark, sf, "lineitem"), ["l_quantity", "l_linenumber"], 50).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"WITH c AS ({B.COUNTS}), t AS (SELECT sample, sum(value) AS t FROM c GROUP BY sample), k AS (SELECT feature FROM c JOIN t USING (sample) GROUP BY feature HAVING count(*) FILTER (value * 1e6 / t > 100) >= 2) SELECT c.* FROM c SEMI JOIN k USING (feature)")
def f8_filter_expressed(spark, sf):
    return E.filter_expressed(run(spark, sf, B.COUNTS), cpm=100, k=2)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount <= 0.03 AND -l_quantity <= -20")
def f9_filter_targets(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({"pvalue": F.col("l_discount"), "energy": -F.col("l_quantity")})
    return E.filter_targets(df, 0.03, -20).select("l_orderkey", "l_linenumber", "l_partkey")


_DUPLEX = """SELECT doc_id, translate(md5(text), '0123456789abcdef', 'ACGUACGUACGUACG-') AS t, translate(md5(concat(text, 'x')), '0123456789abcdef', 'ACGUACGUACGUACG ') AS q FROM documents"""


@query(f"""WITH d AS ({_DUPLEX}), r AS (SELECT doc_id, reverse(t) AS t, reverse(q) AS q FROM d)
 SELECT doc_id FROM r WHERE len([i FOR i IN range(2, 5) IF substr(t, i, 1) IN (' ', '-') OR substr(q, i, 1) IN (' ', '-') OR substr(t, i, 1) || substr(q, i, 1) IN ('GU', 'UG')]) = 0""")
def f10_filter_seed_gu(spark, sf):
    return E.filter_seed_gu(run(spark, sf, _DUPLEX), "t", "q", 2, 4).select("doc_id")


@query("SELECT l_suppkey AS target, l_quantity AS score, l_linenumber AS mirna, max(l_partkey) AS sites FROM lineitem WHERE l_quantity <= 10 GROUP BY ALL")
def f11_filter_score(spark, sf):
    df = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("target"), F.col("l_quantity").alias("score"), F.col("l_linenumber").alias("mirna"), F.col("l_partkey").alias("sites"))
    return E.filter_score(df, 10)


@query(f"SELECT id, type FROM ({B.features('duckdb')}) WHERE type NOT IN ('exon', 'tRNA')")
def f12_filter_features(spark, sf):
    return FT.filter_features(run(spark, sf, B.features("spark")), ["exon", "tRNA"]).select("id", "type")


@query("SELECT l_linenumber AS lane, l_orderkey, l_discount * 10 AS rf, 'L' || l_linenumber AS name FROM lineitem WHERE l_discount * 10 BETWEEN 0.1 AND 0.9 AND l_linenumber < 4".replace("l_discount * 10", "CAST(CAST(l_discount AS STRING) AS DOUBLE)"))
def f13_filter_lanes(spark, sf):
    df = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("lane"), "l_orderkey", F.replace(F.col("l_discount").cast("string"), F.lit("."), F.lit(",")).alias("rf"))
    lanes = spark.range(1, 4).select(F.col("id").cast("int").alias("lane"), F.concat(F.lit("L"), F.col("id").cast("string")).alias("name"))
    return M.filter_lanes(df, lanes).select("lane", "l_orderkey", "rf", "name")


@query("SELECT p_partkey FROM part WHERE NOT regexp_matches(p_type, 'ECO|^P')")
def f14_exclude_lineages(spark, sf):
    return M.exclude_lineages(table(spark, sf, "part"), "p_type", ["ECO", "^P"]).select("p_partkey")


@query("SELECT DISTINCT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -900)")
def u1_set_diff(spark, sf):
    return TB.set_diff(table(spark, sf, "nation"), table(spark, sf, "customer").where("c_acctbal < -900"), "n_nationkey", "c_nationkey")


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def u2_union_distinct(spark, sf):
    return TB.union_distinct(table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def w1_top1(spark, sf):
    return TB.top1(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")])


@query("SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 3")
def s3_limit_per_group(spark, sf):
    df = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return TB.limit_per_group(df, ["l_suppkey"], 3, [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")])


@query("""WITH s AS (SELECT l_returnflag AS g, p_brand AS c, sum(l_quantity) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
 t AS (SELECT DISTINCT c FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY g ORDER BY v DESC, c) <= 2))
 SELECT g, CASE WHEN c IN (SELECT c FROM t) THEN c ELSE 'other' END AS c, sum(v) AS v FROM s GROUP BY ALL""")
def s4_lump_other(spark, sf):
    df = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_returnflag").alias("g"), F.col("p_brand").alias("c"), F.col("l_quantity").alias("v"))
    return TB.lump_other(df, "g", "c", "v", 2)


@query("SELECT n_name, CASE regexp_extract('Group' || n_nationkey, '^Group(\\d+)$', 1) WHEN '' THEN NULL ELSE n_nationkey END AS k, n_nationkey + 1000 AS u FROM nation")
def s2_natural_chrom_key(spark, sf):
    n = F.col("n_nationkey").cast("string")
    return table(spark, sf, "nation").select("n_name", XT.natural_chrom_key(F.concat(F.lit("Group"), n)).alias("k"), XT.natural_chrom_key(F.concat(F.lit("GroupUn"), n)).alias("u"))


@query("""WITH r AS (SELECT l_partkey AS item, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS l, l_tax - 0.04 AS fold FROM lineitem)
 SELECT item, max((l = 0)::INT) || ';' || max((l = 1)::INT) || ';' || max((l = 2)::INT) AS code, CASE WHEN bool_or(fold > 0) AND bool_or(fold <= 0) THEN 'contra' WHEN bool_or(fold > 0) THEN 'up' ELSE 'down' END AS direction FROM r GROUP BY item""")
def a23_venn_membership(spark, sf):
    df = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item"), (F.col("l_tax") - 0.04).alias("fold"), "l_returnflag")
    return TB.venn_membership([(f, df.where(F.col("l_returnflag") == f)) for f in "ANR"])


@query("SELECT 'all' AS stage, count(*) AS n FROM lineitem UNION ALL SELECT 'open', count(*) FROM lineitem WHERE l_linestatus = 'O'")
def a28_stage_counts(spark, sf):
    df = table(spark, sf, "lineitem")
    return TB.stage_counts([("all", df), ("open", df.where("l_linestatus = 'O'"))])


@query(f"SELECT read_id, seq, qual, descr FROM ({B.READS}) ORDER BY md5(read_id || '|1'), read_id LIMIT 100")
def r19_sample_rows(spark, sf):
    return TB.sample_rows(run(spark, sf, B.READS), 100, "read_id")


# --- ranks and rates -----------------------------------------------------------


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS n FROM orders")
def rank_global_row_number(spark, sf):
    return R.global_row_number(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "n").select("o_orderkey", "n")


_P = "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, CAST((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 1000003 + 1 AS DOUBLE) / 1000004 AS p FROM lineitem"


@query(f"""WITH x AS ({_P}), u AS (SELECT *, count(*) OVER (PARTITION BY l_returnflag) AS n, row_number() OVER (PARTITION BY l_returnflag ORDER BY p) AS r FROM x WHERE l_linestatus = 'O'),
 m AS (SELECT *, least(1.0, min(p * n / r) OVER (PARTITION BY l_returnflag ORDER BY p DESC, r DESC ROWS UNBOUNDED PRECEDING)) AS q FROM u)
 SELECT l_orderkey, l_linenumber, l_partkey, round(q, 9) AS q FROM m UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, NULL FROM x WHERE l_linestatus <> 'O'""")
def a14_bh_adjust(spark, sf):
    df = R.bh_adjust(run(spark, sf, _P), "p", ["l_returnflag"], F.col("l_linestatus") == "O", "q")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", _r("q", 9).alias("q"))


_P3 = "SELECT o_orderkey, CAST(o_orderkey * 7919 % 1009 + 1 AS DOUBLE) / 1010 AS p1, CAST(o_custkey * 104729 % 1009 + 1 AS DOUBLE) / 1010 AS p2, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey * 31 % 1009 + 1 AS DOUBLE) / 1010 END AS p3 FROM orders"


@query(f"""WITH x AS ({_P3}), l AS (SELECT o_orderkey, unnest(['p1', 'p2', 'p3']) AS c, unnest([p1, p2, p3]) AS p FROM x),
 u AS (SELECT *, count(*) OVER (PARTITION BY o_orderkey) AS n, row_number() OVER (PARTITION BY o_orderkey ORDER BY p) AS r FROM l WHERE p IS NOT NULL),
 m AS (SELECT *, round(least(1.0, min(p * n / r) OVER (PARTITION BY o_orderkey ORDER BY r DESC ROWS UNBOUNDED PRECEDING)), 9) AS q FROM u)
 SELECT o_orderkey, max(q) FILTER (c = 'p1') AS q1, max(q) FILTER (c = 'p2') AS q2, max(q) FILTER (c = 'p3') AS q3 FROM m GROUP BY o_orderkey""")
def a15_bh_across(spark, sf):
    cols = R.bh_across(["p1", "p2", "p3"])
    return run(spark, sf, _P3).select("o_orderkey", *[_r(c, 9).alias(f"q{i + 1}") for i, c in enumerate(cols)])
