"""How the operators' inputs are made from the star-schema tables, for Spark and as SQL with the same rows.

SQL texts here run on both engines unless two are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Texts as reads: bases from a digest of the text, so copies have equal bases; qualities from the id.
READS = """SELECT concat('r', CAST(doc_id AS STRING)) AS read_id,
 translate(md5(text), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
 translate(md5(concat('q', CAST(doc_id AS STRING))), '0123456789abcdef', '#+05:?ABCDEFGHIJ') AS qual,
 source AS descr FROM documents"""

# Mates: lines 1 and 2 of an order, one row each.
MATES = """SELECT concat('p', CAST(l_orderkey AS STRING), '/', CAST(l_linenumber AS STRING)) AS read_id, l_linenumber AS mate,
 translate(md5(CAST(min(l_partkey) AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
 translate(md5(CAST(min(l_suppkey) AS STRING)), '0123456789abcdef', '#+05:?ABCDEFGHIJ') AS qual
 FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY l_orderkey, l_linenumber"""

# Line items as intervals on their supplier: from the day shipped, a day for each piece.
_DAYS = {"spark": "unix_date(CAST(l_shipdate AS DATE))", "duckdb": "CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS INTEGER)"}


def intervals(engine: str, where: str) -> str:
    day = f"CAST({_DAYS[engine]} AS BIGINT)"
    return f"""SELECT concat('s', CAST(l_suppkey AS STRING)) AS chrom, {day} AS start, {day} + CAST(l_quantity AS BIGINT) AS "end",
 l_linestatus AS strand, concat(CAST(l_orderkey AS STRING), '.', CAST(l_linenumber AS STRING), '.', CAST(l_partkey AS STRING)) AS name
 FROM lineitem WHERE {where}"""


# Sums by supplier and part as alignment hits of query and subject.
HITS = """SELECT concat('n', CAST(l_suppkey AS STRING)) AS query, concat('n', CAST(l_partkey AS STRING)) AS hit,
 CAST(sum(l_quantity) AS DOUBLE) AS bits, min(l_discount) AS evalue FROM lineitem GROUP BY l_suppkey, l_partkey"""

# Quantities by part and sample as counts.
COUNTS = """SELECT concat('f', CAST(l_partkey AS STRING)) AS feature, concat(l_returnflag, l_linestatus) AS sample, sum(l_quantity) AS value
 FROM lineitem GROUP BY concat('f', CAST(l_partkey AS STRING)), concat(l_returnflag, l_linestatus)"""

# Regions, nations and customers as a taxonomy.
NODES = """SELECT CAST(1 AS BIGINT) AS taxid, CAST(1 AS BIGINT) AS parent
 UNION ALL SELECT CAST(r_regionkey + 10 AS BIGINT), CAST(1 AS BIGINT) FROM region
 UNION ALL SELECT CAST(n_nationkey + 100 AS BIGINT), CAST(n_regionkey + 10 AS BIGINT) FROM nation
 UNION ALL SELECT CAST(c_custkey + 1000 AS BIGINT), CAST(c_nationkey + 100 AS BIGINT) FROM customer"""

CLOSURE_SQL = """SELECT taxid AS ancestor, taxid AS descendant, 0 AS depth FROM nodes
 UNION ALL SELECT parent, taxid, 1 FROM nodes WHERE parent <> taxid
 UNION ALL SELECT p.parent, n.taxid, 2 FROM nodes n JOIN nodes p ON n.parent = p.taxid WHERE n.parent <> n.taxid AND p.parent <> p.taxid
 UNION ALL SELECT g.parent, n.taxid, 3 FROM nodes n JOIN nodes p ON n.parent = p.taxid JOIN nodes g ON p.parent = g.taxid
   WHERE n.parent <> n.taxid AND p.parent <> p.taxid AND g.parent <> g.taxid"""

# Orders and their lines as genes and their parts.
def features(engine: str) -> str:
    day = f"CAST({_DAYS[engine]} AS BIGINT)"
    order_day = day.replace("l_shipdate", "o_orderdate")
    return f"""SELECT concat('g', CAST(o_orderkey AS STRING)) AS id, CAST(NULL AS STRING) AS parent, concat('c', CAST(o_custkey % 50 AS STRING)) AS seqid,
 {order_day} AS start, {order_day} + 100 AS "end", o_orderstatus AS strand, 'gene' AS type FROM orders WHERE o_orderkey % 10 <> 3
 UNION ALL SELECT concat('x', CAST(l_orderkey AS STRING), '.', CAST(l_linenumber AS STRING)), concat('g', CAST(l_orderkey AS STRING)), concat('c', CAST(max(l_partkey) % 50 AS STRING)),
 min({day}), min({day}) + 10, min(l_linestatus), CASE WHEN l_linenumber = 1 THEN 'mRNA' WHEN l_linenumber = 2 THEN 'tRNA' ELSE 'exon' END FROM lineitem GROUP BY l_orderkey, l_linenumber"""


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A binding over the tables that it names."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "benchmark")
    import re

    used = [n for n in names if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", sql)]
    text = re.sub(r'"end"', "`end`", sql)
    for n in used:
        text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in used})
