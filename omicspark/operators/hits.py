"""Alignment hits (query, hit, bits, evalue): best, near-best, reciprocal and exclusive ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omicspark.operators.intervals import overlap_join
from omicspark.storage import dealt, materialize, parts_of


def self_scores(hits: DataFrame) -> DataFrame:
    """(query, bits, evalue) of each query against itself, the best of several; 0 and 1 where it has none."""
    own = hits.where("query = hit").groupBy("query").agg(F.max("bits").alias("bits"), F.min("evalue").alias("evalue"))
    return hits.select("query").distinct().join(own, "query", "left").select("query", F.coalesce("bits", F.lit(0.0)).alias("bits"), F.coalesce("evalue", F.lit(1.0)).alias("evalue"))


def near_best_hits(hits: DataFrame, ratio: float, reverse: DataFrame | None = None) -> DataFrame:
    """Hits with at least ``ratio`` of their query's best score; ``is_rbh``: ``reverse`` has the pair the other way round."""
    held = materialize(hits, "hits")
    parts = parts_of(held.count())
    by_query = held.repartition(parts, "query")
    best = by_query.groupBy("query").agg(F.max("bits").alias("__best"))
    near = by_query.join(best.hint("shuffle_hash"), "query").where(F.col("bits") >= ratio * F.col("__best")).drop("__best")
    if reverse is None:
        return near.withColumn("is_rbh", F.lit(False))
    back = reverse.select(F.col("hit").alias("query"), F.col("query").alias("hit"), F.lit(True).alias("__back")).repartition(parts, "query", "hit").distinct()
    return near.repartition(parts, "query", "hit").join(back.hint("shuffle_hash"), ["query", "hit"], "left").withColumn("is_rbh", F.coalesce("__back", F.lit(False))).drop("__back")


def top_hits(hits: DataFrame, max_evalue: float = float("inf")) -> DataFrame:
    """Each query's best hit: most bits, then lowest e-value, then name; rows without bits don't count. One aggregate, over rows dealt by query."""
    best = F.min_by(F.struct("hit", "bits", "evalue"), F.struct(-F.col("bits"), "evalue", "hit"))
    known = hits.where((F.col("evalue") <= max_evalue) & F.col("bits").isNotNull())
    return dealt(known.select("query", "hit", "bits", "evalue"), "known", "query").groupBy("query").agg(best.alias("b")).select("query", "b.hit", "b.bits", "b.evalue")


def best_hit(hits: DataFrame, self_q: DataFrame, self_s: DataFrame, threshold: float, max_evalue: float, tolerance: float = 2.0, first_hit_free: bool = True) -> DataFrame:
    """(query, hit, bits, class): hits within ``tolerance`` bits of their query's best, by their share of the self scores.

    Class ``==``: at least the threshold of both; ``=~``: of the subject's;
    ``~=``: of the query's. A query's first hit is taken without a threshold, as
    ``~~`` where it has none of these, unless first_hit_free is False.
    """
    used = hits.where(F.col("evalue") <= max_evalue)
    place = F.struct((-F.col("bits")).alias("b"), F.col("evalue").alias("e"), F.col("hit").alias("h"))
    best = used.groupBy("query").agg(F.max("bits").alias("__best"), F.min(place).alias("__first"))
    near = used.join(best, "query").where(F.col("bits") >= F.col("__best") - tolerance)
    scored = near.join(self_q.select("query", F.col("bits").alias("__q")), "query", "left").join(self_s.select(F.col("query").alias("hit"), F.col("bits").alias("__s")), "hit", "left")
    of_q = F.coalesce(F.col("bits") >= threshold * F.col("__q"), F.lit(False))
    of_s = F.coalesce(F.col("bits") >= threshold * F.col("__s"), F.lit(False))
    kind = F.when(of_q & of_s, "==").when(of_s, "=~").when(of_q, "~=")
    ranked = scored.withColumn("class", kind)
    if first_hit_free:
        ranked = ranked.withColumn("class", F.coalesce("class", F.when(place == F.col("__first"), "~~")))
    return ranked.where("class IS NOT NULL").select("query", "hit", "bits", "class")


def settle_by_overlap(best: DataFrame, loc_q: DataFrame, loc_s: DataFrame, min_frac: float = 0.7) -> DataFrame:
    """Best hits (query, hit, ...) with ``settled``; of a query with several, those that overlap it the most stay.

    loc_q, loc_s (name, chrom, start, end, strand): where queries and hits lie. Only
    overlaps on one strand of at least min_frac of both count; ties stay, and where
    there is no such overlap all stay, not settled. Only places of a query and of its own
    hits meet, not all that lie on one chromosome.
    """
    asked = best.select("query", "hit").distinct()
    own = lambda loc, end: asked.join(loc.where("chrom IS NOT NULL").withColumnRenamed("name", end), end).select("query", "hit", F.struct("query", "hit", "chrom").alias("chrom"), "start", "end", "strand")
    pairs = overlap_join(own(loc_q, "query"), own(loc_s, "hit"), same_strand=True, min_frac=min_frac, reciprocal=True)
    met = pairs.groupBy(F.col("a_query").alias("query"), F.col("a_hit").alias("hit")).agg(F.max("overlap").alias("__overlap"))
    each = best.join(met, ["query", "hit"], "left")
    told = each.join(each.groupBy("query").agg(F.count("*").alias("__n"), F.max("__overlap").alias("__most")), "query")
    stay = told.where((F.col("__n") == 1) | F.col("__most").isNull() | (F.col("__overlap") == F.col("__most")))
    return stay.select(*best.columns, ((F.col("__n") == 1) | F.col("__most").isNotNull()).alias("settled"))


def ranked_hits(hits: DataFrame) -> DataFrame:
    """(query, hits array): the names of each query's hits, most bits first, equal ones by name."""
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("bits")).alias("b"), "hit")))
    return dealt(hits.select("query", "hit", "bits"), "hits", "query").groupBy("query").agg(F.transform(ranked, lambda x: x["hit"]).alias("hits"))


def mark_reciprocal(relations: DataFrame) -> DataFrame:
    """Relations (qdb, query, sdb, hits array) with ``marked``: each hit, with ``*`` if its own relation names the query. Tasks get a number of hits, not a share of them."""
    rows = materialize(relations.select("qdb", "query", "sdb", F.posexplode("hits").alias("at", "hit")), "relations")
    parts, pair, own = parts_of(rows.count()), ["qdb", "query", "sdb", "hit"], ["qdb", "query", "sdb"]
    back = rows.select(F.col("sdb").alias("qdb"), F.col("hit").alias("query"), F.col("qdb").alias("sdb"), F.col("query").alias("hit"), F.lit("*").alias("mark")).repartition(parts, *pair).distinct()
    marked = rows.repartition(parts, *pair).join(back.hint("shuffle_hash"), pair, "left").repartition(parts, *own)
    entry = F.struct("at", F.concat("hit", F.coalesce("mark", F.lit(""))).alias("hit"))
    return marked.groupBy(*own).agg(F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["hit"]), ";").alias("marked"))


def exclusive_pairs(hits: DataFrame, min_bits: float, max_evalue: float) -> DataFrame:
    """Best hits of queries and hits that are in no reciprocal pair (is_rbh), where no other query has the same best."""
    sure = hits.where("is_rbh")
    free = hits.where(~F.col("is_rbh") & (F.col("bits") >= min_bits) & (F.col("evalue") <= max_evalue))
    free = free.join(sure.select("query").distinct(), "query", "left_anti").join(sure.select("hit").distinct(), "hit", "left_anti")
    best = top_hits(free)
    alone = best.groupBy("hit").agg(F.count("*").alias("n")).where("n = 1").select("hit")
    return best.join(alone, "hit", "left_semi").select("query", "hit", "bits", "evalue")


def relation_table(rna: DataFrame, protein: DataFrame, protein_of: DataFrame) -> DataFrame:
    """(qdb, sdb, query, rna, protein): ``id[class];...`` of RNA and protein hits side by side. protein_of (protein, query)."""

    def told(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("qdb", "sdb", "query").agg(F.array_join(F.array_sort(F.collect_list(F.concat("hit", F.lit("["), "class", F.lit("]")))), ";").alias(name))

    mapped = protein.withColumnRenamed("query", "protein").join(protein_of, "protein").drop("protein")
    both = told(rna, "rna").join(told(mapped, "protein"), ["qdb", "sdb", "query"], "full")
    return both.select("qdb", "sdb", "query", F.coalesce("rna", F.lit("")).alias("rna"), F.coalesce("protein", F.lit("")).alias("protein"))
