"""Haplotype frequencies from genotypes (subject, pop, marker, a1, a2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omicspark.storage import bounded, free_name, materialize

BASES = "ACGT"
MOST_KNOWN = 100_000
MOST_UNKNOWN = 30
DIGITS = 6  # unknown bases that become rows at a time


def expand_unknown(haplotypes: DataFrame, col: str = "haplotype") -> DataFrame:
    """A row for each way to read the ``N`` of a string as a base.

    A way is a number with a digit in base 4 for each ``N``. It becomes rows DIGITS digits
    at a time, so no array holds more than 4^DIGITS numbers however many ways there are.
    Over MOST_UNKNOWN ``N`` in one string are an error.
    """
    n, way = free_name(haplotypes, "__n"), free_name(haplotypes, "__way")
    unknown = F.length(F.regexp_replace(col, "[^N]", ""))
    out = haplotypes.withColumn(n, F.when(unknown > MOST_UNKNOWN, F.raise_error(F.lit(f"over {MOST_UNKNOWN} N in a haplotype")).cast("int")).otherwise(F.coalesce(unknown, F.lit(0)))).withColumn(way, F.lit(0).cast("bigint"))
    for low in reversed(range(0, MOST_UNKNOWN, DIGITS)):  # most rows come last
        digits = F.expr(f"sequence(0L, shiftleft(1L, 2 * greatest(least(`{n}` - {low}, {DIGITS}), 0)) - 1)")
        out = out.withColumn(way, F.explode(F.transform(digits, lambda d: F.col(way) + F.shiftleft(d, 2 * low))))  # noqa: B023  (used at once)
    parts = F.split(F.col(col), "N", -1)
    base = lambda i: F.substring(F.lit(BASES), (F.call_function("shiftright", F.col(way), i * 2).bitwiseAND(F.lit(3)) + 1).cast("int"), F.lit(1))
    read = F.transform(F.slice(parts, 2, MOST_UNKNOWN + 1), lambda text, i: F.concat(base(i), text))
    return out.withColumn(col, F.concat(F.get(parts, F.lit(0)), F.array_join(read, ""))).drop(n, way)


def _read_unknown(weights: DataFrame) -> DataFrame:
    """Weights (pop, haplotype, weight) with haplotypes that hold ``N`` dealt to the ways to read them."""
    clear = weights.where(~F.contains("haplotype", F.lit("N")))
    open_ = weights.where(F.contains("haplotype", F.lit("N"))).withColumn("__from", F.col("haplotype"))
    ways = expand_unknown(open_)
    known = clear.select("pop", "haplotype", F.col("weight").alias("__known"))
    # A way counts 1 and what is known of it; all ways of a haplotype together 4^N and what is known of any.
    found = ways.join(known, ["pop", "haplotype"]).groupBy("pop", "__from").agg(F.sum("__known").alias("__found"))
    whole = F.pow(F.lit(4.0), F.length(F.regexp_replace("__from", "[^N]", "")))
    dealt = ways.join(known, ["pop", "haplotype"], "left").join(found, ["pop", "__from"], "left")
    dealt = dealt.withColumn("weight", F.col("weight") * (1 + F.coalesce("__known", F.lit(0.0))) / (whole + F.coalesce("__found", F.lit(0.0))))
    return clear.unionByName(dealt.select(*clear.columns)).groupBy("pop", "haplotype").agg(F.sum("weight").alias("weight"))


def haplotype_freq(genotypes: DataFrame, max_known: int = 1) -> DataFrame:
    """(pop, haplotype, weight, percent): of subjects with no heterozygous marker weight 2, with one 1 and 1.

    A haplotype with ``N`` is dealt to the ways to read it, each by 1 and what that
    population has of it for sure. Subjects with more take the most frequent haplotype known from all populations
    that fits their genotype, and its complement, 1 each; without one they count
    nothing. Frequencies used in a step are those before it, so order plays no part.
    Percent is of the population's weight. Distinct genotypes meet every known
    haplotype; over MOST_KNOWN of these are an error.
    """
    rows = genotypes.groupBy("subject", "pop").agg(F.sort_array(F.collect_list(F.struct("marker", "a1", "a2"))).alias("g"))
    read = rows.select("subject", "pop", "g", F.size(F.filter("g", lambda x: x["a1"] != x["a2"])).alias("het"), F.array_join(F.transform("g", lambda x: x["a1"]), "").alias("h1"), F.array_join(F.transform("g", lambda x: x["a2"]), "").alias("h2"))
    read = materialize(read, "haplotypes")
    sure = read.where(F.col("het") <= max_known).select("pop", F.explode(F.array("h1", "h2")).alias("haplotype")).groupBy("pop", "haplotype").agg(F.count("*").cast("double").alias("weight"))
    sure = materialize(_read_unknown(sure), "sure")
    known = bounded(sure.groupBy("haplotype").agg(F.sum("weight").alias("freq")), MOST_KNOWN, "known haplotypes")
    open_ = materialize(read.where(F.col("het") > max_known).select("subject", "pop", "g", "h1", "h2"), "open")
    # Each distinct genotype once, not each subject, meets the known haplotypes.
    kinds = open_.select("h1", "h2", "g").groupBy("h1", "h2").agg(F.first("g").alias("g"))
    pairs = kinds.join(F.broadcast(known), F.length("h1") == F.length("haplotype"))
    fits = ~F.exists(F.transform("g", lambda x, i: (F.substring(F.col("haplotype"), i + 1, F.lit(1)) != x["a1"]) & (F.substring(F.col("haplotype"), i + 1, F.lit(1)) != x["a2"])), lambda b: b)
    best = pairs.where(fits).groupBy("h1", "h2").agg(F.min(F.struct((-F.col("freq")).alias("f"), F.col("haplotype"))).alias("best"))
    chosen = open_.join(best.select("h1", "h2", "best.haplotype"), ["h1", "h2"])
    other = F.array_join(F.transform("g", lambda x, i: F.when(F.substring(F.col("haplotype"), i + 1, F.lit(1)) == x["a1"], x["a2"]).otherwise(x["a1"])), "")
    more = chosen.select("pop", F.explode(F.array("haplotype", other)).alias("haplotype")).groupBy("pop", "haplotype").agg(F.count("*").cast("double").alias("weight"))
    weights = sure.unionByName(more).groupBy("pop", "haplotype").agg(F.sum("weight").alias("weight"))
    total = weights.groupBy("pop").agg(F.sum("weight").alias("__t"))
    return weights.join(total, "pop").select("pop", "haplotype", "weight", (100 * F.col("weight") / F.col("__t")).alias("percent"))


def report_levels(freq: DataFrame, pops: DataFrame) -> DataFrame:
    """(lv_one, lv_two, pop, haplotype, weight) at three levels of populations (lv_one, lv_two, pop); a level summed over is null."""
    return freq.join(pops, "pop").groupingSets([["lv_one", "lv_two", "pop", "haplotype"], ["lv_one", "lv_two", "haplotype"], ["lv_one", "haplotype"]], "lv_one", "lv_two", "pop", "haplotype").agg(F.sum("weight").alias("weight"))
