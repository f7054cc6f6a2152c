"""Expression counts: normalisation, fold change, tests, filters, enrichment, distances."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T

from omicspark.operators.ranks import bh_adjust, exact_percentiles, global_row_number, keyed_permutation
from omicspark.operators.samples import euclidean_distance, js_distance, sample_pca  # noqa: F401
from omicspark.storage import bounded, materialize

MOST_SAMPLES = 1_000_000


def filter_deg(df: DataFrame, min_fold: float, max_q: float, min_value: float, ok_only: bool = True) -> DataFrame:
    """Rows (status, log2_fold, q_value, value_1, value_2) that differ enough, surely enough, from enough."""
    good = (F.abs("log2_fold") >= min_fold) & (F.col("q_value") <= max_q) & ((F.col("value_1") >= min_value) | (F.col("value_2") >= min_value))
    return df.where(good & (F.col("status") == "OK") if ok_only else good)


def filter_any(df: DataFrame, q_cols: list[str], fold_cols: list[str], max_q: float, min_fold: float) -> DataFrame:
    """Rows where some comparison is sure enough and some, maybe another, is large enough."""
    some = lambda tests: reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])
    return df.where(some(F.col(c) <= max_q for c in q_cols) & some(F.abs(F.col(c)) >= min_fold for c in fold_cols))


def filter_min_sum(df: DataFrame, cols: list[str], least: float) -> DataFrame:
    return df.where(reduce(lambda a, b: a + b, [F.col(c) for c in cols]) > least)


def filter_expressed(counts: DataFrame, min_sum: float | None = None, cpm: float | None = None, k: int = 1) -> DataFrame:
    """Counts (feature, sample, value) of features with a sum of at least min_sum, or more than ``cpm`` per million in k samples."""
    if cpm is None:
        keep = counts.groupBy("feature").agg(F.sum("value").alias("s")).where(F.col("s") >= (1 if min_sum is None else min_sum))
    else:
        totals = counts.groupBy("sample").agg(F.sum("value").alias("__t"))
        keep = counts.join(F.broadcast(bounded(totals, MOST_SAMPLES, "samples")), "sample").groupBy("feature").agg(F.count_if(F.col("value") * 1e6 / F.col("__t") > cpm).alias("n")).where(F.col("n") >= k)
    return counts.join(keep.select("feature"), "feature", "left_semi")


def filter_targets(df: DataFrame, max_p: float, max_energy: float) -> DataFrame:
    return df.where((F.col("pvalue") <= max_p) & (F.col("energy") <= max_energy))


def filter_seed_gu(df: DataFrame, target: str, query: str, start: int, end: int) -> DataFrame:
    """Duplexes without a G:U pair or gap at positions start to end (1-based) of the reversed alignment strings."""
    t, q = F.upper(F.reverse(target)), F.upper(F.reverse(query))
    bad = lambda i: (F.substring(t, i, F.lit(1)).isin(" ", "-")) | (F.substring(q, i, F.lit(1)).isin(" ", "-")) | F.concat(F.substring(t, i, F.lit(1)), F.substring(q, i, F.lit(1))).isin("GU", "UG")
    return df.where(~F.exists(F.sequence(F.lit(start), F.lit(end)), bad))


def filter_score(df: DataFrame, max_score: float) -> DataFrame:
    """Targets up to a score; of equal (target, score, mirna) rows one. Ordered by target, score and mirna."""
    return df.where(F.col("score") <= max_score).groupBy("target", "score", "mirna").agg(F.max("sites").alias("sites")).orderBy("target", "score", "mirna")


def cpm_fold(counts: DataFrame, samples: list[str], pseudo: float = 1.0) -> DataFrame:
    """(feature, first, second, cpm_1, cpm_2, log2_fold) of every two samples.

    The pseudo-count is added to each input row before sums; values per million
    are rounded to 2 decimals before the ratio, which is first by second.
    """
    added = counts.withColumn("value", F.col("value") + pseudo)
    wide = added.groupBy("feature").pivot("sample", samples).agg(F.sum("value"))
    totals = added.groupBy("sample").agg(F.sum("value").alias("t"))
    total = totals.agg(*[F.max(F.when(F.col("sample") == s, F.col("t"))).alias(f"__t_{s}") for s in samples])
    per = wide.crossJoin(F.broadcast(total))  # one row
    per = per.select("feature", *[F.round(F.coalesce(F.col(f"`{s}`"), F.lit(0.0)) * 1e6 / F.col(f"__t_{s}"), 2).alias(s) for s in samples])
    pairs = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"`{a}`").alias("cpm_1"), F.col(f"`{b}`").alias("cpm_2")) for a, b in combinations(samples, 2)])
    rows = per.select("feature", F.explode(pairs).alias("p")).select("feature", "p.*")
    return rows.withColumn("log2_fold", F.when((F.col("cpm_1") > 0) & (F.col("cpm_2") > 0), F.log2(F.col("cpm_1") / F.col("cpm_2"))))


def log2_fold(df: DataFrame, a: str, b: str, out: str = "log2_fold") -> DataFrame:
    """log2 of (b + 1) by (a + 1), to 6 decimals."""
    return df.withColumn(out, F.round(F.log2((F.col(b) + 1) / (F.col(a) + 1)), 6))


def lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0: Stirling's series, shifted to where it is exact."""
    x = np.asarray(x, dtype=np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    while (small := y < 10).any():
        shift = np.where(small, shift + np.log(np.where(small, y, 1)), shift)
        y = np.where(small, y + 1, y)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


@F.pandas_udf(T.DoubleType())
def _audic(x: pd.Series, y: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    x, y, n1, n2 = (s.to_numpy(dtype=np.float64) for s in (x, y, n1, n2))
    swap = n2 > n1
    x, y, n1, n2 = np.where(swap, y, x), np.where(swap, x, y), np.where(swap, n2, n1), np.where(swap, n1, n2)
    r = np.log(n2 / n1)
    return pd.Series(np.exp(y * r + lgamma(x + y + 1) - lgamma(x + 1) - lgamma(y + 1) - (x + y + 1) * np.log1p(n2 / n1)))


def audic_claverie(x: str, y: str, n1: str, n2: str) -> Column:
    """The probability of count y given x in libraries of n1 and n2; the larger library counts as the first. No nulls."""
    return _audic(*[F.col(c).cast("double") for c in (x, y, n1, n2)])


def denormalize(counts: DataFrame, scales: DataFrame) -> DataFrame:
    """Values times their sample's scale, rounded half to even. scales (sample, scale)."""
    return counts.join(scales, "sample").select("feature", "sample", F.bround(F.col("value") * F.col("scale")).alias("value"))


def size_factors(counts: DataFrame, n_samples: int, control: DataFrame | None = None) -> DataFrame:
    """(sample, factor) by the median of ratios to geometric means, over features positive in all samples."""
    used = counts if control is None else counts.join(control.select("feature"), "feature", "left_semi")
    means = used.where("value > 0").groupBy("feature").agg(F.avg(F.log("value")).alias("m"), F.count("*").alias("n")).where(F.col("n") == n_samples)
    ratios = used.join(means.select("feature", "m"), "feature").select("sample", (F.log("value") - F.col("m")).alias("ratio"))
    return exact_percentiles(ratios, ["sample"], "ratio", {"half": 0.5}).select("sample", F.exp("half").alias("factor"))


def normalized(counts: DataFrame, factors: DataFrame) -> DataFrame:
    return counts.join(factors, "sample").select("feature", "sample", (F.col("value") / F.col("factor")).alias("value"))


def group_means(counts: DataFrame, design: DataFrame) -> DataFrame:
    """(feature, group, mean). design (sample, group)."""
    return counts.join(design.select("sample", "group"), "sample").groupBy("feature", "group").agg(F.avg("value").alias("mean"))


def tmm_factors(counts: DataFrame, reference: str, trim_m: float = 0.3, trim_a: float = 0.05) -> DataFrame:
    """(sample, factor): trimmed means of log ratios to the reference sample, weighted by inverse variance."""
    totals = counts.groupBy("sample").agg(F.sum("value").alias("__n"))
    shares = counts.join(totals, "sample").where("value > 0")
    ref = shares.where(F.col("sample") == reference).select("feature", F.col("value").alias("r"), F.col("__n").alias("rn"))
    both = shares.join(ref, "feature").withColumns({"m": F.log2(F.col("value") / F.col("__n") / (F.col("r") / F.col("rn"))), "a": F.log2(F.col("value") / F.col("__n") * F.col("r") / F.col("rn")) / 2, "w": 1 / ((F.col("__n") - F.col("value")) / (F.col("__n") * F.col("value")) + (F.col("rn") - F.col("r")) / (F.col("rn") * F.col("r")))})
    both = materialize(both, "log-ratios")
    cuts = exact_percentiles(both, ["sample"], "m", {"m_lo": trim_m, "m_hi": 1 - trim_m}).join(exact_percentiles(both, ["sample"], "a", {"a_lo": trim_a, "a_hi": 1 - trim_a}), "sample")
    kept = both.join(cuts, "sample").where("m BETWEEN m_lo AND m_hi AND a BETWEEN a_lo AND a_hi")
    return kept.groupBy("sample").agg(F.pow(F.lit(2.0), F.sum(F.col("w") * F.col("m")) / F.sum("w")).alias("factor"))


def tmm_cpm(counts: DataFrame, reference: str) -> DataFrame:
    """(feature, sample, value): counts per million of the effective library, size times factor."""
    totals = counts.groupBy("sample").agg(F.sum("value").alias("__n"))
    scaled = totals.join(tmm_factors(counts, reference), "sample").select("sample", (F.col("__n") * F.col("factor")).alias("__e"))
    return counts.join(scaled, "sample").select("feature", "sample", (F.col("value") * 1e6 / F.col("__e")).alias("value"))


def best_annotation(ann: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """One annotation (tx, score, evalue, descr) a gene: highest score, then lowest e-value; ``.pN`` of a protein's name is left out."""
    named = ann.withColumn("tx", F.regexp_replace("tx", r"\.p\d+$", "")).join(tx2gene.select("tx", "gene").distinct(), "tx")
    return named.groupBy("gene").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("evalue"), F.col("descr"))).alias("b")).select("gene", (-F.col("b.s")).alias("score"), "b.evalue", "b.descr")


@F.pandas_udf(T.DoubleType())
def _hypergeometric_tail(k: pd.Series, size: pd.Series, chosen: pd.Series, total: pd.Series) -> pd.Series:
    out = []
    for a, m, n, all_ in zip(k, size, chosen, total):
        i = np.arange(a, min(m, n) + 1, dtype=np.float64)
        log_choose = lambda x, y: lgamma(np.asarray(x + 1.0)) - lgamma(y + 1.0) - lgamma(x - y + 1.0)
        terms = log_choose(m, i) + log_choose(all_ - m, n - i) - log_choose(float(all_), np.asarray([float(n)]))
        out.append(min(1.0, float(np.exp(terms).sum())))
    return pd.Series(out)


def enrich(sets: DataFrame, genes: DataFrame, selected: DataFrame, min_size: int = 10) -> DataFrame:
    """(term, size, hits, p_value, q_value): over-representation of selected genes, by Fisher's exact test. sets (term, gene)."""
    universe = genes.select("gene").distinct()
    chosen = selected.select("gene").distinct().join(universe, "gene", "left_semi").withColumn("__hit", F.lit(1))
    members = sets.select("term", "gene").distinct().join(universe, "gene", "left_semi").join(chosen, "gene", "left")
    counts = members.groupBy("term").agg(F.count("*").alias("size"), F.count("__hit").alias("hits")).where(F.col("size") >= min_size)
    sizes = universe.agg(F.count("*").alias("total")).crossJoin(chosen.agg(F.count("*").alias("chosen")))  # one row
    tested = counts.crossJoin(F.broadcast(sizes)).where("total >= size AND total - size >= chosen - hits")
    tested = tested.withColumn("p_value", _hypergeometric_tail("hits", "size", "chosen", "total"))
    return bh_adjust(materialize(tested, "tested"), "p_value", []).select("term", "size", "hits", "p_value", "q_value")


def ma_values(df: DataFrame, a: str, b: str) -> DataFrame:
    """``m``: log2 ratio; ``a``: mean log2; of values with 1 added."""
    x, y = F.log2(F.col(a) + 1), F.log2(F.col(b) + 1)
    return df.withColumns({"m": y - x, "a": (x + y) / 2})


def cv2(counts: DataFrame) -> DataFrame:
    """(feature, mean, cv2): the squared coefficient of variation over samples; null for a mean of 0."""
    return counts.groupBy("feature").agg(F.avg("value").alias("mean"), (F.var_samp("value") / F.nullif(F.pow(F.avg("value"), F.lit(2)), F.lit(0.0))).alias("cv2"))


def term_zscore(terms: DataFrame, de: DataFrame, sep: str = ",") -> DataFrame:
    """(term, n, up, down, zscore): (up - down) / sqrt(n) over a term's delimited genes with a fold change. terms (term, genes); de (gene, fold)."""
    genes = terms.select("term", F.explode(F.split("genes", sep)).alias("gene")).distinct()
    counts = genes.join(de, "gene").groupBy("term").agg(F.count("*").alias("n"), F.count_if(F.col("fold") > 0).alias("up"), F.count_if(F.col("fold") < 0).alias("down"))
    return counts.withColumn("zscore", (F.col("up") - F.col("down")) / F.sqrt("n"))


def rarefaction(reads: DataFrame, order: Column | None, chunk: int, reps: int, min_reads: float, min_rpk: float = 0.0, known: DataFrame | None = None, count: str | None = None, rpk: str | None = None) -> DataFrame:
    """(rep, chunk, mapped, mapped_unique, genes, known, novel): reads and genes discovered, chunk by chunk, in each replicate.

    reads (read, gene, and columns ``count`` and ``rpk``): a row's weight, 1 without
    the column, and its part of reads per 1000 bases, 0 without. Without ``order``
    rows are numbered once by all that counts of them, each replicate puts the numbers
    in an order of its own (``keyed_permutation``), and every chunk but the last has
    exactly ``chunk`` rows. ``order`` gives instead, from the column ``rep``, a whole
    number whose remainder by the number of chunks is the chunk: chunks are then about equal.

    mapped sums all weights so far, mapped_unique those of at least 1. A gene is
    discovered in the chunk where its weights so far reach min_reads and its rpk
    min_rpk; no gene ('' or null) is never one. known (gene): the others are novel.
    Reads shrink to (rep, gene, chunk) sums before any window.
    """
    total = reads.count()
    weight = F.col(count).cast("double") if count else F.lit(1.0)
    used = reads.select("read", "gene", weight.alias("w"), (F.col(rpk).cast("double") if rpk else F.lit(0.0)).alias("k"))
    if order is None:
        numbered = global_row_number(used, ["read", "gene", "w", "k"], "number").withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(reps))))
        placed = keyed_permutation(numbered.withColumn("number", F.col("number") - 1), "number", total, F.col("rep"), "place")
        dealt = placed.withColumn("chunk", F.expr(f"place div {int(chunk)} + 1"))
    else:
        dealt = used.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(reps)))).withColumn("chunk", F.pmod(order, F.lit(max(1, -(-total // chunk)))) + 1)
    sums = dealt.groupBy("rep", "gene", "chunk").agg(F.sum("w").alias("n"), F.sum(F.when(F.col("w") >= 1, F.col("w")).otherwise(0.0)).alias("u"), F.sum("k").alias("k"))
    counts = materialize(sums, "rarefaction")
    own = Window.partitionBy("rep", "gene").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.where("gene IS NOT NULL AND CAST(gene AS STRING) <> ''").withColumns({"n": F.sum("n").over(own), "k": F.sum("k").over(own)})
    found = reached.where((F.col("n") >= min_reads) & (F.col("k") >= min_rpk)).groupBy("rep", "gene").agg(F.min("chunk").alias("chunk"))
    old = found.withColumn("__old", F.lit(0)) if known is None else found.join(known.select("gene").distinct().withColumn("__old", F.lit(1)), "gene", "left")
    news = old.groupBy("rep", "chunk").agg(F.count("*").alias("g"), F.count_if(F.col("__old") == 1).alias("o"))
    grid = counts.groupBy("rep", "chunk").agg(F.sum("n").alias("n"), F.sum("u").alias("u")).join(news, ["rep", "chunk"], "left")
    upto = Window.partitionBy("rep").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    told = grid.select("rep", "chunk", F.sum("n").over(upto).alias("mapped"), F.sum("u").over(upto).alias("mapped_unique"), F.sum(F.coalesce("g", F.lit(0))).over(upto).alias("genes"), F.sum(F.coalesce("o", F.lit(0))).over(upto).alias("known"))
    return told.withColumn("novel", F.col("genes") - F.col("known"))


def replicate_stats(df: DataFrame, by: str | list[str], value: str, size: Column | None = None) -> DataFrame:
    """Mean, deviation, standard error and the 95 % band of replicates.

    size: of what the values are a part, from the columns ``by`` (the chunk's number
    times its reads): adds percent, percent_low and percent_high, mean and band of it.
    """
    got = df.groupBy(by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    se = F.col("sd") / F.sqrt("n")
    told = got.withColumns({"se": se, "low": F.col("mean") - 1.96 * se, "high": F.col("mean") + 1.96 * se})
    return told if size is None else told.withColumns({f"percent{end}": F.col(c) / size * 100 for c, end in (("mean", ""), ("low", "_low"), ("high", "_high"))})


def saturation_fit(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """Fit of y on log(x) for each group, and its value a third beyond the greatest x."""
    logged = df.where(F.col(x) > 0).withColumn("__x", F.log(F.col(x)))
    fit = logged.groupBy(by).agg(F.regr_slope(F.col(y), F.col("__x")).alias("slope"), F.regr_intercept(F.col(y), F.col("__x")).alias("intercept"), F.regr_r2(F.col(y), F.col("__x")).alias("r2"), (F.max(x) * 4 / 3).alias("beyond"))
    return fit.withColumn("predicted", F.col("intercept") + F.col("slope") * F.log("beyond"))


def steady_line(df: DataFrame, x: str, y: str, by: str, points: int = 5, min_r2: float = 0.98) -> DataFrame:
    """(by, start, end, slope, intercept, r2): of fits of y on x over ``points`` rows in a row with r2 above min_r2 the one with the smallest slope.

    Rows of a group are in order of x; y of 0 or less counts as 0.001. The last two
    windows are left out, as in the workflow that this serves. Ties: the first.
    """
    values = df.select(by, F.col(x).cast("double").alias("__x"), F.when(F.col(y) <= 0, F.lit(0.001)).otherwise(F.col(y).cast("double")).alias("__y"))
    order = Window.partitionBy(by).orderBy("__x")
    ahead = order.rowsBetween(0, points - 1)
    fit = values.withColumns({"start": F.col("__x"), "end": F.max("__x").over(ahead), "slope": F.regr_slope("__y", "__x").over(ahead), "intercept": F.regr_intercept("__y", "__x").over(ahead), "r2": F.regr_r2("__y", "__x").over(ahead), "__at": F.row_number().over(order), "__n": F.count("*").over(Window.partitionBy(by))})
    good = fit.where((F.col("__at") <= F.col("__n") - points - 1) & (F.col("r2") > min_r2))
    return good.groupBy(by).agg(F.min(F.struct("slope", "start", "end", "intercept", "r2")).alias("b")).select(by, "b.start", "b.end", "b.slope", "b.intercept", "b.r2")


def difference_quotients(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """``quotient``: the change of y by that of x since the row before, within each group."""
    order = Window.partitionBy(by).orderBy(x)
    return df.withColumn("quotient", (F.col(y) - F.lag(y).over(order)) / F.nullif(F.col(x) - F.lag(x).over(order), F.lit(0)))
