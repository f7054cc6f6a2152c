"""Table work: selection, merging, annotation, aggregation, pivots, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T

from omicspark.functions.text import split_list
from omicspark.operators.grams import find_literals
from omicspark.storage import bounded, free_name

MOST_TEMPLATES = 10_000


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def select_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """(rows whose key is listed, listed ids that no row has)."""
    listed = ids.select(F.col(id_col).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(listed, key, "left_semi"), listed.join(df.select(key), key, "left_anti")


def exclude_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    return df.join(ids.select(F.col(id_col).alias(key)), key, "left_anti")


def _needs_id(template: str) -> bool:
    """Whether every match of the template surely contains the id: no choice, no flags or classes, ``$id`` outside groups and not optional."""
    before, found, after = template.partition("$id")
    return bool(found) and not any(x in template for x in ("|", "(?", "[", "\\Q")) and before.count("(") == before.count(")") and "\\(" not in before and "\\)" not in before and after[:1] not in ("?", "*", "{") and not before.endswith("\\")


def select_by_template(df: DataFrame, ids: DataFrame, col: str, template: str, id_col: str = "id", rename: bool = False) -> DataFrame:
    """Rows whose ``col`` matches the regex ``template`` with its ``$id`` put in literally; a row for each id that matches.

    Texts that contain an id are found first (``find_literals``), and only these pairs are
    held to the regex: any number of ids will do. Where a match needn't contain the id
    (a choice, a flag, an optional ``$id``), and for the id '', each id is tried against
    each text: over MOST_TEMPLATES distinct ones are an error then. Null ids match nothing.
    """
    own = free_name(df, "matched_id" if not rename else "__id")
    named = ids.select(F.col(id_col).cast("string").alias("__id")).where("__id IS NOT NULL").distinct()
    quoted = F.concat(F.lit("\\Q"), F.replace(F.col("__id"), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    matches = lambda text: F.regexp(F.col(text), F.replace(F.lit(template), F.lit("$id"), quoted))
    texts = df.select(F.col(col).alias("__text")).where("__text IS NOT NULL").distinct()
    tried = named.where("__id = ''") if _needs_id(template) else named
    pairs = texts.join(F.broadcast(bounded(tried, MOST_TEMPLATES, "ids")), matches("__text"))
    if _needs_id(template):
        pairs = find_literals(texts, "__text", named, "__id").where(matches("__text")).unionByName(pairs)
    met = df.join(pairs.withColumnRenamed("__id", own), df[col] == pairs["__text"]).drop("__text")
    return met.select(*[F.col(f"`{own}`").alias(c) if c == col else F.col(f"`{c}`") for c in df.columns]) if rename else met


def select_group(df: DataFrame, col: str, group: int, kinds: list[str]) -> DataFrame:
    """Rows whose header names the group, five digits wide, and one of the kinds."""
    tag = F.lpad(F.lit(str(group)), 5, "0")
    return df.where(F.contains(F.col(col), tag) & F.regexp_like(F.col(col), F.lit("|".join(kinds))))


def merge_tables(x: DataFrame, y: DataFrame, by_x: str, by_y: str, all_x: bool = False, all_y: bool = False) -> DataFrame:
    """Join on keys of different names; null keys match null keys. One key column; other shared names get .x and .y."""
    how = {(False, False): "inner", (True, False): "left", (False, True): "right", (True, True): "full"}[all_x, all_y]
    shared = (set(x.columns) - {by_x}) & (set(y.columns) - {by_y})
    left = x.select(F.col(by_x).alias("__kx"), *[F.col(f"`{c}`").alias(f"{c}.x" if c in shared else c) for c in x.columns if c != by_x])
    right = y.select(F.col(by_y).alias("__ky"), *[F.col(f"`{c}`").alias(f"{c}.y" if c in shared else c) for c in y.columns if c != by_y])
    joined = left.join(right, F.col("__kx").eqNullSafe(F.col("__ky")), how)
    rest = [F.col(f"`{c}`") for c in joined.columns if c not in ("__kx", "__ky")]
    return joined.select(F.coalesce("__kx", "__ky").alias(by_x), *rest)


def annotate(df: DataFrame, ann: DataFrame, key: str, id_col: str, value: str, name: str, order: str | None = None) -> DataFrame:
    """``df`` with ``name``: the annotation of its key, '' if there is none. Of repeated ids the last by ``order`` counts."""
    known = ann.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max_by(value, order or value).alias("__value"))
    return df.join(known, df[key] == known["__id"], "left").select(*[df[c] for c in df.columns], F.coalesce("__value", F.lit("")).alias(name))


def aggregate_concat(df: DataFrame, by: str, sep: str = ";") -> DataFrame:
    """Distinct rows without nulls, then every other column's values of each key put together in order."""
    rest = [c for c in df.columns if c != by]
    return df.dropna().distinct().groupBy(by).agg(*[F.array_join(F.array_sort(F.collect_list(F.col(c).cast("string"))), sep).alias(c) for c in rest])


def sum_counts(df: DataFrame, id_col: str, samples: list[str] | None = None) -> DataFrame:
    """Sums of sample columns for each id. By default all but the fixed names of quantifier tables and normalised columns."""
    fixed = {"#miRNA", "read_count", "precursor", "total", id_col}
    chosen = samples or [c for c in df.columns if c not in fixed and not c.endswith("(norm)")]
    return df.groupBy(id_col).agg(*[F.sum(F.col(f"`{c}`").cast("double")).alias(c) for c in chosen])


def to_matrix(df: DataFrame, row: str, col: str, value: str, values: list, how: str = "sum") -> DataFrame:
    """Long to wide over known column values; what is missing is 0."""
    return df.groupBy(row).pivot(col, values).agg(getattr(F, how)(value)).fillna(0)


def symmetric_matrix(df: DataFrame, a: str, b: str, value: str, names: list[str]) -> DataFrame:
    """A distance matrix from pairs named once: both triangles, zeros on the diagonal and for missing pairs."""
    pairs = df.select(F.col(a).alias("name"), F.col(b).alias("__other"), F.col(value).alias("__value"))
    swapped = pairs.select(F.col("__other").alias("name"), F.col("name").alias("__other"), "__value")
    both = pairs.unionByName(swapped).where("name <> __other")
    diagonal = both.select("name").distinct().select("name", F.col("name").alias("__other"), F.lit(0.0).alias("__value"))
    return to_matrix(both.unionByName(diagonal), "name", "__other", "__value", names, "max")


def melt(df: DataFrame, ids: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, [c for c in df.columns if c not in ids], name, value)


def split_rows(df: DataFrame, col: str, sep: str) -> DataFrame:
    """A row for each part of a delimited column; empty and null cells give none."""
    return df.withColumn(col, F.explode(split_list(F.col(col), sep)))


def top1(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group."""
    return limit_per_group(df, by, 1, order)


def limit_per_group(df: DataFrame, by: list[str], n: int, order: list[Column]) -> DataFrame:
    """At most n rows of each group, the first by ``order``."""
    number = free_name(df, "__n")
    return df.withColumn(number, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(number) <= n).drop(number)


def lump_other(df: DataFrame, by: str, cls: str, value: str, n: int, other: str = "other") -> DataFrame:
    """Sums by group and class, where classes that are in no group's n greatest are one class."""
    sums = df.groupBy(by, cls).agg(F.sum(value).alias(value))
    tops = limit_per_group(sums, [by], n, [F.desc(value), F.col(cls)]).select(F.col(cls).alias("__top")).distinct()
    named = sums.join(tops, sums[cls] == tops["__top"], "left").withColumn(cls, F.when(F.col("__top").isNotNull(), F.col(cls)).otherwise(other))
    return named.groupBy(by, cls).agg(F.sum(value).alias(value))


def set_diff(x: DataFrame, y: DataFrame, by_x: str, by_y: str) -> DataFrame:
    """Distinct values of one column that the other lacks."""
    return x.select(by_x).subtract(y.select(F.col(by_y).alias(by_x)))


def union_distinct(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out.distinct()


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 1) -> DataFrame:
    """n rows by a digest of ``key`` and the seed: a top-n, no full sort, the same rows each time."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")).cast("binary")), key).limit(n)


def stage_counts(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, n) of each named DataFrame."""
    each = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in stages]
    out = each[0]
    for one in each[1:]:
        out = out.unionByName(one)
    return out


def venn_membership(lists: list[tuple[str, DataFrame]], item: str = "item", fold: str = "fold") -> DataFrame:
    """(item, code, direction): a 1 or 0 for each list, and up, down or contra by the signs of its folds."""
    rows = [df.select(F.col(item).alias("item"), F.lit(i).alias("__list"), F.col(fold).alias("__fold")) for i, (_, df) in enumerate(lists)]
    every = rows[0]
    for one in rows[1:]:
        every = every.unionByName(one)
    seen = every.groupBy("item").agg(
        *[F.max(F.when(F.col("__list") == i, 1).otherwise(0)).alias(f"__in{i}") for i in range(len(lists))],
        F.max(F.col("__fold") > 0).alias("__up"),
        F.max(F.col("__fold") <= 0).alias("__down"),
    )
    direction = F.when(F.col("__up") & F.col("__down"), "contra").when(F.col("__up"), "up").otherwise("down")
    return seen.select("item", F.concat_ws(";", *[F.col(f"__in{i}").cast("string") for i in range(len(lists))]).alias("code"), direction.alias("direction"))


def rollup_lineage(df: DataFrame, lineage: str, samples: list[str], sep: str = "; ", scale: float | None = None, rank: int | None = None, unclassified: str = "Unclassified", exclusive: bool = False) -> DataFrame:
    """(lineage, depth, samples..., total): every prefix of each lineage gets the sums of what is under it.

    Rows without a lineage are one class, ``unclassified``, of depth 1. scale:
    values as a share of each sample's total, unclassified included, times scale.
    rank: only prefixes of that depth. exclusive: a class has only its own rows.
    """
    parts = F.filter(F.split(F.coalesce(F.col(lineage), F.lit("")), F.lit(f"\\Q{sep}\\E")), lambda p: p != "")
    whole = F.when(F.size(parts) == 0, F.array(F.lit(unclassified))).otherwise(parts)
    own = df.select(whole.alias("__parts"), *samples).groupBy("__parts").agg(*[F.sum(s).alias(s) for s in samples])
    depths = F.array(F.size("__parts")) if exclusive else F.sequence(F.lit(1), F.size("__parts"))
    rolled = own.select(F.col("__parts"), F.explode(depths).alias("depth"), *samples)
    sums = rolled.groupBy(F.array_join(F.slice("__parts", F.lit(1), F.col("depth")), sep).alias("lineage"), "depth").agg(*[F.sum(s).alias(s) for s in samples])
    if scale is not None:
        totals = own.agg(*[F.sum(s).alias(f"__t_{s}") for s in samples])
        sums = sums.crossJoin(F.broadcast(totals))  # one row
        sums = sums.select("lineage", "depth", *[(F.col(s) * scale / F.nullif(F.col(f"__t_{s}"), F.lit(0))).alias(s) for s in samples])
    total = sum((F.coalesce(F.col(s), F.lit(0)) for s in samples), F.lit(0))
    out = sums.withColumn("total", total)
    return out.where(F.col("depth") == rank) if rank is not None else out
