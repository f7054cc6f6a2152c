"""Global numbers, running sums, percentiles and false-discovery rates without a window over a whole group.

Rows are dealt by range; what a range holds is summed first, and a range begins
with what the ranges before it (or after it) hold. A group of any size is spread
over as many ranges as its rows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from omicspark.storage import free_name, materialize


def global_row_number(df: DataFrame, order: list[str], name: str = "row_number", parts: int | None = None) -> DataFrame:
    """``df`` with numbers from 1 in the order of columns that are unique together.

    Rows are dealt by range and sorted within each range; a range's numbers begin
    after the rows of those before, which are counted first. No task sees all rows.
    parts: how many ranges, instead of the session's number.
    """
    ranged = df.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order).withColumn("__range", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    placed = materialize(ranged, "ranges")
    sizes = placed.groupBy("__range").agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    bases = sizes.select("__range", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = placed.join(F.broadcast(bases), "__range")  # one row a partition
    return numbered.withColumn(name, F.col("base") + F.col("__at") - F.col("first") + 1).drop("__range", "__at", "first", "base")


_PRIME = 2147483647


def _mixed(x: Column) -> Column:
    once = (x % _PRIME * 48271 + 11) % _PRIME
    return once * (once % 65537 + 1) % _PRIME


def keyed_permutation(df: DataFrame, number: str, total: int, key: Column, name: str, rounds: int = 16) -> DataFrame:
    """``df`` with ``name``: where a permutation of 0 .. total - 1 that depends on ``key`` puts ``number``.

    Swap-or-not: in each round a number and its mirror at a place that the key tells
    change places or not, as the greater of the two tells. Every round is a permutation
    of exactly these numbers at any ``total``, so nothing is sorted, moved or tried again.
    """
    place, mirror = free_name(df, "__place"), free_name(df, "__mirror")
    out, n = df.withColumn(place, F.col(number).cast("bigint")), F.lit(max(1, total)).cast("bigint")
    for r in range(1, rounds + 1):
        z = key.cast("bigint") * 1000003 + r * 7919
        out = out.withColumn(mirror, ((_mixed(z) * _PRIME + _mixed(z + 1)) % n - F.col(place) + n) % n)
        swap = _mixed(_mixed(F.greatest(place, mirror)) + _mixed(z + 2)) % 2 == 1
        out = out.withColumn(place, F.when(swap, F.col(mirror)).otherwise(F.col(place)))
    return out.withColumn(name, F.col(place)).drop(place, mirror)


def _ranged(df: DataFrame, by: list[str], *order: str) -> DataFrame:
    """``df`` written in ranges of (by, order), with the number of the range."""
    return materialize(df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("__range", F.spark_partition_id()), "ranges")


def _with_ranges(placed: DataFrame, by: list[str], own: Column, others: Column, total: Column, backward: bool = False) -> DataFrame:
    """``placed`` with __other: ``others`` of __own (``own`` of each range and group) over the group's ranges before, or after; and __total over all."""
    sizes = placed.groupBy("__range", *by).agg(own.alias("__own"))  # a row a range and group
    group = Window.partitionBy(*by)
    before = group.orderBy(F.desc("__range") if backward else F.col("__range")).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("__range", *by, others.over(before).alias("__other"), total.over(group).alias("__total")).alias("b")
    on = [F.col("a.__range") == F.col("b.__range"), *(F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by)]
    return placed.alias("a").join(bases, on).select("a.*", "b.__other", "b.__total")


def running_sums(df: DataFrame, by: list[str], order: str, value: str, out: str, total: str) -> DataFrame:
    """``df`` with the sums of ``value`` up to each row in ``order`` within its group, and the group's sum. (by, order) is unique."""
    placed = _with_ranges(_ranged(df, by, order), by, F.sum(value), F.sum("__own"), F.sum("__own"))
    within = Window.partitionBy("__range", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn(out, F.coalesce("__other", F.lit(0)) + F.sum(value).over(within)).withColumnRenamed("__total", total)
    return summed.drop("__range", "__other")


def numbers_within(df: DataFrame, by: list[str], order: list[str], out: str, total: str) -> DataFrame:
    """``df`` with the number of each row, from 1, in ``order`` within its group, and the group's rows. A null key is a group."""
    placed = _with_ranges(_ranged(df, by, *order), by, F.count("*"), F.sum("__own"), F.sum("__own"))
    within = Window.partitionBy("__range", *by).orderBy(*order)
    numbered = placed.withColumn(out, F.coalesce("__other", F.lit(0)) + F.row_number().over(within)).withColumnRenamed("__total", total)
    return numbered.drop("__range", "__other")


def exact_percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(by, a column a share): percentiles of ``value`` within groups, linear between ranks. Nulls don't count.

    Equal values are counted first; no task sees all values of a group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    upto = running_sums(counts, by, "__v", "__n", "__upto", "__all")

    def at(share: float, rounded) -> Column:  # the value at a rank counted from 0
        return F.min(F.when(F.col("__upto") > rounded(F.lit(share) * (F.col("__all") - 1)), F.col("__v")))

    found = upto.groupBy(*by).agg(F.max("__all").alias("__all"), *[at(p, f).alias(f"__{side}_{n}") for n, p in shares.items() for side, f in (("lo", F.floor), ("hi", F.ceil))])
    part = lambda p: F.lit(p) * (F.col("__all") - 1) - F.floor(F.lit(p) * (F.col("__all") - 1))
    return found.select(*by, *[(F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * part(p)).alias(n) for n, p in shares.items()])


def bh_adjust(df: DataFrame, p: str, by: list[str], where: Column | None = None, out: str = "q_value") -> DataFrame:
    """``df`` with Benjamini-Hochberg adjusted p-values within ``by``; an empty ``by`` is one group. A column ``out`` that is there gives way.

    Rows that ``where`` leaves out, or without a p-value, get null and don't
    count. q depends on p alone, so equal p-values are counted first; ranks and
    the least of what follows go by ranges, and are joined back.
    """
    used = F.col(p).isNotNull() & (where if where is not None else F.lit(True))
    counts = df.where(used).groupBy(*by, p).agg(F.count("*").alias("__n"))
    ranked = running_sums(counts, by, p, "__n", "__rank", "__all").withColumn("__score", F.col(p) * F.col("__all") / F.col("__rank"))
    placed = _with_ranges(_ranged(ranked, by, p), by, F.min("__score"), F.min("__own"), F.min("__own"), backward=True)
    within = Window.partitionBy("__range", *by).orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0)
    adjusted = placed.withColumn(out, F.least(F.lit(1.0), F.min("__score").over(within), F.col("__other")))
    keys = [F.col(f"x.{b}").eqNullSafe(F.col(f"q.{b}")) for b in by]
    mark, rest = free_name(df, "__used"), [c for c in df.columns if c != out]
    marked = df.withColumn(mark, used).alias("x")
    joined = marked.join(adjusted.select(*by, p, out).alias("q"), [*keys, (F.col(f"x.{p}") == F.col(f"q.{p}")) & F.col(f"x.{mark}")], "left")
    return joined.select(*[F.col(f"x.`{c}`") for c in rest], f"q.{out}")


def bh_across(cols: list[str]) -> list[Column]:
    """Adjusted values of a row's own p-values, in the order of ``cols``; nulls stay null and don't count."""
    values = F.filter(F.array(*cols), lambda x: x.isNotNull())
    n = F.size(values)

    def one(col: str) -> Column:
        # the least of p * n / rank over p-values at or above the own one
        at = lambda ordered: F.array_min(F.filter(F.transform(ordered, lambda x, i: F.when(x >= F.col(col), x * n / (i + 1))), lambda x: x.isNotNull()))
        return F.when(F.col(col).isNotNull(), F.least(F.lit(1.0), F.transform(F.array(F.sort_array(values)), at)[0]))

    return [one(c) for c in cols]
