"""Samples compared over all features: principal components and distances, for any number of samples.

Plans don't grow with the samples. A feature is one row of its values other than 0;
tasks add up products or distances of whole Arrow batches, and only their sums move.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omicspark.storage import bound_batches, materialize

BLOCK = 512  # samples of a block, two of which meet at a time
_CELLS = 1 << 20  # numbers that a task works on at once
_MORE = 8  # directions beyond those asked for
_TOLERANCE = 1e-10  # of the greatest variance: what a component may miss


def _numbers(counts: DataFrame, samples: list[str]) -> DataFrame:
    return counts.sparkSession.createDataFrame(list(enumerate(samples)), "at int, name string")


def _features(counts: DataFrame, samples: list[str]) -> DataFrame:
    """(feature, at, value): the values other than 0 of each feature, by the numbers of their samples in order. Written."""
    numbers = F.broadcast(_numbers(counts, samples))  # as long as the list that was given
    known = counts.select("feature", F.col("sample").cast("string").alias("name"), F.col("value").cast("double").alias("value"))
    sums = known.join(numbers, "name").groupBy("feature", "at").agg(F.sum("value").alias("value")).where("value <> 0")
    cells = sums.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("cells"))
    bound_batches(counts.sparkSession)
    return materialize(cells.select("feature", F.col("cells.at").alias("at"), F.col("cells.value").alias("value")), "features")


def _slices(batch: pa.RecordBatch, most: Callable[[int], int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(features, feature, sample, value) of cells, for so many features at a time that they have ``most`` cells, or one."""
    at, value = batch.column("at"), batch.column("value")
    lengths = at.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    where, what = at.flatten().to_numpy(), value.flatten().to_numpy()
    first = 0
    while first < len(lengths):
        base = ends[first] - lengths[first]
        last = max(first + 1, int(np.searchsorted(ends, base + most(first), "right")))
        cells = slice(int(base), int(ends[last - 1]))
        yield last - first, np.repeat(np.arange(last - first), lengths[first:last]), where[cells], what[cells]
        first = last


def _products(features: DataFrame, directions: np.ndarray) -> np.ndarray:
    """The sum over features x of x (x . d), for each direction d: a row a sample, a column a direction."""
    n, k = directions.shape
    names = [f"d{j}" for j in range(k)]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, k))
        for batch in batches:
            for size, owner, at, value in _slices(batch, lambda _: _CELLS):
                for j in range(k):
                    along = np.bincount(owner, value * directions[at, j], size)
                    total[:, j] += np.bincount(at, value * along[owner], n)
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[pa.array(total[some, j]) for j in range(k)]], ["at", *names])

    sums = features.select("at", "value").mapInArrow(part, "at int, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros((n, k))
    for row in sums.groupBy("at").agg(*[F.sum(c) for c in names]).collect():  # a row a sample
        out[row[0]] = row[1:]
    return out


def _leading(apply: Callable[[np.ndarray], np.ndarray], n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues and their vectors of a symmetric map that takes constant vectors to 0.

    A block of random directions and its images under the map, over and over, span
    a space that nears the vectors sought; the map within it is taken apart. Ends where
    every vector is mapped to its multiple, which is sure at the latest when the space is whole.
    """
    centre = lambda z: z - z.mean(axis=0)
    basis = images = np.zeros((n, 0))
    block = np.random.default_rng(0).normal(size=(n, min(k + _MORE, n - 1)))
    values, vectors = np.zeros(0), np.zeros((n, 0))
    while block.shape[1]:
        block = block / np.maximum(np.linalg.norm(block, axis=0), 1e-300)
        for _ in range(2):
            block = centre(block - basis @ (basis.T @ block))
        left, sizes, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, sizes > 1e-9]
        block = centre(block - basis @ (basis.T @ block))
        if not block.shape[1]:
            break
        image = centre(apply(block))
        basis, images = np.hstack([basis, block]), np.hstack([images, image])
        within = basis.T @ images
        found, turn = np.linalg.eigh((within + within.T) / 2)
        found, turn = found[::-1][:k], turn[:, ::-1][:, :k]
        values, vectors = np.maximum(found, 0), basis @ turn
        missed = np.linalg.norm(images @ turn - vectors * found, axis=0)
        if missed.max(initial=0) <= _TOLERANCE * max(values.max(initial=0), 1e-300):
            break
        block = image
    return values, vectors


def sample_pca(counts: DataFrame, samples: list[str], k: int = 2, top: int | None = 500) -> DataFrame:
    """(sample, component, score, share): principal components of samples over features, and the share of variance of each.

    Values are centred for each feature; missing ones and nulls are 0, equal rows
    add up, samples that aren't listed don't count. top: only so many features with
    the greatest variance over samples, ties by name; None: all. No matrix of samples
    by samples is made: each pass over the features maps a block of directions, and
    passes end when the components are exact to 10 digits of the greatest. The
    driver holds a few numbers a sample and pass. A component's largest score by size is
    positive; components beyond the variance there is have scores of 0.
    """
    n, spark = len(samples), counts.sparkSession
    if not n:
        return spark.createDataFrame([], "sample string, component int, score double, share double")
    total = F.aggregate("value", F.lit(0.0), lambda a, x: a + x)
    features = _features(counts, samples).withColumn("mean", total / n)
    spread = F.aggregate("value", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) + (n - F.size("value")) * F.col("mean") * F.col("mean")
    features = features.withColumn("spread", spread)
    if top is not None:
        best = features.select(F.col("feature").alias("best"), "spread").orderBy(F.desc(F.round("spread", 9)), "feature").limit(top).select("best")
        features = materialize(features.join(best, F.col("feature").eqNullSafe(F.col("best")), "left_semi"), "features")
    variance = features.agg(F.coalesce(F.sum("spread"), F.lit(0.0))).first()[0]
    values, vectors = _leading(lambda d: _products(features, d), n, k) if variance else (np.zeros(0), np.zeros((n, 0)))
    rows = []
    for c in range(min(k, n)):
        score = vectors[:, c] * np.sqrt(values[c]) if c < len(values) else np.zeros(n)
        score = score * (1.0 if score[np.abs(score).argmax()] >= 0 else -1.0)
        share = float(values[c] / variance) if c < len(values) and variance else 0.0
        rows += [(s, c + 1, float(x), share) for s, x in zip(samples, score)]
    return spark.createDataFrame(rows, "sample string, component int, score double, share double")


def _pair_sums(counts: DataFrame, samples: list[str], each: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(a, b, sum): the sum of each(x, y) over features for every two samples in the order of the list.

    Features go to pairs of blocks of samples, with their values in these two; a task
    adds up one pair at a time.
    """
    n, spark = len(samples), counts.sparkSession
    blocks = max(1, -(-n // BLOCK))
    pairs = blocks * (blocks + 1) // 2
    shares = max(1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // pairs)
    span = F.sequence(F.lit(0), F.lit(blocks - 1))
    dealt = _features(counts, samples).withColumn("i", F.explode(span)).withColumn("j", F.explode(F.slice(span, F.col("i") + 1, F.lit(blocks))))
    cells = F.filter(F.arrays_zip("at", "value"), lambda c: F.floor(c["at"] / BLOCK).isin(F.col("i"), F.col("j")))
    dealt = dealt.select("i", "j", F.pmod(F.xxhash64("feature"), F.lit(shares)).alias("share"), cells.alias("cells")).where(F.size("cells") > 0)
    dealt = dealt.select("i", "j", "share", F.col("cells.at").alias("at"), F.col("cells.value").alias("value")).repartition("i", "j", "share").sortWithinPartitions("i", "j").drop("share")

    def rows(i: int, j: int, total: np.ndarray) -> pa.RecordBatch:
        a, b = np.nonzero(total)
        a_at, b_at = a + i * BLOCK, b + j * BLOCK
        keep = a_at < b_at
        return pa.RecordBatch.from_arrays([pa.array(a_at[keep], pa.int32()), pa.array(b_at[keep], pa.int32()), pa.array(total[a[keep], b[keep]])], ["x", "y", "sum"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(0)
        width = lambda block: min(BLOCK, n - block * BLOCK)
        for batch in batches:
            places = np.stack([batch.column("i").to_numpy(), batch.column("j").to_numpy()], axis=1)
            starts = [0, *(np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1), len(places)] if len(places) else [0]
            for start, end in zip(starts, starts[1:]):
                i, j = map(int, places[start])
                if now != (i, j):
                    if now:
                        yield rows(*now, total)
                    now, total = (i, j), np.zeros((width(i), width(j)))
                step = max(1, _CELLS // total.size)
                for first in range(start, end, step):
                    for size, owner, at, value in _slices(batch.slice(first, min(step, end - first)), lambda _: 1 << 62):
                        sides = []
                        for block in (i, j):
                            side = np.zeros((size, width(block)))
                            mine = at // BLOCK == block
                            side[owner[mine], at[mine] - block * BLOCK] = value[mine]
                            sides.append(side)
                        total += each(sides[0][:, :, None], sides[1][:, None, :]).sum(axis=0)
        if now:
            yield rows(*now, total)

    numbers = _numbers(counts, samples)
    none = numbers.where(F.col("at") < n - 1).select(F.col("at").alias("x"), F.explode(F.sequence(F.col("at") + 1, F.lit(n - 1))).alias("y"), F.lit(0.0).alias("sum"))
    sums = dealt.mapInArrow(part, "x int, y int, sum double").unionByName(none).groupBy("x", "y").agg(F.sum("sum").alias("sum"))
    name = lambda at, col: F.broadcast(numbers.select(F.col("at").alias(at), F.col("name").alias(col)))
    return sums.join(name("x", "a"), "x").join(name("y", "b"), "y").select("a", "b", "sum")


def euclidean_distance(counts: DataFrame, samples: list[str]) -> DataFrame:
    """(a, b, distance) of every two samples, a before b in the list; missing values and nulls are 0, equal rows add up. No rows: 0."""
    return _pair_sums(counts, samples, lambda x, y: (x - y) ** 2).select("a", "b", F.sqrt("sum").alias("distance"))


def js_distance(counts: DataFrame, samples: list[str]) -> DataFrame:
    """(a, b, distance): the root of the Jensen-Shannon divergence (base 2) of values as they are, their mean in between. Else as euclidean_distance."""

    def each(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        mean = (x + y) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            part = lambda p: np.where(p > 0, p * np.log2(p / mean), 0.0)
            return part(x) + part(y)

    return _pair_sums(counts, samples, each).select("a", "b", F.sqrt(F.greatest(F.col("sum") / 2, F.lit(0.0))).alias("distance"))
