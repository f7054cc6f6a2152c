"""Exact top-k by inner product: Fagin's threshold algorithm, block by block.

Candidates are dealt evenly into blocks, queries too; each pair of a candidate
block and a query block is one bounded group. A block keeps, for each dimension,
its rows in order of their component. A query reads the lists from the end that
suits the sign of its own component, those first whose next rows lower the bound
the most, and scores each row when it first appears. No row not yet seen can score
more than the sum of what comes next in each list times the query's component:
when that bound is under the kth score, the search of the block is over. The kth
score of one block is the floor for all the others, which then end at once when
their bound is under it. Ties go to the smaller id, so a bound that equals the kth
score doesn't end it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from omicspark.storage import materialize

BLOCK = 4096
QUERIES = 4096
_STEP = 128  # rows of a list read at first; then as many again as were read
_EXACT = 1 << 53  # products and sums below this are exact in floating point


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component as a long; null for a vector that is null or holds null or non-finite components."""
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("bigint")))


class SortedLists:
    """A block of rows with its rows in order of each dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        self.order = np.argsort(rows, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(rows, self.order.T, axis=0).T.copy()
        self.largest = max(1, int(np.abs(rows).max())) if rows.size else 1
        self.floats = rows.astype(np.float64)
        self.scored = 0  # rows scored so far, by all queries

    def _scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.largest * max(1, int(np.abs(query).max())) * len(query) < _EXACT:
            return (self.floats[at] @ query.astype(np.float64)).astype(np.int64)
        return self.rows[at] @ query

    def top(self, query: np.ndarray, k: int, own: int = -1, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best rows by falling score, then id; ``own`` is left out.

        floor: a score that the kth best of all blocks has at least; rows below it may be left out.
        """
        n = len(self.rows)
        seen = np.zeros(n, dtype=bool)
        scores = np.empty(n, dtype=np.int64)
        if own >= 0:
            seen[own] = True
        dims = np.flatnonzero(query)
        q, up = query[dims], query[dims] > 0
        depth = np.zeros(len(dims), dtype=np.int64)  # rows read of each list
        place = lambda d: np.where(up, n - 1 - d, d)
        comes = self.values[dims, place(depth)] * q if n else np.empty(0, np.int64)
        found = np.empty(0, dtype=np.int64)
        while n:
            if not len(dims):  # a query of zeros has no list to read
                new = np.flatnonzero(~seen)
            else:
                ahead = np.minimum(depth + np.maximum(depth, _STEP), n)
                then = np.where(ahead < n, self.values[dims, place(np.minimum(ahead, n - 1))] * q, comes)
                drop = np.where(ahead < n, comes - then, comes.max() - comes.min() + 1)
                chosen = np.flatnonzero((drop >= drop.mean()) & (depth < n))
                read = [self.order[dims[j], n - ahead[j] : n - depth[j]] if up[j] else self.order[dims[j], depth[j] : ahead[j]] for j in chosen]
                fresh = np.zeros(n, dtype=bool)
                fresh[np.concatenate(read)] = True
                new = np.flatnonzero(fresh & ~seen)
                depth[chosen], comes[chosen] = ahead[chosen], then[chosen]
            seen[new] = True
            scores[new] = self._scores(new, query)
            self.scored += len(new)
            found = np.concatenate([found, new if floor is None else new[scores[new] >= floor]])
            if len(found) > k:
                least = np.partition(scores[found], len(found) - k)[len(found) - k]
                found = found[scores[found] >= least]
                if len(found) > k:
                    found = found[np.lexsort((self.ids[found], -scores[found]))][:k]
            if seen.all() or (depth == n).any():
                break
            bound = int(comes.sum())
            if (floor is not None and bound < floor) or (len(found) == k and scores[found].min() > bound):
                break
        found = found[np.lexsort((self.ids[found], -scores[found]))]
        return found, scores[found]


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _search(k: int):
    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if candidates.num_rows and queries.num_rows:
            rows, ask = _matrix(candidates["v"], candidates.num_rows), _matrix(queries["v"], queries.num_rows)
            ids = candidates["vec_id"].to_numpy()
            place = {u: i for i, u in enumerate(candidates["uid"].to_pylist())}
            lists = SortedLists(rows, ids)
            for uid, query_id, floor, q in zip(*(queries[c].to_pylist() for c in ("uid", "vec_id", "floor")), ask):
                at, scores = lists.top(q, k, place.get(uid, -1), floor)
                found += [(uid, query_id, int(i), int(s)) for i, s in zip(ids[at], scores)]
        cols = list(zip(*found)) if found else [[], [], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("uid", "query_id", "vec_id", "score"), cols)})

    return search


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query row's k best other rows.

    Score: integer inner product of the quantised vectors. A row is told apart
    from others by where it stands in the table, so a repeated id is another row.
    Vectors that are null, empty or hold null or non-finite components, and rows
    with a null id, take no part; vectors of another length are never compared.
    Fewer than k other rows: all. An empty table, or no queries: no rows.
    """
    known = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("v"), is_query.alias("asks"))
    # Written once with its number, as another evaluation could number rows otherwise.
    known = materialize(known.where("v IS NOT NULL AND size(v) > 0 AND vec_id IS NOT NULL").withColumn("dim", F.size("v")), "vectors")
    size = known.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks, groups = (max(1, math.ceil(n / most)) for n, most in ((size["n"], block), (size["q"], queries)))
    dealt = lambda n, seed: F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(n)).cast("int")
    key = ["dim", "b", "g"]

    def search(asked: DataFrame, first: int, last: int) -> DataFrame:
        """The k best of each block from ``first`` to ``last`` for each query with its floor."""
        left = known.select("dim", dealt(blocks, 1).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "uid", "vec_id", "v").where(F.col("b").between(first, last))
        right = asked.select("dim", dealt(groups, 2).alias("g"), F.explode(F.sequence(F.lit(first), F.lit(last))).alias("b"), "uid", "vec_id", "v", "floor")
        right = right.select(*(F.col(c).alias(c) for c in right.columns))  # columns of its own, as both sides are of one table
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_search(k), "uid long, query_id long, vec_id long, score long")

    asked = known.where("asks").withColumn("floor", F.lit(None).cast("long"))
    best = search(asked, 0, 0)
    if blocks > 1:
        best = materialize(best, "first-block")
        floors = best.groupBy("uid").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
        best = best.unionByName(search(asked.drop("floor").join(floors, "uid", "left"), 1, blocks - 1))
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
