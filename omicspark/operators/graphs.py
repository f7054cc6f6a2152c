"""Co-occurrence edges between features and statistics of edges."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omicspark.operators.ranks import global_row_number
from omicspark.storage import materialize, release, spread

ROWS = 1 << 17  # rows of a block of features, about
_CELLS = 1 << 22  # products or paths held at a time
_PACK = 1 << 20  # edges that are packed together, or looked at together
TASK_EDGES = 1 << 23  # edges that a task looks for triangles in, about
FEW_EDGES = 1 << 18  # edges that one task sees
LEAST_GROUPS = 4  # of nodes, so 20 tasks, beyond
_SLACK = 2e-9  # scores count to 9 decimals
MANY_BLOCKS = 8  # beyond, features that seldom meet go by the samples that they share
MOST_MET = 32  # pairs of features with a common sample, for each row
FEW = 256  # features that are tried with each other first
MOST_TRIED = 4096  # features that are tried with each other
_EDGE = "a string, b string, score double"


def _products(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(features of the left, features of the right, sums of products, sums of minima) of all pairs, 0 without a common sample.

    Some left features at a time, so that no more than _CELLS pairs are held.
    left and right: f (number of the feature), sample, v; the right by sample.
    """
    samples, values, own = (right[c].to_numpy() for c in ("sample", "v", "f"))
    width = int(own.max()) + 1
    step = max(1, _CELLS // width)
    left = left.sort_values("f", kind="stable")
    f, s, v = (left[c].to_numpy() for c in ("f", "sample", "v"))
    for low in range(0, int(f.max()) + 1, step):
        a, b = np.searchsorted(f, [low, low + step])
        begin, end = np.searchsorted(samples, s[a:b], "left"), np.searchsorted(samples, s[a:b], "right")
        p, m = np.zeros(step * width), np.zeros(step * width)
        met = np.cumsum(end - begin)
        at = 0
        while at < b - a:  # rows whose partners are at most _CELLS
            to = max(at + 1, int(np.searchsorted(met, (met[at - 1] if at else 0) + _CELLS, side="right")))
            size = (end - begin)[at:to]
            row = np.repeat(np.arange(a + at, a + to), size)
            other = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[at:to], size)
            cell = (f[row] - low) * width + own[other]
            p += np.bincount(cell, v[row] * values[other], len(p))
            m += np.bincount(cell, np.minimum(v[row], values[other]), len(m))
            at = to
        cell = np.arange(min(step, int(f.max()) + 1 - low) * width)
        x, y = cell // width + low, cell % width
        if same:
            cell, x, y = (z[x < y] for z in (cell, x, y))
        yield x, y, p[cell], m[cell]


def _ends(score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Where the k first and the k last by score (to 9 decimals) are, ties by the order of names. No more than these are sorted."""
    found = []
    for value in (-score.round(9), score.round(9)):
        if len(value) <= k:
            return np.arange(len(value))
        last = np.partition(value, k - 1)[k - 1]
        ahead, ties = np.flatnonzero(value < last), np.flatnonzero(value == last)
        need = k - len(ahead)
        found += [ahead, ties[np.argpartition(name[ties], need - 1)[:need]]]
    return np.unique(np.concatenate(found))


def _block_edges(k: int, method: str, n: int):
    def edges(pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": [], "score": []})
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        sides = []
        for block in (i, j):
            rows = pdf[pdf["block"] == block]
            if not len(rows):
                return none
            names, f = np.unique(rows["feature"].to_numpy(dtype=str), return_inverse=True)
            first = rows.groupby("feature", sort=True)[["s", "ss"]].first()
            sides.append((rows.assign(f=f), names, first["s"].to_numpy(), first["ss"].to_numpy()))
        (left, a, sa, qa), (right, b, sb, qb) = sides
        names = np.unique(np.concatenate([a, b]))
        at_a, at_b = np.searchsorted(names, a), np.searchsorted(names, b)
        kept = [np.empty(0, dtype=np.int64), np.empty(0)]  # pairs of names as numbers, scores
        for x, y, p, low in _products(left, right.sort_values("sample", kind="stable"), i == j):
            if method == "bray":
                score = 2 * low / (sa[x] + sb[y])
            else:
                up = n * p - sa[x] * sb[y]
                down = np.sqrt(np.maximum((n * qa[x] - sa[x] ** 2) * (n * qb[y] - sb[y] ** 2), 0))
                score = np.divide(up, down, out=np.full(len(up), np.nan), where=down > 0)
            good = ~np.isnan(score)
            one, two = at_a[x[good]], at_b[y[good]]
            pair = np.minimum(one, two) * len(names) + np.maximum(one, two)
            kept = [np.concatenate(z) for z in zip(kept, (pair, score[good]))]
            chosen = _ends(kept[1], kept[0], k)
            kept = [z[chosen] for z in kept]
        return pd.DataFrame({"a": names[kept[0] // len(names)], "b": names[kept[0] % len(names)], "score": kept[1]})

    return edges


def cooccurrence(counts: DataFrame, k: int, method: str = "pearson", rows: int = ROWS) -> DataFrame:
    """(a, b, score, side): the k strongest and the k weakest edges between features (feature, sample, value).

    Values are shares of their sample. pearson; spearman (of ranks, ties by their
    mean); bray (1 less the distance). Samples where a feature is missing count as
    0, by sums over the samples where both are there and each one's own sums; so
    features without a common sample have an edge as well, the weakest of all for
    features that exclude each other. Equal scores (to 9 decimals) go by name.
    Features are dealt into blocks of about ``rows`` rows, those whose greatest
    sample is the same side by side. Blocks first look for edges within
    themselves and with their neighbours; what they find bounds which others have to meet. A pair of blocks
    is one group that keeps its own k at either end, so edges are never written or shuffled
    beyond these. A block has more rows only where one feature has (at most a row a sample).
    With over MANY_BLOCKS blocks whose features seldom meet, pairs with a common sample are made instead (``_sparse_edges``).
    """
    totals = counts.groupBy("sample").agg(F.sum("value").alias("__t"))
    x = counts.groupBy("feature", "sample").agg(F.sum("value").alias("value")).join(totals, "sample").select("feature", "sample", (F.col("value") / F.col("__t")).cast("double").alias("v"))
    x = materialize(x.where("feature IS NOT NULL AND v IS NOT NULL"), "shares")
    n, size = totals.count(), x.count()
    if method == "spearman":
        by = Window.partitionBy("feature").orderBy("v")
        rank, ties = F.rank().over(by), F.count("*").over(Window.partitionBy("feature", "v"))
        missing = F.lit(n) - F.count("*").over(Window.partitionBy("feature"))
        # Missing samples are ties at 0, before all others; shifted so that they count 0.
        x = x.select("feature", "sample", (rank + (ties - 1) / 2 + missing - F.when(missing > 0, (missing + 1) / 2).otherwise(0)).alias("v"))
    own = x.groupBy("feature").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("ss"), F.max_by("sample", F.struct("v", "sample")).alias("home"))
    spread = F.lit(1.0) if method == "bray" else F.sqrt(F.greatest(n * F.col("ss") - F.col("s") * F.col("s"), F.lit(0.0)))
    # A feature that is the same in all samples has no correlation.
    own = own.withColumn("d", spread).where(F.col("d") > 0)
    numbered = materialize(global_row_number(own, ["home", "feature"], "number"), "features")  # those with one greatest sample side by side
    features = numbered.count()
    a_block = max(1, rows * features // max(1, size))
    blocks = max(1, -(-features // a_block))
    own = numbered.withColumn("block", F.floor((F.col("number") - 1) / a_block).cast("int")).select("feature", "s", "ss", "d", "block")
    dealt = materialize(x.join(own, "feature").select("feature", F.xxhash64("sample").alias("sample"), "v", "s", "ss", "d", "block"), "dealt")
    if blocks > MANY_BLOCKS:
        edges = _sparse_edges(materialize(x, "ranks") if method == "spearman" else x, numbered, n, size, k, method)
        if edges is not None:
            return _both_ends(edges, k)
    found = _block_edges(k, method, n)
    # Each block by itself, with the one before and with the one after it.
    near = F.filter(F.array(*[F.struct(i.alias("i"), j.alias("j")) for i, j in ((F.col("block"), F.col("block")), (F.col("block") - 1, F.col("block")), (F.col("block"), F.col("block") + 1))]), lambda p: (p["i"] >= 0) & (p["j"] < blocks))
    edges = materialize(dealt.withColumn("p", F.explode(near)).select(*dealt.columns, "p.*").groupBy("i", "j").applyInPandas(found, _EDGE), "edges")
    if blocks > 2:
        pairs = _bounded_pairs(dealt, own, edges, blocks, n, k, method)
        asked = materialize(pairs.select("i", "j", F.explode(F.array("i", "j")).alias("block")), "pairs-of-blocks")
        edges = edges.unionByName(materialize(dealt.join(asked, "block").groupBy("i", "j").applyInPandas(found, _EDGE), "edges"))
    return _both_ends(edges, k)


def _both_ends(edges: DataFrame, k: int) -> DataFrame:
    best = edges.orderBy(F.desc(F.round("score", 9)), "a", "b").limit(k).withColumn("side", F.lit("top"))
    worst = edges.orderBy(F.round("score", 9), "a", "b").limit(k).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def _sparse_edges(x: DataFrame, own: DataFrame, n: int, size: int, k: int, method: str) -> DataFrame | None:
    """(a, b, score): edges that hold the k first and the k last, for features that mostly have no common sample; None where this can't tell.

    x: feature, sample, v; own: feature, s, d. Pairs with a common sample are made by a join on
    samples, if there are at most MOST_MET a row of x. The score of any other pair is
    -t * t of its two features (t: s / d; 0 for bray). None of these comes first where k
    met pairs are above the greatest of them. Those that come last hold the features whose t by the
    greatest t reaches the kth edge so far; if these are too many, they are alike, and the
    first by name decide.
    """
    met = x.groupBy("sample").agg(F.count("*").alias("c")).agg(F.sum(F.col("c") * (F.col("c") - 1) / 2)).first()[0] or 0
    if met > MOST_MET * size:
        return None
    t = F.lit(0.0) if method == "bray" else F.col("s") / F.col("d")
    features = materialize(global_row_number(own.select("feature", t.alias("t"), "s", "d"), ["feature"], "number"), "features-by-name")  # so numbers go in the order of names
    value = F.col("v") if method == "bray" else F.col("v") / F.col("d")
    told = x.join(features, "feature").select("sample", F.col("number").cast("long").alias("number"), value.alias("v"), F.col("s" if method == "bray" else "t").alias("w"))
    side = lambda i: told.select("sample", F.col("number").alias(i), F.col("v").alias(f"v_{i}"), F.col("w").alias(f"w_{i}"))
    both, of_two = (F.least("v_i", "v_j"), F.col("w_i") + F.col("w_j")) if method == "bray" else (F.col("v_i") * F.col("v_j"), F.col("w_i") * F.col("w_j"))
    pairs = side("i").join(side("j"), "sample").where("i < j").groupBy("i", "j").agg(F.sum(both).alias("p"), F.max(of_two).alias("w"))
    score = 2 * F.col("p") / F.col("w") if method == "bray" else n * F.col("p") - F.col("w")
    shared = materialize(pairs.select("i", "j", score.alias("score")), "met-pairs")
    place = F.round("score", 9)
    first = materialize(shared.orderBy(F.desc(place), "i", "j").limit(k), "first-edges")
    last = materialize(shared.orderBy(place, "i", "j").limit(k), "last-edges")
    known = first.agg(F.count("*").alias("n"), F.min(place).alias("o")).first()
    low = features.orderBy("t").limit(2).agg(F.min("t") * F.max("t")).first()[0]
    if known["n"] < k or known["o"] + low <= _SLACK:
        return None  # a pair without a common sample could be among the first
    top = features.agg(F.max("t")).first()[0]

    def apart(some: DataFrame, others: DataFrame) -> DataFrame:
        """The k last edges so far and those of pairs of ``some`` and ``others`` without a common sample. Both are few, or one is very few."""
        ends = lambda df, c: df.select(F.col("number").cast("long").alias(c), F.col("t").alias(f"t_{c}"))
        tried = F.broadcast(ends(some, "x")).crossJoin(ends(others, "y")).where("x <> y").select(F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), (-F.col("t_x") * F.col("t_y")).alias("score")).distinct()
        here = lambda c: shared.join(F.broadcast(some.select(F.col("number").cast("long").alias(c))), c, "left_semi").select("i", "j")
        near = here("i").unionByName(here("j"))
        found = last.unionByName(tried.join(near, ["i", "j"], "left_anti")).distinct()
        return materialize(found.orderBy(place, "i", "j").limit(k), "last-edges")

    def kth() -> tuple[float, int] | None:
        row = last.agg(F.count("*").alias("n"), F.max(F.struct(place.alias("o"), "i")).alias("m")).first()
        return (-row["m"]["o"], row["m"]["i"]) if row["n"] == k else None

    def reach(least: float) -> DataFrame:
        return features.where(F.col("t") * top >= least)

    some = materialize(features.orderBy(F.desc("t"), "number").limit(FEW), "greatest")
    last = apart(some, some)
    if (end := kth()) is None:
        return None
    wanted = materialize(reach(end[0] - _SLACK), "reaching")
    if wanted.count() <= MOST_TRIED:
        last = apart(wanted, wanted)
    else:
        ahead = materialize(wanted.orderBy("number").limit(FEW // 16), "first-by-name")
        last = apart(ahead, wanted)
        end = kth()
        # Pairs of the others come later where they are equal; they could still be below.
        beyond = materialize(reach(end[0] + _SLACK / 8), "below")
        if end[1] > ahead.agg(F.max("number")).first()[0] or beyond.count() > MOST_TRIED:
            return None
        last = apart(beyond, beyond)
    # _both_ends takes the first of first and the last of last again.
    name = lambda c: features.select(F.col("number").cast("long").alias(c), F.col("feature").alias({"i": "a", "j": "b"}[c]))
    return materialize(first.unionByName(last).distinct().join(name("i"), "i").join(name("j"), "j").select("a", "b", "score"), "edges")


def _bounded_pairs(dealt: DataFrame, own: DataFrame, diagonal: DataFrame, blocks: int, n: int, k: int, method: str) -> DataFrame:
    """(i, j): pairs of blocks that can hold one of the k first or last edges, given those within blocks and between neighbours.

    A block's shape is the greatest value that any of its features has in each sample. A
    product (or minimum) of two features is at most that of the shapes, which bounds
    their score from above; a product is at least 0, which bounds it from below. Pairs
    that can only reach what k edges have already reached stay if a name could come first.
    """
    order = lambda side: [F.desc("o"), "a", "b"] if side == "top" else ["o", "a", "b"]
    kth = {}
    for side in ("top", "bottom"):
        rows = diagonal.withColumn("o", F.round("score", 9)).orderBy(*order(side)).select("o", "a").limit(k).collect()
        kth[side] = (rows[-1]["o"], rows[-1]["a"]) if len(rows) == k else None
    value = F.col("v") if method == "bray" else F.col("v") / F.col("d")
    shape = materialize(dealt.groupBy("block", "sample").agg(F.max(value).alias("m")), "shapes")
    ends = materialize(own.groupBy("block").agg(F.min("feature").alias("least"), F.min(F.col("s") / F.col("d")).alias("t_low"), F.max(F.col("s") / F.col("d")).alias("t_high"), F.min("s").alias("s_low")), "block-ends")
    side = lambda name: shape.select("sample", F.col("block").alias(name), F.col("m").alias(f"m_{name}"))
    both = F.least("m_i", "m_j") if method == "bray" else F.col("m_i") * F.col("m_j")
    met = side("i").join(side("j"), "sample").where("i + 1 < j").groupBy("i", "j").agg(F.sum(both).alias("most"))
    told = lambda name: ends.select(F.col("block").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("least", "t_low", "t_high", "s_low")])
    ids = dealt.sparkSession.range(blocks * blocks).select(F.floor(F.col("id") / blocks).cast("int").alias("i"), (F.col("id") % blocks).cast("int").alias("j")).where("i + 1 < j")
    every = ids.join(told("i"), "i").join(told("j"), "j").join(met, ["i", "j"], "left").withColumn("most", F.coalesce("most", F.lit(0.0)))
    if method == "bray":
        high, low = 2 * F.col("most") / (F.col("s_low_i") + F.col("s_low_j")), F.lit(0.0)
    else:
        high, low = n * F.col("most") - F.col("t_low_i") * F.col("t_low_j"), -F.col("t_high_i") * F.col("t_high_j")
    first = F.least("least_i", "least_j")

    def reaches(bound, last: tuple[float, str] | None):
        if last is None:
            return F.lit(True)
        ahead = bound - last[0]  # above 0: better than the kth
        return (ahead > _SLACK) | ((ahead >= -_SLACK) & (first <= last[1]))

    bottom = None if kth["bottom"] is None else (-kth["bottom"][0], kth["bottom"][1])
    return every.where(reaches(high, kth["top"]) | reaches(-low, bottom)).select("i", "j")


def simplify_edges(edges: DataFrame) -> DataFrame:
    """Undirected edges (src, dst, weight) once each, with the greatest weight, without loops."""
    return edges.where("src <> dst").groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.max("weight").alias("weight"))


def _put(keys: np.ndarray) -> bytes:
    """Whole numbers in order as their differences, byte by byte, packed; ``_taken`` gives them back."""
    steps = np.diff(keys, prepend=0)
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _taken(data: bytes, n: int) -> np.ndarray:
    held = np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(held.reshape(8, n).T).view(np.int64).ravel())


def _packed(batches: Iterator[pa.RecordBatch], groups: int, nodes: int) -> Iterator[pa.RecordBatch]:
    """Edges (lo, hi) as rows (a, b, n, data) for the groups of lo and hi: about three bytes an edge."""
    span, held, size = nodes // groups + 1, [], 0

    def told():
        lo, hi = (np.concatenate([h[e] for h in held]) for e in (0, 1))
        block = lo % groups * groups + hi % groups
        order = np.argsort(block, kind="stable")
        at = np.searchsorted(block[order], np.arange(groups * groups + 1))
        keys = (lo // groups * span + hi // groups)[order]
        for k in np.flatnonzero(np.diff(at)).tolist():
            own = np.sort(keys[at[k] : at[k + 1]])
            yield pa.RecordBatch.from_pylist([{"a": k // groups, "b": k % groups, "n": len(own), "data": _put(own)}], pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("data", pa.binary())]))

    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(c).to_numpy() for c in (0, 1)])
            size += batch.num_rows
        if size >= _PACK:
            yield from told()
            held, size = [], 0
    if held:
        yield from told()


def _closed(table: pa.Table, groups: int, nodes: int) -> pa.Table:
    """(lo, hi, n): in how many triangles each edge is whose nodes lie in the three groups of nodes of this table.

    Each triangle u < v < w is found from its edge u-v, by the later neighbours w of u, and looked up as v-w.
    """
    at, span = table["three"][0].as_py(), nodes // groups + 1
    three = sorted((at // (groups * groups), at // groups % groups, at % groups))
    own = np.array(sorted(set(three)))
    place = {x: i for i, x in enumerate(own.tolist())}
    # A node is known by its group's place here and its number there; edges by both nodes, in order of u, the neighbour's group and the neighbour.
    all_ = len(own) * span
    keys, upto = np.empty(sum(table["n"].to_pylist()), np.int64), 0
    for x, y, n, data in zip(*(table[c] for c in ("a", "b", "n", "data"))):
        part = _taken(data.as_py(), n.as_py())
        keys[upto : (upto := upto + len(part))] = (place[x.as_py()] * span + part // span) * all_ + place[y.as_py()] * span + part % span
    keys.sort()
    found = np.zeros(len(keys), np.int64)
    number = lambda node: node % span * groups + own[node // span]
    spot = [place[x] for x in three]
    for a, b, c in {(spot[x], spot[y], spot[z]) for x, y, z in ((0, 1, 2), (1, 0, 2), (2, 0, 1))}:
        # u in a, one neighbour in b, the other in c; b <= c, so neither pair comes twice.
        first, last = np.searchsorted(keys, [a * span * all_, (a + 1) * span * all_])
        for start in range(first, last, _PACK):
            head = keys[start : min(start + _PACK, last)]
            mine = np.flatnonzero(head % all_ // span == b)
            heads, lo = mine + start, head[mine] // all_ * all_
            begin = heads + 1 if b == c else np.searchsorted(keys, lo + c * span, "left")
            size = np.searchsorted(keys, lo + (c + 1) * span, "left") - begin
            total, done = np.cumsum(size), 0
            while done < len(heads):
                to = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + _CELLS, side="right")))
                s = size[done:to]
                one = np.repeat(heads[done:to], s)
                two = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s) + np.repeat(begin[done:to], s)
                v, w = keys[one] % all_, keys[two] % all_
                swap = number(v) > number(w)
                third = np.where(swap, w, v) * all_ + np.where(swap, v, w)
                met = np.minimum(np.searchsorted(keys, third), len(keys) - 1)
                hit = keys[met] == third
                for e in (one[hit], two[hit], met[hit]):
                    edge, times = np.unique(e, return_counts=True)
                    found[edge] += times
                done = to
    some = np.flatnonzero(found)
    lo, hi = number(keys[some] // all_), number(keys[some] % all_)
    return pa.table({"lo": lo, "hi": hi, "n": found[some]})


def common_neighbours(edges: DataFrame, nodes: int, rows: int = TASK_EDGES) -> DataFrame:
    """(lo, hi, common): how many common neighbours the ends of each edge (lo < hi, numbers up to ``nodes``, once each) have, where there are any.

    Nodes are dealt into g groups and each edge goes to the g threes of groups that hold
    it; a task counts the triangles of one three and gives a number an edge. So g times the edges
    move, whatever the number of paths, with g such that a task has about ``rows`` edges; they move
    packed, many a row.
    """
    n = edges.count()
    groups = max(1, math.ceil(math.sqrt(6 * n / rows)) if n > rows else 1, LEAST_GROUPS if n > FEW_EDGES else 1)
    packed = edges.select("lo", "hi").mapInArrow(lambda batches: _packed(batches, groups, nodes), "a long, b long, n long, data binary")
    a, b, c = F.col("a"), F.col("b"), F.col("id")
    three = F.array_sort(F.array(a, b, c))
    told = F.element_at(three, 1) * groups * groups + F.element_at(three, 2) * groups + F.element_at(three, 3)
    dealt = packed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("id")).select("a", "b", "n", "data", told.alias("three"))
    threes = groups * (groups + 1) * (groups + 2) // 6
    found = dealt.repartition(spread(edges.sparkSession, threes), "three").groupBy("three").applyInArrow(lambda t: _closed(t, groups, nodes), "lo long, hi long, n long")
    return found.groupBy("lo", "hi").agg(F.sum("n").alias("common"))


def edge_stats(edges: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """Simplified edges with the degrees of both ends, their common neighbours and Dice similarity; ``known``: both ends are in ``valid`` (node).

    Each step is written and what it shuffled let go, so disk holds one step's shuffles at a time.
    """
    spark = edges.sparkSession
    simple = materialize(simplify_edges(edges), "simple-edges")
    release(spark)
    degree = simple.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    # Nodes of few edges first: an edge leads to the node of more, so no node has many later neighbours.
    numbered = materialize(global_row_number(degree, ["degree", "node"], "number"), "numbered-nodes")
    nodes = numbered.count()
    release(spark)
    ends = lambda e: numbered.select(F.col("node").alias(e), F.col("degree").alias(f"{e}_degree"), F.col("number").cast("long").alias(f"__{e}"))
    both = simple.join(ends("src"), "src").join(ends("dst"), "dst")
    edge = lambda lo, hi: lo * F.lit(nodes + 1).cast("long") + hi
    out = materialize(both.withColumn("edge", edge(F.least("__src", "__dst"), F.greatest("__src", "__dst"))).drop("__src", "__dst"), "numbered-edges")
    release(spark)
    shared = common_neighbours(out.select(F.expr(f"edge div {nodes + 1}L").alias("lo"), F.expr(f"edge % {nodes + 1}L").alias("hi")), nodes)
    shared = materialize(shared.select(edge(F.col("lo"), F.col("hi")).alias("edge"), "common"), "common-neighbours")
    release(spark)
    out = out.join(shared, "edge", "left").withColumn("common", F.coalesce("common", F.lit(0).cast("bigint")))
    out = out.select("src", "dst", "weight", "src_degree", "dst_degree", "common", (2 * F.col("common") / (F.col("src_degree") + F.col("dst_degree"))).alias("dice"))
    if valid is None:
        return out
    seen = valid.select("node").distinct()
    a, b = (seen.select(F.col("node").alias(e), F.lit(True).alias(f"__{e}")) for e in ("src", "dst"))
    return out.join(a, "src", "left").join(b, "dst", "left").withColumn("known", F.col("__src").isNotNull() & F.col("__dst").isNotNull()).drop("__src", "__dst")


def node_stats(edges: DataFrame, kinds: dict[str, str], other: str, valid: DataFrame | None = None) -> DataFrame:
    """(node, degree, kind, status): the nodes of the simplified edges; a node's kind is the first whose regex finds something in its name, else ``other``; status: Y for nodes of ``valid`` (node), else N."""
    simple = simplify_edges(edges)
    ends = simple.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    kind = F.coalesce(*[F.when(F.regexp_like(F.col("node").cast("string"), F.lit(p)), F.lit(n)) for n, p in kinds.items()], F.lit(other))
    if valid is None:
        return ends.select("node", "degree", kind.alias("kind"), F.lit("N").alias("status"))
    listed = valid.select(F.col("node").alias("__valid")).distinct()
    return ends.join(listed, ends["node"] == listed["__valid"], "left").select("node", "degree", kind.alias("kind"), F.when(F.col("__valid").isNotNull(), "Y").otherwise("N").alias("status"))
