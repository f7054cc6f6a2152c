"""SimHash near-duplicates: fingerprints joined through Golay keys of their segments.

A fingerprint's 64 bits fall into segments of 22, 21 and 21 bits. If two
fingerprints differ in at most 4 bits, the two segments with the fewest
differences have at most 2 together, so either

* one segment P is equal and another, Q, differs in at most two bits: they share
  (P itself, a near key of Q); or
* two segments differ in one bit each. Then their parities differ in both
  segments, and the one whose segment has even parity gives the key of its own
  codeword there, the other all near keys: they share one.

That is about 62 keys of 25 to 35 bits a fingerprint. Only distinct fingerprints
get keys. Rows that share a key meet in one place, where the distance is
verified; a bucket of many rows is linked by a breadth-first search that gives a
spanning forest, never all pairs, and a bucket over ``BUCKET`` rows is dealt
again as pairs of blocks, so no bucket is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from omicspark.llm import golay
from omicspark.llm.rows import keep_rows, row_key
from omicspark.operators.components import connected_components
from omicspark.storage import materialize, spread

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
BUCKET = 1 << 16
_FEW = 8
_ROWS = 4096


def of_hashes(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes, as a signed integer; zero without hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash as a signed integer; zero without words. Fewer words than a shingle: they are one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    return of_hashes(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8"))


@F.pandas_udf(T.LongType())
def _simhash_column(texts: pd.Series) -> pd.Series:
    return pd.Series([simhash(t) for t in texts], dtype="int64")


def fingerprint(text) -> F.col:
    """The SimHash of a text column as a long; its bytes are read as they are, null counts as empty."""
    return _simhash_column(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"))


def _parity(words: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(words) & 1).astype(bool)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of the fingerprint) rows of an array of fingerprints."""
    bits = prints.astype(np.int64).view(np.uint64)
    parts = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [golay.near_keys(p, n) for p, (_, n) in zip(parts, SEGMENTS)]
    own = [golay.key(p) for p in parts]
    odd = [_parity(p) for p in parts]
    keys, rows, table = [], [], 0
    for p in range(3):
        for q in range(3):
            if p != q:
                at, col = np.nonzero(near[q][1])
                keys.append((((table << 22) | parts[p][at]) << 12) | near[q][0][at, col])
                rows.append(at)
                table += 1
    for p, q in ((0, 1), (0, 2), (1, 2)):
        # The near keys of an odd segment, the own key of an even one.
        one = [np.where(odd[s][:, None], near[s][0], own[s][:, None]) for s in (p, q)]
        use = []
        for s in (p, q):
            m = near[s][1].copy()
            m[~odd[s]] = False
            m[~odd[s], 0] = True
            use.append(m)
        at, i = np.nonzero(use[0])
        inner = use[1][at]
        r, j = np.nonzero(inner)
        doc = at[r]
        mixed = (odd[p] ^ odd[q])[doc].astype(np.int64)
        keys.append((((((table << 1) | mixed) << 12 | one[0][doc, i[r]]) << 12) | one[1][doc, j]))
        rows.append(doc)
        table += 1
    return np.concatenate(keys), np.concatenate(rows)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), _ROWS):
            part = prints[at : at + _ROWS]
            keys, rows = keys_of(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "print"])


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= MAX_BITS


def _search(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    left, src, dst = prints, [], []
    while len(left):
        queue, left = [left[:1]], left[1:]
        while queue and len(left):
            block = queue.pop()
            for u in block:
                hit = _near(left, u)
                if hit.any():
                    found = left[hit]
                    src.append(found)
                    dst.append(np.full(len(found), u))
                    queue.append(found)
                    left = left[~hit]
                    if not len(left):
                        break
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(src), np.concatenate(dst)) if src else (none, none)


def _bucket_edges(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within the buckets of sorted keys; of large buckets a spanning forest."""
    starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    src, dst = [], []
    for start, n in zip(starts[sizes > _FEW].tolist(), sizes[sizes > _FEW].tolist()):
        s, d = _search(prints[start : start + n])
        src.append(s)
        dst.append(d)
    few = np.repeat(sizes <= _FEW, sizes)
    k, f = keys[few], prints[few]
    for shift in range(1, _FEW):
        same = np.flatnonzero(k[shift:] == k[:-shift])
        if not len(same):
            break
        same = same[_near(f[same], f[same + shift])]
        src.append(f[same + shift])
        dst.append(f[same])
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(src), np.concatenate(dst)) if src else (none, none)


def _forest(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) of a set of edges."""
    if not len(src):
        return src, dst
    nodes, ends = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = ends[: len(src)], ends[len(src) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all() and (label[a] == label[b]).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def _links(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, dtype=np.int8)), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], ["kind", "a", "b"])


def _link_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: links (kind 0), and the rows (key, fingerprint) of buckets over BUCKET (kind 1)."""
    keys = prints = np.empty(0, dtype=np.int64)
    hot, src, dst, held = None, [], [], 0
    for batch in batches:
        k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if hot is not None:
            n = int(np.searchsorted(k, hot, side="right"))
            yield _links(1, k[:n], f[:n])
            k, f = k[n:], f[n:]
            if not len(k):
                continue
            hot = None
        keys, prints = np.concatenate([keys, k]), np.concatenate([prints, f])
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if cut:
            s, d = _bucket_edges(keys[:cut], prints[:cut])
            src.append(s)
            dst.append(d)
            held += len(s)
            keys, prints = keys[cut:], prints[cut:]
        if len(keys) > BUCKET:
            yield _links(1, keys, prints)
            hot, keys, prints = keys[-1], keys[:0], prints[:0]
        if held > 1 << 20:
            yield _links(0, *_forest(np.concatenate(src), np.concatenate(dst)))
            src, dst, held = [], [], 0
    if len(keys):
        s, d = _bucket_edges(keys, prints)
        src.append(s)
        dst.append(d)
    if src:
        yield _links(0, *_forest(np.concatenate(src), np.concatenate(dst)))


def _link_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links among the rows of two blocks of one bucket."""
    src, dst = _forest(*_search(pdf["b"].drop_duplicates().to_numpy()))
    return pd.DataFrame({"a": src, "b": dst})


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Deal buckets over BUCKET rows as pairs of blocks: every two rows meet, at most about 2 * BUCKET at a time."""
    sized = rows.groupBy("a").agg(F.ceil(F.count("*") / F.lit(BUCKET // 2)).cast("int").alias("blocks"))
    own = rows.join(sized, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("a", "b", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return met.groupBy("a", "i", "j").applyInPandas(_link_blocks, "a long, b long")


def near_links(prints: DataFrame, col: str = "fingerprint") -> DataFrame:
    """(a, b): pairs of distinct values of ``col`` that differ in at most MAX_BITS bits, enough of them to link all that are.

    Nulls are ignored, repeated values count once, no links give no rows.
    """
    distinct = prints.where(F.col(col).isNotNull()).select(F.col(col).alias("print")).distinct()
    keyed = distinct.repartition(spread(prints.sparkSession), "print").mapInArrow(_emit_keys, "key long, print long")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    found = materialize(dealt.mapInArrow(_link_buckets, "kind byte, a long, b long"), "links")
    links = found.where("kind = 0").select("a", "b")
    large = found.where("kind = 1").select("a", "b")
    if not large.isEmpty():
        links = links.unionByName(materialize(_block_pairs(large), "links"))
    return links


def near_duplicates(prints: DataFrame, col: str = "fingerprint") -> DataFrame:
    """(print, root): for each fingerprint of ``col`` that has a link, the smallest of its component."""
    return connected_components(near_links(prints, col), "a", "b").select(F.col("node").alias("print"), F.col("component").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long, component_id): one row for each row of ``docs``.

    component_id is the smallest id reachable over links, the row's own included.
    Null and empty texts have fingerprint zero and link like others. Rows with a
    null id keep their row; their id is no candidate for the smallest. Repeated
    rows stay repeated. An empty table gives no rows. Other columns are ignored.
    """
    prints = materialize(docs.select(F.col(id_col), fingerprint(text_col).alias("fingerprint")), "prints")
    lowest = prints.groupBy("fingerprint").agg(F.min(id_col).alias("low"))
    roots = materialize(near_duplicates(prints), "roots")
    rooted = materialize(lowest.join(roots, lowest["fingerprint"] == roots["print"], "left").select("fingerprint", "low", F.coalesce("root", "fingerprint").alias("root")), "rooted")
    by_root = materialize(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "by_root")
    named = materialize(rooted.join(by_root, "root").select(F.col("fingerprint").alias("print"), "component_id"), "named")
    return prints.join(named, prints["fingerprint"] == named["print"], "left").select(id_col, "fingerprint", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, that come first in their component: smallest id, nulls last.

    Of rows with equal ids and linked or equal fingerprints one stays. Only ids
    and fingerprints take part in the search; the texts move once, to be joined
    with the rows that stay. ``docs`` is read twice; rows are known by their ids and
    texts, so it may be shuffled otherwise each time.
    """
    numbered = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), fingerprint(text_col).alias("fingerprint"))
    prints = materialize(numbered, "prints")
    low = F.min(F.struct(F.col("id").isNull().alias("missing"), F.col("id"), F.col("key")))
    lowest = prints.groupBy("fingerprint").agg(low.alias("low"))
    roots = materialize(near_duplicates(prints), "roots")
    rooted = lowest.join(roots, lowest["fingerprint"] == roots["print"], "left").select("low", F.coalesce("root", "fingerprint").alias("root"))
    stay = materialize(rooted.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.key").alias("key")), "stay")
    return keep_rows(docs, stay, id_col, text_col)
