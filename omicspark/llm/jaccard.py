"""SimHash near-dedup by similarity: texts whose sets of 5-word shingles have a Jaccard similarity of at least 0.8.

Candidates come from two searches. Operator 2's: SimHash fingerprints of the
shingles that differ in few bits, through Golay keys. They reach only part of the
pairs at 0.8, which differ in some ten of 64 bits, so MinHash finds the rest: 32
bands of 5 minima. Two texts with a similarity of 0.8 share a band with a probability
of 1 - (1 - 0.8**5)**32 = 0.999997, more above 0.8. Candidates form coarse components.
Within each, similarity is counted exactly on the shingles, so no link is ever a
guess: a breadth-first search over an inverted index of the shingles gives a
spanning forest of the links.
A component with more than ``BLOCK`` shingles is dealt as blocks, and texts of
different blocks meet unless they are known to be of one group, so none is cut
short and a large group of copies is not compared with itself.
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

from omicspark.llm import simhash
from omicspark.llm.rows import keep_rows, one_a_key, row_key
from omicspark.llm.simhash import near_links
from omicspark.operators.components import connected_components
from omicspark.storage import bound_batches, materialize

SHINGLE = 5
SEED = 42
# A similarity of at least PART / WHOLE links two texts.
PART, WHOLE = 4, 5
BANDS, ROWS = 32, 5
BLOCK = 1 << 17
_CHUNK = 1 << 11


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; none without words. Fewer words than a shingle: they are one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) > SHINGLE else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype=np.uint64))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 31, (BANDS * ROWS, 1), dtype=np.uint32) << 1 | np.uint32(1), rng.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)


_TIMES, _PLUS = _permutations()


def band_keys(found: np.ndarray) -> list[int]:
    """One key a band of a set of shingles; none for an empty set."""
    if not len(found):
        return []
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), _CHUNK):
        np.minimum(low, (short[None, at : at + _CHUNK] * _TIMES + _PLUS).min(axis=1), out=low)
    low = low.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(low[band].tobytes(), band) - (1 << 63) for band in range(BANDS)]


_SKETCH = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("print", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])


@F.arrow_udf(_SKETCH)
def _sketch(texts: pa.Array) -> pa.Array:
    sets = [shingles(t) for t in texts.to_pylist()]
    return pa.StructArray.from_arrays(
        [
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([simhash.of_hashes(s) for s in sets], pa.int64()),
            pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())),
        ],
        ["digest", "size", "print", "bands"],
    )


@F.arrow_udf(T.BinaryType())
def _set_bytes(texts: pa.Array) -> pa.Array:
    return pa.array([shingles(t).tobytes() for t in texts.to_pylist()], pa.binary())


def _first_of_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, node): each node with the first of its key, but for the first itself."""
    last_key = last_low = None
    for batch in batches:
        keys, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(keys):
            continue
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        starts = np.flatnonzero(new)
        lows = nodes[starts]
        if keys[0] == last_key:
            lows[0] = last_low
        low = lows[np.cumsum(new) - 1]
        last_key, last_low = keys[-1], low[-1]
        use = nodes != low
        if use.any():
            yield pa.RecordBatch.from_arrays([pa.array(nodes[use]), pa.array(low[use])], ["src", "dst"])


def forest(nodes: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the texts that are similar enough, by exact counts of common shingles."""
    n = len(nodes)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(ids, kind="stable")
    post = owner[order]
    heads = np.concatenate([[0], np.cumsum(np.bincount(ids))])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    left = np.ones(n, dtype=bool)
    src, dst = [], []
    for start in range(n):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue and left.any():
            u = queue.pop()
            own = ids[ends[u] : ends[u + 1]]
            at, length = heads[own], heads[own + 1] - heads[own]
            if not length.size:
                continue
            places = np.repeat(at - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
            common = np.bincount(post[places], minlength=n)
            hit = np.flatnonzero(left & ((PART + WHOLE) * common >= PART * (sizes + sizes[u])))
            left[hit] = False
            src += [u] * len(hit)
            dst += hit.tolist()
            queue += hit.tolist()
    return nodes[np.array(src, dtype=np.int64)], nodes[np.array(dst, dtype=np.int64)]


def _link(pdf: pd.DataFrame) -> pd.DataFrame:
    """Verified links among the texts of a component, of a block or of two blocks."""
    src, dst = forest(pdf["node"].to_numpy(), [np.frombuffer(s, dtype=np.uint64) for s in pdf["shingles"]])
    return pd.DataFrame({"src": src, "dst": dst})


def _near_prints(nodes: DataFrame) -> DataFrame:
    """(src, dst): nodes (node, print) with one fingerprint, or with two that differ in few bits."""
    prints = materialize(nodes.groupBy("print").agg(F.min("node").alias("low")), "prints")
    same = nodes.select("print", "node").join(prints.hint("merge"), "print").where("node <> low").select(F.col("node").alias("src"), F.col("low").alias("dst"))
    near = near_links(prints, "print")
    a, b = (prints.select(F.col("print").alias(side), F.col("low").alias(end)) for side, end in (("a", "src"), ("b", "dst")))
    return same.unionByName(near.join(a.hint("merge"), "a").join(b.hint("merge"), "b").select("src", "dst"))


def _dealt(members: DataFrame, by: list[str], name: str) -> DataFrame:
    """``members`` with ``blocks``, how many blocks of BLOCK shingles their group (columns ``by``) makes, and ``block``, theirs."""
    blocks = members.groupBy(*by).agg(F.greatest(F.ceil(F.sum("size") / F.lit(BLOCK)), F.lit(1)).cast("int").alias("blocks"))
    return materialize(members.join(blocks, by).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), name)


def _met(rows: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Links found where blocks meet. rows: node, shingles, component, block; pairs: component, block, other, each pair both ways."""
    met = rows.join(pairs, ["component", "block"]).select("node", "shingles", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return materialize(met.groupBy("component", "i", "j").applyInPandas(_link, "src long, dst long"), name)


def _all_pairs(dealt: DataFrame) -> DataFrame:
    return dealt.select("component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).distinct()


def _large_links(own: DataFrame) -> DataFrame:
    """Links within components of several blocks: own: node, size, shingles, component, block.

    First each block by itself, then one text of each group so found with those of
    the other blocks: a large group of copies is one group from then on. Where a
    component is not one group, its texts meet once more but for those of one group,
    so work grows with a large group, not with its square.
    """
    within = materialize(own.groupBy("component", "block").applyInPandas(_link, "src long, dst long"), "links-within")
    first = materialize(connected_components(within, "src", "dst"), "first-groups")
    led = own.join(first.where("node <> component").select("node").hint("merge"), "node", "left_anti")
    leaders = _dealt(led.select("node", "component", "size"), ["component"], "leaders")
    across = _met(led.drop("block").join(leaders.select("node", "block").hint("merge"), "node"), _all_pairs(leaders), "links-across")
    links = within.unionByName(across)
    groups = materialize(connected_components(links, "src", "dst").withColumnRenamed("component", "fine"), "groups")
    named = materialize(own.select("node", "component", "size").join(groups.hint("merge"), "node", "left").withColumn("fine", F.coalesce("fine", "node")), "named")
    several = named.groupBy("component").agg(F.min("fine").alias("lo"), F.max("fine").alias("hi")).where("lo <> hi").select("component")
    edge = materialize(named.join(several, "component", "left_semi"), "several-groups")
    if edge.isEmpty():
        return links
    # A group that fills a block has blocks of its own; the others of a component share blocks.
    sized = edge.join(edge.groupBy("fine").agg(F.sum("size").alias("whole")), "fine")
    dealt = _dealt(sized.withColumn("part", F.when(F.col("whole") >= BLOCK, F.col("fine")).otherwise(-1)), ["component", "part"], "edge-blocks")
    named_blocks = dealt.select("node", "component", F.when(F.col("part") >= 0, F.col("part")).alias("part"), F.xxhash64("part", "block").alias("block"))
    blocks = materialize(named_blocks.select("component", "block", "part").distinct(), "blocks")
    other = blocks.select("component", F.col("block").alias("other"), F.col("part").alias("other_part"))
    pairs = blocks.join(other, "component").where("part IS NULL OR other_part IS NULL OR part <> other_part").select("component", "block", "other")
    return links.unionByName(_met(own.select("node", "shingles").join(named_blocks.select("node", "component", "block").hint("merge"), "node"), pairs, "links-between"))


def _verified(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(src, dst): links among the nodes of each coarse component. texts: key, text; members: key, node, size, component."""
    dealt = _dealt(members, ["component"], "dealt")
    # The members grow with the table, so they are no side to broadcast.
    own = one_a_key(texts, "key", []).join(dealt.hint("merge"), "key").select("node", "component", "size", "blocks", "block", _set_bytes(F.col("text")).alias("shingles"))
    if dealt.where("blocks > 1").isEmpty():
        return materialize(own.groupBy("component").applyInPandas(_link, "src long, dst long"), "links")
    own = materialize(own, "shingles")
    small = materialize(own.where("blocks = 1").groupBy("component").applyInPandas(_link, "src long, dst long"), "links")
    return small.unionByName(_large_links(own.where("blocks > 1").drop("blocks")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, that come first in their group: smallest id, nulls last.

    A group is what links of a similarity of at least PART / WHOLE reach. Texts are
    read as bytes, ASCII letters in lower case, words by white space; null counts as
    empty, and texts without words are alike. Of rows with equal ids in a group one stays.
    ``docs`` is read three times; rows are known by their ids and texts, so it may be
    shuffled otherwise each time. Columns may have any names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.col(text_col).cast("binary")
    sketched = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), _sketch(text).alias("s"))
    rows = materialize(sketched.select("key", "id", "s.*").withColumn("uid", F.monotonically_increasing_id()), "sketches")
    # Texts with the same shingles are one node: the smallest row number among them.
    low = F.min(F.struct(F.col("id").isNull().alias("missing"), F.col("id"), F.col("uid")))
    nodes = materialize(rows.groupBy("digest").agg(F.min("uid").alias("node"), low.alias("low"), F.min("print").alias("print")), "nodes")
    first = rows.join(nodes.select(F.col("node").alias("uid")).hint("merge"), "uid", "left_semi")
    keyed = first.select(F.explode("bands").alias("band"), F.col("uid").alias("node"))
    shared = keyed.repartition("band").sortWithinPartitions("band", "node").mapInArrow(_first_of_key, "src long, dst long")
    coarse = materialize(connected_components(shared.unionByName(_near_prints(nodes)), "src", "dst"), "coarse")
    members = materialize(coarse.join(rows.select(F.col("uid").alias("node"), "key", "size").hint("merge"), "node"), "members")
    links = _verified(docs.select(row_key(id_col, text_col).alias("key"), text.alias("text")), members)
    roots = connected_components(links, "src", "dst")
    rooted = nodes.join(roots.hint("merge"), "node", "left").select("low", F.coalesce("component", "node").alias("root"))
    stay = materialize(rooted.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.uid").alias("uid")), "stay")
    chosen = rows.select("uid", "key").join(stay.hint("merge"), "uid", "left_semi")
    return keep_rows(docs, chosen, id_col, text_col)
