"""A Merkle manifest of a dataset by time-forward processing, with a proof for every row.

Nodes are labelled so that each comes after its children, and messages go forward
in the order of labels. Within a block of leaves a priority queue delivers child
digests to parents: the nodes come in order of their labels, each takes the messages
with its own label off the queue and sends its digest on. Messages beyond the
block are the rows of the next table, which is numbered and dealt into blocks in turn:
the part of the queue that is not in memory. Then the sweep is reversed: parents
send what is above them, as the rest of a proof, to their children, block by block down
to the leaves. A block has 4096 leaves and its queue seven messages a level, so a task holds
little however many rows there are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omicspark.operators.ranks import numbers_within
from omicspark.storage import materialize

RUN = 8
LEVELS = 4  # of a block

Proof = tuple  # ((place in the run, digests before it, digests after it), rest of the proof), or () at the root


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    found = 0
    while n > 1:
        n, found = -(-n // RUN), found + 1
    return found


def sweep_up(leaves: Iterable[str], levels: int) -> Iterator[tuple[int, int, list[str], str]]:
    """(level, number, children, digest) of the nodes above leaves, parents after children, by a priority queue.

    A node's label is (its last leaf, its level): children have smaller ones. The
    end of the leaves closes runs that are not full.
    """
    queue: list[tuple[tuple[int, int], int, int, str]] = []  # label of the receiver, its number, number of the sender, digest

    def send(level: int, number: int, found: str) -> None:
        if level < levels:
            parent = number // RUN
            heapq.heappush(queue, (((parent + 1) * RUN ** (level + 1) - 1, level + 1), parent, number, found))

    def deliver(upto: int) -> Iterator[tuple[int, int, list[str], str]]:
        while queue and queue[0][0][0] <= upto:
            label, number = queue[0][:2]
            children = []
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[3])
            found = digest(*children)
            yield label[1], number, children, found
            send(label[1], number, found)

    for i, leaf in enumerate(leaves):
        send(0, i, leaf)
        yield from deliver(i)
    yield from deliver(1 << 62)


def sweep_down(leaves: list[str], levels: int, above: Proof) -> list[Proof]:
    """The proof of each leaf: the same nodes in reversed order, each sending the rest of a proof to its children."""
    nodes = list(sweep_up(leaves, levels))
    queue: list[tuple[tuple[int, int], Proof]] = []
    label = lambda level, number: (-((number + 1) * RUN**level - 1), -level)
    for level, number, _, _ in nodes:
        if level == levels:
            heapq.heappush(queue, (label(level, number), above))
    found: list[Proof] = [above] * len(leaves)
    for level, number, children, _ in reversed(nodes):
        own, rest = heapq.heappop(queue)
        assert own == label(level, number)
        for at in range(len(children)):
            proof = ((at, children[:at], children[at + 1 :]), rest)
            child = number * RUN + at
            if level == 1:
                found[child] = proof
            else:
                heapq.heappush(queue, (label(level - 1, child), proof))
    return found


def steps(proof: Proof) -> Iterator[tuple[int, list[str], list[str]]]:
    while proof:
        step, proof = proof
        yield step


def folded(leaf: str, proof: Proof) -> str:
    """The root that a leaf and its proof give."""
    for _, before, after in steps(proof):
        leaf = digest(*before, leaf, *after)
    return leaf


def siblings(proof: Proof) -> str:
    return "".join(["".join(before) + "".join(after) for _, before, after in steps(proof)])


def written(proof: Proof) -> str:
    """A proof as text: (place in its run, digests of the others) of each level."""
    return " ".join(f"{at}:{''.join(before)}{''.join(after)}" for at, before, after in steps(proof))


def read(text: str) -> Proof:
    proof: Proof = ()
    for step in reversed(text.split()):
        at, _, rest = step.partition(":")
        others = [rest[i : i + 64] for i in range(0, len(rest), 64)]
        proof = ((int(at), others[: int(at)], others[int(at) :]), proof)
    return proof


def leaf_digest(cols: Iterable[str | Column]) -> Column:
    """The digest of a row's columns in order: ``-`` for null, else the number of bytes, a colon and the value."""

    def part(col: str | Column) -> Column:
        value = (F.col(col) if isinstance(col, str) else col).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, cols)).cast("binary"), 256)


_NODES = "part string, number long, n long, digest string"


def _block_top(levels: int):
    def top_of(table: pa.Table) -> pa.Table:
        """The node above a block of (part, block, number, n, digest)."""
        part, block, n = (table[c][0].as_py() for c in ("part", "block", "n"))
        leaves = table.sort_by("number")["digest"].to_pylist()
        top = leaves[0]
        for _, _, _, top in sweep_up(leaves, min(levels, height(n))):
            pass
        return pa.table([pa.array([part], pa.string()), pa.array([block], pa.int64()), pa.array([-(-n // RUN**levels)], pa.int64()), pa.array([top], pa.string())], names=["part", "number", "n", "digest"])

    return top_of


def _proofs(table: pa.Table, above: pa.Table, levels: int) -> list[Proof]:
    """Of a block's nodes in order of their numbers, from the proof of the node above it."""
    if not table.num_rows:
        return []
    return sweep_down(table["digest"].to_pylist(), min(levels, height(table["n"][0].as_py())), read(above["proof"][0].as_py()))


def _block_proofs(levels: int):
    def proofs(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        found = [written(p) for p in _proofs(table, above, levels)]
        return pa.table([table["part"], table["number"], pa.array(found, pa.string())], names=["part", "number", "proof"])

    return proofs


def _leaf_proofs(levels: int):
    """As _block_proofs, for leaves: the digest of the proof's siblings and the root that the presented leaf gives."""

    def proofs(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        found = _proofs(table, above, levels)
        hashed = pa.array([digest(siblings(p)) for p in found], pa.string())
        roots = pa.array([folded(leaf, p) for leaf, p in zip(table["presented"].to_pylist(), found)], pa.string())
        return table.drop_columns(["block", "number", "n", "presented"]).append_column("proof_sha256", hashed).append_column("folded_root", roots)

    return proofs


def _blocked(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("number") / RUN**levels))


def _tops(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tables of (part, number, n, digest), each the nodes above the blocks of the one before, until each part has one node."""
    tables = [nodes]
    while not tables[-1].where("n > 1").isEmpty():
        up = _blocked(tables[-1].select("part", "number", "n", "digest"), levels).groupBy("part", "block").applyInArrow(_block_top(levels), _NODES)
        tables.append(materialize(up, "merkle-nodes"))
    return tables


def _sent(nodes: DataFrame, proofs: DataFrame, levels: int) -> DataFrame:
    """(part, number, proof) of nodes, from those of the nodes above their blocks."""
    above = proofs.select("part", F.col("number").alias("block"), "proof")
    down = _blocked(nodes.select("part", "number", "n", "digest"), levels).groupBy("part", "block").cogroup(above.groupBy("part", "block"))
    return materialize(down.applyInArrow(_block_proofs(levels), "part string, number long, proof string"), "merkle-proofs")


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    return numbers_within(nodes, ["part"], order, "number", "n").withColumn("number", F.col("number") - 1)


def manifest(rows: DataFrame, part_col: str, order_cols: list[str], digest_col: str, presented_col: str, levels: int = LEVELS) -> DataFrame:
    """(part, order columns, leaf, subroot, root, proof_sha256, folded_root) of every row.

    rows: a part, what orders the rows within it, the digest of the row as it was
    and that of the row as it is presented. Per part the digests ascend by the order
    columns (nulls first; equal ones by the digest, where the order makes no
    difference); each run of eight becomes the digest of their concatenation until
    one is left, the subroot. Subroots by part (null first, then by bytes) likewise give
    the root. The proof of a row is the others of its run at each level, up to the root;
    folded_root is what the presented digest and the proof give. Repeated rows are
    leaves of their own. An empty table gives no rows. No text moves: a row is its
    keys and two digests. levels: of a block, the nodes that one task has at a time.
    """
    known = F.when(F.col(part_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(part_col).cast("string")))  # sorts null first
    keys = [f"key{i}" for i in range(len(order_cols))]
    placed = rows.select(known.alias("part"), *[F.col(f"`{c}`").alias(k) for c, k in zip(order_cols, keys)], F.col(digest_col).alias("digest"), F.col(presented_col).alias("presented"))
    leaves = materialize(_numbered(placed, [*keys, "digest"]), "merkle-leaves")
    lower = _tops(leaves, levels)
    subroots = lower[-1].select("part", "digest")
    top = materialize(_numbered(subroots.select(F.lit("").alias("part"), F.col("part").alias("name"), "digest"), ["name"]), "merkle-subroots")
    upper = _tops(top, levels)
    proofs = upper[-1].select("part", "number", F.lit("").alias("proof"))  # nothing is above the root
    for nodes in upper[-2::-1]:
        proofs = _sent(nodes, proofs, levels)
    at = top.select("part", "number", "name").join(proofs, ["part", "number"])
    proofs = materialize(at.select(F.col("name").alias("part"), F.lit(0).cast("long").alias("number"), "proof"), "merkle-proofs")
    for nodes in lower[-2:0:-1]:
        proofs = _sent(nodes, proofs, levels)
    above = proofs.select("part", F.col("number").alias("block"), "proof")
    kinds = dict(leaves.dtypes)
    out = ", ".join(f"{c} {kinds[c]}" for c in ("part", *keys, "digest"))
    down = _blocked(leaves.select("part", *keys, "digest", "presented", "number", "n"), levels).groupBy("part", "block").cogroup(above.groupBy("part", "block"))
    told = down.applyInArrow(_leaf_proofs(levels), f"{out}, proof_sha256 string, folded_root string")
    root = upper[-1].select(F.col("digest").alias("root"))  # one row
    named = told.join(subroots.select("part", F.col("digest").alias("subroot")), "part").join(F.broadcast(root))
    part = F.when(F.col("part") == "", F.lit(None)).otherwise(F.expr("substring(part, 2)")).alias(part_col)
    return named.select(part, *[F.col(k).alias(c) for c, k in zip(order_cols, keys)], F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root")
