"""Alignment of the tokens of two tokenizers, by a monoid of text fragments.

Both tokenizers surely end a token before a space that follows a visible
character. What lies between two such places is a unit: its tokens, and the groups
that common token ends cut it into, depend on its bytes alone. A range of bytes of
a text is a fragment: an open prefix up to its first sure place, the closed groups of
the units within, and an open suffix; without a sure place all of it is open. Two
fragments side by side compose: the left suffix and the right prefix close into
units. That is associative, with the empty fragment as its unit, so long texts are
cut at any byte, and a tree of tasks puts their fragments together.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omicspark.llm.encoders import GPT2_PATTERN, byte_letters, ranks_of
from omicspark.storage import bound_batches, free_name, materialize

CHUNK = 1 << 15
FAN_IN = 16  # fragments that one step of the tree puts together
CACHE_UNITS = 100_000  # in each of two generations
CACHE_BYTES = 48
_TOGETHER = 1 << 15  # bytes of unknown units that are encoded as one text
MOST_LINKS = 1 << 20  # id pairs whose counts every task holds; the rest are joined
LINK = np.dtype("<u4")  # first id * 2^16 + second id
_SPLIT = re.compile(rb" (?:(?<=[!-~] )|(?<=\xc3[\x80-\xbf] ))").split  # the sure places: before these spaces
# Units that end at a sure place and whose characters all versions of Unicode agree on.
_PLAIN = re.compile(rb"(?:[\t-\r -~]|\xc3[\x80-\xbf])*(?:[!-~]|\xc3[\x80-\xbf])").fullmatch
_UNSOUND = (b"", b"", 1 << 64)
# Fixed value: what stands for a space in pieces.
_SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")

ALIGNED = "sound boolean, groups binary, n_a long, n_b long, n_groups long, links binary, link_times binary"


class Closed(NamedTuple):
    """Groups that are settled: as text (``a1,a2|b1;a3|b2``), the id pairs that end them, the numbers of tokens, and whether all bytes came back."""

    groups: bytes = b""
    links: bytes = b""
    n_a: int = 0
    n_b: int = 0
    sound: bool = True

    @classmethod
    def of(cls, parts: Iterable["Closed"]) -> "Closed":
        groups, links, n_a, n_b, sound = zip(*parts)
        return cls(b";".join(filter(None, groups)), b"".join(links), sum(n_a), sum(n_b)) if all(sound) else cls(sound=False)


@dataclass(frozen=True)
class Fragment:
    """A range of bytes. closed is None if it holds no sure place; then prefix is all of it."""

    prefix: bytes = b""
    closed: Closed | None = None
    suffix: bytes = b""


def _byte_level_pieces(path: str) -> tuple[list[bytes], Callable[[str], list[int]]]:
    """Bytes of each id of a byte-level tokenizer file, and the ids of a text in which special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    bytes_of = {letter: b for b, letter in byte_letters().items()}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        table[i] = bytes(bytes_of[c] for c in token) if all(c in bytes_of for c in token) else token.encode()
    whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    ranks = ranks_of(told)
    if not ranks:
        return table, whole
    ordinary = tiktoken.Encoding("own", pat_str=GPT2_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    plain = re.compile(r"[ -~\t\n\x0b\x0c\r\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch  # characters on whose class all versions of Unicode agree
    return table, lambda text: ordinary(text) if plain(text) else whole(text)


def _sentence_pieces(path: str) -> tuple[list[bytes], Callable[[str], list[int]]]:
    """Bytes of each id of a model that puts a space before a text and keeps spaces as a letter of their own, and the ids of a text."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
        raise ValueError("a piece goes on after a space, so texts can't be cut before spaces")
    return [bytes([int(m[1], 16)]) if model.is_byte(i) and (m := _BYTE.fullmatch(p)) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)], model.encode


def _flat(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, pa.large_binary())


def _taken(pieces: pa.Array, at: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """Ends of the chosen pieces, the first being 0, and their bytes side by side."""
    found = pieces.take(pa.array(at))
    return np.frombuffer(found.buffers()[1], dtype=np.int64)[: len(at) + 1], memoryview(found.buffers()[2])


class Units(dict):
    """A unit's bytes, without the space before it -> (groups, links, numbers of tokens) of it. What is short is remembered, until it isn't met for long."""

    def __init__(self, path_a: str, path_b: str):
        super().__init__()
        (bytes_a, self._ids_a), (bytes_b, self._ids_b) = _byte_level_pieces(path_a), _sentence_pieces(path_b)
        if max(len(bytes_a), len(bytes_b)) > 1 << 16:
            raise ValueError("a vocabulary has over 65,536 ids")
        self._old: dict[bytes, tuple[bytes, bytes, int]] = {}
        self._bytes_a, self._bytes_b = _flat(bytes_a), _flat(bytes_b)
        self._sizes_a, self._sizes_b = (np.array([len(x) for x in pieces]) for pieces in (bytes_a, bytes_b))
        # An id as text before another, as the last of its side, and as the last of its group.
        self._names = _flat([f"{i}{end}".encode() for end in ",|;" for i in range(1 << 16)])

    def _remember(self, unit: bytes, found: tuple[bytes, bytes, int]) -> None:
        if len(self) >= CACHE_UNITS:
            self._old = dict(self)
            self.clear()
        self[unit] = found

    def __missing__(self, unit: bytes) -> tuple[bytes, bytes, int]:
        found = self._old.get(unit) or self._aligned([unit])[0]
        if len(unit) <= CACHE_BYTES:
            self._remember(unit, found)
        return found

    def _encoded(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        text = data.decode("utf-8", "replace")
        # No text at all would get no space.
        return np.asarray(self._ids_a(" " + text), dtype=np.int64), np.asarray(self._ids_b(text) if text else self._ids_b("a ")[len(self._ids_b("a")) :], dtype=np.int64)

    def _aligned(self, units: list[bytes]) -> list[tuple[bytes, bytes, int]]:
        """Groups of units that stand one after the other: cut where a token of either side ends at one byte. None at all if bytes are lost."""
        data = b" ".join(units)
        a, b = self._encoded(data)
        if any(bytes(_taken(pieces, ids)[1]) != b" " + data for pieces, ids in ((self._bytes_a, a), (self._bytes_b, b))):
            return [_UNSOUND] * len(units)
        ends_a, ends_b = np.cumsum(self._sizes_a[a]), np.cumsum(self._sizes_b[b])
        _, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        links = ((a[last_a] << 16) | b[last_b]).astype(LINK).tobytes()
        # A group's first tokens come before its second ones.
        closes_a, closes_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        closes_a[last_a], closes_b[last_b] = 1, 1
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[np.cumsum(closes_a) - closes_a]] = a + (closes_a << 16)
        order[np.arange(len(b)) + (last_a + 1)[np.cumsum(closes_b) - closes_b]] = b + (closes_b << 17)
        at, text = _taken(self._names, order)
        upto = np.cumsum([len(u) + 1 for u in units])
        n_a, n_b, n = (np.concatenate([[0], np.searchsorted(x, upto) + 1]) for x in (ends_a, ends_b, ends_a[last_a]))
        places = at[n_a + n_b].tolist()
        counts = ((np.diff(n_a) << 32) | np.diff(n_b)).tolist()
        n = (n * LINK.itemsize).tolist()
        whole = bytes(text)
        return [(whole[p : q - 1], links[i:j], c) for p, q, i, j, c in zip(places, places[1:], n, n[1:], counts)]

    def meet(self, units: Iterable[bytes]) -> None:
        """Remember units. Those that are not known are encoded many at a time, put together at sure places."""
        old, held, size = self._old, [], 0
        for unit in set(units).difference(self):
            if unit in old:
                self._remember(unit, old[unit])
            elif len(unit) <= CACHE_BYTES and _PLAIN(unit):
                held.append(unit)
                size += len(unit) + 1
                if size >= _TOGETHER:
                    self._together(held)
                    held, size = [], 0
        if held:
            self._together(held)

    def _together(self, units: list[bytes]) -> None:
        for unit, found in zip(units, self._aligned(units)):
            if found is not _UNSOUND:  # else each is tried by itself as it is met
                self._remember(unit, found)

    def _summed(self, units: Iterable[bytes]) -> Closed:
        groups, links, counts = zip(*map(self.__getitem__, units))
        n = sum(counts)
        return Closed(b";".join(groups), b"".join(links), n >> 32, n & 0xFFFFFFFF) if n < _UNSOUND[2] else Closed(sound=False)

    def closed(self, data: bytes) -> Closed:
        """The groups of bytes between two sure places, without the space that they begin with."""
        return self._summed(_SPLIT(data))

    def closed_each(self, texts: list[bytes]) -> list[Closed]:
        """``closed`` of each text, empty ones without groups; what they don't share with texts before is encoded together."""
        parts = [_SPLIT(t) if t else [] for t in texts]
        self.meet(chain.from_iterable(parts))
        return [self._summed(p) if p else Closed() for p in parts]

    def fragment(self, data: bytes) -> Fragment:
        """The fragment of a range of bytes of a text."""
        parts = _SPLIT(data)
        if len(parts) == 1:
            return Fragment(data)
        self.meet(parts[1:-1])
        return Fragment(parts[0], self._summed(parts[1:-1]) if len(parts) > 2 else Closed(), b" " + parts[-1])

    def compose(self, left: Fragment, right: Fragment) -> Fragment:
        """The fragment of two ranges side by side."""
        if left.closed is None and right.closed is None:
            return self.opened(left.prefix + right.prefix)
        if left.closed is None:
            begun = self.opened(left.prefix + right.prefix)
            if begun.closed is None:
                return Fragment(begun.prefix, right.closed, right.suffix)
            return Fragment(begun.prefix, Closed.of([begun.closed, self.closed(begun.suffix[1:]), right.closed]), right.suffix)
        if right.closed is None:
            ended = self.opened(left.suffix[1:] + right.prefix)
            if ended.closed is None:
                return Fragment(left.prefix, left.closed, b" " + ended.prefix)
            return Fragment(left.prefix, Closed.of([left.closed, self.closed(ended.prefix), ended.closed]), ended.suffix)
        return Fragment(left.prefix, Closed.of([left.closed, self.closed(left.suffix[1:] + right.prefix), right.closed]), right.suffix)

    def opened(self, data: bytes) -> Fragment:
        """Open bytes put together can hold a sure place where they meet."""
        return self.fragment(data)

    def whole(self, fragment: Fragment) -> Closed:
        """The groups of a text, whose ends are sure."""
        if fragment.closed is None:
            return self.closed(fragment.prefix)
        return Closed.of([self.closed(fragment.prefix), fragment.closed, self.closed(fragment.suffix[1:])])


@lru_cache(maxsize=2)
def units_of(path_a: str, path_b: str) -> Units:
    return Units(path_a, path_b)


def _told(found: list[Closed]) -> pa.StructArray:
    """ALIGNED of each text; one of which bytes were lost has no tokens."""
    kept = [c if c.sound else Closed(sound=False) for c in found]
    links, times = [], []
    for c in kept:
        keys, n = np.unique(np.frombuffer(c.links, dtype=LINK), return_counts=True)
        links.append(keys.astype(LINK).tobytes())
        times.append(n.astype(LINK).tobytes())
    columns = [
        pa.array([c.sound for c in kept], pa.bool_()),
        pa.array([c.groups for c in kept], pa.binary()),
        pa.array([c.n_a for c in kept], pa.int64()),
        pa.array([c.n_b for c in kept], pa.int64()),
        pa.array([len(c.links) // LINK.itemsize for c in kept], pa.int64()),
        pa.array(links, pa.binary()),
        pa.array(times, pa.binary()),
    ]
    return pa.StructArray.from_arrays(columns, [c.split()[0] for c in ALIGNED.split(", ")])


def _align_column(path_a: str, path_b: str):
    @F.arrow_udf(f"struct<{ALIGNED.replace(' ', ':').replace(',:', ',')}>")
    def align(texts: pa.Array) -> pa.Array:
        units = units_of(path_a, path_b)
        return _told(units.closed_each(texts.to_pylist()))

    return align


_FRAGMENT = "uid long, k int, open boolean, prefix binary, suffix binary, groups binary, links binary, n_a long, n_b long, sound boolean"


def _rows(uids: list[int], ks: list[int], found: list[Fragment]) -> pa.RecordBatch:
    closed = [f.closed or Closed() for f in found]
    columns = [
        pa.array(uids, pa.int64()),
        pa.array(ks, pa.int32()),
        pa.array([f.closed is None for f in found], pa.bool_()),
        *(pa.array([getattr(f, name) for f in found], pa.binary()) for name in ("prefix", "suffix")),
        *(pa.array([getattr(c, name) for c in closed], pa.binary()) for name in ("groups", "links")),
        *(pa.array([getattr(c, name) for c in closed], pa.int64()) for name in ("n_a", "n_b")),
        pa.array([c.sound for c in closed], pa.bool_()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _FRAGMENT.split(", ")])


def _fragments_of(table: pa.Table | pa.RecordBatch) -> list[Fragment]:
    return [Fragment(r["prefix"], None if r["open"] else Closed(r["groups"], r["links"], r["n_a"], r["n_b"], r["sound"]), r["suffix"]) for r in table.to_pylist()]


def _cut(chunk: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = [data[i : i + chunk] for i in range(0, len(data), chunk)]
                yield pa.RecordBatch.from_arrays([pa.array([uid] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["uid", "k", "data"])

    return rows


def _fragments(path_a: str, path_b: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(path_a, path_b)
        for batch in batches:
            uid, k, data = (batch.column(i).to_pylist() for i in range(3))
            yield _rows(uid, k, [units.fragment(d) for d in data])

    return rows


def _compose(path_a: str, path_b: str):
    def group(table: pa.Table) -> pa.Table:
        units, table = units_of(path_a, path_b), table.sort_by("k")
        first, *rest = _fragments_of(table)
        for other in rest:
            first = units.compose(first, other)
        return pa.Table.from_batches([_rows([table["uid"][0].as_py()], [table["k"][0].as_py() // FAN_IN], [first])])

    return group


def _finish(path_a: str, path_b: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(path_a, path_b)
        for batch in batches:
            told = _told([units.whole(f) for f in _fragments_of(batch)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *told.flatten()], ["uid", *(f.name for f in told.type)])

    return rows


def align(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), chunk: int = CHUNK) -> DataFrame:
    """``keep`` columns, sound, groups, n_a, n_b, n_groups, links and link_times of every whole text.

    path_a: a byte-level BPE tokenizer file, for a space and the text; path_b: a
    sentencepiece model, which puts the space itself. groups: ``a1,a2|b1;a3|b2`` as
    ids; n_groups of them, each ended by a link, a pair of tokens that end at one
    byte. links: the distinct id pairs (LINK), link_times how often each comes. A null
    or empty text, or one whose bytes a tokenizer changes (then not sound), has none.
    Rows are told apart by where they stand, so repeated rows and null ids are
    fine. Texts over ``chunk`` bytes are cut and composed; a text's groups are one
    value, so a text's result must fit in a row (about 400 MB of text).
    """
    bound_batches(docs.sparkSession, 512)
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text_col).cast("binary").alias("data"))
    is_long = F.coalesce(F.octet_length("data"), F.lit(0)) > chunk
    short = rows.where(~is_long).withColumn("told", _align_column(path_a, path_b)("data")).select("kept.*", "told.*")
    # Written once with its number, as another evaluation could number rows otherwise.
    long = materialize(rows.where(is_long).withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    most = long.agg(F.max(F.octet_length("data"))).first()[0]
    if most is None:
        return short
    cut = long.select("uid", "data").mapInArrow(_cut(chunk), "uid long, k int, data binary")
    found = materialize(cut.repartition("uid", "k").mapInArrow(_fragments(path_a, path_b), _FRAGMENT), "fragments")
    parts = -(-most // chunk)
    while parts > 1:
        found = materialize(found.groupBy("uid", F.floor(F.col("k") / FAN_IN)).applyInArrow(_compose(path_a, path_b), _FRAGMENT), "fragments")
        parts = -(-parts // FAN_IN)
    told = found.mapInArrow(_finish(path_a, path_b), f"uid long, {ALIGNED}")
    return short.unionByName(long.select("uid", "kept").join(told, "uid").select("kept.*", *told.columns[1:]))


def _sum_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(link, n) of the rows of a task, each link once or a few times."""
    held, size = [], 0

    def told() -> pa.RecordBatch:
        links, times = (np.concatenate(x) for x in zip(*held))
        keys, at = np.unique(links, return_inverse=True)
        sums = np.bincount(at, times, len(keys)).astype(np.int64)  # exact below 2^53
        held[:] = [(keys, sums)]
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(sums)], ["link", "n"])

    for batch in batches:
        for links, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if links:
                held.append((np.frombuffer(links, dtype=LINK), np.frombuffer(times, dtype=LINK).astype(np.int64)))
                size += len(held[-1][0])
        if size > 1 << 20:
            out = told()
            size = out.num_rows
            if size > 1 << 19:  # what combines no further is let go
                yield out
                held, size = [], 0
    if held:
        yield told()


def link_counts(aligned: DataFrame) -> DataFrame:
    """(link, n, best) over all rows of ``align``: how often a pair of ids is linked, and whether no pair with the same second id is so more often."""
    counts = materialize(aligned.select("links", "link_times").mapInArrow(_sum_links, "link long, n long").groupBy("link").agg(F.sum("n").alias("n")), "link-counts")
    second = F.col("link").bitwiseAND(0xFFFF)
    most = counts.groupBy(second.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(most, second == F.col("b")).select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, most: int = MOST_LINKS) -> DataFrame:
    """``aligned`` without links and link_times, with n_links, n_best and count_sum.

    n_best: links whose pair is, over all rows, the most frequent of its second id,
    ties included. count_sum: over links, how often their pair is linked. At most
    ``most`` counts, the greatest, go to every task; a pair beyond them is joined to
    its rows, so none is left out. An empty table gives no rows.
    """
    spark = aligned.sparkSession
    row = free_name(aligned, "__row")
    held = materialize(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    counts = materialize(link_counts(held), "links")
    sizes = sorted(((r["p"], r["n"]) for r in counts.groupBy(F.floor(F.log2("n")).alias("p")).agg(F.count("*").alias("n")).collect()), reverse=True)  # a row for each power of two
    least, total = 64, 0
    for power, n in sizes:
        if total + n > most:
            break
        least, total = power, total + n
    frequent = counts.where(F.floor(F.log2("n")) >= least).toArrow().sort_by("link")
    known = spark.sparkContext.broadcast((frequent["link"].to_numpy().astype(LINK), frequent["n"].to_numpy(), frequent["best"].to_numpy()))

    def looked_up(links: bytes, times: bytes) -> tuple[int, int, np.ndarray]:
        keys, n, best = known.value
        own, often = np.frombuffer(links, dtype=LINK), np.frombuffer(times, dtype=LINK).astype(np.int64)
        at = np.searchsorted(keys, own)
        there = keys[np.minimum(at, max(len(keys) - 1, 0))] == own if len(keys) else np.zeros(len(own), dtype=bool)
        at, seen = at[there], often[there]
        return int(seen[best[at]].sum()), int((seen * n[at]).sum()), ~there

    @F.arrow_udf("struct<n_best:long,count_sum:long>")
    def score(links: pa.Array, times: pa.Array) -> pa.Array:
        found = [looked_up(a or b"", b or b"")[:2] for a, b in zip(links.to_pylist(), times.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(2)], ["n_best", "count_sum"])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, links, times in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = looked_up(links or b"", times or b"")[2]
                if own.any():
                    keys = np.frombuffer(links, dtype=LINK)[own].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), row)), pa.array(keys), pa.array(np.frombuffer(times, dtype=LINK)[own].astype(np.int64))], ["row", "link", "times"])

    told = held.withColumn("__score", score("links", "link_times"))
    best, summed = F.col("__score.n_best"), F.col("__score.count_sum")
    if total < sum(n for _, n in sizes):
        rare = held.select(row, "links", "link_times").mapInArrow(rest, "row long, link long, times long")
        met = rare.join(counts, "link").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("__best"), F.sum(F.col("times") * F.col("n")).alias("__sum"))
        told = told.join(met, told[row] == met["row"], "left").drop("row")
        best, summed = best + F.coalesce("__best", F.lit(0)), summed + F.coalesce("__sum", F.lit(0))
    others = [F.col(f"`{c}`") for c in held.columns if c not in (row, "links", "link_times")]
    return told.select(*others, F.col("n_groups").alias("n_links"), best.alias("n_best"), summed.alias("count_sum"))
