"""Tokenizers with a cache of the ids of text units, for use inside tasks.

Both libraries find pre-tokens first and merge bytes within each, so a text may
be encoded unit by unit if each unit ends where a pre-token surely ends. That is
so before white space that follows something else: no pre-token holds a visible
character followed by white space. Words of prose repeat, so most are found in
the cache. One that is not, and whose characters are plain, is split into its
pre-tokens, which are looked up in turn; only those not found reach the library's
merges. A text that holds a tokenizer's added token goes to its library whole.

A tokenizer file whose ids follow the order of its merges says the same as ranks,
and plain texts are encoded by them, whole.
"""

from __future__ import annotations

import base64
import json
import os
import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

CACHE_UNITS = 250_000  # in each of two generations
CACHE_BYTES = 48
IDS = np.dtype("<u4")
# Fixed value: the pre-token pattern of byte-level tokenizer files that name none.
GPT2_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4

_UNITS = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_CONTROLS = tuple(bytes([c]) for c in range(0x1C, 0x20))  # some engines count them as white space
# Those, and white space and separators beyond ASCII by their first bytes.
_ODD = (*_CONTROLS, b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe1\xa0\x8e", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80\x80", b"\xef\xbb\xbf")
# Characters on whose class, case and composition all versions of Unicode agree: ASCII and the Latin-1 letters.
_PLAIN = re.compile(r"[ -~\t\n\x0b\x0c\rÀ-ÖØ-öø-ÿ]+")


class TwoGenerations(dict):
    """A cache that forgets what it hasn't met for CACHE_UNITS new entries."""

    def __init__(self, make: Callable):
        super().__init__()
        self._make, self._old = make, {}

    def __missing__(self, key):
        found = self._old.get(key)
        if found is None:
            found = self._make(key)
        if len(key) <= CACHE_BYTES:
            if len(self) >= CACHE_UNITS:
                self._old = dict(self)
                self.clear()
            self[key] = found
        return found


class UnitCache(TwoGenerations):
    """A word -> the ids, as little-endian unsigned 32-bit integers, of the word after a space.

    whole: ids of any text. pieces: the pre-tokens of a plain text. of_piece: the
    ids of one pre-token. spaces: whether a pre-token may begin with white space;
    if not, the tokenizer drops it. lower: whether it lower-cases. added: what its
    added tokens begin with. ranked: packed ids of a plain text by ranks, if it has any.
    """

    def __init__(self, whole: Callable[[str], list[int]], pieces: Callable[[str], list[str]], of_piece: Callable[[str], list[int]], spaces: bool, lower: bool, added: tuple[bytes, ...] = (), ranked: Callable[[str], bytes] | None = None):
        super().__init__(self._encode_word)
        self._added, self._ranked = added, ranked
        self._whole, self._pieces, self._space, self._lower = whole, pieces, " " if spaces else "", lower
        self.piece_ids = TwoGenerations(lambda piece: _packed(of_piece(piece)))

    def encode_text(self, text: bytes) -> bytes:
        return _packed(self._whole(text.decode("utf-8", "replace")))

    def _encode_unit(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            return b"".join(map(self.piece_ids.__getitem__, self._pieces(text)))
        return _packed(self._whole(text))

    def _encode_word(self, word: bytes) -> bytes:
        core = word.rstrip(b".,")
        if core.isalpha():  # ASCII letters and the stops after them are two pre-tokens
            text = core.decode("ascii")
            ids = self.piece_ids[self._space + (text.lower() if self._lower else text)]
            return ids if len(core) == len(word) else ids + self.piece_ids[word[len(core) :].decode("ascii")]
        return self._encode_unit(self._space + word.decode("utf-8", "replace"))

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole text."""
        if any(a in text for a in self._added):
            return self.encode_text(text)
        if not self._space:
            return b"".join(map(self.__getitem__, text.split()))
        if self._ranked and not any(c in text for c in _CONTROLS):
            whole = text.decode("utf-8", "replace")
            if text.isascii() or _PLAIN.fullmatch(whole):
                return self._ranked(whole)
        if any(odd in text for odd in _ODD):
            return self.encode_text(text)
        if b"  " in text or text.endswith(b" "):  # a run of white space may end elsewhere than before its last space
            return b"".join(self._encode_unit(u.decode("utf-8", "replace")) for u in _UNITS.findall(text))
        words = text.split(b" ")
        return (self._encode_unit(words[0].decode("utf-8", "replace")) if words[0] else b"") + b"".join(map(self.__getitem__, words[1:]))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if _NATIVE else np.asarray(ids, dtype=IDS).tobytes()


@lru_cache(maxsize=8)
def tiktoken_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=8)
def tiktoken_encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=tiktoken_ranks(path), special_tokens={})


def tiktoken_ids(path: str, pattern: str, kind: np.dtype = IDS) -> Callable[[bytes], bytes]:
    """A function from a text's bytes to its ids, packed as ``kind``. This library is as fast on whole texts as a cache of words."""
    encode = tiktoken_encoding(path, pattern).encode_to_numpy
    return lambda text: encode(text.decode("utf-8", "replace"), disallowed_special=()).astype(kind, copy=False).tobytes()


def id_kind(largest: int) -> np.dtype:
    """The least of 16 and 32 bits that holds ids up to ``largest``."""
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


@lru_cache(maxsize=8)
def tiktoken_pieces(path: str, pattern: str) -> TwoGenerations:
    """A pre-token's bytes -> its packed ids."""
    return TwoGenerations(tiktoken_ids(path, pattern))


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it can be seen, else the next free one from 256."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


def ranks_of(told: dict) -> dict[bytes, int] | None:
    """The ranks that a byte-level BPE tokenizer file (as read from JSON) amounts to; None if ids alone don't tell its merges."""
    model, pre = told["model"], told["pre_tokenizer"]
    plain = pre["type"] == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and told["normalizer"] is None
    if not plain or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [model["vocab"].get(a + b, -1) for a, b in pairs]
    added = {t["content"] for t in told["added_tokens"]}
    bytes_of = {letter: b for b, letter in byte_letters().items()}
    ranks = {bytes(bytes_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    in_order = all(a < b for a, b in zip(merged, merged[1:])) and (not merged or merged[0] > max(ranks.get(bytes([b]), 1 << 31) for b in range(256)))
    return ranks if in_order and len(ranks) == len(merged) + 256 else None


@lru_cache(maxsize=8)
def hugging_units(path: str) -> UnitCache:
    """A byte-level BPE tokenizer file, as its own library encodes without adding special tokens.

    Its own normalizer and pre-tokenizer see all but plain text, its own model or its ranks every pre-token.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    ranks = ranks_of(told)
    by_rank = tiktoken.Encoding("own", pat_str=GPT2_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy if ranks else None
    ranked = (lambda text: by_rank(text, disallowed_special=()).astype(IDS, copy=False).tobytes()) if ranks else None
    added = [t["content"] for t in told["added_tokens"]]
    begin = os.path.commonprefix(added)
    lower = "Lowercase" in json.dumps(told["normalizer"])
    split = [p["pattern"]["Regex"] for p in told["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
    find = regex.compile(split[0] if split else GPT2_PATTERN).findall
    letters, tokenize = byte_letters(), tokenizer.model.tokenize
    space = letters[0x20]

    def of_piece(piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():
            return [t.id for t in tokenize(piece.replace(" ", space))]
        return [t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters))]

    def pieces(text: str) -> list[str]:
        # A word of letters and the stops after it, without the pattern.
        core = text.rstrip(".,")
        if core[1:].isalpha() and (core[0] == " " or core[0].isalpha()):
            found = [core, text[len(core) :]] if len(core) < len(text) else [core]
        else:
            return find(text.lower() if lower else text)
        return [p.lower() for p in found] if lower else found

    return UnitCache(lambda text: tokenizer.encode(text, add_special_tokens=False).ids, pieces, of_piece, not split, lower, tuple(a.encode() for a in ([begin] if begin else added)), ranked)
