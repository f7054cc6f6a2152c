"""The Merkle manifest, token alignment and chunk reuse against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

pytest.importorskip("omicspark.llm.merkle")
P = pytest.importorskip("public_tokenizers")
from omicspark.llm import alignment, chunk_reuse, merkle  # noqa: E402

BYTES, PIECES, WORDS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")


def fuzz(n, seed, alphabet="abzABZ  \n\t'sretdv.,!?0123éèßñ×½  ́ẞΣσς中🙂▁\x1c\x85'll", most=80):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]


def hexed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """rows: (lang, key, leaf, presented) -> the same with subroot, root, digest of the proof, folded root."""

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([hexed(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def climb(levels, i, now):
        proof = ""
        for level in levels[:-1]:
            run = level[i // 8 * 8 : i // 8 * 8 + 8]
            at = i % 8
            proof += "".join(run[:at] + run[at + 1 :])
            now = hexed(*run[:at], now, *run[at + 1 :])
            i //= 8
        return proof, now

    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees[lang] = tree([r[2] for r in groups[lang]])
    upper = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        for i, (_, key, leaf, presented) in enumerate(groups[lang]):
            a, now = climb(trees[lang], i, presented)
            b, now = climb(upper, j, now)
            out.append((lang, key, leaf, trees[lang][-1][0], upper[-1][0], hexed(a + b), now))
    return out


@pytest.mark.parametrize(("n", "langs", "levels"), [(1, 1, 4), (9, 1, 4), (700, 3, 1), (90, 70, 1), (1300, 2, 2), (64, 64, 4)])
def test_manifest(spark, n, langs, levels):
    rng = random.Random(n)
    names = [None, "", *[f"l{i}é" for i in range(langs)]][: langs + (langs > 1)]
    rows = []
    for i in range(n):
        leaf = hexed(str(rng.randint(0, n)))
        rows.append((rng.choice(names), rng.choice([None, i, i // 2]), leaf, leaf if i % 3 else hexed("other", leaf)))
    rows += rows[:2]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, number long, leaf string, presented string, block int, part string")
    got = merkle.manifest(df, "lang", ["number"], "leaf", "presented", levels=levels)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_manifest(rows), key=repr)


def test_manifest_of_no_rows(spark):
    df = spark.createDataFrame([], "lang string, number long, leaf string, presented string")
    assert merkle.manifest(df, "lang", ["number"], "leaf", "presented").count() == 0


def test_leaf_digests(spark):
    df = spark.createDataFrame([(1, "é", None), (None, "", 7)], "a long, b string, c int")
    got = [r[0] for r in df.select(merkle.leaf_digest(["a", "b", "c"])).collect()]
    assert got == [hexed("1:12:é-"), hexed("-0:1:7")]


def test_sweeps_hold_little():
    """Labels deliver a node right after its last child, so the queue stays short."""
    seen = list(merkle.sweep_up((hexed(str(i)) for i in range(600)), 4))
    assert [n[1] for n in seen if n[0] == 1] == list(range(75)) and seen[-1][0] == 4
    place = {(level, number): i for i, (level, number, _, _) in enumerate(seen)}
    assert all(place[level, number] < place[level + 1, number // 8] for level, number in place if level < 4)
    proofs = merkle.sweep_down([hexed(str(i)) for i in range(600)], 4, ())
    assert all(merkle.folded(hexed(str(i)), p) == seen[-1][3] for i, p in enumerate(proofs))
    assert merkle.read(merkle.written(proofs[77])) == proofs[77]


def brute_alignment(text):
    """(groups, links, n_a, n_b) from whole texts by the libraries; None if bytes are lost."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    own = brute_alignment.__dict__
    if "a" not in own:
        own["a"], own["b"] = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
        own["a"].encode_special_tokens = True
        seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in seen]
        own["bytes"] = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}
    a, b = own["a"].encode(" " + text, add_special_tokens=False).ids, own["b"].encode(text)
    bytes_a = [bytes(own["bytes"][c] for c in own["a"].id_to_token(i)) for i in a]
    bytes_b = [bytes([int(own["b"].id_to_piece(i)[3:5], 16)]) if own["b"].is_byte(i) else own["b"].id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    ends = []
    for parts in (bytes_a, bytes_b):
        at, found = 0, []
        for p in parts:
            at += len(p)
            found.append(at)
        ends.append(found)
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        links.append((a[p - 1], b[q - 1]))
        i, j = p, q
    return ";".join(groups), links, len(a), len(b)


def brute_scores(texts):
    found = [brute_alignment(t) if t else None for t in texts]
    counts = Counter(link for f in found if f for link in f[1])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for f in found:
        groups, links, n_a, n_b = f or ("", [], 0, 0)
        out.append((n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), groups))
    return out


ALIGNED_TEXTS = [None, "", " ", "  ", "a", "Hello, world! It's 12:30.", "  two  spaces ", "tab\tline\n\nend ", "\n  x\n y", "café au lait", "x" * 400, "<|endoftext|> <s></s> <0x41>", "a▁b", "nbsp  here", "中文 字", "é  ü", "\x00 z"]


@pytest.mark.parametrize(("chunk", "most"), [(1 << 15, 1 << 20), (20, 40)])
def test_alignment_and_scores(spark, chunk, most):
    texts = ALIGNED_TEXTS + fuzz(40, 5) + [" ".join(fuzz(8, s, "abcde fgh, .é")) for s in range(6)] + ["the same text of words"] * 3
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, groups string").repartition(3)
    aligned = alignment.align(df, BYTES, PIECES, chunk=chunk)
    got = alignment.score_links(aligned, most=most).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").cast("string")).collect()
    want = [(r[0], *s) for r, s in zip(rows, brute_scores([r[1] for r in rows]))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert alignment.score_links(alignment.align(df.limit(0), BYTES, PIECES)).count() == 0


def test_fragments_are_a_monoid():
    units = alignment.units_of(BYTES, PIECES)
    rng = random.Random(9)
    for text in [t for t in ALIGNED_TEXTS if t] + fuzz(80, 3, "ab é, \n."):
        data = text.encode()
        cuts = sorted(rng.randint(0, len(data)) for _ in range(3))
        a, b, c, d = (units.fragment(data[i:j]) for i, j in zip([0, *cuts], [*cuts, len(data)]))
        left = units.compose(units.compose(units.compose(a, b), c), d)
        right = units.compose(a, units.compose(b, units.compose(c, d)))
        both = units.compose(units.compose(a, b), units.compose(c, d))
        assert left == right == both == units.compose(alignment.Fragment(), left) == units.compose(left, alignment.Fragment())
        assert units.whole(left) == units.closed(data)


def library_ids(text):
    from tokenizers import Tokenizer

    own = library_ids.__dict__
    own.setdefault("t", Tokenizer.from_file(WORDS))
    return own["t"].encode(text or "", add_special_tokens=False).ids


def test_chunk_reuse(spark):
    """Documents that share passages, with cuts of a few bytes, equal the library's ids and decoding."""
    rng = random.Random(2)
    passages = [" ".join(fuzz(12, s, "abcdefg hij,. é")) for s in range(6)] + ["z" * 300, "é" * 200, "<|endoftext|> in <|startoftext|>text", "中文" * 90]
    texts = [None, "", " ", "a", "ab cd", *fuzz(40, 8)]
    for i in range(60):
        texts.append("".join(rng.choice([*passages, *fuzz(3, i), " ", "\n\n", "x"]) for _ in range(rng.randint(1, 6))))
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, passages[0] * 2, 1), (3, "a", 1), (9, texts[-1], 1), (9, texts[-1], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, uid int").repartition(4)
    for mean, least, most in ((16, 4, 64), (64, 16, 200), (1024, 128, 1 << 14)):
        got = chunk_reuse.encode(df, WORDS, mean=mean, least=least, most=most).withColumn("back", chunk_reuse.decode("ids", WORDS)).collect()
        library_ids("")
        want = [(i, library_ids(t), library_ids.t.decode(library_ids(t), skip_special_tokens=False)) for i, t, _ in rows]
        assert sorted(((r.doc_id, r.ids, bytes(r.back).decode()) for r in got), key=repr) == sorted(want, key=repr)
    assert chunk_reuse.encode(df.limit(0), WORDS).count() == 0


def test_shared_chunks_are_encoded_once(monkeypatch):
    """A text made of borrowed chunks is encoded at its joins alone."""
    text = " ".join(fuzz(200, 4, "abcdefgh ij")).encode()
    ends = chunk_reuse.cut(text, 256, 64, 1 << 14)
    assert len(ends) > 5 and ends[-1] == len(text)
    borrowed = [(a, b - a, *chunk_reuse.encode_span(text[a:b], WORDS)) for a, b in zip([0, *ends], ends)]
    units = chunk_reuse.hugging_units(WORDS)
    seen = []
    whole = units.encode(text)

    class Counted:
        encode = staticmethod(lambda data: seen.append(len(data)) or units.encode(data))

    monkeypatch.setattr(chunk_reuse, "hugging_units", lambda path: Counted)
    assert chunk_reuse.assemble(text, borrowed, WORDS) == whole
    assert sum(seen) < len(text) / 4


def test_cuts_follow_the_content():
    """A passage is cut at the same places wherever it stands, and whatever the block of the hash."""
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh éij") for _ in range(4000))
    own = [passage.encode()[a:b] for a, b in zip([0, *chunk_reuse.cut(passage.encode(), 128, 32, 4096)], chunk_reuse.cut(passage.encode(), 128, 32, 4096))]
    moved = ("another beginning, " * 9 + passage).encode()
    ends = chunk_reuse.cut(moved, 128, 32, 4096)
    found = {moved[a:b] for a, b in zip([0, *ends], ends)}
    assert len(found & set(own)) >= len(set(own)) - 2
    assert chunk_reuse.cut(b"") == [] and chunk_reuse.cut(b"ab") == [2]
    for end in ends[:-1]:
        moved[:end].decode()


def test_registered_queries(spark):
    """The three queries on a small table, from the plain versions."""
    from omicspark.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_alignment(spark, sf).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest() if x else ""
    assert got == {d.doc_id: (*s[:6], sha(s[6])) for d, s in zip(docs, brute_scores([d.text for d in docs]))}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_chunk_bpe(spark, sf).collect()}
    library_ids("")
    want = {}
    for d in docs:
        ids = library_ids(d.text)
        want[d.doc_id] = (len(ids), hexed(" ".join(map(str, ids))), hexed(library_ids.t.decode(ids, skip_special_tokens=False)))
    assert got == want
    leaf = lambda d, text: hexed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d.doc_id, d.source, d.lang, d.n_chars, text)])
    lowered = lambda t: t and t.translate({c: c + 32 for c in range(65, 91)})
    rows = [(d.lang, d.doc_id, leaf(d, d.text), leaf(d, lowered(d.text) if zlib.crc32(str(d.doc_id).encode()) % 3 == 0 else d.text)) for d in docs]
    got = {tuple(r) for r in queries.op11_merkle(spark, sf).collect()}
    assert got == {(k, leaf, sub, root, proof, now, now == root) for _, k, leaf, sub, root, proof, now in brute_manifest(rows)}
    assert 0 < sum(not r[-1] for r in got) < len(got)
