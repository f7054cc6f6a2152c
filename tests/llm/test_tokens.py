"""Token operators against the libraries themselves."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("omicspark.llm.bpe")
P = pytest.importorskip("public_tokenizers")
from omicspark.llm import bpe, encoders, packing, packing_plan, token_counts, token_files  # noqa: E402

MULTI, WORDS, BYTES = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "Hello, world! It's 12:30.", "  two  spaces ", "tab\tline\n\nend ", "éàü ß Σσς ½ 中文 🙂", "x" * 5000, "word " * 3000, "<|endoftext|> <|startoftext|>", "nbsp here   there", "\x1c\x1d á é", "it's we'll THEY'VE", "..'s ...'ll", "a.\n b.\n\n c", " \n x"]


def fuzz(n=300, seed=1):
    rng = random.Random(seed)
    alphabet = "abzABZ  \n\t'sretdv.,!?0123éèßÜñ×÷½²  ́ẞΣσςİ中🙂\x1c\x85​'ll"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def hugging(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_units_equal_the_library(path):
    units, whole = encoders.hugging_units(path), hugging(path)
    marked = ["hello <|endoftext|> world", "<|endoftext|>", "a<|startoftext|>b <|EndOfText|> <|", "Ünder <|endoftext|>é"]
    for text in [t for t in TEXTS if t] + fuzz() + marked:
        assert np.frombuffer(units.encode(text.encode()), encoders.IDS).tolist() == whole(text), repr(text)


def test_given_documents_equal_the_library():
    """Every text of the given documents, by both tokenizer files."""
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() if t]
    for path in (WORDS, BYTES):
        units, whole = encoders.hugging_units(path), hugging(path)
        for text in texts:
            assert np.frombuffer(units.encode(text.encode()), encoders.IDS).tolist() == whole(text)


def test_ranks_of_a_file():
    import base64
    import json

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        same = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    told = json.load(open(BYTES))
    assert encoders.ranks_of(told) == same
    assert encoders.ranks_of(json.load(open(WORDS))) is None
    told["model"]["merges"][5], told["model"]["merges"][6] = told["model"]["merges"][6], told["model"]["merges"][5]
    assert encoders.ranks_of(told) is None


def test_cache_forgets(monkeypatch):
    monkeypatch.setattr(encoders, "CACHE_UNITS", 3)
    made = []
    cache = encoders.TwoGenerations(lambda k: made.append(k) or k.upper())
    for k in "abcdabcdefgabz":
        assert cache[k] == k.upper()
    assert len(cache) <= 3


def test_chunked_encoding_and_decoding(spark):
    encode = encoders.tiktoken_encoding(MULTI, P.PATTERN).encode_ordinary
    long = [" ".join(fuzz(200, seed)) for seed in range(3)] + ["a" * 3000, "\n" * 2000, "é" * 2000 + " end", "ab cd " * 900]
    texts = TEXTS + fuzz(50) + long
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, "null id", 0), (1, "again", 0)], "doc_id long, text string, uid int")
    coded = bpe.encode(df, MULTI, P.PATTERN, chunk=256, overlap=64).withColumn("back", bpe.decode("ids", MULTI))
    got = coded.collect()
    assert len(got) == len(texts) + 2
    want = sorted(((i, encode(t or ""), (t or "").encode()) for i, t in [*enumerate(texts), (None, "null id"), (1, "again")]), key=repr)
    assert sorted(((r.doc_id, r.ids, bytes(r.back)) for r in got), key=repr) == want
    assert bpe.encode(df.limit(0), MULTI, P.PATTERN).count() == 0


def test_encoding_of_shuffled_rows(spark, tmp_path):
    """Ids stay with their documents when the input is shuffled and columns are pruned differently."""
    encode = encoders.tiktoken_encoding(MULTI, P.PATTERN).encode_ordinary
    texts = [f"document {i} " + " ".join(fuzz(12, i)) for i in range(120)]
    spark.createDataFrame([(i, t, "x" * i) for i, t in enumerate(texts)], "doc_id long, text string, other string").repartition(5).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs").repartition(3)
    got = {r.doc_id: r.ids for r in bpe.encode(docs, MULTI, P.PATTERN, chunk=128, overlap=64).collect()}
    assert got == {i: encode(t) for i, t in enumerate(texts)}


def test_encoding_of_bytes_that_are_no_text(spark):
    encode = encoders.tiktoken_encoding(MULTI, P.PATTERN).encode_ordinary
    rng = random.Random(4)
    odd = [b"\xff", b"\xe4\xb8", b"\xf0\x9f\x99", b"\x80", "é中🙂".encode(), b" word", b"s ", b"\n"]
    rows = [(i, bytearray(b"".join(rng.choice(odd) for _ in range(rng.randint(0, 900))))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text binary")
    got = {r.doc_id: r.ids for r in bpe.encode(df, MULTI, P.PATTERN, chunk=256, overlap=64).collect()}
    assert got == {i: encode(bytes(b).decode("utf-8", "replace")) for i, b in rows}
    assert bpe._places(b"a\xe4\xb8b\xff").tolist() == [0, 1, 1, 1, 3, 4, 4, 4, 5]


def test_cuts_are_on_characters():
    data = ("é" * 100).encode()
    spans = bpe.cut(data, 33, 7)
    assert spans[0][0] == 0 and spans[-1][2] == len(data)
    for start, after, end in spans:
        data[start:end].decode()
        assert after == -1 or start < after < end


def test_separator_scan(spark):
    encode = encoders.tiktoken_encoding(MULTI, P.PATTERN).encode_ordinary
    rows = [(i, t, 0, "f", 0) for i, t in enumerate(TEXTS)] + [(None, "x y", 1, None, 1), (3, "twice", 2, "f", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, file string, ordinal long").repartition(3)
    for block in (1, 7, 1 << 20):
        got = token_counts.document_token_counts(df, MULTI, P.PATTERN, 50256, block=block)
        want = sorted([(i, len(encode(t or ""))) for i, t in [*enumerate(TEXTS), (None, "x y"), (3, "twice")]], key=repr)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert token_counts.document_token_counts(df.limit(0), MULTI, P.PATTERN, 50256).count() == 0


def test_scan_of_a_file_without_last_separator(spark, tmp_path):
    np.array([9, 9, 5, 5, 5, 9, 1, 2], "<u4").tofile(tmp_path / "flat")
    (tmp_path / "none").write_bytes(b"")
    files = spark.createDataFrame([(f"file://{tmp_path}/flat",), (f"file://{tmp_path}/none",)], "file string")
    with pytest.raises(OverflowError):
        np.array([70000], encoders.id_kind(50256))
    assert encoders.id_kind(65535).itemsize == 2 and encoders.id_kind(65536).itemsize == 4
    for block in (1, 2, 3, 100):
        got = token_counts.count_tokens(files, 9, block=block).orderBy("ordinal").collect()
        assert [(r.ordinal, r.start, r.n_tokens) for r in got] == [(0, 0, 0), (1, 1, 0), (2, 2, 3), (3, 6, 2)]


@pytest.mark.parametrize("width", [1, 5, 8, 15, 16, 17, 32])
def test_packing_of_bits(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1000).astype(np.uint32)
    data = token_files.pack(ids, width)
    assert len(data) == -(-1000 * width // 8)
    assert (token_files.unpack(data, 1000, width) == ids).all()
    with pytest.raises(ValueError):
        token_files.pack(np.array([1 << width], np.uint64), width)


def test_random_access(tmp_path):
    uri = f"file://{tmp_path}/t"
    ids = np.random.default_rng(0).integers(0, 32000, 10_000).astype("<u4")
    w = token_files.TokenWriter(uri, token_files.width_of(32000), block=64)
    for a in range(0, 10_000, 777):
        w.add(a, ids[a : a + 777])
    w.add(None, ids[:0])
    w.close()
    r = token_files.TokenReader(uri)
    for start, n in ((0, 10_000), (63, 2), (9_999, 5), (640, 64), (5, 0), (20_000, 3)):
        assert (r.read(start, n) == ids[start : start + n]).all()
    assert r.nulls[-1] and r.lengths.sum() == 10_000


def test_token_files(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)][::-1] + [(None, "first of all"), (-5, "Minus")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int")
    back = token_files.read_token_files(token_files.write_token_files(df, WORDS, 49408, 2))
    got = back.withColumn("crc", token_files.ids_crc32("ids")).orderBy("start").collect()
    encode, at, want = hugging(WORDS), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode(t), 2]
        want.append((d, at, ids, zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert [(r.doc_id, r.start, r.ids, r.crc) for r in got] == want
    assert token_files.read_token_files(token_files.write_token_files(df.limit(0), WORDS, 49408, 2)).count() == 0


def test_rows_of_one_id_go_to_several_files(spark):
    """A null id or another that holds most rows is spread, and ids still ascend from file to file."""
    rows = [(None, f"null {i}") for i in range(150)] + [(7, f"seven {i}") for i in range(150)] + [(i, "x") for i in range(20)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few bytes would be put together again
    try:
        files = token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), WORDS, 49408, 2).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) == 4 and max(f.n_docs for f in files) < 130
    got = token_files.read_token_files(token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), WORDS, 49408, 2)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    encode = hugging(WORDS)
    assert sorted((r.doc_id or -1, r.ids) for r in got) == sorted((d or -1, [*encode(t), 2]) for d, t in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids)


def test_packing_plan_places_every_id_once():
    rng = np.random.default_rng(3)
    for n, window in ((0, 64), (1, 64), (500, 64), (3000, 256)):
        lengths = np.clip(rng.lognormal(3, 1, n).astype(int), 1, window)
        ranks, seen = np.zeros(n, int), {}
        for i, x in enumerate(lengths.tolist()):
            ranks[i] = seen.get(x, 0)
            seen[x] = ranks[i] + 1
        plan = packing_plan.plan_packing(np.bincount(lengths, minlength=window + 1), window)
        row, part = plan.place(lengths, ranks)
        assert (np.bincount(row, plan.size[part], n) == lengths).all()
        sequence = plan.shift[part] + ranks[row]
        fill = np.bincount(sequence, plan.size[part], plan.sequences).astype(int)
        assert all(f == window or f & (f - 1) == 0 for f in fill)
        order = np.lexsort((plan.offset[part], sequence))
        at = {}
        for s, o, size in zip(sequence[order], plan.offset[part][order], plan.size[part][order]):
            assert at.get(s, 0) == o
            at[s] = o + size


def test_packing(spark):
    texts = TEXTS + fuzz(60) + ["many words here " * 900]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, "no id", 0)], "doc_id long, text string, offset int").select("*", F.lit(1).alias("kept"), F.lit("t").alias("task"), F.lit(2).alias("data")).repartition(3)
    rows = packing.pack(df, BYTES, end_id=1, vocabulary=50257, window=128).collect()
    encode = hugging(BYTES)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) > 0
    for i, t in [*enumerate(texts), (None, "no id")]:
        own = sorted(pieces[i], key=lambda r: r.start)
        want = [*encode(t), 1]
        assert [x for r in own for x in r.ids] == want and {r.doc_tokens for r in own} == {len(want)}
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 128 or at & (at - 1) == 0
    assert packing.pack(df.limit(0), BYTES, end_id=1, vocabulary=50257).count() == 0
