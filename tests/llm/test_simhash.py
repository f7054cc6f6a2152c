"""SimHash against brute force, its keys against all small distances, and edge cases."""

import numpy as np
import pytest
import xxhash

pytest.importorskip("omicspark.llm.simhash")
from omicspark.llm import golay, simhash as S  # noqa: E402


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def brute(rows):
    prints = np.array([plain_simhash(t) for _, t in rows], dtype=np.int64)
    near = np.bitwise_count((prints[:, None] ^ prints[None]).view(np.uint64)) <= 4
    label = np.arange(len(rows))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(rows))])
        if (new == label).all():
            break
        label = new
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[label[i]] = min(low.get(label[i], doc), doc)
    return sorted(((d, int(p), low.get(label[i])) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def test_golay_is_perfect():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 3000)
    checks, _ = golay._tables()
    index = golay.key(words)
    assert (np.bitwise_count((index << 11 | checks[index]) ^ words) <= 3).all()


def test_keys_meet_up_to_four_bits():
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63, 4000, dtype=np.int64)
    other = base.copy()
    for i in range(len(base)):
        for b in rng.choice(64, i % 5, replace=False):
            other[i] ^= np.uint64(1 << int(b)).astype(np.int64)
    ka, ra = S.keys_of(base)
    kb, rb = S.keys_of(other)
    seen = set(zip(ra.tolist(), ka.tolist()))
    assert {r for r, k in zip(rb.tolist(), kb.tolist()) if (r, k) in seen} == set(range(len(base)))


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(2)
    vocab = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    rows = []
    for i in range(60):
        words = list(rng.choice(vocab, 40))
        rows.append((3 * i, " ".join(words)))
        for _ in range(2):
            words[int(rng.integers(40))] = str(rng.choice(vocab))
            rows.append((len(rows) * 3 + 1, " ".join(words)))
    rows += [(9001, None), (9000, ""), (9002, " \t\n"), (9003, "One two"), (9004, "one  TWO"), (9004, "one  TWO"), (None, "one two"), (8, "É é"), (7, "word " * 5000)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fingerprint string")
    got = S.simhash_components(df).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == brute(rows)


def test_dense_bucket_and_split_bucket(spark, monkeypatch):
    base = 0x0123456789ABCDEF
    prints = sorted({base ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(12)})
    found = S._search(np.array(prints, dtype=np.int64))
    assert len(found[0]) == len(prints) - 1
    df = spark.createDataFrame([(0, p) for p in prints], "a long, b long")
    monkeypatch.setattr(S, "BUCKET", 16)
    pairs = S._block_pairs(df).collect()
    nodes = {p: p for p in prints}

    def root(x):
        while nodes[x] != x:
            x = nodes[x]
        return x

    for a, b in pairs:
        nodes[max(root(a), root(b))] = min(root(a), root(b))
    assert len({root(p) for p in prints}) == 1


def test_empty_and_one_of_each(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_components(empty).count() == 0
    df = spark.createDataFrame([(5, "a b c d e f", 1), (3, "A b c d e f", 2), (3, "a b c d e f", 3), (None, "q r s t u v", 4), (7, "other words are here now", 5)], "doc_id long, text string, x int")
    kept = S.one_of_each(df)
    assert kept.columns == ["doc_id", "text", "x"]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 3), (False, 7), (True, 0)]


def test_one_of_each_of_shuffled_rows(spark, tmp_path):
    rows = [(i, f"text {i % 90} of some words that are its own {i % 90}", "x" * (i % 40)) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, other string").repartition(5).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d").repartition(3)
    want = {}
    for d, t, c in brute([(d, t) for d, t, _ in rows]):
        want[c] = min(want.get(c, d), d)
    assert sorted(r.doc_id for r in S.one_of_each(docs).select("doc_id").collect()) == sorted(want.values())
