"""Near-duplicates by shingle similarity against brute-force Jaccard, and how many linked pairs the bands find."""

import numpy as np
import pytest

pytest.importorskip("omicspark.llm.jaccard")
pipeline = pytest.importorskip("corpus_pipeline")
from omicspark.llm import jaccard as J  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return not a and not b or 5 * len(a & b) >= 4 * len(a | b)


def brute(rows):
    """Ids that stay: the smallest of each group."""
    sets = [plain(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if min(len(sets[i]), len(sets[j])) * 5 >= 4 * max(len(sets[i]), len(sets[j])) and similar(sets[i], sets[j]):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    return sorted((min((d for d in g if d is not None), default=None) for g in groups.values()), key=repr)


def made(seed, families):
    """Families of a text and copies with 1 to 12 words changed: similarities on both sides of 0.8."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(families):
        words = [f"w{x}" for x in rng.integers(0, 10**6, int(rng.integers(60, 260)))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(4):
            copy = list(words)
            for at in rng.choice(len(copy), int(rng.integers(1, 13)), replace=False):
                copy[at] = f"x{rng.integers(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def stage(spark, rows):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, x int")
    out = dict(pipeline.STAGES)["near-duplicates"](spark, df, "")
    assert out.columns == df.columns
    return sorted((r.doc_id for r in out.collect()), key=repr)


def test_stage_matches_brute_force(spark):
    rows = made(3, 30) + [(9001, None), (9000, ""), (9002, " \n"), (9003, "one Two"), (9004, "ONE  two"), (None, "q r s t u v"), (9005, "five words are one shingle"), (9006, "five words are one Shingle")]
    assert stage(spark, rows) == brute(rows)


def test_large_component_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 300)
    rows = made(4, 12)
    assert stage(spark, rows) == brute(rows)


def test_large_groups_of_copies(spark, monkeypatch):
    """Groups of many blocks, chains of texts that are similar to the next one only, and texts near two groups."""
    monkeypatch.setattr(J, "BLOCK", 400)
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 100)]
    rows = []

    def add(words):
        rows.append((len(rows), " ".join(words)))

    for _ in range(40):  # copies with one or two words changed
        copy = list(base)
        for at in rng.choice(100, int(rng.integers(0, 3)), replace=False):
            copy[at] = f"x{rng.integers(10**6)}"
        add(copy)
    chain = list(base)
    for step in range(30):  # each four words further from the first
        chain = [*chain[4:], *(f"c{step}_{i}" for i in range(4))]
        add(chain)
    for at in range(0, 100, 9):  # too far from the copies, near to each other
        far = list(base)
        far[5:30] = [f"f{i}" for i in range(25)]
        far[at] = "one"
        add(far)
    order = rng.permutation(len(rows))
    rows = [rows[i] for i in order]
    assert stage(spark, rows) == brute(rows)


def test_documents_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert stage(spark, rows) == brute(rows)


def test_recall_of_the_bands():
    """Of pairs with a similarity of 0.8 to 0.85, all but three in a million should share a band."""
    rng = np.random.default_rng(5)
    missed = total = 0
    for _ in range(400):
        n = int(rng.integers(20, 400))
        base = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        swap = n // 9  # (n - swap) / (n + swap) >= 0.8
        a, b = np.unique(base[:n]), np.unique(base[swap : n + swap])
        total += 1
        missed += not set(J.band_keys(a)) & set(J.band_keys(b))
    assert total == 400 and missed == 0


def test_empty(spark):
    assert J.one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0
