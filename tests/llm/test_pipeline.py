"""The pipeline's stages against brute-force versions, and the registered llm queries against their SQL."""

import os
import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("omicspark.llm.queries")
pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")
from omicspark.llm import langid, queries as Q  # noqa: E402
from test_jaccard import brute  # noqa: E402
from test_text_operators import plain_statistics  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_kept(text):
    n, chars, symbols, dup, repeats = plain_statistics(text)
    if n < 10 or 100 * repeats > 20 * n:
        return False
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    stutter = sum(a == b for a, b in zip(words, words[1:]))
    upper, letters = (sum(test(c) for c in text) for test in (str.isupper, str.isalpha))
    return not (100 * symbols > 10 * n or (len(lines) >= 5 and 100 * dup > 30 * len(lines)) or 100 * stutter > 20 * n or 100 * upper > 50 * letters or chars < 2 * n or chars > 15 * n)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    net = langid.fit(docs, ~langid.held_out())
    ids = sorted(rows)
    told = langid.predict_texts(net, [rows[i].encode() for i in ids])
    want = {i for i, (lang, score) in zip(ids, told) if lang != "und" and score >= pipeline.MIN_LANGUAGE_SCORE}
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["language ID", "quality rules", "near-duplicates", "packing"]
    step = pipeline.STAGES[0][1](spark, docs, SF)
    assert step.columns == docs.columns and {r.doc_id for r in step.collect()} == want
    want = {i for i in want if plain_kept(rows[i])}
    step = pipeline.STAGES[1][1](spark, docs.where(docs.doc_id.isin(sorted({i for i in ids if i in want or not plain_kept(rows[i])}))), SF)
    assert step.columns == docs.columns and {r.doc_id for r in step.collect()} == want
    stay = brute([(i, rows[i]) for i in sorted(want)])
    step = pipeline.STAGES[2][1](spark, docs.where(docs.doc_id.isin(sorted(want))), SF)
    kept = {r.doc_id for r in step.collect()}
    assert step.columns == docs.columns and kept == set(stay)


def test_run_packs_what_is_left(spark):
    packed = pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = {}
    for r in packed:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc, own in pieces.items():
        assert [x for r in sorted(own, key=lambda r: r.start) for x in r.ids] == [*tokenizer.encode(docs[doc], add_special_tokens=False).ids, 1]
    fill = Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in fill.values())
    assert 0.5 * len(docs) < len(pieces) < len(docs)


ODD = [(1, "the words of a text that is short but fine to read by all", 5), (1, "the words of a text that is short but fine to read by all", 5), (None, "another text of some words that nobody has read before today", 6), (2, None, 7), (None, None, 8), (3, "", 9), (4, " \n\t ", 0), (5, "word " * 60000, 1), (6, " ".join(f"w{i * 7}" for i in range(40000)), 2), (7, "#$%& " * 30, 3)]
CLASHES = "score int, held_out int, lang_pred string, n_words int, kept int, rejected_by string, words int, lines int, __lang int, __jaccard_row int, node int, id int, component int, uid int, data int, offset int, ids int, task int, rank int, start int"


@pytest.mark.parametrize("at", range(4))
def test_each_stage_bears_odd_rows(spark, at):
    """Nulls, empty and very long texts, repeated rows and clashing names: whole rows come out as they went in, or pieces of every row."""
    names = [x.split()[0] for x in CLASHES.split(", ")]
    plain = spark.createDataFrame([(i, t, n, "en" if n % 2 else None, "s") for i, t, n in ODD], "doc_id long, text string, n_chars long, lang string, source string")
    docs = plain.selectExpr("*", *(f"CAST({k} AS {x.split()[1]}) AS {x.split()[0]}" for k, x in enumerate(CLASHES.split(", ")))).repartition(3)
    out = pipeline.STAGES[at][1](spark, docs, SF)
    got = out.collect()
    if at == 3:
        lengths = Counter()
        for r in got:
            lengths[r.doc_id] += r.length
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        want = Counter()
        for i, t, _ in ODD:
            want[i] += len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
        assert lengths == want
        return
    assert out.columns == docs.columns and set(names) < set(out.columns)
    rows = Counter(tuple(r) for r in docs.collect())
    assert all(n <= rows[r] for r, n in Counter(map(tuple, got)).items())
    kept = Counter(r.n_chars for r in got)
    if at == 0:
        assert not {7, 8, 9, 0, 3} & set(kept)
    if at == 1:
        assert kept == {5: 2, 6: 1, 2: 1}
    if at == 2:  # texts without words are one group, and so is the repeated row
        assert kept == {5: 1, 6: 1, 7: 1, 1: 1, 2: 1, 3: 1}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(Q.SQL[name])
    names = sorted(c[0] for c in result.description)
    at = [[c[0] for c in result.description].index(n) for n in names]
    want = sorted(tuple(str(r[i]) for i in at) for r in result.fetchall())
    got = sorted(tuple(str(r[n]) for n in names) for r in Q.QUERIES[name](spark, SF).collect())
    assert got == want and got


def test_html_query(spark):
    """The article of the made pages, found by their tags."""
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in Q.QUERIES["op4_html"](spark, SF).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|h3|ul|li|div|blockquote)\b[^>]*>", article)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " " if "<br" in p else "", p)).split()) for p in parts)
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_language_query_on_held_out_rows(spark):
    got = {r.doc_id: r for r in Q.QUERIES["op9_langid"](spark, os.path.join(os.path.dirname(SF), "sf0.01")).collect()}
    rows = spark.read.parquet(f"{os.path.dirname(SF)}/sf0.01/documents.parquet").select("doc_id", "lang").collect()
    held = [r for r in rows if got[r.doc_id].held_out and r.lang]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
