"""HTML extraction, language ID, quality rules, chat formatting and top-k."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("omicspark.llm.quality")
from pyspark.sql import functions as F  # noqa: E402

from omicspark.llm import chat, html_extract as H, langid, quality, topk  # noqa: E402
from omicspark.llm.labelled_pages import LABELLED_PAGES  # noqa: E402
from held_out_pages import FRESH, HELD_OUT  # noqa: E402
from unseen_pages import UNSEEN  # noqa: E402


# --- HTML -------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return H.train()


def test_marginals_are_exact(model):
    """Messages against a sum over all labellings."""
    dom = H.parse('<body><div class="ad"><p>x</p></div><article><p>y <a href="#">z</a></p></article></body>')
    found = H.features(dom)
    n = len(dom.tags)
    own = [sum(model.weights.get(f, 0.0) for f in x) for x in found]
    both, left, entered = model.pairs
    total, on = 0.0, np.zeros(n)
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        score = sum(o for o, v in zip(own, y) if v)
        for i in range(1, n):
            score += {(1, 1): both, (1, 0): left, (0, 1): entered, (0, 0): 0.0}[y[dom.parents[i]], y[i]]
        total += np.exp(score)
        on += np.exp(score) * np.array(y)
    assert np.allclose(model.marginals(dom), on / total)


def test_labelled_pages_are_learned(model):
    wrong = 0
    for page in LABELLED_PAGES:
        dom = H.parse(page)
        wrong += sum((p >= 0.5) != y for p, y in zip(model.marginals(dom), H._labels(dom)))
    assert wrong <= 25


def test_extract(model):
    page = "<html><head><title>T</title><script>if (a < b) { x('<p>no</p>') }</script></head><body><nav><ul><li><a href=/a>Menu</a></ul></nav><div class=ad>Buy now</div><article><h1>A &amp; B</h1><p><b>One\n  two&nbsp;three.<br><p>Second <i>part</i><p></p></article><section class='comments'><p>I disagree with this.</p></section><footer>&copy; me</footer>"
    assert H.extract(page, model) == "A & B\n\nOne two three.\n\nSecond part"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</div></p>", "<!-- only", "<script>", "&#x41;&bogus;", "<a href='x>y", "<div>" * 3000, "<p>" * 3000 + "x", "<b a=1 " * 200])
def test_odd_pages(model, page):
    assert isinstance(H.extract(page, model), str)


@pytest.mark.parametrize("title", ["\u0130stanbul", "Istanbul"])
def test_letter_that_grows_in_lower_case(model, title):
    """U+0130 is two characters in lower case; raw elements must still end where they end."""
    page = f"<html><head><TITLE>{title}</TITLE><style>p {{}}</STYLE><script>let a = 1</script></head><body><article><h1>\u0130zmir</h1><p>One two \u0130 three.</p><script>x</script><p>Second part</p></article></body></html>"
    assert H.extract(page, model) == "\u0130zmir\n\nOne two \u0130 three.\n\nSecond part"


def test_raw_elements_end_at_their_own_tag(model):
    page = "<article><p>One two three four five.</p><select><option>no</option></selection><option>nor this</option></SELECT ><p>Six</p><script>a</scripts>b</script\n><p>Seven</p></article>"
    assert H.extract(page, model) == "One two three four five.\n\nSix\n\nSeven"


_PARTS = ["<h1>One</h1>", "<p>The first of three paragraphs is about the bridge.</p>", "<p>The second one says more of it.</p>", "<p>The last is short.</p>"]
_WHOLE = "One\n\nThe first of three paragraphs is about the bridge.\n\nThe second one says more of it.\n\nThe last is short."


@pytest.mark.parametrize("odd", ["<svg class=i/>", "<svg/>", "<math/>", "<!-->", "<!--->", "<!-- x --!>", "<!---->", "<!-- a <p>b</p> -->", "<svg class='i'><path d=''/></svg>", "<svg><g><title>x</title></g></svg>"])
def test_markup_that_takes_no_text_with_it(model, odd):
    for at in range(1, 4):
        page = "<html><body><article>" + "".join(_PARTS[:at]) + odd + "".join(_PARTS[at:]) + "</article><svg><title>far</title></svg></body></html>"
        assert H.extract(page, model) == _WHOLE
    assert H.extract(f"<article><p>The first <b>of {odd} three</b> is long enough.</p></article>", model) == "The first of three is long enough."


@pytest.mark.parametrize("page", ["<div id=text>A day.<br><br>B was there as well.<br><br>C came late.</div>", "<div>A day. B was there as well. C came late.</div>", "<p>A day. B was there as well. C came late.</p>", "A day. B was there as well. C came late.", "<html><head><title>x</title></head>A day. B was there as well. C came late.</html>"])
def test_pages_without_structure(model, page):
    assert H.extract(page, model) == "A day. B was there as well. C came late."


@pytest.mark.parametrize("noise", ["<aside>Read this too, it is about mills.</aside>", "<div class=newsletter>Write your name here.</div>", "<div class=promo>Boots for less.</div>", "<div class=sponsored><p>Paid for by the mill.</p></div>", "<div class=share>Tell others.</div>"])
def test_notices_within_an_article(model, noise):
    for at in range(1, 5):
        page = "<html><body><article>" + "".join(_PARTS[:at]) + noise + "".join(_PARTS[at:]) + "</article></body></html>"
        assert H.extract(page, model) == _WHOLE
    assert H.extract("<html><body><div class=consent><p>Do you agree to all this?</p></div><article>" + "".join(_PARTS) + "</article></body></html>", model) == _WHOLE


@pytest.mark.parametrize("page", ["<div>" * 100_000, "<select>" * 100_000, "<a '" * 100_000, "<!" * 100_000, "<p>" * 100_000 + "x", "<li>" * 100_000, "<tr><td>" * 50_000, "<b " + "a" * 200_000 + ">", "</div>" * 100_000, "<!--" * 100_000, "<!-->" * 100_000])
def test_parse_is_linear(model, page):
    began = time.perf_counter()
    H.extract(page, model)
    assert time.perf_counter() - began < 15


def test_layouts_that_training_does_not_hold(model):
    """Blocks right and wrong over all such pages; the README has the figures of the first measurement."""
    found = right = wanted = 0
    for page, want in HELD_OUT + FRESH:
        got = [b for b in H.extract(page, model).split("\n\n") if b]
        found, right, wanted = found + len(got), right + sum((Counter(got) & Counter(want)).values()), wanted + len(want)
    assert right / found >= 0.9 and right / wanted >= 0.95


def test_unseen_layouts(model):
    """The README has the figures, the first ones as well."""
    found = right = wanted = 0
    for page, want in UNSEEN:
        got = [b for b in H.extract(page, model).split("\n\n") if b]
        found, right, wanted = found + len(got), right + sum((Counter(got) & Counter(want)).values()), wanted + len(want)
    assert right / found >= 0.9 and right / wanted >= 0.9


@pytest.mark.parametrize("page", ['<html><body><nav><ul><li><a href="/">Home</a></li></ul></nav><footer>All rights reserved</footer></body></html>', '<div class="cookie"><p>We use cookies.</p></div><div class="menu"><a href="/">Home</a></div>'])
def test_pages_without_main_text(model, page):
    assert H.extract(page, model) == ""


def test_html_query_over_a_column(spark, model):
    df = spark.createDataFrame([(1, "<article><p>Long enough text of an article, it is.</p></article>", "t"), (2, None, "t"), (1, "", "t")], "page_id long, html string, text string")
    got = df.select("page_id", H.main_text("html").alias("main")).collect()
    assert sorted(map(tuple, got)) == [(1, ""), (1, "Long enough text of an article, it is."), (2, "")]
    assert df.limit(0).select(H.main_text("html")).count() == 0


# --- language -----------------------------------------------------------------

_SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ein", "ü"], "cc": ["ción", "ll", "ado", "ñ"]}


def _text(rng, lang, n=60):
    return " ".join("".join(rng.choice(_SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_language_id(spark):
    rng = random.Random(4)
    rows = [(i, _text(rng, lang, rng.choice([5, 60, 400])), lang) for i, lang in enumerate(rng.choices(sorted(_SYLLABLES), [6, 2, 2], k=500))]
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 ... !!", "cc"), (1003, _text(rng, "aa", 20000), None), (None, _text(rng, "bb"), "bb"), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame([(*r, 0.5) for r in rows + odd], "doc_id long, text string, lang string, score double").selectExpr("*", "'x' AS Held_Out", "1 AS lang_pred", "2 AS __lang", "3 AS told")
    got = langid.identify(df)
    assert got.columns == ["doc_id", "text", "lang", "__lang", "told", "held_out", "lang_pred", "score"]
    got = got.collect()
    assert len(got) == len(rows) + len(odd)
    held = [r for r in got if r.held_out and r.lang and r.doc_id is not None and r.doc_id < 1000]
    assert len(held) > 60 and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and by[1003].lang_pred == "aa" and by[None].held_out is False
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(df.limit(0)).count() == 0
    kept = langid.keep_known(df, 0.5)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.lang_pred != "und" and r.score >= 0.5}


def test_letters_are_letters(spark):
    """Numbers that are no digits are no letters."""
    net = langid.train(np.zeros((1, langid.WINDOW), np.uint8), np.zeros(1, np.int64), ["aa"], epochs=1)
    texts = ["½ ² Ⅷ", "٣", "_", "ª", "中", "é"]
    assert [lang for lang, _ in langid.predict_texts(net, [t.encode() for t in texts])] == ["und", "und", "und", "aa", "aa", "aa"]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").rlike(langid.LETTER)).collect()] == [False] * 3 + [True] * 3


def test_every_language_is_learned(spark):
    """Frequent and rare labels, rows that are all alike, null ids: each label is in the network; too many are an error."""
    rows = [(None, "ka to mi", "aa")] * 2000 + [(i, f"schein {i}", "bb") for i in range(900)] + [(7, "ci\u00f3n", f"rare{i}") for i in range(230)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(langid.fit(df, F.lit(True), sample_docs=20).languages) == 232
    # Many languages share the sample; one row that a language repeats leaves the others theirs.
    bound, train, seen = langid.SAMPLE_TEXTS, langid.train, []
    langid.SAMPLE_TEXTS, langid.train = 500, lambda x, y, languages, **more: seen.append((len(y), set(y.tolist()))) or train(x[:1], y[:1], languages, epochs=1)
    try:
        hot = df.unionByName(spark.range(3000).select(*[F.lit(v).cast(t).alias(c) for (c, t), v in zip(df.dtypes, df.first())]))
        assert len(langid.fit(hot, F.lit(True)).languages) == 232
    finally:
        langid.SAMPLE_TEXTS, langid.train = bound, train
    assert seen[0][1] == set(range(232)) and seen[0][0] < 1500
    old = langid.MOST_LANGUAGES
    langid.MOST_LANGUAGES = 100
    try:
        with pytest.raises(ValueError):
            langid.fit(df, F.lit(True))
    finally:
        langid.MOST_LANGUAGES = old
    assert langid.fit(df.limit(0), F.lit(True)).languages == ["und"]


def test_windows_count_by_their_bytes():
    net = langid.train(np.frombuffer(b"ka to " * 400 + b"zz yy " * 400, np.uint8)[: 16 * 256].reshape(-1, 256), np.arange(16) // 8, ["aa", "bb"], epochs=3)
    text = b"ka to " * 42 + b"ka t" + b"zzzz"
    first, last = (net.probabilities(langid.windows_of(part))[0] for part in (text[:256], text[256:]))
    lang, score = langid.predict_texts(net, [text])[0]
    assert abs(score - max((first * 256 + last * (len(text) - 256)) / len(text))) < 1e-5


def test_language_order_of_columns_plays_no_part(spark):
    net = langid.train(np.zeros((1, langid.WINDOW), np.uint8), np.zeros(1, np.int64), ["aa"], epochs=1)
    assert langid.predict_texts(net, [b"abc", None, b"..."]) == [("aa", 1.0), ("und", 0.0), ("und", 0.0)]


# --- quality ------------------------------------------------------------------


def plain_statistics(text):
    text = text or ""
    words = [w for w in __import__("re").split("[ \t-\r]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_against_brute_force(spark):
    rng = random.Random(9)
    texts = [None, "", " \n\t ", "one", "a b c d e " * 3, "same line\nsame line\n\nother\nsame line", "x" * 10000, "A###*** " * 40, "é ñ ß " * 30, "THE END OF ALL " * 20, "w w w w w w w w w w w"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(60)] + [" ".join(f"w{rng.randint(0, 4000)}" for _ in range(20000))]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "a b", 1), (0, None, 1)], "doc_id long, text string, n_words int")
    got = quality.judge(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = plain_statistics(texts[r.doc_id] if r.doc_id is not None else "a b")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in got if r.kept}
    assert {r.doc_id for r in quality.quality_filter(df).collect()} == kept and kept
    assert quality.quality_filter(df).columns == df.columns
    assert quality.judge(df.limit(0)).count() == 0


def test_order_plays_no_part_in_the_verdict(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "### *** " * 20, "fine words are written here by someone who cares about them a lot"])], "doc_id long, text string")
    own = quality._names(df)
    rows = quality._with_words(df, "text", own)
    stats = quality.statistics(*(F.col(own[n]) for n in ("text", "words", "lines")))
    for order in (quality.RULES, quality.RULES[::-1]):
        assert [r.doc_id for r in rows.where(quality.cascade(list(order), stats.__getitem__).isNull()).collect()] == [2]


def test_cascade_works_out_what_it_reaches(spark):
    """A statistic behind a rule that rejects is never worked out: it would raise."""
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    stats = {"n": F.size(F.split("text", " ")), "never": F.raise_error("reached").cast("int")}
    rules = [quality.Rule("few", lambda s: s("n") < 10), quality.Rule("never", lambda s: s("never") > 0)]
    assert df.select(quality.cascade(rules, stats.__getitem__)).first()[0] == "few"
    with pytest.raises(Exception, match="reached"):
        df.select(quality.cascade(rules[::-1], stats.__getitem__)).collect()


def test_quality_filter_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "fine words are written here by someone who cares about them a lot", 1, 2, "x", 0), (1, None, 1, 2, "y", 0)], "doc_id long, text string, n_words int, __quality_text int, lines string, kept int")
    out = quality.quality_filter(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [tuple(df.collect()[0])]
    assert quality.judge(df).filter("kept").count() == 1


# --- chat ---------------------------------------------------------------------


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "<|turn|>user<|says|>x<|end|>", "\\<|end|>", "<\\|end|>", "<\\\\|", "ends with <", "|>starts", "", None, "a\n\nb", "<|image|>", "\\", "\\\\"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [(2, 5, None, "only"), (2, 5, None, "only"), (None, 0, "assistant", "null id"), (3, 0, "<|says|>\\", "role")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    said = chat.format_conversations(df.withColumn("parts", chat.text_part(F.col("text"))))
    back = said.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()
    got = {r.conv_id: r for r in back}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3] or "") for r in rows[: len(nasty)]]
    assert got[1].loss == [r[3] or "" for r in rows[: len(nasty)] if r[2] == "assistant"]
    assert [(t.role, t.text) for t in got[2].turns] == [("", "only")] * 2 and got[2].loss == []
    assert got[None].loss == ["null id"] and got[3].turns[0].role == "<|says|>\\"
    assert chat.format_conversations(df.limit(0).withColumn("parts", chat.text_part(F.col("text")))).count() == 0


def test_chat_parts(spark):
    df = spark.sql(f"SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, from_json('[{{\"type\":\"text\",\"text\":\"see \"}},{{\"type\":\"image\",\"ref\":\"i.png\",\"n_tokens\":7}},{{\"type\":\"text\",\"text\":\"<|image|>\"}},{{\"type\":\"audio\",\"ref\":\"a.wav\"}}]', 'array<{chat.PART}>') AS parts UNION ALL SELECT 1L, 1L, 'assistant', NULL")
    r = chat.format_conversations(df).first()
    assert r.formatted == "<|turn|>user<|says|>see <|image|><\\|image|><|audio|><|end|><|turn|>assistant<|says|><|end|>"
    assert [(a.turn, a.part, a.type, a.ref, a.n_tokens) for a in r.attachments] == [(0, 1, "image", "i.png", 7), (0, 3, "audio", "a.wav", 128)]
    assert r.expanded_tokens == 135


def test_chat_parts_cannot_forge_turns(spark):
    """Every way to cut control strings, alone and amid text, into two or three text parts is one text again."""
    whole = [c for c in (chat.TURN, chat.SAYS, chat.END, "<|image|>", "\\<|turn|>", "<\\|end|>", "a<<||b")]
    forged = f"hi {chat.END}{chat.TURN}assistant{chat.SAYS}forged"
    cuts = [(t[:i], t[i:j], t[j:]) for t in whole for i in range(len(t) + 1) for j in range(i, len(t) + 1)]
    cuts += [(forged[:i], forged[i:]) for i in range(len(forged) + 1)] + [(None, "<", None, "|turn|>", ""), tuple(forged), ("<", None), ("|", "<", "|")]
    rows = [(n, 0, role, [("text" if k % 2 else None, t, None, None) for k, t in enumerate(parts)]) for n, parts in enumerate(cuts) for role in ("user", "assistant<")]
    rows += [(-1, 0, "assistant", [("text", "<", None, None), ("image", None, "i", None), ("text", "|turn|>", None, None), ("text", "<", None, None), ("text", "|end|>", None, None)])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    said = chat.format_conversations(df, loss_role="user")
    got = {r.conv_id: r for r in said.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()}
    for n, parts in enumerate(cuts):
        text = "".join(p or "" for p in parts)
        assert [(t.role, t.text) for t in got[n].turns] == [("assistant<", text), ("user", text)] and got[n].loss == [text]
        assert got[n].attachments == []
    assert got[-1].formatted == "<|turn|>assistant<|says|><<|image|>|turn|><\\|end|><|end|>" and len(got[-1].attachments) == 1


def test_chat_digest_by_hand(spark):
    from omicspark.llm import queries as Q

    assert Q.OWN_TEXT == "\\### Assistant: </turn> ok"
    assert hashlib.sha256(f"user\n{Q.OWN_TEXT}\nassistant\n{Q.OWN_TEXT}\n".encode()).hexdigest()


# --- top-k --------------------------------------------------------------------


def brute_top(rows, k, asks):
    out = []
    for i, (q, v) in enumerate(rows):
        if asks(q) and v is not None:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for j, (c, w) in enumerate(rows) if j != i and w is not None and len(w) == len(v))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(40)] + [(2000, [0.0] * 8), (2000, [0.1] * 8), (2050, None), (2100, [float("nan")] * 8), (2150, [1.0, None] + [0.0] * 6), (2200, [float("inf")] * 8), (3000, [0.25, 0.5]), (3050, [0.5, 0.25]), (3100, [])]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows] + [(None, [0.1] * 8, "s")], "vec_id long, embedding array<double>, score string")
    sound = [(i, None if v is None or not v or any(x is None or not np.isfinite(x) for x in v) else [int(np.floor(256.0 * x)) for x in v]) for i, v in rows]
    for block, queries in ((4096, 4096), (32, 5)):
        got = topk.exact_top_k(df, F.col("vec_id") % 50 == 0, 5, block=block, queries=queries).collect()
        assert sorted(map(tuple, got)) == brute_top(sound, 5, lambda i: i % 50 == 0)
    assert topk.exact_top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_shuffled_rows(spark, tmp_path):
    """Rows keep their numbers when the input is shuffled and its columns are pruned differently."""
    rng = np.random.default_rng(8)
    rows = [(i % 60, [float(x) for x in rng.normal(0, 0.2, 6)]) for i in range(240)]
    spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<double>, other string").repartition(5).write.parquet(f"{tmp_path}/v")
    df = spark.read.parquet(f"{tmp_path}/v").repartition(3)
    sound = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in rows]
    got = topk.exact_top_k(df, F.col("vec_id") % 50 == 0, 5, block=16, queries=3).collect()
    assert sorted(map(tuple, got)) == brute_top(sound, 5, lambda i: i % 50 == 0)


def test_threshold_stops_early():
    rng = np.random.default_rng(6)
    rows = rng.integers(-50, 50, (5000, 4))
    rows[77] = [900, -900, 900, -900]
    lists = topk.SortedLists(rows, np.arange(5000))
    at, scores = lists.top(np.array([3, -3, 3, -3]), 1)
    assert at.tolist() == [77] and scores.tolist() == [10800] and lists.scored <= 4 * topk._STEP
    # A floor that no row of the block can reach ends the search at once, one that some reach loses none.
    lists.scored = 0
    assert not len(lists.top(np.array([3, -3, 3, -3]), 5, floor=20000)[0]) and lists.scored <= 4 * topk._STEP
    query = np.array([1, 2, -3, 4])
    exact = rows @ query
    kth = np.sort(exact)[-5]
    at, scores = lists.top(query, 5, floor=int(kth))
    assert scores.tolist() == sorted(exact.tolist())[-5:][::-1]
    big = topk.SortedLists(np.array([[1 << 40, 3], [5, 1 << 20]]), np.arange(2))
    assert big.top(np.array([1 << 20, 7]), 2)[1].tolist() == [(1 << 60) + 21, 5 * (1 << 20) + 7 * (1 << 20)]
