"""Quality rules as a short-circuit cascade of native column expressions.

A rule is a condition on statistics of a text that rejects it. On a bounded
sample each rule is run alone: its cost is the time it takes beyond reading what
is at hand anyway, its selectivity the share it rejects. Rules are tried in order
of rejection per cost; the statistics of a rule are worked out only for texts that
no rule before it rejected. The order changes the work, never the verdict.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omicspark.storage import free_name, materialize

WINDOW = 5
SAMPLE_ROWS = 600
TIMES, TRIALS = 4, 2
LEAST_SECONDS = 1 / 64
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOLS_PERCENT = 10
MAX_DUP_LINES_PERCENT = 30
MIN_LINES = 5
MAX_STUTTER_PERCENT = 20
MAX_UPPER_PERCENT = 50
MEAN_WORD_CHARS = (2, 15)
_SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _repeat_words(words: Column) -> Column:
    """Words in windows of WINDOW words that occur twice or more. Windows are compared by 64-bit hashes."""

    def covered(starts: Column) -> Column:
        first = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("bigint").alias("n"))
        add = lambda acc, at: F.struct(at.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), at - acc["at"])).alias("n"))
        return F.aggregate(F.sort_array(starts), first, add, lambda acc: acc["n"])

    def twice(ordered: Column) -> Column:
        near = lambda i: F.get(ordered, i)["h"]
        again = F.transform(ordered, lambda x, i: F.when((x["h"] == near(i - 1)) | (x["h"] == near(i + 1)), x["i"]))
        return covered(F.filter(again, lambda i: i.isNotNull()))

    def counted(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(_let(ordered, twice))

    def windows(hashes: Column) -> Column:
        starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
        return F.transform(starts, lambda h, i: F.xxhash64(h, *(hashes[i + k] for k in range(1, WINDOW))))

    return _let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), counted)


def _stutter(words: Column) -> Column:
    return _let(words, lambda ws: F.size(F.filter(F.transform(ws, lambda w, i: w == F.get(ws, i - 1)), lambda same: F.coalesce(same, F.lit(False))))).cast("bigint")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_SPACE)) != "")


def statistics(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Statistics of a text (not null), the array of its words and that of its lines with a word."""
    return {
        "lines": lines,
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace(text, f"[^{_SYMBOLS}]+", "")).cast("bigint"),
        "n_dup_lines": _let(lines, _duplicates),
        "n_repeat_words": _repeat_words(words),
        "n_stutter": _stutter(words),
        "n_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("bigint"),
        "n_letters": (F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))).cast("bigint"),
    }


#: What op6's contract asks of every text; ``judge`` works them out for all rows.
TOLD = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _duplicates(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def _mean_word_out_of_range(chars: Column, n: Column) -> Column:
    low, high = MEAN_WORD_CHARS
    return _let(chars, lambda c: (c < low * n) | (c > high * n))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Callable[[str], Column]], Column]  # from a statistic's name to its column
    base: bool = False


RULES = (
    Rule("few_words", lambda s: s("n_words") < MIN_WORDS, True),
    Rule("repeats", lambda s: 100 * s("n_repeat_words") > MAX_REPEAT_PERCENT * s("n_words"), True),
    Rule("symbols", lambda s: 100 * s("n_symbols") > MAX_SYMBOLS_PERCENT * s("n_words")),
    Rule("dup_lines", lambda s: _let(s("lines"), lambda x: (F.size(x) >= MIN_LINES) & (100 * _duplicates(x) > MAX_DUP_LINES_PERCENT * F.size(x)))),
    Rule("stutter", lambda s: 100 * s("n_stutter") > MAX_STUTTER_PERCENT * s("n_words")),
    Rule("upper_case", lambda s: 100 * s("n_upper") > MAX_UPPER_PERCENT * s("n_letters")),
    Rule("word_length", lambda s: _mean_word_out_of_range(s("word_chars"), s("n_words"))),
)


def _names(docs: DataFrame) -> dict[str, str]:
    """Column names that ``docs`` doesn't have, for its text without nulls, its words and its lines."""
    return {n: free_name(docs, f"__quality_{n}") for n in ("text", "words", "lines")}


def _with_words(docs: DataFrame, text_col: str, own: dict[str, str]) -> DataFrame:
    whole = docs.withColumn(own["text"], F.coalesce(F.col(text_col), F.lit("")))
    return whole.withColumns({own["words"]: _words(F.col(own["text"])), own["lines"]: _lines(F.col(own["text"]))})


def order_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, known: tuple[str, ...] = (), sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) by falling rejection per cost, from a sample of at most ``sample_rows`` rows.

    known: statistics that are worked out anyway and cost a rule nothing. A rule's
    time is the least of TRIALS runs over TIMES copies of the sample, less that of a
    run without a rule, as a power of two: noise within a factor doesn't change the order.
    """
    only = docs.select(F.col(text_col).alias("text"))
    total = only.count()
    sample = only.sample(min(1.0, sample_rows / max(1, total)), seed=1).limit(sample_rows)
    own = _names(sample)
    rows = _with_words(sample, "text", own)
    made = statistics(*(F.col(own[n]) for n in ("text", "words", "lines")))
    held = materialize(rows.select(*own.values(), *(made[n].alias(n) for n in known)), "quality-sample")
    copies = held.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(TIMES))))
    stat = lambda n: F.col(n) if n in known else made[n]

    def run(rejected: Column) -> tuple[float, int, int]:
        seconds = []
        for _ in range(TRIALS):
            began = time.perf_counter()
            got = copies.agg(F.count("*").alias("n"), F.sum(F.size(own["words"]) + F.size(own["lines"]) + F.length(own["text"])), F.count_if(rejected).alias("hit")).first()
            seconds.append(time.perf_counter() - began)
        return min(seconds), got["hit"], got["n"]

    run(F.lit(False))
    idle = run(F.lit(False))[0]
    found = []
    for rule in rules:
        seconds, hit, n = run(rule.rejects(stat))
        found.append((rule, 2.0 ** round(math.log2(max(seconds - idle, LEAST_SECONDS))), hit / max(1, n)))
    return sorted(found, key=lambda x: (-x[2] / x[1], x[1], x[0].name))


def cascade(rules: list[Rule], stat: Callable[[str], Column]) -> Column:
    """The name of the first rule that rejects, null if none does. Later rules are not worked out."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(stat), F.lit(rule.name)).otherwise(verdict)
    return verdict


def judge(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the statistics TOLD, base_failed, kept and rejected_by (the first rule that rejects), a row for each row.

    ``kept`` doesn't depend on the order of the rules; ``rejected_by`` of a text that
    several rules reject does, and the order is measured, so it can differ between runs.
    What TOLD names is worked out for every row and base rules read it; the other
    rules are a cascade behind them that works out its statistics as it reaches
    them. Null and empty texts have no words and fail the base rules. Repeated rows
    and null ids keep their rows; an empty table gives none. Only ``keep`` columns
    and the text are read; a ``keep`` column with the name of a result is an error.
    """
    rest = tuple(r for r in RULES if not r.base)
    order = [rule for rule, _, _ in order_rules(docs, text_col, rest, TOLD)]
    wanted = docs.select(*keep, F.col(text_col).alias(free_name(docs, "__quality_source")))
    own = _names(wanted)
    rows = _with_words(wanted, wanted.columns[-1], own)
    made = statistics(*(F.col(own[n]) for n in ("text", "words", "lines")))
    told = rows.select(*keep, *own.values(), *(made[n].alias(n) for n in TOLD))
    stat = lambda n: F.col(n) if n in TOLD else made[n]
    base = [r for r in RULES if r.base]
    failed = F.lit(False)
    for rule in base:
        failed = failed | rule.rejects(stat)
    verdict = told.withColumn("base_failed", failed).withColumn("rejected_by", F.when(F.col("base_failed"), cascade(base, stat)).otherwise(cascade(order, stat)))
    return verdict.select(*keep, *TOLD, "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by")


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns, whatever these are called.

    Statistics are worked out as the cascade reaches them. Null and empty texts go.
    """
    order = [rule for rule, _, _ in order_rules(docs, text_col)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Words are bound within the condition: as a column of a projection they would be put into it at each use.
    verdict = _let(_words(text), lambda words: cascade(order, statistics(text, words, _lines(text)).__getitem__))
    return docs.where(verdict.isNull())
