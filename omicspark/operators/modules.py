"""Pathway modules and gene sets from knowledge-base records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _split(text: str, marks: str) -> list[str]:
    """Parts of a definition between marks that stand outside parentheses."""
    parts, depth, now = [], 0, ""
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch in marks and not depth:
            parts.append(now)
            now = ""
        else:
            now += ch
    return [p for p in (x.strip() for x in [*parts, now]) if p]


def holds(text: str, have: set[str]) -> bool:
    """A definition against a set of ids: ``,`` and ``-`` are or, blanks and ``+`` are and."""
    for marks, some in ((" ", False), (",", True), ("+", False), ("-", True)):
        parts = _split(text, marks)
        if len(parts) > 1:
            return (any if some else all)(holds(p, have) for p in parts)
    text = text.strip()
    return holds(text[1:-1], have) if text.startswith("(") and text.endswith(")") else text in have


def module_steps(sets: DataFrame, modules: list[tuple[str, str]]) -> DataFrame:
    """(key, module, found, needed): steps of each module that a set (key, ids array) completes. Top-level blanks part steps."""
    steps = [(name, _split(text, " ")) for name, text in modules]

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, ids in zip(batch["key"], batch["ids"]):
                have = set(ids)
                rows += [(key, name, sum(holds(s, have) for s in parts), len(parts)) for name, parts in steps]
            yield pd.DataFrame(rows, columns=["key", "module", "found", "needed"])

    return sets.select(F.col("key").cast("string").alias("key"), "ids").mapInPandas(evaluate, "key string, module string, found long, needed long")


def genus_counts(genes: DataFrame, organisms: DataFrame) -> DataFrame:
    """(group, genus, n): organisms of each group's genes, by the first word of their name. genes (group, code); organisms (code, name)."""
    return genes.join(organisms.groupBy("code").agg(F.min("name").alias("name")), "code").groupBy("group", F.substring_index("name", " ", 1).alias("genus")).agg(F.count("*").alias("n"))


def pathway_sets(entries: DataFrame, leave_out: str | None = None) -> DataFrame:
    """(category, ids): the ids (id, category, class) under each category, without those of a class that is left out."""
    used = entries
    if leave_out is not None:
        used = entries.join(entries.where(F.col("class") == leave_out).select("id").distinct(), "id", "left_anti")
    return used.groupBy("category").agg(F.array_join(F.array_sort(F.collect_set("id")), ";").alias("ids"))


def exclude_lineages(df: DataFrame, col: str, patterns: list[str]) -> DataFrame:
    return df.where(~F.coalesce(F.regexp_like(col, F.lit("|".join(f"(?:{p})" for p in patterns))), F.lit(False)))


def filter_lanes(df: DataFrame, lanes: DataFrame, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Gel bands of mapped lanes with a relative front from low to high; decimal commas are read as points."""
    rf = F.replace("rf", F.lit(","), F.lit(".")).try_cast("double")
    return df.withColumn("rf", rf).where(F.col("rf").between(low, high)).join(lanes, "lane")
