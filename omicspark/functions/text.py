"""Column functions on ids, attributes, lineages and labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from omicspark.functions.sequences import _c

RANKS = ("k", "p", "c", "o", "f", "g", "s", "t")


def attributes(col: Column | str, dialect: str = "gff3") -> Column:
    """The attribute column of a feature as a map: ``k=v;`` (gff3) or ``k "v";`` (gtf). The last of equal keys wins."""
    if dialect == "gff3":
        pairs = F.filter(F.split(_c(col), ";"), lambda p: F.trim(p) != "")
        entries = F.transform(pairs, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.substring(p, F.instr(p, "=") + 1, F.length(p)).alias("value")))
    else:
        keys = F.regexp_extract_all(_c(col), F.lit(r'(\S+)\s+"([^"]*)"\s*;?'), 1)
        values = F.regexp_extract_all(_c(col), F.lit(r'(\S+)\s+"([^"]*)"\s*;?'), 2)
        entries = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    later = lambda all_, e, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda o: o["key"] == e["key"])
    last = F.transform(F.array(entries), lambda es: F.filter(es, lambda e, i: later(es, e, i)))[0]
    return F.map_from_entries(last)


def attribute(col: Column | str, key: str) -> Column:
    """One ``k=v`` attribute of a feature, null if absent."""
    found = F.regexp_extract(_c(col), rf"(?:^|;)\s*{re.escape(key)}=([^;]*)", 1)
    return F.when(F.regexp_like(_c(col), F.lit(rf"(?:^|;)\s*{re.escape(key)}=")), found)


def set_attribute(col: Column | str, key: str, value: Column | str) -> Column:
    """The attributes with ``key`` set to ``value``: in its place, or at the end."""
    entry = F.concat(F.lit(f"{key}="), _c(value))
    there = F.regexp_like(_c(col), F.lit(rf"(?:^|;)\s*{re.escape(key)}="))
    parts = F.transform(F.split(_c(col), ";"), lambda p: F.when(F.startswith(F.trim(p), F.lit(f"{key}=")), entry).otherwise(p))
    return F.when(there, F.array_join(parts, ";")).otherwise(F.concat_ws(";", F.nullif(F.rtrim(_c(col), F.lit(";")), F.lit("")), entry))


def split_list(col: Column | str, sep: str) -> Column:
    """A delimited cell as an array: plain separator, trailing empty parts dropped, an empty cell has none."""
    parts = F.split(F.regexp_replace(_c(col), f"(?:{re.escape(sep)})+$", ""), re.escape(sep))
    return F.filter(parts, lambda p: F.lit(True)) if sep == "" else F.when(_c(col) == "", F.array().cast("array<string>")).otherwise(parts)


def strip_parens(col: Column | str) -> Column:
    """The text without parts in parentheses, however deep they are nested."""
    turns = F.sequence(F.lit(0), F.length(F.regexp_replace(_c(col), r"[^(]", "")))
    return F.aggregate(turns, _c(col), lambda text, _: F.regexp_replace(text, r"\([^()]*\)", ""))


def natural_chrom_key(col: Column | str) -> Column:
    """Order of chromosome names: MT 0, GroupN N, GroupUnN N + 1000; other names null."""
    return (
        F.when(F.upper(_c(col)) == "MT", F.lit(0))
        .when(F.regexp_like(_c(col), F.lit(r"^Group\d+$")), F.regexp_extract(_c(col), r"^Group(\d+)$", 1).cast("int"))
        .when(F.regexp_like(_c(col), F.lit(r"^GroupUn\d+$")), F.regexp_extract(_c(col), r"^GroupUn(\d+)$", 1).cast("int") + 1000)
    )


def format_lineage(ranks: Column | str, names: Column | str, default: str = "Unclassified") -> Column:
    """Parallel arrays of one-letter ranks and names as ``k__A; p__B; ...`` over all of RANKS, blanks for what is missing."""
    known = F.map_from_arrays(_c(ranks), _c(names))
    parts = [F.concat(F.lit(f"{r}__"), F.coalesce(F.try_element_at(known, F.lit(r)), F.lit(""))) for r in RANKS]
    return F.when(_c(ranks).isNull() | (F.size(_c(ranks)) == 0), F.lit(default)).otherwise(F.concat_ws("; ", *parts))


def xref_id(col: Column | str, patterns: list[str]) -> Column:
    """The first group of the first pattern that matches, else the text itself."""
    found = [F.when(F.regexp_like(_c(col), F.lit(p)), F.regexp_extract(_c(col), p, 1)) for p in patterns]
    return F.coalesce(*found, _c(col))


def json_get(col: Column | str, path: str) -> Column:
    return F.get_json_object(_c(col), path)


def regulation(q: Column | str, log_fold: Column | str, max_q: float, min_fold: float) -> Column:
    """Up, Down or Not DEG; a missing q is 1."""
    sure = F.coalesce(_c(q), F.lit(1.0)) <= max_q
    return F.when(sure & (_c(log_fold) >= min_fold), "Up").when(sure & (_c(log_fold) <= -min_fold), "Down").otherwise("Not DEG")


def sample_of(path: Column | str) -> Column:
    """A sample's name from a file's: no folders, no read or compression suffix."""
    return F.regexp_replace(F.regexp_extract(_c(path), r"([^/]*)$", 1), r"([._]R?[12])?\.(fastq|fq|fasta|fa|txt|tsv)(\.gz)?$", "")


def relabel(col: Column | str, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The label of the first rule (regex, label) that matches; else ``otherwise``, or the text itself."""
    out = _c(col) if otherwise is None else F.lit(otherwise)
    for pattern, label in reversed(rules):
        out = F.when(F.regexp_like(_c(col), F.lit(pattern)), F.lit(label)).otherwise(out)
    return out


def promoter_span(start: Column | str, end: Column | str, strand: Column | str, size: int, chrom_size: Column | str) -> tuple[Column, Column]:
    """(start, end) of the ``size`` bases before a transcript on its strand, within [0, chrom_size]; half-open."""
    low = F.when(_c(strand) == "-", _c(end)).otherwise(_c(start) - size)
    high = F.when(_c(strand) == "-", _c(end) + size).otherwise(_c(start))
    return F.least(F.greatest(low, F.lit(0)), _c(chrom_size)), F.least(F.greatest(high, F.lit(0)), _c(chrom_size))
