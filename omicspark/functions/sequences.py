"""Column functions on sequences and base qualities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC nucleotide codes and their complements.
_BASES = "ACGTURYSWKMBDHVNacgturyswkmbdhvn"
_COMPLEMENTS = "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def complement(col: Column | str) -> Column:
    return F.translate(_c(col), _BASES, _COMPLEMENTS)


def revcomp(col: Column | str) -> Column:
    """Reverse complement, IUPAC codes included; other characters stay."""
    return F.reverse(complement(col))


def u_to_t(col: Column | str) -> Column:
    return F.translate(_c(col), "Uu", "Tt")


def first_token(col: Column | str) -> Column:
    """A header up to its first white space."""
    return F.regexp_extract(_c(col), r"^(\S*)", 1)


def chars(col: Column | str) -> Column:
    """The characters of a string as an array; an empty string has none."""
    return F.filter(F.split(_c(col), ""), lambda x: x != "")


def phred(col: Column | str, encoding: str = "sanger") -> Column:
    """Qualities of a string: offset 33 (``sanger``), offset 64 (``illumina``), or the older log scale (``solexa``), unrounded."""
    codes = F.transform(chars(col), lambda x: F.ascii(x))
    if encoding == "sanger":
        return F.transform(codes, lambda x: x - 33)
    if encoding == "illumina":
        return F.transform(codes, lambda x: x - 64)
    if encoding == "solexa":
        return F.transform(codes, lambda x: 10 * F.log10(1 + F.pow(F.lit(10.0), (x - 64) / F.lit(10.0))))
    raise ValueError(f"unknown encoding {encoding}")


def encode_quality(values: Column | str, offset: int = 33) -> Column:
    """An array of qualities as a string."""
    return F.array_join(F.transform(_c(values), lambda x: F.char(x + offset)), "")


def max_quality(a: Column | str, b: Column | str) -> Column:
    """The better quality at each position; beyond the shorter string, the longer one's."""
    return F.array_join(F.zip_with(chars(a), chars(b), lambda x, y: F.greatest(x, y)), "")


def circular_junction(col: Column | str, n: int) -> Column:
    """The last n bases followed by the first n: what a read across the closing point sees."""
    return F.concat(F.right(_c(col), F.lit(n)), F.left(_c(col), F.lit(n)))


def mate_suffix(col: Column | str, mate: int) -> Column:
    """An id with /1 or /2, added where it is absent."""
    tail = f"/{mate}"
    return F.when(F.endswith(_c(col), F.lit(tail)), _c(col)).otherwise(F.concat(_c(col), F.lit(tail)))


def strip_mate(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), r"/[12]$", "")


def to_base(col: Column | str, base: int = 36) -> Column:
    return F.conv(_c(col).cast("string"), 10, base)


def arm_of(fold: Column | str, start: Column | str, length: Column | str) -> Column:
    """5p or 3p: which side of the hairpin a span (1-based) pairs with; null if it opens as often as it closes."""
    span = F.substring(_c(fold), _c(start), _c(length))
    opened, closed = F.length(F.regexp_replace(span, r"[^(]", "")), F.length(F.regexp_replace(span, r"[^)]", ""))
    return F.when(opened > closed, "5p").when(closed > opened, "3p")


def max_mismatches(length: Column | str, error: float = 0.02, threshold: float = 0.04, most: int = 200) -> Column:
    """The smallest k >= 2 for which a Poisson count with mean length * error exceeds k with probability below ``threshold``."""
    mean = _c(length) * F.lit(error)
    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("sum"), F.lit(None).cast("int").alias("k"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * mean / k
        total = acc["sum"] + term
        return F.struct(term.alias("term"), total.alias("sum"), F.coalesce(acc["k"], F.when(1 - total < threshold, k)).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step, lambda acc: F.greatest(F.coalesce(acc["k"], F.lit(2)), F.lit(2)))
