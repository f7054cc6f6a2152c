"""Reads and mate pairs: merging, trimming, repair, collapse of duplicates, alignment flags."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F, types as T

from omicspark.functions.sequences import chars, mate_suffix, phred, revcomp, strip_mate

SECONDARY, REVERSE, UNMAPPED = 0x100, 0x10, 0x4


def merge_pairs(r1: DataFrame, r2: DataFrame, strict: bool = False) -> DataFrame:
    """(id, seq1, seq2, qual1, qual2) of reads whose ids, mate suffix aside, are in both. strict: only pairs of equal length."""
    side = lambda df, n: df.select(strip_mate("read_id").alias("id"), F.col("seq").alias(f"seq{n}"), F.col("qual").alias(f"qual{n}"))
    pairs = side(r1, 1).join(side(r2, 2), "id")
    return pairs.where(F.length("seq1") == F.length("seq2")) if strict else pairs


def unmerge_pairs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two mates of pairs, with their suffixes."""
    side = lambda n: pairs.select(mate_suffix("id", n).alias("read_id"), F.col(f"seq{n}").alias("seq"), F.col(f"qual{n}").alias("qual"))
    return side(1), side(2)


def split_merged(df: DataFrame) -> DataFrame:
    """Mates of merged strings of two equal halves: the first half to mate 1, the second to mate 2, of bases and qualities alike."""
    half = F.floor(F.length("seq") / 2).cast("int")
    return df.select("id", F.substring("seq", F.lit(1), half).alias("seq1"), F.substring("seq", half + 1, F.length("seq")).alias("seq2"), F.substring("qual", F.lit(1), half).alias("qual1"), F.substring("qual", half + 1, F.length("qual")).alias("qual2"))


def concat_pairs(r1: DataFrame, r2: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(mates joined by n ``N`` of the lowest quality, ids that only one side has)."""
    pairs = merge_pairs(r1, r2)
    joined = pairs.select("id", F.concat("seq1", F.lit("N" * n), "seq2").alias("seq"), F.concat("qual1", F.lit("!" * n), "qual2").alias("qual"))
    a, b = r1.select(strip_mate("read_id").alias("id")), r2.select(strip_mate("read_id").alias("id"))
    return joined, a.join(b, "id", "left_anti").unionByName(b.join(a, "id", "left_anti"))


def trim_to(df: DataFrame, length: Column) -> DataFrame:
    """Bases and qualities cut to a length."""
    return df.withColumns({"seq": F.substring("seq", F.lit(1), length), "qual": F.substring("qual", F.lit(1), length)})


def trim_fixed(df: DataFrame, length: int) -> DataFrame:
    return trim_to(df, F.lit(length))


def first_low(quals: Column, q: int) -> Column:
    """The number of bases before the first with quality below q; all, if there is none."""
    at = F.array_position(F.transform(quals, lambda x: x < q), True)
    return F.when(at == 0, F.size(quals)).otherwise(at - 1).cast("int")


def trim_first_low(df: DataFrame, q: int, min_length: int, encoding: str = "sanger") -> DataFrame:
    """Reads cut at the first base with quality below q; ``passed`` is false for what is left of less than min_length."""
    cut = df.withColumn("__cut", first_low(phred("qual", encoding), q))
    return trim_to(cut.withColumn("passed", F.col("__cut") >= min_length), F.col("__cut")).drop("__cut")


def _window_cut(quals: np.ndarray, q: float) -> int:
    """Bases to keep: the windows of a tenth of the read slide by one; in the first with a mean below q, or in what is left past the last, the first base below q ends the read."""
    n = len(quals)
    if not n:
        return 0
    w = max(1, n // 10)
    sums = np.concatenate([[0], np.cumsum(quals)])
    low = np.flatnonzero((sums[w:] - sums[:-w]) / w < q)
    start = int(low[0]) if len(low) else n - w + 1
    bad = np.flatnonzero(quals[start:] < q)
    return start + int(bad[0]) if len(bad) else n


def _bwa_cut(quals: np.ndarray, q: float) -> int:
    """Bases to keep by the running sum of q - quality from the 3' end, stopped when negative, cut where it is greatest."""
    sums = np.cumsum(q - quals[::-1])
    below = np.flatnonzero(sums < 0)
    seen = sums[: int(below[0])] if len(below) else sums
    return len(quals) if not len(seen) or seen.max() <= 0 else len(quals) - 1 - int(seen.argmax())


def _cuts(rule):
    @F.pandas_udf(T.IntegerType())
    def column(quals: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([0 if s is None else rule(np.frombuffer(s.encode("latin-1", "replace"), dtype=np.uint8).astype(np.int64) - 33, t) for s, t in zip(quals, q)], dtype="int32")

    return column


def trim_window(df: DataFrame, q: int, min_length: int) -> DataFrame:
    cut = df.withColumn("__cut", _cuts(_window_cut)(F.col("qual"), F.lit(q)))
    return trim_to(cut.withColumn("passed", F.col("__cut") >= min_length), F.col("__cut")).drop("__cut")


def trim_bwa(df: DataFrame, q: int) -> DataFrame:
    """Reads trimmed from the 3' end; one that is trimmed away is ``N`` with quality ``#``."""
    cut = df.withColumn("__cut", _cuts(_bwa_cut)(F.col("qual"), F.lit(q)))
    return cut.withColumns({"seq": F.when(F.col("__cut") > 0, F.substring("seq", F.lit(1), F.col("__cut"))).otherwise("N"), "qual": F.when(F.col("__cut") > 0, F.substring("qual", F.lit(1), F.col("__cut"))).otherwise("#")}).drop("__cut")


def route_pairs(df: DataFrame, first: str = "passed1", second: str = "passed2") -> DataFrame:
    """``route``: paired if both mates passed, single if one did, else none."""
    return df.withColumn("route", F.when(F.col(first) & F.col(second), "paired").when(F.col(first) | F.col(second), "single").otherwise("none"))


def repair_pairs(guide: DataFrame, f1: DataFrame, f2: DataFrame, key: str = "id") -> DataFrame:
    """Each id of the guide with its route: paired, single1, single2 or none, by which mates are left."""
    one, two = (f.select(key).distinct().withColumn(f"__in{n}", F.lit(True)) for n, f in ((1, f1), (2, f2)))
    a, b = F.col("__in1").isNotNull(), F.col("__in2").isNotNull()
    joined = guide.join(one, key, "left").join(two, key, "left")
    return joined.withColumn("route", F.when(a & b, "paired").when(a, "single1").when(b, "single2").otherwise("none")).drop("__in1", "__in2")


def remove_mapped(reads: DataFrame, alignments: DataFrame) -> DataFrame:
    """Reads that no mapped alignment names, mate suffixes aside."""
    mapped = alignments.where(F.col("flag").bitwiseAND(UNMAPPED) == 0).select(strip_mate("qname").alias("__name")).distinct()
    return reads.withColumn("__name", strip_mate("read_id")).join(mapped, "__name", "left_anti").drop("__name")


def recover_descr(df: DataFrame, ref: DataFrame) -> DataFrame:
    """``df`` with the description that a row of the same id and sequence has in ``ref``; its own where there is none."""
    known = ref.groupBy("read_id", "seq").agg(F.min("descr").alias("__descr"))
    return df.join(known, ["read_id", "seq"], "left").withColumn("descr", F.coalesce("__descr", "descr")).drop("__descr").select(*df.columns)


def se_to_pe(df: DataFrame) -> DataFrame:
    """Each read and its reverse complement as interleaved mates: the mate number is flipped, 1 where there is none."""
    base = strip_mate("read_id")
    own = F.when(F.endswith("read_id", F.lit("/2")), 2).otherwise(1)
    mate = lambda n, s, q: F.struct(F.concat(base, F.lit("/"), n.cast("string")).alias("read_id"), s.alias("seq"), q.alias("qual"))
    both = F.array(mate(own, F.col("seq"), F.col("qual")), mate(3 - own, revcomp("seq"), F.reverse("qual")))
    return df.select(F.explode(both).alias("m")).select("m.*")


def fasta_to_fastq(df: DataFrame, quals: DataFrame | None = None, offset: int = 33, default: int = 40) -> DataFrame:
    """Sequences with the qualities (seq_id, values array<int>) of their id, or a default for every base."""
    usual = F.repeat(F.lit(chr(default + offset)), F.length("seq"))
    if quals is None:
        return df.withColumn("qual", usual)
    own = quals.select("seq_id", F.array_join(F.transform("values", lambda x: F.char(x + offset)), "").alias("__qual"))
    return df.join(own, "seq_id", "left").withColumn("qual", F.coalesce("__qual", usual)).drop("__qual")


def rename_ids(df: DataFrame, prefix: str, id_col: str, mapping: DataFrame | None = None) -> DataFrame:
    """``df`` with ``new_id``: what mapping (old_id, new_id) gives, else the prefix and a 10-digit hex counter in the order of ids; equal ids share one."""
    from omicspark.operators.ranks import global_row_number

    ids = global_row_number(df.select(id_col).where(F.col(id_col).isNotNull()).distinct(), [id_col], "__n")
    named = ids.withColumn("new_id", F.concat(F.lit(prefix), F.lpad(F.hex("__n"), 10, "0"))).drop("__n")
    if mapping is not None:
        given = mapping.groupBy(F.col("old_id").alias(id_col)).agg(F.min("new_id").alias("__given"))
        named = named.join(given, id_col, "left").withColumn("new_id", F.coalesce("__given", "new_id")).drop("__given")
    return df.join(named, id_col, "left")


def restore_ids(df: DataFrame, mapping: DataFrame, col: str, key: str, width: int = 0, pad: str = " ", sub: str | None = None, repl: str = "") -> DataFrame:
    """Text with each word that is a new id put back to the old one. mapping (old_id, new_id); key tells rows apart.

    width: shorter old ids are filled on the right with ``pad``. sub: what this
    pattern finds in them becomes ``repl``, after filling. A row's words meet in one task.
    """
    old = F.when(F.length("old_id") < width, F.rpad("old_id", width, pad)).otherwise(F.col("old_id"))
    mapping = mapping.groupBy("new_id").agg(F.min("old_id").alias("old_id")).select("new_id", (F.regexp_replace(old, sub, repl) if sub else old).alias("old_id"))
    words = df.select(key, F.posexplode(F.split(col, "(?<=\\s)|(?=\\s)")).alias("at", "new_id"))
    old = words.join(mapping.select("new_id", "old_id"), "new_id", "left").select(key, F.struct("at", F.coalesce("old_id", "new_id").alias("word")).alias("w"))
    texts = old.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["word"]), "").alias("__text"))
    return df.join(texts, key, "left").withColumn(col, F.coalesce("__text", F.col(col))).drop("__text")


def amplicon_from_hits(reads: DataFrame, hits: DataFrame, min_length: int) -> DataFrame:
    """Parts of reads that exactly one primer under one name hits: from start to end, or to start + primer - 1 on the reverse strand. Hits (read_id, primer, name, flag, start)."""
    one = hits.distinct().groupBy("read_id").agg(F.count_distinct("primer").alias("p"), F.count_distinct("name").alias("n"), F.min("flag").alias("flag"), F.min("start").alias("start"), F.min("primer").alias("primer")).where("p = 1 AND n = 1")
    joined = reads.join(one, "read_id")
    backward = F.col("flag").bitwiseAND(REVERSE) != 0
    part = F.when(backward, F.substring("seq", F.lit(1), (F.col("start") + F.length("primer") - 1).cast("int"))).otherwise(F.substring("seq", F.col("start").cast("int"), F.length("seq")))
    return joined.select("read_id", part.alias("seq")).where(F.length("seq") > min_length)


def unique_alignments(alignments: DataFrame) -> DataFrame:
    """Alignments of reads that have no other. Counts combine before they move; alignments are joined to them."""
    once = alignments.groupBy("qname").agg(F.count("*").alias("n")).where("n = 1").select("qname")
    return alignments.join(once, "qname", "left_semi")


def fix_primary(alignments: DataFrame, tie: list[str]) -> DataFrame:
    """One primary alignment for each read and mate: one not marked secondary, then the first by ``tie``; the others are marked."""
    mate = F.col("flag").bitwiseAND(0xC0)
    order = Window.partitionBy("qname", mate).orderBy(F.col("flag").bitwiseAND(SECONDARY), *tie)
    ranked = alignments.withColumn("__n", F.row_number().over(order))
    return ranked.withColumn("flag", F.when(F.col("__n") == 1, F.col("flag").bitwiseAND(~SECONDARY)).otherwise(F.col("flag").bitwiseOR(SECONDARY))).drop("__n")


def fix_missing_mate(alignments: DataFrame, names: DataFrame, side: int) -> DataFrame:
    """Alignments whose read name is a number: the name of that number, flags of a read whose mate is not mapped. names (n, name)."""
    bit = {1: 0x40, 2: 0x80}[side]
    named = alignments.join(names, alignments["qname"].cast("long") == names["n"])
    flag = F.col("flag").bitwiseOR(0x1 | 0x8 | bit).bitwiseAND(~SECONDARY)
    return named.select(*[F.col("name").alias("qname") if c == "qname" else flag.alias("flag") if c == "flag" else alignments[c] for c in alignments.columns])


def best_qualities(rows: DataFrame, by: list[str], quals: list[str]) -> DataFrame:
    """(by, __n, quals): the number of rows of each key, and the greatest code at each position of each quality column, whatever their lengths.

    Keys with one row have theirs. The others become a row a position: maxima
    combine before rows move, and no task sees all rows of a key.
    """
    found = rows.groupBy(*by).agg(F.count("*").alias("__n"), *[F.min(q).alias(q) for q in quals])
    several = rows.join(found.where("__n > 1").select(*by), by, "left_semi")
    best = _greatest(several, by, quals).select(*by, *[F.col(q).alias(f"__{q}") for q in quals])
    return found.join(best, by, "left").select(*by, "__n", *[F.coalesce(f"__{q}", q).alias(q) for q in quals])


def _greatest(rows: DataFrame, by: list[str], quals: list[str]) -> DataFrame:
    key = F.md5(F.concat_ws("\x00", *by).cast("binary"))
    named = rows.select(key.alias("__key"), *by, F.posexplode(F.array(*[F.struct(F.lit(i).alias("col"), F.col(q).alias("text")) for i, q in enumerate(quals)])).alias("__i", "__q"))
    at = named.select("__key", *by, "__i", F.posexplode(chars("__q.text")).alias("__at", "__c"))
    best = at.groupBy("__key", "__i", "__at").agg(F.max("__c").alias("__c"), *[F.first(c).alias(c) for c in by])
    whole = lambda i: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("__i") == i, F.struct("__at", "__c")))), lambda x: x["__c"]), "")
    return best.groupBy("__key").agg(*[F.first(c).alias(c) for c in by], *[whole(i).alias(q) for i, q in enumerate(quals)]).drop("__key")


def _same_length(seq: str, qual: str) -> Column:
    return F.when(F.length(seq) == F.length(qual), F.col(qual)).otherwise(F.raise_error(F.concat(F.lit("lengths of sequence and quality differ: "), F.col(seq), F.lit(" "), F.col(qual))))


def dedup_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with equal bases as one: the smallest id, the number, the best quality at each position. Qualities as long as their bases, else an error."""
    known = pairs.select("id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("seq1", "seq2", "qual1", "qual2")])
    checked = known.withColumns({f"qual{i}": _same_length(f"seq{i}", f"qual{i}") for i in (1, 2)})
    first = checked.groupBy("seq1", "seq2").agg(F.min("id").alias("id"))
    best = best_qualities(checked, ["seq1", "seq2"], ["qual1", "qual2"])
    return first.join(best, ["seq1", "seq2"]).select("id", "seq1", "seq2", F.col("__n").alias("n"), "qual1", "qual2")


def dedup_reads(reads: DataFrame, prefix: str, run: int) -> tuple[DataFrame, DataFrame]:
    """(unique reads, log of old and new names). A name with ``_xN`` stands for N reads.

    New names: prefix (3 letters), run (one digit), ``_``, the 9-digit rank of the
    sequence, ``_x`` and the number of reads. Qualities are the best at each
    position; they are as long as their bases, else an error.
    """
    from omicspark.operators.ranks import global_row_number

    if len(prefix) != 3 or not 0 <= run <= 9:
        raise ValueError("the prefix has 3 letters, the run is a digit")
    n = F.regexp_extract("read_id", r"_x(\d+)$", 1)
    reads = reads.withColumns({c: F.coalesce(c, F.lit("")) for c in ("seq", "qual")})
    found = reads.groupBy("seq").agg(F.sum(F.when(n != "", n.cast("long")).otherwise(1)).alias("n"))
    best = best_qualities(reads.select("seq", _same_length("seq", "qual").alias("qual")), ["seq"], ["qual"])
    ranked = global_row_number(found.join(best, "seq").select("seq", "n", "qual"), ["seq"], "__rank")
    unique = ranked.select(F.concat(F.lit(f"{prefix}{run}_"), F.lpad(F.col("__rank").cast("string"), 9, "0"), F.lit("_x"), F.col("n").cast("string")).alias("read_id"), "seq", "qual", "n")
    log = reads.select(F.col("read_id").alias("old_id"), "seq").join(unique.select(F.col("read_id").alias("new_id"), "seq"), "seq").select("old_id", "new_id")
    return unique, log


def expand_cigar(alignments: DataFrame) -> DataFrame:
    """Lengths told by a CIGAR: aligned (M, =, X), inserted, deleted and clipped bases, and the end on the reference (0-based, half-open)."""

    def total(kinds: str) -> Column:
        return F.aggregate(F.regexp_extract_all("cigar", F.lit(rf"(\d+)[{kinds}]"), 1), F.lit(0).cast("bigint"), lambda n, x: n + x.cast("bigint"))

    return alignments.withColumns({"aligned": total("M=X"), "inserted": total("I"), "deleted": total("D"), "clipped": total("SH"), "ref_end": F.col("pos") - 1 + total("M=XDN")})


_ALIGNED = T.StructType([T.StructField("query_aligned", T.StringType()), T.StructField("hit_aligned", T.StringType()), T.StructField("gaps", T.LongType()), T.StructField("hit_length", T.LongType())])
_CIGAR, _MD = re.compile(r"(\d+)([MIDNSHP=X])"), re.compile(r"(\d+)|\^([A-Za-z]+)|([A-Za-z])")


def aligned_strings(seq: str | None, cigar: str | None, md: str | None) -> tuple[str, str, int, int] | None:
    """Query and reference with ``-`` for gaps, their number and the reference's length; None where something is missing or doesn't fit."""
    if not seq or not cigar or md is None:
        return None
    query, kinds, at = [], [], 0
    for n, kind in ((int(n), k) for n, k in _CIGAR.findall(cigar)):
        if kind in "M=XI":
            query += seq[at : at + n]
            kinds += ("I" if kind == "I" else "M") * n
        elif kind == "D":
            query += "-" * n
            kinds += "D" * n
        at += n if kind in "M=XIS" else 0
    if at != len(seq):
        return None
    # The reference where it isn't an insertion: MD says what differs, in order.
    hit, places = list(query), iter([i for i, k in enumerate(kinds) if k != "I"])
    try:
        for same, gone, other in _MD.findall(md):
            if same:
                for _ in range(int(same)):
                    if kinds[next(places)] == "D":
                        return None
            for base in gone or other:
                i = next(places)
                if (kinds[i] == "D") != bool(gone):
                    return None
                hit[i] = base
    except StopIteration:
        return None
    if next(places, None) is not None:
        return None
    whole = "".join("-" if k == "I" else b for b, k in zip(hit, kinds))
    return "".join(query), whole, len(kinds) - kinds.count("M"), len(kinds) - kinds.count("I")


def expand_alignment(alignments: DataFrame, order: list[str]) -> DataFrame:
    """Alignments (qname, rname, pos, seq, cigar, md) as pairs of strings.

    query_aligned and hit_aligned with ``-`` for gaps, gaps, hit_to (1-based, the last
    base); hit_num: the ordinal of the reference among those of the query, by their
    first alignment in ``order``; hsp_num: the ordinal among those of both. Strings
    are null where sequence, CIGAR and MD don't fit each other.
    """

    @F.pandas_udf(_ALIGNED)
    def told(seq: pd.Series, cigar: pd.Series, md: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([aligned_strings(*x) or (None, None, None, None) for x in zip(seq, cigar, md)], columns=_ALIGNED.names).astype({"gaps": "Int64", "hit_length": "Int64"})

    own = Window.partitionBy("qname", "rname")
    first = F.min(F.struct(*order)).over(own)
    numbered = alignments.withColumns({"__first": first, "hsp_num": F.row_number().over(own.orderBy(*order))})
    numbered = numbered.withColumn("hit_num", F.dense_rank().over(Window.partitionBy("qname").orderBy("__first", "rname"))).drop("__first")
    strings = numbered.withColumn("__told", told("seq", "cigar", "md"))
    return strings.select("*", "__told.query_aligned", "__told.hit_aligned", "__told.gaps", (F.col("pos") + F.col("__told.hit_length") - 1).alias("hit_to")).drop("__told")


def qc_reads(reads: DataFrame, min_length: int = 20, max_n_percent: float = 5, tail: int = 5, q: int = 20, window: int = 5, max_low_complexity: float = 0.5) -> DataFrame:
    """Reads that pass: 3' and 5' A/T tails of at least ``tail`` bases off, right end off while the mean of its last ``window`` qualities is below q, then length, share of N, no other codes, and the greatest share of one dinucleotide."""

    @F.pandas_udf(T.IntegerType())
    def right_cut(quals: pd.Series) -> pd.Series:
        def one(s):
            x = np.frombuffer((s or "").encode("latin-1", "replace"), dtype=np.uint8).astype(np.int64) - 33
            if len(x) < window:
                return len(x) if len(x) and x.mean() >= q else 0
            sums = np.concatenate([[0], np.cumsum(x)])
            good = np.flatnonzero((sums[window:] - sums[:-window]) / window >= q)
            return int(good[-1]) + window if len(good) else 0

        return pd.Series([one(s) for s in quals], dtype="int32")

    lead = F.length(F.regexp_extract("seq", rf"^(A{{{tail},}}|T{{{tail},}})", 1))
    off = reads.withColumn("__from", lead).withColumns({"seq": F.expr("substring(seq, __from + 1)"), "qual": F.expr("substring(qual, __from + 1)")}).drop("__from")
    keep = F.length(F.regexp_replace("seq", rf"(A{{{tail},}}|T{{{tail},}})$", ""))
    cut = trim_to(off.withColumn("__cut", keep), F.col("__cut")).drop("__cut")
    cut = trim_to(cut.withColumn("__cut", right_cut("qual")), F.col("__cut")).drop("__cut")
    n = F.length("seq")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(F.col("seq"), i, F.lit(2)))
    most = F.transform(F.array(pairs), lambda ps: F.array_max(F.transform(F.array_distinct(ps), lambda d: F.size(F.filter(ps, lambda x: x == d)))))[0] / F.greatest(n - 1, F.lit(1))
    return cut.where((n >= min_length) & (100 * F.length(F.regexp_replace("seq", "[^N]", "")) <= max_n_percent * n) & ~F.regexp_like("seq", F.lit("[^ACGTN]")) & (most <= max_low_complexity))


def base_profile(reads: DataFrame) -> DataFrame:
    """(position, base, n, mean_quality) over all reads; counts combine before they move."""
    at = reads.select(F.posexplode(F.arrays_zip(chars("seq").alias("base"), phred("qual").alias("q"))).alias("at", "x"))
    return at.groupBy((F.col("at") + 1).alias("position"), F.col("x.base").alias("base")).agg(F.count("*").alias("n"), F.avg("x.q").alias("mean_quality"))


def length_histogram(reads: DataFrame) -> DataFrame:
    return reads.groupBy(F.length("seq").alias("length")).agg(F.count("*").alias("n"))
