"""Rows known by what they hold, for tables that are evaluated more than once.

A row's number depends on how the table is dealt out, which can change from one
evaluation to the next; a digest of its id and text doesn't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from omicspark.storage import free_name


def row_key(id_col: str, text_col: str) -> Column:
    """128 bits that tell a row by its id and text, the same wherever the row stands."""
    known = F.concat(F.col(id_col).isNull().cast("string"), F.col(text_col).isNull().cast("string"), F.lit(" "), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(" "))
    return F.unhex(F.md5(F.concat(known.cast("binary"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))))


def one_a_key(rows: DataFrame, key: str, rest: list[str]) -> DataFrame:
    """One row of each key, the same each time; rows beyond it go before the shuffle."""
    n = free_name(rows, "__n")
    first = Window.partitionBy(key).orderBy(F.xxhash64(*rest) if rest else F.lit(0))
    return rows.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1).drop(n)


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of ``docs`` for each row key of ``keys`` (key), with the columns of ``docs``, whatever these are called.

    The keys grow with the table, so they are no side to broadcast, however few they are today.
    """
    key = free_name(docs, "__row_key")
    others = [f"`{c}`" for c, kind in docs.dtypes if c not in (id_col, text_col) and not kind.startswith(("map", "variant"))]
    rows = one_a_key(docs.withColumn(key, row_key(id_col, text_col)), key, others)
    return rows.join(keys.select(F.col("key").alias(key)).hint("merge"), key, "left_semi").drop(key)
