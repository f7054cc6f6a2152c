"""Taxonomy: root paths, merged ids, lineage-compatible hits, lowest common ancestors.

A taxon is known by its path, the taxa from the root down to it. Paths in order are
the tree in preorder, so one taxon is above another if its path begins the other's,
and the lowest common ancestor of a set is where its least and its greatest path
part. Paths come from doubling pointers, so a tree of any depth takes a join for each
doubling of its depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omicspark.storage import free_name, materialize

MOST_DOUBLINGS = 40  # depths up to 2^40: what goes on longer is a circle


def taxon_paths(nodes: DataFrame) -> DataFrame:
    """(taxid, path) of nodes (taxid, parent): the taxa from the root to each node, itself last.

    A root is its own parent or has none; a parent without a row of its own counts as a
    root. Each round joins what is above the paths so far, which doubles them; finished
    ones take no part. Parents that lead in a circle are an error. Repeated nodes
    count once. A path is a row, as long as the tree is deep.
    """
    up = F.when(F.col("parent") != F.col("taxid"), F.col("parent"))
    open_ = materialize(nodes.where("taxid IS NOT NULL").select("taxid", F.array("taxid").alias("path"), up.alias("up")).dropDuplicates(["taxid"]), "paths")
    count = open_.count()
    done = None
    every = open_
    for doubling in range(MOST_DOUBLINGS):
        finished = every.where("up IS NULL").select("taxid", "path")
        done = finished if done is None else done.unionByName(finished)
        rest = every.where("up IS NOT NULL")
        if rest.isEmpty():
            return done
        if 1 << doubling > 2 * count:
            break
        # What is above: its own segment so far, finished or not.
        known = (every if doubling == 0 else every.unionByName(done.withColumn("up", F.lit(None).cast(dict(every.dtypes)["up"])))).dropDuplicates(["taxid"])
        above = known.select(F.col("taxid").alias("__above"), F.col("path").alias("__path"), F.col("up").alias("__up"))
        met = rest.join(above.hint("merge"), rest["up"] == above["__above"], "left")
        joined = met.select("taxid", F.concat(F.coalesce("__path", F.array("up")), "path").alias("path"), F.col("__up").alias("up"))
        every = materialize(joined, "paths")
    raise ValueError("parents lead in a circle")


def taxon_closure(nodes: DataFrame) -> DataFrame:
    """(ancestor, descendant, depth) of nodes (taxid, parent): each node with itself at depth 0 and all above it."""
    whole = taxon_paths(nodes).select(F.col("taxid").alias("descendant"), F.size("path").alias("n"), F.posexplode("path").alias("at", "ancestor"))
    return whole.select("ancestor", "descendant", (F.col("n") - 1 - F.col("at")).alias("depth"))


def replace_merged(df: DataFrame, merged: DataFrame, col: str) -> DataFrame:
    """A row for each id of a white-space delimited column, merged ids (old, new) replaced."""
    one, new = free_name(df, "__id"), free_name(df, "__new")
    ids = df.withColumn(one, F.explode(F.filter(F.split(F.col(col), r"\s+"), lambda x: x != "").cast("array<bigint>")))
    return ids.join(merged.select(F.col("old").alias(one), F.col("new").alias(new)), one, "left").withColumn(col, F.coalesce(new, one)).drop(one, new)


def reads_by_taxa(classified: DataFrame, paths: DataFrame, targets: DataFrame) -> DataFrame:
    """(target, read): classified reads (read, taxid) whose taxon is the target, above it or below it. paths: taxon_paths.

    Each taxon that reads name meets the targets on its path, and each target the taxa
    on its own, once, however many reads there are.
    """
    named = targets.select(F.col("taxid").alias("target")).distinct()
    seen = classified.select("taxid").distinct().join(paths, "taxid")
    below = seen.select("taxid", F.explode("path").alias("target")).join(named, "target").select("target", "taxid")
    above = named.join(paths, F.col("target") == F.col("taxid")).select("target", F.explode("path").alias("taxid"))
    return classified.join(below.unionByName(above).distinct(), "taxid").select("target", "read")


def taxon_compatible(hits: DataFrame, paths: DataFrame, ids: str, taxid: int, sep: str = "__") -> DataFrame:
    """Hits of which one of the delimited ids is the taxon, above it or below it. paths: taxon_paths."""
    row, one = free_name(hits, "__row"), "__id"
    above = paths.where(F.col("taxid") == taxid).select(F.explode("path").alias(one))
    kin = paths.where(F.array_contains("path", taxid)).select(F.col("taxid").alias(one)).unionByName(above).distinct()
    # Written once with its number, as another evaluation could number rows otherwise.
    keyed = materialize(hits.withColumn(row, F.monotonically_increasing_id()), "taxon-hits")
    good = keyed.select(row, F.explode(F.split(ids, sep).cast("array<bigint>")).alias(one)).join(kin, one).select(row).distinct()
    return keyed.join(good, row, "left_semi").drop(row)


def _shared(a: str, b: str) -> Column:
    """What two paths begin with."""
    parted = F.filter(F.sequence(F.lit(1), F.least(F.size(a), F.size(b))), lambda i: F.element_at(F.col(a), i) != F.element_at(F.col(b), i))
    return F.slice(a, F.lit(1), F.coalesce(F.get(parted, 0) - 1, F.least(F.size(a), F.size(b))))


def lca(df: DataFrame, paths: DataFrame, key: str, taxid: str, strip: bool = False) -> DataFrame:
    """(key, lca): the lowest common ancestor of each key's taxa. paths: taxon_paths.

    strip: first leave out taxa that are above all others of their key; what is
    left may be one taxon, which then is the answer. Taxa without a path count
    for nothing, keys whose taxa share no root have no row. Least and greatest paths
    combine before they move, so a key may have any number of taxa.
    """
    members = df.select(F.col(key).alias("key"), F.col(taxid).alias("taxid")).where("taxid IS NOT NULL").distinct()
    placed = members.join(paths, "taxid").select("key", "path")
    ends = placed.groupBy("key").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    if strip:
        # Those that the greatest path goes through are in a line. Without others the last of the line is
        # left; else the line is stripped down to where the others part from it, and that is their ancestor.
        high = ends.select(F.col("key").alias("__key"), "high")
        lined = F.slice("high", F.lit(1), F.size("path")) == F.col("path")
        others = placed.join(high, F.col("key").eqNullSafe(F.col("__key"))).where(~lined).groupBy("key").agg(F.min("path").alias("low"))
        ends = high.join(others, F.col("key").eqNullSafe(F.col("__key")), "left").select(F.col("__key").alias("key"), F.coalesce("low", "high").alias("low"), "high")
    found = ends.withColumn("shared", _shared("low", "high")).where(F.size("shared") > 0)
    return found.select(F.col("key").alias(key), F.element_at("shared", -1).alias("lca"))
