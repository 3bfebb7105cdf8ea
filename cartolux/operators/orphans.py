"""References to records that do not exist, came later, were withdrawn or disagree.

Parents (maps) and children (both sides of every hit) are united as tagged keys in long form and
grouped by key. The group has a parent flag, the parent's facts and the range of what its children
ask of it; a group that can hold no bad reference ends here. Only the rest is joined back to the
hits, salted, so a key named by a third of all hits is spread over many tasks.

Cases. A null key refers to nothing and is left out. A parent without a known load time is never
late, without a withdrawal never deleted, without a usable length never of another length; unusable
is null, NaN or infinite. A hit without ``aligned_at`` has a null period and is neither late nor
deleted. Of several lengths of a map the largest counts, of several load and withdrawal times the
first. Hits sent twice give one row. Columns beyond those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import salted_join

TOLERANCE = 1.0


def _known(length: Column) -> Column:
    return F.when(~F.isnan(length) & (F.abs(length) != float("inf")), length)


def references(hits: DataFrame) -> DataFrame:
    """Long form of the child side: one row per hit and side with a key."""
    sides = [("qry", "QryContigID", "QryLen"), ("ref", "RefContigID", "RefLen")]
    each = F.array(*[F.struct(F.lit(side).alias("side"), F.col(key).alias("key"), _known(F.col(length)).alias("len")) for side, key, length in sides])
    return hits.select("XmapEntryID", "aligned_at", F.explode(each).alias("r")).filter(F.col("r.key").isNotNull()).select("XmapEntryID", "aligned_at", "r.*")


def suspects(maps: DataFrame, refs: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per key for which some reference may be bad, with the parent's facts."""
    none = lambda kind: F.lit(None).cast(kind)
    parents = maps.filter(F.col("CMapId").isNotNull()).select(
        F.col("CMapId").alias("key"), F.lit(True).alias("parent"), F.col("loaded_at").alias("loaded"), F.col("retired_at").alias("retired"),
        _known(F.col("ContigLength")).alias("own_len"), none("timestamp").alias("asked"), none("double").alias("len"),
    )
    children = refs.select(
        "key", F.lit(False).alias("parent"), none("timestamp").alias("loaded"), none("timestamp").alias("retired"),
        none("double").alias("own_len"), F.col("aligned_at").alias("asked"), "len",
    )
    groups = parents.unionByName(children).groupBy("key").agg(
        F.max("parent").alias("parent"), F.min("loaded").alias("loaded"), F.min("retired").alias("retired"), F.max("own_len").alias("own_len"),
        F.min("asked").alias("first_asked"), F.max("asked").alias("last_asked"), F.min("len").alias("least"), F.max("len").alias("most"), F.bool_and("parent").alias("unused"),
    )
    bad = ~F.col("parent") | (F.col("loaded") > F.col("first_asked")) | (F.col("retired") <= F.col("last_asked")) | (F.col("own_len") - F.col("least") > tolerance) | (F.col("most") - F.col("own_len") > tolerance)
    return groups.filter(~F.col("unused") & F.coalesce(bad, F.lit(False))).select("key", "parent", "loaded", "retired", "own_len")


def orphans(maps: DataFrame, hits: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(xmapentryid, side, reason, period), distinct."""
    refs = references(hits)
    both = salted_join(refs, suspects(maps, refs, tolerance), ["key"], [F.col("XmapEntryID"), F.col("side")])
    reason = (
        F.when(~F.col("parent"), "missing")
        .when(F.col("loaded") > F.col("aligned_at"), "late")
        .when(F.col("retired") <= F.col("aligned_at"), "deleted")
        .when(F.abs(F.col("len") - F.col("own_len")) > tolerance, "length")
    )
    return (
        both.select(F.col("XmapEntryID").alias("xmapentryid"), "side", reason.alias("reason"), F.date_format("aligned_at", "yyyy-MM").alias("period"))
        .filter(F.col("reason").isNotNull())
        .distinct()
    )


def per_period(found: DataFrame, parent: str = "cmap", child: str = "xmap") -> DataFrame:
    """Bad references counted per table, side, reason and month."""
    return found.groupBy(F.lit(parent).alias("parent_table"), F.lit(child).alias("child_table"), "side", "reason", "period").agg(F.count("*").alias("n_refs"))
