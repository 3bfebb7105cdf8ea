"""Covered stretches and gaps of intervals, by a sweep over their boundaries.

Each interval becomes a plus event at its start and a minus event at its end; events of one place
are added up before they are shuffled. Prefix sums run in two levels: within blocks of a fixed
width, and over the totals of the blocks. As places are whole numbers, a block holds at most
``BLOCK`` events however many intervals there are, so an entity with a third of all intervals is
swept by many tasks, none of which grows with the data.

Cases. Ends in the wrong order are turned. Without an end, start plus the stand-in length is the
end. Intervals without entity, start or any end (null, NaN or infinite) are left out. An interval
of no length is a stretch of no length unless another covers it. A shared end point is no break.
A null partition key is a partition of its own. Repeated intervals change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 20


def _place(x: Column, scale: float) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < 9e17), F.round(x * scale).cast("long"))


def spans(hits: DataFrame, keys: list[str], start: str, end: str, length: str, scale: float = 10.0) -> DataFrame:
    """keys, lo, hi in whole units of 1/scale."""
    a = _place(F.col(start), scale)
    b = F.coalesce(_place(F.col(end), scale), _place(F.col(start) + F.col(length), scale))
    placed = hits.select(*keys, a.alias("a"), b.alias("b")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    return placed.select(*keys, F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))


def sweep(intervals: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """keys, kind (period or gap), start, end of ``intervals`` (keys, lo, hi)."""
    event = F.explode(F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("plus"), F.lit(0).alias("minus")), F.struct(F.col("hi").alias("at"), F.lit(0).alias("plus"), F.lit(1).alias("minus"))))
    blocked = [*keys, "block"]
    events = (
        intervals.select(*keys, event.alias("e"))
        .select(*keys, F.floor(F.col("e.at") / block).alias("block"), "e.*")
        .groupBy(*blocked, "at")
        .agg(F.sum("plus").alias("plus"), F.sum("minus").alias("minus"))
    )
    over = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = events.groupBy(*blocked).agg(F.sum(F.col("plus") - F.col("minus")).alias("net"))
    carried = totals.select(*blocked, F.coalesce(F.sum("net").over(over), F.lit(0)).alias("open"))
    within = Window.partitionBy(*blocked).orderBy("at")
    active = _with_block(events, carried, blocked, "open").withColumn("after", F.col("open") + F.sum(F.col("plus") - F.col("minus")).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.col("after") - F.col("plus") + F.col("minus")
    edges = active.select(*blocked, "at", ((before == 0) & (F.col("plus") > 0)).alias("opens"), (F.col("after") == 0).alias("closes")).filter("opens or closes")
    lasts = edges.groupBy(*blocked).agg(F.max("at").alias("last"))
    lasts = lasts.select(*blocked, F.max("last").over(over).alias("earlier"))
    paired = _with_block(edges.withColumn("prev", F.lag("at").over(within)), lasts, blocked, "earlier").withColumn("prev", F.coalesce("prev", "earlier"))
    at, prev = F.col("at"), F.col("prev")
    out = F.array(
        F.when(F.col("opens") & prev.isNotNull(), F.struct(F.lit("gap").alias("kind"), prev.alias("start"), at.alias("end"))),
        F.when(F.col("closes"), F.struct(F.lit("period").alias("kind"), F.when(F.col("opens"), at).otherwise(prev).alias("start"), at.alias("end"))),
    )
    return paired.select(*keys, F.explode(F.filter(out, lambda x: x.isNotNull())).alias("x")).select(*keys, "x.*")


def _with_block(rows: DataFrame, per_block: DataFrame, blocked: list[str], value: str) -> DataFrame:
    named = per_block.select(*[F.col(c).alias(f"_{c}") for c in blocked], value)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in blocked]
    return rows.join(named, same).select(*rows.columns, value)


def coverage(hits: DataFrame) -> DataFrame:
    """Stretches and gaps of the reference spans of hits, per alignment set and reference."""
    keys = ["aln_set", "RefContigID"]
    named = spans(hits.filter(F.col("RefContigID").isNotNull()), keys, "RefStartPos", "RefEndPos", "QryLen")
    return sweep(named, keys).select("aln_set", F.col("RefContigID").alias("refcontigid"), "kind", F.col("start").alias("start_dbp"), F.col("end").alias("end_dbp"))
