"""Range and overlap joins by bins, nearest labels, and counts of points in ranges.

A range join needs a real equi key, or it falls back to a nested loop: every range is written once
per bin it touches, every point once, and (key, bin) is the join key. A hot key is split by its bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _binned(df: DataFrame, lo: str, hi: str, width: int, out: str) -> DataFrame:
    return df.withColumn(out, F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))


def points_in_ranges(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, lo: str, hi: str, width: int) -> DataFrame:
    """Every (range, point) with lo <= at <= hi on the same keys."""
    p = points.withColumn("_bin", F.floor(F.col(at) / width))
    r = _binned(ranges.filter(F.col(lo) <= F.col(hi)), lo, hi, width, "_bin")
    return r.join(p, [*keys, "_bin"]).filter((F.col(at) >= F.col(lo)) & (F.col(at) <= F.col(hi))).drop("_bin")


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], width: int, least: int) -> DataFrame:
    """Pairs of spans (lo, hi) and (lo2, hi2) on the same keys that share at least ``least`` units. A pair is
    emitted in one bin only, the one where its shared part begins. ``right`` has its columns renamed."""
    a = _binned(left, "lo", "hi", width, "_bin")
    b = _binned(right, "lo2", "hi2", width, "_bin")
    shared = F.least("hi", "hi2") - F.greatest("lo", "lo2") + 1
    first = F.floor(F.greatest("lo", "lo2") / width)
    return a.join(b, [*keys, "_bin"]).filter((shared >= least) & (F.col("_bin") == first)).withColumn("shared", shared).drop("_bin")


def counted_beside(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, lo: str, hi: str, width: int, block: int = 1 << 20) -> DataFrame:
    """Adds n_left, n_right to ``ranges`` (with a unique ``rid``): points before lo and beyond hi.

    Not a range join: the points before a place are the place's prefix count. Points and range ends are
    united as events and counted in two levels, so the cost is a sort, whatever the counts."""
    from .prefix import prefix_sum

    places = ranges.select(*keys, "rid", F.explode(F.array(F.struct(F.col(lo).alias("at"), F.lit("L").alias("side")), F.struct((F.col(hi) + 1).alias("at"), F.lit("R").alias("side")))).alias("e"))
    counts = points.groupBy(*keys, F.col(at).alias("_at")).agg(F.count("*").alias("_n"))
    wanted = places.groupBy(*keys, F.col("e.at").alias("_at")).agg(F.lit(0).alias("_zero"))
    events = counts.select(*keys, "_at", "_n").unionByName(wanted.select(*keys, "_at", F.lit(0).cast("long").alias("_n"))).groupBy(*keys, "_at").agg(F.sum("_n").alias("_n"))
    summed = prefix_sum(events, keys, "_at", "_n", "_upto", block).select(*keys, "_at", (F.col("_upto") - F.col("_n")).alias("_before"), "total")
    found = places.select(*keys, "rid", F.col("e.at").alias("_at"), F.col("e.side").alias("side")).join(summed, [*keys, "_at"])
    sides = found.groupBy("rid").agg(F.max(F.when(F.col("side") == "L", F.col("_before"))).alias("n_left"), F.max(F.when(F.col("side") == "R", F.col("total") - F.col("_before"))).alias("n_right"))
    return ranges.join(sides, "rid")


def at_or_before(points: DataFrame, probes: DataFrame, payload: list[str], block: int = 1 << 20) -> DataFrame:
    """Adds to ``probes`` (map_id, at, and whatever else) ``found``: a struct of pos and ``payload`` of the nearest
    point (map_id, pos, unique) at or before ``at``, null if there is none. One running maximum over both, in
    two levels, so a hot map is spread over its blocks."""
    from pyspark.sql import Window

    seen = F.struct("pos", *payload)
    kind = points.select(seen.alias("s")).schema["s"].dataType
    row = F.struct(*probes.columns)
    both = points.select("map_id", F.col("pos").alias("at"), seen.alias("seen"), F.lit(None).cast(probes.select(row.alias("r")).schema["r"].dataType).alias("probe")).unionByName(
        probes.select("map_id", "at", F.lit(None).cast(kind).alias("seen"), row.alias("probe"))
    )
    both = both.withColumn("_b", F.floor(F.col("at") / block))
    tops = both.groupBy("map_id", "_b").agg(F.max("seen").alias("top"))
    tops = tops.withColumn("carry", F.max("top").over(Window.partitionBy("map_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).drop("top")
    w = Window.partitionBy("map_id", "_b").orderBy("at", F.col("probe").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.join(tops, ["map_id", "_b"]).withColumn("found", F.coalesce(F.max("seen").over(w), "carry"))
    return found.filter("probe IS NOT NULL").select("probe.*", "found")
