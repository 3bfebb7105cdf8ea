"""Map sets: channel selection, unification, recombination, cutting, masks, gaps.

Labels have map_set, map_id, site_id, channel, pos. Windows are partitioned by map: a map's labels are
bounded by the length of a chromosome, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import salted_join
from .ranges import points_in_ranges


def channel_subset(labels: DataFrame, channels: list[int]) -> DataFrame:
    """Labels of some channels, channels renumbered in the given order, sites numbered anew, num_sites set."""
    new = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(channels, 1) for x in (c, i)]), F.col("channel"))
    kept = labels.filter(F.col("channel").isin(channels)).withColumn("channel", new)
    w = Window.partitionBy("map_set", "map_id")
    return kept.withColumn("site_id", F.row_number().over(w.orderBy("pos", "channel", "site_id"))).withColumn("num_sites", F.count("*").over(w))


def unified(labels: DataFrame) -> DataFrame:
    """All labels in one channel, terminal rows (channel 0) kept."""
    return labels.withColumn("channel", F.when(F.col("channel") > 0, 1).otherwise(0))


def recombined(sets: DataFrame, codes: DataFrame) -> DataFrame:
    """Single-channel maps put together by id: channels recoded by ``codes`` (map_set, code), sites in order."""
    both = sets.join(F.broadcast(codes), "map_set")  # one row per map set
    w = Window.partitionBy("map_id").orderBy("pos", "code", "map_set", "site_id")
    return both.select("map_id", "map_set", "pos", F.col("code").alias("channel"), F.row_number().over(w).alias("site_id"))


def fragments(cuts: DataFrame, lengths: DataFrame, k: int, n: int, max_id: int) -> DataFrame:
    """Translation rows of maps cut at whole-number places: old_id, old_start, old_end, new_id, new_start,
    new_end. New ids are max_id*k + max_id*n*i + id for the i-th piece, unique over n enzymes. Maps without
    cuts are one piece under their own id."""
    inside = cuts.join(lengths, "map_id").filter((F.col("at") > 0) & (F.col("at") < F.col("len") - 1)).select("map_id", "at", "len").distinct()
    bounds = inside.select("map_id", "len", F.explode(F.array(F.lit(None).cast("long"), F.col("at"))).alias("at")).distinct()
    w = Window.partitionBy("map_id").orderBy(F.col("at").asc_nulls_first())
    start = F.coalesce(F.col("at") + 1, F.lit(0))
    cut = bounds.select(
        F.col("map_id").alias("old_id"), start.alias("old_start"), F.coalesce(F.lead("at").over(w), F.col("len") - 1).alias("old_end"),
        (F.lit(max_id * k).cast("long") + F.lit(max_id * n).cast("long") * (F.row_number().over(w) - 1) + F.col("map_id")).alias("new_id"),
    )
    whole = lengths.join(inside.select("map_id").distinct(), "map_id", "left_anti")
    uncut = whole.select(F.col("map_id").alias("old_id"), F.lit(0).cast("long").alias("old_start"), (F.col("len") - 1).alias("old_end"), F.col("map_id").alias("new_id"))
    return cut.unionByName(uncut).withColumn("new_start", F.lit(0).cast("long")).withColumn("new_end", F.col("old_end") - F.col("old_start"))


def cut(labels: DataFrame, segments: DataFrame, width: int) -> DataFrame:
    """Labels on the pieces of their map: those in (start, end], their place less the start, numbered anew."""
    seg = segments.select(F.col("old_id").alias("map_id"), F.col("old_start").alias("lo"), F.col("old_end").alias("hi"), "new_id")
    on = points_in_ranges(labels, seg, ["map_id"], "pos", "lo", "hi", width).filter(F.col("pos") > F.col("lo"))
    w = Window.partitionBy("new_id").orderBy("pos", "channel", "site_id", "map_set")
    return on.select("new_id", F.row_number().over(w).alias("site_id"), "channel", (F.col("pos") - F.col("lo")).alias("pos"), (F.col("hi") - F.col("lo")).alias("len"))


def invalid_segments(segments: DataFrame) -> DataFrame:
    """Translation rows that break the rules: start not before end, or not next to the row before."""
    w = Window.partitionBy("old_id").orderBy("old_start", "new_id")
    before = F.lag("old_end").over(w)
    bad = (F.col("old_start") >= F.col("old_end")) | (before.isNotNull() & (before + 1 != F.col("old_start")))
    return segments.withColumn("bad", bad).filter("bad").drop("bad")


def masked(labels: DataFrame, bits: int, first: bool = True, last: bool = True) -> DataFrame:
    """Bits or-ed into the mask of the first and last label of every map."""
    w = Window.partitionBy("map_set", "map_id")
    place = F.row_number().over(w.orderBy("pos", "site_id", "channel"))
    back = F.row_number().over(w.orderBy(F.desc("pos"), F.desc("site_id"), F.desc("channel")))
    old = F.col("mask") if "mask" in labels.columns else F.lit(0)
    hit = (F.lit(first) & (place == 1)) | (F.lit(last) & (back == 1))
    return labels.withColumn("mask", F.when(hit, old.bitwiseOR(F.lit(bits))).otherwise(old))


def internal_gaps(labels: DataFrame, mean: DataFrame, times: float, min_sites: int) -> DataFrame:
    """Gaps of at least ``times`` the mean label distance of the set inside maps of ``min_sites`` labels."""
    w = Window.partitionBy("map_set", "map_id")
    lagged = labels.withColumn("n", F.count("*").over(w)).withColumn("before", F.lag("pos").over(w.orderBy("pos", "site_id", "channel")))
    both = lagged.filter((F.col("n") >= min_sites) & F.col("before").isNotNull()).join(F.broadcast(mean), "map_set")  # one row per map set
    return both.filter((F.col("pos") - F.col("before")) >= times * F.col("mean_distance")).select("map_set", "map_id", F.col("before").alias("lo"), F.col("pos").alias("hi"))


def runs_between_gaps(labels: DataFrame, gap: int) -> DataFrame:
    """Adds ``run``: the number of the stretch of labels without a distance beyond ``gap``."""
    w = Window.partitionBy("map_set", "map_id").orderBy("pos", "site_id", "channel")
    new = F.when(F.col("pos") - F.lag("pos").over(w) > gap, 1).otherwise(0)
    return labels.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def painted(hits: DataFrame, sites: DataFrame, width: int) -> DataFrame:
    """Every label with the partner of its most confident hit (the later entry on ties): an argmax over the
    hits that cover it."""
    on = points_in_ranges(sites, hits.select(F.col("ref_id").alias("map_id"), F.col("rs").alias("lo"), F.col("re").alias("hi"), "conf", "entry_id", "qry_id"), ["map_id"], "pos", "lo", "hi", width)
    return on.groupBy("map_id", "pos").agg(F.max_by("qry_id", F.struct("conf", "entry_id", "qry_id")).alias("partner"))


def supported(paint: DataFrame, overhang: int) -> DataFrame:
    """Adds ``support``: whether all labels within ``overhang`` labels on both sides have one partner."""
    w = Window.partitionBy("map_id").orderBy("pos").rowsBetween(-overhang, overhang)
    return paint.withColumn("support", (F.min("partner").over(w) == F.max("partner").over(w)))


def alternatives(paint: DataFrame, sites: DataFrame, overhang: int) -> DataFrame:
    """map_id, pos, alt for every label: the partner that it and ``overhang`` labels on either side are all painted
    with, -1 where they are not of one partner or of none."""
    every = sites.join(paint, ["map_id", "pos"], "left").withColumn("partner", F.coalesce("partner", F.lit(-1).cast("long")))
    w = Window.partitionBy("map_id").orderBy("pos").rowsBetween(-overhang, overhang)
    return every.select("map_id", "pos", F.when(F.min("partner").over(w) == F.max("partner").over(w), F.col("partner")).otherwise(-1).alias("alt"))


def settled(ref_support: Column, qry_support: Column, ref_status: Column, qry_status: Column) -> tuple[Column, Column]:
    """Both statuses of a conflict after alternative support is known: both supported, ignore it; one
    supported, the molecules' verdict on the query decides; none, as they were."""
    okay = qry_status == "okay"
    ref = F.when(ref_support & qry_support, "okay").when(qry_support, F.when(okay, "cut").otherwise("okay")).when(ref_support, "okay").otherwise(ref_status)
    qry = F.when(ref_support & qry_support, "okay").when(qry_support, "okay").when(ref_support, F.when(okay, "okay").otherwise("cut")).otherwise(qry_status)
    return ref, qry


def rescale_factors(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Stretch of queries against references: the slope through the origin of reference over query spans."""
    q, r = F.abs(F.col("qe") - F.col("qs")).cast("decimal(20,0)"), (F.col("re") - F.col("rs")).cast("decimal(20,0)")
    g = hits.groupBy(*keys).agg(F.sum(q * r).alias("qr"), F.sum(q * q).alias("qq"), F.count("*").alias("n"))
    return g.filter("qq > 0").select(*keys, "n", (F.col("qr").cast("double") / F.col("qq").cast("double")).alias("factor"))


def scaled(labels: DataFrame, factors: DataFrame, keys: list[str]) -> DataFrame:
    both = salted_join(labels, factors.select(*keys, "factor"), keys, [F.col("pos")], "left")
    return both.withColumn("pos", F.floor(F.col("pos") * F.coalesce("factor", F.lit(1.0)) + 0.5).cast("long")).drop("factor")
