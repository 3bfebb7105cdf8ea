"""Evidence that molecules link contigs: pairing, outlier trimming, consistency, mate pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import salted_join
from .prefix import prefix_sum

PAIR = ["ctg1", "ctg2"]
LINK = ["ctg1", "ctg2", "end1", "end2"]


def plausible(evidence: DataFrame, least_labels: int = 5, most_labels: int | None = None, farthest: int = 1_000_000) -> DataFrame:
    """Evidence of a molecule that meets its two contigs in opposite orientations (else no distance is defined),
    within the distance and the label counts."""
    kept = evidence.filter((F.col("ori1") != F.col("ori2")) & (F.abs("distance") <= farthest) & (F.col("minlabels") >= least_labels))
    return kept if most_labels is None else kept.filter(F.col("minlabels") <= most_labels)


def distance_stats(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """n, mean and population deviation of whole-number distances, each from whole-number sums."""
    d = F.col("distance").cast("decimal(38,0)")
    g = evidence.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(d).alias("s"), F.sum(d * d).alias("ss"))
    n, s, ss = F.col("n"), F.col("s").cast("double"), F.col("ss").cast("double")
    spread = F.greatest(n * ss - s * s, F.lit(0.0))
    return g.select(*keys, "n", (s / n).alias("mean"), (F.sqrt(spread) / n).alias("std"))


def trimmed(evidence: DataFrame, keys: list[str], share: float = 0.1, least: int = 3, lowest: float = -3000, widest: float = 10000) -> DataFrame:
    """The evidence of each link without its outliers: all but the farthest ``share`` from the mean, and of
    those what lies within 1.2 deviations; everything if there are no more than ``least``. Rows as close as
    the last one kept are kept. Links whose mean or deviation is then out of bounds are dropped whole.

    The rank by closeness is a two-level prefix count, so one link may hold a third of all rows."""
    stats = distance_stats(evidence, keys)
    both = salted_join(evidence, stats, keys, [F.col("no")]).withColumn("_off", F.abs(F.col("distance") - F.col("mean")))
    both = both.withColumn("_o", F.floor(F.col("_off") * 1000))
    counts = both.groupBy(*keys, "_o").agg(F.count("*").alias("_n"))
    keep = F.col("total") - F.ceil(F.col("total") * F.lit(share))
    ranked = prefix_sum(counts, keys, "_o", "_n", "_upto")
    edge = ranked.groupBy(*keys).agg(F.min(F.when(F.col("_upto") >= keep, F.col("_o"))).alias("_edge"))
    joined = salted_join(both, edge, keys, [F.col("no")])
    near = (F.col("n") <= least) | (F.col("_o") <= F.col("_edge")) | (F.col("_off") < 1.2 * F.col("std"))
    left = joined.filter(near).select(*evidence.columns)
    good = distance_stats(left, keys).filter((F.col("mean") > lowest) & (F.col("std") < widest)).select(*keys)
    return salted_join(left, good, keys, [F.col("no")])


def consistent(evidence: DataFrame, least: int, ratio: float, deepest: int | None = None) -> DataFrame:
    """Pairs of contigs with at least ``least`` pieces of evidence (``deepest`` at most) that agree on their
    ends: all of one kind, or twice as many with the commonest kind at ``ratio``."""
    kinds = evidence.groupBy(*LINK).agg(F.count("*").alias("n"))
    pairs = kinds.groupBy(*PAIR).agg(F.sum("n").alias("total"), F.max("n").alias("top"), F.count("*").alias("kinds"))
    ok = (F.col("total") >= least) & ((F.col("kinds") == 1) | ((F.col("total") >= 2 * least) & (F.col("top") >= ratio * F.col("total"))))
    return pairs.filter(ok if deepest is None else ok & (F.col("total") <= deepest))


def mate_pairs(evidence: DataFrame, lengths: DataFrame, insert: int, read: int = 100) -> DataFrame:
    """Evidence as mate pairs of an insert size: the span left after the distance is shared by contig length
    and measured from the far end; reads of ``read`` bases point back on the 5' and forth on the 3' end."""
    l1 = lengths.select(F.col("id").alias("ctg1"), F.col("len").alias("len1"))
    l2 = lengths.select(F.col("id").alias("ctg2"), F.col("len").alias("len2"))
    both = salted_join(salted_join(evidence, l1, ["ctg1"], [F.col("no")]), l2, ["ctg2"], [F.col("no")])
    span = (F.lit(insert) - F.col("distance")).cast("long")
    first = (F.col("len1") * span / (F.col("len1") + F.col("len2"))).cast("long")
    at1, at2 = F.col("len1") - first, F.col("len2") - (span - first)

    def ends(end: str, at):
        back = F.col(end) == "5"
        return F.when(back, at).otherwise(at - read), F.when(back, at - read).otherwise(at)

    (s1, e1), (s2, e2) = ends("end1", at1), ends("end2", at2)
    return both.select("no", "ctg1", s1.alias("start1"), e1.alias("stop1"), "ctg2", s2.alias("start2"), e2.alias("stop2"))
