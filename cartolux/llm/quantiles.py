"""Percentiles of very large numeric columns by radix selection.

A double is mapped to a 64-bit integer of the same order. ``select`` histograms the top 16 bits per
group, finds the digit that holds each wanted rank, keeps only the values under those digits and
goes on with the next 16 bits: four passes over shrinking data give the exact value of any rank.
``summary`` is the first passes' histogram kept as a result: counts by the order-preserving key cut
to ``MANTISSA`` bits of mantissa. Summaries of days or partitions are combined by adding counts, and
a percentile read from one lies in the same cut as the exact value, so it is off by at most half a
cut, 2^-(MANTISSA+1) of the value. A summary has at most 2^MANTISSA rows per octave of values.

All grouping is by (group, digit) with map-side combination; a group with a third of all values
costs no task more than 65,536 counters. The nearest-rank definition holds: the value of rank
ceil(q*n), at least 1.

Cases. Null, NaN and infinite values are left out by the callers below; -0.0 and 0.0 are one value.
Ties are counted. A group without values gives no row. Null group keys are a group. Keys may have any
names but those of the result columns (n, q, value, low, high, cut) and u, digit, prefix, left, total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Stage, fits_broadcast, salted_join

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
MANTISSA = 10
DIGIT = 16
#: Wanted digits that are broadcast, by their counted number.
FEW = 100_000


def order_key(x: Column) -> Column:
    """Signed 64-bit integer in the order of the doubles."""
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("long")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(0x7FFFFFFFFFFFFFFF)))


def from_key(u: Column) -> Column:
    """The double of an order key."""
    bits = F.when(u >= 0, u).otherwise(u.bitwiseXOR(F.lit(0x7FFFFFFFFFFFFFFF)))
    return F.call_function("java_method", F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def _same(keys: list[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return test


def _found(hist: DataFrame, keys: list[str], wanted: Column, digit: str = "digit") -> DataFrame:
    """Rows of ``hist`` (keys, digit, n) that hold a wanted rank: ``wanted`` is array<struct<q,rank>>."""
    w = Window.partitionBy(*keys).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
    summed = hist.withColumn("upto", F.sum("n").over(w))
    hits = F.filter(wanted, lambda t: (t["rank"] <= F.col("upto")) & (t["rank"] > F.col("upto") - F.col("n")))
    return summed.withColumn("t", F.explode(hits)).withColumn("left", F.col("t.rank") - F.col("upto") + F.col("n"))


def _ranks(quantiles: tuple[float, ...], total: Column) -> Column:
    return F.array(*[F.struct(F.lit(q).alias("q"), F.greatest(F.lit(1), F.ceil(F.lit(q) * total)).cast("long").alias("rank")) for q in quantiles])


def select(values: DataFrame, keys: list[str], quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """keys, n, q, value: the exact value of each rank, from ``values`` (keys, value)."""
    stage = Stage(values.sparkSession)
    left = stage.write(values.select(*keys, order_key(F.col("value")).alias("u")), "keys")
    shift = 64 - DIGIT
    hist = left.groupBy(*keys, F.shiftright("u", shift).alias("digit")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*keys)
    hist = hist.withColumn("total", F.sum("n").over(whole))
    at = _found(hist, keys, _ranks(quantiles, F.col("total"))).select(*keys, "total", F.col("t.q").alias("q"), F.col("digit").alias("prefix"), "left")
    while True:
        at = stage.write(at, "targets")
        if shift == 0:
            break
        followed = at.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.col("prefix").alias("__r_prefix")).distinct()
        # One row per group and wanted rank: broadcast up to a counted number of rows, salted copies beyond.
        followed = stage.write(followed, "followed")
        under = left.withColumn("prefix", F.shiftright("u", shift))
        # The key of the join is hashed with its nulls, then compared null-safe.
        under = under.withColumn("__hash", F.xxhash64(*keys, "prefix"))
        wide = followed.withColumn("__hash", F.xxhash64(*[f"__r_{k}" for k in keys], "__r_prefix"))
        both = under.join(F.broadcast(wide), "__hash") if fits_broadcast(followed, FEW) else salted_join(under, wide, ["__hash"], [F.col("u")])
        both = both.filter(_same([*keys, "prefix"]))
        old, left = left, stage.write(both.select(*keys, "u"), "keys")
        stage.drop(old)
        shift -= DIGIT
        hist = left.groupBy(*keys, F.shiftright("u", shift + DIGIT).alias("prefix"), F.shiftright("u", shift).alias("digit")).agg(F.count("*").alias("n"))
        wanted = at.groupBy(*keys, "total", "prefix").agg(F.collect_list(F.struct("q", F.col("left").alias("rank"))).alias("wanted"))
        wanted = wanted.select("total", "wanted", *[F.col(k).alias(f"__r_{k}") for k in [*keys, "prefix"]])
        at = _found(hist.join(wanted.hint("merge"), _same([*keys, "prefix"])), [*keys, "prefix"], F.col("wanted")).select(
            *keys, "total", F.col("t.q").alias("q"), F.col("digit").alias("prefix"), "left"
        )
    return at.select(*keys, F.col("total").alias("n"), "q", from_key(F.col("prefix")).alias("value"))


def summary(values: DataFrame, keys: list[str], mantissa: int = MANTISSA) -> DataFrame:
    """keys, cut, n: the combinable result of a day or partition."""
    return values.groupBy(*keys, F.shiftright(order_key(F.col("value")), 52 - mantissa).alias("cut")).agg(F.count("*").alias("n"))


def combined(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """Summaries added up over whatever columns ``keys`` leaves out."""
    return summaries.groupBy(*keys, "cut").agg(F.sum("n").alias("n"))


def percentiles(summaries: DataFrame, keys: list[str], quantiles: tuple[float, ...] = QUANTILES, mantissa: int = MANTISSA) -> DataFrame:
    """keys, n, q, value, low, high: the estimate and the bounds of the exact value."""
    hist = summaries.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    at = _found(hist, keys, _ranks(quantiles, F.col("total")), "cut")
    shift = 52 - mantissa
    low, high = F.shiftleft("cut", shift), F.shiftleft("cut", shift) + F.lit((1 << shift) - 1)
    ends = at.select(*keys, F.col("total").alias("n"), F.col("t.q").alias("q"), from_key(low).alias("low"), from_key(high).alias("high"))
    return ends.select(*keys, "n", "q", ((F.col("low") + F.col("high")) / 2).alias("value"), "low", "high")


def _usable(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def label_values(maps: DataFrame) -> DataFrame:
    """measure, map_set, label_channel, day, value: label positions, each label once, on the day of its
    first load. Left out: terminal rows, labels without a channel, positions that are null, not
    numbers, negative or beyond the end of the map (of the row, or else of the map's other rows)."""
    length, position = F.col("ContigLength"), F.col("Position")
    labels = maps.filter((F.col("LabelChannel") != 0) & _usable(position) & (position >= 0))
    within = labels.filter(_usable(length) & (position <= length))
    lengths = maps.filter(_usable(length)).groupBy("CMapId").agg(F.max("ContigLength").alias("_length"))
    unstated = labels.filter(~F.coalesce(_usable(length), F.lit(False)))
    unstated = salted_join(unstated, lengths, ["CMapId"], [F.col("SiteID")], "left").filter(F.col("_length").isNull() | (position <= F.col("_length")))
    columns = ["map_set", "CMapId", "SiteID", "LabelChannel", "Position", "loaded_at"]
    once = within.select(*columns).union(unstated.select(*columns)).groupBy(*columns[:-1]).agg(F.min("loaded_at").alias("loaded_at"))
    return once.select(F.lit("Position").alias("measure"), "map_set", F.col("LabelChannel").alias("label_channel"), F.to_date("loaded_at").alias("day"), F.col("Position").alias("value"))


def length_values(maps: DataFrame) -> DataFrame:
    """The same columns for the lengths of maps, once per map and map_set, on the day of its first row;
    the largest where rows of a map disagree."""
    length = F.col("ContigLength")
    once = maps.groupBy("map_set", "CMapId").agg(F.max(F.when(_usable(length) & (length > 0), length)).alias("value"), F.min("loaded_at").alias("loaded_at"))
    return once.filter(F.col("value").isNotNull()).select(
        F.lit("ContigLength").alias("measure"), "map_set", F.lit(None).cast("int").alias("label_channel"), F.to_date("loaded_at").alias("day"), "value"
    )
