"""Prefix sums, ranks and weighted ranks over long ordered groups, without a task per group.

Rows of a group are cut into blocks by the value of an integer order column. Sums run within blocks
and over the totals of blocks, so a group with a third of all rows is spread over its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 20


def _joined(rows: DataFrame, per_block: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    named = per_block.select(*[F.col(c).alias(f"_{c}") for c in by], *columns)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return rows.join(named, same).select(*rows.columns, *columns)


def prefix_sum(df: DataFrame, keys: list[str], order: str, value: str, out: str, block: int = BLOCK) -> DataFrame:
    """Adds ``out``: the sum of ``value`` up to and including the row, by ``order`` (unique in a group),
    and ``total``: the sum of the group."""
    by = [*keys, "_block"]
    rows = df.withColumn("_block", F.floor(F.col(order) / block))
    totals = rows.groupBy(*by).agg(F.sum(value).alias("_net"))
    w = Window.partitionBy(*keys).orderBy("_block")
    carried = totals.select(*by, (F.sum("_net").over(w) - F.col("_net")).alias("_before"), F.sum("_net").over(Window.partitionBy(*keys)).alias("total"))
    inner = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = _joined(rows, carried, by, ["_before", "total"])
    return summed.withColumn(out, F.col("_before") + F.sum(value).over(inner)).drop("_before", "_block")


def nx(df: DataFrame, keys: list[str], length: str, shares: dict[str, float], block: int = BLOCK) -> DataFrame:
    """N50-like figures: for each share, the largest length such that lengths as long or longer make up
    that share of the total. ``length`` is a whole number."""
    per_length = df.groupBy(*keys, length).agg(F.sum(length).alias("_mass"))
    summed = prefix_sum(per_length, keys, length, "_mass", "_upto", block)
    shorter = F.col("_upto") - F.col("_mass")
    return summed.groupBy(*keys).agg(*[F.max(F.when(F.col("total") - shorter >= F.col("total") * share, F.col(length))).alias(name) for name, share in shares.items()])


def median(df: DataFrame, keys: list[str], value: str, out: str = "median", block: int = BLOCK) -> DataFrame:
    """Mean of the middle two of a whole-number column, by counting."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    summed = prefix_sum(counts, keys, value, "_n", "_upto", block)
    low = (F.col("_upto") >= F.floor((F.col("total") + 1) / 2))
    high = (F.col("_upto") >= F.floor(F.col("total") / 2) + 1)
    return summed.groupBy(*keys).agg(((F.min(F.when(low, F.col(value))) + F.min(F.when(high, F.col(value)))) / 2).alias(out))


def running_max(rows: DataFrame, keys: list[str], order: list, at: str, value: Column, out: str, own: bool, block: int = 1 << 20) -> DataFrame:
    """Adds ``out``: the largest ``value`` of the rows before each one (and of its own, if ``own``) in ``order``, whose
    first column is the whole number ``at``. In two levels, blocks of ``at`` and within them, so a hot key is spread."""
    marked = rows.withColumn("_v", value).withColumn("_b", F.floor(F.col(at) / block))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tops = marked.groupBy(*keys, "_b").agg(F.max("_v").alias("_top")).withColumn("_carry", F.max("_top").over(before)).drop("_top")
    inner = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    return marked.join(tops, [*keys, "_b"]).withColumn(out, F.greatest("_carry", F.max("_v").over(inner))).drop("_v", "_b", "_carry")
