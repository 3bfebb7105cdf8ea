"""Queries p5 to p9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from . import components, leakage, quality, quantiles, tokens
from .sql import ORACLES  # noqa: F401


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    edges, glues = table(spark, d, "edges"), table(spark, d, "glues")
    records = edges.select(F.explode(F.array("id1", "id2")).alias("id")).union(glues.select(F.explode(F.array("QryContigID", "RefContigID_x", "RefContigID_y")).alias("id")))
    return components.consolidated(records, components.map_links(edges, glues))


def p5_sizes(spark: SparkSession, d: str) -> DataFrame:
    return components.group_sizes(p5_found(spark, d))


MEASURE = ["measure", "map_set", "label_channel"]


def _values(spark: SparkSession, d: str) -> DataFrame:
    maps = table(spark, d, "cmap")
    return quantiles.label_values(maps).union(quantiles.length_values(maps))


def p6_daily(spark: SparkSession, d: str) -> DataFrame:
    """Exact percentiles per measure, map_set, channel and day."""
    return quantiles.select(_values(spark, d), [*MEASURE, "day"])


def p6_overall(spark: SparkSession, d: str) -> DataFrame:
    """Exact percentiles over all days."""
    return quantiles.select(_values(spark, d), MEASURE)


def p6_summaries(spark: SparkSession, d: str) -> DataFrame:
    """The combinable results of the days."""
    return quantiles.summary(_values(spark, d), [*MEASURE, "day"])


def p6_months(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of months put together from the results of their days, with bounds."""
    months = quantiles.combined(p6_summaries(spark, d).withColumn("month", F.date_format("day", "yyyy-MM")), [*MEASURE, "month"])
    return quantiles.percentiles(months, [*MEASURE, "month"])


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encoded(table(spark, d, "documents"))


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return tokens.round_trip(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Test items by the number of documents that give them away."""
    return p8_found(spark, d).groupBy("item_id").agg(F.count("*").alias("n_documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.unnatural(table(spark, d, "documents"))


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The figures and the kind of every document."""
    return quality.judged(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p5_found, p5_sizes, p6_daily, p6_overall, p6_summaries, p6_months, p7_ids, p7_round_trip, p8_found, p8_items, p9_found, p9_statistics)}
