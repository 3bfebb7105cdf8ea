"""Alignment hits: role switch, translation, filters, best hits, extension, embedding, gaps.

Hits have entry_id, qry_id, ref_id, qs, qe, rs, re (starts and ends), ori, conf, ql, rl (lengths),
channel, cigar and pairs (text), and aln_set. Lengths may be in any unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import salted_join


def pair_list(text: Column) -> Column:
    """'(1,9)(2,8)' as array<struct<ref,qry>>."""
    at = lambda k: F.transform(F.regexp_extract_all(text, F.lit(r"\((\d+),(\d+)\)"), F.lit(k)), lambda x: x.cast("int"))
    return F.transform(F.arrays_zip(at(1).alias("ref"), at(2).alias("qry")), lambda p: F.struct(p["ref"].alias("ref"), p["qry"].alias("qry")))


def pair_text(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("("), p["ref"], F.lit(","), p["qry"], F.lit(")"))), "")


def cigar_list(text: Column) -> Column:
    """'8M1D' as array<struct<n,op>>."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\d+[MID]"), F.lit(0)), lambda t: F.struct(F.regexp_extract(t, r"\d+", 0).cast("int").alias("n"), F.right(t, F.lit(1)).alias("op")))


def switched(hits: DataFrame) -> DataFrame:
    """The hits with reference and query in each other's role. Twice gives the hits again."""
    turned = F.col("ori") == "-"
    steps = F.transform(F.regexp_extract_all("cigar", F.lit(r"\d+[MID]"), F.lit(0)), lambda t: F.translate(t, "ID", "DI"))
    pairs = F.transform(pair_list(F.col("pairs")), lambda p: F.struct(p["qry"].alias("ref"), p["ref"].alias("qry")))
    new = {
        "qry_id": F.col("ref_id"), "ref_id": F.col("qry_id"), "ql": F.col("rl"), "rl": F.col("ql"),
        "qs": F.when(turned, F.col("re")).otherwise(F.col("rs")), "qe": F.when(turned, F.col("rs")).otherwise(F.col("re")),
        "rs": F.when(turned, F.col("qe")).otherwise(F.col("qs")), "re": F.when(turned, F.col("qs")).otherwise(F.col("qe")),
        "cigar": F.array_join(F.when(turned, F.reverse(steps)).otherwise(steps), ""),
        "pairs": pair_text(F.when(turned, F.reverse(pairs)).otherwise(pairs)),
    }
    return hits.select(*[new[c].alias(c) if c in new else F.col(c) for c in hits.columns])


def translated(hits: DataFrame, segments: DataFrame) -> DataFrame:
    """Query coordinates of cut maps brought back to the original map. ``segments`` has old_id, old_start,
    old_end, new_id. Unknown ids pass unchanged."""
    ends = segments.groupBy("old_id").agg(F.max("old_end").alias("_last"))
    known = segments.select(F.col("new_id").alias("qry_id"), F.col("old_id").alias("_old"), F.col("old_start").alias("_shift")).join(ends.withColumnRenamed("old_id", "_old"), "_old")
    both = salted_join(hits, known, ["qry_id"], [F.col("entry_id")], "left")
    shift = F.coalesce("_shift", F.lit(0))
    new = {"qry_id": F.coalesce("_old", "qry_id"), "qs": F.col("qs") + shift, "qe": F.col("qe") + shift, "ql": F.coalesce(F.col("_last") + 1, F.col("ql"))}
    return both.select(*[new[c].alias(c) if c in new else F.col(c) for c in hits.columns])


def pairs_shifted(hits: DataFrame, leading: DataFrame) -> DataFrame:
    """Query label numbers of the pairs raised by ``leading`` (qry_id, n_before), sorted by them again."""
    both = salted_join(hits, leading, ["qry_id"], [F.col("entry_id")], "left")
    moved = F.transform(pair_list(F.col("pairs")), lambda p: F.struct((p["qry"] + F.coalesce("n_before", F.lit(0)).cast("int")).alias("qry"), p["ref"].alias("ref")))
    return both.withColumn("pairs", pair_text(F.array_sort(moved))).select(*hits.columns)


def remapped(hits: DataFrame, keys: DataFrame) -> DataFrame:
    """Query ids through a key table (old_id, new_id); unknown ids stay."""
    both = salted_join(hits, keys.select(F.col("old_id").alias("qry_id"), F.col("new_id").alias("_new")), ["qry_id"], [F.col("entry_id")], "left")
    return both.withColumn("qry_id", F.coalesce("_new", "qry_id")).select(*hits.columns)


def best_per_query(hits: DataFrame, keys: list[str]) -> DataFrame:
    """The hit of highest confidence of each query, the first entry on ties: an argmax with map-side
    combination, no sort."""
    best = hits.groupBy(*keys).agg(F.max(F.struct("conf", (-F.col("entry_id")).alias("_e"), F.struct(*hits.columns).alias("row"))).alias("m"))
    return best.select("m.row.*")


def strong(hits: DataFrame, keys: list[str], conf: float, delta: float, ratio: float) -> DataFrame:
    """Hits above max(best - delta, conf) of their query whose query length is at least ``ratio`` of the
    longest. The group maxima come from a partial aggregation and are joined back salted."""
    tops = hits.groupBy(*keys).agg(F.max("conf").alias("_top"), F.max("ql").alias("_long"))
    both = salted_join(hits, tops, keys, [F.col("entry_id")])
    return both.filter((F.col("conf") > F.greatest(F.col("_top") - delta, F.lit(conf))) & (F.col("ql") >= ratio * F.col("_long"))).select(*hits.columns)


def extended(hits: DataFrame) -> DataFrame:
    """Adds ext_start, ext_end: the reference span with the unaligned tails of the query."""
    plus = F.col("ori") == "+"
    head = F.when(plus, F.col("qs") - 1).otherwise(F.col("ql") - F.col("qs"))
    tail = F.when(plus, F.col("ql") - F.col("qe")).otherwise(F.col("qe") - 1)
    return hits.withColumn("ext_start", F.col("rs") - head).withColumn("ext_end", F.col("re") + tail)


def outermost(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Hits not embedded in earlier ones: their end lies beyond every end before, by start, then the longer
    first. Done in two levels (blocks of starts), so a hot reference is spread."""
    block = F.floor(F.col("rs") / (1 << 20))
    rows = hits.withColumn("_b", block)
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(*keys, "_b").agg(F.max("re").alias("_top")).withColumn("_reach", F.max("_top").over(w)).drop("_top")
    both = rows.join(tops, [*keys, "_b"])
    inner = Window.partitionBy(*keys, "_b").orderBy("rs", F.desc("re"), "entry_id").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.col("_reach"), F.max("re").over(inner))
    return both.withColumn("_r", reach).filter(F.col("_r").isNull() | (F.col("re") > F.col("_r"))).select(*hits.columns)


def renumbered(hits: DataFrame, order: list[Column], out: str = "new_id") -> DataFrame:
    """Dense numbers in a global order: a range-partitioned sort, then the partition's offset plus the place
    in the partition. No task sees all rows."""
    spark = hits.sparkSession
    from ..runtime import Stage

    stage = Stage(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = stage.write(hits.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()), "ordered")
    counts = ordered.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    offsets = counts.select("_p", "_first", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_off"))  # one row per partition
    return ordered.join(F.broadcast(offsets), "_p").withColumn(out, F.col("_off") + F.col("_i") - F.col("_first") + 1).drop("_p", "_i", "_first", "_off")
