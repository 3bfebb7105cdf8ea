"""Queries over maps and hits: statistics, coverage, filters, joins, windows, sets; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import hits as H
from ..operators import intervals, prefix, ranges
from ..runtime import salted_join, table
from . import inputs as I
from .inputs import sql

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


BIN = 1_000_000  # 100 kb in tenths


@query(sql("maps", """
totals AS (SELECT map_set, count(*) AS n_maps, min(len) AS min_len, quantile_cont(len, 0.5) AS median_len, sum(len) / count(*) AS mean_len, max(len) AS max_len, sum(len) AS total_len FROM maps GROUP BY 1),
cum AS (SELECT map_set, len, sum(len) OVER (PARTITION BY map_set ORDER BY len DESC) AS c FROM maps)
SELECT t.map_set, n_maps, min_len, median_len, mean_len, max_len, total_len::BIGINT AS total_len,
  (SELECT max(len) FROM cum c WHERE c.map_set = t.map_set AND c.c >= t.total_len * 0.5) AS n50, (SELECT max(len) FROM cum c WHERE c.map_set = t.map_set AND c.c >= t.total_len * 0.9) AS n90
FROM totals t"""))
def a1_length_stats(spark: SparkSession, d: str) -> DataFrame:
    """Count, extremes, median, mean, total, N50 and N90 of map lengths per set (A1-A3)."""
    m = I.maps(spark, d)
    stats = m.groupBy("map_set").agg(
        F.count("*").alias("n_maps"), F.min("len").alias("min_len"), (F.sum("len") / F.count("*")).alias("mean_len"), F.max("len").alias("max_len"), F.sum("len").alias("total_len")
    )
    return stats.join(prefix.nx(m, ["map_set"], "len", {"n50": 0.5, "n90": 0.9}), "map_set").join(prefix.median(m, ["map_set"], "len", "median_len"), "map_set")


@query(sql("maps", """
ranked AS (SELECT map_set, len, row_number() OVER w AS rn, sum(len) OVER (PARTITION BY map_set ORDER BY len DESC, map_id ROWS UNBOUNDED PRECEDING) AS c, lead(len) OVER w AS nxt, sum(len) OVER (PARTITION BY map_set) AS t FROM maps WINDOW w AS (PARTITION BY map_set ORDER BY len DESC, map_id))
SELECT map_set, CASE WHEN c * 2 = t AND nxt IS NOT NULL THEN (len + nxt) / 2 ELSE len / 1 END AS n50_mid FROM ranked QUALIFY row_number() OVER (PARTITION BY map_set ORDER BY CASE WHEN c * 2 >= t THEN 0 ELSE 1 END, rn) = 1"""))
def a4_n50_midpoint(spark: SparkSession, d: str) -> DataFrame:
    """N50 that takes the mean of two lengths where half the total falls between them (A4)."""
    m = I.maps(spark, d)
    per = m.groupBy("map_set", "len").agg(F.sum("len").alias("mass"))
    up = prefix.prefix_sum(per, ["map_set"], "len", "mass", "upto")
    longer = F.col("total") - F.col("upto") + F.col("mass")
    at = F.max(F.when(longer * 2 >= F.col("total"), F.col("len")))
    exact = F.max(F.when(longer * 2 == F.col("total"), F.col("len")))
    below = F.max(F.when((F.col("total") - F.col("upto") + F.col("mass")) * 2 > F.col("total"), F.col("len")))
    g = up.groupBy("map_set").agg(at.alias("at"), exact.alias("exact"), below.alias("below"))
    return g.select("map_set", F.when(F.col("exact").isNotNull() & F.col("below").isNotNull(), (F.col("exact") + F.col("below")) / 2).otherwise(F.col("at") / 1).alias("n50_mid"))


@query(sql("hits", """
spans AS (SELECT DISTINCT aln_set, ref_id, rs AS lo, re AS hi FROM hits),
marked AS (SELECT *, CASE WHEN lo > max(hi) OVER (PARTITION BY aln_set, ref_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS brk FROM spans),
grp AS (SELECT *, sum(brk) OVER (PARTITION BY aln_set, ref_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM marked),
isl AS (SELECT aln_set, ref_id, g, max(hi) - min(lo) AS len FROM grp GROUP BY ALL),
un AS (SELECT aln_set, ref_id, sum(len)::BIGINT AS unique_len, count(*) AS n_islands FROM isl GROUP BY ALL),
red AS (SELECT aln_set, ref_id, sum(re - rs)::BIGINT AS redundant_len, max(rl) AS ref_len, count(*) AS n_hits FROM hits GROUP BY ALL)
SELECT aln_set, ref_id, redundant_len, unique_len, n_islands, n_hits, ref_len, floor(unique_len * 10000.0 / ref_len + 0.5) / 100 AS percent FROM red JOIN un USING (aln_set, ref_id)"""))
def a6_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Redundant and union coverage of every reference."""
    h = I.hits(spark, d)
    keys = ["aln_set", "ref_id"]
    red = h.groupBy(*keys).agg(F.sum(F.col("re") - F.col("rs")).alias("redundant_len"), F.max("rl").alias("ref_len"), F.count("*").alias("n_hits"))
    islands = intervals.sweep(h.select(*keys, F.col("rs").alias("lo"), F.col("re").alias("hi")), keys).filter("kind = 'period'")
    un = islands.groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("unique_len"), F.count("*").alias("n_islands"))
    return red.join(un, keys).withColumn("percent", F.floor(F.col("unique_len") * 10000.0 / F.col("ref_len") + 0.5) / 100)


@query(sql("hits", "SELECT entry_id, aln_set, qry_id, ref_id, conf, qs, qe, rs, re FROM hits QUALIFY row_number() OVER (PARTITION BY aln_set, qry_id ORDER BY conf DESC, entry_id) = 1"))
def a9_best_hits(spark: SparkSession, d: str) -> DataFrame:
    """The best alignment of each query."""
    h = I.hits(spark, d).select("entry_id", "aln_set", "qry_id", "ref_id", "conf", "qs", "qe", "rs", "re")
    return H.best_per_query(h, ["aln_set", "qry_id"])


@query(sql("hits", "SELECT aln_set, count(*) AS n_hits, count(DISTINCT qry_id) AS n_queries, count(DISTINCT ref_id) AS n_refs FROM hits GROUP BY 1"))
def a12_counts(spark: SparkSession, d: str) -> DataFrame:
    """Hits, queries and references per alignment set."""
    return I.hits(spark, d).groupBy("aln_set").agg(F.count("*").alias("n_hits"), F.countDistinct("qry_id").alias("n_queries"), F.countDistinct("ref_id").alias("n_refs"))


@query(sql("maps", "SELECT map_set, sum(len) / sum(num_sites) AS mean_distance FROM maps WHERE num_sites > 0 GROUP BY 1"))
def a14_mean_distance(spark: SparkSession, d: str) -> DataFrame:
    """Mean distance of labels."""
    return I.maps(spark, d).filter("num_sites > 0").groupBy("map_set").agg((F.sum("len") / F.sum("num_sites")).alias("mean_distance"))


@query(sql("maps hits", """
used AS (SELECT DISTINCT qry_id FROM hits)
SELECT CASE WHEN len < 200000 THEN 'small' WHEN len <= 2000000 THEN 'middle' ELSE 'large' END AS class, u.qry_id IS NOT NULL AS used, count(*) AS n, sum(len)::BIGINT AS total_len
FROM maps m LEFT JOIN used u ON u.qry_id = m.map_id GROUP BY ALL"""))
def a15_used_classes(spark: SparkSession, d: str) -> DataFrame:
    """Used and unused maps by length class."""
    m, used = I.maps(spark, d), I.hits(spark, d).select(F.col("qry_id").alias("map_id")).distinct().withColumn("used", F.lit(True))
    cls = F.when(F.col("len") < 200000, "small").when(F.col("len") <= 2000000, "middle").otherwise("large")
    return m.join(used, "map_id", "left").groupBy(cls.alias("class"), F.coalesce("used", F.lit(False)).alias("used")).agg(F.count("*").alias("n"), F.sum("len").alias("total_len"))


@query(sql("labels maps", "SELECT map_id, max(pos) AS max_len FROM (SELECT map_id, pos FROM labels UNION ALL SELECT map_id, len FROM maps) GROUP BY 1"))
def a18_max_length(spark: SparkSession, d: str) -> DataFrame:
    """Largest extent of each map over all channels."""
    both = I.labels(spark, d).select("map_id", "pos").union(I.maps(spark, d).select("map_id", "len"))
    return both.groupBy("map_id").agg(F.max("pos").alias("max_len"))


@query(sql("hits", "SELECT aln_set, ref_id, CASE WHEN sum(CASE WHEN ori = '+' THEN ql ELSE -ql END) >= 0 THEN '+' ELSE '-' END AS vote FROM hits GROUP BY 1, 2"))
def a19_orientation_vote(spark: SparkSession, d: str) -> DataFrame:
    """Orientation of a reference by the summed lengths of its hits."""
    weight = F.sum(F.when(F.col("ori") == "+", F.col("ql")).otherwise(-F.col("ql")))
    return I.hits(spark, d).groupBy("aln_set", "ref_id").agg(F.when(weight >= 0, "+").otherwise("-").alias("vote"))


_TOK = "regexp_extract_all(cigar, '[0-9]+[MID]')"
_PAIRS = "list_zip(regexp_extract_all(pairs, '\\(([0-9]+),([0-9]+)\\)', 1), regexp_extract_all(pairs, '\\(([0-9]+),([0-9]+)\\)', 2))"


@query(sql("hits", f"""
t AS (SELECT *, list_transform({_TOK}, lambda x: translate(x, 'ID', 'DI')) AS toks, list_transform({_PAIRS}, lambda p: '(' || p[2] || ',' || p[1] || ')') AS prs FROM hits)
SELECT entry_id, aln_set, ref_id AS qry_id, qry_id AS ref_id, rl AS ql, ql AS rl, CASE WHEN ori = '-' THEN re ELSE rs END AS qs, CASE WHEN ori = '-' THEN rs ELSE re END AS qe,
  CASE WHEN ori = '-' THEN qe ELSE qs END AS rs, CASE WHEN ori = '-' THEN qs ELSE qe END AS re, ori, conf, channel,
  array_to_string(CASE WHEN ori = '-' THEN list_reverse(toks) ELSE toks END, '') AS cigar, array_to_string(CASE WHEN ori = '-' THEN list_reverse(prs) ELSE prs END, '') AS pairs FROM t"""))
def proj1_switched_roles(spark: SparkSession, d: str) -> DataFrame:
    """Hits with reference and query switched."""
    return H.switched(I.hits(spark, d))


@query(sql("hits", """
top AS (SELECT aln_set, qry_id, max(conf) AS t, max(ql) AS l FROM hits GROUP BY 1, 2)
SELECT entry_id, h.aln_set, h.qry_id, ref_id, conf, ql FROM hits h JOIN top ON top.aln_set = h.aln_set AND top.qry_id = h.qry_id WHERE conf > greatest(t - 200, 1100) AND ql >= 0.9 * l"""))
def f3_strong_hits(spark: SparkSession, d: str) -> DataFrame:
    """Hits near the best of their query (F3, N8): within 2 of the best, above 11, 90 % of the length."""
    h = I.hits(spark, d).select("entry_id", "aln_set", "qry_id", "ref_id", "conf", "ql")
    return H.strong(h, ["aln_set", "qry_id"], 1100, 200, 0.9)


@query(sql("hits", """
e AS (SELECT *, rs - CASE WHEN ori = '+' THEN qs - 1 ELSE ql - qs END AS ext_start, re + CASE WHEN ori = '+' THEN ql - qe ELSE qe - 1 END AS ext_end FROM hits)
SELECT entry_id, aln_set, ref_id, qry_id, ext_start, ext_end FROM e"""))
def proj10_extended(spark: SparkSession, d: str) -> DataFrame:
    """Reference spans with unaligned tails (P10)."""
    return H.extended(I.hits(spark, d)).select("entry_id", "aln_set", "ref_id", "qry_id", "ext_start", "ext_end")


@query(sql("hits", """
r AS (SELECT entry_id, aln_set, ref_id, rs, re, max(re) OVER (PARTITION BY aln_set, ref_id ORDER BY rs, re DESC, entry_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM hits)
SELECT entry_id, aln_set, ref_id, rs, re FROM r WHERE reach IS NULL OR re > reach"""))
def f12_outermost(spark: SparkSession, d: str) -> DataFrame:
    """Hits not embedded in earlier ones."""
    return H.outermost(I.hits(spark, d).select("entry_id", "aln_set", "ref_id", "rs", "re"), ["aln_set", "ref_id"])


@query(sql("hits", "SELECT entry_id, aln_set, ref_id, rs - lag(re) OVER (PARTITION BY aln_set, ref_id ORDER BY rs, re DESC, entry_id) - 10 AS gap FROM hits QUALIFY gap IS NOT NULL"))
def n1_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gap between a hit and the one before it on its reference (N1): neighbours within blocks of starts,
    and the last hit of the earlier block for the first of each."""
    h = I.hits(spark, d).select("entry_id", "aln_set", "ref_id", "rs", "re").withColumn("b", F.floor(F.col("rs") / (1 << 20)))
    keys, order = ["aln_set", "ref_id"], ["rs", F.desc("re"), "entry_id"]
    last = h.groupBy(*keys, "b").agg(F.max_by("re", F.struct("rs", -F.col("re"), "entry_id")).alias("last"))
    last = last.withColumn("carry", F.lag("last").over(Window.partitionBy(*keys).orderBy("b"))).drop("last")
    prev = F.coalesce(F.lag("re").over(Window.partitionBy(*keys, "b").orderBy(*order)), "carry")
    return h.join(last, [*keys, "b"]).withColumn("gap", F.col("rs") - prev - 10).filter("gap IS NOT NULL").select("entry_id", *keys, "gap")


@query(sql("labels", "SELECT map_set, map_id, site_id, pos, pos - lag(pos) OVER (PARTITION BY map_set, map_id ORDER BY pos, site_id, channel, coverage, quality) AS distance FROM labels QUALIFY distance IS NOT NULL"))
def n3_distances(spark: SparkSession, d: str) -> DataFrame:
    """Distance of each label to the one before it (N3). A map's labels are bounded by its length."""
    w = Window.partitionBy("map_set", "map_id").orderBy("pos", "site_id", "channel", "coverage", "quality")
    return I.labels(spark, d).withColumn("distance", F.col("pos") - F.lag("pos").over(w)).filter("distance IS NOT NULL").select("map_set", "map_id", "site_id", "pos", "distance")


@query(sql("hits", "SELECT entry_id, aln_set, row_number() OVER (ORDER BY ref_id, rs, re DESC, entry_id, aln_set) AS new_id FROM hits"))
def n5_renumbered(spark: SparkSession, d: str) -> DataFrame:
    """Entries numbered in file order (N5, W4): a range-partitioned sort and partition offsets."""
    h = I.hits(spark, d).select("entry_id", "aln_set", "ref_id", "rs", "re")
    return H.renumbered(h, [F.col("ref_id"), F.col("rs"), F.desc("re"), F.col("entry_id"), F.col("aln_set")]).select("entry_id", "aln_set", "new_id")


@query(sql("hits", """
a AS (SELECT * FROM hits WHERE channel % 2 = 1), b AS (SELECT * FROM hits WHERE channel % 2 = 0)
SELECT a.qry_id, a.entry_id, b.entry_id AS entry_id2, a.ref_id, b.ref_id AS ref_id2, least(greatest(a.qs, a.qe), greatest(b.qs, b.qe)) - greatest(least(a.qs, a.qe), least(b.qs, b.qe)) + 1 AS shared
FROM a JOIN b ON a.qry_id = b.qry_id WHERE least(greatest(a.qs, a.qe), greatest(b.qs, b.qe)) - greatest(least(a.qs, a.qe), least(b.qs, b.qe)) + 1 >= 500000"""))
def j1_glued_hits(spark: SparkSession, d: str) -> DataFrame:
    """Hits of two channels that overlap by 50 kb on one query contig (J1), the complete overlap join."""
    h = I.hits(spark, d)
    lo, hi = F.least("qs", "qe"), F.greatest("qs", "qe")
    a = h.filter("channel % 2 = 1").select("qry_id", "entry_id", "ref_id", lo.alias("lo"), hi.alias("hi"))
    b = h.filter("channel % 2 = 0").select("qry_id", F.col("entry_id").alias("entry_id2"), F.col("ref_id").alias("ref_id2"), lo.alias("lo2"), hi.alias("hi2"))
    return ranges.overlaps(a, b, ["qry_id"], BIN, 500000).select("qry_id", "entry_id", "entry_id2", "ref_id", "ref_id2", "shared")


_OVERHANG = """
pts AS (SELECT DISTINCT map_id, pos FROM labels), r AS (SELECT entry_id, aln_set, conf, ref_id, rs - 200 AS lo, re + 200 AS hi FROM hits),
nl AS (SELECT r.entry_id, r.aln_set, count(p.pos) AS n_left FROM r LEFT JOIN pts p ON p.map_id = r.ref_id AND p.pos < r.lo GROUP BY 1, 2),
nr AS (SELECT r.entry_id, r.aln_set, count(p.pos) AS n_right FROM r LEFT JOIN pts p ON p.map_id = r.ref_id AND p.pos > r.hi GROUP BY 1, 2),
cnt AS (SELECT r.entry_id, r.aln_set, r.ref_id, r.conf, n_left, n_right FROM r JOIN nl USING (entry_id, aln_set) JOIN nr USING (entry_id, aln_set))"""


def _overhangs(spark: SparkSession, d: str) -> DataFrame:
    points = I.labels(spark, d).select("map_id", "pos").distinct()
    r = I.hits(spark, d).select("entry_id", "aln_set", "conf", F.col("ref_id").alias("map_id"), (F.col("rs") - 200).alias("lo"), (F.col("re") + 200).alias("hi"), F.struct("entry_id", "aln_set").alias("rid"))
    counted = ranges.counted_beside(points, r, ["map_id"], "pos", "lo", "hi", BIN)
    return counted.select("entry_id", "aln_set", F.col("map_id").alias("ref_id"), "conf", "n_left", "n_right")


@query(sql("labels hits", _OVERHANG + " SELECT entry_id, aln_set, ref_id, conf, n_left, n_right FROM cnt"))
def j2_overhang_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the reference left and right of every hit, its ends widened by 20 bp."""
    return _overhangs(spark, d)


STICKY = _OVERHANG + """,
q AS (SELECT entry_id, aln_set, qry_id, ori, CASE WHEN ori = '+' THEN qs ELSE qe END - 200 AS lo, CASE WHEN ori = '+' THEN qe ELSE qs END + 200 AS hi FROM hits),
ql_ AS (SELECT q.entry_id, q.aln_set, count(p.pos) AS n FROM q LEFT JOIN pts p ON p.map_id = q.qry_id AND p.pos < q.lo GROUP BY 1, 2),
qr_ AS (SELECT q.entry_id, q.aln_set, count(p.pos) AS n FROM q LEFT JOIN pts p ON p.map_id = q.qry_id AND p.pos > q.hi GROUP BY 1, 2),
sides AS (SELECT h.*, n_left > 5 AND CASE WHEN h.ori = '+' THEN a.n ELSE b.n END > 5 AS l, n_right > 5 AND CASE WHEN h.ori = '+' THEN b.n ELSE a.n END > 5 AS r
  FROM hits h JOIN cnt USING (entry_id, aln_set) JOIN ql_ a USING (entry_id, aln_set) JOIN qr_ b USING (entry_id, aln_set)),
sticky AS (SELECT entry_id, aln_set, ref_id, qry_id, ori, CASE WHEN l THEN rs ELSE -1 END AS left_ref, CASE WHEN l THEN qs ELSE -1 END AS left_qry, CASE WHEN r THEN re ELSE -1 END AS right_ref, CASE WHEN r THEN qe ELSE -1 END AS right_qry
  FROM sides WHERE conf >= 1100 AND (l OR r))"""


@query(sql("labels hits", STICKY + " SELECT * FROM sticky"))
def f5_sticky_hits(spark: SparkSession, d: str) -> DataFrame:
    """Conflicts (F5, W7): confident hits with more than five overhanging labels of both maps on the same side; the
    places of both where the sides part, -1 where they do not. A turned query's left is its far end."""
    h = I.hits(spark, d)
    points = I.labels(spark, d).select("map_id", "pos").distinct()
    plus = F.col("ori") == "+"
    rid = F.struct("entry_id", "aln_set")
    q = h.select(F.col("qry_id").alias("map_id"), (F.when(plus, F.col("qs")).otherwise(F.col("qe")) - 200).alias("lo"), (F.when(plus, F.col("qe")).otherwise(F.col("qs")) + 200).alias("hi"), rid.alias("rid"))
    q = ranges.counted_beside(points, q, ["map_id"], "pos", "lo", "hi", BIN).select("rid.entry_id", "rid.aln_set", F.col("n_left").alias("q_low"), F.col("n_right").alias("q_high"))
    r = _overhangs(spark, d).filter("conf >= 1100 AND (n_left > 5 OR n_right > 5)").select("entry_id", "aln_set", "n_left", "n_right")
    both = h.join(r, ["entry_id", "aln_set"]).join(q, ["entry_id", "aln_set"])
    left = (F.col("n_left") > 5) & (F.when(plus, F.col("q_low")).otherwise(F.col("q_high")) > 5)
    right = (F.col("n_right") > 5) & (F.when(plus, F.col("q_high")).otherwise(F.col("q_low")) > 5)
    at = lambda test, c: F.when(test, F.col(c)).otherwise(-1)
    return both.filter(left | right).select("entry_id", "aln_set", "ref_id", "qry_id", "ori", at(left, "rs").alias("left_ref"), at(left, "qs").alias("left_qry"), at(right, "re").alias("right_ref"), at(right, "qe").alias("right_qry"))


@query(sql("labels hits", """
b AS (SELECT DISTINCT entry_id, aln_set, ref_id AS map_id, re AS bkpt FROM hits)
SELECT entry_id, aln_set, map_id, bkpt, count(*) AS n_labels, min(coverage) AS min_coverage, min(quality) AS min_quality, CASE WHEN min(coverage) < 100 OR min(quality) < 3500 THEN true ELSE false END AS cut
FROM b JOIN labels l USING (map_id) WHERE pos BETWEEN bkpt - 100000 AND bkpt + 100000 GROUP BY ALL"""))
def j3_breakpoint_support(spark: SparkSession, d: str) -> DataFrame:
    """Coverage and chimera quality of the labels within 10 kb of every hit end, and whether they call for a
    cut (J3, X10): coverage below 10 or quality below 35."""
    b = I.hits(spark, d).select("entry_id", "aln_set", F.col("ref_id").alias("map_id"), F.col("re").alias("bkpt"), (F.col("re") - 100000).alias("lo"), (F.col("re") + 100000).alias("hi")).distinct()
    near = ranges.points_in_ranges(I.labels(spark, d).select("map_id", "pos", "coverage", "quality", "map_set", "site_id", "channel"), b, ["map_id"], "pos", "lo", "hi", BIN)
    g = near.groupBy("entry_id", "aln_set", "map_id", "bkpt").agg(F.count("*").alias("n_labels"), F.min("coverage").alias("min_coverage"), F.min("quality").alias("min_quality"))
    return g.withColumn("cut", F.coalesce((F.col("min_coverage") < 100) | (F.col("min_quality") < 3500), F.lit(False)))


@query(sql("labels hits", """
p AS (SELECT DISTINCT map_id, pos FROM labels)
SELECT h.entry_id, h.aln_set, h.ref_id AS map_id, h.rs AS at, p.pos AS nearest FROM hits h ASOF JOIN p ON p.map_id = h.ref_id AND p.pos <= h.rs"""))
def j4_label_before(spark: SparkSession, d: str) -> DataFrame:
    """The nearest label at or before the start of every hit (J4): an as-of join as one running maximum over
    labels and hits together, in two levels, so that a hot map is spread over its blocks."""
    keys = ["map_id"]
    p = I.labels(spark, d).select("map_id", F.col("pos").alias("at"), F.col("pos").alias("seen"), F.lit(None).cast("struct<entry_id:bigint,aln_set:string>").alias("hit")).distinct()
    h = I.hits(spark, d).select(F.col("ref_id").alias("map_id"), F.col("rs").alias("at"), F.lit(None).cast("long").alias("seen"), F.struct("entry_id", "aln_set").alias("hit"))
    both = p.unionByName(h).withColumn("b", F.floor(F.col("at") / (1 << 20)))
    tops = both.groupBy("map_id", "b").agg(F.max("seen").alias("top"))
    tops = tops.withColumn("carry", F.max("top").over(Window.partitionBy("map_id").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))).drop("top")
    w = Window.partitionBy("map_id", "b").orderBy("at", F.col("hit").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.join(tops, [*keys, "b"]).withColumn("nearest", F.coalesce(F.max("seen").over(w), "carry"))
    return found.filter("hit IS NOT NULL AND nearest IS NOT NULL").select("hit.entry_id", "hit.aln_set", "map_id", "at", "nearest")


@query(sql("hits", """
g AS (SELECT qry_id, aln_set, count(*) FILTER (ori = '+') AS plus, count(*) FILTER (ori = '-') AS minus, min(entry_id) FILTER (ori = '+') AS first_plus, min(entry_id) FILTER (ori = '-') AS first_minus FROM hits GROUP BY ALL)
SELECT entry_id, aln_set, h.qry_id, CASE WHEN ori = '+' THEN minus ELSE plus END AS n_links, CASE WHEN ori = '+' THEN first_minus ELSE first_plus END AS partner
FROM hits h JOIN g USING (qry_id, aln_set) WHERE plus > 0 AND minus > 0"""))
def j7_opposite_links(spark: SparkSession, d: str) -> DataFrame:
    """Hits of one query in opposite orientation (J7): each hit with the number of its partners and the first.
    All pairs of a query follow from its two classes, so they are not written out."""
    h = I.hits(spark, d).select("entry_id", "aln_set", "qry_id", "ori")
    plus = F.col("ori") == "+"
    g = h.groupBy("qry_id", "aln_set").agg(
        F.count_if(plus).alias("plus"), F.count_if(~plus).alias("minus"), F.min(F.when(plus, F.col("entry_id"))).alias("first_plus"), F.min(F.when(~plus, F.col("entry_id"))).alias("first_minus")
    )
    both = salted_join(h, g.filter("plus > 0 AND minus > 0"), ["qry_id", "aln_set"], [F.col("entry_id")])
    return both.select("entry_id", "aln_set", "qry_id", F.when(plus, F.col("minus")).otherwise(F.col("plus")).alias("n_links"), F.when(plus, F.col("first_minus")).otherwise(F.col("first_plus")).alias("partner"))


@query(sql("hits", """
f AS (SELECT DISTINCT aln_set, qry_id, least(qs, qe) AS lo, greatest(qs, qe) AS hi FROM hits)
SELECT a.aln_set, a.qry_id, a.lo, a.hi, b.lo AS lo2, b.hi AS hi2, least(a.hi, b.hi) - b.lo + 1 AS shared FROM f a JOIN f b ON a.aln_set = b.aln_set AND a.qry_id = b.qry_id AND (b.lo > a.lo OR (b.lo = a.lo AND b.hi > a.hi)) AND b.lo <= a.hi"""))
def j8_sibling_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping fragments of one contig."""
    f = I.hits(spark, d).select("aln_set", "qry_id", F.least("qs", "qe").alias("lo"), F.greatest("qs", "qe").alias("hi")).distinct()
    pairs = ranges.overlaps(f, f.withColumnsRenamed({"lo": "lo2", "hi": "hi2"}), ["aln_set", "qry_id"], BIN, 1)
    return pairs.filter((F.col("lo2") > F.col("lo")) | ((F.col("lo2") == F.col("lo")) & (F.col("hi2") > F.col("hi")))).select("aln_set", "qry_id", "lo", "hi", "lo2", "hi2", "shared")


@query(sql("maps hits", "SELECT map_set, map_id, len FROM maps WHERE map_id NOT IN (SELECT qry_id FROM hits) AND map_id NOT IN (SELECT ref_id FROM hits)"))
def j9_unused_maps(spark: SparkSession, d: str) -> DataFrame:
    """Maps that no hit names (J9, F2, U3): an anti join."""
    h = I.hits(spark, d)
    named = h.select(F.col("qry_id").alias("map_id")).union(h.select("ref_id")).distinct()
    return I.maps(spark, d).join(named, "map_id", "left_anti").select("map_set", "map_id", "len")


@query(sql("maps hits", "SELECT map_set, map_id, len FROM maps WHERE map_id IN (SELECT ref_id FROM hits WHERE conf >= 1100)"))
def f1_selected_maps(spark: SparkSession, d: str) -> DataFrame:
    """Maps of an id list (F1): a semi join."""
    ids = I.hits(spark, d).filter("conf >= 1100").select(F.col("ref_id").alias("map_id")).distinct()
    return I.maps(spark, d).join(ids, "map_id", "left_semi").select("map_set", "map_id", "len")


@query(sql("maps", "SELECT map_set, CASE WHEN num_sites >= 5 THEN 'mergeable' ELSE 'unmergeable' END AS class, count(*) AS n FROM maps GROUP BY ALL"))
def f9_mergeable(spark: SparkSession, d: str) -> DataFrame:
    """Maps with enough sites to merge."""
    return I.maps(spark, d).groupBy("map_set", F.when(F.col("num_sites") >= 5, "mergeable").otherwise("unmergeable").alias("class")).agg(F.count("*").alias("n"))


@query(sql("hits", "SELECT qry_id FROM hits WHERE channel = 1 UNION SELECT ref_id FROM hits WHERE channel = 2"))
def u2_distinct_ids(spark: SparkSession, d: str) -> DataFrame:
    """Distinct union of ids."""
    h = I.hits(spark, d)
    return h.filter("channel = 1").select("qry_id").union(h.filter("channel = 2").select("ref_id")).distinct()


@query(sql("hits", "SELECT qry_id FROM hits WHERE channel = 1 INTERSECT SELECT qry_id FROM hits WHERE channel = 2"))
def u4_common_ids(spark: SparkSession, d: str) -> DataFrame:
    """Queries hit in two channels (U4)."""
    h = I.hits(spark, d)
    return h.filter("channel = 1").select("qry_id").intersect(h.filter("channel = 2").select("qry_id"))


@query(sql("maps hits", """
u AS (SELECT map_id, len, 1 AS src FROM maps UNION ALL SELECT ref_id, max(rl), 2 FROM hits GROUP BY ref_id)
SELECT map_id, max_by(len, src) AS len FROM u GROUP BY 1"""))
def u1_override_union(spark: SparkSession, d: str) -> DataFrame:
    """Union of the maps and of those that the hits state as references, whose lengths override."""
    named = I.hits(spark, d).groupBy("ref_id").agg(F.max("rl"))
    both = I.maps(spark, d).select("map_id", "len", F.lit(1).alias("src")).union(named.select("ref_id", "max(rl)", F.lit(2)))
    return both.groupBy("map_id").agg(F.max_by("len", "src").alias("len"))


@query(sql("hits", """
r AS (SELECT aln_set, channel, entry_id, ref_id, rs, re, row_number() OVER (PARTITION BY channel ORDER BY ref_id, rs, re DESC, entry_id, aln_set) AS rn FROM hits WHERE channel IS NOT NULL),
n AS (SELECT channel, count(*) AS n FROM r GROUP BY 1), o AS (SELECT channel, sum(n) OVER (ORDER BY channel) - n AS off FROM n)
SELECT r.aln_set, r.channel, r.entry_id, (off + rn)::BIGINT AS new_id FROM r JOIN o USING (channel)"""))
def w17_combined_hits(spark: SparkSession, d: str) -> DataFrame:
    """Hits of all channels in one file, renumbered with a running offset."""
    h = I.hits(spark, d).filter("channel IS NOT NULL").select("aln_set", "channel", "entry_id", "ref_id", "rs", "re")
    return H.renumbered(h, [F.col("channel"), F.col("ref_id"), F.col("rs"), F.desc("re"), F.col("entry_id"), F.col("aln_set")]).select("aln_set", "channel", "entry_id", "new_id")


@query(sql("maps hits", """
s AS (SELECT power(10, ceil(log10(max(map_id) + 1000)))::BIGINT AS shift FROM maps)
SELECT map_set, map_id, map_id + shift AS shifted FROM maps, s"""))
def proj11_shifted_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids shifted beyond the largest."""
    m = I.maps(spark, d)
    top = m.agg(F.max("map_id")).first()[0]  # one value
    if top is None:
        return m.select("map_set", "map_id", F.col("map_id").alias("shifted"))
    import math

    return m.select("map_set", "map_id", (F.col("map_id") + 10 ** math.ceil(math.log10(top + 1000))).alias("shifted"))


@query(sql("maps hits", "SELECT h.entry_id, h.aln_set, coalesce(m.map_set || ':' || m.map_id, 'unknown') AS name, CASE WHEN m.len IS NOT NULL AND m.len > h.ql THEN coalesce(m.map_set, '') || '_subseq_' || h.qs || ':' || h.qe ELSE coalesce(m.map_set, '') END AS label FROM hits h LEFT JOIN maps m ON m.map_id = h.qry_id"))
def j6_named_hits(spark: SparkSession, d: str) -> DataFrame:
    """Hits with the name of their query and a sub-sequence label (J5, J6, P14); unknown ids are marked."""
    m = I.maps(spark, d).select(F.col("map_id").alias("qry_id"), "map_set", "len")
    both = salted_join(I.hits(spark, d), m, ["qry_id"], [F.col("entry_id")], "left")
    name = F.when(F.col("map_set").isNotNull(), F.concat("map_set", F.lit(":"), "qry_id")).otherwise("unknown")
    label = F.when(F.col("len") > F.col("ql"), F.concat(F.coalesce("map_set", F.lit("")), F.lit("_subseq_"), "qs", F.lit(":"), "qe")).otherwise(F.coalesce("map_set", F.lit("")))
    return both.select("entry_id", "aln_set", name.alias("name"), label.alias("label"))


_COMPOSE = """
sites AS (SELECT DISTINCT map_id, channel, pos FROM labels),
inq AS (SELECT h.entry_id, h.aln_set, s.channel, count(*) AS n FROM hits h JOIN sites s ON s.map_id = h.qry_id AND s.pos BETWEEN least(h.qs, h.qe) AND greatest(h.qs, h.qe) GROUP BY ALL),
inr AS (SELECT h.entry_id, h.aln_set, s.channel, count(*) AS n FROM hits h JOIN sites s ON s.map_id = h.ref_id AND s.pos BETWEEN h.rs AND h.re GROUP BY ALL),
both_ AS (SELECT coalesce(q.entry_id, r.entry_id) AS entry_id, coalesce(q.aln_set, r.aln_set) AS aln_set, coalesce(q.n, 0) AS a, coalesce(r.n, 0) AS b FROM inq q FULL JOIN inr r USING (entry_id, aln_set, channel))"""


@query(sql("labels hits", _COMPOSE + """
SELECT entry_id, aln_set, sum(a * b)::BIGINT AS dot, sum(a * a)::BIGINT AS aa, sum(b * b)::BIGINT AS bb FROM both_ GROUP BY ALL
HAVING bool_and((a > 0) = (b > 0)) AND sum(a * b) * sum(a * b) * 100 >= sum(a * a) * sum(b * b)"""))
def f4_channel_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Hits whose query and reference hold the same channels, with a cosine of their counts of at least 0.1
    (F4, X9). Squares are compared, so all is whole-number arithmetic."""
    sites = I.labels(spark, d).select("map_id", "channel", "pos").distinct()
    h = I.hits(spark, d)

    def counted(span: DataFrame, name: str) -> DataFrame:
        inside = ranges.points_in_ranges(sites, span, ["map_id"], "pos", "lo", "hi", 10 * BIN)
        return inside.groupBy("entry_id", "aln_set", "channel").agg(F.count("*").alias(name))

    q = counted(h.select("entry_id", "aln_set", F.col("qry_id").alias("map_id"), F.least("qs", "qe").alias("lo"), F.greatest("qs", "qe").alias("hi")), "a")
    r = counted(h.select("entry_id", "aln_set", F.col("ref_id").alias("map_id"), F.col("rs").alias("lo"), F.col("re").alias("hi")), "b")
    both = q.select("entry_id", "aln_set", "channel", "a", F.lit(0).alias("b")).unionByName(r.select("entry_id", "aln_set", "channel", F.lit(0).alias("a"), "b"))
    both = both.groupBy("entry_id", "aln_set", "channel").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    g = both.groupBy("entry_id", "aln_set").agg(
        F.sum(F.col("a") * F.col("b")).alias("dot"), F.sum(F.col("a") * F.col("a")).alias("aa"), F.sum(F.col("b") * F.col("b")).alias("bb"), F.bool_and((F.col("a") > 0) == (F.col("b") > 0)).alias("same")
    )
    return g.filter("same AND dot * dot * 100 >= aa * bb").drop("same")
