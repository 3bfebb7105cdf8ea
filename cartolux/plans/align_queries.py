"""Queries of alignment, gap filling, multi-channel building and scaffold export; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align as A
from ..operators import export as X
from ..operators import hits as H
from ..runtime import Stage
from . import inputs as I
from .graph_queries import FOREST, x22_layout
from .inputs import sql

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    l = I.labels(spark, d)
    return A.packed(l.filter("map_set LIKE 'NGS%'").select("map_id", "pos")), A.packed(l.filter("map_set LIKE 'BNG%'").select("map_id", "pos"))


def _chained(spark: SparkSession, d: str, rule: str, *more: str) -> DataFrame:
    out = A.chained(A.windows(I.hits(spark, d), I.labels(spark, d), 0, 1_000_000), rule)
    return out.select("entry_id", "aln_set", "n_pairs", F.floor(F.col("cost") * 1000 + 0.5).alias("cost3"), "turned", "first_qry", "first_ref", "last_qry", "last_ref", *more)


@query()
def x3_realigned_hits(spark: SparkSession, d: str) -> DataFrame:
    """Every hit aligned anew over the labels of its spans, in the better direction (X3): matches first, then cost,
    under the limit on passed labels, with the rejections of two-sided mode."""
    return _chained(spark, d, "whole")


@query()
def x4_cheapest_chains(spark: SparkSession, d: str) -> DataFrame:
    """The chain of least cost over the labels of every hit, direction as given."""
    return _chained(spark, d, "cheapest")


@query()
def x6_blockwise_chains(spark: SparkSession, d: str) -> DataFrame:
    """Hits whose labels pair to nine tenths when taken in blocks."""
    return _chained(spark, d, "blocks")


@query()
def x7_overlapping_ends(spark: SparkSession, d: str) -> DataFrame:
    """The end of every hit's query on the beginning of its reference stretch, seeds of 50 labels of each."""
    return _chained(spark, d, "ends")


@query()
def x8_molecule_ends(spark: SparkSession, d: str) -> DataFrame:
    """Every hit's query as a contig on the reference stretch as a molecule: seeds of 14 labels of both ends, both
    directions; the end that lies on it, its direction, and the part of the molecule left free (X8)."""
    bp = [F.floor(F.col(c) * 10 + 0.5).cast("long").alias(c) for c in ("link_start", "link_mid", "link_end")]
    return _chained(spark, d, "molecule", "end", "dir", *bp, "link_side")


@query()
def x27_two_pass_alignments(spark: SparkSession, d: str) -> DataFrame:
    """Sequence maps against assembled maps in two passes, the best of each (X27, J10): all pairs scored,
    the best traced."""
    q, r = _sides(spark, d)
    out = A.two_passes(q, r)
    return out.select("qry_id", "ref_id", F.size("pairs").alias("n_pairs"), F.floor(F.col("score") * 1000 + 0.5).alias("score3"), "ori")


def _fillers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The labels of every map, read once, and the best small map for every internal gap."""
    stage = Stage(spark)
    arrays = stage.write(A.map_arrays(I.labels(spark, d, A.MAP)), "labels")
    m = stage.write(I.maps(spark, d), "maps")
    mean = m.filter("num_sites > 0").groupBy("map_set").agg((F.sum("len") / F.sum("num_sites")).alias("mean_distance"))
    mean = F.broadcast(stage.write(mean, "mean"))  # one row per map set
    contexts = stage.write(A.gaps_in_context(arrays.join(mean, "map_set"), 10 * F.col("mean_distance"), 0.618 * 10 * F.col("mean_distance"), 51), "contexts")
    small = m.join(mean, "map_set").filter("len BETWEEN 20 * mean_distance AND 400 * mean_distance AND num_sites BETWEEN 10 AND 250").select("map_id").distinct()
    same = arrays.join(small, "map_id", "left_semi").groupBy("map_id")
    smalls = stage.write(same.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("positions")), "smalls")
    return arrays, stage.write(A.gap_fillers(contexts, smalls), "fillers")


@query()
def x14_gap_fillers(spark: SparkSession, d: str) -> DataFrame:
    """The best small map for every internal gap."""
    _, out = _fillers(spark, d)
    return out.select("map_id", "lo", "hi", "small_id", "n_pairs", F.floor(F.col("score") * 1000 + 0.5).alias("score3"), F.floor(F.col("shift") + 0.5).alias("shift"))


@query()
def x14_filled_maps(spark: SparkSession, d: str) -> DataFrame:
    """The maps with their gaps filled, all that follows shifted."""
    arrays, fillers = _fillers(spark, d)
    hosts = arrays.join(fillers.select("map_id").distinct(), "map_id", "left_semi")
    return A.filled_maps(hosts.select("map_id", F.explode("positions").alias("pos")), fillers)


@query(FOREST + ", " + ", ".join(I.CTES[n] for n in ("labels",)) + """,
ids AS (SELECT map_id, row_number() OVER (ORDER BY map_id) AS node FROM (SELECT DISTINCT map_id FROM labels)),
put AS (SELECT path_id, node_id, channel, CASE WHEN dir = '+' THEN start + pos ELSE "end" - pos END AS pos, start, "end" FROM lay JOIN ids ON node = node_id JOIN labels USING (map_id))
SELECT path_id, node_id, channel, pos - min(pos) OVER (PARTITION BY path_id) + 200 AS pos, CASE WHEN pos < start THEN 'prev' WHEN pos > "end" THEN 'post' ELSE 'core' END AS side FROM put""")
def x23_merged_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of all maps of a path on one axis, before, within or behind their node's stretch (X23): the layout's node ids count maps of the whole stage, so
    maps take part by their dense number."""
    l = I.labels(spark, d).select("map_set", "map_id", "channel", "pos")
    numbered = H.renumbered(l.select("map_id").distinct(), [F.col("map_id")], "node")
    named = l.join(numbered, "map_id").select(F.col("node").alias("map_id"), "channel", "pos")
    return A.merged_labels(x22_layout(spark, d), named)


_BP = """
b AS (SELECT entry_id, aln_set, qry_id, ref_id, ori, conf, channel, floor((qs + 5) / 10)::BIGINT AS qs, floor((qe + 5) / 10)::BIGINT AS qe, floor((rs + 5) / 10)::BIGINT AS rs, floor((re + 5) / 10)::BIGINT AS re, floor((ql + 5) / 10)::BIGINT AS ql, floor((rl + 5) / 10)::BIGINT AS rl FROM hits),
best AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY qry_id ORDER BY conf DESC, entry_id, aln_set) = 1)"""


def _best(spark: SparkSession, d: str) -> DataFrame:
    """The best hit of each query, in whole bp."""
    bp = lambda c: F.floor((c + 5) / 10).alias
    h = I.hits(spark, d).select(
        "entry_id", "aln_set", "qry_id", "ref_id", "ori", "conf", "channel", bp(F.col("qs"))("qs"), bp(F.col("qe"))("qe"),
        bp(F.col("rs"))("rs"), bp(F.col("re"))("re"), bp(F.col("ql"))("ql"), bp(F.col("rl"))("rl"),
    )
    return H.best_per_query(h, ["qry_id"])


_WALK = _BP + """,
x AS (SELECT *, rs - CASE WHEN ori = '+' THEN qs - 1 ELSE ql - qs END AS ext_start, re + CASE WHEN ori = '+' THEN ql - qe ELSE qe - 1 END AS ext_end, row_number() OVER (PARTITION BY ref_id ORDER BY rs, re DESC, entry_id) AS rn FROM best),
walk(ref_id, rn, cur, prev, gap, adjusted_gap, embedded) AS (
  SELECT ref_id, rn, rn, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, false FROM x WHERE rn = 1
  UNION ALL SELECT n.ref_id, n.rn, CASE WHEN -(n.ext_start - c.ext_end - 1) > n.ql THEN w.cur ELSE n.rn END, c.qry_id, n.rs - c.re - 1, n.ext_start - c.ext_end - 1, -(n.ext_start - c.ext_end - 1) > n.ql
  FROM walk w JOIN x n ON n.ref_id = w.ref_id AND n.rn = w.rn + 1 JOIN x c ON c.ref_id = w.ref_id AND c.rn = w.cur),
g AS (SELECT x.*, w.prev AS prev_qry, w.gap, w.adjusted_gap, w.embedded FROM walk w JOIN x USING (ref_id, rn)),
names AS (SELECT map_id AS id, map_set || '_' || map_id AS name FROM maps)"""


def _recursive(names: str, body: str) -> str:
    return sql(names, body).replace("WITH ", "WITH RECURSIVE ", 1)


@query(_recursive("hits maps", _WALK + " SELECT entry_id, ref_id, qry_id, prev_qry, gap, adjusted_gap, embedded FROM g"))
def f13_scaffold_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps between neighbours of each scaffold, with embedded queries marked."""
    return X.scaffold_gaps(_best(spark, d))


def _names(spark: SparkSession, d: str) -> DataFrame:
    return I.maps(spark, d).select(F.col("map_id").alias("id"), F.concat("map_set", F.lit("_"), "map_id").alias("name"))


@query(_recursive("hits maps", _WALK + """,
k AS (SELECT g.*, coalesce(name, qry_id::VARCHAR) AS component, CASE WHEN adjusted_gap IS NULL THEN 0 WHEN adjusted_gap < 0 THEN 13 WHEN adjusted_gap < 23 THEN 23 ELSE adjusted_gap END AS pad FROM g LEFT JOIN names ON id = qry_id WHERE NOT embedded),
o AS (SELECT *, sum(pad + ql) OVER (PARTITION BY ref_id ORDER BY rn) AS stop, row_number() OVER (PARTITION BY ref_id ORDER BY rn) AS no FROM k)
SELECT 'Super-Scaffold_' || ref_id AS object, (stop - ql + 1)::BIGINT AS object_beg, stop::BIGINT AS object_end, 2 * no - 1 AS part, 'W' AS kind, component, '1' AS component_beg, ql::VARCHAR AS component_end, ori AS orientation FROM o
UNION ALL SELECT 'Super-Scaffold_' || ref_id, (stop - ql + 1 - pad)::BIGINT, (stop - ql)::BIGINT, 2 * no - 2, 'N', pad::VARCHAR, 'scaffold', 'yes', 'map' FROM o WHERE pad > 0"""))
def w11_agp(spark: SparkSession, d: str) -> DataFrame:
    """AGP rows of all scaffolds."""
    h = Stage(spark).write(_best(spark, d), "best")
    return X.agp(h, X.scaffold_gaps(h), _names(spark, d))


@query(_recursive("hits maps", _WALK + """,
l AS (SELECT ref_id, qry_id, max(ql) AS ql, any_value(coalesce(name, qry_id::VARCHAR)) AS name FROM best LEFT JOIN names ON id = qry_id GROUP BY 1, 2),
z AS (SELECT ref_id, arg_max(qry_id, {'a': rs, 'b': entry_id}) AS qry_id FROM g WHERE NOT embedded GROUP BY 1)
SELECT a.name AS name1, b.name AS name2, g.ref_id, gap, adjusted_gap, a.ql AS len1, b.ql AS len2 FROM g JOIN l a ON a.ref_id = g.ref_id AND a.qry_id = prev_qry JOIN l b ON b.ref_id = g.ref_id AND b.qry_id = g.qry_id
UNION ALL SELECT l.name, l.name, z.ref_id, 0, 0, l.ql, l.ql FROM z JOIN l ON l.ref_id = z.ref_id AND l.qry_id = z.qry_id"""))
def w10_gap_report(spark: SparkSession, d: str) -> DataFrame:
    """The gap report, with a last row for every scaffold."""
    stage = Stage(spark)
    h = stage.write(_best(spark, d), "best")
    return X.gap_report(stage.write(X.scaffold_gaps(h), "gaps"), h, _names(spark, d))


@query(sql("hits", _BP + " SELECT ref_id, min(rs) - 1 AS begin_gap, max(rl) - max(re) AS end_gap FROM best GROUP BY 1"))
def w11_trimmed_ends(spark: SparkSession, d: str) -> DataFrame:
    """Bases before the first and after the last hit of each scaffold."""
    return X.trimmed_ends(_best(spark, d))


@query(sql("hits", _BP + """,
s1 AS (SELECT * FROM (SELECT *, max(re) OVER (PARTITION BY ref_id, channel ORDER BY rs, re DESC, entry_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM best) WHERE r IS NULL OR re > r),
s2 AS (SELECT * FROM (SELECT * EXCLUDE (r), max(re) OVER (PARTITION BY ref_id ORDER BY rs, re DESC, entry_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM s1) WHERE r IS NULL OR re > r)
SELECT ref_id, channel, entry_id, qry_id, ori, CASE WHEN lag(re) OVER w IS NULL THEN rs ELSE floor((lag(re) OVER w + rs) / 2)::BIGINT + 1 END AS region_start,
  CASE WHEN lead(rs) OVER w IS NULL THEN least(re + 100000, rl) ELSE floor((re + lead(rs) OVER w) / 2)::BIGINT END AS region_end, row_number() OVER w AS no
FROM s2 WINDOW w AS (PARTITION BY ref_id ORDER BY rs, re DESC, entry_id)"""))
def x25_channel_regions(spark: SparkSession, d: str) -> DataFrame:
    """Regions of scaffolds from the hits of all channels."""
    h = _best(spark, d).filter("channel IS NOT NULL")
    return X.channel_regions(h, 100_000)


ORACLES["x25_channel_regions"] = ORACLES["x25_channel_regions"].replace("FROM best) WHERE r IS NULL OR re > r),\ns2", "FROM best WHERE channel IS NOT NULL) WHERE r IS NULL OR re > r),\ns2")


@query(sql("hits", _BP + " SELECT entry_id, aln_set, rs - 500 AS gap, CASE WHEN rs - 500 < 0 THEN 13 WHEN rs - 500 < 23 THEN 23 ELSE rs - 500 END AS padded FROM best"))
def x26_padded_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The gap sizes written for gaps of any size."""
    gap = F.col("rs") - 500
    return _best(spark, d).select("entry_id", "aln_set", gap.alias("gap"), X.padded(gap).cast("long").alias("padded"))
