"""Queries over glues, edges, evidence and sequences; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import evidence as E
from ..operators import graph as G
from ..operators import hits as H
from ..operators import prefix
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


_SX, _SY = "(CASE WHEN ori_x = '+' THEN 1 ELSE -1 END)", "(CASE WHEN ori_y = '+' THEN 1 ELSE -1 END)"
_OFF = f"""
c AS (SELECT *, 2 * greatest(CASE WHEN ori_x = '+' THEN qs_x ELSE qe_x END, CASE WHEN ori_y = '+' THEN qs_y ELSE qe_y END) + overlap - 10 - ql AS c2 FROM gl),
o AS (SELECT *, (rs_x + re_x - rl_x) - {_SX} * (qs_x + qe_x - ql) + {_SX} * c2 AS off2_x, (rs_y + re_y - rl_y) - {_SY} * (qs_y + qe_y - ql) + {_SY} * c2 AS off2_y FROM c),
off_ AS (SELECT *, CASE WHEN {_SX} * {_SY} = 1 THEN '+' ELSE '-' END AS direction, off2_y - {_SX} * {_SY} * off2_x AS rel2 FROM o)"""


@query(sql("gl", _OFF + " SELECT glue_id, qry_id, ref_x, ref_y, off2_x, off2_y, direction, rel2 FROM off_"))
def proj8_glue_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Offsets of glues on both references, relative direction and offset."""
    return G.offsets(I.glues(spark, d)).select("glue_id", "qry_id", "ref_x", "ref_y", "off2_x", "off2_y", "direction", "rel2")


def _end_sql() -> str:
    low = {s: f"(CASE WHEN ori_{s} = '+' THEN qs_{s} ELSE qe_{s} END)" for s in "xy"}
    high = {s: f"(CASE WHEN ori_{s} = '+' THEN qe_{s} ELSE qs_{s} END)" for s in "xy"}
    lo, hi = f"greatest({low['x']}, {low['y']})", f"least({high['x']}, {high['y']})"
    cols = []
    for s in "xy":
        at_lo = f"CASE WHEN ori_{s} = '+' THEN rs_{s} + ({lo} - {low[s]}) ELSE re_{s} - ({lo} - {low[s]}) END"
        at_hi = f"CASE WHEN ori_{s} = '+' THEN re_{s} - ({high[s]} - {hi}) ELSE rs_{s} + ({high[s]} - {hi}) END"
        cols += [f"CASE WHEN ori_x = '+' THEN {at_lo} ELSE {at_hi} END AS first_{s}", f"CASE WHEN ori_x = '+' THEN {at_hi} ELSE {at_lo} END AS second_{s}"]
    return f"e AS (SELECT glue_id, ref_x, ref_y, overlap, {', '.join(cols)} FROM gl)"


_ENDS = _end_sql()


@query(sql("gl", _ENDS + " SELECT glue_id, ref_x, ref_y, first_x, first_y, second_x, second_y FROM e"))
def proj9_glue_ends(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates of both ends of glues on both references."""
    return G.ends(I.glues(spark, d)).select("glue_id", "ref_x", "ref_y", "first_x", "first_y", "second_x", "second_y")


@query(sql("gl", "SELECT glue_id, ref_x, ref_y FROM gl QUALIFY count(*) OVER (PARTITION BY ref_x, ref_y) >= 2"))
def f7_repeated_glues(spark: SparkSession, d: str) -> DataFrame:
    """Glues of pairs with two glues or more."""
    g = I.glues(spark, d).select("glue_id", "ref_x", "ref_y")
    many = g.groupBy("ref_x", "ref_y").agg(F.count("*").alias("n")).filter("n >= 2").select("ref_x", "ref_y")
    return g.join(many, ["ref_x", "ref_y"]).select("glue_id", "ref_x", "ref_y")


_FIT = _OFF + """,
k1 AS (SELECT * FROM off_ QUALIFY row_number() OVER (PARTITION BY ref_x, ref_y, off2_x ORDER BY overlap DESC, glue_id) = 1),
k2 AS (SELECT * FROM k1 QUALIFY row_number() OVER (PARTITION BY ref_x, ref_y, off2_y ORDER BY overlap DESC, glue_id) = 1),
s AS (SELECT ref_x, ref_y, count(*) AS n, sum(overlap)::BIGINT AS w, max(rl_x) AS lx, max(rl_y) AS ly,
  sum(off2_x::HUGEINT)::DOUBLE AS sx, sum(off2_y::HUGEINT)::DOUBLE AS sy, sum(off2_x::HUGEINT * off2_x)::DOUBLE AS sxx, sum(off2_y::HUGEINT * off2_y)::DOUBLE AS syy, sum(off2_x::HUGEINT * off2_y)::DOUBLE AS sxy,
  sum(overlap::HUGEINT * off2_x)::DOUBLE AS wx, sum(overlap::HUGEINT * off2_y)::DOUBLE AS wy, sum(overlap::HUGEINT * off2_x * off2_x)::DOUBLE AS wxx, sum(overlap::HUGEINT * off2_x * off2_y)::DOUBLE AS wxy,
  arg_min(CASE WHEN direction = '+' THEN 1 ELSE -1 END, glue_id) AS dir, arg_min(rel2, glue_id) AS rel2, string_agg(glue_id::VARCHAR, ',' ORDER BY glue_id) AS glues FROM k2 GROUP BY 1, 2),
l AS (SELECT *, n > 1 AND w * wxx - wx * wx > 0 AS line FROM s),
f AS (SELECT *, CASE WHEN line THEN (w * wxy - wx * wy) / (w * wxx - wx * wx) ELSE dir END AS slope,
  CASE WHEN n > 1 AND n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0 THEN (n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)) ELSE 1.0 END AS coef FROM l),
fit AS (SELECT *, ((CASE WHEN line THEN (wy - slope * wx) / w ELSE rel2 END) + ly - slope * lx) / 2 AS intercept FROM f WHERE abs(coef) >= 0.9)"""


@query(sql("gl", _FIT + " SELECT ref_x, ref_y, n AS nglues, w AS overlap, floor(slope * 1000000 + 0.5)::BIGINT AS slope6, floor(intercept + 0.5)::BIGINT AS intercept, glues FROM fit"))
def a10_fitted_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges fitted through the glues of each pair: count, overlap, weighted line, correlation at least 0.9
    (A10, A11, F8, W16)."""
    f = G.fitted(I.glues(spark, d))
    return f.select("ref_x", "ref_y", "nglues", "overlap", F.floor(F.col("slope") * 1000000 + 0.5).alias("slope6"), F.floor(F.col("intercept") + 0.5).alias("intercept"), "glues")


@query(sql("gl", _FIT + ", " + _ENDS + """, x AS (SELECT e.*, abs(first_x * slope + intercept - first_y) AS one, abs(second_x * slope + intercept - second_y) AS two FROM e JOIN fit ON fit.ref_x = e.ref_x AND fit.ref_y = e.ref_y)
SELECT glue_id, ref_x, ref_y FROM x WHERE (one > 500000 AND one / overlap > 0.1) OR (two > 500000 AND two / overlap > 0.1)"""))
def f6_outlier_glues(spark: SparkSession, d: str) -> DataFrame:
    """Glues with an end 50 kb and a tenth of the overlap off the fitted line of their pair."""
    g = I.glues(spark, d)
    lines = G.fitted(g).select("ref_x", "ref_y", "slope", "intercept")
    both = salted_join(G.ends(g), lines, ["ref_x", "ref_y"], [F.col("glue_id")])
    return G.outliers(both, F.col("slope"), F.col("intercept"), 500000, 0.1).select("glue_id", "ref_x", "ref_y")


@query("""SELECT type, id, row_number() OVER (ORDER BY type, id) AS node FROM (SELECT DISTINCT type1 AS type, id1 AS id FROM edges UNION SELECT DISTINCT type2, id2 FROM edges) WHERE id IS NOT NULL AND type IS NOT NULL""")
def x15_numbered_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of all types numbered densely."""
    e = table(spark, d, "edges")
    nodes = e.select(F.col("type1").alias("type"), F.col("id1").alias("id")).union(e.select("type2", "id2")).filter("id IS NOT NULL AND type IS NOT NULL").distinct()
    return H.renumbered(nodes, [F.col("type"), F.col("id")], "node").select("type", "id", "node")


def _affine(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "edges").filter("id1 IS NOT NULL AND id2 IS NOT NULL AND id1 <> id2 AND slope IS NOT NULL AND intercept IS NOT NULL")
    return e.select(
        F.col("id1").alias("a"), F.col("id2").alias("b"), F.coalesce(F.round(F.col("overlap") * 10), F.lit(0)).cast("long").alias("weight"),
        F.when(F.col("slope") < 0, -1).otherwise(1).alias("sign"), F.round(F.col("intercept") * 10).cast("long").alias("shift"),
    )


#: The forest by its definition: an edge belongs to it unless edges before it (heavier, or as heavy and of smaller
#: ids) link its ends already. Then every node by the path of forest edges from the smallest node.
FOREST = """
WITH RECURSIVE raw AS (
  SELECT id1 AS a, id2 AS b, coalesce(CAST(round(overlap * 10) AS BIGINT), 0) AS weight, CASE WHEN slope < 0 THEN -1 ELSE 1 END AS sign, CAST(round(intercept * 10) AS BIGINT) AS shift
  FROM edges WHERE id1 IS NOT NULL AND id2 IS NOT NULL AND id1 <> id2 AND slope IS NOT NULL AND intercept IS NOT NULL),
flat AS (SELECT least(a, b) AS a, greatest(a, b) AS b, weight, sign, CASE WHEN a > b THEN -sign * shift ELSE shift END AS shift FROM raw),
e AS (SELECT *, row_number() OVER (ORDER BY weight DESC, a, b) AS rk FROM (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY weight DESC, sign DESC, shift DESC) = 1)),
adj AS (SELECT a AS node, b AS other, rk FROM e UNION ALL SELECT b, a, rk FROM e),
reach(rk, node) AS (SELECT rk, a FROM e UNION SELECT r.rk, d.other FROM reach r JOIN adj d ON d.node = r.node AND d.rk < r.rk),
forest AS (SELECT e.* FROM e WHERE NOT EXISTS (SELECT 1 FROM reach r WHERE r.rk = e.rk AND r.node = e.b)),
low(node, root) AS (SELECT a, a FROM e UNION SELECT b, b FROM e UNION SELECT d.other, l.root FROM low l JOIN adj d ON d.node = l.node WHERE l.root < d.other),
roots AS (SELECT node, min(root) AS root FROM low GROUP BY 1),
both_ AS (SELECT a AS node, b AS other, sign, -sign * shift AS shift FROM forest UNION ALL SELECT b, a, sign, shift FROM forest),
at_(node, root, sign, shift, prev) AS (
  SELECT node, root, 1, 0::BIGINT, -1::BIGINT FROM roots WHERE node = root
  UNION ALL SELECT f.other, p.root, p.sign * f.sign, p.sign * f.shift + p.shift, p.node FROM at_ p JOIN both_ f ON f.node = p.node WHERE f.other <> p.prev),
kinds AS (SELECT node, max(CAST(round(len * 10) AS BIGINT)) AS len, min(type) AS type FROM (SELECT id1 AS node, length1 AS len, type1 AS type FROM edges UNION ALL SELECT id2, length2, type2 FROM edges) WHERE node IS NOT NULL GROUP BY 1),
spans AS (SELECT a.root, a.node, a.sign, k.type, coalesce(k.len, 0) AS len, least(shift, sign * coalesce(k.len, 0) + shift) AS s, greatest(shift, sign * coalesce(k.len, 0) + shift) AS e FROM at_ a LEFT JOIN kinds k USING (node)),
lay AS (SELECT root AS path_id, node AS node_id, type, CASE WHEN sign = 1 THEN '+' ELSE '-' END AS dir, (s - min(s) OVER (PARTITION BY root))::BIGINT AS start, (e - min(s) OVER (PARTITION BY root))::BIGINT AS "end",
  CASE WHEN sign = 1 THEN 0 ELSE len END AS xstart, CASE WHEN sign = 1 THEN len ELSE 0 END AS xend, len AS xlength FROM spans)"""


@query(FOREST + " SELECT a, b, weight FROM forest")
def x16_spanning_forest(spark: SparkSession, d: str) -> DataFrame:
    """The maximum spanning forest of the edges."""
    return G.spanning_layout(_affine(spark, d))[0]


@query(FOREST + ' SELECT path_id, node_id, node_id AS ori_id, type, start, "end", dir, xstart, xend, xlength FROM lay')
def x22_layout(spark: SparkSession, d: str) -> DataFrame:
    """Nodes placed on the axes of their paths along the forest, with their own coordinates at both ends (X22, D11);
    the edge table numbers nodes of all types together, so a node's own id is its number."""
    e = table(spark, d, "edges")
    one = e.select(F.col("id1").alias("node"), F.col("length1").alias("len"), F.col("type1").alias("type")).union(e.select("id2", "length2", "type2")).filter("node IS NOT NULL")
    kinds = one.groupBy("node").agg(F.max(F.round(F.col("len") * 10)).cast("long").alias("len"), F.min("type").alias("type"))
    placed = G.layout(_affine(spark, d), kinds.select("node", "len").filter("len IS NOT NULL"))
    named = salted_join(placed, kinds.withColumnRenamed("node", "node_id"), ["node_id"], [F.col("path_id")], "left")
    len_, plus = F.coalesce("len", F.lit(0)), F.col("dir") == "+"
    return named.select(
        "path_id", "node_id", F.col("node_id").alias("ori_id"), "type", "start", "end", "dir", F.when(plus, 0).otherwise(len_).alias("xstart"), F.when(plus, len_).otherwise(0).alias("xend"), len_.alias("xlength")
    )


@query(FOREST + """, r AS (SELECT *, max("end") OVER (PARTITION BY path_id ORDER BY start, "end" DESC, node_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM lay)
SELECT path_id, node_id, dir, start, "end", start - reach AS gap FROM r""")
def n6_path_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gap or overlap of every node of a path to what lies before it."""
    return G.path_gaps(x22_layout(spark, d).select("path_id", "node_id", "dir", "start", "end"))


_ANCHORS = """
s AS (SELECT glue_id, ref_x, ref_y, CASE WHEN ori_x = ori_y THEN '+' ELSE '-' END AS dir, least(first_x, second_x) AS x1, greatest(first_x, second_x) AS x2, least(first_y, second_y) AS y1, greatest(first_y, second_y) AS y2
  FROM e JOIN (SELECT glue_id, ref_x, ref_y, ori_x, ori_y FROM gl) USING (glue_id, ref_x, ref_y)),
k1 AS (SELECT * EXCLUDE (r) FROM (SELECT *, max(x2) OVER (PARTITION BY ref_x, ref_y ORDER BY x1, x2 DESC, glue_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM s) WHERE r IS NULL OR x2 > r),
k2 AS (SELECT * EXCLUDE (r) FROM (SELECT *, max(y2) OVER (PARTITION BY ref_x, ref_y ORDER BY y1, y2 DESC, glue_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM k1) WHERE r IS NULL OR y2 > r),
n AS (SELECT *, lag(x2) OVER x AS px, lead(x1) OVER x AS nx, lag(y2) OVER y AS py, lead(y1) OVER y AS ny, row_number() OVER x AS no FROM k2
  WINDOW x AS (PARTITION BY ref_x, ref_y ORDER BY x1, x2 DESC, glue_id), y AS (PARTITION BY ref_x, ref_y ORDER BY y1, y2 DESC, glue_id))
SELECT glue_id, ref_x, ref_y, no, dir, CASE WHEN px > x1 THEN floor((px + x1) / 2)::BIGINT ELSE x1 END AS start_x, CASE WHEN nx < x2 THEN floor((x2 + nx) / 2)::BIGINT ELSE x2 END AS end_x,
  CASE WHEN py > y1 THEN floor((py + y1) / 2)::BIGINT ELSE y1 END AS start_y, CASE WHEN ny < y2 THEN floor((y2 + ny) / 2)::BIGINT ELSE y2 END AS end_y FROM n"""


@query(sql("gl", _ENDS + "," + _ANCHORS))
def x17_anchors(spark: SparkSession, d: str) -> DataFrame:
    """The glues of each pair of references as a chain of anchors: covered ones dropped, overlaps of neighbours cut at
    their middle on both references (X17)."""
    return G.anchors(G.ends(I.glues(spark, d)))


@query(sql("gl", _ENDS + "," + _ANCHORS.rsplit("SELECT glue_id, ref_x", 1)[0] + """
, a AS (SELECT ref_x, ref_y, no, CASE WHEN px > x1 THEN floor((px + x1) / 2)::BIGINT ELSE x1 END AS sx, CASE WHEN nx < x2 THEN floor((x2 + nx) / 2)::BIGINT ELSE x2 END AS ex,
  CASE WHEN py > y1 THEN floor((py + y1) / 2)::BIGINT ELSE y1 END AS sy, CASE WHEN ny < y2 THEN floor((y2 + ny) / 2)::BIGINT ELSE y2 END AS ey, dir FROM n),
g AS (SELECT ref_x, ref_y, no, dir, sx - lag(ex) OVER w AS gx, CASE WHEN dir = '+' THEN sy - lag(ey) OVER w ELSE lag(sy) OVER w - ey END AS gy FROM a WINDOW w AS (PARTITION BY ref_x, ref_y ORDER BY no))
SELECT ref_x, ref_y, no, (gx + gy) / 2 AS gap FROM g WHERE gx IS NOT NULL"""))
def proj17_anchor_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Distance of each anchor to the one before it, the mean over both references."""
    from pyspark.sql import Window

    from ..functions.scalars import shared_gap

    w = Window.partitionBy("ref_x", "ref_y").orderBy("no")  # the anchors of one pair lie side by side on a map
    plus = F.col("dir") == "+"
    a = G.anchors(G.ends(I.glues(spark, d)))
    ends = F.array(F.lag("end_x").over(w), F.when(plus, F.lag("end_y").over(w)).otherwise(F.col("end_y")))
    starts = F.array(F.col("start_x"), F.when(plus, F.col("start_y")).otherwise(F.lag("start_y").over(w)))
    return a.select("ref_x", "ref_y", "no", shared_gap(ends, starts).alias("gap"), F.lag("end_x").over(w).alias("_p")).filter("_p IS NOT NULL").drop("_p")


@query(FOREST + """, v AS (SELECT path_id, node_id, sum(CASE WHEN dir = '+' THEN xlength ELSE -xlength END) OVER (PARTITION BY path_id) AS vote, dir, start, "end", max("end") OVER (PARTITION BY path_id) AS stop, count(*) OVER (PARTITION BY path_id) AS n FROM lay),
w AS (SELECT path_id, row_number() OVER (ORDER BY n DESC, path_id) AS rank FROM (SELECT DISTINCT path_id, n FROM v))
SELECT v.path_id, w.rank, node_id, CASE WHEN vote >= 0 THEN dir WHEN dir = '+' THEN '-' ELSE '+' END AS dir, CASE WHEN vote >= 0 THEN start ELSE stop - "end" END AS start, CASE WHEN vote >= 0 THEN "end" ELSE stop - start END AS "end" FROM v JOIN w USING (path_id)""")
def x21_oriented_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths numbered by their nodes, turned round where most of their length is turned."""
    from .pipeline import ranked_paths

    lay = x22_layout(spark, d)
    ranks = ranked_paths(lay.select("path_id", "node_id")).select("path_id", "rank")
    return G.oriented(lay).join(ranks, "path_id")


_STATS = "SELECT *, s / n AS mean, sqrt(greatest(n * ss - s * s, 0)) / n AS std FROM (SELECT ctg1, ctg2, end1, end2, count(*) AS n, sum(distance::HUGEINT)::DOUBLE AS s, sum(distance::HUGEINT * distance)::DOUBLE AS ss FROM {} GROUP BY ALL)"


@query(sql("evid", f"st AS ({_STATS.format('evid')}) SELECT ctg1, ctg2, end1, end2, n, floor(mean * 1000 + 0.5)::BIGINT AS mean3, floor(std * 1000 + 0.5)::BIGINT AS std3 FROM st"))
def a16_distance_stats(spark: SparkSession, d: str) -> DataFrame:
    """Mean and population deviation of the distances of each link."""
    s = E.distance_stats(I.evidence(spark, d), E.LINK)
    return s.select(*E.LINK, "n", F.floor(F.col("mean") * 1000 + 0.5).alias("mean3"), F.floor(F.col("std") * 1000 + 0.5).alias("std3"))


@query(sql("evid", "SELECT no, ctg1, ctg2, end1, end2, distance FROM evid WHERE ori1 <> ori2 AND abs(distance) <= 1000000 AND minlabels >= 5 AND minlabels <= 30"))
def f14_plausible_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Evidence of opposite orientations within a million bp and the label counts."""
    return E.plausible(I.evidence(spark, d), 5, 30).select("no", *E.LINK, "distance")


@query(sql("evid", f"""
st AS ({_STATS.format('evid')}),
o AS (SELECT e.*, st.n, st.std, abs(e.distance - st.mean) AS off, floor(abs(e.distance - st.mean) * 1000) AS o FROM evid e JOIN st USING (ctg1, ctg2, end1, end2)),
k AS (SELECT ctg1, ctg2, end1, end2, min(o) AS edge FROM (SELECT *, count(*) OVER (PARTITION BY ctg1, ctg2, end1, end2 ORDER BY o) AS upto FROM o) WHERE upto >= n - ceil(n * 0.1::DOUBLE) GROUP BY ALL),
near AS (SELECT o.* FROM o JOIN k USING (ctg1, ctg2, end1, end2) WHERE n <= 3 OR o <= edge OR off < 1.2::DOUBLE * std),
st2 AS ({_STATS.format('near')})
SELECT no, ctg1, ctg2, end1, end2, distance FROM near JOIN (SELECT ctg1, ctg2, end1, end2 FROM st2 WHERE mean > -3000 AND std < 10000) USING (ctg1, ctg2, end1, end2)"""))
def f15_trimmed_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Evidence without the outliers of its link."""
    return E.trimmed(I.evidence(spark, d).select("no", *E.LINK, "distance"), E.LINK).select("no", *E.LINK, "distance")


@query(sql("evid", """
k AS (SELECT ctg1, ctg2, end1, end2, count(*) AS n FROM evid GROUP BY ALL), p AS (SELECT ctg1, ctg2, sum(n)::BIGINT AS total, max(n) AS top, count(*) AS kinds FROM k GROUP BY 1, 2)
SELECT ctg1, ctg2, total, top, kinds FROM p WHERE total >= 3 AND (kinds = 1 OR (total >= 6 AND top >= 0.3 * total))"""))
def f16_consistent_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Contig pairs whose evidence agrees on the ends (F16)."""
    return E.consistent(I.evidence(spark, d), 3, 0.3)


@query(sql("evid", """
l AS (SELECT p_partkey AS id, p_size * 1000 + 50000 AS len FROM part),
j AS (SELECT e.*, a.len AS len1, b.len AS len2, (20000 - distance)::BIGINT AS span FROM evid e JOIN l a ON a.id = e.ctg1 JOIN l b ON b.id = e.ctg2),
f AS (SELECT *, trunc(len1 * span / (len1 + len2))::BIGINT AS first FROM j), p AS (SELECT *, len1 - first AS at1, len2 - (span - first) AS at2 FROM f)
SELECT no, ctg1, CASE WHEN end1 = '5' THEN at1 ELSE at1 - 100 END AS start1, CASE WHEN end1 = '5' THEN at1 - 100 ELSE at1 END AS stop1,
  ctg2, CASE WHEN end2 = '5' THEN at2 ELSE at2 - 100 END AS start2, CASE WHEN end2 = '5' THEN at2 - 100 ELSE at2 END AS stop2 FROM p"""))
def proj19_mate_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Evidence as mate pairs."""
    lengths = table(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 1000 + 50000).cast("long").alias("len"))
    return E.mate_pairs(I.evidence(spark, d), lengths, 20000)


MOTIFS = {1: ["CACGAG"], 2: ["GAATGC"], 3: ["ATCGAT", "GGATCC"]}
_FORMS = ", ".join(f"({c}, '{f}')" for c, ms in MOTIFS.items() for m in ms for f in sorted({m, S.reverse_complement(m)}))
_DIGEST = f"""
motifs(channel, m) AS (VALUES {_FORMS}),
at_ AS (SELECT seq_id, seq, unnest(range(1, length(seq) + 1)) AS site FROM seqs),
dig AS (SELECT DISTINCT seq_id, site, channel FROM at_ JOIN motifs ON substr(seq, site, 6) = m)"""


@query(sql("seqs", _DIGEST + " SELECT seq_id, site, channel FROM dig"))
def x1_digested(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the sequences in three channels."""
    return S.digested(I.sequences(spark, d), MOTIFS)


@query(sql("seqs", _DIGEST + """, n AS (SELECT seq_id, count(*) AS loci FROM dig GROUP BY 1)
SELECT s.seq_id, loci, length(seq) AS len FROM seqs s JOIN n USING (seq_id) WHERE loci >= 1 AND length(seq) >= 500"""))
def f10_digested_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Sequences with enough labels and length to make a map."""
    s = I.sequences(spark, d)
    loci = S.digested(s, MOTIFS).groupBy("seq_id").agg(F.count("*").alias("loci"))
    return s.select("seq_id", F.length("seq").alias("len")).filter("len >= 500").join(loci, "seq_id").select("seq_id", "loci", "len")


@query(sql("seqs", """r AS (SELECT seq_id, seq, unnest(range(1, length(seq) + 1)) AS i FROM seqs), n AS (SELECT seq_id, i, i - row_number() OVER (PARTITION BY seq_id ORDER BY i) AS g FROM r WHERE substr(seq, i, 1) = 'N')
SELECT seq_id, min(i) - 1 AS start, max(i) AS "end" FROM n GROUP BY seq_id, g HAVING count(*) >= 3"""))
def x2_n_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Runs of three N or more."""
    return S.n_gaps(I.sequences(spark, d), 3)


_BASES = ", ".join(f"length(seq) - length(replace(seq, '{b}', '')) AS n_{b.lower()}" for b in "ACGTN")


@query(sql("seqs", f"SELECT seq_id, length(seq) AS len, {_BASES}, CASE WHEN length(seq) > length(seq) - length(replace(seq, 'N', '')) THEN (2 * length(seq) - length(replace(seq, 'C', '')) - length(replace(seq, 'G', ''))) / length(replace(seq, 'N', '')) END AS gc FROM seqs"))
def a7_composition(spark: SparkSession, d: str) -> DataFrame:
    """Base composition, N and GC share of each sequence."""
    s = I.sequences(spark, d)
    n = {b: c.alias(f"n_{b.lower()}") for b, c in S.composition(F.col("seq")).items()}
    out = s.select("seq_id", F.length("seq").alias("len"), *n.values())
    return out.withColumn("gc", F.when(F.col("len") > F.col("n_n"), (F.col("n_c") + F.col("n_g")) / (F.col("len") - F.col("n_n"))))


@query(sql("seqs", _DIGEST + """,
len_ AS (SELECT sum(length(seq)) AS total FROM seqs),
dist AS (SELECT channel, site - lag(site) OVER (PARTITION BY seq_id, channel ORDER BY site) AS dist FROM dig),
a AS (SELECT channel, count(*) AS n, sum(dist)::DOUBLE AS s, sum(dist * dist)::DOUBLE AS ss FROM dist WHERE dist IS NOT NULL GROUP BY GROUPING SETS ((channel), ())),
c AS (SELECT coalesce(channel, 0) AS channel, dist FROM dist WHERE dist IS NOT NULL UNION ALL SELECT 0, dist FROM dist WHERE dist IS NOT NULL),
h AS (SELECT channel, dist, sum(dist) OVER (PARTITION BY channel ORDER BY dist DESC) AS up, sum(dist) OVER (PARTITION BY channel) AS t FROM c),
n50 AS (SELECT channel, max(dist) AS n50 FROM h WHERE up >= t * 0.5 GROUP BY 1)
SELECT coalesce(a.channel, 0) AS channel, n AS n_distances, n50, floor(sqrt(greatest(n * ss - s * s, 0)) / n * 1000 + 0.5)::BIGINT AS std3 FROM a JOIN n50 ON n50.channel = coalesce(a.channel, 0)"""))
def a8_label_distances(spark: SparkSession, d: str) -> DataFrame:
    """N50 and deviation of label distances per channel and over all channels' own distances."""
    from pyspark.sql import Window

    w = Window.partitionBy("seq_id", "channel").orderBy("site")
    dist = S.digested(I.sequences(spark, d), MOTIFS).withColumn("dist", F.col("site") - F.lag("site").over(w)).filter("dist IS NOT NULL")
    both = dist.select(F.explode(F.array(F.col("channel"), F.lit(0))).alias("channel"), "dist")
    n50 = prefix.nx(both, ["channel"], "dist", {"n50": 0.5})
    a = both.groupBy("channel").agg(F.count("*").alias("n_distances"), F.sum("dist").cast("double").alias("s"), F.sum(F.col("dist") * F.col("dist")).cast("double").alias("ss"))
    std = F.sqrt(F.greatest(F.col("n_distances") * F.col("ss") - F.col("s") * F.col("s"), F.lit(0.0))) / F.col("n_distances")
    return a.join(n50, "channel").select("channel", "n_distances", "n50", F.floor(std * 1000 + 0.5).alias("std3"))


@query(sql("seqs", "SELECT seq_id, translate(reverse(seq), 'ACGTacgt', 'TGCAtgca') AS rc FROM seqs"))
def proj15_reverse_complement(spark: SparkSession, d: str) -> DataFrame:
    """Reverse complements."""
    return I.sequences(spark, d).select("seq_id", S.reverse_complement_column(F.col("seq")).alias("rc"))


@query(sql("seqs", "SELECT seq_id, CASE WHEN seq_id % 2 = 1 THEN translate(reverse(substr(seq, 11, 50)), 'ACGTacgt', 'TGCAtgca') ELSE substr(seq, 11, 50) END AS piece FROM seqs"))
def proj16_subsequence(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of sequences by place, length and strand."""
    strand = F.when(F.col("seq_id") % 2 == 1, "-").otherwise("+")
    return I.sequences(spark, d).select("seq_id", S.subsequence(F.col("seq"), F.lit(11), F.lit(50), strand).alias("piece"))


@query(sql("seqs", "SELECT count(*) AS n, sum(length(seq))::BIGINT AS total, min(length(seq)) AS shortest, max(length(seq)) AS longest FROM seqs"))
def a17_total_bases(spark: SparkSession, d: str) -> DataFrame:
    """Records and bases of the sequences."""
    n = F.length("seq")
    return I.sequences(spark, d).agg(F.count("*").alias("n"), F.sum(n).alias("total"), F.min(n).alias("shortest"), F.max(n).alias("longest"))
