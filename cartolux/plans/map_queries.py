"""Queries over map sets: channels, cutting and translation, masks, gaps, conflicts; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hits as H
from ..operators import malformed, ranges
from ..operators import maps as M
from ..runtime import table
from . import inputs as I
from .core_problems import ORACLES as CORE
from .hit_queries import STICKY
from .inputs import sql

QUERIES, ORACLES = {}, {}
BIN = 1_000_000


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query(sql("labels", """
k AS (SELECT map_set, map_id, site_id, CASE channel WHEN 2 THEN 1 ELSE 2 END AS channel, pos FROM labels WHERE channel IN (2, 1))
SELECT map_set, map_id, row_number() OVER (PARTITION BY map_set, map_id ORDER BY pos, channel, site_id) AS site_id, channel, pos, count(*) OVER (PARTITION BY map_set, map_id) AS num_sites FROM k"""))
def proj13_channel_subset(spark: SparkSession, d: str) -> DataFrame:
    """Channels 2 and 1 chosen and renumbered."""
    return M.channel_subset(I.labels(spark, d), [2, 1]).select("map_set", "map_id", "site_id", "channel", "pos", "num_sites")


@query("SELECT map_set, CMapId AS map_id, CASE WHEN LabelChannel > 0 THEN 1 ELSE 0 END AS channel, count(*) AS n FROM cmap WHERE LabelChannel IS NOT NULL GROUP BY ALL")
def proj12_unified_channels(spark: SparkSession, d: str) -> DataFrame:
    """All channels as one, terminal rows kept."""
    c = table(spark, d, "cmap").filter("LabelChannel IS NOT NULL").select("map_set", F.col("CMapId").alias("map_id"), F.col("LabelChannel").alias("channel"))
    return M.unified(c).groupBy("map_set", "map_id", "channel").agg(F.count("*").alias("n"))


@query(sql("labels", """
codes AS (SELECT map_set, dense_rank() OVER (ORDER BY map_set) AS code FROM (SELECT DISTINCT map_set FROM labels WHERE map_set LIKE 'BNG%'))
SELECT map_id, map_set, pos, code AS channel, row_number() OVER (PARTITION BY map_id ORDER BY pos, code, map_set, site_id) AS site_id FROM labels JOIN codes USING (map_set)"""))
def x24_recombined(spark: SparkSession, d: str) -> DataFrame:
    """Single-channel maps put together by id, channels coded by set."""
    l = I.labels(spark, d).filter("map_set LIKE 'BNG%'")
    from pyspark.sql import Window

    codes = l.select("map_set").distinct().select("map_set", F.dense_rank().over(Window.orderBy("map_set")).alias("code"))  # one row per map set
    return M.recombined(l, codes)


_CUTS = """
ext AS (SELECT map_id, max(len) AS len FROM maps GROUP BY 1),
top AS (SELECT max(map_id) AS m FROM ext),
inside AS (SELECT DISTINCT l.map_id, l.pos AS "at", m.len FROM labels l JOIN ext m USING (map_id) WHERE l.quality BETWEEN 0 AND 7500 AND l.pos > 0 AND l.pos < m.len - 1),
b AS (SELECT map_id, len, "at" FROM inside UNION SELECT map_id, len, NULL FROM inside),
cut AS (SELECT map_id AS old_id, coalesce("at" + 1, 0) AS old_start, coalesce(lead("at") OVER w, len - 1) AS old_end, m * 1 + m * 2 * (row_number() OVER w - 1) + map_id AS new_id FROM b, top WINDOW w AS (PARTITION BY map_id ORDER BY "at" NULLS FIRST)),
seg AS (SELECT * FROM cut UNION ALL SELECT map_id, 0, len - 1, map_id FROM ext WHERE map_id NOT IN (SELECT map_id FROM inside))"""


def _segments(spark: SparkSession, d: str) -> DataFrame:
    lengths = I.maps(spark, d).groupBy("map_id").agg(F.max("len").alias("len"))
    cuts = I.labels(spark, d).filter("quality BETWEEN 0 AND 7500").select("map_id", F.col("pos").alias("at"))
    return M.fragments(cuts, lengths, 1, 2, lengths.agg(F.max("map_id")).first()[0] or 0)  # one value


@query(sql("labels maps", _CUTS + " SELECT old_id, old_start, old_end, new_id, 0::BIGINT AS new_start, old_end - old_start AS new_end FROM seg"))
def x12_fragments(spark: SparkSession, d: str) -> DataFrame:
    """Translation rows of maps cut at labels of low chimera quality."""
    return _segments(spark, d)


@query(sql("labels maps", _CUTS + """, w AS (SELECT *, lag(old_end) OVER (PARTITION BY old_id ORDER BY old_start, new_id) AS prev FROM seg)
SELECT old_id, old_start, old_end, new_id, 0::BIGINT AS new_start, old_end - old_start AS new_end FROM w WHERE old_start >= old_end OR (prev IS NOT NULL AND prev + 1 <> old_start)"""))
def s7_invalid_segments(spark: SparkSession, d: str) -> DataFrame:
    """Translation rows that are not contiguous or not ascending."""
    return M.invalid_segments(_segments(spark, d))


@query(sql("labels maps", _CUTS + """
SELECT s.new_id, row_number() OVER (PARTITION BY s.new_id ORDER BY l.pos, l.channel, l.site_id, l.map_set) AS site_id, l.channel, l.pos - s.old_start AS pos, s.old_end - s.old_start AS len
FROM labels l JOIN seg s ON s.old_id = l.map_id AND l.pos > s.old_start AND l.pos <= s.old_end"""))
def x11_cut_maps(spark: SparkSession, d: str) -> DataFrame:
    """Labels on the pieces of their maps (X11)."""
    return M.cut(I.labels(spark, d).select("map_set", "map_id", "site_id", "channel", "pos", "coverage", "quality"), _segments(spark, d), BIN * 100)


@query(sql("labels maps hits", _CUTS + """,
ends AS (SELECT old_id, max(old_end) AS last FROM seg GROUP BY 1), k AS (SELECT new_id, s.old_id, old_start, last FROM seg s JOIN ends USING (old_id))
SELECT entry_id, aln_set, coalesce(k.old_id, qry_id) AS qry_id, qs + coalesce(old_start, 0) AS qs, qe + coalesce(old_start, 0) AS qe, coalesce(last + 1, ql) AS ql FROM hits h LEFT JOIN k ON k.new_id = h.qry_id"""))
def proj2_translated(spark: SparkSession, d: str) -> DataFrame:
    """Query coordinates brought back to the uncut map; unknown ids unchanged."""
    h = I.hits(spark, d).select("entry_id", "aln_set", "qry_id", "qs", "qe", "ql")
    return H.translated(h, _segments(spark, d))


@query(sql("labels hits", """
lead_ AS (SELECT map_id AS qry_id, count(DISTINCT pos) AS n FROM labels WHERE pos < 100000 GROUP BY 1),
p AS (SELECT entry_id, aln_set, qry_id, list_zip(regexp_extract_all(pairs, '\\(([0-9]+),([0-9]+)\\)', 1), regexp_extract_all(pairs, '\\(([0-9]+),([0-9]+)\\)', 2)) AS z FROM hits),
t AS (SELECT entry_id, aln_set, p.qry_id, list_sort(list_transform(z, lambda x: {'q': x[2]::INT + coalesce(n, 0)::INT, 'r': x[1]::INT})) AS s FROM p LEFT JOIN lead_ USING (qry_id))
SELECT entry_id, aln_set, qry_id, array_to_string(list_transform(s, lambda x: '(' || x.r || ',' || x.q || ')'), '') AS pairs FROM t"""))
def proj3_shifted_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Label numbers of the pairs shifted by the labels that lead a map, here those of its first 10 kb."""
    n = I.labels(spark, d).filter("pos < 100000").select(F.col("map_id").alias("qry_id"), "pos").distinct().groupBy("qry_id").agg(F.count("*").alias("n_before"))
    return H.pairs_shifted(I.hits(spark, d).select("entry_id", "aln_set", "qry_id", "pairs"), n)


@query("WITH k AS (SELECT p_partkey AS old_id, p_size + 1000000 AS new_id FROM part) SELECT l_orderkey AS entry_id, l_linenumber, count(*) AS n, max(coalesce(new_id, l_partkey)) AS qry_id FROM lineitem LEFT JOIN k ON old_id = l_partkey AND old_id % 2 = 0 GROUP BY ALL")
def proj4_remapped(spark: SparkSession, d: str) -> DataFrame:
    """Ids through a key table, unknown ones unchanged."""
    keys = table(spark, d, "part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("old_id"), (F.col("p_size") + 1000000).cast("long").alias("new_id"))
    h = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("entry_id"), "l_linenumber", F.col("l_partkey").alias("qry_id"))
    return H.remapped(h, keys).groupBy("entry_id", "l_linenumber").agg(F.count("*").alias("n"), F.max("qry_id").alias("qry_id"))


@query(sql("labels", """
r AS (SELECT map_set, map_id, site_id, pos, row_number() OVER (PARTITION BY map_set, map_id ORDER BY pos, site_id, channel) AS f, row_number() OVER (PARTITION BY map_set, map_id ORDER BY pos DESC, site_id DESC, channel DESC) AS b FROM labels)
SELECT map_set, map_id, site_id, pos, CASE WHEN f = 1 OR b = 1 THEN 6 ELSE 0 END AS mask FROM r"""))
def proj18_end_masks(spark: SparkSession, d: str) -> DataFrame:
    """Mask bits on the first and last label."""
    return M.masked(I.labels(spark, d), 6).select("map_set", "map_id", "site_id", "pos", "mask")


_GAPS = """
mean AS (SELECT map_set, sum(len) / sum(num_sites) AS mean_distance FROM maps WHERE num_sites > 0 GROUP BY 1),
n AS (SELECT *, count(*) OVER (PARTITION BY map_set, map_id) AS n, lag(pos) OVER (PARTITION BY map_set, map_id ORDER BY pos, site_id, channel) AS before FROM labels)"""


@query(sql("labels maps", _GAPS + " SELECT map_set, map_id, before AS lo, pos AS hi FROM n JOIN mean USING (map_set) WHERE n >= 51 AND before IS NOT NULL AND pos - before >= 10 * mean_distance"))
def f18_internal_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps of ten mean distances in maps of 51 labels or more."""
    mean = I.maps(spark, d).filter("num_sites > 0").groupBy("map_set").agg((F.sum("len") / F.sum("num_sites")).alias("mean_distance"))
    return M.internal_gaps(I.labels(spark, d), mean, 10, 51)


@query(sql("labels maps", _GAPS + " SELECT map_set, map_id, len, num_sites FROM maps JOIN mean USING (map_set) WHERE len BETWEEN 20 * mean_distance AND 400 * mean_distance AND num_sites BETWEEN 10 AND 250"))
def f17_fill_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Small maps that may fill a gap."""
    m = I.maps(spark, d)
    mean = m.filter("num_sites > 0").groupBy("map_set").agg((F.sum("len") / F.sum("num_sites")).alias("mean_distance"))
    both = m.join(F.broadcast(mean), "map_set")  # one row per map set
    return both.filter("len BETWEEN 20 * mean_distance AND 400 * mean_distance AND num_sites BETWEEN 10 AND 250").select("map_set", "map_id", "len", "num_sites")


@query(sql("labels", """
g AS (SELECT *, CASE WHEN pos - lag(pos) OVER w > 1000000 THEN 1 ELSE 0 END AS new FROM labels WINDOW w AS (PARTITION BY map_set, map_id ORDER BY pos, site_id, channel)),
r AS (SELECT *, sum(new) OVER (PARTITION BY map_set, map_id ORDER BY pos, site_id, channel ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT map_set, map_id, run::BIGINT AS run, min(pos) AS lo, max(pos) AS hi, count(*) AS n FROM r GROUP BY ALL"""))
def n9_stretches(spark: SparkSession, d: str) -> DataFrame:
    """Stretches of labels without a distance beyond 100 kb."""
    return M.runs_between_gaps(I.labels(spark, d), 1_000_000).groupBy("map_set", "map_id", "run").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.count("*").alias("n"))


_PAINT = """
sites AS (SELECT DISTINCT map_id, pos FROM labels),
paint AS (SELECT s.map_id, s.pos, arg_max(h.qry_id, {'c': h.conf, 'e': h.entry_id, 'q': h.qry_id}) AS partner FROM sites s JOIN hits h ON h.ref_id = s.map_id AND s.pos BETWEEN h.rs AND h.re GROUP BY ALL),
sup AS (SELECT *, min(partner) OVER w = max(partner) OVER w AS support FROM paint WINDOW w AS (PARTITION BY map_id ORDER BY pos ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING))"""


@query(sql("labels hits", _PAINT + " SELECT map_id, pos, partner, support FROM sup"))
def x10_painted_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels painted with the partner of their best hit, and whether ten labels on either side agree."""
    sites = I.labels(spark, d).select("map_id", "pos").distinct()
    return M.supported(M.painted(I.hits(spark, d), sites, BIN), 10)


_SETTLE = STICKY + """,
side AS (SELECT entry_id, aln_set, ref_id, qry_id, 'L' AS side, left_ref AS rb, left_qry AS qb FROM sticky WHERE left_ref <> -1 UNION ALL SELECT entry_id, aln_set, ref_id, qry_id, 'R', right_ref, right_qry FROM sticky WHERE right_ref <> -1),
near AS (SELECT s.entry_id, s.aln_set, s.side, min(l.coverage) < 100 OR min(l.quality) < 3500 AS weak FROM side s JOIN labels l ON l.map_id = s.qry_id AND l.pos BETWEEN s.qb - 100000 AND s.qb + 100000 GROUP BY ALL),
flagged AS (SELECT s.*, CASE WHEN coalesce(weak, false) THEN 'okay' ELSE 'cut' END AS r_was, CASE WHEN coalesce(weak, false) THEN 'cut' ELSE 'okay' END AS q_was FROM side s LEFT JOIN near USING (entry_id, aln_set, side)),
cover AS (SELECT ref_id AS map_id, rs AS lo, re AS hi, qry_id AS partner, conf, entry_id, 'r' AS role FROM hits UNION ALL SELECT qry_id, least(qs, qe), greatest(qs, qe), ref_id, conf, entry_id, 'q' FROM hits),
paint2 AS (SELECT c.role, p.map_id, p.pos, arg_max(partner, {'c': conf, 'e': entry_id, 'q': partner}) AS partner FROM pts p JOIN cover c ON c.map_id = p.map_id AND p.pos BETWEEN c.lo AND c.hi GROUP BY ALL),
roles(role) AS (VALUES ('r'), ('q')),
every AS (SELECT roles.role, p.map_id, p.pos, coalesce(partner, -1) AS partner FROM pts p CROSS JOIN roles LEFT JOIN paint2 t ON t.role = roles.role AND t.map_id = p.map_id AND t.pos = p.pos),
alt AS (SELECT role, map_id, pos, CASE WHEN min(partner) OVER w = max(partner) OVER w THEN partner ELSE -1 END AS alt FROM every WINDOW w AS (PARTITION BY role, map_id ORDER BY pos ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)),
ra AS (SELECT f.*, coalesce(a.alt, -1) NOT IN (-1, f.qry_id) AS rsup FROM flagged f ASOF LEFT JOIN (SELECT * FROM alt WHERE role = 'r') a ON a.map_id = f.ref_id AND a.pos <= f.rb),
qa AS (SELECT f.*, coalesce(a.alt, -1) NOT IN (-1, f.ref_id) AS qsup FROM ra f ASOF LEFT JOIN (SELECT * FROM alt WHERE role = 'q') a ON a.map_id = f.qry_id AND a.pos <= f.qb)
SELECT entry_id, aln_set, side, rsup AS ref_support, qsup AS qry_support, CASE WHEN rsup AND qsup THEN 'okay' WHEN qsup THEN CASE WHEN q_was = 'okay' THEN 'cut' ELSE 'okay' END WHEN rsup THEN 'okay' ELSE r_was END AS ref_status,
  CASE WHEN qsup THEN 'okay' WHEN rsup THEN CASE WHEN q_was = 'okay' THEN 'okay' ELSE 'cut' END ELSE q_was END AS qry_status FROM qa"""


@query(sql("labels hits", _SETTLE))
def x10_settled_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """The sides of all conflicts decided (X10, W7): the query is at fault where labels within 10 kb of its
    breakpoint have a coverage below 10 or a quality below 35, else the reference; then the four cases of
    alternative support, which is one other partner painted on the label at the breakpoint and five around it."""
    from ..runtime import Stage
    from .hit_queries import f5_sticky_hits

    h, labels = I.hits(spark, d), I.labels(spark, d)
    sites = labels.select("map_id", "pos").distinct()
    parts = F.array(*[F.struct(F.lit(n).alias("side"), F.col(f"{w}_ref").alias("rb"), F.col(f"{w}_qry").alias("qb")) for n, w in (("L", "left"), ("R", "right"))])
    side = f5_sticky_hits(spark, d).select("entry_id", "aln_set", "ref_id", "qry_id", F.explode(parts).alias("p")).filter("p.rb <> -1").select("entry_id", "aln_set", "ref_id", "qry_id", "p.*")
    side = Stage(spark).write(side, "conflicts")
    keys = ["entry_id", "aln_set", "side"]
    span = side.select(*keys, F.col("qry_id").alias("map_id"), (F.col("qb") - 100_000).alias("lo"), (F.col("qb") + 100_000).alias("hi"))
    near = ranges.points_in_ranges(labels.select("map_id", "pos", "coverage", "quality"), span, ["map_id"], "pos", "lo", "hi", BIN).groupBy(*keys).agg(F.min("coverage").alias("c"), F.min("quality").alias("q"))
    weak = F.coalesce((F.col("c") < 100) | (F.col("q") < 3500), F.lit(False))
    flagged = side.join(near, keys, "left").select(*side.columns, F.when(weak, "okay").otherwise("cut").alias("r_was"), F.when(weak, "cut").otherwise("okay").alias("q_was"))

    def supported(rows: DataFrame, hits: DataFrame, own: str, at: str, other: str, out: str) -> DataFrame:
        alt = M.alternatives(M.painted(hits, sites, BIN), sites, 5)
        probes = rows.withColumn("map_id", F.col(own)).withColumn("at", F.col(at))
        found = ranges.at_or_before(alt, probes, ["alt"]).drop("map_id", "at")
        return found.withColumn(out, ~F.coalesce(F.col("found.alt"), F.lit(-1)).isin(-1) & (F.col("found.alt") != F.col(other))).withColumn(out, F.coalesce(out, F.lit(False))).drop("found")

    turned = h.select(F.col("qry_id").alias("ref_id"), F.least("qs", "qe").alias("rs"), F.greatest("qs", "qe").alias("re"), "conf", "entry_id", F.col("ref_id").alias("qry_id"))
    both = supported(supported(flagged, h, "ref_id", "rb", "qry_id", "ref_support"), turned, "qry_id", "qb", "ref_id", "qry_support")
    ref, qry = M.settled(F.col("ref_support"), F.col("qry_support"), F.col("r_was"), F.col("q_was"))
    return both.select(*keys, "ref_support", "qry_support", ref.alias("ref_status"), qry.alias("qry_status"))


@query(f"""
WITH c AS ({CORE['p4_valid']}), n AS (SELECT "refId" AS contig, file_id, count(*) AS n FROM c WHERE "refLeftBkptStatus" = 'cut' OR "refRightBkptStatus" = 'cut' GROUP BY 1, 2),
m AS (SELECT contig, max(n) AS n FROM n GROUP BY 1) SELECT count(*) AS n_contigs, sum(n)::BIGINT AS n_conflicts FROM m""")
def a13_conflict_report(spark: SparkSession, d: str) -> DataFrame:
    """Conflicts per contig, the largest count over files, then summed."""
    c = malformed.accepted(table(spark, d, "conflict_line")).filter("refLeftBkptStatus = 'cut' OR refRightBkptStatus = 'cut'")
    n = c.groupBy(F.col("refId").alias("contig"), "file_id").agg(F.count("*").alias("n")).groupBy("contig").agg(F.max("n").alias("n"))
    return n.agg(F.count("*").alias("n_contigs"), F.sum("n").alias("n_conflicts"))


@query(f"""
WITH c AS ({CORE['p4_valid']}) SELECT side, id, "at", count(*) AS n FROM (
  SELECT 'L' AS side, "qryId" AS id, floor("qryLeftBkpt" + 0.5)::BIGINT AS "at" FROM c WHERE "qryLeftBkpt" <> -1 UNION ALL SELECT 'R', "qryId", floor("qryRightBkpt" + 0.5)::BIGINT FROM c WHERE "qryRightBkpt" <> -1) GROUP BY ALL""")
def s8_breakpoints(spark: SparkSession, d: str) -> DataFrame:
    """Query breakpoints in long form, without the -1 of none."""
    c = malformed.accepted(table(spark, d, "conflict_line"))
    long = c.selectExpr("qryId AS id", "stack(2, 'L', qryLeftBkpt, 'R', qryRightBkpt) AS (side, b)").filter("b <> -1")
    return long.groupBy("side", "id", F.floor(F.col("b") + 0.5).alias("at")).agg(F.count("*").alias("n"))


@query(f"""
WITH c AS ({CORE['p4_valid']}), b AS (SELECT "qryId" AS id, floor("qryLeftBkpt" + 0.5)::BIGINT AS "at" FROM c WHERE "qryLeftBkpt" <> -1),
n AS (SELECT id, "at", row_number() OVER (PARTITION BY id ORDER BY "at") AS no FROM (SELECT DISTINCT id, "at" FROM b))
SELECT id AS chrom, greatest("at" - 1000, 0) AS chrom_start, "at" + 1000 AS chrom_end, 'cut_' || no AS name, '255,0,0' AS rgb FROM n""")
def w8_bed_windows(spark: SparkSession, d: str) -> DataFrame:
    """BED windows of a thousand bp around the breakpoints, numbered per contig."""
    from pyspark.sql import Window

    c = malformed.accepted(table(spark, d, "conflict_line")).filter("qryLeftBkpt <> -1").select(F.col("qryId").alias("id"), F.floor(F.col("qryLeftBkpt") + 0.5).alias("at")).distinct()
    no = F.row_number().over(Window.partitionBy("id").orderBy("at"))
    return c.select(F.col("id").alias("chrom"), F.greatest(F.col("at") - 1000, F.lit(0)).alias("chrom_start"), (F.col("at") + 1000).alias("chrom_end"), F.concat(F.lit("cut_"), no).alias("name"), F.lit("255,0,0").alias("rgb"))


_THREE = "CASE WHEN {0} = 0 THEN 0 ELSE sign({0}) * floor(abs({0}) / power(10, floor(log10(abs({0}))) - 2) + 0.5) * power(10, floor(log10(abs({0}))) - 2) END"


@query(f"""
WITH c AS (SELECT DISTINCT "xId" AS x, "refId" AS r, "qryId" AS q, "qryLeftBkpt" AS lb, "qryRightBkpt" AS rb FROM ({CORE['p4_valid']})),
b AS (SELECT x, r, q, lb AS b FROM c WHERE lb <> -1 UNION SELECT x, r, q, rb FROM c WHERE rb <> -1),
k AS (SELECT *, {_THREE.format('lb')} AS l3, {_THREE.format('rb')} AS r3 FROM c), m AS (SELECT *, {_THREE.format('b')} AS b3 FROM b)
SELECT m.x, m.r, m.q, m.b, bool_or(l3 = b3) AS left_met, bool_or(r3 = b3) AS right_met, count(*) AS n FROM m JOIN k ON k.x = m.x AND k.r = m.r AND k.q = m.q GROUP BY ALL HAVING bool_or(l3 = b3) OR bool_or(r3 = b3)""")
def j13_three_digit_keys(spark: SparkSession, d: str) -> DataFrame:
    """Query breakpoints joined to the conflicts of their three ids whose left or right breakpoint has the same
    first three digits (J13): the tolerance is a rounding, so the composite key is an equi key."""
    three = lambda c: F.when(F.col(c) == 0, 0.0).otherwise(F.signum(c) * F.floor(F.abs(c) / F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))) - 2) + 0.5) * F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))) - 2))
    v = malformed.accepted(table(spark, d, "conflict_line"))
    c = v.select(F.col("xId").alias("x"), F.col("refId").alias("r"), F.col("qryId").alias("q"), F.col("qryLeftBkpt").alias("lb"), F.col("qryRightBkpt").alias("rb")).distinct()
    long = c.select("x", "r", "q", F.explode(F.array("lb", "rb")).alias("b")).filter("b <> -1").distinct()
    both = long.withColumn("b3", three("b")).join(c.withColumn("l3", three("lb")).withColumn("r3", three("rb")), ["x", "r", "q"])
    met = both.groupBy("x", "r", "q", "b").agg(F.bool_or(F.col("l3") == F.col("b3")).alias("left_met"), F.bool_or(F.col("r3") == F.col("b3")).alias("right_met"), F.count("*").alias("n"))
    return met.filter("left_met OR right_met")


@query(sql("hits", "SELECT aln_set, count(*) AS n, sum(abs(qe - qs)::DECIMAL(20,0) * (re - rs)::DECIMAL(20,0))::DOUBLE / sum(abs(qe - qs)::DECIMAL(20,0) * abs(qe - qs)::DECIMAL(20,0))::DOUBLE AS factor FROM hits GROUP BY 1 HAVING sum(abs(qe - qs)) > 0"))
def x28_rescale_factors(spark: SparkSession, d: str) -> DataFrame:
    """Stretch factors of the queries of each set."""
    return M.rescale_factors(I.hits(spark, d), ["aln_set"])


@query("SELECT CMapId AS map_id, count(*) AS n, min(Coverage) AS min_coverage, min(ChimQuality) AS min_quality, bool_or(ChimQuality IS NOT NULL) AS has_score FROM cmap WHERE LabelChannel <> 0 AND LabelChannel IS NOT NULL GROUP BY 1")
def s12_chimera_scores(spark: SparkSession, d: str) -> DataFrame:
    """Chimera quality and coverage per map, and whether scores exist at all."""
    c = table(spark, d, "cmap").filter("LabelChannel <> 0")
    return c.groupBy(F.col("CMapId").alias("map_id")).agg(F.count("*").alias("n"), F.min("Coverage").alias("min_coverage"), F.min("ChimQuality").alias("min_quality"), F.bool_or(F.col("ChimQuality").isNotNull()).alias("has_score"))
