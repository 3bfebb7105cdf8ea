"""Queries of readers and writers (what is written is read back) and of scalar functions; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.sequence import ENZYMES
from ..operators import export as X
from ..operators.align import packed
from ..runtime import Stage, table
from ..sinks import text as W
from ..sources import text as R
from . import inputs as I
from .graph_queries import FOREST, x22_layout
from .inputs import sql
from .pipeline import merged_sets, ranked_paths

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    return f"{Stage(spark).root}/{name}"


@query("""
WITH c AS (SELECT DISTINCT CMapId, ContigLength, NumSites, SiteID, LabelChannel, Position FROM cmap WHERE CMapId IS NOT NULL AND SiteID IS NOT NULL AND (Position IS NULL OR isfinite(Position)) AND (ContigLength IS NULL OR isfinite(ContigLength)))
SELECT CMapId, count(*) AS n, count(Position) AS n_positions, sum(CAST(round(Position * 10) AS BIGINT))::BIGINT AS positions, max(CAST(round(ContigLength * 10) AS BIGINT)) AS len, sum(SiteID)::BIGINT AS sites, count(LabelChannel) AS n_channels FROM c GROUP BY 1""")
def w1_cmap_files(spark: SparkSession, d: str) -> DataFrame:
    """All maps written as map files and read back."""
    finite = lambda c: F.col(c).isNull() | (~F.isnan(c) & (F.abs(c) != float("inf")))
    c = table(spark, d, "cmap").filter("CMapId IS NOT NULL AND SiteID IS NOT NULL").filter(finite("Position") & finite("ContigLength"))
    c = c.select("CMapId", "ContigLength", "NumSites", "SiteID", "LabelChannel", "Position").distinct()
    path = _folder(spark, "cmap")
    W.write_cmap(c, path, {1: "GCTCTTC"}, c.select("CMapId").distinct().count())
    back = R.read_cmap(spark, path)
    tenths = lambda x: F.round(F.col(x) * 10).cast("long")
    return back.groupBy("CMapId").agg(
        F.count("*").alias("n"), F.count("Position").alias("n_positions"), F.sum(tenths("Position")).alias("positions"), F.max(tenths("ContigLength")).alias("len"), F.sum("SiteID").alias("sites"), F.count("LabelChannel").alias("n_channels")
    )


@query(sql("hits", "SELECT entry_id, aln_set, qry_id, ref_id, qs, qe, rs, re, ori, conf, cigar, pairs FROM hits"))
def w3_xmap_files(spark: SparkSession, d: str) -> DataFrame:
    """All hits written as alignment files, one folder per set, and read back."""
    h = I.hits(spark, d)
    path = _folder(spark, "xmap")
    x = h.select(
        "aln_set", F.col("entry_id").alias("XmapEntryID"), F.col("qry_id").alias("QryContigID"), F.col("ref_id").alias("RefContigID"), (F.col("qs") / 10).alias("QryStartPos"), (F.col("qe") / 10).alias("QryEndPos"),
        (F.col("rs") / 10).alias("RefStartPos"), (F.col("re") / 10).alias("RefEndPos"), F.col("ori").alias("Orientation"), (F.col("conf") / 100).alias("Confidence"), F.col("cigar").alias("HitEnum"), F.col("pairs").alias("Alignment"),
    )
    sets = [r["aln_set"] for r in h.select("aln_set").distinct().collect()]  # the names of the sets
    out = None
    for i, name in enumerate(sets):
        W.write_xmap(x.filter(F.col("aln_set") == name).drop("aln_set"), f"{path}/{i}", "r.cmap", "q.cmap")
        one = R.read_xmap(spark, f"{path}/{i}").withColumn("aln_set", F.lit(name))
        out = one if out is None else out.unionByName(one)
    if out is None:
        return h.select("entry_id", "aln_set", "qry_id", "ref_id", "qs", "qe", "rs", "re", "ori", "conf", "cigar", "pairs")
    n = lambda c, k: F.round(F.col(c) * k).cast("long")
    return out.select(
        F.col("XmapEntryID").alias("entry_id"), "aln_set", F.col("QryContigID").alias("qry_id"), F.col("RefContigID").alias("ref_id"), n("QryStartPos", 10).alias("qs"), n("QryEndPos", 10).alias("qe"),
        n("RefStartPos", 10).alias("rs"), n("RefEndPos", 10).alias("re"), F.col("Orientation").alias("ori"), n("Confidence", 100).alias("conf"), F.col("HitEnum").alias("cigar"), F.col("Alignment").alias("pairs"),
    )


@query(sql("labels", "SELECT map_id, count(DISTINCT pos) AS n, sum(DISTINCT pos)::BIGINT AS positions FROM labels GROUP BY 1 HAVING count(DISTINCT pos) >= 30"))
def s3_molecule_files(spark: SparkSession, d: str) -> DataFrame:
    """Maps written as molecule records and read back, those of thirty labels."""
    m = packed(I.labels(spark, d).select("map_id", "pos"))
    bp = F.transform("positions", lambda p: p / 10)
    bnx = m.select(F.col("map_id").alias("molecule_id"), (F.element_at("positions", -1) / 10 + 20).alias("length"), F.size("positions").alias("n_labels"), bp.alias("labels"))
    bnx = bnx.withColumn("snr", F.transform("labels", lambda p: F.lit(10.0))).withColumn("intensity", F.transform("labels", lambda p: F.lit(0.05)))
    path = _folder(spark, "bnx")
    W.write_bnx(bnx, path)
    back = R.read_bnx(spark, path, 30)
    total = F.aggregate("labels", F.lit(0).cast("long"), lambda s, p: s + F.round(p * 10).cast("long"))
    return back.select(F.col("molecule_id").alias("map_id"), F.size("labels").cast("long").alias("n"), total.alias("positions"))


@query(sql("seqs", "SELECT 'seq_' || seq_id AS name, seq FROM seqs"))
def w12_fasta_files(spark: SparkSession, d: str) -> DataFrame:
    """All sequences written as wrapped FASTA and read back."""
    path = _folder(spark, "fasta")
    W.write_fasta(I.sequences(spark, d).select(F.concat(F.lit("seq_"), "seq_id").alias("name"), "seq"), path)
    return R.read_fasta(spark, path).select("name", "seq")


@query(sql("seqs hits", """
u AS (SELECT DISTINCT 'seq_' || qry_id AS name FROM hits)
SELECT CASE WHEN length(seq) < 300 THEN 'small' WHEN length(seq) > 3000 THEN 'large' ELSE 'fit' END AS class, u.name IS NOT NULL AS used, count(*) AS n, sum(length(seq))::BIGINT AS bases FROM seqs s LEFT JOIN u ON u.name = 'seq_' || s.seq_id GROUP BY ALL"""))
def w13_split_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Sequences by use and size, written into one folder per class and counted."""
    s = I.sequences(spark, d).select(F.concat(F.lit("seq_"), "seq_id").alias("name"), "seq")
    used = I.hits(spark, d).select(F.concat(F.lit("seq_"), "qry_id").alias("name"))
    classed = X.split_by_use(s, used, 300, 3000)
    W.write_split_fasta(classed, _folder(spark, "split"))
    return classed.groupBy("class", "used").agg(F.count("*").alias("n"), F.sum(F.length("seq")).alias("bases"))


@query("""
WITH e AS (SELECT DISTINCT id_str, nglues, type1, id1, type2, id2, glues FROM edges WHERE id_str IS NOT NULL)
SELECT id_str, nglues, type1, id1, type2, id2, coalesce(glues, '') AS glues FROM e""")
def w16_edge_files(spark: SparkSession, d: str) -> DataFrame:
    """The edge table written as text and read back, required columns checked."""
    names = ["id_str", "nglues", "type1", "id1", "type2", "id2", "glues"]
    e = table(spark, d, "edges").filter("id_str IS NOT NULL").select(*names).distinct()
    path = _folder(spark, "edges")
    W.write_table(e, path, ["id_str", "glues"])
    return R.read_table(spark, path, {n: R.EDGE[n] for n in names}).select(*names)


@query(sql("labels hits", """
m AS (SELECT map_id, count(DISTINCT pos) AS n FROM labels GROUP BY 1)
SELECT 'map' AS kind, map_id AS id, (n + 1)::BIGINT AS parts FROM m UNION ALL SELECT 'hit', entry_id, len(regexp_extract_all(pairs, '\\([0-9]+,[0-9]+\\)'))::BIGINT FROM hits"""))
def w14_fragment_xml(spark: SparkSession, d: str) -> DataFrame:
    """Maps as fragments and hits as triples in XML, counted by element."""
    from ..operators.hits import pair_list

    m = packed(I.labels(spark, d).select("map_id", "pos")).select(F.col("map_id").alias("CMapId"), (F.element_at("positions", -1) / 10 + 20).alias("length"), F.transform("positions", lambda p: p / 10).alias("positions"))
    h = I.hits(spark, d).select("entry_id", "ref_id", "qry_id", pair_list(F.col("pairs")).alias("pairs"))
    x = W.fragments_xml(m, h)
    inner = F.regexp_extract("value", r">([^<]*)</(?:FRAGMENTS|MAP_ALIGNMENT)>", 1)
    return x.select(F.when(F.col("o") == 0, "map").otherwise("hit").alias("kind"), "id", F.when(F.col("o") == 0, F.size(F.split(inner, " "))).otherwise(F.size(F.split(inner, r"\)\(")) - F.when(inner == "", 1).otherwise(0)).cast("long").alias("parts"))


@query(sql("maps hits", """
t AS (SELECT map_id AS old_id, 0::BIGINT AS old_start, len - 1 AS old_end, map_id AS new_id FROM maps UNION ALL SELECT m.map_id, 0, m.len - 1, m.map_id FROM maps m JOIN hits h ON h.ref_id = m.map_id)
SELECT DISTINCT old_id, old_start, old_end, new_id FROM t"""))
def w18_combined_translation(spark: SparkSession, d: str) -> DataFrame:
    """Translation tables of several enzymes as one, repeats dropped."""
    one = I.maps(spark, d).select(F.col("map_id").alias("old_id"), F.lit(0).cast("long").alias("old_start"), (F.col("len") - 1).alias("old_end"), F.col("map_id").alias("new_id"))
    two = one.join(I.hits(spark, d).select(F.col("ref_id").alias("old_id")).distinct(), "old_id", "left_semi")
    return one.union(two).distinct()


_MOTIF = "upper(regexp_extract(line, 'Recognition Site [0-9]+:\\s*([^;\\s]+)', 1))"


@query(f"SELECT file_id, {_MOTIF} AS motif FROM map_file_line WHERE line LIKE '#%Recognition Site 1:%'")
def s16_file_motifs(spark: SparkSession, d: str) -> DataFrame:
    """The motif in the header of every delivered file."""
    l = table(spark, d, "map_file_line").withColumn("file", F.col("file_id").cast("string"))
    h = R.headers(l.select("file", F.regexp_replace("line", r"\r$", "").alias("line")))
    return h.filter(F.col("channels")[1].isNotNull()).select(F.col("file").cast("long").alias("file_id"), F.col("channels")[1].alias("motif"))


@query(f"""SELECT m.motif, e.enzyme, count(*) AS n FROM (SELECT {_MOTIF} AS motif FROM map_file_line WHERE line LIKE '#%Recognition Site 1:%') m
LEFT JOIN (VALUES {', '.join(f"('{m}', '{e}')" for e, m in ENZYMES.items())}) e(motif, enzyme) ON e.motif = m.motif GROUP BY ALL""")
def f19_known_motifs(spark: SparkSession, d: str) -> DataFrame:
    """Files by motif and enzyme, null for motifs that are not registered."""
    names = F.create_map(*[F.lit(x) for e, m in ENZYMES.items() for x in (m, e)])
    return s16_file_motifs(spark, d).groupBy("motif", names[F.col("motif")].alias("enzyme")).agg(F.count("*").alias("n"))


@query("""SELECT f.stream, min(regexp_extract(line, 'File Version:\\s*(\\S+)', 1)::DOUBLE) AS version FROM map_file_line l JOIN map_file f USING (file_id) WHERE line LIKE '#%File Version:%' GROUP BY 1""")
def u6_common_version(spark: SparkSession, d: str) -> DataFrame:
    """The smallest file version of each stream."""
    l = table(spark, d, "map_file_line").filter(F.col("line").startswith("#")).select("file_id", F.regexp_extract("line", r"File Version:\s*(\S+)", 1).alias("v")).filter("v <> ''")
    per = l.join(table(spark, d, "map_file").select("file_id", "stream"), "file_id").groupBy("stream").agg(F.collect_set("v").alias("v"))
    return per.select("stream", scalars.newest_common_version(F.col("v")).alias("version"))


@query(sql("labels", """
p AS (SELECT map_id, list_sort(list(DISTINCT pos)) AS pos FROM labels GROUP BY 1)
SELECT map_id, list_reverse(list_transform(pos, lambda x: pos[-1] + 200 - x)) AS turned FROM p"""))
def proj5_turned_maps(spark: SparkSession, d: str) -> DataFrame:
    """Maps turned round, the last label 20 bp from the new start (P5)."""
    m = packed(I.labels(spark, d).select("map_id", "pos"))
    return m.select("map_id", scalars.turned_positions(F.col("positions"), F.element_at("positions", -1) + 200).alias("turned"))


@query(sql("labels", """
p AS (SELECT map_id, list_sort(list(DISTINCT pos)) AS pos FROM labels GROUP BY 1)
SELECT map_id, list_transform(pos, lambda x: floor(x / 10 * (510.0::DOUBLE / 500) * 100 + 0.5) / 100) AS labels FROM p"""))
def proj6_rescaled(spark: SparkSession, d: str) -> DataFrame:
    """Labels times bpp/500, to two decimals."""
    m = packed(I.labels(spark, d).select("map_id", "pos")).select("map_id", F.lit(0.0).alias("length"), F.transform("positions", lambda p: p / 10).alias("labels"))
    return R.rescaled_molecules(m, 510).select("map_id", "labels")


@query(sql("hits", """
SELECT entry_id, aln_set, CASE WHEN qs <> qe THEN floor((rs - re)::DOUBLE / (qs - qe) * 1000000 + 0.5)::BIGINT END AS slope6, CASE WHEN (qs - qe) * (rs - re) >= 0 THEN 1 ELSE -1 END AS unit_slope,
  ((rs + re) - (CASE WHEN (qs - qe) * (rs - re) >= 0 THEN 1 ELSE -1 END) * (qs + qe)) / 2 AS unit_intercept FROM hits"""))
def proj7_lines(spark: SparkSession, d: str) -> DataFrame:
    """The line through both ends of every hit and the one of unit slope through its middle."""
    ends = F.col("qs"), F.col("qe"), F.col("rs"), F.col("re")
    slope, _ = scalars.line_through(*ends)
    unit, at = scalars.unit_line(*ends)
    return I.hits(spark, d).select("entry_id", "aln_set", F.floor(slope * 1000000 + 0.5).alias("slope6"), unit.alias("unit_slope"), at.alias("unit_intercept"))


@query(sql("hits", """
n AS (SELECT entry_id, aln_set, len(regexp_extract_all(pairs, '\\([0-9]+,[0-9]+\\)')) AS n, (re - rs) / 10 AS size FROM hits)
SELECT entry_id, aln_set, CASE WHEN n <= 6 THEN n * 3.0::DOUBLE ELSE floor((n * 1.05::DOUBLE - 3.3::DOUBLE) * n * 100 + 0.5) / 100 END AS cost_limit,
  CASE WHEN size <= 600 THEN 0.0::DOUBLE WHEN size >= 2200 THEN 1.0 ELSE floor((size - 800) / 1600 * 10000 + 0.5) / 10000 END AS weight, CASE WHEN size > 600 THEN 1 ELSE 0 END AS counts FROM n"""))
def proj20_score_limits(spark: SparkSession, d: str) -> DataFrame:
    """Cost limits by number of pairs, weights and counts by size (P20)."""
    from ..operators.hits import pair_list

    size = (F.col("re") - F.col("rs")) / 10
    return I.hits(spark, d).select("entry_id", "aln_set", scalars.cost_limit(F.size(pair_list(F.col("pairs")))).alias("cost_limit"), scalars.distance_weight(size).alias("weight"), scalars.distance_counts(size).alias("counts"))


@query(sql("hits", """
SELECT entry_id, aln_set, CASE WHEN rs < 0 THEN '-' ELSE '' END || (abs(rs) // 10)::VARCHAR || '.' || (abs(rs) % 10)::VARCHAR AS start1, (conf // 100)::VARCHAR || '.' || lpad((conf % 100)::VARCHAR, 2, '0') AS conf2, format('{:,}', rl // 10) AS length FROM hits"""))
def proj21_formatted(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with fixed decimals and with separators of thousands."""
    return I.hits(spark, d).select(
        "entry_id", "aln_set", W.decimals(F.col("rs") / 10, 1).alias("start1"), W.decimals(F.col("conf") / 100, 2).alias("conf2"), W.thousands(F.floor(F.col("rl") / 10)).alias("length")
    )


@query()
def x13_merged_sets(spark: SparkSession, d: str) -> DataFrame:
    """Assembled maps of two enzymes merged into one set (X13): those that align share an axis."""
    l = I.labels(spark, d).select("map_set", "map_id", "channel", "pos")
    return merged_sets(l.filter("map_set = 'BNG_BSPQI'").drop("map_set"), l.filter("map_set = 'BNG_BSSSI'").drop("map_set"))


@query(FOREST + " SELECT path_id, n_nodes, row_number() OVER (ORDER BY n_nodes DESC, path_id) AS rank FROM (SELECT path_id, count(*) AS n_nodes FROM lay GROUP BY 1)")
def o5_ranked_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths numbered by their number of nodes."""
    return ranked_paths(x22_layout(spark, d))


@query(sql("maps", """
r AS (SELECT map_id, row_number() OVER (ORDER BY map_id) AS round FROM (SELECT DISTINCT map_id FROM maps)), z AS (SELECT round, (round - 1) AS a, (round - 27) AS b, (round - 703) AS c, (round - 18279) AS e FROM r)
SELECT round, CASE WHEN round <= 26 THEN chr((65 + a)::INT) WHEN round <= 702 THEN chr((65 + b // 26)::INT) || chr((65 + b % 26)::INT) WHEN round <= 18278 THEN chr((65 + c // 676)::INT) || chr((65 + c // 26 % 26)::INT) || chr((65 + c % 26)::INT)
  ELSE chr((65 + e // 17576)::INT) || chr((65 + e // 676 % 26)::INT) || chr((65 + e // 26 % 26)::INT) || chr((65 + e % 26)::INT) END AS name FROM z"""))
def w9_round_letters(spark: SparkSession, d: str) -> DataFrame:
    """The names of merge rounds, one round a map (W9): A to Z, AA, AB and so on."""
    from ..operators.hits import renumbered

    return renumbered(I.maps(spark, d).select("map_id").distinct(), [F.col("map_id")], "round").select("round", W.round_name(F.col("round")).alias("name"))
