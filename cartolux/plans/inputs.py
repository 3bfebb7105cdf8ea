"""The relations that the reference queries start from: clean maps, labels, hits, glues, edges, sequences
and evidence over the given tables, as DataFrames and as the SQL that defines the same rows.

Places and lengths are whole tenths of a bp, confidences whole hundredths, so sums have one value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import salted_join, table


def _tenths(column: str) -> str:
    return f"CAST(round({column} * 10) AS BIGINT)"


_LABELS = ["map_set", "CMapId AS map_id", "SiteID AS site_id", "LabelChannel AS channel", f"{_tenths('Position')} AS pos", f"{_tenths('Coverage')} AS coverage", "CAST(round(ChimQuality * 100) AS BIGINT) AS quality"]
#: NaN is above every number and fails both.
_PLACED = "LabelChannel > 0 AND Position >= 0 AND Position < 9.2e17"
_STATED = "ContigLength < double('Infinity')"
_MAPS = ["map_set", "CMapId AS map_id"]
_HITS = [
    "aln_set", "XmapEntryID AS entry_id", "QryContigID AS qry_id", "RefContigID AS ref_id", f"{_tenths('QryStartPos')} AS qs", f"{_tenths('QryEndPos')} AS qe",
    f"{_tenths('RefStartPos')} AS rs", f"{_tenths('RefEndPos')} AS re", "Orientation AS ori", "CAST(round(Confidence * 100) AS BIGINT) AS conf",
    f"{_tenths('QryLen')} AS ql", f"{_tenths('RefLen')} AS rl", "LabelChannel AS channel", "HitEnum AS cigar", "Alignment AS pairs",
]
_HITS_WHERE = "QryContigID IS NOT NULL AND RefContigID IS NOT NULL AND QryStartPos IS NOT NULL AND QryEndPos IS NOT NULL AND RefStartPos IS NOT NULL AND RefEndPos >= RefStartPos AND QryLen IS NOT NULL AND RefLen IS NOT NULL AND Orientation IN ('+', '-') AND Confidence IS NOT NULL"
_SIDES = ("RefContigID", "RefLen", "Orientation", "Confidence", "QryStartPos", "QryEndPos", "RefStartPos", "RefEndPos")
_GLUES = ["ID AS glue_id", "QryContigID AS qry_id", f"{_tenths('QryLen')} AS ql", f"{_tenths('Overlap')} AS overlap"] + [
    (f"{c}_{s} AS {n}_{s}" if c in ("RefContigID", "Orientation") else f"{_tenths(f'{c}_{s}')} AS {n}_{s}")
    for s in "xy"
    for c, n in zip(_SIDES, ("ref", "rl", "ori", "conf", "qs", "qe", "rs", "re"))
]
_GLUES_WHERE = " AND ".join(f"{c}_{s} IS NOT NULL" for s in "xy" for c in _SIDES) + " AND ID IS NOT NULL AND QryContigID IS NOT NULL AND QryLen IS NOT NULL AND Overlap > 0"
_EDGES = ["least(id1, id2) AS a", "greatest(id1, id2) AS b", "overlap", "nglues"]
_EDGES_WHERE = "id1 IS NOT NULL AND id2 IS NOT NULL AND id1 <> id2"
#: Letters of a text as bases, for tables that hold no sequences.
_FROM = "BDEFHIJKLMNOPQRSUVWXYZbdefhijklmnopqrsuvwxyzacgt"
_TO = "ACGTACGTACGTACGTACGTAC" * 2 + "ACGT"


def labels(spark: SparkSession, d: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Labels at places up to the end of their map: its length by the row, or else by the map's other rows (as
    ``label_values`` of p6); where none states one, every place that tenths in a BIGINT can hold. ``by``: columns
    that the rows are shuffled by, so that grouping by them needs no other shuffle."""
    cmap = table(spark, d, "cmap")
    placed = cmap.filter(_PLACED)
    stated = placed.filter(f"{_STATED} AND Position <= ContigLength").selectExpr(*_LABELS)
    lengths = cmap.filter(_STATED).groupBy("CMapId").agg(F.max("ContigLength").alias("_length"))
    unstated = salted_join(placed.filter(f"NOT coalesce({_STATED}, false)"), lengths, ["CMapId"], [F.col("SiteID")], "left")
    rows = stated.unionByName(unstated.filter("_length IS NULL OR Position <= _length").selectExpr(*_LABELS))
    return (rows.repartition(*by) if by else rows).distinct()


def maps(spark: SparkSession, d: str) -> DataFrame:
    usable = table(spark, d, "cmap").filter("ContigLength > 0 AND ContigLength < 9.2e17 AND CMapId IS NOT NULL")
    return usable.selectExpr(*_MAPS, f"{_tenths('ContigLength')} AS len", "NumSites AS n").groupBy("map_set", "map_id").agg(F.max("len").alias("len"), F.max("n").alias("num_sites"))


def hits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "xmap").filter(_HITS_WHERE).selectExpr(*_HITS).distinct()


def glues(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "glues").filter(_GLUES_WHERE).selectExpr(*_GLUES).distinct()


def edges(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "edges").filter(_EDGES_WHERE).selectExpr(*_EDGES).groupBy("a", "b").agg(F.max(F.round(F.col("overlap") * 10).cast("long")).alias("weight"))


def sequences(spark: SparkSession, d: str) -> DataFrame:
    text = F.regexp_replace(F.translate("text", _FROM, _TO), "[^ACGT]", "N")
    return table(spark, d, "documents").filter("text IS NOT NULL AND text <> ''").select(F.col("doc_id").alias("seq_id"), text.alias("seq"))


def evidence(spark: SparkSession, d: str) -> DataFrame:
    """Evidence rows over the event table: two contigs, their ends, orientations, a molecule and a distance."""
    return table(spark, d, "events").selectExpr(
        "event_id AS no", "user_id % 20 AS ctg1", "user_id % 7 AS ctg2", "CASE WHEN event_type IN ('click', 'view') THEN '5' ELSE '3' END AS end1",
        "CASE WHEN event_id % 2 = 0 THEN '5' ELSE '3' END AS end2", "user_id AS mol", "CAST(event_id % 40 AS INT) AS minlabels", "CAST(floor(value * 100) AS BIGINT) AS distance",
        "CASE WHEN event_type IN ('click', 'purchase') THEN '+' ELSE '-' END AS ori1", "CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END AS ori2",
    )


CTES = {
    "labels": f"lens AS (SELECT CMapId, max(ContigLength) AS _length FROM cmap WHERE isfinite(ContigLength) GROUP BY 1), labels AS (SELECT DISTINCT {', '.join(_LABELS)} FROM cmap LEFT JOIN lens USING (CMapId) WHERE LabelChannel > 0 AND isfinite(Position) AND Position >= 0 AND Position < 9.2e17 AND (CASE WHEN isfinite(ContigLength) THEN Position <= ContigLength ELSE _length IS NULL OR Position <= _length END))",
    "maps": f"maps AS (SELECT map_set, CMapId AS map_id, max({_tenths('ContigLength')}) AS len, max(NumSites) AS num_sites FROM cmap WHERE ContigLength > 0 AND ContigLength < 9.2e17 AND CMapId IS NOT NULL GROUP BY 1, 2)",
    "hits": f"hits AS (SELECT DISTINCT {', '.join(_HITS)} FROM xmap WHERE {_HITS_WHERE})",
    "gl": f"gl AS (SELECT DISTINCT {', '.join(_GLUES)} FROM glues WHERE {_GLUES_WHERE})",
    "ed": f"ed AS (SELECT a, b, max(CAST(round(overlap * 10) AS BIGINT)) AS weight FROM (SELECT {', '.join(_EDGES)} FROM edges WHERE {_EDGES_WHERE}) GROUP BY 1, 2)",
    "seqs": f"seqs AS (SELECT doc_id AS seq_id, regexp_replace(translate(text, '{_FROM}', '{_TO}'), '[^ACGT]', 'N', 'g') AS seq FROM documents WHERE text IS NOT NULL AND text <> '')",
    "evid": "evid AS (SELECT event_id AS no, user_id % 20 AS ctg1, user_id % 7 AS ctg2, CASE WHEN event_type IN ('click', 'view') THEN '5' ELSE '3' END AS end1, CASE WHEN event_id % 2 = 0 THEN '5' ELSE '3' END AS end2, user_id AS mol, CAST(event_id % 40 AS INT) AS minlabels, CAST(floor(value * 100) AS BIGINT) AS distance, CASE WHEN event_type IN ('click', 'purchase') THEN '+' ELSE '-' END AS ori1, CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END AS ori2 FROM events)",
}


def sql(names: str, body: str) -> str:
    """A query over the named relations; ``body`` may begin with more relations."""
    return "WITH " + ", ".join(CTES[n] for n in names.split()) + ("" if body.lstrip().startswith("SELECT") else ", ") + " " + body.strip()
