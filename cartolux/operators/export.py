"""Scaffold export: gaps, AGP, trimmed ends, multi-channel regions and sequences."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement_column
from ..runtime import salted_join
from .hits import extended, outermost
from .prefix import running_max

PAD, LEAST = 13, 23
GAPS = "entry_id long, ref_id long, qry_id long, prev_qry long, gap long, adjusted_gap long, embedded boolean"


def _walk(pdf: pd.DataFrame, unit: int) -> pd.DataFrame:
    """The gaps of one scaffold in order: a query that lies wholly inside what the current one covers is
    embedded and does not become the current one."""
    pdf = pdf.sort_values(["rs", "re", "entry_id"], ascending=[True, False, True])
    out, cur = [], None
    for row in pdf.itertuples(index=False):
        if cur is None:
            out.append((row.entry_id, row.ref_id, row.qry_id, None, None, None, False))
            cur = row
            continue
        gap = row.rs - cur.re - unit
        adjusted = row.ext_start - cur.ext_end - unit
        inside = -adjusted > row.ql
        out.append((row.entry_id, row.ref_id, row.qry_id, cur.qry_id, gap, adjusted, inside))
        cur = cur if inside else row
    frame = pd.DataFrame(out, columns=["entry_id", "ref_id", "qry_id", "prev_qry", "gap", "adjusted_gap", "embedded"])
    return frame.astype({"prev_qry": "Int64", "gap": "Int64", "adjusted_gap": "Int64"})


def scaffold_gaps(hits: DataFrame, unit: int = 1) -> DataFrame:
    """GAPS of every hit against the current one of its scaffold.

    Which hit is current depends on those before it, which no window expresses. But a hit that reaches, from its
    extended start on and with its whole length, as far as any hit before it cannot be embedded in any of
    them: it becomes the current one whatever went before. Such hits cut a scaffold into stretches that are
    walked apart in Arrow groups; the last current hit of a stretch is then carried to the first of the next."""
    order = ["rs", F.desc("re"), "entry_id"]
    wide = extended(hits).select("entry_id", "ref_id", "qry_id", "rs", "re", "ql", "ext_start", "ext_end")
    reach = running_max(wide, ["ref_id"], order, "rs", F.col("ext_end"), "_reach", own=False)
    place = F.struct("rs", (-F.col("re")).alias("re"), "entry_id")
    free = F.col("_reach").isNull() | (F.col("ext_start") + F.col("ql") - unit >= F.col("_reach"))
    cut = running_max(reach, ["ref_id"], order, "rs", F.when(free, place), "_cut", own=True).drop("_reach")
    walked = cut.groupBy("ref_id", "_cut").applyInPandas(lambda keys, pdf: _walk(pdf.drop(columns="_cut"), unit).assign(first=lambda x: x["prev_qry"].isna()), GAPS + ", first boolean")
    rows = walked.join(cut.select("entry_id", "ref_id", "rs", "re", "ext_start", "ext_end", "_cut"), ["entry_id", "ref_id"])
    last = rows.filter("NOT embedded").groupBy("ref_id", "_cut").agg(F.max_by(F.struct("qry_id", "re", "ext_end"), place).alias("_last"))
    last = last.withColumn("_prev", F.lag("_last").over(Window.partitionBy("ref_id").orderBy("_cut"))).drop("_last")  # one row per stretch
    both = rows.join(last, ["ref_id", "_cut"])
    carried = {"prev_qry": F.col("_prev.qry_id"), "gap": F.col("rs") - F.col("_prev.re") - unit, "adjusted_gap": F.col("ext_start") - F.col("_prev.ext_end") - unit}
    return both.select("entry_id", "ref_id", "qry_id", *[F.when(F.col("first"), v).otherwise(F.col(c)).alias(c) for c, v in carried.items()], "embedded")


def padded(gap):
    """The gap written to an AGP: a pad for overlaps, a least size for short gaps."""
    return F.when(gap < 0, PAD).when(gap < LEAST, LEAST).otherwise(gap)


def agp(hits: DataFrame, gaps: DataFrame, names: DataFrame) -> DataFrame:
    """AGP 2.0 rows: object, object_beg, object_end, part, kind, component or gap length, component_beg,
    component_end, orientation. Lengths of hits are whole bp."""
    order = Window.partitionBy("ref_id").orderBy("rs", F.desc("re"), "entry_id")
    kept = hits.join(gaps.filter("NOT embedded").select("entry_id", "adjusted_gap"), "entry_id")
    kept = salted_join(kept, names.select(F.col("id").alias("qry_id"), "name"), ["qry_id"], [F.col("entry_id")], "left")
    kept = kept.withColumn("gap", F.when(F.col("adjusted_gap").isNotNull(), padded(F.col("adjusted_gap"))).otherwise(0)).withColumn("no", F.row_number().over(order))
    before = F.sum(F.col("gap") + F.col("ql")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    kept = kept.withColumn("stop", before).withColumn("start", F.col("stop") - F.col("ql") + 1)
    component = F.struct(
        F.col("start").alias("object_beg"), F.col("stop").alias("object_end"), (2 * F.col("no") - 1).alias("part"), F.lit("W").alias("kind"),
        F.coalesce("name", F.col("qry_id").cast("string")).alias("component"), F.lit("1").alias("component_beg"), F.col("ql").cast("string").alias("component_end"), F.col("ori").alias("orientation"),
    )
    gap = F.struct(
        (F.col("start") - F.col("gap")).alias("object_beg"), (F.col("start") - 1).alias("object_end"), (2 * F.col("no") - 2).alias("part"), F.lit("N").alias("kind"),
        F.col("gap").cast("string").alias("component"), F.lit("scaffold").alias("component_beg"), F.lit("yes").alias("component_end"), F.lit("map").alias("orientation"),
    )
    rows = F.when(F.col("gap") > 0, F.array(gap, component)).otherwise(F.array(component))
    return kept.select(F.concat(F.lit("Super-Scaffold_"), "ref_id").alias("object"), F.explode(rows).alias("r")).select("object", "r.*")


def gap_report(gaps: DataFrame, hits: DataFrame, names: DataFrame) -> DataFrame:
    """Name of both queries, scaffold, gaps and lengths of each pair of neighbours; the last row of each
    scaffold repeats its last query with gaps of zero."""
    lengths = hits.groupBy("ref_id", "qry_id").agg(F.max("ql").alias("ql"))
    named = salted_join(lengths, names.select(F.col("id").alias("qry_id"), "name"), ["qry_id"], [F.col("ref_id")], "left").withColumn("name", F.coalesce("name", F.col("qry_id").cast("string")))
    two = named.select("ref_id", F.col("qry_id").alias("prev_qry"), F.col("name").alias("name1"), F.col("ql").alias("len1"))
    one = named.withColumnsRenamed({"name": "name2", "ql": "len2"})
    pairs = gaps.filter("prev_qry IS NOT NULL").join(two, ["ref_id", "prev_qry"]).join(one, ["ref_id", "qry_id"])
    last = gaps.filter("NOT embedded").join(hits.select("entry_id", "rs"), "entry_id").groupBy("ref_id").agg(F.max_by("qry_id", F.struct("rs", "entry_id")).alias("qry_id"))
    ends = last.join(one, ["ref_id", "qry_id"])
    return pairs.select("name1", "name2", "ref_id", "gap", "adjusted_gap", "len1", "len2").union(
        ends.select(F.col("name2").alias("name1"), "name2", "ref_id", F.lit(0).cast("long"), F.lit(0).cast("long"), F.col("len2").alias("len1"), "len2")
    )


def trimmed_ends(hits: DataFrame) -> DataFrame:
    """Reference bases before the first and after the last hit of each scaffold."""
    return hits.groupBy("ref_id").agg((F.min("rs") - 1).alias("begin_gap"), (F.max("rl") - F.max("re")).alias("end_gap"))


def channel_regions(hits: DataFrame, tail: int) -> DataFrame:
    """Regions of scaffolds from the hits of several channels: per channel the hits not embedded, put in one
    order by start (the longer first), those embedded over channels removed, borders at the middle of
    gaps and overlaps, the last one ending no more than ``tail`` beyond its hit."""
    single = outermost(hits, ["ref_id", "channel"])
    merged = outermost(single, ["ref_id"])
    w = Window.partitionBy("ref_id").orderBy("rs", F.desc("re"), "entry_id")
    prev, nxt = F.lag("re").over(w), F.lead("rs").over(w)
    start = F.when(prev.isNull(), F.col("rs")).otherwise(F.floor((prev + F.col("rs")) / 2) + 1)
    stop = F.when(nxt.isNull(), F.least(F.col("re") + tail, F.col("rl"))).otherwise(F.floor((F.col("re") + nxt) / 2))
    return merged.select("ref_id", "channel", "entry_id", "qry_id", "ori", start.alias("region_start"), stop.alias("region_end"), F.row_number().over(w).alias("no"))


def gap_sequence(length: int, sites: list[int], motif: str) -> str:
    """A gap of N with the motif written where the map has labels (1-based)."""
    text = ["N"] * length
    for s in sites:
        if 1 <= s and s + len(motif) - 1 <= length:
            text[s - 1 : s - 1 + len(motif)] = motif
    return "".join(text)


def scaffold_sequences(agp_rows: DataFrame, sequences: DataFrame) -> DataFrame:
    """object, part, piece: the sequence of each AGP row in its orientation. Rows are pieces, in order by
    (object, part), so a chromosome never has to fit one cell; the FASTA writer joins them."""
    parts = agp_rows.filter("kind = 'W'").select("object", "part", F.col("component").alias("name"), "orientation")
    w = salted_join(parts, sequences.select("name", "seq"), ["name"], [F.col("object"), F.col("part")])
    w = w.select("object", "part", F.when(F.col("orientation") == "-", reverse_complement_column(F.col("seq"))).otherwise(F.col("seq")).alias("piece"))
    n = agp_rows.filter("kind = 'N'").select("object", "part", F.repeat(F.lit("N"), F.col("component").cast("int")).alias("piece"))
    return w.union(n)


def split_by_use(sequences: DataFrame, used: DataFrame, small: int, large: int) -> DataFrame:
    """Sequences with ``class`` small, fit or large and whether they are in ``used`` (name)."""
    flagged = sequences.join(used.select("name").distinct().withColumn("used", F.lit(True)), "name", "left")
    size = F.length("seq")
    return flagged.withColumn("class", F.when(size < small, "small").when(size > large, "large").otherwise("fit")).withColumn("used", F.coalesce("used", F.lit(False)))


def fasta_lines(sequences: DataFrame, width: int = 70) -> DataFrame:
    """name, line_no, line: wrapped FASTA, generated where the rows lie."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, seq in zip(pdf["name"], pdf["seq"]):
                rows.append((name, 0, f">{name}"))
                rows += [(name, i // width + 1, seq[i : i + width]) for i in range(0, len(seq), width)]
            yield pd.DataFrame(rows, columns=["name", "line_no", "line"])

    return sequences.select("name", "seq").mapInPandas(run, "name string, line_no long, line string")
