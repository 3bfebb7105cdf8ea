"""Command line: ``python -m cartolux PROGRAM [options]``. Each program reads files, runs operators and
writes a folder of parts."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .functions.sequence import ENZYMES, digested
from .operators import hits as H
from .operators import maps as M
from .operators import intervals, prefix
from .runtime import session
from .sinks import text as W
from .sources import text as R


def tenths(c: str):
    return F.round(F.col(c) * 10).cast("long")


def stats(spark, a):
    m = R.read_cmap(spark, a.input).groupBy("file", "CMapId").agg(F.max(tenths("ContigLength")).alias("len"))
    g = m.groupBy("file").agg(F.count("*").alias("n"), F.min("len").alias("min"), F.max("len").alias("max"), F.sum("len").alias("total"))
    out = g.join(prefix.nx(m, ["file"], "len", {"n50": 0.5, "n90": 0.9}), "file").join(prefix.median(m, ["file"], "len"), "file")
    W.write_table(out, a.output, ["file"], one_file=True)


def coverage(spark, a):
    x = R.read_xmap(spark, a.input)
    named = intervals.spans(x, ["RefContigID"], "RefStartPos", "RefEndPos", "QryLen")
    covered = intervals.sweep(named, ["RefContigID"]).filter("kind = 'period'").groupBy("RefContigID").agg(F.sum(F.col("end") - F.col("start")).alias("covered"))
    lengths = R.read_cmap(spark, a.maps).groupBy(F.col("CMapId").alias("RefContigID")).agg(F.max(tenths("ContigLength")).alias("len"))
    out = lengths.join(covered, "RefContigID", "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    W.write_table(out.withColumn("percent", W.decimals(F.col("covered") * 100 / F.col("len"), 2)), a.output, ["RefContigID"], one_file=True)


def digest(spark, a):
    named = R.read_fasta(spark, a.input, upper=True)
    numbered = H.renumbered(named, [F.col("name")], "seq_id")
    motifs = {i: [ENZYMES.get(e.upper(), e.upper())] for i, e in enumerate(a.enzyme, 1)}
    sites = digested(numbered.select("seq_id", "seq"), motifs)
    n = sites.groupBy("seq_id").agg(F.count("*").alias("NumSites")).filter(F.col("NumSites") >= a.min_labels)
    lengths = numbered.select("seq_id", F.length("seq").cast("double").alias("ContigLength")).filter(F.col("ContigLength") >= a.min_length * 1000).join(n, "seq_id")
    terminal = lengths.select("seq_id", F.col("ContigLength").cast("long").alias("site"), F.lit(0).alias("channel"))
    rows = sites.unionByName(terminal).join(lengths, "seq_id")
    from pyspark.sql import Window

    w = Window.partitionBy("seq_id").orderBy((F.col("channel") == 0), "site", "channel")
    cmap = rows.select(
        F.col("seq_id").alias("CMapId"), "ContigLength", F.col("NumSites").cast("int"), F.row_number().over(w).alias("SiteID"), F.col("channel").alias("LabelChannel"),
        F.col("site").cast("double").alias("Position"), F.lit(1.0).alias("StdDev"), F.lit(1.0).alias("Coverage"), F.lit(1.0).alias("Occurrence"),
    )
    W.write_cmap(cmap, a.output, {k: ",".join(m) for k, m in motifs.items()}, lengths.count())
    W.write_table(numbered.select(F.col("seq_id").alias("CompntId"), F.col("name").alias("CompntName"), F.length("seq").alias("CompntLength")), a.output + ".key", ["CompntId"])


def select_maps(spark, a):
    c = R.read_cmap(spark, a.input)
    ids = R.read_ids(spark, a.ids).select(F.col("id").alias("CMapId")).distinct()
    kept = c.join(ids, "CMapId", "left_anti" if a.exclude else "left_semi").drop("file")
    W.write_cmap(kept, a.output, {}, kept.select("CMapId").distinct().count(), full_header=False)


def unify(spark, a):
    c = R.read_cmap(spark, a.input).drop("file").withColumn("channel", F.col("LabelChannel"))
    one = M.unified(c).withColumn("LabelChannel", F.col("channel")).drop("channel")
    W.write_cmap(one, a.output, {1: "N"}, one.select("CMapId").distinct().count())


PROGRAMS = {"stats": stats, "coverage": coverage, "digest": digest, "select": select_maps, "unify": unify}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cartolux")
    p.add_argument("program", choices=PROGRAMS)
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--maps", help="maps of the references (coverage)")
    p.add_argument("--ids", help="list of ids (select)")
    p.add_argument("--exclude", action="store_true")
    p.add_argument("-e", "--enzyme", nargs="+", default=[], help="names or motifs, one per channel (digest)")
    p.add_argument("-m", "--min-labels", type=int, default=0)
    p.add_argument("-M", "--min-length", type=float, default=0, help="kb")
    a = p.parse_args(argv)
    PROGRAMS[a.program](session("cartolux"), a)


if __name__ == "__main__":
    main()
