"""Writers of map, alignment, molecule, sequence and table files.

Rows are sorted by range, so parts in order are one file in order; each part has the header, which
every reader here finds per file. ``one_file`` joins small outputs into one for other programs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.export import fasta_lines
from ..schemas import CMAP, XMAP

TYPE_NAMES = {"long": "int", "int": "int", "double": "float", "string": "string"}


def decimals(x: Column, places: int) -> Column:
    """Text with ``places`` decimals, half up by whole-number arithmetic: the same in every engine."""
    k = 10**places
    n = F.floor(F.abs(x) * k + 0.5).cast("long")
    body = F.concat((n / k).cast("decimal(38,0)").cast("string")) if places == 0 else F.concat(F.floor(n / k).cast("string"), F.lit("."), F.lpad((n % k).cast("string"), places, "0"))
    return F.when((x < 0) & (n > 0), F.concat(F.lit("-"), body)).otherwise(body)


def thousands(n: Column) -> Column:
    """1234567 as 1,234,567."""
    return F.format_number(n, 0)


def _write(rows: DataFrame, header: list[str], order: list[Column], line: Column, path: str, one_file: bool) -> None:
    """Each part opens with the header: its rows come through one iterator per part."""
    from collections.abc import Iterator

    import pandas as pd

    def headed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for pdf in batches:
            if first and len(pdf):
                yield pd.DataFrame({"value": header})
                first = False
            yield pdf

    parts = 1 if one_file else int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (rows.coalesce(1) if one_file else rows.repartitionByRange(parts, *order)).sortWithinPartitions(*order)
    ordered.select(line.alias("value")).mapInPandas(headed, "value string").write.mode("overwrite").text(path)


def write_cmap(cmap: DataFrame, path: str, channels: dict[int, str], n_maps: int, full_header: bool = True, least: int | None = None, most: int | None = None, one_file: bool = False) -> None:
    """Maps by id and site, kept by their number of sites if asked."""
    names = [c for c in CMAP if c in cmap.columns]
    if least is not None:
        cmap = cmap.filter(F.col("NumSites") >= least)
    if most is not None:
        cmap = cmap.filter(F.col("NumSites") <= most)
    head = ["# CMAP File Version:\t0.2", f"# Label Channels:\t{len(channels)}", *[f"# Nickase Recognition Site {k}:\t{m}" for k, m in channels.items()], f"# Number of Consensus Maps:\t{n_maps}"]
    header = (head if full_header else []) + ["#h " + "\t".join(names), "#f " + "\t".join(TYPE_NAMES[CMAP[c]] for c in names)]
    cells = [F.coalesce(decimals(F.col(c), 1) if CMAP[c] == "double" else F.col(c).cast("string"), F.lit("")) for c in names]
    _write(cmap, header, [F.col("CMapId"), F.col("SiteID")], F.concat_ws("\t", *cells), path, one_file)


def write_xmap(xmap: DataFrame, path: str, reference: str, queries: str, one_file: bool = False) -> None:
    names = [c for c in XMAP if c in xmap.columns]
    header = ["# XMAP File Version:\t0.2", f"# Reference Maps From:\t{reference}", f"# Query Maps From:\t{queries}", "#h " + "\t".join(names), "#f " + "\t".join(TYPE_NAMES[XMAP[c]] for c in names)]
    cells = [F.coalesce(decimals(F.col(c), 2 if c == "Confidence" else 1) if XMAP[c] == "double" else F.col(c).cast("string"), F.lit("")) for c in names]
    _write(xmap, header, [F.col("XmapEntryID")], F.concat_ws("\t", *cells), path, one_file)


def write_table(df: DataFrame, path: str, order: list[str], one_file: bool = False, mark: str = "") -> None:
    """A table with a header line: edges, glues, layouts, evidence, translations, conflicts, gaps, AGP, BED."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    _write(df, [mark + "\t".join(df.columns)], [F.col(c) for c in order], F.concat_ws("\t", *cells), path, one_file)


def write_fasta(sequences: DataFrame, path: str, width: int = 70) -> None:
    """name, seq as wrapped FASTA, split over parts by name; a record is in one part."""
    parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wrapped = fasta_lines(sequences.repartitionByRange(parts, "name").sortWithinPartitions("name"), width)
    wrapped.select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def write_bnx(bnx: DataFrame, path: str) -> None:
    """Molecules as records of their 0, 1, QX11 and QX12 lines."""
    fixed = lambda a, p: F.array_join(F.transform(a, lambda x: decimals(x, p)), "\t")
    zero = F.concat_ws("\t", F.lit("0"), F.col("molecule_id").cast("string"), decimals(F.col("length"), 2), F.lit("0.0"), F.lit("0.0"), F.col("n_labels").cast("string"))
    one = F.concat(F.lit("1\t"), fixed(F.concat("labels", F.array("length")), 2))
    quality = lambda tag, c: F.concat(F.lit(f"{tag}\t"), fixed(F.col(c), 4))
    bnx.select(F.concat_ws("\n", zero, one, quality("QX11", "snr"), quality("QX12", "intensity")).alias("value")).write.mode("overwrite").text(path)


def write_split_fasta(classed: DataFrame, path: str) -> None:
    """Sequences with ``class`` into one folder per class, in one pass."""
    classed.select("class", F.concat(F.lit(">"), "name", F.lit("\n"), "seq").alias("value")).write.mode("overwrite").partitionBy("class").text(path)


def round_letters(n: int) -> str:
    """Spreadsheet letters of a merge round, from 1: A to Z, AA, AB and so on."""
    out = ""
    while n > 0:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def round_name(n: Column) -> Column:
    """``round_letters`` of a column of numbers: digits of base 26 without a zero."""
    digits = F.aggregate(
        F.sequence(F.lit(1), F.lit(14)), F.struct(n.cast("long").alias("n"), F.lit("").alias("s")),
        lambda a, _: F.when(a["n"] <= 0, a).otherwise(F.struct(F.floor((a["n"] - 1) / 26).alias("n"), F.concat(F.char((a["n"] - 1) % 26 + 65), a["s"]).alias("s"))),
    )
    return digits["s"]


def fragments_xml(maps: DataFrame, hits: DataFrame) -> DataFrame:
    """Maps as fragments in kb and alignments as (index, left, right) triples, an XML element per row."""
    sizes = F.zip_with(F.concat("positions", F.array("length")), F.concat(F.array(F.lit(0.0)), "positions"), lambda a, b: decimals((a - b) / 1000, 3))
    m = maps.select(F.lit(0).alias("o"), F.col("CMapId").alias("id"), F.format_string('<RESTRICTION_MAP ID="%d"><FRAGMENTS>%s</FRAGMENTS></RESTRICTION_MAP>', "CMapId", F.array_join(sizes, " ")).alias("value"))
    triples = F.transform("pairs", lambda p, i: F.format_string("(%d,%d,%d)", i, p["ref"], p["qry"]))
    a = hits.select(F.lit(1).alias("o"), F.col("entry_id").alias("id"), F.format_string('<MAP_ALIGNMENT ID="%d" REFERENCE="%d" QUERY="%d">%s</MAP_ALIGNMENT>', "entry_id", "ref_id", "qry_id", F.array_join(triples, "")).alias("value"))
    return m.union(a)
