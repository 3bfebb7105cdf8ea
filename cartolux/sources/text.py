"""Readers of map, alignment, molecule, sequence and table files.

Files are read as distributed text. A header belongs to its own file: it is found per file, never
assumed to be that of another. Rows keep ``file`` so that files of several enzymes stay apart.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import salted_join
from ..schemas import FORMATS, spellings


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line of text files, carriage returns removed."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\r$", "").alias("line"))


def headers(text: DataFrame) -> DataFrame:
    """One row per file: columns (array), types (array), channels (map of number to motif), version."""
    h = text.filter(F.col("line").startswith("#"))
    cells = lambda tag: F.max(F.when(F.col("line").rlike(f"^#{tag}[ \t]"), F.split(F.regexp_replace("line", f"^#{tag}[ \t]+", ""), "[ \t]+")))
    site = F.regexp_extract("line", r"Recognition Site (\d+):\s*([^;\s]+)", 1)
    motif = F.upper(F.regexp_extract("line", r"Recognition Site (\d+):\s*([^;\s]+)", 2))
    return h.groupBy("file").agg(
        cells("h").alias("columns"), cells("f").alias("types"),
        F.map_from_entries(F.array_sort(F.collect_set(F.when(site != "", F.struct(site.cast("int"), motif))))).alias("channels"),
        F.max(F.nullif(F.regexp_extract("line", r"File Version:\s*(\S+)", 1), F.lit(""))).alias("version"),
        F.max(F.nullif(F.regexp_extract("line", r"Label Channels:\s*(\d+)", 1), F.lit(""))).cast("int").alias("n_channels"),
    )


def _typed(cell: Column, kind: str) -> Column:
    if kind == "string":
        return cell
    if kind in ("int", "long"):
        return F.coalesce(cell.try_cast("long"), cell.try_cast("double").cast("long")).cast(kind)
    return cell.try_cast(kind)


def _records(spark: SparkSession, path: str | list[str], kind: str, keep: int | None = None) -> DataFrame:
    text = lines(spark, path)
    names = spellings(kind)
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    heads = headers(text).filter("columns IS NOT NULL")
    if keep:
        heads = heads.withColumn("columns", F.slice("columns", 1, keep))
    place = F.map_from_entries(F.array_distinct(F.transform("columns", lambda c, i: F.struct(F.coalesce(known[F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))], c), i))))
    heads = heads.select("file", place.alias("place"))
    data = text.filter(~F.col("line").startswith("#") & (F.trim("line") != "")).select("file", F.split("line", "\t").alias("cells"))
    both = salted_join(data, heads, ["file"], [F.col("cells")])  # one row per input file: broadcast while that is small
    return both.select("file", *[_typed(F.get("cells", F.element_at("place", F.lit(c))), t).alias(c) for c, t in FORMATS[kind].items()])


def read_cmap(spark: SparkSession, path: str | list[str], limited: bool = False) -> DataFrame:
    """Labels and terminal rows of map files, in the layout of ``schemas.CMAP``; columns a file lacks are
    null. ``limited`` keeps the first nine columns of each file only, ten with chimera quality."""
    return _records(spark, path, "CMAP", 10 if limited else None)


def read_xmap(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _records(spark, path, "XMAP")


def channel_mismatches(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files whose number of recognition sites is not their number of channels."""
    return headers(lines(spark, path)).filter(F.size("channels") != F.col("n_channels")).select("file", "n_channels", "channels")


def packed(cmap: DataFrame, least: int = 0) -> DataFrame:
    """One row per map: CMapId, length, positions in order, without the terminal row."""
    labels = cmap.filter("LabelChannel > 0").groupBy("CMapId").agg(F.max("ContigLength").alias("length"), F.transform(F.array_sort(F.collect_list(F.struct("Position", "LabelChannel"))), lambda x: x["Position"]).alias("positions"))
    return labels.filter(F.size("positions") >= least)


def read_bnx(spark: SparkSession, path: str | list[str], least: int = 30) -> DataFrame:
    """Molecules with at least ``least`` labels: molecule_id, length, n_labels, labels, snr, intensity. A record
    starts at its ``0`` line; files are split at those, so records stay whole."""
    return molecule_rows(spark.read.option("lineSep", "\n0\t").text(path), least)


def molecule_rows(records: DataFrame, least: int) -> DataFrame:
    """The molecules of records (value) as split at their ``0`` lines."""
    records = records.select(F.regexp_replace(F.concat(F.lit("\n"), "value"), r"\r", "").alias("r"))

    def row(tag: str) -> Column:
        return F.split(F.regexp_extract("r", rf"\n{tag}\t([^\n]*)", 1), "\t")

    doubles = lambda c: F.filter(F.transform(c, lambda x: x.try_cast("double")), lambda x: x.isNotNull())
    info = F.split(F.regexp_extract("r", r"^\n(?:#[^\n]*\n)*(?:0\t)?([^\n]*)", 1), "\t")
    all_labels = doubles(row("1"))
    out = records.filter(F.col("r").rlike(r"\n1\t")).select(
        F.get(info, F.lit(0)).try_cast("long").alias("molecule_id"), F.get(info, F.lit(1)).try_cast("double").alias("length"), F.get(info, F.lit(4)).try_cast("int").alias("n_labels"),
        F.slice(all_labels, 1, F.greatest(F.size(all_labels) - 1, F.lit(0))).alias("labels"), doubles(row("QX11")).alias("snr"), doubles(row("QX12")).alias("intensity"),
    )
    return out.filter((F.col("n_labels") >= least) & (F.size("labels") == F.col("n_labels")))


def rescaled_molecules(bnx: DataFrame, bpp: float) -> DataFrame:
    """Lengths and labels times bpp/500, to two decimals."""
    scale = lambda x: F.floor(x * (bpp / 500) * 100 + 0.5) / 100
    return bnx.withColumn("length", scale(F.col("length"))).withColumn("labels", F.transform("labels", scale))


def read_fasta(spark: SparkSession, path: str | list[str], upper: bool = False) -> DataFrame:
    """name (first word of the header), description, seq with line breaks removed."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("r")).filter(F.trim("r") != "")
    head = F.regexp_extract("r", r"^([^\n]*)", 1)
    seq = F.regexp_replace(F.regexp_extract("r", r"^[^\n]*\n([\s\S]*)$", 1), r"\s", "")
    return records.select(F.regexp_extract(head, r"^(\S*)", 1).alias("name"), F.trim(F.regexp_extract(head, r"^\S*(.*?)\r?$", 1)).alias("description"), (F.upper(seq) if upper else seq).alias("seq"))


def read_table(spark: SparkSession, path: str | list[str], required: dict[str, str], sep: str = "\t") -> DataFrame:
    """A table with a header line (a leading ``#`` is dropped) that must have the ``required`` columns; rows of
    another width are dropped. Other columns stay as text."""
    text = lines(spark, path).filter(F.trim("line") != "")
    first = text.filter(~F.col("line").rlike("^#[^A-Za-z]")).limit(1).collect()  # one line
    names = [c.strip().lstrip("#").strip() for c in first[0]["line"].split(sep)] if first else []
    lacking = [c for c in required if c not in names]
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    head = first[0]["line"]
    cells = F.split("line", sep, -1)
    rows = text.filter((F.col("line") != head) & ~F.col("line").startswith("#")).filter(F.size(cells) == len(names))
    return rows.select(*[_typed(F.get(cells, F.lit(i)), required.get(c, "string")).alias(c) for i, c in enumerate(names)])


KEY = {"CompntId": "long", "CompntName": "string", "CompntLength": "long"}
TRANSLATION = {"oldId": "long", "oldStart": "long", "oldEnd": "long", "newId": "long", "newStart": "long", "newEnd": "long"}
EDGE = {"id_str": "string", "nglues": "int", "overlap": "double", "intercept": "double", "slope": "double", "type1": "int", "id1": "long", "length1": "double", "type2": "int", "id2": "long", "length2": "double", "glues": "string"}
LAYOUT = {"path_id": "long", "node_id": "long", "ori_id": "long", "type": "int", "start": "double", "end": "double", "dir": "string", "xstart": "double", "xend": "double", "xlength": "double"}
EVIDENCE = {"no": "long", "ctg1": "long", "ctg2": "long", "end1": "string", "end2": "string", "mol": "long", "minlabels": "int", "channel": "int", "distance": "double"}


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, KEY)


def ids_in_names(keys: DataFrame) -> DataFrame:
    """Ids written inside names, as the last but one part between bars."""
    return keys.withColumn("name_id", F.try_element_at(F.split("CompntName", r"\|"), F.lit(-2)).try_cast("long"))


def read_translation(spark: SparkSession, path: str) -> DataFrame:
    """Coordinate translation rows; raises if segments are not ascending and contiguous."""
    t = read_table(spark, path, TRANSLATION)
    w = Window.partitionBy("oldId").orderBy("oldStart", "newId")
    gap = t.withColumn("prev", F.lag("oldEnd").over(w)).filter((F.col("oldStart") >= F.col("oldEnd")) | (F.col("prev") + 1 != F.col("oldStart")))
    if not gap.isEmpty():
        raise ValueError("segments are not contiguous")
    return t


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a list; lines that are not digits are passed over."""
    return spark.read.text(path).select(F.trim("value").alias("v")).filter(F.col("v").rlike(r"^\d+$")).select(F.col("v").cast("long").alias("id"))


def read_stage_config(path: str) -> dict[str, dict[str, list[str]]]:
    """Parameters of stages from an XML file: section -> flag -> values; every ``include`` names a section
    whose flags come first."""
    root = ET.parse(path).getroot()
    own = {s.tag: {f.get("attr"): [f.get(f"val{i}") for i in range(len(f.attrib)) if f.get(f"val{i}") is not None] for f in s.iter("flag")} for s in root}
    return {s.tag: {**{k: v for inc in s.iter("include") for k, v in own.get(inc.get("val0"), {}).items()}, **own[s.tag]} for s in root}


def motif_of(path: str) -> str | None:
    """Motif of the first recognition site of a map file's header."""
    with Path(path).open() as f:
        for line in f:
            if not line.startswith("#"):
                return None
            if "Recognition Site" in line:
                return line.split(":", 1)[1].strip().split(";")[0].upper()
    return None


def checked_motifs(motifs: dict[str, str], known: dict[str, str]) -> list[str]:
    """Enzymes of the files in registry order; unknown and repeated motifs are errors."""
    by_motif = {m: e for e, m in known.items()}
    unknown = [f for f, m in motifs.items() if m not in by_motif]
    if unknown:
        raise ValueError(f"unknown motif in {', '.join(unknown)}")
    found = [by_motif[m] for m in motifs.values()]
    if len(set(found)) < len(found):
        raise ValueError("an enzyme appears twice")
    return [e for e in known if e in found]
