"""Sequence functions: reverse complement, motifs, digestion of tiled sequences, gaps of N.

A chromosome does not fit one cell, so sequences are cut into tiles that overlap by the longest motif
less one base; each site is found in the tile in which it starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Nicking and labelling enzymes in their order, and their motifs.
ENZYMES = {
    "BSPQI": "GCTCTTC", "BSSSI": "CACGAG", "BBVCI": "CCTCAGC", "BSMI": "GAATGC", "BSRDI": "GCAATG", "BSECI": "ATCGAT", "BAMHI": "GGATCC", "DLE1": "CTTAAG",
}
_COMPLEMENT = str.maketrans("ACGTacgt", "TGCAtgca")
TILE = 1 << 20


def reverse_complement(seq: str) -> str:
    return seq[::-1].translate(_COMPLEMENT)


def reverse_complement_column(seq: Column) -> Column:
    """Case preserving; letters other than bases stay."""
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def subsequence(seq: Column, start: Column, length: Column, strand: Column) -> Column:
    piece = F.substring(seq, start, length)
    return F.when(strand == "-", reverse_complement_column(piece)).otherwise(piece)


def occurrences(seq: str, motif: str) -> list[int]:
    """1-based starts of all occurrences, overlapping ones too."""
    out, at = [], seq.find(motif)
    while at >= 0:
        out.append(at + 1)
        at = seq.find(motif, at + 1)
    return out


def sites(seq: str, motifs: dict[int, list[str]], limit: int | None = None) -> list[tuple[int, int]]:
    """(site, channel) of the motifs and their reverse complements, each once, in order; starts beyond
    ``limit`` belong to the next tile."""
    seq = seq.upper()
    found = {(at, channel) for channel, names in motifs.items() for m in names for form in {m, reverse_complement(m)} for at in occurrences(seq, form)}
    return sorted(x for x in found if limit is None or x[0] <= limit)


def tiled(sequences: DataFrame, overlap: int, tile: int = TILE) -> DataFrame:
    """seq_id, tile_no, shift, seq of each tile, with ``overlap`` more bases than ``tile``."""
    n = F.greatest(F.ceil(F.length("seq") / tile), F.lit(1))
    cut = sequences.select("seq_id", "seq", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("tile_no"))
    start = F.col("tile_no") * tile
    return cut.select("seq_id", "tile_no", start.alias("shift"), F.substring("seq", (start + 1).cast("int"), F.lit(tile + overlap)).alias("seq"))


def digested(sequences: DataFrame, motifs: dict[int, list[str]], tile: int = TILE) -> DataFrame:
    """seq_id, site (1-based), channel of every label of the sequences."""
    overlap = max(len(m) for names in motifs.values() for m in names) - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, shift + at, c) for i, shift, seq in zip(pdf["seq_id"], pdf["shift"], pdf["seq"]) for at, c in sites(seq, motifs, tile)]
            yield pd.DataFrame(rows, columns=["seq_id", "site", "channel"])

    return tiled(sequences, overlap, tile).select("seq_id", "shift", "seq").mapInPandas(run, "seq_id long, site long, channel int")


def n_gaps(sequences: DataFrame, least: int) -> DataFrame:
    """Runs of N of at least ``least`` bases, 0-based half-open. A sequence is read whole where it lies."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        for pdf in batches:
            rows = [(i, m.start(), m.end()) for i, seq in zip(pdf["seq_id"], pdf["seq"]) for m in re.finditer(r"[Nn]{%d,}" % least, seq)]
            yield pd.DataFrame(rows, columns=["seq_id", "start", "end"])

    return sequences.select("seq_id", "seq").mapInPandas(run, "seq_id long, start long, end long")


def composition(seq: Column) -> dict[str, Column]:
    up = F.upper(seq)
    return {base: F.length(up) - F.length(F.replace(up, F.lit(base))) for base in "ACGTN"}
