"""Rows that fail to parse: typed rows and rejected rows with the reason and its place.

The records go through the finite-state tokenizer in Arrow batches; all that follows (field count,
values, casts) are built-in expressions. Nothing is shuffled but the rejected rows.

Cases. A trailing carriage return is no content. Null lines, lines that start with ``#`` and lines
of blanks and tabs only are no rows. Blanks around values are ignored, other white space is not.
Repeated rows stay repeated among the valid and are reported once among the rejected. ``offset`` is
the character at which quoting breaks, else -1. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokenizer import tokenize
from ..schemas import CONFLICT

COLUMNS = list(CONFLICT)
IDS, BREAKS, ORIENTATIONS = ("xId", "refId", "qryId"), ("refLeftBkpt", "refRightBkpt", "qryLeftBkpt", "qryRightBkpt"), ("refOrientation", "qryOrientation")
BREAK_STATES, STATES = ("refLeftBkptStatus", "refRightBkptStatus", "qryLeftBkptStatus", "qryRightBkptStatus"), ("refStatus", "qryStatus")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fields, offsets = tokenize(batch.column("line").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("file_id"), batch.column("line_no"), pa.array(fields, pa.list_(pa.string())), pa.array(offsets, pa.int32())],
            names=["file_id", "line_no", "fields", "offset"],
        )


def tokenized(lines: DataFrame) -> DataFrame:
    line = F.regexp_replace("line", r"\r\z", "")
    rows = lines.select("file_id", "line_no", line.alias("line")).filter(~F.col("line").startswith("#") & ~F.col("line").rlike(r"\A[ \t]*\z"))
    kinds = dict(lines.dtypes)
    return rows.mapInArrow(_tokens, f"file_id {kinds['file_id']}, line_no {kinds['line_no']}, fields array<string>, offset int")


def judged(lines: DataFrame) -> DataFrame:
    """Every row with its trimmed values and ``reason`` (null if valid)."""
    read = tokenized(lines)
    value = {c: F.trim(F.get("fields", F.lit(i))) for i, c in enumerate(COLUMNS)}

    def all_match(columns: tuple[str, ...], pattern: str) -> Column:
        tests = [value[c].rlike(pattern) for c in columns]
        return F.when(F.array_contains(F.array(*tests), False), False).otherwise(True)

    reason = (
        F.when(F.col("fields").isNull(), "quoting")
        .when(F.size("fields") != len(COLUMNS), "columns")
        .when(~all_match(IDS, r"\A([0-9]+|-1)\z"), "bad_id")
        .when(~all_match(BREAKS, r"\A([0-9]+(\.[0-9]*)?|-1)\z"), "bad_bkpt")
        .when(~all_match(ORIENTATIONS, r"\A[+-]\z"), "bad_orientation")
        .when(~(all_match(BREAK_STATES, r"\A((?i:okay|cut)|-)\z") & all_match(STATES, r"\A((?i:okay|exclude)|-)\z")), "bad_status")
    )
    return read.select("file_id", "line_no", "fields", "offset", reason.alias("reason"))


def rejected(lines: DataFrame) -> DataFrame:
    """(file_id, line_no, reason, offset), distinct."""
    return judged(lines).filter(F.col("reason").isNotNull()).select("file_id", "line_no", "reason", "offset").distinct()


def accepted(lines: DataFrame) -> DataFrame:
    """The valid rows, typed; statuses in lower case. Ids too long for a 64-bit integer become null."""
    rows = judged(lines).filter(F.col("reason").isNull())

    def typed(i: int, name: str) -> Column:
        text = F.trim(F.get("fields", F.lit(i)))
        text = F.lower(text) if name in BREAK_STATES + STATES else text
        return (text.try_cast(CONFLICT[name]) if CONFLICT[name] != "string" else text).alias(name)

    return rows.select("file_id", "line_no", *[typed(i, c) for i, c in enumerate(COLUMNS)])
