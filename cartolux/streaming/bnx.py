"""A file-source stream of molecules: each new file is parsed as a whole, without state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.text import molecule_rows


def molecules(spark: SparkSession, folder: str, least: int = 30, files_per_trigger: int = 64) -> DataFrame:
    """Molecules of the files that arrive in ``folder``, with the columns of ``sources.text.read_bnx``."""
    records = spark.readStream.option("lineSep", "\n0\t").option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return molecule_rows(records, least)
