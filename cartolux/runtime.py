"""Session, table loading, shared-folder staging and skew helpers used by every operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Salts given to the big side of a join whose key may be hot.
SALTS = 16
#: How much larger than its compressed files a table is assumed to be in memory.
GROWTH = 8


def session(app: str = "cartolux", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings that the operators expect (UTC, AQE, Arrow)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session, or, only where
    that is unset and the master is local (tests, a single machine), a temporary folder that is removed
    at exit. On a cluster without the setting this raises: executors would write to disks of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="cartolux-")
        atexit.register(shutil.rmtree, folder, True)
        folder = f"file://{folder}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Stage:
    """Tables written to the shared folder to cut lineage. They survive the loss of executors, and
    the next plan starts from their files. ``drop`` removes those that no later plan reads."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/cartolux-{uuid.uuid4().hex}"
        self.made = 0
        atexit.register(self._clear)

    def _clear(self) -> None:
        """Removes what is left when the driver ends; results read from here have been written by then."""
        try:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:
            pass  # the session is gone; the folder is the cluster's to clear

    def write(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made:04d}-{name}"
        df.write.mode("error").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.staged_path = path
        return out

    def drop(self, *staged: DataFrame) -> None:
        for df in staged:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small_enough(df: DataFrame) -> bool:
    """Whether Catalyst's estimate of ``df`` leaves its hash table within the session's broadcast limit.
    Files are compressed, so the estimate counts ``GROWTH`` fold."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return GROWTH * int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def salted_join(big: DataFrame, small: DataFrame, on: list[str], salt_by: list[Column], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Equi-join of ``big`` with ``small`` (unique in ``on``) in which each key's rows of ``big`` are
    spread over ``salts`` partitions: a key that holds a third of all rows never reaches one task.
    ``small`` is replicated ``salts`` times, so prune it first; if it is known to be within the
    broadcast limit it is broadcast instead, as it is. ``how``: inner or left."""
    if small_enough(small):
        return big.join(F.broadcast(small), on, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def fits_broadcast(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` is known to have at most ``max_rows`` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows
