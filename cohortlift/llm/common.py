"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"
#: Groups over which the rows of one join key are dealt.
SALTS = 16


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, a local session gets a folder of its own; a cluster must name one."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if known is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(known)
    return known


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder; what follows neither recomputes them nor loses them with an executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one for files of a query; it goes when the driver ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(path)
    return folder


def columns(df: DataFrame, **named: str) -> DataFrame:
    """Only the given columns, under private names; others, whatever they are called, stay out."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in named.items()))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text):
    """A-Z to a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    """The words of a text column in order; null and empty texts have none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words_of(text):
    """The number of words, without building them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
