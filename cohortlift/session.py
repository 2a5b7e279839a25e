"""Session settings and materialisation."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cohortlift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC dates.

    No shuffle partition count is set here: adaptive execution coalesces the default, and a
    cluster sets its own from the size of its data.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_scratch: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder and a cluster is refused: no
    executor could read another machine's temporary folder.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="cohortlift-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    return _local_scratch


def scratch_path(spark: SparkSession) -> str:
    """A new folder below the shared one; it is needed as long as frames built on it are, so it goes when the driver ends."""
    path = f"{scratch_root(spark)}/cohortlift/{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(jvm_path)
    return path


_stored: dict[str, DataFrame] = {}


def stored_from(path: str) -> DataFrame | None:
    """The frame that ``materialise`` stored at ``path``; None for any other path."""
    return _stored.get(path)


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for results used by several passes.

    The written table survives the loss of executors and carries file statistics.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    _stored[path.removeprefix("file:").replace("//", "/") if "://" not in path or path.startswith("file:") else path] = df
    return df.sparkSession.read.schema(df.schema).parquet(path)
