"""Keyed upsert, and versioned storage of the tables it refreshes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.functions.expressions import hash_slot
from cohortlift.session import materialise
from cohortlift.sources.pointer import Versions


def upsert(target: DataFrame, source: DataFrame, keys: list[str], delete_missing: bool = False) -> DataFrame:
    """``target`` with matching rows replaced by ``source`` and new rows added.

    Rows of ``target`` without a match are kept unless ``delete_missing``. Keys must be unique
    in both frames.
    """
    values = [c for c in target.columns if c not in keys]
    t, s = (df.select(*keys, F.struct(*values).alias(name)) for df, name in ((target, "_t"), (source, "_s")))
    joined = t.join(s, keys, "right" if delete_missing else "full")
    row = F.coalesce("_s", "_t")
    return joined.select(*keys, *[row[c].alias(c) for c in values]).select(*target.columns)


class VersionedTable:
    """A Parquet table kept as numbered versions, so a refresh never overwrites what it reads.

    A version counts once its write has committed; readers take the highest of those, and an
    interrupted write leaves the previous version current.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/v=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
        return sorted(int(f.getPath().getParent().getName()[2:]) for f in found or [])

    def current(self) -> DataFrame | None:
        versions = self._versions()
        return self.spark.read.parquet(f"{self.root}/v={versions[-1]}") if versions else None

    def write(self, df: DataFrame) -> int:
        version = (self._versions() or [0])[-1] + 1
        df.write.mode("overwrite").parquet(f"{self.root}/v={version}")
        return version

    def merge(self, source: DataFrame, keys: list[str], delete_missing: bool = False) -> int:
        """Upsert ``source`` into the current version and commit the result as the next."""
        target = self.current()
        return self.write(source if target is None else upsert(target, source, keys, delete_missing))


@dataclass(frozen=True)
class Version:
    """What a version of a bucketed table consists of: for every bucket that has rows, the version in which it was written."""

    number: int
    buckets: int
    written: dict[int, int]


class BucketedTable:
    """A Parquet table in hash buckets of its key, of which an upsert rewrites only those that the source touches.

    ``data/written=n/bucket=b`` holds bucket b as version n wrote it; ``versions/n.json`` lists the folders that make up version n and is
    put in place, by a rename, after all data of the version. So readers of a version are never disturbed, an interrupted
    merge leaves the version before it current, and its leftovers are overwritten by the next. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = 256):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets
        self.versions = Versions(spark, self.root)

    def version(self, number: int | None = None) -> Version | None:
        """A version, the latest by default; None if there is none."""
        found = self.versions.read(number)
        return found and Version(found["version"], found["buckets"], {int(b): w for b, w in found["written"].items()})

    def bucket(self) -> Column:
        """The bucket of a row: a hash of its key that other engines can recompute."""
        return hash_slot(F.concat_ws("|", *[F.col(k).cast("string") for k in self.keys]), self.buckets).cast("int")

    def read(self, number: int | None = None, only: set[int] | None = None) -> DataFrame | None:
        """The rows of a version with ``written`` and ``bucket``; with ``only``, of these buckets. None if it has no rows there."""
        version = self.version(number)
        wanted = {} if version is None else {b: w for b, w in version.written.items() if only is None or b in only}
        if not wanted:
            return None
        folders = [f"{self.root}/data/written={w}/bucket={b}" for b, w in sorted(wanted.items())]
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*folders)

    def merge(self, source: DataFrame, delete_missing: bool = False) -> Version:
        """Upserts ``source``: matching rows replaced, new ones added, others kept, or dropped with ``delete_missing``.

        Keys must be unique in ``source``. Only buckets with rows in it are read and written (all with ``delete_missing``); each bucket's rows
        are joined where they lie, as both sides are hashed by the same key.
        """
        last = self.version()
        if last and last.buckets != self.buckets:
            raise ValueError(f"the table has {last.buckets} buckets, not {self.buckets}")
        new = (last.number if last else 0) + 1
        source = materialise(source.withColumn("bucket", self.bucket()))
        touched = {r["bucket"] for r in source.select("bucket").distinct().collect()}
        if delete_missing and last:
            touched |= set(last.written)
        target = self.read(only=touched) if last else None
        rows = source
        if target is not None and not delete_missing:
            rows = upsert(target.drop("written").select(*source.columns), source, ["bucket", *self.keys])
        rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(
            f"{self.root}/data/written={new}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data/written={new}/bucket=*")
        found = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
        filled = sorted(int(f.getPath().getName()[7:]) for f in found or [])
        kept = {b: w for b, w in (last.written if last else {}).items() if b not in touched}
        version = Version(new, self.buckets, kept | dict.fromkeys(filled, new))
        self.versions.put(new, {"version": new, "buckets": self.buckets, "written": {str(b): w for b, w in version.written.items()}})
        return version
