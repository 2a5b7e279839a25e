"""Numbered versions of a table or a set of tables, each put in place by one rename."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Versions:
    """Small descriptions ``<root>/versions/<n>.json``. A version exists once its file has its name; all it describes is written before.

    Readers of a version are never disturbed by the next, and an interrupted writer leaves the version before it current. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/versions"

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def known(self) -> list[int]:
        path, fs = self._path("*.json")
        names = [f.getPath().getName()[:-5] for f in fs.globStatus(path) or []]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int | None = None) -> dict | None:
        """A version, the latest by default; None if there is none at all."""
        known = self.known()
        if number is None and not known:
            return None
        if number is not None and number not in known:
            raise ValueError(f"no version {number}; there are {known}")
        lines = self.spark.read.text(f"{self.root}/{known[-1] if number is None else number}.json", wholetext=True).first()
        return json.loads(lines[0])

    def put(self, number: int, description: dict) -> None:
        temporary, fs = self._path(f"_{number}.tmp")
        final, _ = self._path(f"{number}.json")
        if fs.exists(final):
            raise ValueError(f"version {number} was written by someone else")
        out = fs.create(temporary, True)
        try:
            out.write(bytearray(json.dumps(description).encode()))
        finally:
            out.close()
        if not fs.rename(temporary, final):
            raise OSError(f"could not put version {number} in place")
