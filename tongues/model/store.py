"""Versions of a model in a folder: complete ones count, and nothing is written over."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from tongues.sources.scratch import discard

MARKER = "_COMPLETE"
_VERSION = re.compile(r"v(\d{8})-[0-9a-f]{32}")


class ModelStore:
    """Folders ``v<number>-<random>`` below ``directory``. Two writers at a time have folders of their own, and the one whose number or, of equal numbers, name is
    higher is read; both are whole."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.directory).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, complete: bool = True) -> list[str]:
        """Folders of versions, oldest first: the complete ones, or all."""
        files = self._files()
        if not files.exists(self._path(self.directory)):
            return []
        names = [s.getPath().getName() for s in files.listStatus(self._path(self.directory))]
        found = [f"{self.directory}/{n}" for n in sorted(names) if _VERSION.fullmatch(n)]
        return [p for p in found if not complete or files.exists(self._path(f"{p}/{MARKER}"))]

    def begin(self) -> str:
        """A folder for a new version, with a higher number than all there are."""
        names = [p.rsplit("/", 1)[1] for p in self.versions(complete=False)]
        number = max([int(_VERSION.fullmatch(n)[1]) for n in names], default=0) + 1
        return f"{self.directory}/v{number:08d}-{uuid.uuid4().hex}"

    def commit(self, path: str) -> None:
        """Mark a version as complete, then delete all that are older than the one before it."""
        self._files().create(self._path(f"{path}/{MARKER}"), False).close()
        complete = self.versions()
        for old in self.versions(complete=False):
            if len(complete) > 1 and old < complete[-2]:
                discard(self.spark, old)

    def last(self) -> str | None:
        return next(iter(reversed(self.versions())), None)
