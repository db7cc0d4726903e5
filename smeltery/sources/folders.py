"""Folders that appear whole or not at all: written under a hidden name, then renamed once.

A store whose rename of a folder is atomic and refuses a taken name (HDFS, local disks) makes a rename
both the moment of publishing and the test that nobody else has taken the name.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError


def literal(path: str) -> str:
    """The path as a name, not a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


@dataclass(frozen=True)
class Folders:
    """The folders below ``root``."""

    spark: SparkSession
    root: str

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, inside: str = "") -> list[str]:
        """Visible folders directly in ``inside``, in order."""
        files, place = self._files(), self._path(inside)
        if not files.exists(place):
            return []
        found = [status.getPath().getName() for status in files.listStatus(place) if status.isDirectory()]
        return sorted(name for name in found if not name.startswith((".", "_")))

    def hidden(self) -> str:
        """A new name that readers don't see."""
        return f".pending-{uuid.uuid4().hex}"

    def publish(self, hidden: str, name: str) -> bool:
        """Renames a written folder; False if another one has the name."""
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files().getUri(), self.spark._jsc.hadoopConfiguration())
        nothing = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(hidden), self._path(name), nothing)
        except (Py4JJavaError, CapturedException) as error:
            if "FileAlreadyExists" in str(error) or "not empty" in str(error):
                return False
            raise
        return True

    def drop(self, name: str) -> None:
        self._files().delete(self._path(name), True)
