"""Folders of a shared file system whose valid version is named by an empty file.

    current/N     version N is complete

Whatever belongs to version N is written first. Then the name is created, which is
there or not; a version that was not named is no part of the table and is
written anew. Names alone come to the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


class Versioned:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def numbers(self, folder: str, pattern: str) -> list[int]:
        """The numbers in the names of a folder that match the pattern."""
        system, path = self._hadoop(folder)
        if not system.exists(path):
            return []
        found = (re.fullmatch(pattern, status.getPath().getName()) for status in system.listStatus(path))
        return sorted(int(m[1]) for m in found if m)

    def current(self) -> int | None:
        return max(self.numbers("current", r"(\d+)"), default=None)

    def name(self, number: int) -> None:
        """Make a version valid."""
        system, path = self._hadoop(f"current/{number}")
        system.create(path, True).close()

    def remove(self, name: str) -> None:
        system, path = self._hadoop(name)
        system.delete(path, True)
