"""A cells table of many files, of which a delete rewrites only those that it touches.

    data=N/family=F/   files that version N added
    manifest=N/        the files that version N consists of, relative to the table
    current/N          version N is complete (see ``Versioned``)

A delete finds the files that hold doomed cells from keys and file names, reads and
filters these files, writes what is left as new files, and names a manifest of
the files kept and the new ones. Files that hold no doomed cell are not opened for more
than the search, and stay as they are. Readers of an older version go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from foliant.model import CELLS_SCHEMA
from foliant.operators.clean import Doomed
from foliant.sources.files import file_path, relative_path
from foliant.sources.versions import Versioned

ORDER = ("family", "row_key", "qualifier", "ts")


class CellTable(Versioned):
    """The table at a path. Its files' names come to the driver, where Spark's own index of them is."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path)
        self.schema = StructType([*CELLS_SCHEMA.fields]).add("data", IntegerType())

    def files(self) -> list[str]:
        """The files of the current version, relative to the table."""
        number = self.current()
        return [] if number is None else sorted(r["value"] for r in self.spark.read.text(f"{self.path}/manifest={number}").collect())

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in files])

    def cells(self) -> DataFrame:
        return self._read(self.files()).select(*CELLS_SCHEMA.names)

    def _add(self, cells: DataFrame, number: int) -> None:
        """Files of a version, sorted by key within each family."""
        cells.select(*CELLS_SCHEMA.names).sortWithinPartitions(*ORDER).write.mode("overwrite").partitionBy("family").parquet(f"{self.path}/data={number}")

    def _commit(self, kept: list[str], number: int) -> None:
        system, folder = self._hadoop(f"data={number}")
        new = []
        if system.exists(folder):
            walk = system.listFiles(folder, True)
            root = self.spark._jvm.java.net.URI.create(str(system.makeQualified(self._hadoop()[1]).toUri().toString()))
            while walk.hasNext():
                name = root.relativize(walk.next().getPath().toUri()).getPath()
                if name.endswith(".parquet"):
                    new.append(name if name.startswith("data=") else name[name.index(f"data={number}/") :])
        names = self.spark.createDataFrame([(f,) for f in [*kept, *new]], "value string")
        names.coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest={number}")
        self.name(number)

    def write(self, cells: DataFrame) -> None:
        """A version of these cells alone, range-partitioned by family and key."""
        number = self._next()
        self._add(cells.repartitionByRange("family", "row_key"), number)
        self._commit([], number)

    def _next(self) -> int:
        held = self.current()
        return 0 if held is None else held + 1

    def touched(self, doomed: Doomed) -> list[str]:
        """The files of the current version that hold a doomed cell; values are read only if the test does."""
        path = relative_path(file_path(), F.lit(self.path))
        held = self._read(self.files()).withColumn("file", path)
        return sorted(r["file"] for r in doomed.hits(held).select("file").distinct().collect())

    def delete(self, doomed: Doomed) -> tuple[int, int]:
        """Remove the doomed cells; how many files were rewritten, and how many stayed."""
        files, touched = self.files(), self.touched(doomed)
        kept = sorted(set(files) - set(touched))
        if touched:
            number = self._next()
            self._add(doomed.survivors(self._read(touched).select(*CELLS_SCHEMA.names)), number)
            self._commit(kept, number)
        return len(touched), len(kept)

    def clear(self) -> None:
        """Remove files and manifests behind the current version; for a time when nobody reads them."""
        held, files = self.current(), set(self.files())
        if held is None:
            return
        for number in self.numbers("", r"data=(\d+)"):
            if not any(f.startswith(f"data={number}/") for f in files):
                self.remove(f"data={number}")
        for number in self.numbers("", r"manifest=(\d+)"):
            if number < held:
                self.remove(f"manifest={number}")
                self.remove(f"current/{number}")
