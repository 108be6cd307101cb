"""A store of stream batches that stays small to read.

    batch=N/      rows of batch N, replaced if the batch is run again
    snapshot=N/   what all batches up to N come to
    current/N     the manifest: names the snapshot that is valid (see ``Versioned``)

A read takes the newest snapshot that the manifest names, and the batches after
it. Compaction writes such a state as the next snapshot and then names it; until
then readers see the old one, and a snapshot that was not named is written anew.
Nothing that a reader may have open is changed; ``clear`` removes what is behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from foliant.sources.versions import Versioned


#: Rows of one document, which say much the same, stand side by side; this finds what repeats far apart.
PACKING = "zstd"
#: Where a row is stored.
AT = ("file", "row")


class BatchStore(Versioned):
    """reduce: the state that rows (schema, batch, file, row) come to, in columns of the schema.

    It must give the same for parts as for the whole: the rows of a snapshot count as
    rows of the snapshot's batch. file and row say where a row is stored.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, reduce: Callable[[DataFrame], DataFrame]):
        super().__init__(spark, path)
        self.reduce = reduce
        self.schema = StructType(list(schema.fields))
        self.with_batch = StructType(list(schema.fields)).add("batch", LongType())

    def batches(self) -> list[int]:
        return self.numbers("", r"batch=(\d+)")

    def snapshot(self) -> int | None:
        """The batch up to which the valid snapshot reaches."""
        return self.current()

    # Rows.

    def put(self, rows: DataFrame, batch: int) -> None:
        """Store the rows of a batch; once more, if it is run again."""
        self._write(rows.select(*self.schema.names), f"batch={batch}")

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").option("compression", PACKING).parquet(f"{self.path}/{name}")

    def rows(self) -> DataFrame:
        """(schema, batch, file, row): the valid snapshot and the batches after it."""
        held = self.snapshot()
        later = [f"{self.path}/batch={n}" for n in self.batches() if held is None or n > held]
        place = [F.substring_index("_metadata.file_path", "/", -2).alias(AT[0]), F.col("_metadata.row_index").alias(AT[1])]
        parts = []
        if held is not None:
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshot={held}")
            parts.append(rows.select("*", F.lit(held).cast("bigint").alias("batch"), *place))
        if later:
            rows = self.spark.read.schema(self.with_batch).option("basePath", self.path).parquet(*later)
            parts.append(rows.select("*", *place))
        if not parts:
            return self.spark.createDataFrame([], StructType(list(self.with_batch.fields)).add(AT[0], StringType()).add(AT[1], LongType()))
        return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]

    def state(self) -> DataFrame:
        return self.reduce(self.rows()).select(*self.schema.names)

    # Compaction.

    def write_snapshot(self) -> int | None:
        """Write the state of all batches as a snapshot that is not valid yet; its number, or none if there is nothing new."""
        last, held = max(self.batches(), default=None), self.snapshot()
        if last is None or (held is not None and last <= held):
            return None
        self._write(self.state(), f"snapshot={last}")
        return last

    def compact(self) -> None:
        number = self.write_snapshot()
        if number is not None:
            self.name(number)

    def clear(self) -> None:
        """Remove batches, snapshots and names behind the valid snapshot; for a time when nobody reads them."""
        held = self.snapshot()
        if held is None:
            return
        behind = [f"batch={n}" for n in self.batches() if n <= held]
        behind += [f"snapshot={n}" for n in self.numbers("", r"snapshot=(\d+)") if n < held]
        behind += [f"current/{n}" for n in self.numbers("current", r"(\d+)") if n < held]
        for name in behind:
            self.remove(name)
