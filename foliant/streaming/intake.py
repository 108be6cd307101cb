"""Continuous feed intake and its running counts.

Each batch is stored under its id and replaced if it is run again, so a restart
neither loses nor doubles a row. Readers take the newest cell per column, which
makes a re-seen entry one row; compaction keeps what they read near the size of
the table (see ``BatchStore``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from foliant.model import CELLS_SCHEMA, docs_to_cells
from foliant.operators.upsert import newest
from foliant.sources.feeds import SEEN, feed_docs
from foliant.streaming.store import AT, BatchStore


def landed_feeds(spark: SparkSession, folder: str, glob: str = "*.xml") -> DataFrame:
    """Stream of feed files: (url, xml, seen_at)."""
    files = spark.readStream.option("pathGlobFilter", glob).text(folder, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("url"),
        F.col("value").alias("xml"),
        F.col("_metadata.file_modification_time").alias("seen_at"),
    )


def table_stream(spark: SparkSession, folder: str, glob: str, schema: StructType) -> DataFrame:
    """Stream of the parquet files of a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def feed_cells(feeds: DataFrame, source: str) -> DataFrame:
    """I5/I6 cells of a batch of (url, xml, seen_at), each stamped with its feed's arrival.

    A feed that lands late, or again, is stored like any other: the newest cell
    per column is what readers see, whichever batch brought it.
    """
    return docs_to_cells(feed_docs(feeds, source), F.col(SEEN))


def cell_store(spark: SparkSession, path: str) -> BatchStore:
    """Cells, of which the newest version per column counts, a later batch before an earlier one."""
    return BatchStore(spark, path, CELLS_SCHEMA, lambda rows: newest(rows, tie="batch", at=AT))


def count_store(spark: SparkSession, path: str) -> BatchStore:
    """(value, n); counts only grow, so the latest is the largest."""
    schema = StructType().add("value", "string").add("n", "long")
    return BatchStore(spark, path, schema, lambda rows: rows.groupBy("value").agg(F.max("n").alias("n")))


def _started(stream: DataFrame, mode: str, to_rows, store: BatchStore, checkpoint: str, compact_every: int | None) -> StreamingQuery:
    """Put every batch into the store; all available input, then stop."""

    def put(batch: DataFrame, batch_id: int) -> None:
        store.put(to_rows(batch), batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            store.compact()

    written = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint)
    return written.trigger(availableNow=True).start()


def start_intake(
    stream: DataFrame,
    to_cells: Callable[[DataFrame], DataFrame],
    store: str,
    checkpoint: str,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Store the cells of every batch; compact_every: batches after which the store is compacted."""
    return _started(stream, "append", to_cells, cell_store(stream.sparkSession, store), checkpoint, compact_every)


def stored_cells(spark: SparkSession, store: str) -> DataFrame:
    """The table as it stands: newest version of every column."""
    return cell_store(spark, store).state()


def start_counts(stream: DataFrame, column: str, store: str, checkpoint: str, compact_every: int | None = None) -> StreamingQuery:
    """Running rows per value of a column, in update mode: every batch stores the counts that changed."""
    counted = stream.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return _started(counted, "update", lambda batch: batch, count_store(stream.sparkSession, store), checkpoint, compact_every)


def latest_counts(spark: SparkSession, store: str) -> DataFrame:
    """(value, n) as of the last batch."""
    return count_store(spark, store).state()
