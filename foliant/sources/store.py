"""Cells and docs as stored tables, and text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import normalized
from foliant.model import CELLS_SCHEMA
from foliant.operators.terms import MATRIX_FIELDS, vector_text


def write_cells(cells: DataFrame, path: str) -> None:
    """A new snapshot, one folder per family and sorted by key.

    A scan of one family reads that folder only, and a key range reads only
    the row groups whose key bounds meet it.
    """
    (
        cells.select(*CELLS_SCHEMA.names)
        .repartitionByRange("family", "row_key")
        .sortWithinPartitions("family", "row_key", "qualifier", "ts")
        .write.partitionBy("family")
        .parquet(path)
    )


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELLS_SCHEMA).parquet(path).select(*CELLS_SCHEMA.names)


def save_cells_by_key(cells: DataFrame, table: str, buckets: int) -> DataFrame:
    """A managed table bucketed by row_key: joins and groupings by row_key on
    it (deletes, row sizes, docs) need no shuffle of the values."""
    (
        cells.select(*CELLS_SCHEMA.names)
        .repartition(buckets, "row_key")
        .write.bucketBy(buckets, "row_key")
        .sortBy("row_key")
        .saveAsTable(table)
    )
    return cells.sparkSession.table(table)


def matrix_lines(matrix: DataFrame) -> DataFrame:
    """Year, month, day, section and id:count pairs, each field followed by a tab."""
    fields = [F.concat(F.col(f), F.lit("\t")) for f in MATRIX_FIELDS]
    return matrix.select("row_key", F.concat(*fields, vector_text(F.col("vector")), F.lit("\t")).alias("line"))


def write_matrix(matrix: DataFrame, path: str) -> None:
    """I12 in key order; the parts together are the matrix."""
    matrix_lines(matrix).orderBy("row_key").select("line").write.text(path)


def dictionary_lines(dictionary: DataFrame) -> DataFrame:
    """``id text`` lines of the folded terms."""
    return dictionary.select(F.concat_ws(" ", F.col("term_id").cast("string"), "term").alias("value"))


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """I13, sorted by text, gzip."""
    dictionary_lines(dictionary.orderBy("term")).write.text(path, compression="gzip")


def parse_dictionary(lines: DataFrame) -> DataFrame:
    """Lines back to a dictionary; lines without an id are skipped."""
    pattern = r"^\s*(\d+)\s+(.*)$"
    rows = lines.where(F.rlike("value", F.lit(pattern)))
    term = normalized(F.regexp_extract("value", pattern, 2))
    return rows.select(
        F.regexp_extract("value", pattern, 1).cast("bigint").alias("term_id"), term.alias("term"), term.alias("surface")
    )


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return parse_dictionary(spark.read.text(path))
