"""A term dictionary that stays in place: a table bucketed by term.

The rows (term_id, term, surface) of a bucket stay together. Looking up, growing
and merging join by term, so that what is looked up or added moves to the
buckets, and the dictionary does not move. Growth appends the new rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import clean_text, normalized
from foliant.operators import terms as V
from foliant.operators.rows import with_index
from foliant.session import written


class StoredDictionary:
    def __init__(self, spark: SparkSession, table: str, buckets: int):
        self.spark, self.table, self.buckets = spark, table, buckets

    @classmethod
    def create(cls, dictionary: DataFrame, table: str, buckets: int, path: str | None = None) -> StoredDictionary:
        """Store a dictionary as a new table; path: where its files lie, if not in the warehouse."""
        self = cls(dictionary.sparkSession, table, buckets)
        self._write(dictionary, "errorifexists", path)
        return self

    def _write(self, rows: DataFrame, mode: str, path: str | None = None) -> None:
        # A task per bucket, so that a bucket gets one file.
        dealt = rows.select(*V.DICTIONARY_COLUMNS).repartition(self.buckets, "term")
        writer = dealt.write.mode(mode).format("parquet").bucketBy(self.buckets, "term").sortBy("term")
        (writer if path is None else writer.option("path", path)).saveAsTable(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def unknown(self, terms: DataFrame) -> DataFrame:
        """The rows of terms (term, ...) that the dictionary lacks. Terms move to its buckets, which stay."""
        return terms.join(self.rows().select("term"), "term", "left_anti")

    def lookup(self, texts: DataFrame, column: str = "text") -> DataFrame:
        """V5: the id of each text, -1 if unknown."""
        return V.lookup_ids(texts, self.rows(), column)

    def grow(self, terms: DataFrame) -> None:
        """V4: known terms keep their ids, new ones follow the highest id in first-seen order, and are appended.

        terms: a table as ``document_terms`` writes it.
        """
        new = written(V.first_seen(terms), "seen")
        ids = with_index(self.unknown(new), ["place"]).select(
            (F.col("idx") + V.next_id(self.rows())).cast("bigint").alias("term_id"), "term", "surface"
        )
        self._write(written(ids, "grown"), "append")

    def merge(self, other: DataFrame) -> DataFrame:
        """V6: append all terms of other that are new, in term order; the map (old_id, new_id)."""
        folded = other.select(F.col("term_id").alias("old_id"), normalized(F.col("term")).alias("term"), clean_text(F.col("term")).alias("surface"))
        folded = written(folded, "folded")
        forms = folded.groupBy("term", "surface").agg(F.count("*").alias("n"))
        new = self.unknown(forms.groupBy("term").agg(F.min("surface").alias("surface")))
        ids = with_index(new, ["term"]).select((F.col("idx") + V.next_id(self.rows())).cast("bigint").alias("term_id"), "term", "surface")
        self._write(written(ids, "merged"), "append")
        return folded.join(self.rows().select("term", F.col("term_id").alias("new_id")), "term").select("old_id", "new_id")
