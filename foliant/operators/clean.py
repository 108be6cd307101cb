"""Deletes. Each returns the surviving table and a counter table.

Rows without a source are "not this source". On ``docs`` a delete by source is
a plain filter; on ``cells`` it is an anti-join by row_key, broadcast when the
list of victims is small and shuffle-free on a table bucketed by row_key. What a
delete removes is a ``Doomed``, which ``sources.celltable`` applies to a stored table,
rewriting only the files that hold such cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.model import in_families
from foliant.operators.rows import counters, key_side, long_result
from foliant.operators.scan import column_is
from foliant.operators.sizes import MIB, upper_bin


@dataclass(frozen=True)
class Doomed:
    """Which cells a delete removes: those that meet the test in rows of the listed
    keys; no keys means all rows, no test whole rows. A test that is null holds for nothing."""

    keys: DataFrame | None = None
    test: Column | None = None

    def _tested(self) -> Column:
        return F.lit(True) if self.test is None else F.coalesce(self.test, F.lit(False))

    def survivors(self, cells: DataFrame) -> DataFrame:
        if self.keys is None:
            return cells.where(~self._tested())
        if self.test is None:
            return cells.join(self.keys, "row_key", "left_anti")
        return cells.where(~self._tested()).unionByName(self.hits(cells, "left_anti"))

    def hits(self, cells: DataFrame, how: str = "left_semi") -> DataFrame:
        """The cells that are removed; as an anti-join, those that the test alone would remove."""
        found = cells if self.test is None else cells.where(self._tested())
        return found if self.keys is None else found.join(self.keys, "row_key", how)


def doomed_rows(cells: DataFrame, source: str, families: Sequence[str] = ()) -> Doomed:
    """Rows of a source, or only the named families of them."""
    return Doomed(source_keys(cells, source), in_families(families) if families else None)


def doomed_columns(cells: DataFrame, source: str, family: str = "meta", name_regex: str = "2010.*") -> Doomed:
    """D3. A null qualifier matches nothing; its cell stays."""
    return Doomed(source_keys(cells, source), column_is(family) & F.rlike("qualifier", F.lit(f"^(?:{name_regex})$")))


def doomed_large_rows(cells: DataFrame, family: str, limit: int = MIB) -> Doomed:
    """D4."""
    return Doomed(key_side(cells.where(column_is(family) & (F.octet_length("value") >= limit))))


def doomed_column(cells: DataFrame, family: str, qualifier: str | None = None, where: tuple[str, str, str] | None = None) -> Doomed:
    """D5."""
    if where is None:
        return Doomed(test=column_is(family, qualifier))
    test_family, test_qualifier, value = where
    rows = cells.where(column_is(test_family, test_qualifier) & (F.col("value") == value))
    return Doomed(key_side(rows), column_is(family, qualifier))


def doomed_numeric_keys() -> Doomed:
    """D6."""
    return Doomed(test=F.rlike("row_key", F.lit("^[0-9]+$")))


def source_keys(cells: DataFrame, source: str) -> DataFrame:
    return key_side(cells.where(column_is("src", "name") & (F.col("value") == source)))


def _rows(group: str, counter: str, keys: DataFrame) -> DataFrame:
    return keys.agg(F.countDistinct("row_key").alias("n")).select(*long_result(group, counter, F.col("n")))


def delete_source_rows(cells: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """D1."""
    doomed = doomed_rows(cells, source)
    return doomed.survivors(cells), _rows("rows", "row deleted", doomed.keys)


def delete_source_docs(docs: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """D1 on docs: a pushed-down filter and one counting pass."""
    name = F.col("src.name")
    counted = counters(docs, "rows", **{"row seen": F.lit(True), "row deleted": name == source})
    return docs.where(name.isNull() | (name != source)), counted


def delete_rows(cells: DataFrame, source: str, families: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of a source, or only the named families of them."""
    doomed = doomed_rows(cells, source, families)
    survivors, victims = doomed.survivors(cells), doomed.keys
    names = cells.where(column_is("src", "name")).groupBy("value").agg(F.countDistinct("row_key").alias("n"))
    counted = names.select(
        *long_result("rows", F.concat(F.lit("row src ("), "value", F.lit(")")), F.col("n"))
    )
    counted = counted.unionByName(_rows("rows", "row seen", cells)).unionByName(_rows("rows", "row deleted", victims))
    for family in families:
        hit = cells.where(column_is(family)).select("row_key").join(victims, "row_key", "left_semi")
        counted = counted.unionByName(_rows("rows", f"delete column family({family})", hit))
    return survivors, counted


def delete_columns_matching(
    cells: DataFrame, source: str, family: str = "meta", name_regex: str = "2010.*"
) -> tuple[DataFrame, DataFrame]:
    """D3: columns of a family whose whole name matches, for rows of a source."""
    doomed = doomed_columns(cells, source, family, name_regex)
    survivors, gone = doomed.survivors(cells), doomed.hits(cells.select("row_key", "family", "qualifier"))
    counted = gone.groupBy("qualifier").agg(F.count("*").alias("n")).select(
        *long_result("column deleted", F.col("qualifier"), F.col("n"))
    )
    return survivors, counted.unionByName(_rows("rows", "row changed", gone))


def delete_large_rows(cells: DataFrame, family: str, limit: int = MIB) -> tuple[DataFrame, DataFrame]:
    """Whole rows with a cell of the family at or above the limit.

    Counters: victims by MiB of their largest cell, and size bins of the
    family's cells in the surviving rows.
    """
    sizes = cells.where(column_is(family)).select(
        "row_key", "qualifier", F.octet_length("value").alias("size")
    )
    largest = sizes.groupBy("row_key").agg(F.max("size").alias("largest"))
    victims = largest.where(F.col("largest") >= limit)
    doomed = key_side(victims)
    deleted = victims.groupBy(F.floor(F.col("largest") / MIB).alias("mib")).agg(F.count("*").alias("n"))
    kept = sizes.where(F.col("size") < limit).join(doomed, "row_key", "left_anti")
    bins = kept.groupBy("qualifier", upper_bin(F.col("size")).alias("bin")).agg(F.count("*").alias("n"))
    counted = deleted.select(*long_result("delete", F.col("mib"), F.col("n"))).unionByName(
        bins.select(*long_result(F.concat(F.lit("size "), "qualifier"), F.col("bin"), F.col("n")))
    )
    return cells.join(doomed, "row_key", "left_anti"), counted


def delete_column(
    cells: DataFrame,
    family: str,
    qualifier: str | None = None,
    where: tuple[str, str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A family, or one column, from all rows having it.

    where = (family, qualifier, value) restricts it to rows with that value,
    in whichever family the tested column lies.
    """
    doomed = doomed_column(cells, family, qualifier, where)
    survivors, gone = doomed.survivors(cells), doomed.hits(cells.select("row_key", "family", "qualifier"))
    return survivors, _rows("rows", "row changed", gone)


def delete_numeric_keys(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is all digits; of cells or docs."""
    doomed = doomed_numeric_keys()
    return doomed.survivors(table), _rows("rows", "row deleted", doomed.hits(table).select("row_key"))


def without_annotation_set(docs: DataFrame, name: str) -> DataFrame:
    """D7."""
    return docs.withColumn("annotations", without_key(F.col("annotations"), name))


def without_metadata(docs: DataFrame, key: str) -> DataFrame:
    """D8."""
    return docs.withColumn("meta", without_key(F.col("meta"), key))


def without_key(entries: Column, key: str) -> Column:
    return F.map_filter(entries, lambda k, _: k != key)
