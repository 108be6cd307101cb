"""Counts of rows, columns and values. Results are rows, not job counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.spans import annotation_set, span_texts
from foliant.functions.text import is_blank, split_tabs, trimmed
from foliant.model import in_families
from foliant.operators.rows import long_result
from foliant.operators.scan import column_is

# Labels, counter groups and counters of the reports.
EMPTY = "--- Empty ---"
NO_SOURCE, WRONG_SOURCE, RIGHT_SOURCE = "-- no src --", "-- wrong src --", "right source"
VALUES, SOURCE_STATUS = "CountVals", "CountVals meta"
PARSE_REPORT, PARSE_TYPE, DEP_TYPE = "printNPs", "type", "dep type"
SEEN, NO_TEXT, NO_PARSE, NO_DEPS = (
    "seen row", "skipped -- no raw text", "skipped -- not parsed", "skipped deps -- not parsed",
)
PARSE_SET, DEP_SET = "parse", "dep"


def count_rows(cells: DataFrame) -> DataFrame:
    """A1 on cells: distinct keys. A docs table needs ``count_docs`` only."""
    return cells.agg(F.countDistinct("row_key").alias("n"))


def count_docs(docs: DataFrame) -> DataFrame:
    """A1 on docs: no shuffle but the final sum."""
    return docs.agg(F.count("*").alias("n"))


def count_rows_with_column(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """A2, A4."""
    return count_rows(cells.where(column_is(family, qualifier)))


def count_rows_with_family(cells: DataFrame, family: str) -> DataFrame:
    """A3: rows, although the reports call them columns."""
    return count_rows(cells.where(column_is(family)))


def count_rows_matching(cells: DataFrame, family: str, qualifier: str, regex: str) -> DataFrame:
    """A5: rows whose column has the pattern anywhere."""
    return count_rows(cells.where(column_is(family, qualifier) & F.rlike("value", F.lit(regex))))


def column_values(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Counts of exact values, with the total over all rows."""
    values = cells.where(column_is(family, qualifier)).groupBy("value").agg(F.count("*").alias("n"))
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return values.select(*long_result("value", F.col("value"), F.col("n"))).unionByName(
        total.select(*long_result("total", "total rows", F.col("n")))
    )


def column_subvalues(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Counts of the trimmed parts of tab lists; blank cells under one label."""
    value = F.col("value")
    parts = F.when(is_blank(value), F.array(F.lit(EMPTY))).otherwise(F.transform(split_tabs(value), trimmed))
    exploded = cells.where(column_is(family, qualifier)).select(F.explode(parts).alias("value"))
    counted = exploded.groupBy("value").agg(F.count("*").alias("n"))
    return counted.select(*long_result(VALUES, F.col("value"), F.col("n")))


def columns_of_families(cells: DataFrame, families: Sequence[str]) -> DataFrame:
    """Cells per family and qualifier."""
    return (
        cells.where(in_families(families))
        .groupBy("family", "qualifier")
        .agg(F.count("*").alias("n"))
    )


def columns_of_source(cells: DataFrame, family: str, source: str) -> DataFrame:
    """A10: cells per qualifier for rows of a source (any case), and row status.

    A row is seen if it has a cell in the family or in ``src``.
    """
    seen = cells.where(in_families({family, "src"}))
    is_name = column_is("src", "name")
    names = seen.groupBy("row_key").agg(F.max(F.when(is_name, F.col("value"))).alias("name"))
    status = (
        F.when(is_blank(F.col("name")), NO_SOURCE)
        .when(F.lower("name") == source.lower(), RIGHT_SOURCE)
        .otherwise(WRONG_SOURCE)
    )
    rows = names.groupBy(status.alias("status")).agg(F.count("*").alias("n"))
    right = seen.where(is_name & (F.lower("value") == source.lower())).select("row_key")
    columns = (
        cells.where(column_is(family))
        .select("row_key", "qualifier")
        .join(right, "row_key", "left_semi")
        .groupBy("qualifier")
        .agg(F.count("*").alias("n"))
    )
    return rows.select(*long_result(SOURCE_STATUS, F.col("status"), F.col("n"))).unionByName(
        columns.select(*long_result(VALUES, F.col("qualifier"), F.col("n")))
    )


def parse_types(docs: DataFrame) -> DataFrame:
    """Annotation types of the parse and dependency sets, and skip reasons.

    Dependencies count only for rows with raw text and a parse. One scan: each
    row yields its status and its types, counted before the shuffle.
    """
    parse, dep = annotation_set(PARSE_SET), annotation_set(DEP_SET)
    no_text = F.coalesce(F.length("text.raw"), F.lit(0)) == 0
    entry = "array<struct<counter_group:string,counter:string>>"

    def one(counter: str):
        return F.array(F.struct(F.lit(PARSE_REPORT).alias("counter_group"), F.lit(counter).alias("counter"))).cast(entry)

    def types(group: str, spans):
        return F.transform(
            spans, lambda a: F.struct(F.lit(group).alias("counter_group"), a["type"].alias("counter"))
        ).cast(entry)

    found = (
        F.when(no_text, F.concat(one(SEEN), one(NO_TEXT)))
        .when(F.size(parse) == 0, F.concat(one(SEEN), one(NO_PARSE)))
        .when(F.size(dep) == 0, F.concat(one(SEEN), types(PARSE_TYPE, parse), one(NO_DEPS)))
        .otherwise(F.concat(one(SEEN), types(PARSE_TYPE, parse), types(DEP_TYPE, dep)))
    )
    return (
        docs.select(F.inline(found)).groupBy("counter_group", "counter").agg(F.count("*").alias("n"))
    )


def annotation_values(docs: DataFrame, name: str) -> DataFrame:
    """How often each covered text occurs in an annotation set."""
    spans = annotation_set(name)
    texts = docs.select(F.explode(span_texts(F.col("text.raw"), spans)).alias("value"))
    return texts.groupBy("value").agg(F.count("*").alias("n"))


def count_rows_without_column(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Rows that lack the column, in one pass over keys and flags."""
    rows = cells.groupBy("row_key").agg(F.max(column_is(family, qualifier)).alias("has"))
    return rows.agg(F.count_if(~F.col("has")).alias("n"))
