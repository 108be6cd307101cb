"""Queries D1-D8."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.operators import clean as D
from foliant.plans.profiles import upper_sql
from foliant.plans.registry import query
from foliant.plans.scans import CELL, CELL_COLUMNS
from foliant.plans.tables import CELLS_SQL, cells, docs
from foliant.session import fresh_path
from foliant.sources.celltable import CellTable

C = f"WITH {CELLS_SQL}\n"


def of_source(name: str) -> str:
    return f"SELECT row_key FROM cells WHERE family = 'src' AND qualifier = 'name' AND value = '{name}'"


@query("D1_delete_source_rows", C + f"SELECT {CELL} FROM cells WHERE row_key NOT IN ({of_source('src1')})")
def delete_source_rows(spark, folder):
    return D.delete_source_rows(cells(spark, folder), "src1")[0].select(*CELL_COLUMNS)


def stored(spark, folder) -> CellTable:
    """The cells as a stored table of many files."""
    held = CellTable(spark, fresh_path(spark, "table"))
    held.write(cells(spark, folder))
    return held


@query(
    "D_stored_deletes",
    C + f"""SELECT {CELL} FROM cells WHERE row_key NOT IN ({of_source('src1')})
AND NOT (family IN ('meta', 'text') AND row_key IN ({of_source('src2')}))
AND NOT (family = 'meta' AND regexp_full_match(qualifier, '2010.*') AND row_key IN ({of_source('src6')}))
AND row_key NOT IN (SELECT row_key FROM cells WHERE family = 'text' AND strlen(value) >= 8192 AND row_key NOT IN ({of_source('src2')}))
AND NOT (family = 'meta' AND qualifier = 'translated')""",
)
def stored_deletes(spark, folder):
    """D1 to D5 one after the other on a stored table, each rewriting the files that it touches.

    The large rows are those that still have their text when their turn comes."""
    held = stored(spark, folder)
    held.delete(D.doomed_rows(held.cells(), "src1"))
    held.delete(D.doomed_rows(held.cells(), "src2", ["meta", "text"]))
    held.delete(D.doomed_columns(held.cells(), "src6"))
    held.delete(D.doomed_large_rows(held.cells(), "text", 8192))
    held.delete(D.doomed_column(held.cells(), "meta", "translated"))
    return held.cells().select(*CELL_COLUMNS)


@query(
    "D1_counters", C + f"SELECT 'rows' AS counter_group, 'row deleted' AS counter, count(*) AS n FROM ({of_source('src1')})"
)
def delete_source_counters(spark, folder):
    return D.delete_source_rows(cells(spark, folder), "src1")[1]


@query("D1_delete_source_docs", "SELECT CAST(doc_id AS VARCHAR) AS row_key, source, text FROM documents WHERE source <> 'src1'")
def delete_source_docs(spark, folder):
    kept = D.delete_source_docs(docs(spark, folder), "src1")[0]
    return kept.select("row_key", F.col("src.name").alias("source"), F.col("text.raw").alias("text"))


@query("D2_delete_rows", C + f"SELECT {CELL} FROM cells WHERE row_key NOT IN ({of_source('src2')})")
def delete_rows(spark, folder):
    return D.delete_rows(cells(spark, folder), "src2")[0].select(*CELL_COLUMNS)


@query(
    "D2_delete_families",
    C + f"SELECT {CELL} FROM cells WHERE NOT (family IN ('meta', 'text') AND row_key IN ({of_source('src2')}))",
)
def delete_families(spark, folder):
    return D.delete_rows(cells(spark, folder), "src2", ["meta", "text"])[0].select(*CELL_COLUMNS)


@query(
    "D2_counters",
    C + f"""SELECT 'rows' AS counter_group, 'row seen' AS counter, count(DISTINCT row_key) AS n FROM cells
UNION ALL SELECT 'rows', 'row src (' || value || ')', count(*) FROM cells WHERE family = 'src' AND qualifier = 'name' GROUP BY value
UNION ALL SELECT 'rows', 'row deleted', count(*) FROM ({of_source('src2')})
UNION ALL SELECT 'rows', 'delete column family(meta)', count(DISTINCT row_key) FROM cells
  WHERE family = 'meta' AND row_key IN ({of_source('src2')})""",
)
def delete_counters(spark, folder):
    return D.delete_rows(cells(spark, folder), "src2", ["meta"])[1]


_DATED = f"family = 'meta' AND regexp_full_match(qualifier, '2010.*') AND row_key IN ({of_source('src6')})"


@query("D3_delete_columns_matching", C + f"SELECT {CELL} FROM cells WHERE NOT ({_DATED})")
def delete_columns_matching(spark, folder):
    return D.delete_columns_matching(cells(spark, folder), "src6")[0].select(*CELL_COLUMNS)


@query(
    "D3_counters",
    C + f"""SELECT 'column deleted' AS counter_group, qualifier AS counter, count(*) AS n FROM cells WHERE {_DATED} GROUP BY qualifier
UNION ALL SELECT 'rows', 'row changed', count(DISTINCT row_key) FROM cells WHERE {_DATED}""",
)
def delete_columns_counters(spark, folder):
    return D.delete_columns_matching(cells(spark, folder), "src6")[1]


_LARGE = "SELECT row_key FROM cells WHERE family = 'text' AND strlen(value) >= 8192"


@query("D4_delete_large_rows", C + f"SELECT {CELL} FROM cells WHERE row_key NOT IN ({_LARGE})")
def delete_large_rows(spark, folder):
    return D.delete_large_rows(cells(spark, folder), "text", 8192)[0].select(*CELL_COLUMNS)


@query(
    "D4_counters",
    C + f"""SELECT 'delete' AS counter_group, CAST(b // 1048576 AS VARCHAR) AS counter, count(*) AS n FROM (
  SELECT row_key, max(strlen(value)) AS b FROM cells WHERE family = 'text' GROUP BY row_key) WHERE b >= 8192 GROUP BY 2
UNION ALL SELECT 'size ' || qualifier, {upper_sql('strlen(value)')}, count(*) FROM cells
  WHERE family = 'text' AND row_key NOT IN ({_LARGE}) GROUP BY 1, 2""",
)
def delete_large_counters(spark, folder):
    return D.delete_large_rows(cells(spark, folder), "text", 8192)[1]


@query("D5_delete_family", C + f"SELECT {CELL} FROM cells WHERE family <> 'meta'")
def delete_family(spark, folder):
    return D.delete_column(cells(spark, folder), "meta")[0].select(*CELL_COLUMNS)


@query(
    "D5_delete_column_where",
    C + f"SELECT {CELL} FROM cells WHERE NOT (family = 'meta' AND qualifier = 'tags' AND row_key IN ({of_source('src9')}))",
)
def delete_column_where(spark, folder):
    return D.delete_column(cells(spark, folder), "meta", "tags", ("src", "name", "src9"))[0].select(*CELL_COLUMNS)


@query(
    "D5_counters",
    C + f"""SELECT 'rows' AS counter_group, 'row changed' AS counter, count(DISTINCT row_key) AS n FROM cells
WHERE family = 'meta' AND qualifier = 'tags' AND row_key IN ({of_source('src9')})""",
)
def delete_column_counters(spark, folder):
    return D.delete_column(cells(spark, folder), "meta", "tags", ("src", "name", "src9"))[1]


def mixed_keys(spark, folder):
    """Docs with numeric keys for English and prefixed ones otherwise."""
    key = F.when(F.col("meta.lang") == "en", F.col("row_key")).otherwise(F.concat_ws(":", "meta.lang", "row_key"))
    return docs(spark, folder).withColumn("row_key", key)


@query("D6_delete_numeric_keys", "SELECT lang || ':' || CAST(doc_id AS VARCHAR) AS row_key, source FROM documents WHERE lang <> 'en'")
def delete_numeric_keys(spark, folder):
    return D.delete_numeric_keys(mixed_keys(spark, folder))[0].select("row_key", F.col("src.name").alias("source"))


@query(
    "D6_counters", "SELECT 'rows' AS counter_group, 'row deleted' AS counter, count(*) AS n FROM documents WHERE lang = 'en'"
)
def delete_numeric_counters(spark, folder):
    return D.delete_numeric_keys(mixed_keys(spark, folder))[1]


@query(
    "D7_drop_annotation_set",
    r"SELECT CAST(doc_id AS VARCHAR) AS row_key, 'ne' AS sets, len(regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*')) AS n FROM documents",
)
def drop_annotation_set(spark, folder):
    kept = D.without_annotation_set(docs(spark, folder, "dep", "ne"), "dep")
    return kept.select(
        "row_key",
        F.array_join(F.map_keys("annotations"), ",").alias("sets"),
        F.size(F.col("annotations")["ne"]).cast("bigint").alias("n"),
    )


@query(
    "D8_drop_metadata",
    """SELECT CAST(doc_id AS VARCHAR) AS row_key, lang FROM documents""",
)
def drop_metadata(spark, folder):
    kept = docs(spark, folder)
    for key in ("tags", "n_chars", "PublicationYear", "PublicationMonth", "PublicationDayOfMonth", "OnlineSection"):
        kept = D.without_metadata(kept, key)
    return kept.select("row_key", F.array_join(F.map_values("meta"), ",").alias("lang"))
