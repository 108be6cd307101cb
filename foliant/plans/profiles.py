"""Queries A1-A14 and Z1-Z5."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.operators import profile as P
from foliant.operators import sizes as Z
from foliant.operators.clean import delete_source_docs
from foliant.plans.registry import query
from foliant.plans.tables import CELLS_SQL, cells, docs

C = f"WITH {CELLS_SQL}\n"


@query("A1_count_rows", "SELECT count(*) AS n FROM documents")
def count_rows(spark, folder):
    return P.count_docs(docs(spark, folder))


@query("A1_count_rows_of_cells", C + "SELECT count(DISTINCT row_key) AS n FROM cells")
def count_rows_of_cells(spark, folder):
    return P.count_rows(cells(spark, folder))


_TRANSLATED = "family = 'meta' AND qualifier = 'translated'"


@query("A2_count_rows_with_column", C + f"SELECT count(DISTINCT row_key) AS n FROM cells WHERE {_TRANSLATED}")
def count_rows_with_column(spark, folder):
    return P.count_rows_with_column(cells(spark, folder), "meta", "translated")


@query("A3_count_rows_with_family", C + "SELECT count(DISTINCT row_key) AS n FROM cells WHERE family = 'meta'")
def count_rows_with_family(spark, folder):
    return P.count_rows_with_family(cells(spark, folder), "meta")


@query("A4_count_qualifiers", C + "SELECT count(DISTINCT row_key) AS n FROM cells WHERE family = 'meta' AND qualifier = '2010-fr'")
def count_qualifiers(spark, folder):
    return P.count_rows_with_column(cells(spark, folder), "meta", "2010-fr")


@query(
    "A5_count_rows_matching",
    C + r"SELECT count(DISTINCT row_key) AS n FROM cells WHERE family = 'text' AND qualifier = 'raw' AND regexp_matches(value, '(?i)tion\s+of\b')",
)
def count_rows_matching(spark, folder):
    return P.count_rows_matching(cells(spark, folder), "text", "raw", r"(?i)tion\s+of\b")


_VALUES = """, v AS (SELECT value, count(*) AS n FROM cells WHERE family = 'src' AND qualifier = 'name' GROUP BY value)
SELECT 'value' AS counter_group, value AS counter, n FROM v
UNION ALL SELECT 'total', 'total rows', CAST(sum(n) AS BIGINT) FROM v"""


@query("A6_column_values", C + _VALUES)
def column_values(spark, folder):
    return P.column_values(cells(spark, folder), "src", "name")


@query(
    "A7_column_subvalues",
    C + r"""SELECT 'CountVals' AS counter_group, part AS counter, count(*) AS n FROM (
  SELECT unnest(CASE WHEN trim(value) = '' THEN ['--- Empty ---']
    ELSE list_transform(string_split(regexp_replace(value, '\t+$', ''), chr(9)), lambda x: trim(x)) END) AS part
  FROM cells WHERE family = 'meta' AND qualifier = 'tags') GROUP BY part""",
)
def column_subvalues(spark, folder):
    return P.column_subvalues(cells(spark, folder), "meta", "tags")


@query("A8_columns_of_families", C + "SELECT family, qualifier, count(*) AS n FROM cells GROUP BY family, qualifier")
def columns_of_families(spark, folder):
    return P.columns_of_families(cells(spark, folder), ["src", "meta", "text", "annotations"])


@query(
    "A9_scan_qualifiers",
    C + "SELECT family, qualifier, count(*) AS n FROM cells WHERE family IN ('meta') GROUP BY family, qualifier",
)
def scan_qualifiers(spark, folder):
    return P.columns_of_families(cells(spark, folder), ["meta"])


@query(
    "A10_columns_of_source",
    C + """, r AS (SELECT row_key, max(CASE WHEN family = 'src' AND qualifier = 'name' THEN value END) AS name
  FROM cells WHERE family IN ('meta', 'src') GROUP BY row_key)
SELECT 'CountVals meta' AS counter_group, CASE WHEN name IS NULL OR trim(name) = '' THEN '-- no src --'
  WHEN lower(name) = 'src5' THEN 'right source' ELSE '-- wrong src --' END AS counter, count(*) AS n FROM r GROUP BY 2
UNION ALL SELECT 'CountVals', qualifier, count(*) FROM cells
  WHERE family = 'meta' AND row_key IN (SELECT row_key FROM r WHERE lower(name) = 'src5') GROUP BY qualifier""",
)
def columns_of_source(spark, folder):
    return P.columns_of_source(cells(spark, folder), "meta", "SRC5")


@query(
    "A11_parse_types",
    r"""WITH d AS (
  SELECT length(text) AS n_text, CASE WHEN lang <> 'es' THEN len(regexp_extract_all(text, '\p{Lu}\p{L}*')) ELSE 0 END AS np,
    CASE WHEN lang <> 'es' THEN len(regexp_extract_all(text, '\p{N}+')) ELSE 0 END AS num,
    len(regexp_extract_all(text, ',')) AS punct FROM documents),
s AS (SELECT *, n_text > 0 AS has_text, n_text > 0 AND np + num > 0 AS is_parsed FROM d),
r AS (
  SELECT 'printNPs' AS counter_group, 'seen row' AS counter, count(*) AS n FROM s
  UNION ALL SELECT 'printNPs', 'skipped -- no raw text', count(*) FROM s WHERE NOT has_text
  UNION ALL SELECT 'printNPs', 'skipped -- not parsed', count(*) FROM s WHERE has_text AND NOT is_parsed
  UNION ALL SELECT 'printNPs', 'skipped deps -- not parsed', count(*) FROM s WHERE is_parsed AND punct = 0
  UNION ALL SELECT 'type', 'NP', CAST(sum(np) AS BIGINT) FROM s WHERE is_parsed
  UNION ALL SELECT 'type', 'NUM', CAST(sum(num) AS BIGINT) FROM s WHERE is_parsed
  UNION ALL SELECT 'dep type', 'punct', CAST(sum(punct) AS BIGINT) FROM s WHERE is_parsed)
SELECT * FROM r WHERE n > 0""",
)
def parse_types(spark, folder):
    return P.parse_types(docs(spark, folder, "parse", "dep"))


@query(
    "A12_counters",
    """SELECT 'rows' AS counter_group, 'row seen' AS counter, count(*) AS n FROM documents
UNION ALL SELECT 'rows', 'row deleted', count(*) FROM documents WHERE source = 'src4'""",
)
def counters(spark, folder):
    return delete_source_docs(docs(spark, folder), "src4")[1]


@query(
    "A13_annotation_values",
    r"""SELECT value, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*')) AS value FROM documents) GROUP BY value""",
)
def annotation_values(spark, folder):
    return P.annotation_values(docs(spark, folder, "ne"), "ne")


@query(
    "A14_count_rows_without_column",
    C + f"""SELECT count(DISTINCT row_key) AS n FROM cells
WHERE row_key NOT IN (SELECT row_key FROM cells WHERE {_TRANSLATED})""",
)
def count_rows_without_column(spark, folder):
    return P.count_rows_without_column(cells(spark, folder), "meta", "translated")


def upper_sql(size: str) -> str:
    bins = "".join(f" WHEN {size} < {bound} THEN '{name}'" for bound, name in Z.UPPER_BINS)
    return f"CASE{bins} ELSE 'BIG' END"


def lower_sql(size: str) -> str:
    kib = f"({size} >> 10)"
    return f"CASE WHEN {kib} < 10 THEN {kib} WHEN {kib} < 100 THEN {kib} // 10 * 10 ELSE 100 END"


def distribution_sql(sizes: str) -> str:
    return f"""SELECT 'kb size' AS counter_group, CAST({lower_sql('b')} AS VARCHAR) AS counter, count(*) AS n FROM {sizes} GROUP BY 2
UNION ALL SELECT 'mb size', CAST({lower_sql('(b >> 10)')} AS VARCHAR), count(*) FROM {sizes} GROUP BY 2
UNION ALL SELECT 'total', 'total rows', count(*) FROM {sizes}"""


_SIZES = ", sizes AS (SELECT row_key, CAST(sum(strlen(value)) AS BIGINT) AS b FROM cells GROUP BY row_key)\n"


@query("Z1_row_size_bins", C + _SIZES + f"SELECT {upper_sql('b')} AS bin, count(*) AS n FROM sizes GROUP BY 1")
def row_size_bins(spark, folder):
    return Z.row_size_bins(cells(spark, folder))


@query(
    "Z2_cell_size_bins",
    C + f"SELECT qualifier, {upper_sql('strlen(value)')} AS bin, count(*) AS n FROM cells WHERE family = 'text' GROUP BY 1, 2",
)
def cell_size_bins(spark, folder):
    return Z.cell_size_bins(cells(spark, folder), "text")


@query("Z3_row_size_distribution", C + _SIZES + distribution_sql("sizes"))
def row_size_distribution(spark, folder):
    return Z.row_size_distribution(cells(spark, folder))


@query(
    "Z4_family_size_distribution",
    C + ", sizes AS (SELECT row_key, CAST(sum(strlen(value)) AS BIGINT) AS b FROM cells WHERE family = 'meta' GROUP BY row_key)\n"
    + distribution_sql("sizes"),
)
def family_size_distribution(spark, folder):
    return Z.family_size_distribution(cells(spark, folder), "meta")


@query(
    "Z5_column_length_distribution",
    C + ", sizes AS (SELECT length(value) AS b FROM cells WHERE family = 'text' AND qualifier = 'raw')\n" + distribution_sql("sizes"),
)
def column_length_distribution(spark, folder):
    return Z.column_length_distribution(cells(spark, folder), "text", "raw")


@query(
    "A_corpus_profile",
    C + """SELECT family, qualifier, count(*) AS n_cells, count(DISTINCT value) AS n_values,
  CAST(sum(strlen(value)) AS BIGINT) AS n_bytes, max(strlen(value)) AS max_bytes FROM cells GROUP BY family, qualifier""",
)
def corpus_profile(spark, folder):
    """One report over every column: cells, distinct values, bytes.

    Values are told apart by SHA-1, so texts are not shuffled.
    """
    size = F.octet_length("value")
    return (
        cells(spark, folder)
        .select("family", "qualifier", F.sha1(F.col("value").cast("binary")).alias("v"), size.cast("bigint").alias("b"))
        .groupBy("family", "qualifier")
        .agg(
            F.count("*").alias("n_cells"),
            F.countDistinct("v").alias("n_values"),
            F.sum("b").alias("n_bytes"),
            F.max("b").alias("max_bytes"),
        )
    )
