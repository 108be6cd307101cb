"""Queries S1-S15."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.operators import scan as S
from foliant.plans.registry import query
from foliant.plans.tables import CELLS_SQL, EVENT_CELLS_SQL, cells, docs, event_cells, table
from foliant.session import fresh_path

C = f"WITH {CELLS_SQL}\n"
E = f"WITH {EVENT_CELLS_SQL}\n"
CELL = "row_key, family, qualifier, value"
CELL_COLUMNS = ("row_key", "family", "qualifier", "value")


@query("S1_full_scan", C + "SELECT row_key || ' -> ' || family || ':' || qualifier || ':::' || value AS line FROM cells")
def full_scan(spark, folder):
    return S.printed(S.scan_cells(cells(spark, folder), S.ScanSpec()))


@query("S1_scan_total", C + "SELECT count(*) AS n_cells, count(DISTINCT row_key) AS n_rows FROM cells")
def scan_total(spark, folder):
    return cells(spark, folder).agg(
        F.count("*").alias("n_cells"), F.countDistinct("row_key").alias("n_rows")
    )


@query("S2_fetch", C + f"SELECT {CELL} FROM cells WHERE family = 'src' OR (family = 'meta' AND qualifier = 'lang')")
def fetch(spark, folder):
    return S.scan_cells(cells(spark, folder), S.ScanSpec(columns=["src", "meta:lang"])).select(*CELL_COLUMNS)


_EQUAL = "SELECT row_key FROM cells WHERE family = 'meta' AND qualifier = 'translated' AND value = 'fr'"


@query("S3_equals", C + f"SELECT {CELL} FROM cells WHERE row_key IN ({_EQUAL})")
def equals(spark, folder):
    spec = S.ScanSpec(equals=[("meta", "translated", "fr")])
    return S.scan_cells(cells(spark, folder), spec).select(*CELL_COLUMNS)


@query(
    "S3_equals_keep_missing",
    C + f"""SELECT {CELL} FROM cells WHERE row_key NOT IN (
  SELECT row_key FROM cells WHERE family = 'meta' AND qualifier = 'translated' AND value <> 'fr')""",
)
def equals_keep_missing(spark, folder):
    spec = S.ScanSpec(equals=[("meta", "translated", "fr")], missing="keep")
    return S.scan_cells(cells(spark, folder), spec).select(*CELL_COLUMNS)


@query(
    "S4_row_limit",
    C + f"SELECT {CELL} FROM cells WHERE row_key IN (SELECT DISTINCT row_key FROM cells ORDER BY row_key LIMIT 25)",
)
def row_limit(spark, folder):
    return S.scan_cells(cells(spark, folder), S.ScanSpec(limit=25)).select(*CELL_COLUMNS)


@query(
    "S4_large_row_limit",
    C + f"SELECT {CELL} FROM cells WHERE row_key IN (SELECT DISTINCT row_key FROM cells ORDER BY row_key LIMIT 20000)",
)
def large_row_limit(spark, folder):
    return S.scan_cells(cells(spark, folder), S.ScanSpec(limit=20_000)).select(*CELL_COLUMNS)


@query("S4_document_limit", "SELECT CAST(doc_id AS VARCHAR) AS row_key FROM documents ORDER BY row_key LIMIT 100")
def document_limit(spark, folder):
    return S.scan_docs(docs(spark, folder), S.ScanSpec(limit=100)).select("row_key")


@query(
    "S5_every_nth_row",
    C + f"""SELECT {CELL} FROM cells WHERE row_key IN (
  SELECT row_key FROM (SELECT row_key, row_number() OVER (ORDER BY row_key) AS k FROM (SELECT DISTINCT row_key FROM cells))
  WHERE k % 10 = 0)""",
)
def every_nth_row(spark, folder):
    return S.every_nth_row(cells(spark, folder), 10).select(*CELL_COLUMNS)


@query("S6_show_rows", C + "SELECT row_key, value FROM cells WHERE family = 'src' AND qualifier = 'name'")
def show_rows(spark, folder):
    return S.key_values(cells(spark, folder), "src", "name")


@query("S7_get_row", C + f"SELECT {CELL} FROM cells WHERE row_key = '17'")
def get_row(spark, folder):
    return S.row(cells(spark, folder), "17").select(*CELL_COLUMNS)


@query("S8_key_range", C + f"SELECT {CELL} FROM cells WHERE row_key >= '3' AND row_key < '62'")
def key_range(spark, folder):
    spec = S.ScanSpec(start_row="3", stop_row="62")
    return S.scan_cells(cells(spark, folder), spec).select(*CELL_COLUMNS)


@query(
    "S9_time_range",
    E + f"SELECT {CELL} FROM cells WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'",
)
def time_range(spark, folder):
    spec = S.ScanSpec(time_range=("2024-01-03", "2024-01-20-12"))
    return S.scan_cells(event_cells(spark, folder), spec).select(*CELL_COLUMNS)


@query("S10_time_stamp", C + f"SELECT {CELL} FROM cells WHERE ts = TIMESTAMP '2024-01-01 00:02:00'")
def time_stamp(spark, folder):
    spec = S.ScanSpec(timestamp="2024-01-01-00-02")
    return S.scan_cells(cells(spark, folder), spec).select(*CELL_COLUMNS)


@query(
    "S10_time_range_wins",
    C + f"SELECT {CELL} FROM cells WHERE ts >= TIMESTAMP '2024-01-01 00:01:00' AND ts < TIMESTAMP '2024-01-01 00:02:00'",
)
def time_range_wins(spark, folder):
    spec = S.ScanSpec(timestamp="2024-01-01-00-05", time_range=("2024-01-01-00-01", "2024-01-01-00-02"))
    return S.scan_cells(cells(spark, folder), spec).select(*CELL_COLUMNS)


@query("S11_source", "SELECT CAST(doc_id AS VARCHAR) AS row_key, lang, text FROM documents WHERE source = 'src7'")
def source(spark, folder):
    found = S.scan_docs(docs(spark, folder), S.ScanSpec(source="src7"))
    return found.select("row_key", F.col("meta.lang").alias("lang"), F.col("text.raw").alias("text"))


@query(
    "S11_source_cells",
    C + f"""SELECT {CELL} FROM cells WHERE family = 'meta' AND row_key IN (
  SELECT row_key FROM cells WHERE family = 'src' AND qualifier = 'name' AND value = 'src7')""",
)
def source_cells(spark, folder):
    spec = S.ScanSpec(source="src7", columns=["meta"])
    return S.scan_cells(cells(spark, folder), spec).select(*CELL_COLUMNS)


def listed_keys(spark, folder):
    """Key-file lines out of the labels: keys, each also with blanks, and comments."""
    line = F.col("doc_id").cast("string")
    lines = F.array(line, F.concat(F.lit("  "), line, F.lit("\t")), F.concat(F.lit("# "), line), F.lit(" "))
    # Key files, written and read back.
    path = fresh_path(spark, "key-files")
    table(spark, folder, "labels").select(F.explode(lines).alias("value")).write.text(path)
    return S.read_key_list(spark, path)


@query(
    "S12_key_list",
    C + f"SELECT {CELL} FROM cells WHERE family IN ('src', 'meta') AND row_key IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)",
)
def key_list(spark, folder):
    spec = S.ScanSpec(keys=listed_keys(spark, folder), columns=["src", "meta"])
    return S.scan_cells(cells(spark, folder), spec).select(*CELL_COLUMNS)


@query(
    "S12_key_list_with_misses",
    """SELECT CAST(c.conv_id + 50 AS VARCHAR) AS row_key, d.source AS source
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN documents d ON d.doc_id = c.conv_id + 50""",
)
def key_list_with_misses(spark, folder):
    keys = table(spark, folder, "conversations").select((F.col("conv_id") + 50).cast("string").alias("row_key"))
    found = S.rows_with_keys(docs(spark, folder), keys, keep_missing=True)
    return found.select("row_key", F.col("src.name").alias("source"))


@query(
    "S13_row_exists",
    """SELECT CAST(e.event_id AS VARCHAR) AS row_key, d.doc_id IS NOT NULL AS row_exists
FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id""",
)
def row_exists(spark, folder):
    keys = table(spark, folder, "events").select(F.col("event_id").cast("string").alias("row_key"))
    return S.rows_exist(keys, docs(spark, folder))


_SIZES = ", sizes AS (SELECT row_key, CAST(sum(strlen(value)) AS BIGINT) AS b FROM cells GROUP BY row_key)\n"


@query("S14_rows_within_size", C + _SIZES + f"SELECT {CELL} FROM cells WHERE row_key IN (SELECT row_key FROM sizes WHERE b <= 5000)")
def rows_within_size(spark, folder):
    return S.rows_within_size(cells(spark, folder), 5000)[0].select(*CELL_COLUMNS)


@query(
    "S14_size_counters",
    C + _SIZES + """SELECT 'row size log10' AS counter_group, CAST(CAST(floor(log10(b) + 0.5) AS BIGINT) AS VARCHAR) AS counter,
  count(*) AS n FROM sizes GROUP BY 2
UNION ALL SELECT 'rows', 'skip -- row too large (5000)', count(*) FROM sizes WHERE b > 5000""",
)
def size_counters(spark, folder):
    return S.rows_within_size(cells(spark, folder), 5000)[1]


@query(
    "S15_docs_within_text_size",
    "SELECT CAST(doc_id AS VARCHAR) AS row_key, length(text) AS n_chars FROM documents WHERE length(text) BETWEEN 1 AND 3000",
)
def docs_within_text_size(spark, folder):
    kept = S.docs_within_text_size(docs(spark, folder), 3000)[0]
    return kept.select("row_key", F.length("text.raw").cast("bigint").alias("n_chars"))


@query(
    "S15_text_size_counters",
    """SELECT 'rows' AS counter_group, CASE WHEN coalesce(length(text), 0) = 0 THEN 'skip -- no raw text'
  WHEN length(text) > 3000 THEN 'skip -- raw text too long (3000)' ELSE 'kept' END AS counter, count(*) AS n
FROM documents GROUP BY 2""",
)
def text_size_counters(spark, folder):
    return S.docs_within_text_size(docs(spark, folder), 3000)[1]


@query(
    "S_all_selectors",
    C + f"""SELECT {CELL} FROM cells
WHERE row_key IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
  AND row_key >= '1' AND row_key < '9'
  AND row_key IN (SELECT row_key FROM cells WHERE family = 'src' AND qualifier = 'name' AND value = 'src3')
  AND row_key IN (SELECT row_key FROM cells WHERE family = 'meta' AND qualifier = 'lang' AND value = 'en')
  AND (family = 'text' OR qualifier = 'n_chars')""",
)
def all_selectors(spark, folder):
    spec = S.ScanSpec(
        columns=["text", "meta:n_chars"],
        equals=[("meta", "lang", "en")],
        source="src3",
        start_row="1",
        stop_row="9",
        keys=listed_keys(spark, folder),
    )
    return S.scan_cells(cells(spark, folder), spec).select(*CELL_COLUMNS)
