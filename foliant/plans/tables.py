"""The benchmark tables in the shape of the model, and the same as SQL.

``documents`` becomes cells and docs, ``events`` a cells table with times.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.spans import match_spans, set_annotation_set
from foliant.model import CELLS_SCHEMA, empty_annotations, meta_map, src_struct, text_struct
from foliant.operators.rows import computed

WORD = r"[\p{L}\p{N}]+"
NAME = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*"
CAPITAL = r"\p{Lu}\p{L}*"
EPOCH_2024 = 1704067200


#: Bytes of text that a task is dealt, about, and what a row counts beside its text.
TASK_BYTES = 8 << 20
ROW_BYTES = 64


def tasks(df: DataFrame, text: str = "text") -> int:
    """How many tasks the text of a table is dealt to: one per core, or more as the text grows."""
    held = df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-held // TASK_BYTES))


def spread(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Deal the rows of a benchmark table out over the tasks before costly work on them.

    The small tables are one row group each, read by one task; what follows would run alone.
    The number of tasks grows with the text, so that what one task sorts, counts and
    gathers stays the same however long the table is.
    """
    return df.repartition(tasks(df, text), key)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _key() -> Column:
    return F.col("doc_id").cast("string")


def tag_list() -> Column:
    """A tab list: language and source, empty parts at the end; blank for German."""
    return F.when(F.col("lang") == "de", "  ").otherwise(
        F.concat(F.col("lang"), F.lit("\t "), F.col("source"), F.lit("\t\t"))
    )


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the documents, one branch per column as in a table stored by
    family: a scan of one column reads that column only."""
    docs = documents(spark, folder)
    ts = F.timestamp_seconds(F.col("doc_id") + EPOCH_2024)

    def branch(family: str, qualifier: str | Column, value: Column, rows: DataFrame = docs) -> DataFrame:
        name = F.lit(qualifier) if isinstance(qualifier, str) else qualifier
        return rows.select(
            _key().alias("row_key"),
            F.lit(family).alias("family"),
            name.alias("qualifier"),
            ts.alias("ts"),
            value.cast("string").alias("value"),
        )

    parts = [
        branch("src", "name", F.col("source")),
        branch("src", "id", F.col("doc_id")),
        branch("text", "raw", F.col("text")),
        branch("meta", "lang", F.col("lang")),
        branch("meta", "n_chars", F.col("n_chars")),
        branch("meta", "tags", tag_list()),
        branch("meta", F.concat(F.lit("2010-"), F.col("lang")), F.lit("ingested")),
        branch("meta", "translated", F.col("lang"), docs.where(F.col("lang") != "en")),
    ]
    return reduce(DataFrame.unionByName, parts).select(*CELLS_SCHEMA.names)


CELLS_SQL = """
documents_at AS (
  SELECT *, CAST(doc_id AS VARCHAR) AS row_key, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS ts
  FROM documents),
cells AS (
  SELECT row_key, 'src' AS family, 'name' AS qualifier, ts, source AS value FROM documents_at
  UNION ALL SELECT row_key, 'src', 'id', ts, row_key FROM documents_at
  UNION ALL SELECT row_key, 'text', 'raw', ts, text FROM documents_at
  UNION ALL SELECT row_key, 'meta', 'lang', ts, lang FROM documents_at
  UNION ALL SELECT row_key, 'meta', 'n_chars', ts, CAST(n_chars AS VARCHAR) FROM documents_at
  UNION ALL SELECT row_key, 'meta', 'tags', ts,
    CASE WHEN lang = 'de' THEN '  ' ELSE lang || chr(9) || ' ' || source || chr(9) || chr(9) END FROM documents_at
  UNION ALL SELECT row_key, 'meta', '2010-' || lang, ts, 'ingested' FROM documents_at
  UNION ALL SELECT row_key, 'meta', 'translated', ts, lang FROM documents_at WHERE lang <> 'en')"""


def event_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the events, at the time of the event."""
    key = F.col("event_id").cast("string")
    fields = ("event_type", "user_id", "props")
    events = table(spark, folder, "events")
    parts = [
        events.select(
            key.alias("row_key"),
            F.lit("meta").alias("family"),
            F.lit(f).alias("qualifier"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.col(f).cast("string").alias("value"),
        )
        for f in fields
    ]
    return reduce(DataFrame.unionByName, parts)


EVENT_CELLS_SQL = """
cells AS (
  SELECT CAST(event_id AS VARCHAR) AS row_key, 'meta' AS family, 'event_type' AS qualifier, ts, event_type AS value
  FROM events
  UNION ALL SELECT CAST(event_id AS VARCHAR), 'meta', 'user_id', ts, CAST(user_id AS VARCHAR) FROM events
  UNION ALL SELECT CAST(event_id AS VARCHAR), 'meta', 'props', ts, props FROM events)"""


def docs(spark: SparkSession, folder: str, *sets: str) -> DataFrame:
    """Docs of the documents, with the named annotation sets.

    token: words; ne: runs of capitalized words; parse: capitalized words and
    numbers, none for Spanish; dep: commas.
    """
    base = documents(spark, folder).withColumn("row_key", _key())
    if sets:
        base = spread(base, "row_key")
    text = F.col("text")
    day = F.col("doc_id") % 28 + 1
    meta = meta_map(
        lang=F.col("lang"),
        n_chars=F.col("n_chars"),
        tags=tag_list(),
        PublicationYear=F.col("doc_id") % 20 + 1987,
        PublicationMonth=F.col("doc_id") % 12 + 1,
        PublicationDayOfMonth=day,
        OnlineSection=F.when(F.col("lang") != "es", F.col("lang")),
    )
    annotations = empty_annotations()
    for name in sets:
        annotations = set_annotation_set(annotations, F.lit(name), _spans(name, text))
    columns = [
        "row_key",
        src_struct(name=F.col("source"), id=F.col("row_key")).alias("src"),
        meta.alias("meta"),
        text_struct(raw=text).alias("text"),
    ]
    if not sets:
        return base.select(*columns, annotations.alias("annotations"))
    # A stored table would hold the annotations; here they are made once.
    return computed(base, "annotations", annotations).select(*columns, "annotations")


def _spans(name: str, text: Column) -> Column:
    if name == "token":
        return match_spans(text, WORD, "word")
    if name == "ne":
        return match_spans(text, NAME, "name")
    if name == "parse":
        both = F.concat(match_spans(text, CAPITAL, "NP"), match_spans(text, r"\p{N}+", "NUM"))
        return F.when(F.col("lang") != "es", both)
    if name == "dep":
        return match_spans(text, ",", "punct")
    raise ValueError(f"no rule for set {name}")


def conversation_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Docs of the conversation turns, with their tokens."""
    key = F.format_string("%d/%d", "conv_id", "turn")
    turns = spread(table(spark, folder, "conversations").withColumn("row_key", key), "row_key")
    return turns.select(
        "row_key",
        src_struct(name=F.col("role"), id=F.col("row_key")).alias("src"),
        meta_map(role=F.col("role")).alias("meta"),
        text_struct(raw=F.col("text")).alias("text"),
        set_annotation_set(empty_annotations(), F.lit("token"), match_spans(F.col("text"), WORD, "word")).alias(
            "annotations"
        ),
    )


def spans_sql(pattern: str) -> str:
    """Matches in the documents as an SQL table (row_key, i, w, s, e): text, start and end."""
    found, gaps = f"regexp_extract_all(text, '{pattern}')", f"regexp_split_to_array(text, '{pattern}')"
    return f"""(SELECT row_key, i, w, e - length(w) AS s, e FROM (
  SELECT row_key, z[3] AS i, z[1] AS w, CAST(sum(length(z[1]) + length(z[2])) OVER (PARTITION BY row_key ORDER BY z[3]) AS BIGINT) AS e FROM (
    SELECT CAST(doc_id AS VARCHAR) AS row_key, unnest(list_zip({found}, {gaps}[1:len({found})], range(len({found})))) AS z FROM documents)))"""


def span_list(spans: Column) -> Column:
    """``start-end`` of every span, in order of place."""
    at = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.array_join(F.transform(at, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_list_sql(*patterns: str) -> str:
    """``span_list`` of the matches of all patterns per document (row_key, spans)."""
    every = " UNION ALL ".join(f"SELECT row_key, s, e FROM {spans_sql(p)}" for p in patterns)
    return f"""(SELECT CAST(doc_id AS VARCHAR) AS row_key, coalesce(spans, '') AS spans FROM documents LEFT JOIN (
  SELECT row_key, string_agg(CAST(s AS VARCHAR) || '-' || CAST(e AS VARCHAR), ',' ORDER BY s, e) AS spans
  FROM ({every}) GROUP BY row_key) ON row_key = CAST(doc_id AS VARCHAR))"""


# Tokens of the documents and of the conversations: (row_key, pos, tok).
TOKENS_SQL = r"""
token_lists AS (
  SELECT CAST(doc_id AS VARCHAR) AS row_key, regexp_extract_all(text, '[\p{L}\p{N}]+') AS l FROM documents),
tokens AS (
  SELECT row_key, unnest(l) AS tok, unnest(range(len(l))) AS pos FROM token_lists)"""

TURN_TOKENS_SQL = r"""
turn_lists AS (
  SELECT CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS row_key,
    regexp_extract_all(text, '[\p{L}\p{N}]+') AS l FROM conversations),
turn_tokens AS (
  SELECT row_key, unnest(l) AS tok, unnest(range(len(l))) AS pos FROM turn_lists)"""

# The dictionary of the documents: ids in first-seen order.
DICTIONARY_SQL = (
    TOKENS_SQL
    + """,
seen AS (
  SELECT lower(tok) AS term, tok AS surface, row_key, pos,
    row_number() OVER (PARTITION BY lower(tok) ORDER BY row_key, pos) AS k FROM tokens),
dictionary AS (
  SELECT row_number() OVER (ORDER BY row_key, pos) - 1 AS term_id, term, surface FROM seen WHERE k = 1)"""
)
