"""Queries U1-U11, F1-F13, and the writes I8-I10, I14."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from foliant.functions import spans as P
from foliant.functions import text as X
from foliant.model import CELLS_SCHEMA, cells_to_docs, docs_to_cells
from foliant.operators import annotate as U
from foliant.operators import upsert as I
from foliant.operators.rows import computed
from foliant.plans.registry import query
from foliant.plans.scans import CELL, CELL_COLUMNS
from foliant.plans.tables import CELLS_SQL, NAME, WORD, cells, docs, documents, span_list, span_list_sql, spans_sql, spread, table

C = f"WITH {CELLS_SQL}\n"
KEY = "CAST(doc_id AS VARCHAR) AS row_key"
RUN_TIME = dt.datetime(2024, 2, 3, 4, 5, 6, tzinfo=dt.timezone.utc)


@query("U1_transform", f"SELECT {KEY}, split_part(text, chr(10), 1) AS title FROM documents")
def transform(spark, folder):
    return docs(spark, folder).transform(U.title_from_first_line).select("row_key", F.col("text.title").alias("title"))


@query(
    "U2_chain",
    rf"""SELECT {KEY}, split_part(text, chr(10), 1) AS title, split_part(text, chr(10), 1) AS headline,
  CAST(len(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+')) AS VARCHAR) AS n_tokens, 'names' AS sets FROM documents""",
)
def chain(spark, folder):
    out = U.chain(spread(docs(spark, folder), "row_key", "text.raw"), *_CHAIN)
    return out.select(
        "row_key",
        F.col("text.title").alias("title"),
        F.col("meta")["headline"].alias("headline"),
        F.col("meta")["n_tokens"].alias("n_tokens"),
        F.array_join(U.annotation_set_names(), ",").alias("sets"),
    )


_LIMIT = 4000
_CHAIN = (
    "title",
    ("copy", {"source": "text:title", "target": "headline"}),
    ("matches", {"set": "words", "pattern": WORD}),
    ("count", {"set": "words", "field": "n_tokens"}),
    ("matches", {"set": "names", "pattern": NAME}),
    ("drop", {"set": "words"}),
)


@query(
    "U2_chain_counters",
    rf"""WITH k AS (SELECT * FROM documents WHERE length(text) BETWEEN 1 AND {_LIMIT}),
t AS (SELECT count(*) FILTER (trim(split_part(text, chr(10), 1)) <> '') AS a, count(*) FILTER (regexp_matches(text, '[\p{{L}}\p{{N}}]')) AS b,
  count(*) AS c, count(*) FILTER (regexp_matches(text, '{NAME}')) AS d FROM k)
SELECT 'rows' AS counter_group, 'started' AS counter, count(*) AS n FROM documents
UNION ALL SELECT 'rows', 'skip -- no raw text', count(*) FROM documents WHERE length(text) = 0 HAVING count(*) > 0
UNION ALL SELECT 'rows', 'skip -- raw text too long ({_LIMIT})', count(*) FROM documents WHERE length(text) > {_LIMIT} HAVING count(*) > 0
UNION ALL SELECT 'rows', 'completed', c FROM t
UNION ALL SELECT 'added', unnest(['1 title', '2 copy', '3 matches', '4 count', '5 matches', '6 drop']), unnest([a, a, b, c, d, c]) FROM t""",
)
def chain_counters(spark, folder):
    """Counters and size guards of the same chain."""
    return U.counted_chain(spread(docs(spark, folder), "row_key", "text.raw"), *_CHAIN, max_chars=_LIMIT, max_bytes=1 << 20)[1]


@query(
    "U2_guarded_chain",
    f"""SELECT {KEY}, split_part(text, chr(10), 1) AS title FROM documents WHERE length(text) BETWEEN 1 AND {_LIMIT}""",
)
def guarded_chain(spark, folder):
    found = U.counted_chain(spread(docs(spark, folder), "row_key", "text.raw"), *_CHAIN, max_chars=_LIMIT, max_bytes=1 << 20)[0]
    return found.select("row_key", F.col("text.title").alias("title"))


# The section is a language, or none.
_FAILING = (
    ("number", {"source": "src:id", "target": "number"}),
    ("number", {"source": "meta:OnlineSection", "target": "section"}),
    "title",
)
_FATE = f"""WITH r AS (SELECT {KEY}, doc_id, CASE
  WHEN length(text) = 0 THEN 'guard' WHEN length(text) > {_LIMIT} THEN 'guard' WHEN lang <> 'es' THEN '2 number' END AS step, CASE
  WHEN length(text) = 0 THEN 'skip -- no raw text' WHEN length(text) > {_LIMIT} THEN 'skip -- raw text too long ({_LIMIT})'
  WHEN lang <> 'es' THEN 'no number in meta:OnlineSection: ' || lang END AS reason FROM documents)
"""


def failing_chain(spark, folder):
    return U.tried_chain(spread(docs(spark, folder), "row_key", "text.raw"), *_FAILING, max_chars=_LIMIT)


@query("U2_rejected_rows", _FATE + "SELECT row_key, step, reason FROM r WHERE step IS NOT NULL")
def rejected_rows(spark, folder):
    return failing_chain(spark, folder)[1]


@query("U2_rows_or_rejects", _FATE + "SELECT row_key, step IS NOT NULL AS rejected, CASE WHEN step IS NULL THEN CAST(doc_id AS VARCHAR) || '.000000' END AS number FROM r")
def rows_or_rejects(spark, folder):
    """Every row is a result or a reject."""
    results, rejects, _ = failing_chain(spark, folder)
    kept = results.select("row_key", F.lit(False).alias("rejected"), F.col("meta")["number"].alias("number"))
    return kept.unionByName(rejects.select("row_key", F.lit(True).alias("rejected"), F.lit(None).cast("string").alias("number")))


@query(
    "U2_error_counters",
    _FATE + """SELECT 'row process error' AS counter_group, s AS counter, count(step) AS n FROM unnest(['1 number', '2 number']) AS u(s)
LEFT JOIN r ON r.step = s GROUP BY s""",
)
def error_counters(spark, folder):
    return failing_chain(spark, folder)[2].where("counter_group = 'row process error'")


@query("U3_run_by_name", f"SELECT {KEY}, split_part(text, chr(10), 1) AS title FROM documents")
def run_by_name(spark, folder):
    return U.run(docs(spark, folder), "title", families=["text"]).select("row_key", F.col("text.title").alias("title"))


@query(
    "U4_add_field",
    f"""SELECT {KEY}, CASE WHEN trim(CASE WHEN lang = 'de' THEN '  ' ELSE source END) = '' THEN lang ELSE source END AS lang
FROM documents""",
)
def add_field(spark, folder):
    """A blank value leaves the old one."""
    value = F.when(F.col("meta.lang") == "de", "  ").otherwise(F.col("src.name"))
    return U.add_field(docs(spark, folder), "lang", value).select("row_key", F.col("meta")["lang"].alias("lang"))


@query("U4_added_count", "SELECT count(*) AS n FROM documents WHERE lang <> 'de'")
def added_count(spark, folder):
    return U.added_count(docs(spark, folder), F.when(F.col("meta.lang") == "de", "  ").otherwise(F.col("src.name")))


@query(
    "U5_add_annotation_set",
    rf"SELECT row_key, 'ne,token' AS sets, spans FROM {span_list_sql(r'\p{N}+')}",
)
def add_annotation_set(spark, folder):
    """A set of the same name is replaced."""
    out = U.add_annotations(docs(spark, folder, "token", "ne"), "token", P.match_spans(F.col("text.raw"), r"\p{N}+", "number"))
    return out.select(
        "row_key",
        F.array_join(U.annotation_set_names(), ",").alias("sets"),
        span_list(P.annotation_set("token")).alias("spans"),
    )


@query(
    "U6_canonical_names",
    f"SELECT row_key, 'named_entity,token' AS sets, spans FROM {span_list_sql(NAME, ',')}",
)
def canonical_names(spark, folder):
    out = U.canonical_sets(docs(spark, folder, "token", "ne", "dep"), {"ne": "named_entity", "dep": "named_entity"})
    return out.select(
        "row_key",
        F.array_join(U.annotation_set_names(), ",").alias("sets"),
        span_list(P.annotation_set("named_entity")).alias("spans"),
    )


@query(
    "U7_read_annotation_set",
    f"SELECT row_key, spans AS dep, '' AS pos FROM {span_list_sql(',')}",
)
def read_annotation_set(spark, folder):
    return docs(spark, folder, "dep").select(
        "row_key",
        span_list(P.annotation_set("dep")).alias("dep"),
        span_list(P.annotation_set("pos")).alias("pos"),
    )


@query("U8_row_keys", "SELECT sha1(source || ':' || CAST(doc_id AS VARCHAR)) AS row_key, doc_id FROM documents")
def row_keys(spark, folder):
    return documents(spark, folder).select(X.sha1_key(F.col("source"), F.col("doc_id").cast("string")).alias("row_key"), "doc_id")


@query(
    "U9_step_arguments",
    rf"SELECT row_key, spans FROM {span_list_sql(r'\p{Lu}')}",
)
def step_arguments(spark, folder):
    out = U.chain(spread(docs(spark, folder), "row_key", "text.raw"), ("matches", {"set": "capital", "pattern": r"\p{Lu}", "type": "letter"}))
    return out.select("row_key", span_list(P.annotation_set("capital")).alias("spans"))


@query(
    "U10_merge_metadata",
    f"""SELECT {KEY}, upper(lang) AS lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""",
)
def merge_metadata(spark, folder):
    base = docs(spark, folder)
    new = F.create_map(F.lit("lang"), F.upper("meta.lang"), F.lit("source"), F.col("src.name"))
    out = base.withColumn("meta", U.merge_metadata(F.col("meta"), new))
    return out.select("row_key", *[F.col("meta")[k].alias(k) for k in ("lang", "source", "n_chars")])


@query(
    "U11_names",
    f"""SELECT {KEY}, 'dep,ne' AS sets, concat_ws(',', CASE WHEN lang <> 'es' THEN 'OnlineSection' END, 'PublicationDayOfMonth',
  'PublicationMonth', 'PublicationYear', 'lang', 'n_chars', CASE WHEN lang <> 'de' THEN 'tags' END) AS keys FROM documents""",
)
def names(spark, folder):
    return docs(spark, folder, "ne", "dep").select(
        "row_key",
        F.array_join(U.annotation_set_names(), ",").alias("sets"),
        F.array_join(U.metadata_keys(), ",").alias("keys"),
    )


# -- writes ----------------------------------------------------------------


def label_puts(spark, folder):
    """Puts out of the labels: new columns, an older and a newer version of one
    column, and a blank that must not be stored."""
    row = F.col("doc_id").cast("string")
    entries = F.array(
        *[
            F.struct(F.lit("meta").alias("family"), F.lit(q).alias("qualifier"), v.cast("string").alias("value"), F.lit(day).alias("day"))
            for q, v, day in [
                ("quality", F.col("quality"), 400),
                ("toxic", F.col("toxic"), 400),
                ("lang", F.lit("older"), -400),
                ("n_chars", F.lit("newer"), 400),
                ("tags", F.lit(" "), 400),
            ]
        ]
    )
    put = table(spark, folder, "labels").select(row.alias("row_key"), "doc_id", F.inline(entries))
    at = F.timestamp_seconds(F.col("doc_id") + 1704067200 + F.col("day") * 86400)
    return put.withColumn("ts", at).select(*CELLS_SCHEMA.names)


@query(
    "I8_upsert",
    C + f"""SELECT {CELL} FROM cells c WHERE NOT (family = 'meta' AND qualifier = 'n_chars'
  AND row_key IN (SELECT CAST(doc_id AS VARCHAR) FROM labels))
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'meta', 'n_chars', 'newer' FROM labels
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'meta', 'quality', CAST(quality AS VARCHAR) FROM labels
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'meta', 'toxic', CAST(toxic AS VARCHAR) FROM labels""",
)
def upsert(spark, folder):
    return I.upsert(cells(spark, folder), label_puts(spark, folder)).select(*CELL_COLUMNS)


def turn_references(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select((F.col("conv_id") + 100).cast("string").alias("row_key"), F.col("role").alias("reference"))


_REFERENCES = """WITH r AS (SELECT CAST(conv_id + 100 AS VARCHAR) AS row_key, string_agg(DISTINCT role, ';' ORDER BY role) AS refs
  FROM conversations GROUP BY 1)
"""


@query(
    "I9_append_references",
    _REFERENCES + """SELECT coalesce(r.row_key, CAST(d.doc_id AS VARCHAR)) AS row_key, d.source, r.refs
FROM documents d FULL JOIN r ON CAST(d.doc_id AS VARCHAR) = r.row_key""",
)
def append_references(spark, folder):
    once = I.append_references(docs(spark, folder), turn_references(spark, folder))[0]
    twice = I.append_references(once, turn_references(spark, folder))[0]
    return twice.select("row_key", F.col("src.name").alias("source"), F.array_join("text.reference", ";").alias("refs"))


@query(
    "I9_existed",
    _REFERENCES + "SELECT row_key, row_key IN (SELECT CAST(doc_id AS VARCHAR) FROM documents) AS existed FROM r",
)
def references_existed(spark, folder):
    return I.append_references(docs(spark, folder), turn_references(spark, folder))[1]


@query("I10_ingest_date", f"SELECT {KEY}, '2024-02-03T04:05:06Z' AS ingest_date FROM documents")
def ingest_date(spark, folder):
    return I.with_ingest_date(docs(spark, folder), RUN_TIME).select("row_key", F.col("meta")["ingestDate"].alias("ingest_date"))


_DOC_CELLS = r"""WITH d AS (SELECT *, CAST(doc_id AS VARCHAR) AS row_key FROM documents)
SELECT row_key, 'src' AS family, 'name' AS qualifier, source AS value FROM d
UNION ALL SELECT row_key, 'src', 'id', row_key FROM d
UNION ALL SELECT row_key, 'text', 'raw', text FROM d
UNION ALL SELECT row_key, 'meta', 'lang', lang FROM d
UNION ALL SELECT row_key, 'meta', 'n_chars', CAST(n_chars AS VARCHAR) FROM d
UNION ALL SELECT row_key, 'meta', 'tags', lang || chr(9) || ' ' || source || chr(9) || chr(9) FROM d WHERE lang <> 'de'
UNION ALL SELECT row_key, 'meta', 'PublicationYear', CAST(doc_id % 20 + 1987 AS VARCHAR) FROM d
UNION ALL SELECT row_key, 'meta', 'PublicationMonth', CAST(doc_id % 12 + 1 AS VARCHAR) FROM d
UNION ALL SELECT row_key, 'meta', 'PublicationDayOfMonth', CAST(doc_id % 28 + 1 AS VARCHAR) FROM d
UNION ALL SELECT row_key, 'meta', 'OnlineSection', lang FROM d WHERE lang <> 'es'"""


@query("I14_write_documents", _DOC_CELLS)
def write_documents(spark, folder):
    return docs_to_cells(docs(spark, folder)).select(*CELL_COLUMNS)


@query("I14_round_trip", _DOC_CELLS)
def round_trip(spark, folder):
    """cells to docs and back."""
    return docs_to_cells(cells_to_docs(docs_to_cells(docs(spark, folder)))).select(*CELL_COLUMNS)


@query(
    "I14_annotations_round_trip",
    r"""SELECT CAST(doc_id AS VARCHAR) AS row_key, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS BIGINT) AS n_token,
  CAST(len(regexp_extract_all(text, ',')) AS BIGINT) AS n_dep FROM documents""",
)
def annotations_round_trip(spark, folder):
    back = cells_to_docs(docs_to_cells(docs(spark, folder, "token", "dep")))
    return back.select(
        "row_key", *[F.size(P.annotation_set(s)).cast("bigint").alias(f"n_{s}") for s in ("token", "dep")]
    )


# -- scalar functions --------------------------------------------------------


@query(
    "F1_field_value",
    f"SELECT {KEY}, lang AS bare, source AS of_src, text AS of_text, CAST(NULL AS VARCHAR) AS absent FROM documents",
)
def field_value(spark, folder):
    return docs(spark, folder).select(
        "row_key",
        U.field_value("lang").alias("bare"),
        U.field_value("src:name").alias("of_src"),
        U.field_value("text:raw").alias("of_text"),
        U.field_value("nothing").alias("absent"),
    )


@query("F2_raw_text", f"SELECT {KEY}, CASE WHEN lang = 'es' THEN '' ELSE text END AS raw FROM documents")
def raw_text(spark, folder):
    without = docs(spark, folder).withColumn(
        "text", F.col("text").withField("raw", F.when(F.col("meta.lang") != "es", F.col("text.raw")))
    )
    return without.select("row_key", X.raw_text().alias("raw"))


@query(
    "F3_span_text",
    f"SELECT {KEY}, substring(text, 11, 90) AS inside, substring(text, CAST(length(text) // 2 + 1 AS BIGINT), 1000000) AS clamped FROM documents",
)
def span_text(spark, folder):
    text, half = F.col("text.raw"), F.floor(F.length("text.raw") / 2).cast("int")
    return docs(spark, folder).select(
        "row_key",
        X.span_of(text, F.lit(10), F.lit(100)).alias("inside"),
        X.span_of(text, half, half + 1000000).alias("clamped"),
    )


@query(
    "F3_span_texts",
    r"""SELECT CAST(doc_id AS VARCHAR) AS row_key, unnest(l) AS covered, unnest(range(len(l))) AS id FROM (
  SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS l FROM documents)""",
)
def span_texts(spark, folder):
    tokens = docs(spark, folder, "token")
    texts = P.span_texts(F.col("text.raw"), P.annotation_set("token"))
    return tokens.select("row_key", F.posexplode(texts).alias("id", "covered")).withColumn("id", F.col("id").cast("bigint"))


@query(
    "F4_clean_span",
    r"""SELECT CAST(doc_id AS VARCHAR) AS row_key, regexp_replace(regexp_replace(
  regexp_replace(trim('  "([-' || text, chr(10) || ' '), '\s+', ' ', 'g'), '\A[\s"''`\[\(\-]+', ''), '\W+\z', '') AS cleaned FROM documents""",
)
def clean_span(spark, folder):
    return docs(spark, folder).select(
        "row_key", X.clean_span(F.concat(F.lit('  "([-'), F.col("text.raw"))).alias("cleaned")
    )


@query(
    "F5_tab_values",
    """SELECT CAST(doc_id AS VARCHAR) AS row_key, CASE WHEN lang = 'de' THEN '' ELSE lang || '|' || source END AS parts,
  CASE WHEN lang = 'de' THEN 1 ELSE 2 END AS n FROM documents""",
)
def tab_values(spark, folder):
    cell = cells(spark, folder).where((F.col("family") == "meta") & (F.col("qualifier") == "tags"))
    values = X.tab_values(F.col("value"))
    return cell.select("row_key", F.array_join(values, "|").alias("parts"), F.size(values).alias("n"))


@query(
    "F6_tab_joined",
    r"""SELECT CAST(doc_id AS VARCHAR) AS row_key, trim(array_to_string(list_transform(list_sort(string_split(text, chr(10))),
  lambda x: regexp_replace(x, '\s+', ' ', 'g')), chr(9)), chr(9) || ' ' || chr(10)) AS joined FROM documents""",
)
def tab_joined(spark, folder):
    return docs(spark, folder).select("row_key", X.tab_joined(F.split("text.raw", "\n")).alias("joined"))


@query(
    "F7_normalized",
    r"""SELECT CAST(doc_id AS VARCHAR) AS row_key, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS normalized,
  trim(regexp_replace(text, '\s+', ' ', 'g')) AS cleaned FROM documents""",
)
def normalized(spark, folder):
    return docs(spark, folder).select(
        "row_key", X.normalized(F.col("text.raw")).alias("normalized"), X.clean_text(F.col("text.raw")).alias("cleaned")
    )


@query(
    "F8_time_argument",
    """SELECT event_id, epoch_ms(date_trunc('year', ts)) AS y, epoch_ms(date_trunc('month', ts)) AS mo,
  epoch_ms(date_trunc('day', ts)) AS d, epoch_ms(date_trunc('hour', ts)) AS h, epoch_ms(date_trunc('minute', ts)) AS mi,
  epoch_ms(date_trunc('second', ts)) AS s, epoch_us(ts) // 1000 AS ms FROM events""",
)
def time_argument(spark, folder):
    ts = F.col("ts").cast("timestamp")
    written = {
        "y": "yyyy", "mo": "yyyy-MM", "d": "yyyy-MM-dd", "h": "yyyy-MM-dd-HH",
        "mi": "yyyy-MM-dd-HH-mm", "s": "yyyy-MM-dd-HH-mm-ss",
    }
    return table(spark, folder, "events").select(
        "event_id",
        *[X.time_millis(F.date_format(ts, p)).alias(n) for n, p in written.items()],
        X.time_millis(F.unix_millis(ts).cast("string")).alias("ms"),
    )


@query("F9_iso_date", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def iso_date(spark, folder):
    return table(spark, folder, "events").select("event_id", X.iso_date(F.col("ts").cast("timestamp")).alias("iso"))


@query("F10_sha1", "SELECT doc_id, sha1(text) AS digest FROM documents")
def sha1(spark, folder):
    return documents(spark, folder).select("doc_id", X.sha1_key(F.col("text")).alias("digest"))


@query(
    "F11_comma_joined",
    "SELECT CAST(doc_id AS VARCHAR) AS row_key, least(lang, source) || ', ' || greatest(lang, source) AS joined FROM documents",
)
def comma_joined(spark, folder):
    return docs(spark, folder).select(
        "row_key", X.comma_joined(F.array("src.name", "meta.lang", "src.name")).alias("joined")
    )


@query(
    "F12_contains_ignoring_case",
    "SELECT doc_id, contains(lower(text), lower('THE ' || lang)) OR contains(lower(text), 'tion of') AS found FROM documents",
)
def contains_ignoring_case(spark, folder):
    text = F.col("text")
    either = X.contains_ignoring_case(text, F.concat(F.lit("THE "), "lang")) | X.contains_ignoring_case(text, F.lit("TION OF"))
    return documents(spark, folder).select("doc_id", either.alias("found"))


@query(
    "F13_length_and_equality",
    "SELECT CAST(doc_id AS VARCHAR) AS row_key, length(text) AS n, doc_id IN (SELECT doc_id FROM labels) AS labelled FROM documents",
)
def length_and_equality(spark, folder):
    """Equal documents are those with the same key, whatever else they hold."""
    keys = table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("row_key"), F.lit(True).alias("hit"))
    return (
        docs(spark, folder)
        .join(keys.distinct(), "row_key", "left")
        .select("row_key", X.text_length(F.col("text.raw")).cast("bigint").alias("n"), F.coalesce("hit", F.lit(False)).alias("labelled"))
    )


@query(
    "F_span_json",
    f"""SELECT row_key, '{{"value":"' || w || '","start":' || CAST(s AS VARCHAR) || ',"end":' || CAST(e AS VARCHAR) || '}}' AS json
FROM {spans_sql(WORD)}""",
)
def span_json(spark, folder):
    """Every token of every text."""
    tokens = docs(spark, folder, "token")
    read = computed(tokens, "covered", P.span_texts(F.col("text.raw"), P.annotation_set("token")))
    pair = F.zip_with(P.annotation_set("token"), "covered", lambda s, t: F.struct(s.alias("s"), t.alias("t")))
    rows = read.select("row_key", F.explode(pair).alias("p"))
    return rows.select("row_key", P.span_json(F.col("p.t"), F.col("p.s.start"), F.col("p.s.end")).alias("json"))
