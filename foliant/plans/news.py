"""Queries N1-N11: the documents written as news articles in XML and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.markup import all_text, guarded, replaced
from foliant.model import empty_annotations, meta_map, src_struct, text_struct
from foliant.operators import newsxml as N
from foliant.operators.rows import computed
from foliant.plans.registry import query
from foliant.plans.tables import documents, spread, table

HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE nitf SYSTEM '
    '"http://www.nitf.org/IPTC/NITF/3.3/specification/dtd/nitf-3-3.dtd">\n<nitf><head><title>x</title>'
)
# One template for every article; {name} stands for a column of ``_values``.
TEMPLATE = (
    HEAD + '<meta name="dsk" content="{source} &amp; {lang}"/><meta name="dsk"/>'
    '<meta name="publication_day_of_month" content="{day}"/><meta name="publication_month" content="{month}"/>'
    '<meta name="publication_year" content="{year}"/><meta name="publication_day_of_week" content="Tuesday"/>'
    '<meta name="print_page_number" content="{page}"/><meta name="print_section" content="{lang}"/>'
    '<meta name="online_sections" content="{source}; {lang}"/><meta name="print_column" content=" 3 "/>'
    '<meta name="slug" content="{lang}-{doc_id}"/><meta name="alternate_url" content="{alternate}"/>'
    '<meta name="correction_date" content="20050607T080910"/><meta name="banner" content="  "/>'
    '<docdata><doc-id id-string="{guid}"/><series series.name="Series {lang}"/><identified-content>'
    '<classifier class="indexing_service" type="descriptor">{lang}   descriptor</classifier>'
    '<classifier class="online_producer" type="descriptor">{source}</classifier>'
    '<classifier class="online_producer" type="general_descriptor">General {lang}</classifier>'
    '<classifier class="online_producer" type="general_descriptor">All</classifier>'
    '<classifier class="online_producer" type="taxonomic_classifier">Top/News/{source}</classifier>'
    '<classifier class="online_producer" type="types_of_material">Text</classifier>'
    '<classifier class="indexing_service" type="names">Name &lt;{source}&gt;</classifier>'
    '<classifier class="elsewhere" type="names">nobody</classifier>'
    '<org class="indexing_service">Org <b>{lang}</b></org><org class="online_producer">Org {lang}</org>'
    '<person class="indexing_service">Person {source}</person><person class="online_producer">Another {source}</person>'
    '<location class="online_producer">City of {lang}</location><object.title class="indexing_service"/>'
    "</identified-content></docdata>"
    '<pubdata date.publication="{stamp}" ex-ref="http://news.example/{doc_id}" item-length="{n_chars}" name="Wire"/></head>'
    "<body><body.head><hedline><hl1>{first}</hl1><hl2 class='online_headline'>On <em>{lang}</em> line {source}</hl2></hedline>"
    '<byline class="print_byline">By {source}</byline><byline class="normalized_byline">{source}, By</byline>'
    "<dateline>{lang} city</dateline><abstract><p>first</p><p>About <i>{source}</i>.</p></abstract></body.head><body.content>"
    '<block class="lead_paragraph"><p>LEAD: {first}</p></block><block class="correction_text"><p/></block>'
    "{body}</body.content><body.end><tagline class=\"author_info\">Writes for {source}</tagline></body.end></body></nitf>"
)


def escaped(text: Column) -> Column:
    return replaced(text, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")])


def filled(template: str, values: dict[str, Column]) -> Column:
    """The template with every {name} replaced by its column."""
    parts, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [F.lit(before), values[name].cast("string")]
    return F.concat(*parts, F.lit(rest))


def _values() -> dict[str, Column]:
    doc_id, lang = F.col("doc_id"), F.col("lang")
    lines = F.replace(escaped(F.col("text")), F.lit("\n"), F.lit("</p>\n<p>"))
    body = F.concat(F.lit('<block class="full_text"><p>'), lines, F.lit("</p></block>"))
    at = F.timestamp_seconds(doc_id * 3600 + 1118102400)
    return {
        "doc_id": doc_id,
        "lang": lang,
        "source": F.col("source"),
        "n_chars": F.col("n_chars"),
        "day": doc_id % 28 + 1,
        "month": doc_id % 12 + 1,
        "year": doc_id % 20 + 1987,
        "page": F.concat(F.when(lang == "de", "A").otherwise(""), F.col("n_chars").cast("string")),
        "alternate": F.when(lang == "de", "not a url").otherwise(F.concat(F.lit("http://alt.example/"), doc_id.cast("string"))),
        "guid": doc_id + 1,
        "stamp": F.date_format(at, "yyyyMMdd'T'HHmmss"),
        "first": escaped(F.substring_index("text", "\n", 1)),
        "body": body,
    }


def news_docs(spark, folder, damaged: bool = False) -> DataFrame:
    """Articles of the source NYT and, for French, of another. Damaged: one source
    is cut short and not well-formed; very short documents have no text."""
    base = spread(documents(spark, folder), "doc_id")
    made = computed(base, "xml", filled(TEMPLATE, _values()))
    xml = F.col("xml")
    cut = F.when(F.col("source") == "src13", F.substring(xml, F.lit(1), F.length(xml) - 30)).otherwise(xml)
    key = F.col("doc_id").cast("string")
    return made.select(
        key.alias("row_key"),
        src_struct(name=F.when(F.col("lang") == "fr", "other").otherwise("NYT"), id=key).alias("src"),
        meta_map(lang=F.col("lang")).alias("meta"),
        text_struct(orig=F.when(F.col("n_chars") >= 100, cut) if damaged else xml).alias("text"),
        empty_annotations().alias("annotations"),
    )


_FIELDS = """WITH written AS (
  SELECT *, CAST(doc_id AS VARCHAR) AS row_key, TIMESTAMP '2005-06-07 00:00:00' + to_hours(doc_id) AS at_time,
    trim(split_part(text, chr(10), 1)) AS first_line FROM documents),
fields AS (SELECT row_key, lang,
  source || ' & ' || lang AS "NewsDesk", source || '; ' || lang AS "OnlineSection", lang AS "Section",
  lang || '-' || row_key AS "Slug", '  ' AS "Banner", 'Tuesday' AS "DayOfWeek",
  CASE WHEN lang <> 'de' THEN CAST(n_chars AS INTEGER) END AS "Page", CAST(doc_id % 28 + 1 AS INTEGER) AS "PublicationDayOfMonth",
  CAST(doc_id % 12 + 1 AS INTEGER) AS "PublicationMonth", CAST(doc_id % 20 + 1987 AS INTEGER) AS "PublicationYear", CAST(3 AS INTEGER) AS "ColumnNumber",
  CASE WHEN lang <> 'de' THEN 'http://alt.example/' || row_key END AS "AlternateURL",
  'Tue Jun 07 08:09:10 UTC 2005' AS "CorrectionDate",
  strftime(at_time, '%a %b %d %H:%M:%S UTC %Y') AS "PublicationDate", 'http://news.example/' || row_key AS "Url",
  CAST(n_chars AS INTEGER) AS "WordCount", 'Wire' AS "Credit", CAST(doc_id + 1 AS INTEGER) AS "Guid", 'Series ' || lang AS "Kicker",
  first_line AS "Headline", 'On ' || lang || ' line ' || source AS "OnlineHeadline", 'By ' || source AS "Byline",
  source || ', By' AS "NormalizedByline", lang || ' city' AS "Dateline", 'About ' || source || ' .' AS "ArticleAbstract",
  'Writes for ' || source AS "AuthorBiography", trim('LEAD: ' || first_line) AS "LeadParagraph",
  CAST(NULL AS VARCHAR) AS "CorrectionText", CAST(NULL AS VARCHAR) AS "OnlineLeadParagraph",
  CAST(NULL AS VARCHAR) AS "FeaturePage", CAST(NULL AS VARCHAR) AS "ColumnName", CAST(NULL AS VARCHAR) AS "SeriesName",
  nullif(array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x)), chr(10)), '') AS "Body",
  '[General ' || lang || ', All]' AS "GeneralOnlineDescriptors",
  lang || '   descriptor' AS "Descriptors", source AS "OnlineDescriptors", 'Top/News/' || source AS "TaxonomicClassifiers",
  'Text' AS "TypesOfMaterial", 'Name <' || source || '>' AS "Names", 'Org ' || lang AS "Organizations",
  'Org ' || lang AS "OnlineOrganizations", 'Person ' || source AS "People", 'Another ' || source AS "OnlinePeople",
  'City of ' || lang AS "OnlineLocations" FROM written)
"""
_MERGED = """, merged AS (SELECT row_key,
  "Organizations" || chr(10) AS "NYT_Organizations", "OnlinePeople" || chr(10) || "People" || chr(10) AS "NYT_People",
  "OnlineLocations" || chr(10) AS "NYT_Locations", "Names" || chr(10) AS "NYT_Names",
  "TypesOfMaterial" || chr(10) AS "typesOfMaterial", "TaxonomicClassifiers" || chr(10) AS "TaxonomicClassifiers",
  least(lang || ' descriptor', "OnlineDescriptors") || chr(10) || greatest(lang || ' descriptor', "OnlineDescriptors") || chr(10) AS "Descriptors"
  FROM fields)
"""
# Merged lists of the articles that have values, in any order.
_MERGED_KEYS = (
    "NYT_Organizations", "NYT_People", "NYT_Locations", "NYT_Names", "typesOfMaterial",
    "TaxonomicClassifiers", "Descriptors",
)


def _quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


def _read(spark, folder, names) -> DataFrame:
    return N.articles(news_docs(spark, folder), names).select("row_key", *names)


HEAD_NAMES = (*N.TEXT_META.values(), *N.INT_META.values(), "AlternateURL")


@query("N2_head_fields", _FIELDS + f'SELECT row_key, {_quoted(HEAD_NAMES)}, "CorrectionDate" FROM fields')
def head_fields(spark, folder):
    found = _read(spark, folder, [*HEAD_NAMES, "CorrectionDate"])
    return found.withColumn("CorrectionDate", N.field_text("CorrectionDate"))


@query("N3_publication_fields", _FIELDS + 'SELECT row_key, "PublicationDate", "Url", "WordCount", "Credit" FROM fields')
def publication_fields(spark, folder):
    found = _read(spark, folder, ["PublicationDate", "Url", "WordCount", "Credit"])
    return found.withColumn("PublicationDate", N.field_text("PublicationDate"))


@query("N4_identity_fields", _FIELDS + 'SELECT row_key, "Guid", "Kicker" FROM fields')
def identity_fields(spark, folder):
    return _read(spark, folder, ["Guid", "Kicker"])


_LISTS = tuple(N.CONTENT_LISTS)
_LIST_SQL = {
    "GeneralOnlineDescriptors": "'General ' || lang || '|All'",
    "BiographicalCategories": "''",
    "Locations": "''",
    "Titles": "''",
    "OnlineTitles": "''",
}


@query(
    "N5_identified_content",
    _FIELDS + "SELECT row_key, " + ", ".join(f'{_LIST_SQL.get(n, chr(34) + n + chr(34))} AS "{n}"' for n in _LISTS)
    + ", 1 AS n_titles FROM fields",
)
def identified_content(spark, folder):
    found = _read(spark, folder, _LISTS)
    return found.select(
        "row_key", *[F.array_join(n, "|").alias(n) for n in _LISTS], F.size("Titles").alias("n_titles")
    )


BODY_NAMES = ("Headline", "OnlineHeadline", "Byline", "NormalizedByline", "Dateline", "ArticleAbstract", "AuthorBiography")


@query("N6_body_fields", _FIELDS + f"SELECT row_key, {_quoted(BODY_NAMES)} FROM fields")
def body_fields(spark, folder):
    return _read(spark, folder, BODY_NAMES)


BLOCK_NAMES = tuple(N.BLOCKS.values())


@query("N7_blocks", _FIELDS + f"SELECT row_key, {_quoted(BLOCK_NAMES)} FROM fields")
def blocks(spark, folder):
    return _read(spark, folder, BLOCK_NAMES)


@query(
    "N8_all_text",
    """SELECT page_id, trim(array_to_string(list_transform(list_filter(regexp_split_to_array(html, '<[^>]*>'), lambda x: x <> ''),
  lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), ' ')) AS text FROM pages""",
)
def page_text(spark, folder):
    return table(spark, folder, "pages").select("page_id", all_text(guarded(F.col("html"))).alias("text"))


@query(
    "N9_merged_lists",
    _FIELDS + _MERGED + f"SELECT row_key, key, value FROM (UNPIVOT merged ON {_quoted(_MERGED_KEYS)} INTO NAME key VALUE value)"
    " WHERE value IS NOT NULL",
)
def merged_lists(spark, folder):
    found = _read(spark, folder, _LISTS)
    entries = F.explode(
        F.array(*[F.struct(F.lit(k).alias("key"), N.merged_list(l).alias("value")) for k, l in N.MERGED_LISTS.items()])
    )
    # An empty title element is a value of no characters.
    return found.select("row_key", entries.alias("e")).select("row_key", "e.key", "e.value").where(
        F.col("value").isNotNull() & (F.col("value") != "\n")
    )


_TEXTS = ", ".join(f'CAST("{n}" AS VARCHAR) AS "{n}"' for n in N.SINGLE_FIELDS)
_SINGLE = f", texts AS (SELECT row_key, {_TEXTS} FROM fields)\n"
_META = (
    _FIELDS + _MERGED + _SINGLE
    + f""", meta AS (
  SELECT row_key, key, value FROM (UNPIVOT merged ON {_quoted(_MERGED_KEYS)} INTO NAME key VALUE value)
  UNION ALL SELECT row_key, key, value FROM (UNPIVOT texts ON {_quoted(N.SINGLE_FIELDS)} INTO NAME key VALUE value)
  UNION ALL SELECT row_key, 'guid', CAST("Guid" AS VARCHAR) FROM fields
  UNION ALL SELECT row_key, 'lang', lang FROM fields)
"""
)


@query(
    "N10_metadata",
    _META + "SELECT row_key, key, value FROM meta JOIN documents ON row_key = CAST(doc_id AS VARCHAR)"
    " WHERE documents.lang <> 'fr' AND value IS NOT NULL AND trim(value) <> ''",
)
def metadata(spark, folder):
    return N.parse_articles(news_docs(spark, folder), "NYT").select("row_key", F.explode("meta").alias("key", "value"))


@query("N1_parse_articles", _FIELDS + """SELECT row_key, "Body" AS raw FROM fields WHERE lang <> 'fr'""")
def parse_articles(spark, folder):
    return N.parse_articles(news_docs(spark, folder), "NYT").select("row_key", F.col("text.raw").alias("raw"))


@query("N1_rejected", "SELECT CAST(doc_id AS VARCHAR) AS row_key FROM documents WHERE n_chars >= 100 AND source = 'src13'")
def rejected(spark, folder):
    return N.rejected(news_docs(spark, folder, damaged=True)).select("row_key")


@query(
    "N1_skip_counts",
    """SELECT 'Parse NYT' AS counter_group, CASE WHEN lang = 'fr' THEN 'skip -- wrong source: other'
  WHEN n_chars < 100 THEN 'skip -- null text' ELSE 'map' END AS counter, count(*) AS n FROM documents GROUP BY 2""",
)
def skip_counts(spark, folder):
    return N.skip_counts(news_docs(spark, folder, damaged=True), "NYT")


@query(
    "N11_parse_audit",
    _FIELDS + _SINGLE + f""", unpivoted AS (
  SELECT key, value FROM texts UNPIVOT INCLUDE NULLS (value FOR key IN ({_quoted(N.SINGLE_FIELDS)}))),
r AS (
  SELECT 'add' AS counter_group, key AS counter, count(*) AS n FROM unpivoted WHERE trim(value) <> '' GROUP BY key
  UNION ALL SELECT 'null val', key, count(*) FROM unpivoted WHERE value IS NULL GROUP BY key
  UNION ALL SELECT 'empty val', key, count(*) FROM unpivoted WHERE trim(value) = '' GROUP BY key
  UNION ALL SELECT 'add', 'guid', count(*) FROM fields
  UNION ALL SELECT 'add', '--Body--', count("Body") FROM fields
  UNION ALL SELECT 'skip (null)', '--Body--', count(*) FILTER ("Body" IS NULL) FROM fields
  UNION ALL SELECT 'add collection list', unnest([{", ".join(f"'{k}'" for k in (*_MERGED_KEYS, "titles"))}]), (SELECT count(*) FROM fields))
SELECT counter_group, counter, n FROM r WHERE n > 0""",
)
def parse_audit(spark, folder):
    return N.parse_audit(N.articles(news_docs(spark, folder)))
