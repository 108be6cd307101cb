"""Fields of news articles in XML, parsed once per row by ``from_xml``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.markup import CORRUPT, XML_OPTIONS, all_text, attribute, plain, protected, with_tree
from foliant.functions.text import is_blank
from foliant.model import META_TYPE
from foliant.operators.annotate import merge_metadata
from foliant.operators.rows import computed, long_result

# Elements with both text and attributes.
TEXT_ELEMENTS = ("byline", "hl2", "tagline", "classifier", "location", "object.title", "org", "person")

_TEXTS = ",".join(f"`{n}`: array<string>" for n in TEXT_ELEMENTS[3:])

ARTICLE_DDL = f"""
head struct<
  meta: array<struct<_name: string, _content: string>>,
  docdata: array<struct<
    `doc-id`: array<struct<`_id-string`: string>>,
    series: array<struct<`_series.name`: string>>,
    `identified-content`: array<struct<{_TEXTS}>>>>,
  pubdata: array<struct<
    `_date.publication`: string, `_ex-ref`: string, `_item-length`: string, _name: string>>>,
body struct<
  `body.head`: array<struct<
    hedline: array<struct<hl1: array<string>, hl2: array<string>>>,
    byline: array<string>, dateline: array<string>, abstract: array<struct<p: array<string>>>>>,
  `body.content`: array<struct<block: array<struct<_class: string, p: array<string>>>>>,
  `body.end`: array<struct<tagline: array<string>>>>,
{CORRUPT} string
"""

# Meta name -> field, by type of the content.
TEXT_META = {
    "dsk": "NewsDesk",
    "online_sections": "OnlineSection",
    "print_section": "Section",
    "slug": "Slug",
    "banner": "Banner",
    "feature_page": "FeaturePage",
    "column_name": "ColumnName",
    "series_name": "SeriesName",
    "publication_day_of_week": "DayOfWeek",
}
INT_META = {
    "print_column": "ColumnNumber",
    "print_page_number": "Page",
    "publication_day_of_month": "PublicationDayOfMonth",
    "publication_month": "PublicationMonth",
    "publication_year": "PublicationYear",
}

# Identified content -> list field, by element, class and type.
CONTENT_LISTS = {
    "Descriptors": ("classifier", "indexing_service", "descriptor"),
    "BiographicalCategories": ("classifier", "indexing_service", "biographical_categories"),
    "Names": ("classifier", "indexing_service", "names"),
    "OnlineDescriptors": ("classifier", "online_producer", "descriptor"),
    "GeneralOnlineDescriptors": ("classifier", "online_producer", "general_descriptor"),
    "TaxonomicClassifiers": ("classifier", "online_producer", "taxonomic_classifier"),
    "TypesOfMaterial": ("classifier", "online_producer", "types_of_material"),
    "Locations": ("location", "indexing_service", None),
    "OnlineLocations": ("location", "online_producer", None),
    "Titles": ("object.title", "indexing_service", None),
    "OnlineTitles": ("object.title", "online_producer", None),
    "Organizations": ("org", "indexing_service", None),
    "OnlineOrganizations": ("org", "online_producer", None),
    "People": ("person", "indexing_service", None),
    "OnlinePeople": ("person", "online_producer", None),
}

# Block class -> field.
BLOCKS = {
    "full_text": "Body",
    "lead_paragraph": "LeadParagraph",
    "online_lead_paragraph": "OnlineLeadParagraph",
    "correction_text": "CorrectionText",
}

# Metadata keys of merged lists.
MERGED_LISTS = {
    "NYT_Organizations": ("Organizations", "OnlineOrganizations"),
    "NYT_People": ("OnlinePeople", "People"),
    "NYT_Locations": ("Locations", "OnlineLocations"),
    "NYT_Names": ("Names",),
    "titles": ("Titles", "OnlineTitles"),
    "typesOfMaterial": ("TypesOfMaterial",),
    "TaxonomicClassifiers": ("TaxonomicClassifiers",),
    "Descriptors": ("Descriptors", "OnlineDescriptors"),
    "BiographicalCategories": ("BiographicalCategories",),
}

# Fields copied one to one into metadata.
SINGLE_FIELDS = (
    "AlternateURL", "ArticleAbstract", "AuthorBiography", "Banner", "Byline", "ColumnName",
    "ColumnNumber", "CorrectionDate", "CorrectionText", "Credit", "Dateline", "DayOfWeek",
    "FeaturePage", "GeneralOnlineDescriptors", "Headline", "Kicker", "LeadParagraph", "NewsDesk",
    "NormalizedByline", "OnlineHeadline", "OnlineLeadParagraph", "OnlineSection", "Page",
    "PublicationDate", "PublicationDayOfMonth", "PublicationMonth", "PublicationYear", "Section",
    "SeriesName", "Slug", "Url", "WordCount",
)

DATE_FORMAT = "yyyyMMdd'T'HHmmss"
DATE_TEXT = "EEE MMM dd HH:mm:ss 'UTC' yyyy"
URL_PATTERN = r"^(?i:https?|ftp|file|jar|mailto):"


def _children(root: str, *names: str) -> str:
    """SQL for the descendants along the names, over all parents, in order."""
    for name in names:
        root = f"flatten(filter(transform({root}, p -> p.`{name}`), c -> c is not null))"
    return root


def _last(items: str, test: str) -> str:
    """SQL for the last item that passes; null if there is none."""
    return f"try_element_at(filter({items}, x -> {test}), -1)"


def _date(text: str) -> str:
    return f"try_to_timestamp({text}, \"{DATE_FORMAT}\")"


def _url(text: str) -> str:
    return f"case when rlike({text}, r'{URL_PATTERN}') then {text} end"


def _int(text: str) -> str:
    return f"try_cast(trim({text}) as int)"


def parsed(docs: DataFrame) -> DataFrame:
    """Well-formed rows with the XML tree in one struct column ``nitf``."""
    return with_tree(docs, protected(F.col("text.orig"), TEXT_ELEMENTS), ARTICLE_DDL, "nitf")


def rejected(docs: DataFrame) -> DataFrame:
    """Rows whose text is no well-formed XML, with the text."""
    tree = F.from_xml(
        protected(F.col("text.orig"), TEXT_ELEMENTS), f"{CORRUPT} string", XML_OPTIONS
    )
    bad = docs.where(F.col("text.orig").isNotNull() & tree[CORRUPT].isNotNull())
    return bad.select("row_key", F.col("text.orig").alias("orig"))


# Where each text element is found below the root.
_PLACES = {
    "hl2": ("nitf.body.`body.head`", "hedline"),
    "byline": ("nitf.body.`body.head`",),
    "tagline": ("nitf.body.`body.end`",),
}


def _nodes(wanted: set[str]) -> Column:
    """The tree as flat lists of plain values, one list per wanted kind of node."""
    body, docdata = "nitf.body.`body.head`", "nitf.head.docdata"

    def elements(name: str) -> str:
        found = _children(*_PLACES.get(name, (docdata, "identified-content")), name)
        return f"coalesce(transform({found}, x -> struct('{name}' as element, x as markup)), array())"

    def strings(sql: str, read) -> Column:
        return F.transform(F.expr(sql), read)

    lists = (
        F.transform(
            "nitf.head.meta", lambda m: F.struct(m["_name"].alias("name"), plain(m["_content"]).alias("content"))
        ).alias("meta"),
        F.transform(
            "nitf.head.pubdata",
            lambda p: F.struct(
                plain(p["_date.publication"]).alias("date"),
                plain(p["_ex-ref"]).alias("ref"),
                p["_item-length"].alias("length"),
                plain(p["_name"]).alias("name"),
            ),
        ).alias("pubdata"),
        strings(_children(docdata, "doc-id"), lambda d: d["_id-string"]).alias("ids"),
        strings(_children(docdata, "series"), lambda s: plain(s["_series.name"])).alias("series"),
        strings(
            f"concat({', '.join(elements(n) for n in TEXT_ELEMENTS)})",
            lambda x: F.struct(
                x["element"].alias("element"),
                attribute(x["markup"], "class").alias("class"),
                attribute(x["markup"], "type").alias("type"),
                all_text(x["markup"]).alias("text"),
            ),
        ).alias("texts"),
        strings(_children(body, "hedline", "hl1"), all_text).alias("hl1"),
        strings(_children(body, "dateline"), all_text).alias("dateline"),
        strings(_children(body, "abstract", "p"), all_text).alias("abstract"),
        strings(
            _children("nitf.body.`body.content`", "block"),
            lambda b: F.struct(
                plain(b["_class"]).alias("class"), F.array_join(F.transform(b["p"], all_text), "\n").alias("text")
            ),
        ).alias("block"),
    )
    # A list's name is its alias.
    names = ("meta", "pubdata", "ids", "series", "texts", "hl1", "dateline", "abstract", "block")
    return F.struct(*[column for name, column in zip(names, lists) if name in wanted])


def head_fields() -> dict[str, str]:
    """N2. An unreadable value leaves the one before it in place."""

    def value(name: str, read=str) -> str:
        found = _last("n.meta", f"x.name = '{name}' and {read('x.content')} is not null")
        return read(f"{found}.content")

    fields = {field: value(name) for name, field in TEXT_META.items()}
    fields |= {field: value(name, _int) for name, field in INT_META.items()}
    return fields | {
        "AlternateURL": value("alternate_url", _url),
        "CorrectionDate": value("correction_date", _date),
    }


def publication_fields() -> dict[str, str]:
    """N3."""

    def value(name: str, read=str) -> str:
        found = _last("n.pubdata", f"{read('x.' + name)} is not null")
        return read(f"{found}.{name}")

    return {
        "PublicationDate": value("date", _date),
        "Url": value("ref", _url),
        "WordCount": value("length", _int),
        "Credit": value("name"),
    }


def identity_fields() -> dict[str, str]:
    """N4."""
    return {
        "Guid": _int(_last("n.ids", f"{_int('x')} is not null")),
        "Kicker": "try_element_at(n.series, -1)",
    }


def _is(element: str, of_class: str, of_type: str | None = None) -> str:
    test = f"x.element = '{element}' and x.class = '{of_class}'"
    return test if of_type is None else f"{test} and x.type = '{of_type}'"


def content_fields() -> dict[str, str]:
    """Lists of identified content; empty lists, never null."""
    return {
        field: f"transform(filter(n.texts, x -> {_is(*rule)}), x -> x.text)" for field, rule in CONTENT_LISTS.items()
    }


def body_fields() -> dict[str, str]:
    """Where an element repeats, the last one stands."""

    def text(element: str, of_class: str) -> str:
        return _last("n.texts", _is(element, of_class)) + ".text"

    return {
        "Headline": "try_element_at(n.hl1, -1)",
        "OnlineHeadline": text("hl2", "online_headline"),
        "Byline": text("byline", "print_byline"),
        "NormalizedByline": text("byline", "normalized_byline"),
        "Dateline": "try_element_at(n.dateline, -1)",
        "ArticleAbstract": "try_element_at(n.abstract, -1)",
        "AuthorBiography": text("tagline", "author_info"),
    }


def block_fields() -> dict[str, str]:
    """Paragraphs of the last block of a class, newline-joined; empty is null."""
    return {field: f"nullif({_last('n.block', f"x.class = '{name}'")}.text, '')" for name, field in BLOCKS.items()}


def articles(docs: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One typed column per article field, all or the named ones, for
    well-formed rows.

    Tree, node lists and fields are each computed once per row, and only the
    lists that the wanted fields are taken from.
    """
    fields = head_fields() | publication_fields() | identity_fields()
    fields |= content_fields() | body_fields() | block_fields()
    if names is not None:
        fields = {f: fields[f] for f in names}
    lists = {name for sql in fields.values() for name in re.findall(r"\bn\.(\w+)", sql)}
    nodes = computed(parsed(docs), "n", _nodes(lists))
    article = computed(nodes, "article", F.struct(*[F.expr(sql).alias(f) for f, sql in fields.items()]))
    return article.select(*docs.columns, *[F.col(f"article.{f}") for f in fields])


def merged_list(lists: Sequence[str]) -> Column:
    """The union of list fields as text, one value per line, sorted.

    Whitespace inside a value is collapsed; null if there is no value.
    """
    union = F.array_distinct(F.flatten(F.array(*[F.col(f) for f in lists])))
    lines = F.transform(F.sort_array(union), lambda v: F.concat(F.regexp_replace(v, r"\s+", " "), F.lit("\n")))
    return F.when(F.size(union) > 0, F.array_join(lines, ""))


def field_text(field: str) -> Column:
    """A single field as metadata text; null if it has no value."""
    value = F.col(field)
    if field == "GeneralOnlineDescriptors":
        return F.when(F.size(value) > 0, F.concat(F.lit("["), F.array_join(value, ", "), F.lit("]")))
    if field in ("PublicationDate", "CorrectionDate"):
        return F.date_format(value, DATE_TEXT)
    return value.cast("string")


def article_metadata() -> Column:
    """The metadata map of an article; null and blank left out."""
    entries = {"guid": F.when(F.col("Guid") > 0, F.col("Guid").cast("string"))}
    entries |= {key: merged_list(lists) for key, lists in MERGED_LISTS.items()}
    entries |= {field: field_text(field) for field in SINGLE_FIELDS}
    pairs = F.map_from_arrays(
        F.array(*[F.lit(k) for k in entries]), F.array(*[v for v in entries.values()])
    )
    return F.map_filter(pairs, lambda _, v: ~is_blank(v)).cast(META_TYPE)


def skip_reason(source: str) -> Column:
    return (
        F.when(F.coalesce(F.col("src.name") != source, F.lit(True)), F.concat(F.lit("skip -- wrong source: "), F.coalesce("src.name", F.lit("null"))))
        .when(F.col("text.orig").isNull(), "skip -- null text")
        .otherwise("map")
    )


def parse_articles(docs: DataFrame, source: str) -> DataFrame:
    """Documents of one source with raw text and metadata from their XML.

    Rows that yield neither text nor metadata are left out; malformed ones are
    in ``rejected``.
    """
    own = docs.where((F.col("src.name") == source) & F.col("text.orig").isNotNull())
    found = computed(articles(own), "__meta", article_metadata())
    kept = found.where((F.size("__meta") > 0) | F.col("Body").isNotNull())
    text = F.col("text").withField("raw", F.coalesce("Body", "text.raw"))
    return (
        kept.withColumn("text", text)
        .withColumn("meta", merge_metadata(F.col("meta"), F.col("__meta")))
        .select(*docs.columns)
    )


def skip_counts(docs: DataFrame, source: str) -> DataFrame:
    """Rows mapped and skipped, by reason."""
    return docs.groupBy(skip_reason(source).alias("reason")).agg(F.count("*").alias("n")).select(
        *long_result("Parse NYT", F.col("reason"), F.col("n"))
    )


def parse_audit(found: DataFrame) -> DataFrame:
    """Added, null and empty counts per field of ``articles``; one aggregate."""
    tests = {("add", "guid"): F.col("Guid") > 0}
    tests[("add", "--Body--")] = F.col("Body").isNotNull()
    tests[("skip (null)", "--Body--")] = F.col("Body").isNull()
    for key, lists in MERGED_LISTS.items():
        tests[("add collection list", key)] = F.size(F.flatten(F.array(*[F.col(f) for f in lists]))) > 0
    for field in SINGLE_FIELDS:
        value = field_text(field)
        tests[("add", field)] = ~is_blank(value)
        tests[("null val", field)] = value.isNull()
        tests[("empty val", field)] = value.isNotNull() & is_blank(value)
    counts = found.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests.values())])
    entry = F.inline(
        F.array(
            *[
                F.struct(F.lit(g).alias("counter_group"), F.lit(c).alias("counter"), F.col(f"c{i}").alias("n"))
                for i, (g, c) in enumerate(tests)
            ]
        )
    )
    return counts.select(entry).where(F.col("n") > 0)
