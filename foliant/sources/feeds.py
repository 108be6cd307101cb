"""RSS and Atom feeds as rows for entries and for their contents.

Feeds are a table (url, xml) with an optional ``tags`` column: feed files that
have landed, or text made by an earlier step. One feed is one row; its entries
become rows of their own before anything else is done with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.arrays import let
from foliant.functions.markup import (
    CORRUPT, XML_OPTIONS, attribute, first, inner, last, present, protected, with_tree,
)
from foliant.functions.text import comma_joined, iso_date, sha1_key
from foliant.model import INGEST_DATE, empty_annotations, meta_map, src_struct, text_struct
from foliant.operators.rows import computed
from foliant.session import written

# Elements with both text (or markup) and attributes.
TEXT_ELEMENTS = ("title", "subtitle", "summary", "content", "rights", "category", "link", "guid", "description")

_HEAD = """title array<string>, link array<string>, id array<string>, description array<string>,
subtitle array<string>, language array<string>, copyright array<string>, rights array<string>,
managingEditor array<string>, author array<struct<name array<string>>>"""
FEED_DDL = f"""{_HEAD}, `_xml:lang` string, _version string,
channel struct<{_HEAD}, item array<struct<title string>>>,
entry array<struct<id string>>, item array<struct<title string>>, {CORRUPT} string"""

ENTRY_DDL = f"""title array<string>, id array<string>, guid array<string>, link array<string>,
updated array<string>, published array<string>, pubDate array<string>,
summary array<string>, description array<string>, content array<string>, `content:encoded` array<string>,
category array<string>, author array<string>, `dc:creator` array<string>, {CORRUPT} string"""

#: When a feed was seen, if its table says so; every row of it keeps that.
SEEN = "seen_at"
_WEEKDAY = r"^\s*[A-Za-z]+,\s*"
RSS_DATES = ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss xx", "d MMM yyyy HH:mm:ss")


def read_feeds(spark: SparkSession, paths) -> DataFrame:
    """Landed feed files; the file path stands for the url."""
    files = spark.read.text(paths, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("xml"))


def entry_texts(xml: Column) -> Column:
    """The text of every Atom entry or, if there is none, of every RSS item.

    An entry that is never closed ends the search.
    """

    def found(tag: str) -> Column:
        return F.regexp_extract_all(xml, F.lit(rf"(?is)<{tag}[\s>].*?</{tag}>"), F.lit(0))

    entries = found("entry")
    return F.when(F.size(entries) > 0, entries).otherwise(found("item"))


def _text(items: Column) -> Column:
    return inner(last(items))


def _href(links: Column) -> Column:
    """The alternate link of Atom, the text of an RSS link."""
    alternate = F.filter(
        links, lambda x: F.coalesce(attribute(x, "rel"), F.lit("alternate")) == "alternate"
    )
    return F.coalesce(attribute(first(alternate), "href"), F.nullif(inner(first(links)), F.lit("")))


def parse_date(text: Column) -> Column:
    """RFC 3339 or RFC 822 date as ISO text, null if unreadable."""
    bare = F.regexp_replace(text, _WEEKDAY, "")
    tries = [F.try_to_timestamp(bare, F.lit(p)) for p in RSS_DATES]
    iso = F.when(F.rlike(text, F.lit(r"^\s*\d{4}-")), text.try_cast("timestamp"))
    return iso_date(F.coalesce(iso, *tries))


def feed_status(feeds: DataFrame) -> DataFrame:
    """Each feed with its entry texts, head fields and reason to reject it, if any.

    The reference point is the parsed feed: the number of entries cut out of
    the text must equal the number of entries in the tree.
    """
    tags = F.col("tags") if "tags" in feeds.columns else F.lit(None).cast("string")
    seen = F.col(SEEN) if SEEN in feeds.columns else F.lit(None).cast("timestamp")
    tree = F.from_xml(protected(F.col("xml"), TEXT_ELEMENTS), FEED_DDL, XML_OPTIONS)
    rows = feeds.select("url", "xml", tags.alias("tags"), seen.alias(SEEN))
    read = computed(rows, "read", F.struct(entry_texts(F.col("xml")).alias("entries"), tree.alias("t")))
    cut = read.select("url", "xml", "tags", SEEN, "read.entries", "read.t")
    channel = "t.channel"
    parsed = sum(
        (F.coalesce(F.size(c), F.lit(0)) for c in (F.col("t.entry"), F.col("t.item"), F.col(f"{channel}.item"))),
        F.lit(0),
    )

    def either(name: str, read=_text) -> Column:
        return F.coalesce(read(F.col(f"t.{name}")), read(F.col(f"{channel}.{name}")))

    is_atom = F.col(channel).isNull()
    names = lambda a: last(F.flatten(F.transform(a, lambda p: p["name"])))
    head = F.struct(
        F.when(is_atom, _text(F.col("t.id"))).alias("feed_url"),
        either("link", _href).alias("feed_link"),
        F.coalesce(names(F.col("t.author")), _text(F.col(f"{channel}.managingEditor"))).alias("feed_author"),
        F.coalesce(either("copyright"), either("rights")).alias("feed_copyright"),
        F.coalesce(either("description"), either("subtitle")).alias("feed_description"),
        F.coalesce(either("language"), F.col("t.`_xml:lang`")).alias("feed_language"),
        F.when(is_atom, F.lit("atom_1.0"))
        .otherwise(F.concat(F.lit("rss_"), F.coalesce("t._version", F.lit("1.0"))))
        .alias("feed_type"),
        either("title").alias("feed_title"),
    )
    reason = F.when(F.col("xml").isNull(), "no feed").when(
        F.col(f"t.{CORRUPT}").isNotNull(), "no well-formed XML"
    ).when(parsed != F.size("entries"), "entry texts do not match the parsed entries")
    return cut.select("url", "xml", "tags", SEEN, "entries", head.alias("head"), reason.alias("reason"))


def rejected_feeds(feeds: DataFrame) -> DataFrame:
    """Feeds that cannot be ingested, with the reason."""
    return feed_status(feeds).where(F.col("reason").isNotNull()).select("url", "reason")


def read_entries(feeds: DataFrame) -> DataFrame:
    """One row per entry of the good feeds: its text, key, feed fields and tree,
    the tree null for an entry that does not parse alone."""
    rows = feed_status(feeds).select(
        "url", "tags", SEEN, "head", F.explode(F.when(F.col("reason").isNull(), F.col("entries"))).alias("orig")
    )
    keyed = rows.withColumn("entry_key", sha1_key(F.col("orig")))
    return with_tree(keyed, protected(F.col("orig"), TEXT_ELEMENTS), ENTRY_DDL, "e", keep=True)


def parsed_entries(feeds: DataFrame) -> DataFrame:
    """The entries that can be ingested; with ``rejected_entries`` all of the good feeds."""
    return read_entries(feeds).where(F.col("e").isNotNull())


def rejected_entries(feeds: DataFrame) -> DataFrame:
    """Entries of good feeds that do not parse alone (url, entry_key, orig)."""
    return read_entries(feeds).where(F.col("e").isNull()).select("url", "entry_key", "orig")


def _is_rss() -> Column:
    return F.startswith(F.col("head.feed_type"), F.lit("rss"))


def _description() -> Column:
    return F.coalesce(_text(F.col("e.summary")), _text(F.col("e.description")))


def _entry_meta() -> dict[str, Column]:
    author_names = F.transform(
        F.coalesce("e.author", F.array().cast("array<string>")),
        lambda a: F.coalesce(
            F.nullif(F.regexp_extract(a, r"(?s)<name[^>]*>(.*?)</name>", 1), F.lit("")), inner(a)
        ),
    )
    authors = F.concat(author_names, present(F.col("e.`dc:creator`"), inner))
    links = present(F.col("e.link"), lambda x: F.coalesce(attribute(x, "href"), F.nullif(inner(x), F.lit(""))))
    categories = present(
        F.col("e.category"), lambda x: F.coalesce(attribute(x, "term"), F.nullif(inner(x), F.lit("")))
    )
    return {f: F.col(f"head.{f}") for f in _FEED_FIELDS} | {
        "title": _text(F.col("e.title")),
        "url": F.coalesce(_text(F.col("e.id")), _text(F.col("e.guid")), _href(F.col("e.link"))),
        "updated_date": parse_date(last(F.col("e.updated"))),
        "published_date": parse_date(F.coalesce(last(F.col("e.published")), last(F.col("e.pubDate")))),
        "authors": comma_joined(authors),
        "links": comma_joined(links),
        "categories": comma_joined(categories),
    }


# Feed fields copied to the metadata of each of its rows.
_FEED_FIELDS = (
    "feed_url", "feed_link", "feed_author", "feed_copyright", "feed_description",
    "feed_language", "feed_type", "feed_title",
)


_BODIES = "array<struct<key:string,type:string,value:string,tag:string>>"


def _bodies() -> Column:
    """Contents that are not empty or, if there is none, the description."""

    def body(type: Column, value: Column, tag: str) -> Column:
        return F.struct(
            sha1_key(value).alias("key"), type.alias("type"), value.alias("value"), F.lit(tag).alias("tag")
        )

    def contents(items: Column, type: Column) -> Column:
        made = F.transform(items, lambda x: body(F.coalesce(attribute(x, "type"), type), inner(x), "content"))
        return F.coalesce(made, F.array()).cast(_BODIES)

    own = contents(F.col("e.content"), F.lit(None))
    encoded = contents(F.col("e.`content:encoded`"), F.lit("text/html"))
    type = F.when(_is_rss(), "text/html").otherwise(attribute(last(F.col("e.summary")), "type"))
    description = F.array(body(type, _description(), "desc")).cast(_BODIES)
    filled = lambda b: F.coalesce(b["value"], F.lit("")) != ""
    return let(
        F.filter(F.concat(own, encoded), filled),
        lambda found: F.when(F.size(found) > 0, found).otherwise(F.filter(description, filled)),
    )


def feed_rows(parsed: DataFrame, source: str, at: dt.datetime | None = None) -> DataFrame:
    """I5 and I6 from one reading: a document per entry, and one per body of it.

    A body is keyed by its own text and linked back to its entry. An entry or
    body seen twice has the same key.
    """
    entry = F.array(
        F.struct(F.col("entry_key"), F.lit(None), F.col("orig"), F.lit(None)).cast(_BODIES[6:-1])
    )
    shared = _entry_meta()
    if at is not None:
        shared[INGEST_DATE] = iso_date(F.lit(at))
    read = computed(
        parsed,
        "row",
        F.struct(
            F.concat(entry, _bodies()).alias("bodies"),
            meta_map(**shared).alias("meta"),
            meta_map(description=_description()).alias("own_meta"),
        ),
    )
    rows = read.select("tags", SEEN, "entry_key", "row.meta", "row.own_meta", F.explode("row.bodies").alias("body"))
    back = meta_map(entry_tag_type=F.col("body.tag"), entry_key=F.col("entry_key"))
    is_entry = F.col("body.tag").isNull()
    return rows.select(
        F.col("body.key").alias("row_key"),
        src_struct(name=F.lit(source), id=F.col("body.key"), tags=F.col("tags")).alias("src"),
        F.map_concat("meta", F.when(is_entry, F.col("own_meta")).otherwise(back)).alias("meta"),
        text_struct(orig=F.col("body.value"), mimeType=F.col("body.type")).alias("text"),
        empty_annotations().alias("annotations"),
        SEEN,
    )


def entry_docs(parsed: DataFrame, source: str, at: dt.datetime | None = None) -> DataFrame:
    """One document per entry of ``parsed_entries``."""
    return feed_rows(parsed, source, at).where(F.col("meta")["entry_key"].isNull()).drop(SEEN)


def content_docs(parsed: DataFrame, source: str, at: dt.datetime | None = None) -> DataFrame:
    """One document per content body."""
    return feed_rows(parsed, source, at).where(F.col("meta")["entry_key"].isNotNull()).drop(SEEN)


def feed_docs(feeds: DataFrame, source: str, at: dt.datetime | None = None) -> DataFrame:
    """I5 and I6 for a table of feeds; with the time a feed was seen, if the table has it."""
    rows = feed_rows(parsed_entries(feeds), source, at)
    return rows if SEEN in feeds.columns else rows.drop(SEEN)


def tag_table(json: DataFrame) -> DataFrame:
    """(url, tags) from JSON objects ``{url: [tag, ...]}`` in column value;
    a url named more than once has the tags of all."""
    entries = F.explode(F.from_json("value", "map<string,array<string>>")).alias("url", "tags")
    every = json.select(entries).groupBy("url").agg(F.flatten(F.collect_set("tags")).alias("tags"))
    return every.select("url", comma_joined(F.col("tags")).alias("tags"))


def tagged_feeds(feeds: DataFrame, tags: DataFrame) -> DataFrame:
    """The feeds asked for, with their tags; one that is absent has no text
    and ends up among the rejects.

    The tag table is written first: the join knows its size, and feed texts
    are not shuffled for a list that can be broadcast.
    """
    wanted = written(tags.select("url", "tags"), "tags")
    here = feeds.select("url", "xml").join(wanted, "url").select("url", "xml", "tags")
    found = feeds.select("url").join(wanted, "url", "left_semi").distinct()
    absent = wanted.join(found, "url", "left_anti")
    return here.unionByName(absent.select("url", F.lit(None).cast("string").alias("xml"), "tags"))


def ingest_total(parsed: DataFrame) -> DataFrame:
    """Entries ingested over all feeds; ``rejected_entries`` has the rest."""
    return parsed.agg(F.count("*").alias("n"))
