"""Reading XML text with ``from_xml`` without losing inline markup.

Two things would be lost in parsing and are kept by rewriting the text first:
escaped ``<`` (it could not be told from a tag once decoded) and the
attributes of elements whose text may hold markup. Such elements are then read
as plain strings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import trimmed

# Private-use characters: an escaped "<", begin and end of moved attributes.
LESS, OPEN, SHUT = "\ue001", "\ue002", "\ue003"
# Before one of these, or itself, that the text holds: KEPT and a digit stand for it.
KEPT = "\ue004"
OWN = (LESS, OPEN, SHUT, KEPT)
CORRUPT = "_corrupt_record"
# Attribute values and text keep their blanks; what is trimmed is trimmed here.
XML_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT, "ignoreSurroundingSpaces": "false"}
ATTRIBUTES = r"""((?:\s+[\w.:-]+\s*=\s*(?:"[^"]*"|'[^']*'))*)\s*"""


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What use gives for a value that is evaluated once, however often use reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def replaced(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """The text with one piece after the other replaced; a text without a piece is only searched for it."""
    held = F.array(text)
    for old, new in pairs:
        held = F.transform(held, lambda t: F.when(F.contains(t, F.lit(old)), F.replace(t, F.lit(old), F.lit(new))).otherwise(t))
    return F.get(held, F.lit(0))


def _trimmed(text: Column) -> Column:
    """Trimmed, if an end is a blank; for a text that costs nothing to read again."""
    last = F.substring(text.cast("binary"), -1, 1)
    return F.when((F.ascii(text) <= 0x20) | (last <= F.lit(b"\x20")), trimmed(text)).otherwise(text)


def guarded(text: Column) -> Column:
    """The text with the private-use characters that it already has told apart from ours."""
    safe = F.replace(text, F.lit(KEPT), F.lit(f"{KEPT}{len(OWN)}"))
    for i, c in enumerate(OWN, 1):
        if c != KEPT:
            safe = F.replace(safe, F.lit(c), F.lit(f"{KEPT}{i}"))
        safe = F.regexp_replace(safe, f"(?i)&#0*{ord(c)};|&#x0*{ord(c):x};", f"{KEPT}{i}")
    named = F.contains(text, F.lit("&#")) & F.rlike(text, F.lit("&#(?:0*5734[5-8]|[xX]0*[eE]00[1-4]);"))
    own = F.contains(text.cast("binary"), F.lit(LESS.encode()[:2]))  # these bytes begin all of OWN
    return F.when(own | named, safe).otherwise(text)


def protected(xml: Column, elements: Sequence[str]) -> Column:
    """The text to parse: no DOCTYPE, escaped "<" marked, attributes moved."""
    names = "|".join(n.replace(".", r"\.") for n in elements)
    text = F.regexp_replace(guarded(xml), r"(?s)<!DOCTYPE[^>\[]*(\[.*?\]\s*)?>", "")
    # An empty element is written out first: marks make the text wider, and what follows them slower.
    text = F.regexp_replace(text, f"<({names}){ATTRIBUTES}/>", "<$1$2></$1>")
    text = F.regexp_replace(text, "&(?:lt|#0*60|#[xX]0*3[cC]);", LESS)
    return F.regexp_replace(text, f"<({names}){ATTRIBUTES}>", f"<$1>{OPEN}$2{SHUT}")


def with_tree(df: DataFrame, xml: Column, schema: str, name: str, keep: bool = False) -> DataFrame:
    """Add the parsed struct; rows that are no well-formed XML are left out, or kept with null."""
    trees = F.array(F.from_xml(xml, schema, XML_OPTIONS))
    good = F.filter(trees, lambda t: t.isNotNull() & t[CORRUPT].isNull())
    return df.withColumn(name, F.explode_outer(good) if keep else F.explode(good))


def plain(text: Column) -> Column:
    """What a piece of guarded or protected text stands for."""

    def read(t: Column) -> Column:
        own = replaced(t, [(LESS, "<"), *[(f"{KEPT}{i}", c) for i, c in enumerate(OWN, 1)]])
        return F.when(F.contains(t, F.lit(LESS)) | F.contains(t, F.lit(KEPT)), own).otherwise(t)

    return bound(text, read)


def inner(markup: Column) -> Column:
    """The content of an element as text, markup included."""
    return plain(trimmed(F.regexp_replace(markup, f"{OPEN}[^{SHUT}]*{SHUT}", "")))


def all_text(markup: Column) -> Column:
    """Every text node trimmed, joined by a space; of guarded or protected text."""

    def joined(bare: Column) -> Column:
        nodes = F.filter(F.split(bare, "<[^>]*>"), lambda t: t != "")
        several = trimmed(F.array_join(F.transform(nodes, _trimmed), " "))
        return F.when(F.contains(bare, F.lit("<")), several).otherwise(_trimmed(bare))

    def read(text: Column) -> Column:
        bare = F.when(F.contains(text, F.lit(OPEN)), F.regexp_replace(text, f"{OPEN}[^{SHUT}]*{SHUT}", "")).otherwise(text)
        return bound(bare, joined)

    return plain(bound(markup, read))


def attribute(markup: Column, name: str) -> Column:
    """A moved attribute of an element; null if it has none."""
    inside = F.regexp_extract(markup, f"^{OPEN}([^{SHUT}]*){SHUT}", 1)
    quoted = F.regexp_extract(inside, rf"""\s{name}\s*=\s*("[^"]*"|'[^']*')""", 1)
    return bound(quoted, lambda q: F.when(q != "", plain(F.substring(q, F.lit(2), F.length(q) - 2))))


def first(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def present(items: Column, read: Callable[[Column], Column] = lambda c: c) -> Column:
    """What read gives for each item, without nulls; an empty array for null."""
    kept = F.filter(F.transform(items, read), lambda v: v.isNotNull())
    return F.coalesce(kept, F.array().cast("array<string>"))
