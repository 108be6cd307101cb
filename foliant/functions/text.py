"""Scalar text rules (F2-F13). "Trim" always means: drop chars up to U+0020."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Argument formats by number of '-' separated parts.
TIME_FORMATS = ("yyyy", "yyyy-M", "yyyy-M-d", "yyyy-M-d-H", "yyyy-M-d-H-m", "yyyy-M-d-H-m-s")
ISO_DATE = "yyyy-MM-dd'T'HH:mm:ss'Z'"


BLANKS = "".join(map(chr, range(0x21)))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    return text.isNull() | (trimmed(text) == "")


def collapsed(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def clean_text(text: Column) -> Column:
    """whitespace runs become one space, ends trimmed, case kept.

    A text without any of these characters, as most words are, is left as it is.
    """
    return F.when(F.rlike(text, F.lit(r"[\x00-\x20]")), trimmed(collapsed(text))).otherwise(text)


def normalized(text: Column, preserve_case: bool = False) -> Column:
    """clean text, case folded unless it is to be kept."""
    return clean_text(text if preserve_case else F.lower(text))


def raw_text(docs_text: str = "text") -> Column:
    """the raw text, empty if absent."""
    return F.coalesce(F.col(docs_text)["raw"], F.lit(""))


def span_of(text: Column, start: Column, end: Column) -> Column:
    """zero-based half-open span; an end past the text is clamped."""
    return F.substring(text, start + 1, F.least(end, F.length(text)) - start)


def clean_span(span: Column) -> Column:
    """span text without surrounding brackets, quotes and punctuation."""
    flat = collapsed(trimmed(span))
    opened = F.regexp_replace(flat, r"\A[\s\"'`\[\(\-]+", "")
    return F.regexp_replace(opened, r"\W+\z", "")


def split_tabs(text: Column) -> Column:
    """Parts of a tab list; empty parts at the end do not count."""
    body = F.regexp_replace(text, r"\t+$", "")
    nothing = F.array().cast("array<string>")
    return F.when((body == "") & (text != ""), nothing).otherwise(F.split(body, "\t"))


def tab_values(text: Column) -> Column:
    """distinct trimmed values of a tab list."""
    return F.array_distinct(F.transform(split_tabs(text), trimmed))


def tab_joined(values: Column) -> Column:
    """sorted values, whitespace collapsed, tab-joined."""
    return trimmed(F.array_join(F.transform(F.sort_array(values), collapsed), "\t"))


def comma_joined(values: Column) -> Column:
    """``a, b`` text of a set, in sorted order."""
    return F.array_join(F.sort_array(F.array_distinct(values)), ", ")


def time_millis(text: Column) -> Column:
    """F8: epoch millis of a date argument or of millis given as text."""
    parts = F.size(F.split(text, "-"))
    year = F.when(F.length(text) == 4, F.try_to_timestamp(text, F.lit(TIME_FORMATS[0])))
    dated = year
    for n, pattern in enumerate(TIME_FORMATS[1:], start=2):
        dated = F.when(parts == n, F.try_to_timestamp(text, F.lit(pattern))).otherwise(dated)
    return F.coalesce(F.unix_millis(dated), F.when(parts == 1, text.try_cast("bigint")))


def parse_time(value: str) -> dt.datetime:
    """F8 on the driver, for scan arguments; an unreadable value is an error."""
    parts = value.split("-")
    if len(parts) > 1 or len(value) == 4:
        pattern = "-".join(["%Y", "%m", "%d", "%H", "%M", "%S"][: len(parts)])
        return dt.datetime.strptime(value, pattern).replace(tzinfo=dt.timezone.utc)
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return epoch + dt.timedelta(milliseconds=int(value))


def iso_date(ts: Column) -> Column:
    """ISO date text ending in Z (the session runs in UTC)."""
    return F.date_format(ts, ISO_DATE)


def contains_ignoring_case(text: Column, part: Column) -> Column:
    """F12."""
    return F.contains(F.lower(text), F.lower(part))


def text_length(text: Column) -> Column:
    """characters, 0 if absent."""
    return F.coalesce(F.length(text), F.lit(0))


def sha1_key(*parts: Column, separator: str = ":") -> Column:
    """The default row key, SHA-1 hex of the joined parts."""
    return F.sha1(F.concat_ws(separator, *parts).cast("binary"))
