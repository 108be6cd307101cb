import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from foliant.functions import arrays, markup, spans, text
from tests.conftest import table


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_trim_drops_every_control_character(spark):
    assert value(spark, text.trimmed(F.lit("\x00\t\n a b \r\x1f"))) == "a b"
    assert value(spark, text.trimmed(F.lit(" a"))) == " a"


@pytest.mark.parametrize(
    ("given", "parts"),
    [("a\tb\t\t", ["a", "b"]), ("\ta", ["", "a"]), ("\t\t", []), ("", [""]), ("a\t\tb", ["a", "", "b"])],
)
def test_split_tabs_drops_empty_parts_at_the_end_only(spark, given, parts):
    assert value(spark, text.split_tabs(F.lit(given))) == parts


def test_tab_values_and_joins(spark):
    assert value(spark, text.tab_values(F.lit("b\t a\tb "))) == ["b", "a"]
    assert value(spark, text.tab_joined(F.array(F.lit("b  c"), F.lit("a")))) == "a\tb c"
    assert value(spark, text.comma_joined(F.array(F.lit("b"), F.lit("a"), F.lit("b")))) == "a, b"


def test_span_is_clamped(spark):
    assert value(spark, text.span_of(F.lit("héllo"), F.lit(1), F.lit(99))) == "éllo"


def test_clean_span(spark):
    assert value(spark, text.clean_span(F.lit(" \"([-The\n  end).. "))) == "The end"


def test_time_argument(spark):
    expected = dt.datetime(2010, 3, 1, tzinfo=dt.timezone.utc)
    assert text.parse_time("2010-03") == expected
    assert text.parse_time(str(int(expected.timestamp() * 1000))) == expected
    assert value(spark, text.time_millis(F.lit("2010-03"))) == int(expected.timestamp() * 1000)
    assert value(spark, text.time_millis(F.lit("2010-3-1-2-3"))) == int(expected.timestamp() + 7380) * 1000
    assert value(spark, text.time_millis(F.lit("12345"))) == 12345
    assert value(spark, text.time_millis(F.lit("no-date"))) is None
    with pytest.raises(ValueError):
        text.parse_time("2010-99")


def test_iso_date_and_sha1(spark):
    moment = F.to_timestamp(F.lit("2024-02-03 04:05:06"))
    assert value(spark, text.iso_date(moment)) == "2024-02-03T04:05:06Z"
    key = value(spark, text.sha1_key(F.lit("Boats come in at noon.")))
    assert re.fullmatch("[0-9a-f]{40}", key)


def test_running_matches_a_fold(spark):
    for size in (0, 1, 2, 3, 10, 101):
        items = [random.Random(size).randint(0, 50) for _ in range(size)]
        sums = value(spark, arrays.running(F.lit(items) if items else F.array().cast("array<int>"), 0, lambda s, x: s + x))
        assert sums == [sum(items[: i + 1]) for i in range(size)]


def test_match_spans_and_texts(spark):
    content = "Ünder the \U0001f600 bridge, " * 40 + "endx"
    made = spans.match_spans(F.lit(content), r"[\p{L}]+", "word")
    found = value(spark, made)
    expected = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", content)]
    assert [(a["start"], a["end"]) for a in found] == expected
    assert value(spark, spans.span_texts(F.lit(content), made)) == [content[s:e] for s, e in expected]
    for none in (F.lit(None).cast("string"), F.lit(""), F.lit("no match")):
        assert value(spark, spans.match_spans(none, "z", "x")) == []


def test_outside_matches_brute_force(spark):
    rng = random.Random(3)
    for _ in range(5):
        make = lambda n: [(i, s, s + rng.randint(0, 6)) for i, s in enumerate(rng.randint(0, 60) for _ in range(n))]
        tokens, cover = make(25), make(rng.choice([0, 1, 8]))
        column = lambda rows: (
            F.array(*[spans.annotation(F.lit(i), F.lit(s), F.lit(e), F.lit("t")) for i, s, e in rows])
            if rows
            else spans.empty_set()
        )
        kept = value(spark, spans.outside(column(tokens), column(cover)))
        expected = sorted(i for i, s, e in tokens if not any(a <= s and e <= b for _, a, b in cover))
        assert sorted(r["id"] for r in kept) == expected


def test_annotation_sets(spark):
    docs = spark.range(1).select(
        spans.set_annotation_set(F.lit(None), F.lit("a"), spans.match_spans(F.lit("x y"), "[a-z]", "c")).alias("annotations")
    )
    again = docs.withColumn(
        "annotations", spans.set_annotation_set(F.col("annotations"), F.lit("a"), spans.match_spans(F.lit("x"), "x", "c"))
    )
    row = again.select(F.size(spans.annotation_set("a")), F.size(spans.annotation_set("none"))).first()
    assert tuple(row) == (1, 0)
    assert value(spark, spans.canonical_name(F.lit("ne"), {"ne": "named"})) == "named"
    assert value(spark, spans.canonical_name(F.lit("pos"), {"ne": "named"})) == "pos"
    assert value(spark, spans.span_json(F.lit('a"b'), F.lit(1), F.lit(2))) == '{"value":"a\\"b","start":1,"end":2}'


def test_markup_helpers(spark):
    assert value(spark, markup.all_text(F.lit("One <b>two</b> <i>three</i>"))) == "One two  three"
    xml = '<r><org class="a &lt; b" x=\'1\'/><org>t</org></r>'
    moved = markup.protected(F.lit(xml), ["org"])
    frame = spark.range(1).select(F.from_xml(moved, "org array<string>", markup.XML_OPTIONS)["org"].alias("o"))
    classes = frame.select(F.transform("o", lambda x: markup.attribute(x, "class")), F.transform("o", markup.inner)).first()
    assert list(classes) == [["a < b", None], ["", "t"]]
    assert table(frame.select(F.size("o"))) == [(2,)]
