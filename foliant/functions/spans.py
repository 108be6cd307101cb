"""Annotation sets as columns: making, reading and comparing spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.arrays import let, running
from foliant.model import ANNOTATION_SET_TYPE, ANNOTATIONS_TYPE

#: Characters of a block are two to this power.
BLOCK_BITS = 6
BLOCK = 1 << BLOCK_BITS


def empty_set() -> Column:
    return F.array().cast(ANNOTATION_SET_TYPE)


def annotation(id: Column, start: Column, end: Column, type: Column) -> Column:
    return F.struct(
        id.cast("int").alias("id"),
        start.cast("int").alias("start"),
        end.cast("int").alias("end"),
        type.alias("type"),
        F.lit(None).cast("map<string,string>").alias("features"),
    )


def match_spans(text: Column, pattern: str, type: str) -> Column:
    """Annotations for every match of the pattern, which matches no empty text.

    The pattern cuts the text into gaps and matches; a match ends where the gaps
    and matches up to it end. Nothing is written into the text to find them.
    """
    safe = F.coalesce(text, F.lit(""))
    parts = F.struct(
        F.transform(F.split(safe, pattern), F.length).alias("gaps"),
        F.transform(F.regexp_extract_all(safe, F.lit(pattern), F.lit(0)), F.length).alias("matches"),
    )

    def spans(p: Column) -> Column:
        steps = F.transform(p["matches"], lambda n, i: n + F.get(p["gaps"], i))
        return let(
            running(steps, 0, lambda at, n: at + n),
            lambda ends: F.transform(ends, lambda e, i: annotation(i, e - F.get(p["matches"], i), e, F.lit(type))),
        )

    return let(parts, spans).cast(ANNOTATION_SET_TYPE)


def span_texts(text: Column, spans: Column) -> Column:
    """Covered text of every span (F3 for a whole set).

    The text is cut into blocks once; a span then costs its own length instead
    of a walk from the start of the text.
    """
    safe = F.coalesce(text, F.lit(""))

    def covered(blocks: Column) -> Column:
        def one(s: Column) -> Column:
            first = F.shiftright(s["start"], BLOCK_BITS)
            last = F.shiftright(F.greatest(s["end"] - 1, s["start"]), BLOCK_BITS)
            window = F.when(first == last, F.get(blocks, first)).otherwise(
                F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            )
            return F.coalesce(F.substring(window, s["start"].bitwiseAND(BLOCK - 1) + 1, s["end"] - s["start"]), F.lit(""))

        return F.transform(spans, one)

    return let(F.regexp_extract_all(safe, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0)), covered)


def outside(spans: Column, cover: Column) -> Column:
    """The spans that lie inside no single span of cover.

    Both sets are merged in order of start. The place of a span in the merged
    order tells how many cover spans have begun; the farthest end among those
    decides. Sorting is all it costs: no pair of spans is compared.
    """

    def tagged(array: Column, kind: int) -> Column:
        return F.transform(
            array,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), _bare(s).alias("span")
            ),
        )

    merged = F.sort_array(F.concat(tagged(cover, 0), tagged(spans, 1)))
    placed = F.transform(merged, lambda row, i: F.struct(row["kind"].alias("kind"), i.alias("place"), row["span"].alias("span")))
    ends = F.transform(F.sort_array(tagged(cover, 0)), lambda row: row["end"])
    farthest = running(ends, -1, lambda far, end: F.greatest(far, end))

    def pick(far: Column) -> Column:
        own = F.filter(placed, lambda row: row["kind"] == 1)
        kept = F.filter(
            own,
            lambda row, k: F.coalesce(F.get(far, row["place"] - k - 1), F.lit(-1)) < row["span"]["end"],
        )
        return F.transform(kept, lambda row: row["span"])

    return let(farthest, pick)


def _bare(span: Column) -> Column:
    """A span without its feature map, which cannot be sorted."""
    return F.struct(*[span[f].alias(f) for f in ("id", "start", "end", "type")])


def annotation_set(name: str | Column, annotations: str = "annotations") -> Column:
    """The named set, empty if absent."""
    return F.coalesce(F.col(annotations)[name], empty_set())


def set_annotation_set(annotations: Column, name: Column, spans: Column) -> Column:
    """The set under its name, replacing one of the same name."""
    rest = F.map_filter(F.coalesce(annotations, F.create_map().cast(ANNOTATIONS_TYPE)), lambda k, _: k != name)
    return F.map_concat(rest, F.create_map(name, spans.cast(ANNOTATION_SET_TYPE)))


def canonical_name(name: Column, names: dict[str, str]) -> Column:
    """The configured name of a set, or the name itself."""
    if not names:
        return name
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(table[name], name)


def span_json(value: Column, start: Column, end: Column) -> Column:
    """Span with its value as JSON.

    A value without quotes, backslashes and control characters, as most words are, stands in
    it as it is; whatever else there is, nulls included, is left to the JSON writer.
    """
    bare = ~F.rlike(value, F.lit(r'["\\\x00-\x1f]')) & start.isNotNull() & end.isNotNull()
    made = F.concat(F.lit('{"value":"'), value, F.lit('","start":'), start.cast("string"), F.lit(',"end":'), end.cast("string"), F.lit("}"))
    return F.when(bare, made).otherwise(F.to_json(F.struct(value.alias("value"), start.alias("start"), end.alias("end"))))
