"""The two table shapes and the conversions between them.

``cells``: one row per (row_key, family, qualifier), open-ended qualifiers.
``docs``: one row per document with the four families as nested columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.text import is_blank

# Family and qualifier names of the table layout.
FAMILIES = ("src", "meta", "text", "annotations")
SRC_FIELDS = ("name", "id", "parent", "file", "tags")
TEXT_FIELDS = ("orig", "raw", "title", "mimeType", "fileName", "byteOffset", "reference")
INGEST_DATE = "ingestDate"
ANNOTATION_SETS = ("paragraph", "sentence", "token", "pos", "parse", "dep", "ne")

META_TYPE = T.MapType(T.StringType(), T.StringType())
ANNOTATION_TYPE = (
    T.StructType()
    .add("id", "integer")
    .add("start", "integer")
    .add("end", "integer")
    .add("type", "string")
    .add("features", META_TYPE)
)
ANNOTATION_SET_TYPE = T.ArrayType(ANNOTATION_TYPE)
ANNOTATIONS_TYPE = T.MapType(T.StringType(), ANNOTATION_SET_TYPE)
SRC_TYPE = T.StructType([T.StructField(f, T.StringType()) for f in SRC_FIELDS])
TEXT_TYPE = T.StructType(
    [
        T.StructField(f, T.ArrayType(T.StringType()) if f == "reference" else T.StringType())
        for f in TEXT_FIELDS
    ]
)

CELLS_SCHEMA = (
    T.StructType()
    .add("row_key", "string")
    .add("family", "string")
    .add("qualifier", "string")
    .add("ts", "timestamp")
    .add("value", "string")
)
DOCS_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("src", SRC_TYPE),
        T.StructField("meta", META_TYPE),
        T.StructField("text", TEXT_TYPE),
        T.StructField("annotations", ANNOTATIONS_TYPE),
    ]
)


def struct_of(struct_type: T.StructType, **fields: Column) -> Column:
    """A struct with every field of the type, null where not given."""
    unknown = set(fields) - set(struct_type.names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    return F.struct(
        *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in struct_type]
    )


def src_struct(**fields: Column) -> Column:
    return struct_of(SRC_TYPE, **fields)


def text_struct(**fields: Column) -> Column:
    return struct_of(TEXT_TYPE, **fields)


def meta_map(**fields: Column) -> Column:
    """Metadata map of the given values; null and blank ones are not stored."""
    if not fields:
        return F.create_map().cast(META_TYPE)
    pairs = [part for key, value in fields.items() for part in (F.lit(key), value.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: ~is_blank(v))


def empty_annotations() -> Column:
    return F.create_map().cast(ANNOTATIONS_TYPE)


def docs_to_cells(docs: DataFrame, ts: Column | None = None) -> DataFrame:
    """Every field, metadata key and annotation set as its own cell.

    One pass, no shuffle: the cells of a row stay together in its partition.
    """
    entry = "struct<family:string,qualifier:string,value:string>"

    def cell(family: str, qualifier: Column, value: Column) -> Column:
        return F.struct(
            F.lit(family).alias("family"), qualifier.alias("qualifier"), value.alias("value")
        ).cast(entry)

    fixed = [cell("src", F.lit(f), F.col("src")[f]) for f in SRC_FIELDS]
    fixed += [
        cell("text", F.lit(f), F.array_join(F.col("text")[f], ";") if f == "reference" else F.col("text")[f])
        for f in TEXT_FIELDS
    ]
    meta = F.transform(
        F.map_entries("meta"), lambda e: cell("meta", e["key"], e["value"])
    )
    annotations = F.transform(
        F.map_entries("annotations"),
        lambda e: cell("annotations", e["key"], F.to_json(e["value"])),
    )
    none = F.array().cast(f"array<{entry}>")
    every = F.concat(F.array(*fixed), F.coalesce(meta, none), F.coalesce(annotations, none))
    stamp = (F.lit(None) if ts is None else ts).cast("timestamp")
    return docs.select("row_key", stamp.alias("ts"), F.inline(F.filter(every, lambda c: ~is_blank(c["value"])))).select(
        *CELLS_SCHEMA.names
    )


def cells_to_docs(cells: DataFrame) -> DataFrame:
    """One row per document from cells that hold one version per column.

    Groups by row_key; a document's cells must fit in a row, as in ``docs``
    itself. Reading a cells table bucketed by row_key spares the shuffle.
    """
    column = F.concat_ws(":", "family", "qualifier")
    rows = cells.groupBy("row_key").agg(
        F.map_from_entries(F.collect_list(F.struct(column, "value"))).alias("cell")
    )

    def family(name: str) -> Column:
        start = len(name) + 2
        mine = F.map_filter("cell", lambda k, _: k.startswith(f"{name}:"))
        return F.map_from_entries(
            F.transform(
                F.map_entries(mine),
                lambda e: F.struct(F.substr(e["key"], F.lit(start)), e["value"]),
            )
        )

    def at(column: str) -> Column:
        return F.col("cell")[column]

    annotations = F.transform_values(
        family("annotations"), lambda _, v: F.from_json(v, ANNOTATION_SET_TYPE)
    )
    text = {f: at(f"text:{f}") for f in TEXT_FIELDS}
    text["reference"] = F.split(text["reference"], ";")
    return rows.select(
        "row_key",
        src_struct(**{f: at(f"src:{f}") for f in SRC_FIELDS}).alias("src"),
        family("meta").alias("meta"),
        text_struct(**text).alias("text"),
        annotations.cast(ANNOTATIONS_TYPE).alias("annotations"),
    )


def in_families(families: Iterable[str]) -> Column:
    return F.col("family").isin(*families)
