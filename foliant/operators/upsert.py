"""Writes as new snapshots. Nothing is changed in place."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliant.functions.text import ISO_DATE, is_blank
from foliant.model import CELLS_SCHEMA, INGEST_DATE, text_struct
from foliant.session import written

COLUMN_KEY = ("row_key", "family", "qualifier")


def newest(cells: DataFrame, tie: str | None = None, at: Sequence[str] | None = None) -> DataFrame:
    """The newest version of every column of a stored history table.

    Equal timestamps are settled by the tie column (not negative), then by the
    larger value; a version without a time is the oldest.
    Which version wins is found from numbers: time and tie make one decimal, whose
    maximum per column is a hash aggregate, combined before the shuffle. Only
    columns with several versions are listed, and the list is written, so that a
    short one is broadcast and the cells stay where they are; a long one is
    joined by row_key alone, as in ``upsert``. Values are read once, at the end;
    they are compared only where several versions tie, and then only distinct ones.
    With at, the columns that say where a cell is stored (file, row number), the
    cells stay where they are however many columns have several versions.
    """
    if at is not None:
        return _newest_in_place(cells, tie, *at)
    places = cells.select(*COLUMN_KEY, _place(tie).alias("place"))
    tops = places.groupBy(*COLUMN_KEY).agg(F.max("place").alias("top"), F.count("*").alias("n"))
    contested = written(tops.where("n > 1").select(*_put_names(), "top"), "contested")
    winning = F.col("place") == F.col("top")
    tied = places.join(contested, _same_column()).where(winning).groupBy(*COLUMN_KEY).agg(F.count("*").alias("n"))
    listed = written(
        contested.join(
            tied.where("n > 1").select(*[F.col(c).alias(f"tied_{c}") for c in COLUMN_KEY], F.lit(True).alias("is_tied")),
            F.expr(" and ".join(f"put_{c} <=> tied_{c}" for c in COLUMN_KEY)),
            "left",
        ).select(*_put_names("put_"), "top", F.coalesce("is_tied", F.lit(False)).alias("is_tied")),
        "listed",
    )
    held = cells.withColumn("place", _place(tie)).join(listed, _same_column(), "left")
    columns = CELLS_SCHEMA.names
    kept = held.where(F.col("top").isNull() | (winning & ~F.col("is_tied"))).select(*columns)
    if listed.where("is_tied").isEmpty():
        return kept
    ties = held.where(winning & F.col("is_tied")).select(*columns).distinct()
    return kept.unionByName(_settled(ties))


def _settled(ties: DataFrame) -> DataFrame:
    """The larger value of each column."""
    return ties.groupBy(*COLUMN_KEY, "ts").agg(F.max("value").alias("value")).select(*CELLS_SCHEMA.names)


#: Rows of a file that one bitmap is for (that of ``bitmap_construct_agg``), bytes of bitmaps that are broadcast at most, and what one counts beside its bits.
BITMAP_ROWS = 32_768
BITMAP_BYTES = 128 << 20
BITMAP_KEY = 256


def _newest_in_place(cells: DataFrame, tie: str | None, file: str, row: str) -> DataFrame:
    """``newest`` of stored cells: which of them are superseded is a bit per row of their files.

    Keys, numbers and places are shuffled by row key, so that the cells of a row, stored
    side by side, stay together and their key packs well; values are not, but of cells that tie.
    Bitmaps too many to be broadcast are joined by file. A cell without a row key supersedes none.
    """
    column = W.partitionBy(*COLUMN_KEY)
    keyed = cells.where(F.col("row_key").isNotNull()).select(*COLUMN_KEY, _place(tie).alias("place"), file, row)
    ranked = keyed.repartition("row_key").withColumn("top", F.max("place").over(column))
    ranked = ranked.withColumn("wins", F.col("place") == F.col("top")).withColumn("ties", F.count_if("wins").over(column) > 1)
    bit = F.when(F.col("ties") & F.col("wins"), F.col("bit"))
    marked = (
        ranked.where(~F.col("wins") | F.col("ties"))
        .select(file, F.floor(F.col(row) / BITMAP_ROWS).alias("part"), (F.col(row) % BITMAP_ROWS).alias("bit"), "ties", "wins")
        .repartition(file, "part")
        .groupBy(file, "part")
        .agg(_bitmap(F.col("bit")).alias("left_out"), _bitmap(bit).alias("tied"))
    )
    bitmaps = written(marked, "superseded")
    size = F.octet_length("left_out") + F.coalesce(F.octet_length("tied"), F.lit(0)) + BITMAP_KEY
    short = (bitmaps.agg(F.sum(size)).first()[0] or 0) <= BITMAP_BYTES
    placed = cells.withColumn("part", F.floor(F.col(row) / BITMAP_ROWS))
    held = placed.join(F.broadcast(bitmaps) if short else bitmaps, [file, "part"], "left")
    columns, bit = CELLS_SCHEMA.names, F.col(row) % BITMAP_ROWS
    kept = held.where(~_is_set("left_out", bit)).select(*columns)
    if bitmaps.where("tied is not null").isEmpty():
        return kept
    return kept.unionByName(_settled(held.where(_is_set("tied", bit)).select(*columns).distinct()))


def _bitmap(bits: Column) -> Column:
    """A bitmap of the given bits up to the last of them, null if there is none."""
    return F.when(F.max(bits).isNotNull(), F.substring(F.bitmap_construct_agg(bits), F.lit(1), F.floor(F.max(bits) / 8).cast("int") + 1))


def _is_set(bitmap: str, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def _place(tie: str | None) -> Column:
    """Time, then tie, as one number that a hash aggregate can take the maximum of."""
    micros = F.coalesce(F.unix_micros("ts"), F.lit(-(1 << 62))).cast("decimal(38,0)")
    after = F.coalesce(F.col(tie).cast("decimal(19,0)"), F.lit(0)) if tie else F.lit(0)
    return (micros * F.lit(Decimal(10**19)) + after).cast("decimal(38,0)")


def _put_names(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{c}").alias(f"put_{c}") for c in COLUMN_KEY]


def _same_column() -> Column:
    """One column of one row, of which the row key alone is a join key."""
    return (F.col("row_key") == F.col("put_row_key")) & _alike("family") & _alike("qualifier")


def upsert(table: DataFrame, puts: DataFrame) -> DataFrame:
    """I8: puts merged into a table that holds one version per column.

    The newest cell wins; a put wins a tie and also if it, or the cell held,
    has no time. Blank values are never stored.
    The puts are reduced first and written, so that a small batch is broadcast
    and the table is not shuffled. A larger one is joined by row_key alone, the
    rest of the column key being a condition on top: a table bucketed by row_key
    stays where it is, and only the puts move. The second look at the table reads
    keys and times only.
    """
    given = written(puts.where(~is_blank(F.col("value"))).select(*CELLS_SCHEMA.names), "given")
    put = written(newest(given), "puts")
    times = put.select(*_put_names(), F.col("ts").alias("put_ts"))
    same = _same_column()
    stays = F.col("put_row_key").isNull() | (F.col("put_ts") < F.col("ts"))
    columns = CELLS_SCHEMA.names
    kept = table.join(times, same, "left").where(stays).select(*columns)
    held = table.select(*_put_names(), F.col("ts").alias("held_ts"))
    won = put.join(held, same & (F.col("held_ts") > F.col("ts")), "left_anti")
    return kept.unionByName(won.select(*columns))


def _alike(name: str) -> Column:
    """Equal, or both null, in a form that does not become a join key."""
    a, b = F.col(name), F.col(f"put_{name}")
    return ((a <= b) & (a >= b)) | (a.isNull() & b.isNull())


def append_references(docs: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add (row_key, reference) pairs to the reference lists of documents.

    Returns the documents, with rows added for unknown keys, and per key
    whether the row existed before. A reference already present is not added
    again. New references follow in sorted order.
    """
    pairs = references.select("row_key", "reference").where(~is_blank(F.col("reference"))).distinct()
    gathered = pairs.groupBy("row_key").agg(F.sort_array(F.collect_list("reference")).alias("__added"))
    added = written(gathered, "references")
    none = F.array().cast("array<string>")
    merged = F.array_union(F.coalesce(F.col("text.reference"), none), F.col("__added"))
    text = F.when(F.col("__added").isNull(), F.col("text")).otherwise(
        F.col("text").withField("reference", merged)
    )
    held = docs.join(added, "row_key", "left").withColumn("text", text).select(*docs.columns)
    present = docs.select("row_key").join(added, "row_key", "left_semi").distinct()
    new = added.join(present, "row_key", "left_anti")
    types = dict(zip(docs.schema.names, docs.schema))
    made = new.select(
        "row_key",
        *[
            (text_struct(reference=F.col("__added")) if c == "text" else F.lit(None)).cast(types[c].dataType).alias(c)
            for c in docs.columns
            if c != "row_key"
        ],
    )
    existed = added.join(present.withColumn("__held", F.lit(True)), "row_key", "left").select(
        "row_key", F.coalesce("__held", F.lit(False)).alias("existed")
    )
    return held.unionByName(made), existed


def with_ingest_date(docs: DataFrame, at: dt.datetime) -> DataFrame:
    """The run's time on every row; given, so that a rerun repeats it."""
    stamp = F.date_format(F.lit(at), ISO_DATE)
    rest = F.map_filter(F.coalesce("meta", F.create_map().cast("map<string,string>")), lambda k, _: k != INGEST_DATE)
    return docs.withColumn("meta", F.map_concat(rest, F.create_map(F.lit(INGEST_DATE), stamp)))
