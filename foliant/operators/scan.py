"""Selecting rows and columns of the cells and docs tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import parse_time, trimmed
from foliant.operators.rows import first_keys, key_intervals, key_side, long_result, with_index
from foliant.operators.upsert import newest


@dataclasses.dataclass(frozen=True)
class ScanSpec:
    """What to read. Every selector given must hold.

    columns: ``family`` or ``family:qualifier`` entries to fetch (all if empty).
    equals: (family, qualifier, value) tests on rows; missing says whether a
    row without the column is dropped or kept.
    start_row is included, stop_row is not; the time range is half-open and an
    exact timestamp gives way to it. keys: table with a row_key column.
    versions: "newest" reduces a history table to one version per column after
    the time selection; "all" reads cells as they are.
    """

    columns: Sequence[str] = ()
    equals: Sequence[tuple[str, str, str]] = ()
    missing: str = "drop"
    start_row: str | None = None
    stop_row: str | None = None
    time_range: tuple[str, str] | None = None
    timestamp: str | None = None
    source: str | None = None
    keys: DataFrame | None = None
    limit: int | None = None
    versions: str = "all"

    def __post_init__(self):
        if self.missing not in ("drop", "keep"):
            raise ValueError("missing is drop or keep")
        if self.versions not in ("all", "newest"):
            raise ValueError("versions is all or newest")
        if self.limit is not None and self.limit < 0:
            raise ValueError("limit is not negative")
        for text in (*(self.time_range or ()), *([self.timestamp] if self.timestamp else [])):
            parse_time(text)


def column_is(family: str, qualifier: str | None = None) -> Column:
    test = F.col("family") == family
    return test if qualifier is None else test & (F.col("qualifier") == qualifier)


def fetched(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named families or columns."""
    if not columns:
        return cells
    test = F.lit(False)
    for name in columns:
        family, _, qualifier = name.partition(":")
        test = test | column_is(family, qualifier or None)
    return cells.where(test)


def key_range(start: str | None, stop: str | None) -> Column:
    """S8."""
    test = F.lit(True)
    if start is not None:
        test = test & (F.col("row_key") >= start)
    if stop is not None:
        test = test & (F.col("row_key") < stop)
    return test


def in_time(time_range: tuple[str, str] | None, timestamp: str | None) -> Column:
    """A range, given as well, wins over the exact timestamp."""

    def moment(value: str) -> Column:
        return F.timestamp_micros(F.lit(_micros(parse_time(value))))

    if time_range is not None:
        low, high = time_range
        return (F.col("ts") >= moment(low)) & (F.col("ts") < moment(high))
    if timestamp is not None:
        return F.col("ts") == moment(timestamp)
    return F.lit(True)


def _micros(moment: dt.datetime) -> int:
    return (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def rows_where(cells: DataFrame, family: str, qualifier: str, value: str, missing: str = "drop") -> DataFrame:
    """S3: all cells of the rows whose column equals the value."""
    column = cells.where(column_is(family, qualifier))
    if missing == "drop":
        return cells.join(key_side(column.where(F.col("value") == value)), "row_key", "left_semi")
    return cells.join(key_side(column.where(F.col("value") != value)), "row_key", "left_anti")


def first_rows(cells: DataFrame, n: int) -> DataFrame:
    """The cells, or the document, of the first n rows in key order.

    A task gives its first n keys; they alone are counted and put in order. The
    rows are then read by ranges of the keys.
    """
    return keyed_rows(cells, first_keys(cells, n))


def every_nth_row(cells: DataFrame, n: int) -> DataFrame:
    """The cells of every n-th row in key order, counted from 1."""
    if n < 1:
        raise ValueError("n is at least 1")
    numbered = with_index(cells.select("row_key").distinct(), ["row_key"])
    nth = numbered.where((F.col("idx") + 1) % n == 0)
    return cells.join(key_side(nth), "row_key", "left_semi")


def scan_cells(cells: DataFrame, spec: ScanSpec) -> DataFrame:
    """All selectors of a scan over cells.

    Key and time tests come first, since they reach the file scan; row tests
    then see only what is left; the fetch list is applied last so that a row
    test may look at a column that is not fetched.
    """
    chosen = cells.where(key_range(spec.start_row, spec.stop_row) & in_time(spec.time_range, spec.timestamp))
    if spec.keys is not None:
        chosen = rows_with_keys(chosen, spec.keys)
    if spec.versions == "newest":
        chosen = newest(chosen)
    tests = list(spec.equals)
    if spec.source is not None:
        tests.append(("src", "name", spec.source))
    for family, qualifier, value in tests:
        chosen = rows_where(chosen, family, qualifier, value, spec.missing)
    out = fetched(chosen, spec.columns)
    return out if spec.limit is None else first_rows(out, spec.limit)


def scan_docs(docs: DataFrame, spec: ScanSpec) -> DataFrame:
    """The same row selectors over docs: plain filters, no join but the key list."""
    from foliant.operators.annotate import field_value

    if spec.time_range is not None or spec.timestamp is not None or spec.versions == "newest":
        raise ValueError("docs hold no cell times; scan the cells")
    chosen = docs.where(key_range(spec.start_row, spec.stop_row))
    tests = [(f"{f}:{q}", v) for f, q, v in spec.equals]
    if spec.source is not None:
        tests.append(("src:name", spec.source))
    for name, value in tests:
        test = field_value(name) == value
        # A plain equality is pushed down to the file scan.
        chosen = chosen.where(test if spec.missing == "drop" else test | field_value(name).isNull())
    if spec.keys is not None:
        chosen = rows_with_keys(chosen, spec.keys)
    if spec.limit is not None:
        chosen = first_rows(chosen, spec.limit)
    families = {name.partition(":")[0] for name in spec.columns}
    return chosen.select("row_key", *[f for f in docs.columns if f in families]) if families else chosen


def printed(cells: DataFrame) -> DataFrame:
    """``key -> family:qualifier:::value`` lines."""
    line = F.concat("row_key", F.lit(" -> "), "family", F.lit(":"), "qualifier", F.lit(":::"), "value")
    return cells.select(line.alias("line"))


def key_values(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """S6."""
    return cells.where(column_is(family, qualifier)).select("row_key", "value")


def row(table: DataFrame, key: str) -> DataFrame:
    """One row by its key, of cells or docs."""
    return table.where(F.col("row_key") == key)


def key_list(lines: DataFrame) -> DataFrame:
    """Distinct keys of key-file lines; blank and # lines do not count."""
    keys = lines.select(trimmed(F.col("value")).alias("row_key"))
    return keys.where((F.col("row_key") != "") & ~F.col("row_key").startswith("#")).distinct()


def read_key_list(spark, paths) -> DataFrame:
    return key_list(spark.read.text(paths))


def rows_with_keys(table: DataFrame, keys: DataFrame, keep_missing: bool = False) -> DataFrame:
    """The rows of the listed keys; keep_missing adds empty rows for misses.

    The ranges in which the keys lie are pushed to the file scan, so that a list of
    near keys reads the files of these ranges alone. Beyond the broadcast threshold
    the join is by key, and adaptive execution splits a key with very many cells.
    """
    wanted = key_side(keys)
    if keep_missing:
        return wanted.join(table.where(key_intervals(wanted)), "row_key", "left")
    return keyed_rows(table, wanted)


def keyed_rows(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of a written list of keys."""
    return table.where(key_intervals(wanted)).join(wanted, "row_key", "left_semi")


def rows_exist(keys: DataFrame, table: DataFrame) -> DataFrame:
    """(row_key, row_exists) for a batch of keys."""
    wanted = key_side(keys)
    present = keyed_rows(table.select("row_key"), wanted).distinct()
    return wanted.join(present.withColumn("__present", F.lit(True)), "row_key", "left").select(
        "row_key", F.coalesce("__present", F.lit(False)).alias("row_exists")
    )


def row_sizes(cells: DataFrame) -> DataFrame:
    """(row_key, n_bytes): value bytes per row; only lengths are shuffled."""
    return (
        cells.select("row_key", F.octet_length("value").cast("bigint").alias("b"))
        .groupBy("row_key")
        .agg(F.sum("b").alias("n_bytes"))
    )


def rows_within_size(cells: DataFrame, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The cells of rows up to max_bytes, and the counters.

    Counters: the log10 size histogram over all rows and the skipped rows.
    """
    sizes = row_sizes(cells)
    large = sizes.where(F.col("n_bytes") > max_bytes).select("row_key")
    magnitude = F.floor(F.log10("n_bytes") + 0.5).cast("int")
    histogram = sizes.groupBy(magnitude.alias("m")).agg(F.count("*").alias("n")).select(
        *long_result("row size log10", F.col("m"), F.col("n"))
    )
    skipped = large.agg(F.count("*").alias("n")).select(
        *long_result("rows", f"skip -- row too large ({max_bytes})", F.col("n"))
    )
    return cells.join(key_side(large), "row_key", "left_anti"), histogram.unionByName(skipped)


def text_status(max_chars: int) -> Column:
    length = F.length(F.col("text")["raw"])
    return (
        F.when(F.coalesce(length, F.lit(0)) == 0, "skip -- no raw text")
        .when(length > max_chars, f"skip -- raw text too long ({max_chars})")
        .otherwise("kept")
    )


def docs_within_text_size(docs: DataFrame, max_chars: int) -> tuple[DataFrame, DataFrame]:
    """Documents with text up to max_chars, and counts by reason."""
    kept = docs.where(text_status(max_chars) == "kept")
    reasons = docs.groupBy(text_status(max_chars).alias("reason")).agg(F.count("*").alias("n"))
    return kept, reasons.select(*long_result("rows", F.col("reason"), F.col("n")))
