"""Scans, counts, sizes, deletes and writes on small cells tables."""

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliant.model import cells_to_docs, docs_to_cells
from foliant.operators import clean, profile, rows, scan, sizes, upsert
from foliant.operators.rows import join_hot, with_index
from foliant.operators.scan import ScanSpec
from foliant.sources import store
from foliant.sources.celltable import CellTable
from tests.conftest import counts, table

KEYS = ("row_key",)


@pytest.fixture
def small(cells_of):
    return cells_of(
        ("1", "src:name", "foo"),
        ("1", "meta:lang", "en", 2),
        ("1", "text:raw", "é" * 600, 3),
        ("2", "src:name", "FOO"),
        ("2", "meta:lang", "a=b:c"),
        ("2", "meta:2010-01", "x"),
        ("2", "meta:x2010", "x"),
        ("k3", "meta:lang", " ", 5),
        ("k3", "text:raw", "z" * 1024),
    )


def keys(frame):
    return sorted({r["row_key"] for r in frame.select("row_key").collect()})


def test_equality_sees_whole_values(small):
    assert keys(scan.scan_cells(small, ScanSpec(equals=[("meta", "lang", "a=b:c")]))) == ["2"]


def test_rows_without_the_column(small):
    by_source = {"equals": [("src", "name", "foo")]}
    assert keys(scan.scan_cells(small, ScanSpec(**by_source))) == ["1"]
    assert keys(scan.scan_cells(small, ScanSpec(**by_source, missing="keep"))) == ["1", "k3"]


def test_ranges_are_half_open(small):
    assert keys(scan.scan_cells(small, ScanSpec(start_row="1", stop_row="2"))) == ["1"]
    found = scan.scan_cells(small, ScanSpec(time_range=("2024-01-02", "2024-01-05")))
    assert sorted(r["qualifier"] for r in found.collect()) == ["lang", "raw"]
    exact = ScanSpec(timestamp="2024-01-05", time_range=("2024-01-02", "2024-01-03"))
    assert [r["value"] for r in scan.scan_cells(small, exact).collect()] == ["en"]


def test_unreadable_time_is_an_error():
    with pytest.raises(ValueError):
        ScanSpec(time_range=("2024-01", "soon"))


def test_limit_and_nth_row(small):
    assert keys(scan.scan_cells(small, ScanSpec(limit=2))) == ["1", "2"]
    assert keys(scan.every_nth_row(small, 2)) == ["2"]
    assert keys(scan.scan_cells(small, ScanSpec(limit=20_000))) == ["1", "2", "k3"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_first_rows_move_few_keys(spark, tmp_path):
    cells = spark.range(20_000).select(
        F.lpad((F.col("id") * 7919 % 10_000).cast("string"), 5, "0").alias("row_key"),
        F.lit("m").alias("family"), F.lit("a").alias("qualifier"), F.current_timestamp().alias("ts"), F.lit("v").alias("value"),
    )
    store.write_cells(cells, str(tmp_path / "c"))
    cells = store.read_cells(spark, str(tmp_path / "c"))
    every = [f"{i:05d}" for i in range(10_000)]
    for n in (0, 1, 10, 999, 2500, 9_999, 10_000, 50_000):
        found = scan.first_rows(cells, n)
        assert keys(found) == every[:n] and found.count() == 2 * min(n, 10_000)
    # What leaves the tasks: no more than n keys of each.
    tasks = cells.select("row_key").withColumn("task", F.spark_partition_id()).select("task").distinct().count()
    moved = cells.select("row_key").mapInArrow(rows._smallest(10), "row_key string")
    assert moved.count() <= 10 * max(tasks, 1) and tasks >= 1
    assert "MapInArrow" in plan_of(moved) and "Exchange" not in plan_of(moved)


def test_smallest_keys_of_a_task():
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["row_key"]) for x in (["d", "b", "b"], [], ["é", "a", "Z"], ["c", "b"])]
    for n in (1, 2, 4, 9):
        held = [k for b in rows._smallest(n)(iter(batches)) for k in b.column(0).to_pylist()]
        assert held == sorted({"a", "b", "c", "d", "Z", "é"}, key=str.encode)[:n]


def test_near_keys_read_few_files(spark, tmp_path):
    path = str(tmp_path / "sorted")
    table_ = spark.range(40_000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("row_key"), F.repeat(F.lit("v"), 50).alias("value"))
    table_.repartitionByRange(40, "row_key").sortWithinPartitions("row_key").write.parquet(path)
    table_ = spark.read.parquet(path)
    near = [f"{i:06d}" for i in range(7_000, 7_100)] + [f"{i:06d}" for i in range(31_000, 31_003)]
    listed = spark.createDataFrame([(k,) for k in near], "row_key string")
    wanted = rows.key_side(listed)
    ranges = rows.key_intervals(wanted)
    files = table_.where(ranges).select("_metadata.file_path").distinct().count()
    assert files <= 6 < table_.select("_metadata.file_path").distinct().count()
    found = scan.rows_with_keys(table_, listed)
    assert "Or(Or(" in plan_of(found).partition("Pushed")[2] and keys(found) == near
    assert scan.rows_with_keys(table_, listed.limit(0)).count() == 0
    missing = spark.createDataFrame([("000001",), ("nothing",), (None,)], "row_key string")
    assert scan.rows_with_keys(table_, missing).count() == 1 and scan.rows_exist(missing, table_).where("row_exists").count() == 1


def test_key_lists(spark, small, tmp_path):
    for n in range(3):
        (tmp_path / f"keys{n}").write_text("".join(f"key-{i}\n" for i in range(n * 202, n * 202 + 202)))
    (tmp_path / "again").write_text("# note\n\n" + "".join(f"  key-{i}\t\n" for i in range(5)))
    assert scan.read_key_list(spark, str(tmp_path)).count() == 606
    listed = spark.createDataFrame([("2",), ("no",), ("2",)], "row_key string")
    assert keys(scan.rows_with_keys(small, listed)) == ["2"]
    assert keys(scan.rows_with_keys(small, listed, keep_missing=True)) == ["2", "no"]
    assert table(scan.rows_exist(listed, small)) == [("2", True), ("no", False)]
    spec = ScanSpec(keys=listed, source="foo")
    assert keys(scan.scan_cells(small, spec)) == []


def test_sizes_count_bytes_and_lengths_count_characters(small):
    assert dict(table(scan.row_sizes(small)))["1"] == 3 + 2 + 1200
    z5 = counts(sizes.column_length_distribution(small, "text", "raw"))
    assert z5[("kb size", "0")] == 1 and z5[("kb size", "1")] == 1 and z5[("total", "total rows")] == 2


@pytest.mark.parametrize(
    ("size", "upper", "lower"),
    [
        (0, "1 K", 0), (1023, "1 K", 0), (1024, "10 K", 1), (10240, "100 K", 10), (20479, "100 K", 10),
        (102400, "200 K", 100), (921599, "900 K", 100), (921600, "1 M", 100), (1048575, "1 M", 100),
        (1048576, "2 M", 100), (10485759, "10 M", 100), (10485760, "100 M", 100), (104857600, "BIG", 100),
    ],
)
def test_bins(spark, size, upper, lower):
    row = spark.range(1).select(sizes.upper_bin(F.lit(size)), sizes.lower_bin(F.lit(size))).first()
    assert tuple(row) == (upper, lower)


def test_large_rows_are_skipped(small):
    kept, counted = scan.rows_within_size(small, 1000)
    assert keys(kept) == ["2"]
    assert counts(counted)[("rows", "skip -- row too large (1000)")] == 2


def test_counts(small):
    assert profile.count_rows(small).first()["n"] == 3
    assert profile.count_rows_with_column(small, "src", "name").first()["n"] == 2
    assert profile.count_rows_without_column(small, "src", "name").first()["n"] == 1
    assert profile.count_rows_with_family(small, "meta").first()["n"] == 3
    assert profile.count_rows_matching(small, "meta", "lang", "b:").first()["n"] == 1
    found = counts(profile.columns_of_source(small, "meta", "Foo"))
    assert found[("CountVals meta", "right source")] == 2
    assert found[("CountVals meta", "-- no src --")] == 1
    assert found[("CountVals", "lang")] == 2


def test_subvalues(cells_of):
    found = counts(profile.column_subvalues(cells_of(("1", "m:t", "\ta \tb\t\t"), ("2", "m:t", " \t"), ("3", "m:u", "a")), "m", "t"))
    assert found == {("CountVals", ""): 1, ("CountVals", "a"): 1, ("CountVals", "b"): 1, ("CountVals", profile.EMPTY): 1}


def test_delete_by_source_keeps_rows_without_one(small):
    kept, counted = clean.delete_rows(small, "foo")
    assert keys(kept) == ["2", "k3"] and counts(counted)[("rows", "row deleted")] == 1
    kept, counted = clean.delete_rows(small, "foo", ["text"])
    assert table(kept.where("row_key = '1'"), "qualifier") == [("lang",), ("name",)]
    assert counts(counted)[("rows", "delete column family(text)")] == 1


def test_delete_columns_by_whole_name(small):
    kept, counted = clean.delete_columns_matching(small, "FOO")
    assert ("x2010",) in table(kept, "qualifier") and ("2010-01",) not in table(kept, "qualifier")
    assert counts(counted) == {("column deleted", "2010-01"): 1, ("rows", "row changed"): 1}
    kept, counted = clean.delete_columns_matching(small, "foo")
    assert kept.count() == small.count() and counts(counted) == {("rows", "row changed"): 0}


def test_delete_large_rows(cells_of):
    mib = 1 << 20
    cells = cells_of(("a", "t:x", "y" * mib), ("a", "t:b", "s"), ("b", "t:x", "y" * (mib - 1)), ("c", "u:x", "y" * mib))
    kept, counted = clean.delete_large_rows(cells, "t")
    assert keys(kept) == ["b", "c"]
    assert counts(counted) == {("delete", "1"): 1, ("size x", "1 M"): 1}


def test_delete_column_with_a_filter_on_another_family(small):
    kept, counted = clean.delete_column(small, "meta", "lang", ("src", "name", "foo"))
    assert keys(kept.where("qualifier = 'lang'")) == ["2", "k3"] and counts(counted) == {("rows", "row changed"): 1}
    assert clean.delete_column(small, "meta")[0].where("family = 'meta'").count() == 0


def test_delete_numeric_keys(small):
    kept, counted = clean.delete_numeric_keys(small)
    assert keys(kept) == ["k3"] and counts(counted) == {("rows", "row deleted"): 2}


def test_upsert(cells_of):
    old = cells_of(("1", "m:a", "old", 5), ("1", "m:b", "keep", 5), ("1", "m:c", "tie", 5))
    put = cells_of(("1", "m:a", "older", 4), ("1", "m:b", " ", 6), ("1", "m:c", "put", 5), ("2", "m:a", "new", 1))
    assert table(upsert.upsert(old, put), "row_key", "qualifier", "value") == [
        ("1", "a", "old"), ("1", "b", "keep"), ("1", "c", "put"), ("2", "a", "new"),
    ]


def test_references_are_whole(spark, cells_of):
    docs = cells_to_docs(cells_of(("1", "text:reference", "12;7"), ("2", "text:raw", "x")))
    refs = spark.createDataFrame([("1", "1"), ("1", "12"), ("9", "5"), ("2", " ")], "row_key string, reference string")
    out, existed = upsert.append_references(docs, refs)
    found = {r["row_key"]: r["text"]["reference"] for r in out.collect()}
    assert found == {"1": ["12", "7", "1"], "2": None, "9": ["5"]}
    assert table(existed) == [("1", True), ("9", False)]


def test_ingest_date(cells_of):
    docs = cells_to_docs(cells_of(("1", "meta:ingestDate", "x")))
    at = dt.datetime(2024, 2, 3, tzinfo=dt.timezone.utc)
    assert upsert.with_ingest_date(docs, at).first()["meta"] == {"ingestDate": "2024-02-03T00:00:00Z"}


def test_one_document_round_trip(cells_of):
    rows = [("k", "src:name", "test"), ("k", "src:id", "k"), ("k", "text:orig", "Boats come in at noon."), ("k", "text:raw", "raw")]
    docs = cells_to_docs(cells_of(*rows))
    assert docs.first()["text"]["orig"] == "Boats come in at noon."
    back = docs_to_cells(docs)
    assert table(back, "row_key", F.concat_ws(":", "family", "qualifier"), "value") == sorted(rows, key=str)


def test_with_index_is_contiguous_and_ordered(spark):
    frame = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    rows = with_index(frame, ["v"]).collect()
    assert sorted(r["idx"] for r in rows) == list(range(5000))
    assert all(r["idx"] == r["v"] for r in rows)


def test_join_hot_gives_the_plain_join(spark):
    left = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 3000).cast("string"))).alias("k"), "id"
    )
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 3000, 2)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        salted = join_hot(left, right, "k", how).select(*plain.columns)
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_stored_cells_prune_and_join_without_shuffle(spark, small, tmp_path):
    path = str(tmp_path / "cells")
    store.write_cells(small, path)
    back = store.read_cells(spark, path)
    assert table(back) == table(small)
    plan = back.where("family = 'meta' and row_key >= '2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(family" in plan and "GreaterThanOrEqual(row_key,2)" in plan
    spark.sql("drop table if exists cells_by_key")
    bucketed = store.save_cells_by_key(small, "cells_by_key", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = clean.delete_source_rows(bucketed, "foo")[0]
        plan = kept._jdf.queryExecution().executedPlan().toString()
        # Only the list of keys moves.
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        grouped = scan.row_sizes(bucketed)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in grouped
        assert keys(kept) == ["2", "k3"]
        # A write moves the puts, once for each look at the table, and no cell of the table.
        puts = bucketed.withColumn("value", F.concat("value", F.lit("!")))
        merged = upsert.upsert(bucketed, puts)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        tables = [line for line in plan.splitlines() if "Bucketed: true" in line]
        assert len(tables) == 2 and "Bucketed: false" not in plan.replace("Bucketed: false (disabled", "")
        assert plan.count("Exchange hashpartitioning(put_row_key") + plan.count("Exchange hashpartitioning(row_key") == 2
        assert {r["value"][-1] for r in merged.collect()} == {"!"} and merged.count() == bucketed.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table cells_by_key")


def test_deletes_rewrite_touched_files_only(spark, tmp_path):
    cells = spark.range(4000).select(
        F.lpad(F.col("id").cast("string"), 5, "0").alias("row_key"), F.lit("m").alias("family"), F.lit("a").alias("qualifier"),
        F.timestamp_seconds("id").alias("ts"), F.col("id").cast("string").alias("value"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        table_ = CellTable(spark, str(tmp_path / "a table"))
        assert table_.files() == [] and table_.cells().count() == 0
        table_.write(cells)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    before = table_.files()
    state = {f: (tmp_path / "a table" / f).stat().st_mtime_ns for f in before}
    assert len(before) == 20
    one = clean.Doomed(rows.key_side(spark.createDataFrame([("00777",)], "row_key string")))
    old = table_.cells()
    assert table_.delete(one) == (1, 19)
    after = table_.files()
    assert len(set(before) & set(after)) == 19 and len(after) == 20
    assert {f: (tmp_path / "a table" / f).stat().st_mtime_ns for f in set(before) & set(after)}.items() <= state.items()
    assert table_.cells().count() == 3999 and old.count() == 4000
    assert table_.delete(one) == (0, 20) and table_.current() == 1
    # A crash before the name: the files of the next version are no part of the table, and are written again.
    two = clean.Doomed(test=F.col("value").isin("5", "3999"))
    table_._add(spark.createDataFrame([], cells.schema), 2)
    assert table_.cells().count() == 3999
    assert table_.delete(two)[0] == 2 and keys(table_.cells().where("row_key in ('00005', '00006')")) == ["00006"]
    # All cells of a file go; nothing is written for it.
    assert table_.delete(clean.Doomed(test=F.col("row_key") < "00100"))[0] == 1
    table_.clear()
    assert table_.cells().count() == 3997 - 99 and table_.numbers("", r"manifest=(\d+)") == [3]


def test_docs_selectors_reach_the_file_scan(spark, small, tmp_path):
    path = str(tmp_path / "docs")
    cells_to_docs(small).write.parquet(path)
    docs = spark.read.parquet(path)
    found = scan.scan_docs(docs, ScanSpec(source="foo", start_row="1", columns=["meta"]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(src.name,foo)" in plan and "GreaterThanOrEqual(row_key,1)" in plan and "annotations" not in plan
    assert keys(found) == ["1"]
    assert keys(scan.scan_docs(docs, ScanSpec(source="foo", missing="keep"))) == ["1", "k3"]
    assert keys(clean.delete_source_docs(docs, "foo")[0]) == ["2", "k3"]


def test_puts_without_a_time_win(cells_of):
    old = cells_of(("1", "m:a", "old", 5))
    put = cells_of(("1", "m:a", "put")).withColumn("ts", F.lit(None).cast("timestamp"))
    assert table(upsert.upsert(old, put), "value") == [("put",)]
