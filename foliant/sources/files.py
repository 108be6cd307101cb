"""Text trees, annotated corpora, and file inventories."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import sha1_key
from foliant.model import (
    ANNOTATION_SET_TYPE, ANNOTATIONS_TYPE, META_TYPE, empty_annotations, meta_map, src_struct, text_struct,
)
from foliant.session import written
from foliant.sources.ranged import is_folder, listed, opened


SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)"


def relative_path(full: Column, root: Column) -> Column:
    """The part of a file path below its root folder, whatever the file system."""
    bare = F.regexp_replace(full, SCHEME, "")
    base = F.regexp_replace(F.regexp_replace(root, SCHEME, ""), "/+$", "")
    return F.when(F.startswith(bare, F.concat(base, F.lit("/"))), F.substr(bare, F.length(base) + 2)).otherwise(bare)


def file_path() -> Column:
    """The plain path of the file a row was read from; a plus sign is no blank."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


#: Suffixes of the files that a text reader unpacks.
PACKED = (".bz2", ".deflate", ".gz", ".lz4", ".snappy", ".zst")


def _is_plain(glob: str) -> bool:
    """Whether every file that a glob matches is named as one that is not packed."""
    end = re.split(r"[*?\[\]{}\\]", glob)[-1]
    return "." in end and not end.endswith(PACKED)


#: Files of a tree that the driver lists and deals out, at most.
LISTED = 10_000
#: Folders that a task lists, about, and bytes of files that it is dealt.
FOLDERS = 1000
TASK_BYTES = 8 << 20
#: Names, and bytes and files, that a task hands on at once.
NAMES = 10_000
PORTION_BYTES, PORTION_FILES = 4 << 20, 500


def _is_hidden(name: str, of_folder: bool) -> bool:
    """Whether Spark's file sources leave out a name."""
    hidden = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
    return hidden and not (of_folder and name.startswith(("_metadata", "_common_metadata")))


def _batch(values: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*values), schema.types)], schema=schema)


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is in each folder: (path, length), the length of a folder null."""
    schema = pa.schema([("path", pa.string()), ("length", pa.int64())])
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            held = []
            for name, length in listed(folder):
                if _is_hidden(name, length is None):
                    continue
                held.append((f"{folder}/{name}", length))
                if len(held) == NAMES:
                    yield _batch(held, schema)
                    held = []
            if held:
                yield _batch(held, schema)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) of each path, in portions of some bytes."""
    schema = pa.schema([("path", pa.string()), ("content", pa.binary())])
    held, size = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with opened(path) as file:
                held.append((path, file.read()))
            size += len(held[-1][1])
            if size >= PORTION_BYTES or len(held) == PORTION_FILES:
                yield _batch(held, schema)
                held, size = [], 0
    if held:
        yield _batch(held, schema)


def _files_below(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, length) of the files below a folder that Spark's file sources would read, empty ones left out as there.

    Tasks list the folders, level by level, and write the names; none of them comes to the driver.
    """
    cores = spark.sparkContext.defaultParallelism
    folders, n, levels = spark.createDataFrame([(root,)], "path string"), 1, []
    while n:
        dealt = folders.repartition(min(n, cores + n // FOLDERS), "path")
        names = written(dealt.mapInArrow(_names, "path string, length long"), "names")
        levels.append(names.where("length > 0"))
        folders = names.where("length is null").select("path")
        n = folders.count()
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    name = F.substring_index("path", "/", -1)
    return reduce(DataFrame.unionByName, levels).where(F.rlike(name, F.lit(rf"(?s)\A(?:{pattern})\z")))


def read_text_tree(spark: SparkSession, root: str, source: str, glob: str = "*.txt", tasks: int | None = None) -> DataFrame:
    """One document per text file below root, keyed by its relative path.

    Plain files are read as bytes: the text reader copies the whole Hadoop configuration,
    under a lock, for every file. A scan deals some 32 small files to a task; if tasks
    is given, there are no more tasks than that. A scan's files are listed and held by the
    driver; those of a tree of many are listed, dealt out and opened by tasks, unless
    only Spark can open them.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if not _is_plain(glob):
        files = reader.text(root, wholetext=True).select(file_path().alias("path"), F.col("value").alias("content"))
        return text_docs(files if tasks is None else files.coalesce(tasks), root, source)
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    if is_folder(full):
        below = _files_below(spark, full, glob)
        n, held = below.agg(F.count("*"), F.sum("length")).first()
        if n > LISTED:
            dealt = tasks or max(spark.sparkContext.defaultParallelism, -(-held // TASK_BYTES))
            read = below.select("path").repartition(dealt, "path").mapInArrow(_contents, "path string, content binary")
            return text_docs(read.select("path", F.col("content").cast("string")), root, source)
    files = reader.format("binaryFile").load(root).select(file_path().alias("path"), F.col("content").cast("string"))
    return text_docs(files if tasks is None else files.coalesce(tasks), root, source)


def text_docs(files: DataFrame, root: str, source: str) -> DataFrame:
    """I1 for a table (path, content)."""
    key = relative_path(F.col("path"), F.lit(root))
    return files.select(
        key.alias("row_key"),
        src_struct(name=F.lit(source), id=key).alias("src"),
        meta_map(fullPath=F.col("path")).alias("meta"),
        text_struct(orig=F.col("content")).alias("text"),
        empty_annotations().alias("annotations"),
    )


def corpus_docs(
    documents: DataFrame, annotations: DataFrame, source: str, key: Callable[..., Column] = sha1_key
) -> DataFrame:
    """Documents (doc_id, text, meta map) with annotation rows
    (doc_id, set, id, start, end, type, features), keyed by SHA-1 of source:id
    or by the given key function of source and id (U8).

    Annotations are gathered per document and set; the set of one document is
    one value of its row. They are partitioned by document once, for both
    groupings and the join.
    """
    spans = (
        annotations.repartition("doc_id")
        .groupBy("doc_id", "set")
        .agg(F.collect_list(F.struct("start", "end", "id", "type", "features")).alias("spans"))
        .select("doc_id", "set", F.array_sort("spans", _by_place).alias("spans"))
    )
    ordered = F.transform(
        "spans", lambda s: F.struct(*[s[f].alias(f) for f in ("id", "start", "end", "type", "features")])
    ).cast(ANNOTATION_SET_TYPE)
    sets = (
        spans.select("doc_id", "set", ordered.alias("spans"))
        .groupBy("doc_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("set", "spans"))).alias("annotations"))
    )
    rows = documents.join(sets, "doc_id", "left")
    id = F.col("doc_id").cast("string")
    return rows.select(
        key(F.lit(source), id).alias("row_key"),
        src_struct(name=F.lit(source), id=id).alias("src"),
        F.map_filter("meta", lambda _, v: v.isNotNull()).cast(META_TYPE).alias("meta"),
        text_struct(raw=F.col("text")).alias("text"),
        F.coalesce("annotations", F.create_map().cast(ANNOTATIONS_TYPE)).alias("annotations"),
    )


def _by_place(a: Column, b: Column) -> Column:
    """Order by start, end, id; feature maps cannot be compared."""
    order = F.lit(0)
    for field in ("id", "end", "start"):
        order = F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(order)
    return order


def file_inventory(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, glob: str | None = None) -> DataFrame:
    """(path, length) of files under paths and globs; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return reader.load(paths).select("path", "length")


def inventory_below(files: DataFrame, root: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """I11 for a listing (path, length): the files below a folder, by name."""
    below = relative_path(F.col("path"), F.lit(root))
    chosen = files.where(below != F.regexp_replace("path", SCHEME, ""))
    if not recursive:
        chosen = chosen.where(~F.contains(below, F.lit("/")))
    if glob is not None:
        name = F.regexp_extract("path", r"([^/]*)$", 1)
        chosen = chosen.where(F.rlike(name, F.lit(fnmatch.translate(glob))))
    return chosen.select("path", "length")


def total_size(inventory: DataFrame) -> DataFrame:
    """I11."""
    return inventory.agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes")
    )


