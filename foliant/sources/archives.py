"""Documents out of tar.gz and zip archives.

Archives are files (path, length); tasks open them and read ranges, so that no
archive is ever held as a value, however long it is.

* Zip: the directory at the end of each file becomes a table of entries. Filters and
  caps are DataFrame operations on that table; what is left is spread over tasks by
  archive and place, and each task seeks to its members. One archive can keep
  a whole cluster busy, and an entry that is not wanted is never decompressed.
* Tar: a stream that can only be read from its start, by one task, member after member.

A task holds the member at hand and one batch of results. Members can also be had
in portions of a fixed size. An archive or member that cannot be read is one
row with an error.
"""

from __future__ import annotations

import datetime as dt
import mimetypes
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import iso_date, sha1_key
from foliant.model import INGEST_DATE, empty_annotations, meta_map, src_struct, text_struct
from foliant.operators.rows import counters, with_index
from foliant.session import written
from foliant.sources.ranged import opened

MIB = 1 << 20
#: Bytes of the longest member that is given as one value.
LARGEST = (1 << 31) - 1024
#: Packed bytes that a task reads, about, where the number of entries per task is not given.
TASK_BYTES = 128 * MIB
# What readers raise over damaged members: bad data, a method or a password that is not supported.
DAMAGE = (tarfile.TarError, zipfile.BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError, ValueError)
BATCH_BYTES = 4 * MIB
TOO_LONG = "member of more than 2 GiB"
MEMBERS = "path string, entry string, entry_bytes bigint, is_dir boolean, content binary, error string"
DIRECTORY = (
    "path string, entry string, entry_no bigint, mime_type string, entry_bytes bigint, packed_bytes bigint, "
    "offset bigint, method int, flags int, crc bigint, error string"
)
ENTRIES = "path string, entry string, entry_no bigint, mime_type string, entry_bytes bigint, part bigint, content binary, error string"
Opener = Callable[[str], BinaryIO]


# Types by file name, the same on every machine: no system files are read.
MIME_TYPES = mimetypes.MimeTypes()
MIME_TYPES.add_type("application/xml", ".xml")
for _suffix in (".java", ".cc", ".c++", ".text"):
    MIME_TYPES.add_type("text/plain", _suffix)


def mime_type_of(name: str) -> str | None:
    return MIME_TYPES.guess_type(name, strict=True)[0]


def read_archives(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, length) of archive files; nothing of them is read yet."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select("path", "length")


def listed_archives(spark: SparkSession, list_file: str) -> DataFrame:
    """The archives named in a file, one path per line.

    The names go to the driver, where Spark's own index of the files to read is.
    """
    lines = spark.read.text(list_file).select(F.trim("value").alias("p")).where("p <> ''").distinct()
    paths = [r["p"] for r in lines.toLocalIterator()]
    if not paths:
        raise ValueError(f"{list_file} names no archive")
    return read_archives(spark, paths)


def _dealt(archives: DataFrame) -> DataFrame:
    """Names of archives dealt out over the tasks: files of no read bytes would all lie in one split."""
    paths = archives.select("path")
    return paths.repartition(archives.sparkSession.sparkContext.defaultParallelism, "path")


def _batches(rows: Iterator[dict], columns: Sequence[str]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("content") or b"") + 100
        if size >= BATCH_BYTES:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _reason(error: BaseException) -> str:
    return str(error) or type(error).__name__


def _tar_members(path: str, open_: Opener) -> Iterator[dict]:
    row = {"path": path, "entry": None, "entry_bytes": None, "is_dir": False, "content": None, "error": None}
    try:
        with open_(path) as file, tarfile.open(fileobj=file, mode="r|*") as archive:
            for member in archive:
                found = row | {"entry": member.name, "entry_bytes": member.size, "is_dir": member.isdir()}
                if member.isfile() and member.size > LARGEST:
                    found["error"] = TOO_LONG
                elif member.isfile():
                    found["content"] = archive.extractfile(member).read()
                yield found
                archive.members = []  # the stream does not go back to them
    except DAMAGE as error:  # what follows in the stream is out of reach
        yield row | {"error": _reason(error)}


def tar_members(archives: DataFrame, open_: Opener = opened) -> DataFrame:
    """Every member of every tar archive of a table (path), streamed from the open file."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                yield from _batches(_tar_members(path, open_), _names(MEMBERS))

    return _dealt(archives).mapInPandas(read, MEMBERS)


def text_of(content: str) -> Column:
    """Bytes as UTF-8 text; what is no UTF-8 becomes the replacement character."""
    return F.make_valid_utf8(F.col(content).cast("string"))


def is_repaired(content: str) -> Column:
    return F.coalesce(~F.is_valid_utf8(F.col(content).cast("string")), F.lit(False))


def tar_docs(
    archives: DataFrame, source: str, at: dt.datetime | None = None, key: Callable[[Column], Column] = sha1_key, open_: Opener = opened
) -> DataFrame:
    """One document per file in the archives.

    The key is the SHA-1 (U8: or another function) of the name of the archive's
    folder followed by the member name. Folders are skipped; an archive that breaks off keeps what
    was read before (see ``tar_counts``).
    """
    parent = F.coalesce(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), F.lit(""))
    files = tar_members(archives, open_).where(F.col("content").isNotNull())
    id = F.concat(parent, F.col("entry"))
    meta = meta_map() if at is None else meta_map(**{INGEST_DATE: iso_date(F.lit(at))})
    return files.select(
        key(id).alias("row_key"),
        src_struct(name=F.lit(source), id=id, parent=parent, file=F.col("entry")).alias("src"),
        meta.cast("map<string,string>").alias("meta"),
        text_struct(orig=text_of("content"), mimeType=F.lit("text/xml")).alias("text"),
        empty_annotations().alias("annotations"),
    )


def tar_counts(archives: DataFrame, open_: Opener = opened) -> DataFrame:
    """Members added and skipped, texts repaired, and archives that broke off."""
    return counters(
        tar_members(archives, open_),
        "ImportNYT",
        **{
            "import file": F.col("content").isNotNull(),
            "skip dir": F.col("is_dir"),
            "broken archive": F.col("error").isNotNull(),
            "repaired text": is_repaired("content"),
        },
    )


# -- zip -----------------------------------------------------------------------


def _directory(path: str, open_: Opener) -> Iterator[dict]:
    row = dict.fromkeys(_names(DIRECTORY)) | {"path": path}
    try:
        with open_(path) as file, zipfile.ZipFile(file) as archive:
            for number, info in enumerate(archive.infolist()):
                if not info.is_dir():
                    yield row | {
                        "entry": info.filename,
                        "entry_no": number,
                        "mime_type": mime_type_of(info.filename),
                        "entry_bytes": info.file_size,
                        "packed_bytes": info.compress_size,
                        "offset": info.header_offset,
                        "method": info.compress_type,
                        "flags": info.flag_bits,
                        "crc": info.CRC,
                    }
    except DAMAGE as error:
        yield row | {"error": _reason(error)}


def zip_directory(archives: DataFrame, open_: Opener = opened) -> DataFrame:
    """I4: the entries of zip archives (path), from the directories at their ends, written.

    Names, sizes and places; folders are left out. No member is read. An archive
    without a directory that can be read is one row with an error.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                yield from _batches(_directory(path, open_), _names(DIRECTORY))

    return written(_dealt(archives).mapInPandas(read, DIRECTORY), "directory")


def _member(file: BinaryIO, entry) -> zipfile.ZipExtFile:
    """A member as a stream, found by its place in the directory."""
    file.seek(entry.offset)
    head = file.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member where the directory says")
    if entry.flags & 1:
        raise RuntimeError("member is encrypted")
    file.seek(entry.offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    info = zipfile.ZipInfo(entry.entry)
    info.compress_type, info.flag_bits = int(entry.method), int(entry.flags)
    info.compress_size, info.file_size, info.CRC = int(entry.packed_bytes), int(entry.entry_bytes), int(entry.crc)
    return zipfile.ZipExtFile(file, "r", info)


def _contents(frame: pd.DataFrame, open_: Opener, portion: int | None) -> Iterator[dict]:
    """The members that a frame of the directory names: whole, or a row per portion."""
    file, at = None, None
    try:
        for entry in frame.sort_values(["path", "entry_no"]).itertuples(index=False):
            row = {c: getattr(entry, c) for c in ("path", "entry", "entry_no", "mime_type", "entry_bytes")} | {"part": 0, "content": None, "error": None}
            try:
                if at != entry.path:
                    if file is not None:
                        file.close()
                    file, at = None, None
                    file, at = open_(entry.path), entry.path
                if portion is None and entry.entry_bytes > LARGEST:
                    yield row | {"error": TOO_LONG}
                    continue
                with _member(file, entry) as member:
                    content, part = member.read(portion or -1), 0
                    while content or not part:
                        yield row | {"content": content, "part": part}
                        part += 1
                        content = member.read(portion) if portion else b""
            except DAMAGE as error:  # the other members are still there
                yield row | {"error": _reason(error)}
    finally:
        if file is not None:
            file.close()


def _read(entries: DataFrame, entries_per_task: int | None, open_: Opener, portion: int | None = None) -> DataFrame:
    """The contents of written entries, consecutive ones of an archive to a task."""
    count, packed = entries.agg(F.count("*"), F.sum("packed_bytes")).first()
    tasks = -(-(packed or 0) // TASK_BYTES) if entries_per_task is None else -(-count // entries_per_task)
    tasks = max(1, tasks, min(count, entries.sparkSession.sparkContext.defaultParallelism) if entries_per_task is None else 1)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from _batches(_contents(frame, open_, portion), _names(ENTRIES))

    return entries.drop("error").repartitionByRange(tasks, "path", "entry_no").mapInPandas(read, ENTRIES)


def chosen_entries(
    directory: DataFrame, mime_types: Sequence[str] = (), max_mib: float | None = None, max_entries: int | None = None
) -> DataFrame:
    """I4: the entries of a directory that are wanted, by the MIME type guessed from
    their name, by size, and by place: max_entries caps them by (path, place in archive)."""
    found = directory.where(F.col("error").isNull())
    wanted = sorted({m.lower() for m in mime_types if m})
    if wanted:
        found = found.where(F.lower("mime_type").isin(wanted))
    if max_mib is not None:
        found = found.where(F.col("entry_bytes") <= int(max_mib * MIB))
    if max_entries is not None:
        place = ["path", "entry_no"]
        first = written(with_index(found.select(*place), place).where(F.col("idx") < max_entries).select(*place), "entries")
        found = found.join(first, place, "left_semi")
    return found


def zip_entries(
    archives: DataFrame,
    mime_types: Sequence[str] = (),
    max_mib: float | None = None,
    max_entries: int | None = None,
    entries_per_task: int | None = None,
    open_: Opener = opened,
) -> DataFrame:
    """I4: (row_key, path, entry, mime_type, entry_bytes, content) of zip archives.

    Entries are chosen from the directories (see ``chosen_entries``), and only those
    are read, spread over the tasks by archive and place: so many to a task, or as
    many as make about ``TASK_BYTES``. Members that cannot be read are left out (see
    ``broken_zips``).
    """
    if entries_per_task is not None and entries_per_task < 1:
        raise ValueError("entries_per_task is at least 1")
    chosen = written(chosen_entries(zip_directory(archives, open_), mime_types, max_mib, max_entries), "chosen")
    found = _read(chosen, entries_per_task, open_).where(F.col("error").isNull())
    key = F.concat_ws("-", "path", "entry")
    return found.select(key.alias("row_key"), "path", "entry", "mime_type", "entry_bytes", "content")


def zip_portions(entries: DataFrame, portion: int = BATCH_BYTES, open_: Opener = opened) -> DataFrame:
    """(path, entry, entry_no, part, content, error): members of a directory in portions of so many bytes.

    For members of any length: a task holds one portion, and a batch of them. A
    member that turns out to be damaged has a row with an error after its good portions.
    """
    return _read(entries, None, open_, portion).select("path", "entry", "entry_no", "part", "content", "error")


def zip_text(entries: DataFrame) -> DataFrame:
    """Entry contents as text."""
    return entries.select("row_key", "entry", "mime_type", text_of("content").alias("text"))


def zip_members(archives: DataFrame, open_: Opener = opened) -> DataFrame:
    """Every entry of every zip archive, those that cannot be read with an error and no content."""
    directory = zip_directory(archives, open_)
    good = directory.where(F.col("error").isNull())
    bad = directory.where(F.col("error").isNotNull())
    columns = ["path", "entry", "mime_type", "entry_bytes", "content", "error"]
    return _read(good, None, open_).select(*columns).unionByName(bad.withColumn("content", F.lit(None).cast("binary")).select(*columns))


def broken_zips(archives: DataFrame, open_: Opener = opened) -> DataFrame:
    """Archives (entry null) and entries that cannot be read, with the reason."""
    return zip_members(archives, open_).where(F.col("error").isNotNull()).select("path", "entry", "error")
