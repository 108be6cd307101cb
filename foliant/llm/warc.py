"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some whole WARC
records, and a seek table in a skippable frame at its end (the seekable format:
sizes of every frame, their number, a flag byte and a magic number). The index
maps a record's identifier to its bundle, its frame and its place in the frame's
content, so that one record is read by decompressing one frame.

Each task writes bundles of its own, straight to the shared folder, holding one
frame at a time. File names are new for every attempt of a task; the index,
written by Spark with the attempt that counts, alone says which files are valid.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import fresh_path, written

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")

INDEX = "record_id string, page_id bigint, bundle string, frame int, offset bigint, length bigint, frame_start bigint, frame_size bigint"
_INDEX = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64()), ("frame_start", pa.int64()), ("frame_size", pa.int64())]
)
RECORDS = "page_id bigint, url string, record_type string, payload_digest string, refers_to bigint, payload binary"
_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


@dataclass(frozen=True)
class Bundles:
    """least: bytes of a payload that may be revisited. frame, bundle: content bytes
    after which a frame and a file end."""

    least: int = 1000
    frame: int = 256 << 10
    bundle: int = 64 << 20
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"


def open_path(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


# Records.


def record_name(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> tuple[str, bytes]:
    """(record id, bytes) of a response, or of a revisit without payload if refers_to is given."""
    name = record_name(page_id, digest)
    # A header is one line: whatever would end it is percent encoded.
    target = "".join(f"%{ord(c):02X}" if c < " " or c == "%" else c for c in url) if url is not None else None
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if target is not None:
        head.append(f"WARC-Target-URI: {target}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_name(refers_to, digest)}")
        head.append(f"X-Refers-To-Page-ID: {refers_to}")
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return name, "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(content: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, place behind the record) of the record that begins at a place."""
    end = content.index(b"\r\n\r\n", at)
    version, *lines = content[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    headers = dict(line.split(": ", 1) for line in lines)
    begin = end + 4
    stop = begin + int(headers["Content-Length"])
    if content[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, content[begin:stop], stop + 4


# Bundles.


class BundleWriter:
    """Writes frames and, at the end, their seek table."""

    def __init__(self, path: str, level: int):
        fs, place = open_path(path)
        fs.create_dir(place.rpartition("/")[0], recursive=True)
        # The stream must not compress by the name of the file.
        self.path, self.out = path, fs.open_output_stream(place, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.sizes: list[tuple[int, int]] = []
        self.at, self.content = 0, 0

    def frame(self, content: bytes) -> tuple[int, int, int]:
        """(number, place in the file, size there) of a new frame."""
        packed = self.compressor.compress(content)
        self.out.write(packed)
        self.sizes.append((len(packed), len(content)))
        place = self.at
        self.at += len(packed)
        self.content += len(content)
        return len(self.sizes) - 1, place, len(packed)

    def close(self) -> None:
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes) + FOOTER.pack(len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries)) + entries)
        self.out.close()


class BundleReader:
    """Random access to the frames of a bundle by its seek table alone."""

    def __init__(self, path: str):
        fs, place = open_path(path)
        self.file = fs.open_input_file(place)
        size = self.file.size()
        self.file.seek(size - FOOTER.size)
        count, flags, magic = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError(f"{path} has no seek table")
        self.file.seek(size - FOOTER.size - 8 * count)
        sizes = list(struct.iter_unpack("<II", self.file.read(8 * count)))
        self.frames, at = [], 0
        for packed, content in sizes:
            self.frames.append((at, packed, content))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, content = self.frames[number]
        self.file.seek(at)
        out = zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=content)
        if len(out) != content:
            raise ValueError(f"frame {number} is not as long as its seek table says")
        return out

    def close(self) -> None:
        self.file.close()


def _archiver(folder: str, p: Bundles):
    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle: BundleWriter | None = None
        held: list[tuple[str, int | None, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal bundle, size
            if bundle is None:
                bundle = BundleWriter(f"{folder}/{uuid.uuid4().hex}.warc.zst", p.level)
            number, place, packed = bundle.frame(b"".join(r[2] for r in held))
            rows, at = [], 0
            for name, page, content in held:
                rows.append((name, page, bundle.path, number, at, len(content), place, packed))
                at += len(content)
            held.clear()
            size = 0
            if bundle.content >= p.bundle:
                bundle.close()
                bundle = None
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)

        for batch in batches:
            for page, url, html, refers_to in zip(*(batch.column(i) for i in range(4))):
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                name, content = warc_record(page.as_py(), url.as_py(), payload, hashlib.sha1(payload).hexdigest(), refers_to.as_py(), p.date)
                held.append((name, page.as_py(), content))
                size += len(content)
                if size >= p.frame:
                    yield flush()
        if held:
            yield flush()
        if bundle is not None:
            bundle.close()

    return archive


def archived(pages: DataFrame, folder: str, p: Bundles = Bundles(), id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record per row into bundles below the folder; returns the index.

    Of the rows with equal payloads (UTF-8, null as empty) of at least ``least``
    bytes, that with the largest id is a response and the others revisit it;
    smaller payloads are all responses. A repeated row of the largest id is a
    response each time. A null id is below any other: it is a response only where
    no row of that payload has an id. An empty table writes no file. Other columns
    are not read.

    Ids and digests alone are grouped, and the rows that become revisits are found by
    id: payloads do not move while that list is short enough to be broadcast, and are
    joined with it beyond. A very long payload is a frame of its own, and is held
    once by the task that writes it.
    """
    rows = pages.select(F.col(id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    light = rows.select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size")).where(F.col("size") >= p.least)
    largest = light.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = light.join(largest, "digest").where("page_id is null and refers_to is not null or page_id < refers_to")
    revisits = written(revisits.select("page_id", "digest", "refers_to").distinct(), "revisits")
    same = rows["page_id"].eqNullSafe(revisits["page_id"]) & (F.sha1(payload) == revisits["digest"])
    marked = rows.join(revisits, same, "left").select(rows["page_id"], "url", "html", "refers_to")
    return written(marked.mapInArrow(_archiver(folder, p), INDEX), "index")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, path, number, content = None, None, None, b""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        nonlocal size
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _RECORDS)], schema=_RECORDS)
        held.clear()
        size = 0
        return batch

    for batch in batches:
        for bundle, frame, offset, length, name in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length", "record_id"))):
            if bundle != path:
                if reader is not None:
                    reader.close()
                reader, path, number = BundleReader(bundle), bundle, None
            if frame != number:
                content, number = reader.frame(frame), frame
            headers, payload, end = parse_record(content, offset)
            if end - offset != length or headers["WARC-Record-ID"] != name:
                raise ValueError(f"{bundle}, frame {frame}: the index does not fit the record at {offset}")
            page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
            url = headers.get("WARC-Target-URI")
            if url is not None:
                parts = url.split("%")
                url = parts[0] + "".join(chr(int(x[:2], 16)) + x[2:] for x in parts[1:])
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            held.append((page and int(page), url, headers["WARC-Type"], digest, refers and int(refers), payload))
            size += len(payload) + 200
            if size >= 4 << 20:
                yield out()
    if held:
        yield out()
    if reader is not None:
        reader.close()


def records(index: DataFrame) -> DataFrame:
    """The records that an index, or any part of it, names: page_id, url,
    record_type, payload_digest, refers_to, payload (empty for a revisit).

    A frame is decompressed once for the records that lie in it; each is found by
    its place in the frame and checked against its identifier.
    """
    at_hand = index.repartition("bundle").sortWithinPartitions("bundle", "frame", "offset")
    return at_hand.mapInArrow(_reader, RECORDS)


def shared_folder(spark, name: str = "warc") -> str:
    return fresh_path(spark, name)


def payload_facts(found: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The bytes and the digest are those of the full payload: taken from a
    response's content, and for a revisit from the response it refers to.
    """
    facts = found.select(
        "page_id", "record_type", "refers_to", F.col("payload_digest").alias("named"), F.octet_length("payload").cast("bigint").alias("n"), F.sha1("payload").alias("d")
    )
    facts = written(facts, "facts")
    responses = facts.where("record_type = 'response'")
    targets = responses.where("page_id is not null").select(F.col("page_id").alias("refers_to"), F.col("d").alias("named"), "n").distinct()
    revisits = facts.where("record_type = 'revisit'").drop("n", "d").join(targets, ["refers_to", "named"])
    names = F.col("n").alias("payload_bytes"), F.col("named").alias("payload_digest")
    return responses.select("page_id", names[0], F.col("d").alias("payload_digest"), "record_type", "refers_to").unionByName(
        revisits.select("page_id", *names, "record_type", "refers_to")
    )
