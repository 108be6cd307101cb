"""Packing tokenized documents into sequences of a fixed length.

Bounded-space online best fit: each task keeps a fixed number of open windows.
A document is cut into whole sequences and a rest; the rest goes to the open
window that it leaves fullest. If it fits none, the fullest window is emitted and
a new one opened. What is still open at the end of the tasks is merged in a last
step by the same rule, whole windows at a time, in groups of a bounded number of
windows. Only rows of numbers are written and joined: a row per piece.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliant.session import written

#: Fixed value: how byte-level BPE of this vocabulary splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, window bigint, offset bigint, open boolean"
)
NAMES = [part.split()[0] for part in PIECES.split(", ")]
_ENCODERS: dict[str, Encoder] = {}


@dataclass(frozen=True)
class Packing:
    """length: tokens of a sequence. end: id that closes a document. windows: open
    at once in a task. merged: leftover windows that meet in one group."""

    vocabulary: str
    length: int = 2048
    end: int = 1
    windows: int = 64
    merged: int = 4096


class Encoder:
    """Ids of a byte-level BPE vocabulary file of the tokenizers library.

    The ranks of the file are handed to tiktoken, which gives the same ids in a
    fifth of the time. A text that it refuses, or that holds an added token of the
    file, such as <|endoftext|>, goes to the tokenizers library in its default
    setting, which gives the added token's id.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ranks = content["model"]["vocab"]
        self.added = [token["content"] for token in content.get("added_tokens") or []]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        added = set(self.added)
        merges = {bytes(byte_of[c] for c in token): i for token, i in ranks.items() if token not in added}
        self.fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        self.path, self.exact = path, None

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def ids(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added):
            return self._exact_ids(text)
        try:
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        except BaseException as error:  # tiktoken's panics are no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit)):
                raise
            return self._exact_ids(text)

    def _exact_ids(self, text: str) -> np.ndarray:
        if self.exact is None:
            self.exact = Tokenizer.from_file(self.path)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


class Windows:
    """The open windows of a task. place() returns the window that had to be emitted, if any."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.open: list[tuple[int, list]] = []  # tokens, pieces

    def place(self, size: int, piece) -> list | None:
        best = max((i for i, (used, _) in enumerate(self.open) if used + size <= self.length), key=lambda i: self.open[i][0], default=None)
        out = None
        if best is None:
            if len(self.open) == self.most:
                out = self.open.pop(max(range(self.most), key=lambda i: self.open[i][0]))[1]
            self.open.append((size, [(0, piece)]))
            return out
        used, pieces = self.open[best]
        pieces.append((used, piece))
        self.open[best] = (used + size, pieces)
        if used + size == self.length:
            return self.open.pop(best)[1]
        return None


def _packer(p: Packing):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, windows = Encoder.of(p.vocabulary), Windows(p.length, p.windows)
        count = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def emit(pieces: list, is_open: bool) -> None:
            nonlocal count
            rows.extend((*piece, count, offset, is_open) for offset, piece in pieces)
            count += 1

        def taken() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], NAMES)
            rows.clear()
            return batch

        for batch in batches:
            for id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(p.end)).astype("<u4")
                for start in range(0, len(ids), p.length):
                    part = ids[start : start + p.length]
                    piece = (id, start, len(part), zlib.crc32(part.tobytes()), len(ids))
                    full = [(0, piece)] if len(part) == p.length else windows.place(len(part), piece)
                    if full:
                        emit(full, False)
                if len(rows) > 20_000:
                    yield taken()
        for _, pieces in windows.open:
            emit(pieces, True)
        if rows:
            yield taken()

    return pack


def _merger(p: Packing):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, out = Windows(p.length, p.merged), []
        found = [x for batch in batches for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        for window, used in sorted(found, key=lambda x: (-x[1], x[0])):
            if full := windows.place(used, window):
                out.append(full)
        out.extend(pieces for _, pieces in windows.open)
        moved = [(window, pieces[0][1], shift) for pieces in out for shift, window in pieces]
        if moved:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*moved)], ["window", "sequence", "shift"])

    return merge


def packed(docs: DataFrame, p: Packing, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, and the id that closes it, lies in exactly one
    piece. A null or empty text is its closing id alone. Repeated rows are packed
    each; a null id stays null; an empty table gives no rows. Sequence ids are
    unique but not dense. A very long text is encoded whole by its task, and gives a
    row per sequence. Only the id and the text are read.
    """
    sources = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # Window numbers hold the task's number: written once, so that they cannot change.
    pieces = written(sources.mapInArrow(_packer(p), PIECES), "pieces")
    left = pieces.where("open").groupBy("window").agg(F.sum("length").alias("used"))
    left = written(left, "leftovers")
    groups = max(1, -(-left.count() // p.merged))
    merged = left.repartition(groups, "window").mapInArrow(_merger(p), "window bigint, sequence bigint, shift bigint")
    placed = pieces.join(merged, "window", "left")
    return placed.select(
        *NAMES[:5],
        F.coalesce("sequence", "window").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
