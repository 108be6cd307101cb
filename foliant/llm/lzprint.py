"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into LZ78 phrases: each is the longest phrase of the dictionary
that the rest begins with, and one character more, and joins the dictionary. The
set of phrases is what a compressor learns of the text; the minima of hashes of
its phrases are the fingerprint, and the share of equal minima estimates how much
of one text's dictionary the other has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliant.llm.words import mix
from foliant.session import written

WIDTH = 4096
_BASE = 0x9E3779B97F4A7C55
_UP = np.ones(1, np.uint64)
_DOWN = np.ones(1, np.uint64)


@dataclass(frozen=True)
class Phrases:
    """minima: of a fingerprint, 16 bits each. dictionary: phrases after which a new
    dictionary is begun, so that memory has a bound; the set keeps them all."""

    minima: int = 64
    dictionary: int = 1 << 19
    seed: int = 5


class Parser:
    """An LZ78 parse that can be taken up at a place and taken back to it."""

    def __init__(self, limit: int):
        self.root: dict = {}
        self.node, self.count, self.limit = self.root, 0, limit

    def feed(self, text: str, at: int, added: list | None = None) -> list[int]:
        """Where phrases end, for a text that continues the parse at a place; added notes what joins the dictionary."""
        root, node, ends = self.root, self.node, []
        end, room = ends.append, self.limit - self.count
        for ch in text:
            at += 1
            child = node.get(ch)
            if child is not None:
                node = child
                continue
            node[ch] = {}
            if added is not None:
                added.append((node, ch))
            end(at)
            room -= 1
            if not room:
                root, room = {}, self.limit
            node = root
        self.root, self.node, self.count = root, node, self.limit - room
        return ends


def phrase_ends(text: str, limit: int = Phrases.dictionary) -> list[int]:
    return Parser(limit).feed(text, 0)


def _span_hashes(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points, the same wherever the span lies."""
    global _UP, _DOWN
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if len(_UP) <= len(codes):
        size = max(1 << 16, 2 * len(codes))
        powers = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            powers.append(np.multiply.accumulate(steps))
        _UP, _DOWN = powers
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _UP[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _DOWN[starts] + (ends - starts).astype(np.uint64))


class Fingerprinter:
    def __init__(self, p: Phrases = Phrases()):
        self.p = p
        random = np.random.default_rng(p.seed)
        self.factors = random.integers(0, 1 << 32, (p.minima, 1), np.uint32) | np.uint32(1)
        self.shifts = random.integers(0, 1 << 32, (p.minima, 1), np.uint32)

    def _minima(self, text: str, start: int, ends: list[int]) -> np.ndarray:
        """Minima over the phrases that end at the given places, the first of them from start."""
        low = np.full(self.p.minima, np.iinfo(np.uint32).max, np.uint32)
        if ends:
            stops = np.array(ends)
            hashes = (_span_hashes(text, np.concatenate([[start], stops[:-1]]), stops) >> np.uint64(32)).astype(np.uint32)
            for i in range(0, len(hashes), WIDTH):
                np.minimum(low, (hashes[None, i : i + WIDTH] * self.factors + self.shifts).min(axis=1), out=low)
        return low

    def signature(self, text: str) -> np.ndarray:
        return (self._minima(text, 0, phrase_ends(text, self.p.dictionary)) >> np.uint32(16)).astype(np.uint16)

    def of_both(self, text: str, keep: int, edited: str) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of two texts that share their first keep characters, which are parsed once."""
        parser = Parser(self.p.dictionary)
        shared = parser.feed(text[:keep], 0)
        begin = shared[-1] if shared else 0
        state = parser.root, parser.node, parser.count
        added: list = []
        rest = parser.feed(text[keep:], keep, added)
        low = self._minima(text[:keep], 0, shared)
        first = np.minimum(low, self._minima(text, begin, rest))
        for node, ch in reversed(added):
            del node[ch]
        parser.root, parser.node, parser.count = state
        second = np.minimum(low, self._minima(edited, begin, parser.feed(edited[keep:], keep)))
        return (first >> np.uint32(16)).astype(np.uint16), (second >> np.uint32(16)).astype(np.uint16)


def text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases: equal minima, less what chance makes equal."""
    chance = 2.0**-16
    return max(0.0, float(((a == b).mean() - chance) / (1 - chance)))


ROWS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
    "part int, head string, tail string"
)
_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string())]
    + [("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("head", pa.string()), ("tail", pa.string())]
)
RESULT = _ROWS.names[:7]


def _compared(printer: Fingerprinter, text: str, following: str) -> tuple[str, np.ndarray, np.ndarray]:
    half = len(text) // 2
    keep = len(text) - half
    edited = text[:keep] + following[:half]
    return hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), *printer.of_both(text, keep, edited)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROWS)], schema=_ROWS)
    rows.clear()
    return batch


def _walker(p: Phrases):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer, part = Fingerprinter(p), TaskContext.get().partitionId()
        rows: list[tuple] = []
        last, pending = None, None  # the document before, and its row that still lacks near_next
        for batch in batches:
            for id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if last is not None:
                    digest, own, edited = _compared(printer, last[1], text)
                    if pending is not None:
                        rows.append((*pending[0], likeness(pending[1], own), part, pending[2], None))
                    row = last[0], len(last[1]), digest, text_of(own), text_of(edited), likeness(own, edited)
                    pending = row, own, last[2]
                    if len(rows) >= 2000:
                        yield _batch(rows)
                last = id, text, text if last is None else None
        if last is not None:
            own = printer.signature(last[1])
            if pending is not None:
                rows.append((*pending[0], likeness(pending[1], own), part, pending[2], None))
            rows.append((last[0], len(last[1]), None, text_of(own), None, None, None, part, last[2], last[1]))
            yield _batch(rows)

    return walk


def _closer(p: Phrases):
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Fingerprinter(p)
        for batch in batches:
            rows = []
            for id, print_, text, following, next_print in zip(*(batch.column(i).to_pylist() for i in range(5))):
                digest, own, edited = _compared(printer, text, following)
                assert text_of(own) == print_
                after = np.frombuffer(bytes.fromhex(next_print), ">u2")
                rows.append((id, len(text), digest, print_, text_of(edited), likeness(own, edited), likeness(own, after), 0, None, None))
            if rows:
                yield _batch(rows)

    return close


def fingerprinted(docs: DataFrame, p: Phrases = Phrases(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half (rounded down) replaced by as much of the
    next row's beginning; the next row of the last is the first. near_edited and
    near_next are the likeness of the row's fingerprint to the edited text's and
    to the next row's. Rows go by id, then by a hash of the text and the text;
    null ids first. A null text is empty: its fingerprint is that of no phrase,
    like only to itself. One row is its own next; an empty table gives no rows.

    The rows are dealt out by ranges of ids and walked in order, a task keeping
    two texts at a time. Only the last text of each range waits for the first of
    the next one; those, two per partition, are paired afterwards.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = "doc_id", F.xxhash64("text"), "text"
    walked = written(rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(_walker(p), ROWS), "walked")
    inner = walked.where("tail is null").select(*RESULT)
    # One number per partition.
    parts = walked.where("head is not null").select("part")
    first = F.min("part").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    following = parts.select("part", F.coalesce(F.lead("part").over(W.orderBy("part")), first).alias("next"))
    heads = walked.where("head is not null").select(F.col("part").alias("next"), F.col("head").alias("following"), F.col("fingerprint").alias("next_print"))
    tails = walked.where("tail is not null").select("part", "doc_id", "fingerprint", "tail").join(following, "part").join(heads, "next")
    outer = tails.select("doc_id", "fingerprint", "tail", "following", "next_print").mapInArrow(_closer(p), ROWS)
    return inner.unionByName(outer.select(*RESULT))
