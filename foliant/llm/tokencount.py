"""Token counts of whole texts by a two-tier lookup, without a shuffle of pre-tokens.

A tokenizer that drops white space and splits before merging gives a text as many
tokens as its pre-tokens have together, and most pre-tokens of a corpus are
frequent ones. Their lengths go to every task as a compact hash table of fixed
size (first tier). What it lacks is looked up in a cache of the Python worker, and
encoded by the library where the cache lacks it too (second tier). A text is cut
into pieces that the library would never join:

* a run of bytes between ASCII blanks, whole, if it holds a byte outside ASCII, an
  apostrophe (contractions) or ``<|`` (special strings);
* else its runs of letters, its digits one by one, and its runs of other signs.

Which pieces are frequent is found over all documents: each task keeps a bounded
list of its heaviest pieces, and only these lists are added up. The choice has an
effect on speed alone, not on any count.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliant.llm.pieces import pieces
from foliant.llm.words import BLANKS, portions, text_buffer

COUNTED = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
_BYTE = np.arange(256)
_LETTER, _DIGIT, _SIGN, _WHOLE = 1, 2, 3, 4
_CLASS = np.full(256, _SIGN, np.int8)
_CLASS[BLANKS] = 0
_CLASS[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
_CLASS[[c for c in range(128) if chr(c).isdigit()]] = _DIGIT
_CLASS[_BYTE >= 128] = _WHOLE
_CLASS[ord("'")] = _WHOLE


@dataclass(frozen=True)
class TokenCounts:
    """limit: a text of more tokens is over it. frequent: pieces in the broadcast
    table. heaviest: pieces that a task lists. longest: bytes of a piece in the table.
    cached: pieces that a worker remembers, twice as many for a short time."""

    vocabulary: str
    limit: int = 2048
    frequent: int = 1 << 15
    heaviest: int = 1 << 12
    longest: int = 64
    cached: int = 1 << 19


def cut(part: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last places of the pieces of a part of the bytes of texts that begin at ``inside``."""
    kind = _CLASS[part]
    solid = kind > 0
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[inside] |= solid[inside]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    ends[inside - 1] |= solid[inside - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    special = kind == _WHOLE
    special[:-1] |= (part[:-1] == ord("<")) & (part[1:] == ord("|"))
    specials = np.concatenate([[0], np.cumsum(special)])
    whole = specials[last] > specials[first]
    edge = np.zeros(len(part) + 1, np.int8)
    edge[first[whole]] += 1
    edge[last[whole]] -= 1
    split = solid & (np.cumsum(edge[:-1], dtype=np.int8) == 0)
    split[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    starts = np.flatnonzero(begins | split)
    if not len(starts):
        return starts, starts
    end_of_run = last[np.searchsorted(first, starts, "right") - 1]
    return starts, np.minimum(np.append(starts[1:], len(part)), end_of_run)


class Table:
    """Lengths by hash, open addressing: 12 bytes a slot, at most half of them in use."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        bits = max(4, int(2 * len(hashes)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.lengths = np.zeros(1 << bits, np.uint32)
        self.probes = 1
        used = np.zeros(1 << bits, bool)
        for h, n in zip(hashes.tolist(), lengths.tolist()):
            slot, probes = h & int(self.mask), 1
            while used[slot]:
                slot, probes = (slot + 1) & int(self.mask), probes + 1
            used[slot], self.keys[slot], self.lengths[slot] = True, h, n
            self.probes = max(self.probes, probes)
        # An empty slot must match no hash that is looked for there: it holds one of the next slot.
        empty = np.flatnonzero(~used).astype(np.uint64)
        self.keys[empty.astype(np.int64)] = (empty + np.uint64(1)) & self.mask

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The length of each hash, and where it is not known."""
        found = np.zeros(len(hashes), np.int64)
        open_ = np.arange(len(hashes))
        for step in range(self.probes):
            slots = ((hashes[open_] + np.uint64(step)) & self.mask).astype(np.int64)
            hit = self.keys[slots] == hashes[open_]
            found[open_[hit]] = self.lengths[slots[hit]]
            open_ = open_[~hit]
        return found, open_


class Encoder:
    """Lengths by the library, remembered in the worker."""

    _OF: dict[str, Encoder] = {}

    def __init__(self, path: str, cached: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core
        self.library, self.cached = Tokenizer.from_file(path), cached
        self.library.no_truncation()
        self.library.no_padding()
        self.young: dict[int, int] = {}
        self.old: dict[int, int] = {}

    @classmethod
    def of(cls, p: TokenCounts) -> Encoder:
        if p.vocabulary not in cls._OF:
            cls._OF[p.vocabulary] = cls(p.vocabulary, p.cached)
        return cls._OF[p.vocabulary]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def remembered(self, hashes: list[int], text_of) -> list[int]:
        """Lengths of the pieces of these distinct hashes; text_of(i) reads the i-th piece."""
        young, old = self.young, self.old
        found = [young.get(h) for h in hashes]
        missing = [i for i, n in enumerate(found) if n is None]
        for i in missing:
            found[i] = old.get(hashes[i])
        new = [i for i in missing if found[i] is None]
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            for i, n in zip(some, self.lengths([text_of(i) for i in some])):
                found[i] = n
        young.update((hashes[i], found[i]) for i in missing)
        if len(young) > self.cached:
            self.young, self.old = {}, young
        return found


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in portions(batch.column(column)):
            yield batch.slice(i, j - i)


def _heaviest(p: TokenCounts):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: Counter = Counter()
        for part in _parts(batches, 0):
            data, offsets = text_buffer(part.column(0))
            found = pieces(data, offsets, BLANKS, cut, fold=False)
            short = np.flatnonzero(found.ends - found.starts <= p.longest)
            _, first, n = np.unique(found.hashes[short], return_index=True, return_counts=True)
            top = np.argsort(-n, kind="stable")[: p.heaviest]
            for i, count in zip(short[first[top]].tolist(), n[top].tolist()):
                most[data[found.starts[i] : found.ends[i]].tobytes()] += count
            if len(most) > 4 * p.heaviest:
                most = Counter(dict(most.most_common(2 * p.heaviest)))
        rows = most.most_common(p.heaviest)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], ["piece", "n"])

    return listed


def frequent_pieces(docs: DataFrame, p: TokenCounts, text: str = "text") -> Table:
    """The lengths of at most ``frequent`` pieces, of those that the tasks list as their heaviest.

    A task sends at most ``heaviest`` pieces of at most ``longest`` bytes, whatever it reads.
    """
    listed = docs.select(F.col(text).alias("text")).where("text <> ''").mapInArrow(_heaviest(p), "piece binary, n bigint")
    totals = listed.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(p.frequent)
    found = [bytes(r["piece"]) for r in totals.collect()]
    buffer = np.frombuffer(b"".join(found), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in found], dtype=np.int64)]).astype(np.int64)
    lengths = Encoder(p.vocabulary, 0).lengths([w.decode("utf-8", "replace") for w in found]) if found else []
    # Each of these texts is one piece.
    hashes = pieces(buffer, offsets, BLANKS, cut, fold=False).hashes
    return Table(hashes, np.array(lengths, np.int64))


def _counter(table, p: TokenCounts):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(p)
        for part in _parts(batches, 1):
            data, offsets = text_buffer(part.column(1))
            found = pieces(data, offsets, BLANKS, cut, fold=False)
            lengths, misses = table.value.find(found.hashes)
            distinct, first, where = np.unique(found.hashes[misses], return_index=True, return_inverse=True)
            at = misses[first]
            starts, ends = found.starts[at].tolist(), found.ends[at].tolist()
            text_of = lambda i: data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace")
            lengths[misses] = np.array(encoder.remembered(distinct.tolist(), text_of), np.int64)[where]
            sums = np.concatenate([[0], np.cumsum(lengths)])
            n = sums[found.bounds[1:]] - sums[found.bounds[:-1]]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > p.limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    return count


def token_counts(docs: DataFrame, p: TokenCounts, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens of the whole text, over_limit.

    n_tokens is what the tokenizers library gives for the vocabulary file, without
    added special tokens, truncation or padding; special strings inside a text are
    handled as its default. The vocabulary must drop white space and split letters,
    digits and other signs before merging. A null or empty text has 0 bytes and 0
    tokens. Repeated rows are counted each; a null id stays null; an empty table
    gives no rows. A very long text is a portion alone, held with 8 bytes a piece
    for each of a few arrays. Only the id and the text are read, so extra columns of
    any name do no harm.
    """
    sources = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, p, text))
    return sources.mapInArrow(_counter(table, p), COUNTED)
