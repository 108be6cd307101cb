"""Language-model scores from a weighted backoff automaton.

An n-gram model as an automaton: a state per history that the corpus holds, up to
``order`` - 1 words long, an arc per word seen after it, and a failure arc to the
state of the history without its first word for any other word, down to the empty
history of the root. Weights are log10 probabilities smoothed by Dirichlet priors:
after h, word w has (c(hw) + mass * p(w after h without its first word)) / (c(h) + mass),
so that the failure arc of h weighs mass / (c(h) + mass) and every state sums to one.

The corpus is counted in blocks of documents, dealt out by a hash and as many as
keep a block near a fixed size. A block sends each n-gram that it holds once,
with its count there, to the bucket of the n-gram's hash; the bucket returns the
totals. A block thus gets the part of the automaton that its documents can
reach, whatever the size of the whole, and walks every document through it once
from left to right: an arc of the state at hand, or failure arcs until one has it. N-grams travel as sorted arrays in binary rows, byte by
byte, which compresses well. Blocks and buckets grow in number with the corpus,
not in size; a word of any frequency is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.words import mix, text_buffer, word_hashes

START, END = (int(x) for x in mix(np.array([0x53, 0x45], np.uint64)))
WORD = 1
#: The bits of a hash by which n-grams of several words are told apart: 56.
SENT = np.uint64((1 << 64) - (1 << 8))
CHUNKS = "bucket int, block bigint, kind int, grams binary, counts binary"
TOTALS = "block bigint, bucket int, kind int, totals binary"
SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


@dataclass(frozen=True)
class Automaton:
    """order: words of the longest n-gram. mass: weight of the prior, in tokens, after one word;
    of every longer history the fall-th part of it, but not less than least. half: added to every
    word's count. block_bytes: of text in a block, about."""

    order: int = 3
    mass: float = 500.0
    fall: float = 100.0
    least: float = 1.0
    half: float = 0.5
    block_bytes: int = 8 << 20

    def prior(self, n: int) -> float:
        """Of the n-grams of n words, n > 1."""
        return max(self.least, self.mass / self.fall ** (n - 2)) if n > 2 else self.mass


def pack(x: np.ndarray) -> bytes:
    """64-bit numbers as planes of bytes, those that hardly change together, compressed."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(x) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


class Tokens:
    """The tokens of a block of texts, words and, after each text, one end, and their n-grams.

    grams[n] holds the distinct n-grams, of[n] the number of the one that ends at each
    token, or -1 where the text begins too late. The begin of a text is a history of its
    own, before the first token.
    """

    def __init__(self, texts: pa.Array, order: int):
        hashes, bounds = word_hashes(*text_buffer(texts))
        n = len(bounds) - 1
        self.order, self.bounds = order, bounds + np.arange(n + 1)
        tokens = np.insert(hashes, bounds[1:], np.uint64(END))
        self.place = np.arange(len(tokens)) - np.repeat(self.bounds[:-1], np.diff(self.bounds))  # in its text
        # The start of texts is counted as a history only.
        self.grams: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.of: list[np.ndarray] = [np.zeros(0, np.int32)]
        words, of = np.unique(np.append(tokens, np.uint64(START)), return_inverse=True)
        self.start = int(of[-1])
        self.grams.append(words)
        self.of.append(of[:-1].astype(np.int32))
        last = tokens
        for k in range(2, order + 1):
            before = np.empty_like(tokens)
            before[1:] = last[:-1]
            before[self.bounds[:-1]] = np.uint64(START)
            last = mix(mix(before) * np.uint64(3) + tokens)
            held = np.flatnonzero(self.place >= k - 2)
            grams, where = np.unique(last[held] & SENT, return_inverse=True)
            of = np.full(len(tokens), -1, np.int32)
            of[held] = where
            self.grams.append(grams)
            self.of.append(of)

    def counts(self, taught: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, n-grams, their counts in the texts that are learned from; of the start: texts)."""
        weight = np.repeat(taught.astype(float), np.diff(self.bounds))
        for n in range(1, self.order + 1):
            held = self.of[n] >= 0
            counts = np.bincount(self.of[n][held], weight[held], len(self.grams[n]))
            if n == WORD:
                counts[self.start] = taught.sum()
            yield n, self.grams[n], counts.astype(np.uint64)

    def history(self, n: int) -> np.ndarray:
        """The number of the history that an n-gram at each token continues, among grams[n - 1]; -1: none."""
        before = np.full(len(self.place), -1, np.int32)
        before[1:] = self.of[n - 1][:-1]
        before[self.place == 0] = self.start if n == 2 else -1
        return before


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose texts, the second column, are compressed."""
    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = pa.array([compress(x.as_buffer()) for x in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), texts, *batch.columns[2:]], batch.schema.names)


def _texts(column: pa.ChunkedArray) -> pa.Array:
    decompress = zstandard.ZstdDecompressor().decompress
    return pa.array([decompress(x.as_buffer()) for x in column], pa.large_binary()).cast(pa.large_string())


def _slices(grams: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes, by their highest bits."""
    if not len(grams):
        return []
    if not bits:
        return [(0, 0, len(grams))]
    bucket = (grams >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    first = np.concatenate([[0], edges])
    return list(zip(bucket[first].tolist(), first.tolist(), [*edges.tolist(), len(grams)]))


def _taught(column: pa.Array) -> np.ndarray:
    return np.array([x is True for x in column.to_pylist()], bool)


def _counter(bits: int, order: int):
    def count(key: tuple, block: pa.Table) -> pa.Table:
        tokens = Tokens(_texts(block.column("text")), order)
        rows = []
        for kind, grams, counts in tokens.counts(_taught(block.column("taught"))):
            rows += [(b, key[0].as_py(), kind, pack(grams[i:j]), pack(counts[i:j])) for b, i, j in _slices(grams, bits)]
        kinds = pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["bucket", "block", "kind", "grams", "counts"])

    return count


def _merge(bucket: pa.Table) -> pa.Table:
    """The totals of each chunk's n-grams, in the chunk's order."""
    out = []
    for kind in sorted(set(bucket.column("kind").to_pylist())):
        rows = [r for r in zip(*(bucket.column(c) for c in ("block", "bucket", "kind", "grams", "counts"))) if r[2].as_py() == kind]
        grams = [unpack(r[3].as_buffer()) for r in rows]
        _, place = np.unique(np.concatenate(grams), return_inverse=True)
        counts = np.concatenate([unpack(r[4].as_buffer()) for r in rows]).astype(np.int64)
        sums = np.zeros(place.max() + 1, np.int64)
        np.add.at(sums, place, counts)
        totals, at = sums[place], 0
        for r, g in zip(rows, grams):
            out.append((r[0].as_py(), r[1].as_py(), kind, pack(totals[at : at + len(g)])))
            at += len(g)
    kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary()
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["block", "bucket", "kind", "totals"])


def _vocabulary(bits: int):
    """Distinct tokens of each batch of texts, by bucket, and how many tokens it has."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            if len(texts):
                hashes, _ = word_hashes(*text_buffer(texts))
                distinct = np.append(np.unique(hashes), np.uint64(END))
                distinct.sort()
                slices = _slices(distinct, bits)
                n = [len(hashes) + len(texts), *[0] * (len(slices) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, *_ in slices], pa.int32()), pa.array(n, pa.int64()), pa.array([pack(distinct[i:j]) for _, i, j in slices], pa.binary())],
                    ["bucket", "n", "grams"],
                )

    return words


def _distinct(bucket: pa.Table) -> pa.Table:
    grams = np.unique(np.concatenate([unpack(g.as_buffer()) for g in bucket.column("grams")]))
    return pa.table({"n": pa.array([sum(bucket.column("n").to_pylist())], pa.int64()), "v": pa.array([len(grams)], pa.int64())})


class Part:
    """The part of the automaton that a block's texts can reach: arrays by n-gram of each length.

    A state is a history that the corpus continues. An arc is found by the number of
    the n-gram that it reads; an n-gram that was not seen has none, and the failure
    arc of its history is taken.
    """

    def __init__(self, totals: dict[int, np.ndarray], tokens: Tokens, n: int, v: int, p: Automaton):
        self.tokens, self.order = tokens, p.order
        mass = n + p.half * (v + 1)
        own = totals[WORD].astype(float)
        if v:
            own[tokens.start] = 0  # never read
            chance = (own + p.half) / mass
        else:
            chance = np.full(len(own), 1.0)
        self.known = own > 0
        self.starts = totals[WORD][tokens.start] > 0
        self.root = np.log10(chance)  # arcs of the root
        self.arc: dict[int, np.ndarray] = {}  # by n-gram
        self.fail: dict[int, np.ndarray] = {}  # by history of n - 1 words
        for k in range(2, p.order + 1):
            history, of = tokens.history(k), tokens.of[k]
            held = np.flatnonzero(of >= 0)
            first = np.zeros(len(totals[k]), np.int64)  # a place where each n-gram is read
            first[of[held]] = held
            seen, before = totals[k].astype(float), totals[k - 1].astype(float)
            chance = (seen + p.prior(k) * chance[tokens.of[k - 1][first]]) / (before[history[first]] + p.prior(k))
            self.arc[k] = np.where(seen > 0, np.log10(chance), np.nan)
            self.fail[k] = np.log10(p.prior(k) / (before + p.prior(k)))

    def weights(self, at: slice) -> tuple[list, list, list, list]:
        """Per token of a text: root arcs, whether the word is a state; per n: arcs, and failure arcs of the histories."""
        words = self.tokens.of[WORD][at]
        arcs, fails = [[], []], [[], []]
        for k in range(2, self.order + 1):
            of, history = self.tokens.of[k][at], self.histories[k][at]
            arcs.append(np.where(of >= 0, self.arc[k][of], np.nan).tolist() if len(self.arc[k]) else [np.nan] * len(of))
            fails.append(np.where(history >= 0, self.fail[k][history], 0.0).tolist())
        return self.root[words].tolist(), self.known[words].tolist(), arcs, fails

    @cached_property
    def histories(self) -> dict[int, np.ndarray]:
        return {k: self.tokens.history(k) for k in range(2, self.order + 1)}

    def walk(self, at: slice) -> float:
        """The weight of one text: from the start state, along arcs and failure arcs, once from left to right."""
        roots, known, arcs, fails = self.weights(at)
        longest = self.order - 1
        words = min(longest, 1) if self.starts else 0  # of the state's history
        total = 0.0
        for i, root in enumerate(roots):
            n = words + 1
            while n > 1:
                arc = arcs[n][i]
                if arc == arc:
                    total += arc
                    break
                total += fails[n][i]
                n -= 1
            else:
                total += root
            # The longest history that ends with this word: what was read, without its first word if it is too long.
            words = min(n, longest) if n > 1 or known[i] else 0
        return total


def _scorer(n: int, v: int, p: Automaton):
    def score(key: tuple, block: pa.Table, totals: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in _KINDS})
        tokens = Tokens(_texts(block.column("text")), p.order)
        of_kind = {}
        for kind in range(1, p.order + 1):
            rows = sorted((r[1].as_py(), r[2]) for r in zip(*(totals.column(c) for c in ("kind", "bucket", "totals"))) if r[0].as_py() == kind)
            of_kind[kind] = np.concatenate([np.zeros(0, np.uint64), *(unpack(x.as_buffer()) for _, x in rows)])
            if len(of_kind[kind]) != len(tokens.grams[kind]):
                raise RuntimeError("a block's documents have changed between counting and scoring")
        part = Part(of_kind, tokens, n, v, p)
        words = tokens.of[WORD]
        known = np.concatenate([[0], np.cumsum(part.known[words])])
        base = part.root[words]
        scores, bases = [], []
        for i, j in zip(tokens.bounds[:-1].tolist(), tokens.bounds[1:].tolist()):
            scores.append(part.walk(slice(i, j)))
            bases.append(float(base[i:j].sum()))
        ends = tokens.bounds
        columns = [
            block.column("doc_id"),
            [not t for t in _taught(block.column("taught"))],
            np.diff(ends),
            known[ends[1:]] - known[ends[:-1]],
            [n] * block.num_rows,
            bases,
            scores,
        ]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, k) for c, (_, k) in zip(columns, _KINDS)], [m for m, _ in _KINDS])

    return score


_KINDS = [
    ("doc_id", pa.int64()),
    ("held_out", pa.bool_()),
    ("n_tokens", pa.int64()),
    ("n_known", pa.int64()),
    ("train_tokens", pa.int64()),
    ("base_score", pa.float64()),
    ("score", pa.float64()),
]


def scored(docs: DataFrame, taught: Column, p: Automaton = Automaton(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    taught: which rows the model learns from; null counts as false. score is the
    automaton's log10 probability of the row's tokens, base_score that of its
    root alone, n_known the tokens that occur in what was learned. A null or
    blank text is one end token. Repeated rows are counted and scored each, and
    those of equal id and text lie in one block; a null id stays null. A very long text
    is in one block, which then is longer. Other columns are not read, so that clashing
    names do no harm. If nothing is learned, all scores are 0: the prior has
    one word. An empty table gives no rows.
    """
    if p.order < 1:
        raise ValueError("order is at least 1")
    rows = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(taught, F.lit(False)).alias("taught")
    )
    total = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-total // p.block_bytes))
    bits = max(0, int(blocks - 1).bit_length())
    counted = rows.where("taught").select("text").mapInArrow(_vocabulary(bits), "bucket int, n bigint, grams binary")
    n, v = counted.groupBy("bucket").applyInArrow(_distinct, "n bigint, v bigint").agg(F.sum("n"), F.sum("v")).first()
    # Both uses of the blocks are one exchange of the texts.
    placed = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    dealt = placed.mapInArrow(_pressed, "doc_id bigint, text binary, taught boolean, block bigint").groupBy("block")
    totals = dealt.applyInArrow(_counter(bits, p.order), CHUNKS).groupBy("bucket").applyInArrow(_merge, TOTALS)
    return dealt.cogroup(totals.groupBy("block")).applyInArrow(_scorer(n or 0, v or 0, p), SCORES)
