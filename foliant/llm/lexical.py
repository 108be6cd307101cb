"""Ranked lexical search of many items at once, by branch and bound over tries of documents.

The items are the stated queries. A document is restricted to their terms: a vector
of terms in order of falling document frequency, with its term frequencies. In a
task, the vectors of a few thousand documents form a trie, in which documents share
the path of the frequent terms that they have in common; a path without a branch is
one node. A node knows the largest tf of each term on its path and of any term below
it, which terms lie below it, and the smallest length factor m of its documents.
tf and m bound what a term can add, so that an item walks the trie depth first, best
bound first, and leaves every subtree that cannot reach its tenth best score so far.
Documents that remain are scored exactly, in 64-bit integers.

A task keeps its best documents per item over all its tries and sends only these;
they meet in two steps, so that no task gets more than a share of the tasks' lists.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.llm.words import NOT_ALPHANUMERIC, portions, text_buffer, word_hashes
from foliant.session import written

VECTORS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
BEST = "item_row bigint, item_id bigint, doc_id bigint, score bigint, part bigint"
GROUPS = 1000


@dataclass(frozen=True)
class Ranking:
    """top: documents per item. block_bytes: of items searched at once. documents, terms:
    of a trie, at most (a longer document is one alone). presence: terms below a node are
    kept modulo this number. scored: documents that are scored together."""

    top: int = 10
    block_bytes: int = 8 << 20
    documents: int = 8192
    terms: int = 1 << 22
    presence: int = 4096
    scored: int = 512


class Items:
    """A block of items: their distinct terms as sorted hashes, and each item's terms by number."""

    def __init__(self, ids: Sequence[int | None], texts: Sequence[str]):
        hashes, bounds = word_hashes(*text_buffer(pa.array(texts, pa.string())), blanks=NOT_ALPHANUMERIC)
        self.ids = list(ids)
        self.terms, number = np.unique(hashes, return_inverse=True)
        self.of = [Counter(number[bounds[i] : bounds[i + 1]].tolist()) for i in range(len(self.ids))]


def _restricted(terms):
    """Vectors over the terms, for documents that have any word."""

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        for batch in batches:
            for i, j in portions(batch.column(1)):
                part = batch.slice(i, j - i)
                hashes, bounds = word_hashes(*text_buffer(part.column(1)), blanks=NOT_ALPHANUMERIC)
                n = np.diff(bounds)
                spot = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
                hit = np.flatnonzero(known[spot] == hashes) if len(known) else np.zeros(0, np.int64)
                text = np.searchsorted(bounds, hit, "right") - 1
                pairs, tfs = np.unique(text * max(1, len(known)) + spot[hit], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(part.num_rows + 1) * max(1, len(known))).astype(np.int32)
                held = pa.array(n > 0)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (pairs % max(1, len(known)), tfs)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"]).filter(held)

    return restrict


@dataclass
class Plan:
    """What the tasks need to search: items, and per term in trie order its number's place and weight."""

    ids: list
    items: list  # (places, weights) of each item
    place: np.ndarray
    all_docs: int
    all_terms: int


def planned(items: Items, df: np.ndarray, all_docs: int, all_terms: int) -> Plan:
    """Weights, and the order of the trie: frequent terms first."""
    weight = np.array([math.floor(1000 * math.log((2 * all_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    order = np.argsort(-df, kind="stable")
    place = np.empty(len(df), np.int64)
    place[order] = np.arange(len(df))
    rows = []
    for of in items.of:
        numbers = np.array(list(of), np.int64)
        rows.append((place[numbers], weight[numbers] * np.array(list(of.values()), np.int64)))
    return Plan(items.ids, rows, place, all_docs, all_terms)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all ranges from starts, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the consecutive parts of these sizes."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


class Trie:
    """Documents in the order of their vectors; nodes as arrays, children as lists.

    A child that is not negative is a node, else ~child is a document.
    """

    def __init__(self, ids: list, m: np.ndarray, starts: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, width: int, all_terms: int):
        coded = terms.astype(">u4").tobytes()
        keys = [coded[4 * a : 4 * (a + n)] for a, n in zip(starts.tolist(), sizes.tolist())]
        order = np.array(sorted((i for i, k in enumerate(keys) if k), key=keys.__getitem__), np.int64)
        at = _spans(starts[order], sizes[order])
        self.ids, self.m, self.sizes = [ids[i] for i in order.tolist()], m[order], sizes[order]
        self.terms, self.tfs = terms[at], tfs[at]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.impacts = impact(self.tfs, np.repeat(self.m, self.sizes))
        self.width = max(1, min(width, all_terms))
        self.children: list[list[int]] = [[]]
        self.depth, self.parent = [0], [0]
        self._branch()
        self._bound()

    def _shared(self) -> list[int]:
        """How many first terms each document shares with the next."""
        n = np.minimum(self.sizes[:-1], self.sizes[1:])
        if not len(n):
            return []
        differ = self.terms[_spans(self.starts[:-1], n)] != self.terms[_spans(self.starts[1:], n)]
        places = np.append(np.flatnonzero(differ), len(differ))
        begins = np.cumsum(n) - n
        return np.minimum(places[np.searchsorted(places, begins)] - begins, n).tolist()

    def _branch(self) -> None:
        """Nodes from the lengths of shared paths, in one pass with a stack; every node is closed before its parent."""
        if not self.ids:
            return
        stack, self.closed = [0], []
        for doc, shared in enumerate([*self._shared(), 0]):
            pending = ~doc
            while self.depth[stack[-1]] > shared:
                node = stack.pop()
                self.children[node].append(pending)
                self.closed.append(node)
                pending = node
            if self.depth[stack[-1]] < shared:
                self.children.append([])
                self.depth.append(shared)
                self.parent.append(0)
                stack.append(len(self.depth) - 1)
            self.children[stack[-1]].append(pending)
        self.closed.append(0)
        for node, children in enumerate(self.children):
            for child in children:
                if child >= 0:
                    self.parent[child] = node

    def _bound(self) -> None:
        """tf maxima, m minima and terms of all subtrees, children first."""
        nodes = len(self.depth)
        self.min_m = np.full(nodes, 1, np.int64)
        self.below_tf = np.zeros(nodes, np.int64)
        self.below = np.zeros((nodes, self.width), bool)
        path: dict[int, np.ndarray] = {}
        doc_of = [0] * nodes
        segments: list = [np.zeros(0, np.int64)] * nodes
        segment_terms: list = [np.zeros(0, np.int64)] * nodes
        starts, ends, m = self.starts.tolist(), (self.starts + self.sizes).tolist(), self.m.tolist()
        for node in self.closed if self.ids else []:
            depth, below = self.depth[node], self.below[node]
            least, most, top = None, 0, None
            for child in self.children[node]:
                if child < 0:
                    doc = ~child
                    row, value = self.tfs[starts[doc] : ends[doc]], m[doc]
                    tail = self.terms[starts[doc] + depth : ends[doc]]
                    rest = 0
                else:
                    doc = doc_of[child]
                    row, value, rest = path.pop(child), int(self.min_m[child]), int(self.below_tf[child])
                    tail = self.terms[starts[doc] + depth : starts[doc] + self.depth[child]]
                    segments[child], segment_terms[child] = row[depth:], tail
                    below |= self.below[child]
                if len(tail):
                    below[tail % self.width] = True
                    rest = max(rest, int(row[depth:].max()))
                least = value if least is None else min(least, value)
                most = max(most, rest)
                top = row[:depth] if top is None else np.maximum(top, row[:depth])
            path[node], doc_of[node] = top, doc
            self.min_m[node], self.below_tf[node] = least, most
        self.segment_sizes = np.array([len(s) for s in segments])
        self.segment_terms = np.concatenate(segment_terms)
        self.segment_impacts = impact(np.concatenate(segments), np.repeat(self.min_m, self.segment_sizes))
        self.below_impact = impact(self.below_tf, self.min_m)

    def best(self, places: np.ndarray, weights: np.ndarray, dense: np.ndarray, found: list, p: Ranking) -> list:
        """The best (-score, id is null, id) of found and of this trie, for the item of these terms.

        dense: a zero for every term; it is given back as it was.
        """
        dense[places] = weights
        on_node = _sums(dense[self.segment_terms] * self.segment_impacts, self.segment_sizes).tolist()
        under = (self.below[:, places % self.width] @ weights * self.below_impact).tolist()
        least = -found[-1][0] if len(found) == p.top else 1
        stack, waiting = [(under[0], 0, 0)], []

        def score() -> int:
            docs = np.array(waiting, np.int64)
            waiting.clear()
            at = _spans(self.starts[docs], self.sizes[docs])
            scores = _sums(dense[self.terms[at]] * self.impacts[at], self.sizes[docs])
            near = np.flatnonzero(scores >= least)
            rows = [(-int(scores[i]), self.ids[d] is None, self.ids[d] or 0) for i, d in zip(near.tolist(), docs[near].tolist())]
            found[:] = sorted(found + rows)[: p.top]
            return max(least, -found[-1][0]) if len(found) == p.top else least

        while stack:
            bound, node, so_far = stack.pop()
            if bound < least:
                continue
            inner = []
            for child in self.children[node]:
                if child < 0:
                    waiting.append(~child)
                else:
                    path = so_far + on_node[child]
                    if path + under[child] >= least:
                        inner.append((path + under[child], child, path))
            stack.extend(sorted(inner))
            if len(waiting) >= p.scored:
                least = score()
        if waiting:
            score()
        dense[places] = 0
        return found


def _tries(batches: Iterator[pa.RecordBatch], plan: Plan, p: Ranking) -> Iterator[Trie]:
    for batch in batches:
        ids, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        m = np.array([25 + 75 * x * plan.all_docs // plan.all_terms for x in n], np.int64)
        offsets = batch.column(2).offsets.to_numpy().astype(np.int64)
        terms = plan.place[batch.column(2).values.to_numpy()]
        tfs = batch.column(3).values.to_numpy().astype(np.int64)
        sizes = np.diff(offsets)
        # Each vector in the order of the trie.
        at = np.lexsort((terms, np.repeat(np.arange(len(ids)), sizes)))
        first = int(offsets[0])
        used = slice(first, int(offsets[-1]))
        terms, tfs, offsets = terms[used][at], tfs[used][at], offsets - first
        i = 0
        while i < len(ids):
            j = min(i + p.documents, max(i + 1, int(np.searchsorted(offsets, offsets[i] + p.terms, "right")) - 1), len(ids))
            yield Trie(ids[i:j], m[i:j], offsets[i:j], sizes[i:j], terms, tfs, p.presence, len(plan.place))
            i = j


def _searcher(plan, p: Ranking):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = plan.value
        found: list[list] = [[] for _ in asked.ids]
        dense = np.zeros(len(asked.place), np.int64)
        for trie in _tries(batches, asked, p):
            for (places, weights), best in zip(asked.items, found):
                if len(places) and trie.ids:
                    trie.best(places, weights, dense, best, p)
        part = TaskContext.get().partitionId()
        rows = [(i, asked.ids[i], None if null else id, -score, part) for i, best in enumerate(found) for score, null, id in best]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["item_row", "item_id", "doc_id", "score", "part"])

    return search


def _firsts(best: DataFrame, keys: list, top: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return best.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)


def ranked(
    docs: DataFrame, items: DataFrame, p: Ranking = Ranking(), id: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the documents of highest score above 0 for every row of items.

    rank counts from 1; of equal scores the smallest doc_id goes first, a null id last.
    An item without terms (null, empty, signs only), or whose terms no document holds,
    gives no row, and so does an empty table of either kind. Texts without terms count
    neither for the number of documents nor for the mean length. Repeated rows of either table are
    ranked and searched each. A very long text is one portion of a task, held with 8
    bytes a word for each of a few arrays; its vector is no longer than the terms of a
    block of items. Only the ids and the texts are read.

    The items are cut into blocks by a hash of their rows, as many as keep a block near
    ``block_bytes``; the documents are read once per block.
    """
    spark = docs.sparkSession
    sources = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item).cast("bigint").alias("item_id"), F.col("text")).where("text is not null")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // p.block_bytes))
    result = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        held = Items([r["item_id"] for r in rows], [r["text"] for r in rows])
        vectors = written(sources.mapInArrow(_restricted(spark.sparkContext.broadcast(held.terms)), VECTORS), "vectors")
        n, words = vectors.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(held.terms), np.int64)
        for term, count in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect():
            df[term] = count
        plan = spark.sparkContext.broadcast(planned(held, df, n, words or 1))
        best = vectors.where(F.size("terms") > 0).mapInArrow(_searcher(plan, p), BEST)
        best = _firsts(best.withColumn("part", F.pmod("part", F.lit(GROUPS))), ["item_row", "part"], p.top)
        best = _firsts(best, ["item_row"], p.top).select("item_id", "rank", "doc_id", "score")
        result = best if result is None else result.unionByName(best)
    return result
