"""Benchmark decontamination by greedy string tiling.

Test items are the stated queries: they go to the tasks in blocks of bounded
size, and every document is looked at once per block. Runs of a few words that
a document shares with an item are seeds; where the seeds of an item cover too
little of it, no tiling can cover more, and the pair is left. The rest is tiled:
the longest common runs of words that do not overlap are marked, longest first,
each found by Karp-Rabin hashes of windows whose length falls from round to
round. The share of the item's words under tiles decides, wherever in the
document the tiles lie, so that a passage with its sentences in another order
is found like one in place.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.words import NOT_ALPHANUMERIC, portions, runs, text_buffer, word_hashes

TILED = (
    "doc_id bigint, item_id bigint, coverage double, covered_words bigint, item_words bigint, longest_tile bigint, "
    "tiles array<struct<doc_word:bigint,item_word:bigint,words:bigint>>"
)
FILTER_BITS = 22
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


@dataclass(frozen=True)
class Tiling:
    """least: words of the shortest tile. coverage: least share of an item's words
    under tiles. block_bytes: of test items sent to the tasks at once."""

    least: int = 5
    coverage: float = 0.5
    block_bytes: int = 8 << 20


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words in lower case, parted by whatever in ASCII is not a letter or digit."""
    return word_hashes(*text_buffer(pc.utf8_lower(pc.fill_null(column, ""))), blanks=NOT_ALPHANUMERIC)


class _Windows:
    """Karp-Rabin hashes of all windows of a sequence, for any window length."""

    def __init__(self, words: np.ndarray):
        up = np.full(len(words) + 1, _STEP, np.uint64)
        down = np.full(len(words) + 1, _BACK, np.uint64)
        up[0] = down[0] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.multiply.accumulate(up)[:-1])])

    def of(self, length: int | np.ndarray, starts: np.ndarray) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.down[starts]


def _next_marked(marked: np.ndarray) -> np.ndarray:
    """For each place the first marked one from there on; the last is marked."""
    places = np.flatnonzero(marked)
    return places[np.searchsorted(places, np.arange(len(marked)))]


def _before(words: np.ndarray, marked: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each place, and whether there is none that a match could take in."""
    return words[np.maximum(at - 1, 0)], (at == 0) | marked[np.maximum(at - 1, 0)]


def tile(doc: np.ndarray, item: np.ndarray, starts: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, words) of greedy string tiling, running Karp-Rabin.

    starts: ascending places in doc where a run of least words of the item begins.
    Of equally long matches the one first in the item, then in the doc, is marked first.

    For each search length, windows of equal hash that cannot be extended to the
    left begin a match; its length is found by bisection over the window hashes. The
    longest match is marked; one that lies partly under tiles is put back as what is
    left of it. So a repeated word costs a match per place, not per pair of places.
    """
    doc_windows, item_windows = _Windows(doc), _Windows(item)
    doc_marked, item_marked = np.zeros(len(doc) + 1, bool), np.zeros(len(item) + 1, bool)
    doc_marked[-1] = item_marked[-1] = True
    tiles, left = [], len(item)
    search = max(least, len(item) // 2)
    while True:
        matches = _matches(doc, item, doc_windows, item_windows, doc_marked, item_marked, starts, search)
        heapq.heapify(matches)
        while matches and left >= search:
            n, place, at = heapq.heappop(matches)
            n = -n
            free = ~(doc_marked[at : at + n] | item_marked[place : place + n]) & (doc[at : at + n] == item[place : place + n])
            if free.all():
                doc_marked[at : at + n] = item_marked[place : place + n] = True
                tiles.append((at, place, n))
                left -= n
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
            for i, j in zip(edges[0::2].tolist(), edges[1::2].tolist()):
                if j - i >= search:
                    heapq.heappush(matches, (i - j, place + i, at + i))
        if search == least or left < least:
            return tiles
        search = max(least, search // 2)


def _matches(doc, item, doc_windows, item_windows, doc_marked, item_marked, starts, search) -> list[tuple[int, int, int]]:
    """(-words, place in item, place in doc) of matches of at least search unmarked words that no word before them extends."""
    doc_end, item_end = _next_marked(doc_marked), _next_marked(item_marked)
    places = np.arange(max(0, len(item) - search + 1))
    places = places[item_end[places] >= places + search]
    fitting = starts[starts + search <= len(doc)]
    fitting = fitting[doc_end[fitting] >= fitting + search]
    if not len(places) or not len(fitting):
        return []
    item_hashes, doc_hashes = item_windows.of(search, places), doc_windows.of(search, fitting)
    order = np.argsort(doc_hashes, kind="stable")
    fitting, doc_hashes = fitting[order], doc_hashes[order]
    first, last = (np.searchsorted(doc_hashes, item_hashes, side).tolist() for side in ("left", "right"))
    doc_before, doc_begins = _before(doc, doc_marked, fitting)
    item_before, item_begins = _before(item, item_marked, places)
    at, of = [], []
    for i, (x, y) in enumerate(zip(first, last)):
        if x < y:
            found = np.arange(x, y) if item_begins[i] else x + np.flatnonzero(doc_begins[x:y] | (doc_before[x:y] != item_before[i]))
            at.append(fitting[found])
            of.append(np.full(len(found), places[i]))
    if not at:
        return []
    at, of = np.concatenate(at), np.concatenate(of)
    low, high = np.full(len(at), search), np.minimum(doc_end[at] - at, item_end[of] - of)
    while (low < high).any():  # the longest window of equal hash
        middle = (low + high + 1) // 2
        equal = doc_windows.of(middle, at) == item_windows.of(middle, of)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    return list(zip((-low).tolist(), of.tolist(), at.tolist()))


class Items:
    """A block of test items and the index of their seeds, in arrays: hash, and the items and places that have it."""

    def __init__(self, ids: list[int], texts: list[str], p: Tiling):
        words, bounds = _words(pa.array(texts, pa.string()))
        self.ids, self.p = ids, p
        self.words = [words[bounds[i] : bounds[i + 1]] for i in range(len(ids))]
        self.index: dict[int, tuple] = {}
        for length in sorted({min(p.least, len(w)) for w in self.words if len(w)}):
            own = [i for i, w in enumerate(self.words) if min(p.least, len(w)) == length]
            hashes = [runs(self.words[i], length) for i in own]
            item = np.repeat(np.array(own, np.int32), [len(h) for h in hashes])
            place = np.concatenate([np.arange(len(h), dtype=np.int32) for h in hashes])
            every = np.concatenate(hashes)
            order = np.argsort(every, kind="stable")
            seeds, begins = np.unique(every[order], return_index=True)
            present = np.zeros(1 << FILTER_BITS, bool)
            present[seeds >> np.uint64(64 - FILTER_BITS)] = True
            self.index[length] = seeds, present, np.append(begins, len(every)), item[order], place[order]

    def matches(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
        """(text, item, share, tiles) of every text and item with enough coverage."""
        for length, (seeds, present, *where) in self.index.items():
            if len(words) < length:
                continue
            hashes = runs(words, length)
            near = np.flatnonzero(present[hashes >> np.uint64(64 - FILTER_BITS)])
            spot = np.searchsorted(seeds, hashes[near])
            spot[spot == len(seeds)] = 0
            hit = seeds[spot] == hashes[near]
            hits, spot = near[hit], spot[hit]
            text_of = np.searchsorted(bounds, hits, "right") - 1
            inside = hits + length <= bounds[text_of + 1]
            hits, spot, text_of = hits[inside], spot[inside], text_of[inside]
            for first, last in zip(*_groups(text_of)):
                text = int(text_of[first])
                doc = words[bounds[text] : bounds[text + 1]]
                yield from self._of_text(text, doc, hits[first:last] - bounds[text], spot[first:last], length, *where)

    def _of_text(self, text, doc, starts, spots, length, begins, item_of, place_of):
        order = np.argsort(spots, kind="stable")
        starts, spots = starts[order], spots[order]
        begun, seen = defaultdict(list), defaultdict(list)
        for first, last in zip(*_groups(spots)):  # once per distinct seed
            at = slice(begins[spots[first]], begins[spots[first] + 1])
            items, places = item_of[at], place_of[at]
            for i, j in zip(*_groups(items)):
                begun[int(items[i])].append(starts[first:last])
                seen[int(items[i])].append(places[i:j])
        for item in sorted(seen):
            words = self.words[item]
            edge = np.zeros(len(words) + 1, np.int64)
            places = np.concatenate(seen[item])
            np.add.at(edge, places, 1)
            np.add.at(edge, places + length, -1)
            if (np.cumsum(edge[:-1]) > 0).mean() < self.p.coverage:
                continue
            tiles = tile(doc, words, np.unique(np.concatenate(begun[item])), length)
            share = sum(n for *_, n in tiles) / len(words)
            if share >= self.p.coverage:
                yield text, item, share, tiles


def _groups(keys: np.ndarray) -> tuple[list[int], list[int]]:
    """First and behind-last places of the runs of equal keys."""
    if not len(keys):
        return [], []
    edges = np.flatnonzero(np.diff(keys)) + 1
    return [0, *edges.tolist()], [*edges.tolist(), len(keys)]


def _tiler(items):
    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, j - i) for b in batches for i, j in portions(b.column(1))):
            words, bounds = _words(batch.column(1))
            rows = defaultdict(list)
            for text, item, share, tiles in items.value.matches(words, bounds):
                rows["doc_id"].append(batch.column(0)[text].as_py())
                rows["item_id"].append(items.value.ids[item])
                rows["coverage"].append(share)
                rows["covered_words"].append(sum(n for *_, n in tiles))
                rows["item_words"].append(len(items.value.words[item]))
                rows["longest_tile"].append(max(n for *_, n in tiles))
                rows["tiles"].append([{"doc_word": d, "item_word": i, "words": n} for d, i, n in tiles])
            if rows:
                yield pa.RecordBatch.from_pydict(rows, pa.schema(SCHEMA))

    return tiled


SCHEMA = [
    ("doc_id", pa.int64()),
    ("item_id", pa.int64()),
    ("coverage", pa.float64()),
    ("covered_words", pa.int64()),
    ("item_words", pa.int64()),
    ("longest_tile", pa.int64()),
    ("tiles", pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))),
]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, p: Tiling = Tiling(), id: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """Pairs of a document and a test item of which it holds enough, with the tiles.

    One row per row of docs and of benchmark whose tiles cover at least
    ``coverage`` of the item's words; documents that hold no item give no row.
    Texts without words (null, empty, punctuation only) match nothing. An item of
    fewer words than ``least`` must occur whole. Repeated rows of either table
    give repeated pairs; a null id stays null. An empty table of either kind gives
    no rows. A very long text is one portion of a task, held as 8 bytes a word in a few
    arrays. Only the id and the text are read.

    The benchmark is cut into blocks by a hash of its rows, as many as keep a
    block near ``block_bytes``; the documents are scanned once per block.
    """
    spark = docs.sparkSession
    sources = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    asked = benchmark.select(F.col(item).cast("bigint").alias("item_id"), F.col("text")).where("text is not null")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // p.block_bytes))
    result = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        items = spark.sparkContext.broadcast(Items([r["item_id"] for r in rows], [r["text"] for r in rows], p))
        found = sources.mapInArrow(_tiler(items), TILED)
        result = found if result is None else result.unionByName(found)
    return result
