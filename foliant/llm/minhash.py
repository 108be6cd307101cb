"""MinHash near-duplicates with b-bit signatures.

The minima of each document's shingles give band keys, and their low bits a
packed signature. Equal sets are one node from the start. Within a bucket of a
band every node is tied to the bucket's smallest node (a star, not all pairs).
Candidates whose signatures cannot reach the threshold are left out: the number
of equal low-bit groups, corrected for chance, estimates the similarity. What is
left is confirmed on the full sets. Only where a bucket still holds several
components are the pairs across them looked at, so that a link between two
members that are both far from the star's centre is found as well: by longer
signatures inside the join, which lets through only pairs close to the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.graph import components
from foliant.llm.words import mix, portions, runs, signed, text_buffer, word_hashes
from foliant.session import written

WIDTH = 4096


@dataclass(frozen=True)
class NearDuplicates:
    """words: of a shingle. percent: least 100 * intersection / union of a link.
    bands * rows: minima. bits: kept of each. wide, wide_bits:
    the same for nodes whose bucket holds several components. slack: standard deviations that an
    estimate may lie below the threshold before the pair is left out unconfirmed.

    With the defaults a pair at the threshold shares no band with probability
    6e-11, and is left out by its estimate with probability 3e-7; both fall fast above it.
    """

    words: int = 5
    percent: int = 85
    bands: int = 32
    rows: int = 4
    bits: int = 4
    wide: int = 1024
    wide_bits: int = 2
    slack: float = 5.0
    seed: int = 7

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    def least_estimate(self, minima: int, bits: int) -> float:
        p = self.percent / 100
        chance = 2.0**-bits
        equal = p + (1 - p) * chance
        return p - self.slack * math.sqrt(equal * (1 - equal) / minima) / (1 - chance)

    def functions(self, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Factors and shifts of n hash functions."""
        random = np.random.default_rng(seed)
        factors = random.integers(0, 1 << 32, (n, 1), np.uint32) | np.uint32(1)
        return factors, random.integers(0, 1 << 32, (n, 1), np.uint32)


SIGNED = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, planes array<bigint>, bands array<bigint>"


def _minima(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), WIDTH):
        np.minimum(low, (short[None, i : i + WIDTH] * factors + shifts).min(axis=1), out=low)
    return low


def _planes(low: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of each row's minima, mixed, a plane of bits after the other, as 64-bit numbers.

    A minimum's own low bits depend on the element's low bits alone, whatever the odd factor.
    """
    low = mix(low.astype(np.uint64))
    planes = [np.packbits(((low >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1) for b in range(bits)]
    return np.concatenate(planes, axis=1).view(np.int64).reshape(len(low), -1)


def _lists(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    """A list column with a row of the matrix where present, else an empty list."""
    ends = np.concatenate([[0], np.cumsum(np.where(present, rows.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows[present].ravel()))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (id, text) of a few MB of text."""
    for batch in batches:
        for i, j in portions(batch.column(1)):
            yield batch.slice(i, j - i)


def _signer(p: NearDuplicates):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = p.functions(p.minima, p.seed)
        places = mix(np.arange(1, p.minima + 1, dtype=np.uint64)).reshape(p.bands, p.rows) | np.uint64(1)
        for batch in _parts(batches):
            hashes, bounds = word_hashes(*text_buffer(batch.column(1)))
            n = batch.num_rows
            sizes, keys = np.zeros(n, np.int64), np.zeros((n, 2), np.int64)
            low = np.zeros((n, p.minima), np.uint32)
            for i in range(n):
                shingles = np.unique(runs(hashes[bounds[i] : bounds[i + 1]], p.words))
                sizes[i] = len(shingles)
                if len(shingles):
                    keys[i] = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
                    low[i] = _minima(shingles, factors, shifts)
            present = sizes > 0
            bands = signed(mix((mix(low.reshape(n, p.bands, p.rows).astype(np.uint64) + places)).sum(axis=2)))
            planes = _planes(low, p.bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(keys[:, 0]), pa.array(keys[:, 1]), _lists(planes, present), _lists(bands, present)],
                ["doc_id", "n_shingles", "k1", "k2", "planes", "bands"],
            )

    return sign


def signatures(docs: DataFrame, p: NearDuplicates = NearDuplicates(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, size of its set, 128-bit key of the set, bit planes of the minima, band keys."""
    if p.minima % 64 or p.wide % 64:
        raise ValueError("bands * rows and wide are multiples of 64")
    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_signer(p), SIGNED)


def estimate(a: Sequence[Column], b: Sequence[Column], minima: int, bits: int) -> Column:
    """Similarity by bit counts: minima differ where any of their planes differs; chance hits are taken off."""
    longs = minima // 64
    differing = F.lit(0)
    for i in range(longs):
        either = F.lit(0).cast("bigint")
        for at in range(i, bits * longs, longs):
            either = either.bitwiseOR(a[at].bitwiseXOR(b[at]))
        differing = differing + F.bit_count(either)
    chance = 2.0**-bits
    return (1 - differing / F.lit(float(minima)) - F.lit(chance)) / F.lit(1 - chance)


def may_link(p: NearDuplicates, minima: int, bits: int) -> Column:
    """Whether sizes m, n and planes p0.., q0.. allow a link."""
    planes = range(minima // 64 * bits)
    equal = estimate([F.col(f"p{i}") for i in planes], [F.col(f"q{i}") for i in planes], minima, bits)
    near = equal >= F.lit(p.least_estimate(minima, bits))
    return (100 * F.least("m", "n") >= p.percent * F.greatest("m", "n")) & near


def _spread(name: str, minima: int, bits: int) -> list[Column]:
    """The array of planes as columns: a condition over them stays small enough to be compiled."""
    return [F.coalesce(F.col("planes").getItem(i), F.lit(0)).alias(f"{name}{i}") for i in range(minima // 64 * bits)]


def _widener(p: NearDuplicates):
    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = p.functions(p.wide, p.seed + 1)
        for batch in batches:
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
            low = np.array([_minima(x, factors, shifts) for x in sets], np.uint32).reshape(len(sets), p.wide)
            planes = _lists(_planes(low, p.wide_bits), np.ones(len(sets), bool))
            sizes = pa.array([len(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, planes], ["node", "n", "planes"])

    return widen


def _set_maker(p: NearDuplicates):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            hashes, bounds = word_hashes(*text_buffer(batch.column(1)))
            found = [np.unique(runs(hashes[bounds[i] : bounds[i + 1]], p.words)).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "shingles"])

    return sets


def _confirmer(p: NearDuplicates):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(x) + len(y) - len(np.union1d(x, y))
                linked.append(100 * shared >= p.percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return confirm


def _confirmed(pairs: DataFrame, sets: DataFrame, p: NearDuplicates) -> DataFrame:
    """Those of the pairs (a, b) that are linked by their full sets."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(_confirmer(p), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, p: NearDuplicates = NearDuplicates(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept.

    Rows are linked if 100 * intersection >= percent * union of their shingle
    sets. A null or blank text has an empty set and is linked with nothing. Rows
    with one id are one document: its links are those of all its texts. A row
    whose id is null is its own group: component_id null, kept true. Other
    columns are not read. An empty table gives an empty result. A very long text is
    a portion of a task alone, held as 8 bytes a word in a few arrays.
    """
    signed_docs = written(signatures(docs, p, id, text), "signatures")
    known = signed_docs.where("n_shingles > 0 and doc_id is not null")
    firsts = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    nodes = written(
        known.withColumnRenamed("doc_id", "node").join(firsts, ["k1", "k2", "node"], "left_semi").dropDuplicates(["k1", "k2"]),
        "nodes",
    )
    # 1. Buckets of at least two nodes, and a star in each.
    members = nodes.select("node", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = written(members.join(shared, "band"), "buckets")
    print_of = nodes.select("node", F.col("n_shingles").alias("n"), "planes")

    def candidates(pairs: DataFrame) -> DataFrame:
        left = pairs.join(print_of.select(F.col("node").alias("a"), F.col("n").alias("m"), *_spread("p", p.minima, p.bits)), "a")
        right = print_of.select(F.col("node").alias("b"), "n", *_spread("q", p.minima, p.bits))
        return left.join(right, "b").where(may_link(p, p.minima, p.bits)).select("a", "b").distinct()

    star = written(candidates(buckets.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()), "star")
    # 2. Sets of the nodes that share a bucket; their texts are found by id.
    wanted = buckets.select("node").distinct()
    texts = docs.select(F.col(id).cast("bigint").alias("node"), F.col(text).alias("text"))
    texts = texts.join(wanted, "node", "left_semi").dropDuplicates(["node", "text"])
    sets = written(texts.mapInArrow(_set_maker(p), "node bigint, shingles binary"), "sets")
    several = known.groupBy("doc_id").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low < high").select("doc_id")
    of_one_id = known.join(several, "doc_id", "left_semi").join(nodes.select("k1", "k2", "node"), ["k1", "k2"])
    linked = written(
        _confirmed(star, sets, p).unionByName(of_one_id.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()), "linked"
    )
    groups = components(linked)
    # 3. Pairs across the components of a bucket.
    placed = buckets.join(groups, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_ = written(placed.join(mixed.select("band"), "band", "left_semi"), "open")
    wide = sets.join(open_.select("node").distinct(), "node", "left_semi").mapInArrow(
        _widener(p), "node bigint, n bigint, planes array<bigint>"
    )
    open_ = open_.join(written(wide, "wide"), "node").join(nodes.select("node", "bands"), "node")
    left = open_.select("band", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("m"), F.col("bands").alias("x"), *_spread("p", p.wide, p.wide_bits))
    right = open_.select("band", F.col("node").alias("b"), F.col("component").alias("cb"), "n", F.col("bands").alias("y"), *_spread("q", p.wide, p.wide_bits))
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    # A pair comes out of the first of its common buckets only.
    first = F.col("band") == F.array_min(F.array_intersect("x", "y"))
    across = left.join(right, "band").where("ca < cb").where(may_link(p, p.wide, p.wide_bits)).where(first).select(*ends)
    more = written(_confirmed(across.join(star, ["a", "b"], "left_anti"), sets, p), "more")
    if not more.isEmpty():
        groups = components(linked.unionByName(more))
    # 4. Every row gets its node's component.
    to_node = nodes.select("k1", "k2", "node").join(groups, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("group"))
    rows = signed_docs.select("doc_id", "n_shingles", "k1", "k2").join(to_node, ["k1", "k2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
