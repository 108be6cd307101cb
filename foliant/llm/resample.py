"""Importance resampling of documents towards a target distribution.

Hashed features (runs of words, counted in buckets) of all documents and of the
target texts give every bucket a gain, the log of its share in the target over its
share in the documents. A document's weight is the mean gain of its features, read
from one array of bounded size; Gumbel noise from its id turns the highest scores
into a weighted sample without replacement.

The scores are written once, as numbers. The cutoff is found by bisection: each
step is one exact count over the written scores, first of the score, then of the
doc_id among rows tied at the cutoff. Only the rows beyond it are range-partitioned
and sorted for their ranks; no row is sorted to find the cutoff, and no text moves.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.pieces import Pieces, between, pieces
from foliant.llm.words import NOT_ALPHANUMERIC, mix, portions, text_buffer
from foliant.operators.rows import with_index
from foliant.session import written

_LAST = (1 << 63) - 1
_cut = between(NOT_ALPHANUMERIC)


@dataclass(frozen=True)
class Resampling:
    """longest: words of a feature, at most. buckets: of features. least_words: of a document
    that may be drawn. percent: of these documents to draw, rounded down. seed: of the
    noise. probes: thresholds that one count job tries."""

    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"
    probes: int = 15


def features(data: np.ndarray, found: Pieces, p: Resampling) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of runs: the bucket of every run, and each text's first place in them (n + 1 places)."""
    n = np.diff(found.bounds)
    for length in range(1, p.longest + 1):
        size = max(0, len(found.hashes) - length + 1)
        hashes = found.hashes[:size]
        for i in range(1, length):
            hashes = mix(hashes * np.uint64(3) + found.hashes[i : i + size])
        # Runs that reach into the next text are left out.
        left = np.maximum(0, n - (length - 1))
        bounds = np.concatenate([[0], np.cumsum(left)])
        at = np.arange(bounds[-1]) + np.repeat(found.bounds[:-1] - bounds[:-1], left)
        _, first, where = np.unique(hashes[at], return_index=True, return_inverse=True)
        distinct = []
        for i in at[first].tolist():
            words = [data[found.starts[k] : found.ends[k]].tobytes().lower() for k in range(i, i + length)]
            distinct.append(zlib.crc32(b" ".join(words)) % p.buckets)
        yield np.array(distinct, np.int64)[where], bounds


def _portions(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Pieces]]:
    for batch in batches:
        for i, j in portions(batch.column(column)):
            part = batch.slice(i, j - i)
            data, offsets = text_buffer(part.column(column))
            yield part, data, pieces(data, offsets, NOT_ALPHANUMERIC, _cut)


def _counter(p: Resampling):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(p.buckets, np.int64)
        for _, data, found in _portions(batches, 0):
            for buckets, _ in features(data, found, p):
                counts += np.bincount(buckets, minlength=p.buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    return count


def bucket_counts(rows: DataFrame, p: Resampling, text: str = "text") -> np.ndarray:
    """How many features of all rows fall into each bucket; one row per bucket reaches the driver."""
    counted = rows.select(F.col(text).alias("text")).where("text <> ''").mapInArrow(_counter(p), "bucket bigint, n bigint")
    counts = np.zeros(p.buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of each bucket's share in the target over that in the documents, smoothed by one, rounded down."""
    buckets, all_docs, all_target = len(docs), int(docs.sum()), int(target.sum())
    ratio = lambda s, t: (t + 1.0) * (all_docs + buckets) / ((s + 1.0) * (all_target + buckets))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def _weigher(gain, p: Resampling):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, found in _portions(batches, 1):
            total = n = np.zeros(part.num_rows, np.int64)
            for buckets, bounds in features(data, found, p):
                sums = np.concatenate([[0], np.cumsum(gain.value[buckets])])
                total = total + sums[bounds[1:]] - sums[bounds[:-1]]
                n = n + np.diff(bounds)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            columns = [part.column(0), pa.array(n), pa.array(np.diff(found.bounds)), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_features", "n_words", "weight"])

    return weigh


def noise(id: Column, seed: str) -> Column:
    """1000 times Gumbel noise from the id, rounded down; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def bisected(lo: int, hi: int, counts: Callable[[list[int]], list[int]], least: int, probes: int) -> int:
    """The largest x of lo <= x < hi whose count is at least ``least``; counts fall with x, and lo has enough.

    counts: one job that gives the exact counts of several thresholds.
    """
    while hi - lo > 1:
        step = max(1, -(-(hi - lo) // (probes + 1)))
        tried = list(range(lo + step, hi, step))[:probes]
        for x, n in zip(tried, counts(tried)):
            if n < least:
                hi = x
                break
            lo = x
    return lo


def _counts(rows: DataFrame, test: Callable[[int], Column]) -> Callable[[list[int]], list[int]]:
    return lambda tried: list(rows.agg(*[F.count_if(test(x)).alias(f"n{i}") for i, x in enumerate(tried)]).first())


def cutoff(scores: DataFrame, drawn: int, probes: int = 15) -> Column:
    """Which rows of scores (score, place) are among the ``drawn`` highest scores, ties to the smallest place.

    More than ``drawn`` rows meet it only where rows of equal score and place lie across the end.
    """
    if drawn <= 0:
        return F.lit(False)
    score, place = F.col("score"), F.col("place")
    lo, hi = scores.agg(F.min("score"), F.max("score")).first()
    least = bisected(lo, hi + 1, _counts(scores, lambda x: score >= x), drawn, probes)
    left = drawn - scores.where(score > least).count()
    tied = scores.where(score == least)
    first, last = tied.agg(F.min("place"), F.max("place")).first()
    # The smallest place with enough rows up to it is the largest of the negated ones.
    end = -bisected(-last, -first + 1, _counts(tied, lambda x: place <= -x), left, probes)
    return (score > least) | ((score == least) & (place <= end))


def resampled(docs: DataFrame, target: DataFrame, p: Resampling = Resampling(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_features, weight, score, rank (1, 2, 3, ... of drawn rows, else null).

    target: texts whose distribution is wanted, in the column of the same name. A
    null or empty text has no features, weight 0, and is never drawn; an empty
    target gives a flat distribution. Rows with one id have the same noise; of rows
    with equal score the smallest doc_id goes first, a null id last; rows equal in
    both (repeated rows) are ranked each, in any order. Very long texts are one
    portion of a task each. An empty table gives no rows. Only the id and the text
    are read, so extra columns of any name do no harm.
    """
    context = docs.sparkSession.sparkContext
    gain = context.broadcast(gains(bucket_counts(docs, p, text), bucket_counts(target, p, text)))
    sources = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    weighed = sources.mapInArrow(_weigher(gain, p), "doc_id bigint, n_features bigint, n_words bigint, weight bigint")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), p.seed))
    # Row numbers of the write tell repeated rows apart; they cannot change once written.
    numbers = written(
        scored.withColumn("place", F.coalesce("doc_id", F.lit(_LAST))).withColumn("row", F.monotonically_increasing_id()), "scores"
    )
    eligible = F.col("n_words") >= p.least_words
    pool = numbers.where(eligible)
    drawn = pool.count() * p.percent // 100
    chosen = eligible & cutoff(pool, drawn, p.probes)
    ranked = with_index(numbers.where(chosen).withColumn("down", -F.col("score")), ["down", "place", "row"])
    rank = F.when(F.col("idx") < drawn, F.col("idx") + 1).cast("bigint").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank).unionByName(numbers.where(~chosen).select(*columns, F.lit(None).cast("bigint").alias("rank")))
