"""Importance resampling against a version by hand."""

import hashlib
import math
import re
import zlib
from collections import Counter
from dataclasses import replace

import pytest

from foliant.llm import queries, resample

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, place string, score int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def runs(text, longest):
    words = WORD.findall((text or "").translate(SMALL))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def by_hand(rows, target, p):
    bucket = lambda f: zlib.crc32(f.encode()) % p.buckets
    s, t = (Counter(bucket(f) for text in texts for f in runs(text, p.longest)[1]) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + p.buckets) / ((s[b] + 1) * (all_t + p.buckets))))
    out = []
    for id, text in rows:
        n_words, found = runs(text, p.longest)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{p.seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([id, len(found), weight, score, None, n_words])
    pool = sorted((r for r in out if r[5] >= p.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(pool[: len(pool) * p.percent // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in out]


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def check(found, expected):
    """Equal rows; where rows of equal score and id lie across the end, any of them may be drawn."""
    assert sorted(r["rank"] for r in found if r["rank"]) == sorted(r[4] for r in expected if r[4])
    assert by_id(tuple(r)[:4] for r in found) == by_id(r[:4] for r in expected)
    key = {r[4]: (r[0], r[3]) for r in expected if r[4]}
    assert {r["rank"]: (r["doc_id"], r["score"]) for r in found if r["rank"]} == key


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = queries.QUERIES["op13_importance_resampling"](spark, SF).collect()
    check(found, by_hand(rows, target, resample.Resampling()))


@pytest.mark.parametrize("longest, percent, probes", [(1, 50, 1), (3, 33, 4), (2, 100, 15), (1, 0, 15)])
def test_hard_cases(spark, longest, percent, probes):
    words = [f"w{i * i % 13} É{i % 5} x-{i % 7}" for i in range(40)]
    rows = [(i if i % 11 else None, " ".join(words[i % 9 : i % 9 + i % 13])) for i in range(60)]
    rows += [(5, rows[5][1])] * 9 + [(None, None), (70, ""), (71, " . "), (72, "Q" * 100_000), (73, "a b " * 30_000)]
    # One id with ties at any cut.
    rows += [(8, "same text of more than a few words " * 2)] * 40
    p = replace(resample.Resampling(), longest=longest, percent=percent, probes=probes, least_words=5)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    target = [None, "", "w1 w3 é1", "W9 É1 x 3"]
    found = resample.resampled(docs, spark.createDataFrame([(1, t, "", 0) for t in target], SCHEMA), p).collect()
    check(found, by_hand(rows, target, p))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert resample.resampled(none, none).count() == 0
    some = spark.createDataFrame([(i, "one two " * 20, "", 0) for i in range(20)], SCHEMA)
    found = resample.resampled(some, none).collect()
    check(found, by_hand([(i, "one two " * 20) for i in range(20)], [], resample.Resampling()))


def test_bisection_tries_few_thresholds():
    values = sorted([3, 3, 3, 9, -(10**18), 10**18, 77, 12, 12])
    for probes in (1, 2, 15):
        for least in range(1, len(values) + 1):
            jobs = []
            counts = lambda tried: jobs.append(tried) or [sum(v >= x for v in values) for x in tried]  # noqa: B023, E731
            found = resample.bisected(values[0], values[-1] + 1, counts, least, probes)
            assert found == sorted(values, reverse=True)[least - 1]
            assert len(jobs) <= 2 + math.log(2 * 10**18) / math.log(probes + 1) * 1.5
