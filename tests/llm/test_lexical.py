"""Ranked lexical search against scores of all documents by hand."""

import math
import random
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from foliant.llm import lexical, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, part string, score int, rank int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return [t.translate(SMALL) for t in TERM.findall(text or "")]


def by_hand(docs, items, top=10):
    vectors = [(id, Counter(terms_of(text))) for id, text in docs]
    vectors = [(id, v, sum(v.values())) for id, v in vectors if v]
    all_docs, all_terms = len(vectors), sum(n for *_, n in vectors)
    df = Counter(t for _, v, _ in vectors for t in v)
    weight = lambda t: math.floor(1000 * math.log((2 * all_docs + 2) / (2 * df[t] + 1)))
    out = []
    for item, text in items:
        asked, scores = Counter(terms_of(text)), []
        for id, v, n in vectors:
            m = 100 - 75 + 75 * n * all_docs // all_terms
            score = sum(k * weight(t) * (1_000_000_000 * v[t] // (1000 * v[t] + 8 * m)) for t, k in asked.items() if t in v)
            if score > 0:
                scores.append((-score, id is None, id))
        out += [(item, i + 1, id, -score) for i, (score, _, id) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top])]
    return out


def as_list(rows):
    return sorted(map(tuple, rows), key=str)


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = queries.QUERIES["op12_document_fp_tree"](spark, SF)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert as_list(found.collect()) == as_list(by_hand(docs, items))


@pytest.mark.parametrize("p", [lexical.Ranking(), lexical.Ranking(top=3, block_bytes=60, documents=4, terms=30, presence=7, scored=2)])
def test_hard_cases(spark, p):
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "x_y", "Ab", "aB"]
    text = lambda n: " ".join(r.choice(words[: r.randrange(2, len(words))]) for _ in range(n))
    docs = [(i if i % 13 else None, text(r.randrange(1, 30))) for i in range(120)]
    docs += [(200, docs[3][1])] * 30 + [(300 + i, docs[5][1]) for i in range(30)]
    docs += [(400, None), (401, ""), (402, " .,"), (None, None), (403, "w1 " * 50_000), (404, "q" * 100_000)]
    items = [(i, text(12)) for i in range(12)] + [(1, "w1 w1 w1"), (1, "w1 w1 w1"), (50, None), (51, ""), (52, "unknown"), (None, "W3 w4"), (53, "w7")]
    rows = lambda pairs: spark.createDataFrame([(*x, "clash", 1, 2) for x in pairs], SCHEMA)
    found = lexical.ranked(rows(docs).repartition(3), rows(items).withColumnRenamed("doc_id", "item_id"), p).collect()
    assert as_list(found) == as_list(by_hand(docs, items, p.top))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "one two", "", 0, 0)], SCHEMA)
    assert lexical.ranked(none, some.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert lexical.ranked(some, none.withColumnRenamed("doc_id", "item_id")).count() == 0


def tries(seed, n=60, vocabulary=12):
    r = random.Random(seed)
    vectors = [sorted(r.sample(range(vocabulary), r.randrange(0, vocabulary))) for _ in range(n)]
    vectors += vectors[:5] * 2
    terms = np.array([t for v in vectors for t in v], np.int64)
    tfs = np.array([r.randrange(1, 9) for _ in terms], np.int64)
    sizes = np.array([len(v) for v in vectors])
    m = np.array([r.randrange(25, 400) for _ in vectors], np.int64)
    starts = np.cumsum(sizes) - sizes
    return vectors, lexical.Trie(list(range(len(vectors))), m, starts, sizes, terms, tfs, 5, vocabulary)


def test_documents_share_the_paths_of_their_first_terms():
    for seed in range(20):
        vectors, trie = tries(seed)
        seen = []

        def walk(node, path):
            assert len(path) == trie.depth[node]
            for child in trie.children[node]:
                if child < 0:
                    doc = ~child
                    whole = trie.terms[trie.starts[doc] : trie.starts[doc] + trie.sizes[doc]].tolist()
                    assert whole == vectors[trie.ids[doc]] and whole[: len(path)] == path
                    seen.append(trie.ids[doc])
                else:
                    at = trie.segment_sizes[:child].sum()
                    segment = trie.segment_terms[at : at + trie.segment_sizes[child]].tolist()
                    assert segment and len(trie.children[child]) > 1
                    walk(child, path + segment)
            firsts = [vectors[trie.ids[~c]][len(path) : len(path) + 1] or [None, c] for c in trie.children[node] if c < 0]
            assert len({tuple(f) for f in firsts}) == len(firsts)

        walk(0, [])
        assert sorted(seen) == [i for i, v in enumerate(vectors) if v]


def test_no_document_is_better_than_the_bound_of_its_nodes():
    for seed in range(20):
        _, trie = tries(seed)
        r = random.Random(seed)
        places = np.array(r.sample(range(12), 5))
        weights = np.array([r.randrange(1, 9000) for _ in places])
        dense = np.zeros(12, np.int64)
        dense[places] = weights
        scores = lexical._sums(dense[trie.terms] * trie.impacts, trie.sizes)
        on_node = lexical._sums(dense[trie.segment_terms] * trie.segment_impacts, trie.segment_sizes)
        under = trie.below[:, places % trie.width] @ weights * trie.below_impact

        def walk(node, so_far):
            best = [scores[~c] if c < 0 else walk(c, so_far + on_node[c]) for c in trie.children[node]]
            assert max(best) <= so_far + under[node]
            return max(best)

        walk(0, 0)
        found = trie.best(places, weights, np.zeros(12, np.int64), [], replace(lexical.Ranking(), top=7, scored=3))
        expected = sorted((-s, False, trie.ids[i]) for i, s in enumerate(scores.tolist()) if s > 0)[:7]
        assert found == expected
