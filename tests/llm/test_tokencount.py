"""Token counts against the tokenizers library over whole texts."""

import random
from dataclasses import replace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from foliant.llm import queries, tokencount, words
from foliant.llm.pieces import pieces

SF = "/root/testdata/sf0.001"
P = tokencount.TokenCounts(public_tokenizers.path("word_bpe_49k.json"))
SCHEMA = "doc_id bigint, text string, n_tokens string, piece int"
PARTS = [
    "the", "The", "don't", "DON'T", "'ll", "x'sy", "12", "3.14", "naïve", "NAÏVE", "T̈", "ẗ", "é", "É", "ß", "İ", "Σς",
    "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "a<|endoftext|>b", "<|", "|>", "--", "—", "word—word", "한국어", "🙂🙂", " ", " ",
    "\u0085", "\x1c", "\x00", "a\x1fb", "½", "٣", "_", "foo_bar", "http://x.y/z?q=1", "‍", "x" * 70,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.vocabulary)


def texts(n, seed):
    r = random.Random(seed)
    gaps = [" ", "", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c"]
    return ["".join(r.choice(PARTS) + r.choice(gaps) for _ in range(r.randrange(30))) for _ in range(n)]


def test_counts_of_any_text(spark, library):
    made = [None, "", " \n", *texts(400, 1), "y" * 200_000, "a1 " * 50_000]
    rows = [(i if i % 7 else None, t, "clash", 0) for i, t in enumerate(made)] * 2
    found = tokencount.token_counts(spark.createDataFrame(rows, SCHEMA).repartition(5), replace(P, limit=100, frequent=64, heaviest=50)).collect()
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r[:3]) for r in found), key=key) == sorted(expected, key=key)
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in found)


def test_query(spark, library):
    found = queries.QUERIES["op11_two_tier_token_counts"](spark, SF).collect()
    documents = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in documents.items()}
    assert len(found) == len(documents) and {r["over_limit"] for r in found} <= {True, False}


def test_empty_table(spark):
    found = tokencount.token_counts(spark.createDataFrame([], SCHEMA), P)
    assert found.count() == 0 and found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_pieces_fill_what_blanks_leave():
    made = texts(100, 2)
    data, offsets = words.text_buffer(pa.array(made))
    found = pieces(data, offsets, words.BLANKS, tokencount.cut, fold=False)
    for i, text in enumerate(made):
        at = range(found.bounds[i], found.bounds[i + 1])
        assert b"".join(data[found.starts[k] : found.ends[k]].tobytes() for k in at) == b"".join(text.encode().split())


def test_the_table_finds_its_own_and_nothing_else():
    r = np.random.default_rng(1)
    for n in (0, 1, 1000):
        keys = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        table = tokencount.Table(keys, np.arange(len(keys)))
        found, unknown = table.find(keys)
        assert not len(unknown) and (found == np.arange(len(keys))).all()
        others = np.concatenate([keys + np.uint64(1 << 40), np.arange(100, dtype=np.uint64)])
        others = others[~np.isin(others, keys)]
        assert len(table.find(others)[1]) == len(others)


def test_a_worker_forgets_what_is_old(library):
    encoder = tokencount.Encoder(P.vocabulary, 10)
    for i in range(100):
        text = f"word{i % 30}"
        assert encoder.remembered([i % 30], lambda _: text) == [len(library.encode(text, add_special_tokens=False).ids)]  # noqa: B023
        assert len(encoder.young) <= 11 and len(encoder.old) <= 11
