"""Each operator against a brute-force version, and its hard cases."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from foliant.llm import chat, cotrain, decontaminate, langid, lzprint, minhash, ngram, packing, queries, urlmodel, warc, words
from foliant.llm.graph import components

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i * i % 977}" for i in range(40_000))
HARD = [
    (1, None, None, "s", 3),
    (2, "", "en", None, None),
    (3, " \n\t", "en", "s", 1),
    (4, "one two", None, "s", 7),
    (5, "one two", "en", "s", 7),
    (5, "one two", "en", "s", 7),
    (6, LONG, "en", "s", len(LONG)),
    (7, LONG, "de", "t", len(LONG)),
    (None, "a text without an id, but with words enough", "en", "s", 3),
    (8, "x" * 300_000, "de", "t", 1),
    (9, "<|endoftext|> 🙂 e\u0301 \ud55c\uad6d\uc5b4", "en", "t", 2),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(HARD, SCHEMA).withColumn("node", F.lit(1)).withColumn("__text", F.lit("z")).withColumn("window", F.lit(0))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def split(text):
    return (text or "").encode().lower().split()


# Words.


def test_words_are_those_of_bytes_split():
    r = random.Random(1)
    texts = ["".join(r.choice("aB é\t\n\x0b\x1c🙂.") for _ in range(r.randrange(40))) for _ in range(300)] + ["q" * (words.CHUNK + 9) + " b", ""]
    hashes, bounds = words.word_hashes(*words.text_buffer(pa.array(texts).slice(0)))
    names = {}
    for i, t in enumerate(texts):
        found = hashes[bounds[i] : bounds[i + 1]].tolist()
        assert len(found) == len(split(t))
        for h, w in zip(found, split(t)):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_words_over_chunks(monkeypatch):
    texts = pa.array([LONG[:5000], None, LONG[300:9000], "a b c"])
    whole = words.word_hashes(*words.text_buffer(texts))
    monkeypatch.setattr(words, "CHUNK", 64)
    monkeypatch.setattr(words, "_POWERS", {})
    parts = words.word_hashes(*words.text_buffer(texts))
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_portions_cover_all_rows():
    for texts in (["aa", None, "b" * 50, "", "cc"], [], [None, ""], ["x"] * 40):
        column = pa.array(["skipped", *texts], pa.string()).slice(1)
        ranges = list(words.portions(column, 7))
        assert [i for a, b in ranges for i in range(a, b)] == list(range(len(texts)))
        assert all(b - a == 1 or sum(len(t or "") for t in texts[a:b]) <= 7 for a, b in ranges)


# 7. Near duplicates.


def components_by_hand(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def test_components(spark):
    r = random.Random(3)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5), (2000, 2000)]
    found = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    expected = components_by_hand([p for p in pairs if p[0] != p[1]])
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def near_by_hand(texts, percent=85):
    sets = {}
    for id, t in texts.items():
        w = split(t)
        sets[id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    pairs = [(i, i) for i in ids]
    for x, a in enumerate(ids):
        for b in ids[:x]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                pairs.append((a, b))
    return {i: len(sets[i]) for i in ids}, components_by_hand(pairs)


def test_near_duplicates_are_those_of_all_pairs(spark):
    r = random.Random(5)
    texts = {}
    base = [f"b{i}" for i in range(120)]
    for i in range(160):  # a large group with few and many edits
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8])):
            w[r.randrange(120)] = f"x{r.randrange(10**6)}"
        texts[i] = " ".join(w)
    for i in range(160, 260):
        texts[i] = " ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(0, 9)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sizes, groups = near_by_hand(texts)
    for row in minhash.near_duplicates(docs).collect():
        assert (row["n_shingles"], row["component_id"]) == (sizes[row["doc_id"]], groups[row["doc_id"]])
        assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_near_duplicates_hard_cases(hard, empty):
    rows = minhash.near_duplicates(hard).collect()
    assert len(rows) == len(HARD)
    group = {r["doc_id"]: r["component_id"] for r in rows}
    assert (group[4], group[5], group[6], group[7], group[1], group[None]) == (4, 4, 6, 6, 1, None)
    assert minhash.near_duplicates(empty).count() == 0


def test_one_id_with_two_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id bigint, text string")
    assert {r["component_id"] for r in minhash.near_duplicates(docs).collect()} == {1}


def test_estimate_is_near_the_similarity(spark):
    p = minhash.NearDuplicates()
    a, b = [f"a{i}" for i in range(400)], [f"a{i}" for i in range(100, 500)]
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id bigint, text string")
    x, y = sorted(minhash.signatures(docs, p).collect())
    frame = spark.createDataFrame([(x["planes"], y["planes"])], "x array<bigint>, y array<bigint>")
    planes = range(p.minima // 64 * p.bits)
    value = frame.select(minhash.estimate([F.col("x")[i] for i in planes], [F.col("y")[i] for i in planes], p.minima, p.bits)).first()[0]
    assert abs(value - 296 / 496) < 0.15


def test_small_sets_above_the_threshold_may_link():
    p, left_out, n = minhash.NearDuplicates(), 0, 3000
    factors, shifts = p.functions(p.wide, p.seed + 1)
    elements = words.mix(np.arange(1, 7 * n + 1, dtype=np.uint64)).reshape(n, 7)
    for x in elements:
        low = np.stack([minhash._minima(s, factors, shifts) for s in (x[:6], x)])
        planes = minhash._planes(low, p.wide_bits).view(np.uint64)
        differing = np.bitwise_or.reduce((planes[0] ^ planes[1]).reshape(p.wide_bits, -1), axis=0)
        equal = 1 - sum(int(v).bit_count() for v in differing) / p.wide
        left_out += (equal - 0.25) / 0.75 < p.least_estimate(p.wide, p.wide_bits)
    assert left_out == 0


# 1. Decontamination.


def tiles_by_hand(doc, item, least):
    used_d, used_i, out = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and not used_d[p + n] and not used_i[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < least:
            return out
        out.append(n)
        used_d[p : p + n] = [True] * n
        used_i[q : q + n] = [True] * n


def test_tiles_are_those_of_greedy_search():
    for seed in range(150):
        r = random.Random(seed)
        item = [r.randrange(6) for _ in range(r.randrange(3, 25))]
        doc = [r.randrange(6) for _ in range(r.randrange(3, 60))]
        if seed % 2:
            doc[5:5] = item[10:] + [9] + item[:10]
        starts = [p for p in range(len(doc) - 2) if any(doc[p : p + 3] == item[q : q + 3] for q in range(len(item) - 2))]
        found = decontaminate.tile(np.array(doc, np.uint64), np.array(item, np.uint64), np.array(starts, np.int64), 3)
        assert sorted(n for *_, n in found) == sorted(tiles_by_hand(doc, item, 3))
        assert all(doc[d : d + n] == item[i : i + n] for d, i, n in found)


def test_contaminated_documents(spark):
    item = "alpha beta gamma delta epsilon zeta. eta theta iota kappa lambda mu nu xi omicron pi rho sigma"
    swapped = "first words. Eta THETA iota, kappa lambda mu nu xi omicron pi rho sigma; and then alpha beta gamma delta epsilon zeta!"
    little = "alpha beta gamma delta epsilon, and nothing else of it"
    docs = [(1, item), (2, swapped), (3, little), (4, None), (5, ""), (None, item), (6, f"{LONG} {item} {LONG}"), (7, "Tiny Item")]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(5))
    items = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "tiny item"), (10, item)], "item_id bigint, text string")
    for block in (1 << 20, 50):  # one block, several blocks
        found = decontaminate.contaminated(docs, items, decontaminate.Tiling(block_bytes=block)).collect()
        pairs = Counter((r["doc_id"], r["item_id"]) for r in found)
        assert pairs == {(1, 10): 2, (2, 10): 2, (None, 10): 2, (6, 10): 2, (7, 13): 1}
        assert {r["coverage"] for r in found} == {1.0}
        assert {len(r["tiles"]) for r in found if r["doc_id"] == 2} == {2}
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


# 2. WARC.


def test_warc_query_and_single_records(spark):
    folder = warc.shared_folder(spark)
    p = warc.Bundles(frame=3000, bundle=20_000)
    big = "é" * 600
    rows = [(1, "http://a/\r\n%41", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"), (None, "u", big), (7, "u", big + "\r\n\r\n")]
    rows += [(7, "u", big + "\r\n\r\n"), (8, "v", LONG)] + [(100 + i, f"u{i}", f"{i} " * 700) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("x"))
    index = warc.archived(pages, folder, p)
    assert index.count() == len(rows) and index.select("bundle").distinct().count() > 1
    found = {r["page_id"]: r for r in warc.payload_facts(warc.records(index)).collect()}
    for page, _, html in rows:
        payload = (html or "").encode()
        assert (found[page]["payload_bytes"], found[page]["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
    assert {k: r["refers_to"] for k, r in found.items() if r["record_type"] == "revisit"} == {1: 2, None: 2}
    one = warc.records(index.where("page_id = 1")).first()
    assert (one["url"], one["record_type"], one["payload"]) == ("http://a/\r\n%41", "revisit", bytearray())
    assert bytes(warc.records(index.where("page_id = 8")).first()["payload"]).decode() == LONG
    # Any reader of Zstandard reads a bundle from the front: the seek table is a frame to skip.
    import zstandard

    path = index.first()["bundle"].removeprefix("file:")
    path = "/" + path.lstrip("/")
    with open(path, "rb") as file:
        content = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    at = 0
    while at < len(content):
        *_, at = warc.parse_record(content, at)
    assert warc.payload_facts(warc.records(warc.archived(pages.limit(0), folder, p))).count() == 0


# 3. Packing.


def check_pieces(rows, texts, length=2048):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r["doc_id"]].append(r)
        of_sequence[r["sequence_id"]].append(r)
    for id, all_texts in texts.items():
        ids = [np.array([*exact.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in all_texts]
        assert sorted(r["length"] for r in of_doc[id] if r["start"] == 0) == sorted(min(length, len(x)) for x in ids)
        if len(ids) == 1:
            at = 0
            for r in sorted(of_doc[id], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(ids[0])
                at += r["length"]
                assert zlib.crc32(ids[0][r["start"] : at].tobytes()) == r["ids_crc32"]
            assert at == len(ids[0])
    for pieces in of_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    return len(of_sequence) * length / sum(r["length"] for r in rows)


def test_packing(spark, hard, empty):
    p = packing.Packing(queries.vocabulary())
    texts = defaultdict(list)
    for id, text, *_ in HARD:
        texts[id].append(text)
    check_pieces(packing.packed(hard, p).collect(), texts)
    assert packing.packed(empty, p).count() == 0


def test_packing_query(spark, documents):
    padded = check_pieces(queries.op3(spark, SF).collect(), {k: [v] for k, v in documents.items()})
    assert padded < 1.1


def test_leftovers_meet_in_groups(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(16)
    p = packing.Packing(queries.vocabulary(), windows=4, merged=8)
    check_pieces(packing.packed(docs, p).collect(), {k: [v] for k, v in documents.items()})


def test_ids_are_those_of_the_tokenizers_library():
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = ["<|endoftext|>", "<|endoftext|", "<|", " ", "\n", "a", "hello world", "é", "🙂", "12", "'s"]
    r = random.Random(17)
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(9))) for _ in range(500)] + ["hello <|endoftext|> world", f"{LONG}<|endoftext|>"]
    encoder = packing.Encoder(queries.vocabulary())
    for text in texts:
        assert encoder.ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_packing_of_texts_with_added_tokens(spark):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {1: "hello <|endoftext|> world", 2: "<|endoftext|>" * 3000, 3: "hello world"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = packing.packed(docs, packing.Packing(queries.vocabulary())).collect()
    for id, text in texts.items():
        ids = np.array([*exact.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows if r["doc_id"] == id)
        parts = [ids[i : i + 2048] for i in range(0, len(ids), 2048)]
        assert own == [(i * 2048, len(x), zlib.crc32(x.tobytes()), len(ids)) for i, x in enumerate(parts)]


# 4. Language.


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op4(spark, folder).collect()
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.97


def test_language_hard_cases(spark, hard, empty):
    model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = langid.identified(hard, model).collect()
    assert len(rows) == len(HARD)
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert und == {1, 2, 3} and all(r["rejected"] for r in rows if r["doc_id"] in und)
    assert langid.learn(empty) == {} and langid.identified(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.identified(hard, {}).collect()} == {"und"}


def test_language_of_texts_of_megabytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.learn(docs)
    joined = []
    for lang in model:
        text = " ".join(r["text"] for r in docs.where((F.col("lang") == lang) & (F.length("text") > 2000)).limit(1500).collect())
        joined += [(len(joined) + i, (text * (size // len(text) + 1))[:size], lang) for i, size in enumerate((100_000, 2_000_000, 4_000_000))]
    lang = {id: l for id, _, l in joined}
    rows = langid.identified(spark.createDataFrame(joined, "doc_id bigint, text string, lang string"), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in rows} == lang
    assert not any(r["rejected"] for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert all(score[i + 2] > 0.7 * score[i] for i in range(0, len(joined), 3))


# 5. Fingerprints.


def phrases_by_hand(text):
    seen, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            start = end
    return seen


def test_phrases():
    for seed in range(200):
        r = random.Random(seed)
        text = "".join(r.choice("abé🙂 ") for _ in range(r.randrange(80)))
        ends = lzprint.phrase_ends(text)
        assert {text[a:b] for a, b in zip([0, *ends], ends)} == phrases_by_hand(text)
        other = "".join(r.choice("abé🙂 ") for _ in range(r.randrange(80)))
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        printer = lzprint.Fingerprinter(lzprint.Phrases(dictionary=r.choice([7, 1000])))
        first, second = printer.of_both(text, len(text) - half, edited)
        assert (first == printer.signature(text)).all() and (second == printer.signature(edited)).all()


def check_fingerprints(rows, ordered):
    """rows against (id, text) in order."""
    printer = lzprint.Fingerprinter()
    expected = []
    for i, (id, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = printer.signature(text), printer.signature(edited), printer.signature(following)
        expected.append(
            (id, len(text), hashlib.sha256(edited.encode()).hexdigest(), lzprint.text_of(own), lzprint.text_of(other), lzprint.likeness(own, other), lzprint.likeness(own, after))
        )
    assert Counter(tuple(r) for r in rows) == Counter(expected)


def test_fingerprints_over_partitions(spark, documents):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = queries.op5(spark, SF).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    check_fingerprints(rows, sorted(documents.items()))


def test_fingerprints_hard_cases(spark, hard, empty):
    rows = lzprint.fingerprinted(hard).collect()
    order = [r["doc_id"] for r in hard.orderBy("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    texts = defaultdict(list)
    for id, text, *_ in HARD:
        texts[id].append(text or "")
    check_fingerprints(rows, [(id, texts[id][0]) for id in order])
    assert lzprint.fingerprinted(empty).count() == 0
    alone = lzprint.fingerprinted(hard.where("doc_id = 4")).first()
    assert alone["near_next"] == 1 and 0 <= alone["near_edited"] <= 1


# 6. URLs.


def judge_by_hand(urls, rules, p=urlmodel.UrlModel()):
    import math

    def parts(url):
        if "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:n], rest[n:]
        for c in "?#":
            path = path.split(c, 1)[0]
        return "".join(x.lower() if x.isascii() else x for x in host), path

    def ruled(url):
        host, path = parts(url)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.rule), default=None)

    small = lambda u: "".join(x.lower() if x.isascii() else x for x in u)
    counts = {v: (Counter(), Counter()) for v in ("allow", "block")}
    apart = lambda u: int(hashlib.md5(u.encode()).hexdigest()[:6], 16) % p.apart == 0
    for u in urls:
        if (r := ruled(u)) and not apart(u):
            text = "^" * p.order + small(u) + "$"
            for i in range(p.order, len(text)):
                for k in range(p.order + 1):
                    counts[r.verdict][0][text[i - k : i + 1]] += 1
                    counts[r.verdict][1][(k, text[i - k : i])] += 1

    def score(u):
        text, total = "^" * p.order + small(u) + "$", 0
        for i in range(p.order, len(text)):
            chance = {}
            for v, (n, c) in counts.items():
                chance[v] = 1 / p.alphabet
                for k in range(p.order + 1):
                    chance[v] = (n[text[i - k : i + 1]] + p.mass * chance[v]) / (c[k, text[i - k : i]] + p.mass)
            total += round((math.log(chance["allow"]) - math.log(chance["block"])) * urlmodel.UNIT)
        return math.floor(total / (len(u) + 1))

    known = [(score(u) // urlmodel.STEP, ruled(u).verdict) for u in urls if ruled(u) and apart(u)]
    a, b = (sum(v == x for _, v in known) for x in ("allow", "block"))
    errors = {s: sum(v == "allow" and x < s for x, v in known) * b + sum(v == "block" and x >= s for x, v in known) * a for s, _ in known}
    cut = min(errors, key=lambda s: (errors[s], s)) * urlmodel.STEP if a and b else 0
    out = []
    for u in urls:
        r = ruled(u)
        out.append((*parts(u), r and r.rule, r.verdict if r else "allow" if score(u) >= cut else "block"))
    return out


def test_urls(spark):
    urls = [r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    urls += [None, "", "no scheme", "HTTP://WWW.Example.NET/en/x?y#z", "ftp://a.org?q/fr/", "x://net", "x://net/", "x://subnet/", "a://b://c", "é://ü/ß", "l" * 5000]
    urls += ["https://x.example.com/en/1"] * 50
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("host", F.lit("h"))
    rows = sorted(urlmodel.judged(pages, queries.RULES).drop("score").collect())
    assert [tuple(r)[1:] for r in rows] == judge_by_hand([u or "" for u in urls], queries.RULES)
    assert urlmodel.judged(pages.limit(0), queries.RULES).count() == 0
    assert {r["verdict"] for r in urlmodel.judged(pages.where("url is null"), queries.RULES).collect()} == {"allow"}


# 8. Quality.


def test_quality_of_labels_kept_apart(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = {r["doc_id"]: r["good"] for r in queries.good_labels(spark, folder).collect()}
    held = {i for i in good if i % 3 == 0}
    labels = queries.good_labels(spark, folder).where("doc_id % 3 <> 0")
    rows = [r for r in cotrain.scored(docs, cotrain.learn(docs, labels)).collect() if r["doc_id"] in held]
    kept = [not r["rejected"] for r in rows if good[r["doc_id"]]]
    caught = [r["rejected"] for r in rows if not good[r["doc_id"]]]
    assert sum(kept) / len(kept) > 0.985 and sum(caught) / len(caught) > 0.75
    assert all(0 <= r[c] <= 1 for r in rows for c in ("text_score", "meta_score", "score"))


def test_toxic_documents_of_labels_kept_apart(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r["doc_id"] % 3 == 0}
    english = {r["doc_id"]: r["lang"] == "en" for r in docs.select("doc_id", "lang").collect()}
    model = cotrain.learn(docs, queries.good_labels(spark, folder).where("doc_id % 3 <> 0"))
    rejected = {r["doc_id"]: r["rejected"] for r in cotrain.scored(docs, model).collect()}
    caught = {e: [rejected[i] for i, (_, toxic) in known.items() if toxic and english[i] == e] for e in (True, False)}
    clean = [not rejected[i] for i, label in known.items() if label == (1, 0)]
    assert sum(caught[True]) / len(caught[True]) > 0.93 and sum(caught[False]) / len(caught[False]) > 0.75
    assert sum(clean) / len(clean) > 0.985


def test_the_cut_follows_good_documents():
    p = cotrain.CoTraining(threshold=0.2, highest=0.5, lost=0.01)
    assert cotrain._cut(np.full(200, 0.9), p) == 0.5 and cotrain._cut(np.zeros(0), p) == 0.2
    assert cotrain._cut(np.array([0.01, 0.02, 0.3, *[0.9] * 197]), p) == pytest.approx(0.3)
    assert cotrain._cut(np.full(200, 0.01), p) == 0.2


def test_terms_are_words_and_their_beginnings():
    texts = pa.array(["", "abcdefgh, abcdefxy Abcdef", None, "abcde abcdefgh", "ab"])
    terms, bounds, _ = cotrain._text(texts)
    assert bounds.tolist() == [0, 0, 6, 6, 10, 12]
    word, stem = terms[0::2], terms[1::2]
    assert stem[0] == stem[1] == stem[4] != word[0] and word[0] == word[4] != word[1]
    assert stem[2] == word[2] and stem[3] == word[3] and stem[5] == word[5]
    held = cotrain.Finder(np.unique(terms))(terms, bounds)
    assert held.shape == (5, len(cotrain.LEVELS) * len(np.unique(terms)))
    assert not held[0].any() and not held[2].any()


def test_quality_hard_cases(spark, hard, empty):
    labels = spark.createDataFrame([(4, True), (4, False), (None, True), (5, None), (6, True), (7, False), (9, False), (99, True)], "doc_id bigint, good boolean")
    model = cotrain.learn(hard, labels)
    assert cotrain.scored(hard, model).count() == len(HARD)
    none = cotrain.learn(hard, labels.limit(0))
    assert {r["score"] for r in cotrain.scored(hard, none).collect()} == {0.5}
    assert cotrain.scored(empty, model).count() == 0 and cotrain.learn(empty, labels).text is None
    bare = hard.select("doc_id", "text")
    assert cotrain.scored(bare, cotrain.learn(bare, labels)).count() == len(HARD)


def in_memory(x, prints, p):
    """All rows of a pool in memory, as co_train asks for the surest of them."""

    def surest(views, taken):
        picks = [[], []]
        for view, label, _, at in cotrain.best_picks(views, taken, prints, x, p):
            picks[view].append((int(prints[at]), x[0][at], x[1][at], label))
        return picks

    return surest


def test_views_teach_each_other():
    r = np.random.default_rng(0)
    y = r.integers(0, 2, 600).astype(float)
    views = [(y[:, None] + r.normal(0, 0.35, (600, 3))).astype(np.float32) for _ in range(2)]
    p = cotrain.CoTraining(confidence=0.6, surest=30)
    pool = in_memory([x[12:] for x in views], np.arange(588), p)
    text, meta = cotrain.co_train(*(x[:12] for x in views), y[:12], pool, p)
    for view, x in zip((text, meta), views):
        assert ((view.raw(x[12:]) > 0) == y[12:]).mean() > 0.93


def test_rounds_are_those_of_a_plain_version():
    """Pseudo-labels by hand: every view names its surest, one per print, for the other to learn from."""
    r = np.random.default_rng(3)
    x = [r.random((80, 5)) < 0.5 for _ in range(2)]
    y = (x[0][:, 0] | x[1][:, 0]).astype(float)
    prints = np.array([i // 2 for i in range(60)])  # pool of 60 rows, two of each print
    p = cotrain.CoTraining(rounds=2, surest=4, confidence=0.5)
    views = cotrain.co_train(x[0][:20], x[1][:20], y[:20], in_memory([v[20:] for v in x], prints, p), p)
    learned = [([*range(20)], [*y[:20]]) for _ in x]
    plain = [None, None]
    for turn in range(p.rounds + 1):
        plain = [cotrain.fit(x[i][rows], np.array(labels), p.ridge, plain[i]) for i, (rows, labels) in enumerate(learned)]
        if turn == p.rounds:
            break
        chosen = []
        for i in (0, 1):
            held = {prints[row - 20] for row in learned[1 - i][0] if row >= 20}
            free = [20 + k for k in range(60) if prints[k] not in held and k % 2 == 0]
            chance = {row: 1 / (1 + np.exp(-float(plain[i].raw(x[i][[row]])[0]))) for row in free}
            for label, sure in ((1.0, chance), (0.0, {k: 1 - v for k, v in chance.items()})):
                best = sorted(free, key=lambda row: -sure[row])[: p.surest]
                chosen += [(1 - i, row, label) for row in best if sure[row] >= p.confidence]
        for other, row, label in chosen:
            learned[other][0].append(row)
            learned[other][1].append(label)
    for view, other in zip(views, plain):
        assert view.weights == pytest.approx(other.weights, abs=1e-3)


def test_fit_is_at_the_least_loss():
    r = np.random.default_rng(5)
    x, y = r.random((300, 6)) < 0.4, (r.random(300) < 0.5).astype(float)
    view = cotrain.fit(x, y, 0.5)
    full = np.concatenate([x, np.ones((300, 1))], axis=1)
    slope = full.T @ (1 / (1 + np.exp(-full @ view.weights)) - y) + 0.5 * view.weights
    assert np.abs(slope).max() < 0.05
    cotrain._calibrate(view, x, y)
    raw, target = view.raw(x), np.where(y > 0.5, (y.sum() + 1) / (y.sum() + 2), 1 / (300 - y.sum() + 2))
    error = 1 / (1 + np.exp(-(view.scale * raw + view.shift))) - target
    assert abs(error.sum()) < 0.05 and abs((error * raw).sum() + view.scale - 1) < 0.05


def test_all_unlabelled_documents_may_be_labelled(spark, monkeypatch):
    """The rounds see every distinct row without a label, and the driver only a few."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    plain = cotrain._surest

    def watched(pool, model, p):
        seen.append(pool.count())
        inner = plain(pool, model, p)
        return lambda views, taken: [seen.append([len(x) for x in picks]) or x for picks in [inner(views, taken)] for x in picks]

    monkeypatch.setattr(cotrain, "_surest", watched)
    p = cotrain.CoTraining(surest=7)
    model = cotrain.learn(docs.unionByName(docs.limit(3)), queries.good_labels(spark, folder), p)
    labelled = queries.good_labels(spark, folder).select("doc_id").distinct().count()
    assert model.text is not None and docs.count() - labelled <= seen[0] <= docs.count() - labelled + 3
    assert all(n <= 14 for counts in seen[1:] for n in counts)


# 9. Language model.


def scores_by_hand(rows, taught, p=ngram.Automaton()):
    import math

    tokens = {id: [*split(t), 0] for id, t in rows.items()}
    grams = lambda w, n: [tuple([None, *w][i - n + 1 : i + 1]) for i in range(1, len(w) + 1) if i - n + 1 >= 0]
    count, held = Counter(), Counter()
    for id, w in tokens.items():
        if taught(id):
            for k in range(1, p.order + 1):
                count.update(grams(w, k))
            held.update(g[:-1] for k in range(2, p.order + 1) for g in grams(w, k))
    n, v = sum(c for g, c in count.items() if len(g) == 1), sum(len(g) == 1 for g in count)
    base_of = lambda x: (count[(x,)] + 0.5) / (n + 0.5 * (v + 1))

    def chance(g):
        if len(g) == 1:
            return base_of(g[0])
        mass = p.prior(len(g))
        return (count[g] + mass * chance(g[1:])) / (held[g[:-1]] + mass)

    out = {}
    for id, w in tokens.items():
        base = sum(math.log10(base_of(x)) for x in w)
        score = sum(math.log10(chance(tuple([None, *w][max(0, i - p.order + 1) : i + 1]))) for i in range(1, len(w) + 1))
        out[id] = (not taught(id), len(w), sum(count[(x,)] > 0 for x in w), n, base, score)
    return out


def check_scores(rows, expected):
    assert len(rows) == len(expected)
    for r in rows:
        held, n, known, total, base, score = expected[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)


def test_language_model_query(spark, documents):
    expected = scores_by_hand(documents, lambda id: zlib.crc32(str(id).encode()) % 5 != 1)
    rows = queries.op9(spark, SF).collect()
    check_scores(rows, expected)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model_over_many_blocks(spark, documents, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    p = ngram.Automaton(order=order, block_bytes=20_000)
    check_scores(ngram.scored(docs, F.col("doc_id") % 2 == 0, p).collect(), scores_by_hand(documents, lambda id: id % 2 == 0, p))


def test_language_model_hard_cases(hard, empty):
    rows = ngram.scored(hard, F.col("doc_id") < 6).collect()
    assert len(rows) == len(HARD) and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["score"] for r in ngram.scored(hard, F.lit(False)).collect()} == {0.0}
    assert ngram.scored(empty, F.lit(True)).count() == 0


@pytest.mark.parametrize("order", [2, 3, 4])
def test_states_sum_to_one(order):
    texts = pa.array(["a b a c a b", "b a", "c c c", "a b a b a b c"])
    p = ngram.Automaton(order=order, mass=3.0, fall=2.0)
    tokens = ngram.Tokens(texts, order)
    totals = {k: counts for k, _, counts in tokens.counts(np.ones(4, bool))}
    n, v = int(totals[1].sum()) - 4, len(tokens.grams[1]) - 1
    part = ngram.Part(totals, tokens, n, v, p)
    arcs, shorter = {}, {}  # of a state (words, number): weights by word, and the state that its failure arc leads to
    for i, w in enumerate(tokens.of[1].tolist()):
        for k in range(2, order + 1):
            if tokens.of[k][i] >= 0:
                state = (k - 1, int(tokens.history(k)[i]))
                arcs.setdefault(state, {})[w] = 10 ** part.arc[k][tokens.of[k][i]]
                shorter[state] = (k - 2, int(tokens.history(k - 1)[i])) if k > 2 else None
    unseen = 0.5 / (n + 0.5 * (v + 1))
    readable = [w for w in range(len(tokens.grams[1])) if w != tokens.start]

    def weight(state, w):
        if state is None:
            return unseen if w is None else 10 ** part.root[w]
        if w in arcs[state]:
            return arcs[state][w]
        return 10 ** part.fail[state[0] + 1][state[1]] * weight(shorter[state], w)

    assert {k for k, _ in arcs} == set(range(1, order))
    for state in arcs:
        assert sum(weight(state, w) for w in [*readable, None]) == pytest.approx(1)


# 10. Chat.


def test_round_trip_of_any_text():
    pieces = ["\\", "### ", "</turn>", "a", "\n", ": ", "User", "###", " ", "</tu", "rn>", "é", "🙂", "\x00"]
    for seed in range(20_000):
        r = random.Random(seed)
        text = "".join(r.choice(pieces) for _ in range(r.randrange(9)))
        role = r.choice(["user", "assistant", "", "x: y", "### ", "=a", "User", "</turn>"])
        s, begin, end, escaped = chat.format_turn(role, text)
        assert chat.parse(s + s) == [(role, text, begin, end), (role, text, len(s) + begin, len(s) + end)]
        assert escaped or s[begin:end] == text
    with pytest.raises(chat.GrammarError):
        chat.parse("### User: a ### User: b</turn>\n")


def digests_by_hand(turns):
    out = {}
    for conv, rows in turns.items():
        text = "".join(f"{role or ''}\n{t or ''}\n" for role, t in rows)
        loss = "".join(t or "" for role, t in rows if role == "assistant")
        out[conv] = (len(rows), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_query(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r["conv_id"]].append((r["role"], r["text"]))
    hard_text = "\\### Assistant: </turn> ok"
    turns[-7] = [("user", hard_text), ("assistant", hard_text)]
    rows = queries.op10(spark, SF).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows} == digests_by_hand(turns)
    assert {r["escaped_turns"] for r in rows if r["conv_id"] == -7} == {2}


def test_chat_hard_cases(spark):
    turns = [(1, 0, None, None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (None, None, "user", "x"), (None, None, "user", "y"), (2, 5, "a\nb", LONG)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("rendered", F.lit(1))
    expected = digests_by_hand({1: [("", ""), ("assistant", "a"), ("assistant", "a")], None: [("user", "x"), ("user", "y")], 2: [("a\nb", LONG)]})
    rows = chat.read_back(chat.formatted(frame)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows} == expected
    assert chat.read_back(chat.formatted(frame.limit(0))).count() == 0


def test_long_conversation_streams(spark):
    frame = spark.range(30_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.concat(F.lit("</turn>"), F.col("id")).alias("text"))
    row = chat.read_back(chat.formatted(frame)).first()
    loss = "".join(f"</turn>{i}" for i in range(30_000))
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (30_000, len(loss), hashlib.sha256(loss.encode()).hexdigest())


# Queries with SQL, and the pipeline.


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_give_the_rows_of_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    frame = queries.QUERIES[name](spark, SF)
    cursor = connection.execute(queries.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert Counter(tuple(r) for r in frame.select(columns).collect()) == Counter(cursor.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.4 * kept[0]
    assert decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    texts = {r["doc_id"]: [r["text"]] for r in docs.collect()}
    _, groups = near_by_hand({k: v[0] for k, v in texts.items()})
    assert all(k == v for k, v in groups.items())
    check_pieces(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), texts)


def test_pipeline_removes_near_copies_at_80_percent(spark):
    r = random.Random(11)
    texts, base = {}, [f"b{i}" for i in range(120)]
    for i in range(60):
        w = [x if i % 6 == 0 else f"g{i // 6}{x}" for x in base]
        for _ in range(r.choice([0, 1, 2, 3, 4])):
            w[r.randrange(120)] = f"x{r.randrange(10**6)}"
        texts[i] = " ".join(w)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    _, groups = near_by_hand(texts, percent=80)
    assert groups != near_by_hand(texts)[1]
    kept = {row["doc_id"] for row in corpus_pipeline.distinct_documents(spark, docs, SF).collect()}
    assert kept == {k for k, v in groups.items() if k == v}


def test_pipeline_keeps_one_row_of_each_text(spark):
    near = LONG + " and one more word"
    rows = [(1, "a b"), (1, "a b"), (2, "a b"), (None, "b"), (None, "b"), (None, "b"), (4, "b c d e f g"), (4, "other words"), (4, "B C d e f g")]
    rows += [(9, LONG), (None, LONG), (7, near), (8, LONG), (7, near), (None, None), (None, None), (5, None), (6, " "), (6, " "), (6, None), (6, "")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id bigint, text string, doc string").repartition(4)
    kept = Counter(tuple(r)[:2] for r in corpus_pipeline.distinct_documents(spark, docs, SF).collect())
    assert {t: n for t, n in kept.items() if t[0] != 4} == Counter(
        [(1, "a b"), (None, "b"), (7, near), (None, None), (5, None), (6, " "), (6, None), (6, "")]
    )
    assert sorted(t[1].lower() for t in kept.elements() if t[0] == 4) == ["b c d e f g", "other words"]


def test_pipeline_removes_contaminated_documents_without_an_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").orderBy("item_id").first()["text"]
    docs = spark.createDataFrame([(None, item), (None, LONG), (None, None), (1, item), (2, LONG), (3, None)], "doc_id bigint, text string")
    kept = Counter(tuple(r) for r in corpus_pipeline.decontaminated(spark, docs, SF).collect())
    assert kept == Counter([(None, LONG), (None, None), (2, LONG), (3, None)])


def test_pipeline_hard_cases(spark, hard, empty):
    docs = hard.select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("component_id"))
    for frame in (docs, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns and out.count() <= frame.count()
    assert os.path.isdir(SF)
