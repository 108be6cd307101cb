"""News XML, feeds, archives, files, dictionaries, chains and streams."""

import datetime as dt
import gzip
import io
import random
import tarfile
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foliant.functions.spans import match_spans, set_annotation_set
from foliant.model import docs_to_cells, empty_annotations, meta_map, src_struct, text_struct
from foliant.operators import annotate, newsxml, profile, terms
from foliant.operators.upsert import newest
from foliant.session import written
from foliant.sources import archives, feeds, files, store
from foliant.sources.dictionary import StoredDictionary
from foliant.streaming import intake
from tests.conftest import counts, table

AT = dt.datetime(2024, 2, 3, 4, 5, 6, tzinfo=dt.timezone.utc)


@pytest.fixture
def docs_of(spark):
    def make(*rows, column="raw"):
        frame = spark.createDataFrame(rows, "row_key string, source string, t string")
        return frame.select(
            "row_key",
            src_struct(name=F.col("source")).alias("src"),
            meta_map(kept=F.lit("x")).alias("meta"),
            text_struct(**{column: F.col("t")}).alias("text"),
            empty_annotations().alias("annotations"),
        )

    return make


# -- news ----------------------------------------------------------------------

NEWS = """<?xml version="1.0"?><!DOCTYPE nitf SYSTEM "http://www.nitf.org/dtd">
<nitf><head><meta name="dsk" content="A &lt; B"/><meta name="print_page_number" content="7"/>
<meta name="print_page_number" content="bad"/><meta name="correction_date" content="never"/>
<docdata><doc-id id-string="x"/><doc-id id-string="9"/><identified-content>
<org class="indexing_service">A   <b>B</b></org><org class="online_producer">A B</org>
<person class="online_producer">Z</person><person class="indexing_service">C</person></identified-content></docdata>
<pubdata date.publication="20050607T080910" ex-ref="nowhere" item-length="12a" name="Wire"/></head>
<body><body.head><hedline><hl1>One</hl1><hl1>Two <i>three</i></hl1></hedline></body.head>
<body.content><block class="full_text"><p> One &lt;i&gt; <b>two</b> &amp; three </p><p>Four</p></block>
<block class="lead_paragraph"><p>x</p></block><block class="lead_paragraph"><p/></block></body.content></body></nitf>"""


def test_article_fields(docs_of):
    row = newsxml.articles(docs_of(("1", "NYT", NEWS), column="orig")).first()
    assert row["NewsDesk"] == "A < B" and row["Page"] == 7 and row["CorrectionDate"] is None
    assert row["Guid"] == 9 and row["Url"] is None and row["WordCount"] is None and row["Credit"] == "Wire"
    assert row["Headline"] == "Two three" and row["Body"] == "One <i> two & three\nFour"
    assert row["LeadParagraph"] is None and row["PublicationDate"] == dt.datetime(2005, 6, 7, 8, 9, 10)
    assert row["Organizations"] == ["A B"] and row["OnlinePeople"] == ["Z"] and row["Names"] == []


def test_article_rows(docs_of):
    docs = docs_of(
        ("1", "NYT", NEWS), ("2", "NYT", "<nitf><head>"), ("3", "NYT", "<nitf/>"), ("4", "AP", NEWS), ("5", "NYT", None),
        ("6", None, NEWS), column="orig",
    )
    out = newsxml.parse_articles(docs, "NYT").collect()
    assert [r["row_key"] for r in out] == ["1"]
    meta = out[0]["meta"]
    assert meta["NYT_Organizations"] == "A B\n" and meta["NYT_People"] == "C\nZ\n" and meta["kept"] == "x"
    assert meta["PublicationDate"] == "Tue Jun 07 08:09:10 UTC 2005" and "GeneralOnlineDescriptors" not in meta
    assert [r["row_key"] for r in newsxml.rejected(docs).collect()] == ["2"]
    assert counts(newsxml.skip_counts(docs, "NYT")) == {
        ("Parse NYT", "map"): 3,
        ("Parse NYT", "skip -- wrong source: AP"): 1,
        ("Parse NYT", "skip -- wrong source: null"): 1,
        ("Parse NYT", "skip -- null text"): 1,
    }


# -- feeds -----------------------------------------------------------------------

ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>F &lt;b&gt;</title><id>urn:f</id>
<link rel="self" href="http://f/self"/><link href="http://f/"/>
<ENTRYX/><entry><title>E</title><id>urn:1</id><link href="http://f/1"/><content type="html">&lt;p&gt;Hi&lt;/p&gt;</content>
<content type="xhtml"><div>x <b>y</b></div></content><content type="text"></content>
<author><name>Zed</name></author><author><name>Amy</name></author><category term="c"/></entry>
<entry><title>S</title><id>urn:2</id><summary>only</summary></entry></feed>"""
RSS = """<rss version="2.0"><channel><title>R</title><item><title>T</title><guid>g</guid>
<pubDate>Tue, 07 Jun 2005 08:09:10 +0200</pubDate><description><![CDATA[<p>d</p>]]></description></item></channel></rss>"""
OPEN = "<rss><channel><item><title>a</title></item><item><title>b"


@pytest.fixture
def feed_table(spark):
    rows = [("a", ATOM), ("r", RSS), ("o", OPEN), ("n", "no feed")]
    return spark.createDataFrame(rows, "url string, xml string")


def test_feed_rows(feed_table):
    parsed = feeds.parsed_entries(feed_table)
    entries = {r["meta"]["title"]: r for r in feeds.entry_docs(parsed, "s", AT).collect()}
    assert set(entries) == {"E", "S", "T"}
    first = entries["E"]["meta"]
    assert first["authors"] == "Amy, Zed" and first["links"] == "http://f/1" and first["categories"] == "c"
    assert first["feed_title"] == "F <b>" and first["feed_link"] == "http://f/" and first["ingestDate"].endswith("Z")
    assert entries["T"]["meta"]["published_date"] == "2005-06-07T06:09:10Z"
    bodies = feeds.content_docs(parsed, "s").select("text.orig", "text.mimeType", F.col("meta")["entry_tag_type"])
    assert table(bodies) == [
        ("<div>x <b>y</b></div>", "xhtml", "content"), ("<p>Hi</p>", "html", "content"),
        ("<p>d</p>", "text/html", "desc"), ("only", None, "desc"),
    ]
    back = feeds.content_docs(parsed, "s").select(F.col("meta")["entry_key"])
    assert {r[0] for r in back.collect()} == {r["row_key"] for r in entries.values()}
    assert table(feeds.rejected_feeds(feed_table), "url") == [("n",), ("o",)]


def test_tagged_feeds(spark, feed_table):
    tags = feeds.tag_table(spark.createDataFrame([('{"a": ["y", "x", "y"], "gone": ["z"]}',)], "value string"))
    found = feeds.tagged_feeds(feed_table, tags)
    assert {r["src"]["tags"] for r in feeds.feed_docs(found, "s").collect()} == {"x, y"}
    assert table(feeds.rejected_feeds(found)) == [("gone", "no feed")]
    assert feeds.ingest_total(feeds.parsed_entries(found)).first()["n"] == 2


# -- files and archives -----------------------------------------------------------

TREE = {
    "harbour.txt": "Boats come in at noon.",
    "notes.xml": "<note>low tide</note>",
    "north pier/lamp.txt": "The lamp is lit before dusk, also in summer.",
    "north pier/list.xml": "<ships/>",
}


@pytest.fixture
def tree(tmp_path):
    for name, content in TREE.items():
        path = tmp_path / "a folder" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    return tmp_path / "a folder"


def test_file_tree(spark, tree):
    assert tuple(files.total_size(files.file_inventory(spark, str(tree))).first()) == (2, sum(len(TREE[n]) for n in ("harbour.txt", "notes.xml")))
    assert files.file_inventory(spark, str(tree), glob="*.txt").count() == 1
    assert files.file_inventory(spark, str(tree), recursive=True).count() == 4
    docs = files.read_text_tree(spark, str(tree), "s")
    assert table(docs, "row_key", "text.orig") == [(n, TREE[n]) for n in ("harbour.txt", "north pier/lamp.txt")]
    (tree / "c++ 100%.txt").write_text("x")
    again = files.read_text_tree(spark, f"file://{tree}/", "s")
    assert ("c++ 100%.txt",) in table(again, "row_key")


def test_zip_entries(spark, tmp_path):
    members = {
        "gulls.txt": "Gulls over the quay",
        "ropes.txt": "Ropes, nets and a barrel",
        "tides.txt": "high low " * 300,
        "sails.canvas": "white canvas",
    }
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as out:
        for name, content in members.items():
            out.writestr(name, content)
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    zips = archives.read_archives(spark, str(tmp_path))
    plain = archives.zip_text(archives.zip_entries(zips, ["text/plain"]))
    assert table(plain, "entry", "text") == sorted((n, t) for n, t in members.items() if n.endswith(".txt"))
    assert archives.zip_entries(zips).count() == 4
    assert archives.zip_entries(zips, max_mib=100 / (1 << 20)).count() == 3
    assert archives.read_archives(spark, str(tmp_path)).columns == ["path", "length"]
    capped = archives.zip_entries(zips, max_entries=2, entries_per_task=1)
    assert sorted(r["entry"] for r in capped.collect()) == ["gulls.txt", "ropes.txt"]
    assert table(archives.broken_zips(zips), F.regexp_extract("path", "[^/]+$", 0)) == [("bad.zip",)]


class Recorded(io.BytesIO):
    """A file that knows how much of it was read."""

    def __init__(self, data):
        super().__init__(data)
        self.taken = 0

    def read(self, n=-1):
        data = super().read(n)
        self.taken += len(data)
        return data


@pytest.fixture
def large_zip(tmp_path):
    r = random.Random(2)
    bodies = {f"m{i:03d}.txt": r.randbytes(20_000) for i in range(60)}
    with zipfile.ZipFile(tmp_path / "large.zip", "w", zipfile.ZIP_DEFLATED) as out:
        for name, body in bodies.items():
            out.writestr(name, body)
    return str(tmp_path / "large.zip"), bodies


def test_one_archive_is_read_by_many_tasks(spark, large_zip):
    path, bodies = large_zip
    found = archives.zip_entries(archives.read_archives(spark, path), entries_per_task=10)
    rows = found.withColumn("task", F.spark_partition_id()).collect()
    assert {r["entry"]: bytes(r["content"]) for r in rows} == bodies
    tasks = {}
    for r in rows:
        tasks.setdefault(r["task"], []).append(r["entry"])
    assert len(tasks) > 3 and all(len(names) < 30 for names in tasks.values())
    # Entries of a task are neighbours.
    assert all(sorted(bodies).index(max(n)) - sorted(bodies).index(min(n)) == len(n) - 1 for n in tasks.values())


def test_only_what_is_wanted_is_read(spark, large_zip):
    path, bodies = large_zip
    data = open(path, "rb").read()
    directory = archives.zip_directory(archives.read_archives(spark, path))
    file = Recorded(data)
    assert len(list(archives._directory("p", lambda _: file))) == 60 and file.taken < 30_000
    some = archives.chosen_entries(directory, max_entries=2).toPandas()
    file = Recorded(data)
    assert [r["content"] for r in archives._contents(some, lambda _: file, None)] == [bodies["m000.txt"], bodies["m001.txt"]]
    assert file.taken < 50_000
    parts = list(archives._contents(some, lambda _: Recorded(data), 6000))
    assert [(r["entry"], r["part"], len(r["content"])) for r in parts] == [
        (f"m00{i}.txt", k, n) for i in range(2) for k, n in enumerate((6000, 6000, 6000, 2000))
    ]
    # The rest of the file may even be missing: a capped entry is not looked at.
    torn = data[: int(some["offset"].max() + some["packed_bytes"].max() + 60)]
    assert len([r for r in archives._contents(some, lambda _: Recorded(torn), None) if r["error"] is None]) == 2


def test_members_that_cannot_be_read(spark, large_zip, tmp_path, monkeypatch):
    path, bodies = large_zip
    (tmp_path / "empty.zip").write_bytes(b"PK\x05\x06" + b"\0" * 18)
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as out:
        out.writestr("nothing.txt", b"")
    directory = archives.zip_directory(archives.read_archives(spark, str(tmp_path)))
    assert directory.count() == 61
    frame = directory.where("entry in ('m003.txt', 'nothing.txt')").toPandas()
    frame.loc[frame.entry == "m003.txt", "crc"] += 1
    rows = {(r["entry"], r["part"]): r for r in archives._contents(frame, archives.opened, 15_000)}
    # What came before the damage is kept, and the error says so.
    assert len(rows["m003.txt", 0]["content"] or b"") in (0, 15_000) and any(r["error"] for k, r in rows.items() if k[0] == "m003.txt")
    assert rows["nothing.txt", 0]["content"] == b"" and rows["nothing.txt", 0]["error"] is None
    monkeypatch.setattr(archives, "LARGEST", 10_000)
    whole = list(archives._contents(frame, archives.opened, None))
    assert [r["error"] for r in whole if r["entry"] == "m003.txt"] == [archives.TOO_LONG]
    with tarfile.open(tmp_path / "t.tar", "w") as out:
        for name, body in list(bodies.items())[:2] + [("small.txt", b"s")]:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            out.addfile(info, io.BytesIO(body))
    found = list(archives._tar_members(str(tmp_path / "t.tar"), archives.opened))
    assert [(r["entry"], r["error"], r["content"]) for r in found][1:] == [("m001.txt", archives.TOO_LONG, None), ("small.txt", None, b"s")]


def test_tar_archives(spark, tmp_path):
    folder = tmp_path / "1987"
    folder.mkdir()
    with tarfile.open(folder / "a.tgz", "w:gz") as out:
        directory = tarfile.TarInfo("01")
        directory.type = tarfile.DIRTYPE
        out.addfile(directory)
        for name, body in (("01/x.xml", "<a>é</a>".encode()), ("01/y.xml", b"<b/>")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            out.addfile(info, io.BytesIO(body))
    (folder / "bad.tgz").write_bytes(gzip.compress(b"x" * 600))
    (tmp_path / "list").write_text(f"{folder}/a.tgz\n\n{folder}/bad.tgz\n")
    tars = archives.listed_archives(spark, str(tmp_path / "list"))
    docs = archives.tar_docs(tars, "NYT", AT)
    assert table(docs, "src.id", "text.orig") == [("198701/x.xml", "<a>é</a>"), ("198701/y.xml", "<b/>")]
    assert counts(archives.tar_counts(tars)) == {
        ("ImportNYT", "import file"): 2, ("ImportNYT", "skip dir"): 1, ("ImportNYT", "broken archive"): 1, ("ImportNYT", "repaired text"): 0,
    }


def test_annotated_corpus(spark):
    documents = spark.createDataFrame([("1", "a b", {"k": "v", "n": None}), ("2", "c", {})], "doc_id string, text string, meta map<string,string>")
    spans = spark.createDataFrame(
        [("1", "token", 1, 2, 3, "w", None), ("1", "token", 0, 0, 1, "w", {"f": "x"}), ("1", "ne", 0, 0, 3, "n", None)],
        "doc_id string, set string, id int, start int, end int, type string, features map<string,string>",
    )
    rows = {r["src"]["id"]: r for r in files.corpus_docs(documents, spans, "c").collect()}
    assert [a["start"] for a in rows["1"]["annotations"]["token"]] == [0, 2] and rows["1"]["meta"] == {"k": "v"}
    assert rows["2"]["annotations"] == {}


# -- annotations and terms ---------------------------------------------------------


@pytest.fixture
def annotated(docs_of):
    docs = docs_of(("d1", "NYT", "The New York times. new ideas"), ("d2", "NYT", "ideas ideas; The end"), ("d3", "AP", "x y"))
    token = match_spans(F.col("text.raw"), "[A-Za-z]+", "word")
    ne = match_spans(F.col("text.raw"), "New York", "LOC")
    out = docs.withColumn("annotations", set_annotation_set(F.col("annotations"), F.lit("token"), token))
    return out.withColumn(
        "annotations",
        F.when(F.col("row_key") != "d3", set_annotation_set(F.col("annotations"), F.lit("ne"), ne)).otherwise(F.col("annotations")),
    )


def test_term_frequencies(annotated):
    found = table(terms.term_frequencies(annotated, ["THE"]))
    assert found == [
        ("d1", 0, "New York", 1), ("d1", 1, "times", 1), ("d1", 2, "new", 1), ("d1", 3, "ideas", 1),
        ("d2", 0, "ideas", 2), ("d2", 1, "end", 1), ("d3", 0, "x", 1), ("d3", 1, "y", 1),
    ]


def test_stop_words_are_a_table_of_any_size(spark, annotated):
    listed = terms.stop_list(spark.createDataFrame([("THE # article",), ("ideas",)], "value string"))
    found = table(terms.term_frequencies(annotated.where("row_key <> 'd3'"), listed))
    assert found == [("d1", 0, "New York", 1), ("d1", 1, "times", 1), ("d1", 2, "new", 1), ("d2", 0, "end", 1)]
    # No filter, and a filter without words: only what is no word goes.
    assert table(terms.term_frequencies(annotated.where("row_key = 'd2'"))) == table(terms.term_frequencies(annotated.where("row_key = 'd2'"), []))


def test_terms_are_counted_by_hash_aggregates(spark, docs_of):
    words = ["Aa", "aA", "b", "B", "cc", "AA"]
    r = random.Random(4)
    texts = {f"d{i:03d}": [r.choice(words) for _ in range(r.randrange(40))] for i in range(60)}
    docs = docs_of(*[(k, "NYT", " ".join(t)) for k, t in texts.items()]).repartition(5)
    docs = docs.withColumn("annotations", set_annotation_set(F.col("annotations"), F.lit("token"), match_spans(F.col("text.raw"), "[A-Za-z]+", "word")))
    seen, counts = {}, {}
    for key in sorted(texts):
        for word in texts[key]:
            seen.setdefault(word.lower(), word)
            counts[key, word.lower()] = counts.get((key, word.lower()), 0) + 1
    found = terms.document_terms(docs)
    dictionary = terms.build_dictionary(found)
    assert table(dictionary) == [(i, *x) for i, x in enumerate(seen.items())]
    ids = {t: i for i, t in enumerate(seen)}
    vectors = terms.sparse_vectors(found, dictionary)
    held = {(r["row_key"], v["term_id"]): v["count"] for r in vectors.collect() for v in r["vector"]}
    assert held == {(k, ids[t]): n for (k, t), n in counts.items()}
    frequencies = terms.term_frequencies(docs, ["b"])
    for frame in (terms.first_seen(found), vectors, frequencies, terms.grow_dictionary(dictionary, found)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
    rows = sorted((r["row_key"], r["term_id"], r["term"], r["n"]) for r in frequencies.collect())
    expected = []
    for key in sorted(texts):
        own = dict.fromkeys(w.lower() for w in texts[key] if w.lower() != "b")
        forms = {t: next(w for w in texts[key] if w.lower() == t) for t in own}
        expected += [(key, i, forms[t], counts[key, t]) for i, t in enumerate(own)]
    assert rows == expected


def test_dictionary_life(spark, annotated, tmp_path):
    first = terms.build_dictionary(terms.document_terms(annotated.where("row_key = 'd1'")))
    assert table(first) == [(0, "the", "The"), (1, "new", "New"), (2, "york", "York"), (3, "times", "times"), (4, "ideas", "ideas")]
    grown = terms.grow_dictionary(first, terms.document_terms(annotated))
    assert table(grown.where("term_id > 4"), "term_id", "term") == [(5, "end"), (6, "x"), (7, "y")]
    fixed = spark.createDataFrame([(100, " Big  One")], "term_id int, term string")
    grown = terms.insert_fixed(grown, fixed)
    assert terms.next_id(grown) == 101
    with pytest.raises(PySparkException, match="id already exists: 100"):
        terms.insert_fixed(grown, fixed.withColumn("term", F.lit("other"))).collect()
    moved = terms.insert_fixed(grown, spark.createDataFrame([(200, "York"), (300, "york")], "term_id int, term string"))
    assert table(moved.where("term = 'york'"), "term_id") == [(300,)] and moved.count() == grown.count()
    words = spark.createDataFrame([("BIG one",), ("nothing",), ("york",)], "text string")
    assert table(terms.lookup_ids(words, grown)) == [("BIG one", 100), ("nothing", -1), ("york", 2)]
    other = spark.createDataFrame([(0, "times", "times"), (1, "abc", "abc")], "term_id long, term string, surface string")
    merged, mapping = terms.merge_dictionaries(first, other)
    assert table(mapping) == [(0, 3), (1, 5)] and merged.count() == 6
    store.write_dictionary(grown, str(tmp_path / "dict"))
    back = store.read_dictionary(spark, str(tmp_path / "dict"))
    assert table(back, "term_id", "term") == table(grown, "term_id", "term")


def below(plan, what):
    """The subtrees of a plan's lines that hold what."""
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if what in line:
            inner = next((k for k in range(i + 1, len(lines)) if depth(lines[k]) <= depth(line)), len(lines))
            yield "\n".join(lines[i:inner])


def test_stored_dictionary_stays_in_place(spark, annotated, tmp_path):
    spark.sql("drop table if exists words_by_term")
    start = terms.build_dictionary(terms.document_terms(annotated.where("row_key = 'd1'")))
    held = StoredDictionary.create(start, "words_by_term", 4, str(tmp_path / "d"))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "d").glob("*.parquet")}
    more = terms.document_terms(annotated)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = spark.createDataFrame([("THE",), ("nothing",), ("York",)] * 3, "text string")
        for frame in (held.unknown(written(terms.first_seen(more), "seen")), held.lookup(words)):
            assert "Bucketed: true" in plan_of(frame) and not any("Bucketed: true" in x for x in below(plan_of(frame), "Exchange hashpartitioning"))
        assert table(held.lookup(words).distinct()) == [("THE", 0), ("York", 2), ("nothing", -1)]
        held.grow(more)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert table(held.rows(), "term_id", "term") == table(terms.grow_dictionary(start, more), "term_id", "term")
    assert all(f.exists() and f.stat().st_mtime_ns == t for f, t in files.items())
    held.grow(more)
    assert held.rows().count() == 8
    other = spark.createDataFrame([(0, "times", "times"), (1, "abc", "abc"), (2, "ABC", "ABC")], "term_id long, term string, surface string")
    assert table(held.merge(other)) == [(0, 3), (1, 8), (2, 8)] and held.rows().count() == 9
    spark.sql("drop table words_by_term")


def test_matrix(annotated, tmp_path, spark):
    fields = F.create_map(*[F.lit(x) for f in terms.MATRIX_FIELDS for x in (f, f[:3])])
    docs = annotated.withColumn("meta", F.when(F.col("row_key") != "d1", fields).otherwise(F.col("meta")))
    matrix, dictionary = terms.document_term_matrix(docs, "NYT", "d1", "d2")
    store.write_matrix(matrix, str(tmp_path / "m"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "m")).collect()] == ["Pub\tPub\tPub\tOnl\t0:2\t1:1\t2:1\t"]
    assert dictionary.count() == 3


def test_feed_files(spark, tmp_path):
    (tmp_path / "one.xml").write_text(ATOM)
    (tmp_path / "two.xml").write_text(RSS)
    assert feeds.parsed_entries(feeds.read_feeds(spark, str(tmp_path))).count() == 3


def test_stop_list(spark, tmp_path):
    (tmp_path / "stops").write_text("The # article\n# all\n\nOF\n")
    stops = terms.read_stop_words(spark, str(tmp_path / "stops"))
    words = spark.createDataFrame([("the",), ("word",), ("a,b",), ("x-y",)], "term string")
    assert table(terms.without_stop_words(words, stops)) == [("word",), ("x-y",)]


def test_chain(annotated):
    out = annotate.chain(
        annotated, ("matches", {"set": "cap", "pattern": "[A-Z]"}), ("count", {"set": "cap", "field": "caps"}), ("drop", {"set": "cap"}), "title"
    )
    assert table(out, "row_key", F.col("meta")["caps"]) == [("d1", "3"), ("d2", "1"), ("d3", "0")]
    assert "cap" not in out.first()["annotations"]
    with pytest.raises(KeyError):
        annotate.run(annotated, "none")
    assert annotate.run(annotated, "title", families=["text"]).columns == ["row_key", "text"]
    same = annotate.add_field(annotated, "kept", F.lit(" ")).first()["meta"]
    assert same == {"kept": "x"}


def test_rows_that_a_step_fails_for(docs_of):
    docs = docs_of(("a", "NYT", "12.50"), ("b", "NYT", "x y"), ("c", "AP", " "), ("d", "AP", None), ("e", "AP", "2024-02-30"), ("f", "AP", "7\nmore"), ("g", "AP", "2024-02-03"))
    jobs = ("title", ("copy", {"source": "text:title", "target": "t"}), ("number", {"source": "t", "target": "n"}), ("date", {"source": "text:title", "target": "day"}))
    results, rejects, counted = annotate.tried_chain(docs, *jobs)
    assert table(rejects) == [
        ("a", "4 date", "no date in text:title: 12.50"), ("b", "3 number", "no number in t: x y"), ("e", "3 number", "no number in t: 2024-02-30"),
        ("f", "4 date", "no date in text:title: 7"), ("g", "3 number", "no number in t: 2024-02-03"),
    ]
    assert table(results, "row_key") == [("c",), ("d",)] and results.columns == docs.columns
    found = counts(counted)
    assert found[("rows", "started")] == 7 and found[("rows", "completed")] == 2 and found[("added", "1 title")] == 0
    assert found[("row process error", "3 number")] == 3 and found[("row process error", "4 date")] == 2
    # The date alone: an impossible day is a reject, not an error of the job.
    dates, failed, _ = annotate.tried_chain(docs, ("date", {"source": "text:raw", "target": "day"}), max_chars=9)
    assert table(failed, "row_key", "step") == [("a", "1 date"), ("b", "1 date"), ("d", "guard"), ("e", "guard"), ("f", "1 date"), ("g", "guard")]
    assert table(dates, "row_key") == [("c",)]
    good = annotate.tried_chain(docs.where("row_key = 'g'"), jobs[0], jobs[3])[0].first()
    assert good["meta"]["day"] == "2024-02-03"


def test_parse_types(annotated):
    both = annotated.where("row_key != 'd3'").withColumn(
        "annotations", F.map_concat("annotations", F.create_map(F.lit("parse"), F.col("annotations")["ne"]))
    )
    found = counts(profile.parse_types(both))
    assert found == {
        ("printNPs", "seen row"): 2, ("printNPs", "skipped -- not parsed"): 1,
        ("printNPs", "skipped deps -- not parsed"): 1, ("type", "LOC"): 1,
    }
    assert table(profile.annotation_values(annotated, "ne")) == [("New York", 1)]


# -- streams -----------------------------------------------------------------------


def test_feed_stream_is_idempotent(spark, tmp_path):
    landed, store_path = tmp_path / "landed", str(tmp_path / "store")
    landed.mkdir()

    def run():
        stream = intake.landed_feeds(spark, str(landed))
        intake.start_intake(stream, lambda b: intake.feed_cells(b, "s"), store_path, str(tmp_path / "progress")).awaitTermination()
        return intake.stored_cells(spark, store_path)

    (landed / "one.xml").write_text(ATOM)
    assert run().select("row_key").distinct().count() == 5
    (landed / "two.xml").write_text(ATOM)
    (landed / "three.xml").write_text(RSS)
    again = run()
    assert again.select("row_key").distinct().count() == 7
    assert again.count() == again.select("row_key", "family", "qualifier").distinct().count()


def test_late_and_repeated_feeds(spark, tmp_path):
    """A feed seen before the newest is stored as well, each row at its own time."""
    early, late = dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 3, 1, 12)
    other = ATOM.replace("<title>E</title>", "<title>E later</title>")
    batch = spark.createDataFrame([("a", RSS, late), ("b", ATOM, early), ("c", ATOM, late), ("d", other, early)], "url string, xml string, seen_at timestamp")
    cells = intake.feed_cells(batch, "s")
    times = {(r["row_key"], r["ts"]) for r in cells.collect()}
    assert {t for _, t in times} == {early, late}
    stored = newest(cells.withColumn("batch", F.lit(0)), tie="batch")
    titles = set(table(stored.where("qualifier = 'title'"), "value", "ts"))
    assert titles == {("E", late), ("E later", early), ("S", late), ("T", late)}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_newest_compares_numbers(spark, cells_of, tmp_path):
    r = random.Random(8)
    rows = [(str(r.randrange(30)), f"m:{r.choice('ab')}", f"v{r.randrange(6)}", r.randrange(1, 5), r.randrange(3)) for _ in range(400)]
    rows += [("x", "m:a", "only", 1, 0), ("y", "m:a", "same", 2, 1), ("y", "m:a", "same", 2, 1)]
    held = [(*x, b) for x, b in zip([tuple(f) for f in cells_of(*[x[:4] for x in rows]).collect()], [x[4] for x in rows])]
    held += [(None, "m", None, None, "a", 0), ("z", "m", None, None, "b", 0), ("z", "m", None, None, "a", 0)]
    schema = "row_key string, family string, qualifier string, ts timestamp, value string, batch long"
    spark.createDataFrame(held, schema).write.parquet(str(tmp_path / "h"))
    best = {}
    for key, family, qualifier, ts, value, batch in held:
        rank = (ts or dt.datetime(1900, 1, 1), batch, value)
        best[key, family, qualifier] = max(best.get((key, family, qualifier), rank), rank)
    history = spark.read.parquet(str(tmp_path / "h"))
    found = newest(history, tie="batch")
    assert {tuple(x)[:3]: x["value"] for x in found.collect()} == {k: v[2] for k, v in best.items()} and found.count() == len(best)
    # Without ties, text is in no sort, no aggregate and no exchange.
    history.dropDuplicates(["row_key", "family", "qualifier", "ts"]).write.parquet(str(tmp_path / "d"))
    clear = newest(spark.read.parquet(str(tmp_path / "d")))
    plan = plan_of(clear)
    assert "SortAggregate" not in plan and "Sort [" not in plan and "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_compacted_store(spark, cells_of, tmp_path):
    store = intake.cell_store(spark, str(tmp_path / "s"))
    assert store.state().count() == 0 and store.write_snapshot() is None
    store.put(cells_of(("1", "m:a", "old", 2), ("2", "m:a", "x", 2)), 0)
    store.put(cells_of(("1", "m:a", "new", 2)), 1)
    expected = [("1", "new"), ("2", "x")]
    read = lambda: table(store.state(), "row_key", "value")
    assert read() == expected
    # A crash between write and swap: the snapshot is not valid, and is written again.
    assert store.write_snapshot() == 1 and store.snapshot() is None and read() == expected
    store.compact()
    assert store.snapshot() == 1 and read() == expected
    assert {p.split("/")[-2] for p in store.rows().inputFiles()} == {"snapshot=1"}
    # A batch that the snapshot holds is run again; a later one wins at the same time, an older cell does not.
    store.put(cells_of(("1", "m:a", "new", 2)), 1)
    store.put(cells_of(("1", "m:a", "newest", 2), ("2", "m:a", "older", 1), ("3", "m:a", "y", 1)), 2)
    expected = [("1", "newest"), ("2", "x"), ("3", "y")]
    assert read() == expected
    assert {p.split("/")[-2] for p in store.rows().inputFiles()} == {"snapshot=1", "batch=2"}
    store.compact()
    store.compact()
    store.clear()
    assert read() == expected and store.batches() == [] and store.numbers("", r"snapshot=(\d+)") == [2]


def test_counts(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [("1", "a"), ("1", "a"), ("2", "b")]
    frame = spark.createDataFrame(rows, "row_key string, source string")
    frame.coalesce(1).write.parquet(path)
    stream = intake.table_stream(spark, path, "*.parquet", frame.schema)
    for _ in range(2):
        intake.start_counts(stream, "source", str(tmp_path / "c"), str(tmp_path / "p2"), compact_every=2).awaitTermination()
        assert table(intake.latest_counts(spark, str(tmp_path / "c"))) == [("a", 2), ("b", 1)]
        frame.limit(1).coalesce(1).write.mode("append").parquet(path) if _ else None


def test_private_characters_stay(docs_of, spark):
    text = "a\ue001b \ue002c\ue003 \ue0044 &#xE001; &lt;"
    row = newsxml.articles(docs_of(("1", "NYT", NEWS.replace("<p>Four</p>", f"<p>{text}</p>")), column="orig")).first()
    assert row["Body"].endswith("\na\ue001b \ue002c\ue003 \ue0044 \ue001 <")
    marked = spark.createDataFrame([("x\ue000y \ue000",)], "t string")
    spans = marked.select(match_spans(F.col("t"), r"\S+", "w").alias("s")).first()["s"]
    assert [(s["start"], s["end"]) for s in spans] == [(0, 3), (4, 5)]


def test_spans_of_long_texts(spark):
    frame = spark.createDataFrame([(None,), ("",), ("aa",), ("a" + "x a" * 20_000,)], "t string")
    found = [r["s"] for r in frame.select(match_spans(F.col("t"), "a+", "w").alias("s")).collect()]
    assert [len(s) for s in found] == [0, 0, 1, 20_001] and found[2][0]["end"] == 2
    assert (found[3][-1]["start"], found[3][-1]["end"], found[3][-1]["id"]) == (60_000, 60_001, 20_000)


def test_docs_become_cells(docs_of):
    cells = docs_to_cells(docs_of(("1", " ", "x")))
    assert table(cells, "family", "qualifier") == [("meta", "kept"), ("text", "raw")]
