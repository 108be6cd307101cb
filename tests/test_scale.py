"""Tasks, broadcasts and words of queries that grow with their input."""

from pyspark.sql import functions as F

from foliant.functions import markup, spans, text
from foliant.operators import rows, terms, upsert
from foliant.plans import intake, news, tables
from foliant.sources import files
from foliant.streaming import intake as stream
from tests.conftest import table


def test_spread_deals_more_tasks_to_more_text(spark):
    cores = spark.sparkContext.defaultParallelism
    long = spark.range(10 * cores).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
    dealt = tables.spread(long, "doc_id")
    assert dealt.rdd.getNumPartitions() > cores
    assert dealt.select("doc_id").distinct().count() == 10 * cores
    nested = long.select(F.col("doc_id").alias("row_key"), F.struct(F.col("text").alias("raw")).alias("text"))
    assert tables.spread(nested, "row_key", "text.raw").rdd.getNumPartitions() > cores
    short = spark.createDataFrame([(1, "a"), (2, None), (None, "b")], "doc_id long, text string")
    for few in (short, short.limit(0)):
        dealt = tables.spread(few, "doc_id")
        assert dealt.rdd.getNumPartitions() == cores and table(dealt) == table(few)


def test_frequent_keys_stay_where_they_are(spark, monkeypatch):
    held = {}

    def written(df, name):
        held[name] = kept(df, name)
        return held[name]

    kept = rows.written
    monkeypatch.setattr(rows, "written", written)
    # 200 keys of one row in 400 each, fewer than a quarter of a task's share, and 10,000 keys of one row.
    left = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") / 2 % 200).otherwise(F.col("id") + 1000).cast("bigint").alias("k"), "id"
    )
    left = left.unionByName(spark.createDataFrame([(None, -1), (None, -2)], "k long, id long"))
    monkeypatch.setattr(rows, "HOT_KEYS", 1000)
    right = spark.range(0, 15000, 3).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        found = rows.join_hot(left, right, "k", how).select(*plain.columns)
        assert held["hot"].count() == 200
        assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0


def test_vectors_meet_in_more_tasks_for_more_rows(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(terms, "TASK_ROWS", 2)
    found = [(f"d{i}", 0, w, s, 1) for i in range(10) for w, s in (("a", "a"), ("a", "A"), (f"w{i}", f"w{i}"))]
    made = spark.createDataFrame(found, "row_key string, first int, term string, surface string, n long")
    known = spark.createDataFrame([(0, "a")] + [(i + 1, f"w{i}") for i in range(10)], "term_id long, term string")
    vectors = terms.sparse_vectors(made, known)
    assert vectors.rdd.getNumPartitions() > cores
    lines = vectors.select("row_key", terms.vector_text(F.col("vector")).alias("line"))
    assert table(lines) == [(f"d{i}", f"0:2\t{i + 1}:1") for i in range(10)]


def test_words_are_cleaned_and_cut_as_before(spark):
    words = [None, "", "word", " ", "a b", "a b", "\u0001x\u001f", "x\t\n y", " x", "x\n", "été", "\U0001f600\u000b\U0001f600"]
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    plain = text.trimmed(text.collapsed(F.col("w")))
    assert [r[0] for r in frame.select(text.clean_text(F.col("w"))).collect()] == [r[0] for r in frame.select(plain).collect()]
    content = "\U0001f600éab" * 200
    places = [(s, e) for s in (0, 1, 62, 63, 64, 65, 127, 128, 700) for e in (s, s + 1, s + 63, s + 64, s + 65, s + 200)]
    made = F.array(*[spans.annotation(F.lit(0), F.lit(s), F.lit(e), F.lit("x")) for s, e in places])
    got = spark.range(1).select(spans.span_texts(F.lit(content), made)).first()[0]
    assert got == [content[s:e] for s, e in places]


def test_span_json_is_what_the_writer_gives(spark):
    words = [None, "", "word", 'a"b', "a\\b", "a\nb", "\u0000", "\u001f", "\u007f", "é\u2028", "</x>", "\U0001f600"]
    rows_ = [(w, s, e) for w in words for s, e in ((0, 5), (None, 5), (3, None))]
    frame = spark.createDataFrame(rows_, "v string, s int, e int")
    plain = F.to_json(F.struct(F.col("v").alias("value"), F.col("s").alias("start"), F.col("e").alias("end")))
    made = spans.span_json(F.col("v"), F.col("s"), F.col("e"))
    assert all(r[0] == r[1] for r in frame.select(made, plain).collect())
    wide = frame.select(F.col("v"), F.col("s").cast("bigint"), F.col("e").cast("bigint"))
    assert all(r[0] == r[1] for r in wide.select(made, plain).collect())


def test_feeds_land_by_more_tasks_for_more_text(spark, tmp_path, monkeypatch):
    frames = type(spark.range(1))
    dealt, kept = [], frames.repartition

    def repartition(df, n, *keys):
        dealt.append(n)
        return kept(df, n, *keys)

    monkeypatch.setattr(frames, "repartition", repartition)
    monkeypatch.setattr(tables, "TASK_BYTES", 512)
    frame = spark.createDataFrame([(i, "en", f"s{i % 3}", "x" * 100) for i in range(60)], "doc_id long, lang string, source string, text string")
    intake.land(frame, str(tmp_path / "landed"))
    assert dealt[0] == -(-60 * (100 + tables.ROW_BYTES) // 512)
    found = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "landed"), wholetext=True)
    assert sorted(r[0].count("<entry>") for r in found.collect()) == [20, 20, 20]


def test_trees_of_many_small_files_are_read_as_bytes_by_few_tasks(spark, tmp_path, monkeypatch):
    texts = {f"f{i % 3}/{i}.txt": f"text {i}\r\n" for i in range(200)} | {"bom.txt": "\ufeff\u00e9\u0000\U0001f600"}
    for name, content in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content.encode())
        (tmp_path / f"{name}.note").write_text("no")
    (tmp_path / "odd.txt").write_bytes(b"\xff\xfe a \xc3")
    whole = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(str(tmp_path), wholetext=True)
    assert whole.rdd.getNumPartitions() > 2
    found = files.read_text_tree(spark, str(tmp_path), "s", tasks=2)
    assert found.rdd.getNumPartitions() == 2
    # The text reader copies the Hadoop configuration for every file.
    assert "binaryFile" in found._jdf.queryExecution().executedPlan().toString()
    held = found.select(F.col("text.orig").cast("binary").alias("value"))
    assert table(held) == table(whole.select(F.col("value").cast("binary").alias("value")))
    assert dict(table(found.where(~F.contains("row_key", F.lit("odd"))), "row_key", "text.orig")) == texts


def test_packed_files_of_a_tree_are_unpacked(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",)], "v string").coalesce(1).write.text(str(tmp_path / "z"), compression="gzip")
    for glob in ("*.gz", "*.txt.gz", "*", "*.txt*"):
        assert table(files.read_text_tree(spark, str(tmp_path / "z"), "s", glob), "text.orig") == [("a\nb\n",)]


def test_markup_is_searched_before_it_is_rewritten(spark):
    """Same results as the plain chains of replacements, each of which was run on every text."""
    less, opened, shut, kept = markup.LESS, markup.OPEN, markup.SHUT, markup.KEPT
    texts = [
        None, "", " ", "a", " a\n", "\u0000a\u001f", "\u00a0a\u00a0", f"a{less}b {kept}1{kept}4", f"{kept}4{kept}1", "<b> x </b> <i/>y ", "<b></b>", "a<",
        f"{opened} class='x' type=\"y &amp; {less}\"{shut}On <em>en</em> line ", f"{opened}{shut} a", f"{opened} class='a\"b'{shut}", f"{opened} Xclass='n'{shut}z",
        "&#57345;", "&#x0E001;", "&#X000e004; x", "&#57349;", f"{opened}&#1;", "\U0001f600 <p> \u00e9 </p>", "a & b < c > \"d\"\n\n&lt;", "\n",
        "<!DOCTYPE a [ <!ENTITY b 'c'> ]><hl2 class='a/>b' /> <hl2  a=\"1\" b = '2' >&#60;&#x3c;&#X03C;</hl2><object.title/><objectXtitle/><hl2x/>",
        f"{less}{opened}{shut}{kept} \ue000 \ue03f &#x00E002;&#57347;&#X0e004; <hl2/>",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")

    def plain(c):
        out = F.translate(c, less, "<")
        for i, own in enumerate(markup.OWN, 1):
            out = F.replace(out, F.lit(f"{kept}{i}"), F.lit(own))
        return out

    def all_text(c):
        bare = F.regexp_replace(c, f"{opened}[^{shut}]*{shut}", "")
        nodes = F.filter(F.split(bare, "<[^>]*>"), lambda n: n != "")
        return plain(text.trimmed(F.array_join(F.transform(nodes, text.trimmed), " ")))

    def attribute(c, name):
        inside = F.regexp_extract(c, f"^{opened}([^{shut}]*){shut}", 1)
        pattern = rf"""\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
        value = F.concat(F.regexp_extract(inside, pattern, 1), F.regexp_extract(inside, pattern, 2))
        return F.when(F.rlike(inside, F.lit(pattern)), plain(value))

    def escaped(c):
        for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            c = F.replace(c, F.lit(old), F.lit(new))
        return c

    def protected(c, names="hl2|object\\.title"):
        out = F.regexp_replace(markup.guarded(c), r"(?s)<!DOCTYPE[^>\[]*(\[.*?\]\s*)?>", "")
        out = F.regexp_replace(out, "&lt;|&#0*60;|&#[xX]0*3[cC];", less)
        out = F.regexp_replace(out, f"<({names}){markup.ATTRIBUTES}>", f"<$1>{opened}$2{shut}")
        return F.regexp_replace(out, f"<({names}){markup.ATTRIBUTES}/>", f"<$1>{opened}$2{shut}</$1>")

    pairs = [
        (markup.protected(t, ("hl2", "object.title")), protected(t)), (markup.plain(t), plain(t)), (markup.all_text(t), all_text(t)), (news.escaped(t), escaped(t)),
        (markup.attribute(t, "class"), attribute(t, "class")), (markup.attribute(t, "type"), attribute(t, "type")),
    ]
    for new, old in pairs:
        assert [r[0] for r in frame.select(new).collect()] == [r[0] for r in frame.select(old).collect()]
    guards = [("\ue001", f"{kept}1"), ("&#57346; &#xE003;", f"{kept}2 {kept}3"), ("\ue004\ue000", f"{kept}4\ue000"), ("&#x0E004;", f"{kept}4"), ("&#57345", "&#57345")]
    found = spark.createDataFrame(guards, "a string, b string").select(markup.guarded(F.col("a")), "b").collect()
    assert all(r[0] == r[1] for r in found)
    # A text without the character is not rewritten, and a compound value is evaluated once.
    plan = frame.select(markup.plain(F.concat(t, t)))._jdf.queryExecution().optimizedPlan().toString()
    assert "contains" in plan.lower() and plan.count("concat(t#") == 1


def test_superseded_cells_are_found_in_place(spark, tmp_path, monkeypatch):
    key = (F.col("id") % 20_000).cast("string").alias("row_key")
    # Two batches with ties in and between them, files of more rows than a bitmap has, rows without a key or a time.
    ts = F.when(F.col("id") % 97 > 0, F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(5))))
    value = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9)).cast("string").alias("value")
    made = spark.range(0, 90_000, 1, 2).select(F.when(F.col("id") % 19_999 > 0, key).alias("row_key"), F.lit("m").alias("family"), (F.col("id") % 2).cast("string").alias("qualifier"), ts.alias("ts"), value)
    store = stream.cell_store(spark, str(tmp_path / "s"))
    store.put(made.where("ts is null or second(ts) < 4"), 0)
    store.put(made.where("ts is null or second(ts) > 1"), 1)
    expected = sorted(upsert.newest(store.rows(), tie="batch").collect(), key=str)
    assert len(expected) > 20_000
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        # However long the list, values are in no exchange but where versions tie.
        assert sorted(store.state().collect(), key=str) == expected
        store.put(made.where("id < 100").withColumn("ts", F.timestamp_seconds(F.lit(9))), 2)
        plan = store.state()._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        expected = sorted(upsert.newest(store.rows(), tie="batch").collect(), key=str)
        monkeypatch.setattr(upsert, "BITMAP_BYTES", 0)
        assert sorted(store.state().collect(), key=str) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    store.compact()
    store.clear()
    assert sorted(store.state().collect(), key=str) == expected


def test_feed_intake_keeps_little_on_disk(spark, tmp_path, monkeypatch):
    text = "A harbour & its <lights>, one by one.\n" * 50
    rows = [(i, "en" if i % 2 else "de", f"s{i % 3}", f"{i % 50}: {text}") for i in range(300)]
    (tmp_path / "in").mkdir()
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(str(tmp_path / "in" / "documents.parquet"))
    paths = {}
    monkeypatch.setattr(intake, "fresh_path", lambda _, name: paths.setdefault(name, str(tmp_path / name)))
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    shuffles = lambda: {x for x in held().split("\n") if "/shuffle_" in x and "checksum" not in x}
    before = shuffles()
    found = intake.feed_intake(spark, str(tmp_path / "in"))
    assert not shuffles() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    landed = [p for p in (tmp_path / "landed").rglob("*") if p.is_file() and not p.name.startswith((".", "_"))]
    assert sum(p.stat().st_size for p in landed) < sum(len(r[3]) for r in rows)
    # What a snapshot holds is not there in batches as well.
    assert {p.name for p in (tmp_path / "intake").iterdir() if "=" in p.name} == {"snapshot=1"}
    # An entry per document, a body per text.
    assert found.count() == 300 + 50


def test_trees_of_many_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    root = tmp_path / "a tree"
    names = ["a.txt", "b/c.txt", "b/.h.txt", "_x/d.txt", "_x=1/e.txt", ".h/f.txt", "_metadata/g.txt", "_metadata.txt", "b/_y.txt", "b/_y=.txt", "k._COPYING_/l.txt"]
    names += ["c++ 100%.txt", "b/a%20b é.txt", "b/[x]{1}.txt", "deep/1/2/3/q.txt", "empty.txt", "n.txt.note", "TXT.TXT"] + [f"many/{i}.txt" for i in range(40)]
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"" if name == "empty.txt" else name.encode() + b"\xff\r\n\x00x")
    (root / "gone.txt").symlink_to(root / "nowhere")
    monkeypatch.setattr(files, "NAMES", 7)
    monkeypatch.setattr(files, "PORTION_FILES", 3)

    def read(at, glob, most):
        monkeypatch.setattr(files, "LISTED", most)
        found = files.read_text_tree(spark, at, "s", glob, tasks=3)
        assert found.rdd.getNumPartitions() <= 3
        assert ("binaryFile" in found._jdf.queryExecution().executedPlan().toString()) == (most > 1000)
        return table(found.select("row_key", "src.id", "meta", F.hex(F.col("text.orig").cast("binary"))))

    for at, glob in ((str(root), "*.txt"), (f"file://{root}/", "{a,c}.txt"), (str(root), "[0-3]*.txt")):
        assert read(at, glob, 0) == read(at, glob, 10_000)
    assert len(read(str(root), "*.txt", 0)) == 49
    # A single file and a pattern are for Spark to read.
    assert [r[0] for r in table(files.read_text_tree(spark, str(root / "b" / "c.txt"), "s"), "text.orig")]
    assert files.read_text_tree(spark, f"{root}/b*", "s").count() == 4
