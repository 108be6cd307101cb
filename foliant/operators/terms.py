"""Term dictionaries, sparse vectors, term frequencies.

A dictionary is a table (term_id long, term string, surface string): term is
the folded form that is looked up, surface the form first seen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliant.functions.spans import annotation_set, outside, span_texts
from foliant.functions.text import clean_text, normalized, trimmed
from foliant.operators.rows import join_hot, with_index
from foliant.session import written

WORD = r"^[\w-]+$"
DICTIONARY_COLUMNS = ("term_id", "term", "surface")
#: Of a place: so many bits for the position in a document, the others for the document.
POSITION_BITS = 26
#: Rows of terms that a task gathers into vectors, about.
TASK_ROWS = 1 << 20


def token_texts(docs: DataFrame, set: str = "token") -> Column:
    return span_texts(F.col("text.raw"), annotation_set(set))


def document_terms(docs: DataFrame, set: str = "token", preserve_case: bool = False) -> DataFrame:
    """(row_key, first, term, surface, n) per distinct token text of a document, written.

    Case is folded to tell terms apart unless it is to be kept; a term has one
    row per surface, with the first place of that surface in the document.
    """
    return _document_terms(docs.select("row_key", token_texts(docs, set).alias("words")), preserve_case)


def _document_terms(words: DataFrame, preserve_case: bool = False) -> DataFrame:
    """Words (row_key, words) counted by a hash aggregate of numbers, combined before the shuffle."""
    tokens = words.select("row_key", F.posexplode("words").alias("at", "word"))
    tokens = tokens.select("row_key", "at", clean_text(F.col("word")).alias("surface"))
    counts = tokens.groupBy("row_key", "surface").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    term = F.col("surface") if preserve_case else F.lower("surface")
    return written(counts.select("row_key", "first", term.alias("term"), "surface", "n"), "terms")


def term_counts(docs: DataFrame, set: str = "token") -> DataFrame:
    """(term, n) over all documents: a hash aggregate of the tokens, combined before the shuffle."""
    words = docs.select(F.explode(token_texts(docs, set)).alias("word"))
    return words.select(F.lower(clean_text(F.col("word"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def _numbered(terms: DataFrame, first_id: Column | int) -> DataFrame:
    """Ids in order of first occurrence."""
    ordered = with_index(terms, ["place"], "idx")
    return ordered.select((F.col("idx") + first_id).cast("bigint").alias("term_id"), "term", "surface")


def first_seen(terms: DataFrame) -> DataFrame:
    """(term, place, surface): one row per term, with the place and form where it is first seen.

    A place is one number: the rank of the document's key, then the position in
    the document. So the earliest place of a surface, and of a term, is a hash
    aggregate of numbers; the form is that of the surface at the term's place, which
    is looked up among distinct surfaces alone.
    """
    keys = written(with_index(terms.select("row_key").distinct(), ["row_key"], "doc").select("row_key", "doc"), "keys")
    far = F.raise_error(F.lit(f"a document of more than {1 << POSITION_BITS} tokens")).cast("bigint")
    position = F.when(F.col("first") < (1 << POSITION_BITS), F.col("first")).otherwise(far)
    place = F.shiftleft("doc", POSITION_BITS).bitwiseOR(position)
    placed = terms.join(keys, "row_key").select("term", "surface", place.alias("place"))
    surfaces = written(placed.groupBy("term", "surface").agg(F.min("place").alias("place")), "surfaces")
    firsts = surfaces.groupBy("term").agg(F.min("place").alias("place"))
    return firsts.join(surfaces.select("place", "surface"), "place").select("term", "place", "surface")


def build_dictionary(terms: DataFrame) -> DataFrame:
    """V1: ids 0, 1, 2, ... in first-seen order over (row_key, position).

    terms: a table as ``document_terms`` writes it; it is read twice.
    """
    return written(_numbered(first_seen(terms), 0), "dictionary")


def next_id(dictionary: DataFrame) -> int:
    """Highest id in use plus one; one number comes to the driver."""
    return dictionary.agg(F.coalesce(F.max("term_id") + 1, F.lit(0))).first()[0]


def grow_dictionary(dictionary: DataFrame, terms: DataFrame) -> DataFrame:
    """V4: known terms keep their ids, new ones follow the highest id."""
    new = first_seen(terms).join(dictionary.select("term"), "term", "left_anti")
    return dictionary.select(*DICTIONARY_COLUMNS).unionByName(_numbered(new, next_id(dictionary)))


def merge_dictionaries(into: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V6: into with all terms of other, and the map (old_id, new_id).

    Terms new to into are added in term order.
    """
    folded = other.select(
        F.col("term_id").alias("old_id"), normalized(F.col("term")).alias("term"), clean_text(F.col("term")).alias("surface")
    )
    new = folded.select("term", "surface").join(into.select("term"), "term", "left_anti")
    new = new.groupBy("term").agg(F.min("surface").alias("surface"))
    ids = with_index(new, ["term"]).select(
        (F.col("idx") + next_id(into)).cast("bigint").alias("term_id"), "term", "surface"
    )
    merged = written(into.select(*DICTIONARY_COLUMNS).unionByName(ids), "merged")
    mapping = folded.join(merged.select("term", F.col("term_id").alias("new_id")), "term").select("old_id", "new_id")
    return merged, mapping


def insert_fixed(dictionary: DataFrame, rows: DataFrame) -> DataFrame:
    """V7: terms with given ids. An id in use is an error; a known term moves to
    the id given, so that a text has one id. Of several ids given to one term the
    highest holds.

    The test runs with the insert: the failing row stops the job that writes it.
    """
    given = rows.select(
        F.col("term_id").cast("bigint").alias("term_id"),
        normalized(F.col("term")).alias("term"),
        clean_text(F.col("term")).alias("surface"),
    ).distinct()
    ids = given.groupBy("term_id").agg(F.countDistinct("term").alias("terms"))
    used = dictionary.select("term_id", F.lit(True).alias("used"))
    taken = F.coalesce("used", F.lit(False)) | (F.col("terms") > 1)
    clash = F.raise_error(F.concat(F.lit("id already exists: "), F.col("term_id").cast("string"))).cast("bigint")
    checked = given.join(ids, "term_id").join(used, "term_id", "left").withColumn("term_id", F.when(taken, clash).otherwise(F.col("term_id")))
    new = checked.groupBy("term").agg(F.max("term_id").alias("term_id"), F.min("surface").alias("surface"))
    kept = dictionary.join(new.select("term"), "term", "left_anti")
    return kept.select(*DICTIONARY_COLUMNS).unionByName(new.select(*DICTIONARY_COLUMNS))


def lookup_ids(texts: DataFrame, dictionary: DataFrame, column: str = "text") -> DataFrame:
    """V5: the id of each text, -1 if unknown. The texts may repeat a term often."""
    keyed = texts.withColumn("term", normalized(F.col(column)))
    found = join_hot(keyed, dictionary.select("term", "term_id"), "term", "left")
    return found.select(*texts.columns, F.coalesce("term_id", F.lit(-1)).alias("term_id"))


def lookup_terms(ids: DataFrame, dictionary: DataFrame) -> DataFrame:
    """V5: the text of each id, null if unknown."""
    return join_hot(ids, dictionary.select("term_id", "term"), "term_id", "left")


def dictionary_size(dictionary: DataFrame) -> DataFrame:
    """V5."""
    return dictionary.agg(F.count("*").alias("n"))


def sorted_dictionary(dictionary: DataFrame) -> DataFrame:
    """V8: a total order, range-partitioned."""
    return dictionary.orderBy("term")


def term_ids(terms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(row_key, term_id, n) of document terms, a row per surface; common terms stay where they are."""
    found = join_hot(terms.select("row_key", "term", "n"), dictionary.select("term", "term_id"), "term", is_written=True)
    return found.select("row_key", "term_id", "n")


def sparse_vectors(terms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """V2: (row_key, vector array<struct<term_id,count>>), ids ascending.

    A vector holds the distinct terms of one document, as the row itself does. The
    rows of a document meet once: adding up the surfaces of a term and gathering
    the terms need no further exchange. The number of tasks they meet in grows with
    the rows. terms: a table as ``document_terms`` writes it, so that counting reads no row.
    """
    tasks = max(terms.sparkSession.sparkContext.defaultParallelism, -(-terms.count() // TASK_ROWS))
    rows = term_ids(terms, dictionary).repartition(tasks, "row_key")
    counts = rows.groupBy("row_key", "term_id").agg(F.sum("n").alias("count"))
    return counts.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("term_id", "count"))).alias("vector"))


def vector_text(vector: Column) -> Column:
    """``id:count`` pairs, tab-joined."""
    pair = lambda v: F.concat_ws(":", v["term_id"].cast("string"), v["count"].cast("string"))
    return F.array_join(F.transform(vector, pair), "\t")


# Metadata columns of a matrix line, in line order.
MATRIX_FIELDS = ("PublicationYear", "PublicationMonth", "PublicationDayOfMonth", "OnlineSection")


def matrix_docs(docs: DataFrame, source: str, start: str | None, end: str | None) -> DataFrame:
    """Documents of a matrix: one source, keys from start up to and including
    end, with all four metadata fields, text and tokens."""
    chosen = docs.where(F.col("src.name") == source)
    if start is not None:
        chosen = chosen.where(F.col("row_key") >= start)
    if end is not None:
        chosen = chosen.where(F.col("row_key") <= end)
    for field in MATRIX_FIELDS:
        chosen = chosen.where(F.col("meta")[field].isNotNull())
    return chosen.where(F.col("text.raw").isNotNull() & F.col("annotations")["token"].isNotNull())


def document_term_matrix(
    docs: DataFrame,
    source: str,
    start: str | None = None,
    end: str | None = None,
    dictionary: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """V3: (row_key, four fields, vector) per document, and the dictionary used."""
    fields = [F.col("meta")[f].alias(f) for f in MATRIX_FIELDS]
    chosen = matrix_docs(docs, source, start, end)
    # Read once: the fields and the tokens are then columns of one small table.
    chosen = written(chosen.select("row_key", *fields, token_texts(chosen).alias("words")), "chosen")
    terms = _document_terms(chosen.select("row_key", "words"))
    dictionary = build_dictionary(terms) if dictionary is None else written(grow_dictionary(dictionary, terms), "dictionary")
    fields = chosen.drop("words")
    none = F.array().cast("array<struct<term_id:bigint,count:bigint>>")
    lines = fields.join(sparse_vectors(terms, dictionary), "row_key", "left")
    return lines.withColumn("vector", F.coalesce("vector", none)), dictionary


def read_stop_words(spark, path: str) -> DataFrame:
    """A stop list from text lines, # comments and blank lines dropped."""
    return stop_list(spark.read.text(path))


def stop_list(lines: DataFrame, stem: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    word = trimmed(F.regexp_replace("value", "#.*$", ""))
    words = lines.select(F.lower(stem(word)).alias("word"))
    return words.where(F.col("word") != "").distinct()


def without_stop_words(
    terms: DataFrame, stops: DataFrame, column: str = "term", stem: Callable[[Column], Column] = lambda c: c
) -> DataFrame:
    """Drop stop words and whatever is not made of word characters.

    An anti-join, so the list may be of any size: a short one is broadcast by
    its measured size.
    """
    word = F.lower(stem(F.col(column)))
    kept = terms.where(F.rlike(stem(F.col(column)), F.lit(WORD)))
    return kept.join(stops, word == stops["word"], "left_anti")


def term_frequencies(
    docs: DataFrame,
    stop_words: DataFrame | Sequence[str] | None = None,
    stem: Callable[[Column], Column] = lambda c: c,
    tokens: str = "token",
    entities: str = "ne",
) -> DataFrame:
    """V9: per document (row_key, term_id, term, n) with a dictionary of its own.

    Every entity span is a term; a token is one if it lies in no entity and is
    no stop word. Ids count up by first appearance, entities first; term is the
    form first seen. stop_words is a list (None: no filter) or a table (word) of any
    size, as ``stop_list`` gives it; its folded form decides. Tokens under entities
    go before the words are exploded; what is left is counted by a hash
    aggregate, and a document's distinct forms meet for their ids.
    """
    text = F.col("text.raw")
    ne = annotation_set(entities)
    named = F.transform(span_texts(text, ne), lambda w: F.struct(w.alias("word"), F.lit(False).alias("free")))
    free = F.transform(span_texts(text, outside(annotation_set(tokens), ne)), lambda w: F.struct(w.alias("word"), F.lit(True).alias("free")))
    rows = docs.select("row_key", F.posexplode(F.concat(named, free)).alias("at", "w"))
    rows = rows.select("row_key", "at", clean_text(F.col("w.word")).alias("surface"), F.col("w.free").alias("free"))
    if stop_words is not None:
        stemmed = stem(F.col("surface"))
        rows = rows.where(~F.col("free") | F.rlike(stemmed, F.lit(WORD)))
        rows = rows.withColumn("surface", F.when(F.col("free"), stemmed).otherwise(F.col("surface")))
        # Entities have no key here, so that no stop word meets them.
        rows = rows.withColumn("word", F.when(F.col("free"), F.lower("surface"))).join(_stops(docs, stop_words), "word", "left_anti")
    counts = rows.groupBy("row_key", "surface").agg(F.min("at").alias("at"), F.count("*").alias("n"))
    of_term = W.partitionBy("row_key", F.lower("surface"))
    counts = counts.select("row_key", "at", "surface", F.min("at").over(of_term).alias("first"), F.sum("n").over(of_term).alias("n"))
    firsts = counts.where(F.col("at") == F.col("first"))
    id = F.row_number().over(W.partitionBy("row_key").orderBy("at")) - 1
    return firsts.select("row_key", id.cast("bigint").alias("term_id"), F.col("surface").alias("term"), "n")


def _stops(docs: DataFrame, stop_words: DataFrame | Sequence[str]) -> DataFrame:
    """A stop list as a table, written so that a short one is broadcast by its size."""
    if not isinstance(stop_words, DataFrame):
        folded = sorted({w.lower() for w in stop_words})
        stop_words = docs.sparkSession.createDataFrame([(w,) for w in folded], "word string")
    return written(stop_words.select("word"), "stops")
