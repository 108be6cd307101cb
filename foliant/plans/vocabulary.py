"""Queries V1-V10 and I12, I13."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foliant.operators import terms as V
from foliant.plans.registry import query
from foliant.plans.tables import DICTIONARY_SQL, TOKENS_SQL, TURN_TOKENS_SQL, conversation_docs, docs, table
from foliant.session import fresh_path, written
from foliant.sources import store
from foliant.sources.dictionary import StoredDictionary

D = f"WITH {DICTIONARY_SQL}\n"
PAIRS = "string_agg(CAST(term_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), chr(9) ORDER BY term_id)"


def corpus_terms(spark, folder):
    return V.document_terms(docs(spark, folder, "token"))


def corpus_dictionary(spark, folder):
    return V.build_dictionary(corpus_terms(spark, folder))


def turn_terms(spark, folder):
    return V.document_terms(conversation_docs(spark, folder))


@query("V1_dictionary", D + "SELECT term_id, term, surface FROM dictionary")
def dictionary(spark, folder):
    return corpus_dictionary(spark, folder)


@query(
    "V2_sparse_vectors",
    D + f""", c AS (SELECT t.row_key, d.term_id, count(*) AS n FROM tokens t JOIN dictionary d ON d.term = lower(t.tok)
  GROUP BY t.row_key, d.term_id)
SELECT row_key, {PAIRS} AS vector FROM c GROUP BY row_key""",
)
def sparse_vectors(spark, folder):
    terms = corpus_terms(spark, folder)
    vectors = V.sparse_vectors(terms, V.build_dictionary(terms))
    return vectors.select("row_key", V.vector_text(F.col("vector")).alias("vector"))


# The dictionary of a matrix holds the terms of its own documents.
_MATRIX = r"""WITH chosen AS (
  SELECT CAST(doc_id AS VARCHAR) AS row_key, text, lang, doc_id FROM documents
  WHERE source = 'src3' AND lang <> 'es'),
lists AS (SELECT row_key, regexp_extract_all(text, '[\p{L}\p{N}]+') AS l FROM chosen),
tokens AS (SELECT row_key, lower(unnest(l)) AS term, unnest(range(len(l))) AS pos FROM lists),
seen AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY row_key, pos) AS k FROM tokens),
dictionary AS (SELECT row_number() OVER (ORDER BY row_key, pos) - 1 AS term_id, term FROM seen WHERE k = 1),
c AS (SELECT t.row_key, d.term_id, count(*) AS n FROM tokens t JOIN dictionary d USING (term) GROUP BY 1, 2),
vectors AS (SELECT row_key, string_agg(CAST(term_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), chr(9) ORDER BY term_id) AS vector
  FROM c GROUP BY row_key)
"""


def matrix(spark, folder):
    return V.document_term_matrix(docs(spark, folder, "token"), "src3", "0", "~")[0]


@query(
    "V3_document_term_matrix",
    _MATRIX + """SELECT row_key, CAST(doc_id % 20 + 1987 AS VARCHAR) AS year, CAST(doc_id % 12 + 1 AS VARCHAR) AS month,
  CAST(doc_id % 28 + 1 AS VARCHAR) AS day, lang AS section, coalesce(vector, '') AS vector FROM chosen LEFT JOIN vectors USING (row_key)""",
)
def document_term_matrix(spark, folder):
    names = dict(zip(V.MATRIX_FIELDS, ("year", "month", "day", "section")))
    return matrix(spark, folder).select(
        "row_key", *[F.col(f).alias(n) for f, n in names.items()], V.vector_text(F.col("vector")).alias("vector")
    )


@query(
    "I12_matrix_lines",
    _MATRIX + """SELECT row_key, CAST(doc_id % 20 + 1987 AS VARCHAR) || chr(9) || CAST(doc_id % 12 + 1 AS VARCHAR) || chr(9)
  || CAST(doc_id % 28 + 1 AS VARCHAR) || chr(9) || lang || chr(9) || coalesce(vector, '') || chr(9) AS line
FROM chosen LEFT JOIN vectors USING (row_key)""",
)
def matrix_lines(spark, folder):
    return store.matrix_lines(matrix(spark, folder))


_GROWN = f"""WITH {DICTIONARY_SQL}, {TURN_TOKENS_SQL},
fresh AS (
  SELECT lower(tok) AS term, tok AS surface, row_key, pos, row_number() OVER (PARTITION BY lower(tok) ORDER BY row_key, pos) AS k
  FROM turn_tokens WHERE lower(tok) NOT IN (SELECT term FROM dictionary))
"""


@query(
    "V4_grow_dictionary",
    _GROWN + """SELECT term_id, term, surface FROM dictionary
UNION ALL SELECT (SELECT max(term_id) + 1 FROM dictionary) + row_number() OVER (ORDER BY row_key, pos) - 1, term, surface
FROM fresh WHERE k = 1""",
)
def grow_dictionary(spark, folder):
    return V.grow_dictionary(corpus_dictionary(spark, folder), turn_terms(spark, folder))


@query(
    "V5_lookup_ids",
    D.rstrip() + f""", {TURN_TOKENS_SQL}
SELECT t.row_key, t.tok AS text, coalesce(d.term_id, -1) AS term_id, count(*) AS n
FROM turn_tokens t LEFT JOIN dictionary d ON d.term = lower(t.tok) GROUP BY 1, 2, 3""",
)
def lookup_ids(spark, folder):
    turns = conversation_docs(spark, folder)
    words = turns.select("row_key", F.posexplode(V.token_texts(turns)).alias("pos", "text"))
    found = V.lookup_ids(words, corpus_dictionary(spark, folder))
    return found.groupBy("row_key", "text", "term_id").agg(F.count("*").alias("n"))


@query(
    "V5_lookup_terms",
    D + "SELECT CAST(e.event_id AS BIGINT) AS term_id, d.term FROM events e LEFT JOIN dictionary d ON d.term_id = e.event_id",
)
def lookup_terms(spark, folder):
    ids = table(spark, folder, "events").select(F.col("event_id").alias("term_id"))
    return V.lookup_terms(ids, corpus_dictionary(spark, folder))


@query("V5_dictionary_size", D + "SELECT count(*) AS n FROM dictionary")
def dictionary_size(spark, folder):
    return V.dictionary_size(corpus_dictionary(spark, folder))


_MERGE = f"""WITH {DICTIONARY_SQL}, {TURN_TOKENS_SQL},
other_seen AS (SELECT lower(tok) AS term, row_key, pos, row_number() OVER (PARTITION BY lower(tok) ORDER BY row_key, pos) AS k FROM turn_tokens),
other AS (SELECT row_number() OVER (ORDER BY row_key, pos) - 1 AS old_id, term FROM other_seen WHERE k = 1),
added AS (SELECT (SELECT max(term_id) + 1 FROM dictionary) + row_number() OVER (ORDER BY term) - 1 AS term_id, term
  FROM other WHERE term NOT IN (SELECT term FROM dictionary)),
merged AS (SELECT term_id, term FROM dictionary UNION ALL SELECT term_id, term FROM added)
"""


def merge(spark, folder):
    return V.merge_dictionaries(corpus_dictionary(spark, folder), V.build_dictionary(turn_terms(spark, folder)))


@query("V6_merge_mapping", _MERGE + "SELECT o.old_id, m.term_id AS new_id FROM other o JOIN merged m USING (term)")
def merge_mapping(spark, folder):
    return merge(spark, folder)[1]


@query("V6_merged_dictionary", _MERGE + "SELECT term_id, term FROM merged")
def merged_dictionary(spark, folder):
    return merge(spark, folder)[0].select("term_id", "term")


def stored_dictionary(spark, folder) -> StoredDictionary:
    """The dictionary of the documents as a table bucketed by term, in the run folder."""
    name = f"dictionary_{uuid.uuid4().hex}"
    return StoredDictionary.create(corpus_dictionary(spark, folder), name, 8, fresh_path(spark, name))


@query(
    "V4_grow_stored",
    _GROWN + """SELECT term_id, term, surface FROM dictionary
UNION ALL SELECT (SELECT max(term_id) + 1 FROM dictionary) + row_number() OVER (ORDER BY row_key, pos) - 1, term, surface
FROM fresh WHERE k = 1""",
)
def grow_stored(spark, folder):
    held = stored_dictionary(spark, folder)
    held.grow(turn_terms(spark, folder))
    return held.rows()


@query("V6_merge_stored", _MERGE + "SELECT o.old_id, m.term_id AS new_id FROM other o JOIN merged m USING (term)")
def merge_stored(spark, folder):
    return stored_dictionary(spark, folder).merge(V.build_dictionary(turn_terms(spark, folder)))


@query(
    "V7_insert_fixed",
    D + """SELECT term_id, term FROM dictionary
UNION ALL SELECT 1000000000 + item_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) FROM benchmark""",
)
def insert_fixed(spark, folder):
    rows = table(spark, folder, "benchmark").select(
        (F.col("item_id") + 1_000_000_000).alias("term_id"), F.col("text").alias("term")
    )
    return V.insert_fixed(corpus_dictionary(spark, folder), rows).select("term_id", "term")


@query(
    "V7_insert_known",
    D + "SELECT term AS text, 2000000000 + term_id AS term_id FROM dictionary",
)
def insert_known(spark, folder):
    """Every known term gets another id; looked up, it has that one alone."""
    held = corpus_dictionary(spark, folder)
    moved = written(V.insert_fixed(held, held.select((F.col("term_id") + 2_000_000_000).alias("term_id"), "term")), "moved")
    return V.lookup_ids(held.select(F.col("term").alias("text")), moved)


@query("V8_sorted_dictionary", D + "SELECT term_id, term FROM dictionary ORDER BY term")
def sorted_dictionary(spark, folder):
    return V.sorted_dictionary(corpus_dictionary(spark, folder)).select("term_id", "term")


@query("I13_dictionary_lines", D + "SELECT CAST(term_id AS VARCHAR) || ' ' || term AS line, term_id, term FROM dictionary")
def dictionary_lines(spark, folder):
    path = fresh_path(spark, "dictionary-files")
    store.write_dictionary(corpus_dictionary(spark, folder), path)
    return store.read_dictionary(spark, path).select(
        F.concat_ws(" ", "term_id", "term").alias("line"), "term_id", "term"
    )


# The stop list of the term-frequency query.
STOP_WORDS = ("the", "of", "and", "to", "in", "der", "die", "und", "le", "la", "les", "de", "el", "los", "que")

_SPANS = r"""WITH words AS (
  SELECT CAST(doc_id AS VARCHAR) AS row_key, unnest(list_zip(regexp_extract_all(text, '[\p{L}\p{N}]+'),
    regexp_split_to_array(text, '[\p{L}\p{N}]+')[1:len(regexp_extract_all(text, '[\p{L}\p{N}]+'))],
    range(len(regexp_extract_all(text, '[\p{L}\p{N}]+'))))) AS z FROM documents),
tok AS (
  SELECT row_key, z[1] AS w, z[3] AS i,
    sum(length(z[1]) + length(z[2])) OVER (PARTITION BY row_key ORDER BY z[3]) AS e FROM words),
names AS (
  SELECT CAST(doc_id AS VARCHAR) AS row_key, unnest(list_zip(regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*'),
    regexp_split_to_array(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*')[1:len(regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*'))],
    range(len(regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*'))))) AS z FROM documents),
ne AS (
  SELECT row_key, z[1] AS w, z[3] AS i,
    sum(length(z[1]) + length(z[2])) OVER (PARTITION BY row_key ORDER BY z[3]) AS e FROM names),
placed AS (SELECT row_key, w, i, e - length(w) AS s, e FROM tok),
cover AS (SELECT row_key, e - length(w) AS s, e FROM ne),
free AS (
  SELECT p.row_key, p.w, p.i FROM placed p ASOF LEFT JOIN cover c ON p.row_key = c.row_key AND p.s >= c.s
  WHERE c.e IS NULL OR c.e < p.e)
"""


@query(
    "V9_term_frequencies",
    _SPANS + f""", kept AS (
  SELECT row_key, w, 0 AS part, i FROM ne
  UNION ALL SELECT row_key, w, 1, i FROM free
  WHERE lower(w) NOT IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}) AND regexp_full_match(w, '[0-9A-Za-z_-]+')),
grouped AS (SELECT row_key, lower(w) AS term, count(*) AS n, min(part * 100000000 + i) AS place FROM kept GROUP BY 1, 2)
SELECT row_key, row_number() OVER (PARTITION BY row_key ORDER BY place) - 1 AS term_id, term, n FROM grouped""",
)
def term_frequencies(spark, folder):
    found = V.term_frequencies(docs(spark, folder, "token", "ne"), STOP_WORDS)
    return found.select("row_key", "term_id", F.lower("term").alias("term"), "n")


@query(
    "V9_term_frequencies_no_stop_words",
    _SPANS + """, kept AS (SELECT row_key, w FROM ne UNION ALL SELECT row_key, w FROM free)
SELECT row_key, lower(w) AS term, count(*) AS n FROM kept GROUP BY 1, 2""",
)
def term_frequencies_all(spark, folder):
    found = V.term_frequencies(docs(spark, folder, "token", "ne"))
    return found.select("row_key", F.lower("term").alias("term"), "n")


@query(
    "V10_stop_word_filter",
    f"WITH {TOKENS_SQL}" + r""",
stops AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[\p{L}\p{N}]+'))) AS word FROM benchmark)
SELECT lower(tok) AS term, count(*) AS n FROM tokens
WHERE lower(tok) NOT IN (SELECT word FROM stops) AND regexp_full_match(lower(tok), '[0-9A-Za-z_-]+') GROUP BY 1""",
)
def stop_word_filter(spark, folder):
    words = F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    stops = V.stop_list(table(spark, folder, "benchmark").select(words.alias("value")))
    return V.without_stop_words(V.term_counts(docs(spark, folder, "token")), stops)
