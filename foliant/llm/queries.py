"""Registered queries of the operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import chat, cotrain, langid, lzprint, ngram, urlmodel, warc
from foliant.llm.decontaminate import contaminated
from foliant.llm.lexical import ranked
from foliant.llm.minhash import near_duplicates
from foliant.llm.packing import Packing, packed
from foliant.llm.resample import resampled
from foliant.llm.tokencount import TokenCounts, token_counts
from foliant.llm.urlmodel import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORDS_SQL = r"list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(id).cast("string")), F.lit(n))


@query("op1_greedy_string_tiling")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds half of a benchmark item or more, with the tiles."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    "op2_warc_bundles",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
    g AS (SELECT payload_digest, max(page_id) AS largest FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id < largest THEN largest END AS refers_to
    FROM d LEFT JOIN g USING (payload_digest)
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """All pages into bundles and back."""
    index = warc.archived(table(spark, folder, "pages"), warc.shared_folder(spark))
    return warc.payload_facts(warc.records(index))


@query("op3_bounded_space_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packed(table(spark, folder, "documents"), Packing(vocabulary()))


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_compression_language_id")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """The language of all documents, learned from three quarters of them."""
    docs = table(spark, folder, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = langid.learn(docs.where(~held_out))
    return langid.identified(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op5_lz_phrase_fingerprint")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return lzprint.fingerprinted(table(spark, folder, "documents"))


def url_sql(rules, p: urlmodel.UrlModel = urlmodel.UrlModel()) -> str:
    """``urlmodel.judged`` as SQL, a table per order of the model."""
    k = p.order

    def case(value) -> str:
        longest_first = sorted(rules, key=lambda r: (-len(r.rule), r.rule))
        fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in longest_first) + " END"

    lower = f"translate({{}}, '{urlmodel.CAPITALS}', '{urlmodel.SMALL}')"
    steps = [
        f"""parts AS (SELECT page_id, coalesce(url, '') AS url, {lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)""",
        f"ruled AS (SELECT *, {case(lambda r: r.rule)} AS rule, {case(lambda r: r.verdict)} AS verdict FROM parts)",
        f"""urls AS (SELECT url, count(*) AS n, any_value(verdict) AS verdict, CAST('0x' || substr(md5(url), 1, 6) AS BIGINT) % {p.apart} = 0 AS apart
  FROM ruled GROUP BY url)""",
        f"""cut AS (SELECT *, unnest(list_transform(range(1, length(url) + 2), lambda i: substr('{"^" * k}' || {lower.format("url")} || '$', i, {k + 1}))) AS g
  FROM urls)""",
        """grams AS (SELECT g, sum(CASE WHEN verdict = 'allow' AND NOT apart THEN n ELSE 0 END) AS a,
  sum(CASE WHEN verdict = 'block' AND NOT apart THEN n ELSE 0 END) AS r FROM cut GROUP BY g)""",
    ]
    for i in range(k + 1):
        chance = lambda n, c, low: f"(t.{n} + {p.mass}::DOUBLE * {low}) / ({c} + {p.mass}::DOUBLE)"
        low = [f"{1.0 / p.alphabet}::DOUBLE"] * 2 if i == 0 else ["s.pa", "s.pr"]
        join = "" if i == 0 else f"JOIN p{i - 1} s ON s.g = right(t.g, {i})"
        steps += [
            f"t{i} AS (SELECT right(g, {i + 1}) AS g, sum(a) AS a, sum(r) AS r FROM grams GROUP BY 1)",
            f"c{i} AS (SELECT left(g, {i}) AS h, sum(a) AS a, sum(r) AS r FROM t{i} GROUP BY 1)",
            f"p{i} AS (SELECT t.g, {chance('a', 'c.a', low[0])} AS pa, {chance('r', 'c.r', low[1])} AS pr FROM t{i} t JOIN c{i} c ON c.h = left(t.g, {i}) {join})",
        ]
    steps += [
        f"ratios AS (SELECT g, CAST(round((ln(pa) - ln(pr)) * {urlmodel.UNIT}) AS BIGINT) AS ratio FROM p{k})",
        """scores AS (SELECT url, any_value(n) AS n, any_value(verdict) AS verdict, CAST(floor(sum(ratio) / (length(url) + 1)) AS BIGINT) AS score
  FROM cut JOIN ratios USING (g) WHERE verdict IS NULL OR apart GROUP BY url)""",
        f"""steps AS (SELECT CAST(floor(score / {urlmodel.STEP}) AS BIGINT) AS step, sum(CASE verdict WHEN 'allow' THEN n ELSE 0 END) AS a,
  sum(CASE verdict WHEN 'block' THEN n ELSE 0 END) AS r FROM scores WHERE verdict IS NOT NULL GROUP BY 1)""",
        """errors AS (SELECT step, coalesce(sum(a) OVER below, 0) * sum(r) OVER () + (sum(r) OVER () - coalesce(sum(r) OVER below, 0)) * sum(a) OVER () AS error,
  sum(a) OVER () AS all_a, sum(r) OVER () AS all_r FROM steps WINDOW below AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        f"""cutoff AS (SELECT coalesce((SELECT step * {urlmodel.STEP} FROM errors WHERE all_a > 0 AND all_r > 0 ORDER BY error, step LIMIT 1), 0) AS least)""",
    ]
    return "WITH " + ",\n".join(steps) + """
SELECT page_id, host, path, rule, coalesce(ruled.verdict, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled LEFT JOIN scores ON scores.url = ruled.url AND scores.verdict IS NULL CROSS JOIN cutoff"""


RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


@query("op6_url_language_model", url_sql(RULES))
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on the address of every page."""
    return urlmodel.judged(table(spark, folder, "pages"), RULES).drop("score")


@query("op8_co_training_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """The chance that a document is good, for all documents, learned from the labels."""
    docs = table(spark, folder, "documents")
    return cotrain.scored(docs, cotrain.learn(docs, good_labels(spark, folder)))


def good_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Good is of quality and not toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return table(spark, folder, "labels").select("doc_id", good.alias("good"))


@query("op9_backoff_automaton")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, learned from four fifths of them."""
    return ngram.scored(table(spark, folder, "documents"), remainder("doc_id", 5) != 1)


@query(
    "op10_grammar_round_trip",
    r"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
    m AS (SELECT *, regexp_extract_all(text, '(\\*)(?:### |</turn>)', 1) AS slashes, length(regexp_extract(text, '\\+\z')) AS ending FROM t)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length('### : </turn>') + 1 + length(role) + length(text) + len(slashes) + length(array_to_string(slashes, '')) + ending)
            AS BIGINT) AS formatted_chars,
        count(*) FILTER (len(slashes) > 0 OR ending > 0) AS escaped_turns
    FROM m GROUP BY conv_id
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one that imitates the template, formatted and read back."""
    hard = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.read_back(chat.formatted(turns))


@query(
    "op7_minhash_near_dedup",
    rf"""
    WITH RECURSIVE words AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    runs AS (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
    shingles AS (SELECT DISTINCT doc_id, s FROM runs),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id),
    links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT d.doc_id, coalesce(max(sizes.n), 0)::BIGINT AS n_shingles, min(reach.b) AS component_id, d.doc_id = min(reach.b) AS kept
    FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id GROUP BY d.doc_id
    """,
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """b-bit MinHash near-duplicates of all documents."""
    return near_duplicates(table(spark, folder, "documents"))


@query("op11_two_tier_token_counts")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts(table(spark, folder, "documents"), TokenCounts(public_tokenizers.path("word_bpe_49k.json")))


# CRC-32 of a word's UTF-8 bytes: a table of 256 remainders from the reversed polynomial, then one step per byte.
CRC_SQL = """crcs AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
codes AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(hex(word)) + 1, 2),
    lambda i: CAST('0x' || substr(hex(word), i, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT word FROM words) CROSS JOIN crcs)"""
SMALL_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op13_importance_resampling",
    rf"""
    WITH texts AS (SELECT doc_id, true AS is_doc, text FROM documents UNION ALL SELECT item_id, false, text FROM benchmark),
    words AS (SELECT doc_id, is_doc, unnest(regexp_extract_all({SMALL_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
    {CRC_SQL},
    f AS (SELECT doc_id, is_doc, crc % 10000 AS bucket FROM words JOIN codes USING (word)),
    b AS (SELECT bucket, count(*) FILTER (is_doc) AS s, count(*) FILTER (NOT is_doc) AS t FROM f GROUP BY bucket),
    gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000) / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS g FROM b),
    w AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM f JOIN gain USING (bucket) WHERE is_doc GROUP BY doc_id),
    scored AS (
        SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(
            -1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
        FROM documents d LEFT JOIN w USING (doc_id)),
    ranks AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= n * 10 // 100 THEN r END AS rank FROM ranks
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of all documents of 20 words or more, drawn towards the texts of the benchmark."""
    return resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    "op12_document_fp_tree",
    rf"""
    WITH t AS (SELECT doc_id, unnest(regexp_extract_all({SMALL_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    q AS (SELECT item_id, unnest(regexp_extract_all({SMALL_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    lengths AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
    m AS (SELECT doc_id, 25 + ((75 * n * count(*) OVER ()) // CAST(sum(n) OVER () AS BIGINT)) AS m FROM lengths),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT count(*) FROM lengths) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY term),
    scores AS (
        SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
    ranks AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every item of the benchmark."""
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
