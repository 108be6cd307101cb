"""Language identification by compression.

A language's model is a raw-content zstandard dictionary: text of that language
from a bounded sample of labelled documents. A text is compressed with every
dictionary; the language that makes it smallest is its language. A narrow margin
to the second smallest is a reason to reject the text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.words import portions

UNDETERMINED = "und"
#: Without it a short text is stored as it is, since packing it saves nothing.
TAIL = b" " * 256
PREDICTED = "lang_pred string, score double"


@dataclass(frozen=True)
class Compression:
    """documents: sampled per language, about. characters: taken of each, from its
    middle. level: of compression. block: bytes of a text that are compressed at
    once. margin: a smaller score rejects the text."""

    documents: int = 300
    characters: int = 300
    level: int = 6
    block: int = 32 << 10
    margin: float = 0.005


def learn(docs: DataFrame, p: Compression = Compression(), text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary per language of rows with a language and a letter in their text.

    The sample takes the distinct texts whose hashes lie below a share of their
    range, so that repeated rows count once; its expected size is bounded by the
    parameters, whatever the size of the table. There is one dictionary per distinct
    lang: their number is that of the labels used, which is taken to be small.
    """
    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).where(F.col("l").isNotNull() & has_letter(F.col("t")))
    hashed = F.xxhash64("t")
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.approx_count_distinct(hashed).alias("n")).collect()}
    if not counts:
        return {}
    place = F.pmod(hashed, F.lit(1 << 30))
    share = F.element_at(F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, min(1.0, p.documents / max(n, 1)))]), F.col("l"))
    middle = F.greatest(F.lit(1), ((F.length("t") - p.characters) / 2).cast("int"))
    taken = rows.where(place < share * (1 << 30)).select("l", F.substring("t", middle, F.lit(p.characters)).alias("t"), hashed.alias("h")).distinct().collect()
    texts = defaultdict(list)
    for row in sorted(taken, key=lambda r: (r["l"], r["t"])):
        texts[row["l"]].append(row["t"])
    return {l: " ".join(letters_only(pa.array(texts[l])).to_pylist()).encode() for l in sorted(texts)}


def letters_only(column: pa.Array) -> pa.Array:
    """Letters in lower case; whatever else lies between them becomes one blank."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(column, "")), r"[^\pL]+", " ")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def prediction(text: Column, model: dict[str, bytes], p: Compression = Compression()) -> Column:
    """struct<lang_pred, score> of a text, as ``identified`` describes it."""
    languages = list(model)

    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=p.level)
        return zstandard.ZstdCompressor(dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False)

    @F.arrow_udf(PREDICTED)
    def predict(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        compressors = [compressor(content) for content in model.values()]
        for has, texts in columns:
            names, scores = [], []
            lowered = (text for i, j in portions(texts) for text in letters_only(texts.slice(i, j - i)))
            for letters, text in zip(has.to_pylist(), lowered):
                if not letters or not languages:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                content = memoryview(text.as_buffer())
                blocks = [bytes(content[i : i + p.block]) + TAIL for i in range(0, len(content), p.block)]
                sizes = [sum(len(c.compress(b)) for b in blocks) for c in compressors]
                best = min(range(len(sizes)), key=sizes.__getitem__)
                second = min(sizes[:best] + sizes[best + 1 :], default=0)
                names.append(languages[best])
                scores.append(1 - sizes[best] / second if second else 1.0)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict(has_letter(text), text)


def rejection(predicted: Column, p: Compression = Compression()) -> Column:
    """Whether a prediction is no language, or one by too narrow a margin."""
    return (predicted["lang_pred"] == UNDETERMINED) | (predicted["score"] < p.margin)


def identified(docs: DataFrame, model: dict[str, bytes], p: Compression = Compression(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, lang_pred, score, rejected.

    score is 1 - smallest / second smallest size: 0 for a tie (the language first
    in order wins), 1 if only one language was learned. A null text, one without
    a letter, or any text if nothing was learned, is ``und`` with score 0. Only
    und texts and margins below ``margin`` are rejected. The whole text is
    compressed, its letters in lower case, in blocks whose sizes are added up: a
    dictionary saves a bounded number of bytes of what is compressed at once, so
    that the margin of one run over a long text would fall with its length. Rows stay apart, so repeated rows and
    null ids need no care; other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), prediction(F.col(text), model, p).alias("p"))
    return rows.select("doc_id", "p.lang_pred", "p.score", rejection(F.col("p"), p).alias("rejected"))
