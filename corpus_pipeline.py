"""From all documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import cotrain, langid
from foliant.llm.decontaminate import contaminated
from foliant.llm.minhash import NearDuplicates, near_duplicates
from foliant.llm.packing import Packing, packed
from foliant.llm.queries import good_labels, vocabulary
from foliant.session import written

#: Near copies at 0.8 are left out of the training data; op7 links at its own threshold.
NEAR = NearDuplicates(percent=80)
#: Name of a row's own number; no column of documents has it.
ROW = "__row"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject.

    Every row is judged by itself: repeated rows go or stay together, a null id is
    a row like any other, a null or empty text is judged as an empty one. Without
    documents, or without labels for any, none is rejected.
    """
    model = cotrain.learn(docs, good_labels(spark, sf_dir))
    return docs.where(~cotrain.rejection(cotrain.chances(docs, model), model))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells with some margin.

    Every row is judged by itself: repeated rows go or stay together, a null id is
    a row like any other, a null lang is not learned from. A null text, or one
    without letters, is rejected; a very long one is compressed block by block.
    An empty table stays empty.
    """
    return docs.where(~langid.rejection(langid.prediction(F.col("text"), langid.learn(docs))))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id.

    Rows are told apart by a number of their own, so that copies collapse to one row
    whatever their ids are: repeated rows, copies under other ids, rows without an
    id (which come last where a group has others). One id with different texts
    stays once per text. Texts without words are copies only of rows with the same
    id and text. An empty table stays empty.
    """
    # Written, so that the numbers cannot change. Only numbers meet in what follows.
    rows = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(rows, NEAR, id=ROW).select(F.col("doc_id").alias(ROW), "n_shingles", F.col("component_id").alias("group"))
    keys = rows.select(ROW, F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.xxhash64("text", F.length("text")).alias("blank"))
    placed = written(keys.join(groups, ROW), "groups")
    worded = F.col("n_shingles") > 0
    smallest = placed.where(worded).groupBy("group").agg(F.min("id").alias("id"))
    winners = placed.where(worded).join(smallest, ["group", "id"]).groupBy("group").agg(F.min(ROW).alias(ROW)).select(ROW)
    blanks = placed.where(~worded).groupBy("id", "blank").agg(F.min(ROW).alias(ROW)).select(ROW)
    listed = written(placed.select(ROW).join(winners.unionByName(blanks), ROW, "left_anti"), "rejected")
    return rows.join(listed, ROW, "left_anti").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold half of a benchmark item.

    All rows of an id go with any of them; rows without an id are told apart by
    their text. A null or empty text holds nothing and stays. An empty table, or
    an empty benchmark, leaves all as it is.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = _without(docs, contaminated(docs, benchmark).select("doc_id"))
    key = F.xxhash64("text")
    nameless = docs.where("doc_id is null").select(key.alias("doc_id"), "text")
    listed = written(contaminated(nameless, benchmark).select("doc_id").distinct(), "rejected")
    return clean.join(listed.select(F.col("doc_id").alias("__key")), F.col("doc_id").isNull() & (key == F.col("__key")), "left_anti").select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048.

    Repeated rows are packed each, a null id stays null, a null or empty text is
    its closing token alone. An empty table gives no pieces.
    """
    return packed(docs, Packing(vocabulary()))


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose id is not listed. The list is written first, so that a short one is broadcast."""
    listed = written(ids.where("doc_id is not null").distinct(), "rejected")
    return docs.join(listed, "doc_id", "left_anti").select(docs.columns)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", distinct_documents),
    ("decontamination", decontaminated),
    ("packing", sequences),
]
ORACLE_SQL = None  # models, connected components and tokens are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
