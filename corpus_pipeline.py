"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next.

Every stage works on all that its predecessor kept. Language identification drops texts without a language, near-duplicate
detection keeps one document of each class, suffix sorting cuts passages that occur more than once, decontamination drops
documents that overlap a test item, and packing lays what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datashelf.llm.common import keyed
from datashelf.llm.decontaminate import decontaminate
from datashelf.llm.language import UNKNOWN, predict_language
from datashelf.llm.near_dup import near_duplicates
from datashelf.llm.packing import pack
from datashelf.llm.queries import table, tokenizer_path
from datashelf.llm.suffixes import drop_repeated_bytes
from datashelf.session import fresh_folder

# Below this, no language has even a third of the words' probability.
LEAST_LANGUAGE_SCORE = 0.3
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents with the given row numbers."""
    return keyed(docs, **{c: c for c in docs.columns}).join(rows.select("row"), "row", "left_semi").select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language: not those without a letter, nor those whose words are of no language in particular."""
    found = predict_language(docs)
    return only(docs, found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each class of near-duplicates; of repeated rows of it, one."""
    found = near_duplicates(docs).filter("kept")
    one = found.filter("n_shingles > 0 and component_id is not null").groupBy("component_id").agg(F.min("row").alias("row"))
    rest = found.filter("n_shingles = 0 or component_id is null")
    return only(docs, one.select("row").union(rest.select("row")))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out passages of 200 bytes or more that occur more than once; a text of which nothing is left goes."""
    left = drop_repeated_bytes(docs).filter("n_removed = 0 or n_removed < n_bytes").select("row", "text")
    others = keyed(docs, **{c: c for c in docs.columns if c != "text"}).join(left, "row")
    return others.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that overlap no benchmark item."""
    return only(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("not contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# A trained model, hash signatures and a tokenizer are not to be had in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for name, stage in STAGES:
        folder = fresh_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
