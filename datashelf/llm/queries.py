"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from datashelf.llm import oracles
from datashelf.llm.decontaminate import decontaminate
from datashelf.llm.language import predict_language
from datashelf.llm.licenses import license_scan
from datashelf.llm.near_dup import near_duplicates
from datashelf.llm.packing import pack
from datashelf.llm.phrases import collocations
from datashelf.llm.resample import resample
from datashelf.llm.secret_scan import secret_report
from datashelf.llm.sentence_spans import drop_repeated_spans
from datashelf.llm.sharding import shard_documents
from datashelf.llm.suffixes import drop_repeated_bytes
from datashelf.llm.vantage import nearest
from datashelf.llm.wrapper import extract_main_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op2_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_spans(table(spark, sf_dir, "documents")).drop("row")


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op5_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).drop("row")


def tokenizer_path() -> str:
    """The vocabulary file, which is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents")).drop("row")


def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_bytes(table(spark, sf_dir, "documents"), with_text=False).drop("row")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row")


def op11_trigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents")).drop("row")


def op12_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_overlapped_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kd_sharding": op1_kd_sharding,
    "op2_vantage_point": op2_vantage_point,
    "op3_sentence_spans": op3_sentence_spans,
    "op4_spaced_seeds": op4_spaced_seeds,
    "op5_wrapper_induction": op5_wrapper_induction,
    "op6_min_bin_slack": op6_min_bin_slack,
    "op7_crf_language": op7_crf_language,
    "op8_license_rules": op8_license_rules,
    "op9_suffix_array": op9_suffix_array,
    "op10_minhash": op10_minhash,
    "op11_trigram_index": op11_trigram_index,
    "op12_prefix_free": op12_prefix_free,
    "op13_overlapped_scan": op13_overlapped_scan,
}
SQL: dict[str, str] = dict(oracles.SQL)
