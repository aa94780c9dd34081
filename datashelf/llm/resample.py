"""Documents drawn like a target distribution: importance weights of hashed word n-grams, found by overlapped scanning."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datashelf.llm.common import keyed, ranked, stored

BUCKETS = 10_000  # bounds what reaches the driver: a count and a gain for each bucket
SEPARATORS = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def run_pattern(longest: int):
    """Runs of ``longest`` words between single spaces, fewer at the end. The lookarounds let runs begin and end with words."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){0,%d}(?![^ ])" % (longest - 1))


def feature_codes(flat: bytes, pattern) -> tuple[list[int], int]:
    """CRC-32 of every run of words, and the number of words: an overlapped match begins at each word."""
    codes, words = [], 0
    for m in pattern.finditer(flat, overlapped=True):
        start, end = m.span()
        words += 1
        code = 0
        # shorter runs end at the spaces within the span; a longer run's code goes on from the shorter one's
        while (space := flat.find(b" ", start + 1, end)) >= 0:
            code = crc32(flat[start:space], code)
            codes.append(code)
            start = space
        codes.append(crc32(flat[start:end], code))
    return codes, words


def scanner(longest: int, buckets: int):
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = run_pattern(longest)
        for batch in batches:
            sizes, found = [], []
            for text in batch.column("text").to_pylist():
                flat = SEPARATORS.sub(b" ", text.encode("utf-8", "surrogatepass").lower()) if text else b""
                codes, words = feature_codes(flat, pattern)
                sizes.append(words)
                found.append((np.array(codes, np.uint32) % np.uint32(buckets)).astype(kind).tobytes())
            yield pa.record_batch(
                [batch.column("row"), batch.column("id"), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                names=["row", "id", "words", "found"],
            )

    return scan, kind


def bucket_counts(features: DataFrame, kind: type, buckets: int) -> list[int]:
    """How many features each bucket holds. Every task counts its own; one row a bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for codes in batch.column("found"):
                total += np.bincount(np.frombuffer(codes.as_buffer(), kind), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int64()), pa.array(total[held])], names=["bucket", "n"])

    rows = features.select("found").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = [0] * buckets
    for r in rows.collect():
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of target to source share, a bucket at a time, with one added to every count."""
    s_all, t_all = float(sum(source) + len(source)), float(sum(target) + len(target))
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source, target)]


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = 2,
    buckets: int = BUCKETS,
    percent: int = 25,
    min_words: int = 20,
    seed: int = 7,
) -> DataFrame:
    """Importance weights of documents and the draw: (row, doc_id, n_features, weight, score, rank).

    Features are the runs of 1 to ``longest`` words, repeats counted; CRC-32 modulo ``buckets`` gives each its bucket. The
    weight is the floored mean of the buckets' gains (no features: 0). ``score`` adds Gumbel noise from a hash of seed and
    id, so that the highest scores are a draw without replacement in proportion to the weights. Of the documents with at
    least ``min_words`` words, ``percent`` in a hundred are drawn: ``rank`` from 1, ties to smaller ids, else null.

    Texts are scanned once; what stays of them is a bucket's number for each feature. A null or empty text has no features.
    A null id counts as an empty one in the hash and comes last in ties; repeated rows are rows of their own, in the order of
    the input. An empty ``target`` or ``docs`` has counts of zero; empty ``docs`` give no rows. Other columns are not looked at.
    """
    scan, kind = scanner(longest, buckets)

    def features(df: DataFrame, label: str, **columns) -> DataFrame:
        source = keyed(df, **columns)
        id_type = source.schema["id"].dataType.simpleString()
        return stored(source.mapInArrow(scan, f"row long, id {id_type}, words long, found binary"), label)

    own = features(docs, "features", id=id_col, text=text_col)
    wanted = features(target, "target", id=F.lit(0), text=text_col)
    gains = np.array(bucket_gains(bucket_counts(own, kind, buckets), bucket_counts(wanted, kind, buckets)), np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, sizes = [], []
            for codes in batch.column("found"):
                codes = np.frombuffer(codes.as_buffer(), kind)
                sums.append(int(gains[codes].sum()))
                sizes.append(len(codes))
            weights = [s // n if n else 0 for s, n in zip(sums, sizes)]
            yield pa.record_batch(
                [batch.column("row"), batch.column("id"), batch.column("words"), pa.array(sizes, pa.int64()),
                 pa.array(weights, pa.int64())],
                names=["row", "id", "words", "n_features", "weight"],
            )

    id_type = own.schema["id"].dataType.simpleString()
    weighed = own.mapInArrow(weigh, f"row long, id {id_type}, words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = stored(weighed.withColumn("score", F.col("weight") + noise), "scored")
    eligible = scored.filter(F.col("words") >= min_words)
    drawn = percent * eligible.count() // 100
    order = eligible.select("row", (-F.col("score")).alias("down"), F.col("id").isNull().alias("no_id"), "id")
    places = ranked(order, [], ["down", "no_id", "id", "row"]).filter(F.col("rank") < drawn)
    return scored.join(places.select("row", (F.col("rank") + 1).alias("rank")), "row", "left").select(
        "row", F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank"
    )
