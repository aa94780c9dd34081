"""Substring deduplication by sliding spans of consecutive sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datashelf.llm.common import few, keyed, stored

SPAN_WORDS = 16
# A sentence ends at a mark before white space, at a mark of a script that sets none, at a line's end or with the text; white
# space after it belongs to it. Parts of sentences count as sentences: a passage seldom begins and ends with a full one.
SENTENCE = re.compile(r"(?s).+?(?:[.!?,;:]+[ \t\n\r]+|[。！？，；：、।۔؟؛]+[ \t\n\r]*|\n[ \t\n\r]*|\Z)")
SPACE = " \t\n\r"
ROWS_OUT = 50_000


def spans(sentences: list[str], words: int) -> Iterator[tuple[int, int, bytes]]:
    """Sliding spans: (first sentence, number of sentences, text). From each sentence on, the fewest that reach ``words``;
    a text that does not reach them is one span."""
    plain = [s.strip(SPACE) for s in sentences]
    sizes = [len(s.split()) or 1 for s in plain]
    end = total = 0
    for start in range(len(plain)):
        while end < len(plain) and total < words:
            total += sizes[end]
            end += 1
        if total < words and start:
            return
        yield start, end - start, "\n".join(plain[start:end]).encode("utf-8", "surrogatepass")
        total -= sizes[start]


def hasher(words: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, size, k1, k2, of = [], [], [], [], []

            def told() -> pa.RecordBatch:
                ids = pa.array(of, pa.int32())
                return pa.record_batch(
                    [batch.column("row").take(ids), batch.column("id").take(ids), pa.array(at, pa.int32()),
                     pa.array(size, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())],
                    names=["row", "doc_id", "at", "size", "k1", "k2"],
                )

            for i, text in enumerate(batch.column("text").to_pylist()):
                for start, n, run in spans(SENTENCE.findall(text), words) if text else ():
                    key = xxhash.xxh3_128_digest(run)
                    of.append(i)
                    at.append(start)
                    size.append(n)
                    k1.append(int.from_bytes(key[:8], "big", signed=True))
                    k2.append(int.from_bytes(key[8:], "big", signed=True))
                if len(at) >= ROWS_OUT:
                    yield told()
                    at, size, k1, k2, of = [], [], [], [], []
            yield told()

    return hashed


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the sentences that ``gone`` covers."""
    for batch in batches:
        out = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            sentences = SENTENCE.findall(text) if text else []
            covered = bytearray(len(sentences))
            for span in gone or ():
                covered[span["at"] : span["at"] + span["size"]] = b"\1" * span["size"]
            left = "".join([s for s, c in zip(sentences, covered) if not c]) if gone else text
            out.append((len(sentences), sum(covered), len(text or "") - len(left or ""), left))
        n, removed, chars, left = zip(*out) if out else ((), (), (), ())
        yield pa.record_batch(
            [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(removed, pa.int32()),
             pa.array(chars, pa.int32()), pa.array(left, pa.string())],
            names=["row", "doc_id", "n_sentences", "n_removed", "n_chars_removed", "text"],
        )


def drop_repeated_spans(docs: DataFrame, *, words: int = SPAN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts without sentences that lie in a repeated span: (row, doc_id, n_sentences, n_removed, n_chars_removed, text).

    From every sentence on, the run of the fewest consecutive sentences with at least ``words`` words is hashed (128 bits,
    white space around sentences left out). The first occurrence of a run, by doc_id, then by place in the input, then in the
    text, stays; all sentences of every later one go. A text of fewer words is one run. What is left is joined as it stood,
    white space included.

    A null text stays null, with no sentences; an empty text has none either. Null ids come first in the order.
    Repeated rows are repeats like any other. An empty table gives no rows. Other columns are not looked at.

    Half a hash says which runs may occur twice; places are gathered for those only. Runs meet in aggregates with partial
    results, then in joins that adaptive execution can split, so a run that most documents share is no hot group. Rows are
    gathered by document only.
    """
    source = keyed(docs, id=id_col, text=text_col)
    id_type = source.schema["id"].dataType.simpleString()
    runs = source.mapInArrow(hasher(words), f"row long, doc_id {id_type}, at int, size int, k1 long, k2 long")
    twice = stored(runs.groupBy("k1").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("k1"), "twice")
    # merged at every size: a broadcast of the smaller inputs would only hide what the larger ones shuffle
    runs = stored(runs.join(twice.hint("merge"), "k1"), "repeated")
    place = F.struct("doc_id", "row", "at")
    first = runs.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("m"), F.min(place).alias("first")).filter("m > 1")
    # Stored, so that the join shuffles both sides anew and adaptive execution can split a hot run.
    first = stored(first.select("k1", "k2", "first"), "first")
    later = runs.join(first, ["k1", "k2"]).filter(
        (F.col("row") != F.col("first.row")) | (F.col("at") != F.col("first.at"))
    )
    gone = stored(later.groupBy("row").agg(F.collect_list(F.struct("at", "size")).alias("gone")), "gone")
    rows = few(gone.select("row"))
    texts = source.select("row", F.col("id").alias("doc_id"), "text")
    touched = texts.join(rows, "row", "left_semi").join(gone, "row").select("row", "doc_id", "text", "gone")
    whole = texts.join(rows, "row", "left_anti").select("*", F.lit(None).cast(gone.schema["gone"].dataType).alias("gone"))
    return touched.union(whole).mapInArrow(
        cut, f"row long, doc_id {id_type}, n_sentences int, n_removed int, n_chars_removed int, text string"
    )
