"""Exact substring deduplication over suffixes sorted by the difference-cover algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datashelf.llm.common import keyed, stored

LENGTH = 200
ANCHOR = 64
PLACE_BITS = 20
# Names of a batch take 21 bits, so it holds less than 3 MB: this much, and one more group.
BATCH_BYTES = 1_500_000
HOT_BYTES = 1_400_000


def fingerprints(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all strings of ``width`` bytes, by doubling."""
    if len(data) < width:
        return np.empty(0, np.uint64)
    factor = np.uint64(0x94D049BB133111EB)
    now = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    now ^= now >> np.uint64(29)
    size = 1
    while size < width:
        step = min(size, width - size)  # the last step overlaps
        now = now[: len(now) - step] * factor + now[step:]
        now ^= now >> np.uint64(31)
        size += step
    return now


def least_within(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    now, size = values, 1
    while size < width:
        step = min(size, width - size)
        now = np.minimum(now[: len(now) - step], now[step:])
        size += step
    return now


def anchors(data: bytes, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with a common anchor, the first least hash within a window: begin, end, hash of the anchor."""
    hashes = fingerprints(np.frombuffer(data, np.uint8), anchor)
    span, mask = length - anchor + 1, np.uint64((1 << PLACE_BITS) - 1)
    windows, out = len(hashes) - span + 1, []
    for at in range(0, windows, (1 << PLACE_BITS) - span):
        part = hashes[at : at + (1 << PLACE_BITS) - 1]
        least = least_within((part & ~mask) | np.arange(len(part), dtype=np.uint64), span) & mask
        begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        out.append((begin + at, np.append(begin[1:], len(least)) + at, part[least[begin].astype(np.int64)]))
    return tuple(np.concatenate(x) for x in zip(*out))


def difference_cover_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes of ``text`` (small non-negative integers, 0 past the end).

    Suffixes at positions 1 and 2 mod 3 are the sample. Their triples are sorted and named; where names repeat and do
    not yet cover ``depth`` symbols, the sequence of names is ranked in the same way. The remaining suffixes are sorted
    by first symbol and rank of the next, and merged in: against class 1 by one symbol and a rank, against class 2 by
    two symbols and a rank. Suffixes that agree in ``depth`` symbols may share a rank.
    """
    n = len(text)
    if n < 3:
        padded = np.concatenate([text, np.zeros(3, text.dtype)]).astype(np.uint64)
        _, ranks = np.unique((padded[:n] << np.uint64(42)) | (padded[1 : n + 1] << np.uint64(21)) | padded[2 : n + 2], return_inverse=True)
        return ranks.astype(np.int64) + 1
    padded = np.concatenate([text, np.zeros(4, text.dtype)]).astype(np.uint64)
    ones, twos, zeros = np.arange(1, n + 1, 3), np.arange(2, n + 1, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    triples = (padded[sample] << np.uint64(42)) | (padded[sample + 1] << np.uint64(21)) | padded[sample + 2]
    distinct, names = np.unique(triples, return_inverse=True)
    names = names.astype(np.int64) + 1
    if len(distinct) < len(sample) and depth > 3:
        # a symbol below all names keeps the two halves apart
        ranked = difference_cover_ranks(np.concatenate([names[: len(ones)], [0], names[len(ones) :]]), -(-depth // 3))
        names = np.concatenate([ranked[: len(ones)], ranked[len(ones) + 1 :]])
    rank = np.zeros(n + 4, np.uint64)
    rank[sample] = names
    room = np.uint64(int(rank.max()).bit_length())
    symbol = padded << room
    pair = (padded[:-1] << np.uint64(21)) | padded[1:]
    of_zero = symbol[zeros] | rank[zeros + 1]
    zero_order = np.sort(of_zero)
    of_one = symbol[ones] | rank[ones + 1]
    with_two = (pair[zeros] << room) | rank[zeros + 2]
    of_two = (pair[twos] << room) | rank[twos + 2]
    out = np.empty(n + 1, np.int64)
    sample_order = np.sort(rank[sample])
    own = np.searchsorted(sample_order, rank[sample])
    out[ones] = own[: len(ones)] + np.searchsorted(zero_order, of_one)
    out[twos] = own[len(ones) :] + np.searchsorted(np.sort(with_two), of_two)
    out[zeros] = (
        np.searchsorted(zero_order, of_zero) + np.searchsorted(np.sort(of_one), of_zero) + np.searchsorted(np.sort(of_two), with_two)
    )
    return out[:n] + 1


def repeated_starts(pieces: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """For each piece, which of its first ``starts`` windows of ``length`` bytes begin elsewhere among all windows."""
    joined = np.frombuffer(b"".join(pieces), np.uint8)
    first = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])[:-1]
    windows = np.concatenate([np.arange(a, a + n) for a, n in zip(first, starts)])
    ranks = difference_cover_ranks(joined.astype(np.int64) + 1, length)[windows]
    order = np.argsort(ranks, kind="stable")
    prefix = fingerprints(joined, length)[windows[order]]
    alike = np.concatenate([[False], (prefix[1:] == prefix[:-1]), [False]])
    hit = np.zeros(len(windows), bool)
    hit[order] = alike[1:] | alike[:-1]
    return np.split(hit, np.cumsum(starts)[:-1])


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def run_finder(length: int, anchor: int):
    """Cut each text's windows into runs that share the anchor: the least hash of ``anchor`` bytes within a window."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                out = [[] for _ in range(5)]
                for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                    data = encoded(text)
                    if len(data) < length:
                        continue
                    begin, end, least = anchors(data, length, anchor)
                    spans = [xxhash.xxh3_64_intdigest(data[a : b + length - 1]) for a, b in zip(begin.tolist(), end.tolist())]
                    for values, new in zip(out, (np.full(len(begin), row), begin, end, least.view(np.int64),
                                                 np.array(spans, np.uint64).view(np.int64))):
                        values.append(new)
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                columns = [pa.array(np.concatenate(v) if v else [], k) for v, k in zip(out, kinds)]
                yield pa.record_batch(columns, names=["row", "begin", "end", "anchor", "span"])

    return find


def cutter(length: int):
    """The bytes of the runs that a text is asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            for row, text, asked in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "asked"))):
                data = encoded(text)
                for a in asked:
                    for values, new in zip(out, (row, a["begin"], a["end"], a["anchor"], a["single"], data[a["begin"] : a["end"] + length - 1])):
                        values.append(new)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.record_batch([pa.array(v, k) for v, k in zip(out, kinds)],
                                  names=["row", "begin", "end", "anchor", "single", "bytes"])

    return cut


def suffix_sorter(length: int):
    """Sort the suffixes of whole anchor groups, some megabytes at a time; yields runs of windows that repeat."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def done() -> pa.RecordBatch:
            rows, begins, ends = [], [], []
            if held:
                with np.errstate(over="ignore"):
                    found = repeated_starts([h[5] for h in held], [h[2] - h[1] for h in held], length)
                for (row, begin, _, _, single, _), hit in zip(held, found):
                    if single and hit.any():
                        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                        rows += [row] * len(a)
                        begins += (a + begin).tolist()
                        ends += (b + begin).tolist()
            held.clear()
            return pa.record_batch([pa.array(rows, pa.int64()), pa.array(begins, pa.int32()), pa.array(ends, pa.int32())],
                                   names=["row", "begin", "end"])

        for batch in batches:
            for item in zip(*(batch.column(c).to_pylist() for c in ("row", "begin", "end", "anchor", "single", "bytes"))):
                if size >= BATCH_BYTES and item[3] != held[-1][3]:
                    yield done()
                    size = 0
                held.append(item)
                size += len(item[5])
        yield done()

    return sort


def window_hasher(length: int):
    """Every window of a run by two hashes, for anchors with more spans than one task should hold."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for row, begin, single, data in zip(*(batch.column(c).to_pylist() for c in ("row", "begin", "single", "bytes"))):
                    raw = np.frombuffer(data, np.uint8)
                    one, two = fingerprints(raw, length), fingerprints(raw[::-1], length)[::-1]
                    n = len(one)
                    yield pa.record_batch(
                        [pa.array(one.view(np.int64)), pa.array(np.ascontiguousarray(two).view(np.int64)),
                         pa.array(np.full(n, row), pa.int64()), pa.array(np.arange(begin, begin + n), pa.int32()),
                         pa.array(np.full(n, single))],
                        names=["w1", "w2", "row", "begin", "single"],
                    )

    return emit


def remover(length: int, with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in range(5)]
            for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist()):
                data = encoded(text)
                kept, at, removed, spans = [], 0, 0, 0
                last = -1
                for begin, end in sorted((m["begin"], m["end"] + length - 1) for m in marks or ()):
                    if begin > last:
                        spans += 1
                        kept.append(data[at:begin])
                        removed += end - begin
                    else:
                        removed += max(0, end - last)
                    last = at = max(last, end)
                kept.append(data[at:])
                left = b"".join(kept)
                # cuts fall between bytes; what they leave of a character is dropped from the text, not from the digest
                shown = (left.decode("utf-8", "ignore") if spans else text) if with_text else None
                for values, new in zip(columns, (len(data), removed, spans, hashlib.sha256(left).hexdigest(), shown)):
                    values.append(new)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.record_batch(
                [batch.column("row"), batch.column("doc_id"), *[pa.array(v, k) for v, k in zip(columns, kinds)]],
                names=["row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
            )

    return remove


def repeated_windows(source: DataFrame, length: int, anchor: int) -> DataFrame:
    """Windows (strings of ``length`` bytes) that begin elsewhere too: (row, begin, end), starts from begin to end - 1."""
    runs = stored(
        source.select("row", "text").mapInArrow(
            run_finder(length, anchor), "row long, begin int, end int, anchor long, span long"
        ),
        "runs",
    )
    # Equal windows have equal anchors, so an anchor that is seen once takes its run out.
    # Stored, so that the join shuffles both sides anew and adaptive execution can split a hot anchor.
    twice = stored(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("anchor"), "twice")
    runs = stored(runs.join(twice, "anchor"), "active")
    # Equal runs repeat in all their windows; one of them stands for them all.
    place = F.struct("row", "begin", "end")
    spans = stored(runs.groupBy("anchor", "span").agg(F.count(F.lit(1)).alias("m"), F.min(place).alias("at")), "spans")
    whole = runs.join(spans.filter("m > 1").select("anchor", "span"), ["anchor", "span"]).select("row", "begin", "end")
    size = F.sum(F.col("at.end") - F.col("at.begin") + length)
    kinds = spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("spans"), size.alias("size")).filter("spans > 1")
    open_ = spans.join(kinds, "anchor").select("at.row", "at.begin", "at.end", "anchor", (F.col("m") == 1).alias("single"))
    asked = open_.groupBy("row").agg(F.collect_list(F.struct("begin", "end", "anchor", "single")).alias("asked"))
    line = "row long, begin int, end int, anchor long, single boolean, bytes binary"
    hot = stored(kinds.filter(F.col("size") > HOT_BYTES).select("anchor"), "hot")
    pieces = source.select("row", "text").join(asked, "row").mapInArrow(cutter(length), line)
    pieces = stored(pieces, "pieces")
    some = pieces.join(hot, "anchor", "left_anti")
    parts = some.repartition("anchor").sortWithinPartitions("anchor", "row", "begin")
    found = whole.union(parts.mapInArrow(suffix_sorter(length), "row long, begin int, end int"))
    windows = pieces.join(hot, "anchor", "left_semi").select("row", "begin", "single", "bytes").mapInArrow(
        window_hasher(length), "w1 long, w2 long, row long, begin int, single boolean"
    )
    if hot.limit(1).count():
        again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("w1", "w2")
        more = windows.filter("single").join(again, ["w1", "w2"])
        found = found.union(more.select("row", "begin", (F.col("begin") + 1).alias("end")))
    return found


def drop_repeated_bytes(docs: DataFrame, *, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id",
                        text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts anywhere else, same text included:
    (row, doc_id, n_bytes, n_removed, n_spans, kept_sha256[, text]).

    Texts are taken as UTF-8. All occurrences go, overlaps count, and strings are judged on the input. ``n_spans``
    counts maximal removed runs, the digest is that of the remaining bytes. ``text`` is what is left as text; a
    character of which only some bytes are left is dropped from it.

    Texts are first cut where the first least hash of ``anchor`` bytes within a window changes place. Text whose anchors occur once
    cannot repeat, and equal cuts repeat as wholes; both leave the work without loss. What is left, the cuts that agree
    with others only in part, is dealt out by anchor. There, the suffixes of all cuts of a group are sorted by the
    difference-cover algorithm, and neighbours are compared in their first ``length`` bytes. An anchor with more than
    ``HOT_BYTES`` of different cuts goes by hashes of its windows instead, in an aggregate with partial results.

    A null text is empty and stays null. Null ids and repeated rows are texts of their own (repeated rows of ``length``
    bytes or more go whole). An empty table gives no rows.
    """
    source = keyed(docs, doc_id=id_col, text=text_col)
    marks = repeated_windows(source, length, anchor).groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("marks"))
    kind = source.schema["doc_id"].dataType.simpleString()
    out = source.join(marks, "row", "left").mapInArrow(
        remover(length, with_text),
        f"row long, doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string",
    )
    return out if with_text else out.drop("text")
