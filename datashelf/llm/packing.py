"""Packing documents into sequences of fixed capacity by minimum bin slack."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datashelf.llm.common import keyed, ranked, stored

CAPACITY = 2048
END_ID = 0
CACHED = 600_000
# Fixed value: how byte-level tokenizers of this kind cut texts.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")

# How they write bytes: printable ones as themselves, the others as the characters from 256 on.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_SIGNS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
SPACE_SIGN = BYTE_SIGNS[32]


class Encoder:
    """Ids of texts, as little-endian 32-bit bytes, with words once met kept.

    A byte-level tokenizer begins a new pre-token at every space that stands alone between two other characters, and maps
    each pre-token on its own. So a text is cut at these spaces, and the ids of what stands between them are kept, as
    are those of pre-tokens. Texts that hold a special token, and tokenizers of other kinds, go the plain way.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        layout = json.loads(tokenizer.to_str())
        kind = layout["pre_tokenizer"] or {}
        self.plain = bool(layout["normalizer"]) or kind.get("type") != "ByteLevel" or not kind.get("use_regex", True)
        self.plain = self.plain or kind.get("add_prefix_space", True)
        self.tokens = Kept(self.token)
        self.spaced = Kept(self.word)

    def token(self, text: str) -> bytes:
        """A pre-token."""
        if text.isascii() and text.isprintable():  # of these bytes, only the space is not written as itself
            mapped = text.replace(" ", SPACE_SIGN)
        else:
            mapped = text.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_SIGNS)
        return pack_ids([t.id for t in self.tokenizer.model.tokenize(mapped)])

    def apart(self, text: str) -> bytes:
        return b"".join([self.tokens[token] for token in PRE_TOKEN.findall(text)])

    def word(self, text: str) -> bytes | None:
        """What follows a space; None where that space does not stand alone."""
        if text.isalpha():  # letters only: one pre-token with the space
            return self.token(" " + text)
        if text[:-1].isalpha() and text[-1] in ".,":
            return self.spaced[text[:-1]] + self.tokens[text[-1]]
        return self.apart(" " + text) if text and text == text.strip() else None

    def encode(self, text: str) -> bytes:
        if self.plain or any(s in text for s in self.special):
            return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        words = text.split(" ")
        after = list(map(self.spaced.__getitem__, words[1:]))
        if None in after or words[0][-1:].isspace():
            words = LONE_SPACE.split(text)
            after = [self.apart(" " + word) for word in words[1:]]
        return self.apart(words[0]) + b"".join(after)


class Kept(dict):
    """What a function gave for the keys met lately."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, key):
        if len(self) >= CACHED:
            self.clear()
        self[key] = value = self.function(key)
        return value


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def piece_maker(tokenizer_path: str, capacity: int, with_ids: bool):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Encoder(Tokenizer.from_file(tokenizer_path))
        end = pack_ids([END_ID])
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                rows, ids = part.column("row").to_pylist(), part.column("id")
                taken, out = [], {k: [] for k in ("row", "piece", "start", "length", "crc", "ids")}
                for i, text in enumerate(part.column("text").to_pylist()):
                    data = encoder.encode(text or "") + end
                    length = len(data) // 4
                    # the first piece takes what whole pieces leave over
                    cuts = [0, *range(length % capacity or capacity, length, capacity), length]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        piece = data[4 * a : 4 * b]
                        taken.append(i)
                        for name, value in zip(out, (rows[i], k, a, b - a, zlib.crc32(piece))):
                            out[name].append(value)
                        if with_ids:
                            out["ids"].append(np.frombuffer(piece, "<u4").astype(np.int32))
                columns = [pa.array(out["row"], pa.int64()), ids.take(pa.array(taken, pa.int64())),
                           pa.array(out["piece"], pa.int32())]
                columns += [pa.array(out[k], pa.int64()) for k in ("start", "length", "crc")]
                if with_ids:
                    columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
                names = ["row", "id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
                yield pa.record_batch(columns, names=names)

    return make


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``: length -> how many.

    Subset-sum over a bitset: bit s of ``reach`` is set where sum s can be made. Long lengths come first, each in
    doubling numbers, and the search ends once ``room`` itself can be made.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in (np.flatnonzero(counts[: room + 1])[::-1]).tolist():
        left, step = min(int(counts[length]), room // length), 1
        while left > 0 and not reach >> room & 1:
            step = min(step, left)
            steps.append((length, step, reach))
            reach |= (reach << (length * step)) & mask
            left -= step
            step *= 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, step, before in reversed(steps):
        if not before >> total & 1:
            total -= length * step
            taken[length] = taken.get(length, 0) + step
    return taken


def minimum_bin_slack(counts: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """Bins for ``counts[length]`` items: (how many bins, length -> items in each of them).

    Each bin takes the longest length left and the fullest combination of others beside it. A combination is used as
    long as the counts allow, so the work follows the number of combinations, not of bins.
    """
    counts, capacity, bins = counts.copy(), len(counts) - 1, []
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        taken = fullest(counts, capacity - longest)
        counts[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        times = min(int(counts[length]) // n for length, n in taken.items())
        for length, n in taken.items():
            counts[length] -= n * times
        bins.append((times, taken))
    return bins


def places(bins: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """For runs of equal lengths, sorted: length, first rank, first bin, items a bin, offset of the first in a bin."""
    seen: dict[int, int] = {}
    first, out = 0, []
    for times, taken in bins:
        offset = 0
        for length, n in sorted(taken.items(), reverse=True):
            out.append((length, seen.get(length, 0), first, n, offset))
            seen[length] = seen.get(length, 0) + n * times
            offset += length * n
        first += times
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def placer(table: np.ndarray):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1] if len(table) else table
            within, each = rank - at[:, 1], at[:, 3]
            columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != "rank"]
            columns += [pa.array(at[:, 2] + within // each), pa.array(at[:, 4] + within % each * length)]
            names = [name for name in batch.schema.names if name != "rank"]
            yield pa.record_batch(columns, names=[*names, "sequence_id", "offset"])

    return place


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents and their place: (doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]).

    A document's ids are those of its whole text, then id 0. Longer ones than ``capacity`` are cut into whole
    sequences, the first piece taking what is left over. Sequences are filled by minimum bin slack over the number
    of pieces of each length, which has ``capacity`` entries however many pieces there are; that is all the driver
    sees. Pieces of one length are then numbered across partitions, and a piece's number says its sequence.

    A null or empty text is the one id 0. Null ids and repeated rows are packed as documents of their own. An empty
    table gives no rows. Other columns are not looked at.
    """
    source = keyed(docs, id=id_col, text=text_col)
    kind = source.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    pieces = stored(source.mapInArrow(piece_maker(tokenizer_path, capacity, with_ids), schema), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    table = places(minimum_bin_slack(counts))
    numbered = ranked(pieces, ["length"], ["row", "piece"])
    placed = numbered.select(*pieces.columns, "rank").mapInArrow(
        placer(table), f"{schema}, sequence_id long, offset long"
    )
    return placed.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
        *["ids"] * with_ids,
    )
