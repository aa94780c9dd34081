"""Pieces, ids and places of packed documents."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from datashelf.llm.packing import BYTE_SIGNS, END_ID, Encoder, fullest, pack_ids, minimum_bin_slack, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(df, rows, capacity):
    plain = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    total = 0
    for d, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, END_ID]
        total += len(ids)
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b])] += 1
    got, places = defaultdict(int), defaultdict(list)
    for r in pack(df, PATH, capacity=capacity, with_ids=True).collect():
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])] += 1
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), -(-total // capacity)


@pytest.mark.parametrize("capacity", [2048, 256])
def test_documents(documents, texts, capacity):
    used, least = check(documents, texts, capacity)
    assert used <= least * 1.01 + 1


def test_odd_rows(odd_docs, odd_rows, no_docs):
    used, least = check(odd_docs, [r[:2] for r in odd_rows], 2048)
    assert used <= least + 1
    assert pack(no_docs, PATH).count() == 0


def test_parts_give_the_ids_of_whole_texts():
    plain = Tokenizer.from_file(PATH)
    texts = ["", " ", "  two", "a  b", "a \n b", "tab\t x", "é à x y", "don't 12,5 !! ", " lead", "x  y z", "a b\n", "\n\nc d"]
    texts += [" trail ", "\u00a0x \u2003 y\x1fz", "<|endoftext|> a", "x<|endoftext|>", "日本 語。 ok", "\r\n a\tb c's 'll"]
    encoder = Encoder(plain)
    for t in texts:
        assert encoder.encode(t) == pack_ids(plain.encode(t, add_special_tokens=False).ids), t


def test_ascii_pre_tokens_are_mapped_without_a_table():
    """Printable ASCII is what nearly all words are; a look-up for each of its characters took a fifth of the time."""

    class Model:
        def tokenize(self, mapped):
            seen.append(mapped)
            return []

    class Untranslated(str):
        def encode(self, *args):
            raise AssertionError(f"table used for {self!r}")

    encoder, seen = Encoder(Tokenizer.from_file(PATH)), []
    encoder.tokenizer = type("T", (), {"model": Model()})()
    for text in map(Untranslated, [" word", "don't", "~!", " 12", *(chr(c) for c in range(32, 127))]):
        encoder.token(text)
    table = {b: BYTE_SIGNS.get(b, chr(b)) for b in range(256)}
    assert seen[4:] == [table[c] for c in range(32, 127)] and seen[0] == table[32] + "word"
    for text in ["\x7f", "\n", " \t", "é", " é"]:
        encoder.token(text)
        assert seen[-1] == "".join(table[b] for b in text.encode())


def test_fullest_is_the_subset_sum_optimum():
    rng = np.random.default_rng(1)
    for _ in range(60):
        counts = np.zeros(41, np.int64)
        for length in rng.integers(1, 41, 6):
            counts[length] += 1
        room = int(rng.integers(1, 41))
        sums = {0}
        for length in np.repeat(np.arange(41), counts):
            sums |= {s + length for s in sums if s + length <= room}
        taken = fullest(counts, room)
        assert sum(k * n for k, n in taken.items()) == max(sums)
        assert all(n <= counts[k] for k, n in taken.items())


def test_bins_use_every_item_once():
    counts = np.zeros(101, np.int64)
    counts[[3, 40, 60, 97, 100]] = [10_000_000, 5, 7, 9, 2]
    bins = minimum_bin_slack(counts)
    used = np.zeros(101, np.int64)
    for times, taken in bins:
        assert sum(k * n for k, n in taken.items()) <= 100
        for k, n in taken.items():
            used[k] += times * n
    assert (used == counts).all() and len(bins) < 20
