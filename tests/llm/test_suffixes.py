"""Byte-exact substring removal against a table of all windows."""

import hashlib
from collections import Counter

import numpy as np
from conftest import as_files, prose

from datashelf.llm import suffixes


def brute(rows, length):
    seen, data = Counter(), [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(df, **options):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r[n] for n in names) for r in suffixes.drop_repeated_bytes(df, **options).collect()), key=str)


def test_documents(documents, texts):
    assert run(documents) == brute(texts, 200)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert run(odd_docs) == brute([r[:2] for r in odd_rows], 200)
    assert run(no_docs) == []
    left = {r["doc_id"]: r["text"] for r in suffixes.drop_repeated_bytes(odd_docs).collect()}
    assert left[1] is None and left[2] == "" and left[4] == left[5] == "" and left[8].startswith("Été")


def planted(spark):
    shared, tail = prose(20, 120), prose(21, 60)
    rows = [(i, prose(30 + i, 20 + i) + " " + shared[i * 3 :] + (tail if i % 2 else " " + tail[: 40 * i])) for i in range(9)]
    rows += [(50, "ab" * 700), (51, "é" * 300), (52, "x" + "é" * 150), (53, prose(40, 80) * 2)]
    return rows, as_files(spark.createDataFrame(rows, "doc_id long, text string"))


def test_overlaps_periods_and_multibyte(spark):
    rows, df = planted(spark)
    assert run(df) == brute(rows, 200)


def test_hot_anchors_take_the_other_way(spark, monkeypatch):
    rows, df = planted(spark)
    monkeypatch.setattr(suffixes, "HOT_BYTES", 500)
    assert run(df) == brute(rows, 200)


def test_small_batches(spark):
    pieces = [prose(i, 80).encode() + prose(99, 60).encode() for i in range(6)]
    with np.errstate(over="ignore"):
        hits = suffixes.repeated_starts(pieces, [len(p) - 199 for p in pieces], 200)
    want = Counter(p[i : i + 200] for p in pieces for i in range(len(p) - 199))
    assert [list(h) for h in hits] == [[want[p[i : i + 200]] > 1 for i in range(len(p) - 199)] for p in pieces]


def test_difference_cover_sorts_suffixes():
    rng = np.random.default_rng(3)
    for _ in range(200):
        text = rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(1, 70)))
        ranks = suffixes.difference_cover_ranks(text, 10**6)
        assert np.argsort(ranks).tolist() == sorted(range(len(text)), key=lambda i: tuple(text[i:]))


def test_long_texts_are_cut_in_blocks(monkeypatch):
    data = prose(7, 900).encode()
    with np.errstate(over="ignore"):
        whole = suffixes.anchors(data, 200, 64)
        monkeypatch.setattr(suffixes, "PLACE_BITS", 9)
        parts = suffixes.anchors(data, 200, 64)
    assert parts[1][-1] == whole[1][-1] == len(data) - 199 and (parts[0][1:] == parts[1][:-1]).all()
