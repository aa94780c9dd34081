import random
import re
from itertools import combinations

from conftest import as_files, prose

from datashelf.llm import decontaminate as D


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(rows, items):
    """(place of the document, item) of all verified hits."""
    out = set()
    for i, (_, t) in enumerate(rows):
        a = words(t)
        for item, u in items:
            b = words(u)
            for masks in [D.MASKS] if len(b) >= len(D.MASKS[0]) else [("1" * len(b),)] if len(b) >= D.SHORTEST_ITEM else []:
                span = len(masks[0])
                for p in range(len(a) - span + 1):
                    for q in range(len(b) - span + 1):
                        if not any(all(m == "0" or a[p + k] == b[q + k] for k, m in enumerate(mask)) for mask in masks):
                            continue
                        before = min(D.AROUND, p, q)
                        after = min(D.AROUND, len(a) - p - span, len(b) - q - span)
                        same = [a[p + k] == b[q + k] for k in range(-before, span + after)]
                        w = min(len(same), D.VERIFIED_WORDS)
                        if max(sum(same[s : s + w]) for s in range(len(same) - w + 1)) * 100 >= w * D.MIN_PERCENT:
                            out.add((i, item))
    return out


def planted():
    rng, items, rows = random.Random(8), [], []
    for i in range(6):
        items.append((i, prose(100 + i, 40)))
    items += [(6, items[0][1].upper()), (7, "one two three four five six"), (8, "too short"), (9, None), (None, prose(200, 30))]
    for i in range(20):
        own = prose(300 + i, 60).split()
        leak = (items[i % 6][1] if i % 7 else items[10][1]).split()[i % 5 :]
        for _ in range(i % 6):
            leak[rng.randrange(len(leak))] = "changed"
        rows.append((i, " ".join(own[:30] + (leak if i % 3 else []) + own[30:])))
    rows += [(50, "Say: one, two; THREE four five six!"), (51, "one two three four five"), (52, " ".join(prose(100, 40).split()[:11])), (53, "too short")]
    return rows, items


def test_planted_passages(spark):
    rows, items = planted()
    docs = as_files(spark.createDataFrame(rows, "doc_id long, text string"))
    tests = as_files(spark.createDataFrame(items, "item_id long, text string"))
    want = brute(rows, [x for x in items if x[0] != 6])  # 6 has the words of 0
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, tests).collect()}
    assert got == {(rows[i][0], item) for i, item in want}
    flags = {r["doc_id"]: r["contaminated"] for r in D.decontaminate(docs, tests).collect()}
    assert flags == {d: any(j == i for j, _ in want) for i, (d, _) in enumerate(rows)}
    assert flags[50] and not flags[51] and not flags[53]


def overlaps(a, b):
    """Whether words of a and of item b agree as verified, at any distance, without looking at seeds."""
    least = min(len(b), len(D.MASKS[0]))
    for shift in range(least - len(b), len(a) - least + 1):
        same = [a[shift + q] == b[q] for q in range(len(b)) if 0 <= shift + q < len(a)]
        w = min(len(same), D.VERIFIED_WORDS)
        if max(sum(same[s : s + w]) for s in range(len(same) - w + 1)) * 100 >= w * D.MIN_PERCENT:
            return True
    return False


def test_every_verified_overlap_is_found(spark):
    """Items and parts of items with all patterns of changed words."""
    items, rows, whole = [], [], prose(90, 40).split()
    items.append((0, " ".join(whole)))
    cases = [(0, whole[7:23], 3)]  # a part of a longer item
    for n in (*range(5, 17), 20):
        items.append((n, prose(400 + n, n)))
        cases.append((n, items[-1][1].split(), 3 if n >= 15 else 2))
    for item, own, most in cases:
        for k in range(1, most + 1):
            for gone in combinations(range(len(own)), k):
                leak = " ".join("changed" if i in gone else w for i, w in enumerate(own))
                rows.append((len(rows), f"some words {leak} and more of them"))
    want = {(d, i) for d, t in rows for i, u in items if overlaps(words(t), words(u))}
    docs = as_files(spark.createDataFrame(rows, "doc_id long, text string"))
    tests = as_files(spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, tests).collect()} == want


def test_blocks_of_seeds(spark, monkeypatch):
    rows, items = planted()
    docs = as_files(spark.createDataFrame(rows, "doc_id long, text string"))
    tests = as_files(spark.createDataFrame(items, "item_id long, text string"))
    whole = sorted(map(tuple, D.decontaminate(docs, tests).collect()))
    monkeypatch.setattr(D, "BLOCK_ROWS", 100)
    assert sorted(map(tuple, D.decontaminate(docs, tests).collect())) == whole


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    tests = as_files(spark.createDataFrame([(0, odd_rows[4][1][4000:4400])], "item_id long, text string"))
    got = {r["doc_id"]: r["contaminated"] for r in D.decontaminate(odd_docs, tests).collect()}
    assert D.decontaminate(odd_docs, tests).count() == len(odd_rows)
    assert {d for d, flag in got.items() if flag} == {4, 5}
    empty = as_files(tests.limit(0))
    assert D.decontaminate(odd_docs, empty).filter("contaminated").count() == 0
    assert D.decontaminate(no_docs, tests).count() == 0


def test_documents(spark, documents, texts):
    tests = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = [" " + " ".join(words(r["text"])) + " " for r in tests.collect()]
    want = {d for d, t in texts if any(w in " " + " ".join(words(t)) + " " for w in whole)}
    flagged = {r["doc_id"] for r in D.decontaminate(documents, tests).filter("contaminated").collect()}
    assert want <= flagged
