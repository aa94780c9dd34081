"""MinHash classes against all pairs."""

import random

import numpy as np
from conftest import as_files, prose

from datashelf.llm.common import components
from datashelf.llm.near_dup import WordHashes, _prefix_pairs, near_duplicates, shingle_set


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def classes(rows):
    """component of each row by brute force: place -> smallest id"""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return [(d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def check(df, rows):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted(classes(rows), key=str)


def test_documents(documents, texts):
    check(documents, texts)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(odd_docs, [r[:2] for r in odd_rows])
    assert near_duplicates(no_docs).count() == 0
    kept = {(r["doc_id"], r["kept"]) for r in near_duplicates(odd_docs).collect()}
    assert {(4, True), (5, False), (6, True), (None, True), (1, True), (2, True)} <= kept


def test_chains_and_groups_of_near_copies(spark):
    """Chains of documents each near only its neighbours, and a group in which single words differ."""
    rng, rows = random.Random(5), []
    words = prose(9, 240).split()
    for i in range(12):  # a window that moves: neighbours share enough, others do not
        rows.append((100 + i, " ".join(words[i * 12 : i * 12 + 100])))
    base = prose(10, 120).split()
    for i in range(60):
        changed = list(base)
        for _ in range(rng.randrange(4)):
            changed[rng.randrange(len(changed))] = f"other{rng.randrange(9)}"
        rows.append((i, " ".join(changed)))
    rng.shuffle(rows)
    check(as_files(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_link_within_large_buckets_of_other_classes(spark):
    """Two documents near only each other share their buckets with ten larger classes."""
    common, rows = prose(20, 200), []
    for k in range(10):
        for i in range(30):
            rows.append((len(rows), f"{common} {prose(30 + k, 50)} a{k} b{i}"))
    rows += [(900 + i, f"{common} {prose(1024 + i, 28)}") for i in range(2)]
    want = {d: c for d, _, c in classes(rows)}
    assert want[901] == 900 and len(set(want.values())) == 11
    check(as_files(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_copies_that_are_not_near_each_other_are_no_candidates(spark):
    """200 copies of a text with four words changed in each, of which few pairs are near: 19,900 pairs share rare shingles."""
    rng, rows, base = random.Random(6), [], prose(11, 150).split()
    for i in range(200):
        changed = list(base)
        for at in rng.sample(range(30), 4) if i < 20 else rng.sample(range(150), 4):
            changed[at] = f"other{i}-{at}"
        rows.append((i, " ".join(changed)))
    sets = [shingles(t) for _, t in rows]
    links = {(i, j) for j in range(200) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    nodes = as_files(spark.createDataFrame([(i, i, len(s)) for i, s in enumerate(sets)], "node long, label long, n long"))
    texts = as_files(spark.createDataFrame(rows, "row long, text string"))
    found = {tuple(r) for r in _prefix_pairs(nodes, texts, 75).collect()}
    assert links and links <= found and len(found) < len(links) + 200


def test_shingles_are_exact():
    with np.errstate(over="ignore"):
        assert len(shingle_set("A b c d e f A B C D E F", WordHashes())) == 6
        assert len(shingle_set("a b c", WordHashes())) == 1 and len(shingle_set(" \n", WordHashes())) == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (60, 60)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(31)} | {(40, 40), (50, 40), (60, 60)}
