import re
import time

from conftest import as_files

from datashelf.llm.licenses import BASE, LICENSES, TEXT_RULES, detections, license_scan, rules

NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]


def brute(rows):
    out = []
    for d, t in rows:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        hits = [(i, label) for i in range(len(words)) for p, label in BASE.items() if words[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in hits]
        out.append((d, len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r[n] for n in NAMES) for r in license_scan(df).collect()), key=str)


def test_documents(documents, texts):
    assert run(documents) == brute(texts)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert run(odd_docs) == brute([r[:2] for r in odd_rows])
    assert license_scan(no_docs).count() == 0


ROWS = [
    (1, "MIT License"), (2, "mit\n--license and Apache  (License)"), (3, "emit license, mit licenses, mıt license"),
    (4, "GNU General Public License, version 3."), (5, "Éapache license É apache, license"), (6, "mit license " * 300),
    (7, "Licensed under CC BY-NC 4.0."), (8, "SPDX-License-Identifier: BSD-3-Clause"), (9, "released under the Apache License, Version 2.0"),
    (10, "Permission is hereby granted,\nfree of charge, to any person obtaining a copy"), (11, "nothing here"),
    (12, "licensed under the CC BY-NC-SA 4.0"), (13, "general public mit license apache license"),
]


def test_base_and_method_labels(spark):
    df = as_files(spark.createDataFrame(ROWS, "doc_id long, text string"))
    assert run(df) == brute(ROWS)
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(df).collect()}
    assert labels[7] == ("cc-by-nc", 0.95) and labels[8] == ("bsd", 1.0) and labels[10] == ("mit", 1.0)
    assert labels[12][0] == "cc-by-nc-sa" and labels[11] == ("", 0.0) and labels[4][0] == "gpl" and labels[1] == ("mit", 1.0)


def test_contained_detections_are_suppressed(spark):
    df = as_files(spark.createDataFrame(ROWS, "doc_id long, text string"))
    found = {}
    for r in detections(df).collect():
        found.setdefault(r["doc_id"], []).append((r["label"], r["first"], r["last"], r["priority"]))
    assert found[9] == [("apache", 0, 46, 2)]  # not the name within it
    assert [x[0] for x in found[4]] == ["gpl"]
    for spans in found.values():
        for a in spans:
            assert not any(b != a and b[1] <= a[1] and b[2] >= a[2] and b[3] >= a[3] and (b[1:] != a[1:] or b[0] < a[0]) for b in spans)


def test_rules_match_alone_as_they_do_together(spark):
    """Every detection is a match of some rule, and the keyword gate hides none."""
    df = as_files(spark.createDataFrame(ROWS, "doc_id long, text string"))
    texts = dict(ROWS)
    translate = lambda p: p.replace("(?i)", "")
    want = {}
    for label, pattern, _, priority, _ in rules():
        for d, t in texts.items():
            for m in re.finditer(translate(pattern), t, re.I | re.A):
                want.setdefault(d, set()).add((label, m.start(), m.end(), priority))
    for r in detections(df).collect():
        assert (r["label"], r["first"], r["last"], r["priority"]) in want[r["doc_id"]]
    assert {d for d in want} == {r["doc_id"] for r in detections(df).collect()}
    assert len(rules()) > 300


def test_white_space_of_any_kind_between_words(spark):
    """Texts of every rule with a line break, two blanks or a tab at each gap."""
    texts = [(label, re.sub(r"\(\?:([^|)]*)[^)]*\)\??|\[(.)[^]]*\]", r"\1\2", pattern)) for label, pattern, *_ in TEXT_RULES]
    for label, _, names, _ in LICENSES:
        texts += [(label, f"licensed under the terms of the {name} license") for name in names]
    rows, want = [], {}
    for label, text in texts:
        for gap in re.finditer(" ", text):
            for space in ("\n", "  ", "\t", "\r\n "):
                want[len(rows)] = label
                rows.append((len(rows), text[: gap.start()] + space + text[gap.end() :]))
    df = as_files(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {}
    for r in detections(df).collect():
        got.setdefault(r["doc_id"], set()).add(r["label"])
    assert [rows[d] for d, label in want.items() if label not in got.get(d, ())] == []


def test_many_mentions_in_one_text(spark):
    rows = [(1, "MIT License. " * 20_000), (2, "x " + "Apache License, mit license; " * 10_000 + "y z")]
    df = as_files(spark.createDataFrame(rows, "doc_id long, text string"))
    started = time.monotonic()
    got = {r["doc_id"]: r for r in license_scan(df).collect()}
    assert time.monotonic() - started < 30
    assert [got[1][n] for n in NAMES] == [1, 40_000, 20_000, 0, 39_998, "mit"]
    assert [got[2][n] for n in NAMES] == [2, 40_003, 20_000, 1, 39_999, "apache,mit"]
    assert detections(df).filter("doc_id = 1").count() == 20_000
