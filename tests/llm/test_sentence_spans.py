import random
import re
from collections import defaultdict

from conftest import as_files, prose

from datashelf.llm.sentence_spans import SPAN_WORDS, drop_repeated_spans

ENDS = r"[.!?,;:]+(?=[ \t\n\r])|[。！？，；：、।۔؟؛]+|\n|\Z"
PIECE = re.compile(rf"(?s).+?(?:{ENDS})[ \t\n\r]*")


def brute(rows, words=SPAN_WORDS):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    pieces = [PIECE.findall(t or "") for _, t in rows]
    assert ["".join(p) for p in pieces] == [t or "" for _, t in rows]
    runs = defaultdict(list)
    for i in order:
        plain = [p.strip(" \t\r\n") for p in pieces[i]]
        for at in range(len(plain)):
            n = next((n for n in range(1, len(plain) - at + 1) if sum(max(len(s.split()), 1) for s in plain[at : at + n]) >= words), None)
            if n or not at:
                n = n or len(plain)
                runs[tuple(plain[at : at + n])].append((i, at, n))
    gone = defaultdict(set)
    for places in runs.values():
        for i, at, n in places[1:]:
            gone[i] |= set(range(at, at + n))
    return sorted(
        ((d, len(pieces[i]), len(gone[i]), None if t is None else "".join(p for k, p in enumerate(pieces[i]) if k not in gone[i]))
         for i, (d, t) in enumerate(rows)), key=str,
    )


def run(df, **options):
    names = ["doc_id", "n_sentences", "n_removed", "text"]
    return sorted((tuple(r[n] for n in names) for r in drop_repeated_spans(df, **options).collect()), key=str)


def test_documents(documents, texts):
    assert run(documents) == brute(texts)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert run(odd_docs) == brute([r[:2] for r in odd_rows])
    assert run(no_docs) == []


def test_spans_within_and_across(spark):
    rows = [
        (2, "A b. C d! E f? G h.\nI j. K l."), (1, "X. C d! E f? G h. Y."), (3, "A. A. A. A. A."), (4, "E f? G h. I j. K l. Z."),
        (5, "C d!\n\nE f?  G h."), (6, "short. one."), (7, "short. one."), (8, "一二三。四五六！七八。九"), (9, "一二。四五六！七八。九"),
    ]
    df = as_files(spark.createDataFrame(rows, "doc_id long, text string"))
    for words in (1, 2, 3, 6, 16):
        assert run(df, words=words) == brute(rows, words)


def sentences(rng, n):
    return " ".join(prose(rng.randrange(10**9), rng.randint(3, 14)) + rng.choice([".", "!", ",", ";"]) for _ in range(n))


def test_passages_cut_at_any_word_are_caught(spark):
    rng = random.Random(7)
    rows, planted = [], []
    for i in range(200):
        source = sentences(rng, 40).split()
        at = rng.randrange(len(source) - 60)
        rows.append((2 * i, " ".join(source)))
        if i % 2:
            passage = " ".join(source[at : at + 52])
            planted.append(2 * i + 1)
            rows.append((2 * i + 1, f"{prose(5_000 + i, 33)} {passage} {prose(9_000 + i, 20)}. {sentences(rng, 5)}"))
    df = as_files(spark.createDataFrame(rows, "doc_id long, text string"))
    removed = {r[0]: r[2] for r in run(df)}
    assert sum(removed[i] > 0 for i in planted) >= 0.95 * len(planted)
    assert not any(n for i, n in removed.items() if i not in planted)


def test_long_texts_and_a_sentence_of_most_documents(spark):
    rng = random.Random(1)
    long = sentences(rng, 20_000)
    frequent = "This one sentence of many words stands in a third of all the documents that there are in here, word for word."
    rows = [(0, long), (1, long), (2, "x" * 1_000_000), (3, "a. " * 300_000)]
    rows += [(i, f"{sentences(rng, 3)} {frequent if i % 3 else ''} {sentences(rng, 3)}") for i in range(4, 3_000)]
    assert len(long) > 1_000_000 // 2
    df = as_files(spark.createDataFrame(rows, "doc_id long, text string"))
    assert run(df) == brute(rows)
