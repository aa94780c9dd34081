import random
import re
from collections import Counter

import pyarrow as pa
from conftest import as_files, prose

from datashelf.llm import phrases
from datashelf.llm.phrases import TOTAL, chunks, collocations, phrase_counts


def pieces_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in (re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", low)) if w]


def counted(rows, longest=3):
    f = Counter()
    for lang, text in rows:
        for w in pieces_of(text):
            f[lang or "und", TOTAL] += len(w)
            for size in range(1, longest + 1):
                f.update((lang or "und", " ".join(w[i : i + size])) for i in range(len(w) - size + 1))
    return f


def brute(rows, longest=3, min_count=10, contained_percent=50, top=2000):
    f = counted(rows, longest)
    found = {k: a for k, a in f.items() if k[1].count(" ") and a >= min_count}
    out = {}
    for (lang, phrase), a in found.items():
        inside = [b for (other, long), b in found.items() if other == lang and long.count(" ") > phrase.count(" ") and f" {phrase} " in f" {long} "]
        if any(100 * b >= contained_percent * a for b in inside):
            continue
        w = phrase.split(" ")
        cuts = [(f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]) for k in range(1, len(w))]
        score, k = min((1_000_000 * a * a // (x * y), k) for k, (x, y) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, a, *cuts[k], f[lang, TOTAL], score))
    return {(lang, i, *r[3:]) for lang, rs in out.items() for i, r in enumerate(sorted(rs)[:top], 1)}


def as_rows(df, **kw):
    return [tuple(r) for r in collocations(df, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]


def checked(spark, rows, **kw):
    df = as_files(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    got = as_rows(df, **kw)
    assert len(set(got)) == len(got)
    assert set(got) == brute(rows, **kw)
    return got


def test_against_plain_counting(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(12)] + ["Ab", "aB", "é", "É", "x-y"]
    rows = [(rng.choice(["en", "a\tb", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n"]) for _ in range(rng.randint(0, 60)))) for _ in range(400)]
    assert len(checked(spark, rows)) > 100
    assert checked(spark, rows, top=7) and checked(spark, rows, longest=4, top=None, contained_percent=80, min_count=5)


def test_the_given_documents(documents):
    rows = [(r["lang"], r["text"]) for r in documents.select("lang", "text").collect()]
    assert set(as_rows(documents)) == brute(rows)


def test_words_of_many_pieces_are_counted_at_once(monkeypatch):
    """Counting piece by piece took twice the time."""
    calls = []

    class Told(Counter):
        def update(self, *args, **kw):
            calls.append(len(self))
            super().update(*args, **kw)

    rng = random.Random(8)
    rows = [(rng.choice(["en", "de"]), "".join(f"w{rng.randrange(50)}" + rng.choice(" .,;:!?\n\v\f\r\t") for _ in range(300))) for _ in range(200)]
    batch = pa.record_batch([pa.array([r[i] for r in rows]) for i in (0, 1)], names=["lang", "text"])
    monkeypatch.setattr(phrases, "Counter", Told)
    got = Counter()
    for out in phrases.count_words([batch]):
        for r in out.to_pylist():
            got[r["lang"], r["phrase"]] += r["f"]
    assert got == counted(rows, 1)
    assert len(calls) < 30 < sum(len(pieces_of(t)) for _, t in rows)


def test_chunks_cover_every_run_once():
    rng = random.Random(1)
    for overlap in (1, 2, 3):
        for size in range(0, 60):
            words = [f"{rng.randrange(6)}".encode() for _ in range(size)]
            if not words:
                continue
            parsed = [(c.split(b" "), last) for c, last in chunks(words, overlap, 3)]
            assert [last for _, last in parsed] == [False] * (len(parsed) - 1) + [True]
            own = [c if last else c[: len(c) - overlap] for c, last in parsed]
            assert [w for c in own for w in c] == words
            for (c, _), (d, _) in zip(parsed, parsed[1:]):
                assert c[-overlap:] == d[:overlap]


def test_equal_runs_are_parsed_alike():
    words = prose(4, 300).encode().split()
    whole = {c for c, last in chunks(words, 2, 8) if not last}
    shifted = {c for c, last in chunks(words[150:], 2, 8) if not last}
    assert len(shifted - whole) <= 1 and len(shifted) > 5


def test_copies_are_counted_by_their_number(spark):
    rows = [("en", prose(9, 500))] * 2_000 + [("en", prose(8, 40))]
    df = as_files(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    got = {(r["lang"], r["phrase"]): r["f"] for r in phrase_counts(df, lang_col="lang", text_col="text", longest=3, min_count=1, bits=1 << 15).collect()}
    assert got == dict(counted(rows))


def test_one_long_text_and_a_frequent_phrase(spark):
    rows = [("en", prose(1, 250_000)), ("en", "of the " * 30_000), *[("en", f"of the {prose(i, 5)}") for i in range(3_000)]]
    assert len(rows[0][1]) > 1_000_000
    checked(spark, rows, top=50)


def test_a_filter_has_the_bits_of_its_hashes(spark):
    import numpy as np

    from datashelf.llm.phrases import Filter

    rng = random.Random(6)
    codes = np.array([rng.getrandbits(64) for _ in range(3_000)] + [0, 1, 32767, 32768, 65535, 2**64 - 1], np.uint64)
    inside, outside = codes[::2], codes[1::2]
    held = Filter(spark.createDataFrame([(int(c),) for c in inside.view(np.int64)], "code long"), 1 << 17)
    bits = {int(c) % (1 << 17) for c in inside}
    assert held.holds(inside).all()
    assert held.holds(outside).tolist() == [int(c) % (1 << 17) in bits for c in outside]


def test_a_full_filter_only_costs_time(documents):
    from datashelf.llm.phrases import phrase_counts as counts

    few, many = (
        {tuple(r) for r in counts(documents, lang_col="lang", text_col="text", longest=3, min_count=10, bits=b).collect()} for b in (1 << 15, 1 << 22)
    )
    assert few == many


def test_large_counts_stay_exact(spark):
    import datashelf.llm.phrases as phrases

    from datashelf.session import fresh_folder

    a, left, right = 987_654_321_012, 987_654_321_987, 999_999_999_989
    counts = spark.createDataFrame([("en", TOTAL, 5 * 10**13), ("en", "a b", a), ("en", "a", left), ("en", "b", right)], "lang string, phrase string, f long")
    folder = fresh_folder(spark, "counts")
    counts.write.parquet(folder)
    original = phrases.phrase_counts
    phrases.phrase_counts = lambda *_, **__: spark.read.parquet(folder)
    try:
        got = collocations(counts.selectExpr("lang", "phrase as text")).first()
    finally:
        phrases.phrase_counts = original
    assert got["score"] == 1_000_000 * a * a // (left * right)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert set(as_rows(odd_docs)) == brute([(r[2], r[1]) for r in odd_rows])
    assert collocations(no_docs).count() == 0
