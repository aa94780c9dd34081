import hashlib
import math
import random
import re
import zlib

from conftest import as_files, prose

from datashelf.llm.resample import resample


def features(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, target, buckets=10_000, percent=25, min_words=20):
    def counts(texts):
        n = [0] * buckets
        for t in texts:
            for f in features(t)[1]:
                n[zlib.crc32(f.encode()) % buckets] += 1
        return n

    s, t = counts(x for _, x in docs), counts(target)
    gains = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t)]
    rows = []
    for i, (doc_id, text) in enumerate(docs):
        words, found = features(text)
        weight = sum(gains[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words), i])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[6]))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def drawn(df, target, **kw):
    return sorted((tuple(r) for r in resample(df, target, **kw).drop("row").collect()), key=str)


def benchmark(spark, texts):
    return as_files(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string"))


def test_the_given_documents(spark, documents, texts):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [r["text"] for r in target.collect()]
    got = drawn(documents, target)
    assert got == brute(texts, items)
    assert sum(r[4] is not None for r in got) > 20


def test_other_parameters_and_separators(spark):
    rng = random.Random(2)
    docs = [(i, "".join(rng.choice("ab cÉé.-1\t\n  ") for _ in range(rng.randint(0, 80)))) for i in range(300)]
    items = ["a b c", "É é a-b", None, ""]
    df = as_files(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    kw = dict(buckets=101, percent=60, min_words=5)
    assert drawn(df, benchmark(spark, items), **kw) == brute(docs, items, **kw)


def test_drawn_documents_look_like_the_target(spark):
    docs = [(i, prose(i, 60) if i % 10 else " ".join(f"t{(i + j * 7) % 50}" for j in range(60))) for i in range(1_000)]
    items = [" ".join(f"t{(i + j * 7) % 50}" for j in range(40)) for i in range(50)]
    df = as_files(spark.createDataFrame(docs, "doc_id long, text string"))
    ranks = {r[0]: r[4] for r in drawn(df, benchmark(spark, items), percent=10)}
    assert sum(rank is not None for i, rank in ranks.items() if i % 10 == 0) > 40  # of 100 drawn, where 10 would be chance


def test_a_long_text_a_long_word_and_many_copies(spark):
    docs = [(0, prose(1, 250_000)), (1, "x" * 1_000_000), *[(i, prose(5, 30)) for i in range(2, 2_000)]]
    df = as_files(spark.createDataFrame(docs, "doc_id long, text string"))
    assert drawn(df, benchmark(spark, [prose(5, 25)])) == brute(docs, [prose(5, 25)])


def test_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    docs = [(r[0], r[1]) for r in odd_rows]
    target = benchmark(spark, [prose(3, 30)])
    assert drawn(odd_docs, target) == brute(docs, [prose(3, 30)])
    assert drawn(odd_docs, target.limit(0)) == brute(docs, [])
    assert drawn(no_docs, target) == []
