"""The five stages against brute force, one on the other."""

from collections import Counter

import corpus_pipeline as P
import public_tokenizers
from pyspark.sql import functions as F
from test_decontaminate import brute as leaks_of
from test_near_dup import classes
from test_packing import check
from test_suffixes import brute as windows_of

from conftest import as_files

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = as_files(stage(spark, docs, SF))
        assert docs.columns == P.COLUMNS
        after = {r["doc_id"]: r for r in docs.collect()}
        rows = [(d, r["text"]) for d, r in before.items()]
        if name == "language_id":
            assert {d for d in before if d not in after} <= {d for d, t in rows if sum(c.isalpha() for c in t or "") < 40}
        if name == "near_dedup":
            assert set(after) == {d for d, _, c in classes(rows) if d == c}
        if name == "substring_dedup":
            want = {d: (n, gone) for d, n, gone, _, _ in windows_of(rows, 200)}
            assert set(after) == {d for d, (n, gone) in want.items() if not gone or gone < n}
            for d, r in after.items():
                n, gone = want[d]
                assert 0 <= n - gone - len(r["text"].encode()) <= 6 * n and r["n_chars"] == len(r["text"])
                assert gone or r == before[d]
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            near = [(d, t) for d, t in rows]
            bad = {near[i][0] for i, _ in leaks_of(near, items)} if len(near) < 60 else None
            assert bad is None or set(after) == set(before) - bad
            assert all(after[d] == before[d] for d in after)
    used, least = check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert used <= least * 1.01 + 1


def test_run_is_the_stages_one_after_another(spark):
    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert Counter(r["piece"] for r in got.collect())[0] > 100
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_odd_rows(spark, odd_docs, no_docs):
    columns = odd_docs.select(P.COLUMNS)
    for start in (as_files(columns), as_files(no_docs.select(P.COLUMNS))):
        docs = start
        for _, stage in P.STAGES:
            docs = as_files(stage(spark, docs, SF))
    assert docs.count() == 0
    kept = as_files(P.near_dedup(spark, as_files(columns), SF))
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([None, 1, 2, 3, 4, 6, 7, 8, 9, 10])
