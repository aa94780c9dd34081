import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from datashelf.llm.sharding import kd_shards, number_position, shard_documents


def check(df, rows, shards=8):
    got = shard_documents(df, shards).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    sizes, largest = Counter(), max((r["size"] for r in got), default=0)
    for s in {r["shard"] for r in got}:
        own = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own))) and 0 <= s < shards
        sizes[s] = sum(r["size"] for r in own)
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    return sizes, largest


@pytest.mark.parametrize("shards", [1, 5, 8])
def test_sizes_are_near_equal(documents, texts, shards):
    sizes, largest = check(documents, texts, shards)
    assert len(sizes) == shards
    assert max(sizes.values()) - min(sizes.values()) <= 4 * largest


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(odd_docs, [r[:2] for r in odd_rows])
    assert shard_documents(no_docs).count() == 0


def test_equal_rows_are_divided(spark):
    from conftest import as_files

    same = as_files(spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit("x").alias("text"), F.lit(None).cast("string").alias("lang")))
    out = kd_shards(same, {"lang": F.col("lang")}, F.lit(10), shards=8)
    assert {r["n"] for r in out.groupBy("shard").agg(F.count("*").alias("n")).collect()} == {500}


def test_splits_follow_the_widest_dimension(spark):
    from conftest import as_files

    grid = as_files(spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 20).alias("x"), F.floor(F.col("id") / 20).alias("y")))
    out = kd_shards(grid, {"x": number_position("x"), "y": number_position("y")}, F.lit(1), target_bytes=100)
    boxes = out.join(grid, "doc_id").groupBy("shard").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in "xy" for f in (F.min, F.max)])
    found = sorted((r["min_x"], r["max_x"], r["min_y"], r["max_y"]) for r in boxes.collect())
    assert found == [(0, 9, 0, 9), (0, 9, 10, 19), (10, 19, 0, 9), (10, 19, 10, 19)]


def plain_tree(rows, shards):
    """The tree by recursion over (id, size, values) in memory."""
    def spread(some, d):
        return max(r[2][d] for r in some) - min(r[2][d] for r in some)

    whole = [spread(rows, d) or 1 for d in range(len(rows[0][2]))]
    out = {}

    def cut(some, leaves, shard):
        if leaves == 1 or not some:
            out.update({r[0]: shard for r in some})
            return
        shares = [spread(some, d) / w for d, w in enumerate(whole)]
        widest = shares.index(max(shares))
        left, total, ahead, sides = leaves // 2, sum(r[1] for r in some), 0, ([], [])
        for r in sorted(some, key=lambda r: (r[2][widest], r[0])):
            sides[not ahead + r[1] / 2 < total * left / leaves].append(r)
            ahead += r[1]
        cut(sides[0], left, shard)
        cut(sides[1], leaves - left, shard + left)

    cut(rows, shards, 0)
    return out


@pytest.mark.parametrize("shards", [2, 7, 8])
def test_same_tree_as_in_memory_with_names_that_begin_alike(spark, shards):
    from conftest import as_files

    names = [None, "", *[f"https://archive.example.org/collection/{k:02}" for k in range(9)], "z" * 3000]
    rows = [(i, 1 + i * i % 97, names[i * 7 % 12], i * 31 % 50 if i % 9 else None) for i in range(600)]
    docs = as_files(spark.createDataFrame(rows, "doc_id long, size long, name string, age int"))
    out = kd_shards(docs, {"name": F.col("name"), "age": number_position("age")}, F.col("size"), shards=shards)
    place = {n: k for k, n in enumerate(sorted(n for n in names if n is not None))} | {None: -1}
    plain = plain_tree([(i, s, (place[n], -1 if a is None else a)) for i, s, n, a in rows], shards)
    assert {r["doc_id"]: r["shard"] for r in out.collect()} == plain
