import numpy as np
import pytest
from conftest import as_files

from datashelf.llm import vantage


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, np.array(v, np.float32).astype(float))
    ids = np.array(sorted(ok))
    x = np.stack([ok[i] for i in ids])
    out = {}
    for i in ids[ids % every == 0]:
        score = (x * ok[i]).sum(1)
        order = [j for j in np.lexsort([ids, -score]) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def run(df, **options):
    out = {}
    for r in sorted(vantage.nearest(df, **options).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want])


def clusters(n, seed=0, spread=0.05, norms=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, n)] + rng.normal(size=(n, 16)) * spread
    if norms:
        x *= rng.uniform(0.2, 3, (n, 1))
    return [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("norms", [False, True])
def test_factor_one_is_exact(spark, monkeypatch, norms):
    monkeypatch.setattr(vantage, "CELL_ROWS", 200)
    monkeypatch.setattr(vantage, "GROUP_ROWS", 150)
    monkeypatch.setattr(vantage, "LEAF_ROWS", 16)
    rows = clusters(1500, norms=norms)
    rows += [(5000 + i, rows[0][1]) for i in range(400)]  # one vector in many rows
    df = as_files(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert run(df, factor=1.0, k=10, every=20) == brute(rows, 10, 20)


def test_recall_of_the_default(spark, monkeypatch):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in given.collect()]
    assert recall(run(given), brute(rows, 20, 20)) >= 0.95
    monkeypatch.setattr(vantage, "CELL_ROWS", 200)
    monkeypatch.setattr(vantage, "LEAF_ROWS", 16)
    rows = clusters(2000, 3, 0.2)
    df = as_files(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert recall(run(df), brute(rows, 20, 20)) >= 0.95


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (120, []),
            (1, [0.5, 0.5]), (2, [-1.0, -0.0]), (None, [1.0, 1.0]), (140, [1.0, 0.0]), (140, [1.0, 0.0])]
    df = as_files(spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, node string"))
    assert run(df) == {0: [(140, 1.0), (1, 0.5), (2, -1.0)], 140: [(0, 1.0), (1, 0.5), (2, -1.0)]}
    assert run(as_files(df.limit(0))) == {}
    mixed = as_files(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<float>"))
    assert run(mixed) == {0: [(1, 2.0)]}


def test_pruning_passes_over_far_points():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(2000, 3)) * 0.1 + c for c in (0, 50, 100)])
    looked = {}
    for factor in (1.0, 0.5):
        search = vantage.Search(points, points[:5], 5, np.full(5, np.inf), factor)
        seen = []
        visit = search.visit

        def counted(node, active, visit=visit, seen=seen):
            if node.rows is not None:
                seen.append(len(active) * len(node.rows))
            visit(node, active)

        search.visit = counted
        search.run(vantage.build(points, np.arange(len(points))))
        looked[factor] = sum(seen)
    assert looked[0.5] <= looked[1.0] < 5 * len(points) / 2
