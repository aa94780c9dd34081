"""Nearest neighbours by largest inner product: vantage-point trees per shard."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from datashelf.llm.common import stored

FACTOR = 0.9
CELL_ROWS, MAX_CELLS = 8192, 256
GROUP_ROWS = 8192
LEAF_ROWS = 256
SPARE = 11  # kept beyond what is asked for, so that rounding at the limit decides nothing


@dataclass
class VpNode:
    """Rows within ``low`` to ``high`` of their parent's vantage point; a leaf has ``rows``, others ``point`` and children."""

    low: float
    high: float
    rows: np.ndarray | None = None
    point: int = -1
    near: VpNode | None = None
    far: VpNode | None = None


def build(points: np.ndarray, rows: np.ndarray, low: float = 0.0, high: float = np.inf) -> VpNode:
    """The vantage point is the row farthest from the first; the others are halved at their median distance to it."""
    if len(rows) <= LEAF_ROWS:
        return VpNode(low, high, rows)
    point = rows[np.argmax(((points[rows] - points[rows[0]]) ** 2).sum(1))]
    distance = np.sqrt(((points[rows] - points[point]) ** 2).sum(1))
    order = np.argsort(distance, kind="stable")
    half = len(rows) // 2
    inner, outer = order[:half], order[half:]
    return VpNode(
        low, high, None, int(point),
        build(points, rows[inner], distance[inner[0]], distance[inner[-1]]),
        build(points, rows[outer], distance[outer[0]], distance[outer[-1]]),
    )


class Search:
    """The ``k`` nearest points of every query of a batch; each query's list shrinks its own radius."""

    def __init__(self, points: np.ndarray, queries: np.ndarray, k: int, radius: np.ndarray, factor: float):
        self.points, self.queries, self.k, self.factor = points, queries, k, factor
        self.norms, self.query_norms = (points**2).sum(1), (queries**2).sum(1)
        self.distance = np.full((len(queries), k + SPARE), np.inf)
        self.found = np.full((len(queries), k + SPARE), -1)
        self.radius = radius.copy()

    def run(self, node: VpNode) -> np.ndarray:
        self.visit(node, np.arange(len(self.queries)))
        return self.found

    def visit(self, node: VpNode, active: np.ndarray) -> None:
        if not len(active):
            return
        if node.rows is not None:
            square = self.query_norms[active, None] + self.norms[node.rows] - 2 * self.queries[active] @ self.points[node.rows].T
            both = np.concatenate([self.distance[active], np.sqrt(np.maximum(square, 0))], 1)
            rows = np.concatenate([self.found[active], np.broadcast_to(node.rows, square.shape)], 1)
            best = np.argpartition(both, self.k + SPARE - 1, 1)[:, : self.k + SPARE]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(both, best, 1), 1), 1)
            self.distance[active] = np.take_along_axis(both, best, 1)
            self.found[active] = np.take_along_axis(rows, best, 1)
            self.radius[active] = np.minimum(self.radius[active], self.distance[active, self.k - 1])
            return
        away = np.sqrt(((self.queries[active] - self.points[node.point]) ** 2).sum(1))
        first_near = away <= (node.near.high + node.far.low) / 2
        for child, turn in ((node.near, first_near), (node.far, ~first_near), (node.far, first_near), (node.near, ~first_near)):
            least = np.maximum(away - child.high, child.low - away)[turn]
            # triangle inequality: nothing in the child is nearer than ``least``; a factor below one gives up sooner
            self.visit(child, active[turn][least <= self.factor * self.radius[active[turn]] + 1e-9])


def searcher(k: int, factor: float, extra: float):
    """Search one shard: (query, node, score) of each query's nearest ``k`` found, ``extra`` the squared largest norm."""

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({"query": [], "node": [], "score": []})
        x, q = np.stack(points["v"].to_numpy()), np.stack(queries["v"].to_numpy())
        lifted = np.column_stack([x, np.sqrt(np.maximum(extra - (x**2).sum(1), 0))])
        work = Search(lifted, np.column_stack([q, np.zeros(len(q))]), k, queries["radius"].to_numpy(), factor)
        found = work.run(build(lifted, np.arange(len(lifted))))
        at, place = np.nonzero(found >= 0)
        rows = found[at, place]
        # summed for each pair alone, in the order of the components: equal vectors get equal scores
        score = (q[at] * x[rows]).sum(1)
        node, query = points["node"].to_numpy()[rows], queries["node"].to_numpy()[at]
        order = np.lexsort([node, -score, at])
        first = np.searchsorted(at[order], np.arange(len(q)))
        within = np.arange(len(order)) - first[at[order]]
        order = order[within < k]
        return pd.DataFrame({"query": query[order], "node": node[order], "score": score[order]})

    return search


def visitor(centres: np.ndarray, radii: np.ndarray, extra: float, factor: float, home: bool):
    """For each vector or query, its home cell, or the other cells that may hold something within its radius."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.array(batch.column("v").to_pylist(), float).reshape(batch.num_rows, -1)
            lift = batch.column("lift").to_numpy(zero_copy_only=False).astype(float)
            x = np.column_stack([v, np.sqrt(np.maximum(lift * (extra - (v**2).sum(1)), 0))]) if len(v) else np.empty((0, centres.shape[1]))
            away = np.sqrt(np.maximum((x**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * x @ centres.T, 0))
            nearest = away.argmin(1)
            if home:
                rows, cells, distance = np.arange(len(x)), nearest, away.min(1)
            else:
                limit = batch.column("radius").to_numpy(zero_copy_only=False)
                open_ = away - radii <= factor * limit[:, None] + 1e-9
                open_[np.arange(len(x)), nearest] = False
                rows, cells = np.nonzero(open_)
                distance = away[rows, cells]
            out = batch.take(pa.array(rows))
            yield pa.record_batch(
                [*out.columns, pa.array(cells, pa.int32()), pa.array(distance, pa.float64())],
                names=[*out.schema.names, "cell", "away"],
            )

    return visit


def nearest(
    vectors: DataFrame,
    *,
    k: int = 20,
    every: int = 20,
    factor: float = FACTOR,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Each query's ``k`` nearest by inner product: (query_id, rank, vec_id, score), rank from 1, ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows of another id. Inner products
    become distances by one more component, the root of the largest squared norm less the vector's own (0 for queries).
    Vectors of equal components are one point with their k + 1 smallest ids. Points go to the nearest of up to
    ``MAX_CELLS`` centres, a bounded sample by hash; a cell is split by hash into shards of about ``GROUP_ROWS``. Each
    shard has a vantage-point tree. A query is searched in its home cell first, which gives a radius, then in the cells
    whose centre and reach the triangle inequality does not rule out.

    ``factor`` relaxes all pruning: what cannot be nearer than factor * radius is passed over. With 1 the search is
    exact. The default's recall is measured in the tests and stated in the README.

    Vectors that are null, empty, zero or hold null or non-finite components, those of another length than the most
    frequent, and rows with a null id take no part. Repeated rows count once. Too few candidates: fewer ranks. An empty
    table gives no rows. Queries of one shard are searched in blocks, so no group outgrows a task.
    """
    session = vectors.sparkSession
    v = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double") + F.lit(0.0))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    )
    usable = usable.filter(~F.coalesce(bad, F.lit(True))).filter(F.exists("v", lambda x: x != 0))
    usable = usable.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    width = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return session.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.filter(F.size("v") == width.n)
    points = stored(
        usable.groupBy("h1", "h2").agg(F.min("id").alias("node"), F.first("v").alias("v"), F.lit(1).alias("lift")), "points"
    )
    smallest = Window.partitionBy("h1", "h2").orderBy("id")
    few = usable.select("h1", "h2", "id").distinct().withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= k + 1)
    ids = stored(few.join(points.select("h1", "h2", "node"), ["h1", "h2"]).select("node", "id"), "ids")

    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    whole = points.agg(F.max(square).alias("extra"), F.count(F.lit(1)).alias("n")).first()
    extra, cells = float(whole.extra), min(MAX_CELLS, -(-whole.n // CELL_ROWS))
    sample = points.orderBy(F.xxhash64("h1", "h2"), "node").limit(cells).select("v").collect()  # at most MAX_CELLS
    c = np.array([r.v for r in sample])
    centres = np.column_stack([c, np.sqrt(np.maximum(extra - (c**2).sum(1), 0))])
    kept = "h1 long, h2 long, node long, v array<double>, lift int"
    placed = stored(
        points.mapInArrow(visitor(centres, None, extra, factor, True), f"{kept}, cell int, away double"), "cells"
    )
    sizes = {r.cell: (r.m, r.reach) for r in placed.groupBy("cell").agg(F.count("node").alias("m"), F.max("away").alias("reach")).collect()}
    radii = np.array([sizes.get(i, (0, -np.inf))[1] for i in range(cells)])

    asked = usable.filter(F.col("id") % every == 0).select("h1", "h2").distinct().join(points, ["h1", "h2"])
    asked = stored(asked.select("node", "v", F.lit(0).alias("lift"), F.lit(float("inf")).alias("radius")), "queries")
    line = "node long, v array<double>, lift int, radius double, cell int, away double"

    def searched(queries: DataFrame) -> DataFrame:
        loads = {r.cell: r.m for r in queries.groupBy("cell").agg(F.count("node").alias("m")).collect()}
        shards, blocks = ({i: max(1, -(-n // GROUP_ROWS)) for i, n in d.items()}
                          for d in ({i: m for i, (m, _) in sizes.items()}, loads))
        if not loads:
            return session.createDataFrame([], "query long, node long, score double")

        def lookup(table):
            return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col("cell")]

        def spread(number, own, other):
            """A row's own part by hash, once for each part of the other side."""
            mine = F.pmod(F.xxhash64("node"), lookup(own)).cast("int")
            return number.withColumn("mine", mine).withColumn("theirs", F.explode(F.sequence(F.lit(0), lookup(other) - 1)))

        left = spread(placed.filter(F.col("cell").isin(list(loads))), shards, blocks)
        right = spread(queries, blocks, shards)
        return left.select("node", "v", "cell", F.col("mine").alias("shard"), F.col("theirs").alias("block")).groupBy("cell", "shard", "block").cogroup(
            right.select("node", "v", "radius", "cell", F.col("theirs").alias("shard"), F.col("mine").alias("block")).groupBy("cell", "shard", "block")
        ).applyInPandas(_by_key(searcher(k + 1, factor, extra)), "query long, node long, score double")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)

    first = stored(searched(stored(asked.mapInArrow(visitor(centres, radii, extra, factor, True), line), "home")), "first")
    # the distance of the last one found; without enough, anything may be nearer
    limit = top(first).filter(F.col("n") == k + 1).select(F.col("query").alias("node"), F.col("score").alias("last"))
    reach = F.sqrt(F.greatest(square + F.lit(extra) - 2 * F.col("last"), F.lit(0.0)))
    radius = F.when(F.col("last").isNull(), F.lit(float("inf"))).otherwise(reach)
    again = asked.drop("radius").join(limit, "node", "left").select("node", "v", "lift", radius.alias("radius"))
    again = stored(again.mapInArrow(visitor(centres, radii, extra, factor, False), line), "again")
    second = stored(searched(again), "second")
    found = top(first.union(second)).select(F.col("query").alias("of"), "node", "score")
    # at most (k + 1) points of (k + 1) ids for each distinct query vector
    by_class = found.join(ids, "node").select("of", "id", "score")
    nearest_ids = Window.partitionBy("of").orderBy(F.desc("score"), "id")
    by_class = by_class.withColumn("n", F.row_number().over(nearest_ids)).filter(F.col("n") <= k + 1).drop("n")
    queries = usable.filter(F.col("id") % every == 0).join(points.select("h1", "h2", F.col("node").alias("of")), ["h1", "h2"])
    pairs = queries.select(F.col("id").alias("query_id"), "of").distinct().join(by_class, "of").filter("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )


def _by_key(function):
    return lambda key, left, right: function(left, right)
