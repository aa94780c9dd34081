"""What several operators share: stored intermediates, row keys, distributed ranks, connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from datashelf.session import fresh_folder

BROADCAST_ROWS = 1_000_000  # of two numbers at most: 16 MB
PLACE_BITS = 33  # monotonically_increasing_id: the partition's number above 33 bits of place


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and survives lost executors."""
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def keyed(df: DataFrame, **columns: str | Column) -> DataFrame:
    """The named columns under the given names, and ``row``: a number that tells rows apart.

    Rows keep it whenever the same files are scanned again, so a null or repeated id still names one row. Only the
    chosen columns go on, whatever else the input has.
    """
    chosen = [(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return df.select(F.monotonically_increasing_id().alias("row"), *chosen)


def few(df: DataFrame) -> DataFrame:
    """A stored frame of numbers, to be broadcast if it has at most ``BROADCAST_ROWS`` rows and joined by shuffle else."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """Add the place of each row (gapless, from 0) within its group, by ``order``, which must be a total order.

    Rows are range-partitioned on group and order, so a group with most of the rows spreads over many tasks. The
    broadcast side has a row for each partition and group; callers group by something of bounded number.
    """
    keys = [*group, *order]
    placed = stored(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place_", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("part_", F.shiftrightunsigned("place_", PLACE_BITS))
    runs = placed.groupBy(*group, "part_").agg(F.min("place_").alias("first_"), F.count(F.lit(1)).alias("rows_"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(*group, "part_", "first_", F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("start_"))
    return (
        placed.join(F.broadcast(starts), [*group, "part_"])
        .withColumn(name, F.col("start_") + F.col("place_") - F.col("first_"))
        .drop("place_", "part_", "first_", "start_")
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): (node, label), label the smallest node of the component.

    Every node takes the least label around it, then the label of its label, until nothing changes. Nothing but a
    count of changes reaches the driver.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("next"))
        target = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        new = stored(
            step.join(target, "next", "left").select(
                "node", F.least("next", F.coalesce("beyond", "next")).alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
