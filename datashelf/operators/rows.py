"""Row ids, paging and validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from datashelf.session import fresh_folder

TOP_ROWS = 100_000
LOCAL_BITS = 33  # layout of monotonically_increasing_id: partition number above 33 bits of row number


def total_order(df: DataFrame, order: Sequence[Column | str]) -> list[Column]:
    """The given order, then a hash of the row and its columns: only equal rows are tied.

    The hash spreads rows that share a value in the given order.
    """
    fields = [f for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    columns = [F.col(f"`{f.name}`") for f in fields]
    return [*[F.col(o) if isinstance(o, str) else o for o in order], F.xxhash64(*columns), *columns]


def _placed(df: DataFrame, order: Sequence[Column | str]) -> tuple[DataFrame, DataFrame]:
    """Rows in total order, written once with ``__place``, and where each written partition starts: (__part, __start).

    Equal rows are told apart by their place in the input. The second has at most spark.sql.shuffle.partitions rows.
    """
    numbered = df.withColumn("__place", F.monotonically_increasing_id())
    full_order = [*total_order(df, order), F.col("__place")]
    folder = fresh_folder(df.sparkSession, "row-id")
    (
        numbered.repartitionByRange(*full_order)
        .sortWithinPartitions(*full_order)
        .withColumn("__place", F.monotonically_increasing_id())
        .write.parquet(folder)
    )
    placed = df.sparkSession.read.parquet(folder)
    part = F.shiftrightunsigned("__place", LOCAL_BITS).cast("int")
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return placed, sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"), "__rows")


def with_row_id(df: DataFrame, order: Sequence[Column | str], name: str = "row_id") -> DataFrame:
    """Number rows from 0 in the given order without bringing them into one partition.

    Rows are range-partitioned and sorted, written once to the work folder with their place within the partition,
    and each partition is shifted by the number of rows before it (see ``session.remove_work``).
    """
    placed, starts = _placed(df, order)
    part = F.shiftrightunsigned("__place", LOCAL_BITS).cast("int")
    within = F.col("__place").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(starts.drop("__rows")), "__part")
        .select(*columns, (F.col("__start") + within).alias(name))
    )


class Pages:
    """Pages of a frame in a total order. They fit together, whatever ties there are and however deep they lie.

    Pages that end within the first ``TOP_ROWS`` rows are the top of the order: every task keeps so many rows, and nothing
    is written. The first page beyond sorts and writes the rows once; it and all later ones read the files that hold them.
    """

    def __init__(self, df: DataFrame, order: Sequence[Column | str]):
        self.df, self.order = df, list(order)
        self._stored: tuple[DataFrame, list] | None = None

    def page(self, offset: int, limit: int) -> DataFrame:
        if offset + limit <= TOP_ROWS:
            return self.df.orderBy(*total_order(self.df, self.order)).offset(offset).limit(limit)
        if self._stored is None:
            placed, starts = _placed(self.df, self.order)
            self._stored = placed, starts.collect()  # a row for each written partition
        placed, starts = self._stored
        wanted = F.lit(False)
        for r in starts:
            first, last = max(offset - r["__start"], 0), min(offset + limit - r["__start"], r["__rows"])
            if first < last:
                base = r["__part"] << LOCAL_BITS
                wanted |= F.col("__place").between(base + first, base + last - 1)
        return placed.filter(wanted).orderBy("__place").drop("__place")


def page(df: DataFrame, order: Sequence[Column | str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the given order, sorted. For many deep pages, keep a :class:`Pages`."""
    return Pages(df, order).page(offset, limit)


def as_of_interval(df: DataFrame, at, begin: str = "begin_version", end: str = "end_version") -> DataFrame:
    """Rows valid at a version: ``begin <= at`` and not ended by then. An open end is NULL."""
    at = F.lit(at)
    return df.filter((F.col(begin) <= at) & (F.col(end).isNull() | (at < F.col(end))))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union matched by column name, without duplicates; a column one side lacks is NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result.distinct()


def region_filter(df: DataFrame, code_column: str, codes: Sequence[str]) -> DataFrame:
    return df.filter(F.col(code_column).isin(list(codes)))
