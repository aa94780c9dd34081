"""K-d tree sharding: split at distributed weighted medians along the widest metadata dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from datashelf.llm.common import PLACE_BITS, keyed, ranked, stored

BROADCAST_BYTES = 16 << 20


def text_positions(rows: DataFrame, column: str) -> DataFrame:
    """Put the place of each text among the column's distinct texts (null: -1) for the text itself.

    Whole texts count, however long they begin alike. The distinct ones are sorted over range partitions; they are
    broadcast only if they and their places take at most ``BROADCAST_BYTES``.
    """
    texts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows_")).select(column)
    places = ranked(texts, [], [column], "place_of_text")
    places = stored(places.select(column, F.col("place_of_text").cast("double")), "texts")
    if (places.agg(F.sum(F.octet_length(column) + 32)).first()[0] or 0) <= BROADCAST_BYTES:
        places = F.broadcast(places)
    position = F.coalesce("place_of_text", F.lit(-1.0)).alias(column)
    return rows.join(places, column, "left").select(*[position if c == column else F.col(c) for c in rows.columns])


def number_position(column: str | Column) -> Column:
    """A number to order by; null and NaN: -1."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(-1.0))


def kd_shards(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    size: Column,
    *,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Give each row a shard: (doc_id, size, the carried columns, shard).

    The tree has ``shards`` leaves, or total size / ``target_bytes`` of them. A node with several leaves is cut along
    the dimension in which its rows spread widest (as a share of that dimension's spread over all rows; ties: the first
    named), at the weighted median of the sizes, or at the share of leaves to the left where their number is odd.
    Rows of equal value are told apart by id, then by place in the input, so any number of equal rows is divided and
    sizes differ by little more than one row. Dimensions are numbers, or texts, which count by their places in the
    order of the distinct ones.

    An empty table gives no rows; rows with null ids or values are placed like any other (nulls first); repeated rows
    are rows of their own; other columns are not looked at.

    The median is found by sorting each level's rows over range partitions of (node, value, id), summing sizes for
    each partition, and adding up within partitions. Only metadata moves, never texts. The driver gets one total.
    """
    names = list(dimensions)
    rows = stored(
        keyed(
            docs,
            id=id_col,
            size=size.cast("long"),
            **{f"d{i}": c for i, c in enumerate(dimensions.values())},
            **{f"c_{k}": c for k, c in (carry or {}).items()},
        ),
        "kd",
    )
    texts = [f"d{i}" for i in range(len(names)) if isinstance(rows.schema[f"d{i}"].dataType, StringType)]
    if texts:
        for column in texts:
            rows = text_positions(rows, column)
        rows = stored(rows, "kd-places")
    spans = [F.max(f"d{i}") - F.min(f"d{i}") for i in range(len(names))]
    whole = rows.agg(F.sum("size").alias("total"), *[s.alias(f"w{i}") for i, s in enumerate(spans)]).first()
    if shards is None:
        shards = max(1, round((whole.total or 0) / target_bytes))
    rows = rows.withColumns({"node": F.lit(1).cast("long"), "leaves": F.lit(shards), "shard": F.lit(0)})
    while shards > 1:
        rows = _split(rows, [whole[f"w{i}"] or 1.0 for i in range(len(names))])
        shards = (shards + 1) // 2
    kept = [F.col(f"c_{k}").alias(k) for k in (carry or {})]
    return rows.select(F.col("id").alias("doc_id"), "size", *kept, "shard", "row")


def _split(rows: DataFrame, scale: list[float]) -> DataFrame:
    """Cut every node that has more than one leaf in two."""
    spread = [((F.max(f"d{i}") - F.min(f"d{i}")) / F.lit(w)).alias(f"s{i}") for i, w in enumerate(scale)]
    nodes = rows.filter("leaves > 1").groupBy("node").agg(*spread, F.sum("size").alias("node_size"))
    widest = F.greatest(*[F.col(f"s{i}") for i in range(len(scale))]) if len(scale) > 1 else F.col("s0")
    value = F.coalesce(*[F.when(F.col(f"s{i}") == widest, F.col(f"d{i}")) for i in range(len(scale))])
    order = ["node", "value", "id", "row"]
    columns = rows.columns
    placed = stored(
        rows.join(nodes, "node")
        .select(*columns, "node_size", value.alias("value"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.shiftrightunsigned(F.monotonically_increasing_id(), PLACE_BITS)),
        "kd-level",
    )
    # A row for each partition and node: nodes are contiguous in the order, so partitions + nodes at most.
    sums = placed.groupBy("node", "part").agg(F.sum("size").alias("part_size"))
    ahead = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("node", "part", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("node", "part").orderBy("value", "id", "row").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("ahead") + F.sum("size").over(within) - F.col("size") / 2
    left = F.floor(F.col("leaves") / 2).cast("int")
    goes_left = F.col("goes_left")
    cut = (
        placed.join(sums, ["node", "part"])
        .withColumn("goes_left", middle < F.col("node_size") * left / F.col("leaves"))
        .withColumns(
            {
                "node": F.col("node") * 2 + F.when(goes_left, 0).otherwise(1),
                "shard": F.col("shard") + F.when(goes_left, 0).otherwise(left),
                "leaves": F.when(goes_left, left).otherwise(F.col("leaves") - left),
            }
        )
    )
    return stored(rows.filter("leaves = 1").select(*columns).union(cut.select(*columns)), "kd-cut")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents in near-equal shards by bytes: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    Dimensions: language, source and length. A null text counts as empty: size 1, checksum 0.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    placed = kd_shards(
        docs,
        {"lang": F.col("lang"), "source": F.col("source"), "n_chars": number_position("n_chars")},
        F.octet_length(text) + 1,
        shards=shards,
        carry={"text_crc32": F.crc32(text)},
    )
    return ranked(placed, ["shard"], ["doc_id", "row"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
