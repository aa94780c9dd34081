"""Table, column and file statistics, sample values, and file pruning by bounds."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datashelf.functions.scalars import plain_text
from datashelf.sources.files import list_files

NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
INTEGRAL = ("tinyint", "smallint", "int", "bigint")
FLOATING = ("float", "double")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of many tables as one job. Parquet counts come from footers."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionAll, frames)


def _is_nan(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    return F.isnan(column) if field.dataType.simpleString() in FLOATING else F.lit(False)


def _bounds(field: T.StructField) -> tuple[Column, Column]:
    """Smallest and largest value, leaving NaN out, as text."""
    if isinstance(field.dataType, NESTED):
        nothing = F.max(F.lit(None).cast("string"))
        return nothing, nothing
    value = F.when(~_is_nan(field), F.col(f"`{field.name}`"))
    return F.min(value).cast("string"), F.max(value).cast("string")


def _as_rows(df: DataFrame, fields: list[T.StructField], parts: list[str], keep: list[str] = ()) -> DataFrame:
    """Turn columns ``<i>_<part>`` into one row per field."""
    items = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            *[F.col(f"{i}_{p}").alias(p) for p in parts],
        )
        for i, f in enumerate(fields)
    ]
    return df.select(*keep, F.inline(F.array(*items)))


def column_stats(df: DataFrame) -> DataFrame:
    """Per column: contains_null, contains_nan, min_value, max_value as text. One scan, one row per task shuffled."""
    parts = []
    for i, field in enumerate(df.schema.fields):
        low, high = _bounds(field)
        parts += [
            F.coalesce(F.bool_or(F.col(f"`{field.name}`").isNull()), F.lit(False)).alias(f"{i}_contains_null"),
            F.coalesce(F.bool_or(_is_nan(field)), F.lit(False)).alias(f"{i}_contains_nan"),
            low.alias(f"{i}_min_value"),
            high.alias(f"{i}_max_value"),
        ]
    names = ["contains_null", "contains_nan", "min_value", "max_value"]
    return _as_rows(df.agg(*parts), df.schema.fields, names)


def file_column_stats(df: DataFrame) -> DataFrame:
    """Per file and column: value_count, null_count, min_value, max_value, contains_nan.

    The NaN flags are gathered as sets of at most two booleans; with such a set among the aggregates Spark hashes
    on the file name instead of sorting all rows by it, which text minima would otherwise force.
    """
    fields = df.schema.fields
    source = df.select("*", F.col("_metadata.file_path").alias("data_file"))
    parts = []
    for i, field in enumerate(fields):
        low, high = _bounds(field)
        column = F.col(f"`{field.name}`")
        parts += [
            F.count(column).alias(f"{i}_value_count"),
            F.count_if(column.isNull()).alias(f"{i}_null_count"),
            low.alias(f"{i}_min_value"),
            high.alias(f"{i}_max_value"),
            F.array_contains(F.collect_set(_is_nan(field)), True).alias(f"{i}_contains_nan"),
        ]
    names = ["value_count", "null_count", "min_value", "max_value", "contains_nan"]
    return _as_rows(source.groupBy("data_file").agg(*parts), fields, names, ["data_file"])


def table_stats(spark: SparkSession, path: str) -> DataFrame:
    """record_count, file_count and file_size_bytes of a Parquet folder."""
    files = list_files(spark, path, "*.parquet").agg(
        F.lit(0).cast("long").alias("record_count"),
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("file_size_bytes"),
    )
    zero = F.lit(0).cast("long")
    rows = (
        spark.read.option("recursiveFileLookup", True)
        .parquet(path)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select("record_count", zero.alias("file_count"), zero.alias("file_size_bytes"))
    )
    return rows.unionByName(files).agg(*[F.sum(c).alias(c) for c in rows.columns])


def _typed(text: str) -> tuple[Column, Column, Column]:
    """The bound as an exact number, a double and plain text; comparing the three in order suits every type."""
    kind = F.col("column_type")
    exact = F.when(kind.isin(*INTEGRAL) | kind.startswith("decimal"), F.col(text).try_cast("decimal(38,9)"))
    floating = F.when(kind.isin(*FLOATING), F.col(text).try_cast("double"))
    return exact, floating, F.col(text)


def merge_stats(*stats: DataFrame) -> DataFrame:
    """Column statistics of several parts combined; bounds are compared as values of the column's type, not as text."""
    together = reduce(DataFrame.unionByName, stats)
    sort_low, sort_high = F.struct(*_typed("min_value")), F.struct(*_typed("max_value"))
    return together.groupBy("column_name", "column_type").agg(
        F.bool_or("contains_null").alias("contains_null"),
        F.bool_or("contains_nan").alias("contains_nan"),
        F.min_by("min_value", F.when(F.col("min_value").isNotNull(), sort_low)).alias("min_value"),
        F.max_by("max_value", F.when(F.col("max_value").isNotNull(), sort_high)).alias("max_value"),
    )


def prune_files(stats: DataFrame, column: str, op: str, value, data_type: str) -> DataFrame:
    """Files that may hold a row with ``column op value``. A NULL bound cannot rule a file out.

    Bounds leave NaN out. NaN is above all numbers and equal to itself, so a file that holds it stays wherever it meets
    the condition.
    """
    low, high = F.col("min_value").try_cast(data_type), F.col("max_value").try_cast(data_type)
    v = F.lit(value).cast(data_type)
    possible = {
        "=": (low <= v) & (high >= v),
        "<": low < v,
        "<=": low <= v,
        ">": high > v,
        ">=": high >= v,
    }[op]
    if data_type in FLOATING:
        nan = {"=": F.isnan(v), "<": F.lit(False), "<=": F.isnan(v), ">": ~F.isnan(v), ">=": F.lit(True)}[op]
        # nothing but NaN itself is ruled out for a bound that is NaN
        possible = F.when(F.isnan(v), F.lit(op in ("<", "<=")) | (F.col("contains_nan") & nan)).otherwise(
            possible | (F.col("contains_nan") & nan)
        )
    return stats.filter(F.col("column_name") == column).filter(F.coalesce(possible, F.lit(True))).select("data_file")


def sample_distinct(df: DataFrame, n: int = 3) -> DataFrame:
    """Examples of one table's columns: column_name, example_1 ... example_n (see :func:`samples_of`)."""
    return samples_of({"": df}, n).drop("table_name")


def _smallest(n: int):
    """The ``n`` smallest distinct values of every column of a partition, as ``n`` rows or fewer."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] | None = None
        schema = None
        for batch in batches:
            schema = batch.schema
            if held is None:
                held = [batch.column(i).slice(0, 0) for i in range(batch.num_columns)]
            for i, column in enumerate(batch.columns):
                values = pc.unique(pa.concat_arrays([held[i], column.drop_null()]))
                held[i] = values.take(pc.select_k_unstable(values, min(n, len(values)), [("", "ascending")])) if len(values) else values
        if held is not None:
            rows = max(map(len, held))
            padded = [pa.concat_arrays([v, pa.nulls(rows - len(v), v.type)]) for v in held]
            yield pa.RecordBatch.from_arrays(padded, schema=schema)

    return scan


def samples_of(tables: dict[str, DataFrame], n: int = 3) -> DataFrame:
    """Per table and column the ``n`` smallest distinct non-null values, shown as text.

    One pass over all tables in one job: every partition keeps its ``n`` smallest values of each column, and only these
    meet in an aggregate, a few for each partition. NaN is no example, nor are nested and binary values.
    """
    session = next(iter(tables.values())).sparkSession
    columns = ["table_name", "column_name", *[f"example_{k + 1}" for k in range(n)]]
    frames, without = [], []
    for table, df in tables.items():
        fields = [f for f in df.schema.fields if not isinstance(f.dataType, NESTED)]
        without += [(table, f.name) for f in df.schema.fields if isinstance(f.dataType, NESTED)]
        if not fields:
            continue
        plain = df.select(*[_sampled(f).alias(f"c{i}") for i, f in enumerate(fields)])
        few = plain.mapInArrow(_smallest(n), plain.schema)
        lows = few.agg(*[F.slice(F.sort_array(F.collect_set(f"c{i}")), 1, n).alias(f"c{i}") for i in range(len(fields))])
        items = [
            F.struct(
                F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"),
                *[plain_text(F.get(F.col(f"c{i}"), F.lit(k)), f.dataType).alias(f"example_{k + 1}") for k in range(n)],
            )
            for i, f in enumerate(fields)
        ]
        frames.append(lows.select(F.inline(F.array(*items))))
    schema = ", ".join(f"{c} string" for c in columns)
    frames.append(session.createDataFrame([(t, c, *[None] * n) for t, c in without], schema))
    return reduce(DataFrame.unionAll, frames)


def _sampled(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    return F.when(~F.isnan(column), column) if field.dataType.simpleString() in FLOATING else column
