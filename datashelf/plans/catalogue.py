"""The data catalogue: tables, columns, comments, profiles and searches over them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datashelf.functions.geometry import bbox
from datashelf.functions.scalars import is_spatial_type, not_blank, text_or_empty
from datashelf.operators.stats import row_counts, samples_of

SPATIAL_META = "table_name string, geometry_column string, geometry_type string, crs string"


def describe(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: table, column, type, comment, position."""
    rows = [
        (name, f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment"), i)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, comment string, ordinal int"
    )


def show_tables(spark: SparkSession) -> DataFrame:
    """Tables and views the session's catalogue knows."""
    rows = [(t.name, "view" if "VIEW" in t.tableType or t.isTemporary else "table") for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_name string, type string")


def apply_comments(df: DataFrame, name: str, comments: DataFrame) -> tuple[DataFrame, str | None]:
    """Column comments from a comments table (table_name, column_name, comment), put into the field metadata.

    A row without a column name is the table's own comment, which is returned for use as the title.
    """
    rows = comments.filter((F.col("table_name") == name) & not_blank(F.col("comment"))).collect()
    by_column = {r["column_name"]: r["comment"] for r in rows if r["column_name"]}
    for column, comment in by_column.items():
        if column in df.columns:
            df = df.withMetadata(column, {**(df.schema[column].metadata or {}), "comment": comment})
    return df, next((r["comment"] for r in rows if not r["column_name"]), None)


def apply_all_comments(tables: dict[str, DataFrame], comments: DataFrame) -> dict[str, tuple[DataFrame, str | None]]:
    """:func:`apply_comments` for many tables; the comments table is read once."""
    told = comments.filter(F.col("table_name").isin(list(tables)) & not_blank(F.col("comment"))).collect()
    out = {}
    for name, df in tables.items():
        own = [r for r in told if r["table_name"] == name]
        for r in own:
            if r["column_name"] in df.columns:
                column = r["column_name"]
                df = df.withMetadata(column, {**(df.schema[column].metadata or {}), "comment": r["comment"]})
        out[name] = (df, next((r["comment"] for r in own if not r["column_name"]), None))
    return out


def comment_table(spark: SparkSession, table: str, comment: str | None, columns: dict[str, str]) -> None:
    """Put comments on a table of the session's catalogue."""
    quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {quote(comment)}")
    for column, text in columns.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {quote(text)}")


def comments_coverage(columns: DataFrame, minimum: int = 0) -> DataFrame:
    """Per table: columns, commented columns, and whether at least ``minimum`` have a comment."""
    covered = columns.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_columns"), F.count_if(not_blank(F.col("comment"))).alias("n_commented")
    )
    return covered.withColumn("enough", F.col("n_commented") >= minimum)


def table_profile(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, columns, whether a column is spatial, and the group it is copied with."""
    columns = describe(spark, tables).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.bool_or(is_spatial_type(F.col("data_type")) | (F.col("data_type") == "binary")).alias("is_spatial"),
    )
    group = F.when(F.col("is_spatial"), "spatial").otherwise("plain").alias("copy_group")
    return row_counts(tables).join(columns, "table_name").select("*", group)


def datasets_catalogue(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    comments: dict[str, str],
    updated: datetime,
    views=None,
    spatial: DataFrame | None = None,
    geometries: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Twelve columns per table and view: what it is, how many rows, where from, and its extent if spatial.

    ``spatial`` has the columns of ``SPATIAL_META``; ``geometries`` gives the decoded frame and column of each spatial
    table for the extent. All counts are one job, all extents another; both results have one row per table.
    """
    stamp = F.lit(updated).cast("timestamp_ntz").alias("last_updated")
    described = spark.createDataFrame([(n, comments.get(n)) for n in tables], "name string, comment string")
    counts = row_counts(tables).withColumnRenamed("table_name", "name")
    base = counts.join(described, "name").select(
        "name", text_or_empty(F.col("comment")).alias("description"), F.lit("table").alias("type"),
        "row_count", stamp, F.col("name").alias("source_table"),
    )
    rows = base
    if views is not None and len(views):
        view_counts = row_counts(views.build_all(tables)).withColumnRenamed("table_name", "name")
        rows = base.unionByName(
            view_counts.join(views.descriptions(spark), "name").select(
                "name", "description", F.lit("view").alias("type"), "row_count", stamp, "source_table"
            )
        )
    spatial = spatial if spatial is not None else spark.createDataFrame([], SPATIAL_META)
    nothing = spark.createDataFrame(
        [], "table_name string, bbox_xmin double, bbox_ymin double, bbox_xmax double, bbox_ymax double"
    )
    extents = [
        bbox(df, column).select(F.lit(name).alias("table_name"), "*") for name, (df, column) in (geometries or {}).items()
    ]
    boxes = reduce(DataFrame.unionByName, extents, nothing)
    details = spatial.join(boxes, "table_name", "left").withColumnRenamed("table_name", "name")
    return rows.join(details, "name", "left").select(
        "name", "description", "type", "row_count", "last_updated", "source_table", "geometry_type", "crs",
        "bbox_xmin", "bbox_ymin", "bbox_xmax", "bbox_ymax",
    )


def columns_catalogue(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    spatial: DataFrame | None = None,
    derived: dict[str, Sequence[tuple[str, str, str]]] | None = None,
) -> DataFrame:
    """One row per column: type, description and three examples, in table order.

    Geometry columns named in ``spatial`` show the type GEOMETRY and no examples. ``derived`` adds columns that a table
    gains on publishing: ``{table: [(column, type, description)]}``, placed after its own columns.
    """
    columns = describe(spark, tables).withColumnRenamed("comment", "description")
    if derived:
        width = {name: len(df.columns) for name, df in tables.items()}
        extra = [
            (t, c, kind, text, width[t] + i) for t, items in derived.items() for i, (c, kind, text) in enumerate(items)
        ]
        columns = columns.unionByName(spark.createDataFrame(extra, columns.schema))
    samples = samples_of(tables)
    found = columns.join(samples, ["table_name", "column_name"], "left")
    if spatial is not None:
        marks = spatial.select("table_name", F.col("geometry_column").alias("column_name"), F.lit(True).alias("__geo"))
        found = found.join(marks, ["table_name", "column_name"], "left")
    else:
        found = found.withColumn("__geo", F.lit(None).cast("boolean"))
    examples = [F.when(F.col("__geo").isNull(), F.col(f"example_{i}")).alias(f"example_{i}") for i in (1, 2, 3)]
    return found.select(
        "table_name", "column_name", F.when(F.col("__geo"), "GEOMETRY").otherwise(F.col("data_type")).alias("data_type"),
        "description", *examples, "ordinal",
    ).orderBy("table_name", "ordinal")


def search(datasets: DataFrame, type: str | None = None, spatial_only: bool = False) -> DataFrame:
    """Catalogue rows of one type, or those with a geometry."""
    found = datasets.filter(F.col("type") == type) if type else datasets
    return found.filter(F.col("geometry_type").isNotNull()) if spatial_only else found
