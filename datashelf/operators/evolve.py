"""Schema evolution: add, drop, rename, promote, align to another schema, conform files, copy with type casts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datashelf.sources.files import arrow_uri, list_files

DEFAULT_KEY = "initial_default"
NOT_NULL_KEY = "not_null"

# Lossless promotions. Unsigned types arrive in Spark as the next wider signed type.
PROMOTIONS = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint",),
    "float": ("double",),
}


class SchemaMismatch(ValueError):
    """Data does not fit the declared schema."""


def can_promote(old: T.DataType, new: T.DataType) -> bool:
    return new.simpleString() in PROMOTIONS.get(old.simpleString(), ())


def fits(found: T.DataType, declared: T.DataType) -> bool:
    """True when a file type may be read as the declared type without loss."""
    if found == declared or can_promote(found, declared):
        return True
    if isinstance(found, T.DecimalType) and isinstance(declared, T.DecimalType):
        whole = found.precision - found.scale <= declared.precision - declared.scale
        return whole and found.scale <= declared.scale
    return False


def add_column(df: DataFrame, path: str, data_type: str, default=None) -> DataFrame:
    """Add a column, or ``struct.field``, with a literal default that also serves older versions."""
    value = F.lit(as_literal(default)).cast(data_type)
    if "." in path:
        outer, inner = path.split(".", 1)
        return df.withColumn(outer, F.col(outer).withField(inner, value))
    metadata = {} if default is None else {DEFAULT_KEY: json.dumps(as_literal(default))}
    return df.withColumn(path, value).withMetadata(path, metadata)


def as_literal(value):
    """A default in the form that is stored: dates, times, decimals and the like as the text that casts back to them."""
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


def drop_column(df: DataFrame, path: str) -> DataFrame:
    if "." in path:
        outer, inner = path.split(".", 1)
        return df.withColumn(outer, F.col(outer).dropFields(inner))
    return df.drop(path)


def _renamed_type(data_type: T.StructType, parts: Sequence[str], new: str) -> T.StructType:
    fields = []
    for field in data_type.fields:
        if field.name == parts[0] and len(parts) == 1:
            fields.append(T.StructField(new, field.dataType, field.nullable))
        elif field.name == parts[0]:
            fields.append(T.StructField(field.name, _renamed_type(field.dataType, parts[1:], new), field.nullable))
        else:
            fields.append(field)
    return T.StructType(fields)


def rename_column(df: DataFrame, path: str, new: str) -> DataFrame:
    """Rename a column or a field inside a struct; positions and values stay."""
    outer, *rest = path.split(".")
    if not rest:
        return df.withColumnRenamed(outer, new)
    return df.withColumn(outer, F.col(outer).cast(_renamed_type(df.schema[outer].dataType, rest, new)))


def promote(df: DataFrame, column: str, data_type: str) -> DataFrame:
    """Widen a column's type. Anything outside the fixed table is an error."""
    target = T.StructType.fromDDL(f"c {data_type}")["c"].dataType
    if not can_promote(df.schema[column].dataType, target):
        raise SchemaMismatch(f"{df.schema[column].dataType.simpleString()} cannot become {data_type}")
    metadata = df.schema[column].metadata
    return df.withColumn(column, F.col(column).cast(target)).withMetadata(column, metadata)


def set_not_null(df: DataFrame, column: str) -> DataFrame:
    """Require a column from now on: every publish of data that carries this mark checks it."""
    return df.withMetadata(column, {**(df.schema[column].metadata or {}), NOT_NULL_KEY: True})


def drop_not_null(df: DataFrame, column: str) -> DataFrame:
    kept = {k: v for k, v in (df.schema[column].metadata or {}).items() if k != NOT_NULL_KEY}
    return df.withMetadata(column, kept)


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if (f.metadata or {}).get(NOT_NULL_KEY)]


def _default(field: T.StructField, defaults: dict) -> Column:
    value = defaults.get(field.name)
    if value is None and DEFAULT_KEY in (field.metadata or {}):
        value = json.loads(field.metadata[DEFAULT_KEY])
    return F.lit(as_literal(value)).cast(field.dataType)


def align(
    df: DataFrame, schema: T.StructType, defaults: dict | None = None, renames: dict[str, str] | None = None
) -> DataFrame:
    """Rows of an older shape under a newer schema: missing columns take their default, extra ones go, narrow types widen."""
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    have = set(df.columns)

    def field_column(field: T.StructField) -> Column:
        source = F.col(f"`{field.name}`").cast(field.dataType) if field.name in have else _default(field, defaults or {})
        return source.alias(field.name, metadata=field.metadata or {})

    return df.select(*[field_column(f) for f in schema.fields])


def _file_columns(files: DataFrame) -> DataFrame:
    """(path, column, type) of every Parquet file in a listing, from footers read on the executors."""

    def read(frames):
        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        for frame in frames:
            found = []
            for uri in frame["path"]:
                fs, local = pafs.FileSystem.from_uri(arrow_uri(uri))
                with fs.open_input_file(local) as handle:
                    layout = from_arrow_schema(pq.read_schema(handle), prefer_timestamp_ntz=True)
                found.extend((uri, f.name, f.dataType.json()) for f in layout.fields)
            yield pd.DataFrame(found, columns=["path", "column_name", "type_json"])

    return files.select("path").mapInPandas(read, "path string, column_name string, type_json string")


def read_conformed(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    allow_missing: bool = False,
    ignore_extra: bool = False,
    defaults: dict | None = None,
) -> DataFrame:
    """Existing Parquet files under a declared schema, as one scan.

    The check looks at every footer on the executors and brings back one row per distinct (column, type).
    Missing columns read as their default; Spark's reader fills them in and widens narrow types.
    """
    files = list_files(spark, list(paths), "*.parquet")
    seen = _file_columns(files).groupBy("column_name", "type_json").agg(F.count("*").alias("n"), F.min("path").alias("path"))
    n_files = files.count()
    holding: dict[str, int] = {}
    for row in seen.collect():
        name, found = row["column_name"], T._parse_datatype_json_string(row["type_json"])
        holding[name] = holding.get(name, 0) + row["n"]
        if name not in schema.names:
            if not ignore_extra:
                raise SchemaMismatch(f"undeclared column {name}, for example in {row['path']}")
        elif not fits(found, schema[name].dataType):
            raise SchemaMismatch(
                f"{name} is {found.simpleString()} in {row['path']}, declared {schema[name].dataType.simpleString()}"
            )
    missing = [f.name for f in schema.fields if holding.get(f.name, 0) < n_files]
    if missing and not allow_missing:
        raise SchemaMismatch(f"columns missing from some files: {missing}")
    # the same files as were checked, at any depth
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return reader.schema(with_read_defaults(schema, defaults)).parquet(*paths)


def with_read_defaults(schema: T.StructType, defaults: dict | None = None) -> T.StructType:
    """Schema that tells Spark's file readers what a column holds in files written before it existed."""
    fields = []
    for field in schema.fields:
        metadata = dict(field.metadata or {})
        value = (defaults or {}).get(field.name)
        if value is None and DEFAULT_KEY in metadata:
            value = json.loads(metadata[DEFAULT_KEY])
        if value is not None:
            value = as_literal(value)
            if isinstance(value, str):
                text = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
            elif isinstance(value, float):
                text = f"'{value}'"  # also NaN and the infinities
            else:
                text = str(value)
            metadata["EXISTS_DEFAULT"] = metadata["CURRENT_DEFAULT"] = f"CAST({text} AS {field.dataType.simpleString()})"
        fields.append(T.StructField(field.name, field.dataType, True, metadata))
    return T.StructType(fields)


# Types the lake format cannot hold, and what they become.
CAST_MAP = {"enum": "string", "union": "string", "bit": "string", "varint": "int", "char": "string", "varchar": "string"}


def migrate_cast(df: DataFrame, type_map: dict[str, str]) -> DataFrame:
    """Cast every column whose type name is in ``type_map`` (simple type names, or the declared source type
    found in the field metadata under ``source_type``)."""

    def converted(field: T.StructField) -> Column:
        declared = (field.metadata or {}).get("source_type", field.dataType.simpleString())
        target = type_map.get(declared.lower())
        column = F.col(f"`{field.name}`")
        return column.cast(target).alias(field.name) if target else column

    return df.select(*[converted(f) for f in df.schema.fields])


def migrate(shelf, tables: dict[str, DataFrame], type_map: dict[str, str] | None = None, **publish_args) -> dict[str, int]:
    """Copy many tables onto a shelf, casting on the way. Returns the version of each."""
    rules = CAST_MAP if type_map is None else type_map
    return {name: shelf.publish(migrate_cast(df, rules), name, **publish_args) for name, df in tables.items()}
