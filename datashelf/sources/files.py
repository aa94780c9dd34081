"""Reading and listing files: Parquet, CSV, databases, footers, inline rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One named table of a folder of Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_source(spark: SparkSession, fmt: str, **options) -> DataFrame:
    """Whole table from an outside source.

    A ``jdbc`` read is spread over executors, so it needs ``partitionColumn`` and ``numPartitions``; bounds that are not
    given are asked of the source first. ``numPartitions=1`` reads in one task.
    """
    if fmt == "jdbc" and str(options.get("numPartitions")) != "1":
        if "partitionColumn" not in options or "numPartitions" not in options:
            raise ValueError("a jdbc read needs partitionColumn and numPartitions, or numPartitions=1")
        if "lowerBound" not in options or "upperBound" not in options:
            column, source = options["partitionColumn"], options.get("dbtable") or f"({options['query']}) AS source"
            plain = {k: v for k, v in options.items() if k not in ("partitionColumn", "numPartitions", "dbtable", "query")}
            ends = f"SELECT min({column}) AS lo, max({column}) AS hi FROM {source}"
            row = spark.read.format(fmt).options(**plain, query=ends).load().first()
            options |= {"lowerBound": row[0] if row[0] is not None else 0, "upperBound": row[1] if row[1] is not None else 1}
    return spark.read.format(fmt).options(**options).load()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """CSV with a header. Types are inferred unless given; the text ``NA`` is missing.

    Files are split between tasks; pass ``multiLine=True`` where quoted values hold line ends, which makes every file
    one task.
    """
    reader = spark.read.options(header=True, nullValue="NA", escape='"').options(**options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header=True, nullValue="NA", escape='"').csv(path)


def read_glob(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Every matching Parquet file at any depth below a folder."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(folder)
    )


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Many Parquet files as one lazy dataset."""
    return spark.read.parquet(*paths)


def file_paths(df: DataFrame) -> DataFrame:
    """One row per file that a file-based DataFrame reads rows from. The tasks tell; no column is read."""
    return df.select(F.col("_metadata.file_path").alias("data_file")).distinct()


LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
    ]
)


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """Path, length and modification time of files below folders; contents are not read."""
    if isinstance(path, str) and not path_exists(spark, path):
        return spark.createDataFrame([], LISTING)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def arrow_uri(uri: str) -> str:
    """A file's address as Arrow spells it: Hadoop's s3a and s3n are its s3."""
    scheme, mark, rest = uri.partition("://")
    return f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else uri


def footer_meta(paths: DataFrame, key: str | None = None) -> DataFrame:
    """Key/value entries of Parquet footers, read where the file listing's partitions run.

    ``paths`` has a ``path`` column (see :func:`list_files`). With ``key`` only that entry is kept.
    """

    def read(frames):
        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for frame in frames:
            found = []
            for uri in frame["path"]:
                fs, local = pafs.FileSystem.from_uri(arrow_uri(uri))
                with fs.open_input_file(local) as handle:
                    entries = pq.ParquetFile(handle).schema_arrow.metadata or {}
                    raw = pq.read_metadata(handle).metadata or {}
                merged = {**entries, **raw}
                found.extend((uri, k.decode(), v.decode("utf-8", "replace")) for k, v in merged.items())
            yield pd.DataFrame(found, columns=["path", "key", "value"])

    entries = paths.select("path").mapInPandas(read, "path string, key string, value string")
    return entries if key is None else entries.filter(F.col("key") == key)


def inline_rows(spark: SparkSession, columns: dict[str, Iterable]) -> DataFrame:
    """Rows from parallel lists, as literals in the plan."""
    arrays = [F.array(*[F.lit(v) for v in values]).alias(name) for name, values in columns.items()]
    zipped = spark.range(1).select(*arrays).select(F.arrays_zip(*columns).alias("rows"))
    return zipped.select(F.inline("rows"))


# ---- file system calls that have no DataFrame form ----


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete one file or folder of a dataset. Returns False when it was not there."""
    fs, target = _hadoop_path(spark, path)
    return fs.delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """Path with its scheme, in the spelling that file listings use."""
    fs, target = _hadoop_path(spark, path)
    return fs.makeQualified(target).toString()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that appears under its name only once it is complete."""
    fs, target = _hadoop_path(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.tmp")
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(draft, target):
        raise FileExistsError(path)


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder of few entries; empty when there is no such folder."""
    fs, target = _hadoop_path(spark, folder)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def _modified(status) -> datetime:
    return datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)


def children(spark: SparkSession, folder: str) -> list[tuple[str, datetime]]:
    """(path, modification time) of what stands directly below a folder of few entries, hidden entries included."""
    fs, target = _hadoop_path(spark, folder)
    return [(s.getPath().toString(), _modified(s)) for s in fs.listStatus(target)] if fs.exists(target) else []


def files_below(spark: SparkSession, folder: str) -> list[tuple[str, int, datetime]]:
    """(path, length, modification time) of all files below a path, hidden ones included."""
    fs, target = _hadoop_path(spark, folder)
    found, listed = [], fs.listFiles(target, True)
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString(), status.getLen(), _modified(status)))
    return found
