"""Published datasets: named, versioned Parquet folders plus a log of versions.

Layout below one root::

    <root>/<name>/v00000001-<UTC time>-<hash>/part-*.parquet
    <root>/shelf-log/name=<name>/v00000001.json   one log entry per version

A version is a list of folders and of files in them that do not count any more: an append adds a folder that holds the new
rows and refers to those before it; a merge, update or delete adds one that holds the rows of the files it touched. Partition
columns belong to the dataset and stay with it until a publish names others; its folders are then read in one scan, as
partitions of the dataset's folder. A dataset with row ids keeps the id of a row for as long as the row lives.

A version is visible once its log entry exists. Entries are only ever added, so a failed publish leaves an
unreferenced folder (see ``plans.maintain``) and never a half-visible version. Of two writers that publish the same
version of a dataset at a time, the second is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from decimal import Decimal
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datashelf.functions.scalars import calendar_part
from datashelf.operators import changes as change_ops
from datashelf.operators.evolve import align, read_conformed, required_columns
from datashelf.sources.files import child_names, list_files, path_exists, put_text, qualified

LOG_FOLDER = "shelf-log"
TEXT_MAP = T.MapType(T.StringType(), T.StringType())
LOG_SCHEMA = (
    T.StructType()
    .add("name", "string")
    .add("version", "long")
    .add("kind", "string")  # publish | rollback | compact | drop | expire
    .add("published_at", "timestamp")
    .add("path", "string")  # the folder written for this version
    .add("folders", T.ArrayType(T.StringType()))  # all of its folders
    .add("without", T.ArrayType(T.StringType()))  # files of these folders that are not part of it
    .add("partition_by", T.ArrayType(T.StringType()))
    .add("next_row_id", "long")  # set if the rows carry ids
    .add("stats", "string")  # of each column: see Shelf.column_bounds
    .add("target_version", "long")  # of rollback and expire entries
    .add("title", "string")
    .add("description", "string")
    .add("columns", TEXT_MAP)
    .add("column_types", TEXT_MAP)
    .add("user", TEXT_MAP)
    .add("schema_json", "string")
    .add("row_count", "long")
    .add("n_columns", "integer")
    .add("changes", "string")
    .add("author", "string")
    .add("message", "string")
    .add("extra_info", "string")
)

# Files hold at most this many rows.
ROWS_PER_FILE = 3_000_000
ROW_ID = "_row_id"
FILE = "__file"
# Names version folders of partitioned datasets, so that all of them are partitions of the dataset's folder.
VERSION_KEY = "shelf_version"
BOUNDED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


class RowCountMismatch(ValueError):
    """A copy does not hold as many rows as its source."""


class NotPublished(LookupError):
    """No such dataset or version."""


def with_comments(df: DataFrame, comments: dict[str, str] | None) -> DataFrame:
    """Attach column comments as field metadata, which Spark keeps in the Parquet files."""
    comments = comments or {}

    def documented(field: T.StructField) -> Column:
        metadata = dict(field.metadata or {})
        if field.name in comments:
            metadata["comment"] = comments[field.name]
        return F.col(f"`{field.name}`").alias(field.name, metadata=metadata)

    return df.select(*[documented(f) for f in df.schema.fields])


class ShelfReader:
    """Reads a shelf, optionally as it stood at one version number or time."""

    def __init__(self, spark: SparkSession, root: str, *, version: int | None = None, ts: datetime | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._bound_version = version
        self._bound_ts = ts

    # -- the log --

    def log(self, name: str | None = None) -> DataFrame:
        """All log entries up to this reader's bound; with ``name``, only that dataset's files are listed and read."""
        base = f"{self.root}/{LOG_FOLDER}"
        folder = base if name is None else f"{base}/name={name}"
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        reader = self.spark.read.schema(LOG_SCHEMA).option("basePath", base)
        entries = reader.json(folder).select(*LOG_SCHEMA.names)
        if self._bound_version is not None:
            entries = entries.filter(F.col("version") <= self._bound_version)
        if self._bound_ts is not None:
            entries = entries.filter(F.col("published_at") <= F.lit(self._bound_ts))
        return entries

    def versions(self, name: str | None = None) -> DataFrame:
        """Readable versions: every entry but expired ones, drops and expiry notes."""
        log = self.log(name)
        gone = log.filter("kind = 'expire'").select("name", F.col("target_version").alias("version"))
        return log.filter("kind NOT IN ('expire', 'drop')").join(gone, ["name", "version"], "left_anti")

    def latest(self) -> DataFrame:
        """Newest version row of each dataset that is not dropped."""
        log = self.log().filter("kind <> 'expire'")
        newest = log.groupBy("name").agg(F.max_by(F.struct("*"), "version").alias("row"))
        return newest.select("row.*").filter("kind <> 'drop'").select(*LOG_SCHEMA.names)

    def list_datasets(self) -> DataFrame:
        return self.latest().select("name").orderBy("name")

    def _entry(self, name: str, version: int | None = None, ts: datetime | None = None):
        if version is None and ts is None:
            # The newest entry decides; a drop means that nothing is on the shelf.
            newest = self.log(name).filter("kind <> 'expire'")
            row = [r for r in newest.orderBy(F.desc("version")).limit(1).collect() if r["kind"] != "drop"]
        else:
            found = self.versions(name)
            if version is not None:
                found = found.filter(F.col("version") == version)
            if ts is not None:
                found = found.filter(F.col("published_at") <= F.lit(ts))
            row = found.orderBy(F.desc("version")).limit(1).collect()
        if not row:
            raise NotPublished(f"{name} has no version matching version={version}, ts={ts}")
        return row[0]

    # -- reading data --

    def read(self, name: str, version: int | None = None, ts: datetime | None = None, row_ids: bool = False) -> DataFrame:
        """A dataset as a lazy DataFrame: latest, one version, or as of a time; with ``row_ids``, also its column of ids."""
        return self._load(self._entry(name, version, ts), row_ids)

    def _load(self, entry, row_ids: bool = False) -> DataFrame:
        if row_ids and entry["next_row_id"] is None:
            raise ValueError(f"{entry['name']} has no row ids")
        return read_folders(self.spark, schema_of(entry, row_ids), entry["folders"], entry["partition_by"], without=entry["without"] or ())

    def files(self, name: str, version: int | None = None, ts: datetime | None = None) -> DataFrame:
        """Data files of a version with their sizes."""
        return self._files(self._entry(name, version, ts))

    def _files(self, entry) -> DataFrame:
        listed = listed_files(self.spark, entry["folders"], entry["without"] or ())
        return listed.select(F.col("path").alias("data_file"), F.col("length").alias("data_file_size_bytes"))

    def column_bounds(self, name: str, version: int | None = None) -> DataFrame:
        """(column_name, n_nulls, low, high) of every column, from the log: gathered as rows were written, merged by appends.

        Bounds are text, and null for types without an order. After a merge, update or delete, the bounds may be wider than
        the rows, and ``n_nulls`` is null.
        """
        stats = json.loads(self._entry(name, version)["stats"] or "{}")
        rows = [(c, *found) for c, found in stats.items()]  # a row for each column
        return self.spark.createDataFrame(rows, "column_name string, n_nulls long, low string, high string")

    def meta(self, name: str, version: int | None = None) -> DataFrame:
        """Title, description, sizes and the free metadata map of one version."""
        found = self._entry(name, version)["version"]
        return self.versions(name).filter(F.col("version") == found).select(
            "name", "version", "title", "description", "columns", "column_types", "user", "row_count", "n_columns"
        )

    def column_docs(self, name: str, version: int | None = None) -> DataFrame:
        """One row per documented column: name, comment, type."""
        return (
            self.meta(name, version)
            .select("name", F.explode("column_types").alias("column_name", "data_type"), "columns")
            .select("name", "column_name", "data_type", F.try_element_at("columns", F.col("column_name")).alias("comment"))
        )

    def current_version(self, name: str) -> int:
        return self._entry(name)["version"]

    def table_changes(self, name: str, lo, hi, key: Sequence[str] | None = None, copies: str | None = None) -> DataFrame:
        """Row changes made by versions ``lo`` to ``hi``, both included; bounds are numbers or times.

        Folders and files that all versions share are not read; others are read once, under the schema of the end version.
        Without a key, the ids of a dataset with row ids are the key, and the feed shows them. ``copies`` as in
        ``operators.changes.table_changes``.
        """
        known = self.versions(name)
        if isinstance(lo, datetime):
            known = known.withColumn("in_range", F.col("published_at") >= F.lit(lo))
        else:
            known = known.withColumn("in_range", F.col("version") >= lo)
        if isinstance(hi, datetime):
            known = known.filter(F.col("published_at") <= F.lit(hi))
        else:
            known = known.filter(F.col("version") <= hi)
        # The version just before the range is the one that its first change is measured against.
        before = known.filter("NOT in_range").orderBy(F.desc("version")).limit(1)
        rows = sorted(before.unionByName(known.filter("in_range")).collect(), key=lambda r: r["version"])
        if not any(r["in_range"] for r in rows):
            raise NotPublished(f"{name} has no version between {lo} and {hi}")
        end, steps = rows[-1], [r["version"] for r in rows if r["in_range"]]
        first = 1 if rows[0]["in_range"] else 0  # state 0 is the one before the range, if only as nothing at all
        by_id = key is None and all(r["next_row_id"] is not None for r in rows)
        frames = [
            (align(df, schema_of(end, by_id)), members)
            for df, members in self._differing(rows, first, by_id)
        ]
        if not frames:
            nothing = self.spark.createDataFrame([], schema_of(end, by_id))
            frames = [(nothing, [0])]
        return change_ops.changes_of(frames, steps, [ROW_ID] if by_id else key, copies)

    def _differing(self, rows: Sequence, first: int, row_ids: bool) -> list[tuple[DataFrame, list[int]]]:
        """What the versions do not all share: (rows, the states that hold them), each folder or file of a folder once.

        Nothing is read to find out: the log says which folders and files are part of a version.
        """
        every = set(range(first, first + len(rows)))
        # Folders mean the same rows only under the same schema.
        shapes = {r["schema_json"] for r in rows}
        parts: dict[tuple, list] = {}
        for shape in sorted(shapes):
            states = {first + i: r for i, r in enumerate(rows) if r["schema_json"] == shape}
            entry = next(iter(states.values()))
            gone = {i: set(r["without"] or ()) for i, r in states.items()}
            loose = sorted(set().union(*gone.values()))
            for folder in sorted({f for r in states.values() for f in r["folders"]}):
                holders = {i for i, r in states.items() if folder in r["folders"]}
                inside = [f for f in loose if is_inside(f, folder)]
                # the folder but for files that some version leaves out; then each of those files
                groups = [(frozenset(holders), None)]
                groups += [(frozenset(i for i in holders if f not in gone[i]), f) for f in inside]
                for members, file in groups:
                    if members and (members != every or first):
                        parts.setdefault((shape, members, file is not None), []).append((folder, file, inside, entry))
        found = []
        for (_, members, of_files), held in parts.items():
            entry, folders = held[0][3], list(dict.fromkeys(h[0] for h in held))
            left = {} if of_files else {"without": sorted({f for h in held for f in h[2]})}
            chosen = {"only": [h[1] for h in held]} if of_files else left
            df = read_folders(self.spark, schema_of(entry, row_ids), folders, entry["partition_by"], **chosen)
            found.append((df, sorted(members)))
        return found

    def at(self, version: int | None = None, ts: datetime | None = None) -> "ShelfReader":
        """A read-only view of the whole shelf as of one bound."""
        return ShelfReader(self.spark, self.root, version=version, ts=ts)


class Shelf(ShelfReader):
    """A shelf that can also be written to."""

    def __init__(self, spark: SparkSession, root: str, *, require_message: bool = False):
        super().__init__(spark, root)
        self.require_message = require_message
        self.last_committed: dict[str, int] = {}

    def _append_log(self, name: str, entries: list[dict]) -> None:
        """Add entries of one dataset as one small file of JSON lines."""
        lines = []
        for entry in entries:
            full = {field: entry.get(field) for field in LOG_SCHEMA.names if field != "name"}
            full["published_at"] = full["published_at"].astimezone(timezone.utc).isoformat()
            lines.append(json.dumps({k: v for k, v in full.items() if v is not None}))
        first = entries[0]
        label = f"expire-{uuid.uuid4().hex}" if first["kind"] == "expire" else f"v{first['version']:08d}"
        put_text(self.spark, f"{self.root}/{LOG_FOLDER}/name={name}/{label}.json", "\n".join(lines) + "\n")
        if first["kind"] != "expire":
            self.last_committed[name] = first["version"]

    def _next_version(self, name: str) -> int:
        entries = child_names(self.spark, f"{self.root}/{LOG_FOLDER}/name={name}")
        return max((int(e[1:9]) for e in entries if e.startswith("v")), default=0) + 1

    def publish(
        self,
        df: DataFrame,
        name: str,
        *,
        title: str | None = None,
        description: str = "",
        comments: dict[str, str] | None = None,
        user: dict[str, str] | None = None,
        changes: str | None = None,
        author: str | None = None,
        message: str | None = None,
        extra_info: str | None = None,
        not_null: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        beside: Sequence[str] = (),
        date_parts: tuple[str, Sequence[str]] | None = None,
        rows_per_file: int | None = ROWS_PER_FILE,
        compression: str = "snappy",
        options: dict[str, str] | None = None,
        now: datetime | None = None,
        kind: str = "publish",
        expected_rows: int | None = None,
        without: Sequence[str] = (),
        beside_rows: int | None = None,
        beside_stats: str | None = None,
        row_ids: bool = False,
        observe: dict[str, Column] | None = None,
        verify: Callable[[dict], None] | None = None,
    ) -> int:
        """Write a new version and make it visible. Returns the version number.

        ``date_parts=("ts", ["year", "month"])`` adds calendar columns and partitions by them. ``beside`` names folders
        of the same schema and partition columns that are part of the version as they are, but for the files ``without``;
        ``beside_rows`` and ``beside_stats`` say what they hold. With ``expected_rows``, a version of another number of rows
        is not made visible.

        Rows are counted, required columns checked and bounds gathered while they are written, in the same job. ``observe``
        adds aggregates to that, which ``verify`` sees before the version becomes visible; it may raise. With ``row_ids``,
        rows get ids that no other row of the dataset ever had; rows that have one keep it.
        """
        if self.require_message and not (message or "").strip():
            raise ValueError("this shelf requires a message with every publish")
        now = now or datetime.now(timezone.utc)
        version = self._next_version(name)
        keys = [*partition_by, *(date_parts[1] if date_parts else ())]
        label = f"v{version:08d}-{now:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:5]}"
        path = qualified(self.spark, f"{self.root}/{name}/{f'{VERSION_KEY}=' if keys else ''}{label}")

        df = with_comments(df, comments)
        if date_parts:
            source, parts = date_parts
            df = df.withColumns({p: calendar_part(F.col(source), p) for p in parts})
        if keys:
            # Rows of a partition meet in few files; adaptive execution splits a partition that is too large.
            df = df.hint("rebalance", *keys)
        if row_ids:
            first_id = self.log(name).agg(F.max("next_row_id")).first()[0] or 0
            new_id = F.lit(first_id) + F.monotonically_increasing_id()
            df = df.withColumn(ROW_ID, F.coalesce(F.col(ROW_ID), new_id) if ROW_ID in df.columns else new_id)
        elif ROW_ID in df.columns:
            df = df.drop(ROW_ID)

        # The schema in Parquet column order; partition columns come last, as on reading.
        names = [f for f in df.columns if f not in keys and f != ROW_ID] + keys
        schema = T.StructType([T.StructField(n, df.schema[n].dataType, True, df.schema[n].metadata) for n in names])
        observed, gathered = Observation(), {**_measures(schema), **(observe or {})}
        if row_ids:
            gathered["last_id"] = F.max(ROW_ID)
        writer = df.observe(observed, *[c.alias(n) for n, c in gathered.items()]).write
        writer = writer.option("compression", compression).options(**(options or {}))
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        if keys:
            writer = writer.partitionBy(*keys)
        writer.parquet(path)

        got = observed.get
        _check_required(got, schema, not_null)
        if verify is not None:
            verify(got)
        folders = [*beside, path]
        if beside and beside_rows is None:
            beside_rows = read_folders(self.spark, schema, beside, keys, without=without).count()  # from footers
        row_count = got["rows"] + (beside_rows or 0)
        if expected_rows is not None and row_count != expected_rows:
            raise RowCountMismatch(f"row counts differ: {expected_rows} vs {row_count}")
        stats = _stats_of(got, schema)
        if beside:
            stats = _merged_stats(json.loads(beside_stats or "{}"), stats, schema, bool(without))
        if changes is None:
            changes = "created" if version == 1 else "inserted"
        self._append_log(
            name,
            [
                dict(
                    version=version,
                    kind=kind,
                    published_at=now,
                    path=path,
                    folders=folders,
                    without=list(without) or None,
                    partition_by=keys,
                    next_row_id=max(first_id, (got["last_id"] if got["last_id"] is not None else -1) + 1) if row_ids else None,
                    stats=json.dumps(stats),
                    title=(title or "").strip() or name,
                    description=description,
                    columns={f.name: f.metadata.get("comment", "") for f in schema.fields},
                    column_types={f.name: f.dataType.simpleString() for f in schema.fields},
                    user={k: str(v) for k, v in (user or {}).items()},
                    schema_json=schema.json(),
                    row_count=row_count,
                    n_columns=len(schema.fields),
                    changes=changes,
                    author=author,
                    message=message,
                    extra_info=extra_info,
                )
            ]
        )
        return version

    def append(self, df: DataFrame, name: str, **kw) -> int:
        """New version holding the old rows and the new ones. Only the new rows are written, unless types widen."""
        last = self._entry(name)
        old, keys, with_ids = self._load(last), list(last["partition_by"]), last["next_row_id"] is not None
        both = old.unionByName(df)
        args = {"changes": "inserted", "partition_by": keys, "row_ids": with_ids, **kw}
        if both.schema.simpleString() != old.schema.simpleString() or list(args["partition_by"]) != keys:
            if with_ids:
                both = self._load(last, True).unionByName(df, allowMissingColumns=True)
            return self.publish(both, name, **args)
        # columns carry the old marks, so that a required column stays one
        new = df.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in old.schema.fields])
        return self.publish(new, name, **_beside(last), **args)

    def add_files(
        self, name: str, folders: Sequence[str], *, allow_missing: bool = False, ignore_extra: bool = False, now: datetime | None = None,
        author: str | None = None, message: str | None = None, extra_info: str | None = None,
    ) -> int:
        """New version that also holds the Parquet files of other folders, where they lie. No data is copied.

        Columns go by name. Every footer is compared with the dataset's schema: types must be the same or narrower; columns
        that files lack are null there if ``allow_missing``, others that they have are not read if ``ignore_extra``. One scan
        gathers counts and bounds and checks required columns.

        The files belong to whoever wrote them: expiry and clean-up never delete them. Merge, update and delete write the
        rows of touched files anew on the shelf, and compaction those of folders of small files.
        """
        if self.require_message and not (message or "").strip():
            raise ValueError("this shelf requires a message with every publish")
        last = self._entry(name)
        if last["partition_by"] or last["next_row_id"] is not None:
            raise ValueError(f"{name} has partition columns or row ids, which files from elsewhere do not have")
        schema, paths = schema_of(last), [qualified(self.spark, f.rstrip("/")) for f in dict.fromkeys(folders)]
        twice = sorted(set(paths) & set(last["folders"]))
        if twice:
            raise ValueError(f"already part of {name}: {twice}")
        deep = listed_files(self.spark, paths).filter(~F.regexp_replace("path", "/[^/]*$", "").isin(paths)).select("path").first()
        if deep:
            raise ValueError(f"not directly in one of the folders: {deep['path']}")
        read_conformed(self.spark, paths, schema, allow_missing, ignore_extra)
        rows = read_folders(self.spark, schema, paths, [])
        got = rows.agg(*[c.alias(n) for n, c in _measures(schema).items()]).first().asDict()
        _check_required(got, schema)
        entry = last.asDict()
        entry.update(
            version=self._next_version(name), kind="publish", published_at=now or datetime.now(timezone.utc), path=None,
            folders=[*last["folders"], *paths], target_version=None, row_count=last["row_count"] + got["rows"],
            stats=json.dumps(_merged_stats(json.loads(last["stats"] or "{}"), _stats_of(got, schema), schema, False)),
            changes="files added", author=author, message=message, extra_info=extra_info,
        )
        self._append_log(name, [entry])
        return entry["version"]

    def replace_rows(self, df: DataFrame, name: str, **kw) -> int:
        """New version with other rows, keeping documentation and partitioning. Rows with a column of ids keep them."""
        last = self._entry(name)
        kept = dict(title=last["title"], description=last["description"], user=last["user"])
        comments = {k: v for k, v in (last["columns"] or {}).items() if v and k in df.columns}
        keys = [k for k in last["partition_by"] if k in df.columns]
        args = {**kept, "comments": comments, "changes": "altered", "partition_by": keys, "row_ids": last["next_row_id"] is not None}
        return self.publish(df, name, **{**args, **kw})

    # -- changes to some rows: files without such rows stay as they are --

    def merge(
        self,
        name: str,
        source: DataFrame,
        on: Sequence[str],
        matched: str | dict[str, str] | None = "update",
        matched_if: str | None = None,
        not_matched: str | None = "insert",
        **kw,
    ) -> int:
        """Merge ``source`` into a dataset on equal keys, as ``operators.changes.merge`` does.

        Files that hold a key of the source are written anew, as far as their rows remain; the version refers to all others.
        """
        source = source.drop(ROW_ID)
        keys = source.select(*on).dropna().distinct()

        def holding(rows: DataFrame) -> DataFrame:
            return rows.join(keys, list(on), "left_semi")

        return self._rewrite(name, holding, lambda rows: change_ops.merge(rows, source, on, matched, matched_if, not_matched), **kw)

    def delete_where(self, name: str, condition: Column, **kw) -> int:
        """Delete the rows where the condition holds. Files without such rows stay as they are."""
        return self._rewrite(name, lambda rows: rows.filter(condition), lambda rows: change_ops.delete_where(rows, condition), **kw)

    def update_where(self, name: str, values: dict[str, Column], condition: Column, **kw) -> int:
        """Set columns where the condition holds. Files without such rows stay as they are."""
        return self._rewrite(name, lambda rows: rows.filter(condition), lambda rows: change_ops.update_where(rows, values, condition), **kw)

    def _rewrite(self, name: str, holding: Callable, changed: Callable, **kw) -> int:
        """A version in which the rows of some files, those that ``holding`` finds, are replaced by their ``changed`` rows."""
        last = self._entry(name)
        schema, keys = schema_of(last, last["next_row_id"] is not None), list(last["partition_by"])
        before, without = list(last["folders"]), list(last["without"] or ())
        rows = read_folders(self.spark, schema, before, keys, without=without, file=FILE)
        # names of the files that are written anew: the log keeps them
        touched = [r[FILE] for r in holding(rows).select(FILE).distinct().collect()]
        chosen = read_folders(self.spark, schema, before, keys, only=touched) if touched else self.spark.createDataFrame([], schema)
        left = last["row_count"] - (chosen.count() if touched else 0)  # from footers
        gone = [*without, *touched]
        kept = _still_used(self.spark, before, gone) if touched else before
        gone = [f for f in gone if any(is_inside(f, folder) for folder in kept)]
        beside = dict(beside=kept, without=gone, beside_rows=left, beside_stats=last["stats"]) if kept else {}
        return self.replace_rows(changed(chosen), name, **{**beside, **kw})

    def rollback(self, name: str, version: int, now: datetime | None = None) -> int:
        """Make an older version the current one again. No data is copied."""
        row = self._entry(name, version).asDict()
        new = self._next_version(name)
        row.update(
            version=new, kind="rollback", target_version=version, changes=f"rolled back to {version}",
            published_at=now or datetime.now(timezone.utc),
        )
        self._append_log(name, [row])
        return new

    def rename(self, old: str, new: str, now: datetime | None = None) -> int:
        """Give a dataset's newest version another name. No data is copied; older versions stay under the old name."""
        if self._next_version(new) > 1 and self.latest().filter(F.col("name") == new).limit(1).count():
            raise FileExistsError(f"{new} is already on the shelf")
        row = self._entry(old).asDict()
        stamp = now or datetime.now(timezone.utc)
        version = self._next_version(new)
        row.update(
            version=version, kind="publish", target_version=None, changes=f"renamed from {old}", published_at=stamp,
            title=new if row["title"] == old else row["title"],
        )
        self._append_log(new, [row])
        self.drop(old, stamp)
        return version

    def drop(self, name: str, now: datetime | None = None) -> bool:
        """Take a dataset off the shelf. A second call does nothing; old versions stay readable by number."""
        if not self.latest().filter(F.col("name") == name).limit(1).count():
            return False
        self._append_log(
            name,
            [dict(version=self._next_version(name), kind="drop", changes="dropped", published_at=now or datetime.now(timezone.utc))],
        )
        return True

    def mark_expired(self, rows: Sequence[tuple[str, int]], now: datetime | None = None) -> None:
        """Hide versions; their folders are removed by ``plans.maintain``."""
        stamp = now or datetime.now(timezone.utc)
        for name in sorted({n for n, _ in rows}):
            self._append_log(
                name,
                [dict(version=v, kind="expire", target_version=v, published_at=stamp, changes="expired") for n, v in rows if n == name],
            )


def check_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise when a required column holds a NULL. One scan of just those columns."""
    if not columns:
        return
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"NULL in required columns: {bad}")


def schema_of(entry, row_ids: bool = False) -> T.StructType:
    """The schema that the log holds, so that no footer is opened to plan a read."""
    schema = T.StructType.fromJson(json.loads(entry["schema_json"]))
    return T.StructType([*schema.fields, T.StructField(ROW_ID, T.LongType())]) if row_ids else schema


def _beside(entry) -> dict:
    """What a version that refers to all rows of another one says about them."""
    return dict(
        beside=list(entry["folders"]), without=list(entry["without"] or ()), beside_rows=entry["row_count"], beside_stats=entry["stats"]
    )


def _measures(schema: T.StructType) -> dict[str, Column]:
    """Aggregates that say how many rows there are, and of each column the nulls and, if it has an order, the bounds."""
    out = {"rows": F.count(F.lit(1))}
    for i, f in enumerate(schema.fields):
        column = F.col(f"`{f.name}`")
        out[f"nulls_{i}"] = F.count_if(column.isNull())
        if isinstance(f.dataType, BOUNDED):
            out[f"low_{i}"], out[f"high_{i}"] = F.min(column).cast("string"), F.max(column).cast("string")
    return out


def _stats_of(got: dict, schema: T.StructType) -> dict[str, list]:
    return {f.name: [got[f"nulls_{i}"], got.get(f"low_{i}"), got.get(f"high_{i}")] for i, f in enumerate(schema.fields)}


def _check_required(got: dict, schema: T.StructType, not_null: Sequence[str] = ()) -> None:
    required = {*not_null, *required_columns(schema)}
    bad = {f.name: got[f"nulls_{i}"] for i, f in enumerate(schema.fields) if f.name in required and got[f"nulls_{i}"]}
    if bad:
        raise ValueError(f"NULL in required columns: {bad}")


def _merged_stats(old: dict, new: dict, schema: T.StructType, fewer: bool) -> dict:
    """Statistics of old and new rows together; where old rows may have gone (``fewer``), null counts are not known."""
    out = {}
    for f in schema.fields:
        if f.name not in old:
            out[f.name] = [None, None, None]
            continue
        (n, low, high), (m, lower, higher) = old[f.name], new[f.name]
        if isinstance(f.dataType, (T.IntegralType, T.FractionalType)):
            order = Decimal
        else:
            order = str  # dates and times of four-digit years
        lows, highs = [x for x in (low, lower) if x is not None], [x for x in (high, higher) if x is not None]
        out[f.name] = [
            None if fewer or n is None else n + m,
            min(lows, key=order) if lows else None, max(highs, key=lambda x: _nan_last(x, order)) if highs else None,
        ]
    return out


def _nan_last(text: str, order: Callable):
    return (text == "NaN", order("0") if text == "NaN" else order(text))


def is_inside(file: str, folder: str) -> bool:
    """Whether a file, as ``_metadata.file_path`` spells it, is below a folder."""
    return unquote(file).startswith(f"{folder}/")


def listed_files(spark: SparkSession, folders: Sequence[str], without: Sequence[str] = ()) -> DataFrame:
    """Data files of folders, but for those ``without``: path, length."""
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(list(folders))
    if without:
        listed = listed.filter(~F.col("_metadata.file_path").isin(list(without)))
    return listed.select("path", "length")


def _still_used(spark: SparkSession, folders: Sequence[str], gone: Sequence[str]) -> list[str]:
    """Folders that still hold a file besides those gone. One row for each folder reaches the driver."""
    listed = listed_files(spark, folders, gone)
    inside = F.coalesce(*[F.when(F.col("path").startswith(f"{f}/"), F.lit(f)) for f in folders])
    used = {r["folder"] for r in listed.select(inside.alias("folder")).distinct().collect()}
    return [f for f in folders if f in used]


def read_folders(
    spark: SparkSession,
    schema: T.StructType,
    folders: Sequence[str],
    keys: Sequence[str],
    *,
    without: Sequence[str] = (),
    only: Sequence[str] | None = None,
    file: str | None = None,
) -> DataFrame:
    """The rows of all folders, but for the files ``without``, or of the files ``only``; with ``file``, a column of names.

    Files are left out when they are listed, so nothing of them is read. Folders with partition columns are one scan, in
    which a version's folder is a partition like others; a dataset that took over folders of another name has one for each.
    """
    chosen = [F.col(f"`{n}`") for n in schema.names] + ([F.col("_metadata.file_path").alias(file)] if file else [])

    def scan(reader, paths: Sequence[str]) -> DataFrame:
        df = reader.parquet(*paths)
        if only is not None:
            df = df.filter(F.col("_metadata.file_path").isin(list(only)))
        elif without:
            df = df.filter(~F.col("_metadata.file_path").isin(list(without)))
        return df.select(*chosen)

    if not keys:
        return scan(spark.read.schema(schema), folders)
    bases: dict[str, list[str]] = {}
    for folder in folders:
        base, _, last = folder.rpartition("/")
        bases.setdefault(base if last.startswith(f"{VERSION_KEY}=") else folder, []).append(folder)
    scans = []
    for base, paths in bases.items():
        versioned = T.StructType([*schema.fields, T.StructField(VERSION_KEY, T.StringType())])
        reader = spark.read.schema(schema) if paths == [base] else spark.read.schema(versioned).option("basePath", base)
        scans.append(scan(reader, paths))
    return reduce(DataFrame.unionByName, scans)


def export_chunks(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write Parquet files of at most ``rows_per_file`` rows each. Returns how many there are."""
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return list_files(df.sparkSession, path, "*.parquet").count()
