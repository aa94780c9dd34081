"""Upkeep of a shelf: expire versions, merge small files, remove what nothing refers to."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datashelf.sources.files import LISTING, child_names, children, files_below, path_exists, qualified, remove_path
from datashelf.sources.shelf import LOG_FOLDER, Shelf, is_inside, read_folders, schema_of

# Retention and target file size.
RETENTION = timedelta(days=90)
TARGET_FILE_BYTES = 512 * 1024 * 1024
DATASETS_AT_A_TIME = 4


def expired_versions(shelf: Shelf, older_than: datetime | None = None, versions: list[int] | None = None, name: str | None = None) -> DataFrame:
    """Versions that may go: by age, or by number within one dataset. The newest version of a dataset always stays."""
    if versions is not None and name is None:
        raise ValueError("version numbers need the name of their dataset")
    known = shelf.versions(name)
    newest = known.groupBy("name").agg(F.max("version").alias("newest"))
    old = known.join(newest, "name").filter(F.col("version") < F.col("newest"))
    if versions is not None:
        return old.filter(F.col("version").isin(versions)).select("name", "version", "published_at", "folders")
    limit = older_than or datetime.now(timezone.utc) - RETENTION
    return old.filter(F.col("published_at") < F.lit(limit)).select("name", "version", "published_at", "folders")


def expire(shelf: Shelf, older_than: datetime | None = None, versions: list[int] | None = None, name: str | None = None, dry_run: bool = True) -> list[tuple[str, int]]:
    """List the versions to expire; unless ``dry_run``, hide them and delete folders no other version uses."""
    rows = expired_versions(shelf, older_than, versions, name).collect()  # one row per version, not per file
    chosen = sorted((r["name"], r["version"]) for r in rows)
    if not dry_run and rows:
        shelf.mark_expired(chosen)
        # Folders of expired versions that no other version refers to; as many as there were publishes, not files. Folders
        # outside the shelf, whose files were added to a dataset, are not the shelf's to delete.
        root = qualified(shelf.spark, shelf.root)
        own = [(f,) for r in rows for f in r["folders"] if is_inside(f, root)]
        gone = shelf.spark.createDataFrame(own, "folder string").distinct()
        remove_folders(shelf.spark, [r["folder"] for r in gone.join(tracked_folders(shelf), "folder", "left_anti").collect()])
    return chosen


def compact(shelf: Shelf, name: str, target_bytes: int = TARGET_FILE_BYTES, now: datetime | None = None) -> int | None:
    """Rewrite a dataset's folders of small files as one with fewer files near the target size. Rows do not change.

    Only folders whose files are on average below a quarter of the target are read and written; the others are
    referred to as they are. Partition columns stay. Without them, neighbouring input is merged without a shuffle.
    Returns the new version, or None when there is nothing to gain.
    """
    last = shelf._entry(name)
    keys, folders = list(last["partition_by"]), list(last["folders"])
    inside = F.coalesce(*[F.when(F.col("data_file").startswith(f"{f}/"), F.lit(f)) for f in folders])
    sizes = shelf.files(name).groupBy(inside.alias("folder")).agg(F.count("*").alias("n"), F.sum("data_file_size_bytes").alias("bytes"))
    small = {r["folder"]: r for r in sizes.collect() if r["bytes"] < r["n"] * target_bytes / 4}  # a row for each folder
    n, size = sum(r["n"] for r in small.values()), sum(r["bytes"] for r in small.values())
    wanted = max(1, math.ceil(size / target_bytes))
    if n <= wanted:
        return None
    without = list(last["without"] or ())
    with_ids = last["next_row_id"] is not None
    rows = read_folders(shelf.spark, schema_of(last, with_ids), [f for f in folders if f in small], keys, without=without)
    if keys:
        # as many files as partition values at least: no gain if there are no more
        if n <= max(wanted, rows.select(*keys).distinct().count()):
            return None
    else:
        rows = rows.coalesce(wanted)
    return shelf.replace_rows(
        rows, name, kind="compact", changes="compacted", rows_per_file=None, now=now,
        beside=[f for f in folders if f not in small],
        without=[f for f in without if not any(is_inside(f, folder) for folder in small)], beside_stats=last["stats"],
    )


def tracked_folders(shelf: Shelf) -> DataFrame:
    return shelf.versions().select(F.explode("folders").alias("folder")).distinct()


def remove_folders(spark: SparkSession, folders: list[str]) -> int:
    return sum(remove_path(spark, folder) for folder in folders)


def orphan_folders(shelf: Shelf, older_than: datetime | None = None) -> DataFrame:
    """(folder, modified) of version folders below the root that no version refers to, hidden ones included.

    These are what publishes leave that died. Only folder names are listed: one for each publish.
    """
    found = []
    for name in child_names(shelf.spark, shelf.root):
        if name != LOG_FOLDER:
            found += [f for f in children(shelf.spark, f"{shelf.root}/{name}")]
    listed = shelf.spark.createDataFrame(found, "folder string, modified timestamp")
    orphans = listed.join(tracked_folders(shelf), "folder", "left_anti")
    return orphans if older_than is None else orphans.filter(F.col("modified") < F.lit(older_than))


def orphan_files(shelf: Shelf, older_than: datetime | None = None) -> DataFrame:
    """Files of orphan folders: (path, length, modificationTime), hidden ones included."""
    folders = [r["folder"] for r in orphan_folders(shelf, older_than).collect()]
    rows = [f for folder in folders for f in files_below(shelf.spark, folder)]
    return shelf.spark.createDataFrame(rows, LISTING)


def remove_orphans(shelf: Shelf, older_than: datetime, dry_run: bool = True) -> int:
    """Number of orphan folders older than a time; unless ``dry_run`` they are deleted, each by one call."""
    doomed = [r["folder"] for r in orphan_folders(shelf, older_than).collect()]
    return len(doomed) if dry_run else remove_folders(shelf.spark, doomed)


def maintain(shelf: Shelf, *, older_than: datetime | None = None, target_bytes: int = TARGET_FILE_BYTES, dry_run: bool = False) -> DataFrame:
    """Expire, compact, then clean up, in this order. Returns (step, subject, count)."""
    done: list[tuple[str, str, int]] = []
    gone = expire(shelf, older_than, dry_run=dry_run)
    done.append(("expire", "versions", len(gone)))
    merged = 0
    if not dry_run:
        names = [r["name"] for r in shelf.list_datasets().collect()]
        with ThreadPoolExecutor(DATASETS_AT_A_TIME) as pool:
            merged = sum(v is not None for v in pool.map(lambda n: compact(shelf, n, target_bytes), names))
    done.append(("compact", "datasets", merged))
    limit = older_than or datetime.now(timezone.utc) - RETENTION
    done.append(("clean up", "folders", remove_orphans(shelf, limit, dry_run) if path_exists(shelf.spark, shelf.root) else 0))
    return shelf.spark.createDataFrame(done, "step string, subject string, count long")
