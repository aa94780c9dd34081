"""Checks before and after publishing."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datashelf.functions.scalars import not_blank
from datashelf.functions.wkb import wkb_type
from datashelf.operators.stats import row_counts
from datashelf.plans.maintain import RETENTION
from datashelf.plans.views import ViewRegistry
from datashelf.sources.shelf import Shelf, ShelfReader

PREFLIGHT = "table_name string, readable boolean, row_count long, reason string"


class PreflightFailed(RuntimeError):
    """A source cannot be read; nothing was changed."""


def reason_of(error: Exception) -> str:
    """One line that says what went wrong."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()]
    # An error raised inside a Python function comes last, under the worker's stack trace.
    told = [line for line in lines if re.match(r"\w*(Error|Exception): ", line)]
    return ([*told[-1:], *lines] or [type(error).__name__])[0]


def preflight(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], stop: bool = True) -> DataFrame:
    """Open and count every source. With ``stop``, raise if any of them fails."""
    opened, problems = {}, {}
    for name, load in sources.items():
        try:
            opened[name] = load()
        except Exception as error:  # noqa: BLE001 - whatever the source raises is the finding
            problems[name] = reason_of(error)
    counts: dict[str, int] = {}
    try:
        if opened:
            counts = {r["table_name"]: r["row_count"] for r in row_counts(opened).collect()}
    except Exception:  # noqa: BLE001 - find out which one it was
        for name, df in opened.items():
            try:
                counts[name] = df.count()
            except Exception as error:  # noqa: BLE001
                problems[name] = reason_of(error)
    if stop and problems:
        raise PreflightFailed(f"unreadable sources: {problems}")
    rows = [(n, n in counts, counts.get(n), problems.get(n)) for n in sources]
    return spark.createDataFrame(rows, PREFLIGHT)


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Two (table_name, row_count) frames side by side with MATCH or MISMATCH; a missing side is a mismatch."""
    a = source.select("table_name", F.col("row_count").alias("source_rows"))
    b = target.select("table_name", F.col("row_count").alias("target_rows"))
    same = F.col("source_rows").eqNullSafe(F.col("target_rows")) & F.col("source_rows").isNotNull()
    return a.join(b, "table_name", "full").withColumn("status", F.when(same, "MATCH").otherwise("MISMATCH"))


def run_summary(reconciled: DataFrame, failures: DataFrame) -> DataFrame:
    """Per table: passed or not and why. ``failures`` has (table_name, reason)."""
    reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(
        F.col("status") == "MISMATCH", F.concat_ws(" ", F.lit("row counts differ:"), "source_rows", F.lit("vs"), "target_rows")
    )
    return (
        reconciled.join(failures, "table_name", "full")
        .withColumn("reason", reason)
        .withColumn("passed", F.col("reason").isNull())
        .select("table_name", "passed", "reason", "source_rows", "target_rows")
    )


def verdict(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_if("passed").alias("n_passed"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
    )


def _heads(shelf: ShelfReader, rows: list) -> dict[str, bool]:
    """Whether the first rows of each dataset can be read: one job for all, halved where one of them fails."""
    if not rows:
        return {}
    try:
        frames = [
            shelf._load(r).limit(5).agg((F.count(F.lit(1)) > 0).alias("ok")).select(F.lit(r["name"]).alias("name"), "ok")
            for r in rows
        ]
        return {r["name"]: r["ok"] for r in reduce(DataFrame.unionAll, frames).collect()}
    except Exception:  # noqa: BLE001 - an unreadable dataset is a failed check
        if len(rows) == 1:
            return {rows[0]["name"]: False}
        half = len(rows) // 2
        return {**_heads(shelf, rows[:half]), **_heads(shelf, rows[half:])}


def publish_contract(shelf: ShelfReader) -> DataFrame:
    """Per dataset: has a title, column docs, rows, columns, a readable head; spatial ones also their geometry keys."""
    latest = shelf.latest()
    readable = shelf.spark.createDataFrame(
        sorted(_heads(shelf, latest.collect()).items()), "name string, head_ok boolean"  # a row for each dataset
    )
    user = F.col("user")
    wanted = [F.try_element_at(user, F.lit(k)) for k in ("geometry_column", "geometry_type", "crs")]
    spatial = F.lower(F.try_element_at(user, F.lit("spatial"))) == "true"
    checks = latest.select(
        "name",
        not_blank(F.col("title")).alias("title_ok"),
        (F.size(F.col("columns")) > 0).alias("columns_ok"),
        (F.col("row_count") > 0).alias("rows_ok"),
        (F.col("n_columns") > 0).alias("width_ok"),
        F.when(spatial, reduce(lambda a, b: a & b, [not_blank(w) for w in wanted])).otherwise(F.lit(True)).alias("spatial_ok"),
    ).join(readable, "name")
    passed = reduce(
        lambda a, b: a & b, [F.col(c) for c in ("title_ok", "columns_ok", "rows_ok", "width_ok", "spatial_ok", "head_ok")]
    )
    return checks.withColumn("passed", passed)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Same columns and the same rows with the same multiplicity."""
    if a.columns != b.columns or [f.dataType for f in a.schema] != [f.dataType for f in b.schema]:
        return False
    counted = (
        a.withColumn("__side", F.lit(1)).unionAll(b.withColumn("__side", F.lit(-1)))
        .groupBy(*a.columns).agg(F.sum("__side").alias("__balance"))
    )
    return not counted.filter("__balance <> 0").limit(1).count()


def geometry_expectations(df: DataFrame, wkb: str, *, geometry_type: str, min_rows: int, flag: str | None = None,
                          max_invalid: int = 0) -> DataFrame:
    """Checks of a spatial table: (check, passed, detail). One scan; types come from the WKB headers.

    At least ``min_rows`` rows, geometries of one type only, and at most ``max_invalid`` that column ``flag`` calls
    invalid (without ``flag`` that check is left out).
    """
    kind = wkb_type(F.col(wkb))
    invalid = F.count_if(~F.col(flag)) if flag else F.lit(0)
    found = df.agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(kind)).alias("kinds"), invalid.alias("invalid")
    ).first()
    results = [
        ("rows", found["n"] >= min_rows, f"{found['n']} of at least {min_rows}"),
        ("single type", found["kinds"] == [geometry_type], ", ".join(found["kinds"])),
    ]
    if flag:
        results.append(("validity", found["invalid"] <= max_invalid, f"{found['invalid']} invalid, at most {max_invalid}"))
    return df.sparkSession.createDataFrame(results, "check string, passed boolean, detail string")


def shelf_checks(
    shelf: Shelf, views: ViewRegistry, sample: str, key, *, tables: int, comments: int, column_comments: int, min_views: int,
    retention: timedelta = RETENTION, now: datetime | None = None,
) -> DataFrame:
    """Acceptance checks of a whole shelf: (check, passed, detail).

    ``sample`` names a dataset with at least two versions; ``key`` its key columns. Views count if all tables they read
    are on the shelf. Retention holds if no replaced version is older than it.
    """
    names = {r["name"] for r in shelf.list_datasets().collect()}  # a row for each dataset
    counted = sum(set(views.base_tables(v.name)) <= names for v in views)
    limit = (now or datetime.now(timezone.utc)) - retention
    all_versions = shelf.versions()
    newest = all_versions.groupBy("name").agg(F.max("version").alias("newest"))
    old = all_versions.join(newest, "name").filter((F.col("version") < F.col("newest")) & (F.col("published_at") < F.lit(limit))).count()
    latest = shelf.latest()
    facts = latest.agg(
        F.count_if(~F.col("name").endswith("_catalogue")).alias("tables"),
        F.count_if(F.col("title") != F.col("name")).alias("titled"),
        F.coalesce(
            F.sum(F.size(F.filter(F.map_values("columns"), lambda c: not_blank(c)))), F.lit(0)
        ).alias("documented"),
    ).first()
    numbers = [r["version"] for r in shelf.versions(sample).orderBy(F.desc("version")).limit(2).collect()]
    results = [
        ("table count", facts["tables"] == tables, f"{facts['tables']} of {tables}"),
        ("table comments", facts["titled"] >= comments, f"{facts['titled']} of at least {comments}"),
        ("column comments", facts["documented"] >= column_comments, f"{facts['documented']} of at least {column_comments}"),
        ("views", counted >= min_views, f"{counted} of at least {min_views}"),
        ("versions", len(numbers) >= 2, f"{len(numbers)} newest versions found"),
    ]
    if len(numbers) >= 2:
        newer, older = numbers
        counts = [shelf.read(sample, version=v).count() for v in (older, newer)]
        changes = shelf.table_changes(sample, older, newer, key).count()
        results += [
            ("time travel", min(counts) > 0, f"{counts[0]} and {counts[1]} rows"),
            ("change feed", changes >= 1, f"{changes} changes"),
        ]
    results.append(("retention", old == 0, f"{old} versions are older than {retention.days} days"))
    reader = shelf.at(version=max(numbers or [0]))
    writes = {m for m in vars(Shelf) if not m.startswith("_") and callable(getattr(Shelf, m))}
    read_only = not any(hasattr(reader, m) for m in writes) and reader.read(sample).limit(1).count() == 1
    results.append(("read-only access", read_only, f"{len(reader.read(sample).columns)} columns described"))
    return shelf.spark.createDataFrame(results, "check string, passed boolean, detail string")
