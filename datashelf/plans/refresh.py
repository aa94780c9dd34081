"""The whole refresh: check sources, publish, reconcile, catalogue, report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datashelf.functions.crs import set_crs
from datashelf.functions.geometry import geometry_type
from datashelf.functions.wkb import decode_wkb, wkb_type
from datashelf.operators.validity import normalise_wkb
from datashelf.plans.catalogue import SPATIAL_META, columns_catalogue, datasets_catalogue
from datashelf.plans.quality import preflight, reason_of, reconcile_counts, run_summary
from datashelf.plans.views import ViewRegistry
from datashelf.sources.shelf import Shelf

CATALOGUES = ("datasets_catalogue", "columns_catalogue")
COPIES_AT_A_TIME = 4


class WrongGeometryType(ValueError):
    """A geometry is not of the type that its table declares."""


@dataclass(frozen=True)
class Spatial:
    """How the geometry of a table is published."""

    column: str
    geometry_type: str
    crs: str
    rule: str = "decode"
    ids: tuple[str, ...] = ()


@dataclass
class Table:
    load: Callable[[], DataFrame]
    title: str | None = None
    comments: dict[str, str] = field(default_factory=dict)
    spatial: Spatial | None = None


@dataclass
class Config:
    shelf: Shelf
    tables: dict[str, Table]
    views: ViewRegistry | None = None
    source_db: str = ""
    now: datetime | None = None


def publish_spatial(shelf: Shelf, df: DataFrame, name: str, spatial: Spatial, **publish_args) -> int:
    """Normalise the geometry, then publish its WKB with its keys in the metadata and its CRS on the column.

    Every geometry must be of the declared type (``GEOMETRY``: any). The bytes are kept, so Z, M and SRID stay.
    """
    shaped = normalise_wkb(df, spatial.column, spatial.rule, spatial.ids)
    declared = spatial.geometry_type.upper()
    other = F.when(wkb_type(F.col(spatial.column)) != declared, wkb_type(F.col(spatial.column)))

    def verify(found: dict) -> None:
        if declared != "GEOMETRY" and found["other_type"] is not None:
            raise WrongGeometryType(f"{name}: declared {spatial.geometry_type}, holds {found['other_type']}")

    stored = set_crs(shaped, spatial.column, spatial.crs)
    user = {
        **publish_args.pop("user", {}),
        "spatial": "true",
        "geometry_column": spatial.column,
        "geometry_type": spatial.geometry_type,
        "crs": spatial.crs,
    }
    # types are looked at while the rows are written; a wrong one keeps the version from becoming visible
    return shelf.publish(stored, name, user=user, observe={"other_type": F.min(other)}, verify=verify, **publish_args)


def read_geo(shelf, name: str, version: int | None = None) -> DataFrame:
    """A spatial dataset with its WKB column decoded and the CRS attached."""
    user = shelf.meta(name, version).first()["user"] or {}
    if user.get("spatial", "").lower() != "true":
        raise ValueError(f"{name} is not spatial")
    column = user["geometry_column"]
    df = shelf.read(name, version)
    return set_crs(df.withColumn(column, decode_wkb(F.col(column))), column, user["crs"])


def geometry_types(df: DataFrame, column: str) -> DataFrame:
    """Distinct geometry types of a decoded column with their counts."""
    return df.groupBy(geometry_type(F.col(column)).alias("geometry_type")).agg(F.count(F.lit(1)).alias("n"))


def refresh(config: Config) -> DataFrame:
    """Run everything and return one row per table: passed, reason, rows.

    Each table is written once, as a version folder. The folder becomes a version only if it holds as many rows as the
    source had, so a failed copy never replaces a good version. A table that fails is reported and the others go on.
    Tables go several at a time, as far as the cluster has room.
    """
    shelf, spark = config.shelf, config.shelf.spark
    now = config.now or datetime.now(timezone.utc)
    counted = preflight(spark, {n: t.load for n, t in config.tables.items()})  # raises before anything is touched
    expected = {r["table_name"]: r["row_count"] for r in counted.collect()}

    def copy(name: str) -> tuple[str, int | None, str | None]:
        table = config.tables[name]
        args = dict(
            title=table.title, comments=table.comments, now=now, changes="refreshed",
            description=f"{table.title or name}, refreshed {now:%Y-%m-%d}",
            user={"source_db": config.source_db}, expected_rows=expected[name],
        )
        try:
            if table.spatial:
                version = publish_spatial(shelf, table.load(), name, table.spatial, **args)
            else:
                version = shelf.publish(table.load(), name, **args)
            return name, shelf.meta(name, version).first()["row_count"], None
        except Exception as error:  # noqa: BLE001 - reported per table
            return name, None, reason_of(error)

    with ThreadPoolExecutor(COPIES_AT_A_TIME) as pool:
        done = list(pool.map(copy, config.tables))
    written = spark.createDataFrame([(n, c) for n, c, _ in done], "table_name string, row_count long")
    found = spark.createDataFrame([(n, why) for n, _, why in done if why], "table_name string, reason string")
    if len(done) > found.count():
        publish_catalogues(config, now)
    return run_summary(reconcile_counts(counted, written), found)


def publish_catalogues(config: Config, now: datetime) -> None:
    """Build both catalogues from everything on the shelf, and all views whose tables are there, and publish them."""
    shelf, spark = config.shelf, config.shelf.spark
    entries = {r["name"]: r for r in shelf.latest().collect() if r["name"] not in CATALOGUES}  # a row for each dataset
    tables = {n: shelf._load(r) for n, r in entries.items()}
    users = {n: r["user"] or {} for n, r in entries.items()}
    shapes = {n: u for n, u in users.items() if u.get("spatial", "").lower() == "true"}
    spatial = spark.createDataFrame(
        [(n, u["geometry_column"], u["geometry_type"], u["crs"]) for n, u in shapes.items()], SPATIAL_META
    )
    geometries = {n: (read_geo(shelf, n), u["geometry_column"]) for n, u in shapes.items()}
    comments = {n: "" if r["title"] == n else r["title"] or "" for n, r in entries.items()}
    datasets = datasets_catalogue(
        spark, tables, comments, now.replace(tzinfo=None), usable_by(config, list(tables)), spatial, geometries
    )
    shelf.publish(datasets, CATALOGUES[0], title="Data catalogue", changes="refreshed", now=now)
    columns = columns_catalogue(spark, tables, spatial)
    shelf.publish(columns, CATALOGUES[1], title="Column catalogue", changes="refreshed", now=now)


def usable_by(config: Config, names: Sequence[str]) -> ViewRegistry | None:
    """Views all of whose base tables are among ``names``."""
    if config.views is None:
        return None
    kept = ViewRegistry()
    for view in config.views:
        if set(config.views.base_tables(view.name)) <= set(names):
            kept.add(view.name, view.sources, view.build, view.description)
    return kept
