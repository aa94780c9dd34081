"""Statistics, the catalogue and the checks."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from datashelf.operators import stats as st
from datashelf.plans import catalogue as cat
from datashelf.plans import quality as q
from datashelf.plans.refresh import Config, Spatial, Table, refresh
from datashelf.session import fresh_folder
from datashelf.sources.shelf import Shelf
from shelf_queries import inputs as I
from shelf_queries.basic import COUNTS
from shelf_queries.curated import registry, sources
from shelf_queries.inputs import table
from shelf_queries.published import FEED, T0, new_shelf, three_versions
from shelf_queries.registry import query

STAMP = datetime(2025, 1, 1, 12, 0, 0)

# Column names and types of the tables whose columns the SQL side lists.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def columns_of(name: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ")) for c in SCHEMAS[name].split(",")]


def listed(spark, sf, names=tuple(SCHEMAS)):
    return {n: table(spark, sf, n) for n in names}


# ---- statistics ----


def _stats_sql(name: str, where: str = "") -> str:
    def one(column: str, kind: str) -> str:
        nan = f"coalesce(bool_or(isnan({column})), false)" if kind == "double" else "false"
        return f"""SELECT '{column}' AS column_name, '{kind}' AS column_type, coalesce(bool_or({column} IS NULL), false) AS contains_null,
        {nan} AS contains_nan, CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value FROM {name} {where}"""

    return " UNION ALL ".join(one(c, k) for c, k in columns_of(name))


@query("column_stats", _stats_sql("customer"))
def column_stats(spark, sf):
    return st.column_stats(table(spark, sf, "customer"))


@query("merge_stats", _stats_sql("part"))
def merge_stats(spark, sf):
    """Statistics of three parts, combined, equal those of the whole."""
    part = table(spark, sf, "part")
    return st.merge_stats(*[st.column_stats(part.filter(F.col("p_partkey") % 3 == i)) for i in range(3)])


def _split(spark, sf, name: str, key: str, n: int) -> str:
    folder = fresh_folder(spark, "files")
    for i in range(n):
        table(spark, sf, name).filter(F.col(key) % n == i).write.parquet(f"{folder}/{i}")
    return folder


@query(
    "file_column_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS value_count, count(*) - count({c}) AS null_count,
        CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM part"""
        for c, k in columns_of("part")
        if k == "string"
    ),
)
def file_column_stats(spark, sf):
    """Per file, then summed over files for the text columns (file names differ from run to run)."""
    files = st.file_column_stats(spark.read.option("recursiveFileLookup", True).parquet(_split(spark, sf, "part", "p_partkey", 3)))
    return files.filter("column_type = 'string'").groupBy("column_name").agg(
        F.sum("value_count").alias("value_count"), F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
    )


@query("table_stats", "SELECT count(*) AS record_count, true AS has_bytes FROM lineitem")
def table_stats(spark, sf):
    folder = _split(spark, sf, "lineitem", "l_orderkey", 2)
    found = st.table_stats(spark, folder)
    return found.select("record_count", ((F.col("file_size_bytes") > 0) & (F.col("file_count") >= 2)).alias("has_bytes"))


@query(
    "prune_files",
    """SELECT bucket, count(*) AS n FROM (SELECT p_partkey % 4 AS bucket, p_size FROM part)
    GROUP BY bucket HAVING min(p_size) <= 10 AND max(p_size) >= 10 AND bucket IN (0, 2)""",
)
def prune_files(spark, sf):
    """Files that may hold size 10, when the odd buckets hold only sizes beyond it."""
    folder = fresh_folder(spark, "files")
    size = F.when(F.col("p_partkey") % 2 == 1, F.col("p_size") + 100).otherwise(F.col("p_size")).alias("p_size")
    for i in range(4):
        table(spark, sf, "part").filter(F.col("p_partkey") % 4 == i).select("p_partkey", size).coalesce(1).write.parquet(f"{folder}/{i}")
    files = spark.read.option("recursiveFileLookup", True).parquet(folder)
    kept = st.prune_files(st.file_column_stats(files), "p_size", "=", 10, "int")
    rows = files.select("p_partkey", F.col("_metadata.file_path").alias("data_file")).join(kept, "data_file", "left_semi")
    return rows.groupBy((F.col("p_partkey") % 4).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _text(column: str, kind: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(38,6)) AS VARCHAR)" if kind == "double" else f"CAST({column} AS VARCHAR)"


def _samples_sql(name: str) -> str:
    def one(column: str, kind: str) -> str:
        if kind.startswith("array"):
            return f"SELECT '{column}' AS column_name, " + ", ".join(f"CAST(NULL AS VARCHAR) AS example_{i}" for i in (1, 2, 3))
        nth = ", ".join(f"max(v) FILTER (WHERE rn = {i}) AS example_{i}" for i in (1, 2, 3))
        return f"""SELECT '{column}' AS column_name, {nth} FROM (SELECT {_text(column, kind)} AS v, row_number() OVER (ORDER BY {column}) AS rn
        FROM (SELECT DISTINCT {column} FROM {name} WHERE {column} IS NOT NULL))"""

    return " UNION ALL ".join(one(c, k) for c, k in columns_of(name))


@query("sample_distinct", _samples_sql("part"))
def sample_distinct(spark, sf):
    return st.sample_distinct(table(spark, sf, "part"))


# ---- catalogue ----


def _columns_sql(extra: str = "") -> str:
    rows = [(t, c, k, i) for t in SCHEMAS for i, (c, k) in enumerate(columns_of(t))]
    values = ", ".join(f"('{t}', '{c}', '{k}', {i})" for t, c, k, i in rows)
    return f"SELECT * FROM (VALUES {values}) c(table_name, column_name, data_type, ordinal)"


@query("describe_table", f"SELECT c.*, n.row_count FROM ({_columns_sql()}) c JOIN ({COUNTS}) n USING (table_name)")
def describe_table(spark, sf):
    tables = listed(spark, sf)
    return cat.describe(spark, tables).drop("comment").join(st.row_counts(tables), "table_name")


@query("show_tables", f"SELECT table_name, 'view' AS type, row_count FROM ({COUNTS})")
def show_tables(spark, sf):
    tables = I.all_tables(spark, sf)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return cat.show_tables(spark).join(st.row_counts(tables), "table_name")


@query(
    "table_profile",
    f"""SELECT table_name, row_count, n_columns, table_name = 'areas' AS is_spatial, CASE WHEN table_name = 'areas' THEN 'spatial' ELSE 'plain' END AS copy_group
    FROM (SELECT table_name, count(*) AS n_columns FROM ({_columns_sql()}) GROUP BY table_name UNION ALL SELECT 'areas', 2)
    JOIN ({COUNTS} UNION ALL SELECT 'areas', count(*) FROM customer) USING (table_name)""",
)
def table_profile(spark, sf):
    return cat.table_profile(spark, {**listed(spark, sf), "areas": I.areas(spark, sf)})


@query(
    "comments_coverage",
    f"""SELECT table_name, count(*) AS n_columns, count(*) FILTER (WHERE column_name LIKE '%key') AS n_commented,
    count(*) FILTER (WHERE column_name LIKE '%key') >= 1 AS enough, any_value(row_count) AS row_count
    FROM ({_columns_sql()}) JOIN ({COUNTS}) USING (table_name) GROUP BY table_name""",
)
def comments_coverage(spark, sf):
    """Comment every key column from a comments table, then measure the coverage of what was published."""
    tables = listed(spark, sf)
    keys = cat.describe(spark, tables).filter(F.col("column_name").endswith("key"))
    comments = keys.select("table_name", "column_name", F.concat(F.lit("Key "), "column_name").alias("comment"))
    documented = {n: df for n, (df, _) in cat.apply_all_comments(tables, comments).items()}
    covered = cat.comments_coverage(cat.describe(spark, documented), 1)
    return covered.join(st.row_counts(documented), "table_name")


VIEW_ROWS = f"""SELECT 'inclusive_vw' AS name, 'Lookup with the extra area' AS description, 'lookup' AS source_table, (SELECT count(*) + 1 FROM ({I.LOOKUP})) AS row_count
  UNION ALL SELECT 'group_vw', 'Areas of one group', 'lookup', (SELECT count(*) + 1 FROM ({I.LOOKUP}) WHERE group_name = 'EUROPE')
  UNION ALL SELECT 'emissions_vw', 'Emissions with their group', 'emissions', (SELECT count(*) FROM ({I.EMISSIONS}))"""
BOX = """(SELECT min(easting) AS bbox_xmin, min(northing) AS bbox_ymin, max(easting) AS bbox_xmax, max(northing) AS bbox_ymax
  FROM (%s))""" % I.POINTS
DATASETS = f"""SELECT name, description, type, row_count, TIMESTAMP '2025-01-01 12:00:00' AS last_updated, source_table,
  CASE WHEN name = 'points' THEN 'POINT' END AS geometry_type, CASE WHEN name = 'points' THEN 'EPSG:27700' END AS crs,
  CASE WHEN name = 'points' THEN bbox_xmin END AS bbox_xmin, CASE WHEN name = 'points' THEN bbox_ymin END AS bbox_ymin,
  CASE WHEN name = 'points' THEN bbox_xmax END AS bbox_xmax, CASE WHEN name = 'points' THEN bbox_ymax END AS bbox_ymax
  FROM (SELECT table_name AS name, CASE WHEN table_name = 'orders' THEN 'All orders' ELSE '' END AS description, 'table' AS type,
  row_count, table_name AS source_table FROM ({COUNTS} UNION ALL SELECT 'points', count(*) FROM customer
  UNION ALL SELECT 'lookup', count(*) FROM ({I.LOOKUP}) UNION ALL SELECT 'emissions', count(*) FROM ({I.EMISSIONS}))
  UNION ALL SELECT name, description, 'view', row_count, source_table FROM ({VIEW_ROWS})), {BOX}"""


def _datasets(spark, sf):
    from datashelf.functions import wkb

    points = I.points(spark, sf)
    tables = {**I.all_tables(spark, sf), "points": points, **sources(spark, sf)}
    spatial = spark.createDataFrame([("points", "shape", "POINT", "EPSG:27700")], cat.SPATIAL_META)
    decoded = wkb.with_point_xy(points, "shape").select(wkb.point_geometry(F.col("x"), F.col("y")).alias("shape"))
    return cat.datasets_catalogue(
        spark, tables, {"orders": "All orders"}, STAMP, registry(), spatial, {"points": (decoded, "shape")}
    )


@query("datasets_catalogue", DATASETS)
def datasets_catalogue(spark, sf):
    return _datasets(spark, sf)


@query(
    "catalogue_search",
    f"SELECT name, type, row_count, geometry_type FROM ({DATASETS}) WHERE type = 'view' OR geometry_type IS NOT NULL",
)
def catalogue_search(spark, sf):
    found = _datasets(spark, sf)
    both = cat.search(found, "view").unionByName(cat.search(found, spatial_only=True))
    return both.select("name", "type", "row_count", "geometry_type")


@query(
    "columns_catalogue",
    f"""SELECT c.table_name, c.column_name, c.data_type, CAST(NULL AS VARCHAR) AS description, e.example_1, e.example_2, e.example_3, c.ordinal
    FROM ({_columns_sql()}) c JOIN ({" UNION ALL ".join(f"SELECT '{t}' AS table_name, * FROM ({_samples_sql(t)})" for t in SCHEMAS)}) e
    USING (table_name, column_name)""",
)
def columns_catalogue(spark, sf):
    return cat.columns_catalogue(spark, listed(spark, sf))


# ---- checks ----


@query(
    "preflight",
    f"SELECT table_name, true AS readable, row_count FROM ({COUNTS}) UNION ALL SELECT 'absent', false, NULL",
)
def preflight(spark, sf):
    loads = {n: (lambda n=n: table(spark, sf, n)) for n in [*I.TABLES, "absent"]}
    return q.preflight(spark, loads, stop=False).select("table_name", "readable", "row_count")


RECONCILED = f"""SELECT table_name, source_rows, target_rows, CASE WHEN source_rows = target_rows THEN 'MATCH' ELSE 'MISMATCH' END AS status
  FROM (SELECT table_name, row_count AS source_rows FROM ({COUNTS})) s LEFT JOIN
  (SELECT table_name, CASE WHEN table_name = 'customer' THEN (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0) ELSE row_count END AS target_rows
  FROM ({COUNTS}) WHERE table_name <> 'part') t USING (table_name)"""


def _reconciled(spark, sf):
    tables = I.all_tables(spark, sf)
    copies = {**tables, "customer": I.v1(spark, sf)}
    copies.pop("part")
    return q.reconcile_counts(st.row_counts(tables), st.row_counts(copies))


@query("reconcile_counts", RECONCILED)
def reconcile_counts(spark, sf):
    return _reconciled(spark, sf)


@query(
    "run_summary",
    f"""SELECT table_name, status = 'MATCH' AND table_name <> 'events' AS passed, CASE WHEN table_name = 'events' THEN 'disk full'
    WHEN status = 'MISMATCH' THEN 'row counts differ: ' || CAST(source_rows AS VARCHAR) || ' vs' || coalesce(' ' || CAST(target_rows AS VARCHAR), '') END AS reason,
    source_rows, target_rows FROM ({RECONCILED})""",
)
def run_summary(spark, sf):
    failures = spark.createDataFrame([("events", "disk full")], "table_name string, reason string")
    return q.run_summary(_reconciled(spark, sf), failures)


@query(
    "publish_contract",
    """SELECT *, title_ok AND columns_ok AND rows_ok AND width_ok AND spatial_ok AND head_ok AS passed FROM (
    SELECT name, trim(coalesce(title, name)) <> '' AS title_ok, width > 0 AS columns_ok, n > 0 AS rows_ok, width > 0 AS width_ok,
    NOT spatial OR keys = 3 AS spatial_ok, n > 0 AS head_ok
    FROM (SELECT count(*) AS width FROM (DESCRIBE SELECT * FROM customer)), (
      SELECT 'customer' AS name, 'Customers' AS title, count(*) AS n, false AS spatial, 0 AS keys FROM customer
      UNION ALL SELECT 'nothing', NULL, count(*), false, 0 FROM customer WHERE c_custkey < 0
      UNION ALL SELECT 'half_spatial', NULL, count(*), true, 0 FROM customer))""",
)
def publish_contract(spark, sf):
    """One good dataset, one without rows, one that calls itself spatial but lacks the keys."""
    shelf, df = new_shelf(spark), table(spark, sf, "customer")
    shelf.publish(df, "customer", title="Customers")
    shelf.publish(df.filter("c_custkey < 0"), "nothing")
    shelf.publish(df, "half_spatial", user={"spatial": "TRUE"})
    return q.publish_contract(shelf)


@query(
    "lake_checks",
    f"""WITH c AS (SELECT (SELECT count(*) FROM ({I.V1})) AS n1, (SELECT count(*) FROM ({I.V2})) AS n2,
      (SELECT count(*) FROM ({FEED}) WHERE snapshot_id = 2) AS moved, (SELECT count(*) FROM (DESCRIBE SELECT * FROM customer)) AS width)
    SELECT 'table count' AS "check", true AS passed, '3 of 3' AS detail
    UNION ALL SELECT 'table comments', true, '1 of at least 1'
    UNION ALL SELECT 'column comments', true, '2 of at least 2'
    UNION ALL SELECT 'views', true, '3 of at least 3'
    UNION ALL SELECT 'versions', true, '2 newest versions found'
    UNION ALL SELECT 'time travel', n1 > 0 AND n2 > 0, n1 || ' and ' || n2 || ' rows' FROM c
    UNION ALL SELECT 'change feed', n1 + moved >= 1, (n1 + moved) || ' changes' FROM c
    UNION ALL SELECT 'retention', true, '0 versions are older than 90 days'
    UNION ALL SELECT 'read-only access', n2 > 0, width || ' columns described' FROM c""",
)
def lake_checks(spark, sf):
    shelf = three_versions(spark, sf, 2)
    for name, df in sources(spark, sf).items():
        shelf.publish(df, name, now=T0)
    return q.shelf_checks(
        shelf, registry(), "customer", ["c_custkey"], tables=3, comments=1, column_comments=2, min_views=3,
        now=T0 + timedelta(days=60),
    )


@query(
    "refresh_pipeline",
    f"""SELECT table_name, 'table' AS type, true AS passed, CAST(NULL AS VARCHAR) AS reason, row_count AS source_rows, row_count AS target_rows,
    row_count AS catalogue_rows FROM ({COUNTS} UNION ALL SELECT 'areas', count(*) FROM customer
    UNION ALL SELECT 'lookup', count(*) FROM ({I.LOOKUP}) UNION ALL SELECT 'emissions', count(*) FROM ({I.EMISSIONS}))
    UNION ALL SELECT name, 'view', NULL, NULL, NULL, NULL, row_count FROM ({VIEW_ROWS})""",
)
def refresh_pipeline(spark, sf):
    """All test tables, the areas and two derived tables, with the views over them; what the catalogue then lists."""
    shelf: Shelf = new_shelf(spark)
    tables = {n: Table(lambda n=n: table(spark, sf, n), n.title()) for n in I.TABLES}
    tables["customer"].comments = {"c_custkey": "Customer number"}
    tables["areas"] = Table(
        lambda: I.areas(spark, sf), "Areas", spatial=Spatial("shape", "GEOMETRY", "EPSG:27700", "decode+flag", ("area_id",))
    )
    tables |= {n: Table(lambda n=n: sources(spark, sf)[n]) for n in ("lookup", "emissions")}
    summary = refresh(Config(shelf, tables, registry(), source_db="test", now=datetime(2025, 1, 1, tzinfo=timezone.utc)))
    listed_rows = shelf.read("datasets_catalogue").select(F.col("name").alias("table_name"), "type", F.col("row_count").alias("catalogue_rows"))
    return summary.join(listed_rows, "table_name", "full").select(
        "table_name", "type", "passed", "reason", "source_rows", "target_rows", "catalogue_rows"
    )
