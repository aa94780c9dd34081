"""Publishing, versions, change feeds, merges, schema evolution, files and upkeep."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from datashelf.operators import changes as ch
from datashelf.operators import evolve as ev
from datashelf.plans import maintain as mt
from datashelf.plans.quality import same_rows
from datashelf.session import fresh_folder
from datashelf.sources import files as fs
from datashelf.sources.shelf import Shelf, check_not_null, export_chunks
from shelf_queries import inputs as I
from shelf_queries.inputs import table
from shelf_queries.registry import query

T0 = datetime(2025, 1, 1, tzinfo=timezone.utc)
TITLE = "Customers"
COMMENTS = {"c_custkey": "Customer number", "c_name": "Name"}


def new_shelf(spark, **kw) -> Shelf:
    return Shelf(spark, fresh_folder(spark, "shelf"), **kw)


def three_versions(spark, sf, last: int = 3) -> Shelf:
    """``customer`` in up to three versions, one day apart. The third has a further column ``tier``."""
    shelf = new_shelf(spark)
    steps = [
        lambda: I.v1(spark, sf),
        lambda: I.v2(spark, sf),
        lambda: ev.add_column(I.v3_values(I.v2(spark, sf)), "tier", "string", "std"),
    ]
    for i, make in enumerate(steps[:last]):
        shelf.publish(
            make(), "customer", title=TITLE, comments=COMMENTS, author="tester", message=f"step {i + 1}",
            extra_info='{"run": %d}' % (i + 1), now=T0 + timedelta(days=i),
        )
    return shelf


# ---- reading published versions ----


@query("published_latest", I.V3)
def published_latest(spark, sf):
    return three_versions(spark, sf).read("customer")


@query("published_version", I.V1)
def published_version(spark, sf):
    return three_versions(spark, sf).read("customer", version=1)


@query("published_as_of_ts", I.V2)
def published_as_of_ts(spark, sf):
    return three_versions(spark, sf).read("customer", ts=T0 + timedelta(days=1, hours=5))


@query("as_of_session", I.V2)
def as_of_session(spark, sf):
    return three_versions(spark, sf).at(version=2).read("customer")


@query("current_version", f"SELECT 3 AS current_version, 3 AS last_committed, (SELECT count(*) FROM ({I.V3})) AS row_count")
def current_version(spark, sf):
    shelf = three_versions(spark, sf)
    return shelf.read("customer").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(shelf.current_version("customer")).alias("current_version"), F.lit(shelf.last_committed["customer"]).alias("last_committed"), "row_count"
    )


@query(
    "list_versions",
    f"""SELECT * FROM (SELECT 1::BIGINT AS version, 'created' AS changes, 'step 1' AS message, 1 AS run, (SELECT count(*) FROM ({I.V1})) AS row_count
    UNION ALL SELECT 2, 'inserted', 'step 2', 2, (SELECT count(*) FROM ({I.V2}))
    UNION ALL SELECT 3, 'inserted', 'step 3', 3, (SELECT count(*) FROM ({I.V3})))""",
)
def list_versions(spark, sf):
    run = F.from_json("extra_info", "run int")["run"].alias("run")
    return three_versions(spark, sf).versions("customer").select("version", "changes", "message", run, "row_count")


@query(
    "list_datasets",
    """SELECT 'customer' AS name, (SELECT count(*) FROM customer) AS row_count UNION ALL SELECT 'orders', (SELECT count(*) FROM orders)""",
)
def list_datasets(spark, sf):
    shelf = new_shelf(spark)
    for name in ("customer", "orders", "part"):
        shelf.publish(table(spark, sf, name), name)
    shelf.drop("part")
    return shelf.list_datasets().join(shelf.latest().select("name", "row_count"), "name")


@query(
    "dataset_meta",
    f"""SELECT column_name, data_type, comment, (SELECT count(*) FROM ({I.V1})) AS row_count FROM (VALUES ('c_custkey', 'bigint', 'Customer number'),
    ('c_name', 'string', 'Name'), ('c_nationkey', 'int', ''), ('c_acctbal', 'double', ''), ('c_mktsegment', 'string', ''))
    t(column_name, data_type, comment)""",
)
def dataset_meta(spark, sf):
    shelf = three_versions(spark, sf, 1)
    docs = shelf.column_docs("customer").drop("name")
    return docs.withColumn("row_count", F.lit(shelf.meta("customer").first()["row_count"]).cast("long"))


@query("rollback", I.V1)
def rollback(spark, sf):
    shelf = three_versions(spark, sf)
    shelf.rollback("customer", 1)
    return shelf.read("customer")


@query("publish_roundtrip", "SELECT *, true AS same FROM orders")
def publish_roundtrip(spark, sf):
    shelf, df = new_shelf(spark), table(spark, sf, "orders")
    shelf.publish(df, "orders", title="Orders")
    back = shelf.read("orders")
    return back.withColumn("same", F.lit(same_rows(df, back)))


@query("drop_idempotent", "SELECT true AS first_drop, false AS second_drop, 0::BIGINT AS listed, (SELECT count(*) FROM customer) AS still_readable")
def drop_idempotent(spark, sf):
    shelf = new_shelf(spark)
    shelf.publish(table(spark, sf, "customer"), "customer")
    first, second = shelf.drop("customer"), shelf.drop("customer")
    listed = shelf.list_datasets().count()
    return shelf.read("customer", version=1).agg(F.count(F.lit(1)).alias("still_readable")).select(
        F.lit(first).alias("first_drop"), F.lit(second).alias("second_drop"), F.lit(listed).cast("long").alias("listed"), "still_readable"
    )


@query("ctas", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def ctas(spark, sf):
    """Create, then replace, a table from a query; the second definition counts."""
    shelf, orders = new_shelf(spark), table(spark, sf, "orders")
    shelf.publish(orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), "open_orders")
    shelf.publish(orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice"), "open_orders")
    return shelf.read("open_orders")


@query("append_rows", f"{I.V1} UNION ALL SELECT * FROM customer WHERE c_custkey % 11 = 0")
def append_rows(spark, sf):
    shelf = new_shelf(spark)
    shelf.publish(I.v1(spark, sf), "customer")
    shelf.append(table(spark, sf, "customer").filter("c_custkey % 11 = 0"), "customer")
    return shelf.read("customer")


# ---- merge, delete, update ----

SOURCE = """SELECT c_custkey, c_name || ' new' AS c_name, c_nationkey, c_acctbal * 2 AS c_acctbal, c_mktsegment FROM customer
  WHERE c_custkey % 11 = 0 OR c_custkey % 5 = 0"""


def _source(spark, sf):
    changed = table(spark, sf, "customer").filter("c_custkey % 11 = 0 OR c_custkey % 5 = 0")
    return changed.withColumns({"c_name": F.concat("c_name", F.lit(" new")), "c_acctbal": F.col("c_acctbal") * 2})


@query("merge_upsert", f"SELECT * FROM ({I.V1}) WHERE c_custkey NOT IN (SELECT c_custkey FROM ({SOURCE})) UNION ALL {SOURCE}")
def merge_upsert(spark, sf):
    return ch.merge(I.v1(spark, sf), _source(spark, sf), ["c_custkey"])


@query(
    "merge_set",
    f"""SELECT t.c_custkey, t.c_name, t.c_nationkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, t.c_mktsegment
    FROM ({I.V1}) t LEFT JOIN ({SOURCE}) s ON t.c_custkey = s.c_custkey""",
)
def merge_set(spark, sf):
    updates = _source(spark, sf).select("c_custkey", "c_acctbal")
    return ch.merge(I.v1(spark, sf), updates, ["c_custkey"], matched={"c_acctbal": "s.c_acctbal"}, not_matched=None)


@query("merge_delete", f"SELECT * FROM ({I.V1}) WHERE c_custkey % 5 <> 0")
def merge_delete(spark, sf):
    return ch.merge(I.v1(spark, sf), _source(spark, sf).select("c_custkey"), ["c_custkey"], matched="delete", not_matched=None)


@query("merge_delete_if", f"SELECT * FROM ({I.V1}) WHERE NOT (c_custkey % 5 = 0 AND c_acctbal >= 1000)")
def merge_delete_if(spark, sf):
    keys = _source(spark, sf).select("c_custkey")
    return ch.merge(I.v1(spark, sf), keys, ["c_custkey"], matched="delete", matched_if="t.c_acctbal >= 1000", not_matched=None)


@query("delete_where", f"SELECT * FROM ({I.CERTIFICATES}) WHERE tenure IS NULL OR tenure <> 'unknown'")
def delete_where(spark, sf):
    return ch.delete_where(I.certificates(spark, sf), F.col("tenure") == "unknown")


@query(
    "update_where",
    "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer",
)
def update_where(spark, sf):
    return ch.update_where(table(spark, sf, "customer"), {"c_acctbal": F.col("c_acctbal") + 1}, F.col("c_mktsegment") == "BUILDING")


def _filed(spark, sf, **kw):
    """Version 1 of ``customer`` on a shelf, in four files of neighbouring numbers."""
    shelf = new_shelf(spark)
    shelf.publish(I.v1(spark, sf).repartitionByRange(4, "c_custkey"), "customer", **kw)
    return shelf


def _files_of(shelf, version):
    return {r["data_file"] for r in shelf.files("customer", version).collect()}


LAST = "(SELECT max(c_custkey) FROM customer)"
FEW = f"SELECT c_custkey, c_name || ' new' AS c_name, c_nationkey, c_acctbal * 2 AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey * 20 > {LAST} * 19"


@query(
    "shelf_merge",
    f"SELECT *, true AS others_stay FROM (SELECT * FROM ({I.V1}) WHERE c_custkey NOT IN (SELECT c_custkey FROM ({FEW})) UNION ALL {FEW})",
)
def shelf_merge(spark, sf):
    """A merge into a published dataset rewrites the files that hold its keys, and refers to the others as they are."""
    shelf, customer = _filed(spark, sf), table(spark, sf, "customer")
    last = customer.agg(F.max("c_custkey")).first()[0]
    few = customer.filter(F.col("c_custkey") * 20 > last * 19)
    shelf.merge("customer", few.withColumns({"c_name": F.concat("c_name", F.lit(" new")), "c_acctbal": F.col("c_acctbal") * 2}), ["c_custkey"])
    stay = len(_files_of(shelf, 1) & _files_of(shelf, 2)) == 3
    return shelf.read("customer").withColumn("others_stay", F.lit(stay))


@query(
    "shelf_update_delete",
    f"""SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey * 20 > {LAST} * 19 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
    c_mktsegment, 3::BIGINT AS n_shared, 3::BIGINT AS n_kept FROM ({I.V1}) WHERE c_custkey * 20 >= {LAST}""",
)
def shelf_update_delete(spark, sf):
    """An update touches the last file, then a delete the first: the others are referred to each time."""
    shelf = _filed(spark, sf)
    last = table(spark, sf, "customer").agg(F.max("c_custkey")).first()[0]
    shelf.update_where("customer", {"c_acctbal": F.col("c_acctbal") + 1}, F.col("c_custkey") * 20 > last * 19)
    shelf.delete_where("customer", F.col("c_custkey") * 20 < last)
    one, two, three = (_files_of(shelf, v) for v in (1, 2, 3))
    return shelf.read("customer").withColumns(
        {"n_shared": F.lit(len(one & two)).cast("long"), "n_kept": F.lit(len(two & three)).cast("long")}
    )


@query(
    "lasting_row_ids",
    f"""SELECT c_custkey, c_custkey % 5 = 0 AS changed, true AS same_id, (SELECT count(*) FROM ({I.V1})) AS distinct_ids FROM ({I.V1})""",
)
def lasting_row_ids(spark, sf):
    """Every row keeps its id through an update and a compaction."""
    shelf = _filed(spark, sf, row_ids=True)
    first = shelf.read("customer", row_ids=True).select("c_custkey", F.col("_row_id").alias("first_id"))
    shelf.update_where("customer", {"c_acctbal": F.col("c_acctbal") + 1}, F.col("c_custkey") % 5 == 0)
    mt.compact(shelf, "customer")
    last = shelf.read("customer", row_ids=True)
    ids = last.agg(F.count_distinct("_row_id").alias("distinct_ids"))
    same = last.join(first, "c_custkey").select(
        "c_custkey", (F.col("c_custkey") % 5 == 0).alias("changed"), (F.col("_row_id") == F.col("first_id")).alias("same_id")
    )
    return same.withColumn("distinct_ids", F.lit(ids.first()[0]))


@query(
    "row_id_changes",
    f"""SELECT 2::BIGINT AS snapshot_id, k AS change_type, c_custkey, CASE k WHEN 'update_postimage' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
    FROM ({I.V1}), (VALUES ('update_preimage'), ('update_postimage')) t(k) WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT 3, 'insert', c_custkey, c_acctbal FROM customer WHERE c_custkey % 11 = 0""",
)
def row_id_changes(spark, sf):
    """With row ids, a change feed tells updates without a key."""
    shelf = _filed(spark, sf, row_ids=True)
    shelf.update_where("customer", {"c_acctbal": F.col("c_acctbal") + 1}, F.col("c_mktsegment") == "BUILDING")
    shelf.append(table(spark, sf, "customer").filter("c_custkey % 11 = 0"), "customer")
    return shelf.table_changes("customer", 2, 3).select("snapshot_id", "change_type", "c_custkey", "c_acctbal")


@query(
    "published_bounds",
    """SELECT 'o_orderkey' AS column_name, 0::BIGINT AS n_nulls, min(o_orderkey)::VARCHAR AS low, max(o_orderkey)::VARCHAR AS high, count(*) AS row_count FROM orders
    UNION ALL SELECT 'half_key', count(*) FILTER (o_orderkey % 2 = 1), (min(o_orderkey) FILTER (o_orderkey % 2 = 0))::VARCHAR,
    (max(o_orderkey) FILTER (o_orderkey % 2 = 0))::VARCHAR, count(*) FROM orders
    UNION ALL SELECT 'o_orderstatus', 0, NULL, NULL, count(*) FROM orders""",
)
def published_bounds(spark, sf):
    """Null counts and bounds of a dataset in two parts, gathered while its rows were written."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("half_key"), "o_orderstatus")
    shelf = new_shelf(spark)
    shelf.publish(orders.filter("o_orderstatus = 'F'"), "orders")
    shelf.append(orders.filter("o_orderstatus <> 'F'"), "orders")
    return shelf.column_bounds("orders").withColumn("row_count", F.lit(shelf._entry("orders")["row_count"]))


# ---- change feed ----

STATE = {
    1: f"SELECT *, 'std' AS tier FROM ({I.V1})",
    2: f"SELECT *, 'std' AS tier FROM ({I.V2})",
    3: I.V3,
}


def _pair_sql(version: int) -> str:
    old, new = STATE[version - 1], STATE[version]
    moved = "(o.c_acctbal IS DISTINCT FROM n.c_acctbal OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment)"
    both = f"FROM ({old}) o JOIN ({new}) n ON o.c_custkey = n.c_custkey WHERE {moved}"
    return f"""SELECT {version}::BIGINT AS snapshot_id, 'delete' AS change_type, o.* FROM ({old}) o
      WHERE o.c_custkey NOT IN (SELECT c_custkey FROM ({new}))
    UNION ALL SELECT {version}::BIGINT, 'insert', n.* FROM ({new}) n WHERE n.c_custkey NOT IN (SELECT c_custkey FROM ({old}))
    UNION ALL SELECT {version}::BIGINT, 'update_preimage', o.* {both} UNION ALL SELECT {version}::BIGINT, 'update_postimage', n.* {both}"""


FEED = f"{_pair_sql(2)} UNION ALL {_pair_sql(3)}"


@query("table_changes", FEED)
def table_changes(spark, sf):
    return three_versions(spark, sf).table_changes("customer", 2, 3, ["c_custkey"])


@query(
    "change_summary",
    f"""SELECT snapshot_id, count(*) FILTER (WHERE change_type = 'insert') AS inserted, count(*) FILTER (WHERE change_type = 'delete') AS deleted,
    count(*) FILTER (WHERE change_type = 'update_postimage') AS updated,
    CASE snapshot_id WHEN 2 THEN 'inserted,deleted,updated' ELSE 'updated' END AS changes FROM ({FEED}) GROUP BY snapshot_id""",
)
def change_summary(spark, sf):
    feed = three_versions(spark, sf).table_changes("customer", 2, 3, ["c_custkey"], copies="n")
    return ch.change_summary(feed, "n")


# ---- schema evolution ----


@query(
    "evolve_add",
    "SELECT *, 'std' AS tier, {'seg': c_mktsegment, 'score': 5}.score AS score FROM customer",
)
def evolve_add(spark, sf):
    df = table(spark, sf, "customer").withColumn("s", F.struct(F.col("c_mktsegment").alias("seg")))
    df = ev.add_column(ev.add_column(df, "tier", "string", "std"), "s.score", "int", 5)
    return df.select("*", "s.score").drop("s")


@query("evolve_drop", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, 1 AS n_fields FROM customer")
def evolve_drop(spark, sf):
    nested = F.struct(F.col("c_name").alias("a"), F.col("c_acctbal").alias("b"))
    df = ev.drop_column(ev.drop_column(table(spark, sf, "customer").withColumn("s", nested), "c_mktsegment"), "s.b")
    return df.withColumn("n_fields", F.size(F.map_keys(F.from_json(F.to_json("s"), "map<string,string>")))).drop("s")


@query("evolve_rename", "SELECT c_custkey AS id, c_name, c_nationkey, c_acctbal, c_mktsegment, c_name AS inner_name FROM customer")
def evolve_rename(spark, sf):
    df = table(spark, sf, "customer").withColumn("s", F.struct(F.col("c_name").alias("a")))
    df = ev.rename_column(ev.rename_column(df, "c_custkey", "id"), "s.a", "inner_name")
    return df.select("*", "s.inner_name").drop("s")


@query("evolve_promote", "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def evolve_promote(spark, sf):
    return ev.promote(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "bigint")


@query("align_schema", "SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_custkey AS id, 'std' AS tier, CAST(NULL AS DOUBLE) AS score FROM customer")
def align_schema(spark, sf):
    target = T.StructType(
        [
            T.StructField("c_nationkey", T.LongType()), T.StructField("id", T.LongType()),
            T.StructField("tier", T.StringType(), True, {ev.DEFAULT_KEY: '"std"'}), T.StructField("score", T.DoubleType()),
        ]
    )
    return ev.align(table(spark, sf, "customer"), target, renames={"c_custkey": "id"})


@query(
    "conform_files",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN l_returnflag ELSE 'd' END AS l_returnflag
    FROM lineitem""",
)
def conform_files(spark, sf):
    """Two groups of files: one lacks a column, the other has one too many; both hold a narrower type."""
    folder, rows = fresh_folder(spark, "files"), table(spark, sf, "lineitem")
    rows.filter("l_orderkey % 2 = 0").select("l_orderkey", "l_linenumber", "l_returnflag", "l_tax").write.parquet(f"{folder}/a")
    rows.filter("l_orderkey % 2 <> 0").select("l_orderkey", "l_linenumber").write.parquet(f"{folder}/b")
    declared = T.StructType().add("l_orderkey", "long").add("l_linenumber", "long").add("l_returnflag", "string")
    return ev.read_conformed(spark, [f"{folder}/a", f"{folder}/b"], declared, True, True, {"l_returnflag": "d"})


@query("migrate_cast", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part")
def migrate_cast(spark, sf):
    shelf = new_shelf(spark)
    ev.migrate(shelf, {"part": table(spark, sf, "part").select("p_partkey", "p_name", "p_size")}, {"bigint": "string", "int": "bigint"})
    return shelf.read("part")


@query(
    "check_not_null",
    f"SELECT count(*) FILTER (WHERE tenure IS NULL) AS n_null, true AS refused FROM ({I.CERTIFICATES})",
)
def not_null(spark, sf):
    """A required column with NULLs stops the publish; nothing becomes visible."""
    shelf, df = new_shelf(spark), I.certificates(spark, sf)
    check_not_null(df, ["cert_id"])
    try:
        shelf.publish(ev.set_not_null(df, "tenure"), "certificates", not_null=["cert_id"])
        refused = False
    except ValueError:
        refused = shelf.list_datasets().count() == 0
    return df.agg(F.count_if(F.col("tenure").isNull()).alias("n_null")).withColumn("refused", F.lit(refused))


# ---- files ----


def _lineitem_files(spark, sf) -> str:
    folder = fresh_folder(spark, "files")
    rows = table(spark, sf, "lineitem")
    for i in range(2):
        rows.filter(F.col("l_orderkey") % 2 == i).write.parquet(f"{folder}/part{i}/deep")
    return folder


@query("scan_glob", "SELECT * FROM lineitem")
def scan_glob(spark, sf):
    return fs.read_glob(spark, _lineitem_files(spark, sf))


@query("scan_multifile", "SELECT l_orderkey, l_linenumber, true AS many_files FROM lineitem")
def scan_multifile(spark, sf):
    folder = _lineitem_files(spark, sf)
    df = fs.read_files(spark, [f"{folder}/part0/deep", f"{folder}/part1/deep"])
    return df.select("l_orderkey", "l_linenumber", F.lit(fs.file_paths(df).limit(2).count() > 1).alias("many_files"))


@query(
    "chunked_export",
    "SELECT count(*) AS n, true AS within_limit, 4::BIGINT AS chunks FROM orders",
)
def chunked_export(spark, sf):
    """A table as one input partition, in files of at most a quarter of its rows."""
    folder, orders = fresh_folder(spark, "files"), table(spark, sf, "orders").repartition(1)
    quarter = -(-orders.count() // 4)
    chunks = export_chunks(orders, folder, rows_per_file=quarter)
    per_file = spark.read.parquet(folder).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("n"), (F.max("n") <= quarter).alias("within_limit")).withColumn("chunks", F.lit(chunks).cast("long"))


@query(
    "csv_roundtrip",
    """SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS bbox FROM customer""",
)
def csv_roundtrip(spark, sf):
    """Missing values travel as NA and come back as NULL; numbers stay numbers."""
    folder, k = fresh_folder(spark, "csv"), F.col("c_custkey")
    df = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.when(k % 3 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(k % 4 != 0, F.col("c_acctbal")).alias("bbox"),
    )
    fs.write_csv(df, folder)
    return fs.read_csv(spark, folder).withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query(
    "partition_write",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, event_type FROM events WHERE month(ts) = 1""",
)
def partition_write(spark, sf):
    shelf = new_shelf(spark)
    shelf.publish(
        table(spark, sf, "events").select("event_id", "ts", "event_type"), "events", partition_by=["event_type"],
        date_parts=("ts", ["year", "month"]), compression="zstd",
    )
    return shelf.read("events").filter("month = 1").select("event_id", "year", "month", "event_type")


@query(
    "add_files",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal, true AS refers_to_them
    FROM customer WHERE c_custkey % 10 <> 4""",
)
def add_files(spark, sf):
    """Files written elsewhere, with a column less and one more, become part of a dataset without a copy."""
    shelf, customer = new_shelf(spark), table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    shelf.publish(customer.filter("c_custkey % 2 = 0"), "customer")
    outside = fresh_folder(spark, "outside")
    odd = customer.filter("c_custkey % 2 <> 0").withColumn("loaded", F.lit("today")).drop("c_acctbal")
    odd.write.parquet(outside)
    shelf.add_files("customer", [outside], allow_missing=True, ignore_extra=True)
    shelf.delete_where("customer", F.col("c_custkey") % 10 == 4)
    held = shelf.files("customer").filter(F.col("data_file").contains("/outside")).count()
    return shelf.read("customer").withColumn("refers_to_them", F.lit(held > 0))


@query("list_files", "SELECT true AS has_files, true AS all_parquet, true AS all_sized, (SELECT count(*) FROM lineitem) AS rows_held")
def list_files(spark, sf):
    folder = _lineitem_files(spark, sf)
    listed = fs.list_files(spark, folder, "*.parquet").agg(
        (F.count(F.lit(1)) > 1).alias("has_files"), F.bool_and(F.col("path").endswith(".parquet")).alias("all_parquet"),
        F.bool_and(F.col("length") > 0).alias("all_sized"),
    )
    return listed.withColumn("rows_held", F.lit(fs.read_glob(spark, folder).count()).cast("long"))


@query("dataset_files", "SELECT true AS has_files, true AS in_version_folder, (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0) AS rows_held")
def dataset_files(spark, sf):
    shelf = three_versions(spark, sf, 2)
    files = shelf.files("customer", version=1)
    return files.agg(
        (F.count(F.lit(1)) >= 1).alias("has_files"), F.bool_and(F.col("data_file").contains("/customer/v00000001-")).alias("in_version_folder")
    ).withColumn("rows_held", F.lit(shelf.read("customer", version=1).count()).cast("long"))


@query("footer_meta", "SELECT 'org.apache.spark.version' AS key, true AS same_in_all_files, (SELECT count(*) FROM lineitem) AS rows_held")
def footer_meta(spark, sf):
    folder = _lineitem_files(spark, sf)
    files = fs.list_files(spark, folder, "*.parquet")
    found = fs.footer_meta(files, "org.apache.spark.version").groupBy("key").agg(
        (F.count_distinct("value") == 1).alias("one_value"), F.count(F.lit(1)).alias("n")
    )
    return found.select(
        "key", (F.col("one_value") & (F.col("n") == files.count())).alias("same_in_all_files"),
        F.lit(fs.read_glob(spark, folder).count()).cast("long").alias("rows_held"),
    )


# ---- upkeep ----


@query("compact", "SELECT *, true AS fewer_files FROM orders")
def compact(spark, sf):
    shelf = new_shelf(spark)
    shelf.publish(table(spark, sf, "orders").repartition(6, "o_orderkey"), "orders")
    before = shelf.files("orders").count()
    mt.compact(shelf, "orders")
    return shelf.read("orders").withColumn("fewer_files", F.lit(shelf.files("orders").count() < before))


@query(
    "expire_versions",
    f"""SELECT 'customer' AS name, version::BIGINT AS version, (SELECT count(*) FROM ({I.V3})) AS rows_left FROM (VALUES (1), (2)) t(version)""",
)
def expire_versions(spark, sf):
    """Dry run, then the real thing: two old versions go, the newest stays whatever its age."""
    shelf = three_versions(spark, sf)
    limit = T0 + timedelta(days=90)
    planned = mt.expire(shelf, limit)
    if mt.expire(shelf, limit, dry_run=False) != planned:
        raise RuntimeError("dry run and run differ")
    gone = spark.createDataFrame(planned, "name string, version long")
    left = shelf.versions("customer").agg(F.sum("row_count")).first()[0]
    return gone.withColumn("rows_left", F.lit(left).cast("long"))


@query(
    "orphan_files",
    f"SELECT true AS only_stray_files, true AS none_left, (SELECT count(*) FROM ({I.V1})) AS rows_left",
)
def orphan_files(spark, sf):
    """What failed publishes left behind, hidden or not, is found and removed; published files are not touched."""
    shelf = three_versions(spark, sf, 1)
    table(spark, sf, "customer").write.parquet(f"{shelf.root}/customer/v00000002-unfinished")
    table(spark, sf, "customer").write.parquet(f"{shelf.root}/customer/_temporary/unfinished")
    soon = datetime.now(timezone.utc) + timedelta(hours=1)
    stray = mt.orphan_files(shelf).filter(~F.col("path").contains("unfinished")).count() == 0
    removed = mt.remove_orphans(shelf, soon, dry_run=False)
    left = mt.orphan_files(shelf).count()
    return shelf.read("customer").agg(F.count(F.lit(1)).alias("rows_left")).select(
        F.lit(stray and removed == 2).alias("only_stray_files"), F.lit(left == 0).alias("none_left"), "rows_left"
    )


@query(
    "maintain",
    f"""SELECT step, subject, n::BIGINT AS n, (SELECT count(*) FROM ({I.V3})) AS rows_left
    FROM (VALUES ('expire', 'versions', 2), ('compact', 'datasets', 1), ('clean up', 'folders', 0)) t(step, subject, n)""",
)
def maintain(spark, sf):
    shelf = three_versions(spark, sf, 2)
    last = ev.add_column(I.v3_values(I.v2(spark, sf)), "tier", "string", "std")
    # Small files on purpose, so that there is something to merge at every size of the data.
    shelf.publish(last.repartition(3, "c_custkey"), "customer", now=T0 + timedelta(days=2))
    report = mt.maintain(shelf, older_than=T0 + timedelta(days=90))
    rows = shelf.read("customer").count()
    return report.select("step", "subject", F.col("count").alias("n"), F.lit(rows).cast("long").alias("rows_left"))
