"""Versions made of folders and files: what is written anew, what is read, which ids rows have."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from datashelf.operators import changes as ch
from datashelf.operators.evolve import SchemaMismatch, set_not_null
from datashelf.operators.rows import TOP_ROWS, Pages
from datashelf.plans import maintain as mt
from datashelf.plans.refresh import Spatial, WrongGeometryType, publish_spatial
from datashelf.session import fresh_folder, remove_work, work_folder


def files(shelf, name, version=None):
    return {r["data_file"] for r in shelf.files(name, version).collect()}


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def parts(spark, shelf):
    """A hundred rows in five files of neighbouring ids, with ids of their own."""
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("kind"), F.lit("old").alias("state"))
    shelf.publish(df.repartitionByRange(5, "id"), "parts", row_ids=True)
    return shelf


def test_merge_rewrites_touched_files_only(spark, parts):
    source = spark.createDataFrame([(3, 1, "new"), (5, 1, "new"), (200, 2, "new"), (None, 3, "new")], "id long, kind long, state string")
    want = counted(ch.merge(parts.read("parts"), source, ["id"]))
    parts.merge("parts", source, ["id"])
    assert counted(parts.read("parts")) == want
    assert len(files(parts, "parts", 1) & files(parts, "parts", 2)) == 4
    assert parts._entry("parts")["row_count"] == 102 == parts.read("parts").count()
    assert parts.read("parts", 1).count() == 100


def test_delete_and_update_in_steps(parts):
    parts.update_where("parts", {"state": F.lit("new")}, F.col("id").between(40, 45))
    parts.delete_where("parts", F.col("id") < 20)
    parts.delete_where("parts", F.col("id") > 1000)
    got = parts.read("parts").collect()
    assert sorted(r["id"] for r in got) == list(range(20, 100))
    assert {r["id"] for r in got if r["state"] == "new"} == set(range(40, 46))
    parts.delete_where("parts", F.lit(True))
    assert parts.read("parts").count() == 0 and parts._entry("parts")["row_count"] == 0
    parts.rollback("parts", 1)
    assert parts.read("parts").count() == 100


def test_a_feed_reads_what_differs(spark, parts):
    more = spark.range(100, 110).selectExpr("id", "id % 7 AS kind", "'old' AS state")
    parts.append(more, "parts")
    entry = parts._entry("parts")
    feed = parts.table_changes("parts", 2, 2, ["id"])
    read = {f.replace("file:///", "file:/") for f in feed.inputFiles()}
    assert read and read <= {f for f in files(parts, "parts") if f.startswith(entry["path"])}
    assert counted(feed.groupBy("change_type").count()) == {("insert", 10): 1}
    parts.update_where("parts", {"state": F.lit("new")}, F.col("id") == 50)
    parts.delete_where("parts", F.col("id") == 105)
    feed = parts.table_changes("parts", 3, 4)  # ids are the key
    assert counted(feed.select("snapshot_id", "change_type", "id")) == {
        (3, "update_preimage", 50): 1, (3, "update_postimage", 50): 1, (4, "delete", 105): 1,
    }
    states = [(v, parts.read("parts", v)) for v in range(1, 5)]
    want = counted(ch.table_changes(states, ["id"]))
    assert counted(parts.table_changes("parts", 2, 4, ["id"])) == want
    assert counted(parts.table_changes("parts", 1, 4, ["id"])) == counted(ch.table_changes([(None, None), *states], ["id"]))
    parts.rollback("parts", 4)
    assert parts.table_changes("parts", 5, 5).count() == 0


def test_ids_last_and_are_never_given_twice(spark, parts):
    def ids(version=None):
        return {r["id"]: r["_row_id"] for r in parts.read("parts", version, row_ids=True).collect()}

    first = ids()
    assert len(set(first.values())) == 100
    parts.append(spark.range(100, 120).selectExpr("id", "id % 7 AS kind", "'old' AS state"), "parts")
    second = ids()
    parts.rollback("parts", 1)
    parts.append(spark.range(300, 320).selectExpr("id", "id % 7 AS kind", "'old' AS state"), "parts")
    parts.update_where("parts", {"kind": F.lit(9)}, F.col("id") % 10 == 0)
    parts.merge("parts", spark.createDataFrame([(1, 4, "new"), (500, 4, "new")], "id long, kind long, state string"), ["id"])
    before = ids()
    assert mt.compact(parts, "parts") and ids() == before
    assert {k: v for k, v in before.items() if k < 100} == first
    assert not {v for k, v in before.items() if k >= 100} & set(second.values())
    assert len(set(before.values())) == 121
    assert "_row_id" not in parts.read("parts").columns
    parts.publish(spark.range(3), "plain")
    with pytest.raises(ValueError, match="no row ids"):
        parts.read("plain", row_ids=True)


def test_compaction_and_expiry_after_changes(parts):
    parts.delete_where("parts", F.col("id").isin(1, 2, 3))
    want = counted(parts.read("parts"))
    assert mt.compact(parts, "parts")
    assert not parts._entry("parts")["without"] and counted(parts.read("parts")) == want
    mt.expire(parts, versions=[1, 2], name="parts", dry_run=False)
    assert counted(parts.read("parts")) == want


def test_partitions_are_one_scan_however_many_appends(spark, shelf):
    rows = [(i, ["a b", "c%d", "x/y", None][i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, kind string")
    shelf.publish(df.filter("id < 10"), "events", partition_by=["kind"])
    for i in range(10, 40, 10):
        shelf.append(df.filter(F.col("id").between(i, i + 9)), "events")
    got = shelf.read("events")
    assert counted(got) == counted(df)
    plan = got.filter("kind = 'a b'")._jdf.queryExecution().toString()
    assert plan.count("FileScan parquet") == 1 and "PartitionFilters: [isnotnull(kind" in plan and "Union" not in plan
    shelf.update_where("events", {"id": F.col("id") + 1000}, F.col("kind") == "c%d")
    shelf.delete_where("events", F.col("kind").isNull())
    want = Counter((i + 1000 if k == "c%d" else i, k) for i, k in rows if k)
    assert counted(shelf.read("events")) == want and shelf._entry("events")["row_count"] == 30
    held = shelf.files("events").select("data_file").collect()
    assert len(held) == 8 + 1 and not any("__HIVE_DEFAULT" in r[0] for r in held)  # two kinds in four folders, one in a new one
    assert shelf.table_changes("events", 1, 6).count() == 40 + 20 + 10
    shelf.rename("events", "renamed")
    shelf.append(df.limit(1), "renamed")
    assert shelf.read("renamed").count() == 31


def test_bounds_are_gathered_and_merged(spark, shelf):
    one = spark.createDataFrame([(1, 1.5, None), (9, -2.0, "x")], "a int, b double, c string")
    two = spark.createDataFrame([(None, float("nan"), "y"), (10, 0.0, None)], "a int, b double, c string")
    shelf.publish(one, "t")
    shelf.append(two, "t")
    want = {("a", 1, "1", "10"): 1, ("b", 0, "-2.0", "NaN"): 1, ("c", 2, None, None): 1}
    assert counted(shelf.column_bounds("t")) == want
    shelf.delete_where("t", F.col("a") == 9)
    assert counted(shelf.column_bounds("t").select("column_name", "n_nulls", "low", "high"))[("a", None, "1", "10")] == 1
    with pytest.raises(ValueError, match="NULL in required columns"):
        shelf.publish(two, "t", not_null=["a"])
    assert shelf.current_version("t") == 3


def test_a_wrong_geometry_type_is_not_published(spark, shelf):
    point = bytes.fromhex("0101000000000000000000f03f0000000000000040")
    df = spark.createDataFrame([(1, bytearray(point))], "id int, wkb binary")
    publish_spatial(shelf, df, "points", Spatial("wkb", "POINT", "EPSG:4326"))
    with pytest.raises(WrongGeometryType, match="holds POINT"):
        publish_spatial(shelf, df, "points", Spatial("wkb", "POLYGON", "EPSG:4326"))
    assert shelf.current_version("points") == 1


def test_pages_fit_together_at_any_depth(spark):
    n = TOP_ROWS + 500
    df = spark.range(n).select((F.col("id") % 1000).alias("k"), F.col("id"))
    pages = Pages(df.repartition(4), ["k"])
    top, deep, last = pages.page(TOP_ROWS - 50, 50), pages.page(TOP_ROWS, 50), pages.page(n - 10, 50)
    whole = [tuple(r) for r in Pages(df, ["k"]).page(TOP_ROWS - 50, 100).collect()]
    assert [tuple(r) for r in top.collect()] + [tuple(r) for r in deep.collect()] == whole
    assert last.count() == 10 and pages.page(n + 5, 10).count() == 0
    assert "TakeOrderedAndProject" in pages.page(0, 10)._jdf.queryExecution().executedPlan().toString()


def test_an_old_log_entry_is_still_read(spark, shelf):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, kind string")
    shelf.publish(df, "old")
    entry = shelf._entry("old").asDict()
    df.write.partitionBy("kind").parquet(folder := fresh_folder(spark, "old"))
    entry = {k: v for k, v in entry.items() if k not in ("without", "next_row_id", "stats")}
    shelf._append_log("old", [{**entry, "version": 2, "folders": [f"file:{folder}"], "partition_by": ["kind"]}])
    assert json.loads(entry["schema_json"]) and counted(shelf.read("old")) == counted(df)
    assert shelf.table_changes("old", 2, 2).count() == 0


def test_work_folders_are_below_one_folder():
    class Spark:
        """Stands for a session: removing this session's own work would take other tests' data."""

        removed = []

        class conf:
            get = staticmethod(lambda name, default=None: "/shared")

        class sparkContext:
            applicationId = "app-1"

            class _jsc:
                hadoopConfiguration = staticmethod(lambda: None)

    class Target:
        def getFileSystem(self, _):
            return self

        def delete(self, target, recursive):
            Spark.removed.append(recursive)
            return True

    class org:
        class apache:
            class hadoop:
                class fs:
                    Path = staticmethod(lambda path: Spark.removed.append(path) or Target())

    Spark.sparkContext._jvm = type("jvm", (), {"org": org})
    assert work_folder(Spark) == "/shared/datashelf-app-1" and fresh_folder(Spark, "x").startswith("/shared/datashelf-app-1/x-")
    assert remove_work(Spark) and Spark.removed == ["/shared/datashelf-app-1", True]


def test_added_files_stay_where_they_are(spark, shelf):
    schema = "id long, kind long, state string"
    shelf.publish(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], schema), "added")
    outside = fresh_folder(spark, "outside")
    spark.range(10, 50).select(F.col("id"), F.col("id").cast("int").alias("kind"), F.lit(0).alias("more")).repartition(2).write.parquet(outside)
    with pytest.raises(SchemaMismatch):
        shelf.add_files("added", [outside], allow_missing=True)
    with pytest.raises(SchemaMismatch):
        shelf.add_files("added", [outside], ignore_extra=True)
    assert shelf.add_files("added", [outside], allow_missing=True, ignore_extra=True, message="more") == 2
    want = Counter([(1, 1, "a"), (2, 2, "b"), *[(i, i, None) for i in range(10, 50)]])
    assert counted(shelf.read("added")) == want and shelf._entry("added")["row_count"] == 42
    assert shelf.read("added", 1).count() == 2
    bounds = {r["column_name"]: tuple(r)[1:] for r in shelf.column_bounds("added").collect()}
    assert bounds == {"id": (0, "1", "49"), "kind": (0, "1", "49"), "state": (40, None, None)}
    held = {f for f in files(shelf, "added", 2) if "outside" in f}
    assert len(held) == 2
    feed = shelf.table_changes("added", 2, 2)
    assert feed.count() == 40 and all("outside" in f for f in feed.inputFiles())
    with pytest.raises(ValueError, match="already part"):
        shelf.add_files("added", [outside])
    shelf.delete_where("added", F.col("id") == 10)
    assert counted(shelf.read("added")) == want - Counter([(10, 10, None)])
    assert mt.compact(shelf, "added") is not None  # copies them in
    assert not [f for f in files(shelf, "added") if "outside" in f]
    mt.expire(shelf, versions=[1, 2, 3], name="added", dry_run=False)
    assert spark.read.parquet(outside).count() == 40  # not the shelf's to delete
    assert counted(shelf.read("added")) == want - Counter([(10, 10, None)])


def test_files_that_do_not_fit_are_refused(spark, shelf):
    df = spark.createDataFrame([(1, "a")], "id long, state string")
    shelf.publish(set_not_null(df, "state"), "strict")
    wrong, empty, nested = (fresh_folder(spark, x) for x in ("wrong", "empty", "nested"))
    spark.createDataFrame([("x", "a")], "id string, state string").write.parquet(wrong)
    spark.createDataFrame([(2, None)], "id long, state string").write.parquet(empty)
    df.write.parquet(f"{nested}/below")
    for folder, error in ((wrong, SchemaMismatch), (empty, ValueError), (nested, ValueError)):
        with pytest.raises(error):
            shelf.add_files("strict", [folder])
    assert shelf.current_version("strict") == 1
    shelf.publish(df, "by_state", partition_by=["state"])
    with pytest.raises(ValueError, match="partition columns"):
        shelf.add_files("by_state", [empty])
