"""Publishing, versions, change feed, merge, evolution, upkeep."""

import glob
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datashelf.operators import changes as ch
from datashelf.operators import evolve as ev
from datashelf.operators import stats as st
from datashelf.operators.rows import as_of_interval, page, union_by_name, with_row_id
from datashelf.plans import catalogue as cat
from datashelf.plans import maintain as mt
from datashelf.plans import quality as q
from datashelf.plans.refresh import Config, Spatial, Table, read_geo, refresh
from datashelf.plans.views import CERTIFICATE_COLUMNS, standard_views
from datashelf.session import fresh_folder
from datashelf.sources import files as fs
from datashelf.sources.shelf import NotPublished, export_chunks

T0 = datetime(2025, 1, 1, tzinfo=timezone.utc)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "John", 92000.0), (2, "Anna", 100000.0)], "id int, name string, salary double")


def test_merge_steps(spark, people):
    step1 = ch.merge(people, spark.createDataFrame([(3, "Sarah", 95000.0), (1, "John", 105000.0)], people.schema), ["id"])
    assert rows(step1) == [(1, "John", 105000.0), (2, "Anna", 100000.0), (3, "Sarah", 95000.0)]
    raise_ = spark.createDataFrame([(1, 98000.0)], "id int, salary double")
    step2 = ch.merge(step1, raise_, ["id"], matched={"salary": "s.salary"}, not_matched=None)
    assert rows(step2) == [(1, "John", 98000.0), (2, "Anna", 100000.0), (3, "Sarah", 95000.0)]
    step3 = ch.merge(step2, spark.createDataFrame([(1,)], "id int"), ["id"], matched="delete", not_matched=None)
    assert rows(step3) == [(2, "Anna", 100000.0), (3, "Sarah", 95000.0)]
    gone = spark.createDataFrame([(3,), (2,)], "id int")
    step4 = ch.merge(step3, gone, ["id"], matched="delete", matched_if="t.salary >= 100000", not_matched=None)
    assert rows(step4) == [(3, "Sarah", 95000.0)]


def test_merge_keys(spark, people):
    twice = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], people.schema)
    with pytest.raises(ch.DuplicateSourceKey):
        ch.merge(people, twice, ["id"])
    holes = people.unionByName(spark.createDataFrame([(None, "Nobody", 1.0)], people.schema))
    merged = ch.merge(holes, spark.createDataFrame([(None, "New", 2.0), (None, "New2", 3.0)], people.schema), ["id"])
    assert sorted(r["name"] for r in merged.collect()) == ["Anna", "John", "New", "New2", "Nobody"]


def test_change_feed_example(spark, shelf):
    schema = "id int, val string"
    shelf.publish(spark.createDataFrame([], schema), "tbl")
    shelf.publish(spark.createDataFrame([(1, "Hello"), (2, "Lake")], schema), "tbl")
    shelf.publish(spark.createDataFrame([(2, "Lake")], schema), "tbl")
    shelf.publish(shelf.read("tbl").withColumn("val", F.concat("val", "val", "val")), "tbl")
    assert rows(shelf.table_changes("tbl", 2, 2, ["id"])) == [(2, "insert", 1, "Hello"), (2, "insert", 2, "Lake")]
    assert rows(shelf.table_changes("tbl", 3, 4, ["id"])) == [
        (3, "delete", 1, "Hello"), (4, "update_postimage", 2, "LakeLakeLake"), (4, "update_preimage", 2, "Lake"),
    ]
    assert shelf.table_changes("tbl", 1, 1, ["id"]).count() == 0
    with pytest.raises(NotPublished):
        shelf.table_changes("tbl", 9, 9)


def test_change_feed_against_brute_force(spark):
    """Random multisets with copies, NULLs and repeated keys, with and without a key."""
    rng = random.Random(3)
    states = []
    for _ in range(4):
        n = rng.randint(0, 40)
        states.append([(rng.choice([None, 1, 2, 3, 4]), rng.choice(["a", "b", None])) for _ in range(n)] + [(7, "copy")] * rng.randint(0, 50))
    frames = [(i, spark.createDataFrame(s, "k int, v string")) for i, s in enumerate(states)]
    want_plain, want_keyed = Counter(), Counter()
    for i in range(1, 4):
        old, new = Counter(states[i - 1]), Counter(states[i])
        gone, come = old - new, new - old
        for word, part in (("delete", gone), ("insert", come)):
            for row, n in part.items():
                want_plain[(i, word, *row)] += n
                one = sum(c for r, c in gone.items() if r[0] == row[0]) == 1 == sum(c for r, c in come.items() if r[0] == row[0])
                keyed = {"delete": "update_preimage", "insert": "update_postimage"}[word] if one else word
                want_keyed[(i, keyed, *row)] += n
    assert Counter(tuple(r) for r in ch.table_changes(frames).collect()) == want_plain
    assert Counter(tuple(r) for r in ch.table_changes(frames, ["k"]).collect()) == want_keyed


def test_many_copies_are_all_emitted(spark, monkeypatch):
    monkeypatch.setattr(ch, "COPIES_PER_STEP", 7)
    new = spark.range(100).select(F.lit(1).alias("k"))
    feed = ch.table_changes([(None, None), (1, new)])
    assert feed.count() == 100 and feed.distinct().count() == 1


def test_delete_and_update_with_null_conditions(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    assert rows(ch.delete_where(df, F.col("v") > 10)) == [(1, 5), (2, None)]
    assert rows(ch.update_where(df, {"v": F.lit(0)}, F.col("v") > 10)) == [(1, 5), (2, None), (3, 0)]


def test_versions_and_times(spark, shelf, people):
    for i in range(3):
        shelf.publish(people.filter(F.col("id") <= i), "people", now=T0 + timedelta(days=i), message=f"m{i}", author="me")
    assert shelf.current_version("people") == shelf.last_committed["people"] == 3
    assert shelf.read("people", version=2).count() == 1
    assert shelf.read("people", ts=T0 + timedelta(days=1, seconds=1)).count() == 1
    with pytest.raises(NotPublished):
        shelf.read("people", ts=T0 - timedelta(days=1))
    with pytest.raises(NotPublished):
        shelf.read("other")
    past = shelf.at(version=2)
    assert past.read("people").count() == 1 and not hasattr(past, "publish")
    assert shelf.at(ts=T0).read("people").count() == 0
    assert shelf.rollback("people", 1) == 4 and shelf.read("people").count() == 0
    changes = shelf.table_changes("people", T0 + timedelta(hours=1), T0 + timedelta(days=1), ["id"])
    assert rows(changes, "snapshot_id", "change_type", "id") == [(2, "insert", 1)]


def test_drop_and_republish(shelf, people):
    shelf.publish(people, "people")
    assert shelf.drop("people") and not shelf.drop("people")
    with pytest.raises(NotPublished):
        shelf.read("people")
    assert shelf.read("people", version=1).count() == 2
    assert shelf.publish(people, "people") == 3
    assert rows(shelf.list_datasets()) == [("people",)]


def test_publish_rules(spark, people):
    from datashelf.sources.shelf import Shelf

    strict = Shelf(spark, fresh_folder(spark, "strict"), require_message=True)
    with pytest.raises(ValueError, match="message"):
        strict.publish(people, "people", message=" ")
    with pytest.raises(ValueError, match="NULL"):
        strict.publish(people.withColumn("name", F.lit(None).cast("string")), "people", message="x", not_null=["name"])
    assert strict.list_datasets().count() == 0
    strict.publish(people, "people", message="x", title=" ", comments={"id": "Number"}, user={"source_db": "s"})
    meta = strict.meta("people").first()
    assert meta["title"] == "people" and meta["columns"]["id"] == "Number" and meta["user"] == {"source_db": "s"}
    assert strict.read("people").schema["id"].metadata["comment"] == "Number"


def test_rename_and_required_columns(spark, shelf, people):
    shelf.publish(ev.set_not_null(people, "name"), "people")
    assert shelf.rename("people", "staff") == 1 and rows(shelf.list_datasets()) == [("staff",)]
    assert mt.expire(shelf, datetime.now(timezone.utc) + timedelta(days=1), name="people", dry_run=False) == []
    blank = shelf.read("staff").withColumn("salary", F.lit(None).cast("double"))
    shelf.replace_rows(blank, "staff")
    nameless = ch.update_where(shelf.read("staff"), {"name": F.lit(None)}, F.lit(True))
    with pytest.raises(ValueError, match="NULL"):
        shelf.replace_rows(ev.set_not_null(nameless, "name"), "staff")
    shelf.replace_rows(ev.drop_not_null(nameless, "name"), "staff")
    assert shelf.current_version("staff") == 3 and mt.orphan_files(shelf).filter("path LIKE '%v00000001-%'").count() == 0


def test_second_writer_is_refused(shelf, people, monkeypatch):
    shelf.publish(people, "people")
    monkeypatch.setattr(shelf, "_next_version", lambda name: 1)
    with pytest.raises(FileExistsError):
        shelf.publish(people, "people")
    assert shelf.versions("people").count() == 1


def test_added_column_default_reaches_old_versions(spark, shelf, people):
    shelf.publish(people, "people")
    shelf.publish(ev.add_column(people, "tier", "string", "std"), "people")
    feed = shelf.table_changes("people", 1, 2, ["id"])
    assert rows(feed, "snapshot_id", "change_type", "id", "tier") == [(1, "insert", 1, "std"), (1, "insert", 2, "std")]


def test_promotions(spark):
    types = ["tinyint", "smallint", "int", "bigint", "float", "double", "string"]
    allowed = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
               ("int", "bigint"), ("float", "double")}
    for old in types:
        df = spark.range(1).select(F.lit(1).cast(old).alias("c"))
        for new in types:
            if (old, new) in allowed:
                assert ev.promote(df, "c", new).schema["c"].dataType.simpleString() == new
            elif old != new:
                with pytest.raises(ev.SchemaMismatch):
                    ev.promote(df, "c", new)


def test_align(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string")
    schema = T.StructType().add("a", "long").add("c", "string")
    out = ev.align(old, schema, {"c": "d"})
    assert rows(out) == [(1, "d")] and out.schema["a"].dataType == T.LongType()


def test_conform_rules(spark):
    folder = fresh_folder(spark, "conform")
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{folder}/f")
    spark.createDataFrame([(5,)], "a bigint").write.parquet(f"{folder}/wide")
    read = lambda path, ddl, **kw: ev.read_conformed(spark, [f"{folder}/{path}"], T.StructType.fromDDL(ddl), **kw)
    with pytest.raises(ev.SchemaMismatch, match="undeclared"):
        read("f", "a bigint")
    with pytest.raises(ev.SchemaMismatch, match="missing"):
        read("f", "a bigint, b string, c string")
    with pytest.raises(ev.SchemaMismatch, match="declared"):
        read("wide", "a int")
    assert rows(read("f", "a bigint", ignore_extra=True)) == [(1,)]
    assert rows(read("f", "a bigint, b string, c string", allow_missing=True, defaults={"c": "it's"})) == [(1, "x", "it's")]


def test_prune_and_merge_stats_compare_values_not_text(spark):
    stats = spark.createDataFrame([("f1", "c", "2", "9"), ("f2", "c", "10", "30"), ("f3", "c", None, None)],
                                  "data_file string, column_name string, min_value string, max_value string")
    for op, value, want in [("=", 10, ["f2", "f3"]), ("<", 3, ["f1", "f3"]), (">", 9, ["f2", "f3"]), (">=", 9, ["f1", "f2", "f3"]), ("<=", 1, ["f3"])]:
        assert sorted(r[0] for r in st.prune_files(stats, "c", op, value, "int").collect()) == want
    a = spark.createDataFrame([(2, 1.5), (9, float("nan"))], "i int, d double")
    b = spark.createDataFrame([(10, 12.0), (None, 3.0)], "i int, d double")
    merged = {r["column_name"]: r for r in st.merge_stats(st.column_stats(a), st.column_stats(b)).collect()}
    assert (merged["i"]["min_value"], merged["i"]["max_value"], merged["i"]["contains_null"]) == ("2", "10", True)
    assert (merged["d"]["min_value"], merged["d"]["max_value"], merged["d"]["contains_nan"]) == ("1.5", "12.0", True)


def test_samples(spark):
    df = spark.createDataFrame([("b", 1.5, [1]), ("a", None, [2]), ("a", 1.5, None), ("d", 1.5, None), ("c", 1.5, None)], "s string, d double, l array<int>")
    assert rows(st.sample_distinct(df)) == [("d", "1.500000", None, None), ("l", None, None, None), ("s", "a", "b", "c")]


def test_row_ids_with_one_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    ids = with_row_id(df.repartition(5), ["k"]).collect()
    assert sorted(r["row_id"] for r in ids) == list(range(3000))
    assert [r["k"] for r in sorted(ids, key=lambda r: r["row_id"])] == sorted(r["k"] for r in df.collect())


def test_pages_fit_together(spark):
    ties = spark.range(3000).select(F.lit(1).alias("k"), "id")
    pages = [page(ties, ["k"], at, n) for at, n in ((0, 1000), (1000, 1500), (2500, 500))]
    assert sorted(r["id"] for p in pages for r in p.collect()) == list(range(3000))
    mixed = spark.range(500).select((F.col("id") * 7 % 500).alias("k"))
    assert [r["k"] for r in page(mixed, ["k"], 100, 20).collect()] == list(range(100, 120))


def test_validity_interval(spark):
    df = spark.createDataFrame([("a", 0, None), ("b", 1, 3), ("c", 3, None)], "n string, begin_version int, end_version int")
    assert ["".join(sorted(r["n"] for r in as_of_interval(df, v).collect())) for v in range(4)] == ["a", "ab", "ab", "ac"]


def test_union_by_name_removes_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "s string, i int")
    assert rows(union_by_name(a, b)) == [(1, "x"), (2, "y")]


def test_csv_missing_text(spark):
    folder = fresh_folder(spark, "csv")
    fs.write_csv(spark.createDataFrame([("a", 1.5), (None, None)], "s string, bbox double"), folder)
    back = fs.read_csv(spark, folder)
    assert rows(back) == [("a", 1.5), (None, None)] and back.schema["bbox"].dataType == T.DoubleType()


def test_read_source_formats(spark, people):
    folder = fresh_folder(spark, "source")
    people.write.json(folder)
    assert fs.read_source(spark, "json", path=folder).count() == 2


def test_expire_compact_orphans(spark, shelf, people):
    for i in range(3):
        shelf.publish(people.repartition(2), "people", now=T0 + timedelta(days=i))
    shelf.rollback("people", 1, now=T0 + timedelta(days=3))
    assert mt.expire(shelf, T0 + timedelta(days=30)) == [("people", 1), ("people", 2), ("people", 3)]
    mt.expire(shelf, T0 + timedelta(days=30), dry_run=False)
    # Version 4 shares the folder of version 1, which therefore stays.
    assert shelf.read("people").count() == 2
    assert len(glob.glob(f"{shelf.root.removeprefix('file:')}/people/v*")) == 1
    assert mt.compact(shelf, "people") == 5 and shelf.files("people").count() == 1
    assert mt.compact(shelf, "people") is None
    people.write.parquet(f"{shelf.root}/people/v00000009-broken")
    soon = datetime.now(timezone.utc) + timedelta(hours=1)
    assert mt.remove_orphans(shelf, T0) == 0
    assert mt.remove_orphans(shelf, soon, dry_run=False) >= 1
    assert mt.orphan_files(shelf).count() == 0 and shelf.read("people").count() == 2
    # what a job that died leaves is hidden from Spark's own listings
    people.write.parquet(f"{shelf.root}/people/_temporary/0/part")
    assert mt.orphan_files(shelf).count() > 0 and mt.remove_orphans(shelf, soon, dry_run=False) == 1
    with pytest.raises(ValueError):
        mt.expire(shelf, versions=[1])


def test_append_writes_new_rows_only_and_keeps_partitions(spark, shelf):
    df = spark.range(90).select("id", (F.col("id") % 3).alias("k"))
    shelf.publish(df, "parts", partition_by=["k"], not_null=["id"])
    before = {r["data_file"] for r in shelf.files("parts").collect()}
    shelf.append(df.select(F.col("id") + 90, "k").toDF("id", "k"), "parts")
    after = {r["data_file"] for r in shelf.files("parts").collect()}
    assert before < after and shelf.read("parts").count() == 180
    assert all("/k=" in f for f in after)
    shelf.replace_rows(shelf.read("parts").filter("id <> 5"), "parts")
    assert "PartitionFilters: [isnotnull(k" in shelf.read("parts").filter("k = 1")._jdf.queryExecution().toString()
    for i in range(3):
        shelf.append(df.filter(F.col("id") < 6).select(F.col("id") + 1000 * (i + 1), "k").toDF("id", "k"), "parts")
    big = shelf._entry("parts")["folders"][0]
    n = shelf.files("parts").count()
    assert mt.compact(shelf, "parts", target_bytes=4 * 1024) is not None
    assert shelf.files("parts").count() < n and shelf.read("parts").count() == 179 + 18
    assert all("/k=" in r["data_file"] for r in shelf.files("parts").collect()) and big
    # a type that widens is written anew
    shelf.publish(spark.range(2).select(F.col("id").cast("int").alias("id")), "narrow")
    shelf.append(spark.range(3), "narrow")
    assert shelf.read("narrow").schema["id"].dataType == T.LongType() and shelf.read("narrow").count() == 5


def test_export_counts_files(spark):
    folder = fresh_folder(spark, "export")
    assert export_chunks(spark.range(10).repartition(3), folder, rows_per_file=2) == len(glob.glob(f"{folder.removeprefix('file:')}/*.parquet"))


def test_conformed_read_finds_nested_files(spark):
    folder = fresh_folder(spark, "nested")
    spark.range(10).write.parquet(f"{folder}/a")
    spark.range(5).write.parquet(f"{folder}/a/b/c")
    assert ev.read_conformed(spark, [folder], spark.range(1).schema).count() == 15


def test_typed_defaults_and_decimals(spark, people):
    import datetime as dt
    from decimal import Decimal

    added = ev.add_column(people, "since", "date", dt.date(2024, 2, 3))
    added = ev.add_column(added, "rate", "decimal(6,2)", Decimal("1.50"))
    added = ev.add_column(added, "note", "string", "a\\'b")
    folder = fresh_folder(spark, "old")
    people.write.parquet(folder)
    old = spark.read.schema(ev.with_read_defaults(added.schema)).parquet(folder).first()
    assert (old["since"], old["rate"], old["note"]) == (dt.date(2024, 2, 3), Decimal("1.50"), "a\\'b")
    assert not ev.fits(T.DecimalType(10, 0), T.DecimalType(10, 5)) and ev.fits(T.DecimalType(5, 0), T.DecimalType(10, 5))


def test_nan_files_are_not_pruned(spark):
    stats = spark.createDataFrame(
        [("x", "double", "a", "1.0", "1.0", True)], "column_name string, column_type string, data_file string, min_value string, max_value string, contains_nan boolean"
    )
    assert [st.prune_files(stats, "x", op, 10.0, "double").count() for op in (">", ">=", "=", "<")] == [1, 1, 0, 1]


def test_change_summary_sums_copies(spark):
    one = spark.createDataFrame([(1,)] * 5, "a int")
    feed = ch.table_changes([(None, None), (1, one)], copies="n")
    assert feed.count() == 1
    assert rows(ch.change_summary(feed, "n").select("inserted", "changes")) == [(5, "inserted")]


def test_partitioned_publish_prunes(spark, shelf):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("part"))
    shelf.publish(df, "parts", partition_by=["part"])
    plan = shelf.read("parts").filter("part = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    assert shelf.read("parts").filter("part = 1").count() == 25


def test_contract_and_preflight(spark, shelf, people):
    with pytest.raises(q.PreflightFailed):
        q.preflight(spark, {"ok": lambda: people, "bad": lambda: spark.read.parquet("/no/such/folder")})
    found = q.reconcile_counts(spark.createDataFrame([("a", 1), ("b", 2)], "table_name string, row_count long"),
                               spark.createDataFrame([("a", 1), ("b", 3), ("c", 1)], "table_name string, row_count long"))
    assert rows(found, "table_name", "status") == [("a", "MATCH"), ("b", "MISMATCH"), ("c", "MISMATCH")]
    assert q.same_rows(people, people.orderBy("id")) and not q.same_rows(people, people.unionAll(people.limit(1)))


def test_refresh_keeps_going_and_keeps_good_versions(spark, shelf, people):
    point = spark.createDataFrame([(1, b"\x01\x01\0\0\0" + bytes(16))], "id int, shape binary")
    broken = spark.createDataFrame([(1, b"\x01")], "id int, shape binary")
    good = {"people": Table(lambda: people, "People", {"id": "Number"}), "spots": Table(lambda: point, "Spots", spatial=Spatial("shape", "POINT", "EPSG:4326"))}
    first = refresh(Config(shelf, good, now=T0))
    assert all(r["passed"] for r in first.collect()) and q.verdict(first).first()["all_passed"]
    assert all(r["passed"] for r in q.publish_contract(shelf).collect())
    catalogue = {r["name"]: r for r in shelf.read("datasets_catalogue").collect()}
    assert catalogue["spots"]["geometry_type"] == "POINT" and catalogue["people"]["crs"] is None
    assert {r["data_type"] for r in shelf.read("columns_catalogue").filter("column_name = 'shape'").collect()} == {"GEOMETRY"}
    bad = {**good, "spots": Table(lambda: broken, "Spots", spatial=Spatial("shape", "POINT", "EPSG:4326"))}
    second = {r["table_name"]: r for r in refresh(Config(shelf, bad, now=T0 + timedelta(days=1))).collect()}
    assert second["people"]["passed"] and not second["spots"]["passed"] and second["spots"]["reason"]
    assert shelf.current_version("spots") == 1 and read_geo(shelf, "spots").count() == 1


def test_comments_on_catalogue_tables(spark, people):
    people.createOrReplaceTempView("people_source")
    spark.sql("CREATE TABLE IF NOT EXISTS commented USING parquet AS SELECT * FROM people_source")
    try:
        cat.comment_table(spark, "commented", "It's people", {"id": "Person's \\ number"})
        assert spark.table("commented").schema["id"].metadata["comment"] == "Person's \\ number"
        assert spark.catalog.getTable("commented").description == "It's people"
    finally:
        spark.sql("DROP TABLE IF EXISTS commented")


def test_standard_views(spark):
    codes, extra = ["E1", "E2"], {"ladcd": "E2", "ladnm": "Two", "cauthcd": "C1", "cauthnm": "Group"}
    lookup = spark.createDataFrame([("E1", "One", "C1", "Group"), ("E9", "Nine", "C2", "Other")], "LAD25CD string, LAD25NM string, CAUTH25CD string, CAUTH25NM string")
    ghg = spark.createDataFrame(
        [("UK", "K", "R", "S", "E1", "One", 2.0), ("UK", "K", "R", "S", "E7", "Seven", 3.0)],
        "country string, country_code string, region string, second_tier_authority string, local_authority_code string, local_authority_name string, kt double",
    )
    wanted = {c: F.lit("v") for c in CERTIFICATE_COLUMNS}
    wanted |= {"UPRN": F.lit("u1"), "LOCAL_AUTHORITY": F.lit("E1"), "CONSTRUCTION_AGE_BAND": F.lit("1900-1929"),
               "TENURE": F.lit("Owner-occupied"), "LODGEMENT_DATETIME": F.lit("2024-05-06 07:08:09").cast("timestamp_ntz")}
    epc = spark.range(1).select(*[v.alias(k) for k, v in wanted.items()])
    import struct

    points = spark.createDataFrame([("u1", struct.pack("<bIdd", 1, 1, 651409.903, 313177.270))], "UPRN string, shape binary")
    other = spark.createDataFrame([("E1",), ("E8",)], "code string")
    tables = {
        "ca_la_lookup_tbl": lookup, "la_ghg_emissions_tbl": ghg, "raw_domestic_epc_certificates_tbl": epc, "address_points": points,
        "la_ghg_emissions_wide_tbl": other.withColumnRenamed("code", "local_authority_code"),
        "raw_non_domestic_epc_certificates_tbl": other.withColumnRenamed("code", "LOCAL_AUTHORITY"),
        "boundary_lookup_tbl": other.withColumnRenamed("code", "ladcd"),
        "postcode_centroids_tbl": other.withColumnRenamed("code", "lad25cd"), "iod2025_tbl": other.withColumnRenamed("code", "la_cd"),
    }
    views = standard_views(codes, "Group", extra, "address_points")
    assert len(views) == 13
    counts = {name: df.count() for name, df in views.build_all(tables).items()}
    assert counts.pop("area_lookup_inclusive_vw") == 3 and counts.pop("region_areas_vw") == 2
    assert set(counts.values()) == {1}
    joined = views.build("ghg_emissions_sub_sector_vw", tables)
    assert joined.columns == ["local_authority_code", "local_authority_name", "kt", "cauthcd", "cauthnm"]
    row = views.build("domestic_certificates_points_vw", tables).first()
    assert row["geo_point_2d"] == "{52.657979, 1.716052}" and len(row) == 36
    assert rows(views.lineage(spark).filter("view_name = 'ghg_emissions_sub_sector_vw'"), "source_table") == [("ca_la_lookup_tbl",), ("la_ghg_emissions_tbl",)]
