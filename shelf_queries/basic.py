"""Scans, projections, filters, joins, aggregates, order and limits, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from datashelf.functions import scalars as S
from datashelf.operators.rows import as_of_interval, page, with_row_id
from datashelf.operators.stats import row_counts
from datashelf.sources.files import inline_rows
from shelf_queries import inputs as I
from shelf_queries.inputs import table
from shelf_queries.registry import query


@query("scan_table", "SELECT * FROM customer")
def scan_table(spark, sf):
    return table(spark, sf, "customer")


@query("project", "SELECT o_orderkey, o_totalprice AS price, o_totalprice * 2 AS double_price FROM orders")
def project(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), (F.col("o_totalprice") * 2).alias("double_price")
    )


@query("replace_column", "SELECT * EXCLUDE (c_acctbal), abs(c_acctbal) AS c_acctbal FROM customer")
def replace_column(spark, sf):
    df = table(spark, sf, "customer")
    return df.select(*[c for c in df.columns if c != "c_acctbal"], F.abs("c_acctbal").alias("c_acctbal"))


@query("filter_eq", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, sf):
    return table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@query(
    "filter_null",
    f"""SELECT cert_id, tenure IS NULL AS tenure_missing FROM ({I.CERTIFICATES})
    WHERE tenure IS NULL OR (age_band IS NOT NULL AND age_band <> '' AND tenure = 'unknown')""",
)
def filter_null(spark, sf):
    band, tenure = F.col("age_band"), F.col("tenure")
    wanted = tenure.isNull() | (band.isNotNull() & (band != "") & (tenure == "unknown"))
    return I.certificates(spark, sf).filter(wanted).select("cert_id", tenure.isNull().alias("tenure_missing"))


@query(
    "filter_and",
    f"SELECT orderkey, line, kt FROM ({I.EMISSIONS}) WHERE sector IN ('AF', 'RF') AND year = 1996 AND kt >= 10 AND kt < 50",
)
def filter_and(spark, sf):
    df = I.emissions(spark, sf)
    wanted = df.sector.isin("AF", "RF") & (df.year == 1996) & (df.kt >= 10) & (df.kt < 50)
    return df.filter(wanted).select("orderkey", "line", "kt")


@query("distinct_cols", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_cols(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "scalar_subquery",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
)
def scalar_subquery(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("scalar_subquery_orders")
    return spark.sql(
        """SELECT o_orderkey, o_orderdate FROM scalar_subquery_orders
        WHERE o_orderdate = (SELECT max(o_orderdate) FROM scalar_subquery_orders)"""
    )


@query("as_of_interval", f"SELECT * FROM ({I.INTERVALS}) WHERE begin_version <= 7 AND (7 < end_version OR end_version IS NULL)")
def as_of(spark, sf):
    return as_of_interval(I.intervals(spark, sf), 7)


# ---- joins ----


@query(
    "semi_join",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)",
)
def semi_join(spark, sf):
    # One row per customer on the right: a customer with very many orders cannot fill one partition.
    big = table(spark, sf, "orders").filter(F.col("o_totalprice") > 100000).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return table(spark, sf, "customer").join(big, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(
    "anti_join",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
)
def anti_join(spark, sf):
    buyers = table(spark, sf, "orders").filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return table(spark, sf, "customer").join(buyers, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query(
    "join_left",
    """SELECT c_custkey, count(o_orderkey) AS n_orders, max(o_orderdate) AS last_order
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
)
def join_left(spark, sf):
    # Orders are counted per customer first: a customer with very many orders costs one row in the join.
    per_customer = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("n_orders"), F.max("o_orderdate").alias("last_order")
    )
    joined = table(spark, sf, "customer").select("c_custkey").join(per_customer, ["c_custkey"], "left")
    return joined.select("c_custkey", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "last_order")


@query(
    "join_composite",
    """SELECT a.orderkey, a.line, a.kt, b.l_quantity AS quantity FROM (SELECT * FROM (""" + I.EMISSIONS + """) WHERE year = 1997) a
    JOIN lineitem b ON a.orderkey = b.l_orderkey AND a.line = b.l_linenumber WHERE b.l_quantity > 45""",
)
def join_composite(spark, sf):
    a = I.emissions(spark, sf).filter("year = 1997")
    b = table(spark, sf, "lineitem").filter("l_quantity > 45").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity")
    )
    return a.join(b, ["orderkey", "line"]).select("orderkey", "line", "kt", "quantity")


# ---- aggregates ----


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "count_if",
    """SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal < 0) AS n_negative, count(*) FILTER (WHERE NOT (c_acctbal < 0)) AS n_other
    FROM customer GROUP BY c_mktsegment""",
)
def count_if(spark, sf):
    negative = F.col("c_acctbal") < 0
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.count_if(negative).alias("n_negative"), F.count_if(~negative).alias("n_other")
    )


@query("count_distinct", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY l_returnflag")
def count_distinct(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("n_suppliers"))


@query(
    "avg_min",
    """SELECT c_mktsegment, round(avg(c_acctbal), 2) AS avg_bal, min(c_acctbal) AS min_bal, max(c_acctbal) AS max_bal
    FROM customer GROUP BY c_mktsegment""",
)
def avg_min(spark, sf):
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.round(F.avg("c_acctbal"), 2).alias("avg_bal"), F.min("c_acctbal").alias("min_bal"), F.max("c_acctbal").alias("max_bal")
    )


@query("max_date", "SELECT max(l_shipdate) AS last_ship FROM lineitem")
def max_date(spark, sf):
    return table(spark, sf, "lineitem").agg(F.max("l_shipdate").alias("last_ship"))


COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in I.TABLES)


@query("count_union", f"SELECT table_name, row_count, sum(row_count) OVER ()::BIGINT AS total FROM ({COUNTS})")
def count_union(spark, sf):
    counts = row_counts(I.all_tables(spark, sf))
    counts.createOrReplaceTempView("count_union_rows")  # one row per table
    return spark.sql("SELECT table_name, row_count, (SELECT sum(row_count) FROM count_union_rows) AS total FROM count_union_rows")


@query(
    "arg_min",
    f"SELECT arg_min(table_name, {{'n': row_count, 't': table_name}}) AS smallest, min(row_count) AS row_count FROM ({COUNTS})",
)
def arg_min(spark, sf):
    return row_counts(I.all_tables(spark, sf)).agg(
        F.min_by("table_name", F.struct("row_count", "table_name")).alias("smallest"), F.min("row_count").alias("row_count")
    )


# ---- order, limit, paging, row ids ----


@query("sort_multi", "SELECT c_mktsegment, c_nationkey, c_custkey FROM customer ORDER BY c_mktsegment, c_nationkey, c_custkey")
def sort_multi(spark, sf):
    return table(spark, sf, "customer").select("c_mktsegment", "c_nationkey", "c_custkey").orderBy("c_mktsegment", "c_nationkey", "c_custkey")


@query("topk", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey LIMIT 10")
def topk(spark, sf):
    order = [F.desc("o_orderdate"), F.desc("o_totalprice"), F.asc("o_orderkey")]
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(*order).limit(10)


@query("limit_rows", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def limit_rows(spark, sf):
    return table(spark, sf, "customer").orderBy("c_custkey").limit(5)


@query("page_rows", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber, l_quantity LIMIT 50 OFFSET 1000")
def page_rows(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return page(df, ["l_orderkey", "l_linenumber", "l_quantity"], 1000, 50)


@query("row_id", "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id FROM orders")
def row_id(spark, sf):
    return with_row_id(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


# ---- sources without a file ----


@query(
    "range_source",
    """SELECT g.k % 10 AS bucket, count(*) AS n_keys, count(*) - count(o_orderkey) AS n_missing
    FROM (SELECT unnest(range((SELECT max(o_orderkey) + 1 FROM orders))) AS k) g LEFT JOIN orders ON o_orderkey = g.k GROUP BY 1""",
)
def range_source(spark, sf):
    """Order numbers up to the highest one, and how many of them are not in use."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.lit(1).alias("used"))
    top = orders.agg(F.max("id")).first()[0]
    numbers = spark.range(top + 1).join(orders, "id", "left")
    return numbers.groupBy((F.col("id") % 10).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_keys"), (F.count(F.lit(1)) - F.count("used")).alias("n_missing")
    )


@query(
    "inline_rows",
    """SELECT label, count(*) AS n FROM orders JOIN (SELECT unnest(['1-URGENT', '2-HIGH', '5-LOW']) AS o_orderpriority,
    unnest(['now', 'soon', 'later']) AS label) USING (o_orderpriority) GROUP BY label""",
)
def inline(spark, sf):
    labels = inline_rows(spark, {"o_orderpriority": ["1-URGENT", "2-HIGH", "5-LOW"], "label": ["now", "soon", "later"]})
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(labels, "o_orderpriority").select("label", "n")


# ---- scalar functions ----


@query(
    "round_half_up",
    """SELECT p_partkey, CAST(round(p_size / 2.0::DOUBLE) AS INTEGER) AS half, round(p_retailprice, 1) AS price FROM part""",
)
def round_half_up(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.round(F.col("p_size") / F.lit(2.0)).cast("int").alias("half"), F.round("p_retailprice", 1).alias("price")
    )


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
    CAST(day(o_orderdate) AS INTEGER) AS d FROM orders""",
)
def date_parts(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d")
    )


@query(
    "epoch_parts",
    """SELECT event_id, year(ts) - 1970 AS year, (year(ts) - 1970) * 12 + month(ts) - 1 AS month,
    CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS day,
    CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, CAST(year(ts) AS INTEGER) AS hive_year,
    CAST(hour(ts) AS INTEGER) AS hive_hour FROM events""",
)
def epoch_parts(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", *[S.epoch_part(ts, p).alias(p) for p in S.PARTS],
        S.calendar_part(ts, "year").alias("hive_year"), S.calendar_part(ts, "hour").alias("hive_hour"),
    )


@query(
    "title_fallback",
    """SELECT p_partkey, coalesce(nullif(trim(CASE p_partkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' ' || p_type || ' ' END), ''), p_name) AS title,
    coalesce(CASE p_partkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' ' || p_type || ' ' END, '') AS description FROM part""",
)
def title_fallback(spark, sf):
    k = F.col("p_partkey")
    comment = F.when(k % 3 == 0, "  ").when(k % 3 == 1, F.concat(F.lit(" "), "p_type", F.lit(" ")))
    return table(spark, sf, "part").select(
        "p_partkey", S.title_or_name(comment, F.col("p_name")).alias("title"), S.text_or_empty(comment).alias("description")
    )


@query(
    "derive_name",
    """SELECT p_partkey, regexp_replace(p_name || CASE WHEN p_partkey % 2 = 0 THEN '_region_vw' ELSE '' END, '_region_vw$', '_tbl') AS source_table,
    CASE WHEN p_partkey % 2 = 0 THEN 'Region subset of ' || p_name || '_tbl' ELSE p_name END AS description FROM part""",
)
def derive_name(spark, sf):
    """Source table and description of a view, from its name."""
    name = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, "_region_vw").otherwise(""))
    source = S.swap_suffix(name, "_region_vw", "_tbl")
    return table(spark, sf, "part").select(
        "p_partkey", source.alias("source_table"),
        F.when(name.endswith("_region_vw"), F.concat(F.lit("Region subset of "), source)).otherwise(name).alias("description"),
    )


@query(
    "format_count",
    """SELECT o_orderpriority, format('{:,}', count(*)) AS n_text, format('{:,}', CAST(round(sum(o_totalprice)) AS BIGINT)) AS total_text
    FROM orders GROUP BY o_orderpriority""",
)
def format_count(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        S.thousands(F.count(F.lit(1))).alias("n_text"), S.thousands(F.round(F.sum("o_totalprice")).cast("long")).alias("total_text")
    )


@query(
    "format_ts",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp,
    CAST(floor(epoch(ts) - epoch(TIMESTAMP '2024-01-01 00:00:00')) AS BIGINT) AS elapsed_seconds FROM events""",
)
def format_ts(spark, sf):
    since = F.col("ts") - F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.floor(F.extract(F.lit("SECOND"), since) + 60 * F.extract(F.lit("MINUTE"), since)
                + 3600 * F.extract(F.lit("HOUR"), since) + 86400 * F.extract(F.lit("DAY"), since)).cast("long").alias("elapsed_seconds"),
    )


@query(
    "classify_spatial",
    """SELECT p_partkey, regexp_matches(CASE p_partkey % 4 WHEN 0 THEN 'wkb_blob' WHEN 1 THEN 'GEOMETRY(' || p_brand || ')'
    ELSE p_type END, '(?i)BLOB|GEOMETRY|WKB') AS is_spatial FROM part""",
)
def classify_spatial(spark, sf):
    k = F.col("p_partkey")
    kind = F.when(k % 4 == 0, "wkb_blob").when(k % 4 == 1, F.concat(F.lit("GEOMETRY("), "p_brand", F.lit(")"))).otherwise(F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", S.is_spatial_type(kind).alias("is_spatial"))


@query(
    "nested_access",
    """SELECT event_id, event_type AS inner_type, CAST(json_extract(props, '$.k') AS BIGINT) + 1 AS next_k, 2 AS n_tags, event_type AS first_tag
    FROM events""",
)
def nested_access(spark, sf):
    packed = table(spark, sf, "events").select(
        "event_id",
        F.struct(F.col("event_type").alias("kind"), F.from_json("props", "k long").alias("props")).alias("s"),
        F.array("event_type", F.lit("x")).alias("tags"),
        F.create_map(F.lit("a"), F.col("event_type")).alias("m"),
    )
    return packed.select(
        "event_id", F.col("s.kind").alias("inner_type"), (F.col("s.props.k") + 1).alias("next_k"),
        F.size(F.col("tags")).alias("n_tags"), F.element_at("m", "a").alias("first_tag"),
    )


@query("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("sql_macro", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def sql_macro(spark, sf):
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION shelf_net(price DOUBLE, discount DOUBLE) RETURNS DOUBLE RETURN price * (1 - discount)")
    table(spark, sf, "lineitem").createOrReplaceTempView("sql_macro_lineitem")
    return spark.sql("SELECT l_orderkey, l_linenumber, shelf_net(l_extendedprice, l_discount) AS net FROM sql_macro_lineitem")
