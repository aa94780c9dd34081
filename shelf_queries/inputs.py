"""Inputs derived from the test tables, once for Spark and once as SQL with the same meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datashelf.functions import wkb
from datashelf.sources.files import read_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

AGE_BANDS = ["X: 1900-1929", "X: 1930-1949", "X: before 1900", "X: 2012 onwards", "1930", "1900", "2007", "NO DATA"]
TENURES = ["Owner-occupied", "rented (social)", "Rental (social)", "rental (private)", "Rented (private)", "unknown"]
AREA_CODES = ["N03", "N07", "N11", "N19"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def all_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: table(spark, sf, t) for t in TABLES}


def code(prefix: str, number: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(number).cast("string"), width, "0"))


def choose(key: str, values: list[str], n: int) -> Column:
    """The value at position ``key % n``; NULL beyond the list."""
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col(key) % n).cast("int"))


def sql_choose(key: str, values: list[str], n: int) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} % {n} {cases} END"


# ---- lookup: one row per supplier with its region as the group ----


def lookup(spark, sf) -> DataFrame:
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        code("S", "s_suppkey", 7).alias("code"), F.col("s_name").alias("name"),
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("group_code"), F.col("r_name").alias("group_name"),
    )


LOOKUP = """SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS code, s_name AS name,
  'R' || CAST(r_regionkey AS VARCHAR) AS group_code, r_name AS group_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def emissions(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        code("S", "l_suppkey", 7).alias("code"), F.year("l_shipdate").alias("year"),
        F.concat("l_returnflag", "l_linestatus").alias("sector"), (F.col("l_extendedprice") / 1000).alias("kt"),
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"),
    )


EMISSIONS = """SELECT 'S' || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS code, CAST(year(l_shipdate) AS INTEGER) AS year,
  l_returnflag || l_linestatus AS sector, l_extendedprice / 1000 AS kt, l_orderkey AS orderkey, l_linenumber AS line
  FROM lineitem"""


# ---- certificates and address points ----


def certificates(spark, sf) -> DataFrame:
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select(
        F.col("o_orderkey").alias("cert_id"), F.col("o_custkey").alias("address_id"), code("N", "c_nationkey", 2).alias("code"),
        choose("o_orderkey", AGE_BANDS, 8).alias("age_band"), choose("o_orderkey", TENURES, 7).alias("tenure"),
        F.col("o_orderdate").alias("lodged_at"),
    )


CERTIFICATES = f"""SELECT o_orderkey AS cert_id, o_custkey AS address_id,
  'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code,
  {sql_choose("o_orderkey", AGE_BANDS, 8)} AS age_band, {sql_choose("o_orderkey", TENURES, 7)} AS tenure,
  o_orderdate AS lodged_at FROM orders JOIN customer ON o_custkey = c_custkey"""


def points_xy(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("address_id"),
        (350000 + (key * 37) % 30000).cast("double").alias("easting"),
        (160000 + (key * 91) % 30000).cast("double").alias("northing"),
    )


def points(spark, sf) -> DataFrame:
    """Address points with their shape as WKB."""
    shape = wkb.encode_wkb(wkb.point_geometry(F.col("easting"), F.col("northing")))
    return points_xy(spark, sf).select("address_id", shape.alias("shape"))


POINTS = """SELECT c_custkey AS address_id, CAST(350000 + (c_custkey * 37) % 30000 AS DOUBLE) AS easting,
  CAST(160000 + (c_custkey * 91) % 30000 AS DOUBLE) AS northing FROM customer"""


# ---- areas: one (multi)polygon per customer ----


def _ring(*xy) -> Column:
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in xy])


def _box(x, y, w, h) -> Column:
    return _ring((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))


def areas(spark, sf) -> DataFrame:
    """Rectangles: every third twice, every fourth with a hole, every fifth twisted into an invalid bow-tie. As WKB."""
    n = F.col("c_custkey")
    base = table(spark, sf, "customer").select(
        n.alias("area_id"),
        (300000 + (n * 37) % 30000).alias("x"), (150000 + (n * 91) % 30000).alias("y"),
        (100 + n % 50 * 10).alias("w"), (50 + n % 50 * 5).alias("h"),
    )
    i, x, y, w, h = (F.col(c) for c in ("area_id", "x", "y", "w", "h"))
    bow = F.array(F.array(_ring((x, y), (x + w, y + h), (x + w, y), (x, y + h), (x, y))))
    shell = _box(x, y, w, h)
    first = F.when(i % 4 == 1, F.array(shell, _box(x + w / 4, y + h / 4, w / 2, h / 2))).otherwise(F.array(shell))
    second = F.array(_box(x + w + 10, y, w, h))
    parts = F.when(i % 5 == 0, bow).when(i % 3 == 0, F.array(first, second)).otherwise(F.array(first))
    kind = F.when((i % 5 != 0) & (i % 3 == 0), "MULTIPOLYGON").otherwise("POLYGON")
    return base.select("area_id", wkb.encode_wkb(F.struct(kind.alias("type"), parts.alias("parts"))).alias("shape"))


AREAS = """SELECT area_id, x, y, w, h, area_id % 5 = 0 AS bow, area_id % 3 = 0 AND area_id % 5 <> 0 AS twice,
  area_id % 4 = 1 AND area_id % 5 <> 0 AS hole FROM (SELECT c_custkey AS area_id, 300000 + (c_custkey * 37) % 30000 AS x,
  150000 + (c_custkey * 91) % 30000 AS y, 100 + c_custkey % 50 * 10 AS w, 50 + c_custkey % 50 * 5 AS h FROM customer)"""

# ---- three versions of customer ----


def v1(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").filter("c_custkey % 11 <> 0")


def v2(spark, sf) -> DataFrame:
    customer = table(spark, sf, "customer")
    raised = F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal") + 10).otherwise(F.col("c_acctbal"))
    kept = customer.filter("c_custkey % 11 <> 0 AND c_custkey % 7 <> 0").withColumn("c_acctbal", raised)
    return kept.unionByName(customer.filter("c_custkey % 11 = 0"))


def v3_values(df: DataFrame) -> DataFrame:
    changed = F.when(F.col("c_custkey") % 13 == 0, "CHANGED").otherwise(F.col("c_mktsegment"))
    return df.withColumn("c_mktsegment", changed)


V1 = "SELECT * FROM customer WHERE c_custkey % 11 <> 0"
V2 = """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 10 ELSE c_acctbal END AS c_acctbal,
  c_mktsegment FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 7 <> 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 11 = 0"""
V3 = f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_custkey % 13 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment, 'std' AS tier FROM ({V2})"""


def intervals(spark, sf) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", (k % 20).alias("begin_version"),
        F.when(k % 4 != 0, k % 20 + k % 9 + 1).alias("end_version"),
    )


INTERVALS = """SELECT o_orderkey, o_orderkey % 20 AS begin_version,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 20 + o_orderkey % 9 + 1 END AS end_version FROM orders"""
