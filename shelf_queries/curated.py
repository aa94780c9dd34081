"""Curated views and the analysts' grouped queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from datashelf.functions import certificates as C
from datashelf.operators.rows import region_filter
from datashelf.operators.stats import row_counts
from datashelf.plans.views import CERTIFICATE_COLUMNS, ViewRegistry, facts_with_lookup, inclusive_lookup, standard_views
from shelf_queries import inputs as I
from shelf_queries.registry import query

CODES = ", ".join(f"'{c}'" for c in I.AREA_CODES)


@query("star_exclude", f"WITH e AS ({I.EMISSIONS}) SELECT * EXCLUDE (orderkey, line) FROM e WHERE year = 1995")
def star_exclude(spark, sf):
    return I.emissions(spark, sf).filter("year = 1995").drop("orderkey", "line")


@query("region_filter", f"SELECT * FROM ({I.CERTIFICATES}) WHERE code IN ({CODES})")
def by_region(spark, sf):
    return region_filter(I.certificates(spark, sf), "code", I.AREA_CODES)


@query("join_inner", f"SELECT e.orderkey, e.line, e.kt, l.name, l.group_name FROM ({I.EMISSIONS}) e JOIN ({I.LOOKUP}) l ON e.code = l.code")
def join_inner(spark, sf):
    joined = I.emissions(spark, sf).join(I.lookup(spark, sf), "code")
    return joined.select("orderkey", "line", "kt", "name", "group_name")


@query(
    "sum_by_group",
    f"SELECT sector, round(sum(kt), 1) AS total_kt FROM ({I.EMISSIONS}) WHERE year = 1996 GROUP BY sector ORDER BY total_kt DESC",
)
def sum_by_group(spark, sf):
    found = I.emissions(spark, sf).filter("year = 1996")
    return found.groupBy("sector").agg(F.round(F.sum("kt"), 1).alias("total_kt")).orderBy(F.desc("total_kt"))


@query(
    "count_sum_group",
    f"""SELECT l.group_name, count(*) AS n, round(sum(e.kt), 1) AS total_kt FROM ({I.EMISSIONS}) e JOIN ({I.LOOKUP}) l ON e.code = l.code
    GROUP BY l.group_name""",
)
def count_sum_group(spark, sf):
    # Per area first, then by group: the join sees one row per area.
    per_area = I.emissions(spark, sf).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.sum("kt").alias("kt"))
    joined = per_area.join(I.lookup(spark, sf), "code")
    return joined.groupBy("group_name").agg(F.sum("n").alias("n"), F.round(F.sum("kt"), 1).alias("total_kt"))


@query(
    "join_group_topk",
    f"""SELECT l.name, e.year, round(sum(e.kt), 1) AS total_emissions FROM ({I.EMISSIONS}) e JOIN ({I.LOOKUP}) l ON e.code = l.code
    WHERE l.group_name = 'EUROPE' GROUP BY l.name, e.year ORDER BY e.year DESC, total_emissions DESC, l.name LIMIT 8""",
)
def join_group_topk(spark, sf):
    """Facts of one group's areas, summed by area and year; the top eight."""
    members = I.lookup(spark, sf).filter(F.col("group_name") == "EUROPE").select("code", "name")
    yearly = I.emissions(spark, sf).join(members, "code").groupBy("name", "year")
    totals = yearly.agg(F.round(F.sum("kt"), 1).alias("total_emissions"))
    return totals.orderBy(F.desc("year"), F.desc("total_emissions"), F.asc("name")).limit(8)


INCLUSIVE = f"""SELECT code AS ladcd, name AS ladnm, group_code AS cauthcd, group_name AS cauthnm FROM ({I.LOOKUP})
  UNION SELECT 'S9999999', 'Extra area', 'R3', 'EUROPE'"""
NAMES = {"code": "ladcd", "name": "ladnm", "group_code": "cauthcd", "group_name": "cauthnm"}
EXTRA = {"ladcd": "S9999999", "ladnm": "Extra area", "cauthcd": "R3", "cauthnm": "EUROPE"}


def registry() -> ViewRegistry:
    """Views over ``lookup`` and ``emissions``; the second and third build on the first."""
    views = ViewRegistry()
    views.add("inclusive_vw", ["lookup"], lambda t: inclusive_lookup(t, NAMES, EXTRA), "Lookup with the extra area")
    views.add("group_vw", ["inclusive_vw"], lambda v: v.filter(F.col("cauthnm") == "EUROPE"), "Areas of one group")
    views.add(
        "emissions_vw", ["emissions", "inclusive_vw"],
        lambda e, v: facts_with_lookup(e, v, "code", "ladcd", ["ladcd", "ladnm", "cauthcd"]), "Emissions with their group",
    )
    return views


def sources(spark, sf):
    return {"lookup": I.lookup(spark, sf), "emissions": I.emissions(spark, sf)}


@query("union_by_name", INCLUSIVE)
def union_by_name(spark, sf):
    return registry().build("inclusive_vw", sources(spark, sf))


@query("view_on_view", f"SELECT * FROM ({INCLUSIVE}) WHERE cauthnm = 'EUROPE'")
def view_on_view(spark, sf):
    return registry().build("group_vw", sources(spark, sf))


EMISSIONS_VIEW = f"SELECT e.*, i.cauthnm FROM ({I.EMISSIONS}) e JOIN ({INCLUSIVE}) i ON e.code = i.ladcd"


@query("emissions_view", EMISSIONS_VIEW)
def emissions_view(spark, sf):
    return registry().build("emissions_vw", sources(spark, sf))


@query(
    "register_views",
    f"""SELECT 'inclusive_vw' AS view_name, count(*) AS row_count FROM ({INCLUSIVE})
    UNION ALL SELECT 'group_vw', count(*) FROM ({INCLUSIVE}) WHERE cauthnm = 'EUROPE'
    UNION ALL SELECT 'emissions_vw', count(*) FROM ({EMISSIONS_VIEW})""",
)
def register_views(spark, sf):
    """Register twice, then query the views by name."""
    views = registry()
    views.register(sources(spark, sf))
    names = views.register(sources(spark, sf))
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS view_name, count(*) AS row_count FROM {n}" for n in names))


@query(
    "view_lineage",
    f"""SELECT v.view_name, v.source_table, v.position, t.row_count FROM (VALUES ('inclusive_vw', 'lookup', 0), ('group_vw', 'lookup', 0),
    ('emissions_vw', 'emissions', 0), ('emissions_vw', 'lookup', 1)) v(view_name, source_table, position)
    JOIN (SELECT 'lookup' AS source_table, count(*) AS row_count FROM ({I.LOOKUP})
    UNION ALL SELECT 'emissions', count(*) FROM ({I.EMISSIONS})) t USING (source_table)""",
)
def view_lineage(spark, sf):
    """Base tables of each view with their sizes."""
    from datashelf.operators.stats import row_counts

    counts = row_counts(sources(spark, sf)).withColumnRenamed("table_name", "source_table")
    return registry().lineage(spark).join(counts, "source_table").select("view_name", "source_table", "position", "row_count")


# ---- certificates ----

# What the period texts of the test certificates stand for, in the order of ``inputs.AGE_BANDS``.
EXPECTED = [
    (1915, "1900 - 1930"), (1940, "1930 to present"), (1899, "Before 1900"), (2012, "1930 to present"), (1930, "1900 - 1930"),
    (1900, "1900 - 1930"), (2007, "1930 to present"), (None, "Unknown"),
]
BANDS = ", ".join(f"('{band}', {'NULL' if year is None else year}, '{epoch}')" for band, (year, epoch) in zip(I.AGE_BANDS, EXPECTED))
DATED = f"""SELECT c.*, CAST(b.y AS INTEGER) AS nominal_construction_year, coalesce(b.e, 'Unknown') AS construction_epoch
  FROM ({I.CERTIFICATES}) c LEFT JOIN (VALUES {BANDS}) b(band, y, e) ON c.age_band = b.band"""
TENURE = """CASE lower(tenure) WHEN 'owner-occupied' THEN 'Owner occupied' WHEN 'rented (social)' THEN 'Social rented'
  WHEN 'rental (social)' THEN 'Social rented' WHEN 'rental (private)' THEN 'Private rented' WHEN 'rented (private)' THEN 'Private rented' END"""


@query("age_band_year", f"SELECT cert_id, nominal_construction_year FROM ({DATED})")
def age_band_year(spark, sf):
    return I.certificates(spark, sf).select("cert_id", C.age_band_year(F.col("age_band")).alias("nominal_construction_year"))


@query("age_band_epoch", f"SELECT cert_id, construction_epoch FROM ({DATED})")
def age_band_epoch(spark, sf):
    years = I.certificates(spark, sf).withColumn("y", C.age_band_year(F.col("age_band")))
    return years.select("cert_id", C.age_band_epoch(F.col("y")).alias("construction_epoch"))


@query("tenure_clean", f"SELECT cert_id, {TENURE} AS tenure_clean FROM ({I.CERTIFICATES})")
def tenure_clean(spark, sf):
    return I.certificates(spark, sf).select("cert_id", C.tenure_clean(F.col("tenure")).alias("tenure_clean"))


@query(
    "certificates_view",
    f"""SELECT c.*, {TENURE} AS tenure_clean,
    CAST(year(lodged_at) AS INTEGER) AS lodgement_year, CAST(month(lodged_at) AS INTEGER) AS lodgement_month,
    CAST(day(lodged_at) AS INTEGER) AS lodgement_day FROM ({DATED}) c""",
)
def certificates_view(spark, sf):
    return C.with_certificate_columns(I.certificates(spark, sf), "age_band", "tenure", "lodged_at")


# ---- the thirteen curated views, on tables derived from the test tables ----

POINT_COLUMNS = {
    "LMK_KEY": ("cert_id", "cert_id"), "UPRN": ("address_id", "address_id"), "LOCAL_AUTHORITY": ("code", "code"),
    "CONSTRUCTION_AGE_BAND": ("age_band", "age_band"), "TENURE": ("tenure", "tenure"), "LODGEMENT_DATETIME": ("lodged_at", "lodged_at"),
}
REGION = {"ladcd": "S9999999", "ladnm": "Extra area", "cauthcd": "R3", "cauthnm": "EUROPE"}
SUPPLIERS = ["S0000001", "S0000002", "S0000005"]
WANTED = ", ".join(f"'{c}'" for c in [*I.AREA_CODES, *SUPPLIERS])


def _point_value(column: str) -> tuple[str, str]:
    """A certificate column as Spark and as DuckDB SQL; those with no source of their own tell their certificate."""
    return POINT_COLUMNS.get(column) or (f"concat('{column} ', cert_id)", f"'{column} ' || CAST(cert_id AS VARCHAR)")


def base_tables(spark, sf):
    certificates, lookup, emissions = I.certificates(spark, sf), I.lookup(spark, sf), I.emissions(spark, sf)
    suppliers = I.table(spark, sf, "supplier").select(I.code("S", "s_suppkey", 7).alias("area"))
    facts = emissions.select(F.col("code").alias("local_authority_code"), "year", "kt", *[F.lit(c).alias(c) for c in
                             ("country", "country_code", "region", "second_tier_authority")])
    return {
        "ca_la_lookup_tbl": lookup.toDF("LAD25CD", "LAD25NM", "CAUTH25CD", "CAUTH25NM"),
        "la_ghg_emissions_tbl": facts,
        "la_ghg_emissions_wide_tbl": facts.groupBy("local_authority_code").agg(F.sum("kt").alias("kt")),
        "raw_domestic_epc_certificates_tbl": certificates.select(
            *[F.expr(_point_value(c)[0]).alias(c) for c in CERTIFICATE_COLUMNS]
        ),
        "raw_non_domestic_epc_certificates_tbl": certificates.filter("cert_id % 5 = 0").select("cert_id", F.col("code").alias("LOCAL_AUTHORITY")),
        "boundary_lookup_tbl": suppliers.withColumnRenamed("area", "ladcd"),
        "postcode_centroids_tbl": I.points(spark, sf).join(
            I.table(spark, sf, "customer"), F.col("address_id") == F.col("c_custkey")
        ).select("address_id", I.code("N", "c_nationkey", 2).alias("lad25cd")),
        "iod2025_tbl": suppliers.withColumnRenamed("area", "la_cd"),
        "points_tbl": I.points(spark, sf).withColumnRenamed("address_id", "UPRN"),
    }


def curated(spark, sf):
    views = standard_views([*I.AREA_CODES, *SUPPLIERS], "EUROPE", REGION, "points_tbl")
    return views, base_tables(spark, sf)


def _count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS view_name, count(*) AS row_count FROM {source}"


IN_REGION = f"code IN ({WANTED})"
AREA = "SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS code FROM supplier"
CURATED = [
    _count("area_lookup_inclusive_vw", f"({INCLUSIVE})"),
    _count("region_areas_vw", f"({INCLUSIVE}) WHERE cauthnm = 'EUROPE'"),
    _count("ghg_emissions_sub_sector_vw", f"({I.EMISSIONS}) e JOIN ({INCLUSIVE}) i ON e.code = i.ladcd"),
    _count("domestic_certificates_vw", f"({I.CERTIFICATES})"),
    _count("domestic_certificates_points_vw", f"({I.CERTIFICATES}) WHERE {IN_REGION}"),
    _count("la_ghg_emissions_region_vw", f"({I.EMISSIONS}) WHERE {IN_REGION}"),
    _count("la_ghg_emissions_wide_region_vw", f"(SELECT DISTINCT code FROM ({I.EMISSIONS})) WHERE {IN_REGION}"),
    _count("raw_domestic_epc_certificates_region_vw", f"({I.CERTIFICATES}) WHERE {IN_REGION}"),
    _count("raw_non_domestic_epc_certificates_region_vw", f"({I.CERTIFICATES}) WHERE cert_id % 5 = 0 AND {IN_REGION}"),
    _count("boundary_lookup_region_vw", f"({AREA}) WHERE {IN_REGION}"),
    _count("postcode_centroids_region_vw", f"(SELECT 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code FROM customer) WHERE {IN_REGION}"),
    _count("iod2025_region_vw", f"({AREA}) WHERE {IN_REGION}"),
    _count("ca_la_lookup_region_vw", f"({I.LOOKUP}) WHERE {IN_REGION}"),
]


@query("curated_views", " UNION ALL ".join(CURATED))
def curated_views(spark, sf):
    """Rows of each of the thirteen views."""
    views, tables = curated(spark, sf)
    return row_counts(views.build_all(tables)).withColumnRenamed("table_name", "view_name")
