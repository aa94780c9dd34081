"""View registry with declared lineage, and the standard set of curated views."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datashelf.functions.certificates import with_certificate_columns
from datashelf.functions.crs import point_text, to_wgs84
from datashelf.functions.wkb import with_point_xy
from datashelf.operators.rows import region_filter, union_by_name


@dataclass(frozen=True)
class View:
    """A named query over tables or earlier views."""

    name: str
    sources: tuple[str, ...]
    build: Callable[..., DataFrame]
    description: str = ""


class ViewRegistry:
    """Views in the order of their declaration; a view may use any earlier one."""

    def __init__(self) -> None:
        self._views: dict[str, View] = {}

    def add(self, name: str, sources: Sequence[str], build: Callable[..., DataFrame], description: str = "") -> None:
        self._views[name] = View(name, tuple(sources), build, description or name)

    def __iter__(self):
        return iter(self._views.values())

    def __len__(self) -> int:
        return len(self._views)

    def build(self, name: str, tables: dict[str, DataFrame]) -> DataFrame:
        view = self._views[name]
        inputs = [self.build(s, tables) if s in self._views else tables[s] for s in view.sources]
        return view.build(*inputs)

    def build_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {v.name: self.build(v.name, tables) for v in self}

    def register(self, tables: dict[str, DataFrame]) -> list[str]:
        """Create or replace a temporary view for every definition; running it again changes nothing."""
        for name, df in self.build_all(tables).items():
            df.createOrReplaceTempView(name)
        return list(self._views)

    def base_tables(self, name: str) -> list[str]:
        """Tables a view finally reads, through other views."""
        found: list[str] = []
        for source in self._views[name].sources:
            for table in self.base_tables(source) if source in self._views else [source]:
                if table not in found:
                    found.append(table)
        return found

    def lineage(self, spark: SparkSession) -> DataFrame:
        """(view_name, source_table): one row per view and base table, main table first in ``position``."""
        rows = [(v.name, t, i) for v in self for i, t in enumerate(self.base_tables(v.name))]
        return spark.createDataFrame(rows, "view_name string, source_table string, position int")

    def descriptions(self, spark: SparkSession) -> DataFrame:
        rows = [(v.name, v.description, (self.base_tables(v.name) or [None])[0]) for v in self]
        return spark.createDataFrame(rows, "name string, description string, source_table string")


# ---- building blocks ----


def inclusive_lookup(lookup: DataFrame, names: dict[str, str], extra: dict[str, str]) -> DataFrame:
    """Lookup columns renamed (``{old: new}``) with one further literal row; a row already there is not doubled."""
    base = lookup.select(*[F.col(old).alias(new) for old, new in names.items()])
    row = lookup.sparkSession.range(1).select(*[F.lit(v).alias(c) for c, v in extra.items()])
    return union_by_name(base, row)


def facts_with_lookup(facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, without: Sequence[str]) -> DataFrame:
    """Inner join of facts with a lookup, less some columns. The lookup is broadcast when Spark finds it small."""
    return facts.join(lookup, facts[fact_key] == lookup[lookup_key], "inner").drop(*without)


def certificates_at_points(
    certificates: DataFrame, points: DataFrame, key: str, columns: Sequence[str], code_column: str, codes: Sequence[str],
    shape: str = "shape",
) -> DataFrame:
    """Certificates of some areas with the text position of their address."""
    wanted = region_filter(certificates, code_column, codes).select(*columns)
    # Positions are worked out once per address that is asked for, not once per certificate.
    asked = points.select(key, shape).join(wanted.select(key).distinct(), key, "left_semi")
    placed = to_wgs84(with_point_xy(asked, shape, "__east", "__north"), "__east", "__north", "__lat", "__lon")
    located = placed.select(key, point_text("__lat", "__lon").alias("geo_point_2d"))
    return wanted.join(located, key, "inner").select(*columns, "geo_point_2d")


# Certificate columns of the point view.
CERTIFICATE_COLUMNS = [
    "LMK_KEY", "UPRN", "BUILDING_REFERENCE_NUMBER", "LOCAL_AUTHORITY", "LOCAL_AUTHORITY_LABEL", "PROPERTY_TYPE",
    "TRANSACTION_TYPE", "CONSTRUCTION_AGE_BAND", "TENURE", "WALLS_DESCRIPTION", "ROOF_DESCRIPTION",
    "WALLS_ENERGY_EFF", "ROOF_ENERGY_EFF", "MAINHEAT_DESCRIPTION", "MAINHEAT_ENERGY_EFF", "MAIN_FUEL",
    "SOLAR_WATER_HEATING_FLAG", "CURRENT_ENERGY_RATING", "POTENTIAL_ENERGY_RATING", "CURRENT_ENERGY_EFFICIENCY",
    "POTENTIAL_ENERGY_EFFICIENCY", "ENERGY_CONSUMPTION_CURRENT", "ENERGY_CONSUMPTION_POTENTIAL", "ENERGY_TARIFF",
    "CO2_EMISSIONS_CURRENT", "CO2_EMISSIONS_POTENTIAL", "CO2_EMISS_CURR_PER_FLOOR_AREA",
    "ENVIRONMENT_IMPACT_CURRENT", "ENVIRONMENT_IMPACT_POTENTIAL", "NUMBER_HABITABLE_ROOMS", "NUMBER_HEATED_ROOMS",
    "PHOTO_SUPPLY", "TOTAL_FLOOR_AREA", "BUILT_FORM", "LODGEMENT_DATETIME",
]
# Columns that the joined emissions view leaves out.
EMISSIONS_DROPPED = ["country", "country_code", "ladcd", "ladnm", "region", "second_tier_authority"]
# Area-filtered tables and the column that holds the area code.
AREA_TABLES = {
    "la_ghg_emissions_tbl": "local_authority_code",
    "la_ghg_emissions_wide_tbl": "local_authority_code",
    "raw_domestic_epc_certificates_tbl": "LOCAL_AUTHORITY",
    "raw_non_domestic_epc_certificates_tbl": "LOCAL_AUTHORITY",
    "boundary_lookup_tbl": "ladcd",
    "postcode_centroids_tbl": "lad25cd",
    "iod2025_tbl": "la_cd",
    "ca_la_lookup_tbl": "LAD25CD",
}


def standard_views(codes: Sequence[str], group_name: str, extra_member: dict[str, str], points_table: str) -> ViewRegistry:
    """The thirteen curated views for one region.

    ``codes`` are its area codes, ``group_name`` its name in the lookup, ``extra_member`` the area added to the lookup
    (keys ladcd, ladnm, cauthcd, cauthnm), ``points_table`` the table of address points.
    """
    views = ViewRegistry()
    names = {"LAD25CD": "ladcd", "LAD25NM": "ladnm", "CAUTH25CD": "cauthcd", "CAUTH25NM": "cauthnm"}
    views.add(
        "area_lookup_inclusive_vw", ["ca_la_lookup_tbl"],
        lambda lookup: inclusive_lookup(lookup, names, extra_member),
        "Area lookup including the additional member",
    )
    views.add(
        "region_areas_vw", ["area_lookup_inclusive_vw"],
        lambda lookup: lookup.filter(F.col("cauthnm") == group_name),
        "Areas of the region",
    )
    views.add(
        "ghg_emissions_sub_sector_vw", ["la_ghg_emissions_tbl", "area_lookup_inclusive_vw"],
        lambda facts, lookup: facts_with_lookup(facts, lookup, "local_authority_code", "ladcd", EMISSIONS_DROPPED),
        "GHG emissions by sub-sector with area lookup",
    )
    views.add(
        "domestic_certificates_vw", ["raw_domestic_epc_certificates_tbl"],
        lambda c: with_certificate_columns(c, "CONSTRUCTION_AGE_BAND", "TENURE", "LODGEMENT_DATETIME"),
        "Domestic certificates with derived fields",
    )
    views.add(
        "domestic_certificates_points_vw", ["domestic_certificates_vw", points_table],
        lambda c, p: certificates_at_points(c, p, "UPRN", CERTIFICATE_COLUMNS, "LOCAL_AUTHORITY", codes),
        "Domestic certificates of the region with positions",
    )
    for table, column in AREA_TABLES.items():
        views.add(
            table.removesuffix("_tbl") + "_region_vw", [table],
            lambda df, column=column: region_filter(df, column, codes),
            f"Region subset of {table}",
        )
    return views
