"""Derived columns of energy-certificate data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four spellings of a construction period, tried in this order.
YEAR_RANGE = r"(\d{4})-(\d{4})"
BEFORE_YEAR = r"before (\d{4})"
FROM_YEAR = r"(\d{4}) onwards"
ANY_YEAR = r"(\d{4})"

# Tenure spellings (lower case) and their labels.
TENURE_LABELS = {
    "owner-occupied": "Owner occupied",
    "rented (social)": "Social rented",
    "rental (social)": "Social rented",
    "rental (private)": "Private rented",
    "rented (private)": "Private rented",
}


def _year(band: Column, pattern: str, group: int = 1) -> Column:
    # NULL, not '', where the pattern is absent; what it finds is four digits, so the cast cannot fail.
    return F.nullif(F.regexp_extract(band, pattern, group), F.lit("")).cast("int")


def age_band_year(band: Column) -> Column:
    """Nominal construction year of a period text, or NULL."""
    middle = F.round((_year(band, YEAR_RANGE, 1) + _year(band, YEAR_RANGE, 2)) / F.lit(2.0)).cast("int")
    # The first hit in this order is the answer.
    return F.coalesce(middle, _year(band, BEFORE_YEAR) - 1, _year(band, FROM_YEAR), _year(band, ANY_YEAR))


def age_band_epoch(year: Column) -> Column:
    return (
        F.when(year.isNull(), "Unknown")
        .when(year < 1900, "Before 1900")
        .when(year > 1930, "1930 to present")
        .otherwise("1900 - 1930")
    )


def tenure_clean(tenure: Column) -> Column:
    pairs = [F.lit(x) for item in TENURE_LABELS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.lower(tenure))


def with_certificate_columns(df, band: str, tenure: str, lodged_at: str):
    """Base columns plus year, epoch, tenure and lodgement date parts."""
    return df.withColumn("nominal_construction_year", age_band_year(F.col(band))).select(
        "*",
        age_band_epoch(F.col("nominal_construction_year")).alias("construction_epoch"),
        tenure_clean(F.col(tenure)).alias("tenure_clean"),
        F.year(lodged_at).alias("lodgement_year"),
        F.month(lodged_at).alias("lodgement_month"),
        F.dayofmonth(lodged_at).alias("lodgement_day"),
    )
