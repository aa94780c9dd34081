"""Golden tables of the scalar functions and projections."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from datashelf.functions import certificates as C
from datashelf.functions import crs
from datashelf.functions import scalars as S


def test_age_bands(spark):
    want = {
        "X: 1900-1929": (1915, "1900 - 1930"),
        "X: 1930-1949": (1940, "1930 to present"),
        "X: before 1900": (1899, "Before 1900"),
        "X: 2012 onwards": (2012, "1930 to present"),
        "1930": (1930, "1900 - 1930"),
        "1900": (1900, "1900 - 1930"),
        "2007": (2007, "1930 to present"),
        "NO DATA": (None, "Unknown"),
        "": (None, "Unknown"),
        None: (None, "Unknown"),
    }
    df = spark.createDataFrame([(b,) for b in want], "band string")
    df = df.withColumn("y", C.age_band_year(F.col("band"))).withColumn("e", C.age_band_epoch(F.col("y")))
    assert {r["band"]: (r["y"], r["e"]) for r in df.collect()} == want


def test_tenure(spark):
    want = {
        "Owner-occupied": "Owner occupied", "rented (social)": "Social rented", "Rental (social)": "Social rented",
        "rental (private)": "Private rented", "RENTED (private)": "Private rented", "unknown": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in want], "t string")
    assert {r["t"]: r["c"] for r in df.select("t", C.tenure_clean(F.col("t")).alias("c")).collect()} == want


def test_projection_worked_example(spark):
    """Public worked example of the projection step."""
    df = spark.createDataFrame([(651409.903, 313177.270)], "e double, n double")
    row = crs.projected_to_airy(df, "e", "n", "lat", "lon").select(F.degrees("lat"), F.degrees("lon")).first()
    assert row[0] == pytest.approx(52 + 39 / 60 + 27.2531 / 3600, abs=1e-8)
    assert row[1] == pytest.approx(1 + 43 / 60 + 4.5177 / 3600, abs=1e-8)


def test_point_text_axis_order(spark):
    df = spark.createDataFrame([(51.5, -0.00001)], "lat double, lon double")
    row = df.select(crs.point_text("lat", "lon").alias("a"), crs.point_text("lat", "lon", "xy").alias("b")).first()
    assert (row["a"], row["b"]) == ("{51.500000, -0.000010}", "{-0.000010, 51.500000}")


def test_names_and_text(spark):
    df = spark.createDataFrame([("a_region_vw", " "), ("a_vw", "t "), ("b_region_vw", None)], "n string, c string")
    got = df.select(S.swap_suffix(F.col("n"), "_region_vw", "_tbl"), S.title_or_name(F.col("c"), F.col("n")), S.blank(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("a_tbl", "a_region_vw", True), ("a_vw", "t", False), ("b_tbl", "b_region_vw", True)]


def test_spatial_types(spark):
    df = spark.createDataFrame([("WKB_BLOB",), ("geometry",), ("VARCHAR",)], "t string")
    assert [r[0] for r in df.select(S.is_spatial_type(F.col("t"))).collect()] == [True, True, False]


def test_epoch_parts_before_1970(spark):
    df = spark.createDataFrame([(datetime(1969, 12, 31, 23, 30),)], "ts timestamp_ntz")
    assert list(df.select(*[S.epoch_part(F.col("ts"), p) for p in S.PARTS]).first()) == [-1, -1, -1, -1]


def test_workers_need_no_copy_of_the_package(tmp_path):
    """A driver that alone has the library on its path, in a folder of its own."""
    import subprocess
    import sys
    from pathlib import Path

    script = tmp_path / "job.py"
    script.write_text(
        f"""import sys
sys.path.insert(0, {str(Path(__file__).parent.parent)!r})
from pyspark.sql import functions as F
from datashelf.functions.wkb import decode_wkb, encode_wkb, point_geometry
from datashelf.session import build_session
spark = build_session("alone", "local[1]", **{{"spark.ui.enabled": "false"}})
there = spark.range(1).mapInPandas(lambda it: (f.assign(id=int("datashelf" in sys.modules)) for f in it), "id long")
shape = decode_wkb(encode_wkb(point_geometry(F.lit(1.0), F.lit(2.0))))
print("ANSWER", there.first()[0], spark.range(1).select(shape.alias("s")).select("s.type").first()[0])
"""
    )
    env = {k: v for k, v in __import__("os").environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ANSWER 0 POINT" in out.stdout, out.stderr[-2000:]


def test_arrow_spelling_of_addresses():
    from datashelf.sources.files import arrow_uri

    assert arrow_uri("s3a://b/x.parquet") == "s3://b/x.parquet" and arrow_uri("file:/x") == "file:/x"
