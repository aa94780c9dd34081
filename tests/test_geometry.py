"""WKB, geometry functions and validity."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from datashelf.functions import geometry as G
from datashelf.functions import wkb
from datashelf.operators.validity import flag_valid, normalise_geometry


def ring(points):
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", *p) for p in points)


def polygon(*rings):
    return b"\x01\x03\0\0\0" + struct.pack("<I", len(rings)) + b"".join(map(ring, rings))


def multi(*polygons):
    return b"\x01\x06\0\0\0" + struct.pack("<I", len(polygons)) + b"".join(polygons)


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def circle(n, r=10.0):
    points = [(r * np.cos(2 * np.pi * i / n), r * np.sin(2 * np.pi * i / n)) for i in range(n)]
    return points + points[:1]


def diamond(x, y, r):
    return [(x, y - r), (x + r, y), (x, y + r), (x - r, y), (x, y - r)]


DIAMONDS = [diamond(2, 2, 1), diamond(4, 2, 1), diamond(4, 4, 1), diamond(2, 4, 1)]
TWISTED = circle(300)
TWISTED[10], TWISTED[150] = TWISTED[150], TWISTED[10]
SPIKY = [(p[0] * (1 if i % 2 else 0.05), p[1] * (1 if i % 2 else 0.05)) for i, p in enumerate(circle(1000)[:-1])]
SPIKY.append(SPIKY[0])

# name, WKB, valid, area (None: not compared)
CASES = [
    ("unit", polygon(box(0, 0, 1, 1)), True, 1.0),
    ("4x3", polygon(box(0, 0, 4, 3)), True, 12.0),
    ("hole", polygon(box(0, 0, 10, 10), box(2, 2, 2, 2)), True, 96.0),
    ("bow-tie", polygon([(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)]), False, 0.0),
    ("unclosed", polygon([(0, 0), (1, 0), (1, 1), (0, 1)]), False, None),
    ("two", multi(polygon(box(0, 0, 1, 1)), polygon(box(5, 5, 1, 1))), True, 2.0),
    ("overlap", multi(polygon(box(0, 0, 2, 2)), polygon(box(1, 1, 2, 2))), False, None),
    ("part in part", multi(polygon(box(0, 0, 9, 9)), polygon(box(1, 1, 2, 2))), False, None),
    ("part in hole", multi(polygon(box(0, 0, 10, 10), box(2, 2, 5, 5)), polygon(box(3, 3, 1, 1))), True, 76.0),
    ("hole outside", polygon(box(0, 0, 1, 1), box(5, 5, 1, 1)), False, None),
    ("hole in hole", polygon(box(0, 0, 9, 9), box(1, 1, 6, 6), box(2, 2, 1, 1)), False, None),
    ("shared edge", multi(polygon(box(0, 0, 1, 1)), polygon(box(1, 0, 1, 1))), False, None),
    ("shared corner", multi(polygon(box(0, 0, 1, 1)), polygon(box(1, 1, 1, 1))), True, 2.0),
    ("spike", polygon([(0, 0), (4, 0), (4, 4), (4, 0), (0, 4), (0, 0)]), False, None),
    ("repeated vertex", polygon([(0, 0), (1, 0), (1, 0), (1, 1), (0, 1), (0, 0)]), True, 1.0),
    ("not finite", polygon([(0, 0), (float("nan"), 0), (1, 1), (0, 0)]), False, None),
    ("holes in a ring", polygon(box(0, 0, 9, 9), *DIAMONDS), False, None),
    ("holes in a chain", polygon(box(0, 0, 9, 9), *DIAMONDS[:3]), True, None),
    ("two holes from side to side", polygon(box(0, 0, 8, 8), diamond(2, 4, 2), diamond(6, 4, 2)), False, None),
    ("two holes, one at the side", polygon(box(0, 0, 9, 8), diamond(2, 4, 2), diamond(6, 4, 2)), True, None),
    ("hole at the shell in three points", polygon(box(0, 0, 4, 4), diamond(2, 2, 2)[:3] + [(1, 2), (2, 0)]), False, None),
    ("holes that meet in one point of the shell", polygon(box(0, 0, 8, 8), [(0, 4), (3, 3), (3, 2), (0, 4)], [(0, 4), (3, 6), (3, 5), (0, 4)]), True, None),
    ("parts that touch twice", multi(polygon([(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (0, 0)]), polygon([(4, 0), (5, 2), (4, 4), (4.5, 2), (4, 0)])), True, None),
    ("circle", polygon(circle(300)), True, None),
    ("twisted circle", polygon(TWISTED), False, None),
    ("spiky", polygon(SPIKY), True, None),
    ("circle with hole", polygon(circle(500), circle(100, 3.0)), True, None),
    ("hole crosses circle", polygon(circle(500), [(x + 9, y) for x, y in circle(100, 3.0)]), False, None),
    ("point", struct.pack("<bIdd", 1, 1, 3.25, -4.5), True, 0.0),
    ("nothing", None, None, None),
]


@pytest.fixture(scope="module")
def cases(spark):
    df = spark.createDataFrame(CASES, "name string, shape binary, valid boolean, area double")
    return df.withColumn("blob", F.col("shape")).withColumn("shape", wkb.decode_wkb(F.col("shape"))).cache()


@pytest.mark.parametrize("in_row", [128, 0])
def test_validity(cases, in_row):
    """With 0 every polygon takes the way of the large ones."""
    got = {r["name"]: r["geom_valid"] for r in flag_valid(cases, "shape", ["name"], in_row=in_row).collect()}
    assert got == {name: valid for name, _, valid, _ in CASES}


def test_validity_against_brute_force(spark):
    """Random rings: valid exactly when no two segments meet but neighbours at their corner."""
    rng = random.Random(7)
    rings = []
    for i in range(300):
        n = rng.randint(3, 9)
        points = [(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(n)]
        rings.append((i, points + points[:1]))

    def turn(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def on(p, a, b):
        return turn(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])

    def simple(points):
        kept = [p for i, p in enumerate(points) if i == 0 or p != points[i - 1]]
        if len(kept) < 4:
            return False
        segments = list(zip(kept[:-1], kept[1:]))
        for i, (a, b) in enumerate(segments):
            for j in range(i + 1, len(segments)):
                c, d = segments[j]
                if j == i + 1 or (i == 0 and j == len(segments) - 1):
                    far_c, far_a = (d, a) if j == i + 1 else (c, b)
                    if on(far_c, a, b) or on(far_a, c, d):
                        return False
                    continue
                crossing = turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0
                if crossing or on(c, a, b) or on(d, a, b) or on(a, c, d) or on(b, c, d):
                    return False
        return True

    df = spark.createDataFrame([(i, polygon(r)) for i, r in rings], "id int, shape binary")
    df = df.withColumn("shape", wkb.decode_wkb(F.col("shape"))).cache()
    want = {i: simple(r) for i, r in rings}
    assert 20 < sum(want.values()) < 290
    for in_row in (128, 0):
        assert {r["id"]: r["geom_valid"] for r in flag_valid(df, "shape", ["id"], in_row=in_row).collect()} == want


def test_area_and_round_trip(cases):
    got = cases.select("name", G.area(F.col("shape")).alias("a"), (wkb.encode_wkb(F.col("shape")) == F.col("blob")).alias("same")).collect()
    by_name = {r["name"]: r for r in got}
    for name, blob, _, area in CASES:
        if area is not None:
            assert by_name[name]["a"] == area, name
        if blob is not None:
            assert by_name[name]["same"], name


def test_multi_keeps_area_and_extent(cases):
    df = cases.filter("name IN ('unit', 'hole', 'two', 'point', 'nothing')")
    multi_shape = G.to_multi(F.col("shape"))
    rows = df.select(
        "name", multi_shape["type"].alias("t"), (G.area(multi_shape).eqNullSafe(G.area(F.col("shape")))).alias("area_same"),
        (G.envelope(multi_shape) == G.envelope(F.col("shape"))).alias("box_same"),
    ).collect()
    types = {r["name"]: r["t"] for r in rows}
    assert types == {"unit": "MULTIPOLYGON", "hole": "MULTIPOLYGON", "two": "MULTIPOLYGON", "point": "MULTIPOINT", "nothing": None}
    assert all(r["area_same"] for r in rows)


def test_points_in_the_jvm(spark):
    values = [651409.903, 0.1, -1e-300, 1e300, 5e-324, 0.0, 1 / 3, 2.0**53 - 1, float("inf"), 123456.789]
    rows = []
    for v in values:
        rows += [(v, struct.pack("<bIdd", 1, 1, v, -v)), (v, struct.pack(">bIdd", 0, 1, v, -v))]
        rows += [(v, struct.pack("<bIIdd", 1, 1 | 0x20000000, 27700, v, -v)), (v, struct.pack("<bIddd", 1, 1001, v, -v, 9.0))]
    df = spark.createDataFrame([*rows, (None, None)], "v double, b binary")
    got = wkb.with_point_xy(df, "b").collect()
    assert all(r["x"] == r["v"] and (r["v"] is None or r["y"] == -r["v"]) for r in got)
    decoded = df.select("v", wkb.decode_wkb(F.col("b")).alias("g")).select("v", G.point_x(F.col("g")).alias("x"), "g.type").collect()
    assert all(r["x"] == r["v"] for r in decoded)
    assert {r["type"] for r in decoded} == {"POINT", None}


def test_malformed_wkb_raises(spark):
    df = spark.createDataFrame([(polygon(box(0, 0, 1, 1))[:-3],)], "b binary")
    with pytest.raises(Exception, match="malformed WKB"):
        df.select(wkb.decode_wkb(F.col("b"))).collect()
    with pytest.raises(Exception, match="not a WKB point"):
        wkb.with_point_xy(df, "b").collect()


def test_extent_and_rules(spark):
    df = spark.createDataFrame([(1, polygon(box(0, 0, 2, 3))), (2, polygon(box(5, -1, 1, 1))), (3, None)], "id int, shape binary")
    out = normalise_geometry(df, "shape", "multi")
    assert list(G.bbox(out, "shape").first()) == [0.0, -1.0, 6.0, 3.0]
    flagged = normalise_geometry(df, "shape", "decode+flag", ["id"])
    assert flagged.columns == ["id", "shape", "geom_valid"]
    assert {r["id"]: r["geom_valid"] for r in flagged.collect()} == {1: True, 2: True, 3: None}
    with pytest.raises(ValueError):
        normalise_geometry(df, "shape", "other")


def test_published_bytes_keep_z_and_srid(spark, shelf):
    """Z, M, SRID and collections come back as they were stored; a multi header goes before single ones."""
    import struct

    from datashelf.functions.wkb import multi_wkb, wkb_type
    from datashelf.plans.quality import geometry_expectations
    from datashelf.plans.refresh import Spatial, WrongGeometryType, publish_spatial

    line_z = struct.pack("<BIIdddddd", 1, 1002, 2, 0, 0, 5, 1, 1, 6)
    ewkb = struct.pack("<BIIIdddddd", 1, 0x80000002 | 0x20000000, 27700, 2, 0, 0, 5, 1, 1, 6)
    big = struct.pack(">BIdd", 0, 1, 3, 4)
    collection = struct.pack("<BII", 1, 7, 1) + struct.pack("<BIdd", 1, 1, 3, 4)
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate((line_z, ewkb, big, collection))], "id int, shape binary")
    publish_spatial(shelf, df, "mixed", Spatial("shape", "GEOMETRY", "EPSG:27700"))
    assert [bytes(r["shape"]) for r in shelf.read("mixed").orderBy("id").collect()] == [line_z, ewkb, big, collection]
    multi = df.select("id", multi_wkb(F.col("shape")).alias("m")).withColumn("t", wkb_type(F.col("m"))).orderBy("id").collect()
    assert [r["t"] for r in multi] == ["MULTILINESTRING", "MULTILINESTRING", "MULTIPOINT", "GEOMETRYCOLLECTION"]
    assert bytes(multi[0]["m"]) == struct.pack("<BII", 1, 1005, 1) + line_z
    assert bytes(multi[1]["m"]) == struct.pack("<BIII", 1, 0x80000005 | 0x20000000, 27700, 1) + ewkb
    assert bytes(multi[2]["m"]) == struct.pack(">BII", 0, 4, 1) + big
    decoded = df.filter("id < 3").select(wkb.decode_wkb(multi_wkb(F.col("shape"))).alias("s"), wkb.decode_wkb(F.col("shape")).alias("o"))
    assert all(r["s"]["parts"] == r["o"]["parts"] for r in decoded.collect())
    with pytest.raises(WrongGeometryType):
        publish_spatial(shelf, df, "lines", Spatial("shape", "LINESTRING", "EPSG:27700"))
    checks = geometry_expectations(df.filter("id < 2"), "shape", geometry_type="LINESTRING", min_rows=3)
    assert [(r["check"], r["passed"]) for r in checks.collect()] == [("rows", False), ("single type", True)]


def test_boxes_within():
    from datashelf.functions.ringcheck import boxes_within

    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 50, 300):
        low = rng.integers(0, 30, (n, 2)).astype(float)
        high = low + rng.integers(0, 12, (n, 2))
        low[: n // 10], high[: n // 10] = -1e6, 1e6  # a few that hold all others, far off
        want = {(i, o) for i in range(n) for o in range(n) if i != o and (low[i] >= low[o]).all() and (high[i] <= high[o]).all()}
        inner, outer = boxes_within(low, high)
        assert set(zip(inner.tolist(), outer.tolist())) == want and len(inner) == len(want)


def test_many_parts_are_nested_fast():
    import time

    import pyarrow as pa

    from datashelf.functions.ringcheck import VALID, row_status

    n = 16_000
    vertex = lambda x, y: {"x": float(x), "y": float(y)}
    parts = [[[vertex(x, y), vertex(x + 1, y), vertex(x + 1, y + 1), vertex(x, y + 1), vertex(x, y)]]
             for x, y in ((2 * (i % 130), 2 * (i // 130)) for i in range(n))]
    parts.append([[vertex(1e7 + x, y) for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))]])
    shapes = pa.array([{"type": "MULTIPOLYGON", "parts": parts}], pa.struct([("type", pa.string()), ("parts", pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))))]))
    started = time.process_time()
    assert row_status(shapes, 10**9 if n < 1 else 0).to_pylist() in ([2], [VALID])
    assert time.process_time() - started < 2


def test_two_checks_of_interiors_have_small_plans(spark, tmp_path):
    """The second check does not carry the plan of the first one for each time that it reads its input."""
    from shelf_queries.geo import geo_interior

    keys = [*range(12), 5, 2**40 + 3]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    both = geo_interior(spark, str(tmp_path))
    assert both._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 4
    assert sorted(map(tuple, both.collect())) == sorted((k, k % 4, k % 4 < 3, k % 4 < 3) for k in keys)


def test_few_and_many_rings_agree(spark, monkeypatch):
    """Boxes of few rings are compared each with each, those of many rings by columns."""
    from datashelf.functions import ringcheck

    rng = random.Random(3)
    blobs = [polygon(box(0, 0, 20, 20), *(box(rng.randint(0, 18), rng.randint(0, 18), rng.randint(1, 3), 1) for _ in range(rng.randint(1, 4)))) for _ in range(300)]
    blobs += [blob for _, blob, _, _ in CASES if blob is not None]
    shapes = spark.createDataFrame([(b,) for b in blobs], "b binary").select(wkb.decode_wkb(F.col("b")).alias("shape")).toArrow()["shape"].combine_chunks()
    few = ringcheck.row_status(shapes, 10**6).to_pylist()
    monkeypatch.setattr(ringcheck, "FEW_RINGS", 0)
    assert ringcheck.row_status(shapes, 10**6).to_pylist() == few and 20 < sum(few) < len(few) - 20
