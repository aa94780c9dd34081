"""Geometry queries. The SQL side computes from the formulas that generate the inputs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from datashelf.functions import crs, geometry as G, wkb
from datashelf.operators.validity import flag_valid, may_be_large, normalise_geometry
from datashelf.plans.refresh import Spatial, geometry_types, publish_spatial, read_geo
from datashelf.plans.views import certificates_at_points
from datashelf.session import fresh_folder
from datashelf.sources.shelf import Shelf
from shelf_queries import inputs as I
from datashelf.plans.views import CERTIFICATE_COLUMNS
from shelf_queries.curated import CODES, IN_REGION, _point_value, curated
from shelf_queries.registry import query


def _terms(coefficients, pattern: str) -> str:
    return " ".join(pattern.format(c=f"({c!r})", k=2 * (i + 1)) for i, c in enumerate(coefficients))


def _transform_sql() -> str:
    """Inverse projection and datum shift of POINTS, step by step."""
    e2 = 1 - (crs.AIRY_B / crs.AIRY_A) ** 2
    m = 1 + crs.SHIFT_SCALE * 1e-6
    rx, ry, rz = (math.radians(t / 3600) for t in (crs.TURN_X, crs.TURN_Y, crs.TURN_Z))
    b, w2 = crs.WGS_A * (1 - crs.WGS_F), crs.WGS_F * (2 - crs.WGS_F)
    second = w2 / (1 - w2)
    scale = crs.SCALE_0 * crs.RADIUS
    xi = "xi " + _terms(crs.TO_SPHERE, "- {c}::DOUBLE * sin({k} * xi) * cosh({k} * eta)")
    eta = "eta " + _terms(crs.TO_SPHERE, "- {c}::DOUBLE * cos({k} * xi) * sinh({k} * eta)")
    lat = "chi " + _terms(crs.TO_GEODETIC, "+ {c}::DOUBLE * sin({k} * chi)")
    return f"""WITH s0 AS ({I.POINTS}),
  s1 AS (SELECT *, (northing - ({crs.NORTH_0!r})::DOUBLE) / {scale!r}::DOUBLE + {crs.XI_0!r}::DOUBLE AS xi,
    (easting - {crs.EAST_0!r}::DOUBLE) / {scale!r}::DOUBLE AS eta FROM s0),
  s2 AS (SELECT *, {xi} AS xs, {eta} AS es FROM s1),
  s3 AS (SELECT *, asin(sin(xs) / cosh(es)) AS chi FROM s2),
  s4 AS (SELECT *, {lat} AS lat, atan2(sinh(es), cos(xs)) + ({crs.LON_0!r})::DOUBLE AS lon FROM s3),
  s5 AS (SELECT *, {crs.AIRY_A!r}::DOUBLE / sqrt(1 - {e2!r}::DOUBLE * sin(lat) * sin(lat)) AS v FROM s4),
  s6 AS (SELECT *, v * cos(lat) * cos(lon) AS x0, v * cos(lat) * sin(lon) AS y0, v * (1 - {e2!r}::DOUBLE) * sin(lat) AS z0 FROM s5),
  s7 AS (SELECT *, {crs.SHIFT_X!r}::DOUBLE + {m!r}::DOUBLE * (x0 - {rz!r}::DOUBLE * y0 + {ry!r}::DOUBLE * z0) AS x,
    ({crs.SHIFT_Y!r})::DOUBLE + {m!r}::DOUBLE * ({rz!r}::DOUBLE * x0 + y0 - {rx!r}::DOUBLE * z0) AS y,
    {crs.SHIFT_Z!r}::DOUBLE + {m!r}::DOUBLE * (({-ry!r})::DOUBLE * x0 + {rx!r}::DOUBLE * y0 + z0) AS z FROM s6),
  s8 AS (SELECT *, sqrt(x * x + y * y) AS p FROM s7),
  s9 AS (SELECT *, atan2(z * {crs.WGS_A!r}::DOUBLE, p * {b!r}::DOUBLE) AS t FROM s8),
  placed AS (SELECT address_id, round(degrees(atan2(z + {second!r}::DOUBLE * {b!r}::DOUBLE * pow(sin(t), 3),
    p - {w2!r}::DOUBLE * {crs.WGS_A!r}::DOUBLE * pow(cos(t), 3))), 6) AS latitude, round(degrees(atan2(y, x)), 6) AS longitude FROM s9)"""


PLACED = _transform_sql()
TEXT = "'{' || CAST(CAST(latitude AS DECIMAL(20,6)) AS VARCHAR) || ', ' || CAST(CAST(longitude AS DECIMAL(20,6)) AS VARCHAR) || '}'"


@query("geo_wkb_point", f"SELECT address_id, easting AS x, northing AS y FROM ({I.POINTS})")
def geo_wkb_point(spark, sf):
    return wkb.with_point_xy(I.points(spark, sf), "shape").select("address_id", "x", "y")


@query("geo_transform", f"{PLACED} SELECT * FROM placed")
def geo_transform(spark, sf):
    decoded = wkb.with_point_xy(I.points(spark, sf), "shape", "east", "north")
    return crs.to_wgs84(decoded, "east", "north").select(
        "address_id", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude")
    )


@query("geo_point_text", f"{PLACED} SELECT address_id, {TEXT} AS geo_point_2d FROM placed")
def geo_point_text(spark, sf):
    decoded = wkb.with_point_xy(I.points(spark, sf), "shape", "east", "north")
    return crs.to_wgs84(decoded, "east", "north").select("address_id", crs.point_text("latitude", "longitude").alias("geo_point_2d"))


@query(
    "geo_join_points",
    f"""{PLACED} SELECT c.cert_id, c.address_id, c.code, c.tenure, {TEXT} AS geo_point_2d
    FROM ({I.CERTIFICATES}) c JOIN placed USING (address_id) WHERE c.code IN ({CODES})""",
)
def geo_join_points(spark, sf):
    return certificates_at_points(
        I.certificates(spark, sf), I.points(spark, sf), "address_id", ["cert_id", "address_id", "code", "tenure"], "code", I.AREA_CODES
    )


@query(
    "curated_points_view",
    f"""{PLACED} SELECT {", ".join(f"{_point_value(c)[1]} AS {c}" for c in CERTIFICATE_COLUMNS)}, {TEXT} AS geo_point_2d
    FROM ({I.CERTIFICATES}) c JOIN placed USING (address_id) WHERE {IN_REGION}""",
)
def curated_points_view(spark, sf):
    """The whole point view of the curated set: all its certificate columns and the position."""
    views, tables = curated(spark, sf)
    return views.build("domestic_certificates_points_vw", tables)


@query(
    "geo_bbox",
    f"""SELECT min(easting) AS bbox_xmin, min(northing) AS bbox_ymin, max(easting) AS bbox_xmax, max(northing) AS bbox_ymax
    FROM ({I.POINTS})""",
)
def geo_bbox(spark, sf):
    decoded = wkb.with_point_xy(I.points(spark, sf), "shape")
    return G.bbox(decoded.select(wkb.point_geometry(F.col("x"), F.col("y")).alias("shape")), "shape")


def stored_areas(spark, sf):
    """The areas as a table of WKB, the form in which geometry is kept."""
    return stored(spark, I.areas(spark, sf), "areas")


def stored(spark, df, label):
    folder = fresh_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def shapes(spark, sf):
    return I.areas(spark, sf).withColumn("shape", wkb.decode_wkb(F.col("shape")))


N_PARTS = "CASE WHEN twice THEN 2 ELSE 1 END"


@query(
    "geo_wkb_polygon",
    f"""SELECT area_id, CASE WHEN twice THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS type, {N_PARTS} AS n_parts,
    5 * ({N_PARTS} + CASE WHEN hole THEN 1 ELSE 0 END) AS n_vertices, CAST(x AS DOUBLE) AS xmin,
    CAST(x + w + CASE WHEN twice THEN w + 10 ELSE 0 END AS DOUBLE) AS xmax, CAST(y AS DOUBLE) AS ymin, CAST(y + h AS DOUBLE) AS ymax
    FROM ({I.AREAS})""",
)
def geo_wkb_polygon(spark, sf):
    shape = F.col("shape")
    boxed = shapes(spark, sf).withColumn("box", G.envelope(shape))
    return boxed.select(
        "area_id", G.geometry_type(shape).alias("type"), F.size(shape["parts"]).alias("n_parts"),
        F.size(G.vertices(shape)).alias("n_vertices"), "box.xmin", "box.xmax", "box.ymin", "box.ymax",
    )


@query("geo_multi", f"SELECT area_id, 'MULTIPOLYGON' AS type, {N_PARTS} AS n_parts FROM ({I.AREAS})")
def geo_multi(spark, sf):
    multi = shapes(spark, sf).withColumn("shape", G.to_multi(F.col("shape")))
    return multi.select("area_id", "shape.type", F.size("shape.parts").alias("n_parts"))


@query("geo_is_valid", f"SELECT area_id, NOT bow AS geom_valid FROM ({I.AREAS})")
def geo_is_valid(spark, sf):
    stored = stored_areas(spark, sf).withColumn("long", may_be_large(F.col("shape")))
    decoded = stored.withColumn("shape", wkb.decode_wkb(F.col("shape")))
    return flag_valid(decoded, "shape", ["area_id"], large_hint=F.col("long")).select("area_id", "geom_valid")


@query("geo_interior", "SELECT c_custkey AS area_id, c_custkey % 4 AS touches, c_custkey % 4 < 3 AS valid_in_row, c_custkey % 4 < 3 AS valid_joined FROM customer")
def geo_interior(spark, sf):
    """Areas with two holes that touch nothing, each other, the left side too, or both sides, which cuts them apart;
    checked within rows and by the join of segments."""
    keys = I.table(spark, sf, "customer").select("c_custkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = keys.selectExpr(
        "c_custkey AS area_id", "c_custkey % 4 AS touches", "300000 + (c_custkey * 37) % 30000 AS x",
        "150000 + (c_custkey * 91) % 30000 AS y", "100 + c_custkey % 50 * 10 AS w", "50 + c_custkey % 50 * 5 AS h",
    )
    corner = "named_struct('x', CAST({} AS DOUBLE), 'y', CAST({} AS DOUBLE))"
    hole = "array({})".format(
        ", ".join(corner.format(*c) for c in [("{0}", "y + h / 2"), ("({0} + {1}) / 2", "y + h / 4"), ("{1}", "y + h / 2"),
                                              ("({0} + {1}) / 2", "y + h * 3 / 4"), ("{0}", "y + h / 2")])
    )
    shell = "array({})".format(", ".join(corner.format(*c) for c in [("x", "y"), ("x + w", "y"), ("x + w", "y + h"), ("x", "y + h"), ("x", "y")]))
    left = hole.format("IF(touches >= 2, x, x + 1)", "(x + w / 2)")
    right = hole.format("IF(touches >= 1, x + w / 2, x + w / 2 + 1)", "IF(touches = 3, x + w, x + w - 1)")
    shaped = placed.selectExpr("area_id", "touches", f"named_struct('type', 'POLYGON', 'parts', array(array({shell}, {left}, {right}))) AS shape")
    # A check reads its input several times, so each gets it stored: the plans stay apart and small.
    here = stored(spark, flag_valid(stored(spark, shaped, "interiors"), "shape", ["area_id"], flag="valid_in_row"), "interiors")
    both = flag_valid(here, "shape", ["area_id"], flag="valid_joined", in_row=8)
    return both.select("area_id", "touches", "valid_in_row", "valid_joined")


@query("geo_type_count", f"SELECT CASE WHEN twice THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS geometry_type, count(*) AS n FROM ({I.AREAS}) GROUP BY 1")
def geo_type_count(spark, sf):
    """From the WKB header alone; nothing is decoded."""
    return I.areas(spark, sf).groupBy(wkb.wkb_type(F.col("shape")).alias("geometry_type")).agg(F.count(F.lit(1)).alias("n"))


AREA = "CASE WHEN bow THEN 0.0 ELSE w * h * (CASE WHEN twice THEN 2 ELSE 1 END) - CASE WHEN hole THEN w * h / 4.0 ELSE 0 END END"


@query("geo_area", f"SELECT area_id, CAST({AREA} AS DOUBLE) AS area FROM ({I.AREAS})")
def geo_area(spark, sf):
    return shapes(spark, sf).select("area_id", G.area(F.col("shape")).alias("area"))


@query(
    "geo_normalise",
    f"""SELECT area_id, 'decode+flag' AS rule, CASE WHEN twice THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS type, NOT bow AS geom_valid FROM ({I.AREAS})
    UNION ALL SELECT area_id, 'multi', 'MULTIPOLYGON', NULL FROM ({I.AREAS})
    UNION ALL SELECT area_id, 'decode', CASE WHEN twice THEN 'MULTIPOLYGON' ELSE 'POLYGON' END, NULL FROM ({I.AREAS})""",
)
def geo_normalise(spark, sf):
    """The three copy rules on the same table."""
    source = stored_areas(spark, sf)
    frames = []
    for rule in ("decode+flag", "multi", "decode"):
        out = normalise_geometry(source, "shape", rule, ["area_id"])
        valid = F.col("geom_valid") if rule == "decode+flag" else F.lit(None).cast("boolean")
        frames.append(out.select("area_id", F.lit(rule).alias("rule"), "shape.type", valid.alias("geom_valid")))
    return frames[0].unionAll(frames[1]).unionAll(frames[2])


def _published_areas(spark, sf) -> Shelf:
    shelf = Shelf(spark, fresh_folder(spark, "shelf"))
    rule = Spatial("shape", "MULTIPOLYGON", "EPSG:27700", "multi")
    publish_spatial(shelf, I.areas(spark, sf), "areas", rule, title="Areas", comments={"shape": "Outline"})
    return shelf


@query("geo_read_crs", f"SELECT area_id, 'EPSG:27700' AS crs, CAST({AREA} AS DOUBLE) AS area FROM ({I.AREAS})")
def geo_read_crs(spark, sf):
    df = read_geo(_published_areas(spark, sf), "areas")
    return df.select("area_id", F.lit(crs.crs_of(df, "shape")).alias("crs"), G.area(F.col("shape")).alias("area"))


@query(
    "geo_publish",
    f"""SELECT 'areas' AS name, 'true' AS spatial, 'shape' AS geometry_column, 'MULTIPOLYGON' AS geometry_type, 'EPSG:27700' AS crs,
    (SELECT count(*) FROM ({I.AREAS})) AS row_count, (SELECT count(*) FROM ({I.AREAS})) AS n_of_type""",
)
def geo_publish(spark, sf):
    """Publish, then report the spatial metadata and the geometry types that were read back."""
    shelf = _published_areas(spark, sf)
    found = geometry_types(read_geo(shelf, "areas"), "shape").select("geometry_type", F.col("n").alias("n_of_type"))
    keys = [F.try_element_at("user", F.lit(k)).alias(k) for k in ("spatial", "geometry_column", "geometry_type", "crs")]
    return shelf.meta("areas").select("name", *keys, "row_count").join(found, "geometry_type")
