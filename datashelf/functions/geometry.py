"""Operations on geometries in the working form (see ``functions.wkb``), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Single types and what promotion makes of them.
MULTI_TYPES = {"POINT": "MULTIPOINT", "LINESTRING": "MULTILINESTRING", "POLYGON": "MULTIPOLYGON"}


def geometry_type(shape: Column) -> Column:
    return shape["type"]


def to_multi(shape: Column) -> Column:
    """Single geometry to its multi form; multi geometries stay."""
    kind = shape["type"]
    multi = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in MULTI_TYPES.items() for v in kv]), kind), kind)
    return F.when(shape.isNotNull(), F.struct(multi.alias("type"), shape["parts"].alias("parts")))


def point_x(shape: Column) -> Column:
    return F.when(shape["type"] == "POINT", F.get(F.get(F.get(shape["parts"], F.lit(0)), F.lit(0)), F.lit(0))["x"])


def point_y(shape: Column) -> Column:
    return F.when(shape["type"] == "POINT", F.get(F.get(F.get(shape["parts"], F.lit(0)), F.lit(0)), F.lit(0))["y"])


def vertices(shape: Column) -> Column:
    return F.flatten(F.flatten(shape["parts"]))


def envelope(shape: Column) -> Column:
    """``struct<xmin,ymin,xmax,ymax>``; all NULL for an empty geometry."""
    xs, ys = F.transform(vertices(shape), lambda v: v["x"]), F.transform(vertices(shape), lambda v: v["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"),
    )


def edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a ring: ``array<struct<a,b>>``."""
    n = F.size(ring) - 1
    heads, tails = F.slice(ring, F.lit(1), F.greatest(n, F.lit(0))), F.slice(ring, F.lit(2), F.greatest(n, F.lit(0)))
    return F.zip_with(heads, tails, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def ring_area(ring: Column) -> Column:
    """Unsigned area. Coordinates are taken relative to the first vertex, which keeps far-away rings exact."""
    ox, oy = ring[0]["x"], ring[0]["y"]
    doubled = F.aggregate(
        edges(ring),
        F.lit(0.0),
        lambda total, e: total
        + (e["a"]["x"] - ox) * (e["b"]["y"] - oy) - (e["b"]["x"] - ox) * (e["a"]["y"] - oy),
    )
    return F.abs(doubled) / 2


def area(shape: Column) -> Column:
    """Planar area in squared map units: shells minus holes. Zero for points and lines, NULL for collections."""
    one_part = lambda part: F.aggregate(
        F.slice(part, F.lit(2), F.greatest(F.size(part) - 1, F.lit(0))),
        F.when(F.size(part) > 0, ring_area(part[0])).otherwise(F.lit(0.0)),
        lambda total, hole: total - ring_area(hole),
    )
    total = F.aggregate(F.transform(shape["parts"], one_part), F.lit(0.0), lambda a, b: a + b)
    return (
        F.when(shape["type"].isin("POLYGON", "MULTIPOLYGON"), total)
        .when(shape["type"] == "GEOMETRYCOLLECTION", F.lit(None))
        .when(shape.isNotNull(), F.lit(0.0))
    )


def bbox(df: DataFrame, shape: str, *keys: str) -> DataFrame:
    """Extent of all geometries (per key): bbox_xmin, bbox_ymin, bbox_xmax, bbox_ymax. Partially aggregated."""
    boxes = df.select(*keys, envelope(F.col(shape)).alias("box"))
    return boxes.groupBy(*keys).agg(
        F.min("box.xmin").alias("bbox_xmin"), F.min("box.ymin").alias("bbox_ymin"),
        F.max("box.xmax").alias("bbox_xmax"), F.max("box.ymax").alias("bbox_ymax"),
    )
