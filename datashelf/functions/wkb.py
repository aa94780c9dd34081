"""Well-known binary: decoding points with Column arithmetic, everything else with an Arrow-batched function."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Working form of a geometry: part -> ring -> vertex; ring 0 of a part is its shell. A point is one part with
# one ring with one vertex; a line is one part with one ring.
VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOMETRY = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("parts", T.ArrayType(T.ArrayType(T.ArrayType(VERTEX)))),
    ]
)

# Geometry type codes.
TYPE_NAMES = {
    1: "POINT",
    2: "LINESTRING",
    3: "POLYGON",
    4: "MULTIPOINT",
    5: "MULTILINESTRING",
    6: "MULTIPOLYGON",
    7: "GEOMETRYCOLLECTION",
}
TYPE_CODES = {name: code for code, name in TYPE_NAMES.items()}
EWKB_Z, EWKB_M, EWKB_SRID = 0x80000000, 0x40000000, 0x20000000


# ---- header and points, inside the JVM ----


def _turned(hex_text: Column) -> Column:
    """Bytes of a hex text in reverse order."""
    pairs = F.transform(F.sequence(F.length(hex_text) - 1, F.lit(1), F.lit(-2)), lambda i: F.substring(hex_text, i, F.lit(2)))
    return F.array_join(pairs, "")


def _unsigned(hex_text: Column) -> Column:
    return F.conv(hex_text, 16, 10).cast("long")


def _type_word(wkb: Column) -> Column:
    word = F.hex(F.substring(wkb, 2, 4))
    return _unsigned(F.when(F.hex(F.substring(wkb, 1, 1)) == "01", _turned(word)).otherwise(word))


def wkb_type(wkb: Column) -> Column:
    """Geometry type name from the header alone."""
    code = _type_word(wkb).bitwiseAND(F.lit(0x0FFFFFFF)) % 1000
    names = F.create_map(*[F.lit(v) for item in TYPE_NAMES.items() for v in item])
    return F.try_element_at(names, code.cast("int"))


def with_point_xy(df: DataFrame, wkb: str, x: str = "x", y: str = "y") -> DataFrame:
    """Add the coordinates of WKB points: both byte orders, with or without SRID, Z and M.

    NULL on NULL; anything but a whole point raises. Sign, exponent and mantissa of a double are exact as doubles, so
    the values are the stored ones. Each step is its own projection and is computed once per row.
    """
    blob = F.col(wkb)
    skip = F.when(F.col("__type").bitwiseAND(F.lit(EWKB_SRID)) != 0, 9).otherwise(5)
    is_point = (F.col("__type").bitwiseAND(F.lit(0x0FFFFFFF)) % 1000 == 1) & (F.octet_length(blob) >= F.col("__skip") + 16)
    problem = F.raise_error(F.lit("not a WKB point")).cast("string")
    start = 2 * F.col("__skip") + 1
    little = F.substring("__hex", 1, 2) == "01"

    def bits(axis: int) -> Column:
        raw = F.substring(F.col("__hex"), start + 16 * axis, F.lit(16))
        swapped = F.concat(*[F.substring(F.col("__hex"), start + 16 * axis + 2 * i, F.lit(2)) for i in reversed(range(8))])
        return F.when(little, swapped).otherwise(raw)

    steps = df.withColumns({"__hex": F.hex(blob), "__type": _type_word(blob)}).withColumn("__skip", skip)
    steps = steps.withColumn("__hex", F.when(blob.isNull() | is_point, F.col("__hex")).otherwise(problem))
    steps = steps.withColumns({"__b0": bits(0), "__b1": bits(1)})
    for i in (0, 1):
        steps = steps.withColumns(
            {f"__hi{i}": _unsigned(F.substring(f"__b{i}", 1, 8)), f"__lo{i}": _unsigned(F.substring(f"__b{i}", 9, 8))}
        )
    for i in (0, 1):
        high = F.col(f"__hi{i}")
        steps = steps.withColumns(
            {
                f"__e{i}": F.shiftright(high, 20).bitwiseAND(F.lit(0x7FF)),
                f"__m{i}": high.bitwiseAND(F.lit(0xFFFFF)).cast("double") * 2.0**32 + F.col(f"__lo{i}").cast("double"),
            }
        )

    def value(i: int) -> Column:
        exponent, mantissa = F.col(f"__e{i}"), F.col(f"__m{i}")
        sign = F.when(F.col(f"__hi{i}") >= 2**31, F.lit(-1.0)).otherwise(F.lit(1.0))
        normal = (1 + mantissa / 2.0**52) * F.pow(F.lit(2.0), (exponent - 1023).cast("double"))
        tiny = mantissa / 2.0**52 * 2.0**-1022
        special = F.when(mantissa == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
        return sign * F.when(exponent == 0, tiny).when(exponent == 2047, special).otherwise(normal)

    kept = [c for c in df.columns if c not in (x, y)]
    return steps.select(*kept, value(0).alias(x), value(1).alias(y))


def point_geometry(x: Column, y: Column) -> Column:
    """A point in the working form; NULL when a coordinate is."""
    vertex = F.struct(x.alias("x"), y.alias("y"))
    shape = F.struct(F.lit("POINT").alias("type"), F.array(F.array(F.array(vertex))).alias("parts"))
    return F.when(x.isNotNull() & y.isNotNull(), shape)


def multi_wkb(wkb: Column) -> Column:
    """WKB of a single geometry as its multi form: a multi header before the stored bytes, so Z, M and SRID stay.

    Multi geometries and collections stay as they are; NULL on NULL.
    """
    little = F.hex(F.substring(wkb, 1, 1)) == "01"
    word = F.lpad(F.hex(_type_word(wkb) + 3), 8, "0")  # POINT, LINESTRING, POLYGON: each multi code is three above
    one = F.when(little, F.lit("01000000")).otherwise("00000001")
    srid = F.when(_type_word(wkb).bitwiseAND(F.lit(EWKB_SRID)) != 0, F.hex(F.substring(wkb, 6, 4))).otherwise("")
    head = F.concat(F.hex(F.substring(wkb, 1, 1)), F.when(little, _turned(word)).otherwise(word), srid, one)
    return F.when(wkb_type(wkb).isin("POINT", "LINESTRING", "POLYGON"), F.concat(F.unhex(head), wkb)).otherwise(wkb)


# ---- any geometry, in Arrow batches ----


def _read(buf: memoryview, pos: int, parts: list) -> tuple[str, int]:
    """Read one geometry at ``pos``, append its parts (lists of coordinate arrays), return type name and end."""
    order = "<" if buf[pos] == 1 else ">"
    word = int(np.frombuffer(buf, f"{order}u4", 1, pos + 1)[0])
    pos += 5 + (4 if word & EWKB_SRID else 0)
    code = word & 0x0FFFFFFF
    dims = 2 + bool(word & EWKB_Z) + bool(word & EWKB_M) + (0, 1, 1, 2)[code // 1000]
    name = TYPE_NAMES[code % 1000]

    def count(at: int) -> int:
        return int(np.frombuffer(buf, f"{order}u4", 1, at)[0])

    def vertices(at: int, n: int) -> tuple[np.ndarray, int]:
        flat = np.frombuffer(buf, f"{order}f8", n * dims, at)
        return flat.reshape(n, dims)[:, :2], at + 8 * dims * n

    if name == "POINT":
        xy, pos = vertices(pos, 1)
        parts.append([] if np.isnan(xy).all() else [xy])
    elif name == "LINESTRING":
        xy, pos = vertices(pos + 4, count(pos))
        parts.append([xy])
    elif name == "POLYGON":
        rings, n = [], count(pos)
        pos += 4
        for _ in range(n):
            xy, pos = vertices(pos + 4, count(pos))
            rings.append(xy)
        parts.append(rings)
    else:
        n = count(pos)
        pos += 4
        for _ in range(n):
            _, pos = _read(buf, pos, parts)
    return name, pos


def _nested(sizes: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("int32")), values)


@F.arrow_udf(GEOMETRY)
def _decode(blobs: pa.Array) -> pa.Array:
    types, n_parts, n_rings, n_vertices, coordinates = [], [], [], [], []
    for i in range(len(blobs)):
        if not blobs[i].is_valid:
            types.append(None)
            n_parts.append(0)
            continue
        buf = memoryview(blobs[i].as_buffer())
        parts: list = []
        try:
            name, end = _read(buf, 0, parts)
        except (ValueError, KeyError, IndexError) as problem:
            raise ValueError(f"malformed WKB of {len(buf)} bytes: {problem}") from None
        if end != len(buf):
            raise ValueError(f"malformed WKB: {len(buf) - end} bytes left over")
        types.append(name)
        n_parts.append(len(parts))
        for rings in parts:
            n_rings.append(len(rings))
            n_vertices.extend(len(r) for r in rings)
            coordinates.extend(rings)
    xy = np.concatenate(coordinates).astype("f8") if coordinates else np.empty((0, 2))
    vertex = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(xy[:, 0])), pa.array(np.ascontiguousarray(xy[:, 1]))], ["x", "y"]
    )
    parts_array = _nested(n_parts, _nested(n_rings, _nested(n_vertices, vertex)))
    names = pa.array(types, pa.string())
    return pa.StructArray.from_arrays([names, parts_array], ["type", "parts"], mask=names.is_null())


def decode_wkb(wkb: Column) -> Column:
    """Any WKB geometry in the working form; NULL on NULL, an error on malformed bytes. Z and M are dropped."""
    return _decode(wkb)


def _header(code: int) -> bytes:
    return b"\x01" + int(code).to_bytes(4, "little")


@F.arrow_udf(T.BinaryType())
def _encode(shapes: pa.Array) -> pa.Array:
    kinds, parts = shapes.flatten()
    part_at, ring_at = parts.offsets.to_pylist(), parts.values.offsets.to_pylist()
    vertex_at = parts.values.values.offsets.to_pylist()
    x, y = (c.to_numpy(zero_copy_only=False) for c in parts.values.values.values.flatten())
    flat = memoryview(np.column_stack([x, y]).astype("<f8").tobytes())  # 16 bytes per vertex
    empty_point = np.array([np.nan, np.nan], "<f8").tobytes()

    def size(n: int) -> bytes:
        return n.to_bytes(4, "little")

    def run(r: int) -> bytes:
        first, end = vertex_at[r], vertex_at[r + 1]
        return size(end - first) + flat[16 * first : 16 * end]

    def part(kind: str, p: int | None) -> bytes:
        rings = range(ring_at[p], ring_at[p + 1]) if p is not None else range(0)
        if kind == "POINT":
            return _header(1) + (bytes(flat[16 * vertex_at[rings[0]] :][:16]) if rings else empty_point)
        if kind == "LINESTRING":
            return _header(2) + (run(rings[0]) if rings else size(0))
        return _header(3) + size(len(rings)) + b"".join(map(run, rings))

    out = []
    for i, kind in enumerate(kinds.to_pylist()):
        own = range(part_at[i], part_at[i + 1])
        if kind is None:
            out.append(None)
        elif kind == "GEOMETRYCOLLECTION":
            raise ValueError("a geometry collection has no working form to write back from")
        elif kind.startswith("MULTI"):
            out.append(_header(TYPE_CODES[kind]) + size(len(own)) + b"".join(part(kind[5:], p) for p in own))
        else:
            out.append(part(kind, own[0] if own else None))
    return pa.array(out, pa.binary())


def encode_wkb(shape: Column) -> Column:
    """Little-endian WKB of a geometry in the working form."""
    return _encode(shape)
