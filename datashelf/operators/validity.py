"""Geometry validity flags and the normalisation of geometry columns.

Valid means: finite coordinates; lines with two distinct vertices; rings closed, with at least four vertices and no
self-contact; no two rings of a geometry crossing or sharing a stretch; holes inside their shell and not inside each
other; parts not inside each other; every part's interior in one piece (rings that touch make no circle).

Geometries with few segments are tested inside their row, whole batches at a time. Larger ones are cut into segments, which meet only within
cells of a grid laid over their own geometry, so that no task sees a whole large geometry and no pair list is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from datashelf.functions.geometry import to_multi
from datashelf.functions.ringcheck import INVALID, LARGE, cut_apart_rows, row_status
from datashelf.functions.wkb import decode_wkb, multi_wkb

IN_ROW_SEGMENTS = 128
CELL_SEGMENTS = 16  # a geometry of fewer has one cell
RULES = ("decode", "multi", "decode+flag")


def _turn(a: str, b: str, c: str) -> str:
    """Sign of the turn a -> b -> c, as SQL; a name stands for the columns of its x and y."""
    return f"sign(({b}x - {a}x) * ({c}y - {a}y) - ({b}y - {a}y) * ({c}x - {a}x))"


def _overlap(axis: str) -> str:
    """Length that segments s and t share on an axis; negative when their boxes are apart."""
    return (
        f"least(greatest(sa{axis}, sb{axis}), greatest(ta{axis}, tb{axis}))"
        f" - greatest(least(sa{axis}, sb{axis}), least(ta{axis}, tb{axis}))"
    )


# Segments s and t (columns a and b: end points, part, ring number, i: position among all segments, n: ring size) of one
# polygonal geometry may not stand together. The same rule as ``ringcheck.clashing_pairs``, for the join.
NEAR = f"{_overlap('x')} >= 0 AND {_overlap('y')} >= 0"
STRETCH = f"({_overlap('x')} > 0 OR {_overlap('y')} > 0)"
# What is computed once for a pair: the turns between the segments and whether they share a length.
TURNS = f"""inline(array(named_struct('t1', {_turn("sa", "sb", "ta")}, 't2', {_turn("sa", "sb", "tb")},
    't3', {_turn("ta", "tb", "sa")}, 't4', {_turn("ta", "tb", "sb")}, 'stretch', {STRETCH})))"""
CLASH = """t1 * t2 <= 0 AND t3 * t4 <= 0 AND CASE
    WHEN s_ring = t_ring AND (abs(i - j) = 1 OR abs(i - j) = s_n - 1) THEN t1 = 0 AND t2 = 0 AND stretch
    WHEN s_ring = t_ring THEN true
    ELSE (t1 * t2 < 0 AND t3 * t4 < 0) OR (t1 = 0 AND t2 = 0 AND stretch) END"""


def _end_on(turn: str, end: str, a: str, b: str) -> str:
    """An end in line with segment a-b as a point, if it lies on it."""
    within = " AND ".join(f"{end}{v} BETWEEN least({a}{v}, {b}{v}) AND greatest({a}{v}, {b}{v})" for v in "xy")
    return f"IF({turn} = 0 AND {within}, named_struct('x', {end}x, 'y', {end}y), NULL)"


# Where rings of one part touch: (part, ring, x, y) for either ring.
MAY_TOUCH = "s_part = t_part AND s_ring <> t_ring AND (t1 = 0 OR t2 = 0 OR t3 = 0 OR t4 = 0)"
TOUCHES = f"""IF({MAY_TOUCH}, flatten(transform(filter(array(
    {_end_on("t1", "ta", "sa", "sb")}, {_end_on("t2", "tb", "sa", "sb")},
    {_end_on("t3", "sa", "ta", "tb")}, {_end_on("t4", "sb", "ta", "tb")}), c -> c IS NOT NULL), c -> array(
  named_struct('part', s_part, 'ring', s_ring, 'x', c.x, 'y', c.y),
  named_struct('part', t_part, 'ring', t_ring, 'x', c.x, 'y', c.y)))), array())"""

# All segments of all rings of the column ``parts``, repeated vertices skipped.
SEGMENTS = """flatten(transform(
  flatten(transform(parts, (rings, p) -> transform(rings, ring -> named_struct(
    'part', p, 'line', filter(ring, (v, i) -> i = 0 OR v.x <> ring[i - 1].x OR v.y <> ring[i - 1].y))))),
  (ring, r) -> transform(
    zip_with(slice(ring.line, 1, size(ring.line) - 1), slice(ring.line, 2, size(ring.line) - 1), (a, b) -> named_struct('a', a, 'b', b)),
    e -> named_struct('a', e.a, 'b', e.b, 'part', ring.part, 'ring', r, 'n', size(ring.line) - 1))))"""


def _row_status(in_row: int):
    @F.arrow_udf(T.ByteType())
    def status(shapes: pa.Array) -> pa.Array:
        return row_status(shapes, in_row)

    return status


@F.arrow_udf(T.BooleanType())
def _cut_apart(touches: pa.Array) -> pa.Array:
    return cut_apart_rows(touches)


def _large_clashes(large: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Ids of large geometries with clashing segments or an interior cut apart, found by a join on grid cells.

    The points at which rings touch are gathered by geometry, all of whose vertices one row holds.
    """
    # posexplode_outer: a large geometry always has segments, so no filter on their number need be inferred.
    renamed = {c: f"__id{n}" for n, c in enumerate(ids)}  # apart from the working columns below
    back, large = {v: k for k, v in renamed.items()}, large.withColumnsRenamed(renamed)
    ids = list(back)
    # Rings are closed, so first ends are all the vertices. About one segment length per cell side, or more where segments
    # are few.
    boxed = large.selectExpr(
        *ids, "segments",
        f"greatest(least(ceil(sqrt(size(segments))), ceil(size(segments) / {CELL_SEGMENTS})), 1) AS side",
        "array_min(segments.a.x) AS x0", "array_min(segments.a.y) AS y0",
        "array_max(segments.a.x) AS x1", "array_max(segments.a.y) AS y1",
    )
    # Every column of cells that a segment passes gets the cells of its stretch there. Borders are padded by a millionth
    # of a cell against rounding.
    gridded = boxed.selectExpr(
        *ids, "side", "x0", "y0", "greatest((x1 - x0) / side, 1e-300) AS w", "greatest((y1 - y0) / side, 1e-300) AS h",
        "posexplode_outer(segments) AS (i, s)",
    )
    segment = ["s.a.x AS sax", "s.a.y AS say", "s.b.x AS sbx", "s.b.y AS sby", "s.part AS s_part", "s.ring AS s_ring", "s.n AS s_n"]
    ordered = gridded.selectExpr(
        *ids, "i", *segment, "side", "x0", "y0", "w", "h",
        "IF(s.a.x <= s.b.x, s.a, s.b) AS l", "IF(s.a.x <= s.b.x, s.b, s.a) AS r",
    )
    names = ["sax", "say", "sbx", "sby", "s_part", "s_ring", "s_n"]
    columns = ordered.selectExpr("*", f"explode({_passed('(l.x - x0) / w', '(r.x - x0) / w')}) AS cx")
    stretches = columns.selectExpr(
        *ids, "i", *names, "side", "cx", "y0", "h",
        "IF(r.x > l.x, l.y + (r.y - l.y) * ((greatest(l.x, x0 + (cx - 1e-6) * w) - l.x) / (r.x - l.x)), l.y) AS y_in",
        "IF(r.x > l.x, l.y + (r.y - l.y) * ((least(r.x, x0 + (cx + 1 + 1e-6) * w) - l.x) / (r.x - l.x)), r.y) AS y_out",
    )
    cells = stretches.selectExpr(
        *ids, "cx", f"explode({_passed('(least(y_in, y_out) - y0) / h', '(greatest(y_in, y_out) - y0) / h')}) AS cy", "i", *names
    )
    p = cells.alias("p")
    q = cells.withColumnsRenamed({"i": "j"} | {c: f"t{c[1:]}" for c in names}).alias("q")
    meet = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in (*ids, "cx", "cy")]
    pairs = p.join(q, [*meet, F.col("i") < F.col("j"), F.expr(NEAR)], "inner")
    kept = [F.col(f"p.{c}").alias(c) for c in ids]
    ends = [F.col(c) for c in ("i", "j", *names, *(f"t{c[1:]}" for c in names))]
    turned = pairs.select(*kept, *ends, F.expr(TURNS)).filter(f"({CLASH}) OR ({MAY_TOUCH})")
    found = turned.select(*[F.col(c).alias(back[c]) for c in ids], F.expr(CLASH).alias("clash"), F.explode_outer(F.expr(TOUCHES)).alias("touch"))
    names = [back[c] for c in ids]
    by_geometry = found.groupBy(*names).agg(
        F.max("clash").alias("clash"), F.collect_set(F.when(~F.col("clash"), F.col("touch"))).alias("touches")
    )
    return by_geometry.filter(F.col("clash") | _cut_apart("touches")).select(*names)


def _passed(start: str, end: str) -> str:
    """The cells from ``start`` to ``end``, in units of a cell; outer ones have what lies at the border."""
    return f"sequence(least(greatest(floor({start} - 1e-6), 0), side - 1), least(greatest(floor({end} + 1e-6), 0), side - 1))"


def _vertices(shape: Column) -> Column:
    """Number of vertices; nothing is copied to count them."""
    of_part = lambda rings: F.aggregate(rings, F.lit(0), lambda n, ring: n + F.coalesce(F.size(ring), F.lit(0)))
    return F.aggregate(shape["parts"], F.lit(0), lambda n, rings: n + F.coalesce(of_part(rings), F.lit(0)))


def may_be_large(wkb: Column, in_row: int = IN_ROW_SEGMENTS) -> Column:
    """False only for WKB too short to hold more than ``in_row`` segments, which take at least 16 bytes each."""
    return F.octet_length(wkb) > 16 * in_row


def flag_valid(
    df: DataFrame,
    shape: str,
    ids: Sequence[str],
    flag: str = "geom_valid",
    in_row: int = IN_ROW_SEGMENTS,
    large_hint: Column | None = None,
) -> DataFrame:
    """Add a boolean validity column; NULL for a NULL geometry. ``ids`` identify a row (non-null, unique).

    ``large_hint`` is a cheap condition that holds for every geometry of more than ``in_row`` segments, such as
    :func:`may_be_large` of the stored WKB. Rows that fail it are not decoded again for the large-geometry branch.
    Without it, the number of vertices is.
    """
    geometry = F.col(shape)
    status = F.col("__status")
    staged = df.withColumn("__status", _row_status(in_row)(geometry))
    decided = staged.filter(status.isNull() | (status != LARGE)).withColumn(flag, status != INVALID)
    # Only large geometries take part in the join; all others keep their place.
    if large_hint is None:
        large_hint = F.coalesce(_vertices(geometry) > in_row, F.lit(True))
    candidates = staged.filter(large_hint)
    large = candidates.filter(status == LARGE)
    segments = large.select(*ids, geometry["parts"].alias("parts")).selectExpr(*ids, f"{SEGMENTS} AS segments")
    clashing = _large_clashes(segments, ids).withColumn("__bad", F.lit(True))
    checked = large.join(clashing, list(ids), "left").withColumn(flag, F.col("__bad").isNull())
    return decided.select(*df.columns, flag).unionAll(checked.select(*df.columns, flag))


def normalise_wkb(df: DataFrame, wkb: str, rule: str, ids: Sequence[str] = ()) -> DataFrame:
    """Like :func:`normalise_geometry`, but the column stays WKB, with Z, M, SRID and collections as they are stored.

    Only the rule that flags validity decodes anything.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}; one of {RULES}")
    metadata = df.schema[wkb].metadata or {}
    others = [F.col(f"`{c}`") for c in df.columns if c != wkb]
    stored = multi_wkb(F.col(wkb)) if rule == "multi" else F.col(wkb)
    kept = df.select(*others, stored.alias(wkb, metadata=metadata))
    if rule != "decode+flag":
        return kept
    shaped = kept.withColumns({"__shape": decode_wkb(F.col(wkb)), "__long": may_be_large(F.col(wkb))})
    return flag_valid(shaped, "__shape", ids, large_hint=F.col("__long")).drop("__shape", "__long")


def normalise_geometry(df: DataFrame, wkb: str, rule: str, ids: Sequence[str] = ()) -> DataFrame:
    """Replace a WKB column by its decoded geometry, moved to the end.

    Rules: ``decode``; ``multi`` (also promote to multi types); ``decode+flag`` (also add ``geom_valid``).
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}; one of {RULES}")
    decoded = decode_wkb(F.col(wkb))
    if rule == "multi":
        decoded = to_multi(decoded)
    metadata = df.schema[wkb].metadata or {}
    others = [c for c in df.columns if c != wkb]
    shaped = decoded.alias(wkb, metadata=metadata)
    if rule != "decode+flag":
        return df.select(*others, shaped)
    sized = df.select(*others, may_be_large(F.col(wkb)).alias("__long"), shaped)
    return flag_valid(sized, wkb, ids, large_hint=F.col("__long")).drop("__long")
