"""Row-local geometry checks on Arrow batches: finite, closed, long enough, nested well, no clash between few segments,
interiors in one piece."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

INVALID, VALID, LARGE = 0, 1, 2  # LARGE: fine so far, too many segments to compare within the row
PAIRS_PER_STEP = 250_000
FEW_RINGS = 32  # of a geometry: their boxes are compared each with each


def _turn(ax, ay, bx, by, cx, cy):
    return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def clashing_pairs(a, b, ring, k, n, p, q) -> np.ndarray:
    """Which segment pairs (p[i], q[i]) may not stand together.

    ``a`` and ``b`` are end points (n x 2), ``ring`` the ring number, ``k`` the position in the ring and ``n`` its size.
    Neighbours in a ring may share their corner only, other segments of a ring nothing, and segments of different
    rings single points.
    """
    low, high = np.minimum(a, b), np.maximum(a, b)
    near = ((high[p] >= low[q]) & (high[q] >= low[p])).all(axis=1)
    result = np.zeros(len(p), bool)
    p, q = p[near], q[near]
    ends = (*a[p].T, *b[p].T), (*a[q].T, *b[q].T)
    (pax, pay, pbx, pby), (qax, qay, qbx, qby) = ends
    t1, t2 = _turn(pax, pay, pbx, pby, qax, qay), _turn(pax, pay, pbx, pby, qbx, qby)
    t3, t4 = _turn(qax, qay, qbx, qby, pax, pay), _turn(qax, qay, qbx, qby, pbx, pby)
    meet = (t1 * t2 <= 0) & (t3 * t4 <= 0)
    crossing = (t1 * t2 < 0) & (t3 * t4 < 0)
    shared = np.minimum(high[p], high[q]) - np.maximum(low[p], low[q])
    stretch = (t1 == 0) & (t2 == 0) & (shared > 0).any(axis=1)
    same = ring[p] == ring[q]
    step = np.abs(k[p] - k[q])
    neighbours = same & ((step == 1) | (step == n[p] - 1))
    result[near] = meet & np.where(neighbours, stretch, same | crossing | stretch)
    return result


def touching(a, b, p, q) -> tuple[np.ndarray, np.ndarray]:
    """Ends of one segment of a pair that lie on the other: (index into the pairs, points)."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    which, points = [], []
    for end, one, other in ((a, p, q), (b, p, q), (a, q, p), (b, q, p)):
        c = end[one]
        held = ((c >= low[other]) & (c <= high[other])).all(axis=1) & (_turn(*a[other].T, *b[other].T, *c.T) == 0)
        which.append(np.flatnonzero(held))
        points.append(c[held])
    return np.concatenate(which), np.concatenate(points)


def cut_apart(owner, part, ring, x, y) -> set:
    """Owners whose interior falls apart, from arrays of one entry for each ring at each point of contact.

    Rings of a part that neither cross nor share a stretch leave its interior in one piece as long as rings and points
    of contact make no circle; a touch between a ring and a point that hang together already closes one.
    """
    columns = (owner, part, ring, x, y)
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    columns = [c[fresh] for c in columns]
    # A circle takes two rings at two points, which are four touches.
    _, which, count = np.unique(columns[0], return_inverse=True, return_counts=True)
    parent, cut = {}, set()

    def root(node):
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for owner, part, ring, x, y in zip(*(c[count[which] >= 4].tolist() for c in columns)):
        one, other = root((owner, part, ring)), root((owner, part, x, y))
        if one == other:
            cut.add(owner)
        parent[one] = other
    return cut


def cut_apart_rows(touches: pa.Array) -> pa.Array:
    """Whether the touches (list of part, ring, x, y) of each row cut an interior apart."""
    rows = np.repeat(np.arange(len(touches)), np.diff(touches.offsets.to_numpy()))
    first, last = touches.offsets[0].as_py(), touches.offsets[-1].as_py()
    part, ring, x, y = (c.to_numpy(zero_copy_only=False) for c in touches.values[first:last].flatten())
    cut = cut_apart(rows, part, ring, x, y)
    return pa.array([i in cut for i in range(len(touches))], pa.bool_())


def _ray(xy, start, n_edges, points) -> np.ndarray:
    """1 inside, 0 on, -1 outside, per point and ring, by counting crossings of a ray to the right."""
    out = np.empty(len(points), "int8")
    edges = np.concatenate([[0], np.cumsum(n_edges)])
    begin = 0
    while begin < len(points):
        end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + PAIRS_PER_STEP, "right")) - 1)
        n, first = n_edges[begin:end], edges[begin:end] - edges[begin]
        e = np.repeat(start[begin:end] - first, n) + np.arange(n.sum())
        a, b, p = xy[e], xy[e + 1], np.repeat(points[begin:end], n, axis=0)
        turn = _turn(*a.T, *b.T, *p.T)
        on = (turn == 0) & ((p >= np.minimum(a, b)) & (p <= np.maximum(a, b))).all(axis=1)
        crossed = ((a[:, 1] > p[:, 1]) != (b[:, 1] > p[:, 1])) & ((turn > 0) == (b[:, 1] > a[:, 1]))
        inside = np.add.reduceat(crossed.astype("i8"), first) % 2 == 1
        out[begin:end] = np.where(np.logical_or.reduceat(on, first), 0, np.where(inside, 1, -1))
        begin = end
    return out


def _places(xy, first, length, inner, outer) -> np.ndarray:
    """Where rings lie relative to rings that they do not cross: the first probe off the boundary tells."""
    result = np.zeros(len(inner), "int8")
    todo = np.arange(len(inner))
    for probe in (lambda r: xy[r], lambda r: (xy[r] + xy[r + 1]) / 2, lambda r: xy[r + 1], lambda r: xy[r + 2]):
        if len(todo):
            ring = outer[todo]
            result[todo] = _ray(xy, first[ring], length[ring] - 1, probe(first[inner[todo]]))
            todo = todo[result[todo] == 0]
    return result


def _ranges(start, count) -> np.ndarray:
    """start[i], start[i] + 1, ... (count[i] of them), one after the other."""
    first = np.concatenate([[0], np.cumsum(count)])
    return np.arange(first[-1]) - np.repeat(first[:-1] - start, count)


def boxes_within(low, high) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (inner, outer) of boxes that lie within each other.

    Lower corners are dealt into columns of equally many, and sorted upwards in each, so that columns are narrow where
    corners are dense. A box looks only at the stretch between its own ends in the columns that it covers.
    """
    n = len(low)
    if n < 2:
        return np.empty(0, int), np.empty(0, int)
    by_x, by_y = np.argsort(low[:, 0], kind="stable"), np.argsort(low[:, 1], kind="stable")
    side = int(np.ceil(np.sqrt(n)))
    column, height = np.empty(n, int), np.empty(n, int)
    column[by_x], height[by_y] = np.arange(n) // side, np.arange(n)
    key = column * (n + 1) + height
    order = np.argsort(key)
    key, x, y = key[order], low[by_x, 0], low[by_y, 1]
    left, right = np.searchsorted(x, low[:, 0], "left") // side, (np.searchsorted(x, high[:, 0], "right") - 1) // side
    bottom, top = np.searchsorted(y, low[:, 1], "left"), np.searchsorted(y, high[:, 1], "right")
    box = np.repeat(np.arange(n), right - left + 1)
    strip = _ranges(left, right - left + 1) * (n + 1)
    start, end = np.searchsorted(key, strip + bottom[box]), np.searchsorted(key, strip + top[box])
    found = [], []
    sums = np.concatenate([[0], np.cumsum(end - start)])
    at = 0
    while at < len(box):
        to = max(at + 1, int(np.searchsorted(sums, sums[at] + PAIRS_PER_STEP, "right")) - 1)
        inner, outer = order[_ranges(start[at:to], (end - start)[at:to])], np.repeat(box[at:to], (end - start)[at:to])
        held = (inner != outer) & (low[inner] >= low[outer]).all(axis=1) & (high[inner] <= high[outer]).all(axis=1)
        found[0].append(inner[held])
        found[1].append(outer[held])
        at = to
    return np.concatenate(found[0]), np.concatenate(found[1])


def _held_boxes(low, high, begin, count) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(geometry, inner, outer) for boxes of the rings of one geometry that lie within each other.

    The rings of geometry i are ``count[i]`` from ``begin[i]`` on. Few of them are compared each with each, many
    geometries at a time.
    """
    found = [], [], []
    few = np.flatnonzero(count <= FEW_RINGS)
    sums = np.concatenate([[0], np.cumsum(count[few] ** 2)])
    at = 0
    while at < len(few):
        to = max(at + 1, int(np.searchsorted(sums, sums[at] + PAIRS_PER_STEP, "right")) - 1)
        square = count[few[at:to]] ** 2
        owner, place = np.repeat(few[at:to], square), _ranges(np.zeros(to - at, int), square)
        inner, outer = begin[owner] + place // count[owner], begin[owner] + place % count[owner]
        held = (inner != outer) & (low[inner] >= low[outer]).all(axis=1) & (high[inner] <= high[outer]).all(axis=1)
        for out, values in zip(found, (owner, inner, outer)):
            out.append(values[held])
        at = to
    for g in np.flatnonzero(count > FEW_RINGS):
        inner, outer = boxes_within(low[begin[g] : begin[g] + count[g]], high[begin[g] : begin[g] + count[g]])
        for out, values in zip(found, (np.full(len(inner), g), inner + begin[g], outer + begin[g])):
            out.append(values)
    return tuple(np.concatenate(out) if out else np.empty(0, int) for out in found)


def badly_nested(xy, first, length, ring_part, ring_place, begin, count) -> np.ndarray:
    """Which geometries have a hole outside its shell, a hole within a hole, or a part within a part.

    ``ring_part`` and ``ring_place`` give a ring's part and its position there (0 is the shell); geometry i has the
    ``count[i]`` rings from ``begin[i]`` on. Only rings whose boxes lie within each other are compared.
    """
    low = np.minimum.reduceat(xy, first) if len(first) else xy
    high = np.maximum.reduceat(xy, first) if len(first) else xy
    owner, inner, outer = _held_boxes(low, high, begin, count)
    place = _places(xy, first, length, inner, outer)
    hole_in, hole_out = ring_place[inner] > 0, ring_place[outer] > 0
    same_part = ring_part[inner] == ring_part[outer]
    bad = np.zeros(len(begin), bool)
    # A hole belongs in the shell of its part.
    lost = ring_place > 0
    lost[inner[hole_in & ~hole_out & same_part & (place >= 0)]] = False
    bad[np.repeat(np.arange(len(begin)), count)[lost[_ranges(begin, count)]]] = True
    bad[owner[hole_in & hole_out & same_part & (place > 0)]] = True
    # A part may lie within another one only where that has a hole.
    shells = ~hole_in & ~same_part
    sheltered = {(r, p) for r, p in zip(inner[shells & hole_out & (place >= 0)], ring_part[outer[shells & hole_out & (place >= 0)]])}
    for i in np.flatnonzero(shells & ~hole_out & (place > 0)):
        if (inner[i], ring_part[outer[i]]) not in sheltered:
            bad[owner[i]] = True
    return bad


def row_status(shapes: pa.Array, in_row: int) -> pa.Array:
    """INVALID, VALID or LARGE per geometry; NULL for NULL."""
    kinds, parts = shapes.flatten()
    rings, vertices = parts.values, parts.values.values
    part_of_geometry = np.diff(parts.offsets.to_numpy())
    ring_of_part = np.diff(rings.offsets.to_numpy())
    length = np.diff(vertices.offsets.to_numpy()).astype(np.int64)
    x, y = (c.to_numpy(zero_copy_only=False) for c in vertices.values.flatten())
    xy = np.column_stack([x, y]).astype("f8")

    count = len(shapes)
    kind = np.asarray(kinds.to_pylist(), dtype=object)
    polygonal = np.isin(kind, ["POLYGON", "MULTIPOLYGON"])
    lines = np.isin(kind, ["LINESTRING", "MULTILINESTRING"])
    ring_owner = np.repeat(np.repeat(np.arange(count), part_of_geometry), ring_of_part)
    vertex_ring = np.repeat(np.arange(len(length)), length)

    bad = np.zeros(count, bool)
    bad[ring_owner[vertex_ring[~np.isfinite(xy).all(axis=1)]]] = True
    fresh = np.ones(len(xy), bool)
    fresh[1:] = (xy[1:] != xy[:-1]).any(axis=1) | (vertex_ring[1:] != vertex_ring[:-1])
    distinct = np.bincount(vertex_ring[fresh], minlength=len(length))
    last = np.cumsum(length) - 1
    filled = length > 0
    closed = np.zeros(len(length), bool)
    closed[filled] = (xy[(last - length + 1)[filled]] == xy[last[filled]]).all(axis=1)
    ring_bad = np.where(
        polygonal[ring_owner], ~closed | (length < 4) | (distinct < 4), lines[ring_owner] & (distinct == 1)
    )
    bad[ring_owner[ring_bad]] = True

    # Segments of the polygonal geometries that passed, in the order geometry, ring, position.
    usable = fresh & (polygonal & ~bad)[ring_owner[vertex_ring]] if len(xy) else fresh
    points, owner_ring = xy[usable], vertex_ring[usable]
    joined = owner_ring[1:] == owner_ring[:-1]
    a, b, ring = points[:-1][joined], points[1:][joined], owner_ring[:-1][joined]
    size = distinct[ring] - 1
    geometry = ring_owner[ring]
    total = np.bincount(geometry, minlength=count)
    large = total > in_row
    first_of_ring = np.searchsorted(ring, ring)
    k = np.arange(len(ring)) - first_of_ring
    place = np.arange(len(ring)) - np.searchsorted(geometry, geometry)
    partners = np.where(large[geometry], 0, total[geometry] - 1 - place)
    ring_part = np.repeat(np.arange(len(ring_of_part)), ring_of_part)
    part = ring_part[ring]
    low, high = np.minimum(a, b), np.maximum(a, b)
    touches = []
    edges = np.concatenate([[0], np.cumsum(partners)])
    start = 0
    while start < len(ring):
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + PAIRS_PER_STEP, "right")) - 1)
        here = partners[start:stop]
        p = np.repeat(np.arange(start, stop), here)
        q = p + 1 + np.arange(len(p)) - np.repeat(edges[start:stop] - edges[start], here)
        bad[geometry[p[clashing_pairs(a, b, ring, k, size, p, q)]]] = True
        several = (part[p] == part[q]) & (ring[p] != ring[q])
        p, q = p[several], q[several]
        near = ((high[p] >= low[q]) & (high[q] >= low[p])).all(axis=1)
        p, q = p[near], q[near]
        which, points_of = touching(a, b, p, q)
        for end in (p, q):
            s = end[which]
            touches.append((geometry[s], part[s], ring[s], *points_of.T))
        start = stop
    if touches:
        bad[list(cut_apart(*map(np.concatenate, zip(*touches))))] = True
    rings_of = np.bincount(ring_owner, minlength=count)
    ring_end = np.cumsum(rings_of)
    several = np.flatnonzero(polygonal & ~bad & (rings_of > 1))
    if len(several):
        ring_place = np.arange(len(length)) - np.searchsorted(ring_part, ring_part)
        # Empty rings cannot occur here, but other geometries of the batch may have them.
        of = rings_of[several]
        used = _ranges(ring_end[several] - of, of)
        start = np.concatenate([[0], np.cumsum(length[used])])[:-1]
        vertices_used = xy[_ranges((last - length + 1)[used], length[used])]
        begin = np.concatenate([[0], np.cumsum(of)])[:-1]
        bad[several] = badly_nested(vertices_used, start, length[used], ring_part[used], ring_place[used], begin, of)
    status = np.where(bad, INVALID, np.where(large, LARGE, VALID)).astype("int8")
    return pa.array(status, pa.int8(), mask=~np.asarray(shapes.is_valid()))
