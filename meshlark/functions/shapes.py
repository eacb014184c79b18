"""Tests of many pairs of geometries at once, on flat arrays of their edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ..errors import GeoDimensionMismatch
from .geo import AREAS

#: Pairs of edges that are tested at once; edges that are compared at once of a pair with more.
AT_ONCE, SLAB = 1 << 20, 1024


class Shapes:
    """The edges, lines and parts of a column of geometries without nulls, as arrays: lines of one point are an edge from
    it to itself. ``first_edge`` and ``first_line`` say where a geometry's begin."""

    def __init__(self, column: pa.StructArray):
        column = column.take(pa.array(np.arange(len(column))))  # without an offset
        self.n = len(column)
        self.area = np.array([k in AREAS for k in column.field("kind").to_pylist()], bool)
        self.srid = np.array([s if s is not None else -1 for s in column.field("srid").to_pylist()])
        parts = column.field("parts")
        lines = parts.values
        points = lines.values
        xy = points.values
        offsets = [np.asarray(x.offsets) for x in (parts, lines, points)]
        self.x, self.y = (xy.field(c).to_numpy(zero_copy_only=False) for c in "xy")
        geometry_of_part = np.repeat(np.arange(self.n), np.diff(offsets[0]))
        part_of_line = np.repeat(np.arange(len(geometry_of_part)), np.diff(offsets[1]))
        size = np.diff(offsets[2])
        line_of_point = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(line_of_point))
        last, single = at == offsets[2][1:][line_of_point] - 1, size[line_of_point] == 1
        begin = at[~last | single]
        end = np.where(single[begin], begin, begin + 1)
        self.edge = np.stack([self.x[begin], self.y[begin], self.x[end], self.y[end]])
        self.part = part_of_line[line_of_point[begin]]
        self.geometry = geometry_of_part[self.part]
        self.first_edge = np.searchsorted(self.geometry, np.arange(self.n + 1))
        own = np.flatnonzero(size)  # the first point of each line stands for it
        self.line_point, line_geometry = offsets[2][own], geometry_of_part[part_of_line[own]]
        self.first_line = np.searchsorted(line_geometry, np.arange(self.n + 1))
        self.part_in_geometry = self.part - offsets[0][self.geometry]
        self.parts = int(np.diff(offsets[0]).max(initial=0))
        point_geometry = geometry_of_part[part_of_line[line_of_point]]
        self.box = np.stack([np.full(self.n, v) for v in (np.inf, np.inf, -np.inf, -np.inf)])
        for row, how, v in ((0, np.minimum, self.x), (1, np.minimum, self.y), (2, np.maximum, self.x), (3, np.maximum, self.y)):
            how.at(self.box[row], point_geometry, v)


def _side(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def edges_meet(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Whether closed edges (rows x, y, x, y) have a point in common, one by one."""
    ax, ay, bx, by = e
    cx, cy, dx, dy = f
    s, t, u, v = _side(ax, ay, bx, by, cx, cy), _side(ax, ay, bx, by, dx, dy), _side(cx, cy, dx, dy, ax, ay), _side(cx, cy, dx, dy, bx, by)
    out = ((s > 0) != (t > 0)) & ((u > 0) != (v > 0)) & (s != 0) & (t != 0) & (u != 0) & (v != 0)
    for side, (px, py), (qx, qy, rx, ry) in ((s, (cx, cy), e), (t, (dx, dy), e), (u, (ax, ay), f), (v, (bx, by), f)):
        out |= (side == 0) & (np.minimum(qx, rx) <= px) & (px <= np.maximum(qx, rx)) & (np.minimum(qy, ry) <= py) & (py <= np.maximum(qy, ry))
    return out


def _sweep(e: np.ndarray, f: np.ndarray) -> bool:
    """Whether any of many edges meet: in slabs from south to north, each against the edges that reach into it."""
    e, f = (x[:, np.argsort(np.minimum(x[1], x[3]), kind="stable")] for x in (e, f))
    low, high = np.minimum(f[1], f[3]), np.maximum(f[1], f[3])
    for k in range(0, e.shape[1], SLAB):
        some = e[:, k : k + SLAB]
        beside = f[:, (low <= np.maximum(some[1], some[3]).max()) & (high >= np.minimum(some[1], some[3]).min())]
        step = max(1, AT_ONCE // max(1, beside.shape[1]))
        for m in range(0, some.shape[1], step):
            if beside.shape[1] and edges_meet(some[:, m : m + step, None], beside[:, None, :]).any():
                return True
    return False


def _products(n: np.ndarray, m: np.ndarray):
    """(row, first, second) for all n x m pairs of each row, some rows at a time."""
    total = np.cumsum(n * m)
    for lo, hi in _chunks(total):
        t = (n * m)[lo:hi]
        row = np.repeat(np.arange(lo, hi), t)
        local = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)
        yield row, local // m[row], local % m[row]


def _chunks(total: np.ndarray):
    lo, done = 0, 0
    while lo < len(total):
        hi = max(lo + 1, int(np.searchsorted(total, done + AT_ONCE, "right")))
        yield lo, hi
        lo, done = hi, total[hi - 1]


def _inside(x: Shapes, y: Shapes, rows: np.ndarray) -> np.ndarray:
    """For rows whose edges do not meet: whether a line of y's geometry begins inside x's, an area."""
    lines, edges = np.diff(y.first_line)[rows], np.diff(x.first_edge)[rows]
    out = np.zeros(len(rows), bool)
    for row, line, edge in _products(lines, edges):
        p = y.line_point[y.first_line[rows[row]] + line]
        px, py = y.x[p], y.y[p]
        at = x.first_edge[rows[row]] + edge
        ax, ay, bx, by = x.edge[:, at]
        with np.errstate(divide="ignore", invalid="ignore"):
            crossed = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
        # Odd crossings with the rings of one part: inside it, and in none of its holes.
        first = row[0]
        key = ((row - first) * int(lines.max()) + line) * max(1, x.parts) + x.part_in_geometry[at]
        odd = np.flatnonzero(np.bincount(key, crossed) % 2 == 1)
        out[first + odd // (max(1, x.parts) * int(lines.max()))] = True
    return out


def intersect(a: pa.StructArray, b: pa.StructArray) -> np.ndarray:
    """Whether the geometries of each row have a point in common, touching included; no nulls."""
    x, y = Shapes(a), Shapes(b)
    if (x.srid != y.srid).any():
        raise GeoDimensionMismatch("intersection is planar; use force_2d")
    common = np.stack([np.maximum(x.box[0], y.box[0]), np.maximum(x.box[1], y.box[1]), np.minimum(x.box[2], y.box[2]), np.minimum(x.box[3], y.box[3])])
    boxes = (common[0] <= common[2]) & (common[1] <= common[3])
    out = np.zeros(x.n, bool)

    def near(s: Shapes) -> tuple[np.ndarray, np.ndarray]:
        """Edges that reach into the box that both geometries have, and how many each geometry has."""
        c, e = common[:, s.geometry], s.edge
        kept = boxes[s.geometry] & (np.minimum(e[0], e[2]) <= c[2]) & (np.maximum(e[0], e[2]) >= c[0]) & (np.minimum(e[1], e[3]) <= c[3]) & (np.maximum(e[1], e[3]) >= c[1])
        return np.flatnonzero(kept), np.bincount(s.geometry[kept], minlength=s.n)

    (ea, na), (eb, nb) = near(x), near(y)
    sa, sb = np.cumsum(na) - na, np.cumsum(nb) - nb
    large = na * nb > AT_ONCE
    for k in np.flatnonzero(large):
        out[k] = _sweep(x.edge[:, ea[sa[k] : sa[k] + na[k]]], y.edge[:, eb[sb[k] : sb[k] + nb[k]]])
    for row, i, j in _products(np.where(large, 0, na), nb):
        if len(row):
            out[row[edges_meet(x.edge[:, ea[sa[row] + i]], y.edge[:, eb[sb[row] + j]])]] = True
    for s, t in ((x, y), (y, x)):
        rows = np.flatnonzero(boxes & ~out & s.area)
        if len(rows):
            out[rows[_inside(s, t, rows)]] = True
    return out
