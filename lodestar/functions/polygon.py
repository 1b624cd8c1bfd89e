"""Polygons of detections: area, centroid and bounds as expressions; repair, convex hull and overlap in Arrow functions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

POINTS = "array<struct<x:double,y:double>>"
PAIRS = 1 << 14


def _pairs(points: Column) -> Column:
    turned = F.concat(F.slice(points, F.lit(2), F.size(points)), F.slice(points, 1, 1))
    return F.zip_with(points, turned, lambda a, b: F.struct((a["x"] + b["x"]).alias("x"), (a["y"] + b["y"]).alias("y"), (a["x"] * b["y"] - b["x"] * a["y"]).cast("double").alias("cross")))


def signed_area(points: Column) -> Column:
    return F.aggregate(_pairs(points), F.lit(0.0), lambda t, p: t + p["cross"]) / 2


def centroid(points: Column) -> Column:
    """struct<x, y>: centre of mass of the area; null where there is none."""
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    total = F.aggregate(_pairs(points), zero, lambda t, p: F.struct((t["x"] + p["x"] * p["cross"]).alias("x"), (t["y"] + p["y"] * p["cross"]).alias("y")))
    six = 6 * signed_area(points)
    return F.when(six != 0, F.struct((total["x"] / six).alias("x"), (total["y"] / six).alias("y")))


def bounds(points: Column) -> Column:
    """struct<x0, y0, x1, y1>."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def hull(p: np.ndarray) -> np.ndarray:
    """The convex hull of points (n, 2), counter-clockwise."""
    p = np.unique(p, axis=0)
    if len(p) < 3:
        return p

    def chain(rows):
        out: list[np.ndarray] = []
        for r in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (r[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (r[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(r)
        return out[:-1]

    return np.array(chain(p) + chain(p[::-1]))


def crosses_itself(p: np.ndarray) -> bool:
    """Whether two sides of a polygon that are no neighbours meet."""
    n = len(p)
    side = lambda a, b, c: np.sign((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
    for i in range(n):
        for j in range(i + 2, n - (i == 0)):
            a, b, c, d = p[i], p[(i + 1) % n], p[j], p[(j + 1) % n]
            if side(a, b, c) * side(a, b, d) <= 0 and side(c, d, a) * side(c, d, b) <= 0 and (side(a, b, c) or side(a, b, d)):
                return True
    return False


def clipped_area(a: np.ndarray, b: np.ndarray) -> float:
    """Common area of two convex polygons, counter-clockwise: a cut by each side of b in turn."""
    for k in range(len(b)):
        if len(a) < 3:
            return 0.0
        p, q = b[k], b[(k + 1) % len(b)]
        d = (q[0] - p[0]) * (a[:, 1] - p[1]) - (q[1] - p[1]) * (a[:, 0] - p[0])
        after, d2 = np.roll(a, -1, 0), np.roll(d, -1)
        out = []
        for i in range(len(a)):
            if d[i] >= 0:
                out.append(a[i])
            if d[i] * d2[i] < 0:
                out.append(a[i] + (after[i] - a[i]) * (d[i] / (d[i] - d2[i])))
        a = np.array(out) if out else np.empty((0, 2))
    if len(a) < 3:
        return 0.0
    x, y = a[:, 0], a[:, 1]
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def clipped_areas(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``clipped_area`` of many pairs at once, to the last bit: a (n, p, 2) cut by the sides of b (n, q, 2)."""
    n = len(a)
    x, y, size = a[:, :, 0], a[:, :, 1], np.full(n, a.shape[1])
    for k in range(b.shape[1]):
        size[size < 3] = 0
        px, py, qx, qy = (c[:, None] for c in (b[:, k, 0], b[:, k, 1], b[:, (k + 1) % b.shape[1], 0], b[:, (k + 1) % b.shape[1], 1]))
        at = np.arange(x.shape[1])[None, :]
        real, after = at < size[:, None], np.where(at + 1 < size[:, None], at + 1, 0)
        d = (qx - px) * (y - py) - (qy - py) * (x - px)
        x2, y2, d2 = (np.take_along_axis(c, after, 1) for c in (x, y, d))
        stays, meets = real & (d >= 0), real & (d * d2 < 0)
        share = np.divide(d, d - d2, out=np.zeros_like(d), where=meets)
        place = np.cumsum(stays.astype(np.int64) + meets, 1)
        size = place[:, -1].copy()
        new = np.zeros((2, n, max(1, int(size.max(initial=0)))))
        row, col = np.nonzero(stays)
        new[:, row, (place - meets - 1)[row, col]] = x[row, col], y[row, col]
        row, col = np.nonzero(meets)
        new[:, row, place[row, col] - 1] = (x + (x2 - x) * share)[row, col], (y + (y2 - y) * share)[row, col]
        x, y = new
    out = np.zeros(n)
    for m in np.unique(size[size > 2]).tolist():
        u, v = (np.ascontiguousarray(c[size == m, :m]) for c in (x, y))
        out[size == m] = np.abs((u * np.roll(v, -1, 1) - np.roll(u, -1, 1) * v).sum(1)) / 2
    return out


def as_array(points) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in points], float).reshape(-1, 2)


def repaired(points: Column) -> Column:
    """A polygon whose sides cross becomes its convex hull; null where fewer than three points are left."""

    def run(rows):
        import pandas as pd

        def one(r):
            if r is None or len(r) < 3:
                return None
            p = as_array(r)
            p = hull(p) if crosses_itself(p) else p
            return [{"x": x, "y": y} for x, y in p.tolist()] if len(p) > 2 else None

        return pd.Series([one(r) for r in rows])

    return F.pandas_udf(run, POINTS)(points.cast(POINTS))


def convex(points: Column) -> Column:
    """The convex hull as one flat list of doubles: x and y of each corner, counter-clockwise; null of null."""

    def run(rows):
        import pandas as pd

        return pd.Series([None if r is None else hull(as_array(r)).ravel().tolist() for r in rows])

    return F.pandas_udf(run, "array<double>")(points.cast(POINTS))


def overlap(a: Column, b: Column) -> Column:
    """Common area of two ``convex`` hulls, many pairs with as many corners at once."""

    def run(left, right):
        import pyarrow as pa

        ends = [np.diff(c.offsets.to_numpy()) // 2 for c in (left, right)]
        flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (left, right)]
        starts = [np.cumsum(n) - n for n in ends]
        out = np.zeros(len(left))
        kinds, which = np.unique(np.stack(ends, 1), axis=0, return_inverse=True)
        for k, (p, q) in enumerate(kinds.tolist()):
            if p < 3 or q < 3:
                continue
            at = np.nonzero(which == k)[0]
            for rows in np.split(at, range(PAIRS, len(at), PAIRS)):
                out[rows] = clipped_areas(*(f[2 * s[rows, None] + np.arange(2 * m)].reshape(len(rows), m, 2) for f, s, m in zip(flat, starts, (p, q))))
        return pa.array(out)

    return F.arrow_udf(run, "double")(a, b)
