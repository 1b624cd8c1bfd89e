"""Least-squares georeferencing fits. Control points are at most some hundreds, so the solve is the driver's; sums are Spark's."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_sums(points: DataFrame, *by: str) -> DataFrame:
    """The sums of the affine normal equations of (x, y) -> (lon, lat), by group; exact for whole numbers."""
    c = {n: F.col(n).cast("double") for n in ("x", "y", "lon", "lat")}
    pairs = [("x", "x"), ("x", "y"), ("y", "y"), ("x", "lon"), ("y", "lon"), ("x", "lat"), ("y", "lat")]
    return points.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(c[k]).alias(f"s_{k}") for k in c], *[F.sum(c[a] * c[b]).alias(f"s_{a}{b}") for a, b in pairs])


def affine(sums: DataFrame, target: str) -> DataFrame:
    """sums with a_<target>, b_<target>, c_<target>: target = a x + b y + c, by Cramer's rule on centred sums."""
    n = F.col("n")
    sxx, sxy, syy = (F.col(f"s_{p}{q}") - F.col(f"s_{p}") * F.col(f"s_{q}") / n for p, q in (("x", "x"), ("x", "y"), ("y", "y")))
    sxt, syt = (F.col(f"s_{p}{target}") - F.col(f"s_{p}") * F.col(f"s_{target}") / n for p in ("x", "y"))
    det = sxx * syy - sxy * sxy
    a, b = (sxt * syy - syt * sxy) / det, (syt * sxx - sxt * sxy) / det
    return sums.withColumn(f"a_{target}", a).withColumn(f"b_{target}", b).withColumn(f"c_{target}", (F.col(f"s_{target}") - a * F.col("s_x") - b * F.col("s_y")) / n)


def monomials(order: int) -> list[tuple[int, int]]:
    return [(i, d - i) for d in range(order + 1) for i in range(d, -1, -1)]


def design(x: np.ndarray, y: np.ndarray, order: int, scale: float = 1e4) -> np.ndarray:
    return np.stack([(x / scale) ** i * (y / scale) ** j for i, j in monomials(order)], 1)


def polynomial(points: np.ndarray, order: int) -> np.ndarray:
    """Coefficients (terms, 2) of columns x, y, lon, lat."""
    return np.linalg.lstsq(design(points[:, 0], points[:, 1], order), points[:, 2:4], rcond=None)[0]


def projected(coefficients: np.ndarray, order: int, k: int, x: Column, y: Column, scale: float = 1e4) -> Column:
    """The fitted lon (k = 0) or lat (k = 1) as an expression with literal coefficients."""
    out = F.lit(0.0)
    for (i, j), c in zip(monomials(order), coefficients[:, k]):
        out = out + F.lit(float(c)) * F.pow(x / scale, F.lit(i)) * F.pow(y / scale, F.lit(j))
    return out


def thin_plate(points: np.ndarray):
    """A thin-plate spline through the points: a function of (x, y) arrays -> (n, 2)."""
    def kernel(d2):
        return np.where(d2 > 0, d2 * np.log(np.maximum(d2, 1e-300)) / 2, 0.0)

    p = points[:, :2] / 1e3
    d2 = ((p[:, None] - p[None]) ** 2).sum(-1)
    one = np.hstack([np.ones((len(p), 1)), p])
    system = np.block([[kernel(d2), one], [one.T, np.zeros((3, 3))]])
    w = np.linalg.lstsq(system, np.vstack([points[:, 2:4], np.zeros((3, 2))]), rcond=None)[0]

    def at(x, y):
        q = np.stack([np.asarray(x), np.asarray(y)], 1) / 1e3
        return np.hstack([kernel(((q[:, None] - p[None]) ** 2).sum(-1)), np.ones((len(q), 1)), q]) @ w

    return at


def metres(found: np.ndarray, want: np.ndarray) -> np.ndarray:
    d = (found - want) * np.stack([np.cos(np.radians(found[:, 1])) * 111320.0, np.full(len(found), 110540.0)], 1)
    return np.sqrt((d * d).sum(1))


def leave_one_out(points: np.ndarray, model: str) -> np.ndarray:
    """The error in metres of each point under the model fitted to the others: poly1, poly2, poly3 or tps."""
    out = []
    for k in range(len(points)):
        rest, one = np.delete(points, k, 0), points[k : k + 1]
        found = thin_plate(rest)(one[:, 0], one[:, 1]) if model == "tps" else design(one[:, 0], one[:, 1], int(model[-1])) @ polynomial(rest, int(model[-1]))
        out.append(metres(found, one[:, 2:4])[0])
    return np.array(out)


def select_model(points: np.ndarray, models=("poly1", "poly2", "tps")) -> tuple[str, dict[str, tuple[float, float]]]:
    """The model with the smallest median error left out, and (median, maximum) of each."""
    found = {m: (float(np.median(e)), float(e.max())) for m in models for e in [leave_one_out(points, m)]}
    return min(found, key=lambda m: (found[m][0], models.index(m))), found


def robust(points: np.ndarray, fixed: np.ndarray, order: int = 1, rounds: int = 8, factor: float = 2.5, least: float = 350.0) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, kept): refit without points beyond max(factor x median, least) metres until none changes; fixed ones stay."""
    keep = np.ones(len(points), bool)
    for _ in range(rounds):
        c = polynomial(points[keep], order)
        r = metres(design(points[:, 0], points[:, 1], order) @ c, points[:, 2:4])
        new = (r <= max(factor * float(np.median(r[keep])), least)) | fixed
        if (new == keep).all():
            break
        keep = new
    return polynomial(points[keep], order), keep
