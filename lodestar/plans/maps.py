"""Queries on the sheet: slanted boxes, ribbons, tiles, masks, polygons, near duplicates across windows, fits applied."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import geo, polygon
from lodestar.functions import text as T
from lodestar.operators import fit, joins, windows
from lodestar.plans.registry import _POINTS, _points, query, root
from lodestar.plans.stand_ins import load

#: Boxes as slanted polygons: the upper edge falls by s over the width.
_POLY = ", d AS (SELECT id, x, y, w, h, score, win, id % 90 - 30 AS s, x + w // 2 AS cx, y + h // 2 AS cy FROM boxes), ax AS (SELECT *, degrees(atan2(s::DOUBLE, w::DOUBLE)) AS axis FROM d)"
_HEIGHT = "(greatest({0}, {1}, {2}, {3}) - least({0}, {1}, {2}, {3}))".format(*[f"(({y}) * cos(radians(axis)) - ({x}) * sin(radians(axis)))" for x, y in (("x", "y"), ("x + w", "y + s"), ("x + w", "y + s + h"), ("x", "y + h"))])


def detections(spark, sf):
    """Boxes with poly (upper edge first), their slant s and the centre of the box."""
    b = load(spark, sf, "boxes").withColumn("s", F.col("id") % 90 - 30)
    x, y, w, h, s = (F.col(c) for c in "xywhs")
    corner = lambda px, py: F.struct(px.alias("x"), py.alias("y"))
    poly = F.array(corner(x, y), corner(x + w, y + s), corner(x + w, y + s + h), corner(x, y + h))
    return b.withColumns({"poly": poly, "cx": F.expr("x + w div 2"), "cy": F.expr("y + h div 2")})


@query(_POLY + f" SELECT id, round_even(axis, 6) AS axis, abs(axis) > 20 AS steep, round_even({_HEIGHT}, 6) AS height FROM ax")
def tilt_split(spark, sf):
    """The axis of each detection, whether it is steep, and its height across the axis."""
    d = detections(spark, sf)
    a = geo.axis(F.col("poly"))
    return d.select("id", F.bround(a, 6).alias("axis"), (geo.tilt(F.col("poly")) > 20).alias("steep"), F.bround(geo.height_across(F.col("poly"), a), 6).alias("height"))


@query(_POLY + ", m AS (SELECT id // 3 AS g, id, abs(axis) > 20 AS steep FROM ax) SELECT id, g FROM m WHERE g NOT IN (SELECT g FROM m GROUP BY g HAVING 2 * count(*) FILTER (steep) >= count(*))")
def majority_drop(spark, sf):
    """Groups of boxes, without those of which half or more are steep."""
    d = detections(spark, sf).select("id", F.expr("id div 3").alias("g"), "poly")
    return windows.majority_drop(d, "g", geo.tilt(F.col("poly")) > 20).select("id", "g")


_ANGLE = "least(({0} - {1} + 360) % 180, 180 - ({0} - {1} + 360) % 180)"


@query(_POLY + f""", hs AS (SELECT *, {_HEIGHT} AS height FROM ax), med AS (SELECT list_sort(list(height))[count(*) // 2 + 1] AS m FROM hs),
 pr AS (SELECT a.id AS src, b.id AS dst, a.axis AS aa, b.axis AS ba, ((degrees(atan2((b.cy - a.cy)::DOUBLE, (b.cx - a.cx)::DOUBLE)) + 90 + 360) % 180) - 90 AS seg, (b.cx - a.cx) * (b.cx - a.cx) + (b.cy - a.cy) * (b.cy - a.cy) AS d2 FROM hs a JOIN hs b ON a.id < b.id AND abs(a.cx - b.cx) < 300 AND abs(a.cy - b.cy) < 300),
 e AS (SELECT src, dst FROM pr, med WHERE d2 > 0 AND d2 < 90000 AND {_ANGLE.format("seg", "aa")} <= 24 AND {_ANGLE.format("seg", "ba")} <= 24 AND {_ANGLE.format("aa", "ba")} <= 24 AND abs(sqrt(d2::DOUBLE) * sin(radians({_ANGLE.format("seg", "aa")}))) <= 0.7 * m),
 r(node, reach) AS (SELECT src, src FROM e UNION SELECT dst, dst FROM e UNION SELECT r.node, CASE WHEN r.reach = e.src THEN e.dst ELSE e.src END FROM r JOIN e ON r.reach IN (e.src, e.dst)), c AS (SELECT node, min(reach) AS ribbon FROM r GROUP BY node)
 SELECT hs.id, coalesce(ribbon, hs.id) AS ribbon, row_number() OVER (PARTITION BY coalesce(ribbon, hs.id) ORDER BY cx * cos(radians(axis)) + cy * sin(radians(axis)), hs.id)::INTEGER AS place FROM hs LEFT JOIN c ON c.node = hs.id""")
def ribbons(spark, sf):
    """Chains of boxes along one line, each in its order along the axis."""
    return windows.ribbons(detections(spark, sf), root(spark))


@query("SELECT id, win, row_number() OVER (PARTITION BY win ORDER BY round_even(y / 40.0::DOUBLE, 0), x, id)::INTEGER AS place FROM boxes")
def reading_order(spark, sf):
    return windows.reading_order(load(spark, sf, "boxes").select("id", "win", "x", "y"), "win", "x", "y", 40, "id").select("id", "win", "place")


@query(_POLY + " SELECT id, round_even(cx * cos(radians(axis)) + cy * sin(radians(axis)), 4) AS u, round_even(cy * cos(radians(axis)) - cx * sin(radians(axis)), 4) AS v FROM ax")
def deskewed(spark, sf):
    """Centres in the frame along each box's axis."""
    d = detections(spark, sf).withColumn("a", geo.axis(F.col("poly")))
    u, v = geo.rotated(F.col("cx"), F.col("cy"), F.col("a"))
    return d.select("id", F.bround(u, 4).alias("u"), F.bround(v, 4).alias("v"))


@query("SELECT win, round_even((((degrees(atan2(2 * covar_pop(x::DOUBLE, y::DOUBLE), var_pop(x::DOUBLE) - var_pop(y::DOUBLE))) / 2 + 90) + 180) % 180) - 90, 6) AS axis FROM boxes GROUP BY win")
def principal_axis(spark, sf):
    return load(spark, sf, "boxes").groupBy("win").agg(F.bround(geo.principal_axis("x", "y"), 6).alias("axis"))


@query("SELECT id, win * 512 + x / 2.0::DOUBLE AS x0, win * 512 + (x + w) / 2.0::DOUBLE AS x1 FROM boxes")
def tile_to_master(spark, sf):
    """Coordinates in a tile at twice the size as those of the sheet."""
    b = load(spark, sf, "boxes").withColumn("xs", geo.to_master(F.array("x", F.col("x") + F.col("w")), F.col("win") * 512, F.lit(2.0)))
    return b.select("id", F.col("xs")[0].alias("x0"), F.col("xs")[1].alias("x1"))


_MASK = ", px AS (SELECT DISTINCT floor(x / 40.0::DOUBLE)::BIGINT AS px, floor(y / 40.0::DOUBLE)::BIGINT AS py FROM boxes), pk AS (SELECT px, py, py * 2147483648 + px AS k FROM px)"


@query(_MASK + """, e AS (SELECT a.k AS src, b.k AS dst FROM pk a JOIN pk b ON b.k = a.k + 1 OR b.k = a.k + 2147483648), r(node, reach) AS (SELECT k, k FROM pk UNION SELECT r.node, CASE WHEN r.reach = e.src THEN e.dst ELSE e.src END FROM r JOIN e ON r.reach IN (e.src, e.dst)),
 c AS (SELECT node, min(reach) AS component FROM r GROUP BY node) SELECT component, count(*) AS area, round_even(avg(px::DOUBLE), 6) AS cx, round_even(avg(py::DOUBLE), 6) AS cy FROM c JOIN pk ON pk.k = c.node GROUP BY component HAVING count(*) BETWEEN 2 AND 60""")
def mask_blobs(spark, sf):
    """Blobs of a mask of cells that have boxes, those of two to sixty cells."""
    p = load(spark, sf, "boxes").select(F.floor(F.col("x") / 40).alias("px"), F.floor(F.col("y") / 40).alias("py"))
    return windows.mask_components(p, root(spark), 2, 60).select("component", "area", F.bround("cx", 6).alias("cx"), F.bround("cy", 6).alias("cy"))


#: Gazetteer rows with a place (a pixel is 10 m here) and a reading; ids of two tracks, B and C, in twelve windows each.
_READ = ", q AS (SELECT id, CASE WHEN id % 2 = 0 THEN 'B' ELSE 'C' END || printf('%02d', id % 12) AS win, trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(name), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', ' ', 'g'), ' +', ' ', 'g')) AS n, 2.3::DOUBLE + gx * 0.0001167::DOUBLE AS lon, 39.2::DOUBLE + gy * 0.00009::DOUBLE AS lat FROM gazetteer)"


@query(_READ + """ SELECT a.id AS a, b.id AS b, a.win[1] <> b.win[1] AS cross_track FROM q a JOIN q b ON a.id < b.id AND a.win <> b.win AND length(a.n) >= 3 AND abs(a.lat - b.lat) < 0.006 AND abs(a.lon - b.lon) < 0.008
 WHERE 1 - levenshtein(a.n, b.n)::DOUBLE / greatest(length(a.n), length(b.n)) >= 0.85
 AND 2 * 6371000.0::DOUBLE * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) < 600""")
def cross_window_pairs(spark, sf):
    """Names read alike in different windows less than 600 m apart. Cells of 600 m of latitude (and, at 45 degrees or less, as much of longitude) find the pairs; guards go from cheap to dear."""
    win = F.concat(F.when(F.col("id") % 2 == 0, "B").otherwise("C"), F.format_string("%02d", F.col("id") % 12))
    q = load(spark, sf, "gazetteer").select("id", win.alias("win"), T.audit_norm(F.col("name")).alias("n"), (F.lit(2.3) + F.col("gx") * F.lit(0.0001167)).alias("lon"), (F.lit(39.2) + F.col("gy") * F.lit(0.00009)).alias("lat"))
    q = q.where(F.length("n") >= 1).withColumns({"x": F.col("lon") * (111195 * 0.7), "y": F.col("lat") * 111195, "marks": T.letter_marks(F.col("n"))})
    other = q.select(*[F.col(c).alias(f"{c}2") for c in q.columns])
    pairs = joins.grid_join(q, other, 601, ("x", "y"), ("x2", "y2"), chebyshev=True).where("id < id2 and win <> win2 and length(n) >= 3")
    pairs = pairs.where(F.bit_count(F.col("marks").bitwiseXOR(F.col("marks2"))) <= 2 * 0.15 * F.greatest(F.length("n"), F.length("n2")) + 1e-6)  # an edit changes two marks at most
    alike = F.when(F.abs(F.length("n") - F.length("n2")) <= 0.15 * F.greatest(F.length("n"), F.length("n2")), T.lev_ratio(F.col("n"), F.col("n2")) >= 0.85).otherwise(False)
    near = F.when(alike, geo.haversine(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")) < 600).otherwise(False)
    return pairs.where(near).select(F.col("id").alias("a"), F.col("id2").alias("b"), (F.left("win", F.lit(1)) != F.left("win2", F.lit(1))).alias("cross_track"))


@query(", o AS (SELECT avg(gx::DOUBLE) AS mx, avg(gy::DOUBLE) AS my FROM gazetteer) SELECT id, round_even(gx - mx, 6) AS east, round_even(gy - my, 6) AS north FROM gazetteer, o")
def dataset_origin(spark, sf):
    """Coordinates from the mean of the table."""
    g = load(spark, sf, "gazetteer").select("id", "gx", "gy")
    o = g.agg(F.avg(F.col("gx").cast("double")).alias("mx"), F.avg(F.col("gy").cast("double")).alias("my"))  # one row
    return g.join(F.broadcast(o)).select("id", F.bround(F.col("gx") - F.col("mx"), 6).alias("east"), F.bround(F.col("gy") - F.col("my"), 6).alias("north"))


_FIT = _POINTS + ", s AS (SELECT " + ", ".join(f"covar_pop(x::DOUBLE, {t}::DOUBLE) AS x{t}, covar_pop(y::DOUBLE, {t}::DOUBLE) AS y{t}, avg({t}::DOUBLE) AS m{t}" for t in ("lon", "lat")) + ", avg(x::DOUBLE) AS mx, avg(y::DOUBLE) AS my, var_pop(x::DOUBLE) AS xx, var_pop(y::DOUBLE) AS yy, covar_pop(x::DOUBLE, y::DOUBLE) AS xy FROM cp), k AS (SELECT *, " + ", ".join(f"(x{t} * yy - y{t} * xy) / (xx * yy - xy * xy) AS a{t}, (y{t} * xx - x{t} * xy) / (xx * yy - xy * xy) AS b{t}" for t in ("lon", "lat")) + " FROM s)"


@query(_FIT + ", p AS (SELECT id, round_even(mlon + alon * (x - mx) + blon * (y - my), 2) AS lon, round_even(mlat + alat * (x - mx) + blat * (y - my), 2) AS lat FROM toponyms, k) SELECT id, lon, lat, NOT (lon BETWEEN 1000 AND 9000 AND lat BETWEEN 0 AND 9000) AS outside FROM p")
def apply_fit(spark, sf):
    """The affine fit of the control points applied to every toponym; which fall outside a range."""
    f = fit.affine(fit.affine(fit.normal_sums(_points(spark, sf)), "lon"), "lat").select("a_lon", "b_lon", "c_lon", "a_lat", "b_lat", "c_lat")  # one row
    at = lambda t: F.bround(F.col(f"a_{t}") * F.col("x") + F.col(f"b_{t}") * F.col("y") + F.col(f"c_{t}"), 2).alias(t)
    p = load(spark, sf, "toponyms").join(F.broadcast(f)).select("id", at("lon"), at("lat"))
    return p.withColumn("outside", ~(F.col("lon").between(1000, 9000) & F.col("lat").between(0, 9000)))


@query(_FIT + ", e AS (SELECT id, round_even(abs(mlon + alon * (x - mx) + blon * (y - my) - lon), 4) AS error FROM cp, k) SELECT id, error FROM e ORDER BY error DESC, id LIMIT 4")
def worst_residuals(spark, sf):
    """The four control points that fit worst, worst first; the limit is the feature."""
    f = fit.affine(fit.normal_sums(_points(spark, sf)), "lon").select("a_lon", "b_lon", "c_lon")
    e = _points(spark, sf).join(F.broadcast(f)).select("id", F.bround(F.abs(F.col("a_lon") * F.col("x") + F.col("b_lon") * F.col("y") + F.col("c_lon") - F.col("lon")), 4).alias("error"))
    return e.orderBy(F.col("error").desc(), "id").limit(4)


@query(_POLY + " SELECT id, (w * h)::DOUBLE AS area, x + w / 2.0::DOUBLE AS cx, y + (h + s) / 2.0::DOUBLE AS cy, x AS x0, least(y, y + s) AS y0, x + w AS x1, greatest(y + h, y + s + h) AS y1 FROM d WHERE id % 9 <> 0")
def polygon_measures(spark, sf):
    """Area, centre of mass and bounds of polygons; those that are flat are left out."""
    d = detections(spark, sf).withColumn("poly", F.when(F.col("id") % 9 == 0, F.array(F.col("poly")[0], F.col("poly")[1], F.col("poly")[0])).otherwise(F.col("poly")))
    p = d.withColumn("poly", polygon.repaired(F.col("poly"))).withColumns({"area": F.abs(polygon.signed_area(F.col("poly"))), "c": polygon.centroid(F.col("poly")), "b": polygon.bounds(F.col("poly"))}).where("area > 0")
    whole = lambda c: F.col(f"b.{c}").cast("long").alias(c)
    return p.select("id", F.bround("area", 6).alias("area"), F.bround("c.x", 6).alias("cx"), F.bround("c.y", 6).alias("cy"), *map(whole, ("x0", "y0", "x1", "y1")))


@query(None)
def polygon_dedup(spark, sf):
    """Detections that stay when each, by score and area, is dropped if it overlaps one that stays by over .45 of both or .60 of the smaller.

    A pair counts if the centres are no further apart than the longer side of the one that comes later, and 30. Cells of each reach's size class find the pairs.
    """
    d = detections(spark, sf).select("id", "score", "poly")
    d = d.withColumn("poly", polygon.repaired(F.col("poly"))).withColumns({"area": F.abs(polygon.signed_area(F.col("poly"))), "c": polygon.centroid(F.col("poly")), "b": polygon.bounds(F.col("poly"))}).where("area > 0")
    d = d.select("id", polygon.convex(F.col("poly")).alias("poly"), "area", F.col("b").alias("bounds"), F.col("c.x").alias("x"), F.col("c.y").alias("y"), (F.greatest(F.col("b.x1") - F.col("b.x0"), F.col("b.y1") - F.col("b.y0")) + 30).alias("reach"), F.struct((-F.col("score")).alias("s"), (-F.col("area")).alias("a"), F.col("id").alias("i")).alias("rank"))
    return joins.greedy_apart(d, polygon.overlap, 0.45, 0.60, root(spark))


@query("SELECT x // 512 AS col, y // 512 AS row, count(*) AS n, round_even(stddev_pop(h::DOUBLE), 6) AS ink FROM boxes WHERE x >= 0 AND y >= 0 GROUP BY 1, 2 HAVING stddev_pop(h::DOUBLE) >= 20")
def ink_gate(spark, sf):
    """Tiles with enough variation to be worth reading; the others are skipped."""
    tiles = load(spark, sf, "boxes").where("x >= 0 and y >= 0").groupBy(F.expr("x div 512").alias("col"), F.expr("y div 512").alias("row"))
    return tiles.agg(F.count("*").alias("n"), F.stddev_pop(F.col("h").cast("double")).alias("ink")).where("ink >= 20").withColumn("ink", F.bround("ink", 6))
