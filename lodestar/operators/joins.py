"""Joins that Spark has no name for: by grid cell, by preference, by uniqueness, in tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grid_join(left: DataFrame, right: DataFrame, radius: int, left_xy=("x", "y"), right_xy=("gx", "gy"), chebyshev: bool = False, same: tuple[str, ...] = ()) -> DataFrame:
    """Pairs within ``radius`` (inclusive; Chebyshev: strictly nearer on both axes), each once.

    The left rows go to the nine cells around their own (so put the smaller side there); right rows stay in one. A band join becomes an equi
    join on the cell, which AQE can split where a cell is crowded; ``same`` names columns of both that must be equal too. No side is broadcast: a table whose file is small can be large in memory.
    """
    cell = lambda c: F.floor(F.col(c) / radius)
    around = F.explode(F.array(*[F.struct((cell(left_xy[0]) + i).alias("cx"), (cell(left_xy[1]) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    near = left.withColumn("_c", around).select("*", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy")).drop("_c")
    own = right.withColumn("_cx", cell(right_xy[0])).withColumn("_cy", cell(right_xy[1]))
    dx, dy = F.col(left_xy[0]) - F.col(right_xy[0]), F.col(left_xy[1]) - F.col(right_xy[1])
    close = (F.abs(dx) < radius) & (F.abs(dy) < radius) if chebyshev else dx * dx + dy * dy <= radius * radius
    return near.join(own.hint("merge"), ["_cx", "_cy", *same]).where(close).drop("_cx", "_cy")


def best_of(df: DataFrame, keys: list[str], *order: Column, n: int = 1) -> DataFrame:
    """The first n rows of each key in a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def unique_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join with the rows of right whose key is there exactly once."""
    single = right.groupBy(on).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in right.columns if c != on]).where("_n = 1").drop("_n")
    return left.join(single, on)


def preferred(df: DataFrame, key: str, kind: str, preference: list[str], *tie: Column) -> DataFrame:
    """One row a key: the kind that stands first in the preference, any other after all."""
    place = F.array_position(F.array(*map(F.lit, preference)), F.col(kind))
    return best_of(df, [key], F.when(place == 0, len(preference) + 1).otherwise(place), *tie)


def resolve(names: DataFrame, rows: DataFrame, key: str, kind: str, preference: list[str], *tie: Column) -> DataFrame:
    """names with the columns of the row that ``preferred`` picks for its key. A name without any row fails the query, naming it."""
    found = preferred(rows, key, kind, preference, *tie).withColumn("_found", F.lit(True))
    return names.join(found, key, "left").withColumn("_ok", F.when(F.col("_found"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no row for "), F.coalesce(F.col(key), F.lit("a null name")))).cast("boolean"))).where("_ok").drop("_found", "_ok")


def required(df: DataFrame, *columns: str) -> DataFrame:
    """df; the query fails where one of the columns is null."""
    for c in columns:
        df = df.where(F.when(F.col(c).isNotNull(), F.lit(True)).otherwise(F.raise_error(F.lit(f"a row lacks {c}")).cast("boolean")))
    return df


def nearest(left: DataFrame, right: DataFrame, radius: int, key: str, tie: str, same: tuple[str, ...] = ()) -> DataFrame:
    """Pairs with d2: for each left key (rows with x, y) the nearest right row (gx, gy) within radius, the first by tie of equals.

    Small cells are searched first, and an eighth of the radius; what is found there is the nearest. Only the other rows look in the whole radius, so crowded places give few pairs.
    """
    d2 = (F.col("x") - F.col("gx")) * (F.col("x") - F.col("gx")) + (F.col("y") - F.col("gy")) * (F.col("y") - F.col("gy"))
    best = lambda rows, r: best_of(grid_join(rows, right, r, same=same).withColumn("d2", d2), [key], F.col("d2"), F.col(tie))
    first = best(left, max(1, radius // 8))
    return first.unionByName(best(left.join(first.select(key), key, "left_anti"), radius))


def claims(old: DataFrame, new: DataFrame, near: int, blind: int) -> DataFrame:
    """(old_id, new_id, tier, d2): for each old row the nearest new row with the same key within near (tier 1), else the nearest at all within blind (tier 2).

    old: old_id, key, x, y; new: new_id, nkey, gx, gy.
    """
    old, new = old.select("old_id", "key", "x", "y"), new.select("new_id", F.col("nkey").alias("key"), "gx", "gy")
    named = nearest(old, new, near, "old_id", "new_id", ("key",)).select("old_id", "new_id", F.lit(1).alias("tier"), "d2")
    rest = old.join(named.select("old_id"), "old_id", "left_anti").select("old_id", "x", "y")
    return named.unionByName(nearest(rest, new.drop("key"), min(near, blind), "old_id", "new_id").select("old_id", "new_id", F.lit(2).alias("tier"), "d2"))


def remap(old: DataFrame, new: DataFrame, near: int, blind: int) -> DataFrame:
    """The claims that hold: of several on one new row that of the best tier, then the nearest, then the smallest old id."""
    return best_of(claims(old, new, near, blind), ["new_id"], F.col("tier"), F.col("d2"), F.col("old_id"))


def remap_report(old: DataFrame, new: DataFrame, near: int, blind: int) -> DataFrame:
    """(old_id, new_id, tier, d2, winner) of all old rows: the claims with the old row that holds the new one, and rows without a claim (nulls)."""
    first = F.first("old_id").over(Window.partitionBy("new_id").orderBy("tier", "d2", "old_id"))
    made = claims(old, new, near, blind).withColumn("winner", first)
    return old.select("old_id").join(made, "old_id", "left")


def overlap_conflicts(boxes: DataFrame, overlap, iou: float, inside: float, before: DataFrame | None = None) -> DataFrame:
    """(id, over) where the later box (id) of a pair, by rank, overlaps the earlier one by over ``iou`` of both or over ``inside`` of the smaller, and its centre is within its own reach. The earlier ones
    are ``before``, or boxes themselves.

    boxes: id, poly, area, bounds, x, y, reach, rank; overlap gives the common area of two polygons, and is asked only where that of the bounds would do. A later box looks in the cells of its own size class around
    its centre, so a wide one does not widen the search of the others: reaches are rounded up to powers of two, and the earlier boxes stand in the cells of every class that occurs.
    """
    size = F.ceil(F.log2(F.greatest(F.col("reach"), F.lit(1.0)))).cast("int")
    late = boxes.withColumn("_k", size)
    classes = late.select("_k").distinct()  # as many rows as there are powers of two among the reaches
    cell = lambda c, k: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col(k)))
    around = F.explode(F.array(*[F.struct((cell("x", "_k") + i).alias("cx"), (cell("y", "_k") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    late = late.withColumn("_c", around).select("id", "poly", "area", "bounds", "x", "y", "reach", "rank", "_k", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy"))
    early = (boxes if before is None else before).join(F.broadcast(classes)).withColumns({"_cx": cell("x", "_k"), "_cy": cell("y", "_k")})
    early = early.select("_k", "_cx", "_cy", F.col("id").alias("over"), F.col("poly").alias("poly2"), F.col("area").alias("area2"), F.col("bounds").alias("bounds2"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("rank").alias("rank2"))
    dx, dy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    pairs = late.join(early, ["_k", "_cx", "_cy"]).where(F.col("rank2") < F.col("rank")).where(dx * dx + dy * dy <= F.col("reach") * F.col("reach"))
    enough = lambda common: (common > iou * (F.col("area") + F.col("area2") - common)) | (common > inside * F.least("area", "area2"))
    shared = lambda lo, hi: F.greatest(F.least(F.col(f"bounds.{hi}"), F.col(f"bounds2.{hi}")) - F.greatest(F.col(f"bounds.{lo}"), F.col(f"bounds2.{lo}")), F.lit(0.0))
    most = shared("x0", "x1") * shared("y0", "y1")
    pairs = pairs.where(enough(most * (1 + 1e-9) + 1e-9))  # the common area of the polygons is no larger, but for rounding
    return pairs.select("id", "over", "area", "area2", overlap(F.col("poly"), F.col("poly2")).alias("common")).where(enough(F.col("common"))).select("id", "over")


def greedy_apart(boxes: DataFrame, overlap, iou: float, inside: float, root: str, first: int = 2000) -> DataFrame:
    """Ids kept when boxes are taken in order of rank and one is dropped if it conflicts (see ``overlap_conflicts``) with a kept one.

    In batches by rank, each four times the ones before together: what conflicts with a kept box goes, and only the others are paired among themselves. So a box is held against the kept ones around it, which
    the conflicts keep few, and not against all its neighbours. Each step is written under root.
    """
    from lodestar.operators.graph import _saved
    from lodestar.operators.windows import numbered

    boxes = _saved(numbered(_saved(boxes, root), root, F.col("rank")), root)
    n, done, kept = boxes.count(), 0, None
    while done < n:
        upto = max(first, 4 * done)
        batch = boxes.where((F.col("number") >= done) & (F.col("number") < upto)).drop("number")
        if kept is not None:
            gone = overlap_conflicts(batch, overlap, iou, inside, kept).select("id").distinct()
            batch = _saved(batch.join(gone, "id", "left_anti"), root)
        stay = greedy_keep(batch, _saved(overlap_conflicts(batch, overlap, iou, inside), root), root)
        stay = _saved(batch.join(stay, "id", "left_semi"), root)
        kept, done = stay if kept is None else kept.union(stay), upto
    return (boxes if kept is None else kept).select("id")


def greedy_keep(boxes: DataFrame, conflicts: DataFrame, root: str) -> DataFrame:
    """Ids kept when boxes are taken in order of rank and one is dropped if it conflicts with a kept one.

    boxes: id, rank (a value or struct, smaller first, no ties); conflicts: id, over (the ids of a pair, either way). Rounds: a box without an undecided
    conflicting box before it is kept, its conflicts are dropped. Each round is written under root.
    """
    from lodestar.operators.graph import _saved

    spark = boxes.sparkSession
    both = conflicts.select("id", "over").union(conflicts.select("over", "id")).toDF("id", "over").distinct()
    ranks = boxes.select("id", "rank")
    up = _saved(both.join(ranks, "id").join(ranks.select(F.col("id").alias("over"), F.col("rank").alias("r2")), "over").where("r2 < rank").select("id", "over"), root)
    open_, kept = _saved(boxes.select("id"), root), None
    while open_.limit(1).count():
        blocked = up.join(open_, "id", "left_semi").join(open_.select(F.col("id").alias("over")), "over", "left_semi").select("id").distinct()
        now = _saved(open_.join(blocked, "id", "left_anti"), root)
        dropped = up.join(now.select(F.col("id").alias("over")), "over", "left_semi").select("id").distinct()
        open_ = _saved(open_.join(now, "id", "left_anti").join(dropped, "id", "left_anti"), root)
        kept = now if kept is None else kept.union(now)
    return spark.createDataFrame([], boxes.select("id").schema) if kept is None else kept
