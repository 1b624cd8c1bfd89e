"""Facets of the published table, the curation table, the map and the card queue: one builder, four presets.

A facet that is not set (None or empty) lets every row through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    """Whether a value counts as none: null or empty."""
    return c.isNull() | (c == "")


def has_text(text: str | None, *columns: str) -> Column:
    """The trimmed, lower-cased text stands in the columns, joined by spaces."""
    t = (text or "").strip().lower()
    return F.lit(True) if not t else F.contains(F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])), F.lit(t))


def equals(column: str, value: str | None) -> Column:
    return F.lit(True) if not value else F.coalesce(F.col(column) == value, F.lit(False))


def member(column: str, value: str | None) -> Column:
    """A value among those of an array column; ``__any`` and ``__none`` ask whether there are any."""
    has = F.coalesce(F.size(column) > 0, F.lit(False))
    if not value:
        return F.lit(True)
    return {"__any": has, "__none": ~has}.get(value, F.coalesce(F.array_contains(column, value), F.lit(False)))


def tri_state(column: str, value: str | None, some: str = "any", none: str = "none") -> Column:
    """any value, no value, or one value."""
    if not value:
        return F.lit(True)
    return {some: ~blank(F.col(column)), none: blank(F.col(column))}.get(value, F.coalesce(F.col(column) == value, F.lit(False)))


def distance(column: str, value: str | None) -> Column:
    """lt1, 1-3 (both ends in) or gt3 kilometres; rows without a distance are out once the facet is set."""
    k = F.col(column)
    if not value:
        return F.lit(True)
    return F.coalesce({"lt1": k < 1, "1-3": k.between(1, 3), "gt3": k > 3}.get(value, k.isNotNull()), F.lit(False))


def problem(column: str, value: str | None) -> Column:
    """prob: rows with flags; any other value: rows without."""
    has = F.coalesce(F.size(column) > 0, F.lit(False))
    return F.lit(True) if not value else has if value == "prob" else ~has


def every(df: DataFrame, *conditions: Column) -> DataFrame:
    for c in conditions:
        df = df.where(c)
    return df


READ = ("graf", "nom", "ngib", "municipi")


def published(df: DataFrame, text=None, decision=None, kind=None, order=None, place=None, matched=None, km=None, review=None) -> DataFrame:
    """The eight facets of the public table; matched is si or anything else for no."""
    has = ~blank(F.col("ngib"))
    match = F.lit(True) if not matched else has if matched == "si" else ~has
    return every(df, equals("decision", decision), member("tipus", kind), member("ordre", order), equals("municipi", place), match, distance("km", km), tri_state("review", review), has_text(text, *READ))


def curated(df: DataFrame, text=None, decision=None, kind=None, order=None, review=None, problems=None) -> DataFrame:
    """The six facets of the curation table."""
    return every(df, equals("decision", decision), member("tipus", kind), member("ordre", order), tri_state("review", review), problem("flags", problems), has_text(text, *READ))


def on_map(df: DataFrame, **facets) -> DataFrame:
    """The same for the map, which leaves out discarded rows and those without a place."""
    return curated(df.where("lon is not null and lat is not null and not coalesce(discarded, false)"), **facets)


def queue(df: DataFrame, **facets) -> DataFrame:
    """The same for the cards: rows without a verdict; review is no facet there."""
    return curated(df.where(blank(F.col("pend"))), **facets)


def queue_with(df: DataFrame, wanted, *order: str, **facets) -> DataFrame:
    """The queue with place: the wanted item at the front, put there if the facets leave it out; the others in order. An item that is not there changes nothing."""
    from pyspark.sql import Window

    inside = queue(df, **facets)
    extra = df.where(F.col("id") == wanted).join(inside.select("id"), "id", "left_anti")
    rows = inside.withColumn("_rank", F.lit(1)).unionByName(extra.withColumn("_rank", F.lit(0)))
    return rows.withColumn("place", F.row_number().over(Window.orderBy("_rank", *order))).drop("_rank")


def viewport(df: DataFrame, zoom: int, west: float, south: float, east: float, north: float, least: int = 12, most: int = 700) -> DataFrame:
    """The first rows by id within a view, sides included; none when zoomed out. The limit is the feature."""
    if zoom < least:
        return df.limit(0)
    return df.where(F.col("lon").between(west, east) & F.col("lat").between(south, north)).orderBy("id").limit(most)


def choices(df: DataFrame, column: str, first: tuple[str, ...] = ()) -> DataFrame:
    """(value, place): the values that a (single or array) column has, known ones first in their order, then the others by themselves; empty ones left out."""
    from pyspark.sql import Window

    kind = df.schema[column].dataType.typeName()
    values = df.select((F.explode(column) if kind == "array" else F.col(column)).alias("value")).where("value is not null and value <> ''").distinct()
    known = F.array_position(F.array(*map(F.lit, first)).cast("array<string>"), F.col("value"))
    order = Window.orderBy(F.when(known == 0, len(first) + 1).otherwise(known), "value")  # as many rows as there are distinct values
    return values.withColumn("place", F.row_number().over(order))


def progress(df: DataFrame) -> DataFrame:
    """One row: all rows, those with a verdict or review, discarded ones."""
    done = ~blank(F.col("pend")) | ~blank(F.col("review"))
    return df.agg(F.count("*").alias("total"), F.count_if(done).alias("done"), F.count_if(F.coalesce("discarded", F.lit(False))).alias("discarded"))
