"""Items of the curation tool: matches with their curation, geometry, flags and candidates; multi-valued fields; look-ups by name and place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.joins import best_of

CANDIDATE = "array<struct<grafia:string,municipi:string,lon:double,lat:double>>"


def as_list(c: Column, bar: str = "\\|") -> Column:
    """A value or values joined by a bar as an array: null and empty ones have no element."""
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.split(c, bar))


def legal(values: Column, allowed: tuple[str, ...]) -> Column:
    """The values that are allowed, in order, once each; null if none is."""
    kept = F.array_distinct(F.filter(values, lambda v: v.isin(*allowed)))
    return F.when(F.size(kept) > 0, kept)


def falsy(c: Column, other: Column) -> Column:
    """other where c is null, empty, zero or false."""
    return F.when(c.isNull() | c.cast("string").isin("", "0", "0.0", "false"), other).otherwise(c)


def point_tables(gazetteer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points by (grafia, municipi) and by grafia alone; of several rows with a name the first (by id)."""
    both = best_of(gazetteer, ["name", "municipi"], F.col("id")).select(F.col("name").alias("_name"), F.col("municipi").alias("_place"), F.struct("lon", "lat").alias("exact"))
    alone = best_of(gazetteer, ["name"], F.col("id")).select(F.col("name").alias("grafia"), F.struct("lon", "lat").alias("loose"))
    return both, alone


def located(candidates: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """candidates (id, rank, grafia, municipi) with lon and lat: by name and place, else by name, else null."""
    both, alone = point_tables(gazetteer)
    rows = candidates.join(both, F.expr("grafia = _name and municipi <=> _place"), "left").drop("_name", "_place").join(alone, "grafia", "left")
    at = F.coalesce("exact", "loose")
    return rows.withColumns({"lon": at["lon"], "lat": at["lat"]}).drop("exact", "loose")


def candidate_lists(located_rows: DataFrame, n: int = 6) -> DataFrame:
    """(id, candidates): the first n by rank, as an array."""
    rows = F.sort_array(F.collect_list(F.struct("rank", "grafia", "municipi", "lon", "lat")))
    some = F.transform(F.slice(rows, 1, n), lambda r: F.struct(r["grafia"].alias("grafia"), r["municipi"].alias("municipi"), r["lon"].alias("lon"), r["lat"].alias("lat")))
    return located_rows.where(F.col("rank") <= n).groupBy("id").agg(some.alias("candidates"))


def with_current(candidates: Column, grafia: Column, municipi: Column, n: int = 6) -> Column:
    """The first n candidates, the current match before them if its name is none of theirs; unchanged without a match."""
    here = F.exists(candidates, lambda c: c["grafia"] == grafia)
    current = F.array(F.struct(grafia.alias("grafia"), municipi.alias("municipi"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat")))
    return F.slice(F.when(grafia.isNull() | (grafia == "") | here, candidates).otherwise(F.concat(current, candidates)), 1, n)


def assemble(matches: DataFrame, curation: DataFrame, geometry: DataFrame, flags: DataFrame, candidates: DataFrame) -> DataFrame:
    """One item a match: its own fields, the curation's where there are any (with the originals beside them and what was edited), place, flags, candidates.

    matches: id, nom, graf, tipus, ordre, decision, review, ngib, municipi, km, sim. curation: id, verdict, match, graf, tipus, ordre (null: not edited; empty: cleared). geometry: id, x, y,
    lon, lat, dubte. flags: id, flags. candidates: id, candidates. Each of the four has one row an id.
    """
    c = curation.select("id", *[F.col(k).alias(f"c_{k}") for k in ("verdict", "match", "graf", "tipus", "ordre")])
    j = matches.join(c, "id", "left").join(geometry.select("id", "x", "y", "lon", "lat", "dubte"), "id", "left").join(flags, "id", "left").join(candidates, "id", "left")
    none = lambda k: F.when(F.col(k).isNull() | (F.col(k) == ""), None).otherwise(F.col(k))
    multi = {}
    for k in ("tipus", "ordre"):
        own, new = as_list(F.col(k)), as_list(F.coalesce(F.col(f"c_{k}"), F.col(k)))
        multi |= {k: new.alias(k), f"{k}0": own.alias(f"{k}0"), f"{k}_edited": (F.col(f"c_{k}").isNotNull() & (F.array_join(new, "|") != F.array_join(own, "|"))).alias(f"{k}_edited")}
    return j.select(
        "id", "x", "y", "lon", "lat", F.coalesce("dubte", F.lit(False)).alias("dubte"), F.coalesce("flags", F.array().cast("array<string>")).alias("flags"),
        F.coalesce("c_graf", "graf").alias("graf"), F.col("graf").alias("graf0"), "nom", *multi.values(), "decision", none("review").alias("review"), none("ngib").alias("ngib"), none("municipi").alias("municipi"), "km", "sim",
        F.coalesce("candidates", F.array().cast(CANDIDATE)).alias("candidates"), none("c_verdict").alias("pend"), none("c_match").alias("pend_pick"),
        (F.col("c_graf").isNotNull() & ~F.col("c_graf").eqNullSafe(F.col("graf"))).alias("graf_edited"), F.coalesce(F.col("c_verdict") == "trash", F.lit(False)).alias("discarded"),
    )


def first_and_last(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, first, last): what a map built row by row keeps of a key that comes again, if the first or the last row wins."""
    return df.groupBy(key).agg(F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))
