"""Which zone a point lies in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos.plans.staging import bounded_join, stage


def inside(ring: Column, lon: Column, lat: Column) -> Column:
    """Whether a ring (array of lon, lat; closed or not) holds the point: a ray to the east crosses it an odd number of times."""
    after = lambda i: F.get(ring, F.pmod(i + 1, F.size(ring)))

    def crosses(a: Column, b: Column) -> Column:
        share = F.try_divide(lat - a["lat"], b["lat"] - a["lat"])
        return ((a["lat"] > lat) != (b["lat"] > lat)) & F.coalesce(lon < a["lon"] + (b["lon"] - a["lon"]) * share, F.lit(False))

    return F.size(F.filter(F.transform(ring, lambda a, i: crosses(a, after(i))), lambda x: x)) % 2 == 1


def zone_of(points: DataFrame, zones: DataFrame, lon: str = "lon", lat: str = "lat", name: str = "zone", cell: float = 1.0) -> DataFrame:
    """points with the zone that holds each, null outside of all; where zones overlap the first by name.

    zones has a row (zone, ring) for each polygon. Points and zones meet by the cells of a grid, so no point is compared
    with zones of other places, and a zone goes with all cells of its bounds.
    """
    cells = lambda x: F.floor(x / F.lit(cell)).cast("long")
    span = lambda axis: F.sequence(cells(F.array_min(F.transform("ring", lambda p: p[axis]))), cells(F.array_max(F.transform("ring", lambda p: p[axis]))))
    grid = zones.select("zone", "ring", F.explode(span("lon")).alias("__x"), span("lat").alias("ys")).select("zone", "ring", "__x", F.explode("ys").alias("__y"))
    grid = stage(grid.groupBy("__x", "__y").agg(F.sort_array(F.collect_list(F.struct("zone", "ring"))).alias("__zones")), "grid")
    x, y = F.col(f"`{lon}`"), F.col(f"`{lat}`")
    met = bounded_join(points.withColumns({"__x": cells(x), "__y": cells(y)}), grid, ["__x", "__y"], "left")
    found = F.get(F.filter("__zones", lambda z: inside(z["ring"], x, y)), F.lit(0))["zone"]
    return met.select(*[F.col(f"`{c}`") for c in points.columns], found.alias(name))
