"""Radius range join (JN-12, JN-11): count places of a scenario's types within
``radius_m`` of each point.

Plan: every place sits in exactly one grid cell (rows of the radius'
angular size; columns of 360/N degrees that wrap at the antimeridian; one
cell per row in the polar caps). Each distinct point coordinate is exploded
to the cells of its exact bounding box (|dlat| <= delta, |dlon| <=
asin(sin delta / cos lat): 3x3 near the equator, wider towards the poles,
so the candidate set stays exact), equi-joined to the places on the cell
key, and the great-circle distance is the residual filter. Each (point, place)
pair meets at most once, because a place has one cell and a point lists each
cell once. The join is a shuffle on the cell key; a hot cell is split by AQE
skew handling, and places are reduced to the few columns needed before it.

A cell with many places has a second level: a finer grid of its own, as fine as
its places are dense, whose cells have prepared counts and the box of their
places. A fine cell wholly inside a point's radius adds its count, one wholly
outside is left out, and only the places of the cells on the border are met one
by one. So a point in a dense city looks at the cells and at a ring of places
whose number grows with the square root of the density, not with it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0
# Rows of grid cells poleward of this latitude are one cell each, so a point
# near a pole never enumerates a whole circle of longitude cells.
POLAR_LAT = 89.0
_MARGIN = 1e-7   # relative widening of the search box against rounding


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dl = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


class _Grid:
    """Cell geometry for one radius: latitude rows of the radius' angular
    size, longitude columns of 360/N degrees (so they wrap at ±180), and one
    cell per row in the polar caps."""

    def __init__(self, radius_m: float):
        self.delta = radius_m / EARTH_RADIUS_M                       # angular radius, radians
        self.lat_cell = math.degrees(self.delta)
        self.n_lon = max(1, int(360.0 // self.lat_cell))
        self.lon_cell = 360.0 / self.n_lon
        self.hi = math.ceil(POLAR_LAT / self.lat_cell)               # rows >= hi are polar
        self.lo = math.floor(-POLAR_LAT / self.lat_cell) - 1         # rows <= lo are polar

    def polar(self, row: Column) -> Column:
        return (row >= F.lit(self.hi)) | (row <= F.lit(self.lo))

    def row(self, lat: Column) -> Column:
        return F.floor(lat / F.lit(self.lat_cell)).cast("bigint")

    def col(self, lon: Column) -> Column:
        return F.pmod(F.floor((lon + F.lit(180.0)) / F.lit(self.lon_cell)).cast("bigint"),
                      F.lit(self.n_lon).cast("bigint"))

    def place_cell(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        r = self.row(lat)
        return r, F.when(self.polar(r), F.lit(-1).cast("bigint")).otherwise(self.col(lon))

    def point_cells(self, lat: Column, lon: Column) -> Column:
        """Every cell a place within the radius can sit in (exact bounding
        box: |dlat| <= delta, |dlon| <= asin(sin delta / cos lat))."""
        dlat = F.lit(math.degrees(self.delta) * (1 + _MARGIN) + 1e-12)
        sin_d = math.sin(self.delta)
        coslat = F.cos(F.radians(lat))
        dlon = F.when(coslat > F.lit(sin_d),
                      F.degrees(F.asin(F.lit(sin_d) / coslat)) * F.lit(1 + _MARGIN) + F.lit(1e-12)) \
            .otherwise(F.lit(180.0))
        dlon = F.least(dlon, F.lit(180.0))
        k0 = F.floor((lon - dlon + F.lit(180.0)) / F.lit(self.lon_cell)).cast("bigint")
        k1 = F.floor((lon + dlon + F.lit(180.0)) / F.lit(self.lon_cell)).cast("bigint")
        k1 = F.least(k1, k0 + F.lit(self.n_lon - 1))
        cols = F.array_distinct(F.transform(F.sequence(k0, k1),
                                            lambda k: F.pmod(k, F.lit(self.n_lon).cast("bigint"))))
        rows = F.sequence(self.row(lat - dlat), self.row(lat + dlat))
        return F.flatten(F.transform(rows, lambda a: F.when(
            self.polar(a), F.array(F.struct(a.alias("cla"), F.lit(-1).cast("bigint").alias("clo"))))
            .otherwise(F.transform(cols, lambda o: F.struct(a.alias("cla"), o.alias("clo"))))))


#: Fine cells, or place coordinates, of one grid cell that one join row group may hold.
CELL_PLACES = 4096
#: A grid cell with more place coordinates gets a fine grid, of this many places a fine cell.
DENSE_PLACES = 512
FINE_PLACES = 32
_SURE_M = 1e-3   # a box this near to the border counts as on it


def _box_reach(half_lat: Column, half_lon: Column, lat_min: Column, lat_max: Column) -> Column:
    """Metres within which all of a latitude-longitude box lies around its
    centre: sin x <= x, and the widest parallel of the box."""
    widest = F.when((lat_min <= 0) & (lat_max >= 0), F.lit(1.0)).otherwise(
        F.greatest(F.cos(F.radians(lat_min)), F.cos(F.radians(lat_max))))
    a = F.pow(F.radians(half_lat) / 2, 2) + F.pow(widest * F.radians(half_lon) / 2, 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def fine_cells(spots: DataFrame, grid: _Grid, n: int) -> tuple[DataFrame, DataFrame]:
    """(the spots with their fine cell ``fi, fj``, the fine cells) of spots that
    have ``m``, the number of fine rows and columns of their grid cell. A fine
    cell has its counts, the centre and reach of the box of its places, and the
    ``part`` it is dealt to."""
    lon = F.when(F.col("_plon") >= 180, F.col("_plon") - 360).otherwise(F.col("_plon"))
    up = F.col("_plat") / grid.lat_cell - F.col("cla")
    across = F.when(F.col("clo") < 0, (lon + 180) / 360).otherwise((lon + 180) / grid.lon_cell - F.col("clo"))
    place = lambda share: F.least(F.greatest(F.floor(share * F.col("m")), F.lit(0)), F.col("m") - 1).cast("int")
    placed = spots.withColumn("_flon", lon).withColumn("fi", place(up)).withColumn("fj", place(across))
    box = placed.groupBy("cla", "clo", "fi", "fj").agg(
        *[F.sum(f"_c{i}").alias(f"_f{i}") for i in range(n)], F.min("_plat").alias("_s"), F.max("_plat").alias("_t"),
        F.min("_flon").alias("_u"), F.max("_flon").alias("_v"), F.first("parts").alias("parts"))
    reach = _box_reach((F.col("_t") - F.col("_s")) / 2, (F.col("_v") - F.col("_u")) / 2, F.col("_s"), F.col("_t"))
    cells = box.select("cla", "clo", "fi", "fj", *[f"_f{i}" for i in range(n)],
                       ((F.col("_s") + F.col("_t")) / 2).alias("_mlat"), ((F.col("_u") + F.col("_v")) / 2).alias("_mlon"),
                       reach.alias("_reach"), F.pmod(F.xxhash64("fi", "fj"), F.col("parts")).cast("int").alias("part"))
    return placed.drop("_flon", "m", "parts"), cells


def near_fine_cells(cells: DataFrame, fine: DataFrame, radius_m: float) -> DataFrame:
    """Points with the fine cells that may hold places within the radius;
    ``covered`` where all of a cell's places do."""
    d = haversine_m(F.col("_lat"), F.col("_lon"), F.col("_mlat"), F.col("_mlon"))
    near = cells.join(fine, ["cla", "clo", "part"]).withColumn("_d", d)
    return (near.filter(F.col("_d") - F.col("_reach") <= radius_m + _SURE_M)
            .withColumn("covered", F.col("_d") + F.col("_reach") <= radius_m - _SURE_M)
            .drop("part", "_d", "_reach", "_mlat", "_mlon"))


def poi_counts_wide(points: DataFrame, places: DataFrame, scenarios: Mapping[str, Sequence[str]],
                    radius_m: float = 700.0, lat: str = "lat", lon: str = "lon",
                    place_key: str = "place_id", place_lat: str = "lat", place_lon: str = "lon",
                    place_types: str = "types", operational: str | None = "operational") -> DataFrame:
    """The rows of ``points`` with one count column ``_n0, _n1, ...`` per scenario:
    distinct operational places within ``radius_m`` whose types overlap the
    scenario's; NULL for a point without coordinates, 0 with nothing near.

    A place id listed more than once is one place (its smallest row). Places
    of one coordinate are counted before the join. A cell with more than
    ``DENSE_PLACES`` coordinates is met through its fine cells (dealt into parts
    by a hash), so neither side of a dense cell has to meet in one task, nor
    every pair at all."""
    grid = _Grid(radius_m)
    names = list(scenarios)
    kinds = [F.arrays_overlap(F.col("_ty"), F.array(*[F.lit(t) for t in scenarios[s]])) for s in names]
    pl = places.filter(F.col(operational)) if operational else places
    one = (pl.groupBy(F.col(place_key).alias("_pk"))
           .agg(F.min(F.struct(F.col(place_lat).try_cast("double").alias("_plat"),
                               F.col(place_lon).try_cast("double").alias("_plon"),
                               F.col(place_types).alias("_ty"))).alias("_p"))
           .select("_p.*").filter(F.col("_plat").isNotNull() & F.col("_plon").isNotNull()))
    spots = one.groupBy("_plat", "_plon").agg(
        *[F.count_if(F.coalesce(k, F.lit(False))).alias(f"_c{i}") for i, k in enumerate(kinds)])
    spots = spots.filter(" OR ".join(f"_c{i} > 0" for i in range(len(names)))) \
        .select("*", *[c.alias(n) for c, n in zip(grid.place_cell(F.col("_plat"), F.col("_plon")), ("cla", "clo"))])
    count = F.count(F.lit(1))
    side = F.when(count > DENSE_PLACES, F.ceil(F.sqrt(count / FINE_PLACES))).otherwise(0).cast("int")
    dens = spots.groupBy("cla", "clo").agg(side.alias("m")).withColumn(
        "parts", F.ceil(F.greatest(F.col("m") * F.col("m"), F.lit(1)) / F.lit(CELL_PLACES)).cast("int"))
    spots = spots.join(dens, ["cla", "clo"])
    sparse = spots.filter("m = 0").drop("m", "parts")
    placed, fine = fine_cells(spots.filter("m > 0"), grid, len(names))

    pts = points.withColumn("_lat", F.col(lat).try_cast("double")).withColumn("_lon", F.col(lon).try_cast("double"))
    # Copies first: many records can share one coordinate (one building may
    # hold a third of all applications). Counts are computed once per
    # distinct coordinate and joined back on it, an equi join whose hot key
    # adaptive execution splits.
    coords = (pts.select("_lat", "_lon").filter(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
              .distinct())
    cells = coords.select("_lat", "_lon",
                          F.explode(grid.point_cells(F.col("_lat"), F.col("_lon"))).alias("_c"))
    cells = (cells.select("_lat", "_lon", F.col("_c.cla").alias("cla"), F.col("_c.clo").alias("clo"))
             .join(dens, ["cla", "clo"]))
    dist = haversine_m(F.col("_lat"), F.col("_lon"), F.col("_plat"), F.col("_plon"))
    single = (cells.filter("m = 0").drop("m", "parts").join(sparse, ["cla", "clo"]).filter(dist <= F.lit(radius_m))
              .select("_lat", "_lon", *[f"_c{i}" for i in range(len(names))]))
    near = near_fine_cells(cells.filter("m > 0").select(
        "_lat", "_lon", "cla", "clo", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), fine, radius_m)
    # a covered cell meets no place: its own counts stand for them
    met = near.join(placed.withColumn("_border", F.lit(False)),
                    [near[k] == placed[k] for k in ("cla", "clo", "fi", "fj")] + [near["covered"] == F.col("_border")], "left")
    many = met.select("_lat", "_lon", *[
        F.when(F.col("covered"), F.col(f"_f{i}")).when(dist <= F.lit(radius_m), F.col(f"_c{i}")).otherwise(0).alias(f"_c{i}")
        for i in range(len(names))])
    hits = single.unionByName(many).groupBy("_lat", "_lon").agg(*[F.sum(f"_c{i}").alias(f"_n{i}") for i in range(len(names))])
    ok = F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    return pts.join(hits, ["_lat", "_lon"], "left").select(
        *[F.col(f"`{c}`") for c in points.columns],
        *[F.when(ok, F.coalesce(F.col(f"_n{i}"), F.lit(0))).cast("bigint").alias(f"_n{i}")
          for i in range(len(names))])


def poi_counts(points: DataFrame, places: DataFrame, scenarios: Mapping[str, Sequence[str]],
               radius_m: float = 700.0, point_key: str = "point_id",
               lat: str = "lat", lon: str = "lon",
               place_key: str = "place_id", place_lat: str = "lat", place_lon: str = "lon",
               place_types: str = "types", operational: str | None = "operational") -> DataFrame:
    """One row per (point, scenario): ``count`` of distinct operational places
    whose types overlap the scenario's type list, within ``radius_m``.

    ``points``: point_key, lat, lon (numeric; invalid rows give NULL counts).
    ``places``: place_key, lat, lon, types ARRAY<STRING>, operational BOOLEAN.
    Points with no place nearby get 0.
    """
    wide = poi_counts_wide(points.select(F.col(point_key).alias("_pt"), F.col(lat).alias("_a"), F.col(lon).alias("_o")),
                           places, scenarios, radius_m, "_a", "_o", place_key, place_lat, place_lon,
                           place_types, operational)
    pairs = F.array(*[F.struct(F.lit(s).alias("scenario"), F.col(f"_n{i}").alias("count"))
                      for i, s in enumerate(scenarios)])
    return (wide.select(F.col("_pt").alias(point_key), F.explode(pairs).alias("_p"))
            .select(point_key, F.col("_p.scenario").alias("scenario"), F.col("_p.count").alias("count")))
