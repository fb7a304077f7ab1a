"""The radius join against brute force (numpy haversine) on generated
points: near the search radius, across the antimeridian, near the poles."""
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from enrichkit.operators.radius import EARTH_RADIUS_M, poi_counts

R_M = 700.0


def _brute(points, places):
    out = {}
    for pid, la, lo in points:
        p1 = math.radians(la)
        n = 0
        for _, pla, plo in places:
            p2 = math.radians(pla)
            a = (math.sin((p2 - p1) / 2) ** 2
                 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(plo) - math.radians(lo)) / 2) ** 2)
            n += 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(a))) <= R_M
        out[pid] = n
    return out


def _near(center_lat, center_lon, count, rng, spread_m):
    deg = spread_m / 111195.0
    pts = []
    for _ in range(count):
        la = max(-90.0, min(90.0, center_lat + rng.uniform(-deg, deg)))
        lo = center_lon + rng.uniform(-deg, deg) / max(math.cos(math.radians(la)), 1e-3)
        lo = ((lo + 180.0) % 360.0) - 180.0
        pts.append((la, lo))
    return pts


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), center=st.sampled_from([(10.7, 106.6), (0.0, 179.999), (-45.0, -179.9995),
                                                            (85.0, 20.0), (89.995, 0.0), (-89.998, 120.0)]))
def test_poi_counts_equals_brute_force(spark, seed, center):
    rng = np.random.default_rng(seed)
    pts = [(i, la, lo) for i, (la, lo) in enumerate(_near(*center, 25, rng, 1200))]
    plc = [(i, la, lo) for i, (la, lo) in enumerate(_near(*center, 60, rng, 1200))]
    points = spark.createDataFrame(pts, "point_id int, lat double, lon double")
    places = spark.createDataFrame([(i, la, lo, ["bank"], True) for i, la, lo in plc],
                                   "place_id int, lat double, lon double, types array<string>, operational boolean")
    got = {r.point_id: r["count"] for r in poi_counts(points, places, {"fin": ["bank"]}, R_M).collect()}
    assert got == _brute(pts, plc)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), center=st.sampled_from([(10.7, 106.6), (0.0, 179.999), (-45.0, -179.9995), (0.003, 180.0),
                                                            (85.0, 20.0), (89.995, 0.0), (-89.998, 120.0)]))
def test_dense_cells_equal_brute_force(spark, seed, center):
    """All grid cells have a fine grid: covered cells, border cells and places
    on the border itself."""
    from enrichkit.operators import radius
    rng = np.random.default_rng(seed)
    pts = [(i, la, lo) for i, (la, lo) in enumerate(_near(*center, 20, rng, 1200))]
    spots = _near(*center, 250, rng, 1500)
    spots += [(la + math.degrees(R_M / EARTH_RADIUS_M), lo) for _, la, lo in pts[:5] if la < 89]   # at the radius
    spots += [(la, lo) for _, la, lo in pts[5:8]] + spots[:10] + [(center[0], 180.0), (center[0], -180.0)]
    plc = [(i, la, lo) for i, (la, lo) in enumerate(spots)]
    points = spark.createDataFrame(pts, "point_id int, lat double, lon double")
    places = spark.createDataFrame([(i, la, lo, ["bank"] if i % 3 else ["shop"], True) for i, la, lo in plc],
                                   "place_id int, lat double, lon double, types array<string>, operational boolean")
    old = radius.DENSE_PLACES, radius.FINE_PLACES, radius.CELL_PLACES
    radius.DENSE_PLACES, radius.FINE_PLACES, radius.CELL_PLACES = 4, 2, 8
    try:
        out = poi_counts(points, places, {"fin": ["bank"], "com": ["shop"], "any": ["shop", "bank"]}, R_M).collect()
    finally:
        radius.DENSE_PLACES, radius.FINE_PLACES, radius.CELL_PLACES = old
    got = {(r.point_id, r.scenario): r["count"] for r in out}
    for name, keep in (("fin", lambda i: i % 3), ("com", lambda i: i % 3 == 0), ("any", lambda i: True)):
        assert {p: got[p, name] for p, _, _ in pts} == _brute(pts, [x for x in plc if keep(x[0])])


def test_places_met_one_by_one_grow_with_the_root_of_the_density(spark):
    from pyspark.sql import functions as F

    from enrichkit.operators import radius
    grid = radius._Grid(R_M)
    met = {}
    for n in (4_000, 64_000):
        rng = np.random.default_rng(n)
        spots = spark.createDataFrame([(float(a), float(b), 1) for a, b in zip(
            rng.uniform(10.70, 10.72, n), rng.uniform(106.60, 106.62, n), strict=True)], "_plat double, _plon double, _c0 int")
        cla, clo = grid.place_cell(F.col("_plat"), F.col("_plon"))
        spots = spots.withColumn("cla", cla).withColumn("clo", clo)
        count = spots.groupBy("cla", "clo").agg(F.ceil(F.sqrt(F.count(F.lit(1)) / radius.FINE_PLACES)).cast("int").alias("m")) \
            .withColumn("parts", F.lit(1))
        placed, fine = radius.fine_cells(spots.join(count, ["cla", "clo"]), grid, 1)
        points = spark.createDataFrame([(10.71 + i * 1e-4, 106.61) for i in range(10)], "_lat double, _lon double")
        cells = points.select("*", F.explode(grid.point_cells(F.col("_lat"), F.col("_lon"))).alias("_c")).select(
            "_lat", "_lon", "_c.cla", "_c.clo", F.lit(0).alias("part"))
        near = radius.near_fine_cells(cells, fine, R_M)
        per = near.filter("NOT covered").join(placed, ["cla", "clo", "fi", "fj"]).count() / 10
        met[n] = per
        inside = near.agg(F.sum("_f0")).first()[0] / 10
        assert per < (0.75 if n == 4_000 else 0.25) * inside
    assert met[64_000] < 6 * met[4_000]          # sixteen times the places
