"""The grid join finds exactly the pairs a full comparison finds."""

import math
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbside.fixed_values import EARTH_RADIUS_M
from kerbside.functions import circle_wkt, haversine_m
from kerbside.operators.spatial import join_within


def metres(lat1, lon1, lat2, lon2):
    if None in (lat1, lon1, lat2, lon2):
        return None
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, h)))


def check(spark, left, right, radius, min_m=None, inclusive=True, cell_rows=None):
    def hit(d):
        return d is not None and (d <= radius if inclusive else d < radius) and (min_m is None or d >= min_m)

    expected = sorted(
        (i, j)
        for i, (a, b, c, d) in enumerate(left)
        for j, (x, y) in enumerate(right)
        if hit(metres(a, b, x, y)) or hit(metres(c, d, x, y))
    )
    ldf = spark.createDataFrame([(i, *p) for i, p in enumerate(left)], "i int, a double, b double, c double, d double")
    rdf = spark.createDataFrame([(j, *p) for j, p in enumerate(right)], "j int, lat double, lon double")
    got = join_within(
        ldf, rdf, radius, [("a", "b"), ("c", "d")], ("lat", "lon"), ["d1", "d2"], min_m, inclusive, cell_rows
    ).collect()
    assert sorted((r["i"], r["j"]) for r in got) == expected
    for r in got:
        p, q = left[r["i"]], right[r["j"]]
        for value, want in ((r["d1"], metres(*p[:2], *q)), (r["d2"], metres(*p[2:], *q))):
            assert (value is None) == (want is None) and (want is None or abs(value - want) < 0.01)
    return expected


def around(rng, lat, lon, spread, n):
    return [(max(-90, min(90, lat + rng.uniform(-spread, spread))), lon + rng.uniform(-spread, spread)) for _ in range(n)]


@pytest.mark.parametrize("radius", [50.0, 750.0, 2000.0, 20000.0])
@pytest.mark.parametrize(("lat", "lon"), [(48.86, 2.34), (0.0, 0.0), (-33.9, 151.2)])
def test_city_scale(spark, radius, lat, lon):
    rng = random.Random(radius)
    spread = radius / 111_195 * 3
    a, b = around(rng, lat, lon, spread, 20), around(rng, lat, lon, spread, 20)
    left = [(*p, *q) for p, q in zip(a, b, strict=True)]
    left += [(lat, lon, None, None), (None, None, lat, lon), (None, 1.0, 1.0, None)]
    assert check(spark, left, [*around(rng, lat, lon, spread, 60), (None, lon)], radius)


def test_antimeridian_and_poles(spark):
    right = [(0.0, 179.9995), (0.0, -179.9995), (0.0, 180.0), (89.999, 10.0), (89.999, -170.0), (90.0, 55.0), (-90.0, 3.0)]
    left = [(0.0, 179.999, 89.9995, 100.0), (-89.9999, 20.0, 0.0, -180.0), (88.0, 0.0, None, None)]
    for radius in (100.0, 750.0, 50_000.0, 400_000.0):
        assert check(spark, left, right, radius)


def test_half_the_globe(spark):
    rng = random.Random(7)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(20)]
    check(spark, [(*p, None, None) for p in points], points, 9_000_000.0)
    check(spark, [(*p, None, None) for p in points], points, 21_000_000.0)


def test_ring_and_strictness(spark):
    rng = random.Random(3)
    left = [(*p, None, None) for p in around(rng, 48.8, 2.3, 0.02, 15)]
    right = around(rng, 48.8, 2.3, 0.04, 60)
    check(spark, left, right, 2000.0, min_m=1000.0)
    same = [(48.8, 2.3)]
    assert check(spark, [(48.8, 2.3, None, None)], same, 0.001, inclusive=True)


def test_many_stations_at_one_place(spark):
    rng = random.Random(5)
    right = [(48.8, 2.3 + rng.uniform(0, 1e-4)) for _ in range(200)]
    check(spark, [(48.8, 2.3, 48.9, 2.4)], right, 750.0, cell_rows=25)


coordinate = st.tuples(st.floats(-90, 90), st.floats(-180, 180))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(coordinate, min_size=1, max_size=8), st.floats(10, 5_000_000))
def test_any_points(spark, points, radius):
    # distances within a millimetre of the radius may fall either way
    if any(abs(metres(*p, *q) - radius) < 1e-3 for p in points for q in points):
        return
    check(spark, [(*p, *points[0]) for p in points], points, radius)


def test_circle_is_closed_and_on_the_radius(spark):
    df = spark.createDataFrame([(48.86, 2.34), (None, 1.0)], "lat double, lon double")
    wkt, none = [r[0] for r in df.select(circle_wkt("lon", "lat", 750.0)).collect()]
    assert none is None
    corners = [tuple(map(float, c.split())) for c in wkt.removeprefix("POLYGON((").removesuffix("))").split(", ")]
    assert len(corners) == 33 and corners[0] == corners[-1]
    assert all(abs(metres(48.86, 2.34, lat, lon) - 750) < 0.1 for lon, lat in corners)


def test_distance_of_unknown_points(spark):
    df = spark.createDataFrame([(1.0, None), (0.0, 180.0)], "lat double, lon double")
    a, b = [r[0] for r in df.select(haversine_m(F.lit(0.0), F.lit(0.0), "lat", "lon")).collect()]
    assert a is None and abs(b - math.pi * EARTH_RADIUS_M) < 1


def test_dense_cells_are_split_by_their_counts(spark):
    """A third of all stations in one cell: the largest key holds at most twice the median of the full ones."""
    from kerbside.operators.spatial import _split_dense, cells_around, grid_cell

    rng = random.Random(11)
    height = math.degrees(750 / EARTH_RADIUS_M)
    dense = [(48.8 + rng.uniform(0, height / 2), 2.3 + rng.uniform(0, height / 2)) for _ in range(3000)]
    wide = around(rng, 48.8, 2.3, 0.5, 6000)
    rdf = spark.createDataFrame([(j, *p) for j, p in enumerate(dense + wide)], "j int, lat double, lon double")
    stops = around(rng, 48.8, 2.3, 0.02, 25)
    ldf = spark.createDataFrame([(i, *p) for i, p in enumerate(stops)], "i int, a double, b double")
    plain, split = (
        join_within(ldf, rdf, 750.0, [("a", "b")], ("lat", "lon"), ["d"], cell_rows=n) for n in (None, 100)
    )
    rows = sorted((r.i, r.j, r.d) for r in plain.collect())
    assert rows and rows == sorted((r.i, r.j, r.d) for r in split.collect())

    cells = ldf.withColumn("_point", F.struct(F.col("a").alias("lat"), F.col("b").alias("lon"))).withColumn(
        "_cell", F.explode(cells_around(F.col("a"), F.col("b"), 750.0))
    )
    stations = rdf.withColumn("_cell", grid_cell(F.col("lat"), F.col("lon"), 750.0))
    keys = ["_cell", "_quadrant", "_salt"]
    spread, salted = _split_dense(cells, stations, ("lat", "lon"), 750.0, 100, ["j", "lat", "lon"])
    sizes = sorted(r[0] for r in salted.groupBy(*keys).count().select("count").collect())
    full = [n for n in sizes if n >= 40]
    assert sum(sizes) == 9000 and sizes[-1] <= 2 * full[len(full) // 2] and sizes[-1] <= 200
    # a stop goes only to the quadrants its circle reaches
    quadrants = salted.select("_cell", "_quadrant", "_salt").distinct().groupBy("_cell").count()
    assert spread.count() < ldf.count() * 9 * max(r["count"] for r in quadrants.collect())


def test_split_cells_at_the_edges_of_the_map(spark):
    rng = random.Random(4)
    near = lambda lat, lon, n: [(max(-90.0, min(90.0, lat + rng.uniform(-0.01, 0.01))), (lon + rng.uniform(-0.02, 0.02) + 180) % 360 - 180) for _ in range(n)]
    right = near(0.0, 180.0, 150) + near(89.99, 10.0, 100) + near(-89.995, 0.0, 60)
    left = [(0.001, 179.999, 0.0, -179.995), (89.995, 100.0, -89.999, 3.0), (90.0, 0.0, None, None)]
    for radius in (300.0, 2000.0, 40_000.0):
        check(spark, left, right, radius, cell_rows=7)


def rings(wkt):
    parts = re.findall(r"\(([^()]+)\)", wkt)
    return wkt.split("(", 1)[0], [[tuple(map(float, c.split())) for c in p.split(", ")] for p in parts]


def area(ring):
    return abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False))) / 2


def test_circles_over_the_antimeridian_and_the_poles(spark):
    places = [(0.0, 179.999), (0.0, -179.999), (60.0, 180.0), (60.0, -180.0), (89.999, 20.0), (-89.999, 179.0), (90.0, 0.0), (-90.0, 7.0), (0.0, 0.0), (89.0, 179.0)]
    df = spark.createDataFrame(places, "lat double, lon double")
    made = [r[0] for r in df.select(circle_wkt("lon", "lat", 750.0)).collect()]
    angular = math.degrees(750 / EARTH_RADIUS_M)
    for (lat, lon), wkt in zip(places, made, strict=True):
        kind, parts = rings(wkt)
        assert all(p[0] == p[-1] and len(p) >= 4 for p in parts)
        assert all(-180 <= x <= 180 and -90 <= y <= 90 for p in parts for x, y in p)
        if abs(lat) > 89.9:
            assert kind == "POLYGON" and len(parts) == 1
            assert {x for x, _ in parts[0]} >= {-180.0, 180.0} and math.copysign(90, lat) in {y for _, y in parts[0]}
            off_edge = [(x, y) for x, y in parts[0] if abs(y) < 90 and abs(x) < 180]
            assert len(off_edge) >= 31 and all(abs(metres(lat, lon, y, x) - 750) < 1 for x, y in off_edge)
            continue
        assert kind == ("MULTIPOLYGON" if abs(lon) > 179.9 else "POLYGON")
        assert len(parts) == (2 if abs(lon) > 179.9 else 1)
        # each part stays within its half, and together they have the circle's area
        for p in parts:
            assert abs(lon) < 179.9 or all(x > 0 for x, _ in p) or all(x < 0 for x, _ in p)
        want = math.pi * angular**2 / math.cos(math.radians(lat))
        assert abs(sum(map(area, parts)) / want - 1) < 0.02
    with pytest.raises(ValueError):
        circle_wkt("lon", "lat", 2e7)


def test_circle_corners_are_computed_once(spark):
    """The formula of a corner stands once in the expression, however many parts of the text read it."""
    assert str(circle_wkt("lon", "lat", 750.0)).upper().count("ATAN2") == 1
