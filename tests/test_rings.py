"""Containment through cells that know their corner's parity, against the plain even-odd rule."""

import math
import random
import types

import pytest
from pyspark.sql import functions as F

from lampyris.functions import geo
from lampyris.operators import quality, rings, spatial


def _zones(spark, shapes):
    return spark.createDataFrame([(i, s and [tuple(p) for p in s]) for i, s in enumerate(shapes)], "zone_id int, ring array<struct<lon:double,lat:double>>")


def _points(spark, spots):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "light_id int, lon double, lat double")


def _plain(points, zones):
    """Every point with every ring, edge by edge."""
    hit = geo.point_in_polygon(F.col("lon"), F.col("lat"), F.col("ring"))
    return {(r.light_id, r.zone_id) for r in points.crossJoin(zones.where("size(ring) > 1")).where(hit).collect()}


def _found(points, zones):
    rows = [(r.light_id, r.zone_id) for r in spatial.spatial_join_within(points, zones).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _star(n, seed, x=77.5, y=12.9, size=0.1):
    rnd = random.Random(seed)
    ring = []
    for i in range(n):
        r = size * (0.4 + 0.6 * rnd.random())
        ring.append((x + r * math.cos(2 * math.pi * i / n), y + r * math.sin(2 * math.pi * i / n)))
    return [*ring, ring[0]]


def _on_the_grid(n, seed):
    """A ring that crosses itself, with vertices and level and upright edges on cell borders."""
    rnd = random.Random(seed)
    ring = [(rnd.randrange(-6, 7) * 0.02, rnd.randrange(-6, 7) * 0.02) for _ in range(n)]
    for i in range(1, n, 3):
        ring[i] = (ring[i - 1][0], ring[i][1]) if rnd.random() < 0.5 else (ring[i][0], ring[i - 1][1])
    return [*ring, ring[0]]


@pytest.fixture(params=[64, 1], ids=["in the row", "edge by edge"])
def small(request, monkeypatch):
    monkeypatch.setattr(rings, "SMALL_RING", request.param)


@pytest.mark.parametrize("seed", [1, 2])
def test_rings_on_cell_borders(spark, small, seed):
    shapes = [_on_the_grid(n, seed * 100 + n) for n in (3, 4, 5, 8, 13, 30)] + [None, []]
    rnd = random.Random(seed)
    spots = [(x * 0.01, y * 0.01) for x in range(-14, 15) for y in range(-14, 15)]
    spots += [(rnd.uniform(-0.13, 0.13), rnd.uniform(-0.13, 0.13)) for _ in range(300)] + [(None, 0.0), (0.01, None)]
    spots += [p for s in shapes if s for p in s]
    points, zones = _points(spark, spots), _zones(spark, shapes)
    want = _plain(points, zones)
    assert len(want) > 300
    assert _found(points, zones) == want


def test_stars_of_many_edges(spark, small):
    shapes = [_star(n, n) for n in (5, 40, 300, 900)] + [_star(50, 1, size=3.0), _star(400, 2, x=-179.0, y=-80.0, size=8.0)]
    rnd = random.Random(9)
    spots = [(rnd.uniform(77.38, 77.62), rnd.uniform(12.78, 13.02)) for _ in range(600)] + [(rnd.uniform(-187, -171), rnd.uniform(-88, -72)) for _ in range(200)]
    spots += shapes[2][:50]
    points, zones = _points(spark, spots), _zones(spark, shapes)
    assert _found(points, zones) == _plain(points, zones)


def test_equal_zones_and_other_columns_stay(spark, small):
    square = [(0.0, 0.0), (0.05, 0.0), (0.05, 0.05), (0.0, 0.05), (0.0, 0.0)]
    zones = _zones(spark, [square, square]).withColumn("zone_id", F.lit(7)).withColumn("name", F.lit(None).cast("string"))
    got = spatial.spatial_join_within(_points(spark, [(0.01, 0.01), (0.06, 0.01)]), zones)
    assert sorted(got.columns) == ["lat", "light_id", "lon", "name", "zone_id"]
    assert [(r.light_id, r.zone_id) for r in got.collect()] == [(0, 7), (0, 7)]


def _validity(spark, shapes):
    zones = _zones(spark, shapes).withColumnRenamed("zone_id", "neighborhood_id")
    return {r.neighborhood_id: r.self_intersects for r in quality.polygon_validity(types.SimpleNamespace(zones=zones)).collect()}


def _crosses(ring):
    def side(a, b, c):
        v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return (v > 0) - (v < 0)

    edges = list(zip(ring, ring[1:]))
    return any(
        side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0
        for i, (a, b) in enumerate(edges) for c, d in edges[i + 2 :]
    )


def test_crossings_equal_all_pairs(spark, small):
    shapes = [_on_the_grid(n, 10 * n + k) for n in (3, 4, 5, 6, 9, 40) for k in range(4)] + [_star(n, n) for n in (5, 100)]
    got = _validity(spark, [*shapes, None, [(0.0, 0.0)]])
    assert got == {**{i: _crosses(s) for i, s in enumerate(shapes)}, len(shapes): False, len(shapes) + 1: False}
    assert 3 < sum(got.values()) < len(shapes)


def test_one_crossing_in_a_large_ring_is_found(spark):
    ring = _star(20_000, 6)
    broken = [*ring]
    broken[7000], broken[7003] = broken[7003], broken[7000]
    assert _crosses(broken[6990:7015])
    assert _validity(spark, [ring, broken]) == {0: False, 1: True}


def test_a_coastline_costs_few_edge_tests(spark):
    """20,000 edges and 100,000 points: two thousand million pairs of them, of which few are tested."""
    n = 20_000
    zones = _zones(spark, [_star(n, 3)])
    cover = spatial.zone_cover(zones).withColumn("n", F.size("_edges"))
    cells = cover.agg(F.count("*").alias("cells"), F.count_if(F.col("n") == 0).alias("inner"), F.sum("n").alias("edges")).first()
    assert cells.inner > 0 and cells.cells <= 2 * n
    points = spark.range(100_000).select(
        F.col("id").cast("int").alias("light_id"), (77.4 + 0.2 * F.rand(1)).alias("lon"), (12.8 + 0.2 * F.rand(2)).alias("lat")
    )
    level = [r[0] for r in cover.select("_lv").distinct().collect()]
    tested = spatial._with_cells(points, level).join(cover, spatial.CELL).agg(F.sum("n")).first()[0]
    assert tested < 100_000 * n / 20
    sample = points.where("light_id % 1000 = 0")
    assert _found(sample, zones) == _plain(sample, zones)
    assert abs(spatial.spatial_join_within(points, zones).count() / 100_000 - 0.49 * math.pi / 4) < 0.02
