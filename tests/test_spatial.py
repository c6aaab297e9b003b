import math
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lampyris.functions import geo, rules
from lampyris.operators import spatial
from lampyris.plans import questions

L_SHAPE = [(0.0, 0.0), (0.038, 0.0), (0.038, 0.028), (0.019, 0.028), (0.019, 0.057), (0.0, 0.057), (0.0, 0.0)]
BOW_TIE = [(1.0, 1.0), (1.04, 1.04), (1.04, 1.0), (1.0, 1.04), (1.0, 1.0)]
STAR_OVERLAP = [(0.0, 0.0), (0.02, 0.0), (0.02, 0.02), (0.0, 0.02), (0.0, 0.0)]


def _zones(spark, rings):
    return spark.createDataFrame(
        [(i, [tuple(p) for p in ring]) for i, ring in enumerate(rings)], "zone_id int, ring array<struct<lon:double,lat:double>>"
    )


def _points(spark, rows):
    return spark.createDataFrame(rows, "light_id int, lon double, lat double")


def test_containment_edges(spark):
    rows = [
        (1, 0.01, 0.01),  # inside the foot
        (2, 0.0, 0.03),  # on an edge
        (3, 0.038, 0.028),  # on a vertex
        (4, 0.03, 0.04),  # in the notch
        (5, 0.5, 0.5),  # far away
        (6, 1.01, 1.02),  # bow tie, left lobe is open to the left edge
        (7, 1.02, 1.03),  # bow tie, outside the crossing
        (8, 0.005, 0.05),  # inside the upright
    ]
    got = spatial.spatial_join_within(_points(spark, rows), _zones(spark, [L_SHAPE, BOW_TIE, STAR_OVERLAP]))
    pairs = {(r.light_id, r.zone_id) for r in got.collect()}
    assert pairs == {(1, 0), (1, 2), (8, 0), (6, 1)}


def test_centroid_falls_back_to_vertex_mean(spark):
    zones = _zones(spark, [STAR_OVERLAP, [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]])
    rows = {r.zone_id: r for r in zones.select("zone_id", F.inline(F.array(geo.centroid(F.col("ring"))))).collect()}
    assert abs(rows[0].lon - 0.01) < 1e-12 and abs(rows[0].lat - 0.01) < 1e-12
    assert abs(rows[1].lon - 1 / 3) < 1e-12


def _lambert(lon1, lat1, lon2, lat2):
    f = geo.FLATTENING
    b1, b2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    h = math.sin((b2 - b1) / 2) ** 2 + math.cos(b1) * math.cos(b2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    s = 2 * math.asin(math.sqrt(h))
    if s == 0:
        return 0.0
    p, q = (b1 + b2) / 2, (b2 - b1) / 2
    x = (s - math.sin(s)) * math.sin(p) ** 2 * math.cos(q) ** 2 / math.cos(s / 2) ** 2
    y = (s + math.sin(s)) * math.cos(p) ** 2 * math.sin(q) ** 2 / math.sin(s / 2) ** 2
    return geo.SEMI_MAJOR_M * (s - f / 2 * (x + y))


def test_distance_matches_the_textbook_formula(spark):
    cases = [(77.5, 12.8, 77.7, 13.1), (77.5, 12.8, 77.5, 12.8), (0.0, 0.0, 90.0, 45.0), (-10.0, -60.0, 20.0, 55.0), (5.0, 1.0, 5.00001, 1.0)]
    df = spark.createDataFrame(cases, "a double, b double, c double, d double")
    got = [r.m for r in df.select(geo.lambert_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("m")).collect()]
    for m, case in zip(got, cases):
        assert abs(m - _lambert(*case)) < 1e-3, case


def _scatter(n, seed, hot=0.33):
    """Points over a city box; a third of them in one tiny spot."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if rng.random() < hot:
            out.append((i, 77.61 + rng.random() * 1e-4, 12.95 + rng.random() * 1e-4))
        else:
            out.append((i, 77.5 + rng.random() * 0.2, 12.8 + rng.random() * 0.3))
    return out


@pytest.mark.parametrize("metric", ["planar", "geodesic"])
@pytest.mark.parametrize("k", [1, 3])
@pytest.mark.parametrize("n_right, few", [(2, 0), (2, 4096), (40, 0), (3000, 0), (3000, 4096)])
def test_knn_equals_brute_force(spark, monkeypatch, metric, k, n_right, few):
    monkeypatch.setattr(spatial, "KNN_SMALL", few)
    left = _scatter(60, 1) + [(1000, 80.0, 20.0), (1001, 77.61, 12.95)]
    right = _scatter(n_right, 2)
    right.append((n_right, right[0][1], right[0][2]))  # identical location: the smaller key wins
    rdf = spark.createDataFrame(right, "supplier_id int, lon double, lat double")
    got = spatial.knn_join(_points(spark, left), rdf, "light_id", "supplier_id", k=k, metric=metric)
    found = {(r.light_id, r.nn_rank): r.supplier_id for r in got.collect()}

    def d(a, b):
        return (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 if metric == "planar" else _lambert(a[1], a[2], b[1], b[2])

    for point in left:
        ranked = sorted(right, key=lambda s: (d(point, s), s[0]))[:k]
        for rank, supplier in enumerate(ranked, start=1):
            mine = found[(point[0], rank)]
            if mine != supplier[0]:  # equal up to rounding of the distance
                other = next(s for s in right if s[0] == mine)
                assert abs(d(point, other) - d(point, supplier)) < (1e-12 if metric == "planar" else 1e-4)
    assert len(found) == len(left) * min(k, len(right))


def test_knn_without_suppliers_or_location(spark):
    rdf = spark.createDataFrame([], "supplier_id int, lon double, lat double")
    assert spatial.knn_join(_points(spark, [(1, 77.5, 12.9)]), rdf, "light_id", "supplier_id").count() == 0
    rdf = spark.createDataFrame([(1, 77.6, 12.9)], "supplier_id int, lon double, lat double")
    got = spatial.knn_join(_points(spark, [(1, None, 12.9), (2, 77.6, 12.9)]), rdf, "light_id", "supplier_id")
    assert [r.light_id for r in got.collect()] == [2]


def _suppliers(spark, rows):
    return spark.createDataFrame(rows, "supplier_id int, lon double, lat double, service_radius_km int")


def test_radius_join_counts_and_gaps_equal_brute_force(spark):
    lights = [(*p, random.Random(p[0]).choice(["faulty", "operational"])) for p in _scatter(400, 3)]
    ldf = spark.createDataFrame(lights, "light_id int, lon double, lat double, status string")
    suppliers = [(i, lon, lat, [1, 2, 5, 8][i % 4]) for i, lon, lat in _scatter(25, 4, hot=0.2)]
    sdf = _suppliers(spark, suppliers)
    want = {
        (s[0], p[0]) for s in suppliers for p in lights if _lambert(s[1], s[2], p[1], p[2]) <= s[3] * 1000
    }
    centers = spatial.as_centers(sdf, "supplier_id", "service_radius_km")
    got = spatial.spatial_join_dwithin(centers, ldf.select("light_id", "lon", "lat"), F.col("service_radius_km") * 1000)
    assert {(r.supplier_id, r.light_id) for r in got.collect()} == want
    counts = {(r.supplier_id, r.status): r.n for r in spatial.coverage_counts(sdf, ldf).collect()}
    status = {p[0]: p[3] for p in lights}
    brute = {}
    for s, p in want:
        brute[(s, status[p])] = brute.get((s, status[p]), 0) + 1
    assert counts == brute
    bare = {r.light_id for r in spatial.uncovered_lights(ldf, sdf).collect()}
    assert bare == {p[0] for p in lights} - {p for _, p in want}
    assert bare


def test_shapes_of_very_different_size(spark):
    points = _scatter(150, 8) + [(500, 60.0, 0.0), (501, -170.0, 60.0), (502, 79.5, 14.9)]
    suppliers = [(0, 77.6, 12.9, 1), (1, 77.55, 12.95, 40), (2, 77.6, 13.0, 300), (3, 75.0, 10.0, 2500), (4, 77.61, 12.95, 2)]
    centers = spatial.as_centers(_suppliers(spark, suppliers), "supplier_id", "service_radius_km")
    assert len(spatial.circle_levels(centers, F.col("service_radius_km") * 1000)[0]) > 2
    got = spatial.spatial_join_dwithin(centers, _points(spark, points), F.col("service_radius_km") * 1000)
    want = {(s[0], p[0]) for s in suppliers for p in points if _lambert(s[1], s[2], p[1], p[2]) <= s[3] * 1000}
    assert {(r.supplier_id, r.light_id) for r in got.collect()} == want
    ldf = _points(spark, points).withColumn("status", F.lit("faulty"))
    counts = {r.supplier_id: r.n for r in spatial.coverage_counts(_suppliers(spark, suppliers), ldf).collect()}
    assert counts == {s: sum(1 for a, _ in want if a == s) for s in {a for a, _ in want}}
    country = [(70.0, 5.0), (85.0, 5.0), (85.0, 25.0), (70.0, 25.0), (70.0, 5.0)]
    zones = _zones(spark, [country, [(77.6, 12.94), (77.62, 12.94), (77.62, 12.96), (77.6, 12.96), (77.6, 12.94)]])
    inside = {(r.light_id, r.zone_id) for r in spatial.spatial_join_within(_points(spark, points), zones).collect()}
    brute = {(p[0], 0) for p in points if 70 < p[1] < 85 and 5 < p[2] < 25}
    brute |= {(p[0], 1) for p in points if 77.6 < p[1] < 77.62 and 12.94 < p[2] < 12.96}
    assert inside == brute


def test_near_point_is_exact(spark):
    points = _scatter(300, 5)
    got = {r.light_id for r in spatial.near_point(_points(spark, points), 77.61, 12.95, 3000).collect()}
    assert got == {p[0] for p in points if _lambert(77.61, 12.95, p[1], p[2]) <= 3000}


@pytest.mark.parametrize("few", [0, 4096])
def test_plans_have_no_nested_loops(spark, monkeypatch, few):
    monkeypatch.setattr(spatial, "KNN_SMALL", few)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lights = _points(spark, _scatter(50, 6))
        sdf = _suppliers(spark, [(i, lon, lat, 5) for i, lon, lat in _scatter(3000, 7)])
        plans = [
            spatial.knn_join(lights, sdf.drop("service_radius_km"), "light_id", "supplier_id"),
            spatial.spatial_join_dwithin(spatial.as_centers(sdf, "supplier_id", "service_radius_km"), lights, F.col("service_radius_km") * 1000),
            spatial.spatial_join_within(lights, _zones(spark, [L_SHAPE])),
            spatial.uncovered_lights(lights, sdf),
        ]
        for df in plans:
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in text and "Cartesian" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _pairs_formed(df):
    """Rows out of the last join below the exact test, from the executed plan's metrics."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if "Join" in name and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return max(found)


def test_a_cluster_with_one_outlier_forms_few_pairs(spark, monkeypatch):
    """One far row must not put all others into one cell."""
    monkeypatch.setattr(spatial, "KNN_SMALL", 0)
    rnd = random.Random(3)
    left = [(i, 77.6 + rnd.random() / 100, 12.9 + rnd.random() / 100) for i in range(2000)]
    right = [(i, 77.6 + rnd.random() / 100, 12.9 + rnd.random() / 100) for i in range(2000)] + [(9999, -120.0, -45.0)]
    joined = spatial.knn_join(_points(spark, left), _points(spark, right).withColumnRenamed("light_id", "supplier_id"), "light_id", "supplier_id")
    # a constant for each left row: 16 children of the few cells that can matter; all pairs would be 2,000
    assert _pairs_formed(joined) <= 160 * len(left)
    got = {r.light_id: r.supplier_id for r in joined.collect()}
    for i, x, y in left[::40]:
        assert got[i] == min((((x - a) ** 2 + (y - b) ** 2), j) for j, a, b in right)[1]


def test_small_circles_in_one_place_form_few_pairs(spark):
    rnd = random.Random(4)
    circles = [(i, 77.6 + rnd.random() / 60, 12.9 + rnd.random() / 60, 0.005) for i in range(3000)]
    points = [(i, 77.6 + rnd.random() / 60, 12.9 + rnd.random() / 60) for i in range(3000)]
    sdf = spark.createDataFrame(circles, "supplier_id int, lon double, lat double, service_radius_km double")
    joined = spatial.spatial_join_dwithin(
        spatial.as_centers(sdf, "supplier_id", "service_radius_km"), _points(spark, points), F.col("service_radius_km") * 1000
    )
    formed = _pairs_formed(joined)
    assert formed <= 10 * (len(circles) + len(points))


@pytest.mark.parametrize(
    "center, radius_km",
    [((179.99, 0.0), 10), ((-179.95, 40.0), 400), ((80.0, 89.9), 60), ((10.0, -89.99), 30), ((0.0, 89.0), 500), ((180.0, -70.0), 3000)],
)
def test_circles_across_the_antimeridian_and_poles(spark, center, radius_km):
    rnd = random.Random(5)
    points = [(-179.99, 0.0), (179.99, 0.0), (180.0, 0.01), (-180.0, 0.02), (-100.0, 89.9), (0.0, 90.0), (77.0, -90.0)]
    points += [(rnd.uniform(-180, 180), rnd.choice([-1, 1]) * (90 - abs(rnd.gauss(0, 3)) % 90)) for _ in range(300)]
    points += [(rnd.choice([-1, 1]) * (180 - rnd.random() * 5), rnd.uniform(-80, 80)) for _ in range(300)]
    points = [(i, x, y) for i, (x, y) in enumerate(points)]
    want = {i for i, x, y in points if _lambert(*center, x, y) <= radius_km * 1000}
    df = _points(spark, points)
    sdf = _suppliers(spark, [(1, *center, radius_km)])
    got = [r.light_id for r in spatial.spatial_join_dwithin(spatial.as_centers(sdf, "supplier_id", "service_radius_km"), df, F.col("service_radius_km") * 1000).collect()]
    assert sorted(got) == sorted(want)
    assert {r.light_id for r in spatial.near_point(df, *center, radius_km * 1000).collect()} == want
    counts = spatial.coverage_counts(sdf, df.withColumn("status", F.lit("x"))).collect()
    assert sum(r.n for r in counts) == len(want)


def test_radius_join_keeps_columns_nulls_and_ties(spark, monkeypatch):
    """Blocks of one pair each, points that come twice and one without a location."""
    monkeypatch.setattr(spatial, "PAIR_BLOCK", 1)
    points = [(1, 77.6, 12.9), (1, 77.6, 12.9), (2, 77.65, 12.9), (3, None, 12.9)]
    sdf = spark.createDataFrame([(7, 77.61, 12.9, 5.0, None), (7, 77.61, 12.9, 5.0, None), (8, 77.6, 12.9, None, "x")], "supplier_id int, lon double, lat double, service_radius_km double, note string")
    joined = spatial.spatial_join_dwithin(spatial.as_centers(sdf, "supplier_id", "note", "service_radius_km"), _points(spark, points), F.col("service_radius_km") * 1000)
    assert joined.columns == ["supplier_id", "note", "service_radius_km", "light_id", "lon", "lat", "distance_m"]
    got = sorted((r.supplier_id, r.light_id, round(r.distance_m, 3)) for r in joined.collect())
    assert got == [(7, 1, round(_lambert(77.6, 12.9, 77.61, 12.9), 3))] * 4 + [(7, 2, round(_lambert(77.65, 12.9, 77.61, 12.9), 3))] * 2
    # the pairs of a cell are dealt to tasks of their own, whatever the number of input files
    assert joined.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def _shuffled(df):
    """Rows written by the widest exchange of the executed plan."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if node.metrics().contains("shuffleRecordsWritten"):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return max(found)


def test_circles_are_shuffled_once_for_each_cell(spark, monkeypatch):
    """No copies of circles for cells whose pairs are no more than a task's part."""
    monkeypatch.setattr(spatial, "FEW_CIRCLES", 0, raising=False)
    rnd = random.Random(11)
    spots = [(i, 77.5 + rnd.random() * 0.4, 12.8 + rnd.random() * 0.4) for i in range(1500)]
    circles = [(j, 77.5 + rnd.random() * 0.4, 12.8 + rnd.random() * 0.4, rnd.choice([2.0, 5.0])) for j in range(150)]
    sdf = spark.createDataFrame(circles, "supplier_id int, lon double, lat double, service_radius_km double")
    centers, radius = spatial.as_centers(sdf, "supplier_id", "service_radius_km"), F.col("service_radius_km") * 1000
    cells = spatial.circle_cover(centers, radius).count()
    joined = spatial.spatial_join_dwithin(centers, _points(spark, spots), radius)
    assert _shuffled(joined) <= 1.1 * (cells + len(spots))
    want = sorted((s[0], p[0]) for s in circles for p in spots if _lambert(s[1], s[2], p[1], p[2]) <= s[3] * 1000)
    assert sorted((r.supplier_id, r.light_id) for r in joined.collect()) == want


@pytest.mark.parametrize("n_spots, n_circles", [(900, 30), (30, 900), (300, 300)])
def test_crowded_cells_are_split_and_lose_no_pair(spark, monkeypatch, n_spots, n_circles):
    """Nearly all rows in one cell, some twice, others without a location or radius."""
    monkeypatch.setattr(spatial, "FEW_CIRCLES", 0)
    monkeypatch.setattr(spatial, "SPOT_BLOCK", 7)
    rnd = random.Random(12)
    place = lambda: (77.6001 + rnd.random() * 0.002, 12.9001 + rnd.random() * 0.002)
    spots = [(i, *place()) for i in range(n_spots)] + [(5000, 77.9, 12.9), (5001, None, 12.9), (5002, 77.605, None)]
    spots += spots[:5]
    circles = [(j, *place(), rnd.choice([0.05, 0.1])) for j in range(n_circles)] + [(7000, 77.9, 12.9, 1.0), (7001, 77.6, 12.9, None)]
    circles += circles[:5]
    sdf = spark.createDataFrame(circles, "supplier_id int, lon double, lat double, service_radius_km double")
    centers, radius = spatial.as_centers(sdf, "supplier_id", "service_radius_km"), F.col("service_radius_km") * 1000
    points = _points(spark, spots)
    levels, around, n = spatial.circle_levels(centers, radius)
    crowded = spatial._crowded(spatial.circle_cover(centers, radius, around), spatial._with_cells(points, levels), n)
    tasks = spatial._tasks(points)
    assert crowded and len(crowded) <= tasks
    assert 1 < max(a * b for *_, a, b in crowded) and sum(a * b for *_, a, b in crowded) <= 2 * tasks
    assert all(a <= b for *_, a, b in crowded) if n_spots > n_circles else all(a >= b for *_, a, b in crowded) or n_spots == n_circles
    want = sorted((s[0], p[0]) for s in circles for p in spots if s[3] and None not in p and _lambert(s[1], s[2], p[1], p[2]) <= s[3] * 1000)
    got = spatial.spatial_join_dwithin(centers, points, radius, ["light_id", "supplier_id"])
    assert got.columns == ["supplier_id", "light_id", "distance_m"]
    rows = got.collect()
    assert sorted((r.supplier_id, r.light_id) for r in rows) == want
    at = {s[0]: s for s in circles}, {p[0]: p for p in spots}
    assert all(abs(r.distance_m - _lambert(*at[0][r.supplier_id][1:3], *at[1][r.light_id][1:3])) < 1e-3 for r in rows)
    counts = spatial.coverage_counts(sdf, points.withColumn("status", F.lit("x"))).collect()
    assert sorted((r.supplier_id, r.n) for r in counts) == sorted((k, sum(1 for a, _ in want if a == k)) for k in {a for a, _ in want})


def test_many_distances_round_like_decimals(spark):
    rows = [(x,) for x in (0.0, 0.005, 0.015, 2.675, 1.005, 14999.995, 123.454999999, 123.4550000004, 7.1, 1e10 + 0.125)] + [(None,)]
    df = spark.createDataFrame(rows, "x double")
    assert all(r.a == r.b for r in df.select(rules.round_half_up(F.col("x"), 2).alias("a"), rules.round_many(F.col("x"), 2).alias("b")).collect())


def test_crowded_rims_are_counted_without_pairs(spark, monkeypatch):
    monkeypatch.setattr(spatial, "PAIR_BLOCK", 64)
    rnd = random.Random(9)
    rows = [(i, 77.6 + rnd.gauss(0, 0.05), 12.9 + rnd.gauss(0, 0.05), rnd.choice(["a", "b", None])) for i in range(600)]
    lights = spark.createDataFrame(rows, "light_id int, lon double, lat double, status string")
    circles = [(j, 77.6 + rnd.gauss(0, 0.05), 12.9 + rnd.gauss(0, 0.05), rnd.choice([2.0, 6.0])) for j in range(20)]
    sdf = spark.createDataFrame(circles, "supplier_id int, lon double, lat double, service_radius_km double")
    counts = spatial.coverage_counts(sdf, lights)
    plan = counts._jdf.queryExecution().toString()
    assert "MapInArrow" in plan
    want = {}
    for j, a, b, r in circles:
        for _, x, y, status in rows:
            if _lambert(a, b, x, y) <= r * 1000:
                want[j, status] = want.get((j, status), 0) + 1
    assert {(r.supplier_id, r.status): r.n for r in counts.collect()} == want


def test_dispatch_takes_the_nearest_that_reaches_the_light(spark):
    """The nearest supplier of light 1 does not reach it; light 2 is reached by nobody, light 3 comes twice."""
    lights = spark.createDataFrame([(1, 77.60, 12.9), (2, 78.9, 12.9), (3, 77.70, 12.9), (3, 77.701, 12.9), (4, None, 12.9)], "light_id int, lon double, lat double")
    rows = [(1, "near", 77.605, 12.9, 0.1, 2), (2, "far", 77.62, 12.9, 5.0, 3), (3, "none", 77.60, 12.9, None, 4), (3, "own", 77.70, 12.9, 1.0, 4), (3, "own", 77.70, 12.9, 1.0, 4)]
    suppliers = spark.createDataFrame(rows, "supplier_id int, name string, lon double, lat double, service_radius_km double, avg_response_hours int")
    tables = SimpleNamespace(lights=lights.withColumn("_deleted", F.lit(False)), suppliers=suppliers.withColumn("_deleted", F.lit(False)))
    found = {r.light_id: (r.supplier_id, r.supplier_name, r.distance_km) for r in questions.dispatch_supplier(tables).collect()}
    assert found == {1: (2, "far", round(_lambert(77.60, 12.9, 77.62, 12.9) / 1000, 2)), 3: (3, "own", 0.0)}
