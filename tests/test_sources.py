import struct

from pyspark.sql import functions as F

from lampyris.functions import geo
from lampyris.sources import files, geotext
from lampyris.sources import generate as gen


def _hex(srid, x, y):
    head = struct.pack("<BI", 1, 1 | (0x20000000 if srid else 0)) + (struct.pack("<I", 4326) if srid else b"")
    return (head + struct.pack("<dd", x, y)).hex()


def test_points_in_both_notations(spark):
    rows = [
        ("POINT (77.5 12.8)", (77.5, 12.8)),
        ("point(-1e1 +0.25)", (-10.0, 0.25)),
        ("POINT (77.5)", None),
        ("POINT (a b)", None),
        ("", None),
        (None, None),
        (_hex(True, 77.123456789, -12.5), (77.123456789, -12.5)),
        (_hex(False, 0.0, 1e-9), (0.0, 1e-9)),
        (_hex(True, 1.0, 2.0).upper(), (1.0, 2.0)),
        (_hex(True, 1.0, 2.0)[:-2], None),
        ("zz", None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string")
    got = {r.i: (tuple(r.p) if r.p else None) for r in df.select("i", geotext.try_point(F.col("t")).alias("p")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}


def test_polygons_in_both_notations(spark):
    ring = [(0.0, 0.0), (1.5, 0.0), (1.5, 2.0), (0.0, 0.0)]
    text = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in ring) + "))"
    raw = struct.pack("<BIII", 1, 0x20000003, 4326, 1) + struct.pack("<I", 4) + b"".join(struct.pack("<dd", *p) for p in ring)
    df = spark.createDataFrame([(text, raw.hex()), ("POLYGON ((1 2))", "00"), (None, None)], "w string, h string")
    rows = df.select(geotext.polygon_from_wkt(F.col("w")).alias("w"), geotext.polygon_from_ewkb_hex(F.col("h")).alias("h")).collect()
    assert [tuple(p) for p in rows[0].w] == ring and [tuple(p) for p in rows[0].h] == ring
    assert rows[1].w is None and rows[1].h is None and rows[2].w is None


def test_csv_layouts(spark, tmp_path):
    path = tmp_path / "requests"
    path.mkdir()
    (path / "a.csv").write_text(
        "request_id,light_id,reported_at,resolved_at,issue_type,description\n"
        'REQ-0001,SL-0001,2024-01-01 10:00:00,,wiring,"Sparks, smoke"\n'
        "REQ-0002,SL-0002,2024-01-01 10:00:00,2024-01-02 11:30:00,bulb_failure,\n"
    )
    rows = files.scan_layout(spark, str(path), "requests").orderBy("request_id").collect()
    assert rows[0].resolved_at is None and rows[0].description == "Sparks, smoke" and rows[1].description is None
    assert rows[1].resolved_at.hour == 11 and rows[0].created_at is not None
    zones = tmp_path / "zones"
    zones.mkdir()
    (zones / "z.csv").write_text('neighborhood_id,name,boundary,population\nNH-001,A,"POLYGON ((0 0, 1 0, 1 1, 0 0))",5\n')
    assert len(files.scan_layout(spark, str(zones), "zones").first().ring) == 4


def test_materialize_and_views(spark, tmp_path):
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    back = files.materialize(df, str(tmp_path / "t"), ["g"])
    assert back.count() == 10 and set(back.columns) == {"id", "g"}
    files.register_views({"v_ten": lambda: df})
    assert spark.sql("select sum(id) as s from v_ten").first().s == 45


def test_generators_keep_their_rules(spark):
    zones = gen.gen_neighborhoods(spark.range(9).select(F.col("id").alias("i")))
    lights = gen.gen_street_lights(zones, 500, "2001-08-01").cache()
    assert lights.count() == 500 and lights.select("light_no").distinct().count() == 500
    assert lights.agg(F.max("light_no")).first()[0] == 500
    placed = lights.join(zones.select("neighborhood_id", "ring"), "neighborhood_id")
    inside = placed.where(geo.point_in_polygon(F.col("lon"), F.col("lat"), F.col("ring"))).count()
    assert inside >= 490  # centroids of odd rings may fall outside
    assert lights.where("last_maintenance > timestamp_ntz '2001-07-02 12:00:00' or datediff(date '2001-08-01', installation_date) not between 365 and 3650").count() == 0
    again = gen.gen_street_lights(zones.repartition(5), 500, "2001-08-01")
    assert again.exceptAll(lights).count() == 0
    requests = gen.gen_maintenance(lights, 300, "2001-08-01")
    assert requests.count() == 300
    assert requests.where("resolved_at <= reported_at or description is null").count() == 0
    assert gen.gen_maintenance(lights, 20000, "2001-08-01").count() == 20000
    weather = gen.gen_weather(lights, "2001-08-01")
    assert weather.count() == 1500
    assert weather.where("status is not null" if "status" in weather.columns else "failure_risk_score not between 0 and 0.99").count() == 0
    grid = gen.gen_power_grid(lights)
    assert grid.where("avg_load_percent > 80 and outage_history_count not between 3 and 8").count() == 0
    suppliers = gen.gen_suppliers(spark.range(200).select(F.col("id").alias("i")))
    assert suppliers.where("lon not between 77.5 and 77.7 or lat not between 12.8 and 13.1").count() == 0


def test_big_rows_are_spread(spark):
    one = spark.createDataFrame([("z", 25000)], "zone string, n int")
    spread = gen._spread(one, F.col("n"), "j")
    assert spread.agg(F.count("*"), F.max("j"), F.count_distinct("j")).first() == (25000, 25000, 25000)


def test_geojson_is_read_back(spark):
    texts = [
        '{"type":"Polygon","coordinates":[[[1.5,2],[3,4],[1.5,2]],[[9,9]]]}', '{"type":"MultiPolygon","coordinates":[[[[5,6],[7,8]]],[[[0,0]]]]}',
        '{"type":"Point","coordinates":[1,2]}', "not json", None, '{"type":"Polygon","coordinates":[]}', '{"type":"Polygon","coordinates":[[[1]]]}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("r", geo.ring_from_geojson(F.col("t")))
    got = {r.i: r.r and [tuple(p) for p in r.r] for r in df.collect()}
    assert got == {0: [(1.5, 2.0), (3.0, 4.0), (1.5, 2.0)], 1: [(5.0, 6.0), (7.0, 8.0)], 2: None, 3: None, 4: None, 5: None, 6: None}
