"""The metric layer and the enrichment joins on tables with gaps and repeats."""

import os
import types

import pytest
from pyspark.sql import functions as F

from lampyris.operators import enrich, metrics
from lampyris.operators.changes import live_rows
from lampyris.sources.fixtures import scan_tables

SF = os.environ.get("LAMPYRIS_SF", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@needs_data
def test_group_totals_cover_all_live_facts(spark):
    t = scan_tables(spark, SF)
    live = live_rows(t.lights).count()
    by = metrics.metric_query(t, "street_lights", {"n": ("count", "*"), "w": ("count_distinct", "wattage")}, ["neighborhoods.name"])
    assert by.agg(F.sum("n")).first()[0] == live
    gone = types.SimpleNamespace(lights=t.lights, zones=t.zones.withColumn("_deleted", F.lit(True)))
    only = metrics.metric_query(gone, "street_lights", {"n": ("count", "*"), "w": ("count_distinct", "wattage")}, ["neighborhoods.name"]).collect()
    assert [(r.name, r.n) for r in only] == [(None, live)]
    assert only[0].w == live_rows(t.lights).select("wattage").distinct().count()
    one = t.zones.select("name").first().name
    kept = metrics.metric_query(t, "street_lights", {"n": ("count", "*")}, ["status"], where={"neighborhoods.name": [one]})
    assert kept.agg(F.sum("n")).first()[0] == next(r.n for r in by.collect() if r.name == one)


@needs_data
def test_several_facts_equal_the_single_queries(spark):
    t = scan_tables(spark, SF)
    requests, outages = {"requests": ("count", "*")}, {"outages": ("sum", "outages"), "load": ("avg", "grid_load")}
    both = metrics.facts_query(t, {"maintenance_requests": requests, "power_grid_enrichment": outages}, ["neighborhoods.name", "street_lights.status"])
    one = {(r.name, r.status): r for r in metrics.metric_query(t, "maintenance_requests", requests, ["neighborhoods.name", "street_lights.status"]).collect()}
    two = {(r.name, r.status): r for r in metrics.metric_query(t, "power_grid_enrichment", outages, ["neighborhoods.name", "street_lights.status"]).collect()}
    got = {(r.name, r.status): r for r in both.collect()}
    assert set(got) == set(one) | set(two) and both.count() == len(got)
    for k, r in got.items():
        assert r.requests == (one[k].requests if k in one else 0)
        assert (r.outages, r.load) == ((two[k].outages, two[k].load) if k in two else (None, None))
    with pytest.raises(ValueError):
        metrics.facts_query(t, {"maintenance_requests": requests, "power_grid_enrichment": requests}, ["neighborhoods.name"])
    with pytest.raises(ValueError):
        metrics.facts_query(t, {"neighborhoods": {"n": ("count", "*")}, "demographics_enrichment": {"m": ("count", "*")}}, ["area_id"])


@needs_data
def test_geometries_and_the_deleted_flag_are_columns(spark):
    t = scan_tables(spark, SF)
    by = {r._deleted: r.n for r in metrics.metric_query(t, "street_lights", {"n": ("count", "*")}, ["deleted_flag"], deleted=True).collect()}
    assert by == {r._deleted: r["count"] for r in t.lights.groupBy("_deleted").count().collect()} and len(by) == 2
    shape = metrics.metric_query(t, "street_lights", {"n": ("count", "*")}, ["neighborhoods.polygon"]).where("boundary is not null").first()
    assert shape.boundary.startswith("POLYGON((") and shape.boundary.endswith("))")
    assert metrics.metric_query(t, "suppliers", {"n": ("count", "*")}, ["office_location"]).first().location.startswith("POINT(")


@needs_data
def test_repeated_and_empty_seasons_do_not_fail(spark):
    t = scan_tables(spark, SF)
    plain = enrich.requests_enriched(t)
    first = plain.where("season is not null").select("light_id", "season").first()
    again = t.weather.where((F.col("light_id") == first.light_id) & (F.col("season") == first.season))
    odd = t.weather.limit(1).withColumn("season", F.lit(None).cast("string"))
    tables = types.SimpleNamespace(lights=t.lights, zones=t.zones, requests=t.requests, weather=t.weather.unionByName(again).unionByName(odd))
    hits = plain.where((F.col("light_id") == first.light_id) & (F.col("season") == first.season)).count()
    assert enrich.requests_enriched(tables).count() == plain.count() + hits


def test_many_requests_are_dealt_to_more_tasks(spark, monkeypatch):
    t = scan_tables(spark, "/root/testdata/sf0.001")
    plain = enrich.requests_enriched(t)
    monkeypatch.setattr(enrich, "ROWS_PER_TASK", 100)
    dealt = enrich.requests_enriched(t)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.columns == plain.columns and dealt.exceptAll(plain).count() == plain.exceptAll(dealt).count() == 0
