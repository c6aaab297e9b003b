"""Registered queries against their check SQL on the smallest data folder.

A sample of every family by default; LAMPYRIS_FULL=1 runs all of them.
"""

import os

import pytest

from lampyris.catalog import load_all
from lampyris.operators import metrics
from tools import check

SF = os.environ.get("LAMPYRIS_SF", "/root/testdata/sf0.001")
SAMPLE = [
    "entity_counts", "status_share", "faulty_by_zone_spatial", "faulty_nearest_supplier", "supplier_coverage_counts",
    "zone_infrastructure", "issue_resolution", "hazard_text_search", "zone_stats", "zone_nearest_supplier",
    "requests_by_zone", "lights_by_urban_class", "faulty_by_zone_fk", "median_resolution_month", "repeat_failures",
    "dispatch_supplier", "knn_join", "nearest_by_rank", "boundary_geojson", "all_issues_timeseries", "rolling_features",
    "feature_stats", "forecast", "forecast_comparison", "monthly_budget_all", "forecast_metrics", "search", "search_index",
    "hybrid_search", "lights_enriched", "requests_enriched", "rule_age", "radius_histogram", "check_fk", "metric_query_filtered",
    "boosting_features", "search_merged", "vector_index_search", "polygon_validity",
    "apply_changes", "stream_apply", "stream_daily_counts", "scan_csv", "polygon_from_ewkb_hex", "try_geography",
]
KEYS = sorted(load_all()) if os.environ.get("LAMPYRIS_FULL") else SAMPLE
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@needs_data
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_its_check(spark, con, key):
    status, detail, _ = check.compare(spark, con, load_all()[key], SF)
    assert status in ("ok", "rows"), detail


def test_contract():
    import __spark_entry__ as contract

    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 200


def test_business_names():
    assert metrics.resolve("watts") == ("street_lights", "wattage")
    assert metrics.resolve("neighborhoods.area_name") == ("neighborhoods", "name")
    with pytest.raises(ValueError):
        metrics.resolve("lamp_id")
    assert metrics.resolve("lamp_id", "street_lights") == ("street_lights", "light_id")
    with pytest.raises(ValueError):
        metrics._path("suppliers", "neighborhoods")
