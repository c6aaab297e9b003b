"""Queries with check SQL, on the smallest data folder."""

import os
import types

import pytest

from lampyris.llm import entries, registry  # noqa: F401
from tools import check

SF = os.environ.get("LAMPYRIS_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("key", sorted(registry.SQL))
def test_query_matches_its_check(spark, key):
    entry = types.SimpleNamespace(run=registry.QUERIES[key], sql=registry.SQL[key])
    status, detail, _ = check.compare(spark, check.connect(SF), entry, SF)
    assert status == "ok", detail
