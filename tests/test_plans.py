"""What the physical plans must and must not hold."""

from pathlib import Path

import pytest

from tidegauge.plans import registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

STORED = {"gold_by_year", "read_series_docs", "latest_doc_per_series", "silver_roundtrip", "latest_snapshot", "gold_reload", "gold_tables", "catalog_files_combined"}
NAMES = [n for n in registry.QUERIES if n not in STORED and not n.startswith("stream")]


@pytest.mark.parametrize("name", NAMES)
def test_plan(spark, name):
    plan = registry.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    for line in plan.splitlines():
        if "Window [" in line:
            assert not line.rstrip().endswith("[]"), line
            assert "Exchange SinglePartition" not in line
        if "FileScan parquet" in line and "lineitem" in line:
            assert "ReadSchema: struct<l_partkey:bigint" in line and "l_comment" not in line
