"""The benchmark runs and reports every query it is given."""

import bench
from conftest import SF

from skyledger import registry


def test_measure(spark):
    known = {name: registry.queries()[name] for name in ("code_mask", "distinct_months")}
    report = bench.measure(spark, known, SF, 1)
    assert set(report["queries"]) == set(known) and report["value"] > 0 and report["sf"] == "0.001"
