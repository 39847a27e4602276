"""Derived columns are computed once per row, also below a filter on many of them."""

from checks.domain import Domain
from stratalake.operators.quality import quarantined

SF = "/root/testdata/sf0.001"


def test_filter_on_the_flag_does_not_derive_the_columns_again(spark):
    rejected = quarantined(Domain(spark, SF).flagged)
    plan = rejected._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter (" in line]
    assert filters and not any("l_shipdate" in line for line in filters)
