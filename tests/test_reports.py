"""The registered reports hold every value of every result."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sessionlens.plans import reports

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key, build", [
    ("descriptive_report", reports.descriptive_report), ("temporal_report", reports.temporal_report),
    ("segmentation_report", lambda e: reports.segmentation_report(e, as_of=E.AS_OF, exact=True)),
    ("review_report", reports.review_report)])
def test_registered_report_has_all_columns_of_all_results(spark, key, build):
    got = E.queries()[key](spark, SF)
    parts = build(E.enriched(spark, SF, text=True))
    assert set(got.columns) == {"result"} | {c for df in parts.values() for c in df.columns}
    assert {r.result for r in got.select("result").distinct().collect()} == set(parts)


def test_swapped_results_are_seen(spark):
    got = E.queries()["descriptive_report"](spark, SF).where("result = 'conversionByDevice'")
    want = E.queries()["conversion_by_device"](spark, SF)
    assert got.select(want.columns).exceptAll(want).isEmpty() and got.count() == want.count() == 2
    stats = E.queries()["descriptive_report"](spark, SF).where("result = 'stats'")
    typed = {r.column_name: r for r in E.queries()["describe_sessions"](spark, SF).collect()}
    for row in stats.where(F.col("summary") != "count").collect():
        assert row.purchase_amount == pytest.approx(typed["purchase_amount"][row.summary])
