"""Pages of cases."""

from __future__ import annotations

from tariffworks.operators.filters import page_cases


def test_page_without_limit_is_whole(spark):
    cases = spark.range(1200).selectExpr("date'2020-01-01' AS filing_date", "lpad(id, 5, '0') AS docket_number", "'s' AS source")
    assert page_cases(cases).count() == 1200 and page_cases(cases, offset=5).count() == 1195
    assert [r.docket_number for r in page_cases(cases, 2, 3).collect()] == ["00003", "00004"]
