"""Registered queries against their SQL, on the smallest data set.

A few of each kind by default; all of them with TARIFFWORKS_ALL_QUERIES=1.
"""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SOME = ["state_rollup", "bill_impact", "extract_dollar", "html_labelled_fields", "merge_cases", "src_ops_csv",
        "src_raw_json", "stats_all", "dedupe_first", "hist_quality", "schema_store_case", "sink_cases_csv", "link_utilities"]
EMPTY_HERE = {"filter_operations"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


def names():
    return sorted(entry.queries()) if os.environ.get("TARIFFWORKS_ALL_QUERIES") else SOME


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", names())
def test_query_equals_its_sql(spark, con, name):
    got = difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert got is None or (got == "EMPTY" and name in EMPTY_HERE)


def test_every_query_has_sql():
    own = {name for c in entry._CATALOGS if c is not entry.llm for name in c.QUERIES}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())
