"""The pipeline over stored tables, and tables of checked rows."""

import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tariffworks.operators import checked
from tariffworks.plans import pipeline, reports
from tariffworks.schemas import RATE_CASES, RAW_RECORD, UTILITIES

SOURCES = ["oregon_puc", "georgia_psc", "missouri_psc"]


def raw(spark, *rows):
    schema = StructType([*RAW_RECORD.fields, StructField("seq", LongType())])
    return spark.createDataFrame([{**{f.name: None for f in RAW_RECORD.fields}, "utility_name": "A", "state": "or", "seq": i, **r}
                                  for i, r in enumerate(rows)], schema)


def at(hour):
    return F.lit(datetime.datetime(2024, 1, 1, hour)).cast("timestamp")


def test_runs_are_opened_and_closed_with_what_was_written(spark, tmp_path):
    root = str(tmp_path)
    pipeline.create_tables(spark, root)
    first = raw(spark, {"docket_number": "1", "source": "oregon_puc", "status": "open"}, {"docket_number": "2", "source": "oregon_puc"},
                {"docket_number": "1", "source": "oregon_puc", "requested_revenue_change": "5"}, {"docket_number": " ", "source": "oregon_puc"},
                {"docket_number": "1", "source": "georgia_psc"}, {"docket_number": "9", "source": "unheard_of"})
    rejects = pipeline.store_batch(spark, root, first, SOURCES, "one", at(0), at(1))
    assert rejects.count() == 1
    files = sorted(f.name for f in (tmp_path / "rate_cases" / "source=georgia_psc").glob("*.parquet"))
    second = raw(spark, {"docket_number": "1", "source": "oregon_puc", "status": "closed"}, {"docket_number": "3", "source": "oregon_puc"})
    pipeline.store_batch(spark, root, second, SOURCES, "two", at(2), at(3))
    runs = {(r.source, r.started_at.hour): (r.status, r.records_processed, r.records_created, r.records_updated, r.errors, r.completed_at.hour)
            for r in pipeline.read_runs(spark, root).collect()}
    none = ("completed", 0, 0, 0, 0)
    assert runs == {
        ("oregon_puc", 0): ("completed", 3, 2, 1, 0, 1), ("georgia_psc", 0): ("completed", 1, 1, 0, 0, 1), ("missouri_psc", 0): (*none, 1),
        ("oregon_puc", 2): ("completed", 2, 1, 1, 0, 3), ("georgia_psc", 2): (*none, 3), ("missouri_psc", 2): (*none, 3)}
    stored = {(r.docket_number, r.source): (r.status, r.requested_revenue_change) for r in pipeline.read_cases(spark, root).collect()}
    assert stored == {("1", "oregon_puc"): ("decided", 5.0), ("2", "oregon_puc"): ("unknown", None), ("3", "oregon_puc"): ("unknown", None),
                      ("1", "georgia_psc"): ("unknown", None)}
    # a partition that the second run has no rows in keeps its files
    assert sorted(f.name for f in (tmp_path / "rate_cases" / "source=georgia_psc").glob("*.parquet")) == files


def test_statistics_of_no_cases_and_of_nulls(spark):
    empty = {(r.section, r.metric): r.value for r in reports.case_statistics(spark.createDataFrame([], RATE_CASES)).collect()}
    assert empty["total", "cases"] == 0 and empty["quality", "avg_score"] == 0 and empty["dates", "earliest_filing"] is None
    row = {f.name: None for f in RATE_CASES.fields}
    cases = spark.createDataFrame([{**row, "state": "OR"}, {**row, "utility_name": "A", "quality_score": 0.7}, {**row, "utility_name": "A"}], RATE_CASES)
    got = {(r.section, r.key, r.metric): r.value for r in reports.case_statistics(cases).collect()}
    assert got["total", None, "cases"] == 3 and got["total", None, "unique_utilities"] == 1
    assert got["by_state", "OR", "cases"] == 1 and got["by_state", None, "cases"] == 2 and got["quality", None, "above_threshold"] == 1


def test_checked_rows_are_stored_once(spark, tmp_path):
    path, row = str(tmp_path / "cases"), {f.name: None for f in RATE_CASES.fields}
    good = {**row, "docket_number": " 1 ", "utility_name": "A ", "state": "or", "source": "s", "rate_base": 1.23456, "return_on_equity": 9.876}
    cases = spark.createDataFrame([good, {**good, "state": "xx", "return_on_equity": 30.0}], RATE_CASES)
    checked.write_checked(cases, "rate_cases", path)
    kept = checked.read_accepted(spark, path).collect()
    assert [(r.docket_number, r.utility_name, r.state, r.rate_base, r.return_on_equity) for r in kept] == [("1", "A", "OR", 1.235, 9.88)]
    lost = checked.read_rejected(spark, path).collect()
    assert [(r.docket_number, r.state, r.reasons) for r in lost] == [(" 1 ", "xx", ["state code", "return_on_equity range"])]
    utilities = spark.createDataFrame([{**{f.name: None for f in UTILITIES.fields}, "name": " N", "state": "wa"}], UTILITIES)
    assert [(r.name, r.state) for r in checked.checked(utilities, "utilities").collect()] == [("N", "WA")]
