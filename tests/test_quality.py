"""Scores, validation, resolution and linkage on small published examples."""

import datetime

import pytest
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.fixed_aliases import ALIASES
from tariffworks.functions import scores
from tariffworks.operators import impact, linkage, quality, resolve
from tariffworks import schemas
from tariffworks.schemas import RATE_CASES
from tariffworks.sources import readers

D = datetime.date
FULL = dict(docket_number="R-1", utility_name="PECO", canonical_utility_name="PECO Energy Company", state="PA", source="pennsylvania_puc",
            case_type="general_rate_case", status="decided", filing_date=D(2024, 1, 1), decision_date=D(2024, 9, 1),
            requested_revenue_change=100.0, approved_revenue_change=75.0, source_url="https://x")


def case(spark, **values):
    row = {**{f.name: None for f in RATE_CASES.fields}, **values}
    return spark.createDataFrame([row], RATE_CASES)


def score(df, **flags):
    return df.select(scores.quality_score(scores.quality_components(**{k: F.lit(v) for k, v in flags.items()}))).first()[0]


def test_scores(spark):
    assert abs(sum(V.QUALITY_WEIGHTS.values()) - 1) < 1e-9
    assert score(case(spark, **FULL)) == 0.8
    assert score(case(spark, **FULL), has_eia_link=True, has_emissions=True, has_impact=True) == 1.0
    assert score(case(spark, docket_number="R-1", utility_name="PECO")) == 0.19
    assert score(case(spark, **{**FULL, "decision_date": None, "status": "active"})) == 0.76


@pytest.mark.parametrize("change,message", [
    ({}, None), ({"filing_date": D(1980, 1, 1)}, "Filing date 1980-01-01 outside valid range (1990-2030)"),
    ({"decision_date": D(2023, 1, 1)}, "Decision date (2023-01-01) before filing date (2024-01-01)"),
    ({"requested_revenue_change": 60000.0, "approved_revenue_change": None}, "Requested revenue $60000.0M seems unreasonably large"),
    ({"approved_revenue_change": 200.0}, "Approved $200.0M significantly exceeds requested $100.0M"),
    ({"return_on_equity": 30.0}, "ROE 30.0% outside reasonable range (0-25%)"), ({"rate_base": -1.0}, "Rate base $-1.0M is negative"),
    ({"state": "PENN"}, "State code 'PENN' should be 2 characters"),
])
def test_validation(spark, change, message):
    got = case(spark, **{**FULL, **change}).select(scores.validate_case()).first()[0]
    assert got == ([message] if message else [])


def test_integrity(spark):
    rows = spark.createDataFrame([("1", "or", "Avista", None, "OR"), ("1", "or", "Avista", None, "WA"), ("2", "or", "B", None, "OR")],
                                 "docket_number string, source string, utility_name string, canonical_utility_name string, state string")
    assert [tuple(r) for r in quality.dup_dockets(rows, ["docket_number", "source"]).collect()] == [("1", "or", 2)]
    assert [tuple(r) for r in quality.multi_state_entities(rows).collect()] == [("Avista", "OR, WA")]


def test_resolution(spark):
    names = [("PECO Energy Company", None), ("PG&E", None), ("Completely Unknown Utility XYZ 12345", None), ("", None), ("PacifiCorp", "OR"),
             ("Duquesne Lightt", "PA"), ("Georgia Power Company LLC", "GA"), ("Aqua Pensylvania", "TX")]
    df = spark.createDataFrame(names, "utility_name string, state string")
    got = {r.utility_name: (r.canonical_name, r.match_method) for r in resolve.resolve_utilities(df, resolve.alias_table(spark)).collect()}
    assert got["PECO Energy Company"] == ("PECO Energy Company", "exact_alias")
    assert got["PG&E"] == ("Pacific Gas and Electric Company", "exact_alias")
    assert got["Completely Unknown Utility XYZ 12345"] == ("Completely Unknown Utility XYZ 12345", "unresolved")
    assert got[""] == (None, None)
    assert got["PacifiCorp"][1] == "exact_alias"
    assert got["Duquesne Lightt"][0] == "Duquesne Light Company" and got["Duquesne Lightt"][1].startswith("fuzzy_")
    assert got["Georgia Power Company LLC"] == ("Georgia Power Company", "cleaned_exact")
    assert got["Aqua Pensylvania"][0] == "Aqua Pennsylvania Inc."
    assert len(ALIASES) == 43


def test_links_and_impacts(spark):
    utilities = spark.createDataFrame([("Pacific Gas & Electric Company", None, "CA"), ("Nothing Like It", None, "CA")],
                                      "name string, canonical_name string, state string")
    ops = spark.createDataFrame([(14328, "Pacific Gas and Electric Co", "ca", 2021, 900, 25.0, 1), (14328, "Pacific Gas and Electric Co", "CA", 2022, 1000000, 24.0, 2)],
                                "eia_utility_id long, utility_name string, state string, year int, total_customers long, residential_avg_price double, seq int")
    links = linkage.link_utilities(utilities, ops)
    assert [(r.utility_name, r.eia_utility_id, r.match_confidence, r.match_method) for r in links.collect()] == [
        ("Pacific Gas & Electric Company", 14328, 1.0, "exact")]
    cases = case(spark, **{**FULL, "utility_name": "PACIFIC GAS & ELECTRIC COMPANY", "canonical_utility_name": None, "approved_revenue_change": 100.0})
    got = impact.rate_case_impacts(cases, links.withColumn("seq", F.lit(1)), ops).first()
    assert (got.total_customers, got.annual_bill_impact, got.monthly_bill_impact, got.residential_price_after) == (1000000, 100.0, 8.33, None)
    none = case(spark, **{**FULL, "approved_revenue_change": 0.0})
    assert impact.rate_case_impacts(none, links.withColumn("seq", F.lit(1)), ops).count() == 0


def test_headers():
    assert readers.find_column(["utility number ", "Name"], ["Utility Number"]) == "utility number "
    assert readers.find_by_words(["Plant Code", "Utility ID"], [["utility", "number"], ["utility", "id"]]) == "Utility ID"


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"docket_number": "1"}, {"docket_number": "2"}]')
    (tmp_path / "b.json").write_text('{"docket_number": "3"}')
    (tmp_path / "c.json").write_text('{"docket_number": ')
    (tmp_path / "d.json").write_text('[{"docket_number": 4.50, "more": {"x": [1]}}, 7, null, [1, "x"]]')
    (tmp_path / "e.json").write_text('"text"')
    (tmp_path / "f.json").write_text('[]')
    good, bad = readers.read_raw_json(spark, str(tmp_path), "oregon_puc")
    assert good.columns[:-1] == schemas.RAW_RECORD.names
    assert [(r.docket_number, r.source) for r in good.orderBy("seq").collect()] == [(x, "oregon_puc") for x in ["1", "2", "3", "4.5"]]
    assert sorted((r.file.rsplit("/", 1)[1], -1 if r.place is None else r.place, r.reason, r.text) for r in bad.collect()) == [
        ("c.json", -1, "malformed file", '{"docket_number": '), ("d.json", 1, "not a record", "7"), ("d.json", 2, "not a record", "null"),
        ("d.json", 3, "not a record", '[1,"x"]'), ("e.json", 0, "not a record", '"text"')]


def test_files_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "ops_2020.csv").write_text(
        "Sales 2020,,,\nUtility Number,Utility Name,RESIDENTIAL,,TOTAL,\n,,Customers,Revenue (Thousands Dollars),Customers,\n"
        "17,North Gas,\"1,200\",5.5,\"2,000\",\n.,none,1,1,1\n")
    (tmp_path / "ops_2021.csv").write_text("State,Total Customers,utility_number \nor,7,18\nwa,,19\n")
    (tmp_path / "ops_2022.csv").write_text("Utility Name,State\nx,OR\n")
    year = F.regexp_extract("file", r"ops_(\d+)", 1).cast("int")
    rows, others = readers.read_operations_files(spark, str(tmp_path), year)
    assert sorted((r.year, r.eia_utility_id, r.utility_name, r.state, r.residential_customers, r.residential_revenue, r.total_customers)
                  for r in rows.collect()) == [
        (2020, 17, "North Gas", None, 1200, 5.5, 2000), (2021, 18, None, "or", None, None, 7), (2021, 19, None, "wa", None, None, None)]
    assert [r.file.rsplit("/", 1)[1] for r in others.collect()] == ["ops_2022.csv"]
