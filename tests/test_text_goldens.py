"""Published example values of the text functions."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions import dockets, html, names, rules, text
from tariffworks.operators.extract import parse_record
from tariffworks.schemas import RAW_RECORD

D = datetime.date


def check(spark, function, pairs):
    """One job for all pairs of (input, expected)."""
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(pairs)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", function(F.col("x")).alias("y")).collect()}
    for i, (given, expected) in enumerate(pairs):
        assert got[i] == expected, (given, got[i], expected)


def test_dollars(spark):
    check(spark, text.extract_dollar, [
        ("revenue increase of $245.6 million", 245.6), ("rate base of $2.8 billion", 2800.0), ("$245.6M", 245.6),
        ("$2.8B", 2800.0), ("$25,300,000", 25.3), ("decrease of $10 million", -10.0), ("", None), (None, None),
        ("no dollar amounts here", None), ("$1,234,567,890", 1234.568), ("requested $100 million, approved $75 million", 100.0),
        ("$500 by 2024", 500000.0), ("Connecticut asks $5 million", -5.0), ("$50", None)])
    check(spark, text.extract_all_dollars, [("$100 million and $75 million", [100.0, 75.0]), ("", []), (None, []), ("$5 and $2,500,000", [2.5])])
    check(spark, text.parse_dollar, [("$1,000,000,000", 1000.0), ("245 million", None), ("$50", None), ("decrease of $10 million", 10.0)])
    check(spark, text.parse_percent, [("10.5%", 10.5), ("10.5 percent", 10.5), ("just a number 10", None)])


def test_dates(spark):
    day = D(2024, 3, 28)
    check(spark, text.parse_date, [
        ("2024-03-28", day), (" 03/28/2024 ", day), ("3/5/2024", D(2024, 3, 5)), ("March 28, 2024", day), ("Mar 28, 2024", day),
        ("march 28 2024", day), ("28 Mar 2024", day), ("20240328", day), ("03-28-2024", day), ("2024-3-5", D(2024, 3, 5)),
        ("1/2/69", D(1969, 1, 2)), ("1/2/68", D(2068, 1, 2)), ("2023-02-29", None), ("13/01/2024", None), ("Mar. 28, 2024", None),
        ("Foo 28, 2024", None), ("", None), (None, None), ("2024-02-29", D(2024, 2, 29))])
    check(spark, text.extract_date, [
        ("filed on 2024-03-28", day), ("filed on 03/28/2024", day), ("filed March 28, 2024", day), ("filed Mar 28, 2024", day),
        ("no date here", None), ("on 1/2/2020 or 2024-03-28", day), ("2024-13-45 then 3/28/2024", day)])
    check(spark, text.extract_all_dates, [("filed 2024-12-15, decided 2024-03-28, again 12/15/2024", [day, D(2024, 12, 15)]), ("", [])])
    check(spark, text.parse_date_state, [("9/9/2025", D(2025, 9, 9)), ("2024-03-15", D(2024, 3, 15)), ("March 5, 2024", None), ("", None)])


def test_amounts_in_context(spark):
    about = ("Requesting revenue increase of $245.6 million. Commission approved $175 million. "
             "ROE of 10.5%, rate base of $8.75 billion.")
    check(spark, text.revenue_request, [(about, 245.6), ("no revenue info", None), ("increase its revenue requirement by $3.5 billion", 3500.0)])
    check(spark, text.revenue_approved, [(about, 175.0), ("no revenue info", None)])
    check(spark, text.extract_roe, [(about, 10.5), ("return on equity 9.75 %", 9.75), ("none", None)])
    check(spark, text.extract_rate_base, [(about, 8750.0), ("none", None)])


def test_case_types(spark):
    check(spark, lambda x: rules.classify_case_type(x, F.lit("")), [
        ("General Rate Case - Electric Distribution", "general_rate_case"), ("Base Rate Filing for gas service", "general_rate_case"),
        ("Fuel Cost Adjustment Filing", "fuel_cost_adjustment"), ("Distribution System Improvement Charge", "infrastructure_rider"),
        ("Rate Design and Time-of-Use Proceeding", "rate_design"), ("Something completely unrelated", "unknown"), ("", "unknown"),
        ("Revenue Requirement Proceeding", "general_rate_case"), ("because of weather", "fuel_cost_adjustment")])
    check(spark, lambda x: rules.classify_utility_type(x, F.lit("")), [
        ("Electric Distribution Rate Case", "electric"), ("Natural Gas Distribution Rate Case", "gas"), ("Water Service Company - Rate Case", "water"),
        ("Telecommunications Rate Filing", "telecommunications"), ("Something generic", "unknown"), ("wastewater plant", "water"), ("geothermal", "gas")])
    check(spark, lambda x: rules.classify_utility_type(F.lit(""), x), [("UE-220066", "electric"), ("UG 1", "gas"), ("UW-123456", "water"), ("UEX", "unknown")])


def test_status_and_ownership(spark):
    check(spark, rules.normalise_status, [
        ("Active", "active"), ("Open", "active"), ("Decided", "decided"), (" Closed ", "decided"), ("Filed", "filed"), ("Withdrawn", "withdrawn"),
        ("Suspended", "suspended"), ("Settlement reached", "settled"), ("", "unknown"), (None, "unknown"), ("xyzzy", "unknown"), ("in  progress", "active")])
    check(spark, rules.classify_ownership, [
        ("PECO Energy Company Inc.", "investor_owned"), ("Rural Electric Cooperative", "cooperative"), ("City of Seattle Municipal Light", "municipal"),
        ("Some Utility", "investor_owned")])


def test_source_rules(spark):
    def kind(source):
        return lambda x: rules.source_utility_type(F.lit(source), x, x)

    check(spark, kind("connecticut_pura"), [
        ("Connecticut Light and Power Company", "electric"), ("GenConn Energy LLC", "electric"), ("Application for (SCG) rate", "gas"),
        ("Aquarion Water Company", "water"), ("Eversource Energy", "unknown")])
    check(spark, kind("georgia_psc"), [("Georgia Power Rate Case", "electric"), ("Atlanta Gas Light Rate", "gas"), ("Telephone rate", "telecommunications"), ("x", "unknown")])
    check(spark, kind("oregon_puc"), [("UM 1", "multi"), ("UE 9", "electric"), ("XX", "unknown")])
    check(spark, lambda x: rules.source_case_type(F.lit("missouri_psc"), x, F.lit("ER-2024-0319")), [
        ("General Rate Increase", "general_rate_case"), ("Fuel Adjustment Clause", "fuel_cost_adjustment"),
        ("Infrastructure Replacement Surcharge", "infrastructure_rider"), ("", "general_rate_case")])
    check(spark, lambda x: rules.gazetteer_name(x, V.GAZETTEER_CT), [
        ("Eversource Energy rate case", "Eversource Energy"), ("(CNG) application", "Connecticut Natural Gas Corporation"), ("unknown", "")])
    check(spark, rules.fuel_category, [(p.title(), f) for p, f in V.FUEL_PHRASES] + [("", "other"), (None, "other"), ("tidal", "other")])


def test_names(spark):
    check(spark, names.clean_name, [
        ("PECO Energy Company Inc.", "PECO Energy Company"), ("PPL Electric Utilities Corporation", "PPL Electric Utilities"),
        ("Duke Energy Indiana LLC", "Duke Energy Indiana"), ("Duquesne Light Co.", "Duquesne Light"), ("Pacific Gas & Electric", "Pacific Gas and Electric"),
        ("  PECO   Energy   Company  ", "PECO Energy"), ("", ""), ("Test Utility,", "Test Utility"), ("PacifiCorp", "Pacifi")])
    check(spark, names.norm_for_match, [("The Pacific Gas & Electric Company", "the pacific gas and electric"), ("Portland General Electric", "portland general")])


def test_dockets(spark):
    check(spark, dockets.docket_year, [("24-10-04", 2024), ("00-01-01", 2000), ("99-12-01", 1999), ("invalid", None), ("ER-2024-0319", 2024), ("A.23-05-010", 2023)])
    check(spark, dockets.docket_date, [("24-10-04", D(2024, 10, 1)), ("24-13-01", None), ("24-00-01", None), ("invalid", None)])
    check(spark, dockets.title_year, [("Georgia Power 2022 Rate Case", 2022), ("Rate Case (2004)", 2004), ("No year here", None), ("x12022", None)])
    check(spark, dockets.docket_normalise, [("UE399", "UE 399"), ("UG 12[PDF]", "UG 12"), ("24-10-04RE01", "24-10-04")])
    check(spark, dockets.petitioner, [("​North - Star Gas - Gas​, OUCC", "North - Star Gas"), ("Solo", "Solo"), (None, "")])


def test_cells(spark):
    check(spark, text.safe_int, [("1,234", 1234), ("N/A", None), (".", None), ("", None), (None, None), ("12.7", 12), ("abc", None)])
    check(spark, text.safe_float, [("1,234.56", 1234.56), ("NA", None), ("-", None), ("1.23456", 1.2346)])
    check(spark, text.field_float, [("245.6", 245.6), ("$10 million", 10.0), ("1e3", 1000.0), ("5d", None), ("abc", None)])


def test_html(spark):
    check(spark, html.strip_html, [
        ("<p>A &amp; B</p>", "A & B"), ("&lt;b&gt;&nbsp;x", "<b> x"), ("caf&eacute; &#8364;5 &amp;lt;", "café €5 &lt;"), ("<br>", None), (None, None)])
    check(spark, lambda x: F.array_join(html.companies(html.raw_companies(x)), "|"), [
        ('<div>Subject Companies</div><a aria-label="View relationships for Ameren Missouri" href="#">Ameren Missouri</a><div>Style of Case</div>', "Ameren Missouri"),
        ("Application of North Star Gas, for rates", "North Star Gas")])
    check(spark, html.earliest_date, [("<td>12/15/2024</td><td>1/2/2025</td><td>6/30/2024</td>", D(2024, 6, 30)), ("<td>No dates here</td>", None)])
    check(spark, html.best_text, [("<td>short</td><td>A long cell without anything financial in it</td><td>The company asks for $5 million now</td>",
                                   "The company asks for $5 million now")])


def test_references_and_their_contexts(spark):
    from tariffworks.operators.pages import docket_references

    pages = [(1, "text [24-10-04RE01] more"), (2, "a" * 300 + "[24-10-04]" + "b" * 300), (3, "[24-10-04] again [18-03-28] filing"),
             (4, '<a href="#">see 18-03-28 here</a> <a>99-13-01</a> <a>17-01-02</a>')]
    got = {r.docket_number: r.context for r in docket_references(spark.createDataFrame(pages, "page_id long, html string")).collect()}
    assert set(got) == {"24-10-04RE01", "24-10-04", "18-03-28", "17-01-02"}
    assert got["24-10-04"] == "a" * 200 + "[24-10-04]" + "b" * 200
    assert got["18-03-28"] == "[24-10-04] again [18-03-28] filing"


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 50_000])
def test_places_of_matches_on_pages_of_any_length(spark, n):
    page = "".join(f"é<p>[24-{i % 12 + 1:02d}-{i % 100:02d}] of {i}</p>" for i in range(n))
    row = spark.createDataFrame([(page,), (None,)], "html string").select(
        html.matches_with_place(F.col("html"), html.BRACKET_REF).alias("m")).collect()
    expected = [(m.group(1), m.start() + 1, len(m.group())) for m in re.finditer(html.BRACKET_REF, page)]
    assert [tuple(x) for x in row[0].m] == expected and row[1].m is None


def test_surroundings_are_cut_in_blocks(spark):
    from tariffworks.operators.pages import docket_references

    page = "".join(f"é [24-{i % 12 + 1:02d}-{i % 100:02d}] of {i}; " for i in range(700))
    row = spark.createDataFrame([(page,), ("",), (None,)], "html string").select(
        html.with_surroundings(F.col("html"), html.matches_with_place(F.col("html"), html.BRACKET_REF)).alias("m")).collect()
    expected = [page[max(m.start() - 200, 0) : m.end() + 200].strip() for m in re.finditer(html.BRACKET_REF, page)]
    assert [x.around for x in row[0].m] == expected and not row[1].m and not row[2].m
    many = "".join(f"<p>[24-{i % 12 + 1:02d}-{i % 100:02d}] of {i}</p>" for i in range(50_000))
    assert docket_references(spark.createDataFrame([(1, many)], "page_id long, html string")).count() == 300


def test_records(spark):
    base = {f.name: None for f in RAW_RECORD.fields}
    raw = [
        {**base, "docket_number": " R-2024-3046894", "utility_name": "PECO Energy Company", "state": "pa", "source": "pennsylvania_puc",
         "status": "active", "filing_date": "2024-03-28", "requested_revenue_change": "245.6"},
        {**base, "docket_number": "R-2024-001", "utility_name": "Test Electric Co", "state": "PA", "source": "pennsylvania_puc",
         "description": "General Rate Case - Electric Distribution Service, approved $5 million"},
        {**base, "docket_number": " ", "utility_name": "x", "state": "PA", "source": "s"},
    ]
    cases, rejects = parse_record(spark.createDataFrame(raw, RAW_RECORD))
    first, second = cases.orderBy(F.col("requested_revenue_change").desc()).collect()
    assert (first.docket_number, first.state, first.status, first.filing_date, first.requested_revenue_change) == (
        "R-2024-3046894", "PA", "active", D(2024, 3, 28), 245.6)
    # an amount without a request is taken as the request as well
    assert (second.case_type, second.utility_type, second.requested_revenue_change, second.approved_revenue_change) == (
        "general_rate_case", "electric", 5.0, 5.0)
    assert rejects.count() == 1
