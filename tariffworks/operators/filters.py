"""Filters and projections of the stored tables.

Predicates are plain column expressions, so they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions.text import case_type_label

c = F.col


def display_name() -> Column:
    return F.coalesce("canonical_utility_name", "utility_name")


def with_display(cases: DataFrame) -> DataFrame:
    """Cases with the name and the case type label shown to readers."""
    return cases.withColumn("display_name", display_name()).withColumn(
        "case_type_display", case_type_label(c("case_type"))
    )


def filter_cases(cases: DataFrame, state: str | None = None, utility_name: str | None = None,
                 case_type: str | None = None, status: str | None = None,
                 min_quality: float | None = None) -> DataFrame:
    """Cases that meet all filters given; a name matches in part, in any case."""
    out = cases
    if state:
        out = out.filter(c("state") == state.upper())
    if utility_name:
        part = f"%{utility_name}%"
        out = out.filter(c("utility_name").ilike(part) | c("canonical_utility_name").ilike(part))
    if case_type:
        out = out.filter(c("case_type") == case_type)
    if status:
        out = out.filter(c("status") == status)
    if min_quality is not None:
        out = out.filter(c("quality_score") >= min_quality)
    return out


def page_cases(cases: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """One page of cases, newest filing first; without a limit all from the offset on."""
    page = cases.orderBy(c("filing_date").desc_nulls_last(), "docket_number", "source").offset(offset)
    return page if limit is None else page.limit(limit)


def lookup_case(cases: DataFrame, docket: str, source: str | None = None) -> DataFrame:
    """The first case of a docket."""
    hit = cases.filter(c("docket_number") == docket)
    if source:
        hit = hit.filter(c("source") == source)
    return hit.orderBy("docket_number", "source").limit(1)


def docs_for_docket(documents: DataFrame, docket: str) -> DataFrame:
    return documents.filter(c("docket_number") == docket).orderBy("filing_date", "title")


def list_utilities(utilities: DataFrame) -> DataFrame:
    return utilities.orderBy("name")


def _filtered(df: DataFrame, **equal) -> DataFrame:
    for name, value in equal.items():
        if value is not None:
            df = df.filter(c(name) == value)
    return df


def filter_operations(ops: DataFrame, eia_utility_id: int | None = None, state: str | None = None,
                      year: int | None = None) -> DataFrame:
    out = _filtered(ops, eia_utility_id=eia_utility_id, state=state and state.upper(), year=year)
    return out.orderBy(c("year").desc(), "eia_utility_id")


def filter_emissions(emissions: DataFrame, state: str | None = None, year: int | None = None
                     ) -> DataFrame:
    out = _filtered(emissions, state=state and state.upper(), year=year)
    return out.orderBy(c("co2_tons").desc_nulls_last(), "utility_name_egrid", "year")


def filter_capacity(capacity: DataFrame, eia_utility_id: int | None = None,
                    year: int | None = None) -> DataFrame:
    out = _filtered(capacity, eia_utility_id=eia_utility_id, year=year)
    return out.orderBy(c("total_capacity_mw").desc_nulls_last(), "eia_utility_id")


def list_impacts(impacts: DataFrame) -> DataFrame:
    return impacts.orderBy(F.abs("monthly_bill_impact").desc(), "docket_number", "source")


def explore_cases(cases: DataFrame, state: str | None = None, case_type_display: str | None = None,
                  status: str | None = None, utility_type: str | None = None,
                  search: str | None = None) -> DataFrame:
    """Cases with display columns that meet the filters; ``search`` is a pattern."""
    shown = _filtered(
        with_display(cases), state=state, case_type_display=case_type_display, status=status,
        utility_type=utility_type,
    )
    if search:
        pattern = f"(?i){search}"
        hit = F.lit(False)
        for name in ("utility_name", "display_name", "docket_number"):
            hit = hit | F.coalesce(c(name).rlike(pattern), F.lit(False))
        shown = shown.filter(hit)
    return shown


def explore_projection(shown: DataFrame) -> DataFrame:
    """The twelve columns of the case table; missing dates are shown as ''."""
    dated = shown.withColumns({
        f"{d}_str": F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit(""))
        for d in ("filing_date", "decision_date")
    })
    return dated.select(*[c(a).alias(b) for a, b in V.EXPLORE_COLUMNS])


def facet_values(cases: DataFrame) -> DataFrame:
    """Distinct values of each filter, as (facet, value)."""
    facets = ["state", "case_type_display", "status", "utility_type", "docket_number"]
    long = with_display(cases).select(*facets).unpivot([], facets, "facet", "value")
    return long.filter(c("value").isNotNull()).distinct()


def year_range(df: DataFrame, date: str, low: int, high: int, keep_null: bool) -> DataFrame:
    """Rows dated within the years; rows without a date are kept or dropped as told."""
    inside = F.year(date).between(low, high)
    return df.filter(inside | c(date).isNull() if keep_null else inside)


def sibling_cases(cases: DataFrame, docket: str) -> DataFrame:
    """Other cases of the organisation a docket belongs to."""
    shown = with_display(cases)
    names = shown.filter(c("docket_number") == docket).select("display_name").distinct()
    return shown.filter(c("docket_number") != docket).join(names, "display_name", "left_semi")
