"""Queries over stored tables: filters, projections, statistics, reports, top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tariffworks.functions.text import duration_days, money_format
from tariffworks.operators import filters, firstwins, impact
from tariffworks.plans import adapters as A
from tariffworks.plans import reports as R
from tariffworks.sources import writers

c = F.col

CASE_KEY = ["docket_number", "source"]
SHOWN = ["docket_number", "source", "utility_name", "state", "case_type", "status", "filing_date",
         "requested_revenue_change", "approved_revenue_change", "quality_score"]


def impacts(s, d):
    return impact.rate_case_impacts(A.rate_cases(s, d), A.links(s, d), A.utility_operations(s, d))


def capacity(s, d):
    from tariffworks.operators.fleet import fleet_rollup

    return fleet_rollup(A.generators(s, d), 2001, 2001)


def _approval(s, d):
    rows = R.approval_rows(A.rate_cases(s, d))
    return rows.select(*CASE_KEY, F.round("approval_pct", 6).alias("approval_pct"))



QUERIES = {
    # filters and projections
    "filter_cases": lambda s, d: filters.filter_cases(
        A.rate_cases(s, d), state="al", utility_name="group", status="decided", min_quality=0.7
    ).select(*SHOWN),
    "page_cases": lambda s, d: filters.page_cases(A.rate_cases(s, d), 25, 50).select(*SHOWN),
    "lookup_case": lambda s, d: filters.lookup_case(A.rate_cases(s, d), "77").select(*SHOWN),
    "docs_for_docket": lambda s, d: filters.docs_for_docket(A.case_documents(s, d), "77"),
    "list_utilities": lambda s, d: filters.list_utilities(A.utilities(s, d).drop("seq")),
    "filter_operations": lambda s, d: filters.filter_operations(
        A.utility_operations(s, d), state="ak", year=1998).drop("seq"),
    "filter_emissions": lambda s, d: filters.filter_emissions(A.utility_emissions(s, d), year=1998),
    "filter_capacity": lambda s, d: filters.filter_capacity(capacity(s, d), year=2001),
    "list_impacts": lambda s, d: filters.list_impacts(impacts(s, d)),
    "list_links": lambda s, d: A.links(s, d).drop("seq"),
    "explore_cases": lambda s, d: filters.explore_cases(
        A.rate_cases(s, d), case_type_display="General Rate Case", utility_type="gas",
        search="GROUP 1|000[1-3]5").select(*SHOWN, "display_name", "case_type_display"),
    "explore_projection": lambda s, d: filters.explore_projection(
        filters.with_display(A.rate_cases(s, d))),
    "display_name": lambda s, d: filters.with_display(A.rate_cases(s, d)).select(*CASE_KEY, "display_name"),
    "facet_values": lambda s, d: filters.facet_values(A.rate_cases(s, d)),
    "year_range_keep_null": lambda s, d: filters.year_range(
        A.rate_cases(s, d), "filing_date", 1996, 1997, True).select(*CASE_KEY, "filing_date"),
    "year_range_strict": lambda s, d: filters.year_range(
        A.rate_cases(s, d), "filing_date", 1996, 1997, False).select(*CASE_KEY, "filing_date"),
    "sibling_cases": lambda s, d: filters.sibling_cases(A.rate_cases(s, d), "77").select(
        "docket_number", "state", "case_type_display", "status", "filing_date", "requested_revenue_change"),
    # statistics
    "stats_total": lambda s, d: R.stats_total(A.rate_cases(s, d)),
    "stats_by_state": lambda s, d: R.stats_by(A.rate_cases(s, d), "state"),
    "stats_by_source": lambda s, d: R.stats_by(A.rate_cases(s, d), "source"),
    "stats_by_case_type": lambda s, d: R.stats_by(A.rate_cases(s, d), "case_type"),
    "stats_by_status": lambda s, d: R.stats_by(A.rate_cases(s, d), "status"),
    "stats_financial": lambda s, d: R.stats_financial(A.rate_cases(s, d)),
    "stats_quality": lambda s, d: R.stats_quality(A.rate_cases(s, d)),
    "stats_unique_utilities": lambda s, d: R.stats_unique_utilities(A.rate_cases(s, d)),
    "stats_documents": lambda s, d: R.stats_total(A.case_documents(s, d)),
    "stats_date_range": lambda s, d: R.stats_date_range(A.rate_cases(s, d)),
    "stats_enrichment": lambda s, d: R.stats_enrichment(
        A.utility_operations(s, d), A.links(s, d), A.utility_emissions(s, d), capacity(s, d), impacts(s, d)),
    "stats_all": lambda s, d: R.store_statistics(
        A.rate_cases(s, d), A.case_documents(s, d), A.utility_operations(s, d), A.links(s, d), A.utility_emissions(s, d),
        capacity(s, d), impacts(s, d)),
    # reports
    "kpi_overview": lambda s, d: R.kpi_overview(A.rate_cases(s, d)),
    "counts_by_state": lambda s, d: R.counts_by(A.rate_cases(s, d), "state"),
    "counts_by_utility_type": lambda s, d: R.counts_by(A.rate_cases(s, d), "utility_type"),
    "utility_summary": lambda s, d: R.utility_summary(A.rate_cases(s, d)),
    "approval_by_utility": lambda s, d: R.approval_by_utility(A.rate_cases(s, d)),
    "avg_change_by_state": lambda s, d: R.avg_change_by_state(A.rate_cases(s, d)),
    "ops_kpis": lambda s, d: R.ops_kpis(A.utility_operations(s, d)),
    "ownership_counts": lambda s, d: R.ownership_counts(A.utility_operations(s, d)),
    "price_by_state_top20": lambda s, d: R.price_by_state_top20(A.utility_operations(s, d)),
    "impact_kpis": lambda s, d: R.impact_kpis(impacts(s, d)),
    "emissions_kpis": lambda s, d: R.emissions_kpis(A.utility_emissions(s, d)),
    "generation_mix": lambda s, d: R.generation_mix(A.utility_emissions(s, d)),
    "co2_by_state_top20": lambda s, d: R.co2_by_state_top20(A.utility_emissions(s, d)),
    "capacity_kpis": lambda s, d: R.capacity_kpis(capacity(s, d)),
    "capacity_mix": lambda s, d: R.capacity_mix(capacity(s, d)),
    "additions_vs_retirements": lambda s, d: R.additions_vs_retirements(capacity(s, d)),
    "state_rollup": lambda s, d: R.state_rollup(A.rate_cases(s, d)),
    "filings_by_year_state": lambda s, d: R.filings_by_year_state(A.rate_cases(s, d)),
    "filings_by_month": lambda s, d: R.filings_by_month(A.rate_cases(s, d)),
    "duration_by_state": lambda s, d: R.duration_by_state(A.rate_cases(s, d)),
    "duration_days": lambda s, d: A.rate_cases(s, d).select(
        *CASE_KEY, duration_days(c("filing_date"), c("decision_date")).alias("days")),
    "approval_pct": _approval,
    "date_parts": lambda s, d: A.rate_cases(s, d).select(
        *CASE_KEY, F.year("filing_date").alias("year"), F.month("filing_date").alias("month"),
        R.month_label(F.month("filing_date")).alias("label")),
    "money_format": lambda s, d: A.rate_cases(s, d).select(
        *CASE_KEY, money_format(c("requested_revenue_change")).alias("requested"),
        money_format(c("approved_revenue_change"), "Pending").alias("approved")),
    # histograms
    "hist_quality": lambda s, d: R.score_histogram(A.rate_cases(s, d), "quality_score", 20),
    "hist_approval_pct": lambda s, d: R.histogram(R.approval_rows(A.rate_cases(s, d)), "approval_pct", 20),
    "hist_monthly_impact": lambda s, d: R.histogram(impacts(s, d), "monthly_bill_impact", 30),
    "hist_pct_of_bill": lambda s, d: R.histogram(impacts(s, d), "pct_of_avg_bill", 20),
    "hist_co2_rate": lambda s, d: R.histogram(A.utility_emissions(s, d), "co2_rate_lbs_mwh", 30),
    "hist_fleet_age": lambda s, d: R.histogram(capacity(s, d), "avg_generator_age", 20),
    "hist_duration_days": lambda s, d: R.histogram(R.durations(A.rate_cases(s, d)), "duration_days", 20),
    # top lists
    "top_requests": lambda s, d: R.top_requests(A.rate_cases(s, d)).select(*SHOWN),
    "top_utilities_by_cases": lambda s, d: R.top_utilities_by_cases(A.rate_cases(s, d)),
    "top_approval": lambda s, d: R.top_approval(A.rate_cases(s, d)),
    "top_customers": lambda s, d: R.top_customers(A.utility_operations(s, d)).select(
        "eia_utility_id", "utility_name", "state", "total_customers", "residential_avg_price", "ownership_type"),
    "top_impacts": lambda s, d: R.top_impacts(impacts(s, d)),
    "top_emitters": lambda s, d: R.top_emitters(A.utility_emissions(s, d)).select(
        "utility_name_egrid", "state", "year", "co2_tons", "co2_rate_lbs_mwh", "net_generation_mwh"),
    "top_capacity": lambda s, d: R.top_capacity(capacity(s, d)).select(
        "eia_utility_id", "total_capacity_mw", "num_plants", "num_generators", "avg_generator_age"),
    # roll-ups and impact
    "fleet_rollup": capacity,
    "bill_impact": impacts,
    "impact_join": lambda s, d: impact.impact_join(
        A.rate_cases(s, d), A.links(s, d), A.utility_operations(s, d)).select(
        *CASE_KEY, "eia_utility_id", "approved_revenue_change", "total_customers", "residential_avg_price"),
    "latest_operations": lambda s, d: firstwins.latest_operations(A.utility_operations(s, d)).select(
        "eia_utility_id", "year", "total_customers", "residential_avg_price"),
    "latest_year_slice": lambda s, d: firstwins.latest_year_slice(A.utility_operations(s, d)).select(
        "eia_utility_id", "year", "total_customers"),
    "last_wins": lambda s, d: firstwins.last_per_key(
        A.links(s, d).select("utility_name", "eia_utility_id", "state", "seq"), ["utility_name"], "seq"),
    "dedupe_first": lambda s, d: firstwins.first_per_key(
        A.table(s, d, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
        ["l_orderkey", "l_linenumber"], "l_partkey", "l_suppkey", "l_extendedprice"),
    "drop_duplicates_first": lambda s, d: R.newest_per_utility(A.utility_operations(s, d)).select(
        "eia_utility_id", "year", "ownership_type", "total_customers"),
    "docket_label": lambda s, d: firstwins.docket_labels(filters.with_display(A.rate_cases(s, d))),
    # exports
    "sink_report_utilities": lambda s, d: writers.utility_cells(A.utilities(s, d)),
    "sink_report_cells": lambda s, d: writers.report_cells(A.rate_cases(s, d)),
    "sink_cases_json": lambda s, d: writers.json_metadata(A.rate_cases(s, d), A.utilities(s, d)).select(
        "total_records", "total_utilities", "format_version"),
}
