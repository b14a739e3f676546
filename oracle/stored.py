"""SQL for the queries of ``catalog.stored``."""

from __future__ import annotations

from oracle.tables import case, query, text
from tariffworks import fixed_values as V

SHOWN = ("docket_number, source, utility_name, state, case_type, status, filing_date, "
         "requested_revenue_change, approved_revenue_change, quality_score")
LABELS = ("CASE WHEN coalesce(case_type, '') = '' THEN 'Unknown' ELSE coalesce("
          + case("case_type", V.CASE_TYPE_LABELS)
          + ", array_to_string(list_transform(string_split(replace(case_type, '_', ' '), ' '), "
            "lambda x: upper(x[1]) || lower(x[2:])), ' ')) END")
UTILITY_COLUMNS = ("name, canonical_name, state, utility_type, ownership_type, parent_company, "
                   "customer_count, eia_utility_id, ferc_respondent_id")
OPS_COLUMNS = "* EXCLUDE (seq)"
MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"


def hist(source: str, value: str, bins: int) -> str:
    return query(
        f"SELECT CASE WHEN width > 0 THEN CAST(least(floor((v - low) / width) + 1, {bins}) AS INT) ELSE 1 END AS bin, "
        "count(*) AS cnt FROM hist_known, hist_span GROUP BY 1",
        {
            "hist_known": f"SELECT CAST({value} AS DOUBLE) AS v FROM {source} WHERE {value} IS NOT NULL",
            "hist_span": f"SELECT min(v) AS low, (max(v) - min(v)) / {bins} AS width FROM hist_known",
        },
    )


APPROVALS = ("(SELECT *, approved_revenue_change / requested_revenue_change * 100 AS approval_pct FROM rate_cases "
             "WHERE approved_revenue_change IS NOT NULL AND requested_revenue_change <> 0)")
DURATIONS = ("(SELECT *, CAST(decision_date - filing_date AS INT) AS days FROM rate_cases "
             "WHERE decision_date IS NOT NULL AND filing_date IS NOT NULL)")
SUMMARY = """
    SELECT display_name, count(docket_number) AS total_cases,
           round(coalesce(sum(requested_revenue_change), 0), 6) AS total_requested,
           round(coalesce(sum(approved_revenue_change), 0), 6) AS total_approved,
           round(avg(return_on_equity), 6) AS avg_roe,
           string_agg(DISTINCT state, ', ' ORDER BY state) AS states
    FROM rate_cases WHERE display_name IS NOT NULL GROUP BY display_name"""
APPROVAL_BY = f"SELECT display_name, round(avg(approval_pct), 6) AS approval_pct FROM {APPROVALS} GROUP BY 1"
NEWEST_OPS = ("(SELECT * FROM utility_operations QUALIFY row_number() OVER "
              "(PARTITION BY eia_utility_id ORDER BY year DESC, seq DESC) = 1)")


def mean_top(table: str, value: str, name: str) -> str:
    return query(f"SELECT state, round(avg({value}), 6) AS {name} FROM {table} WHERE {value} IS NOT NULL "
                 f"AND state IS NOT NULL GROUP BY state ORDER BY {name} DESC, state LIMIT 20")


def money(x: str, missing: str) -> str:
    return f"coalesce('$' || format('{{:,.1f}}', {x}), '{missing}')"


def counts(key: str) -> str:
    return query(f"SELECT {key}, count(*) AS cnt FROM rate_cases GROUP BY {key}")


MIX = [f"{f}_pct" for f in V.FUELS[:6]] + ["other_renewable_pct"]
MIX_LABELS = [f.title() for f in V.FUELS[:6]] + ["Other Renewable"]

def statistics(rows: str) -> str:
    """All statistics of a table of cases in long form."""
    single = {
        ("total", "cases"): "count(*)", ("total", "unique_utilities"): "count(DISTINCT utility_name)",
        ("financial", "cases_with_revenue_data"): "count(requested_revenue_change)",
        ("financial", "total_requested_m"): "round(coalesce(sum(requested_revenue_change), 0), 1)",
        ("financial", "avg_requested_m"): "round(coalesce(avg(requested_revenue_change), 0), 1)",
        ("financial", "total_approved_m"): "round(coalesce(sum(approved_revenue_change) FILTER (requested_revenue_change IS NOT NULL), 0), 1)",
        ("financial", "avg_approved_m"): "round(coalesce(avg(approved_revenue_change) FILTER (requested_revenue_change IS NOT NULL), 0), 1)",
        ("financial", "avg_roe_pct"): "round(coalesce(avg(return_on_equity) FILTER (requested_revenue_change IS NOT NULL), 0), 2)",
        ("quality", "avg_score"): "round(coalesce(avg(quality_score), 0), 3)", ("quality", "min_score"): "round(coalesce(min(quality_score), 0), 3)",
        ("quality", "max_score"): "round(coalesce(max(quality_score), 0), 3)", ("quality", "above_threshold"): "count(*) FILTER (quality_score >= 0.6)",
        ("dates", "earliest_filing"): "strftime(min(filing_date), '%Y%m%d')", ("dates", "latest_filing"): "strftime(max(filing_date), '%Y%m%d')",
    }
    parts = [f"SELECT '{a}' AS section, CAST(NULL AS VARCHAR) AS key, '{b}' AS metric, CAST({v} AS DOUBLE) AS value FROM {rows}" for (a, b), v in single.items()]
    parts += [f"SELECT 'by_{k}', {k}, 'cases', CAST(count(*) AS DOUBLE) FROM {rows} GROUP BY {k}" for k in ("state", "source", "case_type", "status")]
    return " UNION ALL ".join(parts)


def _counted(section: str, metric: str, table: str, what: str = "*") -> str:
    return f" UNION ALL SELECT '{section}', NULL, '{metric}', CAST(count({what}) AS DOUBLE) FROM {table}"


SQL = {
    "stats_all": query(statistics("rate_cases") + _counted("documents", "documents", "case_documents")
                       + "".join(_counted("enrichment", *x) for x in [
                           ("utility_operations", "utility_operations"), ("eia_links", "links"), ("emissions_records", "utility_emissions"),
                           ("capacity_records", "utility_capacity"), ("impact_records", "impacts"),
                           ("unique_eia_utilities", "utility_operations", "DISTINCT eia_utility_id"), ("linked_utilities", "links", "DISTINCT eia_utility_id")])),
    "filter_cases": query(f"SELECT {SHOWN} FROM rate_cases WHERE state = 'AL' AND (utility_name ILIKE '%group%' "
                          "OR canonical_utility_name ILIKE '%group%') AND status = 'decided' AND quality_score >= 0.7"),
    "page_cases": query(f"SELECT {SHOWN} FROM rate_cases ORDER BY filing_date DESC NULLS LAST, docket_number, source LIMIT 25 OFFSET 50"),
    "lookup_case": query(f"SELECT {SHOWN} FROM rate_cases WHERE docket_number = '77' ORDER BY docket_number, source LIMIT 1"),
    "docs_for_docket": query("SELECT * FROM case_documents WHERE docket_number = '77' ORDER BY filing_date, title"),
    "list_utilities": query(f"SELECT {UTILITY_COLUMNS} FROM utilities ORDER BY name"),
    "filter_operations": query(f"SELECT {OPS_COLUMNS} FROM utility_operations WHERE state = 'AK' AND year = 1998"),
    "filter_emissions": query("SELECT * FROM utility_emissions WHERE year = 1998"),
    "filter_capacity": query("SELECT * FROM utility_capacity WHERE year = 2001"),
    "list_impacts": query("SELECT * FROM impacts ORDER BY abs(monthly_bill_impact) DESC"),
    "list_links": query("SELECT utility_name, state, eia_utility_id, 1.0::DOUBLE AS match_confidence, 'exact' AS match_method FROM links"),
    "explore_cases": query(f"""
        SELECT {SHOWN}, display_name, {LABELS} AS case_type_display FROM rate_cases
        WHERE case_type = 'general_rate_case' AND utility_type = 'gas'
          AND (regexp_matches(utility_name, 'GROUP 1|000[1-3]5', 'i') OR regexp_matches(display_name, 'GROUP 1|000[1-3]5', 'i')
               OR regexp_matches(docket_number, 'GROUP 1|000[1-3]5', 'i'))"""),
    "explore_projection": query(f"""
        SELECT docket_number AS "Docket", display_name AS "Utility", state AS "State", {LABELS} AS "Type",
               utility_type AS "Service", status AS "Status", coalesce(strftime(filing_date, '%Y-%m-%d'), '') AS "Filed",
               coalesce(strftime(decision_date, '%Y-%m-%d'), '') AS "Decided", requested_revenue_change AS "Requested ($M)",
               approved_revenue_change AS "Approved ($M)", return_on_equity AS "ROE (%)", quality_score AS "Quality" FROM rate_cases"""),
    "display_name": query("SELECT docket_number, source, display_name FROM rate_cases"),
    "facet_values": query(" UNION ".join(
        f"SELECT '{n}' AS facet, {e} AS value FROM rate_cases WHERE {e} IS NOT NULL" for n, e in
        {"state": "state", "case_type_display": LABELS, "status": "status", "utility_type": "utility_type",
         "docket_number": "docket_number"}.items())),
    "year_range_keep_null": query("SELECT docket_number, source, filing_date FROM rate_cases WHERE filing_date IS NULL OR year(filing_date) BETWEEN 1996 AND 1997"),
    "year_range_strict": query("SELECT docket_number, source, filing_date FROM rate_cases WHERE year(filing_date) BETWEEN 1996 AND 1997"),
    "sibling_cases": query(f"""
        SELECT docket_number, state, {LABELS} AS case_type_display, status, filing_date, requested_revenue_change
        FROM rate_cases WHERE docket_number <> '77'
          AND display_name IN (SELECT display_name FROM rate_cases WHERE docket_number = '77')"""),
    "stats_total": query("SELECT count(*) AS cnt FROM rate_cases"),
    "stats_by_state": counts("state"),
    "stats_by_source": counts("source"),
    "stats_by_case_type": counts("case_type"),
    "stats_by_status": counts("status"),
    "stats_financial": query("""
        SELECT count(*) AS cases_with_revenue_data, round(coalesce(sum(requested_revenue_change), 0), 1) AS total_requested_m,
               round(coalesce(avg(requested_revenue_change), 0), 1) AS avg_requested_m,
               round(coalesce(sum(approved_revenue_change), 0), 1) AS total_approved_m,
               round(coalesce(avg(approved_revenue_change), 0), 1) AS avg_approved_m,
               round(coalesce(avg(return_on_equity), 0), 2) AS avg_roe_pct
        FROM rate_cases WHERE requested_revenue_change IS NOT NULL"""),
    "stats_quality": query("""
        SELECT round(coalesce(avg(quality_score), 0), 3) AS avg_score, round(coalesce(min(quality_score), 0), 3) AS min_score,
               round(coalesce(max(quality_score), 0), 3) AS max_score, count(*) FILTER (quality_score >= 0.6) AS above_threshold
        FROM rate_cases WHERE quality_score IS NOT NULL"""),
    "stats_unique_utilities": query("SELECT count(DISTINCT utility_name) AS cnt FROM rate_cases"),
    "stats_documents": query("SELECT count(*) AS cnt FROM case_documents"),
    "stats_date_range": query("SELECT min(filing_date) AS earliest_filing, max(filing_date) AS latest_filing FROM rate_cases"),
    "stats_enrichment": query("""
        SELECT 'utility_operations' AS metric, count(*) AS cnt FROM utility_operations
        UNION ALL SELECT 'eia_links', count(*) FROM links UNION ALL SELECT 'emissions_records', count(*) FROM utility_emissions
        UNION ALL SELECT 'capacity_records', count(*) FROM utility_capacity UNION ALL SELECT 'impact_records', count(*) FROM impacts
        UNION ALL SELECT 'unique_eia_utilities', count(DISTINCT eia_utility_id) FROM utility_operations
        UNION ALL SELECT 'linked_utilities', count(DISTINCT eia_utility_id) FROM links"""),
    "kpi_overview": query("""
        SELECT count(*) AS total_cases, count(DISTINCT state) AS states, count(*) FILTER (status = 'active') AS active,
               count(*) FILTER (status = 'decided') AS decided, count(DISTINCT display_name) AS utilities FROM rate_cases"""),
    "counts_by_state": query("SELECT state, count(*) AS cnt FROM rate_cases WHERE state IS NOT NULL GROUP BY state"),
    "counts_by_utility_type": query("SELECT utility_type, count(*) AS cnt FROM rate_cases WHERE utility_type IS NOT NULL GROUP BY 1"),
    "utility_summary": query(SUMMARY),
    "approval_by_utility": query(APPROVAL_BY),
    "avg_change_by_state": query("""
        SELECT state, round(avg(requested_revenue_change), 6) AS avg_requested, round(avg(approved_revenue_change), 6) AS avg_approved
        FROM rate_cases WHERE requested_revenue_change IS NOT NULL AND state IS NOT NULL GROUP BY state"""),
    "ops_kpis": query("""
        SELECT count(eia_utility_id) AS utilities, CAST(coalesce(sum(c), 0) AS BIGINT) AS total_customers,
               round(coalesce(sum(r), 0), 4) AS total_revenue,
               (SELECT round(avg(residential_avg_price), 6) FROM utility_operations) AS avg_price
        FROM (SELECT eia_utility_id, max(total_customers) AS c, max(total_revenue) AS r FROM utility_operations GROUP BY 1)"""),
    "ownership_counts": query(f"SELECT ownership_type, count(*) AS cnt FROM {NEWEST_OPS} WHERE ownership_type IS NOT NULL GROUP BY 1"),
    "price_by_state_top20": mean_top("utility_operations", "residential_avg_price", "avg_price"),
    "impact_kpis": query("SELECT count(*) AS cases, round(avg(monthly_bill_impact), 6) AS avg_monthly, max(monthly_bill_impact) AS max_monthly FROM impacts"),
    "emissions_kpis": query("""
        SELECT round(coalesce(sum(co2_tons), 0), 4) AS total_co2, round(avg(co2_rate_lbs_mwh), 6) AS avg_rate,
               round(coalesce(sum(net_generation_mwh), 0), 4) AS total_generation FROM utility_emissions"""),
    "generation_mix": query("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT {text(label)} AS fuel, round(avg({col}), 6) AS pct FROM utility_emissions"
        for label, col in zip(MIX_LABELS, MIX)) + ") WHERE pct > 0"),
    "co2_by_state_top20": mean_top("utility_emissions", "co2_rate_lbs_mwh", "avg_rate"),
    "capacity_kpis": query("""
        SELECT round(coalesce(sum(total_capacity_mw), 0), 4) AS total_mw, round(avg(avg_generator_age), 6) AS avg_age,
               CAST(coalesce(sum(num_generators), 0) AS BIGINT) AS generators FROM utility_capacity"""),
    "capacity_mix": query("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{f.title()}' AS fuel, round(coalesce(sum({f}_capacity_mw), 0), 4) AS mw FROM utility_capacity" for f in V.FUELS)
        + ") WHERE mw > 0"),
    "additions_vs_retirements": query("""
        SELECT 'Planned Additions' AS category, round(coalesce(sum(planned_additions_mw), 0), 4) AS mw FROM utility_capacity
        UNION ALL SELECT 'Planned Retirements', round(coalesce(sum(planned_retirements_mw), 0), 4) FROM utility_capacity"""),
    "state_rollup": query("""
        SELECT state, count(docket_number) AS case_count, round(coalesce(sum(requested_revenue_change), 0), 6) AS total_requested,
               round(coalesce(sum(approved_revenue_change), 0), 6) AS total_approved, round(avg(return_on_equity), 6) AS avg_roe
        FROM rate_cases WHERE state IS NOT NULL GROUP BY state"""),
    "filings_by_year_state": query("SELECT CAST(year(filing_date) AS INT) AS year, state, count(*) AS cnt FROM rate_cases WHERE filing_date IS NOT NULL AND state IS NOT NULL GROUP BY 1, 2"),
    "filings_by_month": query(f"SELECT CAST(month(filing_date) AS INT) AS month, {MONTHS}[month(filing_date)] AS label, count(*) AS cnt FROM rate_cases WHERE filing_date IS NOT NULL GROUP BY 1, 2"),
    "duration_by_state": query(f"SELECT state, round(avg(days), 6) AS avg_days FROM {DURATIONS} WHERE state IS NOT NULL GROUP BY 1"),
    "duration_days": query("SELECT docket_number, source, CAST(decision_date - filing_date AS INT) AS days FROM rate_cases"),
    "approval_pct": query(f"SELECT docket_number, source, round(approval_pct, 6) AS approval_pct FROM {APPROVALS}"),
    "date_parts": query(f"SELECT docket_number, source, CAST(year(filing_date) AS INT) AS year, CAST(month(filing_date) AS INT) AS month, {MONTHS}[month(filing_date)] AS label FROM rate_cases"),
    "money_format": query(f"SELECT docket_number, source, {money('requested_revenue_change', 'N/A')} AS requested, {money('approved_revenue_change', 'Pending')} AS approved FROM rate_cases"),
    "hist_quality": hist("rate_cases", "quality_score", 20),
    "hist_approval_pct": hist(APPROVALS, "approval_pct", 20),
    "hist_monthly_impact": hist("impacts", "monthly_bill_impact", 30),
    "hist_pct_of_bill": hist("impacts", "pct_of_avg_bill", 20),
    "hist_co2_rate": hist("utility_emissions", "co2_rate_lbs_mwh", 30),
    "hist_fleet_age": hist("utility_capacity", "avg_generator_age", 20),
    "hist_duration_days": hist(DURATIONS, "days", 20),
    "top_requests": query(f"SELECT {SHOWN} FROM rate_cases WHERE coalesce(requested_revenue_change, 0) <> 0 ORDER BY abs(requested_revenue_change) DESC, docket_number, source LIMIT 15"),
    "top_utilities_by_cases": query(SUMMARY + " ORDER BY total_cases DESC, display_name LIMIT 15"),
    "top_approval": query(APPROVAL_BY + " ORDER BY approval_pct DESC, display_name LIMIT 15"),
    "top_customers": query("""
        SELECT eia_utility_id, utility_name, state, total_customers, residential_avg_price, ownership_type FROM utility_operations
        WHERE year = (SELECT max(year) FROM utility_operations) AND total_customers IS NOT NULL
        ORDER BY total_customers DESC, eia_utility_id LIMIT 15"""),
    "top_impacts": query("SELECT * FROM impacts ORDER BY monthly_bill_impact DESC, docket_number, source LIMIT 15"),
    "top_emitters": query("""
        SELECT utility_name_egrid, state, year, co2_tons, co2_rate_lbs_mwh, net_generation_mwh FROM utility_emissions
        WHERE co2_tons IS NOT NULL ORDER BY co2_tons DESC, utility_name_egrid, year LIMIT 15"""),
    "top_capacity": query("""
        SELECT eia_utility_id, total_capacity_mw, num_plants, num_generators, avg_generator_age FROM utility_capacity
        WHERE total_capacity_mw IS NOT NULL ORDER BY total_capacity_mw DESC, eia_utility_id LIMIT 15"""),
    "fleet_rollup": query("SELECT * FROM utility_capacity"),
    "bill_impact": query("SELECT * FROM impacts"),
    "impact_join": query("SELECT docket_number, source, linked_id AS eia_utility_id, approved_revenue_change, total_customers, residential_avg_price FROM impact_rows"),
    "latest_operations": query("SELECT eia_utility_id, year, total_customers, residential_avg_price FROM latest_ops"),
    "latest_year_slice": query("SELECT eia_utility_id, year, total_customers FROM utility_operations WHERE year = (SELECT max(year) FROM utility_operations)"),
    "last_wins": query("SELECT utility_name, eia_utility_id, state, seq FROM links QUALIFY row_number() OVER (PARTITION BY utility_name ORDER BY seq DESC) = 1"),
    "dedupe_first": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1""",
    "drop_duplicates_first": query(f"SELECT eia_utility_id, year, ownership_type, total_customers FROM {NEWEST_OPS}"),
    "docket_label": query("""
        SELECT docket_number, docket_number || ' - ' || display_name AS label FROM rate_cases
        QUALIFY row_number() OVER (PARTITION BY docket_number ORDER BY filing_date DESC NULLS LAST, source) = 1"""),
    "sink_report_utilities": query("SELECT " + ", ".join(f'{x} AS "{t}"' for t, x in V.REPORT_UTILITY_COLUMNS) + " FROM utilities"),
    "sink_report_cells": query("SELECT " + ", ".join(
        f'{"display_name" if x == "canonical_utility_name" else x} AS "{t}"' for t, x in V.REPORT_CASE_COLUMNS) + " FROM rate_cases"),
    "sink_cases_json": query("SELECT count(*) AS total_records, (SELECT count(*) FROM utilities) AS total_utilities, '1.1' AS format_version FROM rate_cases"),
}
