"""Schemas of the nine stored tables and of raw records.

Money is in millions of USD unless a column name says otherwise; revenue in
``utility_operations`` is in thousands of USD and prices are in cents per kWh.
"""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Names and types as in DDL; needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_RECORD = _schema("""
    docket_number string, utility_name string, state string, source string, case_type string,
    utility_type string, status string, filing_date string, decision_date string, effective_date string,
    requested_revenue_change string, approved_revenue_change string, rate_base string,
    return_on_equity string, requested_rate_change_pct string, approved_rate_change_pct string,
    source_url string, description string, scraped_at string
""")

RATE_CASES = _schema("""
    docket_number string, utility_name string, canonical_utility_name string, state string,
    source string, case_type string, utility_type string, status string, filing_date date,
    decision_date date, effective_date date, requested_revenue_change double,
    approved_revenue_change double, rate_base double, return_on_equity double,
    requested_rate_change_pct double, approved_rate_change_pct double, source_url string,
    description string, quality_score double, scraped_at timestamp, created_at timestamp,
    updated_at timestamp
""")

UTILITIES = _schema("""
    name string, canonical_name string, state string, utility_type string, ownership_type string,
    parent_company string, customer_count bigint, eia_utility_id bigint, ferc_respondent_id bigint,
    created_at timestamp, updated_at timestamp
""")

CASE_DOCUMENTS = _schema("""
    docket_number string, document_type string, title string, filed_by string, filing_date date,
    url string, source string, state string, created_at timestamp
""")

PIPELINE_RUNS = _schema("""
    run_id string, source string, stage string, status string, records_processed bigint,
    records_created bigint, records_updated bigint, errors bigint, started_at timestamp,
    completed_at timestamp, notes string
""")

UTILITY_OPERATIONS = _schema("""
    eia_utility_id bigint, year int, utility_name string, state string, ownership_type string,
    residential_customers bigint, commercial_customers bigint, industrial_customers bigint,
    total_customers bigint, residential_revenue double, commercial_revenue double,
    industrial_revenue double, total_revenue double, residential_sales_mwh double,
    commercial_sales_mwh double, industrial_sales_mwh double, total_sales_mwh double,
    residential_avg_price double, commercial_avg_price double, industrial_avg_price double,
    avg_price double, revenue_per_customer double, quality_score double, created_at timestamp
""")

UTILITY_EIA_LINKS = _schema("""
    utility_name string, state string, eia_utility_id bigint, match_confidence double,
    match_method string, created_at timestamp
""")

UTILITY_EMISSIONS = _schema("""
    utility_name_egrid string, state string, year int, eia_utility_id bigint, net_generation_mwh double,
    co2_tons double, nox_tons double, so2_tons double, co2_rate_lbs_mwh double, nox_rate_lbs_mwh double,
    so2_rate_lbs_mwh double, coal_pct double, gas_pct double, nuclear_pct double, hydro_pct double,
    wind_pct double, solar_pct double, other_renewable_pct double, quality_score double,
    created_at timestamp
""")

UTILITY_CAPACITY = _schema("""
    eia_utility_id bigint, year int, coal_capacity_mw double, gas_capacity_mw double,
    nuclear_capacity_mw double, hydro_capacity_mw double, wind_capacity_mw double,
    solar_capacity_mw double, other_capacity_mw double, total_capacity_mw double, num_plants bigint,
    num_generators bigint, avg_generator_age double, planned_additions_mw double,
    planned_retirements_mw double, quality_score double, created_at timestamp
""")

RATE_CASE_IMPACTS = _schema("""
    docket_number string, source string, eia_utility_id bigint, total_customers bigint,
    monthly_bill_impact double, annual_bill_impact double, pct_of_avg_bill double,
    residential_price_before double, residential_price_after double, created_at timestamp
""")

GENERATOR_ROWS = _schema("""
    utility_id bigint, plant_code bigint, technology string, nameplate_mw double, operating_year int,
    status string, planned_retirement_year int
""")

# table -> (schema, key columns)
TABLES = {
    "rate_cases": (RATE_CASES, ["docket_number", "source"]),
    "utilities": (UTILITIES, ["name", "state"]),
    "case_documents": (CASE_DOCUMENTS, []),
    "pipeline_runs": (PIPELINE_RUNS, ["run_id"]),
    "utility_operations": (UTILITY_OPERATIONS, ["eia_utility_id", "year"]),
    "utility_eia_links": (UTILITY_EIA_LINKS, ["utility_name", "state", "eia_utility_id"]),
    "utility_emissions": (UTILITY_EMISSIONS, ["utility_name_egrid", "state", "year"]),
    "utility_capacity": (UTILITY_CAPACITY, ["eia_utility_id", "year"]),
    "rate_case_impacts": (RATE_CASE_IMPACTS, ["docket_number", "source"]),
}
