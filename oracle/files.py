"""SQL for the queries of ``catalog.files``: what was written must come back."""

from __future__ import annotations

from oracle.links import EMI, OPS
from oracle.texts import CHECK_CASE, CHECK_DOCUMENT, CHECK_UTILITY  # parsed_records too
from oracle.tables import query
from tariffworks import fixed_values as V

SQL = {
    "src_raw_json": query("SELECT * EXCLUDE (seq), " + ", ".join(f"CAST(NULL AS VARCHAR) AS {x}" for x in [
        "approved_revenue_change", "rate_base", "return_on_equity", "requested_rate_change_pct", "approved_rate_change_pct", "scraped_at"]) + " FROM raw_records"),
    "src_raw_json_rejects": query("SELECT DISTINCT 'cut-list-' || seq // 1000 AS part, 'malformed file' AS reason, 100 AS n_chars FROM raw_records WHERE seq % 1000 <> 999"),
    "src_union_all": query("SELECT docket_number, source, CASE WHEN source <> 'oregon_puc' THEN source_url END AS source_url, description FROM raw_records"),
    "src_ops_sheet": query("SELECT " + OPS.replace(" ", ", ") + " FROM utility_operations WHERE eia_utility_id NOT IN (0, 3)"),
    "src_ops_csv": query("SELECT " + OPS.replace(" ", ", ") + " FROM utility_operations WHERE eia_utility_id NOT IN (0, 3)"),
    "src_emissions_map": query("SELECT " + EMI.replace(" ", ", ") + ", " + ", ".join(f"CAST(NULL AS DOUBLE) AS {x}" for x in [
        "nox_tons", "so2_tons", "nox_rate_lbs_mwh", "so2_rate_lbs_mwh"]) + " FROM utility_emissions"),
    "src_generator_rows": query("SELECT * FROM generators WHERE nameplate_mw NOT IN (7, 9)"),
    "src_paged_json_cases": query("""SELECT CAST(floor(seq / 50) AS BIGINT) AS page_no, docket_number AS iurc_docketnumber,
        strftime(filing_date, '%m/%d/%Y') AS iurc_petitiondate, utility_name AS iurc_forpetionersearch, utility_type AS iurc_industry
        FROM rate_cases_plain WHERE status <> 'filed'"""),
    "sink_tables": query(" UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n, CAST(sum({' + '.join(f'length(CAST({k} AS VARCHAR))' for k in keys)}) AS BIGINT) AS key_length FROM {table}"
        for name, table, keys in [
            ("rate_cases", "rate_cases", ["docket_number", "source"]), ("utilities", "utilities", ["name", "state"]),
            ("case_documents", "case_documents", ["docket_number"]), ("pipeline_runs", "(SELECT lpad(o_orderkey::VARCHAR, 8, '0') AS run_id FROM orders)", ["run_id"]),
            ("utility_operations", "utility_operations", ["coalesce(eia_utility_id::VARCHAR, '')", "year"]),
            ("utility_eia_links", "links", ["utility_name", "state", "eia_utility_id"]),
            ("utility_emissions", "utility_emissions", ["utility_name_egrid", "coalesce(state, '')", "year"]),
            ("utility_capacity", "utility_capacity", ["eia_utility_id", "year"]), ("rate_case_impacts", "impacts", ["docket_number", "source"])])),
    "sink_cases_csv": query("SELECT " + ", ".join(
        f"replace({x}, '&amp;', '&') AS {x}" if x == "description" else x for x in V.CASE_EXPORT_COLUMNS) + " FROM rate_cases"),
    "sink_enrichment_csv": query("SELECT * FROM utility_capacity"),
    "sink_operations_csv": query("SELECT * EXCLUDE (seq) FROM utility_operations"),
    "sink_emissions_csv": query("SELECT * FROM utility_emissions"),
    "sink_impacts_csv": query("SELECT * FROM impacts"),
    "sink_json_cases": query("""SELECT docket_number, source, utility_name, state, filing_date, approved_revenue_change,
        replace(description, '&amp;', '&') AS description, quality_score FROM rate_cases"""),
    "schema_store_case": query(f"""SELECT CASE WHEN reasons = '' THEN docket_number ELSE ' ' || docket_number END AS docket_number, source,
        CASE WHEN reasons = '' THEN state ELSE lower(state) END AS state,
        CASE WHEN reasons = '' THEN round(requested_revenue_change + 0.0001::DOUBLE, 3) ELSE requested_revenue_change + 0.0001::DOUBLE END AS requested_revenue_change, reasons
        FROM (SELECT *, {CHECK_CASE} AS reasons FROM rate_cases)"""),
    "schema_store_utility": query(f"""SELECT CASE WHEN reasons = '' THEN name ELSE name || ' ' END AS name, CASE WHEN reasons = '' THEN state ELSE lower(state) END AS state, reasons
        FROM (SELECT *, {CHECK_UTILITY} AS reasons FROM utilities)"""),
    "schema_store_document": query(f"""SELECT docket_number, title, CASE WHEN reasons = '' THEN url ELSE url || '  ' END AS url, reasons
        FROM (SELECT *, {CHECK_DOCUMENT} AS reasons FROM case_documents)"""),
    "sink_case_table": query("SELECT docket_number, source, state, filing_date, requested_revenue_change, quality_score FROM rate_cases"),
    "job_export": query("""SELECT 'rate_cases' AS name, count(*) AS n FROM rate_cases UNION ALL SELECT 'json', count(*) FROM rate_cases
        UNION ALL SELECT 'utility_operations', count(*) FROM utility_operations UNION ALL SELECT 'utility_emissions', count(*) FROM utility_emissions
        UNION ALL SELECT 'utility_capacity', count(*) FROM utility_capacity UNION ALL SELECT 'rate_case_impacts', count(*) FROM impacts
        UNION ALL SELECT 'report_utilities', count(*) FROM utilities"""),
    "stream_ingest": query("""SELECT docket_number, source, utility_name, state, case_type, utility_type, status, filing_date,
        requested_revenue_change, approved_revenue_change FROM parsed_records"""),
}
