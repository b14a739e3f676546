"""SQL for the queries of ``catalog.links``.

Fuzzy stages compare every pair; the Spark side never does.
"""

from __future__ import annotations

from oracle.stored import LABELS, SQL as STORED, statistics
from oracle.tables import STATE, TABLES, array, query, score, text
from oracle.texts import ISSUES, VALIDATE, clean, form, lcs, norm, ratio, words
from tariffworks import fixed_values as V

# Bound on the pairs worth scoring: lengths alone.
NEAR = "200 * least(len(a), len(b)) >= ({t} - 0.5) * (len(a) + len(b))"

def _folded(rows: str) -> str:
    """The last value of each column by key."""
    return "SELECT docket_number, source, " + ", ".join(
        f"arg_max({x}, seq) FILTER ({x} IS NOT NULL) AS {x}" for x in
        ["utility_name", "state", "case_type", "status", "decision_date", "approved_revenue_change"]) + f" FROM ({rows}) GROUP BY 1, 2"


T = {
    "alias_forms": f"SELECT *, {form('alias')} AS b FROM aliases",
    "names_clean": f"SELECT utility_name, state, {clean('utility_name')} AS cleaned FROM raw_names",
    "names_exact": """SELECT n.*, x.canonical AS x_canonical, x.parent AS x_parent, x.utility_type AS x_type,
        y.canonical AS y_canonical, y.parent AS y_parent, y.utility_type AS y_type
        FROM names_clean n LEFT JOIN aliases x ON x.alias = lower(trim(utility_name)) LEFT JOIN aliases y ON y.alias = lower(cleaned)""",
    "name_pairs": f"""SELECT * FROM (SELECT n.utility_name, n.state, n.a, f.*, {ratio('a', 'b', lcs('a', 'b'))} AS score
        FROM (SELECT *, {form('lower(cleaned)')} AS a FROM names_exact WHERE x_canonical IS NULL AND y_canonical IS NULL) n,
             (SELECT canonical, parent, utility_type, alias_state, pos, b FROM alias_forms) f
        WHERE {NEAR.format(t=85)}) WHERE score >= 85""",
    "name_any": "SELECT * FROM name_pairs QUALIFY row_number() OVER (PARTITION BY utility_name ORDER BY score DESC, pos) = 1",
    "name_in_state": """SELECT * FROM name_pairs WHERE coalesce(state, '') = '' OR alias_state IS NULL OR alias_state = upper(state)
        QUALIFY row_number() OVER (PARTITION BY utility_name ORDER BY score DESC, pos) = 1""",
    "names_resolved": """SELECT n.utility_name, n.state,
        coalesce(x_canonical, y_canonical, i.canonical, g.canonical, cleaned) AS canonical_name,
        CASE WHEN x_canonical IS NOT NULL THEN x_parent WHEN y_canonical IS NOT NULL THEN y_parent
             WHEN i.canonical IS NOT NULL THEN i.parent ELSE g.parent END AS parent_company,
        coalesce(x_type, y_type, i.utility_type, g.utility_type, 'unknown') AS utility_type,
        CASE WHEN x_canonical IS NOT NULL THEN 'exact_alias' WHEN y_canonical IS NOT NULL THEN 'cleaned_exact'
             WHEN i.canonical IS NOT NULL THEN 'fuzzy_' || i.score WHEN g.canonical IS NOT NULL THEN 'fuzzy_' || g.score
             ELSE 'unresolved' END AS match_method
        FROM names_exact n LEFT JOIN name_in_state i USING (utility_name) LEFT JOIN name_any g USING (utility_name)""",
    "named_cases": f"""SELECT CAST(p_partkey AS VARCHAR) AS docket_number, s.utility_name, n.state, DATE '2000-01-01' - CAST(p_partkey % 1000 AS INT) AS filing_date
        FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN alias WHEN 1 THEN alias || ', Inc.'
                 WHEN 2 THEN substr(alias, 1, 3) || substr(alias, 5, 100) WHEN 3 THEN alias || ' ' || substr(p_name, 1, 3)
                 ELSE p_name || ' Co-op ' || p_brand END AS utility_name
              FROM part JOIN aliases ON p_partkey % (SELECT count(*) FROM aliases) = pos) s JOIN raw_names n USING (utility_name)""",
    "utility_rows": """SELECT name, state, utility_type, parent_company FROM (
            SELECT r.canonical_name AS name, k.state, r.utility_type, r.parent_company, k.filing_date, k.docket_number
            FROM named_cases k JOIN names_resolved r USING (utility_name))
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY filing_date DESC, docket_number) = 1""",
    "left_forms": f"SELECT name, state, norm, {form('norm')} AS a FROM (SELECT name, state, {norm('name')} AS norm FROM link_left)",
    "right_forms": f"SELECT eia_utility_id, state, seq, norm, {form('norm')} AS b FROM (SELECT eia_utility_id, upper(trim(state)) AS state, seq, {norm('utility_name')} AS norm FROM link_right WHERE eia_utility_id <> 0)",
    "right_by_state": "SELECT norm, state, any_value(b) AS b, arg_max(eia_utility_id, seq) AS id, min(seq) AS rank FROM right_forms GROUP BY 1, 2",
    "right_by_name": "SELECT norm, any_value(b) AS b, arg_min(eia_utility_id, seq) AS id, min(seq) AS rank FROM right_forms GROUP BY 1",
    "stage_exact": "SELECT l.*, r.id FROM left_forms l LEFT JOIN right_by_state r ON l.norm = r.norm AND l.state = r.state",
    "stage_near": f"""SELECT name, state, id, score FROM (
            SELECT l.name, l.state, r.id, r.rank, {ratio('l.a', 'r.b', lcs('l.a', 'r.b'))} AS score
            FROM (SELECT name, state, a FROM stage_exact WHERE id IS NULL) l JOIN right_by_state r ON l.state = r.state) WHERE score >= 82
        QUALIFY row_number() OVER (PARTITION BY name, state ORDER BY score DESC, rank) = 1""",
    "far_left": "SELECT name, state, a FROM stage_exact WHERE id IS NULL AND (name, state) NOT IN (SELECT (name, state) FROM stage_near)",
    "far_pairs": f"""SELECT a, id, rank, {ratio('a', 'b', lcs('a', 'b'))} AS score FROM (SELECT DISTINCT a FROM far_left), (SELECT b, id, rank FROM right_by_name)""",
    "stage_far": """SELECT f.name, f.state, p.id, p.score FROM far_left f JOIN far_pairs p USING (a) WHERE p.score >= 87
        QUALIFY row_number() OVER (PARTITION BY f.name, f.state ORDER BY p.score DESC, p.rank) = 1""",
    "all_links": """SELECT name AS utility_name, state, id AS eia_utility_id, 1.0::DOUBLE AS match_confidence, 'exact' AS match_method FROM stage_exact WHERE id IS NOT NULL
        UNION ALL SELECT name, state, id, round(score / 100, 2), 'fuzzy_' || score FROM stage_near
        UNION ALL SELECT name, state, id, round(score / 100, 2), 'fuzzy_cross_state_' || score FROM stage_far""",
    "known_forms": f"SELECT norm, state, {form('norm')} AS b, arg_max(eia_utility_id, seq) AS id, min(seq) AS rank FROM (SELECT *, {norm('utility_name')} AS norm FROM link_right) GROUP BY 1, 2",
    "emission_names": "SELECT l.*, CASE WHEN length(name) > 12 THEN length(name) END AS own_id FROM left_forms l",
    "emission_near": f"""SELECT name, state, id, score FROM (SELECT l.name, l.state, r.id, r.rank, {ratio('l.a', 'r.b', lcs('l.a', 'r.b'))} AS score
            FROM emission_names l JOIN known_forms r ON l.state = r.state) WHERE score >= 82
        QUALIFY row_number() OVER (PARTITION BY name, state ORDER BY score DESC, rank) = 1""",
    "emissions_linked": """SELECT e.name AS utility_name_egrid, e.state, coalesce(x.id, n.id, own_id) AS eia_utility_id,
            CAST(coalesce(x.id, n.id) IS NOT NULL AS INT) AS is_linked
        FROM emission_names e LEFT JOIN known_forms x ON e.norm = x.norm AND e.state = x.state
        LEFT JOIN emission_near n ON e.name = n.name AND e.state = n.state""",
    "old_cases": "SELECT docket_number, source, utility_name, state, case_type, utility_type, status, decision_date, requested_revenue_change, approved_revenue_change FROM rate_cases_plain WHERE filing_date < DATE '1998-01-01'",
    "batch_rows": """SELECT docket_number, source, utility_name, state, CASE WHEN l_linenumber > 5 THEN 'rate_design' END AS case_type,
            CASE WHEN l_linestatus = 'F' THEN 'decided' END AS status, CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS decision_date,
            CASE WHEN l_returnflag = 'A' THEN l_quantity END AS approved_revenue_change,
            row_number() OVER (ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS seq
        FROM lineitem JOIN rate_cases_plain ON CAST(l_orderkey AS VARCHAR) = docket_number""",
    "batch_folded": _folded("SELECT * FROM batch_rows"),
}
TABLES.update(T)

STORE = """SELECT 'oregon_puc' AS source, count(*) AS records_processed,
      (SELECT count(DISTINCT docket_number) FROM batch_rows WHERE coalesce(approved_revenue_change, 50) <> 50
         AND docket_number NOT IN (SELECT docket_number FROM old_cases WHERE source = 'oregon_puc')) AS records_created,
      (SELECT count(*) FROM batch_rows WHERE coalesce(approved_revenue_change, 50) <> 50)
       - (SELECT count(DISTINCT docket_number) FROM batch_rows WHERE coalesce(approved_revenue_change, 50) <> 50
         AND docket_number NOT IN (SELECT docket_number FROM old_cases WHERE source = 'oregon_puc')) AS records_updated,
      count(*) FILTER (coalesce(approved_revenue_change, 50) = 50) AS errors
    FROM batch_rows"""

SCORES = ("SELECT docket_number, source, CASE WHEN status = 'decided' THEN quality_score / 2 ELSE quality_score END AS quality_score, CASE WHEN status = 'decided' THEN '2001-02-03' END AS updated FROM rate_cases")


def keep(columns: list[str], old: str = "o", new: str = "b") -> str:
    return ", ".join(f"coalesce({new}.{x}, {old}.{x}) AS {x}" for x in columns)


def upsert(table: str, keys: list[str], changed: dict[str, str], old_filter: str, columns: str) -> str:
    """Null-preserving merge of a table, changed in one column, into some of its own rows."""
    on = " AND ".join(f"b.{k} = o.{k}" for k in keys)
    names = [x for x in columns.split()]
    return query(f"SELECT {', '.join(f'coalesce(b.{x}, o.{x}) AS {x}' for x in names)} FROM upsert_new b LEFT JOIN upsert_old o ON {on}", {
        "upsert_new": "SELECT " + ", ".join(f"{changed.get(x, x)} AS {x}" for x in names) + f" FROM {table}",
        "upsert_old": f"SELECT * FROM {table} WHERE {old_filter}"})


OPS = ("eia_utility_id year utility_name state ownership_type residential_customers commercial_customers industrial_customers total_customers "
       "residential_revenue commercial_revenue industrial_revenue total_revenue residential_sales_mwh commercial_sales_mwh industrial_sales_mwh "
       "total_sales_mwh residential_avg_price commercial_avg_price industrial_avg_price avg_price revenue_per_customer quality_score")
EMI = ("utility_name_egrid state year eia_utility_id net_generation_mwh co2_tons co2_rate_lbs_mwh coal_pct gas_pct nuclear_pct hydro_pct wind_pct "
       "solar_pct other_renewable_pct quality_score")
CAP = ("eia_utility_id year " + " ".join(f"{f}_capacity_mw" for f in V.FUELS) + " total_capacity_mw num_plants num_generators avg_generator_age "
       "planned_additions_mw planned_retirements_mw quality_score")

VALIDATED = {"validated": f"SELECT *, {score('has_eia_link', 'has_emissions', 'has_impact')} AS new_score, {ISSUES} AS issue_text, {VALIDATE} AS error_text FROM flags"}
N_ISSUES = "CASE WHEN issue_text = '' THEN 0 ELSE len(string_split(issue_text, '; ')) END"

INGESTED = {
    "ingest_folded": "SELECT * FROM parsed_records",
    "ingest_names": f"SELECT DISTINCT utility_name, {clean('utility_name')} AS cleaned FROM parsed_records",
    "ingest_rows": "SELECT p.*, cleaned AS canonical_utility_name FROM parsed_records p JOIN ingest_names USING (utility_name)",
}

SQL = {
    "resolve_exact": query("SELECT utility_name, x_canonical AS canonical FROM names_exact"),
    "resolve_cleaned": query("SELECT utility_name, cleaned AS cleaned_name, y_canonical AS canonical FROM names_exact"),
    "resolve_fuzzy_state": query("SELECT utility_name, canonical, score FROM name_in_state"),
    "resolve_fuzzy_any": query("SELECT utility_name, canonical, score FROM name_any"),
    "resolve_utilities": query("SELECT * FROM names_resolved"),
    "parent_company": query("SELECT utility_name, parent_company FROM names_resolved"),
    "resolution_summary": query("SELECT count(*) FILTER (match_method <> 'unresolved') AS resolved, count(*) AS total FROM names_resolved"),
    "apply_name_mapping": query("SELECT docket_number, utility_name, canonical_name AS canonical_utility_name FROM named_cases JOIN names_resolved USING (utility_name)"),
    "first_utility_row": query("SELECT * FROM utility_rows"),
    "link_exact": query("SELECT * FROM all_links WHERE match_method = 'exact'"),
    "link_fuzzy_state": query("SELECT * FROM all_links WHERE match_method LIKE 'fuzzy_%' AND match_method NOT LIKE 'fuzzy_cross%'"),
    "link_fuzzy_cross_state": query("SELECT * FROM all_links WHERE match_method LIKE 'fuzzy_cross%'"),
    "link_utilities": query("SELECT * FROM all_links"),
    "link_summary": query("SELECT (SELECT count(*) FROM all_links) AS matched, (SELECT count(*) FROM link_left) - (SELECT count(*) FROM all_links) AS unmatched"),
    "link_emissions": query("SELECT * FROM emissions_linked"),
    "dedupe_eia": query("SELECT eia_utility_id, utility_name, upper(state) AS state FROM link_right WHERE eia_utility_id <> 0"),
    "best_match": query("SELECT utility_name, state, match_confidence FROM all_links"),
    "merge_existence": query("SELECT CAST((docket_number, source) IN (SELECT (docket_number, source) FROM old_cases) AS INT) AS is_stored, count(*) AS n FROM batch_rows GROUP BY 1"),
    "merge_cases": query("""SELECT docket_number, source, coalesce(b.utility_name, o.utility_name) AS utility_name, coalesce(b.state, o.state) AS state,
            CASE WHEN o.docket_number IS NULL THEN coalesce(b.case_type, 'unknown') ELSE coalesce(b.case_type, o.case_type) END AS case_type,
            CASE WHEN o.docket_number IS NULL THEN 'unknown' ELSE o.utility_type END AS utility_type,
            CASE WHEN o.docket_number IS NULL THEN coalesce(b.status, 'unknown') ELSE coalesce(b.status, o.status) END AS status,
            coalesce(b.decision_date, o.decision_date) AS decision_date, o.requested_revenue_change,
            coalesce(b.approved_revenue_change, o.approved_revenue_change) AS approved_revenue_change
        FROM (SELECT *, docket_number AS k FROM old_cases) o FULL JOIN batch_folded b USING (docket_number, source)"""),
    "merge_cases_batch": query("""SELECT count(*) AS processed, count(DISTINCT (docket_number, source)) FILTER ((docket_number, source) NOT IN (SELECT (docket_number, source) FROM old_cases)) AS created,
            count(*) - count(DISTINCT (docket_number, source)) FILTER ((docket_number, source) NOT IN (SELECT (docket_number, source) FROM old_cases)) AS updated FROM batch_rows"""),
    "merge_store": query("""SELECT coalesce(b.docket_number, o.docket_number) AS docket_number, coalesce(o.source, 'oregon_puc') AS source, coalesce(b.utility_name, o.utility_name) AS utility_name,
            coalesce(b.state, o.state) AS state,
            CASE WHEN o.docket_number IS NULL THEN coalesce(b.case_type, 'unknown') ELSE coalesce(b.case_type, o.case_type) END AS case_type,
            CASE WHEN o.docket_number IS NULL THEN 'unknown' ELSE o.utility_type END AS utility_type,
            CASE WHEN o.docket_number IS NULL THEN coalesce(b.status, 'unknown') ELSE coalesce(b.status, o.status) END AS status,
            coalesce(b.decision_date, o.decision_date) AS decision_date, o.requested_revenue_change,
            coalesce(b.approved_revenue_change, o.approved_revenue_change) AS approved_revenue_change
        FROM old_cases o FULL JOIN store_folded b ON b.docket_number = o.docket_number AND b.source = o.source""", {
        "store_folded": _folded("SELECT * REPLACE ('oregon_puc' AS source) FROM batch_rows WHERE coalesce(approved_revenue_change, 50) <> 50")}),
    "update_counts": query("SELECT 2 * count(*) AS given, count(*) AS touched FROM rate_cases WHERE status = 'decided'"),
    "job_normalise_cases": query("SELECT docket_number, utility_name, canonical_name AS canonical_utility_name FROM named_cases JOIN names_resolved USING (utility_name)"),
    "report_summary_by_state": STORED["stats_by_state"], "report_summary_by_type": STORED["stats_by_case_type"],
    "report_summary_financial": STORED["stats_financial"], "report_summary_quality": STORED["stats_quality"],
    "run_counters": query(STORE),
    "merge_utilities": query("""SELECT name, state, o.canonical_name AS canonical_name, coalesce(b.utility_type, o.utility_type, 'unknown') AS utility_type,
            coalesce(b.ownership_type, o.ownership_type, 'unknown') AS ownership_type, coalesce(b.parent_company, o.parent_company) AS parent_company,
            o.customer_count, o.eia_utility_id, o.ferc_respondent_id
        FROM utilities_old o FULL JOIN utilities_new b USING (name, state)""", {
        "utilities_old": "SELECT * FROM utilities WHERE eia_utility_id % 2 = 0",
        "utilities_new": """SELECT name, state, arg_max('telecommunications', o_orderkey) FILTER (o_orderstatus <> 'F') AS utility_type,
            arg_max('municipal', o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS ownership_type,
            arg_max(o_orderpriority, o_orderkey) FILTER (o_orderstatus = 'O') AS parent_company
            FROM orders JOIN utilities ON o_custkey = eia_utility_id GROUP BY 1, 2"""}),
    "merge_operations": upsert("utility_operations", ["eia_utility_id", "year"],
                               {"total_customers": "CASE WHEN year % 2 = 1 THEN total_customers + 1 END"}, "year <= 1998", OPS),
    "merge_emissions": upsert("utility_emissions", ["utility_name_egrid", "state", "year"],
                              {"co2_tons": "CASE WHEN year % 2 = 1 THEN co2_tons + 1 END"}, "year <= 1998", EMI),
    "merge_capacity": upsert("utility_capacity", ["eia_utility_id", "year"],
                             {"num_plants": "CASE WHEN num_plants % 2 = 1 THEN num_plants + 1000 END"}, "num_generators % 2 = 0", CAP),
    "merge_links": query("""SELECT utility_name, state, eia_utility_id, CASE WHEN arg_max(seq, seq) % 3 <> 0 THEN CAST(max(seq) AS DOUBLE) END AS match_confidence,
            'new' AS match_method FROM links GROUP BY 1, 2, 3"""),
    "merge_impacts": query("SELECT * REPLACE (CAST(NULL AS DOUBLE) AS pct_of_avg_bill) FROM impacts"),
    "append_documents": query("""SELECT docket_number, document_type, title, source, state FROM case_documents
            UNION ALL SELECT docket_number, CASE WHEN document_type = 'order' THEN 'other' ELSE document_type END, title, source, state
            FROM case_documents WHERE document_type <> 'testimony'"""),
    "update_names": query("SELECT docket_number, canonical_name AS canonical_utility_name FROM named_cases JOIN names_resolved USING (utility_name)"),
    "update_scores": query(SCORES),
    "score_update_join": query(SCORES),
    "audit_run": "SELECT lpad(o_orderkey::VARCHAR, 8, '0') AS run_id, o_orderpriority AS source, CASE WHEN o_orderstatus = 'P' THEN 'running' ELSE 'completed' END AS status, "
                 "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END AS records_processed FROM orders",
    "case_orders_join": query("""SELECT docket_number, source, coalesce(f, m) AS decision_date FROM rate_cases_plain LEFT JOIN (
            SELECT l_orderkey, arg_min(CAST(l_shipdate AS DATE), ROW(l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)) FILTER (l_returnflag = 'A') AS f,
                   CAST(max(l_shipdate) AS DATE) AS m FROM lineitem GROUP BY 1) ON CAST(l_orderkey AS VARCHAR) = docket_number"""),
    "decision_from_orders": """SELECT l_suppkey AS supplier, coalesce(arg_min(CAST(l_shipdate AS DATE), ROW(l_orderkey, l_linenumber, l_partkey, l_extendedprice)) FILTER (l_discount = 0.05::DOUBLE),
            CAST(max(l_shipdate) AS DATE)) AS decision_date FROM lineitem GROUP BY 1""",
    "enrichment_flags": query("SELECT docket_number, source, CAST(has_eia_link AS INT) AS has_eia_link, CAST(has_emissions AS INT) AS has_emissions, CAST(has_impact AS INT) AS has_impact FROM flags"),
    "validation_summary": query(f"""SELECT count(*) AS scored, round(avg(new_score), 6) AS avg_score, min(new_score) AS min_score, max(new_score) AS max_score,
            count(*) FILTER (new_score >= 0.6) AS above_threshold, count(*) FILTER (error_text <> '') AS with_errors, CAST(sum({N_ISSUES}) AS BIGINT) AS total_issues FROM validated""", VALIDATED),
    "job_validate": query(f"SELECT docket_number, source, new_score AS quality_score, {N_ISSUES} AS n_issues, error_text AS errors FROM validated", VALIDATED),
    "job_normalise": query("SELECT name, state, utility_type, " + words("lower(name)", [
        ("cooperative", V.COOPERATIVE_WORDS), ("municipal", V.MUNICIPAL_WORDS)], "'investor_owned'") + " AS ownership_type, parent_company FROM utility_rows"),
    "job_enrich": query("""SELECT part, what, count(*) AS n FROM (SELECT 'links' AS part, match_method AS what FROM all_links
        UNION ALL SELECT 'emissions', CAST(is_linked AS VARCHAR) FROM job_emissions
        UNION ALL SELECT 'capacity', CAST(num_plants AS VARCHAR) FROM utility_capacity) GROUP BY 1, 2""", {
        "job_links": "SELECT norm, state, any_value(b) AS b, arg_max(id, (state, id)) AS id FROM (SELECT l.*, f.norm, f.a AS b, l.eia_utility_id AS id FROM all_links l JOIN left_forms f ON f.name = l.utility_name AND f.state = l.state) GROUP BY 1, 2",
        "job_emissions": f"""SELECT e.name, e.state, EXISTS (SELECT 1 FROM job_links k WHERE k.state = e.state AND (k.norm = e.norm OR {ratio('e.a', 'k.b', lcs('e.a', 'k.b'))} >= 82))::INT AS is_linked FROM emission_names e"""}),
    "job_ingest": query(f"""SELECT docket_number, source, utility_name, canonical_utility_name, state, case_type, utility_type, status, filing_date,
            requested_revenue_change, approved_revenue_change, {score()} AS quality_score FROM ingest_rows""", INGESTED),
    "job_pipeline": query(f"""SELECT docket_number, source, utility_name, canonical_utility_name, state, case_type, utility_type, status, filing_date,
            requested_revenue_change, approved_revenue_change, {score()} AS quality_score FROM ingest_rows""", INGESTED),
    "job_pipeline_runs": query("""SELECT left(sha256('first/' || source), 8) AS run_id, source, 'store' AS stage, 'completed' AS status, half AS records_processed, half AS records_created,
            0 AS records_updated, 0 AS errors, '00' AS started, '01' AS completed FROM run_counts
        UNION ALL SELECT left(sha256('second/' || source), 8), source, 'store', 'completed', every, every - half, half, 0, '02', '03' FROM run_counts""", {
        "run_counts": f"""SELECT x AS source, count(seq) AS every, count(seq) FILTER (seq % 2 = 0) AS half
            FROM (SELECT unnest({list(V.SOURCES)}) AS x) LEFT JOIN (SELECT * FROM raw_records WHERE trim(docket_number) <> '') ON source = x GROUP BY 1"""}),
    "job_pipeline_statistics": query(statistics("scored_rows"), {**INGESTED, "scored_rows": f"SELECT *, {score()} AS quality_score FROM ingest_rows"}),
    "report_summary": query("""SELECT docket_number, substr(display_name, 1, 45) AS utility, state, '$' || format('{:,.1f}', requested_revenue_change) AS requested,
            coalesce('$' || format('{:,.1f}', approved_revenue_change), 'Pending') AS approved, status
        FROM rate_cases WHERE coalesce(requested_revenue_change, 0) <> 0 ORDER BY abs(requested_revenue_change) DESC, docket_number, source LIMIT 15"""),
    "case_detail": query(f"""SELECT docket_number, display_name, state, source, status, {LABELS} AS case_type_display, filing_date, decision_date,
            CAST(decision_date - filing_date AS INT) AS duration_days, coalesce('$' || format('{{:,.1f}}', nullif(requested_revenue_change, 0)) || 'M', 'No data yet') AS requested,
            coalesce('$' || format('{{:,.1f}}', nullif(approved_revenue_change, 0)) || 'M', 'Pending') AS approved,
            coalesce('$' || format('{{:,.1f}}', nullif(rate_base, 0)) || 'M', 'No data yet') AS rate_base,
            round(CASE WHEN requested_revenue_change <> 0 AND approved_revenue_change <> 0 THEN approved_revenue_change / requested_revenue_change * 100 END, 1) AS approval_pct
        FROM rate_cases WHERE docket_number = '77'"""),
}
