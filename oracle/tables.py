"""The logical tables in SQL, written independently of the Spark adapters.

``query(body)`` puts the tables a query needs in front of it.
"""

from __future__ import annotations

import re

from tariffworks import fixed_values as V
from tariffworks.operators.resolve import alias_rows
from tariffworks.plans import adapters as A


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def array(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def case(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in mapping.items()) + " END"


STATE = f"CASE WHEN n_nationkey < 24 THEN {array(V.STATE_CODES)}[n_nationkey + 1] ELSE n_name END"
CANONICAL = "CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment || ' GROUP ' || n_regionkey END"
PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
CLASSES = {"residential": "l_returnflag = 'A'", "commercial": "l_returnflag = 'N'",
           "industrial": "l_returnflag = 'R'", "total": "true"}
SHARES = dict(zip(A.TECHNOLOGY_OF, V.FUELS))

# The score of a case that has no enrichment, component by component.
SCORE_PARTS = """
    (CASE WHEN coalesce(docket_number, '') <> '' THEN 1.0::DOUBLE ELSE 0 END) * 0.12::DOUBLE
    + (CASE WHEN coalesce(canonical_utility_name, '') <> '' THEN 1.0::DOUBLE
            WHEN coalesce(utility_name, '') <> '' THEN 0.7 ELSE 0 END) * 0.10::DOUBLE
    + (CASE WHEN coalesce(case_type, '') NOT IN ('', 'unknown') THEN 1.0::DOUBLE ELSE 0 END) * 0.08::DOUBLE
    + (CASE WHEN filing_date IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) * 0.08::DOUBLE
    + (CASE WHEN decision_date IS NOT NULL THEN 1.0::DOUBLE
            WHEN status IN ('active', 'filed') THEN 0.5 ELSE 0 END) * 0.08::DOUBLE
    + (CASE WHEN requested_revenue_change IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) * 0.12::DOUBLE
    + (CASE WHEN approved_revenue_change IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) * 0.12::DOUBLE
    + (CASE WHEN coalesce(status, '') NOT IN ('', 'unknown') THEN 1.0::DOUBLE ELSE 0 END) * 0.05::DOUBLE
    + (CASE WHEN coalesce(source_url, '') <> '' THEN 1.0::DOUBLE ELSE 0 END) * 0.05::DOUBLE
    + (CASE WHEN {link} THEN 1.0::DOUBLE ELSE 0 END) * 0.10::DOUBLE
    + (CASE WHEN {emission} THEN 1.0::DOUBLE ELSE 0 END) * 0.05::DOUBLE
    + (CASE WHEN {impact} THEN 1.0::DOUBLE ELSE 0 END) * 0.05::DOUBLE
"""


def score(link="false", emission="false", impact="false") -> str:
    return f"round(least(greatest({SCORE_PARTS.format(link=link, emission=emission, impact=impact)}, 0), 1), 3)"


def credits(pairs) -> str:
    return "round(" + " + ".join(f"(CASE WHEN {cond} THEN {w}::DOUBLE ELSE 0 END)" for cond, w in pairs) + ", 3)"


def _whole(x: str) -> str:
    return f"CAST(floor({x}) AS BIGINT)"


def _cents(x: str) -> str:
    return f"CAST(floor(({x}) * 100 + 0.5) AS BIGINT)"


def _ops_measures() -> str:
    out = []
    for name, cond in CLASSES.items():
        out += [
            f"count(DISTINCT CASE WHEN {cond} THEN l_orderkey END) AS {name}_n",
            f"CAST(sum(CASE WHEN {cond} THEN {_cents('l_extendedprice')} END) AS BIGINT) AS {name}_cents",
            f"CAST(sum(CASE WHEN {cond} THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS {name}_mwh",
        ]
    return ", ".join(out)


def _price(n: str) -> str:
    return _whole(f"{n}_cents / {n}_mwh / 100") + " / 100"


OPS_SCORE = credits([
    ("coalesce(eia_utility_id, 0) <> 0", 0.15), ("coalesce(utility_name, '') <> ''", 0.10),
    ("coalesce(state, '') <> ''", 0.10), ("coalesce(total_customers, 0) <> 0", 0.20),
    ("coalesce(total_revenue, 0) <> 0", 0.15), ("coalesce(total_sales_mwh, 0) <> 0", 0.10),
    ("coalesce(residential_avg_price, 0) <> 0", 0.10), ("coalesce(ownership_type, '') <> ''", 0.10),
])
EMISSIONS_SCORE = credits([
    ("coalesce(utility_name_egrid, '') <> ''", 0.15), ("coalesce(state, '') <> ''", 0.10),
    ("coalesce(net_generation_mwh, 0) <> 0", 0.15), ("coalesce(co2_tons, 0) <> 0", 0.15),
    ("coalesce(co2_rate_lbs_mwh, 0) <> 0", 0.15), ("coal_pct IS NOT NULL", 0.10),
    ("gas_pct IS NOT NULL", 0.10), ("coalesce(eia_utility_id, 0) <> 0", 0.10),
])
CAPACITY_SCORE = credits([
    ("coalesce(eia_utility_id, 0) <> 0", 0.15), ("coalesce(total_capacity_mw, 0) <> 0", 0.20),
    ("coalesce(num_generators, 0) <> 0", 0.15), ("coalesce(num_plants, 0) <> 0", 0.10),
    ("coalesce(avg_generator_age, 0) <> 0", 0.15), ("coal_capacity_mw IS NOT NULL", 0.15),
    ("planned_additions_mw IS NOT NULL", 0.10),
])


def fuel(column: str) -> str:
    t = f"lower(trim(coalesce({column}, '')))"
    return "CASE " + " ".join(f"WHEN contains({t}, {text(p)}) THEN {text(f)}" for p, f in V.FUEL_PHRASES) + " ELSE 'other' END"


PLANNED = ("(contains(lower(status), 'proposed') OR contains(lower(status), 'planned') "
           "OR lower(trim(status)) IN ('ts', 'p', 'l', 't'))")

_MONEY = ("(CAST(floor(round(abs(coalesce({0}, requested_revenue_change, 0.0)) * 1000) / 1000) AS BIGINT)::VARCHAR || '.' || "
          "lpad((CAST(round(abs(coalesce({0}, requested_revenue_change, 0.0)) * 1000) AS BIGINT) % 1000)::VARCHAR, 3, '0'))")
MONEY_REQ = _MONEY.format("requested_revenue_change")
MONEY_APP = _MONEY.format("approved_revenue_change")
ROE_TEXT = "((seq % 15)::VARCHAR || '.' || (seq % 10)::VARCHAR)"

TABLES: dict[str, str] = {
    "line_sums": f"""
        SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS last_ship,
               CAST(sum({_cents('l_extendedprice')}) AS BIGINT) AS gross,
               CAST(sum({_cents('l_extendedprice * (1 - l_discount)')}) AS BIGINT) AS net
        FROM lineitem GROUP BY l_orderkey""",
    "case_rows": f"""
        SELECT o.*, c.*, n.*, last_ship, {PRIORITY} AS p,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END
                 * ({_whole('(gross + 50) / 100')} / 1000) AS requested,
               CASE WHEN o_orderstatus = 'F' THEN
                 CASE WHEN o_orderpriority = '5-LOW' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END
                 * ({_whole('(net + 50) / 100')} / 1000) END AS approved,
               CASE WHEN o_orderpriority <> '2-HIGH' THEN
                 {_whole(_cents('o_totalprice') + ' / 300')} / 100 END AS base
        FROM orders o JOIN customer c ON o_custkey = c_custkey
        JOIN nation n ON c_nationkey = n_nationkey
        LEFT JOIN line_sums ON o_orderkey = l_orderkey""",
    "rate_cases_plain": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS docket_number, c_name AS utility_name,
               {CANONICAL} AS canonical_utility_name, {STATE} AS state,
               {array(V.SOURCES)}[n_regionkey + 1] AS source,
               {array(A.CASE_TYPE_OF)}[p] AS case_type,
               {case('c_mktsegment', A.SERVICE_OF)} AS utility_type,
               {case('o_orderstatus', A.STATUS_OF)} AS status,
               CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED')
                    THEN CAST(o_orderdate AS DATE) END AS filing_date,
               CASE WHEN o_orderstatus = 'F' THEN last_ship END AS decision_date,
               CASE WHEN o_orderstatus = 'F' THEN last_ship + 30 END AS effective_date,
               requested AS requested_revenue_change, approved AS approved_revenue_change,
               base AS rate_base,
               CASE WHEN o_orderstatus <> 'O' THEN {_whole(_cents('c_acctbal') + ' / 300')} / 100 END AS return_on_equity,
               CASE WHEN base > 0 THEN {_whole('requested * 10000 / base')} / 100 END AS requested_rate_change_pct,
               CAST(NULL AS DOUBLE) AS approved_rate_change_pct,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 'https://dockets.example.org/' || o_orderkey END AS source_url,
               CASE WHEN o_orderstatus <> 'P' THEN 'Rate  case <b>' || c_mktsegment || '</b> &amp; tariff ' || o_orderkey END AS description,
               o_orderkey AS seq, p, o_orderstatus, c_mktsegment, CAST(o_orderdate AS DATE) AS order_day
        FROM case_rows""",
    "rate_cases": f"""
        SELECT *, {score()} AS quality_score,
               coalesce(canonical_utility_name, utility_name) AS display_name
        FROM rate_cases_plain""",
    "utilities": f"""
        SELECT c_name AS name, {CANONICAL} AS canonical_name, {STATE} AS state,
               coalesce({case('c_mktsegment', A.SERVICE_OF)}, 'unknown') AS utility_type,
               CASE WHEN n_regionkey = 0 THEN 'unknown' ELSE 'investor_owned' END AS ownership_type,
               CASE WHEN n_regionkey = 1 THEN n_name END AS parent_company,
               {_whole('c_acctbal')} AS customer_count, c_custkey AS eia_utility_id,
               CAST(NULL AS BIGINT) AS ferc_respondent_id, c_custkey AS seq
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "case_documents": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS docket_number,
               {case('l_returnflag', A.DOCUMENT_OF)} AS document_type,
               'Exhibit ' || l_linenumber || ' part ' || l_partkey AS title,
               'Supplier ' || l_suppkey AS filed_by, CAST(l_shipdate AS DATE) AS filing_date,
               CASE WHEN l_linestatus = 'F' THEN 'https://files.example.org/' || l_linenumber
                    ELSE 'ftp://files.example.org/' || l_linenumber END AS url,
               'oregon_puc' AS source, 'OR' AS state
        FROM lineitem""",
    "supplier_lines": """
        SELECT l.*, s_name, n_nationkey, n_name, n_regionkey, CAST(year(l_shipdate) AS INT) AS year
        FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "ops_groups": f"""
        SELECT l_suppkey, year, s_name, n_nationkey, n_name, n_regionkey, {_ops_measures()}
        FROM supplier_lines GROUP BY ALL""",
    "ops_rows": f"""
        SELECT l_suppkey AS eia_utility_id, year, s_name AS utility_name, {STATE} AS state,
               {array(A.OWNERSHIP_OF)}[n_regionkey + 1] AS ownership_type,
               {', '.join(f'nullif({n}_n, 0) AS {n}_customers' for n in CLASSES)},
               {', '.join(f"{_whole(f'{n}_cents / 100')} / 1000 AS {n}_revenue" for n in CLASSES)},
               {', '.join(f'CAST({n}_mwh AS DOUBLE) AS {n}_sales_mwh' for n in CLASSES)},
               {', '.join(f'{_price(n)} AS {n}_avg_price' for n in list(CLASSES)[:3])},
               {_price('total')} AS avg_price, l_suppkey * 10000 + year AS seq
        FROM ops_groups""",
    "utility_operations": f"""
        SELECT *, CASE WHEN total_revenue <> 0 AND total_customers > 0
                       THEN round(total_revenue * 1000 / total_customers, 2) END AS revenue_per_customer,
               {OPS_SCORE} AS quality_score
        FROM ops_rows""",
    "emission_groups": f"""
        SELECT l_suppkey, year, s_name, n_nationkey, n_name, n_regionkey,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS gen,
               CAST(sum(CAST(l_quantity AS BIGINT) * p_size) AS BIGINT) AS co2,
               {', '.join(f"CAST(sum(CASE WHEN p_type = '{t}' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS {f}" for t, f in SHARES.items())}
        FROM supplier_lines JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "emission_rows": f"""
        SELECT s_name AS utility_name_egrid, {STATE} AS state, year,
               CASE WHEN n_regionkey <> 0 THEN l_suppkey END AS eia_utility_id,
               CAST(gen AS DOUBLE) AS net_generation_mwh, CAST(co2 AS DOUBLE) AS co2_tons,
               CASE WHEN coal > 0 THEN CAST({_whole('co2 * 2000 / gen')} AS DOUBLE) END AS co2_rate_lbs_mwh,
               {', '.join(f"CASE WHEN {f} > 0 THEN {_whole(f'{f} * 10000 / gen')} / 100 END AS {f}_pct" for f in SHARES.values())},
               CAST(NULL AS DOUBLE) AS other_renewable_pct
        FROM emission_groups""",
    "utility_emissions": f"SELECT *, {EMISSIONS_SCORE} AS quality_score FROM emission_rows",
    "generators": f"""
        SELECT l_suppkey AS utility_id, l_partkey AS plant_code, {case('p_type', A.TECHNOLOGY_OF)} AS technology,
               l_quantity AS nameplate_mw, CAST(year(l_shipdate) AS INT) AS operating_year,
               {case('l_returnflag', A.UNIT_STATUS_OF)} AS status,
               CASE WHEN l_linestatus = 'F' THEN CAST(year(l_shipdate) AS INT) + l_linenumber END AS planned_retirement_year
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "fleet_rows": f"""
        SELECT utility_id AS eia_utility_id, 2001 AS year,
               {', '.join(f"round(sum(CASE WHEN {fuel('technology')} = '{f}' THEN nameplate_mw ELSE 0 END), 2) AS {f}_capacity_mw" for f in V.FUELS)},
               round(sum(nameplate_mw), 2) AS total_capacity_mw, count(DISTINCT plant_code) AS num_plants,
               count(*) AS num_generators,
               round(2001 - avg(CASE WHEN operating_year BETWEEN 1900 AND 2001 THEN operating_year END), 1) AS avg_generator_age,
               round(sum(CASE WHEN {PLANNED} THEN nameplate_mw ELSE 0 END), 2) AS planned_additions_mw,
               round(sum(CASE WHEN planned_retirement_year >= 2001 THEN nameplate_mw ELSE 0 END), 2) AS planned_retirements_mw
        FROM generators WHERE utility_id IS NOT NULL AND nameplate_mw > 0 GROUP BY utility_id""",
    "utility_capacity": f"SELECT *, {CAPACITY_SCORE} AS quality_score FROM fleet_rows",
    "links": f"""
        SELECT coalesce({CANONICAL}, c_name) AS utility_name, {STATE} AS state, c_custkey % 100 AS eia_utility_id,
               c_custkey AS seq
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "links_by_name": "SELECT lower(utility_name) AS k, arg_max(eia_utility_id, seq) AS eia_utility_id FROM links GROUP BY 1",
    "latest_ops": """
        SELECT * FROM utility_operations WHERE coalesce(eia_utility_id, 0) <> 0
        QUALIFY row_number() OVER (PARTITION BY eia_utility_id ORDER BY coalesce(year, 0) DESC, seq DESC) = 1""",
    "impact_rows": """
        SELECT r.*, l.eia_utility_id AS linked_id, o.total_customers, o.residential_avg_price,
               r.approved_revenue_change * 1000000 / o.total_customers AS annual
        FROM rate_cases r
        JOIN links_by_name l ON lower(coalesce(nullif(r.canonical_utility_name, ''), r.utility_name)) = l.k
        JOIN latest_ops o ON o.eia_utility_id = l.eia_utility_id
        WHERE coalesce(r.approved_revenue_change, 0) <> 0""",
    "impacts": """
        SELECT docket_number, source, linked_id AS eia_utility_id, total_customers,
               round(annual / 12, 2) AS monthly_bill_impact, round(annual, 2) AS annual_bill_impact,
               CASE WHEN residential_avg_price > 0
                    THEN round(annual / 12 / (residential_avg_price / 100 * 886.0::DOUBLE) * 100, 2) END AS pct_of_avg_bill,
               residential_avg_price AS residential_price_before, CAST(NULL AS DOUBLE) AS residential_price_after
        FROM impact_rows WHERE total_customers > 0""",
    "flags": """
        SELECT r.*, k.n IS NOT NULL AS has_eia_link,
               coalesce(k.eia_utility_id IN (SELECT eia_utility_id FROM utility_emissions WHERE coalesce(eia_utility_id, 0) <> 0), false) AS has_emissions,
               EXISTS (SELECT 1 FROM impacts i WHERE i.docket_number = r.docket_number AND i.source = r.source) AS has_impact
        FROM rate_cases r LEFT JOIN (
            SELECT lower(utility_name) AS name, upper(state) AS state, arg_max(eia_utility_id, seq) AS eia_utility_id, count(*) AS n
            FROM links GROUP BY 1, 2) k
        ON k.name = lower(coalesce(nullif(r.canonical_utility_name, ''), r.utility_name)) AND k.state = upper(coalesce(r.state, ''))""",
    "part_words": "SELECT *, string_split(p_name, ' ') AS w FROM part",
    "link_left": f"""
        SELECT DISTINCT CASE p_size % 5 WHEN 0 THEN p_name || ' Company' WHEN 1 THEN replace(p_name, 'e', '') || ' Inc.'
                 WHEN 2 THEN w[2] || ' ' || w[1] WHEN 3 THEN 'The ' || p_name || ' & ' || p_name
                 ELSE p_name || 'x' || substr(p_brand, 7, 2) END AS name,
               {array(V.STATE_CODES)}[p_size % 10 + 1] AS state
        FROM part_words""",
    "link_right": f"""
        SELECT p_partkey AS eia_utility_id,
               upper(w[1][1]) || w[1][2:] || ' ' || upper(w[2][1]) || w[2][2:] || ' Corporation' AS utility_name,
               {array(V.STATE_CODES)}[CAST(substr(p_brand, 7, 2) AS INT) % 12 + 1] AS state, p_partkey AS seq
        FROM part_words""",
    "aliases": "SELECT * FROM (VALUES " + ", ".join(
        "(" + ", ".join([*map(text, row[:5]), str(row[5])]) + ")" for row in alias_rows()
    ) + ") AS t(alias, canonical, parent, utility_type, alias_state, pos)",
    "raw_names": f"""
        SELECT utility_name, arg_min(state, seq) AS state FROM (
            SELECT CASE p_size % 5 WHEN 0 THEN alias WHEN 1 THEN alias || ', Inc.'
                     WHEN 2 THEN substr(alias, 1, 3) || substr(alias, 5, 100)
                     WHEN 3 THEN alias || ' ' || substr(p_name, 1, 3) ELSE p_name || ' Co-op ' || p_brand END AS utility_name,
                   CASE WHEN p_size % 2 = 0 THEN alias_state ELSE {array(V.STATE_CODES)}[p_size % 50 + 1] END AS state,
                   p_partkey AS seq
            FROM part JOIN aliases ON p_partkey % {len(alias_rows())} = pos) GROUP BY utility_name""",
    "raw_records": f"""
        SELECT CASE WHEN p = 5 AND o_orderstatus = 'P' THEN '  '
                    ELSE ' ' || coalesce({case("regexp_extract(description, '<b>(.*?)</b>', 1)", A.DOCKET_PREFIX_OF)}, 'WR-') || docket_number END AS docket_number,
               utility_name, ' ' || lower(state) AS state, source,
               CASE p WHEN 1 THEN 'unknown' WHEN 2 THEN 'bogus' WHEN 4 THEN 'rate_design' WHEN 5 THEN '' END AS case_type,
               CASE p WHEN 4 THEN 'telecom' WHEN 5 THEN 'water' END AS utility_type,
               CASE o_orderstatus WHEN 'F' THEN ' Final Order ' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Settlement reached' END AS status,
               CASE p WHEN 1 THEN strftime(order_day, '%Y-%m-%d') WHEN 2 THEN strftime(order_day, '%m/%d/%Y')
                      WHEN 3 THEN strftime(order_day, '%B %-d, %Y') WHEN 4 THEN strftime(order_day, '%-m/%-d/%y')
                      ELSE 'to be set' END AS filing_date,
               strftime(decision_date, '%Y%m%d') AS decision_date, CAST(NULL AS VARCHAR) AS effective_date,
               CASE WHEN p = 4 THEN {MONEY_REQ} WHEN p = 5 AND o_orderstatus = 'F' THEN '$' || {MONEY_REQ} || ' million' END AS requested_revenue_change,
               source_url,
               CASE p WHEN 1 THEN utility_name || ' requests a revenue increase of $' || {MONEY_REQ} || ' million. Approved increase of $' || {MONEY_APP}
                        || ' million; return on equity of ' || {ROE_TEXT} || '% and rate base of $' || (seq + 1000) || ' million. Filed on ' || strftime(order_day, '%Y-%m-%d')
                      WHEN 2 THEN 'Proposed decrease of $' || (seq * 1000 + 250000) || ' for electric service, filed ' || strftime(order_day, '%B %-d, %Y')
                      WHEN 3 THEN 'General rate case seeking $' || {MONEY_REQ} || 'M; authorized $' || {MONEY_APP} || 'M. ROE ' || {ROE_TEXT} || '%'
                      WHEN 4 THEN 'Fuel cost adjustment: $' || {MONEY_REQ} || ' billion over 3 years and $5 million, water service'
                      ELSE 'Notice of hearing on ' || strftime(order_day, '%m/%d/%Y') || '; rate design ' || {ROE_TEXT} || ' percent, $12,500,000 at stake' END AS description,
               seq
        FROM rate_cases_plain""",
    "texts": """
        SELECT 'o' || seq AS id, description AS text FROM raw_records
        UNION ALL SELECT 'd' || doc_id AS id, text FROM documents""",
}

_SHEET_SERVICE = {"BUILDING": "UE", "FURNITURE": "UG", "HOUSEHOLD": "UM", "MACHINERY": "ER", "AUTOMOBILE": "WR"}
_D = "CAST(o_orderdate AS DATE)"
_US = f"strftime({_D}, '%-m/%-d/%Y')"
_REF = f"(strftime({_D}, '%y-%m-') || lpad((o_orderkey % 100)::VARCHAR, 2, '0'))"
_FULL = f"({_REF} || CASE WHEN o_orderstatus = 'F' THEN 'RE01' ELSE '' END)"
_SERVICE = case("c_mktsegment", _SHEET_SERVICE)
_SEGMENT = "(c_mktsegment[1] || lower(c_mktsegment[2:]))"
_CENTS = f"{_cents('o_totalprice')}::VARCHAR"
TABLES["case_pages"] = f"""
    SELECT o_orderkey AS page_id,
      '<html><head><title>Docket Sheet - ' || {_SERVICE} || strftime({_D}, '-%Y-') || lpad((o_orderkey % 100000)::VARCHAR, 5, '0')
      || '</title></head><body><div>Status</div> <div class="v"> <b>' || {case('o_orderstatus', {'F': 'Closed', 'O': 'Pending', 'P': 'Open'})}
      || '</b> (' || {_US} || ') </div><div>Utility Type</div><div>' || {_SEGMENT} || '</div><div>Type of Case</div>' || chr(10) || '<div>'
      || ['General Rate Increase', 'Fuel Adjustment', 'Infrastructure Charge', 'Rate Design', 'Tariff'][{PRIORITY}]
      || '</div><h2>Subject Companies</h2><a title="View" href="#">' || c_name || ' d/b/a ' || {_SEGMENT} || ' &amp; Sons (Investor)</a>'
      || '<a aria-label="View relationships for ' || n_name || ' Power" href="#">x</a><div>Style of Case</div><div>In the Matter of ' || c_name
      || ' &amp; Others</div><a class="t" href="/Case/FilingDisplay/' || o_orderkey || '">Tariff revision ' || o_orderkey || '</a>'
      || '<a href="/Case/FilingDisplay/' || o_orderkey || '">Direct testimony on revenue increase</a>'
      || CASE WHEN o_orderstatus = 'F' THEN '<a href="/Case/FilingDisplay/1">Order: $' || {_CENTS} || ' granted</a>' ELSE '' END
      || '<table><tr class="h"><td>Docket</td><td>Name</td></tr><tr><td>' || {_SERVICE} || ' ' || o_orderkey
      || ' [PDF]</td><td><a href="docket.asp?DocketID=' || o_orderkey || '">' || c_name || ' - Met Retention</a></td><td>' || {_US}
      || '</td><td>&nbsp;</td><td>' || CASE WHEN o_orderstatus = 'F' THEN strftime({_D} + 90, '%m/%d/%Y') ELSE '&nbsp;' END || '</td></tr>'
      || '<tr><td>Rate change of <i>$' || {_CENTS} || '</i> requested by the company in docket</td></tr></table>'
      || '<p>See also [' || {_FULL} || '] on the revenue requirement of ' || c_name || ' and <a href="#">docket ' || {_REF} || ' notice</a></p>'
      || '<font size="2" color="#008000">' || {_FULL} || '</font><a href="x?OpenDocument&amp;n=' || o_orderkey || '">Application of ' || c_name || '</a>'
      || '<div id="dockTitle"> <span>' || {_SEGMENT} || ' ' || strftime({_D}, '%Y')
      || [' Rate Case', ' Base Rate Review', ' Certificate', ' Rate Plan', ' Complaint'][{PRIORITY}] || '</span> </div>'
      || '<a href="/search/facts-docket/?docketId=' || c_custkey || '">d</a><p>Filed By:</b> ' || c_name || '</p><p>Industry :</b>Electric and Gas</p>'
      || '<p>Filing Date:</b> ' || {_US} || '</p><p>Category =</b> Ratesetting</p><p>Description:</b> Rates of ' || c_name
      || '</p><p>Dockets A.' || strftime({_D}, '%y-%m-') || lpad((o_orderkey % 1000)::VARCHAR, 3, '0')
      || ' R-' || strftime({_D}, '%Y-') || lpad(o_orderkey::VARCHAR, 7, '0') || '</p></body></html>' AS html
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
TABLES["all_pages"] = """
    SELECT page_id, html FROM case_pages
    UNION ALL SELECT -1 - page_id AS page_id, html FROM pages"""


def query(body: str, extra: dict[str, str] | None = None) -> str:
    """The body with all tables it uses, directly or not, as common table expressions."""
    known = {**TABLES, **(extra or {})}
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit_name(name)

    def visit_name(name: str) -> None:
        if name in needed:
            return
        used = [n for n in known if n != name and re.search(rf"\b{n}\b", known[name])]
        for n in used:
            visit_name(n)
        if name not in needed:
            needed.append(name)

    visit(body)
    ctes = ",\n".join(f"{n} AS ({known[n]})" for n in needed)
    return f"WITH {ctes}\n{body}" if ctes else body
