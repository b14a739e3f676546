"""SQL for the queries of ``catalog.texts``."""

from __future__ import annotations

from oracle.tables import TABLES, array, case, fuel, query, text
from tariffworks import fixed_values as V


def first(t: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({t}, {text(pattern)}, {group}), '')"


def number(x: str) -> str:
    return f"TRY_CAST(replace({x}, ',', '') AS DOUBLE)"


def scaled(amount: str, unit: str) -> str:
    return (f"CASE WHEN lower({unit}) IN ('billion', 'b') THEN round({amount} * 1000, 3) "
            f"WHEN lower({unit}) IN ('million', 'm') THEN round({amount}, 3) ELSE round({amount} / 1000000, 3) END")


def first_amount(t: str, patterns: list[str]) -> str:
    return "coalesce(" + ", ".join(
        f"CASE WHEN regexp_matches({t}, {text(p)}) THEN {scaled(number(first(t, p)), first(t, p, 2))} END"
        for p in patterns) + ")"


def plain(t: str) -> str:
    value = f"round({number(first(t, V.DOLLAR_PLAIN))} / 1000000, 3)"
    return f"CASE WHEN {value} >= 0.001 THEN {value} END"


def dollar(t: str) -> str:
    return (f"CASE WHEN regexp_matches({t}, {text(V.DOLLAR_WITH_UNIT)}) "
            f"THEN {scaled(number(first(t, V.DOLLAR_WITH_UNIT)), first(t, V.DOLLAR_WITH_UNIT, 2))} ELSE {plain(t)} END")


def signed(t: str, value: str) -> str:
    return f"CASE WHEN regexp_matches({t}, {text(V.DECREASE_WORDS)}) THEN -({value}) ELSE {value} END"


_ALL_UNIT = f"regexp_extract_all(text, {text(V.DOLLAR_WITH_UNIT)}, 0)"
_ALL_PLAIN = f"regexp_extract_all(text, {text(V.DOLLAR_PLAIN)}, 0)"


def date(t: str) -> str:
    s = f"trim(regexp_replace({t}, '\\s+', ' ', 'g'))"

    def when(shape: str, fmt: str) -> str:
        return f"CASE WHEN regexp_full_match({s}, {text(shape)}) THEN CAST(try_strptime({s}, {text(fmt)}) AS DATE) END"

    return "coalesce(" + ", ".join([
        when(r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"), when(r"\d{1,2}/\d{1,2}/\d{4}", "%m/%d/%Y"),
        when(r"\d{1,2}/\d{1,2}/\d{2}", "%m/%d/%y"), when(r"\d{1,2}-\d{1,2}-\d{4}", "%m-%d-%Y"),
        when(r"[A-Za-z]+ \d{1,2}, \d{4}", "%B %d, %Y"), when(r"[A-Za-z]+ \d{1,2}, \d{4}", "%b %d, %Y"),
        when(r"[A-Za-z]+ \d{1,2} \d{4}", "%B %d %Y"), when(r"[A-Za-z]+ \d{1,2} \d{4}", "%b %d %Y"),
        when(r"\d{1,2} [A-Za-z]+ \d{4}", "%d %B %Y"), when(r"\d{1,2} [A-Za-z]+ \d{4}", "%d %b %Y"),
        when(r"\d{8}", "%Y%m%d")]) + ")"


def date_state(t: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({t}), '\\d{{1,2}}/\\d{{1,2}}/(\\d{{2}}|\\d{{4}})|\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') "
            f"THEN {date(t)} END")


def per_text(value: str) -> str:
    return query(f"SELECT id, {value} AS value FROM texts")


def compiled(rules) -> list[tuple[str, str]]:
    return [(label, "(?i)" + "|".join([*ps, *[k.lower().replace("(", r"\(") for k in ks]])) for label, ps, ks in rules]


def chain(t: str, rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({t}, {text(p)}) THEN {text(v)}" for v, p in rules) + f" ELSE {default} END"


def words(t: str, rules, default: str) -> str:
    return "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains({t}, {text(w)})" for w in ws) + f" THEN {text(v)}" for v, ws in rules
    ) + f" ELSE {default} END"


def case_type(t: str, docket: str) -> str:
    return chain(f"lower(coalesce({docket}, '') || ' ' || coalesce({t}, ''))", compiled(V.CASE_TYPE_RULES), "'unknown'")


def utility_type(t: str, docket: str) -> str:
    prefix = "CASE " + " ".join(
        f"WHEN upper({docket}) LIKE '{p}-%' OR upper({docket}) LIKE '{p} %' THEN '{v}'" for p, v in V.DOCKET_PREFIX_TYPES) + " END"
    return f"coalesce({prefix}, {chain(f'lower({docket} || chr(32) || {t})', compiled(V.UTILITY_TYPE_RULES), text('unknown'))})"


STATUS = chain("trim(status)", [(label, "(?i)" + "|".join(ps)) for label, ps in V.STATUS_RULES], "'unknown'")


def clean(name: str) -> str:
    out = f"trim({name})"
    for suffix in sorted(V.NAME_SUFFIXES, key=len, reverse=True):
        out = f"regexp_replace({out}, {text(',?\\s*' + suffix.replace('.', '[.]') + '\\s*$')}, '', 'i')"
    for short, full in V.NAME_EXPANSIONS:
        if short == "&":
            out = f"replace({out}, ' & ', ' {full} ')"
        else:
            out = f"regexp_replace({out}, {text('\\b' + short.replace('.', '[.]') + '\\b')}, {text(full)}, 'gi')"
    return f"rtrim(trim(regexp_replace({out}, '\\s+', ' ', 'g')), '.,;:')"


def norm(name: str) -> str:
    return (f"(SELECT array_to_string(CASE WHEN len(list_filter(w, lambda x: NOT list_contains({array(V.NOISE_WORDS)}, x))) < 2 THEN w "
            f"ELSE list_filter(w, lambda x: NOT list_contains({array(V.NOISE_WORDS)}, x)) END, ' ') "
            f"FROM (SELECT list_filter(string_split(lower({clean(name)}), ' '), lambda x: x <> '') AS w))")


def form(name: str) -> str:
    return (f"array_to_string(list_sort(list_filter(string_split(regexp_replace(lower({name}), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'), ' '), "
            "lambda x: x <> '')), ' ')")


def lcs(a: str, b: str) -> str:
    """Longest common subsequence with one bit per position of ``a`` (up to 120)."""
    full = f"((1::HUGEINT << len({a})) - 1)"
    mask = (f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: CASE WHEN ({a})[i] = ch THEN 1::HUGEINT << (i - 1)::INT "
            "ELSE 0::HUGEINT END))::HUGEINT")
    masks = f"list_transform(string_split({b}, ''), lambda ch: {mask})"
    step = f"((v + (v & m)) | (v - (v & m))) & {full}"
    return f"(len({a}) - bit_count(list_reduce({masks}, lambda v, m: {step}, {full})))"


def ratio(a: str, b: str, common: str) -> str:
    return (f"CAST(round_even((1.0::DOUBLE - (len({a}) + len({b}) - 2 * {common}) / (len({a}) + len({b}))) * 100, 0) AS INT)")


def messages(pairs) -> str:
    parts = ", ".join(f"CASE WHEN {cond} THEN {m} END" for cond, m in pairs)
    return f"array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), '; ')"


def lit_messages(pairs) -> str:
    return messages([(cond, text(m)) for cond, m in pairs])


def out_of_years(x: str) -> str:
    return f"year({x}) NOT BETWEEN 1990 AND 2030"


VALIDATE = messages([
    ("coalesce(docket_number, '') = ''", "'Missing docket_number'"), ("coalesce(utility_name, '') = ''", "'Missing utility_name'"),
    ("coalesce(state, '') = ''", "'Missing state'"), ("coalesce(source, '') = ''", "'Missing source'"),
    (out_of_years("filing_date"), "'Filing date ' || filing_date || ' outside valid range (1990-2030)'"),
    (out_of_years("decision_date"), "'Decision date ' || decision_date || ' outside valid range (1990-2030)'"),
    ("decision_date < filing_date", "'Decision date (' || decision_date || ') before filing date (' || filing_date || ')'"),
    ("abs(requested_revenue_change) > 50000", "'Requested revenue $' || requested_revenue_change || 'M seems unreasonably large'"),
    ("abs(approved_revenue_change) > 50000", "'Approved revenue $' || approved_revenue_change || 'M seems unreasonably large'"),
    ("abs(approved_revenue_change) > abs(requested_revenue_change) * 1.5::DOUBLE",
     "'Approved $' || approved_revenue_change || 'M significantly exceeds requested $' || requested_revenue_change || 'M'"),
    ("return_on_equity < 0 OR return_on_equity > 25", "'ROE ' || return_on_equity || '% outside reasonable range (0-25%)'"),
    ("rate_base < 0", "'Rate base $' || rate_base || 'M is negative'"),
    ("rate_base > 100000", "'Rate base $' || rate_base || 'M seems unreasonably large'"),
    ("coalesce(state, '') <> '' AND length(state) <> 2", "'State code ''' || state || ''' should be 2 characters'"),
])

ISSUES = lit_messages([
    ("coalesce(docket_number, '') = ''", "Missing docket number"),
    ("coalesce(canonical_utility_name, '') = '' AND coalesce(utility_name, '') = ''", "Missing utility name"),
    ("coalesce(case_type, 'unknown') IN ('', 'unknown')", "Case type not classified"),
    ("filing_date IS NULL", "Missing filing date"),
    ("decision_date IS NULL AND coalesce(status, '') NOT IN ('active', 'filed')", "Missing decision date"),
    ("requested_revenue_change IS NULL", "No revenue request amount"),
    ("approved_revenue_change IS NULL", "No revenue approved amount"),
    ("coalesce(status, 'unknown') IN ('', 'unknown')", "Missing or unknown case status"),
])


def not_in(column: str, allowed) -> str:
    return f"NOT list_contains({array(allowed)}, {column})"


CHECK_CASE = lit_messages(
    [("length(docket_number) NOT BETWEEN 1 AND 100", "docket_number length"), ("length(utility_name) NOT BETWEEN 1 AND 500", "utility_name length"),
     (not_in("upper(trim(state))", V.STATE_CODES), "state code"), ("source IS NULL", "source missing"),
     (not_in("case_type", V.CASE_TYPES), "case_type value"), (not_in("utility_type", V.UTILITY_TYPES) + " AND utility_type IS NOT NULL", "utility_type value"),
     (not_in("status", V.CASE_STATUSES), "status value")]
    + [(out_of_years(x), f"{x} range") for x in ["filing_date", "decision_date", "effective_date"]]
    + [(f"abs({x}) > 50000", f"{x} range") for x in ["requested_revenue_change", "approved_revenue_change", "rate_base"]]
    + [("return_on_equity NOT BETWEEN 0 AND 25", "return_on_equity range"), ("length(description) > 5000", "description length"),
       ("quality_score NOT BETWEEN 0 AND 1", "quality_score range"), ("decision_date < filing_date", "decision before filing")])

SHEET = """CASE source WHEN 'pennsylvania_puc' THEN strftime(filing_date, '%y-%m-') || lpad(docket_number, 2, '0') || 'RE01'
    WHEN 'oregon_puc' THEN 'UE' || docket_number || '[PDF]'
    WHEN 'california_cpuc' THEN 'A.' || strftime(filing_date, '%y-%m-') || lpad(docket_number, 3, '0')
    WHEN 'indiana_iurc' THEN 'ER-' || strftime(filing_date, '%Y-') || docket_number ELSE '99-13-' || docket_number END"""

TITLES = {"docket_titles": f"SELECT seq, {array(V.SOURCES)}[seq % 8 + 1] AS source, description AS title, trim(docket_number) AS docket, decision_date AS decision FROM raw_records"}
CELLS = {"sheet_cells": """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN ' ' || format('{:,.2f}', l_extendedprice)
    WHEN 2 THEN 'N/A' WHEN 3 THEN ' . ' WHEN 4 THEN l_partkey || '.7' WHEN 5 THEN '' ELSE 'n.a.' END AS cell FROM lineitem"""}
CELL = "CASE WHEN replace(trim(cell), ',', '') NOT IN ('', '.', '-', 'None', 'NA', 'N/A') THEN TRY_CAST(replace(trim(cell), ',', '') AS DOUBLE) END"
PARTIES = {"party_lists": """SELECT seq, chr(8203) || utility_name || ' - North - ' || upper(utility_type[1]) || utility_type[2:] || chr(8203) || ', Office of Counsel' AS parties,
    case_type AS petition, coalesce(utility_type, '') AS industry FROM rate_cases_plain"""}


def prefix_type(pairs) -> str:
    return f"coalesce({case('docket[1:2]', dict(pairs))}, 'unknown')"


SOURCE_TYPE = f"""CASE source WHEN 'connecticut_pura' THEN {words('lower(title)', V.TYPE_WORDS_CT, "'unknown'")}
    WHEN 'georgia_psc' THEN {words('lower(title)', V.TYPE_WORDS_GA, "'unknown'")}
    WHEN 'oregon_puc' THEN {prefix_type(V.PREFIX_TYPES_OR)}
    WHEN 'missouri_psc' THEN CASE WHEN {prefix_type(V.PREFIX_TYPES_MO)} <> 'unknown' THEN {prefix_type(V.PREFIX_TYPES_MO)}
        ELSE {words('lower(title)', V.TYPE_WORDS_MO, "'unknown'")} END
    WHEN 'indiana_iurc' THEN coalesce({case('lower(title)', dict(V.INDUSTRY_TYPES_IN))}, 'unknown')
    WHEN 'california_cpuc' THEN {words('lower(title)', V.TYPE_WORDS_CA, 'NULL')} ELSE 'unknown' END"""

SOURCE_CASE = f"""CASE WHEN source = 'missouri_psc' THEN coalesce({words('lower(title)', V.CASE_TYPE_WORDS_MO, 'NULL')},
    CASE WHEN docket[1:2] IN ('ER', 'GR', 'WR', 'SR') THEN 'general_rate_case' END, 'unknown') ELSE 'general_rate_case' END"""

_W = "['Closed', 'pending', 'Appealed', 'Active', 'New', 'void'][seq % 6 + 1]"
SOURCE_STATUS = f"""CASE source
    WHEN 'missouri_psc' THEN CASE {_W} WHEN 'Closed' THEN 'decided' WHEN 'pending' THEN 'active' ELSE 'decided' END
    WHEN 'california_cpuc' THEN CASE {_W} WHEN 'Closed' THEN 'decided' WHEN 'Active' THEN 'active' ELSE lower({_W}) END
    WHEN 'indiana_iurc' THEN CASE {_W} WHEN 'pending' THEN 'active' WHEN 'New' THEN 'active' WHEN 'Appealed' THEN 'decided' WHEN 'void' THEN 'decided' ELSE 'unknown' END
    WHEN 'oregon_puc' THEN CASE WHEN decision IS NOT NULL THEN 'decided' ELSE 'active' END ELSE 'decided' END"""


def _gaz(t: str, names) -> str:
    return "CASE " + " ".join(f"WHEN contains({t}, {text(p)}) THEN {text(n)}" for p, n in names) + " ELSE '' END"


GAZ_TITLE = (f"lower('Application of ' || {array([p for p, _ in V.GAZETTEER_CT])}[seq % {len(V.GAZETTEER_CT)} + 1] || ' with ' || "
             f"{array([p for p, _ in V.GAZETTEER_GA])}[seq % {len(V.GAZETTEER_GA)} + 1] || ' rate')")

RELEVANT = {"ct_refs": """SELECT seq, CASE WHEN status = 'decided' THEN utility_name ELSE '' END AS title,
    ['motion to intervene ', 'annual review of rate ', 'Yankee Gas corres. ', 'notice ', 'cl&p '][seq % 5 + 1] || source AS context,
    ['00-00-01', '24-10-04'][seq % 2 + 1] AS base FROM rate_cases_plain"""}


def has(t: str, ws) -> str:
    return "(" + " OR ".join(f"contains({t}, {text(w)})" for w in ws) + ")"


_BOTH = "lower(title || ' ' || context)"
RATE = has(_BOTH, V.RATE_WORDS_CT)

RECORD = f"""
    SELECT trim(docket_number) AS docket_number, utility_name, upper(trim(state)) AS state, source,
      CASE WHEN list_contains({array(V.CASE_TYPES[:-1])}, case_type) THEN case_type ELSE {case_type('description', 'trim(docket_number)')} END AS case_type,
      CASE WHEN list_contains({array(V.UTILITY_TYPES[:-1])}, utility_type) THEN utility_type ELSE {utility_type('description', 'trim(docket_number)')} END AS utility_type,
      {STATUS} AS status, {date('filing_date')} AS filing_date, {date('decision_date')} AS decision_date, CAST(NULL AS DATE) AS effective_date,
      coalesce(coalesce(TRY_CAST(requested_revenue_change AS DOUBLE), {dollar('requested_revenue_change')}),
               {first_amount('description', V.REVENUE_REQUEST)}, {signed('description', dollar('description'))}) AS requested_revenue_change,
      {first_amount('description', V.REVENUE_APPROVED)} AS approved_revenue_change,
      {first_amount('description', [V.RATE_BASE])} AS rate_base,
      round(TRY_CAST({first('description', V.RETURN_ON_EQUITY)} AS DOUBLE), 2) AS return_on_equity,
      source_url, description, seq
    FROM raw_records WHERE trim(docket_number) <> '' AND trim(utility_name) <> '' AND trim(state) <> '' AND trim(source) <> ''"""
TABLES["parsed_records"] = RECORD

_CT = r"^(\d{2})-(\d{2})-(\d{2})"
_YY, _YYYY = r"^(\d{2})-", r"-(\d{4})-"
UNITS = "['billion', 'B', 'Million', 'm', ''][l_linenumber % 5 + 1]"
OTHER_NAME = "state || ' GEAR widget-' || lower(state)"
_CA = r"^A\.(\d{2})-(\d{2})-\d{3}"


def _pivot(x: str) -> str:
    return f"(CASE WHEN CAST({x} AS INT) < 50 THEN 2000 ELSE 1900 END + CAST({x} AS INT))"


def _month_start(year: str, month: str) -> str:
    return f"CASE WHEN CAST({month} AS INT) BETWEEN 1 AND 12 THEN make_date({year}, CAST({month} AS INT), 1) END"


CHECK_UTILITY = lit_messages([
    (not_in("upper(trim(state))", V.STATE_CODES), "state code"), (not_in("utility_type", V.UTILITY_TYPES), "utility_type value"),
    (not_in("ownership_type", V.OWNERSHIP_TYPES), "ownership_type value"), ("customer_count < 0", "customer_count negative")])
CHECK_DOCUMENT = lit_messages([
    (not_in("document_type", V.DOCUMENT_TYPES), "document_type value"), (out_of_years("filing_date"), "filing_date range"),
    ("NOT starts_with(url, 'http://') AND NOT starts_with(url, 'https://')", "url scheme")])

SQL = {
    "extract_dollar": per_text(signed("text", dollar("text"))),
    "parse_dollar": per_text(dollar("text")),
    "extract_all_dollars": per_text(
        f"array_to_string(list_transform(list_filter(CASE WHEN len({_ALL_UNIT}) > 0 "
        f"THEN list_transform({_ALL_UNIT}, lambda m: {scaled(number(first('m', V.DOLLAR_WITH_UNIT)), first('m', V.DOLLAR_WITH_UNIT, 2))}) "
        f"ELSE list_transform({_ALL_PLAIN}, lambda m: {plain('m')}) END, lambda x: x IS NOT NULL), "
        f"lambda x: CAST({signed('text', 'x')} AS VARCHAR)), '|')"),
    "parse_percent": per_text(f"round(TRY_CAST(coalesce({first('text', V.PERCENT_SIGN)}, {first('text', V.PERCENT_WORD)}) AS DOUBLE), 2)"),
    "extract_date": per_text("coalesce(" + ", ".join(date(first("text", p)) for p in V.DATE_IN_TEXT) + ")"),
    "extract_all_dates": per_text(
        "array_to_string(list_sort(list_distinct(list_filter(list_transform(list_concat("
        + ", ".join(f"regexp_extract_all(text, {text(p)}, 1)" for p in V.DATE_IN_TEXT)
        + f"), lambda x: {date('x')}), lambda x: x IS NOT NULL))), '|')"),
    "revenue_request": per_text(first_amount("text", V.REVENUE_REQUEST)),
    "revenue_approved": per_text(first_amount("text", V.REVENUE_APPROVED)),
    "extract_rate_base": per_text(first_amount("text", [V.RATE_BASE])),
    "extract_roe": per_text(f"round(TRY_CAST({first('text', V.RETURN_ON_EQUITY)} AS DOUBLE), 2)"),
    "parse_date": query(f"SELECT seq, {date('filing_date')} AS filing, {date('decision_date')} AS decision FROM raw_records"),
    "parse_date_state": query(f"SELECT seq, {date_state('filing_date')} AS filing, {date_state('decision_date')} AS decision FROM raw_records"),
    "field_date": query(f"SELECT seq, {date('filing_date')} AS value FROM raw_records"),
    "field_float": query(f"SELECT seq, coalesce(TRY_CAST(requested_revenue_change AS DOUBLE), {dollar('requested_revenue_change')}) AS value FROM raw_records"),
    "scale_amount": f"SELECT l_orderkey, l_linenumber, l_partkey, {scaled('l_extendedprice', UNITS)} AS value FROM lineitem",
    "safe_int": query(f"SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc({CELL}) AS BIGINT) AS value FROM sheet_cells", CELLS),
    "safe_float": query(f"SELECT l_orderkey, l_linenumber, l_partkey, round({CELL}, 4) AS value FROM sheet_cells", CELLS),
    "safe_str": query("SELECT l_orderkey, l_linenumber, l_partkey, nullif(trim(cell), '') AS value FROM sheet_cells", CELLS),
    "parse_record": query("SELECT *, CAST(NULL AS DOUBLE) AS requested_rate_change_pct, CAST(NULL AS DOUBLE) AS approved_rate_change_pct FROM parsed_records"),
    "reject_incomplete": query("SELECT seq, utility_name, upper(trim(state)) AS state, source FROM raw_records WHERE trim(docket_number) = ''"),
    "defaults": query("SELECT docket_number, source, coalesce(nullif(case_type, 'rate_design'), 'unknown') AS case_type, coalesce(utility_type, 'unknown') AS utility_type, 'unknown' AS status FROM rate_cases"),
    "classify_case_type": per_text(case_type("text", "id")),
    "classify_utility_type": query(f"SELECT seq, {utility_type('description', 'trim(docket_number)')} AS value FROM raw_records"),
    "normalise_status": query(f"SELECT seq, {STATUS} AS value FROM raw_records"),
    "classify_ownership": query("SELECT utility_name, " + words("lower(utility_name)", [
        ("cooperative", V.COOPERATIVE_WORDS), ("municipal", V.MUNICIPAL_WORDS)], "'investor_owned'") + " AS value FROM raw_names"),
    "source_utility_type": query(f"SELECT seq, {SOURCE_TYPE} AS value FROM docket_titles", TITLES),
    "source_case_type": query(f"SELECT seq, {SOURCE_CASE} AS value FROM docket_titles", TITLES),
    "source_status": query(f"SELECT seq, {SOURCE_STATUS} AS value FROM docket_titles", TITLES),
    "gazetteer_name": query(f"SELECT seq, {_gaz(GAZ_TITLE, V.GAZETTEER_CT)} AS ct, {_gaz(GAZ_TITLE, V.GAZETTEER_GA)} AS ga FROM rate_cases_plain"),
    "relevance_filter": query(
        f"SELECT * FROM ct_refs WHERE base NOT IN ('00-00-01', '00-00-00') AND ({_gaz(_BOTH, V.GAZETTEER_CT)} <> '' OR {RATE}) "
        f"AND NOT (NOT {RATE} AND title = '' AND {has('lower(context)', V.CORRESPONDENCE_WORDS_CT)})", RELEVANT),
    "fuel_category": query(f"SELECT technology, {fuel('technology')} AS fuel, count(*) AS n FROM generators GROUP BY 1, 2"),
    "planned_flags": query("""SELECT utility_id, plant_code, operating_year, CAST(status IN ('P', 'Proposed') AS INT) AS adds,
        CAST(coalesce(planned_retirement_year >= 2001, false) AS INT) AS retires FROM generators"""),
    "clean_name": query(f"SELECT utility_name, {clean('utility_name')} AS value FROM raw_names"),
    "norm_for_match": query(f"SELECT utility_name, {norm('utility_name')} AS value FROM raw_names"),
    "token_sort_ratio": query(f"SELECT name, state, {ratio('a', 'b', lcs('a', 'b'))} AS score FROM scored_names", {
        "scored_names": f"SELECT name, state, {form('name')} AS a, {form(OTHER_NAME)} AS b FROM link_left"}),
    "docket_year": query(f"""SELECT docket_number, CAST(coalesce({_pivot(first('sheet', _YY))}, CAST({first('sheet', _YYYY)} AS INT),
        2000 + CAST({first('sheet', _CA)} AS INT)) AS INT) AS year, CAST(year(filing_date) AS INT) AS in_title, CAST(year(filing_date) AS INT) AS in_text FROM (SELECT *, {SHEET} AS sheet FROM rate_cases)"""),
    "docket_date": query(f"""SELECT docket_number, coalesce({_month_start(_pivot(first('sheet', _CT)), first('sheet', _CT, 2))},
        {_month_start('2000 + CAST(' + first('sheet', _CA) + ' AS INT)', first('sheet', _CA, 2))}) AS day FROM (SELECT *, {SHEET} AS sheet FROM rate_cases)"""),
    "docket_normalise": query(f"""SELECT docket_number, CASE source WHEN 'oregon_puc' THEN 'UE ' || docket_number
        WHEN 'pennsylvania_puc' THEN rtrim(replace(sheet, 'RE01', '')) ELSE sheet END AS docket FROM (SELECT *, {SHEET} AS sheet FROM rate_cases)"""),
    "petitioner": query("SELECT seq, CASE WHEN utility_type IS NULL THEN '' ELSE utility_name || ' - North' END AS value FROM rate_cases_plain"),
    "build_description": query("""SELECT seq, array_to_string(list_filter([petition, CASE WHEN industry <> '' THEN '(' || industry || ')' END,
        '- ' || replace(parties, chr(8203), '')], lambda x: x IS NOT NULL), ' ') AS value FROM party_lists""", PARTIES),
    "template_url": query("SELECT docket_number, source, CASE source " + " ".join(
        f"WHEN '{k}' THEN " + " || docket_number || ".join(text(x) for x in v.replace("%%", "\0").split("%s")).replace("\0", "%") for k, v in V.URL_TEMPLATES.items())
        + " END AS url FROM rate_cases"),
    "strip_html": query("SELECT docket_number, source, 'Rate case ' || c_mktsegment || ' & tariff ' || docket_number AS value FROM rate_cases WHERE description IS NOT NULL "
                        "UNION ALL SELECT docket_number, source, NULL FROM rate_cases WHERE description IS NULL"),
    "unescape_all_strings": """SELECT page_id, url, replace(replace(replace(replace(html, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&') AS html FROM pages""",
    "case_type_label": query("SELECT docket_number, source, CASE WHEN status = 'filed' THEN coalesce(CASE utility_type WHEN 'electric' THEN 'Electric' WHEN 'gas' THEN 'Gas' "
                             "WHEN 'water' THEN 'Water' WHEN 'multi_service' THEN 'Multi Service' END, 'Unknown') ELSE CASE case_type WHEN 'general_rate_case' THEN 'General Rate Case' "
                             "WHEN 'distribution_rate_case' THEN 'Distribution Rate Case' WHEN 'fuel_cost_adjustment' THEN 'Fuel Cost Adjustment' WHEN 'rate_design' THEN 'Rate Design' "
                             "ELSE 'Unknown' END END AS label FROM rate_cases"),
    "quality_score": query("SELECT docket_number, source, quality_score FROM rate_cases"),
    "quality_issues": query(f"SELECT docket_number, source, quality_score, {ISSUES} AS issues FROM rate_cases"),
    "validate_case": query(f"SELECT docket_number, source, {VALIDATE} AS errors FROM rate_cases"),
    "score_operations": query("SELECT eia_utility_id, year, quality_score FROM utility_operations"),
    "score_emissions": query("SELECT utility_name_egrid, year, quality_score FROM utility_emissions"),
    "score_capacity": query("SELECT eia_utility_id, year, quality_score FROM utility_capacity"),
    "revenue_per_customer": query("SELECT eia_utility_id, year, revenue_per_customer FROM utility_operations"),
    "schema_check_case": query(f"SELECT docket_number, source, {CHECK_CASE} AS reasons FROM rate_cases"),
    "schema_check_utility": query(f"SELECT name, {CHECK_UTILITY} AS reasons FROM utilities"),
    "schema_check_document": query(f"SELECT docket_number, title, url, {CHECK_DOCUMENT} AS reasons FROM case_documents"),
    "enrich_description": query("""SELECT docket_number, CASE WHEN status = 'filed' THEN NULL WHEN status = 'active' THEN 'Rates of $5, ' || utility_name
        ELSE 'In the matter of ' || utility_name || CASE WHEN seq % 3 <> 0 THEN ' | Order ' || docket_number ELSE '' END END AS value FROM rate_cases_plain"""),
    "schema_check_run": "SELECT o_orderkey AS seq, " + lit_messages([
        ("o_orderstatus = 'P'", "stage missing"), ("o_custkey < 5", "records_processed negative")]) + " AS reasons FROM orders",
    "dup_dockets": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "multi_state_entities": query("SELECT display_name AS name, string_agg(DISTINCT state, ', ' ORDER BY state) AS states FROM rate_cases GROUP BY 1 HAVING count(DISTINCT state) > 1"),
    "doc_count_join": query("""SELECT docket_number, source, coalesce(n, 0) AS document_count FROM rate_cases
        LEFT JOIN (SELECT docket_number AS k, count(*) AS n FROM case_documents GROUP BY 1) ON k = docket_number"""),
}
