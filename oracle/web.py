"""SQL for the queries of ``catalog.web``."""

from __future__ import annotations

from oracle.tables import array, query, text
from oracle.texts import date_state, first, has, words
from tariffworks import fixed_values as V


def entities(x: str) -> str:
    for entity, char in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")]:
        x = f"replace({x}, {text(entity)}, {text(char)})"
    return x


def tags(x: str, by: str = "") -> str:
    return f"regexp_replace({x}, '<[^>]+>', '{by}', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '[\\s ]+', ' ', 'g'))"


def every(t: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all({t}, {text(pattern)}, {group})"


def label(name: str) -> str:
    return f"trim({tags(f'regexp_extract(html, {text(f'(?s){name}[[:space:]]*</div>[[:space:]]*<div[^>]*>[[:space:]]*(.*?)[[:space:]]*</div>')}, 1)')})"


def titles(link: str) -> str:
    return (f"list_filter(list_transform({every('html', f'<a[^>]*href=\"{link}\"[^>]*>([^<]+)</a>')}, lambda x: {entities('trim(x)')}), "
            "lambda x: length(x) > 5)")


def best_title(t: str) -> str:
    return (f"coalesce(list_filter({t}, lambda x: contains(x, '$'))[1], "
            f"list_filter({t}, lambda x: regexp_matches(x, {text(V.FINANCIAL_WORDS)}))[1])")


FILINGS = titles(r"/Case/FilingDisplay/\d+")
_US_DATE = r"(\d{1,2}/\d{1,2}/\d{4})"
EARLIEST = (f"list_min(list_filter(list_transform({every('html', _US_DATE)}, "
            f"lambda x: {date_state('x')}), lambda x: x IS NOT NULL))")


def labelled(name: str, value: str = "([^<]+)") -> str:
    return f"trim({first('html', f'(?i)(?:{name})[[:space:]]*[:=][[:space:]]*</[^>]+>[[:space:]]*{value}')})"


WEB = {
    "page_rows": f"SELECT page_id, unnest({every('html', '(?s)<tr[^>]*>(.*?)</tr>')}) AS row FROM all_pages",
    "page_cells": f"SELECT page_id, {every('row', '(?s)<td[^>]*>(.*?)</td>')} AS cells FROM page_rows",
    "clean_cells": f"SELECT *, list_transform(cells, lambda x: trim(replace(trim({tags('x')}), '&nbsp;', ''))) AS clean FROM page_cells WHERE len(cells) >= 4",
    "page_texts": f"""SELECT page_id, list_filter(list_transform({every('html', '(?s)<td[^>]*>(.*?)</td>')},
        lambda x: replace(replace({squeeze(tags('x', ' '))}, '&nbsp;', ' '), '&amp;', '&')), lambda x: length(x) > 30 AND NOT regexp_full_match(x, '[\\d/\\-\\s]+')) AS texts FROM all_pages""",
    "labelled": f"""SELECT page_id, {labelled('Filed[[:space:]]*By|Filer')} AS utility_name,
        {words(f'lower({labelled("Industry")})', V.TYPE_WORDS_CA, 'NULL')} AS utility_type,
        {date_state(labelled('Filing[[:space:]]*Date', r'([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})'))} AS filing_date,
        CASE WHEN contains(lower({labelled('Status')}), 'clos') OR contains(lower({labelled('Status')}), 'final') THEN 'decided'
             WHEN contains(lower({labelled('Status')}), 'active') OR contains(lower({labelled('Status')}), 'open') THEN 'active' ELSE lower({labelled('Status')}) END AS status,
        {labelled('Category')} AS category, {labelled('Description')} AS description FROM all_pages""",
    "bracket_split": r"""SELECT page_id, html, regexp_extract_all(html, '\[(\d{2}-\d{2}-\d{2}(?:[A-Z]{2}\d{2})?)\]', 0) AS hits,
        regexp_split_to_array(html, '\[\d{2}-\d{2}-\d{2}(?:[A-Z]{2}\d{2})?\]') AS gaps, 0 AS kind FROM all_pages""",
    "link_split": r"""SELECT page_id, html, regexp_extract_all(html, '(?s)<a[^>]*>[^<]*?(\d{2}-\d{2}-\d{2}(?:[A-Z]{2}\d{2})?)[^<]*?</a>', 0) AS hits,
        regexp_split_to_array(html, '(?s)<a[^>]*>[^<]*?\d{2}-\d{2}-\d{2}(?:[A-Z]{2}\d{2})?[^<]*?</a>') AS gaps, 1 AS kind FROM all_pages""",
    "ref_places": """SELECT page_id, html, kind, hits[i] AS hit, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS before
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT * FROM bracket_split UNION ALL SELECT * FROM link_split))""",
    "ref_texts": f"""SELECT page_id, kind, before, CAST(greatest(before - 200, 0) AS BIGINT) AS low,
            regexp_extract(hit, '(\\d{{2}}-\\d{{2}}-\\d{{2}}(?:[A-Z]{{2}}\\d{{2}})?)', 1) AS docket_number,
            trim({tags("substr(html, CAST(greatest(before - 200, 0) + 1 AS BIGINT), CAST(before + length(hit) + 200 - greatest(before - 200, 0) AS BIGINT))", " ")}, ' ' || chr(10)) AS around FROM ref_places""",
    "refs": f"""SELECT page_id, kind, before, docket_number, {entities(f"CASE kind WHEN 0 THEN {squeeze('around')} ELSE around END")} AS context FROM ref_texts
        WHERE kind = 0 OR CAST(docket_number[4:5] AS INT) BETWEEN 1 AND 12""",
    "best_brackets": """SELECT docket_number, context FROM refs WHERE kind = 0
        QUALIFY row_number() OVER (PARTITION BY docket_number ORDER BY length(context) DESC, page_id, before) = 1""",
    "first_refs": "SELECT * FROM refs QUALIFY row_number() OVER (PARTITION BY docket_number ORDER BY page_id, kind, before) = 1",
    "docket_contexts": """SELECT f.docket_number, CASE WHEN f.kind = 1 AND NOT coalesce(length(b.context) > length(f.context), false) THEN f.context ELSE b.context END AS context
        FROM first_refs f LEFT JOIN best_brackets b USING (docket_number)""",
    "listed": r"""SELECT page_id, html, unnest(list_distinct(regexp_extract_all(html, '<font[^>]*color="#008000"[^>]*>(\d{2}-\d{2}-\d{2}(?:[A-Z]{2}\d{2})?)</font>', 1))) AS docket_number FROM all_pages""",
    "listed_titles": f"""SELECT docket_number, arg_max(title, page_id) AS title FROM (SELECT page_id, docket_number,
            {entities('trim(' + "regexp_extract(substr(html, instr(html, docket_number), 1000), '<a[^>]*href=\"[^\"]*[?]OpenDocument[^\"]*\"[^>]*>([^<]+)</a>', 1)" + ')')} AS title FROM listed)
        WHERE length(title) > 5 GROUP BY 1""",
}

_DETAIL = r"""(?i)<a[^>]+href=["']?docket\.asp\?DocketID=(\d+)"""
_AFTER_DETAIL = f"list_filter(list_transform(cells[1:3], lambda x: {first('x', _DETAIL)}), lambda x: x IS NOT NULL)[1]"
_LONGEST = "list_reduce({0}, lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END)"
_MONEY = r"(?i)(revenue|increase|decrease|\$|million|rate\s+change|rate\s+base)"
_FIN = f"list_filter(texts, lambda x: regexp_matches(x, {text(_MONEY)}))"
_LISTED = (r"""list_transform(list_filter(list_transform(regexp_extract_all(regexp_extract(html, '(?s)Subject Companies(.*?)(?:Style of Case|Assigned Judge)', 1), """
           r"""'(?:title="View"[^>]*>|>)\s*([A-Z][^<(]{3,60}?)\s*(?:<|\()', 1), lambda x: """ + entities("trim(x)")
           + "), lambda x: length(x) > 3), lambda x: trim(coalesce(" + first("x", r"d/b/a\s+(.+)") + ", x)))")
_STYLE = "trim(" + first("html", r"(?:Application|Request|Tariff[s]?)[^<]*?of\s+([A-Z][^<,]{5,60}?)(?:,|\s+for|\s+d/b/a)") + ")"
_ARIA = "list_transform(regexp_extract_all(html, 'aria-label=\"[^\"]*relationships for ([^\"]+)\"', 1), lambda x: " + entities("x") + ")"


def q(sql: str) -> str:
    return query(sql, WEB)


SQL = {
    "html_table_rows": q(f"""SELECT page_id, trim(replace(regexp_replace(clean[1], '(U[EGMCW])\\s*(\\d+)', '\\1 \\2', 'g'), '[PDF]', '')) AS docket_number,
        trim(regexp_replace(clean[2], '\\s*-\\s*Met Retention\\s*$', '')) AS utility_name, {date_state('clean[3]')} AS filing_date, {date_state('clean[5]')} AS decision_date,
        CASE WHEN {date_state('clean[5]')} IS NOT NULL THEN 'decided' ELSE 'active' END AS status, {_AFTER_DETAIL} AS detail_id
        FROM clean_cells WHERE regexp_matches(clean[1], '^U[EGMCW]\\s*\\d+')"""),
    "html_best_text": q(f"SELECT page_id, coalesce({_LONGEST.format(_FIN)}, {_LONGEST.format('texts')}) AS value FROM (SELECT page_id, CASE WHEN len(texts) = 0 THEN NULL ELSE texts END AS texts FROM page_texts)".replace(
        _LONGEST.format(_FIN), f"CASE WHEN len({_FIN}) > 0 THEN {_LONGEST.format(_FIN)} END")),
    "html_label_value": q(f"SELECT page_id, {label('Status')} AS status, {label('Utility Type')} AS service, {label('Type of Case')} AS kind FROM all_pages"),
    "html_case_fields": q(f"""SELECT page_id, {first('html', 'Docket Sheet - ([A-Z]{2}-[0-9]{4}-[0-9]{3,5})')} AS docket_number, {label('Status')} AS status_text,
        {date_state(first(label('Status'), '[(]([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})[)]'))} AS decision_date, {label('Utility Type')} AS utility_type_text,
        {label('Type of Case')} AS case_type_text, {label('Style of Case')} AS style, {best_title(FILINGS)} AS best_title, {EARLIEST} AS filing_date FROM all_pages"""),
    "html_titles": q(f"SELECT page_id, array_to_string({titles('/[^\"]*')}, '|') AS value FROM all_pages"),
    "html_best_title": q(f"SELECT page_id, {best_title(FILINGS)} AS value FROM all_pages"),
    "html_companies": q(f"""SELECT page_id, array_to_string(list_concat(f, list_filter(list_distinct(a), lambda x: NOT list_contains(f, x))), '|') AS value FROM (
        SELECT page_id, {_ARIA} AS a, CASE WHEN len(l) > 0 THEN l WHEN st IS NOT NULL THEN [st] ELSE [] END AS f FROM (SELECT page_id, html, {_LISTED} AS l, {_STYLE} AS st FROM all_pages))"""),
    "earliest_date": q(f"SELECT page_id, {EARLIEST} AS value FROM all_pages"),
    "html_refs_context": q("SELECT * FROM docket_contexts"),
    "longest_context": """SELECT source || '-' || lang AS docket_number, text AS context FROM documents
        QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, doc_id) = 1""",
    "html_listing_titles": q("SELECT * FROM listed_titles"),
    "title_context_join": q("""SELECT c.docket_number, trim(regexp_replace(c.docket_number, '[A-Z]{2}\\d{2}$', '')) AS base,
        coalesce(b.title, f.title, '') AS title, c.context, coalesce(b.title, f.title, c.context) AS text
        FROM docket_contexts c LEFT JOIN listed_titles b ON b.docket_number = trim(regexp_replace(c.docket_number, '[A-Z]{2}\\d{2}$', ''))
        LEFT JOIN listed_titles f ON f.docket_number = c.docket_number"""),
    "html_div_title": q(f"""SELECT * FROM (SELECT page_id, nullif(trim({tags("regexp_extract(html, '(?s)<div\\s+id=\"dockTitle\">\\s*(.*?)\\s*</div>', 1)")}), '') AS title FROM all_pages)
        WHERE title IS NOT NULL AND {has('lower(title)', V.RATE_WORDS_GA)}"""),
    "html_link_ids": q("SELECT DISTINCT CAST(unnest(regexp_extract_all(html, '/search/facts-docket/[?]docketId=(\\d+)', 1)) AS BIGINT) AS id FROM all_pages"),
    "html_labelled_fields": q("SELECT * FROM labelled"),
    "merge_scraped_fields": q("""SELECT k.page_id, CASE WHEN coalesce(k.utility_name, '') = '' AND coalesce(n.utility_name, '') <> '' THEN n.utility_name ELSE k.utility_name END AS utility_name,
        CASE WHEN coalesce(k.utility_type, '') = '' AND coalesce(n.utility_type, '') <> '' THEN n.utility_type ELSE k.utility_type END AS utility_type,
        coalesce(n.filing_date, k.filing_date) AS filing_date, coalesce(nullif(n.status, ''), k.status) AS status,
        CASE WHEN length(n.description) > length(coalesce(k.description, '')) THEN n.description ELSE k.description END AS description
        FROM (SELECT seq AS page_id, CASE WHEN status <> 'decided' THEN utility_name END AS utility_name, nullif(utility_type, 'gas') AS utility_type, decision_date AS filing_date,
                     status, status || ' case' AS description FROM rate_cases_plain) k LEFT JOIN labelled n USING (page_id)"""),
    "html_docket_scan": q(" UNION ALL ".join(
        f"SELECT page_id, unnest(list_distinct(regexp_extract_all(html, '{p}'))) AS docket_number FROM all_pages" for p in [r"R-\d{4}-\d{7}", r"A\.\d{2}-\d{2}-\d{3}"])),
    "page_gate": q(f"""SELECT page_id, CAST(coalesce(NOT contains(html[1:1000], 'Submission not found') AND
          regexp_extract(html, 'Docket Sheet - ([A-Z]{{2}}-\\d{{4}}-\\d{{3,5}})', 1)[1:3] IN ('ER-', 'GR-', 'WR-', 'SR-'), false) AS INT) AS is_case_sheet,
        CAST(length(html) >= 500 AND NOT contains(html, 'Session State Protection') AS INT) AS is_proceeding,
        CAST(NOT (contains(lower(html), 'javascript') AND length(html) < 5000) AS INT) AS is_rendered FROM all_pages"""),
    "anti_new_cases": q(r"""SELECT DISTINCT docket_number FROM (SELECT unnest(regexp_extract_all(html, 'R-\d{4}-\d{7}')) AS docket_number FROM all_pages)
        WHERE docket_number NOT IN (SELECT 'R-' || strftime(filing_date, '%Y-') || lpad(docket_number, 7, '0') FROM rate_cases_plain WHERE status = 'decided' AND filing_date IS NOT NULL)"""),
}
