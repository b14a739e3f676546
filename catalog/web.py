"""Queries over whole web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tariffworks.functions import html
from tariffworks.operators import pages as P
from tariffworks.operators.firstwins import longest_context
from tariffworks.plans import adapters as A

c = F.col


def page():
    return F.col("html")


def _per_page(**values):
    return lambda s, d: A.pages(s, d).select("page_id", *[v().alias(k) for k, v in values.items()])


def _rows(s, d):
    return P.result_rows(A.pages(s, d))


WEB_LINK = r"/[^\"]*"


def _known(s, d):
    """Records known before scraping, with gaps."""
    return A.rate_cases(s, d, score=False).select(
        c("seq").alias("page_id"), F.when(c("status") != "decided", c("utility_name")).alias("utility_name"),
        F.nullif("utility_type", F.lit("gas")).alias("utility_type"), c("decision_date").alias("filing_date"),
        "status", F.concat(c("status"), F.lit(" case")).alias("description"))


def _title_context(s, d):
    pages = A.pages(s, d)
    return P.title_context(P.docket_references(pages), P.listing_titles(pages))


QUERIES = {
    "html_table_rows": lambda s, d: _rows(s, d).drop("row_no"),
    "html_best_text": _per_page(value=lambda: html.best_text(page())),
    "html_label_value": _per_page(
        status=lambda: html.label_value(page(), "Status"), service=lambda: html.label_value(page(), "Utility Type"),
        kind=lambda: html.label_value(page(), "Type of Case")),
    "html_case_fields": lambda s, d: P.case_fields(A.pages(s, d)),
    "html_titles": lambda s, d: P.page_titles(A.pages(s, d), WEB_LINK).select("page_id", F.array_join("titles", "|").alias("value")),
    "html_best_title": lambda s, d: P.page_titles(A.pages(s, d)).select("page_id", html.best_title(c("titles")).alias("value")),
    "html_companies": lambda s, d: P.page_companies(A.pages(s, d)).select("page_id", F.array_join("companies", "|").alias("value")),
    "earliest_date": _per_page(value=lambda: html.earliest_date(page())),
    "html_refs_context": lambda s, d: P.docket_references(A.pages(s, d)),
    "longest_context": lambda s, d: longest_context(A.table(s, d, "documents").select(
        F.concat_ws("-", "source", "lang").alias("docket_number"), c("text").alias("context"), c("doc_id").alias("seq"))),
    "html_listing_titles": lambda s, d: P.listing_titles(A.pages(s, d)),
    "title_context_join": _title_context,
    "html_div_title": lambda s, d: P.div_titles(A.pages(s, d)),
    "html_link_ids": lambda s, d: P.link_ids(A.pages(s, d)),
    "html_labelled_fields": lambda s, d: P.labelled_fields(A.pages(s, d)),
    "merge_scraped_fields": lambda s, d: P.merge_scraped_fields(_known(s, d), P.labelled_fields(A.pages(s, d)), "page_id"),
    "html_docket_scan": lambda s, d: P.docket_scan(A.pages(s, d), r"R-\d{4}-\d{7}").unionByName(
        P.docket_scan(A.pages(s, d), r"A\.\d{2}-\d{2}-\d{3}")),
    "page_gate": lambda s, d: P.page_gate(A.pages(s, d)).select(
        "page_id", *[c(x).cast("int").alias(x) for x in ["is_case_sheet", "is_proceeding", "is_rendered"]]),
    "anti_new_cases": lambda s, d: P.anti_new_cases(
        P.docket_scan(A.pages(s, d), r"R-\d{4}-\d{7}"),
        A.rate_cases(s, d, score=False).filter(c("status") == "decided").select(
            F.concat(F.lit("R-"), F.date_format("filing_date", "yyyy-"), F.lpad("docket_number", 7, "0")).alias("docket_number"))),
}
