"""Queries over text columns: amounts, dates, rules, names, scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.stored import capacity
from tariffworks import fixed_values as V
from tariffworks.functions import dockets, names, rules, scores, text
from tariffworks.functions.html import strip_html
from tariffworks.operators import extract, merge, quality
from tariffworks.plans import adapters as A
from tariffworks.sources import writers

c = F.col


def _per_text(value):
    """(id, value) for every whole text."""
    return lambda s, d: A.texts(s, d).select("id", value(c("text")).alias("value"))


def _joined(value):
    return _per_text(lambda t: F.array_join(value(t).cast("array<string>"), "|"))


def _per_record(**values):
    """(seq, ...) for every raw record; each value is built from its columns."""
    return lambda s, d: A.raw_records(s, d).select("seq", *[v().alias(k) for k, v in values.items()])


def _per_case(**values):
    return lambda s, d: A.rate_cases(s, d).select(
        "docket_number", "source", *[v().alias(k) for k, v in values.items()])


def _defaults(s, d):
    """Cases stored for the first time without their types."""
    batch = A.rate_cases(s, d, score=False).select(
        "docket_number", "source", "utility_name", "state", F.nullif("case_type", F.lit("rate_design")).alias("case_type"),
        "utility_type", F.lit(None).cast("string").alias("status"), "seq")
    return merge.merge_cases(s.createDataFrame([], batch.drop("seq").schema), batch).select(
        "docket_number", "source", "case_type", "utility_type", "status")


def _messages(column):
    return F.array_join(column, "; ")


def parsed(s, d):
    return extract.parse_record(A.raw_records(s, d))[0]


def _sheet_docket():
    """Docket numbers in the spelling of each source."""
    day, key = c("filing_date"), c("docket_number")
    return (
        F.when(c("source") == "pennsylvania_puc", F.concat(F.date_format(day, "yy-MM-"), F.lpad(key, 2, "0"), F.lit("RE01")))
        .when(c("source") == "oregon_puc", F.concat(F.lit("UE"), key, F.lit("[PDF]")))
        .when(c("source") == "california_cpuc", F.concat(F.lit("A."), F.date_format(day, "yy-MM-"), F.lpad(key, 3, "0")))
        .when(c("source") == "indiana_iurc", F.concat(F.lit("ER-"), F.date_format(day, "yyyy-"), key))
        .otherwise(F.concat(F.lit("99-13-"), key))
    )


def _titles(s, d):
    """Docket titles of the raw records, by the source they come from."""
    return A.raw_records(s, d).select(
        "seq", "source", c("description").alias("title"), F.trim("docket_number").alias("docket"),
        c("decision_date").alias("decision"),
    ).withColumn("source", A._nth(V.SOURCES, c("seq") % 8 + 1))


def _gazetteer(s, d):
    """Known phrases put into titles, one after another."""
    n_ct, n_ga = len(V.GAZETTEER_CT), len(V.GAZETTEER_GA)
    title = F.concat(F.lit("Application of "), A._nth([p for p, _ in V.GAZETTEER_CT], c("seq") % n_ct + 1),
                     F.lit(" with "), A._nth([p for p, _ in V.GAZETTEER_GA], c("seq") % n_ga + 1), F.lit(" rate"))
    titled = A.rate_cases(s, d, score=False).withColumn("title", title)
    return titled.select(
        "seq", rules.gazetteer_name(c("title"), V.GAZETTEER_CT).alias("ct"),
        rules.gazetteer_name(c("title"), V.GAZETTEER_GA).alias("ga"))


def _relevance(s, d):
    """Docket references with a title or with correspondence only."""
    titled = A.rate_cases(s, d, score=False).select(
        "seq",
        F.when(c("status") == "decided", c("utility_name")).otherwise("").alias("title"),
        F.concat(A._nth(["motion to intervene ", "annual review of rate ", "Yankee Gas corres. ", "notice ", "cl&p "],
                        c("seq") % 5 + 1), "source").alias("context"),
        A._nth(["00-00-01", "24-10-04"], c("seq") % 2 + 1).alias("base"))
    return titled.filter(
        rules.is_relevant_ct(c("title"), c("context")) & ~c("base").isin(V.PLACEHOLDER_DOCKETS_CT))


def _cells(s, d):
    """Numbers as they stand in spreadsheet cells."""
    number = F.concat(F.lit(" "), F.format_number("l_extendedprice", 2))
    cell = (
        F.when(c("l_linenumber") == 1, number)
        .when(c("l_linenumber") == 2, "N/A").when(c("l_linenumber") == 3, " . ")
        .when(c("l_linenumber") == 4, F.concat(c("l_partkey").cast("string"), F.lit(".7")))
        .when(c("l_linenumber") == 5, "").otherwise("n.a.")
    )
    return A.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", cell.alias("cell"))


def _cell(value):
    return lambda s, d: _cells(s, d).select("l_orderkey", "l_linenumber", "l_partkey", value(c("cell")).alias("value"))


def _parties(s, d):
    """Party lists with an industry after the last dash and invisible blanks."""
    z = F.lit("​")
    return A.rate_cases(s, d, score=False).select(
        "seq", F.concat(z, "utility_name", F.lit(" - North - "), F.initcap("utility_type"), z, F.lit(", Office of Counsel")).alias("parties"),
        c("case_type").alias("petition"), F.coalesce("utility_type", F.lit("")).alias("industry"))


def _label_cases(s, d):
    return A.rate_cases(s, d).select(
        "docket_number", "source",
        text.case_type_label(F.when(c("status") == "filed", c("utility_type")).otherwise(c("case_type"))).alias("label"))


def _issues(s, d):
    return A.rate_cases(s, d).select(
        "docket_number", "source", "quality_score", _messages(scores.quality_issues()).alias("issues"))


def _runs(s, d):
    """Audit rows written from the orders; some counters are negative."""
    return A.table(s, d, "orders").select(
        c("o_orderkey").alias("seq"), c("o_orderpriority").alias("source"),
        F.when(c("o_orderstatus") != "P", "store").alias("stage"), F.lit("running").alias("status"),
        (c("o_custkey") - 5).alias("records_processed"), F.lit(0).alias("records_created"),
        F.lit(0).alias("records_updated"), F.lit(0).alias("errors"))


QUERIES = {
    # amounts, percentages, dates
    "extract_dollar": _per_text(text.extract_dollar),
    "extract_all_dollars": _joined(text.extract_all_dollars),
    "parse_dollar": _per_text(text.parse_dollar),
    "parse_percent": _per_text(text.parse_percent),
    "extract_date": _per_text(text.extract_date),
    "extract_all_dates": _joined(text.extract_all_dates),
    "revenue_request": _per_text(text.revenue_request),
    "revenue_approved": _per_text(text.revenue_approved),
    "extract_roe": _per_text(text.extract_roe),
    "extract_rate_base": _per_text(text.extract_rate_base),
    "parse_date": _per_record(filing=lambda: text.parse_date(c("filing_date")), decision=lambda: text.parse_date(c("decision_date"))),
    "parse_date_state": _per_record(filing=lambda: text.parse_date_state(c("filing_date")), decision=lambda: text.parse_date_state(c("decision_date"))),
    "field_date": _per_record(value=lambda: text.field_date(c("filing_date"))),
    "field_float": _per_record(value=lambda: text.field_float(c("requested_revenue_change"))),
    "scale_amount": lambda s, d: A.table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.scale_amount(
            c("l_extendedprice"), A._nth(["billion", "B", "Million", "m", ""], c("l_linenumber") % 5 + 1)).alias("value")),
    "safe_int": _cell(text.safe_int),
    "safe_float": _cell(text.safe_float),
    "safe_str": _cell(text.safe_str),
    # records
    "parse_record": lambda s, d: parsed(s, d).drop("scraped_at"),
    "reject_incomplete": lambda s, d: extract.reject_incomplete(A.raw_records(s, d))[1].select("seq", "utility_name", "state", "source"),
    "defaults": _defaults,
    # rules
    "classify_case_type": lambda s, d: A.texts(s, d).select("id", rules.classify_case_type(c("text"), c("id")).alias("value")),
    "classify_utility_type": _per_record(value=lambda: rules.classify_utility_type(c("description"), F.trim("docket_number"))),
    "normalise_status": _per_record(value=lambda: rules.normalise_status(c("status"))),
    "classify_ownership": lambda s, d: A.raw_names(s, d).select("utility_name", rules.classify_ownership(c("utility_name")).alias("value")),
    "source_utility_type": lambda s, d: _titles(s, d).select("seq", rules.source_utility_type(c("source"), c("title"), c("docket")).alias("value")),
    "source_case_type": lambda s, d: _titles(s, d).select("seq", rules.source_case_type(c("source"), c("title"), c("docket")).alias("value")),
    "source_status": lambda s, d: _titles(s, d).select("seq", rules.source_status(
        c("source"), A._nth(["Closed", "pending", "Appealed", "Active", "New", "void"], c("seq") % 6 + 1), c("decision")).alias("value")),
    "gazetteer_name": _gazetteer,
    "relevance_filter": _relevance,
    "fuel_category": lambda s, d: A.generators(s, d).groupBy("technology").agg(F.count("*").alias("n")).select(
        "technology", rules.fuel_category(c("technology")).alias("fuel"), "n"),
    "planned_flags": lambda s, d: A.generators(s, d).select(
        "utility_id", "plant_code", "operating_year", rules.planned_addition(c("status")).cast("int").alias("adds"),
        rules.planned_retirement(c("planned_retirement_year"), 2001).cast("int").alias("retires")),
    # names and dockets
    "clean_name": lambda s, d: A.raw_names(s, d).select("utility_name", names.clean_name(c("utility_name")).alias("value")),
    "norm_for_match": lambda s, d: A.raw_names(s, d).select("utility_name", names.norm_for_match(c("utility_name")).alias("value")),
    "token_sort_ratio": lambda s, d: A.linkage_left(s, d).select(
        "name", "state", names.token_sort_ratio(c("name"), F.concat("state", F.lit(" GEAR widget-"), F.lower("state"))).alias("score")),
    "docket_year": lambda s, d: A.rate_cases(s, d).select(
        "docket_number", dockets.docket_year(_sheet_docket()).alias("year"),
        dockets.title_year(F.concat(F.lit("Case "), F.date_format("filing_date", "yyyy"), F.lit(" plan"))).alias("in_title"),
        dockets.free_year(F.when(c("status") == "decided", F.date_format("filing_date", "MM/dd/yyyy")).otherwise(
            F.concat(F.lit("no. 12 of "), F.date_format("filing_date", "yyyy"), F.lit("9")))).alias("in_text")),
    "docket_date": lambda s, d: A.rate_cases(s, d).select("docket_number", dockets.docket_date(_sheet_docket()).alias("day")),
    "docket_normalise": lambda s, d: A.rate_cases(s, d).select("docket_number", dockets.docket_normalise(_sheet_docket()).alias("docket")),
    "petitioner": lambda s, d: _parties(s, d).select("seq", dockets.petitioner(c("parties")).alias("value")),
    "build_description": lambda s, d: _parties(s, d).select("seq", dockets.build_description(c("petition"), c("industry"), c("parties")).alias("value")),
    "enrich_description": lambda s, d: A.rate_cases(s, d, score=False).select("docket_number", dockets.enrich_description(
        F.when(c("status") == "filed", F.lit("")).when(c("status") == "active", F.concat(F.lit("Rates of $5, "), "utility_name"))
        .otherwise(F.concat(F.lit("In the matter of "), "utility_name")),
        F.when(c("seq") % 3 != 0, F.concat(F.lit("Order "), "docket_number"))).alias("value")),
    "template_url": _per_case(url=lambda: dockets.template_url(c("source"), c("docket_number"))),
    # display
    "strip_html": _per_case(value=lambda: strip_html(c("description"))),
    "unescape_all_strings": lambda s, d: writers.unescape_all_strings(A.table(s, d, "pages").select("page_id", "url", "html")),
    "case_type_label": _label_cases,
    # scores and checks
    "quality_score": lambda s, d: A.rate_cases(s, d).select("docket_number", "source", "quality_score"),
    "quality_issues": _issues,
    "validate_case": _per_case(errors=lambda: _messages(scores.validate_case())),
    "score_operations": lambda s, d: A.utility_operations(s, d).select("eia_utility_id", "year", "quality_score"),
    "score_emissions": lambda s, d: A.utility_emissions(s, d).select("utility_name_egrid", "year", "quality_score"),
    "score_capacity": lambda s, d: capacity(s, d).select("eia_utility_id", "year", "quality_score"),
    "revenue_per_customer": lambda s, d: A.utility_operations(s, d).select("eia_utility_id", "year", "revenue_per_customer"),
    "schema_check_case": _per_case(reasons=lambda: _messages(scores.schema_check_case())),
    "schema_check_utility": lambda s, d: A.utilities(s, d).select("name", _messages(scores.schema_check_utility()).alias("reasons")),
    "schema_check_document": lambda s, d: A.case_documents(s, d).select(
        "docket_number", "title", "url", _messages(scores.schema_check_document()).alias("reasons")),
    "schema_check_run": lambda s, d: _runs(s, d).select("seq", _messages(scores.schema_check_run()).alias("reasons")),
    "dup_dockets": lambda s, d: quality.dup_dockets(A.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "multi_state_entities": lambda s, d: quality.multi_state_entities(A.rate_cases(s, d)),
    "doc_count_join": lambda s, d: quality.doc_counts(A.rate_cases(s, d), A.case_documents(s, d)).select("docket_number", "source", "document_count"),
}

