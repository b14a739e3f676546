"""Queries that resolve and link names, merge batches and run whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.files import scratch
from catalog.stored import capacity, impacts
from tariffworks import fixed_values as V
from tariffworks import schemas
from tariffworks.operators import (
    extract, firstwins, linkage, merge, pages, quality, resolve,
)
from tariffworks.plans import adapters as A
from tariffworks.plans import jobs, pipeline
from tariffworks.plans import reports as R

c, lit = F.col, F.lit

CASE = ["docket_number", "source"]


def aliases(s):
    return resolve.alias_table(s)


def resolved(s, d):
    return resolve.resolve_utilities(A.raw_names(s, d), aliases(s))


def _fuzzy(s, d, which):
    rest = resolved_rest(s, d)
    return resolve.resolve_fuzzy(rest, aliases(s)).filter(c(which).isNotNull()).select(
        "utility_name", c(which)["canonical"].alias("canonical"), c(which)["score"].alias("score"))


def resolved_rest(s, d):
    """Names that no spelling matches exactly."""
    staged = resolve.resolve_cleaned(resolve.resolve_exact(A.raw_names(s, d), aliases(s)), aliases(s))
    return staged.filter(c("exact").isNull() & c("cleaned").isNull()).select("utility_name", "state")


def named_cases(s, d):
    """Cases filed under the raw names, one for each part."""
    part = A.table(s, d, "part")
    names = A.raw_names(s, d).select("utility_name", c("state").alias("name_state"))
    kind = c("p_size") % 5
    alias = aliases(s)
    n = len(resolve.alias_rows())
    spelled = part.join(alias, (c("p_partkey") % n).cast("int") == c("pos")).select(
        c("p_partkey").cast("string").alias("docket_number"),
        F.when(kind == 0, c("alias")).when(kind == 1, F.concat("alias", lit(", Inc.")))
        .when(kind == 2, F.concat(F.substring("alias", 1, 3), F.substring("alias", 5, 100)))
        .when(kind == 3, F.concat("alias", lit(" "), F.substring("p_name", 1, 3)))
        .otherwise(F.concat("p_name", lit(" Co-op "), c("p_brand"))).alias("utility_name"),
        F.date_add(lit("2000-01-01").cast("date"), -(c("p_partkey") % 1000).cast("int")).alias("filing_date"),
        lit("oregon_puc").alias("source"),
    )
    return spelled.join(names, "utility_name").select(
        "docket_number", "utility_name", lit(None).cast("string").alias("canonical_utility_name"),
        c("name_state").alias("state"), "source", "filing_date")


def links_found(s, d):
    return linkage.link_utilities(A.linkage_left(s, d), A.linkage_right(s, d))


def _stage(name):
    def run(s, d):
        stage = linkage.link_stages(A.linkage_left(s, d), A.linkage_right(s, d))[name]
        return stage.withColumnsRenamed({"link_name": "utility_name", "link_state": "state"})
    return run


def known_links(s, d):
    """Links from the reference side itself, in order of id."""
    return A.linkage_right(s, d).select(
        "utility_name", F.upper("state").alias("state"), "eia_utility_id", "seq")


def emissions_linked(s, d):
    return linkage.link_emissions(known_links(s, d), A.linkage_emissions(s, d)).select(
        "utility_name_egrid", "state", "eia_utility_id", c("is_linked").cast("int").alias("is_linked"))


# --- merges -------------------------------------------------------------------------------

CASE_COLUMNS = ["docket_number", "source", "utility_name", "state", "case_type", "utility_type", "status",
                "decision_date", "requested_revenue_change", "approved_revenue_change"]


def stored_cases(s, d):
    """What is stored: cases filed before 1998."""
    return A.rate_cases(s, d, score=False).filter(c("filing_date") < "1998-01-01").select(*CASE_COLUMNS)


def case_batch(s, d):
    """What arrives: one partial record for each line item, several for most keys."""
    known = A.rate_cases(s, d, score=False).select("docket_number", "source", "utility_name", "state")
    line = A.table(s, d, "lineitem")
    return line.join(known, c("l_orderkey").cast("string") == c("docket_number")).select(
        "docket_number", "source", "utility_name", "state",
        F.when(c("l_linenumber") > 5, "rate_design").alias("case_type"),
        lit(None).cast("string").alias("utility_type"),
        F.when(c("l_linestatus") == "F", "decided").alias("status"),
        F.when(c("l_returnflag") == "R", c("l_shipdate").cast("date")).alias("decision_date"),
        lit(None).cast("double").alias("requested_revenue_change"),
        F.when(c("l_returnflag") == "A", c("l_quantity")).alias("approved_revenue_change"),
        _line_seq().alias("seq"))


def _line_seq():
    """Order of arrival of line items: by number, part, supplier and price."""
    return F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def merged_cases(s, d):
    return merge.merge_cases(stored_cases(s, d), case_batch(s, d))


def _utilities_merge(s, d):
    old = A.utilities(s, d).filter(c("eia_utility_id") % 2 == 0).drop("seq")
    orders = A.table(s, d, "orders")
    batch = orders.join(A.utilities(s, d), c("o_custkey") == c("eia_utility_id")).select(
        "name", "state", lit(None).cast("string").alias("canonical_name"),
        F.when(c("o_orderstatus") == "F", "unknown").otherwise("telecommunications").alias("utility_type"),
        F.when(c("o_orderpriority") == "1-URGENT", "municipal").otherwise("unknown").alias("ownership_type"),
        F.when(c("o_orderstatus") == "O", c("o_orderpriority")).alias("parent_company"),
        c("o_orderkey").alias("seq"))
    return merge.merge_utilities(old, batch)


def _year_merge(table, how, partial, old_rows):
    """Merge a table into some of its own rows; ``partial`` changes the arriving rows."""
    def run(s, d):
        rows = table(s, d)
        rows = rows.drop("seq") if "seq" in rows.columns else rows
        return how(rows.filter(old_rows()), partial(rows).withColumn("seq", lit(1)))
    return run


def _links_merge(s, d):
    rows = A.links(s, d)
    old = rows.filter(c("seq") % 2 == 0).groupBy("utility_name", "state", "eia_utility_id").agg(
        lit(0.5).alias("match_confidence"), lit("old").alias("match_method"))
    batch = rows.select(
        "utility_name", "state", "eia_utility_id",
        F.when(c("seq") % 3 != 0, c("seq").cast("double")).alias("match_confidence"),
        lit("new").alias("match_method"), "seq")
    return merge.merge_links(old, batch)


def _impacts_merge(s, d):
    rows = impacts(s, d)
    old = rows.filter(c("total_customers") % 2 == 0)
    batch = rows.withColumn("pct_of_avg_bill", lit(None).cast("double")).withColumn("seq", lit(1))
    return merge.merge_impacts(old, batch)


def _store(s, d):
    batch = case_batch(s, d).drop("source").withColumn(
        "utility_name", F.when(c("approved_revenue_change") != 50, c("utility_name")))
    return merge.merge_store(stored_cases(s, d), batch, "oregon_puc")


def _scores(s, d):
    return A.rate_cases(s, d).filter(c("status") == "decided").select(*CASE, (c("quality_score") / 2).alias("quality_score"))


def _update_scores(keys):
    def run(s, d):
        cases = A.rate_cases(s, d).withColumn("updated_at", lit(None).cast("timestamp"))
        now = lit("2001-02-03 00:00:00").cast("timestamp")
        return merge.update_scores(cases, _scores(s, d).select(*keys, "quality_score"), updated_at=now).select(
            *CASE, "quality_score", F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))
    return run


def _documents(s, d):
    docs = A.case_documents(s, d)
    batch = docs.select(
        F.when(c("document_type") != "testimony", c("docket_number")).alias("docket_number"),
        F.nullif("document_type", lit("order")).alias("document_type"), "title", "source", "state")
    return merge.append_documents(docs, batch).select("docket_number", "document_type", "title", "source", "state")


def _audit(s, d):
    orders = A.table(s, d, "orders")
    started = c("o_orderdate").cast("timestamp")
    run_id = F.concat(F.lpad(c("o_orderkey").cast("string"), 8, "0"), lit("-tail"))
    opened = orders.select(*merge.audit_start(run_id, c("o_orderpriority"), "store", started))
    closed = orders.filter(c("o_orderstatus") != "P").select(
        *[x for x in merge.audit_start(run_id, c("o_orderpriority"), "store", started)]
    ).withColumns({"status": lit("completed"), "records_processed": c("run_id").cast("bigint"),
                   "completed_at": c("started_at") + F.expr("INTERVAL 1 HOUR")})
    return merge.audit_latest(opened.unionByName(closed)).select("run_id", "source", "status", "records_processed")


# --- jobs ------------------------------------------------------------------------------------

def _empty(s, name):
    return s.createDataFrame([], schemas.TABLES[name][0])


def _validated(s, d):
    return jobs.validate(A.rate_cases(s, d), A.links(s, d), A.utility_emissions(s, d), impacts(s, d))


def _normalised(s, d):
    empty = _empty(s, "utilities")
    return jobs.normalise(named_cases(s, d), empty, aliases(s))


def _ingested(s, d):
    raw = A.raw_records(s, d)
    empty_links = _empty(s, "utility_eia_links").withColumn("seq", lit(0))
    return jobs.ingest(raw, _empty(s, "rate_cases"), _empty(s, "utilities"), aliases(s), empty_links,
                       _empty(s, "utility_emissions"), _empty(s, "rate_case_impacts"))


def _piped(s, d):
    """Every second raw record stored in a first run, all of them in a second one."""
    root, raw = scratch(s), A.raw_records(s, d)
    at = [lit("2001-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=lit(h)) for h in range(4)]
    pipeline.create_tables(s, root)
    pipeline.store_batch(s, root, raw.filter(c("seq") % 2 == 0), V.SOURCES, "first", at[0], at[1])
    empty_links = _empty(s, "utility_eia_links").withColumn("seq", lit(0))
    return pipeline.run_pipeline(
        s, root, raw, V.SOURCES, "second", at[2], at[3], _empty(s, "utilities"), aliases(s), empty_links,
        _empty(s, "utility_emissions"), _empty(s, "rate_case_impacts"))


def _enriched(s, d):
    """Rows of each enrichment table and what identifies them best."""
    operations = A.linkage_right(s, d).withColumns({
        "year": lit(2001), "total_customers": c("seq") + 1, "residential_avg_price": lit(12.0)})
    out = jobs.enrich(A.rate_cases(s, d), A.linkage_left(s, d), operations,
                      A.linkage_emissions(s, d), A.generators(s, d), 2001, 2001)
    return out["utility_eia_links"].select(lit("links").alias("part"), c("match_method").alias("what")).unionByName(
        out["utility_emissions"].select(lit("emissions").alias("part"), c("is_linked").cast("int").cast("string").alias("what"))
    ).unionByName(
        out["utility_capacity"].select(lit("capacity").alias("part"), c("num_plants").cast("string").alias("what"))
    ).groupBy("part", "what").agg(F.count("*").alias("n"))


QUERIES = {
    # resolution
    "resolve_exact": lambda s, d: resolve.resolve_exact(A.raw_names(s, d), aliases(s)).select(
        "utility_name", c("exact.canonical").alias("canonical")),
    "resolve_cleaned": lambda s, d: resolve.resolve_cleaned(A.raw_names(s, d), aliases(s)).select(
        "utility_name", "cleaned_name", c("cleaned.canonical").alias("canonical")),
    "resolve_fuzzy_state": lambda s, d: _fuzzy(s, d, "in_state"),
    "resolve_fuzzy_any": lambda s, d: _fuzzy(s, d, "any_state"),
    "resolve_utilities": resolved,
    "parent_company": lambda s, d: resolved(s, d).select("utility_name", "parent_company"),
    "resolution_summary": lambda s, d: resolve.resolution_summary(resolved(s, d)),
    "apply_name_mapping": lambda s, d: resolve.apply_name_mapping(named_cases(s, d), resolved(s, d)).select(
        "docket_number", "utility_name", "canonical_utility_name"),
    "first_utility_row": lambda s, d: firstwins.first_utility_rows(named_cases(s, d), resolved(s, d)),
    # linkage
    "link_exact": _stage("exact"),
    "link_fuzzy_state": _stage("fuzzy_state"),
    "link_fuzzy_cross_state": _stage("fuzzy_cross_state"),
    "link_utilities": links_found,
    "link_summary": lambda s, d: linkage.link_summary(A.linkage_left(s, d), links_found(s, d)),
    "link_emissions": emissions_linked,
    "dedupe_eia": lambda s, d: firstwins.dedupe_eia(A.linkage_right(s, d)).select("eia_utility_id", "utility_name", "state"),
    "best_match": lambda s, d: links_found(s, d).select("utility_name", "state", "match_confidence"),
    # merges
    "merge_existence": lambda s, d: merge.merge_existence(stored_cases(s, d), case_batch(s, d), CASE).groupBy("is_stored").agg(
        F.count("*").alias("n")).select(c("is_stored").cast("int").alias("is_stored"), "n"),
    "merge_cases": merged_cases,
    "merge_cases_batch": lambda s, d: merge.merge_counts(stored_cases(s, d), case_batch(s, d), CASE),
    "merge_store": lambda s, d: _store(s, d)[0].select(*CASE_COLUMNS),
    "merge_utilities": _utilities_merge,
    "merge_operations": _year_merge(
        A.utility_operations, merge.merge_operations,
        lambda rows: rows.withColumn("total_customers", F.when(c("year") % 2 == 1, c("total_customers") + 1)),
        lambda: c("year") <= 1998),
    "merge_emissions": _year_merge(
        A.utility_emissions, merge.merge_emissions,
        lambda rows: rows.withColumn("co2_tons", F.when(c("year") % 2 == 1, c("co2_tons") + 1)), lambda: c("year") <= 1998),
    "merge_capacity": _year_merge(
        capacity, merge.merge_capacity,
        lambda rows: rows.withColumn("num_plants", F.when(c("num_plants") % 2 == 1, c("num_plants") + 1000)),
        lambda: c("num_generators") % 2 == 0),
    "merge_links": _links_merge,
    "merge_impacts": _impacts_merge,
    "append_documents": _documents,
    "update_names": lambda s, d: merge.update_names(named_cases(s, d), resolved(s, d)).select("docket_number", "canonical_utility_name"),
    "update_scores": _update_scores(["docket_number"]),
    "score_update_join": _update_scores(CASE),
    "run_counters": lambda s, d: _store(s, d)[1],
    "update_counts": lambda s, d: merge.update_counts(A.rate_cases(s, d), _scores(s, d).unionByName(
        _scores(s, d).withColumn("docket_number", F.concat(lit("no "), "docket_number")))),
    "audit_run": _audit,
    "case_orders_join": lambda s, d: pages.case_orders_join(
        A.rate_cases(s, d, score=False).select("docket_number", "source", "decision_date"),
        A.table(s, d, "lineitem").select(
            c("l_orderkey").cast("string").alias("docket_number"),
            F.when(c("l_returnflag") == "A", "Final Order, phase 2").when(c("l_returnflag") == "N", "Entry").alias("order_type"),
            c("l_shipdate").cast("date").alias("order_date"), _line_seq().alias("position")), "docket_number"),
    "decision_from_orders": lambda s, d: pages.decision_from_orders(
        A.table(s, d, "lineitem").select(
            c("l_suppkey").alias("supplier"), F.when(c("l_discount") == 0.05, "FINAL ORDER").alias("order_type"),
            c("l_shipdate").cast("date").alias("order_date"),
            F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("position")), "supplier"),
    # quality
    "enrichment_flags": lambda s, d: quality.enrichment_flags(
        A.rate_cases(s, d), A.links(s, d), A.utility_emissions(s, d), impacts(s, d)).select(
        *CASE, *[c(x).cast("int").alias(x) for x in ["has_eia_link", "has_emissions", "has_impact"]]),
    "validation_summary": lambda s, d: quality.validation_summary(_validated(s, d)),
    # jobs
    "job_validate": lambda s, d: _validated(s, d).select(
        *CASE, "quality_score", F.size("issues").alias("n_issues"), F.array_join("errors", "; ").alias("errors")),
    "job_normalise": lambda s, d: _normalised(s, d)[1].select(
        "name", "state", "utility_type", "ownership_type", "parent_company"),
    "job_normalise_cases": lambda s, d: _normalised(s, d)[0].select("docket_number", "utility_name", "canonical_utility_name"),
    "job_enrich": _enriched,
    "job_ingest": lambda s, d: _ingested(s, d)["rate_cases"].select(
        "docket_number", "source", "utility_name", "canonical_utility_name", "state", "case_type", "utility_type",
        "status", "filing_date", "requested_revenue_change", "approved_revenue_change", "quality_score"),
    "job_pipeline": lambda s, d: _piped(s, d)["rate_cases"].select(
        "docket_number", "source", "utility_name", "canonical_utility_name", "state", "case_type", "utility_type",
        "status", "filing_date", "requested_revenue_change", "approved_revenue_change", "quality_score"),
    "job_pipeline_runs": lambda s, d: _piped(s, d)["pipeline_runs"].select(
        "run_id", "source", "stage", "status", "records_processed", "records_created", "records_updated", "errors",
        F.date_format("started_at", "HH").alias("started"), F.date_format("completed_at", "HH").alias("completed")),
    "job_pipeline_statistics": lambda s, d: _piped(s, d)["statistics"],
    "report_summary": lambda s, d: jobs.report_summary(A.rate_cases(s, d))["largest"],
    **{f"report_summary_{part}": lambda s, d, part=part: jobs.report_summary(A.rate_cases(s, d))[part]
       for part in ("by_state", "by_type", "financial", "quality")},
    "case_detail": lambda s, d: jobs.case_detail(A.rate_cases(s, d), "77"),
}
