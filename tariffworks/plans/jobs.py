"""End-to-end jobs: chains of the operators, each returning DataFrames.

Nothing is collected.  A caller writes what is returned; long chains can be cut
with :func:`tariffworks.session.cut_lineage`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffworks.fixed_values import AVERAGE_MONTHLY_KWH
from tariffworks.functions.rules import classify_ownership
from tariffworks.functions.text import approval_pct, duration_days, money_format
from tariffworks.operators import (
    extract, filters, firstwins, fleet, impact, linkage, merge, quality, resolve,
)
from tariffworks.plans import reports
from tariffworks.session import cut_lineage
from tariffworks.sources import writers


def normalise(cases: DataFrame, utilities: DataFrame, aliases: DataFrame
              ) -> tuple[DataFrame, DataFrame]:
    """(cases with canonical names, utilities with the organisations found).

    One state stands for each raw name, that of its newest case.
    """
    newest_first = F.struct(
        F.col("filing_date").isNull().alias("no_date"),
        (-F.unix_date("filing_date")).alias("age"),
        F.col("docket_number"), F.col("source"),
    )
    names = cases.groupBy("utility_name").agg(F.min_by("state", newest_first).alias("state"))
    resolved = cut_lineage(resolve.resolve_utilities(names, aliases))
    found = firstwins.first_utility_rows(cases, resolved).select(
        "name", F.col("name").alias("canonical_name"), "state", "utility_type",
        classify_ownership(F.col("name")).alias("ownership_type"), "parent_company",
        F.lit(0).alias("seq"),
    )
    mapping = resolved.withColumn(
        "canonical_name", F.coalesce("canonical_name", "utility_name")
    )
    return merge.update_names(cases, mapping), merge.merge_utilities(utilities, found)


def validate(cases: DataFrame, links: DataFrame, emissions: DataFrame, impacts: DataFrame
             ) -> DataFrame:
    """Cases with enrichment flags, new scores, components, issues and errors."""
    return quality.score_cases(quality.enrichment_flags(cases, links, emissions, impacts))


def enrich(cases: DataFrame, utilities: DataFrame, operations: DataFrame, emissions: DataFrame,
           generators: DataFrame, year: int, as_of_year: int, kwh: float = AVERAGE_MONTHLY_KWH
           ) -> dict[str, DataFrame]:
    """Links, linked emissions, capacity and impacts."""
    links = cut_lineage(linkage.link_utilities(utilities, operations))
    ordered = links.withColumn("seq", F.struct("state", "eia_utility_id"))
    return {
        "utility_eia_links": links,
        "utility_emissions": linkage.link_emissions(ordered, emissions),
        "utility_capacity": fleet.fleet_rollup(generators, year, as_of_year),
        "rate_case_impacts": impact.rate_case_impacts(cases, ordered, operations, kwh),
    }


def summaries(scored: DataFrame) -> dict[str, DataFrame]:
    """What a run reports of the scored cases."""
    return {"validation": quality.validation_summary(scored), "statistics": reports.case_statistics(scored)}


def ingest(raw: DataFrame, stored: DataFrame, utilities: DataFrame, aliases: DataFrame,
           links: DataFrame, emissions: DataFrame, impacts: DataFrame) -> dict[str, DataFrame]:
    """Raw records to named and scored cases without storing any, with the statistics of the result."""
    parsed, rejects = extract.parse_record(raw)
    typed = parsed.withColumn("scraped_at", F.try_to_timestamp("scraped_at"))
    merged = cut_lineage(merge.merge_cases(stored, typed))
    named, organisations = normalise(merged, utilities, aliases)
    scored = validate(named, links, emissions, impacts)
    return {"rate_cases": scored.select(*stored.columns), "utilities": organisations, "rejects": rejects, **summaries(scored)}


def report_summary(cases: DataFrame) -> dict[str, DataFrame]:
    """The tables of the summary report."""
    top = reports.top_requests(cases)
    return {
        "by_state": reports.stats_by(cases, "state").orderBy("state"),
        "by_type": reports.stats_by(cases, "case_type"),
        "financial": reports.stats_financial(cases),
        "quality": reports.stats_quality(cases),
        "largest": top.select(
            "docket_number",
            F.substring(filters.display_name(), 1, 45).alias("utility"), "state",
            money_format(F.col("requested_revenue_change"), "N/A").alias("requested"),
            money_format(F.col("approved_revenue_change"), "Pending").alias("approved"), "status",
        ),
    }


def case_detail(cases: DataFrame, docket: str) -> DataFrame:
    """One case with its duration and amounts; zero and missing amounts are 'no data'."""
    def shown(column: str, missing: str):
        return F.coalesce(
            F.concat(money_format(F.nullif(F.col(column), F.lit(0.0)), None), F.lit("M")),
            F.lit(missing),
        )

    asked, given = F.col("requested_revenue_change"), F.col("approved_revenue_change")
    one = filters.lookup_case(filters.with_display(cases), docket)
    return one.select(
        "docket_number", "display_name", "state", "source", "status", "case_type_display",
        "filing_date", "decision_date",
        duration_days(F.col("filing_date"), F.col("decision_date")).alias("duration_days"),
        shown("requested_revenue_change", "No data yet").alias("requested"),
        shown("approved_revenue_change", "Pending").alias("approved"),
        shown("rate_base", "No data yet").alias("rate_base"),
        F.round(F.when((asked != 0) & (given != 0), approval_pct(given, asked)), 1)
        .alias("approval_pct"),
    )


def export(tables: dict[str, DataFrame], out_dir: str, formats: tuple[str, ...] = ("csv", "json")
           ) -> list[str]:
    """Write the exports and return the folders written; empty tables are skipped.

    Each table is read several times, the cases six: store derived ones first.
    """
    cases, utilities = tables["rate_cases"], tables["utilities"]
    if cases.isEmpty():
        return []
    written = []

    def csv(df: DataFrame, name: str) -> None:
        writers.write_csv(df, f"{out_dir}/{name}_csv")
        written.append(f"{out_dir}/{name}_csv")

    if "csv" in formats:
        csv(writers.cases_csv(cases), "rate_cases")
        for name in ("utility_operations", "utility_emissions", "utility_capacity",
                     "rate_case_impacts"):
            if name in tables and not tables[name].isEmpty():
                csv(writers.enrichment_csv(tables[name]), name)
    if "json" in formats:
        parts = {
            "metadata": writers.json_metadata(cases, utilities),
            "statistics": reports.stats_financial(cases),
            "rate_cases": writers.unescape_all_strings(cases),
            "utilities": writers.unescape_all_strings(utilities),
        }
        for name, df in parts.items():
            df.write.mode("overwrite").json(f"{out_dir}/json/{name}")
        written.append(f"{out_dir}/json")
    if "report" in formats:
        csv(writers.report_cells(cases), "report_cases")
        csv(writers.utility_cells(utilities), "report_utilities")
    return written
