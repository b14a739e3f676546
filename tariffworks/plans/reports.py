"""Reporting queries: roll-ups, top lists, histograms, time lines.

Each function takes stored tables and returns a small table.  ``k`` of the top
lists is 15 unless told otherwise; ties are broken by the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffworks.fixed_values import FUELS, QUALITY_FLOOR
from tariffworks.functions.columns import title_case
from tariffworks.functions.text import approval_pct, duration_days, month_label
from tariffworks.operators.filters import display_name
from tariffworks.operators.firstwins import last_per_key, latest_year_slice

c = F.col


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def _count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("cnt"))


# --- statistics -------------------------------------------------------------------

def stats_total(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count("*").alias("cnt"))


def stats_by(cases: DataFrame, key: str) -> DataFrame:
    """Cases per value of a column, most first; a null value is a group of its own."""
    return _count_by(cases, key).orderBy(c("cnt").desc(), key)


def stats_financial(cases: DataFrame) -> DataFrame:
    """Totals and averages over the cases that name a requested change."""
    asked, given = "requested_revenue_change", "approved_revenue_change"
    return cases.filter(c(asked).isNotNull()).agg(
        F.count("*").alias("cases_with_revenue_data"),
        F.round(_or_zero(F.sum(asked)), 1).alias("total_requested_m"),
        F.round(_or_zero(F.avg(asked)), 1).alias("avg_requested_m"),
        F.round(_or_zero(F.sum(given)), 1).alias("total_approved_m"),
        F.round(_or_zero(F.avg(given)), 1).alias("avg_approved_m"),
        F.round(_or_zero(F.avg("return_on_equity")), 2).alias("avg_roe_pct"),
    )


def stats_quality(cases: DataFrame) -> DataFrame:
    q = "quality_score"
    return cases.filter(c(q).isNotNull()).agg(
        F.round(_or_zero(F.avg(q)), 3).alias("avg_score"),
        F.round(_or_zero(F.min(q)), 3).alias("min_score"),
        F.round(_or_zero(F.max(q)), 3).alias("max_score"),
        F.count_if(c(q) >= QUALITY_FLOOR).alias("above_threshold"),
    )


def stats_unique_utilities(cases: DataFrame, approximate: bool = False) -> DataFrame:
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return cases.agg(counter("utility_name").alias("cnt"))


def stats_date_range(cases: DataFrame) -> DataFrame:
    return cases.agg(
        F.min("filing_date").alias("earliest_filing"), F.max("filing_date").alias("latest_filing")
    )


def stats_enrichment(operations: DataFrame, links: DataFrame, emissions: DataFrame,
                     capacity: DataFrame, impacts: DataFrame) -> DataFrame:
    """Row counts of the enrichment tables and two distinct counts, as (metric, cnt)."""
    counted = {
        "utility_operations": operations, "eia_links": links, "emissions_records": emissions,
        "capacity_records": capacity, "impact_records": impacts,
    }
    parts = [
        df.agg(F.count("*").alias("cnt")).select(F.lit(name).alias("metric"), "cnt")
        for name, df in counted.items()
    ]
    for name, df in {"unique_eia_utilities": operations, "linked_utilities": links}.items():
        parts.append(
            df.agg(F.count_distinct("eia_utility_id").alias("cnt"))
            .select(F.lit(name).alias("metric"), "cnt")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_GROUPED = ["state", "source", "case_type", "status"]


def case_statistics(cases: DataFrame) -> DataFrame:
    """All statistics of the cases in long form (section, key, metric, value), from one scan and one shuffle.

    Sections: total, financial, quality, dates (as yyyymmdd) and by_state, by_source, by_case_type, by_status.
    Names are one more grouping set, so that they are counted without a distinct aggregate.
    """
    asked, given, q, filed = c("requested_revenue_change"), c("approved_revenue_change"), c("quality_score"), c("filing_date")
    named = asked.isNotNull()
    of_all = {
        ("financial", "cases_with_revenue_data"): F.count(asked),
        ("financial", "total_requested_m"): F.round(_or_zero(F.sum(asked)), 1),
        ("financial", "avg_requested_m"): F.round(_or_zero(F.avg(asked)), 1),
        ("financial", "total_approved_m"): F.round(_or_zero(F.sum(F.when(named, given))), 1),
        ("financial", "avg_approved_m"): F.round(_or_zero(F.avg(F.when(named, given))), 1),
        ("financial", "avg_roe_pct"): F.round(_or_zero(F.avg(F.when(named, c("return_on_equity")))), 2),
        ("quality", "avg_score"): F.round(_or_zero(F.avg(q)), 3),
        ("quality", "min_score"): F.round(_or_zero(F.min(q)), 3),
        ("quality", "max_score"): F.round(_or_zero(F.max(q)), 3),
        ("quality", "above_threshold"): F.count_if(q >= QUALITY_FLOOR),
        ("dates", "earliest_filing"): F.date_format(F.min(filed), "yyyyMMdd"),
        ("dates", "latest_filing"): F.date_format(F.max(filed), "yyyyMMdd"),
    }
    keys = [*_GROUPED, "utility_name"]
    values = [value.cast("double").alias(f"{section} {metric}") for (section, metric), value in of_all.items()]
    grouped = cases.groupingSets([[], *[[k] for k in keys]], *keys).agg(
        F.grouping_id().alias("set"), F.count("*").cast("double").alias("cnt"), *values)

    def row(section: str, key: Column, metric: str, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"), F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"))

    none = F.lit(None)
    # The bit of a key is 0 where rows are grouped by it.
    every = (1 << len(keys)) - 1
    set_of = {k: every - (1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)}
    total = F.array(row("total", none, "cases", c("cnt")),
                    *[row(section, none, metric, c(f"`{section} {metric}`")) for section, metric in of_all])
    names = F.array(row("total", none, "unique_utilities", F.when(c("utility_name").isNotNull(), 1.0).otherwise(0.0)))
    rows = F.when(c("set") == every, total).when(c("set") == set_of["utility_name"], names)
    for k in _GROUPED:
        rows = rows.when(c("set") == set_of[k], F.array(row(f"by_{k}", c(k), "cases", c("cnt"))))
    # A table without rows has no grouping set at all; zeros change no other sum.
    zeros = [row("total", none, metric, F.lit(0)) for metric in ("cases", "unique_utilities")]
    zeros += [row(section, none, metric, none if section == "dates" else F.lit(0)) for section, metric in of_all]
    found = grouped.select(F.inline(rows)).unionByName(cases.sparkSession.range(1).select(F.inline(F.array(*zeros))))
    return found.groupBy("section", "key", "metric").agg(F.sum("value").alias("value"))


def store_statistics(cases: DataFrame, documents: DataFrame, operations: DataFrame, links: DataFrame, emissions: DataFrame,
                     capacity: DataFrame, impacts: DataFrame) -> DataFrame:
    """Statistics of all tables, each read once, in the form of `case_statistics`."""
    counted = {
        "documents": (documents, None), "utility_operations": (operations, "unique_eia_utilities"),
        "eia_links": (links, "linked_utilities"), "emissions_records": (emissions, None),
        "capacity_records": (capacity, None), "impact_records": (impacts, None),
    }
    out = case_statistics(cases)
    for name, (df, distinct) in counted.items():
        section = "documents" if name == "documents" else "enrichment"
        found = df.agg(F.count("*").alias("n"), (F.count_distinct("eia_utility_id") if distinct else F.lit(0)).alias("ids"))
        metrics = [F.struct(F.lit(name).alias("metric"), c("n").cast("double").alias("value"))]
        if distinct:
            metrics.append(F.struct(F.lit(distinct).alias("metric"), c("ids").cast("double").alias("value")))
        out = out.unionByName(found.select(F.inline(F.array(*metrics))).select(
            F.lit(section).alias("section"), F.lit(None).cast("string").alias("key"), "metric", "value"))
    return out


# --- overview, utilities, states -----------------------------------------------------

def kpi_overview(cases: DataFrame) -> DataFrame:
    return cases.agg(
        F.count("*").alias("total_cases"),
        F.count_distinct("state").alias("states"),
        F.count_if(c("status") == "active").alias("active"),
        F.count_if(c("status") == "decided").alias("decided"),
        F.count_distinct(display_name()).alias("utilities"),
    )


def counts_by(cases: DataFrame, key: str) -> DataFrame:
    """Cases per known value of a column."""
    return _count_by(cases.filter(c(key).isNotNull()), key)


def utility_summary(cases: DataFrame) -> DataFrame:
    named = cases.withColumn("display_name", display_name()).filter(c("display_name").isNotNull())
    return named.groupBy("display_name").agg(
        F.count("docket_number").alias("total_cases"),
        F.round(_or_zero(F.sum("requested_revenue_change")), 6).alias("total_requested"),
        F.round(_or_zero(F.sum("approved_revenue_change")), 6).alias("total_approved"),
        F.round(F.avg("return_on_equity"), 6).alias("avg_roe"),
        F.array_join(F.sort_array(F.collect_set("state")), ", ").alias("states"),
    )


def approval_rows(cases: DataFrame) -> DataFrame:
    """Cases with an approval percentage: both amounts known, request not zero."""
    pct = approval_pct(c("approved_revenue_change"), c("requested_revenue_change"))
    return cases.filter(
        c("approved_revenue_change").isNotNull() & (c("requested_revenue_change") != 0)
    ).withColumn("display_name", display_name()).withColumn("approval_pct", pct)


def approval_by_utility(cases: DataFrame) -> DataFrame:
    return approval_rows(cases).groupBy("display_name").agg(
        F.round(F.avg("approval_pct"), 6).alias("approval_pct")
    )


def avg_change_by_state(cases: DataFrame) -> DataFrame:
    """Averages over exact decimals, so that they do not depend on the order of the rows."""
    def average(amount: str) -> Column:
        return F.round(F.avg(c(amount).cast("decimal(28,6)")), 6).cast("double")

    return cases.filter(
        c("requested_revenue_change").isNotNull() & c("state").isNotNull()
    ).groupBy("state").agg(
        average("requested_revenue_change").alias("avg_requested"),
        average("approved_revenue_change").alias("avg_approved"),
    )


def state_rollup(cases: DataFrame) -> DataFrame:
    return cases.filter(c("state").isNotNull()).groupBy("state").agg(
        F.count("docket_number").alias("case_count"),
        F.round(_or_zero(F.sum("requested_revenue_change")), 6).alias("total_requested"),
        F.round(_or_zero(F.sum("approved_revenue_change")), 6).alias("total_approved"),
        F.round(F.avg("return_on_equity"), 6).alias("avg_roe"),
    )


# --- enrichment reports ------------------------------------------------------------------

def ops_kpis(ops: DataFrame) -> DataFrame:
    per_utility = ops.groupBy("eia_utility_id").agg(
        F.max("total_customers").alias("customers"), F.max("total_revenue").alias("revenue"),
        F.sum("residential_avg_price").alias("price_sum"),
        F.count("residential_avg_price").alias("price_n"),
    )
    return per_utility.agg(
        F.count("eia_utility_id").alias("utilities"),
        F.coalesce(F.sum("customers"), F.lit(0)).alias("total_customers"),
        F.round(_or_zero(F.sum("revenue")), 4).alias("total_revenue"),
        F.round(F.try_divide(F.sum("price_sum"), F.sum("price_n")), 6).alias("avg_price"),
    )


def newest_per_utility(ops: DataFrame) -> DataFrame:
    """One row per utility, of its latest year."""
    return last_per_key(ops, ["eia_utility_id"], "year", "seq")


def ownership_counts(ops: DataFrame) -> DataFrame:
    return counts_by(newest_per_utility(ops), "ownership_type")


def _mean_by_state_top(df: DataFrame, value: str, name: str, k: int) -> DataFrame:
    return (
        df.filter(c(value).isNotNull() & c("state").isNotNull())
        .groupBy("state").agg(F.round(F.avg(value), 6).alias(name))
        .orderBy(c(name).desc(), "state").limit(k)
    )


def price_by_state_top20(ops: DataFrame, k: int = 20) -> DataFrame:
    return _mean_by_state_top(ops, "residential_avg_price", "avg_price", k)


def co2_by_state_top20(emissions: DataFrame, k: int = 20) -> DataFrame:
    return _mean_by_state_top(emissions, "co2_rate_lbs_mwh", "avg_rate", k)


def impact_kpis(impacts: DataFrame) -> DataFrame:
    return impacts.agg(
        F.count("*").alias("cases"),
        F.round(F.avg("monthly_bill_impact"), 6).alias("avg_monthly"),
        F.max("monthly_bill_impact").alias("max_monthly"),
    )


def emissions_kpis(emissions: DataFrame) -> DataFrame:
    return emissions.agg(
        F.round(_or_zero(F.sum("co2_tons")), 4).alias("total_co2"),
        F.round(F.avg("co2_rate_lbs_mwh"), 6).alias("avg_rate"),
        F.round(_or_zero(F.sum("net_generation_mwh")), 4).alias("total_generation"),
    )


MIX_COLUMNS = [f"{f}_pct" for f in FUELS[:6]] + ["other_renewable_pct"]


def generation_mix(emissions: DataFrame) -> DataFrame:
    """Mean share of each source of generation, those above zero only."""
    means = emissions.agg(*[F.round(F.avg(x), 6).alias(x) for x in MIX_COLUMNS])
    long = means.unpivot([], MIX_COLUMNS, "fuel", "pct").filter(c("pct") > 0)
    return long.select(title_case(F.replace("fuel", F.lit("_pct"), F.lit(""))).alias("fuel"), "pct")


def capacity_kpis(capacity: DataFrame) -> DataFrame:
    return capacity.agg(
        F.round(_or_zero(F.sum("total_capacity_mw")), 4).alias("total_mw"),
        F.round(F.avg("avg_generator_age"), 6).alias("avg_age"),
        F.coalesce(F.sum("num_generators"), F.lit(0)).alias("generators"),
    )


def capacity_mix(capacity: DataFrame) -> DataFrame:
    columns = [f"{f}_capacity_mw" for f in FUELS]
    sums = capacity.agg(*[F.round(_or_zero(F.sum(x)), 4).alias(x) for x in columns])
    long = sums.unpivot([], columns, "fuel", "mw").filter(c("mw") > 0)
    name = title_case(F.replace("fuel", F.lit("_capacity_mw"), F.lit("")))
    return long.select(name.alias("fuel"), "mw")


def additions_vs_retirements(capacity: DataFrame) -> DataFrame:
    sums = capacity.agg(
        F.round(_or_zero(F.sum("planned_additions_mw")), 4).alias("Planned Additions"),
        F.round(_or_zero(F.sum("planned_retirements_mw")), 4).alias("Planned Retirements"),
    )
    return sums.unpivot([], ["Planned Additions", "Planned Retirements"], "category", "mw")


# --- time lines ------------------------------------------------------------------------

def filings_by_year_state(cases: DataFrame) -> DataFrame:
    dated = cases.filter(c("filing_date").isNotNull() & c("state").isNotNull())
    return dated.groupBy(F.year("filing_date").alias("year"), "state").agg(
        F.count("*").alias("cnt")
    )


def filings_by_month(cases: DataFrame) -> DataFrame:
    months = cases.filter(c("filing_date").isNotNull()).groupBy(
        F.month("filing_date").alias("month")
    ).agg(F.count("*").alias("cnt"))
    return months.select("month", month_label(c("month")).alias("label"), "cnt")


def durations(cases: DataFrame) -> DataFrame:
    """Cases with both dates and their length in days."""
    days = duration_days(c("filing_date"), c("decision_date"))
    return cases.withColumn("duration_days", days).filter(c("duration_days").isNotNull())


def duration_by_state(cases: DataFrame) -> DataFrame:
    return durations(cases).filter(c("state").isNotNull()).groupBy("state").agg(
        F.round(F.avg("duration_days"), 6).alias("avg_days")
    )


# --- histograms ---------------------------------------------------------------------------

def _bin(low: Column, high: Column, bins: int) -> Column:
    width = (high - low) / bins
    inside = F.floor(F.try_divide(c("v") - low, width)).cast("int") + 1
    return F.when(width > 0, F.least(inside, F.lit(bins))).otherwise(F.lit(1))


def score_histogram(df: DataFrame, score: str, bins: int) -> DataFrame:
    """As `histogram`, of a score from 0 to 1 with three decimals, in one pass.

    Rows are counted by score, 1,001 counts at most; these are then binned between the least and the greatest.
    """
    counts = df.filter(c(score).isNotNull()).groupBy(c(score).cast("double").alias("v")).agg(F.count("*").alias("cnt"))
    all_of = Window.partitionBy()
    limited = counts.withColumns({"low": F.min("v").over(all_of), "high": F.max("v").over(all_of)})
    return limited.groupBy(_bin(c("low"), c("high"), bins).alias("bin")).agg(F.sum("cnt").alias("cnt"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in equal-width bins between the least and the greatest value.

    The limits are a plain aggregate, one scalar subquery; rows are then binned and counted.  Both
    are reduced to a row or a bin a task before anything is shuffled.  Bins count from 1; empty
    ones are left out.
    """
    values = df.filter(c(value).isNotNull()).select(c(value).cast("double").alias("v"))
    limits = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    spanned = values.withColumn("span", limits)
    return spanned.groupBy(_bin(c("span.low"), c("span.high"), bins).alias("bin")).agg(F.count("*").alias("cnt"))


# --- top lists ------------------------------------------------------------------------------

def top_requests(cases: DataFrame, k: int = 15) -> DataFrame:
    asked = c("requested_revenue_change")
    return cases.filter(F.coalesce(asked, F.lit(0.0)) != 0).orderBy(
        F.abs(asked).desc(), "docket_number", "source"
    ).limit(k)


def top_utilities_by_cases(cases: DataFrame, k: int = 15) -> DataFrame:
    return utility_summary(cases).orderBy(c("total_cases").desc(), "display_name").limit(k)


def top_approval(cases: DataFrame, k: int = 15) -> DataFrame:
    return approval_by_utility(cases).orderBy(c("approval_pct").desc(), "display_name").limit(k)


def top_customers(ops: DataFrame, k: int = 15) -> DataFrame:
    return latest_year_slice(ops).filter(c("total_customers").isNotNull()).orderBy(
        c("total_customers").desc(), "eia_utility_id"
    ).limit(k)


def top_impacts(impacts: DataFrame, k: int = 15) -> DataFrame:
    return impacts.orderBy(c("monthly_bill_impact").desc(), "docket_number", "source").limit(k)


def top_emitters(emissions: DataFrame, k: int = 15) -> DataFrame:
    return emissions.filter(c("co2_tons").isNotNull()).orderBy(
        c("co2_tons").desc(), "utility_name_egrid", "year"
    ).limit(k)


def top_capacity(capacity: DataFrame, k: int = 15) -> DataFrame:
    return capacity.filter(c("total_capacity_mw").isNotNull()).orderBy(
        c("total_capacity_mw").desc(), "eia_utility_id"
    ).limit(k)
