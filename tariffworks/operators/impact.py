"""Consumer bill impact of approved rate changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffworks.fixed_values import AVERAGE_MONTHLY_KWH
from tariffworks.operators.firstwins import latest_operations


def bill_impact(approved: Column, customers: Column, price: Column, kwh: float
                ) -> dict[str, Column]:
    """Yearly and monthly impact in dollars and as a share of the average bill."""
    annual = approved * 1_000_000 / customers
    monthly = annual / 12
    bill = price / 100 * kwh
    return {
        "monthly_bill_impact": F.round(monthly, 2),
        "annual_bill_impact": F.round(annual, 2),
        "pct_of_avg_bill": F.when((price > 0) & (bill > 0), F.round(monthly / bill * 100, 2)),
    }


def impact_join(cases: DataFrame, links: DataFrame, operations: DataFrame) -> DataFrame:
    """Cases with an approved change, their linked id and the latest year of that id.

    Links are looked up by name alone, whatever the state; the last link of a
    name wins.  Cases are the large side and keep their place; links and
    operations are reduced to one row per key first.
    """
    approved = F.coalesce(F.col("approved_revenue_change"), F.lit(0.0)) != 0
    name = F.coalesce(F.nullif("canonical_utility_name", F.lit("")), F.col("utility_name"))
    by_name = links.groupBy(F.lower("utility_name").alias("name_key")).agg(
        F.max_by("eia_utility_id", "seq").alias("eia_utility_id")
    )
    latest = latest_operations(operations).select(
        "eia_utility_id", "total_customers", "residential_avg_price"
    )
    return (
        cases.filter(approved)
        .withColumn("name_key", F.lower(name))
        .join(by_name, "name_key")
        .join(latest, "eia_utility_id")
        .drop("name_key")
    )


def rate_case_impacts(cases: DataFrame, links: DataFrame, operations: DataFrame,
                      kwh: float = AVERAGE_MONTHLY_KWH) -> DataFrame:
    """One row per case whose organisation has customers in its latest year."""
    joined = impact_join(cases, links, operations).filter(F.col("total_customers") > 0)
    measures = bill_impact(
        F.col("approved_revenue_change"), F.col("total_customers"),
        F.col("residential_avg_price"), kwh,
    )
    return joined.select(
        "docket_number", "source", "eia_utility_id", "total_customers",
        *[m.alias(name) for name, m in measures.items()],
        F.col("residential_avg_price").alias("residential_price_before"),
        F.lit(None).cast("double").alias("residential_price_after"),
    )
