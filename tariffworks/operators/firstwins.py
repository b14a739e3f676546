"""One row per key: the first, the last or the best one.

Every operator names the column that decides the order.  Whole rows are ranked
within their key and cut off at the first rank, which Spark does in each task
before the shuffle as well as behind it; single values are aggregated.  Either
way a key that holds a third of the table sends one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return ranked.filter(F.col("__rank") == 1).select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The row that comes first by ``order``; null keys are a key."""
    return _pick(df, keys, F.struct(*order).asc())


def last_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The row that comes last by ``order``; null keys are a key."""
    return _pick(df, keys, F.struct(*order).desc())


def latest_year_slice(df: DataFrame, year: str = "year") -> DataFrame:
    """Rows of the latest year in the table."""
    latest = df.agg(F.max(year).alias("latest"))
    return df.filter(F.col(year) == latest.scalar())


def latest_operations(ops: DataFrame) -> DataFrame:
    """Latest year of each utility; of equal years the later row."""
    return last_per_key(
        ops.filter(F.coalesce(F.col("eia_utility_id"), F.lit(0)) != 0),
        ["eia_utility_id"],
        F.coalesce("year", F.lit(0)),
        "seq",
    )


def dedupe_eia(ops: DataFrame) -> DataFrame:
    """First row per (utility id, state), states compared in upper case."""
    usable = ops.filter(
        (F.coalesce(F.col("eia_utility_id"), F.lit(0)) != 0)
        & (F.coalesce(F.col("utility_name"), F.lit("")) != "")
    )
    upper = usable.withColumn("state", F.trim(F.upper(F.coalesce("state", F.lit("")))))
    return first_per_key(upper, ["eia_utility_id", "state"], "seq")


def longest_context(refs: DataFrame) -> DataFrame:
    """Longest context of each docket; of equal lengths the earlier one."""
    return refs.groupBy("docket_number").agg(
        F.max_by("context", F.struct(F.length("context"), -F.col("seq"))).alias("context")
    )


def docket_labels(cases: DataFrame) -> DataFrame:
    """``docket - name`` with the name of the newest case of the docket."""
    newest_first = F.struct(
        F.col("filing_date").isNull(), -F.unix_date("filing_date"), F.col("source")
    )
    return cases.groupBy("docket_number").agg(
        F.concat_ws(" - ", "docket_number", F.min_by("display_name", newest_first)).alias("label")
    )


def first_utility_rows(cases: DataFrame, resolved: DataFrame) -> DataFrame:
    """For each canonical name the first case that carries it, newest filing first.

    ``resolved`` maps raw names to canonical names and their attributes.
    """
    newest_first = F.struct(
        F.col("filing_date").isNull().alias("no_date"),
        (-F.unix_date("filing_date")).alias("age"),
        F.col("docket_number"),
        F.col("source"),
    )
    first_raw = cases.groupBy("utility_name").agg(
        F.min(newest_first).alias("first_seen"), F.min_by("state", newest_first).alias("state")
    )
    named = first_raw.join(resolved.drop("state"), "utility_name").withColumn(
        "name", F.coalesce("canonical_name", "utility_name")
    )
    return named.groupBy("name").agg(
        *[
            F.min_by(x, "first_seen").alias(x)
            for x in ["state", "utility_type", "parent_company"]
        ]
    )
