"""Writers: stored tables and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffworks import fixed_values as V
from tariffworks.functions.html import unescape

PARTITIONS = {
    "rate_cases": ["state"], "utilities": ["state"], "utility_operations": ["year"],
    "utility_emissions": ["year"], "utility_capacity": ["year"],
}


def unescape_all_strings(df: DataFrame) -> DataFrame:
    """Character references decoded in every string column."""
    return df.select(*[
        unescape(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def write_table(df: DataFrame, root: str, table: str, version: int) -> str:
    """Write one version of a table and return its path.

    A version is complete when its folder holds ``_SUCCESS``; readers keep the
    version they have until they are told of the next, so a failed write is
    never seen.  ``rebalance`` lets adaptive execution split a partition value
    that holds most rows and join small ones, instead of one file per task and
    value.
    """
    path = f"{root}/{table}/version={version}"
    partitions = PARTITIONS.get(table)
    if partitions:
        df.hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def cases_csv(cases: DataFrame) -> DataFrame:
    """The twenty exported columns in order."""
    return unescape_all_strings(cases).select(*V.CASE_EXPORT_COLUMNS)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def enrichment_csv(df: DataFrame) -> DataFrame:
    return df.drop("created_at")


def json_metadata(cases: DataFrame, utilities: DataFrame) -> DataFrame:
    """One row that describes a JSON export."""
    units = F.create_map(*[F.lit(x) for pair in V.DATA_UNITS.items() for x in pair])
    n_utilities = utilities.agg(F.count("*").alias("n"))
    return cases.agg(F.count("*").alias("total_records")).select(
        F.current_timestamp().alias("exported_at"), "total_records",
        n_utilities.scalar().alias("total_utilities"), F.lit("1.1").alias("format_version"),
        units.alias("data_units"),
    )


def report_cells(cases: DataFrame) -> DataFrame:
    """Seventeen columns of the case sheet; the raw name stands in for a missing canonical one."""
    name = F.coalesce(F.nullif("canonical_utility_name", F.lit("")), F.col("utility_name"))
    return cases.withColumn("canonical_utility_name", name).select(
        *[F.col(column).alias(title) for title, column in V.REPORT_CASE_COLUMNS]
    )


def utility_cells(utilities: DataFrame) -> DataFrame:
    return utilities.select(*[F.col(x).alias(title) for title, x in V.REPORT_UTILITY_COLUMNS])
