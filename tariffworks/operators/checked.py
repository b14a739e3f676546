"""Rows checked against the schema of their table, kept with the reasons and written once.

A checked row is in its stored form (trimmed, upper-case state, rounded amounts) and has an array of
reasons against it.  Accepted and rejected rows are parts of one table, so that a batch is checked and
written in one pass, and rejects can be read, mended and checked again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffworks.functions import scores

#: Checks of a row, and the stored form of its columns.
RULES: dict[str, tuple[Callable[[], Column], Callable[[list[str]], list[Column]]]] = {
    "rate_cases": (scores.schema_check_case, scores.normalised_case),
    "utilities": (scores.schema_check_utility, scores.normalised_utility),
    "case_documents": (scores.schema_check_document, scores.normalised_document),
}


def checked(rows: DataFrame, table: str) -> DataFrame:
    """The rows with `reasons`; accepted rows in their stored form, the others as they came."""
    check, normalised = RULES[table]
    known = rows.withColumn("reasons", check())
    accepted = F.size("reasons") == 0
    stored = {name: F.when(accepted, value).otherwise(F.col(name))
              for name, value in zip(rows.columns, normalised(rows.columns), strict=True)}
    return known.withColumns({"accepted": accepted}).select(*[v.alias(n) for n, v in stored.items()], "reasons", "accepted")


def write_checked(rows: DataFrame, table: str, path: str) -> None:
    """Check the rows and write both parts in one pass."""
    checked(rows, table).write.mode("append").partitionBy("accepted").parquet(path)


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("accepted").cast("boolean")).drop("accepted", "reasons")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(~F.col("accepted").cast("boolean")).drop("accepted")
