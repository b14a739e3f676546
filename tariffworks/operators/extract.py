"""Raw records to rate cases, in one projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions import rules, text
from tariffworks.functions.columns import strip

REQUIRED = ["docket_number", "utility_name", "state", "source"]


def _trimmed(raw: DataFrame) -> DataFrame:
    clean = {x: strip(F.coalesce(x, F.lit(""))) for x in REQUIRED}
    clean["state"] = F.upper(clean["state"])
    return raw.withColumns(clean)


def _complete() -> Column:
    return reduce(lambda a, b: a & b, [F.col(x) != "" for x in REQUIRED])


def reject_incomplete(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with all required fields (trimmed, upper-case state), and the others."""
    trimmed = _trimmed(raw)
    return trimmed.filter(_complete()), trimmed.filter(~_complete())


def _explicit_or(value: Column, allowed: list[str], derived: Column) -> Column:
    """The given value if it is a known one other than 'unknown', else the derived one."""
    known = [x for x in allowed if x != "unknown"]
    return F.when(value.isin(known), value).otherwise(derived)


def parse_record(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cases, rejects): explicit fields win, the description fills the gaps.

    An amount in the description without a recognisable context is the last
    resort for the requested change only.
    """
    complete, rejects = reject_incomplete(raw)
    about = F.coalesce("description", F.lit(""))
    docket = F.col("docket_number")
    number = {
        x: text.field_float(F.col(x))
        for x in ["requested_revenue_change", "approved_revenue_change", "rate_base",
                  "return_on_equity", "requested_rate_change_pct", "approved_rate_change_pct"]
    }
    cases = complete.select(
        *REQUIRED[:2], "state", "source",
        _explicit_or(
            F.col("case_type"), V.CASE_TYPES, rules.classify_case_type(about, docket)
        ).alias("case_type"),
        _explicit_or(
            F.col("utility_type"), V.UTILITY_TYPES, rules.classify_utility_type(about, docket)
        ).alias("utility_type"),
        F.when(F.coalesce("status", F.lit("")) != "unknown", rules.normalise_status(F.col("status")))
        .otherwise("unknown").alias("status"),
        *[text.field_date(F.col(x)).alias(x)
          for x in ["filing_date", "decision_date", "effective_date"]],
        F.coalesce(
            number["requested_revenue_change"], text.revenue_request(about),
            text.extract_dollar(about),
        ).alias("requested_revenue_change"),
        F.coalesce(number["approved_revenue_change"], text.revenue_approved(about))
        .alias("approved_revenue_change"),
        F.coalesce(number["rate_base"], text.extract_rate_base(about)).alias("rate_base"),
        F.coalesce(number["return_on_equity"], text.extract_roe(about)).alias("return_on_equity"),
        number["requested_rate_change_pct"].alias("requested_rate_change_pct"),
        number["approved_rate_change_pct"].alias("approved_rate_change_pct"),
        "source_url",
        F.nullif("description", F.lit("")).alias("description"),
        "scraped_at",
        *[x for x in raw.columns if x == "seq"],
    )
    return cases, rejects
