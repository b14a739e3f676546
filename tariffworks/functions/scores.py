"""Quality scores, validation rules and schema checks as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions.columns import strip

c = F.col


def _present(column: Column) -> Column:
    return F.coalesce(column != "", F.lit(False))


def _credit(condition: Column, value: float = 1.0) -> Column:
    return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))


def _flag(flag: Column | None) -> Column:
    return F.lit(0.0) if flag is None else _credit(F.coalesce(flag, F.lit(False)))


def quality_components(
    has_eia_link: Column | None = None,
    has_emissions: Column | None = None,
    has_impact: Column | None = None,
) -> dict[str, Column]:
    """Credit from 0 to 1 for each component of the score of a rate case."""
    open_case = F.coalesce(c("status").isin("active", "filed"), F.lit(False))
    return {
        "has_docket_number": _credit(_present(c("docket_number"))),
        "has_utility_name_resolved": F.when(_present(c("canonical_utility_name")), F.lit(1.0))
        .when(_present(c("utility_name")), F.lit(V.RAW_NAME_CREDIT))
        .otherwise(F.lit(0.0)),
        "has_case_type_classified": _credit(
            _present(c("case_type")) & (c("case_type") != "unknown")
        ),
        "has_filing_date": _credit(c("filing_date").isNotNull()),
        "has_decision_date": F.when(c("decision_date").isNotNull(), F.lit(1.0))
        .when(open_case, F.lit(V.OPEN_CASE_CREDIT))
        .otherwise(F.lit(0.0)),
        "has_revenue_request_amount": _credit(c("requested_revenue_change").isNotNull()),
        "has_revenue_approved_amount": _credit(c("approved_revenue_change").isNotNull()),
        "has_case_status": _credit(_present(c("status")) & (c("status") != "unknown")),
        "has_source_url": _credit(_present(c("source_url"))),
        "has_eia_data_linked": _flag(has_eia_link),
        "has_emissions_data": _flag(has_emissions),
        "has_customer_impact": _flag(has_impact),
    }


def quality_score(components: dict[str, Column], weights=V.QUALITY_WEIGHTS) -> Column:
    total = reduce(lambda a, b: a + b, [components[k] * w for k, w in weights.items()])
    return F.round(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)), 3)


def _messages(pairs: list[tuple[Column, Column | str]]) -> Column:
    """Array of the messages whose condition holds."""
    return F.array_compact(
        F.array(*[F.when(cond, m if isinstance(m, Column) else F.lit(m)) for cond, m in pairs])
    )


def quality_issues() -> Column:
    """Messages for the parts a rate case lacks."""
    k = quality_components()
    return _messages([
        (k["has_docket_number"] == 0, "Missing docket number"),
        (k["has_utility_name_resolved"] == 0, "Missing utility name"),
        (k["has_case_type_classified"] == 0, "Case type not classified"),
        (k["has_filing_date"] == 0, "Missing filing date"),
        (k["has_decision_date"] == 0, "Missing decision date"),
        (k["has_revenue_request_amount"] == 0, "No revenue request amount"),
        (k["has_revenue_approved_amount"] == 0, "No revenue approved amount"),
        (k["has_case_status"] == 0, "Missing or unknown case status"),
    ])


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _out_of_years(date: Column) -> Column:
    return ~F.year(date).between(V.MIN_YEAR, V.MAX_YEAR)


def validate_case() -> Column:
    """Messages for the values of a rate case that cannot be right."""
    filing, decision = c("filing_date"), c("decision_date")
    asked, given = c("requested_revenue_change"), c("approved_revenue_change")
    roe, base, state = c("return_on_equity"), c("rate_base"), c("state")
    years = f"({V.MIN_YEAR}-{V.MAX_YEAR})"
    large = "M seems unreasonably large"
    return _messages([
        (~_present(c("docket_number")), "Missing docket_number"),
        (~_present(c("utility_name")), "Missing utility_name"),
        (~_present(state), "Missing state"),
        (~_present(c("source")), "Missing source"),
        (_out_of_years(filing), _text("Filing date ", filing, " outside valid range ", years)),
        (_out_of_years(decision), _text("Decision date ", decision, " outside valid range ", years)),
        (decision < filing,
         _text("Decision date (", decision, ") before filing date (", filing, ")")),
        (F.abs(asked) > V.MAX_AMOUNT, _text("Requested revenue $", asked, large)),
        (F.abs(given) > V.MAX_AMOUNT, _text("Approved revenue $", given, large)),
        (F.abs(given) > F.abs(asked) * V.APPROVED_TO_REQUESTED_LIMIT,
         _text("Approved $", given, "M significantly exceeds requested $", asked, "M")),
        ((roe < 0) | (roe > V.MAX_ROE), _text("ROE ", roe, "% outside reasonable range (0-25%)")),
        (base < 0, _text("Rate base $", base, "M is negative")),
        (base > V.MAX_RATE_BASE, _text("Rate base $", base, large)),
        (_present(state) & (F.length(state) != 2),
         _text("State code '", state, "' should be 2 characters")),
    ])


# --- completeness of reference data ------------------------------------------

def _nonzero(column: str) -> Column:
    return F.coalesce(c(column) != 0, F.lit(False))


def _sum_credits(pairs: list[tuple[Column, float]]) -> Column:
    return F.round(reduce(lambda a, b: a + b, [_credit(cond, w) for cond, w in pairs]), 3)


def score_operations() -> Column:
    return _sum_credits([
        (_nonzero("eia_utility_id"), 0.15), (_present(c("utility_name")), 0.10),
        (_present(c("state")), 0.10), (_nonzero("total_customers"), 0.20),
        (_nonzero("total_revenue"), 0.15), (_nonzero("total_sales_mwh"), 0.10),
        (_nonzero("residential_avg_price"), 0.10), (_present(c("ownership_type")), 0.10),
    ])


def score_emissions() -> Column:
    return _sum_credits([
        (_present(c("utility_name_egrid")), 0.15), (_present(c("state")), 0.10),
        (_nonzero("net_generation_mwh"), 0.15), (_nonzero("co2_tons"), 0.15),
        (_nonzero("co2_rate_lbs_mwh"), 0.15), (c("coal_pct").isNotNull(), 0.10),
        (c("gas_pct").isNotNull(), 0.10), (_nonzero("eia_utility_id"), 0.10),
    ])


def score_capacity() -> Column:
    some_fuel = F.coalesce(*[c(f"{f}_capacity_mw") for f in V.FUELS[:6]]).isNotNull()
    planned = F.coalesce(c("planned_additions_mw"), c("planned_retirements_mw")).isNotNull()
    return _sum_credits([
        (_nonzero("eia_utility_id"), 0.15), (_nonzero("total_capacity_mw"), 0.20),
        (_nonzero("num_generators"), 0.15), (_nonzero("num_plants"), 0.10),
        (_nonzero("avg_generator_age"), 0.15), (some_fuel, 0.15), (planned, 0.10),
    ])


def revenue_per_customer(revenue_thousands: Column, customers: Column) -> Column:
    usable = (revenue_thousands != 0) & (customers > 0)
    return F.when(usable, F.round(revenue_thousands * 1000 / customers, 2))


# --- schema checks: reasons for rejection, empty when a row is accepted --------

def _length_outside(column: str, low: int, high: int) -> Column:
    return F.coalesce(~F.length(c(column)).between(low, high), F.lit(low > 0))


def _not_in(column: str, allowed: list[str]) -> Column:
    return ~c(column).isin(allowed)


def _bad_state() -> Column:
    return ~strip(F.upper(c("state"))).isin(V.STATE_CODES)


def schema_check_case() -> Column:
    dates = ["filing_date", "decision_date", "effective_date"]
    amounts = ["requested_revenue_change", "approved_revenue_change", "rate_base"]
    return _messages(
        [
            (_length_outside("docket_number", 1, 100), "docket_number length"),
            (_length_outside("utility_name", 1, 500), "utility_name length"),
            (F.coalesce(_bad_state(), F.lit(True)), "state code"),
            (c("source").isNull(), "source missing"),
            (_not_in("case_type", V.CASE_TYPES), "case_type value"),
            (_not_in("utility_type", V.UTILITY_TYPES), "utility_type value"),
            (_not_in("status", V.CASE_STATUSES), "status value"),
        ]
        + [(_out_of_years(c(d)), f"{d} range") for d in dates]
        + [(F.abs(c(a)) > V.MAX_AMOUNT, f"{a} range") for a in amounts]
        + [
            (~c("return_on_equity").between(0, V.MAX_ROE), "return_on_equity range"),
            (F.length(c("description")) > 5000, "description length"),
            (~c("quality_score").between(0, 1), "quality_score range"),
            (c("decision_date") < c("filing_date"), "decision before filing"),
        ]
    )


def schema_check_utility() -> Column:
    return _messages([
        (_length_outside("name", 1, 500), "name length"),
        (_bad_state() | (F.length(c("state")) != 2), "state code"),
        (_not_in("utility_type", V.UTILITY_TYPES), "utility_type value"),
        (_not_in("ownership_type", V.OWNERSHIP_TYPES), "ownership_type value"),
        (c("customer_count") < 0, "customer_count negative"),
    ])


def schema_check_document() -> Column:
    url = strip(c("url"))
    return _messages([
        (_length_outside("docket_number", 1, 100), "docket_number length"),
        (_not_in("document_type", V.DOCUMENT_TYPES), "document_type value"),
        (F.length(c("title")) > 1000, "title length"),
        (F.length(c("filed_by")) > 500, "filed_by length"),
        (_out_of_years(c("filing_date")), "filing_date range"),
        ((url != "") & ~url.rlike("^https?://"), "url scheme"),
        (c("source").isNull(), "source missing"),
        (_length_outside("state", 2, 2), "state length"),
    ])


def schema_check_run() -> Column:
    counters = ["records_processed", "records_created", "records_updated", "errors"]
    return _messages(
        [(c(x).isNull(), f"{x} missing") for x in ["source", "stage", "status"]]
        + [(c(x) < 0, f"{x} negative") for x in counters]
    )


def normalised_case(columns: list[str]) -> list[Column]:
    """Accepted rate cases as stored: trimmed, upper-case state, rounded amounts."""
    change = {
        "docket_number": strip(c("docket_number")),
        "utility_name": strip(c("utility_name")),
        "state": strip(F.upper(c("state"))),
        "requested_revenue_change": F.round(c("requested_revenue_change"), 3),
        "approved_revenue_change": F.round(c("approved_revenue_change"), 3),
        "rate_base": F.round(c("rate_base"), 3),
        "return_on_equity": F.round(c("return_on_equity"), 2),
    }
    return [change.get(x, c(x)).alias(x) for x in columns]


def normalised_utility(columns: list[str]) -> list[Column]:
    """Accepted utilities as stored: trimmed name, upper-case state."""
    change = {"name": strip(c("name")), "state": strip(F.upper(c("state")))}
    return [change.get(x, c(x)).alias(x) for x in columns]


def normalised_document(columns: list[str]) -> list[Column]:
    """Accepted documents as stored: trimmed address, upper-case state."""
    change = {"url": strip(c("url")), "state": strip(F.upper(c("state")))}
    return [change.get(x, c(x)).alias(x) for x in columns]
