"""Amounts, percentages and dates found in free text, as Spark columns.

Amounts are in millions of USD.  All functions take a string column and return
a column; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions.columns import found, lookup, squeeze, strip, title_case


# --- amounts ----------------------------------------------------------------
#
# Expressions below use their input once.  A chain that repeats its input grows
# with every step and soon exceeds what Spark can compile to one method.

def scale_amount(amount: Column, unit: Column) -> Column:
    """Bring an amount to millions by its unit; no unit means plain dollars."""
    unit = F.lower(unit)
    factor = F.when(unit.isin("billion", "b"), 1000.0).when(unit.isin("million", "m"), 1.0)
    return F.round(F.coalesce(amount * factor, amount / 1_000_000), 3)


def _amount_in(match: Column) -> Column:
    """Amount in a short piece of text that a pattern has already found.

    The unit becomes the exponent of a decimal number: "$2.8 billion" -> "2.8e3".
    """
    number = F.regexp_extract(match, rf"(?i){V.AMOUNT}\s*{V.UNIT}?", 0)
    number = F.regexp_replace(number, r"[$,\s]", "")
    number = F.regexp_replace(number, r"(?i)b(?:illion)?$", "e3")
    number = F.regexp_replace(number, r"(?i)m(?:illion)?$", "e0")
    number = F.regexp_replace(number, r"^([\d.]+)$", "$1e-6")
    return F.round(number.try_cast("double"), 3)


def _plain_amount_in(match: Column) -> Column:
    """Amount without a unit; what rounds to nothing is dropped."""
    number = F.regexp_replace(F.regexp_extract(match, V.DOLLAR_PLAIN, 1), ",", "")
    return F.nullif(F.round(number.try_cast("double") / 1_000_000, 3), F.lit(0.0))


def _sign(text: Column) -> Column:
    return F.when(text.rlike(V.DECREASE_WORDS), -1.0).otherwise(1.0)


def parse_dollar(text: Column) -> Column:
    """First amount in the text: one with a unit if there is any, else a plain one."""
    return F.coalesce(
        _amount_in(F.regexp_extract(text, V.DOLLAR_WITH_UNIT, 0)),
        _plain_amount_in(F.regexp_extract(text, V.DOLLAR_PLAIN, 0)),
    )


def extract_dollar(text: Column) -> Column:
    """As :func:`parse_dollar`, negative if the text speaks of a decrease."""
    return parse_dollar(text) * _sign(text)


def extract_all_dollars(text: Column) -> Column:
    """Array of all amounts; plain ones only if none carries a unit."""
    with_unit = F.regexp_extract_all(text, F.lit(V.DOLLAR_WITH_UNIT), F.lit(0))
    plain = F.regexp_extract_all(text, F.lit(V.DOLLAR_PLAIN), F.lit(0))
    amounts = F.when(F.size(with_unit) > 0, F.transform(with_unit, _amount_in)).otherwise(
        F.transform(plain, _plain_amount_in)
    )
    signed = F.transform(F.array_compact(amounts), lambda x: x * _sign(text))
    return F.coalesce(signed, F.array().cast("array<double>"))


def _first_amount(text: Column, patterns: list[str]) -> Column:
    return _amount_in(F.coalesce(*[found(text, p, 0) for p in patterns]))


def revenue_request(text: Column) -> Column:
    return _first_amount(text, V.REVENUE_REQUEST)


def revenue_approved(text: Column) -> Column:
    return _first_amount(text, V.REVENUE_APPROVED)


def extract_rate_base(text: Column) -> Column:
    return _first_amount(text, [V.RATE_BASE])


def extract_roe(text: Column) -> Column:
    """Return on equity in percent."""
    return F.round(found(text, V.RETURN_ON_EQUITY).try_cast("double"), 2)


def parse_percent(text: Column) -> Column:
    number = F.coalesce(found(text, V.PERCENT_SIGN), found(text, V.PERCENT_WORD))
    return F.round(number.try_cast("double"), 2)


# --- dates ------------------------------------------------------------------

def safe_date(year: Column, month: Column, day: Column) -> Column:
    """A date, or null where the parts do not make one."""
    parts = [x.cast("string") for x in (year, month, day)]
    return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2]).try_cast("date")


# Styles a date is written in, and the same as year-month-day.
_NUMERIC_STYLES = [
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/(69|[7-9]\d)$", "19$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{2})$", "20$3-$1-$2"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$1-$2"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
]
_NAMED_STYLES = [
    (r"^([A-Za-z]+) (\d{1,2}),? (\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2}) ([A-Za-z]+) (\d{4})$", "$3-$2-$1"),
] + [
    (f"(?i)-{month[:3]}(?:{month[3:]})?-", f"-{number}-")
    for number, month in enumerate(V.MONTHS, start=1)
]


def _rewritten_date(text: Column, styles: list[tuple[str, str]]) -> Column:
    t = squeeze(text)
    for style, rewritten in styles:
        t = F.regexp_replace(t, style, rewritten)
    return F.regexp_extract(t, r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$", 0).try_cast("date")


def parse_date(text: Column) -> Column:
    """Date written in any of eleven styles, or null.

    Year first, US numeric with two or four year digits (two digits from 69 up
    are in the 1900s), dashes, month names before or after the day, and eight
    digits in a row.  A style is rewritten to year-month-day, then cast; month
    names are looked at only where no numeric style fits.
    """
    return F.coalesce(
        _rewritten_date(text, _NUMERIC_STYLES), _rewritten_date(text, _NAMED_STYLES)
    )


def parse_date_state(text: Column) -> Column:
    """Date in one of the three styles used by state dockets, or null."""
    style = r"^(?:\d{1,2}/\d{1,2}/(?:\d{2}|\d{4})|\d{4}-\d{1,2}-\d{1,2})$"
    return _rewritten_date(F.regexp_extract(strip(text), style, 0), _NUMERIC_STYLES[:3])


def extract_date(text: Column) -> Column:
    """First date in the text, by the order of the styles and not by position."""
    return F.coalesce(*[parse_date(found(text, p)) for p in V.DATE_IN_TEXT])


def extract_all_dates(text: Column) -> Column:
    """Sorted array of the different dates in the text."""
    every = F.flatten(
        F.array(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in V.DATE_IN_TEXT])
    )
    dates = F.array_sort(F.array_distinct(F.array_compact(F.transform(every, parse_date))))
    return F.coalesce(dates, F.array().cast("array<date>"))


# --- fields of raw records ---------------------------------------------------

def field_float(text: Column) -> Column:
    """A number as written, else an amount in dollar text."""
    plain = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    return F.when(text.rlike(plain), strip(text).try_cast("double")).otherwise(parse_dollar(text))


def field_date(text: Column) -> Column:
    return parse_date(text)


def _cell(text: Column) -> Column:
    t = F.replace(strip(text), F.lit(","), F.lit(""))
    return F.when(~t.isin(V.NUMBER_SENTINELS), t)


def safe_float(text: Column) -> Column:
    """Number in a spreadsheet cell: thousands separators out, marks for 'no value' to null."""
    return F.round(_cell(text).try_cast("double"), 4)


def safe_int(text: Column) -> Column:
    return F.when(_cell(text).rlike(r"\d"), _cell(text).try_cast("double")).try_cast("bigint")


def safe_str(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


# --- display ------------------------------------------------------------------

def money_format(amount: Column, missing: str = "N/A") -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(amount, 1)), F.lit(missing))


def case_type_label(case_type: Column) -> Column:
    key = strip(case_type)
    return (
        F.when(F.coalesce(case_type, F.lit("")) == "", "Unknown")
        .otherwise(F.coalesce(lookup(key, V.CASE_TYPE_LABELS), title_case(key)))
    )


def approval_pct(approved: Column, requested: Column) -> Column:
    return F.try_divide(approved, requested) * 100


def duration_days(filing: Column, decision: Column) -> Column:
    return F.datediff(decision, filing)


def month_label(month: Column) -> Column:
    return F.when(
        month.between(1, 12), F.element_at(F.array(*[F.lit(m[:3]) for m in V.MONTHS]), month)
    )
