"""Docket numbers: dates hidden in them, spelling, links, petitioners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions.columns import found, strip
from tariffworks.functions.text import parse_date, safe_date


def _pivot_50(yy: Column) -> Column:
    yy = yy.try_cast("int")
    return F.when(yy < 50, yy + 2000).otherwise(yy + 1900)


def docket_year(docket: Column) -> Column:
    """Year in ``YY-...`` (up to 49 is 20xx), ``XX-YYYY-N`` or ``A.YY-MM-NNN`` dockets."""
    short = found(docket, r"^(\d{2})-")
    return F.coalesce(
        _pivot_50(short),
        found(docket, r"-(\d{4})-").try_cast("int"),
        found(docket, r"^A\.(\d{2})-\d{2}-\d{3}").try_cast("int") + 2000,
    )


def title_year(title: Column) -> Column:
    """First year from 1900 to 2099 standing alone in a title."""
    return found(title, r"\b(19\d{2}|20\d{2})\b").try_cast("int")


def docket_date(docket: Column) -> Column:
    """First day of the month a docket number names, or null for an invalid month."""
    ct = r"^(\d{2})-(\d{2})-(\d{2})"
    ca = r"^A\.(\d{2})-(\d{2})-\d{3}"
    return F.coalesce(
        safe_date(_pivot_50(found(docket, ct)), found(docket, ct, 2), F.lit(1)),
        safe_date(found(docket, ca).try_cast("int") + 2000, found(docket, ca, 2), F.lit(1)),
    )


def free_year(text: Column) -> Column:
    """Year of a date, else the first four digits."""
    return F.coalesce(F.year(parse_date(text)), found(text, r"(\d{4})").try_cast("int"))


def docket_normalise(docket: Column) -> Column:
    """One blank between prefix and number; file and amendment marks removed."""
    spaced = F.regexp_replace(docket, r"(U[EGMCW])\s*(\d+)", "$1 $2")
    no_file = strip(F.regexp_replace(spaced, r"\[PDF\]", ""))
    return strip(F.regexp_replace(no_file, r"[A-Z]{2}\d{2}$", ""))


def strip_retention(name: Column) -> Column:
    return strip(F.regexp_replace(name, r"\s*-\s*Met Retention\s*$", ""))


def petitioner(parties: Column) -> Column:
    """First of the comma-separated parties, without its industry."""
    first = strip(F.split(F.coalesce(parties, F.lit("")), ",")[0])
    visible = strip(F.replace(first, F.lit("\u200b"), F.lit("")))
    return strip(F.regexp_replace(visible, r"^(.+) - .*$", "$1"))


def build_description(petition_type: Column, industry: Column, parties: Column) -> Column:
    """One line from the parts that are present, at most 500 characters."""
    visible = strip(F.replace(parties, F.lit("\u200b"), F.lit("")))
    line = F.concat_ws(
        " ",
        F.nullif(petition_type, F.lit("")),
        F.concat(F.lit("("), F.nullif(industry, F.lit("")), F.lit(")")),
        F.concat(F.lit("- "), F.nullif(F.substring(visible, 1, 200), F.lit(""))),
    )
    return F.nullif(F.substring(line, 1, 500), F.lit(""))


def enrich_description(style: Column, best_title: Column) -> Column:
    """Case title, with the best filing title appended if it names no amount itself."""
    text = F.when(
        (style != "") & ~style.contains("$") & best_title.isNotNull(),
        F.concat_ws(" | ", style, best_title),
    ).otherwise(style)
    return F.nullif(F.substring(text, 1, 500), F.lit(""))


def template_url(source: Column, key: Column) -> Column:
    """Public page of a docket, by source."""
    chain = None
    for name, template in V.URL_TEMPLATES.items():
        url = F.when(key != "", F.format_string(template, key))
        chain = F.when(source == name, url) if chain is None else chain.when(source == name, url)
    return chain
