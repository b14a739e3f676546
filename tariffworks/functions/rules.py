"""Rule tables compiled to column expressions.

A rule is (label, patterns, keywords).  All patterns and keywords of a label
become one alternation, so a table of sixty patterns is a short ``CASE`` chain
and stays inside generated code.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions.columns import any_of, first_rule, first_word, lookup, strip


def _first_letters(pattern: str) -> str | None:
    """Letters a match of the pattern starts with, in lower case; None for patterns that are not plain enough to tell.

    Told for words, and for a group of words, optional or not, before other words.
    """
    group = re.match(r"\(([A-Za-z]\w+(?:\|[A-Za-z]\w+)*)(?:\\s\+)?\)(\??)", pattern)
    if group:
        rest = _first_letters(pattern[group.end():]) if group[2] else ""
        return None if rest is None else "".join(w[0] for w in group[1].split("|")).lower() + rest
    # A quantifier behind the first letter could drop it.
    return pattern[0].lower() if re.match(r"[A-Za-z][A-Za-z ]", pattern) and "|" not in re.sub(r"\([^()]*\)", "", pattern) else None


def _compiled(rules) -> list[tuple[str, str]]:
    out = []
    for label, patterns, keywords in rules:
        parts = [f"(?:{p})" for p in patterns] + [f"(?:{any_of([k.lower()])})" for k in keywords]
        letters = [_first_letters(p) for p in [*patterns, *keywords]]
        # One look at a letter spares most places of a text the trial of every alternative.
        ahead = "" if None in letters else f"(?=[{''.join(sorted(set(''.join(letters))))}])"
        out.append((label, f"(?i){ahead}(?:{'|'.join(parts)})"))
    return out


def _docket_and_text(docket: Column, text: Column) -> Column:
    # Rules ignore case themselves, so the text is not copied to lower case.
    return F.concat_ws(" ", F.coalesce(docket, F.lit("")), F.coalesce(text, F.lit("")))


def classify_case_type(text: Column, docket: Column, rules=V.CASE_TYPE_RULES) -> Column:
    return first_rule(_docket_and_text(docket, text), _compiled(rules), "unknown")


def classify_utility_type(
    text: Column, docket: Column, rules=V.UTILITY_TYPE_RULES, prefixes=V.DOCKET_PREFIX_TYPES
) -> Column:
    """Docket prefix first, then the text rules."""
    by_text = first_rule(_docket_and_text(docket, text), _compiled(rules), "unknown")
    by_prefix = first_rule(F.upper(docket), [(t, f"^{p}[- ]") for p, t in prefixes], None)
    return F.coalesce(by_prefix, by_text)


def normalise_status(status: Column, rules=V.STATUS_RULES) -> Column:
    compiled = [(label, "(?i)" + "|".join(f"(?:{p})" for p in ps)) for label, ps in rules]
    return first_rule(strip(status), compiled, "unknown")


def classify_ownership(name: Column) -> Column:
    return first_word(
        F.lower(name),
        [("cooperative", V.COOPERATIVE_WORDS), ("municipal", V.MUNICIPAL_WORDS)],
        "investor_owned",
    )


def gazetteer_name(text: Column, names: list[tuple[str, str]]) -> Column:
    """Name for the first listed phrase contained in the text, else ''."""
    t = F.lower(text)
    chain = None
    for phrase, name in names:
        hit = t.contains(phrase)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise(F.lit(""))


def _prefix_type(docket: Column, pairs: list[tuple[str, str]]) -> Column:
    return F.coalesce(lookup(F.substring(docket, 1, 2), dict(pairs)), F.lit("unknown"))


def source_utility_type(source: Column, text: Column, docket: Column) -> Column:
    """Service type by the rule of the source the record comes from.

    ``text`` is the docket title (Connecticut, Georgia), the industry label
    (California, Indiana) or the type shown on the page (Missouri).
    """
    t = F.lower(F.coalesce(text, F.lit("")))
    mo = _prefix_type(docket, V.PREFIX_TYPES_MO)
    return (
        F.when(source == "connecticut_pura", first_word(t, V.TYPE_WORDS_CT, "unknown"))
        .when(source == "georgia_psc", first_word(t, V.TYPE_WORDS_GA, "unknown"))
        .when(source == "oregon_puc", _prefix_type(docket, V.PREFIX_TYPES_OR))
        .when(
            source == "missouri_psc",
            F.when(mo != "unknown", mo).otherwise(first_word(t, V.TYPE_WORDS_MO, "unknown")),
        )
        .when(
            source == "indiana_iurc",
            F.coalesce(lookup(t, dict(V.INDUSTRY_TYPES_IN)), F.lit("unknown")),
        )
        .when(source == "california_cpuc", first_word(t, V.TYPE_WORDS_CA, None))
        .otherwise(F.lit("unknown"))
    )


def source_case_type(source: Column, text: Column, docket: Column) -> Column:
    """Case type by source: text rules in Missouri, a constant elsewhere."""
    by_text = first_word(F.lower(F.coalesce(text, F.lit(""))), V.CASE_TYPE_WORDS_MO, None)
    prefixes = [p for p, _ in V.PREFIX_TYPES_MO]
    by_prefix = F.when(F.substring(docket, 1, 2).isin(prefixes), "general_rate_case")
    return F.when(
        source == "missouri_psc", F.coalesce(by_text, by_prefix, F.lit("unknown"))
    ).otherwise("general_rate_case")


def source_status(source: Column, text: Column, decision_date: Column) -> Column:
    """Case status by the wording of each source."""
    t = F.lower(F.coalesce(text, F.lit("")))
    mo = (
        F.when(t.contains("closed"), "decided")
        .when(t.contains("pending") | t.contains("open"), "active")
        .when(t != "", "decided")
        .otherwise("unknown")
    )
    ca = (
        F.when(t.contains("clos") | t.contains("final"), "decided")
        .when(t.contains("active") | t.contains("open"), "active")
        .otherwise(F.nullif(t, F.lit("")))
    )
    indiana = first_rule(t, [(s, f"^(?:{any_of(words)})$") for s, words in V.STATUS_WORDS_IN], "unknown")
    return (
        F.when(source == "missouri_psc", mo)
        .when(source == "california_cpuc", ca)
        .when(source == "indiana_iurc", indiana)
        .when(source == "oregon_puc", F.when(decision_date.isNotNull(), "decided").otherwise("active"))
        .otherwise("decided")
    )


def fuel_category(technology: Column, phrases=V.FUEL_PHRASES) -> Column:
    """Fuel of the first phrase contained in the technology text.

    Neighbouring phrases of one fuel share an alternation, which keeps the
    order of the list and shortens the chain.
    """
    grouped: list[tuple[str, list[str]]] = []
    for phrase, fuel in phrases:
        if grouped and grouped[-1][0] == fuel:
            grouped[-1][1].append(phrase)
        else:
            grouped.append((fuel, [phrase]))
    return first_word(F.lower(strip(F.coalesce(technology, F.lit("")))), grouped, "other")


def planned_addition(status: Column) -> Column:
    s = F.lower(strip(F.coalesce(status, F.lit(""))))
    return s.rlike(any_of(V.PLANNED_STATUS_WORDS)) | s.isin(V.PLANNED_STATUS_CODES)


def planned_retirement(year: Column, as_of_year: int) -> Column:
    return F.coalesce(year >= as_of_year, F.lit(False))


def is_relevant_ct(title: Column, context: Column) -> Column:
    """Whether a docket reference is a rate case.

    Kept if a known company or a rate word occurs; dropped if there is only
    correspondence to go by.
    """
    title, context = F.coalesce(title, F.lit("")), F.coalesce(context, F.lit(""))
    both = F.lower(F.concat_ws(" ", title, context))
    rate = both.rlike(any_of(V.RATE_WORDS_CT))
    known = gazetteer_name(both, V.GAZETTEER_CT) != ""
    letters = F.lower(context).rlike(any_of(V.CORRESPONDENCE_WORDS_CT))
    return (known | rate) & ~(~rate & (title == "") & letters)


def is_rate_title(title: Column) -> Column:
    return F.lower(title).rlike(any_of(V.RATE_WORDS_GA))


def has_rate_prefix(docket: Column) -> Column:
    return F.substring(docket, 1, 3).isin([f"{p}-" for p, _ in V.PREFIX_TYPES_MO])
