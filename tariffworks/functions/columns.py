"""Small column helpers shared by the other function modules."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, or null (``regexp_extract`` returns '' instead)."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


# Characters that count as white space.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
#: The same characters by their class, which tests a character several times faster than a list of them.
_WHITE_SPACE_RUN = r"[\p{IsWhite_Space}\x1c-\x1f]+"


def strip(text: Column) -> Column:
    """Text without white space at its ends (``trim`` alone removes only blanks)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def squeeze(text: Column) -> Column:
    """Every run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, _WHITE_SPACE_RUN, " "))


def any_of(words: Iterable[str]) -> str:
    """One alternation of literal words."""
    return "|".join(literal(w) for w in words)


def literal(word: str) -> str:
    """Escape a word for use in a pattern; plain escapes read by any engine."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", word)


def first_rule(text: Column, rules: Iterable[tuple[str, str]], default: str | None) -> Column:
    """Value of the first (value, pattern) rule whose pattern is found in the text."""
    chain = None
    for value, pattern in rules:
        hit = text.rlike(pattern)
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain.otherwise(F.lit(default))


def first_word(text: Column, rules: Iterable[tuple[str, list[str]]], default: str | None) -> Column:
    """Like :func:`first_rule` for rules made of literal words."""
    return first_rule(text, [(value, any_of(words)) for value, words in rules], default)


def lookup(key: Column, pairs: dict[str, str]) -> Column:
    """Value for a key in a fixed table, or null."""
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.try_element_at(table, key)


def title_case(text: Column) -> Column:
    """Words separated by ``_`` or blanks, each starting with a capital."""
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))
