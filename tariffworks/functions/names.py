"""Organisation names: cleaning, matching form and similarity, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions.columns import literal, squeeze, strip


def clean_name(name: Column, suffixes=V.NAME_SUFFIXES, expansions=V.NAME_EXPANSIONS) -> Column:
    """Name without legal suffixes, with abbreviations written out.

    Each suffix is tried once, longest first, so stripping one can expose a
    shorter one but not a longer one.
    """
    out = strip(name)
    for suffix in sorted(suffixes, key=len, reverse=True):
        out = F.regexp_replace(out, rf"(?i),?\s*{literal(suffix)}\s*$", "")
    for short, full in expansions:
        if short == "&":
            out = F.replace(out, F.lit(" & "), F.lit(f" {full} "))
        else:
            out = F.regexp_replace(out, rf"(?i)\b{literal(short)}\b", full)
    out = squeeze(out)
    return F.regexp_replace(out, r"[.,;:]+$", "")


def norm_for_match(name: Column, noise=V.NOISE_WORDS) -> Column:
    """Lower-case cleaned name without noise words, unless fewer than two words remain."""
    words = F.filter(F.split(F.lower(strip(clean_name(name))), r"\s+"), lambda w: w != "")
    kept = F.filter(words, lambda w: ~w.isin(noise))
    return F.array_join(F.when(F.size(kept) < 2, words).otherwise(kept), " ")


def token_sort_form(name: Column) -> Column:
    """Form compared by :func:`token_sort_ratio`.

    Latin-1 letters beyond ASCII are dropped, other signs become blanks, and
    the words are sorted.
    """
    plain = F.lower(F.regexp_replace(name, "[\u0080-\u00ff]", ""))
    words = F.split(F.regexp_replace(plain, r"[^\p{L}\p{N}_]", " "), " ")
    return F.array_join(F.array_sort(F.filter(words, lambda w: w != "")), " ")


# Longest common subsequence, one bit per position of the first string.  Sixty
# positions fit a word with room for the carry, longer strings use more words.
_WORD = 60
_FULL = (1 << _WORD) - 1


def char_masks(text: Column) -> Column:
    """Map from each character to the positions it occurs at, as bit words.

    Built once per distinct string, before a join, and read once per pair.
    """
    words = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / _WORD) - 1, F.lit(0)).cast("int"))
    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")

    def mask(char: Column, word: Column) -> Column:
        part = F.substring(text, word * _WORD + 1, F.lit(_WORD))
        positions = F.sequence(F.lit(1), F.greatest(F.length(part), F.lit(1)))
        return F.aggregate(
            positions,
            F.lit(0).cast("bigint"),
            lambda acc, i: acc.bitwiseOR(
                F.when(
                    F.substring(part, i, F.lit(1)) == char,
                    F.call_function("shiftleft", F.lit(1).cast("bigint"), i - 1),
                ).otherwise(F.lit(0).cast("bigint"))
            ),
        )

    return F.map_from_entries(
        F.transform(chars, lambda c: F.struct(c, F.transform(words, lambda w: mask(c, w))))
    )


def lcs_length(length: Column, masks: Column, other: Column) -> Column:
    """Length of the longest common subsequence of a string and ``other``.

    ``length`` and ``masks`` describe the first string (:func:`char_masks`).
    """
    zero = F.lit(0).cast("bigint")
    full = F.lit(_FULL).cast("bigint")
    chars = F.filter(F.split(other, ""), lambda c: c != "")

    def short_step(v: Column, m: Column) -> Column:
        hit = v.bitwiseAND(m)
        return (v + hit).bitwiseOR(v - hit).bitwiseAND(full)

    hits = F.filter(
        F.transform(chars, lambda c: F.try_element_at(F.try_element_at(masks, c), F.lit(1))),
        lambda m: m.isNotNull(),
    )
    short = F.aggregate(hits, full, short_step, lambda v: _WORD - F.bit_count(v))

    n_words = F.ceil(length / _WORD).cast("int")

    def long_step(state: Column, mask: Column) -> Column:
        # state: one word after another, lowest first; the carry goes upward
        start = F.struct(F.array().cast("array<bigint>").alias("out"), zero.alias("carry"))

        def one_word(acc: Column, pair: Column) -> Column:
            hit = pair["v"].bitwiseAND(pair["m"])
            total = pair["v"] + hit + acc["carry"]
            out = total.bitwiseAND(full).bitwiseOR(pair["v"] - hit)
            return F.struct(
                F.array_append(acc["out"], out).alias("out"),
                F.call_function("shiftright", total, F.lit(_WORD)).alias("carry"),
            )

        pairs = F.transform(
            state, lambda v, i: F.struct(v.alias("v"), F.get(mask, i).alias("m"))
        )
        return F.aggregate(pairs, start, one_word, lambda acc: acc["out"])

    long_hits = F.filter(
        F.transform(chars, lambda c: F.try_element_at(masks, c)), lambda m: m.isNotNull()
    )
    long = F.aggregate(
        long_hits,
        F.array_repeat(full, n_words),
        long_step,
        lambda vs: (
            n_words * _WORD - F.aggregate(vs, F.lit(0), lambda acc, v: acc + F.bit_count(v))
        ).cast("int"),
    )
    return F.when(length <= _WORD, short).otherwise(long)


def similarity_score(length_a: Column, length_b: Column, common: Column) -> Column:
    """Rounded share (0-100) of two strings covered by a common subsequence."""
    total = length_a + length_b
    distance = (total - 2 * common).cast("double")
    share = F.when(total == 0, F.lit(1.0)).otherwise(1.0 - distance / F.nullif(total, F.lit(0)))
    return F.bround(share * 100).cast("int")


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity of two names, 0-100, whatever the order of their words."""
    a, b = token_sort_form(a), token_sort_form(b)
    return similarity_score(F.length(a), F.length(b), lcs_length(F.length(a), char_masks(a), b))
