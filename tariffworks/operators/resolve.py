"""Resolve raw organisation names to canonical ones.

Exact spelling, then cleaned spelling, then the most similar spelling.  Works
on distinct names and joins back, so its cost follows the number of different
names and not the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffworks.fixed_aliases import ALIASES
from tariffworks.fixed_values import RESOLVE_THRESHOLD
from tariffworks.functions.columns import strip
from tariffworks.functions.names import clean_name, token_sort_form
from tariffworks.operators.similarity import similar_names

ALIAS_SCHEMA = "alias string, canonical string, parent string, utility_type string, alias_state string, pos int"


def alias_rows(aliases=ALIASES) -> list[tuple]:
    """(lower-case spelling, canonical, parent, type, state, position).

    A spelling claimed twice belongs to the later claim but keeps the position
    of the first.
    """
    claims = {}
    for canonical, parent, utility_type, state, spellings in aliases:
        for spelling in [canonical, *spellings]:
            claims[spelling.lower()] = (canonical, parent, utility_type, state)
    return [(alias, *claim, pos) for pos, (alias, claim) in enumerate(claims.items())]


def alias_table(spark: SparkSession, aliases=ALIASES) -> DataFrame:
    return spark.createDataFrame(alias_rows(aliases), ALIAS_SCHEMA)


def _info(prefix: str) -> list:
    return [F.struct("canonical", "parent", "utility_type", "pos").alias(prefix)]


def resolve_exact(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Adds ``exact``, the entry whose spelling equals the raw name."""
    table = aliases.select(F.col("alias").alias("__alias"), *_info("exact"))
    key = F.lower(strip(F.col("utility_name")))
    return names.join(table, key == F.col("__alias"), "left").drop("__alias")


def resolve_cleaned(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Adds ``cleaned_name`` and ``cleaned``, the entry equal to the cleaned name."""
    table = aliases.select(F.col("alias").alias("__alias"), *_info("cleaned"))
    with_clean = names.withColumn("cleaned_name", clean_name(F.col("utility_name")))
    return with_clean.join(
        table, F.lower(F.col("cleaned_name")) == F.col("__alias"), "left"
    ).drop("__alias")


def resolve_fuzzy(names: DataFrame, aliases: DataFrame, threshold: int = RESOLVE_THRESHOLD
                  ) -> DataFrame:
    """Most similar entries by raw name: ``in_state`` and ``any_state``.

    ``in_state`` leaves out entries known to belong to another state; it equals
    ``any_state`` where the name has no state.
    """
    form = names.select(
        "utility_name", "state",
        token_sort_form(F.lower(clean_name(F.col("utility_name")))).alias("form"),
    )
    table = aliases.withColumn("form", token_sort_form(F.col("alias")))
    block = F.lit("").alias("block")
    scored = similar_names(
        form.select(block, F.col("form").alias("name")).distinct(),
        table.select(block, F.col("form").alias("name")).distinct(),
        threshold,
    ).select(F.col("left_name").alias("form"), "right_name", "score")
    candidates = (
        form.join(scored, "form")
        .join(table.withColumnRenamed("form", "right_name"), "right_name")
    )
    state = F.upper(F.coalesce("state", F.lit("")))
    fits = (state == "") | F.col("alias_state").isNull() | (F.col("alias_state") == state)
    entry = F.struct("canonical", "parent", "utility_type", "pos", "score")
    rank = F.struct(F.col("score"), -F.col("pos"))
    return candidates.groupBy("utility_name").agg(
        F.max_by(entry, F.when(fits, rank)).alias("in_state"),
        F.max_by(entry, rank).alias("any_state"),
    )


def resolve_utilities(names: DataFrame, aliases: DataFrame, threshold: int = RESOLVE_THRESHOLD
                      ) -> DataFrame:
    """Canonical name, parent, type and method for each (utility_name, state).

    ``names`` has one row per raw name.  Methods: ``exact_alias``,
    ``cleaned_exact``, ``fuzzy_<score>``, ``unresolved``; null for an empty name.
    """
    named = strip(F.coalesce("utility_name", F.lit(""))) != ""
    staged = resolve_cleaned(resolve_exact(names, aliases), aliases)
    rest = staged.filter(named & F.col("exact").isNull() & F.col("cleaned").isNull())
    fuzzy = resolve_fuzzy(rest, aliases, threshold)
    every = staged.join(fuzzy, "utility_name", "left")
    near = F.coalesce("in_state", "any_state")
    hit = F.coalesce(
        F.col("exact"), F.col("cleaned"), F.when(near.isNotNull(), F.struct(
            near["canonical"], near["parent"], near["utility_type"], near["pos"]
        ).cast("struct<canonical:string,parent:string,utility_type:string,pos:int>")),
    )
    method = (
        F.when(F.col("exact").isNotNull(), "exact_alias")
        .when(F.col("cleaned").isNotNull(), "cleaned_exact")
        .when(near.isNotNull(), F.concat(F.lit("fuzzy_"), near["score"].cast("string")))
        .otherwise("unresolved")
    )
    return every.select(
        "utility_name", "state",
        F.when(named, F.coalesce(hit["canonical"], "cleaned_name")).alias("canonical_name"),
        F.when(named, hit["parent"]).alias("parent_company"),
        F.when(named, F.coalesce(hit["utility_type"], F.lit("unknown")))
        .otherwise("unknown").alias("utility_type"),
        F.when(named, method).alias("match_method"),
    )


def apply_name_mapping(cases: DataFrame, resolved: DataFrame) -> DataFrame:
    """Cases with the canonical name of their raw name; of several, the greatest, so that no case is multiplied."""
    mapping = resolved.groupBy("utility_name").agg(F.max("canonical_name").alias("__canonical"))
    return cases.join(mapping, "utility_name", "left").withColumn(
        "canonical_utility_name", F.col("__canonical")
    ).drop("__canonical")


def resolution_summary(resolved: DataFrame) -> DataFrame:
    return resolved.agg(
        F.count_if(F.col("match_method") != "unresolved").alias("resolved"),
        F.count("*").alias("total"),
    )

