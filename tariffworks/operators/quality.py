"""Enrichment flags, scores, validation and integrity checks of rate cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffworks.fixed_values import QUALITY_FLOOR
from tariffworks.functions.scores import (
    quality_components, quality_issues, quality_score, validate_case,
)


def _case_name():
    return F.lower(
        F.coalesce(F.nullif("canonical_utility_name", F.lit("")), F.col("utility_name"))
    )


def enrichment_flags(cases: DataFrame, links: DataFrame, emissions: DataFrame,
                     impacts: DataFrame) -> DataFrame:
    """Cases with ``has_eia_link``, ``has_emissions`` and ``has_impact``.

    The right sides are reduced to distinct keys, so no case is repeated; of
    several links of a name and state the last decides about emissions.
    """
    link_ids = links.groupBy(
        F.lower("utility_name").alias("name_key"),
        F.upper(F.coalesce("state", F.lit(""))).alias("state_key"),
    ).agg(F.max_by("eia_utility_id", "seq").alias("linked_id"), F.count("*").alias("n_links"))
    with_emissions = (
        emissions.filter(F.coalesce(F.col("eia_utility_id"), F.lit(0)) != 0)
        .select(F.col("eia_utility_id").alias("linked_id")).distinct()
        .withColumn("emits", F.lit(True))
    )
    by_link = link_ids.join(with_emissions, "linked_id", "left")
    with_impact = impacts.select("docket_number", "source").distinct().withColumn(
        "hit", F.lit(True)
    )
    keyed = cases.withColumn("name_key", _case_name()).withColumn(
        "state_key", F.upper(F.coalesce("state", F.lit("")))
    )
    return (
        keyed.join(by_link, ["name_key", "state_key"], "left")
        .join(with_impact, ["docket_number", "source"], "left")
        .select(
            *[keyed[x] for x in cases.columns],
            F.col("n_links").isNotNull().alias("has_eia_link"),
            F.coalesce("emits", F.lit(False)).alias("has_emissions"),
            F.coalesce("hit", F.lit(False)).alias("has_impact"),
        )
    )


def score_cases(flagged: DataFrame) -> DataFrame:
    """Adds ``components``, ``issues``, ``errors`` and a new ``quality_score``."""
    parts = quality_components(
        F.col("has_eia_link"), F.col("has_emissions"), F.col("has_impact")
    )
    as_map = F.create_map(*[x for k, v in parts.items() for x in (F.lit(k), v)])
    return flagged.select(
        *[F.col(x) for x in flagged.columns if x != "quality_score"],
        quality_score(parts).alias("quality_score"),
        as_map.alias("components"), quality_issues().alias("issues"),
        validate_case().alias("errors"),
    )


def validation_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("scored"),
        F.round(F.avg("quality_score"), 6).alias("avg_score"),
        F.min("quality_score").alias("min_score"),
        F.max("quality_score").alias("max_score"),
        F.count_if(F.col("quality_score") >= QUALITY_FLOOR).alias("above_threshold"),
        F.count_if(F.size("errors") > 0).alias("with_errors"),
        F.coalesce(F.sum(F.size("issues")), F.lit(0)).cast("bigint").alias("total_issues"),
    )


def doc_counts(cases: DataFrame, documents: DataFrame) -> DataFrame:
    """Cases with the number of documents of their docket."""
    counts = documents.groupBy("docket_number").agg(F.count("*").alias("document_count"))
    return cases.join(counts, "docket_number", "left").withColumn(
        "document_count", F.coalesce("document_count", F.lit(0)).cast("bigint")
    )


def dup_dockets(records: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return records.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def multi_state_entities(cases: DataFrame) -> DataFrame:
    """Names found in more than one state, with the sorted list of states."""
    name = F.coalesce(F.nullif("canonical_utility_name", F.lit("")), F.col("utility_name"))
    usable = cases.select(name.alias("name"), "state").filter(
        (F.coalesce("name", F.lit("")) != "") & (F.coalesce("state", F.lit("")) != "")
    )
    states = usable.distinct().groupBy("name").agg(
        F.sort_array(F.collect_set("state")).alias("states")
    )
    return states.filter(F.size("states") > 1).select(
        "name", F.array_join("states", ", ").alias("states")
    )
