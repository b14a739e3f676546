"""Link organisations to reference data by name and state.

Three stages, each on what the one before left over: equal matching form and
state; most similar form within the state; most similar form in any state, with
a higher threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffworks.fixed_values import CROSS_STATE_BONUS, LINK_THRESHOLD
from tariffworks.functions.names import norm_for_match, token_sort_form
from tariffworks.operators.firstwins import dedupe_eia
from tariffworks.operators.similarity import best_similar
from tariffworks.session import cut_lineage


def _upper(column: str):
    return F.trim(F.upper(F.coalesce(F.col(column), F.lit(""))))


def left_names(utilities: DataFrame) -> DataFrame:
    """Distinct (link_name, link_state) with the matching form."""
    name = F.coalesce(F.nullif("canonical_name", F.lit("")), F.col("name"))
    return (
        utilities.select(name.alias("link_name"), _upper("state").alias("link_state"))
        .filter(F.coalesce("link_name", F.lit("")) != "")
        .distinct()
        .withColumn("norm", norm_for_match(F.col("link_name")))
    )


def reference_names(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reference entries by (form, state) and by form.

    Of records with the same form and state the last gives the id and the first
    the rank; across states the first record of a form gives both.
    """
    forms = dedupe_eia(records).select(
        norm_for_match(F.col("utility_name")).alias("norm"), "state", "eia_utility_id", "seq"
    )
    by_state = forms.groupBy("norm", "state").agg(
        F.max_by("eia_utility_id", "seq").alias("eia_utility_id"), F.min("seq").alias("rank")
    )
    by_name = forms.groupBy("norm").agg(
        F.min_by("eia_utility_id", "seq").alias("eia_utility_id"), F.min("seq").alias("rank")
    )
    return by_state, by_name


def _exact(left: DataFrame, by_state: DataFrame) -> DataFrame:
    """Left rows with the id of an equal form and state, null if there is none."""
    same = by_state.select(
        "norm", F.col("state").alias("link_state"), F.col("eia_utility_id").alias("exact_id")
    )
    return left.join(same, ["norm", "link_state"], "left")


def _fuzzy(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """Best (id, score) for each (block, norm) of the left side.

    ``left`` has (block, norm), ``right`` (block, norm, eia_utility_id, rank).
    """
    left = left.withColumn("form", token_sort_form(F.col("norm")))
    right = right.withColumn("form", token_sort_form(F.col("norm"))).groupBy("block", "form").agg(
        F.min_by("eia_utility_id", "rank").alias("eia_utility_id"), F.min("rank").alias("rank")
    )
    best = best_similar(
        left.select("block", F.col("form").alias("name")).distinct(),
        right.select(
            "block", F.col("form").alias("name"), F.col("eia_utility_id").alias("value"), "rank"
        ),
        threshold,
    )
    return left.join(best.withColumnRenamed("left_name", "form"), ["block", "form"]).select(
        "block", "norm", F.col("value").alias("eia_utility_id"), "score"
    )


def link_stages(utilities: DataFrame, records: DataFrame, threshold: int = LINK_THRESHOLD,
                cross_bonus: int = CROSS_STATE_BONUS) -> dict[str, DataFrame]:
    """The links each stage finds, plus what is left ('unmatched')."""
    by_state, by_name = (cut_lineage(x) for x in reference_names(records))
    staged = cut_lineage(_exact(left_names(utilities), by_state))
    columns = ["link_name", "link_state"]
    exact = staged.filter(F.col("exact_id").isNotNull()).select(
        *columns, F.col("exact_id").alias("eia_utility_id"),
        F.lit(1.0).alias("match_confidence"), F.lit("exact").alias("match_method"),
    )

    def links(df: DataFrame, label: str) -> DataFrame:
        return df.select(
            *columns, "eia_utility_id", F.round(F.col("score") / 100, 2).alias("match_confidence"),
            F.concat(F.lit(label), F.col("score").cast("string")).alias("match_method"),
        )

    rest = staged.filter(F.col("exact_id").isNull()).drop("exact_id")
    near = _fuzzy(
        rest.select(F.col("link_state").alias("block"), "norm").distinct(),
        by_state.withColumnRenamed("state", "block"),
        threshold,
    ).withColumnRenamed("block", "link_state")
    in_state = rest.join(near, ["link_state", "norm"], "left")
    far_rest = in_state.filter(F.col("score").isNull()).drop("eia_utility_id", "score")
    far = _fuzzy(
        far_rest.select(F.lit("").alias("block"), "norm").distinct(),
        by_name.withColumn("block", F.lit("")),
        threshold + cross_bonus,
    ).drop("block")
    cross = far_rest.join(far, "norm", "left")
    return {
        "exact": exact,
        "fuzzy_state": links(in_state.filter(F.col("score").isNotNull()), "fuzzy_"),
        "fuzzy_cross_state": links(
            cross.filter(F.col("score").isNotNull()), "fuzzy_cross_state_"
        ),
        "unmatched": cross.filter(F.col("score").isNull()).select(*columns),
    }


def link_utilities(utilities: DataFrame, records: DataFrame, threshold: int = LINK_THRESHOLD,
                   cross_bonus: int = CROSS_STATE_BONUS) -> DataFrame:
    """One link per (name, state) that any stage can match."""
    stages = link_stages(utilities, records, threshold, cross_bonus)
    every = (
        stages["exact"]
        .unionByName(stages["fuzzy_state"])
        .unionByName(stages["fuzzy_cross_state"])
    )
    return every.withColumnsRenamed({"link_name": "utility_name", "link_state": "state"})


def link_emissions(links: DataFrame, emissions: DataFrame, threshold: int = LINK_THRESHOLD
                   ) -> DataFrame:
    """Emissions with the id of the linked organisation where one is found.

    ``links`` needs an order column ``seq``; a record without a match keeps its
    own id.
    """
    # The matching form is costly, so each spelling gets it once, in as many tasks as a shuffle has.
    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = links.select(
        "utility_name", F.upper(F.coalesce("state", F.lit(""))).alias("state"), "eia_utility_id", "seq",
    ).groupBy("utility_name", "state").agg(
        F.max_by("eia_utility_id", "seq").alias("eia_utility_id"), F.max("seq").alias("last"), F.min("seq").alias("rank")
    ).repartition(parts, "utility_name", "state")
    by_state = names.withColumn("norm", norm_for_match(F.col("utility_name"))).groupBy("norm", "state").agg(
        F.max_by("eia_utility_id", "last").alias("eia_utility_id"), F.min("rank").alias("rank")
    )
    left = (
        emissions.select(
            F.col("utility_name_egrid").alias("link_name"),
            F.upper(F.coalesce("state", F.lit(""))).alias("link_state"),
        )
        .distinct()
        .repartition(parts, "link_name", "link_state")
        .withColumn("norm", norm_for_match(F.coalesce("link_name", F.lit(""))))
    )
    staged = _exact(left, by_state)
    near = _fuzzy(
        staged.filter(F.col("exact_id").isNull())
        .select(F.col("link_state").alias("block"), "norm").distinct(),
        by_state.withColumnRenamed("state", "block"),
        threshold,
    ).select(F.col("block").alias("link_state"), "norm", F.col("eia_utility_id").alias("near_id"))
    ids = staged.join(near, ["link_state", "norm"], "left").select(
        "link_name", "link_state", F.coalesce("exact_id", "near_id").alias("linked_id")
    )
    keyed = emissions.withColumn("link_state", F.upper(F.coalesce("state", F.lit(""))))
    same = keyed["utility_name_egrid"].eqNullSafe(ids["link_name"]) & (
        keyed["link_state"] == ids["link_state"]
    )
    return keyed.join(ids, same, "left").select(
        *[
            (F.coalesce("linked_id", "eia_utility_id") if x == "eia_utility_id" else F.col(x))
            .alias(x)
            for x in emissions.columns
        ],
        F.col("linked_id").isNotNull().alias("is_linked"),
    )


def link_summary(utilities: DataFrame, links: DataFrame) -> DataFrame:
    """Matched and unmatched organisations."""
    found = links.select(
        F.col("utility_name").alias("link_name"), F.col("state").alias("link_state"),
        F.lit(True).alias("hit"),
    )
    return left_names(utilities).join(found, ["link_name", "link_state"], "left").agg(
        F.count_if("hit").alias("matched"), F.count_if(F.col("hit").isNull()).alias("unmatched")
    )
