"""Roll generator rows up to one row per utility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffworks.fixed_values import FUELS
from tariffworks.functions.rules import fuel_category, planned_addition, planned_retirement
from tariffworks.functions.scores import score_capacity


def fleet_rollup(generators: DataFrame, year: int, as_of_year: int) -> DataFrame:
    """Capacity by fuel, plants, generators, mean age and planned changes.

    ``as_of_year`` is the year ages and planned retirements are counted from.
    """
    mw = F.col("nameplate_mw")
    usable = generators.filter(F.col("utility_id").isNotNull() & (mw > 0)).withColumn(
        "fuel", fuel_category(F.col("technology"))
    )
    zero = F.lit(0.0)
    started = F.col("operating_year").between(1900, as_of_year)
    per_utility = usable.groupBy(F.col("utility_id").alias("eia_utility_id")).agg(
        *[
            F.round(F.sum(F.when(F.col("fuel") == f, mw).otherwise(zero)), 2)
            .alias(f"{f}_capacity_mw")
            for f in FUELS
        ],
        F.round(F.sum(mw), 2).alias("total_capacity_mw"),
        F.count_distinct("plant_code").alias("num_plants"),
        F.count("*").alias("num_generators"),
        F.round(as_of_year - F.avg(F.when(started, F.col("operating_year"))), 1)
        .alias("avg_generator_age"),
        F.round(F.sum(F.when(planned_addition(F.col("status")), mw).otherwise(zero)), 2)
        .alias("planned_additions_mw"),
        F.round(
            F.sum(
                F.when(
                    planned_retirement(F.col("planned_retirement_year"), as_of_year), mw
                ).otherwise(zero)
            ), 2,
        ).alias("planned_retirements_mw"),
    )
    return per_utility.select(
        "eia_utility_id", F.lit(year).alias("year"),
        *[x for x in per_utility.columns if x != "eia_utility_id"],
    ).withColumn("quality_score", score_capacity())
