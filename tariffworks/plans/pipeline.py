"""The pipeline over stored tables: raw records to cases, with an audit row for every source.

The case table is partitioned by source, a part of its key.  A run opens an audit row for each source,
parses the raw records once, merges them into the partitions they have rows in, and closes the audit
rows with counters that were observed while the merge was written, not counted again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tariffworks import schemas
from tariffworks.operators import extract, merge
from tariffworks.plans import jobs
from tariffworks.session import cut_lineage

STAGE = "store"


def create_tables(spark: SparkSession, root: str, cases: DataFrame | None = None) -> None:
    """Empty tables of cases and of runs, or cases to start with."""
    if cases is None:
        cases = spark.createDataFrame([], schemas.RATE_CASES)
    columns = [F.col(f.name).cast(f.dataType) if f.name in cases.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in schemas.RATE_CASES.fields]
    cases.select(*columns).write.mode("overwrite").partitionBy("source").parquet(f"{root}/rate_cases")
    spark.createDataFrame([], schemas.PIPELINE_RUNS).write.mode("overwrite").parquet(f"{root}/pipeline_runs")


def read_cases(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.RATE_CASES).parquet(f"{root}/rate_cases").select(*schemas.RATE_CASES.names)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """The latest state of each run."""
    return merge.audit_latest(spark.read.schema(schemas.PIPELINE_RUNS).parquet(f"{root}/pipeline_runs"))


def store_batch(spark: SparkSession, root: str, raw: DataFrame, sources: list[str], run: str,
                started_at: Column, completed_at: Column) -> DataFrame:
    """Parse raw records (with ``seq``) and store them; returns the rejected ones.

    ``source`` of a record is one of ``sources``; records of others are none of ours and stay out.  A run is
    named by ``run`` and its source.
    """
    names = spark.createDataFrame([(x,) for x in sources], "source string")
    run_id = F.sha2(F.concat(F.lit(run), F.lit("/"), F.col("source")), 256)
    opened = names.select(*merge.audit_start(run_id, F.col("source"), STAGE, started_at))
    opened.select(*schemas.PIPELINE_RUNS.names).write.mode("append").parquet(f"{root}/pipeline_runs")

    parsed, rejects = extract.parse_record(raw.filter(F.col("source").isin(sources)))
    typed = parsed.withColumn("scraped_at", F.try_to_timestamp("scraped_at"))
    is_valid = F.lit(True)
    for name in merge.CASE_REQUIRED:
        is_valid = is_valid & F.col(name).isNotNull()
    of = {x: F.col("source") == x for x in sources}
    read, written = Observation(f"{run}-read"), Observation(f"{run}-written")
    watched = typed.observe(
        read, *[F.count_if(of[x]).alias(f"processed {x}") for x in sources],
        *[F.count_if(of[x] & ~is_valid).alias(f"errors {x}") for x in sources])

    def effects(stored: DataFrame, batch: DataFrame) -> DataFrame:
        return merge.case_effects(stored, batch).observe(
            written, *[F.count_if(of[x] & F.col("is_new")).alias(f"created {x}") for x in sources])

    # Stored once: the partitions the batch has rows in are asked for before it is merged.
    merge.merge_partitions(spark, f"{root}/rate_cases", schemas.RATE_CASES, cut_lineage(watched.filter(is_valid)), "source", effects)

    counters = []
    for x in sources:
        processed, errors, created = read.get[f"processed {x}"], read.get[f"errors {x}"], written.get[f"created {x}"]
        counters.append((x, processed, created, processed - errors - created, errors))
    found = spark.createDataFrame(counters, "source string, records_processed bigint, records_created bigint, records_updated bigint, errors bigint")
    closed = opened.drop("records_processed", "records_created", "records_updated", "errors").join(found, "source").withColumns(
        {"status": F.lit("completed"), "completed_at": completed_at})
    closed.select(*schemas.PIPELINE_RUNS.names).write.mode("append").parquet(f"{root}/pipeline_runs")
    return rejects


def run_pipeline(spark: SparkSession, root: str, raw: DataFrame, sources: list[str], run: str, started_at: Column,
                 completed_at: Column, utilities: DataFrame, aliases: DataFrame, links: DataFrame, emissions: DataFrame,
                 impacts: DataFrame) -> dict[str, DataFrame]:
    """Store a batch, then name, score and sum up all stored cases."""
    rejects = store_batch(spark, root, raw, sources, run, started_at, completed_at)
    named, organisations = jobs.normalise(read_cases(spark, root), utilities, aliases)
    scored = cut_lineage(jobs.validate(named, links, emissions, impacts))
    return {"rate_cases": scored.select(*schemas.RATE_CASES.names), "utilities": organisations, "rejects": rejects,
            "pipeline_runs": read_runs(spark, root), **jobs.summaries(scored)}
