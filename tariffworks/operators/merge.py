"""Keyed upsert of a batch into a table.

One operator serves all tables; a policy per column says what an incoming value
does to the stored one:

* ``keep_old_on_null``    an incoming null leaves the stored value
* ``keep_old_on_unknown`` as above, and so does the value ``'unknown'``
* ``overwrite``           the incoming value always wins, null included
* ``keep_old``            the stored value stays (creation time)

The batch is folded once and meets the table in one full outer join: both are read once, and the table
is shuffled once at most.  A small batch does not touch all of a large table: :func:`merge_partitions`
reads, shuffles and writes only the partitions that the batch has keys in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffworks.session import cut_lineage

KEEP_OLD_ON_NULL = "keep_old_on_null"
KEEP_OLD_ON_UNKNOWN = "keep_old_on_unknown"
OVERWRITE = "overwrite"
KEEP_OLD = "keep_old"


def _same_key(keys: list[str]) -> Column:
    """Equal keys of a table and of one whose key columns start with two underscores; nulls are equal."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


def _usable(column: Column, policy: str) -> Column:
    if policy == KEEP_OLD_ON_UNKNOWN:
        return F.nullif(column, F.lit("unknown"))
    return column


def fold_batch(batch: DataFrame, keys: list[str], seq: str, policies: dict[str, str] | None = None,
               default: str = KEEP_OLD_ON_NULL, count_as: str | None = None) -> DataFrame:
    """One row per key: the effect of applying the rows of a batch in order, and their number if it is asked for.

    An aggregation per column (last usable value by ``seq``), reduced before
    the shuffle.
    """
    policies = policies or {}
    order = F.col(seq)
    folded = []
    for name in batch.columns:
        if name in keys or name == seq:
            continue
        policy = policies.get(name, default)
        value = F.col(name)
        if policy == OVERWRITE:
            folded.append(F.max_by(value, order).alias(name))
        elif policy == KEEP_OLD:
            folded.append(F.min_by(value, F.when(value.isNotNull(), order)).alias(name))
        else:
            usable = _usable(value, policy)
            last = F.max_by(usable, F.when(usable.isNotNull(), order))
            if policy == KEEP_OLD_ON_UNKNOWN:
                last = F.coalesce(last, F.max_by(value, order))
            folded.append(last.alias(name))
    counted = [F.count("*").alias(count_as)] if count_as else []
    return batch.groupBy(*keys).agg(*folded, *counted)


def merge(old: DataFrame, batch: DataFrame, keys: list[str], seq: str,
          policies: dict[str, str] | None = None, default: str = KEEP_OLD_ON_NULL,
          insert_defaults: dict[str, str] | None = None) -> DataFrame:
    """``old`` with the batch applied.

    ``insert_defaults`` fill columns of rows that are new.  Columns the batch
    does not have keep their stored values.
    """
    return merge_effects(old, batch, keys, seq, policies, default, insert_defaults).select(*old.columns)


def merge_effects(old: DataFrame, batch: DataFrame, keys: list[str], seq: str,
                  policies: dict[str, str] | None = None, default: str = KEEP_OLD_ON_NULL,
                  insert_defaults: dict[str, str] | None = None) -> DataFrame:
    """As `merge`, with is_new (the key was not stored) and n_rows (of the batch, 0 where it left the row alone)."""
    policies = policies or {}
    fields = [c for c in batch.columns if c not in keys and c != seq]
    new = fold_batch(batch, keys, seq, policies, default, count_as="__n")
    new = new.select(*[F.col(k).alias(f"__{k}") for k in keys],
                     F.struct(*[c for c in new.columns if c not in keys]).alias("__new"))
    is_new, touched = F.col("__stored").isNull(), F.col("__new").isNotNull()

    def value(name: str, field) -> Column:
        if name in keys:
            return F.when(is_new, F.col(f"__{name}")).otherwise(F.col(name))
        if name not in fields:
            both = F.col(name)
        else:
            stored, incoming = F.col(name), F.col("__new")[name].cast(field.dataType)
            policy = policies.get(name, default)
            if policy == OVERWRITE:
                both = F.when(touched, incoming).otherwise(stored)
            elif policy == KEEP_OLD:
                both = F.coalesce(stored, incoming)
            else:
                both = F.when(is_new, incoming).otherwise(F.coalesce(_usable(incoming, policy), stored))
        if insert_defaults and name in insert_defaults:
            both = F.when(is_new, F.coalesce(both, F.lit(insert_defaults[name]).cast(field.dataType))).otherwise(both)
        return both

    joined = old.withColumn("__stored", F.lit(True)).join(new, _same_key(keys), "full_outer")
    return joined.select(
        *[value(f.name, f).cast(f.dataType).alias(f.name) for f in old.schema.fields],
        is_new.alias("is_new"), F.coalesce(F.col("__new.__n"), F.lit(0)).alias("n_rows"))


def merge_partitions(spark: SparkSession, path: str, schema: T.StructType, batch: DataFrame, partition: str, merger) -> DataFrame:
    """Apply ``merger(stored, batch)`` to the partitions of a table that the batch has rows in; returns what it gave.

    ``partition`` is a column of the key, so that a key never leaves its partition.  The result is stored
    before any partition is replaced: a failure leaves the table as it was or lets the replacement be repeated.
    """
    touched = [row[0] for row in batch.select(partition).distinct().collect()]
    stored = spark.read.schema(schema).parquet(path).select(*schema.names)
    result = cut_lineage(merger(stored.filter(F.col(partition).isin(touched)), batch))
    (result.select(*stored.columns).hint("rebalance", partition).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))
    return result


def merge_counts(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row (processed, created, updated).

    A key that occurs again inside the batch counts as an update, because its
    first row has stored it by then.
    """
    per_key = batch.groupBy(*keys).agg(F.count("*").alias("n"))
    fresh = _anti(per_key, old, keys)
    created = fresh.agg(F.count("*").alias("created"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("processed")).select(
        "processed",
        created.scalar().alias("created"),
        (F.col("processed") - created.scalar()).alias("updated"),
    )


def _anti(left: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    stored = old.select(*[F.col(k).alias(f"__{k}") for k in keys])
    return left.join(stored, _same_key(keys), "left_anti")


def merge_existence(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch with a flag telling whether its key is stored already; null keys are keys."""
    stored = old.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct().withColumn("is_stored", F.lit(True))
    return batch.join(stored, _same_key(keys), "left").select(
        *batch.columns, F.coalesce("is_stored", F.lit(False)).alias("is_stored"))


# --- the tables ------------------------------------------------------------------

CASE_KEYS = ["docket_number", "source"]
CASE_REQUIRED = ["docket_number", "utility_name", "state"]
CASE_DEFAULTS = {"case_type": "unknown", "utility_type": "unknown", "status": "unknown"}


def case_effects(old: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    return merge_effects(old, batch, CASE_KEYS, seq, {"created_at": KEEP_OLD}, insert_defaults=CASE_DEFAULTS)


def merge_cases(old: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    return case_effects(old, batch, seq).select(*old.columns)


def merge_utilities(old: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    policies = {"utility_type": KEEP_OLD_ON_UNKNOWN, "ownership_type": KEEP_OLD_ON_UNKNOWN,
                "created_at": KEEP_OLD}
    return merge(old, batch, ["name", "state"], seq, policies,
                 insert_defaults={"utility_type": "unknown", "ownership_type": "unknown"})


def merge_operations(old: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    return merge(old, batch, ["eia_utility_id", "year"], seq)


def merge_emissions(old: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    return merge(old, batch, ["utility_name_egrid", "state", "year"], seq)


def merge_capacity(old: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    return merge(old, batch, ["eia_utility_id", "year"], seq)


def merge_links(old: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    return merge(old, batch, ["utility_name", "state", "eia_utility_id"], seq, default=OVERWRITE)


def merge_impacts(old: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    return merge(old, batch, CASE_KEYS, seq, default=OVERWRITE)


def split_valid(batch: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that can be stored and rows that lack a required value."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    return batch.filter(~missing), batch.filter(missing)


def merge_store(old: DataFrame, batch: DataFrame, source: str, seq: str = "seq"
                ) -> tuple[DataFrame, DataFrame]:
    """Store a batch under a source: the merged table and one row of counters."""
    tagged = batch.withColumn("source", F.lit(source))
    valid, invalid = split_valid(tagged, CASE_REQUIRED)
    errors = invalid.agg(F.count("*").alias("errors"))
    counts = merge_counts(old, valid, CASE_KEYS).select(
        F.lit(source).alias("source"),
        (F.col("processed") + errors.scalar()).alias("records_processed"),
        F.col("created").alias("records_created"),
        F.col("updated").alias("records_updated"),
        errors.scalar().alias("errors"),
    )
    return merge_cases(old, valid, seq), counts


def append_documents(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Documents have no key: every complete row is kept, type defaulting to 'other'."""
    valid, _ = split_valid(batch, ["docket_number", "source", "state"])
    typed = valid.withColumn("document_type", F.coalesce("document_type", F.lit("other")))
    return old.unionByName(typed, allowMissingColumns=True)


def _set(cases: DataFrame, new: DataFrame, keys: list[str], value: str, column: str, order: str | None,
         updated_at: Column | None) -> DataFrame:
    """Cases with a column set by key.

    Of several rows of a key the last one by ``order`` counts (without one, the greatest value),
    so that no case is multiplied.  Null values set nothing.  ``updated_at`` is set where a value is.
    """
    by = F.col(order) if order else F.col(value)
    last = new.filter(F.col(value).isNotNull()).groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        F.max_by(F.col(value), by).alias("__value"))
    joined = cases.join(last, _same_key(keys), "left").withColumn(column, F.coalesce("__value", column))
    if updated_at is not None and "updated_at" in cases.columns:
        joined = joined.withColumn("updated_at", F.when(F.col("__value").isNotNull(), updated_at).otherwise(F.col("updated_at")))
    return joined.select(*cases.columns)


def update_names(cases: DataFrame, mapping: DataFrame, order: str | None = None, updated_at: Column | None = None) -> DataFrame:
    """Set the canonical name by raw name (columns ``utility_name``, ``canonical_name``)."""
    return _set(cases, mapping, ["utility_name"], "canonical_name", "canonical_utility_name", order, updated_at)


def _score_keys(scores: DataFrame) -> list[str]:
    return [k for k in CASE_KEYS if k in scores.columns]


def update_scores(cases: DataFrame, scores: DataFrame, order: str | None = None, updated_at: Column | None = None) -> DataFrame:
    """Set scores by (docket, source), or by docket if the scores have no source."""
    return _set(cases, scores, _score_keys(scores), "quality_score", "quality_score", order, updated_at)


def update_counts(cases: DataFrame, scores: DataFrame) -> DataFrame:
    """One row (given, touched): scores given, and cases that have one of them."""
    keys = _score_keys(scores)
    given = scores.filter(F.col("quality_score").isNotNull())
    known = given.select(*[F.col(k).alias(f"__{k}") for k in keys])
    touched = cases.join(known, _same_key(keys), "left_semi").agg(F.count("*").alias("touched"))
    return given.agg(F.count("*").alias("given")).select("given", touched.scalar().alias("touched"))


def audit_start(run_id: Column, source: Column, stage: str, started_at: Column) -> list[Column]:
    """Columns of the row that opens a run."""
    return [
        F.substring(run_id, 1, 8).alias("run_id"), source.alias("source"),
        F.lit(stage).alias("stage"), F.lit("running").alias("status"),
        F.lit(0).cast("bigint").alias("records_processed"),
        F.lit(0).cast("bigint").alias("records_created"),
        F.lit(0).cast("bigint").alias("records_updated"),
        F.lit(0).cast("bigint").alias("errors"),
        started_at.alias("started_at"), F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit(None).cast("string").alias("notes"),
    ]


def audit_latest(runs: DataFrame) -> DataFrame:
    """Latest state of each run: a completed row replaces the row that opened it."""
    order = F.struct(F.col("completed_at").isNotNull(), F.col("completed_at"))
    rest = [x for x in runs.columns if x not in ("run_id", "started_at")]
    return runs.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        *[F.max_by(x, order).alias(x) for x in rest],
    ).select(*runs.columns)
