"""Raw batches arriving as files, kept as a table of changes.

Rewriting the whole case table for every small batch would not scale, so each
micro-batch appends one folded row per key under its own number, and the
current table is the fold of all of them.  The fold keeps the last non-null
value per column, which gives the same result in any grouping, so batches can be
folded together later (:func:`compact`) without changing what is read.

A batch that is run again after a failure overwrites its own folder.  There are
no event-time semantics here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tariffworks.operators.extract import parse_record
from tariffworks.operators.merge import CASE_KEYS, fold_batch
from tariffworks.schemas import RAW_RECORD


def write_changes(batch: DataFrame, batch_id: int, path: str) -> None:
    """Parse one batch of raw records and store its effect."""
    placed = batch.withColumn(
        "seq", F.struct("seq", F.monotonically_increasing_id().alias("place"))
    )
    cases, rejects = parse_record(placed)
    folded = fold_batch(cases, CASE_KEYS, "seq")
    folded.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
    rejects.drop("seq").write.mode("overwrite").parquet(f"{path}/rejects/batch={batch_id}")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The case table as of the last stored batch."""
    return fold_batch(spark.read.parquet(f"{path}/changes"), CASE_KEYS, "batch")


def compact(spark: SparkSession, path: str, target: str, batch: int) -> None:
    """Fold all changes up to a batch into one batch of a new folder."""
    upto = spark.read.parquet(f"{path}/changes").filter(F.col("batch") <= batch)
    fold_batch(upto, CASE_KEYS, "batch").write.mode("overwrite").parquet(
        f"{target}/changes/batch={batch}"
    )


def stream_ingest(spark: SparkSession, raw_path: str, path: str, checkpoint: str,
                  max_files: int = 1000) -> StreamingQuery:
    """Start reading JSON-lines files of raw records as they arrive."""
    raw = (
        spark.readStream.schema(RAW_RECORD).option("maxFilesPerTrigger", max_files)
        .json(raw_path)
        .withColumn("seq", F.struct(
            F.col("_metadata.file_modification_time").alias("at"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        ))
    )
    return (
        raw.writeStream.foreachBatch(lambda df, batch_id: write_changes(df, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
