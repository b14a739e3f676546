"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of equally many words.  Slot n has the point n * golden ratio modulo 1;
cumulative target weights map the point to a source, so that every stretch of the schedule holds
the sources near their weights.  The r-th slot of a source takes the r-th block of its documents,
which are shuffled by a keyed hash and laid end to end, again and again if the target asks for more
words than there are.  Blocks of a source for which the points leave no slot have slots of their own
at the end, so that every source gives its whole target.

A very common source is no hot spot: ranks of slots and places of documents are prefix sums over
(source, chunk) groups of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffworks.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
#: A source gives each word at most so many times.
MOST_REPEATS = 3
#: Slots the schedule has at most (and 64 words a slot at least).
SLOTS = 2_000_000
LEAST_BLOCK = 64
#: Slots beyond the share of a source, against rounding: a part of all, and so many for each source.
SLACK, SOURCE_SLACK = 0.02, 64
#: floor(2**32 / golden ratio): the n-th point is n times this modulo 2**32.
_STEP = 2654435769
_CELL_BITS = 22
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size -> with source_no, weight and target.

    Sources by code point, null last, take the weights in turn and share all words; a target stops
    at `most` times the size of its source and the excess goes to the others by weight.  The level
    all of them reach is found with sums over the sources by the level at which each stops.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_stop = Window.orderBy("stop", "source_no")
    levels = (
        sizes.withColumn("source_no", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") - 1) % len(weights) + 1))
        .withColumn("most", F.col("source_size") * most)
        .withColumn("stop", F.col("most") / F.col("weight"))
        .withColumn("below", F.sum("most").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("above", F.sum("weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("level", (F.col("total") - F.coalesce("below", F.lit(0))) / F.col("above"))
        .withColumn("reached", F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "source_no", "level")))
                    .over(Window.partitionBy())["level"])
    )
    return levels.select(
        "source", "source_no", "source_size", "weight",
        F.coalesce(F.least(F.col("most").cast("double"), F.col("weight") * F.col("reached")),
                   F.col("most").cast("double")).alias("target"))


def schedule(sources: DataFrame, block: int, total: int, n_sources: int) -> DataFrame:
    """slot, source_no, rank of the slot within its source; all ranks of the targets are there."""
    spark = sources.sparkSession
    n = int(total / block * (1 + SLACK)) + 1 + SOURCE_SLACK * n_sources
    sums = Window.orderBy("source_no")
    unit = float(1 << 32)
    spans = (
        sources.where("target > 0")
        .withColumn("to", F.sum("target").over(sums.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("all", F.sum("target").over(Window.partitionBy()))
        .select("source_no", F.floor((F.col("to") - F.col("target")) / F.col("all") * unit).alias("lo"),
                F.when(F.col("source_no") == F.max("source_no").over(Window.partitionBy()), F.lit(1 << 32))
                .otherwise(F.floor(F.col("to") / F.col("all") * unit)).alias("hi"))
        .where("lo < hi")
        .withColumn("cell", F.explode(F.sequence(F.shiftright("lo", _CELL_BITS),
                                                 F.shiftright(F.col("hi") - 1, _CELL_BITS))))
    )
    points = (
        spark.range(n).withColumnRenamed("id", "slot")
        .withColumn("point", (F.col("slot").bitwiseAND(F.lit((1 << 31) - 1)) * F.lit(_STEP)) % F.lit(1 << 32))
        .withColumn("cell", F.shiftright("point", _CELL_BITS))
    )
    slots = points.join(spans, "cell").where("point >= lo and point < hi").select(
        "slot", "source_no", F.shiftright("slot", 12).alias("chunk"))
    inside = slots.withColumn("within", F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")))
    before = slots.groupBy("source_no", "chunk").count().withColumn(
        "before", F.sum("count").over(Window.partitionBy("source_no").orderBy("chunk")
                                      .rowsBetween(Window.unboundedPreceding, -1)))
    dealt = inside.join(before, ["source_no", "chunk"]).select(
        "slot", "source_no", (F.coalesce("before", F.lit(0)) + F.col("within") - 1).alias("rank"))

    # Ranks that a source's target asks for and the points do not give.
    given = slots.groupBy("source_no").agg(F.count("*").alias("given"))
    short = (
        sources.select("source_no", F.ceil(F.floor("target") / block).cast("long").alias("asked"))
        .join(given, "source_no", "left").withColumn("given", F.coalesce("given", F.lit(0)))
        .where("asked > given")
        .withColumn("at", F.sum(F.col("asked") - F.col("given")).over(sums.rowsBetween(Window.unboundedPreceding, 0)) - F.col("asked"))
        .withColumn("rank", F.explode(F.sequence(F.col("given"), F.col("asked") - 1)))
    )
    return dealt.unionByName(short.select((F.lit(n) + F.col("at") + F.col("rank")).alias("slot"), "source_no", "rank"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per row of docs (doc_id, text, source): size, source_size, target, taken.

    taken counts the words of the row that the slots take, repeats included; it is the target of a
    source, rounded down, over its rows together.  Null and empty texts have size 0 and give
    nothing.  A null source is a source.  Rows that are equal in doc_id and size are told apart
    arbitrarily, which changes no count but their own.  Other columns are ignored.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(seed)))
    rows = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("key")), "sizes")
    sources = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    total, n_sources = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count("*")).first()
    block = max(LEAST_BLOCK, total // SLOTS)

    # Where each row starts in its source.
    order = Window.partitionBy("source_no", "part").orderBy("key", "size", "doc_id")
    rows = rows.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    rows = rows.withColumn("part", F.substring("key", 1, 3))
    inside = (
        rows.withColumn("nth", F.row_number().over(order))
        .withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    )
    before = rows.groupBy("source_no", "part").agg(F.sum("size").alias("part_size")).withColumn(
        "before", F.sum("part_size").over(Window.partitionBy("source_no").orderBy("part")
                                          .rowsBetween(Window.unboundedPreceding, -1)))
    placed = stored(
        inside.join(before, ["source_no", "part"])
        .withColumn("start", F.coalesce("before", F.lit(0)) + F.col("within"))
        .select("doc_id", "source", "size", "source_no", "source_size", "target", "part", "nth", "start"), "placed")

    # The blocks that each pass over a row covers, up to the target.
    limit = F.floor("target")
    pieces = (
        placed.where("size > 0").withColumn("limit", limit).where("start < limit")
        .withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"),
                                                 F.floor((F.col("limit") - F.col("start") - 1) / F.col("source_size")))))
        .withColumn("from", F.col("turn") * F.col("source_size") + F.col("start"))
        .withColumn("to", F.least(F.col("from") + F.col("size"), F.col("limit")))
        .withColumn("rank", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))))
        .withColumn("words", F.least("to", (F.col("rank") + 1) * block) - F.greatest("from", F.col("rank") * block))
        .select("source_no", "rank", "part", "nth", "words")
    )
    taken = (
        pieces.join(schedule(sources, block, total, n_sources), ["source_no", "rank"])
        .groupBy("source_no", "part", "nth").agg(F.sum("words").alias("taken"))
    )
    return placed.join(taken, ["source_no", "part", "nth"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mix takes it: the words taken over its size, rounded half up.

    Rows equal in doc_id and size share what is taken of them.  Texts without words go.
    """
    copies = (
        mix(docs.select("doc_id", "text", "source"), **options).where("taken > 0")
        .groupBy(F.col("doc_id").alias("mix_id"), F.col("size").alias("mix_size"))
        .agg(F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("mix_copies"))
        .where("mix_copies > 0")
    )
    rows = docs.select(F.col("doc_id").alias("row_id"), n_words(F.col("text")).alias("words"), F.struct(*docs.columns).alias("doc"))
    joined = rows.join(copies, F.col("row_id").eqNullSafe(F.col("mix_id")) & (F.col("words") == F.col("mix_size")))
    return joined.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select("doc.*")
