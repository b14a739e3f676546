"""What the operators of this subpackage share: stored steps, hashes in numpy, components of links."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffworks.session import shared_folder

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step into the shared folder and go on from what is written.

    The lineage ends there, so that a lost executor costs no more than the step it ran.
    """
    spark = df.sparkSession
    base = shared_folder(spark)
    if base is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = f"{base}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.transform(F.array(value), body)[0]


# Hashes ------------------------------------------------------------------------------------------

_MULTIPLIER = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers of a seed."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_MULTIPLIER) + np.uint64(seed * 1_000_003))


@cache
def _bytes_table() -> np.ndarray:
    return random_numbers(256, 1)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd base, and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(1 << 16, 1 << (n + 1).bit_length())
        for k, base in enumerate((_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def sum_hashes(values: np.ndarray) -> np.ndarray:
    """Prefix sums that `range_hashes` takes differences of."""
    powers, _ = _power_tables(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range of the values below `sums`; equal ranges hash alike wherever they stand."""
    _, inverse = _power_tables(len(sums))
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_numbers(sums: np.ndarray, start: int, n: int, width: int) -> np.ndarray:
    """A number for each of n grams from a place on, equal for equal grams, its high bits well spread."""
    _, inverse = _power_tables(len(sums))
    return (sums[start + width : start + width + n] - sums[start : start + n]) * inverse[start : start + n]


def byte_sums(buffer: np.ndarray) -> np.ndarray:
    return sum_hashes(_bytes_table()[buffer])


@cache
def lower_table() -> np.ndarray:
    """Bytes with A-Z as a-z, all others as they are."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


@cache
def space_table() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[32, *range(9, 14)]] = True
    return out


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[0::2], edges[1::2]


def chunks(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes together; a longer text stands alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if texts:
        yield start, len(texts)


# Components --------------------------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) of all nodes of the links (a, b).

    Alternates the large-star and small-star steps; each is a join with the smallest neighbour of
    a node, so that a node with very many links is an ordinary skewed join side, not one group.
    """
    edges = stored(_stars(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                       F.least("a", "b").alias("b"))), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        edges = stored(_stars(_large_star(edges)), "links")
    roots = edges.groupBy("b").agg(F.lit(1).alias("one")).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _stars(edges: DataFrame) -> DataFrame:
    """The small-star step on edges with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()
