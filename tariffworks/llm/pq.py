"""Near-duplicate vectors by product quantisation.

A bounded sample trains coarse centroids and, for each of several subspaces, a codebook of
residuals.  Every vector is put into the inverted list of its nearest centroid as the codes of its
residual.  As a query it probes every list that a vector within the threshold's angle can be in;
no link is lost by it.  Products of a block of queries with what the codes of a list stand for are
one matrix product; what the triangle inequality of angles leaves is compared by cosine in double
precision.

Lists are stored as blocks, with the lists that any vector of the block probes.  Two blocks meet
where each probes the other's list: tasks read the stored blocks pair by pair, so that however many
lists a vector probes, it is shuffled and stored once.  A task counts links and keeps spanning ones.
Equal vectors are one vector with a count.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffworks.llm.common import components, stored

LIKE = 0.9
#: Vectors a model is trained on at most, drawn by hash, and the bytes they may take.
SAMPLE, SAMPLE_BYTES = 20_000, 32_000_000
#: Vectors a list holds on average, and lists at most.
LIST, LISTS = 1000, 16_384
SUBSPACES, CODES, ROUNDS = 8, 64, 10
#: Against rounding, in cosines and distances.
ROUNDING = 1e-9
#: Numbers of the pairs of vectors that are multiplied at once to be confirmed.
PAIR_NUMBERS = 1 << 21
#: Vectors of a block, and queries that are multiplied with a block at once.
MEMBERS, QUERIES = 1024, 256
#: Bytes of pairs of blocks that are handed to a worker at once.
PAIR_BYTES = "32m"
#: Distances that differ by less are compared without rounding.
TIE = 1e-9


class Model:
    """Centroids and codebooks (subspace, code, component)."""

    def __init__(self, centroids: np.ndarray, books: list[np.ndarray]):
        self.centroids, self.books = centroids, books

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, less the squared length of x."""
        return (self.centroids**2).sum(1) - 2 * x @ self.centroids.T

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid, which is the same for equal vectors whatever others stand beside them."""
        d = self.distances(x)
        near = d.argmin(1)
        close = d <= d[np.arange(len(x)), near][:, None] + TIE
        for i in np.flatnonzero(close.sum(1) > 1):
            own = np.flatnonzero(close[i])
            exact = [math.fsum(np.concatenate((c * c, -2 * (x[i] * c)))) for c in self.centroids[own]]
            near[i] = own[int(np.argmin(exact))]
        return near

    def probed(self, x: np.ndarray, own: int, like: float, lists: slice = slice(None)) -> np.ndarray:
        """For each unit vector x of list own and each of the lists, whether a unit vector y with x @ y >= like can be in it.

        y is nearer to centroid c than to the own one o of x only if y @ (c - o) >= (c @ c - o @ o) / 2;
        the largest such product in the cap around x is known.
        """
        centroids, centroid = self.centroids[lists], self.centroids[own]
        squares, own = (centroids**2).sum(1), (centroid**2).sum()
        along = x @ centroids.T - (x @ centroid)[:, None]
        apart = np.maximum(squares + own - 2 * centroids @ centroid, 0)
        cos = max(-1.0, like - ROUNDING)
        edge = cos * along + np.sqrt(1 - cos * cos) * np.sqrt(np.maximum(apart - along**2, 0))
        most = np.where(along >= cos * np.sqrt(apart), np.sqrt(apart), edge)
        return most >= (squares - own) / 2 - ROUNDING

    def coded(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far they are off."""
        rest, codes, off = x - self.centroids[lists], [], np.zeros(len(x))
        for part, book in zip(np.array_split(np.arange(x.shape[1]), len(self.books)), self.books, strict=True):
            d = (book**2).sum(1) - 2 * rest[:, part] @ book.T
            code = d.argmin(1)
            codes.append(code)
            off += ((rest[:, part] - book[code]) ** 2).sum(1)
        return np.array(codes, np.uint8).T, off


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([((centres**2).sum(1) - 2 * x[i : i + 4096] @ centres.T).argmin(1) for i in range(0, len(x), 4096)])
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def train(sample: np.ndarray, n: int) -> Model:
    """A model for n vectors from a sample of unit vectors."""
    rng = np.random.default_rng(1)
    lists = max(1, min(LISTS, n // LIST, len(sample) // 4))
    centroids = _means(sample, lists, rng)
    model = Model(centroids, [])
    near = model.distances(sample).argmin(1)
    rest = sample - centroids[near]
    parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
    model.books = [_means(rest[:, p], CODES, rng) for p in parts]
    return model


# Vectors -----------------------------------------------------------------------------------------

def _numbers(column: pd.Series) -> np.ndarray:
    """Vectors of one length; adding 0 makes -0 equal to 0, as they are in a key."""
    return np.stack(column).astype(np.float64) + 0.0


def _digests(x: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x]


def _raw(x: np.ndarray) -> list[bytes]:
    """Vectors in half the bytes, if these hold the same numbers."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    same = (short == x).all(1)
    return [(a if s else b).tobytes() for a, b, s in zip(short, x, same, strict=True)]


def _matrix(column: list[bytes], dim: int) -> np.ndarray:
    """The vectors that `_raw` wrote."""
    out = np.empty((len(column), dim))
    for kind in (np.float32, np.float64):
        which = [i for i, r in enumerate(column) if len(r) == dim * kind().itemsize]
        out[which] = np.frombuffer(b"".join(column[i] for i in which), kind).reshape(-1, dim)
    return out


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """vec_id, digest and length of vectors."""
    for batch in batches:
        digests = [_digests(np.asarray(v, np.float64)[None] + 0.0)[0] for v in batch["vector"]]
        yield pd.DataFrame({"vec_id": batch["vec_id"], "digest": digests, "dim": [len(v) for v in batch["vector"]]})


def _drawn(last: bytes):
    """Vectors whose digests come up to the last one."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _numbers(batch["vector"])
                found = {d: r for d, r in zip(_digests(x), x, strict=True) if d <= last}
                yield pd.DataFrame({"digest": list(found), "raw": _raw(np.array(list(found.values())).reshape(-1, x.shape[1]))})

    return run


def _listed(model: Model, parts: np.ndarray):
    """The vectors of a batch with their lists, equal ones once; large lists in several parts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 4096):
                part = batch.iloc[i : i + 4096]
                x = _numbers(part["vector"])
                rows = pd.DataFrame({"digest": _digests(x), "vec_id": part["vec_id"].to_numpy(), "at": np.arange(len(x))})
                own = rows.groupby("digest", sort=False).agg(at=("at", "min"), vec_id=("vec_id", "min"), n=("at", "size"))
                x = x[own["at"]]
                lists = np.concatenate([model.nearest(_unit(x[k : k + 256])) for k in range(0, len(x), 256)])
                yield pd.DataFrame({
                    "list": lists, "part": [int.from_bytes(d[:4], "big") % parts[k] for d, k in zip(own.index, lists, strict=True)],
                    "digest": own.index, "vec_id": own["vec_id"].to_numpy(), "n": own["n"].to_numpy(), "raw": _raw(x)})

    return run


# Blocks ------------------------------------------------------------------------------------------

_BLOCK = "list int, head binary, ids binary, counts binary, vectors binary, codes binary, off binary, probes array<long>"


def _block(model: Model, dim: int, like: float, key: int, rows: list[list]) -> dict:
    """One row for vectors (digest, vec_id, n, raw) of a list: codes of the residuals, and which lists any of them probes."""
    vectors = _matrix([r[3] for r in rows], dim)
    x, short = _unit(vectors), all(len(r[3]) == 4 * dim for r in rows)
    codes, off = model.coded(x, np.full(len(x), key))
    bits = np.zeros(-(-len(model.centroids) // 64) * 64, bool)
    for i in range(0, len(x), 256):
        bits[: len(model.centroids)] |= model.probed(x[i : i + 256], key, like).any(0)
    return {
        "list": key, "head": rows[0][0], "ids": np.array([r[1] for r in rows], np.int64).tobytes(),
        "counts": np.array([r[2] for r in rows], np.int64).tobytes(),
        "vectors": vectors.astype(np.float32 if short else np.float64).tobytes(), "codes": codes.tobytes(),
        "off": off.tobytes(), "probes": np.packbits(bits, bitorder="little").view(np.int64)}


def _packed(model: Model, dim: int, like: float, members: int):
    """Blocks of rows in the order of their lists, parts and digests."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list] = []
        place = None
        for batch in batches:
            out = []
            for key, part, digest, vec_id, n, raw in batch.itertuples(index=False, name=None):
                if place == (key, part) and held[-1][0] == digest:
                    held[-1][1:3] = min(held[-1][1], vec_id), held[-1][2] + n
                    continue
                if held and (place != (key, part) or len(held) == members):
                    out.append(_block(model, dim, like, place[0], held))
                    held = []
                place = key, part
                held.append([digest, vec_id, n, raw])
            if out:
                yield pd.DataFrame(out)
        if held:
            yield pd.DataFrame([_block(model, dim, like, place[0], held)])

    return run


class Block(NamedTuple):
    """A block as it is read: unit vectors, what the codes stand for, and the least product of a near vector with that."""

    list: int
    head: bytes
    ids: np.ndarray
    counts: np.ndarray
    units: np.ndarray
    rough: np.ndarray
    coded: np.ndarray
    least: np.ndarray

    def some(self, which: np.ndarray) -> Block:
        return self if which.all() else Block(self.list, self.head, *(v[which] for v in self[2:]))


def _read(model: Model, dim: int, like: float, key: int, head: bytes, ids: bytes, counts: bytes, vectors: bytes, codes: bytes,
          off: bytes) -> Block:
    ids = np.frombuffer(ids, np.int64)
    x = _unit(np.frombuffer(vectors, np.float32 if len(vectors) == 4 * dim * len(ids) else np.float64).reshape(-1, dim).astype(np.float64))
    codes, eps = np.frombuffer(codes, np.uint8).reshape(len(ids), -1), np.finfo(np.float32).eps
    # Products with what the codes stand for are sums over the subspaces; one matrix product makes them all.
    coded = model.centroids[key] + np.hstack([book[codes[:, s]] for s, book in enumerate(model.books)])
    squares = (coded**2).sum(1)
    least = _least_product(squares, np.frombuffer(off, np.float64), np.arccos(np.clip(like, -1, 1)))
    least = least - 2 * (dim + 4) * eps * (1 + squares) - ROUNDING
    return Block(key, bytes(head), ids, np.frombuffer(counts, np.int64), x, x.astype(np.float32), coded.astype(np.float32),
                 least.astype(np.float32))


def _least_product(squares: np.ndarray, off: np.ndarray, apart: float) -> np.ndarray:
    """Least product of the code of a unit vector with a unit vector at most this angle apart from it.

    By the triangle inequality of angles; squares are the squared lengths of the codes, off their squared distances.
    """
    size = np.sqrt(squares)
    along = np.divide((1 + squares - off) / 2, size, out=np.ones(len(size)), where=size > 0)
    return size * np.cos(np.minimum(np.arccos(np.clip(along, -1, 1)) + apart, np.pi))


def _links(model: Model, like: float, queries: int, one: Block, two: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids with links between two blocks (or within one), the vectors they link with, and the smallest id they are joined to."""
    same = one.head == two.head
    if one.list != two.list:
        q = one.some(model.probed(one.units, one.list, like, slice(two.list, two.list + 1))[:, 0])
        m = two.some(model.probed(two.units, two.list, like, slice(one.list, one.list + 1))[:, 0])
    else:
        q, m = one, two
    exact, coded, first, second = max(1, PAIR_NUMBERS // one.units.shape[1]), m.coded.T, [], []
    for i in range(0, len(q.ids) if len(m.ids) else 0, queries):
        a, b = np.nonzero(q.rough[i : i + queries] @ coded >= m.least)
        a += i
        other = q.ids[a] != m.ids[b]
        a, b = a[other], b[other]
        near = np.zeros(len(a), bool)
        for k in range(0, len(a), exact):
            near[k : k + exact] = np.einsum("ij,ij->i", q.units[a[k : k + exact]], m.units[b[k : k + exact]]) >= like
        first.append(a[near])
        second.append(b[near])
    if not sum(map(len, first)):
        return (np.zeros(0, np.int64),) * 3
    a, b = np.concatenate(first), np.concatenate(second)
    nodes, at = np.unique(np.concatenate((q.ids[a], m.ids[b])), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    found = np.zeros(len(nodes), np.int64)
    np.add.at(found, u, m.counts[b])
    if not same:
        np.add.at(found, v, q.counts[a])
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        if (label[u] == least).all() and (label[v] == least).all():
            return nodes, found, nodes[label]
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        label = label[label]


def _matched(model: Model, dim: int, like: float, queries: int):
    """Counts of linked vectors and spanning links of pairs of blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = None
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False, name=None):
                if one is None or one.head != row[1]:
                    one = _read(model, dim, like, *row[:7])
                two = one if one.head == row[8] else _read(model, dim, like, *row[7:])
                links = _links(model, like, queries, one, two)
                if len(links[0]):
                    found.append(links)
            if found:
                ids, linked, labels = (np.concatenate(x) for x in zip(*found, strict=True))
                rows = pd.DataFrame({"vec_id": ids, "linked": labels, "found": linked})
                yield rows.groupby(["vec_id", "linked"], as_index=False)["found"].sum()[["vec_id", "found", "linked"]]

    return run


def _linked(known: DataFrame, classes: DataFrame, dim: int, like: float) -> DataFrame:
    """vec_id, found, linked of distinct vectors (known: vec_id, vector; classes: digest, first, n) of one length."""
    spark = known.sparkSession
    few = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * dim)))
    n = classes.count()
    last = classes.select("digest").orderBy("digest").limit(few).agg(F.max("digest")).first()[0]
    drawn = known.mapInPandas(_drawn(bytes(last)), "digest binary, raw binary").groupBy("digest").agg(F.first("raw").alias("raw")).collect()
    sample = _unit(_matrix([bytes(r[1]) for r in sorted(drawn)], dim))
    model = train(sample, n)
    share = np.bincount(model.nearest(sample), minlength=len(model.centroids)) / len(sample)
    parts = np.maximum(1, np.ceil(share * n / (4 * MEMBERS))).astype(np.int64)

    listed = known.mapInPandas(_listed(model, parts), "list int, part int, digest binary, vec_id long, n long, raw binary")
    blocks = stored(
        listed.repartition("list", "part").sortWithinPartitions("list", "part", "digest")
        .mapInPandas(_packed(model, dim, like, MEMBERS), _BLOCK), "blocks")

    columns = [c for c in blocks.columns if c != "probes"]
    one, two = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in ("one", "two"))
    probes = "bit_get({0}_probes[cast({1}_list div 64 as int)], {1}_list % 64) = 1"
    meet = F.expr(" and ".join(("one_head <= two_head", probes.format("one", "two"), probes.format("two", "one"))))
    pairs = one.join(two, meet).select(*[f"{side}_{c}" for side in ("one", "two") for c in columns])
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, PAIR_BYTES)
    try:
        return stored(pairs.mapInPandas(_matched(model, dim, like, QUERIES), "vec_id long, found long, linked long"), "linked")
    finally:
        spark.conf.set(limit, before)


def near_vectors(vectors: DataFrame, like: float = LIKE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding).

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
    vectors of different lengths do not link.  vec_id tells rows apart; rows repeated in vec_id
    and vector count as each other's copies, a null vec_id links with nothing.  Other columns are
    ignored.  No rows give no rows.
    """
    spark: SparkSession = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = (F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
             & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
             & F.exists("vector", lambda x: x != 0))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    known = rows.where("sound").select("vec_id", "vector")
    # Equal vectors are told by a digest of 128 bits: nothing but blocks of lists holds vectors.
    keys = stored(known.mapInPandas(_keyed, "vec_id long, digest binary, dim int"), "keys")
    classes = stored(keys.groupBy("digest", "dim").agg(F.min("vec_id").alias("first"), F.count("*").alias("n")), "classes")
    lengths = [r[0] for r in classes.select("dim").distinct().collect()]
    parts = [_linked(known.where(F.size("vector") == d), classes.where(F.col("dim") == d), d, like) for d in sorted(lengths)]
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    linked = parts[0]
    for more in parts[1:]:
        linked = linked.unionByName(more)
    counts = linked.groupBy("vec_id").agg(F.sum("found").alias("found")).withColumnRenamed("vec_id", "first")
    reach = components(linked.where("linked <> vec_id").select(F.col("vec_id").alias("a"), F.col("linked").alias("b")).distinct())
    named = (
        classes.join(counts, "first", "left").join(reach.withColumnRenamed("node", "first"), "first", "left")
        .select("digest", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "first").alias("component_id")))
    sound_rows = keys.join(named, "digest").select("vec_id", "n_links", "component_id")
    others = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return sound_rows.unionByName(others).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
