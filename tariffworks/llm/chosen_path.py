"""Near-duplicate documents by a chosen-path set-similarity join.

A document is the set of its 5-word shingles.  Tasks reduce a set to a sketch of minwise tokens.
Each of several independent trees branches the documents: a node picks coordinates of the sketch,
and a document goes to the child of its token there.  Documents that fall into a small node are
compared exhaustively by their sketches; a large node compares all its documents once with two pivots,
central ones of a part of it, is done if these tie all of them, and otherwise lets go those close to
one (whatever is similar to them is then fairly similar to the pivot, by the triangle inequality of
Jaccard distance, and has been tied to it) and branches the rest further.

What ties documents together so far are loose similarities, kept as spanning links.  Their
components are the groups in which links are then confirmed on full sets: a small group meets in
one task, a large one is compared with a pivot and only what that leaves open in blocks.

Copies (equal sets) are one document from the start.  Exact similarity alone decides a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffworks.llm.common import (
    byte_sums, chunks, components, lower_table, mixed, random_numbers, range_hashes, runs, space_table, stored,
    sum_hashes,
)

SHINGLE = 5
#: Links have 100 * intersection >= 75 * union.
SIMILAR = 75
#: Tokens of a sketch, 32 bits each (8 bits suffice where sketches are only compared).
TOKENS = 64
#: Trees and the coordinates a large node branches on.  A pair at the threshold misses one tree's
#: first level with probability 1/4, all ten with one in a million; two coordinates a level keep
#: 15 of 16 such pairs in each tree from level to level.
TREES, BRANCHES, LEVELS = 10, 2, 3
#: Documents that are compared exhaustively at once.
SMALL = 256
#: Sketch similarities (shares of equal tokens): loose enough for a pair at the threshold to pass
#: but once in ten thousand, for the bound by the pivot (by level: what still shares a deeper node is
#: tied more readily, since a tie too many is only one more document to confirm), and close enough to
#: leave a large node.
LOOSE, TIED, CLOSE = 0.55, (0.45, 0.35, 0.25, 0.15), 0.85
#: Documents of a large node that its pivots are chosen among, about.
CHOSEN = 64
#: Shingles of the documents that meet in one task to be confirmed.
GROUP_SHINGLES = 2_000_000
BLOCK = 64

_COORDINATES = random_numbers(TOKENS, 6)


# Sets --------------------------------------------------------------------------------------------

def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for a, b in chunks(texts):
        part = texts[a:b]
        buffer = lower_table()[np.frombuffer(b" ".join(part) + b" ", np.uint8)]
        starts, ends = runs(~space_table()[buffer])
        firsts = np.cumsum([0, *(len(t) + 1 for t in part)])
        cuts = np.searchsorted(starts, firsts)
        words = range_hashes(byte_sums(buffer), starts, ends)
        sums = sum_hashes(words)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo >= SHINGLE:
                at = np.arange(lo, hi - SHINGLE + 1)
                yield np.unique(range_hashes(sums, at, at + SHINGLE))
            elif hi > lo:
                yield range_hashes(sums, np.array([lo]), np.array([hi]))
            else:
                yield np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """TOKENS minwise tokens, folded to 32 bits."""
    least = np.full(TOKENS, np.uint64(2**64 - 1))
    for i in range(0, len(shingles), 4096):
        part = (shingles[None, i : i + 4096] ^ _COORDINATES[:, None]) * (_COORDINATES[:, None] | np.uint64(1))
        np.minimum(least, part.min(1), out=least)
    return (mixed(least) >> np.uint64(32)).astype("<u4")


def _bytes(texts: pd.Series) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (which stand for the set), tokens, brief (tokens of 8 bits)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shingles in shingle_sets(_bytes(batch["text"])):
                with np.errstate(over="ignore"):
                    one, two = int(shingles.sum()), int(mixed(shingles ^ _COORDINATES[0]).sum())
                tokens = sketch(shingles)
                rows.append((len(shingles), one - (1 << 63), two - (1 << 63), tokens.tobytes(),
                             tokens.astype(np.uint8).tobytes()))
            out = pd.DataFrame(rows, columns=["n_shingles", "set_a", "set_b", "tokens", "brief"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out.astype({"doc_id": "Int64"})

    schema = "doc_id long, n_shingles long, set_a long, set_b long, tokens binary, brief binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)


# Trees -------------------------------------------------------------------------------------------

def _tokens(column: pd.Series) -> np.ndarray:
    raw = b"".join(column)
    kind = np.dtype("u1") if len(raw) == TOKENS * len(column) else np.dtype("<u4")
    return np.frombuffer(raw, kind).reshape(-1, TOKENS)


def _planted(sketches: DataFrame) -> DataFrame:
    """node, doc_id: the first level of all trees, each on a coordinate of its own."""
    at = np.argsort(random_numbers(TOKENS, 7), kind="stable")[:TREES]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = _tokens(batch["tokens"]).astype(np.uint64)
            for c in at:
                node = mixed(tokens[:, c] + np.uint64(int(c + 1) << 33))
                yield pd.DataFrame({"node": node.view(np.int64), "doc_id": batch["doc_id"]})

    return sketches.select("doc_id", "tokens").mapInPandas(run, "node long, doc_id long")


def _branched(rows: DataFrame) -> DataFrame:
    """node, doc_id: each document in the children of its node (node, doc_id, tokens)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, parents = _tokens(batch["tokens"]), batch["node"].to_numpy().view(np.uint64)
            for k in range(BRANCHES):
                at = (mixed(parents + np.uint64(k + 1)) % np.uint64(TOKENS)).astype(int)
                token = tokens[np.arange(len(at)), at].astype(np.uint64)
                node = mixed(parents ^ mixed(token + np.uint64(k + 1 << 33)))
                yield pd.DataFrame({"node": node.view(np.int64), "doc_id": batch["doc_id"]})

    return rows.mapInPandas(run, "node long, doc_id long")


def _spanning(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the linked pairs (places a, b): ids and, for each, the smallest id it reaches."""
    label = ids.copy()
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        if (label == before).all():
            break
    moved = label != ids
    return ids[moved], label[moved]


def _compared(group: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of the documents of a small node (or of two blocks of a large one)."""
    group = group.drop_duplicates("doc_id")
    ids, tokens = group["doc_id"].to_numpy(), _tokens(group["brief"])
    a, b = [], []
    for i in range(len(ids) - 1):
        near = np.flatnonzero((tokens[i + 1 :] == tokens[i]).mean(1) >= LOOSE)
        a.append(np.full(len(near), i))
        b.append(near + i + 1)
    if not a:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    x, y = _spanning(ids, np.concatenate(a), np.concatenate(b))
    return pd.DataFrame({"a": x, "b": y})


def _equal_tokens(a: str, b: str):
    @F.pandas_udf("double")
    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series((_tokens(x) == _tokens(y)).mean(1) if len(x) else [], dtype="float64")

    return share(a, b)


def _central(group: pd.DataFrame) -> pd.DataFrame:
    """The document most like the others, and of those it does not tie (or the least tied one) the same."""
    group = group.drop_duplicates("doc_id").sort_values("doc_id")
    tokens = _tokens(group["tokens"])
    shares = np.stack([(tokens == t).mean(1) for t in tokens])
    pivot = int(shares.sum(0).argmax())
    apart = np.flatnonzero(shares[pivot] < TIED[0])
    following = int(apart[shares[np.ix_(apart, apart)].sum(0).argmax()]) if len(apart) else int(shares[pivot].argmin())
    ids, raw = group["doc_id"].to_numpy(), group["tokens"].to_numpy()
    return pd.DataFrame({"node": [group["node"].iloc[0]], "pivot": [ids[pivot]], "pivot_tokens": [raw[pivot]],
                         "next": [ids[following]], "next_tokens": [raw[following]]})


def _pivots(nodes: DataFrame, large: DataFrame, tokens: DataFrame) -> DataFrame:
    """Two pivots and their tokens for each large node (node, n, last), chosen among some of its documents."""
    some = F.pmod(F.xxhash64("doc_id"), F.floor(F.col("n") / CHOSEN)) == 0
    asked = nodes.join(large.withColumnRenamed("node", "large"), (F.col("node") == F.col("large"))
                       & (some | (F.col("doc_id") == F.col("last")))).select("node", "doc_id")
    return _dealt(asked.join(tokens, "doc_id"), "node").groupBy("node").applyInPandas(
        _central, "node long, pivot long, pivot_tokens binary, next long, next_tokens binary")


def _left(against: DataFrame, enough: float) -> DataFrame:
    """node, doc_id of what may be like a document that is not tied to the same pivot.

    Shares of equal tokens keep the triangle inequality: a document so much closer to a pivot than all that
    are not tied is like none of them, and it is tied to all others.
    """
    tied, next_tied = F.col("share") >= enough, F.col("next_share") >= enough
    far = against.groupBy("node").agg(
        F.max(tied & next_tied).alias("one"), *[F.max(F.when(which, F.col(share))).alias(name) for name, which, share in (
            ("apart", ~tied & ~next_tied, "share"), ("next_apart", ~tied & ~next_tied, "next_share"),
            ("other", ~tied, "share"), ("next_other", ~next_tied, "next_share"))])
    # Where a document is tied to both pivots, all that are tied are one group.  Where nothing is apart, all go.
    apart, next_apart = (F.when(F.col("one"), F.col(x)).otherwise(F.col(y)) for x, y in (("apart", "other"), ("next_apart", "next_other")))
    bounds = far.where(apart.isNotNull() & next_apart.isNotNull()).select(
        "node", F.least(F.lit(CLOSE), apart + (1 - LOOSE)).alias("bound"),
        F.least(F.lit(CLOSE), next_apart + (1 - LOOSE)).alias("next_bound"))
    return against.join(bounds, "node").where(
        (F.col("share") < F.col("bound")) & (F.col("next_share") < F.col("next_bound"))).select("node", "doc_id")


def loose_links(sketches: DataFrame) -> DataFrame:
    """Spanning links (a, b) of the documents (doc_id, tokens, brief) that the trees find alike."""
    tokens, brief = sketches.select("doc_id", "tokens"), sketches.select("doc_id", "brief")
    found, level = [], 0
    nodes = stored(_planted(tokens), "nodes0")
    while True:
        sizes = stored(
            nodes.groupBy("node").agg(
                F.count("*").alias("n"), F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last"),
                F.bit_xor(F.xxhash64("doc_id")).alias("members"))
            .where("n > 1"), f"sizes{level}")
        # Trees often agree: one of the nodes with the same documents is enough where all are compared.
        small = sizes.where(F.col("n") <= SMALL).groupBy("n", "pivot", "last", "members").agg(F.min("node").alias("node"))
        compared = nodes.join(small.select("node"), "node").join(brief, "doc_id")
        found.append(stored(_dealt(compared, "node").groupBy("node").applyInPandas(_compared, "a long, b long").distinct(), f"small{level}"))
        large = sizes.where(F.col("n") > SMALL).select("node", "n", "last")
        if large.isEmpty():
            break
        against = stored(
            nodes.join(_pivots(nodes, large, tokens), "node").join(tokens, "doc_id")
            .withColumn("share", _equal_tokens("tokens", "pivot_tokens"))
            .withColumn("next_share", _equal_tokens("tokens", "next_tokens"))
            .select("node", "doc_id", "pivot", "share", "next", "next_share"), f"pivots{level}")
        for pivot, share in (("pivot", "share"), ("next", "next_share")):
            found.append(against.where((F.col(share) >= TIED[level]) & (F.col("doc_id") != F.col(pivot)))
                         .select(F.col("doc_id").alias("a"), F.col(pivot).alias("b")).distinct())
        rest = _left(against, TIED[level])
        level += 1
        if level > LEVELS:
            blocks = _in_blocks(rest.join(brief, "doc_id"), ["node"], _compared, "a long, b long")
            found.append(stored(blocks.distinct(), "blocks"))
            break
        nodes = stored(_branched(rest.join(tokens, "doc_id")), f"nodes{level}")
        if nodes.isEmpty():
            break
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct()


def _in_blocks(rows: DataFrame, keys: list[str], compare, schema: str) -> DataFrame:
    """compare() on every two blocks of the rows of a key: the exact way for what stays together.

    A key's blocks are as many as its rows ask for, so that two blocks always fit a task.
    """
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(SMALL)).cast("int").alias("blocks"))
    dealt = (
        rows.join(sizes, keys)
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    )
    return dealt.groupBy(*keys, "low", "high").applyInPandas(compare, schema)


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key together, over all shuffle partitions: little data may be much work."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


# Confirmation ------------------------------------------------------------------------------------

def _sets(docs: DataFrame) -> DataFrame:
    """Columns of docs with the shingles of text (sorted 64-bit hashes) in its place."""
    @F.pandas_udf("binary")
    def shingles(text: pd.Series) -> pd.Series:
        return pd.Series([s.tobytes() for s in shingle_sets(_bytes(text))], dtype=object)

    return docs.withColumn("shingles", shingles("text")).drop("text")


class _Sets:
    """Sets of a group, their hashes numbered, so that one set meets all others at once."""

    def __init__(self, packed: pd.Series):
        sets = [np.frombuffer(s, np.uint64) for s in packed]
        self.sizes = np.array([len(s) for s in sets])
        self.names, self.flat = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.cuts = np.concatenate(([0], np.cumsum(self.sizes)))

    def linked(self, numbers: np.ndarray, size: int) -> np.ndarray:
        """The sets that link with a set of `size` of which these numbers are known."""
        marked = np.zeros(len(self.names), bool)
        marked[numbers] = True
        both = np.bincount(self.owner[marked[self.flat]], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= SIMILAR * (self.sizes + size - both))

    def of(self, i: int) -> np.ndarray:
        return self.flat[self.cuts[i] : self.cuts[i + 1]]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of those of the hashes that any set holds."""
        if not len(self.names):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.names, hashes), len(self.names) - 1)
        return at[self.names[at] == hashes]


class _Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)


def _confirmed(group: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of a group by full sets."""
    group = group.drop_duplicates("doc_id").sort_values("doc_id")
    ids = group["doc_id"].to_numpy()
    sets, union, out = _Sets(group["shingles"]), _Union(len(ids)), []
    for i in range(len(ids)):
        for j in sets.linked(sets.of(i), sets.sizes[i]):
            if j > i and union.root(i) != union.root(j):
                union.join(i, j)
                out.append((ids[j], ids[i]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def confirmed_links(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) by full sets of docs (doc_id, text) within groups (doc_id, cluster, n_shingles, brief).

    They join what all links of a group would join.
    """
    sizes = groups.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    small = (F.col("n") <= BLOCK) & (F.col("weight") <= GROUP_SHINGLES)
    sized = groups.join(sizes, "cluster").withColumn("small", small).select("doc_id", "cluster", "small", "brief")
    texts = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    sets = stored(_sets(texts.join(sized, "doc_id")), "sets")
    links = stored(_dealt(sets.where("small").select("doc_id", "cluster", "shingles"), "cluster").groupBy("cluster")
                   .applyInPandas(_confirmed, "a long, b long"), "confirmed")
    large = sets.where("not small")
    if large.isEmpty():
        return links

    # The pivot of a large group is its document closest to the most common tokens.
    listed = large.select("cluster", "doc_id", "brief", F.hex("brief").alias("digits"))
    common = listed.groupBy("cluster").agg(F.unhex(F.concat(*[
        F.mode(F.substring("digits", 2 * at + 1, 2), True) for at in range(TOKENS)])).alias("common"))
    pivots = (
        listed.join(common, "cluster").withColumn("share", _equal_tokens("brief", "common"))
        .groupBy("cluster").agg(F.max_by("doc_id", F.struct("share", -F.col("doc_id"))).alias("doc_id"))
    )
    pivots = large.join(pivots, ["cluster", "doc_id"]).dropDuplicates(["cluster"]).select(
        "cluster", F.col("doc_id").alias("pivot"), F.col("shingles").alias("pivot_shingles"))

    @F.pandas_udf("double")
    def distance(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for s, t in zip(x, y, strict=True):
            a, b = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked = 100 * both >= SIMILAR * (len(a) + len(b) - both)
            out.append(0.0 if len(a) + len(b) == 0 else (1 - both / (len(a) + len(b) - both)) * (-1 if linked else 1))
        return pd.Series(out, dtype="float64")

    # Linked ones have a distance below or at zero here, its sign turned.
    measured = stored(large.join(pivots, "cluster").withColumn("distance", distance("shingles", "pivot_shingles"))
                      .select("cluster", "doc_id", "pivot", "distance"), "distances")
    star = measured.where("distance <= 0 and doc_id <> pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"))
    nearest = measured.where("distance > 0").groupBy("cluster").agg(F.min("distance").alias("nearest"))
    # Whatever is linked to an open document is at most so much closer to the pivot (less a rounding error).
    reach = 1 - SIMILAR / 100 + 1e-9
    left = measured.join(nearest, "cluster").where(F.abs("distance") >= F.col("nearest") - reach).select(
        "cluster", "doc_id", (F.col("distance") > 0).alias("open"))
    rest = large.select("cluster", "doc_id", "shingles").join(left, ["cluster", "doc_id"])
    more = stored(_open_blocks(rest), "open")
    return links.unionByName(star).unionByName(more)


def _open_blocks(rows: DataFrame) -> DataFrame:
    """Confirmed links of the open rows of a cluster with all its rows, in blocks.

    Rows that are not open are linked to their pivot already; two of them never meet.
    """
    sizes = rows.groupBy("cluster").agg(
        F.greatest(F.ceil(F.sum(F.col("open").cast("int")) / BLOCK), F.lit(1)).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "cluster")
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    spread = dealt.groupBy("cluster").agg(F.ceil(F.count("*") / (4 * BLOCK)).cast("int").alias("shares"))
    dealt = dealt.join(spread, "cluster")
    share = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("shares")).cast("int")
    # A task has one block of open rows and one share of all rows.
    opened = dealt.where("open").withColumn("block", own).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).withColumn("asks", F.lit(True))
    every = dealt.withColumn("share", share).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(False))
    both = opened.unionByName(every).select("cluster", "block", "share", "doc_id", "shingles", F.col("asks").alias("open"))
    return _dealt(both, "cluster", "block", "share").groupBy("cluster", "block", "share").applyInPandas(_asked, "a long, b long")


def _asked(group: pd.DataFrame) -> pd.DataFrame:
    """Links of the asking rows of a group with its other rows."""
    asks = group[group["open"]].drop_duplicates("doc_id")
    others = group[~group["open"]].drop_duplicates("doc_id")
    sets, ids = _Sets(others["shingles"]), others["doc_id"].to_numpy()
    union, out = _Union(len(ids)), []
    for doc_id, packed in zip(asks["doc_id"], asks["shingles"], strict=True):
        own = np.frombuffer(packed, np.uint64)
        near = [i for i in sets.linked(sets.numbers(own), len(own)) if ids[i] != doc_id]
        # The others it links with are joined by it; one link to each part of them is enough.
        for i in near:
            if i == near[0] or union.root(i) != union.root(near[0]):
                union.join(i, near[0])
                out.append((max(doc_id, ids[i]), min(doc_id, ids[i])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


# Operator ----------------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text).

    Null texts and texts without words have an empty set and are their own component, as is a row
    with a null doc_id (component_id null, kept).  Rows equal in doc_id share a component; only
    one row per doc_id is expected, and repeated ones keep their own n_shingles.  Extra columns are
    ignored.  No rows give no rows.
    """
    rows = stored(sketched(docs), "sketches")
    known = rows.where("n_shingles > 0 and doc_id is not null")
    classes = stored(known.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.first("tokens").alias("tokens"), F.first("brief").alias("brief")), "classes")
    clusters = components(loose_links(classes)).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    groups = stored(classes.select("doc_id", "n_shingles", "brief").join(clusters, "doc_id"), "clusters")
    links = confirmed_links(docs, groups)
    found = components(links)
    named = classes.join(found, F.col("doc_id") == F.col("node"), "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    named = rows.where("n_shingles > 0").join(named, ["set_a", "set_b", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """Rows of docs, all columns, that are the first of their component.

    Of rows equal in doc_id one stays.  Rows with a null doc_id all stay.
    """
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("doc"))
    first = Window.partitionBy("doc_id").orderBy("doc")
    same = rows.join(kept, "doc_id").withColumn("nth", F.row_number().over(first)).where("nth = 1").select("doc.*")
    return same.unionByName(docs.where("doc_id is null"))
