"""Merkle manifest of a dataset, and proofs of its rows by a recursive query.

Every row is a leaf.  The leaves of a source ascend by id; every `fanout` consecutive nodes become
their hash, level by level, until one is left, the source's subroot; the subroots, in order of their
sources, become the root likewise.  The built levels are stored as rows that name their parent.  A
recursive query starts at all leaves at once and follows the links: each step appends the siblings
at hand as a row and folds the hash it came with, until a node has no parent.

* Places come from a range sort, so that a source with a third of all rows is spread over tasks.
* All leaves meet in the same few nodes near the root, so these are stored in copies, one for every
  `SHARE` leaves below, and a leaf takes one of them.
* Siblings are appended as rows of the result, not carried upwards.  Leaves of one run have the same
  siblings above it, so these are appended once, by the first leaf of the run.  Digests are bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tariffworks.llm.common import stored

FANOUT = 16
#: Leaves that go through one copy of a node, about.
SHARE = 4096
#: The tree over the subroots; the trees of sources count from 0.
TOP = -1
#: Rows whose crc32 of the id this divides are tampered with.
TAMPER_EVERY = 5
_DIGEST = 32


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, `:` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    """The hash of a row of documents with this text."""
    fields = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long"), text]
    return F.sha2(F.concat(*map(field, fields)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with their places, from 0, in a total order of all rows (equal rows in any order).

    Range partitions are sorted and stored with the place inside the partition; the sums over
    partitions have one row for each partition.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_inside", inside).withColumn("_part", F.spark_partition_id()), "sorted")
    before = parts.groupBy("_part").count().select(
        "_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    return parts.join(before, "_part").withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")


@dataclass
class Manifest:
    """The stored parts of a manifest.

    leaves: at (place among all rows), doc_id, leaf, claimed (the digest to be proved), tree, and the link
    (up_level, up_node, up_copies, slot) to the parent, null for a leaf without one.
    nodes: tree, level, node, copy, hash, children (digests of the children, concatenated) and the
    link (up_tree, up_level, up_node, up_copies, slot) to the parent, null for the root.
    subroots: tree, source, subroot.  root: the digest, None for an empty table.
    """

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def _link(place: Column, level: int, n: Column, fanout: int) -> list[Column]:
    """slot, up_level, up_node, up_copies of a node of a level in a tree of n leaves, null for the last one."""
    inner = n > fanout**level
    return [F.when(inner, value).alias(name) for name, value in (
        ("slot", (place % fanout).cast("int")), ("up_level", F.lit(level + 1)),
        ("up_node", F.floor(place / fanout).cast("long")), ("up_copies", F.lit(max(1, -(-fanout ** (level + 1) // SHARE)))))]


def _levels(leaves: DataFrame, fanout: int, most: int) -> list[DataFrame]:
    """Levels 1, 2 ... of trees (tree, place, hash, n), each stored, until all trees have one node."""
    out, level, below = [], 0, leaves
    while fanout**level < most:
        children = F.transform(F.array_sort(F.collect_list(F.struct("place", "hash"))), lambda c: c["hash"])
        level += 1
        below = stored(
            below.where(F.col("n") > fanout ** (level - 1))
            .groupBy("tree", "n", F.floor(F.col("place") / fanout).cast("long").alias("place")).agg(F.array_join(children, "").alias("children"))
            .withColumn("hash", F.sha2("children", 256)).withColumn("level", F.lit(level)), f"level{level}")
        out.append(below)
    return out


def build(docs: DataFrame, claimed: Column | None = None, fanout: int = FANOUT) -> Manifest:
    """The manifest of docs (doc_id, source, lang, n_chars, text).

    `claimed` is the text whose hash is to be proved in place of the row's own.  Null ids come
    first in their source, a null source is the first source; rows with equal ids are ordered by
    their hash, so that the root does not depend on the order of the input.
    """
    spark = docs.sparkSession
    text = F.col("text")
    hashes = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", leaf_hash(text).alias("leaf"),
        (F.lit(None).cast("string") if claimed is None else F.when(~claimed.eqNullSafe(text), leaf_hash(claimed))).alias("claimed")), "leaves")
    placed = numbered(hashes, [F.col("source"), F.col("doc_id"), F.col("leaf")], "at")
    sources = stored(numbered(placed.groupBy("source").agg(F.min("at").alias("first"), F.count("*").alias("n")), [F.col("source")], "tree"), "sources")
    n_trees, most = sources.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()

    own = sources.select(F.col("source").alias("name"), "tree", "first", "n")
    leaves = stored(placed.join(own, F.col("source").eqNullSafe(F.col("name"))).select(
        "at", "doc_id", "leaf", F.unhex(F.coalesce("claimed", "leaf")).alias("claimed"), "tree", "n", (F.col("at") - F.col("first")).alias("place")), "placed")
    below = leaves.select("tree", "place", F.col("leaf").alias("hash"), "n")
    levels = _levels(below, fanout, most)

    # The last node of each source, and the tree over these.
    last = [below.where("n = 1").select("tree", "hash")]
    last += [rows.where((F.col("n") > fanout**k) & (F.col("n") <= fanout ** (k + 1))).select("tree", "hash") for k, rows in enumerate(levels)]
    found = last[0]
    for rows in last[1:]:
        found = found.unionByName(rows)
    subroots = stored(found.join(sources.select("tree", "source", "n"), "tree").select("tree", "source", F.col("hash").alias("subroot"), "n"), "subroots")
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("subroot").alias("hash"), F.lit(n_trees).cast("long").alias("n"))
    above = _levels(top, fanout, n_trees)
    root = (above[-1] if above else top).select("hash").first()

    # Links: a subroot's parent is in the tree over the subroots, where its place is its source's.
    # Nodes there are below all leaves, so they are stored in as many copies as all leaves ask for.
    n_leaves = leaves.count()
    shares = -(-n_leaves // SHARE)

    def linked(rows: DataFrame, level: int) -> DataFrame:
        plain = _link(F.col("place"), level, F.col("n"), fanout)
        rows = rows.select("*", *plain, F.when(F.col("n") > fanout**level, F.col("tree")).alias("up_tree"))
        if n_trees <= 1:
            return rows
        joint = {"slot": (F.col("tree") % fanout).cast("int"), "up_level": F.lit(1), "up_node": F.floor(F.col("tree") / fanout).cast("long"),
                 "up_copies": F.lit(shares), "up_tree": F.lit(TOP).cast("long")}
        return rows.withColumns({name: F.coalesce(F.col(name), value) for name, value in joint.items()})

    def linked_top(rows: DataFrame, level: int) -> DataFrame:
        rows = rows.select("*", *_link(F.col("place"), level, F.col("n"), fanout), F.when(F.col("n") > fanout**level, F.lit(TOP).cast("long")).alias("up_tree"))
        return rows.withColumn("up_copies", F.when(F.col("up_tree").isNotNull(), F.lit(shares)))

    def copied(rows: DataFrame, n_copies: int) -> DataFrame:
        columns = ["tree", "level", F.col("place").alias("node"), F.unhex("hash").alias("hash"), F.unhex("children").alias("children"), "up_tree", "up_level", "up_node", "up_copies", "slot"]
        return rows.select(*columns, F.explode(F.sequence(F.lit(0), F.lit(n_copies - 1))).alias("copy"))

    parts = [copied(linked(rows, k + 1), max(1, -(-fanout ** (k + 1) // SHARE))) for k, rows in enumerate(levels)]
    parts += [copied(linked_top(rows, k + 1), shares) for k, rows in enumerate(above)]
    columns = "tree long, level int, node long, hash binary, children binary, up_tree long, up_level int, up_node long, up_copies int, slot int, copy int"
    nodes = spark.createDataFrame([], columns)
    for rows in parts:
        nodes = nodes.unionByName(rows)
    return Manifest(linked(leaves, 0).drop("place", "n"), stored(nodes, "nodes"), subroots.drop("n"), root["hash"] if root else None)


def climb(manifest: Manifest) -> DataFrame:
    """run, at, level, folded, siblings, done: one row for each leaf and level, from the leaf (level 0) to the root.

    A recursive query.  run is the place of the first leaf of the leaf's run; siblings are null where that
    leaf has the same.  The last row of a leaf is done, and folded to the root that its claim leads to.
    """
    spark: SparkSession = manifest.leaves.sparkSession
    # All leaves take part: the number of rows is no sign of a query that does not end.
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    before = f"substring(n.children, 1, {_DIGEST} * c.slot)"
    behind = f"substring(n.children, {_DIGEST} * (c.slot + 1) + 1)"
    return spark.sql(
        f"""
        WITH RECURSIVE climb(run, at, level, folded, siblings, up_tree, up_level, up_node, up_copies, slot) AS (
            SELECT CASE WHEN up_tree = tree THEN at - slot ELSE at END, at, 0, claimed, CAST(NULL AS BINARY), up_tree, up_level, up_node, up_copies, slot FROM {{leaves}}
            UNION ALL
            SELECT c.run, c.at, c.level + 1,
                unhex(sha2(lower(hex(concat({before}, c.folded, {behind}))), 256)),
                CASE WHEN c.level = 0 OR c.run = c.at THEN concat({before}, {behind}) END,
                n.up_tree, n.up_level, n.up_node, n.up_copies, n.slot
            FROM climb c JOIN {{nodes}} n
            ON n.tree = c.up_tree AND n.level = c.up_level AND n.node = c.up_node AND n.copy = c.at % c.up_copies
        )
        SELECT run, at, level, folded, siblings, up_node IS NULL AS done FROM climb
        """, leaves=manifest.leaves, nodes=manifest.nodes)


def proofs(manifest: Manifest) -> DataFrame:
    """at, proof (the siblings' digests from the leaf to the root, left to right), folded_root (a digest)."""
    steps = climb(manifest).where("done OR siblings IS NOT NULL")
    runs = steps.groupBy("run").agg(
        F.array_sort(F.collect_list(F.when((F.col("at") == F.col("run")) & (F.col("level") > 1), F.struct("level", "siblings")))).alias("shared"),
        F.collect_list(F.when(F.col("level") == 1, F.struct("at", "siblings"))).alias("own"),
        F.collect_list(F.when(F.col("done"), F.struct("at", "folded"))).alias("roots"))
    joined = F.aggregate("shared", F.lit(b""), lambda acc, s: F.concat(acc, s["siblings"]))
    of_leaf = lambda rows, leaf: F.filter(rows, lambda x: x["at"] == leaf["at"])
    each = F.transform("roots", lambda leaf: F.struct(
        leaf["at"].alias("at"), leaf["folded"].alias("folded_root"),
        F.coalesce(F.get(of_leaf(F.col("own"), leaf), F.lit(0))["siblings"], F.lit(b"")).alias("own")))
    return runs.select(joined.alias("shared"), F.explode(each).alias("leaf")).select(
        "leaf.at", F.concat("leaf.own", "shared").alias("proof"), "leaf.folded_root")


def audit(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row of docs (doc_id, source, lang, n_chars, text).

    Rows whose crc32 of the decimal id is divisible by `TAMPER_EVERY` are proved with their letters
    A-Z lower-cased; they are verified only if that changes nothing.  Nulls in any column are
    hashed as `-`; a null id is never tampered with.  An empty text is hashed as `0:`.  Repeated
    rows are leaves of their own with equal hashes.  Extra columns are ignored; an empty table
    has no rows.  A table of one row has its leaf as root and an empty proof.
    """
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % TAMPER_EVERY == 0
    manifest = build(docs, F.when(tampered, lower_ascii(F.col("text"))).otherwise(F.col("text")), fanout)
    proved = proofs(manifest).select(
        "at", F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), F.lower(F.hex("folded_root")).alias("folded_root"))
    rows = manifest.leaves.select("at", "doc_id", "leaf", "tree").join(proved, "at")
    rows = rows.join(manifest.subroots.select("tree", "subroot"), "tree")
    root = F.lit(manifest.root)
    return rows.select(
        "doc_id", "leaf", "subroot", root.cast("string").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))
