"""Similarity join: all pairs of names whose score reaches a threshold.

The score is the rounded share of two strings covered by a common subsequence, so a threshold bounds
how many characters may be inserted or deleted.  If at most ``d`` are, then of ``d + m`` pieces of
one string at least ``m`` occur unchanged in the other, each near its own place, and the edits before,
between and behind them add up to ``d``.  Names meet in nodes: a node at depth k is (length, length) and
the first k pieces that are unchanged, with their texts.  A node is joined, unless its pairs would
outnumber its names by far: then its names go on to the nodes of their next piece.  Every pair that
qualifies follows its own unchanged pieces down to a node that is joined, so none is lost, and no cross
join is made.  As names grow in number, more of the common pieces are combined with a second and a third,
so that pairs grow clearly slower than the square of the names.

Pairs that meet are tested by a bit set of characters inside the join, then by the number of grams of
two characters they share, and only what is left is scored.

Callers pass distinct strings: a name that occurs a billion times is one row here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffworks.functions.names import char_masks, lcs_length, similarity_score
from tariffworks.session import cut_lineage


def allowed_edits(length_a: Column, length_b: Column, threshold: int) -> Column:
    """Most insertions plus deletions that still reach the threshold.

    Scores are rounded, so half a point below the threshold still counts.  The
    number of edits has the parity of the sum of the lengths.
    """
    total = length_a + length_b
    most = F.floor(total * (201 - 2 * threshold) / 200).cast("int")
    return most - F.pmod(most + total, F.lit(2))


def _partner_lengths(length: Column, threshold: int) -> Column:
    """Lengths a partner can have: all common characters of the shorter string."""
    floor = 2 * threshold - 1
    low = F.ceil(length * floor / (400 - floor)).cast("int")
    high = F.floor(length * (400 - floor) / floor).cast("int")
    return F.sequence(low, high)


def _piece_start(length: Column, pieces: Column, number: Column) -> Column:
    """0-based start of a piece; the last pieces are one longer if needed."""
    base = F.floor(length / pieces).cast("int")
    longer = length - base * pieces
    return number * base + F.greatest(number - (pieces - longer), F.lit(0))


def _bag(name: Column) -> Column:
    """Which characters occur once and which at least twice, as 62 bits.

    One insertion or deletion changes one bit at most, so two names differ in no
    more bits than they have edits: a test of candidates that costs a few
    machine instructions.
    """
    chars = F.filter(F.array_distinct(F.split(name, "")), lambda x: x != "")

    def bits(char: Column) -> Column:
        bucket = F.pmod(F.ascii(char), F.lit(31))
        count = F.length(name) - F.length(F.replace(name, char, F.lit("")))
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bucket)
        two = F.call_function("shiftleft", F.lit(1).cast("bigint"), bucket + 31)
        return F.when(count > 1, one.bitwiseOR(two)).otherwise(one)

    return F.aggregate(
        chars, F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(bits(x))
    )


def _grams(name: Column) -> Column:
    """Grams of two characters, ends included, each with how often it has occurred before."""
    padded = F.concat(F.lit("\x02"), name, F.lit("\x03"))
    plain = F.transform(F.sequence(F.lit(1), F.length(name) + 1), lambda at: F.substring(padded, at, F.lit(2)))
    return F.transform(F.array(plain), lambda all_of: F.transform(all_of, lambda gram, i: F.xxhash64(
        gram, F.size(F.filter(F.slice(all_of, F.lit(1), i + 1), lambda x: x == gram)))))[0]


def _common_grams(length_a: Column, length_b: Column, threshold: int) -> Column:
    """Grams that two names share at least: matched characters and both ends form runs, and an edit ends one run at most."""
    edits = allowed_edits(length_a, length_b, threshold)
    return ((length_a + length_b - edits) / 2).cast("int") + 1 - edits


#: Pieces that a node is made of at most; nodes as deep as that are joined whatever their size.
DEEPEST = 3
#: A node is joined unless its pairs outnumber its names by this factor.
PAIRS_PER_NAME = 4
#: So many pairs are joined at once: one more step would take longer.
FEW_PAIRS = 1_000_000


def _roots(names: DataFrame, threshold: int, is_left: bool) -> DataFrame:
    """A row for each name and length of a partner, before any piece.

    piece: the last one so far; shift: how far it stands from its place; used: edits before it at least.
    """
    own, partner = ("left_len", "right_len") if is_left else ("right_len", "left_len")
    edits = allowed_edits(F.col("left_len"), F.col("right_len"), threshold)
    return (
        names.withColumn(own, F.length("name"))
        .withColumn(partner, F.explode(_partner_lengths(F.col(own), threshold)))
        .withColumn("edits", edits)
        .filter(F.col("edits") >= F.abs(F.col("left_len") - F.col("right_len")))
        .withColumn("deepest", F.greatest(F.lit(1), F.least(F.lit(DEEPEST), F.col("right_len") - F.col("edits"))))
        .select("id", "name", "bag", "left_len", "right_len", "edits", "deepest",
                F.xxhash64("block", "left_len", "right_len").alias("node"),
                F.lit(-1).alias("piece"), F.lit(0).alias("shift"), F.lit(0).alias("used"))
    )


def _next_nodes(rows: DataFrame, depth: int, is_left: bool) -> DataFrame:
    """The rows in the nodes of each piece that can be the next unchanged one."""
    pieces = F.col("edits") + F.col("deepest")
    last = F.least(F.col("edits") + depth, pieces) - 1
    following = F.when(F.col("piece") < last, F.sequence(F.col("piece") + 1, last))
    size = _piece_start(F.col("right_len"), pieces, F.col("next") + 1) - F.col("start")
    placed = (
        rows.withColumn("next", F.explode(following))
        .withColumn("start", _piece_start(F.col("right_len"), pieces, F.col("next"))).withColumn("size", size)
    )
    if is_left:
        # Each piece passed over has an edit; edits have the parity of the shift they add up to.
        left = F.col("edits") - F.col("used")
        low = F.greatest(F.col("shift") - left, -F.col("start"))
        high = F.least(F.col("shift") + left, F.col("left_len") - F.col("size") - F.col("start"))
        moved = F.col("to") - F.col("shift")
        passed = F.greatest(F.col("next") - F.col("piece") - 1, F.abs(moved))
        behind = F.abs(F.col("left_len") - F.col("right_len") - F.col("to"))
        placed = (
            placed.withColumn("to", F.explode(F.when(low <= high, F.sequence(low, high))))
            .withColumn("used", F.col("used") + passed + F.pmod(passed - moved, F.lit(2)))
            .filter(F.col("used") + behind <= F.col("edits"))
            .withColumn("shift", F.col("to"))
        )
    text = F.substring(F.col("name"), F.col("start") + F.col("shift") + 1, F.col("size"))
    return placed.select(
        "id", "name", "bag", "left_len", "right_len", "edits", "deepest",
        F.xxhash64("node", "next", text).alias("node"), F.col("next").alias("piece"), "shift", "used")


def candidates(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """(left_id, right_id), each once, of the pairs of names that can qualify.

    Both sides have (id, block, name, bag).
    """
    sides = {True: _roots(left, threshold, True), False: _roots(right, threshold, False)}
    met = []
    for depth in range(1, DEEPEST + 1):
        sides = {is_left: cut_lineage(_next_nodes(rows, depth, is_left)) for is_left, rows in sides.items()}
        counts = [sides[is_left].groupBy("node").agg(F.count("*").alias(label), F.first("deepest").alias(f"{label}_deepest"))
                  for is_left, label in ((True, "lefts"), (False, "rights"))]
        pairs = F.col("lefts") * F.col("rights")
        nodes = counts[0].join(counts[1], "node").withColumn(
            "goes_on", (F.col("lefts_deepest") > depth) & (pairs > PAIRS_PER_NAME * (F.col("lefts") + F.col("rights"))))
        if depth < DEEPEST:
            nodes = cut_lineage(nodes.select("node", "goes_on", pairs.alias("pairs")))
            many = nodes.agg(F.sum("pairs"), F.count_if("goes_on")).first()
            on = many[0] is not None and many[0] > FEW_PAIRS and many[1] > 0
        else:
            on = False
        ends = nodes.filter(~F.col("goes_on")).select("node") if on else nodes.select("node")
        met.append(_meet(sides, ends))
        if not on:
            break
        further = nodes.filter("goes_on").select("node")
        sides = {is_left: rows.join(further, "node", "left_semi") for is_left, rows in sides.items()}
    return reduce(DataFrame.unionByName, met).distinct()


def _meet(sides: dict[bool, DataFrame], ends: DataFrame) -> DataFrame:
    """Pairs of these nodes whose characters differ in no more bits than the edits allow."""
    left = sides[True].join(ends, "node", "left_semi").select("node", "edits", F.col("id").alias("left_id"), F.col("bag").alias("left_bag"))
    right = sides[False].join(ends, "node", "left_semi").select("node", F.col("id").alias("right_id"), F.col("bag").alias("right_bag"))
    differ = F.bit_count(F.col("left_bag").bitwiseXOR(F.col("right_bag")))
    return left.join(right, "node").filter(differ <= F.col("edits")).select("left_id", "right_id")


def similar_names(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """Pairs (block, left_name, right_name, score) with a score of at least ``threshold``.

    Both inputs have columns (block, name), are distinct, and hold names in
    token-sorted form; only names of one block are compared.
    """
    left, right = (cut_lineage(side.select("block", "name").withColumn("id", F.monotonically_increasing_id())
                               .withColumn("bag", _bag(F.col("name"))).withColumn("grams", _grams(F.col("name")))) for side in (left, right))
    lefts = left.select("block", F.col("id").alias("left_id"), F.col("name").alias("left_name"), F.col("grams").alias("left_grams"))
    rights = right.select(F.col("id").alias("right_id"), F.col("name").alias("right_name"), F.col("grams").alias("right_grams"),
                          char_masks(F.col("name")).alias("masks"))
    left_len, right_len = F.length("left_name"), F.length("right_name")
    shared = F.size(F.array_intersect("left_grams", "right_grams"))
    scored = (
        candidates(left, right, threshold).join(lefts, "left_id").join(rights, "right_id")
        .filter(shared >= _common_grams(left_len, right_len, threshold))
        .select("block", "left_name", "right_name", similarity_score(
            left_len, right_len, lcs_length(right_len, F.col("masks"), F.col("left_name"))).alias("score"))
    )
    return scored.filter(F.col("score") >= threshold)


def best_similar(left: DataFrame, right: DataFrame, threshold: int, tiers: tuple[int, ...] = ()
                 ) -> DataFrame:
    """Best partner of each left name: (block, left_name, value, score).

    ``right`` also has ``value`` and ``rank``; of equal scores the lowest rank
    wins.  Equal names are found first, then names above each tier if any are
    given, and only what is left goes on: a name's best partner cannot be below
    a tier where it has one.  Each step is stored, because all later ones read it.
    """
    right = right.withColumnRenamed("name", "right_name")
    partner = right.select("block", "right_name", "value", "rank")
    equal = left.join(
        partner, (left["block"] == partner["block"]) & (left["name"] == partner["right_name"])
    ).select(left["block"], F.col("name").alias("left_name"), "value", F.lit(100).alias("score"))
    found = [cut_lineage(equal)]
    rest = left
    for tier in [t for t in tiers if t > threshold] + [threshold]:
        done = found[-1].select("block", F.col("left_name").alias("name"))
        rest = rest.join(done, ["block", "name"], "left_anti")
        scored = similar_names(
            rest, right.select("block", F.col("right_name").alias("name")), tier
        ).join(partner, ["block", "right_name"])
        best = scored.groupBy("block", "left_name").agg(
            F.min_by(
                F.struct("value", "score"), F.struct(-F.col("score"), F.col("rank"))
            ).alias("best")
        )
        found.append(cut_lineage(best.select("block", "left_name", "best.value", "best.score")))
    return reduce(DataFrame.unionByName, found)
