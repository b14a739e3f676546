"""The similarity join against brute force: no qualifying pair may be lost."""

import random

import pytest
from pyspark.sql import functions as F

from tariffworks.functions import names
from tariffworks.operators import similarity
from tariffworks.operators.similarity import best_similar, similar_names


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, start=1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def score(a, b):
    total = len(a) + len(b)
    return 100 if total == 0 else round((1 - (total - 2 * lcs(a, b)) / total) * 100)


def random_names(seed, n, alphabet, longest):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for _ in range(n // 4)]
    out = set(base)
    while len(out) < n:
        word = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 6)):
            at = rnd.randint(0, len(word))
            if rnd.random() < 0.5:
                word.insert(at, rnd.choice(alphabet))
            elif word:
                word.pop(min(at, len(word) - 1))
        out.add("".join(word))
    return sorted(out)


@pytest.mark.parametrize("threshold", [82, 85, 87, 95])
@pytest.mark.parametrize("alphabet,longest", [("ab c", 14), ("abcdefghij klmno12", 30)])
def test_finds_exactly_the_pairs_of_brute_force(spark, threshold, alphabet, longest):
    left = random_names(1, 120, alphabet, longest)
    right = random_names(1, 100, alphabet, longest) + ["only here"]
    expected = {(a, b, score(a, b)) for a in left for b in right if score(a, b) >= threshold}
    make = lambda xs: spark.createDataFrame([("", x) for x in xs], "block string, name string")
    got = similar_names(make(left), make(right), threshold)
    assert {(r.left_name, r.right_name, r.score) for r in got.collect()} == expected


@pytest.mark.parametrize("threshold", [82, 87])
def test_nodes_of_several_pieces_lose_no_pair(spark, monkeypatch, threshold):
    """Nearly every node goes on to the next piece, as in very large inputs."""
    monkeypatch.setattr(similarity, "FEW_PAIRS", 0)
    monkeypatch.setattr(similarity, "PAIRS_PER_NAME", 0.5)
    left = random_names(5, 160, "ab cd", 22) + ["", "a", "ab"]
    right = random_names(5, 140, "ab cd", 22) + ["", "b", "ab"]
    expected = {(a, b, score(a, b)) for a in left for b in right if score(a, b) >= threshold}
    make = lambda xs: spark.createDataFrame([("", x) for x in sorted(set(xs))], "block string, name string")
    got = similar_names(make(left), make(right), threshold)
    assert {(r.left_name, r.right_name, r.score) for r in got.collect()} == expected


def test_names_of_other_blocks_are_not_compared(spark):
    left = spark.createDataFrame([("OR", "north gas"), ("WA", "north gas")], "block string, name string")
    right = spark.createDataFrame([("OR", "north gas")], "block string, name string")
    assert [(r.block, r.score) for r in similar_names(left, right, 82).collect()] == [("OR", 100)]


def test_best_partner_is_the_highest_score_then_the_lowest_rank(spark):
    left = random_names(3, 80, "abcdef gh", 16)
    right = random_names(3, 70, "abcdef gh", 16)
    l_df = spark.createDataFrame([("", x) for x in left], "block string, name string")
    r_df = spark.createDataFrame(
        [("", x, i, (i * 37) % 70) for i, x in enumerate(right)], "block string, name string, value int, rank int")
    got = {r.left_name: (r.value, r.score) for r in best_similar(l_df, r_df, 82).collect()}
    expected = {}
    for a in left:
        options = [(-score(a, b), (i * 37) % 70, i) for i, b in enumerate(right) if score(a, b) >= 82]
        if options:
            best = min(options)
            expected[a] = (best[2], -best[0])
    assert got == expected


def test_lcs_beyond_one_word(spark):
    rnd = random.Random(7)
    pairs = [
        ("".join(rnd.choice("abc ") for _ in range(n)), "".join(rnd.choice("abc ") for _ in range(m)))
        for n, m in [(1, 200), (59, 61), (60, 60), (61, 59), (120, 130), (121, 40), (200, 3)]
    ]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", names.lcs_length(F.length("a"), names.char_masks(F.col("a")), F.col("b")).alias("n"))
    assert all(r.n == lcs(r.a, r.b) for r in df.collect())


@pytest.mark.parametrize("a,b,expected", [
    ("Pacific Gas", "gas pacific", 100), ("Alpha-Beta Co.", "co beta alpha", 100), ("abc", "xyz", 0),
    ("Énergie Nord", "nergie nord", 100),
])
def test_token_sort_ratio(spark, a, b, expected):
    got = spark.range(1).select(names.token_sort_ratio(F.lit(a), F.lit(b))).first()[0]
    assert got == expected
