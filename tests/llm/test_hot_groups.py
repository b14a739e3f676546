"""Large groups of loosely alike documents in the trees of op6: few rows from level to level, no pair lost."""

import numpy as np
from pyspark.sql import functions as F

from tariffworks.llm import chosen_path
from tariffworks.llm.common import components


def _copies(center, share, n, numbers):
    """n sketches that agree with the center in each token with this probability."""
    other = numbers.integers(0, 2**32, (n, chosen_path.TOKENS), dtype=np.uint64).astype("<u4")
    return np.where(numbers.random((n, chosen_path.TOKENS)) < share, center, other).astype("<u4")


def test_loose_group_is_compared_once_a_level(spark, monkeypatch):
    numbers = np.random.default_rng(3)
    center = numbers.integers(0, 2**32, chosen_path.TOKENS, dtype=np.uint64).astype("<u4")
    near, far = _copies(center, 0.7, 600, numbers), _copies(center, 0.4, 900, numbers)
    pairs = np.array([_copies(t, 0.85, 1, numbers)[0] for t in far[:100]])
    tokens = np.concatenate([near, far, pairs])
    numbers.shuffle(tokens)
    sketches = spark.createDataFrame(
        [(i, t.tobytes(), t.astype(np.uint8).tobytes()) for i, t in enumerate(tokens)], "doc_id long, tokens binary, brief binary")
    kept, store = {}, chosen_path.stored

    def counted(df, label):
        out = store(df, label)
        kept[label] = out
        return out

    monkeypatch.setattr(chosen_path, "stored", counted)
    found = components(chosen_path.loose_links(sketches))
    cluster = {r["node"]: r["component"] for r in found.collect()}
    lost = [(i, j) for i in range(len(tokens)) for j in np.flatnonzero((tokens[i + 1 :] == tokens[i]).mean(1) >= 0.7) + i + 1
            if cluster.get(i) is None or cluster.get(i) != cluster.get(int(j))]
    assert not lost
    met = {label: df.count() for label, df in kept.items() if label.startswith(("pivots", "seconds", "blocks"))}
    assert sum(met.values()) < 35_000, met


def test_pivot_of_a_large_group_makes_no_rows(spark, monkeypatch):
    words, numbers = [f"w{i}" for i in range(400)], np.random.default_rng(5)
    texts = []
    for _ in range(chosen_path.BLOCK + 40):
        text = list(words[:120])
        for at in numbers.choice(120, 2, replace=False):
            text[at] = words[numbers.integers(120, 400)]
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = chosen_path.sketched(docs).select("doc_id", F.lit(0).cast("long").alias("cluster"), "n_shingles", "brief")
    plans, store = {}, chosen_path.stored

    def planned(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, label)

    monkeypatch.setattr(chosen_path, "stored", planned)
    found = components(chosen_path.confirmed_links(docs, groups))
    assert "Generate" not in plans["distances"]
    got = {r["node"]: r["component"] for r in found.collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= chosen_path.SIMILAR * len(sets[i] | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert [got.get(i, i) for i in range(len(sets))] == label
