"""Small documents with what is rare: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, part string, doc string, length long"


def words(rng: random.Random, n: int) -> str:
    parts = ["the", "an", "er", "tion", "en", "st", "re", "ou", "ing", "ha", "Le", "é", "ß", "ñ"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def near(text: str, rng: random.Random, changes: int) -> str:
    out = text.split(" ")
    for _ in range(changes):
        out[rng.randrange(len(out))] = "changed" + str(rng.randrange(99))
    return " ".join(out)


def documents(extra: list[tuple[int | None, str | None]] = (), n: int = 40, seed: int = 5) -> list[tuple]:
    """Rows of SCHEMA."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(30, 160)) for _ in range(n)]
    texts: list[tuple[int | None, str | None]] = [(i, t) for i, t in enumerate(base)]
    texts += [(100 + i, base[i % 5]) for i in range(15)]
    texts += [(200 + i, near(base[6 + i % 3], rng, 1 + i % 3)) for i in range(24)]
    passage = words(rng, 20)
    texts += [(300 + i, words(rng, 20) + " " + passage + "\n" + words(rng, 10)) for i in range(6)]
    texts += [(400, None), (401, ""), (402, " \t\n"), (403, "two words"), (404, "two  words"), (405, "word"),
              (406, "A B c D e"), (407, "a b C d E"), (408, "x" * 300), (409, "x" * 300 + "y"),
              (410, words(rng, 12_000)), (3, base[3]), (3, base[3]), (None, base[4]), (None, None)]
    texts += list(extra)
    sources = ["b", "a", "\U0001f600", None, "b", "b", "￿"]
    return [(d, t, "en", sources[i % len(sources)], -1, 0.5, "p", "d", 7) for i, (d, t) in enumerate(texts)]


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)
