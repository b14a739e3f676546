"""Best-fit packing of tokenised documents by exact complements.

Tasks tokenise whole texts and cut what is longer than a sequence.  Only the histogram of piece
lengths (at most one row for each length up to the capacity) reaches the driver, which plans on
it: for each length from the greatest down, sums of one, two and three other lengths that fill
its gap exactly are looked up among the lengths still available and consumed as often as the
counts allow; what is left is packed best-fit, longest first.  The plan is a list of patterns with
counts; each use of a length exhausts a count, so that the plan is as short as the histogram.
Tasks then give the r-th piece of each length its place by a search in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffworks.llm.common import chunks, stored

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
END_ID = 0
#: Words whose ids a task remembers, twice at most.
REMEMBERED = 500_000
#: Groups that the pieces of one length are ranked in.
RANK_PARTS = 1024


# Tokens ------------------------------------------------------------------------------------------

class WordIds:
    """Little-endian 32-bit ids of words, remembered: the vocabulary never joins over white space.

    Unseen words are encoded together, with a mark between them that no such word holds.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._encode("|")
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, words: list[bytes]) -> None:
        plain = [w for w in words if b"|" not in w]
        ids = np.array(self._encode(" | ".join(w.decode() for w in plain)), np.dtype("<u4"))
        cuts = np.flatnonzero(ids == self.mark[0]) if len(self.mark) == 1 else np.zeros(0, int)
        if len(cuts) == len(plain) - 1:
            raw = ids.tobytes()
            starts, ends = [0, *((cuts + 1) * 4).tolist()], [*(cuts * 4).tolist(), len(raw)]
            for word, a, b in zip(plain, starts, ends, strict=True):
                self.recent[word] = raw[a:b]
        else:
            plain = []
        for word in set(words).difference(plain):
            self.recent[word] = np.array(self._encode(word.decode()), np.dtype("<u4")).tobytes()

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        split = [t.split() for t in texts]
        unseen = []
        for word in set().union(*split):
            if word not in self.recent:
                known = self.older.get(word)
                if known is None:
                    unseen.append(word)
                else:
                    self.recent[word] = known
        for i in range(0, len(unseen), 1000):
            self._learn(unseen[i : i + 1000])
        get = self.recent.__getitem__
        for words in split:
            yield b"".join(map(get, words))


_encoders: dict[str, WordIds] = {}


def _encoder(path: str | None) -> WordIds:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian 32-bit) of docs (doc_id, text).

    A document is its ids and the end id; a null or empty text is the end id alone.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path)
        end = np.array([END_ID], np.dtype("<u4")).tobytes()
        for batch in batches:
            texts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            for a, b in chunks(texts):
                rows = []
                for doc_id, ids in zip(batch["doc_id"].iloc[a:b], encoder.of(texts[a:b]), strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), capacity * 4)):
                        part = ids[at : at + capacity * 4]
                        row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, part) if with_ids else row)
                yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    columns = [c.split(" ")[0] for c in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, schema)


# Plan --------------------------------------------------------------------------------------------

def _pair(free: np.ndarray, gap: int, most: int) -> tuple[int, int] | None:
    """The pair of lengths with this sum whose greater one is greatest, but at most `most`."""
    low, high = (gap + 1) // 2, min(gap - 1, most)
    if low > high:
        return None
    fits = np.flatnonzero((free[low : high + 1] > 0) & (free[gap - high : gap - low + 1][::-1] > 0))
    for at in fits[::-1]:
        a = low + int(at)
        if 2 * a != gap or free[a] > 1:
            return a, gap - a
    return None


def _complement(free: np.ndarray, gap: int, most: int) -> tuple[int, ...] | None:
    """One, two or three available lengths up to `most` that fill the gap exactly."""
    if gap <= most and free[gap] > 0:
        return (gap,)
    if found := _pair(free, gap, most):
        return found
    for a in range(min(gap - 2, most), (gap + 2) // 3 - 1, -1):
        if free[a] > 0:
            free[a] -= 1
            found = _pair(free, gap - a, a)
            free[a] += 1
            if found:
                return (a, *found)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences have each."""
    free = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        free[length] = n
    out: list[tuple[tuple[int, ...], int]] = []
    if free[capacity]:
        out.append(((capacity,), int(free[capacity])))
        free[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        if length * 4 < capacity:
            break
        while free[length] > 0:
            free[length] -= 1
            rest = _complement(free, capacity - length, length)
            free[length] += 1
            if rest is None:
                break
            pattern = (length, *rest)
            uses = Counter(pattern)
            n = min(int(free[x]) // k for x, k in uses.items())
            for x, k in uses.items():
                free[x] -= k * n
            out.append((pattern, n))
    return out + _best_fit(free, capacity)


def _best_fit(free: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the fullest sequence that has room; equal sequences go together."""
    groups: dict[int, list[list]] = defaultdict(list)  # gap -> [pattern, how many]
    gaps: list[int] = []

    def put(pattern: tuple[int, ...], gap: int, n: int) -> None:
        if n:
            if not groups[gap]:
                insort(gaps, gap)
            groups[gap].append([pattern, n])

    for length in range(capacity, 0, -1):
        n = int(free[length])
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                gap, pattern, many = capacity, (), n
            else:
                gap = gaps[at]
                pattern, many = groups[gap].pop()
                if not groups[gap]:
                    gaps.pop(at)
            each = gap // length
            whole = min(many, n // each)
            put(pattern + (length,) * each, gap - each * length, whole)
            n, many = n - whole * each, many - whole
            if many and n:
                put(pattern + (length,) * n, gap - n * length, 1)
                n, many = 0, many - 1
            if pattern:
                put(pattern, gap, many)
    return [(pattern, n) for held in groups.values() for pattern, n in held]


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first ranks of the runs of pieces, and the first sequence and the offset of each run."""
    places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: Counter = Counter()
    first = 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            places[length].append((used[length], first, offset))
            used[length] += n
            offset += length
        first += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in places.items()}


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of docs (doc_id, text) with sequence_id and offset: gapless from 0, at most `capacity` ids each.

    Null and empty texts give one piece of length 1.  Repeated rows are packed each.  A null doc_id
    stays null.  No rows give no rows.  Extra columns are ignored.
    """
    cut = stored(pieces(docs, capacity, path, with_ids), "pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    places = _places(plan(counts, capacity))

    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_PARTS))
    cut = cut.withColumn("part", part)
    before = cut.groupBy("length", "part").count().withColumn(
        "before", F.sum("count").over(Window.partitionBy("length").orderBy("part")
                                      .rowsBetween(Window.unboundedPreceding, -1))).drop("count")
    ranked = (
        cut.withColumn("within", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece")))
        .join(before, ["length", "part"])
        .withColumn("rank", F.coalesce("before", F.lit(0)) + F.col("within") - 1)
    )

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((2, len(length)), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for x in np.unique(lengths):
            rows = lengths == x
            starts, sequences, offsets = places[int(x)]
            run = np.searchsorted(starts, ranks[rows], "right") - 1
            out[0, rows] = sequences[run] + ranks[rows] - starts[run]
            out[1, rows] = offsets[run]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    return ranked.withColumn("place", placed("length", "rank")).select(*names, "place.sequence_id", "place.offset")
