"""Licences named in texts, by ordered signature rules.

Texts become lower-cased words with one space between them.  A rule is tried on a text only if the
text has the rule's keyword; the places that its pattern matches are runs of words.  Places are
taken in the order of the rules, then from left to right, and one that lies within a place already
taken is suppressed: the name of a licence within its notice, a general name within a special one.
Places that merely overlap are all kept.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffworks.llm.common import chunks
from tariffworks.llm.license_rules import Rule, rules

#: Phrases that are always reported, with their labels; no rule suppresses them.
BASE = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))
SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
          " places array<struct<start:int,end:int,label:string,worth:double>>")

_ARROW = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("worth", pa.float64())]))]


@cache
def _letters() -> bytes:
    """Bytes of words, A-Z as a-z; all other ASCII bytes as a space."""
    word = b"0123456789abcdefghijklmnopqrstuvwxyz"
    return bytes(b if b >= 0x80 or b in word else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@cache
def _by_keyword() -> dict[bytes, list[Rule]]:
    out = defaultdict(list)
    for rule in rules():
        out[rule.keyword].append(rule)
    return dict(out)


@cache
def _keywords() -> frozenset[bytes]:
    return frozenset(_by_keyword()) | {phrase.split()[0] for phrase, _ in BASE}


def words(text: bytes) -> list[bytes]:
    return text.translate(_letters()).split()


def uncontained(found: list[tuple]) -> list[tuple]:
    """The places (start, end, priority, ...) that no place of an earlier priority, or of the same
    priority and further left, contains.

    The places kept never lie within each other, so among those that start no later than a place,
    the one that ends last is the one to ask.
    """
    starts: list[int] = []
    ends: list[int] = []
    kept = []
    for place in sorted(found, key=lambda p: (p[2], p[0], -p[1])):
        start, end = place[:2]
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue
        kept.append(place)
        # Those that this one contains give way to it.
        last = at
        while last < len(starts) and ends[last] <= end:
            last += 1
        first = at - 1 if at and starts[at - 1] == start else at
        starts[first:last], ends[first:last] = [start], [end]
    return kept


def scan(text: bytes) -> tuple:
    """The columns of SCHEMA for a text in UTF-8."""
    split = words(text)
    present = _keywords().intersection(split)
    if not present:
        return len(split), 0, None, None, "", "", 0.0, []
    line = b" " + b" ".join(split) + b" "
    hits = []
    for rule in sorted((r for k in present for r in _by_keyword().get(k, ())), key=lambda r: r.priority):
        hits += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(line)]
    base = []
    for phrase, label in BASE:
        sought, at = b" " + phrase + b" ", -1
        while (at := line.find(sought, at + 1)) >= 0:
            base.append((at + 1, label))
    if not hits and not base:
        return len(split), 0, None, None, "", "", 0.0, []

    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)

    def word_at(byte: int) -> int:
        return int(np.searchsorted(spaces, byte)) - 1

    kept = uncontained([(word_at(a), word_at(b) + 1, rule.priority, rule) for a, b, rule in hits])
    places = [{"start": a, "end": b, "label": r.label, "worth": r.worth} for a, b, _, r in sorted(kept, key=lambda p: p[:3])]
    starts = [word_at(at) for at, _ in base]
    base_labels = {label for _, label in base}
    labels = base_labels | {p["label"] for p in places}
    return (len(split), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
            ",".join(sorted(labels)), max((p["worth"] for p in places), default=0.0), places)


def find_licenses(docs: DataFrame, text: str | Column = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of docs: the columns `keep` (doc_id if not given), then

    n_words; n_base, first_word and last_word: number, least and greatest start (in words, from 0) of
    the base phrases; base_labels and labels (those of the rules too): distinct, sorted,
    comma-joined; score: the worth of the most telling place; places: start, end (words, exclusive),
    label and worth of the places of the rules.

    Null and empty texts have no words, no places, empty labels and score 0.  Repeated rows have
    equal results; columns not kept are ignored, whatever their names.  Texts are read whole.
    """
    keep = ["doc_id"] if keep is None else keep
    kept = [f"kept_{i}" for i in range(len(keep))]
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    schema = ", ".join([*(f"{k} {docs.schema[c].dataType.simpleString()}" for k, c in zip(kept, keep, strict=True)), SCHEMA])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for a, b in chunks(texts):
                columns = list(zip(*map(scan, texts[a:b]), strict=True))
                arrays = [batch.column(k).slice(a, b - a) for k in kept]
                arrays += [pa.array(values, kind) for values, kind in zip(columns, _ARROW, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *names])

    source = F.col(text) if isinstance(text, str) else text
    rows = docs.select(*[F.col(c).alias(k) for k, c in zip(kept, keep, strict=True)], F.encode(source, "UTF-8").alias("text"))
    return rows.mapInArrow(scanned, schema).select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], *names)
