"""Licence signatures: base phrases and suppression against brute force, rules against their own wording."""

from __future__ import annotations

import random
import re
import warnings

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tariffworks.llm import licenses
from tariffworks.llm.license_rules import rules
from tests.llm.fixtures import documents, frame

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = [
    "Licensed under the Apache License, Version 2.0.", "ALL RIGHTS\n * Reserved", "cc-by CC BY cc by-nc 4.0", "cc by cc by",
    "GNU General Public License, version 3", "the general public license", "© 2020 é; (c) All rights reserved!",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "spdx-license-identifier: MIT",
    "# This program is distributed in the hope that it will be useful,\n# but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of\n# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", "GPL v2 or later", "İall rights reserved", "all rights reservedé"]


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def outermost(found):
    """The places, in order of priority, that none taken before contains."""
    kept = []
    for p in sorted(found, key=lambda p: (p[2], p[0], -p[1])):
        if not any(q[0] <= p[0] and p[1] <= q[1] for q in kept):
            kept.append(p)
    return kept


def scan_by_force(text):
    """All rules on all texts, no keywords, places by counting words."""
    words = WORD.findall(lowered(text or ""))
    line = " " + " ".join(words) + " "
    base = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()]
    found = []
    for rule in rules():
        for m in rule.pattern.finditer(line.encode()):
            first = len(line.encode()[: m.start()].split())
            found.append((first, first + len(m.group().split()), rule.priority, rule))
    kept = outermost(found)
    starts = [i for i, _ in base]
    labels = {label for _, label in base}
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {p[3].label for p in kept})), max((p[3].worth for p in kept), default=0.0))


def mixed_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    out = []
    for i in range(120):
        parts = [rng.choice([*NOTICES, "plain words here", "license", "under the", "\n"]) for _ in range(rng.randint(1, 12))]
        out.append((1000 + i, " ".join(parts)))
    out.append((2000, "filler " * 40_000 + "Licensed under CC BY-NC 4.0. " + "filler " * 40_000))
    return out


def test_documents_against_brute_force(spark):
    """Nulls, empty and very long texts, repeated rows, null ids, clashing extra columns."""
    rows = documents(mixed_texts())
    docs = frame(spark, rows).withColumn("text_", F.lit(1)).withColumn("row", F.lit(1)).withColumn("labels", F.lit("x"))
    got = sorted((tuple(r)[:8] for r in licenses.find_licenses(docs).collect()), key=repr)
    assert got == sorted(((r[0], *scan_by_force(r[1])) for r in rows), key=repr)
    assert licenses.find_licenses(docs.limit(0)).collect() == []


def test_places_and_kept_columns(spark):
    docs = spark.createDataFrame([("a", 1, "Code: Apache License, version 2.0; docs: CC BY-SA 4.0"), ("b", None, None)], "text string, no long, body string")
    rows = licenses.find_licenses(docs, "body", ["text", "no"]).orderBy("text").collect()
    assert [(p.start, p.end, p.label) for p in rows[0].places] == [(1, 6, "apache-2.0"), (7, 12, "cc-by-sa")]
    assert (rows[0].text, rows[0].no, rows[0].score) == ("a", 1, 0.7)
    assert (rows[1].text, rows[1].no, rows[1].n_words, rows[1].labels, rows[1].places) == ("b", None, 0, "", [])


def test_special_names_win(spark):
    for text, labels in (
        ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"), ("released under the MIT License", "mit"), ("(mit) license of mit", "mit"),
        ("BSD 3-Clause License", "bsd-3-clause"), ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa"),
        ("placed this file into the public domain", "public-domain"), ("an open door", "")):
        assert licenses.scan(text.encode())[5] == labels, text


def test_suppression_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        found = [(a, a + rng.randint(1, 9), rng.randrange(6)) for a in (rng.randrange(25) for _ in range(rng.randint(0, 25)))]
        assert licenses.uncontained(found) == outermost(found)


def hold_keyword(rule):
    body = rule.pattern.pattern.removeprefix(b"(?<= )").removesuffix(b"(?= )").replace(b"[^ ]+", b"[a-z]{2,5}")

    @settings(max_examples=10, database=None, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.from_regex(re.compile(body), fullmatch=True))
    def holds(text):
        assert rule.keyword in text.split() and rule.pattern.search(b" " + text + b" ")
        assert licenses.scan(text)[7]

    holds()


def test_every_match_holds_its_keyword():
    """Texts drawn from each pattern; without this the prefilter would lose matches."""
    warnings.simplefilter("ignore")
    known = rules()
    assert len(known) >= 200 and [r.priority for r in known] == list(range(len(known)))
    for rule in known:
        hold_keyword(rule)
