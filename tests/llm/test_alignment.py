"""Token alignment against both tokenizers run on whole texts, without pieces, spans or chunks."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tariffworks.llm import alignment
from tests.llm.fixtures import documents, frame, words

ALPHABET = ["a", "b", "The", " ", " ", "  ", "\n", "\t", "\r\n", "é", "日本", "🎉", "𐍈", "'s", " ", "　", "\x1c", "\x85",
            "<|endoftext|>", "<s>", "\n", ".", "²", "word", "'", "▁", "12", ",", "...", "\x00", "ß", "​", "ﬁ"]


def odd_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 25))) for _ in range(n)]


class Plain:
    """Tokens with their bytes; A's are looked up in the file of the same vocabulary as byte strings."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
        self.a_bytes = {int(i): base64.b64decode(t) for t, i in map(bytes.split, lines)}

    def b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes.fromhex(piece[3:5]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        raw = (" " + (text or "")).encode()
        if not text:
            return []
        sides = []
        for ids, spelt in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes.__getitem__),
                           (self.b.encode(text), self.b_bytes)):
            at, ends = 0, {}
            for i in ids:
                at += len(spelt(i))
                ends[at] = i
            if b"".join(map(spelt, ids)) != raw:
                return []
            sides.append(ends)
        common = sorted(set(sides[0]) & set(sides[1]))
        return [tuple([i for e, i in side.items() if lo < e <= hi] for side in sides)
                for lo, hi in zip([0, *common], common)]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def align_by_force(plain, rows):
    aligned = [plain.groups(r[1]) for r in rows]
    counts = Counter((a[-1], b[-1]) for groups in aligned for a, b in groups)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for r, groups in zip(rows, aligned, strict=True):
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((r[0], sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def test_pieces_against_whole_texts(plain):
    """Whatever white space, marks, controls or characters of several bytes meet where texts are cut."""
    aligner = alignment._aligner(None)
    texts = odd_texts(1500, 1) + [words(random.Random(2), 300), "x" * 50_000, " " * 5_000, "é" * 3_000]
    for text, got in zip(texts, aligner.of(texts), strict=True):
        groups = plain.groups(text)
        want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups).encode()
        assert (got[0] if got else b"") == want, text


def test_documents_against_brute_force(spark, plain, monkeypatch):
    """Nulls, empty and very long texts, repeated rows, null ids, clashing extra columns; chunks of few documents."""
    monkeypatch.setattr(alignment, "LINKS", 500)
    rows = documents([(5000 + i, t) for i, t in enumerate(odd_texts(60, 3))])
    docs = frame(spark, rows).withColumn("chunk", F.lit(1)).withColumn("n_a", F.lit("x")).withColumn("codes", F.lit(0))
    got = alignment.align_tokens(docs).collect()
    assert sorted(map(tuple, got), key=repr) == align_by_force(plain, rows)
    assert alignment.align_tokens(docs.limit(0)).collect() == []


def test_groups_spell_the_text(spark, plain):
    rows = documents()[:20]
    for r in alignment.align_tokens(frame(spark, rows), with_groups=True).collect():
        text = next(t for d, t, *_ in rows if d == r.doc_id)
        sides = [g.split("|") for g in r.groups.split(";")]
        for a, b in sides:
            assert b"".join(plain.a_bytes[int(i)] for i in a.split(",")) == b"".join(plain.b_bytes(int(i)) for i in b.split(","))
        assert b"".join(plain.a_bytes[int(i)] for a, _ in sides for i in a.split(",")).decode() == " " + text
        assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 and len(sides) == r.n_groups


def test_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    import public_tokenizers as p

    aligner = alignment.Aligner(p.path(alignment.A_FILE), p.path(alignment.B_FILE))
    fresh = alignment._aligner(None)
    for seed in range(6):
        texts = [words(random.Random(seed), 60), "y" * 300 + " z"]
        assert list(aligner.of(texts)) == list(fresh.of(texts))
        assert len(aligner.recent) <= 130 and not any(len(p) > alignment.LONGEST for p in aligner.recent)
        assert len(aligner.firsts) <= 130 and len(aligner.later) <= 130
