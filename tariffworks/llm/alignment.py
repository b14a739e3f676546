"""Alignment of the tokens of two public tokenizers, and how often their ids are linked.

A is a byte-level BPE (tokenizers), B a BPE with byte fallback (sentencepiece).  Character offsets
of A and the spans of B's proto are the coarse cuts: where a span ends between two characters, the
token ends there.  Tokens that end inside a character (pieces of a multibyte character, tokens of
byte fallback) share their character's span; their ends are refined by the bytes that the tokens
before them decode to.  Byte offsets where tokens of both end cut them into groups.

Neither vocabulary joins over a space that follows anything but white space, so texts are cut there
and a task aligns each different piece of text once and remembers it.  Neither joins a letter and a
mark that follows it, nor a line feed and what comes before it, so a piece that has not been seen
yet is put together from parts that have.

Counts of linked ids over the whole corpus come in three steps.  Tasks reduce their documents in
chunks of about `LINKS` links to one row with the chunk's different id pairs; these are summed over
the corpus; the sums that a chunk asks for meet its documents again.  A pair is shuffled once per
chunk, however many documents hold it, and no task holds more than a chunk.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffworks.llm.common import chunks, stored

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Links of a chunk, about; a longer document is a chunk of its own.
LINKS = 1 << 20
#: Pieces of text that a task remembers (twice at most), and their parts; and how long a piece remembered may be.
REMEMBERED, LONGEST = 300_000, 200
#: Pieces that are encoded together.
TOGETHER = 2000
_SPLIT = re.compile(r"(?<=\S)(?= )")
_ODD_SPACE = re.compile(r"\s ")
_PARTS = regex.compile(r"(?<=\p{L})(?=[^\w\s])|(?<=\S)(?=\n\S)")


@cache
def _printed_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 ones stand
    for themselves, the others have the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and what is remembered of the pieces of text seen so far."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are ordinary text
        self.b = SentencePieceProcessor(model_file=b_path)
        printed = _printed_bytes()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.n_b = self.b.vocab_size()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(printed[c] for c in token)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.n_b)))]
        self.a_size = np.array([len(t) for t in self.a_bytes])
        self.b_size = np.array([len(t) for t in self.b_bytes])
        self.firsts: dict[str, tuple | None] = {}
        self.later: dict[str, tuple | None] = {}
        self.recent: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def ends(self, text: str) -> tuple[list[int], np.ndarray, list[int], np.ndarray] | None:
        """Ids of A and the byte offsets where they end in the text, and those of B; the text starts with a space.

        None if the tokens of either do not spell the text.
        """
        raw = text.encode()
        encoded = self.a.encode(text, add_special_tokens=False)
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        a_ids, b_ids = encoded.ids, [p.id for p in pieces]
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != raw or b"".join(map(self.b_bytes.__getitem__, b_ids)) != raw:
            return None

        # A: spans in characters.  A span that the next one reaches into ends inside a character.
        spans = np.array(encoded.offsets).reshape(-1, 2)
        starts_of_characters = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        byte_of = np.append(starts_of_characters, len(raw))
        whole = np.append(spans[1:, 0] >= spans[:-1, 1], True)
        a_ends = np.where(whole, byte_of[spans[:, 1]], np.cumsum(self.a_size[a_ids]))

        # B: spans in bytes of the text without the added space.  Tokens of byte fallback have empty spans but for the last.
        spans = np.array([p.end for p in pieces]) + 1
        whole = np.diff(spans, prepend=0) > 0
        b_ends = np.where(whole, spans, np.cumsum(self.b_size[b_ids]))
        return a_ids, a_ends, b_ids, b_ends

    def align(self, pieces: list[str]) -> list[tuple | None] | None:
        """For each piece of text (without the space before it): its groups as `a1,a2|b1;a3|b2`, its links
        (id of A times the size of B's vocabulary, plus the id of B; 32 bits), and the numbers of its tokens."""
        text = "".join([" " + p for p in pieces])
        found = self.ends(text)
        if found is None:
            return None
        a_ids, a_ends, b_ids, b_ends = found
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_to, b_to = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
        links = (np.array(a_ids)[a_to - 1] * self.n_b + np.array(b_ids)[b_to - 1]).astype("<i4")
        a_text, b_text = list(map(str, a_ids)), list(map(str, b_ids))
        a_cut, b_cut = [0, *a_to.tolist()], [0, *b_to.tolist()]
        groups = [",".join(a_text[a_cut[i] : a_cut[i + 1]]) + "|" + ",".join(b_text[b_cut[i] : b_cut[i + 1]]) for i in range(len(common))]
        piece_ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        last = np.searchsorted(common, piece_ends)
        if not np.array_equal(common[last], piece_ends):
            raise ValueError("a token runs over the end of a piece of text")
        out, first = [], 0
        for to in (last + 1).tolist():
            out.append((";".join(groups[first:to]).encode(), links[first:to].tobytes(),
                        a_cut[to] - a_cut[first], b_cut[to] - b_cut[first]))
            first = to
        return out

    def _encode(self, pieces: list[str]) -> dict[str, tuple | None]:
        out: dict[str, tuple | None] = {}
        # White space at the end of a piece may belong to what follows, so such pieces stand alone, after a letter.
        alone = [p for p in pieces if not p or p[-1].isspace()]
        joined = [p for p in pieces if p and not p[-1].isspace()]
        for i in range(0, len(joined), TOGETHER):
            part = joined[i : i + TOGETHER]
            aligned = self.align(part)
            if aligned is None:
                alone += part
            else:
                out.update(zip(part, aligned, strict=True))
        for piece in alone:
            aligned = self.align(["x", piece])
            out[piece] = None if aligned is None else aligned[1]
        return out

    def _learn(self, pieces: list[str]) -> Iterator[tuple[str, tuple | None]]:
        """Pieces not seen yet, put together from their first part and the later ones, which have no space before them."""
        split = [_PARTS.split(p) for p in pieces]
        firsts = {parts[0] for parts in split}.difference(self.firsts)
        later = {part for parts in split for part in parts[1:]}.difference(self.later)
        # A later part is encoded behind a letter, whose group is then left out.
        self.firsts.update(self._encode(list(firsts)))
        for part, found in self._encode(["x" + part for part in later]).items():
            self.later[part[1:]] = found and (found[0].partition(b";")[2], found[1][4:], found[2] - 1, found[3] - 1)
        for piece, (first, *rest) in zip(pieces, split, strict=True):
            found = [self.firsts[first], *map(self.later.__getitem__, rest)]
            if len(found) == 1:
                yield piece, found[0]
            elif None in found:
                yield piece, None
            else:
                groups, links, n_a, n_b = zip(*found, strict=True)
                yield piece, (b";".join(groups), b"".join(links), sum(n_a), sum(n_b))
        for known in (self.firsts, self.later):
            if len(known) > REMEMBERED:
                known.clear()

    def of(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes, int, int] | None]:
        """Groups, links and numbers of tokens of each text; None for texts without tokens."""
        split = []
        for text in texts:
            if not text:
                split.append([])
            elif _ODD_SPACE.search(" " + text):
                split.append([p[1:] for p in _SPLIT.split(" " + text)])
            else:
                split.append(text.split(" "))
        unseen = []
        for piece in set().union(*split):
            if piece not in self.recent:
                if piece in self.older:
                    self.recent[piece] = self.older[piece]
                else:
                    unseen.append(piece)
        for piece, aligned in self._learn(unseen):
            self.recent[piece] = aligned
        for pieces in split:
            aligned = [self.recent[p] for p in pieces]
            if not aligned or None in aligned:
                yield None
            else:
                groups, links, n_a, n_b = zip(*aligned, strict=True)
                yield b";".join(groups), b"".join(links), sum(n_a), sum(n_b)
        for piece in unseen:
            if len(piece) > LONGEST:
                del self.recent[piece]
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(paths: tuple[str, str] | None) -> Aligner:
    if paths is None:
        import public_tokenizers

        paths = public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE)
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


_DOC = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, groups string"
#: A row is a document (pairs, times: its different pairs as numbers into those of its chunk, and how often
#: it has each, as 32-bit numbers) or a chunk (codes: its different pairs in order; sums: how often it has each).
_STEP = f"chunk long, {_DOC}, pairs binary, times binary, codes array<int>, sums array<long>"
_STEP_ARROW = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("groups_sha256", pa.string()), ("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
    ("codes", pa.list_(pa.int32())), ("sums", pa.list_(pa.int64()))])


def _chunk_rows(chunk: int, docs: list[tuple]) -> pa.RecordBatch:
    """The rows of documents (doc_id, groups, links, n_a, n_b) and the row of their chunk."""
    links = [np.frombuffer(d[2], "<i4") for d in docs]
    codes, numbers, sums = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
    rows, at = [], 0
    for (doc_id, digest, _, n_a, n_b, groups), own in zip(docs, links, strict=True):
        pairs, times = np.unique(numbers[at : at + len(own)], return_counts=True)
        at += len(own)
        deltas = np.diff(pairs, prepend=0).astype("<i4").tobytes()
        rows.append((chunk, doc_id, n_a, n_b, len(own), digest, groups, deltas, times.astype("<i4").tobytes(), None, None))
    rows.append((chunk, *[None] * 8, codes, sums))
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind.type) for values, kind in zip(zip(*rows, strict=True), _STEP_ARROW, strict=True)], schema=_STEP_ARROW)


def _aligned(docs: DataFrame, paths: tuple[str, str] | None, with_groups: bool) -> DataFrame:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(paths)
        chunk, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            sizes = [b"" if t is None else t for t in texts]
            for a, b in chunks(sizes):
                plain = [None if t is None else t.decode() for t in texts[a:b]]
                for doc_id, found in zip(ids[a:b], aligner.of(plain), strict=True):
                    groups, links, n_a, n_b = found or (b"", b"", 0, 0)
                    digest = hashlib.sha256(groups).hexdigest() if groups else ""
                    held.append((doc_id, digest, links, n_a, n_b, groups.decode() if with_groups else None))
                    n += len(links) // 4
                    if n >= LINKS:
                        yield _chunk_rows(chunk, held)
                        chunk, held, n = chunk + 1, [], 0
        if held:
            yield _chunk_rows(chunk, held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text")).mapInArrow(align, _STEP)


def pair_counts(steps: DataFrame, n_b: int) -> DataFrame:
    """code, count, best (greatest count of a code with the same id of B) over all chunks."""
    totals = steps.where("codes IS NOT NULL").select(F.explode(F.arrays_zip("codes", "sums")).alias("p")) \
        .groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.sums").alias("count"))
    return totals.withColumn("best", F.max("count").over(Window.partitionBy(F.col("code") % n_b)))


def align_tokens(docs: DataFrame, paths: tuple[str, str] | None = None, with_groups: bool = False) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_a, n_b (tokens), n_groups, n_links, n_best,
    count_sum, groups_sha256, and the groups themselves if asked for.

    A link is a token of A and one of B that end at the same byte; its count is how many links of the
    corpus have the same two ids.  n_best counts the links whose count no other id of A has with
    the same id of B (ties included); count_sum adds the counts up.  Null and empty texts, and
    texts that the tokens of A or B do not spell (U+2581, which B reads as a space), have no
    tokens: zeros, and an empty groups_sha256.  Repeated rows count repeatedly.  Null ids stay
    null; other columns are ignored.  `paths` are the files of A and B, the public ones if not given.
    """
    steps = stored(_aligned(docs, paths, with_groups), "aligned")
    n_b = _aligner(paths).n_b
    totals = stored(pair_counts(steps, n_b), "pairs")
    asked = steps.where("codes IS NOT NULL").select("chunk", F.posexplode("codes").alias("number", "code"))
    answers = asked.join(totals, "code").select(F.col("chunk").alias("of_chunk"), "number", "count", (F.col("count") == F.col("best")).alias("is_best"))
    own = steps.where("codes IS NULL").select("chunk", *[c.split(" ")[0] for c in _DOC.split(", ")], "pairs", "times")

    def score(documents: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("number").to_numpy())
        counts = answers.column("count").to_numpy()[order]
        best = answers.column("is_best").to_numpy()[order]
        n_best, sums = [], []
        for pairs, times in zip(documents.column("pairs").to_pylist(), documents.column("times").to_pylist(), strict=True):
            numbers, often = np.cumsum(np.frombuffer(pairs, "<i4")), np.frombuffer(times, "<i4").astype(np.int64)
            n_best.append(int(often[best[numbers]].sum()))
            sums.append(int((often * counts[numbers]).sum()))
        out = documents.drop_columns(["chunk", "pairs", "times"])
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    scored = own.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(score, f"{_DOC}, n_best long, count_sum long")
    return scored.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256",
                         *(["groups"] if with_groups else []))
