"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are positives; any other text is unlabelled, a mixture of toxic and clean
with a known share (class prior) of toxic.  A linear classifier is trained on
    prior * positive loss on positives + max(0, negative loss on unlabelled - prior * negative loss on positives)
which corrects the unlabelled part for the toxic texts in it and never lets it go below zero.

Features are the words of a text, letters in lower case, and their beginnings of 4 to 9 bytes, as
hashes.  A feature counts once a text however long that is.  The weights are a bounded table of
the features that enough positives hold, found in the positives alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffworks.llm.common import byte_sums, chunks, lower_table, range_hashes, runs

#: Rows a model is fitted on at most, drawn by hash.
POSITIVES, UNLABELLED = 4000, 12000
#: Features a model has at most, and the positives that must hold one at least.
FEATURES, LEAST_TEXTS, LEAST_SHARE = 20_000, 5, 0.01
#: A feature must be so many standard errors more frequent in positives than in unlabelled texts.
LEAST_ERRORS = 5.0
PREFIXES = (4, 5, 6, 7, 8, 9)
FOLDS = 5
ROUNDS, RATE, SHRINK = 400, 0.05, 2e-4


def _letters() -> np.ndarray:
    """Bytes of words: ASCII letters and all bytes of other characters."""
    out = np.zeros(256, bool)
    out[97:123] = True
    out[128:] = True
    return out


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and feature, for each word and word beginning; repeats included."""
    buffer = lower_table()[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    starts, ends = runs(_letters()[buffer])
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    rows = np.searchsorted(firsts, starts, "right") - 1
    sums = byte_sums(buffer)
    kinds = [(rows, range_hashes(sums, starts, ends))]
    for n in PREFIXES:
        longer = ends - starts > n
        at = starts[longer]
        kinds.append((rows[longer], range_hashes(sums, at, at + n) ^ np.uint64(n)))
    return np.concatenate([k[0] for k in kinds]), np.concatenate([k[1] for k in kinds])


def _bytes(texts: pd.Series) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def held_out(doc_id: str = "doc_id"):
    """Whether the labels of a row are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


class Model:
    """Features in ascending order, their weights, and a constant."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, constant: float):
        self.names, self.weights, self.constant = names, weights, constant

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.constant)
        for a, b in chunks(texts):
            rows, found = _held(texts[a:b], self.names)
            np.add.at(out, a + rows, self.weights[found])
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _held(texts: list[bytes], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and place among `names` of the features held, each once a text."""
    if not len(names):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, hashes = features(texts)
    at = np.searchsorted(names, hashes)
    at[at == len(names)] = 0
    hit = names[at] == hashes
    both = np.unique(rows[hit] * np.int64(len(names)) + at[hit])
    return both // len(names), both % len(names)


def _drawn(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """Texts of the n ids that come first by hash; at most n ids are sent to the tasks."""
    few = ids.distinct().orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(n)
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")


def _found(docs: DataFrame, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows, places and number of the texts, for a bounded sample."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, out = _bytes(batch["text"]), [b""] * len(batch)
            for a, b in chunks(texts):
                rows, at = _held(texts[a:b], names)
                cuts = np.searchsorted(rows, np.arange(b - a + 1))
                for i in range(b - a):
                    out[a + i] = at[cuts[i] : cuts[i + 1]].astype("<i4").tobytes()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held": out})

    got = sorted((r[0], bytes(r[1])) for r in docs.mapInPandas(find, "doc_id long, held binary").collect())
    held = [np.frombuffer(x, "<i4") for _, x in got]
    return np.repeat(np.arange(len(held)), [len(x) for x in held]), np.concatenate([np.zeros(0, "<i4"), *held]), len(held)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from docs (doc_id, text) and labels (doc_id, toxic) but for the held-out rows.

    The samples are bounded by POSITIVES and UNLABELLED.  The class prior is the toxic share of all
    labels learnt from.  Without any toxic label, nothing is toxic.
    """
    labels = labels.select("doc_id", "toxic").where(~held_out() & F.col("toxic").isNotNull())
    prior = labels.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -2.0)
    positives = _drawn(docs, labels.where("toxic = 1").select("doc_id"), POSITIVES)
    others = docs.select("doc_id").where(~held_out())
    unlabelled = _drawn(docs, others, UNLABELLED)

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = _bytes(batch["text"])
            for a, b in chunks(texts):
                rows, hashes = features(texts[a:b])
                if len(rows):
                    order = np.lexsort((hashes, rows))
                    new = np.ones(len(order), bool)
                    r, h = rows[order], hashes[order]
                    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
                    values, counts = np.unique(h[new], return_counts=True)
                    yield pd.DataFrame({"feature": values.view(np.int64), "n": counts})

    frequent = (
        positives.mapInPandas(distinct, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_TEXTS).orderBy(F.desc("n"), "feature").limit(FEATURES)
    )
    names = np.sort(np.array([r[0] for r in frequent.collect()], np.int64).view(np.uint64))
    p, u = _found(positives, names), _found(unlabelled, names)
    telling = _telling(len(names), p, u, float(prior))
    return _trained(names[telling], _only(telling, p), _only(telling, u), float(prior))


def _telling(d: int, positives, unlabelled, prior: float) -> np.ndarray:
    """Whether a feature is clearly more frequent in positives than in unlabelled texts.

    A feature that no clean text holds is 1 / prior times as frequent, as unlabelled texts are partly
    toxic; three quarters of the way there from equal shares is asked for,
    and a share of the positives.
    """
    (_, pc, n_p), (_, uc, n_u) = positives, unlabelled
    if not n_p or not n_u:
        return np.zeros(d, bool)
    a, b = np.bincount(pc, minlength=d), np.bincount(uc, minlength=d)
    share = (a + b) / (n_p + n_u)
    error = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u)) + 1e-12
    lift = 0.25 + 0.75 / prior
    clear = ((a / n_p - b / n_u) / error >= LEAST_ERRORS) & (a / n_p >= lift * b / n_u)
    return clear & (a >= max(LEAST_TEXTS, LEAST_SHARE * n_p))


def _only(keep: np.ndarray, found):
    """What was found, for some of the features."""
    rows, cols, n = found
    hit = keep[cols] if len(keep) else np.zeros(len(cols), bool)
    return rows[hit], (np.cumsum(keep) - 1)[cols[hit]], n


def _trained(names: np.ndarray, positives, unlabelled, prior: float) -> Model:
    """Minimise the risk by full gradients (Adam), weights shrunk towards zero."""
    (pr, pc, n_p), (ur, uc, n_u) = positives, unlabelled
    if not n_p or not n_u:
        return Model(names, np.zeros(len(names)), -2.0)
    d = len(names)
    theta = np.zeros(d + 1)
    theta[d] = np.log(prior / (1 - prior)) if prior < 1 else 2.0
    m, v = np.zeros(d + 1), np.zeros(d + 1)

    def outputs(rows, cols, n):
        return np.bincount(rows, theta[cols], n) + theta[d]

    def gradient(rows, cols, slopes):
        g = np.empty(d + 1)
        g[:d] = np.bincount(cols, slopes[rows], d)
        g[d] = slopes.sum()
        return g

    for t in range(1, ROUNDS + 1):
        fp, fu = outputs(pr, pc, n_p), outputs(ur, uc, n_u)
        sp, su = 1 / (1 + np.exp(-np.clip(fp, -30, 30))), 1 / (1 + np.exp(-np.clip(fu, -30, 30)))
        # Logistic losses: log(1 + exp(-f)) for a positive, log(1 + exp(f)) for a negative.
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g = gradient(pr, pc, -(1 - sp) * prior / n_p)
        if negative >= 0:
            g += gradient(ur, uc, su / n_u) - gradient(pr, pc, sp * prior / n_p)
        g[:d] += SHRINK * theta[:d]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(names, theta[:d], float(theta[d]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each row of docs (doc_id, text); null and empty texts score like a text without features."""
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": model.scores(_bytes(batch["text"]))})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(scored, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs.

    A null doc_id counts as held out.  Labels of unknown documents and null labels teach nothing.
    Repeated rows are scored each.  Extra columns are ignored.
    """
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs, all columns, whose text scores below 0.5."""
    model = fit(docs, labels)

    @F.pandas_udf("double")
    def scores(text: pd.Series) -> pd.Series:
        return pd.Series(model.scores(_bytes(text)))

    return docs.where(scores("text") < 0.5)
