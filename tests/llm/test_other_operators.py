"""Vectors, conversations, toxicity and the pipeline."""

from __future__ import annotations

import random
import zlib
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest

import corpus_pipeline
from tariffworks.llm import chat, pq, toxicity
from tests.compare import connect, difference
from tests.llm.fixtures import documents, frame, words

SF = "/root/testdata/sf0.001"


def vectors_by_force(rows):
    sound = {}
    for i, (_, v, *_) in enumerate(rows):
        if rows[i][0] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float) / np.abs(np.array(v, float)).max()
            sound[i] = x / np.linalg.norm(x)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sound:
        for j in sound:
            if i != j and len(sound[i]) == len(sound[j]) and sound[i] @ sound[j] >= 0.9:
                links[i] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, links[i], None if d is None else least[root(i)], d is None or d == least[root(i)])
                   for i, (d, *_) in enumerate(rows)), key=repr)


def vector_rows(n=60, dim=16):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((n, dim))
    rows = [(i, base[i].tolist(), 0, None) for i in range(n)]
    rows += [(100 + i, (base[i % 4] + 0.15 * rng.standard_normal(dim)).tolist(), 0, None) for i in range(60)]
    rows += [(200 + i, base[i % 3].tolist(), 1, None) for i in range(9)]
    rows += [(300, None, 0, None), (301, [0.0] * dim, 0, None), (302, [None] + [1.0] * (dim - 1), 0, None),
             (303, [float("nan")] + [1.0] * (dim - 1), 0, None), (304, [float("inf")] + [1.0] * (dim - 1), 0, None),
             (305, [], 0, None), (306, [1.0, 2.0], 0, None), (307, [2.0, 4.0], 0, None), (308, [1e300, 2e300], 0, None),
             (309, (base[0] * 7).tolist(), 0, None), (None, base[0].tolist(), 0, None)]
    return rows


VECTORS = "vec_id long, embedding array<double>, label int, list string"


def test_vectors(spark):
    rows = vector_rows()
    got = pq.near_vectors(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert sorted(map(tuple, got.collect()), key=repr) == vectors_by_force(rows)


def test_vectors_in_many_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(pq, "LIST", 20)
    monkeypatch.setattr(pq, "MEMBERS", 8)
    monkeypatch.setattr(pq, "QUERIES", 16)
    rows = vector_rows(200)
    got = {r[0]: r for r in pq.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()}
    want = {r[0]: r for r in vectors_by_force(rows)}
    assert all(got[d][1] <= want[d][1] for d in want)
    assert sum(r[1] for r in got.values()) >= 0.99 * sum(r[1] for r in want.values())


def test_vectors_whose_smallest_ids_are_dense(spark, monkeypatch):
    monkeypatch.setattr(pq, "LIST", 200)
    rng = np.random.default_rng(2)
    dense = np.repeat(rng.standard_normal((400, 16)), 10, axis=0) + 0.01 * rng.standard_normal((4000, 16))
    loose, away = (rng.standard_normal((800, 16)) for _ in range(2))
    loose /= np.linalg.norm(loose, axis=1, keepdims=True)
    away -= (away * loose).sum(1, keepdims=True) * loose
    pairs = 0.905 * loose + np.sqrt(1 - 0.905**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    x = np.concatenate([dense, loose, pairs])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    got = dict(pq.near_vectors(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>"))
               .select("vec_id", "n_links").collect())
    assert [i for i in range(len(x)) if got[i] != want[i]] == []


def test_vectors_that_probe_all_lists_are_stored_once(spark, monkeypatch):
    """Without clusters each vector probes all 20 lists; what is stored does not grow with their number."""
    monkeypatch.setattr(pq, "LIST", 50)
    folder = Path(urlparse(spark.conf.get("spark.checkpoint.dir")).path)
    before = set(folder.glob("llm-*"))
    x = np.random.default_rng(3).standard_normal((1000, 64))
    got = pq.near_vectors(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == [(i, 0, i, True) for i in range(1000)]
    steps = set(folder.glob("llm-*")) - before
    assert sum(spark.read.parquet(str(f)).count() for f in steps) < 3 * 1000
    assert sum(p.stat().st_size for f in steps for p in f.rglob("*.parquet")) < 2 * x.nbytes


def test_vectors_of_many_blocks_against_force(spark, monkeypatch):
    """Copies in other partitions, signed zeros, ids that two vectors have, and numbers of 24 and of 53 bits."""
    monkeypatch.setattr(pq, "LIST", 20)
    monkeypatch.setattr(pq, "MEMBERS", 8)
    rng = np.random.default_rng(4)
    near = np.repeat(rng.standard_normal((30, 8)), 6, axis=0) + 0.1 * rng.standard_normal((180, 8))
    near[90:] = near[90:].astype(np.float32)
    near[:12, 3] = 0.0
    rows = [(i, x.tolist(), 0, None) for i, x in enumerate(near)]
    rows += [(500 + i, (-0.0 * (near[i] == 0) + near[i]).tolist(), 0, None) for i in range(0, 180, 3)]
    rows += [(900, near[k].tolist(), 0, None) for k in (1, 1, 170, 171)]
    got = pq.near_vectors(spark.createDataFrame(rows, VECTORS).repartition(5))
    links = dict.fromkeys(range(len(rows)), 0)
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.9).sum(1) - 1
    alone = [i for i in links if rows[i][0] != 900]
    assert {r[0]: r[1] for r in got.collect() if r[0] != 900} == {rows[i][0]: linked[i] for i in alone}


def test_nearest_list_of_a_vector_does_not_depend_on_its_batch():
    centroids = np.array([[1.0, 2.0, 3.0], [3.0, 2.0, 1.0], [1.0, 2.0, 3.0]])
    model = pq.Model(centroids, [])
    x = pq._unit(np.array([[1.0, 1.0, 1.0], [0.3, 0.3, 0.3], [7.0, 1.0, 0.0]]))
    assert model.nearest(x).tolist() == [0, 0, 1]
    assert [int(model.nearest(r[None])[0]) for r in x] == [0, 0, 1]


def test_vectors_empty(spark):
    assert pq.near_vectors(spark.createDataFrame([], VECTORS)).collect() == []


CHAT = "conv_id long, turn long, role string, text string, speaker string, start int"


def test_codes_leave_few_vectors_and_no_near_one_out():
    numbers = np.random.default_rng(7)
    x = pq._unit(numbers.normal(size=(4000, 64)))
    model = pq.train(x, len(x))
    lists = model.distances(x).argmin(1)
    codes, off = model.coded(x, lists)
    held = model.centroids[lists] + np.hstack([book[codes[:, s]] for s, book in enumerate(model.books)])
    least = pq._least_product((held**2).sum(1), off, np.arccos(0.9))
    assert (x @ held.T >= least).mean() < 0.03  # 0.2 by the triangle inequality of distances
    aside = numbers.normal(size=x.shape)
    aside = pq._unit(aside - (aside * x).sum(1, keepdims=True) * x)
    near = 0.9 * x + np.sqrt(1 - 0.81) * aside
    assert ((near * held).sum(1) >= least - 1e-9).all()
    # The worst case lies in the plane of a vector and its code.
    off_code = x * (held * x).sum(1, keepdims=True) - held
    worst = 0.9 * x + np.sqrt(1 - 0.81) * pq._unit(off_code)
    assert np.allclose((worst * held).sum(1), least)


def test_perspectives_against_sql(spark):
    con = connect(SF)
    assert difference(chat.rotate(spark.read.parquet(f"{SF}/conversations.parquet")), con, chat.ROTATE_SQL) is None


def test_perspectives_of_odd_turns(spark, tmp_path):
    rng = random.Random(1)
    rows = [(1, t, rng.choice(["ann", "bob", "<|x"]), words(rng, 3), "s", 0) for t in range(200)]
    rows += [(1, 5, "ann", "again", "s", 0)] * 2
    rows += [(2, None, None, None, None, None), (2, 0, "system", "<|end|> <||", None, None), (3, 0, "system", "alone", None, None),
             (None, 1, "ann", "", None, None), (None, 0, "bob", None, None, None)]
    df = spark.createDataFrame(rows, CHAT)
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert difference(chat.rotate(df.repartition(4)), con, chat.ROTATE_SQL) is None
    for r in chat.rotate(df).where("mask <> ''").collect():
        for a, b in (m.split(":") for m in r.mask.split(",")):
            assert r.text[: int(a)].endswith("<|assistant|>\n") and r.text[int(a) : int(b)].endswith("<|end|>")
    whole = "".join(r.text for r in chat.rotate(df).where("conv_id = 1 and speaker = 'ann'").orderBy("part").collect())
    assert whole.count("<|end|>\n") == 202


def test_perspectives_empty(spark):
    assert chat.rotate(spark.createDataFrame([], CHAT)).collect() == []


def toxic_rows(n=900):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 8 == 0
        text = words(rng, rng.randint(20, 80)).split()
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["Vileword", "nastyword!", "hatestem" + rng.choice("abcde")]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    docs = frame(spark, documents(rows)).cache()
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, marks).collect()
    assert len(got) == len(documents(rows))
    truth = {d: t for d, _, t in labels}
    for r in got:
        assert r.doc_id is None or r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id > 420]
    right = [r.predicted == truth[r.doc_id] for r in held]
    assert len(held) > 60 and sum(right) / len(right) > 0.97
    clean = toxicity.clean_documents(docs, marks)
    assert clean.columns == docs.columns
    assert clean.count() == sum(1 - r.predicted for r in got)


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, documents(n=12))
    assert {r.predicted for r in toxicity.classify(docs, none).collect()} == {0}
    assert toxicity.classify(docs.limit(0), none).collect() == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    packed = corpus_pipeline.run(spark, SF).collect()
    assert packed and max(r.length for r in packed) <= 2048


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_documents(spark, name, stage):
    odd = frame(spark, documents())
    out = stage(spark, odd, SF)
    assert out.count() > 0
    assert name == "packing" or out.columns == odd.columns
    assert stage(spark, odd.limit(0), SF).count() == 0
