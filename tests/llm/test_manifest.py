"""The Merkle manifest against a tree built by hand, and against SQL."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tariffworks.llm import merkle, sql
from tests.compare import connect, difference
from tests.llm.fixtures import documents, frame


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text) -> str:
    return digest("".join(map(field, (row[0], row[3], row[2], row[4], text))))


def levels(nodes: list[str], fanout: int) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def audit_by_force(rows, fanout):
    by_source: dict = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    trees = []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, levels([leaf(r, r[1]) for r in own], fanout)))
    top = levels([t[-1][0] for _, t in trees], fanout)
    out = []
    for no, (own, tree) in enumerate(trees):
        for place, row in enumerate(own):
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded, siblings = leaf(row, text), ""
            for part, at in ((tree, place), (top, no)):
                for nodes in part[:-1]:
                    run = nodes[at // fanout * fanout : at // fanout * fanout + fanout]
                    left, right = "".join(run[: at % fanout]), "".join(run[at % fanout + 1 :])
                    siblings += left + right
                    folded = digest(left + folded + right)
                    at //= fanout
            root = top[-1][0]
            out.append((row[0], leaf(row, row[1]), tree[-1][0], root, digest(siblings), folded, folded == root))
    return sorted(out, key=repr)


def taken(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("fanout", [16, 4])
def test_audit(spark, fanout):
    """Nulls, empty and long texts, repeated rows, null ids and sources, clashing extra columns."""
    rows = [(*r[:4], None if i % 7 == 0 else i, *r[5:]) for i, r in enumerate(documents())]
    rows = [(*r[:2], None if i % 11 == 0 else r[2], *r[3:]) for i, r in enumerate(rows)]
    docs = frame(spark, rows).withColumn("at", F.lit(1)).withColumn("tree", F.lit("x")).withColumn("leaf", F.lit(0))
    got = taken(merkle.audit(docs, fanout))
    assert got == audit_by_force(rows, fanout)
    assert {r[-1] for r in got} == {True, False}


def test_copies_of_nodes(spark, monkeypatch):
    """Nodes near the root are stored in copies; whichever a leaf takes, its proof is the same."""
    monkeypatch.setattr(merkle, "SHARE", 4)
    rows = [(i, f"Text {i % 50}", "en", "hot" if i % 3 else f"s{i % 5}", i, 0.0, "", "", 0) for i in range(60)]
    assert taken(merkle.audit(frame(spark, rows), 2)) == audit_by_force(rows, 2)


def test_few_rows(spark):
    """One row, one source, sources of one row among others, no rows."""
    rows = documents()
    single = [(*r[:3], f"only {i}" if i < 20 else r[3], *r[4:]) for i, r in enumerate(rows)]
    for some in (rows[:1], [r for r in rows if r[3] == "b"], single):
        assert taken(merkle.audit(frame(spark, some))) == audit_by_force(some, 16)
    assert merkle.audit(frame(spark, rows).limit(0)).collect() == []


def test_links_lead_to_the_root(spark):
    """Every node but the root has a parent whose children hold its hash at its slot."""
    manifest = merkle.build(frame(spark, documents()), fanout=4)
    nodes = {(r.tree, r.level, r.node): r for r in manifest.nodes.where("copy = 0").collect()}
    roots = [n for n in nodes.values() if n.up_node is None]
    assert [n.hash.hex() for n in roots] == [manifest.root]
    for n in nodes.values():
        if n.up_node is not None:
            up = nodes[n.up_tree, n.up_level, n.up_node]
            assert up.children[32 * n.slot : 32 * n.slot + 32] == n.hash
    for r in manifest.leaves.collect():
        up = nodes[r.up_tree, r.up_level, r.up_node]
        assert up.children[32 * r.slot : 32 * r.slot + 32].hex() == r.leaf


def test_sql(spark, tmp_path):
    docs = frame(spark, documents())
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS FROM '{tmp_path}/documents/*.parquet'")
    assert difference(merkle.audit(docs), con, sql.MANIFEST) is None
