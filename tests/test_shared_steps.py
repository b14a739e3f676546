"""Steps that many queries share: rules, links of names, operations by supplier."""

import datetime
import random
import re
from unittest.mock import MagicMock

from pyspark.sql import functions as F

from catalog import files
from tariffworks import fixed_values as V
from tariffworks.functions import rules
from tariffworks.operators import linkage
from tariffworks.plans import adapters
from tariffworks.sources import readers

T = datetime.datetime


def test_rules_look_at_a_letter_first():
    rng = random.Random(4)
    words = [re.sub(r"\\s\+|\\|[()?]", " ", p) for table in (V.CASE_TYPE_RULES, V.UTILITY_TYPE_RULES) for _, ps, ks in table for p in [*ps, *ks]]
    texts = [rng.choice(["", "x", "UE-", "\n"]).join(rng.choice([w, w.upper(), w[1:], " ", "|", "natural  gas", "wastewater treatment"])
                                                    for w in rng.sample(words, 4)) for _ in range(3000)]
    for table in (V.CASE_TYPE_RULES, V.UTILITY_TYPE_RULES):
        for (label, ps, ks), (same, pattern) in zip(table, rules._compiled(table), strict=True):
            plain = re.compile("|".join(f"(?:{p})" for p in [*ps, *map(re.escape, ks)]), re.I | re.A)
            assert label == same and pattern.startswith("(?i)(?=[")
            assert [bool(plain.search(t)) for t in texts] == [bool(re.search(pattern, t, re.A)) for t in texts]
    assert [rules._first_letters(p) for p in ("x?y", "ab|cd", r"\d+ab", "(a+|b)cd", "(no )?go")] == [None] * 5


def test_links_of_repeated_names(spark):
    """The last row of a form gives the id, however its spellings repeat."""
    links = spark.createDataFrame(
        [("Acme Power Inc.", "or", 1, 1), ("Acme Power", "OR", 2, 5), ("Acme Power Inc.", "or", 3, 7), ("Acme Power Inc.", "OR", 4, 3),
         ("Other Water", None, 9, 2)], "utility_name string, state string, eia_utility_id long, seq long")
    emissions = spark.createDataFrame([("ACME POWER CORP", "or", 77), ("Other Water", None, 78), ("Nobody", "or", 79)],
                                      "utility_name_egrid string, state string, eia_utility_id long")
    assert sorted((r.utility_name_egrid, r.eia_utility_id, r.is_linked) for r in linkage.link_emissions(links, emissions).collect()) == [
        ("ACME POWER CORP", 3, True), ("Nobody", 79, False), ("Other Water", 9, True)]


def test_operations_of_repeated_suppliers(spark, tmp_path):
    """A supplier that comes twice has its lines twice and its orders once; lines are dealt out before they are summed up."""
    rows = {
        "nation": [(0, "ALGERIA", 0)],
        "supplier": [(1, "S1", 0, 1.0), (1, "S1", 0, 2.0), (1, "S1b", 0, 1.0), (2, "S2", 0, 1.0), (None, "S3", 0, 1.0)],
        "lineitem": [(o, 1, s, 1, 10.0, 1000.0, 0.0, 0.0, f, "F", T(1995, 1, 1))
                     for o, s, f in [(1, 1, "A"), (1, 1, "N"), (2, 1, "A"), (3, 2, "R"), (4, None, "A"), (5, 7, "A")]],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, adapters.TABLE_TYPES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    got = adapters.utility_operations(spark, str(tmp_path))
    assert "RepartitionByExpression" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.utility_name, r.total_customers, r.residential_customers, r.total_revenue, r.total_sales_mwh, r.avg_price) for r in got.collect()) == [
        ("S1", 2, 2, 6.0, 60.0, 1.0), ("S1b", 2, 2, 3.0, 30.0, 1.0), ("S2", 1, None, 1.0, 10.0, 1.0)]


def test_operations_are_summed_up_where_lines_are_dealt(spark, tmp_path):
    """Lines are shuffled once: orders, then years, are summed up in the same task, and few rows a year go on."""
    rows = {
        "nation": [(0, "ALGERIA", 0)], "supplier": [(1, "S1", 0, 1.0)],
        "lineitem": [(o, 1, 1, 1, 10.0, 1000.0, 0.0, 0.0, "ANR"[o % 3], "F", T(1995, 1, 1)) for o in range(2000)]}
    for name, values in rows.items():
        spark.createDataFrame(values, adapters.TABLE_TYPES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    got = adapters.utility_operations(spark, str(tmp_path))
    assert re.search(r"RepartitionByExpression \[l_suppkey#\d+L, year#\d+, part#\d+\]", got._jdf.queryExecution().optimizedPlan().toString())
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", got._jdf.queryExecution().executedPlan().toString())
    assert shuffled and not any("l_orderkey" in keys for keys in shuffled)
    assert [(r.total_customers, r.residential_customers, r.total_sales_mwh) for r in got.collect()] == [(2000, 667, 20000.0)]


def test_emissions_of_repeated_suppliers(spark, tmp_path):
    """A supplier that comes twice has its lines twice; names join the sums, not the lines."""
    rows = {
        "nation": [(0, "ALGERIA", 0), (1, "ARGENTINA", 1)], "part": [(1, "p", "b", "STANDARD", 3, 1.0), (2, "p", "b", "PROMO", 5, 1.0)],
        "supplier": [(1, "S1", 1, 1.0), (1, "S1", 1, 2.0), (2, "S2", 0, 1.0), (None, "S3", 0, 1.0)],
        "lineitem": [(o, p, s, 1, 10.0, 1000.0, 0.0, 0.0, "A", "F", T(1995, 1, 1))
                     for o, p, s in [(1, 1, 1), (2, 2, 1), (3, 1, 2), (4, 2, None), (5, 9, 1)]]}
    for name, values in rows.items():
        spark.createDataFrame(values, adapters.TABLE_TYPES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    got = adapters.utility_emissions(spark, str(tmp_path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("s_suppkey") < plan.index("l_partkey")  # printed from the last step to the first
    assert sorted((r.utility_name_egrid, r.eia_utility_id, r.net_generation_mwh, r.co2_tons, r.coal_pct, r.wind_pct) for r in got.collect()) == [
        ("S1", 1, 40.0, 160.0, 50.0, 50.0), ("S2", None, 10.0, 30.0, 100.0, None)]


def test_exports_read_stored_tables(monkeypatch):
    """Each derived table is worked out once, whatever reads it."""
    seen = {}
    monkeypatch.setattr(files.jobs, "export", lambda tables, folder, formats: seen.update(tables))
    monkeypatch.setattr(files, "scratch", lambda s: "folder")
    monkeypatch.setattr(files, "_kept", lambda s, tables, folder: {name: f"{folder}/{name}" for name in tables})
    for name in ("rate_cases", "utility_operations", "utility_emissions", "utilities", "links"):
        monkeypatch.setattr(files.A, name, MagicMock())
    monkeypatch.setattr(files, "capacity", MagicMock())
    impacts = MagicMock()
    monkeypatch.setattr(files.impact, "rate_case_impacts", impacts)
    files._export(MagicMock(), "d")
    assert all(seen[x] == f"folder/tables/{x}" for x in (
        "rate_cases", "utility_operations", "utility_emissions", "utility_capacity", "rate_case_impacts"))
    assert impacts.call_args.args[0] == seen["rate_cases"] and impacts.call_args.args[2] == seen["utility_operations"]


def test_rows_of_operations_files_are_not_broadcast(spark, tmp_path):
    """Rows meet the header of their file in parts; cells behind the last filled one are empty, as before."""
    (tmp_path / "year=1999").mkdir()
    (tmp_path / "year=1999" / "a.csv").write_text(
        "Utility Number,Utility Name,State,Total Customers\n" + "".join(f"{i},U{i},OR,{i * 10}\n" for i in range(1, 200)) + "200,U200\n,,\n")
    rows, others = readers.read_operations_files(spark, f"{tmp_path}/*", F.regexp_extract("file", r"year=(\d+)", 1).cast("int"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [file" in plan and not re.search(r"BroadcastHashJoin \[file#\d+\]", plan)
    got = {r.eia_utility_id: (r.utility_name, r.state, r.total_customers) for r in rows.collect()}
    assert len(got) == 200 and got[7] == ("U7", "OR", 70) and got[200][0] == "U200" and got[200][2] is None
    assert others.count() == 0
