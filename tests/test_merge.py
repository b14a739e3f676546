"""Keyed merges: policies, order inside a batch, repetition, the stream."""

import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tariffworks.operators import firstwins, merge

CASE = "docket_number string, source string, utility_name string, state string, status string, approved_revenue_change double, seq int"


def cases(spark, *rows):
    return spark.createDataFrame(list(rows), CASE)


def as_dict(df):
    return {(r.docket_number, r.source): (r.status, r.approved_revenue_change) for r in df.collect()}


def test_nulls_keep_stored_values_and_keys_include_the_source(spark):
    old = cases(spark, ("1", "or", "A", "OR", "active", 5.0, 0)).drop("seq")
    batch = cases(spark, ("1", "or", "A", "OR", "decided", None, 1), ("1", "wa", "A", "WA", None, 2.0, 2))
    got = as_dict(merge.merge_cases(old, batch))
    assert got == {("1", "or"): ("decided", 5.0), ("1", "wa"): ("unknown", 2.0)}


def test_a_batch_is_applied_in_order(spark):
    old = cases(spark).drop("seq")
    batch = cases(spark, ("1", "or", "A", "OR", "filed", 1.0, 1), ("1", "or", "A", "OR", None, 3.0, 3), ("1", "or", "A", "OR", "decided", None, 2))
    assert as_dict(merge.merge_cases(old, batch)) == {("1", "or"): ("decided", 3.0)}


def test_counts_and_repetition(spark):
    rows = [(str(i), "or", "A", "OR", None, None, i) for i in range(5)]
    old = cases(spark).drop("seq")
    count = lambda o, b: tuple(merge.merge_counts(o, b, merge.CASE_KEYS).first())
    assert count(old, cases(spark, *rows)) == (5, 5, 0)
    stored = merge.merge_cases(old, cases(spark, *rows))
    assert count(stored, cases(spark, rows[0], ("9", "or", "A", "OR", None, None, 9))) == (2, 1, 1)
    assert count(old, cases(spark, rows[0], rows[0])) == (2, 1, 1)
    again = merge.merge_cases(stored, cases(spark, *rows))
    assert as_dict(again) == as_dict(stored)


def test_unknown_and_overwrite_policies(spark):
    schema = ("name string, canonical_name string, state string, utility_type string, ownership_type string, parent_company string, "
              "customer_count long, eia_utility_id long, ferc_respondent_id long")
    old = spark.createDataFrame([("A", None, None, "gas", "municipal", "P", 1, 2, None)], schema)
    batch = spark.createDataFrame([("A", "AA", None, "unknown", "cooperative", None, None, None, 7)], schema).withColumn("seq", F.lit(1))
    got = merge.merge_utilities(old, batch).collect()
    assert [tuple(r) for r in got] == [("A", "AA", None, "gas", "cooperative", "P", 1, 2, 7)]
    links = "utility_name string, state string, eia_utility_id long, match_confidence double, match_method string"
    old = spark.createDataFrame([("A", "OR", 1, 0.9, "fuzzy_90")], links)
    new = spark.createDataFrame([("A", "OR", 1, None, "exact")], links).withColumn("seq", F.lit(1))
    assert [tuple(r) for r in merge.merge_links(old, new).collect()] == [("A", "OR", 1, None, "exact")]


def test_store_counts_incomplete_rows_as_errors(spark):
    batch = cases(spark, ("1", None, "A", "OR", None, None, 1), (None, None, "A", "OR", None, None, 2))
    merged, counts = merge.merge_store(cases(spark).drop("seq"), batch, "oregon_puc")
    assert tuple(counts.first()) == ("oregon_puc", 2, 1, 0, 1)
    assert as_dict(merged) == {("1", "oregon_puc"): ("unknown", None)}


def test_first_wins_whatever_the_partitioning(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"), (F.col("id") * 3).alias("v"))
    for n in (1, 3, 16):
        got = {r.k: r.v for r in firstwins.first_per_key(rows.repartition(n), ["k"], "seq").collect()}
        assert got == {k: 3 * k for k in range(7)}


def test_stream_gives_the_result_of_one_batch(spark, tmp_path):
    from tariffworks.operators.extract import parse_record
    from tariffworks.schemas import RAW_RECORD
    from tariffworks.streaming import ingest

    def record(docket, **values):
        return {**{f.name: None for f in RAW_RECORD.fields}, "docket_number": docket, "utility_name": "A", "state": "or",
                "source": "oregon_puc", **values}

    batches = [
        [record("1", status="open"), record("2", requested_revenue_change="5"), record(" ")],
        [record("1", decision_date="2024-01-02"), record("2", status="closed")],
    ]
    raw, table = str(tmp_path / "raw"), str(tmp_path / "table")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, RAW_RECORD).coalesce(1).write.mode("append").json(raw)
        ingest.stream_ingest(spark, raw, table, str(tmp_path / "checkpoint")).awaitTermination()
    show = lambda df: sorted(
        (r.docket_number, r.status, r.decision_date, r.requested_revenue_change) for r in df.collect())
    streamed = show(ingest.read_current(spark, table))
    everything = spark.createDataFrame([{**r, "seq": i} for i, r in enumerate(batches[0] + batches[1])],
                                       StructType([*RAW_RECORD.fields, StructField("seq", LongType())]))
    once = merge.fold_batch(parse_record(everything)[0], merge.CASE_KEYS, "seq")
    assert streamed == show(once)
    # a status the later batch leaves out is 'unknown' there, and overwrites
    assert streamed == [("1", "unknown", datetime.date(2024, 1, 2), None), ("2", "decided", None, 5.0)]
    ingest.compact(spark, table, str(tmp_path / "compacted"), 1)
    assert show(ingest.read_current(spark, str(tmp_path / "compacted"))) == streamed


def test_scores_multiply_no_case_and_the_last_one_counts(spark):
    stored = spark.createDataFrame(
        [("1", "or", 0.1, None), ("1", "wa", 0.2, None), (None, "or", 0.3, None), ("2", "or", 0.4, None)],
        "docket_number string, source string, quality_score double, updated_at timestamp")
    scores = spark.createDataFrame(
        [("1", 0.5, 2), ("1", 0.9, 1), (None, 0.7, 3), ("1", None, 4), ("9", 1.0, 5)], "docket_number string, quality_score double, seq int")
    now = F.lit(datetime.datetime(2024, 1, 2)).cast("timestamp")
    got = sorted(map(tuple, merge.update_scores(stored, scores, "seq", now).collect()), key=str)
    day = datetime.datetime(2024, 1, 2)
    assert got == sorted([("1", "or", 0.5, day), ("1", "wa", 0.5, day), (None, "or", 0.7, day), ("2", "or", 0.4, None)], key=str)
    assert tuple(merge.update_counts(stored, scores).first()) == (4, 3)
    exact = spark.createDataFrame([("1", "wa", 0.6), ("1", "wa", 0.5)], "docket_number string, source string, quality_score double")
    assert sorted(r.quality_score for r in merge.update_scores(stored, exact).collect()) == [0.1, 0.3, 0.4, 0.6]


def test_names_multiply_no_case(spark):
    stored = spark.createDataFrame([("A", None), ("B", "b")], "utility_name string, canonical_utility_name string")
    mapping = spark.createDataFrame([("A", "a1", 1), ("A", "a2", 2), ("B", None, 3)], "utility_name string, canonical_name string, seq int")
    got = sorted(map(tuple, merge.update_names(stored, mapping, "seq").collect()))
    assert got == [("A", "a2"), ("B", "b")]


def test_null_keys_are_stored_keys(spark):
    old = cases(spark, (None, "or", "A", "OR", None, None, 0)).drop("seq")
    batch = cases(spark, (None, "or", "A", "OR", None, None, 1), ("3", "or", "A", "OR", None, None, 2))
    got = {r.docket_number: r.is_stored for r in merge.merge_existence(old, batch, merge.CASE_KEYS).collect()}
    assert got == {None: True, "3": False}


def test_effects_come_with_what_happened(spark):
    old = cases(spark, ("1", "or", "A", "OR", "active", 5.0, 0), ("2", "or", "B", "OR", "active", None, 0)).drop("seq")
    batch = cases(spark, ("1", "or", "A", "OR", "decided", None, 1), ("1", "or", "A", "OR", None, 6.0, 2), ("3", "or", "C", "OR", None, None, 3))
    got = {r.docket_number: (r.is_new, r.n_rows, r.status) for r in merge.case_effects(old, batch).collect()}
    assert got == {"1": (False, 2, "decided"), "2": (False, 0, "active"), "3": (True, 1, "unknown")}


def test_the_stored_side_is_shuffled_once(spark):
    old, batch = (cases(spark).repartition(3) for _ in range(2))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = merge.merge_cases(old.drop("seq"), batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the stored rows, one for the folded batch, and the repartitions of the test's own inputs.
    assert plan.count("Exchange hashpartitioning") <= 3 and plan.count("SortMergeJoin") == 1


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "cases")
    old = cases(spark, ("1", "or", "A", "OR", "active", 5.0, 0), ("1", "wa", "A", "WA", "active", 5.0, 0)).drop("seq")
    old.write.partitionBy("source").parquet(path)
    files = lambda: {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "cases").glob("source=*")}
    before = files()
    batch = cases(spark, ("1", "or", "A", "OR", "decided", None, 1), ("2", "ct", "A", "CT", "filed", None, 2))
    result = merge.merge_partitions(spark, path, old.schema, batch, "source", merge.case_effects)
    after = files()
    assert after["source=wa"] == before["source=wa"] and after["source=or"] != before["source=or"]
    assert as_dict(spark.read.schema(old.schema).parquet(path)) == {
        ("1", "or"): ("decided", 5.0), ("1", "wa"): ("active", 5.0), ("2", "ct"): ("filed", None)}
    assert result.filter("is_new").count() == 1
    # applied again, as after a failure
    merge.merge_partitions(spark, path, old.schema, batch, "source", merge.case_effects)
    assert as_dict(spark.read.schema(old.schema).parquet(path))[("1", "or")] == ("decided", 5.0)


def test_repeated_keys_multiply_no_rows(spark):
    from tariffworks.operators import pages, resolve

    named = spark.createDataFrame([("A",), ("B",)], "utility_name string")
    mapping = spark.createDataFrame([("A", "a1"), ("A", "a2"), ("C", "c")], "utility_name string, canonical_name string")
    got = sorted(map(tuple, resolve.apply_name_mapping(named, mapping).collect()))
    assert got == [("A", "a2"), ("B", None)]
    fields = "page_id int, utility_name string, utility_type string, filing_date string, status string, description string"
    known = spark.createDataFrame([(1, None, "gas", None, "open", "short"), (2, "N", None, None, None, None)], fields)
    scraped = spark.createDataFrame([(1, "X", "", "2020", None, "longer text"), (1, "W", None, "2021", "closed", "long text")], fields)
    got = sorted(map(tuple, pages.merge_scraped_fields(known, scraped, "page_id").collect()))
    assert got == [(1, "X", "gas", "2021", "closed", "longer text"), (2, "N", None, None, None, None)]
