"""Pages searched once, and the patterns that were made cheaper against the plain ones."""

import random

from pyspark.sql import functions as F

from tariffworks.functions import html
from tariffworks.functions.columns import WHITE_SPACE, squeeze
from tariffworks.operators import pages as P

LABELS = [r"Filed\s*By|Filer", "Industry", r"Filing\s*Date", "Status", "Category", "Description"]
ATOMS = ["Filed By", "filed\n by", "FILER", "Industry", "inDustry", "Status", "Filing  Date", "Category", "description", "Fi", "xIn",
         ":", "=", " ", "\n", "</", "</b>", "</b", ">", "<", "<i>", "/", "1/2/2020", "12/31/99", "open", "Gas", "é", "ſtatus", "\U0001f600"]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pieces_hold_what_the_page_holds(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 40))),) for _ in range(4000)]
    rows += [(f"{a}{b} {c}</{d}> {e}<",) for a in ATOMS[:9] for b in ":=x" for c in ("", "\n", "Status: ") for d in ("b", "b Industry: </i", "")
             for e in ("7/8/2001", " ", "Filing Date: </b> 1/2/2003")] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "html string").withColumn("pieces", html.labelled_pieces(F.col("html")))
    value = {label: r"(\d{1,2}/\d{1,2}/\d{4})" if "Date" in label else r"([^<]+)" for label in LABELS}
    fields = [F.struct(*[html.labelled_field(F.col(x), label, v).alias(f"f{i}") for i, (label, v) in enumerate(value.items())])
              for x in ("html", "pieces")]
    found = df.select("html", fields[0].alias("plain"), fields[1].alias("cut")).collect()
    assert [r for r in found if r.plain != r.cut] == []
    assert sum(any(x is not None for x in r.plain) for r in found) > 500


def test_labelled_fields_search_the_page_once(spark):
    df = P.labelled_fields(spark.createDataFrame([(1, "<p>Status:</b> Closed</p>")], "page_id long, html string"))
    assert plan(df).count("regexp_extract_all(html") == 1 and "regexp_extract(html" not in plan(df)
    assert df.first().status == "decided"


def test_listing_titles_search_the_page_once(spark):
    def listed(docket, title):
        return f'<font color="#008000">{docket}</font><a href="x?OpenDocument">{title}</a>'

    rows = [(1, listed("01-02-03", "Application &amp; more")), (2, listed("01-02-03", "short")), (3, listed("01-02-04", "tiny"))]
    df = P.listing_titles(spark.createDataFrame(rows, "page_id long, html string"))
    assert plan(df).count("OpenDocument") == 1
    assert [tuple(r) for r in df.collect()] == [("01-02-03", "Application & more")]


def test_white_space(spark):
    every = [chr(n) for n in range(1, 0x10000) if not 0xD800 <= n < 0xE000]
    got = spark.createDataFrame([(x,) for x in every], "x string").select(
        "x", squeeze(F.concat(F.lit("a"), "x", F.lit("b"))).alias("y")).where("y = 'a b'")
    assert sorted(r.x for r in got.collect()) == sorted(WHITE_SPACE)
