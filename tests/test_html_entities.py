"""Character references against the standard library."""

import html
import random

from tariffworks.functions.html import unescape

GOLDEN = [
    "&eacute;&Eacute; &euro;5 &mdash; &hellip;", "&#8217;&#x2019;&#X2019 &#8364", "&amp;lt; &amp;#39; &amp;amp;", "&copyright &notit; &not",
    "&unknown; &; & &#; &#x; &#xZZ;", "&#0; &#128; &#150; &#x9F; &#xD800; &#x110000; &#1114112; &#99999999999;", "&#xFDD0;x&#65534;y&#11;",
    "&#128512; \U0001f600 &#x1F600;", "&NotEqualTilde; &nvlt; &fjlig;", "&nbsp;&lt;&gt;&quot;&#39;&middot;&copy;&amp;", "plain", "",
    "a &lt b &amp c", "&AMP &LT; &ampamp;",
]


def test_references_are_decoded_as_by_the_standard_library(spark):
    rng = random.Random(3)
    parts = ["&", "#", "x", ";", "amp", "lt", "eacute", "copy", "39", "8217", "1F600", " ", "not", "in", "a", "\u00e9", "<"]
    texts = GOLDEN + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(600)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "id int, text string")
    got = {r.id: r.out for r in df.select("id", unescape(df.text).alias("out")).collect()}
    assert got.pop(-1) is None
    wrong = [(texts[i], html.unescape(texts[i]), x) for i, x in got.items() if html.unescape(texts[i]) != x]
    assert wrong == []


def test_no_python_in_the_plan(spark):
    df = spark.range(3).selectExpr("cast(id as string) AS text")
    assert "Python" not in df.select(unescape(df.text))._jdf.queryExecution().toString()
