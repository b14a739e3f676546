"""Secrets in texts, with multipart credentials linked, by DataFrame functions alone.

Three kinds are secrets by themselves: assignments to telling names, access identifiers, and long
hexadecimal runs.  Weaker parts (names of accounts, values that look random or are assigned to
vague names, endpoints) are so common that they are reported only as parts of one credential: an
interval join within the scope of a text looks for the parts that complement each other.

* an identifier is reported with a secret in its scope,
* a weak secret with an identifier and an endpoint in its scope,
* an endpoint with a secret in its scope that has an identifier in its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffworks.llm.common import let, stored

#: Code points between two parts of one credential at most.
SCOPE = 200
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
_QUOTE = "[\"']?"
_IS = rf"{_QUOTE}\x20*[:=]\x20*{_QUOTE}"
ASSIGN = rf"(?i:password|passwd|secret|token|api_?key){_IS}([A-Za-z0-9+/_.=-]+)"
#: A run of these that is too short holds no long enough one, so the length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
IDENTIFIER = (r"(?<![A-Za-z0-9])(?i:(?:client|access|account|app|tenant|project|user)[_-]?(?:key[_-]?)?id|user[_-]?name|user"
              rf"|login){_IS}[A-Za-z0-9@._-]{{3,}}+")
WEAK = (rf"(?<![A-Za-z0-9])(?i:pwd|pass|passphrase|auth|credential|private[_-]?key){_IS}[^\x20\x09-\x0D\"',;]{{4,}}+"
        r"|(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])"
        r"[A-Za-z0-9+/_-]{20,}+={0,2}")
ENDPOINT = (r"(?<![A-Za-z0-9])(?i:https?|ftp|sftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|mongodb|amqp|s3)://"
            r"[^\x20\x09-\x0D\"'<>]++"
            r"|(?<![A-Za-z0-9.@-])(?:[a-z0-9-]++\.)++(?:com|net|org|io|internal|local)(?![A-Za-z0-9-])(?::[0-9]{1,5})?"
            r"|(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z.])(?::[0-9]{1,5})?")
#: Matches whose places are summed up at once.
_BLOCK = 512


def _sum(steps: Column) -> Column:
    return F.aggregate(steps, F.lit(0), lambda a, s: a + s["gap"] + s["len"])


def _running(steps: Column, base: Column) -> Column:
    """Start and end of each step (gap, len) from a base on."""
    zero = F.struct(base.alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        return F.struct((start + s["len"]).alias("at"),
                        F.array_append(acc["out"], F.struct(start.alias("start"), (start + s["len"]).alias("end"))).alias("out"))

    return F.aggregate(steps, zero, step, lambda acc: acc["out"])


def places(text: Column, pattern: str, passes=None) -> Column:
    """start, end (code points) of the matches of a pattern that pass, as an array.

    What lies between the matches gives the starts.  Long lists are summed up in blocks.
    """
    def located(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.length)
        steps = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), F.length(m).alias("len")))

        def blocked(steps: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
                                 lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)))

            def in_blocks(blocks: Column) -> Column:
                sums = F.transform(blocks, lambda b: F.struct(F.lit(0).alias("gap"), _sum(b).alias("len")))
                return F.flatten(F.zip_with(blocks, _running(sums, F.lit(0)), lambda b, s: _running(b, s["start"])))

            return let(blocks, in_blocks)

        all_of = let(steps, blocked)
        if passes is not None:
            all_of = F.transform(
                F.filter(F.zip_with(all_of, found, lambda p, m: F.struct(p.alias("p"), m.alias("m"))), lambda x: passes(x["m"])),
                lambda x: x["p"])
        return F.when(F.size(found) > 0, all_of).otherwise(F.expr("cast(array() as array<struct<start:int,end:int>>)"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def _of_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def _long_value(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 1)) >= 8


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_a, row_b (which stand for the row), base and weak spans (start, kind, end) of docs (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    base = [("assign", ASSIGN, _long_value), ("access", ACCESS, None), ("hex", HEX, None)]
    weak = [("identifier", IDENTIFIER, None), ("secret", WEAK, None), ("endpoint", ENDPOINT, None)]
    columns = {name: F.concat(*[_of_kind(places(text, p, passes), kind) for kind, p, passes in kinds])
               for name, kinds in (("base", base), ("weak", weak))}
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_a"), F.hash("doc_id", "text").alias("row_b"),
                       *[c.alias(n) for n, c in columns.items()])


def linked(rows: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row_a, row_b and the weak spans that parts in their scope complement."""
    row = ["row_a", "row_b"]
    parts = rows.where(F.size("weak") > 0).select(*row, F.explode(F.concat("base", "weak")).alias("s")).select(*row, "s.*").distinct()
    number = {k: i for i, k in enumerate(KINDS)}
    identifiers = parts.where(F.col("kind").isin(number["access"], number["identifier"]))
    secrets = parts.where(F.col("kind").isin(number["assign"], number["hex"], number["secret"]))
    endpoints = parts.where(F.col("kind") == number["endpoint"])

    def near(left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs of spans with at most `scope` between them: equal cells of the text, then the places."""
        cells = [F.explode(F.sequence(F.floor((F.col("start") - by) / scope), F.floor((F.col("end") + by) / scope))).alias("cell")
                 for by in (scope, 0)]
        a = left.select(*row, F.struct("start", "kind", "end").alias("a"), cells[0])
        b = right.select(*row, F.struct("start", "kind", "end").alias("b"), cells[1])
        close = (F.col("b.start") - F.col("a.end") <= scope) & (F.col("a.start") - F.col("b.end") <= scope)
        return a.join(b, [*row, "cell"]).where(close).select(*row, "a", "b").distinct()

    with_id = stored(near(secrets, identifiers), "credentials")
    whole = near(with_id.select(*row, "a.*").distinct(), endpoints)
    weak_id = with_id.select(*row, F.col("b").alias("s")).where(F.col("s.kind") == number["identifier"])
    weak_secret = whole.select(*row, F.col("a").alias("s")).where(F.col("s.kind") == number["secret"])
    endpoint = whole.select(*row, F.col("b").alias("s"))
    return reduce(DataFrame.unionByName, [weak_id, weak_secret, endpoint]).groupBy(*row).agg(F.collect_set("s").alias("extra"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked for each row of docs (doc_id, text).

    Null and empty texts have no spans (the hash of nothing, an empty string).  Repeated rows get
    equal results.  A null doc_id stays null.  Spans of several kinds may overlap.  Extra columns
    are ignored.
    """
    rows = stored(spans(docs), "spans")
    extra = linked(rows, scope)
    both = rows.join(extra, ["row_a", "row_b"], "left")
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")

    def count(k: int) -> Column:
        # A second parameter of the lambda, also one with a default, would be the place in the array.
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return both.select(
        "doc_id", *map(count, range(3)), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", F.coalesce("extra", none))).alias("spans"),
        F.size(F.coalesce("extra", none)).cast("long").alias("n_linked"))
