"""Document fingerprints by winnowing, with DataFrame functions alone.

The grams are runs of k words; characters of scripts without spaces, and those of words beyond a
length, are words of their own.  Of every w consecutive gram hashes the smallest is selected, the
rightmost of equal ones, together with its place.  Any run of w + k - 1 words that two texts share
gives them a selected hash in common.  Hash and place travel as one number whose order is the
order of selection, so that the minimum of a window is a minimum of numbers; windows of w = 2**p
are p rounds of pairwise minima.

Texts are compared with the next one by doc_id.  Bounds drawn from the ids deal the texts to
ranges; a text on a bound stands in both ranges, so that each range knows the text after its last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffworks.llm.common import let

#: Words of a gram, and the power of two that a window has.
GRAM, WINDOW_POWER = 5, 2
#: Letters of a word at most; of longer ones, and in these scripts, each character is a word.
LONG_WORD = 320
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
#: Bits of a place: texts up to 67 million words.
PLACE_BITS = 26
_HASH_BITS = 63 - PLACE_BITS
#: Documents of a range, and ranges at most.
RANGE, RANGES = 1000, 5000


def _grams(words: Column, k: int) -> Column:
    """Selection numbers of the grams: hash above, place below so that a later one is smaller."""
    last = (1 << PLACE_BITS) - 1
    mask = (1 << _HASH_BITS) - 1

    def one(i: Column) -> Column:
        h = F.xxhash64(*[F.get(words, i + j) for j in range(k)])
        return F.shiftleft(h.bitwiseAND(F.lit(mask)), PLACE_BITS) + (F.lit(last) - i)

    # A text of fewer words is one gram; words beyond its end are nulls, which the hash skips.
    n = F.greatest(F.size(words) - k, F.lit(0))
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), n), one)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _windows(numbers: Column, power: int) -> Column:
    """The smallest number of each window, once each, in the order of the text."""
    w = 1 << power

    def halved(a: Column, p: int) -> Column:
        if p == power:
            return a
        shift = 1 << p
        pairs = F.transform(F.sequence(F.lit(0), F.size(a) - 1 - shift),
                            lambda i: F.least(F.get(a, i), F.get(a, i + shift)))
        return let(pairs, lambda b: halved(b, p + 1))

    return F.when(F.size(numbers) < 1, numbers).when(F.size(numbers) <= w, F.array(F.array_min(numbers))).otherwise(
        F.array_distinct(halved(numbers, 0)))


def _words(text: Column) -> Column:
    spaced = F.split(text, r"[\x20\x09-\x0D]+")
    apart = F.split(F.regexp_replace(text, f"({UNSPACED})", " $1 "), r"[\x20\x09-\x0D]+")
    pieces = F.flatten(F.transform(apart, lambda x: F.when(F.length(x) > LONG_WORD, F.split(x, "")).otherwise(F.array(x))))
    odd = text.rlike(rf"{UNSPACED}|(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{{{LONG_WORD + 1}}}")
    return F.filter(F.when(odd, pieces).otherwise(spaced), lambda x: x != "")


def selected(text: Column, k: int = GRAM, power: int = WINDOW_POWER) -> Column:
    """The selected grams of a text, as numbers; null or empty: none."""
    return let(_words(F.coalesce(text, F.lit(""))), lambda x: let(_grams(x, k), lambda g: _windows(g, power)))


def hashes(numbers: Column) -> Column:
    return F.array_distinct(F.transform(numbers, lambda x: F.shiftright(x, PLACE_BITS)))


def fingerprint(numbers: Column) -> Column:
    """hash:place of the selected grams, comma-joined; hash in hexadecimal, place in words."""
    last = (1 << PLACE_BITS) - 1
    return F.array_join(F.transform(numbers, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, PLACE_BITS))), F.lit(":"),
        (F.lit(last) - x.bitwiseAND(F.lit(last))).cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all hashes of two fingerprints; 1 if both have none."""
    def shared(x: Column, y: Column) -> Column:
        common = F.size(F.array_intersect(x, y))
        every = F.size(x) + F.size(y) - common
        return F.when(every == 0, F.lit(1.0)).otherwise(common / every)

    return shared(a, b).cast("double")


def with_next(docs: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """docs with next_<column> of the row after, in the order of columns that starts with doc_id.

    The row after the last is the first.  Rows are dealt to ranges of the ids between bounds that
    the ids give; no range is a share of all rows unless one id is.
    """
    spark = docs.sparkSession
    n, first = docs.agg(F.count("*"), F.min("doc_id")).first()
    if not n:
        return docs.select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in columns])
    ranges = max(1, min(RANGES, n // RANGE))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 10 * ranges)).first()[0] or []
    bounds = sorted({b for b in bounds if b != first}) if shares else []
    edges = F.array(*map(F.lit, bounds)) if bounds else F.expr("cast(array() as array<bigint>)")
    edges = spark.range(1).select(edges.alias("bounds"))

    # Rows of a bound's own id also end the range before it; those of the first id end the last range.
    place = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("bounds", lambda b: b <= F.col("doc_id"))))
    dealt = docs.join(F.broadcast(edges)).withColumn("range", place)
    starts = F.array_contains("bounds", F.col("doc_id"))
    lead = first is None
    tail = F.when(F.col("range") > 0, F.when(starts, F.col("range") - 1)).otherwise(
        F.when(F.col("doc_id").eqNullSafe(F.lit(first).cast("long")) if not lead else F.lit(True), F.size("bounds")))
    has_null = docs.where("doc_id is null").limit(1).count() > 0
    if has_null and not lead:
        tail = F.when(F.col("range") > 0, F.when(starts, F.col("range") - 1)).otherwise(
            F.when(F.col("doc_id").isNull(), F.size("bounds")))
    copies = F.array_compact(F.array(F.struct(F.col("range").alias("at"), F.lit(False).alias("guest")),
                                     F.when(tail.isNotNull(), F.struct(tail.alias("at"), F.lit(True).alias("guest")))))
    spread = dealt.withColumn("copy", F.explode(copies)).select(*docs.columns, F.col("copy.at").alias("at"), F.col("copy.guest").alias("guest"))
    following = Window.partitionBy("at").orderBy("guest", *[F.asc_nulls_first(c) for c in order])
    led = spread.select("*", F.lead(F.struct(*columns)).over(following).alias("after"))
    return led.where("not guest").select(*docs.columns, *[F.col("after")[c].alias(f"next_{c}") for c in columns])


def fingerprints(docs: DataFrame, k: int = GRAM, power: int = WINDOW_POWER) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of docs (doc_id, text).

    The edited text has its last floor(n_chars / 2) code points replaced by as many from the start
    of the next text.  Null and empty texts have no code points, an empty fingerprint and a
    likeness of 1 to one another.  Rows equal in doc_id follow each other by text; null ids come
    first.  A single row is its own next.  Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # Selected again for the next text: sending them beside the texts would take more disk.
    rows = with_next(rows, ["text"], ["doc_id", "text"]).withColumn("numbers", selected(F.col("text"), k, power))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)))
    own = hashes(F.col("numbers"))
    edited = let(selected(F.col("edited"), k, power), lambda e: F.struct(
        fingerprint(e).alias("fingerprint"), likeness(own, hashes(e)).alias("near")))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "numbers", hashes(selected(F.col("next_text"), k, power)).alias("next_hashes"), edited.alias("edited"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("numbers")).alias("fingerprint"),
        F.col("edited.fingerprint").alias("edited_fingerprint"), F.col("edited.near").alias("near_edited"),
        likeness(own, F.col("next_hashes")).alias("near_next"))
