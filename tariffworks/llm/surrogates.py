"""Personal data replaced by keyed surrogates, with DataFrame functions alone.

Entities are found by pattern.  Every distinct value of the corpus gets one surrogate, made from a
keyed hash: letters become letters of the same case and script, digits digits, punctuation stays,
address numbers stay in range, and a name after a title gets a name of that title's gender.  The
same value has the same surrogate wherever it stands, also in another notation (case of an e-mail
address, punctuation of a number), and different values have different ones: values whose
candidate another value holds, or that occurs in the corpus itself, try again with the next hash.
After a few tries surrogates get longer than their values, so that no shape runs out of candidates.

Only rows that hold an entity are joined with the surrogates; all other texts pass through.  A
value that very many rows hold is an ordinary skewed join side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffworks.llm.common import let, stored

KEY = "surrogates"
KINDS = ("email", "ip", "iban", "card", "ssn", "phone", "name")

# Patterns.  None starts inside a longer run of its own characters, so that long runs are read once.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_SEVEN = "[0-9][ .()-]{0,3}" * 7
MALE = ("Mr", "Herr", "Señor", "Monsieur")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame")
NEUTRAL = ("Dr", "Prof")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,6}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z.])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": (rf"(?<![0-9A-Za-z.+])(?:\+[0-9]{{1,3}}(?:[ .-]?\(?[0-9]{{1,4}}\)?){{2,5}}(?<={_SEVEN})"
              r"|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
              r"|[0-9]{10,12})(?![0-9A-Za-z]|\.[0-9])"),
    "name": rf"(?<!\p{{L}})(?:{'|'.join((*MALE, *FEMALE, *NEUTRAL))})\.? \p{{Lu}}[\p{{L}}'-]++(?: \p{{Lu}}[\p{{L}}'-]++)?",
}
# The group of a pattern is numbered from the start of the whole.
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)

# Names by gender: fixed values.
MALE_NAMES = ("Adam", "Brian", "Carl", "David", "Eric", "Frank", "George", "Henry", "Ivan", "James", "Kevin", "Louis",
              "Martin", "Neil", "Oscar", "Peter", "Quentin", "Robert", "Simon", "Thomas", "Ulrich", "Victor", "Walter")
FEMALE_NAMES = ("Alice", "Bertha", "Clara", "Diana", "Emma", "Fiona", "Greta", "Helen", "Irene", "Julia", "Karen",
                "Laura", "Maria", "Nora", "Olivia", "Paula", "Rachel", "Sarah", "Teresa", "Ursula", "Vera", "Wanda")
FAMILY_NAMES = ("Archer", "Baker", "Carter", "Dyer", "Ellis", "Fisher", "Gardner", "Harper", "Ingram", "Jordan",
                "Keller", "Lambert", "Mason", "Norris", "Osborn", "Parker", "Quinn", "Ramsey", "Sawyer", "Tanner",
                "Unger", "Vaughn", "Weaver", "Young")
#: Alphabets letters are drawn from: each letter stays within its own.
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
             "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
             "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
#: Other letters, by script: upper case, lower case and letters without case.
SCRIPTS = (
    ("Armenian", "ԱԲԳԴԵԶԷԸԹԺԻԼԽԾԿՀՁՂՃՄՅՆՇՈՉՊՋՌՍՎՏՐՑՓՔ", "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփք", ""),
    ("Georgian", "ᲐᲑᲒᲓᲔᲕᲖᲗᲘᲙᲚᲛᲜᲝᲞᲟᲠᲡᲢᲣᲤᲥᲦᲧᲨᲩᲪᲫᲬᲭᲮᲯᲰ", "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", ""),
    ("Cyrillic", ALPHABETS[4], ALPHABETS[3], ""),
    ("Greek", ALPHABETS[6], ALPHABETS[5], ""),
    ("Hebrew", "", "", "אבגדהוזחטיכלמנסעפצקרשת"),
    ("Arabic", "", "", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    ("Devanagari", "", "", "कखगघचछजझटठडढतथदधनपफबभमयरलवशसह"),
    ("Thai", "", "", "กขคงจฉชซญดตถทธนบปผฝพฟภมยรลวสหอ"),
    ("Hiragana", "", "", "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめも"),
    ("Katakana", "", "", "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモ"),
    ("Hangul", "", "", "가나다라마바사아자차카타파하고노도로모보소오조초코토포호"),
    ("Han", "", "", "一丁七三上下中主久之九也于五井京人仁今介代令以任伊休伯何余作"),
)
#: Tries after which a surrogate gets longer than its value, and what it grows by.
PLAIN_TRIES, GROWTH = 4, 8


def kind_of(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for k in reversed(KINDS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[k]})$"), F.lit(k)).otherwise(out)
    return out


def canonical(kind: Column, value: Column) -> Column:
    """One form for all notations of a value."""
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("iban"), F.replace(value, F.lit(" "), F.lit("")))
        .when(kind.isin("card", "ssn", "phone"), F.regexp_replace(value, "[^0-9]", ""))
        .otherwise(value)
    )


def _number(digest: Column, at: Column | int, below: int) -> Column:
    """A number below `below` from eight hexadecimal digits of a digest, chosen by place."""
    place = (F.lit(at) if isinstance(at, int) else at) % 57 + 1
    return (F.conv(F.substr(digest, place, F.lit(8)), 16, 10).cast("long") % below).cast("int")


def _shaped(value: Column, digest: Column) -> Column:
    """Each letter and digit replaced by one of its alphabet, all else kept."""
    def one(c: Column, i: Column) -> Column:
        out = unlisted(c, i)
        for letters in ALPHABETS:
            out = F.when(F.lit(letters).contains(c), drawn(letters, i)).otherwise(out)
        return F.when(c == "", c).otherwise(out)

    def drawn(letters: str, i: Column) -> Column:
        return F.substr(F.lit(letters), _number(digest, i * 3, len(letters)) + 1, F.lit(1))

    def unlisted(c: Column, i: Column) -> Column:
        """A letter of the script and case of one that no alphabet holds; of the Latin ones for scripts not listed."""
        upper, out = c.rlike(r"\p{Lu}"), c
        for script, large, small, plain in (("L", ALPHABETS[1], ALPHABETS[0], ""), *reversed(SCRIPTS)):
            of = c.rlike(rf"\p{{{script if script == 'L' else 'Is' + script}}}")
            out = F.when(of, F.when(upper, drawn(large or plain, i)).otherwise(drawn(small or plain, i))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _chosen(names: tuple[str, ...], digest: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), _number(digest, at, len(names)) + 1)


def surrogate(kind: Column, value: Column, attempt: int, key: str = KEY) -> Column:
    """A candidate for a canonical value."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, value, F.lit(str(attempt))), 256)
    longer = attempt >= PLAIN_TRIES

    def made(d: Column) -> Column:
        more = F.substr(d, F.lit(50), F.lit(GROWTH)) if longer else F.lit("")
        # Digits beyond those of the value.
        grown = F.concat(value, F.repeat(F.lit("0"), F.lit(GROWTH))) if longer else value
        local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        labels = F.split(domain, r"\.")
        above = F.regexp_replace(domain, r"(?:^|\.)[^.]*\.[^.]*$", "")
        last = F.element_at(labels, -1)
        email = F.concat(_shaped(local, d), more, F.lit("@"),
                         F.when(above != "", F.concat(_shaped(above, F.reverse(d)), F.lit("."))).otherwise(F.lit("")),
                         F.lit("example."), F.when(last.isin("com", "org", "net"), last).otherwise(F.lit("com")))
        ip = F.concat_ws(".", *[(_number(d, i * 9, 254) + 1).cast("string") for i in range(4)])
        iban = F.concat(F.substr(value, F.lit(1), F.lit(2)), _shaped(F.substr(grown, F.lit(3)), d))
        title = F.regexp_extract(value, r"^(\p{L}+\.? )", 1)
        bare = F.regexp_replace(title, r"\.? $", "")
        male, female = _chosen(MALE_NAMES, d, 0), _chosen(FEMALE_NAMES, d, 0)
        first = F.when(bare.isin(*MALE), male).when(bare.isin(*FEMALE), female).otherwise(
            F.when(_number(d, 30, 2) == 0, male).otherwise(female))
        last_name = F.concat(_chosen(FAMILY_NAMES, d, 9), F.translate(more, "0123456789", "ghijklmnop"))
        own = F.substr(value, F.length(title) + 1)
        latin = own.rlike(r"^[\p{IsLatin}' -]+$")
        last_letter = F.substr(F.regexp_replace(own, r"[^\p{L}]", ""), F.lit(-1), F.lit(1))
        spelt = F.concat(own, F.repeat(last_letter, F.lit(GROWTH))) if longer else own
        name = F.concat(title, F.when(~latin, _shaped(spelt, d)).when(own.contains(" "), F.concat(first, F.lit(" "), last_name))
                        .otherwise(last_name))
        return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "iban", iban)
                .when(kind == "name", name).otherwise(_shaped(grown, d)))

    return let(digest, made)


def _written(kind: Column, value: Column, chosen: Column) -> Column:
    """The surrogate in the notation of the value it replaces."""
    letters = F.when(kind == "iban", F.lit("[^0-9A-Z]")).otherwise(F.lit("[^0-9]"))

    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(value, F.lit(1), i + 1), letters, F.lit("")))
        return F.when(F.regexp_replace(c, letters, F.lit("")) == "", c).otherwise(F.substr(chosen, before, F.lit(1)))

    # What a surrogate has grown by stands at the end.
    places = F.length(F.regexp_replace(value, letters, F.lit("")))
    numbers = F.concat(F.array_join(F.transform(F.split(value, ""), one), ""), F.substr(chosen, places + 1))
    upper = (value == F.upper(value)) & (value != F.lower(value))
    return (F.when(kind.isin("card", "ssn", "phone", "iban"), numbers)
            .when((kind == "email") & upper, F.upper(chosen)).otherwise(chosen))


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """kind, value, chosen for the distinct (kind, value); no chosen is another's, or a value itself."""
    left = stored(entities.select("kind", "value").distinct(), "entities")
    values = left.select("kind", F.col("value").alias("chosen"))
    done, attempt = None, 0
    while not left.isEmpty():
        tried = left.withColumn("chosen", surrogate(F.col("kind"), F.col("value"), attempt, key))
        tried = tried.join(values, ["kind", "chosen"], "left_anti")
        if done is not None:
            tried = tried.join(done.select("kind", "chosen"), ["kind", "chosen"], "left_anti")
        won = stored(tried.groupBy("kind", "chosen").agg(F.min("value").alias("value")).select("kind", "value", "chosen"), "chosen")
        done = won if done is None else done.unionByName(won)
        left = stored(left.join(won, ["kind", "value"], "left_anti"), "left")
        attempt += 1
    return done if done is not None else left.withColumn("chosen", F.lit(None).cast("string"))


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Rows and columns of docs with the entities of `text` replaced, and pii_entities, how many there were.

    Null and empty texts stay as they are with 0.  Repeated rows are treated alike.  No column but
    text is read; a column of docs named pii_entities is replaced.
    """
    names = [c for c in docs.columns if c != "pii_entities"]
    docs = docs.select(names)
    has = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    hits = stored(docs.where(has).select(F.struct(*names).alias("doc"), F.monotonically_increasing_id().alias("row"))
                  .withColumn("found", F.regexp_extract_all("doc.text", F.lit(ANY), 0)), "hits")
    spots = (
        hits.select("row", F.posexplode("found").alias("at", "written"))
        .withColumn("kind", kind_of(F.col("written")))
        .withColumn("value", canonical(F.col("kind"), F.col("written")))
    )
    spots = stored(spots, "spots")
    known = surrogates(spots, key)
    replaced = (
        spots.join(known, ["kind", "value"], "left")
        .select("row", "at", F.coalesce(_written(F.col("kind"), F.col("written"), F.col("chosen")), "written").alias("new"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("new"))
    )
    rest = F.split("doc.text", ANY, -1)
    joined = F.array_join(F.flatten(F.zip_with(
        rest, F.col("new.new"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    changed = hits.join(replaced, "row").withColumn("changed", joined).select(
        *[F.col("changed").alias("text") if c == "text" else F.col("doc")[c].alias(c) for c in names],
        F.size("found").alias("pii_entities"))
    return docs.where(~has).withColumn("pii_entities", F.lit(0)).unionByName(changed)
