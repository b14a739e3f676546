"""Readers of raw record files and reference files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffworks import fixed_values as V
from tariffworks.functions.scores import revenue_per_customer, score_emissions, score_operations
from tariffworks.functions.text import safe_float, safe_int, safe_str
from tariffworks.schemas import RAW_RECORD

def read_raw_json(spark: SparkSession, path: str, source: str | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): files that hold an array of records or one record.

    Files become variants, so that arrays, single records and files that are no JSON need no schema of
    their own.  Rejects (file, place, reason, text) hold malformed files and entries that are no
    records, which do not stop the read.  ``seq`` orders the records: by file, then by place in the file.
    """
    files = (
        spark.read.option("wholetext", True).text(path)
        .select(F.col("_metadata.file_path").alias("file"), "value", F.try_parse_json("value").alias("parsed"))
    )
    # One pass: a malformed file stays as one entry without a value, its text beside it.
    entries = files.select(
        "file", F.when(F.col("parsed").isNull(), F.col("value")).alias("malformed"), F.posexplode(F.coalesce(
            F.try_variant_get("parsed", "$", "array<variant>"), F.array("parsed"))).alias("place", "entry"))
    is_record = F.coalesce(F.schema_of_variant("entry").startswith("OBJECT"), F.lit(False))
    fields = [F.try_variant_get("entry", f"$.{f.name}", "string").alias(f.name) for f in RAW_RECORD.fields]
    records = entries.filter(is_record).select(*fields, F.struct("file", "place").alias("seq"))
    whole = F.col("malformed").isNotNull()
    rejects = entries.filter(~is_record).select(
        "file", F.when(~whole, F.col("place")).alias("place"),
        F.when(whole, "malformed file").otherwise("not a record").alias("reason"),
        F.when(whole, F.col("malformed")).otherwise(F.to_json("entry")).alias("text"))
    if source:
        records = records.withColumn("source", F.lit(source))
    return records, rejects


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """All sources in one table, each tagged with its key."""
    tagged = [df.withColumn("source", F.lit(key)) for key, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


# --- header resolution: works on the list of column names only -----------------------

def find_column(headers: list[str], spellings: list[str]) -> str | None:
    """Header equal to a spelling without regard to case, else one that contains or is contained."""
    lowered = {h.strip().lower(): h for h in headers}
    wanted = [s.strip().lower() for s in spellings]
    exact = next((lowered[w] for w in wanted if w in lowered), None)
    if exact is not None:
        return exact
    return next((h for w in wanted for low, h in lowered.items() if w in low or low in w), None)


def find_by_words(headers: list[str], word_lists: list[list[str]]) -> str | None:
    """First header that contains all words of the first list that matches any header."""
    for words in word_lists:
        for header in headers:
            if all(w in header.lower() for w in words):
                return header
    return None


def _or_null(df: DataFrame, header: str | None, convert) -> Column:
    return convert(F.col(f"`{header}`")) if header else convert(F.lit(None).cast("string"))


def operations_rows(sheet: DataFrame, year: int | Column) -> DataFrame:
    """Text columns of an operations file to typed ones, plus two derived ones."""
    found = {n: find_column(sheet.columns, s) for n, s in V.OPERATIONS_HEADERS.items()}
    if found["eia_utility_id"] is None:
        raise ValueError("no utility number column in the operations file")
    year = F.lit(year) if isinstance(year, int) else year
    return _typed_operations(sheet.select(year.alias("year"), *[_or_null(sheet, h, lambda x: x).alias(n) for n, h in found.items()]))


def _typed_operations(sheet: DataFrame) -> DataFrame:
    """Typed rows of a sheet with the names of our fields; rows without an id are dropped."""
    texts = {"utility_name", "state", "ownership_type"}

    def typed(name: str) -> Column:
        if name in texts:
            return safe_str(F.col(name))
        whole = name == "eia_utility_id" or name.endswith("_customers")
        return (safe_int if whole else safe_float)(F.col(name))

    rows = sheet.select("year", *[typed(n).alias(n) for n in V.OPERATIONS_HEADERS])
    return (
        rows.filter(F.coalesce("eia_utility_id", F.lit(0)) != 0)
        .withColumn(
            "revenue_per_customer",
            revenue_per_customer(F.col("total_revenue"), F.col("total_customers")),
        )
        .withColumn("quality_score", score_operations())
    )


#: Columns a spreadsheet file has at most.
MOST_COLUMNS = 100
#: Parts that the rows of a file meet its header in.
FILE_PARTS = 32


def _header_names(parents: Column, children: Column) -> Column:
    """One name per column from two header rows; an empty parent repeats the one before."""
    def step(acc: Column, pair: Column) -> Column:
        parent = F.coalesce(F.nullif(pair["parent"], F.lit("")), acc["parent"])
        name = F.when((pair["child"] != "") & (parent != ""), F.concat(parent, F.lit("."), pair["child"])) \
            .when(pair["child"] != "", pair["child"]).otherwise(pair["parent"])
        return F.struct(parent.alias("parent"), F.array_append(acc["names"], name).alias("names"))

    start = F.struct(F.lit("").alias("parent"), F.array().cast("array<string>").alias("names"))
    pairs = F.arrays_zip(parents.alias("parent"), children.alias("child"))
    return F.aggregate(pairs, start, step, lambda acc: acc["names"])


def _column_place(names: Column, spellings: list[str]) -> Column:
    """Place (from 1) of the name equal to a spelling, else of one that contains or is contained; null if there is none."""
    wanted = [w.strip().lower() for w in spellings]
    equal = [F.nullif(F.array_position(names, w), F.lit(0).cast("bigint")) for w in wanted]
    alike = [F.nullif(F.array_position(F.transform(names, lambda n, w=w: n.contains(w) | F.lit(w).contains(n)), True), F.lit(0).cast("bigint"))
             for w in wanted]
    return F.coalesce(*equal, *alike)


def read_operations_files(spark: SparkSession, path: str, year: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, files without a usable header) of CSV files, each with a header of its own.

    A file's header is its first row that names a utility's number or name, together with the next row if
    that names customers or revenues.  Headers are found from the start of each file and turned into a
    place for each field; rows of all files are then read by the places of their own file, in one
    plan.  ``year`` may use the column ``file``.  Rows as in :func:`operations_rows`.
    """
    names = [f"c{i}" for i in range(MOST_COLUMNS)]
    lines = (
        spark.read.schema(", ".join(f"{n} string" for n in names)).option("header", False).csv(path)
        .select(F.transform(F.array(*names), lambda x: F.coalesce(F.trim(x), F.lit(""))).alias("cells"),
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .withColumn("line", F.monotonically_increasing_id())
    )
    words = F.lower(F.array_join("cells", " "))
    first = lines.filter(F.col("block") == 0)
    header = first.filter(words.contains("utility") & (words.contains("number") | words.contains("name"))) \
        .groupBy("file").agg(F.min("line").alias("header_line"), F.min_by("cells", "line").alias("parents"))
    # A line number counts on within the start of a file.
    below = first.filter(words.contains("customer") | words.contains("revenue")).select(
        "file", (F.col("line") - 1).alias("header_line"), F.col("cells").alias("children"))
    headers = header.join(below, ["file", "header_line"], "left").withColumn(
        "names", F.when(F.col("children").isNull(), F.col("parents")).otherwise(_header_names(F.col("parents"), F.col("children"))))
    # Empty cells behind the last name are no columns.
    filled = F.array_max(F.transform(F.col("names"), lambda n, i: F.when(n != "", i + 1)))
    named = headers.withColumn("names", F.transform(F.slice("names", F.lit(1), filled), lambda n: F.lower(F.trim(n))))
    places = {f: _column_place(F.col("names"), spellings) for f, spellings in V.OPERATIONS_HEADERS.items()}
    mapped = named.select(
        "file", (F.col("header_line") + F.col("children").isNotNull().cast("int")).alias("last_header"),
        *[place.cast("int").alias(f"at_{f}") for f, place in places.items()])
    usable = mapped.filter(F.col("at_eia_utility_id").isNotNull())
    # Rows go to the places of their file without the empty cells behind their last one, which most of the cells are.
    last = F.array_max(F.transform("cells", lambda x, i: F.when(x != "", i + 1)))
    short = lines.withColumn("cells", F.slice("cells", F.lit(1), F.coalesce(last, F.lit(0))))
    # Files are few and may be large: the rows of each are dealt out to the places in several parts.  The hash
    # is of the places: rows look small to the planner, which would send all of them to every task.
    parted = short.withColumn("part", (F.col("line") % FILE_PARTS).cast("int")).repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "part")
    to_each = usable.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(FILE_PARTS - 1))))
    rows = parted.join(to_each.hint("shuffle_hash"), ["file", "part"]).filter((F.col("block") > 0) | (F.col("line") > F.col("last_header")))

    def cell(at: Column) -> Column:
        return F.when(at.isNotNull(), F.coalesce(F.get("cells", at - 1), F.lit("")))

    sheet = rows.select(year.alias("year"), *[cell(F.col(f"at_{f}")).alias(f) for f in V.OPERATIONS_HEADERS])
    others = lines.select("file").distinct().join(usable.select("file"), "file", "left_anti")
    return _typed_operations(sheet), others


def emissions_rows(sheet: DataFrame, year: int | Column) -> DataFrame:
    """Coded columns of an emissions sheet to named ones; rows without a name are dropped."""
    present = {code: name for code, name in V.EMISSIONS_COLUMNS.items() if code in sheet.columns}

    def typed(code: str, name: str) -> Column:
        value = F.trim(F.col(code))
        if name in ("utility_name_egrid", "state"):
            return value
        number = value.try_cast("double")
        return number.try_cast("bigint") if name == "eia_utility_id" else F.round(number, 4)

    year = F.lit(year) if isinstance(year, int) else year
    named = sheet.filter(F.coalesce("UTLSRVNM", F.lit("")) != "").select(
        year.alias("year"),
        *[
            (typed(code, name) if code in present else F.lit(None).cast("double")).alias(name)
            for code, name in V.EMISSIONS_COLUMNS.items()
        ],
    )
    return named.withColumn("quality_score", score_emissions())


def generator_rows(sheet: DataFrame) -> DataFrame:
    """Generator rows with typed columns; rows without an id or capacity are dropped."""
    found = {n: find_by_words(sheet.columns, w) for n, w in V.GENERATOR_HEADER_WORDS.items()}
    if found["utility_id"] is None or found["nameplate_mw"] is None:
        raise ValueError("no utility id or capacity column in the generator file")

    def whole(text: Column) -> Column:
        return F.trim(text).try_cast("double").try_cast("bigint")

    def number(text: Column) -> Column:
        return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("double")

    convert = {"technology": F.trim, "status": F.trim, "nameplate_mw": number}
    rows = sheet.select(
        *[_or_null(sheet, h, convert.get(n, whole)).alias(n) for n, h in found.items()]
    )
    return rows.filter(F.col("utility_id").isNotNull() & (F.col("nameplate_mw") > 0))


# --- paged JSON ------------------------------------------------------------------------

PAGE_SCHEMA = (
    "data array<struct<iurc_docketnumber:string, iurc_petitiondate:string, "
    "iurc_legalcaseid:string, iurc_forpetionersearch:string, iurc_industry:string, "
    "iurc_casestatustype:string, iurc_petitiontypeid:string>>, "
    "PagerDetails struct<TotalPages:int>"
)


def paged_json_cases(pages: DataFrame) -> DataFrame:
    """Cases of search result pages (page_no, body), with their place."""
    parsed = pages.select("page_no", F.from_json("body", PAGE_SCHEMA).alias("page"))
    return parsed.select(
        "page_no", F.posexplode("page.data").alias("place", "case")
    ).select("page_no", "place", "case.*").filter(
        F.coalesce("iurc_docketnumber", F.lit("")) != ""
    )
