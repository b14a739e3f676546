"""The logical tables of this package, derived from the driver's tables.

The operators take column names and work on any table of the right shape.  The
test data is a TPC-H-like star schema, so each logical table is bound to it
here.  Amounts go through whole cents: sums of integers are the same in any
order, so results do not depend on how Spark splits the work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions.scores import (
    quality_components, quality_score, revenue_per_customer, score_emissions, score_operations,
)
from tariffworks.operators.resolve import alias_rows, alias_table

c, lit = F.col, F.lit

# What the codes of the driver's tables stand for.
STATUS_OF = {"F": "decided", "O": "active", "P": "filed"}
CASE_TYPE_OF = ["general_rate_case", "distribution_rate_case", "fuel_cost_adjustment",
                "rate_design", "unknown"]
SERVICE_OF = {"BUILDING": "electric", "FURNITURE": "gas", "HOUSEHOLD": "water",
              "MACHINERY": "multi_service"}
OWNERSHIP_OF = ["Investor Owned", "Municipal", "Cooperative", "Federal", "State"]
DOCUMENT_OF = {"A": "order", "N": "application", "R": "testimony"}
TECHNOLOGY_OF = {
    "STANDARD": "Conventional Steam Coal", "ECONOMY": "Natural Gas Fired Combined Cycle",
    "MEDIUM": "Nuclear", "LARGE": "Conventional Hydroelectric", "PROMO": "Onshore Wind Turbine",
    "SMALL": "Solar Photovoltaic",
}
UNIT_STATUS_OF = {"A": "OP", "N": "P", "R": "Proposed"}
CLASS_OF = {"A": "residential", "N": "commercial", "R": "industrial"}
DOCKET_PREFIX_OF = {"BUILDING": "UE-", "FURNITURE": "UG ", "HOUSEHOLD": "UW-",
                    "MACHINERY": "ER-", "AUTOMOBILE": "GR-"}


# Types of the driver's tables, so that planning a query reads no file.
TABLE_TYPES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_TYPES:
        reader = reader.schema(TABLE_TYPES[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, *keys: str, times: int = 1) -> DataFrame:
    """Rows dealt out by keys of few rows each, before costly expressions.

    A scan alone has as many tasks as its files have row groups, and a join of small rows as few as adaptive
    execution leaves; both may be one.  ``times`` as many tasks as a shuffle has otherwise hold less each.
    """
    return rows.repartition(times * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _nth(values: list[str], position: Column) -> Column:
    """Element at a position that counts from 1."""
    return F.element_at(F.array(*[lit(v) for v in values]), position.cast("int"))


def _case(column: Column, mapping: dict[str, str]) -> Column:
    return reduce(lambda acc, kv: acc.when(column == kv[0], kv[1]),
                  list(mapping.items())[1:], F.when(column == list(mapping)[0], list(mapping.values())[0]))


def _cents(amount: Column) -> Column:
    return F.floor(amount * 100 + 0.5).cast("bigint")


def _whole(value: Column) -> Column:
    return F.floor(value).cast("bigint")


def state_code() -> Column:
    """Two-letter code of a nation; the last nation keeps its name and so is not a valid code."""
    return F.when(c("n_nationkey") < 24, _nth(V.STATE_CODES, c("n_nationkey") + 1)).otherwise(c("n_name"))


def canonical() -> Column:
    return F.when(
        c("c_mktsegment") != "MACHINERY",
        F.concat(c("c_mktsegment"), lit(" GROUP "), c("n_regionkey").cast("string")),
    )


def priority() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(nation, c("c_nationkey") == c("n_nationkey"))


def rate_cases(spark: SparkSession, sf_dir: str, score: bool = True, every_column: bool = False
               ) -> DataFrame:
    """One case per order.  ``seq`` is its order of arrival."""
    amounts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").cast("date").alias("last_ship"),
        F.sum(_cents(c("l_extendedprice"))).alias("gross"),
        F.sum(_cents(c("l_extendedprice") * (1 - c("l_discount")))).alias("net"),
    )
    joined = (
        table(spark, sf_dir, "orders")
        .join(customers(spark, sf_dir), c("o_custkey") == c("c_custkey"))
        .join(amounts, c("o_orderkey") == c("l_orderkey"), "left")
    )
    joined = dealt(joined, "o_orderkey")
    decided = c("o_orderstatus") == "F"
    sign = F.when(decided & (c("o_orderpriority") == "5-LOW"), lit(-1.0)).otherwise(lit(1.0))

    def millions(cents: Column) -> Column:
        return sign * (_whole((cents + 50) / 100) / 1000)

    decision = F.when(decided, c("last_ship"))
    requested = millions(c("gross"))
    base = F.when(
        c("o_orderpriority") != "2-HIGH", _whole(_cents(c("o_totalprice")) / 300) / 100
    )
    cases = joined.select(
        c("o_orderkey").cast("string").alias("docket_number"),
        c("c_name").alias("utility_name"),
        canonical().alias("canonical_utility_name"),
        state_code().alias("state"),
        _nth(V.SOURCES, c("n_regionkey") + 1).alias("source"),
        _nth(CASE_TYPE_OF, priority()).alias("case_type"),
        _case(c("c_mktsegment"), SERVICE_OF).alias("utility_type"),
        _case(c("o_orderstatus"), STATUS_OF).alias("status"),
        F.when(
            ~((c("o_orderstatus") == "P") & (c("o_orderpriority") == "4-NOT SPECIFIED")),
            c("o_orderdate").cast("date"),
        ).alias("filing_date"),
        decision.alias("decision_date"),
        F.date_add(decision, 30).alias("effective_date"),
        requested.alias("requested_revenue_change"),
        F.when(decided, millions(c("net"))).alias("approved_revenue_change"),
        base.alias("rate_base"),
        F.when(~(c("o_orderstatus") == "O"), _whole(_cents(c("c_acctbal")) / 300) / 100)
        .alias("return_on_equity"),
        F.when(base > 0, _whole(requested * 10000 / base) / 100).alias("requested_rate_change_pct"),
        lit(None).cast("double").alias("approved_rate_change_pct"),
        F.when(
            c("o_orderpriority") != "3-MEDIUM",
            F.concat(lit("https://dockets.example.org/"), c("o_orderkey").cast("string")),
        ).alias("source_url"),
        F.when(
            c("o_orderstatus") != "P",
            F.concat(lit("Rate  case <b>"), c("c_mktsegment"), lit("</b> &amp; tariff "),
                     c("o_orderkey").cast("string")),
        ).alias("description"),
        c("o_orderkey").alias("seq"),
        *([c(x) for x in ("o_orderpriority", "o_orderdate", "o_orderstatus")] if every_column else []),
    )
    return cases.withColumn("quality_score", quality_score(quality_components())) if score else cases


def utilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select(
        c("c_name").alias("name"), canonical().alias("canonical_name"),
        state_code().alias("state"),
        F.coalesce(_case(c("c_mktsegment"), SERVICE_OF), lit("unknown")).alias("utility_type"),
        F.when(c("n_regionkey") == 0, "unknown").otherwise("investor_owned").alias("ownership_type"),
        F.when(c("n_regionkey") == 1, c("n_name")).alias("parent_company"),
        _whole(c("c_acctbal")).alias("customer_count"),
        c("c_custkey").alias("eia_utility_id"),
        lit(None).cast("bigint").alias("ferc_respondent_id"),
        c("c_custkey").alias("seq"),
    )


def case_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = c("l_linenumber").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").cast("string").alias("docket_number"),
        _case(c("l_returnflag"), DOCUMENT_OF).alias("document_type"),
        F.concat(lit("Exhibit "), line, lit(" part "), c("l_partkey").cast("string")).alias("title"),
        F.concat(lit("Supplier "), c("l_suppkey").cast("string")).alias("filed_by"),
        c("l_shipdate").cast("date").alias("filing_date"),
        F.when(c("l_linestatus") == "F", F.concat(lit("https://files.example.org/"), line))
        .otherwise(F.concat(lit("ftp://files.example.org/"), line)).alias("url"),
        lit("oregon_puc").alias("source"), lit("OR").alias("state"),
    )


SUPPLIER_NAMES = ["s_name", "n_nationkey", "n_name", "n_regionkey"]


def with_supplier(spark: SparkSession, sf_dir: str, sums: DataFrame, names: list[str]) -> DataFrame:
    """Sums of a supplier's lines (by l_suppkey) with its names; ``names`` are the columns that are sums.

    A supplier that comes several times has its lines as often, but counts its orders once.
    """
    supplier = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), c("s_nationkey") == c("n_nationkey")
    ).groupBy("s_suppkey", *SUPPLIER_NAMES).agg(F.count("*").alias("copies"))
    return sums.join(supplier, c("l_suppkey") == c("s_suppkey")).select(
        *[(c(x) * c("copies")).alias(x) if x in names else c(x) for x in sums.columns], *SUPPLIER_NAMES)


def utility_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, revenue, sales and price by supplier and year."""
    # Lines are summed up by supplier, year and order before names join, and dealt out first: a scan's tasks
    # would each hold nearly all of their rows as groups, since an order rarely has two lines of a supplier.
    # What is dealt out is a supplier's year in eight parts of its orders, so that both sums are made where
    # the lines are and eight rows of a year at most go on, however many lines it has.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"), F.pmod(F.hash("l_orderkey"), lit(8)).alias("part"), "l_orderkey",
        "l_returnflag", _cents(c("l_extendedprice")).alias("cents"), c("l_quantity").cast("bigint").alias("mwh"))
    classes = {name: c("l_returnflag") == flag for flag, name in CLASS_OF.items()}
    classes["total"] = lit(True)
    # Orders first: each is then one row, and customers are counted without a
    # distinct count per class, which would multiply the rows.
    part = ["l_suppkey", "year", "part"]
    per_order = dealt(lines, *part, times=4).groupBy(*part, "l_orderkey").agg(*[
        F.sum(F.when(inside, c(x))).alias(f"{name}_{x}") for name, inside in classes.items() for x in ("cents", "mwh")])
    per_year = per_order.groupBy("l_suppkey", "year").agg(*[
        x for name in classes for x in (
            F.count(f"{name}_cents").alias(f"{name}_customers"),
            F.sum(f"{name}_cents").alias(f"{name}_cents"), F.sum(f"{name}_mwh").alias(f"{name}_mwh"))
    ])
    grouped = with_supplier(spark, sf_dir, per_year, [f"{n}_{x}" for n in classes for x in ("cents", "mwh")])

    def price(name: str) -> Column:
        return _whole(c(f"{name}_cents") / c(f"{name}_mwh") / 100) / 100

    every = ["residential", "commercial", "industrial", "total"]
    out = grouped.select(
        c("l_suppkey").alias("eia_utility_id"), "year", c("s_name").alias("utility_name"),
        state_code().alias("state"), _nth(OWNERSHIP_OF, c("n_regionkey") + 1).alias("ownership_type"),
        *[F.nullif(f"{n}_customers", lit(0)).alias(f"{n}_customers") for n in every],
        *[(_whole(c(f"{n}_cents") / 100) / 1000).alias(f"{n}_revenue") for n in every],
        *[c(f"{n}_mwh").cast("double").alias(f"{n}_sales_mwh") for n in every],
        *[price(n).alias(f"{n}_avg_price") for n in every[:3]],
        price("total").alias("avg_price"),
        (c("l_suppkey") * 10000 + c("year")).alias("seq"),
    )
    return out.withColumn(
        "revenue_per_customer", revenue_per_customer(c("total_revenue"), c("total_customers"))
    ).withColumn("quality_score", score_operations())


def utility_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation, emissions and shares by supplier and year."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    # Names join the sums, so that no line is shuffled with them.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"), "l_partkey", c("l_quantity").cast("bigint").alias("qty"))
    qty = c("qty")
    shares = dict(zip(TECHNOLOGY_OF, V.FUELS))
    sums = {"gen": F.sum(qty), "co2": F.sum(qty * c("p_size")), **{
        f: F.sum(F.when(c("p_type") == t, qty).otherwise(lit(0).cast("bigint"))) for t, f in shares.items()}}
    per_year = lines.join(part, c("l_partkey") == c("p_partkey")).groupBy("l_suppkey", "year").agg(
        *[total.alias(name) for name, total in sums.items()])
    grouped = with_supplier(spark, sf_dir, per_year, list(sums))
    out = grouped.select(
        c("s_name").alias("utility_name_egrid"), state_code().alias("state"), "year",
        F.when(c("n_regionkey") != 0, c("l_suppkey")).alias("eia_utility_id"),
        c("gen").cast("double").alias("net_generation_mwh"),
        c("co2").cast("double").alias("co2_tons"),
        F.when(c("coal") > 0, _whole(c("co2") * 2000 / c("gen")).cast("double")).alias("co2_rate_lbs_mwh"),
        *[F.when(c(f) > 0, _whole(c(f) * 10000 / c("gen")) / 100).alias(f"{f}_pct") for f in shares.values()],
        lit(None).cast("double").alias("other_renewable_pct"),
    )
    return out.withColumn("quality_score", score_emissions())


def generators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generator per line item."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    year = F.year("l_shipdate")
    return table(spark, sf_dir, "lineitem").join(part, c("l_partkey") == c("p_partkey")).select(
        c("l_suppkey").alias("utility_id"), c("l_partkey").alias("plant_code"),
        _case(c("p_type"), TECHNOLOGY_OF).alias("technology"),
        c("l_quantity").alias("nameplate_mw"), year.alias("operating_year"),
        _case(c("l_returnflag"), UNIT_STATUS_OF).alias("status"),
        F.when(c("l_linestatus") == "F", year + c("l_linenumber")).alias("planned_retirement_year"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of display names to reference ids; several rows per name, the last one counts."""
    return customers(spark, sf_dir).select(
        F.coalesce(canonical(), c("c_name")).alias("utility_name"), state_code().alias("state"),
        (c("c_custkey") % 100).alias("eia_utility_id"), lit(1.0).alias("match_confidence"),
        lit("exact").alias("match_method"), c("c_custkey").alias("seq"),
    )


# --- names -----------------------------------------------------------------------------

def linkage_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisations to link: product names, misspelt in five ways."""
    kind = c("p_size") % 5
    words = F.split("p_name", " ")
    name = (
        F.when(kind == 0, F.concat("p_name", lit(" Company")))
        .when(kind == 1, F.concat(F.replace("p_name", lit("e"), lit("")), lit(" Inc.")))
        .when(kind == 2, F.concat_ws(" ", words[1], words[0]))
        .when(kind == 3, F.concat(lit("The "), "p_name", lit(" & "), "p_name"))
        .otherwise(F.concat("p_name", lit("x"), F.substring("p_brand", 7, 2)))
    )
    return table(spark, sf_dir, "part").select(
        name.alias("name"), lit(None).cast("string").alias("canonical_name"),
        _nth(V.STATE_CODES, c("p_size") % 10 + 1).alias("state"),
    ).distinct()


def linkage_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference records to link to."""
    brand = F.substring("p_brand", 7, 2).cast("int")
    return table(spark, sf_dir, "part").select(
        c("p_partkey").alias("eia_utility_id"),
        F.concat(F.initcap("p_name"), lit(" Corporation")).alias("utility_name"),
        F.lower(_nth(V.STATE_CODES, brand % 12 + 1)).alias("state"), c("p_partkey").alias("seq"),
    )


def linkage_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emission records to link, by name only in part known to the links."""
    return linkage_left(spark, sf_dir).select(
        c("name").alias("utility_name_egrid"), "state", lit(2001).alias("year"),
        F.when(F.length("name") > 12, F.length("name").cast("bigint")).alias("eia_utility_id"),
    )


def raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw organisation names with a state: known spellings, changed in five ways."""
    aliases = alias_table(spark)
    n = len(alias_rows())
    kind = c("p_size") % 5
    name = (
        F.when(kind == 0, c("alias"))
        .when(kind == 1, F.concat("alias", lit(", Inc.")))
        .when(kind == 2, F.concat(F.substring("alias", 1, 3), F.substring("alias", 5, 100)))
        .when(kind == 3, F.concat("alias", lit(" "), F.substring("p_name", 1, 3)))
        .otherwise(F.concat("p_name", lit(" Co-op "), c("p_brand")))
    )
    state = F.when(c("p_size") % 2 == 0, c("alias_state")).otherwise(
        _nth(V.STATE_CODES, c("p_size") % 50 + 1)
    )
    every = table(spark, sf_dir, "part").join(
        aliases, (c("p_partkey") % n).cast("int") == c("pos")
    ).select(name.alias("utility_name"), state.alias("state"), c("p_partkey").alias("seq"))
    return every.groupBy("utility_name").agg(F.min_by("state", "seq").alias("state"))


# --- text -------------------------------------------------------------------------------

def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records as text, written from the cases in five styles."""
    p = priority()
    cases = rate_cases(spark, sf_dir, score=False, every_column=True)

    def money(value: str) -> Column:
        k = F.round(F.abs(F.coalesce(c(value), c("requested_revenue_change"), lit(0.0))) * 1000).cast("bigint")
        return F.concat(_whole(k / 1000).cast("string"), lit("."), F.lpad((k % 1000).cast("string"), 3, "0"))

    day = c("o_orderdate").cast("date")
    roe = F.concat((c("seq") % 15).cast("string"), lit("."), (c("seq") % 10).cast("string"))
    about = (
        F.when(p == 1, F.concat(
            "utility_name", lit(" requests a revenue increase of $"), money("requested_revenue_change"),
            lit(" million. Approved increase of $"), money("approved_revenue_change"),
            lit(" million; return on equity of "), roe, lit("% and rate base of $"),
            (c("seq") + 1000).cast("string"), lit(" million. Filed on "), F.date_format(day, "yyyy-MM-dd")))
        .when(p == 2, F.concat(
            lit("Proposed decrease of $"), (c("seq") * 1000 + 250000).cast("string"),
            lit(" for electric service, filed "), F.date_format(day, "MMMM d, yyyy")))
        .when(p == 3, F.concat(
            lit("General rate case seeking $"), money("requested_revenue_change"), lit("M; authorized $"),
            money("approved_revenue_change"), lit("M. ROE "), roe, lit("%")))
        .when(p == 4, F.concat(
            lit("Fuel cost adjustment: $"), money("requested_revenue_change"),
            lit(" billion over 3 years and $5 million, water service")))
        .otherwise(F.concat(
            lit("Notice of hearing on "), F.date_format(day, "MM/dd/yyyy"), lit("; rate design "), roe,
            lit(" percent, $12,500,000 at stake")))
    )
    segment = F.regexp_extract("description", "<b>(.*?)</b>", 1)
    prefix = F.coalesce(_case(segment, DOCKET_PREFIX_OF), lit("WR-"))
    blank = (p == 5) & (c("o_orderstatus") == "P")
    return cases.select(
        F.when(blank, lit("  ")).otherwise(F.concat(lit(" "), prefix, c("docket_number"))).alias("docket_number"),
        "utility_name", F.concat(lit(" "), F.lower("state")).alias("state"), "source",
        F.when(p == 1, "unknown").when(p == 2, "bogus").when(p == 4, "rate_design").when(p == 5, "").alias("case_type"),
        F.when(p == 4, "telecom").when(p == 5, "water").alias("utility_type"),
        _case(c("o_orderstatus"), {"F": " Final Order ", "O": "Open", "P": "Settlement reached"}).alias("status"),
        F.when(p == 1, F.date_format(day, "yyyy-MM-dd")).when(p == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(p == 3, F.date_format(day, "MMMM d, yyyy")).when(p == 4, F.date_format(day, "M/d/yy"))
        .otherwise("to be set").alias("filing_date"),
        F.date_format("decision_date", "yyyyMMdd").alias("decision_date"),
        lit(None).cast("string").alias("effective_date"),
        F.when(p == 4, money("requested_revenue_change"))
        .when((p == 5) & (c("o_orderstatus") == "F"), F.concat(lit("$"), money("requested_revenue_change"), lit(" million")))
        .alias("requested_revenue_change"),
        *[lit(None).cast("string").alias(x) for x in [
            "approved_revenue_change", "rate_base", "return_on_equity", "requested_rate_change_pct",
            "approved_rate_change_pct"]],
        "source_url", about.alias("description"), lit(None).cast("string").alias("scraped_at"), "seq",
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts (id, text): descriptions of raw records, and documents."""
    described = raw_records(spark, sf_dir).select(
        F.concat(lit("o"), c("seq").cast("string")).alias("id"), c("description").alias("text")
    )
    documents = dealt(table(spark, sf_dir, "documents"), "doc_id").select(
        F.concat(lit("d"), c("doc_id").cast("string")).alias("id"), "text"
    )
    return described.unionByName(documents)


# --- pages -------------------------------------------------------------------------------

def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages (page_id, html): docket pages written from the orders, and web pages.

    Web pages have negative ids.
    """
    orders = dealt(table(spark, sf_dir, "orders").join(customers(spark, sf_dir), c("o_custkey") == c("c_custkey")), "o_orderkey")
    key = c("o_orderkey").cast("string")
    day = c("o_orderdate").cast("date")
    us = F.date_format(day, "M/d/yyyy")
    late = F.date_format(F.date_add(day, 90), "MM/dd/yyyy")
    two = F.lpad((c("o_orderkey") % 100).cast("string"), 2, "0")
    ref = F.concat(F.date_format(day, "yy-MM-"), two)
    full = F.concat(ref, F.when(c("o_orderstatus") == "F", "RE01").otherwise(""))
    service = _case(c("c_mktsegment"), {"BUILDING": "UE", "FURNITURE": "UG", "HOUSEHOLD": "UM",
                                        "MACHINERY": "ER", "AUTOMOBILE": "WR"})
    sheet = F.concat(service, F.date_format(day, "-yyyy-"), F.lpad((c("o_orderkey") % 100000).cast("string"), 5, "0"))
    status = _case(c("o_orderstatus"), {"F": "Closed", "O": "Pending", "P": "Open"})
    price = _cents(c("o_totalprice")).cast("string")
    html = F.concat(
        lit("<html><head><title>Docket Sheet - "), sheet, lit("</title></head><body>"),
        lit("<div>Status</div> <div class=\"v\"> <b>"), status, lit("</b> ("), us, lit(") </div>"),
        lit("<div>Utility Type</div><div>"), F.initcap("c_mktsegment"), lit("</div>"),
        lit("<div>Type of Case</div>\n<div>"),
        _nth(["General Rate Increase", "Fuel Adjustment", "Infrastructure Charge", "Rate Design", "Tariff"], priority()),
        lit("</div><h2>Subject Companies</h2><a title=\"View\" href=\"#\">"), c("c_name"),
        lit(" d/b/a "), F.initcap("c_mktsegment"), lit(" &amp; Sons ("), lit("Investor)</a>"),
        lit("<a aria-label=\"View relationships for "), c("n_name"), lit(" Power\" href=\"#\">x</a>"),
        lit("<div>Style of Case</div><div>In the Matter of "), c("c_name"), lit(" &amp; Others</div>"),
        lit("<a class=\"t\" href=\"/Case/FilingDisplay/"), key, lit("\">Tariff revision "), key, lit("</a>"),
        lit("<a href=\"/Case/FilingDisplay/"), key, lit("\">Direct testimony on revenue increase</a>"),
        F.when(c("o_orderstatus") == "F", F.concat(lit("<a href=\"/Case/FilingDisplay/1\">Order: $"), price, lit(" granted</a>"))).otherwise(""),
        lit("<table><tr class=\"h\"><td>Docket</td><td>Name</td></tr><tr><td>"), service, lit(" "), key,
        lit(" [PDF]</td><td><a href=\"docket.asp?DocketID="), key, lit("\">"), c("c_name"),
        lit(" - Met Retention</a></td><td>"), us, lit("</td><td>&nbsp;</td><td>"),
        F.when(c("o_orderstatus") == "F", late).otherwise("&nbsp;"), lit("</td></tr>"),
        lit("<tr><td>Rate change of <i>$"), price, lit("</i> requested by the company in docket</td></tr></table>"),
        lit("<p>See also ["), full, lit("] on the revenue requirement of "), c("c_name"),
        lit(" and <a href=\"#\">docket "), ref, lit(" notice</a></p>"),
        lit("<font size=\"2\" color=\"#008000\">"), full, lit("</font><a href=\"x?OpenDocument&amp;n="), key,
        lit("\">Application of "), c("c_name"), lit("</a>"),
        lit("<div id=\"dockTitle\"> <span>"), F.initcap("c_mktsegment"), lit(" "), F.date_format(day, "yyyy"),
        _nth([" Rate Case", " Base Rate Review", " Certificate", " Rate Plan", " Complaint"], priority()), lit("</span> </div>"),
        lit("<a href=\"/search/facts-docket/?docketId="), c("c_custkey").cast("string"), lit("\">d</a>"),
        lit("<p>Filed By:</b> "), c("c_name"), lit("</p><p>Industry :</b>"), lit("Electric and Gas</p>"),
        lit("<p>Filing Date:</b> "), us, lit("</p><p>Category =</b> Ratesetting</p><p>Description:</b> Rates of "),
        c("c_name"), lit("</p><p>Dockets A."), F.date_format(day, "yy-MM-"), F.lpad((c("o_orderkey") % 1000).cast("string"), 3, "0"),
        lit(" R-"), F.date_format(day, "yyyy-"), F.lpad(key, 7, "0"), lit("</p></body></html>"),
    )
    written = orders.select(c("o_orderkey").alias("page_id"), html.alias("html"))
    web = dealt(table(spark, sf_dir, "pages"), "page_id").select((-1 - c("page_id")).alias("page_id"), "html")
    return written.unionByName(web)
