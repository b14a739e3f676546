"""Queries that write files and read them back, sources, and the stream.

Files go to the shared folder the cluster names; a local one is used only where
none is set, as in tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.stored import capacity, impacts
from tariffworks import fixed_values as V
from tariffworks import schemas
from tariffworks.operators import checked, impact, merge
from tariffworks.operators.firstwins import first_per_key
from tariffworks.plans import adapters as A
from tariffworks.plans import jobs
from tariffworks.session import shared_folder
from tariffworks.sources import readers, writers
from tariffworks.streaming import ingest

c, lit = F.col, F.lit


def scratch(s) -> str:
    """A new folder for one run."""
    folder = shared_folder(s)
    if folder is None:
        raise RuntimeError("spark.checkpoint.dir names no shared folder")
    return f"{folder}/run-{uuid.uuid4().hex}"


RAW_SHOWN = schemas.RAW_RECORD.names


def _raw_files(s, d):
    """Raw records written as files: arrays of a thousand, the last of each thousand alone, and files cut short."""
    folder = scratch(s)
    raw = A.raw_records(s, d).select("seq", F.struct(*RAW_SHOWN).alias("record"))
    single = c("seq") % 1000 == 999
    kind = F.when(single, F.concat(lit("one-"), c("seq").cast("string"))).otherwise(
        F.concat(lit("list-"), F.floor(c("seq") / 1000).cast("string")))
    listed = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("seq", "record"))), lambda x: x["record"]))
    files = raw.groupBy(kind.alias("part")).agg(
        F.when(F.count("*") == 1, F.to_json(F.first("record"))).otherwise(listed).alias("value"))
    # Each file and, of a list, the one cut short: from one run of what makes them.
    cut = F.when(c("part").startswith("list-"), F.struct(
        F.concat(lit("cut-"), c("part")).alias("part"), F.substring("value", 1, 100).alias("value")))
    every = files.select(F.inline(F.array_compact(F.array(F.struct("part", "value"), cut))))
    every.repartition("part").write.partitionBy("part").text(folder)
    return readers.read_raw_json(s, f"{folder}/*")


def _raw_json(s, d):
    return _raw_files(s, d)[0].select(*RAW_SHOWN)


def _raw_rejects(s, d):
    return _raw_files(s, d)[1].select(F.regexp_extract("file", "part=([^/]*)", 1).alias("part"), "reason", F.length("text").alias("n_chars"))


def _union(s, d):
    """The raw records split by source and put together again."""
    raw = A.raw_records(s, d)
    frames = {key: raw.filter(c("source") == key).drop("source", "scraped_at") for key in V.SOURCES}
    frames["oregon_puc"] = frames["oregon_puc"].drop("source_url")
    return readers.union_sources(frames).select("docket_number", "source", "source_url", "description")


def _sheet(s, d):
    """The operations as the text of a spreadsheet, with thousands separators and gaps."""
    ops = A.utility_operations(s, d)
    number = {f"{x}_{m}": f"{x.title()} {h}" for x in V.CUSTOMER_CLASSES for m, h in [
        ("customers", "Customers"), ("revenue", "Revenue (Thousands Dollars)"), ("sales_mwh", "Sales (Megawatthours)")]}
    prices = {f"{x}_avg_price": f"Average Price (Cents/kWh).{x.title()}" for x in V.CUSTOMER_CLASSES[:3]}
    prices["avg_price"] = "Average Price (Cents/kWh).Total"
    return ops.select(
        F.when(c("eia_utility_id") != 3, F.concat(lit(" "), c("eia_utility_id").cast("string"))).otherwise("NA").alias("UTILITY_NUMBER"),
        c("year").alias("Data Year"), c("utility_name").alias("Utility Name"), c("state").alias("STATE"),
        F.concat("ownership_type", lit(" ")).alias("Ownership Type"),
        *[F.coalesce(F.format_number(a, 3), lit(".")).alias(b) for a, b in {**number, **prices}.items()])


def _operations_files(s, d):
    """The sheet as one file per year: one header row, two header rows, or a title, columns turned round and other spellings."""
    sheet = _sheet(s, d).withColumnRenamed("Data Year", "year")
    columns = [x for x in sheet.columns if x != "year"]
    paired = []
    for x in columns:
        of_class = next((k for k in V.CUSTOMER_CLASSES if x.startswith(f"{k.title()} ")), None)
        paired.append((of_class.upper(), x[len(of_class) + 1 :]) if of_class else tuple(x.split(".")) if "." in x else (x, ""))
    # A parent stands over the first of its columns.
    parents = [p if i == 0 or p != paired[i - 1][0] else "" for i, (p, _) in enumerate(paired)]
    other = {"UTILITY_NUMBER": "Utility Number", "Utility Name": "utility name ", "STATE": "State", "Ownership Type": "Ownership"}
    style = c("year") % 3

    def text(values) -> str:
        return F.array_join(F.array(*[F.concat(lit('"'), F.coalesce(v, lit("")), lit('"')) for v in values]), ",")

    turned = columns[::-1]
    body = sheet.select("year", lit(9).alias("line"), F.when(style == 2, text(c(f"`{x}`") for x in turned)).otherwise(
        text(c(f"`{x}`") for x in columns)).alias("value"))
    years = sheet.select("year").distinct()
    heads = [
        (years.filter(style == 0), 1, [lit(x) for x in columns]),
        (years.filter(style == 1), 1, [lit(p) for p in parents]),
        (years.filter(style == 1), 2, [lit(child) for _, child in paired]),
        (years.filter(style == 2), 1, [lit("Sales to customers"), *[lit("")] * (len(columns) - 1)]),
        (years.filter(style == 2), 2, [lit(other.get(x, x)) for x in turned]),
    ]
    lines = body
    for part, line, cells in heads:
        lines = lines.unionByName(part.select("year", lit(line).alias("line"), text(cells).alias("value")))
    folder = scratch(s)
    lines.repartition("year").sortWithinPartitions("year", "line").drop("line").write.partitionBy("year").text(folder)
    year = F.regexp_extract("file", r"year=(\d+)", 1).cast("int")
    return readers.read_operations_files(s, f"{folder}/*", year)[0]


def _emission_sheet(s, d):
    rows = A.utility_emissions(s, d)
    back = {name: code for code, name in V.EMISSIONS_COLUMNS.items()}
    shown = [x for x in back if x in rows.columns and x != "other_renewable_pct"]
    return rows.select(
        "year", *[F.coalesce(F.concat(lit(" "), c(x).cast("string")), lit("N/A")).alias(back[x]) for x in shown])


def _generator_sheet(s, d):
    g = A.generators(s, d)
    return g.select(
        F.when(c("nameplate_mw") == 7, "n/a").otherwise(c("utility_id").cast("string")).alias("Utility ID"),
        c("plant_code").cast("string").alias("Plant Code"), c("technology").alias("Technology"),
        F.when(c("nameplate_mw") == 9, "0").otherwise(F.format_number("nameplate_mw", 1)).alias("Nameplate Capacity (MW)"),
        c("operating_year").cast("string").alias("Operating Year"), c("status").alias("Status"),
        c("planned_retirement_year").cast("string").alias("Planned Retirement Year"))


def _paged(s, d):
    """Search results in pages of fifty, some cases on two pages; the first place counts."""
    cases = A.rate_cases(s, d, score=False)
    case = F.struct(
        F.when(c("status") != "filed", c("docket_number")).otherwise("").alias("iurc_docketnumber"),
        F.date_format("filing_date", "MM/dd/yyyy").alias("iurc_petitiondate"), c("docket_number").alias("iurc_legalcaseid"),
        c("utility_name").alias("iurc_forpetionersearch"), c("utility_type").alias("iurc_industry"), c("status").alias("iurc_casestatustype"))
    page_no = F.floor(c("seq") / 50)
    both = cases.select(page_no.alias("page_no"), c("seq"), case.alias("case")).unionByName(
        cases.filter(c("source") == "oregon_puc").select((page_no + 1).alias("page_no"), c("seq"), case.alias("case")))
    pages = both.groupBy("page_no").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("seq", "case"))), lambda x: x["case"]).alias("data")
    ).select("page_no", F.to_json(F.struct("data")).alias("body"))
    found = readers.paged_json_cases(pages)
    return first_per_key(found, ["iurc_docketnumber"], "page_no", "place").select(
        "page_no", "iurc_docketnumber", "iurc_petitiondate", "iurc_forpetionersearch", "iurc_industry")


def _stored_tables(s, d):
    """The nine tables as derived, with the columns they are stored with."""
    runs = A.table(s, d, "orders").select(*merge.audit_start(
        F.lpad(c("o_orderkey").cast("string"), 8, "0"), c("o_orderpriority"), "store", c("o_orderdate").cast("timestamp")))
    tables = {
        "rate_cases": A.rate_cases(s, d), "utilities": A.utilities(s, d), "case_documents": A.case_documents(s, d), "pipeline_runs": runs,
        "utility_operations": A.utility_operations(s, d), "utility_eia_links": A.links(s, d), "utility_emissions": A.utility_emissions(s, d),
        "utility_capacity": capacity(s, d), "rate_case_impacts": impacts(s, d)}
    return {name: df.select(*[c(f.name).cast(f.dataType) for f in schemas.TABLES[name][0].fields if f.name in df.columns])
            for name, df in tables.items()}


def _tables(s, d):
    """All nine tables written and read back: rows, and the length of their keys together."""
    folder, out = scratch(s), None
    for name, df in _stored_tables(s, d).items():
        back = s.read.schema(df.schema).parquet(writers.write_table(df, folder, name, 1))
        keys = schemas.TABLES[name][1] or ["docket_number"]
        size = sum((F.length(F.coalesce(c(k).cast("string"), lit(""))) for k in keys), lit(0))
        found = back.agg(F.count("*").alias("n"), F.sum(size).alias("key_length")).select(lit(name).alias("name"), "n", "key_length")
        out = found if out is None else out.unionByName(found)
    return out


def _case_table(s, d):
    """The case table written by state and read back."""
    df = _stored_tables(s, d)["rate_cases"]
    back = s.read.schema(df.schema).parquet(writers.write_table(df, scratch(s), "rate_cases", 1))
    return back.select("docket_number", "source", "state", "filing_date", "requested_revenue_change", "quality_score")


def _csv_and_back(rows):
    """What a CSV export holds once it is read again with the types it was written with."""
    def run(s, d):
        df, folder = rows(s, d), scratch(s)
        writers.write_csv(df, folder)
        return s.read.schema(df.schema).option("header", True).option("multiLine", True).option("escape", '"').csv(folder)
    return run


def _json_cases(s, d):
    """The cases of the JSON export, read again."""
    folder = scratch(s)
    cases = A.rate_cases(s, d).drop("seq")
    jobs.export({"rate_cases": cases, "utilities": A.utilities(s, d).drop("seq")}, folder, ("json",))
    return s.read.schema(cases.schema).json(f"{folder}/json/rate_cases").select(
        "docket_number", "source", "utility_name", "state", "filing_date", "approved_revenue_change", "description", "quality_score")


def _checked(table, rows, shown):
    """Rows checked, written once, and read as accepted or rejected."""
    def run(s, d):
        folder = scratch(s)
        checked.write_checked(rows(s, d), table, folder)
        accepted = checked.read_accepted(s, folder).select(*shown, lit("").alias("reasons"))
        return accepted.unionByName(checked.read_rejected(s, folder).select(*shown, F.array_join("reasons", "; ").alias("reasons")))
    return run


def _unkempt_cases(s, d):
    """Cases with blanks around their texts, lower-case states and finer amounts."""
    return A.rate_cases(s, d).drop("seq").withColumns({
        "docket_number": F.concat(lit(" "), "docket_number"), "state": F.lower("state"),
        "requested_revenue_change": c("requested_revenue_change") + 0.0001})


def _kept(s, tables, folder):
    """Derived tables written once, as a store holds them, and read from there by each use."""
    back = {}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
        back[name] = s.read.schema(df.schema).parquet(f"{folder}/{name}")
    return back


def _export(s, d):
    """All exports written, and the rows of each counted."""
    folder = scratch(s)
    tables = _kept(s, {"rate_cases": A.rate_cases(s, d).drop("seq"), "utility_operations": A.utility_operations(s, d),
                       "utility_emissions": A.utility_emissions(s, d), "utility_capacity": capacity(s, d)}, f"{folder}/tables")
    tables |= _kept(s, {"rate_case_impacts": impact.rate_case_impacts(
        tables["rate_cases"], A.links(s, d), tables["utility_operations"])}, f"{folder}/tables")
    jobs.export(tables | {"utilities": A.utilities(s, d).drop("seq")}, folder, ("csv", "json", "report"))
    names = ["rate_cases", "utility_operations", "utility_emissions", "utility_capacity", "rate_case_impacts", "report_utilities"]
    counts = [s.read.option("header", True).option("multiLine", True).csv(f"{folder}/{n}_csv").agg(F.count("*").alias("n")).select(lit(n).alias("name"), "n")
              for n in names]
    counts.append(s.read.json(f"{folder}/json/rate_cases").agg(F.count("*").alias("n")).select(lit("json").alias("name"), "n"))
    out = counts[0]
    for x in counts[1:]:
        out = out.unionByName(x)
    return out


def _stream(s, d):
    """Raw records arriving as files, folded into the current cases."""
    folder = scratch(s)
    A.raw_records(s, d).drop("seq").write.json(f"{folder}/raw")
    ingest.stream_ingest(s, f"{folder}/raw", f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return ingest.read_current(s, f"{folder}/table").select(
        "docket_number", "source", "utility_name", "state", "case_type", "utility_type", "status", "filing_date",
        "requested_revenue_change", "approved_revenue_change")


QUERIES = {
    "src_raw_json": _raw_json,
    "src_union_all": _union,
    "src_raw_json_rejects": _raw_rejects,
    "src_ops_sheet": lambda s, d: readers.operations_rows(_sheet(s, d), c("Data Year")),
    "src_ops_csv": _operations_files,
    "src_emissions_map": lambda s, d: readers.emissions_rows(_emission_sheet(s, d), c("year")),
    "src_generator_rows": lambda s, d: readers.generator_rows(_generator_sheet(s, d)),
    "src_paged_json_cases": _paged,
    "sink_tables": _tables,
    "sink_case_table": _case_table,
    "sink_cases_csv": _csv_and_back(lambda s, d: writers.cases_csv(A.rate_cases(s, d))),
    "sink_enrichment_csv": _csv_and_back(lambda s, d: writers.enrichment_csv(capacity(s, d).withColumn("created_at", F.current_timestamp()))),
    "sink_operations_csv": _csv_and_back(lambda s, d: writers.enrichment_csv(A.utility_operations(s, d).drop("seq"))),
    "sink_emissions_csv": _csv_and_back(lambda s, d: writers.enrichment_csv(A.utility_emissions(s, d))),
    "sink_impacts_csv": _csv_and_back(lambda s, d: writers.enrichment_csv(impacts(s, d))),
    "sink_json_cases": _json_cases,
    "schema_store_case": _checked("rate_cases", _unkempt_cases, ["docket_number", "source", "state", "requested_revenue_change"]),
    "schema_store_utility": _checked("utilities", lambda s, d: A.utilities(s, d).drop("seq").withColumns(
        {"name": F.concat("name", lit(" ")), "state": F.lower("state")}), ["name", "state"]),
    "schema_store_document": _checked("case_documents", lambda s, d: A.case_documents(s, d).withColumn(
        "url", F.concat("url", lit("  "))), ["docket_number", "title", "url"]),
    "job_export": _export,
    "stream_ingest": _stream,
}
