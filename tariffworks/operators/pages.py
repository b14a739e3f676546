"""Jobs over a table of web pages (page_id, html)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions import html
from tariffworks.functions.columns import first_word, found, squeeze
from tariffworks.functions.dockets import strip_retention
from tariffworks.functions.rules import has_rate_prefix, is_rate_title
from tariffworks.functions.text import parse_date_state



def _page() -> Column:
    return F.col("html")


def result_rows(pages: DataFrame) -> DataFrame:
    """Rows of docket search results: one row per table row that names a docket."""
    rows = pages.select(
        "page_id", F.posexplode(html.table_rows(_page())).alias("row_no", "row")
    ).withColumn("cells", html.table_cells(F.col("row")))
    clean = rows.filter(F.size("cells") >= 4).withColumn(
        "clean", F.transform("cells", html.clean_cell)
    )
    docket = F.col("clean")[0]
    spaced = F.regexp_replace(docket, r"(U[EGMCW])\s*(\d+)", "$1 $2")
    decision = parse_date_state(F.get("clean", F.lit(4)))
    return clean.filter(docket.rlike(r"^U[EGMCW]\s*\d+")).select(
        "page_id", "row_no",
        F.trim(F.replace(spaced, F.lit("[PDF]"), F.lit(""))).alias("docket_number"),
        strip_retention(F.col("clean")[1]).alias("utility_name"),
        parse_date_state(F.col("clean")[2]).alias("filing_date"),
        decision.alias("decision_date"),
        F.when(decision.isNotNull(), "decided").otherwise("active").alias("status"),
        html.detail_id(F.col("cells")).alias("detail_id"),
    )


def case_fields(pages: DataFrame) -> DataFrame:
    """Labelled fields, companies and titles of case pages."""
    # Values used more than once are columns of their own first; Spark does not
    # merge such a projection with the next, so each page is searched once.
    searched = pages.select(
        "page_id", "html",
        html.label_value(_page(), "Status").alias("status_text"),
        html.raw_titles(_page()).alias("raw_titles"),
    ).withColumn("titles", html.titles(F.col("raw_titles")))
    status_text = F.col("status_text")
    return searched.select(
        "page_id",
        found(_page(), r"Docket Sheet - ([A-Z]{2}-\d{4}-\d{3,5})").alias("docket_number"),
        "status_text",
        parse_date_state(found(status_text, r"\((\d{1,2}/\d{1,2}/\d{4})\)")).alias("decision_date"),
        html.label_value(_page(), "Utility Type").alias("utility_type_text"),
        html.label_value(_page(), "Type of Case").alias("case_type_text"),
        html.label_value(_page(), "Style of Case").alias("style"),
        html.best_title(F.col("titles")).alias("best_title"),
        html.earliest_date(_page()).alias("filing_date"),
    )


def labelled_fields(pages: DataFrame) -> DataFrame:
    """Six labelled fields of a proceeding page."""
    # The page is searched once and each field once in what was found: a chain that names a field
    # several times would search for it as often.
    searched = (pages.select("page_id", html.labelled_pieces(_page()).alias("pieces")))
    pieces = F.col("pieces")
    fields = (searched.select(
        "page_id",
        html.labelled_field(pieces, r"Filed\s*By|Filer").alias("utility_name"),
        F.lower(html.labelled_field(pieces, "Industry")).alias("industry"),
        html.labelled_field(pieces, r"Filing\s*Date", r"(\d{1,2}/\d{1,2}/\d{4})").alias("filed"),
        F.lower(html.labelled_field(pieces, "Status")).alias("status"),
        html.labelled_field(pieces, "Category").alias("category"),
        html.labelled_field(pieces, "Description").alias("description"),
    ))
    status = F.col("status")
    return fields.select(
        "page_id", "utility_name",
        first_word(F.col("industry"), V.TYPE_WORDS_CA, None).alias("utility_type"),
        parse_date_state(F.col("filed")).alias("filing_date"),
        F.when(status.contains("clos") | status.contains("final"), "decided")
        .when(status.contains("active") | status.contains("open"), "active")
        .otherwise(status).alias("status"),
        "category", "description",
    )


def _references(pages: DataFrame) -> DataFrame:
    """References of both kinds with their surroundings; a page is searched and cut in its own row."""
    def placed(pattern: str, kind: int):
        def one(m):
            return F.struct(
                m["value"].alias("docket_number"), F.lit(kind).alias("kind"), m["start"].alias("at"),
                (squeeze(m["around"]) if kind == 0 else m["around"]).alias("around"))
        return F.transform(html.with_surroundings(_page(), html.matches_with_place(_page(), pattern)), one)

    found = F.concat(placed(html.BRACKET_REF, 0), placed(html.LINK_REF, 1))
    # Cut out first, decoded next: decoding names its input more than once.
    cut = pages.select("page_id", F.explode(found).alias("m")).select("page_id", "m.*")
    return cut.select(
        "docket_number", html.unescape(F.col("around")).alias("context"),
        F.struct("page_id", "kind", "at").alias("seq"), "kind")


def page_titles(pages: DataFrame, link: str = html.FILING_LINK) -> DataFrame:
    """Decoded link texts of each page."""
    searched = pages.select("page_id", html.raw_titles(_page(), link).alias("raw"))
    return searched.select("page_id", html.titles(F.col("raw")).alias("titles"))


def page_companies(pages: DataFrame) -> DataFrame:
    """Company names on each page."""
    searched = pages.select("page_id", html.raw_companies(_page()).alias("raw"))
    return searched.select("page_id", html.companies(F.col("raw")).alias("companies"))


def docket_references(pages: DataFrame) -> DataFrame:
    """Best context of each docket referred to on the pages.

    References in brackets compete by the length of their surroundings.  A
    reference in a link counts only if it is the first one of its docket, and a
    later one in brackets has to be longer to replace it.
    """
    month = F.split("docket_number", "-")[1].cast("int")
    every = _references(pages).filter((F.col("kind") == 0) | month.between(1, 12))
    # Lowest seq first: longer text wins, the earlier of equals stays.
    longest = F.max_by(
        F.when(F.col("kind") == 0, F.col("context")),
        F.when(F.col("kind") == 0, F.struct(
            F.length("context"), -F.col("seq.page_id"), -F.col("seq.at")
        )),
    )
    best = every.groupBy("docket_number").agg(
        longest.alias("bracket"),
        F.min_by(F.struct("kind", "context"), "seq").alias("first"),
    )
    link = F.when(F.col("first.kind") == 1, F.col("first.context"))
    longer = F.coalesce(F.length("bracket") > F.length(link), F.lit(False))
    return best.select(
        "docket_number",
        F.when(link.isNull() | longer, F.col("bracket")).otherwise(link).alias("context"),
    )


def listing_titles(pages: DataFrame) -> DataFrame:
    """Title of each listed docket; the last page that has one wins."""
    listed = pages.select(
        "page_id", "html",
        F.explode(F.array_distinct(
            F.regexp_extract_all(_page(), F.lit(html.LISTED_REF), F.lit(1))
        )).alias("docket_number"),
    )
    # Steps of their own, and no filter of the rows: a filter would be moved below the steps and repeat them.
    raw = listed.select("page_id", "docket_number", html.title_after(_page(), F.col("docket_number")).alias("raw"))
    decoded = raw.select("page_id", "docket_number", html.unescape(F.col("raw")).alias("title"))
    long = F.length("title") > 5
    return decoded.groupBy("docket_number").agg(
        F.max_by("title", F.when(long, F.col("page_id"))).alias("title")
    ).filter(F.col("title").isNotNull())


def title_context(references: DataFrame, titles: DataFrame) -> DataFrame:
    """References with a title: of the base docket, else of the full one, else the context."""
    base = F.trim(F.regexp_replace("docket_number", r"[A-Z]{2}\d{2}$", ""))
    by_base = titles.select(F.col("docket_number").alias("base"), F.col("title").alias("t_base"))
    by_full = titles.select("docket_number", F.col("title").alias("t_full"))
    title = F.coalesce(F.nullif("t_base", F.lit("")), F.col("t_full"), F.lit(""))
    return (
        references.withColumn("base", base)
        .join(by_base, "base", "left")
        .join(by_full, "docket_number", "left")
        .select("docket_number", "base", title.alias("title"), "context",
                F.coalesce(F.nullif(title, F.lit("")), F.col("context")).alias("text"))
    )


def div_titles(pages: DataFrame) -> DataFrame:
    """Titles of docket pages that are rate cases."""
    return pages.select("page_id", html.div_title(_page()).alias("title")).filter(
        F.col("title").isNotNull() & is_rate_title(F.col("title"))
    )


def link_ids(pages: DataFrame, link: str = r"/search/facts-docket/\?docketId=") -> DataFrame:
    return pages.select(F.explode(html.link_ids(_page(), link)).alias("id")).distinct()


def docket_scan(pages: DataFrame, pattern: str) -> DataFrame:
    return pages.select(
        "page_id", F.explode(html.docket_scan(_page(), pattern)).alias("docket_number")
    )


def page_gate(pages: DataFrame) -> DataFrame:
    """Pages with flags telling which parsers would read them."""
    docket = found(_page(), r"Docket Sheet - ([A-Z]{2}-\d{4}-\d{3,5})")
    not_found = F.substring(_page(), 1, 1000).contains("Submission not found")
    lower = F.lower(_page())
    return pages.select(
        "page_id",
        F.coalesce(~not_found & has_rate_prefix(docket), F.lit(False)).alias("is_case_sheet"),
        ((F.length(_page()) >= 500) & ~_page().contains("Session State Protection"))
        .alias("is_proceeding"),
        (~(lower.contains("javascript") & (F.length(_page()) < 5000))).alias("is_rendered"),
    )


def merge_scraped_fields(known: DataFrame, scraped: DataFrame, key: str) -> DataFrame:
    """Known records improved by scraped ones.

    Name and type fill gaps; date and status always win; a description wins if
    it is longer.  Pages scraped twice multiply no record: of their values the
    greatest count, and the longest description.
    """
    fields = ["utility_name", "utility_type", "filing_date", "status", "description"]
    longest = F.max_by("description", F.struct(F.length("description"), "description"))
    new = scraped.groupBy(key).agg(
        *[(longest if f == "description" else F.max(f)).alias(f"__{f}") for f in fields])

    def empty(x: Column) -> Column:
        return F.coalesce(x, F.lit("")) == ""

    s = {f: F.col(f"__{f}") for f in fields}
    value = {
        "utility_name": F.when(empty(F.col("utility_name")) & ~empty(s["utility_name"]),
                               s["utility_name"]).otherwise(F.col("utility_name")),
        "utility_type": F.when(empty(F.col("utility_type")) & ~empty(s["utility_type"]),
                               s["utility_type"]).otherwise(F.col("utility_type")),
        "filing_date": F.coalesce(s["filing_date"], F.col("filing_date")),
        "status": F.coalesce(F.nullif(s["status"], F.lit("")), F.col("status")),
        "description": F.when(
            F.length(s["description"]) > F.length(F.coalesce("description", F.lit(""))),
            s["description"],
        ).otherwise(F.col("description")),
    }
    joined = known.join(new, key, "left")
    return joined.select(*[value.get(x, F.col(x)).alias(x) for x in known.columns])


def decision_from_orders(orders: DataFrame, key: str) -> DataFrame:
    """Date of the first final order of a case, else of its latest order."""
    final = F.lower(F.coalesce("order_type", F.lit(""))).contains("final order")
    return orders.groupBy(key).agg(
        F.count_if(final).alias("n_final"),
        F.min_by("order_date", F.when(final, F.col("position"))).alias("final_date"),
        F.max("order_date").alias("latest_date"),
    ).select(
        key,
        F.when(F.col("n_final") > 0, F.col("final_date")).otherwise(F.col("latest_date"))
        .alias("decision_date"),
    )


def case_orders_join(cases: DataFrame, orders: DataFrame, key: str) -> DataFrame:
    """Cases with the decision date their orders give."""
    return cases.drop("decision_date").join(decision_from_orders(orders, key), key, "left")


def anti_new_cases(found_ids: DataFrame, known: DataFrame, key: str = "docket_number") -> DataFrame:
    """Discovered ids that are not known yet."""
    return found_ids.select(key).distinct().join(known.select(key), key, "left_anti")
