"""Fields of docket web pages, as column expressions over the page text."""

from __future__ import annotations

import html as _html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffworks import fixed_values as V
from tariffworks.functions.columns import found, squeeze, strip

# Entities decoded by plain replacement; "&amp;" is last so that its result is not
# decoded a second time.
COMMON_ENTITIES = [
    ("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&middot;", "\u00b7"), ("&copy;", "\u00a9"), ("&amp;", "&"),
]
_OTHER_ENTITY = (
    "&(?!" + "|".join(e[1:] for e, _ in COMMON_ENTITIES) + ")[#a-zA-Z]"
)
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# The standard table of names; those that count without a semicolon, the longest first.
_NAMES = json.dumps(html5)
_OPEN_NAMES = "^&(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: -len(n))) + ")"
# Numbers that do not stand for their own character.
_ODD_NUMBERS = json.dumps({str(n): _html.unescape(f"&#{n};") for n in range(160) if _html.unescape(f"&#{n};") != chr(n)})


def _table(text: str) -> Column:
    """A map as one constant."""
    return F.from_json(F.lit(text), "map<string,string>")


def _number(reference: Column) -> Column:
    """Character of a numeric reference."""
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    hexadecimal = reference.rlike("^&#[xX]")
    short = F.length(digits) <= 8
    value = F.coalesce(F.when(short & hexadecimal, F.conv(digits, 16, 10).try_cast("bigint"))
                       .when(short, digits.try_cast("bigint")), F.when(digits == "", F.lit(0)).otherwise(F.lit(0x110000)))

    def character(n: Column) -> Column:
        nothing = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        own = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return (
            F.when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .when(nothing, F.lit("")).otherwise(F.coalesce(F.try_element_at(_table(_ODD_NUMBERS), n.cast("string")), own))
        )

    return F.transform(F.array(value), character)[0]


def _name(reference: Column) -> Column:
    """Characters of a named reference: the whole name, else its longest beginning that is one."""
    def begun(start: Column) -> Column:
        return F.when(start == "", reference).otherwise(
            F.concat(F.try_element_at(_table(_NAMES), start), F.substr(reference, F.length(start) + 2)))

    rest = F.transform(F.array(F.regexp_extract(reference, _OPEN_NAMES, 1)), begun)[0]
    return F.coalesce(F.try_element_at(_table(_NAMES), F.substr(reference, F.lit(2))), rest)


def _unescape_all(text: Column) -> Column:
    decoded = F.transform(
        F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)),
        lambda r: F.when(r.startswith("&#"), _number(r)).otherwise(_name(r)))
    pieces = F.zip_with(F.split(text, _REFERENCE, -1), decoded,
                        lambda piece, char: F.concat(piece, F.coalesce(char, F.lit(""))))
    return F.array_join(pieces, "")


def unescape_common(text: Column) -> Column:
    for entity, char in COMMON_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def unescape(text: Column) -> Column:
    """Text with all character references decoded, by the rules of the standard library.

    Texts with common ones only take plain replacements.
    """
    other = F.coalesce(text.rlike(_OTHER_ENTITY), F.lit(False))
    return F.when(other, _unescape_all(text)).otherwise(unescape_common(text))


def unescape_each(texts: Column) -> Column:
    """:func:`unescape` for every element of an array, as one text with a separator."""
    joined = unescape(F.array_join(texts, "\u0001"))
    return F.when(F.size(texts) > 0, F.split(joined, "\u0001")).otherwise(texts)


def strip_tags(text: Column, by: str = "") -> Column:
    return F.regexp_replace(text, r"<[^>]+>", by)


def strip_html(text: Column) -> Column:
    """Text without tags and references, white space squeezed; null if nothing is left."""
    return F.nullif(squeeze(unescape(strip_tags(text))), F.lit(""))


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


# --- tables -------------------------------------------------------------------

def table_rows(page: Column) -> Column:
    return _all(page, r"(?s)<tr[^>]*>(.*?)</tr>")


def table_cells(row: Column) -> Column:
    return _all(row, r"(?s)<td[^>]*>(.*?)</td>")


def clean_cell(cell: Column) -> Column:
    return strip(F.replace(strip(strip_tags(cell)), F.lit("&nbsp;"), F.lit("")))


DETAIL_LINK = r"""(?i)<a[^>]+href=["']?docket\.asp\?DocketID=(\d+)"""


def detail_id(cells: Column) -> Column:
    """Number in the first link to a docket page among the first three cells."""
    ids = F.transform(F.slice(cells, 1, 3), lambda x: found(x, DETAIL_LINK))
    return F.try_element_at(F.array_compact(ids), F.lit(1))


def _longest(texts: Column) -> Column:
    """Longest text, the earlier one of equals."""
    longer = lambda best, x: F.when(
        best.isNull() | (F.length(x) > F.length(best)), x
    ).otherwise(best)
    return F.aggregate(texts, F.lit(None).cast("string"), longer)


BEST_TEXT_WORDS = r"(?i)(revenue|increase|decrease|\$|million|rate\s+change|rate\s+base)"


def best_text(page: Column, financial: str = BEST_TEXT_WORDS) -> Column:
    """Longest table cell that speaks of money, else the longest wordy cell."""
    texts = F.transform(
        table_cells(page),
        lambda x: F.replace(
            F.replace(squeeze(strip_tags(x, " ")), F.lit("&nbsp;"), F.lit(" ")),
            F.lit("&amp;"), F.lit("&"),
        ),
    )
    wordy = F.filter(texts, lambda x: (F.length(x) > 30) & ~x.rlike(r"^[\d/\-\s]+$"))
    return F.coalesce(_longest(F.filter(wordy, lambda x: x.rlike(financial))), _longest(wordy))


# --- labelled values, titles, companies -----------------------------------------

def label_value(page: Column, label: str) -> Column:
    """Text of the ``div`` that follows a labelled one, '' if there is none."""
    raw = F.regexp_extract(page, rf"(?s){label}\s*</div>\s*<div[^>]*>\s*(.*?)\s*</div>", 1)
    return strip(strip_tags(raw))


FILING_LINK = r"/Case/FilingDisplay/\d+"


def raw_titles(page: Column, link: str = FILING_LINK) -> Column:
    """Texts of the links whose address matches, as they stand in the page."""
    return F.transform(_all(page, rf'<a[^>]*href="{link}"[^>]*>([^<]+)</a>'), strip)


def titles(texts: Column) -> Column:
    """Decoded link texts longer than five characters."""
    return F.filter(unescape_each(texts), lambda x: F.length(x) > 5)


def best_title(texts: Column) -> Column:
    """First title with a dollar sign, else the first that speaks of money."""
    first = lambda cond: F.try_element_at(F.filter(texts, cond), F.lit(1))
    return F.coalesce(
        first(lambda x: x.contains("$")), first(lambda x: x.rlike(V.FINANCIAL_WORDS))
    )


def raw_companies(page: Column) -> Column:
    """What names companies on a case page, as it stands there.

    A struct of the names in the section, the name in the case style and the
    names in link labels.
    """
    section = F.regexp_extract(
        page, r"(?s)Subject Companies(.*?)(?:Style of Case|Assigned Judge)", 1
    )
    listed = _all(section, r'(?:title="View"[^>]*>|>)\s*([A-Z][^<(]{3,60}?)\s*(?:<|\()')
    style = strip(found(
        page,
        r"(?:Application|Request|Tariff[s]?)[^<]*?of\s+([A-Z][^<,]{5,60}?)(?:,|\s+for|\s+d/b/a)",
    ))
    labels = _all(page, r'aria-label="[^"]*relationships for ([^"]+)"')
    return F.struct(
        F.transform(listed, strip).alias("listed"), style.alias("style"), labels.alias("labels")
    )


def companies(raw: Column) -> Column:
    """Company names: the section, else the case style, then link labels."""
    listed = F.filter(unescape_each(raw["listed"]), lambda x: F.length(x) > 3)
    listed = F.transform(listed, lambda x: strip(F.coalesce(found(x, r"d/b/a\s+(.+)"), x)))
    first = F.when(F.size(listed) > 0, listed).otherwise(
        F.array_compact(F.array(raw["style"]))
    )
    labels = unescape_each(raw["labels"])
    return F.concat(first, F.array_except(labels, first))


def earliest_date(page: Column) -> Column:
    dates = F.array_distinct(_all(page, r"(\d{1,2}/\d{1,2}/\d{4})"))
    iso = lambda x: F.regexp_replace(x, r"(\d+)/(\d+)/(\d+)", "$3-$1-$2")
    return F.array_min(F.transform(dates, lambda x: iso(x).try_cast("date")))


def div_title(page: Column) -> Column:
    raw = F.regexp_extract(page, r'(?s)<div\s+id="dockTitle">\s*(.*?)\s*</div>', 1)
    return F.nullif(strip(strip_tags(strip(raw))), F.lit(""))


def link_ids(page: Column, link: str = r"/search/facts-docket/\?docketId=") -> Column:
    return F.transform(_all(page, rf"{link}(\d+)"), lambda x: x.cast("bigint"))


def labelled_field(page: Column, label: str, value: str = r"([^<]+)") -> Column:
    """Value after ``Label: </tag>``."""
    return strip(found(page, rf"(?i)(?:{label})\s*[:=]\s*</[^>]+>\s*{value}"))


#: Labels of :func:`labelled_pieces`: the first two letters, and the rest.
_LABELS = [("fi", r"l(?:ed\s*By|er|ing\s*Date)"), ("in", "dustry"), ("st", "atus"), ("ca", "tegory"), ("de", "scription")]
_FIRST, _SECOND = ("".join(sorted({x for two, _ in _LABELS for x in (two[i], two[i].upper())})) for i in (0, 1))
_LABELLED = (rf"[{_FIRST}][{_SECOND}](?<=(?=((?i:" + "|".join(two + rest for two, rest in _LABELS)
             + r")\s*[:=]\s*</[^>]+>\s*[^<]+))[a-zA-Z]{2})")


def labelled_pieces(page: Column) -> Column:
    """The labels of a proceeding page with their values, in one text.

    :func:`labelled_field` finds the same in it as in the page: every place where it could match is
    the start of a piece, pieces may overlap, and none can match beyond its end, since the next one
    follows a ``<`` and starts with a letter.  Two letters are tested before a label is tried.
    """
    return F.array_join(_all(page, _LABELLED), "<")


def docket_scan(page: Column, pattern: str) -> Column:
    return F.array_distinct(_all(page, f"({pattern})"))


# --- docket references with their surroundings ------------------------------------

#: Matches whose places are added up at once.
_BLOCK = 256


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.transform(F.array(value), body)[0]


def _blocks(items: Column) -> Column:
    last = F.floor((F.size(items) - 1) / _BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(items, b * _BLOCK + 1, F.lit(_BLOCK)))


def _running(steps: Column, base: Column) -> Column:
    """Start of each step (gap, size, value) behind a base; the steps are few."""
    start = F.struct(F.array().cast("array<struct<value:string,start:int,size:int>>").alias("out"), base.alias("at"))

    def place(acc: Column, m: Column) -> Column:
        item = F.struct(m["value"].alias("value"), (acc["at"] + m["gap"]).alias("start"), m["size"].alias("size"))
        return F.struct(F.array_append(acc["out"], item).alias("out"), (acc["at"] + m["gap"] + m["size"]).alias("at"))

    return F.aggregate(steps, start, place, lambda acc: acc["out"])


def matches_with_place(page: Column, pattern: str, group: int = 1) -> Column:
    """Array of (value, start, length) of all matches; start counts from 1.

    The pieces between matches and the matches themselves give each place as a
    running sum of lengths: of whole blocks first, then inside each block, so
    that a page with very many matches takes no longer per match.
    """
    # Zipped first: an array named inside a lambda would be made again per element.
    zipped = F.arrays_zip(
        _all(page, pattern, 0).alias("whole"), F.split(page, pattern).alias("piece")
    )
    steps = F.transform(
        F.filter(zipped, lambda m: m["whole"].isNotNull()),
        lambda m: F.struct(
            F.regexp_extract(m["whole"], pattern, group).alias("value"),
            F.length(m["piece"]).alias("gap"),
            F.length(m["whole"]).alias("size"),
        ),
    )

    def placed(steps: Column) -> Column:
        def in_blocks(blocks: Column) -> Column:
            whole = F.transform(blocks, lambda b: F.struct(
                F.lit("").alias("value"), F.lit(0).alias("gap"),
                F.aggregate(b, F.lit(0), lambda acc, m: acc + m["gap"] + m["size"]).alias("size")))
            return F.flatten(F.zip_with(blocks, _running(whole, F.lit(1)), lambda b, w: _running(b, w["start"])))

        return _let(_blocks(steps), in_blocks)

    return _let(steps, placed)


def with_surroundings(page: Column, matches: Column, reach: int = 200) -> Column:
    """The matches (value, start, size) with the text around each, tags replaced by blanks.

    A block of matches is cut out of the page first and each match out of its block, since finding a
    place in a text means reading it from the start.
    """
    def low(m: Column) -> Column:
        return F.greatest(m["start"] - reach, F.lit(1))

    def cut(block: Column) -> Column:
        first, last = F.get(block, F.lit(0)), F.element_at(block, -1)
        text = F.substring(page, low(first), last["start"] + last["size"] + reach - low(first))
        return _let(F.struct(text.alias("text"), low(first).alias("low")), lambda b: F.transform(block, lambda m: F.struct(
            m["value"].alias("value"), m["start"].alias("start"), m["size"].alias("size"),
            strip(strip_tags(F.substring(b["text"], low(m) - b["low"] + 1, m["start"] + m["size"] + reach - low(m)), " ")).alias("around"))))

    return _let(matches, lambda all_of: F.flatten(F.transform(F.filter(_blocks(all_of), lambda b: F.size(b) > 0), cut)))


BRACKET_REF = r"\[(\d{2}-\d{2}-\d{2}(?:[A-Z]{2}\d{2})?)\]"
LINK_REF = r"(?s)<a[^>]*>[^<]*?(\d{2}-\d{2}-\d{2}(?:[A-Z]{2}\d{2})?)[^<]*?</a>"
LISTED_REF = r'<font[^>]*color="#008000"[^>]*>(\d{2}-\d{2}-\d{2}(?:[A-Z]{2}\d{2})?)</font>'
DOCUMENT_LINK = r'<a[^>]*href="[^"]*\?OpenDocument[^"]*"[^>]*>([^<]+)</a>'


def title_after(page: Column, docket: Column) -> Column:
    """Text of the first document link within 1,000 characters of a docket number, as it stands there."""
    after = F.substring(page, F.instr(page, docket), F.lit(1000))
    return strip(F.regexp_extract(after, DOCUMENT_LINK, 1))
