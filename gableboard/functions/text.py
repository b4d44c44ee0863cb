"""Escapes, dates, page counters and page status as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from gableboard.constants import NOT_AN_OFFICE, PAGE_RULES
from gableboard.functions.names import blank_to_null, col, let
from gableboard.functions.numbers import digits


def unescape(c: Column | str) -> Column:
    r"""Decode every `\uXXXX`; a pair of surrogates becomes one character.

    Everything else is quoted first, so the JSON reader decodes exactly those escapes.
    """
    source = col(c)
    quoted = F.regexp_replace(source, r'\\(?!u[0-9a-fA-F]{4})|"', r"\\$0")
    decoded = F.from_json(
        F.concat(F.lit('["'), quoted, F.lit('"]')), "array<string>",
        {"allowUnquotedControlChars": "true"})
    return F.when(F.contains(source, F.lit("\\u")), decoded[0]).otherwise(source)


def month_name_date(c: Column | str) -> Column:
    """`June-30-2025`, or a ten-character ISO date; anything else is null."""
    text = col(c)
    iso = F.when(
        (F.length(text) == 10) & (F.substring(text, 5, 1) == "-"), F.try_to_date(text, "yyyy-MM-dd"))
    return F.coalesce(F.try_to_timestamp(text, F.lit("MMMM-d-yyyy")).cast("date"), iso)


def us_date(c: Column | str) -> Column:
    """`6/27/2025`; anything else is null."""
    return F.try_to_timestamp(F.trim(col(c)), F.lit("M/d/yyyy")).cast("date")


def iso_day(c: Column | str) -> Column:
    """First ten characters as a date; anything else is null."""
    return F.try_to_date(F.substring(col(c), 1, 10), "yyyy-MM-dd")


def short_month(c: Column | str) -> Column:
    """`2023-03-09` -> `Mar 2023`; other text as it is; `N/A` for nothing."""
    text = col(c).cast("string")
    return F.when(text.isNull() | (text == "") | (text == "N/A"), F.lit("N/A")).otherwise(
        F.coalesce(F.date_format(iso_day(text), "MMM yyyy"), text))


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Group of the first match, null without a match."""
    return blank_to_null(F.regexp_extract(col(c), pattern, group))


def page_position(c: Column | str, worded: bool = False) -> Column:
    """`2 of 90` (or `Page 2 of 90`) -> struct(page, pages); null without a match."""
    pattern = r"(?i)Page\s+(\d+)\s+of\s+(\d+)" if worded else r"(\d+)\s+of\s+(\d+)"
    page = extract(c, pattern, 1).try_cast("int")
    return F.when(
        page.isNotNull(),
        F.struct(page.alias("page"), extract(c, pattern, 2).try_cast("int").alias("pages")),
    )


def result_count(c: Column | str) -> Column:
    return digits(extract(c, r"([\d,]+)\s+Results"))


def _mentions(haystack: Column, phrases: tuple[str, ...]) -> Column:
    return reduce(or_, [F.contains(haystack, F.lit(p)) for p in phrases])


def page_status(text, url=None, title=None, http_status=None, rules=PAGE_RULES,
                must_contain: str | None = None) -> Column:
    """struct(status, reason) of a page by its wording, then by its HTTP status."""
    parts = [F.lower(col(c)) for c in (text, url, title) if c is not None]

    def verdict(hay: Column) -> Column:
        def label(status: str, reason: Column) -> Column:
            return F.struct(F.lit(status).alias("status"), reason.alias("reason"))

        cases = [(_mentions(hay, phrases), label(status, F.lit(f"{status}_indicators")))
                 for status, phrases in rules]
        if must_contain is not None:
            cases.append((~F.contains(col(text), F.lit(must_contain)),
                          label("blocked", F.lit("no_profile_link"))))
        if http_status is not None:
            code = col(http_status)
            cases.append((code >= 400, label("blocked", F.concat(F.lit("http_"), code.cast("string")))))
        out = F.when(*cases[0])
        for case in cases[1:]:
            out = out.when(*case)
        return out.otherwise(label("ok", F.lit("ok")))

    # The lower-cased text is made once per page, not once per phrase.
    return let(F.concat_ws(" ", *parts), verdict)


_FURNITURE = "(?i)" + "|".join(NOT_AN_OFFICE)


def office_guess(body, name) -> Column:
    """First line, of the seven after the name, that does not look like page furniture."""
    # One pass trims every line and drops the blank ones.
    text = F.trim(F.regexp_replace(col(body), r"\s*\n\s*", "\n"))

    def pick(lines: Column) -> Column:
        return let(F.array_position(lines, F.trim(col(name))), lambda at: _after(lines, at))

    return let(F.split(text, "\n"), pick)


def _after(lines: Column, at: Column) -> Column:
    following = F.slice(lines, (at + 1).cast("int"), F.lit(7))
    office = F.filter(following, lambda x: ~F.rlike(x, F.lit(_FURNITURE)))
    return F.when((at > 0) & (at < F.size(lines)), F.try_element_at(office, F.lit(1)))


PROFILE_COUNTERS = {
    "sales_last_12_months": r"(?i)([\d,]+)\s+Sales last 12 months",
    "total_sales": r"(?i)([\d,]+)\s+Total sales",
    "average_price": r"(?i)\$([\d,]+)\s+Average price",
}
_PRICE_RANGE = r"(?i)(\$[\dKMB,.~-]+\s*-\s*\$?[\dKMB,.]+)\s+Price range"


def profile_counters(body) -> list[Column]:
    """The counters of a profile page as columns."""
    numbers = [digits(extract(body, p)).alias(n) for n, p in PROFILE_COUNTERS.items()]
    return numbers + [F.trim(extract(body, _PRICE_RANGE)).alias("price_range")]
