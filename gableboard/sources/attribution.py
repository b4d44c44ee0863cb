"""Agents named in the text or the structured data of a sale page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.functions.names import blank_to_null
from gableboard.functions.text import extract

# Text formats of attribution lines.
LISTED_BY = r"(?i)Listed\s+by\s+(.+?)(?:\s*[•·]\s*(.+?))?(?:\n|$)"
BOUGHT_WITH = r"(?i)Bought\s+with\s+(.+?)(?:\s*[•·]\s*(.+?))?(?:\n|$)"
COURTESY = r"(?i)Listing\s+(?:provided|courtesy)\s+(?:by|of)\s+(.+?)(?:\n|$)"
LISTING_TYPES = ("RealEstateListing", "Product")
COLUMNS = ("listing_agent", "listing_office", "buyer_agent", "buyer_office")


def _structured(html: Column) -> Column:
    """The first structured-data script of a listing."""
    scripts = F.regexp_extract_all(
        html, F.lit(r"(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    kind = lambda s: F.coalesce(F.get_json_object(s, "$['@type']"), F.lit(""))
    wanted = lambda s: F.exists(
        F.array(*[F.lit(t) for t in LISTING_TYPES]),
        lambda t: (kind(s) == t) | F.contains(kind(s), F.concat(F.lit('"'), t, F.lit('"'))))
    return F.try_element_at(F.filter(scripts, wanted), F.lit(1))


def _named(script: Column, field: str) -> Column:
    """Name inside the field's object, or the field's plain value."""
    value = F.get_json_object(script, f"$.{field}")
    inside = F.get_json_object(script, f"$.{field}.name")
    return F.when(F.startswith(F.trim(value), F.lit("{")), inside).otherwise(value)


def attributed(pages: DataFrame, text: str = "text", html: str | None = None) -> DataFrame:
    """Agents and offices per page: the text lines if they name anyone, else the data."""
    found = lambda pattern, i: blank_to_null(F.trim(extract(text, pattern, i)))
    by_text = {
        "listing_agent": found(LISTED_BY, 1),
        "listing_office": F.coalesce(found(LISTED_BY, 2), found(COURTESY, 1)),
        "buyer_agent": found(BOUGHT_WITH, 1),
        "buyer_office": found(BOUGHT_WITH, 2),
    }
    out = pages.withColumns(by_text)
    if html is None:
        return out
    nothing = F.lit(True)
    for c in COLUMNS:
        nothing = nothing & F.col(c).isNull()
    out = out.withColumn("_ld", F.when(nothing, _structured(F.col(html))))
    return out.withColumns({
        "listing_agent": F.coalesce("listing_agent", _named(F.col("_ld"), "agent")),
        "listing_office": F.coalesce("listing_office", _named(F.col("_ld"), "broker")),
    }).drop("_ld")
