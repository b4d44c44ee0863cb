"""Detail-page source and detail returns to listing details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.functions.names import blank_to_null
from gableboard.functions.text import extract, iso_day, unescape

# Field in the page source -> column.
QUOTED = {
    "list_agent_full_name": "listing_agent", "list_agent_mls_id": "listing_agent_id",
    "list_agent_email": "listing_agent_email", "list_office_name": "listing_office",
    "buyer_agent_full_name": "buyer_agent", "buyer_agent_mls_id": "buyer_agent_id",
    "buyer_agent_email": "buyer_agent_email", "buyer_office_name": "buyer_office",
    "listing_id": "mls_number", "property_sub_type": "property_type", "mls_status": "status",
}
PRICES = {"close_price": "sale_price", "list_price": "list_price"}
DATES = {"close_date": "close_date", "listing_contract_date": "list_date"}
NUMBERS = {
    "days_on_market": "days_on_market", "year_built": "year_built",
    "lot_size_square_feet": "lot_sqft",
}
MARKER = "buyer_agent_full_name"
RETURN_SCHEMA = (
    "error string, photo_url string, listing_agent string, listing_agent_id string, "
    "listing_agent_email string, listing_office string, buyer_agent string, "
    "buyer_agent_id string, buyer_agent_email string, buyer_office string, "
    "sale_price bigint, list_price bigint, close_date string, list_date string, "
    "mls_number string, property_type string, status string, days_on_market int, "
    "year_built int, lot_sqft int, description string"
)


def _script(html: Column) -> Column:
    """The first script that carries the listing's data."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script>"), 1)
    return F.try_element_at(F.filter(scripts, lambda s: F.contains(s, F.lit(MARKER))), F.lit(1))


def _rounded(text: Column) -> Column:
    """Nearest whole number, halves upwards."""
    return F.floor(text.try_cast("double") + 0.5).try_cast("int")


def fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """Listing details of every page; `error` is set where no agent was found.

    A field takes its first non-empty quoted value, or its first number, bare or quoted.
    """
    keep = [c for c in pages.columns if c != html]
    meta = r'(?is)<meta\b(?=[^>]*\bproperty="og:image")[^>]*\bcontent="([^"]*)"'
    src = pages.select(
        *keep, F.regexp_extract(html, meta, 1).alias("_photo"), _script(F.col(html)).alias("_js"))
    quoted = lambda f: extract("_js", f + r':"([^"]+)"')
    number = lambda f: extract("_js", f + r':"?(-?\d+(?:\.\d+)?)"?')
    whole = lambda f: extract(quoted(f), r"^\s*([+-]?\d+)").try_cast("long")
    out = {col: quoted(f) for f, col in QUOTED.items()}
    out |= {col: whole(f) for f, col in PRICES.items()}
    out |= {col: iso_day(F.split(quoted(f), "T")[0]) for f, col in DATES.items()}
    out |= {col: _rounded(number(f)) for f, col in NUMBERS.items()}
    out["description"] = extract("_js", r'public_remarks:"((?:[^"\\]|\\.)*+)"')
    out["photo_url"] = blank_to_null(F.col("_photo"))
    parsed = src.select(*keep, *[c.alias(name) for name, c in out.items()])
    texts = [*QUOTED.values(), "description", "photo_url"]
    missing = F.col("listing_agent").isNull() & F.col("buyer_agent").isNull()
    return parsed.withColumn(
        "error", F.when(missing, F.lit("no agent data found"))
    ).withColumns({c: unescape(c) for c in texts})


def returns(rows: DataFrame, column: str = "value") -> DataFrame:
    """Details returned as JSON text: failures and broken JSON go, escapes are decoded."""
    keep = [c for c in rows.columns if c != column]
    parsed = rows.select(*keep, F.from_json(column, RETURN_SCHEMA, {"mode": "PERMISSIVE"}).alias("d"))
    names = [part.split()[0] for part in RETURN_SCHEMA.split(", ")]
    texts = [p.split()[0] for p in RETURN_SCHEMA.split(", ") if p.endswith(" string")]
    # Broken JSON leaves every field null.
    any_field = F.lit(False)
    for n in names:
        any_field = any_field | F.col(f"d.{n}").isNotNull()
    good = parsed.filter(any_field & (F.coalesce("d.error", F.lit("")) == ""))
    out = good.select(*keep, "d.*").drop("error")
    out = out.withColumns({c: unescape(c) for c in texts if c != "error"})
    return out.withColumns({"close_date": iso_day("close_date"), "list_date": iso_day("list_date")})


