"""Search-page text to listing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gableboard.functions.keys import city_state_zip
from gableboard.functions.names import groups
from gableboard.functions.numbers import digits
from gableboard.functions.text import page_position, result_count

# Text format of a search-result card. Groups: price, badge, address,
# place, beds, baths, square feet, office, link.
_BREAK = r"\\\\\s*\\\\\s*"
CARD = (
    r"\$\s*([\d,]+)\s*({badge})" + _BREAK
    + r"\*\*([^*]+)\*\*\s+\*\*([^*]+)\*\*" + _BREAK
    + r"(\d+)\s+Beds?" + _BREAK
    + r"(\d+)\s+Baths?" + _BREAK
    + r"([\d,]+)\s+sqft" + _BREAK
    + r"Brought to you by\s+([^\]]+?)\]"
    + r"\((https?://[^)\s/]+/listings/[^)]+)\)"
)
BADGES = {"Closed": "Closed", "Active": "Active|New Listing|Pending"}


def cards(pages: DataFrame, text: str = "text", status: str = "Closed") -> DataFrame:
    """One row per card, with the page's own columns and the position on the page.

    The page is scanned once; the groups are then read from the card's text. On closed
    pages the price is the sale price, otherwise the list price.
    """
    pattern = CARD.replace("{badge}", BADGES["Closed" if status == "Closed" else "Active"])
    keep = [c for c in pages.columns if c != text]
    found = pages.select(*keep, F.posexplode(F.regexp_extract_all(text, F.lit(pattern), 0)).alias("position", "_card"))
    found = found.withColumn("_g", groups(F.col("_card"), pattern, 9))
    group = lambda i: F.trim(F.col("_g")[i - 1])
    price = digits(group(1))
    nothing = F.lit(None).cast("long")
    place = city_state_zip(group(4))
    return found.select(
        *keep, "position",
        F.when(group(2) == "New Listing", F.lit("Active")).otherwise(group(2)).alias("status"),
        (price if status == "Closed" else nothing).alias("sale_price"),
        (nothing if status == "Closed" else price).alias("list_price"),
        group(3).alias("address"),
        place["city"].alias("city"), place["state"].alias("state"), place["zip"].alias("zip"),
        place["well_formed"].alias("place_ok"),
        group(5).try_cast("int").alias("beds"), group(6).try_cast("double").alias("baths"),
        digits(group(7)).try_cast("int").alias("sqft"),
        group(8).alias("listing_office"), group(9).alias("detail_url"))


def counters(pages: DataFrame, text: str = "text") -> DataFrame:
    """Page position (`n of m`) and result total of every page."""
    return pages.withColumns({
        "page_position": page_position(text), "results": result_count(text)})
