"""Page texts composed from domain tables, so that the text sources can be checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BREAK = "\\\\\n\\\\\n"


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def search_pages(listings: DataFrame) -> DataFrame:
    """A page per listing, with its card; a listing without a first line has a page without a card."""
    c = F.col
    price = F.format_number(F.coalesce("sale_price", "list_price"), 0)
    badge = F.when(c("status") == "Active", "New Listing").otherwise(c("status"))
    card = _text(
        "[![Thumb](https://example.com/a.jpg)\n$ ", price, " ", badge, BREAK,
        "**", c("address"), "** **", c("city"), ", ", c("state"), " ", c("zip"), "**", BREAK,
        c("beds"), " Beds", BREAK, c("beds"), " Baths", BREAK, F.format_number("sqft", 0), " sqft", BREAK,
        "Brought to you by ", c("listing_office"), "](https://example.com/listings/", c("detail_url"), ")\n")
    counters = _text(c("enrichment_attempts"), " of ", c("year_built"), " pages, ", F.format_number("sqft", 0), " Results\n")
    return listings.select(
        c("mls_number").alias("page_id"), F.concat(counters, F.coalesce(card, F.lit(""))).alias("text"))


def detail_pages(listings: DataFrame) -> DataFrame:
    c = F.col
    blank = F.lit("")
    q = lambda name, value: _text(name, ':"', F.coalesce(value.cast("string"), blank), '",')
    script = F.concat(
        q("list_agent_full_name", blank), q("list_agent_full_name", c("listing_agent")),
        q("list_agent_email", c("listing_agent_email")), q("list_office_name", c("listing_office")),
        q("buyer_agent_full_name", c("buyer_agent")),
        q("buyer_office_name", _text(c("buyer_office"), "\\u002FNorth")),
        q("close_price", c("sale_price")), q("list_price", c("list_price")),
        q("close_date", _text(c("close_date"), "T00:00:00")), q("listing_id", c("mls_number")),
        q("mls_status", c("status")), _text("days_on_market:", F.coalesce(c("days_on_market"), F.lit(0)), ","),
        q("lot_size_square_feet", _text(F.coalesce(c("lot_sqft"), F.lit(0)), ".6")),
        _text('public_remarks:"Say \\"', c("description"), '\\" twice",'))
    html = _text(
        '<html><head><meta property="og:image" content="https://example.com/', c("mls_number"),
        '.jpg"></head><body><script>var x=1;</script><script>window.__DATA__={', script, "}</script></body></html>")
    return listings.select("detail_url", html.alias("html"))


def directory_pages(profiles: DataFrame, towns: DataFrame) -> DataFrame:
    """One page per profile and town."""
    c = F.col
    team = F.when(c("profile_type") == "team", _text("TEAM", BREAK)).otherwise("")
    office = F.coalesce(c("office_name"), F.lit(""))
    word = F.when(c("profile_type") == "team", "team sales").otherwise("sales")
    recent = F.when(
        c("sales_last_12_months").isNotNull(),
        _text(F.format_number("sales_last_12_months", 0), word, " last 12 months"),
    ).otherwise("No sales last 12 months")
    card = _text(
        "# Agents\n[![](https://img.example.com/a.jpg)", BREAK, team, "5.0(36)", BREAK,
        "**", c("profile_name"), "** ", office, BREAK, "$15K - $8.4Mprice range", BREAK, recent, BREAK,
        F.format_number("local_sales_count", 0), word, " in ", F.translate("town", "_0123456789", " ABCDEFGHIJ"),
        "](", c("profile_url"), ")\n- Page 1 of 25\n")
    return profiles.join(towns, "profile_url").select(
        _text(c("profile_url"), "|", c("town")).alias("page_id"),
        F.translate("town", "_0123456789", " ABCDEFGHIJ").alias("town"), card.alias("text"))


def sold_lines(sales: DataFrame) -> DataFrame:
    """Sold lines of profiles, position by order and line."""
    c = F.col
    day = F.concat_ws("/", F.month("sale_date"), F.dayofmonth("sale_date"), F.year("sale_date"))
    line = _text(
        c("address"), "  ", F.lit("York"), ", ", c("state"), " ", c("zip"), " Sold date: ", day,
        " Closing price: $", F.format_number("sale_price", 0), " Represented: ", F.initcap("represented_side"))
    return sales.select(
        "profile_url", F.struct("l_orderkey", "flag", "sale_price").alias("position"),
        _text("https://example.com/homedetails/", c("l_orderkey")).alias("href"), line.alias("text"))


def sale_pages(listings: DataFrame) -> DataFrame:
    """Sale pages that name agents in the text, or only in structured data."""
    c = F.col
    named = c("data_source") == "feed_a"
    text = _text(
        "Welcome\nListed by ", c("listing_agent"), " • ", c("listing_office"), "\nBought with ",
        c("buyer_agent"), " • ", c("buyer_office"), "\n")
    data = _text(
        '<script type="application/ld+json">{"@type":["RealEstateListing"],"agent":{"name":"',
        c("listing_agent"), '"},"broker":"', c("listing_office"), '"}</script>')
    return listings.select(
        "detail_url", F.when(named, F.coalesce(text, F.lit("Welcome"))).otherwise("Welcome").alias("text"),
        F.coalesce(data, F.lit("<p></p>")).alias("html"))
