"""Directory-page text, profile pages and profile JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.constants import TOWNS
from gableboard.functions.keys import computed, match_key, split_address, with_address
from gableboard.functions.names import blank_to_null, groups, in_towns, let, squeeze
from gableboard.functions.numbers import digits
from gableboard.functions.text import extract, office_guess, page_position, profile_counters, us_date
from gableboard.operators.filters import passes_cutoff
from gableboard.operators.grouping import first_wins

# Text formats of directory cards.
PROFILE_LINK = r"\[([\s\S]*?)\]\((https?://[^)\s/]+/profile/[^)]+)\)"
IMAGE = r"!\[[^\]]*\]\([^)]*\)"
BOLD = r"\*\*(.+?)\*\*"
CARD_START = r"(?:TEAM\s+)?\d\.\d\(\d+\)"
STATS_START = r"(?i)\$[\dKMB,.]|(?:\d[\d,]*\s*(?:team\s+)?(?:sales?|sale)\b)|No (?:recent|sales)"
LOCAL_SALES = r"(?i)([\d,]+)\s+(?:team\s+)?sales?\s+in\s+([A-Za-z ]+)"
YEAR_SALES = r"(?i)([\d,]+)\s+(?:team\s+)?sales?\s+last 12 months"
SOLD = (
    r"(?i)^(.+?)\s+Sold date:\s*(\d{1,2}/\d{1,2}/\d{4})"
    r"\s+Closing price:\s*\$([\d,]+)\s+Represented:\s*(Buyer|Seller)"
)


def _cut_at(text: Column, pattern: str) -> Column:
    """Text before the first match, or all of it."""
    return F.regexp_replace(text, r"(?s)(?:" + pattern + r").*", "")


def card_text(raw: Column) -> Column:
    """Card without images, escapes and what stands before its rating or bold name."""
    plain = F.replace(F.regexp_replace(raw, IMAGE, ""), F.lit("\\"), F.lit(" "))
    start = r"(?s)^(?:(?!" + CARD_START + r"|\*\*[^\n]+?\*\*).)*+(?=.)"
    return let(plain, lambda p: F.when(
        F.rlike(p, F.lit(CARD_START)), F.regexp_replace(p, start, "")).otherwise(p))


def clean_card(text: Column) -> Column:
    """`card_text` on one line, with a space between a count and its word."""
    line = squeeze(F.regexp_replace(text, BOLD, "$1"))
    return F.trim(F.regexp_replace(line, r"(\d)((?:team\s+)?sales?\b)", "$1 $2"))


def card_identity(text: Column) -> Column:
    """struct(name, office, kind) of `card_text`: bold name, then text up to a figure.

    No office makes a brokerage, the word TEAM a team.
    """
    team = F.rlike(F.substring(text, 1, 50), F.lit(r"(?i)\bTEAM\b"))
    # Name and the rest of the card; the name may not span lines.
    split_at = groups(text, r"(?s)^.*?\*\*([^\n]+?)\*\*(.*)$", 2)

    def identity(g: Column) -> Column:
        rest = F.regexp_replace(squeeze(g[1]), r"^\d\.\d\(\d+\)\s*", "")
        office = blank_to_null(F.trim(_cut_at(rest, STATS_START)))
        return let(office, lambda o: F.struct(
            F.trim(g[0]).alias("name"), o.alias("office"),
            F.when(g.isNull(), "individual").when(team, "team").when(o.isNull(), "brokerage")
            .otherwise("individual").alias("kind")))

    return let(split_at, identity)


def cards(pages: DataFrame, text: str = "text", town: str = "town", page: str = "page_id") -> DataFrame:
    """Cards of the page's own town with local sales; the first card per page and profile.

    `town` names the column with the town that was asked for.
    """
    found = pages.select(page, town, F.posexplode(F.regexp_extract_all(text, F.lit(PROFILE_LINK), 0)).alias("position", "_link"))
    found = found.withColumn("_g", groups(F.col("_link"), PROFILE_LINK, 2)).select(
        page, town, "position", F.col("_g")[0].alias("_raw"), F.col("_g")[1].alias("profile_url"))
    rows = found.withColumn("_card", card_text(F.col("_raw"))).withColumns({
        "raw_card_text": clean_card(F.col("_card")), "_who": card_identity(F.col("_card"))})
    rows = rows.withColumns({
        "local_sales_count": digits(extract("raw_card_text", LOCAL_SALES, 1)).try_cast("int"),
        "_town": F.lower(F.trim(extract("raw_card_text", LOCAL_SALES, 2))),
        "sales_last_12_months": digits(extract("raw_card_text", YEAR_SALES, 1)).try_cast("int"),
    })
    # Name, office and kind come from the page's last card of the profile that has text.
    shown = rows.filter(F.col("raw_card_text") != "")
    last = shown.groupBy(page, "profile_url").agg(F.max_by("_who", "position").alias("_last"))
    wanted = shown.filter((F.col("_town") == F.lower(F.trim(town))) & (F.col("local_sales_count") > 0))
    first = first_wins(wanted, [page, "profile_url"], ["position"])
    return first.join(last, [page, "profile_url"]).select(
        page, town, "position", "profile_url", "local_sales_count", "sales_last_12_months",
        "raw_card_text", F.col("_last.name").alias("profile_name"),
        F.col("_last.office").alias("office_name"), F.col("_last.kind").alias("profile_type"))


def counters(pages: DataFrame, text: str = "text") -> DataFrame:
    return pages.withColumn("page_position", page_position(text, worded=True))


def sold_rows(links: DataFrame, *, cutoff, towns: tuple[str, ...] = TOWNS, text: str = "text",
              href: str = "href", profile: str = "profile_url", position: str = "position") -> DataFrame:
    """Sold lines of profiles in listed towns; the first of each sale and side per profile."""
    keep = [c for c in links.columns if c not in (text, href)]
    parsed = lambda g: F.struct(
        split_address(F.trim(g[0]), towns).alias("a"), us_date(g[1]).alias("sale_date"),
        digits(g[2]).alias("sale_price"), F.lower(g[3]).alias("represented_side"))
    lines = links.filter(F.contains(href, F.lit("/homedetails/")))
    # A line is parsed once: filters below read the exploded value, not the parsing.
    found = lines.select(*keep, F.col(href).alias("source_url"), F.explode(F.array(
        let(groups(squeeze(F.col(text)), SOLD + ".*$", 4), parsed))).alias("_p"))
    rows = found.filter(F.col("_p.a").isNotNull()).select(
        *keep, "source_url", F.col("_p.a.street").alias("address"), F.col("_p.a.city").alias("city"),
        F.col("_p.a.state").alias("state"), F.col("_p.a.zip").alias("zip"), "_p.sale_date",
        "_p.sale_price", "_p.represented_side")
    rows = rows.filter(passes_cutoff("sale_date", cutoff) & in_towns(F.trim("city"), towns))
    rows = computed(with_address(rows), transaction_match_key=match_key(
        "normalized_address_hash", "sale_date", "sale_price"))
    return first_wins(rows, [profile, "transaction_match_key", "represented_side"], [position])


def member_links(links: DataFrame, text: str = "text", href: str = "href",
                 profile: str = "profile_url", position: str = "position") -> DataFrame:
    """Members a team page links to: other profiles, the first link of each."""
    other = F.contains(href, F.lit("/profile/")) & (F.col(href) != F.col(profile))
    rows = links.filter(other).select(
        F.col(profile).alias("team_profile_url"), F.col(href).alias("member_profile_url"),
        blank_to_null(squeeze(F.col(text))).alias("member_name"), position)
    return first_wins(rows, ["team_profile_url", "member_profile_url"], [position])


def profile_page(pages: DataFrame, body: str = "body", name: str = "profile_name") -> DataFrame:
    """Office guess and counters of a profile page's text."""
    return pages.withColumn("office_name", office_guess(body, name)).select("*", *profile_counters(body))


PROFILE_JSON = """
    agent string, office string, screenName string, forSaleCount int,
    stats struct<countAllTime: int, countLastYear: int, averageValueThreeYear: bigint,
                 priceRangeThreeYearMin: bigint, priceRangeThreeYearMax: bigint>,
    soldRows array<struct<zpid: string, fullAddressText: string, cityState: string,
        closingPrice: string, attributes: array<struct<label: string, value: string>>,
        saleCardData: struct<soldDuration: string, representedList: array<string>>>>,
    error string
"""


def profile_json(rows: DataFrame, column: str = "value") -> DataFrame:
    """Profile returns parsed; `outcome` is `error` for failures and broken JSON."""
    keep = [c for c in rows.columns if c != column]
    d = rows.select(*keep, F.from_json(column, PROFILE_JSON).alias("d"))
    failed = F.col("d.error").isNotNull() | (F.col("d.stats").isNull() & F.col("d.soldRows").isNull()
                                             & F.col("d.agent").isNull())
    return d.select(
        *keep, F.when(failed, "error").otherwise("success").alias("outcome"),
        F.col("d.error").alias("last_error"),
        F.col("d.stats.countAllTime").alias("total_sales"),
        F.col("d.stats.countLastYear").alias("sales_last_12_months"),
        F.col("d.stats.averageValueThreeYear").alias("average_price"),
        F.col("d.forSaleCount").alias("for_sale_count"),
        F.col("d.stats.countAllTime").alias("total_sold"),
        F.col("d.stats.averageValueThreeYear").alias("avg_price_3yr"),
        F.col("d.stats.priceRangeThreeYearMin").alias("price_range_min"),
        F.col("d.stats.priceRangeThreeYearMax").alias("price_range_max"),
        F.col("d.screenName").alias("screen_name"), F.col("d.soldRows").alias("sold"))


def profile_json_sold(parsed: DataFrame) -> DataFrame:
    """Sold rows of parsed profile returns; rows without an id go."""
    keep = [c for c in ("profile_url", "observed_at", "seq") if c in parsed.columns]
    rows = parsed.filter(F.col("outcome") == "success").select(
        *keep, F.posexplode("sold").alias("position", "s"))
    label = lambda name: F.try_element_at(
        F.filter("s.attributes", lambda a: a["label"] == name), F.lit(-1))["value"]
    text = lambda c: F.coalesce(c, F.lit(""))
    return rows.filter(text(F.col("s.zpid")) != "").select(
        *keep, "position", F.col("s.zpid").alias("zpid"),
        text(F.col("s.fullAddressText")).alias("address"),
        text(F.col("s.cityState")).alias("city_state"),
        text(F.col("s.saleCardData.soldDuration")).alias("sold_date"),
        digits("s.closingPrice").alias("closing_price"),
        text(F.try_element_at("s.saleCardData.representedList", F.lit(1))).alias("represented"),
        label("bd").alias("beds"), label("ba").alias("baths"))
