"""Live listings: what is on the market, since when, and what came new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from gableboard.constants import STALE_DAYS_ON_MARKET

# Column contracts of the four feeds.
LIVE_COLUMNS = (
    "detail_url", "mls_number", "status", "address", "city", "state", "zip", "list_price",
    "list_date", "days_on_market", "beds", "baths", "sqft", "year_built", "lot_sqft",
    "property_type", "description", "photo_url", "listing_agent", "listing_agent_email",
    "listing_agent_id", "listing_office", "last_seen_at",
)
NEW_COLUMNS = (
    "detail_url", "address", "city", "status", "list_price", "list_date", "beds", "baths",
    "sqft", "listing_agent", "listing_agent_email", "listing_office", "first_snap",
)
STALE_COLUMNS = (
    "detail_url", "address", "city", "status", "list_price", "list_date", "days_on_market",
    "beds", "baths", "sqft", "property_type", "listing_agent", "listing_agent_email",
    "listing_office",
)


def active(listings: DataFrame, *, towns: Sequence[str] | None = None,
           min_days_on_market: int | None = None, include_pending: bool = False) -> DataFrame:
    """Active (and pending) listings, newest list date first."""
    rows = listings.filter(F.col("status").isin("Active", *(["Pending"] if include_pending else [])))
    if towns:
        rows = rows.filter(F.lower("city").isin([t.lower() for t in towns]))
    if min_days_on_market is not None:
        rows = rows.filter(F.col("days_on_market") >= min_days_on_market)
    return rows.select(*LIVE_COLUMNS).orderBy(F.desc("list_date"), F.asc("detail_url"))


def stale(listings: DataFrame, *, min_dom: int = STALE_DAYS_ON_MARKET) -> DataFrame:
    """Active listings at least `min_dom` days on the market, longest first."""
    return (
        listings.filter((F.col("status") == "Active") & (F.col("days_on_market") >= min_dom))
        .select(*STALE_COLUMNS).orderBy(F.desc("days_on_market"), F.asc("detail_url"))
    )


def first_seen(history: DataFrame) -> DataFrame:
    return history.groupBy("detail_url").agg(F.min("snapshot_date").alias("first_snap"))


def new_since(listings: DataFrame, history: DataFrame, since) -> DataFrame:
    """Active or pending listings whose first history row is on or after `since`."""
    fresh = first_seen(history).filter(F.col("first_snap") >= F.lit(since).cast("timestamp"))
    on_market = listings.filter(F.col("status").isin("Active", "Pending"))
    return (
        on_market.join(fresh, "detail_url").select(*NEW_COLUMNS)
        .orderBy(F.asc("first_snap"), F.asc("detail_url"))
    )


def timeline(history: DataFrame, detail_url: str | None = None, *, bucket: str = "month") -> DataFrame:
    """Status and price steps, oldest first, with the time each one ended.

    For one listing, or for all of them. Steps are followed inside (listing, bucket); one
    row per bucket links it to the next, so a listing with very many steps is spread.
    """
    rows = history if detail_url is None else history.filter(F.col("detail_url") == detail_url)
    rows = rows.select("detail_url", "snapshot_date", "seq", "status", "list_price",
                       F.date_trunc(bucket, "snapshot_date").alias("_b"))
    inside = W.partitionBy("detail_url", "_b").orderBy("snapshot_date", "seq")
    heads = rows.groupBy("detail_url", "_b").agg(F.min("snapshot_date").alias("_head"))
    links = heads.select("detail_url", "_b", F.lead("_head").over(
        W.partitionBy("detail_url").orderBy("_b")).alias("_next"))
    stepped = rows.withColumn("_step", F.lead("snapshot_date").over(inside))
    return (
        stepped.join(links, ["detail_url", "_b"], "left")
        .withColumn("valid_to", F.coalesce("_step", "_next")).drop("_step", "_next", "_b")
        .orderBy("detail_url", "snapshot_date", "seq")
    )
