"""Work queues for another attempt, and the residential purge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gableboard.constants import RESIDENTIAL_TYPES


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def listings_to_retry(listings: DataFrame, *, limit: int | None = 50,
                      max_attempts: int = 2) -> DataFrame:
    status = F.col("enrichment_status")
    open_ = (status.isNull() | (status == "error")) & (F.col("enrichment_attempts") < max_attempts)
    queue = listings.filter(open_).select("detail_url", "city", "discovered_at")
    return _first(queue.orderBy(F.desc("discovered_at"), F.asc("detail_url")), limit)


def transactions_to_retry(transactions: DataFrame, *, limit: int | None = 200,
                          max_attempts: int = 3, order: str = "mls_number") -> DataFrame:
    status = F.col("enrichment_status")
    again = (status == "error") & (F.col("enrichment_attempts") < max_attempts)
    queue = transactions.filter((status.isNull() | again) & F.col("source_url").isNotNull())
    return _first(queue.select("mls_number", "source_url").orderBy(order), limit)


def _teams_first() -> list:
    return [F.when(F.col("profile_type") == "team", 0).otherwise(1), F.asc("profile_url")]


def profiles_to_retry(profiles: DataFrame, *, limit: int | None = 25,
                      max_attempts: int = 3) -> DataFrame:
    status = F.col("scrape_status")
    again = status.isin("failed", "blocked", "captcha") & (F.col("scrape_attempts") < max_attempts)
    queue = profiles.filter(status.isNull() | again)
    return _first(
        queue.select("profile_url", "profile_type", "profile_name").orderBy(*_teams_first()), limit)


def profiles_to_enrich(profiles: DataFrame, *, limit: int | None = 50,
                       max_attempts: int = 2) -> DataFrame:
    status = F.col("enrichment_status")
    open_ = (status.isNull() | (status == "error")) & (F.col("scrape_attempts") < max_attempts)
    queue = profiles.filter(open_).orderBy(*_teams_first()).select("profile_url", "profile_type")
    return _first(queue, limit)


def purge_preview(transactions: DataFrame, keep=RESIDENTIAL_TYPES) -> DataFrame:
    """One row: what a purge would keep and drop, and whether it is refused."""
    kind = F.col("property_type")
    counts = transactions.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(kind).alias("tagged"),
        F.count(F.when(kind.isin(*keep), 1)).alias("kept"),
    )
    return counts.withColumns({
        "dropped_typed": F.col("tagged") - F.col("kept"),
        "dropped_untyped": F.col("total") - F.col("tagged"),
        "refused": F.col("kept") == 0,
    })


def purge(transactions: DataFrame, keep=RESIDENTIAL_TYPES) -> DataFrame:
    """Rows of the kept types; an untyped row goes. Where nothing would be kept, all rows stay."""
    kept = F.col("property_type").isin(*keep)
    # A scalar of the same plan: nothing runs until the rows are asked for.
    nothing = transactions.agg(F.count_if(kept)).scalar() == 0
    return transactions.filter(kept | nothing)
