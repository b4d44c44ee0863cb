"""Boards over closed, enriched listings, and their summary figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.constants import HIGH_VALUE, THIN_TOWN
from gableboard.functions.names import present
from gableboard.operators.filters import (
    closed_and_enriched, not_placeholder, role_columns, same_text,
)
from gableboard.operators.grouping import Facet, facet_summary, top_per_group
from gableboard.operators.sides import sides


def listed_or_sold() -> Column:
    return F.coalesce("sale_price", "list_price", F.lit(0))


def side(listings: DataFrame, role: str, *, limit: int | None = 30,
         town: str | None = None) -> DataFrame:
    """Agents of one role by sides, then volume.

    Under a town filter the figures are the town's, while office and towns come from all
    of the agent's sales: both are taken from one scan.
    """
    agent, office = role_columns(role)
    rows = (
        listings.filter(closed_and_enriched() & present(agent) & not_placeholder(agent))
        .select(
            F.col(agent).alias("agent_name"), F.col(office).alias("office"), "city", "close_date",
            listed_or_sold().alias("amount"),
            (same_text("city", town) if town is not None else F.lit(True)).alias("here"),
        )
    )
    here = lambda value: F.when(F.col("here"), value)
    measures = {
        "sides": F.count(here(F.lit(1))),
        "volume": F.sum(here(F.col("amount"))),
        "high_value": F.count(here(F.when(F.col("amount") >= HIGH_VALUE, 1))),
        "most_recent": F.max(here(F.col("close_date"))),
    }
    board = facet_summary(rows, ["agent_name"], measures,
                          {"office": Facet("office", 1), "towns": Facet("city", 3)})
    board = board.filter(F.col("sides") > 0).withColumn("avg_price", F.col("volume") / F.col("sides"))
    return _by_sides(board, "sides", "agent_name", limit)


def _by_sides(board: DataFrame, count: str, name: str, limit: int | None) -> DataFrame:
    ordered = board.orderBy(F.desc(count), F.desc("volume"), F.asc(name))
    return ordered if limit is None else ordered.limit(limit)


def _combined_rows(listings: DataFrame, town: str | None) -> DataFrame:
    return (
        sides(listings, "agent", town).filter(not_placeholder("agent"))
        .withColumnRenamed("agent", "agent_name")
    )


def _combined(rows: DataFrame, keys: list[str]) -> DataFrame:
    price = F.coalesce("sale_price", F.lit(0))
    measures = {
        "total_sides": F.count(F.lit(1)),
        "listing_sides": F.count(F.when(F.col("role") == "listing", 1)),
        "buyer_sides": F.count(F.when(F.col("role") == "buyer", 1)),
        "volume": F.sum(price),
        "most_recent": F.max("close_date"),
    }
    board = facet_summary(rows, keys, measures,
                          {"office": Facet("office", 1), "towns": Facet("city", 3)})
    return board.withColumn("avg_price", F.col("volume") / F.col("total_sides"))


def combined(listings: DataFrame, *, limit: int | None = 30, town: str | None = None) -> DataFrame:
    """Agents by both sides together; under a town filter everything is the town's."""
    board = _combined(_combined_rows(listings, town), ["agent_name"])
    return _by_sides(board, "total_sides", "agent_name", limit)


def combined_by_town(listings: DataFrame, *, n: int = 5) -> DataFrame:
    """`combined` for every town in one job."""
    rows = _combined_rows(listings, None).withColumn("town", F.lower("city"))
    board = _combined(rows.filter(F.col("town").isNotNull()), ["town", "agent_name"])
    order = [F.desc("total_sides"), F.desc("volume"), F.asc("agent_name")]
    return top_per_group(board, ["town"], order, n)


def brokerages(listings: DataFrame, *, limit: int | None = 20, town: str | None = None) -> DataFrame:
    """Offices by both sides, with agent count and top agents; branches stay apart."""
    rows = sides(listings, "office", town).withColumnRenamed("office", "brokerage")
    price = F.coalesce("sale_price", F.lit(0))
    board = facet_summary(
        rows, ["brokerage"], {"sides": F.count(F.lit(1)), "volume": F.sum(price)},
        {"top_agents": Facet("agent", 3)}, distinct={"agent_count": "agent"})
    board = board.withColumn("avg_price", F.col("volume") / F.col("sides"))
    return _by_sides(board, "sides", "brokerage", limit)


def stats(listings: DataFrame, *, all_statuses: bool = False) -> DataFrame:
    """One row of totals over closed listings, or over every status."""
    rows = listings if all_statuses else listings.filter(F.col("status") == "Closed")
    count = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        count(F.coalesce(F.col("enrichment_status") == "success", F.lit(False))).alias("enriched"),
        F.count("listing_agent").alias("has_listing"),
        F.count("buyer_agent").alias("has_buyer"),
        F.min("close_date").alias("date_min"),
        F.max("close_date").alias("date_max"),
        F.sum(F.coalesce("sale_price", F.lit(0))).alias("volume"),
    )


def town_counts(listings: DataFrame, *, thin: int = THIN_TOWN) -> DataFrame:
    """Closed, enriched sales per town, flagged where they are few."""
    counted = (
        listings.filter(closed_and_enriched() & F.col("city").isNotNull())
        .groupBy("city").agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.withColumn("thin", F.col("n") < thin).orderBy(F.desc("n"), F.asc("city"))
