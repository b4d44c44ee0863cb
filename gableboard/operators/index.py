"""Search records of the three sources, and the queries that run over them."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.constants import SEARCH_CAP, TOWN_FILTER_CAP
from gableboard.functions.numbers import money_value
from gableboard.operators import kpis
from gableboard.operators.boards import listed_or_sold
from gableboard.operators.kpis import cutoffs


def agents(transactions: DataFrame, *, today: date | str | None = None) -> DataFrame:
    """Listing agents with a per-town map, totals and 365-day totals.

    Sales without a town count only in the 365-day totals. The office is the one of the
    newest sale in the last town (by name) that has any.
    """
    recent = F.col("sale_date") >= F.lit(cutoffs(today).current)
    rows = transactions.filter(F.col("listing_agent").isNotNull()).select(
        "listing_agent", "city", "listing_office", "sale_date", listed_or_sold().alias("amount"))
    at = F.struct(F.col("sale_date"), F.col("listing_office"))
    cells = rows.groupBy("listing_agent", "city").agg(
        F.count(F.lit(1)).alias("sides"), F.sum("amount").alias("volume"),
        F.max("sale_date").alias("most_recent"),
        F.max_by("listing_office", F.when(F.col("sale_date").isNotNull(), at)).alias("office"),
        F.count(F.when(recent, 1)).alias("r_sides"),
        F.sum(F.when(recent, F.col("amount")).otherwise(0)).alias("r_volume"),
    )
    placed = F.col("city").isNotNull()
    named = placed & (F.col("office") != "")
    entry = F.struct("city", F.struct("sides", "volume").alias("totals"))
    out = cells.groupBy(F.col("listing_agent").alias("name")).agg(
        F.max_by("office", F.when(named, F.col("city"))).alias("office"),
        F.sum(F.when(placed, F.col("sides"))).alias("total_sides"),
        F.sum(F.when(placed, F.col("volume"))).alias("total_volume"),
        F.max(F.when(placed, F.col("most_recent"))).alias("most_recent"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(placed, entry)))).alias("towns"),
        F.sum("r_sides").alias("rolling_sides"),
        F.sum("r_volume").alias("rolling_volume"),
    ).filter(F.col("total_sides") > 0)
    return out.withColumn("avg_price", F.bround(F.col("total_volume") / F.col("total_sides")).cast("long"))


def listing_agents(listings: DataFrame, *, today: date | str | None = None) -> DataFrame:
    """The period KPIs as search records, towns as an array."""
    rows = kpis.agent(listings, today=today)
    return rows.select(
        "name", F.coalesce("office", F.lit("")).alias("office"),
        F.col("all_time_sides").alias("total_sides"), "listing_sides", "buyer_sides",
        F.col("all_time_volume").alias("volume"), "most_recent",
        F.when(F.col("primary_towns").isNotNull(), F.split("primary_towns", ", "))
        .otherwise(F.array().cast("array<string>")).alias("towns"),
        "current_12mo_volume", "current_12mo_sides", "prior_12mo_volume", "prior_12mo_sides",
        "three_yr_volume", "three_yr_sides", "all_time_volume", "all_time_sides")


def distinct_towns(records: DataFrame) -> DataFrame:
    """Towns named in any record's comma list."""
    town = F.trim(F.col("t"))
    return (
        records.select(F.explode(F.split("primary_towns", ",")).alias("t"))
        .select(town.alias("town")).filter(F.col("town") != "").distinct()
    )


def matches(query: str) -> Column:
    """Name or office contains the query, whatever the case."""
    q = query.lower()
    hit = lambda c: F.coalesce(F.contains(F.lower(c), F.lit(q)), F.lit(False))
    return hit("name") | hit("office")


def search(sources: dict[str, DataFrame], query: str, *, limit: int | None = SEARCH_CAP) -> DataFrame:
    """People of all sources that match, one row per name, with their sources.

    The office is the last non-empty one in source order. Queries under two letters find
    nothing.
    """
    tagged = [
        df.select("name", "office").withColumns(
            {"source": F.lit(source), "_order": F.lit(i)})
        for i, (source, df) in enumerate(sources.items())
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rows = rows.filter(matches(query) if len(query) >= 2 else F.lit(False))
    at = F.struct("_order", "name", "office")
    found = rows.groupBy(F.lower(F.coalesce("name", F.lit(""))).alias("key")).agg(
        F.min_by("name", at).alias("name"),
        F.max_by("office", F.when(F.col("office") != "", at)).alias("office"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
        F.min("_order").alias("_order"),
    ).orderBy("_order", "key").drop("_order")
    return found if limit is None else found.limit(limit)


SORTABLE = (
    "name", "office", "agent_count", "current_12mo_volume", "current_12mo_sides",
    "prior_12mo_volume", "prior_12mo_sides", "three_yr_volume", "three_yr_sides",
    "all_time_volume", "all_time_sides", "avg_3yr", "most_recent", "delta",
)


def sorted_board(rows: DataFrame, column: str, *, ascending: bool = False,
                 town: str | None = None, query: str | None = None,
                 town_limit: int | None = TOWN_FILTER_CAP) -> DataFrame:
    """Rows by a chosen column, nulls last; a town filter keeps the first `town_limit` (None: all)."""
    if column not in SORTABLE:
        raise ValueError(f"cannot sort by {column}")
    if town:
        rows = rows.filter(F.contains(F.lower("primary_towns"), F.lit(town.lower())))
    if query and query.strip():
        q = query.strip()
        rows = rows.filter(matches(q) if "office" in rows.columns
                           else F.contains(F.lower("name"), F.lit(q.lower())))
    by = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    rows = rows.orderBy(by, F.asc("name"))
    return rows.limit(town_limit) if town and town_limit is not None else rows


def sorted_cells(rows: DataFrame, cell: str, *, ascending: bool = False, tie: str = "name") -> DataFrame:
    """Rows by a formatted money cell; `N/A` counts as the lowest."""
    value = money_value(cell)
    by = value.asc_nulls_first() if ascending else value.desc_nulls_last()
    return rows.orderBy(by, F.asc(tie))
