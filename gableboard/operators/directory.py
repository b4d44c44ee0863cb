"""Boards and index over directory profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gableboard.functions.numbers import estimated_volume
from gableboard.operators.grouping import numbered, top_per_group


def _in_town(towns: DataFrame, town: str | None) -> DataFrame:
    """Exact spelling, unlike the listing boards."""
    return towns if town is None else towns.filter(F.col("town") == town)


_PROFILE_FIELDS = (
    "profile_name", "office_name", "profile_type", "sales_last_12_months", "price_range",
    "total_sold", "avg_price_3yr", "for_sale_count",
)


def _town_totals(towns: DataFrame) -> DataFrame:
    """Local sales per profile, so that the profile join meets one row per key."""
    return towns.groupBy("profile_url").agg(
        F.sum("local_sales_count").alias("total_local_sales"),
        F.array_join(F.array_sort(F.collect_set("town")), ",").alias("towns"))


def agents(profiles: DataFrame, towns: DataFrame, *, limit: int | None = 30,
           town: str | None = None) -> DataFrame:
    """Individuals and teams by local sales."""
    people = profiles.filter(F.col("profile_type") != "brokerage").select("profile_url", *_PROFILE_FIELDS)
    board = people.join(_town_totals(_in_town(towns, town)), "profile_url")
    board = board.orderBy(F.desc("total_local_sales"), F.asc("profile_url"))
    return board if limit is None else board.limit(limit)


def agents_by_town(profiles: DataFrame, towns: DataFrame, *, n: int = 10) -> DataFrame:
    people = profiles.filter(F.col("profile_type") != "brokerage").select("profile_url", *_PROFILE_FIELDS)
    rows = people.join(towns.select("profile_url", "town", "local_sales_count"), "profile_url")
    order = [F.desc("local_sales_count"), F.asc("profile_url")]
    return top_per_group(rows, ["town"], order, n)


def brokerages(profiles: DataFrame, towns: DataFrame, *, limit: int | None = 20,
               town: str | None = None, fanout: bool = True) -> DataFrame:
    """Brokerages from their agents and from their own profile, which takes precedence.

    `fanout` counts the 12-month sales (and weighs the average price) of a profile once
    for every town it works in, as the published boards do; without it, once.
    """
    board = _brokerages(profiles, _in_town(towns, town), [], fanout)
    board = board.orderBy(F.desc("total_sales"), F.asc("brokerage"))
    return board if limit is None else board.limit(limit)


def brokerages_by_town(profiles: DataFrame, towns: DataFrame, *, n: int = 5) -> DataFrame:
    board = _brokerages(profiles, towns, ["town"], True)
    return top_per_group(board, ["town"], [F.desc("total_sales"), F.asc("brokerage")], n)


def _brokerages(profiles: DataFrame, towns: DataFrame, keys: list[str], fanout: bool) -> DataFrame:
    per_profile = towns.groupBy("profile_url", *keys).agg(
        F.sum("local_sales_count").alias("local"), F.count(F.lit(1)).alias("appearances"))
    rows = profiles.select(
        "profile_url", "profile_type", "profile_name", "office_name", "sales_last_12_months",
        "avg_price_3yr").join(per_profile, "profile_url")
    times = F.col("appearances") if fanout else F.lit(1)
    priced = F.col("avg_price_3yr") > 0
    # One row per (profile, key) here, so counting rows counts profiles.
    staff = (
        rows.filter(F.col("profile_type").isin("individual", "team") & F.col("office_name").isNotNull())
        .groupBy(*keys, F.col("office_name").alias("brokerage")).agg(
            F.count(F.lit(1)).alias("agent_count"),
            F.sum("local").alias("agent_sales"),
            F.sum(F.coalesce("sales_last_12_months", F.lit(0)) * times).alias("agent_12mo_sales"),
            F.sum(F.when(priced, F.col("avg_price_3yr") * times)).alias("_price"),
            F.sum(F.when(priced, times)).alias("_weight"),
        )
    )
    own = (
        rows.filter(F.col("profile_type") == "brokerage")
        .groupBy(*keys, F.col("profile_name").alias("brokerage")).agg(
            F.sum("local").alias("direct_sales"), F.max("sales_last_12_months").alias("direct_12mo"))
    )
    average = F.try_divide("_price", "_weight").cast("long")
    merged = staff.join(own, [*keys, "brokerage"], "full_outer")
    total = F.coalesce("direct_sales", "agent_sales", F.lit(0))
    average = F.when(average != 0, average)
    return merged.select(
        *keys, "brokerage",
        F.coalesce("agent_count", F.lit(0)).alias("agent_count"),
        F.coalesce("agent_sales", F.lit(0)).alias("agent_sales"),
        F.coalesce("agent_12mo_sales", F.lit(0)).alias("agent_12mo_sales"),
        average.alias("avg_price"),
        "direct_sales",
        F.coalesce("direct_12mo", "agent_12mo_sales", F.lit(0)).alias("sales_12mo"),
        total.alias("total_sales"),
        estimated_volume(total, average).alias("est_volume"),
    )


def stats(profiles: DataFrame, towns: DataFrame) -> DataFrame:
    n = lambda kind: F.count(F.when(F.col("profile_type") == kind, 1))
    kinds = profiles.agg(
        F.count(F.lit(1)).alias("total_profiles"), n("team").alias("teams"),
        n("individual").alias("individuals"), n("brokerage").alias("brokerages"))
    served = towns.agg(F.count_distinct("town")).scalar()
    both = kinds.withColumn("towns_with_data", served)
    return both.withColumn("agents", F.col("individuals") + F.col("teams"))


def sold_pages(sold: DataFrame, page_size: int = 500) -> DataFrame:
    """Sold rows per profile as arrays of at most `page_size`, in order of `seq`.

    Positions come from a range sort over (profile, seq), so a profile with very many
    rows is spread over the sort's partitions and over its pages. `seq` must be unique
    within a profile.
    """
    placed = numbered(sold, [F.asc("profile_url"), F.asc("seq")], "_pos")
    starts = placed.groupBy("profile_url").agg(F.min("_pos").alias("_first"))
    paged = placed.join(starts, "profile_url").withColumn(
        "page", F.floor((F.col("_pos") - F.col("_first")) / page_size))
    return paged.groupBy("profile_url", "page").agg(F.array_sort(F.collect_list(F.struct(
        F.col("seq"), F.col("sold_date").alias("date"), F.col("closing_price").alias("price"),
        F.col("represented").alias("side"), F.col("city_state").alias("city"),
        F.col("address").alias("addr"), F.col("beds").alias("bd"), F.col("baths").alias("ba"),
    ))).alias("sold_rows"))


def index(profiles: DataFrame, towns: DataFrame, sold: DataFrame, *, page_size: int = 500) -> DataFrame:
    """One search record per named profile: town map, total, and its sold rows in order.

    A profile with more than `page_size` sold rows continues on further pages.
    """
    named = profiles.filter(F.col("profile_name").isNotNull()).select(
        F.col("profile_name").alias("name"), F.col("office_name").alias("office"),
        F.col("profile_type").alias("type"), F.col("sales_last_12_months").alias("sales_12mo"),
        "price_range", "profile_url", F.col("total_sold").alias("career_sales"),
        F.col("avg_price_3yr").alias("avg_price"), F.col("for_sale_count").alias("for_sale"),
        F.coalesce(F.col("enrichment_status") == "success", F.lit(False)).alias("enriched"))
    count = F.coalesce("local_sales_count", F.lit(0))
    local = towns.groupBy("profile_url").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("town", count.alias("n"))))).alias("towns"),
        F.sum(count).alias("total_local_sales"))
    return (
        named.join(local, "profile_url")
        .join(sold_pages(sold, page_size), "profile_url", "left")
        .withColumns({
            "page": F.coalesce("page", F.lit(0)), "sold_rows": F.coalesce("sold_rows", F.array()),
        })
    )


def sold_sides(sold: DataFrame) -> DataFrame:
    """Seller, buyer and both-sided sold rows per profile."""
    n = lambda text: F.count(F.when(F.col("represented") == text, 1))
    return sold.groupBy("profile_url").agg(
        n("Seller").alias("seller_sides"), n("Buyer").alias("buyer_sides"),
        n("Buyer and Seller").alias("both_sides"), F.count(F.lit(1)).alias("shown"))
