"""Boards over transactions, scoped by source, role and start date; rankings and trends."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.constants import HIGH_VALUE
from gableboard.functions.numbers import trend_label
from gableboard.operators.boards import listed_or_sold
from gableboard.operators.filters import not_company, not_self_named, role_columns, scope
from gableboard.operators.grouping import Facet, facet_summary, top_per_group
from gableboard.operators.kpis import cutoffs


def _rows(transactions: DataFrame, role: str, source, since, town=None) -> DataFrame:
    agent, office = role_columns(role)
    return transactions.filter(scope(source, since, town)).select(
        F.col(agent).alias("agent_name"), F.col(office).alias("office"), "city", "sale_date",
        listed_or_sold().alias("amount"))


def _average() -> Column:
    """Whole average, cut towards zero."""
    return (F.col("volume") / F.col("sides")).cast("long")


def _agent_board(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Only sales that pass the company rules count; office and towns come from all."""
    counts = not_self_named("agent_name", "office") & not_company("agent_name")
    rows = rows.filter(F.col("agent_name").isNotNull()).withColumn("counts", counts)
    here = lambda value: F.when(F.col("counts"), value)
    measures = {
        "sides": F.count(here(F.lit(1))),
        "volume": F.sum(here(F.col("amount"))),
        "high_value": F.count(here(F.when(F.col("amount") >= HIGH_VALUE, 1))),
        "most_recent": F.max(here(F.col("sale_date"))),
    }
    board = facet_summary(rows, keys, measures,
                          {"office": Facet("office", 1), "towns": Facet("city", 3)})
    return board.filter(F.col("sides") > 0).withColumn("avg_price", _average())


def _by_volume(name: str) -> list[Column]:
    return [F.desc("volume"), F.asc(name)]


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def agents(transactions: DataFrame, *, limit: int | None = 30, since=None, source: str | None = None,
           role: str = "seller", town: str | None = None) -> DataFrame:
    board = _agent_board(_rows(transactions, role, source, since, town), ["agent_name"])
    return _first(board.orderBy(*_by_volume("agent_name")), limit)


def agents_by_town(transactions: DataFrame, *, n: int = 5, source: str | None = None,
                   role: str = "seller") -> DataFrame:
    """The best `n` agents of every town in one job."""
    rows = _rows(transactions, role, source, None).withColumn("town", F.lower("city"))
    board = _agent_board(rows.filter(F.col("town").isNotNull()), ["town", "agent_name"])
    columns = ["town", "rank", "agent_name", "office", "sides", "volume", "avg_price"]
    return top_per_group(board, ["town"], _by_volume("agent_name"), n).select(*columns)


def brokerages(transactions: DataFrame, *, limit: int | None = 20, since=None,
               source: str | None = None, role: str = "seller") -> DataFrame:
    """Offices of one role by volume; nobody is excluded."""
    rows = _rows(transactions, role, source, since).filter(F.col("office").isNotNull())
    board = facet_summary(
        rows, ["office"], {"sides": F.count(F.lit(1)), "volume": F.sum("amount")},
        {"top_agents": Facet("agent_name", 3), "towns": Facet("city", 3)})
    board = board.withColumn("avg_price", _average())
    return _first(board.orderBy(*_by_volume("office")), limit)


def rankings(transactions: DataFrame) -> DataFrame:
    """All listing agents without exclusions, for the rankings table."""
    rows = transactions.filter(F.col("listing_agent").isNotNull()).select(
        F.col("listing_agent").alias("agent_name"), "listing_office", "city", "sale_date",
        listed_or_sold().alias("amount"))
    board = facet_summary(
        rows, ["agent_name"],
        {
            "total_listing_sides": F.count(F.lit(1)),
            "listing_volume": F.sum("amount"),
            "high_value_listings": F.count(F.when(F.col("amount") >= HIGH_VALUE, 1)),
            "most_recent_sale": F.max("sale_date"),
        },
        {"listing_office": Facet("listing_office", 1), "primary_towns": Facet("city", 3)})
    return board.withColumn(
        "avg_listing_price", F.col("listing_volume") / F.col("total_listing_sides"))


def trend(volumes: DataFrame, name: str, n: int) -> DataFrame:
    """Places of the 365-day top `n` against the all-time top `n`; volumes: name, volume, recent (null without sales).

    Both tops are ranked in one pass, as two groups that keep `n` rows a task before they meet.
    """
    of = lambda kind, volume: F.struct(F.lit(kind).alias("kind"), volume.alias("volume"))
    both = volumes.select(name, F.explode(F.array(of("ever", F.col("volume")), of("now", F.col("recent")))).alias("x")).select(name, "x.*")
    both = both.filter((F.col("kind") == "ever") | F.col("volume").isNotNull())
    ranked = top_per_group(both, ["kind"], _by_volume(name), n)
    here = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    joined = ranked.groupBy(name).agg(
        here("now", "rank").alias("rolling_rank"), here("now", "volume").alias("rolling_volume"),
        here("ever", "rank").alias("all_time_rank")).filter(F.col("rolling_rank").isNotNull())
    is_new = F.col("all_time_rank").isNull()
    change = F.coalesce(F.col("all_time_rank") - F.col("rolling_rank"), F.lit(0))
    return joined.select(
        name, "rolling_rank", "rolling_volume", is_new.alias("is_new"), change.alias("rank_change"),
    ).withColumn("label", trend_label("rank_change", "is_new", "rolling_volume"))


def _trend_of(rows: DataFrame, name: str, today: date | str | None, n: int) -> DataFrame:
    recent = F.coalesce(F.col("sale_date") >= F.lit(cutoffs(today).current), F.lit(False))
    return trend(rows.groupBy(name).agg(
        F.sum("amount").alias("volume"), F.sum(F.when(recent, F.col("amount"))).alias("recent")), name, n)


def agent_trends(transactions: DataFrame, *, today: date | str | None = None, n: int = 30,
                 source: str | None = None, role: str = "seller") -> DataFrame:
    """All-time position minus 365-day position of the 365-day top `n`."""
    rows = _rows(transactions, role, source, None).filter(
        F.col("agent_name").isNotNull() & not_self_named("agent_name", "office") & not_company("agent_name"))
    return _trend_of(rows, "agent_name", today, n)


def brokerage_trends(transactions: DataFrame, *, today: date | str | None = None, n: int = 20,
                     source: str | None = None, role: str = "seller") -> DataFrame:
    rows = _rows(transactions, role, source, None).filter(F.col("office").isNotNull())
    return _trend_of(rows, "office", today, n)


def stats(transactions: DataFrame, *, source: str | None = None, role: str = "seller") -> DataFrame:
    agent, _ = role_columns(role)
    return transactions.filter(scope(source)).agg(
        F.count(F.lit(1)).alias("total"),
        F.count(agent).alias("with_agent"),
        F.count_distinct(agent).alias("unique_agents"),
        F.min("sale_date").alias("date_min"),
        F.max("sale_date").alias("date_max"),
    )


def breakdown(transactions: DataFrame, *, source: str | None = None) -> DataFrame:
    """Rows per source and per town in one pass: `(kind, value, n)`."""
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"))
    return (
        transactions.filter(scope(source))
        .select(F.explode(F.array(pair("source", "data_source"), pair("town", "city"))).alias("x"))
        .select("x.*").filter((F.col("kind") == "source") | F.col("value").isNotNull())
        .groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def enrichment_stats(transactions: DataFrame) -> DataFrame:
    status = F.col("enrichment_status")
    has_url = F.col("source_url").isNotNull()
    n = lambda c: F.count(F.when(c, 1))
    return transactions.agg(
        n(has_url).alias("total"),
        n(has_url & status.isNull()).alias("pending"),
        n(status == "success").alias("success"),
        n(status == "no_agent").alias("no_agent"),
        n(status == "error").alias("error"),
    )
