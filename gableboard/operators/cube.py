"""One combinable pre-aggregate behind all sections of a report.

A cell holds the figures of all rows that agree in everything a report groups by. Counts and
sums of cells add up, dates take their least or greatest: cells of two sets of rows, merged,
are the cells of both (`added`), and every board of a report is an aggregate of cells. So a
report reads its source once, and a hot agent, office or town is one cell a task from the first
shuffle on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.constants import HIGH_VALUE, THIN_TOWN
from gableboard.functions.names import present
from gableboard.operators import boards, kpis as period, scoped
from gableboard.operators.filters import not_company, not_placeholder, not_self_named, role_columns, scope
from gableboard.operators.grouping import Facet, facet_summary, top_per_group
from gableboard.session import settled

LISTING_KEYS = ("closed", "enriched", "role", "agent", "office", "city")
SALE_KEYS = ("source", "agent", "office", "city")
#: What a window of time counts: its rows, their sum, large ones, the newest date.
WINDOW = ("n", "amount", "high_value", "most_recent")


def _merged(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    least, greatest = ("first_date",), ("last_date", "most_recent", "r_most_recent")
    pick = lambda c: F.min(c) if c in least else F.max(c) if c in greatest else F.sum(c)
    return rows.groupBy(*keys).agg(*[pick(c).alias(c) for c in rows.columns if c not in keys])


def added(one: DataFrame, other: DataFrame) -> DataFrame:
    """Cells of two sets of rows, counted with the same windows, as one."""
    keys = LISTING_KEYS if "closed" in one.columns else SALE_KEYS
    return _merged(one.unionByName(other), keys)


def listing_cells(listings: DataFrame, *, today: date | str | None = None) -> DataFrame:
    """Cells of both sides of all listings, whatever their status."""
    cut = period.cutoffs(today)
    closed = F.col("close_date")
    price, one = F.coalesce("sale_price", F.lit(0)), F.lit(1).cast("bigint")
    windows = {
        "current_12mo": closed >= F.lit(cut.current),
        "prior_12mo": (closed >= F.lit(cut.prior)) & (closed < F.lit(cut.current)),
        "three_yr": closed >= F.lit(cut.three_year)}
    inside = lambda when, value: F.when(when, value).otherwise(0).cast("bigint")
    amount = boards.listed_or_sold()
    side = lambda role: F.struct(
        F.lit(role).alias("role"), F.col(f"{role}_agent").alias("agent"), F.col(f"{role}_office").alias("office"))
    rows = listings.select(
        F.coalesce(F.col("status") == "Closed", F.lit(False)).alias("closed"),
        F.coalesce(F.col("enrichment_status") == "success", F.lit(False)).alias("enriched"), "city",
        F.explode(F.array(side("listing"), side("buyer"))).alias("s"), one.alias("n"), price.alias("price"),
        amount.alias("amount"), inside(amount >= HIGH_VALUE, 1).alias("high_value"),
        closed.alias("most_recent"), closed.alias("first_date"), closed.alias("last_date"),
        *[inside(w, 1).alias(f"{name}_sides") for name, w in windows.items()],
        *[inside(w, price).alias(f"{name}_volume") for name, w in windows.items()])
    return _merged(rows.select("s.*", *[c for c in rows.columns if c != "s"]), LISTING_KEYS)


def sale_cells(transactions: DataFrame, *, source: str | None = None, role: str = "seller",
               today: date | str | None = None) -> DataFrame:
    """Cells of the sales of one role; columns with r_ count the last 365 days."""
    agent, office = role_columns(role)
    recent = F.coalesce(F.col("sale_date") >= F.lit(period.cutoffs(today).current), F.lit(False))
    amount = boards.listed_or_sold()
    rows = transactions.filter(scope(source)).select(
        F.col("data_source").alias("source"), F.col(agent).alias("agent"), F.col(office).alias("office"), "city",
        F.col("sale_date").alias("first_date"), F.col("sale_date").alias("last_date"),
        F.lit(1).cast("bigint").alias("n"), amount.alias("amount"),
        F.when(amount >= HIGH_VALUE, 1).otherwise(0).cast("bigint").alias("high_value"),
        F.col("sale_date").alias("most_recent"), recent.alias("recent"))
    for c in WINDOW:
        rows = rows.withColumn(f"r_{c}", F.when(F.col("recent"), F.col(c)).otherwise(F.lit(None if c == "most_recent" else 0)))
    return _merged(rows.drop("recent"), SALE_KEYS)


# --- listings ---------------------------------------------------------------------------

def _sold(cells: DataFrame, by: str) -> DataFrame:
    return cells.filter(F.col("closed") & F.col("enriched") & present(by))


def _agents(cells: DataFrame) -> DataFrame:
    return _sold(cells, "agent").filter(not_placeholder("agent"))


def _of_role(role: str, value: str = "n") -> Column:
    return F.sum(F.when(F.col("role") == role, F.col(value)).otherwise(0))


def _kpi_measures() -> dict[str, Column]:
    out = {}
    for name in ("current_12mo", "prior_12mo", "three_yr"):
        out |= {f"{name}_sides": F.sum(f"{name}_sides"), f"{name}_volume": F.sum(f"{name}_volume")}
    return out | {
        "all_time_sides": F.sum("n"), "all_time_volume": F.sum("price"), "listing_sides": _of_role("listing"),
        "buyer_sides": _of_role("buyer"), "most_recent": F.max("most_recent")}


def _kpis(cells: DataFrame, by: str, keys: list[str]) -> DataFrame:
    towns = {"primary_towns": Facet("city", 3)}
    if by == "agent":
        rows, facets, distinct = _agents(cells), {"office": Facet("office", 1), **towns}, None
    else:
        rows, facets, distinct = _sold(cells, "office"), {"top_agents": Facet("agent", 3), **towns}, {"agent_count": "agent"}
    rows = rows.withColumnRenamed(by, "name").withColumn("town", F.lower("city"))
    rows = rows.filter(F.col("town").isNotNull()) if "town" in keys else rows.drop("town")
    return facet_summary(rows, keys, _kpi_measures(), facets, distinct, weight="n")


def kpis(cells: DataFrame, by: str = "agent") -> DataFrame:
    """As `kpis.agent` or `kpis.brokerage` (by="office")."""
    return _kpis(cells, by, ["name"])


def kpis_by_town(cells: DataFrame, by: str = "agent", *, n: int = 50) -> DataFrame:
    return top_per_group(_kpis(cells, by, ["town", "name"]), ["town"], period.kpi_order(), n)


def side(cells: DataFrame, role: str) -> DataFrame:
    """As `boards.side`, all rows in no order."""
    rows = _agents(cells).filter(F.col("role") == role).withColumnRenamed("agent", "agent_name")
    measures = {"sides": F.sum("n"), "volume": F.sum("amount"), "high_value": F.sum("high_value"), "most_recent": F.max("most_recent")}
    board = facet_summary(rows, ["agent_name"], measures, {"office": Facet("office", 1), "towns": Facet("city", 3)}, weight="n")
    return board.withColumn("avg_price", F.col("volume") / F.col("sides"))


def _combined(cells: DataFrame, keys: list[str]) -> DataFrame:
    rows = _agents(cells).withColumnRenamed("agent", "agent_name").withColumn("town", F.lower("city"))
    rows = rows.filter(F.col("town").isNotNull()) if "town" in keys else rows.drop("town")
    measures = {"total_sides": F.sum("n"), "listing_sides": _of_role("listing"), "buyer_sides": _of_role("buyer"),
                "volume": F.sum("price"), "most_recent": F.max("most_recent")}
    board = facet_summary(rows, keys, measures, {"office": Facet("office", 1), "towns": Facet("city", 3)}, weight="n")
    return board.withColumn("avg_price", F.col("volume") / F.col("total_sides"))


def combined(cells: DataFrame) -> DataFrame:
    """As `boards.combined`, all rows in no order."""
    return _combined(cells, ["agent_name"])


def combined_by_town(cells: DataFrame, *, n: int = 5) -> DataFrame:
    order = [F.desc("total_sides"), F.desc("volume"), F.asc("agent_name")]
    return top_per_group(_combined(cells, ["town", "agent_name"]), ["town"], order, n)


def brokerages(cells: DataFrame) -> DataFrame:
    """As `boards.brokerages`, all rows in no order."""
    rows = _sold(cells, "office").withColumnRenamed("office", "brokerage")
    board = facet_summary(rows, ["brokerage"], {"sides": F.sum("n"), "volume": F.sum("price")},
                          {"top_agents": Facet("agent", 3)}, {"agent_count": "agent"}, weight="n")
    return board.withColumn("avg_price", F.col("volume") / F.col("sides"))


def stats(cells: DataFrame, *, all_statuses: bool = False) -> DataFrame:
    """As `boards.stats`: each listing has a cell of either role."""
    rows = cells if all_statuses else cells.filter("closed")
    listing = F.col("role") == "listing"
    total = lambda when, c="n": F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    return rows.agg(
        total(listing).alias("total"), total(listing & F.col("enriched")).alias("enriched"),
        total(listing & F.col("agent").isNotNull()).alias("has_listing"),
        total(~listing & F.col("agent").isNotNull()).alias("has_buyer"),
        F.min("first_date").alias("date_min"), F.max("last_date").alias("date_max"),
        F.sum(F.when(listing, F.col("price"))).alias("volume"))


def town_counts(cells: DataFrame, *, thin: int = THIN_TOWN) -> DataFrame:
    sold = cells.filter(F.col("closed") & F.col("enriched") & (F.col("role") == "listing") & F.col("city").isNotNull())
    return sold.groupBy("city").agg(F.sum("n").alias("n")).withColumn("thin", F.col("n") < thin)


# --- sales of a source and role ---------------------------------------------------------

def _window(cells: DataFrame, recent: bool) -> DataFrame:
    """Cells with any row in the window, its figures under their plain names."""
    if not recent:
        return cells.drop(*[f"r_{c}" for c in WINDOW])
    return cells.drop(*WINDOW).withColumnsRenamed({f"r_{c}": c for c in WINDOW}).filter("n > 0")


def _average() -> Column:
    return (F.col("volume") / F.col("sides")).cast("long")


def _sellers(cells: DataFrame, keys: list[str], recent: bool) -> DataFrame:
    rows = _window(cells, recent).withColumnRenamed("agent", "agent_name").filter(F.col("agent_name").isNotNull())
    rows = rows.withColumn("counts", not_self_named("agent_name", "office") & not_company("agent_name")).withColumn("town", F.lower("city"))
    rows = rows.filter(F.col("town").isNotNull()) if "town" in keys else rows.drop("town")
    here = lambda c: F.when(F.col("counts"), F.col(c))
    total = lambda c: F.coalesce(F.sum(here(c)), F.lit(0))
    measures = {"sides": total("n"), "volume": F.sum(here("amount")), "high_value": total("high_value"), "most_recent": F.max(here("most_recent"))}
    board = facet_summary(rows, keys, measures, {"office": Facet("office", 1), "towns": Facet("city", 3)}, weight="n")
    return board.filter(F.col("sides") > 0).withColumn("avg_price", _average())


def sellers(cells: DataFrame, *, recent: bool = False) -> DataFrame:
    """As `scoped.agents`, all rows in no order; `recent` counts the last 365 days."""
    return _sellers(cells, ["agent_name"], recent)


def sellers_by_town(cells: DataFrame, *, n: int = 5) -> DataFrame:
    columns = ["town", "rank", "agent_name", "office", "sides", "volume", "avg_price"]
    return top_per_group(_sellers(cells, ["town", "agent_name"], False), ["town"], [F.desc("volume"), F.asc("agent_name")], n).select(*columns)


def selling_offices(cells: DataFrame, *, recent: bool = False) -> DataFrame:
    """As `scoped.brokerages`, all rows in no order."""
    rows = _window(cells, recent).filter(F.col("office").isNotNull())
    board = facet_summary(rows, ["office"], {"sides": F.sum("n"), "volume": F.sum("amount")},
                          {"top_agents": Facet("agent", 3), "towns": Facet("city", 3)}, weight="n")
    return board.withColumn("avg_price", _average())


def trends(cells: DataFrame, by: str = "agent", *, n: int = 30) -> DataFrame:
    """As `scoped.agent_trends` or `scoped.brokerage_trends` (by="office")."""
    if by == "agent":
        rows, name = cells.filter(F.col("agent").isNotNull() & not_self_named("agent", "office") & not_company("agent")), "agent_name"
    else:
        rows, name = cells.filter(F.col("office").isNotNull()), "office"
    volumes = rows.groupBy(F.col(by).alias(name)).agg(
        F.sum("amount").alias("volume"), F.sum(F.when(F.col("r_n") > 0, F.col("r_amount"))).alias("recent"))
    return scoped.trend(volumes, name, n)


def sale_stats(cells: DataFrame) -> DataFrame:
    """As `scoped.stats`."""
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("agent").isNotNull(), F.col("n"))), F.lit(0)).alias("with_agent"),
        F.count_distinct("agent").alias("unique_agents"), F.min("first_date").alias("date_min"), F.max("last_date").alias("date_max"))


def breakdown(cells: DataFrame) -> DataFrame:
    """As `scoped.breakdown`."""
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"), F.col("n"))
    return (
        cells.select(F.explode(F.array(pair("source", "source"), pair("town", "city"))).alias("x")).select("x.*")
        .filter((F.col("kind") == "source") | F.col("value").isNotNull()).groupBy("kind", "value").agg(F.sum("n").alias("n")))


def kept(cells: DataFrame) -> DataFrame:
    """Cells materialised, for the sections of a report."""
    return settled(cells)
