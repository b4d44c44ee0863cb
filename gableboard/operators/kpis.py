"""Period KPIs of agents and brokerages, and rank movers."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.constants import MOVER_BANNER_MIN, MOVER_MIN_SIDES, MOVER_TOP, YEAR_DAYS
from gableboard.functions.numbers import delta_label, percent_change
from gableboard.operators.filters import not_placeholder
from gableboard.operators.grouping import Facet, facet_summary, numbered, top_per_group
from gableboard.operators.sides import sides


@dataclass(frozen=True)
class Cutoffs:
    """Window starts; every window includes its start and has no upper end of its own."""

    current: date
    prior: date
    three_year: date


def cutoffs(today: date | str | None = None) -> Cutoffs:
    anchor = date.fromisoformat(today) if isinstance(today, str) else today or date.today()
    back = lambda years: anchor - timedelta(days=YEAR_DAYS * years)
    return Cutoffs(back(1), back(2), back(3))


def kpi_order() -> list[Column]:
    return [F.desc("current_12mo_volume"), F.desc("all_time_volume"), F.asc("name")]


def _period_measures(cut: Cutoffs) -> dict[str, Column]:
    closed = F.col("close_date")
    current = closed >= F.lit(cut.current)
    prior = (closed >= F.lit(cut.prior)) & (closed < F.lit(cut.current))
    three = closed >= F.lit(cut.three_year)
    price = F.coalesce("sale_price", F.lit(0))
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    volume = lambda cond: F.sum(F.when(cond, price).otherwise(0))
    return {
        "current_12mo_sides": count(current), "current_12mo_volume": volume(current),
        "prior_12mo_sides": count(prior), "prior_12mo_volume": volume(prior),
        "three_yr_sides": count(three), "three_yr_volume": volume(three),
        "all_time_sides": F.count(F.lit(1)), "all_time_volume": F.sum(price),
        "listing_sides": count(F.col("role") == "listing"),
        "buyer_sides": count(F.col("role") == "buyer"),
        "most_recent": F.max("close_date"),
    }


def _finish(kpis: DataFrame, limit: int | None) -> DataFrame:
    ordered = kpis.orderBy(*kpi_order())
    return ordered if limit is None else ordered.limit(limit)


def _agent_rows(listings: DataFrame, town: str | None) -> DataFrame:
    return sides(listings, "agent", town).filter(not_placeholder("agent"))


_AGENT_FACETS = {"office": Facet("office", 1), "primary_towns": Facet("city", 3)}
_OFFICE_FACETS = {"top_agents": Facet("agent", 3), "primary_towns": Facet("city", 3)}


def agent(listings: DataFrame, *, town: str | None = None, limit: int | None = None,
          today: date | str | None = None) -> DataFrame:
    """One row per agent name with every period metric, best current volume first."""
    rows = _agent_rows(listings, town).withColumnRenamed("agent", "name")
    kpis = facet_summary(rows, ["name"], _period_measures(cutoffs(today)), _AGENT_FACETS)
    return _finish(kpis, limit)


def brokerage(listings: DataFrame, *, town: str | None = None, limit: int | None = None,
              today: date | str | None = None) -> DataFrame:
    """As `agent` by office (branches stay apart), with agent count and top agents."""
    rows = sides(listings, "office", town).withColumnRenamed("office", "name")
    kpis = facet_summary(rows, ["name"], _period_measures(cutoffs(today)), _OFFICE_FACETS,
                         distinct={"agent_count": "agent"})
    return _finish(kpis, limit)


def by_town(listings: DataFrame, kind: str = "agent", *, n: int = 50,
            today: date | str | None = None) -> DataFrame:
    """The best `n` of every town in one job (town text compared without case)."""
    if kind == "agent":
        rows, name, facets, distinct = _agent_rows(listings, None), "agent", _AGENT_FACETS, None
    else:
        rows, name, facets = sides(listings, "office"), "office", _OFFICE_FACETS
        distinct = {"agent_count": "agent"}
    rows = (
        rows.withColumnRenamed(name, "name").withColumn("town", F.lower("city"))
        .filter(F.col("town").isNotNull())
    )
    kpis = facet_summary(rows, ["town", "name"], _period_measures(cutoffs(today)), facets, distinct)
    return top_per_group(kpis, ["town"], kpi_order(), n)


def ranked(kpis: DataFrame, *, current_field: str = "current_12mo_sides",
           prior_field: str = "prior_12mo_sides") -> DataFrame:
    """`current_rank`, `prior_rank`, `delta` (positive = moved up) and `is_new` per entity.

    Ranks are unique positions; equal counts keep the KPI order.
    """
    filled = kpis.withColumns({
        current_field: F.coalesce(current_field, F.lit(0)),
        prior_field: F.coalesce(prior_field, F.lit(0)),
    })
    tie = kpi_order() if "current_12mo_volume" in kpis.columns else [F.asc("name")]
    current = numbered(filled, [F.desc(current_field), *tie], "current_rank")
    # The first numbering is materialised, so the second one does not recompute the KPIs.
    had_prior = F.col(prior_field) > 0
    prior = numbered(current.filter(had_prior), [F.desc(prior_field), *tie], "prior_rank")
    fresh = current.filter(~had_prior).withColumn("prior_rank", F.lit(None).cast("long"))
    return (
        prior.unionByName(fresh)
        .withColumn("is_new", F.col("prior_rank").isNull())
        .withColumn("delta", F.col("prior_rank") - F.col("current_rank"))
    )


def movers(kpis: DataFrame, *, current_field: str = "current_12mo_sides",
           prior_field: str = "prior_12mo_sides", min_sides: int = MOVER_MIN_SIDES,
           top_n: int = MOVER_TOP, banner: bool = False) -> DataFrame:
    """Risers (new entities first) and fallers, `top_n` each, with their position.

    With `banner`, nothing is shown unless ten entities qualify.
    """
    enough = ranked(kpis, current_field=current_field, prior_field=prior_field).filter(
        F.col(current_field) >= min_sides)
    side = (
        F.when(F.col("is_new") | (F.col("delta") > 0), "riser").when(F.col("delta") < 0, "faller"))
    order = [
        F.desc("is_new"),
        F.desc(F.when(F.col("is_new"), F.col(current_field)).otherwise(F.abs("delta"))),
        F.asc("current_rank"),
    ]
    moved = enough.withColumn("side", side).filter(F.col("side").isNotNull())
    # Equal deltas keep the KPI order, not the rank order.
    if "current_12mo_volume" in kpis.columns:
        order[2:] = kpi_order()
    shown = top_per_group(moved, ["side"], order, top_n, "position")
    shown = shown.withColumn("delta_label", delta_label("delta", "is_new"))
    if "current_12mo_volume" in kpis.columns:
        shown = shown.withColumn(
            "volume_change_pct", percent_change("current_12mo_volume", "prior_12mo_volume"))
    if banner:
        qualifying = enough.agg(F.count(F.lit(1))).scalar()
        shown = shown.filter(qualifying >= MOVER_BANNER_MIN)
    return shown
