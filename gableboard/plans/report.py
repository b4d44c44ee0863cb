"""The published reports as sections of board rows, ready for the board sink.

The sections of a report are aggregates of one table of cells (`operators/cube.py`).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from gableboard.operators import cube, directory, kpis, teams
from gableboard.operators.grouping import top_overall
from gableboard.session import settled
from gableboard.sources.sinks import section


def _head(name: str, board: DataFrame, order: list, n: int) -> DataFrame:
    return section(top_overall(board, order, n), name, rank="rank")


def listing_report(listings: DataFrame) -> list[DataFrame]:
    cells = cube.kept(cube.listing_cells(listings))
    by_sides = lambda count, name: [F.desc(count), F.desc("volume"), F.asc(name)]
    return [
        _head("combined", cube.combined(cells), by_sides("total_sides", "agent_name"), 30),
        _head("listing_side", cube.side(cells, "listing"), by_sides("sides", "agent_name"), 30),
        _head("buyer_side", cube.side(cells, "buyer"), by_sides("sides", "agent_name"), 30),
        _head("brokerages", cube.brokerages(cells), by_sides("sides", "brokerage"), 20),
        section(cube.combined_by_town(cells, n=5), "towns", scope="town", rank="rank"),
        section(cube.stats(cells), "summary"),
        section(cube.town_counts(cells), "town_counts", scope="city"),
    ]


def kpi_report(listings: DataFrame, *, today: date | str | None = None) -> list[DataFrame]:
    cells = cube.kept(cube.listing_cells(listings, today=today))
    agents, offices = cube.kpis(cells), cube.kpis(cells, "office")
    movers = lambda rows: kpis.movers(rows, banner=True)
    return [
        section(movers(agents), "agent_movers", scope="side", rank="position"),
        _head("agents", agents, kpis.kpi_order(), 50),
        section(movers(offices), "brokerage_movers", scope="side", rank="position"),
        _head("offices", offices, kpis.kpi_order(), 50),
        section(cube.kpis_by_town(cells), "town_agents", scope="town", rank="rank"),
        section(cube.kpis_by_town(cells, "office"), "town_offices", scope="town", rank="rank"),
        section(cube.stats(cells, all_statuses=True), "header"),
    ]


def scoped_report(transactions: DataFrame, *, source: str | None = None, role: str = "seller",
                  today: date | str | None = None) -> list[DataFrame]:
    cells = cube.kept(cube.sale_cells(transactions, source=source, role=role, today=today))
    volume = lambda name: [F.desc("volume"), F.asc(name)]
    return [
        _head("agents", cube.sellers(cells), volume("agent_name"), 30),
        _head("agents_year", cube.sellers(cells, recent=True), volume("agent_name"), 30),
        section(cube.trends(cells), "agent_trends", rank="rolling_rank"),
        _head("brokerages", cube.selling_offices(cells), volume("office"), 15),
        _head("brokerages_year", cube.selling_offices(cells, recent=True), volume("office"), 20),
        section(cube.trends(cells, "office", n=20), "brokerage_trends", rank="rolling_rank"),
        section(cube.sellers_by_town(cells), "towns", scope="town", rank="rank"),
        section(cube.sale_stats(cells), "summary"),
        section(cube.breakdown(cells), "breakdown", scope="kind"),
    ]


def directory_report(profiles: DataFrame, towns: DataFrame) -> list[DataFrame]:
    return [
        _head("brokerages", directory.brokerages(profiles, towns), [F.desc("total_sales"), F.asc("brokerage")], 20),
        _head("agents", directory.agents(profiles, towns), [F.desc("total_local_sales"), F.asc("profile_url")], 30),
        section(directory.brokerages_by_town(profiles, towns, n=5), "town_brokerages", scope="town", rank="rank"),
        section(directory.agents_by_town(profiles, towns, n=10), "town_agents", scope="town", rank="rank"),
        section(directory.stats(profiles, towns), "summary"),
    ]


def gap_report(team_sales: DataFrame, individual_sales: DataFrame) -> list[DataFrame]:
    rows = settled(teams.gap(team_sales, individual_sales))
    return [section(teams.gap_summary(rows), "summary", scope="team_name"), section(teams.gap_detail(rows), "detail")]
