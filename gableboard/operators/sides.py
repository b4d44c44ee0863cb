"""Sides: one row per agent (or office) appearance on a closed sale."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gableboard.functions.names import present
from gableboard.operators.filters import closed_and_enriched, same_text


def sides(listings: DataFrame, by: str = "agent", town: str | None = None) -> DataFrame:
    """Both sides of every closed, enriched sale whose `by` (agent or office) is present.

    One scan: the two sides of a row are exploded instead of being read twice.
    """
    closed = listings.filter(closed_and_enriched())
    if town is not None:
        closed = closed.filter(same_text("city", town))
    side = lambda role: F.struct(
        F.col(f"{role}_agent").alias("agent"), F.col(f"{role}_office").alias("office"),
        F.lit(role).alias("role"))
    return (
        closed.select("city", "close_date", "sale_price",
                      F.explode(F.array(side("listing"), side("buyer"))).alias("s"))
        .select("s.*", "city", "close_date", "sale_price")
        .filter(present(by))
    )
