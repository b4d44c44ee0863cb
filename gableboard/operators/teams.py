"""Team sales without a member behind them, and sales found in two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gableboard.constants import GAP_DETAIL_CAP


def gap(team_sales: DataFrame, individual_sales: DataFrame) -> DataFrame:
    """Team sales with no individual observation of the same key and side.

    The order in which the two were seen does not matter. A null key or side never
    matches. Individual sales are reduced to one row per key and side before the join.
    """
    seen = individual_sales.select(
        F.col("transaction_match_key").alias("_key"), F.lower("represented_side").alias("_side")
    ).filter(F.col("_key").isNotNull() & F.col("_side").isNotNull()).distinct()
    # Null keys never match; giving each its own key keeps them out of one partition.
    alone = F.concat(F.lit("none:"), F.xxhash64(*team_sales.columns).cast("string"))
    marked = team_sales.withColumns({
        "_key": F.coalesce("transaction_match_key", alone),
        "_side": F.lower("represented_side"),
    })
    return marked.join(seen, ["_key", "_side"], "left_anti").drop("_key", "_side")


def gap_summary(gap_rows: DataFrame) -> DataFrame:
    named = gap_rows.select(
        F.coalesce(F.nullif("team_name", F.lit("")), F.lit("Unknown Team")).alias("team_name"),
        F.coalesce(F.nullif("local_town", F.lit("")), F.lit("Unknown")).alias("local_town"))
    return named.groupBy("team_name", "local_town").agg(F.count(F.lit(1)).alias("unresolved"))


def gap_detail(gap_rows: DataFrame, n: int = GAP_DETAIL_CAP) -> DataFrame:
    """The first `n` gap rows by team, newest sale first."""
    columns = ["team_name", "team_profile_url", "local_town", "represented_side", "sale_date",
               "sale_price", "property_url"]
    order = [F.asc("team_name"), F.desc("sale_date"), F.asc("property_url"),
             F.asc("represented_side"), F.asc("sale_price")]
    return gap_rows.select(*columns).orderBy(*order).limit(n)


def cross_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Match keys known to both sides, with the number of rows on each.

    Both sides are counted per key first: copies of one sale never multiply.
    """
    count = lambda df, name: (
        df.filter(F.col("transaction_match_key").isNotNull())
        .groupBy("transaction_match_key").agg(F.count(F.lit(1)).alias(name)))
    return count(left, "left_rows").join(count(right, "right_rows"), "transaction_match_key")
