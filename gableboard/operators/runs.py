"""Deltas of observation runs against what was known before, and run verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gableboard.constants import TOWNS
from gableboard.operators.grouping import with_previous


def compared(observations: DataFrame) -> DataFrame:
    """`is_new` (key never seen before) and `status_changed` per observation, in order."""
    marked = with_previous(observations, "detail_url", ["status"], skip_nulls=True)
    known = F.col("has_prev")
    changed = known & F.col("status").isNotNull() & ~F.equal_null("status", "prev_status")
    return marked.withColumns({"is_new": ~known, "status_changed": changed}).drop("prev_status", "has_prev")


def compared_with_state(observations: DataFrame, state: DataFrame) -> DataFrame:
    """As `compared`, for one batch against a current-state table with one row per key.

    Only the first sighting of a key in the batch needs the state, so the joined side is
    one row per key and a hot key costs one match.
    """
    marked = compared(observations)
    known = state.select("detail_url", F.col("status").alias("_known"), F.lit(True).alias("_in"))
    heads = marked.filter("is_new").join(known, "detail_url", "left")
    was = F.coalesce("_in", F.lit(False))
    moved = was & F.col("status").isNotNull() & ~F.equal_null("status", "_known")
    heads = heads.withColumns({"is_new": ~was, "status_changed": moved}).drop("_known", "_in")
    return heads.unionByName(marked.filter(~F.col("is_new")))


def deltas(observations: DataFrame) -> DataFrame:
    """Listings, new listings and status changes per (run, town)."""
    return (
        compared(observations).groupBy("run", "town").agg(
            F.count(F.lit(1)).alias("listings"),
            F.count(F.when(F.col("is_new"), 1)).alias("new_listings"),
            F.count(F.when(F.col("status_changed"), 1)).alias("status_changes"),
        )
    )


def anomalies(run_deltas: DataFrame, *, towns_expected: int = len(TOWNS)) -> DataFrame:
    """Totals per run; a run that saw every town and no change at all is suspicious."""
    totals = run_deltas.groupBy("run").agg(
        F.count_distinct("town").alias("towns_seen"),
        F.sum("listings").alias("listings"),
        F.sum("new_listings").alias("new_listings"),
        F.sum("status_changes").alias("status_changes"),
    )
    quiet = (F.col("new_listings") == 0) & (F.col("status_changes") == 0)
    return totals.withColumn("suspicious", (F.col("towns_seen") >= towns_expected) & quiet)


def outcomes(attempts: DataFrame) -> DataFrame:
    """Success rate per run; more than 10 % failed of over 100 is a warning."""
    totals = attempts.groupBy("run").agg(
        F.count(F.when(F.col("outcome") == "success", 1)).alias("enriched"),
        F.count(F.when(F.col("outcome") != "success", 1)).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )
    # Ten failures per success, compared in whole numbers.
    bad = (F.col("failed") * 10 > F.col("enriched")) & (F.col("total") > 100)
    return totals.withColumns({
        "success_pct": F.round(F.col("enriched") / F.col("total") * 100, 1),
        "verdict": F.when(bad, "warning").otherwise("ok"),
    })


def known_pages(observations: DataFrame) -> DataFrame:
    """Per page of a run: cards, and whether every card was already known (the stop rule)."""
    return (
        compared(observations).groupBy("run", "town", "page").agg(
            F.count(F.lit(1)).alias("cards"),
            F.every(~F.col("is_new")).alias("all_known"),
        )
    )
