"""Change history, first sightings and the withdrawn sweep."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.constants import SWEEP_DAYS
from gableboard.operators.grouping import with_previous


def changes(observations: DataFrame, *, carry_forward: bool = False, kinds: bool = False) -> DataFrame:
    """Observations whose (status, list_price) differ from the one before.

    Nulls count as values; an observation that knows neither is not logged. With
    `carry_forward` a missing value first takes the latest known one, so that a page
    without a price does not look like a change. With `kinds`, a column says whether a row
    is the first of its key, a withdrawal or another change.
    """
    known = observations.filter(
        F.col("detail_url").isNotNull()
        & (F.col("status").isNotNull() | F.col("list_price").isNotNull()))
    # The latest known values before a row are also the filled values of the row before.
    marked = with_previous(known, "detail_url", ["status", "list_price"], skip_nulls=carry_forward)
    if carry_forward:
        marked = marked.withColumns({
            "status": F.coalesce("status", "prev_status"),
            "list_price": F.coalesce("list_price", "prev_list_price")})
    same = F.equal_null("status", "prev_status") & F.equal_null("list_price", "prev_list_price")
    kind = change_kind().alias("kind")
    return marked.filter(~(F.col("has_prev") & same)).select(
        "detail_url", F.col("observed_at").alias("snapshot_date"), "seq", "status", "list_price",
        *([kind] if kinds else []))


def change_kind() -> Column:
    return (
        F.when(~F.col("has_prev"), "new")
        .when(F.coalesce(F.col("status") == "Withdrawn", F.lit(False)), "withdrawn")
        .otherwise("changed"))


def daily_counts(rows: DataFrame) -> DataFrame:
    """New, changed and withdrawn rows per day; a stream needs a watermark first."""
    return (
        rows.groupBy(F.window("snapshot_date", "1 day").alias("w"), "kind")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").cast("date").alias("day"), "kind", "n")
    )


def latest(observations: DataFrame, *, time: str = "observed_at", seq: str = "seq") -> DataFrame:
    """Last row per listing, as one combinable aggregate."""
    rest = [c for c in observations.columns if c != "detail_url"]
    last = F.max_by(F.struct(*rest), F.struct(time, seq)).alias("_row")
    return observations.groupBy("detail_url").agg(last).select("detail_url", "_row.*")


def _stale(cutoff: datetime) -> Column:
    return (
        F.col("status").isin("Active", "Pending")
        & (F.col("last_seen_at") < F.lit(cutoff)))


def sweep(listings: DataFrame, now: datetime, *, stale_days: int = SWEEP_DAYS) -> DataFrame:
    """Active or pending listings not seen for more than `stale_days` become withdrawn."""
    gone = F.coalesce(_stale(now - timedelta(days=stale_days)), F.lit(False))
    status = F.when(gone, F.lit("Withdrawn")).otherwise(F.col("status"))
    return listings.withColumns({"status": status, "swept": gone})


def sweep_history(listings: DataFrame, now: datetime, *, stale_days: int = SWEEP_DAYS,
                  seq: int = 0) -> DataFrame:
    """The history rows a sweep adds (a swept listing always changes its status)."""
    return sweep(listings, now, stale_days=stale_days).filter("swept").select(
        "detail_url", F.lit(now).alias("snapshot_date"), F.lit(seq).cast("long").alias("seq"),
        "status", "list_price")


def withdrawn(observations: DataFrame, *, stale_days: int = SWEEP_DAYS) -> DataFrame:
    """History rows for listings that were active or pending and then not seen for `stale_days`.

    A listing's sightings less than `stale_days` apart are one session; at its end, which
    lies `stale_days` of 24 hours after the last of them, the newest known status and price
    decide. Sessions compare instants, so the session's time zone does not matter. A session
    that knows no status is none. In a stream with a watermark a session is final once the
    watermark has passed its end; a batch ends them all.
    """
    rows = observations.filter("observed_at is not null and seq is not null")
    at = F.struct("observed_at", "seq")
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
    gap = f"{24 * stale_days} hours"
    # Not the window's end: filters on that would be pushed below the merge of its sessions.
    sessions = rows.groupBy("detail_url", F.session_window("observed_at", gap).alias("w")).agg(
        F.max("observed_at").alias("seen"), F.max_by("seq", at).alias("seq"), known("status"), known("list_price"))
    return sessions.filter(F.col("status").isin("Active", "Pending")).select(
        "detail_url", (F.col("seen") + F.expr(f"INTERVAL {gap}")).alias("snapshot_date"), "seq",
        F.lit("Withdrawn").alias("status"), "list_price")
