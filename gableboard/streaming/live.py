"""Event-time streams: daily change counts and withdrawn listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gableboard import schemas
from gableboard.constants import SWEEP_DAYS
from gableboard.operators import history


def logged(spark: SparkSession, path: str, **options) -> DataFrame:
    """The rows that `changes.ChangeLog` appends below `path`, as a stream."""
    return spark.readStream.options(**options).schema(schemas.HISTORY).parquet(f"{path}/history/bid=*")


def daily_counts(changes: DataFrame, *, delay: str = "2 days") -> DataFrame:
    """New, changed and withdrawn rows per day of a stream of logged changes, in append mode.

    A day is final, and comes out once, when the watermark (the newest change less `delay`)
    has passed its end. A change that arrives after that is not counted; one that a
    replayed batch logs again counts once, for `delay` remembers it.
    """
    timely = changes.withWatermark("snapshot_date", delay)
    once = timely.dropDuplicatesWithinWatermark(["detail_url", "snapshot_date", "seq"])
    return history.daily_counts(once)


def withdrawn(observations: DataFrame, *, stale_days: int = SWEEP_DAYS, delay: str = "1 day") -> DataFrame:
    """`history.withdrawn` of a stream: a session comes out once the watermark has passed its end."""
    return history.withdrawn(observations.withWatermark("observed_at", delay), stale_days=stale_days)
