"""Outputs: search records as JSON, boards by section, the rankings table."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType

from gableboard.operators.scoped import rankings


def write_index(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").json(path)


def section(board: DataFrame, name: str, *, scope: str | None = None, rank: str | None = None) -> DataFrame:
    """A board as `(section, scope, rank, body)`; `body` holds its columns as JSON.

    `scope` and `rank` name columns of the board, such as its town and position.
    """
    taken = [c for c in (scope, rank) if c]
    body = F.to_json(F.struct(*[c for c in board.columns if c not in taken]))
    return board.select(
        F.lit(name).alias("section"),
        (F.col(scope) if scope else F.lit("all")).alias("scope"),
        (F.col(rank).cast(LongType()) if rank else F.lit(None).cast(LongType())).alias("rank"),
        body.alias("body"))


def boards(sections: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sections)


def write_boards(sections: Iterable[DataFrame], path: str) -> None:
    boards(sections).write.mode("overwrite").partitionBy("section").parquet(path)


def write_rankings(transactions: DataFrame, path: str) -> None:
    """Rebuild the rankings table from all transactions."""
    board = rankings(transactions).withColumn(
        "avg_listing_price", F.col("avg_listing_price").cast(DoubleType())
    ).withColumn("last_updated", F.current_timestamp())
    board.write.mode("overwrite").parquet(path)
