"""Small helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gableboard.session import ensure_checkpoint_dir

#: Whether the shuffle files of a query go when it ends.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def id_remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts the lineage, compresses, survives lost executors.

    Spark deletes the shuffle files of the write when it ends; they would stay until the driver collects garbage."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, name)
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        df.write.parquet(folder, compression=compression)
    finally:
        spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(folder)


def packed(docs: DataFrame) -> Column:
    """All columns of docs as one struct `row`, so that no name of theirs meets one of an operator; `row.*` unpacks it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def running(rows: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]], width: int = 128) -> Column:
    """What `step(at, row)` gives beside the next `at` for each row of an array, `at` being 0 at first; nulls are left out.

    Lists of `width` are made first and put together then, as adding to one list copies it each time.
    """
    none = F.array().cast(f"array<{kind}>")

    def add(a, row):
        at, item = step(a["at"], row)
        return F.struct(at.cast("bigint").alias("at"), F.concat(a["out"], F.array(item.cast(kind))).alias("out"))

    def part(a, rows):
        start = F.struct(a["at"].alias("at"), none.alias("out"))
        return F.aggregate(rows, start, add, lambda b: F.struct(b["at"].alias("at"), F.concat(a["out"], F.array(b["out"])).alias("out")))

    def whole(rows):
        parts = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(rows) - 1, F.lit(0)) / width).cast("int")), lambda k: F.slice(rows, (k * width + 1).cast("int"), width))
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.filter(F.flatten(F.aggregate(parts, start, part, lambda a: a["out"])), lambda x: x.isNotNull())

    # In a list of one, so that the rows are made once.
    return F.transform(F.array(rows), whole)[0]
