"""Stored tables with declared schemas."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gableboard import schemas
from gableboard.operators.merge import evolve

SCHEMAS: dict[str, StructType] = {
    "listings": schemas.LISTING,
    "history": schemas.HISTORY,
    "observations": schemas.OBSERVATION,
    "transactions": schemas.TRANSACTION,
    "profile_sales": schemas.PROFILE_SALE,
    "profiles": schemas.PROFILE,
    "profile_towns": schemas.PROFILE_TOWN,
    "team_members": schemas.TEAM_MEMBER,
    "team_sales": schemas.TEAM_SALE,
    "sold_rows": schemas.SOLD_ROW,
}


def read(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A table in its current layout. Parquet fills columns that older files lack."""
    return spark.read.schema(SCHEMAS[table]).parquet(path)


def read_legacy_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listings written before `status` existed: new columns added, closed rows marked."""
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    return evolve(stored, schemas.LISTING, backfill_status=True)


def write(df: DataFrame, table: str, path: str, *, mode: str = "append",
          partition_by: str | None = None) -> None:
    """Write rows in the declared column order and types."""
    out = evolve(df, SCHEMAS[table]).write.mode(mode)
    (out.partitionBy(partition_by) if partition_by else out).parquet(path)


#: What makes a row of a table one row.
KEYS: dict[str, tuple[str, ...]] = {
    "listings": ("detail_url",), "transactions": ("mls_number",), "profiles": ("profile_url",),
    "profile_towns": ("profile_url", "town"), "team_members": ("team_profile_url", "member_profile_url"),
    "sold_rows": ("profile_url", "zpid"),
}
PARTS = 16


class Refused(ValueError):
    """A publication that failed its checks; the table is as it was."""


def publish(df: DataFrame, table: str, path: str, *, least: int = 1, keys: Sequence[str] | None = None, parts: int = PARTS) -> int:
    """Put `df` in place of those parts of a table that its rows fall into; returns the number of rows.

    The rows are written beside the table first, in its declared layout and dealt over `parts` by
    their key, and read back: every key column known, no key twice, not fewer rows than `least`
    and than were written. Only then do the parts they fall into change, by Spark's dynamic partition
    overwrite, which moves whole parts when all tasks are done; other parts stay. A reader sees the old
    or the new files of a part. If a check fails, `Refused` is raised and the table is as it was.
    """
    keys = list(keys if keys is not None else KEYS[table])
    schema, spark = SCHEMAS[table], df.sparkSession
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    full = StructType([*schema.fields, StructField("part", IntegerType(), True)])
    seen = Observation("written")
    ready = evolve(df, schema).withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
    ready = ready.observe(seen, F.count(F.lit(1)).alias("n"))
    ready.repartition(parts, "part").write.partitionBy("part").parquet(staged)
    back = spark.read.schema(full).parquet(staged)
    unknown = reduce(or_, [F.col(k).isNull() for k in keys])
    per_key = back.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("twice"),
        F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0)).alias("unknown")).head()
    written = seen.get["n"] if found["rows"] else 0
    if found["rows"] < max(least, written) or found["twice"] or found["unknown"]:
        raise Refused(f"{table}: {found['rows']} rows read of {written} written, at least {least} wanted; "
                      f"{found['twice']} keys twice, {found['unknown']} rows without a key")
    back.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    return found["rows"]


def published(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A published table, in its current layout whatever the layout of its files."""
    full = StructType([*SCHEMAS[table].fields, StructField("part", IntegerType(), True)])
    return spark.read.schema(full).parquet(path).drop("part")
