"""Substring search over stored index records by postings of letter pairs and triples.

`build` writes two tables. Postings hold (gram, key): a gram is two or three neighbouring
letters of a lower-cased name or office, a key the lower-cased name of its record. Records
hold the records themselves. Both are partitioned by a hash, of the gram or the key, and
sorted. `search` reads the partitions and row groups of the query's grams only, keeps
the keys that have all of them, reads the partitions of those keys and verifies every hit in
the record itself, so the result is that of comparing all names.

Postings are dealt by ranges of (gram, key), so a gram that most names share is spread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from gableboard.constants import SEARCH_CAP
from gableboard.operators.index import matches

SIZES = (2, 3)
BUCKETS = 32


def records(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """All records as (source, place, id, name, office, body); sources: name -> (records, id column), in order."""
    rows = [
        df.select(F.lit(source).alias("source"), F.lit(i).alias("place"), F.col(key).cast("string").alias("id"), "name", "office",
                  F.to_json(F.struct(*df.columns)).alias("body"))
        for i, (source, (df, key)) in enumerate(sources.items())]
    return reduce(DataFrame.unionByName, rows)


def _key() -> Column:
    return F.lower(F.coalesce("name", F.lit("")))


def _bucket(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def _grams(text: Column) -> Column:
    """Distinct neighbouring letters of a lower-cased text, in twos and threes."""
    low = F.lower(F.coalesce(text, F.lit("")))
    of = lambda k: F.when(F.length(low) >= k, F.transform(
        F.sequence(F.lit(1), F.length(low) - (k - 1)), lambda i: F.substring(low, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[of(k) for k in SIZES]))


def build(rows: DataFrame, path: str) -> None:
    """Write postings and records below `path`."""
    keyed = rows.withColumn("key", _key())
    keyed.withColumn("bucket", _bucket(F.col("key"))).repartitionByRange("bucket", "key", "id").sortWithinPartitions("key").write.mode(
        "overwrite").partitionBy("bucket").parquet(f"{path}/records")
    # Postings come from the stored names, so that the records are not made again.
    stored = rows.sparkSession.read.schema("office string, key string, bucket int").parquet(f"{path}/records")
    postings(stored).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")


def postings(stored: DataFrame) -> DataFrame:
    """Every (bucket, gram, key) of stored records once, in order within ranges.

    Grams are dealt before repeated ones go, so a task holds a range of them and never all of its names.
    """
    offices = F.explode(F.array(F.lit(""), F.coalesce(F.lower("office"), F.lit(""))))
    texts = stored.select("key", offices.alias("office")).distinct()
    own = _grams(F.col("key"))
    grams = F.when(F.col("office") == "", own).otherwise(F.array_except(_grams(F.col("office")), own))
    posted = texts.select("key", F.explode(grams).alias("gram")).withColumn("bucket", _bucket(F.col("gram")))
    place = F.row_number().over(W.partitionBy("bucket", "gram", "key").orderBy("bucket"))
    dealt = posted.repartitionByRange("bucket", "gram", "key").withColumn("_place", place)
    return dealt.filter("_place = 1").drop("_place").sortWithinPartitions("bucket", "gram", "key")


def hits(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Records whose name or office contains the query, whatever the case; none for less than two letters."""
    stored = spark.read.schema("source string, place int, id string, name string, office string, body string, key string, bucket int").parquet(
        f"{path}/records")
    low = query.lower()
    if len(low) < min(SIZES):
        return stored.filter(F.lit(False))
    size = min(len(low), max(SIZES))
    grams = sorted({low[i:i + size] for i in range(len(low) - size + 1)})
    wanted = [_bucket(F.lit(g)) for g in grams]
    postings = spark.read.schema("key string, gram string, bucket int").parquet(f"{path}/postings")
    posted = postings.filter(F.col("bucket").isin(*wanted) & F.col("gram").isin(*grams))
    keys = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams))
    keys = keys.select("key", _bucket(F.col("key")).alias("bucket"))
    return stored.join(keys, ["bucket", "key"], "left_semi").filter(matches(query))


def search(spark: SparkSession, path: str, query: str, *, limit: int | None = SEARCH_CAP) -> DataFrame:
    """People of all sources that match, one row per name: key, name, office, sources, found (source -> body).

    The name is the first in source order, the office the last that is not empty; of each source the last record (by
    name, office and id) is kept.
    """
    at = F.struct("place", "name", "office", "id")
    one = hits(spark, path, query).groupBy("key", "source").agg(
        F.min("place").alias("place"), F.min(at).alias("first"), F.max(F.struct(at.alias("at"), "body")).alias("last"),
        F.max(F.when(F.col("office") != "", at)).alias("office"))
    found = one.groupBy("key").agg(
        F.min("first")["name"].alias("name"), F.max("office")["office"].alias("office"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", F.col("last.body"))))).alias("found"),
        F.min("place").alias("place"),
    ).orderBy("place", "key").drop("place")
    return found if limit is None else found.limit(limit)
