"""Change history and current state from a stream of observations, batch by batch.

Each micro-batch is merged with ordinary DataFrame operators. Everything a batch writes
goes to its own `bid=<batch>` folder, which a replay overwrites, and a batch reads only
folders of earlier batches: repeating a batch repeats its result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from gableboard import schemas
from gableboard.operators.grouping import with_previous
from gableboard.operators.history import change_kind
from gableboard.operators.merge import Rules, combined, merged_of, partial

_BID = StructType([StructField("bid", LongType(), True)])


def _earlier(spark: SparkSession, path: str, schema: StructType, batch: int, since: int = 0) -> DataFrame:
    """Rows of the batches in `[since, batch)`; nothing if none was written."""
    full = StructType(schema.fields + _BID.fields)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).option("basePath", path).parquet(path)
    return rows.filter((F.col("bid") >= since) & (F.col("bid") < batch))


def _write(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/bid={batch}")


_TAIL = StructType([
    f for f in schemas.HISTORY.fields if f.name in ("detail_url", "snapshot_date", "status", "list_price")])


@dataclass(frozen=True)
class ChangeLog:
    """`foreachBatch` target that appends changed observations to `<path>/history`.

    `<path>/tail` holds the last logged row per key: the keys a batch changed, and every
    `compact` batches all keys, so that a batch reads at most `compact` folders of it.
    Rows that arrive after a later row of their key was logged count as seen on arrival.
    Each logged row says its kind: new, withdrawn or changed.
    """

    path: str
    compact: int = 50

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = batch_id - 1 - (batch_id - 1) % self.compact if batch_id else 0
        tails = _earlier(spark, f"{self.path}/tail", _TAIL, batch_id, base)
        last = tails.groupBy("detail_url").agg(
            F.max_by(F.struct("snapshot_date", "status", "list_price"), "bid").alias("t"))
        known = batch.filter(
            F.col("detail_url").isNotNull()
            & (F.col("status").isNotNull() | F.col("list_price").isNotNull()))
        heads = known.select("detail_url").distinct().join(last, "detail_url")
        # The logged row of a key comes before all of its rows in this batch.
        first = known.groupBy("detail_url").agg(F.min("observed_at").alias("_from"))
        seeds = heads.join(first, "detail_url").select(
            "detail_url", F.col("_from").alias("observed_at"),
            F.lit(-(1 << 62)).cast("long").alias("seq"), F.col("t.status").alias("status"),
            F.col("t.list_price").alias("list_price"), F.lit(True).alias("_seed"))
        rows = known.select(
            "detail_url", "observed_at", "seq", "status", "list_price", F.lit(False).alias("_seed"))
        marked = with_previous(
            rows.unionByName(seeds), "detail_url", ["status", "list_price"])
        same = F.equal_null("status", "prev_status") & F.equal_null("list_price", "prev_list_price")
        changed = marked.filter(~F.col("_seed") & ~(F.col("has_prev") & same)).select(
            "detail_url", F.col("observed_at").alias("snapshot_date"), "seq", "status", "list_price",
            change_kind().alias("kind"))
        _write(changed, f"{self.path}/history", batch_id)

        logged = _earlier(spark, f"{self.path}/history", schemas.HISTORY, batch_id + 1, batch_id)
        new_tail = logged.groupBy("detail_url").agg(
            F.max_by(F.struct("snapshot_date", "status", "list_price"), F.struct("snapshot_date", "seq")).alias("t"))
        if batch_id % self.compact == 0 and batch_id:
            kept = last.join(new_tail.select("detail_url"), "detail_url", "left_anti")
            new_tail = kept.unionByName(new_tail)
        _write(new_tail.select("detail_url", "t.*"), f"{self.path}/tail", batch_id)

    def history(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schemas.HISTORY).parquet(f"{self.path}/history").drop("bid")

    def start(self, observations: DataFrame, checkpoint: str) -> StreamingQuery:
        """Process what is there and stop; run again for what came since."""
        return (
            observations.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


@dataclass(frozen=True)
class CurrentState:
    """`foreachBatch` target that keeps mergeable states, one row per key that a batch touched.

    A batch writes the merged states of its own keys to `<path>/tail/bid=<batch>` and reads
    nothing. Every `compact` batches the tails since the last base and that base become a
    new one, `<path>/base/bid=<batch>`: the only time that all keys are written. `current`
    puts a base and the tails after it together. Values win by the rules' order, counts
    add up, so the result is that of merging the whole log, whatever the order of arrival.
    """

    path: str
    rules: Rules
    schema: StructType
    compact: int = 20

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        _write(partial(batch, self.rules), f"{self.path}/tail", batch_id)
        if (batch_id + 1) % self.compact == 0:
            _write(self._state(batch.sparkSession, batch.schema, batch_id, batch_id), f"{self.path}/base", batch_id)

    def _state(self, spark: SparkSession, observed: StructType, batch_id: int, before: int) -> DataFrame:
        """The state after a batch, from the newest base older than batch `before`."""
        layout = partial(spark.createDataFrame([], observed), self.rules).schema
        base = before // self.compact * self.compact - 1
        old = _earlier(spark, f"{self.path}/base", layout, base + 1, base)
        new = _earlier(spark, f"{self.path}/tail", layout, batch_id + 1, base + 1)
        return combined(old.unionByName(new).drop("bid"), self.rules)

    def current(self, spark: SparkSession, observed: StructType, batch_id: int) -> DataFrame:
        """The merged rows after a batch; `observed` is the schema of the observations."""
        return merged_of(self._state(spark, observed, batch_id, batch_id + 1), self.rules).select(*self.schema.names)
