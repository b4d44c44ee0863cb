from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gableboard import schemas
from gableboard.operators import history, merge
from gableboard.streaming.changes import ChangeLog, CurrentState
from gableboard.streaming.live import daily_counts, logged, withdrawn

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def observations(spark):
    from gableboard.plans import driver_tables
    return driver_tables.observations(spark, SF).select(
        "detail_url", F.col("observed_at").cast("timestamp").alias("observed_at"), "seq", "status", "list_price")


def in_slices(df, path, edges):
    """Write the rows as one file per slice, in order of time."""
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        part = df.filter((F.col("observed_at") >= F.lit(lo)) & (F.col("observed_at") < F.lit(hi)))
        part.coalesce(1).write.mode("append").parquet(f"{path}/slice={i}")
        yield path


@pytest.mark.parametrize("compact", [50, 2])
def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path, compact):
    df = observations(spark)
    edges = [START, START + timedelta(days=9), START + timedelta(days=10), START + timedelta(days=22),
             START + timedelta(days=40)]
    log = ChangeLog(str(tmp_path / "log"), compact=compact)
    source = str(tmp_path / "in")
    for path in in_slices(df, source, edges):
        stream = spark.readStream.schema(schemas.OBSERVATION).parquet(f"{path}/slice=*")
        log.start(stream, str(tmp_path / "cp")).awaitTermination()
    want = sorted(map(str, history.changes(df, kinds=True).collect()))
    assert sorted(map(str, log.history(spark).collect())) == want
    last = df.filter((F.col("observed_at") >= F.lit(edges[3])))
    log(last, 3)
    assert sorted(map(str, log.history(spark).collect())) == want


@pytest.mark.parametrize("compact", [2, 50])
def test_current_state_by_batches_equals_one_merge(spark, tmp_path, compact):
    """Batches in any order, one of them twice; counts and largest values too."""
    rules = merge.Rules(keys=("detail_url",), latest_known=("status", "list_price"), latest=("note",), first=("town", "day"), largest=("top",), count="seen")
    df = observations(spark).withColumns({
        "town": F.concat(F.lit("T"), F.col("seq").cast("string")), "day": F.to_date("observed_at"),
        "note": F.when(F.col("seq") % 3 == 0, F.col("seq").cast("string")), "top": F.col("seq") % 100})
    df = df.union(df.limit(3).withColumn("detail_url", F.lit(None).cast("string")))
    schema = merge.merge(df, rules).schema
    state = CurrentState(str(tmp_path / "state"), rules, schema, compact)
    slices = [df.filter(F.floor(F.dayofmonth("observed_at") / 7) == k) for k in (3, 0, 4, 1, 2)]
    for i, part in enumerate(slices):
        state(part, i)
    state(slices[4], 4)
    want = sorted(map(str, merge.merge(df, rules).select(*schema.names).collect()))
    assert sorted(map(str, state.current(spark, df.schema, 4).collect())) == want
    upto = slices[0].union(slices[1]).union(slices[2])
    assert sorted(map(str, state.current(spark, df.schema, 2).collect())) == sorted(map(str, merge.merge(upto, rules).select(*schema.names).collect()))
    one = slices[2].filter("detail_url = 'U1'")
    state(one, 5)
    written = spark.read.parquet(str(tmp_path / "state" / "tail" / "bid=5"))
    assert written.count() == one.select("detail_url").distinct().count() <= 1


def run_to_memory(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def test_rows_without_time_or_key_in_the_stream(spark, tmp_path):
    rows = [("a", None, 1, "Active", 1), (None, START, 2, "Active", 1), ("a", START, 3, "Active", 2), ("a", START, None, "Closed", 3), ("b", START, 4, None, None)]
    ChangeLog(str(tmp_path / "log"))(spark.createDataFrame(rows, schemas.OBSERVATION), 0)
    got = ChangeLog(str(tmp_path / "log")).history(spark).collect()
    assert {r.detail_url for r in got} == {"a"}
    assert sorted((r.status, r.kind) for r in got if r.snapshot_date is not None) == [("Active", "changed"), ("Closed", "new")]


def test_from_observations_to_final_days(spark, tmp_path):
    """Observations go into the change log, the log's rows into days; a replayed batch and a late row change no day."""
    df = observations(spark).withColumn("status", F.coalesce("status", F.lit("Withdrawn")))
    edges = [START + timedelta(days=n) for n in (0, 9, 10, 22, 40)]
    log, source = ChangeLog(str(tmp_path / "log")), str(tmp_path / "in")
    for i, path in enumerate(in_slices(df, source, edges)):
        stream = spark.readStream.schema(schemas.OBSERVATION).parquet(f"{path}/slice=*")
        log.start(stream, str(tmp_path / "cp")).awaitTermination()
        if i == 2:
            log(df.filter((F.col("observed_at") >= F.lit(edges[2])) & (F.col("observed_at") < F.lit(edges[3]))), 2)
        days = daily_counts(logged(spark, str(tmp_path / "log")), delay="2 days")
        days.writeStream.format("parquet").option("path", str(tmp_path / "days")).option("checkpointLocation", str(tmp_path / "cp2")).outputMode(
            "append").trigger(availableNow=True).start().awaitTermination()
        if i == 3:
            late = spark.createDataFrame([("late", edges[0], 1, "Active", 1)], schemas.OBSERVATION)
            log(late, 4)
    got = sorted(map(str, spark.read.parquet(str(tmp_path / "days")).collect()))
    changed = history.changes(df, kinds=True)
    newest = changed.agg(F.max("snapshot_date")).head()[0]
    final = (newest - timedelta(days=2)).date()
    want = sorted(map(str, history.daily_counts(changed).filter(F.col("day") < F.lit(final)).collect()))
    assert got == want and {"new", "changed", "withdrawn"} <= {k for k in ("new", "changed", "withdrawn") if any(k in x for x in got)}


SEEN = "detail_url string, observed_at timestamp, seq long, status string, list_price long"


def test_withdrawn_sessions(spark, tmp_path):
    day = lambda n: START + timedelta(days=n)
    rows = [
        ("gone", day(0), 1, "Active", 100), ("sold", day(0), 2, "Closed", 100), ("back", day(0), 3, "Pending", 5),
        ("kept", day(0), 5, "Active", 7), ("kept", day(6), 6, None, None), ("kept", day(12), 7, None, 8),
        ("back", day(19), 4, None, None), (None, None, 1, "Active", 1),
    ]
    table = spark.createDataFrame(rows, SEEN)
    want = [("back", day(7), 3, "Withdrawn", 5), ("gone", day(7), 1, "Withdrawn", 100), ("kept", day(19), 7, "Withdrawn", 8)]
    assert sorted(map(tuple, history.withdrawn(table).collect())) == want
    for i, row in enumerate(rows + [("tick", day(26), 9, "Closed", 1)]):
        spark.createDataFrame([row], SEEN).coalesce(1).write.mode("append").parquet(str(tmp_path / "w"))
    stream = spark.readStream.schema(SEEN).parquet(str(tmp_path / "w"))
    run_to_memory(withdrawn(stream), "withdrawn_test")
    assert sorted(map(tuple, spark.table("withdrawn_test").collect())) == want


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_withdrawn_stream_equals_batch_in_any_zone(spark, tmp_path, zone):
    df = observations(spark)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        second = F.unix_seconds("observed_at")
        lo, hi = df.agg(F.min(second), F.max(second)).head()
        for i in range(4):
            quarter = F.least(F.floor((second - lo) * 4 / (hi - lo)), F.lit(3))
            df.filter(quarter == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "o"))
        stream = spark.readStream.schema(schemas.OBSERVATION).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "o"))
        found = withdrawn(stream, stale_days=1, delay="10 days")
        run_to_memory(found, f"zone_{zone[-3:]}")
        got = sorted(map(str, spark.table(f"zone_{zone[-3:]}").collect()))
        ended = history.withdrawn(df, stale_days=1).filter(
            F.unix_micros("snapshot_date") < df.agg(F.max(F.unix_micros("observed_at"))).scalar() - 10 * 86_400_000_000)
        assert got == sorted(map(str, ended.collect())) and got
        text = ended._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Pandas" not in text
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
