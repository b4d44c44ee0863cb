"""What merges of sales send between tasks, and that it changes no value."""

import hashlib
import random
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from gableboard.operators import merge
from gableboard.plans import driver_tables

SALE = ("address string, city string, state string, zip string, sale_date {0}, sale_price string, represented_side string, agent_profile_url string, "
        "listing_agent string, listing_office string, observed_at int, seq string")
NOTHING = ("list_price", "beds", "baths", "sqft", "year_built", "days_on_market", "buyer_agent", "buyer_office", "source_url", "property_type",
           "profile_type", "local_directory_town", "attribution_confidence", "data_source")
TEAM = ("team_profile_url string, represented_side string, transaction_match_key string, team_name string, property_url string, local_town string, "
        "sale_date string, sale_price string, normalized_address string, normalized_address_hash string, created_at int, observed_at int, seq string")


@pytest.fixture
def fixed(spark):
    """Plans that run as they are first made, so that their counts can be read."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def sent(df):
    """Rows and bytes of all exchanges of a plan."""
    run = df._jdf.queryExecution()
    run.toRdd().count()

    def under(node):
        found = [0, 0]
        if node.nodeName() == "Exchange":
            found = [node.metrics().apply(m).value() for m in ("shuffleRecordsWritten", "dataSize")]
        children = node.children().iterator()
        while children.hasNext():
            found = [a + b for a, b in zip(found, under(children.next()), strict=True)]
        return found

    return under(run.executedPlan())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def team_log(spark, n, key="k{}", seq="{}", made=True):
    return spark.createDataFrame([
        (f"t{k}", "buyer", key and key.format(k), "name", "url", "town", "d", "$1", f"A{k}", sha(f"A{k}") if made else None, 1, 1, seq.format(k))
        for k in range(n)], TEAM)


def profile_log(spark, rows, kind="date"):
    log = spark.createDataFrame(rows, SALE.format(kind))
    return log.withColumns({c: F.lit(None).cast("string") for c in NOTHING} | {"scraped_at": F.col("observed_at")})


def sale(k, *, seq="{}", day=date(2024, 5, 1), url="u{}", side="Buyer", price="$1,000", agent="jane doe", at=1):
    return (f"{k} Main Street", "York", "ME", "03909", day, price, side, url.format(k), agent, "Office", at, seq.format(k))


def test_team_sales_do_not_send_hashes_that_addresses_give(spark, fixed):
    (rows, hashed), (_, bare) = [sent(merge.team_sales(team_log(spark, 200, made=m))) for m in (True, False)]
    assert rows == 200 and hashed - bare < 8 * rows


@pytest.mark.parametrize("key, most", [("k{}", 2), (None, 0)])
def test_team_sales_send_an_order_once_for_the_first_and_once_for_the_latest(spark, fixed, key, most):
    """A row without a key, which stays as it is, sends none."""
    rows, size = sent(merge.team_sales(team_log(spark, 100, key, "{}" + "x" * 5000)))
    assert rows == 100 and size < (most * 5000 + 2500) * rows


def test_team_sales_keep_hashes_of_their_own(spark):
    log = [("t", "buyer", k, None, None, None, None, "1", a, h, 1, 1, "1") for k, a, h in (
        ("made", "A", sha("A")), ("other", "A", "h"), ("none", "A", None), ("bare", None, "h"), (None, "A", "h"), (None, "B", sha("B")))]
    got = merge.team_sales(spark.createDataFrame(log, TEAM)).select("transaction_match_key", "normalized_address", "normalized_address_hash")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((k, a, h)) for *_, k, a, h in [(*r[:2], r[2], r[8], r[9]) for r in log])


@pytest.mark.parametrize("latest", [(), ("c", "e")])
def test_columns_together_merge_as_columns_apart(spark, latest):
    rng = random.Random(5)
    some = lambda: rng.choice([None, *"vwxyz"])
    rows = [(rng.choice([None, *range(60)]), k // 2, k, *(some() for _ in range(5))) for k in rng.sample(range(600), 600)]
    log = spark.createDataFrame(rows, "key int, observed_at int, seq int, a string, b string, c string, d string, e string").repartition(7)
    rules = merge.Rules(keys=("key",), latest_known=("a", "b", "d"), latest=latest, first=("e",), count="n")
    for together in (("a",), ("a", "b"), ("d", "b", "a")):
        got, want = merge.merge(log, replace(rules, together=together)), merge.merge(log, rules)
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())


def test_profile_sales_send_an_order_once_and_no_digest(spark, fixed):
    shown = ("observation_id", "normalized_address_hash", "transaction_match_key", "listing_agent", "listing_office", "represented_side")
    n = 100
    rows, size = sent(merge.profile_sales(profile_log(spark, [sale(k, seq="{}" + "x" * 5000) for k in range(n)])).select(*shown))
    assert rows == n and size < 7500 * n
    _, size = sent(merge.profile_sales(profile_log(spark, [sale(k) for k in range(n)])).select(*shown))
    assert size < 400 * n


@pytest.mark.parametrize("kind, days", [("date", (date(2024, 5, 1), None)), ("string", ("2024-05-01", ""))])
def test_profile_sales_digests_are_those_of_their_rows(spark, kind, days):
    rows = [sale(1, day=days[0], side="Buyer", at=1, agent="old name"), sale(1, day=days[0], side="BUYER", price="1000.7", at=2, agent=None),
            sale(1, day=days[0], side="seller"), sale(2, day=days[0], url="a|b{}"), sale(3, day=days[1]), sale(4, day=days[0], price="none"),
            sale(5, day=days[0], url=""), sale(6, day=days[0], side=None)]
    got = merge.profile_sales(profile_log(spark, rows, kind))
    assert got.columns == [*merge.PROFILE_SALE_RULES.keys, *merge.PROFILE_SALE_RULES.latest_known, *merge.PROFILE_SALE_RULES.latest,
                           *merge.PROFILE_SALE_RULES.first]
    assert dict(got.dtypes)["sale_date"] == kind
    want = []
    for k, url, side, agent in ((1, "u1", "BUYER", "Old Name"), (1, "u1", "seller", "Jane Doe"), (2, "a|b2", "Buyer", "Jane Doe")):
        place = f"{k} MAIN ST | YORK | ME | 03909"
        want.append((sha(f"{url}|{side.lower()}|{sha(place)}|2024-05-01|1000"), url, side, str(days[0]), 1000, place, sha(place),
                     sha(f"{sha(place)}|2024-05-01|1000"), agent))
    found = got.select("observation_id", "agent_profile_url", "represented_side", F.col("sale_date").cast("string"), "sale_price", "normalized_address",
                       "normalized_address_hash", "transaction_match_key", "listing_agent")
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_orders_learn_their_towns_before_lines_learn_their_orders(spark, fixed, tmp_path):
    """Each line is dealt once; dealt again by customer it would take the room of the whole table twice."""
    n, lines = 40, 400
    tables = {
        "nation": spark.range(2).selectExpr("cast(id as int) n_nationkey", "concat('N', id) n_name"),
        "customer": spark.range(n).selectExpr("id c_custkey", "cast(id % 2 as int) c_nationkey"),
        "orders": spark.range(n).selectExpr("id o_orderkey", "id o_custkey", "timestamp'2024-05-01' o_orderdate"),
        "lineitem": spark.range(lines).selectExpr(
            f"id % {n} l_orderkey", "id l_partkey", "id l_suppkey", "1 l_linenumber", "id + 0.5D l_extendedprice", "'A' l_returnflag", "'F' l_linestatus")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    sales = driver_tables.raw_sales(spark, str(tmp_path))
    rows, _ = sent(sales)
    assert rows <= lines + 4 * n + 2
    assert sorted(r.sale_price for r in sales.collect()) == [*range(lines)]
