"""The domain tables derived from the order, event and directory tables at hand.

Every row of the source tables is used; attributes come from real columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ANCHOR = "2001-08-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _floor(c) -> Column:
    return F.floor(c).cast("bigint")


def _first_lines(lines: DataFrame) -> DataFrame:
    """The first line of every order, as one combinable aggregate."""
    order = ["l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_returnflag",
             "l_linestatus", "l_shipdate"]
    return lines.groupBy("l_orderkey").agg(F.min(F.struct(*order)).alias("x")).select("l_orderkey", "x.*")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    t = lambda name: table(spark, folder, name)
    nation = t("nation").select("n_nationkey", "n_name")
    customers = t("customer").join(nation.withColumnsRenamed(
        {"n_nationkey": "c_nationkey", "n_name": "city"}), "c_nationkey")
    suppliers = t("supplier").select("s_suppkey", "s_name", "s_nationkey").join(
        nation.withColumnsRenamed({"n_nationkey": "s_nationkey", "n_name": "s_nation"}), "s_nationkey")
    first = _first_lines(t("lineitem")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    rows = (
        t("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    closed = F.col("o_orderstatus") == "F"
    day = F.col("o_orderdate").cast("date")
    text = lambda c: F.col(c).cast("string")
    return rows.select(
        F.concat(F.lit("L"), text("o_orderkey")).alias("detail_url"),
        text("o_orderkey").alias("mls_number"),
        F.concat(text("l_partkey"), F.lit(" Summer Street")).alias("address"),
        "city", F.lit("ME").alias("state"), F.lpad(text("c_custkey"), 5, "0").alias("zip"),
        F.when(closed, _floor("o_totalprice")).alias("sale_price"),
        (_floor("o_totalprice") + _floor(F.coalesce("l_extendedprice", F.lit(0.0)))).alias("list_price"),
        F.col("l_linenumber").alias("beds"), (F.col("l_linenumber") / 2).alias("baths"),
        F.floor(F.col("o_totalprice") / 100).cast("int").alias("sqft"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Single Family Residential")
        .when(F.col("c_mktsegment") == "BUILDING", "Condo/Co-op")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "Commercial")
        .when(F.col("c_mktsegment") == "FURNITURE", "Land").alias("property_type"),
        F.abs(F.datediff("l_shipdate", "o_orderdate")).alias("days_on_market"),
        F.when(closed, day).alias("close_date"), day.alias("list_date"),
        F.col("s_name").alias("listing_agent"), F.col("s_nation").alias("listing_office"),
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("listing_agent_email"),
        text("l_suppkey").alias("listing_agent_id"),
        F.col("c_name").alias("buyer_agent"), F.col("c_mktsegment").alias("buyer_office"),
        F.when(F.col("o_orderpriority") != "5-LOW", "success")
        .when(F.col("l_linestatus") == "F", "error").alias("enrichment_status"),
        F.coalesce("l_linenumber", F.lit(0)).alias("enrichment_attempts"),
        F.col("o_orderdate").alias("discovered_at"),
        F.coalesce("l_shipdate", "o_orderdate").alias("last_seen_at"),
        F.when(closed, "Closed").when(F.col("o_orderstatus") == "O", "Active")
        .otherwise("Pending").alias("status"),
        F.year("o_orderdate").alias("year_built"), F.col("l_linenumber").alias("lot_sqft"),
        F.col("o_orderpriority").alias("description"), F.lit(None).cast("string").alias("photo_url"),
        F.when(F.col("l_linestatus") == "O", "feed_b").otherwise("feed_a").alias("data_source"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("https://example.com/sale/"), text("o_orderkey")))
        .alias("source_url"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return listings(spark, folder).withColumn("sale_date", F.col("list_date")).drop("close_date")


def observations(spark: SparkSession, folder: str) -> DataFrame:
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    return table(spark, folder, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("detail_url"),
        F.col("ts").alias("observed_at"), F.col("event_id").alias("seq"),
        F.when(kind == "click", "Pending").when(kind == "purchase", "Closed")
        .when(kind != "error", "Active").alias("status"),
        F.when(F.col("value") >= 5, _floor(F.col("value") / 20) * 20).alias("list_price"),
        F.when(kind == "purchase", _floor("value")).alias("sale_price"),
        F.when(F.col("value") < 40, kind).alias("listing_office"),
        F.when(kind != "view", F.concat(F.lit("agent "), k)).alias("listing_agent"),
        F.when(kind == "error", "error").otherwise("success").alias("outcome"),
        F.col("ts").cast("date").alias("run"),
        F.concat(F.lit("T"), F.substring(k, 1, 1)).alias("town"), k.cast("int").alias("page"),
    )


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select("n_nationkey", "n_name")


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    money = F.col("s_acctbal")
    rows = table(spark, folder, "supplier").join(
        _nations(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
    direct = money < 500
    return rows.select(
        F.concat(F.lit("https://example.com/profile/"), F.col("s_suppkey").cast("string")).alias("profile_url"),
        F.when(direct, "brokerage").when(money < 2500, "team").otherwise("individual").alias("profile_type"),
        F.when(direct, F.col("n_name")).otherwise(F.col("s_name")).alias("profile_name"),
        F.when((money <= 9500) & ~direct, F.col("n_name")).alias("office_name"),
        F.when(money <= 9000, F.floor(money / 10).cast("int")).alias("sales_last_12_months"),
        F.floor(money).cast("int").alias("total_sold"),
        F.when(money < 1000, F.lit(0).cast("bigint")).otherwise(_floor(money * 100)).alias("avg_price_3yr"),
        F.lit(None).cast("string").alias("price_range"),
        F.when(money < 3000, None).when(money < 4000, "failed").when(money < 5000, "captcha")
        .otherwise("success").alias("scrape_status"),
        F.col("s_nationkey").alias("scrape_attempts"),
        F.when(money > 1000, "success").alias("enrichment_status"),
        F.col("s_nationkey").alias("for_sale_count"),
    )


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line as a sale of its supplier to its customer's town.

    Orders learn their towns before lines learn their orders, and prices are whole by then: lines are dealt once, and narrow.
    """
    t = lambda name: table(spark, folder, name)
    lines = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", _floor("l_extendedprice").alias("sale_price"))
    orders = (
        t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def profile_towns(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _sales(spark, folder).groupBy("l_suppkey", F.col("n_name").alias("town"))
        .agg(F.count(F.lit(1)).cast("int").alias("local_sales_count"))
        .select(F.concat(F.lit("https://example.com/profile/"), F.col("l_suppkey").cast("string")).alias("profile_url"),
                "town", "local_sales_count")
    )


def sold(spark: SparkSession, folder: str) -> DataFrame:
    """One sold row per profile and order."""
    picked = table(spark, folder, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(
        F.min(F.struct("l_extendedprice", "l_returnflag", "l_shipdate")).alias("x"))
    return picked.select(
        F.concat(F.lit("https://example.com/profile/"), F.col("l_suppkey").cast("string")).alias("profile_url"),
        F.col("l_orderkey").cast("string").alias("zpid"), F.col("l_orderkey").alias("seq"),
        F.date_format("x.l_shipdate", "yyyy-MM-dd").alias("sold_date"),
        _floor("x.l_extendedprice").alias("closing_price"),
        F.when(F.col("x.l_returnflag") == "A", "Seller").when(F.col("x.l_returnflag") == "N", "Buyer")
        .otherwise("Buyer and Seller").alias("represented"),
        F.lit("").alias("city_state"), F.lit("").alias("address"),
        F.lit(None).cast("string").alias("beds"), F.lit(None).cast("string").alias("baths"))


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sale lines with raw address parts; flags A and N are team sales, N and R individual."""
    return _sales(spark, folder).select(
        F.concat(F.col("l_partkey").cast("string"), F.lit(" Summer Street #"),
                 F.col("l_linenumber").cast("string")).alias("address"),
        F.col("n_name").alias("city"), F.lit("ME").alias("state"),
        F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("zip"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        "sale_price",
        F.when(F.col("l_linestatus") == "F", "Seller").otherwise("buyer").alias("represented_side"),
        F.col("l_returnflag").alias("flag"), F.col("l_suppkey"), F.col("l_orderkey"),
        F.concat(F.lit("https://example.com/profile/"), F.col("l_suppkey").cast("string")).alias("profile_url"))


def keyed_sales(spark: SparkSession, folder: str) -> DataFrame:
    from gableboard.functions.keys import computed, match_key, with_address

    rows = with_address(raw_sales(spark, folder))
    return computed(rows, transaction_match_key=match_key("normalized_address_hash", "sale_date", "sale_price"))


def team_and_individual(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = keyed_sales(spark, folder)
    team = rows.filter(F.col("flag").isin("A", "N")).select(
        F.col("profile_url").alias("team_profile_url"),
        F.concat(F.lit("Team "), F.col("l_suppkey").cast("string")).alias("team_name"),
        F.col("city").alias("local_town"), "represented_side", "sale_date", "sale_price",
        F.concat(F.lit("https://example.com/home/"), F.col("l_orderkey").cast("string")).alias("property_url"),
        "transaction_match_key")
    individual = rows.filter(F.col("flag").isin("N", "R")).select(
        F.lower("represented_side").alias("represented_side"), "transaction_match_key", "city")
    return team, individual


def part_agents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_name").alias("listing_agent"), F.col("p_brand").alias("listing_office"))
