"""Every registered query: a callable of (session, folder of tables) per name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gableboard import schemas
from gableboard.functions import keys, names, numbers, text as texts
from gableboard.operators import (
    boards, directory, fuzzy, history, index, kpis, live, merge, pages, queues, runs, scoped, search_index, teams,
)
from gableboard.plans import driver_tables as d, page_texts, report
from gableboard.plans.driver_tables import ANCHOR
from gableboard.session import shared_folder
from gableboard.sources import attribution, cards, details, directory as directory_source, property_json, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- period KPIs and movers -------------------------------------------------------------

@query
def agent_kpis(s, p):
    return kpis.agent(d.listings(s, p), today=ANCHOR)


@query
def agent_kpis_one_town(s, p):
    return kpis.agent(d.listings(s, p), today=ANCHOR, town="nation_3", limit=50)


@query
def brokerage_kpis(s, p):
    return kpis.brokerage(d.listings(s, p), today=ANCHOR)


@query
def agent_kpis_by_town_top50(s, p):
    return kpis.by_town(d.listings(s, p), "agent", today=ANCHOR)


@query
def brokerage_kpis_by_town_top50(s, p):
    return kpis.by_town(d.listings(s, p), "brokerage", today=ANCHOR)


_MOVER_COLUMNS = ["side", "position", "name", "current_12mo_sides", "prior_12mo_sides",
                  "current_rank", "prior_rank", "delta", "is_new", "delta_label", "volume_change_pct"]


@query
def rank_movers_agents(s, p):
    return kpis.movers(kpis.agent(d.listings(s, p), today=ANCHOR), banner=True).select(*_MOVER_COLUMNS)


@query
def rank_movers_brokerages(s, p):
    return kpis.movers(kpis.brokerage(d.listings(s, p), today=ANCHOR)).select(*_MOVER_COLUMNS)


@query
def agent_ranks(s, p):
    return kpis.ranked(kpis.agent(d.listings(s, p), today=ANCHOR)).select(
        "name", "current_rank", "prior_rank", "delta", "is_new")


# --- boards -----------------------------------------------------------------------------

@query
def side_board_listing(s, p):
    return boards.side(d.listings(s, p), "listing")


@query
def side_board_buyer(s, p):
    return boards.side(d.listings(s, p), "buyer")


@query
def side_board_one_town(s, p):
    return boards.side(d.listings(s, p), "listing", town="nation_3")


@query
def combined_board(s, p):
    return boards.combined(d.listings(s, p))


@query
def brokerage_board(s, p):
    return boards.brokerages(d.listings(s, p))


@query
def town_top5(s, p):
    return boards.combined_by_town(d.listings(s, p))


@query
def listing_stats(s, p):
    return boards.stats(d.listings(s, p))


@query
def listing_stats_all(s, p):
    return boards.stats(d.listings(s, p), all_statuses=True)


@query
def town_counts_thin(s, p):
    return boards.town_counts(d.listings(s, p), thin=160)


# --- scoped boards ----------------------------------------------------------------------

@query
def scoped_agents(s, p):
    return scoped.agents(d.transactions(s, p), source="feed_a")


@query
def scoped_agents_buyer_since(s, p):
    return scoped.agents(d.transactions(s, p), role="buyer", since="1999-01-01", town="nation_3")


@query
def scoped_brokerages(s, p):
    return scoped.brokerages(d.transactions(s, p), source="feed_b")


@query
def scoped_town_top5(s, p):
    return scoped.agents_by_town(d.transactions(s, p), role="buyer")


@query
def rankings(s, p):
    return scoped.rankings(d.transactions(s, p))


@query
def trend_agents(s, p):
    return scoped.agent_trends(d.transactions(s, p), today=ANCHOR)


@query
def trend_brokerages(s, p):
    return scoped.brokerage_trends(d.transactions(s, p), today=ANCHOR)


@query
def scoped_stats(s, p):
    return scoped.stats(d.transactions(s, p), source="feed_a")


@query
def scoped_breakdown(s, p):
    return scoped.breakdown(d.transactions(s, p))


@query
def enrichment_stats(s, p):
    return scoped.enrichment_stats(d.transactions(s, p))


# --- live listings and history ----------------------------------------------------------

@query
def live_listings(s, p):
    return live.active(d.listings(s, p), towns=["Nation_3", "Nation_4"], min_days_on_market=30,
                       include_pending=True)


@query
def stale_listings(s, p):
    return live.stale(d.listings(s, p))


def _order_history(s, p) -> DataFrame:
    """Two history rows per order, the later one first."""
    seen = F.explode(F.array(F.greatest("discovered_at", "last_seen_at"), F.least("discovered_at", "last_seen_at")))
    return d.listings(s, p).select(
        "detail_url", seen.alias("snapshot_date"),
        F.lit(0).cast("bigint").alias("seq"), "status", "list_price")


@query
def new_since(s, p):
    return live.new_since(d.listings(s, p), _order_history(s, p), "2000-01-01")


@query
def listing_timeline(s, p):
    return live.timeline(history.changes(d.observations(s, p)))


@query
def history_changes(s, p):
    return history.changes(d.observations(s, p))


@query
def history_carry_forward(s, p):
    return history.changes(d.observations(s, p), carry_forward=True)


@query
def latest_state(s, p):
    return history.latest(d.observations(s, p).select("detail_url", "observed_at", "seq", "status", "list_price"))


@query
def first_seen(s, p):
    return live.first_seen(history.changes(d.observations(s, p)))


@query
def withdrawn_sweep(s, p):
    return history.sweep(d.listings(s, p), datetime(2001, 8, 1)).select(
        "detail_url", "status", "swept", "last_seen_at")


@query
def sweep_history(s, p):
    return history.sweep_history(d.listings(s, p), datetime(2001, 8, 1))


# --- merges -----------------------------------------------------------------------------

def _listing_log(s, p) -> DataFrame:
    return d.observations(s, p).select(
        "detail_url", "observed_at", "seq", "sale_price", "list_price", "listing_office", "status",
        F.col("observed_at").alias("last_seen_at"), F.col("listing_agent").alias("address"),
        F.col("town").alias("city"), F.lit("ME").alias("state"), F.lit(None).cast("string").alias("zip"),
        F.col("page").alias("beds"), F.lit(None).cast("double").alias("baths"),
        F.col("page").alias("sqft"), F.col("observed_at").alias("discovered_at"))


@query
def merge_listings(s, p):
    return merge.merge(_listing_log(s, p), merge.LISTING_RULES).select(
        "detail_url", "sale_price", "list_price", "listing_office", "status", "last_seen_at",
        "address", "city", "beds", "discovered_at")


@query
def merge_enrichment(s, p):
    log = d.observations(s, p)
    nothing = lambda kind: F.lit(None).cast(kind)
    log = log.withColumns({
        "mls_number": F.col("town"), "list_date": F.col("run"), "year_built": F.col("page"),
        "lot_sqft": F.col("page"), "description": nothing("string"), "photo_url": nothing("string"),
        "listing_agent_id": nothing("string"), "listing_agent_email": nothing("string"),
        "buyer_agent": F.col("listing_office"), "buyer_agent_id": nothing("string"),
        "buyer_agent_email": nothing("string"), "buyer_office": nothing("string"),
        "close_date": F.col("run"), "property_type": F.col("listing_agent"),
        "days_on_market": F.col("page"),
    })
    return merge.listing_details(log).select(
        "detail_url", "enrichment_status", "enrichment_attempts", "enriched_at", "mls_number",
        "listing_office", "sale_price", "list_price", "status", "listing_agent", "buyer_agent",
        "close_date", "days_on_market")


@query
def merge_transactions(s, p):
    raw = d.raw_sales(s, p)
    log = raw.select(
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string")).alias("mls_number"),
        F.col("sale_date").cast("timestamp").alias("observed_at"),
        F.struct("l_suppkey", "flag", "sale_price", "address", "represented_side").alias("seq"),
        F.when(F.col("flag") != "R", F.concat(F.lit("$"), F.format_number("sale_price", 0))).alias("sale_price"),
        F.lit("n/a").alias("list_price"),
        F.concat(F.lit("jane o'brien-"), F.col("flag"), F.lit(", CRS")).alias("listing_agent"),
        F.when(F.col("flag") == "N", F.lit("  ")).otherwise("JOHN SMITH (Broker)").alias("buyer_agent"),
        F.lit("LandVest, INC.").alias("listing_office"), F.lit("Red Post Realty ").alias("buyer_office"),
        "sale_date", F.lit(None).cast("string").alias("property_type"),
        F.col("sale_date").cast("timestamp").alias("scraped_at"), "address", "city", "state", "zip",
        F.lit("3").alias("beds"), F.lit("2.5").alias("baths"), F.lit("1,800").alias("sqft"),
        F.lit("").alias("year_built"), F.lit("12.9").alias("days_on_market"),
        F.lit(None).cast("string").alias("source_url"), F.lit("feed_a").alias("data_source"))
    return merge.transactions(log).select(
        "mls_number", "sale_price", "listing_agent", "buyer_agent", "listing_office",
        "buyer_office", "beds", "baths", "sqft", "year_built", "days_on_market", "address")


@query
def merge_profile_sales(s, p):
    raw = d.raw_sales(s, p)
    nothing = F.lit(None).cast("string")
    log = raw.select(
        "address", "city", "state", "zip", "sale_date", "sale_price", "represented_side",
        F.col("profile_url").alias("agent_profile_url"),
        F.col("sale_date").cast("timestamp").alias("observed_at"),
        F.struct("l_orderkey", "flag").alias("seq"),
        F.col("sale_date").cast("timestamp").alias("scraped_at"),
        *[nothing.alias(c) for c in (
            "list_price", "beds", "baths", "sqft", "year_built", "days_on_market", "buyer_agent",
            "buyer_office", "source_url", "property_type", "profile_type", "local_directory_town",
            "attribution_confidence")],
        F.lit("jane doe").alias("listing_agent"), F.lit("Samonas Realty").alias("listing_office"),
        F.lit("profiles").alias("data_source"))
    return merge.profile_sales(log).select(
        "observation_id", "agent_profile_url", "represented_side", "sale_price", "sale_date",
        "normalized_address", "transaction_match_key", "listing_agent", "listing_office")


@query
def merge_profiles(s, p):
    log = d.observations(s, p).select(
        F.col("detail_url").alias("profile_url"), "observed_at", "seq",
        F.col("listing_agent").alias("raw_card_text"), F.col("listing_office").alias("profile_name"),
        F.col("status").alias("office_name"), F.col("page").alias("sales_last_12_months"),
        F.lit(None).cast("string").alias("price_range"), F.col("outcome").alias("profile_type"),
        F.col("observed_at").alias("discovered_at"))
    return merge.merge(log, merge.PROFILE_RULES)


@query
def merge_profile_towns(s, p):
    log = d.observations(s, p).select(
        F.col("detail_url").alias("profile_url"), "town", "observed_at", "seq",
        F.col("page").alias("local_sales_count"), F.col("observed_at").alias("discovered_at"))
    return merge.merge(log, merge.PROFILE_TOWN_RULES)


@query
def merge_sold_rows(s, p):
    log = d.observations(s, p).select(
        F.col("detail_url").alias("profile_url"), F.col("town").alias("zpid"), "observed_at", "seq",
        F.col("run").cast("string").alias("sold_date"), F.col("sale_price").alias("closing_price"),
        F.col("status").alias("represented"), F.col("listing_agent").alias("address"),
        F.lit("").alias("city_state"), F.lit(None).cast("string").alias("beds"),
        F.lit(None).cast("string").alias("baths"), F.col("observed_at").alias("created_at"))
    return merge.merge(log, merge.SOLD_ROW_RULES)


@query
def member_profiles(s, p):
    profiles = d.profiles(s, p).withColumn("discovered_at", F.lit(None).cast("timestamp"))
    members = d.table(s, p, "lineitem").groupBy("l_suppkey", "l_partkey").agg(
        F.min("l_shipdate").alias("discovered_at")).select(
        F.col("l_suppkey").alias("team_profile_url"),
        F.concat(F.lit("https://example.com/profile/"), (F.col("l_partkey") * 2).cast("string")).alias("member_profile_url"),
        F.concat(F.lit("Member "), F.col("l_suppkey").cast("string")).alias("member_name"), "discovered_at")
    return merge.member_profiles(profiles, members).select("profile_url", "profile_type", "profile_name")


@query
def merge_profile_status(s, p):
    log = d.observations(s, p)
    failed = F.col("outcome") != "success"
    made = log.select(
        F.col("detail_url").alias("profile_url"), "observed_at", "seq", F.col("listing_agent").alias("profile_name"),
        F.col("listing_office").alias("office_name"), F.col("page").cast("string").alias("sales_last_12_months"),
        F.format_number(F.col("list_price") * 100, 0).alias("total_sales"),
        F.concat(F.lit("$"), F.format_number(F.col("sale_price") * 1000, 0)).alias("average_price"),
        F.when(F.col("page") > 50, F.col("town")).alias("price_range"), F.col("outcome").alias("scrape_status"),
        F.when(failed, F.col("town")).alias("last_error"), F.col("observed_at").alias("last_scraped_at"))
    return merge.profile_status(made)


@query
def merge_team_members(s, p):
    log = d.table(s, p, "lineitem").select(
        F.col("l_suppkey").alias("team_profile_url"), (F.col("l_partkey") % 50).alias("member_profile_url"),
        F.when(F.col("l_returnflag") != "R", F.concat(F.lit("Part "), F.col("l_partkey").cast("string"), F.col("l_returnflag")))
        .alias("member_name"), F.col("l_shipdate").alias("observed_at"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").alias("seq"), F.col("l_shipdate").alias("discovered_at"))
    return merge.team_members(log)


@query
def merge_team_sales(s, p):
    """Keys of two digits, so that sales of a team meet; lines of flag R have none."""
    log = d.keyed_sales(s, p).select(
        F.col("profile_url").alias("team_profile_url"), F.lower("represented_side").alias("represented_side"),
        F.when(F.col("flag") != "R", F.substring("transaction_match_key", 1, 2)).alias("transaction_match_key"),
        F.when(F.col("flag") == "A", F.concat(F.lit("Team "), F.col("l_suppkey").cast("string"))).alias("team_name"),
        F.concat(F.lit("https://example.com/home/"), F.col("l_orderkey").cast("string")).alias("property_url"),
        F.when(F.col("sale_price") > 30000, F.col("city")).alias("local_town"), "sale_date",
        F.concat(F.lit("$"), F.format_number("sale_price", 0)).alias("sale_price"), "normalized_address",
        "normalized_address_hash", F.col("sale_date").cast("timestamp").alias("created_at"),
        F.col("sale_date").cast("timestamp").alias("observed_at"),
        F.struct("l_orderkey", "flag", F.col("sale_price").alias("price"), "normalized_address").alias("seq"))
    return merge.team_sales(log)


# --- runs and queues --------------------------------------------------------------------

@query
def run_deltas(s, p):
    return runs.deltas(d.observations(s, p))


@query
def run_anomaly(s, p):
    """A run is a minute, so that quiet ones occur."""
    log = d.observations(s, p).withColumn("run", F.date_trunc("minute", "observed_at"))
    return runs.anomalies(runs.deltas(log), towns_expected=1)


@query
def run_outcome(s, p):
    """Two runs a day, a large and a small one."""
    part = F.when(F.col("page") < 75, "day").otherwise("night")
    log = d.observations(s, p).withColumn("run", F.concat_ws(" ", F.col("run").cast("string"), part))
    return runs.outcomes(log)


@query
def all_known_pages(s, p):
    return runs.known_pages(d.observations(s, p))


@query
def daily_change_counts(s, p):
    """An observation without a status is a withdrawal, so that every kind occurs."""
    log = d.observations(s, p).withColumn("status", F.coalesce("status", F.lit("Withdrawn")))
    return history.daily_counts(history.changes(log, kinds=True))


@query
def withdrawn_sessions(s, p):
    """Sightings of a user less than two days apart are a session."""
    return history.withdrawn(d.observations(s, p), stale_days=2)


@query
def retry_queue_listings(s, p):
    return queues.listings_to_retry(d.listings(s, p))


@query
def retry_queue_transactions(s, p):
    return queues.transactions_to_retry(d.transactions(s, p))


@query
def retry_queue_profiles(s, p):
    return queues.profiles_to_retry(d.profiles(s, p))


@query
def enrich_queue_profiles(s, p):
    return queues.profiles_to_enrich(d.profiles(s, p))


@query
def purge_preview(s, p):
    return queues.purge_preview(d.transactions(s, p))


@query
def purge_types(s, p):
    return queues.purge(d.transactions(s, p)).select("mls_number", "property_type", "city")


# --- names and keys ---------------------------------------------------------------------

@query
def normalized_agents(s, p):
    raw = F.concat(F.lit("  jane  o'BRIEN-"), F.lower("c_mktsegment"), F.lit(" "), F.col("c_name"),
                   F.lit(", CRS, e-PRO (Broker) realtor."))
    return d.table(s, p, "customer").select("c_custkey", names.agent_name(raw).alias("agent"))


@query
def normalized_places(s, p):
    n = d.table(s, p, "customer")
    segment = F.col("c_mktsegment")
    place = (
        F.when(segment == "BUILDING", " York Beach ").when(segment == "HOUSEHOLD", "OOB")
        .when(segment == "MACHINERY", "Saco").otherwise(F.concat(F.lit(" "), F.col("c_name"))))
    office = F.when(segment == "BUILDING", "LANDVEST, INC. ").otherwise(F.concat(F.lit(" "), segment))
    slug = F.when(segment == "BUILDING", "old-orchard_beach").otherwise(segment)
    return n.select(
        "c_custkey", names.place_name(place).alias("town"), names.office_name(office).alias("office"),
        names.in_towns(names.place_name(place)).alias("listed"), names.town_spelling(slug).alias("spelled"))


@query
def address_keys(s, p):
    return d.keyed_sales(s, p).select(
        "l_orderkey", "l_suppkey", "flag", "normalized_address", "normalized_address_hash")


@query
def match_keys(s, p):
    rows = d.keyed_sales(s, p)
    return rows.select("l_orderkey", "l_suppkey", "flag", "transaction_match_key", keys.observation_id(
        "profile_url", "represented_side", "normalized_address_hash", "sale_date", "sale_price").alias("observation_id"))


@query
def split_addresses(s, p):
    rows = d.raw_sales(s, p)
    town = F.when(F.col("flag") == "A", "Old Orchard Beach").when(F.col("flag") == "N", "york").otherwise("Bath")
    line = F.concat(F.col("address"), F.lit(" "), town, F.lit(", ME "), F.col("zip"))
    return rows.select("l_orderkey", "flag", keys.split_address(line).alias("x")).select("l_orderkey", "flag", "x.*")


# --- team gap and fuzzy merge -----------------------------------------------------------

@query
def team_gap(s, p):
    return teams.gap(*d.team_and_individual(s, p))


@query
def team_gap_summary(s, p):
    return teams.gap_summary(teams.gap(*d.team_and_individual(s, p)))


@query
def team_gap_detail(s, p):
    return teams.gap_detail(teams.gap(*d.team_and_individual(s, p)))


@query
def cross_source_match(s, p):
    return teams.cross_source(*d.team_and_individual(s, p))


@query
def fuzzy_edges(s, p):
    rows = fuzzy.edges(fuzzy.name_counts(d.part_agents(s, p)), 80)
    return rows.withColumn("score", F.round("score", 6))


@query
def fuzzy_merge(s, p):
    return fuzzy.merge_names(d.part_agents(s, p), 80)


@query
def fuzzy_merge_chains(s, p):
    return fuzzy.merge_names(d.part_agents(s, p), 66)


# --- directory and indexes --------------------------------------------------------------

@query
def directory_agents(s, p):
    return directory.agents(d.profiles(s, p), d.profile_towns(s, p))


@query
def directory_agents_by_town(s, p):
    return directory.agents_by_town(d.profiles(s, p), d.profile_towns(s, p)).select(
        "town", "rank", "profile_url", "profile_name", "office_name", "local_sales_count")


@query
def directory_brokerages(s, p):
    return directory.brokerages(d.profiles(s, p), d.profile_towns(s, p))


@query
def directory_brokerages_once(s, p):
    return directory.brokerages(d.profiles(s, p), d.profile_towns(s, p), fanout=False, limit=None)


@query
def directory_brokerages_by_town(s, p):
    return directory.brokerages_by_town(d.profiles(s, p), d.profile_towns(s, p))


@query
def directory_stats(s, p):
    return directory.stats(d.profiles(s, p), d.profile_towns(s, p))


def _map_text(column: str, value) -> Column:
    return F.array_join(F.transform(F.map_entries(column), value), ";").alias(column)


@query
def agent_index(s, p):
    rows = index.agents(d.transactions(s, p), today=ANCHOR)
    value = lambda e: F.concat_ws("=", e["key"], e["value"]["sides"].cast("string"), e["value"]["volume"].cast("string"))
    return rows.withColumn("towns", _map_text("towns", value))


@query
def listing_index(s, p):
    return index.listing_agents(d.listings(s, p), today=ANCHOR).withColumn("towns", F.array_join("towns", "|"))


@query
def directory_index(s, p):
    rows = directory.index(d.profiles(s, p), d.profile_towns(s, p), d.sold(s, p), page_size=100)
    shown = F.transform("sold_rows", lambda r: F.concat_ws("=", r["date"], r["price"].cast("string"), r["side"]))
    return rows.select(
        "profile_url", "name", "office", "type", "enriched", "total_local_sales", "page",
        _map_text("towns", lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))),
        F.array_join(shown, ";").alias("sold_rows"))


@query
def sold_sides(s, p):
    return directory.sold_sides(d.sold(s, p))


@query
def cross_source_search(s, p):
    """A name over the three indexes, by postings; a figure of the record that each source has."""
    pages = directory.index(d.profiles(s, p), d.profile_towns(s, p), d.sold(s, p), page_size=100).filter("page = 0")
    sources = {
        "sales": (index.agents(d.transactions(s, p), today=ANCHOR), "name"),
        "profiles": (pages.drop("sold_rows"), "profile_url"),
        "listings": (index.listing_agents(d.listings(s, p), today=ANCHOR), "name"),
    }
    folder = shared_folder(s, "search-index")
    search_index.build(search_index.records(sources), folder)
    found = search_index.search(s, folder, "0000001", limit=None)
    figure = lambda source, field: F.get_json_object(F.col("found")[source], f"$.{field}").cast("long")
    return found.select(
        "key", "name", "office", "sources", figure("sales", "total_volume").alias("sales_volume"),
        figure("profiles", "total_local_sales").alias("local_sales"), figure("listings", "all_time_sides").alias("listing_sides"))


@query
def cross_source_scan(s, p):
    """The same question by comparing all names of the source tables."""
    sources = {
        "sales": d.transactions(s, p).select(F.col("listing_agent").alias("name"), F.col("listing_office").alias("office")),
        "profiles": d.profiles(s, p).select(F.col("profile_name").alias("name"), F.col("office_name").alias("office")),
        "listings": d.listings(s, p).select(F.col("buyer_agent").alias("name"), F.col("buyer_office").alias("office")),
    }
    return index.search(sources, "00000001", limit=None)


# --- stored tables ----------------------------------------------------------------------

def _stored(s, table: str, rows: DataFrame) -> DataFrame:
    folder = shared_folder(s, table)
    tables.publish(rows, table, folder)
    return tables.published(s, table, folder)


@query
def stored_listings(s, p):
    rows = _stored(s, "listings", d.listings(s, p))
    return rows.select("detail_url", "mls_number", "city", "status", "sale_price", "list_price", "beds", "baths", "close_date", "listing_agent", "scraped_at")


@query
def stored_transactions(s, p):
    rows = _stored(s, "transactions", d.transactions(s, p))
    return rows.select("mls_number", "sale_date", "sale_price", "listing_agent", "buyer_office", "data_source", "enrichment_attempts", "raw_buyer_agent")


@query
def stored_directory(s, p):
    profiles, towns = _stored(s, "profiles", d.profiles(s, p)), _stored(s, "profile_towns", d.profile_towns(s, p))
    return profiles.join(towns, "profile_url").select("profile_url", "town", "local_sales_count", "profile_type", "total_sold", "avg_price_3yr", "scrape_status")


@query
def legacy_listings(s, p):
    """Files of the layout before `status` and the newer columns, and files of today's, read as one table."""
    rows, folder = d.listings(s, p), shared_folder(s, "legacy")
    old = F.col("detail_url").endswith("1")
    merge.evolve(rows.filter(old), schemas.LISTING).drop("status", "list_date", "last_seen_at", "year_built", "lot_sqft", "description", "photo_url").write.parquet(f"{folder}/layout=1")
    tables.write(rows.filter(~old), "listings", f"{folder}/layout=2")
    return tables.read_legacy_listings(s, folder).select("detail_url", "status", "close_date", "list_date", "year_built", "sale_price")


@query
def stored_index(s, p):
    """The index sink, read back."""
    folder = shared_folder(s, "index")
    sinks.write_index(index.listing_agents(d.listings(s, p), today=ANCHOR), folder)
    return s.read.schema("name string, office string, total_sides long, towns array<string>, all_time_volume long, most_recent date").json(
        folder).withColumn("towns", F.array_join("towns", "|"))


@query
def stored_rankings(s, p):
    """The rankings table, rebuilt and read back."""
    folder = shared_folder(s, "rankings")
    sinks.write_rankings(d.transactions(s, p), folder)
    return s.read.parquet(folder).filter(F.col("last_updated").isNotNull()).drop("last_updated")


@query
def distinct_towns(s, p):
    return index.distinct_towns(kpis.agent(d.listings(s, p), today=ANCHOR))


@query
def sorted_board(s, p):
    return index.sorted_board(kpis.agent(d.listings(s, p), today=ANCHOR), "three_yr_volume", town="nation_3").select(
        "name", "office", "three_yr_volume", "primary_towns")


def _named(sections, *fields: str) -> DataFrame:
    """Sections with the first of `fields` that a row's body holds."""
    name = F.coalesce(*[F.get_json_object("body", f"$.{f}") for f in fields])
    return sinks.boards(sections).select("section", "scope", "rank", name.alias("name"))


def _figures(sections, names: list[str], counts: list[str], sums: list[str], lists: list[str]) -> DataFrame:
    """Sections with the figures of their bodies: of each kind the first field that a body holds."""
    first = lambda fields: F.coalesce(*[F.get_json_object("body", f"$.{f}") for f in fields])
    return sinks.boards(sections).select(
        "section", "scope", "rank", first(names).alias("name"), first(counts).cast("long").alias("sides"),
        first(sums).cast("long").alias("volume"), first(lists).alias("listed"))


@query
def kpi_report_figures(s, p):
    return _figures(report.kpi_report(d.listings(s, p), today=ANCHOR), ["name", "total"],
                    ["current_12mo_sides", "enriched"], ["all_time_volume", "volume"], ["primary_towns", "date_max"])


@query
def listing_report_figures(s, p):
    return _figures(report.listing_report(d.listings(s, p)), ["agent_name", "brokerage", "total", "n"],
                    ["total_sides", "sides", "has_buyer"], ["volume"], ["towns", "top_agents", "date_min", "thin"])


@query
def scoped_report_figures(s, p):
    return _figures(report.scoped_report(d.transactions(s, p), source="feed_a", today=ANCHOR), ["agent_name", "office", "value", "total"],
                    ["sides", "rank_change", "unique_agents", "n"], ["rolling_volume", "volume"], ["label", "towns", "date_max"])


@query
def gap_report_figures(s, p):
    return _figures(report.gap_report(*d.team_and_individual(s, p)), ["property_url", "local_town"],
                    ["unresolved", "sale_price"], ["sale_price"], ["sale_date"])


@query
def listing_report_rows(s, p):
    return _named(report.listing_report(d.listings(s, p)), "agent_name", "brokerage", "total", "n")


@query
def directory_report_rows(s, p):
    return _named(report.directory_report(d.profiles(s, p), d.profile_towns(s, p)),
                  "brokerage", "profile_url", "total_profiles")


@query
def scoped_report_rows(s, p):
    return _named(report.scoped_report(d.transactions(s, p), source="feed_a", today=ANCHOR),
                  "agent_name", "office", "value", "total")


@query
def profile_details(s, p):
    log = d.observations(s, p)
    made = log.select(
        F.col("detail_url").alias("profile_url"), "observed_at", "seq", "outcome",
        F.col("page").alias("total_sales"), F.col("page").alias("sales_last_12_months"),
        F.col("list_price").alias("average_price"), F.col("listing_agent").alias("screen_name"),
        F.col("page").alias("for_sale_count"), F.col("page").alias("total_sold"),
        F.col("sale_price").alias("avg_price_3yr"), F.col("list_price").alias("price_range_min"),
        F.col("list_price").alias("price_range_max"), F.col("listing_office").alias("last_error"))
    return merge.profile_details(made).select(
        "profile_url", "enrichment_status", "scrape_attempts", "last_error", "total_sales",
        "average_price", "screen_name", "avg_price_3yr")


@query
def member_links(s, p):
    """Every line as a link from its supplier's page to a part's page, and to itself."""
    text = lambda c: F.col(c).cast("string")
    own = F.concat(F.lit("https://example.com/profile/"), text("l_suppkey"))
    links = d.table(s, p, "lineitem").select(
        own.alias("profile_url"), F.struct("l_orderkey", "l_linenumber").alias("position"),
        F.concat(F.lit("https://example.com/profile/"), text("l_partkey")).alias("href"),
        F.concat(F.lit(" Part  "), text("l_partkey"), F.lit(" ")).alias("text"))
    return directory_source.member_links(links).drop("position")


# --- text and nested sources ------------------------------------------------------------

_CARD_COLUMNS = ["page_id", "position", "status", "sale_price", "list_price", "address", "city",
                 "state", "zip", "place_ok", "beds", "baths", "sqft", "listing_office", "detail_url"]


@query
def search_cards_closed(s, p):
    return cards.cards(page_texts.search_pages(d.listings(s, p)), status="Closed").select(*_CARD_COLUMNS)


@query
def search_cards_active(s, p):
    return cards.cards(page_texts.search_pages(d.listings(s, p)), status="Active").select(*_CARD_COLUMNS)


@query
def page_counters(s, p):
    rows = cards.counters(page_texts.search_pages(d.listings(s, p)))
    return rows.select("page_id", "page_position.page", "page_position.pages", "results")


@query
def detail_fields(s, p):
    return details.fields(page_texts.detail_pages(d.listings(s, p))).select(
        "detail_url", "listing_agent", "listing_agent_email", "listing_office", "buyer_agent",
        "buyer_office", "sale_price", "list_price", "close_date", "mls_number", "status",
        "days_on_market", "lot_sqft", "description", "photo_url", "error")


@query
def detail_returns(s, p):
    c = F.col
    good = F.to_json(F.struct(
        F.lit(None).cast("string").alias("error"), "listing_agent",
        F.concat(c("buyer_office"), F.lit("\\u002FNorth")).alias("buyer_office"), "sale_price",
        c("close_date").cast("string").alias("close_date"), "status", "days_on_market"))
    value = (
        F.when(c("status") == "Pending", '{"error":"no agent data found"}')
        .when((c("status") == "Active") & (c("enrichment_status") == "success"), "not json")
        .otherwise(good))
    return details.returns(d.listings(s, p).select("detail_url", value.alias("value"))).select(
        "detail_url", "listing_agent", "buyer_office", "sale_price", "close_date", "status", "days_on_market")


@query
def directory_cards(s, p):
    pages_ = page_texts.directory_pages(d.profiles(s, p), d.profile_towns(s, p))
    return directory_source.cards(pages_).drop("raw_card_text", "position")


@query
def sold_row_texts(s, p):
    lines = page_texts.sold_lines(d.raw_sales(s, p))
    return directory_source.sold_rows(lines, cutoff="1998-01-01").drop("position")


@query
def profile_json_rows(s, p):
    """Profile returns with one sold row per profile and order, parsed back."""
    c = F.col
    row = F.struct(
        c("zpid"), F.format_number("closing_price", 0).alias("closingPrice"),
        F.array(F.struct(F.lit("bd").alias("label"), F.lit("3").alias("value")),
                F.struct(F.lit("bd").alias("label"), c("zpid").alias("value"))).alias("attributes"),
        F.struct(c("sold_date").alias("soldDuration"), F.array(c("represented"), F.lit("x")).alias("representedList"))
        .alias("saleCardData"))
    value = F.to_json(F.struct(
        c("profile_url").alias("agent"), F.struct(F.length("zpid").alias("countAllTime")).alias("stats"),
        F.array(row).alias("soldRows")))
    parsed = directory_source.profile_json(d.sold(s, p).select("profile_url", value.alias("value")))
    return directory_source.profile_json_sold(parsed).select(
        "profile_url", "zpid", "sold_date", "closing_price", "represented", "beds")


@query
def property_json_sales(s, p):
    """Nested property records composed from listings, parsed back for one year."""
    c = F.col
    agent = lambda kind, name, office: F.struct(
        F.lit(kind).alias("type"), c(name).alias("name"), F.struct(c(office).alias("name")).alias("office"))
    value = F.to_json(F.struct(
        c("mls_number").alias("property_id"),
        F.when(c("status") == "Closed", F.struct(c("mls_number").alias("id"))).alias("mls"),
        F.date_format("list_date", "yyyy-MM-dd'T'00:00:00").alias("sold_date"),
        c("sale_price").alias("sold_price"), "list_price",
        F.struct(F.struct(c("address").alias("line"), F.lit("york harbor").alias("city"),
                          c("zip").alias("postal_code")).alias("address")).alias("location"),
        F.struct("beds").alias("description"),
        F.array(agent("Listing", "listing_agent", "listing_office"),
                agent("Buyer", "buyer_agent", "buyer_office")).alias("agents")))
    parsed = property_json.parse(d.listings(s, p).select(value.alias("value")))
    return property_json.sales(parsed, source="json", town="York", year=1999).select(
        "mls_number", "address", "city", "zip", "sale_price", "list_price", "beds", "sale_date",
        "listing_agent", "buyer_agent", "listing_office")


@query
def attribution_lines(s, p):
    return attribution.attributed(page_texts.sale_pages(d.listings(s, p)), html="html").drop("text", "html")


@query
def page_status(s, p):
    rows = pages.profile_pages(d.table(s, p, "pages"), text="html", url="url")
    return rows.select("page_id", "page_status.*")


@query
def document_page_status(s, p):
    """The four rule sets over whole documents, some with a blocking phrase appended."""
    rows = d.table(s, p, "documents")
    phrase = (
        F.when(F.col("source") == "src0", " Please VERIFY you are human")
        .when(F.col("source") == "src1", " Access Denied").when(F.col("source") == "src2", " see /profile/x")
        .otherwise(""))
    rows = rows.select("doc_id", F.concat("text", phrase).alias("text"),
                       F.when(F.col("lang") == "en", 429).when(F.col("lang") == "fr", 500).otherwise(200).alias("code"))
    out = pages.profile_pages(rows, http_status="code").withColumnRenamed("page_status", "a")
    out = pages.sale_pages(out).withColumnRenamed("page_status", "b")
    out = pages.directory_pages(out).withColumnRenamed("page_status", "c")
    out = pages.listing_pages(out).withColumnRenamed("page_status", "l")
    return out.select("doc_id", F.col("l.status").alias("listing_status"), F.col("a.status").alias("profile_status"), F.col("a.reason").alias("profile_reason"),
                      F.col("b.status").alias("sale_status"), F.col("c.status").alias("directory_status"))


@query
def office_guesses(s, p):
    """Office line after the name on profile pages composed around whole documents."""
    rows = d.table(s, p, "documents")
    body = F.concat(F.lit("Home\n Jane Doe \n12 Reviews\nContact us\n"), F.col("source"), F.lit(" Realty\n"),
                    F.col("text"), F.lit("\n"), F.format_number("n_chars", 0), F.lit(" Total sales\n$"),
                  F.format_number(F.col("n_chars") * 7, 0), F.lit(" Average price"))
    made = rows.select("doc_id", F.lit("Jane Doe").alias("profile_name"), body.alias("body"))
    return directory_source.profile_page(made).select("doc_id", "office_name", "total_sales", "average_price")


# --- labels and derived figures ---------------------------------------------------------

@query
def currency_labels(s, p):
    price = F.col("sale_price")
    return d.listings(s, p).select(
        "detail_url", numbers.money(price).alias("short"), numbers.money_or_na(price * 10000).alias("long"),
        numbers.money_full(price).alias("full"), numbers.money(F.floor(price / 1000)).alias("small"),
        numbers.to_long(F.concat(numbers.money_full(price), F.lit(".99 "))).alias("back"))


@query
def currency_sort(s, p):
    cells = d.listings(s, p).select(F.col("detail_url").alias("name"), numbers.money("sale_price").alias("cell"))
    rows = cells.withColumn("value", numbers.money_value("cell"))
    return index.sorted_cells(rows, "cell")


@query
def derived_metrics(s, p):
    rows = kpis.agent(d.listings(s, p), today=ANCHOR)
    return rows.select(
        "name", numbers.ratio_or_zero("three_yr_volume", "three_yr_sides").alias("avg_3yr"),
        numbers.side_split("listing_sides", "buyer_sides").alias("split"),
        numbers.percent_change("current_12mo_volume", "prior_12mo_volume").alias("pct"),
        numbers.estimated_volume("all_time_sides", "current_12mo_sides").alias("est_volume"),
        numbers.sales_not_shown("all_time_sides", "three_yr_sides").alias("not_shown"),
        texts.short_month("most_recent").alias("month"))


@query
def parsed_dates(s, p):
    day = F.col("o_orderdate")
    return d.table(s, p, "orders").select(
        "o_orderkey", texts.month_name_date(F.date_format(day, "MMMM-d-yyyy")).alias("named"),
        texts.month_name_date(F.date_format(day, "yyyy-MM-dd")).alias("iso"),
        texts.us_date(F.date_format(day, "M/d/yyyy")).alias("us"), texts.us_date(F.col("o_orderpriority")).alias("bad"),
        texts.iso_day(day.cast("string")).alias("cut"))


@query
def unescaped(s, p):
    """Documents with every blank written as an escape, decoded back."""
    rows = d.table(s, p, "documents")
    coded = F.replace(F.col("text"), F.lit(" "), F.lit("\\u0020"))
    return rows.select("doc_id", texts.unescape(coded).alias("text"))
