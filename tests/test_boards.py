from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gableboard import schemas
from gableboard.operators import boards, history, kpis, live, merge, queues, runs, scoped, teams

ANCHOR = date(2026, 4, 16)


def table(spark, schema, rows):
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def sale(days_ago, price, listing=("Ann Lister", "Office One"), buyer=(None, None), city="York", **more):
    return dict(
        detail_url=f"u{days_ago}-{price}", listing_agent=listing[0], listing_office=listing[1],
        buyer_agent=buyer[0], buyer_office=buyer[1], city=city, sale_price=price,
        close_date=None if days_ago is None else ANCHOR - timedelta(days=days_ago),
        enrichment_status="success", status="Closed") | more


@pytest.fixture(scope="module")
def listings(spark):
    nobody, bob = (None, None), ("Bob Buyer", "Office Two")
    rows = [
        sale(30, 500_000, buyer=bob), sale(100, 600_000), sale(200, 700_000), sale(400, 300_000),
        sale(900, 200_000), sale(50, 400_000, nobody, bob), sale(200, 450_000, nobody, bob),
        sale(500, 350_000, nobody, bob), sale(600, 250_000, nobody, bob),
        sale(2000, 150_000, ("Cy Old", "Office Three")),
        sale(10, 999_999_999, status="Active"), sale(10, 888, enrichment_status=None),
        sale(20, 5, ("Non-MREIS Agent", "Office One")), sale(21, 6, ("  ", "")),
        sale(None, 70, ("Dee Undated", None), city=None),
    ]
    return table(spark, schemas.LISTING, rows)


def test_agent_kpis(listings):
    got = {r.name: r for r in kpis.agent(listings, today=ANCHOR).collect()}
    ann, bob = got["Ann Lister"], got["Bob Buyer"]
    assert (ann.current_12mo_sides, ann.current_12mo_volume) == (3, 1_800_000)
    assert (ann.prior_12mo_sides, ann.prior_12mo_volume) == (1, 300_000)
    assert (ann.three_yr_sides, ann.three_yr_volume) == (5, 2_300_000)
    assert (ann.all_time_sides, ann.listing_sides, ann.buyer_sides) == (5, 5, 0)
    assert (ann.office, ann.primary_towns, ann.most_recent) == ("Office One", "York", ANCHOR - timedelta(days=30))
    assert (bob.buyer_sides, bob.listing_sides, bob.office) == (5, 0, "Office Two")
    dee = got["Dee Undated"]
    assert (dee.all_time_sides, dee.three_yr_sides, dee.office, dee.primary_towns) == (1, 0, None, None)
    assert set(got) == {"Ann Lister", "Bob Buyer", "Cy Old", "Dee Undated"}


def test_agent_kpis_order_limit_and_town(listings):
    order = [r.name for r in kpis.agent(listings, today=ANCHOR).collect()]
    assert order == ["Ann Lister", "Bob Buyer", "Cy Old", "Dee Undated"]
    assert [r.name for r in kpis.agent(listings, today=ANCHOR, limit=1).collect()] == ["Ann Lister"]
    assert "Dee Undated" not in [r.name for r in kpis.agent(listings, today=ANCHOR, town="YORK").collect()]


def test_brokerage_kpis_keep_placeholders(listings):
    got = {r.name: r for r in kpis.brokerage(listings, today=ANCHOR).collect()}
    assert got["Office One"].all_time_sides == 6 and got["Office One"].agent_count == 2
    assert got["Office One"].top_agents == "Ann Lister, Non-MREIS Agent"
    assert "" not in got


def test_sides_add_up(listings):
    sides = kpis.agent(listings, today=ANCHOR).agg(
        F.sum("all_time_sides"), F.sum(F.col("listing_sides") + F.col("buyer_sides"))).first()
    assert sides[0] == sides[1] == 12


def test_results_do_not_depend_on_partitioning(listings, rows):
    for build in (lambda x: kpis.agent(x, today=ANCHOR), lambda x: kpis.brokerage(x, today=ANCHOR),
                  boards.combined, lambda x: boards.side(x, "listing")):
        assert list(map(str, build(listings.repartition(7)).collect())) == list(map(str, build(listings.coalesce(1)).collect()))


def mover_rows(spark, rows):
    return spark.createDataFrame(rows, "name string, current_12mo_sides long, prior_12mo_sides long")


def test_movers_swap(spark):
    got = kpis.movers(mover_rows(spark, [("A", 10, 5), ("B", 5, 10)])).collect()
    assert {(r.side, r.name, r.delta) for r in got} == {("riser", "A", 1), ("faller", "B", -1)}


def test_movers_new_first_and_minimum(spark):
    data = [("Old", 20, 3), ("New", 6, 0), ("Few", 4, 0), ("Down", 5, 30)]
    got = sorted((r.side, r.position, r.name, r.delta) for r in kpis.movers(mover_rows(spark, data)).collect())
    assert got == [("faller", 1, "Down", -2), ("riser", 1, "New", None), ("riser", 2, "Old", 1)]


def test_movers_empty_cap_and_banner(spark):
    assert kpis.movers(mover_rows(spark, [])).count() == 0
    many = [(f"N{i:02d}", 50 - i, 0) for i in range(12)]
    assert [r.name for r in kpis.movers(mover_rows(spark, many), top_n=3).orderBy("position").collect()] == ["N00", "N01", "N02"]
    assert kpis.movers(mover_rows(spark, many), banner=True).count() == 5
    assert kpis.movers(mover_rows(spark, many[:9]), banner=True).count() == 0


def test_side_board_town_keeps_all_towns(spark):
    rows = [sale(1, 500_000, city="York"), sale(2, 100, city="Saco"), sale(3, 100, ("Ann Lister", "Elsewhere"), city="Saco"),
            sale(4, 100, ("Ann Lister", "Elsewhere"), city="Saco")]
    df = table(spark, schemas.LISTING, rows)
    r = boards.side(df, "listing", town="york").first()
    assert (r.sides, r.volume, r.high_value, r.office, r.towns) == (1, 500_000, 1, "Elsewhere", "Saco, York")
    c = boards.combined(df, town="york").first()
    assert (c.total_sides, c.office, c.towns) == (1, "Office One", "York")


def test_unknown_role():
    with pytest.raises(ValueError):
        boards.side(None, "owner")


def tx(name, office, price, city="York", source="a", day=date(2025, 1, 1), **more):
    return dict(mls_number=f"{name}{price}{day}{city}", listing_agent=name, listing_office=office, sale_price=price,
                city=city, data_source=source, sale_date=day) | more


def test_scoped_excludes_companies_only_from_agents(spark):
    df = table(spark, schemas.TRANSACTION, [
        tx("Pat Roe", "Shore", 300), tx("Anchor Real Estate", "Shore", 900), tx("SHORE", "Shore", 800),
        tx("Pat Roe", None, 100, source="b"), tx(None, "Shore", 50)])
    got = scoped.agents(df).collect()
    assert [(r.agent_name, r.sides, r.volume, r.avg_price) for r in got] == [("Pat Roe", 2, 400, 200)]
    assert [(r.office, r.sides, r.volume) for r in scoped.brokerages(df).collect()] == [("Shore", 4, 2050)]
    assert scoped.agents(df, source="b").first().office is None
    assert scoped.rankings(df).count() == 3


def test_trends(spark):
    old, new = date(2020, 1, 1), date(2026, 1, 1)
    df = table(spark, schemas.TRANSACTION, [
        tx("A", "x", 1000, day=old), tx("A", "x", 10, day=new), tx("B", "x", 500, day=old), tx("B", "x", 20, day=new)])
    got = {r.agent_name: (r.rank_change, r.is_new) for r in scoped.agent_trends(df, today=ANCHOR).collect()}
    assert got == {"B": (1, False), "A": (-1, False)}
    top1 = {r.agent_name: (r.rank_change, r.is_new) for r in scoped.agent_trends(df, today=ANCHOR, n=1).collect()}
    assert top1 == {"B": (0, True)}


def obs(spark, rows):
    return spark.createDataFrame(
        [(u, datetime(2024, 1, d), s, st, p) for u, d, s, st, p in rows],
        "detail_url string, observed_at timestamp, seq long, status string, list_price long")


def test_history_changes(spark):
    df = obs(spark, [
        ("a", 1, 1, "Active", 5), ("a", 1, 2, "Active", 5), ("a", 2, 3, "Active", 6), ("a", 3, 4, "Pending", 6),
        ("a", 4, 5, None, None), ("a", 5, 6, "Pending", 6), ("a", 6, 7, None, 6), ("a", 7, 8, None, 6), ("b", 1, 1, "Withdrawn", None)])
    got = sorted((r.detail_url, r.seq) for r in history.changes(df).collect())
    assert got == [("a", 1), ("a", 3), ("a", 4), ("a", 7), ("b", 1)]
    carried = sorted((r.detail_url, r.seq) for r in history.changes(df, carry_forward=True).collect())
    assert carried == [("a", 1), ("a", 3), ("a", 4), ("b", 1)]
    hourly = sorted((r.detail_url, r.seq) for r in history.changes(df).collect())
    assert hourly == got


def test_sweep_boundary(spark):
    now = datetime(2024, 2, 1)
    seen = lambda d: now - timedelta(days=d)
    df = spark.createDataFrame([
        ("2", "Active", 1, seen(2)), ("7", "Active", 1, seen(7)), ("8", "Active", 1, seen(8)), ("10", "Pending", 1, seen(10)),
        ("10c", "Closed", 1, seen(10)), ("n", "Active", 1, None)],
        "detail_url string, status string, list_price long, last_seen_at timestamp")
    assert {r.detail_url for r in history.sweep(df, now).filter("status = 'Withdrawn'").collect()} == {"8", "10"}
    assert {r.detail_url for r in history.sweep_history(df, now).collect()} == {"8", "10"}


def test_merge_rules_and_idempotence(spark):
    df = obs(spark, [("a", 1, 1, "Active", 5), ("a", 2, 2, None, None), ("a", 3, 3, "Pending", None), (None, 1, 1, "x", 1)])
    df = df.withColumn("town", F.col("status"))
    rules = merge.Rules(keys=("detail_url",), latest_known=("status", "list_price"), latest=("town",), count="n")
    assert [tuple(r) for r in merge.merge(df, rules).collect()] == [("a", "Pending", 5, "Pending", 3)]
    twice = merge.Rules(keys=("detail_url",), latest_known=("status", "list_price"), latest=("town",))
    assert merge.merge(df.unionByName(df), twice).collect() == merge.merge(df, twice).collect()


def test_latest_overwrites_with_null(spark):
    df = obs(spark, [("a", 1, 1, "Active", 5), ("a", 2, 2, None, None)])
    rules = merge.Rules(keys=("detail_url",), latest=("status", "list_price"))
    assert tuple(merge.merge(df, rules).first()) == ("a", None, None)


def test_evolve_backfills_status(spark):
    old = spark.createDataFrame(
        [("u1", date(2024, 1, 1), 5), ("u2", None, 6)], "detail_url string, close_date date, sale_price long")
    got = merge.evolve(old, schemas.LISTING, backfill_status=True)
    assert [f.name for f in got.schema.fields] == [f.name for f in schemas.LISTING.fields]
    assert {r.detail_url: r.status for r in got.collect()} == {"u1": "Closed", "u2": None}
    assert merge.evolve(got, schemas.LISTING, backfill_status=True).collect() == got.collect()


def test_live_feeds(spark):
    rows = [
        dict(detail_url="new", status="Active", days_on_market=1, city="York", list_date=date(2024, 3, 1)),
        dict(detail_url="old", status="Active", days_on_market=80, city="Saco", list_date=date(2024, 1, 1)),
        dict(detail_url="pend", status="Pending", days_on_market=90, city="York"),
        dict(detail_url="closed", status="Closed", days_on_market=99, city="York"),
        dict(detail_url="gone", status="Withdrawn", city="York")]
    df = table(spark, schemas.LISTING, rows)
    ids = lambda x: [r.detail_url for r in x.collect()]
    assert ids(live.active(df)) == ["new", "old"]
    assert sorted(ids(live.active(df, include_pending=True, towns=["YORK"]))) == ["new", "pend"]
    assert ids(live.active(df, min_days_on_market=60)) == ["old"]
    assert ids(live.stale(df)) == ["old"]
    seen = spark.createDataFrame(
        [("new", datetime(2024, 3, 2)), ("old", datetime(2024, 1, 1)), ("old", datetime(2024, 3, 9)), ("gone", datetime(2024, 3, 9))],
        "detail_url string, snapshot_date timestamp")
    assert ids(live.new_since(df, seen, "2024-03-01")) == ["new"]
    assert len(live.active(df).columns) == 23 and len(live.stale(df).columns) == 14


def test_runs(spark):
    df = spark.createDataFrame(
        [(1, "T", "u", datetime(2024, 1, 1), 1, "Active"), (1, "T", "v", datetime(2024, 1, 1), 2, "Active"),
         (2, "T", "u", datetime(2024, 1, 2), 3, "Pending"), (2, "T", "v", datetime(2024, 1, 2), 4, None),
         (3, "T", "u", datetime(2024, 1, 3), 5, "Pending"), (3, "T", "v", datetime(2024, 1, 3), 6, "Active")],
        "run int, town string, detail_url string, observed_at timestamp, seq long, status string")
    deltas = runs.deltas(df)
    got = {r.run: (r.listings, r.new_listings, r.status_changes) for r in deltas.collect()}
    assert got == {1: (2, 2, 0), 2: (2, 0, 1), 3: (2, 0, 0)}
    assert {r.run: r.suspicious for r in runs.anomalies(deltas, towns_expected=1).collect()} == {1: False, 2: False, 3: True}
    assert not runs.anomalies(deltas).filter("suspicious").count()
    state = spark.createDataFrame([("u", "Active")], "detail_url string, status string")
    batch = df.filter("run = 3")
    marks = {r.detail_url: (r.is_new, r.status_changed) for r in runs.compared_with_state(batch, state).collect()}
    assert marks == {"u": (False, True), "v": (True, False)}


def test_outcomes_warn_above_ten_percent(spark):
    make = lambda run, good, bad: [(run, "success")] * good + [(run, "error")] * bad
    df = spark.createDataFrame(make(1, 100, 10) + make(2, 100, 11) + make(3, 5, 5), "run int, outcome string")
    assert {r.run: r.verdict for r in runs.outcomes(df).collect()} == {1: "ok", 2: "warning", 3: "ok"}


def test_queues(spark):
    df = table(spark, schemas.TRANSACTION, [
        dict(mls_number=str(i), source_url=u, enrichment_status=s, enrichment_attempts=n) for i, (u, s, n) in enumerate(
            [("u", None, 0), ("u", "error", 2), ("u", "error", 3), ("u", "success", 0), (None, None, 0), ("u", "no_agent", 1)])])
    assert [r.mls_number for r in queues.transactions_to_retry(df).collect()] == ["0", "1"]
    prof = table(spark, schemas.PROFILE, [
        dict(profile_url=u, profile_type=t, scrape_status=s, scrape_attempts=n) for u, t, s, n in
        [("b", "individual", None, 0), ("c", "team", "failed", 2), ("a", "individual", "captcha", 3), ("d", "team", "success", 0)]])
    assert [r.profile_url for r in queues.profiles_to_retry(prof).collect()] == ["c", "b"]
    kinds = table(spark, schemas.TRANSACTION, [dict(mls_number="1", property_type="Land"), dict(mls_number="2")])
    assert queues.purge_preview(kinds).first().refused


def test_team_gap(spark):
    team = table(spark, schemas.TEAM_SALE, [
        dict(team_profile_url="t", team_name="T", represented_side="Seller", transaction_match_key=k, local_town=None)
        for k in ("k1", "k2", None, None)])
    single = spark.createDataFrame([("k1", "SELLER"), ("k1", "seller"), ("k2", "buyer"), (None, "seller")],
                                   "transaction_match_key string, represented_side string")
    got = teams.gap(team, single)
    assert sorted(str(r.transaction_match_key) for r in got.collect()) == ["None", "None", "k2"]
    assert [tuple(r) for r in teams.gap_summary(got).collect()] == [("T", "Unknown", 3)]
