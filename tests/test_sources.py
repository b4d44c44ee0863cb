import json
from datetime import date

import pytest

from gableboard.operators import directory as boards, index, merge
from gableboard.sources import attribution, cards, csv_extract, details, directory, property_json, sinks, tables

B = "\\\\\n\\\\\n"


def page(*pieces):
    return "".join(pieces)


def card(price, badge, address, place, office, link):
    return page("[![Thumb](https://example.com/a.jpg)\n$ ", price, " ", badge, "\\\\ \\\\\n", "**", address, "** **", place, "**\\\\ \\\\\n",
                "3 Beds\\\\ \\\\\n1 Bath\\\\ \\\\\n1,800 sqft\\\\ \\\\\nBrought to you by ", office, "](https://listings.example.com/listings/", link, ")\n")


def test_cards(spark):
    text = card("750,000", "Closed", "1 Ocean Ave", "Kittery, ME 03904", "ACME", "a-1") + card(
        "1,200,000", "New Listing", "9 Dock St", "odd place", "Coast", "b-2") + card("9", "Pending", "8 A", "York, ME 03909", "X", "c-3")
    df = spark.createDataFrame([("p", text)], "page_id string, text string")
    closed = cards.cards(df).collect()
    assert [(r.sale_price, r.list_price, r.city, r.zip, r.sqft, r.baths, r.detail_url) for r in closed] == [
        (750_000, None, "Kittery", "03904", 1800, 1.0, "https://listings.example.com/listings/a-1")]
    live = cards.cards(df, status="Active").orderBy("position").collect()
    assert [(r.status, r.list_price, r.sale_price, r.city, r.state, r.place_ok) for r in live] == [
        ("Active", 1_200_000, None, "odd place", "ME", False), ("Pending", 9, None, "York", "ME", True)]
    assert cards.cards(spark.createDataFrame([("p", "nothing")], "page_id string, text string")).count() == 0


def test_card_counters(spark):
    df = spark.createDataFrame([("1 of 90\n1,234 Results",), ("none",)], "text string")
    got = [(r.page_position and tuple(r.page_position), r.results) for r in cards.counters(df).collect()]
    assert got == [((1, 90), 1234), (None, None)]


def test_detail_fields(spark):
    js = ('list_agent_full_name:"",list_agent_full_name:"Ann \\u0026 Co",buyer_agent_full_name:"",close_price:"750000.00",'
          'close_date:"2024-05-06T00:00:00",year_built:2026,lot_size_square_feet:"94525.5",days_on_market:a,days_on_market:12,'
          'public_remarks:"Big \\"sea\\" view",mls_status:"Closed"')
    html = f'<meta content="x"><meta content="https://p/1.jpg" property="og:image"><script>a</script><script id=1>{js}</script>'
    df = spark.createDataFrame([("u", html), ("v", "<script>none</script>")], "detail_url string, html string")
    a, b = details.fields(df).orderBy("detail_url").collect()
    assert (a.listing_agent, a.buyer_agent, a.sale_price, a.close_date) == ("Ann & Co", None, 750_000, date(2024, 5, 6))
    assert (a.year_built, a.lot_sqft, a.days_on_market, a.status) == (2026, 94526, 12, "Closed")
    assert (a.description, a.photo_url, a.error) == ('Big \\"sea\\" view', "https://p/1.jpg", None)
    assert b.error is not None


def test_detail_returns(spark):
    rows = [("ok", json.dumps({"error": None, "listing_agent": "A\\u002FB", "sale_price": 5, "close_date": "2024-01-02"})),
            ("bad", json.dumps({"error": "no agent"})), ("broken", "{not json"), ("null", None)]
    got = details.returns(spark.createDataFrame(rows, "detail_url string, value string")).collect()
    assert [(r.detail_url, r.listing_agent, r.sale_price, r.close_date) for r in got] == [("ok", "A/B", 5, date(2024, 1, 2))]


def profile(body, link):
    return f"[{body}](https://dir.example.com/profile/{link})"


DIRECTORY = " ".join([
    profile(page("![](https://img.example.com/a.jpg)", B, "TEAM", B, "5.0(361)", B, "**Tia Lead** Shore & Sea Realty", B,
                 "$15K - $8.4Mteam price range", B, "210team sales last 12 months", B, "1,124team sales in York"), "tia"),
    profile(page("![](https://img.example.com/b.jpg)", B, "**Ivy Solo** ", B, "4.8(23)", B, "Bay Realty", B, "$167K - $1.3Mprice range", B,
                 "10sales last 12 months", B, "91sales in York"), "ivy"),
    profile(page("![](x.jpg)", B, "**Nora Zero** ", B, "5.0(24)", B, "Quiet Realty", B, "No recent price range", B,
                 "No sales last 12 months", B, "6sales in York"), "nora"),
    profile(page("![](x.jpg)", B, "5.0(37)", B, "**Big Shoreline** ", B, "$95K - $1.4Mprice range", B, "15sales last 12 months", B,
                 "340sales in York"), "big"),
    profile(page("**Far Away** ", B, "Office", B, "9sales in Saco"), "far"),
    profile(page("**Ivy Solo** ", B, "Second Office", B, "7sales in York"), "ivy"),
    "- Page 1 of 25",
])


def test_directory_cards(spark):
    df = spark.createDataFrame([("p", "York", DIRECTORY)], "page_id string, town string, text string")
    got = {r.profile_name: (r.profile_type, r.office_name, r.local_sales_count, r.sales_last_12_months)
           for r in directory.cards(df).collect()}
    assert got == {
        "Tia Lead": ("team", "Shore & Sea Realty", 1124, 210), "Ivy Solo": ("individual", "Second Office", 91, 10),
        "Nora Zero": ("individual", "Quiet Realty", 6, None), "Big Shoreline": ("brokerage", None, 340, 15)}
    assert tuple(directory.counters(df).first().page_position) == (1, 25)


def test_sold_rows(spark):
    line = "45 Summer Street #1 Kennebunk, ME 04043 Sold date: 6/27/2025 Closing price: $450,000 Represented: {}"
    rows = [("u", 1, "https://x/homedetails/1", line.format("Seller")), ("u", 2, "https://x/homedetails/2", line.format("seller")),
            ("u", 3, "https://x/homedetails/3", line.format("Buyer")), ("u", 4, "https://x/other/4", line.format("Buyer")),
            ("u", 5, "https://x/homedetails/5", line.replace("2025", "2010").format("Buyer")),
            ("u", 6, "https://x/homedetails/6", line.replace("Kennebunk", "Bangor").format("Buyer"))]
    df = spark.createDataFrame(rows, "profile_url string, position int, href string, text string")
    got = directory.sold_rows(df, cutoff="2023-01-01").orderBy("position").collect()
    assert [(r.position, r.represented_side) for r in got] == [(1, "seller"), (3, "buyer")]
    r = got[0]
    assert (r.address, r.city, r.sale_date, r.sale_price) == ("45 Summer Street #1", "Kennebunk", date(2025, 6, 27), 450_000)
    assert r.normalized_address == "45 SUMMER ST UNIT 1 | KENNEBUNK | ME | 04043"


def test_profile_json(spark):
    value = {"agent": "A", "screenName": "s", "forSaleCount": 2, "stats": {"countAllTime": 7, "averageValueThreeYear": 9},
             "soldRows": [{"zpid": 11, "closingPrice": "$585,000", "attributes": [{"label": "bd", "value": "3"}, {"label": "bd", "value": "4"}],
                           "saleCardData": {"soldDuration": "1y", "representedList": ["Buyer", "Seller"]}}, {"zpid": None}]}
    rows = [("u", json.dumps(value)), ("v", json.dumps({"error": "x"})), ("w", "nope")]
    parsed = directory.profile_json(spark.createDataFrame(rows, "profile_url string, value string"))
    got = {r.profile_url: (r.outcome, r.total_sales, r.total_sold, r.avg_price_3yr) for r in parsed.collect()}
    assert got == {"u": ("success", 7, 7, 9), "v": ("error", None, None, None), "w": ("error", None, None, None)}
    sold = directory.profile_json_sold(parsed).collect()
    assert [(r.zpid, r.closing_price, r.represented, r.beds, r.baths) for r in sold] == [("11", 585_000, "Buyer", "4", None)]


def test_csv_extract(spark, tmp_path):
    link = "URL (SEE https://example.com FOR INFO ON PRICING)"
    head = f'SOLD DATE,PROPERTY TYPE,ADDRESS,CITY,STATE OR PROVINCE,ZIP OR POSTAL CODE,PRICE,BEDS,MLS#,LISTING AGENT,BUYER\'S AGENT,{link}\n'
    body = ('June-30-2025,Condo/Co-op,"1 A St, Unit 2",York Beach,ME,03909,"500,000",3,m1,"jane doe, CRS",,https://x/1\n'
            'June-30-2010,Land,2 B St,York,ME,03909,1,1,m2,,,\n'
            ',Land,"3 ""C"" St",Saco,ME,,1,1,m3,,,\n'
            'June-30-2025,Land,4 D St,Bangor,ME,,1,1,m4,,,\nJune-30-2025,Land,5 E St,York,ME,,1,1, ,,,\n')
    (tmp_path / "x.csv").write_text(head + body)
    got = csv_extract.sales(csv_extract.read(spark, str(tmp_path)), source="extract", cutoff="2023-01-01").orderBy("mls_number").collect()
    assert [(r.mls_number, r.city, r.sale_date, r.zip) for r in got] == [("m1", "York", date(2025, 6, 30), "03909"), ("m3", "Saco", None, None)]
    assert (got[0].address, got[0].sale_price, got[0].listing_agent, got[0].source_url) == ("1 A St, Unit 2", "500,000", "jane doe, CRS", "https://x/1")
    assert got[1].address == '3 "C" St'


def test_csv_extracts_of_other_header_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("MLS#,CITY,ADDRESS,SOLD DATE\nm1,York,1 A St,June-30-2025\n")
    (tmp_path / "b 1%20.csv").write_text("CITY,SOLD DATE,MLS#,PRICE\nSaco,June-29-2025,m2,7\n")
    (tmp_path / "c.csv").write_text("MLS#,CITY,ADDRESS,SOLD DATE\nm3,York,\"3 C St\nrear\",June-30-2025\n")
    got = csv_extract.sales(csv_extract.read(spark, str(tmp_path)), source="extract", cutoff="2023-01-01").orderBy("mls_number").collect()
    assert [(r.mls_number, r.city, r.address, r.sale_price, r.sale_date.day) for r in got] == [
        ("m1", "York", "1 A St", None, 30), ("m2", "Saco", None, "7", 29), ("m3", "York", "3 C St\nrear", None, 30)]


def test_property_json(spark, tmp_path):
    a = {"mls": {"id": "77"}, "last_sold_date": "2024-03-04T00:00:00Z", "location": {"address": {"line": "1 A", "city": "cape neddick", "postal_code": "03902"}},
         "sold_price": 5, "list_price": 6, "description": {"beds": 3}, "agents": [
             {"type": "Seller", "name": "First", "office": {"name": "O1"}}, {"type": "listing", "full_name": "Last", "office": {"name": "O2"}},
             {"type": "Buyer agent", "name": "Bo"}]}
    b = {"mls": "abc", "mls_id": "ignored", "location": {"address": "x"}, "address": "2 B", "city": "Saco", "listing_agent": "Top"}
    c = {"property_id": 9, "sold_date": "2023-01-01"}
    d = {"sold_date": "2024-01-01"}
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, (a, b, c, d))))
    got = {r.mls_number: r for r in property_json.sales(property_json.read(spark, str(tmp_path)), source="s", town="York", year=2024).collect()}
    assert set(got) == {"s_77", "s_abc"}
    x, y = got["s_77"], got["s_abc"]
    assert (x.city, x.zip, x.sale_price, x.list_price, x.beds, x.listing_agent, x.listing_office, x.buyer_agent) == (
        "York", "03902", "5", "6", "3", "Last", "O2", "Bo")
    assert (y.address, y.city, y.listing_agent, y.sale_date) == ("2 B", "Saco", "Top", None)


def test_attribution(spark):
    ld = '<script type="application/ld+json">{"@type":"Product","agent":"Plain","broker":{"name":"Br"}}</script>'
    rows = [("t", "Listed by Ann Roe • Shore\nBought with Bo Fin · Bay\n", ld), ("c", "Listing courtesy of Dune\nx", ld), ("l", "none", ld), ("n", "none", "")]
    got = {r.k: (r.listing_agent, r.listing_office, r.buyer_agent, r.buyer_office)
           for r in attribution.attributed(spark.createDataFrame(rows, "k string, text string, html string"), html="html").collect()}
    assert got == {"t": ("Ann Roe", "Shore", "Bo Fin", "Bay"), "c": (None, "Dune", None, None), "l": ("Plain", "Br", None, None),
                   "n": (None, None, None, None)}


@pytest.fixture
def profile_tables(spark):
    profiles = spark.createDataFrame(
        [("a", "individual", "Ann", "A Office", 10, 100), ("b", "team", "Bo", "A Office", 20, 300), ("c", "individual", "Cy", "B Office", None, 0),
         ("d", "brokerage", "A Office", None, 99, None)],
        "profile_url string, profile_type string, profile_name string, office_name string, sales_last_12_months int, avg_price_3yr long")
    for c in ("price_range", "total_sold", "for_sale_count", "enrichment_status"):
        from pyspark.sql import functions as F
        profiles = profiles.withColumn(c, F.lit(None).cast("string"))
    towns = spark.createDataFrame([("a", "York", 50), ("a", "Saco", 1), ("b", "York", 40), ("c", "York", 30), ("d", "York", 200)],
                                  "profile_url string, town string, local_sales_count int")
    return profiles, towns


def test_directory_boards(profile_tables):
    board = {r.brokerage: r for r in boards.brokerages(*profile_tables).collect()}
    a, b = board["A Office"], board["B Office"]
    assert (a.direct_sales, a.agent_count, a.agent_sales, a.total_sales, a.sales_12mo) == (200, 2, 91, 200, 99)
    assert (a.agent_12mo_sales, a.avg_price, a.est_volume) == (40, 166, 33_200)
    assert (b.direct_sales, b.agent_sales, b.total_sales, b.avg_price, b.est_volume) == (None, 30, 30, None, None)
    once = {r.brokerage: r for r in boards.brokerages(*profile_tables, fanout=False).collect()}["A Office"]
    assert (once.agent_12mo_sales, once.avg_price) == (30, 200)
    assert [r.profile_url for r in boards.agents(*profile_tables, limit=2).collect()] == ["a", "b"]
    assert [r.profile_url for r in boards.agents(*profile_tables, town="Saco").collect()] == ["a"]
    assert boards.agents(*profile_tables, town="york").count() == 0


def test_directory_index_pages(spark, profile_tables):
    sold = spark.createDataFrame([("a", i, f"2024-01-{i:02d}", i, "Buyer", "", "", "", "") for i in range(1, 8)],
                                 "profile_url string, seq long, sold_date string, closing_price long, represented string, city_state string, address string, beds string, baths string")
    got = sorted((r.profile_url, r.page, [s.price for s in r.sold_rows]) for r in boards.index(*profile_tables, sold, page_size=3).collect())
    assert got == [("a", 0, [1, 2, 3]), ("a", 1, [4, 5, 6]), ("a", 2, [7]), ("b", 0, []), ("c", 0, []), ("d", 0, [])]


def test_search_and_sort(spark):
    make = lambda rows: spark.createDataFrame(rows, "name string, office string")
    src = {"one": make([("Ann Roe", "Shore"), ("Al", None)]), "two": make([("ANN ROE", "Bay"), ("Zed", "annex")])}
    got = {r.key: (r.office, r.sources) for r in index.search(src, "ann").collect()}
    assert got == {"ann roe": ("Bay", "one,two"), "zed": ("annex", "two")}
    assert index.search(src, "a").count() == 0
    with pytest.raises(ValueError):
        index.sorted_board(src["one"], "drop")


def test_tables_and_sinks(spark, tmp_path):
    old = spark.createDataFrame([("u1", date(2024, 1, 1))], "detail_url string, close_date date")
    old.write.parquet(str(tmp_path / "old"))
    assert tables.read_legacy_listings(spark, str(tmp_path / "old")).first().status == "Closed"
    tables.write(old, "listings", str(tmp_path / "new"))
    assert tables.read(spark, "listings", str(tmp_path / "new")).first().detail_url == "u1"
    board = spark.createDataFrame([("York", 1, "A"), ("York", 2, "B")], "town string, rank int, name string")
    sinks.write_boards([sinks.section(board, "towns", scope="town", rank="rank"), sinks.section(board.select("name"), "names")], str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert {(r.section, r.scope, r["rank"]) for r in back.collect()} == {("towns", "York", 1), ("towns", "York", 2), ("names", "all", None)}
    sinks.write_index(board, str(tmp_path / "i"))
    assert spark.read.json(str(tmp_path / "i")).count() == 2
    tx = spark.createDataFrame([("A", "o", "c", 5, None, date(2024, 1, 1))],
                               "listing_agent string, listing_office string, city string, sale_price long, list_price long, sale_date date")
    sinks.write_rankings(tx, str(tmp_path / "r"))
    sinks.write_rankings(tx, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1


def test_members_become_profiles(spark):
    profiles = spark.createDataFrame([("m1", "team", None, None), ("x", "team", "X", None)],
                                     "profile_url string, profile_type string, profile_name string, discovered_at timestamp")
    from datetime import datetime
    links = spark.createDataFrame([("t", "m1", "Mia", datetime(2024, 1, 1)), ("t", "m2", None, datetime(2024, 1, 1))],
                                  "team_profile_url string, member_profile_url string, member_name string, discovered_at timestamp")
    got = {r.profile_url: (r.profile_type, r.profile_name) for r in merge.member_profiles(profiles, links).collect()}
    assert got == {"m1": ("individual", "Mia"), "m2": ("individual", None), "x": ("team", "X")}


def test_oversized_numbers_are_null_and_do_not_fail(spark):
    text = card("99,999,999,999,999,999,999", "Closed", "1 A", "York, ME 03909", "X", "a").replace("1,800 sqft", "99,999,999,999 sqft")
    r = cards.cards(spark.createDataFrame([("p", text)], "page_id string, text string")).first()
    assert (r.sale_price, r.sqft, r.city) == (None, None, "York")
    html = '<script>buyer_agent_full_name:"B",year_built:99999999999,close_price:"99999999999999999999"</script>'
    d = details.fields(spark.createDataFrame([("u", html)], "detail_url string, html string")).first()
    assert (d.buyer_agent, d.year_built, d.sale_price) == ("B", None, None)
