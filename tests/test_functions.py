from datetime import date

import pytest
from pyspark.sql import functions as F

from gableboard.functions import keys, names, numbers, similarity, text


def value(spark, inputs, expression, kind="string"):
    """Evaluate `expression` over one row whose columns are `a`, `b`, ..."""
    columns = [chr(97 + i) for i in range(len(inputs))]
    schema = ", ".join(f"{c} {kind}" for c in columns)
    return spark.createDataFrame([tuple(inputs)], schema).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, want", [
    ("JANE DOE", "Jane Doe"), ("  john smith  ", "John Smith"), ("Jane Doe, CRS", "Jane Doe"),
    ("Jane Doe, CRS, ABR, GRI", "Jane Doe"), ("John Smith, BROKER", "John Smith"),
    ("Jane Doe (Broker)", "Jane Doe"), ("Jane Doe, REALTOR", "Jane Doe"), ("Jane   Doe", "Jane Doe"),
    (None, None), ("", None), ("CRS, ABR", None), ("Jane Doe, e-PRO", "Jane Doe"),
    ("jane doe", "Jane Doe"), ("JANE DOE crs", "Jane Doe"), ("o'brien moody-maxon", "O'Brien Moody-Maxon"),
    ("élise  ábel", "Élise Ábel"), ("   ", None),
])
def test_agent_name(spark, raw, want):
    assert value(spark, [raw], names.agent_name("a")) == want


@pytest.mark.parametrize("raw, want", [
    (" LandVest, INC. ", "LandVest, Inc."), ("Other Office ", "Other Office"), ("  ", None), (None, None)])
def test_office_name(spark, raw, want):
    assert value(spark, [raw], names.office_name("a")) == want


@pytest.mark.parametrize("raw, want", [
    ("York Beach", "York"), (" oob ", "Old Orchard Beach"), ("Saco", "Saco"), ("Bath ", "Bath"), ("", None)])
def test_place_name(spark, raw, want):
    assert value(spark, [raw], names.place_name("a")) == want


@pytest.mark.parametrize("raw, want", [
    ("old-orchard_beach", "Old Orchard Beach"), (" YORK ", "York"), ("Nowhere", "Nowhere")])
def test_town_spelling(spark, raw, want):
    assert value(spark, [raw], names.town_spelling("a")) == want


@pytest.mark.parametrize("parts, want", [
    (("45 Summer Street #1", "Kennebunk", "ME", "04043"), "45 SUMMER ST UNIT 1 | KENNEBUNK | ME | 04043"),
    (("45 Summer St. Apt 1", "Kennebunk", "me", "04043-1234"), "45 SUMMER ST UNIT 1 | KENNEBUNK | ME | 04043"),
    (("1 Oak & Elm Avenue", None, None, None), "1 OAK AND ELM AVE"),
    (("", "York", None, "x"), "YORK"), ((None, None, None, None), None), (("  ", "", "", ""), None),
    (("9 Terrace Lane Streetside Boulevard", None, None, None), "9 TER LN STREETSIDE BLVD"),
])
def test_normalized_address(spark, parts, want):
    assert value(spark, parts, keys.normalized_address("a", "b", "c", "d")) == want


def test_every_street_word_has_its_short_form(spark):
    from gableboard.constants import STREET_WORDS
    got = spark.createDataFrame([(f"1 A {w} B",) for w in STREET_WORDS], "a string").select(
        "a", keys.normalized_address("a").alias("x")).collect()
    assert {r.a.split()[2]: r.x.split()[2] for r in got} == STREET_WORDS


def test_keys_need_every_part(spark):
    key = keys.match_key("a", "b", "c")
    whole = value(spark, ["h", "2024-01-02", "$1,000.9"], key)
    import hashlib
    assert whole == hashlib.sha256(b"h|2024-01-02|1000").hexdigest()
    assert value(spark, [None, "2024-01-02", "1"], key) is None
    assert value(spark, ["h", "2024-01-02", ""], key) is None
    observed = keys.observation_id("a", "b", "c", "d", "e")
    assert value(spark, ["u", "Buyer", "h", "2024-01-02", "5"], observed) == hashlib.sha256(
        b"u|buyer|h|2024-01-02|5").hexdigest()
    assert value(spark, ["u", "Buyer", "h", "2024-01-02", None], observed) is None


@pytest.mark.parametrize("line, want", [
    ("12 Shore Rd Old Orchard Beach, ME 04064", ("12 Shore Rd", "Old Orchard Beach", "ME", "04064")),
    ("12 Shore Rd kennebunkport, ME, 04046", ("12 Shore Rd", "Kennebunkport", "ME", "04046")),
    ("York, ME 03909", ("", "York", "ME", "03909")), ("7 Elm St Bath, ME 04530", ("7", "Elm St Bath", "ME", "04530")),
    ("no address", None),
])
def test_split_address(spark, line, want):
    got = value(spark, [line], keys.split_address("a"))
    assert (None if got is None else tuple(got)) == want


def test_city_state_zip(spark):
    assert tuple(value(spark, ["Kittery, ME 03904"], keys.city_state_zip("a"))) == ("Kittery", "ME", "03904", True)
    assert tuple(value(spark, ["odd text"], keys.city_state_zip("a"))) == ("odd text", "ME", "", False)


@pytest.mark.parametrize("amount, want", [
    (None, "$0"), (0, "$0"), (450, "$450"), (1_500, "$2K"), (2_500, "$2K"), (807_400, "$807K"),
    (1_250_000, "$1.2M"), (1_350_000, "$1.4M"), (12_345_678, "$12.3M"), (999_999, "$1000K")])
def test_money(spark, amount, want):
    assert value(spark, [amount], numbers.money("a"), "long") == want


@pytest.mark.parametrize("amount, want", [(None, "N/A"), (0, "N/A"), (2_500_000_000, "$2.5B"), (5_000, "$5K")])
def test_money_or_na(spark, amount, want):
    assert value(spark, [amount], numbers.money_or_na("a"), "long") == want


@pytest.mark.parametrize("cell, want", [
    ("$1.3M", 1.3e6), ("$807K", 807e3), ("$450,000", 450e3), ("N/A", None), ("—", None), ("1,234", 1234.0)])
def test_money_value(spark, cell, want):
    assert value(spark, [cell], numbers.money_value("a")) == want


@pytest.mark.parametrize("raw, want", [("$1,234.9", 1234), ("12", 12), ("x", None), ("", None), (None, None), (" -3.7 ", -3)])
def test_to_long(spark, raw, want):
    assert value(spark, [raw], numbers.to_long("a")) == want


@pytest.mark.parametrize("raw, want", [
    ("a\\u002Fb", "a/b"), ("plain", "plain"), ("\\ud83d\\ude00!", "😀!"), ('q"\\x \\u0041\n\t', 'q"\\x A\n\t'),
    ("\\\\u0041", "\\A"), (None, None), ("\\u00", "\\u00")])
def test_unescape(spark, raw, want):
    assert value(spark, [raw], text.unescape("a")) == want


def test_dates(spark):
    assert value(spark, ["June-30-2025"], text.month_name_date("a")) == date(2025, 6, 30)
    assert value(spark, ["2025-06-30"], text.month_name_date("a")) == date(2025, 6, 30)
    assert value(spark, ["junk"], text.month_name_date("a")) is None
    assert value(spark, [" 6/7/2025 "], text.us_date("a")) == date(2025, 6, 7)
    assert value(spark, ["2023-03-09"], text.short_month("a")) == "Mar 2023"
    assert value(spark, ["soon"], text.short_month("a")) == "soon"
    assert value(spark, [None], text.short_month("a")) == "N/A"


@pytest.mark.parametrize("page, code, want", [
    ("Press & Hold to continue", 200, "captcha"), ("Access Denied", 200, "blocked"), ("fine", 429, "blocked"),
    ("fine", 500, "blocked"), ("fine", 200, "ok"), ("fine", None, "ok"), (None, None, "ok")])
def test_page_status(spark, page, code, want):
    df = spark.createDataFrame([(page, code)], "a string, b int")
    assert df.select(text.page_status("a", http_status="b").alias("x")).first().x.status == want


def test_office_guess(spark):
    body = "Home\n Pat Roe \n4.9 reviews\n\nContact Pat\nShore Realty\nmore"
    guess = text.office_guess("a", "b")
    assert value(spark, [body, "Pat Roe"], guess) == "Shore Realty"
    assert value(spark, [body, "Nobody"], guess) is None


@pytest.mark.parametrize("a, b", [("jane doe", "jane doe"), ("jane doe", "jan doe"), ("abc", "xyz"), ("", ""),
                                  ("", "a"), ("kitten", "sitting"), ("aab", "baa")])
def test_name_ratio(spark, a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = rows[i - 1][j - 1] + 1 if x == y else max(rows[i - 1][j], rows[i][j - 1])
    want = 100.0 if not a and not b else 200.0 * rows[-1][-1] / (len(a) + len(b))
    assert value(spark, [a, b], similarity.name_ratio("a", "b")) == pytest.approx(want)


def test_derived(spark):
    df = spark.createDataFrame([(300, 200, 0)], "a long, b long, c long").select(
        numbers.percent_change("a", "b").alias("up"), numbers.percent_change("b", "a").alias("down"),
        numbers.percent_change("a", "c").alias("none"), numbers.ratio_or_zero("a", "c").alias("zero"),
        numbers.side_split("a", "b").alias("split"), numbers.estimated_volume("a", "c").alias("est"),
        numbers.delta_label("c", F.lit(False)).alias("flat"), numbers.sales_not_shown("a", "b").alias("more"))
    assert tuple(df.first()) == (50, -33, None, 0.0, "300 : 200", None, "—", 100)


def test_white_space_of_any_kind(spark):
    from gableboard.functions import names
    kinds = [chr(c) for c in range(0x3100) if c < 0xD800]
    df = spark.createDataFrame([(i, f"{c}{c} a {c}b{c}") for i, c in enumerate(kinds)] + [(-1, None), (-2, "")], "i int, t string")
    for made, pattern in ((names.strip(F.col("t")), F.regexp_replace("t", r"(?U)^\s+|\s+$", "")),
                          (names.squeeze(F.col("t")), F.trim(F.regexp_replace("t", r"(?U)\s+", " ")))):
        assert df.filter(~F.equal_null(made, pattern)).count() == 0
    assert [r.p for r in df.filter("i < 0 or t like '\u3000%'").orderBy("i").select(names.present("t").alias("p")).collect()][:2] == [False, False]


def test_place_over_two_lines_keeps_itself(spark):
    from gableboard.functions.keys import city_state_zip
    rows = ["York, ME 03909", "Old\nYork, ME 03909", "York,\nME 03909 and\nmore", "nowhere", None]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select(city_state_zip("t").alias("x")).select("x.*").collect()
    assert [tuple(r)[:3] for r in got[:4]] == [("York", "ME", "03909"), (rows[1], "ME", ""), ("York", "ME", "03909"), ("nowhere", "ME", "")]


def test_purge_refuses_to_drop_everything(spark):
    from gableboard.operators import queues
    df = spark.createDataFrame([(1, "Land"), (2, None), (3, "Commercial")], "id int, property_type string")
    assert queues.purge(df).count() == 3 and queues.purge_preview(df).head().refused
    more = df.union(spark.createDataFrame([(4, "Condo/Co-op")], df.schema))
    assert [r.id for r in queues.purge(more).collect()] == [4]
    assert queues.purge(df.limit(0)).count() == 0


def test_no_limit_and_links_without_a_date(spark):
    from gableboard.operators import index, merge, queues
    rows = spark.createDataFrame([(f"n{i:04}", "Town") for i in range(120)], "name string, primary_towns string").withColumn("delta", F.lit(1))
    assert index.sorted_board(rows, "delta", town="town").count() == 50
    assert index.sorted_board(rows, "delta", town="town", town_limit=None).count() == 120
    listings = spark.createDataFrame([(f"u{i}", "York", None, 0, None) for i in range(70)], "detail_url string, city string, enrichment_status string, enrichment_attempts int, discovered_at timestamp")
    assert queues.listings_to_retry(listings).count() == 50 and queues.listings_to_retry(listings, limit=None).count() == 70
    profiles = spark.createDataFrame([("p1", "One", "team", None)], "profile_url string, profile_name string, profile_type string, discovered_at timestamp")
    links = spark.createDataFrame([("t", "p1", None, None), ("t", "p2", "Two", None)], "team_profile_url string, member_profile_url string, member_name string, discovered_at timestamp")
    got = sorted(map(tuple, merge.member_profiles(profiles, links).select("profile_url", "profile_name", "profile_type", "discovered_at").collect()))
    assert got == [("p1", "One", "individual", None), ("p2", "Two", "individual", None)]


def test_listed_words_side_by_side_and_inside_others(spark):
    street = "1 Street Street lane-LANE Streets XROAD Road's"
    assert value(spark, [street], keys.normalized_address("a")) == "1 ST ST LN LN STREETS XROAD RD S"


def test_computed_columns_replace_and_keep_nulls(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None)], "i int, a string")
    got = keys.computed(rows, a=F.upper("a"), b=F.col("i") + 1)
    assert got.columns == ["i", "a", "b"] and sorted(map(tuple, got.collect())) == [(1, "X", 2), (2, None, 3)]
