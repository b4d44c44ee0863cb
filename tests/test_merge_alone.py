"""Team sales with and without a whole key, in one pass over the log."""

from gableboard.operators import merge


def test_team_sales_keep_rows_without_a_key_in_one_pass(spark):
    schema = ("team_profile_url string, represented_side string, transaction_match_key string, team_name string, property_url string, "
              "local_town string, sale_date string, sale_price string, normalized_address string, normalized_address_hash string, "
              "created_at int, observed_at int, seq int")
    row = lambda t, s, k, name, price, at: (t, s, k, name, "u", None, None, price, None, None, at, at, at)
    rows = [row("t", "buyer", "k", "old", "$1", 1), row("t", "buyer", "k", None, "$2", 2), row("t", "buyer", None, "a", "$3", 3),
            row("t", "buyer", None, "a", "$3", 3), row(None, "buyer", "k", None, None, 4), row("t", None, "k", "b", "x", 5)]
    merged = merge.team_sales(spark.createDataFrame(rows, schema))
    got = sorted(map(str, merged.select("team_profile_url", "represented_side", "transaction_match_key", "team_name", "sale_price").collect()))
    want = [("t", "buyer", "k", "old", 1), ("t", "buyer", None, "a", 3), ("t", "buyer", None, "a", 3), (None, "buyer", "k", None, None),
            ("t", None, "k", "b", None)]
    fields = merged.select("team_profile_url", "represented_side", "transaction_match_key", "team_name", "sale_price")
    assert got == sorted(map(str, spark.createDataFrame(want, fields.schema).collect()))
    assert "Union" not in merged._jdf.queryExecution().executedPlan().toString()
