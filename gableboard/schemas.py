"""Declared schemas. Prices are integral so that sums stay exact."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)

_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()
_DATE, _TS, _B = DateType(), TimestampType(), BooleanType()


def _struct(*columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


LISTING = _struct(
    ("mls_number", _S), ("address", _S), ("city", _S), ("state", _S), ("zip", _S),
    ("sale_price", _L), ("list_price", _L), ("beds", _I), ("baths", _D), ("sqft", _I),
    ("property_type", _S), ("days_on_market", _I), ("close_date", _DATE),
    ("listing_agent", _S), ("listing_agent_id", _S), ("listing_agent_email", _S),
    ("listing_office", _S), ("buyer_agent", _S), ("buyer_agent_id", _S),
    ("buyer_agent_email", _S), ("buyer_office", _S), ("detail_url", _S),
    ("listing_key", _S), ("enrichment_status", _S), ("enrichment_attempts", _I),
    ("discovered_at", _TS), ("enriched_at", _TS), ("scraped_at", _TS), ("status", _S),
    ("list_date", _DATE), ("last_seen_at", _TS), ("year_built", _I), ("lot_sqft", _I),
    ("description", _S), ("photo_url", _S),
)

HISTORY = _struct(
    ("detail_url", _S), ("snapshot_date", _TS), ("seq", _L), ("status", _S), ("list_price", _L),
    ("kind", _S),
)

OBSERVATION = _struct(
    ("detail_url", _S), ("observed_at", _TS), ("seq", _L), ("status", _S), ("list_price", _L),
)

TRANSACTION = _struct(
    ("mls_number", _S), ("address", _S), ("city", _S), ("state", _S), ("zip", _S),
    ("sale_price", _L), ("list_price", _L), ("beds", _I), ("baths", _D), ("sqft", _I),
    ("year_built", _I), ("days_on_market", _I), ("sale_date", _DATE),
    ("listing_agent", _S), ("buyer_agent", _S), ("listing_office", _S), ("buyer_office", _S),
    ("source_url", _S), ("data_source", _S), ("scraped_at", _TS),
    ("raw_listing_agent", _S), ("raw_buyer_agent", _S), ("enrichment_status", _S),
    ("enrichment_attempts", _I), ("property_type", _S),
)

PROFILE_SALE_COLUMNS = _struct(
    ("represented_side", _S), ("agent_profile_url", _S), ("profile_type", _S),
    ("normalized_address", _S), ("normalized_address_hash", _S),
    ("transaction_match_key", _S), ("observation_id", _S), ("local_directory_town", _S),
    ("attribution_confidence", _S),
)
# A sale seen on a profile is a transaction plus the columns above.
PROFILE_SALE = StructType(TRANSACTION.fields + PROFILE_SALE_COLUMNS.fields)

PROFILE = _struct(
    ("profile_url", _S), ("profile_type", _S), ("profile_name", _S), ("office_name", _S),
    ("raw_card_text", _S), ("sales_last_12_months", _I), ("total_sales", _I),
    ("average_price", _L), ("price_range", _S), ("scrape_status", _S),
    ("scrape_attempts", _I), ("last_error", _S), ("discovered_at", _TS),
    ("last_scraped_at", _TS), ("for_sale_count", _I), ("total_sold", _I),
    ("avg_price_3yr", _L), ("price_range_min", _L), ("price_range_max", _L),
    ("screen_name", _S), ("enrichment_status", _S), ("sold_rows_scraped", _I),
)

PROFILE_TOWN = _struct(
    ("profile_url", _S), ("town", _S), ("local_sales_count", _I), ("discovered_at", _TS),
)

TEAM_MEMBER = _struct(
    ("team_profile_url", _S), ("member_profile_url", _S), ("member_name", _S),
    ("discovered_at", _TS),
)

TEAM_SALE = _struct(
    ("team_profile_url", _S), ("team_name", _S), ("property_url", _S),
    ("represented_side", _S), ("sale_date", _DATE), ("sale_price", _L),
    ("normalized_address", _S), ("normalized_address_hash", _S),
    ("transaction_match_key", _S), ("local_town", _S), ("resolved_by_member", _B),
    ("created_at", _TS),
)

SOLD_ROW = _struct(
    ("profile_url", _S), ("zpid", _S), ("address", _S), ("city_state", _S),
    ("sold_date", _S), ("closing_price", _L), ("represented", _S), ("beds", _S),
    ("baths", _S), ("created_at", _TS),
)
