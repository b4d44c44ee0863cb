"""Nested property JSON to raw sale records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gableboard.functions.names import blank_to_null, place_name
from gableboard.functions.text import iso_day

SCHEMA = """
    property_id string, mls_id string, mls string,
    last_sold_date string, sold_date string, list_date string,
    last_sold_price string, sold_price string, list_price string, price string,
    address string, city string, postal_code string, zip string,
    location struct<address: string>,
    beds string, baths string, sqft string, year_built string, days_on_market string,
    description struct<beds: string, baths: string, sqft: string, year_built: string>,
    agents array<struct<type: string, name: string, full_name: string, office: string>>,
    listing_agent string, agent_name string, listing_office string, office_name string,
    permalink string, url string
"""


def read(spark: SparkSession, path: str) -> DataFrame:
    """One property per line; parts whose shape varies stay JSON text."""
    return spark.read.schema(SCHEMA).json(path)


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(F.from_json(column, SCHEMA).alias("p")).select("p.*")


def _filled(*candidates: Column) -> Column:
    """First value that is neither null nor empty (a zero is empty too)."""
    return F.coalesce(*[F.when(~c.isin("", "0"), c) for c in candidates])


def _agent(words: tuple[str, ...], exclude: tuple[str, ...] = ()) -> Column:
    """The last agent whose role contains one of the words and none of `exclude`."""
    def wanted(a: Column) -> Column:
        role = F.lower(F.coalesce(a["type"], F.lit("")))
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(role, F.lit(w))
        for w in exclude:
            hit = hit & ~F.contains(role, F.lit(w))
        return hit
    return F.try_element_at(F.filter("agents", wanted), F.lit(-1))


def sales(properties: DataFrame, *, source: str, town: str, year: int) -> DataFrame:
    """Records sold in `year` (or undated), keyed `<source>_<id>`."""
    c = F.col
    object_like = lambda text: F.coalesce(F.startswith(F.trim(text), F.lit("{")), F.lit(False))
    mls_id = F.when(
        object_like(c("mls")),
        _filled(c("mls_id"), F.get_json_object("mls", "$.id")),
    ).otherwise(c("mls"))
    key = _filled(mls_id, c("property_id"))
    sold = _filled(c("last_sold_date"), c("sold_date"), c("list_date"))
    place = c("location.address")
    # No address at all counts as an empty address object.
    nested = object_like(place) | place.isNull()
    inside = lambda name: F.get_json_object(place, f"$.{name}")
    city = F.when(nested, F.coalesce(inside("city"), F.lit(town))).otherwise(
        F.coalesce(c("city"), F.lit(town)))
    listing, buyer = _agent(("list", "sell")), _agent(("buy",), ("list", "sell"))
    name = lambda a: _filled(a["name"], a["full_name"])
    rows = properties.select(
        F.concat(F.lit(f"{source}_"), key).alias("mls_number"),
        blank_to_null(F.when(nested, inside("line")).otherwise(c("address"))).alias("address"),
        place_name(city).alias("city"),
        F.lit("ME").alias("state"),
        F.when(nested, inside("postal_code")).otherwise(_filled(c("postal_code"), c("zip"))).alias("zip"),
        _filled(c("last_sold_price"), c("sold_price"), c("list_price"), c("price")).alias("sale_price"),
        "list_price",
        *[_filled(c(n), c(f"description.{n}")).alias(n) for n in ("beds", "baths", "sqft", "year_built")],
        "days_on_market",
        iso_day(sold).alias("sale_date"),
        _filled(name(listing), c("listing_agent"), c("agent_name")).alias("listing_agent"),
        name(buyer).alias("buyer_agent"),
        _filled(F.get_json_object(listing["office"], "$.name"), c("listing_office"), c("office_name"))
        .alias("listing_office"),
        F.lit(None).cast("string").alias("buyer_office"),
        _filled(c("permalink"), c("url")).alias("source_url"),
        F.lit(source).alias("data_source"),
        sold.isNull().alias("_undated"),
    )
    in_year = F.coalesce(F.year("sale_date") == year, F.lit(False))
    return rows.filter(c("mls_number").isNotNull() & (c("_undated") | in_year)).drop("_undated")
