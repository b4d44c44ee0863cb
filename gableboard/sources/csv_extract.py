"""Sold-homes CSV extracts to raw sale records."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from gableboard.functions.names import blank_to_null, in_towns, place_name
from gableboard.functions.text import month_name_date
from gableboard.operators.filters import passes_cutoff

# Header -> column. The link header is recognised by its opening words.
HEADERS = {
    "MLS#": "mls_number", "ADDRESS": "address", "CITY": "city",
    "STATE OR PROVINCE": "state", "ZIP OR POSTAL CODE": "zip", "PRICE": "sale_price",
    "BEDS": "beds", "BATHS": "baths", "SQUARE FEET": "sqft", "YEAR BUILT": "year_built",
    "DAYS ON MARKET": "days_on_market", "SOLD DATE": "sale_date",
    "LISTING AGENT": "listing_agent", "BUYER'S AGENT": "buyer_agent",
    "LISTING BROKER": "listing_office", "BUYER'S BROKER": "buyer_office",
    "PROPERTY TYPE": "property_type",
}
LINK_HEADER = "URL (SEE"


def read(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """All columns as text, each file by its own header; what a file lacks is null.

    Files are read together with those of the same header. With `multi_line` quoted values may
    hold line breaks, and a file is one task; without it, large files are split.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"), "value")
    # The driver holds one line of each file, which it lists anyway.
    heads = lines.filter("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("head")).collect()
    by_head: dict[str, list[str]] = {}
    for r in sorted(heads, key=lambda r: r["file"]):
        by_head.setdefault(r["head"], []).append(unquote(r["file"]))  # the column holds an encoded path
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if len(by_head) < 2:
        return reader.csv(path)
    parts = [reader.csv(files) for files in by_head.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def sales(extract: DataFrame, *, source: str, cutoff) -> DataFrame:
    """Records of listed towns, sold on or after `cutoff` (or undated), with a key."""
    have = set(extract.columns)
    link = next((c for c in extract.columns if c.startswith(LINK_HEADER)), None)
    # Names with dots or quotes need back ticks.
    text = lambda header: (
        F.trim(F.col("`" + header.replace("`", "``") + "`")) if header in have
        else F.lit(None).cast("string"))
    columns = {name: blank_to_null(text(header)) for header, name in HEADERS.items()}
    columns["city"] = place_name(text("CITY"))
    columns["sale_date"] = month_name_date(text("SOLD DATE"))
    columns["state"] = F.coalesce(text("STATE OR PROVINCE"), F.lit("ME"))
    columns["source_url"] = blank_to_null(text(link)) if link else F.lit(None).cast("string")
    rows = extract.select(*[c.alias(name) for name, c in columns.items()])
    return rows.withColumns({
        "list_price": F.lit(None).cast("string"), "data_source": F.lit(source),
    }).filter(
        in_towns("city") & passes_cutoff("sale_date", cutoff) & F.col("mls_number").isNotNull())


