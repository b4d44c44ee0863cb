"""Status of fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gableboard.constants import (
    DIRECTORY_PAGE_RULES, LISTING_PAGE_RULES, PAGE_RULES, SALE_PAGE_RULES,
)
from gableboard.functions.text import page_status


def profile_pages(pages: DataFrame, text="text", url=None, title=None, http_status=None) -> DataFrame:
    """Captcha, blocked or ok, by wording and then by HTTP status."""
    return pages.withColumn("page_status", page_status(text, url, title, http_status, PAGE_RULES))


def sale_pages(pages: DataFrame, text="text") -> DataFrame:
    """Captcha (stop), error (skip) or ok."""
    return pages.withColumn("page_status", page_status(text, rules=SALE_PAGE_RULES))


def directory_pages(pages: DataFrame, text="text") -> DataFrame:
    """Blocked by wording, or because no profile link is on the page; else ok."""
    return pages.withColumn(
        "page_status", page_status(text, rules=DIRECTORY_PAGE_RULES, must_contain="/profile/"))


def listing_pages(pages: DataFrame, text="text") -> DataFrame:
    """Blocked by wording, else ok."""
    return pages.withColumn("page_status", page_status(text, rules=LISTING_PAGE_RULES))
