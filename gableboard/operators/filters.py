"""Predicates shared by the boards."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from gableboard.constants import COMPANIES_AS_AGENTS, PLACEHOLDER_AGENTS
from gableboard.functions.names import col, present

ROLES = {"listing": "listing", "seller": "listing", "buyer": "buyer"}


def role_columns(role: str) -> tuple[str, str]:
    side = ROLES.get(role.lower())
    if side is None:
        raise ValueError(f"unknown role: {role}")
    return f"{side}_agent", f"{side}_office"


def closed_and_enriched() -> Column:
    return (F.col("enrichment_status") == "success") & (F.col("status") == "Closed")


def same_text(c: Column | str, value: str) -> Column:
    return F.lower(col(c)) == value.lower()


def not_placeholder(c: Column | str) -> Column:
    return ~F.lower(col(c)).isin(*PLACEHOLDER_AGENTS)


def not_company(c: Column | str) -> Column:
    return ~F.lower(col(c)).isin(*COMPANIES_AS_AGENTS)


def not_self_named(agent: Column | str, office: Column | str) -> Column:
    """The office is missing or differs from the agent."""
    return col(office).isNull() | (F.lower(col(agent)) != F.lower(col(office)))


def scope(source: str | None = None, since=None, town: str | None = None,
          date: str = "sale_date") -> Column:
    parts = []
    if source is not None:
        parts.append(F.col("data_source") == source)
    if since is not None:
        parts.append(F.col(date) >= F.lit(since).cast("date"))
    if town is not None:
        parts.append(same_text("city", town))
    return reduce(and_, parts, F.lit(True))


def passes_cutoff(date: Column | str, cutoff) -> Column:
    """On or after the cutoff; a missing date passes."""
    return F.coalesce(col(date) >= F.lit(cutoff).cast("date"), F.lit(True))


__all__ = ["present", "role_columns", "closed_and_enriched", "same_text", "not_placeholder",
           "not_company", "not_self_named", "scope", "passes_cutoff"]
