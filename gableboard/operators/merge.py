"""Current state from an observation log: one merge, one rule per column.

Every rule is an aggregate that Spark combines before the shuffle, so a key with very
many observations costs one row per task. Merging the merged state with new observations
gives the same result as merging the whole log.
"""

from __future__ import annotations


from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import combinations
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType

from gableboard.functions.keys import address_hash, computed, match_key, normalized_address, observation_id
from gableboard.functions.names import agent_name, blank_to_null, office_name
from gableboard.functions.numbers import to_double, to_long

ORDER = ("observed_at", "seq")


@dataclass(frozen=True)
class Rules:
    """Columns by how they merge.

    latest_known: the newest non-null value; latest: the newest value, even null;
    first: the oldest value, even null; largest: the maximum; count: rows per key.
    `latest` columns of one rule set always come from the same observation.

    together: a few of the latest known columns, which share the order of their observation, also
    with `latest`, on the way to a key. The result is the same; each set of them is an aggregate.
    """

    keys: tuple[str, ...]
    latest_known: tuple[str, ...] = ()
    latest: tuple[str, ...] = ()
    first: tuple[str, ...] = ()
    largest: tuple[str, ...] = ()
    count: str | None = None
    together: tuple[str, ...] = ()
    order: tuple[str, ...] = field(default=ORDER)


def merge(log: DataFrame, rules: Rules, *, alone: str | None = None) -> DataFrame:
    """The current state of a log. Rows with a null key go, but those that `alone` numbers stay as they are."""
    at = F.struct(*rules.order)
    # A row that stays as it is needs no order, and a null one takes no room on the way. Such rows
    # also stay beside their neighbours, as their numbers lead the key.
    own = at if alone is None else F.when(F.col(alone).isNull(), at)
    apart = [c for c in rules.latest_known if c not in rules.together]
    aggregates: list[Column] = [
        F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in apart]
    aggregates += [F.max(c).alias(c) for c in rules.largest]
    known = _known_sets(rules)
    aggregates += [F.max(F.when(_knows(rules.together, some), F.struct(own.alias("_at"), *rules.latest, *some))).alias(name)
                   for name, some in known.items()]
    if rules.latest and not known:
        aggregates.append(F.max_by(F.struct(*rules.latest), at).alias("_latest"))
    if rules.first:
        aggregates.append((F.min_by(F.struct(*rules.first), at) if alone is None else
                           F.min(F.struct(own.alias("_at"), *rules.first))).alias("_first"))
    if rules.count:
        aggregates.append(F.count(F.lit(1)).alias(rules.count))
    usable = log
    for k in rules.keys:
        usable = usable.filter(F.col(k).isNotNull() if alone is None else F.col(k).isNotNull() | F.col(alone).isNotNull())
    merged = usable.groupBy(*([alone] if alone else []), *rules.keys).agg(*aggregates)
    parts: list[str | Column] = [*rules.keys]
    parts += [c if c in apart else _newest([name for name, some in known.items() if c in some], c) for c in rules.latest_known]
    parts += rules.largest
    parts += [_newest([*known], c, *rules.latest) for c in rules.latest] if known else ["_latest.*"] if rules.latest else []
    parts += [F.col("_first")[c].alias(c) for c in rules.first]
    parts += [rules.count] if rules.count else []
    return merged.select(*parts)


def _known_sets(rules: Rules) -> dict[str, tuple[str, ...]]:
    """The sets of the columns `together` that a row may know, by the names of their aggregates."""
    least = 0 if rules.latest else 1
    sets = [some for n in range(len(rules.together), least - 1, -1) for some in combinations(rules.together, n)]
    return {f"_known{k}": some for k, some in enumerate(sets)} if rules.together else {}


def _knows(columns: tuple[str, ...], some: tuple[str, ...]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() if c in some else F.col(c).isNull() for c in columns])


def _newest(names: list[str], column: str, *beside: str) -> Column:
    """A column of the newest of some aggregates' rows, found by their orders and the columns `beside`."""
    rows = [F.when(F.col(n).isNotNull(), F.struct(F.col(n)["_at"], *[F.col(n)[c].alias(c) for c in beside or (column,)])) for n in names]
    return (F.greatest(*rows) if len(rows) > 1 else rows[0])[column].alias(column)


def partial(log: DataFrame, rules: Rules) -> DataFrame:
    """The rows of a log, merged, with the place of every winner: states of parts of a log that `combined` puts together.

    Each value stands beside the (order) of its observation, so it does not matter in which
    batch, or how late, an observation came.
    """
    at = F.struct(*rules.order)
    known = lambda c: F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("v")))
    whole = lambda columns: F.struct(at.alias("at"), F.struct(*columns).alias("v"))
    aggregates = [F.max(known(c)).alias(c) for c in rules.latest_known]
    aggregates += [F.max(c).alias(c) for c in rules.largest]
    aggregates += [F.max(whole(rules.latest)).alias("_latest")] if rules.latest else []
    aggregates += [F.min(whole(rules.first)).alias("_first")] if rules.first else []
    aggregates += [F.count(F.lit(1)).alias(rules.count)] if rules.count else []
    usable = log
    for k in rules.keys:
        usable = usable.filter(F.col(k).isNotNull())
    return usable.groupBy(*rules.keys).agg(*aggregates)


def combined(states: DataFrame, rules: Rules) -> DataFrame:
    """One state of several; `partial` of a whole log is what `combined` gives of its parts."""
    how = {"_first": F.min, rules.count: F.sum}
    return states.groupBy(*rules.keys).agg(*[how.get(c, F.max)(c).alias(c) for c in states.columns if c not in rules.keys])


def merged_of(state: DataFrame, rules: Rules) -> DataFrame:
    """What `merge` gives of the whole log."""
    parts = [*rules.keys, *[F.col(c)["v"].alias(c) for c in rules.latest_known], *rules.largest]
    parts += ["_latest.v.*"] if rules.latest else []
    parts += ["_first.v.*"] if rules.first else []
    return state.select(*parts, *([rules.count] if rules.count else []))


LISTING_RULES = Rules(
    keys=("detail_url",),
    latest_known=("sale_price", "list_price", "listing_office", "status"),
    latest=("last_seen_at",),
    first=("address", "city", "state", "zip", "beds", "baths", "sqft", "discovered_at"),
)

DETAIL_RULES = Rules(
    keys=("detail_url",),
    latest_known=(
        "mls_number", "listing_office", "sale_price", "list_price", "status", "list_date",
        "year_built", "lot_sqft", "description", "photo_url",
    ),
    latest=(
        "listing_agent", "listing_agent_id", "listing_agent_email", "buyer_agent",
        "buyer_agent_id", "buyer_agent_email", "buyer_office", "close_date", "property_type",
        "days_on_market",
    ),
)

TRANSACTION_RULES = Rules(
    keys=("mls_number",),
    latest_known=(
        "sale_price", "list_price", "listing_agent", "buyer_agent", "listing_office",
        "buyer_office", "sale_date", "raw_listing_agent", "raw_buyer_agent", "property_type",
    ),
    latest=("scraped_at",),
    first=(
        "address", "city", "state", "zip", "beds", "baths", "sqft", "year_built",
        "days_on_market", "source_url", "data_source",
    ),
)

PROFILE_SALE_RULES = Rules(
    keys=("observation_id",),
    latest_known=(
        "sale_price", "list_price", "sale_date", "listing_agent", "buyer_agent",
        "listing_office", "buyer_office", "source_url", "raw_listing_agent", "raw_buyer_agent",
        "represented_side", "agent_profile_url", "profile_type", "normalized_address",
        "normalized_address_hash", "transaction_match_key", "local_directory_town",
        "attribution_confidence",
    ),
    latest=("scraped_at",),
    first=(
        "address", "city", "state", "zip", "beds", "baths", "sqft", "year_built",
        "days_on_market", "data_source", "property_type",
    ),
    together=("listing_agent", "listing_office"),
)

PROFILE_RULES = Rules(
    keys=("profile_url",),
    latest_known=(
        "raw_card_text", "profile_name", "office_name", "sales_last_12_months", "price_range"),
    latest=("profile_type",),
    first=("discovered_at",),
)

PROFILE_TOWN_RULES = Rules(
    keys=("profile_url", "town"), largest=("local_sales_count",), first=("discovered_at",))

PROFILE_STATUS_RULES = Rules(
    keys=("profile_url",),
    latest_known=(
        "profile_name", "office_name", "sales_last_12_months", "total_sales", "average_price",
        "price_range"),
    latest=("scrape_status", "last_error", "last_scraped_at"),
    count="scrape_attempts",
)

PROFILE_DETAIL_RULES = Rules(
    keys=("profile_url",),
    latest_known=("total_sales", "sales_last_12_months", "average_price", "screen_name"),
    latest=(
        "for_sale_count", "total_sold", "avg_price_3yr", "price_range_min", "price_range_max",
        "last_scraped_at"),
    count="scrape_attempts",
)

SOLD_ROW_RULES = Rules(
    keys=("profile_url", "zpid"),
    latest=("sold_date", "closing_price", "represented"),
    first=("address", "city_state", "beds", "baths", "created_at"),
)

TEAM_MEMBER_RULES = Rules(
    keys=("team_profile_url", "member_profile_url"),
    latest_known=("member_name",), first=("discovered_at",))

TEAM_SALE_RULES = Rules(
    keys=("team_profile_url", "represented_side", "transaction_match_key"),
    latest_known=("team_name", "property_url", "local_town"),
    first=(
        "sale_date", "sale_price", "normalized_address", "normalized_address_hash", "created_at"),
    together=("team_name", "property_url", "local_town"),
)


def listing_details(log: DataFrame) -> DataFrame:
    """Detail pages merged per listing: successes by rule, failures only counted.

    `log` has an `outcome` column (`success` or `error`).
    """
    good = log.filter(F.col("outcome") == "success")
    tries = log.groupBy("detail_url").agg(
        F.max_by("outcome", F.struct(*ORDER)).alias("enrichment_status"),
        F.count(F.lit(1)).cast("int").alias("enrichment_attempts"),
        F.max("observed_at").alias("enriched_at"),
        F.max(F.when(F.col("outcome") == "success", F.col("observed_at"))).alias("last_seen_at"),
    )
    return tries.join(merge(good, DETAIL_RULES), "detail_url", "left")


def profile_details(log: DataFrame) -> DataFrame:
    """Profile returns merged per profile: successes by rule, failures keep the figures.

    `log` has `outcome` and `last_error` columns; every try counts.
    """
    at = F.struct(*ORDER)
    tries = log.groupBy("profile_url").agg(
        F.max_by("outcome", at).alias("enrichment_status"),
        F.count(F.lit(1)).cast("int").alias("scrape_attempts"),
        F.max_by("last_error", F.when(F.col("outcome") != "success", at)).alias("last_error"),
        F.max("observed_at").alias("last_scraped_at"),
    )
    good = log.filter(F.col("outcome") == "success")
    rules = replace(
        PROFILE_DETAIL_RULES, count=None,
        latest=tuple(c for c in PROFILE_DETAIL_RULES.latest if c != "last_scraped_at"))
    return tries.join(merge(good, rules), "profile_url", "left")


def profile_status(log: DataFrame) -> DataFrame:
    """Status pages merged per profile: figures keep the newest known value, every try counts."""
    whole = ("sales_last_12_months", "total_sales", "average_price")
    return merge(log.withColumns({c: to_long(c) for c in whole}), PROFILE_STATUS_RULES)


def team_members(log: DataFrame) -> DataFrame:
    """Links of teams to members; the first sighting and the newest known name stay."""
    return merge(log, TEAM_MEMBER_RULES)


def team_sales(log: DataFrame) -> DataFrame:
    """Sales that only a team claims, one row per team, side and match key.

    A row with a null key matches nothing and stays a row of its own.
    """
    rules = TEAM_SALE_RULES
    null_key = reduce(or_, [F.col(k).isNull() for k in rules.keys])
    made = address_hash("normalized_address")
    # A number of its own keeps such a row alone in the one pass over the log. Hashes that the
    # address gives do not travel: a digest takes as much room as the rest of a row.
    ready = log.withColumns({
        "sale_price": to_long("sale_price"),
        "normalized_address_hash": F.when(~F.equal_null("normalized_address_hash", made), F.col("normalized_address_hash")),
        "_hash_made": F.equal_null("normalized_address_hash", made),
        "_alone": F.when(null_key, F.monotonically_increasing_id())})
    merged = merge(ready, replace(rules, first=(*rules.first, "_hash_made")), alone="_alone")
    return merged.withColumn(
        "normalized_address_hash", F.when(F.col("_hash_made"), made).otherwise(F.col("normalized_address_hash"))).drop("_hash_made")


def transactions(log: DataFrame) -> DataFrame:
    """Raw sale records to typed, normalised current state; blank keys are dropped."""
    key = blank_to_null(F.trim(F.col("mls_number").cast("string")))
    ready = _normalise_sales(log).withColumn("mls_number", key)
    return merge(ready, TRANSACTION_RULES)


def _normalise_sales(log: DataFrame) -> DataFrame:
    whole = lambda c: to_long(c).try_cast("int")
    return log.withColumns({
        "raw_listing_agent": F.col("listing_agent"),
        "raw_buyer_agent": F.col("buyer_agent"),
        "listing_agent": agent_name("listing_agent"),
        "buyer_agent": agent_name("buyer_agent"),
        "listing_office": office_name("listing_office"),
        "buyer_office": office_name("buyer_office"),
        "sale_price": to_long("sale_price"),
        "list_price": to_long("list_price"),
        "beds": whole("beds"), "baths": to_double("baths"), "sqft": whole("sqft"),
        "year_built": whole("year_built"), "days_on_market": whole("days_on_market"),
    })


def profile_sales(log: DataFrame) -> DataFrame:
    """Sales seen on profiles, keyed by observation; incomplete keys are dropped.

    Rows meet by the parts of their `observation_id`, and digests are made of the merged rows: none
    travels. All rows of a key know its parts, so the latest row has the latest known ones.
    """
    rules, text = PROFILE_SALE_RULES, lambda c: blank_to_null(c.cast("string"))
    # A date is as good a key as its text.
    day, parts = ("sale_date", ()) if isinstance(log.schema["sale_date"].dataType, DateType) else ("_day", ("sale_date",))
    made = ("agent_profile_url", "represented_side", "sale_date", "sale_price", "normalized_address", "normalized_address_hash", "transaction_match_key")
    keyed = _normalise_sales(computed(log, normalized_address=normalized_address("address", "city", "state", "zip"))).withColumns({
        "_who": F.concat(text(F.col("agent_profile_url")), F.lit("|"), text(F.lower("represented_side")))} | (
        {day: text(F.col("sale_date"))} if parts else {}))
    merged = merge(keyed, replace(
        rules, keys=(day, "sale_price", "_who", "normalized_address"), latest=(*rules.latest, "represented_side", *parts),
        latest_known=tuple(c for c in rules.latest_known if c not in made)))
    side = F.char_length(F.lower("represented_side"))
    hashed = merged.withColumns({
        "agent_profile_url": F.left("_who", F.char_length("_who") - side - 1),
        "normalized_address_hash": address_hash("normalized_address")})
    return hashed.withColumns({
        "transaction_match_key": match_key("normalized_address_hash", "sale_date", "sale_price"),
        "observation_id": observation_id("agent_profile_url", "represented_side", "normalized_address_hash", "sale_date", "sale_price"),
    }).select(*rules.keys, *rules.latest_known, *rules.latest, *rules.first)


def member_profiles(profiles: DataFrame, members: DataFrame) -> DataFrame:
    """Profiles after member discovery.

    Every linked member is an individual; unknown members become profiles.
    """
    linked = merge(members, Rules(
        keys=("member_profile_url",), latest_known=("member_name",), first=("discovered_at",),
        order=("discovered_at", "team_profile_url"))).select(
        F.col("member_profile_url").alias("profile_url"),
        F.col("member_name").alias("_name"), F.col("discovered_at").alias("_found"), F.lit(True).alias("_linked"))
    both = profiles.join(linked, "profile_url", "full_outer")
    is_member = F.col("_linked").isNotNull()
    return both.withColumns({
        "profile_name": F.coalesce("_name", "profile_name"),
        "profile_type": F.when(is_member, F.lit("individual")).otherwise(F.col("profile_type")),
        "discovered_at": F.coalesce("discovered_at", "_found"),
    }).drop("_name", "_found", "_linked")


def evolve(rows: DataFrame, schema, *, backfill_status: bool = False) -> DataFrame:
    """Rows of an older layout in the current one: missing columns are null, extra ones go.

    With `backfill_status`, rows with a close date and no status are closed.
    """
    have = set(rows.columns)
    out = rows.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])
    if backfill_status:
        closed = F.col("status").isNull() & F.col("close_date").isNotNull()
        out = out.withColumn("status", F.when(closed, F.lit("Closed")).otherwise(F.col("status")))
    return out


