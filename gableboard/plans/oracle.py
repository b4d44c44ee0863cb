"""The registered queries in plain SQL, written independently of the DataFrame code.

Every text is a complete statement over the source tables. Counts and sums are cast to
BIGINT; every most-frequent list and every limit has a full tie-break.
"""

from __future__ import annotations

LISTINGS = """
first_line AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey,
      l_extendedprice, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1),
listings AS (
  SELECT 'L' || o_orderkey AS detail_url, CAST(o_orderkey AS VARCHAR) AS mls_number,
    l_partkey || ' Summer Street' AS address, cn.n_name AS city, 'ME' AS state,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS zip,
    CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) END AS sale_price,
    CAST(floor(o_totalprice) AS BIGINT) + CAST(floor(coalesce(l_extendedprice, 0)) AS BIGINT) AS list_price,
    l_linenumber AS beds, l_linenumber / 2.0 AS baths, CAST(floor(o_totalprice / 100) AS INTEGER) AS sqft,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Single Family Residential' WHEN 'BUILDING' THEN 'Condo/Co-op'
      WHEN 'AUTOMOBILE' THEN 'Commercial' WHEN 'FURNITURE' THEN 'Land' END AS property_type,
    CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS INTEGER) AS days_on_market,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS close_date,
    CAST(o_orderdate AS DATE) AS list_date, CAST(o_orderdate AS DATE) AS sale_date,
    s_name AS listing_agent, sn.n_name AS listing_office,
    lower(s_name) || '@example.com' AS listing_agent_email, CAST(l_suppkey AS VARCHAR) AS listing_agent_id,
    c_name AS buyer_agent, c_mktsegment AS buyer_office,
    CASE WHEN o_orderpriority <> '5-LOW' THEN 'success' WHEN l_linestatus = 'F' THEN 'error' END AS enrichment_status,
    coalesce(l_linenumber, 0) AS enrichment_attempts, o_orderdate AS discovered_at,
    coalesce(l_shipdate, o_orderdate) AS last_seen_at,
    CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Pending' END AS status,
    CAST(year(o_orderdate) AS INTEGER) AS year_built, l_linenumber AS lot_sqft, o_orderpriority AS description,
    CAST(NULL AS VARCHAR) AS photo_url,
    CASE WHEN l_linestatus = 'O' THEN 'feed_b' ELSE 'feed_a' END AS data_source,
    CASE WHEN l_returnflag <> 'N' THEN 'https://example.com/sale/' || o_orderkey END AS source_url
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN first_line ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey)"""

_SIDES = """
base AS (SELECT * FROM listings WHERE enrichment_status = 'success' AND status = 'Closed'),
all_sides AS (
  SELECT listing_agent AS agent, listing_office AS office, 'listing' AS role, city, close_date, sale_price FROM base
  UNION ALL
  SELECT buyer_agent, buyer_office, 'buyer', city, close_date, sale_price FROM base)"""

_OBSERVATIONS = """
obs AS (
  SELECT 'U' || user_id AS detail_url, ts AS observed_at, event_id AS seq,
    CASE event_type WHEN 'click' THEN 'Pending' WHEN 'purchase' THEN 'Closed' WHEN 'error' THEN NULL ELSE 'Active' END AS status,
    CASE WHEN value >= 5 THEN CAST(floor(value / 20) AS BIGINT) * 20 END AS list_price,
    CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END AS sale_price,
    CASE WHEN value < 40 THEN event_type END AS listing_office,
    CASE WHEN event_type <> 'view' THEN 'agent ' || json_extract_string(props, '$.k') END AS listing_agent,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS outcome,
    CAST(ts AS DATE) AS run, 'T' || left(json_extract_string(props, '$.k'), 1) AS town,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS page
  FROM events)"""

_HISTORY = """
known AS (SELECT * FROM obs WHERE status IS NOT NULL OR list_price IS NOT NULL),
stepped AS (SELECT *, row_number() OVER w AS rn, lag(status) OVER w AS ps, lag(list_price) OVER w AS pp
  FROM known WINDOW w AS (PARTITION BY detail_url ORDER BY observed_at, seq)),
history AS (SELECT detail_url, observed_at AS snapshot_date, seq, status, list_price, rn FROM stepped
  WHERE rn = 1 OR status IS DISTINCT FROM ps OR list_price IS DISTINCT FROM pp)"""

_MARKED = """
ordered AS (SELECT *, row_number() OVER w AS rn,
    last_value(status IGNORE NULLS) OVER (PARTITION BY detail_url ORDER BY observed_at, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ps
  FROM obs WINDOW w AS (PARTITION BY detail_url ORDER BY observed_at, seq)),
marked AS (SELECT *, rn = 1 AS is_new, rn > 1 AND status IS NOT NULL AND status IS DISTINCT FROM ps AS changed FROM ordered)"""

_PROFILES = """
profiles AS (
  SELECT 'https://example.com/profile/' || s_suppkey AS profile_url,
    CASE WHEN s_acctbal < 500 THEN 'brokerage' WHEN s_acctbal < 2500 THEN 'team' ELSE 'individual' END AS profile_type,
    CASE WHEN s_acctbal < 500 THEN n_name ELSE s_name END AS profile_name,
    CASE WHEN s_acctbal <= 9500 AND s_acctbal >= 500 THEN n_name END AS office_name,
    CASE WHEN s_acctbal <= 9000 THEN CAST(floor(s_acctbal / 10) AS INTEGER) END AS sales_last_12_months,
    CAST(floor(s_acctbal) AS INTEGER) AS total_sold,
    CASE WHEN s_acctbal < 1000 THEN 0 ELSE CAST(floor(s_acctbal * 100) AS BIGINT) END AS avg_price_3yr,
    CAST(NULL AS VARCHAR) AS price_range,
    CASE WHEN s_acctbal < 3000 THEN NULL WHEN s_acctbal < 4000 THEN 'failed' WHEN s_acctbal < 5000 THEN 'captcha'
      ELSE 'success' END AS scrape_status,
    s_nationkey AS scrape_attempts, CASE WHEN s_acctbal > 1000 THEN 'success' END AS enrichment_status,
    s_nationkey AS for_sale_count
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

_SALES = """
sales AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""

_TOWNS = """
profile_towns AS (SELECT 'https://example.com/profile/' || l_suppkey AS profile_url, n_name AS town,
  CAST(count(*) AS INTEGER) AS local_sales_count FROM sales GROUP BY ALL)"""

_SOLD = """
sold AS (SELECT 'https://example.com/profile/' || l_suppkey AS profile_url, CAST(l_orderkey AS VARCHAR) AS zpid,
    l_orderkey AS seq, strftime(l_shipdate, '%Y-%m-%d') AS sold_date, CAST(floor(l_extendedprice) AS BIGINT) AS closing_price,
    CASE l_returnflag WHEN 'A' THEN 'Seller' WHEN 'N' THEN 'Buyer' ELSE 'Buyer and Seller' END AS represented
  FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY l_extendedprice, l_returnflag, l_shipdate) AS rn
    FROM lineitem) WHERE rn = 1)"""

_KEYED = """
raw AS (SELECT l_partkey || ' Summer Street #' || l_linenumber AS address, n_name AS city, 'ME' AS state,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS zip, CAST(o_orderdate AS DATE) AS sale_date,
    CAST(floor(l_extendedprice) AS BIGINT) AS sale_price,
    CASE WHEN l_linestatus = 'F' THEN 'Seller' ELSE 'buyer' END AS represented_side, l_returnflag AS flag,
    l_suppkey, l_orderkey, l_partkey, l_linenumber, 'https://example.com/profile/' || l_suppkey AS profile_url FROM sales),
addressed AS (SELECT *, l_partkey || ' SUMMER ST UNIT ' || l_linenumber || ' | ' || replace(city, '_', ' ') || ' | ME | ' || zip
  AS normalized_address FROM raw),
hashed AS (SELECT *, sha256(normalized_address) AS normalized_address_hash FROM addressed),
keyed AS (SELECT *, sha256(normalized_address_hash || '|' || sale_date || '|' || sale_price) AS transaction_match_key,
  sha256(profile_url || '|' || lower(represented_side) || '|' || normalized_address_hash || '|' || sale_date || '|' || sale_price)
  AS observation_id FROM hashed)"""

_TEAMS = """
team AS (SELECT profile_url AS team_profile_url, 'Team ' || l_suppkey AS team_name, city AS local_town, represented_side,
  sale_date, sale_price, 'https://example.com/home/' || l_orderkey AS property_url, transaction_match_key
  FROM keyed WHERE flag IN ('A', 'N')),
individual AS (SELECT lower(represented_side) AS represented_side, transaction_match_key FROM keyed WHERE flag IN ('N', 'R')),
gap AS (SELECT * FROM team t WHERE NOT EXISTS (SELECT 1 FROM individual i
  WHERE i.transaction_match_key = t.transaction_match_key AND i.represented_side = lower(t.represented_side)))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _top(source: str, keys: str, value: str, k: int) -> str:
    """Sub-query `(keys, v)`: the `k` most frequent values joined by a comma and a blank."""
    return f"""(SELECT {keys}, string_agg(v, ', ' ORDER BY rn) AS v FROM (
      SELECT {keys}, {value} AS v, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {value}) AS rn
      FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) WHERE rn <= {k} GROUP BY {keys})"""


_PERIODS = """
  CAST(count(*) FILTER (WHERE close_date >= DATE '2000-08-01') AS BIGINT) AS current_12mo_sides,
  CAST(coalesce(sum(sale_price) FILTER (WHERE close_date >= DATE '2000-08-01'), 0) AS BIGINT) AS current_12mo_volume,
  CAST(count(*) FILTER (WHERE close_date >= DATE '1999-08-02' AND close_date < DATE '2000-08-01') AS BIGINT) AS prior_12mo_sides,
  CAST(coalesce(sum(sale_price) FILTER (WHERE close_date >= DATE '1999-08-02' AND close_date < DATE '2000-08-01'), 0) AS BIGINT) AS prior_12mo_volume,
  CAST(count(*) FILTER (WHERE close_date >= DATE '1998-08-02') AS BIGINT) AS three_yr_sides,
  CAST(coalesce(sum(sale_price) FILTER (WHERE close_date >= DATE '1998-08-02'), 0) AS BIGINT) AS three_yr_volume,
  CAST(count(*) AS BIGINT) AS all_time_sides, CAST(coalesce(sum(sale_price), 0) AS BIGINT) AS all_time_volume,
  CAST(count(*) FILTER (WHERE role = 'listing') AS BIGINT) AS listing_sides,
  CAST(count(*) FILTER (WHERE role = 'buyer') AS BIGINT) AS buyer_sides, max(close_date) AS most_recent"""


def _kpi_cte(kind: str, town: str = "", by_town: bool = False) -> str:
    name = "agent" if kind == "agent" else "office"
    keys = "town, name" if by_town else "name"
    where = f"trim({name}) <> ''" + (f" AND lower(city) = '{town}'" if town else "")
    src = f"(SELECT *, lower(city) AS town, {name} AS name FROM all_sides WHERE {where})"
    extra = ", CAST(count(DISTINCT agent) AS BIGINT) AS agent_count" if kind != "agent" else ""
    first, label = ("office", "office") if kind == "agent" else ("agent", "top_agents")
    k = 1 if kind == "agent" else 3
    return f"""
kpi_rows AS (SELECT * FROM {src}),
kpi_totals AS (SELECT {keys}, {_PERIODS}{extra} FROM kpi_rows GROUP BY {keys}),
kpi_first AS {_top("kpi_rows", keys, first, k)},
kpi_towns AS {_top("kpi_rows", keys, "city", 3)},
kpi AS (SELECT t.*, f.v AS {label}, w.v AS primary_towns FROM kpi_totals t
  LEFT JOIN kpi_first f USING ({keys}) LEFT JOIN kpi_towns w USING ({keys}))"""


_KPI_ORDER = "current_12mo_volume DESC, all_time_volume DESC, name"
_L = (LISTINGS, _SIDES)


def _ranked() -> str:
    return f"""
prior_ranks AS (SELECT name, row_number() OVER (ORDER BY prior_12mo_sides DESC, {_KPI_ORDER}) AS prior_rank
  FROM kpi WHERE prior_12mo_sides > 0),
ranked AS (SELECT k.*, row_number() OVER (ORDER BY current_12mo_sides DESC, {_KPI_ORDER}) AS current_rank, prior_rank,
  prior_rank IS NULL AS is_new, prior_rank - row_number() OVER (ORDER BY current_12mo_sides DESC, {_KPI_ORDER}) AS delta
  FROM kpi k LEFT JOIN prior_ranks USING (name))"""


def _movers(kind: str, gate: bool) -> str:
    check = "WHERE (SELECT count(*) FROM enough) >= 10" if gate else ""
    return _with(*_L, _kpi_cte(kind), _ranked()) + f""", enough AS (SELECT * FROM ranked WHERE current_12mo_sides >= 5),
moved AS (SELECT *, CASE WHEN is_new OR delta > 0 THEN 'riser' WHEN delta < 0 THEN 'faller' END AS side FROM enough),
placed AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY is_new DESC,
  CASE WHEN is_new THEN current_12mo_sides ELSE abs(delta) END DESC, {_KPI_ORDER}) AS position FROM moved WHERE side IS NOT NULL)
SELECT side, CAST(position AS INTEGER) AS position, name, current_12mo_sides, prior_12mo_sides, current_rank, prior_rank, delta, is_new,
  CASE WHEN is_new THEN 'NEW' WHEN delta > 0 THEN '▲' || delta WHEN delta < 0 THEN '▼' || abs(delta) ELSE '—' END AS delta_label,
  CASE WHEN prior_12mo_volume > 0 THEN CAST(trunc((current_12mo_volume - prior_12mo_volume) / prior_12mo_volume * 100) AS BIGINT) END
    AS volume_change_pct
FROM (SELECT * FROM placed WHERE position <= 5) {check}"""


def _side_board(role: str, town: str = "") -> str:
    here = f"lower(city) = '{town}'" if town else "true"
    return _with(*_L) + f""", rows_ AS (SELECT {role}_agent AS agent_name, {role}_office AS office, city, close_date,
  coalesce(sale_price, list_price, 0) AS amount, {here} AS here FROM base WHERE trim({role}_agent) <> ''),
totals AS (SELECT agent_name, CAST(count(*) AS BIGINT) AS sides, CAST(sum(amount) AS BIGINT) AS volume,
  CAST(count(*) FILTER (WHERE amount >= 500000) AS BIGINT) AS high_value, max(close_date) AS most_recent
  FROM rows_ WHERE here GROUP BY agent_name),
o AS {_top("rows_", "agent_name", "office", 1)}, w AS {_top("rows_", "agent_name", "city", 3)}
SELECT t.*, o.v AS office, w.v AS towns, volume / sides AS avg_price FROM totals t
LEFT JOIN o USING (agent_name) LEFT JOIN w USING (agent_name) ORDER BY sides DESC, volume DESC, agent_name LIMIT 30"""


def _combined(keys: str) -> str:
    return f""", rows_ AS (SELECT agent AS agent_name, lower(city) AS town, * FROM all_sides WHERE trim(agent) <> ''),
totals AS (SELECT {keys}, CAST(count(*) AS BIGINT) AS total_sides,
  CAST(count(*) FILTER (WHERE role = 'listing') AS BIGINT) AS listing_sides,
  CAST(count(*) FILTER (WHERE role = 'buyer') AS BIGINT) AS buyer_sides,
  CAST(sum(coalesce(sale_price, 0)) AS BIGINT) AS volume, max(close_date) AS most_recent FROM rows_ GROUP BY {keys}),
o AS {_top("rows_", keys, "office", 1)}, w AS {_top("rows_", keys, "city", 3)},
board AS (SELECT t.*, o.v AS office, w.v AS towns, volume / total_sides AS avg_price FROM totals t
  LEFT JOIN o USING ({keys}) LEFT JOIN w USING ({keys}))"""


def _scoped_ctes(role: str, where: str, keys: str) -> str:
    return f""", filtered AS (SELECT {role}_agent AS agent_name, {role}_office AS office, city, lower(city) AS town, sale_date,
  coalesce(sale_price, list_price, 0) AS amount FROM listings WHERE {where} AND {role}_agent IS NOT NULL),
totals AS (SELECT {keys}, CAST(count(*) AS BIGINT) AS sides, CAST(sum(amount) AS BIGINT) AS volume,
  CAST(count(*) FILTER (WHERE amount >= 500000) AS BIGINT) AS high_value, max(sale_date) AS most_recent
  FROM filtered WHERE office IS NULL OR lower(agent_name) <> lower(office) GROUP BY {keys}),
o AS {_top("filtered", keys, "office", 1)}, w AS {_top("filtered", keys, "city", 3)},
board AS (SELECT t.*, o.v AS office, w.v AS towns, CAST(floor(volume / sides) AS BIGINT) AS avg_price FROM totals t
  LEFT JOIN o USING ({keys}) LEFT JOIN w USING ({keys}))"""


def _money(x: str) -> str:
    return (f"CASE WHEN coalesce({x}, 0) = 0 THEN '$0' WHEN {x} >= 1000000 THEN '$' || format('{{:.1f}}', {x} / 1000000) || 'M' "
            f"WHEN {x} >= 1000 THEN '$' || format('{{:.0f}}', {x} / 1000) || 'K' ELSE '$' || {x} END")


def _money_na(x: str) -> str:
    return (f"CASE WHEN coalesce({x}, 0) = 0 THEN 'N/A' WHEN {x} >= 1000000000 THEN '$' || format('{{:.1f}}', {x} / 1000000000) || 'B' "
            f"ELSE {_money(x)} END")


def _grouped(x: str) -> str:
    return f"format('{{:,}}', {x})"


def _trend(name: str, n: int, board: str, rolling: str) -> str:
    label = _money("rolling_volume")
    return f"""
SELECT {name}, CAST(rolling_rank AS INTEGER) AS rolling_rank, rolling_volume, all_time_rank IS NULL AS is_new,
  CAST(coalesce(all_time_rank - rolling_rank, 0) AS INTEGER) AS rank_change,
  CASE WHEN all_time_rank IS NULL THEN 'NEW' WHEN all_time_rank > rolling_rank THEN '▲' || (all_time_rank - rolling_rank) || ' (' || {label} || ')'
    WHEN all_time_rank < rolling_rank THEN '▼' || (rolling_rank - all_time_rank) || ' (' || {label} || ')'
    ELSE '— (' || {label} || ')' END AS label
FROM (SELECT {name}, volume AS rolling_volume, row_number() OVER (ORDER BY volume DESC, {name}) AS rolling_rank
  FROM ({rolling}) QUALIFY rolling_rank <= {n}) r
LEFT JOIN (SELECT {name}, row_number() OVER (ORDER BY volume DESC, {name}) AS all_time_rank
  FROM ({board}) QUALIFY all_time_rank <= {n}) a USING ({name})"""


_AGENT_VOLUME = """SELECT listing_agent AS agent_name, CAST(sum(coalesce(sale_price, list_price, 0)) AS BIGINT) AS volume FROM listings
  WHERE listing_agent IS NOT NULL AND (listing_office IS NULL OR lower(listing_agent) <> lower(listing_office)) {} GROUP BY 1"""
_OFFICE_VOLUME = """SELECT listing_office AS office, CAST(sum(coalesce(sale_price, list_price, 0)) AS BIGINT) AS volume FROM listings
  WHERE listing_office IS NOT NULL {} GROUP BY 1"""
_YEAR = "AND sale_date >= DATE '2000-08-01'"


def _brokerages(keys: str, weight: str) -> str:
    join = "USING (brokerage" + (", town)" if keys else ")")
    k = keys
    return f""", joined AS (SELECT p.*, {k} local_sales_count FROM profiles p JOIN profile_towns t USING (profile_url)),
once AS (SELECT profile_url, {k} any_value(office_name) AS office_name, any_value(profile_type) AS profile_type,
  any_value(profile_name) AS profile_name, any_value(sales_last_12_months) AS s12, any_value(avg_price_3yr) AS price,
  sum(local_sales_count) AS local, count(*) AS appearances FROM joined GROUP BY {k} profile_url),
staff AS (SELECT {k} office_name AS brokerage, count(*) AS agent_count, sum(local) AS agent_sales,
  sum(coalesce(s12, 0) * {weight}) AS agent_12mo_sales,
  sum(CASE WHEN price > 0 THEN price * {weight} END) AS tp, sum(CASE WHEN price > 0 THEN {weight} END) AS tw
  FROM once WHERE profile_type IN ('individual', 'team') AND office_name IS NOT NULL GROUP BY {k} office_name),
own AS (SELECT {k} profile_name AS brokerage, sum(local) AS direct_sales, max(s12) AS direct_12mo
  FROM once WHERE profile_type = 'brokerage' GROUP BY {k} profile_name),
merged AS (SELECT {k} brokerage, CAST(coalesce(agent_count, 0) AS BIGINT) AS agent_count, CAST(coalesce(agent_sales, 0) AS BIGINT) AS agent_sales,
  CAST(coalesce(agent_12mo_sales, 0) AS BIGINT) AS agent_12mo_sales, CAST(floor(tp / tw) AS BIGINT) AS avg_price,
  CAST(direct_sales AS BIGINT) AS direct_sales, CAST(coalesce(direct_12mo, agent_12mo_sales, 0) AS BIGINT) AS sales_12mo,
  CAST(coalesce(direct_sales, agent_sales, 0) AS BIGINT) AS total_sales FROM staff FULL OUTER JOIN own {join}),
board AS (SELECT *, total_sales * avg_price AS est_volume FROM merged)"""


_CARD_FIELDS = """mls_number AS page_id, 0 AS position, CASE status WHEN 'New' THEN 'Active' ELSE status END AS status,
  address, city, state, zip, true AS place_ok, beds, CAST(beds AS DOUBLE) AS baths, sqft, listing_office,
  'https://example.com/listings/' || detail_url AS detail_url"""

_STATUS_OF_TEXT = """CASE WHEN contains(t, 'captcha') OR contains(t, 'perimeterx') OR contains(t, 'verify you are human')
  OR contains(t, 'before we continue') OR contains(t, 'press and hold') OR contains(t, 'press & hold') OR contains(t, 'security check') THEN 'captcha'
  WHEN contains(t, 'access to this page has been denied') OR contains(t, 'request unsuccessful') OR contains(t, '403 forbidden')
  OR contains(t, 'temporarily unavailable') OR contains(t, 'access denied') THEN 'blocked'"""


def _fuzzy_merge(name: str, office: str, threshold: int, passes: int = 6) -> str:
    """The greedy passes, row by row: each pass walks the rows in order and carries the names merged so far.

    Passes are unrolled; the last ones find nothing to merge.
    """
    parts = [f"t0 AS (SELECT {name} AS name, {office} AS office, count(*) AS cnt FROM part WHERE {name} IS NOT NULL GROUP BY ALL)",
             f"""score AS (SELECT x.name AS a, y.name AS b, list_reduce(list_prepend([0 for i in range(length(y.name) + 1)], [[ascii(c)] for c in string_split(x.name, '')]),
  lambda row, ch: list_reduce(list_prepend([0], [[j] for j in range(1, length(y.name) + 1)]), lambda acc, j: list_append(acc,
    CASE WHEN ascii(y.name[j[1]:j[1]]) = ch[1] THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], acc[j[1]]) END)))[length(y.name) + 1] AS lcs
  FROM (SELECT DISTINCT name FROM t0) x, (SELECT DISTINCT name FROM t0) y WHERE x.name <> y.name)""",
             f"near AS (SELECT a, b FROM score WHERE 200 * lcs >= {threshold} * (length(a) + length(b)))"]
    for k in range(passes):
        parts += [
            f"r{k} AS (SELECT *, row_number() OVER (ORDER BY cnt DESC, name, office NULLS FIRST) AS i FROM t{k})",
            f"""reach{k} AS (SELECT x.i, x.name, coalesce((SELECT list(y.name ORDER BY y.i) FROM r{k} y JOIN near ON near.b = y.name
  WHERE near.a = x.name AND y.i > x.i AND y.office IS NOT DISTINCT FROM x.office), []) AS found FROM r{k} x)""",
            f"""walk{k} AS (SELECT 0::BIGINT AS i, []::VARCHAR[] AS gone, []::VARCHAR[] AS into_ UNION ALL
  SELECT w.i + 1, CASE WHEN list_contains(gone, r.name) THEN gone ELSE gone || list_filter(found, lambda x: NOT list_contains(gone, x)) END,
    CASE WHEN list_contains(gone, r.name) THEN into_ ELSE into_ || [r.name FOR x IN found IF NOT list_contains(gone, x)] END
  FROM walk{k} w JOIN reach{k} r ON r.i = w.i + 1)""",
            f"m{k} AS (SELECT unnest(gone) AS old, unnest(into_) AS new FROM (SELECT * FROM walk{k} ORDER BY i DESC LIMIT 1))",
            f"f{k} AS (SELECT old, new, 1 AS n FROM m{k} UNION ALL SELECT f.old, m.new, n + 1 FROM f{k} f JOIN m{k} m ON m.old = f.new)",
            f"e{k} AS (SELECT old, arg_max(new, n) AS new FROM f{k} GROUP BY old)",
            f"t{k + 1} AS (SELECT coalesce(new, name) AS name, office, sum(cnt) AS cnt FROM t{k} LEFT JOIN e{k} ON old = name GROUP BY ALL)"]
    total = "e0"
    for k in range(1, passes):
        parts.append(f"""all{k} AS (SELECT x.old, coalesce(e{k}.new, x.new) AS new FROM {total} x LEFT JOIN e{k} ON e{k}.old = x.new
  UNION ALL SELECT old, new FROM e{k} WHERE old NOT IN (SELECT old FROM {total}))""")
        total = f"all{k}"
    return "WITH RECURSIVE " + ",\n".join(parts) + f"\nSELECT old AS old_name, new AS merged_into FROM {total}"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["agent_kpis"] = _with(*_L, _kpi_cte("agent")) + "SELECT * FROM kpi"
    q["agent_kpis_one_town"] = _with(*_L, _kpi_cte("agent", "nation_3")) + f"SELECT * FROM kpi ORDER BY {_KPI_ORDER} LIMIT 50"
    q["brokerage_kpis"] = _with(*_L, _kpi_cte("office")) + "SELECT * FROM kpi"
    for kind in ("agent", "brokerage"):
        q[f"{kind}_kpis_by_town_top50"] = _with(*_L, _kpi_cte(kind, by_town=True)) + f"""
SELECT * REPLACE (CAST(rank AS INTEGER) AS rank) FROM (
  SELECT *, row_number() OVER (PARTITION BY town ORDER BY {_KPI_ORDER}) AS rank FROM kpi) WHERE rank <= 50"""
    q["rank_movers_agents"] = _movers("agent", True)
    q["rank_movers_brokerages"] = _movers("office", False)
    q["agent_ranks"] = _with(*_L, _kpi_cte("agent"), _ranked()) + "SELECT name, current_rank, prior_rank, delta, is_new FROM ranked"

    q["side_board_listing"] = _side_board("listing")
    q["side_board_buyer"] = _side_board("buyer")
    q["side_board_one_town"] = _side_board("listing", "nation_3")
    q["combined_board"] = _with(*_L) + _combined("agent_name") + "SELECT * FROM board ORDER BY total_sides DESC, volume DESC, agent_name LIMIT 30"
    q["town_top5"] = _with(*_L) + _combined("town, agent_name") + """
SELECT * REPLACE (CAST(rank AS INTEGER) AS rank) FROM (SELECT *, row_number() OVER (PARTITION BY town
  ORDER BY total_sides DESC, volume DESC, agent_name) AS rank FROM board) WHERE rank <= 5"""
    q["brokerage_board"] = _with(*_L) + f""", rows_ AS (SELECT office AS brokerage, agent, sale_price FROM all_sides WHERE trim(office) <> ''),
totals AS (SELECT brokerage, CAST(count(*) AS BIGINT) AS sides, CAST(sum(coalesce(sale_price, 0)) AS BIGINT) AS volume,
  CAST(count(DISTINCT agent) AS BIGINT) AS agent_count FROM rows_ GROUP BY 1),
a AS {_top("rows_", "brokerage", "agent", 3)}
SELECT t.*, a.v AS top_agents, volume / sides AS avg_price FROM totals t LEFT JOIN a USING (brokerage)
ORDER BY sides DESC, volume DESC, brokerage LIMIT 20"""
    totals = """SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE enrichment_status = 'success') AS BIGINT) AS enriched,
  CAST(count(listing_agent) AS BIGINT) AS has_listing, CAST(count(buyer_agent) AS BIGINT) AS has_buyer, min(close_date) AS date_min,
  max(close_date) AS date_max, CAST(sum(coalesce(sale_price, 0)) AS BIGINT) AS volume FROM listings"""
    q["listing_stats"] = _with(LISTINGS) + totals + " WHERE status = 'Closed'"
    q["listing_stats_all"] = _with(LISTINGS) + totals
    q["town_counts_thin"] = _with(*_L) + """SELECT city, CAST(count(*) AS BIGINT) AS n, count(*) < 160 AS thin FROM base
WHERE city IS NOT NULL GROUP BY city"""

    q["scoped_agents"] = _with(LISTINGS) + _scoped_ctes("listing", "data_source = 'feed_a'", "agent_name") + \
        "SELECT * FROM board ORDER BY volume DESC, agent_name LIMIT 30"
    q["scoped_agents_buyer_since"] = _with(LISTINGS) + _scoped_ctes(
        "buyer", "sale_date >= DATE '1999-01-01' AND lower(city) = 'nation_3'", "agent_name") + \
        "SELECT * FROM board ORDER BY volume DESC, agent_name LIMIT 30"
    q["scoped_town_top5"] = _with(LISTINGS) + _scoped_ctes("buyer", "city IS NOT NULL", "town, agent_name") + """
SELECT town, CAST(rank AS INTEGER) AS rank, agent_name, office, sides, volume, avg_price FROM (
  SELECT *, row_number() OVER (PARTITION BY town ORDER BY volume DESC, agent_name) AS rank FROM board) WHERE rank <= 5"""
    q["scoped_brokerages"] = _with(LISTINGS) + f""", filtered AS (SELECT listing_office AS office, listing_agent AS agent_name, city,
  coalesce(sale_price, list_price, 0) AS amount FROM listings WHERE data_source = 'feed_b' AND listing_office IS NOT NULL),
a AS {_top("filtered", "office", "agent_name", 3)}, w AS {_top("filtered", "office", "city", 3)}
SELECT t.*, a.v AS top_agents, w.v AS towns, CAST(floor(volume / sides) AS BIGINT) AS avg_price
FROM (SELECT office, CAST(count(*) AS BIGINT) AS sides, CAST(sum(amount) AS BIGINT) AS volume FROM filtered GROUP BY 1) t
LEFT JOIN a USING (office) LEFT JOIN w USING (office) ORDER BY volume DESC, office LIMIT 20"""
    q["rankings"] = _with(LISTINGS) + f""", rows_ AS (SELECT listing_agent AS agent_name, listing_office AS office, city, sale_date,
  coalesce(sale_price, list_price, 0) AS amount FROM listings WHERE listing_agent IS NOT NULL),
o AS {_top("rows_", "agent_name", "office", 1)}, w AS {_top("rows_", "agent_name", "city", 3)}
SELECT t.*, o.v AS listing_office, w.v AS primary_towns, listing_volume / total_listing_sides AS avg_listing_price
FROM (SELECT agent_name, CAST(count(*) AS BIGINT) AS total_listing_sides, CAST(sum(amount) AS BIGINT) AS listing_volume,
  CAST(count(*) FILTER (WHERE amount >= 500000) AS BIGINT) AS high_value_listings, max(sale_date) AS most_recent_sale
  FROM rows_ GROUP BY 1) t LEFT JOIN o USING (agent_name) LEFT JOIN w USING (agent_name)"""
    q["trend_agents"] = _with(LISTINGS) + _trend("agent_name", 30, _AGENT_VOLUME.format(""), _AGENT_VOLUME.format(_YEAR))
    q["trend_brokerages"] = _with(LISTINGS) + _trend("office", 20, _OFFICE_VOLUME.format(""), _OFFICE_VOLUME.format(_YEAR))
    q["scoped_stats"] = _with(LISTINGS) + """SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(listing_agent) AS BIGINT) AS with_agent,
  CAST(count(DISTINCT listing_agent) AS BIGINT) AS unique_agents, min(sale_date) AS date_min, max(sale_date) AS date_max
FROM listings WHERE data_source = 'feed_a'"""
    q["scoped_breakdown"] = _with(LISTINGS) + """SELECT 'source' AS kind, data_source AS value, CAST(count(*) AS BIGINT) AS n FROM listings GROUP BY 2
UNION ALL SELECT 'town', city, CAST(count(*) AS BIGINT) FROM listings WHERE city IS NOT NULL GROUP BY 2"""
    q["enrichment_stats"] = _with(LISTINGS) + """SELECT CAST(count(source_url) AS BIGINT) AS total,
  CAST(count(source_url) FILTER (WHERE enrichment_status IS NULL) AS BIGINT) AS pending,
  CAST(count(*) FILTER (WHERE enrichment_status = 'success') AS BIGINT) AS success,
  CAST(count(*) FILTER (WHERE enrichment_status = 'no_agent') AS BIGINT) AS no_agent,
  CAST(count(*) FILTER (WHERE enrichment_status = 'error') AS BIGINT) AS error FROM listings"""

    live = """detail_url, mls_number, status, address, city, state, zip, list_price, list_date, days_on_market, beds, baths, sqft,
  year_built, lot_sqft, property_type, description, photo_url, listing_agent, listing_agent_email, listing_agent_id, listing_office, last_seen_at"""
    q["live_listings"] = _with(LISTINGS) + f"""SELECT {live} FROM listings WHERE status IN ('Active', 'Pending')
AND lower(city) IN ('nation_3', 'nation_4') AND days_on_market >= 30"""
    q["stale_listings"] = _with(LISTINGS) + """SELECT detail_url, address, city, status, list_price, list_date, days_on_market, beds, baths,
  sqft, property_type, listing_agent, listing_agent_email, listing_office FROM listings WHERE status = 'Active' AND days_on_market >= 60"""
    q["new_since"] = _with(LISTINGS) + """SELECT detail_url, address, city, status, list_price, list_date, beds, baths, sqft, listing_agent,
  listing_agent_email, listing_office, least(discovered_at, last_seen_at) AS first_snap FROM listings
WHERE status IN ('Active', 'Pending') AND least(discovered_at, last_seen_at) >= TIMESTAMP '2000-01-01'"""
    q["history_changes"] = _with(_OBSERVATIONS, _HISTORY) + "SELECT detail_url, snapshot_date, seq, status, list_price FROM history"
    q["listing_timeline"] = _with(_OBSERVATIONS, _HISTORY) + """SELECT detail_url, snapshot_date, seq, status, list_price,
  lead(snapshot_date) OVER (PARTITION BY detail_url ORDER BY snapshot_date, seq) AS valid_to FROM history"""
    q["history_carry_forward"] = _with(_OBSERVATIONS) + """, known0 AS (SELECT * FROM obs WHERE status IS NOT NULL OR list_price IS NOT NULL),
known AS (SELECT detail_url, observed_at, seq, last_value(status IGNORE NULLS) OVER w AS status,
  last_value(list_price IGNORE NULLS) OVER w AS list_price FROM known0
  WINDOW w AS (PARTITION BY detail_url ORDER BY observed_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
stepped AS (SELECT *, row_number() OVER w AS rn, lag(status) OVER w AS ps, lag(list_price) OVER w AS pp FROM known
  WINDOW w AS (PARTITION BY detail_url ORDER BY observed_at, seq))
SELECT detail_url, observed_at AS snapshot_date, seq, status, list_price FROM stepped
WHERE rn = 1 OR status IS DISTINCT FROM ps OR list_price IS DISTINCT FROM pp"""
    q["latest_state"] = _with(_OBSERVATIONS) + """SELECT detail_url, observed_at, seq, status, list_price FROM obs
QUALIFY row_number() OVER (PARTITION BY detail_url ORDER BY observed_at DESC, seq DESC) = 1"""
    q["first_seen"] = _with(_OBSERVATIONS, _HISTORY) + "SELECT detail_url, min(snapshot_date) AS first_snap FROM history GROUP BY 1"
    gone = "status IN ('Active', 'Pending') AND last_seen_at < TIMESTAMP '2001-07-25'"
    q["withdrawn_sweep"] = _with(LISTINGS) + f"""SELECT detail_url, CASE WHEN {gone} THEN 'Withdrawn' ELSE status END AS status,
  {gone} AS swept, last_seen_at FROM listings"""
    q["sweep_history"] = _with(LISTINGS) + f"""SELECT detail_url, TIMESTAMP '2001-08-01' AS snapshot_date, CAST(0 AS BIGINT) AS seq,
  'Withdrawn' AS status, list_price FROM listings WHERE {gone}"""

    at = "(observed_at, seq)"
    known = lambda c: f"arg_max({c}, {at}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    newest = lambda c, name: f"arg_max_null({c}, {at}) AS {name}"
    oldest = lambda c, name: f"arg_min_null({c}, {at}) AS {name}"
    q["merge_listings"] = _with(_OBSERVATIONS) + f"""SELECT detail_url, {known('sale_price')}, {known('list_price')}, {known('listing_office')},
  {known('status')}, max(observed_at) AS last_seen_at, {oldest('listing_agent', 'address')}, {oldest('town', 'city')},
  {oldest('page', 'beds')}, min(observed_at) AS discovered_at FROM obs GROUP BY 1"""
    q["merge_enrichment"] = _with(_OBSERVATIONS) + f""", good AS (SELECT detail_url, arg_max(town, {at}) AS mls_number, {known('listing_office')},
  {known('sale_price')}, {known('list_price')}, {known('status')}, {newest('listing_agent', 'listing_agent')},
  {newest('listing_office', 'buyer_agent')}, {newest('run', 'close_date')}, {newest('page', 'days_on_market')}
  FROM obs WHERE outcome = 'success' GROUP BY 1),
tries AS (SELECT detail_url, arg_max(outcome, {at}) AS enrichment_status, CAST(count(*) AS INTEGER) AS enrichment_attempts,
  max(observed_at) AS enriched_at FROM obs GROUP BY 1)
SELECT * FROM tries LEFT JOIN good USING (detail_url)"""
    order = "(sale_date, l_suppkey, flag, sale_price, address, represented_side)"
    q["merge_transactions"] = _with(_SALES, _KEYED) + f"""SELECT CAST(l_orderkey AS VARCHAR) AS mls_number,
  arg_max(sale_price, {order}) FILTER (WHERE flag <> 'R') AS sale_price,
  'Jane O''Brien-' || arg_max(flag, {order}) AS listing_agent,
  CASE WHEN bool_or(flag <> 'N') THEN 'John Smith' END AS buyer_agent, 'LandVest, Inc.' AS listing_office, 'Red Post Realty, LLC' AS buyer_office,
  3 AS beds, CAST(2.5 AS DOUBLE) AS baths, 1800 AS sqft, CAST(NULL AS INTEGER) AS year_built, 12 AS days_on_market,
  arg_min(address, {order}) AS address FROM keyed GROUP BY l_orderkey"""
    q["merge_profile_sales"] = _with(_SALES, _KEYED) + """SELECT observation_id, any_value(profile_url) AS agent_profile_url,
  arg_max(represented_side, (sale_date, l_orderkey, flag)) AS represented_side, any_value(sale_price) AS sale_price,
  any_value(sale_date) AS sale_date, any_value(normalized_address) AS normalized_address,
  any_value(transaction_match_key) AS transaction_match_key, 'Jane Doe' AS listing_agent, 'Samonas Realty, LLC' AS listing_office
FROM keyed GROUP BY observation_id"""
    k2 = lambda c, name: f"arg_max({c}, {at}) FILTER (WHERE {c} IS NOT NULL) AS {name}"
    q["merge_profiles"] = _with(_OBSERVATIONS) + f"""SELECT detail_url AS profile_url, {k2('listing_agent', 'raw_card_text')},
  {k2('listing_office', 'profile_name')}, {k2('status', 'office_name')}, {k2('page', 'sales_last_12_months')},
  CAST(NULL AS VARCHAR) AS price_range, {newest('outcome', 'profile_type')}, min(observed_at) AS discovered_at FROM obs GROUP BY 1"""
    q["merge_profile_towns"] = _with(_OBSERVATIONS) + """SELECT detail_url AS profile_url, town, max(page) AS local_sales_count,
  min(observed_at) AS discovered_at FROM obs GROUP BY 1, 2"""
    q["merge_sold_rows"] = _with(_OBSERVATIONS) + f"""SELECT detail_url AS profile_url, town AS zpid, CAST(max(run) AS VARCHAR) AS sold_date,
  {newest('sale_price', 'closing_price')}, {newest('status', 'represented')}, {oldest('listing_agent', 'address')}, '' AS city_state,
  CAST(NULL AS VARCHAR) AS beds, CAST(NULL AS VARCHAR) AS baths, min(observed_at) AS created_at FROM obs GROUP BY 1, 2"""
    q["member_profiles"] = _with(_PROFILES) + """, linked AS (
  SELECT 'https://example.com/profile/' || (l_partkey * 2) AS profile_url, 'Member ' || arg_max(l_suppkey, (first_at, l_suppkey)) AS name
  FROM (SELECT l_suppkey, l_partkey, min(l_shipdate) AS first_at FROM lineitem GROUP BY 1, 2) GROUP BY l_partkey)
SELECT profile_url, CASE WHEN l.name IS NOT NULL THEN 'individual' ELSE profile_type END AS profile_type,
  coalesce(l.name, profile_name) AS profile_name FROM profiles FULL OUTER JOIN linked l USING (profile_url)"""

    q["merge_profile_status"] = _with(_OBSERVATIONS) + f"""SELECT detail_url AS profile_url, {k2('listing_agent', 'profile_name')},
  {k2('listing_office', 'office_name')}, CAST(arg_max(page, {at}) AS BIGINT) AS sales_last_12_months,
  CAST(100 * arg_max(list_price, {at}) FILTER (WHERE list_price IS NOT NULL) AS BIGINT) AS total_sales,
  CAST(1000 * arg_max(sale_price, {at}) FILTER (WHERE sale_price IS NOT NULL) AS BIGINT) AS average_price,
  arg_max(town, {at}) FILTER (WHERE page > 50) AS price_range, {newest('outcome', 'scrape_status')},
  arg_max_null(CASE WHEN outcome <> 'success' THEN town END, {at}) AS last_error, max(observed_at) AS last_scraped_at,
  CAST(count(*) AS BIGINT) AS scrape_attempts FROM obs GROUP BY 1"""
    line = "(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_returnflag)"
    q["merge_team_members"] = f"""SELECT l_suppkey AS team_profile_url, l_partkey % 50 AS member_profile_url,
  arg_max('Part ' || l_partkey || l_returnflag, {line}) FILTER (WHERE l_returnflag <> 'R') AS member_name,
  min(l_shipdate) AS discovered_at FROM lineitem GROUP BY 1, 2"""
    place = "(sale_date, l_orderkey, flag, sale_price, normalized_address)"
    q["merge_team_sales"] = _with(_SALES, _KEYED) + f""", made AS (SELECT *, lower(represented_side) AS side, left(transaction_match_key, 2) AS k FROM keyed)
SELECT profile_url AS team_profile_url, side AS represented_side, k AS transaction_match_key,
  CASE WHEN bool_or(flag = 'A') THEN 'Team ' || any_value(l_suppkey) END AS team_name,
  'https://example.com/home/' || arg_max(l_orderkey, {place}) AS property_url,
  arg_max(city, {place}) FILTER (WHERE sale_price > 30000) AS local_town, arg_min(sale_date, {place}) AS sale_date,
  arg_min(sale_price, {place}) AS sale_price, arg_min(normalized_address, {place}) AS normalized_address,
  arg_min(normalized_address_hash, {place}) AS normalized_address_hash, CAST(min(sale_date) AS TIMESTAMP) AS created_at
FROM made WHERE flag <> 'R' GROUP BY 1, 2, 3
UNION ALL SELECT profile_url, side, NULL, CAST(NULL AS VARCHAR), 'https://example.com/home/' || l_orderkey,
  CASE WHEN sale_price > 30000 THEN city END, sale_date, sale_price, normalized_address, normalized_address_hash,
  CAST(sale_date AS TIMESTAMP) FROM made WHERE flag = 'R'"""

    q["run_deltas"] = _with(_OBSERVATIONS, _MARKED) + """SELECT run, town, CAST(count(*) AS BIGINT) AS listings,
  CAST(count(*) FILTER (WHERE is_new) AS BIGINT) AS new_listings, CAST(count(*) FILTER (WHERE changed) AS BIGINT) AS status_changes
FROM marked GROUP BY 1, 2"""
    q["run_anomaly"] = _with(_OBSERVATIONS, _MARKED) + """SELECT date_trunc('minute', observed_at) AS run, CAST(count(DISTINCT town) AS BIGINT) AS towns_seen,
  CAST(count(*) AS BIGINT) AS listings, CAST(count(*) FILTER (WHERE is_new) AS BIGINT) AS new_listings,
  CAST(count(*) FILTER (WHERE changed) AS BIGINT) AS status_changes,
  count(DISTINCT town) >= 1 AND count(*) FILTER (WHERE is_new OR changed) = 0 AS suspicious FROM marked GROUP BY 1"""
    q["run_outcome"] = _with(_OBSERVATIONS) + """SELECT run || CASE WHEN page < 75 THEN ' day' ELSE ' night' END AS run, CAST(count(*) FILTER (WHERE outcome = 'success') AS BIGINT) AS enriched,
  CAST(count(*) FILTER (WHERE outcome <> 'success') AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS total,
  round(count(*) FILTER (WHERE outcome = 'success') / count(*) * 100, 1) AS success_pct,
  CASE WHEN count(*) FILTER (WHERE outcome <> 'success') * 10 > count(*) FILTER (WHERE outcome = 'success') AND count(*) > 100
    THEN 'warning' ELSE 'ok' END AS verdict FROM obs GROUP BY 1"""
    q["all_known_pages"] = _with(_OBSERVATIONS, _MARKED) + """SELECT run, town, page, CAST(count(*) AS BIGINT) AS cards,
  bool_and(NOT is_new) AS all_known FROM marked GROUP BY 1, 2, 3"""
    q["withdrawn_sessions"] = _with(_OBSERVATIONS) + """, apart AS (SELECT *, CASE WHEN observed_at - lag(observed_at) OVER w < INTERVAL 48 HOUR THEN 0 ELSE 1 END AS first
  FROM obs WINDOW w AS (PARTITION BY detail_url ORDER BY observed_at, seq)),
sessions AS (SELECT *, sum(first) OVER (PARTITION BY detail_url ORDER BY observed_at, seq) AS session FROM apart)
SELECT detail_url, last_seen + INTERVAL 48 HOUR AS snapshot_date, seq, 'Withdrawn' AS status, list_price FROM (
  SELECT detail_url, max(observed_at) AS last_seen, last(seq ORDER BY observed_at, seq) AS seq,
    last(status ORDER BY observed_at, seq) FILTER (status IS NOT NULL) AS status,
    last(list_price ORDER BY observed_at, seq) FILTER (list_price IS NOT NULL) AS list_price FROM sessions GROUP BY detail_url, session)
WHERE status IN ('Active', 'Pending')"""
    q["daily_change_counts"] = _with(_OBSERVATIONS.replace("'error' THEN NULL", "'error' THEN 'Withdrawn'"), _HISTORY) + """SELECT CAST(snapshot_date AS DATE) AS day,
  CASE WHEN rn = 1 THEN 'new' WHEN status = 'Withdrawn' THEN 'withdrawn' ELSE 'changed' END AS kind,
  CAST(count(*) AS BIGINT) AS n FROM history GROUP BY 1, 2"""
    q["retry_queue_listings"] = _with(LISTINGS) + """SELECT detail_url, city, discovered_at FROM listings
WHERE (enrichment_status IS NULL OR enrichment_status = 'error') AND enrichment_attempts < 2 ORDER BY discovered_at DESC, detail_url LIMIT 50"""
    q["retry_queue_transactions"] = _with(LISTINGS) + """SELECT mls_number, source_url FROM listings
WHERE (enrichment_status IS NULL OR (enrichment_status = 'error' AND enrichment_attempts < 3)) AND source_url IS NOT NULL
ORDER BY mls_number LIMIT 200"""
    teams_first = "ORDER BY CASE profile_type WHEN 'team' THEN 0 ELSE 1 END, profile_url"
    q["retry_queue_profiles"] = _with(_PROFILES) + f"""SELECT profile_url, profile_type, profile_name FROM profiles WHERE scrape_status IS NULL
OR (scrape_status IN ('failed', 'blocked', 'captcha') AND scrape_attempts < 3) {teams_first} LIMIT 25"""
    q["enrich_queue_profiles"] = _with(_PROFILES) + f"""SELECT profile_url, profile_type FROM profiles
WHERE (enrichment_status IS NULL OR enrichment_status = 'error') AND scrape_attempts < 2 {teams_first} LIMIT 50"""
    kept = "property_type IN ('Single Family Residential', 'Condo/Co-op')"
    q["purge_preview"] = _with(LISTINGS) + f"""SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(property_type) AS BIGINT) AS tagged,
  CAST(count(*) FILTER (WHERE {kept}) AS BIGINT) AS kept, CAST(count(*) FILTER (WHERE NOT {kept}) AS BIGINT) AS dropped_typed,
  CAST(count(*) FILTER (WHERE property_type IS NULL) AS BIGINT) AS dropped_untyped, count(*) FILTER (WHERE {kept}) = 0 AS refused FROM listings"""
    q["purge_types"] = _with(LISTINGS) + f"SELECT mls_number, property_type, city FROM listings WHERE {kept}"

    q["normalized_agents"] = """SELECT c_custkey, 'Jane O''Brien-' || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' ' || c_name AS agent
FROM customer"""
    q["normalized_places"] = """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'York' WHEN 'HOUSEHOLD' THEN 'Old Orchard Beach'
  WHEN 'MACHINERY' THEN 'Saco' ELSE c_name END AS town, CASE c_mktsegment WHEN 'BUILDING' THEN 'LandVest, Inc.' ELSE c_mktsegment END AS office,
  c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') AS listed,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Old Orchard Beach' ELSE c_mktsegment END AS spelled FROM customer"""
    q["address_keys"] = _with(_SALES, _KEYED) + "SELECT l_orderkey, l_suppkey, flag, normalized_address, normalized_address_hash FROM keyed"
    q["match_keys"] = _with(_SALES, _KEYED) + "SELECT l_orderkey, l_suppkey, flag, transaction_match_key, observation_id FROM keyed"
    q["split_addresses"] = _with(_SALES, _KEYED) + """SELECT l_orderkey, flag, CASE WHEN flag = 'R' THEN CAST(l_partkey AS VARCHAR) ELSE address END AS street,
  CASE flag WHEN 'A' THEN 'Old Orchard Beach' WHEN 'N' THEN 'York' ELSE 'Summer Street #' || l_linenumber || ' Bath' END AS city,
  'ME' AS state, zip FROM raw"""

    q["team_gap"] = _with(_SALES, _KEYED, _TEAMS) + "SELECT * FROM gap"
    q["team_gap_summary"] = _with(_SALES, _KEYED, _TEAMS) + "SELECT team_name, local_town, CAST(count(*) AS BIGINT) AS unresolved FROM gap GROUP BY 1, 2"
    q["team_gap_detail"] = _with(_SALES, _KEYED, _TEAMS) + """SELECT team_name, team_profile_url, local_town, represented_side, sale_date, sale_price, property_url
FROM gap ORDER BY team_name, sale_date DESC, property_url, represented_side, sale_price LIMIT 100"""
    q["cross_source_match"] = _with(_SALES, _KEYED, _TEAMS) + """SELECT transaction_match_key, l.n AS left_rows, r.n AS right_rows
FROM (SELECT transaction_match_key, CAST(count(*) AS BIGINT) AS n FROM team GROUP BY 1) l
JOIN (SELECT transaction_match_key, CAST(count(*) AS BIGINT) AS n FROM individual GROUP BY 1) r USING (transaction_match_key)"""
    q["fuzzy_merge"] = _fuzzy_merge("p_name", "p_brand", 80)
    q["fuzzy_merge_chains"] = _fuzzy_merge("p_name", "p_brand", 66)
    q["fuzzy_edges"] = """WITH counts AS (SELECT p_name AS name, p_brand AS office, count(*) AS cnt FROM part GROUP BY 1, 2),
pairs AS (SELECT x.office, x.name AS a, CAST(x.cnt AS BIGINT) AS a_cnt, y.name AS b, CAST(y.cnt AS BIGINT) AS b_cnt
  FROM counts x JOIN counts y ON x.office = y.office AND (x.cnt > y.cnt OR (x.cnt = y.cnt AND x.name < y.name))
  AND abs(length(x.name) - length(y.name)) <= 0.2 * (length(x.name) + length(y.name))),
words AS (SELECT DISTINCT a, b FROM pairs),
cells AS (SELECT a, b, list_reduce(list_prepend([0 for i in range(length(b) + 1)], [[ascii(c)] for c in string_split(a, '')]),
  lambda row, ch: list_reduce(list_prepend([0], [[j] for j in range(1, length(b) + 1)]),
    lambda acc, j: list_append(acc, CASE WHEN ascii(b[j[1]:j[1]]) = ch[1] THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], acc[j[1]]) END)))
  AS last_row FROM words)
SELECT office, a, a_cnt, b, b_cnt, round(200.0 * last_row[length(b) + 1] / (length(a) + length(b)), 6) AS score
FROM pairs JOIN cells USING (a, b) WHERE 200.0 * last_row[length(b) + 1] / (length(a) + length(b)) >= 80"""

    fields = "profile_name, office_name, profile_type, sales_last_12_months, price_range, total_sold, avg_price_3yr, for_sale_count"
    dirs = (_PROFILES, _SALES, _TOWNS)
    q["directory_agents"] = _with(*dirs) + f"""SELECT profile_url, {fields}, CAST(sum(local_sales_count) AS BIGINT) AS total_local_sales,
  string_agg(DISTINCT town, ',' ORDER BY town) AS towns FROM profiles JOIN profile_towns USING (profile_url)
WHERE profile_type <> 'brokerage' GROUP BY ALL ORDER BY total_local_sales DESC, profile_url LIMIT 30"""
    q["directory_agents_by_town"] = _with(*dirs) + """SELECT town, CAST(rank AS INTEGER) AS rank, profile_url, profile_name, office_name, local_sales_count
FROM (SELECT *, row_number() OVER (PARTITION BY town ORDER BY local_sales_count DESC, profile_url) AS rank
  FROM profiles JOIN profile_towns USING (profile_url) WHERE profile_type <> 'brokerage') WHERE rank <= 10"""
    q["directory_brokerages"] = _with(*dirs) + _brokerages("", "appearances") + "SELECT * FROM board ORDER BY total_sales DESC, brokerage LIMIT 20"
    q["directory_brokerages_once"] = _with(*dirs) + _brokerages("", "1") + "SELECT * FROM board"
    q["directory_brokerages_by_town"] = _with(*dirs) + _brokerages("town,", "appearances") + """SELECT * REPLACE (CAST(rank AS INTEGER) AS rank) FROM (
  SELECT *, row_number() OVER (PARTITION BY town ORDER BY total_sales DESC, brokerage) AS rank FROM board) WHERE rank <= 5"""
    q["directory_stats"] = _with(*dirs) + """SELECT CAST(count(*) AS BIGINT) AS total_profiles,
  CAST(count(*) FILTER (WHERE profile_type = 'team') AS BIGINT) AS teams, CAST(count(*) FILTER (WHERE profile_type = 'individual') AS BIGINT) AS individuals,
  CAST(count(*) FILTER (WHERE profile_type = 'brokerage') AS BIGINT) AS brokerages,
  CAST(count(*) FILTER (WHERE profile_type IN ('team', 'individual')) AS BIGINT) AS agents,
  (SELECT CAST(count(DISTINCT town) AS BIGINT) FROM profile_towns) AS towns_with_data FROM profiles"""
    q["agent_index"] = _with(LISTINGS) + """, rows_ AS (SELECT *, coalesce(sale_price, list_price, 0) AS amount FROM listings WHERE listing_agent IS NOT NULL),
cells AS (SELECT listing_agent AS name, city, count(*) AS sides, sum(amount) AS volume, max(sale_date) AS most_recent,
  arg_max(listing_office, (sale_date, listing_office)) AS office FROM rows_ WHERE city IS NOT NULL GROUP BY 1, 2),
recent AS (SELECT listing_agent AS name, count(*) AS rs, sum(amount) AS rv FROM rows_ WHERE sale_date >= DATE '2000-08-01' GROUP BY 1)
SELECT name, arg_max(office, city) AS office, CAST(sum(sides) AS BIGINT) AS total_sides, CAST(sum(volume) AS BIGINT) AS total_volume,
  max(most_recent) AS most_recent, string_agg(city || '=' || sides || '=' || volume, ';' ORDER BY city) AS towns,
  CAST(coalesce(any_value(rs), 0) AS BIGINT) AS rolling_sides, CAST(coalesce(any_value(rv), 0) AS BIGINT) AS rolling_volume,
  CAST(round_even(sum(volume) / sum(sides), 0) AS BIGINT) AS avg_price FROM cells LEFT JOIN recent USING (name) GROUP BY name"""
    q["listing_index"] = _with(*_L, _kpi_cte("agent")) + """SELECT name, coalesce(office, '') AS office, all_time_sides AS total_sides, listing_sides,
  buyer_sides, all_time_volume AS volume, most_recent, replace(coalesce(primary_towns, ''), ', ', '|') AS towns, current_12mo_volume, current_12mo_sides,
  prior_12mo_volume, prior_12mo_sides, three_yr_volume, three_yr_sides, all_time_volume, all_time_sides FROM kpi"""
    q["directory_index"] = _with(*dirs, _SOLD) + """, numbered AS (SELECT *, (row_number() OVER (PARTITION BY profile_url ORDER BY seq) - 1) // 100 AS page FROM sold),
paged AS (SELECT profile_url, page, string_agg(sold_date || '=' || closing_price || '=' || represented, ';' ORDER BY seq) AS sold_rows
  FROM numbered GROUP BY 1, 2),
local_ AS (SELECT profile_url, string_agg(town || '=' || local_sales_count, ';' ORDER BY town) AS towns,
  CAST(sum(local_sales_count) AS BIGINT) AS total_local_sales FROM profile_towns GROUP BY 1)
SELECT p.profile_url, profile_name AS name, office_name AS office, profile_type AS type, coalesce(enrichment_status = 'success', false) AS enriched,
  total_local_sales, coalesce(page, 0) AS page, towns, coalesce(sold_rows, '') AS sold_rows
FROM profiles p JOIN local_ USING (profile_url) LEFT JOIN paged USING (profile_url) WHERE profile_name IS NOT NULL"""
    q["sold_sides"] = _with(_SOLD) + """SELECT profile_url, CAST(count(*) FILTER (WHERE represented = 'Seller') AS BIGINT) AS seller_sides,
  CAST(count(*) FILTER (WHERE represented = 'Buyer') AS BIGINT) AS buyer_sides,
  CAST(count(*) FILTER (WHERE represented = 'Buyer and Seller') AS BIGINT) AS both_sides, CAST(count(*) AS BIGINT) AS shown FROM sold GROUP BY 1"""
    has = "coalesce(contains(lower(name), '0000001'), false) OR coalesce(contains(lower(office), '0000001'), false)"
    q["cross_source_search"] = f"""WITH rows_ AS (
  SELECT 0 AS o, 'sales' AS source, name AS id, name, office, total_volume AS figure FROM ({q["agent_index"]})
  UNION ALL SELECT 1, 'profiles', profile_url, name, office, total_local_sales FROM ({q["directory_index"]}) WHERE page = 0
  UNION ALL SELECT 2, 'listings', name, name, office, all_time_sides FROM ({q["listing_index"]})),
hits AS (SELECT *, (o, coalesce(name, ''), coalesce(office, ''), coalesce(id, '')) AS at_ FROM rows_ WHERE {has})
SELECT lower(coalesce(name, '')) AS key, arg_min(name, at_) AS name, arg_max(office, at_) FILTER (WHERE office <> '') AS office,
  string_agg(DISTINCT source, ',' ORDER BY source) AS sources, CAST(arg_max(figure, at_) FILTER (WHERE o = 0) AS BIGINT) AS sales_volume,
  CAST(arg_max(figure, at_) FILTER (WHERE o = 1) AS BIGINT) AS local_sales, CAST(arg_max(figure, at_) FILTER (WHERE o = 2) AS BIGINT) AS listing_sides
FROM hits GROUP BY 1"""
    q["stored_listings"] = _with(LISTINGS) + """SELECT detail_url, mls_number, city, status, sale_price, list_price, beds, baths, close_date, listing_agent,
  CAST(NULL AS TIMESTAMP) AS scraped_at FROM listings"""
    q["stored_transactions"] = _with(LISTINGS) + """SELECT mls_number, sale_date, sale_price, listing_agent, buyer_office, data_source, enrichment_attempts,
  CAST(NULL AS VARCHAR) AS raw_buyer_agent FROM listings"""
    q["stored_directory"] = _with(*dirs) + """SELECT profile_url, town, local_sales_count, profile_type, total_sold, avg_price_3yr, scrape_status
FROM profiles JOIN profile_towns USING (profile_url)"""
    q["legacy_listings"] = _with(LISTINGS) + """SELECT detail_url, CASE WHEN NOT old THEN status WHEN close_date IS NOT NULL THEN 'Closed' END AS status, close_date,
  CASE WHEN NOT old THEN list_date END AS list_date, CASE WHEN NOT old THEN year_built END AS year_built, sale_price
FROM (SELECT *, detail_url LIKE '%1' AS old FROM listings)"""
    q["stored_index"] = f"SELECT name, office, total_sides, towns, all_time_volume, most_recent FROM ({q['listing_index']})"
    q["stored_rankings"] = f"SELECT * FROM ({q['rankings']})"
    q["cross_source_scan"] = _with(LISTINGS, _PROFILES) + """, rows_ AS (
  SELECT listing_agent AS name, listing_office AS office, 'sales' AS source, 0 AS o FROM listings
  UNION ALL SELECT profile_name, office_name, 'profiles', 1 FROM profiles
  UNION ALL SELECT buyer_agent, buyer_office, 'listings', 2 FROM listings),
hits AS (SELECT * FROM rows_ WHERE coalesce(contains(lower(name), '00000001'), false) OR coalesce(contains(lower(office), '00000001'), false))
SELECT lower(coalesce(name, '')) AS key, arg_min(name, (o, name, office)) AS name,
  arg_max(office, (o, name, office)) FILTER (WHERE office <> '') AS office, string_agg(DISTINCT source, ',' ORDER BY source) AS sources
FROM hits GROUP BY 1"""
    q["distinct_towns"] = _with(*_L, _kpi_cte("agent")) + """SELECT DISTINCT trim(t) AS town FROM (SELECT unnest(string_split(primary_towns, ',')) AS t FROM kpi)
WHERE trim(t) <> ''"""
    q["sorted_board"] = _with(*_L, _kpi_cte("agent")) + """SELECT name, office, three_yr_volume, primary_towns FROM kpi
WHERE contains(lower(primary_towns), 'nation_3') ORDER BY three_yr_volume DESC NULLS LAST, name LIMIT 50"""

    def head(name: str, sql: str, order: str, column: str, limit: int) -> str:
        return f"""SELECT '{name}' AS section, 'all' AS scope, rank, {column} AS name FROM (
  SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM ({sql})) WHERE rank <= {limit}"""

    def rest(name: str, sql: str, scope: str, rank: str, column: str) -> str:
        return f"SELECT '{name}', {scope}, CAST({rank} AS BIGINT), CAST({column} AS VARCHAR) FROM ({sql})"

    by_sides = "sides DESC, volume DESC, "
    q["listing_report_rows"] = " UNION ALL ".join([
        head("combined", q["combined_board"], "total_sides DESC, volume DESC, agent_name", "agent_name", 30),
        head("listing_side", q["side_board_listing"], by_sides + "agent_name", "agent_name", 30),
        head("buyer_side", q["side_board_buyer"], by_sides + "agent_name", "agent_name", 30),
        head("brokerages", q["brokerage_board"], by_sides + "brokerage", "brokerage", 20),
        rest("towns", q["town_top5"], "town", "rank", "agent_name"),
        rest("summary", q["listing_stats"], "'all'", "NULL", "total"),
        rest("town_counts", q["town_counts_thin"], "city", "NULL", "n")])
    q["directory_report_rows"] = " UNION ALL ".join([
        head("brokerages", q["directory_brokerages"], "total_sales DESC, brokerage", "brokerage", 20),
        head("agents", q["directory_agents"], "total_local_sales DESC, profile_url", "profile_url", 30),
        rest("town_brokerages", q["directory_brokerages_by_town"], "town", "rank", "brokerage"),
        rest("town_agents", q["directory_agents_by_town"], "town", "rank", "profile_url"),
        rest("summary", q["directory_stats"], "'all'", "NULL", "total_profiles")])
    feed = "AND data_source = 'feed_a' "
    trends = lambda name, n, sql: _with(LISTINGS) + _trend(name, n, sql.format(feed), sql.format(feed + _YEAR))
    volumes = lambda sql, year="": _with(LISTINGS) + "SELECT * FROM (" + sql.format(feed + year) + ")"
    by_volume = "volume DESC, "
    town5 = _with(LISTINGS) + _scoped_ctes("listing", "city IS NOT NULL AND data_source = 'feed_a'", "town, agent_name") + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY town ORDER BY volume DESC, agent_name) AS rank FROM board) WHERE rank <= 5"""
    parts = _with(LISTINGS) + """SELECT 'source' AS kind, data_source AS value FROM listings WHERE data_source = 'feed_a' GROUP BY 2
UNION ALL SELECT 'town', city FROM listings WHERE city IS NOT NULL AND data_source = 'feed_a' GROUP BY 2"""
    q["scoped_report_rows"] = " UNION ALL ".join([
        head("agents", volumes(_AGENT_VOLUME), by_volume + "agent_name", "agent_name", 30),
        head("agents_year", volumes(_AGENT_VOLUME, _YEAR), by_volume + "agent_name", "agent_name", 30),
        rest("agent_trends", trends("agent_name", 30, _AGENT_VOLUME), "'all'", "rolling_rank", "agent_name"),
        head("brokerages", volumes(_OFFICE_VOLUME), by_volume + "office", "office", 15),
        head("brokerages_year", volumes(_OFFICE_VOLUME, _YEAR), by_volume + "office", "office", 20),
        rest("brokerage_trends", trends("office", 20, _OFFICE_VOLUME), "'all'", "rolling_rank", "office"),
        rest("towns", town5, "town", "rank", "agent_name"), rest("summary", q["scoped_stats"], "'all'", "NULL", "total"),
        rest("breakdown", parts, "kind", "NULL", "value")])
    figures = lambda sections: " UNION ALL ".join(
        f"""SELECT '{name}' AS section, CAST({scope} AS VARCHAR) AS scope, CAST({rank} AS BIGINT) AS rank, CAST({label} AS VARCHAR) AS name,
  CAST({count} AS BIGINT) AS sides, CAST({total} AS BIGINT) AS volume, CAST({listed} AS VARCHAR) AS listed FROM ({sql})"""
        for name, scope, rank, sql, label, count, total, listed in sections)
    first = lambda sql, order, n: f"SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS pos FROM ({sql})) WHERE pos <= {n}"
    none, kpi = "NULL", ("name", "current_12mo_sides", "all_time_volume", "primary_towns")
    # A mover's body has its delta, but neither all-time volume nor towns.
    full = lambda kind, gate: _movers(kind, gate).replace("SELECT side, CAST", "SELECT all_time_volume, primary_towns, side, CAST")
    q["kpi_report_figures"] = figures([
        ("agent_movers", "side", "position", full("agent", True), *kpi),
        ("agents", "'all'", "pos", first(q["agent_kpis"], _KPI_ORDER, 50), *kpi),
        ("brokerage_movers", "side", "position", full("office", True), *kpi),
        ("offices", "'all'", "pos", first(q["brokerage_kpis"], _KPI_ORDER, 50), *kpi),
        ("town_agents", "town", "rank", q["agent_kpis_by_town_top50"], *kpi),
        ("town_offices", "town", "rank", q["brokerage_kpis_by_town_top50"], *kpi),
        ("header", "'all'", none, q["listing_stats_all"], "total", "enriched", "volume", "date_max")])
    q["listing_report_figures"] = figures([
        ("combined", "'all'", "pos", first(q["combined_board"], "total_sides DESC, volume DESC, agent_name", 30), "agent_name", "total_sides", "volume", "towns"),
        ("listing_side", "'all'", "pos", first(q["side_board_listing"], by_sides + "agent_name", 30), "agent_name", "sides", "volume", "towns"),
        ("buyer_side", "'all'", "pos", first(q["side_board_buyer"], by_sides + "agent_name", 30), "agent_name", "sides", "volume", "towns"),
        ("brokerages", "'all'", "pos", first(q["brokerage_board"], by_sides + "brokerage", 20), "brokerage", "sides", "volume", "top_agents"),
        ("towns", "town", "rank", q["town_top5"], "agent_name", "total_sides", "volume", "towns"),
        ("summary", "'all'", none, q["listing_stats"], "total", "has_buyer", "volume", "date_min"),
        ("town_counts", "city", none, q["town_counts_thin"].replace("< 160", "< 50"), "n", none, none, "thin")])
    agents = lambda extra="": _with(LISTINGS) + _scoped_ctes("listing", "data_source = 'feed_a' " + extra, "agent_name") + "SELECT * FROM board"
    offices = lambda extra="": _with(LISTINGS) + f"""rows_ AS (SELECT listing_office AS office, listing_agent, city, coalesce(sale_price, list_price, 0) AS amount
  FROM listings WHERE data_source = 'feed_a' AND listing_office IS NOT NULL {extra}), w AS {_top("rows_", "office", "city", 3)}
SELECT t.*, w.v AS towns FROM (SELECT office, count(*) AS sides, sum(amount) AS volume FROM rows_ GROUP BY 1) t LEFT JOIN w USING (office)""".replace("rows_ AS (SELECT", ", rows_ AS (SELECT", 1)
    sized = """SELECT 'source' AS kind, data_source AS value, count(*) AS n FROM listings WHERE data_source = 'feed_a' GROUP BY 2
UNION ALL SELECT 'town', city, count(*) FROM listings WHERE city IS NOT NULL AND data_source = 'feed_a' GROUP BY 2"""
    q["scoped_report_figures"] = figures([
        ("agents", "'all'", "pos", first(agents(), by_volume + "agent_name", 30), "agent_name", "sides", "volume", "towns"),
        ("agents_year", "'all'", "pos", first(agents(_YEAR), by_volume + "agent_name", 30), "agent_name", "sides", "volume", "towns"),
        ("agent_trends", "'all'", "rolling_rank", trends("agent_name", 30, _AGENT_VOLUME), "agent_name", "rank_change", "rolling_volume", "label"),
        ("brokerages", "'all'", "pos", first(offices(), by_volume + "office", 15), "office", "sides", "volume", "towns"),
        ("brokerages_year", "'all'", "pos", first(offices(_YEAR), by_volume + "office", 20), "office", "sides", "volume", "towns"),
        ("brokerage_trends", "'all'", "rolling_rank", trends("office", 20, _OFFICE_VOLUME), "office", "rank_change", "rolling_volume", "label"),
        ("towns", "town", "rank", town5, "agent_name", "sides", "volume", none),
        ("summary", "'all'", none, q["scoped_stats"], "total", "unique_agents", none, "date_max"),
        ("breakdown", "kind", none, _with(LISTINGS) + sized, "value", "n", none, none)])
    q["gap_report_figures"] = figures([
        ("summary", "team_name", none, q["team_gap_summary"], "local_town", "unresolved", none, none),
        ("detail", "'all'", none, q["team_gap_detail"], "property_url", "sale_price", "sale_price", "sale_date")])
    q["profile_details"] = _with(_OBSERVATIONS) + f""", tries AS (SELECT detail_url AS profile_url, arg_max(outcome, {at}) AS enrichment_status,
  CAST(count(*) AS INTEGER) AS scrape_attempts, arg_max_null(listing_office, {at}) FILTER (WHERE outcome <> 'success') AS last_error FROM obs GROUP BY 1),
good AS (SELECT detail_url AS profile_url, {k2('page', 'total_sales')}, {k2('list_price', 'average_price')}, {k2('listing_agent', 'screen_name')},
  {newest('sale_price', 'avg_price_3yr')} FROM obs WHERE outcome = 'success' GROUP BY 1)
SELECT * FROM tries LEFT JOIN good USING (profile_url)"""
    q["member_links"] = """SELECT DISTINCT 'https://example.com/profile/' || l_suppkey AS team_profile_url,
  'https://example.com/profile/' || l_partkey AS member_profile_url, 'Part ' || l_partkey AS member_name FROM lineitem WHERE l_suppkey <> l_partkey"""

    q["search_cards_closed"] = _with(LISTINGS) + f"""SELECT {_CARD_FIELDS}, sale_price, CAST(NULL AS BIGINT) AS list_price FROM listings
WHERE address IS NOT NULL AND status = 'Closed'"""
    q["search_cards_active"] = _with(LISTINGS) + f"""SELECT {_CARD_FIELDS}, CAST(NULL AS BIGINT) AS sale_price, list_price FROM listings
WHERE address IS NOT NULL AND status <> 'Closed'"""
    q["page_counters"] = _with(LISTINGS) + """SELECT mls_number AS page_id, enrichment_attempts AS page, year_built AS pages,
  CAST(sqft AS BIGINT) AS results FROM listings"""
    q["detail_fields"] = _with(LISTINGS) + """SELECT detail_url, listing_agent, listing_agent_email, listing_office, buyer_agent,
  buyer_office || '/North' AS buyer_office, sale_price, list_price, close_date, mls_number, status,
  coalesce(days_on_market, 0) AS days_on_market, coalesce(lot_sqft, 0) + 1 AS lot_sqft, 'Say \\"' || description || '\\" twice' AS description,
  'https://example.com/' || mls_number || '.jpg' AS photo_url, CAST(NULL AS VARCHAR) AS error FROM listings"""
    q["detail_returns"] = _with(LISTINGS) + """SELECT detail_url, listing_agent, buyer_office || '/North' AS buyer_office, sale_price, close_date, status, days_on_market
FROM listings WHERE status <> 'Pending' AND NOT (status = 'Active' AND coalesce(enrichment_status, '') = 'success')"""
    letters = "translate(town, '_0123456789', ' ABCDEFGHIJ')"
    q["directory_cards"] = _with(*dirs) + f"""SELECT profile_url || '|' || town AS page_id, {letters} AS town, profile_url, local_sales_count,
  abs(sales_last_12_months) AS sales_last_12_months, profile_name, office_name, CASE WHEN profile_type = 'team' THEN 'team' WHEN office_name IS NULL THEN 'brokerage'
  ELSE 'individual' END AS profile_type FROM profiles JOIN profile_towns USING (profile_url)"""
    q["sold_row_texts"] = _with(_SALES, _KEYED) + """, made AS (SELECT profile_url, l_orderkey, flag, sale_price, address, 'York' AS city, state, zip, sale_date,
  lower(represented_side) AS represented_side, l_partkey || ' SUMMER ST UNIT ' || l_linenumber || ' | YORK | ME | ' || zip AS normalized_address
  FROM raw WHERE sale_date >= DATE '1998-01-01'),
h AS (SELECT *, sha256(normalized_address) AS normalized_address_hash FROM made),
m AS (SELECT *, sha256(normalized_address_hash || '|' || sale_date || '|' || sale_price) AS transaction_match_key FROM h)
SELECT profile_url, 'https://example.com/homedetails/' || l_orderkey AS source_url, address, city, state, zip, sale_date, sale_price, represented_side,
  normalized_address, normalized_address_hash, transaction_match_key FROM m
QUALIFY row_number() OVER (PARTITION BY profile_url, transaction_match_key, represented_side ORDER BY l_orderkey, flag, sale_price) = 1"""
    q["profile_json_rows"] = _with(_SOLD) + "SELECT profile_url, zpid, sold_date, closing_price, represented, zpid AS beds FROM sold"
    q["property_json_sales"] = _with(LISTINGS) + """SELECT 'json_' || mls_number AS mls_number, address, 'York' AS city, zip,
  CAST(coalesce(sale_price, list_price) AS VARCHAR) AS sale_price, CAST(list_price AS VARCHAR) AS list_price, CAST(beds AS VARCHAR) AS beds,
  sale_date, listing_agent, buyer_agent, listing_office FROM listings WHERE year(sale_date) = 1999"""
    q["attribution_lines"] = _with(LISTINGS) + """SELECT detail_url, listing_agent, listing_office,
  CASE WHEN data_source = 'feed_a' AND listing_agent IS NOT NULL THEN buyer_agent END AS buyer_agent,
  CASE WHEN data_source = 'feed_a' AND listing_agent IS NOT NULL THEN buyer_office END AS buyer_office FROM listings"""
    q["page_status"] = f"""SELECT page_id, {_STATUS_OF_TEXT} ELSE 'ok' END AS status,
  {_STATUS_OF_TEXT.replace("THEN 'captcha'", "THEN 'captcha_indicators'").replace("THEN 'blocked'", "THEN 'blocked_indicators'")} ELSE 'ok' END AS reason
FROM (SELECT page_id, lower(html) || ' ' || lower(url) AS t FROM pages)"""
    q["document_page_status"] = f"""SELECT doc_id,
  {_STATUS_OF_TEXT} WHEN code >= 400 THEN 'blocked' ELSE 'ok' END AS profile_status,
  {_STATUS_OF_TEXT.replace("THEN 'captcha'", "THEN 'captcha_indicators'").replace("THEN 'blocked'", "THEN 'blocked_indicators'")}
    WHEN code >= 400 THEN 'http_' || code ELSE 'ok' END AS profile_reason,
  CASE WHEN contains(t, 'verify you are a human') OR contains(t, 'please verify') OR contains(t, 'captcha') OR contains(t, 'are you a robot') THEN 'captcha'
    WHEN contains(t, 'the request could not be satisfied') OR contains(t, 'access denied') OR contains(t, 'request blocked') THEN 'error' ELSE 'ok' END AS sale_status,
  CASE WHEN contains(t, 'captcha') OR contains(t, 'perimeterx') OR contains(t, 'verify you are human') OR contains(t, 'press and hold')
    OR contains(t, 'access denied') OR contains(t, '403 forbidden') OR NOT contains(raw, '/profile/') THEN 'blocked' ELSE 'ok' END AS directory_status,
  CASE WHEN contains(t, 'unexpected occurred') OR contains(t, 'access denied') OR contains(t, 'captcha') THEN 'blocked' ELSE 'ok' END AS listing_status
FROM (SELECT doc_id, lower(raw) AS t, raw, code FROM (SELECT doc_id, text || CASE source WHEN 'src0' THEN ' Please VERIFY you are human'
  WHEN 'src1' THEN ' Access Denied' WHEN 'src2' THEN ' see /profile/x' ELSE '' END AS raw,
  CASE lang WHEN 'en' THEN 429 WHEN 'fr' THEN 500 ELSE 200 END AS code FROM documents))"""
    q["office_guesses"] = """SELECT doc_id, source || ' Realty' AS office_name, CAST(n_chars AS BIGINT) AS total_sales,
  CAST(n_chars * 7 AS BIGINT) AS average_price FROM documents"""

    price = "sale_price"
    q["currency_labels"] = _with(LISTINGS) + f"""SELECT detail_url, {_money(price)} AS short, {_money_na("(sale_price * 10000)")} AS long,
  '$' || {_grouped("coalesce(sale_price, 0)")} AS "full", {_money("(sale_price // 1000)")} AS small, coalesce(sale_price, 0) AS back FROM listings"""
    q["currency_sort"] = _with(LISTINGS) + f""", cells AS (SELECT detail_url AS name, {_money(price)} AS cell FROM listings)
SELECT name, cell, CAST(CASE WHEN cell LIKE '%M' THEN CAST(cell[2:-2] AS DOUBLE) * 1e6 WHEN cell LIKE '%K' THEN CAST(cell[2:-2] AS DOUBLE) * 1e3
  ELSE CAST(cell[2:] AS DOUBLE) END AS DOUBLE) AS value FROM cells"""
    q["derived_metrics"] = _with(*_L, _kpi_cte("agent")) + """SELECT name, CASE WHEN three_yr_sides > 0 THEN three_yr_volume / three_yr_sides ELSE 0.0 END AS avg_3yr,
  listing_sides || ' : ' || buyer_sides AS split,
  CASE WHEN prior_12mo_volume > 0 THEN CAST(trunc((current_12mo_volume - prior_12mo_volume) / prior_12mo_volume * 100) AS BIGINT) END AS pct,
  CASE WHEN current_12mo_sides <> 0 THEN all_time_sides * current_12mo_sides END AS est_volume, all_time_sides - three_yr_sides AS not_shown,
  strftime(most_recent, '%b %Y') AS month FROM kpi"""
    q["parsed_dates"] = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS named, CAST(o_orderdate AS DATE) AS iso, CAST(o_orderdate AS DATE) AS us,
  CAST(NULL AS DATE) AS bad, CAST(o_orderdate AS DATE) AS cut FROM orders"""
    q["unescaped"] = "SELECT doc_id, text FROM documents"
    return q
