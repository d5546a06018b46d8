"""Equivalent SQL per query, written independently of the Spark plans."""

from __future__ import annotations

from .queries import (
    BATCH,
    CATEGORY,
    CLICK_CATEGORY,
    CLICK_END,
    CLICK_START,
    END,
    FILE_ROWS,
    PRODUCT_ID,
    ROW_CAP,
    START,
    TRAILING_DAYS,
)


def r(expression: str, digits: int = 2) -> str:
    """Half-up rounding of a DOUBLE that is not thrown off by its binary form."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def money(expression: str, digits: int = 2) -> str:
    return f"CAST(round({expression}, {digits}) AS DOUBLE)"


def pct(num: str, den: str, default: str | None = None) -> str:
    out = r(f"100.0 * ({num}) / nullif({den}, 0)")
    return out if default is None else f"coalesce({out}, {default})"


CLICKS = """
WITH c0 AS (
  SELECT ts AS event_time, user_id, CAST(value AS DECIMAL(18,4)) AS revenue,
         CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS product_id
  FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
ev AS (
  SELECT *, CASE WHEN product_id % 7 <> 6 THEN 'cat' || CAST(product_id % 7 AS VARCHAR) || '.p' || CAST(product_id AS VARCHAR)
                 ELSE 'unknown.general' END AS category_code,
         CASE WHEN product_id % 7 <> 6 THEN 'cat' || CAST(product_id % 7 AS VARCHAR) ELSE 'unknown' END AS category,
         CAST(user_id AS VARCHAR) || '-' || strftime(event_time, '%Y%m%d') AS order_id,
         CAST(event_time AS DATE) AS day, strftime(event_time, '%Y-%m-%d') AS event_date,
         strftime(event_time, '%Y-%m') AS month, CAST(1 AS BIGINT) AS quantity,
         CAST(hour(event_time) AS INTEGER) AS hour, CAST(dayofweek(event_time) + 1 AS INTEGER) AS weekday
  FROM c0),
p AS (SELECT * FROM ev WHERE event_type = 'purchase')
"""

SALES = """
WITH s0 AS (
  SELECT o_orderdate AS event_time, o_custkey AS user_id, l_partkey AS product_id, p_brand AS brand,
         lower(p_type) || '.' || p_brand AS code, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4)) AS revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
  WHERE o_orderdate IS NOT NULL AND o_custkey IS NOT NULL),
p AS (
  SELECT *, 'purchase' AS event_type, coalesce(code, 'unknown.general') AS category_code,
         split_part(coalesce(code, 'unknown.general'), '.', 1) AS category,
         CAST(event_time AS DATE) AS day, strftime(event_time, '%Y-%m-%d') AS event_date,
         strftime(event_time, '%Y-%m') AS month,
         CAST(hour(event_time) AS INTEGER) AS hour, CAST(dayofweek(event_time) + 1 AS INTEGER) AS weekday
  FROM s0)
"""

TOTALS = "sum(revenue) AS rev, count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS buyers"
DAILY = f", d AS (SELECT event_date, day, {TOTALS} FROM p GROUP BY ALL)"
MONTHLY = f", m AS (SELECT month, {TOTALS} FROM p GROUP BY month)"
CATS = f", c AS (SELECT category, {TOTALS} FROM p GROUP BY category)"
CAT_DAYS = f", cd AS (SELECT event_date, day, category, {TOTALS} FROM p GROUP BY ALL)"
CELLS = ", h AS (SELECT weekday, hour, sum(revenue) AS rev, count(DISTINCT order_id) AS orders FROM p GROUP BY ALL)"
DAY_NAME = "['Sun','Mon','Tue','Wed','Thu','Fri','Sat'][weekday]"
USERS = """, u AS (SELECT user_id, sum(revenue) AS rev, count(DISTINCT order_id) AS orders,
  min(event_time) AS t0, max(event_time) AS t1 FROM p GROUP BY user_id)"""
LIFETIME = "CAST(greatest(0, date_diff('day', CAST(t0 AS DATE), CAST(t1 AS DATE))) + 1 AS INTEGER)"
STAMP = "'%Y-%m-%d %H:%M:%S'"
CLV = f"coalesce({r('rev / nullif(orders, 0)')}, 0)"


def _score(rank: str) -> str:
    return f"CAST(CASE WHEN n = 1 THEN 1 ELSE greatest(1, (({rank} - 1) * least(5, n) + n - 2) // (n - 1)) END AS INTEGER)"


RFM = (
    USERS
    + f""", q AS (SELECT *, CAST(date_diff('day', CAST(t1 AS DATE), (SELECT CAST(max(t1) AS DATE) FROM u)) AS INTEGER) AS recency,
  count(*) OVER () AS n FROM u),
k AS (SELECT *, row_number() OVER (ORDER BY recency DESC, user_id) AS rr, row_number() OVER (ORDER BY orders, user_id) AS fr,
  row_number() OVER (ORDER BY rev, user_id) AS mr FROM q),
sc AS (SELECT *, {_score('rr')} AS r_score, {_score('fr')} AS f_score, {_score('mr')} AS m_score FROM k),
g AS (SELECT *, r_score + f_score + m_score AS rfm_score,
  CASE WHEN r_score + f_score + m_score >= 8 THEN 'VIP' WHEN r_score + f_score + m_score BETWEEN 6 AND 7 THEN 'Loyal'
       WHEN recency >= 30 THEN 'At Risk' ELSE 'Growth Opportunity' END AS segment FROM sc)"""
)
RFM_COLUMNS = f"""user_id, orders AS frequency, {money('rev')} AS monetary, strftime(t1, {STAMP}) AS last_purchase,
  strftime(t0, {STAMP}) AS first_seen_at, {LIFETIME} AS lifetime_days, {CLV} AS clv_estimate, recency,
  r_score, f_score, m_score, CAST(rfm_score AS INTEGER) AS rfm_score, segment"""
SEGMENTS = f"""SELECT segment, count(*) AS customers, {money('sum(rev)')} AS revenue,
  {r('sum(recency) / count(*)')} AS avg_recency FROM g GROUP BY segment"""

PRODUCTS = """, pr AS (SELECT product_id, sum(revenue) AS rev, CAST(sum(quantity) AS BIGINT) AS quantity,
  max(struct_pack(t := event_time, c := category_code)) AS latest FROM p GROUP BY product_id),
ps AS (SELECT product_id, split_part(latest.c, '.', 1) AS category, latest.c AS category_code, rev, quantity,
  sum(rev) OVER (ORDER BY rev DESC, product_id ROWS UNBOUNDED PRECEDING) AS run, sum(rev) OVER () AS total FROM pr)"""
FIGURES = f"""product_id, category, category_code, {money('rev')} AS revenue, quantity,
  coalesce({r('rev / nullif(quantity, 0)')}, 0) AS avg_price"""
SHARES = f"{pct('rev', 'total')} AS revenue_share_pct, {pct('run', 'total')} AS cumulative_share_pct"
ABC = f"""CASE WHEN {pct('run', 'total')} <= 30 THEN 'Hero SKU' WHEN {pct('run', 'total')} <= 80 THEN 'Core'
  ELSE 'Long Tail' END AS abc_class"""

DAILY_REPORT = f"""SELECT event_date, {money('rev')} AS revenue, orders, buyers AS dau,
  {r('avg(rev) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS rolling_7d,
  {money('lag(rev) OVER (ORDER BY day)')} AS prev_revenue FROM d"""


def _change(name: str) -> str:
    prev = f"lag({name}) OVER (ORDER BY month)"
    return pct(f"{name} - {prev}", prev)


MONTHLY_REPORT = f"""SELECT month, {money('rev')} AS revenue, orders, buyers, coalesce({r('rev / nullif(orders, 0)')}, 0) AS avg_order_value,
  {_change('rev')} AS revenue_pct_vs_prev, {_change('orders')} AS orders_pct_vs_prev,
  {_change('buyers')} AS buyers_pct_vs_prev FROM m"""

STEPS = """, f AS (SELECT count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'cart') AS c,
  count(*) FILTER (event_type = 'purchase') AS b FROM {source})"""
FUNNEL = f"""SELECT v > 0 AND c > 0 AS available,
  CASE WHEN v > 0 AND c > 0 THEN 'Funnel computed from view, cart and purchase events.'
       ELSE 'View or cart events are missing; the funnel is not available.' END AS message,
  {{v}} AS view, {{c}} AS cart, {{b}} AS purchase, {pct('c', 'v', '0')} AS view_to_cart_pct, {pct('b', 'c', '0')} AS cart_to_purchase_pct,
  {pct('v - c', 'v', '0')} AS drop_off_view_to_cart_pct, {pct('c - b', 'c', '0')} AS drop_off_cart_to_purchase_pct FROM f"""
PLAIN_FUNNEL = FUNNEL.format(v="v", c="c", b="b")

GROWTH = """, gr AS (SELECT *, lag(rev) OVER (ORDER BY day) AS prev FROM d), gp AS (SELECT * FROM gr WHERE prev > 0)"""
GROWTH_PCT = f"""(SELECT coalesce({r('avg(x)')}, 0) FROM (SELECT 100.0 * (rev - prev) / prev AS x FROM gp ORDER BY day DESC LIMIT 7))"""

ADDITIVE = """, am AS (SELECT left(event_date, 7) AS month, sum(rev) AS rev, CAST(sum(orders) AS BIGINT) AS orders,
  CAST(sum(buyers) AS BIGINT) AS buyers, count(*) AS days FROM d GROUP BY ALL)"""


def _delta(name: str) -> str:
    return pct(f"a.{name} - b.{name}", f"b.{name}")


MONTH_DELTA = f""", rk AS (SELECT *, row_number() OVER (ORDER BY month DESC) AS n FROM am)
SELECT a.month AS current_month, b.month AS previous_month, {_delta('rev')} AS revenue_pct, {_delta('orders')} AS orders_pct,
  {_delta('buyers')} AS buyers_pct, {pct('a.rev / a.orders - b.rev / b.orders', 'b.rev / b.orders')} AS aov_pct,
  CASE WHEN {_delta('rev')} >= 0 THEN 'up' WHEN {_delta('rev')} < 0 THEN 'down' END AS revenue_direction
FROM rk a, rk b WHERE a.n = 1 AND b.n = 2"""


def _kpis(base: str, source: str) -> str:
    return (
        base
        + DAILY
        + USERS
        + STEPS.format(source=source)
        + GROWTH
        + f""", t AS (SELECT coalesce(sum(revenue), 0) AS rev, count(DISTINCT order_id) AS orders FROM p)
SELECT (SELECT CAST(v + c + b AS BIGINT) FROM f) AS total_events, {money('t.rev')} AS total_revenue, t.orders AS total_orders,
  coalesce({r('CAST(round(t.rev, 2) AS DOUBLE) / nullif(t.orders, 0)')}, 0) AS average_order_value,
  (SELECT {r('sum(buyers) / count(*)')} FROM d) AS daily_active_users_avg,
  (SELECT {r('avg(rev / nullif(orders, 0))')} FROM u) AS estimated_clv,
  (SELECT {pct('b', 'c', '0')} FROM f) AS conversion_rate_pct, (SELECT {pct('b', 'v', '0')} FROM f) AS overall_conversion_pct,
  {GROWTH_PCT} AS revenue_growth_pct FROM t"""
    )


def _between(column: str, start: str, end: str) -> str:
    return f"{column} BETWEEN DATE '{start}' AND DATE '{end}'"


SALE_RANGE = _between("day", START, END)
CLICK_RANGE = _between("day", CLICK_START, CLICK_END)


def _share(where: str, category: str) -> str:
    """One-row CTE with the category's share, from longs as DOUBLE."""
    return f""", sh AS (SELECT coalesce(
  CAST(sum(CAST(rev * 10000 AS BIGINT)) FILTER (category = '{category}') AS DOUBLE)
  / nullif(CAST(sum(CAST(rev * 10000 AS BIGINT)) AS DOUBLE), 0), 1.0) AS share FROM cd WHERE {where})"""


def _units(expression: str) -> str:
    return f"CAST(CAST({expression} * 10000 AS BIGINT) AS DOUBLE) / 10000.0"


def _view_kpis(where: str, category: str | None) -> str:
    share = _share(where, category) if category else ", sh AS (SELECT 1.0::DOUBLE AS share)"
    buyers = (
        f"(SELECT CAST(sum(buyers) AS BIGINT) FROM cd WHERE {where} AND category = '{category}')"
        if category
        else "CAST(NULL AS BIGINT)"
    )
    return (
        SALES
        + DAILY
        + CAT_DAYS
        + share
        + f""", w AS (SELECT sum(rev) AS rev, sum(orders) AS orders, sum(buyers) AS buyers, count(*) AS days FROM d WHERE {where})
SELECT true AS is_filtered, {r(_units('rev') + ' * share')} AS total_revenue,
  CAST(floor(orders * share + 0.5) AS BIGINT) AS total_orders, {r('rev / orders')} AS average_order_value,
  {r('buyers * share / days')} AS daily_active_users_avg, {buyers} AS total_buyers FROM w, sh"""
    )


PROMOTIONS = {
    "sales": f""", promo AS (SELECT * FROM (VALUES
  ('SPRING97', 20.0, DATE '1997-03-01', DATE '1997-03-31', ['economy', 'small']),
  ('SUMMER97', 35.0, DATE '1997-07-01', DATE '1997-08-15', ['large', 'medium', 'promo']),
  ('AUGUST97', 10.0, DATE '1997-08-01', DATE '1997-08-31', ['large']),
  ('YEAREND99', 15.5, DATE '1999-11-20', DATE '1999-12-31', ['standard', 'economy']),
  ('LATER', 50.0, DATE '2010-01-01', DATE '2010-01-31', ['economy'])) AS t(promotion_id, discount, d0, d1, cats))""",
    "clicks": """, promo AS (SELECT * FROM (VALUES
  ('JAN-A', 25.0, DATE '2024-01-05', DATE '2024-01-10', ['cat0', 'cat1']),
  ('JAN-B', 40.0, DATE '2024-01-08', DATE '2024-01-20', ['cat1', 'unknown'])) AS t(promotion_id, discount, d0, d1, cats))""",
}
COVERED = "EXISTS (SELECT 1 FROM promo WHERE p.day BETWEEN d0 AND d1 AND list_contains(cats, p.category))"


def _promotion_share(base: str, promo: str, grain: str) -> str:
    return (
        base
        + PROMOTIONS[promo]
        + f""", x AS (SELECT p.*, {COVERED} AS hit FROM p)
SELECT {grain}, {pct('count(DISTINCT order_id) FILTER (hit)', 'count(DISTINCT order_id)', '0')} AS promotion_orders_pct,
  {pct('coalesce(sum(revenue) FILTER (hit), 0)', 'sum(revenue)', '0')} AS promotion_contribution_pct FROM x GROUP BY {grain}"""
    )


PROMOTION_PERFORMANCE = (
    SALES
    + PROMOTIONS["sales"]
    + f""", x AS (SELECT promotion_id, order_id, user_id, revenue, day >= d0 AS inside FROM p JOIN promo
  ON list_contains(cats, category) AND day BETWEEN d0 - CAST(date_diff('day', d0, d1) + 1 AS INTEGER) AND d1),
a AS (SELECT promotion_id, count(DISTINCT order_id) FILTER (inside) AS n1, count(DISTINCT order_id) FILTER (NOT inside) AS n0,
  coalesce(sum(revenue) FILTER (inside), 0) AS rev FROM x GROUP BY 1),
y AS (SELECT promotion_id, user_id, count(DISTINCT order_id) AS n FROM x WHERE inside GROUP BY ALL),
b AS (SELECT promotion_id, count(*) AS people, count(*) FILTER (n >= 2) AS again FROM y GROUP BY 1)
SELECT promotion_id, coalesce(n1, 0) AS orders_generated, coalesce({money('rev')}, 0) AS revenue_generated,
  coalesce(people, 0) AS total_participants, {pct('again', 'people', '0')} AS repeat_purchase_rate_pct,
  {pct('n1 - n0', 'n0')} AS order_lift_pct
FROM (SELECT promotion_id FROM promo) LEFT JOIN a USING (promotion_id) LEFT JOIN b USING (promotion_id)"""
)

EVENT_COLUMNS = f"""strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time, event_type, product_id, user_id, category_code, category,
  {{brand}} AS brand, quantity, CAST(revenue AS DOUBLE) AS revenue, order_id, event_date, month, hour, weekday"""

PEAK = "(SELECT * FROM h ORDER BY orders DESC, rev DESC, weekday, hour LIMIT 1)"
UNION_SOURCES = (
    SALES.rstrip()
    + ", "
    + CLICKS.strip()
    .removeprefix("WITH ")
    .replace("p AS (SELECT * FROM ev WHERE event_type = 'purchase')", "cp AS (SELECT * FROM ev WHERE event_type = 'purchase')")
    + f""", both_sources AS (SELECT month, revenue, order_id, user_id FROM p UNION ALL SELECT month, revenue, order_id, user_id FROM cp),
m AS (SELECT month, {TOTALS} FROM both_sources GROUP BY month)"""
)
PARETO = """(SELECT count(*) FILTER ((run - rev) * 100 < total * 80) AS k, count(*) AS n FROM ps)"""


def _metric(metric: str, value: str, source: str, dimension: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"SELECT '{metric}' AS metric, {dimension} AS dimension, CAST({value} AS DOUBLE) AS value FROM {source}"


def _snapshot() -> str:
    kpis = f"({_kpis_body()})"
    top_c = "(SELECT * FROM c ORDER BY round(rev, 2) DESC, category LIMIT 5)"
    top_p = "(SELECT * FROM ps ORDER BY rev DESC, product_id LIMIT 5)"
    seg = f"({SEGMENTS})"
    fun = f"({PLAIN_FUNNEL})"
    rows = [
        *[
            _metric(k, k, kpis)
            for k in ("total_revenue", "total_orders", "average_order_value", "daily_active_users_avg", "conversion_rate_pct")
        ],
        _metric("returning_customers_pct", "CASE WHEN count(*) > 0 THEN 100 ELSE 0 END", "g"),
        _metric("churn_list", "least(count(*) FILTER (recency >= 21), 25)", "g"),
        _metric("churn_candidates", "count(*) FILTER (recency >= 21)", "g"),
        _metric("category_revenue", money("rev"), top_c, "category"),
        _metric("category_orders", "orders", top_c, "category"),
        _metric("product_revenue", money("rev"), top_p, "CAST(product_id AS VARCHAR)"),
        *[_metric(k, k, fun) for k in ("view", "cart", "purchase", "view_to_cart_pct", "cart_to_purchase_pct")],
        _metric("segment_customers", "customers", seg, "segment"),
        _metric("segment_revenue", "revenue", seg, "segment"),
        _metric("peak_weekday", "weekday", PEAK),
        _metric("peak_hour", "hour", PEAK),
        _metric("peak_orders", "orders", PEAK),
        _metric("peak_revenue", money("rev"), PEAK),
    ]
    return CLICKS + DAILY + CATS + CELLS + RFM + PRODUCTS + STEPS.format(source="ev") + " " + " UNION ALL ".join(rows)


NEW_VS_RETURNING = (
    CLICKS
    + """, fd AS (SELECT user_id, min(day) AS first_day FROM ev GROUP BY 1)
SELECT event_date, count(DISTINCT ev.user_id) AS active_users, count(DISTINCT ev.user_id) FILTER (day = first_day) AS new,
  count(DISTINCT ev.user_id) FILTER (day > first_day) AS returning FROM ev JOIN fd ON ev.user_id = fd.user_id"""
)


def _filtered_snapshot() -> str:
    """The snapshot of a click range and category: additive figures scaled by the category's share."""
    where = CLICK_RANGE
    fun = "(" + FUNNEL.format(**{s: f"CAST(floor({s} * (SELECT share FROM sh) + 0.5) AS BIGINT)" for s in "vcb"}) + ")"
    top_c = f"(SELECT category, {money('sum(rev)')} AS revenue, sum(orders) AS orders FROM cd WHERE {where} AND category <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)"
    top_p = f"(SELECT * FROM ps WHERE category = '{CLICK_CATEGORY}' ORDER BY rev DESC, product_id LIMIT 5)"
    peak = "(SELECT * FROM hs ORDER BY orders DESC, rev DESC, weekday, hour LIMIT 1)"
    seg = f"({SEGMENTS})"
    delta = "(" + MONTH_DELTA.split("\n", 1)[1] + ")"
    rows = [
        _metric("total_revenue", r(_units("rev") + " * share"), "w, sh"),
        _metric("total_orders", "floor(orders * share + 0.5)", "w, sh"),
        _metric("average_order_value", r("rev / orders"), "w"),
        _metric("daily_active_users_avg", r("buyers * share / days"), "w, sh"),
        _metric("conversion_rate_pct", pct("b", "c", "0"), "f"),
        _metric("returning_customers_pct", "CASE WHEN count(*) > 0 THEN 100 ELSE 0 END", "g"),
        _metric("churn_list", "least(count(*) FILTER (recency >= 21), 25)", "g"),
        _metric("churn_candidates", "count(*) FILTER (recency >= 21)", "g"),
        _metric("month_revenue_pct", "revenue_pct", delta, "current_month"),
        _metric("month_orders_pct", "orders_pct", delta, "current_month"),
        _metric("month_buyers_pct", "buyers_pct", delta, "current_month"),
        _metric("category_revenue", "revenue", top_c, "category"),
        _metric("category_orders", "orders", top_c, "category"),
        _metric("product_revenue", money("rev"), top_p, "CAST(product_id AS VARCHAR)"),
        *[_metric(k, k, fun) for k in ("view", "cart", "purchase", "view_to_cart_pct", "cart_to_purchase_pct")],
        _metric("segment_customers", "customers", seg, "segment"),
        _metric("segment_revenue", "revenue", seg, "segment"),
        _metric("peak_weekday", "weekday", peak),
        _metric("peak_hour", "hour", peak),
        _metric("peak_orders", "orders", peak),
        _metric("peak_revenue", money("rev"), peak),
    ]
    return (
        CLICKS
        + DAILY
        + CAT_DAYS
        + RFM
        + PRODUCTS
        + STEPS.format(source="ev")
        + _share(where, CLICK_CATEGORY)
        + ADDITIVE.replace("FROM d ", f"FROM d WHERE {where} ")
        + MONTH_DELTA.split("\n", 1)[0]
        + f""", w AS (SELECT sum(rev) AS rev, sum(orders) AS orders, sum(buyers) AS buyers, count(*) AS days FROM d WHERE {where}),
hd AS (SELECT day, weekday, hour, sum(revenue) AS rev, count(DISTINCT order_id) AS orders FROM p WHERE {where} GROUP BY ALL),
hs AS (SELECT weekday, hour, sum(rev) AS rev, sum(orders) AS orders FROM hd GROUP BY ALL) """
        + " UNION ALL ".join(rows)
    )


def _kpis_body() -> str:
    return f"""SELECT {money('t.rev')} AS total_revenue, t.orders AS total_orders,
  {r('CAST(round(t.rev, 2) AS DOUBLE) / t.orders')} AS average_order_value,
  (SELECT {r('sum(buyers) / count(*)')} FROM d) AS daily_active_users_avg,
  (SELECT {pct('b', 'c', '0')} FROM f) AS conversion_rate_pct
  FROM (SELECT sum(revenue) AS rev, count(DISTINCT order_id) AS orders FROM p) t"""


def _insights() -> str:
    share = "CAST(CAST(round(CAST(100.0 * k / n AS DECIMAL(38,8)), 1) AS DECIMAL(10,1)) AS VARCHAR)"
    drop = f"CAST(CAST({pct('c - b', 'c')} AS DECIMAL(10,2)) AS VARCHAR)"
    name = lambda x: f"upper(left({x}, 1)) || substr({x}, 2)"
    return (
        CLICKS
        + CATS
        + CELLS
        + PRODUCTS
        + STEPS.format(source="ev")
        + f""", best AS (SELECT category FROM c ORDER BY rev DESC, category DESC LIMIT 1), worst AS (SELECT category FROM c ORDER BY rev, category LIMIT 1)
SELECT 1 AS position, 'Revenue concentration' AS title, {share} || '% of products bring in 80% of revenue.' AS detail,
  'Keep these products in stock first.' AS action FROM {PARETO}
UNION ALL SELECT 2, 'Busiest hour', 'Most orders arrive on ' || {DAY_NAME} || ' at ' || lpad(CAST(hour AS VARCHAR), 2, '0') || ':00.',
  'Time campaigns to this hour.' FROM {PEAK}
UNION ALL SELECT 3, 'Lost carts', {drop} || '% of carts do not end in a purchase.', 'Review the checkout steps.' FROM f WHERE c > b
UNION ALL SELECT 4, 'Category gap', {name('best.category')} || ' earns most and ' || {name('worst.category')} || ' least.',
  'Check range and placement of the weakest category.' FROM best, worst WHERE best.category <> worst.category"""
    )


def _merged_cubes() -> str:
    """The cubes of the whole log, one under another."""

    def part(name: str, first: str, second: str, orders: str, buyers: str, source: str, group: str, revenue: str = money("sum(revenue)")) -> str:
        null = lambda x: f"CAST({x} AS VARCHAR)"
        return f"""SELECT '{name}' AS cube, {null(first)} AS first_key, {null(second)} AS second_key, {revenue} AS revenue,
  CAST({orders} AS BIGINT) AS orders, CAST({buyers} AS BIGINT) AS buyers FROM {source} {group}"""

    o, b, none = "count(DISTINCT order_id)", "count(DISTINCT user_id)", "CAST(NULL AS DOUBLE)"
    firsts = "(SELECT event_date, user_id, min(event_date) OVER (PARTITION BY user_id) AS born FROM ev)"
    parts = [
        part("daily", "event_date", "NULL", o, b, "p", "GROUP BY event_date"),
        part("monthly", "CAST(date_trunc('month', day) AS DATE)", "NULL", o, b, "p", "GROUP BY date_trunc('month', day)"),
        part("categories", "category", "NULL", o, b, "p", "GROUP BY category"),
        part("category_daily", "event_date", "category", o, b, "p", "GROUP BY event_date, category"),
        part("heatmap", "weekday", "hour", o, "NULL", "p", "GROUP BY weekday, hour"),
        part("heatmap_daily", "event_date", "hour", o, "NULL", "p", "GROUP BY event_date, hour"),
        part("users", "user_id", f"strftime(max(event_time), {STAMP})", o, "NULL", "p", "GROUP BY user_id"),
        part("products", "product_id", "max(struct_pack(t := date_trunc('second', event_time), c := category_code)).c", "sum(quantity)", "NULL", "p", "GROUP BY product_id"),
        part("event_counts", "event_type", "NULL", "count(*)", "NULL", "ev", "GROUP BY event_type", none),
        part("user_days", "event_date", "NULL", b, "count(DISTINCT user_id) FILTER (WHERE event_date = born)", firsts, "GROUP BY event_date", none),
        part("totals", "NULL", "NULL", o, "NULL", "p", ""),
        part("capabilities", "NULL", "NULL", o, "NULL", "ev", "", none),
    ]
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    heat = f"SELECT weekday, {DAY_NAME} AS day_name, hour, {money('rev')} AS revenue, orders"
    view_cats = f"""SELECT category, {money('sum(rev)')} AS revenue, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(buyers) AS BIGINT) AS buyers
  FROM cd WHERE {SALE_RANGE} GROUP BY category"""
    cat_report = f"SELECT category, {money('rev')} AS revenue, orders, buyers FROM c"
    click_csv = CLICKS.replace("SELECT ts AS event_time", "SELECT date_trunc('second', ts) AS event_time")
    return {
        "daily_revenue": SALES + DAILY + DAILY_REPORT,
        "daily_revenue_clicks": CLICKS + DAILY + DAILY_REPORT,
        "daily_chart": SALES
        + DAILY
        + f""" SELECT event_date, {money('rev')} AS revenue,
  CAST({r('avg(rev) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 0)} AS BIGINT) AS ma7,
  {r('rev / greatest(1, (SELECT max(rev) FROM d))', 4)} AS bar_ratio FROM d""",
        "day_growth": SALES
        + DAILY
        + GROWTH
        + f" SELECT event_date, {money('rev')} AS revenue, {money('prev')} AS prev_revenue, {pct('rev - prev', 'prev')} AS growth_pct FROM gp",
        "revenue_growth": SALES + DAILY + GROWTH + f" SELECT {GROWTH_PCT} AS revenue_growth_pct",
        "monthly_summary": SALES + MONTHLY + MONTHLY_REPORT,
        "monthly_summary_clicks": CLICKS + MONTHLY + MONTHLY_REPORT,
        "month_totals_additive": SALES + DAILY + ADDITIVE + f" SELECT month, {money('rev')} AS revenue, orders, buyers, days FROM am",
        "month_delta_last_two": SALES + DAILY + ADDITIVE + MONTH_DELTA,
        "month_delta_one_month": CLICKS + DAILY + ADDITIVE + MONTH_DELTA,
        "seasonality": SALES
        + DAILY
        + f" SELECT dayname(day) AS day_of_week, {r('avg(rev)')} AS avg_revenue, {r('avg(orders)')} AS avg_orders FROM d GROUP BY 1",
        "date_range": SALES + DAILY + ' SELECT min(event_date) AS start, max(event_date) AS "end" FROM d',
        "clean_events": CLICKS + f" SELECT {EVENT_COLUMNS.format(brand=chr(39) + 'unknown' + chr(39))} FROM ev",
        "clean_sales": SALES + f" SELECT {EVENT_COLUMNS.format(brand='coalesce(brand, ' + chr(39) + 'unknown' + chr(39) + ')')} FROM p",
        "event_counts": CLICKS + ' SELECT event_type, count(*) AS "count" FROM ev GROUP BY 1',
        "funnel": CLICKS + STEPS.format(source="ev") + " " + PLAIN_FUNNEL,
        "funnel_orders_only": SALES + STEPS.format(source="p") + " " + PLAIN_FUNNEL,
        "funnel_steps": CLICKS
        + STEPS.format(source="ev")
        + f""" SELECT 1 AS step_no, 'view' AS step, v AS value, 100 AS width_pct, CAST(NULL AS DOUBLE) AS drop_off_pct FROM f
UNION ALL SELECT 2, 'cart', c, CAST({r('100.0 * c / v', 0)} AS INTEGER), {pct('v - c', 'v', '0')} FROM f
UNION ALL SELECT 3, 'purchase', b, greatest(1, CAST({r('100.0 * b / v', 0)} AS INTEGER)), {pct('c - b', 'c', '0')} FROM f""",
        "capabilities": CLICKS
        + """ SELECT count(DISTINCT order_id) AS total_sessions,
  bool_or(event_type = 'view') AND bool_or(event_type = 'cart') AS funnel_available, bool_or(event_type = 'view') AS traffic_events_available,
  bool_or(event_type = 'purchase') AS orders_available, false AS promotions_available FROM ev""",
        "kpi_totals": _kpis(CLICKS, "ev"),
        "kpi_totals_sales": _kpis(SALES, "p"),
        "category_summary": SALES + CATS + cat_report,
        "category_summary_clicks": CLICKS + CATS + cat_report,
        "category_daily": SALES + CAT_DAYS + f" SELECT event_date, category, {money('rev')} AS revenue, orders, buyers FROM cd",
        "category_share": SALES
        + CATS
        + f""" SELECT category, upper(left(category, 1)) || substr(category, 2) AS label, {money('rev')} AS revenue, orders, buyers,
  {pct('rev', '(SELECT sum(rev) FROM c)')} AS revenue_share_pct, {r('rev / orders')} AS avg_order_value FROM c""",
        "category_growth": SALES
        + f""", cm AS (SELECT category, month, sum(revenue) AS rev FROM p GROUP BY ALL),
cl AS (SELECT *, lag(rev) OVER w AS prev, row_number() OVER (PARTITION BY category ORDER BY month DESC) AS n
  FROM cm WINDOW w AS (PARTITION BY category ORDER BY month))
SELECT category, month, {money('rev')} AS revenue, {pct('rev - prev', 'prev')} AS growth_pct FROM cl WHERE n = 1""",
        "category_filter_list": SALES
        + CATS
        + " SELECT category, CAST(row_number() OVER (ORDER BY rev DESC, category) AS INTEGER) AS position FROM c ORDER BY 2 LIMIT 50",
        "category_pareto": SALES
        + CATS
        + f""", cr AS (SELECT *, {r('100.0 * sum(rev) OVER (ORDER BY rev DESC, category ROWS UNBOUNDED PRECEDING) / sum(rev) OVER ()', 1)} AS cum FROM c)
SELECT category, upper(left(category, 1)) || substr(category, 2) AS product_name, {money('rev')} AS revenue, orders AS quantity,
  cum AS cumulative_share_pct, CASE WHEN cum <= 30 THEN 'Hero SKU' WHEN cum <= 80 THEN 'Core' ELSE 'Long Tail' END AS abc_class FROM cr""",
        "heatmap": CLICKS + CELLS + f" {heat} FROM h",
        "heatmap_daily": CLICKS
        + f" SELECT event_date, weekday, hour, {money('sum(revenue)')} AS revenue, count(DISTINCT order_id) AS orders FROM p GROUP BY ALL",
        "heatmap_intensity": CLICKS
        + CELLS
        + f" {heat}, {r('orders / greatest(1, (SELECT max(orders) FROM h))', 4)} AS intensity FROM h",
        "peak_window": CLICKS + CELLS + f" {heat} FROM {PEAK}",
        "hourly_pattern": CLICKS
        + f" SELECT hour, {money('sum(revenue)')} AS revenue, count(DISTINCT order_id) AS orders FROM p GROUP BY hour",
        "user_summary": SALES
        + USERS
        + f""" SELECT user_id, {money('rev')} AS customer_revenue, orders AS purchase_count, strftime(t0, {STAMP}) AS first_seen_at,
  strftime(t1, {STAMP}) AS last_seen_at, {LIFETIME} AS lifetime_days, {CLV} AS clv_estimate FROM u""",
        "top_customers": SALES
        + USERS
        + f""" SELECT user_id, {money('rev')} AS customer_revenue, orders AS purchase_count, strftime(t0, {STAMP}) AS first_seen_at,
  strftime(t1, {STAMP}) AS last_seen_at, {LIFETIME} AS lifetime_days, {CLV} AS clv_estimate FROM u ORDER BY rev DESC, user_id LIMIT 50""",
        "rfm_scores": SALES + RFM + f" SELECT {RFM_COLUMNS} FROM g",
        "rfm_scores_clicks": CLICKS + RFM + f" SELECT {RFM_COLUMNS} FROM g",
        "rfm_top": SALES + RFM + f" SELECT {RFM_COLUMNS} FROM (SELECT * FROM g ORDER BY rfm_score DESC, user_id LIMIT 100)",
        "segment_summary": SALES + RFM + " " + SEGMENTS,
        "segment_bars": SALES
        + RFM
        + f""", sg AS (SELECT segment, count(*) AS customers FROM g GROUP BY 1)
SELECT segment, customers, CAST({r('100.0 * customers / (SELECT max(customers) FROM sg)', 0)} AS INTEGER) AS width_pct FROM sg""",
        "churn_risk": SALES
        + RFM
        + f""" SELECT {RFM_COLUMNS}, CASE WHEN recency >= 30 THEN 'high' ELSE 'medium' END AS severity
FROM (SELECT * FROM g WHERE recency >= 21 ORDER BY recency DESC, rev DESC, user_id LIMIT 25)""",
        "customer_cards": SALES
        + RFM
        + f""" SELECT count(*) FILTER (segment IN ('VIP', 'Loyal')) AS vip_loyal, count(*) FILTER (segment = 'At Risk') AS at_risk,
  count(*) AS customers, {pct("count(*) FILTER (segment IN ('VIP', 'Loyal'))", 'count(*)', '0')} AS vip_loyal_pct,
  CAST(100 AS DOUBLE) AS returning_pct, least(count(*) FILTER (recency >= 21), 25) AS churn_list, count(*) FILTER (recency >= 21) AS churn_candidates,
  {pct("count(*) FILTER (segment = 'At Risk')", 'count(*)', '0')} AS churn_pct,
  (SELECT segment FROM g GROUP BY segment ORDER BY sum(rev) DESC LIMIT 1) AS top_segment, CAST(count(*) AS DOUBLE) AS unique_customers FROM g""",
        "customer_mix": SALES
        + USERS
        + f""" SELECT {pct('count(*) FILTER (orders < 2)', 'count(*)', '0')} AS new_customers_pct,
  {pct('count(*) FILTER (orders >= 2)', 'count(*)', '0')} AS returning_customers_pct FROM u""",
        "new_vs_returning": NEW_VS_RETURNING + " GROUP BY event_date",
        "active_users": CLICKS + " SELECT event_date, count(DISTINCT user_id) AS active_users FROM ev GROUP BY 1",
        "top_products_revenue": SALES + PRODUCTS + f" SELECT {FIGURES}, {SHARES} FROM (SELECT * FROM ps ORDER BY rev DESC, product_id LIMIT 10)",
        "top_products_quantity": SALES + PRODUCTS + f" SELECT {FIGURES} FROM (SELECT * FROM ps ORDER BY quantity DESC, product_id LIMIT 10)",
        "product_abc": SALES + PRODUCTS + f" SELECT {FIGURES}, {SHARES}, {ABC} FROM ps",
        "pareto_summary": SALES
        + PRODUCTS
        + f""" SELECT k AS top_products_for_80pct, n AS product_count, CAST(ceil(n / 5.0) AS BIGINT) AS top_20pct_product_count FROM {PARETO}""",
        "product_filter_list": SALES
        + PRODUCTS
        + """ SELECT product_id, coalesce(nullif(p_name, ''), 'SKU ' || CAST(product_id AS VARCHAR)) AS product_name, category
FROM (SELECT * FROM ps ORDER BY rev DESC, product_id LIMIT 50) LEFT JOIN part ON product_id = p_partkey""",
        "product_bars": SALES
        + PRODUCTS
        + f""" SELECT CASE WHEN product_id <> 0 THEN 'SKU ' || CAST(product_id AS VARCHAR) ELSE 'Unknown product' END AS label, {money('rev')} AS revenue,
  CAST({r('100.0 * rev / greatest(1, (SELECT max(rev) FROM ps))', 0)} AS INTEGER) AS width_pct
FROM (SELECT * FROM ps ORDER BY rev DESC, product_id LIMIT 7)""",
        "view_kpis": _view_kpis(SALE_RANGE, CATEGORY),
        "view_kpis_swapped_bounds": _view_kpis(SALE_RANGE, None),
        "view_kpis_unfiltered": SALES
        + DAILY
        + f""" SELECT false AS is_filtered, {money('sum(revenue)')} AS total_revenue, count(DISTINCT order_id) AS total_orders,
  {r('CAST(round(sum(revenue), 2) AS DOUBLE) / count(DISTINCT order_id)')} AS average_order_value,
  (SELECT {r('sum(buyers) / count(*)')} FROM d) AS daily_active_users_avg, CAST(NULL AS BIGINT) AS total_buyers FROM p""",
        "view_categories": SALES + CAT_DAYS + " " + view_cats,
        "view_categories_staged": SALES + CAT_DAYS + " " + view_cats,
        "view_donut": SALES
        + CAT_DAYS
        + f", vc AS ({view_cats}) SELECT category, revenue, {pct('revenue', '(SELECT sum(CAST(revenue AS DECIMAL(18,2))) FROM vc)')} AS share_pct FROM vc",
        "view_heatmap": CLICKS
        + f""", hd AS (SELECT day, weekday, hour, sum(revenue) AS rev, count(DISTINCT order_id) AS orders FROM p WHERE {CLICK_RANGE} GROUP BY ALL)
SELECT weekday, hour, {money('sum(rev)')} AS revenue, CAST(sum(orders) AS BIGINT) AS orders FROM hd GROUP BY ALL""",
        "view_heatmap_allocated": CLICKS
        + CAT_DAYS
        + _share(CLICK_RANGE, CLICK_CATEGORY)
        + f""", hd AS (SELECT day, weekday, hour, sum(revenue) AS rev, count(DISTINCT order_id) AS orders FROM p WHERE {CLICK_RANGE} GROUP BY ALL),
hs AS (SELECT weekday, hour, sum(rev) AS rev, sum(orders) AS orders FROM hd GROUP BY ALL)
SELECT weekday, hour, {r(_units('rev') + ' * share')} AS revenue, {r('orders * share')} AS orders FROM hs, sh""",
        "view_allocation": SALES
        + DAILY
        + CAT_DAYS
        + _share(SALE_RANGE, CATEGORY)
        + f""" SELECT event_date, {r(_units('rev') + ' * share')} AS revenue, {r('orders * share')} AS orders, {r('buyers * share')} AS dau
FROM d, sh WHERE {SALE_RANGE}""",
        "view_funnel": CLICKS
        + STEPS.format(source="ev")
        + CAT_DAYS
        + _share(CLICK_RANGE, CLICK_CATEGORY)
        + " "
        + FUNNEL.format(
            **{s: f"CAST(floor({s} * (SELECT share FROM sh) + 0.5) AS BIGINT)" for s in "vcb"}
        ),
        "view_last_n_days": SALES
        + DAILY.replace(", d AS", ", d0 AS")
        + f", d AS (SELECT * FROM d0 WHERE day >= greatest((SELECT min(day) FROM d0), (SELECT max(day) FROM d0) - {TRAILING_DAYS - 1})) "
        + DAILY_REPORT,
        "view_month_delta": SALES + DAILY + ADDITIVE.replace("FROM d ", f"FROM d WHERE {SALE_RANGE} ") + MONTH_DELTA,
        "view_exact_range": SALES
        + f""" SELECT {money('sum(revenue)')} AS revenue, count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS buyers,
  {r('sum(revenue) / count(DISTINCT order_id)')} AS avg_order_value FROM p WHERE {SALE_RANGE} AND category = '{CATEGORY}'""",
        "view_exact_bitmap": SALES
        + f""" SELECT {money('sum(revenue)')} AS revenue, count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS buyers,
  {r('sum(revenue) / count(DISTINCT order_id)')} AS avg_order_value FROM p WHERE {SALE_RANGE} AND category = '{CATEGORY}'""",
        "daily_signals": CLICKS
        + DAILY
        + CELLS
        + f""" SELECT {r('avg(buyers)')} AS avg_buyers, {r('avg(orders)')} AS avg_orders, {r('avg(rev)')} AS avg_revenue,
  (SELECT hour FROM {PEAK}) AS peak_hour, (SELECT orders FROM {PEAK}) AS peak_orders FROM d""",
        "promotion_performance": PROMOTION_PERFORMANCE,
        "promotion_share_by_month": _promotion_share(SALES, "sales", "month"),
        "promotion_share_by_weekday": _promotion_share(SALES, "sales", "weekday"),
        "promotion_share_by_category": _promotion_share(SALES, "sales", "category"),
        "promotion_share_by_hour": _promotion_share(CLICKS, "clicks", "hour"),
        "promotion_discount": SALES
        + PROMOTIONS["sales"]
        + f" SELECT {r('avg(discount)')} AS avg_promotion_discount_pct FROM p JOIN promo ON day BETWEEN d0 AND d1 AND list_contains(cats, category)",
        "source_rows": 'SELECT count(*) AS "rows" FROM events',
        "row_cap": CLICKS
        + f""" SELECT {EVENT_COLUMNS.format(brand=chr(39) + 'unknown' + chr(39))} FROM (SELECT * FROM ev
ORDER BY event_time, user_id, product_id, event_type, revenue LIMIT {ROW_CAP})""",
        "union_monthly": UNION_SOURCES + " " + MONTHLY_REPORT,
        "csv_daily": click_csv + DAILY + DAILY_REPORT,
        "conversion_report": f"""SELECT count(*) AS csv_rows, count(*) AS parquet_rows, CAST({BATCH} AS BIGINT) AS batch_size,
  CAST(ceil(count(*) / {BATCH}.0) AS BIGINT) AS num_batches, true AS enough_files, true AS files_within_batch FROM events""",
        "export_daily_csv": SALES + DAILY + f' SELECT event_date AS "Date", {money("rev")} AS "Revenue", orders AS "Orders", buyers AS "Buyers" FROM d',
        "incremental_refresh": CLICKS + ' SELECT event_type, count(*) AS "count" FROM ev GROUP BY 1',
        "section_revenue": SALES + DAILY + f" SELECT * FROM ({DAILY_REPORT}) WHERE event_date BETWEEN '{START}' AND '{END}'",
        "section_products": SALES
        + PRODUCTS
        + f" SELECT {FIGURES}, {SHARES} FROM ps WHERE category = '{CATEGORY}' AND (run - rev) * 100 < total * 80",
        "section_products_top": SALES
        + PRODUCTS
        + f""", ch AS (SELECT * REPLACE (sum(rev) OVER (ORDER BY rev DESC, product_id) AS run) FROM ps WHERE category = '{CATEGORY}')
SELECT {FIGURES}, {SHARES} FROM (SELECT * FROM ch ORDER BY rev DESC, product_id LIMIT 10)""",
        "section_product_id": SALES + PRODUCTS + f" SELECT {FIGURES} FROM ps WHERE product_id = {PRODUCT_ID}",
        "section_customers": NEW_VS_RETURNING + f" WHERE {CLICK_RANGE} GROUP BY event_date",
        "view_new_vs_returning": NEW_VS_RETURNING + f" WHERE {CLICK_RANGE} GROUP BY event_date",
        "view_snapshot_filtered": _filtered_snapshot(),
        "view_buyers_approx": SALES
        + f""" SELECT count(DISTINCT user_id) AS buyers, count(DISTINCT order_id) AS orders, true AS buyers_near, true AS orders_near
FROM p WHERE {SALE_RANGE}""",
        "row_cap_files": CLICKS
        + f""", n AS (SELECT event_type, row_number() OVER (PARTITION BY event_type) AS k FROM ev)
SELECT event_type, count(*) AS "count" FROM n WHERE k <= {FILE_ROWS} GROUP BY 1""",
        "csv_quarantine": """
WITH e AS (SELECT user_id AS u, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS n FROM events),
x AS (SELECT CASE WHEN n % 17 = 3 THEN 'bad time' WHEN n % 17 = 5 OR n IS NULL THEN 'no time' WHEN u % 13 = 5 THEN 'bad user'
  WHEN u % 13 = 7 OR u IS NULL THEN 'no user' ELSE 'kept' END AS outcome, n FROM e)
SELECT outcome, count(*) AS "rows" FROM x GROUP BY 1 UNION ALL SELECT 'repaired', count(*) FROM x WHERE outcome = 'kept' AND n % 10 = 1""",
        "refresh_incremental": CLICKS + _merged_cubes(),
        "empty_table": SALES + DAILY + " SELECT count(*) AS present_rows, CAST(0 AS BIGINT) AS missing_rows FROM d",
        "document_missing": CLICKS
        + """ SELECT section, (SELECT count(*) FROM ev WHERE event_type IN ('view', 'cart', 'purchase')) AS total_events
FROM (VALUES ('filters'), ('dashboard'), ('revenue'), ('categories'), ('time_behavior'), ('customers')) AS t(section)""",
        "document_categories_daily": CLICKS + CAT_DAYS + f" SELECT event_date, category, {money('rev')} AS revenue, orders, buyers FROM cd",
        "document_heatmap_daily": CLICKS
        + f""" SELECT event_date, weekday, hour, {money('sum(revenue)')} AS revenue, count(DISTINCT order_id) AS orders FROM p GROUP BY ALL""",
        "document_republished": CLICKS
        + f""" SELECT 'tallycart' AS engine, '3' AS generated_at,
  (SELECT count(*) FROM ev WHERE event_type IN ('view', 'cart', 'purchase')) AS total_events, {money('sum(revenue)')} AS total_revenue,
  count(DISTINCT order_id) AS total_orders, min(event_date) AS start, max(event_date) AS "end" FROM p""",
        "document_promotions": CLICKS
        + PROMOTIONS["clicks"]
        + f""", x AS (SELECT promotion_id, discount, order_id, user_id, revenue FROM p JOIN promo ON list_contains(cats, category) AND day BETWEEN d0 AND d1),
a AS (SELECT promotion_id, count(DISTINCT order_id) AS n, sum(revenue) AS rev, count(DISTINCT user_id) AS people FROM x GROUP BY 1)
SELECT true AS promotions_available, (SELECT {r('avg(discount)')} FROM x) AS avg_discount_pct, promotion_id, coalesce(n, 0) AS orders_generated,
  coalesce({money('rev')}, 0) AS revenue_generated, coalesce(people, 0) AS total_participants FROM promo LEFT JOIN a USING (promotion_id)""",
        "document_sections": """SELECT section, (SELECT count(*) FROM events) > 0 AS present FROM (VALUES ('meta'), ('filters'), ('dashboard'),
  ('revenue'), ('funnel'), ('categories'), ('time_behavior'), ('customers'), ('segments')) AS t(section)""",
        "document_summary": CLICKS
        + DAILY
        + f""" SELECT 'tallycart' AS engine, '2024-02-01T00:00:00Z' AS generated_at,
  (SELECT count(*) FROM ev WHERE event_type IN ('view', 'cart', 'purchase')) AS total_events, {money('sum(revenue)')} AS total_revenue,
  count(DISTINCT order_id) AS total_orders, min(event_date) AS start, max(event_date) AS "end" FROM p""",
        "document_daily": CLICKS + DAILY + DAILY_REPORT,
        "insights": _insights(),
        "dashboard_snapshot": _snapshot(),
    }
