"""Oracle SQL (DuckDB) for every registered query.

An independent statement of the same answers, from the definitions of the
queries and by other means than the Spark plans: gaps between orders come from
sorted lists, previous periods from a self-join on row numbers, retention from
EXISTS, rankings from QUALIFY, and profiles from a union of per-source counts.
The entity mapping of ``TestdataTables`` is stated again as CTEs, constants
included.

Decimal arithmetic is emulated exactly: Spark divides decimals at a fixed
result scale with HALF_UP rounding and then rounds again; DuckDB would
divide in double. ``_rhu`` reproduces each rounding step with 128-bit
integer arithmetic so that both engines print the same digits.
"""

from __future__ import annotations

# Fixed values of the mapping: as-of dates, first days of windows, history's end.
AS_OF, HISTORY_END = "DATE '2001-08-01'", "TIMESTAMP '1998-01-01 00:00:00'"
ORDERS_30, ORDERS_90, ORDERS_365 = "DATE '2001-07-02'", "DATE '2001-05-03'", "DATE '2000-08-01'"
EVENTS_30, EVENTS_90 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2023-11-02 00:00:00'"


def _rhu(num: str, den: str) -> str:
    """round(num / den) half away from zero, on HUGEINT operands."""
    return (
        f"(sign({num}) * sign({den}) * "
        f"((2 * abs({num}) + abs({den})) // (2 * abs({den}))))"
    )


def _cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def _growth_pct(curr: str, prev: str) -> str:
    """Spark: round(100 * (curr - prev) / nullif(prev, 0), 2) on decimal(31,2):
    the quotient is decimal(38,6) (HALF_UP), then rounded to 2 places."""
    c, p = _cents(curr), _cents(prev)
    q6 = _rhu(f"(100 * ({c} - {p}) * 1000000)", p)
    q2 = _rhu(q6, "CAST(10000 AS HUGEINT)")
    return f"(CASE WHEN ({prev}) IS NULL OR ({prev}) = 0 THEN NULL ELSE CAST({q2} AS DOUBLE) / 100.0 END)"


def _yoy_pct(curr: str, prev: str) -> str:
    """Spark: round((curr - prev) / prev * 100, 2): the ratio is decimal(38,6)
    (HALF_UP), times 100 exactly, then rounded to 2 places."""
    c, p = _cents(curr), _cents(prev)
    q6 = _rhu(f"(({c} - {p}) * 1000000)", p)
    q2 = _rhu(q6, "CAST(100 AS HUGEINT)")
    return f"(CASE WHEN ({prev}) IS NULL OR ({prev}) = 0 THEN NULL ELSE CAST({q2} AS DOUBLE) / 100.0 END)"


def _ratio_pct(part: str, whole: str) -> str:
    """Spark: round(100.0 * part / nullif(whole, 0), 2) on bigints: the
    quotient is decimal(38,14), then rounded to 2 places."""
    num = f"(CAST({part} AS HUGEINT) * 100 * CAST(100000000000000 AS HUGEINT))"
    q14 = _rhu(num, f"CAST({whole} AS HUGEINT)")
    q2 = _rhu(q14, "CAST(1000000000000 AS HUGEINT)")
    return f"(CASE WHEN ({whole}) = 0 THEN NULL ELSE CAST({q2} AS DOUBLE) / 100.0 END)"


def _avg_money(col: str) -> str:
    """Spark avg(decimal(21,2)): sum / count at scale 9 (HALF_UP), then cast
    to decimal(25,6) (HALF_UP)."""
    s = _cents(f"SUM({col})")
    q9 = _rhu(f"({s} * 10000000)", f"CAST(COUNT({col}) AS HUGEINT)")
    q6 = _rhu(q9, "CAST(1000 AS HUGEINT)")
    return f"(CASE WHEN COUNT({col}) = 0 THEN NULL ELSE CAST({q6} AS DOUBLE) / 1000000.0 END)"


def entity_ctes(product_families: bool = False) -> str:
    """The entity mapping of ``TestdataTables`` as DuckDB CTEs (no WITH)."""
    k = "c.c_custkey"
    ks = f"CAST({k} AS VARCHAR)"
    product = "l.l_partkey % 20" if product_families else "l.l_partkey"
    products = (
        "SELECT p_partkey % 20 AS product_id, min(p_name) AS name, min(p_type) AS category FROM part GROUP BY 1"
        if product_families else
        "SELECT p_partkey AS product_id, p_name AS name, p_type AS category FROM part"
    )
    return f"""
e_customers AS (
  SELECT {k} AS customer_id,
    CASE WHEN {k} % 3 = 0 THEN '  ' || split_part(c.c_name, '#', 1) || ' '
         ELSE split_part(c.c_name, '#', 1) END AS first_name,
    CASE WHEN {k} % 50 = 7 THEN NULL ELSE split_part(c.c_name, '#', 2) END AS last_name,
    CASE WHEN {k} % 10 = 0 THEN 'user' || {ks} || '.example.com'
         WHEN {k} % 10 = 1 THEN 'user' || {ks} || '@examplecom'
         WHEN {k} % 10 = 2 THEN '  USER' || {ks} || '@Example.COM '
         ELSE 'user' || {ks} || '@example.com' END AS email,
    '(' || lpad(CAST({k} % 1000 AS VARCHAR), 3, '0') || ') 555-'
        || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') AS phone,
    ' ' || {ks} || ' Market Street  ' AS address,
    'City' || CAST(c.c_nationkey AS VARCHAR) AS city,
    c.c_mktsegment AS state,
    CAST(10000 + {k} % 90000 AS INTEGER) AS zip_code,
    n.n_name AS country
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
e_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
         CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount
  FROM orders
),
e_products AS ({products}),
e_order_items AS (
  SELECT l.l_orderkey AS order_id, {product} AS product_id,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price
  FROM lineitem l, part p WHERE l.l_partkey = p.p_partkey
),
e_lines AS (
  SELECT i.order_id, o.o_custkey AS customer_id, o.o_orderdate AS order_date, i.product_id, i.quantity, i.unit_price,
         CAST(i.quantity * i.unit_price AS DECIMAL(21,2)) AS sales_amount,
         CAST(date_part('year', o.o_orderdate) AS INTEGER) AS order_year,
         CAST(date_part('month', o.o_orderdate) AS INTEGER) AS order_month
  FROM e_order_items i, orders o WHERE i.order_id = o.o_orderkey
),
e_current AS (
  SELECT * FROM e_lines
  WHERE order_date >= {HISTORY_END} AND product_id IN (SELECT product_id FROM e_products)
),
e_history AS (SELECT * FROM e_lines WHERE order_date < {HISTORY_END}),
e_logins AS (
  SELECT user_id AS customer_id, ts, concat('10.0.0.', json_extract_string(props, '$.k')) AS ip FROM events
),
e_campaigns AS (
  SELECT user_id AS CustomerID, concat('CMP-', event_id) AS CampaignID, event_id, event_type, ts
  FROM events WHERE event_type = 'click' OR event_type = 'view'
),
e_engagement AS (
  SELECT CustomerID, CampaignID, CAST(1 AS BIGINT) AS Opens, CAST(event_type = 'click' AS BIGINT) AS Clicks,
    concat(event_id, '-', kind) AS InteractionID, ts AS "Timestamp",
    ['Email', 'Web', 'App'][event_id % 3 + 1] AS Channel,
    CASE kind WHEN 'o' THEN 'Opened' ELSE 'Clicked' END AS Action
  FROM e_campaigns, (VALUES ('o'), ('c')) AS kinds(kind)
  WHERE event_id % 11 > 1 AND (kind = 'o' OR event_type = 'click') AND ts >= {EVENTS_90}
),
e_support AS (
  SELECT user_id AS CustomerID, event_id AS TicketID, ts, event_id % 2 = 0 AS is_open
  FROM events WHERE event_type = 'error'
),
e_clean_customers AS (
  SELECT DISTINCT customer_id, TRIM(first_name) AS first_name, TRIM(last_name) AS last_name,
         LOWER(TRIM(email)) AS email, regexp_replace(phone, '[^0-9]', '', 'g') AS phone,
         TRIM(address) AS address, city, state, CAST(zip_code AS VARCHAR) AS zip_code, country
  FROM e_customers
  WHERE customer_id IS NOT NULL AND regexp_matches(email, '^[^@]+@[^@]+.[^@]+$')
),
e_clean_orders AS (
  SELECT order_id, customer_id, order_date, status, total_amount FROM e_orders
  WHERE order_id IS NOT NULL AND total_amount > 0 AND order_date <= {AS_OF}
    AND customer_id IN (SELECT customer_id FROM e_clean_customers)
  GROUP BY ALL
)"""


def _with(body_ctes: str, select: str, product_families: bool = False) -> str:
    ctes = entity_ctes(product_families)
    if body_ctes.strip():
        ctes += ",\n" + body_ctes
    return f"WITH {ctes}\n{select}"


def _before(source: str, entity: str, order: str) -> str:
    """Rows of ``source`` numbered within ``entity``, each beside the one before (``prev``)."""
    on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in entity.split(", "))
    return f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY {entity} ORDER BY {order}) AS nth FROM {source}),
paired AS (SELECT a.*, b.amount AS prev FROM numbered a LEFT JOIN numbered b ON {on} AND b.nth = a.nth - 1)"""


_TOP5 = """
best AS (
  SELECT customer_id FROM (SELECT customer_id, sum(sales_amount) AS total FROM e_lines GROUP BY ALL)
  QUALIFY row_number() OVER (ORDER BY total DESC, customer_id) <= 5
)"""

_SUSPICIOUS = f"""
per_login AS (
  SELECT customer_id, count(DISTINCT ip) AS unique_ips, count(*) AS total_attempts
  FROM e_logins WHERE ts >= {EVENTS_30} GROUP BY ALL
),
suspects AS (SELECT * FROM per_login WHERE unique_ips > 3 OR total_attempts > 10)"""

_HIGH_RISK = f"""
recent AS (
  SELECT customer_id, count(order_id) AS order_count, sum(total_amount) AS total_spent
  FROM e_orders WHERE order_date >= {ORDERS_30} GROUP BY ALL
),
risky AS (SELECT * FROM recent WHERE total_spent > 5000 OR order_count > 5)"""

# One row per (source, customer); a profile is the sum over sources.
_PROFILE = f"""
counted AS (
  SELECT 'engagement' AS source, CustomerID AS id,
    count(*) FILTER (Channel = 'Email' AND Action = 'Opened') AS emails_opened,
    count(*) FILTER (Channel = 'Email' AND Action = 'Clicked') AS emails_clicked,
    count(*) FILTER (Channel <> 'Email' AND Action = 'Clicked') AS ad_clicks,
    count(*) FILTER (Channel <> 'Email' AND Action = 'Opened') AS ad_views,
    0 AS purchases, 0.00 AS total_spent, 0 AS total_ticket, 0 AS open_ticket, 0 AS resolved_ticket
  FROM e_engagement GROUP BY CustomerID
  UNION ALL
  SELECT 'orders', customer_id, 0, 0, 0, 0, count(order_id), sum(total_amount), 0, 0, 0
  FROM e_orders WHERE order_date >= {ORDERS_90} GROUP BY customer_id
  UNION ALL
  SELECT 'support', CustomerID, 0, 0, 0, 0, 0, 0.00, count(TicketID), count(*) FILTER (is_open), count(*) FILTER (NOT is_open)
  FROM e_support WHERE ts >= {EVENTS_90} GROUP BY CustomerID
),
profile AS (
  SELECT id, bool_or(source = 'engagement') AS engaged, bool_or(source = 'orders') AS bought,
    bool_or(source = 'support') AS asked,
    CAST(sum(emails_opened) AS BIGINT) AS emails_opened, CAST(sum(emails_clicked) AS BIGINT) AS emails_clicked,
    CAST(sum(ad_clicks) AS BIGINT) AS ad_clicks, CAST(sum(ad_views) AS BIGINT) AS ad_views,
    CAST(sum(purchases) AS BIGINT) AS purchases, CAST(sum(total_spent) AS DOUBLE) AS total_spent,
    CAST(sum(total_ticket) AS BIGINT) AS total_ticket, CAST(sum(open_ticket) AS BIGINT) AS open_ticket,
    CAST(sum(resolved_ticket) AS BIGINT) AS resolved_ticket
  FROM counted GROUP BY id
)"""

_ENGAGEMENT = ["emails_opened", "emails_clicked", "ad_clicks", "ad_views"]
_BUYING = ["purchases", "total_spent"]
_ASKING = ["total_ticket", "open_ticket", "resolved_ticket"]


def _split_profile(id_when_bought: str, id_else: str, missing: str) -> str:
    """Customers with engagement keep all they have in one row; of the others,
    purchases and tickets stand in rows of their own."""
    def row(cid: str, parts: list[tuple[str, list[str]]], where: str) -> str:
        columns = [
            f"CASE WHEN {has} THEN {c} ELSE {missing} END AS {c}" if has != "TRUE" else c
            for has, names in parts for c in names
        ]
        return f"SELECT {cid} AS customer_id, {', '.join(columns)} FROM profile WHERE {where}"

    return "\nUNION ALL\n".join([
        row(f"CASE WHEN bought THEN {id_when_bought} ELSE {id_else} END",
            [("TRUE", _ENGAGEMENT), ("bought", _BUYING), ("asked", _ASKING)], "engaged"),
        row(id_when_bought, [("FALSE", _ENGAGEMENT), ("TRUE", _BUYING), ("FALSE", _ASKING)], "bought AND NOT engaged"),
        row(id_else, [("FALSE", _ENGAGEMENT), ("FALSE", _BUYING), ("TRUE", _ASKING)], "asked AND NOT engaged"),
    ])


def _spending(select: str) -> str:
    return f"""
spending AS (
  SELECT customer_id, sum(total_amount) AS spent, count(order_id) AS total_orders,
    max(order_date) AS last_purchase_date
  FROM e_orders WHERE order_date >= {ORDERS_365} GROUP BY ALL
),
ranked AS (
  SELECT {select}, CAST(s.spent AS DOUBLE) AS total_spent, s.total_orders, s.last_purchase_date,
    CAST(rank() OVER (PARTITION BY c.country ORDER BY s.spent DESC) AS INTEGER) AS spending_rank
  FROM e_customers c, spending s WHERE c.customer_id = s.customer_id AND starts_with(c.country, 'NATION_1')
  QUALIFY spending_rank <= 10
)"""


def _fact_select(src: str) -> str:
    return f"SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(sales_amount AS DOUBLE) AS sales_amount) FROM {src}"


def _yoy(product_families: bool) -> str:
    return _with(_TOP5 + "," + """
by_month AS (
  SELECT customer_id, product_id, order_year AS sales_year, order_month AS sales_month,
    CAST(sum(sales_amount) AS DECIMAL(31,2)) AS amount
  FROM e_lines WHERE customer_id IN (FROM best) GROUP BY ALL
),""" + _before("by_month", "customer_id, product_id, sales_month", "sales_year"), f"""
SELECT p.customer_id, product_id, e_products.name AS product_name, category, sales_year, sales_month,
  CAST(amount AS DOUBLE) AS monthly_sales, CAST(prev AS DOUBLE) AS prev_year_sales,
  {_yoy_pct('amount', 'prev')} AS yoy_growth_percent
FROM paired p JOIN e_products USING (product_id)""", product_families)


def _dq_row(name: str, src: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, COUNT(*) AS record_count, COUNT(*) - COUNT({key}) AS null_key_count, "
        f"(COUNT(*) > 0 AND COUNT(*) = COUNT({key})) AS passed FROM {src}"
    )


ORACLE_SQL: dict[str, str] = {
    "clean_customers": _with("", "SELECT * FROM e_clean_customers"),
    "clean_orders": _with("", "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM e_clean_orders"),
    "dq_gate": _with("", "\nUNION ALL\n".join([
        _dq_row("customers", "e_clean_customers", "customer_id"),
        _dq_row("orders", "e_clean_orders", "order_id"),
        _dq_row("order_items", "e_order_items", "order_id"),
        _dq_row("products", "e_products", "product_id"),
        _dq_row("loginhistory", "e_logins", "customer_id"),
        _dq_row("usage_history", "(FROM events WHERE event_type = 'purchase')", "user_id"),
        _dq_row("customersupport", "e_support", "TicketID"),
        _dq_row("enterprisecampaigns", "e_campaigns", "CustomerID"),
        _dq_row("historical_customer_sales", "e_history", "order_id"),
    ])),
    "churn_risk": _with("""
dated AS (
  SELECT customer_id, count(order_id) AS total_orders, list_sort(list(order_date)) AS days
  FROM e_orders GROUP BY ALL
),
gaps AS (
  SELECT customer_id, total_orders, days[-1] AS last_order_date,
    list_avg(list_transform(range(2, len(days) + 1), lambda i: days[i] - days[i - 1])) AS avg_order_gap
  FROM dated
)""", f"""SELECT customer_id, total_orders, last_order_date,
  CAST({AS_OF} - last_order_date AS INTEGER) AS days_since_last_purchase, avg_order_gap
FROM gaps WHERE {AS_OF} - last_order_date > 2 * avg_order_gap"""),
    "suspicious_logins": _with(_SUSPICIOUS, "FROM suspects"),
    "high_risk_orders": _with(_HIGH_RISK, "SELECT * REPLACE (CAST(total_spent AS DOUBLE) AS total_spent) FROM risky"),
    "high_risk_customers": _with(_SUSPICIOUS + "," + _HIGH_RISK,
                                 "SELECT customer_id FROM suspects INTERSECT SELECT customer_id FROM risky"),
    "customer_spending": _with(_spending("c.country"), """SELECT customer_id, CAST(spent AS DOUBLE) AS total_spent,
  total_orders, last_purchase_date FROM spending"""),
    "top_customers_by_country": _with(
        _spending("c.country, c.customer_id, c.first_name || ' ' || c.last_name AS full_name, c.email"), "FROM ranked"),
    "top_customers_by_country_all_columns": _with(_spending("c.*"), "FROM ranked"),
    "flatten_interactions": _with("", "FROM e_engagement"),
    "channel_engagement": _with(_PROFILE, """SELECT id AS CustomerID, emails_opened AS EmailsOpened,
  emails_clicked AS EmailsClicked, ad_clicks AS AdClicks, ad_views AS AdViews FROM counted WHERE source = 'engagement'"""),
    "purchase_activity": _with(_PROFILE, """SELECT id AS customer_id, purchases, CAST(total_spent AS DOUBLE) AS total_spent
FROM counted WHERE source = 'orders'"""),
    "support_activity": _with(_PROFILE, """SELECT id AS CustomerID, total_ticket AS TotalTickets,
  open_ticket AS OpenTickets, resolved_ticket AS ResolvedTickets FROM counted WHERE source = 'support'"""),
    "omni_profile_reference": _with(_PROFILE, _split_profile("id", "NULL", "0")),
    "omni_profile_dataframe_form": _with(_PROFILE, _split_profile("id", "id", "NULL")),
    "omni_profile_unified": _with(_PROFILE, "SELECT id AS customer_id, * EXCLUDE (id, engaged, bought, asked) FROM profile"),
    "sales_fact": _with("", _fact_select("e_current")),
    "sales_fact_all": _with("", _fact_select("e_current") + "\nUNION ALL\n" + _fact_select("e_history")),
    "peak_sales_months": _with("", """SELECT format('{:04d}-{:02d}', order_year, order_month) AS year_month,
  CAST(sum(sales_amount) AS DOUBLE) AS monthly_product_sales
FROM e_lines GROUP BY order_year, order_month"""),
    "top_customer_products": _with(_TOP5, """SELECT customer_id,
  format('{:04d}-{:02d}', order_year, order_month) AS year_month, count(*) AS product_count,
  any_value(name) AS product_name, any_value(category) AS category, CAST(sum(sales_amount) AS DOUBLE) AS monthly_sales
FROM e_lines JOIN e_products USING (product_id) WHERE customer_id IN (FROM best)
GROUP BY customer_id, order_year, order_month, product_id"""),
    "customer_purchase_trend": _with(f"""
months AS (
  SELECT customer_id, order_year, order_month, count(DISTINCT order_id) AS orders_per_month,
    CAST(sum(sales_amount) AS DECIMAL(31,2)) AS amount, {_avg_money('sales_amount')} AS avg_order_value
  FROM e_lines GROUP BY ALL
),""" + _before("months", "customer_id", "order_year, order_month"), f"""SELECT customer_id, order_year, order_month,
  orders_per_month, CAST(amount AS DOUBLE) AS monthly_spent, CAST(prev AS DOUBLE) AS previous_month_spent,
  {_growth_pct('amount', 'prev')} AS spending_growth_pct, avg_order_value
FROM paired"""),
    "retention_rate": _with("""
active AS (SELECT order_year, customer_id FROM e_lines WHERE customer_id IS NOT NULL GROUP BY ALL),
kept AS (
  SELECT order_year AS current_year, count(*) AS here,
    count(*) FILTER (EXISTS (FROM active b WHERE b.customer_id = a.customer_id AND b.order_year = a.order_year - 1)) AS stayed
  FROM active a GROUP BY order_year
)""", f"""SELECT current_year, here AS total_customers_current_year, stayed AS retained_customers,
  {_ratio_pct('stayed', 'here')} AS retention_rate_pct FROM kept"""),
    "product_mom_growth": _with("""
months AS (
  SELECT product_id, order_year, order_month, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
    CAST(sum(sales_amount) AS DECIMAL(31,2)) AS amount
  FROM e_lines GROUP BY ALL
),""" + _before("months", "product_id", "order_year, order_month"), f"""SELECT order_year, order_month, product_id,
  e_products.name AS product_name, category, total_quantity_sold, CAST(amount AS DOUBLE) AS total_sales_amount,
  CAST(prev AS DOUBLE) AS previous_month_sales, {_growth_pct('amount', 'prev')} AS month_over_month_growth_pct
FROM paired JOIN e_products USING (product_id)"""),
    "yoy_comparison": _yoy(False),
    "yoy_comparison_product_families": _yoy(True),
    "customer_segments": _with("""
bought AS (
  SELECT customer_id, count(order_id) AS purchase_count, sum(sales_amount) AS spent, max(order_date) AS last_order_date
  FROM e_current GROUP BY ALL
)""", """SELECT customer_id, purchase_count, CAST(spent AS DOUBLE) AS total_spent, last_order_date,
  ['Occasional Buyer', 'Regular Customer', 'High-Value Customer'][
    1 + CAST(purchase_count >= 5 AND spent >= 500 AS INTEGER) + CAST(purchase_count >= 10 AND spent >= 1000 AS INTEGER)
  ] AS customer_segment
FROM bought"""),
}
