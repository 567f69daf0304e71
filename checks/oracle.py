"""What each query must return, as DuckDB SQL over the order-book tables.

Written apart from the Spark code: views build on each other as common table
expressions, and every statement carries the ones it needs.
"""

from __future__ import annotations

import math
import re

from checks.queries import CENTERS, FOREST

AS_OF = "DATE '2001-08-01'"
LOADED = "TIMESTAMP '2001-08-01 06:00:00'"

VIEWS: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def _uses(sql: str) -> list[str]:
    words = set(re.findall(r"\bv_\w+", sql))
    return [name for name in VIEWS if name in words]


def statement(select: str) -> str:
    needed: set[str] = set()
    todo = _uses(select)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _uses(VIEWS[name])
    parts = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    recursive = "RECURSIVE " if any(name in _uses(VIEWS[name]) for name in needed) else ""
    return (f"WITH {recursive}{', '.join(parts)} " if parts else "") + select


def tidy(column: str) -> str:
    """One word, trimmed and capitalised (every such value here is one word)."""
    word = f"trim({column})"
    return f"upper(substr({word}, 1, 1)) || lower(substr({word}, 2))"


def pick(key: str, *values: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


def mean(column: str) -> str:
    return f"sum({column})::DOUBLE / nullif(count({column}), 0)"


def days(later: str, earlier: str) -> str:
    return f"date_diff('day', ({earlier})::DATE, ({later})::DATE)"


# -- sources ------------------------------------------------------------------
VIEWS["v_customers_raw"] = f"""
SELECT c_custkey::VARCHAR AS customer_id,
  ' ' || lower(split_part(c_name, '#', 1)) AS first_name,
  split_part(c_name, '#', 2) AS last_name,
  CASE WHEN c_acctbal >= 0 THEN ' ' || upper(replace(c_name, '#', '.')) || '@Shop.example ' END AS email,
  CASE WHEN c_acctbal < 9000 THEN '+' || c_nationkey::VARCHAR || ' (555) ' || c_custkey::VARCHAR END AS phone,
  DATE '1895-01-01' + (c_custkey * 97 % 36000)::INTEGER AS date_of_birth,
  {pick('c_custkey', 'f', 'm')} AS gender,
  lower(n_name) AS city,
  lower(n_name) || ' ' AS state,
  lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS zip_code,
  DATE '1993-01-01' + (c_custkey * 13 % 2500)::INTEGER AS registration_date,
  c_mktsegment AS customer_segment,
  {pick('c_nationkey', 'Organic', 'Paid', 'Referral')} AS acquisition_channel,
  {LOADED} AS ingestion_timestamp
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

VIEWS["v_products_raw"] = f"""
SELECT p_partkey::VARCHAR AS product_id, ' ' || p_name AS product_name, p_type AS category,
  p_type || '_sub' AS subcategory, p_brand AS brand,
  CASE WHEN p_size = 49 THEN 0::DECIMAL(18,4) ELSE p_retailprice::DECIMAL(18,4) END AS price,
  CASE WHEN p_size = 48 THEN 0::DECIMAL(18,4) ELSE (p_retailprice::DECIMAL(12,2) * CASE WHEN p_size = 50 THEN 1.20::DECIMAL(3,2) ELSE 0.65::DECIMAL(3,2) END)::DECIMAL(18,4) END AS cost,
  (p_size - 1) * 2 AS stock_quantity,
  'S' || (p_partkey % 10)::VARCHAR AS supplier_id,
  DATE '1990-01-01' + (p_partkey % 3000)::INTEGER AS launch_date,
  {LOADED} AS ingestion_timestamp
FROM part"""

VIEWS["v_transactions_raw"] = """
SELECT l_orderkey::VARCHAR AS transaction_id, CASE WHEN l_orderkey % 97 <> 0 THEN o_custkey::VARCHAR END AS customer_id,
  CASE WHEN l_orderkey % 101 <> 0 OR l_linenumber <> 2 THEN l_partkey::VARCHAR END AS product_id,
  o_orderdate + to_hours((o_orderkey % 24)::INTEGER)
    - to_days(CASE l_partkey % 10 WHEN 0 THEN 400 WHEN 1 THEN 150 ELSE 0 END) AS transaction_date,
  l_quantity::INTEGER - 1 AS quantity,
  (l_extendedprice::DECIMAL(14,2) * 0.01::DECIMAL(3,2))::DECIMAL(18,4) AS unit_price,
  (l_discount::DECIMAL(4,2) * 100)::DECIMAL(9,4) AS discount_percent,
  ((l_extendedprice::DECIMAL(14,2) * 0.01::DECIMAL(3,2))::DECIMAL(18,4)
    * (1::DECIMAL(4,2) - l_discount::DECIMAL(4,2))
    * CASE WHEN l_orderkey % 89 = 0 AND l_linenumber = 1 THEN -1 ELSE 1 END)::DECIMAL(18,4) AS total_amount,
  CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'Credit Card'
       WHEN o_orderpriority = '2-HIGH' THEN 'PayPal' ELSE 'Debit Card' END AS payment_method,
  CASE o_orderstatus WHEN 'F' THEN 'Online' WHEN 'O' THEN 'Store' ELSE 'Mobile App' END AS channel,
  l_suppkey::VARCHAR AS store_id,
  l_tax::DECIMAL(4,2)::DECIMAL(18,4) AS shipping_cost,
  CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Cancelled' ELSE 'Completed' END AS order_status,
  l_shipdate AS ingestion_timestamp
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""

VIEWS["v_tickets_raw"] = f"""
SELECT o_orderkey::VARCHAR AS ticket_id, o_custkey::VARCHAR AS customer_id, o_orderdate AS created_date,
  split_part(o_orderpriority, '-', 2) AS category,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High' ELSE 'Normal' END AS priority,
  CASE WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Closed' END AS status,
  {pick('o_orderkey', 'ana', 'ben', 'cho')} AS assigned_agent,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_hours((o_orderkey * 7 % 120)::INTEGER) END AS resolved_date,
  CASE WHEN o_orderstatus <> 'O' THEN (o_orderkey * 7 % 120)::INTEGER END AS resolution_time_hours,
  (o_orderkey % 5 + 1)::INTEGER AS customer_satisfaction
FROM orders"""

VIEWS["v_events"] = """
SELECT event_id, user_id, user_id::VARCHAR AS customer_id, ts - to_days(8218) AS happened, event_type, value,
  regexp_extract(props, '([0-9]+)', 1)::INTEGER AS k, floor(value)::INTEGER AS whole
FROM events"""

VIEWS["v_crm_raw"] = f"""
SELECT event_id::VARCHAR AS interaction_id, customer_id, happened AS interaction_date,
  CASE WHEN event_type = 'error' THEN 'Complaint' ELSE 'Inquiry' END AS interaction_type, event_type AS reason,
  {pick('event_id', 'Resolved', 'Pending', 'Closed', 'Escalated')} AS resolution_status,
  {pick('k', 'ana', 'ben', 'cho')} AS agent_id, whole % 45 AS duration_minutes,
  (event_id % 5 + 1)::INTEGER AS satisfaction_score, 'k=' || k::VARCHAR AS notes
FROM v_events"""

VIEWS["v_loyalty_raw"] = f"""
SELECT event_id::VARCHAR AS event_id, customer_id, happened AS event_date, event_type,
  CASE event_type WHEN 'purchase' THEN whole WHEN 'error' THEN -whole ELSE 0 END AS points_change,
  k * 20 AS points_balance, {pick('user_id', 'Gold', 'Silver', 'Bronze', 'Platinum')} AS tier,
  'k=' || k::VARCHAR AS description
FROM v_events"""

VIEWS["v_web_raw"] = f"""
SELECT event_id::VARCHAR AS session_id, CASE WHEN event_type <> 'signup' THEN customer_id END AS customer_id,
  happened AS session_date, {pick('event_id', 'Mobile', 'Desktop', 'Tablet')} AS device_type,
  {pick('k', 'Firefox', 'Chrome')} AS browser, k % 12 AS page_views, floor(value * 3)::INTEGER AS session_duration_seconds,
  event_type = 'error' AS bounce, event_type = 'purchase' AS conversion,
  {pick('k', 'mail', 'search', 'direct')} AS utm_source, {pick('user_id', 'spring', 'fall')} AS utm_campaign,
  '/home' AS landing_page, '/' || event_type AS exit_page
FROM v_events"""

# -- conformed ------------------------------------------------------------------
VIEWS["v_customers"] = f"""
SELECT *, CASE WHEN email IS NULL OR phone_cleaned IS NULL THEN 'Missing Contact Info'
  WHEN age < 18 THEN 'Underage' WHEN age > 100 THEN 'Invalid Age' ELSE 'Valid' END AS data_quality_flag
FROM (SELECT customer_id, {tidy('first_name')} AS first_name, {tidy('last_name')} AS last_name,
  lower(trim(email)) AS email, regexp_replace(phone, '[^0-9]', '', 'g') AS phone_cleaned,
  phone AS phone_original, date_of_birth, registration_date,
  floor({days(AS_OF, 'date_of_birth')} / 365.25)::BIGINT AS age,
  {days(AS_OF, 'registration_date')}::INTEGER AS customer_tenure_days,
  upper(gender) AS gender, {tidy('city')} AS city, upper(trim(state)) AS state, zip_code,
  customer_segment, acquisition_channel, ingestion_timestamp AS bronze_ingestion_timestamp
FROM v_customers_raw)"""

VIEWS["v_products"] = f"""
SELECT product_id, trim(product_name) AS product_name, {tidy('category')} AS category,
  {tidy('subcategory')} AS subcategory, {tidy('brand')} AS brand, price, cost,
  round((price - cost)::DOUBLE / nullif(price::DOUBLE, 0) * 100, 2) AS profit_margin_pct,
  stock_quantity,
  CASE WHEN stock_quantity = 0 THEN 'Out of Stock' WHEN stock_quantity < 10 THEN 'Low Stock'
       WHEN stock_quantity < 50 THEN 'Medium Stock' ELSE 'In Stock' END AS stock_status,
  supplier_id, launch_date, {days(AS_OF, 'launch_date')}::INTEGER AS product_age_days,
  ingestion_timestamp AS bronze_ingestion_timestamp,
  CASE WHEN price IS NULL OR price <= 0 THEN 'Invalid Price' WHEN cost IS NULL OR cost <= 0 THEN 'Invalid Cost'
       WHEN price < cost THEN 'Price Below Cost' ELSE 'Valid' END AS data_quality_flag
FROM v_products_raw"""

VIEWS["v_flagged"] = """
SELECT *, CASE WHEN total_amount < 0 THEN 'Negative Amount' WHEN quantity <= 0 THEN 'Invalid Quantity'
  WHEN customer_id IS NULL THEN 'Missing Customer' WHEN product_id IS NULL THEN 'Missing Product'
  ELSE 'Valid' END AS data_quality_flag
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id, product_id ORDER BY
    ingestion_timestamp DESC NULLS LAST, customer_id NULLS FIRST, transaction_date NULLS FIRST,
    quantity NULLS FIRST, unit_price NULLS FIRST, discount_percent NULLS FIRST,
    total_amount NULLS FIRST, payment_method NULLS FIRST, channel NULLS FIRST,
    store_id NULLS FIRST, shipping_cost NULLS FIRST, order_status NULLS FIRST) AS place
  FROM v_transactions_raw) WHERE place = 1"""

VIEWS["v_lines"] = """
SELECT t.transaction_id, t.customer_id, t.product_id, t.transaction_date,
  year(t.transaction_date)::INTEGER AS transaction_year, month(t.transaction_date)::INTEGER AS transaction_month,
  (dayofweek(t.transaction_date) + 1)::INTEGER AS transaction_day_of_week,
  hour(t.transaction_date)::INTEGER AS transaction_hour, quarter(t.transaction_date)::INTEGER AS transaction_quarter,
  t.quantity, t.unit_price, t.discount_percent, t.total_amount,
  round(t.unit_price * t.quantity::DECIMAL(9,0) * t.discount_percent * 0.01, 2) AS discount_amount,
  t.total_amount AS revenue,
  round(t.total_amount - p.cost * t.quantity::DECIMAL(9,0), 2) AS gross_profit,
  t.payment_method, t.channel, t.store_id, t.shipping_cost, t.order_status,
  c.customer_segment, c.state AS customer_state, p.category AS product_category, p.brand AS product_brand,
  t.ingestion_timestamp AS bronze_ingestion_timestamp, t.data_quality_flag
FROM v_flagged t LEFT JOIN v_customers c ON t.customer_id = c.customer_id
  LEFT JOIN v_products p ON t.product_id = p.product_id
WHERE t.data_quality_flag = 'Valid'"""

VIEWS["v_crm"] = f"""
SELECT event_id::VARCHAR AS interaction_id, customer_id, happened AS interaction_date,
  year(happened)::INTEGER AS interaction_year, month(happened)::INTEGER AS interaction_month,
  CASE WHEN event_type = 'error' THEN 'Complaint' ELSE 'Inquiry' END AS interaction_type,
  event_type AS reason,
  {pick('event_id', 'Resolved', 'Pending', 'Closed', 'Escalated')} AS resolution_status,
  {pick('k', 'ana', 'ben', 'cho')} AS agent_id, whole % 45 AS duration_minutes,
  CASE WHEN whole % 45 < 5 THEN 'Quick' WHEN whole % 45 < 15 THEN 'Standard'
       WHEN whole % 45 < 30 THEN 'Extended' ELSE 'Long' END AS duration_category,
  (event_id % 5 + 1)::INTEGER AS satisfaction_score,
  event_id % 4 IN (1, 3) AS is_unresolved,
  'k=' || k::VARCHAR AS notes, {LOADED} AS bronze_ingestion_timestamp
FROM v_events"""

VIEWS["v_loyalty"] = f"""
SELECT event_id, customer_id, event_date, year(event_date)::INTEGER AS event_year,
  month(event_date)::INTEGER AS event_month, event_type, points_change,
  CASE WHEN points_change > 0 THEN 'Earn' WHEN points_change < 0 THEN 'Redeem' ELSE 'Neutral' END AS points_transaction_type,
  points_balance, tier, description, {LOADED} AS bronze_ingestion_timestamp
FROM (SELECT event_id::VARCHAR AS event_id, customer_id, happened AS event_date, event_type,
    CASE event_type WHEN 'purchase' THEN whole WHEN 'error' THEN -whole ELSE 0 END AS points_change,
    k * 20 AS points_balance, {pick('user_id', 'Gold', 'Silver', 'Bronze', 'Platinum')} AS tier,
    'k=' || k::VARCHAR AS description FROM v_events)"""

VIEWS["v_web"] = f"""
SELECT session_id, customer_id, session_date, year(session_date)::INTEGER AS session_year,
  month(session_date)::INTEGER AS session_month, (dayofweek(session_date) + 1)::INTEGER AS session_day_of_week,
  hour(session_date)::INTEGER AS session_hour, device_type, browser, page_views, session_duration_seconds,
  round(session_duration_seconds::DOUBLE / nullif(page_views, 0)::DOUBLE, 2) AS avg_time_per_page_seconds,
  CASE WHEN session_duration_seconds < 60 THEN 'Very Short' WHEN session_duration_seconds < 300 THEN 'Short'
       WHEN session_duration_seconds < 900 THEN 'Medium' ELSE 'Long' END AS session_duration_category,
  is_bounce, is_conversion, utm_source, utm_campaign, '/home' AS landing_page, exit_page,
  NOT is_conversion AND page_views > 3 AS is_abandoned_cart, {LOADED} AS bronze_ingestion_timestamp
FROM (SELECT event_id::VARCHAR AS session_id,
    CASE WHEN event_type <> 'signup' THEN customer_id END AS customer_id, happened AS session_date,
    {pick('event_id', 'Mobile', 'Desktop', 'Tablet')} AS device_type,
    {pick('k', 'Firefox', 'Chrome')} AS browser, k % 12 AS page_views,
    floor(value * 3)::INTEGER AS session_duration_seconds,
    event_type = 'error' AS is_bounce, event_type = 'purchase' AS is_conversion,
    {pick('k', 'mail', 'search', 'direct')} AS utm_source,
    {pick('user_id', 'spring', 'fall')} AS utm_campaign, '/' || event_type AS exit_page FROM v_events)"""

VIEWS["v_tickets"] = f"""
SELECT ticket_id, customer_id, created_date, year(created_date)::INTEGER AS created_year,
  month(created_date)::INTEGER AS created_month, category, priority, status, assigned_agent,
  resolved_date, resolution_time_hours,
  CASE WHEN resolution_time_hours IS NULL THEN 'Unresolved' WHEN resolution_time_hours < 4 THEN 'Fast'
       WHEN resolution_time_hours < 24 THEN 'Standard' WHEN resolution_time_hours < 72 THEN 'Slow'
       ELSE 'Very Slow' END AS resolution_speed,
  coalesce(resolution_time_hours > CASE priority WHEN 'High' THEN 48 ELSE 72 END, false) AS sla_breached,
  customer_satisfaction, customer_satisfaction <= 2 AS is_dissatisfied,
  {LOADED} AS bronze_ingestion_timestamp
FROM v_tickets_raw"""

# -- per customer -----------------------------------------------------------------
VIEWS["v_transaction_metrics"] = f"""
SELECT customer_id, count(transaction_id) AS total_transactions, sum(revenue)::DOUBLE AS total_revenue,
  {mean('revenue')} AS avg_transaction_value, max(transaction_date) AS last_purchase_date,
  min(transaction_date) AS first_purchase_date,
  count(DISTINCT product_category) AS distinct_categories_purchased,
  count(*) FILTER (WHERE order_status = 'Returned') AS return_count,
  {days(AS_OF, 'max(transaction_date)')}::INTEGER AS recency_days
FROM v_lines GROUP BY customer_id"""

VIEWS["v_loyalty_metrics"] = """
SELECT customer_id, max(points_balance) AS current_loyalty_points, max(tier) AS current_loyalty_tier,
  sum(CASE WHEN points_change > 0 THEN points_change ELSE 0 END)::BIGINT AS total_points_earned,
  sum(CASE WHEN points_change < 0 THEN -points_change ELSE 0 END)::BIGINT AS total_points_redeemed
FROM v_loyalty GROUP BY customer_id"""

VIEWS["v_crm_metrics"] = f"""
SELECT customer_id, count(*) AS total_crm_interactions, {mean('satisfaction_score')} AS avg_satisfaction_score,
  count(*) FILTER (WHERE is_unresolved) AS unresolved_interactions_count
FROM v_crm GROUP BY customer_id"""

VIEWS["v_web_metrics"] = f"""
SELECT customer_id, count(*) AS total_web_sessions, sum(page_views)::BIGINT AS total_page_views,
  {mean('session_duration_seconds')} AS avg_session_duration,
  count(*) FILTER (WHERE is_conversion) AS web_conversions,
  count(DISTINCT device_type) AS distinct_devices_used
FROM v_web WHERE customer_id IS NOT NULL GROUP BY customer_id"""

VIEWS["v_ticket_metrics"] = f"""
SELECT customer_id, count(*) AS total_support_tickets,
  count(*) FILTER (WHERE sla_breached) AS sla_breaches_count,
  {mean('customer_satisfaction')} AS avg_ticket_satisfaction
FROM v_tickets GROUP BY customer_id"""

VIEWS["v_360_joined"] = """
SELECT c.*, t.* EXCLUDE (customer_id), l.* EXCLUDE (customer_id), m.* EXCLUDE (customer_id),
  w.* EXCLUDE (customer_id), s.* EXCLUDE (customer_id),
  coalesce(t.recency_days <= 90, false) AS is_active_customer
FROM v_customers c LEFT JOIN v_transaction_metrics t ON c.customer_id = t.customer_id
  LEFT JOIN v_loyalty_metrics l ON c.customer_id = l.customer_id
  LEFT JOIN v_crm_metrics m ON c.customer_id = m.customer_id
  LEFT JOIN v_web_metrics w ON c.customer_id = w.customer_id
  LEFT JOIN v_ticket_metrics s ON c.customer_id = s.customer_id"""

FILLED_360 = [
    ("total_transactions", "0"), ("total_revenue", "0.0"), ("avg_transaction_value", "0.0"),
    ("return_count", "0"), ("current_loyalty_points", "0"), ("total_points_earned", "0"),
    ("total_points_redeemed", "0"), ("total_crm_interactions", "0"), ("avg_satisfaction_score", "0.0"),
    ("unresolved_interactions_count", "0"), ("total_web_sessions", "0"), ("total_page_views", "0"),
    ("avg_session_duration", "0.0"), ("web_conversions", "0"), ("distinct_devices_used", "0"),
    ("total_support_tickets", "0"), ("sla_breaches_count", "0"), ("avg_ticket_satisfaction", "0.0"),
]
VIEWS["v_360"] = f"""
SELECT * REPLACE ({', '.join(f'coalesce({c}, {z}) AS {c}' for c, z in FILLED_360)}),
  coalesce(total_revenue, 0.0) AS customer_lifetime_value,
  round((coalesce(avg_satisfaction_score, 3.0) * 20)::DECIMAL(18,6)
    + (least(coalesce(total_transactions, 0), 20) * 2)::DECIMAL(18,6)
    + (CASE WHEN is_active_customer THEN 30 ELSE 0 END)::DECIMAL(18,6)
    + least(coalesce(current_loyalty_points, 0) / 100, 10.0)::DECIMAL(18,6), 1)::DOUBLE AS customer_health_score,
  CASE WHEN recency_days > 180 THEN 'High' WHEN recency_days > 90 THEN 'Medium' ELSE 'Low' END AS churn_risk_flag
FROM v_360_joined"""

VIEWS["v_rfm_base"] = f"""
SELECT customer_id, {days(AS_OF, 'max(transaction_date)')}::INTEGER AS recency_days,
  count(DISTINCT transaction_id) AS frequency, sum(revenue)::DOUBLE AS monetary_value
FROM v_lines GROUP BY customer_id"""

VIEWS["v_cuts"] = """
SELECT quantile_disc(recency_days, [0.2, 0.4, 0.6, 0.8]) AS r,
  quantile_disc(frequency, [0.2, 0.4, 0.6, 0.8]) AS f,
  quantile_disc(monetary_value, [0.2, 0.4, 0.6, 0.8]) AS m FROM v_rfm_base"""

VIEWS["v_rfm"] = """
SELECT *, CASE WHEN rfm_score >= 13 THEN 'Champions' WHEN rfm_score >= 11 THEN 'Loyal Customers'
  WHEN rfm_score >= 9 THEN 'Potential Loyalists' WHEN rfm_score >= 7 THEN 'At Risk'
  WHEN rfm_score >= 5 THEN 'Needs Attention' ELSE 'Lost' END AS rfm_segment
FROM (SELECT *, recency_score + frequency_score + monetary_score AS rfm_score FROM (
  SELECT v_rfm_base.*,
    CASE WHEN recency_days <= r[1] THEN 5 WHEN recency_days <= r[2] THEN 4 WHEN recency_days <= r[3] THEN 3
         WHEN recency_days <= r[4] THEN 2 ELSE 1 END AS recency_score,
    CASE WHEN frequency >= f[4] THEN 5 WHEN frequency >= f[3] THEN 4 WHEN frequency >= f[2] THEN 3
         WHEN frequency >= f[1] THEN 2 ELSE 1 END AS frequency_score,
    CASE WHEN monetary_value >= m[4] THEN 5 WHEN monetary_value >= m[3] THEN 4 WHEN monetary_value >= m[2] THEN 3
         WHEN monetary_value >= m[1] THEN 2 ELSE 1 END AS monetary_score
  FROM v_rfm_base, v_cuts))"""

RECENT = ", ".join(
    f"count(*) FILTER (WHERE transaction_date >= {AS_OF} - {d}) AS transactions_last_{d}d, "
    f"sum(CASE WHEN transaction_date >= {AS_OF} - {d} THEN revenue ELSE 0 END)::DOUBLE AS revenue_last_{d}d"
    for d in (30, 60, 90)
)
VIEWS["v_transaction_features"] = f"""
SELECT customer_id, count(transaction_id) AS total_transactions, sum(revenue)::DOUBLE AS total_revenue,
  {mean('revenue')} AS avg_transaction_value,
  round(stddev_samp(revenue::DOUBLE), 6) AS stddev_transaction_value, {RECENT},
  count(DISTINCT transaction_month) AS distinct_months_active, {mean('transaction_hour')} AS avg_purchase_hour,
  count(DISTINCT product_id) AS distinct_products_purchased,
  count(DISTINCT product_category) AS distinct_categories_purchased,
  count(*) FILTER (WHERE channel = 'Online') AS online_purchases,
  count(*) FILTER (WHERE channel = 'Store') AS store_purchases,
  count(*) FILTER (WHERE channel = 'Mobile App') AS mobile_purchases,
  count(*) FILTER (WHERE order_status = 'Returned') AS return_count,
  count(*) FILTER (WHERE order_status = 'Cancelled') AS cancellation_count,
  {days(AS_OF, 'max(transaction_date)')}::INTEGER AS days_since_last_purchase,
  {days('max(transaction_date)', 'min(transaction_date)')}::INTEGER AS customer_lifespan_days,
  {mean('discount_percent')} AS avg_discount_used,
  count(*) FILTER (WHERE discount_percent > 0) AS discounted_purchases,
  count(*) FILTER (WHERE payment_method = 'Credit Card') AS credit_card_payments,
  count(*) FILTER (WHERE payment_method = 'PayPal') AS paypal_payments
FROM v_lines GROUP BY customer_id"""

VIEWS["v_loyalty_features"] = """
SELECT customer_id, max(points_balance) AS current_loyalty_points,
  sum(CASE WHEN points_change > 0 THEN points_change ELSE 0 END)::BIGINT AS total_points_earned,
  sum(CASE WHEN points_change < 0 THEN abs(points_change) ELSE 0 END)::BIGINT AS total_points_redeemed,
  count(DISTINCT event_type) AS distinct_loyalty_event_types,
  max(CASE tier WHEN 'Gold' THEN 3 WHEN 'Silver' THEN 2 ELSE 1 END) AS loyalty_tier_numeric
FROM v_loyalty GROUP BY customer_id"""

VIEWS["v_crm_features"] = f"""
SELECT customer_id, count(*) AS total_crm_interactions,
  count(*) FILTER (WHERE interaction_type = 'Complaint') AS complaint_count,
  {mean('satisfaction_score')} AS avg_crm_satisfaction,
  count(*) FILTER (WHERE is_unresolved) AS unresolved_issues,
  {days(AS_OF, 'max(interaction_date)')}::INTEGER AS days_since_last_contact
FROM v_crm GROUP BY customer_id"""

VIEWS["v_web_features"] = f"""
SELECT customer_id, count(*) AS total_web_sessions, sum(page_views)::BIGINT AS total_page_views,
  {mean('page_views')} AS avg_pages_per_session, count(*) FILTER (WHERE is_bounce) AS bounce_sessions,
  count(*) FILTER (WHERE is_conversion) AS web_conversions,
  count(*) FILTER (WHERE is_abandoned_cart) AS abandoned_cart_count,
  count(DISTINCT device_type) AS distinct_devices,
  count(*) FILTER (WHERE device_type = 'Mobile') AS mobile_sessions
FROM v_web WHERE customer_id IS NOT NULL GROUP BY customer_id"""

VIEWS["v_ticket_features"] = f"""
SELECT customer_id, count(*) AS total_support_tickets,
  count(*) FILTER (WHERE priority = 'High') AS high_priority_tickets,
  count(*) FILTER (WHERE sla_breached) AS sla_breach_count,
  {mean('customer_satisfaction')} AS avg_ticket_satisfaction,
  count(*) FILTER (WHERE is_dissatisfied) AS dissatisfied_ticket_count
FROM v_tickets GROUP BY customer_id"""

FEATURE_INTS = """total_transactions transactions_last_30d transactions_last_60d transactions_last_90d
distinct_months_active distinct_products_purchased distinct_categories_purchased online_purchases
store_purchases mobile_purchases return_count cancellation_count days_since_last_purchase
customer_lifespan_days discounted_purchases credit_card_payments paypal_payments current_loyalty_points
total_points_earned total_points_redeemed distinct_loyalty_event_types loyalty_tier_numeric
total_crm_interactions complaint_count unresolved_issues days_since_last_contact total_web_sessions
total_page_views bounce_sessions web_conversions abandoned_cart_count distinct_devices mobile_sessions
total_support_tickets high_priority_tickets sla_breach_count dissatisfied_ticket_count""".split()
FEATURE_DOUBLES = """total_revenue avg_transaction_value stddev_transaction_value revenue_last_30d
revenue_last_60d revenue_last_90d avg_purchase_hour avg_discount_used avg_crm_satisfaction
avg_pages_per_session avg_ticket_satisfaction""".split()
_filled = [f"coalesce({c}, 0) AS {c}" for c in FEATURE_INTS] + [
    f"coalesce({c}, 0.0) AS {c}" for c in FEATURE_DOUBLES
]
VIEWS["v_features"] = f"""
SELECT *,
  CASE WHEN customer_lifespan_days > 0 THEN total_transactions::DOUBLE / (customer_lifespan_days / 30) ELSE 0.0 END AS purchase_frequency,
  CASE WHEN total_transactions > 0 THEN return_count / total_transactions ELSE 0.0 END AS return_rate,
  CASE WHEN total_web_sessions > 0 THEN web_conversions / total_web_sessions ELSE 0.0 END AS web_conversion_rate,
  CASE WHEN total_points_earned > 0 THEN total_points_redeemed / total_points_earned ELSE 0.0 END AS loyalty_redemption_rate,
  CASE WHEN days_since_last_purchase > 90 THEN 1 ELSE 0 END AS is_churned
FROM (SELECT c.customer_id, age, gender, state, customer_segment, acquisition_channel, customer_tenure_days,
    {', '.join(_filled)}, recency_score, frequency_score, monetary_score, rfm_segment
  FROM v_customers c LEFT JOIN v_transaction_features t ON c.customer_id = t.customer_id
    LEFT JOIN v_loyalty_features l ON c.customer_id = l.customer_id
    LEFT JOIN v_crm_features m ON c.customer_id = m.customer_id
    LEFT JOIN v_web_features w ON c.customer_id = w.customer_id
    LEFT JOIN v_ticket_features s ON c.customer_id = s.customer_id
    LEFT JOIN v_rfm r ON c.customer_id = r.customer_id)"""


def clv_sql(source: str, as_of: str) -> str:
    return f"""
SELECT b.* EXCLUDE (avg_transaction_revenue, freq), coalesce(avg_transaction_revenue, 0.0) AS avg_transaction_revenue,
  freq AS purchase_frequency_monthly,
  CASE WHEN purchase_count > 1 THEN customer_age_days / (purchase_count - 1) END AS avg_days_between_purchases,
  age, customer_segment, customer_tenure_days,
  round(coalesce(avg_transaction_revenue, 0.0) * freq * 36.0::DOUBLE, 2) AS predicted_clv_3yr
FROM (SELECT *, CASE WHEN customer_age_days > 0 THEN purchase_count::DOUBLE / (customer_age_days / 30.0::DOUBLE) ELSE 0.0 END AS freq
  FROM (SELECT customer_id, sum(revenue)::DOUBLE AS historical_revenue, {mean('revenue')} AS avg_transaction_revenue,
    count(transaction_id) AS purchase_count, count(DISTINCT transaction_date::DATE) AS purchase_days,
    {days('max(transaction_date)', 'min(transaction_date)')}::INTEGER AS customer_age_days,
    {days(as_of, 'max(transaction_date)')}::INTEGER AS recency_days,
    count(DISTINCT product_category) AS categories_purchased, {mean('quantity')} AS avg_items_per_transaction
  FROM {source} GROUP BY customer_id)) b
LEFT JOIN v_customers c ON b.customer_id = c.customer_id"""


VIEWS["v_clv_untiered"] = clv_sql("v_lines", AS_OF)
VIEWS["v_clv"] = """
SELECT *, CASE WHEN predicted_clv_3yr >= 10000 THEN 'Platinum' WHEN predicted_clv_3yr >= 5000 THEN 'Gold'
  WHEN predicted_clv_3yr >= 2000 THEN 'Silver' ELSE 'Bronze' END AS clv_tier FROM v_clv_untiered"""

# -- sales --------------------------------------------------------------------------
CALENDAR = """(dayofweek(date) + 1)::INTEGER AS day_of_week, dayname(date) AS day_name,
  weekofyear(date)::INTEGER AS week_of_year, month(date)::INTEGER AS month, quarter(date)::INTEGER AS quarter,
  year(date)::INTEGER AS year, CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"""
VIEWS["v_daily"] = f"""
SELECT date, 'daily' AS aggregation_level, NULL::VARCHAR AS category, transaction_count, total_revenue,
  avg_transaction_value, unique_customers, total_quantity_sold, {CALENDAR}
FROM (SELECT transaction_date::DATE AS date, count(transaction_id) AS transaction_count,
  sum(revenue)::DOUBLE AS total_revenue, {mean('revenue')} AS avg_transaction_value,
  count(DISTINCT customer_id) AS unique_customers, sum(quantity)::BIGINT AS total_quantity_sold
  FROM v_lines GROUP BY 1)"""
VIEWS["v_monthly"] = f"""
SELECT *, year::VARCHAR || '-' || lpad(month::VARCHAR, 2, '0') AS month_year
FROM (SELECT transaction_year AS year, transaction_month AS month, count(transaction_id) AS transaction_count,
  sum(revenue)::DOUBLE AS total_revenue, {mean('revenue')} AS avg_transaction_value,
  count(DISTINCT customer_id) AS unique_customers FROM v_lines GROUP BY 1, 2)"""
VIEWS["v_by_category"] = """
SELECT transaction_date::DATE AS date, product_category, sum(revenue)::DOUBLE AS category_revenue,
  count(transaction_id) AS category_transaction_count FROM v_lines GROUP BY 1, 2"""
VIEWS["v_performance"] = f"""
SELECT *, CASE WHEN days_since_last_sale > 180 THEN 'Dormant' WHEN days_since_last_sale > 90 THEN 'Slow Moving'
  WHEN avg_daily_sales > 1 THEN 'Fast Moving' ELSE 'Active' END AS product_status
FROM (SELECT s.*, product_name, category, subcategory, brand, price::DOUBLE AS price, cost::DOUBLE AS cost,
    profit_margin_pct, stock_quantity,
    CASE WHEN total_orders > 0 THEN return_count / total_orders ELSE 0.0 END AS return_rate,
    {days('last_sold_date', 'first_sold_date')}::INTEGER AS product_lifespan_days,
    {days(AS_OF, 'last_sold_date')}::INTEGER AS days_since_last_sale,
    CASE WHEN {days('last_sold_date', 'first_sold_date')} > 0
      THEN total_quantity_sold / {days('last_sold_date', 'first_sold_date')} ELSE 0.0 END AS avg_daily_sales
  FROM (SELECT product_id, count(transaction_id) AS total_orders, sum(quantity)::BIGINT AS total_quantity_sold,
      sum(revenue)::DOUBLE AS total_revenue, {mean('revenue')} AS avg_order_value,
      count(DISTINCT customer_id) AS unique_customers,
      count(*) FILTER (WHERE order_status = 'Returned') AS return_count,
      min(transaction_date) AS first_sold_date, max(transaction_date) AS last_sold_date
    FROM v_lines GROUP BY product_id) s LEFT JOIN v_products p ON s.product_id = p.product_id)"""

# -- segments -----------------------------------------------------------------------
SEGMENTATION = """total_transactions total_revenue days_since_last_purchase distinct_categories_purchased
avg_transaction_value return_rate current_loyalty_points web_conversion_rate""".split()
VIEWS["v_numbers"] = (
    f"SELECT customer_id, {', '.join(f'{c}::DOUBLE AS {c}' for c in SEGMENTATION)} FROM v_features"
)
_distance = [
    " + ".join(
        f"({c} - ({x})::DOUBLE) * ({c} - ({x})::DOUBLE)"
        for c, x in zip(SEGMENTATION, center, strict=True)
    )
    for center in CENTERS
]
_ids = range(len(CENTERS))
VIEWS["v_assigned"] = f"""
SELECT customer_id, {', '.join(SEGMENTATION)},
  CASE {' '.join(f'WHEN d{i} = nearest THEN {i}' for i in _ids)} END AS cluster
FROM (SELECT *, least({', '.join(f'd{i}' for i in _ids)}) AS nearest FROM (
  SELECT *, {', '.join(f'{d} AS d{i}' for i, d in enumerate(_distance))} FROM v_numbers))"""
VIEWS["v_named"] = """
SELECT *, CASE cluster WHEN 0 THEN 'High Value Frequent Buyers' WHEN 1 THEN 'Occasional Shoppers'
  WHEN 2 THEN 'At Risk Customers' WHEN 3 THEN 'New Customers' WHEN 4 THEN 'Discount Seekers'
  ELSE 'Segment_' || cluster::VARCHAR END AS segment_name FROM v_assigned"""


# -- forecast ------------------------------------------------------------------------
def forecast_views(prefix: str, series: str) -> None:
    """Views of the trend-and-weekday forecast over ``series`` (series_id, date, y)."""
    v = f"v_{prefix}"
    VIEWS[f"{v}_span"] = f"""
SELECT series_id, min(date) AS first, max(date) AS last, count(*) AS days FROM {series} GROUP BY series_id"""
    VIEWS[f"{v}_history"] = f"""
SELECT d.series_id, d.date, date_diff('day', d.first, d.date) AS t, dayofweek(d.date) AS weekday, coalesce(s.y, 0.0) AS y
FROM (SELECT series_id, first, unnest(generate_series(first::TIMESTAMP, last::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date
  FROM {v}_span WHERE days >= 14) d LEFT JOIN {series} s ON d.series_id = s.series_id AND d.date = s.date"""
    VIEWS[f"{v}_trend"] = f"""
SELECT series_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS base, max(date) AS last_date, max(t) AS last_t
FROM {v}_history GROUP BY series_id"""
    VIEWS[f"{v}_effect"] = f"""
SELECT h.series_id, weekday, avg(y - (base + slope * t)) AS effect
FROM {v}_history h JOIN {v}_trend r ON h.series_id = r.series_id GROUP BY h.series_id, weekday"""
    VIEWS[f"{v}_fitted"] = f"""
SELECT h.series_id, date, y, base + slope * t + effect AS prediction
FROM {v}_history h JOIN {v}_trend r ON h.series_id = r.series_id
  JOIN {v}_effect e ON h.series_id = e.series_id AND h.weekday = e.weekday"""
    VIEWS[f"{v}_spread"] = f"""
SELECT series_id, stddev_samp(y - prediction) AS sd FROM {v}_fitted GROUP BY series_id"""
    VIEWS[f"{v}_forecast"] = f"""
SELECT series_id, date AS forecast_date, round(prediction, 4) AS predicted_revenue, NULL::DOUBLE AS lower_bound,
  NULL::DOUBLE AS upper_bound, 'trend_weekday' AS model_type, false AS is_future FROM {v}_fitted
UNION ALL
SELECT f.series_id, f.date, round(level, 4), round(level - 1.96 * sd, 4), round(level + 1.96 * sd, 4), 'trend_weekday', true
FROM (SELECT a.series_id, a.date, base + slope * (last_t + step) + effect AS level
  FROM (SELECT r.series_id, base, slope, last_t, step, (last_date + step::INTEGER)::DATE AS date
    FROM {v}_trend r, (SELECT unnest(generate_series(1, 30)) AS step)) a
  JOIN {v}_effect e ON a.series_id = e.series_id AND dayofweek(a.date) = e.weekday) f
JOIN {v}_spread s ON f.series_id = s.series_id"""


ERRORS = """round(avg(abs(y - prediction)), 4) AS mae, round(sqrt(avg((y - prediction) * (y - prediction))), 4) AS rmse,
  round(avg(CASE WHEN y <> 0 THEN abs((y - prediction) / y) END) * 100, 4) AS mape"""
VIEWS["v_series"] = "SELECT 'all' AS series_id, date, total_revenue AS y FROM v_daily"
forecast_views("all", "v_series")
VIEWS["v_category_series"] = (
    "SELECT product_category AS series_id, date, category_revenue AS y FROM v_by_category"
)
forecast_views("cat", "v_category_series")
VIEWS["v_smooth_series"] = """
SELECT series_id, max(date) AS last, count(*) AS n, list(y ORDER BY t) AS y FROM v_cat_history GROUP BY series_id"""
VIEWS["v_smooth"] = """
SELECT series_id, alpha, beta, gamma, 7 AS day, list_sum(y[1:7]) / 7 AS level,
  (list_sum(y[8:14]) / 7 - list_sum(y[1:7]) / 7) / 7 AS trend,
  [v - list_sum(y[1:7]) / 7 FOR v IN y[1:7]] AS season, 0.0::DOUBLE AS squares
FROM v_smooth_series, (VALUES (0.05::DOUBLE), (0.2), (0.5)) a(alpha), (VALUES (0.0::DOUBLE), (0.02)) b(beta),
  (VALUES (0.05::DOUBLE), (0.2)) g(gamma)
UNION ALL
SELECT series_id, alpha, beta, gamma, day + 1, level + trend + alpha * e, trend + beta * e,
  [CASE WHEN i = day % 7 THEN season[i + 1] + gamma * e ELSE season[i + 1] END FOR i IN range(7)], squares + e * e
FROM (SELECT s.*, r.y[s.day + 1] - (s.level + s.trend + s.season[s.day % 7 + 1]) AS e
  FROM v_smooth s JOIN v_smooth_series r ON s.series_id = r.series_id WHERE s.day < r.n)"""
VIEWS["v_smooth_best"] = """
SELECT s.*, r.last FROM v_smooth s JOIN v_smooth_series r ON s.series_id = r.series_id AND s.day = r.n
QUALIFY row_number() OVER (PARTITION BY s.series_id ORDER BY squares, alpha, beta, gamma) = 1"""
VIEWS["v_smooth_ahead"] = """
SELECT series_id, (last + h::INTEGER)::DATE AS date, level + h * trend + season[(day + h - 1) % 7 + 1] AS y,
  1.96 * sqrt(squares / (day - 7) * (1 + coalesce(list_sum([(alpha + beta * j + CASE WHEN j % 7 = 0 THEN gamma ELSE 0 END) ** 2 FOR j IN range(1, h)]), 0))) AS margin
FROM v_smooth_best, (SELECT unnest(generate_series(1, 30)) AS h)"""
VIEWS["v_past_series"] = """
SELECT s.* FROM v_series s JOIN v_all_span p ON s.series_id = p.series_id WHERE s.date <= p.last - 30"""
forecast_views("past", "v_past_series")
VIEWS["v_held_out"] = """
SELECT d.series_id, coalesce(s.y, 0.0) AS y,
  base + slope * (last_t + date_diff('day', last_date, d.date)) + effect AS prediction
FROM (SELECT series_id, unnest(generate_series((last - 29)::TIMESTAMP, last::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM v_all_span) d
  LEFT JOIN v_series s ON d.series_id = s.series_id AND d.date = s.date
  JOIN v_past_trend r ON d.series_id = r.series_id
  JOIN v_past_effect e ON d.series_id = e.series_id AND dayofweek(d.date) = e.weekday"""

MONEY_LINES = """unit_price::DOUBLE AS unit_price, discount_percent::DOUBLE AS discount_percent,
  total_amount::DOUBLE AS total_amount, discount_amount::DOUBLE AS discount_amount, revenue::DOUBLE AS revenue,
  gross_profit::DOUBLE AS gross_profit, shipping_cost::DOUBLE AS shipping_cost"""
MONEY_PRODUCTS = "price::DOUBLE AS price, cost::DOUBLE AS cost"

SELECTS = {
    "ingest_stamp": f"""SELECT *, {LOADED} AS ingestion_timestamp, 'orders.parquet' AS source_file,
        DATE '2001-08-01' AS bronze_load_date FROM orders""",
    "conform_customers": "SELECT * FROM v_customers",
    "conform_products": f"SELECT * REPLACE ({MONEY_PRODUCTS}) FROM v_products",
    "conform_transactions": f"SELECT * REPLACE ({MONEY_LINES}) FROM v_lines",
    "conform_crm": "SELECT * FROM v_crm",
    "conform_loyalty": "SELECT * FROM v_loyalty",
    "conform_web": "SELECT * FROM v_web",
    "conform_tickets": "SELECT * FROM v_tickets",
    "dedup_latest": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey,
          l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS place
        FROM lineitem) WHERE place = 1""",
    "dq_customers": "SELECT customer_id, data_quality_flag FROM v_customers",
    "dq_products": "SELECT product_id, data_quality_flag FROM v_products",
    "dq_transactions": "SELECT transaction_id, product_id, data_quality_flag FROM v_flagged",
    "dq_flag_distribution": """SELECT data_quality_flag, count(*) AS count, 'customers' AS source FROM v_customers GROUP BY 1
        UNION ALL SELECT data_quality_flag, count(*), 'products' FROM v_products GROUP BY 1""",
    "dq_duplicate_keys": """SELECT transaction_id, product_id, count(*) AS count FROM v_transactions_raw
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_report": """SELECT (SELECT count(*) FROM (SELECT customer_id FROM v_customers_raw GROUP BY 1 HAVING count(*) > 1)) AS duplicate_customer_ids,
        (SELECT count(*) FROM v_transactions_raw WHERE customer_id IS NULL) AS null_customer_ids,
        (SELECT min(transaction_date) FROM v_transactions_raw) AS earliest_transaction,
        (SELECT max(transaction_date) FROM v_transactions_raw) AS latest_transaction,
        (SELECT count(*) FROM v_products_raw WHERE price <= 0 OR price IS NULL) AS invalid_product_prices""",
    "transaction_summary": f"""SELECT count(*) AS total_transactions, sum(revenue)::DOUBLE AS total_revenue,
        {mean('revenue')} AS avg_transaction_value, count(DISTINCT customer_id) AS unique_customers FROM v_lines""",
    "partitioned_write": """SELECT transaction_year, transaction_month, count(*) AS records,
        sum(revenue)::DOUBLE AS revenue FROM v_lines GROUP BY 1, 2""",
    "overwrite_replace": """SELECT 2 AS version, product_category, count(*) AS records, sum(2 * revenue)::DOUBLE AS revenue
        FROM v_lines WHERE revenue > 50 GROUP BY 2
        UNION ALL SELECT 3, product_category, count(*), sum(4 * revenue)::DOUBLE
        FROM v_lines WHERE revenue > 50 AND product_category IS NOT NULL GROUP BY 2""",
    "catalog_schema": """SELECT transaction_year, count(*) AS records, sum(revenue)::DOUBLE AS amount,
        'transaction_month int, amount decimal(18,4), transaction_year int partition' AS columns FROM v_lines GROUP BY 1""",
    "layer_summary": " UNION ALL ".join(
        f"SELECT '{name}_silver' AS table_name, count(*) AS records, {width} AS columns FROM {view}"
        for name, view, width in (
            ("customers", "v_customers", 18),
            ("products", "v_products", 15),
            ("transactions", "v_lines", 27),
            ("crm_interactions", "v_crm", 15),
            ("loyalty_events", "v_loyalty", 12),
            ("web_analytics", "v_web", 21),
            ("support_tickets", "v_tickets", 16),
        )
    ),
    "transaction_metrics": "SELECT * FROM v_transaction_metrics",
    "loyalty_metrics": "SELECT * FROM v_loyalty_metrics",
    "crm_metrics": "SELECT * FROM v_crm_metrics",
    "web_metrics": "SELECT * FROM v_web_metrics",
    "ticket_metrics": "SELECT * FROM v_ticket_metrics",
    "customer_360": "SELECT * FROM v_360",
    "top_customers_sql": """SELECT customer_id, total_transactions, total_revenue AS total_spent, avg_transaction_value,
        current_loyalty_points AS loyalty_points, last_purchase_date AS last_interaction_date
        FROM v_360 ORDER BY total_spent DESC, customer_id LIMIT 10""",
    "health_distribution": """SELECT CASE WHEN customer_health_score >= 80 THEN 'Excellent'
        WHEN customer_health_score >= 60 THEN 'Good' WHEN customer_health_score >= 40 THEN 'Fair' ELSE 'Poor' END AS health_category,
        count(*) AS count FROM v_360 GROUP BY 1""",
    "churn_risk_distribution": "SELECT churn_risk_flag, count(*) AS count FROM v_360 GROUP BY 1",
    "rfm": "SELECT * FROM v_rfm",
    "rfm_cutpoints": "SELECT "
    + ", ".join(
        f"{short}[{i}]::DOUBLE AS {name}_q{i * 20}"
        for short, name in (("r", "recency_days"), ("f", "frequency"), ("m", "monetary_value"))
        for i in range(1, 5)
    )
    + " FROM v_cuts",
    "rfm_distribution": """SELECT rfm_segment, count(*) AS customer_count,
        sum(monetary_value::DECIMAL(28,4))::DOUBLE / count(*) AS avg_revenue FROM v_rfm GROUP BY 1""",
    "transaction_features": "SELECT * FROM v_transaction_features",
    "loyalty_features": "SELECT * FROM v_loyalty_features",
    "crm_features": "SELECT * FROM v_crm_features",
    "web_features": "SELECT * FROM v_web_features",
    "ticket_features": "SELECT * FROM v_ticket_features",
    "customer_features": "SELECT * FROM v_features",
    "feature_coverage": """SELECT count(*) AS total_customers,
        count(*) FILTER (WHERE total_transactions > 0) AS customers_with_purchases,
        count(*) FILTER (WHERE is_churned = 1) AS churned_customers,
        sum(total_revenue::DECIMAL(28,4))::DOUBLE / count(*) AS avg_customer_revenue,
        sum(customer_tenure_days)::DOUBLE / count(*) AS avg_tenure_days FROM v_features""",
    "churn_label_distribution": "SELECT is_churned, count(*) AS count FROM v_features GROUP BY 1",
    "clv_features": "SELECT * FROM v_clv",
    "clv_distribution": """SELECT clv_tier, count(*) AS customer_count, sum(predicted_clv_3yr::DECIMAL(28,6))::DOUBLE / count(*) AS avg_clv,
        sum(historical_revenue::DECIMAL(28,4))::DOUBLE AS total_revenue FROM v_clv GROUP BY 1""",
    "clv_training_set": """SELECT c.customer_id, historical_revenue::DOUBLE AS historical_revenue,
        avg_transaction_revenue, purchase_count::DOUBLE AS purchase_count, purchase_frequency_monthly,
        coalesce(avg_days_between_purchases, 0.0) AS avg_days_between_purchases,
        categories_purchased::DOUBLE AS categories_purchased, avg_items_per_transaction,
        recency_days::DOUBLE AS recency_days, customer_age_days::DOUBLE AS customer_age_days,
        f.customer_tenure_days::DOUBLE AS cf_customer_tenure_days, return_rate AS cf_return_rate,
        current_loyalty_points::DOUBLE AS cf_current_loyalty_points, web_conversion_rate AS cf_web_conversion_rate,
        predicted_clv_3yr AS label
        FROM v_clv c LEFT JOIN v_features f ON c.customer_id = f.customer_id
        WHERE predicted_clv_3yr > 0 AND predicted_clv_3yr < 100000""",
    "select_available": "SELECT customer_id, total_revenue, return_rate, is_churned FROM v_features",
    "split_by_hash": """SELECT customer_id, bucket, CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS part
        FROM (SELECT customer_id, (('0x' || substr(md5(customer_id), 1, 8))::UBIGINT % 100)::INTEGER AS bucket FROM v_customers)""",
    "zscore_features": "SELECT customer_id, "
    + ", ".join(
        f"round(CASE WHEN {c}_sd > 0 THEN ({c} - {c}_mean) / {c}_sd ELSE 0.0 END, 6) AS {c}" for c in SEGMENTATION
    )
    + " FROM v_numbers, (SELECT "
    + ", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_sd" for c in SEGMENTATION)
    + " FROM v_numbers)",
    "sales_daily": "SELECT * FROM v_daily",
    "sales_monthly": "SELECT * FROM v_monthly",
    "sales_by_category": "SELECT * FROM v_by_category",
    "sales_union": f"""SELECT * FROM v_daily
        UNION ALL SELECT make_date(year, month, 1), 'monthly', NULL, transaction_count, total_revenue, avg_transaction_value,
          unique_customers, NULL, NULL, NULL, NULL, month, quarter(make_date(year, month, 1))::INTEGER, year, NULL FROM v_monthly
        UNION ALL SELECT date, 'category', product_category, category_transaction_count, category_revenue,
          category_revenue / category_transaction_count, NULL, NULL, {CALENDAR} FROM v_by_category""",
    "recent_sales": """SELECT sum(total_revenue::DECIMAL(28,4))::DOUBLE AS revenue_last_30d,
        sum(total_revenue::DECIMAL(28,4))::DOUBLE / count(*) AS avg_daily_revenue,
        sum(transaction_count)::BIGINT AS total_transactions
        FROM (SELECT * FROM v_daily ORDER BY date DESC LIMIT 30)""",
    "product_performance": "SELECT * FROM v_performance",
    "top_products": """SELECT product_id, product_name, category, total_revenue, total_quantity_sold
        FROM v_performance ORDER BY total_revenue DESC, product_id LIMIT 10""",
    "product_status_overview": """SELECT product_status, count(*) AS product_count,
        sum(total_revenue::DECIMAL(28,4))::DOUBLE AS total_revenue FROM v_performance GROUP BY 1""",
    "nearest_center_assign": "SELECT * FROM v_assigned",
    "cluster_profiles": """SELECT cluster, count(*) AS customer_count, round(avg(total_transactions), 2) AS avg_transactions,
        round(avg(total_revenue), 2) AS avg_revenue, round(avg(days_since_last_purchase), 2) AS avg_recency,
        round(avg(return_rate), 4) AS avg_return_rate FROM v_assigned GROUP BY 1""",
    "segment_names": "SELECT customer_id, cluster, segment_name FROM v_named",
    "segment_profile": """SELECT segment_name, count(*) AS count,
        sum(total_revenue::DECIMAL(28,6))::DOUBLE / count(*) AS avg_revenue,
        sum(total_transactions::DECIMAL(28,6))::DOUBLE / count(*) AS avg_transactions,
        sum(days_since_last_purchase::DECIMAL(28,6))::DOUBLE / count(*) AS avg_recency
        FROM v_named GROUP BY 1""",
    "forecast_trend_dow": "SELECT * FROM v_all_forecast",
    "forecast_next_days": """SELECT f.* FROM v_all_forecast f JOIN v_all_span s ON f.series_id = s.series_id
        WHERE forecast_date > last AND forecast_date <= last + 7""",
    "forecast_metrics": f"SELECT series_id, {ERRORS} FROM v_all_fitted GROUP BY 1",
    "forecast_holdout": f"SELECT series_id, {ERRORS} FROM v_held_out GROUP BY 1",
    "forecast_by_category": "SELECT * FROM v_cat_forecast",
    "forecast_seasonal_by_category": """SELECT series_id, count(*) AS days, 30 AS future_days, true AS optimal
        FROM v_cat_history GROUP BY 1""",
    "forecast_smoothing": """SELECT series_id, date AS forecast_date, round(y, 4) AS predicted_revenue,
        round(y - margin, 4) AS lower_bound, round(y + margin, 4) AS upper_bound,
        'exponential_smoothing' AS model_type, true AS is_future FROM v_smooth_ahead""",
    "churn_training_set": """SELECT customer_id, days_since_last_purchase, total_transactions, total_revenue,
        avg_transaction_value, transactions_last_30d, transactions_last_60d, transactions_last_90d, revenue_last_30d,
        distinct_categories_purchased, return_count, return_rate, current_loyalty_points, loyalty_tier_numeric,
        total_crm_interactions, complaint_count, avg_crm_satisfaction, unresolved_issues, total_web_sessions,
        web_conversions, web_conversion_rate, abandoned_cart_count, total_support_tickets, high_priority_tickets,
        dissatisfied_ticket_count, purchase_frequency, customer_tenure_days, coalesce(recency_score, 0) AS recency_score,
        coalesce(frequency_score, 0) AS frequency_score, coalesce(monetary_score, 0) AS monetary_score,
        is_churned AS label FROM v_features""",
}
VIEWS["v_past_lines"] = "SELECT * FROM v_lines WHERE transaction_date::DATE <= DATE '2000-08-01'"
VIEWS["v_past_clv"] = clv_sql("v_past_lines", "DATE '2000-08-01'")
VIEWS["v_later"] = """SELECT customer_id, sum(revenue)::DOUBLE AS label FROM v_lines
  WHERE transaction_date::DATE > DATE '2000-08-01' GROUP BY 1"""
SELECTS["clv_future_set"] = """SELECT c.customer_id, historical_revenue, avg_transaction_revenue,
    purchase_count::DOUBLE AS purchase_count, purchase_frequency_monthly,
    coalesce(avg_days_between_purchases, 0.0) AS avg_days_between_purchases,
    categories_purchased::DOUBLE AS categories_purchased, avg_items_per_transaction,
    recency_days::DOUBLE AS recency_days, customer_age_days::DOUBLE AS customer_age_days, coalesce(label, 0.0) AS label
    FROM v_past_clv c LEFT JOIN v_later l ON c.customer_id = l.customer_id"""

# -- ingest from CSV ------------------------------------------------------------
_STAMPS = f"""NULL::VARCHAR AS undeclared_fields, '' AS rejected_fields, {LOADED} AS ingestion_timestamp,
  'part.csv' AS source_file, DATE '2001-08-01' AS bronze_load_date"""
for _source, _view, _leave, _cast in (
    ("customers", "v_customers_raw", "EXCLUDE (ingestion_timestamp)", ""),
    ("products", "v_products_raw", "EXCLUDE (ingestion_timestamp)", f"REPLACE ({MONEY_PRODUCTS})"),
    (
        "transactions",
        "v_transactions_raw",
        "EXCLUDE (ingestion_timestamp)",
        """REPLACE (unit_price::DOUBLE AS unit_price, discount_percent::DOUBLE AS discount_percent,
          total_amount::DOUBLE AS total_amount, shipping_cost::DOUBLE AS shipping_cost)""",
    ),
    ("crm_interactions", "v_crm_raw", "", ""),
    ("loyalty_events", "v_loyalty_raw", "", ""),
    ("web_analytics", "v_web_raw", "", ""),
    ("support_tickets", "v_tickets_raw", "", ""),
):
    SELECTS[f"ingest_{_source}"] = f"SELECT * {_leave} {_cast}, {_STAMPS} FROM {_view}"

# -- quarantine, layers, current values -------------------------------------------
SELECTS["quarantine_transactions"] = (
    "SELECT transaction_id, product_id, data_quality_flag FROM v_flagged WHERE data_quality_flag <> 'Valid'"
)
SELECTS["latest_loyalty"] = """SELECT customer_id, tier, points_balance FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_date DESC, event_id DESC) AS place
  FROM v_loyalty_raw) WHERE place = 1"""
SELECTS["never_purchased"] = """SELECT customer_id, churn_risk_flag, total_transactions = 0 AS never_purchased FROM v_360"""
SELECTS["layer_status"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS records, {width} AS columns, 'at path' AS status FROM {view}"
    for name, view, width in (
        ("customers_bronze", "v_customers_raw", 14),
        ("products_bronze", "v_products_raw", 11),
        ("customers_silver", "v_customers", 18),
        ("products_silver", "v_products", 15),
        ("transactions_silver", "v_lines", 27),
        ("customer_rfm_gold", "v_rfm", 9),
        ("sales_aggregated_gold", "v_daily", 15),
    )
) + " UNION ALL SELECT 'nothing_gold', NULL, NULL, 'missing'"
SELECTS["segment_profile_joined"] = SELECTS["segment_profile"]
SELECTS["segments_shape"] = """SELECT count(*) AS customers, count(DISTINCT customer_id) AS distinct_customers,
  true AS one_name_each, true AS within_k FROM v_features"""

# -- forecasts ------------------------------------------------------------------
SELECTS["forecast_next_days_seasonal"] = """SELECT series_id, (last + step::INTEGER)::DATE AS forecast_date,
  'seasonal_regression' AS model_type, true AS is_future
  FROM v_all_span, (SELECT unnest(generate_series(1, 7)) AS step)"""
SELECTS["forecast_seasonal_days"] = """SELECT series_id, false AS is_future, date_diff('day', min(date), max(date)) + 1 AS days,
    min(date) AS first, max(date) AS last FROM v_series GROUP BY 1
  UNION ALL SELECT series_id, true, 30, (max(date) + 1)::DATE, (max(date) + 30)::DATE FROM v_series GROUP BY 1"""
SELECTS["forecast_skipped"] = """SELECT product_id AS series_id, count(*) AS days FROM (
  SELECT product_id, transaction_date::DATE AS date FROM v_lines GROUP BY 1, 2 HAVING sum(revenue) IS NOT NULL)
  GROUP BY 1 HAVING count(*) < 28"""

# -- anomalies and metrics of fixed scores ------------------------------------------
SELECTS["isolation_flags"] = """SELECT count(*) AS customers, ceil((count(*) - 1) * 0.05)::BIGINT AS flagged FROM v_features"""
SELECTS["anomaly_flags"] = """SELECT customer_id, (score <= cut)::INTEGER AS is_anomaly, score AS anomaly_score
  FROM (SELECT customer_id, -total_revenue::DOUBLE AS score FROM v_features),
    (SELECT max(score) AS cut FROM (SELECT -total_revenue::DOUBLE AS score,
      row_number() OVER (ORDER BY -total_revenue::DOUBLE) AS place, count(*) OVER () AS n FROM v_features)
     WHERE place <= ceil((n - 1) * 0.05))"""


def _mean_depth(rows: int) -> float:
    """Of a search that fails, in a random binary tree."""
    if rows <= 2:
        return float(rows == 2)
    return 2 * (math.log(rows - 1) + 0.5772156649015329) - 2 * (rows - 1) / rows


def _tree_sql(tree: int, node: int = 0, depth: int = 0) -> str:
    """The depth at which a tree ends, as nested CASE."""
    names = ["total_transactions", "total_revenue", "avg_transaction_value", "return_rate", "days_since_last_purchase"]
    _, _, feature, threshold, left, right, size = next(n for n in FOREST if n[:2] == (tree, node))
    if feature < 0:
        return repr(depth + _mean_depth(size))
    value = f"coalesce({names[feature]}::DOUBLE, 0)"
    return f"CASE WHEN {value} <= {threshold} THEN {_tree_sql(tree, left, depth + 1)} ELSE {_tree_sql(tree, right, depth + 1)} END"


SELECTS["forest_scores"] = f"""SELECT customer_id,
  round(-pow(2, -(({_tree_sql(0)}) + ({_tree_sql(1)})) / 2 / {_mean_depth(100)!r}), 9) AS anomaly_score FROM v_features"""
VIEWS["v_linear"] = """SELECT is_churned AS label, (days_since_last_purchase - total_transactions)::DOUBLE AS score,
  (days_since_last_purchase - total_transactions > 60)::INTEGER AS prediction FROM v_features"""
VIEWS["v_cells"] = "SELECT label, prediction, count(*) AS count FROM v_linear GROUP BY 1, 2"
SELECTS["linear_confusion"] = "SELECT * FROM v_cells"
SELECTS["linear_metrics"] = """
SELECT 'linear' AS model, 'auc_roc' AS metric, round((sum(place) FILTER (WHERE label = 1)
    - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
    / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)), 9) AS value
  FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM v_linear)
UNION ALL SELECT 'linear', 'auc_pr', round(sum(pos * (above + below) / 2) / sum(pos), 9) FROM (
  SELECT pos, hits / seen AS above, CASE WHEN seen > pos + neg THEN (hits - pos) / (seen - pos - neg) ELSE hits / seen END AS below
  FROM (SELECT pos, neg, sum(pos) OVER w AS hits, sum(pos + neg) OVER w AS seen FROM (
    SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM v_linear GROUP BY score)
    WINDOW w AS (ORDER BY score DESC)))
UNION ALL SELECT 'linear', 'accuracy', round(avg((label = prediction)::INTEGER), 9) FROM v_linear
UNION ALL SELECT 'linear', 'f1', round(sum(share * 2 * hits / (actual + guessed)), 9) FROM (
  SELECT label, count(*) / (SELECT count(*) FROM v_linear)::DOUBLE AS share, count(*) AS actual,
    count(*) FILTER (WHERE label = prediction) AS hits,
    (SELECT count(*) FROM v_linear g WHERE g.prediction = l.label) AS guessed FROM v_linear l GROUP BY label)"""
SELECTS["linear_regression_metrics"] = """SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
  round(1 - avg(e * e) / var_pop(y), 6) AS r2
  FROM (SELECT predicted_clv_3yr::DOUBLE AS y, predicted_clv_3yr::DOUBLE - historical_revenue::DOUBLE * 0.5 AS e FROM v_clv)"""

_TRAIN = "(('0x' || substr(md5(customer_id), 1, 8))::UBIGINT % 100) < 80"
SELECTS["lloyd_step"] = f"""SELECT cluster, count(*) AS customers,
  round(avg(least({', '.join(_distance)})) + 1e-9, 6) AS squares, {', '.join(f'round(avg({c}) + 1e-9, 6) AS {c}' for c in SEGMENTATION)}
  FROM v_assigned GROUP BY cluster"""
SELECTS["segments_fixed_point"] = "SELECT count(*) AS customers, true AS all_centers_used, true AS fixed FROM v_numbers"
SELECTS["churn_lr_optimal"] = f"SELECT count(*) AS rows, true AS all_rows, true AS optimal FROM v_features WHERE {_TRAIN}"
SELECTS["clv_lr_optimal"] = f"""SELECT count(*) AS rows, true AS all_rows, true AS optimal FROM (
  {SELECTS['clv_training_set']}) WHERE {_TRAIN}"""
SELECTS["gbt_node_scores"] = f"SELECT count(*) AS customers, 0 AS differing FROM v_features WHERE NOT {_TRAIN}"
SELECTS["saved_model"] = f"""SELECT count(*) AS customers, 0 AS differing FROM (
  {SELECTS['clv_training_set']}) WHERE NOT {_TRAIN}"""
SELECTS["unique_customers"] = " UNION ALL ".join(
    f"""SELECT '{level}' AS level, date_trunc('{level}', transaction_date)::DATE AS date, count(DISTINCT customer_id) AS unique_customers
  FROM v_lines WHERE customer_id IS NOT NULL AND transaction_date IS NOT NULL GROUP BY 2"""
    for level in ("day", "month", "year")
)

ORACLE.update({name: statement(select) for name, select in SELECTS.items()})
