"""SQL counterpart of each registered query, over the driver's test tables.

Written in DuckDB's dialect and, where there is a choice, along another route
than the Spark version (window instead of telescoped sum, nested loop instead
of array, and so on), so that the two check each other.
"""

from __future__ import annotations

_FACT_ORDER = """
fact_order AS (
  SELECT *, CAST(gross_amount - discount_amount AS DECIMAL(12,2)) AS net_amount
  FROM (
    SELECT *, CAST(gross_amount * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS discount_amount
    FROM (
      SELECT
        l_discount,
        CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
        o_custkey AS user_id, l_partkey AS product_id, l_suppkey AS vendor_id,
        CASE WHEN l_discount <> 0 THEN CAST(round(l_discount * 100) AS BIGINT) END AS discount_id,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS time_id,
        CAST(l_quantity AS INTEGER) AS quantity,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount,
        CASE o_orderpriority
          WHEN '1-URGENT' THEN 'prepaid_card' WHEN '2-HIGH' THEN 'credit_card'
          WHEN '3-MEDIUM' THEN 'third_party' WHEN '4-NOT SPECIFIED' THEN 'unionpay'
          WHEN '5-LOW' THEN 'wire_transfer' END AS payment_method,
        CASE l_linenumber % 5
          WHEN 0 THEN 'web' WHEN 1 THEN 'mobile_app' WHEN 2 THEN 'mini_program'
          WHEN 3 THEN 'social_media' ELSE 'affiliate' END AS purchase_channel,
        CASE WHEN l_returnflag = 'R' THEN 'Returned'
          ELSE CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Shipped' WHEN 'P' THEN 'Pending' END
        END AS order_status,
        n_name AS province, c_mktsegment AS city,
        CAST(o_orderdate AS DATE) AS order_date
      FROM lineitem
      LEFT JOIN orders ON l_orderkey = o_orderkey
      LEFT JOIN customer ON o_custkey = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey)))"""

_DIM_USER = """
dim_user AS (
  SELECT
    c_custkey AS user_id, c_name AS user_name,
    CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'O' END AS gender,
    CAST(18 + c_custkey % 48 AS INTEGER) AS age,
    'user' || c_custkey || '@example.com' AS email,
    lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS phone,
    n_name AS province, c_mktsegment AS city,
    DATE '1995-01-01' - CAST(c_custkey * 37 % 700 AS INTEGER) AS registration_date,
    CAST(c_custkey % 6 AS INTEGER) AS vip_level,
    CAST(CAST(c_custkey * 13 % 70 AS DOUBLE) / 100 AS DECIMAL(5,4)) AS discount_sensitivity,
    CAST(CAST(c_custkey % 31 AS DOUBLE) / 100 AS DECIMAL(5,4)) AS return_rate,
    CAST(300 + floor((c_acctbal + 1000) / 20) AS INTEGER) AS credit_score,
    r_name AS country
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""

_DIM_PRODUCT = """
dim_product AS (
  SELECT
    p_partkey AS product_id, p_type || '>' || p_brand AS category, p_brand AS brand,
    CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_size AS stock,
    'A ' || p_name || ', by "' || p_brand || '"' AS description,
    split_part(p_name, ' ', 1) AS color, split_part(p_name, ' ', 2) AS size,
    (SELECT min(l_suppkey) FROM lineitem WHERE l_partkey = p_partkey) AS vendor_id
  FROM part)"""

_DIM_VENDOR = """
dim_vendor AS (
  SELECT *, CAST(cost_price * 1.15 AS DECIMAL(10,2)) AS market_price
  FROM (
    SELECT
      s_suppkey AS vendor_id, s_name AS vendor_name,
      CAST(500 + s_suppkey * 13 % 300 AS DECIMAL(10,2)) AS cost_price,
      CAST(1 + CAST(s_suppkey * 7 % 41 AS DOUBLE) / 10 AS DECIMAL(3,2)) AS vendor_rating,
      CAST(2.5 + CAST(s_suppkey % 26 AS DOUBLE) / 10 AS DECIMAL(3,2)) AS service_quality,
      CAST(1 + s_suppkey % 8 AS INTEGER) AS avg_delivery_time,
      CAST(CAST(s_suppkey % 20 AS DOUBLE) / 100 AS DECIMAL(5,4)) AS vendor_return_rate,
      CASE s_suppkey % 3 WHEN 0 THEN ['East'] WHEN 1 THEN ['East', 'South']
        ELSE ['East', 'South', 'North'] END AS distribution_areas,
      r_name AS country
    FROM supplier
    LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey))"""

_DIM_DISCOUNT = """
dim_discount AS (
  SELECT
    id AS discount_id, 'D_' || upper(kind) || '_' || id AS discount_name, kind AS discount_type,
    CAST(CASE id % 4 WHEN 0 THEN 0 WHEN 1 THEN 100 WHEN 2 THEN 200 ELSE 500 END AS DECIMAL(12,2)) AS threshold_amount,
    CASE WHEN id % 3 = 0 THEN CAST(CAST(id AS DOUBLE) / 100 AS DECIMAL(10,2))
      ELSE CAST(5 + 4 * id AS DECIMAL(10,2)) END AS discount_value,
    CAST(DATE '2024-01-01' + CAST(2 * id AS INTEGER) AS TIMESTAMP) AS valid_from,
    CAST(DATE '2024-01-01' + CAST(2 * id + 7 AS INTEGER) AS TIMESTAMP) AS valid_to
  FROM (
    SELECT range AS id, CASE range % 3 WHEN 0 THEN 'percentage' WHEN 1 THEN 'fixed' ELSE 'coupon' END AS kind
    FROM range(1, 11)))"""

_FACT_EVENT = """
fact_event AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id, user_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
    CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
    CASE event_type WHEN 'click' THEN 'cart_add' ELSE event_type END AS event_type,
    ts AS event_ts, CAST(ts AS DATE) AS event_date,
    CAST(1 + event_id % 5 AS INTEGER) AS quantity,
    CASE event_id % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'third_party'
      WHEN 2 THEN 'unionpay' ELSE 'prepaid_card' END AS payment_method,
    CASE event_id % 5 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile_app' WHEN 2 THEN 'mini_program'
      WHEN 3 THEN 'social_media' ELSE 'affiliate' END AS purchase_channel
  FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""

_COUPON_STRATEGY = """
coupon_strategy(strategy_id, min_discount_sensitivity, min_view_count, min_cart_count,
                trigger_type, action_type, coupon_id) AS (
  SELECT CAST(a AS BIGINT), CAST(b AS DECIMAL(5,2)), c, d, e, f, CAST(g AS BIGINT)
  FROM (VALUES
    (1, 0.10, 5, 5, 'view', 'popup', 1),
    (2, 0.30, 10, 10, 'cart_add', 'push', 2),
    (3, 0.50, 12, 12, 'cart_add', 'sms', 3)) t(a, b, c, d, e, f, g))"""


def _order_features(kind: str, profile: str) -> str:
    return f"""
user_orders AS (
  SELECT user_id, max(order_date) AS last_purchase_date, count(order_id) AS frequency,
    sum(net_amount) AS monetary,
    round(CAST(CAST(sum(discount_amount) AS DOUBLE) / count(discount_amount) AS DECIMAL(38,10)), 6) AS avg_discount,
    CAST(sum(CASE WHEN order_status = 'Returned' THEN 1 ELSE 0 END) AS DOUBLE) / count(order_id) AS return_rate_model,
    count(CASE WHEN payment_method = 'prepaid_card' THEN 1 END) AS prepaid_card_count
  FROM fact_order GROUP BY user_id),
user_joined AS (
  SELECT u.user_id, {profile}, last_purchase_date, frequency, monetary, avg_discount, return_rate_model,
    prepaid_card_count,
    CAST(date_diff('day', last_purchase_date, DATE '2001-08-02') AS INTEGER) AS recency,
    CAST(date_diff('day', registration_date, DATE '2001-08-02') AS INTEGER) AS user_tenure
  FROM user_orders o {kind} JOIN dim_user u ON o.user_id = u.user_id)"""


_FILLED = """
user_features AS (
  SELECT user_id, registration_date, credit_score, last_purchase_date,
    coalesce(frequency, 0) AS frequency,
    coalesce(CAST(monetary AS DOUBLE), 0) AS monetary,
    coalesce(CAST(avg_discount AS DOUBLE), 0) AS avg_discount,
    coalesce(return_rate_model, 0) AS return_rate_model,
    coalesce(prepaid_card_count, 0) AS prepaid_card_count,
    coalesce(recency, 999) AS recency, user_tenure
  FROM user_joined)"""
_LABELLED = """
user_labelled AS (
  SELECT *, CASE
    WHEN return_rate_model > 0.6 AND prepaid_card_count > 1 THEN CAST(1 AS DOUBLE)
    WHEN credit_score < 400 THEN CAST(1 AS DOUBLE)
    WHEN recency < 10 AND monetary > 5000 THEN CAST(1 AS DOUBLE)
    ELSE CAST(0 AS DOUBLE) END AS label
  FROM user_features)"""
_ALL_USERS = ", ".join(
    [
        _FACT_ORDER,
        _DIM_USER,
        _order_features("RIGHT", "registration_date, credit_score"),
        _FILLED,
        _LABELLED,
    ]
)

_MARGIN = """
margin AS (
  SELECT vendor_id,
    CAST(prices - cost_price * n AS DOUBLE) / nullif(CAST(cost_price * n AS DOUBLE), 0) AS avg_profit_margin
  FROM (
    SELECT p.vendor_id, v.cost_price, sum(unit_price) AS prices, CAST(count(unit_price) AS INTEGER) AS n
    FROM dim_product p JOIN dim_vendor v ON p.vendor_id = v.vendor_id GROUP BY 1, 2))"""
_VENDOR_FEATURES = """
vendor_stats AS (
  SELECT vendor_id, count(order_id) AS sales_volume, CAST(sum(net_amount) AS DOUBLE) AS sales_value,
    CAST(count(*) FILTER (order_status = 'Returned') AS DOUBLE) / count(order_id) AS order_return_rate
  FROM fact_order GROUP BY vendor_id),
vendor_feature AS (
  SELECT v.vendor_id, vendor_name,
    CAST(cost_price AS DOUBLE) AS cost_price, CAST(market_price AS DOUBLE) AS market_price,
    CAST(vendor_rating AS DOUBLE) AS vendor_rating, CAST(service_quality AS DOUBLE) AS service_quality,
    avg_delivery_time, CAST(vendor_return_rate AS DOUBLE) AS vendor_return_rate,
    array_to_string(distribution_areas, ',') AS distribution_areas, country,
    coalesce(avg_profit_margin, 0) AS avg_profit_margin, coalesce(sales_volume, 0) AS sales_volume,
    coalesce(sales_value, 0) AS sales_value, coalesce(order_return_rate, 0) AS order_return_rate
  FROM dim_vendor v LEFT JOIN margin m ON v.vendor_id = m.vendor_id
  LEFT JOIN vendor_stats s ON v.vendor_id = s.vendor_id),
vendor_label AS (
  SELECT vendor_id, vendor_name,
    vendor_rating * CAST(0.4 AS DOUBLE) + avg_profit_margin * CAST(0.3 AS DOUBLE)
      + (1 - order_return_rate) * CAST(0.2 AS DOUBLE)
      + (1 - CAST(avg_delivery_time AS DOUBLE) / 10) * CAST(0.1 AS DOUBLE) AS performance_label
  FROM vendor_feature)"""
_VENDORS = ", ".join([_FACT_ORDER, _DIM_PRODUCT, _DIM_VENDOR, _MARGIN, _VENDOR_FEATURES])

_BEST_DISCOUNT = """
candidate AS (
  SELECT p.event_id, d.discount_id,
    CASE WHEN d.discount_type = 'percentage' THEN p.gross_amount * d.discount_value
      ELSE CAST(d.discount_value AS DECIMAL(18,4)) END AS amount
  FROM purchase p JOIN dim_discount d
    ON d.valid_from <= p.event_ts AND d.valid_to >= p.event_ts AND d.threshold_amount <= p.gross_amount),
chosen AS (
  SELECT event_id, discount_id, amount
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY amount DESC, discount_id) AS rank FROM candidate)
  WHERE rank = 1)"""
_PURCHASE = """
purchase AS (
  SELECT event_id, event_ts, CAST(unit_price * quantity AS DECIMAL(12,2)) AS gross_amount
  FROM fact_event e JOIN dim_product p ON e.product_id = p.product_id WHERE event_type = 'purchase')"""
_STATUS = """CASE WHEN event_ts > TIMESTAMP '2024-01-28 12:00:00' THEN 'Pending'
    WHEN event_ts > TIMESTAMP '2024-01-27 12:00:00' THEN 'Processing'
    WHEN event_ts > TIMESTAMP '2024-01-25 12:00:00' THEN 'Shipped'
    WHEN event_ts > TIMESTAMP '2024-01-21 12:00:00' THEN 'Delivered'
    ELSE 'Completed' END"""
_DISCOUNT_CHOICE = f"""
WITH {_FACT_EVENT}, {_DIM_PRODUCT}, {_DIM_DISCOUNT}, {_PURCHASE}, {_BEST_DISCOUNT}
SELECT p.event_id, CAST(gross_amount AS DOUBLE) AS gross_amount, discount_id,
  CAST(round(coalesce(amount, 0), 2) AS DOUBLE) AS discount_amount
FROM purchase p LEFT JOIN chosen c ON p.event_id = c.event_id"""

_PROFILE = f"""
{_FACT_ORDER}, {_DIM_PRODUCT}, {_FACT_EVENT},
visit AS (
  SELECT user_id, session_id,
    min(CASE WHEN event_type = 'view' THEN date_trunc('second', event_ts) END) AS view_at,
    min(CASE WHEN event_type = 'cart_add' THEN date_trunc('second', event_ts) END) AS cart_at,
    min(CASE WHEN event_type = 'purchase' THEN date_trunc('second', event_ts) END) AS buy_at,
    count(*) FILTER (event_type = 'purchase') AS bought, count(*) AS n
  FROM fact_event GROUP BY 1, 2),
timing AS (
  SELECT user_id,
    avg(CASE WHEN cart_at > view_at THEN date_diff('second', view_at, cart_at) END) AS research,
    avg(CASE WHEN buy_at > cart_at THEN date_diff('second', cart_at, buy_at) END) AS decision,
    CAST(sum(bought) AS DOUBLE) / sum(n) AS intensity
  FROM visit GROUP BY user_id),
bought AS (
  SELECT user_id, purchase_channel, split_part(category, '>', 1) AS main_category
  FROM fact_order o LEFT JOIN dim_product p ON o.product_id = p.product_id),
favourite AS (
  SELECT user_id, main_category FROM (
    SELECT user_id, main_category,
      row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, main_category) AS rank
    FROM bought GROUP BY 1, 2)
  WHERE rank = 1),
channel AS (
  SELECT user_id, string_agg(purchase_channel, ',' ORDER BY purchase_channel) AS channels
  FROM (SELECT DISTINCT user_id, purchase_channel FROM bought) GROUP BY user_id),
social AS (
  SELECT user_id, CAST(count(*) FILTER (purchase_channel IN ('social_media', 'affiliate')) AS DOUBLE) / count(*) AS share
  FROM bought GROUP BY user_id),
profile AS (
  SELECT coalesce(t.user_id, s.user_id) AS user_id,
    CAST(round(CAST(research AS DECIMAL(38,10)), 0) AS INTEGER) AS avg_research_time,
    CAST(round(CAST(decision AS DECIMAL(38,10)), 0) AS INTEGER) AS decision_time,
    CAST(round(CAST(intensity AS DECIMAL(38,10)), 2) AS DOUBLE) AS purchase_intensity,
    main_category AS preferred_category, channels AS channel_preference,
    CAST(round(CAST(share AS DECIMAL(38,10)), 2) AS DOUBLE) AS social_influence_factor
  FROM timing t FULL JOIN social s ON t.user_id = s.user_id
  LEFT JOIN favourite f ON f.user_id = coalesce(t.user_id, s.user_id)
  LEFT JOIN channel c ON c.user_id = coalesce(t.user_id, s.user_id))"""

_COUPON_TARGETING = f"""
WITH {_DIM_USER}, {_FACT_EVENT}, {_COUPON_STRATEGY},
activity AS (
  SELECT user_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'cart_add') AS carts
  FROM fact_event GROUP BY user_id)
SELECT u.user_id, strategy_id, trigger_type, action_type, coupon_id
FROM dim_user u LEFT JOIN activity a ON u.user_id = a.user_id
JOIN coupon_strategy ON discount_sensitivity >= min_discount_sensitivity
  AND coalesce(views, 0) >= min_view_count AND coalesce(carts, 0) >= min_cart_count"""


def _null_count(table: str, column: str) -> str:
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS violations FROM {table} WHERE {column} IS NULL"


def _broken(table: str, column: str, rule: str, alias: str | None = None) -> str:
    name = alias or table
    return f"SELECT '{name}' AS table_name, '{column}' AS column_name, count(*) AS violations FROM {table} WHERE NOT ({rule})"


_AUDITED = f"WITH {_PROFILE}, {_COUPON_STRATEGY}, user_behavior_profile AS (SELECT * FROM profile)"
_NOT_NULL = {
    "fact_order": "order_id user_id product_id time_id vendor_id quantity gross_amount discount_amount "
    "net_amount payment_method purchase_channel",
    "user_behavior_profile": "user_id",
    "coupon_strategy": "strategy_id min_discount_sensitivity min_view_count min_cart_count trigger_type "
    "action_type coupon_id",
}
_CHECKS = [
    ("fact_order", "quantity", "quantity > 0"),
    ("fact_order", "gross_amount", "gross_amount > 0"),
    ("fact_order", "discount_amount", "discount_amount >= 0"),
    ("fact_order", "net_amount", "net_amount >= 0"),
    (
        "fact_order",
        "payment_method",
        "payment_method IN ('credit_card', 'third_party', 'prepaid_card', 'wire_transfer', 'unionpay')",
    ),
    ("fact_order", "purchase_channel", "purchase_channel IN ('web', 'mobile_app', 'mini_program')"),
    ("user_behavior_profile", "avg_research_time", "avg_research_time > 0"),
    ("user_behavior_profile", "decision_time", "decision_time > 0"),
    ("user_behavior_profile", "purchase_intensity", "purchase_intensity BETWEEN 0 AND 1"),
    ("user_behavior_profile", "social_influence_factor", "social_influence_factor BETWEEN 0 AND 1"),
    ("coupon_strategy", "min_discount_sensitivity", "min_discount_sensitivity BETWEEN 0 AND 1"),
    ("coupon_strategy", "min_view_count", "min_view_count >= 0"),
    ("coupon_strategy", "min_cart_count", "min_cart_count >= 0"),
    ("coupon_strategy", "trigger_type", "trigger_type IN ('view', 'cart_add')"),
    ("coupon_strategy", "action_type", "action_type IN ('popup', 'push', 'sms')"),
]

_CALENDAR = """
SELECT CAST(strftime(dt, '%Y%m%d') AS INTEGER) AS time_id, dt,
  CAST(year(dt) AS INTEGER) AS year, CAST(quarter(dt) AS INTEGER) AS quarter, CAST(month(dt) AS INTEGER) AS month,
  CAST(day(dt) AS INTEGER) AS day, CAST(0 AS INTEGER) AS hour, CAST(0 AS INTEGER) AS minute,
  CAST(isodow(dt) AS INTEGER) AS day_of_week, CAST(CASE WHEN isodow(dt) > 5 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
FROM (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS dt
  FROM orders SEMI JOIN lineitem ON l_orderkey = o_orderkey)"""

_GAPS = """
gap AS (
  SELECT user_id, order_date,
    date_diff('day', lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date), order_date) AS gap_days
  FROM (SELECT DISTINCT user_id, order_date FROM fact_order))"""


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["category_sales_share"] = f"""
WITH {_FACT_ORDER}, {_DIM_PRODUCT},
sales AS (
  SELECT split_part(category, '>', 1) AS main_category, sum(net_amount) AS total
  FROM fact_order o JOIN dim_product p ON o.product_id = p.product_id
  WHERE order_date BETWEEN DATE '1997-04-01' AND DATE '1997-06-30' GROUP BY 1)
SELECT main_category, CAST(total AS DOUBLE) AS total_sales,
  CAST(round(CAST(CAST(total * 100 AS DOUBLE) / CAST(sum(total) OVER () AS DOUBLE) AS DECIMAL(38,10)), 2) AS DOUBLE)
    AS sales_percentage
FROM sales"""
    sql["repurchase_cycle_days"] = f"""
WITH {_FACT_ORDER}, {_GAPS}
SELECT CAST(round(CAST(avg(gap_days) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_repurchase_cycle_days FROM gap"""
    sql["repurchase_gaps"] = f"""
WITH {_FACT_ORDER}, {_GAPS}
SELECT user_id, order_date, CAST(gap_days AS INTEGER) AS gap_days FROM gap WHERE gap_days IS NOT NULL"""
    sql["coupon_roi"] = f"""
WITH {_FACT_ORDER}, {_DIM_DISCOUNT},
used AS (
  SELECT discount_name, discount_type, count(order_id) AS orders_with_coupon,
    CAST(sum(net_amount) AS DOUBLE) AS sales, CAST(sum(discount_amount) AS DOUBLE) AS cost,
    CAST(sum(net_amount) - sum(discount_amount) AS DOUBLE) AS gain
  FROM fact_order o JOIN dim_discount d ON o.discount_id = d.discount_id
  GROUP BY discount_name, discount_type)
SELECT discount_name, discount_type, orders_with_coupon, sales AS sales_with_coupon, cost AS total_discount_cost,
  CAST(round(CAST(gain / nullif(cost, 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS coupon_roi
FROM used"""
    sql["vendor_value_top10"] = f"""
WITH {_FACT_ORDER}, {_DIM_VENDOR},
per_vendor AS (
  SELECT v.vendor_id, vendor_name, CAST(vendor_rating AS DOUBLE) AS vendor_rating,
    CAST(vendor_return_rate AS DOUBLE) AS vendor_return_rate,
    sum(quantity * cost_price) AS cost, sum(gross_amount) AS gross
  FROM fact_order o JOIN dim_vendor v ON o.vendor_id = v.vendor_id
  GROUP BY v.vendor_id, vendor_name, vendor_rating, vendor_return_rate)
SELECT vendor_id, vendor_name, vendor_rating, vendor_return_rate,
  CAST(cost AS DOUBLE) AS total_cost, CAST(gross AS DOUBLE) AS total_gross_sales,
  CAST(round(CAST(CAST(gross - cost AS DOUBLE) / nullif(CAST(cost AS DOUBLE), 0) * CAST(0.5 AS DOUBLE)
    + vendor_rating * CAST(0.3 AS DOUBLE) + (1 - vendor_return_rate) * CAST(0.2 AS DOUBLE) AS DECIMAL(38,10)), 4)
    AS DOUBLE) AS value_score
FROM per_vendor ORDER BY value_score DESC NULLS LAST, vendor_id LIMIT 10"""
    sql["warehouse_demand_top20"] = f"""
WITH {_FACT_ORDER}
SELECT province, city, count(order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  CAST(sum(net_amount) AS DOUBLE) AS total_sales
FROM fact_order WHERE order_date >= DATE '1997-01-01' GROUP BY province, city
ORDER BY total_orders DESC, total_sales DESC, province, city LIMIT 20"""
    sql["user_credit_rating"] = f"""
WITH {_FACT_ORDER}, {_DIM_USER},
metric AS (
  SELECT u.user_id, max(CASE WHEN order_status = 'Returned' THEN 1 ELSE 0 END) AS returned,
    sum(net_amount) AS spend, CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS aov,
    date_diff('day', registration_date, DATE '2001-08-01') AS tenure
  FROM dim_user u JOIN fact_order o ON u.user_id = o.user_id
  WHERE order_date > DATE '2001-08-01' - 90
  GROUP BY u.user_id, registration_date)
SELECT user_id, CASE WHEN returned = 1 THEN 'Low'
  WHEN spend > 5000 AND aov > 500 AND tenure > 180 THEN 'High'
  WHEN spend > 1000 AND tenure > 90 THEN 'Medium' ELSE 'Standard' END AS credit_rating
FROM metric"""
    sql["top_risk_users"] = f"""
WITH {_ALL_USERS}
SELECT user_id, label AS is_high_risk, label AS risk_score, DATE '2001-08-02' AS scoring_date
FROM user_labelled ORDER BY label DESC, user_id LIMIT 20"""
    sql["top_vendors_by_score"] = f"""
WITH {_VENDORS}
SELECT vendor_name, performance_label AS performance_score
FROM vendor_label ORDER BY performance_label DESC, vendor_id LIMIT 10"""
    sql["user_risk_features"] = f"""
WITH {_ALL_USERS}
SELECT user_id, registration_date, credit_score, last_purchase_date, frequency, monetary, avg_discount,
  return_rate_model, prepaid_card_count, recency, user_tenure
FROM user_labelled"""
    sql["user_risk_label"] = f"""
WITH {_ALL_USERS}
SELECT user_id, frequency, monetary, recency, avg_discount, return_rate_model, user_tenure, prepaid_card_count,
  credit_score, label
FROM user_labelled"""
    sql["user_risk_label_v1"] = f"""
WITH {_FACT_ORDER}, {_DIM_USER},
{_order_features('INNER', 'registration_date, vip_level, credit_score')}
SELECT user_id, last_purchase_date, frequency, CAST(monetary AS DOUBLE) AS monetary,
  CAST(avg_discount AS DOUBLE) AS avg_discount, return_rate_model, prepaid_card_count, registration_date,
  coalesce(vip_level, 0) AS vip_level, coalesce(credit_score, 0) AS credit_score, recency, user_tenure,
  CASE WHEN return_rate_model > 0.5 AND prepaid_card_count > 0 THEN CAST(1 AS DOUBLE)
    WHEN credit_score < 450 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
FROM user_joined"""
    sql["vendor_profit_margin"] = f"""
WITH {_DIM_PRODUCT}, {_DIM_VENDOR}, {_MARGIN} SELECT vendor_id, avg_profit_margin FROM margin"""
    sql["vendor_features"] = f"WITH {_VENDORS} SELECT * FROM vendor_feature"
    sql["vendor_performance_label"] = f"WITH {_VENDORS} SELECT * FROM vendor_label"
    sql["train_test_split"] = """
SELECT c_custkey AS user_id,
  CASE WHEN substr(md5(CAST(c_custkey AS VARCHAR)), 1, 2) < 'cd' THEN 1 ELSE 0 END AS is_train
FROM customer"""
    inputs = "frequency monetary recency avg_discount return_rate_model user_tenure prepaid_card_count".split()
    scaled = ", ".join(
        f"CAST(round(CAST(coalesce({c} / nullif((SELECT stddev_samp({c}) FROM model_input WHERE is_train), 0), 0) "
        f"AS DECIMAL(38,10)), 6) AS DOUBLE) AS {c}_scaled"
        for c in inputs
    )
    sql["user_risk_scaled_features"] = f"""
WITH {_ALL_USERS},
model_input AS (
  SELECT user_id, substr(md5(CAST(user_id AS VARCHAR)), 1, 2) < 'cd' AS is_train,
    {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in inputs)}
  FROM user_labelled)
SELECT user_id, {scaled} FROM model_input"""
    sql["build_dim_time"] = _CALENDAR
    sql["parquet_dim_time"] = _CALENDAR
    sql["vendor_rating"] = f"""
WITH {_DIM_VENDOR}
SELECT vendor_id, CAST(round(CAST(1 + 4 * (
    least(CASE WHEN cost_price > 0
      THEN (CAST(market_price AS DOUBLE) - CAST(cost_price AS DOUBLE)) / CAST(cost_price AS DOUBLE) ELSE 0 END, 1)
      * CAST(0.4 AS DOUBLE)
    + (1 - CAST(vendor_return_rate AS DOUBLE)) * CAST(0.3 AS DOUBLE)
    + CAST(service_quality AS DOUBLE) / 5 * CAST(0.2 AS DOUBLE)
    + (1 - CAST(avg_delivery_time AS DOUBLE) / 10) * CAST(0.1 AS DOUBLE)) AS DECIMAL(38,10)), 2) AS DOUBLE)
  AS vendor_rating
FROM dim_vendor"""
    sql["order_status_by_age"] = f"""
WITH {_FACT_EVENT}
SELECT event_id, {_STATUS} AS order_status FROM (SELECT event_id, event_type, date_trunc('second', event_ts) AS event_ts FROM fact_event)
WHERE event_type = 'purchase'"""
    sql["best_valid_discount"] = _DISCOUNT_CHOICE
    sql["best_valid_discount_by_day"] = _DISCOUNT_CHOICE
    sql["orders_from_events"] = f"""
WITH {_FACT_EVENT}, {_DIM_PRODUCT}, {_DIM_USER}, {_DIM_DISCOUNT},
purchase AS (
  SELECT e.*, vendor_id, province, city, CAST(unit_price * quantity AS DECIMAL(12,2)) AS gross_amount
  FROM fact_event e JOIN dim_product p ON e.product_id = p.product_id JOIN dim_user u ON e.user_id = u.user_id
  WHERE event_type = 'purchase'),
{_BEST_DISCOUNT}
SELECT sha256(p.event_id) AS order_id, user_id, product_id, discount_id,
  CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS time_id, vendor_id, quantity,
  CAST(gross_amount AS DOUBLE) AS gross_amount,
  CAST(round(coalesce(amount, 0), 2) AS DOUBLE) AS discount_amount,
  CAST(greatest(round(gross_amount - coalesce(amount, 0), 2), 0) AS DOUBLE) AS net_amount,
  payment_method, purchase_channel, {_STATUS.replace("event_ts", "date_trunc('second', event_ts)")} AS order_status,
  province, city, event_date AS order_date
FROM purchase p LEFT JOIN chosen c ON p.event_id = c.event_id"""
    sql["product_attributes"] = f"WITH {_DIM_PRODUCT} SELECT product_id, split_part(category, '>', 1) AS main_category, split_part(category, '>', -1) AS sub_category, color, size FROM dim_product"
    sql["vendor_areas"] = f"""
WITH {_DIM_VENDOR} SELECT vendor_id, unnest(distribution_areas) AS distribution_area FROM dim_vendor"""
    sql["session_funnel"] = f"""
WITH {_FACT_EVENT},
reached AS (
  SELECT session_id, max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS v,
    max(CASE WHEN event_type = 'cart_add' THEN 1 ELSE 0 END) AS c,
    max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p
  FROM fact_event GROUP BY session_id),
total AS (
  SELECT count(*) AS sessions, CAST(sum(v) AS BIGINT) AS view_sessions, CAST(sum(v * c) AS BIGINT) AS cart_sessions,
    CAST(sum(v * c * p) AS BIGINT) AS purchase_sessions
  FROM reached)
SELECT *,
  CAST(round(CAST(CAST(cart_sessions AS DOUBLE) / nullif(view_sessions, 0) AS DECIMAL(38,10)), 4) AS DOUBLE)
    AS view_to_cart_rate,
  CAST(round(CAST(CAST(purchase_sessions AS DOUBLE) / nullif(cart_sessions, 0) AS DECIMAL(38,10)), 4) AS DOUBLE)
    AS cart_to_purchase_rate,
  CAST(round(CAST(CAST(purchase_sessions AS DOUBLE) / nullif(view_sessions, 0) AS DECIMAL(38,10)), 4) AS DOUBLE)
    AS view_to_purchase_rate
FROM total"""
    sql["user_behavior_profile"] = f"WITH {_PROFILE} SELECT * FROM profile"
    sql["coupon_targeting"] = _COUPON_TARGETING
    sql["coupon_targeting_by_level"] = _COUPON_TARGETING
    sql["not_null_audit"] = f"{_AUDITED} " + " UNION ALL ".join(
        _null_count(table, column) for table, columns in _NOT_NULL.items() for column in columns.split()
    )
    sql["check_audit"] = f"{_AUDITED} " + " UNION ALL ".join(_broken(*check) for check in _CHECKS)
    sql["discount_rate"] = f"""
WITH {_FACT_ORDER}
SELECT order_id, product_id, CAST(gross_amount AS DOUBLE) AS gross_amount,
  CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(round(CAST(CAST(discount_amount AS DOUBLE) / nullif(CAST(gross_amount AS DOUBLE), 0) AS DECIMAL(38,10)), 4)
    AS DOUBLE) AS discount_rate
FROM fact_order"""
    sql["table_profile"] = f"""
WITH {_DIM_DISCOUNT}, {_FACT_EVENT}, calendar AS ({_CALENDAR})
SELECT 'dim_user' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'dim_product', count(*) FROM part
UNION ALL SELECT 'dim_vendor', count(*) FROM supplier
UNION ALL SELECT 'dim_discount', count(*) FROM dim_discount
UNION ALL SELECT 'fact_order', count(*) FROM lineitem
UNION ALL SELECT 'fact_event', count(*) FROM fact_event
UNION ALL SELECT 'dim_time', count(*) FROM calendar"""
    sql["user_preview"] = f"""
WITH {_DIM_USER} SELECT user_id, user_name, country FROM dim_user ORDER BY user_id LIMIT 5"""
    sql["csv_to_warehouse"] = f"""
WITH {_FACT_ORDER}
SELECT order_id, user_id, product_id, discount_id, time_id, vendor_id, quantity,
  CAST(gross_amount AS DOUBLE) AS gross_amount, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(net_amount AS DOUBLE) AS net_amount, payment_method, purchase_channel, order_status, province, city, order_date
FROM fact_order"""
    sql["csv_to_warehouse_user"] = f"""
WITH {_DIM_USER}
SELECT user_id, user_name, gender, age, email, phone, province, city, registration_date,
  strftime(registration_date + CAST(user_id % 30 AS INTEGER), '%Y-%m-%d') || ' 00:00:00' AS last_login, vip_level,
  CAST(discount_sensitivity AS DOUBLE) AS discount_sensitivity, CAST(return_rate AS DOUBLE) AS return_rate,
  credit_score, country
FROM dim_user"""
    sql["csv_to_warehouse_product"] = f"""
WITH {_DIM_PRODUCT}
SELECT product_id, category, brand, CAST(unit_price AS DOUBLE) AS unit_price, stock, description,
  '{{"color":"' || color || '","size":"' || size || '"}}' AS implicit_attributes, vendor_id
FROM dim_product"""
    sql["csv_to_warehouse_vendor"] = f"""
WITH {_DIM_VENDOR}
SELECT vendor_id, vendor_name, CAST(cost_price AS DOUBLE) AS cost_price, CAST(market_price AS DOUBLE) AS market_price,
  CAST(vendor_rating AS DOUBLE) AS vendor_rating, CAST(service_quality AS DOUBLE) AS service_quality,
  avg_delivery_time, CAST(vendor_return_rate AS DOUBLE) AS vendor_return_rate,
  array_to_string(distribution_areas, ',') AS distribution_areas, country
FROM dim_vendor"""
    sql["csv_to_warehouse_event"] = f"""
WITH {_FACT_EVENT}
SELECT event_id, user_id, product_id, session_id, event_type, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts,
  event_date
FROM fact_event"""
    sql["partition_replace"] = f"""
WITH {_DIM_USER}
SELECT country, CASE WHEN country = 'ASIA' THEN 9 ELSE vip_level END AS vip_level, count(*) AS users
FROM dim_user GROUP BY 1, 2"""
    sql["bucketed_join"] = f"""
WITH {_ALL_USERS} SELECT user_id, frequency, monetary, recency, user_tenure FROM user_labelled"""
    sql["bucketed_range_features"] = f"""
WITH {_FACT_ORDER}, {_DIM_USER}
SELECT u.user_id, count(order_id) AS frequency, CAST(sum(net_amount) AS DOUBLE) AS monetary,
  CAST(date_diff('day', max(order_date), DATE '1997-04-14') AS INTEGER) AS recency,
  CAST(date_diff('day', registration_date, DATE '1997-04-14') AS INTEGER) AS user_tenure
FROM fact_order o JOIN dim_user u ON o.user_id = u.user_id
WHERE order_date BETWEEN DATE '1997-04-08' AND DATE '1997-04-14' GROUP BY u.user_id, registration_date"""
    changed = """
changed AS (
  SELECT * REPLACE (CAST(CASE WHEN order_date IN (DATE '1997-04-09', DATE '1997-04-10', DATE '1997-06-03')
    THEN net_amount * 2 ELSE net_amount END AS DECIMAL(12,2)) AS net_amount)
  FROM fact_order WHERE order_date BETWEEN DATE '1997-04-01' AND DATE '1997-06-30')"""
    sql["daily_category_share"] = f"""
WITH {_FACT_ORDER}, {_DIM_PRODUCT}, {changed},
sales AS (
  SELECT split_part(category, '>', 1) AS main_category, sum(net_amount) AS total
  FROM changed o JOIN dim_product p ON o.product_id = p.product_id GROUP BY 1)
SELECT main_category, CAST(total AS DOUBLE) AS total_sales,
  CAST(round(CAST(CAST(total * 100 AS DOUBLE) / CAST(sum(total) OVER () AS DOUBLE) AS DECIMAL(38,10)), 2) AS DOUBLE)
    AS sales_percentage
FROM sales"""
    sql["daily_demand_top20"] = f"""
WITH {_FACT_ORDER}, {changed}
SELECT province, city, count(order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  CAST(sum(net_amount) AS DOUBLE) AS total_sales
FROM changed GROUP BY province, city
ORDER BY total_orders DESC, total_sales DESC, province, city LIMIT 20"""
    sql["stream_orders"] = sql["orders_from_events"]
    orphans = f"""
WITH {_FACT_EVENT},
lost AS (
  SELECT event_id, product_id, e.user_id,
    product_id IS NULL OR product_id NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 5 <> 0) AS no_product,
    e.user_id IS NULL OR e.user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0) AS no_user
  FROM fact_event e WHERE event_type = 'purchase'),
named AS (
  SELECT CASE WHEN no_product AND no_user THEN 'product and user' WHEN no_product THEN 'product'
    WHEN no_user THEN 'user' ELSE 'kept' END AS reason, event_id, product_id, user_id FROM lost)"""
    sql["purchase_orphans"] = f"{orphans} SELECT * FROM named WHERE reason <> 'kept'"
    sql["purchase_orphan_counts"] = f"{orphans} SELECT reason, count(*) AS purchases FROM named GROUP BY reason"
    sql["stream_event_counts"] = """
SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS events FROM events
WHERE CAST(ts AS DATE) + 1 <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
GROUP BY 1, 2"""
    sql["csv_to_warehouse_discount"] = f"""
WITH {_DIM_DISCOUNT}
SELECT discount_id, discount_name, discount_type, CAST(threshold_amount AS DOUBLE) AS threshold_amount,
  CAST(discount_value AS DOUBLE) AS discount_value, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
  strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to
FROM dim_discount"""
    sql["csv_to_warehouse_time"] = _CALENDAR
    sql["csv_reload"] = f"""
WITH {_DIM_USER} SELECT user_id, CAST(7 AS INTEGER) AS vip_level, country FROM dim_user WHERE country <> 'ASIA'"""
    sql["csv_column_order"] = sql["csv_to_warehouse_product"]
    sql["csv_line_breaks"] = f"""
WITH {_DIM_PRODUCT}
SELECT product_id, 'first line|"second", ' || brand || '|' AS description, vendor_id FROM dim_product"""
    sql["csv_lists"] = """
SELECT s_suppkey AS vendor_id, CASE s_suppkey % 4 WHEN 0 THEN '[]' WHEN 2 THEN '["d''Or","b"]'
  WHEN 3 THEN '["a",null]' END AS areas
FROM supplier"""
    sql["csv_rejects"] = """
SELECT 'stock' AS column_name, count(*) AS rejected FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'unit_price', count(*) FROM part WHERE p_partkey % 5 = 0"""
    sql["partition_load"] = f"""
WITH {_DIM_USER}
SELECT country, CASE WHEN country = 'ASIA' THEN 8 ELSE vip_level END AS vip_level, count(*) AS users
FROM dim_user WHERE country <> 'EUROPE' GROUP BY 1, 2"""
    sql["partition_load_names"] = f"""
WITH {_DIM_USER}
SELECT CASE country WHEN 'ASIA' THEN 'A/B' WHEN 'AFRICA' THEN 'c:d' WHEN 'AMERICA' THEN 'a=b' ELSE country END AS country,
  CAST(CASE country WHEN 'ASIA' THEN 20 WHEN 'AFRICA' THEN 21 WHEN 'AMERICA' THEN 22 ELSE vip_level END AS INTEGER) AS vip_level,
  count(*) AS users
FROM dim_user WHERE country <> 'EUROPE' GROUP BY 1, 2"""
    sql["ledger_load"] = f"""
WITH {_DIM_USER}
SELECT country, CASE WHEN country = 'ASIA' THEN 8 ELSE vip_level END AS vip_level, count(*) AS users,
  CAST(2 AS BIGINT) AS loads
FROM dim_user GROUP BY 1, 2"""
    sql["score_writeback_rule"] = f"""
WITH {_ALL_USERS}
SELECT user_id, label AS is_high_risk, label AS risk_score, DATE '2001-08-02' AS scoring_date FROM user_labelled"""
    sql["score_writeback_vendor_rule"] = f"""
WITH {_VENDORS}
SELECT vendor_id, vendor_name, performance_label AS performance_score, DATE '2001-08-02' AS scoring_date
FROM vendor_label"""
    # The rank sum gives the same area as the curve: ties count one half.
    sql["user_credit_auc"] = f"""
WITH {_ALL_USERS},
test AS (
  SELECT label, -credit_score AS score FROM user_labelled
  WHERE substr(md5(CAST(user_id AS VARCHAR)), 1, 2) >= 'cd'),
ranked AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS r FROM test),
total AS (SELECT count(*) AS n, sum(label) AS bad, sum(r) FILTER (label = 1) AS ranks FROM ranked)
SELECT CAST(round(CAST((ranks - bad * (bad + 1) / 2) / (bad * (n - bad)) AS DECIMAL(38,10)), 6) AS DOUBLE) AS value,
  n AS test_rows
FROM total"""
    sql["user_credit_rank_auc"] = sql["user_credit_auc"]
    sql["product_attribute_leaves"] = f"""
WITH {_DIM_PRODUCT}
SELECT product_id, 'color' AS path, color AS value FROM dim_product
UNION ALL SELECT product_id, 'size', size FROM dim_product"""
    sql["stream_running_scores"] = f"""
WITH {_FACT_EVENT}, {_DIM_PRODUCT}, {_DIM_USER},
sums AS (
  SELECT e.user_id, count(*) AS frequency, sum(CAST(unit_price * quantity AS DECIMAL(12,2))) AS monetary,
    date_diff('day', max(event_date), DATE '2024-02-05') AS recency,
    count(*) FILTER (payment_method = 'prepaid_card') AS prepaid
  FROM fact_event e JOIN dim_product p ON e.product_id = p.product_id
  WHERE event_type = 'purchase' GROUP BY e.user_id)
SELECT user_id, CAST(CASE WHEN frequency > 3 AND prepaid > 1 THEN 1 WHEN monetary > 5000 THEN 0.75
  WHEN recency < 10 THEN 0.5 ELSE 0.25 END AS DOUBLE) AS risk_score, CAST(1 AS INTEGER) AS model
FROM sums SEMI JOIN dim_user USING (user_id)"""
    sql["stream_session_funnel"] = sql["session_funnel"].replace(
        "GROUP BY session_id)",
        """GROUP BY session_id
  HAVING max(event_ts) + INTERVAL 1 DAY <= (SELECT max(event_ts) - INTERVAL 1 HOUR FROM fact_event))""",
    )
    sql["vendor_rating_rmse"] = f"""
WITH {_VENDORS},
test AS (
  SELECT performance_label - CAST(service_quality AS DOUBLE) / 5 AS e
  FROM vendor_label JOIN vendor_feature USING (vendor_id)
  WHERE substr(md5(CAST(vendor_id AS VARCHAR)), 1, 2) >= 'cd')
SELECT CAST(round(CAST(sqrt(avg(e * e)) AS DECIMAL(38,10)), 6) AS DOUBLE) AS value, count(*) AS test_rows FROM test"""
    sql["user_risk_scores_checked"] = """
SELECT c_custkey AS user_id, DATE '2001-08-02' AS scoring_date, true AS in_range, true AS flag_agrees FROM customer"""
    sql["vendor_performance_scores_checked"] = """
SELECT s_suppkey AS vendor_id, s_name AS vendor_name, DATE '2001-08-02' AS scoring_date, true AS in_range FROM supplier"""
    sql["user_risk_small_forest"] = f"""
WITH {_ALL_USERS}
SELECT user_id,
  CAST(0.5 * CASE WHEN frequency <= 4 THEN CASE WHEN recency <= 999 THEN 0.25 ELSE 0 END
    WHEN prepaid_card_count <= 0 THEN 0.5 ELSE 1 END
  + 0.25 * CASE WHEN CAST(monetary AS DOUBLE) * CAST(0.001 AS DOUBLE) <= 50 THEN 0.125 ELSE 0.75 END
  + 0.25 * CASE WHEN coalesce(user_tenure, 0) > 2500 THEN 0 WHEN return_rate_model <= 0.25 THEN 0.5 ELSE 1 END
  AS DOUBLE) AS risk_score
FROM user_labelled"""
    sql["user_risk_scores_exported"] = "SELECT c_custkey AS user_id, true AS same_score FROM customer"
    sql["vendor_performance_scores_exported"] = "SELECT s_suppkey AS vendor_id, true AS same_score FROM supplier"
    sql["stream_risk_alerts"] = f"""
WITH {_ALL_USERS}, {_FACT_EVENT}
SELECT sha256(event_id) AS alert_id, event_id, e.user_id,
  strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts, label AS risk_score
FROM fact_event e JOIN user_labelled l ON e.user_id = l.user_id
WHERE event_type = 'purchase' AND label >= 0.5"""
    return sql
