"""Independent DuckDB oracle for every registered query.

The adapter rules (driver tables -> bronze strings) and the staging tables are
written a second time in DuckDB SQL.  Core and gold results are worked out from four wide
base tables (place, ord, line, review) that are built straight from the driver tables by key arithmetic,
compared with statements that share neither code nor intermediate models with it.

Dialect notes: Spark's `round(double, n)` rounds the shortest decimal text of
the double half-up; `R()` reproduces that.  DuckDB's `dayofweek` is 0-based,
`date_diff` takes (part, start, end), and integer results are cast to the
Spark types (int / bigint) explicitly.
"""

from __future__ import annotations


def R(x: str, n: int) -> str:
    """Spark `round(double, n)`."""
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,15)), {n}) AS DOUBLE)"


def RE(x: str, n: int) -> str:
    """Spark `bround(double, n)` (half-even on the shortest decimal text)."""
    return f"CAST(ROUND_EVEN(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,15)), {n}) AS DOUBLE)"


def RD(x: str, n: int) -> str:
    """Round an exact decimal, return double."""
    return f"CAST(ROUND(({x}), {n}) AS DOUBLE)"


def M(x: str) -> str:
    return f"CAST(({x}) AS DECIMAL(28,6))"


def DD(end: str, start: str) -> str:
    """Spark datediff(end, start) in days, as int."""
    return f"CAST(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE)) AS INTEGER)"


def PLUS(ts: str, days: str) -> str:
    return f"({ts} + to_days(CAST({days} AS INTEGER)))"


STATE = "['SP', 'RJ', 'MG', 'RS', 'BA', 'PR', 'SC', 'PE'][CAST({n} % 8 + 1 AS INTEGER)]"

CTES: list[tuple[str, str]] = []


def cte(name: str, sql: str) -> None:
    CTES.append((name, sql))


# ----------------------------------------------------------------------------- bronze (adapter)
cte("o_src", """
SELECT o.*, o_orderkey AS k,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
       WHEN 'P' THEN CASE WHEN o_orderkey % 10 = 0 THEN 'canceled' ELSE 'delivered' END
       ELSE 'unavailable' END AS st
FROM orders o""")

cte("b_orders", f"""
SELECT CAST(k AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, st AS order_status,
  CAST(o_orderdate AS VARCHAR) AS order_purchase_timestamp,
  CAST({PLUS('o_orderdate', 'k % 2')} AS VARCHAR) AS order_approved_at,
  CASE WHEN st <> 'canceled' THEN CAST({PLUS('o_orderdate', '1 + k % 3')} AS VARCHAR) END AS order_delivered_carrier_date,
  CASE WHEN st = 'delivered' THEN CAST({PLUS('o_orderdate', '(k * 7) % 41')} AS VARCHAR) END AS order_delivered_customer_date,
  CAST({PLUS('o_orderdate', '15 + k % 13')} AS VARCHAR) AS order_estimated_delivery_date
FROM o_src""")

cte("b_order_items", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
  CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
  CAST(l_shipdate AS VARCHAR) AS shipping_limit_date,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS VARCHAR) AS freight_value
FROM lineitem""")

cte("b_customers", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey - c_custkey % 2 AS VARCHAR) AS customer_unique_id,
  lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix, c_mktsegment AS customer_city,
  {STATE.format(n='c_nationkey')} AS customer_state
FROM customer""")

cte("b_sellers", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
  s_name AS seller_city, {STATE.format(n='s_nationkey')} AS seller_state
FROM supplier""")

cte("b_geolocation", f"""
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
  CAST(-33.5 + 1.7 * n_nationkey + 0.01 * (j % 2) AS VARCHAR) AS geolocation_lat,
  CAST(-73.0 + 1.5 * n_nationkey + 0.01 * (j % 2) AS VARCHAR) AS geolocation_lng,
  n_name || '-' || CAST(j AS VARCHAR) AS geolocation_city,
  {STATE.format(n='n_nationkey')} AS geolocation_state
FROM nation, (VALUES (0), (1), (2)) AS t(j)""")

cte("b_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE WHEN p_size % 10 <> 0 THEN p_type END AS product_category_name,
  CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
  CAST(p_size * 10 AS VARCHAR) AS product_description_lenght,
  CAST(1 + p_size % 5 AS VARCHAR) AS product_photos_qty,
  CAST(p_size * 100 AS VARCHAR) AS product_weight_g,
  CAST(p_size AS VARCHAR) AS product_length_cm,
  CAST(1 + p_size % 7 AS VARCHAR) AS product_height_cm,
  CAST(2 + p_size % 11 AS VARCHAR) AS product_width_cm
FROM part""")

cte("b_category_translation", """
SELECT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM part WHERE NOT starts_with(p_type, 'PROMO')""")

cte("b_order_payments", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(seq AS VARCHAR) AS payment_sequential,
  CASE WHEN seq = 2 THEN 'voucher' ELSE CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto'
       WHEN 2 THEN 'voucher' ELSE 'debit_card' END END AS payment_type,
  CAST(CASE WHEN seq = 2 THEN 1 ELSE 1 + o_orderkey % 10 END AS VARCHAR) AS payment_installments,
  CAST(CAST(CASE WHEN seq = 2 THEN 10.00
       ELSE CAST(o_totalprice AS DECIMAL(18,2)) - CASE WHEN o_orderkey % 7 = 0 THEN 10.00 ELSE 0.00 END END
       AS DECIMAL(18,2)) AS VARCHAR) AS payment_value
FROM orders, (VALUES (1), (2)) AS s(seq)
WHERE seq = 1 OR o_orderkey % 7 = 0""")

cte("b_order_reviews", f"""
SELECT 'rev-' || CAST(k AS VARCHAR) AS review_id, CAST(k AS VARCHAR) AS order_id,
  CASE WHEN k % 97 = 0 THEN 'n/a' ELSE CAST(1 + (k % 16) % 5 AS VARCHAR) END AS review_score,
  CASE WHEN k % 5 = 0 THEN 'Recomendo' END AS review_comment_title,
  CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN 'Entrega com ATRASO' WHEN 3 THEN 'produto quebrado'
       WHEN 4 THEN 'muito ruim' WHEN 5 THEN 'Late delivery and broken' ELSE d.text END AS review_comment_message,
  CAST({PLUS('o_orderdate', '30')} AS VARCHAR) AS review_creation_date,
  CASE WHEN k % 89 = 0 THEN 'not a date'
       WHEN k % 11 <> 0 THEN CAST({PLUS('o_orderdate', '30 + k % 9')} AS VARCHAR) END AS review_answer_timestamp
FROM o_src LEFT JOIN documents d ON k % 8 >= 6
  AND d.doc_id = (2 * (k // 8) + (k % 8 - 6)) % (SELECT max(doc_id) + 1 FROM documents)
UNION ALL
SELECT 'rev-' || CAST(k AS VARCHAR), CAST(k AS VARCHAR), CAST(1 + ((k + 1) % 16) % 5 AS VARCHAR), NULL,
  'avaliacao anterior', CAST({PLUS('o_orderdate', '29')} AS VARCHAR), CAST({PLUS('o_orderdate', '29')} AS VARCHAR)
FROM o_src WHERE k % 30 = 1""")

# ----------------------------------------------------------------------------- staging
cte("stg_customers", """
SELECT customer_id AS customer_key, customer_unique_id, CAST(customer_zip_code_prefix AS VARCHAR) AS zip_code_prefix,
  customer_city AS city, customer_state AS state FROM b_customers""")

cte("stg_geolocation", """
SELECT DISTINCT ON (zip_code_prefix) * FROM (
  SELECT CAST(geolocation_zip_code_prefix AS VARCHAR) AS zip_code_prefix,
    CAST(geolocation_lat AS DOUBLE) AS latitude, CAST(geolocation_lng AS DOUBLE) AS longitude,
    geolocation_city AS city, geolocation_state AS state
  FROM b_geolocation
  WHERE CAST(geolocation_lat AS DOUBLE) BETWEEN -34.0 AND 6.0
    AND CAST(geolocation_lng AS DOUBLE) BETWEEN -74.0 AND -34.0)
ORDER BY zip_code_prefix, latitude ASC NULLS LAST, longitude ASC NULLS LAST, city ASC NULLS LAST, state ASC NULLS LAST""")

cte("stg_order_items", """
SELECT order_id AS order_key, CAST(order_item_id AS INTEGER) AS order_item_id, product_id AS product_key,
  seller_id AS seller_key, CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_timestamp,
  CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
FROM b_order_items""")

cte("stg_order_payments", """
SELECT order_id AS order_key, CAST(payment_sequential AS INTEGER) AS payment_sequential, payment_type,
  CAST(payment_installments AS INTEGER) AS payment_installments, CAST(payment_value AS DOUBLE) AS payment_value
FROM b_order_payments""")

cte("stg_order_reviews", """
SELECT DISTINCT ON (review_key) * FROM (
  SELECT review_id AS review_key, order_id AS order_key, TRY_CAST(review_score AS INTEGER) AS review_score,
    review_comment_title AS comment_title, review_comment_message AS comment_message,
    TRY_CAST(review_creation_date AS TIMESTAMP) AS creation_timestamp,
    TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS answer_timestamp
  FROM b_order_reviews)
ORDER BY review_key, coalesce(answer_timestamp, creation_timestamp) DESC NULLS LAST,
  order_key ASC NULLS LAST, review_score ASC NULLS LAST, comment_title ASC NULLS LAST,
  comment_message ASC NULLS LAST, creation_timestamp ASC NULLS LAST, answer_timestamp ASC NULLS LAST""")

cte("stg_orders", """
SELECT order_id AS order_key, customer_id AS customer_key, order_status,
  CAST(order_purchase_timestamp AS TIMESTAMP) AS purchase_timestamp,
  CAST(order_approved_at AS TIMESTAMP) AS approved_at_timestamp,
  CAST(order_delivered_carrier_date AS TIMESTAMP) AS delivered_carrier_timestamp,
  CAST(order_delivered_customer_date AS TIMESTAMP) AS delivered_customer_timestamp,
  CAST(order_estimated_delivery_date AS TIMESTAMP) AS estimated_delivery_timestamp
FROM b_orders""")

cte("stg_category_translation", """
SELECT DISTINCT ON (category_name_portuguese) * FROM (SELECT product_category_name AS category_name_portuguese,
  product_category_name_english AS category_name_english FROM b_category_translation)
ORDER BY category_name_portuguese, category_name_english ASC NULLS LAST""")

cte("stg_products", """
SELECT product_id AS product_key, product_category_name AS category_name_portuguese,
  CAST(product_name_lenght AS INTEGER) AS name_char_length,
  CAST(product_description_lenght AS INTEGER) AS description_char_length,
  CAST(product_photos_qty AS INTEGER) AS photo_count,
  CAST(product_weight_g AS DOUBLE) AS weight_grams, CAST(product_length_cm AS DOUBLE) AS length_cm,
  CAST(product_height_cm AS DOUBLE) AS height_cm, CAST(product_width_cm AS DOUBLE) AS width_cm
FROM b_products""")

cte("stg_sellers", """
SELECT DISTINCT ON (seller_key) * FROM (SELECT seller_id AS seller_key, CAST(seller_zip_code_prefix AS VARCHAR) AS zip_code_prefix,
  seller_city AS city, seller_state AS state FROM b_sellers)
ORDER BY seller_key, zip_code_prefix ASC NULLS LAST, city ASC NULLS LAST, state ASC NULLS LAST""")

# ----------------------------------------------------------------------------- wide base tables
# Four tables straight from the driver tables, with numbers as keys; every core and gold
# statement below reads these and not the models before it.
cte("place", """
SELECT CAST(zip_code_prefix AS INTEGER) AS nation, latitude AS lat, longitude AS lon FROM stg_geolocation""")

cte("ord", f"""
SELECT k, o_custkey AS buyer_no, st, CAST(o_orderdate AS TIMESTAMP) AS bought, CAST(o_orderdate AS DATE) AS day,
  {PLUS('o_orderdate', 'k % 2')} AS approved,
  CASE WHEN st <> 'canceled' THEN {PLUS('o_orderdate', '1 + k % 3')} END AS handed,
  CASE WHEN st = 'delivered' THEN {PLUS('o_orderdate', '(k * 7) % 41')} END AS arrived,
  {PLUS('o_orderdate', '15 + k % 13')} AS due,
  CASE WHEN st = 'delivered' THEN CAST((k * 7) % 41 AS INTEGER) END AS transit,
  c_custkey - c_custkey % 2 AS person, c_mktsegment AS city, c_nationkey AS nation, {STATE.format(n='c_nationkey')} AS state
FROM o_src LEFT JOIN customer ON c_custkey = o_custkey""")

cte("line", f"""
SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS part_no, l_suppkey AS seller_no,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS freight,
  CAST(l_shipdate AS TIMESTAMP) AS ship_by,
  CASE WHEN p_size % 10 = 0 THEN 'Uncategorized' WHEN starts_with(p_type, 'PROMO') THEN p_type ELSE lower(p_type) END AS category,
  s_name AS seller_city, s_nationkey AS seller_nation, {STATE.format(n='s_nationkey')} AS seller_state,
  ord.* EXCLUDE (k)
FROM lineitem JOIN ord ON ord.k = l_orderkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""")

cte("basket", """
SELECT k, count(*) AS lines, count(DISTINCT seller_no) AS sellers, sum(price) AS price, sum(freight) AS freight
FROM line GROUP BY k""")

cte("review", f"""
SELECT review_key, CAST(order_key AS BIGINT) AS k, review_score AS score, comment_title, comment_message,
  creation_timestamp AS asked, answer_timestamp AS answered,
  {DD('answer_timestamp', 'creation_timestamp')} AS delay
FROM stg_order_reviews""")

# ----------------------------------------------------------------------------- core
cte("dim_customers", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_key, CAST(c_custkey - c_custkey % 2 AS VARCHAR) AS customer_unique_id,
  lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code_prefix, c_mktsegment AS city, {STATE.format(n='c_nationkey')} AS state,
  (SELECT lat FROM place WHERE nation = c_nationkey) AS latitude, (SELECT lon FROM place WHERE nation = c_nationkey) AS longitude
FROM customer""")

cte("dim_sellers", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS seller_key, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip_code_prefix,
  s_name AS city, {STATE.format(n='s_nationkey')} AS state,
  (SELECT lat FROM place WHERE nation = s_nationkey) AS latitude, (SELECT lon FROM place WHERE nation = s_nationkey) AS longitude
FROM supplier""")

cte("dim_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_key,
  CASE WHEN p_size % 10 = 0 THEN 'Uncategorized' WHEN starts_with(p_type, 'PROMO') THEN p_type ELSE lower(p_type) END AS category_name,
  CASE WHEN p_size % 10 <> 0 THEN p_type END AS category_name_portuguese,
  CAST(length(p_name) AS INTEGER) AS name_char_length, CAST(p_size * 10 AS INTEGER) AS description_char_length,
  CAST(1 + p_size % 5 AS INTEGER) AS photo_count, CAST(p_size * 100 AS DOUBLE) AS weight_grams,
  CAST(p_size AS DOUBLE) AS length_cm, CAST(1 + p_size % 7 AS DOUBLE) AS height_cm, CAST(2 + p_size % 11 AS DOUBLE) AS width_cm
FROM part""")


def _calendar(first: str, last: str) -> str:
    """One row a day; names and numbers are read off the formatted date."""
    return f"""
SELECT CAST(t AS DATE) AS date_key, CAST(strftime(t, '%Y') AS INTEGER) AS calendar_year,
  CAST(strftime(t, '%m') AS INTEGER) AS calendar_month, strftime(t, '%B') AS month_name,
  CAST(ceil(month(t) / 3.0) AS INTEGER) AS calendar_quarter,
  format('Q{{}}-{{}}', CAST(ceil(month(t) / 3.0) AS INTEGER), year(t)) AS quarter_year,
  CAST(strftime(t, '%w') AS INTEGER) + 1 AS day_of_week, strftime(t, '%A') AS day_name,
  strftime(t, '%A') IN ('Saturday', 'Sunday') AS is_weekend
FROM (SELECT unnest(range({first}, {last} + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS t)"""


cte("dim_dates", _calendar("(SELECT CAST(make_date(CAST(year(least(min(bought), min(due))) AS INTEGER), 1, 1) AS TIMESTAMP) FROM ord)",
                           "(SELECT CAST(make_date(CAST(year(greatest(max(bought), max(due))) AS INTEGER), 12, 31) AS TIMESTAMP) FROM ord)"))

cte("fct_order_items", """
SELECT CAST(k AS VARCHAR) AS order_key, CAST(n AS INTEGER) AS order_item_id, CAST(buyer_no AS VARCHAR) AS customer_key,
  CAST(part_no AS VARCHAR) AS product_key, CAST(seller_no AS VARCHAR) AS seller_key, st AS order_status,
  bought AS ordered_at, ship_by AS shipping_limit_timestamp, CAST(price AS DOUBLE) AS price,
  CAST(freight AS DOUBLE) AS freight_value, CAST(price AS DOUBLE) + CAST(freight AS DOUBLE) AS total_item_value
FROM line""")

cte("fct_order_payments", """
SELECT md5(order_key || '-' || CAST(payment_sequential AS VARCHAR)) AS order_payment_key, order_key,
  payment_sequential AS payment_sequence, payment_type, payment_installments AS installment_count, payment_value AS payment_amount
FROM stg_order_payments""")

cte("fct_order_reviews", """
SELECT review_key, CAST(review.k AS VARCHAR) AS order_key, CAST(buyer_no AS VARCHAR) AS customer_key, score AS review_score,
  comment_title, comment_message, asked AS review_created_at, answered AS review_answered_at, delay AS review_response_delay_days
FROM review LEFT JOIN ord ON ord.k = review.k""")

cte("fct_orders", f"""
SELECT CAST(ord.k AS VARCHAR) AS order_key, CAST(buyer_no AS VARCHAR) AS customer_key, st AS order_status,
  bought AS purchased_at, approved AS approved_at, handed AS handed_to_carrier_at, arrived AS delivered_to_customer_at,
  due AS estimated_delivery_at, transit AS actual_delivery_days, {DD('due', 'arrived')} AS delivery_buffer_days,
  CASE st WHEN 'delivered' THEN if((k * 7) % 41 > 15 + k % 13, 'Late', 'On Time / Early')
          WHEN 'shipped' THEN 'In Flight' ELSE 'Canceled / Unavailable' END AS delivery_performance_status,
  coalesce(lines, 0) AS total_items_ordered, coalesce(sellers, 0) AS unique_sellers_count,
  CAST(coalesce(price, 0) AS DOUBLE) AS total_item_revenue, CAST(coalesce(freight, 0) AS DOUBLE) AS total_freight_cost,
  CAST(coalesce(price, 0) AS DOUBLE) + CAST(coalesce(freight, 0) AS DOUBLE) AS total_order_value
FROM ord LEFT JOIN basket USING (k)""")

cte("int_seller_performance", f"""
SELECT CAST(seller_no AS VARCHAR) AS seller_key, count(*) AS historical_orders_handled,
  any_value(catalog) AS unique_products_cataloged, {R('avg(transit)', 1)} AS merchant_avg_delivery_days
FROM (SELECT seller_no, k, any_value(transit) AS transit FROM line GROUP BY seller_no, k)
JOIN (SELECT seller_no, count(DISTINCT part_no) AS catalog FROM line GROUP BY seller_no) USING (seller_no)
GROUP BY seller_no""")

# ----------------------------------------------------------------------------- gold
cte("gold_category_performance", f"""
SELECT category AS category_name, {RD('sum(price + freight)', 2)} AS total_category_revenue,
  {RD('sum(price)', 2)} AS total_merchandise_revenue, {RD('sum(freight)', 2)} AS total_freight_revenue,
  count(*) AS units_sold, count(DISTINCT k) AS total_orders,
  {R('sum(price + freight) / count(*)', 2)} AS revenue_per_unit, {R('sum(freight) / count(*)', 2)} AS freight_per_unit,
  coalesce(any_value(stars), 0.0) AS avg_review_score
FROM line LEFT JOIN (
  SELECT category, {R('avg(score)', 2)} AS stars
  FROM (SELECT DISTINCT category, k, score FROM review JOIN line USING (k)) GROUP BY category) USING (category)
GROUP BY category""")

cte("visit", """
SELECT k, person, day, CAST(coalesce(price, 0) + coalesce(freight, 0) AS DECIMAL(28,6)) AS spent,
  date_diff('day', min(day) OVER (PARTITION BY person), day) AS age
FROM ord LEFT JOIN basket USING (k) WHERE person IS NOT NULL""")

cte("gold_customer_cohorts", f"""
SELECT CAST(year(day) AS INTEGER) AS calendar_year, CAST(month(day) AS INTEGER) AS calendar_month,
  strftime(any_value(day), '%B') AS month_name, format('Q{{}}-{{}}', quarter(any_value(day)), year(day)) AS quarter_year,
  count(DISTINCT person) AS total_unique_buyers,
  count(DISTINCT if(age = 0, person, NULL)) AS new_buyers_count,
  count(DISTINCT if(age > 0, person, NULL)) AS returning_buyers_count,
  count(*) AS total_orders, {RD('sum(spent)', 2)} AS total_gmv,
  {RD('sum(if(age = 0, spent, 0))', 2)} AS new_buyer_gmv, {RD('sum(if(age > 0, spent, 0))', 2)} AS returning_buyer_gmv,
  {R('count(DISTINCT if(age > 0, person, NULL)) * 100.0 / count(DISTINCT person)', 2)} AS repeat_buyer_rate_pct,
  {R('avg(nullif(age, 0))', 1)} AS avg_days_since_first_purchase
FROM visit GROUP BY year(day), month(day)""")

cte("gold_executive_overview", f"""
SELECT CAST(k AS VARCHAR) AS order_key, CAST(buyer_no AS VARCHAR) AS customer_key, CAST(seller_no AS VARCHAR) AS seller_key,
  state AS customer_state, bought AS purchased_at, due AS estimated_delivery_at, transit AS actual_shipping_days,
  CAST(freight AS DOUBLE) AS actual_freight, faster AS optimized_shipping_days, cheaper AS optimized_freight,
  transit - faster AS days_saved, {R('CAST(freight AS DOUBLE) - cheaper', 2)} AS freight_dollars_saved,
  CAST(faster > 15 + k % 13 AS INTEGER) AS is_optimized_late
FROM (SELECT *, CAST(if(transit < 1, transit, greatest(1, round(transit * 0.65))) AS INTEGER) AS faster,
        {R('CAST(freight AS DOUBLE) * 0.65', 2)} AS cheaper FROM line WHERE transit IS NOT NULL)""")

cte("gold_payment_analysis", f"""
SELECT payment_type, count(DISTINCT order_key) AS total_orders_using_payment_type, count(*) AS total_payment_transactions,
  {R('avg(payment_installments)', 1)} AS avg_installment_count, {RD('sum(paid)', 2)} AS total_captured_payment_value,
  {R('sum(paid) / count(paid)', 2)} AS avg_payment_transaction_value, {RD('sum(worth)', 2)} AS total_associated_order_gmv,
  {RD('sum(paid) - sum(worth)', 2)} AS payment_reconciliation_discrepancy
FROM (SELECT p.*, {M('payment_value')} AS paid, CAST(coalesce(price, 0) + coalesce(freight, 0) AS DECIMAL(28,6)) AS worth
      FROM stg_order_payments AS p LEFT JOIN basket ON k = CAST(order_key AS BIGINT))
GROUP BY payment_type""")

cte("gold_regional_logistics", f"""
SELECT seller_state AS origin_state, state AS destination_state, count(DISTINCT k) AS total_orders_shipped,
  count(transit) AS fulfilled_orders_count,
  {R('sum(CAST(transit > 15 + k % 13 AS INTEGER)) * 100.0 / nullif(count(transit), 0)', 2)} AS sla_breach_rate_pct,
  {R('avg(transit)', 1)} AS avg_delivery_days, {R('sum(freight) / count(*)', 2)} AS avg_freight_cost_per_item
FROM (SELECT DISTINCT k, seller_no, freight, seller_state, state, transit FROM line)
WHERE seller_state IS NOT NULL AND state IS NOT NULL GROUP BY seller_state, state""")

# Complaint words, one pattern for each group.
DELAY, DAMAGE, QUALITY = "atraso|demor|late|delay", "estragad|quebrad|damag|broken", "pessim|ruim|bad|poor"

cte("gold_review_text_signals", f"""
SELECT score AS review_score, count(*) AS total_reviews_count,
  CAST(sum(CAST(filled AS INTEGER)) AS BIGINT) AS reviews_with_written_comments_count,
  {R('avg(CAST(filled AS INTEGER)) * 100', 2)} AS comment_written_rate_pct, {R('avg(delay)', 1)} AS avg_merchant_response_delay_days,
  CAST(sum(CAST(regexp_matches(said, '{DELAY}') AS INTEGER)) AS BIGINT) AS delay_complaint_count,
  CAST(sum(CAST(regexp_matches(said, '{DAMAGE}') AS INTEGER)) AS BIGINT) AS damage_complaint_count,
  CAST(sum(CAST(regexp_matches(said, '{QUALITY}') AS INTEGER)) AS BIGINT) AS poor_quality_complaint_count
FROM (SELECT score, delay, lower(coalesce(comment_message, '')) AS said, trim(coalesce(comment_message, ''), ' ') <> '' AS filled FROM review)
GROUP BY score""")

cte("gold_seller_scorecard", f"""
SELECT seller_key, d.city AS seller_city, d.state AS seller_state, latitude, longitude, historical_orders_handled,
  unique_products_cataloged, merchant_avg_delivery_days, unique_buyers_served, total_items_sold, total_gross_revenue,
  coalesce(stars, 0.0) AS avg_review_score
FROM dim_sellers AS d JOIN int_seller_performance USING (seller_key) JOIN (
  SELECT CAST(seller_no AS VARCHAR) AS seller_key, count(DISTINCT person) AS unique_buyers_served, count(*) AS total_items_sold,
    {RD('sum(price + freight)', 2)} AS total_gross_revenue FROM line GROUP BY seller_no) USING (seller_key) LEFT JOIN (
  SELECT CAST(seller_no AS VARCHAR) AS seller_key, {R('avg(score)', 2)} AS stars
  FROM (SELECT DISTINCT seller_no, k, score FROM review JOIN line USING (k)) GROUP BY seller_no) USING (seller_key)""")

# Regional hubs; every state but RJ and MG is served from Sao Paulo.
cte("hub", """
SELECT * FROM (VALUES ('Sao Paulo Hub', -23.5505::DOUBLE, -46.6333::DOUBLE, 150000::BIGINT),
  ('Rio de Janeiro Hub', -22.9068::DOUBLE, -43.1729::DOUBLE, 90000::BIGINT),
  ('Belo Horizonte Hub', -19.9167::DOUBLE, -43.9345::DOUBLE, 60000::BIGINT)) AS h(hub_name, hub_lat, hub_lon, capacity)""")
SERVES = "coalesce(map {'RJ': 'Rio de Janeiro Hub', 'MG': 'Belo Horizonte Hub'}[{s}], 'Sao Paulo Hub')"

cte("routes_all", f"""
SELECT CAST(k AS VARCHAR) AS order_key, CAST(seller_no AS VARCHAR) AS seller_key, CAST(buyer_no AS VARCHAR) AS customer_key,
  seller_city, seller_state, f.lat AS seller_lat, f.lon AS seller_lon, city AS customer_city, state AS customer_state,
  t.lat AS customer_lat, t.lon AS customer_lon, hub_name, hub_lat, hub_lon
FROM (SELECT DISTINCT k, seller_no, buyer_no, seller_city, seller_state, seller_nation, city, state, nation FROM line) AS r
JOIN place AS f ON f.nation = seller_nation JOIN place AS t ON t.nation = r.nation
JOIN hub ON hub_name = {SERVES.replace('{s}', 'state')}""")

ROUTE_COLS = ("order_key, seller_city, seller_state, seller_lat, seller_lon, customer_city, customer_state, "
              "customer_lat, customer_lon, hub_name, hub_lat, hub_lon")

cte("gold_spatial_routing", f"SELECT {ROUTE_COLS} FROM routes_all")

# ----------------------------------------------------------------------------- scenario
cte("default_states", """
SELECT customer_state FROM (SELECT DISTINCT customer_state FROM gold_executive_overview
  WHERE customer_state IS NOT NULL) ORDER BY customer_state LIMIT 5""")

cte("exec_filtered", "SELECT * FROM gold_executive_overview WHERE optimized_shipping_days <= 30")

KPIS = f"""
SELECT total_baseline_freight, total_optimized_freight, freight_savings,
  CASE WHEN total_baseline_freight > 0 THEN freight_savings / total_baseline_freight * 100 ELSE 0.0 END AS freight_savings_pct,
  avg_days_saved, n_lines, baseline_on_time, optimized_on_time,
  CASE WHEN n_lines > 0 THEN (optimized_on_time - baseline_on_time) / n_lines * 100 ELSE 0.0 END AS otif_lift_pct
FROM (SELECT CAST(sum({M('actual_freight')}) AS DOUBLE) AS total_baseline_freight,
        CAST(sum({M('optimized_freight')}) AS DOUBLE) AS total_optimized_freight,
        CAST(sum({M('actual_freight')}) - sum({M('optimized_freight')}) AS DOUBLE) AS freight_savings,
        avg(days_saved) AS avg_days_saved, count(*) AS n_lines,
        count(CASE WHEN actual_shipping_days <= 20 THEN 1 END) AS baseline_on_time,
        count(CASE WHEN is_optimized_late = 0 THEN 1 END) AS optimized_on_time
      FROM exec_filtered"""

CORRIDORS = """
SELECT i.order_key, s.state AS origin_state, c.state AS destination_state
FROM fct_order_items i JOIN dim_sellers s USING (seller_key) JOIN dim_customers c USING (customer_key)
WHERE s.state IS NOT NULL AND c.state IS NOT NULL"""

#: Every selection of the eight states as a bit mask (0: none chosen, which means all), with the lines that it holds.
SELECTIONS = f"""
SELECT CAST(selection AS INTEGER) AS selection, max_days, e.* FROM range(256) AS s(selection), (VALUES (10), (20), (30)) AS d(max_days), gold_executive_overview e
WHERE e.optimized_shipping_days <= max_days
  AND (selection = 0 OR (selection >> (list_position({STATE[:STATE.index(']') + 1]}, e.customer_state) - 1)) & 1 = 1)"""

VIOLATIONS = """
SELECT order_key, optimized_shipping_days, optimized_freight FROM {t}
WHERE optimized_shipping_days < 0 OR optimized_freight < 0 OR optimized_shipping_days > actual_shipping_days"""


# ----------------------------------------------------------------------------- quality
# The declared checks, by model: columns that must be filled, and columns that must be unique.
NOT_NULL = {
    "dim_customers": "customer_key customer_unique_id", "dim_dates": "date_key", "dim_products": "product_key category_name",
    "dim_sellers": "seller_key", "fct_order_items": "order_key order_item_id customer_key product_key seller_key price",
    "fct_order_payments": "order_payment_key order_key", "fct_order_reviews": "review_key order_key",
    "fct_orders": "order_key customer_key", "int_seller_performance": "seller_key",
    "gold_category_performance": "category_name total_category_revenue",
    "gold_customer_cohorts": "calendar_year calendar_month total_unique_buyers",
    "gold_executive_overview": "order_key customer_state actual_shipping_days actual_freight optimized_shipping_days optimized_freight",
    "gold_payment_analysis": "payment_type total_captured_payment_value",
    "gold_regional_logistics": "origin_state destination_state total_orders_shipped",
    "gold_review_text_signals": "review_score total_reviews_count",
    "gold_seller_scorecard": "seller_key historical_orders_handled",
    "gold_spatial_routing": "order_key seller_lat seller_lon customer_lat customer_lon hub_lat hub_lon",
    "stg_geolocation": "zip_code_prefix latitude longitude",
    "stg_order_items": "order_key order_item_id product_key seller_key price",
    "stg_order_payments": "order_key payment_sequential payment_value",
    "stg_order_reviews": "review_key order_key review_score", "stg_orders": "order_key customer_key",
    "stg_category_translation": "category_name_portuguese", "stg_products": "product_key", "stg_sellers": "seller_key",
}
UNIQUE = {
    "dim_customers": "customer_key", "dim_dates": "date_key", "dim_products": "product_key", "dim_sellers": "seller_key",
    "fct_order_payments": "order_payment_key", "fct_order_reviews": "review_key", "fct_orders": "order_key",
    "int_seller_performance": "seller_key", "gold_category_performance": "category_name", "gold_payment_analysis": "payment_type",
    "gold_review_text_signals": "review_score", "gold_seller_scorecard": "seller_key", "stg_geolocation": "zip_code_prefix",
    "stg_order_reviews": "review_key", "stg_orders": "order_key", "stg_category_translation": "category_name_portuguese",
    "stg_products": "product_key", "stg_sellers": "seller_key",
}
STATUSES = "'On Time / Early', 'Late', 'In Flight', 'Canceled / Unavailable'"


def _quality_sql() -> str:
    counts = [(m, c, "not_null", f"(SELECT count(*) - count({c}) FROM {m})") for m, cs in NOT_NULL.items() for c in cs.split()]
    counts += [(m, c, "unique", f"(SELECT count(*) FROM (SELECT 1 FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))")
               for m, c in UNIQUE.items()]
    counts.append(("fct_orders", "delivery_performance_status", "accepted_values",
                   f"(SELECT count(DISTINCT delivery_performance_status) FROM fct_orders WHERE delivery_performance_status NOT IN ({STATUSES}))"))
    counts.append(("gold_executive_overview", "*", "valid_optimizer_outputs",
                   f"(SELECT count(*) FROM ({VIOLATIONS.format(t='gold_executive_overview')}))"))
    rows = ",\n".join(f"('{kind}__{m}__{c}', '{m}', '{c}', '{kind}', {n})" for m, c, kind, n in counts)
    return (f"SELECT *, if(violations = 0, 'pass', 'fail') AS status FROM (VALUES {rows}) "
            "AS v(check_name, model, column_name, check_type, violations)")


FINAL: dict[str, str] = {
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_order_items": "SELECT * FROM stg_order_items",
    "stg_order_payments": "SELECT * FROM stg_order_payments",
    "stg_products": "SELECT * FROM stg_products",
    "geo_representative_point": "SELECT * FROM stg_geolocation",
    "keep_latest_review": "SELECT * FROM stg_order_reviews",
    "dedup_seller": "SELECT * FROM stg_sellers",
    "dedup_category": "SELECT * FROM stg_category_translation",
    "try_cast_parse": """
SELECT review_id AS review_key, review_score AS raw_review_score, TRY_CAST(review_score AS INTEGER) AS review_score,
  review_answer_timestamp AS raw_answer_timestamp, TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS answer_timestamp
FROM b_order_reviews
WHERE (review_score IS NOT NULL AND TRY_CAST(review_score AS INTEGER) IS NULL)
   OR (review_answer_timestamp IS NOT NULL AND TRY_CAST(review_answer_timestamp AS TIMESTAMP) IS NULL)""",
    "dim_customers_geo": "SELECT * FROM dim_customers",
    "dim_sellers_geo": "SELECT * FROM dim_sellers",
    "dim_products_category": "SELECT * FROM dim_products",
    "dim_dates_calendar": "SELECT * FROM dim_dates",
    "dim_dates_fixed": f"""
SELECT c.*, (SELECT count(*) FROM ord WHERE ord.day = c.date_key) AS orders
FROM ({_calendar("TIMESTAMP '2016-01-01'", "TIMESTAMP '2020-12-31'")}) AS c""",
    "fct_order_items": "SELECT * FROM fct_order_items",
    "fct_order_payments": "SELECT * FROM fct_order_payments",
    "fct_order_reviews": "SELECT * FROM fct_order_reviews",
    "fct_orders": "SELECT * FROM fct_orders",
    "seller_performance": "SELECT * FROM int_seller_performance",
    "delivery_status_summary": f"""
SELECT delivery_performance_status, count(*) AS total_orders,
  {RD(f"sum({M('total_order_value')})", 2)} AS total_order_value,
  {R('avg(actual_delivery_days)', 1)} AS avg_actual_delivery_days
FROM fct_orders GROUP BY 1""",
    "scaled_money_totals": """
SELECT delivery_performance_status, count(*) AS total_orders,
  CAST(sum(CAST(total_order_value * 1e6::DOUBLE * 1e6::DOUBLE AS HUGEINT)) AS VARCHAR) AS total_millionths
FROM fct_orders GROUP BY 1""",
    "category_performance": "SELECT * FROM gold_category_performance",
    "customer_cohorts": "SELECT * FROM gold_customer_cohorts",
    "executive_overview": "SELECT * FROM gold_executive_overview",
    "payment_analysis": "SELECT * FROM gold_payment_analysis",
    "regional_logistics": "SELECT * FROM gold_regional_logistics",
    "review_text_signals": "SELECT * FROM gold_review_text_signals",
    "seller_scorecard": "SELECT * FROM gold_seller_scorecard",
    "spatial_routing": f"SELECT {ROUTE_COLS} FROM routes_all ORDER BY order_key, seller_key, customer_key LIMIT 3000",
    "spatial_routes_all": "SELECT * FROM gold_spatial_routing",
    "state_list": """
SELECT s.customer_state, (d.customer_state IS NOT NULL) AS is_default
FROM (SELECT DISTINCT customer_state FROM gold_executive_overview WHERE customer_state IS NOT NULL) s
LEFT JOIN default_states d ON s.customer_state = d.customer_state""",
    "csv_by_ranges": """
SELECT doc_id, lang, source, n_chars, length(text) AS read_chars, md5(text) AS text_md5 FROM documents""",
    "scenario_kpis": KPIS + ")",
    "scenario_kpis_default": KPIS + " WHERE customer_state IN (SELECT customer_state FROM default_states))",
    "lead_time_histogram": """
SELECT series, bin_index, if(bin_index >= 0, bin_index * 1.5::DOUBLE, NULL) AS bin_start,
  if(bin_index < 27, (bin_index + 1) * 1.5::DOUBLE, NULL) AS bin_end, count(*) AS n
FROM (SELECT series, CAST(greatest(-1, least(27, floor(days / 1.5::DOUBLE))) AS INTEGER) AS bin_index FROM (
  UNPIVOT (SELECT actual_shipping_days AS baseline, optimized_shipping_days AS optimized FROM exec_filtered)
  ON baseline, optimized INTO NAME series VALUE days))
GROUP BY series, bin_index""",
    "corridor_order_rollup": f"""
SELECT CAST(list_position([0, 1, 2, 3], GROUPING(origin_state, destination_state)) - 1 AS INTEGER) AS level,
  origin_state, destination_state, count(DISTINCT order_key) AS total_orders
FROM ({CORRIDORS}) GROUP BY GROUPING SETS ((origin_state, destination_state), (origin_state), (destination_state), ())""",
    "origin_set_orders": f"""
SELECT CAST(selection AS INTEGER) AS selection, count(DISTINCT order_key) AS total_orders
FROM range(1, 256) AS s(selection), ({CORRIDORS})
WHERE (selection >> (list_position({STATE[:STATE.index(']') + 1]}, origin_state) - 1)) & 1 = 1 GROUP BY selection""",
    "buyer_rollup": """
SELECT CAST(CASE GROUPING(calendar_year, quarter_year, calendar_month) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS INTEGER) AS level,
  calendar_year, quarter_year, calendar_month, count(DISTINCT customer_unique_id) AS total_unique_buyers
FROM fct_orders JOIN dim_customers USING (customer_key) JOIN dim_dates ON date_key = CAST(purchased_at AS DATE)
WHERE customer_unique_id IS NOT NULL
GROUP BY GROUPING SETS ((calendar_year, quarter_year, calendar_month), (calendar_year, quarter_year), (calendar_year), ())""",
    "cube_kpis": KPIS.replace("SELECT total_baseline_freight", "SELECT selection, max_days, total_baseline_freight", 1)
    .replace("avg(days_saved)", "CAST(sum(days_saved) AS DOUBLE) / count(days_saved)")
    .replace("FROM (SELECT CAST", "FROM (SELECT selection, max_days, CAST", 1)
    .replace("FROM exec_filtered", f"FROM ({SELECTIONS}) GROUP BY selection, max_days") + ")",
    "cube_histogram": f"""
SELECT selection, max_days, series, bin_index, if(bin_index >= 0, bin_index * 1.5::DOUBLE, NULL) AS bin_start,
  if(bin_index < 27, (bin_index + 1) * 1.5::DOUBLE, NULL) AS bin_end, count(*) AS n
FROM (SELECT selection, max_days, series, CAST(greatest(-1, least(27, floor(days / 1.5::DOUBLE))) AS INTEGER) AS bin_index FROM (
  UNPIVOT (SELECT selection, max_days, actual_shipping_days AS baseline, optimized_shipping_days AS optimized FROM ({SELECTIONS}))
  ON baseline, optimized INTO NAME series VALUE days))
GROUP BY ALL""",
    "cube_hub_load": f"""
SELECT selection, max_days, hub_name, any_value(capacity) AS capacity,
  count(*) FILTER (WHERE hub_name = {SERVES.replace('{s}', 'customer_state')}) AS orders_handled
FROM ({SELECTIONS}) CROSS JOIN hub GROUP BY selection, max_days, hub_name""",
    "hub_load": f"""
SELECT hub_name, any_value(hub_lat) AS hub_lat, any_value(hub_lon) AS hub_lon, any_value(capacity) AS capacity,
  count(order_key) AS orders_handled
FROM hub LEFT JOIN exec_filtered ON hub_name = {SERVES.replace('{s}', 'customer_state')} GROUP BY hub_name""",
    "corridor_top_k": f"""
SELECT seller_state, customer_state, total_orders,
  {RE('avg_days_saved', 1)} AS avg_days_saved, {RE('saved', 2)} AS total_freight_saved,
  {RE('saved / actual * 100', 1)} AS freight_pct
FROM (SELECT r.seller_state, e.customer_state, count(DISTINCT e.order_key) AS total_orders,
        avg(e.days_saved) AS avg_days_saved,
        CAST(sum({M('e.freight_dollars_saved')}) AS DOUBLE) AS saved,
        CAST(sum({M('e.actual_freight')}) AS DOUBLE) AS actual
      FROM exec_filtered e JOIN gold_spatial_routing r ON e.order_key = r.order_key
      WHERE r.seller_state IS NOT NULL AND e.customer_state IS NOT NULL
      GROUP BY 1, 2)
ORDER BY total_orders DESC, seller_state, customer_state LIMIT 5""",
    "corridor_display": f"""
SELECT seller_state AS "Origin (Seller)", customer_state AS "Destination (Customer)", total_orders AS "Orders Handled",
  {RE('avg_days_saved', 1)} AS "Avg Days Saved", {RE('saved', 2)} AS "Total Saved ($)",
  {RE('saved / actual * 100', 1)} AS "Cost Reduced (%)"
FROM (SELECT r.seller_state, e.customer_state, count(DISTINCT e.order_key) AS total_orders,
        avg(e.days_saved) AS avg_days_saved,
        CAST(sum({M('e.freight_dollars_saved')}) AS DOUBLE) AS saved,
        CAST(sum({M('e.actual_freight')}) AS DOUBLE) AS actual
      FROM exec_filtered e JOIN gold_spatial_routing r ON e.order_key = r.order_key
      WHERE r.seller_state IS NOT NULL AND e.customer_state IS NOT NULL
      GROUP BY 1, 2)
ORDER BY total_orders DESC, seller_state, customer_state LIMIT 5""",
    "route_centroid": f"""
SELECT coalesce({R('sum(CAST(customer_lat AS DECIMAL(20,10))) / count(customer_lat)', 6)}, -22.5) AS center_lat,
  coalesce({R('sum(CAST(customer_lon AS DECIMAL(20,10))) / count(customer_lon)', 6)}, -45.0) AS center_lon,
  count(*) AS n_routes, if(count(*) > 0 AND count(DISTINCT customer_state) <= 3, 6, 5) AS zoom
FROM gold_spatial_routing""",
    "route_legs": """
SELECT order_key, 'baseline' AS leg, seller_lat AS src_lat, seller_lon AS src_lon,
  customer_lat AS dst_lat, customer_lon AS dst_lon FROM gold_spatial_routing
UNION ALL
SELECT order_key, 'optimized', hub_lat, hub_lon, customer_lat, customer_lon FROM gold_spatial_routing""",
    "mart_by_view": """
SELECT customer_state, count(*) AS faster_lines, count(DISTINCT order_key) AS faster_orders,
  max(actual_shipping_days - optimized_shipping_days) AS most_days_saved
FROM gold_executive_overview WHERE optimized_shipping_days < actual_shipping_days GROUP BY customer_state""",
    "quality_report": None,  # built below
    "optimizer_violations": VIOLATIONS.format(t="gold_executive_overview"),
    "optimizer_violations_planted": VIOLATIONS.format(t="""(
  SELECT order_key, actual_shipping_days,
    CASE WHEN CAST(order_key AS BIGINT) % 11 = 0 THEN actual_shipping_days + 1
         WHEN CAST(order_key AS BIGINT) % 13 = 0 THEN -1 ELSE optimized_shipping_days END AS optimized_shipping_days,
    if(CAST(order_key AS BIGINT) % 17 = 0, -0.5::DOUBLE, optimized_freight) AS optimized_freight
  FROM gold_executive_overview)"""),
    "bronze_manifest": None,  # built below
}


# The landing file of each source, and the bronze rows it must hold.
FILES = {
    "customers": "b_customers", "geolocation": "b_geolocation", "order_items": "b_order_items", "order_payments": "b_order_payments",
    "order_reviews": "b_order_reviews", "orders": "b_orders", "category_translation": "b_category_translation",
    "products": "b_products", "sellers": "b_sellers"}

#: Registered queries without SQL.
NO_ORACLE = ()


def _manifest_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS source, count(*) AS rows, 0::BIGINT AS rows_missing, 0::BIGINT AS rows_extra FROM {t}"
                              for name, t in FILES.items())



# Columns of each source, as the file contract names them.
COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                      "review_creation_date", "review_answer_timestamp"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "category_translation": ["product_category_name", "product_category_name_english"],
    "products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght", "product_photos_qty",
                 "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
}


def _inference_sql() -> str:
    whole, number = "-?(0|[1-9][0-9]*)", "-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][-+]?[0-9]+)?"
    time = "[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?"

    def column(source: str, i: int, c: str) -> str:
        is_long = f"regexp_full_match({c}, '{whole}') AND TRY_CAST({c} AS BIGINT) IS NOT NULL"
        is_double = f"({is_long} OR NOT regexp_full_match({c}, '{whole}') AND regexp_full_match({c}, '{number}') AND isfinite(TRY_CAST({c} AS DOUBLE)))"
        return f"""SELECT '{source}' AS source, {i} AS position, '{c}' AS column_name,
          CASE WHEN count({c}) = 0 THEN 'void'
               WHEN bool_and(lower({c}) IN ('true', 'false')) THEN 'boolean'
               WHEN bool_and({is_long} AND TRY_CAST({c} AS INTEGER) IS NOT NULL) THEN 'int'
               WHEN bool_and({is_long}) THEN 'long'
               WHEN bool_and({is_double}) THEN 'double'
               WHEN bool_and(regexp_full_match({c}, '{time}') AND TRY_CAST({c} AS TIMESTAMP) IS NOT NULL) THEN 'timestamp'
               ELSE 'string' END AS inferred_type,
          count({c}) AS filled, count(*) FILTER (regexp_full_match({c}, '-?0[0-9]+')) AS leading_zeros
        FROM {FILES[source]} WHERE {c} IS NOT NULL"""
    return " UNION ALL ".join(column(s, i, c) for s, cs in COLUMNS.items() for i, c in enumerate(cs))


def _ledger_sql() -> str:
    states, copies = {"sellers": "new,removed", "order_payments": "new,unchanged"}, {"order_payments": 2}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS source, '{states.get(name, 'unchanged')}' AS file_states, count(*) AS rows_before, "
        f"{copies.get(name, 1)} * count(*) AS rows, 0::BIGINT AS rows_missing, 0::BIGINT AS rows_extra FROM {t}" for name, t in FILES.items())


def _refresh_sql() -> str:
    tables = {"stg_order_items": "price", "fct_orders": "total_order_value", "gold_payment_analysis": "total_associated_order_gmv"}
    steps = (("built", 1), ("task failed", 1), ("check failed", 1), ("repeated", 2))
    return " UNION ALL ".join(
        f"SELECT '{step}' AS step, {n}::BIGINT AS commit, '{t}' AS table_name, count(*) AS rows, {RD(f'sum({M(c)}) * {n}', 2)} AS total FROM {t}"
        for step, n in steps for t, c in tables.items())


def oracle_queries() -> dict[str, str]:
    """Full DuckDB statement per registered query (all CTEs prepended)."""
    with_clause = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in CTES) + "\n"
    final = dict(FINAL)
    final["quality_report"] = final["quality_at_write"] = _quality_sql()
    final["bronze_manifest"] = _manifest_sql()
    final["inferred_types"] = _inference_sql()
    final["landing_ledger"] = _ledger_sql()
    final["atomic_refresh"] = _refresh_sql()
    return {name: with_clause + sql for name, sql in final.items()}
