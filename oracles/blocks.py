"""Building blocks of the expected results: raw views, then staging, analytics and marts."""

from __future__ import annotations


def hours(start: str, end: str) -> str:
    """Hours from start to end at two decimals, half away from zero, in whole numbers."""
    d = f"date_diff('microsecond', {start}, {end})"
    hundredths = f"sign({d}) * ((abs({d}) * 200 + 3600000000) // 7200000000)"
    return f"CAST(CAST({hundredths} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"


def rounded(numerator: str, denominator: str, places: int, kind: str) -> str:
    """numerator / denominator at some decimals, half away from zero; both whole numbers."""
    a, b = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    scaled = f"(sign({a}) * ((abs({a}) * {2 * 10 ** places} + {b}) // (2 * {b})))"
    step = "1" if places == 0 else "0." + "0" * (places - 1) + "1"
    return (
        f"CASE WHEN {b} <> 0 THEN CAST(CAST({scaled} AS DECIMAL(28,0)) "
        f"* CAST({step} AS DECIMAL(9,{places})) AS {kind}) END"
    )


def cents(amount: str) -> str:
    """A sum of amounts as a whole number of cents."""
    return f"(CAST({amount} AS DECIMAL(34,2)) * 100)"


def key(moment: str) -> str:
    return f"CAST(strftime({moment}, '%Y%m%d') AS INTEGER)"


BLOCKS = {
    "raw_customers": """
SELECT 'c' || CAST(o_orderkey AS STRING) AS customer_id,
 CASE WHEN o_orderkey % 3 = 0 THEN 'u' || CAST(o_custkey AS STRING) ELSE 'x' || CAST(o_orderkey AS STRING) END AS customer_unique_id,
 CAST(o_custkey % 400 AS INT) AS customer_zip_code_prefix,
 lower(n_name) AS customer_city, lpad(CAST(CASE WHEN o_orderkey % 30 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS STRING), 2, '0') AS customer_state
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "raw_orders": """
SELECT 'o' || CAST(o_orderkey AS STRING) AS order_id, 'c' || CAST(o_orderkey AS STRING) AS customer_id,
 CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'P' THEN 'shipped'
  WHEN o_orderkey % 6 = 0 THEN 'created' WHEN o_orderkey % 6 = 1 THEN 'approved' WHEN o_orderkey % 6 = 2 THEN 'processing'
  WHEN o_orderkey % 6 = 3 THEN 'invoiced' WHEN o_orderkey % 6 = 4 THEN 'unavailable' ELSE 'canceled' END AS order_status,
 o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 7919) % 86400) AS order_purchase_timestamp,
 CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + INTERVAL '1' SECOND * (86400 + (o_orderkey * 31) % 172800) END AS order_approved_at,
 CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL '1' SECOND * (172800 + (o_orderkey * 97) % 345600) END AS order_delivered_carrier_date,
 CASE WHEN (o_orderstatus = 'F' AND o_orderkey % 50 <> 7) OR (o_orderstatus = 'O' AND o_orderkey % 60 = 5)
  THEN o_orderdate + INTERVAL '1' SECOND * (432000 + (o_orderkey * 7919) % 2592000) END AS order_delivered_customer_date,
 o_orderdate + INTERVAL '30' DAY AS order_estimated_delivery_date
FROM orders""",
    "raw_order_items": """
SELECT 'o' || CAST(l_orderkey AS STRING) AS order_id,
 CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS BIGINT) AS order_item_id,
 'p' || CAST(l_partkey AS STRING) AS product_id, 's' || CAST(l_suppkey AS STRING) AS seller_id, l_shipdate AS shipping_limit_date,
 CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS DECIMAL(12,2)) AS freight_value
FROM lineitem""",
    "raw_order_payments": """
SELECT 'o' || CAST(o_orderkey AS STRING) AS order_id, CAST(s.seq AS INT) AS payment_sequential,
 CASE WHEN s.seq > 1 THEN 'voucher' WHEN o_orderkey % 500 = 13 THEN 'not_defined' WHEN o_orderkey % 5 = 0 THEN 'boleto' WHEN o_orderkey % 11 = 0 THEN 'debit_card' WHEN o_orderkey % 13 = 0 THEN 'voucher' ELSE 'credit_card' END AS payment_type,
 CAST(CASE WHEN s.seq > 1 THEN 1 WHEN o_orderkey % 700 = 9 THEN 0 ELSE 1 + o_orderkey % 13 END AS INT) AS payment_installments,
 CAST(CASE WHEN t.item_total IS NULL AND o_orderkey % 4 = 0 THEN 0
  WHEN s.seq > 1 THEN 10
  ELSE COALESCE(t.item_total, CAST(o_totalprice AS DECIMAL(12,2))) - 10 * (o_orderkey % 3)
   + CASE WHEN o_orderkey % 60 = 0 THEN 0.01 WHEN o_orderkey % 60 = 1 THEN 0.02 WHEN o_orderkey % 60 = 2 THEN -0.01 WHEN o_orderkey % 60 = 3 THEN -5 ELSE 0 END END AS DECIMAL(18,2)) AS payment_value
FROM orders JOIN (SELECT 1 AS seq UNION ALL SELECT 2 UNION ALL SELECT 3) s ON s.seq <= 1 + o_orderkey % 3
LEFT JOIN (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS item_total FROM lineitem GROUP BY l_orderkey) t ON l_orderkey = o_orderkey
WHERE o_orderkey % 500 <> 11""",
    "raw_order_reviews": """
SELECT 'r' || CAST(o_orderkey - (o_orderkey % 2) + k.k * 1000000000 AS STRING) AS review_id, 'o' || CAST(o_orderkey AS STRING) AS order_id,
 CAST(1 + (o_orderkey * 13 + k.k) % 5 AS INT) AS review_score,
 CASE WHEN o_orderkey % 3 = 0 THEN 'title' END AS review_comment_title, CASE WHEN o_orderkey % 4 = 0 THEN 'message' END AS review_comment_message,
 o_orderdate + INTERVAL '36' DAY AS review_creation_date, o_orderdate + INTERVAL '36' DAY + INTERVAL '1' SECOND * ((o_orderkey * 101) % 604800) AS review_answer_timestamp
FROM orders JOIN (SELECT 0 AS k UNION ALL SELECT 1) k
  ON (k.k = 0 AND o_orderkey % 10 <> 0) OR (k.k = 1 AND o_orderkey % 40 = 5)""",
    "raw_products": """
SELECT 'p' || CAST(p_partkey AS STRING) AS product_id, CASE WHEN p_partkey % 50 <> 0 THEN p_name END AS product_category_name,
 CASE WHEN p_partkey % 50 <> 0 THEN CAST(length(p_name) AS INT) END AS product_name_length, CASE WHEN p_partkey % 50 <> 0 THEN CAST(length(p_type) AS INT) END AS product_description_length,
 CASE WHEN p_partkey % 50 <> 0 THEN CAST(1 + p_partkey % 6 AS INT) END AS product_photos_qty,
 CASE WHEN p_partkey % 100 <> 1 THEN CAST(p_retailprice AS DECIMAL(12,2)) END AS product_weight_g,
 CASE WHEN p_partkey % 100 <> 1 THEN CAST(p_size AS DECIMAL(12,2)) END AS product_length_cm, CAST(p_size + 1 AS DECIMAL(12,2)) AS product_height_cm, CAST(p_size + 2 AS DECIMAL(12,2)) AS product_width_cm
FROM part""",
    "raw_category_translation": """
SELECT DISTINCT p_name AS product_category_name, upper(p_name) AS product_category_name_english FROM part WHERE p_name NOT IN ('old gizmo', 'blue rod')""",
    "raw_sellers": """
SELECT 's' || CAST(s_suppkey AS STRING) AS seller_id, CAST(300 + s_suppkey AS INT) AS seller_zip_code_prefix, lower(n_name) AS seller_city, lpad(CAST(s_nationkey AS STRING), 2, '0') AS seller_state FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "raw_geolocation": """
SELECT CAST(l_partkey % 380 AS INT) AS geolocation_zip_code_prefix,
 CAST(CAST((l_orderkey * 7919 + l_linenumber * 104729 + l_suppkey * 31) % 4010001 AS DECIMAL(12,0)) * CAST(0.00001 AS DECIMAL(6,5)) - 34 AS DECIMAL(10,7)) AS geolocation_lat,
 CAST(CAST((l_orderkey * 6007 + l_linenumber * 15485863 + l_suppkey * 17) % 4010001 AS DECIMAL(12,0)) * CAST(0.00001 AS DECIMAL(6,5)) - 74 AS DECIMAL(10,7)) AS geolocation_lng,
 CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 'City_' ELSE 'city_' END || CAST((l_partkey % 380) % 25 + (l_suppkey % 2) AS STRING) AS geolocation_city,
 lpad(CAST((l_partkey % 380 + (l_suppkey % 2)) % 25 AS STRING), 2, '0') AS geolocation_state
FROM lineitem""",
    # staging
    "city_rank": """
SELECT geolocation_zip_code_prefix AS zip, geolocation_city AS city,
 row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY count(*) DESC, geolocation_city) AS place
FROM raw_geolocation GROUP BY 1, 2""",
    "state_rank": """
SELECT geolocation_zip_code_prefix AS zip, geolocation_state AS state,
 row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY count(*) DESC, geolocation_state) AS place
FROM raw_geolocation GROUP BY 1, 2""",
    "zip_point": f"""
SELECT geolocation_zip_code_prefix AS zip,
 {rounded("sum(CAST(geolocation_lat * 10000000 AS BIGINT))", "count(*) * 10000000", 7, "DECIMAL(10,7)")} AS avg_latitude,
 {rounded("sum(CAST(geolocation_lng * 10000000 AS BIGINT))", "count(*) * 10000000", 7, "DECIMAL(10,7)")} AS avg_longitude
FROM raw_geolocation GROUP BY 1""",
    "stg_geolocation": """
SELECT p.zip AS geolocation_zip_code_prefix, p.avg_latitude, p.avg_longitude,
 c.city AS representative_city, s.state AS representative_state
FROM zip_point p JOIN city_rank c ON c.zip = p.zip AND c.place = 1
JOIN state_rank s ON s.zip = p.zip AND s.place = 1""",
    "stg_products": """
SELECT p.*, (SELECT t.product_category_name_english FROM raw_category_translation t
             WHERE t.product_category_name = p.product_category_name) AS product_category_name_english,
 CASE WHEN p.product_category_name IN (SELECT product_category_name FROM raw_category_translation) THEN 'translated'
      WHEN p.product_category_name IS NOT NULL THEN 'missing_translation' ELSE 'no_category' END AS category_translation_status
FROM raw_products p""",
    "stg_orders": f"""
SELECT *, {hours("order_purchase_timestamp", "order_approved_at")} AS approval_delay_hours,
 {hours("order_approved_at", "order_delivered_carrier_date")} AS carrier_delay_hours,
 {hours("order_purchase_timestamp", "order_delivered_customer_date")} AS delivery_time_hours,
 {hours("order_estimated_delivery_date", "order_delivered_customer_date")} AS delivery_vs_estimated_hours
FROM raw_orders""",
    "stg_order_items": """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value,
 product_category_name, product_category_name_english, seller_city, seller_state,
 CAST(price + freight_value AS DECIMAL(12,2)) AS item_total_value
FROM raw_order_items JOIN stg_products USING (product_id) JOIN raw_sellers USING (seller_id)""",
    "stg_order_reviews": f"""
SELECT *, NOT (review_comment_title IS NULL AND review_comment_message IS NULL) AS has_comment,
 {hours("review_creation_date", "review_answer_timestamp")} AS review_response_delay_hours,
 CASE review_score WHEN 5 THEN 'positive' WHEN 4 THEN 'positive' WHEN 3 THEN 'neutral' ELSE 'negative' END AS review_score_category
FROM raw_order_reviews""",
    # analytics
    "moments": """
SELECT unnest([order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date]) AS m FROM raw_orders
UNION ALL SELECT unnest([review_creation_date, review_answer_timestamp]) FROM raw_order_reviews""",
    "dim_date": """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
 CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
 monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day,
 dayname(d) AS day_name, isodow(d) > 5 AS is_weekend
FROM (SELECT CAST(unnest(range(CAST(CAST(min(m) AS DATE) AS TIMESTAMP),
        CAST(CAST(max(m) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM moments)""",
    "dim_geography": """
SELECT geolocation_zip_code_prefix, avg_latitude AS latitude, avg_longitude AS longitude,
 representative_city AS city, representative_state AS state FROM stg_geolocation""",
    "dim_customer": """
SELECT c.*, z.avg_latitude AS latitude, z.avg_longitude AS longitude
FROM raw_customers c LEFT JOIN zip_point z ON z.zip = c.customer_zip_code_prefix""",
    "dim_seller": """
SELECT s.*, z.avg_latitude AS latitude, z.avg_longitude AS longitude
FROM raw_sellers s LEFT JOIN zip_point z ON z.zip = s.seller_zip_code_prefix""",
    "fact_orders": f"""
SELECT order_id, customer_id, {key("order_purchase_timestamp")} AS purchase_date_key, order_status,
 approval_delay_hours, carrier_delay_hours, delivery_time_hours, delivery_vs_estimated_hours,
 {key("order_delivered_customer_date")} > {key("order_estimated_delivery_date")} AS delivered_late
FROM stg_orders""",
    "fact_order_items": f"""
SELECT i.order_id, order_item_id, product_id, seller_id, {key("o.order_purchase_timestamp")} AS purchase_date_key,
 price, freight_value, item_total_value
FROM stg_order_items i, raw_orders o WHERE o.order_id = i.order_id""",
    "fact_reviews": f"""
SELECT review_id, order_id, review_score, review_score_category, has_comment, review_response_delay_hours,
 {key("review_creation_date")} AS review_creation_date_key
FROM stg_order_reviews""",
    "item_sums": """
SELECT order_id, count(*) AS item_count, CAST(sum(price) AS DECIMAL(18,2)) AS product_value,
 CAST(sum(freight_value) AS DECIMAL(18,2)) AS freight_value, CAST(sum(price + freight_value) AS DECIMAL(18,2)) AS item_total_value
FROM stg_order_items GROUP BY order_id""",
    "payment_sums": """
SELECT order_id, CAST(sum(payment_value) AS DECIMAL(18,2)) AS payment_total FROM raw_order_payments GROUP BY order_id""",
    "sides": """
SELECT f.*, i.order_id AS i_id, p.order_id AS p_id, ifnull(i.item_count, 0) AS item_count,
 ifnull(i.product_value, 0.00) AS product_value, ifnull(i.freight_value, 0.00) AS freight_value,
 ifnull(i.item_total_value, 0.00) AS item_total_value, ifnull(p.payment_total, 0.00) AS payment_total,
 CAST(ifnull(p.payment_total, 0.00) - ifnull(i.item_total_value, 0.00) AS DECIMAL(18,2)) AS gap
FROM fact_orders f LEFT JOIN item_sums i USING (order_id) LEFT JOIN payment_sums p ON p.order_id = f.order_id""",
    "order_summary": """
SELECT order_id, customer_id, purchase_date_key, order_status, item_count,
 CAST(product_value AS DECIMAL(18,2)) AS product_value, CAST(freight_value AS DECIMAL(18,2)) AS freight_value,
 CAST(item_total_value AS DECIMAL(18,2)) AS item_total_value, CAST(payment_total AS DECIMAL(18,2)) AS payment_total,
 delivered_late, delivery_time_hours, delivery_vs_estimated_hours,
 CASE WHEN gap BETWEEN -0.01 AND 0.01 THEN 'reconciled'
      WHEN i_id IS NULL THEN 'payment_without_items' WHEN p_id IS NULL THEN 'items_without_payment'
      WHEN gap < 0 THEN 'items_greater_than_payment' ELSE 'payment_greater_than_items' END AS reconciliation_status,
 gap AS reconciliation_difference
FROM sides""",
    # marts
    "delivery_performance": """
SELECT f.order_id, f.customer_id, c.customer_state, f.purchase_date_key, f.order_status, f.delivered_late,
 f.delivery_time_hours, f.delivery_vs_estimated_hours,
 CASE WHEN f.delivered_late IS NULL THEN
        CASE f.order_status WHEN 'delivered' THEN 'missing_delivery_date' WHEN 'canceled' THEN 'not_completed'
             WHEN 'unavailable' THEN 'not_completed' ELSE 'in_progress' END
      WHEN f.delivered_late THEN 'late' ELSE 'on_time_or_early' END AS delivery_category
FROM fact_orders f JOIN raw_customers c USING (customer_id)""",
    "named_items": """
SELECT f.*, ifnull(ifnull(p.product_category_name_english, p.product_category_name), 'unknown') AS category,
 p.category_translation_status
FROM fact_order_items f JOIN stg_products p USING (product_id)""",
    "category_performance": f"""
SELECT category, category_translation_status, count(DISTINCT order_id) AS order_count, count(*) AS item_count,
 CAST(sum(price) AS DECIMAL(28,2)) AS product_value, CAST(sum(freight_value) AS DECIMAL(28,2)) AS freight_value,
 CAST(sum(item_total_value) AS DECIMAL(28,2)) AS total_value,
 {rounded(cents("sum(price)"), "count(*) * 100", 2, "DECIMAL(10,2)")} AS avg_item_price,
 {rounded(cents("sum(freight_value)"), cents("sum(item_total_value)"), 4, "DECIMAL(5,4)")} AS freight_share
FROM named_items GROUP BY category, category_translation_status""",
    "person_orders": """
SELECT c.customer_unique_id, c.customer_state, s.*,
 strptime(CAST(s.purchase_date_key AS VARCHAR), '%Y%m%d')::DATE AS bought,
 row_number() OVER (PARTITION BY c.customer_unique_id ORDER BY s.purchase_date_key DESC, s.order_id DESC) AS recency
FROM order_summary s JOIN raw_customers c USING (customer_id)""",
    "person_scores": """
SELECT c.customer_unique_id, sum(r.review_score) AS points, count(*) AS reviews
FROM raw_order_reviews r JOIN raw_orders o USING (order_id) JOIN raw_customers c USING (customer_id) GROUP BY 1""",
    "customer_performance": f"""
SELECT t.customer_unique_id, any_value(t.customer_state) FILTER (WHERE recency = 1) AS customer_state,
 min(bought) AS first_purchase_date, max(bought) AS last_purchase_date, count(*) AS order_count,
 CAST(sum(item_count) AS BIGINT) AS item_count, CAST(sum(item_total_value) AS DECIMAL(28,2)) AS total_spent,
 {rounded(cents("sum(item_total_value)"), "count(*) FILTER (WHERE item_count > 0) * 100", 2, "DECIMAL(18,2)")} AS avg_order_value,
 count(*) FILTER (WHERE delivered_late IS NOT NULL) AS delivered_orders,
 count(*) FILTER (WHERE delivered_late) AS late_deliveries,
 {rounded("any_value(points)", "any_value(reviews)", 2, "DECIMAL(3,2)")} AS avg_review_score,
 count(*) > 1 AS is_repeat_customer
FROM person_orders t LEFT JOIN person_scores r ON r.customer_unique_id = t.customer_unique_id
GROUP BY t.customer_unique_id""",
    "payments_by_order": """
SELECT order_id, count(*) AS payment_count, string_agg(DISTINCT payment_type, '+' ORDER BY payment_type) AS payment_types,
 first(payment_type ORDER BY payment_value DESC, payment_sequential) AS main_payment_type,
 count(*) FILTER (WHERE payment_type = 'voucher') > 0 AS uses_voucher, max(payment_installments) AS max_installments
FROM raw_order_payments GROUP BY order_id""",
    "payment_analysis": """
SELECT s.order_id, s.purchase_date_key, c.customer_state, s.order_status, ifnull(p.payment_count, 0) AS payment_count,
 ifnull(p.payment_types, 'none') AS payment_types, ifnull(p.main_payment_type, 'none') AS main_payment_type,
 ifnull(p.uses_voucher, false) AS uses_voucher, p.max_installments,
 CASE WHEN p.order_id IS NULL THEN 'no_payment' WHEN max_installments = 0 THEN 'invalid_zero'
      WHEN max_installments > 10 THEN '11+' WHEN max_installments > 5 THEN '6-10'
      WHEN max_installments > 1 THEN '2-5' ELSE '1' END AS installment_band,
 s.payment_total, s.item_total_value, s.reconciliation_status, s.reconciliation_difference
FROM order_summary s JOIN raw_customers c USING (customer_id) LEFT JOIN payments_by_order p ON p.order_id = s.order_id""",
}
