"""The expected result of each registered query."""

from __future__ import annotations

from oracles import with_blocks
from oracles.blocks import cents, rounded
from parcelhouse.tables import TABLES, in_layer

# The building block that holds each stored table.
BLOCK_OF = {
    **{t.name: "raw_" + t.name.split(".")[1] for t in in_layer("raw")},
    "staging.customers": "raw_customers",
    "staging.sellers": "raw_sellers",
    "staging.geolocation": "stg_geolocation",
    "staging.products": "stg_products",
    "staging.orders": "stg_orders",
    "staging.order_items": "stg_order_items",
    "staging.order_payments": "raw_order_payments",
    "staging.order_reviews": "stg_order_reviews",
    "analytics.dim_date": "dim_date",
    "analytics.dim_geography": "dim_geography",
    "analytics.dim_customer": "dim_customer",
    "analytics.dim_seller": "dim_seller",
    "analytics.dim_product": "stg_products",
    "analytics.fact_orders": "fact_orders",
    "analytics.fact_order_items": "fact_order_items",
    "analytics.fact_payments": "raw_order_payments",
    "analytics.fact_reviews": "fact_reviews",
    "analytics.order_summary": "order_summary",
    **{t.name: t.name.split(".")[1] for t in in_layer("marts")},
}
UNION = "\nUNION ALL\n"


def ratio(part: str, whole: str) -> str:
    return rounded(part, whole, 6, "DECIMAL(9,6)")


def mean(total: str, count: str, places: int = 2) -> str:
    return rounded(cents(total), f"({count}) * 100", places, f"DECIMAL(18,{places})")


def figures(pairs: dict[str, str], source: str) -> str:
    return UNION.join(
        f"SELECT '{name}' AS figure, CAST({value} AS DECIMAL(28,2)) AS value FROM {source}"
        for name, value in pairs.items()
    )


def _checks() -> dict[str, dict[str, tuple[str, str]]]:
    """Stage -> check -> (level, SQL of the number of failing rows)."""
    def rows(source: str, condition: str) -> str:
        return f"(SELECT count(*) FROM {source} WHERE {condition})"

    def differs(table: str, column: str, *others: tuple[str, str]) -> str:
        same = " AND ".join(
            f"(SELECT sum({column}) FROM {table}) = (SELECT sum({c}) FROM {t})" for t, c in others
        )
        return f"(SELECT CASE WHEN {same} THEN 0 ELSE 1 END)"

    def size_gap(one: str, other: str) -> str:
        return f"abs((SELECT count(*) FROM {one}) - (SELECT count(*) FROM {other}))"

    c, w = "critical", "warning"
    known = "'approved','canceled','created','delivered','invoiced','processing','shipped','unavailable'"
    return {
        "raw": {
            "raw_order_status_known": (c, rows("raw_orders", f"NOT order_status IN ({known})")),
            "raw_no_negative_money": (c, rows("raw_order_items", "least(price, freight_value) < 0")
                                      + " + " + rows("raw_order_payments", "payment_value < 0")),
            "raw_delivered_before_purchase": (c, rows(
                "raw_orders", "order_purchase_timestamp > order_delivered_customer_date")),
            "raw_review_answered_before_created": (c, rows(
                "raw_order_reviews", "review_creation_date > review_answer_timestamp")),
            "raw_carrier_before_approval": (w, rows(
                "raw_orders", "order_approved_at > order_delivered_carrier_date")),
            "raw_delivered_before_carrier": (w, rows(
                "raw_orders", "order_delivered_carrier_date > order_delivered_customer_date")),
            "raw_geolocation_outside_brazil": (w, rows(
                "raw_geolocation", "NOT (geolocation_lat >= -34 AND geolocation_lat <= 6 "
                "AND geolocation_lng >= -74 AND geolocation_lng <= -34)")),
            "raw_payment_type_not_defined": (w, rows(
                "raw_order_payments", "payment_type = 'not_defined'")),
            "raw_installments_below_one": (w, rows("raw_order_payments", "payment_installments <= 0")),
            "raw_products_without_category": (w, rows("raw_products", "product_category_name IS NULL")),
            "raw_products_without_dimensions": (w, rows(
                "raw_products", "product_weight_g + product_length_cm IS NULL")),
        },
        "staging": {
            "staging_no_rows_lost": (c, " + ".join(
                size_gap(BLOCK_OF[f"raw.{t}"], BLOCK_OF[f"staging.{t}"]) for t in (
                    "orders", "order_items", "order_payments", "order_reviews", "customers",
                    "sellers", "products"))),
            "staging_one_row_per_zip_prefix": (c, size_gap(
                "(SELECT DISTINCT geolocation_zip_code_prefix FROM raw_geolocation)",
                "stg_geolocation")),
            "staging_item_total_is_price_plus_freight": (c, rows(
                "stg_order_items", "item_total_value - price <> freight_value")),
            "staging_customers_without_coordinates": (w, rows(
                "raw_customers", "customer_zip_code_prefix NOT IN (SELECT zip FROM zip_point)")),
            "staging_sellers_without_coordinates": (w, rows(
                "raw_sellers", "seller_zip_code_prefix NOT IN (SELECT zip FROM zip_point)")),
        },
        "analytics": {
            "analytics_dim_date_has_no_gaps": (
                c, "(SELECT date_diff('day', min(full_date), max(full_date)) + 1 - count(*) FROM dim_date)"),
            "analytics_item_value_preserved": (c, differs(
                "stg_order_items", "item_total_value", ("fact_order_items", "item_total_value"),
                ("order_summary", "item_total_value"))),
            "analytics_payment_value_preserved": (c, differs(
                "raw_order_payments", "payment_value", ("order_summary", "payment_total"))),
            "analytics_every_order_reconciled": (c, rows(
                "order_summary", "reconciliation_status IS NULL")),
            "analytics_delivered_without_date": (w, rows(
                "raw_orders", "order_status = 'delivered' AND order_delivered_customer_date IS NULL")),
            "analytics_canceled_after_delivery": (w, rows(
                "raw_orders", "(order_status = 'canceled' OR order_status = 'unavailable') "
                "AND order_delivered_customer_date IS NOT NULL")),
            "analytics_orders_without_items": (w, rows(
                "raw_orders", "order_id NOT IN (SELECT order_id FROM raw_order_items)")),
        },
        "marts": {
            "marts_delivery_covers_every_order": (c, size_gap("raw_orders", "delivery_performance")),
            "marts_category_value_preserved": (c, differs(
                "category_performance", "total_value", ("fact_order_items", "item_total_value"))),
            "marts_customers_cover_every_order": (
                c, "abs((SELECT sum(order_count) FROM customer_performance) - (SELECT count(*) FROM raw_orders))"),
            "marts_payment_value_preserved": (c, differs(
                "payment_analysis", "payment_total", ("raw_order_payments", "payment_value"))),
        },
    }


def checks(*stages: str) -> str:
    found = UNION.join(
        f"SELECT '{name}' AS \"check\", '{stage}' AS stage, '{level}' AS level, "
        f"CAST({failing} AS BIGINT) AS failing_rows"
        for stage in stages for name, (level, failing) in _checks()[stage].items()
    )
    return (
        "SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' WHEN level = 'warning' THEN 'warn' "
        f"ELSE 'FAIL' END AS status FROM ({found}) AS found"
    )


STAGES = ("raw", "staging", "analytics", "marts")


def _table(name: str) -> str:
    return f"SELECT {', '.join(TABLES[name].names)} FROM {BLOCK_OF[name]}"


def _upsert(table: str, older: str, outdated: dict[str, str], newer: str) -> str:
    """Newer rows as they are; of the others the older ones, with their outdated values."""
    columns = ", ".join(
        f"CASE WHEN is_new THEN {c} ELSE {outdated[c]} END AS {c}" if c in outdated else c
        for c in TABLES[table].names
    )
    return (
        f"SELECT {columns} FROM (SELECT *, coalesce({newer}, false) AS is_new, "
        f"coalesce({older}, false) AS is_old FROM {BLOCK_OF[table]}) AS both_states "
        "WHERE is_new OR is_old"
    )


def _without_id(name: str):
    return [c for c in TABLES[name].columns if c.name != "geolocation_id"]


def _primary_keys() -> str:
    parts = []
    for name, block in BLOCK_OF.items():
        for columns in (TABLES[name].key, *TABLES[name].unique):
            label = f"SELECT '{name}' AS \"table\", '{', '.join(columns)}' AS \"key\", "
            if columns == ("geolocation_id",):  # generated when loading: no source column
                parts.append(label + "0 AS null_keys, 0 AS duplicate_keys, 0 AS surplus_rows")
                continue
            listed = ", ".join(columns)
            full = " AND ".join(f"{c} IS NOT NULL" for c in columns)
            parts.append(
                label + f"(SELECT count(*) FROM {block} WHERE NOT ({full})) AS null_keys, "
                "count(*) AS duplicate_keys, CAST(ifnull(sum(n - 1), 0) AS BIGINT) AS surplus_rows "
                f"FROM (SELECT {listed}, count(*) AS n FROM {block} WHERE {full} "
                f"GROUP BY {listed} HAVING count(*) > 1) AS repeated"
            )
    return (
        'SELECT "table", "key", CAST(null_keys AS BIGINT) AS null_keys, '
        "CAST(duplicate_keys AS BIGINT) AS duplicate_keys, CAST(surplus_rows AS BIGINT) "
        f"AS surplus_rows FROM ({UNION.join(parts)}) AS audited"
    )


def _foreign_keys() -> str:
    parts = []
    for name, block in BLOCK_OF.items():
        for parent in TABLES[name].parents:
            child, other = parent.columns[0], parent.table_columns[0]
            parts.append(
                f"SELECT '{name}' AS \"table\", '{child}' AS \"columns\", '{parent.table}' AS parent, "
                f"count(DISTINCT {child}) AS orphan_keys, count(*) AS orphan_rows FROM {block} "
                f"WHERE {child} NOT IN (SELECT {other} FROM {BLOCK_OF[parent.table]})"
            )
    return UNION.join(parts)


# The longest text of each text column, the same in every table that has it.
LENGTHS = {
    "customer_id": 50, "customer_unique_id": 50, "customer_city": 100, "customer_state": 2,
    "seller_id": 50, "seller_city": 100, "seller_state": 2,
    "product_id": 50, "product_category_name": 100, "product_category_name_english": 100,
    "category_translation_status": 20,
    "geolocation_city": 100, "geolocation_state": 2,
    "representative_city": 100, "representative_state": 2, "city": 100, "state": 2,
    "order_id": 50, "order_status": 30, "payment_type": 30,
    "review_id": 50, "review_comment_title": 500, "review_score_category": 20,
    "month_name": 20, "day_name": 20,
    "reconciliation_status": 40, "delivery_category": 30, "category": 100,
    "payment_types": 100, "main_payment_type": 30, "installment_band": 20,
}
# Columns that may be NULL, in every table or in the tables named.
NULLABLE = set("""
product_name_length product_description_length product_photos_qty product_weight_g product_length_cm
product_height_cm product_width_cm order_approved_at order_delivered_carrier_date
order_delivered_customer_date review_comment_title review_comment_message review_creation_date
review_answer_timestamp representative_city representative_state approval_delay_hours
carrier_delay_hours delivery_time_hours delivery_vs_estimated_hours review_response_delay_hours
city state delivered_late review_creation_date_key avg_order_value avg_review_score max_installments
""".split())
NULLABLE_IN = {
    "seller_city": ("staging.order_items",),
    "seller_state": ("staging.order_items",),
    "product_category_name": (
        "raw.products", "staging.products", "staging.order_items", "analytics.dim_product"),
    "product_category_name_english": (
        "staging.products", "staging.order_items", "analytics.dim_product"),
    "latitude": ("analytics.dim_customer", "analytics.dim_seller"),
    "longitude": ("analytics.dim_customer", "analytics.dim_seller"),
    "reconciliation_status": ("analytics.order_summary",),
    "reconciliation_difference": ("analytics.order_summary",),
}


def _domain_rules(name: str):
    """(column, rule, condition of a failing row) of a table, from the values above."""
    for c in TABLES[name].names:
        if c not in NULLABLE and name not in NULLABLE_IN.get(c, ()):
            yield c, "not null", f"{c} IS NULL"
        if c in LENGTHS:
            yield c, f"length <= {LENGTHS[c]}", f"length({c}) > {LENGTHS[c]}"
        if c == "review_score" and name != "analytics.fact_reviews":
            yield c, "between 1 and 5", f"{c} < 1 OR {c} > 5"


def _domains() -> str:
    parts = [
        _rule(name, block, *rule) for name, block in BLOCK_OF.items()
        for rule in _domain_rules(name) if rule[0] != "geolocation_id"
    ]
    parts.append("SELECT 'raw.geolocation', 'geolocation_id', 'not null', 0")
    return UNION.join(parts)


def _planted_domains() -> str:
    """Rows without any value, and rows whose texts are all of 600 characters."""
    parts = []
    for name, block in BLOCK_OF.items():
        key = TABLES[name].key[0]
        if key == "geolocation_id":  # generated when loading: its digits differ
            key = "geolocation_zip_code_prefix"
        empty, long = (
            f"regexp_matches(CAST({key} AS VARCHAR), '[{ends}]$')" for ends in ("5rRkKmM", "3dDoOeE"))
        for column, rule, _ in _domain_rules(name):
            if rule == "not null" and column != "geolocation_id":
                spared = f"OR {long}" if column in LENGTHS or column == "review_comment_message" else ""
                failing = f"{empty} OR ({column} IS NULL AND NOT ({empty} {spared}))"
            elif rule.startswith("length"):
                failing = f"{long} OR (NOT {empty} AND length({column}) > {LENGTHS[column]})"
            elif rule == "not null":
                failing = empty
            else:
                failing = f"NOT {empty} AND ({column} < 1 OR {column} > 5)"
            parts.append(_rule(name, block, column, rule, failing))
    return UNION.join(parts)


def _rule(name: str, block: str, column: str, rule: str, failing: str) -> str:
    return (
        f"SELECT '{name}' AS \"table\", '{column}' AS \"column\", '{rule}' AS rule, "
        f"count(*) AS failing_rows FROM {block} WHERE {failing}"
    )


def _value_rules(name: str, block: str) -> list[str]:
    return [
        _rule(name, block, column, f"between {low} and {high}",
              f"{column} < {low} OR {column} > {high}")
        for column, (low, high) in TABLES[name].between.items()
    ]


def _row_counts(names) -> str:
    return UNION.join(
        f"SELECT '{name}' AS \"table\", count(*) AS \"rows\" FROM {BLOCK_OF[name]}" for name in names
    )


def _profile() -> str:
    return UNION.join(
        f"SELECT '{t.name}' AS \"table\", '{c.name}' AS \"column\", '{c.type}' AS \"type\", "
        f"count(*) AS \"rows\", count(*) FILTER (WHERE {c.name} IS NULL) AS missing FROM {BLOCK_OF[t.name]}"
        for t in in_layer("raw") for c in _without_id(t.name)
    )


# What the faults planted in each table make of every critical check, written out by hand.
PLANTED = """
SELECT "check", split_part("check", '_', 1) AS stage, 'critical' AS level,
 CAST(failing_rows AS BIGINT) AS failing_rows, 'FAIL' AS status FROM (
SELECT 'raw_order_status_known' AS "check", count(*) AS failing_rows FROM raw_orders WHERE order_id LIKE '%7'
UNION ALL SELECT 'raw_no_negative_money', (SELECT count(*) FROM raw_order_items WHERE order_item_id = 1)
 + (SELECT count(*) FROM raw_order_payments WHERE payment_sequential = 3)
UNION ALL SELECT 'raw_delivered_before_purchase', count(*) FROM raw_orders
 WHERE order_id LIKE '%3' AND order_delivered_customer_date IS NOT NULL
UNION ALL SELECT 'raw_review_answered_before_created', count(*) FROM raw_order_reviews WHERE review_score = 1
UNION ALL SELECT 'staging_no_rows_lost', count(*) FROM raw_orders WHERE order_id LIKE '%5'
UNION ALL SELECT 'staging_one_row_per_zip_prefix', count(DISTINCT geolocation_zip_code_prefix)
 FROM raw_geolocation WHERE geolocation_zip_code_prefix < 100
UNION ALL SELECT 'staging_item_total_is_price_plus_freight', count(*) FROM raw_order_items WHERE order_item_id = 2
UNION ALL SELECT 'analytics_dim_date_has_no_gaps', count(*) FROM dim_date WHERE day(full_date) = 15
 AND full_date <> (SELECT min(full_date) FROM dim_date) AND full_date <> (SELECT max(full_date) FROM dim_date)
UNION ALL SELECT 'analytics_item_value_preserved', 1
UNION ALL SELECT 'analytics_payment_value_preserved', 1
UNION ALL SELECT 'analytics_every_order_reconciled', count(*) FROM raw_orders WHERE order_id LIKE '%9'
UNION ALL SELECT 'marts_delivery_covers_every_order', count(*) FROM raw_orders WHERE order_id LIKE '%1'
UNION ALL SELECT 'marts_category_value_preserved', 1
UNION ALL SELECT 'marts_customers_cover_every_order', count(DISTINCT customer_unique_id) FROM raw_customers
UNION ALL SELECT 'marts_payment_value_preserved', 1) AS found"""


def _gates(sound: str) -> str:
    """Both states of the tables: the sound ones stop no run, the broken ones stop every stage."""
    broken = (
        "SELECT s.stage, true AS stops, string_agg(\"check\", ', ' ORDER BY \"check\") AS failed_checks "
        f"FROM ({PLANTED}) AS s GROUP BY s.stage")
    names = f"SELECT stage, \"check\", status = 'warn' AS warns FROM ({sound}) AS c"
    # Two faults also set off a warning: early deliveries, and ZIP prefixes without a point.
    more = """
SELECT 'raw' AS stage, 'raw_delivered_before_carrier' AS "check", count(*) > 0 AS warns FROM raw_orders
 WHERE order_id LIKE '%3' AND order_delivered_customer_date IS NOT NULL AND order_delivered_carrier_date IS NOT NULL
UNION ALL SELECT 'staging', 'staging_customers_without_coordinates', count(*) > 0 FROM raw_customers
 WHERE customer_zip_code_prefix < 100"""
    warned = "SELECT stage, count(DISTINCT \"check\") FILTER (WHERE warns) AS warnings FROM ({}) AS n GROUP BY stage"
    return (
        f"SELECT stage, false AS stops, '' AS failed_checks, warnings, 'built' AS \"tables\" "
        f"FROM ({warned.format(names)}) AS w"
        f"{UNION}SELECT stage, stops, failed_checks, warnings, 'broken' AS \"tables\" "
        f"FROM ({broken}) AS b JOIN ({warned.format(names + UNION + more)}) AS v USING (stage)"
    )


# Primary keys by layer, written out from the tables' definitions.
KEYS = """
raw.customers: customer_id
raw.sellers: seller_id
raw.category_translation: product_category_name
raw.products: product_id
raw.geolocation: geolocation_id
raw.orders: order_id
raw.order_items: order_id, order_item_id
raw.order_payments: order_id, payment_sequential
raw.order_reviews: review_id, order_id
staging.customers: customer_id
staging.sellers: seller_id
staging.geolocation: geolocation_zip_code_prefix
staging.products: product_id
staging.orders: order_id
staging.order_items: order_id, order_item_id
staging.order_payments: order_id, payment_sequential
staging.order_reviews: review_id, order_id
analytics.dim_date: date_key
analytics.dim_geography: geolocation_zip_code_prefix
analytics.dim_customer: customer_id
analytics.dim_seller: seller_id
analytics.dim_product: product_id
analytics.fact_orders: order_id
analytics.fact_order_items: order_id, order_item_id
analytics.fact_payments: order_id, payment_sequential
analytics.fact_reviews: review_id, order_id
analytics.order_summary: order_id
marts.delivery_performance: order_id
marts.category_performance: category
marts.customer_performance: customer_unique_id
marts.payment_analysis: order_id
"""
# Foreign keys: child, column, parent.
PARENTS = """
raw.orders customer_id raw.customers
raw.order_items order_id raw.orders
raw.order_items product_id raw.products
raw.order_items seller_id raw.sellers
raw.order_payments order_id raw.orders
raw.order_reviews order_id raw.orders
staging.order_items order_id staging.orders
staging.order_items product_id staging.products
staging.order_items seller_id staging.sellers
staging.order_payments order_id staging.orders
staging.order_reviews order_id staging.orders
analytics.fact_orders customer_id analytics.dim_customer
analytics.fact_orders purchase_date_key analytics.dim_date
analytics.fact_order_items order_id analytics.fact_orders
analytics.fact_order_items product_id analytics.dim_product
analytics.fact_order_items seller_id analytics.dim_seller
analytics.fact_order_items purchase_date_key analytics.dim_date
analytics.fact_payments order_id analytics.fact_orders
analytics.fact_reviews order_id analytics.fact_orders
analytics.fact_reviews review_creation_date_key analytics.dim_date
"""


def _planted_keys() -> str:
    """Each key is there twice and once NULL; full_date, no part of a primary key, three times."""
    parts = [
        f"SELECT '{name}' AS \"table\", '{key}' AS \"key\", count(*) AS null_keys, "
        f"count(*) AS duplicate_keys, count(*) AS surplus_rows FROM {BLOCK_OF[name]}"
        for name, key in (line.split(": ") for line in KEYS.strip().splitlines())
    ]
    parts.append("SELECT 'analytics.dim_date', 'full_date', 0, count(*), 2 * count(*) FROM dim_date")
    return UNION.join(parts)


def _planted_orphans() -> str:
    return UNION.join(
        f"SELECT '{child}' AS \"table\", '{column}' AS \"columns\", '{parent}' AS parent, "
        f"count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows FROM {BLOCK_OF[child]} "
        f"WHERE regexp_matches(CAST({column} AS VARCHAR), '[13579]$')"
        for child, column, parent in (line.split() for line in PARENTS.strip().splitlines())
    )


def _queries() -> dict[str, str]:
    late = "count(*) FILTER (WHERE delivered_late)"
    judged = "count(*) FILTER (WHERE delivered_late IS NOT NULL)"
    out: dict[str, str] = {}

    # sources
    for t in in_layer("raw"):
        columns = ", ".join(c.name for c in _without_id(t.name))
        out[f"load_csv_{t.name.split('.')[1]}"] = f"SELECT {columns} FROM {BLOCK_OF[t.name]}"
    out["load_csv_bad_values"] = """
SELECT * REPLACE (CASE WHEN order_status NOT IN ('shipped', 'created') THEN order_approved_at END
                  AS order_approved_at) FROM raw_orders"""
    out["number_items_by_ranges"] = out["load_csv_order_items"]
    out["load_csv_byte_order_mark"] = out["load_csv_sellers"]
    out["load_csv_point_ids"] = """
SELECT count(*) AS points, count(*) AS ids FROM raw_geolocation"""
    # Numbers of columns as the tables' definitions have them.
    out["compare_row_counts"] = """
SELECT 'raw.customers' AS "table", count(*) AS "rows", (SELECT count(*) FROM orders) AS expected,
 count(*) = (SELECT count(*) FROM orders) AS ok FROM raw_customers
UNION ALL SELECT 'raw.order_items', count(*), (SELECT count(*) FROM lineitem),
 count(*) = (SELECT count(*) FROM lineitem) FROM raw_order_items
UNION ALL SELECT 'raw.products', count(*), (SELECT count(*) FROM part), true FROM raw_products
UNION ALL SELECT 'raw.sellers', count(*), (SELECT count(*) FROM supplier) + 1, false FROM raw_sellers
UNION ALL SELECT 'raw.orders', NULL, (SELECT count(*) FROM orders), false"""
    out["schema_conformance"] = """
SELECT * FROM (VALUES
  ('raw.customers', 5, NULL), ('raw.sellers', 4, 'seller_city'), ('raw.sellers', 4, 'seller_state'),
  ('raw.products', 9, NULL), ('raw.category_translation', 2, NULL), ('raw.geolocation', 6, NULL),
  ('raw.orders', 8, NULL), ('raw.order_items', 7, NULL), ('raw.order_payments', 5, NULL),
  ('raw.order_reviews', 7, NULL)) AS v("table", declared, missing_column)"""
    out["load_csv_stray_quotes"] = """
SELECT * REPLACE (review_id || '" or "x' AS review_comment_title, order_id || '" tv' AS review_comment_message)
FROM raw_order_reviews"""
    # One text column of every source table.
    out["load_csv_quoted_line_breaks"] = UNION.join(
        f"SELECT '{table}' AS \"table\", {column} || chr(10) || '\"x\", y' AS text, count(*) AS \"rows\" "
        f"FROM raw_{table} GROUP BY 2" for table, column in (
            ("customers", "customer_city"), ("sellers", "seller_city"),
            ("products", "product_category_name"), ("geolocation", "geolocation_city"),
            ("category_translation", "product_category_name_english"),
            ("orders", "order_status"), ("order_items", "seller_id"),
            ("order_payments", "payment_type"), ("order_reviews", "review_comment_message")))
    out["load_csv_decimal_integers"] = out["load_csv_products"]
    out["load_csv_long_texts"] = """
SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(source AS VARCHAR) AS order_id,
 lang AS review_comment_title, text AS review_comment_message FROM documents"""
    out["raw_load_counts"] = _row_counts(t.name for t in in_layer("raw"))
    out["table_profile"] = _profile()

    # tables
    for name in BLOCK_OF:
        if not name.startswith("raw."):
            out[name.replace("staging.", "staging_").split(".")[-1]] = _table(name)
    out["date_bounds"] = (
        "SELECT CAST(min(m) AS DATE) AS first_day, CAST(max(m) AS DATE) AS last_day FROM moments")
    out["items_per_order"] = "SELECT * FROM item_sums"
    out["payments_per_order"] = "SELECT * FROM payment_sums"
    out["payments_by_order"] = "SELECT * FROM payments_by_order"

    # upserts
    for table, older, outdated, newer in (
        ("dim_date", "year < 1997", {"month_name": "'old'"}, "year >= 1995"),
        ("dim_geography", "state <= '12'", {"city": "'old'"}, "state >= '07'"),
        ("dim_customer", "customer_state <= '12'", {"customer_city": "'old'"},
         "customer_state >= '07'"),
        ("dim_seller", "seller_state <= '12'", {"seller_city": "'old'"}, "seller_state >= '07'"),
        ("dim_product", "ifnull(product_photos_qty, 0) <= 4",
         {"category_translation_status": "'old'"}, "product_photos_qty >= 3"),
        ("fact_orders", "purchase_date_key < 19970101", {"order_status": "'old'"},
         "purchase_date_key >= 19950101"),
        ("fact_order_items", "purchase_date_key < 19970101",
         {"price": "CAST(0 AS DECIMAL(12,2))"}, "purchase_date_key >= 19950101"),
        ("fact_payments", "payment_type <> 'boleto'", {"payment_installments": "99"},
         "payment_type <> 'voucher'"),
        ("fact_reviews", "review_score <= 3", {"review_score_category": "'old'"},
         "review_score >= 2"),
    ):
        out[f"upsert_{table}"] = _upsert(f"analytics.{table}", older, outdated, newer)

    # checks and audits
    for stage in STAGES:
        out[f"dq_{stage}"] = checks(stage)
    out["dq_warnings_per_stage"] = (
        "SELECT stage, count(*) FILTER (WHERE status = 'warn') AS warnings "
        f"FROM ({checks(*STAGES)}) AS all_checks GROUP BY stage")
    out["report_warnings"] = (
        f"SELECT \"check\", failing_rows FROM ({checks(*STAGES)}) AS all_checks "
        "WHERE status = 'warn' ORDER BY failing_rows DESC, \"check\"")
    out["dq_planted_faults"] = PLANTED
    out["gate_outcome"] = _gates(checks(*STAGES))
    out["audit_planted_keys"] = _planted_keys()
    out["audit_planted_orphans"] = _planted_orphans()
    out["audit_planted_values"] = """
SELECT 'raw.order_reviews' AS "table", 'review_score' AS "column", 'between 1 and 5' AS rule,
 count(*) FILTER (WHERE review_score = 2) AS failing_rows FROM raw_order_reviews
UNION ALL SELECT 'staging.order_reviews', 'review_score', 'between 1 and 5',
 count(*) FILTER (WHERE review_score = 2) FROM stg_order_reviews
UNION ALL SELECT 'meta.pipeline_runs', 'status', 'in (running, succeeded, failed)', 1"""
    out["audit_primary_keys"] = _primary_keys()
    out["audit_foreign_keys"] = _foreign_keys()
    out["audit_domains"] = _domains()
    out["audit_planted_domains"] = _planted_domains()
    out["audit_value_checks"] = UNION.join([
        *(rule for name, block in BLOCK_OF.items() for rule in _value_rules(name, block)),
        "SELECT 'meta.pipeline_runs', 'status', 'in (running, succeeded, failed)', 0",
    ])
    out["audit_line_number_as_key"] = """
SELECT 0::BIGINT AS null_keys, count(*) AS duplicate_keys, CAST(ifnull(sum(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS repeated"""
    out["audit_payments_of_undelivered"] = """
SELECT order_id, count(*) AS n FROM raw_order_payments JOIN raw_orders USING (order_id)
WHERE order_status <> 'delivered' GROUP BY order_id"""

    # runs
    loaded = " + ".join(f"(SELECT count(*) FROM {BLOCK_OF[t.name]})" for t in in_layer("raw"))
    out["run_log"] = (
        "SELECT CAST(1 AS BIGINT) AS run_id, 'succeeded' AS status, CAST(NULL AS VARCHAR) AS failed_step, "
        f"CAST({loaded} AS BIGINT) AS rows_loaded, CAST((SELECT count(*) FROM ({checks(*STAGES)}) AS a "
        "WHERE status = 'warn') AS INTEGER) AS warnings")
    out["rerun_row_counts"] = _row_counts(BLOCK_OF)
    out["rerun_digests"] = (
        'SELECT "table", "rows" AS rows_before, "rows" AS rows_after, true AS same_rows '
        f"FROM ({_row_counts(BLOCK_OF)}) AS counted")
    out["version_history"] = (
        'SELECT "table", CAST(3 AS BIGINT) AS versions, CAST(2 AS BIGINT) AS versions_kept, '
        'CAST("rows" AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS missing_files, '
        f"CAST(0 AS BIGINT) AS unreachable_folders FROM ({_row_counts(BLOCK_OF)}) AS counted")
    warned = f"(SELECT count(*) FROM ({checks(*STAGES)}) AS a WHERE status = 'warn')"
    out["run_log_states"] = UNION.join(
        f"SELECT CAST({run} AS BIGINT) AS run_id, {status} AS status, {step} AS failed_step, "
        f"{error} AS error_message, CAST({rows} AS BIGINT) AS rows_loaded, "
        f"CAST({warnings} AS INTEGER) AS warnings, {finished} AS finished"
        for run, status, step, error, rows, warnings, finished in (
            (1, "'succeeded'", "NULL", "NULL", loaded, warned, "true"),
            (2, "'failed'", "'Check raw'",
             "'1 critical check(s) failed: raw_order_status_known'", loaded, 0, "true"),
            (3, "'failed'", "'Taken over'", "'taken over by run 4'", "NULL", "NULL", "true"),
            (4, "'succeeded'", "NULL", "NULL", loaded, warned, "true"),
            (5, "'running'", "NULL", "NULL", "NULL", "NULL", "false"),
        ))
    out["merge_linked_months"] = UNION.join(
        f"""SELECT 'analytics.{fact}' AS "table", CAST(count(DISTINCT m) AS INTEGER) AS months,
 CAST(count(DISTINCT m) - count(DISTINCT m) FILTER (WHERE comes) AS INTEGER) AS linked_months,
 ifnull(string_agg(DISTINCT CAST(m AS VARCHAR), ', ' ORDER BY CAST(m AS VARCHAR)) FILTER (WHERE comes), '')
  AS written_months, count(*) AS "rows"
FROM (SELECT m, m = 199603 OR (m = 199702 AND regexp_matches(order_id, '[13579]$')) AS comes
      FROM (SELECT order_id, year(order_purchase_timestamp) * 100 + month(order_purchase_timestamp) AS m
            FROM {source} JOIN raw_orders USING (order_id)) AS dated) AS marked"""
        for fact, source in {
            "fact_orders": "(SELECT order_id FROM raw_orders) AS o",
            "fact_order_items": "raw_order_items", "fact_payments": "raw_order_payments",
            "fact_reviews": "raw_order_reviews"}.items())

    # report figures
    out["report_late_rate"] = f"""
SELECT {late} AS late_orders, {judged} - {late} AS on_time_orders, count(*) - {judged} AS orders_without_result,
 {ratio(late, judged)} AS late_rate FROM fact_orders"""
    by = f"{judged} AS delivered_orders, {late} AS late_orders, {ratio(late, judged)} AS late_rate"
    out["report_late_rate_by_month"] = f"""
SELECT CAST(purchase_date_key // 10000 AS INTEGER) AS year, CAST(purchase_date_key // 100 % 100 AS INTEGER) AS month, {by}
FROM fact_orders GROUP BY 1, 2"""
    by_state = f"""
SELECT customer_state, {by} FROM fact_orders JOIN raw_customers USING (customer_id) GROUP BY customer_state"""
    out["report_late_rate_by_state"] = by_state
    out["report_extreme_states"] = f"""
SELECT customer_state, delivered_orders, late_orders, late_rate, e.extreme
FROM (SELECT *, row_number() OVER (ORDER BY late_rate, customer_state) AS up,
             row_number() OVER (ORDER BY late_rate DESC, customer_state) AS down
      FROM ({by_state}) AS states WHERE late_rate IS NOT NULL) AS ranked
JOIN (SELECT 'lowest' AS extreme UNION ALL SELECT 'highest') AS e
  ON (e.extreme = 'lowest' AND up = 1) OR (e.extreme = 'highest' AND down = 1)"""
    out["report_score_by_lateness"] = f"""
SELECT late_deliveries > 0 AS had_late_delivery, count(*) AS customers,
 {mean("sum(avg_review_score)", "count(avg_review_score)")} AS avg_score
FROM customer_performance WHERE delivered_orders > 0 GROUP BY 1"""
    out["report_repeat_share"] = f"""
SELECT count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
 {ratio("count(*) FILTER (WHERE n > 1)", "count(*)")} AS repeat_share
FROM (SELECT customer_unique_id, count(*) AS n FROM raw_customers GROUP BY 1) AS people"""
    out["report_spend_by_repeat"] = f"""
SELECT is_repeat_customer, count(*) AS customers, {mean("sum(total_spent)", "count(*)")} AS avg_spent
FROM customer_performance GROUP BY is_repeat_customer"""
    share = rounded(cents("sum(freight_value)"), cents("sum(item_total_value)"), 4, "DECIMAL(18,4)")
    out["report_freight_share"] = f"""
SELECT CAST(sum(freight_value) AS DECIMAL(28,2)) AS freight_value,
 CAST(sum(item_total_value) AS DECIMAL(28,2)) AS total_value, {share} AS freight_share FROM stg_order_items"""
    out["report_freight_share_by_category"] = """
SELECT category, freight_share, freight_value, total_value FROM category_performance"""
    out["report_top_freight_shares"] = """
SELECT category, freight_share, freight_value, total_value FROM category_performance
ORDER BY freight_share DESC, category LIMIT 10"""
    reconciled = "count(*) FILTER (WHERE reconciliation_status = 'reconciled')"
    out["report_reconciled_share"] = f"""
SELECT count(*) AS orders, {reconciled} AS reconciled_orders, {ratio(reconciled, "count(*)")} AS reconciled_share
FROM order_summary"""
    out["report_row_counts"] = _row_counts((
        "raw.geolocation", "staging.geolocation", "analytics.dim_product", "analytics.dim_date",
        "analytics.dim_customer", "analytics.dim_geography", "analytics.dim_seller",
        "analytics.fact_orders", "analytics.fact_order_items", "analytics.fact_payments",
        "analytics.fact_reviews"))
    ended = "count(*) FILTER (WHERE delivered_late IS NOT NULL AND order_status IN ('unavailable', 'canceled'))"
    out["report_delivery_categories"] = f"""
SELECT delivery_category, count(*) AS orders, {ended} AS canceled_after_delivery
FROM delivery_performance GROUP BY delivery_category
UNION ALL SELECT 'Total', count(*), {ended} FROM delivery_performance"""
    out["report_translation_statuses"] = """
SELECT category_translation_status, count(*) AS products FROM stg_products GROUP BY 1"""
    status = "count(*) FILTER (WHERE category_translation_status = '{}')"
    out["report_category_summary"] = figures({
        "categories": "count(*)",
        **{f"categories {s}": status.format(s)
           for s in ("translated", "missing_translation", "no_category")},
        "sum of item_count": "sum(item_count)",
        "sum of order_count": "sum(order_count)",
        "sum of total_value": "sum(total_value)",
    }, "category_performance") + UNION + figures({
        "orders with items": "count(*)",
        "orders in several categories": "count(*) FILTER (WHERE n > 1)",
    }, "(SELECT count(DISTINCT category) AS n FROM named_items GROUP BY order_id) AS per_order")
    out["report_top_categories"] = """
SELECT category, total_value, order_count, item_count FROM category_performance
ORDER BY total_value DESC, category LIMIT 1"""
    out["report_customer_summary"] = """
SELECT count(*) AS customers, count(*) FILTER (WHERE order_count > 1) AS repeat_customers,
 CAST(sum(order_count) AS BIGINT) AS orders, CAST(sum(total_spent) AS DECIMAL(28,2)) AS total_spent,
 count(*) FILTER (WHERE avg_review_score IS NULL) AS without_review,
 count(*) FILTER (WHERE item_count = 0) AS without_items FROM customer_performance"""
    all_orders = "(SELECT count(*) FROM raw_orders)"
    out["report_by_payment_type"] = f"""
SELECT main_payment_type, count(*) AS orders, {mean("sum(payment_total)", "count(*)")} AS avg_payment,
 {ratio("count(*)", all_orders)} AS share FROM payment_analysis GROUP BY main_payment_type"""
    out["report_by_installment_band"] = f"""
SELECT installment_band, count(*) AS orders, {mean("sum(payment_total)", "count(*)")} AS avg_payment
FROM payment_analysis GROUP BY installment_band"""
    out["report_payments_without_items"] = """
SELECT CASE order_status WHEN 'canceled' THEN 'canceled' WHEN 'unavailable' THEN 'unavailable' ELSE 'other' END AS status,
 count(*) AS orders, CAST(sum(payment_total) AS DECIMAL(28,2)) AS amount
FROM order_summary WHERE reconciliation_status = 'payment_without_items' GROUP BY 1"""
    out["report_money_totals"] = UNION.join([
        figures({"product value": "sum(price)", "freight": "sum(freight_value)",
                 "item total": "sum(item_total_value)"}, "stg_order_items"),
        figures({"payment total": "sum(payment_value)"}, "raw_order_payments"),
        figures({"payments minus items": "sum(gap)"}, "sides"),
    ])
    out["report_reconciliation"] = f"""
SELECT reconciliation_status, count(*) AS orders,
 CAST(sum(reconciliation_difference) AS DECIMAL(28,2)) AS net_difference,
 {ratio("count(*)", all_orders)} AS share FROM order_summary GROUP BY reconciliation_status"""
    out["report_lateness_basis"] = """
SELECT count(*) FILTER (WHERE delivery_vs_estimated_hours > 0 OR order_delivered_customer_date > order_estimated_delivery_date) AS late_by_time,
 count(*) FILTER (WHERE date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) > 0) AS late_by_day,
 count(*) FILTER (WHERE order_delivered_customer_date > order_estimated_delivery_date
   AND order_delivered_customer_date::DATE = order_estimated_delivery_date::DATE) AS late_by_time_only
FROM stg_orders"""
    out["report_fan_out"] = """
SELECT CAST(t.v AS DECIMAL(38,2)) AS true_value, CAST(j.v AS DECIMAL(38,2)) AS joined_value,
 CAST(j.v - t.v AS DECIMAL(38,2)) AS overstated_by
FROM (SELECT sum(item_total_value) AS v FROM fact_order_items) AS t,
 (SELECT sum(i.item_total_value) AS v FROM fact_order_items i JOIN raw_order_payments p ON p.order_id = i.order_id) AS j"""
    out["report_repeated_reviews_and_moves"] = figures(
        {"orders_with_several_reviews": "count(*) FILTER (WHERE n > 1)"},
        "(SELECT count(*) AS n FROM raw_order_reviews GROUP BY order_id) AS r",
    ) + UNION + figures(
        {"customers_in_several_states": "count(*) FILTER (WHERE n > 1)"},
        "(SELECT count(DISTINCT customer_state) AS n FROM raw_customers GROUP BY customer_unique_id) AS p",
    )
    return out


def expected_sql() -> dict[str, str]:
    return {name: with_blocks(sql) for name, sql in _queries().items()}
