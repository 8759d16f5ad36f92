"""Declared tables of every layer: columns, keys, parents and allowed values.

Column names, lengths and keys are fixed values: stored tables and dashboards depend on
them. Counts and totals are wider than one snapshot needs, so that one key holding much of
a very large table does not overflow them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from parcelhouse.functions.columns import AMOUNT, GRAND_TOTAL, TOTAL


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    length: int | None = None


@dataclass(frozen=True)
class Parent:
    """A foreign key."""

    columns: tuple[str, ...]
    table: str
    table_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    parents: tuple[Parent, ...] = ()
    between: dict[str, tuple[int, int]] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # A whole number per row by which stored files are kept apart; it is no column of the table.
    partition: str | None = None

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        fields = ", ".join(
            f"{c.name} {c.type}{' NOT NULL' if c.required else ''}" for c in self.columns
        )
        return T.StructType.fromDDL(fields)


def text(name, length=None, required=False):
    return Column(name, "string", required, length)


def column(name, kind, required=False):
    return Column(name, kind, required)


def refers(column_name, table, table_column=None):
    return Parent((column_name,), table, (table_column or column_name,))


CUSTOMER = (
    text("customer_id", 50, True),
    text("customer_unique_id", 50, True),
    column("customer_zip_code_prefix", "int", True),
    text("customer_city", 100, True),
    text("customer_state", 2, True),
)
SELLER = (
    text("seller_id", 50, True),
    column("seller_zip_code_prefix", "int", True),
    text("seller_city", 100, True),
    text("seller_state", 2, True),
)
PRODUCT_MEASURES = (
    column("product_name_length", "int"),
    column("product_description_length", "int"),
    column("product_photos_qty", "int"),
    column("product_weight_g", AMOUNT),
    column("product_length_cm", AMOUNT),
    column("product_height_cm", AMOUNT),
    column("product_width_cm", AMOUNT),
)
ORDER = (
    text("order_id", 50, True),
    text("customer_id", 50, True),
    text("order_status", 30, True),
    column("order_purchase_timestamp", "timestamp_ntz", True),
    column("order_approved_at", "timestamp_ntz"),
    column("order_delivered_carrier_date", "timestamp_ntz"),
    column("order_delivered_customer_date", "timestamp_ntz"),
    column("order_estimated_delivery_date", "timestamp_ntz", True),
)
ORDER_DURATIONS = (
    column("approval_delay_hours", "decimal(10,2)"),
    column("carrier_delay_hours", "decimal(10,2)"),
    column("delivery_time_hours", "decimal(10,2)"),
    column("delivery_vs_estimated_hours", "decimal(10,2)"),
)
ITEM = (
    text("order_id", 50, True),
    column("order_item_id", "bigint", True),
    text("product_id", 50, True),
    text("seller_id", 50, True),
    column("shipping_limit_date", "timestamp_ntz", True),
    column("price", AMOUNT, True),
    column("freight_value", AMOUNT, True),
)
PAYMENT = (
    text("order_id", 50, True),
    column("payment_sequential", "int", True),
    text("payment_type", 30, True),
    column("payment_installments", "int", True),
    column("payment_value", TOTAL, True),
)
REVIEW = (
    text("review_id", 50, True),
    text("order_id", 50, True),
    column("review_score", "int", True),
    text("review_comment_title", 500),
    text("review_comment_message"),
    column("review_creation_date", "timestamp_ntz"),
    column("review_answer_timestamp", "timestamp_ntz"),
)
PRODUCT_FULL = (
    text("product_id", 50, True),
    text("product_category_name", 100),
    text("product_category_name_english", 100),
    *PRODUCT_MEASURES,
    text("category_translation_status", 20, True),
)
# Facts are stored by the month in which their order was made, as YYYYMM.
PURCHASE_MONTH = "purchase_month"
POINT = (column("latitude", "decimal(10,7)"), column("longitude", "decimal(10,7)"))

_DECLARED = (
    # raw: the files as delivered
    Table("raw.customers", CUSTOMER, ("customer_id",)),
    Table("raw.sellers", SELLER, ("seller_id",)),
    Table(
        "raw.category_translation",
        (
            text("product_category_name", 100, True),
            text("product_category_name_english", 100, True),
        ),
        ("product_category_name",),
    ),
    Table(
        "raw.products",
        (text("product_id", 50, True), text("product_category_name", 100), *PRODUCT_MEASURES),
        ("product_id",),
    ),
    Table(
        "raw.geolocation",
        (
            column("geolocation_id", "bigint", True),
            column("geolocation_zip_code_prefix", "int", True),
            column("geolocation_lat", "decimal(10,7)", True),
            column("geolocation_lng", "decimal(10,7)", True),
            text("geolocation_city", 100, True),
            text("geolocation_state", 2, True),
        ),
        ("geolocation_id",),
    ),
    Table(
        "raw.orders", ORDER, ("order_id",),
        parents=(refers("customer_id", "raw.customers"),),
    ),
    Table(
        "raw.order_items", ITEM, ("order_id", "order_item_id"),
        parents=(
            refers("order_id", "raw.orders"),
            refers("product_id", "raw.products"),
            refers("seller_id", "raw.sellers"),
        ),
    ),
    Table(
        "raw.order_payments", PAYMENT, ("order_id", "payment_sequential"),
        parents=(refers("order_id", "raw.orders"),),
    ),
    Table(
        "raw.order_reviews", REVIEW, ("review_id", "order_id"),
        parents=(refers("order_id", "raw.orders"),),
        between={"review_score": (1, 5)},
    ),
    # staging: cleaned and enriched, same grain except geolocation
    Table("staging.customers", CUSTOMER, ("customer_id",)),
    Table("staging.sellers", SELLER, ("seller_id",)),
    Table(
        "staging.geolocation",
        (
            column("geolocation_zip_code_prefix", "int", True),
            column("avg_latitude", "decimal(10,7)", True),
            column("avg_longitude", "decimal(10,7)", True),
            text("representative_city", 100),
            text("representative_state", 2),
        ),
        ("geolocation_zip_code_prefix",),
    ),
    Table("staging.products", PRODUCT_FULL, ("product_id",)),
    Table("staging.orders", (*ORDER, *ORDER_DURATIONS), ("order_id",)),
    Table(
        "staging.order_items",
        (
            *ITEM,
            text("product_category_name", 100),
            text("product_category_name_english", 100),
            text("seller_city", 100),
            text("seller_state", 2),
            column("item_total_value", AMOUNT, True),
        ),
        ("order_id", "order_item_id"),
        parents=(
            refers("order_id", "staging.orders"),
            refers("product_id", "staging.products"),
            refers("seller_id", "staging.sellers"),
        ),
    ),
    Table(
        "staging.order_payments", PAYMENT, ("order_id", "payment_sequential"),
        parents=(refers("order_id", "staging.orders"),),
    ),
    Table(
        "staging.order_reviews",
        (
            *REVIEW,
            column("has_comment", "boolean", True),
            column("review_response_delay_hours", "decimal(10,2)"),
            text("review_score_category", 20, True),
        ),
        ("review_id", "order_id"),
        parents=(refers("order_id", "staging.orders"),),
        between={"review_score": (1, 5)},
    ),
    # analytics: dimensions, facts and the order summary
    Table(
        "analytics.dim_date",
        (
            column("date_key", "int", True),
            column("full_date", "date", True),
            column("year", "int", True),
            column("quarter", "int", True),
            column("month", "int", True),
            text("month_name", 20, True),
            column("week", "int", True),
            column("day", "int", True),
            text("day_name", 20, True),
            column("is_weekend", "boolean", True),
        ),
        ("date_key",),
        unique=(("full_date",),),
    ),
    Table(
        "analytics.dim_geography",
        (
            column("geolocation_zip_code_prefix", "int", True),
            column("latitude", "decimal(10,7)", True),
            column("longitude", "decimal(10,7)", True),
            text("city", 100),
            text("state", 2),
        ),
        ("geolocation_zip_code_prefix",),
    ),
    Table("analytics.dim_customer", (*CUSTOMER, *POINT), ("customer_id",)),
    Table("analytics.dim_seller", (*SELLER, *POINT), ("seller_id",)),
    Table("analytics.dim_product", PRODUCT_FULL, ("product_id",)),
    Table(
        "analytics.fact_orders",
        (
            text("order_id", 50, True),
            text("customer_id", 50, True),
            column("purchase_date_key", "int", True),
            text("order_status", 30, True),
            *ORDER_DURATIONS,
            column("delivered_late", "boolean"),
        ),
        ("order_id",),
        partition=PURCHASE_MONTH,
        parents=(
            refers("customer_id", "analytics.dim_customer"),
            refers("purchase_date_key", "analytics.dim_date", "date_key"),
        ),
    ),
    Table(
        "analytics.fact_order_items",
        (
            text("order_id", 50, True),
            column("order_item_id", "bigint", True),
            text("product_id", 50, True),
            text("seller_id", 50, True),
            column("purchase_date_key", "int", True),
            column("price", AMOUNT, True),
            column("freight_value", AMOUNT, True),
            column("item_total_value", AMOUNT, True),
        ),
        ("order_id", "order_item_id"),
        partition=PURCHASE_MONTH,
        parents=(
            refers("order_id", "analytics.fact_orders"),
            refers("product_id", "analytics.dim_product"),
            refers("seller_id", "analytics.dim_seller"),
            refers("purchase_date_key", "analytics.dim_date", "date_key"),
        ),
    ),
    Table(
        "analytics.fact_payments", PAYMENT, ("order_id", "payment_sequential"),
        partition=PURCHASE_MONTH,
        parents=(refers("order_id", "analytics.fact_orders"),),
    ),
    Table(
        "analytics.fact_reviews",
        (
            text("review_id", 50, True),
            text("order_id", 50, True),
            column("review_score", "int", True),
            text("review_score_category", 20, True),
            column("has_comment", "boolean", True),
            column("review_response_delay_hours", "decimal(10,2)"),
            column("review_creation_date_key", "int"),
        ),
        ("review_id", "order_id"),
        partition=PURCHASE_MONTH,
        parents=(
            refers("order_id", "analytics.fact_orders"),
            refers("review_creation_date_key", "analytics.dim_date", "date_key"),
        ),
    ),
    Table(
        "analytics.order_summary",
        (
            text("order_id", 50, True),
            text("customer_id", 50, True),
            column("purchase_date_key", "int", True),
            text("order_status", 30, True),
            column("item_count", "bigint", True),
            column("product_value", TOTAL, True),
            column("freight_value", TOTAL, True),
            column("item_total_value", TOTAL, True),
            column("payment_total", TOTAL, True),
            column("delivered_late", "boolean"),
            column("delivery_time_hours", "decimal(10,2)"),
            column("delivery_vs_estimated_hours", "decimal(10,2)"),
            text("reconciliation_status", 40),
            column("reconciliation_difference", TOTAL),
        ),
        ("order_id",),
    ),
    # marts: one table per business question
    Table(
        "marts.delivery_performance",
        (
            text("order_id", 50, True),
            text("customer_id", 50, True),
            text("customer_state", 2, True),
            column("purchase_date_key", "int", True),
            text("order_status", 30, True),
            column("delivered_late", "boolean"),
            column("delivery_time_hours", "decimal(10,2)"),
            column("delivery_vs_estimated_hours", "decimal(10,2)"),
            text("delivery_category", 30, True),
        ),
        ("order_id",),
    ),
    Table(
        "marts.category_performance",
        (
            text("category", 100, True),
            text("category_translation_status", 20, True),
            column("order_count", "bigint", True),
            column("item_count", "bigint", True),
            column("product_value", GRAND_TOTAL, True),
            column("freight_value", GRAND_TOTAL, True),
            column("total_value", GRAND_TOTAL, True),
            column("avg_item_price", "decimal(10,2)", True),
            column("freight_share", "decimal(5,4)", True),
        ),
        ("category",),
    ),
    Table(
        "marts.customer_performance",
        (
            text("customer_unique_id", 50, True),
            text("customer_state", 2, True),
            column("first_purchase_date", "date", True),
            column("last_purchase_date", "date", True),
            column("order_count", "bigint", True),
            column("item_count", "bigint", True),
            column("total_spent", GRAND_TOTAL, True),
            column("avg_order_value", TOTAL),
            column("delivered_orders", "bigint", True),
            column("late_deliveries", "bigint", True),
            column("avg_review_score", "decimal(3,2)"),
            column("is_repeat_customer", "boolean", True),
        ),
        ("customer_unique_id",),
    ),
    Table(
        "marts.payment_analysis",
        (
            text("order_id", 50, True),
            column("purchase_date_key", "int", True),
            text("customer_state", 2, True),
            text("order_status", 30, True),
            column("payment_count", "bigint", True),
            text("payment_types", 100, True),
            text("main_payment_type", 30, True),
            column("uses_voucher", "boolean", True),
            column("max_installments", "int"),
            text("installment_band", 20, True),
            column("payment_total", TOTAL, True),
            column("item_total_value", TOTAL, True),
            text("reconciliation_status", 40, True),
            column("reconciliation_difference", TOTAL, True),
        ),
        ("order_id",),
    ),
    # meta: the run log
    Table(
        "meta.pipeline_runs",
        (
            column("run_id", "bigint", True),
            column("started_at", "timestamp", True),
            column("finished_at", "timestamp"),
            text("status", 20, True),
            text("failed_step", 100),
            text("error_message"),
            column("duration_seconds", "decimal(10,1)"),
            column("rows_loaded", "bigint"),
            column("warnings", "int"),
        ),
        ("run_id",),
        allowed={"status": ("running", "succeeded", "failed")},
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _DECLARED}


def in_layer(layer: str) -> list[Table]:
    return [t for t in _DECLARED if t.layer == layer]


def shaped(df, name: str):
    """The declared columns, in declared order and type."""
    table = TABLES[name]
    return df.select(*[df[c.name].cast(c.type).alias(c.name) for c in table.columns])


__all__ = ["TABLES", "Column", "Parent", "Table", "in_layer", "shaped"]
