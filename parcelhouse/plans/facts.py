"""Analytics facts and the order summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.functions.columns import TOTAL, day_key, rows
from parcelhouse.functions.labels import reconciliation_status
from parcelhouse.tables import PURCHASE_MONTH, shaped


def orders(staged_orders: DataFrame) -> DataFrame:
    """Late means a later day than promised; promises are midnights, so times would mislead."""
    delivered = F.to_date("order_delivered_customer_date")
    promised = F.to_date("order_estimated_delivery_date")
    keyed = staged_orders.withColumns(
        {
            "purchase_date_key": day_key("order_purchase_timestamp"),
            "delivered_late": delivered > promised,
        }
    )
    return shaped(keyed, "analytics.fact_orders")


def order_items(staged_items: DataFrame, staged_orders: DataFrame) -> DataFrame:
    """Items with the purchase day of their order, so they need no join to be dated."""
    dated = staged_orders.select(
        "order_id", day_key("order_purchase_timestamp").alias("purchase_date_key")
    )
    return shaped(staged_items.join(dated, "order_id"), "analytics.fact_order_items")


def payments(staged_payments: DataFrame) -> DataFrame:
    return shaped(staged_payments, "analytics.fact_payments")


def reviews(staged_reviews: DataFrame) -> DataFrame:
    keyed = staged_reviews.withColumn("review_creation_date_key", day_key("review_creation_date"))
    return shaped(keyed, "analytics.fact_reviews")


def by_month(fact: DataFrame, staged_orders: DataFrame) -> DataFrame:
    """A fact with the month of its order, by which it is stored; 0 if the order is unknown.

    The month is read off the purchase day where the fact has one, else looked up by order.
    """
    if "purchase_date_key" in fact.columns:
        return fact.withColumn(PURCHASE_MONTH, F.expr("CAST(purchase_date_key DIV 100 AS INT)"))
    bought = F.col("order_purchase_timestamp")
    months = staged_orders.select(
        "order_id", (F.year(bought) * 100 + F.month(bought)).alias(PURCHASE_MONTH))
    return fact.join(months, "order_id", "left").fillna(0, [PURCHASE_MONTH])


def items_per_order(fact_items: DataFrame) -> DataFrame:
    return fact_items.groupBy("order_id").agg(
        rows().alias("item_count"),
        F.sum("price").cast(TOTAL).alias("product_value"),
        F.sum("freight_value").cast(TOTAL).alias("freight_value"),
        F.sum("item_total_value").cast(TOTAL).alias("item_total_value"),
    )


def payment_groups(fact_payments: DataFrame) -> DataFrame:
    """All that is asked of an order's payments, in one grouping.

    The main type paid the largest amount, the first payment winning ties. The set of
    types per order is small however many payments there are.
    """
    largest = F.struct(F.col("payment_value"), -F.col("payment_sequential"))
    return fact_payments.groupBy("order_id").agg(
        F.sum("payment_value").cast(TOTAL).alias("payment_total"),
        rows().alias("payment_count"),
        F.array_join(F.array_sort(F.collect_set("payment_type")), "+").alias("payment_types"),
        F.max_by("payment_type", largest).alias("main_payment_type"),
        F.bool_or(F.col("payment_type") == "voucher").alias("uses_voucher"),
        F.max("payment_installments").alias("max_installments"),
    )


def payments_per_order(fact_payments: DataFrame) -> DataFrame:
    return payment_groups(fact_payments).select("order_id", "payment_total")


def order_sides(
    fact_orders: DataFrame, fact_items: DataFrame, payments: DataFrame
) -> DataFrame:
    """Item and payment totals side by side, one row per order, and whether they agree.

    `payments` are grouped by order; columns beyond the total are carried along. Both sides
    are summed to one row per order before the join; joined as they are, an order with 2
    items and 3 payments would become 6 rows.
    """
    items, paid = F.col("item_count").isNotNull(), F.col("payment_total").isNotNull()
    difference = F.col("payment_total") - F.col("item_total_value")
    return (
        fact_orders.join(items_per_order(fact_items), "order_id", "left")
        .join(payments, "order_id", "left")
        .withColumns({"holds_items": items, "is_paid": paid})
        .fillna(0, ["item_count", "product_value", "freight_value"])
        .fillna(0, ["item_total_value", "payment_total"])
        .withColumn("reconciliation_difference", difference)
        .withColumn("reconciliation_status", reconciliation_status(
            F.col("reconciliation_difference"), F.col("holds_items"), F.col("is_paid")))
    )


def order_summary(
    fact_orders: DataFrame, fact_items: DataFrame, fact_payments: DataFrame
) -> DataFrame:
    payments = payments_per_order(fact_payments)
    return shaped(order_sides(fact_orders, fact_items, payments), "analytics.order_summary")
