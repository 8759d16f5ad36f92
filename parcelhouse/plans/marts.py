"""Marts: delivery, categories, customers and payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.functions.columns import TOTAL, day_of, quotient, rows
from parcelhouse.functions.labels import delivery_category, installment_band, shown_category
from parcelhouse.plans.facts import payment_groups
from parcelhouse.tables import shaped


def delivery_performance(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Was each order delivered on time, and if there is no result, why not?"""
    states = dim_customer.select("customer_id", "customer_state")
    judged = fact_orders.join(states, "customer_id").withColumn(
        "delivery_category", delivery_category(F.col("delivered_late"), F.col("order_status"))
    )
    return shaped(judged, "marts.delivery_performance")


def category_performance(fact_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Which categories earn the most? An order counts once in each of its categories.

    Every item gives its order once, without its money, and its money once, without its order.
    Orders are reduced to one row per category and order first, which makes their count a plain
    count and spreads a category with much of the table over all its orders. Money is reduced
    to one row per category before the shuffle, so that orders travel without sums.
    """
    named = dim_product.select(
        "product_id",
        shown_category(
            F.col("product_category_name_english"), F.col("product_category_name")
        ).alias("category"),
        "category_translation_status",
    )
    group = ["category", "category_translation_status"]
    sold, money = fact_items.join(named, "product_id"), ("price", "freight_value", "item_total_value")
    order = F.struct(
        F.lit(True).alias("is_order"), F.col("order_id").alias("order"), F.lit(0).alias("items"),
        *[F.lit(None).cast(sold.schema[c].dataType).alias(c) for c in money])
    amounts = F.struct(
        F.lit(False).alias("is_order"), F.lit(None).cast("string").alias("order"),
        F.lit(1).alias("items"), *money)
    reduced = sold.select(*group, F.inline(F.array(order, amounts))).groupBy(
        *group, "is_order", "order",
    ).agg(F.sum("items").alias("n"), *[F.sum(c).alias(c) for c in money])
    price, freight, total = [F.sum(c) for c in money]
    grouped = reduced.groupBy(*group).agg(
        F.count_if("is_order").alias("order_count"),
        F.sum("n").alias("item_count"),
        price.alias("product_value"),
        freight.alias("freight_value"),
        total.alias("total_value"),
        quotient(price, F.sum("n"), 2, "decimal(10,2)").alias("avg_item_price"),
        quotient(freight, total, 4, "decimal(5,4)").alias("freight_share"),
    )
    return shaped(grouped, "marts.category_performance")


def customer_performance(
    order_summary: DataFrame, dim_customer: DataFrame, fact_reviews: DataFrame
) -> DataFrame:
    """Who are the customers, how much do they spend, and do they come back?

    One row per person. Review scores are summed to one row per order first, so that they
    travel with the order through the join to its customer and one grouping by person
    yields orders, money, latest state and reviews together. The day is read off its key,
    which the audits hold to the calendar, so the calendar is not joined.
    """
    scores = fact_reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("scores")
    )
    people = dim_customer.select("customer_id", "customer_unique_id", "customer_state")
    bought = (
        order_summary.select(
            "order_id", "customer_id", day_of("purchase_date_key").alias("bought_on"),
            "item_count", "item_total_value", "delivered_late",
        )
        .join(scores, "order_id", "left")
        .join(people, "customer_id")
    )
    with_items = F.count_if(F.col("item_count") > 0)
    spent = F.sum("item_total_value")
    grouped = bought.groupBy("customer_unique_id").agg(
        F.max_by("customer_state", F.struct("bought_on", "order_id")).alias("customer_state"),
        F.min("bought_on").alias("first_purchase_date"),
        F.max("bought_on").alias("last_purchase_date"),
        rows().alias("order_count"),
        F.sum("item_count").alias("item_count"),
        spent.alias("total_spent"),
        quotient(spent, F.nullif(with_items, F.lit(0)), 2, TOTAL).alias("avg_order_value"),
        F.count("delivered_late").alias("delivered_orders"),
        F.count_if("delivered_late").alias("late_deliveries"),
        # Sums of no scores are NULL, and so is the mean of a person without reviews.
        quotient(F.sum("score_sum"), F.sum("scores"), 2, "decimal(3,2)").alias("avg_review_score"),
        (rows() > 1).alias("is_repeat_customer"),
    )
    return shaped(grouped, "marts.customer_performance")


def payments_by_order(fact_payments: DataFrame) -> DataFrame:
    """How each order was paid."""
    return payment_groups(fact_payments).drop("payment_total")


def payment_analysis(
    order_summary: DataFrame, dim_customer: DataFrame, fact_payments: DataFrame
) -> DataFrame:
    """How do customers pay, and which orders do not reconcile? Every order has a row."""
    # The state is looked up first, while orders are still without how they were paid.
    states = dim_customer.select("customer_id", "customer_state")
    located = order_summary.join(states, "customer_id")
    return _analysed(located.join(payments_by_order(fact_payments), "order_id", "left"))


def analysed_payments(paid_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """The same from orders that already carry how they were paid."""
    states = dim_customer.select("customer_id", "customer_state")
    return _analysed(paid_orders.join(states, "customer_id"))


def _analysed(paid_orders: DataFrame) -> DataFrame:
    paid = (
        paid_orders
        .fillna({"payment_count": 0, "uses_voucher": False})
        .fillna("none", ["payment_types", "main_payment_type"])
        .withColumn("installment_band", installment_band(F.col("max_installments")))
    )
    return shaped(paid, "marts.payment_analysis")
