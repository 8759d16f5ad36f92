"""Report figures, read from marts and analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelhouse.functions.columns import GRAND_TOTAL, quotient, ratio, rows
from parcelhouse.functions.labels import NEVER_COMPLETED, RECONCILED, shown_category


def _late() -> Column:
    return F.count_if("delivered_late")


def _judged() -> Column:
    """Orders with a delivery result."""
    return F.count("delivered_late")


def _mean(total: Column, count: Column, places: int = 2) -> Column:
    return quotient(total, F.nullif(count, F.lit(0)), places, f"decimal(18,{places})")


def figures(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Several aggregates of one table as rows (figure, value)."""
    one_row = df.agg(*[v.cast(GRAND_TOTAL).alias(name) for name, v in values.items()])
    return one_row.unpivot([], [f"`{name}`" for name in values], "figure", "value")


# Delivery

def late_rate(delivery: DataFrame) -> DataFrame:
    category = F.col("delivery_category")
    late, on_time = F.count_if(category == "late"), F.count_if(category == "on_time_or_early")
    return delivery.agg(
        late.alias("late_orders"), on_time.alias("on_time_orders"),
        (rows() - late - on_time).alias("orders_without_result"),
        ratio(late, late + on_time).alias("late_rate"),
    )


def _late_by(delivery: DataFrame, *keys) -> DataFrame:
    return delivery.groupBy(*keys).agg(
        _judged().alias("delivered_orders"), _late().alias("late_orders"),
        ratio(_late(), _judged()).alias("late_rate"),
    )


def late_rate_by_month(delivery: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Orders are first counted per day, so the calendar joins one row per day."""
    per_day = delivery.groupBy(F.col("purchase_date_key").alias("date_key")).agg(
        _judged().alias("judged"), _late().alias("late")
    )
    months = dim_date.select("date_key", "year", "month")
    judged, late = F.sum("judged"), F.sum("late")
    return per_day.join(months, "date_key").groupBy("year", "month").agg(
        judged.alias("delivered_orders"), late.alias("late_orders"),
        ratio(late, judged).alias("late_rate"),
    )


def late_rate_by_state(delivery: DataFrame) -> DataFrame:
    return _late_by(delivery, "customer_state")


def extreme_states(delivery: DataFrame) -> DataFrame:
    """The states with the lowest and the highest late rate, the first in order on a tie."""
    states = late_rate_by_state(delivery).where("late_rate IS NOT NULL")

    def first(order: Column, label: str) -> DataFrame:
        top = states.orderBy(order, "customer_state").limit(1)
        return top.withColumn("extreme", F.lit(label))

    return first(F.asc("late_rate"), "lowest").unionByName(first(F.desc("late_rate"), "highest"))


def delivery_categories(delivery: DataFrame) -> DataFrame:
    """Orders per category, those canceled after delivery, and a Total row."""
    canceled = F.col("order_status").isin(*NEVER_COMPLETED) & F.col("delivered_late").isNotNull()
    return delivery.rollup("delivery_category").agg(
        rows().alias("orders"), F.count_if(canceled).alias("canceled_after_delivery")
    ).fillna("Total", ["delivery_category"])


def lateness_basis(staged_orders: DataFrame) -> DataFrame:
    """Orders late by time of day, late by day, and those only the time makes late."""
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    by_time = F.count_if(F.col(delivered) > F.col(promised))
    by_day = F.count_if(F.to_date(delivered) > F.to_date(promised))
    return staged_orders.agg(
        by_time.alias("late_by_time"), by_day.alias("late_by_day"),
        (by_time - by_day).alias("late_by_time_only"),
    )


# Customers

def score_by_lateness(customers: DataFrame) -> DataFrame:
    """Mean review score of people with and without a late delivery, if anything reached them."""
    score = F.col("avg_review_score")
    return (
        customers.where("delivered_orders > 0")
        .groupBy((F.col("late_deliveries") > 0).alias("had_late_delivery"))
        .agg(rows().alias("customers"), _mean(F.sum(score), F.count(score)).alias("avg_score"))
    )


def repeat_share(customers: DataFrame) -> DataFrame:
    repeat = F.count_if("is_repeat_customer")
    return customers.agg(
        rows().alias("customers"), repeat.alias("repeat_customers"),
        ratio(repeat, rows()).alias("repeat_share"),
    )


def spend_by_repeat(customers: DataFrame) -> DataFrame:
    return customers.groupBy("is_repeat_customer").agg(
        rows().alias("customers"), _mean(F.sum("total_spent"), rows()).alias("avg_spent")
    )


def customer_summary(customers: DataFrame) -> DataFrame:
    return customers.agg(
        rows().alias("customers"),
        F.count_if("is_repeat_customer").alias("repeat_customers"),
        F.sum("order_count").alias("orders"),
        F.sum("total_spent").cast(GRAND_TOTAL).alias("total_spent"),
        F.count_if(F.col("avg_review_score").isNull()).alias("without_review"),
        F.count_if(F.col("avg_order_value").isNull()).alias("without_items"),
    )


def repeated_reviews_and_moves(fact_reviews: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders with several reviews, people seen in several states."""
    per_order = fact_reviews.groupBy("order_id").agg(rows().alias("n"))
    per_person = dim_customer.groupBy("customer_unique_id").agg(
        F.min("customer_state").alias("a"), F.max("customer_state").alias("z")
    )
    several = {"orders_with_several_reviews": F.count_if(F.col("n") > 1)}
    moved = {"customers_in_several_states": F.count_if(F.col("a") < F.col("z"))}
    return figures(per_order, several).unionByName(figures(per_person, moved))


# Categories and products

def freight_share(categories: DataFrame) -> DataFrame:
    freight, total = F.sum("freight_value"), F.sum("total_value")
    return categories.agg(
        freight.cast(GRAND_TOTAL).alias("freight_value"),
        total.cast(GRAND_TOTAL).alias("total_value"),
        _mean(freight, total, 4).alias("freight_share"),
    )


def freight_share_by_category(categories: DataFrame) -> DataFrame:
    return categories.select("category", "freight_share", "freight_value", "total_value")


def top_freight_shares(categories: DataFrame, k: int = 10) -> DataFrame:
    shares = freight_share_by_category(categories)
    return shares.orderBy(F.desc("freight_share"), "category").limit(k)


def top_categories(categories: DataFrame, k: int = 1) -> DataFrame:
    return (
        categories.select("category", "total_value", "order_count", "item_count")
        .orderBy(F.desc("total_value"), "category").limit(k)
    )


def translation_statuses(dim_product: DataFrame) -> DataFrame:
    return dim_product.groupBy("category_translation_status").agg(rows().alias("products"))


def category_summary(
    categories: DataFrame, fact_items: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """Sums over all categories, and how many orders have items in several of them."""
    status = F.col("category_translation_status")
    sums = {
        "categories": rows(),
        **{
            f"categories {name}": F.count_if(status == name)
            for name in ("translated", "missing_translation", "no_category")
        },
        "sum of item_count": F.sum("item_count"),
        "sum of order_count": F.sum("order_count"),
        "sum of total_value": F.sum("total_value"),
    }
    named = dim_product.select("product_id", shown_category(
        F.col("product_category_name_english"), F.col("product_category_name")
    ).alias("category"))
    per_order = fact_items.join(named, "product_id").groupBy("order_id").agg(
        F.min("category").alias("a"), F.max("category").alias("z")
    )
    spread = {
        "orders with items": rows(),
        "orders in several categories": F.count_if(F.col("a") < F.col("z")),
    }
    return figures(categories, sums).unionByName(figures(per_order, spread))


# Money and payments

def _with_share(grouped: DataFrame) -> DataFrame:
    """Share of all orders; the window sees one row per label."""
    all_orders = F.sum("orders").over(Window.partitionBy())
    return grouped.withColumn("share", ratio(F.col("orders"), all_orders))


def by_payment_type(payments: DataFrame) -> DataFrame:
    return _with_share(payments.groupBy("main_payment_type").agg(
        rows().alias("orders"), _mean(F.sum("payment_total"), rows()).alias("avg_payment")
    ))


def by_installment_band(payments: DataFrame) -> DataFrame:
    return payments.groupBy("installment_band").agg(
        rows().alias("orders"), _mean(F.sum("payment_total"), rows()).alias("avg_payment")
    )


def payments_without_items(payments: DataFrame) -> DataFrame:
    status = F.col("order_status")
    bucket = F.when(status.isin(*NEVER_COMPLETED), status).otherwise("other")
    return (
        payments.where("reconciliation_status = 'payment_without_items'")
        .groupBy(bucket.alias("status"))
        .agg(rows().alias("orders"), F.sum("payment_total").cast(GRAND_TOTAL).alias("amount"))
    )


def money_totals(order_summary: DataFrame) -> DataFrame:
    return figures(order_summary, {
        "product value": F.sum("product_value"),
        "freight": F.sum("freight_value"),
        "item total": F.sum("item_total_value"),
        "payment total": F.sum("payment_total"),
        "payments minus items": F.sum("reconciliation_difference"),
    })


def reconciled_share(order_summary: DataFrame) -> DataFrame:
    reconciled = F.count_if(F.col("reconciliation_status") == RECONCILED)
    return order_summary.agg(
        rows().alias("orders"), reconciled.alias("reconciled_orders"),
        ratio(reconciled, rows()).alias("reconciled_share"),
    )


def reconciliation(order_summary: DataFrame) -> DataFrame:
    return _with_share(order_summary.groupBy("reconciliation_status").agg(
        rows().alias("orders"),
        F.sum("reconciliation_difference").cast(GRAND_TOTAL).alias("net_difference"),
    ))


def fan_out(fact_items: DataFrame, fact_payments: DataFrame) -> DataFrame:
    """By how much a direct join of items and payments would overstate item value.

    Each item would be repeated once per payment of its order, so the joined sum is the
    order's item value times its payments: no pair of rows is ever formed.
    """
    # Products of two large counts need all the digits there are.
    value = F.sum("item_total_value").cast("decimal(25,2)")
    items = fact_items.groupBy("order_id").agg(value.alias("value"))
    paid = fact_payments.groupBy("order_id").agg(rows().cast("decimal(12,0)").alias("payments"))
    both = items.join(paid, "order_id", "left")
    widest = "decimal(38,2)"
    once = F.sum(F.col("value").cast(widest))
    joined = F.sum((F.col("value") * F.coalesce("payments", F.lit(0))).cast(widest))
    return both.agg(
        once.cast(widest).alias("true_value"),
        joined.cast(widest).alias("joined_value"),
        (joined - once).cast(widest).alias("overstated_by"),
    )


def warnings(checked: DataFrame) -> DataFrame:
    """Warning checks that found rows, most rows first."""
    return (
        checked.where("level = 'warning' AND failing_rows > 0")
        .select("check", "failing_rows").orderBy(F.desc("failing_rows"), "check")
    )


PUBLISHED = (
    "raw.geolocation", "staging.geolocation", "analytics.dim_product", "analytics.dim_date",
    "analytics.dim_customer", "analytics.dim_geography", "analytics.dim_seller",
    "analytics.fact_orders",
    "analytics.fact_order_items", "analytics.fact_payments", "analytics.fact_reviews",
)
