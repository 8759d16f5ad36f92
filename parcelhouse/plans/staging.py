"""Staging: cleaned and enriched, at the same grain as raw, except one row per ZIP prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.functions.columns import hours_between, quotient
from parcelhouse.functions.labels import score_category, translation_status
from parcelhouse.operators.grouping import most_common, with_counts
from parcelhouse.tables import shaped

ZIP = "geolocation_zip_code_prefix"


def customers(raw_customers: DataFrame) -> DataFrame:
    return shaped(raw_customers, "staging.customers")


def sellers(raw_sellers: DataFrame) -> DataFrame:
    return shaped(raw_sellers, "staging.sellers")


def order_payments(raw_payments: DataFrame) -> DataFrame:
    return shaped(raw_payments, "staging.order_payments")


def geolocation(points: DataFrame) -> DataFrame:
    """Mean point, most common city and (separately) most common state of each ZIP prefix.

    Points are first counted per ZIP prefix, city and state, which shrinks them by orders
    of magnitude before the second and third step see them.
    """
    spots = with_counts(
        points, ZIP, "geolocation_city", "geolocation_state",
        lat=F.col("geolocation_lat"), lng=F.col("geolocation_lng"),
    )
    # Every spot votes once for its city, carrying the sums, and once for its state.
    city_vote = F.struct(
        F.lit("city").alias("kind"), F.col("geolocation_city").alias("value"),
        "n", "lat", "lng",
    )
    no_sum = F.lit(None).cast("decimal(20,7)")
    state_vote = F.struct(
        F.lit("state").alias("kind"), F.col("geolocation_state").alias("value"),
        F.col("n"), no_sum.alias("lat"), no_sum.alias("lng"),
    )
    votes = spots.select(ZIP, F.inline(F.array(city_vote, state_vote)))
    counted = votes.groupBy(ZIP, "kind", "value").agg(
        F.sum("n").alias("n"), F.sum("lat").alias("lat"), F.sum("lng").alias("lng")
    )
    is_city, is_state = F.col("kind") == "city", F.col("kind") == "state"
    points_here = F.sum(F.when(is_city, F.col("n")))
    grouped = counted.groupBy(ZIP).agg(
        quotient(F.sum("lat"), points_here, 7, "decimal(10,7)", scale=7).alias("avg_latitude"),
        quotient(F.sum("lng"), points_here, 7, "decimal(10,7)", scale=7).alias("avg_longitude"),
        most_common(F.col("value"), F.col("n"), is_city).alias("representative_city"),
        most_common(F.col("value"), F.col("n"), is_state).alias("representative_state"),
    )
    return shaped(grouped, "staging.geolocation")


def products(raw_products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name and why it is missing, if it is."""
    english = F.col("product_category_name_english")
    named = raw_products.join(translation, "product_category_name", "left").withColumn(
        "category_translation_status", translation_status(F.col("product_category_name"), english)
    )
    return shaped(named, "staging.products")


def orders(raw_orders: DataFrame) -> DataFrame:
    """Orders with the hours between their stages; NULL means a stage was not reached."""
    purchased, approved = "order_purchase_timestamp", "order_approved_at"
    delivered, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    timed = raw_orders.withColumns(
        {
            "approval_delay_hours": hours_between(purchased, approved),
            "carrier_delay_hours": hours_between(approved, "order_delivered_carrier_date"),
            "delivery_time_hours": hours_between(purchased, delivered),
            "delivery_vs_estimated_hours": hours_between(promised, delivered),
        }
    )
    return shaped(timed, "staging.orders")


def order_items(raw_items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with their category, seller location and line total."""
    category = products.select(
        "product_id", "product_category_name", "product_category_name_english"
    )
    place = sellers.select("seller_id", "seller_city", "seller_state")
    enriched = (
        raw_items.join(category, "product_id")
        .join(place, "seller_id")
        .withColumn("item_total_value", F.col("price") + F.col("freight_value"))
    )
    return shaped(enriched, "staging.order_items")


def order_reviews(raw_reviews: DataFrame) -> DataFrame:
    title, message = F.col("review_comment_title"), F.col("review_comment_message")
    judged = raw_reviews.withColumns(
        {
            "has_comment": F.coalesce(title, message).isNotNull(),
            "review_response_delay_hours": hours_between(
                "review_creation_date", "review_answer_timestamp"
            ),
            "review_score_category": score_category(F.col("review_score")),
        }
    )
    return shaped(judged, "staging.order_reviews")
