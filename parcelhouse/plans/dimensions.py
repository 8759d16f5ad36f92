"""Analytics dimensions: dates, places, customers, sellers and products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.functions.columns import day_key
from parcelhouse.tables import shaped

ORDER_MOMENTS = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)
REVIEW_MOMENTS = ("review_creation_date", "review_answer_timestamp")


def date_bounds(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """First and last day over all order and review moments: one scan per table, one row."""

    def span(df: DataFrame, moments: tuple[str, ...]) -> DataFrame:
        return df.agg(
            F.least(*[F.min(m) for m in moments]).alias("first"),
            F.greatest(*[F.max(m) for m in moments]).alias("last"),
        )

    both = span(orders, ORDER_MOMENTS).unionByName(span(reviews, REVIEW_MOMENTS))
    return both.agg(
        F.to_date(F.min("first")).alias("first_day"), F.to_date(F.max("last")).alias("last_day")
    )


def date(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row for every day between the bounds; no rows without any moment.

    The week is the ISO week, the year the calendar year.
    """
    one_day = F.expr("INTERVAL 1 DAY")
    days = date_bounds(orders, reviews).select(
        F.explode(F.sequence("first_day", "last_day", one_day)).alias("full_date")
    )
    day = F.col("full_date")
    calendar = days.withColumns(
        {
            "date_key": day_key("full_date"),
            "year": F.year(day),
            "quarter": F.quarter(day),
            "month": F.month(day),
            "month_name": F.date_format(day, "MMMM"),
            "week": F.weekofyear(day),
            "day": F.dayofmonth(day),
            "day_name": F.date_format(day, "EEEE"),
            "is_weekend": F.weekday(day) >= 5,
        }
    )
    return shaped(calendar, "analytics.dim_date")


def geography(geolocation: DataFrame) -> DataFrame:
    renamed = geolocation.withColumnsRenamed(
        {
            "avg_latitude": "latitude",
            "avg_longitude": "longitude",
            "representative_city": "city",
            "representative_state": "state",
        }
    )
    return shaped(renamed, "analytics.dim_geography")


def _located(df: DataFrame, zip_column: str, geolocation: DataFrame) -> DataFrame:
    """Coordinates of the ZIP prefix, NULL where it is unknown."""
    points = geolocation.select(
        F.col("geolocation_zip_code_prefix").alias(zip_column),
        F.col("avg_latitude").alias("latitude"),
        F.col("avg_longitude").alias("longitude"),
    )
    return df.join(points, zip_column, "left")


def customer(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    located = _located(customers, "customer_zip_code_prefix", geolocation)
    return shaped(located, "analytics.dim_customer")


def seller(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    located = _located(sellers, "seller_zip_code_prefix", geolocation)
    return shaped(located, "analytics.dim_seller")


def product(products: DataFrame) -> DataFrame:
    return shaped(products, "analytics.dim_product")
