"""The labels that staging, analytics and marts put on a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and limits that stored tables and dashboards expect.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)
NEVER_COMPLETED = ("canceled", "unavailable")
RECONCILED = "reconciled"
TOLERANCE = "0.01"


def translation_status(name: Column, translated_name: Column) -> Column:
    return (
        F.when(name.isNull(), "no_category")
        .when(translated_name.isNull(), "missing_translation")
        .otherwise("translated")
    )


def score_category(score: Column) -> Column:
    return (
        F.when(score > 3, "positive")
        .when(score == 3, "neutral")
        .otherwise("negative")
    )


def delivery_category(late: Column, status: Column) -> Column:
    """A delivery result wins over the order status; the status explains a missing result."""
    without_result = (
        F.when(status.isin(*NEVER_COMPLETED), "not_completed")
        .when(status == "delivered", "missing_delivery_date")
        .otherwise("in_progress")
    )
    return F.when(late, "late").when(~late, "on_time_or_early").otherwise(without_result)


def reconciliation_status(difference: Column, has_items: Column, has_payments: Column) -> Column:
    """Within the tolerance counts as reconciled, even when one of the two sides is missing."""
    outside = (
        F.when(~has_items, "payment_without_items")
        .when(~has_payments, "items_without_payment")
        .when(difference > 0, "payment_greater_than_items")
        .otherwise("items_greater_than_payment")
    )
    close = F.abs(difference) <= F.lit(TOLERANCE).cast("decimal(3,2)")
    return F.when(close, RECONCILED).otherwise(outside)


def installment_band(most: Column) -> Column:
    return (
        F.when(most.isNull(), "no_payment")
        .when(most == 0, "invalid_zero")
        .when(most == 1, "1")
        .when(most <= 5, "2-5")
        .when(most <= 10, "6-10")
        .otherwise("11+")
    )


def shown_category(english: Column, original: Column) -> Column:
    return F.coalesce(english, original, F.lit("unknown"))
