"""Dimensions, facts and the order summary on small hand-made tables."""

from datetime import date
from decimal import Decimal

import pytest

from comparing import rows
from parcelhouse.plans import dimensions, facts


def calendar(frame, *moments):
    orders = [{"order_id": i, "order_purchase_timestamp": m} for i, m in enumerate(moments)]
    return dimensions.date(frame("staging.orders", *orders), frame("staging.order_reviews"))


def test_calendar_is_inclusive_and_spans_years(frame):
    df = calendar(frame, "2016-12-31 23:59:59", "2017-01-02 00:00:00")
    assert rows(df) == {
        (20161231, date(2016, 12, 31), 2016, 4, 12, "December", 52, 31, "Saturday", True),
        (20170101, date(2017, 1, 1), 2017, 1, 1, "January", 52, 1, "Sunday", True),
        (20170102, date(2017, 1, 2), 2017, 1, 1, "January", 1, 2, "Monday", False),
    }


def test_calendar_covers_reviews_too(frame):
    orders = frame("staging.orders", {"order_id": "o", "order_purchase_timestamp": "2018-01-03 10:00:00"})
    reviews = frame("staging.order_reviews", {"review_id": "r", "review_answer_timestamp": "2018-01-05 01:00:00",
                                              "review_creation_date": "2018-01-02 00:00:00"})
    assert dimensions.date(orders, reviews).count() == 4


def test_calendar_without_moments_is_empty(frame):
    assert calendar(frame).count() == 0


def test_unknown_zip_prefix_keeps_the_row(frame):
    geo = frame("staging.geolocation", {"geolocation_zip_code_prefix": 1, "avg_latitude": "1", "avg_longitude": "2"})
    customers = frame("staging.customers", {"customer_id": "a", "customer_zip_code_prefix": 1},
                      {"customer_id": "b", "customer_zip_code_prefix": 2})
    assert rows(dimensions.customer(customers, geo), "customer_id", "latitude", "longitude") == {
        ("a", Decimal("1.0000000"), Decimal("2.0000000")), ("b", None, None)}
    sellers = frame("staging.sellers", {"seller_id": "s", "seller_zip_code_prefix": 7})
    assert rows(dimensions.seller(sellers, geo), "seller_id", "latitude") == {("s", None)}


@pytest.mark.parametrize("delivered,late", [
    ("2018-01-09 23:00:00", False), ("2018-01-10 14:00:00", False), ("2018-01-11 00:00:00", True),
    (None, None)])
def test_late_compares_days(frame, delivered, late):
    df = facts.orders(frame("staging.orders", {
        "order_id": "o", "order_purchase_timestamp": "2018-01-01 22:00:00",
        "order_delivered_customer_date": delivered, "order_estimated_delivery_date": "2018-01-10 00:00:00"}))
    assert rows(df, "purchase_date_key", "delivered_late") == {(20180101, late)}


def test_items_carry_the_day_of_their_order(frame):
    items = frame("staging.order_items", {"order_id": "o", "order_item_id": 1, "price": 1},
                  {"order_id": "lost", "order_item_id": 1})
    orders = frame("staging.orders", {"order_id": "o", "order_purchase_timestamp": "2018-03-09 00:00:00"})
    assert rows(facts.order_items(items, orders), "order_id", "purchase_date_key") == {("o", 20180309)}


def test_review_without_date_has_no_key(frame):
    df = facts.reviews(frame("staging.order_reviews", {"review_id": "r", "review_score": 1}))
    assert rows(df, "review_creation_date_key") == {(None,)}


def summary(frame, items, payments):
    orders = frame("analytics.fact_orders", {"order_id": "o", "customer_id": "c"})
    return facts.order_summary(
        orders,
        frame("analytics.fact_order_items", *[
            {"order_id": "o", "order_item_id": i, "price": p, "freight_value": f,
             "item_total_value": Decimal(p) + Decimal(f)} for i, (p, f) in enumerate(items)]),
        frame("analytics.fact_payments", *[
            {"order_id": "o", "payment_sequential": i, "payment_value": v}
            for i, v in enumerate(payments)]),
    )


@pytest.mark.parametrize("items,payments,status,difference", [
    ([("10", "1")], ["11.00"], "reconciled", "0.00"),
    ([("10", "1")], ["11.01"], "reconciled", "0.01"),
    ([("10", "1")], ["10.99"], "reconciled", "-0.01"),
    ([("10", "1")], ["11.02"], "payment_greater_than_items", "0.02"),
    ([("10", "1")], ["10.98"], "items_greater_than_payment", "-0.02"),
    ([], ["5"], "payment_without_items", "5.00"),
    ([("10", "1")], [], "items_without_payment", "-11.00"),
    ([], ["0"], "reconciled", "0.00"),      # the tolerance is tested first
    ([], [], "reconciled", "0.00"),
    ([("5", "1"), ("4", "1")], ["1", "2", "8"], "reconciled", "0.00"),
])
def test_reconciliation(frame, items, payments, status, difference):
    df = summary(frame, items, payments)
    assert rows(df, "item_count", "reconciliation_status", "reconciliation_difference") == {
        (len(items), status, Decimal(difference))}


def test_items_and_payments_do_not_multiply(frame):
    df = summary(frame, [("5", "1"), ("4", "1")], ["1", "2", "8"])
    assert rows(df, "product_value", "freight_value", "item_total_value", "payment_total") == {
        (Decimal("9.00"), Decimal("2.00"), Decimal("11.00"), Decimal("11.00"))}
