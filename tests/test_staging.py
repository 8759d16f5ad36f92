"""Staging rules on small hand-made tables."""

from decimal import Decimal

import pytest

from comparing import rows
from parcelhouse.plans import staging


def point(zip_code, lat, lng, city, state):
    return {
        "geolocation_id": 0, "geolocation_zip_code_prefix": zip_code, "geolocation_lat": lat,
        "geolocation_lng": lng, "geolocation_city": city, "geolocation_state": state,
    }


def test_geolocation_city_and_state_are_chosen_apart(frame):
    df = staging.geolocation(frame(
        "raw.geolocation",
        point(1, "1", "10", "a", "SP"), point(1, "2", "20", "a", "SP"),
        point(1, "3", "30", "b", "RJ"), point(1, "4", "40", "c", "RJ"),
        point(1, "5", "50", "d", "RJ"),
    ))
    assert rows(df) == {(1, Decimal("3.0000000"), Decimal("30.0000000"), "a", "RJ")}


def test_geolocation_ties_go_to_the_smallest_in_byte_order(frame):
    df = staging.geolocation(frame(
        "raw.geolocation", point(1, "0", "0", "sao paulo", "SP"), point(1, "0", "0", "São Paulo", "SP"),
        point(1, "0", "0", "Sao Paulo", "SP"), point(2, "0", "0", "b", "RJ"),
        point(2, "0", "0", "B", "ES"),
    ))
    assert rows(df, "geolocation_zip_code_prefix", "representative_city", "representative_state") == {
        (1, "Sao Paulo", "SP"), (2, "B", "ES")}


@pytest.mark.parametrize("values,mean", [
    (("0.0000001", "0.0000002"), "0.0000002"),       # half, away from zero
    (("-0.0000001", "-0.0000002"), "-0.0000002"),
    (("0.0000001", "0.0000001", "0.0000002"), "0.0000001"),
    (("-23.1234567", "-23.1234566"), "-23.1234567"),
])
def test_geolocation_mean_is_exact(frame, values, mean):
    df = staging.geolocation(frame("raw.geolocation", *[point(1, v, v, "a", "SP") for v in values]))
    assert rows(df, "avg_latitude", "avg_longitude") == {(Decimal(mean), Decimal(mean))}


def test_product_translation_status(frame):
    products = frame(
        "raw.products", {"product_id": "p1", "product_category_name": "beleza"},
        {"product_id": "p2", "product_category_name": "pc_gamer"}, {"product_id": "p3"},
    )
    names = frame("raw.category_translation", {
        "product_category_name": "beleza", "product_category_name_english": "beauty"})
    df = staging.products(products, names)
    assert rows(df, "product_id", "product_category_name_english", "category_translation_status") == {
        ("p1", "beauty", "translated"), ("p2", None, "missing_translation"), ("p3", None, "no_category")}


def order(order_id="o1", **moments):
    return {"order_id": order_id, "customer_id": "c1", "order_status": "delivered",
            "order_purchase_timestamp": "2018-01-01 00:00:00",
            "order_estimated_delivery_date": "2018-01-10 00:00:00", **moments}


@pytest.mark.parametrize("approved,hours", [
    ("2018-01-01 01:00:00", "1.00"),
    ("2018-01-01 00:00:18", "0.01"),      # 0.005 hours
    ("2018-01-01 00:00:17", "0.00"),
    ("2017-12-31 23:59:42", "-0.01"),     # -0.005 hours
    ("2017-12-30 00:00:00", "-48.00"),
    ("2018-01-01 00:00:17.999999", "0.00"),
])
def test_order_durations_round_half_away_from_zero(frame, approved, hours):
    df = staging.orders(frame("raw.orders", order(order_approved_at=approved)))
    assert rows(df, "approval_delay_hours") == {(Decimal(hours),)}


def test_clock_changes_of_the_session_zone_do_not_matter(spark, frame):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        moments = {"order_purchase_timestamp": "2017-10-15 00:30:00",   # skipped by the clock there
                   "order_approved_at": "2017-10-15 01:30:00"}
        df = staging.orders(frame("raw.orders", order(**moments)))
        assert rows(df, "approval_delay_hours") == {(Decimal("1.00"),)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_order_durations(frame):
    df = staging.orders(frame("raw.orders", order(
        order_approved_at="2018-01-01 02:00:00", order_delivered_carrier_date="2018-01-01 01:00:00",
        order_delivered_customer_date="2018-01-05 00:00:00"), order("o2")))
    assert rows(df, "order_id", "approval_delay_hours", "carrier_delay_hours",
                "delivery_time_hours", "delivery_vs_estimated_hours") == {
        ("o1", Decimal("2.00"), Decimal("-1.00"), Decimal("96.00"), Decimal("-120.00")),
        ("o2", None, None, None, None)}


def test_items_get_category_place_and_total(frame):
    items = frame(
        "raw.order_items",
        {"order_id": "o1", "order_item_id": 1, "product_id": "p1", "seller_id": "s1",
         "price": "10.10", "freight_value": "0.95"},
        {"order_id": "o1", "order_item_id": 2, "product_id": "unknown", "seller_id": "s1",
         "price": "1", "freight_value": "1"},
    )
    products = frame("staging.products", {"product_id": "p1", "product_category_name": "beleza"})
    sellers = frame("staging.sellers", {"seller_id": "s1", "seller_city": "x", "seller_state": "SP"})
    df = staging.order_items(items, products, sellers)
    assert rows(df, "order_item_id", "product_category_name", "seller_city", "item_total_value") == {
        (1, "beleza", "x", Decimal("11.05"))}


@pytest.mark.parametrize("score,label", [
    (1, "negative"), (2, "negative"), (3, "neutral"), (4, "positive"), (5, "positive")])
def test_review_categories(frame, score, label):
    df = staging.order_reviews(frame("raw.order_reviews", {"review_id": "r", "review_score": score}))
    assert rows(df, "review_score_category") == {(label,)}


@pytest.mark.parametrize("title,message,commented", [
    (None, None, False), ("t", None, True), (None, "m", True), ("t", "m", True), ("", None, True)])
def test_review_has_comment(frame, title, message, commented):
    df = staging.order_reviews(frame("raw.order_reviews", {
        "review_id": "r", "review_score": 5, "review_comment_title": title,
        "review_comment_message": message}))
    assert rows(df, "has_comment") == {(commented,)}
