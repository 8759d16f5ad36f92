"""Mart rules on small hand-made tables."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from comparing import rows
from parcelhouse.plans import marts, reports


@pytest.mark.parametrize("late,status,category", [
    (False, "delivered", "on_time_or_early"), (True, "delivered", "late"),
    (False, "canceled", "on_time_or_early"), (True, "unavailable", "late"),
    (None, "canceled", "not_completed"), (None, "unavailable", "not_completed"),
    (None, "delivered", "missing_delivery_date"), (None, "shipped", "in_progress"),
    (None, "created", "in_progress"),
])
def test_delivery_categories(frame, late, status, category):
    orders = frame("analytics.fact_orders", {
        "order_id": "o", "customer_id": "c", "order_status": status, "delivered_late": late})
    people = frame("analytics.dim_customer", {"customer_id": "c", "customer_state": "SP"})
    df = marts.delivery_performance(orders, people)
    assert rows(df, "customer_state", "delivery_category") == {("SP", category)}


def item(order_id, number, product, price, freight):
    return {"order_id": order_id, "order_item_id": number, "product_id": product, "price": price,
            "freight_value": freight, "item_total_value": Decimal(price) + Decimal(freight)}


PRODUCTS = (
    {"product_id": "p1", "product_category_name": "beleza", "product_category_name_english": "beauty",
     "category_translation_status": "translated"},
    {"product_id": "p2", "product_category_name": "pc_gamer",
     "category_translation_status": "missing_translation"},
    {"product_id": "p3", "category_translation_status": "no_category"},
)


def test_categories(frame):
    items = frame(
        "analytics.fact_order_items",
        item("o1", 1, "p1", "10", "1"), item("o1", 2, "p1", "10.01", "2"),
        item("o1", 3, "p2", "7", "3"), item("o2", 1, "p1", "10", "1"), item("o3", 1, "p3", "1", "0"),
    )
    df = marts.category_performance(items, frame("analytics.dim_product", *PRODUCTS))
    d = Decimal
    assert rows(df) == {
        ("beauty", "translated", 2, 3, d("30.01"), d("4.00"), d("34.01"), d("10.00"), d("0.1176")),
        ("pc_gamer", "missing_translation", 1, 1, d("7.00"), d("3.00"), d("10.00"), d("7.00"), d("0.3000")),
        ("unknown", "no_category", 1, 1, d("1.00"), d("0.00"), d("1.00"), d("1.00"), d("0.0000")),
    }


def test_freight_share_is_rounded_once(frame):
    """2196.00 / 4882256.07 is 0.00044979; rounded to six places first it would become 0.0005."""
    items = frame("analytics.fact_order_items", item("o", 1, "p1", "4880060.07", "2196.00"))
    df = marts.category_performance(items, frame("analytics.dim_product", *PRODUCTS))
    assert rows(df, "freight_share") == {(Decimal("0.0004"),)}


def test_category_without_value_is_an_error(frame):
    items = frame("analytics.fact_order_items", item("o", 1, "p1", "0", "0"))
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        marts.category_performance(items, frame("analytics.dim_product", *PRODUCTS)).collect()


def order(order_id, customer, day, items=1, value="10", late=None):
    return {"order_id": order_id, "customer_id": customer, "purchase_date_key": day,
            "item_count": items, "item_total_value": value, "delivered_late": late}


def people(frame, orders, states, scores=()):
    return marts.customer_performance(
        frame("analytics.order_summary", *orders),
        frame("analytics.dim_customer", *[
            {"customer_id": c, "customer_unique_id": u, "customer_state": s} for c, u, s in states]),
        frame("analytics.fact_reviews", *[
            {"review_id": i, "order_id": o, "review_score": s} for i, (o, s) in enumerate(scores)]),
    )


def test_customer_with_several_orders(frame):
    df = people(
        frame,
        [order("o1", "c1", 20180101, 2, "30", True), order("o2", "c2", 20180301, 0, "0", None),
         order("o3", "c3", 20180201, 1, "5.01", False)],
        [("c1", "u", "SP"), ("c2", "u", "RJ"), ("c3", "u", "ES")],
        [("o1", 5), ("o1", 1), ("o3", 4)],
    )
    d = Decimal
    assert rows(df) == {(
        "u", "RJ", date(2018, 1, 1), date(2018, 3, 1), 3, 3, d("35.01"), d("17.51"), 2, 1,
        d("3.33"), True)}


def test_latest_state_on_one_day_follows_the_order_id(frame):
    df = people(frame, [order("o9", "c1", 20180101), order("o10", "c2", 20180101)],
                [("c1", "u", "SP"), ("c2", "u", "RJ")])
    assert rows(df, "customer_state") == {("SP",)}   # 'o9' comes after 'o10' as text


def test_customer_without_items_or_reviews(frame):
    df = people(frame, [order("o1", "c1", 20180101, 0, "0")], [("c1", "u", "SP")])
    assert rows(df, "avg_order_value", "avg_review_score", "is_repeat_customer") == {(None, None, False)}


def payments(frame, *paid):
    summary = frame("analytics.order_summary", {
        "order_id": "o", "customer_id": "c", "reconciliation_status": "reconciled"})
    return marts.payment_analysis(
        summary, frame("analytics.dim_customer", {"customer_id": "c", "customer_state": "SP"}),
        frame("analytics.fact_payments", *[
            {"order_id": "o", "payment_sequential": n, "payment_type": t, "payment_installments": i,
             "payment_value": v} for n, t, i, v in paid]),
    )


def test_payment_types_and_main_type(frame):
    df = payments(frame, (1, "voucher", 1, "5"), (2, "credit_card", 3, "7"), (3, "boleto", 1, "7"),
                  (4, "voucher", 1, "1"))
    assert rows(df, "payment_count", "payment_types", "main_payment_type", "uses_voucher",
                "max_installments") == {(4, "boleto+credit_card+voucher", "credit_card", True, 3)}


def test_order_without_payment(frame):
    assert rows(payments(frame), "payment_count", "payment_types", "main_payment_type",
                "uses_voucher", "max_installments", "installment_band") == {
        (0, "none", "none", False, None, "no_payment")}


@pytest.mark.parametrize("installments,band", [
    (0, "invalid_zero"), (1, "1"), (2, "2-5"), (5, "2-5"), (6, "6-10"), (10, "6-10"), (11, "11+"),
    (24, "11+")])
def test_installment_bands(frame, installments, band):
    assert rows(payments(frame, (1, "credit_card", installments, "5")), "installment_band") == {(band,)}


def test_fan_out_equals_the_direct_join(frame):
    items = frame("analytics.fact_order_items", item("a", 1, "p1", "10", "1"), item("a", 2, "p1", "5", "0"),
                  item("b", 1, "p1", "3", "0"), item("unpaid", 1, "p1", "2", "0"))
    paid = frame("analytics.fact_payments", *[
        {"order_id": o, "payment_sequential": n, "payment_value": 1} for o, n in
        (("a", 1), ("a", 2), ("a", 3), ("b", 1), ("other", 1))])
    joined = items.join(paid.select("order_id"), "order_id").groupBy().sum("item_total_value").first()[0]
    assert rows(reports.fan_out(items, paid)) == {(Decimal("21.00"), joined, joined - Decimal("21.00"))}


def test_orders_are_counted_without_their_money(frame):
    """No row that stands for an order carries sums; a missing order counts as one."""
    lost = [{**item(None, n, "p1", "2", "1")} for n in (1, 2)]
    items = frame("analytics.fact_order_items", item("o1", 1, "p1", "10", "1"),
                  item("o1", 2, "p1", "10", "2"), item("o2", 1, "p1", "10", "1"), *lost)
    df = marts.category_performance(items, frame("analytics.dim_product", *PRODUCTS))
    assert rows(df, "order_count", "item_count", "total_value") == {(3, 5, Decimal("40.00"))}
    assert "Generate inline" in df._jdf.queryExecution().optimizedPlan().toString()


def test_states_are_looked_up_before_payments(frame):
    """Orders travel to their customers without how they were paid; repeated ones stay apart."""
    orders = frame("analytics.order_summary", order("o1", "c1", 20180101), order("o1", "c1", 20180101),
                   order(None, "c2", 20180101), order("o3", None, 20180101), order("o4", "c1", 20180101))
    people = frame("analytics.dim_customer", *[
        {"customer_id": c, "customer_state": s} for c, s in (("c1", "SP"), ("c1", "RJ"), ("c2", "AM"))])
    paid = frame("analytics.fact_payments", *[
        {"order_id": o, "payment_sequential": n, "payment_type": "boleto", "payment_value": 1,
         "payment_installments": 1} for o, n in (("o1", 1), ("o1", 2), (None, 1))])
    df = marts.payment_analysis(orders, people, paid)
    found = sorted((str(r["order_id"]), r["customer_state"], r["payment_count"]) for r in df.collect())
    assert found == [("None", "AM", 0), ("o1", "RJ", 2), ("o1", "RJ", 2), ("o1", "SP", 2),
                     ("o1", "SP", 2), ("o4", "RJ", 0), ("o4", "SP", 0)]
    joins = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines()
             if "Join " in line]
    assert "LeftOuter" in joins[0] and "Inner" in joins[1]
