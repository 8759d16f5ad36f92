"""Checks: well formed, and each one counts what it should."""

import pytest

from comparing import rows
from parcelhouse.plans import quality
from parcelhouse.queries import built
from parcelhouse.tables import TABLES

NAMES = [c.name for c in quality.CHECKS]


def test_number_of_checks():
    levels = [c.level for c in quality.CHECKS]
    assert (levels.count("critical"), levels.count("warning")) == (15, 12)


def test_names_are_unique():
    assert len(NAMES) == len(set(NAMES))


@pytest.mark.parametrize("check", quality.CHECKS, ids=NAMES)
def test_check_is_well_formed(check):
    assert check.stage in quality.STAGES
    assert check.name.startswith(f"{check.stage}_")
    assert check.level in ("critical", "warning")
    assert check.about and check.measures
    assert all(t in TABLES or t in quality.DERIVED for t, _ in check.measures)


def test_every_stage_has_a_critical_check():
    assert {c.stage for c in quality.CHECKS if c.level == "critical"} == set(quality.STAGES)


@pytest.fixture
def world(frame):
    """A small consistent warehouse; tests replace single tables."""
    moment = {"order_purchase_timestamp": "2018-01-01 00:00:00"}
    order = {"order_id": "o", "customer_id": "c", "order_status": "delivered", **moment}
    item = {"order_id": "o", "order_item_id": 1, "price": "10", "freight_value": "1",
            "item_total_value": "11"}
    paid = {"order_id": "o", "payment_sequential": 1, "payment_type": "boleto",
            "payment_installments": 1, "payment_value": "11"}
    given = {
        "raw.orders": [order], "staging.orders": [order], "raw.order_items": [item],
        "staging.order_items": [item], "analytics.fact_order_items": [item],
        "raw.order_payments": [paid], "staging.order_payments": [paid],
        "analytics.fact_payments": [paid],
        "raw.geolocation": [{"geolocation_zip_code_prefix": 1, "geolocation_lat": -20, "geolocation_lng": -50}],
        "staging.geolocation": [{"geolocation_zip_code_prefix": 1}],
        "raw.customers": [{"customer_id": "c", "customer_zip_code_prefix": 1}],
        "staging.customers": [{"customer_id": "c", "customer_zip_code_prefix": 1}],
        "analytics.dim_date": [{"date_key": 20180101, "full_date": "2018-01-01"}],
        "analytics.fact_orders": [{"order_id": "o", "order_status": "delivered", "delivered_late": False}],
        "analytics.order_summary": [{"order_id": "o", "item_count": 1, "item_total_value": "11",
                                     "payment_total": "11", "reconciliation_status": "reconciled"}],
        "marts.delivery_performance": [{"order_id": "o"}],
        "marts.category_performance": [{"category": "x", "total_value": "11"}],
        "marts.customer_performance": [{"customer_unique_id": "u", "order_count": 1}],
        "marts.payment_analysis": [{"order_id": "o", "payment_total": "11"}],
    }

    def tables(**changes):
        def table(name):
            return frame(name, *changes.get(name.replace(".", "__"), given.get(name, [])))
        return table

    return tables


def failing(tables, stage):
    return {r["check"]: r["failing_rows"] for r in quality.report(tables, stage).collect()
            if r["failing_rows"] != 0}


@pytest.mark.parametrize("stage", quality.STAGES)
def test_consistent_tables_pass(world, stage):
    assert failing(world(), stage) == {}
    assert quality.gate(world(), stage) == 0


CASES = [
    ("raw_order_status_known", "raw", "raw.orders", [{"order_status": "lost"}, {"order_status": "shipped"}], 1),
    ("raw_no_negative_money", "raw", "raw.order_items",
     [{"price": -1, "freight_value": 1}, {"price": 1, "freight_value": -1}, {"price": 0, "freight_value": 0}], 2),
    ("raw_no_negative_money", "raw", "raw.order_payments",
     [{"payment_value": -1, "payment_installments": 1}], 1),
    ("raw_delivered_before_purchase", "raw", "raw.orders", [{
        "order_status": "delivered", "order_purchase_timestamp": "2018-01-02 00:00:00",
        "order_delivered_customer_date": "2018-01-01 00:00:00"}], 1),
    ("raw_review_answered_before_created", "raw", "raw.order_reviews", [{
        "review_creation_date": "2018-01-02 00:00:00", "review_answer_timestamp": "2018-01-01 00:00:00"}], 1),
    ("raw_carrier_before_approval", "raw", "raw.orders", [{
        "order_status": "shipped", "order_approved_at": "2018-01-02 00:00:00",
        "order_delivered_carrier_date": "2018-01-01 00:00:00"}], 1),
    ("raw_delivered_before_carrier", "raw", "raw.orders", [{
        "order_status": "shipped", "order_delivered_carrier_date": "2018-01-02 00:00:00",
        "order_delivered_customer_date": "2018-01-01 00:00:00"}], 1),
    ("raw_geolocation_outside_brazil", "raw", "raw.geolocation", [
        {"geolocation_lat": lat, "geolocation_lng": lng}
        for lat, lng in ((6, -34), (-34, -74), ("6.1", -50), (-20, "-33.9"), (41, -8))], 3),
    ("raw_payment_type_not_defined", "raw", "raw.order_payments",
     [{"payment_type": "not_defined", "payment_installments": 1, "payment_value": 1}], 1),
    ("raw_installments_below_one", "raw", "raw.order_payments",
     [{"payment_type": "boleto", "payment_installments": 0, "payment_value": 1}], 1),
    ("raw_products_without_category", "raw", "raw.products",
     [{"product_id": "p", "product_weight_g": 1, "product_length_cm": 1}], 1),
    ("raw_products_without_dimensions", "raw", "raw.products", [
        {"product_category_name": "x", "product_weight_g": 1}, {"product_category_name": "x", "product_length_cm": 1},
        {"product_category_name": "x", "product_length_cm": 1, "product_weight_g": 1}], 2),
    ("staging_no_rows_lost", "staging", "staging.order_payments", [], 1),
    ("staging_one_row_per_zip_prefix", "staging", "raw.geolocation",
     [{"geolocation_zip_code_prefix": z} for z in (1, 2, 2, 3)], 2),
    ("staging_item_total_is_price_plus_freight", "staging", "staging.order_items",
     [{"price": 1, "freight_value": 2, "item_total_value": 4}], 1),
    ("staging_customers_without_coordinates", "staging", "staging.customers",
     [{"customer_id": "c", "customer_zip_code_prefix": 9}], 1),
    ("analytics_dim_date_has_no_gaps", "analytics", "analytics.dim_date",
     [{"full_date": "2018-01-01"}, {"full_date": "2018-01-05"}], 3),
    ("analytics_item_value_preserved", "analytics", "analytics.fact_order_items", [{"item_total_value": 12}], 1),
    ("analytics_payment_value_preserved", "analytics", "analytics.fact_payments", [{"payment_value": 12}], 1),
    ("analytics_every_order_reconciled", "analytics", "analytics.order_summary",
     [{"item_count": 1, "item_total_value": 11, "payment_total": 11}], 1),
    ("analytics_delivered_without_date", "analytics", "analytics.fact_orders", [{"order_status": "delivered"}], 1),
    ("analytics_canceled_after_delivery", "analytics", "analytics.fact_orders", [
        {"order_status": "canceled", "delivered_late": True}, {"order_status": "unavailable", "delivered_late": False},
        {"order_status": "canceled"}], 2),
    ("analytics_orders_without_items", "analytics", "analytics.order_summary", [
        {"item_count": 0, "item_total_value": 11, "payment_total": 11, "reconciliation_status": "x"}], 1),
    ("marts_delivery_covers_every_order", "marts", "marts.delivery_performance", [], 1),
    ("marts_category_value_preserved", "marts", "marts.category_performance", [{"total_value": 10}], 1),
    ("marts_customers_cover_every_order", "marts", "marts.customer_performance", [{"order_count": 4}], 3),
    ("marts_payment_value_preserved", "marts", "marts.payment_analysis", [{"payment_total": 10}], 1),
]


@pytest.mark.parametrize("check,stage,table,given,expected", CASES, ids=[f"{c[0]}-{c[2]}" for c in CASES])
def test_check_counts_failing_rows(world, check, stage, table, given, expected):
    assert failing(world(**{table.replace(".", "__"): given}), stage) == {check: expected}


def test_sellers_without_coordinates(world):
    sellers = [{"seller_id": "s", "seller_zip_code_prefix": 9}]
    found = failing(world(raw__sellers=sellers, staging__sellers=sellers), "staging")
    assert found == {"staging_sellers_without_coordinates": 1}


def test_sum_over_nothing_fails_without_a_number(world):
    tables = world(**{"analytics__fact_payments": [], "staging__order_payments": []})
    report = quality.report(tables, "analytics").where("check = 'analytics_payment_value_preserved'")
    assert rows(report, "failing_rows", "status") == {(None, "FAIL")}


def test_gate_names_every_failed_check(world):
    tables = world(raw__orders=[{"order_status": "lost"}], raw__order_payments=[{"payment_value": -1}])
    with pytest.raises(quality.QualityCheckFailed, match="2 critical.*raw_order_status_known.*raw_no_negative_money"):
        quality.gate(tables, "raw")


def test_gate_counts_warnings(world):
    assert quality.gate(world(analytics__fact_orders=[{"order_status": "delivered"}]), "analytics") == 1


@pytest.mark.parametrize("stage", quality.STAGES)
def test_one_scan_per_table(spark, small, stage):
    """However many checks read a table, its files are opened once per stage."""
    build, _ = built(spark, small)
    plan = quality.report(build.table, stage)._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    scanned = [leaves.apply(i).toString() for i in range(leaves.size())]
    read = [s for s in scanned if s.startswith("Relation")]
    needed = {table for c in quality.CHECKS if c.stage == stage for table, _ in c.measures}
    assert 0 < len(read) <= len(needed) + sum(2 for t in needed if t in quality.DERIVED)
    assert stage != "raw" or len(read) == len({t for t in needed})
