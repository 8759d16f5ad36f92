"""Report queries on the published data set; needs its CSV files, named by PARCELHOUSE_CSV_DIR.

A line is a report, the row meant (column=value, or - for a report of one row), and what the
columns of that row must hold.
"""

import os
from decimal import Decimal

import pytest

from parcelhouse.plans.warehouse import Warehouse
from parcelhouse.queries import REPORTS
from parcelhouse.sources.csv_files import CsvTables

FOLDER = os.environ.get("PARCELHOUSE_CSV_DIR")
needs_files = pytest.mark.skipif(not FOLDER, reason="PARCELHOUSE_CSV_DIR is not set")

# The published figures, in the order of the reports that give them.
FIGURES = """
late_rate | - | late_orders=6535 on_time_orders=89941 orders_without_result=2965
delivery_categories | delivery_category=on_time_or_early | orders=89941 canceled_after_delivery=5
delivery_categories | delivery_category=late | orders=6535 canceled_after_delivery=1
delivery_categories | delivery_category=in_progress | orders=1729
delivery_categories | delivery_category=not_completed | orders=1228
delivery_categories | delivery_category=missing_delivery_date | orders=8
delivery_categories | delivery_category=Total | orders=99441
lateness_basis | - | late_by_time_only=1292
score_by_lateness | had_late_delivery=False | customers=86857 avg_score=4.29
score_by_lateness | had_late_delivery=True | customers=6499 avg_score=2.30
repeat_share | - | customers=96096 repeat_customers=2997
customer_summary | - | orders=99441 total_spent=15843553.24 without_review=716 without_items=676
translation_statuses | category_translation_status=translated | products=32328
translation_statuses | category_translation_status=no_category | products=610
translation_statuses | category_translation_status=missing_translation | products=13
category_summary | figure=categories | value=74
category_summary | figure=categories translated | value=71
category_summary | figure=categories missing_translation | value=2
category_summary | figure=categories no_category | value=1
category_summary | figure=sum of item_count | value=112650
category_summary | figure=sum of order_count | value=99470
category_summary | figure=sum of total_value | value=15843553.24
category_summary | figure=orders with items | value=98666
category_summary | figure=orders in several categories | value=786
top_categories | category=health_beauty | total_value=1441248.07
by_payment_type | main_payment_type=credit_card | orders=74975 avg_payment=167.29
by_payment_type | main_payment_type=boleto | orders=19784 avg_payment=145.03
by_payment_type | main_payment_type=voucher | orders=3151 avg_payment=120.29
by_payment_type | main_payment_type=debit_card | orders=1527 avg_payment=142.72
by_payment_type | main_payment_type=not_defined | orders=3 avg_payment=0.00
by_payment_type | main_payment_type=none | orders=1 avg_payment=0.00
by_installment_band | installment_band=1 | orders=48268 avg_payment=121.04
by_installment_band | installment_band=2-5 | orders=35089 avg_payment=149.20
by_installment_band | installment_band=6-10 | orders=15740 avg_payment=305.48
by_installment_band | installment_band=11+ | orders=341 avg_payment=360.37
by_installment_band | installment_band=invalid_zero | orders=2 avg_payment=94.32
by_installment_band | installment_band=no_payment | orders=1 avg_payment=0.00
payments_without_items | status=unavailable | orders=603
payments_without_items | status=canceled | orders=161
payments_without_items | status=other | orders=8
money_totals | figure=product value | value=13591643.70
money_totals | figure=freight | value=2251909.54
money_totals | figure=item total | value=15843553.24
money_totals | figure=payment total | value=16008872.12
money_totals | figure=payments minus items | value=165318.88
reconciliation | reconciliation_status=reconciled | orders=98365 net_difference=-0.67
reconciliation | reconciliation_status=payment_without_items | orders=772 net_difference=162591.95
reconciliation | reconciliation_status=payment_greater_than_items | orders=264 net_difference=3070.14
reconciliation | reconciliation_status=items_greater_than_payment | orders=39 net_difference=-199.08
reconciliation | reconciliation_status=items_without_payment | orders=1 net_difference=-143.46
row_counts | table=raw.geolocation | rows=1000163
row_counts | table=staging.geolocation | rows=19015
row_counts | table=analytics.dim_product | rows=32951
row_counts | table=analytics.dim_date | rows=800
row_counts | table=analytics.dim_customer | rows=99441
row_counts | table=analytics.dim_geography | rows=19015
row_counts | table=analytics.dim_seller | rows=3095
row_counts | table=analytics.fact_orders | rows=99441
row_counts | table=analytics.fact_order_items | rows=112650
row_counts | table=analytics.fact_payments | rows=103886
row_counts | table=analytics.fact_reviews | rows=99224
"""


def expectations():
    for line in FIGURES.strip().splitlines():
        report, row, held = (part.strip() for part in line.split(" | "))
        yield report, row, {c: Decimal(v) for c, v in (pair.split("=") for pair in held.split())}


def differences(report: str, found: list[dict]) -> list[str]:
    """Published figures of a report that its rows do not show."""
    wrong = []
    for name, row, held in expectations():
        if name != report:
            continue
        column, _, value = row.partition("=")
        meant = [r for r in found if row == "-" or str(r[column]) == value]
        if len(meant) != 1:
            wrong.append(f"{row}: {len(meant)} rows")
            continue
        wrong += [f"{row}: {c} is {meant[0][c]}, not {v}" for c, v in held.items() if meant[0][c] != v]
    return wrong


PUBLISHED = list(dict.fromkeys(report for report, _, _ in expectations()))


@pytest.fixture(scope="module")
def published(spark):
    return Warehouse(CsvTables(spark, FOLDER))


@needs_files
@pytest.mark.parametrize("report", PUBLISHED)
def test_published_figures(published, report):
    found = [r.asDict() for r in REPORTS[report](published).collect()]
    assert differences(report, found) == []


@pytest.mark.parametrize("report", PUBLISHED)
def test_reports_have_the_rows_and_columns_that_figures_name(spark, small, report):
    """Without the files: on other data a figure may differ, but it must be there to compare."""
    from parcelhouse.sources.driver_tables import RawTables

    df = REPORTS[report](Warehouse(RawTables(spark, small)))
    for name, row, held in expectations():
        if name == report:
            assert set(held) <= set(df.columns)
            assert row == "-" or row.split("=")[0] in df.columns


def test_a_wrong_figure_is_reported():
    found = [{"late_orders": 6535, "on_time_orders": 1, "orders_without_result": 2965}]
    assert differences("late_rate", found) == ["-: on_time_orders is 1, not 89941"]
    assert differences("reconciliation", [])[0] == "reconciliation_status=reconciled: 0 rows"
