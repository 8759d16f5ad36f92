"""Data quality checks: the number of failing rows per check, and the gate between layers.

Every check is a formula over a few measures, each an aggregate of one table. All measures
of a stage on the same table are taken in one scan, so a stage costs one pass per table,
not one job per check.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.functions.labels import NEVER_COMPLETED, ORDER_STATUSES
from parcelhouse.operators.keys import orphans

Tables = Callable[[str], DataFrame]
MEASURE = "decimal(38,2)"
STAGES = ("raw", "staging", "analytics", "marts")


class QualityCheckFailed(Exception):
    """One or more critical checks found failing rows."""


@dataclass(frozen=True)
class Check:
    """`formula` refers to its measures as {0}, {1}...; each is (table, aggregate).

    The name starts with the stage.
    """

    name: str
    stage: str
    level: str
    about: str
    measures: tuple[tuple[str, str], ...]
    formula: str = "{0}"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def rows_where(name, level, about, table, condition):
    """A check that counts the rows of one table meeting a condition."""
    return Check(name, name.split("_")[0], level, about, ((table, f"count_if({condition})"),))


def _rows(*tables: str) -> tuple[tuple[str, str], ...]:
    return tuple((t, "count(1)") for t in tables)


def _kept() -> Check:
    names = ("orders", "order_items", "order_payments", "order_reviews",
             "customers", "sellers", "products")
    pairs = [f"{layer}.{name}" for name in names for layer in ("raw", "staging")]
    lost = " + ".join(f"abs({{{2 * i}}} - {{{2 * i + 1}}})" for i in range(len(names)))
    return Check("staging_no_rows_lost", "staging", "critical",
                 "Staging has as many rows as raw in each table it keeps at raw grain",
                 _rows(*pairs), lost)


# Tables that are not stored but derived for a check: rows whose ZIP prefix is unknown.
def _unlocated(child: str, column: str) -> Callable[[Tables], DataFrame]:
    def build(tables: Tables) -> DataFrame:
        return orphans(tables(child), [column], tables("staging.geolocation"),
                       ["geolocation_zip_code_prefix"])
    return build


DERIVED = {
    "unlocated customers": _unlocated("staging.customers", "customer_zip_code_prefix"),
    "unlocated sellers": _unlocated("staging.sellers", "seller_zip_code_prefix"),
}

# Names and levels are fixed values: run logs and dashboards refer to them.
CHECKS: tuple[Check, ...] = (
    rows_where("raw_order_status_known", "critical", "Order status is one of the known ones",
               "raw.orders", f"order_status NOT IN ({_quoted(ORDER_STATUSES)})"),
    Check("raw_no_negative_money", "raw", "critical",
          "Prices, freight and payments are zero or more",
          (("raw.order_items", "count_if(price < 0 OR freight_value < 0)"),
           ("raw.order_payments", "count_if(payment_value < 0)")), "{0} + {1}"),
    rows_where("raw_delivered_before_purchase", "critical",
               "Delivery does not precede purchase", "raw.orders",
               "order_delivered_customer_date < order_purchase_timestamp"),
    rows_where("raw_review_answered_before_created", "critical",
               "A review's answer does not precede the review", "raw.order_reviews",
               "review_answer_timestamp < review_creation_date"),
    rows_where("raw_carrier_before_approval", "warning",
               "The carrier got the order before the payment was approved", "raw.orders",
               "order_delivered_carrier_date < order_approved_at"),
    rows_where("raw_delivered_before_carrier", "warning",
               "The customer got the order before the carrier did", "raw.orders",
               "order_delivered_customer_date < order_delivered_carrier_date"),
    rows_where("raw_geolocation_outside_brazil", "warning",
               "A point lies outside the country's bounding box", "raw.geolocation",
               "geolocation_lat NOT BETWEEN -34 AND 6 OR geolocation_lng NOT BETWEEN -74 AND -34"),
    rows_where("raw_payment_type_not_defined", "warning", "The payment has no method",
               "raw.order_payments", "payment_type = 'not_defined'"),
    rows_where("raw_installments_below_one", "warning", "The payment has no instalment",
               "raw.order_payments", "payment_installments < 1"),
    rows_where("raw_products_without_category", "warning", "The product has no category",
               "raw.products", "product_category_name IS NULL"),
    rows_where("raw_products_without_dimensions", "warning",
               "The product has no weight or no length", "raw.products",
               "product_weight_g IS NULL OR product_length_cm IS NULL"),
    _kept(),
    Check("staging_one_row_per_zip_prefix", "staging", "critical",
          "Staged geolocation has as many rows as raw has ZIP prefixes",
          (("raw.geolocation", "count(DISTINCT geolocation_zip_code_prefix)"),
           ("staging.geolocation", "count(1)")), "abs({0} - {1})"),
    rows_where("staging_item_total_is_price_plus_freight", "critical",
               "A line total is its price and freight", "staging.order_items",
               "item_total_value <> price + freight_value"),
    Check("staging_customers_without_coordinates", "staging", "warning",
          "The customer's ZIP prefix has no point",
          (("unlocated customers", "coalesce(sum(n), 0)"),)),
    Check("staging_sellers_without_coordinates", "staging", "warning",
          "The seller's ZIP prefix has no point",
          (("unlocated sellers", "coalesce(sum(n), 0)"),)),
    Check("analytics_dim_date_has_no_gaps", "analytics", "critical",
          "The calendar has a row for each day between its ends",
          (("analytics.dim_date", "datediff(max(full_date), min(full_date)) + 1 - count(1)"),)),
    Check("analytics_item_value_preserved", "analytics", "critical",
          "Item value is the same in staging, the item fact and the order summary",
          (("staging.order_items", "sum(item_total_value)"),
           ("analytics.fact_order_items", "sum(item_total_value)"),
           ("analytics.order_summary", "sum(item_total_value)")),
          "CAST({0} <> {1} OR {0} <> {2} AS INT)"),
    Check("analytics_payment_value_preserved", "analytics", "critical",
          "Payment value is the same in staging, the payment fact and the order summary",
          (("staging.order_payments", "sum(payment_value)"),
           ("analytics.fact_payments", "sum(payment_value)"),
           ("analytics.order_summary", "sum(payment_total)")),
          "CAST({0} <> {1} OR {0} <> {2} AS INT)"),
    rows_where("analytics_every_order_reconciled", "critical",
               "The order has a reconciliation status", "analytics.order_summary",
               "reconciliation_status IS NULL"),
    rows_where("analytics_delivered_without_date", "warning",
               "The order counts as delivered but has no delivery date",
               "analytics.fact_orders", "order_status = 'delivered' AND delivered_late IS NULL"),
    rows_where("analytics_canceled_after_delivery", "warning",
               "The order was delivered and still ended as never completed",
               "analytics.fact_orders",
               f"order_status IN ({_quoted(NEVER_COMPLETED)}) AND delivered_late IS NOT NULL"),
    rows_where("analytics_orders_without_items", "warning", "The order has no items",
               "analytics.order_summary", "item_count = 0"),
    Check("marts_delivery_covers_every_order", "marts", "critical",
          "The delivery mart has as many rows as there are orders",
          _rows("analytics.fact_orders", "marts.delivery_performance"), "abs({0} - {1})"),
    Check("marts_category_value_preserved", "marts", "critical",
          "Category totals sum to the value of all items",
          (("marts.category_performance", "sum(total_value)"),
           ("analytics.fact_order_items", "sum(item_total_value)")), "CAST({0} <> {1} AS INT)"),
    Check("marts_customers_cover_every_order", "marts", "critical",
          "The orders of all customers sum to the number of orders",
          (("marts.customer_performance", "sum(order_count)"),
           ("analytics.fact_orders", "count(1)")), "abs({0} - {1})"),
    Check("marts_payment_value_preserved", "marts", "critical",
          "The payment mart sums to the value of all payments",
          (("marts.payment_analysis", "sum(payment_total)"),
           ("analytics.fact_payments", "sum(payment_value)")), "CAST({0} <> {1} AS INT)"),
)


def report(tables: Tables, *stages: str) -> DataFrame:
    """One row per check: failing rows and pass, FAIL or warn.

    A measure without a value (a sum over no rows) gives failing_rows NULL and FAIL.
    """
    checks = [c for c in CHECKS if c.stage in stages]
    labels: dict[tuple[str, str], str] = {}
    for check in checks:
        for measure in check.measures:
            labels.setdefault(measure, f"m{len(labels)}")

    measured = []
    for table in dict.fromkeys(table for table, _ in labels):
        source = DERIVED[table](tables) if table in DERIVED else tables(table)
        mine = {label: a for (t, a), label in labels.items() if t == table}
        one_row = source.agg(*[F.expr(f"CAST({a} AS {MEASURE}) AS {m}") for m, a in mine.items()])
        measured.append(one_row.unpivot([], list(mine), "measure", "value"))

    together = reduce(DataFrame.unionByName, measured).agg(*[
        F.expr(f"max(CASE WHEN measure = '{m}' THEN value END) AS {m}") for m in labels.values()
    ])

    def failing(check: Check) -> str:
        return check.formula.format(*[labels[m] for m in check.measures])

    results = together.selectExpr(
        *[f"CAST({failing(c)} AS BIGINT) AS {c.name}" for c in checks]
    ).unpivot([], [c.name for c in checks], "check", "failing_rows")

    is_critical = F.col("check").isin([c.name for c in checks if c.level == "critical"])
    status = (
        F.when(F.col("failing_rows") == 0, "pass")
        .when(F.col("failing_rows").isNull() | (F.col("level") == "critical"), "FAIL")
        .otherwise("warn")
    )
    return (
        results.withColumn("stage", F.substring_index("check", "_", 1))
        .withColumn("level", F.when(is_critical, "critical").otherwise("warning"))
        .withColumn("status", status)
        .select("check", "stage", "level", "failing_rows", "status")
    )


def warnings_per_stage(checked: DataFrame) -> DataFrame:
    return checked.groupBy("stage").agg(F.count_if(F.col("status") == "warn").alias("warnings"))


def outcome(checked: DataFrame) -> DataFrame:
    """Per stage: would its gate stop the run, for which checks, and how many warnings."""
    failed = F.when(F.col("status") == "FAIL", F.col("check"))
    return checked.groupBy("stage").agg(
        (F.count(failed) > 0).alias("stops"),
        F.concat_ws(", ", F.array_sort(F.collect_list(failed))).alias("failed_checks"),
        F.count_if(F.col("status") == "warn").alias("warnings"),
    )


def gate(tables: Tables, stage: str) -> int:
    """Run every check of a stage; raise if a critical one fails, else return the warnings.

    What reaches the driver is one row per check.
    """
    results = report(tables, stage).collect()
    failed = [r["check"] for r in results if r["status"] == "FAIL"]
    if failed:
        raise QualityCheckFailed(f"{len(failed)} critical check(s) failed: {', '.join(failed)}")
    return sum(r["status"] == "warn" for r in results)
