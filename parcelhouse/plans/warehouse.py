"""All tables of the warehouse as lazy DataFrames, wired layer by layer."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from parcelhouse.plans import dimensions, facts, marts, staging
from parcelhouse.tables import shaped


class Warehouse:
    """Each layer reads the one below it. Nothing runs until a table is used."""

    def __init__(self, raw: dict[str, DataFrame]):
        self.raw = raw

    def table(self, name: str) -> DataFrame:
        """A table by its full name, such as analytics.fact_orders."""
        layer, table = name.split(".")
        if layer == "raw":
            return self.raw[table]
        if layer == "staging":
            return getattr(self, f"staging_{table}")
        return getattr(self, table)

    @cached_property
    def staging_customers(self):
        return staging.customers(self.raw["customers"])

    @cached_property
    def staging_sellers(self):
        return staging.sellers(self.raw["sellers"])

    @cached_property
    def staging_geolocation(self):
        return staging.geolocation(self.raw["geolocation"])

    @cached_property
    def staging_products(self):
        return staging.products(self.raw["products"], self.raw["category_translation"])

    @cached_property
    def staging_orders(self):
        return staging.orders(self.raw["orders"])

    @cached_property
    def staging_order_items(self):
        return staging.order_items(
            self.raw["order_items"], self.staging_products, self.staging_sellers
        )

    @cached_property
    def staging_order_payments(self):
        return staging.order_payments(self.raw["order_payments"])

    @cached_property
    def staging_order_reviews(self):
        return staging.order_reviews(self.raw["order_reviews"])

    @cached_property
    def dim_date(self):
        return dimensions.date(self.staging_orders, self.staging_order_reviews)

    @cached_property
    def dim_geography(self):
        return dimensions.geography(self.staging_geolocation)

    @cached_property
    def dim_customer(self):
        return dimensions.customer(self.staging_customers, self.staging_geolocation)

    @cached_property
    def dim_seller(self):
        return dimensions.seller(self.staging_sellers, self.staging_geolocation)

    @cached_property
    def dim_product(self):
        return dimensions.product(self.staging_products)

    @cached_property
    def fact_orders(self):
        return facts.orders(self.staging_orders)

    @cached_property
    def fact_order_items(self):
        return facts.order_items(self.staging_order_items, self.staging_orders)

    @cached_property
    def fact_payments(self):
        return facts.payments(self.staging_order_payments)

    @cached_property
    def fact_reviews(self):
        return facts.reviews(self.staging_order_reviews)

    @cached_property
    def order_summary(self):
        return shaped(self.order_sides, "analytics.order_summary")

    @cached_property
    def order_sides(self):
        """Orders with all that is known of their payments, which are grouped once."""
        return facts.order_sides(
            self.fact_orders, self.fact_order_items, facts.payment_groups(self.fact_payments))

    @cached_property
    def delivery_performance(self):
        return marts.delivery_performance(self.fact_orders, self.dim_customer)

    @cached_property
    def category_performance(self):
        return marts.category_performance(self.fact_order_items, self.dim_product)

    @cached_property
    def customer_performance(self):
        return marts.customer_performance(
            self.order_summary, self.dim_customer, self.fact_reviews
        )

    @cached_property
    def payment_analysis(self):
        return marts.analysed_payments(self.order_sides, self.dim_customer)
