"""The nine raw tables, derived from order, customer, line and part tables in Parquet.

FIXTURES.md gives the rules as SQL text. Two of them are written differently here: rows
are multiplied with explode instead of a cross join, and items are numbered by an operator
that also copes with one order holding much of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelhouse.functions.columns import AMOUNT, TOTAL
from parcelhouse.operators.numbering import ROWS_PER_TASK, number_within

# FIXTURES.md goes on with l_returnflag and l_linestatus. Lines that agree up to here become equal
# items but for their numbers, so their order shows nowhere.
ITEM_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_shipdate",
]


class RawTables(dict):
    """The raw tables by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, rows_per_task: int = ROWS_PER_TASK):
        """Items of orders with more than `rows_per_task` lines are numbered by many tasks."""
        super().__init__()
        self.spark, self.folder, self.rows_per_task = spark, folder, rows_per_task

    def __missing__(self, name: str) -> DataFrame:
        self[name] = _BUILDERS[name](self)
        return self[name]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def customers(source: RawTables) -> DataFrame:
    nation_of = source.read("customer").join(
        source.read("nation"), F.col("n_nationkey") == F.col("c_nationkey")
    )
    placed = source.read("orders").join(nation_of, F.col("c_custkey") == F.col("o_custkey"))
    state = F.when(F.col("o_orderkey") % 30 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(
        F.col("c_nationkey")
    )
    person = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("u"), "o_custkey")).otherwise(
        F.concat(F.lit("x"), "o_orderkey")
    )
    return placed.select(
        F.concat(F.lit("c"), "o_orderkey").alias("customer_id"),
        person.alias("customer_unique_id"),
        (F.col("o_custkey") % 400).cast("int").alias("customer_zip_code_prefix"),
        F.lower("n_name").alias("customer_city"),
        F.lpad(state.cast("string"), 2, "0").alias("customer_state"),
    )


def _later(seconds: str):
    return F.expr(f"o_orderdate + make_dt_interval(0, 0, 0, {seconds})")


def orders(source: RawTables) -> DataFrame:
    return source.read("orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("order_id"),
        F.concat(F.lit("c"), "o_orderkey").alias("customer_id"),
        F.expr("""
            CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'shipped'
            ELSE element_at(array('created', 'approved', 'processing', 'invoiced',
                                  'unavailable', 'canceled'), CAST(o_orderkey % 6 + 1 AS INT))
            END""").alias("order_status"),
        _later("(o_orderkey * 7919) % 86400").alias("order_purchase_timestamp"),
        F.when(F.expr("o_orderkey % 97 <> 0"), _later("86400 + (o_orderkey * 31) % 172800"))
        .alias("order_approved_at"),
        F.when(F.expr("o_orderstatus <> 'O'"), _later("172800 + (o_orderkey * 97) % 345600"))
        .alias("order_delivered_carrier_date"),
        F.when(
            F.expr("""(o_orderstatus = 'F' AND o_orderkey % 50 <> 7)
                   OR (o_orderstatus = 'O' AND o_orderkey % 60 = 5)"""),
            _later("432000 + (o_orderkey * 7919) % 2592000"),
        ).alias("order_delivered_customer_date"),
        F.expr("o_orderdate + INTERVAL 30 DAY").alias("order_estimated_delivery_date"),
    )


def order_items(source: RawTables) -> DataFrame:
    # Equal lines are told apart by where they lie in the files, to spread them.
    stored_at = [F.xxhash64("_metadata.file_path").alias("stored_in"),
                 F.col("_metadata.row_index").alias("stored_row")]
    lines = source.read("lineitem").select(
        F.concat(F.lit("o"), "l_orderkey").alias("order_id"), *ITEM_ORDER, *stored_at)
    places, limit = ("stored_in", "stored_row"), source.rows_per_task
    return number_within(lines, "order_id", ITEM_ORDER, "order_item_id", limit, places).select(
        "order_id",
        "order_item_id",
        F.concat(F.lit("p"), "l_partkey").alias("product_id"),
        F.concat(F.lit("s"), "l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(AMOUNT).alias("price"),
        F.col("l_quantity").cast(AMOUNT).alias("freight_value"),
    )


def order_payments(source: RawTables) -> DataFrame:
    line_value = F.col("l_extendedprice").cast(AMOUNT) + F.col("l_quantity").cast(AMOUNT)
    # Joined on the final key, so that later work by order finds the rows in place.
    totals = (
        source.read("lineitem")
        .groupBy(F.concat(F.lit("o"), "l_orderkey").alias("order_id"))
        .agg(F.sum(line_value).cast(TOTAL).alias("item_total"))
    )
    parts = (
        source.read("orders")
        .where(F.expr("o_orderkey % 500 <> 11"))
        .select(F.concat(F.lit("o"), "o_orderkey").alias("order_id"), "o_orderkey", "o_totalprice")
        .join(totals, "order_id", "left")
        .withColumn("seq", F.explode(F.expr("sequence(1, CAST(1 + o_orderkey % 3 AS INT))")))
    )
    return parts.select(
        "order_id",
        F.col("seq").alias("payment_sequential"),
        F.expr("""
            CASE WHEN seq > 1 THEN 'voucher' WHEN o_orderkey % 500 = 13 THEN 'not_defined'
                 WHEN o_orderkey % 5 = 0 THEN 'boleto' WHEN o_orderkey % 11 = 0 THEN 'debit_card'
                 WHEN o_orderkey % 13 = 0 THEN 'voucher' ELSE 'credit_card' END
            """).alias("payment_type"),
        F.expr("""
            CAST(CASE WHEN seq > 1 THEN 1 WHEN o_orderkey % 700 = 9 THEN 0
                      ELSE 1 + o_orderkey % 13 END AS INT)""").alias("payment_installments"),
        F.expr(f"""
            CAST(CASE WHEN item_total IS NULL AND o_orderkey % 4 = 0 THEN 0
                      WHEN seq > 1 THEN 10
                      ELSE coalesce(item_total, CAST(o_totalprice AS {AMOUNT}))
                           - 10 * (o_orderkey % 3)
                           + CASE o_orderkey % 60 WHEN 0 THEN 0.01 WHEN 1 THEN 0.02
                                                  WHEN 2 THEN -0.01 WHEN 3 THEN -5 ELSE 0 END
                 END AS {TOTAL})""").alias("payment_value"),
    )


def order_reviews(source: RawTables) -> DataFrame:
    written = source.read("orders").withColumn(
        "k",
        F.explode(F.expr("""
            filter(array(0, 1), k -> (k = 0 AND o_orderkey % 10 <> 0)
                                  OR (k = 1 AND o_orderkey % 40 = 5))""")),
    )
    return written.select(
        F.expr("concat('r', o_orderkey - o_orderkey % 2 + k * 1000000000)").alias("review_id"),
        F.concat(F.lit("o"), "o_orderkey").alias("order_id"),
        F.expr("CAST(1 + (o_orderkey * 13 + k) % 5 AS INT)").alias("review_score"),
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'title' END").alias("review_comment_title"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN 'message' END").alias("review_comment_message"),
        F.expr("o_orderdate + INTERVAL 36 DAY").alias("review_creation_date"),
        _later("36 * 86400 + (o_orderkey * 101) % 604800").alias("review_answer_timestamp"),
    )


def products(source: RawTables) -> DataFrame:
    described, sized = F.expr("p_partkey % 50 <> 0"), F.expr("p_partkey % 100 <> 1")
    size = F.col("p_size")
    return source.read("part").select(
        F.concat(F.lit("p"), "p_partkey").alias("product_id"),
        F.when(described, F.col("p_name")).alias("product_category_name"),
        F.when(described, F.length("p_name")).alias("product_name_length"),
        F.when(described, F.length("p_type")).alias("product_description_length"),
        F.when(described, (1 + F.col("p_partkey") % 6).cast("int")).alias("product_photos_qty"),
        F.when(sized, F.col("p_retailprice").cast(AMOUNT)).alias("product_weight_g"),
        F.when(sized, size.cast(AMOUNT)).alias("product_length_cm"),
        (size + 1).cast(AMOUNT).alias("product_height_cm"),
        (size + 2).cast(AMOUNT).alias("product_width_cm"),
    )


def category_translation(source: RawTables) -> DataFrame:
    names = source.read("part").where(~F.col("p_name").isin("old gizmo", "blue rod"))
    # Grouped by the name alone, so that Spark knows it to be unique and can drop joins to it.
    return names.groupBy(F.col("p_name").alias("product_category_name")).agg(
        F.upper(F.first("p_name")).alias("product_category_name_english"))


def sellers(source: RawTables) -> DataFrame:
    placed = source.read("supplier").join(
        source.read("nation"), F.col("n_nationkey") == F.col("s_nationkey")
    )
    return placed.select(
        F.concat(F.lit("s"), "s_suppkey").alias("seller_id"),
        (300 + F.col("s_suppkey")).cast("int").alias("seller_zip_code_prefix"),
        F.lower("n_name").alias("seller_city"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("seller_state"),
    )


def geolocation(source: RawTables) -> DataFrame:
    def degrees(mix: str, shift: int) -> str:
        steps = f"CAST(({mix}) % 4010001 AS DECIMAL(12,0)) * CAST(0.00001 AS DECIMAL(6,5))"
        return f"CAST({steps} - {shift} AS DECIMAL(10,7))"

    lat = degrees("l_orderkey * 7919 + l_linenumber * 104729 + l_suppkey * 31", 34)
    lng = degrees("l_orderkey * 6007 + l_linenumber * 15485863 + l_suppkey * 17", 74)
    return source.read("lineitem").select(
        F.monotonically_increasing_id().alias("geolocation_id"),
        F.expr("CAST(l_partkey % 380 AS INT)").alias("geolocation_zip_code_prefix"),
        F.expr(lat).alias("geolocation_lat"),
        F.expr(lng).alias("geolocation_lng"),
        F.expr("""
            concat(CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 'City_' ELSE 'city_' END,
                   l_partkey % 380 % 25 + l_suppkey % 2)""").alias("geolocation_city"),
        F.expr("""
            lpad(CAST((l_partkey % 380 + l_suppkey % 2) % 25 AS STRING), 2, '0')
            """).alias("geolocation_state"),
    )


_BUILDERS = {
    builder.__name__: builder
    for builder in (
        customers, sellers, category_translation, products, geolocation,
        orders, order_items, order_payments, order_reviews,
    )
}
