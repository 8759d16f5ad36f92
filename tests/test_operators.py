"""Operators against a plain computation, also with one dominant group."""

import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from comparing import rows
from parcelhouse.operators.numbering import number_within, range_bounds
from parcelhouse.operators.upsert import upsert
from parcelhouse.plans.facts import order_items
from parcelhouse.plans.warehouse import Warehouse
from parcelhouse.session import checkpointed, scratch_dir, shared_dir
from parcelhouse.sources.driver_tables import RawTables


@pytest.fixture
def lines(spark, small):
    """Lines of which a third belong to one order, with many equal rows among them."""
    df = spark.read.parquet(f"{small}/lineitem.parquet").select(
        F.when(F.col("l_partkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")).alias("k"),
        "l_linenumber", (F.col("l_suppkey") % 4).alias("s"), F.xxhash64("*").alias("tie"),
    )
    return df.unionByName(df.withColumn("tie", F.col("tie") + 1))


ORDER = ["l_linenumber", "s", "tie"]


def test_bounds_are_those_of_oversized_groups(lines):
    sizes = {r["k"]: r["count"] for r in lines.groupBy("k").count().collect()}
    found = {r["k"]: r["_bounds"] for r in range_bounds(lines, "k", ORDER, 1000).collect()}
    assert set(found) == {7} and abs(len(found[7]) - sizes[7] / 1000) <= 2
    assert found[7] == sorted(set(found[7]))
    assert range_bounds(lines, "k", ORDER, 1_000_000).isEmpty()


def test_bounds_come_out_the_same_however_rows_lie(lines):
    bounds = [
        {r["k"]: r["_bounds"] for r in range_bounds(df, "k", ORDER, 300).collect()}
        for df in (lines, lines.repartition(13), lines.orderBy("s").coalesce(2))
    ]
    assert bounds[0] and bounds[0] == bounds[1] == bounds[2]


@pytest.mark.parametrize("limit", [3, 40, 1000, 1_000_000])
def test_numbers_equal_a_window_over_the_whole_group(lines, limit):
    window = Window.partitionBy("k").orderBy(*ORDER)
    expected = lines.withColumn("n", F.row_number().over(window).cast("bigint"))
    got = number_within(lines, "k", ORDER, "n", limit)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_equal_rows_get_different_numbers(spark):
    same = spark.range(2000).selectExpr("1 AS k", "5 AS v")
    got = number_within(same, "k", ["v"], "n", 100)
    assert got.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (2000, 1, 2000)


def test_sampled_rows_of_one_place_are_one(spark):
    """Equal rows share a hash, so either all or none of them fall into the sample."""
    same = spark.range(5000).selectExpr("1 AS k", "id % 40 AS v")
    for r in range_bounds(same, "k", ["v"], 16).collect():
        assert len(r["_bounds"]) <= 40


def test_dominant_group_is_spread(spark, lines):
    got = number_within(lines, "k", ORDER, "n", 300)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = [r["count"] for r in got.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(held) > 1 and max(held) < 0.7 * sum(held)


def test_bounds_of_small_ranges_are_not_broadcast(spark, lines):
    """There are as many bounds as rows over the limit, so only large limits make them few."""
    spread = number_within(lines, "k", ORDER, "n", 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in spread
    few = number_within(lines, "k", ORDER, "n", 5_000_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in few


@pytest.mark.parametrize("limit", [2, 300, 5_000_000])
def test_rows_without_a_key_are_numbered_too(lines, limit):
    some = lines.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    window = Window.partitionBy("k").orderBy(*ORDER)
    expected = some.withColumn("n", F.row_number().over(window).cast("bigint"))
    got = number_within(some, "k", ORDER, "n", limit)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_columns_that_only_spread_rows_are_not_shuffled(spark):
    same = spark.range(5000).select(F.lit("a").alias("k"), F.lit(1).alias("v"), F.col("id").alias("place"))
    got = number_within(same, "k", ["v"], "n", 100, ("place",))
    assert got.columns == ["k", "v", "n"]
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 5001))
    plan = number_within(same, "k", ["v"], "n", 1_000_000, ("place",))._jdf.queryExecution().optimizedPlan()
    windows = [line for line in plan.toString().splitlines() if "Window [row_number" in line]
    assert windows and not any("place" in line for line in windows)


def jobs_of(spark, action):
    """What an action returns and how many jobs it ran."""
    context, group = spark.sparkContext, f"jobs-{uuid.uuid4()}"
    context.setJobGroup(group, "counted")
    try:
        result = action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return result, len(context.statusTracker().getJobIdsForGroup(group))


def test_nothing_runs_while_numbers_are_planned(spark, small):
    raw = RawTables(spark, small, rows_per_task=3)
    spark.read.parquet(f"{small}/lineitem.parquet").schema  # the files' schema is known
    items, _ = jobs_of(spark, lambda: raw["order_items"])
    numbered, jobs = jobs_of(spark, lambda: number_within(
        items.drop("order_item_id"), "order_id", ["price", "product_id"], "n", 3))
    assert jobs == 0
    assert jobs_of(spark, numbered.count)[1] > 0


def test_numbers_nobody_reads_cost_nothing(spark, small):
    summary = Warehouse(RawTables(spark, small)).order_summary
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "_bounds" not in plan
    assert scans(plan, "l_orderkey") == 2  # items, and the totals that payments are made from


def scans(plan: str, column: str) -> int:
    return sum("Relation [" in line and column in line for line in plan.splitlines())


def test_payments_are_grouped_once(spark, small):
    plan = Warehouse(RawTables(spark, small)).payment_analysis._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_set(") == 1
    assert scans(plan, "l_orderkey") == 2


def test_upsert(spark):
    def frame(*r):
        return spark.createDataFrame(list(r), "k int, l int, v string")
    old = frame((1, 1, "old"), (1, 2, "old"), (2, 1, "old"))
    new = frame((1, 2, "new"), (3, 1, "new"))
    merged = upsert(old, new, ["k", "l"])
    assert rows(merged) == {(1, 1, "old"), (1, 2, "new"), (2, 1, "old"), (3, 1, "new")}
    assert rows(upsert(merged, new, ["k", "l"])) == rows(merged)
    assert rows(upsert(None, new, ["k", "l"])) == rows(new)


def test_skewed_join_is_split(spark, frame, small):
    """A third of all items on one order: the join splits that order over several tasks."""
    items = spark.read.parquet(f"{small}/lineitem.parquet").select(
        F.when(F.col("l_partkey") % 3 == 0, "o1").otherwise(F.concat(F.lit("o"), "l_orderkey")).alias("order_id"),
        F.lit(1).cast("bigint").alias("order_item_id"),
        *[F.concat(F.lit("p"), F.uuid()).alias(c) for c in ("product_id", "seller_id")],
        *[F.col("l_quantity").cast("decimal(12,2)").alias(c)
          for c in ("price", "freight_value", "item_total_value")],
    ).repartition(16)
    orders = spark.read.parquet(f"{small}/orders.parquet").select(
        F.concat(F.lit("o"), "o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = order_items(items, orders)
        wide = [F.count("product_id").alias("n"), F.max("product_id"), F.max("seller_id")]
        per_order = joined.groupBy("order_id").agg(*wide)
        per_order.collect()
        plan = per_order._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        expected = items.join(orders, "order_id").groupBy("order_id").agg(F.count("*").alias("n"))
        assert rows(per_order, "order_id", "n") == rows(expected)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_checkpoints_go_to_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(shared_dir(spark))
    df = checkpointed(spark.range(5))
    assert df.count() == 5
    assert spark.sparkContext.getCheckpointDir() is not None
