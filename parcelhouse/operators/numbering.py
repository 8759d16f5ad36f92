"""Row numbers within a group, also when one group holds most of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group up to this size is sorted by one task; a larger one in ranges of about this size.
ROWS_PER_TASK = 5_000_000
# Rows looked at per range to find its upper bound.
SAMPLES_PER_RANGE = 16
# Bounds are searched in two steps, first every so many of them.
STRIDE = 50
# There is about one bound per `limit` rows. Of smaller limits they are too many to broadcast.
BROADCAST_FROM = 100_000


def range_bounds(df: DataFrame, key: str, order: list[str], limit: int) -> DataFrame:
    """Of every key with about `limit` rows or more: `_bounds`, places that cut it into ranges.

    Bounds are taken from the rows whose hash of the sort columns falls on a fixed share of
    all values, so they depend on the data alone and come out the same whenever the plan, or
    a lost part of it, runs again. Of all rows about one in `limit` becomes a bound; equal rows
    are one.
    """
    every = max(1, limit // SAMPLES_PER_RANGE)
    step = max(1, limit // every)
    sample = df.where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0)

    def each(n: int, places: Column) -> Column:
        return F.filter(places, lambda _, i: (i + 1) % n == 0)

    return (
        sample.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(*order))).alias("_sample"))
        .select(key, each(step, F.col("_sample")).alias("_bounds"))
        .select(key, "_bounds", each(STRIDE, F.col("_bounds")).alias("_strides"))
        .where(F.size("_bounds") > 0)
    )


def _range(order: list[str]) -> Column:
    """How many bounds lie below the row; 0 in a group without bounds."""
    place = F.struct(*order)

    def below(places: Column) -> Column:
        return F.size(F.filter(places, lambda b: b < place))

    passed = below(F.col("_strides")) * STRIDE
    searched = passed + below(F.slice("_bounds", passed + 1, F.lit(STRIDE)))
    return F.when(F.col("_bounds").isNotNull(), searched).otherwise(0)


def number_within(
    df: DataFrame, key: str, order: list[str], name: str, limit: int = ROWS_PER_TASK,
    spread: tuple[str, ...] = (),
) -> DataFrame:
    """Add `name`: 1, 2, 3... within each `key`, in the order of `order`.

    Groups of about `limit` rows or more are cut into ranges. The number is the place within
    the range plus the size of the group's earlier ranges. `limit` decides how the work is
    spread, never what the numbers are.

    There is about one bound per `limit` rows of the whole table. From BROADCAST_FROM on that
    is few, and bounds are broadcast; else they are joined by key, and sizes by range.

    Nothing runs while the plan is made, and where the number is not read, Spark leaves out
    all of this, as the tables joined here have one row per key. Rows that agree in all of
    `order` are numbered in any order and lie in one range, unless columns of `spread` tell them
    apart. These decide on ranges only, so they are not shuffled, and the result is without them.
    """
    within_order, order = order, [*order, *spread]
    columns = [c for c in df.columns if c not in spread]
    bounds = range_bounds(df, key, order, limit)
    few = limit >= BROADCAST_FROM
    bounds = F.broadcast(bounds) if few else bounds
    held = df.join(bounds, key).select(key, _range(order).alias("_range"))
    sizes = held.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_size"))
    ranged = df.join(bounds, key, "left").withColumn("_range", _range(order)).drop(*spread)
    within = Window.partitionBy(key, "_range").orderBy(*within_order)
    place = F.row_number().over(within).cast("bigint")
    if not few:
        below = Window.partitionBy(key).orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1)
        starts = sizes.select(key, "_range", F.sum("_size").over(below).alias("_before"))
        placed = ranged.select(*columns, "_range").repartition(key, "_range").withColumn(
            name, place)
        return placed.join(starts, [key, "_range"], "left").select(
            *columns, (F.col(name) + F.coalesce("_before", F.lit(0))).alias(name))
    # A bound is a row and lies in the range it closes, so no range before the last is empty.
    in_order = F.array_sort(F.collect_list(F.struct("_range", "_size")))
    earlier = sizes.groupBy(key).agg(in_order.alias("_sizes")).select(
        key,
        F.aggregate(
            "_sizes", F.array(F.lit(0).cast("bigint")),
            lambda sums, s: F.concat(sums, F.array(F.element_at(sums, -1) + s["_size"])),
        ).alias("_earlier"),
    )
    before = F.coalesce(F.try_element_at("_earlier", F.col("_range") + 1), F.lit(0))
    numbered = ranged.join(F.broadcast(earlier), key, "left").withColumn(name, place + before)
    return numbered.select(*columns, name)
