"""Every query by name. Each takes a session and a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelhouse.operators.digest import multiset_digest
from parcelhouse.operators.keys import key_problems, orphans
from parcelhouse.operators.upsert import upsert
from parcelhouse.plans import (
    audits, dimensions, facts, marts, pipeline, planted, profile, quality, reports,
)
from parcelhouse.plans.warehouse import Warehouse
from parcelhouse.session import kept, scratch_dir, shuffles_removed, tuned
from parcelhouse.sources.csv_files import CSV_FILES, CsvTables, write_csv
from parcelhouse.sources.driver_tables import RawTables
from parcelhouse.sources.shared_files import data_files, listed, remove
from parcelhouse.sources.store import RunLog, Store
from parcelhouse.tables import TABLES, in_layer

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(RawTables(tuned(spark), folder))


def from_warehouse(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    """Register a query planned in one piece from the source tables."""
    QUERIES[name] = lambda spark, folder: build(warehouse(spark, folder))


def stored(
    spark: SparkSession, folder: str, runs: int = 1, constraints: bool = False
) -> tuple[pipeline.Build, str]:
    """A warehouse built and written below a fresh path in the shared folder.

    The audits below take the place of the constraints that a run enforces by default.
    """
    root = scratch_dir(tuned(spark), "warehouse")
    raw = RawTables(spark, folder) if runs == 1 else delivered(spark, folder)
    for _ in range(runs):
        build = pipeline.run(spark, raw, root, constraints=constraints)
    return build, root


def delivered(spark: SparkSession, folder: str) -> RawTables:
    """Raw tables that several runs load. Those that take shuffles to derive are written once."""
    raw = RawTables(tuned(spark), folder)
    shuffled = ("order_items", "order_payments", "customers")
    with shuffles_removed(spark), ThreadPoolExecutor(len(shuffled)) as pool:
        raw.update(zip(shuffled, pool.map(kept, [raw[name] for name in shuffled])))
    return raw


_BUILT: dict[tuple, tuple[pipeline.Build, str]] = {}


def built(spark: SparkSession, folder: str) -> tuple[pipeline.Build, str]:
    """The stored warehouse of a folder, built once per application and state of the files."""
    files = [
        (name, size, changed, tuple(listed(spark, f"{folder}/{name}")))
        for name, size, changed in listed(spark, folder)
    ]
    key = (spark.sparkContext.applicationId, folder, tuple(files))
    if key not in _BUILT:
        _BUILT[key] = stored(spark, folder)
    build, root = _BUILT[key]
    return pipeline.Build(Store(tuned(spark), root), build.constraints), root


# Sources: the raw tables written as CSV, then loaded from there

def _load_csv(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        raw = RawTables(tuned(spark), folder)
        files = write_csv(raw, scratch_dir(spark, "csv"), [name])
        return CsvTables(spark, files)[name].drop("geolocation_id")
    return run


for _name in CSV_FILES:
    QUERIES[f"load_csv_{_name}"] = _load_csv(_name)


@query
def load_csv_bad_values(spark: SparkSession, folder: str) -> DataFrame:
    """Moments that cannot be read and missing-value texts in the orders file become NULL."""
    orders = RawTables(tuned(spark), folder)["orders"]
    unreadable = F.when(F.col("order_status") == "shipped", "soon").when(
        F.col("order_status") == "created", "N/A")
    as_text = F.col("order_approved_at").cast("string")
    spoilt = orders.withColumn("order_approved_at", F.coalesce(unreadable, as_text))
    files = write_csv({"orders": spoilt}, scratch_dir(spark, "csv"), ["orders"])
    return CsvTables(spark, files)["orders"]


@query
def load_csv_decimal_integers(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers exported as 40.0 and categories exported as a missing-value text."""
    products = RawTables(tuned(spark), folder)["products"]
    floats = {
        c: F.col(c).cast("decimal(12,1)").cast("string")
        for c in ("product_name_length", "product_description_length", "product_photos_qty")
    }
    no_name = F.coalesce("product_category_name", F.lit("nan"))
    spoilt = products.withColumns({**floats, "product_category_name": no_name})
    files = write_csv({"products": spoilt}, scratch_dir(spark, "csv"), ["products"])
    return CsvTables(spark, files)["products"]


@query
def load_csv_long_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents with line breaks and quotes as review messages."""
    documents = tuned(spark).read.parquet(f"{folder}/documents.parquet")
    label = F.col("source").cast("string")
    reviews = documents.select(
        F.col("doc_id").cast("string").alias("review_id"), label.alias("order_id"),
        F.lit(1).alias("review_score"), F.col("lang").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        *[F.lit(None).cast("timestamp_ntz").alias(m) for m in dimensions.REVIEW_MOMENTS],
    )
    files = write_csv({"order_reviews": reviews}, scratch_dir(spark, "csv"), ["order_reviews"])
    loaded = CsvTables(spark, files)["order_reviews"]
    return loaded.select("review_id", "order_id", "review_comment_title", "review_comment_message")


@query
def load_csv_stray_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that are not quoted but hold quotes, one or two of them."""
    reviews = RawTables(tuned(spark), folder)["order_reviews"]
    marked = reviews.withColumns({
        "review_comment_title": F.concat("review_id", F.lit('" or "x')),
        "review_comment_message": F.concat("order_id", F.lit('" tv')),
    })
    files = scratch_dir(spark, "csv")
    (
        marked.write.option("header", True).option("quote", "").option("escape", "\\")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(f"{files}/order_reviews_dataset.csv")
    )
    return CsvTables(spark, files)["order_reviews"]


# A text column of every table: where line breaks are put, and what is counted afterwards.
BROKEN_TEXTS = {
    "customers": "customer_city", "sellers": "seller_city", "products": "product_category_name",
    "category_translation": "product_category_name_english", "geolocation": "geolocation_city",
    "orders": "order_status", "order_items": "seller_id", "order_payments": "payment_type",
    "order_reviews": "review_comment_message",
}


@query
def load_csv_quoted_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """A text of every table with a line break, a comma and quotes; rows per text.

    One table after the other: its files and what was shuffled to read them are gone before the
    next is written, so the disk holds those of one table at a time.
    """
    raw = RawTables(tuned(spark), folder)
    tail = F.lit('\n"x", y')

    def counted(name: str, column: str) -> DataFrame:
        marked = raw[name].withColumn(column, F.concat(column, tail))
        files = write_csv({name: marked}, scratch_dir(spark, "csv"), [name])
        found = kept(
            CsvTables(spark, files)[name]
            .groupBy(F.lit(name).alias("table"), F.col(column).alias("text"))
            .agg(F.count(F.lit(1)).alias("rows")))
        remove(spark, files)
        return found

    with shuffles_removed(spark):
        return reduce(DataFrame.unionByName, [counted(*text) for text in BROKEN_TEXTS.items()])


@query
def raw_load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All nine CSV files loaded and published together; rows per table."""
    files = write_csv(RawTables(tuned(spark), folder), scratch_dir(spark, "csv"))
    build = pipeline.Build(Store(spark, scratch_dir(spark, "warehouse")))
    pipeline.load_raw(build, CsvTables(spark, files))
    return audits.row_counts(build.table, [t.name for t in in_layer("raw")])


@query
def number_items_by_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Items numbered the way oversized orders are, forced for every order above three lines."""
    return RawTables(tuned(spark), folder, rows_per_task=3)["order_items"]


@query
def load_csv_byte_order_mark(spark: SparkSession, folder: str) -> DataFrame:
    """A file that begins with a byte order mark."""
    raw = RawTables(tuned(spark), folder)["sellers"]
    first = raw.columns[0]
    marked = raw.withColumnRenamed(first, "\ufeff" + first)
    files = scratch_dir(spark, "csv")
    marked.write.option("header", True).csv(f"{files}/sellers_dataset.csv")
    return CsvTables(spark, files)["sellers"]


@query
def load_csv_point_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Points loaded from CSV and how many different ids they were given."""
    raw = RawTables(tuned(spark), folder)
    files = write_csv(raw, scratch_dir(spark, "csv"), ["geolocation"])
    return CsvTables(spark, files)["geolocation"].agg(
        F.count(F.lit(1)).alias("points"), F.count_distinct("geolocation_id").alias("ids"))


@query
def compare_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tables against the sizes of the files they come from.

    One expectation is made wrong and one is of a table that was not counted. The sizes are
    those the files state of themselves, so they do not come from the counted tables.
    """
    raw = RawTables(tuned(spark), folder)
    names = ["raw.customers", "raw.order_items", "raw.products", "raw.sellers"]
    actual = audits.row_counts(lambda name: raw[name.split(".")[1]], names)
    size = {t: raw.read(t).count() for t in ("orders", "lineitem", "part", "supplier")}
    expected = {
        "raw.customers": size["orders"], "raw.order_items": size["lineitem"],
        "raw.products": size["part"], "raw.sellers": size["supplier"] + 1,
        "raw.orders": size["orders"],
    }
    return audits.compare_counts(actual, expected)


@query
def schema_conformance(spark: SparkSession, folder: str) -> DataFrame:
    """Declared columns the raw tables lack, after two were taken away."""
    raw = RawTables(tuned(spark), folder)
    found = {t.name: raw[t.name.split(".")[1]] for t in in_layer("raw")}
    found["raw.sellers"] = found["raw.sellers"].drop("seller_city", "seller_state")
    return profile.conformance(found)


@query
def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    raw = RawTables(tuned(spark), folder)
    profiles = [
        profile.profile(raw[t.name.split(".")[1]].drop("geolocation_id"), t.name)
        for t in in_layer("raw")
    ]
    return reduce(DataFrame.unionByName, profiles)


# Tables

for _table in (*in_layer("staging"), *in_layer("analytics"), *in_layer("marts")):
    _name = _table.name.replace("staging.", "staging_").split(".")[-1]
    from_warehouse(_name, lambda w, name=_table.name: w.table(name))

from_warehouse("date_bounds", lambda w: dimensions.date_bounds(
    w.staging_orders, w.staging_order_reviews))
from_warehouse("items_per_order", lambda w: facts.items_per_order(w.fact_order_items))
from_warehouse("payments_per_order", lambda w: facts.payments_per_order(w.fact_payments))
from_warehouse("payments_by_order", lambda w: marts.payments_by_order(w.fact_payments))


# Upserts: an older state of the table, partly outdated, meets a newer delivery

def _upsert(table: str, older: str, outdated: dict[str, str], newer: str) -> None:
    def build(w: Warehouse) -> DataFrame:
        current = w.table(table)
        existing = current.where(older).withColumns({c: F.expr(e) for c, e in outdated.items()})
        return upsert(existing, current.where(newer), list(TABLES[table].key))
    from_warehouse(f"upsert_{table.split('.')[1]}", build)


def _merge(table: str, older: str, outdated: dict[str, str], newer: str) -> None:
    """The same for a table that is stored by month: through the store, as in a run."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        w = warehouse(spark, folder)
        current = kept(facts.by_month(w.table(table), w.staging_orders))
        store = Store(spark, scratch_dir(spark, "merge"))
        existing = current.where(older).withColumns({c: F.expr(e) for c, e in outdated.items()})
        store.publish({table: store.write(table, existing)})
        store.publish({table: store.merge(table, current.where(newer))})
        return store.read(table)
    QUERIES[f"upsert_{table.split('.')[1]}"] = run


_upsert("analytics.dim_date", "full_date < DATE'1997-01-01'", {"month_name": "'old'"},
        "full_date >= DATE'1995-01-01'")
_upsert("analytics.dim_geography", "state <= '12'", {"city": "'old'"}, "state >= '07'")
_upsert("analytics.dim_customer", "customer_state <= '12'", {"customer_city": "'old'"},
        "customer_state >= '07'")
_upsert("analytics.dim_seller", "seller_state <= '12'", {"seller_city": "'old'"},
        "seller_state >= '07'")
_upsert("analytics.dim_product", "coalesce(product_photos_qty, 0) <= 4",
        {"category_translation_status": "'old'"}, "product_photos_qty >= 3")
_merge("analytics.fact_orders", "purchase_date_key < 19970101", {"order_status": "'old'"},
        "purchase_date_key >= 19950101")
_merge("analytics.fact_order_items", "purchase_date_key < 19970101",
        {"price": "CAST(0 AS DECIMAL(12,2))"}, "purchase_date_key >= 19950101")
_merge("analytics.fact_payments", "payment_type <> 'boleto'", {"payment_installments": "99"},
        "payment_type <> 'voucher'")
_merge("analytics.fact_reviews", "review_score <= 3", {"review_score_category": "'old'"},
        "review_score >= 2")


STORED_BY_MONTH = [t.name for t in in_layer("analytics") if t.partition]


@query
def merge_linked_months(spark: SparkSession, folder: str) -> DataFrame:
    """Months of each fact that an upsert writes anew or links as they are.

    What comes in: all of 1995 as it is stored, a changed March 1996, and the rows of orders
    made in February 1997 that belong to odd order numbers.
    """
    w = warehouse(spark, folder)
    store = Store(spark, scratch_dir(spark, "merge"))
    changes = {
        "analytics.fact_orders": "order_status", "analytics.fact_order_items": "seller_id",
        "analytics.fact_payments": "payment_type", "analytics.fact_reviews": "review_score_category",
    }

    def counted(table: str) -> tuple:
        fact = facts.by_month(w.table(table), w.staging_orders)
        store.publish({table: store.write(table, fact)})
        before = store.current[table]
        c = changes[table]
        incoming = store.read_parts(table, before, True).where(
            "purchase_month DIV 100 = 1995 OR purchase_month = 199603 "
            "OR (purchase_month = 199702 AND order_id RLIKE '[13579]$')"
        ).withColumn(c, F.when(F.col("purchase_month") == 199603, F.lit("new")).otherwise(F.col(c)))
        store.publish({table: store.merge(table, incoming)})
        after = store.current[table]
        values = {p.value for p in after}
        linked = {p.value for p in after if p in before}
        rows = sum(p.rows for p in after)
        return table, len(values), len(linked), ", ".join(sorted(values - linked)), rows

    found = [counted(table) for table in STORED_BY_MONTH]
    return spark.createDataFrame(
        found, "table string, months int, linked_months int, written_months string, rows long")


# Checks and audits

def _checked(stage: str) -> Query:
    """As in a run, checks read the written tables."""
    return lambda spark, folder: quality.report(built(spark, folder)[0].table, stage)


for _stage in quality.STAGES:
    QUERIES[f"dq_{_stage}"] = _checked(_stage)


@query
def dq_planted_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Every critical check on tables that break it."""
    build, _ = built(spark, folder)
    checked = quality.report(planted.broken(build.table), *quality.STAGES)
    return checked.where("level = 'critical'")


@query
def gate_outcome(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each gate would stop the run, on tables as built and on broken ones."""
    build, _ = built(spark, folder)
    outcomes = [
        quality.outcome(quality.report(tables, *quality.STAGES)).withColumn("tables", F.lit(label))
        for label, tables in (("built", build.table), ("broken", planted.broken(build.table)))
    ]
    return reduce(DataFrame.unionByName, outcomes)


@query
def dq_warnings_per_stage(spark: SparkSession, folder: str) -> DataFrame:
    build, _ = built(spark, folder)
    return quality.warnings_per_stage(quality.report(build.table, *quality.STAGES))


@query
def report_warnings(spark: SparkSession, folder: str) -> DataFrame:
    build, _ = built(spark, folder)
    return reports.warnings(quality.report(build.table, *quality.STAGES))


AUDITED = [name for name in TABLES if not name.startswith("meta.")]


@query
def audit_primary_keys(spark: SparkSession, folder: str) -> DataFrame:
    build, _ = built(spark, folder)
    return audits.primary_keys(build.table, AUDITED)


@query
def audit_foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    build, _ = built(spark, folder)
    return audits.foreign_keys(build.table, AUDITED)


@query
def audit_domains(spark: SparkSession, folder: str) -> DataFrame:
    build, _ = built(spark, folder)
    return audits.domains(build.table, AUDITED)


@query
def audit_planted_domains(spark: SparkSession, folder: str) -> DataFrame:
    """Domain rules on tables with rows without any value and rows of over-long texts."""
    build, _ = built(spark, folder)
    return audits.domains(planted.with_spoilt_values(build.table), AUDITED)


@query
def audit_value_checks(spark: SparkSession, folder: str) -> DataFrame:
    build, root = built(spark, folder)
    log = RunLog(spark, root)

    def table(name: str) -> DataFrame:
        return log.runs() if name.startswith("meta.") else build.table(name)

    return audits.value_checks(table, TABLES)


@query
def audit_planted_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of tables that hold every row twice and once without its key."""
    build, _ = built(spark, folder)
    return audits.primary_keys(planted.with_repeated_keys(build.table), AUDITED)


@query
def audit_planted_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Foreign keys whose parents with odd keys are gone."""
    build, _ = built(spark, folder)
    found = [
        audits.foreign_keys(planted.without_odd_keys(build.table, name), [name])
        for name in AUDITED if TABLES[name].parents
    ]
    return reduce(DataFrame.unionByName, found)


@query
def audit_planted_values(spark: SparkSession, folder: str) -> DataFrame:
    """Value rules on scores out of range and a run in an unknown state."""
    build, root = built(spark, folder)
    runs = RunLog(spark, root).runs()
    tables = planted.with_wrong_values(
        lambda name: runs if name.startswith("meta.") else build.table(name))
    return audits.value_checks(tables, TABLES)


@query
def audit_line_number_as_key(spark: SparkSession, folder: str) -> DataFrame:
    """Order and line number do not identify a line: how often is the pair used again?"""
    lines = RawTables(tuned(spark), folder).read("lineitem")
    return key_problems(lines, ["l_orderkey", "l_linenumber"])


@query
def audit_payments_of_undelivered(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with payments that are missing among the delivered orders."""
    w = warehouse(spark, folder)
    delivered = w.staging_orders.where("order_status = 'delivered'")
    return orphans(w.staging_order_payments, ["order_id"], delivered, ["order_id"])


# Runs

@query
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    _, root = stored(spark, folder, constraints=True)
    runs = RunLog(spark, root).runs()
    return runs.select("run_id", "status", "failed_step", "rows_loaded", "warnings")


@query
def rerun_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table after the whole build ran twice over the same store."""
    build, _ = stored(spark, folder, runs=2)
    return audits.row_counts(build.table, AUDITED)


@query
def rerun_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the second run over the same store left every table with the same rows.

    The generated id of a point is left out: it tells points apart and means nothing else.
    """
    raw, root = delivered(spark, folder), scratch_dir(spark, "warehouse")
    first = pipeline.run(spark, raw, root, constraints=False)
    pipeline.run(spark, raw, root, constraints=False)
    second = Store(spark, root)

    def digest(store: Store, name: str) -> DataFrame:
        counted = [a.alias(label) for label, a in multiset_digest(
            [c for c in TABLES[name].names if c != "geolocation_id"]).items()]
        return store.read(name).agg(*counted).withColumn("table", F.lit(name))

    before, after = (
        reduce(DataFrame.unionByName, [digest(store, name) for name in AUDITED])
        for store in (first.store, second))
    same = (F.col("a.sum_1") == F.col("b.sum_1")) & (F.col("a.sum_2") == F.col("b.sum_2"))
    return before.alias("a").join(after.alias("b"), "table").select(
        "table", F.col("a.rows").alias("rows_before"), F.col("b.rows").alias("rows_after"),
        (same & (F.col("a.rows") == F.col("b.rows"))).alias("same_rows"))


@query
def version_history(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of every table after three runs of which two are kept, and what lies on disk.

    Folders that no kept version lists are gone, and each file listed by the current version
    is there.
    """
    raw, root = delivered(spark, folder), scratch_dir(spark, "warehouse")
    for _ in range(3):
        build = pipeline.run(spark, raw, root, constraints=False, keep_versions=2)
    store = build.store
    dead = store.unreachable(2)
    on_disk = [
        (name, sum(data_files(spark, f"{root}/{p.path}") for p in store.current[name]),
         sum(path.startswith(name.replace(".", "/") + "/") for path in dead))
        for name in AUDITED
    ]
    found = spark.createDataFrame(on_disk, "table string, found long, unreachable_folders long")
    return store.history().join(found, "table").select(
        "table", "versions", "versions_kept", "rows",
        (F.col("files") - F.col("found")).alias("missing_files"), "unreachable_folders")


@query
def run_log_states(spark: SparkSession, folder: str) -> DataFrame:
    """Runs that succeeded, failed at a check, were killed and taken over, and one in progress."""
    raw, root = delivered(spark, folder), scratch_dir(spark, "warehouse")

    def run(raw, **how):
        pipeline.run(spark, raw, root, constraints=False, **how)

    run(raw)
    broken = RawTables(spark, folder)
    broken.update(raw)
    broken["orders"] = broken["orders"].withColumn("order_status", F.lit("lost"))
    try:
        run(broken)
    except pipeline.PipelineFailed:
        pass
    log = RunLog(spark, root)
    log.start()  # killed: nothing follows
    run(raw, take_over=True)
    log.start()
    return log.runs().select(
        "run_id", "status", "failed_step", "error_message", "rows_loaded", "warnings",
        F.col("finished_at").isNotNull().alias("finished"))


# Report figures

REPORTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "late_rate": lambda w: reports.late_rate(w.delivery_performance),
    "late_rate_by_month": lambda w: reports.late_rate_by_month(
        w.delivery_performance, w.dim_date),
    "late_rate_by_state": lambda w: reports.late_rate_by_state(w.delivery_performance),
    "extreme_states": lambda w: reports.extreme_states(w.delivery_performance),
    "score_by_lateness": lambda w: reports.score_by_lateness(w.customer_performance),
    "repeat_share": lambda w: reports.repeat_share(w.customer_performance),
    "spend_by_repeat": lambda w: reports.spend_by_repeat(w.customer_performance),
    "freight_share": lambda w: reports.freight_share(w.category_performance),
    "freight_share_by_category": lambda w: reports.freight_share_by_category(
        w.category_performance),
    "top_freight_shares": lambda w: reports.top_freight_shares(w.category_performance),
    "reconciled_share": lambda w: reports.reconciled_share(w.order_summary),
    "row_counts": lambda w: audits.row_counts(w.table, reports.PUBLISHED),
    "delivery_categories": lambda w: reports.delivery_categories(w.delivery_performance),
    "translation_statuses": lambda w: reports.translation_statuses(w.dim_product),
    "category_summary": lambda w: reports.category_summary(
        w.category_performance, w.fact_order_items, w.dim_product),
    "top_categories": lambda w: reports.top_categories(w.category_performance),
    "customer_summary": lambda w: reports.customer_summary(w.customer_performance),
    "by_payment_type": lambda w: reports.by_payment_type(w.payment_analysis),
    "by_installment_band": lambda w: reports.by_installment_band(w.payment_analysis),
    "payments_without_items": lambda w: reports.payments_without_items(w.payment_analysis),
    "money_totals": lambda w: reports.money_totals(w.order_summary),
    "reconciliation": lambda w: reports.reconciliation(w.order_summary),
    "lateness_basis": lambda w: reports.lateness_basis(w.staging_orders),
    "fan_out": lambda w: reports.fan_out(w.fact_order_items, w.fact_payments),
    "repeated_reviews_and_moves": lambda w: reports.repeated_reviews_and_moves(
        w.fact_reviews, w.dim_customer),
}
for _name, _build in REPORTS.items():
    from_warehouse(f"report_{_name}", _build)
