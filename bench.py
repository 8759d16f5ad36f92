"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of Parquet tables, BENCH_CPUS the number of local cores.
Queries are timed as the better of two runs that read every result row; the CSV load and
the full pipeline (from CSV, with all checks and constraints) run once.
"""

from __future__ import annotations

import json
import os
import time

from parcelhouse.plans import audits, pipeline
from parcelhouse.queries import QUERIES, built
from parcelhouse.session import local_session, scratch_dir
from parcelhouse.sources.csv_files import CsvTables, write_csv
from parcelhouse.sources.driver_tables import RawTables
from parcelhouse.sources.store import Store
from parcelhouse.tables import in_layer

HEADLINE = (
    "staging_geolocation", "staging_orders", "staging_order_items", "staging_order_reviews",
    "dim_date", "dim_customer", "fact_orders", "fact_order_items", "order_summary",
    "delivery_performance", "category_performance", "customer_performance", "payment_analysis",
    "dq_raw", "dq_analytics", "table_profile", "report_late_rate_by_month",
    "report_score_by_lateness", "report_by_payment_type", "report_reconciliation",
    "report_fan_out",
)


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds: dict[str, float] = {}

    # The warehouse that the dq_ queries read is built once and timed by itself.
    seconds["dq_stored_build"] = timed(lambda: built(spark, folder))

    for name in HEADLINE:
        def run(name=name):
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = min(timed(run), timed(run))

    files = write_csv(RawTables(spark, folder), scratch_dir(spark, "bench-csv"))

    def load():
        build = pipeline.Build(Store(spark, scratch_dir(spark, "bench-load")), constraints=False)
        pipeline.load_raw(build, CsvTables(spark, files))

    seconds["csv_raw_load"] = timed(load)
    root = scratch_dir(spark, "bench-pipeline")
    seconds["full_pipeline_from_csv"] = timed(
        lambda: pipeline.run(spark, CsvTables(spark, files), root)
    )
    store = Store(spark, root)
    raw = audits.row_counts(store.read, [t.name for t in in_layer("raw")])
    raw_rows = raw.groupBy().sum("rows").first()[0]

    print(json.dumps({
        "metric": "total seconds of headline queries, CSV load and full pipeline",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "raw_rows": raw_rows,
    }))


if __name__ == "__main__":
    main()
