"""The whole build: load, check and publish one layer after the other."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelhouse.operators.upsert import upsert
from parcelhouse.plans import audits, dimensions, facts, marts, quality, staging
from parcelhouse.session import shuffles_removed
from parcelhouse.sources.store import Draft, RunLog, Store
from parcelhouse.tables import TABLES, in_layer



# A written table of at most this many rows that others only look up is broadcast.
LOOKUP_ROWS = 1_000_000


class PipelineFailed(Exception):
    """A step failed; the message names it and the cause is attached."""


@dataclass
class Build:
    """State of one run: the store, and the numbers the run log keeps.

    `same` says that no table published so far differs from its version before. What is built
    from such tables most likely does not either.
    """

    store: Store
    constraints: bool = True
    same: bool = True
    rows_loaded: int = 0
    warnings: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    def lookup(self, name: str, drafts: Mapping[str, Draft] | None = None) -> DataFrame:
        """A written table for a join that looks up rows by its key.

        Its rows were counted while it was written. Spark only knows the size of its files and
        would shuffle the table that looks up for one that is small.
        """
        parts = drafts[name].parts if drafts else self.store.current[name]
        found = self.store.read(name, drafts)
        return F.broadcast(found) if sum(p.rows for p in parts) <= LOOKUP_ROWS else found

    def write(
        self, frames: Mapping[str, Callable[[], DataFrame]], merge: bool = False
    ) -> dict[str, Draft]:
        """Write tables side by side, counting the rows that break their domain rules."""
        rules = audits.domain_measures if self.constraints else None
        return self.store.write_all(frames, rules, merge, expect_same=self.same)

    def publish(
        self, frames: Mapping[str, Callable[[], DataFrame]], merge: bool = False,
        written: Mapping[str, Draft] | None = None,
    ) -> int:
        """Write tables side by side, hold them to their declared rules, make them current.

        `written` are drafts that become current together with them.

        Only rows that arrive are held to the rules, and older parts that never were. A checked
        part that is linked again holds no arriving key, and no table it refers to loses rows
        by an upsert.
        """
        drafts = {**(written or {}), **self.write(frames, merge)}
        if self.constraints:
            outside = {k: v for draft in drafts.values() for k, v in draft.measures.items()}
            overlooked = {name: d.unchecked for name, d in drafts.items() if d.unchecked}
            outside.update(audits.domain_failures(
                lambda name: self.store.read_parts(name, overlooked[name]), list(overlooked)))
            audits.enforce(
                lambda name: self.store.read_parts(
                    name, (*drafts[name].arrived, *drafts[name].unchecked)),
                lambda name: self.store.read(name, drafts),
                [name for name, d in drafts.items() if d.arrived or d.unchecked], outside)
            drafts = {name: draft.passed() for name, draft in drafts.items()}
        self.same = self.same and not any(self.store.differs(n, d) for n, d in drafts.items())
        self.store.publish(drafts)
        self.counts.update({name: draft.rows for name, draft in drafts.items()})
        return sum(draft.rows for draft in drafts.values())

    def merge(self, frames: Mapping[str, Callable[[], DataFrame]]) -> None:
        """Upsert into the current versions by declared key.

        Tables with a partition column are written where they change, others as a whole.
        """

        def merged(name: str, incoming: Callable[[], DataFrame]) -> DataFrame:
            existing = self.table(name) if self.store.has(name) else None
            return upsert(existing, incoming(), list(TABLES[name].key))

        self.publish({
            name: new if TABLES[name].partition else partial(merged, name, new)
            for name, new in frames.items()
        }, merge=True)


def load_raw(build: Build, raw: Mapping[str, DataFrame]) -> None:
    """All raw tables become current together."""
    names = [t.name for t in in_layer("raw")]
    build.rows_loaded += build.publish({n: partial(raw.__getitem__, n.split(".")[1]) for n in names})


def _layer(build: Build, layer: str) -> dict[str, DataFrame]:
    return {t.name.split(".")[1]: build.table(t.name) for t in in_layer(layer)}


def build_staging(build: Build) -> None:
    """All staging tables become current together."""
    raw = _layer(build, "raw")
    looked_up = build.write({
        "staging.sellers": lambda: staging.sellers(raw["sellers"]),
        "staging.products": lambda: staging.products(
            raw["products"], raw["category_translation"]),
    })
    build.publish({
        "staging.customers": lambda: staging.customers(raw["customers"]),
        "staging.geolocation": lambda: staging.geolocation(raw["geolocation"]),
        "staging.orders": lambda: staging.orders(raw["orders"]),
        "staging.order_items": lambda: staging.order_items(
            raw["order_items"], build.lookup("staging.products", looked_up),
            build.lookup("staging.sellers", looked_up)),
        "staging.order_payments": lambda: staging.order_payments(raw["order_payments"]),
        "staging.order_reviews": lambda: staging.order_reviews(raw["order_reviews"]),
    }, written=looked_up)


def build_dimensions(build: Build) -> None:
    s = _layer(build, "staging")
    build.merge({
        "analytics.dim_date": lambda: dimensions.date(s["orders"], s["order_reviews"]),
        "analytics.dim_geography": lambda: dimensions.geography(s["geolocation"]),
        "analytics.dim_customer": lambda: dimensions.customer(s["customers"], s["geolocation"]),
        "analytics.dim_seller": lambda: dimensions.seller(s["sellers"], s["geolocation"]),
        "analytics.dim_product": lambda: dimensions.product(s["products"]),
    })


def build_facts(build: Build) -> None:
    s = _layer(build, "staging")
    build.merge({
        f"analytics.{name}": partial(facts.by_month, fact, s["orders"])
        for name, fact in {
            "fact_orders": facts.orders(s["orders"]),
            "fact_order_items": facts.order_items(s["order_items"], s["orders"]),
            "fact_payments": facts.payments(s["order_payments"]),
            "fact_reviews": facts.reviews(s["order_reviews"]),
        }.items()
    })
    build.publish({
        "analytics.order_summary": lambda: facts.order_summary(
            build.table("analytics.fact_orders"),
            build.table("analytics.fact_order_items"),
            build.table("analytics.fact_payments"),
        )
    })


def build_marts(build: Build) -> None:
    a = _layer(build, "analytics")
    build.publish({
        "marts.delivery_performance": lambda: marts.delivery_performance(
            a["fact_orders"], a["dim_customer"]),
        "marts.category_performance": lambda: marts.category_performance(
            a["fact_order_items"], build.lookup("analytics.dim_product")),
        "marts.customer_performance": lambda: marts.customer_performance(
            a["order_summary"], a["dim_customer"], a["fact_reviews"]),
        "marts.payment_analysis": lambda: marts.payment_analysis(
            a["order_summary"], a["dim_customer"], a["fact_payments"]),
    })


def check(stage: str) -> Callable[[Build], None]:
    def step(build: Build) -> None:
        build.warnings += quality.gate(build.table, stage)
    return step


def check_counts(expected: Mapping[str, int]) -> Callable[[Build], None]:
    def step(build: Build) -> None:
        counted = audits.row_counts(build.table, expected)
        wrong = audits.compare_counts(counted, dict(expected)).where("NOT ok").collect()
        if wrong:
            raise audits.IntegrityError("Row counts do not match: " + ", ".join(
                f"{r['table']} {r['rows']} instead of {r['expected']}" for r in wrong))
    return step


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    expected: Mapping[str, int] | None = None,
    constraints: bool = True,
    keep_versions: int = 3,
    take_over: bool = False,
) -> Build:
    """Build the warehouse below `root` from the nine raw tables.

    Stops at the first failing step and records it in the run log. Running twice gives the
    same tables as running once. Only one run at a time holds the store; a run that was
    killed can be taken over, and is refused if it publishes after that. At the end of a run
    the newest `keep_versions` versions of each table are kept.
    """
    log = RunLog(spark, root)
    run_id, started = log.start(take_over)
    store = Store(spark, root, run_id)
    store.fence()
    build = Build(store, constraints)
    steps: list[tuple[str, Callable[[Build], None]]] = [
        ("Load raw", lambda b: load_raw(b, raw)),
        ("Check raw", check("raw")),
        ("Build staging", build_staging),
        ("Check staging", check("staging")),
        ("Build dimensions", build_dimensions),
        ("Build facts", build_facts),
        ("Check analytics", check("analytics")),
        ("Build marts", build_marts),
        ("Check marts", check("marts")),
    ]
    if expected:
        steps.append(("Row counts", check_counts(expected)))
    steps.append(("Expire versions", lambda b: b.store.expire(keep_versions)))
    for name, step in steps:
        began = time.perf_counter()
        try:
            log.step(run_id, started)
            with shuffles_removed(spark):
                step(build)
            build.seconds[name] = round(time.perf_counter() - began, 2)
        except Exception as error:
            log.finish(run_id, started, "failed", build.rows_loaded, build.warnings,
                       name, str(error))
            raise PipelineFailed(f"{name}: {error}") from error
    log.finish(run_id, started, "succeeded", build.rows_loaded, build.warnings)
    return build
