"""The store, the run log and whole builds."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from pyarrow import parquet
from pyspark.sql import functions as F

from comparing import rows
from parcelhouse import queries
from parcelhouse.operators.digest import multiset_digest
from parcelhouse.operators.upsert import upsert
from parcelhouse.plans import facts, pipeline
from parcelhouse.plans.warehouse import Warehouse
from parcelhouse.session import REMOVE_SHUFFLES, kept, scratch_dir, shuffles_removed
from parcelhouse.sources import driver_tables
from parcelhouse.sources.csv_files import CsvTables, write_csv
from parcelhouse.sources.driver_tables import RawTables
from parcelhouse.sources.shared_files import listed, put_if_absent
from parcelhouse.sources.store import Outdated, RunInProgress, RunLog, Store
from parcelhouse.tables import TABLES, in_layer

STORED = [n for n in TABLES if not n.startswith("meta.")]
SELLER = {"seller_id": "s", "seller_zip_code_prefix": 1, "seller_city": "x", "seller_state": "SP"}


@pytest.fixture
def root(spark):
    return scratch_dir(spark, "test")


def put(store, name, df):
    draft = store.write(name, df)
    store.publish({name: draft})
    return draft.rows


def test_write_counts_rows_and_publishes(spark, frame, root):
    store = Store(spark, root)
    assert put(store, "raw.sellers", frame("raw.sellers", SELLER)) == 1
    assert put(store, "raw.sellers", frame("raw.sellers")) == 0
    assert put(store, "raw.sellers", frame("raw.sellers", SELLER, {**SELLER, "seller_id": "t"})) == 2
    assert Store(spark, root).read("raw.sellers").count() == 2


def test_draft_is_not_visible_before_publishing(spark, frame, root):
    store = Store(spark, root)
    put(store, "raw.sellers", frame("raw.sellers", SELLER))
    draft = store.write("raw.sellers", frame("raw.sellers"))
    assert Store(spark, root).read("raw.sellers").count() == 1
    assert store.read("raw.sellers", {"raw.sellers": draft}).count() == 0


def test_broken_table_is_not_published(spark, frame, root):
    build = pipeline.Build(Store(spark, root))
    build.publish({"raw.sellers": lambda: frame("raw.sellers", SELLER)})
    for extra, message in (
        (SELLER, r"raw.sellers \(seller_id\)"),
        ({**SELLER, "seller_id": "t", "seller_state": "SPX"}, "seller_state: length <= 2"),
        ({**SELLER, "seller_id": "t", "seller_city": None}, "seller_city: not null"),
    ):
        with pytest.raises(pipeline.audits.IntegrityError, match=message):
            build.publish({"raw.sellers": lambda: frame("raw.sellers", SELLER, extra)})
    assert Store(spark, root).read("raw.sellers").count() == 1


def test_merge_keeps_rows_that_do_not_come_again(spark, frame, root):
    build = pipeline.Build(Store(spark, root), constraints=False)
    name, other = "analytics.dim_seller", {**SELLER, "seller_id": "t"}
    build.merge({name: lambda: frame(name, SELLER, other)})
    build.merge({name: lambda: frame(name, {**SELLER, "seller_city": "y"})})
    assert rows(build.table("analytics.dim_seller"), "seller_id", "seller_city") == {("s", "y"), ("t", "x")}


CUSTOMER = {"customer_unique_id": "u", "customer_zip_code_prefix": 1, "customer_city": "x", "customer_state": "SP"}
DAY = {"year": 2017, "quarter": 1, "month": 1, "month_name": "January", "week": 1, "day": 1,
       "day_name": "Monday", "is_weekend": False}
ORDER = {"customer_id": "c", "order_status": "delivered"}


def bought(frame, *orders):
    """fact_orders rows (order_id, day, status) with their month."""
    made = frame("analytics.fact_orders", *[
        {**ORDER, "order_id": o, "purchase_date_key": day, "order_status": status} for o, day, status in orders])
    return facts.by_month(made, None)


def months_of(store, name="analytics.fact_orders"):
    found = {}
    for part in store.current[name]:
        found.setdefault(part.value, set()).add(part.path)
    return found


def files_of(store, spark, root, value, name="analytics.fact_orders"):
    paths = [f"{root}/{p.path}" for p in store.current[name] if p.value == value]
    return {f for p in paths for f in spark.read.parquet(p).inputFiles()}


def test_merge_links_untouched_months(spark, frame, root):
    """Of four months one is delivered again as it is, one changes, two do not come in."""
    name, store = "analytics.fact_orders", Store(spark, root)
    first = [("a", 20170105, "x"), ("b", 20170106, "x"), ("c", 20170210, "x"), ("d", 20170310, "x"),
             ("e", 20170410, "x"), ("f", 20170411, "x")]
    store.publish({name: store.write(name, bought(frame, *first))})
    before = {m: files_of(store, spark, root, m) for m in ("201701", "201702", "201703", "201704")}
    store.publish({name: store.merge(name, bought(
        frame, ("a", 20170105, "new"), ("g", 20170120, "x"), ("c", 20170210, "x"), ("h", 20170501, "x")))})
    again = Store(spark, root)
    assert rows(again.read(name), "order_id", "order_status") == {
        ("a", "new"), ("b", "x"), ("c", "x"), ("d", "x"), ("e", "x"), ("f", "x"), ("g", "x"), ("h", "x")}
    after = {m: files_of(again, spark, root, m) for m in ("201701", "201702", "201703", "201704", "201705")}
    assert all(after[m] == before[m] for m in ("201702", "201703", "201704"))
    assert not after["201701"] & before["201701"] and after["201705"]


def test_merge_follows_a_key_to_another_month(spark, frame, root):
    name, store = "analytics.fact_orders", Store(spark, root)
    store.publish({name: store.write(name, bought(frame, ("a", 20170105, "x"), ("b", 20170106, "x"), ("c", 20170301, "x")))})
    march = months_of(store)["201703"]
    store.publish({name: store.merge(name, bought(frame, ("a", 20170210, "moved")))})
    assert rows(store.read(name), "order_id", "purchase_date_key") == {
        ("a", 20170210), ("b", 20170106), ("c", 20170301)}
    assert months_of(store)["201703"] == march and len(months_of(store)["201701"]) == 1
    store.publish({name: store.merge(name, bought(frame, ("b", 20170211, "moved")))})
    assert set(months_of(store)) == {"201702", "201703"}
    assert store.read(name).count() == 3


def test_merge_equals_upsert_of_whole_tables(spark, small, root):
    """Random deliveries with moved keys, several in a row."""
    name, store = "analytics.fact_reviews", Store(spark, root)
    w = Warehouse(RawTables(spark, small))
    fact = facts.by_month(w.fact_reviews, w.staging_orders).checkpoint()
    expected = None
    for k in range(3):
        delivery = fact.where(F.xxhash64("order_id", F.lit(k)) % 5 == 0).withColumns({
            "review_score_category": F.lit(f"delivery {k}"),
            "purchase_month": F.when(F.xxhash64("review_id", F.lit(k)) % 7 == 0, 199001 + k).otherwise(
                F.col("purchase_month")),
        })
        store.publish({name: store.merge(name, delivery)})
        expected = upsert(expected, delivery.drop("purchase_month"), list(TABLES[name].key))
    found = Store(spark, root).read(name)
    expected = expected.select(*found.columns)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    assert store.read_parts(name, store.current[name], True).where("purchase_month < 199101").count() > 0


def test_empty_deliveries_and_tables(spark, frame, root):
    name, store = "analytics.fact_orders", Store(spark, root)
    store.publish({name: store.merge(name, bought(frame))})
    assert Store(spark, root).has(name) and Store(spark, root).read(name).isEmpty()
    store.publish({name: store.merge(name, bought(frame, ("a", 20170105, "x")))})
    before = store.current[name]
    store.publish({name: store.merge(name, bought(frame))})
    assert store.current[name] == before and Store(spark, root).read(name).count() == 1


def test_same_key_in_a_stored_and_a_new_month_is_refused(spark, frame, root):
    """The month that comes in unchanged is not written, but its keys are still compared."""
    build, name = pipeline.Build(Store(spark, root)), "analytics.fact_orders"
    build.store.publish({name: build.store.write(name, bought(frame, ("a", 20170105, "x")))})
    for parent in ("analytics.dim_customer", "analytics.dim_date"):
        build.store.publish({parent: build.store.write(parent, frame(parent))})
    with pytest.raises(pipeline.audits.IntegrityError, match=r"fact_orders \(order_id\)"):
        build.merge({name: lambda: bought(frame, ("a", 20170105, "x"), ("a", 20170210, "x"))})
    assert Store(spark, root).read(name).count() == 1


def facts_of(frame, store, *orders):
    """fact_orders with the customers and days they refer to."""
    name = "analytics.fact_orders"
    for parent, parents in {
        "analytics.dim_customer": [{**CUSTOMER, "customer_id": "c"}],
        "analytics.dim_date": [{**DAY, "date_key": d, "full_date": f"{d // 10000}-01-0{k + 1}"}
                               for k, d in enumerate(sorted({day for _, day, _ in orders}))],
    }.items():
        store.publish({parent: store.write(parent, frame(parent, *parents))})
    return {name: lambda: bought(frame, *orders)}


def test_audits_read_arriving_parts_only(spark, frame, root, monkeypatch):
    """A month that comes in again is compared by key; other checked months are not read."""
    name, build = "analytics.fact_orders", pipeline.Build(Store(spark, root))
    orders = [(f"o{m}", 20170001 + 100 * m, "x") for m in range(1, 10)]
    build.merge(facts_of(frame, build.store, *orders))
    assert all(p.checked for p in Store(spark, root).current[name])
    before = build.store.current[name]
    seen, enforce = [], pipeline.audits.enforce
    monkeypatch.setattr(pipeline.audits, "enforce", lambda arrived, tables, names, outside: (
        seen.extend(arrived(n) for n in names), enforce(arrived, tables, names, outside)))
    build.merge({name: lambda: bought(frame, ("o3", 20170301, "new"))})
    read = {f.rsplit("/", 1)[0] for df in seen for f in df.inputFiles()}
    after = build.store.current[name]
    assert len(set(before) & set(after)) == 8 and len(read) == 1
    assert {p.value for p in set(after) - set(before)} == {"201703"}


def test_parts_written_without_checks_are_checked_when_linked(spark, frame, root):
    name, store = "analytics.fact_orders", Store(spark, root)
    loose = pipeline.Build(store, constraints=False)
    loose.merge(facts_of(frame, store, ("a", 20170101, "x"), ("b", 20170202, "s" * 31), ("d", 20170303, "x")))
    strict = pipeline.Build(Store(spark, root))
    with pytest.raises(pipeline.audits.IntegrityError, match="order_status: length <= 30"):
        strict.merge({name: lambda: bought(frame, ("a", 20170101, "new"))})
    strict.merge({name: lambda: bought(frame, ("b", 20170202, "short"))})
    assert all(p.checked for p in Store(spark, root).current[name])


def test_second_writer_is_refused(spark, frame, root):
    one, other = Store(spark, root), Store(spark, root)
    put(one, "raw.sellers", frame("raw.sellers", SELLER))
    with pytest.raises(Outdated):
        put(other, "raw.sellers", frame("raw.sellers"))
    assert Store(spark, root).read("raw.sellers").count() == 1


def test_fenced_writer_is_refused(spark, frame, root):
    slow = Store(spark, root)
    Store(spark, root).fence()
    with pytest.raises(Outdated):
        put(slow, "raw.sellers", frame("raw.sellers", SELLER))
    assert not Store(spark, root).has("raw.sellers")


def test_only_one_of_many_creates_a_file(spark, root):
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: put_if_absent(spark, f"{root}/claims/1", [{"by": k}]), range(8)))
    assert sum(made) == 1 and [name for name, _, _ in listed(spark, f"{root}/claims")] == ["1"]


def test_expiry_keeps_what_kept_versions_list(spark, frame, root):
    name, store = "analytics.fact_orders", Store(spark, root)
    store.publish({name: store.merge(name, bought(frame, ("a", 20170105, "x"), ("b", 20170210, "x")))})
    for k in range(3):
        store.publish({name: store.merge(name, bought(frame, ("a", 20170105, f"new {k}")))})
        put(store, "raw.sellers", frame("raw.sellers", {**SELLER, "seller_id": str(k)}))
    store.write(name, bought(frame, ("z", 20170105, "draft of a run that failed")))
    february, live = months_of(store)["201702"], files_of(store, spark, root, "201701")
    # Two tables of sellers; the first January, two later ones and the draft; and the folders of
    # three merges in which no old row remained.
    assert len(store.unreachable(1)) == 9
    assert store.expire(2) > 0
    again = Store(spark, root)
    assert months_of(again)["201702"] == february and files_of(again, spark, root, "201701") == live
    assert rows(again.read(name), "order_id", "order_status") == {("a", "new 2"), ("b", "x")}
    assert again.unreachable(2) == []
    assert rows(again.history(), "table", "versions", "versions_kept", "rows") == {
        (name, 4, 2, 2), ("raw.sellers", 3, 2, 1)}
    assert again.expire(1) > 0 and again.expire(1) == 0
    assert rows(Store(spark, root).read(name), "order_id") == {("a",), ("b",)}


def test_run_log(spark, root):
    log = RunLog(spark, root)
    assert log.runs().count() == 0
    first, started = log.start()
    log.finish(first, started, "failed", 3, 1, "Check raw", "bad")
    second, _ = log.start()          # never finished: it was killed
    assert (first, second) == (1, 2)
    assert rows(log.runs(), "run_id", "status", "failed_step", "rows_loaded") == {
        (1, "failed", "Check raw", 3), (2, "running", None, None)}


def test_only_one_run_at_a_time(spark, root):
    log = RunLog(spark, root)
    first, started = log.start()
    with pytest.raises(RunInProgress):
        RunLog(spark, root).start()
    other = RunLog(spark, root)
    assert other.start(take_over=True)[0] == 2
    log.finish(first, started, "succeeded", 1, 0)  # too late: its state is final
    assert rows(log.runs(), "run_id", "status", "error_message") == {
        (1, "failed", "taken over by run 2"), (2, "running", None)}


def test_a_silent_run_is_taken_over(spark, root):
    RunLog(spark, root).start()
    later = RunLog(spark, root, stale_after=timedelta(0))
    assert later.start()[0] == 2
    assert rows(later.runs(), "run_id", "status") == {(1, "failed"), (2, "running")}


def test_of_runs_that_start_together_one_gets_through(spark, root):
    def start(_):
        try:
            return RunLog(spark, root).start()[0]
        except RunInProgress:
            return None
    with ThreadPoolExecutor(6) as pool:
        ids = [i for i in pool.map(start, range(6)) if i]
    assert ids == [1]


def test_concurrent_run_is_refused_and_a_taken_over_one_cannot_publish(spark, small, root):
    raw = RawTables(spark, small)

    class Meanwhile(dict):
        """Raw tables during whose load another run starts, is refused, and takes over."""
        def __getitem__(self, name):
            if name == "customers" and not self.get("done"):
                self["done"] = True
                with pytest.raises(RunInProgress):
                    pipeline.run(spark, raw, root, constraints=False)
                pipeline.run(spark, raw, root, constraints=False, take_over=True)
            return raw[name]

    with pytest.raises(pipeline.PipelineFailed, match="Load raw: .* published by another writer"):
        pipeline.run(spark, Meanwhile(), root, constraints=False)
    assert rows(RunLog(spark, root).runs(), "run_id", "status", "failed_step") == {
        (1, "failed", "Taken over"), (2, "succeeded", None)}
    assert Store(spark, root).read("raw.orders").count() == raw["orders"].count()


@pytest.fixture(scope="module")
def built(spark, small):
    """The warehouse built from CSV files, twice over the same store."""
    root = scratch_dir(spark, "test")
    files = write_csv(RawTables(spark, small), scratch_dir(spark, "test-csv"))
    first = pipeline.run(spark, CsvTables(spark, files), root)
    paths = dict(first.store.current)
    second = pipeline.run(spark, CsvTables(spark, files), root, expected=first.counts)
    return first, paths, second, root


def test_build_from_csv(built):
    first, _, _, _ = built
    assert set(first.counts) == set(STORED)
    assert first.rows_loaded == sum(first.counts[t.name] for t in in_layer("raw"))
    assert first.counts["analytics.order_summary"] == first.counts["raw.orders"]


@pytest.mark.parametrize("name", STORED)
def test_building_twice_gives_the_same_table(spark, built, name):
    _, paths, second, _ = built
    before = second.store.read_parts(name, paths[name])
    after = second.table(name)
    linked = paths[name] == second.store.current[name]
    assert linked == bool(TABLES[name].partition)  # months that come in as they are stay
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0


def test_runs_are_logged(spark, built):
    first, _, second, root = built
    logged = rows(RunLog(spark, root).runs(), "run_id", "status", "rows_loaded", "warnings")
    assert logged == {(1, "succeeded", first.rows_loaded, first.warnings),
                      (2, "succeeded", second.rows_loaded, second.warnings)}


def test_failed_check_stops_the_run_and_keeps_the_old_tables(spark, small, built):
    _, _, second, root = built
    raw = RawTables(spark, small)
    raw["orders"] = raw["orders"].withColumn("order_status", F.lit("lost"))
    before = dict(second.store.current)
    with pytest.raises(pipeline.PipelineFailed, match="Check raw: .*raw_order_status_known"):
        pipeline.run(spark, raw, root)
    after = Store(spark, root).current
    assert {n for n in STORED if before[n] != after[n]} == {t.name for t in in_layer("raw")}
    last = RunLog(spark, root).runs().orderBy(F.desc("run_id")).first()
    assert (last["status"], last["failed_step"]) == ("failed", "Check raw")


def test_wrong_row_count_fails_the_run(spark, small, root):
    with pytest.raises(pipeline.PipelineFailed, match="Row counts: .*raw.sellers"):
        pipeline.run(spark, RawTables(spark, small), root, expected={"raw.sellers": 0}, constraints=False)


def test_merged_facts_are_computed_once(spark, small, monkeypatch):
    """What comes in is read from what was written; the fact's plan runs a single time."""
    number = driver_tables.number_within
    monkeypatch.setattr(driver_tables, "number_within", lambda lines, *how: number(
        lines.withColumn("order_id", passed(F.col("order_id"))), *how))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(order_id):
        seen.add(1)
        return order_id

    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    queries.QUERIES["upsert_fact_order_items"](spark, small).count()
    # Bounds, sizes and numbers each read the lines.
    assert seen.value <= 3 * lines


def test_months_that_come_in_as_stored_are_not_dealt_again(spark, frame, root, monkeypatch):
    name, store = "analytics.fact_orders", Store(spark, root)
    whole = [("a", 20170105, "x"), ("b", 20170210, "x")]
    store.publish({name: store.merge(name, bought(frame, *whole))})
    dealt, write = [], Store.write

    def counted(self, table, df, *how):
        dealt.append(sorted(r["order_id"] for r in df.select("order_id").collect()))
        return write(self, table, df, *how)

    monkeypatch.setattr(Store, "write", counted)
    before = store.current[name]
    store.publish({name: store.merge(name, bought(frame, *whole))})
    assert dealt == [] and store.current[name] == before
    store.publish({name: store.merge(name, bought(frame, ("a", 20170105, "new"), whole[1]))})
    assert dealt[0] == ["a"]
    assert rows(store.read(name), "order_id", "order_status") == {("a", "new"), ("b", "x")}


def test_several_runs_derive_their_source_once(spark, small, monkeypatch):
    number = driver_tables.number_within
    monkeypatch.setattr(driver_tables, "number_within", lambda lines, *how: number(
        lines.withColumn("order_id", passed(F.col("order_id"))), *how))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(order_id):
        seen.add(1)
        return order_id

    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    queries.QUERIES["rerun_row_counts"](spark, small)
    # Bounds, sizes and numbers each read the lines, for both runs together.
    assert seen.value <= 3 * lines


def test_stored_whole_numbers_are_kept_as_differences(spark, frame, root):
    name, store = "raw.geolocation", Store(spark, root)
    points = spark.range(50).select(*[
        (F.col("id") if c.name == "geolocation_id" else F.lit(None)).cast(c.type).alias(c.name)
        for c in TABLES[name].columns])
    draft = store.write(name, points.coalesce(1))
    folder = f"{root}/{draft.parts[0].path}"
    used = [parquet.ParquetFile(f"{folder.removeprefix('file:')}/{f}").metadata.row_group(0)
            for f, _, _ in listed(spark, folder) if f.endswith(".parquet")]
    written = {used[0].column(i).path_in_schema: used[0].column(i).encodings
               for i in range(used[0].num_columns)}
    assert "PLAIN" not in written["geolocation_id"]
    assert store.read_parts(name, draft.parts).agg(F.sum("geolocation_id")).first()[0] == sum(range(50))


def test_stored_files_take_the_denser_codec(spark, frame, root):
    name, store = "staging.sellers", Store(spark, root)
    draft = store.write(name, frame(name, *[{"seller_id": f"s{n}"} for n in range(50)]))
    folder = f"{root}/{draft.parts[0].path}"
    used = [parquet.ParquetFile(f"{folder.removeprefix('file:')}/{f}").metadata.row_group(0).column(0).compression
            for f, _, _ in listed(spark, folder) if f.endswith(".parquet")]
    assert set(used) == {"ZSTD"}


def test_small_written_tables_are_broadcast_by_their_rows(spark, frame, root, monkeypatch):
    """What is looked up is judged by the rows counted while it was written, not by its files."""
    name, build = "staging.sellers", pipeline.Build(Store(spark, root), constraints=False)
    drafts = build.write({name: lambda: frame(name, SELLER, {**SELLER, "seller_id": "t"})})
    assert not build.store.has(name)
    build.publish({}, written=drafts)

    def joined(*how):
        items = spark.range(5).selectExpr("if(id < 9, 's', 't') AS seller_id")
        return items.join(build.lookup(name, *how), "seller_id")

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ((), (drafts,)):
            assert joined(*how).count() == 5
            assert "BroadcastHashJoin" in joined(*how)._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(pipeline, "LOOKUP_ROWS", 1)
        assert "BroadcastHashJoin" not in joined()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_run_that_brought_nothing_new_compares_facts_before_it_writes(spark, frame, root, monkeypatch):
    name, parents = "analytics.fact_orders", {
        "analytics.dim_customer": [{**CUSTOMER, "customer_id": "c"}],
        "analytics.dim_date": [{**DAY, "date_key": 20170105, "full_date": "2017-01-05"},
                               {**DAY, "date_key": 20170210, "full_date": "2017-02-10"}]}
    whole = [("a", 20170105, "x"), ("b", 20170210, "x")]

    def run(*orders, city="x"):
        build = pipeline.Build(Store(spark, root))
        build.publish({p: lambda p=p, given=given: frame(p, *[
            {**r, **({"customer_city": city} if "customer_id" in r else {})} for r in given])
            for p, given in parents.items()})
        build.merge({name: lambda: bought(frame, *orders)})
        return build

    first = run(*whole)
    assert not first.same
    saved, save = [], Store._save
    monkeypatch.setattr(Store, "_save", lambda self, table, *how, **more: (
        saved.append(table), save(self, table, *how, **more))[1])
    again = run(*whole)
    assert again.same and name not in saved and again.store.current[name] == first.store.current[name]
    assert all(p.checked for p in again.store.current[name])
    assert not run(*whole, city="y").same and name in saved   # compared after it was written
    changed = run(("a", 20170105, "new"), whole[1])
    assert rows(changed.table(name), "order_id", "order_status") == {("a", "new"), ("b", "x")}


def test_rows_that_come_in_unchanged_are_still_checked(spark, frame, root):
    """Compared or written, the rules are counted on the rows that come in."""
    name, store = "analytics.fact_orders", Store(spark, root)
    long = bought(frame, ("a", 20170105, "s" * 31), ("b", 20170210, "x"))
    store.publish({name: store.write(name, long)})
    rules = pipeline.audits.domain_measures(name)
    counted = [store.merge(name, long, rules, same).measures for same in (True, False)]
    assert counted[0] == counted[1] and counted[0][f"{name}.order_status: length <= 30"] == 1
    assert store.merge(name, long.limit(0), rules, True).measures == dict.fromkeys(rules, 0)


def test_digest_is_the_sum_of_the_hashes(spark):
    df = spark.range(2000).selectExpr("id", "if(id % 3 = 0, NULL, concat('t', id)) AS text")
    found = df.agg(*[a.alias(label) for label, a in multiset_digest(df.columns).items()]).first()
    hashed = df.selectExpr("xxhash64(id, text, id IS NULL, text IS NULL) AS a",
                           "xxhash64(1, id, text, id IS NULL, text IS NULL) AS b").collect()
    assert (found["rows"], int(found["sum_1"]), int(found["sum_2"])) == (
        2000, sum(r["a"] for r in hashed), sum(r["b"] for r in hashed))
    assert [*df.where("id < 0").agg(*multiset_digest(df.columns).values()).first()] == [0, 0, 0]
    assert "decimal(28,0)" not in df.agg(
        *multiset_digest(df.columns).values())._jdf.queryExecution().analyzed().toString()


def test_shuffles_of_a_run_go_with_their_queries(spark, small, root, monkeypatch):
    seen, before = [], spark.conf.get(REMOVE_SHUFFLES)

    def stop(build, raw):
        seen.append(spark.conf.get(REMOVE_SHUFFLES))
        raise ValueError("enough")

    monkeypatch.setattr(pipeline, "load_raw", stop)
    with pytest.raises(pipeline.PipelineFailed, match="enough"):
        pipeline.run(spark, RawTables(spark, small), root)
    assert seen == ["true"] and spark.conf.get(REMOVE_SHUFFLES) == before


def test_removed_shuffles_leave_the_rows_readable(spark):
    """What was shuffled for one query is shuffled again if its plan runs once more."""
    with shuffles_removed(spark):
        grouped = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
        assert rows(grouped) == rows(grouped) == rows(kept(grouped))
