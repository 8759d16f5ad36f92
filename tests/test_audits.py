"""Key, foreign key and domain audits find what is planted."""

import pytest

from comparing import rows
from parcelhouse.operators.keys import orphans, unmatched
from parcelhouse.plans import audits, planted


def only(frame, **given):
    return lambda name: frame(name, *given.get(name.split(".")[1], []))


def test_duplicate_and_missing_keys(frame):
    items = [{"order_id": o, "order_item_id": n} for o, n in (("a", 1), ("a", 1), ("a", 1), ("b", None), ("c", 1))]
    df = audits.primary_keys(only(frame, order_items=items), ["raw.order_items"])
    assert rows(df) == {("raw.order_items", "order_id, order_item_id", 1, 1, 2)}


def test_unique_day(frame):
    days = [{"date_key": k, "full_date": "2018-01-01"} for k in (1, 2)]
    df = audits.primary_keys(only(frame, dim_date=days), ["analytics.dim_date"])
    assert rows(df, "key", "duplicate_keys") == {("date_key", 0), ("full_date", 1)}


def test_orphans_ignore_missing_keys(frame):
    tables = only(
        frame, dim_date=[{"date_key": 1}], fact_orders=[{"order_id": "o"}],
        fact_reviews=[{"order_id": "o"}, {"order_id": "x", "review_creation_date_key": 2},
                      {"order_id": "x", "review_creation_date_key": 1}],
    )
    df = audits.foreign_keys(tables, ["analytics.fact_reviews"])
    assert rows(df, "columns", "parent", "orphan_keys", "orphan_rows") == {
        ("order_id", "analytics.fact_orders", 1, 2),
        ("review_creation_date_key", "analytics.dim_date", 1, 1)}


def test_domains(frame):
    reviews = [{"review_id": "r" * 51, "order_id": "o", "review_score": 6}, {"review_id": "r", "order_id": "o"}]
    df = audits.domains(only(frame, order_reviews=reviews), ["raw.order_reviews"]).where("failing_rows > 0")
    assert rows(df, "column", "rule", "failing_rows") == {
        ("review_id", "length <= 50", 1), ("review_score", "not null", 1),
        ("review_score", "between 1 and 5", 1)}   # a NULL score passes the range


def test_run_status_values(frame):
    runs = [{"run_id": i, "status": s} for i, s in enumerate(("running", "succeeded", "failed", "stuck"))]
    df = audits.value_checks(only(frame, pipeline_runs=runs), ["meta.pipeline_runs"])
    assert rows(df, "column", "failing_rows") == {("status", 1)}


def test_row_counts_against_expectation(frame):
    counted = audits.row_counts(only(frame, sellers=[{"seller_id": 1}]), ["raw.sellers", "raw.orders"])
    df = audits.compare_counts(counted, {"raw.sellers": 1, "raw.orders": 3, "raw.products": 2})
    assert rows(df) == {("raw.sellers", 1, 1, True), ("raw.orders", 0, 3, False),
                        ("raw.products", None, 2, False)}


def test_enforce(frame):
    good = {"seller_id": "s", "seller_zip_code_prefix": 1, "seller_city": "x", "seller_state": "SP"}
    def enforce(tables, *rest):
        audits.enforce(tables, tables, *rest)
    enforce(only(frame, sellers=[good]), ["raw.sellers"], {"a rule": 0})
    with pytest.raises(audits.IntegrityError, match=r"raw.sellers \(seller_id\); a rule"):
        enforce(only(frame, sellers=[good, good]), ["raw.sellers"], {"a rule": 1})
    with pytest.raises(audits.IntegrityError, match=r"raw.order_payments \(order_id\) -> raw.orders"):
        enforce(only(frame, order_payments=[{
            "order_id": "o", "payment_sequential": 1, "payment_type": "x", "payment_installments": 1,
            "payment_value": 1}]), ["raw.order_payments"], {})


def test_domain_measures_equal_the_audit(frame):
    reviews = [{"review_id": "r" * 51, "order_id": "o", "review_score": 6}, {"review_id": "r"}]
    df = frame("raw.order_reviews", *reviews)
    measures = audits.domain_measures("raw.order_reviews")
    taken = df.agg(*measures.values()).first()
    audited = audits.domains(lambda _: df, ["raw.order_reviews"]).collect()
    assert list(taken) == [r["failing_rows"] for r in audited]


def test_orphans_of_few_children_are_the_same(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (3,), (3,), (None,)], "p int")
    found = [rows(orphans(child, ["k"], parent, ["p"], few)) for few in (False, True)]
    assert found[0] == found[1] == {(2, 2), (9, 1)}


def test_planted_copies_are_counted_beside_their_row(frame):
    """Every row is read once, and its copies meet before the shuffle."""
    items = [{"order_id": o, "order_item_id": n} for o, n in (("a", 1), ("a", 2), (None, 3), (None, None))]
    tables = planted.with_repeated_keys(only(frame, order_items=items))
    copies = tables("raw.order_items")
    assert copies.columns == frame("raw.order_items").columns
    found = sorted((str(r["order_id"]), str(r["order_item_id"])) for r in copies.collect())
    assert found == sorted(
        2 * [("a", "1"), ("a", "2")] + [("None", "1"), ("None", "2")]
        + 3 * [("None", "3"), ("None", "None")])
    assert "Union" not in copies._jdf.queryExecution().optimizedPlan().toString()
    df = audits.primary_keys(tables, ["raw.order_items"])
    assert rows(df) == {("raw.order_items", "order_id, order_item_id", 8, 2, 2)}


def test_spoilt_rows_are_judged_once_and_padded_in_few_steps(frame):
    """Two looks at the key a row, not two a column; texts are cut or filled up to 600 characters."""
    items = [{"order_id": o, "product_id": p, "seller_id": s, "price": 1} for o, p, s in (
        ("o1", "p", "s"), ("o3", "\u00e9" * 599, "y" * 700), ("o13", None, ""), ("o5", "p", "s"))]
    df = planted.with_spoilt_values(only(frame, order_items=items))("raw.order_items")
    assert rows(df, "order_id", "product_id", "seller_id", "price") == {
        ("o1", "p", "s", 1), (None, None, None, None),
        ("o3".ljust(600, "x"), "\u00e9" * 599 + "x", "y" * 600, 1),
        ("o13".ljust(600, "x"), "x" * 600, "x" * 600, 1)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") + plan.count("rlike") <= 2
    assert f", 600, {'x' * 60})" in df._jdf.queryExecution().analyzed().toString()


def test_unmatched_keys_of_several_children(spark):
    parent = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a")], "p int, q string")
    one = spark.createDataFrame([(1, "a"), (3, "a"), (3, "a"), (4, "b"), (None, "c")], "k int, l string")
    two = spark.createDataFrame([("a", 2), ("b", 2), ("b", None)], "m string, n int")
    empty = one.where("k > 9")
    found = unmatched(parent, ["p", "q"], [(one, ["k", "l"]), (two, ["n", "m"]), (empty, ["k", "l"])])
    assert rows(found) == {(2, 1, 0)}
    assert rows(unmatched(empty, ["k"], [(one, ["k"])])) == {(3,)}
    lost = orphans(one, ["k", "l"], parent, ["p", "q"])
    assert rows(lost) == {(3, "a", 2), (4, "b", 1)}


def test_parents_are_read_once_for_all_tables_that_arrive_whole(frame):
    order = {"order_id": "o", "customer_id": "c"}
    tables = only(frame, orders=[order], customers=[{"customer_id": "c"}], order_payments=[
        {"order_id": "o", "payment_sequential": 1}, {"order_id": "x", "payment_sequential": 1}],
        order_reviews=[{"review_id": "r", "order_id": "y"}])
    looked_up = []

    def parents(name):
        looked_up.append(name)
        return tables(name)

    names = ["raw.customers", "raw.orders", "raw.order_payments", "raw.order_reviews"]
    with pytest.raises(audits.IntegrityError) as error:
        audits.enforce(tables, parents, names, {})
    assert str(error.value) == ("raw.order_payments (order_id) -> raw.orders; "
                                "raw.order_reviews (order_id) -> raw.orders")
    assert sorted(looked_up) == ["raw.customers", "raw.orders"]
