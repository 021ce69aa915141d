"""Derived tables live and die with the versions of their inputs."""

import json

import pytest

from bazaarframe.plans import dashboards as d
from bazaarframe.plans import metrics as m
from bazaarframe.plans import reports as r
from bazaarframe.sources import files, snapshot


@pytest.fixture(scope="module")
def good(shop):
    return shop.with_tables(orders=shop.orders.where("order_id <> 'o7'"))


@pytest.fixture
def root(spark, good, tmp_path):
    root = str(tmp_path / "store")
    snapshot.publish_snapshot(spark, root, good, derived=("order_metrics",))
    return root


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_take_the_stored_result(spark, good, root):
    t = snapshot.open_snapshot(spark, root)
    assert rows(m.order_metrics(t)) == rows(m.order_metrics(good))
    for build in (m.monthly_sales, m.delivery_performance, r.executive_kpis, d.dash_retention, d.dash_cards):
        assert rows(build(t)) == rows(build(good))
        assert all("/derived/order_metrics/" in path for path in build(t).inputFiles()) and "Join" not in plan(build(t))
    without = snapshot.open_snapshot(spark, root, derived=False)
    assert "Join" in plan(m.order_metrics(without))


def test_a_replaced_input_drops_the_result(spark, good, root):
    snapshot.replace_table(spark, root, "product_category_translation", good.product_category_translation.limit(0))
    assert set(snapshot.derived_paths(spark, root)) == {"order_metrics"}  # not an input
    snapshot.replace_table(spark, root, "order_payments", good.order_payments.where("payment_sequential = 1"))
    t = snapshot.open_snapshot(spark, root)
    assert snapshot.derived_paths(spark, root) == {} and t.derived == {}
    assert {x["order_id"]: str(x["payment_value"]) for x in m.order_metrics(t).collect()}["o1"] == "10.00"
    snapshot.derive(spark, root)
    again = snapshot.open_snapshot(spark, root)
    assert "order_metrics" in again.derived and rows(m.order_metrics(again)) == rows(m.order_metrics(t))


def test_a_replaced_input_can_rebuild_the_result(spark, good, root):
    old = snapshot.derived_paths(spark, root)
    snapshot.replace_table(spark, root, "order_payments", good.order_payments.limit(0), rebuild=True)
    new = snapshot.derived_paths(spark, root)
    assert set(new) == set(old) and new != old
    t = snapshot.open_snapshot(spark, root)
    assert {x["payment_value"] for x in t.derived["order_metrics"].collect()} == {0}


def test_derive_keeps_what_is_good(spark, root):
    before = snapshot.derived_paths(spark, root)["order_metrics"]
    snapshot.derive(spark, root, "order_metrics")
    assert snapshot.derived_paths(spark, root)["order_metrics"] == before
    with pytest.raises(ValueError, match="no such derived table"):
        snapshot.derive(spark, root, "nothing")


def test_a_load_in_between_is_taken_up(spark, good, root, monkeypatch):
    create = files.create_text
    others = [lambda: snapshot.replace_table(spark, root, "order_payments", good.order_payments.limit(0))]

    def after_another(*args):
        if others:
            others.pop()()
        return create(*args)

    monkeypatch.setattr(files, "create_text", after_another)
    snapshot.replace_table(spark, root, "order_reviews", good.order_reviews.limit(0), rebuild=True)
    t = snapshot.open_snapshot(spark, root)
    assert {(x["payment_value"], x["review_score"]) for x in t.derived["order_metrics"].collect()} == {(0, None)}
    assert len(files.glob(spark, f"{root}/derived/order_metrics/*")) == 2  # the first one and the last one


def test_a_stale_result_is_refused(spark, root):
    path = files.glob(spark, f"{root}/_manifests/*.json")[-1]
    content = json.loads(files.read_text(spark, path))
    content["derived"]["order_metrics"]["inputs"]["orders"] = "orders/another"
    assert files.create_text(spark, f"{root}/_manifests/000099.json", json.dumps(content), f"{root}/_manifests/x.new")
    with pytest.raises(snapshot.StaleDerivedTable):
        snapshot.open_snapshot(spark, root)
    assert snapshot.open_snapshot(spark, root, derived=False).orders.count() == 6


def test_a_failed_build_leaves_nothing_behind(spark, good, root, monkeypatch):
    before = snapshot.current_paths(spark, root), snapshot.derived_paths(spark, root)

    def fail(*args):
        raise OSError("no room")

    monkeypatch.setattr(snapshot, "write_derived", fail)
    with pytest.raises(OSError, match="no room"):
        snapshot.replace_table(spark, root, "order_payments", good.order_payments.limit(0), rebuild=True)
    assert (snapshot.current_paths(spark, root), snapshot.derived_paths(spark, root)) == before
    assert len(files.glob(spark, f"{root}/order_payments/*")) == 1


def test_the_loadable_orders_are_found_once_for_all_that_refer_to_them(spark):
    from bazaarframe.sources.testdata import load_loadable_model

    t = load_loadable_model(spark, "/root/testdata/sf0.001")
    for name in ("orders", "order_items", "order_payments", "order_reviews"):
        assert not any("customer.parquet" in file for file in getattr(t, name).inputFiles()), name
