"""Reloads by difference, rejects and refusals, and the row counts of a load."""

import pytest
from tests.test_load import RAW, _change, _write_raw

from bazaarframe import load
from bazaarframe.operators import checks
from bazaarframe.schema import TABLES
from bazaarframe.sources import snapshot
from bazaarframe.sources.csv_source import scan_csv


@pytest.fixture
def raw(tmp_path):
    return _write_raw(tmp_path / "raw")


@pytest.fixture
def root(spark, shop, tmp_path):
    root = str(tmp_path / "store")
    snapshot.publish_snapshot(spark, root, shop.with_tables(orders=shop.orders.where("order_id <> 'o7'")))
    return root


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def changed_customers(shop):
    """c1 moves, c2 loses its city, c7 comes new, and the sixth customer has no order that needs it."""
    moved = shop.customers.selectExpr(
        "customer_id",
        "customer_unique_id",
        "case customer_id when 'c1' then 'moved' when 'c2' then null else customer_city end as customer_city",
        "customer_state",
    )
    return moved.union(shop.customers.limit(1).selectExpr("'c7'", "'u9'", "'new'", "'RJ'"))


def test_key_changes(shop):
    old, new = shop.customers, changed_customers(shop).where("customer_id <> 'c6'")
    assert rows(checks.key_changes(old, new, TABLES["customers"])) == [
        ("c1", "changed"),
        ("c2", "changed"),
        ("c6", "removed"),
        ("c7", "added"),
    ]
    assert rows(checks.key_changes(old, old.repartition(3), TABLES["customers"])) == []
    items = shop.order_items
    later = items.where("order_item_id = 1").selectExpr(
        *[f"cast(price + 1 as decimal(12,2)) as price" if c == "price" else c for c in items.columns]
    )
    assert rows(checks.key_changes(items, later, TABLES["order_items"])) == [
        ("o1", 1, "changed"),
        ("o1", 2, "removed"),
        ("o2", 1, "changed"),
        ("o4", 1, "changed"),
        ("o5", 1, "changed"),
    ]


def test_a_reload_stores_its_changes(spark, shop, root):
    assert snapshot.last_changes(spark, root) == {}
    snapshot.replace_table(spark, root, "customers", changed_customers(shop))
    assert rows(snapshot.last_changes(spark, root)["customers"]) == [("c1", "changed"), ("c2", "changed"), ("c7", "added")]
    snapshot.replace_table(spark, root, "sellers", shop.sellers)
    assert rows(snapshot.last_changes(spark, root)["sellers"]) == []


def test_only_removed_keys_meet_the_dependants(spark, shop, root, monkeypatch):
    def no_look(*args):
        raise AssertionError("dependants are read although no key goes")

    monkeypatch.setattr(snapshot, "orphaned_by", no_look)
    snapshot.replace_table(spark, root, "customers", changed_customers(shop))
    with pytest.raises(AssertionError):
        snapshot.replace_table(spark, root, "customers", shop.customers.where("customer_id <> 'c6'"))


def test_orphans_as_rows(spark, shop, root):
    fewer = shop.customers.where("customer_id not in ('c1', 'c6')")
    assert rows(snapshot.would_orphan(spark, root, "customers", fewer)) == [
        ("orders", "customer_id", "c1", 1),
        ("orders", "customer_id", "c6", 1),
    ]
    before = snapshot.current_paths(spark, root)
    with pytest.raises(ValueError, match="orders: reference customer_id .2 rows"):
        snapshot.replace_table(spark, root, "customers", fewer)
    with pytest.raises(ValueError, match="order_items: reference order_id .2 rows.*order_reviews: reference order_id .2 rows|reviews.*items"):
        snapshot.replace_table(spark, root, "orders", shop.orders.where("order_id not in ('o1', 'o7')"))
    assert snapshot.current_paths(spark, root) == before


def test_a_reload_still_checks_its_own_rules(spark, shop, root):
    twice = shop.customers.union(shop.customers.where("customer_id = 'c1'"))
    with pytest.raises(ValueError, match="customers: primary key .1 rows"):
        snapshot.replace_table(spark, root, "customers", twice)
    with pytest.raises(ValueError, match="orders: reference customer_id .1 rows"):
        snapshot.replace_table(spark, root, "orders", shop.orders)


def test_rows_are_counted_by_the_writing_job(spark, shop, tmp_path):
    for name, df in shop.as_dict().items():  # orders go through a range exchange, which reads its input twice
        assert snapshot.write_table(df.repartition(3), str(tmp_path / name), name) == df.count()


def test_rejects(spark, raw, tmp_path):
    assert rows(load.rejects(spark, str(raw))) == []
    _change(raw, "shop_order_items_dataset.csv", "58.90", "abc")
    _change(raw, "shop_order_items_dataset.csv", "o1,2,", "o1,two,")
    _change(raw, "shop_orders_dataset.csv", "2020-01-10 10:00:00", "2020-02-30")
    _change(raw, "shop_orders_dataset.csv", "2020-02-10 10:00:00", "2020-02-30")
    assert rows(load.rejects(spark, str(raw))) == [
        ("order_items", "order_item_id", "shop_order_items_dataset.csv", "two", 1),
        ("order_items", "price", "shop_order_items_dataset.csv", "abc", 1),
        ("orders", "order_purchase_timestamp", "shop_orders_dataset.csv", "2020-02-30", 2),
    ]


def test_refusals_as_rows(spark, raw, tmp_path):
    assert rows(load.refusals(spark, str(raw), str(tmp_path / "a"))) == []
    _change(raw, "shop_orders_dataset.csv", "o2,c2", "o2,c7")
    _change(raw, "shop_order_items_dataset.csv", "o1,2,", "o1,1,")
    assert rows(load.refusals(spark, str(raw), str(tmp_path / "b"))) == [
        ("order_items", "primary key", 1),
        ("orders", "reference customer_id", 1),
    ]


def test_known_line_breaks_spare_the_first_pass(spark, raw, tmp_path, monkeypatch):
    breaks = {name: name in ("order_reviews", "customers") for name in TABLES}
    read = []
    text = type(spark.read).text
    monkeypatch.setattr(type(spark.read), "text", lambda self, *a, **k: (read.append(a), text(self, *a, **k))[1])
    root = str(tmp_path / "store")
    load.run_load(spark, str(raw), root, line_breaks=breaks)
    assert not read
    assert rows(load.source_and_stored_counts(spark, str(raw), root)) == sorted(
        (name, n, n)
        for name, n in {
            "customers": 3, "product_category_translation": 1, "products": 2, "sellers": 1, "orders": 2, "order_items": 2,
            "order_payments": 1, "order_reviews": 2,
        }.items()
    )
    assert read
    with pytest.raises(Exception, match="(?i)malformed"):  # told wrongly
        scan_csv(spark, str(raw / "shop_order_reviews_dataset.csv"), line_breaks=False).frame().collect()


def test_raw_files_of_the_load_tests_are_complete():
    assert len(RAW) == len(TABLES)
