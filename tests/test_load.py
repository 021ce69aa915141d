import csv
import random
from datetime import datetime
from decimal import Decimal

import pandas as pd
import pytest

from bazaarframe import load
from bazaarframe.plans import reports
from bazaarframe.plans.inspection import inspect_folder
from bazaarframe.schema import TABLES
from bazaarframe.sources import files, snapshot
from bazaarframe.sources.csv_source import read_csv_folder, read_csv_table, scan_csv

RAW = {
    "customers.csv": [
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state",
        'c1,u1,01000, "quoted" inside ,\tsp ',
        'c2,u1,02000,"rio, ""the"" city",rj',
        "c3,u2,03000,NA,NULL",
    ],
    "product_category_name_translation.csv": [
        "﻿product_category_name,product_category_name_english",
        "livros,books",
    ],
    "shop_products_dataset.csv": [
        "product_id,product_category_name,product_name_lenght,product_weight_g,product_length_cm,product_height_cm,"
        "product_width_cm,product_photos_qty",
        "p1,livros,10,500.0,1,2,3,1",
        "p2,,11,,,,,",
    ],
    "shop_sellers_dataset.csv": ["seller_id,seller_zip_code_prefix,seller_city,seller_state", "s1,1,rio,rj"],
    "shop_orders_dataset.csv": [
        "order_status,order_id,customer_id,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date",
        " delivered ,o1,c1,2020-01-10 10:00:00,,,2020-01-20 10:00:00,2020-01-15",
        "shipped,o2,c2,2020-02-10 10:00:00,,,,2020-02-15 00:00:00",
    ],
    "shop_order_items_dataset.csv": [
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
        "o1,1,p1,s1,2020-01-12 00:00:00,58.90,13.29",
        "o1,2,p2,s1,2020-01-12 00:00:00,100,0.5",
    ],
    "shop_order_payments_dataset.csv": [
        "order_id,payment_sequential,payment_type,payment_installments,payment_value",
        "o1,1,credit_card,3,172.69",
    ],
    "shop_order_reviews_dataset.csv": [
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        "review_answer_timestamp",
        'r1,o1,4,,"first line',
        'second ""line"", with comma',
        "",
        'last",2020-01-21 00:00:00,2020-01-22 00:00:00',
        "r2,o2,5,ok,,2020-02-21 00:00:00,2020-02-22 00:00:00",
    ],
}


def _write_raw(folder):
    folder.mkdir()
    for name, lines in RAW.items():
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return folder


@pytest.fixture
def raw(tmp_path):
    return _write_raw(tmp_path / "raw")


def _change(folder, name, old, new):
    path = folder / name
    text = path.read_text(encoding="utf-8")
    assert old in text
    path.write_text(text.replace(old, new), encoding="utf-8")


def test_full_load(spark, raw, tmp_path):
    root = str(tmp_path / "store")
    load.run_load(spark, str(raw), root)
    t = snapshot.open_snapshot(spark, root)
    counts = {r["table_name"]: r["row_count"] for r in snapshot.row_counts(t).collect()}
    assert counts == {
        "customers": 3,
        "product_category_translation": 1,
        "products": 2,
        "sellers": 1,
        "orders": 2,
        "order_items": 2,
        "order_payments": 1,
        "order_reviews": 2,
    }
    customers = {r["customer_id"]: tuple(r) for r in t.customers.collect()}
    assert customers == {
        "c1": ("c1", "u1", '"quoted" inside', "SP"),
        "c2": ("c2", "u1", 'rio, "the" city', "RJ"),
        "c3": ("c3", "u2", None, None),
    }
    orders = {r["order_id"]: r for r in t.orders.collect()}
    assert orders["o1"]["order_status"] == "delivered"
    assert orders["o1"]["order_estimated_delivery_date"] == datetime(2020, 1, 15)
    assert orders["o2"]["order_delivered_customer_date"] is None
    assert {r["product_id"]: r["product_weight_g"] for r in t.products.collect()} == {"p1": 500, "p2": None}
    assert sorted(r["price"] for r in t.order_items.collect()) == [Decimal("58.90"), Decimal("100.00")]
    assert {r["review_id"]: r["review_answer_timestamp"] for r in t.order_reviews.collect()} == {
        "r1": datetime(2020, 1, 22),
        "r2": datetime(2020, 2, 22),
    }
    assert reports.executive_kpis(t).first()["gmv"] == Decimal("158.90")


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """A store that holds one good snapshot."""
    folder = tmp_path_factory.mktemp("published")
    _write_raw(folder / "raw")
    load.run_load(spark, str(folder / "raw"), str(folder / "store"))
    return str(folder / "store")


@pytest.mark.parametrize(
    "changes, messages",
    [
        ([("customers.csv", "customer_state", "state")], ["missing columns"]),
        (
            [
                ("customers.csv", "c3,u2", ",u2"),
                ("customers.csv", "\tsp ", "spx"),
                ("shop_orders_dataset.csv", "o2,c2", "o2,c7"),
                ("shop_orders_dataset.csv", "shipped,", "NULL,"),
                ("shop_order_items_dataset.csv", "o1,2,", "o1,1,"),
                ("shop_order_reviews_dataset.csv", "r2,o2,5", "r2,o2,6"),
            ],
            [
                "customers: not null customer_id .1 rows",
                "customers: length customer_state .1 rows",
                "orders: reference customer_id .1 rows",
                "orders: not null order_status .1 rows",
                "order_items: primary key .1 rows",
                "order_reviews: check review_score .1 rows",
            ],
        ),
        ([("shop_order_items_dataset.csv", "58.90", "abc")], ["order_items.price: not a decimal.12,2.: abc"]),
        ([("shop_order_reviews_dataset.csv", 'last",', "last,")], ["inside a quoted field"]),
        ([("shop_order_payments_dataset.csv", ",3,172.69", "")], ["(?i)malformed"]),
    ],
)
def test_a_broken_file_leaves_the_old_snapshot_current(spark, raw, published, changes, messages):
    before = snapshot.current_paths(spark, published)
    for change in changes:
        _change(raw, *change)
    with pytest.raises(Exception) as error:
        load.run_load(spark, str(raw), published)
    for message in messages:
        error.match(message)
    assert snapshot.current_paths(spark, published) == before
    assert snapshot.open_snapshot(spark, published).customers.count() == 3


@pytest.mark.parametrize(
    "name, column, text, value",
    [
        ("order_items", "order_item_id", "7", 7),
        ("order_items", "order_item_id", "7.0", 7),
        ("order_items", "order_item_id", "7.5", 8),
        ("order_items", "order_item_id", "two", None),
        ("order_items", "order_item_id", "3000000000", None),
        ("order_items", "price", "58.905", Decimal("58.91")),
        ("order_items", "price", "12345678901.00", None),
        ("orders", "order_approved_at", "2020-02-29 10:00:00", datetime(2020, 2, 29, 10)),
        ("orders", "order_approved_at", "2020-02-30 10:00:00", None),
    ],
)
def test_coerce_converts_or_fails(spark, name, column, text, value):
    spec = TABLES[name]
    df = spark.createDataFrame(
        [tuple(text if c == column else None for c in spec.column_names)], ", ".join(f"{c} string" for c in spec.column_names)
    )
    typed = load.coerce(df, spec)
    assert typed.schema == spec.struct
    if value is not None:
        assert typed.first()[column] == value
        return
    with pytest.raises(Exception, match=f"{name}.{column}: not a"):
        typed.collect()


def test_missing_files(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv_table(spark, str(tmp_path / "nowhere"), TABLES["orders"])
    with pytest.raises(FileNotFoundError):
        read_csv_folder(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        load.run_load(spark, str(tmp_path / "nowhere"), str(tmp_path / "store"))
    (raw / "other_orders_dataset.csv").write_text("x\n")
    with pytest.raises(ValueError, match="several files"):
        read_csv_table(spark, str(raw), TABLES["orders"])
    named = read_csv_table(spark, str(raw), TABLES["orders"], {"orders": "shop_orders_dataset.csv"})
    assert named.count() == 2
    with pytest.raises(FileNotFoundError):
        snapshot.open_snapshot(spark, str(tmp_path / "nowhere"))


def test_folder_scan(spark, raw):
    found = read_csv_folder(spark, str(raw))
    assert list(found) == sorted(RAW)
    assert found["shop_order_reviews_dataset.csv"].count() == 2
    assert found["product_category_name_translation.csv"].columns[0] == "product_category_name"


def test_inspection_of_a_raw_folder(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x,y\n1,NA\n1,\n2,z\n")
    (tmp_path / "a.csv").write_text("it's\nq\n")
    found = inspect_folder(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found["shape"].collect()) == [("a.csv", 1, 1), ("b.csv", 3, 2)]
    assert sorted(tuple(r) for r in found["columns"].collect()) == [("a.csv", 1, "it's", 0), ("b.csv", 1, "x", 0), ("b.csv", 2, "y", 2)]
    assert sorted(tuple(r) for r in found["duplicates"].collect()) == [("a.csv", 0), ("b.csv", 1)]


def test_count_mismatch_is_refused(spark, shop, tmp_path):
    root = str(tmp_path / "store")
    good = shop.with_tables(orders=shop.orders.where("order_id <> 'o7'"))
    snapshot.publish_snapshot(spark, root, good, {"orders": 6})
    before = snapshot.current_paths(spark, root)
    with pytest.raises(ValueError, match="row count mismatch"):
        snapshot.publish_snapshot(spark, root, good, {"orders": 7})
    assert snapshot.current_paths(spark, root) == before
    for name in TABLES:  # the refused version left nothing behind
        assert len(files.glob(spark, f"{root}/{name}/*")) == 1
    with pytest.raises(ValueError, match="reference customer_id"):
        snapshot.publish_snapshot(spark, root, shop)
    with pytest.raises(ValueError, match="missing"):
        snapshot.publish_snapshot(spark, root, {"orders": good.orders})


def test_replace_table_shares_the_others_and_protects_dependants(spark, raw, tmp_path):
    root = str(tmp_path / "store")
    load.run_load(spark, str(raw), root)
    before = snapshot.current_paths(spark, root)
    _change(raw, "customers.csv", "u2", "u3")
    load.reload_customers(spark, str(raw), root)
    after = snapshot.current_paths(spark, root)
    assert {n for n in after if after[n] != before[n]} == {"customers"}
    t = snapshot.open_snapshot(spark, root)
    assert {r["customer_unique_id"] for r in t.customers.collect()} == {"u1", "u3"}
    assert t.orders.count() == 2
    with pytest.raises(ValueError, match="orders: reference customer_id"):
        snapshot.replace_table(spark, root, "customers", t.customers.where("customer_id <> 'c2'"))
    _change(raw, "customers.csv", "customer_zip_code_prefix", "zip")
    with pytest.raises(ValueError, match="customer_zip_code_prefix"):
        load.reload_customers(spark, str(raw), root)
    assert snapshot.current_paths(spark, root) == after


def test_an_error_after_the_swap_deletes_nothing(spark, shop, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    good = shop.with_tables(orders=shop.orders.where("order_id <> 'o7'"))
    create = files.create_text

    def lost_reply(*args):
        create(*args)
        raise OSError("the reply was lost")

    monkeypatch.setattr(files, "create_text", lost_reply)
    with pytest.raises(OSError, match="lost"):
        snapshot.publish_snapshot(spark, root, good)
    monkeypatch.setattr(files, "create_text", create)
    assert snapshot.open_snapshot(spark, root).orders.count() == 6


def test_two_reloads_at_once_both_stay(spark, shop, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    good = shop.with_tables(orders=shop.orders.where("order_id <> 'o7'"))
    snapshot.publish_snapshot(spark, root, good)
    translation = good.product_category_translation
    create, others = files.create_text, [lambda: snapshot.replace_table(spark, root, "sellers", good.sellers.where("seller_id <> 's3'"))]

    def after_another(*args):
        if others:
            others.pop()()
        return create(*args)

    monkeypatch.setattr(files, "create_text", after_another)
    snapshot.replace_table(spark, root, "product_category_translation", translation.limit(0))
    t = snapshot.open_snapshot(spark, root)
    assert t.sellers.count() == 2 and t.product_category_translation.count() == 0


def test_append(spark, shop, tmp_path):
    path = str(tmp_path / "sellers")
    snapshot.write_table(shop.sellers, path, "sellers")
    snapshot.write_table(shop.sellers.select("seller_state", "seller_id", "seller_city"), path, "sellers", mode="append")
    got = spark.read.parquet(path)
    assert got.columns == ["seller_id", "seller_city", "seller_state"]
    assert got.where("seller_id = 's3' and seller_city = 'idle'").count() == 2


@pytest.fixture
def tiny_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "150")
    spark.conf.set(names[1], "1")
    spark.conf.set(names[2], "40")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def _as_pandas_reads(path):
    df = pd.read_csv(path, dtype=str)
    return sorted(tuple(None if pd.isna(v) else v for v in row) for row in df.itertuples(index=False))


@pytest.mark.parametrize("seed", [1, 2])
def test_records_cut_by_splits_read_as_pandas_reads_them(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)

    def text():
        return rng.choice(
            [
                "plain",
                "with, comma",
                'a "quoted" word',
                "line\nbreak",
                'a\n\n"b"\n,c',
                "NA",
                "",
                "x" * rng.randint(1, 400) + "\n" * rng.randint(0, 20) + '"',
                '\n5" x, 6" y\n',
                "\n".join("long" for _ in range(rng.randint(1, 150))),
            ]
        )

    path = tmp_path / "a.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["id", "text", "tail"])
        writer.writerows([f"id{i:03}", text(), rng.choice(["NULL", "k", " v "])] for i in range(120))
    scan = scan_csv(spark, str(path))
    assert len(next(iter(scan.joined_files.values()))) > 20
    got = sorted(tuple(r) for r in scan.frame().collect())
    assert got == _as_pandas_reads(path)
    assert scan.count() == 120


def test_plain_files_stay_with_the_line_reader(spark, tmp_path, tiny_splits):
    path = tmp_path / "b.csv"
    body = [f'{i},5" pipe {i}' if i % 7 else f'{i},"x, ""y"""' for i in range(200)]
    path.write_text("\n".join(["id,v", *body, "", "   ", ""]))
    scan = scan_csv(spark, str(path))
    assert not scan.joined_files
    assert sorted(tuple(r) for r in scan.frame().collect()) == _as_pandas_reads(path)
    assert scan.count() == 200


def test_folder_of_parts(spark, tmp_path):
    parts = tmp_path / "orders.csv"
    parts.mkdir()
    (parts / "part-1.csv").write_text("a,b\n1,x\n")
    (parts / "part-2.csv").write_text('a,b\n2,"y\nz"\n')
    scan = scan_csv(spark, str(parts))
    assert sorted(tuple(r) for r in scan.frame().collect()) == [("1", "x"), ("2", "y\nz")]
    assert scan.count() == 2
    (parts / "part-3.csv").write_text("b,a\nx,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(parts)).frame().collect()
