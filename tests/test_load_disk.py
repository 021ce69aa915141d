"""A load keeps on disk what it still needs: no shuffle files of steps that are done, no folders of intermediate rows, no plain text."""

import time
from datetime import datetime

import pytest

from bazaarframe.operators import checks
from bazaarframe.plans import derived
from bazaarframe.session import new_folder, shared_folder
from bazaarframe.sources import files, snapshot
from bazaarframe.sources.csv_source import read_csv_folder
from gate import load_queries


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").splitlines() if "/shuffle_" in f}


def folders(spark):
    return set(files.glob(spark, f"{shared_folder(spark)}/*"))


@pytest.fixture
def good(shop):
    return shop.with_tables(orders=shop.orders.where("order_id <> 'o7'"))


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Test tables of a few rows: order 499 has no customer, order 1 repeats an item number."""
    day = datetime(1996, 1, 5)
    tables = {
        "orders": ([(k, 1 + k % 2, 10.0, day) for k in (1, 2, 3, 499)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
        "customer": ([(1, 0, "A"), (2, 1, "B")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": ([(1, "ECO"), (2, "PROMO")], "p_partkey long, p_type string"),
        "supplier": ([(1, 0)], "s_suppkey long, s_nationkey int"),
        "lineitem": (
            [(1, 1, 1, 1, 1.0, 10.0), (1, 2, 1, 1, 2.0, 20.0), (2, 1, 1, 1, 1.0, 5.0), (499, 1, 1, 1, 1.0, 5.0)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double",
        ),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_steps_of_a_load_leave_no_shuffle_files(spark, good, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, session = shuffle_files(spark), spark.conf.get(setting, None)
    snapshot.publish_snapshot(spark, str(tmp_path), good, derived=("order_metrics", "sales_cells"))
    until = time.time() + 5
    while shuffle_files(spark) - before and time.time() < until:  # they are deleted a little later
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(setting, None) == session


def test_derived_tables_leave_no_intermediate_rows(spark, shop):
    before = folders(spark)
    t = derived.store(shop, "order_metrics", "sales_cells")
    assert sorted(path.rsplit("/", 1)[-1].split("-")[0] for path in folders(spark) - before) == ["order_metrics", "sales_cells"]
    assert not any("building" in path for path in folders(spark) - before)
    assert t.derived["order_metrics"].count() == 6


def test_a_derived_table_that_fails_leaves_nothing(spark, shop):
    path = new_folder(spark, "failed")
    broken = shop.with_tables(orders=shop.orders.selectExpr("raise_error('broken') as order_id", *shop.orders.columns[1:]))
    with pytest.raises(Exception, match="broken"):
        derived.write_derived(broken, "order_metrics", path)
    assert files.glob(spark, f"{path}*") == []


def test_raw_files_are_compressed_parts_of_bounded_rows(spark, shop, tmp_path, monkeypatch):
    monkeypatch.setattr(load_queries, "_PART_ROWS", 2)
    load_queries.write_raw(shop.with_tables(orders=shop.orders.coalesce(1)), str(tmp_path / "raw"))
    parts = files.glob(spark, f"{tmp_path}/raw/orders.csv/part-*")
    assert len(parts) == 4 and all(path.endswith(".csv.gz") for path in parts)  # seven orders
    read = read_csv_folder(spark, str(tmp_path / "raw"))
    for name, df in shop.as_dict().items():
        assert read[f"{name}.csv"].count() == df.count()
        key = df.columns[0]
        assert rows(read[f"{name}.csv"].select(key)) == rows(df.select(key))


def test_groups_of_tables_check_every_rule_once(shop, make_tables):
    groups = snapshot._check_groups()
    assert len(groups) == 4
    for t in (shop, make_tables(order_items=[dict(order_id="o1")], order_payments=[dict(order_id="o2", payment_sequential=1)] * 2)):
        apart = [checks.constraint_violations(t.as_dict(), names, incoming=False) for names in groups]
        assert rows(checks.union_all(apart)) == rows(checks.constraint_violations(t))


def test_the_source_counts_need_no_rows_but_raw_files_and_store(spark, sf_dir):
    before = folders(spark)
    found = rows(load_queries.load_source_counts(spark, sf_dir))
    counts = dict(customers=3, product_category_translation=1, products=2, sellers=1, orders=3, order_items=3, order_payments=3, order_reviews=4)
    assert found == sorted((name, n, n) for name, n in counts.items())
    (folder,) = folders(spark) - before
    assert {path.rsplit("/", 1)[-1] for path in files.glob(spark, f"{folder}/*")} == {"raw", "store"}
