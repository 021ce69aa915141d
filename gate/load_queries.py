"""Registered queries of the load: the whole given tables are written as CSV files, loaded, published and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarframe import load
from bazaarframe.plans import metrics
from bazaarframe.session import new_folder, shuffles_dropped, size_for, tune
from bazaarframe.sources import files, snapshot
from bazaarframe.sources.testdata import load_dirty_model, load_loadable_model, load_model
from bazaarframe.tables import Tables

#: Of these tables it is known whether their files have records over several lines.
LINE_BREAKS = {"orders": False, "order_items": False, "order_payments": False}

_WRITTEN = {"quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: Text takes a fraction of its room when compressed. Such files are read whole by a task, so they come in parts of so many rows.
_COMPRESSED = "gzip"
_PART_ROWS = 1_000_000


def write_raw(t: Tables, folder: str, **changed: DataFrame) -> str:
    """CSV files of the tables, as they come from outside: more columns than the model, and reviews over several lines."""
    for name, df in {**t.as_dict(), **changed}.items():
        if name == "customers" and "customer_zip_code_prefix" not in df.columns:
            df = df.select("customer_id", F.lit("01000").alias("customer_zip_code_prefix"), *df.columns[1:])
        if name == "order_reviews":
            comment = F.concat(F.lit('first "line" of '), "order_id", F.lit("\nsecond, and last"))
            df = df.select("review_id", comment.alias("review_comment_message"), *df.columns[1:])
        text = [F.col(c).cast("string").alias(c) for c in df.columns]
        _write_csv(df.select(*text), f"{folder}/{name}.csv")
    return folder


def _write_csv(df: DataFrame, path: str) -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.option("maxRecordsPerFile", _PART_ROWS).csv(path, header=True, compression=_COMPRESSED, **_WRITTEN)


def _sized(spark: SparkSession, sf_dir: str) -> SparkSession:
    return size_for(tune(spark), sf_dir)


_loads: dict[tuple[str, str], tuple[str, str]] = {}


def loaded(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders of the raw files and of the store they were loaded into; the queries that only read share one load a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loads:
        folder = new_folder(_sized(spark, sf_dir), "load")
        t = load_loadable_model(spark, sf_dir, f"{folder}/orders")
        raw = write_raw(t, f"{folder}/raw", customers=load_dirty_model(spark, sf_dir).customers)
        files.delete(spark, f"{folder}/orders")
        load.run_load(spark, raw, f"{folder}/store", line_breaks=LINE_BREAKS, derived=("order_metrics", "sales_cells"))
        _loads[key] = raw, f"{folder}/store"
    return _loads[key]


def opened(spark: SparkSession, sf_dir: str) -> Tables:
    return snapshot.open_snapshot(spark, loaded(spark, sf_dir)[1])


def load_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.row_counts(opened(spark, sf_dir))


def load_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.source_and_stored_counts(spark, *loaded(spark, sf_dir))


def load_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opened(spark, sf_dir).customers


def load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opened(spark, sf_dir).orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"
    )


def load_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the numbers of items: the order of equal ones is open."""
    return opened(spark, sf_dir).order_items.select("order_id", "product_id", "seller_id", "price", "freight_value")


def load_order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.order_metrics(opened(spark, sf_dir)).withColumn("review_score", F.round("review_score", 6))


def load_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(_sized(spark, sf_dir), "refused")
    raw = write_raw(load_dirty_model(spark, sf_dir), f"{folder}/raw")
    return load.refusals(spark, raw, f"{folder}/staged", line_breaks=LINE_BREAKS)


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted values that do not convert, in a column of each type."""
    folder = new_folder(_sized(spark, sf_dir), "rejected")
    t = load_model(spark, sf_dir)
    number = F.substring("order_id", 2, 20).cast("long")
    items = t.order_items.withColumns(
        {
            "order_item_id": F.when(number % 89 == 4, "one").otherwise(F.col("order_item_id").cast("string")),
            "price": F.when(number % 97 == 3, "12,5O").when(number % 101 == 3, F.lit("")).otherwise(F.col("price").cast("string")),
        }
    )
    bought = F.col("order_purchase_timestamp").cast("string")
    orders = t.orders.withColumn("order_purchase_timestamp", F.when(number % 83 == 7, "2020-02-30 10:00:00").otherwise(bought))
    return load.rejects(spark, write_raw(t, f"{folder}/raw", order_items=items, orders=orders), line_breaks=LINE_BREAKS)


def _later_customers(t: Tables) -> DataFrame:
    """Another version of the customers: some cities change, some customers come new, ids otherwise stay."""
    number = F.substring("customer_id", 2, 20).cast("long")
    moved = t.customers.withColumn("customer_city", F.when(number % 7 == 3, F.lit("moved")).otherwise(F.col("customer_city")))
    new = t.customers.where(number % 11 == 2).withColumn("customer_id", F.concat(F.lit("n"), "customer_id"))
    return moved.unionByName(new)


def load_reload_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers reloaded from a later file: the keys that it adds and changes."""
    folder = new_folder(_sized(spark, sf_dir), "reload")
    t = load_loadable_model(spark, sf_dir, f"{folder}/orders")
    root = f"{folder}/store"
    snapshot.publish_snapshot(spark, root, t)
    files.delete(spark, f"{folder}/orders")
    later = _later_customers(t).select("customer_id", F.lit("01000").alias("customer_zip_code_prefix"), *t.customers.columns[1:])
    _write_csv(later, f"{folder}/raw/customers.csv")
    load.reload_customers(spark, f"{folder}/raw", root)
    return snapshot.last_changes(spark, root)["customers"]


def load_would_orphan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that a reload without some customers would leave without one."""
    store = loaded(spark, sf_dir)[1]
    fewer = snapshot.open_snapshot(spark, store).customers.where("cast(substring(customer_id, 2) as bigint) % 37 <> 5")
    return snapshot.would_orphan(spark, store, "customers", fewer)


def load_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers written, and written again behind themselves with columns in another order, by state."""
    t = load_model(_sized(spark, sf_dir), sf_dir)
    path = f"{new_folder(spark, 'append')}/sellers"
    snapshot.write_table(t.sellers, path, "sellers")
    snapshot.write_table(t.sellers.select("seller_state", "seller_city", "seller_id"), path, "sellers", mode="append")
    return spark.read.parquet(path).groupBy("seller_state").agg(
        F.count("*").alias("rows"), F.count_distinct("seller_id").alias("sellers")
    )


QUERIES = {
    f.__name__: f
    for f in (
        load_row_counts,
        load_source_counts,
        load_customers,
        load_orders,
        load_items,
        load_order_metrics,
        load_refusals,
        load_rejects,
        load_reload_changes,
        load_would_orphan,
        load_appended,
    )
}
