"""Results that are stored beside the tables they come from.

A derived table is a view of the model written once as Parquet, laid out for its readers. It is good for exactly the versions
of its inputs it was built from; a snapshot keeps both in one manifest (see ``sources.snapshot``), and the metrics read
a stored result in place of its computation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from bazaarframe.plans import cells, metrics
from bazaarframe.session import new_folder, shuffles_dropped
from bazaarframe.sources import files
from bazaarframe.tables import Tables


COMPRESSION = "zstd"  # of all stored tables: three quarters of the room that Spark's own choice takes


@dataclass(frozen=True)
class Derived:
    """How a derived table is built (with a folder for what is needed meanwhile), from which tables, and the columns whose ranges make its files."""

    inputs: tuple[str, ...]
    build: Callable[[Tables, str], DataFrame]
    stored_by: tuple[str, ...]


DERIVED = {
    # Files cover ranges of purchase time, so a filtered period skips most of them.
    "order_metrics": Derived(
        ("customers", "orders", "order_items", "order_payments", "order_reviews"),
        metrics.order_metrics,
        ("order_purchase_timestamp", "order_id"),
    ),
    "sales_cells": Derived(
        ("customers", "orders", "order_items", "order_payments", "order_reviews"),
        cells.sales_cells,
        ("month", "customer_state", "bucket"),
    ),
}


def write_derived(t: Tables, name: str, path: str) -> None:
    """Compute a derived table and write it; other derived tables of ``t`` may serve, an older one of its name does not.

    It is written to a folder beside the path before it is dealt out in ranges: the range exchange reads its input twice, and the
    shuffles of the computation are gone by then.
    """
    spec = DERIVED[name]
    others = {other: df for other, df in t.derived.items() if other != name}
    spark = t.orders.sparkSession
    folder = f"{path.rstrip('/')}-building"
    try:
        with shuffles_dropped(spark):
            built = spec.build(t.without_derived().with_derived(**others), f"{folder}/meanwhile")
            built.write.parquet(f"{folder}/built", compression=COMPRESSION)
            files.delete(spark, f"{folder}/meanwhile")
            rows = spark.read.schema(built.schema).parquet(f"{folder}/built")
            rows.repartitionByRange(*spec.stored_by).sortWithinPartitions(*spec.stored_by).write.parquet(path, compression=COMPRESSION)
    finally:
        files.delete(spark, folder)


def store(t: Tables, *names: str) -> Tables:
    """Tables that no snapshot holds, with derived tables written to the shared folder, in the given order."""
    spark = t.orders.sparkSession
    for name in names:
        path = new_folder(spark, name)
        write_derived(t, name, path)
        t = t.with_derived(**{name: spark.read.parquet(path)})
    return t
