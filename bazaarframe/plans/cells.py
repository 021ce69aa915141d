"""Sales by month and state as cells that merge exactly, distinct persons included.

Persons have dense numbers, and a cell holds the set of its persons as bitmaps of 32,768 numbers each, one row per bitmap.
The union of sets is the OR of their bitmaps, so any choice of months and states has its exact number of persons without
a look at its orders. Persons are numbered by state and first purchase: those of a cell stand close together and fill few bitmaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarframe.operators.numbering import numbered
from bazaarframe.plans import metrics
from bazaarframe.tables import Tables


def person_numbers(t: Tables, folder: str | None = None) -> DataFrame:
    """(customer_unique_id, person): a dense number for everyone with an active order."""
    people = (
        metrics.active_order_metrics(t)
        .where("customer_unique_id is not null")
        .groupBy("customer_unique_id")
        .agg(F.min("customer_state").alias("home"), F.min("order_purchase_timestamp").alias("since"))
    )
    return numbered(people, "person", "home", "since", "customer_unique_id", folder=folder).select("customer_unique_id", "person")


def sales_cells(t: Tables, folder: str | None = None) -> DataFrame:
    """One row per month, state and bitmap of persons, with the sums of these persons' orders there; the numbers go to the folder.

    Orders of nobody known have a row without bitmap. All columns add up over rows, people by bitmap_or_agg.

    Persons are summed up first and then brought together by cell, at most 32,768 rows each, so that a bitmap is built once:
    tasks that each build their own of every cell would shuffle as many bitmaps as cells times tasks.
    """
    sales = metrics.active_order_metrics(t).join(person_numbers(t, folder), "customer_unique_id", "left")
    cell = ("month", "customer_state", "bucket")
    by_person = sales.groupBy(
        F.trunc("order_purchase_timestamp", "MM").alias("month"),
        "customer_state",
        F.bitmap_bucket_number("person").alias("bucket"),
        "person",
    ).agg(
        F.count("*").alias("orders"),
        F.sum("product_value").alias("product_value"),
        F.sum("freight_value").alias("freight_value"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("scored"),
    )
    sums = by_person.schema.fields[len(cell) + 1 :]
    return by_person.repartition(*cell).groupBy(*cell).agg(
        F.when(F.count("person") > 0, F.bitmap_construct_agg(F.bitmap_bit_position("person"))).alias("people"),
        *[F.sum(s.name).cast(s.dataType).alias(s.name) for s in sums],
    )


def merged(cells: DataFrame, *groups) -> DataFrame:
    """Cells united by group: orders, customers (distinct), product_value, freight_value, score_sum, scored.

    Without groups one row, also if there is no cell.
    """
    sums = ("orders", "product_value", "freight_value", "score_sum", "scored")
    keyed = cells.select(*groups, "bucket", "people", *sums)
    names = keyed.columns[: len(groups)]
    united = keyed.groupBy(*names, "bucket").agg(
        F.when(F.count("people") > 0, F.bitmap_count(F.bitmap_or_agg(F.coalesce("people", F.lit(b""))))).alias("customers"),
        *[F.sum(c).alias(c) for c in sums],
    )
    total = united.groupBy(*names) if names else united
    # The types that the same sums have over orders.
    kinds = {"product_value": "decimal(32,2)", "freight_value": "decimal(32,2)", "score_sum": "decimal(37,16)"}
    return total.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("orders", "customers", "scored")],
        *[F.sum(c).cast(kind).alias(c) for c, kind in kinds.items()],
    )
