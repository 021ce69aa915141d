"""The six metric views, each a function from ``Tables`` to a lazy DataFrame.

Shared choices:

* Items, payments and reviews are reduced to one row per order before any join, so an order with
  many of them is combined map-side and never fans out.
* Nothing carries a broadcast hint: Spark compares the measured size of a side with
  ``spark.sql.autoBroadcastJoinThreshold``. Beyond it, ``unique_join`` keeps a hot customer, order
  or product from ending up in one task.
* A distinct count over one column runs as two hash aggregations, first by (group, value), so a
  group that holds most of the rows is still spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarframe.functions.exact import duration_days, exact_avg, mean_score
from bazaarframe.functions.predicates import active_orders
from bazaarframe.operators.joins import unique_join
from bazaarframe.tables import Tables


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast("decimal(22,2)")).alias(column)


PLACED_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_unique_id",
    "customer_city",
    "customer_state",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def order_metrics(t: Tables, folder: str | None = None) -> DataFrame:
    """One row per order that has a customer: its place, status, times, amounts and score.

    With a folder, the orders with their customers are written there first: the shuffles that bring them together are gone when
    the amounts come.
    """
    if "order_metrics" in t.derived:
        return t.derived["order_metrics"]
    items = t.order_items.groupBy("order_id").agg(
        F.count("*").alias("items_count"),
        F.sum("price").alias("product_value"),
        F.sum("freight_value").alias("freight_value"),
    )
    payments = t.order_payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_value"))
    reviews = t.order_reviews.groupBy("order_id").agg(mean_score(F.col("review_score")).alias("review_score"))

    # Customers first: the exchange on order_id that follows lets adaptive execution split a hot
    # customer_id, and all three left joins then reuse that one partitioning.
    placed = unique_join(t.orders, t.customers, "customer_id").select(*PLACED_COLUMNS)
    if folder:
        placed.write.parquet(folder, compression="zstd")
        placed = placed.sparkSession.read.schema(placed.schema).parquet(folder)
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return (
        placed.join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
        .select(
            *PLACED_COLUMNS,
            F.coalesce(F.col("items_count"), F.lit(0).cast("bigint")).alias("items_count"),
            _or_zero("product_value"),
            _or_zero("freight_value"),
            _or_zero("payment_value"),
            "review_score",
            F.coalesce(late, F.lit(False)).alias("delivered_late"),
        )
    )


def active_order_metrics(t: Tables) -> DataFrame:
    """Order metrics of sales only; the status filter reaches the scan of orders."""
    return active_orders(order_metrics(t))


def monthly_sales(t: Tables) -> DataFrame:
    """Orders, customers and amounts per purchase month; one month is NULL when unknown. Stored cells answer it alone."""
    if "sales_cells" in t.derived:
        from bazaarframe.plans.cells import merged

        return merged(t.derived["sales_cells"], "month").select(
            "month",
            "orders",
            "customers",
            F.col("product_value").alias("gmv"),
            exact_avg(F.col("product_value"), F.col("orders")).alias("average_order_value"),
            "freight_value",
        )
    return (
        active_order_metrics(t)
        .groupBy(F.trunc("order_purchase_timestamp", "MM").alias("month"))
        .agg(
            F.count("*").alias("orders"),
            F.count_distinct("customer_unique_id").alias("customers"),
            F.sum("product_value").alias("gmv"),
            exact_avg(F.sum("product_value"), F.count("product_value")).alias("average_order_value"),
            F.sum("freight_value").alias("freight_value"),
        )
    )


def product_categories(t: Tables) -> DataFrame:
    """Category label of each product: English name, else original name, else 'unknown'."""
    label = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    named = unique_join(t.products, t.product_category_translation, "product_category_name", "left")
    return named.select("product_id", label.alias("category"))


def _active_items(t: Tables, *columns: str) -> DataFrame:
    items = t.order_items.select("order_id", "order_item_id", *columns, "price", "freight_value")
    return unique_join(items, active_orders(t.orders).select("order_id"), "order_id")


def _sales_measures(items_sold: Column) -> list[Column]:
    return [
        F.count_distinct("order_id").alias("orders"),
        items_sold.alias("items_sold"),
        F.sum("price").alias("revenue"),
        exact_avg(F.sum("price"), F.count("price")).alias("average_item_price"),
        F.sum("freight_value").alias("freight_value"),
    ]


def category_performance(t: Tables) -> DataFrame:
    """Sales per product category."""
    items = _active_items(t, "product_id")
    return (
        unique_join(items, product_categories(t), "product_id")
        .groupBy("category")
        .agg(*_sales_measures(F.count("order_item_id")))
    )


def customer_metrics(t: Tables) -> DataFrame:
    """Orders, spending and first and last purchase per person."""
    return (
        active_order_metrics(t)
        .groupBy("customer_unique_id")
        .agg(
            F.count("*").alias("orders"),
            F.sum("product_value").alias("total_spent"),
            exact_avg(F.sum("product_value"), F.count("product_value")).alias("average_order_value"),
            F.min("order_purchase_timestamp").alias("first_purchase"),
            F.max("order_purchase_timestamp").alias("last_purchase"),
        )
    )


def seller_performance(t: Tables) -> DataFrame:
    """Sales per seller with at least one active item.

    Items are aggregated by seller before sellers are joined, so a seller with a third of all items
    meets the join as a single row. This relies on ``seller_id`` being the key of sellers.
    """
    sales = _active_items(t, "seller_id").groupBy("seller_id").agg(*_sales_measures(F.count("*")))
    return t.sellers.join(sales, "seller_id").select("seller_id", "seller_city", "seller_state", *sales.columns[1:])


def delivery_performance(t: Tables) -> DataFrame:
    """One row per delivered order, whatever its status, with the days it took."""
    purchased, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return (
        order_metrics(t)
        .where(delivered.isNotNull())
        .select(
            "order_id",
            "customer_state",
            "order_purchase_timestamp",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
            duration_days(purchased, delivered).alias("delivery_days"),
            "delivered_late",
            "review_score",
        )
    )


def store_order_metrics(t: Tables) -> Tables:
    """The same tables with the order metrics written once to the shared folder.

    For tables that no snapshot holds; a snapshot names its stored results itself (``snapshot.derive``).
    """
    from bazaarframe.plans.derived import store

    return store(t, "order_metrics")


# The view names under which these are registered for SQL.
VIEWS = {
    "vw_order_metrics": order_metrics,
    "vw_monthly_sales": monthly_sales,
    "vw_category_performance": category_performance,
    "vw_customer_metrics": customer_metrics,
    "vw_seller_performance": seller_performance,
    "vw_delivery_performance": delivery_performance,
}
