"""Maps the star-schema Parquet test tables onto the marketplace model.

Every order gets its own ``customer_id``; ids starting with 'r' belong to returning persons. The
mapping leaves gaps on purpose: orders without customer, items, payments, reviews or dates, canceled
orders that were delivered, products without category, and a category without translation.

The item number is the raw line number, which repeats within some orders. Numbering items afresh
would need a whole order in one task, and no metric reads the number's value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarframe.operators.joins import unique_join
from bazaarframe.schema import TABLES
from bazaarframe.session import new_folder, shuffles_dropped
from bazaarframe.tables import Tables

# Columns read from each test table; naming them spares a schema-inference job per read.
_RAW = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_type string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double",
}
# Raw amounts are doubles that hold whole cents; going through the cents is cheaper than a cast.
_MONEY = "cast(cast(rint(({}) * 100) as bigint) * 0.01BD as decimal(12,2))"
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"


class _Source:
    """Builds the model tables of one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(_RAW[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def shape(df: DataFrame, name: str, **columns: str) -> DataFrame:
        """Project to the declared columns and types; columns not given become typed NULLs."""
        return df.selectExpr(
            *[f"cast({columns.get(c.name, 'null')} as {c.type.simpleString()}) as {c.name}" for c in TABLES[name].columns]
        )

    def customers(self) -> DataFrame:
        orders = self.raw("orders").where("o_orderkey % 500 <> 499").select("o_orderkey", "o_custkey")
        customer = self.raw("customer").withColumnRenamed("c_custkey", "o_custkey")
        return self.shape(
            unique_join(orders, customer, "o_custkey"),
            "customers",
            customer_id="concat('c', o_orderkey)",
            customer_unique_id="if(o_orderkey % 10 < 9, concat('o', o_orderkey), concat('r', o_custkey))",
            customer_city="lower(c_mktsegment)",
            customer_state=f"if(c_nationkey = 24, null, concat(substr({_LETTERS}, c_nationkey + 1, 1), 'X'))",
        )

    def product_category_translation(self) -> DataFrame:
        return self.shape(
            self.raw("part").where("p_type <> 'PROMO'").select("p_type").distinct(),
            "product_category_translation",
            product_category_name="lower(p_type)",
            product_category_name_english="concat('en_', lower(p_type))",
        )

    def products(self) -> DataFrame:
        return self.shape(
            self.raw("part"),
            "products",
            product_id="concat('p', p_partkey)",
            product_category_name="if(p_partkey % 50 = 0, null, lower(p_type))",
        )

    def sellers(self) -> DataFrame:
        return self.shape(
            self.raw("supplier"),
            "sellers",
            seller_id="concat('s', s_suppkey)",
            seller_city="concat('city_', s_suppkey % 7)",
            seller_state=f"concat(substr({_LETTERS}, s_nationkey + 1, 1), 'X')",
        )

    def orders(self) -> DataFrame:
        def later(hours: str) -> str:
            return f"o_orderdate + make_dt_interval(0, cast({hours} as int))"

        delivery = later("(o_orderkey * 7 % 30) * 24 + o_orderkey * 5 % 24 + 24")
        return self.shape(
            self.raw("orders"),
            "orders",
            order_id="concat('o', o_orderkey)",
            customer_id="concat('c', o_orderkey)",
            order_status="case o_orderkey % 20 when 0 then 'canceled' when 1 then 'unavailable'"
            " when 2 then 'shipped' else 'delivered' end",
            order_purchase_timestamp=f"if(o_orderkey % 301 = 300, null, {later('o_orderkey % 24')})",
            order_delivered_customer_date="if(o_orderkey % 20 in (1, 2) or o_orderkey % 40 = 20, null, "
            f"{delivery})",
            order_estimated_delivery_date="if(o_orderkey % 97 = 96, null, "
            f"{later('24 * (10 + o_orderkey % 11)')})",
        )

    def order_items(self) -> DataFrame:
        return self.shape(
            self.raw("lineitem"),
            "order_items",
            order_id="concat('o', l_orderkey)",
            order_item_id="l_linenumber",
            product_id="concat('p', l_partkey)",
            seller_id="concat('s', l_suppkey)",
            price=_MONEY.format("l_extendedprice"),
            freight_value=_MONEY.format("l_quantity + 5.25D"),
        )

    def order_payments(self) -> DataFrame:
        first = self.shape(
            self.raw("orders").where("o_orderkey % 200 <> 0"),
            "order_payments",
            order_id="concat('o', o_orderkey)",
            payment_sequential="1",
            payment_value=_MONEY.format("o_totalprice"),
        )
        second = self.shape(
            self.raw("orders").where("o_orderkey % 15 = 0"),
            "order_payments",
            order_id="concat('o', o_orderkey)",
            payment_sequential="2",
            payment_value="10",
        )
        return first.unionByName(second)

    def order_reviews(self) -> DataFrame:
        first = self.shape(
            self.raw("orders").where("o_orderkey % 8 <> 0"),
            "order_reviews",
            review_id="concat('r1_', o_orderkey)",
            order_id="concat('o', o_orderkey)",
            review_score="o_orderkey % 5 + 1",
        )
        second = self.shape(
            self.raw("orders").where("o_orderkey % 50 = 3"),
            "order_reviews",
            review_id="concat('r2_', o_orderkey)",
            order_id="concat('o', o_orderkey)",
            review_score="5",
        )
        return first.unionByName(second)

    # Variants with broken references, bad values, missing keys and untidy text.

    def untidy_customers(self) -> DataFrame:
        return self.shape(
            self.customers(),
            "customers",
            customer_id="customer_id",
            customer_unique_id="customer_unique_id",
            customer_city="if(length(customer_id) % 2 = 0, concat(' ', customer_city, '\\t'), customer_city)",
            customer_state="lower(customer_state)",
        )

    def dirty_items(self) -> DataFrame:
        return self.shape(
            self.raw("lineitem"),
            "order_items",
            order_id="if(l_orderkey % 503 = 7, 'o10000000', concat('o', l_orderkey))",
            order_item_id="if(l_orderkey % 899 = 11, null, l_linenumber)",
            product_id="if(l_partkey % 211 = 3, 'p10000000', concat('p', l_partkey))",
            seller_id="if(l_suppkey % 53 = 9, 's10000000', concat('s', l_suppkey))",
            price=_MONEY.format("if(l_orderkey % 601 = 2, -1D, l_extendedprice)"),
            freight_value=_MONEY.format("if(l_orderkey % 701 = 3, -1D, l_quantity + 5.25D)"),
        )

    def dirty_payments(self) -> DataFrame:
        return self.shape(
            self.raw("orders"),
            "order_payments",
            order_id="concat('o', if(o_orderkey % 409 = 6, o_orderkey + 10000000, o_orderkey))",
            payment_sequential="1",
            payment_value=_MONEY.format("if(o_orderkey % 307 = 4, -1D, o_totalprice)"),
        )

    def dirty_reviews(self) -> DataFrame:
        return self.shape(
            self.raw("orders").where("o_orderkey % 8 <> 0"),
            "order_reviews",
            review_id="if(o_orderkey % 997 = 5, null, concat('r1_', o_orderkey))",
            order_id="concat('o', if(o_orderkey % 401 = 5, o_orderkey + 10000000, o_orderkey))",
            review_score="case o_orderkey % 211 when 0 then 0 when 1 then 6 when 2 then null"
            " else o_orderkey % 5 + 1 end",
        )


def load_model(spark: SparkSession, sf_dir: str) -> Tables:
    """The clean model; the only broken references are the orders without customer."""
    source = _Source(spark, sf_dir)
    return Tables(**{name: getattr(source, name) for name in TABLES})


def load_loadable_model(spark: SparkSession, sf_dir: str, folder: str | None = None) -> Tables:
    """The clean model as a load accepts it: no broken reference, and items of one order with numbers of their own.

    Orders without customer go, with all that refers to them; an item number that an order repeats is raised by a thousand
    each time. The orders that stay are written once to the folder, by default one in the shared folder, for the three tables that
    refer to them.
    """
    t = load_model(spark, sf_dir)
    orders = t.orders.join(t.customers.select("customer_id"), "customer_id", "left_semi").select(t.orders.columns)
    folder = folder or new_folder(spark, "orders")
    with shuffles_dropped(spark):
        orders.write.parquet(folder)
    orders = spark.read.schema(orders.schema).parquet(folder)
    known = orders.select("order_id")
    again = Window.partitionBy("order_id", "order_item_id").orderBy("product_id", "seller_id", "price", "freight_value")
    items = t.order_items.join(known, "order_id", "left_semi").withColumn(
        "order_item_id", (F.col("order_item_id") + 1000 * (F.row_number().over(again) - 1)).cast("int")
    )
    return t.with_tables(
        orders=orders,
        order_items=items.select(t.order_items.columns),
        order_payments=t.order_payments.join(known, "order_id", "left_semi").select(t.order_payments.columns),
        order_reviews=t.order_reviews.join(known, "order_id", "left_semi").select(t.order_reviews.columns),
    )


def load_dirty_model(spark: SparkSession, sf_dir: str) -> Tables:
    """The model with broken references, bad values, missing keys and untidy text."""
    source = _Source(spark, sf_dir)
    return load_model(spark, sf_dir).with_tables(
        customers=source.untidy_customers,
        order_items=source.dirty_items,
        order_payments=source.dirty_payments,
        order_reviews=source.dirty_reviews,
    )
