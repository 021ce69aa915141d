import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from bazaarframe.schema import TABLES  # noqa: E402
from bazaarframe.session import local_session  # noqa: E402
from bazaarframe.tables import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        "4",
        "bazaarframe-tests",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(folder / "checkpoint"),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__driver__memory="4g",
    )
    yield session
    session.stop()


def _cell(value, kind: str):
    if value is None:
        return None
    if kind == "decimal(12,2)":
        return Decimal(str(value))
    if kind == "timestamp_ntz" and isinstance(value, str):
        return datetime.fromisoformat(value)
    return value


def frame(spark, name: str, *rows: dict):
    """A model table from dicts; columns not given are NULL."""
    spec = TABLES[name]
    data = [tuple(_cell(row.get(c.name), c.type.simpleString()) for c in spec.columns) for row in rows]
    return spark.createDataFrame(data, spec.struct)


@pytest.fixture(scope="session")
def make_tables(spark):
    """Build the eight tables from lists of dicts; tables not given are empty."""

    def build(**rows) -> Tables:
        return Tables(**{name: frame(spark, name, *rows.get(name, [])) for name in TABLES})

    return build


@pytest.fixture(scope="session")
def shop(make_tables) -> Tables:
    """A tiny marketplace that holds one case of each rule."""

    def order(n, customer, status="delivered", bought=None, arrived=None, promised=None):
        return dict(
            order_id=f"o{n}",
            customer_id=customer,
            order_status=status,
            order_purchase_timestamp=bought,
            order_delivered_customer_date=arrived,
            order_estimated_delivery_date=promised,
        )

    def item(n, i, product, seller, price, freight):
        return dict(
            order_id=f"o{n}", order_item_id=i, product_id=product, seller_id=seller, price=price, freight_value=freight
        )

    return make_tables(
        customers=[
            dict(customer_id="c1", customer_unique_id="u1", customer_city="rio", customer_state="RJ"),
            dict(customer_id="c2", customer_unique_id="u1", customer_city="rio", customer_state="RJ"),
            dict(customer_id="c3", customer_unique_id="u2", customer_city="sampa", customer_state="SP"),
            dict(customer_id="c4", customer_unique_id="u3", customer_city=None, customer_state=None),
            dict(customer_id="c5", customer_unique_id="u4", customer_city="sampa", customer_state="SP"),
            dict(customer_id="c6", customer_unique_id="u5", customer_city="sampa", customer_state="SP"),
        ],
        orders=[
            # two items, payments and reviews; late
            order(1, "c1", "delivered", "2020-01-10 10:00:00", "2020-01-20 10:00:00", "2020-01-15 00:00:00"),
            # delivered exactly when promised: not late
            order(2, "c2", "delivered", "2020-01-31 23:59:59.999999", "2020-02-05 00:00:00", "2020-02-05 00:00:00"),
            # no items, payments or reviews; never delivered
            order(3, "c3", "shipped", "2020-02-01 00:00:00", None, "2020-02-20 00:00:00"),
            # unknown state, unknown purchase time, unknown estimate
            order(4, "c4", "delivered", None, "2020-03-01 00:00:00", None),
            # canceled but delivered
            order(5, "c5", "canceled", "2020-02-10 00:00:00", "2020-02-12 12:00:00", "2020-02-11 00:00:00"),
            # unavailable
            order(6, "c6", "unavailable", "2020-02-11 00:00:00"),
            # no such customer
            order(7, "c9", "delivered", "2020-02-12 00:00:00", "2020-02-13 00:00:00", "2020-02-20 00:00:00"),
        ],
        product_category_translation=[
            dict(product_category_name="livros", product_category_name_english="books"),
        ],
        products=[
            dict(product_id="p1", product_category_name="livros"),
            dict(product_id="p2", product_category_name="raro"),
            dict(product_id="p3", product_category_name=None),
        ],
        sellers=[
            dict(seller_id="s1", seller_city="rio", seller_state="RJ"),
            dict(seller_id="s2", seller_city="rio", seller_state="RJ"),
            dict(seller_id="s3", seller_city="idle", seller_state="RJ"),
        ],
        order_items=[
            item(1, 1, "p1", "s1", "10.00", "1.00"),
            item(1, 2, "p1", "s1", "5.01", "2.00"),
            item(2, 1, "p2", "s2", "20.00", "3.00"),
            item(4, 1, "p3", "s1", "7.00", "0.50"),
            item(5, 1, "p1", "s2", "100.00", "9.00"),
        ],
        order_payments=[
            dict(order_id="o1", payment_sequential=1, payment_value="10.00"),
            dict(order_id="o1", payment_sequential=2, payment_value="8.01"),
            dict(order_id="o2", payment_sequential=1, payment_value="23.00"),
        ],
        order_reviews=[
            dict(review_id="r1", order_id="o1", review_score=1),
            dict(review_id="r2", order_id="o1", review_score=2),
            dict(review_id="r3", order_id="o2", review_score=5),
            dict(review_id="r4", order_id="o5", review_score=4),
        ],
    )


def rows(df, key=None) -> list[dict]:
    found = [r.asDict() for r in df.collect()]
    return sorted(found, key=lambda r: (r[key] is None, r[key])) if key else found
