import pytest
from pyspark.sql import functions as F

from bazaarframe.operators import checks, clean, profile
from bazaarframe.schema import TABLES
from tests.conftest import frame, rows


def _one(df):
    return df.first()[0]


def test_orphans_count_rows_and_null_keys(make_tables):
    t = make_tables(
        orders=[dict(order_id="o1", customer_id="c1"), dict(order_id="o2", customer_id="x"), dict(order_id="o3", customer_id="x"), dict(order_id="o4")],
        customers=[dict(customer_id="c1")],
        order_items=[dict(order_id="o1", product_id="p1", seller_id="s1"), dict(order_id="o9", product_id="p9", seller_id=None)],
        products=[dict(product_id="p1")],
        sellers=[dict(seller_id="s1")],
        order_payments=[dict(order_id="o1"), dict(order_id="o8"), dict(order_id="o8")],
        order_reviews=[dict(review_id="r", order_id="o1")],
    )
    assert checks.orphan_orders(t).first().asDict() == {"orphan_orders": 3}
    assert checks.orphan_items_orders(t).first().asDict() == {"orphan_order_items_orders": 1}
    assert checks.orphan_items_products(t).first().asDict() == {"orphan_order_items_products": 1}
    assert checks.orphan_items_sellers(t).first().asDict() == {"orphan_order_items_sellers": 1}
    assert checks.orphan_payments(t).first().asDict() == {"orphan_payments": 2}
    assert checks.orphan_reviews(t).first().asDict() == {"orphan_reviews": 0}


def test_value_checks(make_tables):
    t = make_tables(
        order_reviews=[dict(review_id=str(s), order_id="o", review_score=s) for s in (0, 1, 5, 6, None)],
        order_items=[
            dict(price="-1", freight_value="-1"),
            dict(price="0", freight_value="-0.01"),
            dict(price="0", freight_value="0"),
        ],
        order_payments=[dict(payment_value="-0.01"), dict(payment_value=None), dict(payment_value="0")],
    )
    assert _one(checks.invalid_review_scores(t)) == 2
    assert _one(checks.invalid_item_values(t)) == 2
    assert _one(checks.invalid_payments(t)) == 1


def test_untranslated_categories(make_tables):
    t = make_tables(
        products=[dict(product_id=str(i), product_category_name=c) for i, c in enumerate(["a", "b", "b", "c", None])],
        product_category_translation=[dict(product_category_name="c", product_category_name_english="C")],
    )
    assert [tuple(x) for x in checks.untranslated_categories(t).collect()] == [("b", 2), ("a", 1)]


def test_key_checks(spark):
    spec = TABLES["order_items"]
    good = frame(spark, "order_items", dict(order_id="o", order_item_id=1), dict(order_id="o", order_item_id=2))
    checks.require_valid(good, spec)
    with_null = good.union(frame(spark, "order_items", dict(order_id="o")))
    assert checks.pk_nulls(with_null, spec).first()["null_key_rows"] == 1
    with pytest.raises(ValueError, match="null"):
        checks.require_valid(with_null, spec)
    repeated = good.union(good).union(good.limit(1))
    assert checks.pk_duplicates(repeated, spec).first().asDict() == {
        "table_name": "order_items",
        "duplicated_keys": 2,
        "surplus_rows": 3,
    }
    with pytest.raises(ValueError, match="duplicated"):
        checks.require_valid(repeated, spec)


def test_check_columns(spark):
    spec = TABLES["customers"]
    checks.check_columns(frame(spark, "customers"), spec)
    with pytest.raises(ValueError, match=r"customers: missing columns \['customer_state'\]"):
        checks.check_columns(frame(spark, "customers").drop("customer_state"), spec)
    with pytest.raises(ValueError, match="customer_zip_code_prefix"):
        checks.check_columns(frame(spark, "customers"), spec, ("customer_zip_code_prefix",))


def test_constraint_violations(shop, make_tables):
    found = {(x["table_name"], x["rule"]): x["violations"] for x in checks.constraint_violations(shop).collect()}
    assert {k: v for k, v in found.items() if v} == {("orders", "reference customer_id"): 1}
    broken = make_tables(
        customers=[dict(customer_id="x" * 33, customer_state="ABC"), dict(customer_id="c"), dict(customer_id="c")],
        order_reviews=[dict(review_id="r", order_id="o", review_score=9), dict(review_id=None, order_id=None)],
    )
    found = {(x["table_name"], x["rule"]): x["violations"] for x in checks.constraint_violations(broken).collect()}
    assert {k: v for k, v in found.items() if v} == {
        ("customers", "not null customer_unique_id"): 3,
        ("customers", "length customer_id"): 1,
        ("customers", "length customer_state"): 1,
        ("customers", "primary key"): 1,
        ("order_reviews", "not null review_id"): 1,
        ("order_reviews", "not null order_id"): 1,
        ("order_reviews", "check review_score"): 1,
        ("order_reviews", "reference order_id"): 1,
    }


def test_money_range_is_checked_on_wider_types(make_tables, spark):
    t = make_tables()
    wide = frame(spark, "order_payments", dict(order_id="o", payment_sequential=1)).withColumn(
        "payment_value", F.lit("10000000000.00").cast("decimal(20,2)")
    )
    found = checks.row_violations(wide, TABLES["order_payments"]).where("violations > 0").collect()
    assert [x["rule"] for x in found] == ["range payment_value"]
    assert t.order_payments.count() == 0


def test_clean_text_columns(spark):
    df = spark.createDataFrame(
        [("\t sp ", " São Paulo \n", " keep "), (None, None, None), ("\x1cß", " x y ", "")],
        "customer_state string, customer_city string, other string",
    )
    got = [tuple(x) for x in clean.clean_text_columns(df).collect()]
    assert got == [("SP", "São Paulo", " keep "), (None, None, None), ("SS", "x y", "")]


def test_project_to_spec(spark):
    df = frame(spark, "sellers", dict(seller_id="s")).withColumn("zip", F.lit(1)).select("zip", "seller_state", "seller_city", "seller_id")
    assert clean.project_to_spec(df, TABLES["sellers"]).columns == ["seller_id", "seller_city", "seller_state"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x"), (None, "x")], "`a.b` int, c string")
    assert profile.profile_shape(df, "t").first().asDict() == {"table_name": "t", "row_count": 5, "column_count": 2}
    assert [tuple(x) for x in profile.profile_nulls(df, "t").collect()] == [("t", "a.b", 1), ("t", "c", 3)]
    assert [tuple(x) for x in profile.profile_columns(df, "t").select("position", "column_name").collect()] == [(1, "a.b"), (2, "c")]
    assert profile.profile_duplicates(df, "t").first()["duplicated_rows"] == 2
    assert rows(profile.profile_duplicates(df.limit(0), "t"))[0]["duplicated_rows"] == 0
