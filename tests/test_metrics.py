from datetime import date, datetime
from decimal import Decimal

import pytest

from bazaarframe.plans import dashboards as d
from bazaarframe.plans import metrics as m
from bazaarframe.plans import reports as r
from bazaarframe.plans.sql_surface import register_views, run_query
from tests.conftest import rows


def D(text):
    return Decimal(text)


def test_order_metrics_does_not_fan_out(shop):
    got = {x["order_id"]: x for x in rows(m.order_metrics(shop))}
    assert sorted(got) == ["o1", "o2", "o3", "o4", "o5", "o6"]  # o7 has no customer
    first = got["o1"]
    assert (first["items_count"], first["product_value"], first["freight_value"], first["payment_value"]) == (
        2,
        D("15.01"),
        D("3.00"),
        D("18.01"),
    )
    assert first["review_score"] == D("1.5")
    empty = got["o3"]
    assert (empty["items_count"], empty["product_value"], empty["payment_value"], empty["review_score"]) == (0, 0, 0, None)


def test_late_needs_a_delivery_after_the_estimate(shop):
    late = {x["order_id"]: x["delivered_late"] for x in rows(m.order_metrics(shop))}
    assert late == {"o1": True, "o2": False, "o3": False, "o4": False, "o5": True, "o6": False}


def test_monthly_sales(shop):
    got = {x["month"]: x for x in rows(m.monthly_sales(shop))}
    assert set(got) == {date(2020, 1, 1), date(2020, 2, 1), None}
    january = got[date(2020, 1, 1)]
    assert (january["orders"], january["customers"], january["gmv"]) == (2, 1, D("35.01"))
    assert january["average_order_value"] == D("17.51")  # 17.505
    assert got[date(2020, 2, 1)]["gmv"] == 0  # canceled and unavailable orders are left out
    assert [x["month"] for x in r.monthly_evolution(shop).collect()] == [date(2020, 1, 1), date(2020, 2, 1), None]


def test_category_performance(shop):
    got = {x["category"]: x for x in rows(m.category_performance(shop))}
    assert set(got) == {"books", "raro", "unknown"}
    books = got["books"]
    assert (books["orders"], books["items_sold"], books["revenue"]) == (1, 2, D("15.01"))
    assert books["average_item_price"] == D("7.51")


def test_seller_performance_leaves_out_idle_sellers(shop):
    got = {x["seller_id"]: x for x in rows(m.seller_performance(shop))}
    assert set(got) == {"s1", "s2"}
    assert (got["s1"]["orders"], got["s1"]["items_sold"], got["s1"]["revenue"]) == (2, 3, D("22.01"))
    assert got["s2"]["revenue"] == D("20.00")


def test_customer_metrics(shop):
    got = {x["customer_unique_id"]: x for x in rows(m.customer_metrics(shop))}
    assert set(got) == {"u1", "u2", "u3"}
    assert (got["u1"]["orders"], got["u1"]["total_spent"], got["u1"]["average_order_value"]) == (2, D("35.01"), D("17.51"))
    assert got["u1"]["first_purchase"] == datetime(2020, 1, 10, 10)
    assert got["u3"]["first_purchase"] is None


def test_delivery_performance_keeps_canceled_orders(shop):
    got = {x["order_id"]: x for x in rows(m.delivery_performance(shop))}
    assert set(got) == {"o1", "o2", "o4", "o5"}
    assert got["o1"]["delivery_days"] == 10.0
    assert got["o5"]["delivery_days"] == 2.5
    assert got["o4"]["delivery_days"] is None


def test_invariants(shop):
    active = m.active_order_metrics(shop).count()
    kpis = r.executive_kpis(shop).first()
    assert sum(x["orders"] for x in rows(m.monthly_sales(shop))) == active == kpis["total_orders"]
    assert sum(x["gmv"] for x in rows(m.monthly_sales(shop))) == kpis["gmv"]
    by_category = sum(x["revenue"] for x in rows(m.category_performance(shop)))
    by_seller = sum(x["revenue"] for x in rows(m.seller_performance(shop)))
    assert by_category == by_seller
    repeat = r.repeat_customers(shop).first()
    assert repeat["one_time_customers"] + repeat["repeat_customers"] == m.customer_metrics(shop).count()


def test_business_queries(shop):
    assert r.executive_kpis(shop).first().asDict() == {
        "total_orders": 4,
        "unique_customers": 3,
        "gmv": D("42.01"),
        "average_order_value": D("10.50"),
        "average_review_score": D("3.25"),  # mean of 1.5 and 5, not of three reviews
    }
    assert r.delivery_summary(shop).first().asDict() == {
        "delivered_orders": 4,
        "average_delivery_days": D("5.50"),  # 10, 4.0000000000116 and 2.5 days
        "late_delivery_percentage": D("50.00"),
    }
    assert rows(r.review_by_lateness(shop), "delivered_late") == [
        {"delivered_late": False, "orders": 1, "average_review_score": D("5.00")},
        {"delivered_late": True, "orders": 2, "average_review_score": D("2.75")},
    ]
    assert r.repeat_customers(shop).first().asDict() == {
        "one_time_customers": 2,
        "repeat_customers": 1,
        "repeat_customer_percentage": D("33.33"),
    }
    assert r.freight_impact(shop).first().asDict() == {
        "product_value": D("42.01"),
        "freight_value": D("6.50"),
        "freight_to_product_percentage": D("15.47"),
    }


def test_ties_are_ordered_by_key(make_tables):
    n = 15
    t = make_tables(
        customers=[dict(customer_id=f"c{i:02}", customer_unique_id=f"u{i:02}", customer_state="SP") for i in range(n)],
        orders=[dict(order_id=f"o{i:02}", customer_id=f"c{i:02}", order_status="delivered") for i in range(n)],
        sellers=[dict(seller_id=f"s{i:02}") for i in range(n)],
        products=[dict(product_id="p", product_category_name="x")],
        order_items=[
            dict(order_id=f"o{i:02}", order_item_id=1, product_id="p", seller_id=f"s{i:02}", price="5.00", freight_value="0.00")
            for i in reversed(range(n))
        ],
    )
    assert [x["customer_unique_id"] for x in r.top_customers(t).collect()] == [f"u{i:02}" for i in range(10)]
    assert [x["seller_id"] for x in r.top_sellers(t).collect()] == [f"s{i:02}" for i in range(10)]
    assert [x["position"] for x in r.report_top_categories(t).collect()] == [1]


def test_unknown_state_is_a_group(shop):
    got = {x["customer_state"]: x["gmv"] for x in rows(r.top_states(shop))}
    assert got == {"RJ": D("35.01"), "SP": 0, None: D("7.00")}


def test_ratios_without_denominator_are_null(make_tables):
    nothing = make_tables()
    assert r.freight_impact(nothing).first()["freight_to_product_percentage"] is None
    assert r.repeat_customers(nothing).first().asDict() == {
        "one_time_customers": 0,
        "repeat_customers": 0,
        "repeat_customer_percentage": None,
    }
    assert r.delivery_summary(nothing).first()["average_delivery_days"] is None
    assert d.dash_retention(nothing).first()["repeat_customer_percentage"] is None


def test_dash_kpis(shop):
    got = d.dash_kpis(shop, date(2020, 1, 1), date(2020, 1, 31)).first()
    assert (got["total_orders"], got["unique_customers"], got["gmv"]) == (2, 1, D("35.01"))
    assert got["average_order_value"] == 35.01 / 2
    assert got["average_review_score"] == 3.25
    assert d.dash_kpis(shop, "2020-01-01", "2020-01-30").first()["total_orders"] == 1
    assert d.dash_kpis(shop, "2020-01-01", "2020-02-28", "SP").first()["total_orders"] == 1
    assert d.dash_kpis(shop, "2020-01-01", "2020-02-28", "All states").first()["total_orders"] == 3


def test_empty_filter_gives_zeros_and_no_months(shop):
    nobody = d.dash_kpis(shop, "1990-01-01", "1990-01-31").first().asDict()
    assert nobody == {
        "total_orders": 0,
        "unique_customers": 0,
        "gmv": 0,
        "average_order_value": 0.0,
        "average_review_score": 0.0,
    }
    assert d.dash_monthly_filtered(shop, "1990-01-01", "1990-01-31").count() == 0


def test_start_inside_a_month_drops_its_bucket_but_not_its_kpis(shop):
    period = date(2020, 1, 5), date(2020, 2, 28)
    assert [x["month"] for x in d.dash_monthly_filtered(shop, *period).collect()] == [datetime(2020, 2, 1)]
    assert d.dash_kpis(shop, *period).first()["total_orders"] == 3


def test_default_period_ends_on_the_first_day_of_the_last_month(shop):
    assert d.resolve_period(shop) == (date(2020, 1, 1), date(2020, 2, 1))
    assert d.resolve_period(shop, full_last_month=True) == (date(2020, 1, 1), date(2020, 2, 29))
    assert d.dash_kpis(shop).first()["total_orders"] == 3
    assert d.dash_kpis(shop, start=date(2020, 2, 1)).first()["total_orders"] == 3  # one date alone is ignored


def test_dash_top_categories(shop):
    assert [x["category"] for x in d.dash_categories(shop).collect()] == ["raro", "books", "unknown"]
    assert [x["category"] for x in d.dash_top_categories(shop, 5).collect()] == ["unknown", "books", "raro"]
    for n in (4, 21):
        with pytest.raises(ValueError):
            d.dash_top_categories(shop, n)


def test_dash_lists(shop):
    assert [x["customer_state"] for x in d.dash_states(shop).collect()] == ["RJ", None, "SP"]
    assert [x["customer_state"] for x in d.dash_top_states(shop).collect()] == ["SP", None, "RJ"]
    assert [x["customer_state"] for x in d.dash_state_options(shop).collect()] == ["RJ", "SP"]
    assert [(x["delivery_status"], x["orders"]) for x in d.dash_review_by_lateness(shop).collect()] == [("On time", 1), ("Late", 2)]


def test_cards_equal_the_separate_queries(shop):
    cards = {x["label"]: x["value"] for x in d.dash_cards(shop, "2020-01-01", "2020-01-31").collect()}
    assert cards == {
        "GMV": "R$ 35,01",
        "Orders": "2",
        "Customers": "1",
        "Average Order": "R$ 17,50",  # the double 17.505 lies below the half cent
        "Average Review": "3.25 / 5",
        "Delivered Orders": "4",
        "Average Delivery Time": "5.50 days",
        "Late Deliveries": "50.00%",
        "One-time Customers": "2",
        "Repeat Customers": "1",
        "Repeat Customer Rate": "33.33%",
    }


def test_insights(shop, make_tables):
    got = {x["insight"]: (x["subject"], x["value"]) for x in d.dash_insights(shop).collect()}
    assert got["top_category"] == ("raro", 20.0)
    assert got["top_state"] == ("RJ", 35.01)
    assert got["late_delivery_percentage"] == (None, 50.0)
    assert got["review_difference"] == (None, 5.0 - 2.75)
    assert got["repeat_customer_percentage"][1] == pytest.approx(100 / 3)
    on_time_only = make_tables(
        customers=[dict(customer_id="c", customer_unique_id="u")],
        orders=[dict(order_id="o", customer_id="c", order_status="delivered", order_delivered_customer_date="2020-01-01")],
        order_reviews=[dict(review_id="r", order_id="o", review_score=5)],
    )
    lonely = {x["insight"]: x["value"] for x in d.dash_insights(on_time_only).collect()}
    assert lonely["review_difference"] == 0


def test_console_report(shop):
    got = {(x["section"], x["line"]): x["text"] for x in r.console_report(shop).collect()}
    assert got["EXECUTIVE KPIs", 3] == "GMV: R$ 42.01"
    assert got["DELIVERY", 2] == "Average delivery time: 5.50 days"
    assert got["TOP 10 CATEGORIES", 1] == f" 1. {'raro':<35} R$ {'20.00':>12}"
    assert len(got) == 5 + 3 + 3 + 3


def test_stored_order_metrics_stand_in_for_the_joins(shop):
    stored = m.store_order_metrics(shop)
    for build in (r.executive_kpis, r.top_customers, r.delivery_summary, d.dash_cards, d.dash_insights):
        assert sorted(map(str, build(stored).collect())) == sorted(map(str, build(shop).collect()))
    plan = r.executive_kpis(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_report_without_data(make_tables):
    got = {(x["section"], x["line"]): x["text"] for x in r.console_report(make_tables()).collect()}
    assert got["EXECUTIVE KPIs", 1] == "Orders: 0"
    assert got["CUSTOMERS", 2] == "Repeat customers: 0"


def test_sql_views(spark, shop):
    names = register_views(spark, shop)
    assert len(names) == 14
    text = """select count(*) as n from vw_order_metrics
              where order_purchase_timestamp >= :first_day and customer_state = :state"""
    got = run_query(spark, text, {"first_day": date(2020, 1, 15), "state": "RJ"})
    assert got.first()["n"] == 1
    assert run_query(spark, "select * from vw_monthly_sales order by month nulls last").columns == [
        "month",
        "orders",
        "customers",
        "gmv",
        "average_order_value",
        "freight_value",
    ]
    assert run_query(spark, "select count(*) as n from order_items").first()["n"] == 5
