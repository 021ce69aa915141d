"""Sales cells give exact numbers of persons for any months and states; one pass over each table checks all its rules."""

from datetime import date

import pytest

from bazaarframe.operators import checks
from bazaarframe.operators.numbering import numbered
from bazaarframe.plans import cells, dashboards as d, derived, metrics as m, reports as r
from bazaarframe.plans.sql_surface import register_functions, register_views
from bazaarframe.sources.testdata import load_dirty_model, load_model


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def model(spark):
    return load_model(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def stored(model):
    return derived.store(model, "order_metrics", "sales_cells")


@pytest.fixture(scope="module")
def stored_shop(shop):
    return derived.store(shop, "sales_cells")


def test_merged_cells_equal_distinct_counts(model, stored):
    for build in (m.monthly_sales, r.state_sales, r.executive_kpis, r.top_states):
        assert build(stored).schema == build(model).schema
        assert rows(build(stored)) == rows(build(model))
    for period in [
        (date(1992, 1, 1), date(1998, 12, 31), None),
        (date(1996, 2, 1), date(1996, 2, 29), "AX"),
        (date(1996, 12, 1), date(1997, 1, 31), "All states"),
        (date(1970, 1, 1), date(1970, 1, 31), None),
    ]:
        assert d.whole_months(*period[:2])
        assert rows(d.dash_kpis(stored, *period)) == rows(d.dash_kpis(model, *period))
        assert all("sales_cells" in f for f in d.dash_kpis(stored, *period).inputFiles())


def test_parts_of_months_read_the_orders(model, stored):
    part = (date(1996, 2, 2), date(1996, 4, 30), None)
    assert rows(d.dash_kpis(stored, *part)) == rows(d.dash_kpis(model, *part))
    assert not any("sales_cells" in f for f in d.dash_kpis(stored, *part).inputFiles())


def test_cells_of_unknown_persons_months_and_states(shop, stored_shop):
    for build in (m.monthly_sales, r.state_sales, r.executive_kpis):
        assert rows(build(stored_shop)) == rows(build(shop))
    unknown = stored_shop.derived["sales_cells"].where("month is null or customer_state is null")
    assert unknown.count() > 0


def test_cells_of_no_orders(make_tables):
    empty = make_tables()
    assert rows(cells.merged(derived.store(empty, "sales_cells").derived["sales_cells"])) == [(0, 0, 0, None, None, None)]


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(1000).selectExpr("id % 7 as a", "id as b").repartition(6)
    found = [(x["a"], x["b"], x["n"]) for x in numbered(df, "n", "a", "b").collect()]
    assert sorted(found) == [(a, b, i + 1) for i, (a, b) in enumerate(sorted((x % 7, x) for x in range(1000)))]


def test_insights_read_the_order_metrics_once(stored):
    assert plan(d.dash_insights(stored)).count("review_score#") > 0
    scans = plan(d.dash_insights(stored)).count("Relation [order_id")
    with_joins = plan(d.dash_insights(derived.store(stored.without_derived(), "order_metrics")))
    assert with_joins.count("delivered_late") >= 1 and scans <= 4
    assert {x["insight"] for x in d.dash_insight_texts(stored).collect()} == {
        "top_category", "top_state", "repeat_customer_percentage", "late_delivery_percentage", "review_difference",
    }


def test_insights_without_sales(make_tables):
    assert rows(d.dash_insights(make_tables())) == [
        ("late_delivery_percentage", None, None),
        ("repeat_customer_percentage", None, None),
        ("review_difference", None, 0.0),
    ]


def test_constraints_read_each_table_once(spark):
    t = load_dirty_model(spark, "/root/testdata/sf0.001")
    physical = checks.constraint_violations(t)._jdf.queryExecution().executedPlan().toString()
    items = physical.count("FileScan parquet [l_orderkey")
    assert items == 1 and "Join" not in physical.split("FileScan parquet [l_orderkey")[0][-2000:]


def test_statuses_beyond_the_usual_ones(shop):
    more = shop.orders.selectExpr(
        *[
            "case order_id when 'o1' then 'approved' when 'o2' then null when 'o3' then 'invoiced' else order_status end as order_status"
            if c == "order_status"
            else c
            for c in shop.orders.columns
        ]
    )
    t = shop.with_tables(orders=more)
    # 'not in' keeps every status but two, and drops an unknown one
    assert {x["order_id"] for x in m.active_order_metrics(t).collect()} == {"o1", "o3", "o4"}
    assert m.order_metrics(t).where("order_id = 'o2'").count() == 1


def test_table_functions(spark, model):
    register_views(spark, model)
    register_functions(spark)
    found = spark.sql("select * from kpis(date '1996-01-15', date '1996-12-31', 'AX')")
    wanted = d.dash_kpis(model, date(1996, 1, 15), date(1996, 12, 31), "AX")
    assert rows(found) == rows(wanted.select("total_orders", "unique_customers", "gmv"))
    every = spark.sql("select total_orders from kpis(date '1996-01-01', date '1996-12-31', null)").first()[0]
    assert every == d.dash_kpis(model, date(1996, 1, 1), date(1996, 12, 31)).first()["total_orders"]
    assert "CartesianProduct" not in plan(found)


def test_bitmaps_are_built_once_for_each_cell(model):
    physical = cells.sales_cells(model)._jdf.queryExecution().executedPlan().toString()
    assert physical.count("bitmap_construct_agg") == 2  # where the rows of a cell have met, its two halves in one stage
    partial = next(line for line in physical.splitlines() if "partial_bitmap_construct_agg" in line)
    above = physical[: physical.index(partial)]
    assert "Exchange" not in above, above


def test_rules_of_one_row_count_each_and_keys_of_two_columns_stay_apart(make_tables):
    t = make_tables(
        order_items=[dict(order_id="o1", order_item_id=11), dict(order_id="o11", order_item_id=1), dict(order_id="o", order_item_id=None)],
    )
    found = {(x["table_name"], x["rule"]): x["violations"] for x in checks.constraint_violations(t).collect() if x["violations"]}
    assert found == {
        ("order_items", "not null order_item_id"): 1,
        **{("order_items", f"not null {c}"): 3 for c in ("product_id", "seller_id", "price", "freight_value")},
        ("order_items", "reference order_id"): 3,
    }


def test_marks_of_all_checks_run_as_compiled_code(shop):
    physical = checks.constraint_violations(shop)._jdf.queryExecution().executedPlan().toString()
    assert "inline(array(" in physical and "lambdafunction" not in physical
