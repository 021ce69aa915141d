"""Dashboard datasets: unrounded lists, KPIs under period and state filters, cards and insights.

Only ``dash_kpis`` and ``dash_monthly_filtered`` (and the cards built on the former) follow the
filters; every other dataset covers all data.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarframe.functions.exact import MICROS_PER_DAY
from bazaarframe.functions.predicates import Bound, in_period, in_state, month_in_period
from bazaarframe.functions.text import brl_text, fixed_text, int_text
from bazaarframe.plans import metrics, reports
from bazaarframe.plans.cells import merged
from bazaarframe.tables import Tables

# Allowed range of the "categories displayed" control, and the delivery labels.
MIN_CATEGORIES, MAX_CATEGORIES, DEFAULT_CATEGORIES = 5, 20, 10
ON_TIME_LABEL, LATE_LABEL = "On time", "Late"


def plain_avg(total: Column, count: Column) -> Column:
    """Unrounded mean as a double: the exact decimal sum is divided once. NULL for no rows."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def _plain_pct(part: Column, whole: Column) -> Column:
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0))


def _mean_score() -> Column:
    return plain_avg(F.sum("review_score"), F.count("review_score"))


def dash_monthly(t: Tables) -> DataFrame:
    return reports.monthly_evolution(t)


def dash_monthly_times(t: Tables) -> DataFrame:
    """The monthly list with the month as a moment, as a time axis takes it; months that are not known come last."""
    return dash_monthly(t).withColumn("month", F.col("month").cast("timestamp_ntz"))


def dash_categories(t: Tables) -> DataFrame:
    return metrics.category_performance(t).orderBy(F.col("revenue").desc_nulls_first(), F.col("category").asc_nulls_last())


def dash_top_categories(t: Tables, n: int = DEFAULT_CATEGORIES) -> DataFrame:
    """The ``n`` leading categories, smallest first as the bar chart draws them."""
    if not MIN_CATEGORIES <= n <= MAX_CATEGORIES:
        raise ValueError(f"n must lie between {MIN_CATEGORIES} and {MAX_CATEGORIES}, got {n}")
    return reports.top_categories(t, n).orderBy(F.col("revenue").asc_nulls_last(), F.col("category").asc_nulls_last())


def _state_list(t: Tables) -> DataFrame:
    return reports.state_sales(t).select("customer_state", "orders", "customers", "gmv")


def dash_states(t: Tables) -> DataFrame:
    return _state_list(t).orderBy(F.col("gmv").desc_nulls_first(), F.col("customer_state").asc_nulls_last())


def dash_top_states(t: Tables, n: int = 10) -> DataFrame:
    return reports.top(_state_list(t), "gmv", "customer_state", n).orderBy(
        F.col("gmv").asc_nulls_last(), F.col("customer_state").asc_nulls_last()
    )


def dash_review_by_lateness(t: Tables) -> DataFrame:
    return (
        metrics.delivery_performance(t)
        .where(F.col("review_score").isNotNull())
        .groupBy("delivered_late")
        .agg(F.count("*").alias("orders"), _mean_score().alias("average_review_score"))
        .withColumn("delivery_status", F.when(F.col("delivered_late"), LATE_LABEL).otherwise(ON_TIME_LABEL))
        .orderBy(F.col("delivered_late").asc_nulls_last())
    )


def _plain_days(total_micros: Column, count: Column) -> Column:
    return plain_avg(total_micros, count) / F.lit(float(MICROS_PER_DAY))


def dash_delivery_kpis(t: Tables) -> DataFrame:
    return reports.delivery_facts(t).agg(
        F.count("*").alias("delivered_orders"),
        _plain_days(F.sum(F.col("micros").cast("decimal(20,0)")), F.count("micros")).alias("average_delivery_days"),
        _plain_pct(F.count_if("delivered_late"), F.count("*")).alias("late_delivery_percentage"),
    )


def dash_retention(t: Tables) -> DataFrame:
    repeated = F.count_if(F.col("orders") > 1)
    return metrics.customer_metrics(t).agg(
        F.count_if(F.col("orders") == 1).alias("one_time_customers"),
        repeated.alias("repeat_customers"),
        _plain_pct(repeated, F.count("*")).alias("repeat_customer_percentage"),
    )


def dash_state_options(t: Tables) -> DataFrame:
    return (
        metrics.order_metrics(t)
        .where(F.col("customer_state").isNotNull())
        .select("customer_state")
        .distinct()
        .orderBy("customer_state")
    )


def dash_default_period(t: Tables, full_last_month: bool = False) -> DataFrame:
    """First and last month of sales, the period shown before anyone picks one.

    The end is the *first* day of the last month, so the default KPIs leave out the rest of that
    month. ``full_last_month`` moves the end to the month's last day.
    """
    months = metrics.active_order_metrics(t).select(F.trunc("order_purchase_timestamp", "MM").alias("month"))
    last = F.max("month")
    return months.agg(
        F.min("month").alias("start_date"),
        (F.last_day(last) if full_last_month else last).alias("end_date"),
    )


def _bounds(t: Tables, start: Bound | None, end: Bound | None, full_last_month: bool) -> tuple[Bound, Bound]:
    """The given period, or scalar subqueries for the default one if either end is missing."""
    if start is not None and end is not None:
        return start, end
    period = dash_default_period(t, full_last_month)
    return period.select("start_date").scalar(), period.select("end_date").scalar()


def resolve_period(t: Tables, full_last_month: bool = False) -> tuple[date, date]:
    """The default period as two Python dates, for a display that needs them."""
    row = dash_default_period(t, full_last_month).first()
    return row["start_date"], row["end_date"]


def whole_months(start: Bound | None, end: Bound | None) -> bool:
    """Whether two dates are the first and the last day of months."""
    return isinstance(start, date) and isinstance(end, date) and start.day == 1 and (end + timedelta(days=1)).day == 1


def _filtered_orders(t: Tables, start: Bound, end: Bound, state: str | None) -> DataFrame:
    return metrics.active_order_metrics(t).where(in_period(start, end) & in_state(state))


def dash_kpis(
    t: Tables,
    start: Bound | None = None,
    end: Bound | None = None,
    state: str | None = None,
    full_last_month: bool = False,
) -> DataFrame:
    """KPIs of the chosen period and state; one row of zeros when nothing matches.

    A period of whole months is answered from stored cells, if there are any, without a look at the orders.
    """
    if "sales_cells" in t.derived and whole_months(start, end):
        chosen = t.derived["sales_cells"].where(F.col("month").between(F.lit(start), F.lit(end)) & in_state(state))
        return merged(chosen).select(
            F.col("orders").alias("total_orders"),
            F.col("customers").alias("unique_customers"),
            F.coalesce("product_value", F.lit(0)).alias("gmv"),
            F.coalesce(plain_avg(F.col("product_value"), F.col("orders")), F.lit(0.0)).alias("average_order_value"),
            F.coalesce(plain_avg(F.col("score_sum"), F.col("scored")), F.lit(0.0)).alias("average_review_score"),
        )
    start, end = _bounds(t, start, end, full_last_month)
    return _filtered_orders(t, start, end, state).agg(
        F.count("*").alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        F.coalesce(F.sum("product_value"), F.lit(0)).alias("gmv"),
        F.coalesce(plain_avg(F.sum("product_value"), F.count("product_value")), F.lit(0.0)).alias("average_order_value"),
        F.coalesce(_mean_score(), F.lit(0.0)).alias("average_review_score"),
    )


def dash_monthly_filtered(
    t: Tables,
    start: Bound | None = None,
    end: Bound | None = None,
    state: str | None = None,
    full_last_month: bool = False,
) -> DataFrame:
    """Monthly series of the chosen period and state.

    Rows are chosen by day, buckets by their first day: a start inside a month drops that month.
    """
    start, end = _bounds(t, start, end, full_last_month)
    month = F.trunc("order_purchase_timestamp", "MM").cast("timestamp_ntz").alias("month")
    return (
        _filtered_orders(t, start, end, state)
        .groupBy(month)
        .agg(
            F.count("*").alias("orders"),
            F.count_distinct("customer_unique_id").alias("customers"),
            F.coalesce(F.sum("product_value"), F.lit(0)).alias("gmv"),
            F.coalesce(plain_avg(F.sum("product_value"), F.count("product_value")), F.lit(0.0)).alias(
                "average_order_value"
            ),
            F.coalesce(F.sum("freight_value"), F.lit(0)).alias("freight_value"),
        )
        .where(month_in_period(start, end))
        .orderBy("month")
    )


def _retention_pct() -> Column:
    return _plain_pct(F.count_if(F.col("active_orders") > 1), F.count_if(F.col("active_orders") > 0))


def dash_cards(
    t: Tables,
    start: Bound | None = None,
    end: Bound | None = None,
    state: str | None = None,
    full_last_month: bool = False,
) -> DataFrame:
    """The KPI cards as rows (card, label, value); only the first five follow the filters."""
    start, end = _bounds(t, start, end, full_last_month)
    orders = F.sum("chosen_orders")
    people = F.count_if((F.col("chosen_orders") > 0) & F.col("customer_unique_id").isNotNull())
    score = F.coalesce(plain_avg(F.sum("chosen_score"), F.sum("chosen_scored")), F.lit(0.0))
    delivered = F.sum("delivered")
    # Card labels in display order.
    cards = [
        ("GMV", brl_text(F.coalesce(F.sum("chosen_value"), F.lit(0)))),
        ("Orders", int_text(F.coalesce(orders, F.lit(0)))),
        ("Customers", int_text(people)),
        ("Average Order", brl_text(F.coalesce(plain_avg(F.sum("chosen_value"), orders), F.lit(0.0)))),
        ("Average Review", F.concat(fixed_text(score), F.lit(" / 5"))),
        ("Delivered Orders", int_text(F.coalesce(delivered, F.lit(0)))),
        ("Average Delivery Time", F.concat(fixed_text(_plain_days(F.sum("micros"), F.sum("timed"))), F.lit(" days"))),
        ("Late Deliveries", F.concat(fixed_text(_plain_pct(F.sum("late"), delivered)), F.lit("%"))),
        ("One-time Customers", int_text(F.count_if(F.col("active_orders") == 1))),
        ("Repeat Customers", int_text(F.count_if(F.col("active_orders") > 1))),
        ("Repeat Customer Rate", F.concat(fixed_text(_retention_pct()), F.lit("%"))),
    ]
    texts = reports.person_facts(t, in_period(start, end) & in_state(state)).agg(
        *[text.alias(f"card_{i}") for i, (_, text) in enumerate(cards)]
    )
    rows = [
        F.struct(F.lit(i + 1).alias("card"), F.lit(label).alias("label"), F.col(f"card_{i}").alias("value"))
        for i, (label, _) in enumerate(cards)
    ]
    return texts.select(F.inline(F.array(*rows)))


def dash_insights(t: Tables) -> DataFrame:
    """The five headline findings as rows (insight, subject, value).

    The score gap is 0 when either the late or the on-time group has no scored order. Everything but the leading category
    comes from one pass over the order metrics: sums by person and state, rolled up to persons and to states in one
    aggregation, then to a single row.
    """
    sums = ("active_orders", "sold_value", "delivered", "late", "late_score", "late_scored", "on_time_score", "on_time_scored")
    facts = reports.person_facts(t, F.lit(True), "customer_state").withColumnRenamed("chosen_value", "sold_value")
    rolled = facts.groupingSets(
        [["customer_unique_id"], ["customer_state"]], "customer_unique_id", "customer_state"
    ).agg(F.grouping("customer_state").alias("person"), *[F.sum(c).alias(c) for c in sums])

    person = F.col("person") == 1

    def total(column: str) -> Column:
        return F.sum(F.when(person, F.col(column)))

    leading = F.struct(
        (-F.col("sold_value")).alias("less"), F.col("customer_state").isNull().alias("unknown"), F.col("customer_state").alias("state")
    )
    gap = plain_avg(total("on_time_score"), total("on_time_scored")) - plain_avg(total("late_score"), total("late_scored"))
    active = F.col("active_orders")
    figures = rolled.agg(
        F.min(F.when(~person & (active > 0), leading)).alias("state"),
        _plain_pct(F.count_if(person & (active > 1)), F.count_if(person & (active > 0))).alias("repeat"),
        _plain_pct(total("late"), total("delivered")).alias("late"),
        F.coalesce(gap, F.lit(0.0)).alias("gap"),
    )

    def finding(insight: str, subject: Column, value: Column) -> Column:
        return F.struct(F.lit(insight).alias("insight"), subject.alias("subject"), value.cast("double").alias("value"))

    nobody = F.lit(None).cast("string")
    figures = figures.select(
        F.inline(
            F.array_compact(
                F.array(
                    F.when(F.col("state").isNotNull(), finding("top_state", F.col("state.state"), -F.col("state.less"))),
                    finding("repeat_customer_percentage", nobody, F.col("repeat")),
                    finding("late_delivery_percentage", nobody, F.col("late")),
                    finding("review_difference", nobody, F.col("gap")),
                )
            )
        )
    )
    leader = reports.top(metrics.category_performance(t), "revenue", "category", 1).select(
        F.lit("top_category").alias("insight"), F.col("category").alias("subject"), F.col("revenue").cast("double").alias("value")
    )
    return leader.unionByName(figures)


def dash_insight_texts(t: Tables) -> DataFrame:
    """The findings as they are shown: (insight, subject, text), money in reais, shares in percent, the gap in points."""
    value, insight = F.col("value"), F.col("insight")
    text = (
        F.when(insight.startswith("top_"), brl_text(value))
        .when(insight.endswith("_percentage"), F.concat(fixed_text(value), F.lit("%")))
        .otherwise(fixed_text(value))
    )
    return dash_insights(t).select("insight", "subject", text.alias("text"))
