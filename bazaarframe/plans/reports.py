"""Business queries: the ten ranked or single-row results and the console report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarframe.functions.exact import (
    MICROS_PER_DAY,
    SCORE_SCALE,
    duration_micros,
    exact_avg,
    exact_pct,
)
from bazaarframe.functions.predicates import is_active
from bazaarframe.functions.text import comma_text, fixed_text
from bazaarframe.plans import metrics
from bazaarframe.plans.cells import merged
from bazaarframe.tables import Tables


def mean_of_scores() -> Column:
    """Mean of the per-order mean scores, rounded to two digits."""
    return exact_avg(F.sum("review_score"), F.count("review_score"), total_scale=SCORE_SCALE)


def top(df: DataFrame, measure: str, key: str, n: int = 10) -> DataFrame:
    """Largest ``n`` rows by ``measure``; equal values are ordered by ``key``.

    Runs as a per-partition top-n followed by a merge of n rows per partition.
    """
    return df.orderBy(F.col(measure).desc_nulls_first(), F.col(key).asc_nulls_last()).limit(n)


def executive_kpis(t: Tables) -> DataFrame:
    if "sales_cells" in t.derived:
        return merged(t.derived["sales_cells"]).select(
            F.col("orders").alias("total_orders"),
            F.col("customers").alias("unique_customers"),
            F.col("product_value").alias("gmv"),
            exact_avg(F.col("product_value"), F.col("orders")).alias("average_order_value"),
            exact_avg(F.col("score_sum"), F.col("scored"), total_scale=SCORE_SCALE).alias("average_review_score"),
        )
    return metrics.active_order_metrics(t).agg(
        F.count("*").alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        F.sum("product_value").alias("gmv"),
        exact_avg(F.sum("product_value"), F.count("product_value")).alias("average_order_value"),
        mean_of_scores().alias("average_review_score"),
    )


def monthly_evolution(t: Tables) -> DataFrame:
    return metrics.monthly_sales(t).orderBy(F.col("month").asc_nulls_last())


def top_categories(t: Tables, n: int = 10) -> DataFrame:
    return top(metrics.category_performance(t), "revenue", "category", n)


def state_sales(t: Tables) -> DataFrame:
    """Sales per customer state, the unknown state included. Stored cells answer it alone."""
    if "sales_cells" in t.derived:
        return merged(t.derived["sales_cells"], "customer_state").select(
            "customer_state",
            "orders",
            "customers",
            F.col("product_value").alias("gmv"),
            exact_avg(F.col("product_value"), F.col("orders")).alias("average_order_value"),
        )
    return (
        metrics.active_order_metrics(t)
        .groupBy("customer_state")
        .agg(
            F.count("*").alias("orders"),
            F.count_distinct("customer_unique_id").alias("customers"),
            F.sum("product_value").alias("gmv"),
            exact_avg(F.sum("product_value"), F.count("product_value")).alias("average_order_value"),
        )
    )


def top_states(t: Tables, n: int = 10) -> DataFrame:
    return top(state_sales(t), "gmv", "customer_state", n)


def top_sellers(t: Tables, n: int = 10) -> DataFrame:
    return top(metrics.seller_performance(t), "revenue", "seller_id", n)


def delivery_facts(t: Tables) -> DataFrame:
    """Delivered orders with their duration in whole microseconds."""
    return metrics.delivery_performance(t).withColumn(
        "micros", duration_micros(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    )


def _mean_days(total_micros: Column, count: Column) -> Column:
    """Mean of durations in days, rounded to two digits from the exact sum."""
    per_day = F.lit(MICROS_PER_DAY).cast("decimal(14,0)")
    return exact_avg(total_micros, count * per_day, total_scale=0)


def delivery_summary(t: Tables) -> DataFrame:
    """Delivered orders, their mean duration and the share that came late.

    Orders without a purchase time count as delivered but have no duration.
    """
    return delivery_facts(t).agg(
        F.count("*").alias("delivered_orders"),
        _mean_days(F.sum(F.col("micros").cast("decimal(20,0)")), F.count("micros")).alias("average_delivery_days"),
        exact_pct(F.count_if("delivered_late"), F.count("*")).alias("late_delivery_percentage"),
    )


def review_by_lateness(t: Tables) -> DataFrame:
    return (
        metrics.delivery_performance(t)
        .where(F.col("review_score").isNotNull())
        .groupBy("delivered_late")
        .agg(F.count("*").alias("orders"), mean_of_scores().alias("average_review_score"))
    )


def repeat_customers(t: Tables) -> DataFrame:
    repeated = F.count_if(F.col("orders") > 1)
    return metrics.customer_metrics(t).agg(
        F.count_if(F.col("orders") == 1).alias("one_time_customers"),
        repeated.alias("repeat_customers"),
        exact_pct(repeated, F.count("*")).alias("repeat_customer_percentage"),
    )


def freight_impact(t: Tables) -> DataFrame:
    product, freight = F.sum("product_value"), F.sum("freight_value")
    return metrics.active_order_metrics(t).agg(
        product.alias("product_value"),
        freight.alias("freight_value"),
        exact_pct(freight, product, part_scale=2).alias("freight_to_product_percentage"),
    )


def top_customers(t: Tables, n: int = 10) -> DataFrame:
    people = metrics.customer_metrics(t).select("customer_unique_id", "orders", "total_spent", "average_order_value")
    return top(people, "total_spent", "customer_unique_id", n)


def report_top_categories(t: Tables, n: int = 10) -> DataFrame:
    """The leading categories with their position; the window sees only ``n`` rows."""
    leaders = top_categories(t, n).select("category", "orders", "items_sold", "revenue")
    position = F.row_number().over(Window.orderBy(F.col("revenue").desc_nulls_first(), F.col("category").asc_nulls_last()))
    return leaders.select(position.alias("position"), "*")


def _sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def person_facts(t: Tables, chosen: Column, *also: str) -> DataFrame:
    """One row per person (and ``also`` more columns) with the sums that the KPI, delivery and retention figures need.

    All three figures come from a single pass over the order metrics: distinct customers turn into
    a count of persons, so nothing has to be scanned twice or joined back together.
    """
    active = is_active()
    chosen = active & chosen
    delivered = F.col("order_delivered_customer_date").isNotNull()
    late, scored = F.col("delivered_late"), F.col("review_score").isNotNull()
    orders = metrics.order_metrics(t).withColumn(
        "micros",
        duration_micros(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")).cast(
            "decimal(20,0)"
        ),
    )
    return orders.groupBy("customer_unique_id", *also).agg(
        F.count_if(active).alias("active_orders"),
        F.count_if(chosen).alias("chosen_orders"),
        _sum_if(chosen, F.col("product_value")).alias("chosen_value"),
        _sum_if(chosen, F.col("review_score")).alias("chosen_score"),
        F.count_if(chosen & scored).alias("chosen_scored"),
        F.count_if(delivered).alias("delivered"),
        F.count_if(delivered & late).alias("late"),
        _sum_if(delivered, F.col("micros")).alias("micros"),
        F.count_if(delivered & F.col("micros").isNotNull()).alias("timed"),
        _sum_if(delivered & late, F.col("review_score")).alias("late_score"),
        F.count_if(delivered & late & scored).alias("late_scored"),
        _sum_if(delivered & ~late, F.col("review_score")).alias("on_time_score"),
        F.count_if(delivered & ~late & scored).alias("on_time_scored"),
    )


def console_report(t: Tables) -> DataFrame:
    """The printed report as rows (section, line, text), to be ordered by the reader.

    Its three blocks of figures come from one pass over the order metrics.
    """
    days = _mean_days(F.sum("micros"), F.sum("timed"))
    repeated, people = F.count_if(F.col("active_orders") > 1), F.count_if(F.col("active_orders") > 0)
    orders, value = F.sum("chosen_orders"), F.sum("chosen_value")
    score = exact_avg(F.sum("chosen_score"), F.sum("chosen_scored"), total_scale=SCORE_SCALE)
    customers = F.count_if((F.col("chosen_orders") > 0) & F.col("customer_unique_id").isNotNull())
    # Section names and line labels of the report.
    sections = {
        "EXECUTIVE KPIs": [
            ("Orders: ", comma_text(F.coalesce(orders, F.lit(0)))),
            ("Unique customers: ", comma_text(customers)),
            ("GMV: R$ ", comma_text(value, 2)),
            ("Average order value: R$ ", comma_text(exact_avg(value, orders), 2)),
            ("Average review score: ", fixed_text(score)),
        ],
        "DELIVERY": [
            ("Delivered orders: ", comma_text(F.coalesce(F.sum("delivered"), F.lit(0)))),
            ("Average delivery time: ", F.concat(fixed_text(days), F.lit(" days"))),
            ("Late deliveries: ", F.concat(fixed_text(exact_pct(F.sum("late"), F.sum("delivered"))), F.lit("%"))),
        ],
        "CUSTOMERS": [
            ("One-time customers: ", comma_text(F.count_if(F.col("active_orders") == 1))),
            ("Repeat customers: ", comma_text(repeated)),
            ("Repeat customer rate: ", F.concat(fixed_text(exact_pct(repeated, people)), F.lit("%"))),
        ],
    }
    lines = [(name, i, label, text) for name, entries in sections.items() for i, (label, text) in enumerate(entries, 1)]
    figures = person_facts(t, F.lit(True)).agg(
        *[F.concat(F.lit(label), text).alias(f"l{n}") for n, (_, _, label, text) in enumerate(lines)]
    )
    rows = ", ".join(f"'{name}', {i}, l{n}" for n, (name, i, _, _) in enumerate(lines))
    figures = figures.selectExpr(f"stack({len(lines)}, {rows}) as (section, line, text)")
    categories = report_top_categories(t).select(
        F.lit("TOP 10 CATEGORIES").alias("section"),
        F.col("position").alias("line"),
        F.concat(
            F.lpad(F.col("position").cast("string"), 2, " "),
            F.lit(". "),
            _pad_right(F.col("category"), 35),
            F.lit(" R$ "),
            _pad_left(comma_text(F.col("revenue"), 2), 12),
        ).alias("text"),
    )
    return figures.unionByName(categories)


def _pad_right(text: Column, width: int) -> Column:
    """Pad to ``width``; longer text is kept whole."""
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def _pad_left(text: Column, width: int) -> Column:
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))
