"""Registered queries: every dataset over the whole Parquet test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarframe.functions.text import brl_text, fixed_text, int_text
from bazaarframe.operators import checks, clean, profile
from bazaarframe.plans import dashboards as d
from bazaarframe.plans import metrics as m
from bazaarframe.plans import reports as r
from bazaarframe.plans.sql_surface import register_functions, register_views, run_query
from bazaarframe.session import size_for, tune
from bazaarframe.sources.snapshot import row_counts
from bazaarframe.sources.testdata import load_dirty_model, load_model
from bazaarframe.tables import Tables
from gate import load_queries

Query = Callable[[SparkSession, str], DataFrame]

# Filter settings of the registered dashboard queries: (start, end, state).
MID_MONTHS = (date(1996, 1, 15), date(1996, 12, 31), "AX")
EARLY_1996 = (date(1996, 1, 15), date(1996, 3, 10), None)
ALL_OF_1997 = (date(1997, 1, 1), date(1997, 12, 31), "All states")
WHOLE_MONTHS = (date(1996, 2, 1), date(1996, 11, 30), "AX")
NOTHING = (date(1970, 1, 1), date(1970, 1, 31), "AX")

# Orders, items and payments by state and month; the first over one state, the second over all.
SQL_STATE_MONTHS = """
    select customer_state, cast(date_trunc('month', order_purchase_timestamp) as date) as month,
           count(*) as orders, sum(items_count) as items, sum(payment_value) as paid
    from vw_order_metrics
    where order_status not in ('canceled', 'unavailable')
      and order_purchase_timestamp >= :start and order_purchase_timestamp < :stop
      {state}
    group by 1, 2
"""
SQL_FUNCTION_KPIS = "select * from kpis(:first, :last, :state)"
SQL_LATE_SHARE = """
    select customer_state, count(*) as delivered, count(*) filter (where delivered_late) as late
    from vw_delivery_performance group by customer_state
"""


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines report the same type."""
    return df.select(
        *[F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means of means to six digits: their last bits depend on the engine's division."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _clean(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(load_model(size_for(tune(spark), sf_dir), sf_dir)))


def _dirty(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(load_dirty_model(size_for(tune(spark), sf_dir), sf_dir)))


def _plain_query(query: Query) -> Query:
    return lambda spark, sf_dir: plain(query(spark, sf_dir))


def _loaded(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(load_queries.opened(spark, sf_dir)))


def _all_profiles(build: Callable[[DataFrame, str], DataFrame]) -> Callable[[Tables], DataFrame]:
    return lambda t: checks.union_all([build(df, name) for name, df in t.as_dict().items()])


def _in_views(text: str, params: dict | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_views(size_for(tune(spark), sf_dir), load_model(spark, sf_dir), base_tables=False)
        register_functions(spark)
        return plain(run_query(spark, text, params))

    return query


def _parameters(period) -> dict:
    first, last, state = period
    return {"start": first, "stop": last + timedelta(days=1), "state": state}


def _order_texts(t: Tables) -> DataFrame:
    """Amounts of every order as the dashboard prints them."""
    return m.order_metrics(t).select(
        "order_id",
        brl_text(F.col("product_value")).alias("value_text"),
        brl_text(F.col("product_value") * 100).alias("large_text"),
        brl_text(F.col("freight_value")).alias("freight_text"),
        int_text(F.col("payment_value")).alias("payment_text"),
        fixed_text(F.col("review_score")).alias("score_text"),
    )


def all_queries() -> dict[str, Query]:
    mid, early, year, none = MID_MONTHS, EARLY_1996, ALL_OF_1997, NOTHING
    return {
        # Views
        "order_metrics": _clean(lambda t: _rounded(m.order_metrics(t), "review_score")),
        "monthly_sales": _clean(m.monthly_sales),
        "category_performance": _clean(m.category_performance),
        "customer_metrics": _clean(m.customer_metrics),
        "seller_performance": _clean(m.seller_performance),
        "delivery_performance": _clean(lambda t: _rounded(m.delivery_performance(t), "review_score")),
        # Business queries
        "executive_kpis": _clean(r.executive_kpis),
        "monthly_evolution": _clean(r.monthly_evolution),
        "top_categories": _clean(r.top_categories),
        "top_states": _clean(r.top_states),
        "top_sellers": _clean(r.top_sellers),
        "delivery_summary": _clean(r.delivery_summary),
        "review_by_lateness": _clean(r.review_by_lateness),
        "repeat_customers": _clean(r.repeat_customers),
        "freight_impact": _clean(r.freight_impact),
        "top_customers": _clean(r.top_customers),
        "report_top_categories": _clean(r.report_top_categories),
        "console_report": _clean(r.console_report),
        # Quality checks
        "dq_orphan_orders": _dirty(checks.orphan_orders),
        "dq_orphan_items_orders": _dirty(checks.orphan_items_orders),
        "dq_orphan_items_products": _dirty(checks.orphan_items_products),
        "dq_orphan_items_sellers": _dirty(checks.orphan_items_sellers),
        "dq_orphan_payments": _dirty(checks.orphan_payments),
        "dq_orphan_reviews": _dirty(checks.orphan_reviews),
        "dq_invalid_review_scores": _dirty(checks.invalid_review_scores),
        "dq_invalid_item_values": _dirty(checks.invalid_item_values),
        "dq_invalid_payments": _dirty(checks.invalid_payments),
        "dq_untranslated_categories": _dirty(checks.untranslated_categories),
        "dq_pk_nulls": _dirty(checks.all_pk_nulls),
        "dq_pk_duplicates": _dirty(checks.all_pk_duplicates),
        "dq_clean_pk_duplicates": _clean(checks.all_pk_duplicates),
        "constraint_violations": _dirty(checks.constraint_violations),
        "clean_constraint_violations": _clean(checks.constraint_violations),
        "profile_shape": _dirty(_all_profiles(profile.profile_shape)),
        "profile_nulls": _dirty(_all_profiles(profile.profile_nulls)),
        "profile_duplicates": _dirty(lambda t: profile.all_duplicates(t.as_dict())),
        "row_counts": _clean(row_counts),
        "clean_customers": _dirty(lambda t: clean.clean_text_columns(t.customers)),
        # Dashboard
        "dash_monthly": _clean(d.dash_monthly),
        "dash_categories": _clean(d.dash_categories),
        "dash_top_categories": _clean(d.dash_top_categories),
        "dash_top_5_categories": _clean(lambda t: d.dash_top_categories(t, 5)),
        "dash_states": _clean(d.dash_states),
        "dash_top_states": _clean(d.dash_top_states),
        "dash_review_by_lateness": _clean(lambda t: _rounded(d.dash_review_by_lateness(t), "average_review_score")),
        "dash_delivery_kpis": _clean(d.dash_delivery_kpis),
        "dash_retention": _clean(d.dash_retention),
        "dash_state_options": _clean(d.dash_state_options),
        "dash_kpis": _clean(lambda t: _rounded(d.dash_kpis(t, *mid), "average_review_score")),
        "dash_kpis_all_states": _clean(lambda t: _rounded(d.dash_kpis(t, *year), "average_review_score")),
        "dash_kpis_nothing": _clean(lambda t: _rounded(d.dash_kpis(t, *none), "average_review_score")),
        "dash_kpis_default": _clean(lambda t: _rounded(d.dash_kpis(t), "average_review_score")),
        "dash_kpis_full_last_month": _clean(
            lambda t: _rounded(d.dash_kpis(t, full_last_month=True), "average_review_score")
        ),
        "dash_monthly_filtered": _clean(lambda t: d.dash_monthly_filtered(t, *early)),
        "dash_monthly_filtered_state": _clean(lambda t: d.dash_monthly_filtered(t, *mid)),
        "dash_monthly_default": _clean(d.dash_monthly_filtered),
        "dash_default_period": _clean(d.dash_default_period),
        "dash_cards": _clean(lambda t: d.dash_cards(t, *mid)),
        "dash_cards_default": _clean(d.dash_cards),
        "dash_insights": _clean(lambda t: _rounded(d.dash_insights(t), "value")),
        "order_texts": _clean(_order_texts),
        "dash_insight_texts": _clean(d.dash_insight_texts),
        "dash_monthly_times": _clean(d.dash_monthly_times),
        # A snapshot with derived tables
        "stored_dash_kpis": _loaded(lambda t: _rounded(d.dash_kpis(t, *mid), "average_review_score")),
        "stored_review_by_lateness": _loaded(r.review_by_lateness),
        "cells_monthly_sales": _loaded(m.monthly_sales),
        "cells_states": _loaded(d.dash_states),
        "cells_executive_kpis": _loaded(r.executive_kpis),
        "cells_kpis_all_states": _loaded(lambda t: _rounded(d.dash_kpis(t, *year), "average_review_score")),
        "cells_kpis_state": _loaded(lambda t: _rounded(d.dash_kpis(t, *WHOLE_MONTHS), "average_review_score")),
        # The load
        **{name: _plain_query(query) for name, query in load_queries.QUERIES.items()},
        # SQL surface
        "sql_kpis": _in_views(SQL_STATE_MONTHS.format(state="and customer_state = :state"), _parameters(mid)),
        "sql_kpis_all_states": _in_views(SQL_STATE_MONTHS.format(state=""), _parameters(year)),
        "sql_late_share": _in_views(SQL_LATE_SHARE),
        "sql_function_kpis": _in_views(SQL_FUNCTION_KPIS, {"first": mid[0], "last": mid[1], "state": mid[2]}),
        "sql_function_late_share": _in_views("select * from late_share(10)"),
    }
