"""The SQL surface: views by name and queries with named parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarframe.plans.metrics import VIEWS
from bazaarframe.tables import Tables


def register_views(spark: SparkSession, t: Tables, base_tables: bool = True) -> list[str]:
    """Create or replace temporary views for the six metric views and, if asked, the eight tables.

    Views are plans, not results: every query through one is optimized as a whole.
    """
    frames = t.as_dict() if base_tables else {}
    frames |= {name: build(t) for name, build in VIEWS.items()}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def run_query(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """Run a SQL text with ``:name`` parameters."""
    return spark.sql(query, args=params or {})


# Table functions over the registered views: name, parameters and body.
_FUNCTIONS = {
    "kpis": (
        "first date, last date, state string",
        """select count(*) as total_orders, count(distinct customer_unique_id) as unique_customers,
                  coalesce(sum(product_value), 0) as gmv
           from vw_order_metrics
           where order_status not in ('canceled', 'unavailable')
             and order_purchase_timestamp >= cast(kpis.first as timestamp_ntz)
             and order_purchase_timestamp < cast(date_add(kpis.last, 1) as timestamp_ntz)
             and (kpis.state is null or customer_state = kpis.state)""",
        "total_orders bigint, unique_customers bigint, gmv decimal(38,2)",
    ),
    "late_share": (
        "min_orders bigint",
        """select customer_state, count(*), count_if(delivered_late), 100.0D * count_if(delivered_late) / count(*)
           from vw_delivery_performance group by customer_state having count(*) >= late_share.min_orders""",
        "customer_state string, delivered bigint, late bigint, late_percentage double",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create or replace the table functions, so that SQL asks ``select * from kpis(date '...', date '...', 'SP')``.

    They are expanded into the query that calls them and optimized with it; a NULL state stands for all. Needs the views.
    """
    for name, (parameters, body, columns) in _FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns table ({columns}) return {body}")
    return list(_FUNCTIONS)
