"""Row conditions shared by the metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses that do not count as sales, and the word for "no state filter".
INACTIVE_STATUSES = ("canceled", "unavailable")
ALL_STATES = "All states"

Bound = date | str | Column


def is_active() -> Column:
    """True for orders that count as sales; NULL statuses are dropped by SQL logic."""
    return ~F.col("order_status").isin(*INACTIVE_STATUSES)


def active_orders(orders: DataFrame) -> DataFrame:
    return orders.where(is_active())


def _as_date(bound: Bound) -> Column:
    return (bound if isinstance(bound, Column) else F.lit(bound)).cast("date")


def in_period(start: Bound, end: Bound, timestamp: str = "order_purchase_timestamp") -> Column:
    """From the start of day ``start`` to the end of day ``end``, both days included."""
    moment = F.col(timestamp)
    first = _as_date(start).cast("timestamp_ntz")
    after_last = F.date_add(_as_date(end), 1).cast("timestamp_ntz")
    return (moment >= first) & (moment < after_last)


def in_state(state: str | None) -> Column:
    """Equality on the customer's state, or no condition at all."""
    if state is None or state == ALL_STATES:
        return F.lit(True)
    return F.col("customer_state") == state


def month_in_period(start: Bound, end: Bound, month: str = "month") -> Column:
    """Keep month buckets whose first day lies in the period."""
    return F.col(month).cast("date").between(_as_date(start), _as_date(end))
