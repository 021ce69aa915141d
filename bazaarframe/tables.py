"""The record of eight DataFrames that every metric takes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from bazaarframe.schema import TABLES


class Tables:
    """The model tables as attributes. A table given as a function is opened on first use, so a
    query touches no table it does not read."""

    customers: DataFrame
    product_category_translation: DataFrame
    products: DataFrame
    sellers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame

    derived: dict[str, DataFrame]  # stored results of these very tables, by name

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]):
        if set(sources) != set(TABLES):
            raise ValueError(f"expected the tables {sorted(TABLES)}, got {sorted(sources)}")
        self._sources = sources
        self.derived = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._sources:
            raise AttributeError(name)
        source = self._sources[name]
        df = source() if callable(source) else source
        setattr(self, name, df)
        return df

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}

    def with_tables(self, **changed: DataFrame | Callable[[], DataFrame]) -> Tables:
        """Some tables replaced; results derived from the old ones are left behind."""
        return Tables(**{**self._sources, **changed})

    def with_derived(self, **stored: DataFrame) -> Tables:
        """The same tables with stored results that stand in for their computation."""
        tables = Tables(**self._sources)
        tables.derived = {**self.derived, **stored}
        return tables

    def without_derived(self) -> Tables:
        return Tables(**self._sources)
