"""The eight model tables: types, keys, references, limits and source files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """Everything the loader and the checks need to know about one table."""

    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    ranges: tuple[tuple[str, int, int], ...] = ()
    file_patterns: tuple[str, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        """Declared schema. Parquet enforces no NOT NULL, so every field stays nullable here."""
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    @property
    def required_columns(self) -> list[str]:
        """NOT NULL columns, primary-key columns included."""
        return [c.name for c in self.columns if c.required or c.name in self.primary_key]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


def _text(name: str, length: int, required: bool = False) -> Column:
    return Column(name, T.StringType(), required, length)


def _int(name: str, required: bool = False) -> Column:
    return Column(name, T.IntegerType(), required)


def _money(name: str, required: bool = False) -> Column:
    return Column(name, MONEY, required)


def _time(name: str) -> Column:
    return Column(name, T.TimestampNTZType())


def _table(name, columns, primary_key, foreign_keys=(), ranges=(), extra_files=()) -> TableSpec:
    # Accepted file names: "<table>.csv", any "<prefix>_<table>_dataset.csv", or a listed extra name.
    patterns = (f"{name}.csv", f"*_{name}_dataset.csv", *extra_files)
    return TableSpec(name, tuple(columns), tuple(primary_key), tuple(foreign_keys), tuple(ranges), patterns)


# Table names, column names, types, limits and keys of the data model.
# Parents come before their children.
_SPECS = (
    _table(
        "customers",
        [
            _text("customer_id", 32),
            _text("customer_unique_id", 32, required=True),
            _text("customer_city", 100),
            _text("customer_state", 2),
        ],
        ["customer_id"],
    ),
    _table(
        "product_category_translation",
        [_text("product_category_name", 100), _text("product_category_name_english", 100)],
        ["product_category_name"],
        extra_files=("product_category_name_translation.csv",),
    ),
    _table(
        "products",
        [
            _text("product_id", 32),
            _text("product_category_name", 100),
            _int("product_weight_g"),
            _int("product_length_cm"),
            _int("product_height_cm"),
            _int("product_width_cm"),
            _int("product_photos_qty"),
        ],
        ["product_id"],
    ),
    _table(
        "sellers",
        [_text("seller_id", 32), _text("seller_city", 100), _text("seller_state", 2)],
        ["seller_id"],
    ),
    _table(
        "orders",
        [
            _text("order_id", 32),
            _text("customer_id", 32, required=True),
            _text("order_status", 30, required=True),
            _time("order_purchase_timestamp"),
            _time("order_approved_at"),
            _time("order_delivered_carrier_date"),
            _time("order_delivered_customer_date"),
            _time("order_estimated_delivery_date"),
        ],
        ["order_id"],
        [ForeignKey("customer_id", "customers", "customer_id")],
    ),
    _table(
        "order_items",
        [
            _text("order_id", 32),
            _int("order_item_id"),
            _text("product_id", 32, required=True),
            _text("seller_id", 32, required=True),
            _time("shipping_limit_date"),
            _money("price", required=True),
            _money("freight_value", required=True),
        ],
        ["order_id", "order_item_id"],
        [
            ForeignKey("order_id", "orders", "order_id"),
            ForeignKey("product_id", "products", "product_id"),
            ForeignKey("seller_id", "sellers", "seller_id"),
        ],
    ),
    _table(
        "order_payments",
        [
            _text("order_id", 32),
            _int("payment_sequential"),
            _text("payment_type", 30),
            _int("payment_installments"),
            _money("payment_value"),
        ],
        ["order_id", "payment_sequential"],
        [ForeignKey("order_id", "orders", "order_id")],
    ),
    _table(
        "order_reviews",
        [
            _text("review_id", 32),
            _text("order_id", 32),
            _int("review_score"),
            _time("review_creation_date"),
            _time("review_answer_timestamp"),
        ],
        ["review_id", "order_id"],
        [ForeignKey("order_id", "orders", "order_id")],
        ranges=[("review_score", 1, 5)],
    ),
)

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}
