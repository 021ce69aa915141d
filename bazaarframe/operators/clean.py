"""Projection and text tidying applied before a table is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarframe.schema import TableSpec

# Columns whose outer whitespace is removed, and those that are also upper-cased.
STRIPPED_COLUMNS = (
    "customer_city",
    "customer_state",
    "seller_city",
    "seller_state",
    "order_status",
    "payment_type",
)
UPPERCASE_COLUMNS = ("customer_state", "seller_state")

# All Unicode white space plus the four ASCII separators 0x1C to 0x1F.
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_FIRST_SEEN, _LAST_SEEN = 33, 126  # ASCII characters that print


def project_to_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep the modelled columns in declared order."""
    return df.select(*spec.column_names)


def clean_text_columns(df: DataFrame) -> DataFrame:
    """Strip the text columns that are present and upper-case the state codes. NULL stays NULL."""
    cleaned = {}
    for name in STRIPPED_COLUMNS:
        if name in df.columns:
            raw = F.col(name).cast("string")
            tidy = F.ascii(raw).between(_FIRST_SEEN, _LAST_SEEN) & F.ascii(F.right(raw, F.lit(1))).between(_FIRST_SEEN, _LAST_SEEN)
            text = F.when(tidy, raw).otherwise(F.regexp_replace(raw, _OUTER_SPACE, ""))
            cleaned[name] = F.upper(text) if name in UPPERCASE_COLUMNS else text
    return df.withColumns(cleaned) if cleaned else df
