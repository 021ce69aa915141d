"""Data-quality checks, each returning a small DataFrame.

References are checked by counting children per key first and comparing only the distinct keys with
the parent: a key that a third of the children share is one row before it is shuffled, and both
sides of the anti join are unique on the key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarframe.schema import TABLES, TableSpec
from bazaarframe.tables import Tables


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Number of child rows whose key has no parent; NULL keys count."""
    keys = child.groupBy(F.col(key).alias("parent_key")).agg(F.count("*").alias("rows"))
    known = parent.selectExpr(f"{parent_key} as parent_key")
    return keys.join(known, "parent_key", "left_anti").selectExpr(f"coalesce(sum(rows), 0L) as {name}")


def _reference(t: Tables, child: str, key: str, name: str) -> DataFrame:
    fk = next(fk for fk in TABLES[child].foreign_keys if fk.column == key)
    return orphans(getattr(t, child), key, getattr(t, fk.parent), fk.parent_column, name)


def orphan_orders(t: Tables) -> DataFrame:
    return _reference(t, "orders", "customer_id", "orphan_orders")


def orphan_items_orders(t: Tables) -> DataFrame:
    return _reference(t, "order_items", "order_id", "orphan_order_items_orders")


def orphan_items_products(t: Tables) -> DataFrame:
    return _reference(t, "order_items", "product_id", "orphan_order_items_products")


def orphan_items_sellers(t: Tables) -> DataFrame:
    return _reference(t, "order_items", "seller_id", "orphan_order_items_sellers")


def orphan_payments(t: Tables) -> DataFrame:
    return _reference(t, "order_payments", "order_id", "orphan_payments")


def orphan_reviews(t: Tables) -> DataFrame:
    return _reference(t, "order_reviews", "order_id", "orphan_reviews")


def invalid_review_scores(t: Tables) -> DataFrame:
    """Scores outside the allowed range; an unknown score is not counted."""
    (column, low, high), = TABLES["order_reviews"].ranges
    return t.order_reviews.agg(F.count_if(~F.col(column).between(low, high)).alias("invalid_review_scores"))


def invalid_item_values(t: Tables) -> DataFrame:
    negative = (F.col("price") < 0) | (F.col("freight_value") < 0)
    return t.order_items.agg(F.count_if(negative).alias("invalid_order_item_values"))


def invalid_payments(t: Tables) -> DataFrame:
    return t.order_payments.agg(F.count_if(F.col("payment_value") < 0).alias("invalid_payment_values"))


def untranslated_categories(t: Tables) -> DataFrame:
    """Known categories without translation and how many products carry them."""
    counted = (
        t.products.where(F.col("product_category_name").isNotNull())
        .groupBy("product_category_name")
        .agg(F.count("*").alias("products"))
    )
    return counted.join(
        t.product_category_translation.select("product_category_name"), "product_category_name", "left_anti"
    ).orderBy(F.col("products").desc_nulls_first(), F.col("product_category_name").asc_nulls_last())


def check_columns(df: DataFrame, spec: TableSpec, also: tuple[str, ...] = ()) -> None:
    """Raise if a modelled column (or one listed in ``also``) is missing. Reads metadata only."""
    missing = [c for c in [*spec.column_names, *also] if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: missing columns {missing}")


def pk_nulls(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row (table_name, null_key_rows): rows with NULL in any key column."""
    any_null = " or ".join(f"{c} is null" for c in spec.primary_key)
    return df.selectExpr(f"'{spec.name}' as table_name", f"count_if({any_null}) as null_key_rows")


def pk_duplicates(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row (table_name, duplicated_keys, surplus_rows); NULL equals NULL."""
    copies = df.groupBy(*spec.primary_key).agg(F.count("*").alias("n"))
    return copies.selectExpr(
        f"'{spec.name}' as table_name",
        "count_if(n > 1) as duplicated_keys",
        "coalesce(sum(n - 1), 0L) as surplus_rows",
    )


def all_pk_nulls(t: Tables) -> DataFrame:
    return union_all([pk_nulls(df, TABLES[name]) for name, df in t.as_dict().items()])


def all_pk_duplicates(t: Tables) -> DataFrame:
    return union_all([pk_duplicates(df, TABLES[name]) for name, df in t.as_dict().items()])


def require_valid(df: DataFrame, spec: TableSpec) -> None:
    """Raise if the primary key holds NULLs or repeats."""
    if pk_nulls(df, spec).first()["null_key_rows"]:
        raise ValueError(f"{spec.name}: primary key contains null values")
    if pk_duplicates(df, spec).first()["duplicated_keys"]:
        raise ValueError(f"{spec.name}: duplicated primary key detected")


def _row_rules(spec: TableSpec) -> list[tuple[str, str]]:
    """(rule, SQL condition that marks a violating row) pairs that need only the row itself."""
    rules = [(f"not null {c}", f"{c} is null") for c in spec.required_columns]
    for c in spec.columns:
        if c.max_length is not None:
            rules.append((f"length {c.name}", f"length({c.name}) > {c.max_length}"))
        if isinstance(c.type, T.DecimalType):
            limit = 10 ** (c.type.precision - c.type.scale)
            rules.append((f"range {c.name}", f"abs(round({c.name}, {c.type.scale})) >= {limit}"))
    for column, low, high in spec.ranges:
        rules.append((f"check {column}", f"{column} not between {low} and {high}"))
    return rules


def row_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(table_name, rule, violations) for all row rules of a table, counted in one scan."""
    rules = _row_rules(spec)
    counts = df.selectExpr(*[f"count_if({bad}) as r{i}" for i, (_, bad) in enumerate(rules)])
    rows = ", ".join(f"'{spec.name}', '{rule}', r{i}" for i, (rule, _) in enumerate(rules))
    return counts.selectExpr(f"stack({len(rules)}, {rows}) as (table_name, rule, violations)")


def _encoded(columns: tuple[str, ...]) -> str:
    """SQL for a text that is equal for equal keys only, NULL being a value like others; a single column is its own text."""
    if len(columns) == 1:
        return f"cast({columns[0]} as string)"
    return "concat(" + ", ".join(f"coalesce(concat(length({c}), ':', {c}), '-')" for c in columns) + ")"


def _marks(name: str, spec: TableSpec, own: bool, referring: dict[tuple[str, str], tuple[str, int]]) -> list[str]:
    """SQL structs (entity, key, place) that a row of the table contributes to the one grouping of all checks, or NULL.

    A row counts as owner of its key (place 0) and as referrer of the keys it refers to (1 and more). If it breaks row rules,
    it counts once under them all: the entity is the table's of rules, the key has a bit for each.
    """
    entities = {table: i for i, table in enumerate(TABLES)}

    def mark(entity: int, key: str, place: int, condition: str | None = None) -> str:
        struct = f"named_struct('entity', {entity}, 'key', {key}, 'place', {place})"
        return f"case when {condition} then {struct} end" if condition else struct

    marks = []
    if own or any(parent == name for parent, _ in referring.values()):
        marks.append(mark(entities[name], _encoded(spec.primary_key), 0))
    if own:
        broken = " + ".join(f"if({bad}, {1 << i}L, 0L)" for i, (_, bad) in enumerate(_row_rules(spec)))
        marks.append(mark(len(TABLES) + entities[name], f"cast({broken} as string)", 0, f"{broken} <> 0"))
    for fk in spec.foreign_keys:
        if (name, fk.column) in referring:
            parent, place = referring[name, fk.column]
            marks.append(mark(entities[parent], _encoded((fk.column,)), place, f"{fk.column} is not null"))
    return marks


def constraint_violations(
    tables: Tables | dict[str, DataFrame], names: list[str] | None = None, incoming: bool = True
) -> DataFrame:
    """Every declared rule with its number of violations, zero included.

    With ``names``, row and key rules of the other tables are skipped, as are references that
    neither start from nor, unless ``incoming`` is false, point at a named table.

    Every table is read once. A row becomes a few marks: its own key, the keys it refers to, the row rules it breaks. One
    grouping by key, combined where the rows are, then shows keys with several owners and references without any: no
    join, and a key that a third of the rows refer to is one row per task.
    """
    frames = tables.as_dict() if isinstance(tables, Tables) else tables
    wanted = set(names if names is not None else frames)
    referring: dict[tuple[str, str], tuple[str, int]] = {}  # (table, column) to (parent, place among the parent's referrers)
    for name, spec in TABLES.items():
        for fk in spec.foreign_keys:
            if name in wanted or (incoming and fk.parent in wanted):
                place = 1 + sum(parent == fk.parent for parent, _ in referring.values())
                referring[name, fk.column] = (fk.parent, place)
    marked, rules = [], []
    for name, spec in TABLES.items():
        marks = _marks(name, spec, name in wanted, referring)
        if marks:
            marked.append(frames[name].selectExpr(f"inline(array({', '.join(marks)}))").where("place is not null"))
        if name in wanted:
            rules += [(name, rule) for rule, _ in _row_rules(spec)] + [(name, "primary key")]
    rules += [(name, f"reference {column}") for name, column in referring]

    refs = {place: F.count_if(F.col("place") == place).alias(f"r{place}") for _, place in sorted(referring.values())}
    keys = union_all(marked).groupBy("entity", "key").agg(F.count_if(F.col("place") == 0).alias("own"), *refs.values())
    parts = []
    for i, (name, spec) in enumerate(TABLES.items()):
        conditions = []
        if name in wanted:
            bits = f"entity = {len(TABLES) + i} and (try_cast(key as bigint) & {{}}L) <> 0"
            conditions += [(name, rule, bits.format(1 << bit), "own") for bit, (rule, _) in enumerate(_row_rules(spec))]
            conditions.append((name, "primary key", f"entity = {i} and own > 1", "own - 1"))
        for (child, column), (parent, place) in referring.items():
            if parent == name:
                conditions.append((child, f"reference {column}", f"entity = {i} and own = 0 and r{place} > 0", f"r{place}"))
        parts += [
            f"case when {bad} then named_struct('table_name', '{table}', 'rule', '{rule}', 'violations', {n}) end"
            for table, rule, bad, n in conditions
        ]
    broken = keys.where(f"entity >= {len(TABLES)} or own <> 1")  # few keys, if any
    found = broken.selectExpr(f"inline(array({', '.join(parts)}))").where("rule is not null")
    listed = ", ".join(f"('{name}', '{rule}', 0L)" for name, rule in rules)
    none = found.sparkSession.sql(f"select * from values {listed} as (table_name, rule, violations)")
    return found.unionByName(none).groupBy("table_name", "rule").agg(F.sum("violations").alias("violations"))


def key_changes(old: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys that differ between two versions of a table: the key columns and change (added, changed, removed).

    Rows are compared by two hashes of all their other columns, so only keys and hashes are shuffled.
    """
    keys = list(spec.primary_key)
    rest = [c for c in spec.column_names if c not in keys]

    def hashed(df: DataFrame, side: str) -> DataFrame:
        hashes = F.struct(*[F.xxhash64(F.lit(seed), *rest) for seed in (1, 2)])
        return df.select(*keys, hashes.alias(side))

    both = hashed(old, "before").join(hashed(new, "after"), keys, "full")
    change = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .when(F.col("before") != F.col("after"), "changed")
    )
    return both.select(*keys, change.alias("change")).where("change is not null")


def orphaned_by(changes: DataFrame, frames: dict[str, DataFrame], parent: str) -> DataFrame:
    """Rows (table_name, column_name, key, rows) of the dependants whose parent the changes remove.

    Dependants are grouped by key where they are and meet the removed keys only. Sound where no reference was broken before.
    """
    removed = changes.where("change = 'removed'")
    found = [
        frames[name]
        .groupBy(F.col(fk.column).alias("key"))
        .agg(F.count("*").alias("rows"))
        .join(removed.select(F.col(fk.parent_column).alias("key")), "key", "left_semi")
        .select(F.lit(name).alias("table_name"), F.lit(fk.column).alias("column_name"), "key", "rows")
        for name, spec in TABLES.items()
        for fk in spec.foreign_keys
        if fk.parent == parent
    ]
    return union_all(found) if found else removed.selectExpr("'' as table_name", "'' as column_name", "'' as key", "0L as rows").limit(0)
