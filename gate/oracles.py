"""DuckDB SQL for the registered queries, over the raw test tables.

Written on its own: the model is mapped again in SQL, references are checked with NOT EXISTS, and
rounding uses whole numbers because DuckDB's ``avg`` works on doubles.
"""

from __future__ import annotations

from gate.queries import ALL_OF_1997, EARLY_1996, MID_MONTHS, NOTHING, WHOLE_MONTHS

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_NO_TIME = "cast(null as timestamp)"
_NO_INT = "cast(null as integer)"
_NO_TEXT = "cast(null as varchar)"

MODEL = {
    "m_customers": f"""
        select 'c' || o_orderkey as customer_id,
               case when o_orderkey % 10 = 9 then 'r' || o_custkey else 'o' || o_orderkey end as customer_unique_id,
               lower(c_mktsegment) as customer_city,
               case when c_nationkey <> 24 then substr({LETTERS}, c_nationkey + 1, 1) || 'X' end as customer_state
        from orders, customer where o_custkey = c_custkey and o_orderkey % 500 <> 499""",
    "m_translation": """
        select distinct lower(p_type) as product_category_name,
               'en_' || lower(p_type) as product_category_name_english
        from part where p_type <> 'PROMO'""",
    "m_products": f"""
        select 'p' || p_partkey as product_id,
               if(p_partkey % 50 = 0, null, lower(p_type)) as product_category_name,
               {_NO_INT} as product_weight_g, {_NO_INT} as product_length_cm, {_NO_INT} as product_height_cm,
               {_NO_INT} as product_width_cm, {_NO_INT} as product_photos_qty
        from part""",
    "m_sellers": f"""
        select 's' || s_suppkey as seller_id, 'city_' || (s_suppkey % 7) as seller_city,
               substr({LETTERS}, s_nationkey + 1, 1) || 'X' as seller_state
        from supplier""",
    "m_orders": f"""
        select 'o' || o_orderkey as order_id, 'c' || o_orderkey as customer_id,
               case o_orderkey % 20 when 0 then 'canceled' when 1 then 'unavailable' when 2 then 'shipped'
                    else 'delivered' end as order_status,
               if(o_orderkey % 301 = 300, null, o_orderdate + to_hours(cast(o_orderkey % 24 as int)))
                   as order_purchase_timestamp,
               {_NO_TIME} as order_approved_at, {_NO_TIME} as order_delivered_carrier_date,
               if(o_orderkey % 20 in (1, 2) or o_orderkey % 40 = 20, null,
                  o_orderdate + to_hours(cast((o_orderkey * 7 % 30) * 24 + o_orderkey * 5 % 24 + 24 as int)))
                   as order_delivered_customer_date,
               if(o_orderkey % 97 = 96, null, o_orderdate + to_hours(cast(24 * (10 + o_orderkey % 11) as int)))
                   as order_estimated_delivery_date
        from orders""",
    "m_items": f"""
        select 'o' || l_orderkey as order_id, l_linenumber as order_item_id, 'p' || l_partkey as product_id,
               's' || l_suppkey as seller_id, {_NO_TIME} as shipping_limit_date,
               cast(l_extendedprice as decimal(12, 2)) as price,
               cast(5.25 + l_quantity as decimal(12, 2)) as freight_value
        from lineitem""",
    "m_payments": f"""
        select 'o' || o_orderkey as order_id, 1 as payment_sequential, {_NO_TEXT} as payment_type,
               {_NO_INT} as payment_installments, cast(o_totalprice as decimal(12, 2)) as payment_value
        from orders where o_orderkey % 200 <> 0
        union all
        select 'o' || o_orderkey, 2, null, null, cast(10 as decimal(12, 2)) from orders where o_orderkey % 15 = 0""",
    "m_reviews": f"""
        select 'r1_' || o_orderkey as review_id, 'o' || o_orderkey as order_id,
               cast(1 + o_orderkey % 5 as int) as review_score, {_NO_TIME} as review_creation_date,
               {_NO_TIME} as review_answer_timestamp
        from orders where o_orderkey % 8 <> 0
        union all
        select 'r2_' || o_orderkey, 'o' || o_orderkey, 5, null, null from orders where o_orderkey % 50 = 3""",
    # Variants with broken rows
    "d_customers": """
        select customer_id, customer_unique_id,
               if(length(customer_id) % 2 = 0, ' ' || customer_city || chr(9), customer_city) as customer_city,
               lower(customer_state) as customer_state
        from m_customers""",
    "d_items": f"""
        select if(l_orderkey % 503 = 7, 'o10000000', 'o' || l_orderkey) as order_id,
               if(l_orderkey % 899 = 11, null, l_linenumber) as order_item_id,
               if(l_partkey % 211 = 3, 'p10000000', 'p' || l_partkey) as product_id,
               if(l_suppkey % 53 = 9, 's10000000', 's' || l_suppkey) as seller_id,
               {_NO_TIME} as shipping_limit_date,
               cast(if(l_orderkey % 601 = 2, -1, l_extendedprice) as decimal(12, 2)) as price,
               cast(if(l_orderkey % 701 = 3, -1, 5.25 + l_quantity) as decimal(12, 2)) as freight_value
        from lineitem""",
    "d_payments": f"""
        select 'o' || if(o_orderkey % 409 = 6, o_orderkey + 10000000, o_orderkey) as order_id,
               1 as payment_sequential, {_NO_TEXT} as payment_type, {_NO_INT} as payment_installments,
               cast(if(o_orderkey % 307 = 4, -1, o_totalprice) as decimal(12, 2)) as payment_value
        from orders""",
    "d_reviews": f"""
        select if(o_orderkey % 997 = 5, null, 'r1_' || o_orderkey) as review_id,
               'o' || if(o_orderkey % 401 = 5, o_orderkey + 10000000, o_orderkey) as order_id,
               cast(case o_orderkey % 211 when 0 then 0 when 1 then 6 when 2 then null
                         else 1 + o_orderkey % 5 end as int) as review_score,
               {_NO_TIME} as review_creation_date, {_NO_TIME} as review_answer_timestamp
        from orders where o_orderkey % 8 <> 0""",
    # The tables as a load accepts them
    "l_orders": "select * from m_orders where customer_id in (select customer_id from m_customers)",
    "l_items": "select * from m_items where order_id in (select order_id from l_orders)",
    "l_payments": "select * from m_payments where order_id in (select order_id from l_orders)",
    "l_reviews": "select * from m_reviews where order_id in (select order_id from l_orders)",
    # Order grain, with the mean score as a whole number of 1e-16
    "item_sums": """
        select order_id, count(*) as n, sum(price) as price, sum(freight_value) as freight from m_items group by all""",
    "paid": "select order_id, sum(payment_value) as amount from m_payments group by all",
    "scores": """
        select order_id, (2 * cast(sum(review_score) as hugeint) * 10000000000000000 + count(review_score))
                         // (2 * count(review_score)) as score16
        from m_reviews group by all""",
    "om": """
        select o.* exclude (order_approved_at, order_delivered_carrier_date),
               c.customer_unique_id, c.customer_city, c.customer_state,
               ifnull(i.n, 0) as items_count, ifnull(i.price, 0) as product_value,
               ifnull(i.freight, 0) as freight_value, ifnull(p.amount, 0) as payment_value, s.score16,
               ifnull(order_delivered_customer_date > order_estimated_delivery_date, false) as delivered_late,
               epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp) as micros
        from m_orders o
        join m_customers c using (customer_id)
        left join item_sums i using (order_id)
        left join paid p using (order_id)
        left join scores s using (order_id)""",
    "sales": "select * from om where order_status <> 'canceled' and order_status <> 'unavailable'",
    "delivered": "select * from om where order_delivered_customer_date is not null",
    "sold_items": """
        select i.*, ifnull(ifnull(x.product_category_name_english, p.product_category_name), 'unknown') as category
        from m_items i
        join m_products p using (product_id)
        left join m_translation x using (product_category_name)
        where i.order_id in (select order_id from m_orders where order_status not in ('canceled', 'unavailable'))""",
    "people": """
        select customer_unique_id, count(*) as orders, sum(product_value) as spent,
               min(order_purchase_timestamp) as first_purchase, max(order_purchase_timestamp) as last_purchase
        from sales group by all""",
}

_STATE_MONTHS = """
    select customer_state, date_trunc('month', order_purchase_timestamp)::date as month, count(*) as orders,
           sum(items_count)::bigint as items, {money} as paid
    from sales where {where} group by 1, 2"""

_DEPENDS = {
    "l_orders": ["m_orders", "m_customers"],
    "l_items": ["m_items", "l_orders"],
    "l_payments": ["m_payments", "l_orders"],
    "l_reviews": ["m_reviews", "l_orders"],
    "d_customers": ["m_customers"],
    "item_sums": ["m_items"],
    "paid": ["m_payments"],
    "scores": ["m_reviews"],
    "om": ["m_orders", "m_customers", "item_sums", "paid", "scores"],
    "sales": ["om"],
    "delivered": ["om"],
    "sold_items": ["m_items", "m_products", "m_translation", "m_orders"],
    "people": ["sales"],
}


def _needed(names: list[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        for n in [*_needed(_DEPENDS.get(name, [])), name]:
            if n not in found:
                found.append(n)
    return found


def _with(names: str, body: str) -> str:
    ctes = ",\n".join(f"{n} as ({MODEL[n]})" for n in _needed(names.split()))
    return f"with {ctes}\n{body}"


def _dbl(value: str) -> str:
    return f"cast({value} as double)"


def _avg2(total: str, n: str) -> str:
    return f"cast((2 * cast({total} * 100 as hugeint) + {n}) // nullif(2 * {n}, 0) as double) / 100"


def _pct2(part: str, whole: str) -> str:
    part, whole = f"cast({part} as hugeint)", f"cast({whole} as hugeint)"
    return f"cast((20000 * {part} + {whole}) // nullif(2 * {whole}, 0) as double) / 100"


_ONE = "cast(10000000000000000 as hugeint)"
_SCORE2 = f"cast((200 * sum(score16) + count(score16) * {_ONE}) // nullif(2 * count(score16) * {_ONE}, 0) as double) / 100"
_SCORE6 = f"round(cast(sum(score16) as double) / {_ONE} / nullif(count(score16), 0), 6)"
_DAYS = "cast(sum(micros) as double) / nullif(count(micros), 0) / 86400000000.0"
_DAYS2 = (
    "cast((200 * cast(sum(micros) as hugeint) + 86400000000 * cast(count(micros) as hugeint))"
    " // nullif(2 * 86400000000 * cast(count(micros) as hugeint), 0) as double) / 100"
)
_LATE = "count(*) filter (delivered_late)"

_ITEM_MEASURES = f"""count(distinct order_id) as orders, count(*) as items_sold, {_dbl('sum(price)')} as revenue,
    {_avg2('sum(price)', 'count(*)')} as average_item_price, {_dbl('sum(freight_value)')} as freight_value"""
_CATEGORIES = f"select category, {_ITEM_MEASURES} from sold_items group by category"
_SELLERS = f"""select seller_id, seller_city, seller_state, {_ITEM_MEASURES}
    from sold_items join m_sellers using (seller_id) group by seller_id, seller_city, seller_state"""
_MONTHLY = f"""select cast(date_trunc('month', order_purchase_timestamp) as date) as month, count(*) as orders,
    count(distinct customer_unique_id) as customers, {_dbl('sum(product_value)')} as gmv,
    {_avg2('sum(product_value)', 'count(*)')} as average_order_value, {_dbl('sum(freight_value)')} as freight_value
    from sales group by 1"""
_STATES = f"""select customer_state, count(*) as orders, count(distinct customer_unique_id) as customers,
    {_dbl('sum(product_value)')} as gmv from sales group by 1"""
_STATES_AVG = _STATES.replace(" from sales", f", {_avg2('sum(product_value)', 'count(*)')} as average_order_value from sales")
_PEOPLE = f"""select customer_unique_id, orders, {_dbl('spent')} as total_spent,
    {_avg2('spent', 'orders')} as average_order_value"""


def _top(body: str, measure: str, key: str, n: int = 10) -> str:
    return f"select * from ({body}) order by {measure} desc, {key} limit {n}"


def _count_orphans(child: str, key: str, parent: str, parent_key: str, name: str) -> str:
    return _with(
        f"{child} {parent}",
        f"select count(*) as {name} from {child} k"
        f" where not exists (select 1 from {parent} f where f.{parent_key} = k.{key})",
    )


_CLEAN = {
    "customers": "m_customers",
    "product_category_translation": "m_translation",
    "products": "m_products",
    "sellers": "m_sellers",
    "orders": "m_orders",
    "order_items": "m_items",
    "order_payments": "m_payments",
    "order_reviews": "m_reviews",
}
_DIRTY = _CLEAN | {
    "customers": "d_customers",
    "order_items": "d_items",
    "order_payments": "d_payments",
    "order_reviews": "d_reviews",
}
_KEYS = {
    "customers": "customer_id",
    "product_category_translation": "product_category_name",
    "products": "product_id",
    "sellers": "seller_id",
    "orders": "order_id",
    "order_items": "order_id, order_item_id",
    "order_payments": "order_id, payment_sequential",
    "order_reviews": "review_id, order_id",
}
# (text columns with their limits, other NOT NULL columns, money columns) per table
_LIMITS = {
    "customers": {"customer_id": 32, "customer_unique_id": 32, "customer_city": 100, "customer_state": 2},
    "product_category_translation": {"product_category_name": 100, "product_category_name_english": 100},
    "products": {"product_id": 32, "product_category_name": 100},
    "sellers": {"seller_id": 32, "seller_city": 100, "seller_state": 2},
    "orders": {"order_id": 32, "customer_id": 32, "order_status": 30},
    "order_items": {"order_id": 32, "product_id": 32, "seller_id": 32},
    "order_payments": {"order_id": 32, "payment_type": 30},
    "order_reviews": {"review_id": 32, "order_id": 32},
}
_ALSO_REQUIRED = {
    "customers": ["customer_unique_id"],
    "orders": ["customer_id", "order_status"],
    "order_items": ["product_id", "seller_id", "price", "freight_value"],
}
_MONEY = {"order_items": ["price", "freight_value"], "order_payments": ["payment_value"]}
_REFERENCES = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("order_payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
]


def _per_table(tables: dict[str, str], line) -> str:
    return _with(" ".join(tables.values()), " union all ".join(line(n, cte) for n, cte in tables.items()))


def _surplus(cte: str, keys: str) -> str:
    return f"select count(*) as k, ifnull(sum(n - 1), 0) as s from (select count(*) as n from {cte} group by {keys}) where n > 1"


def _violations(tables: dict[str, str]) -> str:
    lines = []
    for name, cte in tables.items():
        conditions = [(f"not null {c.strip()}", f"{c} is null") for c in [*_KEYS[name].split(","), *_ALSO_REQUIRED.get(name, [])]]
        conditions += [(f"length {c}", f"length({c}) > {n}") for c, n in _LIMITS[name].items()]
        conditions += [(f"range {c}", f"abs({c}) >= 10000000000") for c in _MONEY.get(name, [])]
        if name == "order_reviews":
            conditions.append(("check review_score", "review_score < 1 or review_score > 5"))
        for rule, bad in conditions:
            lines.append(
                f"select '{name}' as table_name, '{rule}' as rule, count(*) filter ({bad}) as violations from {cte}"
            )
        lines.append(f"select '{name}', 'primary key', cast(s as bigint) from ({_surplus(cte, _KEYS[name])})")
    for child, key, parent in _REFERENCES:
        lines.append(
            f"select '{child}', 'reference {key}', count(*) from {tables[child]} k where {key} is not null"
            f" and not exists (select 1 from {tables[parent]} f where f.{key} = k.{key})"
        )
    return _with(" ".join(tables.values()), " union all ".join(lines))


def _nulls(name: str, cte: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, '{c}' as column_name, count(*) - count({c}) as nulls from {cte}" for c in columns
    )


def _profile_nulls(tables: dict[str, str]) -> str:
    from bazaarframe.schema import TABLES

    body = " union all ".join(_nulls(n, cte, TABLES[n].column_names) for n, cte in tables.items())
    return _with(" ".join(tables.values()), f"select * from ({body}) where nulls > 0")


def _chosen(period) -> str:
    start, end, state = period
    text = f"order_purchase_timestamp >= date '{start}' and order_purchase_timestamp < date '{end}' + interval 1 day"
    return text if state in (None, "All states") else f"{text} and customer_state = '{state}'"


_DEFAULT = """order_purchase_timestamp >= (select date_trunc('month', min(order_purchase_timestamp)) from sales)
    and order_purchase_timestamp < (select date_trunc('month', max(order_purchase_timestamp)) from sales) + interval {}"""
_DEFAULT_DAY, _DEFAULT_MONTH = _DEFAULT.format("1 day"), _DEFAULT.format("1 month")


def _kpis(condition: str) -> str:
    return _with(
        "sales",
        f"""select count(*) as total_orders, count(distinct customer_unique_id) as unique_customers,
            {_dbl('ifnull(sum(product_value), 0)')} as gmv,
            ifnull({_dbl('sum(product_value)')} / nullif(count(*), 0), 0) as average_order_value,
            ifnull({_SCORE6}, 0) as average_review_score
            from sales where {condition}""",
    )


def _monthly_filtered(condition: str, buckets: str) -> str:
    return _with(
        "sales",
        f"""select * from (
            select date_trunc('month', order_purchase_timestamp) as month, count(*) as orders,
            count(distinct customer_unique_id) as customers, {_dbl('sum(product_value)')} as gmv,
            {_dbl('sum(product_value)')} / count(*) as average_order_value,
            {_dbl('sum(freight_value)')} as freight_value
            from sales where {condition} group by 1) where {buckets}""",
    )


def _brl(x: str) -> str:
    x = _dbl(x)
    return f"""'R$ ' || case when abs({x}) >= 1000000 then replace(printf('%.2f', {x} / 1000000), '.', ',') || ' mi'
        when abs({x}) >= 1000 then replace(printf('%.1f', {x} / 1000), '.', ',') || ' mil'
        else translate(format('{{:,.2f}}', {x}), ',.', '.,') end"""


def _int(x: str) -> str:
    return f"replace(format('{{:,}}', cast(trunc({x}) as bigint)), ',', '.')"


def _cards(condition: str) -> str:
    return _with(
        "sales delivered people",
        f"""select unnest(range(1, 12)::int[]) as card,
            unnest(['GMV', 'Orders', 'Customers', 'Average Order', 'Average Review', 'Delivered Orders',
                    'Average Delivery Time', 'Late Deliveries', 'One-time Customers', 'Repeat Customers',
                    'Repeat Customer Rate']) as label,
            unnest([{_brl('gmv')}, {_int('n')}, {_int('c')}, {_brl('aov')}, printf('%.2f', score) || ' / 5',
                    {_int('dn')}, printf('%.2f', days) || ' days', printf('%.2f', late) || '%',
                    {_int('once')}, {_int('again')}, printf('%.2f', rate) || '%']) as value
            from (select count(*) as n, count(distinct customer_unique_id) as c, ifnull(sum(product_value), 0) as gmv,
                         ifnull({_dbl('sum(product_value)')} / nullif(count(*), 0), 0) as aov,
                         ifnull({_SCORE6}, 0) as score from sales where {condition})
            cross join (select count(*) as dn, {_DAYS} as days, 100.0 * {_LATE} / count(*) as late from delivered)
            cross join (select count(*) filter (orders = 1) as once, count(*) filter (orders > 1) as again,
                               100.0 * count(*) filter (orders > 1) / count(*) as rate from people)""",
    )


def _report() -> str:
    def section(name: str, lines: list[str], source: str) -> str:
        return " union all ".join(
            f"select '{name}' as section, {i} as line, {text} as text from ({source})" for i, text in enumerate(lines, 1)
        )

    def n(x: str) -> str:
        return f"format('{{:,}}', cast({x} as bigint))"

    def money(x: str) -> str:
        return f"format('{{:,.2f}}', {_dbl(x)})"

    def two(x: str) -> str:
        return f"printf('%.2f', {x})"

    kpis = f"""select count(*) as o, count(distinct customer_unique_id) as c, sum(product_value) as g,
        {_avg2('sum(product_value)', 'count(*)')} as a, {_SCORE2} as s from sales"""
    delivery = f"select count(*) as o, {_DAYS2} as d, {_pct2(_LATE, 'count(*)')} as l from delivered"
    customers = f"""select count(*) filter (orders = 1) as o, count(*) filter (orders > 1) as r,
        {_pct2('count(*) filter (orders > 1)', 'count(*)')} as p from people"""
    ranked = f"select *, cast(row_number() over (order by revenue desc, category) as int) as i from ({_top(_CATEGORIES, 'revenue', 'category')})"
    parts = [
        section(
            "EXECUTIVE KPIs",
            [
                f"'Orders: ' || {n('o')}",
                f"'Unique customers: ' || {n('c')}",
                f"'GMV: R$ ' || {money('g')}",
                f"'Average order value: R$ ' || {money('a')}",
                f"'Average review score: ' || {two('s')}",
            ],
            kpis,
        ),
        section(
            "DELIVERY",
            [
                f"'Delivered orders: ' || {n('o')}",
                f"'Average delivery time: ' || {two('d')} || ' days'",
                f"'Late deliveries: ' || {two('l')} || '%'",
            ],
            delivery,
        ),
        section(
            "CUSTOMERS",
            [
                f"'One-time customers: ' || {n('o')}",
                f"'Repeat customers: ' || {n('r')}",
                f"'Repeat customer rate: ' || {two('p')} || '%'",
            ],
            customers,
        ),
        f"""select 'TOP 10 CATEGORIES' as section, i as line,
            format('{{:>2}}. {{:<35}} R$ {{:>12}}', i, category, {money('revenue')}) as text from ({ranked})""",
    ]
    return _with("sales delivered people sold_items", " union all ".join(parts))


_LOADABLE = _CLEAN | {"orders": "l_orders", "order_items": "l_items", "order_payments": "l_payments", "order_reviews": "l_reviews"}


def _planted(table: str, column: str, value: str, cte: str, condition: str) -> str:
    return (
        f"select '{table}' as table_name, '{column}' as column_name, '{table}.csv' as file, '{value}' as value, count(*) as rows"
        f" from {cte} where cast(substr(order_id, 2) as bigint) {condition} having count(*) > 0"
    )


def _load_oracles() -> dict[str, str]:
    number = "cast(substr(customer_id, 2) as bigint)"
    return {
        "load_row_counts": _per_table(_LOADABLE, lambda n, cte: f"select '{n}' as table_name, count(*) as row_count from {cte}"),
        "load_source_counts": _per_table(
            _LOADABLE, lambda n, cte: f"select '{n}' as table_name, count(*) as source_rows, count(*) as stored_rows from {cte}"
        ),
        "load_customers": _with("m_customers", "select customer_id, customer_unique_id, customer_city, customer_state from m_customers"),
        "load_orders": _with(
            "l_orders",
            """select order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
                order_estimated_delivery_date from l_orders""",
        ),
        "load_items": _with(
            "l_items",
            f"select order_id, product_id, seller_id, {_dbl('price')} as price, {_dbl('freight_value')} as freight_value from l_items",
        ),
        "load_refusals": f"select * from ({_violations(_DIRTY)}) where violations > 0",
        "load_rejects": _with(
            "m_items m_orders",
            " union all ".join(
                [
                    _planted("order_items", "order_item_id", "one", "m_items", "% 89 = 4"),
                    _planted("order_items", "price", "12,5O", "m_items", "% 97 = 3"),
                    _planted("orders", "order_purchase_timestamp", "2020-02-30 10:00:00", "m_orders", "% 83 = 7"),
                ]
            ),
        ),
        "load_reload_changes": _with(
            "m_customers",
            f"""select customer_id, 'changed' as change from m_customers where {number} % 7 = 3
                union all select 'n' || customer_id, 'added' from m_customers where {number} % 11 = 2""",
        ),
        "load_would_orphan": _with(
            "l_orders",
            f"""select 'orders' as table_name, 'customer_id' as column_name, customer_id as key, count(*) as rows
                from l_orders where {number} % 37 = 5 group by customer_id""",
        ),
        "load_appended": _with(
            "m_sellers", "select seller_state, 2 * count(*) as rows, count(distinct seller_id) as sellers from m_sellers group by 1"
        ),
    }


def _insight_texts(numbers: str) -> str:
    return f"""select insight, subject, case when insight like 'top%' then {_brl('value')}
        when insight like '%percentage' then printf('%.2f%%', value) else printf('%.2f', value) end as text from ({numbers})"""


def all_oracles() -> dict[str, str]:
    sql = _query_oracles()
    same = {
        "stored_dash_kpis": "dash_kpis",
        "stored_review_by_lateness": "review_by_lateness",
        "cells_monthly_sales": "monthly_sales",
        "cells_states": "dash_states",
        "cells_executive_kpis": "executive_kpis",
        "cells_kpis_all_states": "dash_kpis_all_states",
        "load_order_metrics": "order_metrics",
    }
    return {
        **sql,
        **{name: sql[other] for name, other in same.items()},
        **_load_oracles(),
        "cells_kpis_state": _kpis(_chosen(WHOLE_MONTHS)),
        "dash_insight_texts": _insight_texts(sql["dash_insights"]),
        "dash_monthly_times": _with("sales", _MONTHLY.replace("as date) as month", "as timestamp) as month")),
        "sql_function_kpis": _with(
            "sales",
            f"""select count(*) as total_orders, count(distinct customer_unique_id) as unique_customers,
                {_dbl('ifnull(sum(product_value), 0)')} as gmv from sales where {_chosen(MID_MONTHS)}""",
        ),
        "sql_function_late_share": _with(
            "delivered",
            f"""select customer_state, count(*) as delivered, {_LATE} as late, 100.0 * {_dbl(_LATE)} / count(*) as late_percentage
                from delivered group by 1 having count(*) >= 10""",
        ),
    }


def _query_oracles() -> dict[str, str]:
    top_categories = _with("sold_items", _top(_CATEGORIES, "revenue", "category"))
    monthly = _with("sales", _MONTHLY)
    states = _with("sales", _STATES)
    retention = "count(*) filter (orders = 1) as one_time_customers, count(*) filter (orders > 1) as repeat_customers"
    om_text = """order_id, customer_id, customer_unique_id, customer_city, customer_state, order_status,
        order_purchase_timestamp, order_delivered_customer_date, order_estimated_delivery_date"""
    review_by_lateness = _with(
        "delivered",
        f"""select delivered_late, count(*) as orders, {_SCORE2} as average_review_score
            from delivered where score16 is not null group by 1""",
    )
    score6 = "round(cast(score16 as double) / 10000000000000000, 6) as review_score"

    def early_buckets(period) -> str:
        return f"month >= date '{period[0]}' and month <= date '{period[1]}'"

    return {
        "order_metrics": _with(
            "om",
            f"""select {om_text}, items_count, {_dbl('product_value')} as product_value,
                {_dbl('freight_value')} as freight_value, {_dbl('payment_value')} as payment_value, {score6},
                delivered_late from om""",
        ),
        "monthly_sales": monthly,
        "category_performance": _with("sold_items", _CATEGORIES),
        "customer_metrics": _with("people", f"{_PEOPLE}, first_purchase, last_purchase from people"),
        "seller_performance": _with("sold_items m_sellers", _SELLERS),
        "delivery_performance": _with(
            "delivered",
            f"""select order_id, customer_state, order_purchase_timestamp, order_delivered_customer_date,
                order_estimated_delivery_date, {_dbl('micros')} / 86400000000.0 as delivery_days, delivered_late, {score6}
                from delivered""",
        ),
        "executive_kpis": _with(
            "sales",
            f"""select count(*) as total_orders, count(distinct customer_unique_id) as unique_customers,
                {_dbl('sum(product_value)')} as gmv, {_avg2('sum(product_value)', 'count(*)')} as average_order_value,
                {_SCORE2} as average_review_score from sales""",
        ),
        "monthly_evolution": monthly,
        "top_categories": top_categories,
        "top_states": _with("sales", _top(_STATES_AVG, "gmv", "customer_state")),
        "top_sellers": _with("sold_items m_sellers", _top(_SELLERS, "revenue", "seller_id")),
        "delivery_summary": _with(
            "delivered",
            f"""select count(*) as delivered_orders, {_DAYS2} as average_delivery_days,
                {_pct2(_LATE, 'count(*)')} as late_delivery_percentage from delivered""",
        ),
        "review_by_lateness": review_by_lateness,
        "stored_review_by_lateness": review_by_lateness,
        "repeat_customers": _with(
            "people",
            f"select {retention}, {_pct2('count(*) filter (orders > 1)', 'count(*)')} as repeat_customer_percentage from people",
        ),
        "freight_impact": _with(
            "sales",
            f"""select {_dbl('sum(product_value)')} as product_value, {_dbl('sum(freight_value)')} as freight_value,
                {_pct2('sum(freight_value) * 100', 'sum(product_value) * 100')} as freight_to_product_percentage
                from sales""",
        ),
        "top_customers": _with("people", _top(f"{_PEOPLE} from people", "total_spent", "customer_unique_id")),
        "report_top_categories": _with(
            "sold_items",
            f"""select cast(row_number() over (order by revenue desc, category) as int) as position,
                category, orders, items_sold, revenue from ({_top(_CATEGORIES, 'revenue', 'category')})""",
        ),
        "console_report": _report(),
        "dq_orphan_orders": _count_orphans("m_orders", "customer_id", "d_customers", "customer_id", "orphan_orders"),
        "dq_orphan_items_orders": _count_orphans(
            "d_items", "order_id", "m_orders", "order_id", "orphan_order_items_orders"
        ),
        "dq_orphan_items_products": _count_orphans(
            "d_items", "product_id", "m_products", "product_id", "orphan_order_items_products"
        ),
        "dq_orphan_items_sellers": _count_orphans(
            "d_items", "seller_id", "m_sellers", "seller_id", "orphan_order_items_sellers"
        ),
        "dq_orphan_payments": _count_orphans("d_payments", "order_id", "m_orders", "order_id", "orphan_payments"),
        "dq_orphan_reviews": _count_orphans("d_reviews", "order_id", "m_orders", "order_id", "orphan_reviews"),
        "dq_invalid_review_scores": _with(
            "d_reviews", "select count(*) as invalid_review_scores from d_reviews where review_score < 1 or review_score > 5"
        ),
        "dq_invalid_item_values": _with(
            "d_items", "select count(*) as invalid_order_item_values from d_items where least(price, freight_value) < 0"
        ),
        "dq_invalid_payments": _with(
            "d_payments", "select count(*) as invalid_payment_values from d_payments where payment_value < 0"
        ),
        "dq_untranslated_categories": _with(
            "m_products m_translation",
            """select product_category_name, count(*) as products from m_products p
               where product_category_name is not null and not exists
                   (select 1 from m_translation x where x.product_category_name = p.product_category_name)
               group by 1""",
        ),
        "dq_pk_nulls": _per_table(
            _DIRTY,
            lambda n, cte: f"select '{n}' as table_name, count(*) filter ("
            + " or ".join(f"{k} is null" for k in _KEYS[n].split(","))
            + f") as null_key_rows from {cte}",
        ),
        "dq_pk_duplicates": _per_table(
            _DIRTY,
            lambda n, cte: f"select '{n}' as table_name, k as duplicated_keys, cast(s as bigint) as surplus_rows"
            f" from ({_surplus(cte, _KEYS[n])})",
        ),
        "dq_clean_pk_duplicates": _per_table(
            _CLEAN,
            lambda n, cte: f"select '{n}' as table_name, k as duplicated_keys, cast(s as bigint) as surplus_rows"
            f" from ({_surplus(cte, _KEYS[n])})",
        ),
        "constraint_violations": _violations(_DIRTY),
        "clean_constraint_violations": _violations(_CLEAN),
        "profile_shape": _per_table(
            _DIRTY,
            lambda n, cte: f"select '{n}' as table_name, (select count(*) from {cte}) as row_count,"
            f" (select cast(count(*) as int) from (select unnest(columns) as c from"
            f" (select [x for x in string_split('{_column_list(n)}', ',')] as columns))) as column_count",
        ),
        "profile_nulls": _profile_nulls(_DIRTY),
        "profile_duplicates": _per_table(
            _DIRTY,
            lambda n, cte: f"select '{n}' as table_name, (select count(*) from {cte})"
            f" - (select count(*) from (select distinct * from {cte})) as duplicated_rows",
        ),
        "row_counts": _per_table(_CLEAN, lambda n, cte: f"select '{n}' as table_name, count(*) as row_count from {cte}"),
        "clean_customers": _with(
            "d_customers",
            r"""select customer_id, customer_unique_id, regexp_replace(customer_city, '^\s+|\s+$', '', 'g') as customer_city,
                upper(customer_state) as customer_state from d_customers""",
        ),
        "dash_monthly": monthly,
        "dash_categories": _with("sold_items", _CATEGORIES),
        "dash_top_categories": top_categories,
        "dash_top_5_categories": _with("sold_items", _top(_CATEGORIES, "revenue", "category", 5)),
        "dash_states": states,
        "dash_top_states": _with("sales", _top(_STATES, "gmv", "customer_state")),
        "dash_review_by_lateness": _with(
            "delivered",
            f"""select delivered_late, count(*) as orders, {_SCORE6} as average_review_score,
                if(delivered_late, 'Late', 'On time') as delivery_status
                from delivered where score16 is not null group by delivered_late""",
        ),
        "dash_delivery_kpis": _with(
            "delivered",
            f"""select count(*) as delivered_orders, {_DAYS} as average_delivery_days,
                {_dbl(_LATE)} * 100 / count(*) as late_delivery_percentage from delivered""",
        ),
        "dash_retention": _with(
            "people",
            f"select {retention}, {_dbl('count(*) filter (orders > 1)')} * 100 / count(*) as repeat_customer_percentage from people",
        ),
        "dash_state_options": _with("om", "select customer_state from om where customer_state is not null group by 1"),
        "dash_kpis": _kpis(_chosen(MID_MONTHS)),
        "stored_dash_kpis": _kpis(_chosen(MID_MONTHS)),
        "dash_kpis_all_states": _kpis(_chosen(ALL_OF_1997)),
        "dash_kpis_nothing": _kpis(_chosen(NOTHING)),
        "dash_kpis_default": _kpis(_DEFAULT_DAY),
        "dash_kpis_full_last_month": _kpis(_DEFAULT_MONTH),
        "dash_monthly_filtered": _monthly_filtered(_chosen(EARLY_1996), early_buckets(EARLY_1996)),
        "dash_monthly_filtered_state": _monthly_filtered(_chosen(MID_MONTHS), early_buckets(MID_MONTHS)),
        "dash_monthly_default": _monthly_filtered(_DEFAULT_DAY, "true"),
        "dash_default_period": _with(
            "sales",
            """select cast(date_trunc('month', min(order_purchase_timestamp)) as date) as start_date,
                cast(date_trunc('month', max(order_purchase_timestamp)) as date) as end_date from sales""",
        ),
        "dash_cards": _cards(_chosen(MID_MONTHS)),
        "dash_cards_default": _cards(_DEFAULT_DAY),
        "dash_insights": _with(
            "sales delivered people sold_items",
            f"""(select 'top_category' as insight, category as subject, round(revenue, 6) as value
                 from ({_CATEGORIES}) order by revenue desc, category limit 1)
                union all
                (select 'top_state', customer_state, round(gmv, 6) from ({_STATES}) order by gmv desc, customer_state limit 1)
                union all
                select 'repeat_customer_percentage', null,
                       round({_dbl('count(*) filter (orders > 1)')} * 100 / count(*), 6) from people
                union all
                select 'late_delivery_percentage', null, round({_dbl(_LATE)} * 100 / count(*), 6) from delivered
                union all
                select 'review_difference', null, ifnull(round(
                    cast(sum(score16) filter (not delivered_late) as double) / {_ONE}
                        / nullif(count(score16) filter (not delivered_late), 0)
                    - cast(sum(score16) filter (delivered_late) as double) / {_ONE}
                        / nullif(count(score16) filter (delivered_late), 0), 6), 0) from delivered""",
        ),
        "order_texts": _with(
            "om",
            f"""select order_id, {_brl('product_value')} as value_text, {_brl('product_value * 100')} as large_text,
                {_brl('freight_value')} as freight_text, {_int('payment_value')} as payment_text,
                printf('%.2f', cast(score16 as double) / {_ONE}) as score_text from om""",
        ),
        "sql_kpis": _with("sales", _STATE_MONTHS.format(where=_chosen(MID_MONTHS), money=_dbl("sum(payment_value)"))),
        "sql_kpis_all_states": _with(
            "sales", _STATE_MONTHS.format(where=_chosen(ALL_OF_1997), money=_dbl("sum(payment_value)"))
        ),
        "sql_late_share": _with(
            "delivered",
            f"select customer_state, count(*) as delivered, {_LATE} as late from delivered group by 1",
        ),
    }


def _column_list(name: str) -> str:
    from bazaarframe.schema import TABLES

    return ",".join(TABLES[name].column_names)
