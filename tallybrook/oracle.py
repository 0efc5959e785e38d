"""The same results in SQL for DuckDB, written on the star-schema tables directly.

Used by the checks only. Each relation names the ones it reads; a statement takes
along just those it needs.
"""

from __future__ import annotations

import re

# Fixed values, stated anew: a value that goes missing in the jobs shows here.
STATES = "AC AL AM AP BA CE DF ES GO MA MG MS MT PA PB PE PI PR RJ RN RO RR RS SC SE SP TO".split()
NATION_STATES = "ap ba ce df es go ma mg ms mt pa pb pe pi pr rj rn ro rr rs sc se sp to xx".split()
ORDER_STATUSES = "approved canceled delivered invoiced processing shipped".split()
PAYMENT_TYPES = "boleto credit_card debit_card voucher".split()
SEGMENTS = "high_value low_value medium_value no_purchase".split()


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _first_by(source: str, keys: str, order: str, where: str) -> str:
    """The row of each key that comes first in ``order``."""
    by = ", ".join(f"{c} ASC NULLS FIRST" for c in order.split())
    return f"""
        SELECT * EXCLUDE (nth) FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {by}) AS nth
            FROM {source} WHERE {where})
        WHERE nth = 1"""


_STATE_CASE = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(NATION_STATES))

RELATIONS = {
    # landing
    "landing_customers": f"""
        SELECT c_custkey::VARCHAR AS customer_id, c_name AS customer_unique_id,
               c_custkey::VARCHAR AS zip_code_prefix, ' ' || lower(n_name) || ' ' AS city,
               CASE c_nationkey {_STATE_CASE} END AS state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "landing_products": """
        SELECT p_partkey::VARCHAR AS product_id, lower(p_brand) AS category_name,
               length(p_name)::INTEGER AS name_length, (10 * length(p_name))::INTEGER AS description_length,
               1 + p_size % 10 AS photos_qty, p_size - 1 AS weight_g,
               p_size AS length_cm, p_size + 5 AS height_cm, p_size + 8 AS width_cm
        FROM part""",
    "landing_categories": """
        SELECT DISTINCT lower(p_brand) AS product_category_name, upper(p_brand) AS product_category_name_english
        FROM part WHERE lower(p_brand) <> 'brand#25'""",
    "landing_dated": """
        SELECT o_orderkey AS k, o_custkey, o_orderdate + to_seconds(7919 * o_orderkey % 86400) AS bought,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    ELSE CASE left(o_orderpriority, 1) WHEN '1' THEN 'approved' WHEN '2' THEN 'invoiced'
                         WHEN '3' THEN 'processing' WHEN '4' THEN 'canceled' WHEN '5' THEN 'unknown' END
               END AS status
        FROM orders""",
    "landing_approved": """
        SELECT *, CASE WHEN status <> 'canceled' THEN bought + to_hours(1 + 31 * k % 48) END AS approved
        FROM landing_dated""",
    "landing_sent": """
        SELECT *, CASE WHEN status IN ('delivered', 'shipped')
                       THEN approved + to_days((1 + 17 * k % 5)::INTEGER) END AS sent
        FROM landing_approved""",
    "landing_orders": """
        SELECT k::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id, status AS order_status,
               bought AS purchase_timestamp, approved AS approved_at, sent AS delivered_carrier_date,
               CASE WHEN status = 'delivered' THEN sent + to_days((1 + 11 * k % 15)::INTEGER) END
                   AS delivered_customer_date,
               bought + to_days((5 + 13 * k % 26)::INTEGER) AS estimated_delivery_date
        FROM landing_sent""",
    "landing_items": """
        SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS order_item_id, l_partkey::VARCHAR AS product_id,
               l_suppkey::VARCHAR AS seller_id, l_shipdate AS shipping_limit_date,
               l_extendedprice::DECIMAL(12,2) AS price,
               l_extendedprice::DECIMAL(12,2) * l_tax::DECIMAL(4,2) AS freight_value
        FROM lineitem""",
    "landing_payments": """
        SELECT l_orderkey::VARCHAR AS order_id,
               CASE kind WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3
                    WHEN 'NO' THEN 4 WHEN 'RF' THEN 5 WHEN 'RO' THEN 6 END AS payment_sequential,
               CASE kind WHEN 'AF' THEN 'credit_card' WHEN 'AO' THEN 'boleto' WHEN 'NF' THEN 'voucher'
                    WHEN 'NO' THEN 'debit_card' WHEN 'RF' THEN 'credit_card' WHEN 'RO' THEN 'crypto' END
                   AS payment_type,
               count(*)::INTEGER AS payment_installments, sum(l_extendedprice::DECIMAL(12,2)) AS payment_value
        FROM (SELECT *, l_returnflag || l_linestatus AS kind FROM lineitem)
        GROUP BY l_orderkey, kind""",
    # cleaned
    "clean_customers": f"""
        SELECT customer_id, customer_unique_id,
               CASE WHEN length(zip_code_prefix) < 8 THEN lpad(zip_code_prefix, 8, '0')
                    ELSE zip_code_prefix END AS zip_code_prefix,
               upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) AS city,
               upper(trim(state)) AS state
        FROM ({_first_by("landing_customers", "customer_id",
                         "customer_unique_id zip_code_prefix city state", "customer_id IS NOT NULL")})
        WHERE upper(trim(state)) IN {_in(STATES)}""",
    "clean_orders": _first_by(
        "landing_orders",
        "order_id",
        "customer_id order_status purchase_timestamp approved_at delivered_carrier_date"
        " delivered_customer_date estimated_delivery_date",
        "order_id IS NOT NULL AND customer_id IS NOT NULL AND purchase_timestamp IS NOT NULL",
    )
    + f" AND order_status IN {_in(ORDER_STATUSES)}",
    "clean_products": _first_by(
        "landing_products",
        "product_id",
        "category_name name_length description_length photos_qty weight_g length_cm height_cm width_cm",
        "product_id IS NOT NULL",
    )
    + " AND weight_g > 0",
    "clean_items": _first_by(
        "landing_items",
        "order_id, order_item_id",
        "product_id seller_id shipping_limit_date price freight_value",
        "order_id IS NOT NULL AND product_id IS NOT NULL",
    )
    + " AND price > 0 AND freight_value >= 0",
    "clean_payments": _first_by(
        "landing_payments",
        "order_id, payment_sequential",
        "payment_type payment_installments payment_value",
        "order_id IS NOT NULL",
    )
    + f" AND payment_type IN {_in(PAYMENT_TYPES)} AND payment_value > 0",
    # loaded
    "raw_customers": "SELECT *, NULL::TIMESTAMP AS created_at FROM clean_customers",
    "raw_orders": "SELECT *, NULL::TIMESTAMP AS created_at FROM clean_orders",
    "raw_products": """
        SELECT * REPLACE (weight_g::DECIMAL(10,2) AS weight_g, length_cm::DECIMAL(8,2) AS length_cm,
                          height_cm::DECIMAL(8,2) AS height_cm, width_cm::DECIMAL(8,2) AS width_cm),
               NULL::TIMESTAMP AS created_at
        FROM clean_products""",
    "raw_items": """
        SELECT * REPLACE (freight_value::DECIMAL(12,2) AS freight_value), NULL::TIMESTAMP AS created_at
        FROM clean_items""",
    "raw_payments": """
        SELECT * REPLACE (payment_value::DECIMAL(12,2) AS payment_value), NULL::TIMESTAMP AS created_at
        FROM clean_payments""",
    # bronze
    "bronze_customers": "SELECT * FROM raw_customers WHERE customer_id IS NOT NULL",
    "bronze_orders": """
        SELECT * FROM raw_orders
        WHERE order_id IS NOT NULL AND purchase_timestamp >= TIMESTAMP '1996-01-01 00:00:00'""",
    "bronze_items": """
        SELECT *, price + freight_value AS item_total FROM raw_items WHERE order_id IS NOT NULL AND price > 0""",
    "bronze_payments": "SELECT * FROM raw_payments WHERE order_id IS NOT NULL AND payment_value > 0",
    "bronze_products": """
        SELECT p.* EXCLUDE (category_name), category_name,
               coalesce(product_category_name_english, category_name) AS category_name_english
        FROM raw_products p LEFT JOIN landing_categories ON category_name = product_category_name
        WHERE product_id IS NOT NULL""",
    # lake
    "lake_orders": """
        SELECT o.*, items_total, freight_total, items_count, payment_total, main_payment_type, max_installments,
               items_total + freight_total AS order_total,
               date_sub('day', purchase_timestamp, delivered_customer_date) AS delivery_days,
               delivered_customer_date <= estimated_delivery_date AS delivered_on_time,
               year(purchase_timestamp)::INTEGER AS purchase_year,
               month(purchase_timestamp)::INTEGER AS purchase_month
        FROM clean_orders o
        LEFT JOIN (SELECT order_id, sum(price)::DOUBLE AS items_total, sum(freight_value)::DOUBLE AS freight_total,
                          count(order_item_id) AS items_count
                   FROM clean_items GROUP BY order_id) i USING (order_id)
        LEFT JOIN (SELECT order_id, sum(payment_value)::DOUBLE AS payment_total,
                          arg_min(payment_type, payment_sequential) AS main_payment_type,
                          max(payment_installments) AS max_installments
                   FROM clean_payments GROUP BY order_id) p USING (order_id)""",
    "lake_spend": """
        SELECT customer_id, count(order_id) AS total_orders, coalesce(sum(order_value), 0)::DOUBLE AS total_spent,
               sum(order_value)::DOUBLE / nullif(count(order_value), 0) AS avg_ticket,
               max(purchase_timestamp) AS last_order_date, min(purchase_timestamp) AS first_order_date
        FROM clean_orders
        LEFT JOIN (SELECT order_id, sum(price) AS order_value FROM clean_items GROUP BY order_id) v USING (order_id)
        WHERE order_status = 'delivered' GROUP BY customer_id""",
    "lake_customers": """
        SELECT c.*, total_orders, total_spent, avg_ticket, last_order_date, first_order_date,
               total_orders > 1 AS is_recurring,
               CASE WHEN total_orders IS NULL THEN NULL WHEN total_spent >= 1000000 THEN 'high_value'
                    WHEN total_spent >= 300000 THEN 'medium_value' ELSE 'low_value' END AS customer_segment
        FROM clean_customers c LEFT JOIN lake_spend s USING (customer_id)""",
    "lake_products": """
        SELECT product_id, category_name, name_length, description_length, photos_qty,
               weight_g::DOUBLE AS weight_g, length_cm::DOUBLE AS length_cm, height_cm::DOUBLE AS height_cm,
               width_cm::DOUBLE AS width_cm, coalesce(units_sold, 0) AS units_sold,
               coalesce(total_revenue, 0)::DOUBLE AS total_revenue, coalesce(avg_price, 0)::DOUBLE AS avg_price,
               product_category_name_english
        FROM clean_products
        LEFT JOIN (SELECT product_id, count(*) AS units_sold, sum(price) AS total_revenue,
                          sum(price)::DOUBLE / count(price) AS avg_price
                   FROM clean_items
                   WHERE order_id IN (SELECT order_id FROM clean_orders WHERE order_status = 'delivered')
                   GROUP BY product_id) m USING (product_id)
        LEFT JOIN landing_categories ON category_name = product_category_name""",
    # silver
    "silver_customers": """
        SELECT c.* EXCLUDE (created_at), coalesce(n, 0) AS total_orders, coalesce(spent, 0) AS total_spent,
               coalesce(ticket, 0)::DOUBLE AS avg_ticket, first_order_at, last_order_at,
               coalesce(n, 0) > 1 AS is_recurring,
               CASE WHEN coalesce(spent, 0) >= 1000000 THEN 'high_value'
                    WHEN coalesce(spent, 0) >= 300000 THEN 'medium_value'
                    WHEN coalesce(spent, 0) > 0 THEN 'low_value' ELSE 'no_purchase' END AS customer_segment,
               c.created_at
        FROM bronze_customers c
        LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS n, sum(price) AS spent,
                          sum(price)::DOUBLE / count(price) AS ticket,
                          min(purchase_timestamp) AS first_order_at, max(purchase_timestamp) AS last_order_at
                   FROM bronze_orders JOIN bronze_items USING (order_id)
                   WHERE order_status = 'delivered' GROUP BY customer_id) s USING (customer_id)""",
    "silver_orders": """
        SELECT o.* EXCLUDE (created_at),
               date_trunc('month', purchase_timestamp)::DATE AS purchase_month,
               year(purchase_timestamp)::INTEGER AS purchase_year,
               month(purchase_timestamp)::INTEGER AS purchase_month_num,
               dayofweek(purchase_timestamp)::INTEGER AS purchase_dow,
               coalesce(items_total, 0) AS items_total, coalesce(freight_total, 0) AS freight_total,
               coalesce(order_subtotal, 0) AS order_subtotal, coalesce(payment_total, 0) AS payment_total,
               coalesce(items_count, 0) AS items_count, main_payment_type,
               coalesce(max_installments, 1) AS max_installments,
               round(date_diff('microsecond', purchase_timestamp, delivered_customer_date)
                     / 86400000000.0)::INTEGER AS delivery_days,
               delivered_customer_date <= estimated_delivery_date AS delivered_on_time, o.created_at
        FROM bronze_orders o
        LEFT JOIN (SELECT order_id, count(*) AS items_count, sum(price) AS items_total,
                          sum(freight_value) AS freight_total, sum(item_total) AS order_subtotal
                   FROM bronze_items GROUP BY order_id) i USING (order_id)
        LEFT JOIN (SELECT order_id, sum(payment_value) AS payment_total,
                          max(payment_installments) AS max_installments,
                          first(payment_type ORDER BY payment_value DESC, payment_sequential) AS main_payment_type
                   FROM bronze_payments GROUP BY order_id) p USING (order_id)""",
    "silver_items": """
        SELECT i.* EXCLUDE (created_at), category_name, category_name_english, weight_g, order_status,
               purchase_timestamp, customer_id, date_trunc('month', purchase_timestamp)::DATE AS purchase_month,
               i.created_at
        FROM bronze_items i
        LEFT JOIN bronze_orders USING (order_id) LEFT JOIN bronze_products USING (product_id)""",
    # gold
    "delivered": "SELECT * FROM silver_orders WHERE order_status = 'delivered' AND items_total > 0",
    "gold_months": """
        SELECT purchase_month, purchase_year, purchase_month_num, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT customer_id) AS unique_customers, sum(items_total)::DOUBLE AS total_revenue,
               sum(freight_total)::DOUBLE AS total_freight, sum(payment_total)::DOUBLE AS total_payment,
               sum(items_total)::DOUBLE / count(*) AS avg_ticket,
               sum(items_count)::DOUBLE / count(*) AS avg_items_per_order,
               sum(CASE WHEN delivered_on_time THEN 1 ELSE 0 END)::DOUBLE
                   / nullif(count(delivered_on_time), 0) AS on_time_delivery_rate,
               sum(delivery_days)::DOUBLE / count(delivery_days) AS avg_delivery_days
        FROM delivered GROUP BY ALL""",
    "gold_categories": """
        SELECT category_name_english AS category, category_name AS category_pt,
               count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
               sum(price)::DOUBLE AS total_revenue, sum(price)::DOUBLE / count(price) AS avg_price,
               count(*) AS units_sold,
               round(100.0::DOUBLE * sum(price)::DOUBLE
                     / nullif((sum(sum(price)) OVER ())::DOUBLE, 0), 2) AS revenue_share_pct
        FROM silver_items WHERE order_status = 'delivered' AND category_name IS NOT NULL
        GROUP BY category_name_english, category_name""",
    "gold_states": """
        SELECT state, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT o.customer_id) AS unique_customers, sum(items_total)::DOUBLE AS total_revenue,
               sum(items_total)::DOUBLE / count(*) AS avg_ticket, sum(freight_total)::DOUBLE AS total_freight,
               round(100.0::DOUBLE * sum(items_total)::DOUBLE
                     / nullif((sum(sum(items_total)) OVER ())::DOUBLE, 0), 2) AS revenue_share_pct
        FROM delivered o JOIN silver_customers c ON o.customer_id = c.customer_id GROUP BY state""",
    "product_sales": """
        SELECT i.product_id, p.category_name_english AS category, count(DISTINCT order_id) AS total_orders,
               sum(price) AS revenue, count(*) AS units_sold, sum(price)::DOUBLE / count(price) AS avg_price,
               min(price)::DOUBLE AS min_price, max(price)::DOUBLE AS max_price
        FROM silver_items i LEFT JOIN bronze_products p ON i.product_id = p.product_id
        WHERE order_status = 'delivered' GROUP BY 1, 2""",
    "gold_products": """
        SELECT product_id, category, total_orders, revenue::DOUBLE AS total_revenue, units_sold, avg_price,
               min_price, max_price, rank() OVER (ORDER BY revenue DESC) AS revenue_rank,
               rank() OVER (ORDER BY units_sold DESC) AS units_rank
        FROM product_sales ORDER BY revenue_rank, product_id LIMIT 100""",
    "gold_customers": """
        SELECT customer_id, city, state, customer_segment, is_recurring, total_orders,
               total_spent::DOUBLE AS total_spent, avg_ticket, first_order_at, last_order_at,
               date_sub('day', last_order_at, TIMESTAMP '2001-12-31 00:00:00')::INTEGER AS days_since_last_order,
               date_sub('day', first_order_at, last_order_at)::INTEGER AS customer_lifespan_days,
               rank() OVER (ORDER BY c.total_spent DESC) AS spending_rank
        FROM silver_customers c WHERE total_orders > 0 ORDER BY spending_rank, customer_id LIMIT 100""",
    "monthly": "SELECT purchase_month, sum(items_total) AS revenue FROM delivered GROUP BY purchase_month",
    "growth": """
        SELECT purchase_month, revenue::DOUBLE AS monthly_revenue, before::DOUBLE AS prev_month_revenue,
               round(100.0::DOUBLE * (revenue - before)::DOUBLE / nullif(before::DOUBLE, 0), 2) AS mom_growth_pct
        FROM (SELECT *, lag(revenue) OVER (ORDER BY purchase_month) AS before FROM monthly)""",
    "gold_panel": """
        SELECT (SELECT sum(items_total)::DOUBLE FROM delivered) AS total_revenue,
               (SELECT sum(items_total)::DOUBLE / count(*) FROM delivered) AS overall_avg_ticket,
               (SELECT count(DISTINCT order_id) FROM delivered) AS total_orders,
               (SELECT count(DISTINCT customer_id) FROM delivered) AS total_customers,
               (SELECT round(100.0::DOUBLE * count(CASE WHEN is_recurring THEN 1 END) / nullif(count(*), 0), 2)
                FROM silver_customers WHERE total_orders > 0) AS recurring_customers_pct,
               (SELECT mom_growth_pct FROM growth ORDER BY purchase_month DESC LIMIT 1) AS last_month_growth_pct,
               (SELECT round(100.0::DOUBLE * count(CASE WHEN delivered_on_time THEN 1 END)
                             / nullif(count(delivered_on_time), 0), 2) FROM delivered) AS on_time_delivery_pct,
               (SELECT round(sum(delivery_days)::DOUBLE / count(delivery_days), 1) FROM delivered)
                   AS avg_delivery_days,
               (SELECT category FROM gold_categories ORDER BY total_revenue DESC, category LIMIT 1) AS top_category,
               (SELECT state FROM gold_states ORDER BY total_revenue DESC, state LIMIT 1) AS top_state,
               TIMESTAMP '2001-12-31 00:00:00' AS calculated_at""",
}


def statement(select: str) -> str:
    """``select`` with the relations it needs, directly or not, before it."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in RELATIONS.keys() & words - needed:
            needed.add(name)
            todo.append(RELATIONS[name])
    parts = [f"{name} AS ({sql})" for name, sql in RELATIONS.items() if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + select


_MONEY = {
    "items": "price::DOUBLE AS price, freight_value::DOUBLE AS freight_value",
    "products": "weight_g::DOUBLE AS weight_g, length_cm::DOUBLE AS length_cm, "
    "height_cm::DOUBLE AS height_cm, width_cm::DOUBLE AS width_cm",
    "payments": "payment_value::DOUBLE AS payment_value",
    "orders": "items_total::DOUBLE AS items_total, freight_total::DOUBLE AS freight_total, "
    "order_subtotal::DOUBLE AS order_subtotal, payment_total::DOUBLE AS payment_total",
}


def _all(relation: str, replace: str = "") -> str:
    return f"SELECT * {f'REPLACE ({replace})' if replace else ''} FROM {relation}"


def _numbered(relation: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM {relation}"


def _check(relation: str, model: str, column: str, test: str, broken: str) -> str:
    return f"""SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test,
        count(CASE WHEN {broken} THEN 1 END) AS failing_rows FROM {relation}"""


def _unique(relation: str, model: str, column: str) -> str:
    return f"""SELECT '{model}' AS model, '{column}' AS column_name, 'unique' AS test, count(*) AS failing_rows
        FROM (SELECT {column} FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""


# model: (relation, unique and not null, not null, accepted values, minimum)
_SOURCE_RULES = {
    "customers": ("raw_customers", ["customer_id"], ["state"], {}, {}),
    "orders": (
        "raw_orders",
        ["order_id"],
        ["customer_id", "order_status"],
        {"order_status": ORDER_STATUSES},
        {},
    ),
    "order_items": ("raw_items", [], ["order_id", "product_id", "price"], {}, {"price": "> 0"}),
    "order_payments": ("raw_payments", [], ["order_id"], {"payment_type": PAYMENT_TYPES}, {}),
    "products": ("raw_products", ["product_id"], [], {}, {}),
    "product_categories": ("landing_categories", ["product_category_name"], [], {}, {}),
}
_MODEL_RULES = {
    "bronze_customers": ("bronze_customers", ["customer_id"], [], {}, {}),
    "bronze_orders": ("bronze_orders", ["order_id"], [], {}, {}),
    "bronze_order_items": ("bronze_items", [], ["order_id"], {}, {"item_total": "> 0"}),
    "bronze_order_payments": ("bronze_payments", [], ["order_id"], {}, {}),
    "bronze_products": ("bronze_products", ["product_id"], [], {}, {}),
    "silver_customers": ("silver_customers", ["customer_id"], [], {"customer_segment": SEGMENTS}, {}),
    "silver_orders": ("silver_orders", ["order_id"], [], {"order_status": ORDER_STATUSES}, {}),
    "silver_order_items": ("silver_items", [], ["order_id", "product_id"], {}, {}),
    "gold_revenue_by_month": ("gold_months", ["purchase_month"], [], {}, {"total_revenue": ">= 0"}),
    "gold_revenue_by_category": ("gold_categories", ["category"], [], {}, {}),
    "gold_revenue_by_state": ("gold_states", ["state"], [], {}, {}),
    "gold_top_products": ("gold_products", ["product_id"], [], {}, {}),
    "gold_top_customers": ("gold_customers", ["customer_id"], [], {}, {}),
}
_LANDING_RULES = {
    model: (f"landing_{relation.split('_')[1]}", *rules)
    for model, (relation, *rules) in _SOURCE_RULES.items()
}


def _report(rules: dict, *tests: str) -> str:
    lines = []
    for model, (relation, keys, required, values, minimum) in rules.items():
        lines += [_unique(relation, model, c) for c in keys if "unique" in tests]
        if "not_null" in tests:
            lines += [_check(relation, model, c, "not_null", f"{c} IS NULL") for c in keys + required]
        if "accepted_values" in tests:
            lines += [
                _check(relation, model, c, "accepted_values", f"{c} NOT IN {_in(v)}") for c, v in values.items()
            ]
        if "accepted_range" in tests:
            lines += [_check(relation, model, c, "accepted_range", f"NOT {c} {m}") for c, m in minimum.items()]
    return f"SELECT *, failing_rows = 0 AS passed FROM ({' UNION ALL '.join(lines)})"


_ALL_RULES = {**_SOURCE_RULES, **_MODEL_RULES}
_KINDS = ("unique", "not_null", "accepted_values", "accepted_range")


def _audit() -> str:
    tables = {
        "customers": "customers", "orders": "orders", "products": "products",
        "order_items": "items", "order_payments": "payments",
    }
    lines = [
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM landing_{r}) AS rows_in,"
        f" (SELECT count(*) FROM clean_{r}) AS rows_out"
        for t, r in tables.items()
    ]
    return f"SELECT *, rows_in - rows_out AS rows_removed FROM ({' UNION ALL '.join(lines)})"


# The first load has all states but TO, the second all but SP, with other city names:
# SP customers stay, TO customers are new, all others are updated and keep their load time.
_UPSERT_CUSTOMERS = """
    SELECT customer_id, customer_unique_id, zip_code_prefix,
           CASE WHEN state = 'SP' THEN city ELSE city || ' (moved)' END AS city, state,
           CASE WHEN state = 'TO' THEN TIMESTAMP '2001-02-01 00:00:00'
                ELSE TIMESTAMP '2001-01-01 00:00:00' END AS created_at
    FROM clean_customers"""
# The first load has the orders bought before 1999, all still in processing, the
# second those bought since 1998 as they ended.
_UPSERT_ORDERS = """
    SELECT * REPLACE (CASE WHEN purchase_timestamp < TIMESTAMP '1998-01-01 00:00:00'
                           THEN 'processing' ELSE order_status END AS order_status)
    FROM raw_orders"""

_CSV_ITEMS = """
    SELECT * REPLACE (strftime(shipping_limit_date, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
                      order_item_id::VARCHAR AS order_item_id,
                      price::DOUBLE AS price, freight_value::DOUBLE AS freight_value)
    FROM clean_items"""

SELECTS = {
    "clean_customers": _all("clean_customers"),
    "clean_orders": _all("clean_orders"),
    "clean_products": _all("clean_products", _MONEY["products"]),
    "clean_order_items": _all("clean_items", _MONEY["items"]),
    "clean_order_payments": _all("clean_payments", _MONEY["payments"]),
    "clean_product_categories": _all("landing_categories"),
    "clean_audit": _audit(),
    "load_customers": _all("raw_customers"),
    "load_orders": _all("raw_orders"),
    "load_products": _all("raw_products", _MONEY["products"]),
    "load_order_items": _all("raw_items", _MONEY["items"]),
    "load_order_payments": _all("raw_payments", _MONEY["payments"]),
    "load_product_categories": _all("landing_categories"),
    "bronze_customers": _all("bronze_customers"),
    "bronze_orders": _all("bronze_orders"),
    "bronze_order_items": _all("bronze_items", _MONEY["items"] + ", item_total::DOUBLE AS item_total"),
    "bronze_order_payments": _all("bronze_payments", _MONEY["payments"]),
    "bronze_products": _all("bronze_products", _MONEY["products"]),
    "lake_orders_enriched": _all("lake_orders"),
    "lake_customers_enriched": _all("lake_customers"),
    "lake_products_enriched": _all("lake_products"),
    "lake_order_items": _all("clean_items", _MONEY["items"]),
    "silver_customers": _all("silver_customers", "total_spent::DOUBLE AS total_spent"),
    "silver_orders": _all("silver_orders", _MONEY["orders"]),
    "silver_order_items": _all(
        "silver_items",
        _MONEY["items"] + ", item_total::DOUBLE AS item_total, weight_g::DOUBLE AS weight_g",
    ),
    "gold_revenue_by_month": _all("gold_months"),
    "gold_revenue_by_category": _all("gold_categories"),
    "gold_revenue_by_state": _all("gold_states"),
    "gold_top_products": _all("gold_products"),
    "gold_top_customers": _all("gold_customers"),
    "gold_kpis": _all("gold_panel"),
    "monthly_growth": _all("growth"),
    "dq_not_null": _report(_ALL_RULES, "not_null"),
    "dq_unique": _report(_ALL_RULES, "unique"),
    "dq_accepted_values": _report(_ALL_RULES, "accepted_values"),
    "dq_accepted_range": _report(_ALL_RULES, "accepted_range"),
    "dq_report": _report(_ALL_RULES, *_KINDS),
    "dq_landing": _report(_LANDING_RULES, *_KINDS),
    "dq_referential": "SELECT *, failing_rows = 0 AS passed FROM ("
    + _check(
        "raw_orders",
        "orders",
        "customer_id",
        "relationship",
        "customer_id NOT IN (SELECT customer_id FROM raw_customers)",
    )
    + ")",
    "upsert_customers": _UPSERT_CUSTOMERS,
    "upsert_orders": _UPSERT_ORDERS,
    "upsert_order_items": _all("raw_items", _MONEY["items"]),
    "upsert_order_payments": _all("raw_payments", _MONEY["payments"]),
    "kpi_total_revenue": "SELECT total_revenue FROM gold_panel",
    "kpi_avg_ticket": "SELECT overall_avg_ticket FROM gold_panel",
    "kpi_orders_customers": "SELECT total_orders, total_customers FROM gold_panel",
    "kpi_on_time_pct": "SELECT on_time_delivery_pct FROM gold_panel",
    "kpi_avg_delivery_days": "SELECT avg_delivery_days FROM gold_panel",
    "kpi_recurring_pct": "SELECT recurring_customers_pct FROM gold_panel",
    "top10_categories": """
        SELECT category, total_revenue, units_sold FROM gold_categories
        ORDER BY total_revenue DESC, category LIMIT 10""",
    "top10_states": """
        SELECT state, total_revenue, total_orders FROM gold_states ORDER BY total_revenue DESC, state LIMIT 10""",
    "top10_products": """
        SELECT product_id, category, total_revenue, units_sold, revenue_rank FROM gold_products
        ORDER BY revenue_rank, product_id LIMIT 10""",
    "top10_customers": """
        SELECT customer_id, city, state, total_spent, total_orders, spending_rank FROM gold_customers
        ORDER BY spending_rank, customer_id LIMIT 10""",
    "category_market_share": "SELECT category, category_pt, total_revenue, revenue_share_pct FROM gold_categories",
    "csv_ingest": _CSV_ITEMS,
    "csv_rejected": """
        SELECT 'order_items' AS table_name, count(*) AS broken_lines FROM landing_items WHERE order_item_id = 7
        HAVING count(*) > 0""",
    "csv_multiline": """
        SELECT * REPLACE (trim(city) || chr(10) || '"' || state || '"' AS city) FROM landing_customers""",
    "run_clean_customers": _all("clean_customers"),
    "run_lake_customers": _all("lake_customers"),
    "run_audit": _audit(),
    "ordered_revenue_by_month": _numbered("gold_months", "purchase_month"),
    "ordered_revenue_by_category": _numbered("gold_categories", "total_revenue DESC NULLS LAST, category"),
    "ordered_revenue_by_state": _numbered("gold_states", "total_revenue DESC NULLS LAST, state"),
    "ordered_top_products": _numbered("gold_products", "revenue_rank, product_id"),
    "ordered_top_customers": _numbered("gold_customers", "spending_rank, customer_id"),
    "incremental_ingest": _all("raw_orders"),
    "maintained_silver_orders": _all("silver_orders", _MONEY["orders"]),
    "maintained_revenue_by_month": _all("gold_months"),
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(select) for name, select in SELECTS.items()}
