"""Independent SQL for every registered query, run by another engine on the same tables.

Two spellings are fixed on both sides, since averages of cents often lie exactly between two
roundings: an average is an exact sum over a count, and an average of averages is taken over
values cut to ten places.
"""

from __future__ import annotations

from collections.abc import Iterable

from tillmark.config import LOCATION_CODES, MENU_QUADRANTS, ORDER_TYPES, OTHER_QUADRANT
from tillmark.sources.star import MARK, PRICE_PERIODS, RULES, SITES, UNKNOWN_STEP


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _texts(values: Iterable[str]) -> str:
    return ", ".join(map(_text, values))


_SITE = "CASE r_regionkey " + " ".join(
    f"WHEN {key} THEN {_text(code)}" for key, code in enumerate(SITES)
) + " END"


def _quadrant(field: int, other: str) -> str:
    """The class (2) or the recommendation (3) of an item."""
    cases = " ".join(
        f"WHEN total_units_sold {'>=' if q[0] else '<'} avg_units"
        f" AND avg_margin_pct {'>=' if q[1] else '<'} avg_margin THEN {_text(q[field])}"
        for q in MENU_QUADRANTS
    )
    return f"CASE {cases} ELSE {_text(other)} END"


_PERIODS = ", ".join(
    f"({n}, CAST({factor} AS DOUBLE), CAST({_text(since)} AS DATE), CAST({_text(until)} AS DATE))"
    for n, factor, since, until in PRICE_PERIODS
)

_RAW = f"""
raw_orders AS (
  SELECT 'O-' || o_orderkey AS order_id,
    CASE WHEN o_orderkey % 1009 = 0 THEN NULL
         WHEN o_orderkey % 503 = 7 THEN 'LOC-XXX'
         ELSE {_SITE} END AS location_id,
    r_name AS location_name,
    CAST(o_orderdate AS DATE) AS order_date,
    printf('%02d:%02d:%02d', (o_orderkey * 7919 % 86400) // 3600,
           (o_orderkey * 7919 % 3600) // 60, o_orderkey * 7919 % 60) AS order_time,
    CASE WHEN o_orderkey % 401 = 3 THEN 'Curbside'
         WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Delivery'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'Takeout'
         ELSE 'Dine-In' END AS order_type,
    'C-' || (o_custkey % 100) AS cashier_id,
    round(o_totalprice / 1.13, 2) AS subtotal,
    round(o_totalprice * (o_orderkey % 5) / 100, 2) AS discount_amount,
    round(o_totalprice - o_totalprice / 1.13
          + CASE WHEN o_orderkey % 97 = 0 THEN 0.5 ELSE 0.0 END, 2) AS tax_amount,
    o_totalprice AS total_amount,
    CASE o_custkey % 3 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Card' ELSE 'App' END AS payment_method,
    o_orderstatus = 'F' AS is_refund
  FROM orders
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
),
raw_orders_resent AS (
  SELECT * FROM raw_orders
  UNION ALL
  SELECT * FROM raw_orders WHERE order_date >= DATE '2001-06-15'
),
raw_order_items AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_item_id,
    'O-' || l_orderkey AS order_id,
    'I-' || l_partkey AS item_id,
    p_name AS item_name, p_type AS category,
    CASE WHEN p_size <= 16 THEN 'S' WHEN p_size <= 33 THEN 'M' ELSE 'L' END AS size,
    CASE WHEN l_partkey % 211 = 5 AND l_linenumber = 1 THEN 0
         ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    round(l_extendedprice / l_quantity, 2) AS unit_price,
    round(l_extendedprice * l_discount, 2) AS discount_applied,
    CASE WHEN l_quantity = 13 AND l_linenumber = 2 THEN 0.0
         ELSE round(l_extendedprice * (1 - l_discount), 2) END AS line_total,
    CASE WHEN l_discount > 0
         THEN 'P-' || CAST(round(l_discount * 100) AS INTEGER) END AS promo_id
  FROM lineitem JOIN part ON p_partkey = l_partkey
),
raw_menu AS (
  SELECT CASE WHEN p_brand <> 'Brand#13' THEN 'I-' || p_partkey END AS item_id,
    p_name AS item_name, p_type AS category, p_brand AS subcategory,
    CASE WHEN p_size <= 16 THEN 'S' WHEN p_size <= 33 THEN 'M' ELSE 'L' END AS size,
    p_retailprice AS selling_price,
    round(p_retailprice * CASE WHEN p_partkey % 89 = 0 THEN 0.5 ELSE 0.3 END, 2) AS cost_price,
    p_partkey % 20 <> 0 AS is_active
  FROM part
),
raw_history AS (
  SELECT concat_ws('-', item_id, n) AS price_history_id, item_id,
    round(selling_price * factor, 2) AS selling_price,
    round(cost_price * factor, 2) AS cost_price,
    since AS effective_from, until AS effective_to, until IS NULL AS is_current,
    'repricing' AS change_reason
  FROM raw_menu, (VALUES {_PERIODS}) AS t(n, factor, since, until)
),
raw_promotions AS (
  SELECT DISTINCT CAST(round(l_discount * 100) AS INTEGER) AS step FROM lineitem
  WHERE l_discount > 0 AND CAST(round(l_discount * 100) AS INTEGER) <> {UNKNOWN_STEP}
)"""

_SRC = f"""
src_orders AS (
  SELECT order_id, location_id, location_name, order_date, order_time, order_type, cashier_id,
    CAST(subtotal AS DECIMAL(10,2)) AS subtotal,
    CAST(discount_amount AS DECIMAL(10,2)) AS discount_amount,
    CAST(tax_amount AS DECIMAL(10,2)) AS tax_amount,
    CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
    payment_method, is_refund
  FROM raw_orders
),
src_order_items AS (
  SELECT order_item_id, order_id, item_id, item_name, category, size, quantity,
    CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
    CAST(discount_applied AS DECIMAL(10,2)) AS discount_applied,
    CAST(line_total AS DECIMAL(10,2)) AS line_total,
    promo_id
  FROM raw_order_items
),
src_menu AS (
  SELECT item_id, item_name, category, subcategory, size,
    CAST(selling_price AS DECIMAL(10,2)) AS price,
    CAST(cost_price AS DECIMAL(10,2)) AS cost_price, is_active
  FROM raw_menu WHERE item_id IS NOT NULL
),
src_locations AS (
  SELECT {_SITE} AS location_id,
    r_name AS location_name, '1 Main St' AS address,
    CAST(40 + 10 * r_regionkey AS INTEGER) AS seating_capacity,
    DATE '1994-01-01' AS opened_date, r_name AS manager_name, '555-0100' AS phone,
    TRUE AS is_active
  FROM region
),
src_history AS (
  SELECT price_history_id, item_id,
    CAST(selling_price AS DECIMAL(10,2)) AS selling_price,
    CAST(cost_price AS DECIMAL(10,2)) AS cost_price,
    effective_from, effective_to, is_current, change_reason
  FROM raw_history
),
src_promotions AS (
  SELECT 'P-' || step AS promo_id, step || ' percent off' AS promo_name,
    'percent' AS discount_type, CAST(step AS DECIMAL(10,2)) AS discount_value,
    'all' AS applies_to, DATE '1995-01-01' AS start_date, DATE '2001-12-31' AS end_date,
    CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS VARCHAR) AS day_of_week
  FROM raw_promotions
)"""

_SILVER = f"""
calendar AS (
  SELECT *, md5(order_id) AS surrogate_key,
    CAST(year(order_date) AS INTEGER) AS order_year,
    CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(weekofyear(order_date) AS INTEGER) AS order_week,
    CAST(dayofweek(order_date) AS INTEGER) AS day_of_week,
    dayname(order_date) AS day_name,
    isodow(order_date) IN (5, 6) AS is_weekend,
    CAST(hour(CAST(order_time AS TIME)) AS INTEGER) AS order_hour
  FROM src_orders
),
stg_orders AS (
  SELECT surrogate_key, order_id, location_id, location_name, order_date, order_time,
    order_year, order_month, order_week, day_of_week, day_name, is_weekend, order_hour,
    CASE WHEN order_hour >= 11 AND order_hour < 15 THEN 'Lunch'
         WHEN order_hour >= 15 AND order_hour < 17 THEN 'Afternoon'
         WHEN order_hour >= 17 AND order_hour < 22 THEN 'Dinner'
         ELSE 'Late Night' END AS day_part,
    order_type, cashier_id, subtotal, discount_amount, tax_amount, total_amount,
    payment_method, is_refund
  FROM calendar
  WHERE order_id IS NOT NULL
    AND location_id IN ({_texts(LOCATION_CODES)})
),
sales AS (SELECT * FROM stg_orders WHERE NOT is_refund),
costed AS (
  SELECT l.*, o.location_id, o.location_name, o.order_date, o.is_refund,
    m.subcategory, m.cost_price,
    CAST(m.cost_price * l.quantity AS DECIMAL(18,2)) AS total_cost,
    CAST(l.line_total - m.cost_price * l.quantity AS DECIMAL(18,2)) AS gross_profit
  FROM src_order_items l
  JOIN sales o USING (order_id)
  LEFT JOIN src_menu m USING (item_id)
  WHERE l.quantity > 0
),
stg_order_items AS (
  SELECT md5(order_item_id) AS surrogate_key, order_item_id, order_id, location_id,
    location_name, order_date, is_refund, item_id, item_name, category, subcategory, size,
    quantity, unit_price, cost_price, total_cost, discount_applied, line_total, gross_profit,
    CASE WHEN line_total > 0
         THEN round(CAST(gross_profit AS DOUBLE) / CAST(line_total AS DOUBLE) * 100, 2)
         ELSE 0.0 END AS margin_pct,
    promo_id
  FROM costed
)"""

_GOLD = f"""
item_stats AS (
  SELECT item_id, item_name, category, subcategory, size,
    CAST(sum(quantity) AS BIGINT) AS total_units_sold,
    count(DISTINCT order_id) AS total_orders,
    sum(line_total) AS total_revenue,
    CAST(sum(gross_profit) AS DECIMAL(38,2)) AS total_gross_profit,
    round(CAST(sum(CAST(margin_pct AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(margin_pct), 0), 2)
      AS avg_margin_pct,
    round(CAST(sum(unit_price) AS DOUBLE) / nullif(count(unit_price), 0), 2) AS avg_selling_price,
    round(CAST(sum(cost_price) AS DOUBLE) / nullif(count(cost_price), 0), 2) AS avg_cost_price
  FROM stg_order_items
  GROUP BY ALL
),
menu_thresholds AS (
  SELECT CAST(sum(total_units_sold) AS DOUBLE) / count(total_units_sold) AS avg_units,
    CAST(sum(CAST(avg_margin_pct AS DECIMAL(18,2))) AS DOUBLE) / count(avg_margin_pct) AS avg_margin
  FROM item_stats
),
mart_menu_performance AS (
  SELECT *, {_quadrant(2, OTHER_QUADRANT[0])} AS menu_class,
    {_quadrant(3, OTHER_QUADRANT[1])} AS recommendation
  FROM item_stats, menu_thresholds
),
order_profit AS (
  SELECT order_id, CAST(sum(gross_profit) AS DECIMAL(38,2)) AS gross_profit,
    CAST(sum(CAST(margin_pct AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(margin_pct), 0)
      AS margin_pct
  FROM stg_order_items GROUP BY order_id
),
monthly_locations AS (
  SELECT location_id, location_name, order_year, order_month,
    count(DISTINCT order_id) AS total_orders,
    sum(total_amount) AS total_revenue,
    round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 2) AS avg_ticket,
    sum(discount_amount) AS total_discounts,
    CAST(sum(gross_profit) AS DECIMAL(38,2)) AS total_gross_profit,
    round(CAST(sum(CAST(margin_pct AS DECIMAL(20,10))) AS DOUBLE)
          / nullif(count(margin_pct), 0), 2) AS avg_margin_pct,
    count(DISTINCT order_id) FILTER (order_type = 'Dine-In') AS dine_in_orders,
    count(DISTINCT order_id) FILTER (order_type = 'Takeout') AS takeout_orders,
    count(DISTINCT order_id) FILTER (order_type = 'Delivery') AS delivery_orders
  FROM sales LEFT JOIN order_profit USING (order_id)
  GROUP BY location_id, location_name, order_year, order_month
),
mart_location_comparison AS (
  SELECT l.*, round(CAST(total_revenue AS DOUBLE) / nullif(CAST(month_revenue AS DOUBLE), 0) * 100, 2)
      AS revenue_share_pct
  FROM monthly_locations l
  JOIN (SELECT order_year, order_month, sum(total_revenue) AS month_revenue
        FROM monthly_locations GROUP BY ALL) USING (order_year, order_month)
),
monthly AS (
  SELECT location_id, location_name, order_year, order_month,
    count(DISTINCT order_id) AS total_orders,
    sum(total_amount) AS total_revenue,
    sum(discount_amount) AS total_discounts,
    round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 2) AS avg_ticket
  FROM sales
  GROUP BY location_id, location_name, order_year, order_month
),
mart_revenue_trends AS (
  SELECT *, round(CAST(total_revenue - prev_month_revenue AS DOUBLE)
                  / nullif(CAST(prev_month_revenue AS DOUBLE), 0) * 100, 2) AS mom_growth_pct
  FROM (
    SELECT *,
      lag(total_revenue) OVER (site ORDER BY order_year, order_month, location_name)
        AS prev_month_revenue,
      sum(total_revenue) OVER (PARTITION BY location_id, order_year
        ORDER BY order_month, location_name ROWS UNBOUNDED PRECEDING) AS ytd_revenue,
      sum(total_revenue) OVER (PARTITION BY order_year, order_month) AS all_locations_revenue
    FROM monthly
    WINDOW site AS (PARTITION BY location_id))
),
mart_time_analysis AS (
  SELECT location_id, location_name, order_year, order_month, day_of_week, day_name, is_weekend,
    order_hour, day_part,
    count(DISTINCT order_id) AS total_orders,
    sum(total_amount) AS total_revenue,
    round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 2) AS avg_ticket,
    sum(discount_amount) AS total_discounts
  FROM sales
  GROUP BY location_id, location_name, order_year, order_month, day_of_week, day_name, is_weekend,
    order_hour, day_part
)"""


def _day(text: str) -> str:
    return f"DATE '{text}'"


def _checks(orders: str) -> str:
    closed = ", ".join(_day(d) for d in RULES.closed_days)
    # (check, table, expected, count)
    checks = [
        ("orders_no_null_order_id", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE order_id IS NULL)"),
        ("orders_no_null_location", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE location_id IS NULL)"),
        ("orders_valid_locations", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE location_id NOT IN ({_texts(LOCATION_CODES)}))"),
        ("orders_valid_order_types", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE order_type NOT IN ({_texts(ORDER_TYPES)}))"),
        ("orders_tax_positive", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE NOT is_refund AND tax_amount < 0)"),
        ("orders_total_matches_subtotal", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE NOT is_refund"
         f" AND abs(total_amount - subtotal - tax_amount) > {RULES.total_tolerance})"),
        ("orders_no_future_dates", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE order_date > {_day(RULES.last_day)})"),
        ("orders_date_range_valid", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE order_date < {_day(RULES.first_day)})"),
        ("orders_not_on_closed_days", "bronze_orders", 0,
         f"(SELECT count(*) FROM {orders} WHERE order_date IN ({closed}))"),
        ("orders_no_duplicate_order_ids", "bronze_orders", 0,
         f"(SELECT count(*) - count(DISTINCT order_id) FROM {orders})"),
        ("items_no_null_order_id", "bronze_order_items", 0,
         "(SELECT count(*) FROM raw_order_items WHERE order_id IS NULL)"),
        ("items_quantity_positive", "bronze_order_items", 0,
         "(SELECT count(*) FROM raw_order_items WHERE quantity <= 0)"),
        ("items_price_in_range", "bronze_order_items", 0,
         "(SELECT count(*) FROM raw_order_items WHERE unit_price NOT BETWEEN"
         f" {RULES.lowest_price} AND {RULES.highest_price})"),
        ("items_no_null_item_id", "bronze_order_items", 0,
         "(SELECT count(*) FROM raw_order_items WHERE item_id IS NULL)"),
        ("items_valid_item_ids", "bronze_order_items", 0,
         "(SELECT count(*) FROM raw_order_items i WHERE NOT EXISTS"
         " (SELECT 1 FROM raw_menu m WHERE m.item_id = i.item_id))"),
        ("menu_47_items", "bronze_menu", RULES.menu_rows, "(SELECT count(*) FROM raw_menu)"),
        ("menu_cost_lt_price", "bronze_menu", 0,
         "(SELECT count(*) FROM raw_menu WHERE cost_price >= selling_price)"),
        ("menu_food_cost_reasonable", "bronze_menu", 0,
         "(SELECT count(*) FROM raw_menu WHERE cost_price / nullif(selling_price, 0)"
         f" > {RULES.highest_cost_ratio})"),
    ]
    rows = ",\n    ".join(f"('{name}', '{table}', {n}, {sql})" for name, table, n, sql in checks)
    return f"""
checks AS (
  SELECT name AS "check", tbl AS "table", CAST(n AS BIGINT) AS result,
    CAST(expected AS BIGINT) AS expected, CASE WHEN n = expected THEN 'PASS' ELSE 'FAIL' END AS status
  FROM (VALUES
    {rows}) AS t(name, tbl, expected, n)
)"""


_LAYERS = ",".join([_RAW, _SRC, _SILVER, _GOLD, _checks("raw_orders_resent")])


def _sql(select: str) -> str:
    return f"WITH {_LAYERS}\n{select}"


def _assertion(test: str, table: str, column: str, count: str) -> str:
    return (
        f"SELECT '{test}' AS test, '{table}' AS \"table\", '{column}' AS \"column\","
        f" CAST(({count}) AS BIGINT) AS violations"
    )


def _not_null(table: str, column: str) -> str:
    return _assertion("not_null", table, column, f"SELECT count(*) FROM {table} WHERE {column} IS NULL")


def _unique(table: str, column: str, source: str | None = None) -> str:
    return _assertion(
        "unique", table, column,
        f"SELECT count(*) FROM (SELECT {column} FROM {source or table} WHERE {column} IS NOT NULL"
        f" GROUP BY {column} HAVING count(*) > 1)",
    )


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


_COSTED_AS_OF = """
  SELECT l.*, h.price_then, h.cost_then
  FROM stg_order_items l
  LEFT JOIN (
    SELECT day.item_id, order_date, arg_max(selling_price, effective_from) AS price_then,
      arg_max(cost_price, effective_from) AS cost_then
    FROM (SELECT DISTINCT item_id, order_date FROM stg_order_items) day
    JOIN src_history p ON p.item_id = day.item_id
      AND order_date BETWEEN effective_from AND coalesce(effective_to, DATE '9999-12-31')
    GROUP BY ALL) h
  ON h.item_id = l.item_id AND h.order_date = l.order_date"""


def oracle_sql() -> dict[str, str]:
    mark = _day(MARK)
    months = "location_id, location_name, order_year, order_month"
    selects = {
        # sources
        "csv_scan": "SELECT * FROM src_orders",
        "src_orders": "SELECT * FROM src_orders",
        "src_order_items": "SELECT * FROM src_order_items",
        "src_menu": "SELECT * FROM src_menu",
        "src_locations": "SELECT * FROM src_locations",
        "src_promotions": "SELECT * FROM src_promotions",
        "src_menu_price_history": "SELECT * FROM src_history",
        "bronze_load": f"""
            SELECT *, CASE WHEN order_date > {mark} THEN '{MARK}' ELSE 'start' END AS batch_from
            FROM raw_orders""",
        "bronze_lines": f"""
            SELECT l.*, CASE WHEN order_date > {mark} THEN '{MARK}' ELSE 'start' END AS batch_from
            FROM raw_order_items l JOIN raw_orders USING (order_id)""",
        "load_state": """
            SELECT t AS "table", d AS high_water
            FROM (SELECT max(order_date) AS d FROM raw_orders),
                 (VALUES ('orders'), ('order_items')) AS v(t)""",
        "rebuild_table": "SELECT * FROM stg_orders",
        "load_audit": _union(
            *[
                f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {table}"
                for name, table in [
                    ("bronze_orders", "raw_orders"),
                    ("bronze_order_items", "raw_order_items"),
                    ("bronze_menu", "raw_menu"),
                    ("bronze_locations", "src_locations"),
                    ("bronze_promotions", "raw_promotions"),
                    ("bronze_menu_price_history", "raw_history"),
                    ("stg_orders", "stg_orders"),
                    ("stg_order_items", "stg_order_items"),
                    ("mart_menu_performance", "mart_menu_performance"),
                    ("mart_location_comparison", "mart_location_comparison"),
                    ("mart_revenue_trends", "mart_revenue_trends"),
                    ("mart_time_analysis", "mart_time_analysis"),
                ]
            ]
        ),
        # incremental load
        "incremental_orders": f"SELECT * FROM src_orders WHERE order_date > {mark}",
        "incremental_order_items": f"""
            SELECT * FROM src_order_items
            WHERE order_id IN (SELECT order_id FROM src_orders WHERE order_date > {mark})""",
        "boundary_day_orders": f"""
            SELECT * FROM src_orders
            WHERE order_date > {mark} OR order_date = {mark} AND order_time >= '12:00:00'""",
        "late_rows": "SELECT * FROM stg_order_items",
        "high_water_mark": """
            SELECT t AS "table", d AS high_water
            FROM (SELECT max(order_date) AS d FROM raw_orders),
                 (VALUES ('orders'), ('order_items')) AS v(t)""",
        "silver_orders_delta": f"""
            SELECT * FROM stg_orders
            WHERE order_date > (SELECT max(order_date) FROM stg_orders WHERE order_date <= {mark})""",
        "silver_items_delta": f"""
            SELECT * FROM stg_order_items WHERE order_date >
              (SELECT max(order_date) FROM stg_order_items WHERE order_date <= {mark})""",
        "upsert_by_key": f"""
            SELECT * REPLACE (CASE WHEN order_date > DATE '1998-06-30' THEN 'Voucher'
                                   ELSE payment_method END AS payment_method)
            FROM stg_orders""",
        "silver_merge": f"""
            SELECT * REPLACE (CASE WHEN order_date > DATE '1998-06-30' THEN 'Voucher'
                                   ELSE payment_method END AS payment_method)
            FROM stg_orders""",
        "append_new_columns": f"""
            SELECT *, CASE WHEN order_date > {mark} THEN 'L-' || cashier_id END AS loyalty_id
            FROM stg_orders""",
        "streamed_orders": "SELECT * FROM stg_orders",
        "streamed_order_items": "SELECT * FROM stg_order_items",
        # silver
        "surrogate_key": "SELECT order_id, md5(order_id) AS surrogate_key FROM src_orders",
        "calendar_parts": """
            SELECT order_id, order_date, order_year, order_month, order_week, day_of_week, day_name,
              is_weekend FROM calendar""",
        "day_part": "SELECT order_id, order_time, order_hour, day_part FROM stg_orders",
        "stg_orders": "SELECT * FROM stg_orders",
        "join_items_orders": """
            SELECT i.*, o.location_id, o.location_name, o.order_date, o.is_refund
            FROM src_order_items i JOIN stg_orders o USING (order_id)""",
        "join_items_menu": """
            SELECT i.*, m.subcategory, m.cost_price
            FROM src_order_items i LEFT JOIN src_menu m USING (item_id)""",
        "line_margin": """
            SELECT order_item_id, quantity, line_total, cost_price, total_cost, gross_profit,
              margin_pct FROM stg_order_items""",
        "stg_order_items": "SELECT * FROM stg_order_items",
        # gold
        "item_stats": "SELECT * FROM item_stats",
        "menu_thresholds": "SELECT * FROM menu_thresholds",
        "mart_menu_performance": "SELECT * FROM mart_menu_performance",
        "order_profit": "SELECT * FROM order_profit",
        "join_preaggregated": """
            SELECT o.order_id, o.order_date, o.total_amount, p.gross_profit,
              round(p.margin_pct, 2) AS margin_pct
            FROM stg_orders o LEFT JOIN order_profit p USING (order_id)""",
        "orders_by_type": f"""
            SELECT {months}, total_orders, dine_in_orders, takeout_orders, delivery_orders
            FROM monthly_locations""",
        "monthly_locations": "SELECT * FROM monthly_locations",
        "revenue_share": f"SELECT {months}, total_revenue, revenue_share_pct FROM mart_location_comparison",
        "mart_location_comparison": "SELECT * FROM mart_location_comparison",
        "monthly_revenue": "SELECT * FROM monthly",
        "prev_month_revenue": f"SELECT {months}, total_revenue, prev_month_revenue FROM mart_revenue_trends",
        "mom_growth": f"SELECT {months}, total_revenue, mom_growth_pct FROM mart_revenue_trends",
        "ytd_revenue": f"SELECT {months}, total_revenue, ytd_revenue FROM mart_revenue_trends",
        "all_locations_revenue": f"SELECT {months}, total_revenue, all_locations_revenue FROM mart_revenue_trends",
        "mart_revenue_trends": "SELECT * FROM mart_revenue_trends",
        "mart_time_analysis": "SELECT * FROM mart_time_analysis",
        # reports
        "gold_by_month": "SELECT * FROM mart_location_comparison",
        "report_files": "SELECT * FROM mart_revenue_trends",
        "report_menu_performance": "SELECT * FROM mart_menu_performance ORDER BY total_revenue DESC",
        "report_location_comparison": """
            SELECT * FROM mart_location_comparison
            ORDER BY order_year, order_month, total_revenue DESC""",
        "report_revenue_trends": """
            SELECT * FROM mart_revenue_trends ORDER BY location_id, order_year, order_month""",
        "report_time_analysis": """
            SELECT location_name, day_name, order_hour,
              CAST(sum(total_orders) AS BIGINT) AS total_orders, sum(total_revenue) AS total_revenue
            FROM mart_time_analysis GROUP BY ALL ORDER BY day_name, order_hour, location_name""",
        # quality
        "quality_checks": "SELECT * FROM checks",
        "quality_checks_orders": "SELECT * FROM checks WHERE \"table\" = 'bronze_orders'",
        "quality_checks_items": "SELECT * FROM checks WHERE \"table\" = 'bronze_order_items'",
        "quality_checks_menu": "SELECT * FROM checks WHERE \"table\" = 'bronze_menu'",
        "quality_summary": """
            SELECT count(*) AS total, count(*) FILTER (status = 'PASS') AS passed,
              count(*) FILTER (status <> 'PASS') AS failed,
              printf('%.1f%%', count(*) FILTER (status = 'PASS') * 100.0 / count(*)) AS pass_rate
            FROM checks""",
        "duplicate_orders": "SELECT count(*) - count(DISTINCT order_id) AS duplicates FROM raw_orders_resent",
        "unmatched_items": """
            SELECT count(*) AS unmatched
            FROM raw_order_items i LEFT JOIN raw_menu m USING (item_id) WHERE m.item_id IS NULL""",
        "assert_not_null": _union(
            _not_null("src_orders", "order_id"),
            _not_null("src_orders", "location_id"),
            _not_null("src_order_items", "order_item_id"),
            _not_null("src_menu", "item_id"),
            _not_null("src_locations", "location_id"),
            _not_null("stg_orders", "surrogate_key"),
            _not_null("stg_orders", "order_id"),
            _not_null("stg_orders", "location_id"),
            _not_null("stg_orders", "total_amount"),
            _not_null("stg_order_items", "surrogate_key"),
            _not_null("stg_order_items", "gross_profit"),
        ),
        "assert_unique": _union(
            _unique("src_orders", "order_id", "raw_orders_resent"),
            _unique("src_order_items", "order_item_id"),
            _unique("src_menu", "item_id"),
            _unique("src_locations", "location_id"),
            _unique("stg_orders", "surrogate_key"),
            _unique("stg_order_items", "surrogate_key"),
        ),
        "assert_accepted_range": _assertion(
            "accepted_range", "stg_orders", "total_amount",
            "SELECT count(*) FROM stg_orders WHERE total_amount < 0",
        ),
        "assert_menu_classified": _assertion(
            "accepted_values", "mart_menu_performance", "menu_class",
            "SELECT count(*) FROM mart_menu_performance"
            " WHERE menu_class NOT IN ('Star', 'Plow Horse', 'Puzzle', 'Dog')",
        ),
        "assert_no_negative_revenue": _assertion(
            "accepted_range", "mart_menu_performance", "total_revenue",
            "SELECT count(*) FROM mart_menu_performance WHERE total_revenue < 0",
        ),
        # prices and promotions
        "price_as_of_order": f"""
            SELECT order_item_id, item_id, order_date, unit_price, price_then, cost_then
            FROM ({_COSTED_AS_OF})""",
        "margin_price_history": f"""
            SELECT item_id, count(*) AS lines, sum(line_total) AS total_revenue,
              CAST(sum(gross_profit) AS DECIMAL(38,2)) AS profit_current_cost,
              CAST(sum(profit_then) AS DECIMAL(38,2)) AS profit_historical_cost,
              round(CAST(sum(CAST(margin_pct AS DECIMAL(18,2))) AS DOUBLE)
                    / nullif(count(margin_pct), 0), 2) AS margin_current_cost,
              round(CAST(sum(CAST(margin_then AS DECIMAL(18,2))) AS DOUBLE)
                    / nullif(count(margin_then), 0), 2) AS margin_historical_cost
            FROM (
              SELECT *, CASE WHEN line_total > 0
                THEN round(CAST(profit_then AS DOUBLE) / CAST(line_total AS DOUBLE) * 100, 2)
                ELSE 0.0 END AS margin_then
              FROM (SELECT *, line_total - cost_then * quantity AS profit_then
                    FROM ({_COSTED_AS_OF})))
            GROUP BY item_id""",
        "promo_performance": """
            SELECT promo_id, p.promo_name,
              count(i.order_item_id) AS lines, count(DISTINCT i.order_id) AS orders,
              CAST(coalesce(sum(i.quantity), 0) AS BIGINT) AS units,
              CAST(coalesce(sum(i.line_total), 0) AS DECIMAL(38,2)) AS revenue,
              CAST(coalesce(sum(i.discount_applied), 0) AS DECIMAL(38,2)) AS discount,
              round(CAST(sum(i.discount_applied) AS DOUBLE)
                / nullif(CAST(sum(i.line_total) + sum(i.discount_applied) AS DOUBLE), 0) * 100, 2)
                AS discount_pct
            FROM src_promotions p
            FULL JOIN (SELECT * FROM stg_order_items WHERE promo_id IS NOT NULL) i USING (promo_id)
            GROUP BY promo_id, p.promo_name""",
    }
    return {name: _sql(select) for name, select in selects.items()}
