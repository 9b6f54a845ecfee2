"""The named queries as SQL over the same parquet tables, for comparison.

Written against the table definitions on their own, in the plain relational
form: scalar cents instead of decimal helpers, ordinary windows instead of the
split ones, real joins instead of pre-aggregated ones.
"""

from __future__ import annotations

import re

# ---- tables ------------------------------------------------------------------

VIEWS = {
    "v_branches": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, 1 + n_nationkey % 7 AS traffic_weight FROM nation",
    "v_products": """
        SELECT p_partkey AS id, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS base_price, p_size AS popularity_weight,
               CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN CAST(0 AS DECIMAL(10,2))
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.35 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END AS cost_price
        FROM part""",
    "v_costs": """
        SELECT id, CASE WHEN cost_price IS NULL OR cost_price = 0
                        THEN CAST(base_price * CAST(0.4 AS DECIMAL(2,1)) AS DECIMAL(10,2)) ELSE cost_price END AS cost_price
        FROM v_products""",
    "v_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
               CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2))
                    * CAST(ROUND(l_discount * 100) AS INTEGER) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS discount
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "v_headers": """
        SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS branch_id,
               o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS created_at
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "v_totals": """
        SELECT order_id, SUM(CAST(quantity * unit_price AS DECIMAL(12,2))) AS gross, SUM(discount) AS discount
        FROM v_items GROUP BY order_id""",
    "v_fact": """
        SELECT CAST(strftime(o.created_at, '%Y%m%d') AS BIGINT) AS time_key, o.branch_id + 1 AS branch_key,
               i.product_id + 1 AS product_key, i.order_id, i.quantity,
               CAST(i.unit_price * i.quantity AS DECIMAL(12,2)) AS gross_amount,
               CAST((2 * t.d * i.c + t.g) // (2 * t.g) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS discount_amount,
               CAST((2 * (i.c * t.g - t.d * i.c) + t.g) // (2 * t.g) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS net_amount,
               CAST(k.cost_price * i.quantity AS DECIMAL(12,2)) AS cost_amount,
               CAST(hour(o.created_at) AS BIGINT) AS hour_of_day, CAST(isodow(o.created_at) AS BIGINT) AS day_of_week
        FROM (SELECT *, CAST(unit_price * quantity * 100 AS HUGEINT) AS c FROM v_items) i
        JOIN v_headers o ON o.id = i.order_id
        JOIN v_costs k ON k.id = i.product_id
        JOIN (SELECT order_id, NULLIF(CAST(gross * 100 AS HUGEINT), 0) AS g, CAST(discount * 100 AS HUGEINT) AS d FROM v_totals) t
             ON t.order_id = i.order_id""",
    "v_orders_daily": """
        SELECT time_key, branch_key, COUNT(DISTINCT order_id) AS total_orders, SUM(gross_amount) AS total_gross,
               SUM(discount_amount) AS total_discount, SUM(net_amount) AS total_net, SUM(cost_amount) AS total_cost
        FROM v_fact GROUP BY time_key, branch_key""",
    "v_consumption": """
        SELECT o.branch_id, i.product_id, SUM(i.quantity) AS total_qty
        FROM v_items i JOIN v_headers o ON o.id = i.order_id GROUP BY 1, 2""",
    "v_stock": "SELECT branch_id, product_id, CAST(120 - total_qty AS BIGINT) AS stock_level FROM v_consumption",
    "v_events": "SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "v_pos": """
        SELECT 'txn_' || CAST(event_id AS VARCHAR) AS transaction_id, user_id % 10 + 1 AS branch_id, k % 20 + 1 AS product_id,
               k % 5 + 1 AS quantity, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS unit_price, ts
        FROM v_events JOIN (VALUES (1), (2)) c(n) ON n = 1 OR event_id % 10 = 0""",
    "v_clean": """
        SELECT *, CAST(CAST(unit_price AS DECIMAL(10,2)) * quantity AS DECIMAL(12,2)) AS total_price, CAST(ts AS DATE) AS date
        FROM (SELECT DISTINCT ON (transaction_id) * FROM v_pos ORDER BY transaction_id, ts) WHERE unit_price > 0""",
    "v_daily": """
        SELECT date, branch_id, product_id, CAST(SUM(quantity) AS BIGINT) AS daily_quantity,
               SUM(total_price) AS daily_revenue, COUNT(transaction_id) AS transaction_count
        FROM v_clean GROUP BY date, branch_id, product_id""",
    "v_ledger": """
        SELECT event_id AS id, user_id % 10 + 1 AS store_id, k % 45 + 1 AS product_id,
               CASE event_type WHEN 'signup' THEN k % 26 + 5 WHEN 'error' THEN k % 16 - 5 ELSE -(k % 10 + 1) END AS change_amount,
               CASE event_type WHEN 'signup' THEN 'import' WHEN 'error' THEN 'adjustment' ELSE 'sale' END AS type,
               user_id AS created_by, ts AS created_at
        FROM v_events""",
    "v_edits": """
        SELECT e.*, CASE WHEN product_id = 0 OR quantity IS NULL THEN 'invalid'
                         WHEN u.active AND (r.name = 'admin' OR u.store_id = e.store_id) THEN 'accepted' ELSE 'refused' END AS outcome
        FROM (SELECT id, created_by AS user_id, store_id, product_id % 8 AS product_id,
                     CASE WHEN id % 50 <> 0 THEN id % 37 END AS quantity, CASE WHEN id % 3 = 0 THEN id % 9 END AS low_stock, created_at
              FROM v_ledger) e
        LEFT JOIN v_users u ON u.id = e.user_id LEFT JOIN v_roles r ON r.id = u.role_id""",
    "v_stores": """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, n_name AS name, 'Region ' || CAST(n_regionkey AS VARCHAR) AS location
        FROM nation""",
    "v_shelf": """
        SELECT product_id * 10 + store_id - 1 AS id, store_id, product_id, quantity, product_id % 4 * 10 AS low_stock
        FROM (SELECT l_suppkey % 10 + 1 AS store_id, l_partkey AS product_id,
                     CAST(SUM(CAST(l_quantity AS BIGINT)) % 100 AS BIGINT) AS quantity
              FROM lineitem GROUP BY 1, 2)""",
    "v_running": """
        SELECT l.store_id, l.product_id, l.id, l.created_at, COALESCE(o.quantity, 0) AS opening,
               SUM(change_amount) OVER w AS moved
        FROM v_ledger l LEFT JOIN v_shelf o ON o.store_id = l.store_id AND o.product_id = l.product_id
        WINDOW w AS (PARTITION BY l.store_id, l.product_id ORDER BY l.created_at, l.id ROWS UNBOUNDED PRECEDING)""",
    "v_levels": """
        SELECT store_id, product_id, id, created_at,
               CAST(opening + moved - LEAST(0, MIN(opening + moved) OVER (PARTITION BY store_id, product_id
                    ORDER BY created_at, id ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS quantity
        FROM v_running""",
    "v_logs": """
        SELECT store_id AS branch_id, product_id, created_at, id, quantity - before AS change_amount,
               quantity AS new_stock_level, CASE WHEN quantity > before THEN 'RESTOCK' ELSE 'CONSUMPTION' END AS reason
        FROM (SELECT *, LAG(quantity) OVER (PARTITION BY store_id, product_id ORDER BY created_at, id) AS before FROM v_levels)
        WHERE quantity <> before""",
    "v_stock_days": """
        SELECT CAST(strftime(created_at, '%Y%m%d') AS BIGINT) AS time_key, branch_id + 1 AS branch_key, product_id + 1 AS product_key,
               CAST(SUM(CASE WHEN reason = 'RESTOCK' THEN change_amount ELSE 0 END) AS BIGINT) AS total_restocked,
               CAST(SUM(CASE WHEN reason = 'CONSUMPTION' THEN ABS(change_amount) ELSE 0 END) AS BIGINT) AS total_consumed,
               MAX(new_stock_level) AS closing_stock, arg_max(new_stock_level, (created_at, id)) AS last_stock
        FROM v_logs JOIN part ON p_partkey = product_id JOIN nation ON n_nationkey = branch_id
        GROUP BY 1, 2, 3""",
    "v_lots": """
        SELECT p.name AS product, p.category, CAST(l_quantity AS DECIMAL(10,2)) AS stock,
               CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_shipdate AS DATE) + 30 AS DATE) END AS expiry_date,
               'LOT-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS batch
        FROM lineitem JOIN v_products p ON p.id = l_partkey""",
    "v_users": """
        SELECT c_custkey AS id, c_name AS name, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               c_custkey % 10 AS role_id, (c_custkey // 10) % 10 + 1 AS store_id, c_acctbal >= 0 AS active
        FROM customer""",
    "v_changes": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'user' || CAST(c_custkey AS VARCHAR) || '@example.org' END AS email,
               CASE WHEN c_custkey % 3 = 0 THEN 1 END AS role_id
        FROM customer WHERE c_acctbal < 0""",
    "v_patched": """
        SELECT u.id, u.name, COALESCE(c.email, u.email) AS email, COALESCE(CAST(c.role_id AS BIGINT), u.role_id) AS role_id,
               u.store_id, u.active OR c.id IS NOT NULL AS active
        FROM v_users u LEFT JOIN v_changes c ON c.id = u.id""",
    "v_roles": """
        SELECT s_suppkey AS id, CASE WHEN s_suppkey = 0 THEN 'admin' ELSE s_name END AS name,
               'Nation ' || CAST(s_nationkey AS VARCHAR) AS description
        FROM supplier""",
    "v_permissions": """
        SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS id, 'manage_' || lower(p_brand) AS key FROM part""",
    "v_bridge": """
        SELECT DISTINCT l_suppkey AS role_id, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS permission_id
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "v_audit": """
        SELECT event_id AS id, CASE WHEN k <> 0 THEN user_id * 11 END AS user_id,
               CASE event_type WHEN 'signup' THEN 'CREATE' WHEN 'error' THEN 'DELETE' WHEN 'purchase' THEN 'UPDATE'
                    ELSE upper(event_type) END AS action,
               CASE WHEN k % 2 = 0 THEN 'inventory' ELSE 'users' END AS table_name, k AS record_id, props AS new_value,
               ts AS created_at
        FROM v_events""",
    "v_signups": """
        SELECT c_custkey AS id,
               CASE WHEN c_custkey % 11 = 0 THEN ' x ' WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS name,
               lower(c_mktsegment) || CASE WHEN c_custkey % 7 = 0 THEN '@example' WHEN c_custkey % 13 = 0 THEN '@@example.com'
                    WHEN c_custkey % 19 = 0 THEN ' ' || CAST(c_custkey AS VARCHAR) || '@example.com'
                    ELSE CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
               repeat(CAST(c_custkey AS VARCHAR), 3) AS password,
               CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 9 = 0 THEN '1.5' WHEN c_custkey % 8 = 0 THEN '2.0'
                    ELSE CAST(c_custkey % 10 AS VARCHAR) END AS role_id
        FROM customer""",
    "v_checked": """
        SELECT id, email, list_filter([
                   CASE WHEN name IS NULL OR length(trim(name)) < 2 THEN 'Name must be at least 2 characters' END,
                   CASE WHEN NOT regexp_full_match(email, '[^\\s@]+@[^\\s@]+\\.[^\\s@]+') THEN 'Invalid email format' END,
                   CASE WHEN length(password) < 8 THEN 'Password must be at least 8 characters' END,
                   CASE WHEN role_id IN ('', '0', '1.5') THEN 'Valid role_id is required' END], lambda x: x IS NOT NULL) AS errors
        FROM v_signups""",
    "v_profiles": """
        SELECT c_custkey, 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
               CASE WHEN c_custkey % 3 <> 0 THEN 'E' || CAST(c_custkey AS VARCHAR)
                    ELSE 'EMP-' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) END AS employee_code,
               CASE WHEN c_custkey % 4 <> 0 THEN c_name ELSE 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS name,
               CASE WHEN c_custkey % 5 = 0 THEN 'MANAGER' ELSE 'STAFF' END AS role,
               CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS branch_id
        FROM customer""",
}

TODAY, YESTERDAY = 20010731, 20010730


def _features(frame: str) -> str:
    return f"""
        SELECT date AS feature_date, branch_id, product_id,
               CAST(ROUND(SUM(daily_revenue) OVER w, 2) AS DOUBLE) AS rolling_7d_sales,
               ROUND(CAST(SUM(daily_quantity) OVER w AS DOUBLE) / 7.0, 4) AS popularity_trend_score,
               ROUND(CAST(transaction_count AS DOUBLE) / AVG(transaction_count) OVER (PARTITION BY branch_id), 4) AS branch_demand_index
        FROM v_daily WINDOW w AS (PARTITION BY branch_id, product_id ORDER BY date {frame})"""


def _turnover(cogs: str) -> str:
    return f"""
        WITH sold AS (SELECT branch_key, product_key, cost_amount, 1.0 / COUNT(*) OVER (PARTITION BY branch_key, product_key) AS w FROM v_fact),
        paired AS (
            SELECT f.branch_key, f.product_key, {cogs} AS cogs, AVG(i.closing_stock) AS mean
            FROM sold f LEFT JOIN v_stock_days i ON i.branch_key = f.branch_key AND i.product_key = f.product_key
            GROUP BY 1, 2)
        SELECT b.name AS branch_name, p.name AS product_name, CAST(c.cogs AS DOUBLE) AS "Cost of Goods Sold",
               ROUND(COALESCE(c.mean, 1), 4) AS avg_inventory, ROUND(CAST(c.cogs AS DOUBLE) / NULLIF(c.mean, 0), 4) AS turnover_rate
        FROM paired c JOIN v_branches b ON b.id + 1 = c.branch_key JOIN v_products p ON p.id + 1 = c.product_key"""


def _kpi(scope: str) -> str:
    return f"""
        WITH f AS (SELECT * FROM v_fact WHERE time_key IN ({TODAY}, {YESTERDAY}) {scope}),
        a AS (SELECT COALESCE(SUM(net_amount), 0) AS rev, COUNT(DISTINCT order_id) AS n,
                     COALESCE(CAST(SUM(net_amount) AS DOUBLE) / NULLIF(COUNT(net_amount), 0), 0) AS mean
              FROM f WHERE time_key = {TODAY}),
        y AS (SELECT COALESCE(SUM(net_amount), 0) AS rev FROM f WHERE time_key = {YESTERDAY}),
        best AS (SELECT product_key FROM f WHERE time_key = {TODAY} GROUP BY 1 ORDER BY SUM(quantity) DESC, 1 LIMIT 1)
        SELECT CAST(a.rev AS DOUBLE) AS revenue_today, CAST(a.n AS BIGINT) AS orders_today, ROUND(a.mean, 2) AS avg_order_value,
               ROUND(COALESCE(CAST(a.rev AS DOUBLE) / NULLIF(a.n, 0), 0), 2) AS avg_order_value_true,
               CAST(y.rev AS DOUBLE) AS revenue_yesterday,
               ROUND(CASE WHEN y.rev > 0 THEN (CAST(a.rev AS DOUBLE) - CAST(y.rev AS DOUBLE)) / CAST(y.rev AS DOUBLE) * 100 ELSE 0.0 END, 1) AS revenue_trend_pct,
               COALESCE((SELECT p.name FROM v_products p, best WHERE p.id + 1 = best.product_key), 'N/A') AS top_product
        FROM a, y"""


def _top(scope: str, limit: int = 5, more: str = "", order: str = "s.u DESC, s.product_key") -> str:
    return f"""
        SELECT p.name, p.category, CAST(s.u AS BIGINT) AS units_sold, CAST(s.r AS DOUBLE) AS revenue {more}
        FROM (SELECT product_key, SUM(quantity) AS u, SUM(net_amount) AS r FROM v_fact {scope}
              GROUP BY 1 ORDER BY u DESC, product_key LIMIT {limit}) s
        JOIN v_products p ON p.id + 1 = s.product_key ORDER BY {order}"""


def _insights(today: int, yesterday: int, lift: int) -> str:
    return f"""
        WITH f AS (SELECT * FROM v_fact WHERE time_key IN ({today}, {yesterday})),
        b AS (SELECT branch_key, CAST(SUM(CASE WHEN time_key = {today} THEN net_amount ELSE 0 END) AS DOUBLE) AS t,
                     CAST(SUM(CASE WHEN time_key = {yesterday} THEN net_amount ELSE 0 END) AS DOUBLE) AS y FROM f GROUP BY 1),
        pct AS (SELECT branch_key AS k, v.name, (t - y) / y * 100 AS p FROM b JOIN v_branches v ON v.id + 1 = branch_key WHERE y > 0),
        hours AS (SELECT hour_of_day AS h, SUM(net_amount) AS r FROM f WHERE time_key = {today} GROUP BY 1 ORDER BY r DESC, h LIMIT 2),
        best AS (SELECT product_key, SUM(quantity) AS u FROM f WHERE time_key = {today} GROUP BY 1 ORDER BY u DESC, 1 LIMIT 1),
        low AS (SELECT COUNT(*) AS n FROM v_stock WHERE stock_level + {lift} < 20),
        found AS (
            SELECT 0 AS nr, k, 'warning' AS type, 'Branch ' || name || ' revenue dropped ' || printf('%.1f', ROUND(ABS(p), 1)) || '% so với hôm qua' AS text FROM pct WHERE p <= -15
            UNION ALL
            SELECT 0, k, 'success', 'Branch ' || name || ' revenue surged ' || printf('%.1f', ROUND(p, 1)) || '% so với hôm qua' FROM pct WHERE p >= 20
            UNION ALL
            SELECT 1, 0, 'info', 'Peak hours today: ' || string_agg(lpad(CAST(h AS VARCHAR), 2, '0') || ':00', ' and ' ORDER BY r DESC, h) FROM hours HAVING COUNT(*) > 0
            UNION ALL
            SELECT 2, 0, 'warning', CAST(n AS VARCHAR) || ' product(s) are running low on stock across all branches' FROM low WHERE n > 0
            UNION ALL
            SELECT 3, 0, 'info', 'Best seller today: ' || name || ' (' || CAST(u AS VARCHAR) || ' units)' FROM best JOIN v_products p ON p.id + 1 = product_key)
        SELECT type, text FROM (
            SELECT * FROM found
            UNION ALL
            SELECT 4, 0, 'info', 'No significant data insights for today.' WHERE NOT EXISTS (SELECT 1 FROM found))
        ORDER BY nr, k"""


def _store_kpi(store: int | None) -> str:
    s = f"AND store_id = {store}" if store else ""
    return f"""
        SELECT (SELECT COUNT(*) FROM v_stores {f'WHERE id = {store}' if store else ''}) AS store_count,
               (SELECT COUNT(*) FROM part) AS product_count,
               (SELECT COUNT(*) FROM v_users WHERE active {s}) AS user_count,
               (SELECT CAST(SUM(quantity) AS BIGINT) FROM v_shelf WHERE 1 = 1 {s}) AS total_stock,
               (SELECT COUNT(*) FROM v_shelf WHERE quantity <= low_stock {s}) AS low_stock_count,
               (SELECT COUNT(*) FROM v_ledger WHERE type = 'sale' AND created_at >= TIMESTAMP '2024-01-29 23:59:59' {s}) AS daily_sales"""


def _over_time(kind: str, sign: str, name: str) -> str:
    return f"""
        SELECT CAST(created_at AS DATE) AS date, CAST(SUM({sign}change_amount) AS BIGINT) AS {name} FROM v_ledger
        WHERE type = '{kind}' AND created_at >= TIMESTAMP '2023-12-31 23:59:59' GROUP BY 1 ORDER BY date"""


def _transactions(where: str, tail: str) -> str:
    return f"""
        SELECT l.id, l.store_id, l.product_id, l.change_amount, l.type, l.created_by, l.created_at, s.name AS store, s.name AS store_name,
               p.name AS product, p.name AS product_name, p.category, 'pcs' AS unit, u.name AS created_by_name
        FROM v_ledger l JOIN v_stores s ON s.id = l.store_id JOIN v_products p ON p.id = l.product_id
        LEFT JOIN v_users u ON u.id = l.created_by
        WHERE {where} {tail}"""


def _low(columns: str, tail: str = "") -> str:
    return f"""
        SELECT i.id, i.quantity, i.low_stock, {columns}
        FROM v_shelf i JOIN v_products p ON p.id = i.product_id JOIN v_stores s ON s.id = i.store_id
        WHERE i.quantity <= i.low_stock {tail}"""


LOW_COLUMNS = """s.id AS store_id, s.name AS store, p.id AS product_id, p.name AS product, p.category, 'pcs' AS unit,
               CAST(p.base_price AS DOUBLE) AS price"""
LISTED = """
        SELECT i.id, i.quantity, i.low_stock, p.id AS product_id, p.name AS product, p.category, 'pcs' AS unit,
               s.id AS store_id, s.name AS store, s.location
        FROM v_shelf i JOIN v_products p ON p.id = i.product_id JOIN v_stores s ON s.id = i.store_id"""

IMAGE = "CAST(to_json({{'id': {0}.id, 'name': {0}.name, 'email': {0}.email, 'role_id': {0}.role_id, 'store_id': {0}.store_id, 'active': {0}.active}}) AS VARCHAR)"

JS_SPACE = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(160)||chr(5760)||"
    + "||".join(f"chr({p})" for p in range(8192, 8203))
    + "||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)||chr(65279)"
)

STATEMENTS = {
    # point of sale
    "pos_clean": """
        SELECT transaction_id, branch_id, product_id, quantity, unit_price, ts AS "timestamp",
               CAST(total_price AS DOUBLE) AS total_price, date FROM v_clean""",
    "pos_daily_sales": """
        SELECT date, branch_id, product_id, daily_quantity, CAST(daily_revenue AS DOUBLE) AS daily_revenue, transaction_count FROM v_daily""",
    "ml_features": _features("ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"),
    "ml_features_by_days": _features("RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW"),
    "spike_alerts": """
        SELECT date_trunc('hour', ts) AS window_start, branch_id, CAST(SUM(quantity) AS BIGINT) AS units
        FROM v_pos GROUP BY 1, 2 HAVING SUM(quantity) >= 20""",
    "kafka_normalize": """
        SELECT transaction_id AS order_id, branch_id, CAST(CAST(unit_price AS DECIMAL(10,2)) * quantity AS DOUBLE) AS gross_amount,
               CAST(0 AS DOUBLE) AS discount_amount, ts AS created_at, product_id, quantity,
               CAST(CAST(unit_price AS DECIMAL(10,2)) AS DOUBLE) AS unit_price
        FROM (SELECT DISTINCT ON (transaction_id) * FROM v_pos ORDER BY transaction_id, ts)""",
    # star schema
    "dim_time": """
        SELECT DISTINCT CAST(strftime(created_at, '%Y%m%d') AS BIGINT) AS time_key, CAST(created_at AS DATE) AS full_date,
               CAST(isodow(created_at) AS BIGINT) AS day_of_week, rpad(strftime(created_at, '%A'), 9, ' ') AS day_name,
               CAST(month(created_at) AS BIGINT) AS month, rpad(strftime(created_at, '%B'), 9, ' ') AS month_name,
               CAST(quarter(created_at) AS BIGINT) AS quarter, CAST(year(created_at) AS BIGINT) AS year,
               isodow(created_at) IN (6, 7) AS is_weekend
        FROM v_headers""",
    "dim_branch_upsert": """
        SELECT CASE WHEN n_regionkey = 0 THEN n_nationkey + 101
                    ELSE (SELECT MAX(n_nationkey) + 101 FROM nation WHERE n_regionkey = 0)
                         + ROW_NUMBER() OVER (PARTITION BY n_regionkey = 0 ORDER BY substr(md5(CAST(n_nationkey AS VARCHAR)), 1, 4), n_nationkey) END AS branch_key,
               CAST(n_nationkey AS BIGINT) AS branch_id, n_name AS name,
               CASE WHEN n_regionkey = 0 THEN DATE '1995-01-01' END AS valid_from, CASE WHEN n_regionkey = 0 THEN TRUE END AS is_current
        FROM nation""",
    "dim_branch_inferred": """
            SELECT CASE WHEN n_regionkey = 0 THEN n_nationkey + 101
                        ELSE (SELECT MAX(n_nationkey) + 101 FROM nation WHERE n_regionkey = 0)
                             + ROW_NUMBER() OVER (PARTITION BY n_regionkey = 0 ORDER BY substr(md5(CAST(n_nationkey AS VARCHAR)), 1, 4), n_nationkey) END AS branch_key,
                   CAST(n_nationkey AS BIGINT) AS branch_id, CASE WHEN n_regionkey = 0 THEN 'old ' || n_name END AS name,
                   CASE WHEN n_regionkey = 0 THEN DATE '1995-01-01' END AS valid_from, CASE WHEN n_regionkey = 0 THEN TRUE END AS is_current
            FROM nation WHERE n_regionkey = 0 OR n_nationkey IN (SELECT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey)""",
    "orders_of_inferred_branches": """
        WITH dim AS (
            SELECT CASE WHEN n_regionkey = 0 THEN n_nationkey + 101
                        ELSE (SELECT MAX(n_nationkey) + 101 FROM nation WHERE n_regionkey = 0)
                             + ROW_NUMBER() OVER (PARTITION BY n_regionkey = 0 ORDER BY substr(md5(CAST(n_nationkey AS VARCHAR)), 1, 4), n_nationkey) END AS branch_key,
                   CAST(n_nationkey AS BIGINT) AS branch_id, CASE WHEN n_regionkey = 0 THEN 'old ' || n_name END AS name,
                   CASE WHEN n_regionkey = 0 THEN DATE '1995-01-01' END AS valid_from, CASE WHEN n_regionkey = 0 THEN TRUE END AS is_current
            FROM nation WHERE n_regionkey = 0 OR n_nationkey IN (SELECT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey)),
        sold AS (SELECT c_nationkey AS branch_id, COUNT(*) AS orders FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1)
        SELECT branch_key, name, orders FROM sold JOIN dim USING (branch_id)""",
    "dim_product_upsert": """
        SELECT CASE WHEN category IN ('ECONOMY', 'SMALL') THEN id * 2 + 1
                    ELSE (SELECT MAX(id) * 2 + 1 FROM v_products WHERE category IN ('ECONOMY', 'SMALL'))
                         + ROW_NUMBER() OVER (PARTITION BY category IN ('ECONOMY', 'SMALL') ORDER BY substr(md5(CAST(id AS VARCHAR)), 1, 4), id) END AS product_key,
               id AS product_id, name, category, CASE WHEN category IN ('ECONOMY', 'SMALL') THEN DATE '1995-01-01' END AS valid_from,
               CASE WHEN category IN ('ECONOMY', 'SMALL') THEN TRUE END AS is_current
        FROM v_products""",
    "fact_sales": """
        SELECT time_key, branch_key, product_key, order_id, CAST(quantity AS BIGINT) AS quantity,
               CAST(gross_amount AS DOUBLE) AS gross_amount, CAST(discount_amount AS DOUBLE) AS discount_amount,
               CAST(net_amount AS DOUBLE) AS net_amount, CAST(cost_amount AS DOUBLE) AS cost_amount, hour_of_day, day_of_week
        FROM v_fact""",
    "fact_orders_daily": """
        SELECT time_key, branch_key, total_orders, CAST(total_gross AS DOUBLE) AS total_gross,
               CAST(total_discount AS DOUBLE) AS total_discount, CAST(total_net AS DOUBLE) AS total_net,
               CAST(total_cost AS DOUBLE) AS total_cost
        FROM v_orders_daily""",
    "fact_orders_daily_incremental": """
        SELECT time_key, branch_key, total_orders, CAST(total_gross AS DOUBLE) AS total_gross,
               CAST(total_discount AS DOUBLE) AS total_discount, CAST(total_net AS DOUBLE) AS total_net,
               CAST(total_cost AS DOUBLE) AS total_cost
        FROM v_orders_daily""",
    "fact_inventory": "SELECT time_key, branch_key, product_key, total_restocked, total_consumed, closing_stock FROM v_stock_days",
    "fact_inventory_last": """
        SELECT time_key, branch_key, product_key, total_restocked, total_consumed, last_stock AS closing_stock FROM v_stock_days""",
    # views
    "revenue_by_hour": """
        SELECT hour_of_day, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue, COUNT(DISTINCT order_id) AS total_orders
        FROM v_fact GROUP BY 1 ORDER BY hour_of_day""",
    "top_products_branch": """
        SELECT b.name AS branch_name, p.name AS product_name, CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
               CAST(SUM(f.net_amount) AS DOUBLE) AS total_revenue,
               RANK() OVER (PARTITION BY b.name ORDER BY SUM(f.quantity) DESC) AS rank
        FROM v_fact f JOIN v_branches b ON b.id + 1 = f.branch_key JOIN v_products p ON p.id + 1 = f.product_key
        GROUP BY b.name, p.name""",
    "inventory_turnover": _turnover("SUM(f.cost_amount)"),
    "inventory_turnover_fixed": """
        WITH c AS (SELECT branch_key, product_key, SUM(cost_amount) AS cogs FROM v_fact GROUP BY 1, 2),
        m AS (SELECT branch_key, product_key, AVG(closing_stock) AS mean FROM v_stock_days GROUP BY 1, 2)
        SELECT b.name AS branch_name, p.name AS product_name, CAST(c.cogs AS DOUBLE) AS "Cost of Goods Sold",
               ROUND(COALESCE(m.mean, 1), 4) AS avg_inventory, ROUND(CAST(c.cogs AS DOUBLE) / NULLIF(m.mean, 0), 4) AS turnover_rate
        FROM c LEFT JOIN m ON m.branch_key = c.branch_key AND m.product_key = c.product_key
        JOIN v_branches b ON b.id + 1 = c.branch_key JOIN v_products p ON p.id + 1 = c.product_key""",
    "profit_margin": """
        SELECT time_key, b.name AS branch_name, CAST(total_net AS DOUBLE) AS revenue, CAST(total_cost AS DOUBLE) AS cost,
               CAST(total_net - total_cost AS DOUBLE) AS profit,
               ROUND(CASE WHEN total_net > 0 THEN CAST(total_net - total_cost AS DOUBLE) / CAST(total_net AS DOUBLE) * 100 ELSE 0.0 END, 4) AS profit_margin_percent
        FROM v_orders_daily JOIN v_branches b ON b.id + 1 = branch_key""",
    "branch_performance": """
        SELECT b.name AS branch_name, CAST(SUM(total_net) AS DOUBLE) AS total_revenue, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
               CAST(SUM(total_net - total_cost) AS DOUBLE) AS total_profit, RANK() OVER (ORDER BY SUM(total_net) DESC) AS revenue_rank
        FROM v_orders_daily JOIN v_branches b ON b.id + 1 = branch_key GROUP BY b.name
        ORDER BY revenue_rank, branch_name""",
    "branch_best_worst": """
        WITH r AS (SELECT b.name, SUM(total_net) AS rev FROM v_orders_daily JOIN v_branches b ON b.id + 1 = branch_key GROUP BY 1)
        SELECT (SELECT name FROM r ORDER BY rev DESC, name DESC LIMIT 1) AS best, (SELECT name FROM r ORDER BY rev, name LIMIT 1) AS worst""",
    "revenue_distribution": """
        SELECT b.name AS branch, CAST(SUM(total_net) AS DOUBLE) AS revenue,
               ROUND(CAST(SUM(total_net) AS DOUBLE) / (SELECT CAST(SUM(total_net) AS DOUBLE) FROM v_orders_daily), 6) AS share
        FROM v_orders_daily JOIN v_branches b ON b.id + 1 = branch_key GROUP BY b.name
        ORDER BY revenue DESC, branch""",
    "daily_revenue": """
        SELECT CAST(strptime(CAST(time_key AS VARCHAR), '%Y%m%d') AS DATE) AS sale_date, branch_key - 1 AS branch_id,
               CAST(total_net AS DOUBLE) AS revenue, CAST(total_discount AS DOUBLE) AS total_discount, total_orders AS order_count
        FROM v_orders_daily""",
    "product_performance": """
        SELECT p.name, p.category, CAST(SUM(f.quantity) AS BIGINT) AS units_sold, CAST(SUM(f.net_amount) AS DOUBLE) AS total_revenue
        FROM v_fact f JOIN v_products p ON p.id + 1 = f.product_key GROUP BY p.name, p.category""",
    # dashboard
    "kpi": _kpi(""),
    "kpi_branch": _kpi("AND branch_key = 2"),
    "kpi_revenue_by_hour": f"""
        SELECT lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS hour, CAST(SUM(net_amount) AS DOUBLE) AS revenue,
               COUNT(DISTINCT order_id) AS orders
        FROM v_fact WHERE time_key = {TODAY} GROUP BY hour_of_day
        ORDER BY hour""",
    "revenue_by_date": """
        SELECT CAST(strptime(CAST(time_key AS VARCHAR), '%Y%m%d') AS DATE) AS date, CAST(SUM(net_amount) AS DOUBLE) AS revenue,
               COUNT(DISTINCT order_id) AS orders
        FROM v_fact WHERE time_key >= 20010717 GROUP BY time_key
        ORDER BY date""",
    "revenue_by_date_filled": """
        WITH r AS (SELECT CAST(strptime(CAST(time_key AS VARCHAR), '%Y%m%d') AS DATE) AS date, SUM(net_amount) AS revenue,
                          COUNT(DISTINCT order_id) AS orders
                   FROM v_fact WHERE time_key >= 20010717 AND branch_key = 8 GROUP BY time_key),
        days AS (SELECT CAST(UNNEST(generate_series(DATE '2001-07-17', GREATEST(DATE '2001-07-31',
                        (SELECT COALESCE(MAX(date), DATE '2001-07-31') FROM r)), INTERVAL 1 DAY)) AS DATE) AS date)
        SELECT days.date, CAST(COALESCE(r.revenue, 0) AS DOUBLE) AS revenue, COALESCE(r.orders, 0) AS orders
        FROM days LEFT JOIN r ON r.date = days.date
        ORDER BY date""",
    "top_products": _top(""),
    "top_products_ranked": _top("", 10, ", ROW_NUMBER() OVER (ORDER BY s.u DESC, p.name) AS position", "position"),
    "top_products_of_branch": _top("WHERE branch_key = 4"),
    "low_stock_lots": """
        SELECT product, category, CAST(stock AS DOUBLE) AS stock, 'kg' AS unit, CAST(10 AS DOUBLE) AS reorder_level, expiry_date, batch,
               CASE WHEN stock <= 5 OR (expiry_date IS NOT NULL AND expiry_date <= DATE '1998-01-01') THEN 'critical' ELSE 'warning' END AS severity
        FROM v_lots WHERE stock <= 10 OR (expiry_date IS NOT NULL AND expiry_date <= DATE '1998-01-08')
        ORDER BY expiry_date NULLS LAST, stock, batch, product""",
    "insights": _insights(TODAY, YESTERDAY, 0),
    "insights_quiet_day": _insights(19900102, 19900101, 1_000_000_000),
    "data_quality": """
        WITH n AS (SELECT COUNT(*) AS n FROM v_stock WHERE stock_level < 0),
        o AS (SELECT COUNT(*) AS n FROM v_items WHERE order_id NOT IN (SELECT id FROM v_headers)),
        m AS (SELECT MAX(total_orders) AS n FROM v_orders_daily)
        SELECT 'Negative Stock Check' AS check_name, CASE WHEN n > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
               CASE WHEN n > 0 THEN 'Found ' || CAST(n AS VARCHAR) || ' items with negative stock.' ELSE 'All stock levels >= 0.' END AS details FROM n
        UNION ALL
        SELECT 'FK Integrity (Order Items)', CASE WHEN n > 0 THEN 'FAILED' ELSE 'PASSED' END,
               CASE WHEN n > 0 THEN 'Found ' || CAST(n AS VARCHAR) || ' orphaned order items.' ELSE 'All order items have valid parent orders.' END FROM o
        UNION ALL
        SELECT 'Abnormal Spike Check', CASE WHEN n > 10000 THEN 'WARNING' ELSE 'PASSED' END,
               CASE WHEN n > 10000 THEN 'Max orders/day detected is ' || CAST(n AS VARCHAR) || ', exceeds 10,000 threshold.'
                    ELSE 'Max orders/day is ' || CAST(COALESCE(n, 0) AS VARCHAR) || ', within normal limits.' END FROM m""",
    # orders and branch stock
    "order_totals": """
        SELECT order_id, CAST(gross AS DOUBLE) AS gross_amount, CAST(discount AS DOUBLE) AS discount_amount FROM v_totals""",
    "cost_price_default": "SELECT id AS product_id, CAST(cost_price AS DOUBLE) AS cost_price FROM v_costs",
    "stock_matrix_init": """
        SELECT b.id AS branch_id, p.id AS product_id, CAST(10000 AS BIGINT) AS stock_level FROM v_branches b CROSS JOIN v_products p
        WHERE NOT EXISTS (SELECT 1 FROM v_consumption c WHERE c.branch_id = b.id AND c.product_id = p.id)""",
    "stock_of_assortment": """
        SELECT branch_id, product_id, CAST(10000 AS BIGINT) AS stock_level FROM v_consumption c
        WHERE total_qty >= 50 AND NOT EXISTS (SELECT 1 FROM v_stock s WHERE s.branch_id = c.branch_id
                                              AND s.product_id = c.product_id AND s.stock_level > 0)""",
    "stock_after_consumption": """
        SELECT b.id AS branch_id, p.id AS product_id, CAST(10000 - COALESCE(c.total_qty, 0) AS BIGINT) AS stock_level
        FROM v_branches b CROSS JOIN v_products p LEFT JOIN v_consumption c ON c.branch_id = b.id AND c.product_id = p.id""",
    "inventory_change_log": "SELECT branch_id, product_id, change_amount, new_stock_level, reason FROM v_logs",
    # stores
    "top_selling": """
        SELECT p.id, p.name AS product, p.category, 'pcs' AS unit, CAST(SUM(-l.change_amount) AS BIGINT) AS total_sold,
               COUNT(DISTINCT l.store_id) AS stores_sold
        FROM v_ledger l JOIN v_products p ON p.id = l.product_id WHERE l.type = 'sale'
        GROUP BY p.id, p.name, p.category ORDER BY total_sold DESC, p.id LIMIT 10""",
    "low_stock_items": _low(LOW_COLUMNS, "ORDER BY i.quantity, i.id"),
    "low_stock_preview": _low(LOW_COLUMNS, "ORDER BY i.quantity, i.id LIMIT 5"),
    "low_stock_by_ratio": _low("p.name AS product, p.category, 'pcs' AS unit, s.name AS store, s.id AS store_id",
        "ORDER BY CAST(i.quantity AS DOUBLE) / NULLIF(i.low_stock, 0) NULLS LAST, i.id"),
    "inventory_list": LISTED + " ORDER BY store, category, product, i.id",
    "inventory_chart": f"""
        SELECT substr(product, 1, 15) AS name, quantity, low_stock
        FROM ({LISTED}) ORDER BY store, category, product, id LIMIT 8""",
    "search": LISTED + " WHERE lower(p.name) LIKE '%ring%' OR lower(p.category) LIKE '%ring%' ORDER BY store, category, product, i.id",
    "inventory_by_store": """
        SELECT s.id AS store_id, s.name AS store, s.location, COUNT(i.id) AS product_count, CAST(SUM(i.quantity) AS BIGINT) AS total_quantity,
               CAST(SUM(CASE WHEN i.quantity <= i.low_stock THEN 1 ELSE 0 END) AS BIGINT) AS low_stock_count
        FROM v_stores s JOIN v_shelf i ON i.store_id = s.id GROUP BY s.id, s.name, s.location
        ORDER BY store_id""",
    "store_comparison": """
        SELECT s.id AS store_id, s.name AS store, CAST(COALESCE(SUM(i.quantity), 0) AS BIGINT) AS total_quantity,
               ROUND(COALESCE(AVG(i.quantity), 0), 4) AS avg_quantity, COUNT(i.id) AS product_count
        FROM v_stores s LEFT JOIN v_shelf i ON i.store_id = s.id GROUP BY s.id, s.name
        ORDER BY total_quantity DESC, store_id""",
    "category_breakdown": """
        SELECT p.category, COUNT(p.id) AS product_count, CAST(SUM(i.quantity) AS BIGINT) AS total_stock, ROUND(AVG(i.quantity), 4) AS avg_stock
        FROM v_products p JOIN v_shelf i ON i.product_id = p.id GROUP BY p.category
        ORDER BY total_stock DESC, category""",
    "inventory_value": """
        SELECT s.id AS store_id, s.name AS store, CAST(SUM(i.quantity * p.base_price) AS DOUBLE) AS total_value
        FROM v_stores s JOIN v_shelf i ON i.store_id = s.id JOIN v_products p ON p.id = i.product_id GROUP BY s.id, s.name
        ORDER BY total_value DESC, store_id""",
    "store_kpi": _store_kpi(None),
    "store_kpi_of_store": _store_kpi(4),
    "product_list": "SELECT id, name, category, 'pcs' AS unit FROM v_products ORDER BY category, name, id",
    # ledger
    "transaction_summary": """
        SELECT type, COUNT(*) AS count, CAST(SUM(change_amount) AS BIGINT) AS net_change, ROUND(AVG(ABS(change_amount)), 4) AS avg_amount
        FROM v_ledger WHERE created_at >= TIMESTAMP '2024-01-10 23:59:59' GROUP BY type
        ORDER BY count DESC, type""",
    "sales_over_time": _over_time("sale", "-", "total_sales"),
    "imports_over_time": _over_time("import", "", "total_imports"),
    "sales_trend": """
        SELECT CAST(created_at AS DATE) AS date, CAST(SUM(CASE WHEN type = 'sale' THEN -change_amount ELSE 0 END) AS BIGINT) AS sales,
               CAST(SUM(CASE WHEN type = 'import' THEN change_amount ELSE 0 END) AS BIGINT) AS imports,
               strftime(CAST(created_at AS DATE), '%b %-d') AS label
        FROM v_ledger WHERE type IN ('sale', 'import') AND created_at >= TIMESTAMP '2023-12-31 23:59:59' GROUP BY 1
        ORDER BY date""",
    "transactions_page": _transactions("l.type = 'sale'", "ORDER BY l.created_at DESC, l.id DESC LIMIT 20 OFFSET 40"),
    "transactions_page_info": """
        SELECT CAST(3 AS BIGINT) AS page, CAST(20 AS BIGINT) AS "limit", COUNT(*) AS total, CAST((COUNT(*) + 19) // 20 AS BIGINT) AS pages
        FROM v_ledger l JOIN v_stores s ON s.id = l.store_id JOIN v_products p ON p.id = l.product_id WHERE l.type = 'sale'""",
    "transaction_stats": """
        SELECT type, COUNT(*) AS count, CAST(SUM(change_amount) AS BIGINT) AS total_change, ROUND(AVG(change_amount), 4) AS avg_change,
               MIN(created_at) AS first_transaction, MAX(created_at) AS last_transaction
        FROM v_ledger GROUP BY type""",
    "ledger_balance": "SELECT store_id, product_id, id, quantity FROM v_levels",
    "ledger_balance_from_empty": """
        SELECT store_id, product_id, id, CAST(moved - LEAST(0, MIN(moved) OVER (PARTITION BY store_id, product_id
               ORDER BY created_at, id ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS quantity
        FROM v_running""",
    "ledger_sync": """
        SELECT i.store_id, i.product_id, CAST(CASE WHEN a.net IS NULL THEN i.quantity ELSE GREATEST(0, i.quantity + a.net) END AS BIGINT) AS quantity
        FROM v_shelf i LEFT JOIN (SELECT store_id, product_id, SUM(change_amount) AS net FROM v_ledger GROUP BY 1, 2) a
             ON a.store_id = i.store_id AND a.product_id = i.product_id""",
    "stock_update_to_ledger": """
        WITH d AS (SELECT i.store_id, i.product_id, CAST(GREATEST(0, i.quantity + SUM(l.change_amount)) - i.quantity AS BIGINT) AS change_amount
                   FROM v_shelf i JOIN v_ledger l ON l.store_id = i.store_id AND l.product_id = i.product_id
                   GROUP BY i.store_id, i.product_id, i.quantity)
        SELECT store_id, product_id, change_amount, CASE WHEN change_amount > 0 THEN 'import' ELSE 'sale' END AS type
        FROM d WHERE change_amount <> 0""",
    "stock_edit_outcomes": "SELECT user_id, outcome, COUNT(*) AS edits FROM v_edits GROUP BY 1, 2",
    "stock_edit_ledger": """
        SELECT id AS edit_id, store_id, product_id, change_amount, CASE WHEN change_amount > 0 THEN 'import' ELSE 'sale' END AS type,
               user_id AS created_by, created_at
        FROM (SELECT e.*, CAST(e.quantity - COALESCE(LAG(e.quantity) OVER (PARTITION BY e.store_id, e.product_id ORDER BY e.created_at, e.id),
                                                     s.quantity, 0) AS BIGINT) AS change_amount
              FROM v_edits e LEFT JOIN v_shelf s ON s.store_id = e.store_id AND s.product_id = e.product_id
              WHERE outcome = 'accepted')
        WHERE change_amount <> 0""",
    "stock_after_edits": """
        WITH l AS (SELECT store_id, product_id, CAST(arg_max(quantity, (created_at, id)) AS BIGINT) AS quantity,
                          CAST(arg_max(COALESCE(low_stock, 10), (created_at, id)) AS BIGINT) AS low_stock
                   FROM v_edits WHERE outcome = 'accepted' GROUP BY 1, 2)
        SELECT COALESCE(s.store_id, l.store_id) AS store_id, COALESCE(s.product_id, l.product_id) AS product_id,
               COALESCE(l.quantity, s.quantity) AS quantity, COALESCE(l.low_stock, s.low_stock) AS low_stock
        FROM v_shelf s FULL JOIN l ON l.store_id = s.store_id AND l.product_id = s.product_id""",
    "inventory_upsert": """
        WITH n AS (SELECT store_id, product_id * 50 AS product_id, CAST(SUM(change_amount) AS BIGINT) AS quantity
                   FROM v_ledger WHERE type = 'import' GROUP BY 1, 2)
        SELECT store_id, product_id, quantity, CAST(10 AS BIGINT) AS low_stock FROM n
        UNION ALL
        SELECT i.store_id, i.product_id, i.quantity, i.low_stock FROM v_shelf i
        WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.store_id = i.store_id AND n.product_id = i.product_id)""",
    "stock_patch": """
        WITH c AS (SELECT product_id * 10 + store_id - 1 AS id, COUNT(*) AS n FROM v_ledger WHERE type = 'adjustment' GROUP BY 1)
        SELECT i.id, i.store_id, i.product_id, COALESCE(c.n, i.quantity) AS quantity,
               CASE WHEN c.n % 2 = 0 THEN c.n * 3 ELSE i.low_stock END AS low_stock
        FROM v_shelf i LEFT JOIN c ON c.id = i.id""",
    # people
    "user_patch": "SELECT id, name, email, role_id, store_id, active FROM v_patched",
    "user_list": """
        SELECT u.id, u.name, u.email, u.active, u.role_id, r.name AS role FROM v_users u JOIN v_roles r ON r.id = u.role_id
        ORDER BY u.id DESC""",
    "role_permissions": """
        SELECT r.id, r.name, r.description,
               CAST(to_json(COALESCE(list(p.key ORDER BY p.key) FILTER (WHERE p.key IS NOT NULL), [])) AS VARCHAR) AS permissions
        FROM v_roles r LEFT JOIN v_bridge b ON b.role_id = r.id LEFT JOIN v_permissions p ON p.id = b.permission_id
        GROUP BY r.id, r.name, r.description
        ORDER BY r.id""",
    "permission_list": "SELECT id, key, 'Manage ' || 'Brand#' || CAST(id AS VARCHAR) AS label FROM v_permissions ORDER BY key",
    "user_permissions": """
        SELECT u.id AS user_id, r.name AS role, u.store_id, CAST(to_json(list(DISTINCT p.key ORDER BY p.key)) AS VARCHAR) AS permissions
        FROM v_users u JOIN v_roles r ON r.id = u.role_id JOIN v_bridge b ON b.role_id = r.id JOIN v_permissions p ON p.id = b.permission_id
        WHERE u.active GROUP BY u.id, r.name, u.store_id""",
    "role_permission_replace": """
        SELECT role_id, permission_id FROM v_bridge WHERE role_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000)
        UNION ALL SELECT s_suppkey, CAST(s_nationkey AS BIGINT) FROM supplier WHERE s_acctbal < 1000""",
    "delete_cascade": "SELECT role_id, permission_id FROM v_bridge WHERE permission_id <= 12",
    "delete_cascade_stock": """
        SELECT * FROM v_ledger WHERE store_id NOT IN (SELECT id FROM v_stores WHERE location = 'Region 1')""",
    "delete_users_set_null": """
        SELECT a.id, CASE WHEN u.id IS NULL THEN a.user_id END AS user_id, a.action
        FROM v_audit a LEFT JOIN v_users u ON u.id = a.user_id AND NOT u.active""",
    "visible_inventory": """
        SELECT i.*, u.id AS user_id FROM v_users u JOIN v_roles r ON r.id = u.role_id
        JOIN v_shelf i ON r.name = 'admin' OR i.store_id = u.store_id WHERE u.id IN (10, 11)""",
    "visible_totals": """
        WITH s AS (SELECT store_id, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS q FROM v_shelf GROUP BY 1)
        SELECT u.id AS user_id, r.name AS role,
               CASE WHEN r.name = 'admin' THEN (SELECT COUNT(*) FROM v_shelf) ELSE COALESCE(s.n, 0) END AS visible_rows,
               CASE WHEN r.name = 'admin' THEN (SELECT CAST(SUM(quantity) AS BIGINT) FROM v_shelf) ELSE COALESCE(s.q, 0) END AS visible_quantity
        FROM v_users u JOIN v_roles r ON r.id = u.role_id LEFT JOIN s ON s.store_id = u.store_id""",
    "user_role_lookup": """
        SELECT 'user' || CAST(c.c_custkey * 2 AS VARCHAR) || '@example.com' AS email, COALESCE(p.role, 'STAFF') AS role
        FROM customer c LEFT JOIN v_profiles p ON p.c_custkey = c.c_custkey * 2""",
    "profile_normalize": "SELECT employee_code, name, role, branch_id, email FROM v_profiles",
    "audit_log_search": """
        SELECT a.*, u.name AS user_name, u.email AS user_email FROM v_audit a LEFT JOIN v_users u ON u.id = a.user_id
        WHERE a.action = 'UPDATE' AND a.created_at >= TIMESTAMP '2024-01-05' AND a.created_at <= TIMESTAMP '2024-01-25'
        ORDER BY a.created_at DESC, a.id DESC LIMIT 50 OFFSET 10""",
    "audit_capture": f"""
        WITH after AS (
            SELECT * FROM v_patched WHERE id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)
            UNION ALL
            SELECT -s_suppkey - 1, s_name, NULL, 2, s_suppkey % 10 + 1, TRUE FROM supplier)
        SELECT CAST(NULL AS BIGINT) AS user_id, CASE WHEN b.id IS NULL THEN 'CREATE' WHEN a.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
               'users' AS table_name, COALESCE(a.id, b.id) AS record_id,
               CASE WHEN b.id IS NOT NULL THEN {IMAGE.format("b")} END AS old_value,
               CASE WHEN a.id IS NOT NULL THEN {IMAGE.format("a")} END AS new_value
        FROM v_users b FULL JOIN after a ON a.id = b.id
        WHERE (b.id, b.name, b.email, b.role_id, b.store_id, b.active) IS DISTINCT FROM (a.id, a.name, a.email, a.role_id, a.store_id, a.active)""",
    # cleaning, loading, planning
    "validate_rows": "SELECT id, CAST(to_json(errors) AS VARCHAR) AS errors FROM v_checked",
    "validate_inventory_rows": """
        WITH f AS (SELECT l_orderkey AS form_id, CAST(l_suppkey % 11 AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS product_id,
                          CAST(l_quantity AS INTEGER) AS q,
                          CASE WHEN l_linenumber = 7 THEN 'many' WHEN l_linenumber > 3 THEN '10' END AS low_stock FROM lineitem)
        SELECT form_id, store_id, product_id,
               CASE WHEN q % 10 = 0 THEN CAST(-q AS VARCHAR) WHEN q % 10 = 1 THEN CAST(q AS VARCHAR) || '.5' ELSE CAST(q AS VARCHAR) END AS quantity,
               low_stock,
               CAST(to_json(list_filter([
                   CASE WHEN store_id = '0' THEN 'Valid store_id is required' END,
                   CASE WHEN product_id = '0' THEN 'Valid product_id is required' END,
                   CASE WHEN q % 10 IN (0, 1) THEN 'Quantity must be a non-negative integer' END,
                   CASE WHEN low_stock = 'many' THEN 'Low stock threshold must be a non-negative integer' END], lambda x: x IS NOT NULL)) AS VARCHAR) AS errors
        FROM f""",
    "sanitize_strings": f"""
        SELECT page_id, replace(replace(trim(url, {JS_SPACE}), '<', ''), '>', '') AS url,
               replace(replace(trim(html, {JS_SPACE}), '<', ''), '>', '') AS html FROM pages""",
    "pos_parsed": """
        SELECT transaction_id, branch_id, product_id, quantity, unit_price, ts AS timestamp FROM v_pos WHERE quantity <> 5""",
    "pos_malformed": """
        SELECT substr('{"transaction_id":', 1, 15) AS value, COUNT(*) AS lines FROM v_pos WHERE quantity = 5 GROUP BY 1""",
    "branch_list": "SELECT id, name FROM v_branches ORDER BY id",
    "store_list": "SELECT id, name, location FROM v_stores ORDER BY name, id",
    "transaction_by_id": _transactions("l.id = 77", ""),
    "transactions_page_after": _transactions(
        "l.type = 'sale' AND (l.created_at, l.id) < (TIMESTAMP '2024-01-20', 500)", "ORDER BY l.created_at DESC, l.id DESC LIMIT 30"),
    "permissions_of_role": """
        SELECT p.id, p.key, 'Manage Brand#' || CAST(p.id AS VARCHAR) AS label
        FROM v_permissions p JOIN v_bridge b ON b.permission_id = p.id WHERE b.role_id = 3""",
    "validate_ledger_rows": """
        SELECT id, CAST(to_json(list_filter([
                   CASE WHEN product_id = 9 THEN 'store_id, product_id, change_amount, type are required' END,
                   CASE WHEN type = 'import' THEN 'type must be one of: import, sale, adjustment' END], lambda x: x IS NOT NULL)) AS VARCHAR) AS errors
        FROM v_ledger""",
    "missing_sign_up_fields": """
        SELECT id, CAST(to_json(list_filter([CASE WHEN name IS NULL THEN 'name' END, CASE WHEN role_id = '' THEN 'role_id' END],
                   lambda x: x IS NOT NULL)) AS VARCHAR) AS missing
        FROM v_signups""",
    "accepted_sign_ups": "SELECT id, email FROM v_checked WHERE len(errors) = 0",
    "rejected_sign_ups": """
        SELECT error, COUNT(*) AS forms FROM (SELECT unnest(errors) AS error FROM v_checked) GROUP BY 1""",
    "duplicate_part_names": """
        SELECT p_name, p_brand, COUNT(*) AS copies FROM part GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "uniqueness_report": " UNION ALL ".join(
        f"SELECT 'Unique {table}({keys})' AS check_name, CASE WHEN COUNT(*) > 0 THEN 'FAILED' ELSE 'PASSED' END AS status, "
        f"CAST(COUNT(*) AS VARCHAR) || ' repeated keys.' AS details FROM (SELECT 1 FROM {view} GROUP BY {keys} HAVING COUNT(*) > 1)"
        for table, keys, view in [
            ("branches", "name", "v_branches"),
            ("products", "name", "v_products"),
            ("inventory", "store_id, product_id", "v_shelf"),
            ("inventory_current", "branch_id, product_id", "v_stock"),
            ("raw events", "transaction_id", "v_pos"),
            ("staged events", "transaction_id", "(SELECT DISTINCT transaction_id FROM v_pos)"),
            ("order lines", "l_orderkey, l_linenumber", "lineitem"),
        ]
    ),
    "json_array_load": """
        WITH e AS (
            SELECT p_partkey, 0 AS pos, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS name, p_type, p_retailprice, p_size FROM part
            UNION ALL SELECT p_partkey, 1, p_name || ' ' || p_type, p_type, p_retailprice, p_size FROM part)
        SELECT name, p_type AS category, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS base_price, CAST(p_size AS BIGINT) AS popularity_weight
        FROM (SELECT DISTINCT ON (name) * FROM e ORDER BY name, p_partkey, pos)
        WHERE name NOT IN (SELECT name FROM v_products WHERE category = 'ECONOMY')""",
    "insert_absent_stock": """
        SELECT store_id, product_id, change_amount
        FROM (SELECT DISTINCT ON (store_id, product_id) store_id, product_id * 50 AS product_id, change_amount
              FROM v_ledger ORDER BY store_id, v_ledger.product_id, id) n
        WHERE NOT EXISTS (SELECT 1 FROM v_shelf i WHERE i.store_id = n.store_id AND i.product_id = n.product_id)""",
    "date_volume_plan": """
        WITH h AS (SELECT CAST(MIN(created_at) AS DATE) AS a, CAST(MAX(created_at) AS DATE) AS z, COUNT(*) AS n FROM v_headers),
        d AS (SELECT CAST(UNNEST(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d, n // (z - a + 1) AS base FROM h)
        SELECT d, CAST(CASE WHEN isodow(d) IN (6, 7) THEN (3 * base + 1) // 2 ELSE base END AS BIGINT) AS num_orders FROM d""",
    "weighted_sample": """
        SELECT category, id, ROW_NUMBER() OVER (PARTITION BY category ORDER BY t, id) AS pick_rank
        FROM (SELECT category, id, -ln((CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':7'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
                     / CAST(popularity_weight AS DOUBLE) AS t FROM v_products WHERE popularity_weight > 0)
        QUALIFY pick_rank <= 3""",
}


def _views_for(sql: str) -> list[str]:
    """The views a statement needs, each after those it builds on."""
    ordered: list[str] = []
    for name in dict.fromkeys(re.findall(r"\bv_\w+", sql)):
        for needed in [*_views_for(VIEWS[name]), name]:
            if needed not in ordered:
                ordered.append(needed)
    return ordered


def _complete(sql: str) -> str:
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in _views_for(sql))
    body = sql.strip()
    if not views:
        return body
    if body.startswith("WITH "):
        return f"WITH {views},\n{body[len('WITH '):]}"
    return f"WITH {views}\n{body}"


def statements() -> dict[str, str]:
    return {name: _complete(sql) for name, sql in STATEMENTS.items()}
