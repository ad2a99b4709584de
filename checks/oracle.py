"""The same queries in SQL, written apart from the library."""

from __future__ import annotations

from checks.registry import CATEGORY, CITY, MONTHS

FEEDS = """
customer_feed AS (
  SELECT CASE WHEN c_custkey <> 7 THEN 'C' || c_custkey END AS customer_id,
         CASE WHEN c_custkey % 41 <> 0 THEN c_name END AS customer_name,
         CASE WHEN c_custkey % 43 <> 0 THEN n_name END AS city,
         CASE WHEN c_custkey % 47 = 0 THEN '2023-13-01' ELSE '2022-03-04' END AS signup_date,
         c_custkey * 2 AS seq
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT 'C' || c_custkey, 'Copy ' || c_name, 'Elsewhere', '2022-03-05', c_custkey * 2 + 1
  FROM customer WHERE c_custkey % 10 = 0
),
product_feed AS (
  SELECT 'P' || p_partkey AS product_id,
         CASE WHEN p_partkey % 53 <> 0 THEN p_name END AS product_name,
         CASE WHEN p_partkey % 59 <> 0 THEN p_type END AS category,
         CASE WHEN p_partkey % 37 = 0 THEN 'n/a' WHEN p_partkey % 61 = 0 THEN 'abc'
              ELSE CAST(p_retailprice AS VARCHAR) END AS price,
         p_partkey * 2 AS seq
  FROM part
  UNION ALL
  SELECT 'P' || p_partkey, 'Copy ' || p_name, p_type, '1.0', p_partkey * 2 + 1
  FROM part WHERE p_partkey % 10 = 0
),
order_feed AS (
  SELECT 'O' || l_orderkey || '-' || l_linenumber AS order_id,
         CASE WHEN o_custkey = 7 THEN NULL
              WHEN o_custkey % 67 = 0 THEN 'X' || o_custkey
              ELSE 'C' || o_custkey END AS customer_id,
         CASE WHEN l_partkey % 71 = 0 THEN 'X' || l_partkey
              ELSE 'P' || l_partkey END AS product_id,
         CASE WHEN l_partkey % 29 = 0 THEN 'bad' WHEN l_partkey % 73 = 0 THEN 'nan'
              WHEN l_suppkey % 23 = 0 THEN '-3' WHEN l_suppkey % 31 = 0 THEN '0'
              ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
         CASE WHEN l_orderkey % 53 = 0 THEN '2023-13-01' WHEN l_orderkey % 59 = 0 THEN NULL
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         l_shipdate, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

FIRSTS = """
first_customers AS (
  SELECT customer_id, customer_name, city, try_strptime(signup_date, '%Y-%m-%d') AS signup_date
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seq) AS place
        FROM customer_feed) WHERE place = 1
),
first_products AS (
  SELECT product_id, product_name, category, try_cast(price AS DOUBLE) AS price
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq) AS place
        FROM product_feed) WHERE place = 1
),
first_orders AS (
  SELECT order_id, customer_id, product_id,
         CASE WHEN NOT isnan(try_cast(quantity AS DOUBLE)) THEN try_cast(quantity AS DOUBLE) END
           AS quantity,
         try_strptime(order_date, '%Y-%m-%d') AS order_date,
         copies
  FROM (SELECT *,
               row_number() OVER (PARTITION BY order_id
                 ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS place,
               count(*) OVER (PARTITION BY order_id) AS copies
        FROM order_feed) WHERE place = 1
)"""

CLEAN = """
good_customers AS (
  SELECT * FROM first_customers WHERE customer_name IS NOT NULL AND signup_date IS NOT NULL
),
good_products AS (
  SELECT * FROM first_products WHERE product_name IS NOT NULL AND price IS NOT NULL
),
complete_orders AS (
  SELECT order_id, customer_id, product_id, quantity, order_date FROM first_orders
  WHERE order_date IS NOT NULL AND quantity IS NOT NULL
),
good_orders AS (SELECT * FROM complete_orders WHERE quantity > 0)"""

FACT = """
merged AS (
  SELECT o.order_id, o.customer_id, o.product_id, o.quantity, o.order_date,
         c.customer_name, c.city, p.product_name, p.category, p.price,
         c.customer_name IS NOT NULL AND p.product_name IS NOT NULL AS is_valid
  FROM good_orders o
  LEFT JOIN good_customers c ON o.customer_id IS NOT DISTINCT FROM c.customer_id
  LEFT JOIN good_products p ON o.product_id IS NOT DISTINCT FROM p.product_id
),
ss AS (
  SELECT order_id, order_date, strftime(order_date, '%Y-%m') AS year_month,
         customer_id, customer_name, city, product_id, product_name, category,
         quantity, price, round_even(quantity * price * 100, 0) / 100 AS total_amount, is_valid
  FROM merged
),
sales_all AS (SELECT * EXCLUDE (is_valid) FROM ss),
f AS (SELECT * EXCLUDE (is_valid) FROM ss WHERE is_valid)"""

SELECTED = f"""
picked AS (
  SELECT * FROM f WHERE category = '{CATEGORY}' AND city = '{CITY}'
    AND year_month >= '{MONTHS[0]}' AND year_month <= '{MONTHS[1]}'
)"""

QUALITY = """
q AS (
  SELECT (SELECT count(*) FROM customer_feed) AS raw_customers,
         (SELECT count(*) FROM good_customers) AS clean_customers,
         (SELECT count(*) FROM product_feed) AS raw_products,
         (SELECT count(*) FROM good_products) AS clean_products,
         (SELECT count(*) FROM order_feed) AS raw_orders,
         (SELECT count(*) FROM good_orders) AS clean_orders,
         (SELECT count(*) FROM merged WHERE customer_name IS NULL) AS missing_customers,
         (SELECT count(*) FROM merged WHERE product_name IS NULL) AS missing_products,
         (SELECT count(*) FROM merged WHERE is_valid) AS valid_orders
)"""

MONEY = "round_even(coalesce(sum(total_amount), 0.0) * 100, 0) / 100"
MEAN = f"{MONEY} / nullif(count(total_amount), 0)"
UNITS = "coalesce(sum(quantity), 0.0)"
CUSTOMER = "customer_id, customer_name, city"
PRODUCT = "product_id, product_name, category"
ALL_MONTHS = [f"{1995 + n // 12}-{n % 12 + 1:02d}" for n in range(80)]


def _present(keys: str) -> str:
    return " AND ".join(f"{key.strip()} IS NOT NULL" for key in keys.split(","))


def _grouped(table: str, keys: str, measures: str) -> str:
    return f"SELECT {keys}, {measures} FROM {table} WHERE {_present(keys)} GROUP BY {keys}"


def _top(table: str, keys: str, measures: str, by: str, k: int) -> str:
    return f"{_grouped(table, keys, measures)} ORDER BY {by} DESC, {keys} LIMIT {k}"


def _ranked(table: str, keys: str, measures: str, by: str, k: int) -> str:
    top = _top(table, keys, measures, by, k)
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY {by} DESC, {keys}) AS INTEGER) AS rank, * "
        f"FROM ({top})"
    )


def _with(body: str) -> str:
    parts = ",".join((FEEDS, FIRSTS, CLEAN, FACT, SELECTED, QUALITY))
    return f"WITH {parts}\n{body}"


_KPIS = f"""
SELECT {MONEY} AS total_revenue, count(*) AS total_orders,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT product_id) AS unique_products,
       coalesce({MEAN}, 0.0) AS avg_order_value,
       coalesce(max(total_amount), 0.0) AS largest_order
FROM """

_SHARE = f"""
SELECT category, revenue,
       round_even(revenue / nullif((SELECT {MONEY} FROM sales_all), 0) * 100 * 10, 0) / 10
         AS share_pct
FROM ({_grouped("sales_all", "category", f"{MONEY} AS revenue")})"""

_TREND = f"""
SELECT year_month, revenue,
       repeat('█', CAST(trunc(revenue / max(revenue) OVER () * 30) AS INTEGER)) AS bar
FROM ({_grouped("sales_all", "year_month", f"{MONEY} AS revenue")})"""

_CUSTOMER_TABLE = _ranked(
    "f",
    CUSTOMER,
    f"count(order_id) AS orders, {MONEY} AS total_spent, {MEAN} AS avg_order",
    "total_spent",
    50,
)

_HISTOGRAM = """
SELECT bin, lowest + bin * width AS bin_start, lowest + (bin + 1) * width - 1 AS bin_end,
       count(*) AS customers
FROM (SELECT lowest, width, (n - lowest) // width AS bin
      FROM (SELECT n, min(n) OVER () AS lowest,
                   (max(n) OVER () - min(n) OVER () + 1 + 19) // 20 AS width
            FROM (SELECT customer_id, count(order_id) AS n FROM f
                  WHERE customer_id IS NOT NULL GROUP BY customer_id)))
GROUP BY bin, lowest, width"""

_MATRIX_COLUMNS = ", ".join(
    f"round_even(coalesce(sum(total_amount) FILTER (year_month = '{month}'), 0.0) * 100, 0) / 100"
    f' AS "{month}"'
    for month in ALL_MONTHS
)

_FUNNEL = " UNION ALL ".join(
    f"SELECT {number} AS stage_number, '{stage}' AS stage, {counter} AS row_count FROM q"
    for number, (stage, counter) in enumerate(
        (
            ("Raw Customers", "raw_customers"),
            ("Clean Customers", "clean_customers"),
            ("Raw Products", "raw_products"),
            ("Clean Products", "clean_products"),
            ("Raw Orders", "raw_orders"),
            ("Clean Orders", "clean_orders"),
            ("Valid Orders", "valid_orders"),
        ),
        start=1,
    )
)

_TYPES = (
    ("order_id", "string"),
    ("order_date", "timestamp_ntz"),
    ("year_month", "string"),
    ("customer_id", "string"),
    ("customer_name", "string"),
    ("city", "string"),
    ("product_id", "string"),
    ("product_name", "string"),
    ("category", "string"),
    ("quantity", "double"),
    ("price", "double"),
    ("total_amount", "double"),
)

_SCHEMA = " UNION ALL ".join(
    f"SELECT {position} AS position, '{name}' AS column_name, '{kind}' AS data_type"
    for position, (name, kind) in enumerate(_TYPES, start=1)
)

_BODIES = {
    "feed_profile": """
      SELECT 'customers' AS feed, count(*) AS row_count, 4 AS column_count FROM customer_feed
      UNION ALL SELECT 'products', count(*), 4 FROM product_feed
      UNION ALL SELECT 'orders', count(*), 5 FROM order_feed""",
    "preview_raw_orders": """
      SELECT order_id, customer_id, product_id, quantity, order_date FROM order_feed
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice LIMIT 3""",
    "dedup_orders_keep_first": "SELECT * EXCLUDE (copies) FROM first_orders",
    "dedup_orders_counting": "SELECT * FROM first_orders",
    "clean_customers": "SELECT * FROM good_customers",
    "clean_products": "SELECT * FROM good_products",
    "clean_orders": "SELECT * FROM good_orders",
    "clean_orders_inferred_dates": "SELECT * FROM good_orders WHERE length(order_id) % 5 <> 1",
    "cleaning_counts": """
      SELECT 'customers' AS feed, raw_customers AS raw_rows, clean_customers AS clean_rows,
             raw_customers - clean_customers AS removed_rows,
             CAST(NULL AS BIGINT) AS rejected_quantity FROM q
      UNION ALL SELECT 'products', raw_products, clean_products,
             raw_products - clean_products, NULL FROM q
      UNION ALL SELECT 'orders', raw_orders, clean_orders, raw_orders - clean_orders,
             (SELECT count(*) FROM complete_orders WHERE quantity <= 0) FROM q""",
    "merged_orders": "SELECT * FROM merged",
    "match_counts": """
      SELECT count(*) AS merged_rows,
             count(*) FILTER (customer_name IS NULL) AS missing_customers,
             count(*) FILTER (product_name IS NULL) AS missing_products,
             count(*) FILTER (is_valid) AS valid_orders FROM merged""",
    "sales_summary_all": "SELECT * FROM sales_all",
    "sales_summary_valid": "SELECT * FROM f",
    "sales_in_date_order": "SELECT * FROM f",
    "preview_sales": "SELECT * FROM f ORDER BY order_date, order_id LIMIT 20",
    "total_revenue": f"SELECT {MONEY} AS total_revenue FROM sales_all",
    "top_customers_5": _ranked("sales_all", CUSTOMER, f"{MONEY} AS total_amount", "total_amount", 5),
    "best_products_5": _ranked(
        "sales_all", PRODUCT, f"{UNITS} AS units_sold, {MONEY} AS revenue", "units_sold", 5
    ),
    "category_revenue_share": _SHARE,
    "category_share_display": f"""
      SELECT category AS "Category", '₦' || format('{{:,.2f}}', revenue) AS "Revenue",
             share_pct AS "% Share" FROM ({_SHARE})""",
    "monthly_trend": _TREND,
    "monthly_trend_lines": f"""
      SELECT year_month, '  ' || year_month || '  ' || rpad(bar, 32, ' ') || '  ₦'
             || lpad(format('{{:,.2f}}', revenue), 14, ' ') AS line FROM ({_TREND})""",
    "average_order_value": f"SELECT {MEAN} AS average_order_value FROM sales_all",
    "run_summary": f"""
      SELECT count(*) AS total_orders, {MONEY} AS total_revenue, {MEAN} AS average_order_value,
             count(DISTINCT customer_id) AS unique_customers,
             count(DISTINCT product_id) AS unique_products,
             CAST(min(order_date) AS DATE) AS first_date,
             CAST(max(order_date) AS DATE) AS last_date FROM sales_all""",
    "filter_domains": """
      SELECT 'category' AS domain, 0 AS position, 'All' AS value
      UNION ALL SELECT 'city', 0, 'All'
      UNION ALL SELECT domain,
             CAST(row_number() OVER (PARTITION BY domain ORDER BY value) AS INTEGER), value
      FROM (SELECT DISTINCT 'category' AS domain, category AS value FROM f
            UNION ALL SELECT DISTINCT 'city', city FROM f
            UNION ALL SELECT DISTINCT 'year_month', year_month FROM f)
      WHERE value IS NOT NULL""",
    "filtered_sales": "SELECT * FROM picked",
    "kpis": _KPIS + "f",
    "kpis_filtered": _KPIS + "picked",
    "monthly_revenue": _grouped("f", "year_month", f"{MONEY} AS revenue"),
    "category_revenue": f"""
      SELECT category, revenue,
             round_even(revenue / nullif(round_even(sum(revenue) OVER () * 100, 0) / 100, 0)
                        * 100 * 10, 0) / 10 AS share_pct
      FROM ({_grouped("f", "category", f"{MONEY} AS revenue")})""",
    "top_cities": _top("f", "city", f"{MONEY} AS revenue", "revenue", 10),
    "category_revenue_asc": _grouped("f", "category", f"{MONEY} AS revenue"),
    "monthly_orders": _grouped("f", "year_month", f"{MONEY} AS revenue, count(order_id) AS orders"),
    "monthly_orders_filtered": _grouped(
        "picked", "year_month", f"{MONEY} AS revenue, count(order_id) AS orders"
    ),
    "monthly_avg_order": _grouped("f", "year_month", f"{MEAN} AS avg_order_value"),
    "revenue_heatmap_long": _grouped("f", "year_month, category", f"{MONEY} AS revenue"),
    "revenue_heatmap_dense": f"""
      SELECT category, year_month, coalesce(revenue, 0.0) AS revenue
      FROM (SELECT DISTINCT category FROM f WHERE category IS NOT NULL)
      CROSS JOIN (SELECT DISTINCT year_month FROM f WHERE category IS NOT NULL)
      LEFT JOIN ({_grouped("f", "year_month, category", f"{MONEY} AS revenue")})
        USING (category, year_month)""",
    "revenue_heatmap_matrix": f"""
      SELECT category, {_MATRIX_COLUMNS} FROM f WHERE category IS NOT NULL GROUP BY category""",
    "top_products_units": _top("f", "product_name, category", f"{UNITS} AS units", "units", 10),
    "top_products_revenue": _top(
        "f", "product_name, category", f"{MONEY} AS revenue", "revenue", 10
    ),
    "product_bubble": _grouped(
        "f",
        "category, product_name",
        f"{UNITS} AS units, {MONEY} AS revenue, count(order_id) AS orders",
    ),
    "product_table": _grouped(
        "f", PRODUCT, f"{UNITS} AS units_sold, count(order_id) AS orders, {MONEY} AS revenue"
    ),
    "top_customers_10": _top("f", CUSTOMER, f"{MONEY} AS total_amount", "total_amount", 10),
    "orders_per_customer": _grouped("f", "customer_id", "count(order_id) AS order_count"),
    "orders_histogram": _HISTOGRAM,
    "customers_by_city": _top(
        "f", "city", "count(DISTINCT customer_id) AS customers", "customers", 12
    ),
    "avg_spend_by_city": _top("f", "city", f"{MEAN} AS avg_spend", "avg_spend", 12),
    "customer_table_50": _CUSTOMER_TABLE,
    "customer_table_display": f"""
      SELECT rank, customer_id AS "ID", customer_name AS "Name", city AS "City",
             orders AS "Orders", '₦' || format('{{:,.2f}}', total_spent) AS "Total Spent",
             '₦' || format('{{:,.2f}}', avg_order) AS "Avg Order" FROM ({_CUSTOMER_TABLE})""",
    "currency_labels": f"""
      SELECT year_month, '₦' || format('{{:,.2f}}', revenue) AS revenue,
             format('{{:,}}', orders) AS orders,
             '₦' || format('{{:,.0f}}', revenue) AS revenue_whole
      FROM ({_grouped("f", "year_month", f"{MONEY} AS revenue, count(order_id) AS orders")})""",
    "quality_report": "SELECT * FROM q",
    "removed_deltas": """
      SELECT raw_customers - clean_customers AS removed_customers,
             raw_products - clean_products AS removed_products,
             raw_orders - clean_orders AS removed_orders FROM q""",
    "cleaning_funnel": _FUNNEL,
    "quality_match_counts": "SELECT missing_customers, missing_products, valid_orders FROM q",
    "load_roundtrip": "SELECT * FROM sales_all",
    "sketched_customers": """
      SELECT city, count(*) AS total_orders, count(DISTINCT customer_id) AS customers, true AS close
      FROM f WHERE city IS NOT NULL GROUP BY city""",
    "load_kept_after_failure": "SELECT * FROM sales_all",
    "load_roundtrip_valid": "SELECT * FROM f",
    "load_count_check": """
      SELECT count(*) AS rows_loaded, count(*) AS rows_written, true AS matches FROM sales_all""",
    "schema_report": _SCHEMA,
    "catalog_table": "SELECT * FROM sales_all",
    "catalog_table_schema": _SCHEMA,
    "sales_date_positions": """
      SELECT order_id, row_number() OVER (ORDER BY order_date, order_id) AS position FROM f""",
    "monthly_revenue_positions": """
      SELECT year_month, row_number() OVER (ORDER BY year_month) AS position
      FROM (SELECT DISTINCT year_month FROM f)""",
    "product_table_positions": f"""
      SELECT product_id, product_name, category, row_number() OVER (
        ORDER BY revenue DESC, product_id, product_name, category) AS position
      FROM ({_grouped("f", PRODUCT, f"{MONEY} AS revenue")})""",
    "top_customers_display": f"""
      SELECT rank, customer_id AS "ID", customer_name AS "Name", city AS "City",
             '₦' || format('{{:,.2f}}', total_amount) AS "Total Spent"
      FROM ({_ranked("sales_all", CUSTOMER, f"{MONEY} AS total_amount", "total_amount", 5)})""",
    "best_products_display": f"""
      SELECT rank, product_id AS "ID", product_name AS "Product", category AS "Category",
             units_sold AS "Units", '₦' || format('{{:,.2f}}', revenue) AS "Revenue"
      FROM ({_ranked("sales_all", PRODUCT, f"{UNITS} AS units_sold, {MONEY} AS revenue", "units_sold", 5)})""",
    "product_table_display": f"""
      SELECT product_id, product_name, category, units_sold, orders,
             '₦' || format('{{:,.2f}}', revenue) AS revenue
      FROM ({_grouped("f", PRODUCT, f"{UNITS} AS units_sold, count(order_id) AS orders, {MONEY} AS revenue")})""",
    "csv_export_odd_names": """
      SELECT * REPLACE (CASE length(order_id) % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' || customer_name || ' '
        WHEN 2 THEN customer_name || chr(10) || 'said "so", twice' WHEN 3 THEN customer_name END AS customer_name)
      FROM f""",
    "csv_export_roundtrip": "SELECT * FROM f",
    "csv_export_single_file": "SELECT * FROM f",
    "csv_ingest_roundtrip": "SELECT * FROM good_orders",
    "batch_run_from_csv": "SELECT * FROM sales_all",
}

ORACLE_SQL = {name: _with(body) for name, body in _BODIES.items()}
