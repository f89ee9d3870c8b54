"""Independent DuckDB SQL for every oracle-checked query.

The driver registers the raw tables (``lineitem``, ``supplier`` ...) as views;
the fixture views of FIXTURES.md section C are re-stated here as CTEs, so an
oracle never depends on the Spark code it checks.  Type rules (SURVEY section
5): money leaves as DOUBLE, integer sums as BIGINT, hours as INTEGER.
"""

from __future__ import annotations

from . import params as P

VIEW_SQL = {
    "fct": """SELECT l_orderkey AS transaction_id, CAST(l_shipdate AS DATE) AS transaction_date,
        l_shipdate AS transaction_time, CAST(l_quantity AS BIGINT) AS transaction_qty,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS transaction_total,
        l_suppkey AS store_id, l_partkey AS product_id FROM lineitem""",
    "stores": """SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS store_location,
        'balance ' || CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS store_description
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "products": """SELECT p_partkey AS product_id, p_type AS product_category, p_name AS product_detail,
        CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price FROM part""",
    "timed": """SELECT event_id AS transaction_id, CAST(ts AS DATE) AS transaction_date,
        ts AS transaction_time, CAST(1 AS BIGINT) AS transaction_qty,
        CAST(value AS DECIMAL(18,2)) AS transaction_total, user_id AS store_id FROM events""",
    "timed_stores": "SELECT c_custkey AS store_id, c_mktsegment AS store_name FROM customer",
    "reviews": """SELECT d.doc_id AS review_id, d.doc_id % 10 AS store_id,
        'user.' || CAST(d.doc_id AS VARCHAR) || '@example.com' AS email, d.text AS review,
        1 + 2 * l.quality + 2 * (1 - l.toxic) AS score
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "reviews_sentiment": """SELECT d.doc_id AS review_id, d.doc_id % 10 AS store_id,
        'user.' || CAST(d.doc_id AS VARCHAR) || '@example.com' AS email, d.text AS review,
        1 + 2 * l.quality + 2 * (1 - l.toxic) AS score,
        CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'positive'
             WHEN l.quality = 0 AND l.toxic = 1 THEN 'negative'
             WHEN l.quality = 1 AND l.toxic = 1 THEN 'mixed'
             WHEN l.quality = 0 AND l.toxic = 0 THEN 'neutral' END AS sentiment
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "registrations": """SELECT event_id AS device_id, event_type AS mac_address,
        epoch(ts) AS registration_timestamp, user_id FROM events""",
    "change_rows": """SELECT event_id, user_id, event_type AS op, value,
        CAST(dayofmonth(ts) AS INTEGER) AS batch FROM events""",
    "daily_events": """SELECT event_id, user_id, value, CAST(ts AS DATE) AS date,
        event_type AS topic FROM events""",
}

_Y = P.YEAR
_STORE = P.NAMED_STORE

# Agg_1 of the dashboard (NB daily query) without its ORDER BY.
AGG1 = f"""SELECT store_name, product_detail,
      make_date(year(transaction_date), month(transaction_date), day(transaction_date)) AS month_day,
      CAST(SUM(transaction_id) AS BIGINT) AS total_transactions,
      CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales,
      CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold
    FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id
    LEFT JOIN products ON fct.product_id = products.product_id
    WHERE YEAR(transaction_date) = {_Y}
    GROUP BY store_name, product_detail, month_day"""

# Agg_2: top 10 products by quantity.
AGG2 = """SELECT product_detail, CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold
    FROM fct LEFT JOIN products ON fct.product_id = products.product_id
    GROUP BY product_detail ORDER BY total_quantity_sold DESC, product_detail LIMIT 10"""

# Agg_3: quantity and sales per store and hour.
AGG3 = """SELECT store_name, CAST(HOUR(transaction_time) AS INTEGER) AS hour_of_day,
      CAST(SUM(transaction_qty) AS BIGINT) AS total_transactions_per_hour,
      CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_store_sales_per_hour
    FROM timed LEFT JOIN timed_stores ON timed.store_id = timed_stores.store_id
    GROUP BY HOUR(transaction_time), store_name"""


def with_views(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause defining the named fixture views (then ``extra`` CTEs)."""
    parts = [f"{n} AS ({VIEW_SQL[n]})" for n in names]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n"


def ratio2(num: str, den: str) -> str:
    """SQL twin of :func:`ledgerlens.functions.scalars.ratio2`."""
    return (f"CAST(ROUND(CAST(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) "
            f"AS DECIMAL(38,6)), 2) AS DOUBLE)")


def avg2(col: str) -> str:
    """SQL twin of :func:`ledgerlens.functions.scalars.avg2`."""
    return ratio2(f"SUM({col})", f"COUNT({col})")


def money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DOUBLE)"


STAR_SQL: dict[str, str] = {
    "agg_daily_store_product": with_views("fct", "stores", "products") + AGG1
    + " ORDER BY store_name, month_day",

    "agg_hourly_store": with_views("timed", "timed_stores") + AGG3 + " ORDER BY store_name, hour_of_day",

    "agg_product_qty": with_views("fct", "products") + """
        SELECT product_detail, CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold
        FROM fct LEFT JOIN products ON fct.product_id = products.product_id GROUP BY product_detail""",

    "topk_products": with_views("fct", "products") + AGG2,

    "agg_count_column": with_views("reviews", "stores") + """
        SELECT store_name, COUNT(review_id) AS total_reviews
        FROM reviews LEFT JOIN stores ON reviews.store_id = stores.store_id
        GROUP BY store_name ORDER BY total_reviews DESC""",

    "sort_desc_alias": with_views("reviews", "stores") + """
        SELECT *, row_number() OVER (ORDER BY total_reviews DESC, store_name NULLS FIRST) AS position
        FROM (SELECT store_name, COUNT(review_id) AS total_reviews
              FROM reviews LEFT JOIN stores ON reviews.store_id = stores.store_id GROUP BY store_name)""",

    "sort_multi_key": with_views("timed", "timed_stores", extra={"agg3": AGG3}) + """
        SELECT *, row_number() OVER (ORDER BY store_name NULLS FIRST, hour_of_day) AS position FROM agg3""",

    "topk_products_store": with_views("fct", "stores", "products") + f"""
        SELECT store_name, product_detail, CAST(SUM(transaction_total) AS DOUBLE) AS total_quantity_sold
        FROM fct LEFT JOIN products ON fct.product_id = products.product_id
        LEFT JOIN stores ON fct.store_id = stores.store_id
        WHERE store_name = '{_STORE}'
        GROUP BY store_name, product_detail
        ORDER BY total_quantity_sold DESC, product_detail LIMIT {P.TOP_PER_STORE}""",

    "top1_hour_store": with_views("timed", "timed_stores") + f"""
        SELECT store_name, CAST(HOUR(transaction_time) AS INTEGER) AS hour_of_day,
          CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_transactions
        FROM timed LEFT JOIN timed_stores ON timed.store_id = timed_stores.store_id
        WHERE store_name = '{P.NAMED_TIMED_STORE}'
        GROUP BY store_name, hour_of_day ORDER BY total_transactions DESC, hour_of_day LIMIT 1""",

    "filter_year_eq": with_views("fct") + f"""
        SELECT transaction_id, transaction_date, transaction_qty,
          CAST(transaction_total AS DOUBLE) AS transaction_total, store_id, product_id
        FROM fct WHERE YEAR(transaction_date) = {_Y}""",

    "filter_eq_string": with_views("fct", "stores") + f"""
        SELECT transaction_id, transaction_date, transaction_qty,
          CAST(transaction_total AS DOUBLE) AS transaction_total, fct.store_id, product_id, store_name
        FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id
        WHERE store_name = '{_STORE}'""",

    "filter_dq_string": with_views("reviews_sentiment") + """
        SELECT * FROM reviews_sentiment WHERE sentiment = 'mixed'""",

    "filter_batch_range": with_views("change_rows") + f"""
        SELECT * FROM change_rows WHERE batch >= {P.BATCH_RANGE[0]} AND batch <= {P.BATCH_RANGE[1]}""",

    "filter_rank_le": with_views("fct", "stores") + f"""
        SELECT * FROM (
          SELECT ROW_NUMBER() OVER (ORDER BY SUM(transaction_total) DESC, store_name) AS rank,
            store_name, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales
          FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id GROUP BY store_name)
        WHERE rank <= {P.RANK_LIMIT}""",

    "limit_no_order": with_views("reviews_sentiment") + f"""
        SELECT review_id, email, sentiment FROM reviews_sentiment WHERE sentiment = 'mixed'
        ORDER BY review_id LIMIT {P.MIXED_LIMIT}""",

    "join_fact_store": with_views("fct", "stores") + """
        SELECT transaction_id, transaction_date, transaction_qty,
          CAST(transaction_total AS DOUBLE) AS transaction_total, fct.store_id, product_id,
          store_name, store_location
        FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id""",

    "join_fact_product": with_views("fct", "products") + """
        SELECT transaction_id, transaction_date, transaction_qty,
          CAST(transaction_total AS DOUBLE) AS transaction_total, store_id, fct.product_id,
          product_category, product_detail, CAST(unit_price AS DOUBLE) AS unit_price
        FROM fct LEFT JOIN products ON fct.product_id = products.product_id""",

    "join_star_two_dims": with_views("fct", "stores", "products") + """
        SELECT transaction_id, transaction_date, transaction_qty,
          CAST(transaction_total AS DOUBLE) AS transaction_total, fct.store_id, fct.product_id,
          store_name, product_detail
        FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id
        LEFT JOIN products ON fct.product_id = products.product_id""",

    "join_reviews_store": with_views("reviews", "stores") + """
        SELECT review_id, reviews.store_id, email, score, store_name
        FROM reviews LEFT JOIN stores ON reviews.store_id = stores.store_id""",

    "scan_preview": with_views("fct") + f"""
        SELECT transaction_id, transaction_date, transaction_qty,
          CAST(transaction_total AS DOUBLE) AS transaction_total, store_id, product_id
        FROM fct ORDER BY transaction_id, product_id, store_id, transaction_date LIMIT {P.PREVIEW_ROWS}""",

    "scan_dataset": with_views("fct", "stores", "products", "reviews") + """
        SELECT 'transactions' AS dataset, transaction_id AS row_key, concat_ws('|', CAST(transaction_id AS VARCHAR), CAST(transaction_date AS VARCHAR),
          CAST(transaction_qty AS VARCHAR), CAST(transaction_total AS VARCHAR), CAST(store_id AS VARCHAR), CAST(product_id AS VARCHAR)) AS content FROM fct
        UNION ALL SELECT 'stores', store_id, concat_ws('|', CAST(store_id AS VARCHAR), coalesce(store_name, ''), coalesce(store_location, ''), coalesce(store_description, '')) FROM stores
        UNION ALL SELECT 'reviews', review_id, concat_ws('|', CAST(review_id AS VARCHAR), CAST(store_id AS VARCHAR), email, md5(coalesce(review, '')),
          coalesce(CAST(score AS VARCHAR), '')) FROM reviews
        UNION ALL SELECT 'products', product_id, concat_ws('|', CAST(product_id AS VARCHAR), coalesce(product_category, ''), coalesce(product_detail, ''),
          coalesce(CAST(unit_price AS VARCHAR), '')) FROM products""",

    "window_row_number_topk": with_views("fct", "products") + f"""
        SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY SUM(transaction_total) DESC, product_detail) AS INTEGER) AS rank, product_detail,
            CAST(SUM(transaction_total) AS DOUBLE) AS revenue, CAST(SUM(transaction_qty) AS BIGINT) AS quantity
          FROM fct LEFT JOIN products ON fct.product_id = products.product_id GROUP BY product_detail) WHERE rank <= {P.RANK_LIMIT}""",

    "project_columns": with_views("reviews_sentiment") + """
        SELECT review_id AS "Review ID", store_id AS store, email, score AS review_score, sentiment
        FROM reviews_sentiment""",

    "project_disaggregated": with_views("stores") + """
        SELECT store_location, store_name, store_description FROM stores""",

    "agg_distinct": with_views("products") + """
        SELECT DISTINCT product_id, product_category, product_detail, CAST(unit_price AS DOUBLE) AS unit_price
        FROM products""",

    "agg_group_by_all": with_views("fct", "stores") + """
        SELECT store_location, store_name, CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold,
          COUNT(*) AS n_lines
        FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id GROUP BY ALL""",

    "q_topk_products_per_store": with_views("fct", "stores", "products") + f"""
        SELECT * FROM (
          SELECT store_name, product_detail, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales,
            CAST(ROW_NUMBER() OVER (PARTITION BY store_name
                 ORDER BY ROUND(SUM(transaction_total), 2) DESC, product_detail) AS INTEGER) AS rank
          FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id
          LEFT JOIN products ON fct.product_id = products.product_id
          GROUP BY store_name, product_detail)
        WHERE rank <= {P.TOP_PER_STORE}""",

    "sort_chart_order": with_views("fct", "products") + """
        SELECT *, row_number() OVER (ORDER BY sort_pos NULLS LAST, total_quantity_sold DESC, product_detail) AS position FROM (
          SELECT product_detail, total_quantity_sold,
            CAST(list_position(['""" + "', '".join(P.CHART_ORDER) + """'], product_detail) AS INTEGER) AS sort_pos
          FROM (""" + AGG2 + "))",

    "scalar_ratio": with_views("fct", "stores") + f"""
        SELECT store_name,
          {ratio2('SUM(transaction_total)', 'SUM(transaction_qty)')} AS avg_price_per_item,
          {ratio2('SUM(transaction_qty)', 'COUNT_IF(transaction_qty >= 50)')} AS qty_per_full_line
        FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id GROUP BY store_name""",
}


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in _PARTS:
        out.update(part)
    return out


_PARTS = [STAR_SQL]


_SALES = with_views("fct", "stores", "products")
_JOIN_SP = """FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id
    LEFT JOIN products ON fct.product_id = products.product_id"""
_TIMED = with_views("timed", "timed_stores") + """, h AS (
    SELECT CAST(HOUR(transaction_time) AS INTEGER) AS hour_of_day,
      ROUND(SUM(transaction_total), 2) AS rev, CAST(SUM(transaction_id) AS DOUBLE) AS transactions
    FROM timed LEFT JOIN timed_stores ON timed.store_id = timed_stores.store_id GROUP BY 1)
"""
_RANKED = _SALES + f"""
    SELECT * FROM (
      SELECT CAST(ROW_NUMBER() OVER (ORDER BY ROUND(SUM(transaction_total), 2) DESC, product_detail) AS INTEGER) AS rank,
        product_detail AS "Product detail",
        CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS revenue,
        CAST(SUM(transaction_qty) AS BIGINT) AS quantity
      {_JOIN_SP} GROUP BY product_detail) WHERE rank <= 5"""

MV_SQL: dict[str, str] = {
    "mv_query_one_dim": _SALES + f"""
        SELECT store_name, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS revenue,
          CAST(SUM(transaction_id) AS DOUBLE) AS transactions, CAST(SUM(transaction_qty) AS BIGINT) AS items_sold
        {_JOIN_SP} GROUP BY ALL ORDER BY revenue DESC, store_name""",
    "mv_query_multi_dim": _SALES + f"""
        SELECT fct.product_id AS product, product_detail AS "Product detail",
          CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS revenue,
          CAST(SUM(transaction_qty) AS BIGINT) AS quantity
        {_JOIN_SP} GROUP BY ALL ORDER BY revenue DESC, product LIMIT 10""",
    "mv_query_time": _TIMED + f"""
        SELECT hour_of_day, CAST(rev AS DOUBLE) AS revenue, transactions,
          {ratio2('rev', 'transactions')} AS avg_transaction_value FROM h ORDER BY hour_of_day""",
    "mv_ex_peak_hours": _TIMED + f"""
        SELECT hour_of_day, CAST(rev AS DOUBLE) AS total_revenue, transactions,
          {ratio2('rev', 'transactions')} AS avg_transaction_value FROM h
        ORDER BY avg_transaction_value DESC, hour_of_day""",
    "mv_query_ratio": _SALES + f"""
        SELECT store_name, CAST(rev AS DOUBLE) AS total_revenue, transactions, items_sold,
          {ratio2('rev', 'transactions')} AS avg_transaction_value,
          {ratio2('rev', 'items_sold')} AS avg_price_per_item
        FROM (SELECT store_name, ROUND(SUM(transaction_total), 2) AS rev,
                CAST(SUM(transaction_id) AS DOUBLE) AS transactions,
                CAST(SUM(transaction_qty) AS BIGINT) AS items_sold
              {_JOIN_SP} GROUP BY store_name)
        ORDER BY total_revenue DESC, store_name""",
    "mv_query_topk": _RANKED,
    "mv_ex_product_matrix": _SALES + f"""
        SELECT product_detail AS "Product detail", CAST(rev AS DOUBLE) AS revenue, quantity_sold,
          {ratio2('rev', 'quantity_sold')} AS avg_price_per_item
        FROM (SELECT product_detail, ROUND(SUM(transaction_total), 2) AS rev,
                CAST(SUM(transaction_qty) AS BIGINT) AS quantity_sold {_JOIN_SP} GROUP BY product_detail)
        ORDER BY revenue DESC, "Product detail" """,
    "mv_compose": _SALES + f"""
        SELECT store_name, CAST(rev AS DOUBLE) AS total_sales,
          {ratio2('rev', 'qty')} AS avg_price_per_item
        FROM (SELECT store_name, ROUND(SUM(transaction_total), 2) AS rev, SUM(transaction_qty) AS qty
              {_JOIN_SP} GROUP BY store_name)""",
    "mv_any_subset": with_views("fct") + """
        SELECT CAST(SUM(transaction_id) AS DOUBLE) AS total_transactions,
          COUNT(transaction_id) AS transaction_count,
          CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales,
          CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold FROM fct""",
    "mv_dim_column": _SALES + f"""
        SELECT fct.product_id AS product, product_detail AS "Product detail", store_name,
          CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold {_JOIN_SP} GROUP BY ALL""",
    "mv_dim_expr": with_views("fct") + """
        SELECT make_date(year(transaction_date), month(transaction_date), day(transaction_date)) AS month_day,
          CAST(HOUR(transaction_time) AS INTEGER) AS hour_of_day,
          CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales FROM fct GROUP BY ALL""",
    "mv_measure_sum": _SALES + f"""
        SELECT store_name, CAST(SUM(transaction_id) AS DOUBLE) AS total_transactions,
          CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold {_JOIN_SP} GROUP BY ALL""",
    "mv_measure_rounded": with_views("fct") + """
        SELECT make_date(year(transaction_date), month(transaction_date), day(transaction_date)) AS month_day,
          CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales FROM fct GROUP BY ALL""",
    "mv_join_tree": _SALES + f"""
        SELECT store_name, product_detail AS "Product detail",
          CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales {_JOIN_SP} GROUP BY ALL""",
    "join_snowflake_nested": """
        SELECT r_name AS region, n_name AS nation,
          CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue,
          COUNT(1) AS lines
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "mv_materialize": _SALES + f"""
        SELECT store_name, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales,
          CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold,
          COUNT(transaction_id) AS transaction_count {_JOIN_SP} GROUP BY ALL""",
}
_PARTS.append(MV_SQL)


_D1 = with_views("fct", "stores", "products", extra={"agg1": AGG1})
_D2 = with_views("fct", "products", extra={"agg2": AGG2})
_D3 = with_views("timed", "timed_stores", extra={"agg3": AGG3})
_CUBE = """SELECT product_detail, store_name,
      CAST(SUM(CAST(total_sales AS DECIMAL(18,2))) AS DOUBLE) AS sum_total_sales,
      CAST(GROUPING(product_detail, store_name) AS INTEGER) AS grouping_id
    FROM agg1 GROUP BY CUBE (product_detail, store_name)"""
_STORES_IN = "(" + ", ".join(f"'{s}'" for s in P.FILTER_STORES) + ")"
_GLOBAL_IN = "(" + ", ".join(f"'{s}'" for s in P.GLOBAL_FILTER_STORES) + ")"
DASH_SQL: dict[str, str] = {
    "dash_weekly_avg_store": _D1 + f"""
        SELECT store_name, CAST(date_trunc('week', month_day) AS DATE) AS week_start,
          {avg2('CAST(total_sales AS DECIMAL(18,2))')} AS avg_total_sales FROM agg1 GROUP BY ALL""",
    "dash_weekly_avg_chain": _D1 + f"""
        SELECT CAST(date_trunc('week', month_day) AS DATE) AS week_start,
          {avg2('CAST(total_sales AS DECIMAL(18,2))')} AS avg_total_sales FROM agg1 GROUP BY ALL""",
    "dash_store_table": with_views("stores") + "SELECT store_location, store_name, store_description FROM stores",
    "dash_pivot_sales": _D1 + f"""
        SELECT *, printf('%.2f', sum_total_sales) AS display,
          sum_total_sales < {P.PIVOT_FLAG_THRESHOLD} AS highlight FROM ({_CUBE})""",
    "agg_cube_pivot": _D1 + _CUBE,
    "dash_heatmap_hours": _D3 + """
        SELECT CAST(SUM(CAST(total_store_sales_per_hour AS DECIMAL(18,2))) AS DOUBLE) AS sum_total_store_sales_per_hour,
          hour_of_day, store_name, hour_of_day BETWEEN """ + f"{P.HEATMAP_HOURS[0]} AND {P.HEATMAP_HOURS[1]}" + """ AS shown FROM agg3 GROUP BY ALL""",
    "dash_bar_products": _D2 + """
        SELECT product_detail, CAST(SUM(total_quantity_sold) AS BIGINT) AS sum_total_quantity_sold
        FROM agg2 GROUP BY product_detail""",
    "dash_bar_products_sorted": _D2 + """
        SELECT product_detail, CAST(SUM(total_quantity_sold) AS BIGINT) AS sum_total_quantity_sold
        FROM agg2 GROUP BY product_detail ORDER BY sum_total_quantity_sold DESC, product_detail""",
    "dash_bar_hours": _D3 + "SELECT hour_of_day, total_transactions_per_hour FROM agg3",
    "dash_counters": with_views("fct", "products", "reviews_sentiment") + """
        SELECT 'reviews' AS dataset, COUNT(*) AS count FROM reviews_sentiment
        UNION ALL SELECT 'products', COUNT(*) FROM products
        UNION ALL SELECT 'transactions', COUNT(*) FROM fct""",
    "dash_pie_sentiment": with_views("reviews_sentiment") + """
        SELECT COUNT(*) AS count, sentiment FROM reviews_sentiment GROUP BY sentiment""",
    "dash_facet_counts": with_views("fct", "stores", "products", "timed", "timed_stores", extra={"agg1": AGG1, "agg3": AGG3}) + f"""
        SELECT 'page store' AS filter, 'stores' AS dataset, 'store_name' AS field, store_name AS value,
          COUNT_IF(store_name IN {_GLOBAL_IN}) AS associativity FROM stores GROUP BY ALL
        UNION ALL SELECT 'page store', 'daily', 'store_name', store_name, COUNT_IF(store_name IN {_GLOBAL_IN}) FROM agg1 GROUP BY ALL
        UNION ALL SELECT 'page store', 'hourly', 'store_name', store_name, COUNT(*) FROM agg3 GROUP BY ALL
        UNION ALL SELECT 'store', 'stores', 'store_name', store_name, COUNT(*) FROM stores GROUP BY ALL
        UNION ALL SELECT 'store', 'daily', 'store_name', store_name, COUNT(*) FROM agg1 GROUP BY ALL
        UNION ALL SELECT 'product', 'products', 'product_detail', product_detail, COUNT(*) FROM products GROUP BY ALL""",
    "dash_apply_filters": _D1 + f"""
        SELECT 'stores' AS page, store_name, CAST(date_trunc('week', month_day) AS DATE) AS week_start,
          {avg2('CAST(total_sales AS DECIMAL(18,2))')} AS avg_total_sales FROM agg1
        WHERE store_name IN {_STORES_IN} AND store_name IN {_GLOBAL_IN} GROUP BY ALL
        UNION ALL SELECT 'marketing', NULL, CAST(date_trunc('week', month_day) AS DATE) AS w,
          {avg2('CAST(total_sales AS DECIMAL(18,2))')} FROM agg1 WHERE store_name IN {_GLOBAL_IN} GROUP BY w""",
    "agg_pivot_matrix": with_views("fct", "stores", "products") + f"""
        SELECT product_detail, GROUPING(product_detail) = 1 AS is_total,
          {', '.join(f"CAST(SUM(transaction_total) FILTER (WHERE store_name = '{s}') AS DOUBLE) AS " + '"' + s + '"' for s in P.PIVOT_STORES)},
          CAST(SUM(transaction_total) FILTER (WHERE store_name IS NULL OR store_name NOT IN {tuple(P.PIVOT_STORES)}) AS DOUBLE) AS other_stores,
          CAST(SUM(transaction_total) AS DOUBLE) AS all_stores
        FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id LEFT JOIN products ON fct.product_id = products.product_id
        WHERE YEAR(transaction_date) = {_Y} GROUP BY GROUPING SETS ((product_detail), ())""",
    "agg_avg": _D1 + f"SELECT {avg2('CAST(total_sales AS DECIMAL(18,2))')} AS avg_total_sales FROM agg1",
    "agg_count_if": _D1 + f"""
        SELECT store_name, COUNT_IF(total_sales < {P.LOW_SALES_DAY}) AS low_sales_days, COUNT(*) AS days
        FROM agg1 GROUP BY store_name""",
    "agg_two_level": _D3 + f"""
        SELECT store_name, {avg2('CAST(total_store_sales_per_hour AS DECIMAL(18,2))')} AS avg_sales_per_hour
        FROM agg3 GROUP BY store_name""",
    "agg_count_star": with_views("reviews_sentiment") + "SELECT COUNT(*) AS count FROM reviews_sentiment",
    "scalar_threshold_flag": _D1 + f"""
        SELECT product_detail, store_name,
          CAST(SUM(CAST(total_sales AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
          SUM(CAST(total_sales AS DECIMAL(18,2))) < {P.PIVOT_FLAG_THRESHOLD} AS below_threshold
        FROM agg1 GROUP BY product_detail, store_name""",
    "filter_multi_select": _D1 + f"SELECT * FROM agg1 WHERE store_name IN {_STORES_IN}",
    "filter_single_select": with_views("products") + f"""
        SELECT product_id, product_category, product_detail, CAST(unit_price AS DOUBLE) AS unit_price
        FROM products WHERE product_detail = '{P.FILTER_PRODUCT}'""",
}
_PARTS.append(DASH_SQL)


# The word lists of the default sentiment lexicon and, in the two prompt
# queries below, the reference's prompt texts.
# Lexicon sentiment, restated independently of the Spark scorer.
_LEX = """, lex AS (SELECT *, string_split_regex(lower(review), '[^a-z]+') AS toks FROM reviews),
cnt AS (SELECT *, list_has_any(toks, ['good', 'great', 'excellent', 'amazing', 'awesome', 'best', 'love', 'loved', 'lovely', 'friendly', 'delicious', 'tasty', 'fresh', 'fast', 'clean', 'nice', 'perfect', 'happy', 'recommend', 'wonderful', 'fantastic', 'pleasant', 'helpful', 'cozy', 'favorite']) AS p,
  list_has_any(toks, ['bad', 'poor', 'terrible', 'awful', 'worst', 'hate', 'hated', 'rude', 'slow', 'dirty', 'cold', 'stale', 'bland', 'overpriced', 'disappointing', 'disappointed', 'horrible', 'unfriendly', 'never', 'noisy', 'burnt', 'wrong', 'late', 'broken', 'sad', 'trash', 'worthless', 'idiot', 'scum', 'moron', 'pathetic', 'clown', 'disgusting', 'stupid', 'loser']) AS n FROM lex),
scored AS (SELECT review_id, store_id, email, review, score,
  CASE WHEN review IS NULL THEN NULL WHEN p AND n THEN 'mixed' WHEN p THEN 'positive'
       WHEN n THEN 'negative' ELSE 'neutral' END AS sentiment FROM cnt)
"""

AI_SQL: dict[str, str] = {
    "ai_prompt_product": with_views("products") + f"""
        SELECT product_id, product_category, product_detail,
          'Create a description of the product based on the product category' || product_category || 'and detail' || product_detail || 'and unit price in dollars'
          || CAST(unit_price AS VARCHAR) || 'The output should be just the description and vary for each product' AS prompt
        FROM (SELECT DISTINCT product_id, product_category, product_detail, unit_price FROM products)
        ORDER BY product_id DESC LIMIT {P.PROMPT_LIMIT}""",
    "ai_sentiment_table": with_views("reviews") + _LEX + "SELECT * FROM scored",
    "sink_ctas": with_views("reviews") + _LEX + "SELECT * FROM scored",
    "limit_before_inference": with_views("reviews") + _LEX + f""", f AS (SELECT * FROM scored ORDER BY review_id LIMIT {2 * P.MIXED_LIMIT}),
        o AS (SELECT * FROM f ORDER BY review_id LIMIT {P.MIXED_LIMIT})
        SELECT review_id, sentiment, (SELECT COUNT(DISTINCT review) FROM o) AS first_run,
          (SELECT COUNT(DISTINCT review) FROM f WHERE review NOT IN (SELECT review FROM o WHERE review IS NOT NULL)) AS second_run FROM f""",
    "ai_sentiment_counts": with_views("reviews") + _LEX
        + "SELECT sentiment, COUNT(review_id) AS total_reviews FROM scored GROUP BY sentiment",
    "ai_email_gen": with_views("reviews_sentiment", "stores") + """
        SELECT review_id, email,
          regexp_replace(lower(split_part(email, '@', 1)), '[^a-z0-9_]', '_', 'g') AS name_hint,
          'Use this review:' || review || 'to create a email advertising a 10% discount at the store:' || store_name || 'Use the email:' || email || 'as to infer the user name'
          || '. The output should be just the email and vary for each review' AS prompt
        FROM reviews_sentiment LEFT JOIN stores ON reviews_sentiment.store_id = stores.store_id
        WHERE sentiment = 'mixed' ORDER BY review_id LIMIT """ + str(P.MIXED_LIMIT),
}


def _generated(prompts: str, key: str, prefix: str, out: str, keep: str) -> str:
    """The default generator's text for every prompt: number of words, and its three most frequent words of four letters or more."""
    return f"""WITH prompts AS ({prompts}),
        w AS (SELECT {key}, unnest(regexp_extract_all(prompt, '\\p{{L}}{{4,}}')) AS x FROM prompts),
        c AS (SELECT {key}, lower(x) AS x, count(*) AS n FROM w GROUP BY 1, 2),
        t AS (SELECT {key}, string_agg(x, ', ' ORDER BY n DESC, x) AS top FROM
              (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, x) AS r FROM c) WHERE r <= 3 GROUP BY 1)
        SELECT {keep}, CASE WHEN prompt IS NOT NULL THEN '{prefix}' || CAST(len(regexp_extract_all(prompt, '[^\\s\\p{{Z}}]+')) AS VARCHAR)
          || ' words; key terms: ' || coalesce(top, '') END AS {out} FROM prompts LEFT JOIN t USING ({key})"""


AI_SQL["ai_product_description"] = _generated(AI_SQL["ai_prompt_product"], "product_id", "Description: ", "product_description",
                                              "product_id, product_category, product_detail")
AI_SQL["ai_email_generated"] = _generated(AI_SQL["ai_email_gen"], "review_id", "Email: ", "advertising_emails", "review_id, email")
_PARTS.append(AI_SQL)


_REG = """, reg AS (SELECT event_id AS device_id, event_type AS mac_address, epoch(ts) AS registration_timestamp,
    user_id, CAST(ts AS DATE) AS d FROM events)
"""
_R0, _R1 = P.REPLAY_RANGE
_B0, _B1 = P.BATCH_RANGE

LANDING_SQL: dict[str, str] = {
    "replay_user_reg": "WITH x AS (SELECT 1)" + _REG + f"""
        SELECT device_id, mac_address, registration_timestamp, user_id FROM reg
        WHERE (CASE WHEN d < DATE '2024-01-10' THEN 1 ELSE dayofmonth(d) + 1 END) BETWEEN {_R0} AND {_R1}""",
    "with_column_drop": "WITH x AS (SELECT 1)" + _REG + """
        SELECT device_id, mac_address, registration_timestamp, user_id FROM reg
        WHERE (CASE WHEN d < DATE '2024-01-10' THEN 1 ELSE dayofmonth(d) + 1 END) = 1""",
    "scalar_batch_no": "WITH x AS (SELECT 1)" + _REG + """
        SELECT device_id, CAST(CASE WHEN d < DATE '2024-01-10' THEN 1 ELSE dayofmonth(d) + 1 END AS INTEGER) AS batch
        FROM reg""",
    "scalar_epoch_to_date": "WITH x AS (SELECT 1)" + _REG + "SELECT device_id, d AS registration_date FROM reg",
    "replay_cdc": with_views("change_rows") + f"SELECT * FROM change_rows WHERE batch BETWEEN {_B0} AND {_B1}",
    "replay_daily": with_views("daily_events") + f"""
        SELECT event_id, user_id, value, topic FROM daily_events
        WHERE (CASE WHEN date <= DATE '2024-01-10' THEN 1 ELSE dayofmonth(date) END) BETWEEN {_R0} AND {_R1}""",
    "read_default_format": "SELECT * FROM customer",
    "read_partitioned": with_views("daily_events") + """
        SELECT event_id, user_id, value, date, topic FROM daily_events WHERE topic = 'click'""",
    "ingest_csv_stream": with_views("products") + """
        SELECT CAST(product_id AS VARCHAR) AS product_id, product_category, product_detail,
          CAST(unit_price AS VARCHAR) AS unit_price FROM products""",
    "ingest_typed_layer": with_views("products") + """
        SELECT product_id, product_category, product_detail, CASE WHEN product_id % 10 <> 3 THEN CAST(unit_price AS DOUBLE) END AS unit_price,
          CASE WHEN product_id % 10 = 3 THEN 'unit_price' END AS failed_column, CASE WHEN product_id % 10 = 3 THEN 'on request' END AS failed_value
        FROM products""",
    "read_json_schema": """
        WITH l AS (SELECT *, '{"device_id":' || event_id || ',"mac_address":"' || event_type || '"' AS head FROM events)
        SELECT CASE WHEN event_id % 10 NOT IN (3, 7) THEN event_id END AS device_id, CASE WHEN event_id % 10 NOT IN (3, 7) THEN event_type END AS mac_address,
          CASE WHEN event_id % 10 NOT IN (3, 7) THEN user_id END AS user_id, CASE WHEN event_id % 10 IN (3, 7) THEN '_corrupt_record' END AS failed_column,
          CASE event_id % 10 WHEN 3 THEN head WHEN 7 THEN head || ',"user_id":"someone"}' END AS failed_value FROM l""",
    "clone_table": with_views("products") + """
        SELECT product_id, product_category, product_detail, CAST(unit_price AS DOUBLE) AS unit_price, clone
        FROM products, (VALUES ('copy'), ('reference')) c(clone)""",
    "ingest_csv_sep": with_views("stores") + """
        SELECT CAST(store_id AS VARCHAR) AS store_id, store_name, store_location, store_description FROM stores""",
    "replay_load": "WITH x AS (SELECT 1)" + _REG + """
        SELECT device_id, mac_address, registration_timestamp, user_id, batch, count(*) OVER (PARTITION BY batch) AS batch_rows
        FROM (SELECT *, CAST(CASE WHEN d < DATE '2024-01-10' THEN 1 ELSE dayofmonth(d) + 1 END AS INTEGER) AS batch FROM reg)""",
    "agg_batch_count": "WITH x AS (SELECT 1)" + _REG + """
        SELECT CAST(n.range AS INTEGER) AS batch, count(d) AS rows FROM range(1, 33) n
        LEFT JOIN reg ON CASE WHEN d < DATE '2024-01-10' THEN 1 ELSE dayofmonth(d) + 1 END = n.range GROUP BY n.range""",
    "sink_append_json": with_views("change_rows") + "SELECT *, count(*) OVER () AS rows_appended FROM change_rows",
    "ingest_table_set": with_views("fct", "stores", "products", "reviews") + """
        SELECT 'transactions' AS table_name, transaction_id AS row_key, concat_ws('|', CAST(transaction_id AS VARCHAR), CAST(transaction_date AS VARCHAR),
          CAST(transaction_qty AS VARCHAR), CAST(transaction_total AS VARCHAR), CAST(store_id AS VARCHAR), CAST(product_id AS VARCHAR),
          CASE WHEN transaction_id % 2 = 0 THEN '' ELSE 'web' END) AS content FROM fct
        UNION ALL SELECT 'stores', store_id, concat_ws('|', CAST(store_id AS VARCHAR), coalesce(store_name, ''), coalesce(store_location, ''), coalesce(store_description, '')) FROM stores
        UNION ALL SELECT 'reviews', review_id, concat_ws('|', CAST(review_id AS VARCHAR), CAST(store_id AS VARCHAR), email, md5(coalesce(review, '')),
          coalesce(CAST(score AS VARCHAR), '')) FROM reviews
        UNION ALL SELECT 'products', product_id, concat_ws('|', CAST(product_id AS VARCHAR), coalesce(product_category, ''), coalesce(product_detail, ''),
          coalesce(CAST(unit_price AS VARCHAR), '')) FROM products""",
    "ingest_full_refresh": with_views("stores") + """
        SELECT CAST(store_id AS VARCHAR) AS store_id, store_name, store_location, store_description, 2 AS version FROM stores, range(2)""",
    "stream_incremental_append": """
        SELECT event_id AS device_id, event_type AS mac_address, user_id, event_id % 3 AS run FROM events""",
    "stream_triggered": """
        SELECT event_type, count(*) AS rows, (SELECT count(*) FROM events) AS rows_of_run, true AS over_100_batches FROM events GROUP BY event_type""",
}
_PARTS.append(LANDING_SQL)


_SJ = "FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id"
_PJ = "FROM fct LEFT JOIN products ON fct.product_id = products.product_id"
_TOPCAT = f"""topcat AS (SELECT product_category FROM fct LEFT JOIN products ON fct.product_id = products.product_id
    GROUP BY product_category ORDER BY ROUND(SUM(transaction_total), 2) DESC, product_category LIMIT {{k}})"""
_HOURLY = """SELECT CAST(HOUR(transaction_time) AS INTEGER) AS hour_of_day,
      CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales FROM timed GROUP BY 1"""
_CMP_A, _CMP_B = P.COMPARE_STORES

COLUMN_SQL: dict[str, str] = {
    "scalar_format_currency": with_views("fct", "products") + """
        , s AS (SELECT product_detail, CAST(SUM(transaction_total) AS DECIMAL(38,2)) AS t FROM fct LEFT JOIN products ON fct.product_id = products.product_id GROUP BY 1),
        a AS (SELECT product_detail, unnest([CAST(t AS DECIMAL(38,2)), CAST(-t AS DECIMAL(38,2)), CAST(round(t / 1000, 2) AS DECIMAL(38,2))]) AS v FROM s),
        c AS (SELECT *, CASE WHEN abs(v) >= 1000000000 THEN 9 WHEN abs(v) >= 1000000 THEN 6 WHEN abs(v) >= 1000 THEN 3 ELSE 0 END AS e FROM a),
        k AS (SELECT *, CAST(CAST(round(CAST(v AS DECIMAL(38,10)) / CAST(10 ** e AS DECIMAL(18,0)), 2) AS DECIMAL(38,2)) AS VARCHAR) AS b FROM c)
        SELECT product_detail, CASE WHEN v < 0 THEN '-' ELSE '' END || '$' || format('{:,.2f}', CAST(abs(v) AS DOUBLE)) AS currency, CAST(v AS VARCHAR) AS plain,
          regexp_replace(b, '\\.?0+$', '') || CASE e WHEN 9 THEN 'B' WHEN 6 THEN 'M' WHEN 3 THEN 'K' ELSE '' END AS compact FROM k""",
    "scalar_make_date": with_views("fct") + """
        SELECT transaction_id, product_id,
          make_date(year(transaction_date), month(transaction_date), day(transaction_date)) AS month_day FROM fct""",
    "scalar_date_parts": with_views("fct") + """
        SELECT transaction_id, product_id, CAST(year(transaction_date) AS INTEGER) AS year,
          CAST(month(transaction_date) AS INTEGER) AS month, CAST(day(transaction_date) AS INTEGER) AS day FROM fct""",
    "scalar_hour": with_views("timed") + """
        SELECT transaction_id, CAST(hour(transaction_time) AS INTEGER) AS hour_of_day FROM timed""",
    "scalar_week_trunc": with_views("fct") + """
        SELECT transaction_id, product_id, CAST(date_trunc('week', transaction_date) AS DATE) AS week_start FROM fct""",
    "scalar_round_money": with_views("products") + """
        SELECT product_id, CAST(ROUND(unit_price * CAST('1.0825' AS DECIMAL(6,4)), 2) AS DOUBLE) AS price_with_tax
        FROM products""",
    "scalar_concat_prompt": with_views("reviews", "stores") + """
        SELECT review_id, 'Review of ' || store_name || ' by ' || email || ': ' || review AS prompt
        FROM reviews LEFT JOIN stores ON reviews.store_id = stores.store_id""",
    "scalar_email_to_name": with_views("reviews") + """
        SELECT review_id, email, regexp_replace(lower(split_part(email, '@', 1)), '[^a-z0-9_]', '_', 'g') AS name_hint
        FROM reviews""",
    "scalar_slug": with_views("products") + """
        SELECT product_id, regexp_replace(product_detail, '[^a-zA-Z0-9]+', '-', 'g') AS slug,
          regexp_replace(concat_ws(' / ', product_category, product_detail), '[^a-zA-Z0-9]+', '-', 'g') AS path_slug
        FROM products""",
    "scalar_path_name": "SELECT page_id, string_split(url, '/')[-1] AS page_name FROM pages",
}

QUESTION_SQL: dict[str, str] = {
    "q_best_hour_chain": with_views("timed") + _HOURLY + " ORDER BY total_sales DESC, hour_of_day LIMIT 1",
    "q_hours_at_risk": with_views("timed") + f"SELECT * FROM ({_HOURLY}) WHERE total_sales < {P.HOUR_RISK_THRESHOLD}",
    "q_negative_count_avg": with_views("reviews_sentiment") + f"""
        SELECT COUNT(review_id) AS negative_reviews, {avg2('score')} AS avg_score
        FROM reviews_sentiment WHERE sentiment = 'negative'""",
    "q_products_at_risk": with_views("fct", "products") + f"""
        SELECT fct.product_id, product_detail, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales
        {_PJ} GROUP BY fct.product_id, product_detail HAVING SUM(transaction_total) < {P.PRODUCT_RISK_THRESHOLD}""",
    "q_best_product": with_views("fct", "products") + f"""
        SELECT product_detail, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales {_PJ}
        GROUP BY product_detail ORDER BY total_sales DESC, product_detail LIMIT 1""",
    "q_sales_by_store_year": with_views("fct", "stores") + f"""
        SELECT store_name, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales {_SJ}
        WHERE YEAR(transaction_date) = {_Y} GROUP BY store_name ORDER BY total_sales DESC, store_name""",
    "q_sales_by_store": with_views("fct", "stores") + f"""
        SELECT store_name, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales {_SJ} GROUP BY store_name""",
    "q_best_satisfaction": with_views("reviews", "stores") + f"""
        SELECT b.store_id, avg_score, n_reviews, store_name FROM (
          SELECT store_id, {avg2('score')} AS avg_score, COUNT(review_id) AS n_reviews FROM reviews
          GROUP BY store_id ORDER BY avg_score DESC, n_reviews DESC, store_id LIMIT 1) b
        LEFT JOIN stores ON b.store_id = stores.store_id""",
    "q_total_transactions": with_views("fct") + "SELECT COUNT(*) AS n_transactions FROM fct",
    "q_store_count": with_views("stores") + "SELECT COUNT(DISTINCT store_id) AS n_stores FROM stores",
    "q_first_products": with_views("products") + """
        SELECT product_id, product_detail, CAST(unit_price AS DOUBLE) AS unit_price FROM products
        ORDER BY product_id LIMIT 10""",
    "q_avg_txn_by_store": with_views("fct", "stores") + f"""
        SELECT store_name, {ratio2('SUM(transaction_total)', 'COUNT(transaction_total)')} AS avg_transaction_total
        {_SJ} GROUP BY store_name""",
    "q_top_category_qty": with_views("fct", "products") + f"""
        SELECT product_category, CAST(SUM(transaction_qty) AS BIGINT) AS total_quantity_sold {_PJ}
        GROUP BY product_category ORDER BY total_quantity_sold DESC, product_category LIMIT 1""",
    "q_drilldown_category": with_views("fct", "products") + f"""
        SELECT product_category, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales {_PJ}
        GROUP BY product_category""",
    "q_drilldown_top3": with_views("fct", "products") + f"""
        SELECT product_category, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales {_PJ}
        GROUP BY product_category ORDER BY total_sales DESC, product_category LIMIT {P.TOP_CATEGORIES}""",
    "q_drilldown_by_store": with_views("fct", "stores", "products") + ", " + _TOPCAT.format(k=P.TOP_CATEGORIES) + """
        SELECT product_category, store_name, CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales
        FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id
        LEFT JOIN products ON fct.product_id = products.product_id
        WHERE product_category IN (SELECT product_category FROM topcat)
        GROUP BY product_category, store_name""",
    "q_store_growth": with_views("fct", "stores", "products") + ", " + _TOPCAT.format(k=1) + f"""
        SELECT product_category, store_name, CAST(total AS DOUBLE) AS total_sales,
          CAST(ROUND(s_first, 2) AS DOUBLE) AS sales_first_year, CAST(ROUND(s_last, 2) AS DOUBLE) AS sales_last_year,
          {ratio2('s_last - s_first', 's_first')} AS growth
        FROM (SELECT product_category, store_name, SUM(transaction_total) AS total,
                SUM(CASE WHEN YEAR(transaction_date) = {P.GROWTH_FIRST_YEAR} THEN transaction_total END) AS s_first,
                SUM(CASE WHEN YEAR(transaction_date) = {P.GROWTH_LAST_YEAR} THEN transaction_total END) AS s_last
              FROM fct LEFT JOIN stores ON fct.store_id = stores.store_id
              LEFT JOIN products ON fct.product_id = products.product_id
              WHERE product_category IN (SELECT product_category FROM topcat)
              GROUP BY product_category, store_name)
        ORDER BY growth DESC NULLS LAST, store_name LIMIT 1""",
    "q_reviews_by_sentiment": with_views("reviews_sentiment") + """
        SELECT sentiment, COUNT(review_id) AS total_reviews FROM reviews_sentiment GROUP BY sentiment""",
    "q_most_negative_store": with_views("reviews_sentiment", "stores") + """
        SELECT store_name, COUNT(review_id) AS negative_reviews
        FROM reviews_sentiment LEFT JOIN stores ON reviews_sentiment.store_id = stores.store_id
        WHERE sentiment = 'negative' GROUP BY store_name ORDER BY negative_reviews DESC, store_name LIMIT 1""",
    "q_pos_neg_ratio": with_views("reviews_sentiment", "stores") + f"""
        SELECT store_name, positive_reviews, negative_reviews,
          {ratio2('positive_reviews', 'negative_reviews')} AS pos_neg_ratio
        FROM (SELECT store_name, COUNT_IF(sentiment = 'positive') AS positive_reviews,
                COUNT_IF(sentiment = 'negative') AS negative_reviews
              FROM reviews_sentiment LEFT JOIN stores ON reviews_sentiment.store_id = stores.store_id
              GROUP BY store_name)""",
    "q_monthly_sales": with_views("fct") + """
        SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month,
          CAST(ROUND(SUM(transaction_total), 2) AS DOUBLE) AS total_sales FROM fct GROUP BY 1""",
    "q_compare_two": with_views("fct", "stores") + f"""
        SELECT '{_CMP_A}' AS store_a, '{_CMP_B}' AS store_b,
          CAST(ROUND(SUM(CASE WHEN store_name = '{_CMP_A}' THEN transaction_total END), 2) AS DOUBLE) AS sales_a,
          CAST(ROUND(SUM(CASE WHEN store_name = '{_CMP_B}' THEN transaction_total END), 2) AS DOUBLE) AS sales_b,
          CAST(SUM(CASE WHEN store_name = '{_CMP_A}' THEN transaction_qty END) AS BIGINT) AS qty_a,
          CAST(SUM(CASE WHEN store_name = '{_CMP_B}' THEN transaction_qty END) AS BIGINT) AS qty_b
        {_SJ} WHERE store_name IN ('{_CMP_A}', '{_CMP_B}')""",
    "q_sales_with_reviews": with_views("fct", "reviews", "stores") + """
        SELECT COALESCE(s.store_id, r.store_id) AS store_id, store_name,
          CAST(ROUND(COALESCE(s.total, 0), 2) AS DOUBLE) AS total_sales, COALESCE(r.n, 0) AS total_reviews
        FROM (SELECT store_id, SUM(transaction_total) AS total FROM fct GROUP BY store_id) s
        FULL OUTER JOIN (SELECT store_id, COUNT(review_id) AS n FROM reviews GROUP BY store_id) r
          ON s.store_id = r.store_id
        LEFT JOIN stores ON COALESCE(s.store_id, r.store_id) = stores.store_id""",
    "q_trusted_sql": STAR_SQL["topk_products_store"],
}
_PARTS += [COLUMN_SQL, QUESTION_SQL]
QUESTION_SQL["join_relationships"] = QUESTION_SQL["q_sales_by_store"]
